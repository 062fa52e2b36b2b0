"""Encoding of a whole corpus with a public byte-level BPE tokenizer.

The frequent words of the corpus are compiled, with their ids, into a minimal acyclic transducer: states with the same
continuations are shared, and the outputs along a path add up to a word's number, which points into the table of ids.
Its arrays are one file in the shared folder that the workers map into memory. Words that it doesn't hold are merged
exactly, by rank, so the lexicon changes the speed and never the result.
"""

from __future__ import annotations

import base64
import os
import re
import uuid
from array import array
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import shared_dir

TOKENIZERS = "/opt/tokenizers"
#: Words of the lexicon; words of a partition that are counted before the counts are passed on; words a worker keeps.
LEXICON_WORDS, COUNTED_WORDS, KEPT_WORDS = 1 << 16, 1 << 18, 1 << 19
#: Longer words are merged without being kept.
LONGEST = 64

# Fixed value: the published pre-tokenisation pattern of this vocabulary, and what it comes to for ASCII text. The
# pattern's white space is Unicode's, which (unlike Python's) leaves out the separators \x1c to \x1f.
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
_ANY = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_ASCII = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[A-Za-z]+| ?[0-9]+| ?[^\t\n\x0b\x0c\r A-Za-z0-9]+|[\t\n\x0b\x0c\r ]+(?![^\t\n\x0b\x0c\r ])|[\t\n\x0b\x0c\r ]+")


def words_of(text: str) -> list[str]:
    return (_ASCII if text.isascii() else _ANY).findall(text)


class Merger:
    """Exact merges by rank of one word's bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}

    def ids(self, word: bytes) -> list[int]:
        ranks = self.ranks
        if word in ranks:
            return [ranks[word]]
        if len(word) > 512:
            return self._long(word)
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            best = min(pairs)
            if best == 1 << 60:
                break
            out, i = [], 0
            while i < len(parts):
                if i < len(pairs) and pairs[i] == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return [ranks[p] for p in parts]

    def _long(self, word: bytes) -> list[int]:
        """The same with a heap over a linked list, for words that may be as long as a text."""
        import heapq

        ranks, n = self.ranks, len(word)
        part = [word[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or j >= n or len(part[i]) + len(part[j]) != size or len(part[i]) == 0:
                continue
            part[i] += part[j]
            part[j] = None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := ranks.get(part[a] + part[b])) is not None:
                    heapq.heappush(heap, (r, a, len(part[a]) + len(part[b])))
        return [ranks[p] for p in part if p is not None]


def compile_lexicon(words: dict[str, list[int]]) -> dict[str, np.ndarray]:
    """Arrays of the minimal transducer: arcs sorted by state * 256 + byte with target and output, and for each state
    whether a word ends there; then the ids of all words in the order of their bytes."""
    entries = sorted((w.encode(), ids) for w, ids in words.items())
    register: dict[tuple, int] = {}
    finals: list[bool] = []
    counts: list[int] = []
    frozen: list[tuple] = []

    def freeze(node) -> int:
        key = (node[0], tuple(node[1]))
        if (s := register.get(key)) is None:
            s = register[key] = len(frozen)
            frozen.append(key)
            finals.append(node[0])
            counts.append(node[0] + sum(counts[t] for _, t in node[1]))
        return s

    path, last = [[False, []]], b""  # a node: [ends here, [(byte, frozen target)]]
    for word, _ in entries:
        same = len(os.path.commonprefix([last, word]))
        while len(path) - 1 > same:
            done = path.pop()
            path[-1][1].append((last[len(path) - 1], freeze(done)))
        path += [[False, []] for _ in word[same:]]
        path[-1][0] = True
        last = word
    while len(path) > 1:
        done = path.pop()
        path[-1][1].append((last[len(path) - 1], freeze(done)))
    root = freeze(path[0])
    keys, targets, outputs = [], [], []
    for s, (final, arcs) in enumerate(frozen):
        before = int(final)
        for byte, t in arcs:
            keys.append(s * 256 + byte)
            targets.append(t)
            outputs.append(before)
            before += counts[t]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return {
        "arc": np.array(keys, np.int64)[order],
        "to": np.array(targets, np.int64)[order],
        "out": np.array(outputs, np.int64)[order],
        "final": np.array(finals, np.int64),
        "root": np.array([root], np.int64),
        "start": np.cumsum([0, *(len(i) for _, i in entries)]).astype(np.int64),
        "ids": np.array(list(chain.from_iterable(i for _, i in entries)), np.int64),
    }


_PARTS = ("arc", "to", "out", "final", "root", "start", "ids")


def to_bytes(lexicon: dict[str, np.ndarray]) -> bytes:
    return np.array([len(lexicon[k]) for k in _PARTS], np.int64).tobytes() + b"".join(lexicon[k].tobytes() for k in _PARTS)


def open_lexicon(path: str) -> dict[str, np.ndarray]:
    """Map the file into memory where the folder is mounted; else read it from its file system."""
    if path.startswith("file:") or "://" not in path:
        whole = np.memmap(re.sub(r"^file:/*", "/", path), np.int64, "r")
    else:
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(path)
        with system.open_input_file(at) as f:
            whole = np.frombuffer(f.read(), np.int64)
    sizes, at, out = whole[: len(_PARTS)], len(_PARTS), {}
    for name, n in zip(_PARTS, sizes.tolist()):
        out[name] = whole[at : at + n]
        at += n
    return out


def look_up(lexicon: dict[str, np.ndarray], words: list[str]) -> np.ndarray:
    """The number of each word in the lexicon, or -1; all words advance by one byte at a time."""
    raw = [w.encode() for w in words]
    n, longest = len(raw), max(map(len, raw), default=0)
    grid = np.zeros((n, longest), np.uint8)
    sizes = np.fromiter(map(len, raw), np.int64, n)
    flat = np.frombuffer(b"".join(raw), np.uint8)
    grid[np.arange(longest) < sizes[:, None]] = flat
    state, number, alive = np.full(n, lexicon["root"][0]), np.zeros(n, np.int64), np.ones(n, bool)
    arcs = lexicon["arc"]
    for i in range(longest if len(arcs) else 0):
        at = np.flatnonzero(alive & (sizes > i))
        key = state[at] * 256 + grid[at, i]
        pos = np.minimum(np.searchsorted(arcs, key), len(arcs) - 1)
        hit = arcs[pos] == key
        alive[at[~hit]] = False
        state[at[hit]] = lexicon["to"][pos[hit]]
        number[at[hit]] += lexicon["out"][pos[hit]]
    good = alive & (sizes > 0) & (lexicon["final"][state] == 1) if len(arcs) else np.zeros(n, bool)
    return np.where(good, number, -1)


def _count(batches):
    counts: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(words_of(text))
        if len(counts) > COUNTED_WORDS:
            yield out()
            counts.clear()
    yield out()


def frequent_words(docs: DataFrame, text: str, limit: int = LEXICON_WORDS) -> list[str]:
    """The words that occur most often in the whole corpus, counted twice at least, at most ``limit``; ties by word."""
    counted = docs.select(F.col(text).cast("string")).mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.where(f"n > 1 and octet_length(word) <= {LONGEST}").orderBy(F.desc("n"), "word").limit(limit)
    return [r.word for r in top.collect()]


def _store(spark: SparkSession, data: bytes) -> str:
    path = f"{shared_dir(spark)}/plumbline/{uuid.uuid4().hex}/lexicon.bin"
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    system = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = system.create(jpath)
    stream.write(bytearray(data))
    stream.close()
    system.deleteOnExit(jpath.getParent())
    return path


def encode(docs: DataFrame, id: str, text: str, vocabulary: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS, limit: int = LEXICON_WORDS) -> DataFrame:
    """Columns id (renamed doc_id) and ids (array<int>), one row for each row of ``docs``, without special tokens.

    ``vocabulary`` is a rank file (``<name>.tiktoken``) in the folder ``tokenizers``. Null and empty texts give an
    empty list. White space is text. Strings that look like special tokens are ordinary text. Words of any length, and
    repeated or null ids, are kept as they are. An empty table gives no rows.
    """
    ranks = os.path.join(tokenizers, f"{vocabulary}.tiktoken")
    merger = Merger(ranks)
    path = _store(docs.sparkSession, to_bytes(compile_lexicon({w: merger.ids(w.encode()) for w in frequent_words(docs, text, limit)})))

    def run(batches):
        lexicon = open_lexicon(path)
        start, table = lexicon["start"], lexicon["ids"]
        exact, kept = None, {}
        for batch in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            flat, ends = array("i"), [0]
            texts = [words_of(t) if t else () for t in batch.column(1).to_pylist()]
            fresh = [w for w in set(chain.from_iterable(texts)) if w not in kept]
            short = [w for w in fresh if len(w) <= LONGEST]
            for w, i in zip(short, look_up(lexicon, short).tolist()):
                if i >= 0:
                    kept[w] = table[start[i] : start[i + 1]].tolist()
            for w in fresh:
                if w not in kept:
                    exact = exact or Merger(ranks)
                    kept[w] = exact.ids(w.encode())
            for words in texts:
                flat.extend(chain.from_iterable(map(kept.__getitem__, words)))
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])
            if len(kept) > KEPT_WORDS:
                kept.clear()
            else:
                for w in fresh:
                    if len(w) > LONGEST:
                        kept.pop(w, None)

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(F.col(id), F.col(text).cast("string")).mapInArrow(run, f"doc_id {kind}, ids array<int>")

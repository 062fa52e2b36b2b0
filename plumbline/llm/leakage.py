"""Evaluation texts leaking into training text, by a distributed positional inverted index.

The corpus is indexed in shards of documents, and the postings are stored: for each term of the test items the sorted
list of its positions. An item's lists are shifted by the terms' places in it; taking the rarest terms of every few
words, places where several shifted lists meet are alignments, and these are read word by word from the postings, with
room for altered, lost or added words. Nothing is shuffled but list lengths and results. Only the test items, in blocks
of checked size, go to all executors.
"""

from __future__ import annotations

import html
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import written

#: Words of a reproduced stretch: between the twelve that are none and the eighteen that are one.
STRETCH = 16
#: What may differ in such a stretch: a foreign word (an altered word, a misspelling) counts 1, another word of the
#: items or another number, as sentences of the same pattern have them, counts 2.
DIFFERENCES = 3
#: Item words per segment, of which SEEDS rarest terms open alignments. However the segments lie, sixteen words hold at
#: least six seeds (three in each whole segment; of five words of one at least two, of four at least one), so that after
#: DIFFERENCES at least MEETING of them still meet.
SEGMENT, SEEDS, MEETING = 6, 3, 3
#: Places that an alignment may slip, where words were split, joined, lost or added.
SLIP = 2
#: Words of test items that are sought at once (a block; a piece counts as LEAST_WORDS at least), and of a piece of a
#: long item: bounds what is sent to the executors and the table of a block's words.
BLOCK_WORDS, PIECE_WORDS, LEAST_WORDS = 200_000, 256, 64
#: Characters of a shard; alignments that are read at once.
SHARD_CHARS, ALIGNMENTS = 4_000_000, 50_000

_TAG = re.compile(r"</?[A-Za-z!][^<>]{0,200}>")
_HYPHEN = re.compile(rb"-[ \t]*\r?\n[ \t>]*")
_TABLE = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256)).lower()
_DROPPED = re.compile("[\u00ad\u0300-\u036f\u200b-\u200f\u2060\ufeff]+")
_DASH, _QUOTE, _OTHER = re.compile("[\u2010\u2011]"), re.compile("[\u2019\u02bc]"), re.compile(r"[^\w\n>'-]+")


def terms_of(text: str) -> list[bytes]:
    """Words in lower case without accents, markup, hyphens and apostrophes; a hyphen at a line end joins its halves."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub("", text)
    if not text.isascii():
        text = _DASH.sub("-", _QUOTE.sub("'", _DROPPED.sub("", unicodedata.normalize("NFKD", text).lower())))
        text = _OTHER.sub(" ", text)
    raw = text.encode()
    if b"-\n" in raw or b"-\r" in raw or b"- \n" in raw:
        raw = _HYPHEN.sub(b"", raw)
    return raw.translate(_TABLE, b"-'").split()


class Vocabulary(dict):
    """Terms of the items; other numbers share one more, other words are -1."""

    def __missing__(self, word: bytes) -> int:
        return len(self) if word.isdigit() else -1


def _index(vocabulary: Vocabulary):
    """(id, text) -> one row per shard: ids, starts of the documents, list bounds and positions of all terms."""
    gap = 2 * SLIP + 2

    def shard(ids, streams):
        sizes = np.fromiter((len(s) + gap for s in streams), np.int64, len(streams))
        flat = np.full(int(sizes.sum()), -1, np.int32)
        starts = np.cumsum(sizes) - sizes
        for at, s in zip(starts.tolist(), streams):
            flat[at : at + len(s)] = s
        at = np.flatnonzero(flat >= 0)
        order = np.argsort(flat[at], kind="stable")
        positions = at[order]
        bounds = np.searchsorted(flat[positions], np.arange(len(vocabulary) + 2))
        packed = pa.compress(np.diff(positions, prepend=0).astype(np.int32).tobytes(), codec="zstd", asbytes=True)
        values = [[ids], [starts], [bounds], [len(positions)], [int(len(flat))], [packed]]
        kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["ids", "starts", "bounds", "postings", "size", "packed"])

    def run(batches):
        ids, streams, chars = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i is None or not text:
                    continue
                if streams and chars + len(text) > SHARD_CHARS:
                    yield shard(ids, streams)
                    ids, streams, chars = [], [], 0
                ids.append(i)
                streams.append(np.fromiter(map(vocabulary.__getitem__, terms_of(text)), np.int32))
                chars += len(text)
        if streams:
            yield shard(ids, streams)

    return run


def _lengths(batches):
    """List length of each term, summed over the shards of a partition."""
    total = None
    for batch in batches:
        for b in batch.column(0):
            n = np.diff(b.values.to_numpy())
            total = n if total is None else total + n
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["term", "n"])


def pieces_of(terms: list[int]) -> list[list[int]]:
    """A long item as pieces that overlap by twice a stretch, so that each stretch lies whole in one of them; the last
    piece takes in what would be too short for one of its own."""
    step = PIECE_WORDS - 2 * STRETCH
    starts = range(0, max(1, len(terms) - 2 * STRETCH), step)
    return [terms[a : a + PIECE_WORDS] if a != starts[-1] else terms[a:] for a in starts]


class Items:
    """A block of items as term numbers, with the seeds of each."""

    def __init__(self, ids: list[int], terms: list[list[int]], lengths: np.ndarray):
        self.ids = np.array(ids, np.int64)
        self.sizes = np.array([len(t) for t in terms], np.int64)
        self.grid = np.full((len(terms), int(self.sizes.max(initial=1))), -2, np.int32)
        seeds = []
        for i, t in enumerate(terms):
            self.grid[i, : len(t)] = t
            for lo in range(0, len(t), SEGMENT):
                seeds += [(i, t[p], p) for p in sorted(range(lo, min(lo + SEGMENT, len(t))), key=lambda p: (lengths[t[p]], p))[:SEEDS]]
        self.item, self.term, self.place = (np.array(x, np.int64) for x in (zip(*seeds) if seeds else ((), (), ())))


def align(positions: np.ndarray, bounds: np.ndarray, size: int, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Position in the shard and item number of reproduced stretches."""
    flat = np.full(size, -1, np.int32)
    flat[positions] = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    width = items.grid.shape[1]
    span = size + 2 * width
    n_all = bounds[items.term + 1] - bounds[items.term]
    work = np.cumsum(n_all)
    out_at, out_item, start = [], [], 0
    while start < len(items.item):
        stop = int(np.searchsorted(work, (work[start - 1] if start else 0) + 1_000_000, side="right"))
        stop = int(np.searchsorted(items.item, items.item[max(stop, start + 1) - 1], side="right"))  # whole items
        n = n_all[start:stop]
        seed = np.repeat(np.arange(start, stop), n)
        within = np.arange(len(seed)) - np.repeat(np.cumsum(n) - n, n)
        place, item = items.place[seed], items.item[seed]
        shift = positions[bounds[items.term[seed]] + within] - place
        start = stop
        found = []
        for offset in (0, SLIP):  # two overlapping bands, so that seeds that slip meet in one of them
            band = (shift + offset + width) // (2 * SLIP)
            group = item * (span // SLIP + 4) + band
            o = np.lexsort((place, group))
            g, p = group[o], place[o]
            meet = np.flatnonzero((g[MEETING - 1 :] == g[: len(g) - MEETING + 1]) & (p[MEETING - 1 :] - p[: len(p) - MEETING + 1] < STRETCH))
            found += [((item[o[meet + j]] * span + shift[o[meet + j]] + width) << 8) + (place[o[meet]] >> 3) for j in range(MEETING)]
        cand = np.unique(np.concatenate(found))
        for a in range(0, len(cand), ALIGNMENTS):
            part = cand[a : a + ALIGNMENTS]
            i, s = np.divmod(part >> 8, span)
            at, good = _stretches(flat, items, i, s - width, (part & 0xFF) << 3)
            out_at.append(at)
            out_item.append(i[good])
    none = np.empty(0, np.int64)
    return (np.concatenate(out_at), np.concatenate(out_item)) if out_at else (none, none)


def _stretches(flat: np.ndarray, items: Items, item: np.ndarray, shift: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which alignments hold a stretch near ``place``. A word agrees if the document has it at the alignment or,
    together with a neighbour, up to SLIP places beside it."""
    p = place[:, None] + np.arange(-STRETCH, 2 * STRETCH + 8)
    real = (p >= 0) & (p < items.sizes[item][:, None])
    want = np.where(real, items.grid[item[:, None], np.clip(p, 0, items.grid.shape[1] - 1)], -2)
    at = shift[:, None] + p
    hit = np.zeros(want.shape, bool)
    for slip in range(-SLIP, SLIP + 1):
        same = (flat[np.clip(at + slip, 0, len(flat) - 1)] == want) & (at + slip >= 0)
        if slip:
            pair = same[:, 1:] & same[:, :-1]
            same[:] = False
            same[:, 1:] |= pair
            same[:, :-1] |= pair
        else:
            there = flat[np.clip(at, 0, len(flat) - 1)] >= 0
        hit |= same
    cost = np.where(hit, 0, np.where(real, 1 + there, 99)).astype(np.int32)
    total = np.zeros((len(item), cost.shape[1] + 1), np.int32)
    np.cumsum(cost, axis=1, out=total[:, 1:])
    window = np.minimum(STRETCH, np.maximum(items.sizes[item], 1))
    good, where = np.zeros(len(item), bool), np.zeros(len(item), np.int64)
    for w in np.unique(window):
        rows = np.flatnonzero(window == w)
        sums = total[rows, w:] - total[rows, :-w]
        best = sums.argmin(axis=1)
        allowed = DIFFERENCES if w == STRETCH else w // 6
        good[rows] = sums[np.arange(len(rows)), best] <= allowed
        where[rows] = at[rows, np.minimum(best + w // 2, at.shape[1] - 1)]
    keep = np.flatnonzero(good)
    return where[keep], keep


def find_leaks(docs: DataFrame, items: DataFrame, id: str, text: str, item_id: str, item_text: str) -> DataFrame:
    """Columns doc_id and item_id (bigint), one row for each document and each item of which it holds a stretch of
    STRETCH words, or the whole of a shorter item, whatever the case, punctuation, spacing, line breaks or markup, with
    single words altered.

    Null, empty and blank texts and items match nothing, nor do rows without an id. Repeated items, or documents with
    different ids, are all reported; repeated rows once. Empty tables give no rows. Documents are read whole.
    """
    rows = items.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).cast("string").alias("t")).where("i is not null and t is not null")
    vocabulary, blocks, words = Vocabulary(), [[]], 0
    for r in rows.distinct().orderBy("i", "t").toLocalIterator():
        terms = []
        for w in terms_of(r.t):
            if w not in vocabulary:
                vocabulary[w] = len(vocabulary)
            terms.append(vocabulary[w])
        for piece in pieces_of(terms) if terms else ():
            size = max(LEAST_WORDS, len(piece))
            if words + size > BLOCK_WORDS and blocks[-1]:
                blocks.append([])
                words = 0
            blocks[-1].append((r.i, piece))
            words += size
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    index = "ids array<long>, starts array<long>, bounds array<long>, postings long, size long, packed binary"
    stored = written(texts.mapInArrow(_index(vocabulary), index), "postings")
    lengths = np.zeros(len(vocabulary) + 1, np.int64)
    for r in stored.select("bounds").mapInArrow(_lengths, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        lengths[r.term] = r.n  # a row for each word of the items

    def search(block):
        def run(batches):
            queries = Items([i for i, _ in block], [t for _, t in block], lengths)
            for one in (b.slice(k, 1) for b in batches for k in range(b.num_rows)):
                ids, starts, bounds = (one.column(c)[0].values.to_numpy() for c in ("ids", "starts", "bounds"))
                raw = pa.decompress(one.column("packed")[0].as_buffer(), one.column("postings")[0].as_py() * 4, codec="zstd", asbytes=True)
                at, item = align(np.cumsum(np.frombuffer(raw, np.int32), dtype=np.int64), bounds, one.column("size")[0].as_py(), queries)
                doc = np.maximum(np.searchsorted(starts, at, side="right") - 1, 0)
                pairs = np.unique(np.stack([ids[doc], queries.ids[item]]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["doc_id", "item_id"])

        return run

    found = None
    for block in blocks:
        one = stored.mapInArrow(search(block), "doc_id long, item_id long")
        found = one if found is None else found.unionByName(one)
    return found.distinct()

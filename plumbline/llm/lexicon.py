"""Words of names: how they are read, how a word is mistyped or shortened, and what a typed word stands for.

No grammar of names: a name is a list of words and numbers. ``channel`` is the log likelihood of one word typed for
another, ``Channel`` that of a whole name typed for another, with rates of words left out and put in that are counted
over names whose record is known.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import shuffled, written

#: Words (and runs of words that are cut to their initials) in at least this share of the official names are common:
#: at most the words of an average name divided by it, so they fit into every task whatever the number of names.
COMMON_SHARE = 0.01
#: Log rate of a word left out or put in that nobody was ever seen to leave out or put in; weight of that belief.
NEVER, BELIEF = -6.0, 4.0
#: Weight of the words' log likelihoods: of an office that nobody knows, words are shortened and mistyped too.
WORDS = 0.6

# Words without content, levels of government, number words and signs.
EMPTY = frozenset("the of and for on a an in at".split())
LEVELS = frozenset("city town village county borough township hamlet state".split())
NUMBERS = {"i": "1", "ii": "2", "iii": "3", "iv": "4", "v": "5", "vi": "6", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "first": "1", "second": "2", "third": "3"}
_OF = {"t": "town of", "v": "village of", "c": "city of"}
_ALSO = {"town": ("township", "twp"), "borough": ("boro",), "department": ("dept",), "corporation": ("corp",)}
_NUMBER_SIGN = frozenset("no nr num number nbr".split())
_NONE = -99.0


def words_of(name: str) -> list[str]:
    """Words in lower case without accents; '&' and '/' are 'and', apostrophes and dots inside words vanish, and a
    bracket of one short word is left out unless it names a level."""
    text = re.sub(r"(?<=[a-z]{2})(?=[A-Z][a-z])", " ", unicodedata.normalize("NFKD", name))
    text = "".join(c for c in text if not unicodedata.combining(c) and not 0x200B <= ord(c) <= 0x200F and c not in "­⁠﻿").lower()
    text = re.sub(r"[(\[]\s*([a-z.]{1,7}|[a-z]{2,7}\d{1,3})\s*[)\]]", lambda m: f" {m.group(1)} " if any(channel(m.group(1).strip("."), v) > -4 for v in LEVELS) else " ", text)
    text = re.sub(r"(?<![a-z])([tvc])/o(?![a-z])", lambda m: _OF[m.group(1)], text)
    text = re.sub(r"[’'`´]|(?<=[^\W\d_]),(?=[^\W\d_]{1,2}\b)", "", text)
    text = re.sub(r"#", " no ", text)
    text = re.sub(r"(?<=\w)\s*[&/]\s*(?=\w)", " and ", text)
    text = re.sub(r"(?<![^\W\d_])[^\W\d_](?:\.+[^\W\d_])+\.*(?![^\W\d_])", lambda m: f" {m.group(0).replace('.', '')} ", text)
    text = re.sub(r"(?<=[^\W\d_])(?=\d)|(?<=\d)(?=[^\W\d_])", " ", text)
    return re.findall(r"[^\W\d_]+|\d+", text)


def read(name: str) -> list[str]:
    """Words with numbers in digits and without number signs; empty words stay. Parts between ' ; ' are read apart."""
    if " ; " in name:
        return [w for part in name.split(" ; ") for w in read(part)]
    words, out = words_of(name), []
    for k, w in enumerate(words):
        if w.isdigit():
            out.append(w.lstrip("0") or "0")
        elif w in NUMBERS and k and (len(w) > 1 or k == len(words) - 1 or words[k + 1] in EMPTY):
            out.append(NUMBERS[w])
        elif not (w in _NUMBER_SIGN and k + 1 < len(words) and (words[k + 1].isdigit() or words[k + 1] in NUMBERS)):
            out.append(w)
    return out


def content(name: str) -> list[str]:
    return [w for w in read(name) if w not in EMPTY]


def one_edit(a: str, b: str) -> bool:
    """Damerau distance of at most one."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    ra, rb = a[i:], b[i:]
    return ra[1:] == rb[1:] or ra[1:] == rb or ra == rb[1:] or (len(ra) == len(rb) and len(ra) > 1 and ra[0] == rb[1] and ra[1] == rb[0] and ra[2:] == rb[2:])


def distance(a: str, b: str, most: int = 3) -> int:
    """Damerau distance (adjacent swaps count one), or most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if two and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, two[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


@lru_cache(maxsize=1 << 18)
def channel(typed: str, word: str) -> float:
    """Log likelihood that ``word`` is typed like this: copied, cut off, contracted, or with one or two edits."""
    if typed == word:
        return 0.0
    if not typed or not word or typed.isdigit() or word.isdigit():
        return _NONE
    n = len(typed)
    for other in _ALSO.get(word, ()):
        if typed == other or (n >= 5 and one_edit(typed, other)):
            return -0.5 if typed == other else -3.0
    if typed[0] == word[0] and n < len(word):
        if word.startswith(typed):
            return -1.0 if n >= 3 else -2.0 if n == 2 else -2.5
        it = iter(word)
        if n >= 2 and n <= 0.8 * len(word) and all(c in it for c in typed):
            return (-1.5 if n >= 3 else -2.5) - (typed[-1] != word[-1])
    if n >= 3 and len(word) >= 4 and one_edit(typed, word):
        return -2.5
    if n >= 6 and len(word) >= 6 and distance(typed, word, 2) <= 2:
        return -5.0
    if n >= 4 and n < len(word) and any(one_edit(typed, word[:k]) for k in (n - 1, n, n + 1)):
        return -4.0
    return _NONE


def initials_of(words: list[str]) -> dict[str, tuple[int, int]]:
    """Initials of every run of two to six words, with and without its empty words: where the run starts and ends."""
    out: dict[str, tuple[int, int]] = {}
    for i in range(len(words)):
        for j in range(i + 2, min(len(words), i + 6) + 1):
            run = words[i:j]
            if run[0] in EMPTY or run[-1] in EMPTY or any(w.isdigit() for w in run):
                continue
            out.setdefault("".join(w[0] for w in run), (i, j))
            out.setdefault("".join(w[0] for w in run if w not in EMPTY), (i, j))
    return {k: v for k, v in out.items() if len(k) > 1}


class Channel:
    """Log likelihood of a name typed for an official one. ``left_out`` and ``put_in``: log rates of words."""

    def __init__(self, left_out: dict[str, float] | None = None, put_in: dict[str, float] | None = None):
        self.left_out, self.put_in = left_out or {}, put_in or {}

    def cost_out(self, w: str) -> float:
        return self.left_out.get(w, NEVER)

    def cost_in(self, w: str) -> float:
        return self.put_in.get(w, NEVER)

    def score(self, typed: list[str], name: list[str]) -> float:
        """``typed`` without its empty words, ``name`` with them."""
        return self.align(typed, name)[0]

    def align(self, typed: list[str], name: list[str]) -> tuple[float, list[str], list[str]]:
        """Likelihood, words of the name that were left out, typed words that were put in: the best of reading each
        typed word as a word, or one of them as the initials of a run."""
        best = self._words(typed, [w for w in name if w not in EMPTY])
        if best[0] == 0.0:
            return best
        runs = initials_of(name)
        for k, t in enumerate(typed):
            for drop in (0, 1) if len(t) > 2 else (0,):
                at = runs.get(t[drop:])
                if not at or (drop and not any(w[0] == t[0] for w in name[: at[0]] + name[at[1] :])):
                    continue
                s, out, put = self._words(typed[:k] + typed[k + 1 :], [w for w in name[: at[0]] + name[at[1] :] if w not in EMPTY])
                s += WORDS * (-1.5 - drop)
                if s > best[0]:
                    best = (s, out, put)
        return best

    def _words(self, typed: list[str], name: list[str]) -> tuple[float, list[str], list[str]]:
        pairs = sorted(((c, -i, -j) for i, w in enumerate(typed) for j, x in enumerate(name) if (c := channel(w, x)) > -6), reverse=True)
        used_t, used_n, total = set(), set(), 0.0
        for c, i, j in pairs:
            if -i not in used_t and -j not in used_n:
                used_t.add(-i)
                used_n.add(-j)
                total += WORDS * c
        rest_t = [i for i in range(len(typed)) if i not in used_t]
        rest_n = [j for j in range(len(name)) if j not in used_n]
        for i in rest_t[:]:  # two words typed as one
            for j in rest_n:
                if j + 1 in rest_n and (c := channel(typed[i], name[j] + name[j + 1])) > -4:
                    total += WORDS * (c - 1.5)
                    rest_t.remove(i)
                    rest_n.remove(j)
                    rest_n.remove(j + 1)
                    break
        for j in rest_n[:]:  # one word typed as two
            for i in rest_t:
                if i + 1 in rest_t and (c := channel(typed[i] + typed[i + 1], name[j])) > -4:
                    total += WORDS * (c - 1.5)
                    rest_n.remove(j)
                    rest_t.remove(i)
                    rest_t.remove(i + 1)
                    break
        out, put = [name[j] for j in rest_n], [typed[i] for i in rest_t]
        return total + sum(map(self.cost_out, out)) + sum(map(self.cost_in, put)), out, put


def fit_channel(pairs: list[tuple[str, str]]) -> Channel:
    """Rates of words left out and put in, counted over (typed, official) names; rare words keep NEVER."""
    import math
    from collections import Counter

    plain = Channel()
    out_n, in_n, had, typed_n = Counter(), Counter(), Counter(), Counter()
    for typed, name in pairs:
        t, full = content(typed), read(name)
        score, out, put = plain.align(t, full)
        n = [w for w in full if w not in EMPTY]
        if len(out) + len(put) > max(1, len(n) // 2) or not t:
            continue  # another office: wrong labels must not teach
        had.update(n)
        typed_n.update(t)
        out_n.update(out)
        in_n.update(put)
    rate = lambda k, n: math.log((k + BELIEF * math.exp(NEVER)) / (n + BELIEF))
    return Channel({w: rate(k, had[w]) for w, k in out_n.items()}, {w: rate(k, typed_n[w]) for w, k in in_n.items()})


def _deletions(w: str, most: int) -> set[str]:
    out = {w}
    for _ in range(most):
        out |= {x[:i] + x[i + 1 :] for x in out for i in range(len(x))}
    return out


def typed_marks(w: str) -> list[str]:
    """Marks that a typed word shares with every word that it is one edit (two from seven letters on) or a cut away from."""
    marks = {f"d{x}" for x in _deletions(w, 2 if len(w) >= 7 else 1)} if len(w) >= 4 else {f"d{w}"}
    return sorted(marks | {f"p{w}"}) if len(w) >= 4 else sorted(marks)


def word_marks(w: str) -> list[str]:
    marks = {f"d{x}" for x in _deletions(w, 2 if len(w) >= 7 else 1)} if len(w) >= 4 else {f"d{w}"}
    return sorted(marks | {f"p{w[:k]}" for k in range(4, len(w))})


def name_words(rows: DataFrame, name: str, key: str = "name") -> DataFrame:
    """Distinct names with their words (empty ones included): ``key``, words."""

    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "words": [read(n) for n in pdf[key]]})

    distinct = rows.select(F.col(name).alias(key)).where(f"{key} is not null and trim({key}) <> ''").distinct()
    # few bytes, but much work for each: not to be gathered into few tasks
    distinct = distinct.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return written(distinct.mapInPandas(run, f"{key} string, words array<string>"), "name_words")


class Common:
    """Common words and runs of the official names, by which typed words are read without any join. ``company``: how
    many names hold both of two common words (a word with itself: how many hold it)."""

    def __init__(self, words: list[str], runs: list[str], company: dict[tuple[str, str], int] | None = None):
        self.words, self.company = words, company or {}
        self.runs: dict[str, list[str]] = {}
        for r in runs:
            parts = r.split(" ")
            for k in {"".join(w[0] for w in parts), "".join(w[0] for w in parts if w not in EMPTY)}:
                if len(k) > 1:
                    self.runs.setdefault(k, []).append(" ".join(w for w in parts if w not in EMPTY))
        self.known = frozenset(words)
        self._seen: dict[str, list[tuple[str, float]]] = {}
        self.friends: dict[str, set[str]] = {}
        for (a, b), n in self.company.items():
            for w, x in ((a, b), (b, a)):
                if a != b and n >= 0.2 * self.company[w, w]:
                    self.friends.setdefault(w, set()).add(x)

    def stands_for(self, typed: str) -> list[tuple[str, float]]:
        """Common words (or runs, by their initials) that a typed word may stand for, with log likelihoods."""
        if typed in self.known or typed.isdigit():
            return [(typed, 0.0)]
        if typed in self._seen:
            return self._seen[typed]
        if len(self._seen) > 1 << 17:
            self._seen.clear()
        out = [(w, c) for w in self.words if (c := channel(typed, w)) > -4.5]
        out += [(r, -1.5) for r in dict.fromkeys(self.runs.get(typed, ()))]
        self._seen[typed] = out
        return out

    def after_letter(self, typed: str, rest: list[str]) -> list[tuple[str, float]]:
        """Runs by their initials after the first letter of another word, as of the place."""
        if len(typed) < 3 or typed in self.known or not any(x[0] == typed[0] for x in rest):
            return []
        return [(r, -2.5) for r in dict.fromkeys(self.runs.get(typed[1:], ()))]

    def suits(self, reading: str, rest: set[str], sure: set[str]) -> float:
        """Log likelihood that a reading stands among words that may be ``rest`` and are ``sure``: words that always
        have some of certain company seldom stand alone, and words that no name holds together seldom meet."""
        own, total = set(reading.split(" ")), 0.0
        for w in own & self.known:
            friends = self.friends.get(w)
            if friends and not friends & (rest | own):
                total -= 4.0
            total -= sum(self.company.get((min(w, x), max(w, x)), 0) == 0 for x in (sure & self.known) - own)
        return total


def learn_common(official: DataFrame) -> Common:
    """Common words and common runs of two to six words of ``official(words)``, in a share of at least COMMON_SHARE of
    the names each, and which common words are met together. A run that holds no common end can't be common, so only runs of common words are counted."""
    n = official.count()
    least = max(1.0, COMMON_SHARE * n)
    count = official.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    words = sorted(r.w for r in count.collect())
    known = frozenset(words)

    @F.pandas_udf("array<string>")
    def runs(names: pd.Series) -> pd.Series:
        def one(ws):
            out = set()
            for i, a in enumerate(ws):
                for j in range(i + 2, min(len(ws), i + 6) + 1):
                    if ws[j - 1] not in known:
                        break
                    if a in known and a not in EMPTY and ws[j - 1] not in EMPTY and not any(w.isdigit() for w in ws[i:j]):
                        out.add(" ".join(ws[i:j]))
            return sorted(out)

        return pd.Series([one(list(ws)) for ws in names], dtype=object)

    counted = official.select(F.explode(runs("words")).alias("r")).groupBy("r").agg(F.count("*").alias("n")).where(F.col("n") >= least)

    @F.pandas_udf("array<string>")
    def pairs(names: pd.Series) -> pd.Series:
        return pd.Series([[f"{a} {b}" for a in sorted(k) for b in sorted(k) if a <= b] for k in (known.intersection(ws) - EMPTY for ws in names)], dtype=object)

    met = official.select(F.explode(pairs("words")).alias("p")).groupBy("p").agg(F.count("*").alias("n"))  # of common words only
    company = {tuple(r.p.split(" ")): r.n for r in met.collect()}
    return Common([w for w in words if w not in EMPTY], sorted(r.r for r in counted.collect()), company)


def rare_words(typed: DataFrame, words: DataFrame, cut: bool = True) -> DataFrame:
    """Distinct typed words against distinct words (both column ``w``): typed, word, cost. Both sides leave marks (the
    word with one or two letters left out; its beginnings), and only words with a mark in common are compared."""

    @F.pandas_udf("array<string>")
    def left_marks(ws: pd.Series) -> pd.Series:
        return pd.Series([typed_marks(w) for w in ws], dtype=object)

    @F.pandas_udf("array<string>")
    def right_marks(ws: pd.Series) -> pd.Series:
        return pd.Series([word_marks(w) for w in ws], dtype=object)

    @F.pandas_udf("double")
    def cost(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([channel(t, w) for t, w in zip(a, b)], dtype="float64")

    left = typed.select(F.col("w").alias("typed"), F.explode(left_marks("w")).alias("mark"))
    right = words.select(F.col("w").alias("word"), F.explode(right_marks("w")).alias("mark"))
    met = left.join(shuffled(right), "mark").select("typed", "word").distinct()
    return met.withColumn("cost", cost("typed", "word")).where("cost > -6")

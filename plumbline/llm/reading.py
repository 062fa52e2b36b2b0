"""Reading band of each English document.

Every sentence gets three classic grade estimates (Flesch-Kincaid, Linsear Write, McAlpine EFLAW) from its length and
from syllable counts by hyphenation-style rules. A document's grade by a formula is the median over its sentences,
weighted by their words, so that a few sentences of another level, or a passage from elsewhere, don't move it. Each
formula's grade falls into a band by cut points fitted on labelled rows, and the document's band is the median of the
three. (Formulas that weigh letters or syllables alone, such as Coleman-Liau, can't tell the two upper bands apart.)
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.session import written

#: Labelled documents that the cut points are fitted on, at most (lowest ids first).
LABELLED_DOCS = 5_000
#: Least words of English running text.
LEAST_WORDS = 50
FORMULAS = ("flesch_kincaid", "linsear", "eflaw")
#: Cut points of each formula where there are no labels of both sides: grades 7, 13 and 28 in each formula's own terms.
DEFAULT_CUTS = ((7.0, 13.0, 28.0), (7.0, 16.0, 33.0), (18.5, 30.5, 44.5))

# Function words of English, and of the languages it is told from.
ENGLISH = frozenset(
    "the of and to a in is it you that he was for on are with as his they be at one have this from or had by but what some we can out other were all your when up use how said an each she which do their time if will way about many then them would so these her him has more no there been who its now did get may our us after before not than shall such any my i under upon must should could into because while whether most only over where also nor those through between during please am".split()
)
FOREIGN = frozenset(
    "el los las del y que en un una por con para su al lo como más pero sus le ya este sí porque esta entre cuando muy sin sobre también hasta hay donde quien desde todo nos durante uno ni contra otros ese eso cada año se es la de les des et du au aux une est pour dans par sur pas plus avec ce cette sont qui ont ou leur ses nous vous il elle ne mais der die das und ist nicht ein eine von zu mit den dem auf für werden oder".split()
)
# Spellings in which an e is silent or vowels that stand together are two syllables.
_VOWELS = re.compile(r"[aeiouy]+")
_SILENT = re.compile(r"(?:[^laeiouy]e|[^tdaeiouy]ed|[^aeiouy]ely|[^aeiouylscgxz]es|eful|eless|ement)$")
_TWO = re.compile(r"crea(?!m|k|s)|ia(?!n?t|l)|i[ou](?!us|n)|eo(?!n)|ua(?!rd)|ue[nt]|[aeiouy]ing|io$|ius|uou|yo|iet|dnt$|sm$")

_TAG = re.compile(r"<[^<>]{0,300}>|https?://\S+|www\.\S+|\S+@\S+\.\S+")
_MARK = re.compile(r"^[\s#>*•\-–—·▪◦‣]*(?:\(?(?:\d{1,3}|[a-zA-Z]|[ivxIVX]{1,4})[.)]\s+)?[\s*_#]*")
_END = re.compile(r"(?<=[.!?])[\"'”’)\]*_]*\s+|(?<=;)\s+(?=[A-Z])")
_WORD = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+(?:['’-][A-Za-zÀ-ÖØ-öø-ÿ]+)*")


def syllables(word: str) -> int:
    """Vowel groups, less silent endings, plus hiatuses; one at least."""
    w = word.lower()
    n = 0
    for part in w.split("-"):
        k = len(_VOWELS.findall(part)) + len(_TWO.findall(part))
        if len(part) > 3 and _SILENT.search(part):
            k -= 1
        n += max(1, k)
    return n


def sentences(text: str) -> Iterator[str]:
    """Sentences of the text without markup and list marks. A line break ends a sentence, unless the next line goes on
    in lower case."""
    text = _TAG.sub(" ", html.unescape(text).replace("\r\n", "\n").replace("\r", "\n"))
    joined: list[str] = []
    for line in text.split("\n"):
        bare = _MARK.sub("", line, count=1).strip()
        if not bare:
            joined.append("")
        elif joined and joined[-1] and bare == line.strip() and bare[0].islower():
            joined[-1] += " " + bare
        else:
            joined.append(bare)
    for line in joined:
        yield from (s for s in _END.split(line) if s)


def grades(words: list[str], counted: dict[str, int]) -> tuple[float, float, float]:
    """One sentence by each of FORMULAS."""
    n = len(words)
    total = hard = short = 0
    for w in words:
        k = counted[w]
        total += k
        hard += k >= 3
        short += len(w) <= 3
    load = n + 2 * hard
    return 0.39 * n + 11.8 * total / n - 15.59, load / 2 if load > 20 else load / 2 - 1, float(n + short)


def measure(text: str | None, counted: dict[str, int]) -> tuple[float, float, float, int, bool]:
    """The document's grade by each formula, its number of words, and whether it is English running text."""
    rows, sizes, total, english, foreign = [], [], 0, 0, 0
    for s in sentences(text or ""):
        words = _WORD.findall(s.lower())
        total += len(words)
        for w in words:
            if w in ENGLISH:
                english += 1
            elif w in FOREIGN:
                foreign += 1
            if w not in counted:
                counted[w] = syllables(w)
        if len(words) >= 3:
            rows.append(grades(words, counted))
            sizes.append(len(words))
    if not rows:
        return 0.0, 0.0, 0.0, total, False
    out, half = [], sum(sizes) / 2
    for column in zip(*rows):
        seen = 0
        for value, size in sorted(zip(column, sizes)):
            seen += size
            if seen >= half:
                out.append(value)
                break
    return out[0], out[1], out[2], total, english >= 0.14 * total and foreign < 0.5 * english


def _measured(batches):
    counted: dict[str, int] = {}
    for batch in batches:
        rows = [measure(t, counted) for t in batch.column(1).to_pylist()]
        kinds = (pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.bool_())
        columns = list(zip(*rows)) or [()] * len(kinds)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["doc_id", *FORMULAS, "words", "english"])
        if len(counted) > 1_000_000:
            counted.clear()


def grade_documents(docs: DataFrame, id: str, text: str) -> DataFrame:
    """doc_id, a grade by each formula, words and english for every row; null and empty texts have 0 words and are not
    English. Whole texts are read. Ids are kept as they are, also repeated or null ones."""
    kind = docs.schema[id].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{f} double' for f in FORMULAS)}, words int, english boolean"
    return docs.select(F.col(id), F.col(text).cast("string")).mapInArrow(_measured, schema)


def fit_cuts(grade: np.ndarray, band: np.ndarray, default: tuple[float, ...]) -> list[float]:
    """For each pair of neighbouring bands the cut with the fewest labelled rows on its wrong side (of equal ones the
    middle); the default where only one side has labels. Cuts never fall."""
    cuts: list[float] = []
    for k, usual in enumerate(default, start=1):
        low, high = np.sort(grade[band <= k]), np.sort(grade[band > k])
        if len(low) and len(high):
            at = np.unique(grade)
            at = np.concatenate([at[:1], (at[1:] + at[:-1]) / 2])
            wrong = len(low) - np.searchsorted(low, at) + np.searchsorted(high, at)
            best = at[wrong == wrong.min()]
            usual = float(best[len(best) // 2])
        cuts.append(max([usual, *cuts]))
    return cuts


def reading_bands(docs: DataFrame, labels: DataFrame, id: str, text: str, least_words: int = LEAST_WORDS) -> DataFrame:
    """Columns doc_id and band (int, 1 to 4) of the documents that are English running text of ``least_words`` words.

    The language is judged by function words, whatever any column says. ``labels(doc_id, band)`` fits the cuts, with at
    most LABELLED_DOCS rows (lowest ids; null or contradicting labels are left out); without labels the defaults hold.
    An empty table gives no rows; a repeated id gives a row each time.
    """
    graded = written(grade_documents(docs, id, text), "grades")
    agreed = labels.where("doc_id is not null and band is not null").groupBy("doc_id").agg(F.min("band").alias("band"), F.max("band").alias("other"))
    known = agreed.where("band = other").join(graded.where("english"), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id").limit(LABELLED_DOCS)
    rows = known.select("band", *FORMULAS).collect()
    fitted = [fit_cuts(np.array([r[i + 1] for r in rows]), np.array([r[0] for r in rows]), DEFAULT_CUTS[i]) for i in range(len(FORMULAS))]
    votes = [sum((F.when(F.col(f) >= c, 1).otherwise(0) for c in cuts), F.lit(1)) for f, cuts in zip(FORMULAS, fitted)]
    middle = F.element_at(F.array_sort(F.array(*votes)), 2)
    return graded.where(F.col("english") & (F.col("words") >= least_words) & F.col("doc_id").isNotNull()).select("doc_id", middle.cast("int").alias("band"))

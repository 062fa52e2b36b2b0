"""Variant spellings of organisation names, attributed by a noisy channel to frequent spellings.

Candidate canonical forms are the official names and short names, and the spellings that are typed often for a known
record, ranked by how often they are seen. A typed spelling meets those candidates that hold what its rarest word may
stand for (typing errors, cut and contracted words, initials), and each is weighed by its frequency and by the
likelihood of the whole spelling: words copied, mistyped, shortened, moved, left out or put in. The spelling is attached
to the record of greatest posterior, an office that nobody knows being one of the rivals.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm import lexicon
from plumbline.llm.lexicon import EMPTY, NEVER, Channel, Common
from plumbline.session import shuffled, written

#: Rows that a typed spelling needs to be a canonical form beside the official ones.
FREQUENT = 2
#: Log weight of an office that nobody knows; least posterior of a link. Words that together cost more than the
#: former can't all stay unread.
UNKNOWN, LEAST_POSTERIOR = -5.0, 0.5
#: Labelled rows (typed name, record) by which rates of words left out and put in are fitted, at most.
LABELLED = 5_000


def canonical_forms(registry: DataFrame, known: DataFrame, typed: DataFrame, id: str, names: list[str], name: str, known_id: str) -> DataFrame:
    """form, id, share (of the form's uses that mean this record), seen (rows that are spelled like this, and records
    that are named like this): official spellings, and those typed for known records FREQUENT times or more."""
    each = [registry.select(F.col(id).alias("id"), F.col(n).alias("form")) for n in names]
    official = each[0]
    for e in each[1:]:
        official = official.unionByName(e)
    official = official.where("id is not null and trim(form) <> ''").distinct().withColumn("official", F.lit(1))
    ids = registry.select(F.col(id).alias("id")).distinct()
    meant = known.select(F.lower(F.trim(known_id)).alias("id"), F.col(name).alias("form")).where("id is not null and trim(form) <> ''").join(shuffled(ids), "id", "left_semi")
    often = meant.groupBy("form", "id").agg(F.count("*").alias("n")).where(F.col("n") >= FREQUENT)
    uses = official.unionByName(often.select("id", "form", F.lit(0).alias("official"))).groupBy("form", "id").agg(F.max("official").alias("official"))
    uses = uses.join(shuffled(meant.groupBy("form", "id").agg(F.count("*").alias("n"))), ["form", "id"], "left").withColumn("uses", F.coalesce("n", F.lit(0)) + F.col("official"))
    rows = typed.select(F.col(name).alias("form")).groupBy("form").agg(F.count("*").alias("rows"))
    total = uses.groupBy("form").agg(F.sum("uses").alias("all"), F.max("official").alias("o"))
    shared = uses.join(shuffled(total), "form").join(shuffled(rows), "form", "left")
    return shared.select("form", "id", (F.col("uses") / F.col("all")).alias("share"), (F.coalesce("rows", F.lit(0)) + F.col("o")).alias("seen"))


def labelled_pairs(known: DataFrame, registry: DataFrame, name: str, known_id: str, id: str, reg_name: str) -> list[tuple[str, str]]:
    """At most LABELLED distinct pairs (typed name, official name of the record that the row says it means)."""
    official = registry.select(F.col(id).alias("id"), F.col(reg_name).alias("official")).where("trim(official) <> ''")
    pairs = known.select(F.lower(F.trim(known_id)).alias("id"), F.col(name).alias("typed")).where("trim(typed) <> ''").join(shuffled(official), "id").select("typed", "official").distinct()
    # cut to the limit in an executor: collect() alone would send that many rows of every task to the driver
    return [tuple(r) for r in written(pairs.orderBy(F.xxhash64("typed", "official"), "typed", "official").limit(LABELLED), "labelled").collect()]


def _keys(words: DataFrame) -> DataFrame:
    """Every key under which a spelling can be met: its words, initials of its runs, neighbours written as one."""

    @F.pandas_udf("array<string>")
    def keys(names: pd.Series) -> pd.Series:
        def one(ws):
            ws = list(ws)
            plain = [w for w in ws if w not in EMPTY]
            return sorted({*plain, *(f"{k}." for k in lexicon.initials_of(ws)), *(f"{a}{b}+" for a, b in zip(plain, plain[1:]))})

        return pd.Series([one(ws) for ws in names], dtype=object)

    return words.select("form", F.explode(keys("words")).alias("key"))


def meet(typed: DataFrame, forms: DataFrame, common: Common, model: Channel) -> DataFrame:
    """Pairs (name, words, form, form_words) that can be worth more than UNKNOWN: of each typed name those words are
    taken, those with the shortest lists first, that can't all stay unread, and every form that holds a reading of one
    of them is met. ``typed(name, words)``, ``forms(form, words)``."""
    lists = written(_keys(forms), "form_keys")
    known = lists.groupBy("key").agg(F.count("*").alias("rows"))

    @F.pandas_udf("array<struct<w:string,cost:double>>")
    def unread(names: pd.Series) -> pd.Series:
        return pd.Series([[(w, model.cost_in(w)) for w in dict.fromkeys(x for x in ws if x not in EMPTY)] for ws in names], dtype=object)

    asked = written(typed.select("name", F.explode(unread("words")).alias("u")).select("name", F.col("u.w").alias("w"), F.col("u.cost").alias("cost")), "asked")
    distinct = written(asked.select("w").distinct(), "typed_words")

    @F.pandas_udf("array<string>")
    def usual(ws: pd.Series) -> pd.Series:
        return pd.Series([[w, f"{w}.", f"{w[1:]}.", f"{w}+", *(r for r, _ in common.stands_for(w) if " " not in r)] for w in ws], dtype=object)

    rare = lexicon.rare_words(distinct.where("not w rlike '^[0-9]+$'"), known.where("not key rlike '[0-9.+]'").select(F.col("key").alias("w")))
    # one word of a name that was typed as two is met by its beginning
    readings = distinct.select("w", F.explode(usual("w")).alias("key")).unionByName(rare.select(F.col("typed").alias("w"), F.col("word").alias("key"))).distinct()
    readings = written(readings.join(shuffled(known), "key"), "readings")
    length = readings.groupBy("w").agg(F.sum("rows").alias("length"))
    up = Window.partitionBy("name").orderBy("length", "w").rowsBetween(Window.unboundedPreceding, -1)  # the words of a name
    first = asked.join(shuffled(length), "w", "left").withColumn("length", F.coalesce("length", F.lit(0)))
    needed = first.withColumn("before", F.coalesce(F.sum("cost").over(up), F.lit(0.0))).where(F.col("before") >= UNKNOWN).where("length > 0")
    pairs = needed.select("name", "w").join(shuffled(readings.select("w", "key")), "w").join(shuffled(lists), "key").select("name", "form").distinct()
    return pairs.join(shuffled(typed), "name").join(shuffled(forms.select("form", F.col("words").alias("form_words"))), "form")


def link_variants(variants: DataFrame, known: DataFrame, registry: DataFrame, row_id: str, name: str, known_id: str, reg_id: str, reg_names: list[str], use_prior: bool = True) -> DataFrame:
    """Columns enrichment_id, entity_id, posterior: for each row of ``variants`` the official record that its name most
    probably means, if any reaches LEAST_POSTERIOR; at most one.

    ``reg_names``: columns with official spellings, the first being the full name. ``known`` rows (name and id of the
    record meant, some of them wrong) tell how often a spelling and a record are meant, and how words are left out or
    put in. Null, empty and blank names link to nothing. Records with equal spellings share their posterior and at a tie
    are left unlinked. Repeated rows give one result. Empty tables give no rows. Extra columns are ignored.
    """
    model = lexicon.fit_channel(labelled_pairs(known, registry, name, known_id, reg_id, reg_names[0]))
    both = variants.select(name).unionByName(known.select(name))
    forms = written(canonical_forms(registry, known, both, reg_id, reg_names, name, known_id), "forms")
    form_words = lexicon.name_words(forms, "form", "form")
    official = registry.select(F.col(reg_names[0]).alias("form")).distinct().join(shuffled(form_words), "form")
    common = lexicon.learn_common(official)
    typed = lexicon.name_words(variants, name)
    pairs = meet(typed, form_words, common, model)

    def score(batches):
        for pdf in batches:
            each = [model.score([w for w in t if w not in EMPTY], list(f)) for t, f in zip(pdf["words"], pdf["form_words"])]
            yield pd.DataFrame({"name": pdf["name"], "form": pdf["form"], "ll": each})

    wide = int(variants.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scored = pairs.repartition(wide, "name", "form").mapInPandas(score, "name string, form string, ll double").where(F.col("ll") > UNKNOWN + NEVER)
    scored = written(scored, "scored")
    # how often a record is meant at all, and how often by this spelling
    counts = known.select(F.lower(F.trim(known_id)).alias("id")).where("id is not null").groupBy("id").agg(F.count("*").alias("meant"))
    prior = (F.log1p(F.coalesce("meant", F.lit(0))) + F.log1p("seen")) / 4 if use_prior else F.lit(0.0)
    weighed = scored.join(shuffled(forms), "form").join(shuffled(counts), "id", "left").withColumn("w", F.exp(F.col("ll") + prior) * F.col("share"))
    each = weighed.groupBy("name", "id").agg(F.max("w").alias("w"))
    total = each.groupBy("name").agg(F.sum("w").alias("all"), F.max_by(F.struct("id", "w"), F.struct("w", "id")).alias("best"))
    posterior = F.col("best.w") / (F.col("all") + F.exp(F.lit(UNKNOWN)))
    best = total.select("name", F.col("best.id").alias("entity_id"), posterior.alias("posterior")).where(F.col("posterior") > LEAST_POSTERIOR)
    rows = variants.select(F.col(row_id).alias("enrichment_id"), F.col(name).alias("name")).where("enrichment_id is not null").distinct()
    linked = rows.join(shuffled(best), "name").groupBy("enrichment_id").agg(F.max_by(F.struct("entity_id", "posterior"), F.struct("posterior", "entity_id")).alias("b"))
    return linked.select("enrichment_id", "b.entity_id", "b.posterior")

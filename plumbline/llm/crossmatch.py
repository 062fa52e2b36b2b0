"""Rows of two sources that describe the same office, without a common key.

Every row becomes a bag of terms from all its attributes: words of its name and of its cities, host, phone, street, zip.
A typed word stands for the frequent word that most probably was meant (noisy channel), so that spellings meet; nothing
knows which words are a place or a kind. Rows that say the same are one class. Terms are weighed by BM25 over an
inverted index of the classes; candidates come only from the terms without which a class can't come near its best score
(exact pruning). A pair must be mutually nearest, up to a tolerance, among the offices of either side; a logistic
calibration of score, gaps, words that only one name holds, and the stated confidence gives the pair's confidence, which
decides. An exact comparison of the numbers and words of both names follows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm import lexicon, names
from plumbline.llm.lexicon import EMPTY, NEVER, Channel
from plumbline.session import shuffled, written

K1, B = 1.2, 0.5
#: Share of a class's best score down to which candidates are looked at, and at which an office still is a nearest one.
NEAR, NEAREST = 0.7, 0.75
#: Labelled pairs for the calibration, at most, and its start values: bias, share of the possible score, gap on either
#: side, words that only one name holds (in units of NEVER), stated confidence.
LABELLED_PAIRS = 20_000
PRIOR = np.array([-2.0, 4.0, 3.0, 3.0, -4.0, 0.5])
LEAST_CONFIDENCE = 0.5
#: Log rate below which words that only one name holds speak for another office: if both names hold such words, and
#: else unless the rows share a host, phone or street.
FOREIGN = -3.0
#: Rows that a typed word needs to be a word of its own beside the official ones, and log prior of such a word; weight of
#: words that go together.
OWN_WORD, NEW_WORD, TOGETHER = 2, -1.5, 2.0

# Kinds of streets as written out and shortened, which addresses leave out or change at will.
_STREETS = "street st avenue ave road rd lane ln place pl plaza plz square sq terrace terr row way drive dr court ct boulevard blvd hill"


def host_of(c: Column) -> Column:
    h = F.regexp_replace(F.lower(F.trim(c)), r"^[a-z][a-z0-9+.-]*://", "")
    h = F.regexp_replace(F.regexp_replace(h, r"[/?#:].*$", ""), r"^www\d*\.|\.$", "")
    return F.when(h.rlike(r"^[a-z0-9-]+(\.[a-z0-9-]+)+$"), h)


def phone_of(c: Column) -> Column:
    d = F.regexp_replace(F.regexp_replace(F.lower(c), r"(ext|x|#).*$", ""), r"\D", "")
    d = F.regexp_replace(d, r"^1(?=\d{10}$)", "")
    return F.when(d.rlike(r"^\d{10}$") & ~d.rlike(r"^(\d)\1{9}$"), d)


def street_of(c: Column) -> Column:
    s = F.regexp_replace(F.lower(F.element_at(F.split(c, ","), 1)), r"[^a-z0-9 ]+", "")
    s = F.trim(F.regexp_replace(F.regexp_replace(s, rf"\b({_STREETS.replace(' ', '|')})\b", ""), r"\s+", " "))
    return F.when(s.rlike(r"^\d+ [a-z]"), s)


def zip_of(c: Column) -> Column:
    z = F.regexp_extract(c, r"(?<!\d)(\d{5})(?:-\d{4})?\s*$", 1)
    return F.when(z != "", z)


def _rows(df: DataFrame, side: int, id: Column, name: Column, sure: Column, cities: Column, hosts: Column, phones: Column, streets: Column, zips: Column) -> DataFrame:
    clean = lambda a: F.array_distinct(F.array_compact(F.coalesce(a, F.array().cast("array<string>"))))
    parts = {"cities": cities, "hosts": hosts, "phones": phones, "streets": streets, "zips": zips}
    one = df.select(F.lit(side).alias("side"), id.cast("long").alias("id"), F.struct(name.alias("name"), sure.cast("double").alias("sure"), *(clean(a).alias(n) for n, a in parts.items())).alias("r"))
    return one.where("id is not null")


def greenbook_rows(df: DataFrame) -> DataFrame:
    of = lambda kind: F.transform(F.filter("contact_details", lambda c: c["type"] == kind), lambda c: c["value"])
    address = of("address")
    city = F.transform(address, lambda a: F.trim(F.regexp_extract(a, r",\s*([^,]+),\s*[^,]*$", 1)))
    return _rows(df, 0, F.col("enrichment_id"), F.col("agency_name"), F.col("confidence_score"), city, F.transform("web_candidates", host_of), F.transform(of("voice"), phone_of), F.transform(address, street_of), F.transform(address, zip_of))


def contact_rows(df: DataFrame) -> DataFrame:
    return _rows(df, 1, F.col("contact_id"), F.col("agency"), F.lit(None), F.array("city"), F.array(host_of(F.col("agency_contact_url"))), F.array(phone_of(F.col("phone"))), F.array(street_of(F.col("address_line_1"))), F.array(zip_of(F.col("zip"))))


def meant_words(texts: DataFrame, official: DataFrame) -> DataFrame:
    """text, means: the words that each distinct text of ``texts(text, n)`` most probably means, sorted. An official
    word (of ``official(words)``) means itself; another one means the word, official or used in OWN_WORD rows, of
    greatest frequency times likelihood, or a common word or run; of several readings the one that suits the rest of
    the text, a word that is there already first."""
    common = lexicon.learn_common(official)
    read = lexicon.name_words(texts, "text", "text")
    uses = texts.groupBy("text").agg(F.sum("n").alias("n")).join(shuffled(read), "text").select("n", F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.sum("n").alias("n"))
    named = official.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("named"))
    plain = (~F.col("w").rlike("^[0-9]+$")) & ~F.col("w").isin(*EMPTY)
    vocabulary = written(uses.join(shuffled(named), "w", "full").select("w", (F.coalesce("n", F.lit(0)) + F.coalesce("named", F.lit(0))).alias("n"), F.col("named").isNotNull().alias("known")).where(plain), "vocabulary")
    typed = vocabulary.where("not known")
    near = lexicon.rare_words(typed.select("w"), vocabulary.where(f"known or n >= {OWN_WORD}").select("w")).where("typed <> word")
    weight = F.struct((F.col("cost") + F.log("n")).alias("weight"), F.col("word"))
    best = near.join(shuffled(vocabulary.select(F.col("w").alias("word"), "n")), "word").groupBy(F.col("typed").alias("w")).agg(F.max(weight).alias("b"))
    likely = best.join(shuffled(typed), "w").select("w", "b.word", (F.col("b.weight") - F.log("n") - NEW_WORD).alias("margin"))
    each = read.select("text", F.explode(F.array_distinct("words")).alias("w"))
    unsure = each.join(shuffled(written(likely, "likely")), "w").groupBy("text").agg(F.map_from_entries(F.collect_list(F.struct("w", F.struct("word", "margin")))).alias("likely"))
    known = each.join(shuffled(vocabulary.where("known").select("w")), "w").groupBy("text").agg(F.collect_list("w").alias("known"))

    def choose(ws, likely, known):
        ws, options = [w for w in ws if w not in EMPTY], []
        for k, w in enumerate(ws):
            if w in known or w.isdigit():
                options.append([(w, 0.0)])
                continue
            usual = [*common.stands_for(w), *common.after_letter(w, ws[:k] + ws[k + 1 :])]
            if w in likely and len(w) > 2:
                word, margin = likely[w]["word"], likely[w]["margin"] + TOGETHER * (likely[w]["word"] in ws)
                if word in known or word in common.known:
                    usual.append((word, lexicon.channel(w, word)))
                elif not usual and margin > 0:  # a frequent word, which may be a short one itself
                    usual = common.stands_for(word) or [(word, 0.0)]
                if margin <= 0 and all(r == word for r, _ in usual):
                    usual.append((w, 0.0))
            options.append(usual or [(w, 0.0)])
        sure = {x for o in options if len(o) == 1 for x in o[0][0].split(" ")}
        out = set()
        for k, o in enumerate(options):
            if len(o) > 1:
                rest = {x for j, p in enumerate(options) if j != k for r, _ in p for x in r.split(" ")}
                o = sorted(o, key=lambda rc: (-(rc[1] + common.suits(rc[0], rest, sure) + TOGETHER * (rc[0] in sure)), rc[0]))
            out |= set(o[0][0].split(" "))
        return sorted(out)

    def run(batches):
        for pdf in batches:
            each = [choose(list(ws), dict(m) if m is not None else {}, set(k) if k is not None else set()) for ws, m, k in zip(pdf["words"], pdf["likely"], pdf["known"])]
            yield pd.DataFrame({"text": pdf["text"], "means": each})

    return written(read.join(shuffled(unsure), "text", "left").join(shuffled(known), "text", "left").mapInPandas(run, "text string, means array<string>"), "meant")


def _classes(rows: DataFrame, official: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that say the same are one class: members (side, id, q, sure) and classes (side, q, terms, words), q being
    the least id of a class. Rows without a name are in none."""
    whole = rows.where("trim(name) <> ''").withColumn("text", F.concat_ws(" ; ", F.array("name"), F.filter("cities", lambda c: F.trim(c) != "")))
    meant = meant_words(whole.groupBy("text").agg(F.count("*").alias("n")), official)
    said = whole.join(shuffled(meant), "text")
    words = F.col("means")
    tag = lambda t, a: F.transform(a, lambda x: F.concat(F.lit(t), x))
    terms = F.array_sort(F.concat(tag("w|", words), tag("h|", F.col("hosts")), tag("p|", F.col("phones")), tag("a|", F.col("streets")), tag("z|", F.col("zips"))))
    each = written(said.select("side", "id", "sure", words.alias("words"), terms.alias("terms")), "said")
    least = each.groupBy("side", "terms").agg(F.min("id").alias("q"), F.first("words").alias("words"))
    members = written(each.join(shuffled(least.select("side", "terms", "q")), ["side", "terms"]).select("side", "id", "q", "sure"), "members")
    return members, written(least.select("side", "q", "terms", "words"), "classes")


def _bags(postings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes that say the same to the other side are one bag: side, q, bag (the least q), and the postings of bags
    (their q being the bag). Terms that the other side doesn't have open and add nothing, so they are left out."""
    shared = written(postings.join(shuffled(postings.select((1 - F.col("side")).alias("side"), "term").distinct()), ["side", "term"], "left_semi"), "shared")
    said = shared.groupBy("side", "q").agg(F.array_sort(F.collect_list(F.struct("term", "gain"))).alias("terms"))
    least = said.groupBy("side", "terms").agg(F.min("q").alias("bag"))
    of = written(said.join(shuffled(least), ["side", "terms"]).select("side", "q", "bag"), "bags")
    return of, written(shared.join(shuffled(of.where("q = bag").select("side", "q")), ["side", "q"], "left_semi"), "bag_postings")


def _opening(classes: DataFrame, weights: DataFrame, bag_of: DataFrame, cost_of) -> DataFrame:
    """side, q, term: terms of bags that may open candidates. Of two names that agree each holds the rarest telling word
    of the other, and others must share a host, phone or street, so that no more is needed: a row whose place the other
    side doesn't know never meets all offices of its kind."""
    telling = F.filter("words", lambda w: cost_of(w) < FOREIGN)
    words = classes.select("side", "q", F.explode(F.transform(telling, lambda w: F.xxhash64(F.concat(F.lit("w|"), w)))).alias("term"))
    rarest = words.join(shuffled(weights), "term").groupBy("side", "q").agg(F.min_by("term", F.struct(-F.col("idf"), "term")).alias("term"))
    contacts = classes.select("side", "q", F.explode(F.transform(F.filter("terms", _is_contact), lambda t: F.xxhash64(t))).alias("term"))
    return rarest.unionByName(contacts).join(shuffled(bag_of), ["side", "q"]).select("side", F.col("bag").alias("q"), "term").distinct()


def _is_contact(t: Column) -> Column:
    return F.substring(t, 1, 2).isin("h|", "p|", "a|")


def _candidates(postings: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """Pairs (g, c) of bags that share a term of ``opening(side, q, term)`` (any term if it is not given) of either and
    can reach NEAR of the best score of that one: exact, whatever the lists' lengths.
    ``postings(side, q, term, gain)``; a pair's score is the sum of the products of gains of the terms they share."""
    other = (1 - F.col("side")).alias("side")
    top = postings.groupBy(other, "term").agg(F.max("gain").alias("best_gain"), F.count("*").alias("rows"), F.min_by("q", F.struct(-F.col("gain"), "q")).alias("d"))
    # a candidate's score is at most what all terms up to the last one that opens it can add; others than opening ones first
    up = Window.partitionBy("side", "q").orderBy("opens", "most", "term").rowsBetween(Window.unboundedPreceding, 0)  # the terms of a bag
    asks = postings.join(shuffled(top), ["side", "term"]).withColumn("most", F.col("gain") * F.col("best_gain"))
    asks = asks.withColumn("opens", F.lit(True)) if opening is None else asks.join(shuffled(opening.withColumn("opens", F.lit(True))), ["side", "q", "term"], "left").na.fill(False, ["opens"])
    asked = written(asks.select("side", "q", "term", "rows", "d", "most", "opens", F.sum("most").over(up).alias("reach")).where("opens"), "asked")
    theirs = postings.select(other, "term", F.col("q").alias("d"))
    # the rarest term alone, and of each term the class that says most of it: the best whole score of these is a lower
    # bound of the best
    rare = asked.groupBy("side", "q").agg(F.min_by("term", F.struct("rows", "term")).alias("term"))
    first = rare.join(shuffled(theirs), ["side", "term"]).select("side", "q", "d").unionByName(asked.select("side", "q", "d"))
    bound = scores(_ahead(first), postings)
    both = bound.select(F.lit(0).alias("side"), F.col("g").alias("q"), "score").unionByName(bound.select(F.lit(1).alias("side"), F.col("c").alias("q"), "score"))
    least = both.groupBy("side", "q").agg(F.max("score").alias("bound"))
    essential = asked.join(shuffled(least), ["side", "q"]).where(F.col("reach") >= F.col("bound") * NEAR)
    return _ahead(essential.select("side", "q", "term").join(shuffled(theirs), ["side", "term"]).select("side", "q", "d"))


def _ahead(pairs: DataFrame) -> DataFrame:
    g = F.when(F.col("side") == 0, F.col("q")).otherwise(F.col("d"))
    c = F.when(F.col("side") == 0, F.col("d")).otherwise(F.col("q"))
    return pairs.select(g.alias("g"), c.alias("c")).distinct()


def scores(pairs: DataFrame, postings: DataFrame) -> DataFrame:
    """Whole BM25 scores of pairs (g, c): the terms of both are met, so no list is read again as a whole."""
    bag = lambda side, q, name: postings.where(f"side = {side}").groupBy(F.col("q").alias(q)).agg(F.map_from_entries(F.collect_list(F.struct("term", F.col("gain").cast("float").alias("gain")))).alias(name))
    met = pairs.join(shuffled(bag(0, "g", "left_gains")), "g").join(shuffled(bag(1, "c", "right_gains")), "c")
    shared = F.aggregate(F.map_entries("left_gains"), F.lit(0.0), lambda s, e: s + e["value"].cast("double") * F.coalesce(F.try_element_at("right_gains", e["key"]).cast("double"), F.lit(0.0)))
    return met.select("g", "c", shared.alias("score"))


def _gaps(scored: DataFrame, q: str, office: str, name: str) -> DataFrame:
    """For each class ``q`` and each office of the other side: the best score, and that of the best other office."""
    offices = scored.groupBy(q, office).agg(F.max("score").alias("s"))
    w = Window.partitionBy(q).orderBy(F.desc("s"), office)
    ranked = offices.withColumns({"k": F.row_number().over(w), "second": F.lead("s").over(w), "first": F.max("s").over(Window.partitionBy(q))})
    return ranked.select(q, office, F.when(F.col("k") == 1, F.coalesce("second", F.lit(0.0))).otherwise(F.col("first")).alias(name))


def fit_logistic(x: np.ndarray, y: np.ndarray, start: np.ndarray = PRIOR, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Newton's method towards labels, held near the start values; those if only one kind of label is there."""
    w = start.astype(float).copy()
    if len(y) == 0 or y.min() == y.max():
        return w
    x = np.hstack([np.ones((len(x), 1)), x])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, x.T @ (p - y) + ridge * (w - start))
    return w


def _cost(model: Channel):
    """Log rate at which a word is left out or put in; the learned rates are those of at most LABELLED names."""
    rates = {w: max(model.cost_out(w), model.cost_in(w)) for w in {**model.left_out, **model.put_in}}
    rates = {w: r for w, r in rates.items() if r > NEVER + 1}
    if not rates:
        return lambda w: F.lit(NEVER)
    learned = F.create_map(*(F.lit(x) for w in sorted(rates) for x in (w, float(rates[w]))))
    return lambda w: F.coalesce(F.try_element_at(learned, w), F.lit(NEVER))


def match_offices(greenbook: DataFrame, contacts: DataFrame, registry: DataFrame, weighed: bool = True, mutual: bool = True, calibrated: bool = True) -> DataFrame:
    """Columns enrichment_id, contact_id, confidence: every pair of rows for the same organisation.

    Names, contact details and addresses may be missing, shared, old or misspelt; null and empty attributes say nothing.
    Rows without a name match nothing. Rows delivered twice count once (of rows with one id the greatest stands). Empty
    tables give no rows. Names with different numbers never match. Labels for the calibration are rows whose
    ``entity_id`` names a record and contacts whose name means an official one. ``weighed``, ``mutual`` and
    ``calibrated`` switch a part of the method off, to measure what it does.
    """
    model = lexicon.fit_channel(names.labelled_pairs(greenbook, registry, "agency_name", "entity_id", "id", "name"))
    official = lexicon.name_words(registry, "name", "form")
    both = greenbook_rows(greenbook).unionByName(contact_rows(contacts))
    rows = written(both.groupBy("side", "id").agg(F.max("r").alias("r")).select("side", "id", "r.*"), "rows")
    members, classes = _classes(rows, official)
    n, mean = classes.agg(F.count("*"), F.coalesce(F.avg(F.size("terms")), F.lit(1.0))).first()
    each = classes.select("side", "q", ((K1 + 1) / (1 + K1 * (1 - B + B * F.size("terms") / mean))).alias("norm"), F.explode(F.transform("terms", lambda t: F.xxhash64(t))).alias("term"))  # eight bytes for a term
    sizes = members.groupBy("side", "q").agg(F.count("*").alias("m"))
    rows_n = members.count()
    weights = each.join(shuffled(sizes), ["side", "q"]).groupBy("term").agg(F.sum("m").alias("n")).select("term", (F.log(1 + (rows_n - F.col("n") + 0.5) / (F.col("n") + 0.5)) if weighed else F.lit(1.0)).alias("idf"))
    postings = written(each.join(shuffled(weights), "term").select("side", "q", "term", F.sqrt(F.col("idf") * F.col("norm")).alias("gain")), "postings")
    bag_of, bags = _bags(postings)
    cost_of = _cost(model)
    pairs = written(_candidates(bags, _opening(classes, weights, bag_of, cost_of)), "pairs")
    cost = lambda a: F.aggregate(a, F.lit(0.0), lambda s, w: s + cost_of(w))
    # pairs stay thin and between bags until few are left: an office is the hash of its telling words; a bag of several
    # offices is an office of its own whose members are as near as it is
    telling = F.xxhash64(F.concat_ws(" ", F.filter("words", lambda w: cost_of(w) < FOREIGN)))
    offices = classes.select("side", "q", telling.alias("o")).join(shuffled(bag_of), ["side", "q"]).groupBy("side", "bag").agg(F.min("o").alias("o"), (F.min("o") != F.max("o")).alias("several"))
    office = lambda side, p: offices.where(f"side = {side}").select(F.col("bag").alias(p), F.when(F.col("several"), F.xxhash64(F.lit("several"), "bag")).otherwise(F.col("o")).alias(f"{p}_office"), F.col("several").alias(f"{p}_several"))
    scored = written(scores(pairs, bags).join(shuffled(office(0, "g")), "g").join(shuffled(office(1, "c")), "c"), "scored")
    told = scored.join(shuffled(_gaps(scored, "g", "c_office", "g_other")), ["g", "c_office"]).join(shuffled(_gaps(scored, "c", "g_office", "c_other")), ["c", "g_office"])
    told = told.withColumns({"g_other": F.when(F.col("c_several"), F.greatest("g_other", "score")).otherwise(F.col("g_other")), "c_other": F.when(F.col("g_several"), F.greatest("c_other", "score")).otherwise(F.col("c_other"))})
    if mutual:  # and told apart from others on one side at least
        near = (F.col("score") >= NEAREST * F.col("g_other")) & (F.col("score") >= NEAREST * F.col("c_other"))
        told = told.where(near & ((F.col("score") > F.col("g_other")) | (F.col("score") > F.col("c_other"))))
    near_bags = written(told.select(F.col("g").alias("g_bag"), F.col("c").alias("c_bag"), "score", "g_other", "c_other"), "near")
    inside = lambda side, p: bag_of.where(f"side = {side}").select(F.col("bag").alias(f"{p}_bag"), F.col("q").alias(p))
    told = near_bags.join(shuffled(inside(0, "g")), "g_bag").join(shuffled(inside(1, "c")), "c_bag").drop("g_bag", "c_bag")
    of = lambda side, p: classes.where(f"side = {side}").select(F.col("q").alias(p), F.col("terms").alias(f"{p}_terms"), F.col("words").alias(f"{p}_words"))
    most = postings.groupBy("side", "q").agg(F.sum(F.col("gain") * F.col("gain")).alias("most"))
    side = lambda k, p: most.where(f"side = {k}").select(F.col("q").alias(p), F.col("most").alias(f"{p}_most"))
    stated = members.where("side = 0").groupBy(F.col("q").alias("g")).agg(F.coalesce(F.avg("sure"), F.lit(50.0)).alias("sure"))
    told = told.join(shuffled(of(0, "g")), "g").join(shuffled(side(0, "g")), "g").join(shuffled(stated), "g").join(shuffled(of(1, "c")), "c").join(shuffled(side(1, "c")), "c")
    digits = lambda a: F.filter(a, lambda w: w.rlike("^[0-9]+$"))
    # other offices below NEAR are not looked at, so that gaps end there
    gap = lambda other: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (F.col("score") - F.col(other)) / F.col("score") / (1 - NEAR)))
    features = {
        "share": F.col("score") / F.least("g_most", "c_most"),
        "g_gap": gap("g_other"),
        "c_gap": gap("c_other"),
        "g_cost": cost(F.array_except("g_words", "c_words")),
        "c_cost": cost(F.array_except("c_words", "g_words")),
        "sure": F.col("sure") / 100,
    }
    told = written(told.withColumns(features).withColumn("foreign", (F.col("g_cost") + F.col("c_cost")) / NEVER), "told")
    # labels: a class whose rows name a record, and one whose words are those of an official name
    meaning = greenbook.select(F.col("enrichment_id").cast("long").alias("id"), F.lower(F.trim("entity_id")).alias("e")).where("id is not null and e is not null").distinct()
    plain = official.withColumn("office", F.array_join(F.array_sort(F.array_distinct(F.filter("words", lambda w: ~w.isin(*EMPTY)))), " "))
    truth = meaning.join(shuffled(registry.select(F.col("id").alias("e"), F.col("name").alias("form"))), "e").join(shuffled(plain), "form").join(shuffled(members.where("side = 0").select("id", F.col("q").alias("g"))), "id").groupBy("g").agg(F.min("office").alias("meant"))
    exact = plain.select(F.col("office").alias("said")).distinct()
    columns = ["share", "g_gap", "c_gap", "foreign", "sure"]
    labelled = told.withColumn("said", F.array_join("c_words", " ")).join(shuffled(truth), "g").join(shuffled(exact), "said", "left_semi").orderBy(F.xxhash64("g", "c"), "g", "c").limit(LABELLED_PAIRS)
    labels = written(labelled.select(*columns, (F.col("meant") == F.col("said")).cast("double").alias("same")), "labels")  # cut to the limit in an executor
    got = np.array([list(r) for r in labels.collect()], float).reshape(-1, len(columns) + 1)
    w = fit_logistic(got[:, :-1], got[:, -1]) if calibrated else PRIOR
    z = F.lit(float(w[0]))
    for k, c in enumerate(columns):
        z = z + float(w[k + 1]) * F.col(c)
    sure = told.withColumn("confidence", 1 / (1 + F.exp(-z))).where(F.col("confidence") >= LEAST_CONFIDENCE)
    numbers = (F.size(digits("g_words")) == 0) | (F.size(digits("c_words")) == 0) | (F.size(F.array_intersect(digits("g_words"), digits("c_words"))) > 0)
    foreign = (F.col("g_cost") < FOREIGN).cast("int") + (F.col("c_cost") < FOREIGN).cast("int")
    reach = F.exists(F.array_intersect("g_terms", "c_terms"), _is_contact)
    agreed = sure.where(numbers & ((foreign == 0) | ((foreign == 1) & reach))).select("g", "c", "confidence")
    row = lambda k, p, name: members.where(f"side = {k}").select(F.col("q").alias(p), F.col("id").alias(name))
    return agreed.join(shuffled(row(0, "g", "enrichment_id")), "g").join(shuffled(row(1, "c", "contact_id")), "c").select("enrichment_id", "contact_id", "confidence")

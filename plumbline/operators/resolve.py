"""Resolution of source records to entities: matching, minting, additive enrichment, review reasons.

Order is part of the rules (first or last wins), so it travels as a column (``ord``, ``seq``), never as the order of
partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.session import written

PAIR = "array<struct<scheme:string,identifier:string>>"


def explode_pairs(df: DataFrame, id: str, pairs: str, *keep: str) -> DataFrame:
    """Identifier pairs as edges (id, pos, scheme, identifier)."""
    return df.select(F.col(id).alias("id"), *keep, F.posexplode(pairs).alias("pos", "p")).select("id", *keep, "pos", "p.scheme", "p.identifier").where("scheme is not null and identifier is not null")


def match_batch(records: DataFrame, entities: DataFrame) -> DataFrame:
    """JOIN-1 for one batch: rec_id, entity_id (null: to be minted), how (directive, identifier, name).

    ``records(rec_id, seq, name, pairs, match_entity_id, mint_id)``, ``entities(id, ord, name, pairs)``. The directive
    goes first, then the first of the record's pairs that any entity holds (of several entities the first in ``ord``),
    then the normalised name (of several the last), which a record with a mint_id skips.
    """
    held = explode_pairs(entities, "id", "pairs", "ord").groupBy("scheme", "identifier").agg(F.min_by("id", "ord").alias("entity"))
    by_pair = explode_pairs(records, "rec_id", "pairs").join(held, ["scheme", "identifier"]).groupBy("id").agg(F.min_by("entity", "pos").alias("pair_entity"))
    named = entities.groupBy(text.norm_name(F.col("name")).alias("k")).agg(F.max_by("id", "ord").alias("name_entity")).where("k <> ''")
    j = records.join(by_pair, records["rec_id"] == by_pair["id"], "left").withColumn("k", F.when(F.col("mint_id").isNull(), text.norm_name(F.col("name")))).join(named, "k", "left")
    how = F.when(F.col("match_entity_id").isNotNull(), "directive").when(F.col("pair_entity").isNotNull(), "identifier").when(F.col("name_entity").isNotNull(), "name")
    return j.select("rec_id", F.coalesce("match_entity_id", "pair_entity", "name_entity").alias("entity_id"), how.alias("how"))


def leaders(records: DataFrame) -> DataFrame:
    """Among records that match no entity, the one that the others join (rec_id, leader): records that share a pair or
    a name come to the first in ``seq``, by passing the least label over shared keys until nothing changes."""
    keys = explode_pairs(records, "rec_id", "pairs").select(F.col("id").alias("rec_id"), F.concat_ws("\x1f", "scheme", "identifier").alias("key"))
    keys = keys.unionByName(records.where("mint_id is null").select("rec_id", F.concat(F.lit("n\x1f"), text.norm_name(F.col("name"))).alias("key"))).distinct()
    shared = keys.join(keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "key", "left_semi")
    edges = written(shared, "keys")
    label = written(records.select("rec_id", F.col("seq").alias("label")), "labels")
    while True:
        least = edges.join(label, "rec_id").groupBy("key").agg(F.min("label").alias("m"))
        best = edges.join(least, "key").groupBy("rec_id").agg(F.min("m").alias("m"))
        nxt = written(label.join(best, "rec_id", "left").select("rec_id", F.least("label", "m").alias("label"), (F.col("m") < F.col("label")).alias("moved")), "labels")
        if nxt.where("moved").isEmpty():
            break
        label = nxt.drop("moved")
    first = records.select(F.col("rec_id").alias("leader"), F.col("seq").alias("label"))
    return label.select("rec_id", "label").join(first, "label").select("rec_id", "leader")


def mint_ids(rows: DataFrame, name: str, order: str, used: DataFrame, out: str = "id") -> DataFrame:
    """AGG-24: a slug of the name; of equal slugs, and where one is used, the next gets -2, -3 and so on, passing over
    numbers that are taken. ``used(id)``, ``order`` unique. An id that two different slugs come to is the first row's,
    and the other is numbered again; each round settles a row at least, and one is nearly always enough."""
    todo, taken, done = rows, used.select("id"), None
    while True:
        got = written(_number(todo, name, order, taken, out), "minted")
        first = got.groupBy(out).agg(F.min(order).alias("__first"), F.count("*").alias("__n"))
        clash = written(got.join(first.where("__n > 1"), out), "clash")
        if clash.isEmpty():
            return got if done is None else done.unionByName(got)
        slug = text.slug(F.col(name)).alias("__s")
        lost = clash.where(F.col(order) > F.col("__first")).groupBy(slug).agg(F.min(order).alias("__from"))
        again = got.select(order, slug).join(lost, "__s").where(F.col(order) >= F.col("__from")).select(order)
        again = written(again, "again")
        kept = got.join(again, order, "left_anti")
        done = kept if done is None else done.unionByName(kept)
        todo, taken = rows.join(again, order, "left_semi"), used.select("id").unionByName(done.select(F.col(out).alias("id")))


def _number(rows: DataFrame, name: str, order: str, used: DataFrame, out: str) -> DataFrame:
    base = rows.withColumn("__slug", text.slug(F.col(name)))
    end = F.regexp_extract("id", r"-([1-9]\d{0,8})$", 1)
    numbered = used.where(end != "").select(F.regexp_replace("id", r"-\d+$", "").alias("__slug"), end.cast("int").alias("__n")).where("__n > 1")
    takes = used.select(F.col("id").alias("__slug"), F.lit(1).alias("__n")).unionByName(numbered).groupBy("__slug").agg(F.sort_array(F.collect_set("__n")).alias("__taken"))
    ranked = base.withColumn("__rank", F.row_number().over(Window.partitionBy("__slug").orderBy(order))).join(takes, "__slug", "left")
    # the rank-th number that isn't taken: count on past each taken number not above it
    number = F.aggregate(F.coalesce("__taken", F.array().cast("array<int>")), F.col("__rank"), lambda n, t: F.when(t <= n, n + 1).otherwise(n))
    return ranked.withColumn(out, F.when(number == 1, F.col("__slug")).otherwise(F.concat("__slug", F.lit("-"), number.cast("string")))).drop("__slug", "__rank", "__taken")


def collision_suffix(rows: DataFrame, slug: str, suffix: Column, out: str = "id") -> DataFrame:
    """AGG-23: every member of a group of equal slugs gets its suffix, lone ones none."""
    n = rows.groupBy(slug).agg(F.count("*").alias("__n"))
    return rows.join(n, slug).withColumn(out, F.when(F.col("__n") > 1, F.concat(F.col(slug), F.lit("-"), suffix)).otherwise(F.col(slug))).drop("__n")


def nullify_shared(rows: DataFrame, code: str) -> tuple[DataFrame, DataFrame]:
    """AGG-22: codes that more than one row has become null; and the report of them."""
    n = rows.where(F.col(code).isNotNull()).groupBy(code).agg(F.count("*").alias("n"))
    shared = n.where("n > 1")
    marked = rows.join(shared.select(code, F.lit(True).alias("__s")), code, "left")
    return marked.withColumn(code, F.when(F.col("__s").isNull(), F.col(code))).drop("__s"), shared


def append_missing(entities: DataFrame, additions: DataFrame, column: str, same: list[Column] | None = None, key=None) -> DataFrame:
    """JOIN-2 to 7, MSC-35, 36: add to the array ``column`` of each entity the elements of ``additions(id, value, ord)``
    that it doesn't hold yet (by ``key``, a function of an element), at its end and in order; the rest stays. Entities
    without additions keep their arrays; applying twice changes nothing."""
    key = key or (lambda x: x)
    more = additions.groupBy("id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "value"))), lambda s: s["value"]).alias("__more"))
    j = entities.join(more, "id", "left")
    own = F.coalesce(F.col(column), F.expr(f"cast(array() as {entities.schema[column].dataType.simpleString()})"))
    put = lambda acc, x: F.when(F.exists(acc, lambda y: key(y) == key(x)), acc).otherwise(F.array_append(acc, x))
    return j.withColumn(column, F.when(F.col("__more").isNull(), F.col(column)).otherwise(F.aggregate("__more", own, put))).drop("__more")


def unmatched(additions: DataFrame, entities: DataFrame, id: str = "id") -> DataFrame:
    """JOIN-4 to 6: additions that name no entity, reported as skipped."""
    return additions.join(entities.select(F.col("id").alias(id)), id, "left_anti")


def merge_batches(entities: DataFrame, batches: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """JOIN-1 over batches in sequence, later ones seeing what earlier ones minted: (entities, proposals).

    Entities (id, ord, name, pairs) gain only missing pairs; unmatched records are minted. Proposals (action, entity_id,
    rec_id): one ``add`` per mint, one ``enrich`` per newly attached pair. Directives to unknown entities, and records
    expected to be new that match, are in check_batch().
    """
    log = None
    for records in batches:
        m = written(match_batch(records, entities), "matches")
        fresh = records.join(m.where("entity_id is null").select("rec_id"), "rec_id", "left_semi")
        lead = leaders(fresh)
        heads = fresh.join(lead.where("rec_id = leader").select("rec_id"), "rec_id", "left_semi")
        minted = mint_ids(heads, "name", "seq", entities.select("id"), "__minted").select(F.col("rec_id").alias("leader"), F.coalesce("mint_id", "__minted").alias("new_id"))
        minted = written(minted, "minted")
        to = m.join(lead, "rec_id", "left").join(minted, "leader", "left").select("rec_id", F.coalesce("entity_id", "new_id").alias("to"), (F.col("rec_id") == F.col("leader")).alias("is_new"))
        to = written(to, "to")
        top = entities.agg(F.coalesce(F.max("ord"), F.lit(0)).alias("m")).first().m
        new = records.join(to.where("is_new"), "rec_id").select(F.col("to").alias("id"), (F.col("seq") + top + 1).alias("ord"), "name", "pairs")
        grown = entities.unionByName(new)
        adds = explode_pairs(records, "rec_id", "pairs", "seq").join(to, F.col("id") == F.col("rec_id")).where("not coalesce(is_new, false)").select(F.col("to").alias("id"), F.struct("scheme", "identifier").alias("value"), F.struct("seq", "pos").alias("ord"), "rec_id")
        had = explode_pairs(grown, "id", "pairs").select("id", "scheme", "identifier")
        really = adds.join(had, (adds["id"] == had["id"]) & (adds["value.scheme"] == had["scheme"]) & (adds["value.identifier"] == had["identifier"]), "left_anti")
        one = to.where("is_new").select(F.lit("add").alias("action"), F.col("to").alias("entity_id"), "rec_id").unionByName(really.groupBy("id", "value").agg(F.min_by("rec_id", "ord").alias("rec_id")).select(F.lit("enrich").alias("action"), F.col("id").alias("entity_id"), "rec_id"))
        one = written(one, "proposals")
        log = one if log is None else log.unionByName(one)
        entities = written(append_missing(grown, adds.drop("rec_id"), "pairs"), "entities")
    return entities, log


def check_batch(records: DataFrame, entities: DataFrame) -> DataFrame:
    """DQ-7: rows that must not be there: directives to unknown entities, records expected to be new that match, minted
    ids in use, minted names that an entity has."""
    m = match_batch(records, entities)
    ids = entities.select(F.col("id").alias("entity_id"))
    problem = lambda df, why: df.select("rec_id", F.lit(why).alias("problem"))
    unknown = records.where("match_entity_id is not null").join(ids, records["match_entity_id"] == ids["entity_id"], "left_anti")
    matched = records.where("expect_new").join(m.where("entity_id is not null"), "rec_id", "left_semi")
    used = records.where("mint_id is not null").join(ids, records["mint_id"] == ids["entity_id"], "left_semi")
    names = entities.select(text.norm_name(F.col("name")).alias("k")).distinct()
    clash = records.where("mint_id is not null").withColumn("k", text.norm_name(F.col("name"))).join(names, "k", "left_semi")
    return problem(unknown, "unknown entity").unionByName(problem(matched, "expected new")).unionByName(problem(used, "id in use")).unionByName(problem(clash, "name in use"))


def reconcile(rows: DataFrame, keys: DataFrame, source_level: Column) -> DataFrame:
    """JOIN-8, 9, 37: ``rows(row_id, name, acronym)`` against ``keys(key, priority, ord, entity_id, level)`` (acronym 0,
    name 1, variants 2): row_id, entity_id, decision and reason. The exact match of best priority is attached; another
    level of government, checked first, goes to review; nothing found is unmatched."""
    asked = rows.select("row_id", F.explode(F.array(F.struct(F.lit(0).alias("priority"), text.norm_name(F.col("acronym")).alias("key")), F.struct(F.lit(1).alias("priority"), text.norm_name(F.col("name")).alias("key")))).alias("a"), source_level.alias("source_level")).select("row_id", "source_level", F.col("a.priority").alias("p"), F.col("a.key").alias("key")).where("key <> ''")
    hit = asked.join(keys, "key").where("(p = 0 and priority = 0) or (p = 1 and priority >= 1)")
    best = hit.groupBy("row_id", "source_level").agg(F.min_by(F.struct("entity_id", "level"), F.struct("priority", "ord")).alias("b"))
    j = rows.select("row_id").distinct().join(best, "row_id", "left")
    decision = F.when(F.col("b").isNull(), "unmatched").when(F.col("b.level") != F.col("source_level"), "review").otherwise("attach")
    reason = F.when(F.col("b").isNull(), "no_match").when(F.col("b.level") != F.col("source_level"), "cross_government_level").otherwise("exact")
    return j.select("row_id", F.col("b.entity_id").alias("entity_id"), decision.alias("decision"), reason.alias("reason"))


def fuzzy_review(names: DataFrame, known: DataFrame, most: int = 2) -> DataFrame:
    """Our own fuzzy tier (no parity claimed): names within ``most`` edits of a known one, for review. A known name is cut
    into ``most`` + 1 pieces, one of which no edit touches; it stands in the other name, at most ``most`` letters off."""
    a = names.select("row_id", text.norm_name(F.col("name")).alias("k"))
    b = known.select("entity_id", text.norm_name(F.col("name")).alias("kk"))
    pieces = lambda df: df.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(most)))).withColumn("at", F.expr(f"int(size * i div {most + 1})")).withColumn("n", F.expr(f"int(size * (i + 1) div {most + 1})") - F.col("at"))
    theirs = pieces(b.select("kk").where("kk is not null").distinct().withColumn("size", F.length("kk"))).select("kk", "size", "i", F.expr("substring(kk, at + 1, n)").alias("piece"))
    sizes = a.select("k").where("k is not null").distinct().withColumn("l", F.length("k")).withColumn("size", F.explode(F.expr(f"sequence(greatest(0, l - {most}), l + {most})")))
    moved = pieces(sizes).withColumn("off", F.explode(F.sequence(F.lit(-most), F.lit(most)))).withColumn("at", F.col("at") + F.col("off")).where("at >= 0 and at + n <= l")
    ours = moved.select("k", "size", "i", F.expr("substring(k, at + 1, n)").alias("piece")).distinct()
    met = ours.join(theirs, ["size", "i", "piece"]).withColumn("edits", F.levenshtein("k", "kk", most)).where("edits > 0").select("k", "kk", "edits").distinct()
    return a.join(met, "k").join(b, "kk").select("row_id", "entity_id", "edits")


def inverted(rows: DataFrame, key: Column, owner: str) -> DataFrame:
    """JOIN-10: key -> sorted owners and their number."""
    return rows.select(key.alias("key"), F.col(owner).alias("o")).where("key is not null and key <> ''").distinct().groupBy("key").agg(F.sort_array(F.collect_list("o")).alias("owners"), F.count("*").alias("n"))


def distinctive_match(candidates: DataFrame, hosts: DataFrame, names: DataFrame) -> DataFrame:
    """JOIN-11: ``candidates(cand_id, name, hosts array)`` against inverted indexes of hosts and of normalised names.

    Hosts with one owner are distinctive. Two or more entities by such hosts: review/domain_conflict; exactly one:
    auto/distinctive_domain, with its first host and whether the name says another entity. Else by name: one:
    proposal/exact_name, several: review/ambiguous_name. Else only shared hosts: review/apex_shared_only; else
    unmatched/no_match.
    """
    asked = candidates.select("cand_id", F.explode("hosts").alias("key")).distinct().join(hosts, "key")
    by_host = asked.groupBy("cand_id").agg(F.collect_set(F.when(F.col("n") == 1, F.col("owners")[0])).alias("ids"), F.min(F.when(F.col("n") == 1, F.col("key"))).alias("host"), F.max((F.col("n") > 1).cast("int")).alias("apex"))
    by_name = candidates.select("cand_id", text.norm_name(F.col("name")).alias("key")).join(names, "key").select("cand_id", F.col("owners").alias("named"))
    j = candidates.select("cand_id").distinct().join(by_host, "cand_id", "left").join(by_name, "cand_id", "left")
    ids, named = F.coalesce(F.size("ids"), F.lit(0)), F.coalesce(F.size("named"), F.lit(0))
    rule = lambda *vs: F.when(ids >= 2, vs[0]).when(ids == 1, vs[1]).when(named == 1, vs[2]).when(named > 1, vs[3]).when(F.coalesce("apex", F.lit(0)) == 1, vs[4]).otherwise(vs[5])
    entity = F.when(ids == 1, F.get("ids", F.lit(0))).when((ids == 0) & (named == 1), F.get("named", F.lit(0)))
    return j.select(
        "cand_id",
        rule("review", "auto", "proposal", "review", "review", "unmatched").alias("decision"),
        rule("domain_conflict", "distinctive_domain", "exact_name", "ambiguous_name", "apex_shared_only", "no_match").alias("reason"),
        entity.alias("entity_id"),
        F.when(ids == 1, F.col("host")).alias("host"),
        F.when(ids == 1, (named > 0) & ~F.coalesce(F.array_contains("named", F.get("ids", F.lit(0))), F.lit(False))).alias("name_divergent"),
    )


def one_to_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """JOIN-13: left_id, right_id, reason; a pair only where the key is once on either side. ``left(left_id, key)``,
    ``right(right_id, key)``; reasons matched, no_match, ambiguous, right_unmatched. Counts first, so that a key with
    many rows on both sides never meets itself."""
    a, b = left.groupBy(key).agg(F.count("*").alias("nl"), F.min("left_id").alias("l")), right.groupBy(key).agg(F.count("*").alias("nr"), F.min("right_id").alias("r"))
    j = a.join(b, key, "full")
    sure = (F.col("nl") == 1) & (F.col("nr") == 1)
    lefts = left.join(j, key, "left").select("left_id", F.when(sure, F.col("r")).alias("right_id"), F.when(F.col("nr").isNull(), "no_match").when(sure, "matched").otherwise("ambiguous").alias("reason"))
    rights = right.join(j.where(~F.coalesce(sure, F.lit(False))).select(key), key, "left_semi").unionByName(right.where(F.col(key).isNull()))
    return lefts.unionByName(rights.select(F.lit(None).cast(left.schema["left_id"].dataType).alias("left_id"), "right_id", F.lit("right_unmatched").alias("reason")))


def one_to_one_either(left: DataFrame, right: DataFrame, key: str, alternatives: str) -> DataFrame:
    """JOIN-14: as one_to_one(), a right row counting under each of its distinct alternative keys (an array); a claim
    stands if the left row has one candidate and the right row one claimant."""
    wide = right.select("right_id", F.explode(F.array_distinct(F.array_compact(alternatives))).alias(key))
    claims = left.join(wide, key).select("left_id", "right_id").distinct()
    nl, nr = claims.groupBy("left_id").agg(F.count("*").alias("nl")), claims.groupBy("right_id").agg(F.count("*").alias("nr"))
    sure = claims.join(nl, "left_id").join(nr, "right_id").where("nl = 1 and nr = 1").select("left_id", "right_id")
    return left.select("left_id").join(sure, "left_id", "left").join(nl, "left_id", "left").select("left_id", "right_id", F.when(F.col("right_id").isNotNull(), "matched").when(F.col("nl").isNull(), "no_match").otherwise("ambiguous").alias("reason"))


def multiset_match(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """JOIN-27: counts per key on both sides, and whether they are equal."""
    a, b = left.groupBy(*by).agg(F.count("*").alias("n_left")), right.groupBy(*by).agg(F.count("*").alias("n_right"))
    j = a.join(b, by, "full").na.fill(0, ["n_left", "n_right"])
    return j.withColumn("matched", F.col("n_left") == F.col("n_right"))


def match_rate(rows: DataFrame, level: str, matched: str) -> DataFrame:
    """AGG-19: matched, all, and rate to four places per level."""
    return rows.groupBy(level).agg(F.count_if(matched).alias("matched"), F.count("*").alias("entities")).withColumn("rate", F.when(F.col("entities") > 0, F.bround(F.col("matched") / F.col("entities"), 4)))


def website_rule(leads: DataFrame, owned: DataFrame) -> DataFrame:
    """JOIN-17: unit_id, host, outcome from ``leads(unit_id, host, source, path)`` and ``owned(host)``.

    Only leads to a root (or an index page) count, and only hosts that two sources give. Several such hosts:
    website_several_hosts_agreed; one: shared if another unit's leads agree on it, owned if an entity has it, else
    primary. None: website_single_lead if one source spoke, else website_leads_disagree.
    """
    root = leads.where(F.coalesce(F.col("path"), F.lit("")).rlike(r"(?i)^$|^/(?:(?:index|default|home)(?:\.[a-z]{2,5})?/?)?$"))
    per = root.groupBy("unit_id", "host").agg(F.countDistinct("source").alias("n"))
    agreed = per.where("n >= 2")
    claimed = agreed.groupBy("host").agg(F.count("*").alias("claims"))
    a = agreed.groupBy("unit_id").agg(F.count("*").alias("hosts"), F.min("host").alias("host"))
    one = a.join(claimed, "host", "left").join(owned.select("host", F.lit(True).alias("is_owned")).distinct(), "host", "left")
    units = root.groupBy("unit_id").agg(F.countDistinct("source").alias("sources")).join(one, "unit_id", "left")
    outcome = (
        F.when(F.col("hosts") > 1, "website_several_hosts_agreed")
        .when(F.col("hosts").isNull(), F.when(F.col("sources") == 1, "website_single_lead").otherwise("website_leads_disagree"))
        .when(F.col("claims") > 1, "website_host_shared")
        .when(F.col("is_owned"), "website_host_owned_by_existing_entity")
        .otherwise("primary")
    )
    return units.select("unit_id", F.when(F.col("hosts") == 1, F.col("host")).alias("host"), outcome.alias("outcome"))


def apply_checks(decided: DataFrame, checks: DataFrame) -> DataFrame:
    """JOIN-18: confirmed hosts go over what was decided; conflict marks a check against another primary host."""
    c = checks.select("unit_id", F.col("host").alias("checked"))
    j = decided.join(c, "unit_id", "left")
    return j.select("unit_id", F.coalesce("checked", "host").alias("host"), F.when(F.col("checked").isNotNull(), "checked").otherwise(F.col("outcome")).alias("outcome"), F.coalesce((F.col("outcome") == "primary") & (F.col("checked") != F.col("host")), F.lit(False)).alias("conflict"))


def title_places(titles: DataFrame, places: DataFrame) -> DataFrame:
    """JOIN-19: page_id, place of every place that a title names as whole words and not inside a longer place that it
    names too. A theta join (the title holds the place) run as an equi-join: the title's phrases, as long
    as the longest place, meet the places by key."""
    longest = places.agg(F.coalesce(F.max(F.size(F.split("place", " "))), F.lit(1))).first()[0]
    words = F.split(text.norm_title(F.col("title")), " ")
    t = titles.select("page_id", words.alias("w")).select("page_id", "w", F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i"))
    t = t.select("page_id", "i", F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(longest), F.size("w") - F.col("i") + 1)), lambda n: F.struct(n.alias("n"), F.array_join(F.slice("w", F.col("i"), n), " ").alias("place")))).alias("p")).select("page_id", "i", "p.n", "p.place")
    hit = t.join(places.select("place").distinct(), "place").withColumn("end", F.col("i") + F.col("n"))
    # spans of one title are few: keep those that no longer one covers
    spans = hit.groupBy("page_id").agg(F.collect_list(F.struct("i", "end", "place")).alias("s"))
    free = F.filter("s", lambda a: ~F.exists("s", lambda b: (b["i"] <= a["i"]) & (a["end"] <= b["end"]) & (b["end"] - b["i"] > a["end"] - a["i"])))
    return spans.select("page_id", F.explode(F.array_distinct(F.transform(free, lambda a: a["place"]))).alias("place"))


def title_names_level(title: Column, level: Column, place: Column, needs_level: Column, both: Column) -> Column:
    """JOIN-19: whether a title that names a place also names its level where it must; 'town and village of X' never
    does (``both``: other levels that have a place of this name)."""
    t = F.concat(F.lit(" "), text.norm_title(title), F.lit(" "))
    phrase = lambda l: t.contains(F.concat(F.lit(" "), l, F.lit(" of "), place, F.lit(" "))) | t.contains(F.concat(F.lit(" "), place, F.lit(" "), l, F.lit(" ")))
    joint = F.rlike(t, F.concat(F.lit(r" (?:town|village|city) and (?:town|village|city) of "), place, F.lit(" ")))
    rival = F.exists(both, lambda o: (o != level) & phrase(o))
    return ~joint & (~needs_level | (phrase(level) & ~rival))


def recovery_merge(base: DataFrame, recovery: DataFrame) -> DataFrame:
    """JOIN-12: id, status, action for ``(id, status)`` of two descriptions: absent ones are filled, recovered ok goes
    over failures, another failure over fetch_failed; everything else is protected."""
    j = base.select("id", F.col("status").alias("old")).join(recovery.select("id", F.col("status").alias("new")), "id", "full")
    action = (
        F.when(F.col("new").isNull(), "kept")
        .when(F.col("old").isNull(), "filled")
        .when((F.col("new") == "ok") & F.col("old").isin("fetch_failed", "no_about_found", "extraction_empty"), "replaced")
        .when((F.col("new") != "ok") & (F.col("old") == "fetch_failed"), "reclassified")
        .otherwise("protected")
    )
    return j.select("id", F.when(action.isin("kept", "protected"), F.col("old")).otherwise(F.col("new")).alias("status"), action.alias("action"))


def override(decisions: DataFrame, repoints: DataFrame) -> DataFrame:
    """JOIN-22: what an operator re-pointed goes over the automatic match: ``repoints(entity_id, reject, target)``; the
    last row per entity and rejected code stands (``seq``)."""
    last = repoints.groupBy("entity_id", "reject").agg(F.max_by("target", "seq").alias("target"))
    j = decisions.join(last, (decisions["entity_id"] == last["entity_id"]) & (decisions["code"] == last["reject"]), "left").drop(last["entity_id"])
    return j.withColumns({"decision": F.when(F.col("target").isNotNull(), "repointed").otherwise(F.col("decision")), "code": F.coalesce("target", "code")}).drop("reject", "target")


def leads_not_owned(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """JOIN-23, MSC-3: hosts (id, host) that nobody owns or shares."""
    return rows.join(hosts.select(F.col("key").alias("host")), "host", "left_anti")


def drift(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """JOIN-24, SET-3, 5: keys on one side only."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return left.join(right, key, "left_anti").withColumn("side", F.lit("left_only")).unionByName(right.join(left, key, "left_anti").withColumn("side", F.lit("right_only")))


def append_if_absent(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """JOIN-21."""
    return existing.unionByName(new.join(existing.select(key), key, "left_anti"))


def url_then_host(rows: DataFrame, records: DataFrame) -> DataFrame:
    """JOIN-28: the record of the row's url (the last there is), else of its host (the first). ``records(url, host,
    value, seq)``."""
    by_url = records.where("url is not null").groupBy("url").agg(F.max_by("value", "seq").alias("__u"))
    by_host = records.where("host is not null").groupBy("host").agg(F.min_by("value", "seq").alias("__h"))
    return rows.join(by_url, "url", "left").join(by_host, "host", "left").withColumn("value", F.coalesce("__u", "__h")).drop("__u", "__h")


def listing_targets(listing: DataFrame, overrides: DataFrame, codes: DataFrame) -> DataFrame:
    """JOIN-33: hosts of a listing per curated target; the host's override goes before its agency's code. Rows without
    either come out with a null target, for the caller to refuse."""
    j = listing.join(overrides.select("host", F.col("target").alias("o")), "host", "left").join(codes.select("agency", F.col("target").alias("c")), "agency", "left")
    each = j.select(F.coalesce("o", "c").alias("target"), "host", "seq").groupBy("target", "host").agg(F.min("seq").alias("seq"))
    return each.groupBy("target").agg(F.transform(F.sort_array(F.collect_list(F.struct("seq", "host"))), lambda s: s["host"]).alias("hosts"))


def source_ladder(rows: DataFrame, reasons: list[tuple[str, Column]], otherwise: str = "apply") -> DataFrame:
    """JOIN-34, 35: the first reason that holds, in the given order, else apply."""
    rule = None
    for name, holds in reasons:
        holds = F.coalesce(holds, F.lit(False))
        rule = F.when(holds, name) if rule is None else rule.when(holds, name)
    return rows.withColumn("outcome", rule.otherwise(otherwise) if rule is not None else F.lit(otherwise))


def hosts_named(payload: Column) -> Column:
    """JOIN-36, MSC-15: hosts that any string inside a JSON payload names; strings with blanks are free text."""
    from plumbline.functions import hosts

    strings = F.regexp_extract_all(payload, F.lit(r'(?<=[:\[,{])\s*"((?:[^"\\\\]|\\\\.)*)"(?!\s*:)'), 1)
    named = F.transform(F.filter(strings, lambda s: (s != "") & ~s.rlike(r"\s")), lambda s: hosts.url_host(s))
    return F.array_sort(F.array_distinct(F.filter(named, lambda h: h.isNotNull())))


def tag_marked(items: DataFrame, payload: str, marked: DataFrame) -> DataFrame:
    """JOIN-36: marked hosts that each item's payload names."""
    from plumbline.functions import hosts

    named = items.select("item_id", F.explode(hosts_named(F.col(payload))).alias("h")).withColumn("host", hosts.strip_www_digits(F.col("h")))
    hit = named.join(marked.select("host"), "host", "left_semi").groupBy("item_id").agg(F.sort_array(F.collect_set("host")).alias("marked_hosts"))
    return items.join(hit, "item_id", "left")


def start_urls(entities: DataFrame, url_by_key: DataFrame) -> DataFrame:
    """JOIN-38: where a crawl of each entity starts: the listed address of its first identifier that has one, else its
    primary domain, else any; derivation says which, skipped where there is none. ``entities(id, keys array, domains
    array<struct<domain,role>>)``."""
    keyed = entities.select("id", F.posexplode("keys").alias("pos", "key")).join(url_by_key, "key").groupBy("id").agg(F.min_by("url", "pos").alias("listed"))
    j = entities.join(keyed, "id", "left")
    primary = F.get(F.filter("domains", lambda d: d["role"] == "primary"), F.lit(0))["domain"]
    any_ = F.get("domains", F.lit(0))["domain"]
    to_url = lambda d: F.concat(F.lit("https://"), d, F.lit("/"))
    how = F.when(F.col("listed").isNotNull(), "listed").when(primary.isNotNull(), "primary_domain").when(any_.isNotNull(), "first_domain").otherwise("skipped")
    return j.select("id", F.coalesce("listed", to_url(primary), to_url(any_)).alias("start_url"), how.alias("derivation"))

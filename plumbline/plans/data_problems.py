"""Queries over whole tables for references, snapshots, histories and hierarchies, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import hierarchy, history, orphans, snapshots
from plumbline.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    mapping, greenbook = table(spark, d, "boundaries_mapping"), table(spark, d, "greenbook_enrichment")
    refs = orphans.fields_as_refs(mapping, "boundaries_mapping", "mapping_id", F.col("asserted_on"), {"entity_id": "registry", "layer": "boundary_layers"}).unionByName(
        orphans.fields_as_refs(greenbook, "greenbook_enrichment", "enrichment_id", F.col("received_at"), {"entity_id": "registry"})
    )
    parents = None
    for name in ("registry", "boundary_layers"):
        one = table(spark, d, name).select(F.lit(name).alias("namespace"), F.col("id").alias("key"), F.col("added_on").alias("added"), F.col("removed_on").alias("removed"))
        parents = one if parents is None else parents.unionByName(one)
    return orphans.find_orphans(refs, parents)


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(p1_found(spark, d))


def _squeezed(c):
    t = F.lower(F.regexp_replace(c, r"(?U)[\s ﻿]+", ""))
    return F.when(t != "", t)


def _same_url(c):
    t = F.regexp_replace(_squeezed(c), r"^[a-z][a-z0-9+.-]*://", "")
    t = F.regexp_replace(F.regexp_replace(t, r"^www\.", ""), "/$", "")
    return F.when(t != "", t)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    listing = table(spark, d, "state_listing").select("snapshot_date", "entry_no", "name", "url", "loaded_at")
    value = F.concat(F.coalesce(_squeezed(F.col("name")), F.lit("")), F.lit("\x1f"), F.coalesce(_same_url(F.col("url")), F.lit("")))
    return snapshots.snapshot_changes(listing, "snapshot_date", "entry_no", "loaded_at", value)


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return p3_found(spark, d).groupBy("snapshot_date", "change_kind").agg(F.count("*").alias("n"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    updates = table(spark, d, "web_property_updates").withColumn("domain", orphans.norm_key(F.col("domain")))
    found = history.periods(updates, ["entity_id", "domain"], ["role"], history.first_day(F.col("valid_from")), history.first_day(F.col("valid_to")), "loaded_at")
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return found.where("role is not null").select("entity_id", "domain", "role", day("valid_from").alias("valid_from"), F.coalesce(day("valid_to"), F.lit("")).alias("valid_to"))


def _tree(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.links(table(spark, d, "registry"), "id", "parent_id", "child_ids")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    solved = hierarchy.resolve_hierarchy(_tree(spark, d), with_path=False)
    return solved.select(F.col("id").alias("entity_id"), F.col("root").alias("root_id"), "depth")


def p7_paths(spark: SparkSession, d: str) -> DataFrame:
    solved = hierarchy.resolve_hierarchy(_tree(spark, d))
    return solved.select(F.col("id").alias("entity_id"), F.array_join("path", " > ").alias("path"))


def p7_descendants(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.descendants(hierarchy.resolve_hierarchy(_tree(spark, d)))


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p3_found, p3_report, p6_found, p7_found, p7_paths, p7_descendants)}

_KEY = "nullif(lower(trim({}, chr(32)||chr(9)||chr(10)||chr(13)||chr(160)||chr(65279))), '')"
_P1 = f"""
with refs as (
  select distinct 'boundaries_mapping' as ref_table, 'entity_id' as ref_field, mapping_id as row_id, asserted_on as d, 'r' as ns, {_KEY.format('entity_id')} as k from boundaries_mapping
  union select distinct 'boundaries_mapping', 'layer', mapping_id, asserted_on, 'l', {_KEY.format('layer')} from boundaries_mapping
  union select distinct 'greenbook_enrichment', 'entity_id', enrichment_id, cast(received_at as date), 'r', {_KEY.format('entity_id')} from greenbook_enrichment
), parents as (
  select 'r' as ns, {_KEY.format('id')} as k, added_on, removed_on from registry
  union all select 'l', {_KEY.format('id')}, added_on, removed_on from boundary_layers
), probed as (
  select ref_table, ref_field, row_id, d,
    count(p.k) as n,
    coalesce(bool_or(p.k is not null and (added_on is null or added_on <= d) and (removed_on is null or d < removed_on)), false) as alive,
    coalesce(bool_or(removed_on <= d), false) as gone
  from refs left join parents p using (ns, k) where k is not null and d is not null group by all
)
select ref_table, ref_field, row_id, strftime(d, '%Y-%m') as ref_period,
  case when n = 0 then 'missing' when gone then 'deleted' else 'late' end as reason
from probed where not alive"""
_SQUEEZED = r"lower(regexp_replace({}, '[\s\x{{A0}}\x{{FEFF}}]+', '', 'g'))"
_P3 = f"""
with vals as (
  select snapshot_date as s, entry_no, loaded_at, coalesce({_SQUEEZED.format('name')}, '') as n,
    coalesce(regexp_replace(regexp_replace(regexp_replace({_SQUEEZED.format('url')}, '^[a-z][a-z0-9+.-]*://', ''), '^www\\.', ''), '/$', ''), '') as u
  from state_listing where entry_no is not null and snapshot_date is not null
), latest as (
  select * from vals qualify row_number() over (partition by s, entry_no order by loaded_at desc nulls last) = 1
), seqs as (select s, row_number() over (order by s) as i from (select distinct s from latest)),
l as (select latest.*, i from latest join seqs using (s))
select strftime(coalesce(a.s, (select s from seqs where i = b.i + 1)), '%Y-%m-%d') as snapshot_date,
  coalesce(a.entry_no, b.entry_no) as entry_no,
  case when b.entry_no is null then 'added' when a.entry_no is null then 'removed' else 'changed' end as change_kind
from (select * from l where i > 1) a
full join (select * from l where i < (select max(i) from seqs)) b on a.entry_no = b.entry_no and a.i = b.i + 1
where a.entry_no is null or b.entry_no is null or a.n <> b.n or a.u <> b.u"""
_DAY = "try_cast(case when length(trim({0})) = 4 then trim({0}) || '-01-01' when length(trim({0})) = 7 then trim({0}) || '-01' else trim({0}) end as date)"
_P6 = f"""
with st as (
  select entity_id, {_KEY.format('domain')} as domain, role, {_DAY.format('valid_from')} as f, {_DAY.format('valid_to')} as t, loaded_at from web_property_updates
), one as (
  select * from st where f is not null and domain is not null qualify row_number() over (partition by entity_id, domain, f order by loaded_at desc nulls last) = 1
), cut as (
  select *, least(t, lead(f) over (partition by entity_id, domain order by f)) as u from one
), real as (select * from cut where u is null or u > f),
marked as (
  select *, case when role = lag(role) over w and lag(u) over w = f then 0 else 1 end as fresh from real window w as (partition by entity_id, domain order by f)
), isl as (select *, sum(fresh) over (partition by entity_id, domain order by f) as g from marked)
select entity_id, domain, role, strftime(min(f), '%Y-%m-%d') as valid_from,
  case when count(*) = count(u) then strftime(max(u), '%Y-%m-%d') else '' end as valid_to
from isl where role is not null group by entity_id, domain, role, g"""
_P7 = """
with recursive up as (
  select id, min(parent) as parent from (
    select id, parent_id as parent from registry
    union select c as id, id as parent from (select id, unnest(child_ids) as c from registry)
  ) where id in (select id from registry) and parent in (select id from registry) group by id
), tree as (
  select id, id as root, 0 as depth, id as path from registry where id not in (select id from up)
  union all select up.id, tree.root, tree.depth + 1, tree.path || ' > ' || up.id from up join tree on up.parent = tree.id
)"""
ORACLE = {
    "p1_found": _P1,
    "p1_report": f"select ref_table, ref_field, ref_period, reason, count(*) as n from ({_P1}) group by all",
    "p3_found": _P3,
    "p3_report": f"select snapshot_date, change_kind, count(*) as n from ({_P3}) group by all",
    "p6_found": _P6,
    "p7_found": f"{_P7} select r.id as entity_id, coalesce(root, '') as root_id, coalesce(depth, -1) as depth from registry r left join tree using (id)",
    "p7_paths": f"{_P7} select r.id as entity_id, coalesce(path, '') as path from registry r left join tree using (id)",
    "p7_descendants": f"""{_P7}, chain as (select id, string_split(path, ' > ') as p, depth from tree)
select p[i] as ancestor_id, id as descendant_id, depth - cast(i as int) + 1 as distance
from (select id, p, depth, unnest(range(1, depth + 1)) as i from chain)""",
}

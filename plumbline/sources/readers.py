"""Sources: every reader takes an explicit schema or header contract and infers nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import hosts, text
from plumbline.operators import quality

ENTITY = (
    "id string, name string, short_name string, other_names array<struct<name:string,note:string>>, government_level string, classification string, "
    "parent_id string, child_ids array<string>, identifiers array<struct<scheme:string,identifier:string>>, "
    "web_properties array<struct<domain:string,role:string,valid_from:string,valid_to:string,notes:string>>, "
    "url_conventions array<struct<era:string,pattern:string,notes:string>>, areas array<struct<scheme:string,layer:string,id:string,role:string>>, area_note string, "
    "mandates array<struct<authority_type:string,citation:string,url:string,date:string,role:string>>, relations array<struct<type:string,target_id:string,date:string>>, "
    "status string, founding_date string, dissolution_date string, links array<struct<url:string,note:string>>, "
    "contact_details array<struct<type:string,value:string,note:string>>, provenance struct<sources:array<string>,last_verified:string>"
)
RESULT = "run_id string, host string, page_url string, test string, identity string, verdict string, evidence string, evidence_sha256 string, ts timestamp, seq long"


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def json_array(spark: SparkSession, path: str, key: str, element: str) -> DataFrame:
    """SRC-1, 2, 6, 10, 12: the array under ``key`` of a JSON document as rows; a missing file is an empty table."""
    if not _exists(spark, path):
        return spark.createDataFrame([], element)
    kind = T.ArrayType(T.StructType.fromDDL(element))
    doc = spark.read.schema(T.StructType([T.StructField(key, kind)])).option("multiLine", True).json(path)
    return doc.selectExpr(f"inline({key})")


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> DataFrame:
    """SRC-29, 30: JSON lines; torn lines are dropped, or refused if ``strict``."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def csv_table(spark: SparkSession, path: str, columns: list[str], exact: bool = False) -> DataFrame:
    """SRC-3, 25: a CSV file with a header, all columns strings, a byte order mark dropped; the header is checked."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    df = df.toDF(*(c.lstrip("﻿").strip() for c in df.columns))
    quality.require_columns(df, columns, exact)
    return df if exact else df.select(*columns)


def listing(df: DataFrame, host: str) -> DataFrame:
    """SRC-3, 7: hosts trimmed in lower case, rows without one dropped."""
    return df.withColumn(host, F.lower(F.trim(host))).where(F.coalesce(F.col(host), F.lit("")) != "")


def active_only(df: DataFrame, status: str) -> DataFrame:
    """SRC-4."""
    return df.where(text.is_active(F.col(status)))


def last_by_key(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """SRC-5, 15, MSC-6, 14: the last value that is there for each key."""
    return df.where(F.col(key).isNotNull() & (F.coalesce(F.trim(value), F.lit("")) != "")).groupBy(key).agg(F.max_by(value, order).alias(value))


def website_cell(c: Column) -> Column:
    """SRC-8, PRJ-36: a website given as a string or as an object with a url."""
    return F.nullif(F.trim(F.coalesce(F.get_json_object(c, "$.url"), F.when(~F.ltrim(c).startswith("{"), c))), F.lit(""))


def dotgov(df: DataFrame, state: str, domain: str, kind: str, org: str) -> tuple[DataFrame, DataFrame]:
    """SRC-9, MSC-1: leads (domain, tier, place, organization) of a state's local governments from the list of .gov
    domains, and counts of what was passed over. Contact columns are never read."""
    rows = df.select(F.lower(F.trim(domain)).alias("domain"), F.col(kind).alias("kind"), F.col(org).alias("organization"), F.trim(state).alias("state"))
    named = rows.withColumn("g", text.classify_government(F.col("organization")))
    why = F.when(~F.col("state").isin("NY", "New York"), "other state").when(~F.col("kind").isin("City", "County"), "other kind").when(F.col("g").isNull(), "names no government")
    named = named.withColumn("skipped", why)
    return named.where("skipped is null").select("domain", "g.tier", "g.place", "organization"), named.where("skipped is not null").groupBy("skipped").agg(F.count("*").alias("n"))


def display_name(kind: Column, name: Column, county: Column) -> Column:
    """SRC-11: a locality's name as it is shown, by its kind."""
    return F.when(kind == "County", F.concat(name, F.lit(" County"))).when(kind.isNotNull() & name.isNotNull(), F.concat(F.initcap(kind), F.lit(" of "), name)).otherwise(F.coalesce(name, county))


def checked_vocabulary(df: DataFrame, column: str, allowed: list[str], what: str) -> DataFrame:
    """SRC-15, 16, 26, MSC-41: refuse rows with a word outside the vocabulary."""
    quality.require_empty(quality.outside(df, column, allowed), what)
    return df


def moved_pages(df: DataFrame) -> DataFrame:
    """SRC-16: page corrections; a moved page must say where to."""
    quality.require_empty(df.where("issue = 'moved' and coalesce(trim(moved_to), '') = ''").select("url"), "moved pages without a target")
    return df


def attribute_rows(df: DataFrame, features: str = "features") -> DataFrame:
    """SRC-20: attributes of a map service's paged answers; a page that is an error is refused."""
    quality.require_empty(df.where(F.col(features).isNull()).select(F.to_json(F.struct(*df.columns))), "map service answered an error")
    return df.select(F.explode(features).alias("f")).select("f.attributes.*")


def vocabulary_blocks(source: Column, union_name: str) -> Column:
    """SRC-22: names in a union type of a program text."""
    block = F.regexp_extract(source, rf"(?s)type\s+{union_name}\s*=\s*(.*?);", 1)
    return F.transform(F.regexp_extract_all(block, F.lit("""['"]([^'"]+)['"]"""), 1), lambda s: s)


def quoted_field(block: Column, key: str) -> Column:
    """SRC-23: a field's value in either kind of quotes."""
    return F.nullif(F.regexp_extract(block, rf"""(?s)\b{key}\s*:\s*(['"`])(.*?)\1""", 2), F.lit(""))


def layer_rows(source: DataFrame, column: str) -> DataFrame:
    """SRC-21: layers of a boundary vocabulary from program text: every flat block in braces that has an id."""
    blocks = source.select(F.posexplode(F.regexp_extract_all(F.col(column), F.lit(r"(?s)\{([^{}]*)\}"), 1)).alias("pos", "b"))
    fields = {n: quoted_field(F.col("b"), k) for n, k in (("id", "id"), ("name", "name"), ("name_plural", "namePlural"), ("description", "description"), ("description_url", "descriptionUrl"))}
    return blocks.select("pos", *(c.alias(n) for n, c in fields.items())).where("id is not null")


def targets_from_addresses(df: DataFrame, kinds: list[str]) -> DataFrame:
    """SRC-26, MSC-49: an address list with headers in any case and spacing; unknown kinds are refused."""
    tidy = {c: c.strip().lower().replace(" ", "_") for c in df.columns}
    df = df.withColumnsRenamed(tidy)
    quality.require_columns(df, ["address", "kind"])
    return checked_vocabulary(df, "kind", kinds, "unknown kinds of address")


def targets(df: DataFrame) -> DataFrame:
    """SRC-27, 28, MSC-44: targets (url, host, entity_id, entity_ids) of a table that has a url, an address, a domain or
    a host, and an id, ids or entity_id."""
    columns = set(df.columns)
    url = next(F.col(c) for c in ("url", "address", "domain", "host") if c in columns)
    ids = F.col("ids") if "ids" in columns else F.array(F.col("entity_id")) if "entity_id" in columns else F.array(F.col("id")) if "id" in columns else F.array().cast("array<string>")
    ids = F.array_compact(F.coalesce(ids, F.array().cast("array<string>")))
    return df.select(F.when(url.contains("://"), url).otherwise(F.concat(F.lit("https://"), url, F.lit("/"))).alias("url"), hosts.url_host(url).alias("host"), F.when(F.size(ids) == 1, ids[0]).alias("entity_id"), ids.alias("entity_ids"))


def files_with_manifest(spark: SparkSession, folder: str, manifest: DataFrame, id: str = "id") -> DataFrame:
    """SRC-32: whole text files joined to a manifest by file name (id.txt); a missing file is refused."""
    files = spark.read.option("wholetext", True).text(folder).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]+$", 1).alias(id), F.col("value").alias("raw_text"))
    quality.require_empty(manifest.join(files, id, "left_anti").select(id), "captures without a file")
    return manifest.join(files, id)


def contact_pages(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-33: website and owner (the folder) of markdown contact files."""
    raw = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").text(folder)
    site = F.regexp_extract("value", r"(?im)^\W*(?:website|web|url)\W*\s*:\W*\s*<?(https?://[^\s>)]+|[\w.-]+\.[a-z]{2,}[^\s>)]*)", 1)
    return raw.select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("owner"), F.nullif(site, F.lit("")).alias("website")).where("website is not null")


def table_cells(spark: SparkSession, path: str, default: str) -> DataFrame:
    """SRC-34: rows of a markdown table whose last cell somebody edited: (id, note)."""
    line = spark.read.text(path)
    return line.select(F.trim(F.regexp_extract("value", r"^\|\s*`?([^|`]+?)`?\s*\|", 1)).alias("id"), F.trim(F.regexp_extract("value", r"\|([^|]*)\|\s*$", 1)).alias("note")).where((F.col("id") != "") & ~F.col("id").rlike("^[-: ]+$") & (F.col("note") != default) & ~F.col("note").rlike("^[-: ]*$"))


def links_in_results(results: DataFrame) -> DataFrame:
    """SRC-35: sitemaps named by robots files and final addresses seen by earlier runs: (host, url, via)."""
    robots = results.where("test = 'W1'").select("host", F.explode(F.regexp_extract_all(F.get_json_object("evidence", "$.first_8kb"), F.lit(r"(?im)^\s*sitemap\s*:\s*(\S+)"), 1)).alias("url"), F.lit("robots").alias("via"))
    final = results.where("test = 'F4'").select("host", F.get_json_object("evidence", "$.final_url").alias("url"), F.lit("probe").alias("via")).where("url is not null")
    return robots.unionByName(final).dropDuplicates(["host", "url"])


def sparql_bindings(df: DataFrame) -> DataFrame:
    """SRC-24, AGG-3: bindings (item, itemLabel, altLabel, website; one row for each combination) as one row per code."""
    flat = df.select(text.initials_code(F.col("item")).alias("code"), "itemLabel", "altLabel", hosts.messy_host(F.col("website")).alias("host"))
    return flat.where("code <> ''").groupBy("code").agg(F.min("itemLabel").alias("label"), F.sort_array(F.collect_set("altLabel")).alias("aliases"), F.sort_array(F.collect_set("host")).alias("hosts"))

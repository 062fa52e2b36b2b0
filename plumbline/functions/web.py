"""Parsers of web responses: the only Python functions of the core, each Arrow-batched and run once per response."""

from __future__ import annotations

import gzip
import json
import re
import urllib.parse
import urllib.robotparser
import xml.etree.ElementTree as ET
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()
_LINK = T.StructType([T.StructField(n, _S) for n in ("href", "text", "hreflang")])
_TAG = T.StructType([T.StructField(n, _S) for n in ("rel", "type", "href")])
_NODE = T.StructType([T.StructField(n, _S) for n in ("type", "name", "via")])
PAGE = T.StructType(
    [
        T.StructField("lang", _S),
        T.StructField("title", _S),
        T.StructField("h1", T.IntegerType()),
        T.StructField("headings", T.IntegerType()),
        T.StructField("has_main", T.BooleanType()),
        T.StructField("landmarks", T.ArrayType(_S)),
        T.StructField("meta", T.MapType(_S, _S)),
        T.StructField("links", T.ArrayType(_LINK)),
        T.StructField("alternates", T.IntegerType()),
        T.StructField("link_tags", T.ArrayType(_TAG)),
        T.StructField("scripts", T.ArrayType(_S)),
        T.StructField("types", T.ArrayType(_NODE)),
        T.StructField("invalid_jsonld", T.IntegerType()),
        T.StructField("text_all", _S),
        T.StructField("text_main", _S),
    ]
)
_GROUP = T.StructType([T.StructField("agents", T.ArrayType(_S)), T.StructField("rules", T.ArrayType(T.StructType([T.StructField("kind", _S), T.StructField("path", _S)])))])
_SIGNAL = T.StructType([T.StructField("value", _S), T.StructField("agents", T.ArrayType(_S))])
ROBOTS = T.StructType(
    [
        T.StructField("groups", T.ArrayType(_GROUP)),
        T.StructField("sitemaps", T.ArrayType(_S)),
        T.StructField("signals", T.ArrayType(_SIGNAL)),
        T.StructField("usage", T.ArrayType(_SIGNAL)),
    ]
)
SITEMAP = T.StructType([T.StructField("kind", _S), T.StructField("count", T.IntegerType()), T.StructField("lastmods", T.ArrayType(_S)), T.StructField("gzip", T.BooleanType()), T.StructField("error", _S)])
HEADER_LINK = T.StructType([T.StructField(n, _S) for n in ("href", "rel", "type")])

# Elements whose text isn't read, roles and elements that are landmarks, chrome and blocks of prose.
UNREAD = frozenset(("script", "style", "noscript", "template", "svg", "head"))
ROLES = frozenset(("main", "navigation", "banner", "contentinfo", "search"))
CHROME = frozenset(("script", "style", "nav", "header", "footer", "aside", "noscript", "form", "button", "svg", "select", "option"))
BLOCKS = frozenset(("p", "h1", "h2", "h3", "li", "blockquote"))


class _Events(HTMLParser):
    """Flattens a page into (event, tag, attributes or data), so that readers are loops over a list."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.seen: list[tuple[str, str, dict | str]] = []

    def handle_starttag(self, tag, attrs):
        self.seen.append(("open", tag, {k.lower(): v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        self.seen.append(("close", tag, ""))

    def handle_data(self, data):
        self.seen.append(("text", "", data))


def events(text: str | None) -> list[tuple[str, str, dict | str]]:
    p = _Events()
    try:
        p.feed(text or "")
        p.close()
    except Exception:  # a page that can't be parsed further counts as far as it went
        pass
    return p.seen


def _squeeze(parts: list[str], sep: str = "") -> str:
    return " ".join(sep.join(parts).split())


def _walk(node):
    stack = [node]
    while stack:
        x = stack.pop(0)
        if isinstance(x, list):
            stack[:0] = x
        elif isinstance(x, dict):
            yield x
            stack[:0] = [v for v in x.values() if isinstance(v, (dict, list))]


def json_types(blocks: list[str], itemtypes: list[str]) -> tuple[list[dict], int]:
    """SCL-17, 18: types named by JSON-LD blocks (anywhere inside) and by microdata; number of unreadable blocks."""
    found, bad = [], 0
    for block in blocks:
        try:
            tree = json.loads(block)
        except ValueError:
            bad += 1
            continue
        for node in _walk(tree):
            kinds = node.get("@type") or []
            name = node.get("name")
            for kind in kinds if isinstance(kinds, list) else [kinds]:
                found.append({"type": str(kind).rsplit("/", 1)[-1], "name": name if isinstance(name, str) else None, "via": "json-ld"})
    found += [{"type": t.rsplit("/", 1)[-1], "name": None, "via": "microdata"} for it in itemtypes for t in it.split()]
    return found, bad


def read_page(text: str | None) -> dict:
    """Everything the page tests need, in one pass."""
    page = {"lang": None, "h1": 0, "headings": 0, "has_main": False, "alternates": 0}
    title, landmarks, meta, links, tags, scripts, blocks, items, everything, main = [], set(), {}, [], [], [], [], [], [], []
    unread = in_main = 0
    in_title, block, anchor = False, None, None

    def finish(a):
        links.append({"href": a["href"], "text": _squeeze(a["text"]), "hreflang": a["hreflang"]})

    for event, tag, x in events(text):
        if event == "text":
            if block is not None:
                block.append(x)
            elif in_title:
                title.append(x)
            elif not unread:
                everything.append(x)
                if in_main:
                    main.append(x)
                if anchor is not None:
                    anchor["text"].append(x)
        elif event == "close":
            if tag in UNREAD and unread:
                unread -= 1
            if tag == "main" and in_main:
                in_main -= 1
            elif tag == "title":
                in_title = False
            elif tag == "script" and block is not None:
                blocks.append("".join(block))
                block = None
            elif tag == "a" and anchor is not None:
                finish(anchor)
                anchor = None
        else:
            if tag == "html" and x.get("lang"):
                page["lang"] = x["lang"]
            if x.get("itemtype"):
                items.append(x["itemtype"])
            if x.get("role") in ROLES:
                landmarks.add(x["role"])
                page["has_main"] |= x["role"] == "main"
            if tag == "main":
                page["has_main"] = True
                landmarks.add("main")
                in_main += 1
            elif tag in ("nav", "header", "footer"):
                landmarks.add(tag)
            elif tag == "title":
                in_title = True
            elif tag == "meta":
                key = (x.get("name") or x.get("property") or "").lower()
                if key:
                    meta.setdefault(key, x.get("content", ""))
            elif tag == "link":
                rel = x.get("rel", "").lower()
                tags.append({"rel": rel, "type": x.get("type", "").lower(), "href": x.get("href", "")})
                page["alternates"] += "alternate" in rel and bool(x.get("hreflang"))
            elif tag == "script":
                if x.get("src"):
                    scripts.append(x["src"])
                if "ld+json" in x.get("type", "").lower():
                    block = []
            elif tag == "a":
                anchor = {"href": x.get("href", ""), "text": [], "hreflang": x.get("hreflang")}
            if re.fullmatch("h[1-6]", tag):
                page["headings"] += 1
                page["h1"] += tag == "h1"
            unread += tag in UNREAD
    if anchor is not None:
        finish(anchor)
    types, bad = json_types(blocks, items)
    return page | {
        "title": "".join(title).strip(),
        "landmarks": sorted(landmarks),
        "meta": meta,
        "links": links,
        "link_tags": tags,
        "scripts": scripts,
        "types": types,
        "invalid_jsonld": bad,
        "text_all": _squeeze(everything, " "),
        "text_main": _squeeze(main, " ") if main else None,
    }


def read_main_text(text: str | None) -> str:
    """SCL-24, MSC-39: blocks of prose of a page, without its chrome; only those in <main> or <article> if it has any."""
    chrome = main = 0
    open_block, parts, found = False, [], []
    for event, tag, x in events(text):
        if event == "open":
            if tag in CHROME:
                chrome += 1
            elif tag in ("main", "article"):
                main += 1
            elif tag in BLOCKS and not chrome:
                open_block, parts = True, []
        elif event == "text":
            if open_block and not chrome:
                parts.append(x)
        elif tag in CHROME:
            chrome = max(0, chrome - 1)
        elif tag in ("main", "article"):
            main = max(0, main - 1)
        elif tag in BLOCKS and open_block:
            if s := _squeeze(parts, " "):
                found.append((main > 0, s))
            open_block, parts = False, []
    kept = [s for inside, s in found if inside] or [s for _, s in found]
    return "\n\n".join(s for s in kept if len(s) > 1).strip()


def read_robots(text: str | None) -> dict:
    """SCL-46: groups with their rules, sitemaps, preference lines. Consecutive agent lines share a group; rules and
    unknown fields end a run of them, sitemap and preference lines don't."""
    groups, sitemaps, signals, usage = [], [], [], []
    naming = False
    for line in (text or "").splitlines():
        field, colon, value = line.partition("#")[0].strip().partition(":")
        if not colon:
            continue
        field, value = field.strip().lower(), value.strip()
        agents = list(groups[-1]["agents"]) if groups else []
        if field == "user-agent":
            if not naming:
                groups.append({"agents": [], "rules": []})
            naming = True
            groups[-1]["agents"].append(value)
        elif field == "sitemap":
            sitemaps.append(value)
        elif field == "content-signal":
            signals.append({"value": value, "agents": agents})
        elif field == "content-usage":
            usage.append({"value": value, "agents": agents})
        else:
            naming = False
            if field in ("allow", "disallow") and groups:
                groups[-1]["rules"].append({"kind": field, "path": value})
    return {"groups": groups, "sitemaps": sitemaps, "signals": signals, "usage": usage}


def read_sitemap(raw: bytes | None) -> dict:
    """SCL-11: kind, number of entries and their lastmods, whatever the namespace; gzip by its first bytes."""
    raw = bytes(raw or b"")
    zipped = raw.startswith(b"\x1f\x8b")
    bad = lambda why: {"kind": "invalid", "count": 0, "lastmods": [], "gzip": zipped, "error": why}
    if zipped:
        try:
            raw = gzip.decompress(raw)
        except Exception as e:
            return bad(f"gzip: {type(e).__name__}")
    head = raw[:1024].lower()
    if b"<!doctype html" in head or b"<html" in head:
        return bad("html body")
    try:
        root = ET.fromstring(raw)
    except ET.ParseError as e:
        return bad(f"xml: {str(e)[:120]}")
    local = lambda el: el.tag.rsplit("}", 1)[-1] if isinstance(el.tag, str) else ""
    entry = {"urlset": "url", "sitemapindex": "sitemap"}.get(local(root))
    if entry is None:
        return bad(f"root element <{local(root)}>")
    stamps = []
    for el in root:
        if local(el) == entry:
            said = [x.text.strip() for x in el if local(x) == "lastmod" and (x.text or "").strip()]
            stamps.append(said[-1] if said else None)
    return {"kind": local(root), "count": len(stamps), "lastmods": stamps, "gzip": zipped, "error": None}


def read_link_header(raw: str | None) -> list[dict]:
    """SCL-15: targets of a Link header with rel and type in lower case."""
    out = []
    for target, rest in re.findall(r'<([^>]*)>((?:\s*;\s*[^;,]+=(?:"[^"]*"|[^;,]*))*)', raw or ""):
        pairs = {k.lower(): v.strip().strip('"') for k, v in re.findall(r';\s*([^=;,\s]+)\s*=\s*("[^"]*"|[^;,]*)', rest)}
        out.append({"href": target.strip(), "rel": pairs.get("rel", "").lower(), "type": pairs.get("type", "").lower()})
    return out


def _as_udf(f, kind):
    if isinstance(kind, T.StructType):
        names = kind.names

        def run(s: pd.Series) -> pd.DataFrame:
            return pd.DataFrame([f(x) for x in s], columns=names)
    else:

        def run(s: pd.Series) -> pd.Series:
            return pd.Series([f(x) for x in s], dtype=object)

    run.__annotations__ = {"s": pd.Series, "return": pd.DataFrame if isinstance(kind, T.StructType) else pd.Series}
    # a parse costs more than any plan gains from repeating it
    return F.pandas_udf(run, kind).asNondeterministic()


parse_page = _as_udf(read_page, PAGE)
parse_robots = _as_udf(read_robots, ROBOTS)
parse_sitemap = _as_udf(read_sitemap, SITEMAP)
main_text = _as_udf(read_main_text, _S)
link_header = _as_udf(read_link_header, T.ArrayType(HEADER_LINK))


@F.pandas_udf(T.StringType())
def url_join(base: pd.Series, href: pd.Series) -> pd.Series:
    """SCL-16: an address resolved against its page; '' if that can't be done."""

    def one(b, h):
        try:
            return urllib.parse.urljoin(b or "", h or "")
        except ValueError:
            return ""

    return pd.Series([one(b, h) for b, h in zip(base, href)], dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def url_join_all(base: pd.Series, hrefs: pd.Series) -> pd.Series:
    def one(b, h):
        try:
            return urllib.parse.urljoin(b or "", h or "")
        except ValueError:
            return ""

    return pd.Series([[one(b, h) for h in (hs if hs is not None else [])] for b, hs in zip(base, hrefs)], dtype=object)


@F.pandas_udf(T.BooleanType())
def robots_allows(robots: pd.Series, agent: pd.Series, url: pd.Series) -> pd.Series:
    """SCL-45: the standard library's reading (first match wins), which differs from robots_decision()."""

    def one(text, who, where):
        p = urllib.robotparser.RobotFileParser()
        p.parse((text or "").splitlines())
        try:
            return p.can_fetch(who or "*", where or "/")
        except Exception:
            return True

    return pd.Series([one(*x) for x in zip(robots, agent, url)])


def legacy_robots(parsed: Column, tokens: list[str]) -> Column:
    """SCL-44: for each named token, how many rules its own groups have; tokens that no group names are left out."""
    named = lambda t: F.filter(parsed["groups"], lambda g: F.exists(g["agents"], lambda a: F.lower(a) == t.lower()))
    every = F.array(*(F.struct(F.lit(t).alias("token"), F.size(named(t)).alias("groups"), F.aggregate(named(t), F.lit(0), lambda n, g: n + F.size(g["rules"])).alias("rules")) for t in tokens))
    return F.filter(every, lambda x: x["groups"] > 0)


def norm_robots_path(c: Column) -> Column:
    """SCL-8: hex digits of percent escapes in capitals; empty is '/'."""
    parts = F.split(F.coalesce(F.nullif(c, F.lit("")), F.lit("/")), "(?=%[0-9a-fA-F]{2})")
    up = F.transform(parts, lambda p: F.when(p.rlike("^%[0-9a-fA-F]{2}"), F.concat(F.upper(F.substring(p, 1, 3)), F.substring(p, 4, 100_000))).otherwise(p))
    return F.array_join(up, "")


def robots_pattern(c: Column) -> Column:
    """SCL-9: a rule's path as a regular expression: '*' is anything, a final '$' the end, all else literal."""
    body = F.regexp_replace(c, r"\$$", "")
    quoted = F.regexp_replace(F.regexp_replace(body, r"([\\.+?()\[\]{}^$|])", r"\\$1"), r"\*", ".*")
    return F.concat(F.lit("^"), quoted, F.when(c.endswith("$"), "$").otherwise(""))


def robots_decision(parsed: Column, token: Column, path: Column) -> Column:
    """SCL-34, 35: struct(grp, decision, rule) for a token at a path: the token's own groups together, else those for
    '*'; the longest matching rule decides, at a tie allow; /robots.txt itself is always allowed."""
    mine = lambda t: F.filter(parsed["groups"], lambda g: F.exists(g["agents"], lambda a: F.lower(a) == t))
    own, star = mine(F.lower(token)), F.filter(parsed["groups"], lambda g: F.array_contains(g["agents"], F.lit("*")))
    grp = F.when(F.size(own) > 0, "own").when(F.size(star) > 0, "*").otherwise("none")
    rules = F.flatten(F.transform(F.when(F.size(own) > 0, own).otherwise(star), lambda g: g["rules"]))
    at = norm_robots_path(path)
    hits = F.filter(rules, lambda r: (r["path"] != "") & F.rlike(at, robots_pattern(norm_robots_path(r["path"]))))
    ranked = F.transform(hits, lambda r: F.struct(F.length(norm_robots_path(r["path"])).alias("n"), (r["kind"] == "allow").cast("int").alias("ok"), F.concat(F.initcap(r["kind"]), F.lit(": "), r["path"]).alias("rule")))
    best = F.array_max(ranked)
    free = at == "/robots.txt"
    return F.struct(
        grp.alias("grp"),
        F.when(free | best.isNull() | (best["ok"] == 1), "allow").otherwise("disallow").alias("decision"),
        F.when(~free, best["rule"]).alias("rule"),
    )

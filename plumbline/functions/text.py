"""Name and text normalisers as column expressions: no Python runs in any of them.

Null in, null out, unless said otherwise. Case folding and blanks follow Unicode where the rule says so.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Levels of local government whose names lead or follow a place.
TIERS = ("county", "city", "town", "village")
_LEAD = r"^(?:(?:county|city|town|village)\s+of\s+)+"
# What ends a captured description, what is dropped from it, and what marks a missing page.
STOP_PREFIXES = (
    "you can also follow us on social media",
    "audio description:",
    "playback issues",
    "find social channels",
    "stay in touch",
    "connect with us",
    "follow us on",
    "sign up for our newsletter",
    "download the 311 app",
)
DROP_LINES = ("share", "(opens in new tab)", "select", "print", "translate", "text size")
NOT_FOUND_MARKERS = ("we're sorry.", "you have reached an outdated or non-existing page", "that page was not found")
MAX_TEXT = 5000


def _chain(c: Column, *steps: tuple[str, str]) -> Column:
    return reduce(lambda x, s: F.regexp_replace(x, s[0], s[1]), steps, c)


def norm_name(c: Column) -> Column:
    """PRJ-23: lower case, every run of other than letters and digits one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def slug(c: Column) -> Column:
    """PRJ-24: the same with hyphens; empty becomes 'entity'."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(s == "", "entity").otherwise(s)


def token_key(c: Column) -> Column:
    """PRJ-44: slug with underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def _place_core(s: Column) -> Column:
    return _chain(s, (r"\bsaint\b", "st"), (r"\bmt\b\.?", "mount"), (r"^the\s+", ""), ("[^a-z0-9]+", ""))


def place_key(c: Column) -> Column:
    """PRJ-25: comparison key of a place name without its level."""
    s = F.replace(F.lower(F.trim(c)), F.lit("&"), F.lit(" and "))
    return _place_core(_chain(s, (_LEAD, ""), (r"\s+county$", "")))


def place_key_suffix(c: Column, suffix: Column) -> Column:
    """PRJ-26: as place_key, but only the one trailing word given is dropped."""
    s = F.regexp_replace(F.replace(F.lower(F.trim(c)), F.lit("&"), F.lit(" and ")), _LEAD, "")
    tail = F.concat(F.lit(" "), suffix)
    cut = F.when(suffix.isNotNull() & F.endswith(s, tail), F.left(s, F.length(s) - F.length(tail))).otherwise(s)
    return _place_core(cut)


def norm_title(c: Column) -> Column:
    """PRJ-27: page titles for phrase search."""
    s = F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("&"), F.lit(" and "))
    return F.trim(_chain(s, ("[^a-z0-9]+", " "), (r"\bsaint\b", "st"), (r"\bmt\b", "mount"), (r"\s+", " ")))


def place_part(level: Column, name: Column) -> Column:
    """PRJ-28: the place in an official name."""
    s = F.regexp_replace(norm_title(name), "^(?:(?:county|city|town|village) of )+", "")
    return F.when(level == "county", F.regexp_replace(s, " county$", "")).otherwise(s)


def official_name(level: Column, place: Column) -> Column:
    """PRJ-29: 'X County', else 'Level of X'."""
    p = F.regexp_replace(F.trim(place), r"\s+", " ")
    return F.when(level == "county", F.concat(p, F.lit(" County"))).otherwise(F.concat(F.initcap(level), F.lit(" of "), p))


def drop_level_prefix(c: Column) -> Column:
    """PRJ-30: a place without its (perhaps repeated) level."""
    return F.regexp_replace(c, r"(?i)^(?:(?:County|City|Town|Village) of\s+)+", "")


def digit_code(c: Column, width: int | None = None) -> Column:
    """PRJ-31: a code as digits, left-padded to ``width`` if shorter; null if it isn't one."""
    s = F.trim(c.cast("string"))
    padded = F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s) if width else s
    return F.when(s.rlike(r"^\d+$"), padded)


def classify_government(c: Column) -> Column:
    """PRJ-32: an organisation's name -> struct(tier, place); null if it names no local government."""
    s = F.trim(F.regexp_replace(c, r"\s+", " "))
    s = F.trim(F.regexp_replace(F.trim(F.regexp_replace(s, r"(?i),?\s*(?:ny|n\.y\.|new york(?: state)?)\.?$", "")), ",+$", ""))
    tiered = r"(?i)^(?:(?:inc\.?|incorporated)\s+)?(town|village|city)\s+of\s+(?:the\s+)?(.+)$"
    of, after = r"(?i)^county\s+of\s+(.+)$", r"(?i)^(.+?)\s+county$"
    other = r"(?i)\b(of|department|office|police|sheriff|board|district)\b"
    pair = lambda t, p: F.struct(t.alias("tier"), F.trim(p).alias("place"))
    return (
        F.when(s.rlike(tiered), pair(F.lower(F.regexp_extract(s, tiered, 1)), F.regexp_extract(s, tiered, 2)))
        .when(s.rlike(of), pair(F.lit("county"), F.regexp_extract(s, of, 1)))
        .when(s.rlike(after) & ~F.regexp_extract(s, after, 1).rlike(other), pair(F.lit("county"), F.regexp_extract(s, after, 1)))
    )


def norm_page_name(c: Column) -> Column:
    """PRJ-33: names on pages, without the words that only say 'this is the website of'."""
    s = F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("&"), F.lit(" and "))
    s = _chain(s, ("[^a-z0-9 ]+", " "), (r"\b(the|official website of|official site of|website|homepage|home)\b", " "))
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def address_line(line1: Column, line2: Column, city: Column, state: Column, zip_: Column) -> Column:
    """PRJ-35: the parts that are there, joined; null if none is."""
    full = lambda c: F.when(F.trim(c) != "", F.trim(c))
    tail = F.nullif(F.concat_ws(" ", full(state), full(zip_)), F.lit(""))
    return F.nullif(F.concat_ws(", ", full(line1), full(line2), full(city), tail), F.lit(""))


def split_multi(c: Column, sep: str = ";") -> Column:
    """PRJ-37: trimmed, non-empty parts."""
    return F.filter(F.transform(F.split(c, sep), lambda x: F.trim(x)), lambda x: x != "")


def is_active(status: Column) -> Column:
    """PRJ-38."""
    return F.coalesce(F.lower(F.trim(status)) == "active", F.lit(False))


def initials_code(uri: Column) -> Column:
    """PRJ-42: the last path segment of a URI (an item's code)."""
    return F.regexp_extract(uri, "([^/]*)$", 1)


def partial_date(c: Column) -> Column:
    """SCL-10: the date of a W3C date that may lack month and day, or carry a time; null if there is none."""
    y, m, d = (F.regexp_extract(F.trim(c), r"^(\d{4})(?:-(\d{2}))?(?:-(\d{2}))?", i) for i in (1, 2, 3))
    part = lambda x: F.when(x == "", "01").otherwise(x)
    return F.when(y != "", F.try_to_date(F.concat_ws("-", y, part(m), part(d)), "yyyy-MM-dd"))


def looks_like_html(body: Column) -> Column:
    """SCL-2."""
    head = F.lower(F.left(F.ltrim(F.coalesce(body, F.lit(""))), F.lit(512)))
    return head.startswith("<!doctype html") | head.startswith("<html") | head.contains("<head") | head.contains("<body")


def llms_shape(body: Column) -> Column:
    """SCL-13: struct(h1, summary_blockquote) of the first two lines that aren't blank."""
    lines = F.filter(F.split(F.coalesce(body, F.lit("")), r"\R"), lambda x: F.trim(x) != "")
    h1 = F.coalesce(F.get(lines, F.lit(0)).startswith("# "), F.lit(False))
    return F.struct(h1.alias("h1"), (h1 & F.coalesce(F.get(lines, F.lit(1)).startswith("> "), F.lit(False))).alias("summary_blockquote"))


def squeeze(c: Column) -> Column:
    """SCL-20: runs of white space one blank, trimmed."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def count_words(c: Column) -> Column:
    """SCL-21: tokens with a letter in them, in any script."""
    return F.size(F.regexp_extract_all(c, F.lit(r"(?U)\w*[^\W\d_]\w*"), 0))


def count_tokens(c: Column) -> Column:
    """SCL-22."""
    return F.size(F.regexp_extract_all(c, F.lit(r"(?U)\w+"), 0))


# Phrases of a challenge page.
CHALLENGE = ("Access Denied", "Just a moment", "Attention Required", "verify you are human", "Checking your browser")


def is_challenge(title: Column, text: Column) -> Column:
    """SCL-23: the phrases of a challenge page in a title or in the first 2,000 characters of a text (the rule's own)."""
    both = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(F.substring(text, 1, 2000), F.lit("")))
    return both.rlike("(?i)" + "|".join(CHALLENGE))


def strip(c: Column) -> Column:
    """White space of any kind cut at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def truncated(c: Column, limit: int = MAX_TEXT) -> Column:
    """SRT-7: struct(text, truncated)."""
    t = strip(F.coalesce(c, F.lit("")))
    long = F.length(t) > limit
    return F.struct(F.when(long, strip(F.left(t, F.lit(limit)))).otherwise(t).alias("text"), long.alias("truncated"))


def is_not_found(c: Column) -> Column:
    """SCL-28."""
    low = F.replace(F.lower(c), F.lit("’"), F.lit("'"))
    return reduce(lambda a, b: a | b, (low.contains(m) for m in NOT_FOUND_MARKERS))


def is_prose_start(line: Column) -> Column:
    """SCL-29: a line of 80 characters, or a sentence of twelve words."""
    words = F.size(F.filter(F.split(line, r"\s+"), lambda w: w != ""))
    return (F.length(line) >= 80) | ((words >= 12) & F.rtrim(line).rlike(r"[.!?]$"))


def strip_wrapper(c: Column) -> Column:
    """SCL-27: lines of a capture between its first '---' and its 'Tab Context:' block, trimmed."""
    lines = F.transform(F.split(c, r"\R"), lambda x: F.trim(x))
    rule = F.coalesce(F.array_position(lines, "---"), F.lit(0)).cast("int")
    body = F.slice(lines, rule + 1, F.greatest(F.size(lines) - rule, F.lit(0)))
    tail = F.array_position(F.transform(body, lambda x: x.startswith("Tab Context:")), F.lit(True)).cast("int")
    return F.when(tail > 0, F.slice(body, F.lit(1), tail - 1)).otherwise(body)


def extract_prose(c: Column) -> Column:
    """SCL-26: paragraphs of the prose in a captured page, '' if there is none: from the first prose line to the first
    stop line, without dropped lines; blank lines part paragraphs."""
    lines = strip_wrapper(c)
    first = F.array_position(F.transform(lines, is_prose_start), F.lit(True)).cast("int")
    rest = F.slice(lines, F.greatest(first, F.lit(1)), F.size(lines))
    stops = F.transform(rest, lambda x: reduce(lambda a, b: a | b, (F.lower(x).startswith(p) for p in STOP_PREFIXES)))
    stop = F.array_position(stops, F.lit(True)).cast("int")
    kept = F.when(stop > 0, F.slice(rest, F.lit(1), stop - 1)).otherwise(rest)
    kept = F.filter(kept, lambda x: ~F.lower(x).isin(*DROP_LINES) & ~F.lower(x).startswith("(opens in new tab)"))
    joined = F.array_join(F.transform(kept, lambda x: F.when(x == "", F.lit("\x01")).otherwise(x)), " ")
    paragraphs = F.filter(F.transform(F.split(joined, "\x01"), lambda x: F.trim(x)), lambda p: p != "")
    return F.when(is_not_found(c) | (first == 0), "").otherwise(F.array_join(paragraphs, "\n\n"))


def about_link_score(hint: Column, last_segment: Column) -> Column:
    """SCL-25: how surely an anchor leads to the body's own about page."""
    words = F.size(F.filter(F.split(hint, r"\s+"), lambda w: w != ""))
    # Anchor texts that signal an about page.
    hints = ("about", "mission", "who we are", "who-we-are", "our agency", "about us", "about the", "overview", "what we do")
    by_text = (
        F.when(hint.isin("about", "about us", "about-us", "who we are", "our mission"), 6)
        .when(hint.startswith("about") & (words <= 5), 4)
        .when(reduce(lambda a, b: a | b, (hint.contains(h) for h in hints)), 1)
        .otherwise(0)
    )
    by_path = (
        F.when(last_segment.isin("about", "about-us", "aboutus", "about.page", "about-us.page"), 5)
        .when(last_segment.startswith("about.") | last_segment.startswith("about-us"), 3)
        .when(last_segment.startswith("about"), 1)
        .otherwise(0)
    )
    return by_text + by_path + F.when(last_segment.contains("mission") | last_segment.contains("who-we-are"), 2).otherwise(0)


def registry_platform(c: Column) -> Column:
    """SCL-31: the platform that a portal list's own words name outright."""
    t = F.lower(F.trim(c))
    return (
        F.when(t.contains("retired"), F.lit(None).cast("string"))
        .when(t.startswith("socrata"), "socrata")
        .when(t.startswith("arcgis hub") | (t == "arcgis online / arcgis hub"), "arcgis_hub")
        .when(t.startswith("ckan"), "ckan")
    )


def catalog_url(platform: Column, host: Column) -> Column:
    """SCL-32: the documented catalog of a platform on its own host."""
    base = F.concat(F.lit("https://"), host)
    return (
        F.when(platform == "socrata", F.concat(base, F.lit("/api/views/metadata/v1?limit=1&page=1")))
        .when(platform == "arcgis_hub", F.concat(base, F.lit("/api/feed/dcat-us/1.1.json")))
        .when(platform == "ckan", F.concat(base, F.lit("/api/3/action/package_list?limit=1")))
    )


def lookup_url(platform: Column, host: Column) -> Column:
    """MSC-38: where a dataset's page is looked up, for the platform that needs it."""
    return F.when(platform == "socrata", F.concat(F.lit("https://api.us.socrata.com/api/catalog/v1?domains="), F.url_encode(host), F.lit("&limit=1")))

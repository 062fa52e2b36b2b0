"""Template residue, filler and error-page text among real descriptions.

Texts are cut into messages (sentences and lines). Messages that occur anywhere are mined for templates with a
fixed-depth prefix tree: number of words, first word, second word, then the most similar template of that leaf, whose
differing words become variable. Words that matter for the verdict are never variable. Each template is classified once,
by a naive Bayes model of its words and pairs of words: a short list of patterns (the seed) takes some templates for
residue, their words against those of all others teach the model, and the model may take in or reject any template. The
verdict is passed on to all texts that hold a message of the template. Unfilled slots in otherwise ordinary text are sought
separately; names of fields are learned from the slots that are plain, and tell slots in ordinary brackets.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import written

#: Share of equal words at which a message joins a template; messages of a leaf that one task takes.
SIMILARITY, LEAF_MESSAGES = 0.75, 2_000
#: Slots that a field name is learned from, at least.
FIELD_SEEN = 2
#: Templates by which the words of residue are fitted, at most; log prior of a template that the seed takes for residue
#: or not; most that one word or pair of words can say; weight of what is expected before anything is seen.
FITTED, SEEDED, MOST, BELIEF = 20_000, 3.0, 4.0, 4.0

# The usual words of dummy Latin, of keyboard filler, and of parts of a page that filler names.
LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur consectetuer adipiscing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat proident culpa officia deserunt mollit anim laborum vestibulum mattis pulvinar aliquam viverra sodales fermentum tincidunt egestas porta quam nunc mauris vivamus praesent donec integer phasellus curabitur pellentesque suspendisse maecenas nullam etiam cras proin morbi vitae lectus turpis".split()
)
KEYBOARD = frozenset("asdf asdfasdf qwerty qwertz foo bar baz blah bla xxx xxxx aaa aaaa zzz test dummy sample content text lorem heading subheading caption headline body copy paragraph placeholder description intro title page".split())
MARKS = frozenset(
    "heading intro introduction description paragraph text title body summary blurb page section content image subtitle tagline bio down offline overloaded construction javascript script scripts scripting noscript js cookies browser browsers blocker content human robot captcha puzzle error errors erreur exception traceback warning fatal deprecated found denied forbidden unavailable permission permiso server proxy gateway backend blocked rejected refused suspended parked hosting maintenance session expired timed time-out requests request load loading oops placeholder dummy sample lorem caption headline copy todo fixme here launch delete edit add type write story block words connection secure security check checking moment wait seconds moved deleted".split()
)

_PART = r"(?:headline|heading|caption|copy|intro(?:duction)?|description|paragraph|text|title|body|summary|blurb|page|section|words|content|image|subtitle|tagline|bio)"
_NEEDS = r"(?:enabl|activ|allow|switch(?:ed)? o|turn(?:ed)? o|disabl|requir|need|block|accept|unblock|permit|(?:not|n.t) support|without|not available|unavailable|missing)"
_SCRIPT = r"(?:java ?scripts?|scripts?|scripting|js|active content|cookies)"
_THING = r"(?:page|url|file|resource|object|document|site|address|recurso|página|page)"
#: The seed: templates of these kinds are taken for residue at first. Each pattern is matched against a whole template.
KINDS: dict[str, list[str]] = {
    "filler": [
        r"\blorem ipsum\b|\bblah blah\b|\basdf\b|\bqwerty\b|^test test\b",
        r"^(?:(?:foo|bar|baz|xxx+|aaa+|zzz+|text|content|sample|dummy)\b[ ,]*){3,}",
        rf"\b(?:dummy|placeholder|sample|example|temporary|demo) (?:\w+ )?{_PART}\b(?!s? (?:room|case|hall))",
        rf"\b{_PART} (?:goes|go) here\b",
        rf"\b{_PART}s? (?:coming soon|to come|to follow|tbd|tba)\b|^(?:content |more )?coming soon\b",
        rf"^(?:please )?(?:add|insert|enter|write|type|put|paste|replace|edit|describe) (?:\w+ )?(?:your|a short|some|this|own|you[r]? own) ?(?:\w+ )?(?:{_PART}|here|words|box)\b",
        r"\bclick (?:here )?(?:to|and) (?:add|edit|write|insert)\b|\bdouble[- ]click\b",
        r"^(?:todo|fixme|tbd|xxx)\b",
        r"\breplace (?:this |it )?before (?:launch|publishing)\b|\b(?:change|delete|edit|swap out|replace|remove) (?:it |this )?later\b",
        r"\b(?:remove|delete) this (?:block|text|section|paragraph|line)\b",
        r"\bedit or delete (?:it|this)\b|\bthen start (?:writing|blogging)\b",
        r"\btell your story\b|\blet people know (?:more )?about you\b",
        r"\bgoes on and on to fill\b|\bkeep it (?:under|below|short)\b.*\bwords\b",
        r"\b(?:texte ici|votre texte|escriba aquí|su texto|texto de ejemplo|texte d.exemple|beispieltext|hier text)\b",
        r"^(?:an?|this is an?) (?:\w+ )?(?:placeholder|example|sample|dummy|demo) " + _PART,
    ],
    "error": [
        r"^http <\*>$|^gone$|^(?:please )?(?:try again|refresh the page|reload the page)\b(?:.* (?:later|in a while|in a moment))?$|^check the spelling of the (?:address|url)$",
        r"^(?:http|error|erreur|fehler|status)[ :#]*(?:code[ :]*)?<\*>",
        r"^<\*>(?: -|:| \|)? ?(?:forbidden|(?:page |file |object |url )?not found|bad gateway|gone|unauthori[sz]ed|bad request|internal server error|(?:the )?service (?:is )?(?:temporarily )?unavailable|gateway time-?out|something went wrong|too many requests|access denied)\b",
        rf"^(?:sorry, )?(?:the |this )?(?:requested )?{_THING}(?: you (?:asked|are looking|were looking|requested) ?(?:for)?)?,? (?:was |is |were |could |can ?|has been |may have been |might have been )+(?:not |been |be |have )*(?:found|moved|deleted|removed)\b(?! until| in the)",
        rf"^(?:sorry, )?(?:the )?requested {_THING}|^(?:{_THING} )?not found!?$|^{_THING} not found|^object not found",
        r"\bnot found on this server\b|\bno longer exists on this\b",
        r"\binternal server error\b|\bbad gateway\b|\bgateway time-?out\b|\bupstream\b.*\b(?:took too long|timed out)\b",
        r"^(?:the |this )?(?:service|site|server|website|page) (?:is )?(?:temporarily |currently |momentarily )?(?:unavailable|offline|down|overloaded)(?: right now| at the moment| for maintenance)?[ .!]*$",
        r"^(?:access|permission) (?:is |was )?(?:denied|forbidden|refused)\b|^forbidden\b[ .!]*$|^unauthori[sz]ed\b[ .!]*$",
        r"\byou (?:do not|don.t) have (?:permission|access|the rights?) to (?:view|see|access|open)\b|\bno tiene permiso\b|\bn.avez pas (?:le droit|l.autorisation|accès)\b",
        r"\b(?:unexpected|unknown|fatal|server|database|application|script|runtime|parse|connection) error\b|^fatal\b|\buncaught\b|\ban error (?:has )?occur+ed\b",
        r"^(?:error|warning|notice|deprecated|exception|traceback|panic|fault)\b ?[:(]|^exception in\b|^traceback\b|^error establishing\b",
        r"(?:^|[\s:(])[a-z.]*[a-z](?:error|exception)(?:$|[\s:,(])(?<!\serror)(?<!\serror[\s:,(])(?<!^error[\s:,(])(?<!^error)(?<!exception of )",
        r"\bfailed to open stream\b|\bcannot read propert|\bon line <\*>|^at [\w.$]+\(|\bstack trace\b|\bsegmentation fault\b|\bundefined (?:index|variable|function)\b",
        r"\berr_[a-z_]+\b",
        r"\bsomething went wrong\b|\bcould not connect to\b|\bwe (?:could not|couldn.t|can.t|cannot) load\b|\btimed out after\b|\bnothing matched\b",
        r"\bserver (?:met|encountered) a(?:n)? (?:\w+ )?condition\b",
        r"\btoo many requests\b|\bretry (?:in|after) <\*>|\brate limit",
        r"\b(?:your )?session (?:has |is )?(?:expired|timed out)\b|^(?:please )?log ?in again\b",
        r"^(?:your |the |this )?request (?:was |has been |is )?(?:blocked|rejected|refused|denied)\b|\bblocked by the (?:proxy|security|firewall|filter|edge)",
        r"\baccount (?:has been |is |was )?suspended\b|\bdomain (?:name )?(?:is |has been |was )?(?:parked|for sale|expired)\b|\bhosting provider\b|\bsite administrator\b|\bbuy it today or make an offer\b|\bmake an offer\b",
        r"\b(?:site|page|website|portal) (?:is )?(?:under|down for) (?:scheduled )?(?:maintenance|construction)\b",
        r"\brecurso que busca\b|\bpágina no encontrada\b|\bpage n.existe plus\b|\bpage introuvable\b|\bmomentanément indisponible\b|\bservicio no disponible\b|\bseite nicht gefunden\b",
        r"^(?:ray|incident|reference|support|request|error|trace)(?: id)? (?:id )?[0-9a-f<*>-]*$|\bsupport id\b|^\|? ?id (?:<\*>|[0-9a-f]{6,})[ |]*$",
        r"^oops\b|^loading[ .…]*$|^go back to the home ?page|^try the search box|^revenez à l.accueil|^vuelva (?:a|al) ",
        r"^(?:default|index|apache|nginx|iis)\b.*\b(?:web|test) (?:page|server)\b|\bindex of /",
        r"\blink you (?:followed|clicked)\b.*\b(?:broken|dead|expired|out of date)\b|\baddress does(?: not|n.t) lead anywhere\b",
    ],
    "notice": [
        rf"\b{_NEEDS}\w*\b(?:\W+\w+){{0,4}}?\W+(?:java ?scripts?|js|active content|scripting)\b",
        rf"\b(?:java ?script|scripting|js|active content)\b.*\b(?:{_NEEDS}\w*|switched off|turned off)\b",
        rf"^(?:please |kindly |if nothing happens,? |you (?:have|need) to |you must |turn |first |to )[^.]*\b{_NEEDS}\w*\b[^.]*\b{_SCRIPT}\b",
        rf"^(?:the |this |our |your |votre |su )?(?:[\w’']+ ){{1,3}}(?:needs?|requires?|requiere|doit accepter les|exige|uses?) {_SCRIPT}\b",
        r"^noscript\b|\bad[- ]?blocker\b",
        r"\b(?:rendered on the client|scripts first)\b|\bfull experience\b",
        r"^(?:you must |you have to |you need to |first |please |kindly )?(?:enable|activate|allow|switch on|turn on) (?:it|them)\b.*\b(?:reload|settings|run|view|see|use|continue)\b|^please allow it to\b|\bfirst (?:activate|enable|allow|turn on|switch on) (?:it|them)\b",
        r"\b(?:in|by|with) your (?:web )?browser$|\byour (?:web )?browser (?:is|was|has|does|do|can|blocks?|must|needs?|settings)\b|\b(?:update|upgrade|another|different|newer|modern) (?:\w+ )?browser\b|\bsu navegador\b|\bvotre navigateur\b|\bihr browser\b",
        r"\b(?:verify|confirm|prove|check) (?:that )?(?:you are|you.re) (?:a )?(?:human|not a robot)\b|\bi.?a?m not a robot\b|\bare you (?:a )?human\b|\b(?:complete|solve|enter|type) (?:the|this|a) captcha\b",
        r"\bsecurity check\b(?!s)|\bsolve (?:the|this) puzzle\b|\bpress and hold\b",
        r"^just a moment\b|^one (?:more step|moment)\b.*|\bchecking your\b|\bwhile we (?:make sure|check|verify)\b|\bddos\b|\bmake sure your connection\b",
        r"\b(?:will open|redirected?|reload\w*|refresh\w*|continue) in (?:about )?<\*> seconds\b|\bredirected automatically\b",
        r"\brequiere javascript\b|\bactive javascript\b|\bactiver javascript\b|\bles scripts pour\b",
    ],
}
_KINDS = {k: re.compile("|".join(f"(?:{p})" for p in ps), re.UNICODE) for k, ps in KINDS.items()}
_LETTERS = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


def seed_match(template: str) -> tuple[str, str] | None:
    """The kind of residue that the seed takes a template in lower case for, and the words around what tells so."""
    text = template.lstrip(" \t.!*#>|-–•\"'“”").rstrip(" \t.!|\"'“”")
    words = _LETTERS.findall(text)
    latin = sum(w in LATIN for w in words)
    if latin >= 3 and latin >= 0.5 * len(words):
        return "filler", text
    if len(words) >= 2 and (sum(w in KEYBOARD for w in words) >= 0.75 * len(words)):
        return "filler", text
    for kind, pattern in _KINDS.items():
        if m := pattern.search(text):
            return kind, " ".join([*text[: m.start()].split()[-4:], m.group(0), *text[m.end() :].split()[:4]])
    return None


def features(template: str) -> set[str]:
    """Words and pairs of neighbouring words, with both ends."""
    words = ["^", *(w.strip(".,!:;()[]\"'“”’") or w for w in template.split(" ")), "$"]
    return {w for w in words[1:-1] if w != "<*>"} | {f"{a} {b}" for a, b in zip(words, words[1:])}


def fit_model(templates: list[tuple[str, str | None]]) -> dict[str, float]:
    """Log odds of words and pairs of words, from templates and what the seed takes them for."""
    good, bad = Counter(), Counter()
    sizes = [0, 0]
    for t, kind in templates:
        (bad if kind else good).update(features(t))
        sizes[kind is not None] += 1
    if not all(sizes):
        return {}
    share = sizes[1] / sum(sizes)
    odds = lambda f: math.log((bad[f] + BELIEF * share) / sizes[1]) - math.log((good[f] + BELIEF * (1 - share)) / sizes[0])
    return {f: max(-MOST, min(MOST, odds(f))) for f in {*bad, *good} if bad[f] + good[f] > 1}


def classify(template: str, model: dict[str, float]) -> str | None:
    """The kind of residue that a template is, or None. What the seed finds is judged with the words around it, any
    other template as a whole."""
    seed = seed_match(template)
    told = [model.get(f, 0.0) for f in features(seed[1] if seed else template)]
    if (SEEDED if seed else -SEEDED) + sum(told) / max(1.0, len(told)) ** 0.5 <= 0:
        return None
    return seed[0] if seed else "other"


def messages(text: Column) -> Column:
    """Sentences and lines of a text in lower case, words with digits masked."""
    parts = F.split(F.regexp_replace(text, r"[​-‏⁠﻿­]", ""), r"(?<=[.!?])[\"'”’)]*\s+|[\r\n]+|\s+\|\s+")
    masked = F.transform(parts, lambda m: F.trim(F.regexp_replace(F.lower(F.regexp_replace(F.regexp_replace(m, r"(?U)\s+", " "), r"[^\s:|,;()]*\d[^\s:|,;()]*", "<*>")), r"[.!]+$", "")))
    return F.filter(masked, lambda m: F.length(m) > 1)


def _matters(word: str) -> bool:
    """Marks and words in brackets (the variable <*> aside) are never variable."""
    return word.strip(".,!:;()[]") in MARKS or (word != "<*>" and not word[0].isalnum() and word[0] in "[({<$#%@_&")


class PrefixTree:
    """Templates of one leaf (fixed number of words, first and second word), found in the order of their messages."""

    def __init__(self, similarity: float = SIMILARITY):
        self.similarity, self.templates = similarity, []

    def add(self, words: list[str]) -> int:
        best, at = self.similarity, -1
        room = len(words) - int(-(-self.similarity * len(words) // 1))  # words that may differ
        for k, t in enumerate(self.templates):
            same = differs = 0
            for a, b in zip(t, words):
                if a == b:
                    same += 1
                    continue
                differs += 1
                if differs > room or _matters(a) or _matters(b):
                    break
            else:
                differs = 0
            if differs == 0 and same >= best * len(words) and (same > best * len(words) or at < 0):
                best, at = same / len(words), k
        if at < 0:
            self.templates.append(list(words))
            return len(self.templates) - 1
        self.templates[at] = [a if a == b else "<*>" for a, b in zip(self.templates[at], words)]
        return at


def _mine(group: pd.DataFrame) -> pd.DataFrame:
    """The template of each message of several whole leaves."""
    group = group.sort_values(["size", "first", "second", "part", "n", "message"], ascending=[True, True, True, True, False, True])
    columns = (group[c].tolist() for c in ("size", "first", "second", "part", "message"))
    trees: dict[tuple, PrefixTree] = {}
    of = []
    for *leaf, message in zip(*columns):
        tree = trees.setdefault(tuple(leaf), PrefixTree())
        of.append((tree, tree.add(message.split(" "))))
    return pd.DataFrame({"message": group["message"].to_numpy(), "template": [" ".join(t.templates[k]) for t, k in of]})


def mine_templates(texts: DataFrame, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """message, template for every distinct message of the texts, in the shared folder. A leaf with many messages is
    split by hash, which can only mine a template twice."""
    each = texts.select(F.explode(messages(F.col(text))).alias("message")).groupBy("message").agg(F.count("*").alias("n"))
    words = F.split("message", " ")
    each = written(each.withColumns({"size": F.size(words), "first": F.element_at(words, 1), "second": F.coalesce(F.get(words, F.lit(1)), F.lit(""))}), "messages")
    if similarity > 1:
        return each.select("message", F.col("message").alias("template"))
    leaf = ["size", "first", "second"]
    crowds = each.groupBy(*leaf).agg(F.ceil(F.count("*") / LEAF_MESSAGES).cast("int").alias("parts"))
    spread = each.join(crowds.where("parts > 1"), leaf, "left").withColumn("part", F.pmod(F.xxhash64("message"), F.coalesce("parts", F.lit(1))))
    tasks = max(1, -(-each.count() // LEAF_MESSAGES))  # many small leaves share a group; the tree keeps them apart
    spread = spread.withColumn("g", F.pmod(F.xxhash64(*leaf, "part"), F.lit(tasks)))
    wide = 4 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # much work for few bytes; a partition takes its groups in turn
    mined = spread.select("g", *leaf, "part", "message", "n").repartition(wide, "g").groupBy("g").applyInPandas(_mine, "message string, template string")
    return written(mined, "templates")


def judge_templates(mined: DataFrame) -> DataFrame:
    """message, kind for every message of a template that is residue."""
    templates = written(mined.select("template").distinct(), "distinct_templates")

    @F.pandas_udf("string")
    def seed(ts: pd.Series) -> pd.Series:
        return pd.Series([m[0] if (m := seed_match(t)) else None for t in ts], dtype=object)

    taken = templates.withColumn("kind", seed("template"))
    # all that the seed takes and as many others as there is room for, each in the order of a hash
    teachers = taken.where("kind is not null").orderBy(F.xxhash64("template"), "template").limit(FITTED // 2).collect()
    others = taken.where("kind is null").orderBy(F.xxhash64("template"), "template").limit(FITTED // 2).collect()
    model = fit_model([(r.template, r.kind) for r in [*teachers, *others]])

    @F.pandas_udf("string")
    def judge(ts: pd.Series) -> pd.Series:
        return pd.Series([classify(t, model) for t in ts], dtype=object)

    return mined.join(templates.withColumn("kind", judge("template")).where("kind is not null"), "template").select("message", "kind")


# Slots whose syntax leaves no doubt. The first group of each is the field's name.
_PLAIN = [
    r"\{\{+\s*([^{}]{1,200}?)\s*\}+\}",
    r"[$#]\{\s*([^{}]{1,200}?)\s*\}",
    r"<%[=-]?\s*([^%<>]{1,200}?)\s*-?%>",
    r"\{%\s*([^{}%]{1,200}?)\s*%\}",
    r"@@\s*([\w .-]{1,200}?)\s*@@",
    r"%%\s*([\w .-]{1,200}?)\s*%%",
    r"(?<!\w)__([A-Za-z][A-Za-z_ ]{1,200}?)__(?!\w)",
    r"\[\[\s*([^\[\]]{1,200}?)\s*\]\]",
    r"<<\s*([^<>]{1,200}?)\s*>>",
    r"(?<![\w$])\$([A-Za-z][A-Za-z_]{2,200})\$",
    r"(?<![\w%])%([A-Za-z][A-Za-z_]{2,200})%",
    r"\{([A-Za-z]+(?:_[A-Za-z]+)+)\}",
    r"\[([A-Za-z]+(?:_[A-Za-z]+)+)\]",
]
_OTHER = [
    r"\{\d{0,2}\}|\((?:null|None|undefined|NaN)\)|(?<!\w)_{4,}(?!\w)",
    r"(?<![\w%])%[sd](?!\w)",
    r"\?\?:\?\?|\?{3,}",
    r"(?i)(?<!\w)(?:xx?[/.-]xx?[/.-](?:xx|xxxx|\d\dxx|\d\d\d\d)|dd[/.-]mm[/.-]yyyy|mm[/.-]dd[/.-]yyyy|yyyy[/.-]mm[/.-]dd)(?!\w)",
    r"(?i)\(?x{3}\)?[ .-]?x{3}[ .-]?x{4}",
    r"(?i)(?<!\w)x{4,}(?: x{4,})+(?!\w)|(?<!\w)in yyyy(?!\w)|(?<!\w)from yyyy(?!\w)",
    r"(?i)[\[(<{]\s*(?:insert|enter|type|fill in|put)\s[^\[\](){}<>]{1,200}[\])>}]",
    r"(?i)[\[(<{][^\[\](){}<>]{1,200}\s(?:goes here|here|tbd|tba|to come|pending)\s*[\])>}]",
    r"(?i)[\[<{]\s*(?:your|add|nombre|name|nom|feld|field|champ|campo)(?::|\s)[^\[\](){}<>]{1,200}[\]>}]",
    r"(?<![\w/.<\[{\"'“])(?:NaN|undefined|\[object Object\]|None None|null null)(?![\w/.])(?=\s+(?:is|was|has|of|at|in|and|to|by|please|answers?|can)\b)",
    r"(?:(?:of|by|at|in|for|about|see|the|The|is|with|to|In|At|For|About)\s+)(?:NaN|undefined|null|\[object Object\])(?![\w/-])",
]
_BRACKET = re.compile(r"[\[<{(]\s*([A-Za-z][A-Za-z _-]{2,200}?)\s*[\]>})]")
_SHOUT = re.compile(r"[<\[{]\s*[A-Z]{3,}(?:[ _][A-Z]+)*\s*[>\]}]")
_PLAIN_ANY = re.compile("|".join(f"(?:{p})" for p in _PLAIN))
_OTHER_EACH = [re.compile(p) for p in _OTHER]


def _field(name: str) -> str:
    return re.sub(r"[\s_.-]+", " ", name).strip().lower()


def fields_of(text: str) -> list[str]:
    return [_field(next(g for g in m.groups() if g is not None)) for m in _PLAIN_ANY.finditer(text)]


def has_slot(text: str) -> bool:
    """Whether a text holds an unfilled slot by its syntax, or words in capitals in brackets amid text that isn't."""
    text = html.unescape(text) if "&" in text else text
    if _PLAIN_ANY.search(text) or any(p.search(text) for p in _OTHER_EACH):
        return True
    letters = [c for c in text if c.isalpha()]
    return bool(letters) and sum(c.isupper() for c in letters) < 0.5 * len(letters) and _SHOUT.search(text) is not None


def in_brackets(text: str) -> set[str]:
    """What a text has in brackets: it is an unfilled slot if it is the name of a field; other uses are ordinary."""
    text = html.unescape(text) if "&" in text else text
    return {_field(m.group(1)) for m in _BRACKET.finditer(text)}


def find_residue(texts: DataFrame, id: str, text: str, similarity: float = SIMILARITY) -> DataFrame:
    """Columns desc_id, kind (filler, error, notice, other or slot; the first of these in the alphabet that holds): one
    row for each id whose text holds residue, alone or amid real sentences.

    Null, empty and blank texts are no residue. A repeated id gives one row, a null id none. An empty table gives no
    rows. Texts are read whole; extra columns are ignored. ``similarity`` above 1 leaves every message alone, without
    templates, to measure what they do.
    """
    import pyarrow as pa

    rows = texts.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text")).where("id is not null and trim(text) <> ''")
    id_type = rows.schema["id"].dataType.simpleString()

    def slots(batches):
        for b in batches:
            ids, texts_ = b.column(0).to_pylist(), b.column(1).to_pylist()
            out = []
            for i, t in zip(ids, texts_):
                if has_slot(t):
                    out.append((i, None, None))
                out += [(None, f, None) for f in fields_of(t)] + [(i, None, f) for f in in_brackets(t)]
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], names=["id", "field", "held"])

    seen = written(rows.mapInArrow(slots, f"id {id_type}, field string, held string"), "slots")
    fields = seen.where("field is not null").groupBy("field").agg(F.count("*").alias("n")).where(f"n >= {FIELD_SEEN} and length(field) >= 2").select(F.col("field").alias("held"))
    open_slots = seen.where("field is null and held is null").select("id").unionByName(seen.where("held is not null").join(fields, "held", "left_semi").select("id"))
    bad = judge_templates(mine_templates(rows, "text", similarity))
    held = rows.select("id", F.explode(F.array_distinct(messages(F.col("text")))).alias("message")).join(bad, "message").select("id", "kind")
    found = held.unionByName(open_slots.select("id", F.lit("slot").alias("kind")))
    return found.groupBy("id").agg(F.min("kind").alias("kind")).select(F.col("id").alias("desc_id"), "kind")

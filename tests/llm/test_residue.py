import pytest

from plumbline.llm import residue

BAD = ["Lorem ipsum dolor sit amet, consectetur elit.", "Your text goes here.", "Page not found.", "Internal server error", "Error 500: something went wrong", "Please enable JavaScript to continue.", "Checking your browser before you continue.", "This account has been suspended.", "qwerty foo xxx bar", "ValueError: cannot read property of null", "Your session has expired.", "Verify you are human by completing the action below.", "TODO: ask the clerk"]
GOOD = ["A page of the charter was not found until 1950, when a mason opened the wall.", "Evening classes teach JavaScript and welding.", "Errors in a bill can be reported at the desk.", "The service is unavailable on public holidays; use the drop box.", "Security checks at the gate take a moment on busy days.", "Staff deny access to the dam when the water is high.", "Its motto, \"aqua et lumen\", is cut above the door.", "The unit issues placeholders for letters that are being repaired.", "Requests are refused when letters carry the wrong number.", "The help desk answers about 404 calls a month.", "The clinic offers a free hearing test not a robot.", "Please clear your browser history at home.", "The library's 3d robot club has a captcha workshop.", "Staff can support JavaScript coding camps."]
SLOTS = ["Call {{phone}} now", "At ${office_hours} we", "By <%= city %>.", "__CITY__ hall", "[INSERT city HERE] is", "Open ??:??", "Call (xxx) xxx-xxxx", "on DD/MM/YYYY by", "the [your mission] of", "about %s and", "{0} was", "run by NaN is", "(null) is"]
NO_SLOTS = ["Members are {in order of seniority} three.", "Residents <of any age> may join.", "Rates [see Section 5] rose 5% in 1990.", "turn on [blue switch] lamp", "$18 {sic} more"]


@pytest.mark.parametrize("text", BAD)
def test_bad(text):
    assert residue.classify(text.lower().rstrip("."), {})


@pytest.mark.parametrize("text", GOOD)
def test_good(text):
    assert residue.classify(text.lower().rstrip("."), {}) is None


def test_slots():
    for s in SLOTS:
        assert residue.has_slot(s), s
    for s in NO_SLOTS:
        assert not residue.has_slot(s), s
        assert not residue.has_slot(s.upper()), s
    assert residue.in_brackets("PEOPLE OF <CITY> MAY [see Section]") == {"city", "see section"}
    assert residue.fields_of("{{ city_name }} and [[" + "x" * 150 + "]]") == ["city name", "x" * 150]


def test_templates_decide(spark):
    """A notice that the seed doesn't know, about things of which real sentences speak: its words are learned from
    notices that the seed knows, but only its template, in which those things are variable, tells it."""
    things = [f"{a} {b}" for a in ("museum", "garden", "school", "harbor", "market") for b in ("hall", "desk", "shop", "tower", "court")]
    real = [f"{w} {t} of the children {v} in {m}." for t in things for w, v in (("The old", "is liked best"), ("Every", "was painted"), ("Our", "opens again")) for m in ("May", "June")]
    notice = "helper programs must run now for every new page and new form"
    known = [f"{x}: {notice}." for x in ("Enable JavaScript", "Please allow JavaScript", "JavaScript is needed", "First turn on JavaScript", "Your browser has no JavaScript", "JavaScript is blocked")]
    new = [f"{notice.capitalize()} of the {t}." for t in things]
    df = spark.createDataFrame(list(enumerate([*real, *known, *new])), "id long, t string")
    first = len(real) + len(known)
    got = {sim: {r.desc_id for r in residue.find_residue(df, "id", "t", sim).collect()} for sim in (residue.SIMILARITY, 2)}
    assert got[residue.SIMILARITY] == set(range(len(real), first + len(new)))
    assert got[2] != got[residue.SIMILARITY] and not any(i < len(real) for i in got[2])


def test_model_rejects_and_takes_in():
    model = residue.fit_model([*(("access denied to this server", "error"),) * 6, *(("the film access denied was shown in may", None),) * 40])
    assert residue.classify("access denied to this server", model) and not residue.classify("the film access denied was shown in may", model)
    assert residue.fit_model([("a b", None)]) == {}


def test_tree_keeps_marks():
    t = residue.PrefixTree()
    a, b, c = (t.add(x.split()) for x in ("the office of foo opened a new hall in may", "the office of bar opened a new hall in june", "the office of foo opened a new error in may"))
    assert a == b and c != a and t.templates[0].count("<*>") == 2


def test_documents(spark):
    rows = list(enumerate([*BAD, *GOOD, *(f"Nice people. {s} Good." for s in SLOTS), *NO_SLOTS, None, "", "  ", "Fine town. " * 5000 + "Access denied."]))
    df = spark.createDataFrame(rows + [(0, BAD[0]), (None, BAD[0])], "desc_id long, d string").selectExpr("desc_id", "d", "'x' as message", "1 as kind")
    got = sorted(r.desc_id for r in residue.find_residue(df, "desc_id", "d").collect())
    want = [i for i, t in rows if t in BAD or (t or "").startswith("Nice") or (t or "").startswith("Fine")]
    assert got == want
    assert residue.find_residue(df.limit(0), "desc_id", "d").count() == 0

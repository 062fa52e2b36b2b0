import numpy as np

from plumbline.llm import reading

EASY = "The cat sat on the mat. We like to run. You can see the bus. It is red and big. My dad will help you. "
HARD = "Notwithstanding the aforementioned considerations, the intergovernmental commission has comprehensively reevaluated administrative responsibilities, allocating supplementary appropriations to municipalities demonstrating extraordinary infrastructural deterioration. "
SPANISH = "La oficina de la ciudad ofrece ayuda a las familias que viven lejos y el consejo se reúne cada mes para hablar de los árboles. "


def test_syllables():
    for w, n in {"cat": 1, "table": 2, "made": 1, "water": 2, "agency": 3, "used": 1, "wanted": 2, "municipality": 6, "create": 2, "boxes": 2, "the": 1, "a": 1}.items():
        assert abs(reading.syllables(w) - n) <= (0 if n < 3 else 1), w


def test_sentences():
    text = "1. One two.\r\n- Three four\nfive six; Seven. <b>Eight</b> nine &amp; ten!\n\n\n"
    assert list(reading.sentences(text)) == ["One two.", "Three four five six;", "Seven.", "Eight  nine & ten!"]


def test_robust_grades():
    plain = reading.measure(EASY * 4, {})
    mixed = reading.measure(EASY * 4 + HARD, {})
    assert plain[0] < 5 and abs(mixed[0] - plain[0]) < 6 and reading.measure(HARD, {})[0] > 20
    assert plain[4] and not reading.measure(SPANISH * 4, {})[4]
    for t in (None, "", " ", "12 34", "漢字かな", "x=1;y=2"):
        assert not reading.measure(t, {})[4]


def test_cuts():
    g, b = np.array([1.0, 2, 3, 10, 11, 12, 20]), np.array([1, 1, 1, 2, 2, 2, 3])
    cuts = reading.fit_cuts(g, b, (5.0, 15.0, 30.0))
    assert 3 < cuts[0] <= 10 and 12 < cuts[1] <= 20 and cuts[2] == 30.0
    assert reading.fit_cuts(np.array([]), np.array([]), (5.0, 4.0, 30.0)) == [5.0, 5.0, 30.0]


def test_documents(spark):
    rows = [(1, EASY * 6, "fr"), (2, HARD * 4, None), (3, SPANISH * 6, "en"), (4, EASY, "en"), (5, None, "en"), (6, "", "en"), (7, EASY * 3000, "en"), (1, EASY * 6, "en"), (None, EASY * 6, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as band", "2 as words")
    labels = spark.createDataFrame([(1, 1), (2, 4), (2, 4), (99, 2), (None, 1), (3, None)], "doc_id long, band int")
    got = sorted((r.doc_id, r.band) for r in reading.reading_bands(df, labels, "doc_id", "text").collect())
    assert got == [(1, 1), (1, 1), (2, 4), (7, 1)]
    default = sorted((r.doc_id, r.band) for r in reading.reading_bands(df, labels.limit(0), "doc_id", "text").collect())
    assert [i for i, _ in default] == [i for i, _ in got] and default[0][1] == 1 and default[2][1] >= 3
    assert reading.reading_bands(df.limit(0), labels, "doc_id", "text").count() == 0


def test_labelled_accuracy(spark, data):
    """Cuts fitted on half of the labels, tried on the other half."""
    from plumbline.session import table

    big = data.replace("sf0.001", "sf0.1")
    labels = table(spark, big, "reading_labels")
    fitted = reading.reading_bands(table(spark, big, "documents"), labels.where("doc_id % 2 = 0"), "doc_id", "text")
    held = labels.where("doc_id % 2 = 1").join(fitted.withColumnRenamed("band", "got"), "doc_id", "left")
    rows = held.collect()
    assert sum(r.band == r.got for r in rows) / len(rows) >= 0.93

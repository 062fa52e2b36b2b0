import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plumbline.llm import encode

PATH = os.path.join(encode.TOKENIZERS, "byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no tokenizer files")


@pytest.fixture(scope="module")
def truth():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def merger():
    return encode.Merger(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(truth, merger, text):
    assert [i for w in encode.words_of(text) for i in merger.ids(w.encode())] == truth(text)


@pytest.mark.parametrize("text", ["a" * 1000, "abcdefghij" * 200, "é" * 700, "zzzzzzqqxx" * 90, "  x　　y\n\n z", "a\x1cb \x1c\x1d c", "<|endoftext|> a\x00b", "don't DON'T 12ab ٣٤"])
def test_odd_texts(truth, merger, text):
    assert [i for w in encode.words_of(text) for i in merger.ids(w.encode())] == truth(text)


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = {w: [k, k + 1] for k, w in enumerate(["tap", "taps", "top", "tops", "é", "a", "stop", "stops"])}
    lex = encode.compile_lexicon(words)
    assert len(lex["final"]) < 12  # shared endings
    path = tmp_path / "lex.bin"
    path.write_bytes(encode.to_bytes(lex))
    back = encode.open_lexicon(str(path))
    asked = [*words, "ta", "tapss", "", "x"]
    at = encode.look_up(back, asked)
    for w, i in zip(asked, at):
        assert (back["ids"][back["start"][i] : back["start"][i + 1]].tolist() if i >= 0 else None) == words.get(w)
    empty = encode.compile_lexicon({})
    assert encode.look_up(empty, ["a"]).tolist() == [-1]


def test_documents(spark, truth):
    rows = [(1, "Hello there, hello there"), (2, None), (3, ""), (4, "hello " * 5000), (5, "naïve ‘quotes’ \r\n\n x"), (5, "naïve"), (None, "x"), (6, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'z' as ids")
    got = sorted(((r.doc_id, list(r.ids)) for r in encode.encode(df, "doc_id", "text", limit=3).collect()), key=str)
    assert got == sorted(((i, truth(t or "")) for i, t in rows), key=str)
    assert encode.encode(df.limit(0), "doc_id", "text").count() == 0

"""The agenda of symbol pairs against the sentencepiece library."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from panelyze.llm import pieces
from tests.llm.cases import DOC_SCHEMA, odd_docs, odd_rows

PATH = public_tokenizers.path(pieces.MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def expected(text):
    ids = LIBRARY.encode(text or "")
    decoded = LIBRARY.decode(ids)
    return ids, decoded


@given(st.text(alphabet=st.sampled_from("abcdeth  ▁.,\n\t'é漢ﬁ<0xA>ü\u0000🙂"), max_size=60) | st.text(max_size=40))
@settings(max_examples=400, deadline=None)
def test_agenda_equals_library(text):
    text = text.encode("utf-8", "ignore").decode()
    own, _ = pieces.merger(PATH)
    assert own.encode(text) == LIBRARY.encode(text)
    assert own.merged(text) == own.merged_short(text)


@given(st.text(alphabet=st.sampled_from("ab ▁\n"), max_size=80), st.integers(1, 10))
@settings(max_examples=300, deadline=None)
def test_parts_encode_on_their_own(text, limit):
    parts = list(pieces.text_parts(text, limit))
    ids = [LIBRARY.encode(p) for p in parts]
    assert sum(ids, []) == LIBRARY.encode(text)
    assert " ".join(LIBRARY.decode(i) for i in ids) == LIBRARY.decode(sum(ids, []))


def test_odd_documents(spark):
    docs = odd_docs(spark)
    got = sorted((tuple(r) for r in pieces.digests(docs, PATH).collect()), key=str)
    want = []
    for r in odd_rows():
        ids, decoded = expected(r[1])
        shas = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded)]
        want.append((r[0], len(ids), *shas))
    assert got == sorted(want, key=str)
    whole = sorted(((r["doc_id"], list(r["ids"]), r["decoded"]) for r in pieces.encode(docs, PATH).collect()), key=str)
    assert whole == sorted(((r[0], *expected(r[1])) for r in odd_rows()), key=str)


def test_long_text_in_parts(spark, monkeypatch):
    # Also a stretch without any single space.
    text = "some  words here " * 900 + "x" * 5000 + "  " * 300 + " end of it"
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 500)
    assert len(list(pieces.text_parts(text, 500))) > 10
    together = [(i, ids, back) for i, ids, back in pieces.encoded_parts([text, "", text], PATH)]
    assert sum((ids for i, ids, _ in together if i == 2), []) == LIBRARY.encode(text)
    assert " ".join(back for i, _, back in together if i == 0) == LIBRARY.decode(LIBRARY.encode(text))


def test_a_difference_from_the_library_is_an_error(monkeypatch):
    own = pieces.Merger(PATH)
    own.encode("some text\n\n  with ▁ marks, 漢字 and ü\u0000")
    own.check(LIBRARY)
    assert own.fresh == []
    # Left to right instead of by score.
    monkeypatch.setattr(own, "merged_short", lambda text: list(text))
    own.encode("unmerged")
    with pytest.raises(AssertionError):
        own.check(LIBRARY)


@given(st.text(alphabet=st.sampled_from("abcdeth  ▁.,\n\t'é漢<0xA>\u0000🙂"), max_size=60))
@settings(max_examples=200, deadline=None)
def test_check_accepts_what_the_library_gives(text):
    own, _ = pieces.merger(PATH)
    own.known.clear()
    own.known.older.clear()
    own.encode(text)
    own.check(LIBRARY)


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert pieces.digests(empty, PATH).collect() == [] and pieces.encode(empty, PATH).collect() == []

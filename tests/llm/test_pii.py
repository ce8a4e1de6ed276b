"""Base spans against the literal patterns, the field on planted repeats, odd tables."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from panelyze.llm import pii

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def literal(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m.group())
            if k == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if k == 2 and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((k, *m.span()))
    return out


@settings(max_examples=1500, deadline=None, derandomize=True)
@given(st.text(alphabet="aZ09 4.@+-()%_é\n12", max_size=60))
def test_base_spans_are_the_literal_patterns(text):
    assert pii.base_spans(text) == literal(text)


def test_luhn_and_long_runs_are_linear():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    long = "a" * 300_000 + " " + "1" * 300_000 + " " + "@" * 100_000
    assert pii.base_spans(long) == []


def test_repeats_take_the_label_of_the_pattern():
    train = ["call +1 (456) 555-2186 or write bob.4@mail.example.com", "see 2019 and 42 items", "ip 10.1.2.3 at 7"] * 20
    model = pii.train(train)
    text = "Call +1 (456) 555-2186 today. Later 1 456 555 2186 again, or 456-555-2186; in 2019 we sold 42."
    base, spans = pii.find(text, model)
    assert [text[a:b] for _, a, b in base] == ["+1 (456) 555-2186"]
    assert {text[a:b] for k, a, b in spans if k == 3} == {"+1 (456) 555-2186", "1 456 555 2186", "456-555-2186"}
    assert pii.masked(text, spans).count("[PHONE]") == 3
    assert pii.find("in 2019 we sold 42, in 2019 again 42", model) == ([], [])


def test_defined_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a b@c.de +49 (30) 123-4567", "x"), (3, "a b@c.de +49 (30) 123-4567", "x"), (None, "1.2.3.4", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    model = pii.fit(docs)
    got = sorted(pii.detect(docs, model).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    empty = hashlib.sha256(b"").hexdigest()
    assert [(r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got] == [(0, 0, 0, 0), (0, 0, 0, 0), (1, 0, 0, 1), (1, 0, 0, 1), (0, 1, 0, 0)]
    assert got[0].base_sha256 == empty and got[2].spans == "email:2:8,phone:9:26"
    masked = {r.doc_id: r for r in pii.redact(docs, model).collect()}
    assert masked[3].text == "a [EMAIL] [PHONE]" and masked[1].text is None and masked[3].spans == "x"
    none = docs.limit(0)
    assert pii.detect(none, pii.fit(none)).collect() == []

"""Personal data by patterns and a skip-chain conditional random field.

Base spans (email, ip, card, phone) come from fixed patterns.  The field adds
spans that the patterns miss.  Its nodes are a document's mentions: the base
spans, whose labels are observed, and every other run of digits or word with an
@.  Neighbouring mentions are joined as a chain; mentions that repeat (the same
digits, the same address) or are similar (the same last nine digits, the same
address up to its first domain part) are joined by skip edges from one
occurrence to the next, so that evidence for a label reaches all of them.
Labels come from loopy sum-product message passing.  A mention is added if it
has a skip edge and one kind reaches ``SURE``.

Node weights are a multinomial logistic model and edge potentials are smoothed
log-odds of label pairs; both are learned from the base spans of at most
``SAMPLE_DOCS`` documents with at most ``SAMPLE_CHARS`` characters, chosen by a
hash of the id.  Finding spans reads every whole text; work and memory of a
document grow in proportion to its mentions, and nothing is shuffled.

Defined cases: a null text is empty and has no spans; rows that repeat are read
alike; an empty table gives an empty result; without digits or @ in the sample
the field is uniform and adds nothing; further columns are kept by ``redact``
and ignored by the query.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyze.llm.common import table

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
LABELS = OTHER + 1
SURE = 0.9
SAMPLE_DOCS, SAMPLE_CHARS = 3000, 200_000
ROUNDS, DAMPING = 20, 0.3

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+").fullmatch
# A number is only tried at the first digit of a run: later digits of it cannot do better.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+").finditer
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+").finditer
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_SPACE = "\x20\\x09-\\x0D"
_AT_WORD = re.compile(rf"(?<![^{_SPACE}])[^{_SPACE}@]*@[^{_SPACE}]*").finditer
_NUMBER = re.compile(r"[0-9](?:[\x20().\-/:]{0,2}[0-9])*").finditer
_DIGITS = re.compile(r"[^0-9]+")
_TELLING = re.compile(r"[0-9@]").search
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches, found from each @ outward (linear in the text)."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the fixed patterns, by kind, then start."""
    if not _TELLING(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((1, m.start(), m.end()))
    for m in _CARD(text):
        if m.end() - m.start() >= 13:
            digits = _DIGITS.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE(text):
            if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(label, start, end)`` in text order: base spans with their kind, other candidates with -1."""
    taken = sorted((a, b) for _, a, b in base)
    found = [(k, a, b) for k, a, b in base]
    if _TELLING(text):
        i = 0
        words = [m.span() for m in _AT_WORD(text)] if "@" in text else []
        for a, b in sorted(words + [m.span() for m in _NUMBER(text)]):
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            if i < len(taken) and taken[i][0] < b:
                continue
            found.append((-1, a, b))
    return sorted(found, key=lambda m: (m[1], m[2], m[0]))


def _keys(word: str) -> list[str]:
    """What a mention shares with repeated or similar ones."""
    if "@" in word:
        low = word.strip(".,;:!?()<>[]\"'").lower()
        local, _, domain = low.partition("@")
        return ["w" + low, "a" + local + "@" + domain.split(".")[0]] if local and domain else ["w" + low]
    digits = _DIGITS.sub("", word)
    if len(digits) < 6:
        return []
    return ["d" + digits] + (["s" + digits[-9:]] if len(digits) >= 9 else [])


FEATURES = 24


def _features(text: str, start: int, end: int) -> list[int]:
    word = text[start:end]
    digits = _DIGITS.sub("", word)
    n = len(digits)
    out = [0, 1 + min(n, 20) // 2]  # 1..11: digits by twos
    tests = (
        "@" in word,
        "@" in word and "." in word.partition("@")[2],
        word.count(".") == 3,
        "(" in word or ")" in word,
        "-" in word,
        " " in word,
        13 <= n <= 19 and luhn(digits),
        9 <= n <= 15,
        n == len(word),
        start > 0 and text[start - 1].isalpha(),
    )
    return out + [12 + i for i, t in enumerate(tests) if t]


def edges(text: str, nodes: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Chain and skip edges as index pairs; a skip edge goes to the next mention of the same key."""
    n = len(nodes)
    chain = np.stack([np.arange(n - 1), np.arange(1, n)], 1) if n > 1 else np.empty((0, 2), np.int64)
    last: dict[str, int] = {}
    skip = set()
    for i, (_, a, b) in enumerate(nodes):
        for key in _keys(text[a:b]):
            if key in last:
                skip.add((last[key], i))
            last[key] = i
    return chain, np.array(sorted(skip), dtype=np.int64).reshape(-1, 2)


def _odds(pairs: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Clipped log-odds of label pairs against independence, symmetric, with ``prior`` pseudo-counts."""
    joint = pairs + pairs.T + prior
    joint = joint / joint.sum()
    side = joint.sum(1)
    return np.clip(np.log(joint / np.outer(side, side)), -3.0, 3.0)


def train(texts: list[str]) -> dict:
    rows, labels = [], []
    chain_pairs, skip_pairs = np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS))
    for text in texts:
        nodes = mentions(text, base_spans(text))
        y = np.array([k if k >= 0 else OTHER for k, _, _ in nodes], dtype=np.int64)
        chain, skip = edges(text, nodes)
        np.add.at(chain_pairs, (y[chain[:, 0]], y[chain[:, 1]]), 1)
        np.add.at(skip_pairs, (y[skip[:, 0]], y[skip[:, 1]]), 1)
        for (_, a, b), k in zip(nodes, y):
            f = np.zeros(FEATURES)
            f[_features(text, a, b)] = 1
            rows.append(f)
            labels.append(k)
    w = np.zeros((FEATURES, LABELS))
    if rows:
        x, hot = np.array(rows), np.eye(LABELS)[labels]
        for _ in range(300):
            z = x @ w
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            w -= 1.0 * (x.T @ (p - hot) / len(x) + 1e-3 * w)
    # Beforehand neighbours say nothing of each other, and a repeated mention mostly is the same thing.
    chain = _odds(chain_pairs, np.full((LABELS, LABELS), 4.0))
    return {"w": w, "chain": chain, "skip": _odds(skip_pairs, 0.5 + 9.5 * np.eye(LABELS))}


def marginals(unary: np.ndarray, pairs: np.ndarray, potentials: np.ndarray) -> np.ndarray:
    """Node label probabilities by loopy sum-product; ``potentials[e]`` is the log potential of edge e (symmetric)."""
    n = len(unary)
    src = np.concatenate([pairs[:, 0], pairs[:, 1]])
    dst = np.concatenate([pairs[:, 1], pairs[:, 0]])
    m = len(pairs)
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    pot = np.concatenate([potentials, potentials])
    msg = np.zeros((2 * m, LABELS))

    def gathered():
        total = unary.copy()
        for k in range(LABELS):
            total[:, k] += np.bincount(dst, weights=msg[:, k], minlength=n)
        return total

    for _ in range(ROUNDS if m else 0):
        out = gathered()[src] - msg[back]
        z = out[:, :, None] + pot
        top = z.max(1)
        new = top + np.log(np.exp(z - top[:, None, :]).sum(1))
        new -= new.max(1, keepdims=True)
        moved = np.abs(new - msg).max()
        msg = DAMPING * msg + (1 - DAMPING) * new
        if moved < 1e-4:
            break
    b = gathered()
    p = np.exp(b - b.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def find(text: str, model: dict) -> tuple[list, list]:
    """Base spans and all spans of one text, each sorted by kind, then start."""
    base = base_spans(text)
    nodes = mentions(text, base)
    free = [i for i, m in enumerate(nodes) if m[0] < 0]
    if not free or len(nodes) < 2:
        return base, base
    chain, skip = edges(text, nodes)
    if not len(skip):
        return base, base
    linked = np.zeros(len(nodes), bool)
    linked[skip.ravel()] = True
    if not linked[free].any():
        return base, base
    unary = np.zeros((len(nodes), LABELS))
    for i, (k, a, b) in enumerate(nodes):
        if k >= 0:
            unary[i] = -30.0
            unary[i, k] = 0.0
        else:
            unary[i] = model["w"][_features(text, a, b)].sum(0)
    pot = np.concatenate(
        [np.broadcast_to(model["chain"], (len(chain), LABELS, LABELS)), np.broadcast_to(model["skip"], (len(skip), LABELS, LABELS))]
    )
    p = marginals(unary, np.concatenate([chain, skip]), pot)
    best = p.argmax(1)
    extra = [(int(best[i]), nodes[i][1], nodes[i][2]) for i in free if linked[i] and best[i] != OTHER and p[i, best[i]] >= SURE]
    return base, sorted(base + extra)


def as_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def fit(docs: DataFrame) -> dict:
    """Train on a bounded sample of the documents that hold a digit or an @."""
    ids = docs.where(F.length("text") <= SAMPLE_CHARS).where(F.col("text").rlike("[0-9@]"))
    few = ids.select("doc_id", F.xxhash64(F.lit(10), "doc_id").alias("h")).orderBy("h", "doc_id").limit(SAMPLE_DOCS)
    few = few.select(F.col("doc_id").alias("sample_id")).distinct()
    # At most SAMPLE_DOCS ids.
    chosen = docs.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("sample_id"))
    cut = chosen.where(F.length("text") <= SAMPLE_CHARS).select("text").distinct().orderBy(F.xxhash64("text"), "text")
    return train([r["text"] for r in cut.limit(SAMPLE_DOCS).toLocalIterator()])


RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def detect(docs: DataFrame, model: dict) -> DataFrame:
    """``RESULT`` rows, one per document."""

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                base, spans = find(text or "", model)
                n = [sum(k == i for k, _, _ in base) for i in range(len(KINDS))]
                out.append((*n, hashlib.sha256(as_text(base).encode()).hexdigest(), as_text(spans)))
            cols = list(zip(*out)) if out else [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(c, pa.string()) for c in cols[4:]]
            names = [c.split()[0] for c in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64())] + arrays, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def masked(text: str, spans) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with the spans in ``text`` masked; all other columns as they were."""
    schema = docs.schema

    def run(batches):
        for batch in batches:
            i = batch.schema.get_field_index("text")
            texts = [None if t is None else masked(t, find(t, model)[1]) for t in batch.column(i).to_pylist()]
            yield batch.set_column(i, batch.schema.field(i), pa.array(texts, batch.schema.field(i).type))

    return docs.mapInArrow(run, schema)


def op10_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return detect(docs, fit(docs))

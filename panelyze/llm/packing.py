"""Packing token sequences into fixed windows by non-negative least squares.

Every document becomes token ids and an end id.  Whole windows are cut off its
front and stand alone; what is left, the tail, is shorter than the window.  The
histogram of tail lengths has one bin for each length, however large the
corpus.  On it

1. shallow combinations (two or three lengths) that fill a window exactly are
   enumerated,
2. non-negative least squares finds how often to repeat each so that together
   they use up the histogram,
3. the counts are rounded along the list of combinations, so that sums stay,
   and clipped to what a bin still holds,
4. what is left over is packed greedily, longest first, each gap filled with
   the longest length that fits and in the end by cutting a longer tail.

The outcome is a plan: for a tail length and a range of ranks, the piece, its
sequence and its offset.  A tail finds its pieces by its rank among the tails of
its length.  Nearly every sequence is full.

Scale: the text is read once; the token table holds tails only, two or four
bytes an id; ranks are a running number within a partition plus the counts of
the partitions before; histogram and plan are bounded by the window.

Defined cases: a null or empty text is the end id alone; a text of any length is
cut whole; the strings of added tokens (``<|endoftext|>``) have those tokens'
ids; rows that repeat are documents of their own; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections import deque

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelyze.llm.common import save, table

WINDOW = 1024
END_ID = 0
VOCABULARY = "byte_bpe_50k"
# Triples are enumerated with a shortest part that is a multiple of this.
SHORT_STEP = 16
CACHED_WORDS = 300_000
# Beyond this a run without spaces goes to the library that has no depth limit.
LONG_RUN = 100_000

_ENCODERS: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Byte-level BPE ids of a text, looked up word by word.

    The added tokens of the vocabulary's JSON stand for their own ids; a text is
    cut at them, the longest first, and the parts are encoded apart.
    The vocabulary's split pattern always starts a new token at a space that a
    non-space follows, so a text cut there can be encoded part by part, and most
    parts repeat.  Texts with other white space after a space are encoded whole.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.json = public_tokenizers.path(f"{vocabulary}.json")
        self.bpe = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        with open(self.json, encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added tokens of {vocabulary} are not plain strings")
        self.added = {t["content"]: t["id"] for t in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.dtype = np.uint16 if max([len(ranks) - 1, *self.added.values()]) < 1 << 16 else np.uint32
        self.known: dict[str, bytes] = {}
        self.plain = None
        self.odd_space = re.compile(r" (?:\s|$)").search

    def raw(self, text: str) -> bytes:
        if len(text) > LONG_RUN and max(map(len, text.split(" "))) > LONG_RUN:
            if self.plain is None:
                from tokenizers import Tokenizer

                self.plain = Tokenizer.from_file(self.json)
                self.plain.encode_special_tokens = True
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        return np.array(self.bpe.encode_ordinary(text), self.dtype).tobytes()

    def __call__(self, text: str) -> bytes:
        if self.at_added is None or not self.at_added.search(text):
            return self.ordinary(text)
        parts = self.at_added.split(text)
        # Every second part is an added token.
        return b"".join(
            np.array([self.added[p]], self.dtype).tobytes() if i % 2 else self.ordinary(p) for i, p in enumerate(parts)
        )

    def ordinary(self, text: str) -> bytes:
        if not text:
            return b""
        if self.odd_space(text):
            return self.raw(text)
        first, *rest = text.split(" ")
        known, out = self.known, [self.raw(first)]
        for w in rest:
            ids = known.get(w)
            if ids is None:
                if len(known) > CACHED_WORDS:
                    known.clear()
                ids = known[w] = self.raw(" " + w)
            out.append(ids)
        return b"".join(out)


def encoder(vocabulary: str) -> WordEncoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = WordEncoder(vocabulary)
    return _ENCODERS[vocabulary]


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


TOKEN_SCHEMA = (
    "part int, doc_id long, doc_tokens long, full_before long, crcs array<long>, tail int, tail_rank long, tail_ids binary"
)


def tokenised(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: checksums of its whole windows, its tail, and its rank among its partition's tails."""

    def encode(batches):
        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        seen, fulls = np.zeros(window, np.int64), 0
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids = np.frombuffer(enc(text) if isinstance(text, str) else b"", enc.dtype)
                ids = np.append(ids, enc.dtype(END_ID))
                whole, tail = divmod(len(ids), window)
                crcs = [crc_of(ids[i * window : (i + 1) * window]) for i in range(whole)]
                out.append((part, doc_id, len(ids), fulls, crcs, tail, seen[tail], ids[whole * window :].tobytes()))
                fulls += whole
                seen[tail] += 1
            out = pd.DataFrame(out, columns=[c.split()[0] for c in TOKEN_SCHEMA.split(", ")])
            yield out.astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(encode, TOKEN_SCHEMA)


def combinations(window: int, step: int = SHORT_STEP) -> np.ndarray:
    """Rows of three lengths (0: none) that sum to the window, longest first."""
    pairs = [(window - a, a, 0) for a in range(1, window // 2 + 1)]
    triples = [
        (window - a - b, b, a) for a in range(step, window // 3 + 1, step) for b in range(a, (window - a) // 2 + 1)
    ]
    return np.array(sorted(pairs + triples, reverse=True), dtype=np.int64).reshape(-1, 3)


def nnls(combos: np.ndarray, hist: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Repeat counts x >= 0 that bring the lengths used near ``hist`` (accelerated projected gradient)."""
    bins = len(hist)

    def used(x):
        u = np.bincount(combos.ravel(), weights=np.repeat(x, 3), minlength=bins)
        u[0] = 0
        return u

    def pulled(r):
        return r[combos].sum(axis=1)

    v = np.ones(len(combos))
    for _ in range(30):  # largest eigenvalue of A'A
        w = pulled(used(v))
        norm = np.linalg.norm(w) / np.linalg.norm(v)
        v = w / np.linalg.norm(w)
    scale = max(1.0, hist.sum())
    h = hist / scale
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        r = h - used(y)
        r[0] = 0
        nxt = np.maximum(0, y + pulled(r) / (1.01 * norm))
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x * scale


class Supply:
    """Tail pieces by length, each a range of ranks of the tails it comes from."""

    def __init__(self, hist: np.ndarray):
        self.count = hist.copy()
        self.parts = [deque([(n, 0, int(c), 0, 0)]) if c else deque() for n, c in enumerate(hist.tolist())]

    def take(self, length: int, n: int):
        self.count[length] -= n
        while n:
            tail, lo, hi, start, layer = self.parts[length].popleft()
            m = min(n, hi - lo)
            if lo + m < hi:
                self.parts[length].appendleft((tail, lo + m, hi, start, layer))
            yield tail, lo, lo + m, start, layer
            n -= m

    def give(self, length: int, part) -> None:
        self.parts[length].append(part)
        self.count[length] += part[2] - part[1]


PLAN = ("layer", "tail", "lo", "hi", "start", "length", "sequence", "offset")


def pack_plan(hist: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Rows of ``PLAN``: tails ``tail`` of rank lo to hi put ``length`` ids from ``start`` into sequences from ``sequence`` on."""
    supply, rows, sequence = Supply(hist), [], 0

    def place(lengths, times: int, cut: tuple[int, int] | None = None) -> None:
        nonlocal sequence
        offset = 0
        for length, source in [(n, n) for n in lengths] + ([cut] if cut else []):
            at = sequence
            for tail, lo, hi, start, layer in supply.take(source, times):
                rows.append((layer, tail, lo, hi, start, length, at, offset))
                if source > length:
                    supply.give(source - length, (tail, lo, hi, start + length, layer + 1))
                at += hi - lo
            offset += length
        sequence += times

    if hist.sum():
        combos = combinations(window)
        x = nnls(combos, hist.astype(float))
        steps = np.floor(np.cumsum(x) + 0.5).astype(np.int64)
        want = np.diff(steps, prepend=0)
        for j in np.argsort(-want, kind="stable"):
            if want[j] <= 0:
                break
            lengths, uses = np.unique(combos[j][combos[j] > 0], return_counts=True)
            times = int(min(want[j], (supply.count[lengths] // uses).min()))
            if times > 0:
                place([int(n) for n in combos[j] if n], times)
    while (left := np.flatnonzero(supply.count)).size:
        free, lengths, held = window, [], supply.count.copy()
        while free and (fit := np.flatnonzero(held[: free + 1])).size:
            n = int(fit[-1])
            k = int(min(held[n], free // n))
            lengths += [n] * k
            held[n] -= k
            free -= n * k
        used, uses = np.unique(lengths, return_counts=True)
        times = int((supply.count[used] // uses).min())
        cut = None
        if free and (longer := np.flatnonzero(held)).size:
            source = int(longer[-1])
            cut = (free, source)
            need = int(uses[used == source][0]) + 1 if source in used else 1
            times = min(times, int(supply.count[source]) // need)
        place(lengths, times, cut)
    plan = np.array(rows, dtype=np.int64).reshape(-1, len(PLAN))
    return plan[np.lexsort((plan[:, 2], plan[:, 1], plan[:, 0]))]


PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece (``PIECE_SCHEMA``); sequences of ``window`` tokens, nearly all full."""
    tokens = save(tokenised(docs, window, vocabulary), "pack-tokens")
    counts = save(tokens.groupBy("tail", "part").agg(F.count("*").alias("rows")), "pack-counts")
    # One bin for each tail length: at most ``window`` rows reach the driver.
    hist = np.zeros(window, np.int64)
    for r in counts.where("tail > 0").groupBy("tail").agg(F.sum("rows").alias("n")).collect():
        hist[r["tail"]] = r["n"]
    plan = pack_plan(hist, window)
    bits = 44
    keys = ((plan[:, 0] * window + plan[:, 1]) << bits) + plan[:, 2]
    layers = int(plan[:, 0].max()) + 1 if len(plan) else 0
    before = W.partitionBy("tail").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    heads = counts.select("tail", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("head"))
    placed = tokens.join(save(heads, "pack-heads"), ["tail", "part"])
    dtype = encoder(vocabulary).dtype

    def cut(batches):
        for pdf in batches:
            out = []
            tail = pdf["tail"].to_numpy(np.int64)
            rank = pdf["tail_rank"].to_numpy(np.int64) + pdf["head"].to_numpy(np.int64)
            doc_ids, totals, ids = pdf["doc_id"].tolist(), pdf["doc_tokens"].to_numpy(), pdf["tail_ids"].tolist()
            for i, (part, before_, crcs) in enumerate(zip(pdf["part"], pdf["full_before"], pdf["crcs"])):
                base = ((int(part) + 1) << bits) + int(before_)
                for j, crc in enumerate(crcs):
                    out.append((doc_ids[i], j * window, window, int(crc), totals[i], base + j, 0))
            for layer in range(layers):
                at = np.searchsorted(keys, ((layer * window + tail) << bits) + rank, "right") - 1
                row = plan[np.maximum(at, 0)]
                hit = (at >= 0) & (row[:, 0] == layer) & (row[:, 1] == tail) & (rank < row[:, 3])
                for i in np.flatnonzero(hit & (tail > 0)):
                    _, _, lo, _, start, length, seq, offset = row[i].tolist()
                    piece = np.frombuffer(ids[i], dtype)[start : start + length]
                    at_doc = int(totals[i]) - int(tail[i]) + start
                    out.append((doc_ids[i], at_doc, length, crc_of(piece), totals[i], seq + int(rank[i]) - lo, offset))
            out = pd.DataFrame(out, columns=[c.split()[0] for c in PIECE_SCHEMA.split(", ")])
            yield out.astype({"doc_id": "Int64"})

    return placed.mapInPandas(cut, PIECE_SCHEMA)


def op2_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

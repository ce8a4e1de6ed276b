"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.
Both hold the same base, trained on windows of ordinary documents, so that
ordinary language compresses alike under either; the toxic one goes on with
what training on toxic documents finds typical of them, the ordinary one with
neutral filling of the same length, so that distances into the base agree.
Every window of a text is compressed with both.  The saving in bytes is held
against several thresholds; a logistic model, calibrated on labelled documents
that the dictionaries have not seen, turns the counts over the thresholds into
a score.

Bounded fit: at most ``DICT_TOXIC`` toxic and ``DICT_ORDINARY`` ordinary
labelled documents, ``DICT_BYTES`` bytes of each, reach the driver for the
dictionaries; ``CALIBRATION`` labelled documents give one histogram each.
Scoring reads every window of every text and shuffles nothing.

Defined cases: a null or empty text is one empty window and scores as such;
rows that repeat are scored alike; without labels of both kinds every score is
the share of toxic labels, or 0; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from panelyze.llm.common import save, table

WINDOW = 48
LEVEL = 3
BASE_BYTES = 108_000
CLASS_BYTES = (128, 256, 512, 1024, 2048)
HEAD_BYTES = (4, 10)
COMMON = 0.02
THRESHOLDS = (2, 3, 4, 5, 6, 8, 10)
DICT_TOXIC, DICT_ORDINARY, DICT_BYTES, CALIBRATION = 2000, 4000, 65536, 8000
TYPICAL = 10.0  # times as many toxic as ordinary documents hold a typical word
FOLDS = 5

# Lower-cases A-Z and turns the ASCII controls 9-13 into spaces.
_FOLD = bytes(range(256)).translate(
    bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
)


def windows(text: bytes, size: int = WINDOW):
    """Consecutive stretches of about ``size`` bytes, cut at spaces where there are any."""
    at, end = 0, len(text)
    while at < end:
        cut = text.find(b" ", at + size, at + 4 * size)
        cut = min(end, at + 4 * size) if cut < 0 else cut
        yield text[at:cut]
        at = cut


class Distance:
    """Histogram over ``THRESHOLDS`` of the bytes that the toxic dictionary saves on each window."""

    def __init__(self, base: bytes, typical: bytes):
        self.ordinary = self._compressor(base + b"\xff" * len(typical))
        self.toxic = self._compressor(base + typical)

    @staticmethod
    def _compressor(content: bytes):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        p = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, source_size=2 * WINDOW, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False
        )
        d.precompute_compress(compression_params=p)
        return zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress

    def counts(self, text: str | None) -> list[int]:
        """Number of windows, then the windows at or over each threshold."""
        ordinary, toxic = self.ordinary, self.toxic
        raw = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
        saved = Counter(len(ordinary(w)) - len(toxic(w)) for w in windows(raw))
        return [max(1, sum(saved.values()))] + [sum(n for d, n in saved.items() if d >= t) for t in THRESHOLDS]


def features(counts: np.ndarray) -> np.ndarray:
    n, over = counts[:, :1].astype(float), counts[:, 1:].astype(float)
    return np.hstack([np.log1p(over), np.sqrt(over / n), np.log(n)])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> dict:
    """Weights, centre and spread of a ridge logistic model (Newton steps)."""
    centre, spread = x.mean(0), x.std(0) + 1e-6
    z = np.hstack([(x - centre) / spread, np.ones((len(x), 1))])
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return {"w": w, "centre": centre, "spread": spread}


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    z = (x - model["centre"]) / model["spread"] @ model["w"][:-1] + model["w"][-1]
    # Rounded, so that equal texts score alike in whatever batch they stand.
    return np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 12)


def _cover(samples: list[bytes], size: int) -> bytes:
    """Content of a dictionary trained on ``samples``; the samples themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size + 2000, samples).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def _heads(doc: bytes) -> set[bytes]:
    """Whole words and word beginnings of a document, as they stand behind a space."""
    out = set()
    for w in set(doc.split()):
        w = w.strip(b".,;:!?")
        if len(w) >= HEAD_BYTES[0]:
            out.add(b" " + w + b" ")
            out.update(b" " + w[:n] for n in range(HEAD_BYTES[0], min(len(w), HEAD_BYTES[1]) + 1))
    return out


def train_contents(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    """Contents of the base, and of what is typical of toxic documents, most telling last.

    The base is a cover of ordinary windows.  For the other content, words and
    word beginnings that are common in toxic documents and many times rarer in
    ordinary ones are found; it holds the words that begin so, by frequency.
    """
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    cut = [w for d in ordinary for w in list(windows(d, 200))[:40]]
    order = np.random.default_rng(7).permutation(len(cut))[:30_000]
    base = _cover([cut[i] for i in order], BASE_BYTES) if cut else b""
    seen = Counter(h for d in toxic for h in _heads(d))
    least = max(3, len(toxic) * COMMON)
    heads = {h: n for h, n in seen.items() if n >= least}
    rest = Counter(h for d in ordinary for h in _heads(d) if h in heads)
    gain = {}
    for h, n in heads.items():
        a, b = n / len(toxic), (rest[h] + 0.5) / len(ordinary)
        if a > TYPICAL * b:
            gain[h] = a * np.log(a / b)
    chosen: list[bytes] = []
    for h in sorted(gain, key=lambda h: (-gain[h], h)):
        if not any(h.startswith(c) or c.startswith(h) for c in chosen):
            chosen.append(h)
    stems = tuple(c.rstrip() for c in chosen)
    words = [(n, w) for w, n in seen.items() if w.endswith(b" ") and w.startswith(stems)] if stems else []
    return base, b" ".join(w.strip() for _, w in sorted(words)) + b" "


def labelled_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, text, toxic, use)`` of the rows to learn from; bounded, chosen by a hash of the id."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    mixed = F.xxhash64(F.lit(11), "doc_id")
    known = known.withColumn("h", mixed).withColumn("dict", F.pmod("h", F.lit(2)) == 0)
    pick = lambda cond, n: known.where(cond).orderBy("h", "doc_id").limit(n)
    ids = (
        pick("dict and toxic = 1", DICT_TOXIC)
        .unionByName(pick("dict and toxic = 0", DICT_ORDINARY))
        .unionByName(pick("not dict", CALIBRATION))
    )
    ids = ids.select(F.col("doc_id").alias("label_id"), "toxic", "dict")
    # The chosen ids are bounded by the three limits above.
    return docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("label_id")).drop("label_id")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    sample = save(labelled_sample(docs, labels), "toxicity-sample")
    # Whole texts are cut to DICT_BYTES for the dictionaries only.
    raw = sample.where("dict").select("toxic", F.substring(F.encode("text", "UTF-8"), 1, DICT_BYTES).alias("raw"))
    texts = {0: [], 1: []}
    for r in raw.where("raw is not null").orderBy("raw").toLocalIterator():
        texts[r["toxic"]].append(bytes(r["raw"]).translate(_FOLD))
    rate = sample.agg(F.avg("toxic")).first()[0] or 0.0
    if not texts[0] or not texts[1]:
        return {"rate": float(rate)}
    base, typical = train_contents(texts[1], texts[0])
    sizes = sorted({min(n, len(typical)) for n in CLASS_BYTES})
    width = 1 + len(THRESHOLDS)

    def histograms(batches):
        measures = [Distance(base, typical[-n:]) for n in sizes]
        for pdf in batches:
            rows = [[c for m in measures for c in m.counts(t)] for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"], "counts": rows})

    spread = sample.where("not dict").repartition(max(2, docs.sparkSession.sparkContext.defaultParallelism))
    got = spread.mapInPandas(histograms, "doc_id long, toxic int, counts array<long>").toPandas()
    got = got.sort_values(["doc_id"]).reset_index(drop=True)
    y = got["toxic"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return {"rate": float(rate)}
    counts = np.array(got["counts"].tolist(), dtype=np.int64)
    fold = np.arange(len(y)) % FOLDS
    best = None
    for i, n in enumerate(sizes):
        x = features(counts[:, i * width : (i + 1) * width])
        loss = 0.0
        for k in range(FOLDS):
            p = predict(logistic(x[fold != k], y[fold != k]), x[fold == k])
            loss -= np.log(np.where(y[fold == k] == 1, p, 1 - p) + 1e-9).sum()
        if best is None or loss < best[0]:
            best = (loss, n, logistic(x, y))
    return {"base": base, "typical": typical[-best[1] :], "model": best[2], "rate": float(rate)}


def score(docs: DataFrame, model: dict, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with two columns ``names`` (columns of these names are replaced); only the text is read for them."""
    docs = docs.drop(*names)
    if "base" not in model:
        scored = docs.withColumn(names[0], F.lit(model["rate"]))
        return scored.withColumn(names[1], (F.col(names[0]) >= 0.5).cast("int"))

    def run(batches):
        measure = Distance(model["base"], model["typical"])
        for batch in batches:
            counts = [measure.counts(t) for t in batch.column("text").to_pylist()]
            p = predict(model["model"], features(np.array(counts, dtype=np.int64))) if counts else np.empty(0)
            more = [pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(batch.columns + more, names=batch.schema.names + list(names))

    schema = StructType(docs.schema.fields + [StructField(names[0], DoubleType()), StructField(names[1], IntegerType())])
    return docs.mapInArrow(run, schema)


def op1_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

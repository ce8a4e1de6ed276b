"""Substring dedup by seed and extend, on words.

The seed of a window of ``WINDOW`` words is the run of ``SEED`` words in it with
the smallest hash, so equal windows have equal seeds, and consecutive windows
mostly share one.  The stretch of all windows with the same seed occurrence is
its region.

1. Seeds that occur once in the corpus are dropped; documents meet on the rest.
2. A seed is extended both ways over its region at once.  Regions of one seed
   with equal words are a class.  All windows of a class occur in its first
   document, so they go from every later one.
3. A seed with several classes ends somewhere within a region.  For the first
   document of each class it is extended by each number of words to the left
   and the rest to the right, one row for each window; a window goes if the same
   words start in a smaller document.  Classes stand for all their occurrences,
   so this costs a few dozen rows for each place where copies part, and never a
   pair of occurrences.

Overlapping windows are joined to maximal repeats, whose words are removed.
Words are compared by 128 bits of hash.

Defined cases: a text may be of any length (its task holds its words, its
windows in stretches); a null text has no words; texts under ``WINDOW`` words are kept;
rows that repeat an id are one document and lose the same windows if their texts
are equal; null ids neither remove nor are removed from; an empty table gives
an empty result; further columns are kept by ``cleaned`` and ignored by the
query.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyze.llm import anchors as A
from panelyze.llm.common import blocks, mix64, save, table
from panelyze.llm.shingles import WordHashes, words_of

WINDOW, SEED = 50, 8
BATCH_BYTES = 8 << 20


def text_key(text: str | None) -> int:
    """Tells apart texts that stand under one id."""
    return xxhash.xxh32_intdigest((text or "").encode("utf-8", "surrogatepass")) - (1 << 31)


class Windows:
    """Windows, anchors and hashes of a block of texts, given as word hashes."""

    def __init__(self, parts: list[np.ndarray]):
        self.ends = np.cumsum([len(p) for p in parts])
        self.begin = np.r_[0, self.ends[:-1]]
        flat = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        self.rolling = A.Rolling(flat)
        self.starts = A.window_starts(self.ends, WINDOW)
        self.anchors = A.window_anchors(self.rolling, self.starts, WINDOW, SEED)

    def seeds(self, at: np.ndarray) -> np.ndarray:
        return self.rolling(at, at + SEED).view(np.int64)


def _symbols(texts, hashes: WordHashes) -> list[np.ndarray]:
    return [hashes(words_of(t, lower=False)) for t in texts]


def _text_blocks(pdf: pd.DataFrame, limit: int = BATCH_BYTES):
    size = pdf["text"].map(lambda t: len(t) if isinstance(t, str) else 0).to_numpy()
    for a, b in blocks(size, limit):
        yield pdf.iloc[a:b]


def seed_regions(docs: DataFrame) -> DataFrame:
    """``(seed, body, doc_id, k, lo, hi)``: each region with the hash of its words and its first and last window."""

    stretch = A.STRETCH

    def run(batches):
        hashes = WordHashes()
        for pdf in batches:
            for part in _text_blocks(pdf):
                keys = np.array([text_key(t) for t in part["text"]], np.int32)
                symbols = _symbols(part["text"].tolist(), hashes)
                for w, doc, begin, first, last in A.region_stretches(symbols, Windows, stretch):
                    if not len(first):
                        continue
                    lo, hi = w.starts[first], w.starts[last]
                    out = {"seed": w.seeds(w.anchors[first]), "body": w.rolling(lo, hi + WINDOW).view(np.int64)}
                    out |= {"doc_id": part["doc_id"].to_numpy(np.int64)[doc], "k": keys[doc]}
                    yield pd.DataFrame(out | {"lo": (lo - begin).astype(np.int32), "hi": (hi - begin).astype(np.int32)})

    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    return ids.mapInPandas(run, "seed long, body long, doc_id long, k int, lo int, hi int")


def parting_windows(docs: DataFrame, places: DataFrame) -> DataFrame:
    """``(h1, h2, doc_id, k, lo)``: one row for each window of the regions ``places``."""
    by_doc = places.groupBy("doc_id").agg(F.collect_set(F.struct("k", "lo", "hi")).alias("places"))
    stretch = A.STRETCH

    def run(batches):
        hashes = WordHashes()
        for pdf in batches:
            for part in _text_blocks(pdf, BATCH_BYTES // 4):
                keys = [text_key(t) for t in part["text"]]
                doc, lo, hi = [], [], []
                for d, rows in enumerate(part["places"]):
                    for r in rows:
                        if r["k"] == keys[d]:
                            doc.append(d)
                            lo.append(r["lo"])
                            hi.append(r["hi"])
                if not doc:
                    continue
                docs_, los, his = np.array(doc), np.array(lo), np.array(hi)
                symbols = _symbols(part["text"].tolist(), hashes)
                # A region's windows share a seed, so they end within two windows of its first.
                for w, begin, places in A.place_stretches(symbols, Windows, docs_, los, 2 * WINDOW, stretch):
                    doc, lo, hi = docs_[places], los[places], his[places]
                    n = hi - lo + 1
                    start = np.repeat(lo - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                    doc, at = np.repeat(doc, n), start + np.repeat(begin, n)
                    anchor = w.anchors[np.searchsorted(w.starts, at)]
                    h2 = mix64(w.seeds(anchor).view(np.uint64) + (anchor - at).astype(np.uint64))
                    out = {"h1": w.rolling(at, at + WINDOW).view(np.int64), "h2": h2.view(np.int64)}
                    out |= {"doc_id": part["doc_id"].to_numpy(np.int64)[doc], "k": np.array(keys, np.int32)[doc]}
                    yield pd.DataFrame(out | {"lo": start.astype(np.int32)})

    wide = docs.select("doc_id", "text").join(by_doc, "doc_id")
    return wide.mapInPandas(run, "h1 long, h2 long, doc_id long, k int, lo int")


def removed_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, k, lo, hi)``: runs of windows that also start in a smaller document."""
    seeds = save(seed_regions(docs), "seeds")
    often = seeds.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed")
    hits = save(seeds.join(save(often, "seeds-often"), "seed"), "seed-hits")
    classes = hits.groupBy("seed", "body").agg(F.min("doc_id").alias("first"))
    classes = save(classes, "seed-classes")
    several = classes.groupBy("seed").agg(F.count("*").alias("n")).where("n > 1").select("seed", F.lit(True).alias("parts"))
    known = classes.join(several, "seed", "left").select("seed", "body", "first", F.coalesce("parts", F.lit(False)).alias("parts"))
    told = save(hits.join(save(known, "seed-known"), ["seed", "body"]).select("doc_id", "k", "lo", "hi", "first", "parts"), "seed-told")
    whole = told.where("doc_id > first").select("doc_id", "k", "lo", "hi")
    places = told.where("doc_id = first and parts").select("doc_id", "k", "lo", "hi")
    windows = save(parting_windows(docs, places), "windows")
    first = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    first = save(first.where("first < last").select("h1", "h2", "first"), "window-first")
    single = windows.join(first, ["h1", "h2"]).where("doc_id > first").select("doc_id", "k", "lo", F.col("lo").alias("hi"))
    return whole.unionByName(single)


def kept_mask(n: int, lo: np.ndarray, hi: np.ndarray, window: int) -> np.ndarray:
    """False for every symbol that a window starting in one of the runs covers."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, np.minimum(hi + window, n), -1)
    return np.cumsum(edge[:-1]) == 0


def _with_runs(docs: DataFrame) -> DataFrame:
    runs = removed_runs(docs)
    by_doc = save(runs.groupBy("doc_id").agg(F.collect_list(F.struct("k", "lo", "hi")).alias("runs__")), "runs")
    return docs.join(by_doc, "doc_id", "left")


def _kept(text, runs) -> tuple[list[bytes], int]:
    """Words that stay, and how many there were."""
    words = words_of(text, lower=False)
    if runs is None or not len(runs):
        return words, len(words)
    key = text_key(text)
    at = np.array([(r["lo"], r["hi"]) for r in runs if r["k"] == key], np.int64).reshape(-1, 2)
    keep = kept_mask(len(words), at[:, 0], at[:, 1], WINDOW)
    return [w for w, k in zip(words, keep.tolist()) if k], len(words)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, one row per document."""

    def run(batches):
        for pdf in batches:
            out = []
            for doc_id, text, runs in zip(pdf["doc_id"], pdf["text"], pdf["runs__"]):
                words, n = _kept(text if isinstance(text, str) else None, runs)
                out.append((doc_id, n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
            out = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])
            yield out.astype({"doc_id": "Int64"})

    wide = _with_runs(docs.select("doc_id", "text"))
    return wide.mapInPandas(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages taken out of ``text`` (words joined by one space where any went)."""
    import pyarrow as pa

    columns = docs.columns

    def run(batches):
        for batch in batches:
            i = batch.schema.get_field_index("text")
            out = []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs__").to_pylist()):
                words, n = _kept(text, runs)
                out.append(text if len(words) == n else b" ".join(words).decode("utf-8"))
            batch = batch.set_column(i, batch.schema.field(i), pa.array(out, batch.schema.field(i).type))
            yield batch.select(columns)

    return _with_runs(docs).select(*columns, "runs__").mapInArrow(run, docs.schema)


def op7_seed_extend_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))

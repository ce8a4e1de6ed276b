"""Exact top-k search by integer inner product on a bit-sliced index.

Index: rows stand in blocks of about ``BLOCK_ROWS``; in a block, every
attribute is held as slices, one bitmap over the rows for each bit of the
value.  A query adds the slices of the attributes it weighs: each set bit of a
weight puts the attribute's slices on the bit levels they belong to, and full
adders (five bitmap operations on three bitmaps) bring each level down to one
bitmap.  Negative weights add the complement slices; the constant that this
brings in is taken off at the end.  The sum's slices are then read from the
most significant one downward: rows with the bit set either all belong to the
result or the search goes on among them.  Rows still equal after the last
slice are ties and are taken in order of their id.  Nothing is rounded, so the
result is exact.

Scale: the work is (queries x rows), in blocks of queries against blocks of
rows; each pair of blocks is one row of a partitioned table and gives at most k
rows per query.

Defined cases: null vectors, and vectors with a null or non-finite component,
take no part; an id that repeats stands once, with the smallest of its vectors;
vectors are compared with those of equal length only; ties go to the smaller
id; a query with fewer than k candidates gets them all; an empty table gives an
empty result; sums that need more than 62 bits raise an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelyze.llm.common import save, table

BLOCK_ROWS = 32768
QUERY_ROWS = 192
SCALE = 64
K = 20
QUERY_STEP = 20


def quantised(df: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v, dim)`` with v = floor(scale * x), one row per id."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    ok = df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    ints = ok.select("vec_id", F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))
    return ints.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def slice_block(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Bitmaps ``[attribute, bit, word]`` of ``values - base`` and the base (smallest value)."""
    n, dim = values.shape
    base = int(values.min()) if values.size else 0
    shifted = (values - base).astype(np.uint64)
    bits = max(1, int(shifted.max()).bit_length()) if values.size else 1
    words = (n + 63) // 64
    out = np.zeros((dim, bits, words * 8), dtype=np.uint8)
    for b in range(bits):
        plane = ((shifted >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        packed = np.packbits(plane, axis=0, bitorder="little")
        out[:, b, : packed.shape[0]] = packed.T
    return out.view(np.uint64), base


def add_slices(planes: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """Slices of the sum of weighted bitmaps; ``planes[level]`` lists 2-d stacks of bitmaps."""
    out, level = [], 0
    while planes:
        stack = planes.pop(level, None)
        if stack is None:
            out.append(None)
            level += 1
            continue
        cur = stack[0] if len(stack) == 1 else np.concatenate(stack)
        carried = []
        while len(cur) > 1:
            third = max(1, len(cur) // 3)
            if len(cur) == 2:
                carried.append(cur[:1] & cur[1:])
                cur = cur[:1] ^ cur[1:]
                break
            a, b, c, rest = cur[:third], cur[third : 2 * third], cur[2 * third : 3 * third], cur[3 * third :]
            half = a ^ b
            carried.append((a & b) | (half & c))
            half ^= c
            cur = np.concatenate([half, rest]) if len(rest) else half
        out.append(cur[0])
        if carried:
            planes.setdefault(level + 1, []).extend(carried)
        level += 1
    return out


def top_rows(slices: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest rows; ties by position."""
    sure = np.zeros_like(allowed)
    open_ = allowed.copy()
    for s in reversed(slices):
        if s is None:
            continue
        high = open_ & s
        n = int(np.bitwise_count(sure | high).sum())
        if n > k:
            open_ = high
        else:
            sure |= high
            open_ &= ~s
            if n == k:
                open_[:] = 0
                break
    bits = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little"))
    found = bits(sure)
    return np.concatenate([found, bits(open_)[: k - len(found)]]) if len(found) < k else found


def search_block(queries: np.ndarray, qids: np.ndarray, slices: np.ndarray, base: int, ids: np.ndarray, k: int):
    """Top k of one index block for each query: arrays (query id, row id, score)."""
    dim, bits, words = slices.shape
    n = len(ids)
    everyone = np.zeros(words * 8, dtype=np.uint8)
    everyone[: (n + 7) // 8] = np.packbits(np.ones(n, np.uint8), bitorder="little")
    everyone = everyone.view(np.uint64)
    top = (1 << bits) - 1
    flipped = ~slices
    out_q, out_i, out_s = [], [], []
    for q, qid in zip(queries, qids):
        weight = np.abs(q)
        largest = int(weight.sum()) * (top + abs(base))
        if largest.bit_length() > 62:
            raise ArithmeticError("inner products exceed 62 bits")
        planes: dict[int, list[np.ndarray]] = {}
        for j in range(int(weight.max()).bit_length() if dim else 0):
            on = (weight >> j) & 1 == 1
            pos, neg = np.flatnonzero(on & (q > 0)), np.flatnonzero(on & (q < 0))
            for b in range(bits):
                for src, rows in ((slices, pos), (flipped, neg)):
                    if len(rows):
                        planes.setdefault(j + b, []).append(src[rows, b])
        total = add_slices(planes)
        # sum(q*x): the slices hold x - base, and top - (x - base) where q < 0.
        fixed = base * int(q.sum()) - top * int(weight[q < 0].sum())
        allowed = everyone.copy()
        lo, hi = np.searchsorted(ids, qid, "left"), np.searchsorted(ids, qid, "right")
        for p in range(lo, hi):
            allowed[p >> 6] &= ~np.uint64(1 << (p & 63))
        rows = top_rows(total, allowed, k)
        score = np.full(len(rows), fixed, dtype=np.int64)
        for b, s in enumerate(total):
            if s is not None:
                score += ((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << b
        out_q.append(np.full(len(rows), qid, dtype=np.int64))
        out_i.append(ids[rows])
        out_s.append(score)
    cat = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
    return cat(out_q), cat(out_i), cat(out_s)


def _matrix(pdf: pd.DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    pdf = pdf.sort_values("vec_id")
    values = np.array(pdf["v"].tolist(), dtype=np.int64).reshape(len(pdf), dim)
    return pdf["vec_id"].to_numpy(np.int64), values


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per block: ids, slices and what is needed to read them."""
    groups = max(1, -(-vectors.count() // block_rows))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf["dim"].iloc[0])
        ids, values = _matrix(pdf, dim)
        slices, base = slice_block(values)
        row = {"dim": dim, "block": int(pdf["block"].iloc[0]), "base": base, "bits": slices.shape[1]}
        return pd.DataFrame([row | {"ids": ids.tobytes(), "slices": slices.tobytes()}])

    blocked = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    schema = "dim int, block int, base long, bits int, ids binary, slices binary"
    return blocked.groupBy("dim", "block").applyInPandas(build, schema)


def query_blocks(queries: DataFrame, rows: int = QUERY_ROWS) -> DataFrame:
    groups = max(1, -(-queries.count() // rows))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf["dim"].iloc[0])
        ids, values = _matrix(pdf, dim)
        row = {"dim": dim, "qblock": int(pdf["qblock"].iloc[0]), "qids": ids.tobytes(), "weights": values.tobytes()}
        return pd.DataFrame([row])

    blocked = queries.withColumn("qblock", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    return blocked.groupBy("dim", "qblock").applyInPandas(pack, "dim int, qblock int, qids binary, weights binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of each query row against all rows."""
    spark = vectors.sparkSession
    index = save(build_index(vectors), "bit-slices")
    asked = save(query_blocks(queries), "query-blocks")
    # Each block of queries meets each block of rows of its length.
    pairs = asked.join(index, "dim")
    count = max(1, asked.count())
    pairs = pairs.repartition(min(2000, max(count, 1)), "qblock", "block", "dim")

    def search(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                ids = np.frombuffer(r.ids, np.int64)
                qids = np.frombuffer(r.qids, np.int64)
                weights = np.frombuffer(r.weights, np.int64).reshape(len(qids), r.dim)
                words = (len(ids) + 63) // 64
                slices = np.frombuffer(r.slices, np.uint64).reshape(r.dim, r.bits, words)
                q, i, s = search_block(weights, qids, slices, r.base, ids, k)
                yield pd.DataFrame({"query_id": q, "vec_id": i, "score": s})

    found = pairs.mapInPandas(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = save(quantised(table(spark, sf_dir, "embeddings")), "vectors")
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_STEP == 0))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

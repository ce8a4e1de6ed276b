"""Near-duplicate documents by minhash and a multi-index Hamming join.

A document is its set of distinct five-word shingles.  Documents with equal
sets are one class.  A class has ``CHUNKS`` x ``CHUNK`` minhash symbols of 16
bits; the probability that two symbols agree is the Jaccard similarity of the
sets.  Signatures are split into chunks, and each chunk is indexed with every
way of leaving out ``ERRORS`` of its symbols.  By the pigeonhole principle two
signatures that differ in fewer than ``CHUNKS * (ERRORS + 1)`` symbols agree on a
key; at the similarity of the threshold a pair shares no key with a probability
under 1e-6, at a higher one far less.

Classes that meet under a key are compared on their whole sets:

1. each with the smallest class of the key, where a longer signature does not
   rule it out; the links confirmed give first components;
2. keys that still hold several components are compared all against all, but
   inside tasks: blocks of ``BLOCK`` classes, first by the longer signature,
   which only picks the rows that could link across components, then those rows
   by their whole sets.  Only links come out, as spanning forests of blocks.

Scale: keys with one class are dropped before anything is joined, and of keys
with the same classes all but one; sets are rebuilt only for classes that share
a key; hot keys are split into blocks; what leaves a task grows with the rows,
never with the pairs of a group.

Defined cases: null, empty and blank texts have no shingles and link with
nothing; a text of one to four words is one shingle; a document is its id: rows that
repeat an id, also with other texts, share their links and their component;
texts may be of any length (a task holds one whole text); a null id is a class member without
a component of its own; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyze.llm.common import blocks, components, mix64, save, shuffle_parts, table
from panelyze.llm.shingles import WordHashes, minhash, shingle_set, words_of
from panelyze.operators.ordinals import range_sorted, with_row_numbers

PERCENT = 75
CHUNKS, CHUNK, ERRORS = 12, 4, 1
LONG = 256
# A longer signature rules a pair out below this share of equal symbols: more than
# five standard deviations under the threshold.
LONG_SHARE = 0.60
BLOCK = 1024
BATCH_BYTES = 8 << 20


def _sets(texts: list, hashes: WordHashes) -> list[np.ndarray]:
    return [shingle_set(hashes(words_of(t))) for t in texts]


def set_hash(s: np.ndarray) -> tuple[int, int]:
    """128-bit hash of a set as two longs."""
    a, b = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8").tolist()
    return a, b


def signatures(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, h1, h2, sig)``: set size, 128-bit hash of the set, minhash symbols as bytes."""

    def run(batches):
        hashes = WordHashes()
        for pdf in batches:
            size = pdf["text"].map(lambda t: len(t) if isinstance(t, str) else 0).to_numpy()
            for a, b in blocks(size, BATCH_BYTES):
                sets = _sets(pdf["text"].iloc[a:b].tolist(), hashes)
                some = [i for i, s in enumerate(sets) if len(s)]
                sig: list = [None] * len(sets)
                for i, row in zip(some, minhash([sets[i] for i in some], CHUNKS * CHUNK)):
                    sig[i] = row.tobytes()
                pair = np.array([set_hash(s) for s in sets], np.int64).reshape(-1, 2)
                out = {"doc_id": pdf["doc_id"].iloc[a:b].tolist(), "n": [len(s) for s in sets]}
                out |= {"h1": pair[:, 0], "h2": pair[:, 1], "sig": sig}
                yield pd.DataFrame(out).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n long, h1 long, h2 long, sig binary")


def chunk_keys(classes: DataFrame) -> DataFrame:
    """``(key, id)``: every chunk of every signature, with every symbol left out in turn."""

    def run(batches):
        step = np.uint64(0x9E3779B97F4A7C15)
        for pdf in batches:
            if not len(pdf):
                continue
            sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), CHUNKS, CHUNK).astype(np.uint64)
            keys = []
            for c in range(CHUNKS):
                for out in range(CHUNK):
                    h = np.full(len(pdf), c * CHUNK + out + 1, np.uint64)
                    for j in range(CHUNK):
                        if j != out:
                            h = mix64(h * step + sig[:, c, j])
                    keys.append(h.view(np.int64))
            yield pd.DataFrame({"key": np.concatenate(keys), "id": np.tile(pdf["id"].to_numpy(), len(keys))})

    return classes.select("id", "sig").mapInPandas(run, "key long, id long")


def unlike_keys(rows: DataFrame) -> DataFrame:
    """``(key, size)`` of ``rows(key, id)``: of the keys that hold the same ids, the smallest one.

    Near classes agree on many chunks, so the same few ids meet under key after key; comparing them once finds all
    their links.  Members are told apart by their number, smallest, largest and a 128-bit hash: exactly for two ids.
    """
    words = [F.bit_xor(F.xxhash64(F.lit(seed), "id")).alias(f"x{seed}") for seed in (1, 2)]
    members = rows.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("lo"), F.max("id").alias("hi"), *words)
    return members.groupBy("size", "lo", "hi", "x1", "x2").agg(F.min("key").alias("key")).select("key", "size")


def rebuilt(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """``(id, n, hashes, long_sig)`` of ``classes(id, rep, n, h1, h2)``, from the texts of their representatives."""

    def run(batches):
        hashes = WordHashes()
        for pdf in batches:
            size = pdf["text"].str.len().to_numpy()
            for a, b in blocks(size, BATCH_BYTES // 4):
                sets = [s for s in _sets(pdf["text"].iloc[a:b].tolist(), hashes) if len(s)]
                sig = (minhash(sets, LONG) & np.uint16(255)).astype(np.uint8)
                pair = np.array([set_hash(s) for s in sets], np.int64).reshape(-1, 2)
                out = {"n": [len(s) for s in sets], "h1": pair[:, 0], "h2": pair[:, 1]}
                yield pd.DataFrame(out | {"hashes": [s.tobytes() for s in sets], "long_sig": [s.tobytes() for s in sig]})

    # Ids alone go to the texts, from a table of their own, whose size the planner sees; an id may stand on rows with
    # other texts, whose sets are of no class asked for.
    reps = save(classes.select(F.col("rep").alias("doc_id")).distinct(), "minhash-reps")
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(reps, "doc_id").select("text")
    sets = texts.mapInPandas(run, "n long, h1 long, h2 long, hashes binary, long_sig binary")
    # Dealt by the set's hash once, for both steps.
    sets = sets.dropDuplicates(["n", "h1", "h2"]).join(classes.drop("rep"), ["n", "h1", "h2"])
    return sets.select("id", "n", "hashes", "long_sig")


def _similar_size(a, b):
    return F.least(a, b) * 100 >= F.lit(PERCENT) * F.greatest(a, b)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs(u, v)`` whose whole sets reach the threshold."""
    left = sets.select(F.col("id").alias("u"), F.col("hashes").alias("a"))
    right = sets.select(F.col("id").alias("v"), F.col("hashes").alias("b"))

    def run(batches):
        for pdf in batches:
            ok = []
            for a, b in zip(pdf["a"], pdf["b"]):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(100 * both >= PERCENT * (len(a) + len(b) - both))
            yield pdf.loc[ok, ["u", "v"]]

    return pairs.join(right, "v").join(left, "u").mapInPandas(run, "u long, v long")


def star_pairs(hits: DataFrame, sets: DataFrame) -> DataFrame:
    """Each class with the smallest one of each of its keys, where sizes and long signatures allow a link."""
    low = save(hits.groupBy("key").agg(F.min("id").alias("v")), "minhash-low")
    pairs = hits.join(low, "key").where("id <> v").select(F.col("id").alias("u"), "v").distinct()
    side = lambda c, n, s: sets.select(F.col("id").alias(c), F.col("n").alias(n), F.col("long_sig").alias(s))
    wide = pairs.join(side("u", "nu", "su"), "u").join(side("v", "nv", "sv"), "v")
    wide = wide.where(_similar_size(F.col("nu"), F.col("nv"))).select("u", "v", "su", "sv")

    def run(batches):
        for pdf in batches:
            if len(pdf):
                a = np.frombuffer(b"".join(pdf["su"]), np.uint8).reshape(len(pdf), LONG)
                b = np.frombuffer(b"".join(pdf["sv"]), np.uint8).reshape(len(pdf), LONG)
                yield pdf.loc[(a == b).mean(1) >= LONG_SHARE, ["u", "v"]]

    return wide.mapInPandas(run, "u long, v long")


def _grouped(batches, key):
    """The frames of consecutive equal keys in sorted batches."""
    held = None
    for pdf in batches:
        held = pdf if held is None or not len(held) else pd.concat([held, pdf], ignore_index=True)
        if not len(held):
            continue
        k = held[key].to_numpy()
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(1)])
        for a, b in zip(starts[:-1], starts[1:]):
            yield held.iloc[a:b]
        held = held.iloc[starts[-1] :]
    if held is not None and len(held):
        yield held


BLOCK_KEY = ["key", "bi", "bj"]


def in_blocks(rows: DataFrame) -> DataFrame:
    """``rows(key, size, id, ...)`` dealt to pairs of blocks ``bi <= bj`` of each key; ``left`` tells the side.

    A key within one block is the pair (0, 0) alone.
    """
    count = F.ceil(F.col("size") / F.lit(float(BLOCK))).cast("int")
    rows = rows.withColumn("parts", count).withColumn("own", F.pmod(F.xxhash64(F.lit(3), "id"), count).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other"))
    return rows.withColumn("left", F.col("own") <= F.col("other")).drop("parts", "own", "other", "size")


def _spread(rows: DataFrame) -> DataFrame:
    return rows.repartition(shuffle_parts(rows.sparkSession), *BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY)


def _sides(g: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Both sides of a block pair; a block against itself is both."""
    if g["bi"].iat[0] == g["bj"].iat[0]:
        return g, g
    return g[g["left"]], g[~g["left"]]


def possible(rows: DataFrame) -> DataFrame:
    """``(key, id)`` of the rows that some row of another component, under the same key, could link to."""

    def run(batches):
        for g in _grouped(batches, BLOCK_KEY):
            if g["root"].nunique() < 2:
                continue
            a, b = _sides(g)
            if not len(a) or not len(b):
                continue
            sa = np.frombuffer(b"".join(a["long_sig"]), np.uint8).reshape(len(a), LONG)
            sb = np.frombuffer(b"".join(b["long_sig"]), np.uint8).reshape(len(b), LONG)
            na, nb = a["n"].to_numpy()[:, None], b["n"].to_numpy()[None, :]
            ok = (a["root"].to_numpy()[:, None] != b["root"].to_numpy()[None, :]) & (
                100 * np.minimum(na, nb) >= PERCENT * np.maximum(na, nb)
            )
            for i in np.flatnonzero(ok.any(1)):
                at = np.flatnonzero(ok[i])
                ok[i, at] = (sb[at] == sa[i]).mean(1) >= LONG_SHARE
            ids = np.unique(np.r_[a["id"].to_numpy()[ok.any(1)], b["id"].to_numpy()[ok.any(0)]])
            if len(ids):
                yield pd.DataFrame({"key": np.full(len(ids), g["key"].iat[0]), "id": ids})

    return _spread(in_blocks(rows)).mapInPandas(run, "key long, id long")


def overlaps(a: list[np.ndarray], b: list[np.ndarray], columns: int = 1024) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices of the shingles that repeat."""
    sizes = [len(s) for s in a] + [len(s) for s in b]
    shingle, inverse, seen = np.unique(np.concatenate(a + b), return_inverse=True, return_counts=True)
    column = np.cumsum(seen > 1) - 1
    keep = seen[inverse] > 1
    row = np.repeat(np.arange(len(sizes)), sizes)[keep]
    col = column[inverse[keep]]
    out = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        i, j = np.searchsorted(col, [at, at + columns])
        m = np.zeros((len(sizes), columns), np.float32)
        m[row[i:j], col[i:j] - at] = 1
        out += m[: len(a)] @ m[len(a) :].T
    return out


def block_links(rows: DataFrame) -> DataFrame:
    """Forest edges ``(u, v)`` of the links between the rows of each block pair, on whole sets."""

    def run(batches):
        big = np.iinfo(np.int64).max
        for g in _grouped(batches, BLOCK_KEY):
            a, b = _sides(g)
            if not len(a) or not len(b):
                continue
            sa, sb = [[np.frombuffer(h, np.uint64) for h in side["hashes"]] for side in (a, b)]
            both = overlaps(sa, sb)
            na, nb = a["n"].to_numpy()[:, None], b["n"].to_numpy()[None, :]
            ia, ib = a["id"].to_numpy(), b["id"].to_numpy()
            linked = (100 * both.astype(np.float64) >= PERCENT * (na + nb - both)) & (ia[:, None] != ib[None, :])
            la, lb = ia.copy(), ib.copy()
            while True:
                xb = np.minimum(lb, np.where(linked, la[:, None], big).min(0))
                xa = np.minimum(la, np.where(linked, xb[None, :], big).min(1))
                if (xa == la).all() and (xb == lb).all():
                    break
                la, lb = xa, xb
            out = pd.DataFrame({"u": np.r_[ia, ib], "v": np.r_[la, lb]})
            yield out[out["u"] != out["v"]]

    return _spread(in_blocks(rows)).mapInPandas(run, "u long, v long")


def one_by_id(some: DataFrame, named: DataFrame) -> DataFrame:
    """``named(n, h1, h2, rep, least)`` with components joined that hold one id, where an id stands on several sets."""
    key = F.struct("n", "h1", "h2")
    several = some.groupBy("doc_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).where("lo <> hi")
    several = save(several.select("doc_id"), "minhash-several")
    if several.isEmpty():
        return named
    on = some.join(several, "doc_id").select("doc_id", "n", "h1", "h2").distinct()
    edges = on.join(named, ["n", "h1", "h2"]).select(F.col("doc_id").alias("u"), F.col("least").alias("v"))
    joined = components(edges).select(F.col("node").alias("least"), F.col("root").alias("joined"))
    return named.join(joined, "least", "left").withColumn("least", F.coalesce("joined", "least")).drop("joined")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per document."""
    signed = save(signatures(docs), "minhash-signed")
    some = signed.where("n > 0 and doc_id is not null")
    classes = some.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"))
    classes = save(classes, "minhash-classes")
    # Two classes may have one representative, where its id stands on rows of both.  Their own ids follow the order of
    # the representatives: the smallest class of a key, which the others are compared with first, is its oldest text.
    classes = with_row_numbers(save(range_sorted(classes, ["rep", "h1", "h2"]), "minhash-ranged"), "id")
    classes = save(classes, "minhash-named")
    keys = chunk_keys(classes)
    shared = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    met = save(keys.join(shared, "key").select("key", "id"), "minhash-met")
    hits = save(met.join(save(unlike_keys(met), "minhash-unlike"), "key").select("key", "id", "size"), "minhash-hits")
    ids = save(classes.join(hits.select("id").distinct(), "id").select("id", "rep", "n", "h1", "h2"), "minhash-ids")
    sets = save(rebuilt(docs, ids), "minhash-sets")
    first = save(confirmed(save(star_pairs(hits, sets), "minhash-stars"), sets), "minhash-links")
    roots = components(first)
    # Keys that still hold more than one component.
    at = hits.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    at = save(at, "minhash-rooted")
    mixed = save(
        at.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key"),
        "minhash-mixed",
    )
    rows = at.join(mixed, "key").join(sets.select("id", "n", "long_sig"), "id")
    left = save(possible(rows).distinct(), "minhash-possible")
    rows = left.join(save(unlike_keys(left), "minhash-sizes"), "key").join(sets.select("id", "n", "hashes"), "id")
    more = save(block_links(rows), "minhash-more")
    roots = components(first.unionByName(more)).withColumnRenamed("node", "id")
    named = classes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    named = save(named.select("n", "h1", "h2", "rep", "root"), "minhash-roots")
    least = named.groupBy("root").agg(F.min("rep").alias("least"))
    named = save(named.join(least, "root").select("n", "h1", "h2", "rep", "least"), "minhash-least")
    told = one_by_id(some, named)
    out = signed.join(told.select("n", "h1", "h2", F.col("least").alias("root")), ["n", "h1", "h2"], "left")
    component = F.coalesce(F.when(F.col("n") > 0, F.col("root")), F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    )


def op4_hamming_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

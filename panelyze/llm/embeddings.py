"""Near-duplicate vectors through an inverted multi-index.

Two codebooks are learned, one on each half of the unit vectors; their product
is a grid of cells, and a vector lives in the cell of its nearest centroids.  A
search visits cells in order of the summed distance of the halves
(multi-sequence traversal) and compares the vector with the rows of each cell
visited by the exact cosine in double precision.  How many cells are visited is
the smallest number that reaches ``TARGET_RECALL`` twice: of pairs of a sampled
vector and a random vector at the threshold's cosine from it, which are there
whatever the table holds, and of the links that ``QUERIES`` vectors have among
all rows by brute force.  Where no number in ``VISITS`` does, the grid is made
coarser; with one cell every link is found.

Fit on at most ``SAMPLE`` vectors, chosen by a hash of the id; every vector is
indexed.  The number of cells grows with the table, so a cell keeps about
``CELL_ROWS`` rows unless the recall asks for larger ones.

Scale: equal vectors are one class with a count, searched once.  A cell with
many rows or many visitors is split into blocks of ``BLOCK`` rows by
``BLOCK`` visitors, each a task's group.  A block gives link counts and the
edges of a spanning forest, never its pairs.

Defined cases: null and zero vectors, and those with a null or non-finite
component, link with nothing; vectors of unequal length do not link; an id that
repeats stands once, with the smallest of its vectors; a null id is left out;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelyze.llm.common import components, save, shuffle_parts, table

THRESHOLD = 0.95
TARGET_RECALL = 0.995
SAMPLE = 20_000
CELL_ROWS = 24
MAX_CENTROIDS = 1024
BLOCK = 512
VISITS = (1, 2, 4, 8, 12, 16, 24, 32, 48, 64)
LEAST_VISITS = 4
QUERIES = 1000
# Pairs at the threshold's cosine that the visits are tuned on, at least.
COPIES = 8000
COARSER = 0.7
# One in so many sampled vectors is kept from the codebooks.
HELD_OUT = 5


def unit_rows(vectors: list, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(5)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = distances(x, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)[None, :]


def traversal(unit: np.ndarray, books: tuple[np.ndarray, np.ndarray], visits: int) -> np.ndarray:
    """The first ``visits`` cells of each row, by summed distance of the halves.

    The cell at ranks (i, j) of the two sorted sequences comes after every cell
    at smaller ranks, so it can only be among the first ``visits`` if
    (i + 1) * (j + 1) does not exceed them.
    """
    left, right = books
    cut = left.shape[1]
    du, dv = distances(unit[:, :cut], left), distances(unit[:, cut:], right)
    ou, ov = np.argsort(du, 1, kind="stable"), np.argsort(dv, 1, kind="stable")
    du, dv = np.take_along_axis(du, ou, 1), np.take_along_axis(dv, ov, 1)
    pairs = [(i, j) for i in range(len(left)) for j in range(len(right)) if (i + 1) * (j + 1) <= visits]
    i, j = np.array(pairs).T
    sums = du[:, i] + dv[:, j]
    order = np.argsort(sums, 1, kind="stable")[:, :visits]
    cells = ou[:, i] * len(right) + ov[:, j]
    return np.take_along_axis(cells, order, 1).astype(np.int32)


def sample_recall(unit: np.ndarray, cells: np.ndarray, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Links found with ``cells`` (a pair is found if either visits the other's cell) and all links."""
    found = total = 0
    home = cells[:, 0]
    for at in range(0, len(unit), 1024):
        q, x = np.nonzero(unit[at : at + 1024] @ unit.T >= threshold)
        q = q + at
        keep = q < x
        q, x = q[keep], x[keep]
        seen = (cells[q] == home[x][:, None]).any(1) | (cells[x] == home[q][:, None]).any(1)
        found, total = found + int(seen.sum()), total + len(q)
    return found, total


def near_copies(unit: np.ndarray, dims: np.ndarray, threshold: float, times: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """``times`` random vectors at the cosine ``threshold`` from each row, within its first ``dims`` components, and the rows."""
    rng = np.random.default_rng(9)
    # One component leaves no other direction.
    rows = np.repeat(np.flatnonzero(dims > 1), times)
    u = unit[rows]
    aside = rng.normal(size=u.shape) * (np.arange(unit.shape[1]) < dims[rows][:, None])
    aside -= (aside * u).sum(1, keepdims=True) * u
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    return threshold * u + max(0.0, 1 - threshold**2) ** 0.5 * aside, u


def found_at(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """For pairs of rows with the cells ``q`` and ``x``: how many must be visited until either visits the other's (0: more)."""
    most = q.shape[1] + 1
    at = np.full(len(q), most)
    for cells, home in ((q, x[:, :1]), (x, q[:, :1])):
        hit = cells == home
        at = np.minimum(at, np.where(hit.any(1), hit.argmax(1) + 1, most))
    return np.where(at == most, 0, at)


def least_visits(hist: np.ndarray, cells: int) -> int | None:
    """The smallest of ``VISITS`` that finds ``TARGET_RECALL`` of the pairs counted by ``found_at``."""
    reached = np.cumsum(hist[1:])
    for v in (min(v, cells) for v in VISITS if v >= LEAST_VISITS):
        if reached[v - 1] >= TARGET_RECALL * hist.sum():
            return v
    return None


def fit(unit: np.ndarray, rows: int, threshold: float = THRESHOLD, dims: np.ndarray | None = None, links=None) -> dict:
    """Codebooks for a table of ``rows`` vectors, and the number of cells to visit.

    ``links(index)`` counts the table's own links by ``found_at``.
    """
    dims = np.full(len(unit), unit.shape[1]) if dims is None else dims
    # Codebooks fit their own vectors best; where the table holds others, so do those that recall is tuned on.
    apart = len(unit) // HELD_OUT if rows > len(unit) else 0
    known, seen, dims = unit[apart:], unit[: apart or COPIES], dims[: apart or COPIES]
    copies, tested = near_copies(seen, dims, threshold, -(-COPIES // max(1, len(seen))))
    k = int(min(MAX_CENTROIDS, max(2, round((rows / CELL_ROWS) ** 0.5)), max(1, len(known))))
    cut = (unit.shape[1] + 1) // 2
    right = known[:, cut:] if unit.shape[1] > cut else np.zeros((len(known), 0))
    while True:
        books = kmeans(known[:, :cut], k), kmeans(right, k)
        most = min(max(VISITS), k * k)
        index = {"books": books, "visits": most, "width": unit.shape[1]}
        hist = np.zeros(most + 1, np.int64)
        for at in range(0, len(tested), 1024):
            pair = [traversal(p[at : at + 1024], books, most) for p in (tested, copies)]
            hist += np.bincount(found_at(*pair), minlength=most + 1)
        visits = least_visits(hist, k * k)
        if visits and links:
            own = least_visits(links(index), k * k)
            visits = own and max(visits, own)
        if visits:
            return index | {"visits": visits}
        if k == 1:
            raise RuntimeError(f"no grid finds {TARGET_RECALL} of the links")
        k = int(k * COARSER)


def query_links(classes: DataFrame, queries: pd.DataFrame, index: dict, threshold: float) -> np.ndarray:
    """Links between ``queries(id, embedding)`` and all rows, compared with each other whole, counted by ``found_at``."""
    ids = queries["id"].to_numpy(np.int64)
    dims = queries["embedding"].map(len).to_numpy()
    q_unit = unit_rows(queries["embedding"].tolist(), index["width"])
    books, most = index["books"], index["visits"]
    q_cells = traversal(q_unit, books, most)

    def run(batches):
        hist = np.zeros(most + 1, np.int64)
        for pdf in batches:
            for at in range(0, len(pdf), 1024):
                part = pdf.iloc[at : at + 1024]
                unit = unit_rows(part["embedding"].tolist(), index["width"])
                other = part["id"].to_numpy(np.int64)[:, None] != ids[None, :]
                alike = part["embedding"].map(len).to_numpy()[:, None] == dims[None, :]
                x, q = np.nonzero((unit @ q_unit.T >= threshold) & other & alike)
                if len(x):
                    rows, x = np.unique(x, return_inverse=True)
                    cells = traversal(unit[rows], books, most)
                    hist += np.bincount(found_at(q_cells[q], cells[x]), minlength=most + 1)
        yield pd.DataFrame({"at": np.arange(most + 1), "n": hist})

    counts = classes.select("id", "embedding").mapInPandas(run, "at int, n long").groupBy("at").agg(F.sum("n").alias("n"))
    hist = np.zeros(most + 1, np.int64)
    # One row for each number of visits.
    for r in counts.collect():
        hist[r["at"]] = r["n"]
    return hist


def clean(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All ids, and ``(vec_id, embedding)`` of the vectors that can link."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    one = df.where(F.col("vec_id").isNotNull()).select("vec_id", x.alias("embedding"))
    one = one.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda c: c != 0)
    return one.select("vec_id"), one.where(F.col("embedding").isNotNull()).where(fine & some)


def indexed(classes: DataFrame, index: dict) -> DataFrame:
    """``(id, m, dim, unit, home, cells)``: unit vector as bytes, home cell, cells to visit."""

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            unit = unit_rows(pdf["embedding"].tolist(), index["width"])
            cells = traversal(unit, index["books"], index["visits"])
            yield pd.DataFrame(
                {
                    "id": pdf["id"],
                    "m": pdf["m"],
                    "dim": pdf["embedding"].map(len),
                    "unit": [u.tobytes() for u in unit],
                    "home": cells[:, 0],
                    "cells": list(cells),
                }
            )

    return classes.mapInPandas(run, "id long, m long, dim int, unit binary, home int, cells array<int>")


def link_block(members: pd.DataFrame, visitors: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Link counts and forest edges between the rows of a cell and its visitors."""
    unit = lambda p: np.frombuffer(b"".join(p["unit"]), np.float64).reshape(len(p), -1)
    xi, qi = members["id"].to_numpy(), visitors["id"].to_numpy()
    linked = (unit(visitors) @ unit(members).T >= threshold) & (qi[:, None] != xi[None, :])
    q, x = np.nonzero(linked)
    if not len(q):
        return pd.DataFrame({"id": [], "links": [], "other": []})
    xm, qm = members["m"].to_numpy(), visitors["m"].to_numpy()
    # A member counts the visitor here only if it does not itself visit the visitor's cell.
    cells = np.array(members["cells"].tolist())
    home = visitors["home"].to_numpy()
    alone = ~(cells[x] == home[q][:, None]).any(1)
    q_links = np.bincount(q, weights=xm[x], minlength=len(qi))
    x_links = np.bincount(x[alone], weights=qm[q[alone]], minlength=len(xi))
    # Smallest id reachable within the block.
    big = np.iinfo(np.int64).max
    ql, xl = qi.copy(), xi.copy()
    while True:
        nx = np.minimum(xl, np.where(linked, ql[:, None], big).min(0))
        nq = np.minimum(ql, np.where(linked, nx[None, :], big).min(1))
        if (nx == xl).all() and (nq == ql).all():
            break
        xl, ql = nx, nq
    ids = np.concatenate([qi, xi])
    links = np.concatenate([q_links, x_links]).astype(np.int64)
    other = np.concatenate([ql, xl])
    keep = (links > 0) | (other != ids)
    return pd.DataFrame({"id": ids[keep], "links": links[keep], "other": other[keep]})


def link(rows: DataFrame, threshold: float) -> DataFrame:
    """``(id, links, other)`` over all cells: partial counts, and edges id - other."""
    visits = rows.select("id", "m", "dim", "unit", "home", F.explode("cells").alias("cell"))
    split = lambda c: F.ceil(c / F.lit(float(BLOCK))).cast("int")
    own = rows.groupBy("dim", F.col("home").alias("cell")).agg(split(F.count("*")).alias("b"))
    seen = visits.groupBy("dim", "cell").agg(split(F.count("*")).alias("p"))
    grid = save(own.join(seen, ["dim", "cell"]), "cell-grid")
    part = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keep = ["id", "m", "dim", "unit", "home", "cells", "cell"]
    x = rows.withColumn("cell", F.col("home")).select(*keep).join(grid, ["dim", "cell"])
    x = x.withColumn("mb", part(1, "b")).withColumn("pb", every("p")).withColumn("visitor", F.lit(False))
    q = visits.join(grid, ["dim", "cell"]).withColumn("pb", part(2, "p")).withColumn("mb", every("b"))
    # Only the members' cells are looked at.
    q = q.withColumn("visitor", F.lit(True)).withColumn("cells", F.lit(None).cast("array<int>"))
    key = ["dim", "cell", "mb", "pb"]
    both = x.select(*key, "visitor", "id", "m", "unit", "home", "cells").unionByName(
        q.select(*key, "visitor", "id", "m", "unit", "home", "cells")
    )
    spread = both.repartition(shuffle_parts(rows.sparkSession), *key).sortWithinPartitions(*key)

    def run(batches):
        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            if not len(held):
                continue
            k = held[key].to_numpy()
            starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(1)])
            # The last group may go on in the next batch.
            for a, b in zip(starts[:-1], starts[1:]):
                yield from block(held.iloc[a:b])
            held = held.iloc[starts[-1] :]
        if held is not None and len(held):
            yield from block(held)

    def block(g):
        members, visitors = g[~g["visitor"]], g[g["visitor"]]
        if len(members) and len(visitors):
            out = link_block(members, visitors, threshold)
            if len(out):
                yield out.astype({"id": np.int64, "links": np.int64, "other": np.int64})

    return spread.mapInPandas(run, "id long, links long, other long")


def near_duplicates(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per id."""
    ids, vectors = clean(df)
    vectors = save(vectors, "vectors")
    classes = save(
        vectors.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("m")), "vector-classes"
    )
    n = classes.count()
    # A bounded sample for the codebooks, in a fixed order.
    picked = classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("embedding").toPandas()["embedding"].tolist()
    own = vectors.join(classes, "embedding").select("vec_id", F.col("id").alias("class_id"), "m")
    if n:
        widest = classes.agg(F.max(F.size("embedding"))).first()[0]
        # Bounded too; drawn apart from the sample, as most of a large table's rows are.
        queries = classes.orderBy(F.xxhash64(F.lit(3), "id"), "id").limit(QUERIES).select("id", "embedding").toPandas()
        index = fit(
            unit_rows(picked, widest),
            n,
            threshold,
            np.array([len(v) for v in picked]),
            lambda grid: query_links(classes, queries, grid, threshold),
        )
        found = save(link(save(indexed(classes, index), "vector-index"), threshold), "vector-links")
    else:
        found = df.sparkSession.createDataFrame([], "id long, links long, other long")
    counts = save(found.groupBy("id").agg(F.sum("links").alias("links")), "link-counts")
    roots = components(found.where("other <> id").select(F.col("id").alias("u"), F.col("other").alias("v")))
    linked = save(counts.join(roots.withColumnRenamed("node", "id"), "id", "full"), "class-links")
    own = save(own, "class-members")
    out = own.join(linked, own["class_id"] == linked["id"], "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"),
        F.coalesce("root", "class_id").alias("component_id"),
    )
    rest = ids.join(own.select("vec_id"), "vec_id", "left_anti")
    rest = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op8_multi_index_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))

"""Hard negatives by a cover tree over norm-augmented candidates.

Candidates get one more component, sqrt(M**2 - |x|**2) with M the largest norm,
and so all have norm M; anchors get a zero there.  An inner product is then
(|q|**2 + M**2 - distance**2) / 2, and a ball of candidates bounds it from both
sides.

The candidates are split at the pivots of a bounded sample (the tree's top
level, each with its covering radius over all rows) into cells, and large cells
into blocks of about ``BLOCK`` rows.  Each block is one compressed cover tree:
a point stands once, at its highest level; its children lie within
``BASE ** level`` of it, level by level, and with every point goes the
distance to its farthest descendant.  An anchor's search
opens the nodes with the highest bounds first (``AT_ONCE`` at a time), skips nodes that cannot reach any
open window or whose bound is under what has been found, and scores the points
of opened nodes exactly, in integers.

Two searches: the best rows of the anchor's own label (no window), then, for the
window under each of these positives, the best rows of other labels.  For the
second, an anchor goes only to the cells whose ball reaches one of its windows.

Scale: anchors are a stated query set; each is sent to the blocks it may need,
and every block's tree is read by one task and kept while the anchors of the
block stream past, so trees are not copied and no group is held.  A block
returns at most k rows per anchor and window, cut down again in each task
before the merge.  Pivots are at most ``PIVOTS`` rows of a sample of ``SAMPLE``.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; rows that repeat an id are rows of their own, also as
anchors; ties go to the smaller id; vectors are compared with those of equal
length only; an anchor without positives, or a window without rows, gives none;
an empty table gives an empty result; further columns are ignored; inner
products that double precision cannot hold exactly raise an error.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelyze.llm.common import save, shuffle_parts, table

SCALE = 256
ANCHOR_STEP, RELABEL_STEP, LABELS = 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH, WHOLE = 30, 90, 100
BLOCK, LEAF, BASE = 4096, 48, 1.3
# Nodes opened together, the best of the agenda.
AT_ONCE = 16
PIVOTS, SAMPLE = 512, 8192
EXACT = 1 << 53


def prepared(df: DataFrame) -> DataFrame:
    """``(rid, vec_id, label, v, dim)``: rows that take part, relabelled and in integers; rid names the row."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    ok = df.where("vec_id is not null and label is not null and embedding is not null").where(fine)
    moved = F.when(F.col("vec_id") % RELABEL_STEP == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    ints = F.transform(x, lambda c: F.floor(c * F.lit(float(SCALE))))
    rows = ok.select("vec_id", moved.cast("long").alias("label"), ints.alias("v")).withColumn("dim", F.size("v"))
    return save(rows.withColumn("rid", F.monotonically_increasing_id()), "negatives-rows")


def matrix(vectors, dim: int) -> np.ndarray:
    return np.array([np.asarray(v) for v in vectors], np.float64).reshape(len(vectors), dim)


def augmented(x: np.ndarray, square: float) -> np.ndarray:
    """Rows with one component more, all of squared norm ``square``."""
    return np.c_[x, np.sqrt(np.maximum(square - (x * x).sum(1), 0.0))]


def far(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    d = points - centre
    return np.sqrt((d * d).sum(1))


def ball_bounds(score, radius, qq, square: float):
    """Bounds of the inner products of an anchor (squared norm ``qq``) with a ball around a centre of that ``score``.

    By the triangle inequality on distances, or by Cauchy-Schwarz on the
    difference from the centre, whichever is closer; a little wider than
    double precision may err.
    """
    both = qq + square
    d = np.sqrt(np.maximum(both - 2.0 * score, 0.0))
    reach, slack = np.sqrt(qq) * radius, 1e-9 * (both + 1.0)
    up = np.minimum((both - np.maximum(d - radius, 0.0) ** 2) / 2.0, score + reach)
    down = np.maximum((both - (d + radius) ** 2) / 2.0, score - reach)
    return up + slack, down - slack


def pivots_of(sample: np.ndarray, k: int) -> np.ndarray:
    """Farthest-first pivots: each new one is farthest from those before."""
    picked, d = [0], far(sample, sample[0])
    while len(picked) < min(k, len(sample)):
        nxt = int(d.argmax())
        if d[nxt] == 0:
            break
        picked.append(nxt)
        d = np.minimum(d, far(sample, sample[nxt]))
    return sample[picked]


def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(parent, radius)`` of a compressed cover tree over ``points``.

    The root is point 0.  Points within ``BASE ** level`` of a centre are its
    own at the next level down; of the others the first one becomes a child
    and centre of those near it, and so on, so children of one level lie
    apart.  A centre's last ``LEAF`` points hang below it without order.
    ``radius`` is the distance from a point to its farthest descendant.
    """
    n = len(points)
    parent, radius = np.full(n, -1, np.int64), np.zeros(n)
    if not n:
        return parent, radius
    first = far(points, points[0])
    todo = [(0, np.arange(1, n), first[1:])]
    while todo:
        centre, members, d = todo.pop()
        if not len(members):
            continue
        most = d.max()
        radius[centre] = max(radius[centre], most)
        while True:
            if len(members) <= LEAF or most == 0:
                parent[members] = centre
                break
            # Below the farthest point, also where the logarithm was rounded up.
            reach = min(BASE ** (np.ceil(np.log(most) / np.log(BASE)) - 1), most * (1 - 1e-6))
            apart = d > reach
            rest, members, d = members[apart], members[~apart], d[~apart]
            while len(rest):
                child, rest = rest[0], rest[1:]
                parent[child] = centre
                to_child = far(points[rest], points[child])
                near = to_child <= reach
                todo.append((child, rest[near], to_child[near]))
                rest = rest[~near]
            if not len(members):
                break
            most = d.max()
    return parent, radius


class Tree:
    """A block's tree, ready to be searched; the children of a point stand side by side."""

    def __init__(self, vectors: np.ndarray, square: float, ids, labels, rids, parent, radius):
        order = np.argsort(parent, kind="stable")
        cuts = np.searchsorted(parent[order], np.arange(len(parent) + 1))
        self.first, self.last = cuts[order], cuts[order + 1]
        self.square, self.vectors, self.radius = square, np.ascontiguousarray(vectors[order]), radius[order]
        self.ids, self.labels, self.rids = ids[order], labels[order], rids[order]

    def search(self, q, rid: int, label: int, same: bool, low: np.ndarray, high: np.ndarray, k: int):
        """For each window [low, high]: positions and scores of its best ``k`` rows."""
        n = len(low)
        found = [(np.empty(0, np.int64), np.empty(0))] * n
        need = low.astype(np.float64).copy()
        qq = float(q @ q)
        top = high.max()

        def take(rows, score):
            fits = ((self.labels[rows] == label) == same) & (score >= need.min()) & (score <= top)
            fits &= self.rids[rows] != rid
            rows, score = rows[fits], score[fits]
            for w in range(n):
                ok = (score >= need[w]) & (score <= high[w])
                if not ok.any():
                    continue
                r, s = np.r_[found[w][0], rows[ok]], np.r_[found[w][1], score[ok]]
                if len(r) > k:
                    # The k-th best score; equal scores may still win by their id.
                    need[w] = max(need[w], np.partition(s, -k)[-k])
                    r, s = r[s >= need[w]], s[s >= need[w]]
                best = np.lexsort((self.rids[r], self.ids[r], -s))[:k]
                found[w] = r[best], s[best]

        def opened(rows):
            """Scores some points and puts those with children that may matter on the agenda."""
            score = self.vectors[rows] @ q
            take(rows, score)
            inner = self.last[rows] > self.first[rows]
            if inner.any():
                rows = rows[inner]
                ups, downs = ball_bounds(score[inner], self.radius[rows], qq, self.square)
                reach = ((ups[:, None] >= need) & (downs[:, None] <= high)).any(1)
                for i, u, d in zip(rows[reach].tolist(), ups[reach].tolist(), downs[reach].tolist()):
                    heapq.heappush(agenda, (-min(u, top), i, u, d))

        agenda: list[tuple[float, int, float, float]] = []
        # The root stands first.
        opened(np.array([0]))
        while agenda:
            best = []
            while agenda and len(best) < AT_ONCE:
                _, node, up, down = heapq.heappop(agenda)
                if ((up >= need) & (down <= high)).any():
                    best.append(np.arange(self.first[node], self.last[node]))
            if best:
                opened(np.concatenate(best))
        return found


class Cells:
    """The top level: pivots with their covering radii, and into how many blocks each cell is split."""

    def __init__(self, square: float, wide: int, sample: list, rows: int):
        self.square, self.wide = square, wide
        cells = int(min(PIVOTS, -(-rows // BLOCK)))
        self.pivots = pivots_of(augmented(self.widened(sample), square), cells) if rows else np.empty((0, wide + 1))
        self.radius, self.parts = np.zeros(len(self.pivots)), np.zeros(len(self.pivots), np.int64)

    def widened(self, vectors) -> np.ndarray:
        """Vectors with zeros behind them, up to the widest."""
        out = np.zeros((len(vectors), self.wide))
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        return out

    def nearest(self, vectors) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector, and its distance from the pivot."""
        x = augmented(self.widened(vectors), self.square)
        cell = ((self.pivots**2).sum(1) - 2 * x @ self.pivots.T).argmin(1)
        return cell.astype(np.int32), far(x, self.pivots[cell])

    def routes(self, vectors, lows, highs) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (anchor, cell) where the cell's ball reaches one of the anchor's windows."""
        q = self.widened(vectors)
        up, down = ball_bounds(q @ self.pivots[:, :-1].T, self.radius, (q * q).sum(1)[:, None], self.square)
        hit = np.zeros_like(up, bool)
        for i, (low, high) in enumerate(zip(lows, highs)):
            for lo, hi in zip(low, high):
                hit[i] |= (up[i] >= lo) & (down[i] <= hi)
        return np.nonzero(hit & (self.parts > 0))


def build_index(rows: DataFrame) -> tuple[DataFrame, Cells]:
    """The trees of all blocks as a table of their points, and the cells above them."""
    # One row: number of candidates, widest vector, largest square.
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    n, wide, most = rows.agg(F.count("*"), F.max("dim"), F.max(square)).first()
    if (most or 0) >= EXACT:
        raise ArithmeticError("inner products exceed 53 bits")
    sample = rows.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE).select("v").toPandas()["v"].tolist()
    cells = Cells(float(most or 0.0), int(wide or 0), sample, n)

    def place(batches):
        for pdf in batches:
            if len(pdf):
                pdf["cell"], pdf["far"] = cells.nearest(pdf["v"].tolist())
                yield pdf

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rid")
        x = augmented(matrix(pdf["v"].tolist(), int(pdf["dim"].iloc[0])), cells.square)
        parent, radius = cover_tree(x)
        out = pdf[["dim", "cell", "part", "rid", "vec_id", "label", "v"]]
        return out.assign(pos=np.arange(len(pdf)), parent=parent, radius=radius)

    columns = "rid long, vec_id long, label long, v array<long>, dim int, cell int"
    placed = save(
        rows.select("rid", "vec_id", "label", "v", "dim").mapInPandas(place, columns + ", far double"), "negatives-cells"
    )
    # At most PIVOTS rows.
    for cell, size, radius in placed.groupBy("cell").agg(F.count("*"), F.max("far")).collect():
        cells.parts[cell], cells.radius[cell] = -(-size // BLOCK), radius
    parts = F.array(*[F.lit(int(p)) for p in cells.parts]) if n else F.array(F.lit(1))
    split = F.pmod(F.xxhash64(F.lit(5), "rid"), F.get(parts, F.col("cell"))).cast("int")
    # About BLOCK rows to a group.
    trees = placed.withColumn("part", split).groupBy("dim", "cell", "part")
    trees = save(trees.applyInPandas(build, columns + ", part int, pos long, parent long, radius double"), "negatives-trees")
    return trees, cells


def routed(asked: DataFrame, cells: Cells) -> DataFrame:
    """``asked(rid, vec_id, label, v, dim, low, high)`` once for each block that may hold rows of a window."""

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                row, cell = cells.routes(part["v"].tolist(), part["low"], part["high"])
                if len(row):
                    times = cells.parts[cell]
                    out = part.iloc[np.repeat(row, times)].copy()
                    out["cell"] = np.repeat(cell, times).astype(np.int32)
                    out["part"] = np.concatenate([np.arange(t) for t in times]).astype(np.int32)
                    yield out

    columns = "rid long, vec_id long, label long, v array<long>, dim int, low array<double>, high array<double>"
    asked = asked.select("rid", "vec_id", "label", "v", "dim", "low", "high")
    return asked.mapInPandas(run, columns + ", cell int, part int")


def search(trees: DataFrame, cells: Cells, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """``(rid, window, found_rid, found_id, score, rank)``: the best k rows in each window of each anchor.

    ``same`` asks for rows of the anchor's label, else for all others.
    """
    key, square = ["dim", "cell", "part"], cells.square
    cols = [*key, "asks", "rid", "vec_id", "label", "v", "pos", "parent", "radius", "low", "high"]
    none = F.lit(None).cast("array<double>")
    nodes = trees.withColumns({"asks": F.lit(False), "low": none, "high": none}).select(*cols)
    long_, double = F.lit(None).cast("long"), F.lit(None).cast("double")
    asks = routed(asked, cells).withColumns({"asks": F.lit(True), "pos": long_, "parent": long_, "radius": double})
    both = nodes.unionByName(asks.select(*cols))
    dealt = both.repartition(shuffle_parts(trees.sparkSession), *key).sortWithinPartitions(*key, "asks", "pos")

    def run(batches):
        at, held, tree = None, [], None
        for pdf in batches:
            names = list(zip(pdf["dim"], pdf["cell"], pdf["part"], pdf["asks"]))
            starts = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]] + [len(names)]
            for a, b in zip(starts[:-1], starts[1:]):
                block, asking = names[a][:3], names[a][3]
                if block != at:
                    at, held, tree = block, [], None
                if not asking:
                    held.append(pdf.iloc[a:b])
                    continue
                if tree is None and held:
                    tree, held = made(pd.concat(held), block[0]), []
                if tree is not None:
                    yield answers(tree, pdf.iloc[a:b])

    def made(rows, dim):
        ids = [rows[c].to_numpy(np.int64) for c in ("vec_id", "label", "rid")]
        parent, radius = rows["parent"].to_numpy(np.int64), rows["radius"].to_numpy(np.float64)
        return Tree(matrix(rows["v"].tolist(), dim), square, *ids, parent, radius)

    def answers(tree, rows):
        out = []
        for rid, label, v, low, high in zip(rows["rid"], rows["label"], rows["v"], rows["low"], rows["high"]):
            hits = tree.search(np.asarray(v, np.float64), rid, label, same, np.asarray(low), np.asarray(high), k)
            for w, (r, s) in enumerate(hits):
                out += zip([rid] * len(r), [w] * len(r), tree.rids[r], tree.ids[r], s.astype(np.int64))
        return pd.DataFrame(out, columns=["rid", "window", "found_rid", "found_id", "score"])

    hits = dealt.mapInPandas(run, "rid long, window int, found_rid long, found_id long, score long")
    order = W.partitionBy("rid", "window").orderBy(F.desc("score"), "found_id", "found_rid")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` as made by ``prepared``, ``anchors`` some of them.  Negatives are
    rows of another label whose score is between ``low`` and ``high`` percent
    of the positive's.
    """
    trees, cells = build_index(rows)
    everything = F.array(F.lit(float("-inf"))), F.array(F.lit(float("inf")))
    asked = anchors.withColumns({"low": everything[0], "high": everything[1]})
    best = save(search(trees, cells, asked, True, positives), "negatives-positives")
    # At most ``positives`` windows to an anchor, in order of rank.
    entry = F.struct("rank", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    listed = best.where("score >= 0").groupBy("rid").agg(F.array_sort(F.collect_list(entry)).alias("best"))
    # The smallest and largest whole score in the window, divided without a remainder.
    hundredth = lambda x: (x - F.pmod(x, F.lit(WHOLE))) / F.lit(WHOLE)
    lows = F.transform("best", lambda b: hundredth(b["positive_score"] * F.lit(low) + F.lit(WHOLE - 1)))
    highs = F.transform("best", lambda b: hundredth(b["positive_score"] * F.lit(high)))
    asked = save(anchors.join(listed, "rid").withColumns({"low": lows, "high": highs}), "negatives-windows")
    found = search(trees, cells, asked.drop("best"), False, negatives)
    told = found.join(asked.select("rid", F.col("vec_id").alias("anchor_id"), "best"), "rid")
    told = told.withColumn("b", F.element_at("best", F.col("window") + 1))
    return told.select(
        "anchor_id",
        "b.positive_id",
        "rank",
        F.col("found_id").alias("negative_id"),
        "b.positive_score",
        F.col("score").alias("negative_score"),
    )


def op13_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(table(spark, sf_dir, "embeddings"))
    return hard_negatives(rows, rows.where(F.col("vec_id") % ANCHOR_STEP == 0))


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, c.rid, c.vec_id, a.label = c.label AS same,
         list_inner_product(a.v, c.v)::BIGINT AS score
  FROM v a JOIN v c ON c.rid <> a.rid AND len(c.v) = len(a.v)
  WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY arid ORDER BY score DESC, vec_id, rid) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.arid, p.rid ORDER BY n.score DESC, n.vec_id, n.rid)::INT AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.arid = p.arid AND NOT n.same
WHERE 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""

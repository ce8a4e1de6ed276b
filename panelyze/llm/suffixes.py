"""Repeated byte strings through a sparse suffix array built by merge sort.

The suffix array is sparse: of all suffixes it holds those that start at
anchors.  The anchor of a string of ``WINDOW`` bytes is the stretch of ``SEED``
bytes in it with the smallest hash, so equal strings have equal anchors at equal
places, and neighbouring strings mostly share one; all strings with the same
anchor occurrence are its region.  Suffixes whose seed occurs once in the corpus
cannot repeat and are dropped first.

1. The suffixes, cut at the end of the region and followed by the region's bytes
   before the anchor in reverse, are sorted by ``lcpsort``.  Equal ones are
   regions that repeat whole.  The prefix shared with a neighbour says how far
   right, and behind the region's end how far left, a region repeats.
2. Regions of one seed that differ are also sorted by the bytes before the
   anchor, backward: the farthest to the left that any match goes.
3. Between these two bounds a string may repeat.  Those that a neighbour of
   the sort has too are known from it.  The others are written out as a hash,
   once for each distinct region, and counted; of neighbours that share a string
   the first writes it out.

Strings found are joined to maximal runs, whose bytes are removed; every
occurrence goes, also within one document.

Defined cases: a text may be of any length (its task holds it whole, its
windows in stretches); a null text is empty; texts under ``WINDOW`` bytes are kept; rows
that repeat are occurrences of each other; a null id takes part like any other;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelyze.llm import anchors as A
from panelyze.llm.common import blocks, discard, mix64, save, table
from panelyze.llm.lcpsort import common_prefix, neighbours
from panelyze.llm.substrings import kept_mask

WINDOW, SEED = 400, 32
# Strings lie less than 2**P_BITS bytes left of their anchor.
P_BITS = 9
# Of strings in a batch, and of texts whose windows are worked on at once (their arrays then fit the processor's cache).
BLOCK_BYTES, SCAN_BYTES = 1 << 20, 1 << 18
# Regions whose seeds are compared before they are dealt, and what is seen then.
SEED_ROWS = 1 << 18
AGAIN, LATER = 1, 2
# Random 64-bit numbers for the 256 byte values.
_SYMBOLS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def text_key() -> Column:
    """A text's hash, by which runs are matched with it; a null text has that of an empty one."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


class Windows:
    """Windows, anchors and hashes of a block of byte strings."""

    def __init__(self, parts: list[bytes]):
        self.ends = np.cumsum([len(p) for p in parts])
        self.begin = np.r_[0, self.ends[:-1]]
        self.rolling = A.Rolling(_SYMBOLS[np.frombuffer(b"".join(parts), np.uint8)])
        self.starts = A.window_starts(self.ends, WINDOW)
        self.anchors = A.window_anchors(self.rolling, self.starts, WINDOW, SEED)


def _byte_blocks(pdf: pd.DataFrame, limit: int):
    data = pdf["text"].tolist()
    for a, b in blocks(np.array([len(d) for d in data]), limit):
        yield pdf.iloc[a:b], data[a:b]


# Stands for a null id wherever rows are matched by id.
NO_ID = -(1 << 63)


def seed_regions(texts: DataFrame) -> DataFrame:
    """``(seed, k, d, lo, hi, at, seen)``: first and last window of each region of ``texts(d, k, text)`` and its anchor.

    Of the rows at hand with one seed the first has 0 or, if there are more,
    ``AGAIN`` for ``seen`` and the others ``LATER``.
    """

    stretch = A.STRETCH

    def marked(rows):
        pdf = pd.concat(rows, ignore_index=True)
        _, first, n = np.unique(pdf["seed"].to_numpy(), return_index=True, return_counts=True)
        seen = np.full(len(pdf), LATER, np.int8)
        seen[first] = np.where(n > 1, AGAIN, 0)
        return pdf.assign(seen=seen)

    def run(batches):
        for pdf in batches:
            rows, size = [], 0
            for part, data in _byte_blocks(pdf, SCAN_BYTES):
                keys, ids = part["k"].to_numpy(np.int64), part["d"].to_numpy(np.int64)
                for w, doc, begin, first, last in A.region_stretches(data, Windows, stretch):
                    if not len(first):
                        continue
                    lo, hi, at = w.starts[first], w.starts[last], w.anchors[first]
                    out = {"seed": w.rolling(at, at + SEED).view(np.int64), "k": keys[doc], "d": ids[doc]}
                    for c, v in (("lo", lo), ("hi", hi), ("at", at)):
                        out[c] = (v - begin).astype(np.int32)
                    rows.append(pd.DataFrame(out))
                    size += len(first)
                    if size > SEED_ROWS:
                        yield marked(rows)
                        rows, size = [], 0
            if rows:
                yield marked(rows)

    return texts.mapInPandas(run, "seed long, k long, d long, lo int, hi int, at int, seen byte")


def found_again(batches, first: str, *more: str, alone=None):
    """The rows whose ``first`` and ``more`` also stand in another row, or for which ``alone(rows)`` holds.

    Batches come sorted by ``first``; between them one row is held of each
    distinct key that has the last ``first``.
    """
    held, told = None, np.empty(0, bool)
    for pdf in batches:
        if not len(pdf):
            continue
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        told = np.r_[told, np.zeros(len(pdf) - len(told), bool)]
        if more:
            order = np.lexsort([pdf[c].to_numpy() for c in (*more[::-1], first)])
            pdf, told = pdf.iloc[order], told[order]
        same = np.ones(len(pdf) - 1, bool)
        for c in (first, *more):
            v = pdf[c].to_numpy()
            same &= v[1:] == v[:-1]
        again = np.r_[False, same] | np.r_[same, False]
        if alone is not None:
            again |= alone(pdf)
        yield pdf.loc[again & ~told]
        # Of equal rows the first stands for all; it has gone out if any has.
        v = pdf[first].to_numpy()
        rest = np.r_[True, ~same] & (v == v[-1])
        held, told = pdf.loc[rest], (again | told)[rest]


def repeated_seeds(seeds: DataFrame) -> DataFrame:
    """``(k, d, lo, hi, at, copies)``: the regions whose seed occurs more than once.

    Equal texts come once, with a count, from the one of the smallest id.  Rows
    that are known to repeat where they are made go anywhere, but for the first
    of them, so the rows of a very common seed do not meet in one task.
    """

    def run(batches):
        for pdf in found_again(batches, "seed", alone=lambda pdf: pdf["seen"].to_numpy() > 0):
            yield pdf[["k", "d", "lo", "hi", "at"]]

    dealt = F.when(F.col("seen") == LATER, F.xxhash64("seed", "k", "lo")).otherwise(F.col("seed"))
    often = seeds.repartition(dealt).sortWithinPartitions("seed")
    often = often.mapInPandas(run, "k long, d long, lo int, hi int, at int")
    return often.groupBy("k", "lo", "hi", "at").agg(F.count("*").alias("copies"), F.min("d").alias("d"))


def columns_of(grouped, *names: str) -> DataFrame:
    """A group's rows as arrays of numbers, one for each column, which reach Python as such and not as objects."""
    rows = grouped.agg(F.collect_list(F.struct(*names)).alias("rows"))
    keys = [c for c in rows.columns if c != "rows"]
    return rows.select(*keys, *[F.transform("rows", lambda r: r[n]).alias(n) for n in names])


def runs_of(ps: str) -> Column:
    """``(lo, hi)`` runs of consecutive numbers in a column of sorted arrays; an expression would be made anew for each number."""
    first = F.filter(ps, lambda p, i: (i == 0) | (p != F.get(ps, i - 1) + 1))
    last = F.filter(ps, lambda p, i: (i == F.size(ps) - 1) | (p != F.get(ps, i + 1) - 1))
    return F.arrays_zip(first.alias("lo"), last.alias("hi"))


# Where a text stands behind its places.
BEHIND = (1 << 31) - 1


def region_strings(texts: DataFrame, places: DataFrame) -> DataFrame:
    """``(k, lo, hi, at, copies, s)``: ``places`` with the string that stands for their region in the sort.

    Places and texts are dealt by text and sorted, places before their text;
    a text without places, or equal to the one before, goes no further.
    """
    order, told = ["d", "k", "lo"], ["k", "lo", "hi", "at", "copies"]
    none = [F.lit(0).cast(t).alias(c) for c, t in (("hi", "int"), ("at", "int"), ("copies", "long"))]
    behind = texts.select("d", "k", F.lit(BEHIND).alias("lo"), *none, "text")
    before = places.select("d", *told, F.lit(None).cast("binary").alias("text"))
    mixed = before.unionByName(behind).repartition("d", "k")
    mixed = mixed.withColumn("last", F.lag("lo").over(Window.partitionBy("d", "k").orderBy("lo")))
    mixed = mixed.where((F.col("lo") < BEHIND) | (F.col("last") < BEHIND)).sortWithinPartitions(*order)

    def run(batches):
        held = None
        for pdf in batches:
            if held is not None and len(held):
                pdf = pd.concat([held, pdf], ignore_index=True)
            columns, texts = {c: pdf[c].to_numpy() for c in told}, pdf["text"].tolist()
            ends = np.flatnonzero(columns["lo"] == BEHIND)
            upto = int(ends[-1]) + 1 if len(ends) else 0
            rows = np.flatnonzero(columns["lo"][:upto] < BEHIND)
            columns, whose = {c: v[rows] for c, v in columns.items()}, ends[np.searchsorted(ends, rows)]
            out, size, done, last = [], 0, 0, -1
            for i, lo, hi, at in zip(whose.tolist(), *(columns[c].tolist() for c in ("lo", "hi", "at"))):
                if i != last:
                    data, last = bytes(texts[i]), i
                right = hi + WINDOW - at
                out.append(data[at : at + right] + data[lo:at][::-1] + right.to_bytes(2, "big"))
                size += len(out[-1])
                if size > BLOCK_BYTES:
                    yield pd.DataFrame({c: v[done : done + len(out)] for c, v in columns.items()} | {"s": out})
                    out, size, done = [], 0, done + len(out)
            if out:
                yield pd.DataFrame({c: v[done:] for c, v in columns.items()} | {"s": out})
            held = pdf.iloc[upto:]

    return mixed.select(*told, "text").mapInPandas(run, "k long, lo int, hi int, at int, copies long, s binary")


def right_of(s: bytes) -> int:
    return int.from_bytes(s[-2:], "big")


# From where to where left of the anchor strings start that the neighbour before and the one behind has too.
SHARED = ("before_lo", "before_hi", "behind_lo", "behind_hi")


def _right_facts(s, before_prefix, before, behind_prefix, behind):
    """How far right the region repeats, how far left where it repeats to its end (-1: it does not), and what ``SHARED`` names."""
    right, size = right_of(s), len(s) - 2
    far, left, shared = 0, -1, []
    for h, other in ((before_prefix, before), (behind_prefix, behind)):
        low, high = 1, 0
        if other is not None:
            ends = right_of(other)
            far = max(far, min(h, right))
            if h >= right and ends == right:
                left = max(left, min(h, size, len(other) - 2) - right)
            h = min(h, right, ends)
            if h >= SEED and h + size - right >= WINDOW:
                low, high = WINDOW - h, common_prefix(s[right:-2], other[ends:-2])
        shared += [low, high]
    return far, left, *shared


def _may_part(s, mult, far, left):
    """Whether a string of the region may repeat elsewhere than as a whole region."""
    right = right_of(s)
    return far >= SEED and far + (len(s) - 2 - right) >= WINDOW


def _left_facts(s, before_prefix, before, behind_prefix, behind):
    return max(before_prefix if before is not None else 0, behind_prefix if behind is not None else 0), 0


def part_strings(classes: DataFrame) -> DataFrame:
    """``(h1, h2, key)``: each string p bytes left of the anchor that the two bounds leave open.

    Strings that the neighbour before has too are left to it: the first of
    neighbours that share a string writes it out.  The key is one number: the
    class, P_BITS of p, and whether the class occurs more than once.
    """
    columns = ("cls", "s", "mult", "x", "back", *SHARED[:2])

    def run(batches):
        for pdf in batches:
            bodies, jobs, size = [], [], 0
            for cls, s, mult, far, back, low, high in zip(*(pdf[c].tolist() for c in columns)):
                right = right_of(s)
                left = len(s) - 2 - right
                most, least = min(left, back - SEED), max(WINDOW - far, 0)
                open_ = [(least, most)] if low > high else [(least, min(most, low - 1)), (max(least, high + 1), most)]
                open_ = [(x, y) for x, y in open_ if x <= y]
                if not open_:
                    continue
                jobs += [(cls, mult, size + left, x, y) for x, y in open_]
                bodies.append(s[right:-2][::-1] + s[:right])
                size += len(bodies[-1])
                if size > BLOCK_BYTES:
                    yield hashed(bodies, jobs)
                    bodies, jobs, size = [], [], 0
            if jobs:
                yield hashed(bodies, jobs)

    def hashed(bodies, jobs):
        rolling = A.Rolling(_SYMBOLS[np.frombuffer(b"".join(bodies), np.uint8)])
        cls, mult, at, least, most = (np.array(c, np.int64) for c in zip(*jobs))
        n = most - least + 1
        p = np.repeat(least - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        start, anchor = np.repeat(at, n) - p, np.repeat(at, n)
        h2 = mix64(rolling(anchor, anchor + SEED) + p.astype(np.uint64))
        out = {"h1": rolling(start, start + WINDOW).view(np.int64), "h2": h2.view(np.int64)}
        return pd.DataFrame(out | {"key": (np.repeat(cls << P_BITS, n) + p) * 2 + np.repeat(mult > 1, n)})

    return classes.mapInPandas(run, "h1 long, h2 long, key long")


def repeated_parts(parts: DataFrame) -> DataFrame:
    """``(cls, lo, hi)``: runs of p of the ``parts`` that also stand elsewhere, of classes that occur once."""

    def repeated(batches):
        for pdf in found_again(batches, "h1", "h2"):
            key = pdf["key"].to_numpy()
            yield pd.DataFrame({"at": key[key & 1 == 0] >> 1})

    def joined(batches):
        # A run that reaches over batches stays in two.
        for pdf in batches:
            at = pdf["at"].to_numpy()
            first = np.flatnonzero(np.r_[len(at) > 0, at[1:] != at[:-1] + 1])
            p, last = at & ((1 << P_BITS) - 1), np.r_[first[1:], len(at)][: len(first)] - 1
            yield pd.DataFrame({"cls": at[first] >> P_BITS, "lo": p[first].astype(np.int32), "hi": p[last].astype(np.int32)})

    # Sorted by one number each time, which Spark does without comparing rows.
    found = parts.repartition("h1").sortWithinPartitions("h1").mapInPandas(repeated, "at long")
    found = found.repartition(F.shiftright("at", P_BITS)).sortWithinPartitions("at")
    return found.mapInPandas(joined, "cls long, lo int, hi int")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """``(k, lo, hi)``: by text hash, runs of starts of strings that occur elsewhere."""
    texts = docs.where(F.col("text").isNotNull())
    texts = texts.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("d"), text_key().alias("k"), F.col("text").cast("binary").alias("text")
    )
    hits = repeated_seeds(seed_regions(texts))
    strings = save(region_strings(texts, hits), "suffix-strings")
    told, parting = neighbours(strings, _right_facts, _may_part, "suffix-right", SHARED)
    discard(strings)

    def turned(batches):
        for pdf in batches:
            out = []
            for s in pdf["s"]:
                right = right_of(s)
                out.append(s[:SEED][::-1] + s[right:-2])
            yield pd.DataFrame({"id": pdf["cls"], "s": out})

    lefts = save(parting.select("cls", "s").mapInPandas(turned, "id long, s binary"), "suffix-left")
    back, _ = neighbours(lefts, _left_facts, lambda *a: False, "suffix-back")
    discard(lefts)
    back = back.select(
        F.col("id").alias("cls"), F.when(F.col("mult") > 1, F.lit(1 << 30)).otherwise(F.col("x")).alias("back")
    )
    found = repeated_parts(part_strings(parting.join(back.hint("merge"), "cls")))
    for lo, hi in (SHARED[:2], SHARED[2:]):
        known = parting.where(f"mult = 1 and {lo} <= {hi}")
        found = found.unionByName(known.select("cls", F.col(lo).alias("lo"), F.col(hi).alias("hi")))
    by_class = save(found, "suffix-found")
    repeats = F.expr("mult > 1 or copies > 1")
    # Whole regions, and those that repeat to their end.
    whole = told.where(repeats | (F.col("y") >= 0)).select(
        "k", F.when(repeats, F.col("lo")).otherwise(F.greatest("lo", F.col("at") - F.col("y"))).alias("lo"), "hi"
    )
    # Starts lie p bytes left of the anchor.
    single = told.where(~repeats).select("k", "at", "cls").join(by_class.hint("merge"), "cls")
    single = single.select("k", (F.col("at") - F.col("hi")).alias("lo"), (F.col("at") - F.col("lo")).alias("hi"))
    return whole.where("lo <= hi").unionByName(single)


def deduplicated(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row per document."""
    by_text = save(columns_of(repeated_runs(docs).groupBy("k"), "lo", "hi"), "suffix-text-runs")

    def run(batches):
        for pdf in batches:
            out = []
            for doc_id, data, lo, hi in zip(pdf["doc_id"], pdf["text"], pdf["lo"], pdf["hi"]):
                data, spans = data or b"", 0
                kept = data
                if lo is not None and len(lo):
                    keep = kept_mask(len(data), lo.astype(np.int64), hi.astype(np.int64), WINDOW)
                    kept = np.frombuffer(data, np.uint8)[keep].tobytes()
                    spans = int((~keep & np.r_[True, keep[:-1]]).sum())
                out.append((doc_id, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
            out = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
            yield out.astype({"doc_id": "Int64"})

    keyed = docs.select("doc_id", F.col("text").cast("binary").alias("text"), text_key().alias("k"))
    wide = keyed.join(by_text.hint("merge"), "k", "left").select("doc_id", "text", "lo", "hi")
    return wide.mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op9_suffix_merge_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))

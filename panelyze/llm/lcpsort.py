"""Distributed merge sort of strings that uses common prefixes throughout.

Every task sorts its strings, keeps equal ones once, and front-codes the sorted
run: of each string only the length of the prefix that it shares with the one
before, and the rest.  Runs are cut at common splitters (whole strings from a
bounded sample, so strings with long common prefixes are cut apart too) and
exchanged.  A task merges the pieces of its range with a loser tree whose
entries know their common prefix with the last string that came out: the longer
one wins without looking at a byte, and only at a tie are bytes compared, from
the known prefix on.  What is known of the rows that hold a string travels with
the piece, so the merge tells the rows and not a later join; where a run has a
string more than ``CARRIED`` times, its rows stay behind and are joined, so that
a very common string does not fill the task that merges it.

The strings next to a range are the last one of the range before and the first
one of the range behind, which the ends of the pieces tell before anything is
merged: one row of each range, and two strings for its border.

Scale: a piece is part of one run in one range, and ranges number at most
``RANGES`` for each shuffle partition of the session, so pieces, and the sample
that the ranges are cut by, grow with runs and partitions, not with the square of
the data.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelyze.llm.common import discard, save, shuffle_parts

# Every run has a piece in every range; larger ones keep pieces few, and long enough to share prefixes.
RUN_BYTES = 16 << 20
RANGE_BYTES = 32 << 20
# For each shuffle partition, ranges at most; for each range, sampled strings.
RANGES, SAMPLED = 4, 8
# Rows of one string that travel with a run's piece; those that stay behind stand in no range.
CARRIED = 16
MEMBERS = -1
# Stands where a run stands, and before all of them.
BORDER = -1
# A class is numbered by its range and, in these low bits, within it.
CLASS_BITS = 32
# Strings that a merge holds back.
HELD = 4000


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common prefix, of which the first ``at`` bytes are known."""
    n, step = min(len(a), len(b)), 16
    while at < n:
        end = min(at + step, n)
        if a[at:end] == b[at:end]:
            at, step = end, min(2 * step, 512)
            continue
        while end - at > 1:
            mid = (at + end) >> 1
            if a[at:mid] == b[at:mid]:
                at = mid
            else:
                end = mid
        return at
    return n


def front_code(strings: list[bytes], entries: list[int], counts: list[int]) -> bytes:
    """A sorted run as bytes: prefix lengths, rest lengths, entries, counts, rests."""
    shared, rests, last = [], [], b""
    for s in strings:
        h = common_prefix(last, s)
        shared.append(h)
        rests.append(s[h:])
        last = s
    head = np.array([shared, [len(r) for r in rests], entries, counts], dtype=np.int32)
    return np.int32(len(strings)).tobytes() + head.tobytes() + b"".join(rests)


def decode(block: bytes):
    """``(prefix length, string, entry, count)`` of a front-coded run, in order."""
    n = int(np.frombuffer(block, np.int32, 1)[0])
    shared, lengths, entries, counts = np.frombuffer(block, np.int32, 4 * n, 4).reshape(4, n).tolist()
    at, s = 4 + 16 * n, b""
    for h, k, e, c in zip(shared, lengths, entries, counts):
        s = s[:h] + block[at : at + k]
        at += k
        yield h, s, e, c


class LoserTree:
    """Merge of sorted runs; yields ``(string, prefix shared with the one before, run, entry, count)``."""

    def __init__(self, runs):
        self.runs = [iter(r) for r in runs]
        k = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.known = [0] * k
        self.tree = [-1] * max(1, k)
        self.winner = -1
        for i in range(k):
            self._climb(i, True)

    def _climb(self, i: int, filling: bool = False) -> None:
        tree, heads, known, k = self.tree, self.heads, self.known, len(self.runs)
        node = (i + k) >> 1
        while node:
            j = tree[node]
            if j < 0:
                if filling:
                    tree[node] = i
                    return
            else:
                a, b = heads[i], heads[j]
                if a is None:
                    lost = b is not None
                elif b is None:
                    lost = False
                elif known[i] != known[j]:
                    lost = known[i] < known[j]
                else:
                    h = common_prefix(a[1], b[1], known[i])
                    lost = a[1][h : h + 1] > b[1][h : h + 1]
                    known[i if lost else j] = h
                if lost:
                    tree[node], i = i, j
            node >>= 1
        self.winner = i

    def __iter__(self):
        while self.winner >= 0 and (head := self.heads[self.winner]) is not None:
            i = self.winner
            yield head[1], self.known[i], i, head[2], head[3]
            nxt = next(self.runs[i], None)
            self.heads[i] = nxt
            self.known[i] = nxt[0] if nxt else 0
            self._climb(i)


def sorted_run(strings: list[bytes], ids: list[int]) -> tuple[list[bytes], list[int], np.ndarray]:
    """Distinct strings in order, their counts, and the entry of every id."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    out, counts, entry = [], [], np.empty(len(ids), np.int32)
    for i in order:
        if not out or out[-1] != strings[i]:
            out.append(strings[i])
            counts.append(0)
        counts[-1] += 1
        entry[i] = len(out) - 1
    return out, counts, entry


def cut(strings: list[bytes], splitters: list[bytes]) -> list[int]:
    """Start of each range in the sorted run (the first is 0, the last its length)."""
    from bisect import bisect_left

    return [0] + [bisect_left(strings, s) for s in splitters] + [len(strings)]


Facts = Callable[[bytes, int, bytes | None, int, bytes | None], tuple[int, ...]]


def neighbours(
    strings: DataFrame, facts: Facts, keep: Callable[[bytes, int, int, int], bool], name: str, more: tuple[str, ...] = ()
):
    """Sort ``strings(s, ...)`` and tell every distinct string about its neighbours.

    ``facts(s, prefix before, string before, prefix behind, string behind)``
    gives the numbers x, y and those named by ``more``.  Returns ``members(...,
    cls, mult, x, y)`` with the further columns, numbers that are not null, of
    all rows and ``kept(cls, s, mult, x, y, *more)`` for the distinct strings for
    which ``keep(s, mult, x, y)`` holds.
    """
    spark = strings.sparkSession
    carried = {f.name: f.dataType.simpleString() for f in strings.schema.fields if f.name != "s"}
    kinds = {c: np.dtype({"bigint": np.int64, "int": np.int32}[t]) for c, t in carried.items()}
    width = sum(k.itemsize for k in kinds.values())
    numbers = ("x", "y", *more)
    # One row: number and bytes of the strings.
    n, total = strings.agg(F.count("*"), F.sum(F.octet_length("s"))).first()
    parts = shuffle_parts(spark)
    ranges = min(max(parts, int(total or 0) // RANGE_BYTES + 1), RANGES * parts)
    rate = max(1, n // (SAMPLED * ranges))
    few = strings.where(F.pmod(F.xxhash64(F.lit(9), *carried), F.lit(rate)) == 0).select("s")
    # About SAMPLED strings for each range.
    sample = sorted({bytes(r["s"]) for r in few.collect()})
    splitters = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if len(sample) >= ranges else sample[1:]
    splitters = sorted(set(splitters))

    def runs(batches):
        part, seq = TaskContext.get().partitionId(), 0
        held, rows, size = [], [], 0

        def flush():
            out, counts, entry = sorted_run(held, range(len(held)))
            run = (part << 24) + seq
            by_entry = np.argsort(entry, kind="stable")
            columns = [np.concatenate([r[c] for r in rows])[by_entry] for c in kinds]
            light = np.array(counts) <= CARRIED
            stays = ~light[entry[by_entry]]
            left = [entry[by_entry][stays], *(c[stays] for c in columns)]
            columns = [c[~stays] for c in columns]
            # Of each string, its first row among those that travel; of others, their number, as a negative one.
            begin = np.r_[0, np.cumsum(np.where(light, counts, 0))]
            pieces = [(MEMBERS, run, b"".join(c.tobytes() for c in left), None, None, None)] if stays.any() else []
            edge = cut(out, splitters)
            for r in range(len(edge) - 1):
                a, b = edge[r], edge[r + 1]
                if a < b:
                    entries = np.where(light[a:b], begin[a:b] - begin[a], ~np.arange(a, b))
                    code = front_code(out[a:b], entries.tolist(), counts[a:b])
                    whose = b"".join(c[begin[a] : begin[b]].tobytes() for c in columns)
                    pieces.append((r, run, code, whose, out[a], out[b - 1]))
            return pd.DataFrame(pieces, columns=["range", "run", "block", "whose", "first", "last"])

        for pdf in batches:
            begin = 0
            values = {c: pdf[c].to_numpy(k) for c, k in kinds.items()}
            for i, s in enumerate(pdf["s"].tolist(), 1):
                held.append(bytes(s))
                size += len(s)
                if size > RUN_BYTES:
                    rows.append({c: v[begin:i] for c, v in values.items()})
                    yield flush()
                    held, rows, size, seq, begin = [], [], 0, seq + 1, i
            rows.append({c: v[begin:] for c, v in values.items()})
        if held:
            yield flush()

    piece = "range int, run long, block binary, whose binary, first binary, last binary"
    coded = save(strings.mapInPandas(runs, piece), f"{name}-runs")
    pieces = coded.where(F.col("range") != MEMBERS)
    # One row for each range that holds strings.
    ends = pieces.groupBy("range").agg(F.min("first").alias("lo"), F.max("last").alias("hi"))
    order = Window.orderBy("range")
    none = F.lit(None).cast("binary")
    borders = ends.select(
        "range",
        F.lit(BORDER).cast("long").alias("run"),
        none.alias("block"),
        none.alias("whose"),
        F.lag("hi").over(order).alias("first"),
        F.lead("lo").over(order).alias("last"),
    )

    def merged(batches):
        group, at, beside = [], None, (None, None)
        for pdf in batches:
            for r, run, block, whose, first, last in zip(*(pdf[c] for c in ("range", "run", "block", "whose", "first", "last"))):
                if run == BORDER:
                    if group:
                        yield from one_range(at, group, *beside)
                    group, at = [], r
                    beside = tuple(None if s is None else bytes(s) for s in (first, last))
                else:
                    group.append((bytes(block), whose, run))
        if group:
            yield from one_range(at, group, *beside)

    def one_range(at, group, before, after):
        # Columns of all pieces, and where each piece begins in them.
        sizes = [len(whose) // width for _, whose, _ in group]
        base, columns, skip = [0, *np.cumsum(sizes).tolist()], {}, 0
        for c, k in kinds.items():
            got = [np.frombuffer(whose, k, m, skip * m) for (_, whose, _), m in zip(group, sizes)]
            columns[c] = np.concatenate([*got, np.zeros(1, k)])
            skip += k.itemsize
        classes, places, number = [], [], 0
        # What is known of the present string: [string, prefix shared with the one before, contributions, their sum].
        cur = None

        def close(behind, prefix):
            nonlocal number
            s, known, whose, mult = cur
            told = facts(s, known, before, prefix, behind)
            classes.append((number, mult, sum(p[1] for p in whose), s if keep(s, mult, *told[:2]) else None, *told))
            places.extend(whose)
            number += 1

        def frame():
            start, count, run, entry = np.array(places, np.int64).T
            rows = np.repeat(start - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
            out = pd.DataFrame({c: v[rows] for c, v in columns.items()})
            out["run"], out["entry"] = np.repeat(run, count), np.repeat(entry.astype(np.int32), count)
            cls, mult, n, kept, *told = zip(*classes)
            out["cls"] = np.repeat((int(at) << CLASS_BITS) + np.array(cls, np.int64), n)
            out["mult"] = np.repeat(np.array(mult, np.int64), n)
            for c, v in zip(numbers, told):
                out[c] = np.repeat(np.array(v, np.int32), n)
            # The string stands in the first row of its class.
            s = [None] * len(out)
            for row, v in zip((np.cumsum(n) - n).tolist(), kept):
                s[row] = v
            out["s"] = s
            return out

        for s, known, i, entry, count in LoserTree(decode(b) for b, *_ in group):
            same = cur is not None and known == len(s) == len(cur[0])
            if not same:
                if cur is not None:
                    close(s, known)
                    before = cur[0]
                    if len(places) > HELD:
                        yield frame()
                        classes, places = [], []
                elif before is not None:
                    known = common_prefix(before, s)
                cur = [s, known, [], 0]
            # Rows that stay behind: one row, for their run and entry.
            cur[2].append((base[i] + entry, count, BORDER, 0) if entry >= 0 else (base[-1], 1, group[i][2], ~entry))
            cur[3] += count
        close(after, 0 if after is None else common_prefix(cur[0], after))
        yield frame()

    blocks = pieces.withColumns({c: none for c in ("first", "last")}).unionByName(borders)
    blocks = blocks.repartition(len(splitters) + 1, "range")
    told = carried | {"run": "bigint", "entry": "int", "cls": "bigint", "mult": "bigint"}
    told |= dict.fromkeys(numbers, "int") | {"s": "binary"}
    done = blocks.sortWithinPartitions("range", "run").mapInPandas(merged, ", ".join(f"{c} {t}" for c, t in told.items()))
    done = save(done, f"{name}-merged")

    def unpack(batches):
        for pdf in batches:
            for run, block in zip(pdf["run"], pdf["block"]):
                n, at = len(block) // (width + 4), 0
                out = {"run": np.full(n, run)}
                for c, k in ({"entry": np.dtype(np.int32)} | kinds).items():
                    out[c] = np.frombuffer(block, k, n, at)
                    at += n * k.itemsize
                yield pd.DataFrame(out)

    left = ", ".join(f"{c} {t}" for c, t in ({"run": "bigint", "entry": "int"} | carried).items())
    left = coded.where(F.col("range") == MEMBERS).select("run", "block").mapInPandas(unpack, left)
    about = ["cls", "mult", *numbers]
    joined = left.join(done.where(F.col("run") != BORDER).select("run", "entry", *about).hint("merge"), ["run", "entry"])
    joined = save(joined.select(*carried, *about), f"{name}-members")
    discard(coded)
    members = done.where(F.col("run") == BORDER).select(*carried, *about).unionByName(joined)
    return members, done.where(F.col("s").isNotNull()).select("cls", "s", "mult", *numbers)

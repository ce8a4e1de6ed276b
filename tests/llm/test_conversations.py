"""The conversation trie against brute force and SQL on odd tables."""

import hashlib
import re
import zlib

import duckdb
import pytest

from panelyze.llm import trie
from panelyze.llm.common import WORD

SCHEMA = "conv_id long, turn long, role string, text string, k long, depth string, words int"


def conversations():
    rows = []

    def talk(c, *texts, start=0):
        rows.extend((c, start + i, "user" if i % 2 == 0 else "assistant", t, 7, "x", 1) for i, t in enumerate(texts))

    hot = ["same start", "same answer", "and on", "and on again", "fifth", "sixth turn"]
    for c in range(0, 60):
        talk(c, *hot[: c % 7])
    talk(61, "other start", *hot)
    talk(62, *[f"turn {i % 3}" for i in range(900)])
    talk(63, *[f"turn {i % 3}" for i in range(700)], "parts here")
    talk(80, "a", None, "", "  ")
    talk(81, "only one")
    # Kin of a conversation that is absent, shorter than what they drop.
    for c in range(101, 120):
        talk(c, *["x"] * (c % 4))
    talk(-5, "below", "zero")
    talk(1 << 40, "far " * 3000, "off")
    # One number for several turns, a null number, a repeated row, a null id.
    rows += [(200, 1, "user", "b", 0, None, None), (200, 1, "user", "a", 0, None, None), (200, 1, None, "c", 0, None, None)]
    rows += [(200, None, "user", "first", 0, None, None), (200, 1, "user", "a", 0, None, None)]
    rows += [(None, 0, "user", "nobody", 0, None, None)]
    return rows


def brute_force(rows):
    """The contract, word by word, over Python lists."""
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            md5 = hashlib.md5((text or "").encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, role or "", md5), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in own.items()}
    told = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        told[c] = own.get(base, [])[:h] + ts[h:]
    nodes = {}
    for c, ts in told.items():
        key = ()
        for d in range(len(ts) + 1):
            key = (key, ts[d - 1]) if d else ()
            nodes.setdefault(key, (d, []))[1].append((c, d == len(ts)))
    children, leaves, saved = {k: 0 for k in nodes}, {}, {}
    for k in nodes:
        if k:
            children[k[0]] += 1
    for k in sorted(nodes, key=lambda k: -nodes[k][0]):
        words = len(re.findall(WORD, k[1][1])) if k else 0
        leaves[k] = leaves.get(k, 0) + (children[k] == 0)
        saved[k] = saved.get(k, 0) + (len(nodes[k][1]) - 1) * words
        if k:
            leaves[k[0]] = leaves.get(k[0], 0) + leaves[k]
            saved[k[0]] = saved.get(k[0], 0) + saved[k]
    out = []
    for k, (d, members) in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c, last in members if last))
        parent = min(c for c, _ in nodes[k[0]][1]) if k else None
        row = (min(c for c, _ in members), d, parent, len(members), children[k], leaves[k], saved[k])
        out.append((*row, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def test_trie_equals_brute_force(spark, monkeypatch):
    rows = conversations()
    # Several pieces to a list of ids, and no child of a large parent left to the shuffle.
    monkeypatch.setattr(trie, "PIECE_BITS", 2)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = found(trie.trie(*trie.rebuilt(df)))
    assert got == brute_force(rows)


@pytest.mark.parametrize("block", [1, 3, 7])
def test_block_length_does_not_matter(spark, monkeypatch, block):
    rows = [r for r in conversations() if r[0] not in (62, 63)]
    monkeypatch.setattr(trie, "BLOCK", block)
    assert found(trie.trie(*trie.rebuilt(spark.createDataFrame(rows, SCHEMA)))) == brute_force(rows)


def test_conversations_as_they_are(spark):
    rows = [(c, t, "user", f"{t % 2}", 0, "", 0) for c in range(3) for t in range(5 + c)]
    got = found(trie.trie(*trie.whole(spark.createDataFrame(rows, SCHEMA))))
    assert [r[:6] for r in got[:2]] == [(0, 0, None, 3, 1, 1), (0, 1, 0, 3, 1, 1)]
    assert len(got) == 8


def test_long_conversation_is_spread(spark):
    rows = [(1, t, "user", "x", 0, "", 0) for t in range(4000)]
    turns, _ = trie.numbered_turns(spark.createDataFrame(rows, SCHEMA))
    sizes = [r["count"] for r in turns.groupBy("p").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 4000
    turns, ends = trie.whole(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r["pos"] for r in turns.collect()) == list(range(1, 4001))
    assert ends.collect()[0]["depth"] == 4000


def test_empty_table(spark):
    assert trie.trie(*trie.rebuilt(spark.createDataFrame([], SCHEMA))).collect() == []


def test_sql_agrees_on_odd_rows(spark):
    rows = [r for r in conversations() if r[0] not in (62, 63)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
    got = con.execute(trie.SQL).fetchall()
    assert sorted(got, key=lambda r: r[:2]) == brute_force(rows)

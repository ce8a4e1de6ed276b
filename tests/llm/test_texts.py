"""Text operators against brute force, on odd tables and on the small test table."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelyze.llm import anchors, lcpsort, mixing, neardup, packing, substrings, suffixes, toxicity
from panelyze.llm.common import table
from tests.llm.cases import odd_docs

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module", params=["odd", "table"])
def docs(request, spark):
    return odd_docs(spark) if request.param == "odd" else table(spark, SF, "documents")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_near_duplicates_match_all_pairs(docs):
    rows = [(i, shingles(t)) for i, t in pairs(docs)]
    ids = sorted({i for i, _ in rows if i is not None})
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    known = [(i, s) for i, s in rows if i is not None and s]
    for a, (i, s) in enumerate(known):
        for j, t in known[:a]:
            both = len(s & t)
            if 100 * both >= 75 * (len(s) + len(t) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    sets = dict(rows)
    want = Counter((i, len(sets[i]), find(i) if i is not None else None) for i, _ in rows if i is not None)
    got = neardup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == want
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)
    assert len(got) == len(rows)


def test_rows_that_share_an_id(spark):
    base = [f"w{i}" for i in range(60)]
    near = base[:58] + ["other", "end"]
    far = [f"v{i}" for i in range(60)]
    far_near = far[:58] + ["other", "end"]
    rows = [
        (1, "nothing like it at all here"), (1, " ".join(base)), (3, " ".join(near)),
        (9, " ".join(far)), (9, " ".join(base)), (7, " ".join(far_near)),
        (20, None), (20, " ".join(far_near)), (20, "  "), (21, ""), (21, "alone in its kind"),
    ]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {(r.doc_id, r.component_id) for r in got if r.n_shingles} == {(1, 1), (3, 1), (9, 1), (7, 1), (20, 1), (21, 21)}
    assert len(got) == len(rows) and {r.doc_id for r in got if r.kept} >= {1, 21}


def test_group_of_near_copies_without_a_centre(spark, monkeypatch):
    """Chains of links under common keys, in several blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = np.random.default_rng(2)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for at in rng.choice(120, 1 + i % 4, replace=False):
            w[at] = f"e{i}_{at}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    test_near_duplicates_match_all_pairs(df)


def test_empty_tables(spark):
    none = odd_docs(spark).limit(0)
    for f in (neardup.near_duplicates, substrings.deduplicated, suffixes.deduplicated, packing.pack, mixing.mix):
        assert f(none).collect() == []
    assert toxicity.score(none, toxicity.fit(none, spark.createDataFrame([], "doc_id long, toxic int"))).collect() == []


def kept_bytes(data, starts, width):
    keep = np.ones(len(data), bool)
    for s in starts:
        keep[s : s + width] = False
    return keep


def test_word_windows_match_brute_force(docs):
    rows = pairs(docs)
    first = {}
    cut = lambda t: [x.encode() for x in WORD.findall(t or "")]
    for i, t in rows:
        w = cut(t)
        for s in range(len(w) - 49):
            if i is not None:
                k = tuple(w[s : s + 50])
                first[k] = min(i, first.get(k, i))
    want = Counter()
    for i, t in rows:
        w = cut(t)
        starts = [s for s in range(len(w) - 49) if i is not None and first[tuple(w[s : s + 50])] < i]
        keep = kept_bytes(w, starts, 50)
        out = [x for x, k in zip(w, keep) if k]
        want[i, len(w), len(w) - len(out), hashlib.sha256(b" ".join(out)).hexdigest()] += 1
    got = Counter(tuple(r) for r in substrings.deduplicated(docs).collect())
    assert got == want


def test_cleaned_keeps_columns_and_clean_texts(spark):
    docs = odd_docs(spark)
    out = substrings.cleaned(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[4].text == docs.where("doc_id = 4").first().text and got[5].text == ""
    assert got[9].text == "before it and after" and got[1].text is None and got[3].text == " \t\n "


def brute_bytes(rows, width):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s : s + width] for _, b in data for s in range(len(b) - width + 1))
    out = Counter()
    for i, b in data:
        keep = kept_bytes(b, [s for s in range(len(b) - width + 1) if seen[b[s : s + width]] > 1], width)
        kept = bytes(x for x, k in zip(b, keep) if k)
        spans = sum(1 for p in range(len(b)) if not keep[p] and (p == 0 or keep[p - 1]))
        out[i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_byte_strings_match_brute_force(docs):
    rows = pairs(docs)
    if len(rows) > 100:
        rows = [r for r in rows if len(r[1] or "") < 6000]
        docs = docs.where("coalesce(length(text), 0) < 6000")
    assert Counter(tuple(r) for r in suffixes.deduplicated(docs).collect()) == brute_bytes(rows, 400)


def test_byte_strings_of_little_variety(spark, monkeypatch):
    """Runs, periods and short matches that part within a region on both sides."""
    rng = np.random.default_rng(4)
    core = "".join(rng.choice(list("abcdefgh"), 3000))
    rows = [(0, "z" * 1500), (1, "ab" * 700), (2, "z" * 399), (3, "ab" * 199)]
    for i in range(4, 60):
        a = int(rng.integers(0, 2300))
        noise = ["".join(rng.choice(list("ijkl"), 30)) for _ in range(2)]
        rows.append((i, noise[0] + core[a : a + int(rng.integers(300, 700))] + noise[1]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in suffixes.deduplicated(df).collect()) == brute_bytes(rows, 400)


def test_long_texts_go_in_stretches(spark, monkeypatch):
    """Texts of many stretches, copies that part at any place, and empty texts in the same block."""
    monkeypatch.setattr(anchors, "STRETCH", 900)
    rng = np.random.default_rng(21)
    core = [f"c{i % 61}x{i}" for i in range(2500)]
    rows = [(0, ""), (1, None), (2, " ".join(core)), (3, "short one")]
    for i in range(4, 16):
        a, b = sorted(rng.integers(0, 2500, 2).tolist())
        rows.append((i, " ".join([f"n{i}"] + core[a:b] + [f"m{i}"] + core[b : b + 70])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    test_word_windows_match_brute_force(df)
    assert Counter(tuple(r) for r in suffixes.deduplicated(df).collect()) == brute_bytes(rows, 400)


@pytest.mark.parametrize("module", [suffixes, substrings])
def test_regions_of_a_text_longer_than_a_block_may_be(monkeypatch, module):
    rng = np.random.default_rng(22)
    text = rng.integers(97, 123, 9000, dtype=np.uint8).tobytes()
    parts = [b"", text] if module is suffixes else [np.empty(0, np.uint64), suffixes._SYMBOLS[np.frombuffer(text, np.uint8)]]

    def found(stretch):
        return [
            (int(d), int(w.starts[a] - s), int(w.starts[b] - s), int(w.anchors[a] - s), int(w.rolling(w.starts[[a]], w.starts[[b]] + module.WINDOW)[0]))
            for w, doc, begin, first, last in anchors.region_stretches(parts, module.Windows, stretch)
            for d, s, a, b in zip(doc, begin, first, last)
        ]

    whole = found(1 << 20)
    monkeypatch.setattr(anchors, "_POS_BITS", 13)
    with pytest.raises(ValueError):
        module.Windows(parts)
    assert found(1000) == whole


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.lists(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=12), min_size=1, max_size=7))
def test_loser_tree_sorts_and_knows_prefixes(lists):
    runs, flat = [], []
    for one in lists:
        strings, counts, _ = lcpsort.sorted_run(one, list(range(len(one))))
        runs.append(lcpsort.decode(lcpsort.front_code(strings, list(range(len(strings))), counts)))
        flat += strings
    out = list(lcpsort.LoserTree(runs))
    assert [o[0] for o in out] == sorted(flat)
    last = b""
    for s, h, *_ in out:
        assert h == lcpsort.common_prefix(last, s)
        last = s


def test_sorted_neighbours_over_many_runs_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(lcpsort, "RUN_BYTES", 400)
    rng = np.random.default_rng(8)
    strings = [bytes(rng.integers(97, 99, int(rng.integers(1, 12)), dtype=np.uint8)) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(strings)), "id long, s binary").repartition(5)
    facts = lambda s, h, b, g, n: (h if b is not None else -1, g if n is not None else -1)
    members, kept = lcpsort.neighbours(df, facts, lambda *a: True, "test")
    order, count = sorted(set(strings)), Counter(strings)
    for r in members.collect():
        s = strings[r.id]
        i = order.index(s)
        x = lcpsort.common_prefix(order[i - 1], s) if i else -1
        y = lcpsort.common_prefix(order[i + 1], s) if i + 1 < len(order) else -1
        assert (r.mult, r.x, r.y) == (count[s], x, y)
    assert sorted(bytes(r.s) for r in kept.collect()) == order


def test_pieces_grow_with_the_data(spark, monkeypatch):
    monkeypatch.setattr(lcpsort, "RUN_BYTES", 2000)
    monkeypatch.setattr(lcpsort, "RANGE_BYTES", 2000)
    real, pieces = lcpsort.save, []

    def counted(df, name):
        out = real(df, name)
        if name.endswith("-runs"):
            pieces.append(out.where(f"range <> {lcpsort.MEMBERS}").count())
        return out

    monkeypatch.setattr(lcpsort, "save", counted)
    rng = np.random.default_rng(2)
    for n in (2000, 8000):
        rows = [(i, bytearray(rng.integers(0, 256, 20, dtype=np.uint8).tobytes())) for i in range(n)]
        df = spark.createDataFrame(rows, "id long, s binary").repartition(4)
        lcpsort.neighbours(df, lambda *a: (0, 0), lambda *a: False, "grow")
    # Runs and ranges both grow by four from 40 kB to 160 kB, but ranges stop at those of the session.
    assert pieces[1] < 6 * pieces[0]


def test_runs_of_consecutive_numbers(spark):
    df = spark.createDataFrame([(1, [3, 4, 5, 7, 8, 9]), (2, [1]), (3, [])], "k int, ps array<int>")
    got = {r["k"]: [(x["lo"], x["hi"]) for x in r["r"]] for r in df.select("k", suffixes.runs_of("ps").alias("r")).collect()}
    assert got == {1: [(3, 5), (7, 9)], 2: [(1, 1)], 3: []}


def test_packing_round_trip(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    ids = defaultdict(list)
    for i, x in pairs(docs):
        ids[i].append(np.array(t.encode(x or "", add_special_tokens=False).ids + [0], "<u4"))
    rows = packing.pack(docs).collect()
    space = defaultdict(list)
    got = defaultdict(list)
    for r in rows:
        space[r.sequence_id].append((r.offset, r.length))
        got[r.doc_id].append(r)
    for pieces in space.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    total = sum(len(x) for v in ids.values() for x in v)
    assert sum(r.length for r in rows) == total and len(space) <= total // 1024 + 2
    for i, texts in ids.items():
        assert all(r.doc_tokens == len(texts[0]) for r in got[i])
        for r in got[i]:
            assert zlib.crc32(texts[0][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        assert sorted((r.start, r.length) for r in got[i])[:: len(texts)] == sorted({(r.start, r.length) for r in got[i]}) or len(texts) > 1


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(1, 1023), st.integers(1, 60)), max_size=25))
def test_plan_places_every_tail_once(bins):
    hist = np.zeros(1024, np.int64)
    for n, c in bins:
        hist[n] += c
    plan = packing.pack_plan(hist)
    cover, seqs = defaultdict(list), defaultdict(list)
    for layer, tail, lo, hi, start, length, seq, offset in plan.tolist():
        for r in range(lo, hi):
            cover[tail, r].append((start, length))
            seqs[seq + r - lo].append((offset, length))
    assert {k: n for k, n in Counter(t for t, _ in cover).items()} == {n: int(c) for n, c in enumerate(hist) if c}
    for (tail, _), pieces in cover.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == tail
    for pieces in seqs.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(sum(n for _, n in p) < 1024 for p in seqs.values()) <= 1


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.text(alphabet="ab é\n\t'漢7.  ", max_size=40))
def test_word_by_word_ids_are_the_tokenizers(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    global _T
    if "_T" not in globals():
        _T = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        _T.encode_special_tokens = True
    enc = packing.encoder("byte_bpe_50k")
    assert np.frombuffer(enc(text), enc.dtype).tolist() == _T.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "\n", "a", "Ab é", "漢7", "'s "]), max_size=12).map("".join))
def test_added_tokens_have_the_ids_of_the_plain_call(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if "_P" not in globals() else _P
    globals()["_P"] = plain
    enc = packing.encoder("byte_bpe_50k")
    assert np.frombuffer(enc(text), enc.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_pieces_of_texts_with_added_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    # The last holds a run for the library without depth limit.
    texts = ["a <|endoftext|> b", "<|endoftext|>" * 1500, "x" * 150_000 + "<|endoftext|> y", "no token"]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for i, t in enumerate(texts):
        ids = np.array(plain.encode(t, add_special_tokens=False).ids + [0], "<u4")
        mine = [r for r in rows if r.doc_id == i]
        assert sum(r.length for r in mine) == len(ids) and {r.doc_tokens for r in mine} == {len(ids)}
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in mine)


def test_mix_targets_and_copies(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r.size
    weights = dict(zip(sorted(by, key=lambda s: (s is None, (s or "").encode())), [5, 2, 1] * len(by)))
    size = {s: sum(r.size for r in v) for s, v in by.items()}
    left, open_, target = 1.5 * sum(size.values()), dict(weights), {}
    while open_:
        level = left / sum(open_.values())
        full = [s for s in open_ if level * open_[s] > 2 * size[s]]
        for s in full:
            target[s] = 2.0 * size[s]
            left -= target[s]
            del open_[s]
        if not full:
            target |= {s: level * w for s, w in open_.items()}
            break
    for s, v in by.items():
        assert {r.source_size for r in v} == {size[s]}
        assert all(abs(r.target - target[s]) < 1e-6 * max(1, target[s]) for r in v)
        assert abs(sum(r.taken for r in v) - target[s]) <= 1.01 * max(r.size for r in v)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))
    out = mixing.emit(docs, mixing.mix(docs))
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in rows)


def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(0)
    plain = ["".join(rng.choice(["ta", "re", "mi", "no", "su", "le"], 3)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        w = list(rng.choice(plain, 80))
        toxic = i % 3 == 0
        if toxic:
            for at in rng.choice(80, 6, replace=False):
                w[at] = str(rng.choice(["blorkhead", "wretchling", "foulgrub"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(700, None), (701, ""), (700, None), (None, "ta re")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "'x' as counts")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(docs, model).collect()
    held = [r for r in got if r.doc_id is not None and r.doc_id < 600 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum(r.predicted == (r.doc_id % 3 == 0) for r in held)
    assert len(held) > 80 and right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.counts == "x" for r in got)
    empty = {r.score for r in got if r.doc_id in (700, 701)}
    assert len(empty) == 1 and empty.pop() < 0.5


def test_keys_of_the_same_classes_are_compared_once(spark):
    members = {1: [1, 2], 2: [1, 2], 3: [1, 2, 3], 4: [1, 3], 5: [1, 4, 3], 6: [1, 2, 3], 7: [9], 8: [3, 1]}
    rows = spark.createDataFrame([(k, i) for k, ids in members.items() for i in ids], "key long, id long")
    got = {(r["key"], r["size"]) for r in neardup.unlike_keys(rows).collect()}
    assert got == {(1, 2), (3, 3), (4, 2), (5, 3), (7, 1)}
    assert neardup.unlike_keys(rows.where("key < 0")).collect() == []


def test_rows_found_again_over_batches():
    """Keys that part in their second number, and groups that reach over batches."""
    rng = np.random.default_rng(6)
    rows = pd.DataFrame({"a": np.sort(rng.integers(0, 60, 300)), "b": rng.integers(0, 4, 300), "n": np.arange(300)})
    rows.loc[250:, "a"] = 99
    rows.loc[250:, "b"] = np.arange(50) // 2 % 17
    for size in (1, 3, 40, 300):
        batches = [rows[i : i + size] for i in range(0, 300, size)] + [rows[:0]]
        for keys in (["a"], ["a", "b"]):
            got = pd.concat(suffixes.found_again(iter(batches), *keys))["n"].tolist()
            assert sorted(got) == rows[rows.duplicated(keys, keep=False)]["n"].tolist()
        alone = pd.concat(suffixes.found_again(iter(batches), "a", "b", alone=lambda p: p["n"].to_numpy() % 2 == 0))["n"].tolist()
        assert sorted(alone) == rows[rows.duplicated(["a", "b"], keep=False) | (rows["n"] % 2 == 0)]["n"].tolist()


def test_a_common_seed_is_dealt_to_many_tasks(spark):
    """One passage in every text: its rows must not meet in one task, and unlike rows must."""
    core = "".join(np.random.default_rng(3).choice(list("abcdefgh"), 3000))
    rows = [(i, f"x{i} {core[:460]} y{i}") for i in range(400)] + [(400, core[1000:1600]), (401, "b" + core[1000:1600])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    texts = df.select(F.col("doc_id").alias("d"), suffixes.text_key().alias("k"), F.col("text").cast("binary").alias("text"))
    seeds = suffixes.seed_regions(texts).cache()
    often = seeds.groupBy("seed").count().orderBy(F.desc("count")).first()
    assert often["count"] >= 400
    assert seeds.where(F.col("seed") == often["seed"]).where(f"seen < {suffixes.LATER}").count() <= 4
    want = seeds.join(seeds.groupBy("seed").count().where("count > 1"), "seed", "semi").select("k", "lo", "hi", "at").distinct()
    assert Counter(suffixes.repeated_seeds(seeds).select("k", "lo", "hi", "at").collect()) == Counter(want.collect())
    assert Counter(tuple(r) for r in suffixes.deduplicated(df).collect()) == brute_bytes(rows, 400)


def test_strings_that_a_neighbour_shares_are_not_written_out(spark, monkeypatch):
    """A passage in many places, cut at either end by what differs: one place writes its strings out, not each."""
    real, hashed = suffixes.repeated_parts, []

    def counted(parts):
        hashed.append(parts.count())
        return real(parts)

    monkeypatch.setattr(suffixes, "repeated_parts", counted)
    rng = np.random.default_rng(5)
    core = "".join(rng.choice(list("abcdefgh"), 900))
    for n in (20, 80):
        rows = [(i, "".join(rng.choice(list("ijkl"), 500)) + core + "".join(rng.choice(list("mnop"), 500))) for i in range(n)]
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        assert Counter(tuple(r) for r in suffixes.deduplicated(df).collect()) == brute_bytes(rows, 400)
    assert hashed[1] < 2 * hashed[0] + 1000


def test_rows_of_a_common_string_stay_behind(spark, monkeypatch):
    monkeypatch.setattr(lcpsort, "RUN_BYTES", 3000)
    rng = np.random.default_rng(9)
    strings = [b"common" if i % 3 else bytes(rng.integers(97, 99, 6, dtype=np.uint8)) for i in range(1500)]
    rows = [(i, i % 7, s) for i, s in enumerate(strings)]
    df = spark.createDataFrame(rows, "id long, n int, s binary").repartition(3)
    real, largest = lcpsort.save, []

    def watched(df, name):
        out = real(df, name)
        if name.endswith("-runs"):
            largest.append(out.where(f"range <> {lcpsort.MEMBERS}").selectExpr("max(octet_length(whose))").first()[0])
        return out

    monkeypatch.setattr(lcpsort, "save", watched)
    members, kept = lcpsort.neighbours(df, lambda *a: (0, 0), lambda *a: True, "common")
    count, cls = Counter(strings), {bytes(r.s): r.cls for r in kept.collect()}
    want = Counter((i, n, cls[s], count[s]) for i, n, s in rows)
    assert Counter((r.id, r.n, r.cls, r.mult) for r in members.collect()) == want
    assert largest[0] < 12 * 200

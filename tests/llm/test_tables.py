"""Vectors, pages and the pipeline against brute force and SQL."""

import hashlib
import base64
import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelyze import llm
from panelyze.llm import embeddings, topk, warc
from panelyze.llm.common import scratch, table
from tests.llm.cases import odd_docs

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, id long, links long"


def odd_vectors(spark, extra=()):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(6, 9))
    rows = [(i, list(map(float, base[i % 6] + 0.02 * rng.normal(size=9)))) for i in range(120)]
    rows += [(i, rows[3][1]) for i in range(200, 240)]  # equal vectors
    rows += [
        (300, None), (301, [0.0] * 9), (302, [1.0, None] + [0.0] * 7), (303, [float("nan")] * 9),
        (304, [float("inf")] + [0.0] * 8), (305, [1.0, 2.0]), (306, [1.0, 2.0]), (307, []), (320, [-0.5] * 9),
        (3, rows[3][1]), (1000, [1e150] * 9), (1001, [1e-150] * 9),
    ]
    rows += list(extra)
    return spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], VECTORS)


def finite(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def test_links_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    df = odd_vectors(spark)
    best = {}
    for r in df.collect():
        best.setdefault(r.vec_id, r.embedding)
    unit = {}
    for i, v in best.items():
        if finite(v) and any(v):
            x = np.array(v) / np.abs(v).max()
            unit[i] = x / np.linalg.norm(x)
    linked = {i: {j for j in unit if j != i and len(unit[j]) == len(unit[i]) and unit[i] @ unit[j] >= 0.95} for i in unit}
    want = {}
    for i in best:
        seen, todo = {i}, [i]
        while todo:
            for j in linked.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        want[i] = (len(linked.get(i, ())), min(seen))
    got = embeddings.near_duplicates(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want and len(got) == len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


def test_recall_on_the_table(spark):
    """Visited cells reach the recall promised, against all pairs."""
    rows = table(spark, "/root/testdata/sf0.01", "embeddings").orderBy("vec_id").collect()
    rng = np.random.default_rng(3)
    base = [r.embedding for r in rows]
    near = [np.array(v) + 0.02 * rng.normal(size=len(v)) for v in base for _ in range(3)]
    unit = embeddings.unit_rows([np.array(v) for v in base] + near, len(base[0]))
    index = embeddings.fit(unit[rng.permutation(len(unit))[:1200]], len(unit))
    found, total = embeddings.sample_recall(unit, embeddings.traversal(unit, index["books"], index["visits"]))
    assert total > 100 and found >= 0.9 * total


def test_recall_of_pairs_the_sample_does_not_hold(spark):
    """Vectors without any link to tune on, and their partners at cosine 0.95."""
    rng = np.random.default_rng(12)
    unit = embeddings.unit_rows(list(rng.normal(size=(6000, 64))), 64)
    assert embeddings.sample_recall(unit, np.zeros((6000, 1)))[1] == 0
    index = embeddings.fit(unit[:3000], 100_000)
    aside = rng.normal(size=unit.shape)
    aside -= (aside * unit).sum(1, keepdims=True) * unit
    near = 0.9501 * unit + (1 - 0.9501**2) ** 0.5 * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    both = np.vstack([unit[3000:], near[3000:]])
    found, total = embeddings.sample_recall(both, embeddings.traversal(both, index["books"], index["visits"]))
    assert total == 3000 and found >= 0.99 * total


def test_grid_gets_coarser_until_the_links_are_found(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "VISITS", (4,))
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    rng = np.random.default_rng(13)
    base = embeddings.unit_rows(list(rng.normal(size=(400, 16))), 16)
    aside = rng.normal(size=base.shape)
    aside -= (aside * base).sum(1, keepdims=True) * base
    near = 0.951 * base + (1 - 0.951**2) ** 0.5 * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([base, near]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df).collect()}
    assert len(got) == 800 and sum(n > 0 for n in got.values()) >= 0.985 * 800
    index = embeddings.fit(base, 100_000)
    assert len(index["books"][0]) < 64 and index["visits"] <= 4
    queries = df.where("vec_id < 100").withColumnRenamed("vec_id", "id").toPandas()
    hist = embeddings.query_links(df.withColumnRenamed("vec_id", "id"), queries, index, 0.95)
    unit = np.vstack([base, near])
    assert hist.sum() == (unit[:100] @ unit.T >= 0.95).sum() - 100


def test_traversal_visits_the_nearest_cells():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(40, 8))
    books = rng.normal(size=(7, 4)), rng.normal(size=(5, 4))
    every = embeddings.distances(x[:, :4], books[0])[:, :, None] + embeddings.distances(x[:, 4:], books[1])[:, None, :]
    every = every.reshape(len(x), -1)
    for visits in (1, 6, 35):
        cells = embeddings.traversal(x, books, visits)
        want = np.sort(every, 1)[:, :visits]
        assert np.allclose(np.take_along_axis(every, cells.astype(int), 1), want)


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    df = odd_vectors(spark).where("vec_id < 1000")
    vectors = topk.quantised(df)
    got = topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20).collect()
    ints = {}
    for r in df.collect():
        if finite(r.embedding):
            ints[r.vec_id] = [int(np.floor(64 * x)) for x in r.embedding]
    want = Counter()
    for q, v in ints.items():
        if q % 20 == 0:
            s = sorted((-int(np.dot(v, w)), i) for i, w in ints.items() if i != q and len(w) == len(v))
            want.update((q, n + 1, i, -d) for n, (d, i) in enumerate(s[:20]))
    assert Counter((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).collect() == []


def test_slices_add_up():
    rng = np.random.default_rng(0)
    values = rng.integers(-900, 900, (130, 5))
    slices, base = topk.slice_block(values)
    ids = np.arange(130) * 3
    for q in rng.integers(-70, 70, (12, 5)):
        _, i, s = topk.search_block(q[None], np.array([6]), slices, base, ids, 9)
        want = sorted(((-int(v @ q), j) for v, j in zip(values, ids) if j != 6))[:9]
        assert sorted(zip((-s).tolist(), i.tolist())) == [(a, int(b)) for a, b in want]


def test_revisits(spark):
    rows = [
        (1, "http://a/ b\r\nX: y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://c", None), (4, "http://d", ""),
        (5, "http://e", "WARC/1.1\r\n\r\n\r\nWARC-Type: fake"), (6, "u", "x" * 70000), (2, None, "<p>é</p>"),
        (None, "http://n", "<p>é</p>"), (7, "http://g", "only\r\n\r\nme\n"),
    ]
    df = spark.createDataFrame([r + ("z",) for r in rows], "page_id long, url string, html string, digest string")
    a, b = scratch(spark, "t"), scratch(spark, "t")
    mean = warc.capture(df, a)
    warc.deduplicate(spark, a, b, mean)
    got = warc.read_archive(spark, b, with_payload=True).collect()
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert Counter((r.page_id, r.payload_digest, r.payload_bytes) for r in got) == Counter(
        (p, sha(h), len((h or "").encode())) for p, _, h in rows
    )
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in got)
    assert kinds[2, "response", None] == 1 and kinds[2, "revisit", 2] == 1
    assert kinds[1, "revisit", 2] == 1 and kinds[None, "revisit", 2] == 1 and kinds[3, "revisit", 4] == 1
    by = {(r.page_id, r.record_type): r for r in got}
    assert by[5, "response"].payload == rows[4][2] and by[7, "response"].payload == rows[8][2] and by[1, "revisit"].payload == ""
    assert by[1, "revisit"].url == "http://a/%20b%0D%0AX:%20y"
    assert len({r.record_id for r in got}) == len(rows)
    small = scratch(spark, "t")
    warc.deduplicate(spark, a, small, mean, min_payload=10)
    assert {r.record_type for r in warc.read_archive(spark, small).collect() if r.payload_bytes < 10} == {"response"}
    none, out = scratch(spark, "t"), scratch(spark, "t")
    warc.deduplicate(spark, none, out, warc.capture(df.limit(0), none))
    assert warc.read_archive(spark, out).collect() == []


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = llm.QUERIES[name](spark, SF)
    rel = con.execute(llm.ORACLE_SQL[name])
    at = [[d[0] for d in rel.description].index(c) for c in df.columns]
    want = Counter(tuple(r[i] for i in at) for r in rel.fetchall())
    assert Counter(tuple(r) for r in df.collect()) == want


def test_pipeline_stages(spark):
    """Each stage does what its operator says to all that the one before kept."""
    docs = table(spark, SF, "documents")
    cols, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stage(spark, docs, SF).cache()
        if name == "packing":
            assert docs.count() > 0
            break
        assert docs.columns == cols
        if name == "personal_data":
            assert docs.count() == before
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now and now <= ids
        ids = now


def test_pipeline_takes_odd_rows(spark):
    docs = odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        docs.count()
        if name == "near_duplicates":
            ids = [r.doc_id for r in docs.collect()]
            assert 5 not in ids and 7 not in ids and ids.count(10) == 1 and None in ids


def test_pipeline_keeps_columns_that_clash(spark):
    names = ["score", "Predicted", "kept_id", "digest", "nth", "times", "copy", "text__", "nth__", "copies__"]
    docs = odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.select("*", *[F.concat(F.lit(n + " of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        for r in docs.collect():
            assert all(r[n] == f"{n} of {'none' if r['doc_id'] is None else r['doc_id']}" for n in names), name


def test_scratch_is_where_the_session_says(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert root is None or scratch(spark, "x").startswith(root.rstrip("/"))
    assert os.path.basename(scratch(spark, "x")) != os.path.basename(scratch(spark, "x"))

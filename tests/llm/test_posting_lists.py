import math

import numpy as np
from sightline.llm import posting_lists, queries

FOLDER = "/root/testdata/sf0.01"


def exactly(vectors, top=20, every=20):
    """query -> its (score, id) in order, by comparing all pairs."""
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids], np.float64)
    found = {}
    for k, i in enumerate(ids):
        if i % every == 0:
            scores = (x * x[k]).sum(1)
            found[i] = sorted((-s, j) for j, s in zip(ids, scores) if j != i)[:top]
    return found


def answers(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    got = {q: sorted(rows) for q, rows in got.items()}
    assert all([r for r, _, _ in rows] == list(range(1, len(rows) + 1)) for rows in got.values())
    return {q: [(-s, v) for _, v, s in rows] for q, rows in got.items()}


def recall(got, want):
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    return sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want) / sum(map(len, want.values()))


def test_whole_table_recall_and_scores(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    vectors = {r.vec_id: r.embedding for r in rows}
    got, want = answers(queries.QUERIES["op12_nearest"](spark, FOLDER)), exactly(vectors)
    assert recall(got, want) >= 0.95
    for q, found in got.items():
        for less, v in found:
            assert math.isclose(-less, math.fsum(a * b for a, b in zip(vectors[q], vectors[v])), rel_tol=1e-12, abs_tol=1e-14)
        assert found == sorted(found)


def test_many_lists_shelves_chunks_and_blocks(spark, monkeypatch):
    for name, value in (("LIST", 16), ("SHELF_BYTES", 16 * 4 * 60), ("BLOCK", 20), ("SAMPLE_BYTES", 16 * 4 * 1500)):
        monkeypatch.setattr(posting_lists, name, value)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    points = (centres[rng.integers(0, 30, 2000)] + 0.4 * rng.normal(size=(2000, 16))) * rng.uniform(0.5, 2, (2000, 1))
    vectors = dict(enumerate(points.astype(np.float32).tolist()))
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>").repartition(5)
    got = answers(posting_lists.nearest(df))
    assert recall(got, exactly(vectors)) >= 0.9


def test_graph_search_finds_the_lists_within_the_ratio():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(4000, 12)).astype(np.float32)
    index = posting_lists.Index(points, 150)
    p, c, d = index.around(points[:300], 1.15)
    far = np.sqrt(index.distances(points[:300]))
    want = {(i, j) for i, j in zip(*np.nonzero(far <= 1.15 * far.min(1)[:, None]))}
    assert len(want & set(zip(p.tolist(), c.tolist()))) >= 0.95 * len(want)
    sizes = np.bincount(np.argmin(index.distances(points), 1), minlength=len(index.centres))
    assert sizes.max() <= 4 * sizes.mean()


def test_copies_ties_nulls_and_odd_vectors(spark):
    from pyspark.sql import functions as F
    one = [[1.0, 0.0, 0.0]] * 500 + [[0.0, 1.0, 0.0]] * 30 + [[0.0, 0.0, 2.0]]
    vectors = dict(enumerate(one))
    odd = [(1000, None), (1020, [0.0, 0.0, 0.0]), (1040, [1.0, None, 0.0]), (1060, [math.nan, 1.0, 0.0]), (1080, [math.inf, 1.0, 0.0]), (1100, [1.0, 0.0]), (None, [1.0, 1.0, 1.0]), (1120, [])]
    df = spark.createDataFrame([*vectors.items(), *odd, (3, [1.0, 0.0, 0.0]), (20, [0.5, 0.0, 0.0])], "vec_id long, embedding array<double>").select(
        "*", *(F.lit("x").alias(c) for c in ("id", "v", "lists", "shelf", "query", "rank", "score", "ids")))
    assert answers(posting_lists.nearest(df.repartition(6))) == exactly(vectors)
    assert answers(posting_lists.nearest(df, top=600)) == exactly(vectors, top=600)


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    few = {0: [1.0, 2.0], 7: [3.0, -1.0], 20: [0.5, 0.5]}
    assert answers(posting_lists.nearest(spark.createDataFrame(list(few.items()), schema))) == exactly(few)
    assert posting_lists.nearest(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    assert posting_lists.nearest(spark.createDataFrame([], schema)).count() == 0
    assert posting_lists.nearest(spark.createDataFrame([(0, [0.0]), (1, None)], schema)).count() == 0

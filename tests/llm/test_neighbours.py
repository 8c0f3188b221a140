import math

import numpy as np

from rarelens.llm import neighbours
from rarelens.llm.catalog import QUERIES


def exact(rows, k, every):
    usable = [(i, np.asarray(v, float)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in usable:
        if q % every == 0:
            near = sorted((-(v @ w) / math.sqrt(v @ v) / math.sqrt(w @ w), i) for i, w in usable if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def test_recall_and_scores(spark, small):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    want, got = exact(rows, 5, 50), found(QUERIES["op5_nearest_neighbours"](spark, small))
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q, near in got.items():
        true = dict(exact(rows, len(rows), 50)[q]) if q == min(got) else dict(want[q])
        assert all(abs(s - true[i]) < 1e-12 for i, s in near if i in true)


def test_all_lists_probed_equals_brute_force_with_copies_and_ties(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(0, 40)] + [(i, rng.standard_normal(4).tolist()) for i in range(40, 200)]
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [math.nan, 1.0, 0.0, 0.0]), (204, [math.inf, 1.0, 0.0, 0.0]), (None, [1.0] * 4), rows[3], (210, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, id string")
    got = found(neighbours.search(df, 10, probe=1.0, block=16, eps=50.0))
    want = exact([r for n, r in enumerate(rows) if n != len(rows) - 2], 5, 10)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_few_candidates_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (3, [1.0, 1.0])], schema)
    assert [i for i, _ in found(neighbours.search(two, 50))[0]] == [3, 1]
    assert neighbours.search(spark.createDataFrame([(0, [1.0])], schema), 50).count() == 0
    assert neighbours.search(spark.createDataFrame([], schema), 50).count() == 0


def test_scan_keeps_the_nearest():
    rng = np.random.default_rng(6)
    data = rng.standard_normal((3000, 64))
    hit = 0
    for q in rng.standard_normal((20, 64)):
        kept, added = neighbours.scan(data, q, 6, 16, 2.1)
        assert added < data.size
        hit += len(set(np.argsort(((data - q) ** 2).sum(1))[:6]) & set(kept.tolist()))
    assert hit >= 0.97 * 120


def test_a_bound_from_before_abandons_far_candidates_and_keeps_near_ones():
    rng = np.random.default_rng(8)
    data = rng.standard_normal((2000, 64))
    query = data[7] + 0.1 * rng.standard_normal(64)
    kept, added = neighbours.scan(data, query, 6, 8, 2.1, bound=2.0)
    assert kept.tolist() == [7] and added < 0.3 * data.size
    assert neighbours.scan(data, query, 6, 8, 2.1, bound=0.0)[0].tolist() == []


def test_candidates_are_abandoned_and_few_are_met_where_vectors_cluster(spark):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((40, 32))
    rows = [(i, (centres[i % 40] + 0.2 * rng.standard_normal(32)).tolist()) for i in range(4000)]
    out = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 50, probe=0.1, first=0.03)
    got, want = found(out), exact(rows, 5, 50)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    per_query = out.dropDuplicates(["query_id"]).selectExpr("avg(met) AS met", "avg(added) AS added").first()
    assert per_query["met"] < 0.2 * len(rows) and per_query["added"] < 0.9


def test_abandonment_on_the_given_vectors(spark, small):
    work = QUERIES["op5_nearest_neighbours"](spark, small.replace("sf0.001", "sf0.01")).selectExpr("avg(added) AS added", "min(met) AS met").first()
    assert work["added"] < 0.97 and work["met"] > 0

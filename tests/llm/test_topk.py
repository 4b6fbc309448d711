import numpy as np
import pytest

from tidemark.llm.topk import threshold_search, top_k

SCHEMA = "vec_id long, embedding array<float>, extra string"


def brute(rows, asked, k):
    out = []
    for q, qv in asked:
        scores = [
            (-int(sum(np.floor(256 * np.float64(np.float32(a))) * np.floor(256 * np.float64(np.float32(b))) for a, b in zip(qv, v))), i)
            for i, v in rows if i != q and len(v) == len(qv)
        ]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_matches_brute_force_with_ties_and_clusters(spark):
    rng = np.random.default_rng(3)
    vectors = np.round(rng.normal(size=(300, 6)) * 4) / 8
    vectors[:40] += 3  # a cluster that lets the search stop early
    vectors[250:] = vectors[0]  # ties
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    asked = [r for r in rows if r[0] % 20 == 0]
    assert found(top_k(df, df.where("vec_id % 20 = 0"), k=5)) == brute(rows, asked, 5)


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], ""), (2, None, ""), (3, [1.0, None], ""), (4, [nan, 1.0], ""), (5, [inf, 1.0], ""),
            (6, [], ""), (7, [0.5, 0.5], ""), (8, [1.0], ""), (None, [1.0, 1.0], "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(top_k(df, df, k=3)) == [(1, 1, 7, 128 * 256 + 128 * 512), (7, 1, 1, 128 * 256 + 128 * 512)]
    assert top_k(df.limit(0), df.limit(0)).count() == 0


def test_search_stops_before_the_end_of_the_lists():
    vectors = np.zeros((4000, 3), np.int64)
    vectors[:, 0] = np.arange(4000)
    best = threshold_search(np.array([[1, 0, 0]]), np.array([-1]), vectors, np.arange(4000), 5)
    assert [(c, s) for _, c, s in best] == [(k, k) for k in range(3999, 3994, -1)]


@pytest.mark.parametrize("scale", [1, 2**30])
def test_large_components_stay_exact(scale):
    vectors = np.array([[3, 4], [4, 3], [5, 1]], np.int64) * scale
    best = threshold_search(np.array([[1, 1]], np.int64), np.array([-1]), vectors, np.arange(3), 2)
    assert [(c, s) for _, c, s in best] == [(0, 7 * scale), (1, 7 * scale)]

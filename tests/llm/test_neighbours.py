import numpy as np
from pyspark.sql import functions as F

from ladle.llm import neighbours


def brute(rows, asking, count):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v) and len(v) == 16]
    out = {}
    for q, a in ok:
        if asking(q):
            found = sorted((-round(float((a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())), 12), i) for i, b in ok if i != q)
            out[q] = [(i, -s) for s, i in found[:count]]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, part int, id string").repartition(3)


def results(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, round(r.score, 12)))
    return out


def test_odd_vectors_ties_and_few_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.standard_normal(16).astype(np.float32).tolist()) for i in range(12)]
    rows += [(20 + i, rows[0][1]) for i in range(9)] + [(40, None), (41, [0.0] * 16), (42, [None] + [1.0] * 15), (43, [float("nan")] * 16),
                                                      (44, [float("inf")] + [1.0] * 15), (45, []), (46, [1.0, 2.0]), (None, rows[3][1])]
    df = frame(spark, rows)
    router = neighbours.fit(df)
    for count in (1, 5, 40):
        got = results(neighbours.search(df, df.where("vec_id % 2 = 0"), router, count=count))
        assert got == brute(rows, lambda i: i % 2 == 0, count)
    assert neighbours.fit(df.where("vec_id = 40")) is None
    assert neighbours.search(df, df, None).collect() == []
    assert neighbours.search(df.where("vec_id = -1"), df, router).collect() == []


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 16)) * 2
    rows = [(i, (centres[i % 20] + rng.standard_normal(16)).astype(np.float32).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[7][1]) for i in range(700)]  # one vector of a third of all rows
    df = frame(spark, rows)
    router = neighbours.fit(df, sample=800, parts=8)
    got = results(neighbours.search(df, df.where("vec_id % 50 = 0"), router, probes=4, block=256))
    expected = brute(rows, lambda i: i % 50 == 0, 5)
    assert got.keys() == expected.keys() and all(len(v) == 5 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / 5 for q in got]) >= 0.9
    every = dict(rows)
    for q, found in got.items():
        a = np.array(every[q], float)
        for i, s in found:
            b = np.array(every[i], float)
            assert abs(s - (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())) < 1e-9
    # With every part probed the search is exact.
    whole = results(neighbours.search(df, df.where(F.col("vec_id") % 50 == 0), router, probes=8, block=256))
    assert whole == expected


def test_cut_graph_is_balanced():
    near = np.array([[(i + k) % 64 for k in (1, 2, 3)] for i in range(64)])
    assert np.bincount(neighbours.cut_graph(near, 8)).tolist() == [8] * 8

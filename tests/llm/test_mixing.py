import random

import numpy as np
from pyspark.sql import functions as F

from ladle.llm import mixing

TARGETS = {"good": 0.7, "poor": 0.2, "toxic": 0.1}
WORDS = {"good": "stone river walks slowly home again quiet evening light", "poor": "click buy free now offer deal cheap best price",
         "toxic": "scum loser idiot pathetic stupid worthless trash moron vile"}


def corpus(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        kind = rng.choices(list(WORDS), (1, 3, 2))[0]
        own = WORDS[kind].split() if i % 9 else WORDS["good"].split() + WORDS["toxic"].split()
        rows.append((i, " ".join(rng.choices(own, k=rng.randint(5, 60))), kind))
    labels = spark.createDataFrame([(i, kind) for i, _, kind in rows if i % 2] + [(None, "good"), (7, None), (9999, "poor"), (11, "other")], "doc_id long, domain string")
    return spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), labels, {i: kind for i, _, kind in rows}


def test_totals_match_and_domains_are_told_apart(spark, work):
    docs, labels, kinds = corpus(spark)
    rows = mixing.rates(docs, labels, TARGETS, work()).collect()
    n, r, p = (np.array([getattr(x, c) for x in rows]) for c in ("n_tokens", "rate", "posterior"))
    assert (r >= 0).all() and np.allclose(p.sum(1), 1)
    assert np.allclose((n * r) @ p / n.sum(), [TARGETS[d] for d in sorted(TARGETS)], atol=1e-6)
    held = [(sorted(TARGETS)[int(np.argmax(x.posterior))], kinds[x.doc_id]) for x in rows if not x.doc_id % 2 and x.doc_id % 9]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert all(x.n_tokens == len(d.text.split()) for x, d in zip(sorted(rows, key=lambda x: x.doc_id), docs.orderBy("doc_id").collect()))


def test_rates_stay_nonnegative_where_targets_clash(spark, work):
    """Against plain projected gradient on the same numbers."""
    rng = np.random.default_rng(2)
    p = rng.dirichlet((0.3, 0.3, 0.3), 200)
    n = rng.integers(1, 50, 200)
    table = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_tokens long, posterior array<double>")
    targets = [float(n.sum()) * 0.999, 0.0, float(n.sum()) * 0.001]
    rates = np.array([x.rate for x in mixing.fit_rates(table.withColumn("at", F.monotonically_increasing_id()), targets, work()).orderBy("at").collect()])
    assert rates.min() == 0 and (rates >= 0).all()
    gap = lambda r: (r * n) @ p - targets
    metric = np.linalg.pinv((p * n[:, None]).T @ p)
    plain = np.ones(200)
    for _ in range(mixing.MOST_STEPS):
        plain = np.clip(plain - p @ (metric @ gap(plain)), 0, mixing.MOST_RATE)
    assert abs(gap(rates) @ metric @ gap(rates) - gap(plain) @ metric @ gap(plain)) < 1e-6 * n.sum()


def test_copies_and_odd_documents(spark, docs, empty, work):
    labelled, labels, _ = corpus(spark)
    for frame in (docs, empty):
        for known in (labels, labels.where("doc_id = -1")):
            rows = mixing.rates(frame, known, TARGETS, work()).collect()
            assert len(rows) == frame.count() and all(r.rate >= 0 and abs(sum(r.posterior) - 1) < 1e-9 for r in rows)
    rated = {r.doc_id: r.copies for r in mixing.rates(labelled, labels, TARGETS, work()).select("doc_id", mixing.copies(F.col("rate"), F.col("doc_id")).alias("copies")).collect()}
    out = mixing.mixed(labelled, labels, TARGETS, work())
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {k: v for k, v in rated.items() if v}
    assert mixing.mixed(docs, labels, TARGETS, work()).columns == docs.columns
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def converged(n, p, targets):
    """The least gap that rates can reach, by accelerated projected gradient until the step is nothing."""
    metric = np.linalg.pinv((p * n[:, None]).T @ p)
    rate = ahead = np.ones(len(n))
    momentum = 1.0
    for _ in range(200_000):
        after = np.maximum(0, ahead - p @ (metric @ ((ahead * n) @ p - targets)))
        if (n * (ahead - after)) @ (after - rate) > 0:  # it overshot
            momentum = 1.0
        faster = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        rate, ahead, momentum = after, after + (momentum - 1) / faster * (after - rate), faster
        if np.abs(rate - np.maximum(0, rate - p @ (metric @ ((rate * n) @ p - targets)))).max() < 1e-9:
            break
    return (rate * n) @ p - targets


def test_rates_converge_where_many_fall_to_nothing(spark, work):
    """Targets that can be met, but not in 40 plain steps; and some that can't be."""
    rng = np.random.default_rng(5)
    met = []
    for alpha, wanted in (((0.3, 0.6, 0.6), (0.96, 0.02, 0.02)), ((0.2, 2, 2), (0.96, 0.02, 0.02))):
        p = rng.dirichlet(alpha, 600)
        n = rng.integers(1, 500, 600)
        targets = [float(n.sum() * x) for x in wanted]
        table = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_tokens long, posterior array<double>").coalesce(1)
        folder = work()
        fitted, gap = mixing.settle_rates(mixing.fit_rates(table, targets, folder, 1e6), targets, folder, 1e6)
        rows = fitted.collect()
        assert min(x.rate for x in rows) == 0
        totals = np.array([x.rate * x.n_tokens for x in rows]) @ np.array([x.posterior for x in rows])
        assert np.allclose(totals - targets, gap, atol=1e-6 * n.sum())
        assert np.allclose(gap, converged(n, p, np.array(targets)), atol=1e-5 * n.sum())
        met.append(bool(np.abs(gap).max() < 1e-6 * n.sum()))
    assert met == [True, False]


def test_no_rate_exceeds_its_bound(spark, work):
    """Three good documents among many poor ones can't make up most of the tokens; what is short is reported."""
    rows = [(i, "stone river walks slowly home again quiet evening" if i < 3 else "click buy free now offer deal cheap best price") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "good" if i < 3 else "poor") for i in range(40)], "doc_id long, domain string")
    for most in (mixing.MOST_RATE, 3.0):
        folder = work()
        found = {r.doc_id: r.rate for r in mixing.rates(docs, labels, {"good": 0.9, "poor": 0.1}, folder, most=most).collect()}
        assert max(found.values()) == most and all(abs(found[i] - most) < 1e-9 for i in range(3)) and min(found.values()) >= 0
        gap = {r.domain: (r.target, r.gap) for r in spark.read.parquet(f"{folder}/gap").collect()}
        assert gap["good"][1] < -0.5 * gap["good"][0]
    out = mixing.mixed(docs, labels, {"good": 0.9, "poor": 0.1}, work(), most=3.0)
    assert {r.doc_id: r["count"] for r in out.where("doc_id < 3").groupBy("doc_id").count().collect()} == {0: 3, 1: 3, 2: 3}


def test_bounded_rates_against_a_plain_solver(spark, work):
    """Targets that some documents' bounds stand in the way of: the same least gap as projected gradient run to the end."""
    rng = np.random.default_rng(5)
    p, n = rng.dirichlet((0.4, 0.4, 0.4), 150), rng.integers(1, 40, 150)
    targets = np.array([0.8, 0.15, 0.05]) * n.sum()
    table = spark.createDataFrame([(i, int(a), b.tolist()) for i, (a, b) in enumerate(zip(n, p))], "at long, n_tokens long, posterior array<double>")
    metric = np.linalg.pinv((p * n[:, None]).T @ p)
    for most in (1.2, 2.0, 8.0):
        folder = work()
        fitted, gap = mixing.settle_rates(mixing.fit_rates(table, targets.tolist(), folder, most), targets.tolist(), folder, most)
        rate = np.array([r.rate for r in fitted.orderBy("at").collect()])
        plain = np.ones(150)
        for _ in range(30_000):
            plain = np.clip(plain - p @ (metric @ ((plain * n) @ p - targets)), 0, most)
        least = (plain * n) @ p - targets
        assert rate.min() >= 0 and rate.max() <= most and np.allclose((rate * n) @ p - targets, gap, atol=1e-6 * n.sum())
        assert gap @ metric @ gap <= least @ metric @ least + 1e-6 * n.sum()

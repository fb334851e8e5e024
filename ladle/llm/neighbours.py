"""Approximate nearest neighbours by learned partitions.

On a bounded sample (``SAMPLE`` vectors, in the order of a hash of their id) the graph
of nearest neighbours is cut into parts of equal size by spectral bisection, and a
small softmax classifier learns which parts a vector's neighbours lie in. Every vector
is then indexed under its ``SPILL`` most probable parts, and every query looks through
the most probable ones (more, while those hold too few vectors), comparing the
original vectors exactly. How many it looks through is measured: the fewest by which ``HELD_OUT``
further vectors find ``RECALL`` of their nearest ones in the sample. Where vectors lie in
clusters that is a few parts; where their directions are independent, it is most.

A part is split into blocks of about ``BLOCK`` vectors by a hash of the id, so neither
a large part nor a vector that many rows share ends in one task; of rows with equal
vectors a block compares one and keeps the ids that can matter.

Edge cases: vectors that are null, zero, hold null or non-finite components, or have
another length than most of the sample take no part, nor do rows with a null id; of
rows that share an id one asks, and none of them is its own candidate; equal scores go
by id; with fewer candidates than asked for all are given; an empty table gives an
empty result; other columns are dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE, HELD_OUT = 4096, 512
DEGREE = 12
PARTS = 128
#: Parts that a vector is indexed under.
SPILL = 1
#: The share of nearest vectors that held-out ones have to find in the sample.
RECALL = 0.95
NEIGHBOURS = 5
BLOCK = 16_384
STEPS = 200


@dataclass(frozen=True)
class Router:
    """A softmax classifier from unit vectors to parts, and how many parts a query should look through."""

    size: int
    weights: np.ndarray
    bias: np.ndarray
    probes: int = 1

    def scores(self, unit: np.ndarray) -> np.ndarray:
        return unit @ self.weights + self.bias


def valid(vector: Column) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, number) & F.exists(vector, lambda x: x != 0)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that their largest components are about 1 and no square over- or underflows."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, initial=0))[1][:, None])


def matrix(vectors: pa.Array, size: int) -> np.ndarray:
    return scaled(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size))


def unit_rows(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def cut_graph(near: np.ndarray, parts: int) -> np.ndarray:
    """Parts of equal size of the graph that links each row to those in ``near``, by halving along its slowest mode."""
    n = len(near)
    label = np.zeros(n, np.int64)
    rng = np.random.default_rng(0)
    a = np.repeat(np.arange(n), near.shape[1])
    b = near.ravel()
    a, b = np.concatenate((a, b)), np.concatenate((b, a))
    for _ in range(max(0, parts - 1).bit_length()):
        new = label.copy()
        for part in np.unique(label):
            own = np.flatnonzero(label == part)
            index = np.full(n, -1)
            index[own] = np.arange(len(own))
            inside = (index[a] >= 0) & (index[b] >= 0)
            i, j = index[a[inside]], index[b[inside]]
            degree = np.bincount(i, minlength=len(own)) + 1.0
            x = rng.standard_normal(len(own))
            for _ in range(60):
                x = 0.5 * x + 0.5 * (np.bincount(i, x[j], len(own)) + x) / degree
                x -= (x * degree).sum() / degree.sum()
                x /= np.linalg.norm(x) or 1.0
            order = np.argsort(x, kind="stable")
            new[own[order[len(own) // 2:]]] += n  # a fresh label for the upper half
        label = np.unique(new, return_inverse=True)[1]
    return label


def fit_router(rows: np.ndarray, parts: int) -> Router:
    n, size = rows.shape
    unit = unit_rows(rows)
    if n <= 2 * parts:
        return Router(size, np.zeros((size, 1)), np.zeros(1))
    alike = unit @ unit.T
    np.fill_diagonal(alike, -2)
    near = np.argpartition(-alike, min(DEGREE, n - 1) - 1, axis=1)[:, :DEGREE]
    label = cut_graph(near, parts)
    count = int(label.max()) + 1
    target = np.zeros((n, count))
    np.add.at(target, (np.repeat(np.arange(n), near.shape[1]), label[near].ravel()), 1.0)
    target[np.arange(n), label] += 1
    target /= target.sum(1, keepdims=True)
    weights, bias = np.zeros((size, count)), np.zeros(count)
    moment = [np.zeros_like(weights), np.zeros_like(bias), np.zeros_like(weights), np.zeros_like(bias)]
    for step in range(1, STEPS + 1):
        scores = unit @ weights + bias
        scores = np.exp(scores - scores.max(1, keepdims=True))
        gap = (scores / scores.sum(1, keepdims=True) - target) / n
        for k, (value, gradient) in enumerate(((weights, unit.T @ gap + 1e-6 * weights), (bias, gap.sum(0)))):
            moment[k] = 0.9 * moment[k] + 0.1 * gradient
            moment[k + 2] = 0.999 * moment[k + 2] + 0.001 * gradient ** 2
            value -= 0.3 * (moment[k] / (1 - 0.9 ** step)) / (np.sqrt(moment[k + 2] / (1 - 0.999 ** step)) + 1e-12)
    return Router(size, weights, bias)


def _usable(vectors: DataFrame, vector: str, key: str) -> DataFrame:
    kind = "array<double>" if vectors.schema[vector].dataType.elementType == T.DoubleType() else "array<float>"
    return vectors.select(vectors[key].cast("long").alias("id"), vectors[vector].cast(kind).alias("vector")).where(F.col("id").isNotNull() & valid(F.col("vector")))


def fit(vectors: DataFrame, *, vector: str = "embedding", key: str = "vec_id", parts: int = PARTS, sample: int = SAMPLE, held_out: int = HELD_OUT,
        recall: float = RECALL) -> Router | None:
    """The router, from at most ``sample`` vectors, and its probes, from ``held_out`` more; None for a table without usable ones."""
    rows = [r.vector for r in _usable(vectors, vector, key).orderBy(F.xxhash64("id"), "id").limit(sample + held_out).collect()]
    if not rows:
        return None
    size = Counter(map(len, rows)).most_common(1)[0][0]
    found = scaled(np.array([r for r in rows if len(r) == size], np.float64))
    router = fit_router(found[:sample], parts)
    return replace(router, probes=measured_probes(router, found[:sample], found[sample:], recall))


def measured_probes(router: Router, rows: np.ndarray, asks: np.ndarray, recall: float, count: int = NEIGHBOURS, spill: int = SPILL) -> int:
    """The fewest parts by which ``asks`` find ``recall`` of their ``count`` nearest ``rows``; all parts without enough of either."""
    parts = len(router.bias)
    if len(rows) <= count or not len(asks):
        return parts
    asks, rows = unit_rows(asks), unit_rows(rows)
    under = np.argsort(-router.scores(rows), axis=1, kind="stable")[:, :spill]
    rank = np.argsort(np.argsort(-router.scores(asks), axis=1, kind="stable"), axis=1, kind="stable")
    near = np.argpartition(-(asks @ rows.T), count - 1, axis=1)[:, :count]
    # The first look that meets each of the nearest.
    first = np.sort(np.array([rank[i, under[own]].min(1) for i, own in enumerate(near)]).ravel())
    return int(first[min(len(first), max(1, int(np.ceil(recall * len(first))))) - 1]) + 1


def _nearest(asking: np.ndarray, ask: np.ndarray, ids: np.ndarray, rows: np.ndarray, count: int) -> list[tuple[int, int, float]]:
    """Of each query (id, row) the ``count`` nearest rows: (query, id, score)."""
    # Rows with equal vectors: one is compared, and the least ids that can be asked for are kept.
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], np.ascontiguousarray(rows[order])
    _, first, group = np.unique(rows.view(np.dtype((np.void, rows.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
    by_group = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[by_group], np.arange(len(first) + 1))
    distinct = rows[first]
    norms, ask_norms = (np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (distinct, ask))
    out = []
    for a in range(0, len(ask), 256):
        some = ask[a:a + 256]
        rough = (some @ distinct.T) / ask_norms[a:a + 256, None] / norms
        for i in range(len(some)):
            least = np.partition(rough[i], -count - 1)[-count - 1] - 1e-9 if len(distinct) > count + 1 else -np.inf
            close = np.flatnonzero(rough[i] >= least)
            score = np.einsum("ij,j->i", distinct[close], some[i]) / (norms[close] * ask_norms[a + i])
            own = int(asking[a + i])
            found = []
            for s, g in zip(score.tolist(), close.tolist()):
                same = ids[by_group[starts[g]:min(starts[g + 1], starts[g] + count + 1)]].tolist()
                if own in same:
                    same = [x for x in ids[by_group[starts[g]:starts[g + 1]]].tolist() if x != own]
                found += [(-s, x) for x in same[:count]]
            out += [(own, x, -s) for s, x in sorted(found)[:count]]
    return out


def search(vectors: DataFrame, queries: DataFrame, router: Router | None, *, vector: str = "embedding", key: str = "vec_id", count: int = NEIGHBOURS,
           probes: int | None = None, spill: int = SPILL, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``count`` nearest rows of ``vectors`` to each row of ``queries``, by cosine.

    A query looks through ``probes`` parts: as many as the router was measured to need, unless told.
    """
    spark = vectors.sparkSession
    result = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", T.LongType()),
                           T.StructField("score", T.DoubleType())])
    if router is None:
        return spark.createDataFrame([], result)
    probes = probes or router.probes
    rows = _usable(vectors, vector, key).where(F.size("vector") == router.size)
    asks = _usable(queries, vector, key).where(F.size("vector") == router.size).dropDuplicates(["id"])
    indexed_type = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("id", T.LongType()), rows.schema["vector"]])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            scores = router.scores(unit_rows(matrix(some.column(1), router.size)))
            for part in np.argsort(-scores, axis=1, kind="stable")[:, :spill].T.astype(np.int32):
                yield pa.RecordBatch.from_arrays([pa.array(part), some.column(0), some.column(1)], names=["part", "id", "vector"])

    indexed = rows.mapInArrow(index, indexed_type)
    # A number per part.
    sizes = {r.part: r.n for r in indexed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = {part: -(-n // block) for part, n in sizes.items()}
    parts = len(router.bias)
    held = np.array([sizes.get(i, 0) for i in range(parts)])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            order = np.argsort(-router.scores(unit_rows(matrix(some.column(1), router.size))), axis=1, kind="stable")
            before = np.cumsum(held[order], axis=1) - held[order]
            wanted = (np.arange(parts) < probes) | (before <= spill * count)
            row, column = np.nonzero(wanted & (held[order] > 0))
            yield pa.RecordBatch.from_arrays([pa.array(order[row, column].astype(np.int32)), some.column(0).take(pa.array(row)), some.column(1).take(pa.array(row))],
                                             names=["part", "id", "vector"])

    # The number of blocks of each part, as a literal of ``parts`` entries.
    split = F.get(F.array(*[F.lit(blocks.get(i, 1)) for i in range(parts)]), F.col("part"))
    placed = indexed.withColumn("block", F.pmod(F.xxhash64("id"), split).cast("int")).withColumn("asks", F.lit(False))
    asked = asks.mapInArrow(route, indexed_type).withColumn("block", F.explode(F.sequence(F.lit(0), split - 1))).withColumn("asks", F.lit(True))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held_rows = None, {True: [], False: []}

        def nearest() -> Iterator[pa.RecordBatch]:
            if held_rows[True] and held_rows[False]:
                (asking, ask), (ids, own) = ([np.concatenate(x) for x in zip(*held_rows[side])] for side in (True, False))
                found = _nearest(asking, ask, ids, own, count)
                if found:
                    columns = [pa.array(x, t) for x, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

        for some in batches:
            part, at, asking = (some.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero((part[1:] != part[:-1]) | (at[1:] != at[:-1]) | (asking[1:] != asking[:-1])) + 1
            for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(part)]):
                if first == end:
                    continue
                place = int(part[first]), int(at[first])
                if place != current:
                    yield from nearest()
                    current, held_rows = place, {True: [], False: []}
                own = some.slice(first, end - first)
                held_rows[bool(asking[first])].append((own.column(3).to_numpy(), matrix(own.column(4), router.size)))
        yield from nearest()

    both = placed.unionByName(asked).select("part", "block", "asks", "id", "vector")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(sum(blocks.values()), 10_000))
    found = both.repartition(tasks, "part", "block").sortWithinPartitions("part", "block", "asks", "id").mapInArrow(
        compare, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # met in several parts
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")

"""Near-duplicate documents by ProbMinHash over weighted word shingles.

Similarity is the probability Jaccard index of the shingles' counts: it doesn't
change when a text repeats as a whole, and equals the Jaccard index where every
shingle occurs once. Two texts are linked from ``SIMILARITY`` on, and classes are
the connected components of the links.

1. Each shingle of weight w sends arrivals of a Poisson process of rate w to random
   registers. A register keeps the shingle that came first. A shingle stops once its
   next arrival is later than the document's last register; so most send one or two.
   Two documents agree in a register with the probability of their similarity.
2. Rows with equal texts are one node, the least key. The registers of a node form
   bands; nodes that agree in a band share a bucket.
3. In each bucket every member is compared with the least one only: by the share of
   equal registers first, then exactly on the shingles. This links most copies.
4. Buckets whose members still lie in several classes are searched for the rest, in
   blocks: the members outside the bucket's largest class against those of other
   classes, by registers and, where those agree, exactly. For that the shingles of
   these nodes lie in sorted arrays in the shared folder, which the workers map. Two
   nodes are compared in the first bucket they share, a node that has met a class is
   not compared with the class again, and only links are handed on. Pairs within a
   class are never looked at, so a large group of copies costs its size, not its square.

Edge cases: a null text, and one without words, is linked to nothing, but equal
texts are one class; a null key takes its class from equal texts with a key, if
any, else null; rows that share a key count as one document; an empty table gives an
empty result; other columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.llm.arrays import load, save
from ladle.llm.components import components
from ladle.llm.names import every, unused
from ladle.llm.shingles import GOLDEN, WordHashes, mix, shingles

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
#: Below this share of equal registers no pair is compared exactly; of pairs with ``SIMILARITY`` itself, 5e-7 fall below.
LEAST_AGREEMENT = 0.65
#: Members of a bucket that are compared with others at a time.
BLOCK = 2048
CHUNK_SHINGLES = 300_000


def registers(sets: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """The ProbMinHash signature of each weighted set: ``size`` shingles (0 for an empty set)."""
    n = len(sets)
    earliest, first = np.full(n * size, np.inf), np.zeros(n * size, np.uint64)
    counts = np.array([len(x) for x, _ in sets], np.int64)
    owner = np.repeat(np.arange(n), counts)
    item = np.concatenate([x for x, _ in sets]) if n else np.empty(0, np.uint64)
    weight = np.concatenate([w for _, w in sets]).astype(float) if n else np.empty(0)
    arrival, state = np.zeros(len(item)), mix(item + GOLDEN)
    while len(item):
        state = mix(state + GOLDEN)
        arrival = arrival - np.log((state >> np.uint64(11)).astype(float) * 2.0 ** -53 + 2.0 ** -54) / weight
        at = owner * size + (mix(state ^ GOLDEN) % np.uint64(size)).astype(np.int64)
        sooner = arrival < earliest[at]
        some, when = at[sooner], arrival[sooner]
        np.minimum.at(earliest, some, when)
        wins = earliest[some] == when
        first[some[wins]] = item[sooner][wins]
        latest = earliest.reshape(n, size).max(1)
        go_on = arrival < latest[owner]
        owner, item, weight, arrival, state = owner[go_on], item[go_on], weight[go_on], arrival[go_on], state[go_on]
    return first.reshape(n, size)


def similarity(x: np.ndarray, v: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """The probability Jaccard index of items ``x`` with weights ``v`` and ``y`` with ``w``; items ascend."""
    both, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    # Over all items: sum of max(v_k / v_i, w_k / w_i). It takes v_k where w_k / v_k <= w_i / v_i, else w_k.
    a, b = v[i].astype(float), w[j].astype(float)
    ratio = b / a
    order = np.argsort(ratio, kind="stable")
    sorted_ratio = ratio[order]
    below = np.concatenate(([0.0], np.cumsum(a[order])))[np.searchsorted(sorted_ratio, ratio, side="right")]
    above = b.sum() - np.concatenate(([0.0], np.cumsum(b[order])))[np.searchsorted(sorted_ratio, ratio, side="right")]
    only_x, only_y = v.sum() - a.sum(), w.sum() - b.sum()
    return float((1 / ((only_x + below) / a + (only_y + above) / b)).sum())


def _signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(key, address, text) -> (key, address, buckets, registers); a text without words has no buckets."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("address", T.BinaryType()),
                           T.StructField("buckets", T.ArrayType(T.LongType())), T.StructField("registers", T.BinaryType())])
    size = bands * rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def batch(some: pa.RecordBatch, sets: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            signature = registers(sets, size)
            bucket = np.tile(np.arange(bands, dtype=np.uint64), (len(sets), 1))
            for k in range(rows):
                bucket = mix(bucket * GOLDEN + signature[:, k::rows])
            full = np.array([len(x) > 0 for x, _ in sets])
            ends = np.concatenate(([0], np.cumsum(full * bands))).astype(np.int32)
            flat = pa.array(bucket[full].ravel().view(np.int64))
            raw = [x.tobytes() for x in (signature & np.uint64(255)).astype(np.uint8)]
            return pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(raw, pa.binary())],
                                              names=schema.fieldNames())

        for whole in batches:
            first, sets, held = 0, [], 0
            hashes.trim()
            for at, value in enumerate(whole.column(2)):
                sets.append(shingles(value.as_py() or "", width, hashes))
                held += len(sets[-1][0])
                if held >= CHUNK_SHINGLES or at + 1 == whole.num_rows:
                    yield batch(whole.slice(first, len(sets)), sets)
                    first, sets, held = at + 1, [], 0

    return docs.mapInArrow(sign, schema)


def _agreeing(pairs: DataFrame, least: float) -> DataFrame:
    """Of (a, b, of_a, of_b), the pairs whose registers agree often enough."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                one, other = (np.array([np.frombuffer(x, np.uint8) for x in rows.column(i).to_pylist()]) for i in (2, 3))
                rows = rows.filter(pa.array((one == other).mean(1) >= least))
            yield rows.select(["a", "b"])

    return pairs.select("a", "b", "of_a", "of_b").mapInArrow(keep, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b, similarity) of the pairs that are similar enough; ``sets`` has (node, items, weights)."""
    one = sets.select(F.col("node").alias("a"), F.col("items").alias("x"), F.col("weights").alias("v"))
    other = sets.select(F.col("node").alias("b"), F.col("items").alias("y"), F.col("weights").alias("w"))
    joined = pairs.join(other, "b").join(one, "a").select("a", "b", "x", "v", "y", "w")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = []
            for x, v, y, w in zip(*(rows.column(i).to_pylist() for i in range(2, 6))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                found.append(similarity(x, np.frombuffer(v, np.uint32) if v else np.ones(len(x)), y, np.frombuffer(w, np.uint32) if w else np.ones(len(y))))
            found = np.array(found)
            # A sum of fractions may fall short of the bound by rounding.
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(found, pa.float64())],
                                             names=["a", "b", "similarity"]).filter(pa.array(found >= least - 1e-9))

    return joined.mapInArrow(compare, "a long, b long, similarity double")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(node, text) -> (node, items, weights); null weights are all 1."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for rows in batches:
            hashes.trim()
            for first in range(0, rows.num_rows, 1000):
                some = rows.slice(first, 1000)
                found = [shingles(x or "", width, hashes) for x in some.column(1).to_pylist()]
                items = pa.array([x.tobytes() for x, _ in found], pa.binary())
                weights = pa.array([None if (w == 1).all() else w.astype(np.uint32).tobytes() for _, w in found], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column(0), items, weights], names=["node", "items", "weights"])

    return texts.mapInArrow(take, "node long, items binary, weights binary")


SHARD = T.StructType([T.StructField("shard", T.IntegerType())])


def _save_sets(sets: DataFrame, folder: str, shards: int) -> DataFrame:
    """Keeps (node, items, weights) as arrays by node, in ``shards`` files each; gives a row per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for rows in batches:
            for shard, *row in zip(*(c.to_pylist() for c in rows.columns)):
                held.setdefault(shard, []).append(row)
        for shard, rows in held.items():
            rows = sorted({r[0]: r for r in rows}.values())
            items = [np.frombuffer(x, np.uint64) for _, x, _ in rows]
            weights = [np.frombuffer(w, np.uint32) if w else np.ones(len(x), np.uint32) for x, (_, _, w) in zip(items, rows)]
            for name, array in (("nodes", np.array([r[0] for r in rows], "<i8")), ("ends", np.cumsum([len(x) for x in items], dtype="<i8")),
                                ("items", np.concatenate(items).astype("<u8")), ("weights", np.concatenate(weights).astype("<u4"))):
                save(folder, f"{name}-{shard}", array)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32())], names=["shard"])

    shard = F.pmod(F.col("node"), F.lit(shards)).cast("int").alias("shard")
    return sets.select(shard, "node", "items", "weights").repartitionById(shards, F.col("shard")).mapInArrow(run, SHARD)


class _Sets:
    """The kept shingles, as seen by one worker."""

    def __init__(self, folder: str, shards: int) -> None:
        self.folder, self.shards, self.arrays = folder, shards, {}

    def __getitem__(self, node: int) -> tuple[np.ndarray, np.ndarray]:
        shard = node % self.shards
        if shard not in self.arrays:
            self.arrays[shard] = [load(self.folder, f"{name}-{shard}", kind) for name, kind in (("nodes", "<i8"), ("ends", "<i8"), ("items", "<u8"), ("weights", "<u4"))]
        nodes, ends, items, weights = self.arrays[shard]
        at = int(np.searchsorted(nodes, node))
        own = slice(int(ends[at - 1]) if at else 0, int(ends[at]))
        return items[own], weights[own]


def _rest(members: DataFrame, folder: str, shards: int, least: float, least_agreement: float) -> DataFrame:
    """Links (a, b, similarity) between classes, in blocks of each bucket.

    ``members`` has (bucket, block, asks, node, class, registers, buckets): in each
    (bucket, block), those that ask come first and are compared with the others.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, current, asks, others = _Sets(folder, shards), None, [], []

        def found() -> Iterator[pa.RecordBatch]:
            if not asks or not others:
                return
            node, label, raw, shared = zip(*others)
            label = np.array(label, np.int64)
            there, shared = np.array([np.frombuffer(x, np.uint8) for x in raw]), np.array(shared, np.int64)
            out = []
            for own, own_label, own_raw, own_buckets in asks:
                near = np.flatnonzero(label != own_label)
                near = near[(there[near] == np.frombuffer(own_raw, np.uint8)).mean(1) >= least_agreement]
                common = shared[near] == np.array(own_buckets, np.int64)
                first = common.argmax(1) if len(near) else near
                near = near[shared[near, first] == current[0]]
                met, mine = set(), None
                for i in near.tolist():
                    if label[i] not in met:
                        mine = sets[own] if mine is None else mine
                        alike = similarity(*mine, *sets[node[i]])
                        if alike >= least - 1e-9:
                            met.add(label[i])
                            out.append((min(own, node[i]), max(own, node[i]), alike))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "similarity"])

        for rows in batches:
            for bucket, block, asking, *row in zip(*(c.to_pylist() for c in rows.columns)):
                if (bucket, block) != current:
                    yield from found()
                    current, asks, others = (bucket, block), [], []
                (asks if asking else others).append(row)
        yield from found()

    dealt = members.select("bucket", "block", "asks", "node", "class", "registers", "buckets").repartition("bucket", "block")
    return dealt.sortWithinPartitions("bucket", "block", F.desc("asks"), "node").mapInArrow(search, "a long, b long, similarity double")


def classes(docs: DataFrame, work: str, *, text: str = "text", key: str = "doc_id", width: int = WIDTH, least: float = SIMILARITY,
            bands: int = BANDS, rows: int = ROWS, least_agreement: float = LEAST_AGREEMENT) -> DataFrame:
    """(key, class_id) of each row: the least key of its class.

    ``work`` is a new folder that all workers share; what each step finds is written
    there, so that nothing is computed twice and a lost executor costs a step at most.
    """
    spark = docs.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.parquet(f"{work}/{name}")

    texts = docs.select(docs[key].cast("long").alias("key"), F.unhex(F.md5(F.coalesce(docs[text], F.lit("")))).alias("address"), docs[text].alias("text"))
    signed = kept(_signatures(texts, width, bands, rows), "signatures")
    first = kept(signed.groupBy("address").agg(F.min("key").alias("node")), "first")
    nodes = signed.join(first, (signed["address"] == first["address"]) & (signed["key"] == first["node"])).select("node", "buckets", "registers")
    of_node = nodes.select("node", "registers")

    # Buckets of two nodes or more, with the least one.
    spread = nodes.select("node", F.explode("buckets").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select("bucket", "least")
    members = kept(spread.join(shared, "bucket"), "members")
    in_buckets = members.select("node").distinct()
    sets = kept(_sets(texts.join(in_buckets.join(first, "node").hint("shuffle_hash"), (texts["address"] == first["address"]) & (F.col("key") == F.col("node")),
                                 "left_semi").select(F.col("key").alias("node"), "text"), width), "sets")

    def both(pairs: DataFrame) -> DataFrame:
        return pairs.join(of_node.select(F.col("node").alias("b"), F.col("registers").alias("of_b")), "b").join(
            of_node.select(F.col("node").alias("a"), F.col("registers").alias("of_a")), "a")

    with_least = members.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    links = kept(_verified(_agreeing(both(with_least), least_agreement), sets, least), "links")
    labels = components(links, f"{work}/classes")

    # Buckets that hold several classes besides their least member (which was compared with all).
    others = members.where("node <> least").join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("class"))
    by_class = others.groupBy("bucket", "class").agg(F.count(F.lit(1)).alias("n"))
    mixed = by_class.groupBy("bucket").agg(F.max(F.struct("n", "class")).alias("largest"), F.count(F.lit(1)).alias("classes"), F.sum("n").alias("n")).where(
        "classes > 1").select("bucket", F.col("largest.class").alias("largest"), F.ceil(F.col("n") / BLOCK).cast("int").alias("across"),
                              F.ceil((F.col("n") - F.col("largest.n")) / BLOCK).cast("int").alias("down"))
    open_members = kept(others.join(mixed, "bucket").join(nodes, "node"), "open")
    # A grid of blocks: who asks is dealt over its rows, who is held over its columns.
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = open_members.withColumn("column", own("across")).withColumn("row", each("down")).withColumn("asks", F.lit(False))
    asking = open_members.where(F.col("class") != F.col("largest")).withColumn("column", each("across")).withColumn(
        "row", own("down")).withColumn("asks", F.lit(True))
    blocks = held.unionByName(asking).withColumn("block", F.col("row") * F.col("across") + F.col("column"))
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept(_save_sets(sets.join(open_members.select("node").distinct(), "node"), f"{work}/arrays", shards), "shards")
    more = kept(_rest(blocks, f"{work}/arrays", shards, least, least_agreement), "more-links")
    labels = components(links.unionByName(more), f"{work}/all-classes")
    return signed.select("key", "address").join(first, "address").join(labels, "node", "left").select(
        F.col("key").alias(key), F.coalesce("label", "node").alias("class_id"))


def keep_one(docs: DataFrame, work: str, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each class, that of the least key; rows with a null key stay."""
    found = classes(docs, work, text=text, key=key)
    name, = unused(docs, "kept")
    first = found.where(F.col(key) == F.col("class_id")).select(F.col(key).cast(docs.schema[key].dataType).alias(name)).distinct()
    kept = docs.join(first.hint("shuffle_hash"), docs[key] == F.col(name), "left_semi").dropDuplicates([key])
    return kept.unionByName(docs.where(docs[key].isNull())).select(*every(docs))


"""Mixing documents to target shares of domains, in DataFrame operations only.

A naive Bayes classifier over hashed words, fitted on a bounded sample of a labelled
table (``SAMPLE_ROWS`` documents in the order of a hash of the key), gives each document
its posterior over the domains. A document of n words counts n times its posterior
towards each domain's tokens. Rates 0 <= r <= ``MOST_RATE`` are then fitted so that the totals over all
documents, sum of r * n * posterior, match the targets, or come as near as such rates can: from r = 1
by projected gradient steps on the squared gap between totals and targets. The gap is
measured in the inverse of G = sum of n * posterior * posterior', and the step of a
document is divided by its n; under that scaling a step length of 1 is exact where no
rate meets a bound, and each step lowers the gap. Where ``MOST_STEPS`` of them are not
enough, the next ones are implicit, with the gradient at their end: such a step may be
very long, and is found by Newton's method on one number per domain. They go on until
the gap, or what a plain step would change, is nothing; rates that don't settle raise.
A pass is over a table of a few numbers per document; the driver sees sums per domain
and pair of domains. What targets no rates within the bounds can meet is written down: the folder
``gap`` below ``work`` has a row per domain with its target and by how many tokens its total is off.

``mixed`` applies the rates: floor(r) copies of a row, and one more with the
probability of the rest, by a hash of the key.

Edge cases: a null text and one without words has no tokens and the domains' shares in
the sample as its posterior; rows that agree in key (null too) and text are rated
alike, each on its own tokens; labels that are null or for unknown keys are ignored;
without labels every posterior is the target shares; an empty table gives an empty
result; domains that the labels lack can't gain tokens; a domain short of tokens has its
documents ``MOST_RATE`` times at most. ``mixed`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm.names import every, unused

SAMPLE_ROWS = 20_000
#: Words share this many buckets, which bounds the classifier's table.
BUCKETS = 1 << 16
SMOOTHING = 0.5
#: Words repeat their neighbours' evidence; their summed log odds are divided by this.
TEMPER = 2.0
#: No document enters the mixture more often.
MOST_RATE = 16.0
MOST_STEPS = 40
CLOSE = 1e-9
#: Passes after which rates that have not settled raise.
MOST_PASSES = 400
#: Lengths of the implicit steps: the first, and the longest; each is ten times the last.
FIRST_LENGTH, MOST_LENGTH = 1e4, 1e10


def _pieces(text: Column) -> Column:
    """Lower-case words, and empty strings where a text begins or ends with white space or punctuation."""
    return F.split(F.lower(text), r"[\s\p{Punct}]+")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def _address(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], work: str, *, text: str = "text", key: str = "doc_id",
               sample: int = SAMPLE_ROWS) -> tuple[DataFrame, list[float]]:
    """(bucket, evidence array of a number per domain) for every bucket, and the domains' shares in the sample.

    ``labelled`` has (key, domain); its keys are ``sample`` at most before the join.
    """
    spark = docs.sparkSession
    own = labelled.select(labelled[key].alias("key"), labelled["domain"].alias("domain"))
    known = own.where(F.col("key").isNotNull() & F.col("domain").isin(domains)).groupBy("key").agg(F.min("domain").alias("domain"))
    known.orderBy(F.xxhash64("key"), "key").limit(sample).write.parquet(f"{work}/sample")
    some = spark.read.parquet(f"{work}/sample")
    texts = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    words = texts.join(F.broadcast(some), "key").select("domain", F.explode(_pieces(F.col("text"))).alias("word"))
    words.where("word <> ''").groupBy(_bucket(F.col("word")).alias("bucket")).pivot("domain", domains).count().write.parquet(f"{work}/counts")
    counts = spark.read.parquet(f"{work}/counts")
    column = [F.coalesce(F.col(f"`{d}`"), F.lit(0)) for d in domains]
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in column]).first()
    found = [F.log((c + SMOOTHING) / (float(t) + SMOOTHING * BUCKETS)) for c, t in zip(column, total)]
    mean = sum(found[1:], found[0]) / len(found)
    buckets = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    # Labels of keys that have no document don't count.
    met = texts.select("key").join(F.broadcast(some), "key").groupBy("key").agg(F.min("domain").alias("domain"))
    share = {r.domain: r.n for r in met.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(share.values())
    return buckets.select("bucket", F.array(*[f - mean for f in found]).alias("evidence")), [share.get(d, 0) / n if n else 0.0 for d in domains]


def posteriors(docs: DataFrame, evidence: DataFrame, shares: list[float], *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, address, n_tokens, posterior array) of each distinct (key, text) but null texts."""
    k = len(shares)
    # The address is taken before the words are laid out, once per row.
    rows = docs.select(docs[key].alias("key"), _address(docs[text]).alias("address"), _pieces(docs[text]).alias("pieces"))
    words = rows.select("key", "address", F.posexplode("pieces").alias("at", "word"))
    met = words.select("key", "address", "at", (F.col("word") != "").alias("is_word"), _bucket(F.col("word")).alias("bucket")).join(F.broadcast(evidence), "bucket")
    sums = met.groupBy("key", "address").agg(F.count_if("is_word").alias("words"), F.count_if(F.col("at") == 0).alias("rows"),
                                             *[F.coalesce(F.sum(F.when(F.col("is_word"), F.get("evidence", F.lit(i)))), F.lit(0.0)).alias(f"e{i}") for i in range(k)])
    score = [F.col(f"e{i}") / F.col("rows") / TEMPER + (math.log(shares[i]) if shares[i] else -1e9) for i in range(k)]
    scored = sums.select("key", "address", (F.col("words") / F.col("rows")).cast("long").alias("n_tokens"), F.array(*score).alias("score"))
    weights = F.transform("score", lambda s: F.exp(s - F.array_max("score")))
    return scored.select("key", "address", "n_tokens", weights.alias("weights")).select(
        "key", "address", "n_tokens", F.transform("weights", lambda w: w / F.aggregate("weights", F.lit(0.0), lambda a, b: a + b)).alias("posterior"))


def _within(rate: Column, most: float) -> Column:
    return F.least(F.lit(float(most)), F.greatest(F.lit(0.0), rate))


def fit_rates(table: DataFrame, targets: list[float], work: str, most: float = MOST_RATE) -> DataFrame:
    """``table`` (with n_tokens, posterior) and its column ``rate`` after ``MOST_STEPS`` plain steps, or as many as it takes; ``targets`` are tokens per domain."""
    spark, k = table.sparkSession, len(targets)
    p = [F.get("posterior", F.lit(i)) for i in range(k)]
    gram = table.agg(*[F.coalesce(F.sum(F.col("n_tokens") * p[i] * p[j]), F.lit(0.0)) for i in range(k) for j in range(k)]).first()
    inverse = np.linalg.pinv(np.array(gram, float).reshape(k, k), rcond=1e-9)
    state, rate, scale = table, F.lit(1.0), max(sum(targets), 1.0)
    for step in range(1, MOST_STEPS + 1):
        totals = state.agg(*[F.coalesce(F.sum(rate * F.col("n_tokens") * x), F.lit(0.0)) for x in p]).first()
        gap = np.array(totals, float) - np.array(targets)
        move = inverse @ gap
        if np.abs(gap).max() <= CLOSE * scale or np.abs(move).max() < CLOSE:
            break
        down = sum((F.lit(float(m)) * x for m, x in zip(move, p)), F.lit(0.0))
        rate = _within(rate - down, most)
        if step % 8 == 0:  # a short expression again
            state.withColumn("rate", rate).write.parquet(f"{work}/step-{step}")
            state, rate = spark.read.parquet(f"{work}/step-{step}"), F.col("rate")
    return state.withColumn("rate", rate)


def settle_rates(table: DataFrame, targets: list[float], work: str, most: float = MOST_RATE) -> tuple[DataFrame, np.ndarray]:
    """``table`` with its column ``rate`` moved on until nothing changes, and by how many tokens each domain's total is then off its target.

    The gap is nothing unless no rates meet all targets.
    """
    spark, k, wanted = table.sparkSession, len(targets), np.array(targets, float)
    n, p, rate = F.col("n_tokens"), [F.get("posterior", F.lit(i)) for i in range(k)], F.col("rate")
    passes = 0

    def sums(state: DataFrame, *of: Column) -> np.ndarray:
        nonlocal passes
        passes += 1
        if passes > MOST_PASSES:
            raise RuntimeError(f"rates have not settled after {MOST_PASSES} passes")
        return np.array(state.agg(*[F.coalesce(x, F.lit(0.0)) for x in of]).first(), float)

    def free(by: np.ndarray) -> Column:
        return rate - sum((F.lit(float(m)) * x for m, x in zip(by, p)), F.lit(0.0))

    def moved(by: np.ndarray) -> Column:
        return _within(free(by), most)

    def settled(state: DataFrame, gap: np.ndarray) -> bool:
        move = inverse @ gap
        return np.abs(gap).max() <= CLOSE * scale or np.abs(move).max() < CLOSE or sums(state, F.max(F.abs(rate - moved(move))))[0] < CLOSE

    totals = [F.sum(rate * n * x) for x in p]
    found = sums(table, *totals, *[F.sum(n * x * y) for x in p for y in p])
    gap, gram, scale = found[:k] - wanted, found[k:].reshape(k, k), max(sum(targets), 1.0)
    inverse = np.linalg.pinv(gram, rcond=1e-9)
    sizes, ways = np.linalg.eigh(gram)
    ways = ways[:, sizes > 1e-9 * sizes.max()]  # what the inverse covers: domains that have tokens
    state, step, length, before = table, 0, FIRST_LENGTH, np.inf
    while not settled(state, gap):
        if length == MOST_LENGTH and gap @ inverse @ gap > (1 - CLOSE) * before:
            break  # all that rounding leaves
        before = gap @ inverse @ gap
        if not step:
            table.write.parquet(f"{work}/plain-steps")
            state = spark.read.parquet(f"{work}/plain-steps")

        def at(by: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            """The objective of the step to the rates moved by ``by``, its gradient and its second derivatives."""
            held = F.when((moved(by) > 0) & (moved(by) < most), n).otherwise(F.lit(0.0))
            x = sums(state, F.sum(n * moved(by) * (free(by) - moved(by) / 2)), *[F.sum(n * moved(by) * x) for x in p], *[F.sum(held * x * y) for x in p for y in p])
            return x[0] + 0.5 * by @ gram @ by / length + by @ wanted, gram @ by / length - x[1:k + 1] + wanted, gram / length + x[k + 1:].reshape(k, k)

        by = np.zeros(k)
        value, slope, bend = at(by)
        for _ in range(MOST_STEPS):
            way, share = -ways @ np.linalg.solve(ways.T @ bend @ ways, ways.T @ slope), 1.0
            if -(slope @ way) <= 1e-15 * max(abs(value), 1.0):
                break
            after = at(by + way)
            while after[0] > value + 1e-4 * share * (slope @ way) + 1e-15 * abs(value) and share > 1e-6:
                share /= 2
                after = at(by + share * way)
            if share <= 1e-6:
                break
            by, (value, slope, bend) = by + share * way, after
        step += 1
        state.withColumn("rate", moved(by)).write.parquet(f"{work}/long-step-{step}")
        state, length = spark.read.parquet(f"{work}/long-step-{step}"), min(10 * length, MOST_LENGTH)
        gap = sums(state, *totals) - wanted
    return state, gap


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], work: str, *, text: str = "text", key: str = "doc_id",
          sample: int = SAMPLE_ROWS, most: float = MOST_RATE) -> DataFrame:
    """(key, address, n_tokens, posterior, rate) of each distinct (key, text) of ``docs``.

    ``targets`` are shares of the domains, which also name them; they apply to the
    number of tokens that ``docs`` has. No rate exceeds ``most``. ``work`` is a new folder
    that all workers share; ``gap`` in it has (domain, target, gap) in tokens.
    """
    spark, domains = docs.sparkSession, sorted(targets)
    evidence, shares = classifier(docs, labelled, domains, work, text=text, key=key, sample=sample)
    whole = sum(targets.values()) or 1.0
    wanted = [targets[d] / whole for d in domains]
    if not sum(shares):
        shares = wanted
    posteriors(docs, evidence, shares, text=text, key=key).write.parquet(f"{work}/posteriors")
    table = spark.read.parquet(f"{work}/posteriors")
    tokens = table.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    totals = [w * tokens for w in wanted]
    fitted, gap = settle_rates(fit_rates(table, totals, work, most), totals, work, most)
    spark.createDataFrame(list(zip(domains, totals, gap.tolist())), "domain string, target double, gap double").write.parquet(f"{work}/gap")
    prior = F.array(*[F.lit(float(s)) for s in shares])
    rows = docs.select(docs[key].alias("key"), _address(docs[text]).alias("address"))
    found = fitted.select(F.col("key").alias("__key"), F.col("address").alias("__address"), "n_tokens", "posterior", "rate")
    return rows.join(found, F.col("key").eqNullSafe(F.col("__key")) & (F.col("address") == F.col("__address")), "left").select(
        F.col("key").alias(key), "address", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), F.coalesce("posterior", prior).alias("posterior"),
        F.coalesce("rate", F.lit(1.0)).alias("rate"))


def copies(rate: Column, key: Column) -> Column:
    """How many copies a rate gives: the whole part, and one more with the probability of the rest."""
    chance = F.pmod(F.xxhash64(key, F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")).cast("int")


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], work: str, *, text: str = "text", key: str = "doc_id",
          most: float = MOST_RATE) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says."""
    found = rates(docs.select(docs[key].alias("doc_id"), docs[text].alias("text")), labelled.select(labelled[key].alias("doc_id"), labelled["domain"].alias("domain")),
                  targets, work, most=most).where("n_tokens > 0")
    of, at, times, copy = unused(docs, "of", "at", "times", "copy")
    rated = found.select(F.col("doc_id").alias(of), F.col("address").alias(at), copies(F.col("rate"), F.col("doc_id")).alias(times)).dropDuplicates([of, at])
    joined = docs.join(rated.hint("shuffle_hash"), docs[key].eqNullSafe(F.col(of)) & (_address(docs[text]) == F.col(at)), "left")
    # Of ``most`` entries at most.
    repeated = joined.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.coalesce(times, F.lit(1)))))
    return repeated.select(*every(docs))


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a table of (doc_id, quality, toxic): toxic, else poor or good."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain")).where("domain is not null")

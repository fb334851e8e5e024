"""Quality rules: a linear-chain conditional random field labels each line content or boilerplate.

A document fails the base rules if it has fewer than 10 words, or if more than a
fifth of its words lie in 5-word windows that occur twice or more in it. Of the
others, those are kept whose content lines (by Viterbi decoding) hold at least
``KEEP_SHARE`` of the characters in words.

The field is fitted on a bounded sample of labelled documents: up to
``SAMPLE_ROWS`` of each quality, in the order of a hash of the key, up to
``SAMPLE_CHARS`` characters and ``SAMPLE_LINES`` lines long (of rows that share a key, the least text). All lines of a document bear its quality as
label; the features, shared by all, decide which lines of a mixed document look
like either kind. Without labels of both kinds every line is content.

Edge cases: a null text has no words (and fails); null labels, null keys in the
labels and labels for unknown documents are ignored; repeated rows are judged
each alike; an empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORDS = re.compile(r"[^ \t-\r]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
SAMPLE_ROWS = 600
SAMPLE_CHARS, SAMPLE_LINES = 50_000, 1000
#: Lines of a training sequence; longer documents are cut into several.
SEQUENCE_LINES = 64
STEPS = 120
RIDGE = 1e-3
KEEP_SHARE = 0.3
FEATURES = 12
NOT_LETTERS = re.compile(r"[\W\d_]+")


def line_features(line: str, words: list[str], seen: bool) -> tuple[float, ...]:
    """What a line looks like, each value about 0 to 1."""
    n, size = len(words), len(line)
    if not n:
        return (1.0,) + (0.0,) * (FEATURES - 2) + (1.0,)
    chars = sum(map(len, words))
    letters = NOT_LETTERS.sub("", line)
    return (1.0, min(n, 60) / 60, min(chars / n, 20) / 20, sum(map(line.count, SYMBOLS)) / size, 1 - len(letters) / chars,
            sum(map(str.isupper, words)) / n, line.count("!") / n if n else 0.0, float(seen), float(words[-1][-1] in ".!?:;,"),
            len(set(words)) / n, float("://" in line or "@" in line), 0.0)


def repeated_words(words: list[str]) -> int:
    """Words inside 5-word windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n <= WINDOW:
        return 0
    index: dict[str, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.uint64, n)
    if len(index) > n - 1:
        return 0
    mixed = np.zeros(n - WINDOW + 1, np.uint64)
    for k in range(WINDOW):
        mixed = (mixed ^ ids[k:n - WINDOW + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    for k in range(WINDOW):
        same &= ids[order[1:] + k] == ids[order[:-1] + k]
    again = np.zeros(len(mixed), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    starts = np.flatnonzero(again)
    edges = np.zeros(n + 1, np.int64)
    edges[starts] += 1
    edges[starts + WINDOW] -= 1
    return int((np.cumsum(edges[:-1]) > 0).sum())


@dataclass(frozen=True)
class Field:
    """A linear-chain CRF with two states: 0 content, 1 boilerplate."""

    emission: tuple[float, ...]
    transition: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, scores: list[float]) -> list[int]:
        """Viterbi: the best states, given each line's score for state 1 over state 0."""
        (t00, t01), (t10, t11) = self.transition
        zero = one = 0.0
        back = []
        for first, score in zip([True] + [False] * len(scores), scores):
            if first:
                zero, one = 0.0, score
                continue
            a, b, c, d = zero + t00, one + t10, zero + t01, one + t11
            back.append((a < b, c < d))
            zero, one = (b if a < b else a), (d if c < d else c) + score
        state, states = int(one > zero), []
        for choice in reversed(back):
            states.append(state)
            state = int(choice[state])
        if scores:
            states.append(state)
        return states[::-1]


ALL_CONTENT = Field((-1.0,) + (0.0,) * (FEATURES - 1), ((0.0, 0.0), (0.0, 0.0)))


def fit_field(sequences: list[np.ndarray], labels: list[int]) -> Field:
    """Maximum conditional likelihood by gradient ascent (Adam), all sequences at once."""
    if len(set(labels)) < 2:
        return ALL_CONTENT
    pieces = [(x[a:a + SEQUENCE_LINES], y) for x, y in zip(sequences, labels) for a in range(0, len(x), SEQUENCE_LINES)]
    n, longest = len(pieces), max(len(x) for x, _ in pieces)
    x = np.zeros((n, longest, FEATURES))
    mask = np.zeros((n, longest))
    y = np.array([label for _, label in pieces])
    for i, (rows, _) in enumerate(pieces):
        x[i, :len(rows)], mask[i, :len(rows)] = rows, 1
    pair = mask[:, 1:] * mask[:, :-1]
    # Each class weighs the same, however many lines it has.
    weight = np.where(y == 1, 0.5 / mask[y == 1].sum(), 0.5 / mask[y == 0].sum())
    theta, m, v = np.zeros(FEATURES + 4), np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)
    seen_emission = np.einsum("n,ntf,nt->f", weight * y, x, mask)
    seen_transition = np.zeros((2, 2))
    np.add.at(seen_transition, (y, y), weight * pair.sum(1))
    for step in range(1, STEPS + 1):
        w, trans = theta[:FEATURES], theta[FEATURES:].reshape(2, 2)
        scores = np.stack([np.zeros((n, longest)), x @ w], -1)
        forward, backward = np.zeros((longest, n, 2)), np.zeros((longest, n, 2))
        forward[0] = scores[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(forward[t - 1][:, :, None] + trans, 1) + scores[:, t]
            forward[t] = np.where(mask[:, t, None] > 0, new, forward[t - 1])
        total = np.logaddexp.reduce(forward[-1], 1)
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(trans + (scores[:, t + 1] + backward[t + 1])[:, None, :], 2)
            backward[t] = np.where(mask[:, t + 1, None] > 0, new, 0)
        state = np.exp(forward[:, :, 1] + backward[:, :, 1] - total).T * mask
        pairs = np.zeros((2, 2))
        for t in range(longest - 1):
            p = np.exp(forward[t][:, :, None] + trans + (scores[:, t + 1] + backward[t + 1])[:, None, :] - total[:, None, None])
            pairs += np.einsum("n,nab->ab", weight * pair[:, t], np.where(pair[:, t, None, None] > 0, p, 0))
        gradient = np.concatenate([seen_emission - np.einsum("n,ntf,nt->f", weight, x, state), (seen_transition - pairs).ravel()]) - RIDGE * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        theta = theta + 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    theta = np.round(theta, 6)
    return Field(tuple(theta[:FEATURES].tolist()), tuple(map(tuple, theta[FEATURES:].reshape(2, 2).tolist())))


def _lines(text: str) -> tuple[list[list[str]], list[tuple[float, ...]], int]:
    """Each line's words and features, and how many lines with words equal an earlier one."""
    seen: set[str] = set()
    words_of, features, again = [], [], 0
    for line in text.split("\n"):
        words = WORDS.findall(line)
        known = bool(words) and line in seen
        again += known
        if words:
            seen.add(line)
        words_of.append(words)
        features.append(line_features(line, words, known))
    return words_of, features, again


def fit(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "quality") -> Field:
    """The field, from at most ``SAMPLE_ROWS`` documents of each quality (1 good, 0 poor)."""
    known = labels.select(labels[key].alias("key"), labels[label].alias("label")).where("key is not null and label in (0, 1)")
    some = known.where("label = 0").orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS).union(
        known.where("label = 1").orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS)).groupBy("key").agg(F.min("label").alias("label"))
    short = (F.length("text") <= SAMPLE_CHARS) & (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) < SAMPLE_LINES)
    texts = docs.select(docs[key].alias("key"), docs[text].alias("text")).where(short)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("lines", T.BinaryType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            raw = [np.array(_lines(x or "")[1], np.float32).tobytes() for x in rows.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(raw, pa.binary())], names=schema.fieldNames())

    # A text of each key, whatever rows repeat it.
    one = texts.join(F.broadcast(some), "key").groupBy("key").agg(F.min("label").alias("label"), F.min("text").alias("text"))
    rows = sorted(one.select(F.col("key").cast("long"), F.col("label").cast("int"), "text").mapInArrow(measure, schema).collect())
    return fit_field([np.frombuffer(r.lines, np.float32).reshape(-1, FEATURES).astype(float) for r in rows], [1 - r.label for r in rows])


def judge(docs: DataFrame, field: Field, *, text: str = "text", key: str = "doc_id", keep_share: float = KEEP_SHARE) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept) of each document."""
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    schema = T.StructType([docs.schema[key], *(T.StructField(x, T.LongType(), False) for x in longs), T.StructField("base_failed", T.BooleanType(), False),
                           T.StructField("content_share", T.DoubleType(), False), T.StructField("kept", T.BooleanType(), False)])
    weights = np.array(field.emission)

    def one(text: str) -> tuple:
        words_of, features, again = _lines(text)
        words = [w for line in words_of for w in line]
        n = len(words)
        chars = [sum(map(len, line)) for line in words_of]
        repeated = repeated_words(words)
        failed = n < LEAST_WORDS or 100 * repeated > MOST_REPEATED_PERCENT * n
        states = field.decode((np.array(features) @ weights).tolist())
        content = sum(c for c, state in zip(chars, states) if not state)
        share = content / max(1, sum(chars))
        return n, sum(chars), sum(map(text.count, SYMBOLS)), again, repeated, failed, share, not failed and share >= keep_share

    def judge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [one(x.as_py() or "") for x in rows.column(1)]
            columns = [pa.array(x, f.type) for x, f in zip(zip(*found), arrow)] if found else [pa.array([], f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays([rows.column(0), *columns], names=schema.fieldNames())

    arrow = [pa.field(x, pa.int64()) for x in longs] + [pa.field("base_failed", pa.bool_()), pa.field("content_share", pa.float64()), pa.field("kept", pa.bool_())]
    return docs.select(docs[key], docs[text]).mapInArrow(judge_batches, schema)


def keep(docs: DataFrame, field: Field, *, text: str = "text", keep_share: float = KEEP_SHARE) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    place = docs.columns.index(text)
    weights = np.array(field.emission)

    def passes(value: str) -> bool:
        words_of, features, _ = _lines(value)
        words = [w for line in words_of for w in line]
        if len(words) < LEAST_WORDS or 100 * repeated_words(words) > MOST_REPEATED_PERCENT * len(words):
            return False
        chars = [sum(map(len, line)) for line in words_of]
        states = field.decode((np.array(features) @ weights).tolist())
        return sum(c for c, state in zip(chars, states) if not state) >= keep_share * max(1, sum(chars))

    def keep_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield rows.filter(pa.array([passes(x.as_py() or "") for x in rows.column(place)], pa.bool_()))

    # Under plain names: Spark takes a point in a name for a field's.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(keep_batches, plain.schema).toDF(*docs.columns)

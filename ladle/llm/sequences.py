"""Token ids as Arrow files of equal-length sequences and masks.

Documents are tokenized where they lie, dealt to shards by ranges of their key and
written in key order. A shard is one Arrow IPC file whose record batches hold
``SEQUENCES`` rows of two fixed-size lists: ``tokens`` and the bits of ``mask``
(false marks the padding behind a shard's last document). Sequence i of a shard is row
``i % SEQUENCES`` of batch ``i // SEQUENCES``, so a reader maps the file and takes
it without copying. An index file beside it has each document's place.

Files go to a folder that all workers share (any file system pyarrow reaches by
URI), under a name of the attempt, and are moved to their own name when whole: a
task that runs again replaces a file by the same bytes.

Edge cases: a null text is an empty one, which still has its end id; documents
with a null key come first; equal keys keep a fixed order (by ids); an empty
table makes no files and an empty result; other columns are dropped.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

LENGTH = 2048
SEQUENCES = 256
CACHE_ENTRIES = 800_000
#: Bytes of text tokenized together; a longer document goes alone.
CHUNK_BYTES = 8_000_000
#: Words of one call of the tokenizer.
TOGETHER = 512
#: A word that any tokenizer with word ends takes as one piece, and what may follow it up to white space.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*)").fullmatch


class WordTokenizer:
    """The tokenizers library behind a cache of words.

    For tokenizers whose pieces never span white space. Words of plain letters
    are tokenized many at a time, in lower case where the tokenizer lowers them:
    each ends with the one token that carries the end-of-word mark.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.word_ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.lowers = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str("AÀ") == "aà"
        self.cache: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Adds the words to the cache; of plain words, only stems not seen before are tokenized."""
        stems, cache, plain, odd, fresh, marks_seen = self.stems, self.cache, [], [], {}, set()
        for word in words:
            match = PLAIN(word)
            if match:
                stem, marks = match.groups()
                if self.lowers:
                    stem = stem.lower()
                plain.append((word, stem, marks))
                if stem not in stems:
                    fresh[stem] = None
                if marks and marks not in stems:
                    marks_seen.add(marks)
            else:
                odd.append(word)
        for known, some in ((cache, odd), (stems, list(marks_seen))):
            known.update((x, np.array(ids, self.dtype).tobytes()) for x, ids in zip(some, self._encode(some)))
        fresh = list(fresh)
        for at in range(0, len(fresh), TOGETHER):
            some = fresh[at:at + TOGETHER]
            joined = np.array(self._encode([" ".join(some)])[0], np.int64)
            raw, ends = joined.astype(self.dtype).tobytes(), (np.flatnonzero(self.word_ends[joined]) + 1) * self.dtype.itemsize
            assert len(ends) == len(some), "a word is not one piece"
            ends = [0, *ends.tolist()]
            stems.update(zip(some, map(raw.__getitem__, map(slice, ends, ends[1:]))))
        for word, stem, marks in plain:
            cache[word] = stems[stem] + stems[marks] if marks else stems[stem]

    def _ids_of(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words, little-endian, as ``dtype``."""
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
        if len(self.stems) > CACHE_ENTRIES:
            self.stems.clear()
        found = list(map(self.cache.get, words))
        new = [w for w, x in zip(words, found) if x is None]
        if new:
            self._learn(new)
            found = list(map(self.cache.__getitem__, words))
        return found

    def encode(self, texts: list[str], end: bytes) -> list[bytes]:
        """The ids of each text and the end id, little-endian, as ``dtype``."""
        return self.encode_column(pa.array(texts, pa.string()), int.from_bytes(end, "little")).to_pylist()

    def encode_column(self, texts: pa.StringArray, end_id: int) -> pa.BinaryArray:
        """The ids of each text and the end id, little-endian, as ``dtype``.

        Words are split and told apart by Arrow; each distinct one is looked up once, and
        the ids of all are gathered from those by their places.
        """
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        word = coded.indices.to_numpy()
        raw = self._ids_of(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // self.dtype.itemsize
        flat, begins = np.frombuffer(b"".join(raw), self.dtype), np.cumsum(sizes) - sizes
        upto = np.concatenate(([0], np.cumsum(sizes[word])))
        docs, before = len(texts), upto[split.offsets.to_numpy()]
        ends = before[1:] + np.arange(1, docs + 1)
        out = np.empty(int(upto[-1]) + docs, self.dtype)
        source = np.arange(upto[-1]) + np.repeat(begins[word] - upto[:-1], sizes[word])
        out[np.arange(upto[-1]) + np.repeat(np.arange(docs), np.diff(before))] = flat[source]
        out[ends - 1] = end_id
        offsets = np.concatenate(([0], ends * self.dtype.itemsize)).astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), docs, [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.binary())


@lru_cache(maxsize=4)
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def bounds(keys: DataFrame, key: str, shards: int) -> list[int]:
    """At most ``shards - 1`` keys that cut the table into shards of about equal rows; each is the last of its shard."""
    if shards < 2:
        return []
    shares = [i / shards for i in range(1, shards)]
    found = keys.agg(F.percentile_approx(key, shares, 100 * shards).alias("b")).first()["b"]
    return sorted(set(found or []))


def tokenize(docs: DataFrame, path: str, end_id: int, cuts: list[int], *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(shard, key, ids binary) of each document.

    ``ids`` are little-endian, two bytes each if the vocabulary allows, else four.
    ``shard`` is the number of ``cuts`` below the key.
    """
    schema = T.StructType([T.StructField("shard", T.IntegerType(), False), T.StructField("key", T.LongType()),
                           T.StructField("ids", T.BinaryType(), False)])

    def tokenize_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = word_tokenizer(path)
        for rows in batches:
            keys, texts = rows.column(0), rows.column(1).fill_null("")
            values = keys.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            shard = pa.array(np.searchsorted(np.array(cuts, np.int64), values, side="left").astype(np.int32))
            upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            first = 0
            while first < rows.num_rows:
                before = upto[first - 1] if first else 0
                end = max(first + 1, int(np.searchsorted(upto, before + CHUNK_BYTES, side="right")))
                some = slice(first, end)
                yield pa.RecordBatch.from_arrays([shard[some], keys[some], own.encode_column(texts[some], end_id)], names=schema.fieldNames())
                first = end

    return docs.select(docs[key].cast("long").alias("key"), docs[text].alias("text")).mapInArrow(tokenize_batches, schema)


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder)


class _Shard:
    """Writes one shard: its sequences, and the index of its documents."""

    def __init__(self, folder: str, shard: int, dtype: np.dtype, length: int) -> None:
        self.files, base = _open(folder)
        self.files.create_dir(base, recursive=True)
        self.name, self.shard, self.length, self.dtype = f"{base}/shard-{shard:06d}", shard, length, dtype
        self.attempt = f"{base}/_attempt-{uuid.uuid4().hex}"
        self.schema = pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index = pa.schema([("key", pa.int64()), ("offset", pa.int64()), ("n_tokens", pa.int64())])
        self.sinks = [self.files.open_output_stream(f"{self.attempt}.{kind}") for kind in ("arrow", "index")]
        self.writers = [pa.ipc.new_file(sink, schema) for sink, schema in zip(self.sinks, (self.schema, self.index))]
        self.held: list[bytes] = []
        self.held_bytes = self.total = self.docs = 0
        self.places: list[tuple[int | None, int, int]] = []

    def add(self, key: int | None, raw: bytes) -> None:
        n = len(raw) // self.dtype.itemsize
        self.places.append((key, self.total, n))
        self.total += n
        self.docs += 1
        self.held.append(raw)
        self.held_bytes += len(raw)
        if self.held_bytes >= self.length * SEQUENCES * self.dtype.itemsize:
            self._flush(False)
        if len(self.places) >= 50_000:
            self._flush_index()

    def _flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.held), self.dtype)
        full = self.length * SEQUENCES
        whole = len(flat) // full * full
        for at in range(0, whole, full):
            self._batch(flat[at:at + full], full)
        rest = flat[whole:]
        if last and len(rest):
            self._batch(rest, -(-len(rest) // self.length) * self.length)
            rest = rest[:0]
        self.held, self.held_bytes = [rest.tobytes()], rest.nbytes

    def _batch(self, ids: np.ndarray, size: int) -> None:
        tokens, mask = np.zeros(size, self.dtype), np.zeros(size, bool)
        tokens[:len(ids)], mask[:len(ids)] = ids, True
        self.writers[0].write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (tokens, mask)], schema=self.schema))

    def _flush_index(self) -> None:
        if self.places:
            self.writers[1].write_batch(pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*self.places)], schema=self.index))
        self.places = []

    def close(self) -> tuple[int, str, int, int]:
        self._flush(True)
        self._flush_index()
        for writer, sink, kind in zip(self.writers, self.sinks, ("arrow", "index")):
            writer.close()
            sink.close()
            self.files.move(f"{self.attempt}.{kind}", f"{self.name}.{kind}")
        return self.shard, self.name.rpartition("/")[2], self.total, self.docs


def write(ids: DataFrame, folder: str, shards: int, *, dtype: np.dtype, length: int = LENGTH) -> DataFrame:
    """Writes (shard, key, ids) into ``folder`` by shard, in ascending key order; gives the manifest, a row per shard.

    The manifest is kept as Parquet in the folder, so reading it never writes again.
    """
    spark = ids.sparkSession
    manifest = T.StructType([T.StructField("shard", T.LongType()), T.StructField("file", T.StringType()),
                             T.StructField("n_tokens", T.LongType()), T.StructField("n_docs", T.LongType())])

    def write_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shard, done = None, []
        for rows in batches:
            for at, k, raw in zip(*(rows.column(i).to_pylist() for i in range(3))):
                if open_shard is None or open_shard.shard != at:
                    if open_shard is not None:
                        done.append(open_shard.close())
                    open_shard = _Shard(folder, at, np.dtype(dtype), length)
                open_shard.add(k, raw)
        if open_shard is not None:
            done.append(open_shard.close())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=manifest.fieldNames())

    dealt = ids.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "key", "ids")
    dealt.mapInArrow(write_shards, manifest).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(manifest).parquet(f"{folder}/manifest")


class Sequences:
    """Random access to one shard file: ``tokens(i)`` and ``mask(i)`` are views into the mapped file."""

    def __init__(self, path: str) -> None:
        files, path = _open(path)
        source = pa.memory_map(path) if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        self.length = self.file.schema.field("tokens").type.list_size
        self.at, self.columns = -1, None

    def batch(self, at: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if at != self.at:
            tokens, mask = (x.values for x in self.file.get_batch(at).columns)
            self.at, self.columns = at, (tokens.to_numpy(zero_copy_only=True), mask)
        return self.columns

    def tokens(self, i: int) -> np.ndarray:
        at = i % SEQUENCES * self.length
        return self.batch(i // SEQUENCES)[0][at:at + self.length]

    def mask(self, i: int) -> pa.BooleanArray:
        return self.batch(i // SEQUENCES)[1].slice(i % SEQUENCES * self.length, self.length)

    def span(self, offset: int, n: int) -> np.ndarray:
        """Ids from ``offset`` on in the shard."""
        full, parts = self.length * SEQUENCES, []
        while n:
            at = offset % full
            part = self.batch(offset // full)[0][at:at + n]
            parts.append(part)
            offset, n = offset + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, "<u4")


def read(manifest: DataFrame, folder: str, *, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids) of each document, from the files; ids are little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before. The running sum is over the
    manifest, which has a row per shard.
    """
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    before = F.coalesce(F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.select("file", before.alias("before"))

    def read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _open(folder)
        for rows in batches:
            for name, before in zip(*(rows.column(i).to_pylist() for i in range(2))):
                shard = Sequences(f"{folder}/{name}.arrow") if files.get_file_info(f"{base}/{name}.arrow").size else None
                with files.open_input_file(f"{base}/{name}.index") as source:
                    index = pa.ipc.open_file(source)
                    for at in range(index.num_record_batches):
                        places = index.get_batch(at)
                        for first in range(0, places.num_rows, 1000):
                            some = places.slice(first, 1000)
                            raw = [shard.span(o, n).astype("<u4").tobytes() for o, n in zip(some.column(1).to_pylist(), some.column(2).to_pylist())]
                            yield pa.RecordBatch.from_arrays([some.column(0), pc.add(some.column(1), before), some.column(2),
                                                              pa.array(raw, pa.binary())], names=schema.fieldNames())

    return shards.repartition(max(1, manifest.count()), "file").mapInArrow(read_shards, schema)


def write_documents(docs: DataFrame, path: str, end_id: int, folder: str, *, text: str = "text", key: str = "doc_id",
                    shards: int | None = None, length: int = LENGTH) -> DataFrame:
    """Tokenizes and writes ``docs``; gives the manifest. As many shards as the session has shuffle partitions, unless told."""
    cuts = bounds(docs, key, shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ids = tokenize(docs, path, end_id, cuts, text=text, key=key)
    return write(ids, folder, len(cuts) + 1, dtype=WordTokenizer(path).dtype, length=length)

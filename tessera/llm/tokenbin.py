"""Token ids in seekable zstandard shards.

A shard holds the documents of one doc_id range in ascending order.  Each frame
is an independent zstandard frame with a content checksum and the ids of some
consecutive documents as little-endian unsigned 32-bit integers.  After the
frames comes the index, a zstandard frame too, with five int64 columns (document
key, a null flag, frame number, first id within the frame, number of ids), then
the seek table: a skippable frame in the layout that zstandard's seekable format
fixes, with compressed size, decompressed size and a checksum for each frame,
and a footer.  A reader takes the footer, the table and the index, then
decompresses only the frames of the documents that it wants.

Nulls: a null text is the empty text and so has the end id alone; a null doc_id
sorts first.  Equal doc_ids are kept, in order of their text.  An empty table gives
no rows.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import shared_folder, tidy
from tessera.llm.units import LETTERS, UnitIds, gather, stops_apart

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC, WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
FRAME_IDS = 1 << 16
#: Text of a shard at most, about; with few texts there are as many shards as shuffle partitions.
SHARD_BYTES = 256 << 20
#: Words of Latin letters alone.
PLAIN = rf"^[{LETTERS}]+$"


class WordEncoder:
    """Encodes texts with a word-level BPE tokenizers file (one that drops white space and never joins words over it).

    Each distinct word of a batch reaches the library once: a text's ids are those of its words in order.  A word of
    plain Latin letters is one unit for the library's splitter, as are full stops and commas behind it, so such words are
    sent many to a string and parted again where the word-end mark of the vocabulary stands.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        mark = json.loads(self.library.to_str())["model"]["end_of_word_suffix"]
        self.closes = np.zeros(self.library.get_vocab_size(), dtype=bool)
        for token, i in self.library.get_vocab().items():
            self.closes[i] = token.endswith(mark)
        self.units = UnitIds(self._library)

    def _library(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word, one after another, and where each begins."""
        plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
        parts, lengths = [None] * 2, np.zeros(len(words), np.int64)
        many = words.filter(pa.array(plain)).to_pylist()
        joined = self.library.encode_batch_fast([" ".join(many[i : i + 64]) for i in range(0, len(many), 64)], add_special_tokens=False)
        parts[0] = np.concatenate([np.zeros(0, "<u4"), *(np.asarray(e.ids, dtype="<u4") for e in joined)])
        ends = np.flatnonzero(self.closes[parts[0]]) + 1
        if len(ends) != len(many):
            raise ValueError("a plain word isn't one unit of this tokenizer")
        lengths[plain] = np.diff(ends, prepend=0)
        single = [np.asarray(e.ids, dtype="<u4") for e in self.library.encode_batch_fast(words.filter(pa.array(~plain)).to_pylist(), add_special_tokens=False)]
        lengths[~plain] = [len(x) for x in single]
        parts[1] = np.concatenate([np.zeros(0, "<u4"), *single])
        order = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)]), kind="stable")
        own = np.concatenate([lengths[plain], lengths[~plain]])
        return gather(np.concatenate(parts), np.concatenate([[0], np.cumsum(own)]), order, np.arange(len(words) + 1))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after another, and where each text begins."""
        texts = texts.cast(pa.large_string()).fill_null("")
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = pc.dictionary_encode(parts.flatten())
        flat, begins = stops_apart(coded.dictionary, PLAIN, True, self.units)
        where = parts.offsets.to_numpy()
        return gather(flat, begins, coded.indices.to_numpy(zero_copy_only=False), where - where[0])


class ShardWriter:
    """Writes one shard through write(bytes), frame by frame; the index and the seek table stay in memory until the end."""

    def __init__(self, write, frame_ids: int = FRAME_IDS):
        import zstandard

        self.press = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True)
        self.write, self.frame_ids, self.table, self.index, self.open, self.size = write, frame_ids, [], array("q"), [], 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.index.extend((key or 0, key is None, len(self.table), self.size, len(ids)))
        self.open.append(ids)
        self.size += len(ids)
        if self.size >= self.frame_ids:
            self._flush()

    def _flush(self) -> None:
        if self.open:
            self._frame(np.concatenate(self.open).astype("<u4").tobytes())
            self.open, self.size = [], 0

    def _frame(self, raw: bytes) -> None:
        pressed = self.press.compress(raw)
        self.write(pressed)
        self.table.append((len(pressed), len(raw), zlib.crc32(raw)))

    def finish(self) -> None:
        self._flush()
        self._frame(np.array(self.index, dtype="<i8").reshape(-1, 5).tobytes())
        entries = b"".join(struct.pack("<III", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        self.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)


class ShardReader:
    """Reads a shard through read(offset, length); decompresses only the frames that are asked for."""

    def __init__(self, read, size: int):
        import zstandard

        self.read, self.unpress = read, zstandard.ZstdDecompressor()
        n, flags, magic = struct.unpack("<IBI", read(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != WITH_CHECKSUMS:
            raise ValueError("not a seekable shard")
        self.table = [struct.unpack("<III", x) for x in _chunks(read(size - 9 - 12 * n, 12 * n), 12)]
        self.begins = np.concatenate([[0], np.cumsum([x[0] for x in self.table])]).astype(int)
        self.index = np.frombuffer(self.frame(n - 1), dtype="<i8").reshape(-1, 5)
        self._last: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def frame(self, k: int) -> bytes:
        raw = self.unpress.decompress(self.read(int(self.begins[k]), self.table[k][0]), max_output_size=self.table[k][1])
        if len(raw) != self.table[k][1] or zlib.crc32(raw) != self.table[k][2]:
            raise ValueError(f"frame {k} doesn't match its checksum")
        return raw

    def ids(self, i: int) -> np.ndarray:
        """The ids of the i-th document of the shard."""
        _, _, k, first, n = self.index[i]
        if self._last[0] != k:
            self._last = (k, np.frombuffer(self.frame(int(k)), dtype="<u4"))
        return self._last[1][first : first + n]

    def find(self, doc_id: int) -> list[np.ndarray]:
        keys = np.where(self.index[:, 1] == 1, np.iinfo(np.int64).min, self.index[:, 0])
        lo, hi = np.searchsorted(keys, [doc_id, doc_id + 1])
        return [self.ids(i) for i in range(lo, hi) if not self.index[i, 1]]


def _chunks(raw: bytes, n: int) -> Iterator[bytes]:
    return (raw[i : i + n] for i in range(0, len(raw), n))


def open_shard(uri: str) -> ShardReader:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    f = store.open_input_file(path)
    return ShardReader(lambda at, n: f.read_at(n, at), f.size())


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int, shards: int, frame_ids: int = FRAME_IDS) -> list[dict]:
    """Writes doc_id, text as shards under ``folder`` (a URI that all executors reach).

    Returns the manifest, one entry for each shard in doc_id order.  A task that runs
    again writes under a name of its own and then renames, so shards are whole or absent.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        from tessera.llm.words import slices

        part = TaskContext.get().partitionId()
        store, path = fs.FileSystem.from_uri(folder)
        name, draft = f"part-{part:06d}.zst", f".part-{part:06d}-{uuid.uuid4().hex}"
        encoder, total, docs_n = WordEncoder(tokenizer), 0, 0
        file = out = None
        for batch in batches:
            if out is None:
                file = store.open_output_stream(f"{path}/{draft}")
                out = ShardWriter(file.write, frame_ids)
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo, hi in slices(texts, 2 << 20):
                ids, begins = encoder.encode(texts.slice(lo, hi - lo))
                for k in range(hi - lo):
                    own = np.append(ids[begins[k] : begins[k + 1]], np.uint32(end_id))
                    out.add(keys[lo + k], own)
                    total += len(own)
                docs_n += hi - lo
        if out is not None:
            out.finish()
            file.close()
            store.move(f"{path}/{draft}", f"{path}/{name}")
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "name": [f"{folder}/{name}"], "n_docs": pa.array([docs_n], pa.int64()), "n_ids": pa.array([total], pa.int64())})

    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(tidy(task), "part long, name string, n_docs long, n_ids long").collect()  # one row for each shard
    manifest, start = [], 0
    for r in sorted(rows, key=lambda r: r["part"]):
        manifest.append({"name": r["name"], "start": start, "n_docs": r["n_docs"], "n_ids": r["n_ids"]})
        start += r["n_ids"]
    with store.open_output_stream(f"{path}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def read_shards(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    """One row for each document of the shards: doc_id, start, n_tokens, ids_crc32, in the files' order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = open_shard(name)
                n = shard.index[:, 4]
                crc = [zlib.crc32(shard.ids(i).tobytes()) for i in range(len(n))]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(shard.index[:, 0], mask=shard.index[:, 1] == 1), "start": pa.array(start + np.cumsum(n) - n, pa.int64()),
                    "n_tokens": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    files = spark.createDataFrame([(m["name"], m["start"]) for m in manifest], "name string, start long").repartition(max(1, len(manifest)))
    return files.mapInArrow(tidy(task), "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_to_shards(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None, shards: int | None = None) -> DataFrame:
    """Writes the documents as shards and reads them back."""
    folder = folder or f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    if not shards:
        size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    return read_shards(spark, write_shards(docs, tokenizer, folder, end_id, shards))

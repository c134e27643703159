"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is ``width`` consecutive words of an item, or all words of a shorter
item.  Its shingles (runs of three words, or fewer in windows of one or two
words) are ordered by how often documents hold them, counted over all documents.
A document that holds a window holds all its shingles, so the necessary prefix of
that order is one shingle, the rarest.  Documents are joined with the prefix
shingles; a match fixes where the window would begin, which must lie within the
document (length and positional bounds); then all words of the window are
compared, first as hashes, then as bytes.

Items are cut into pieces that overlap by all but one word of a window, and dealt into blocks of about
a bounded number of words.  Tasks write each block's windows, count its shingles in all documents and write its index, in the
shared folder; nothing of the items passes through the driver.  A task goes through the blocks one at a time, each read once for
many Arrow batches, so memory holds one block and a bounded number of bytes of documents, and nothing is shuffled but the pieces and the counts.

Nulls: null text has no words (n_hit 0, no items); an item with null item_id counts
as the id ''.  Equal items or equal document rows each count and stay; an item_id is
counted once for each document.  Empty tables give no rows, or no hits.
"""

from __future__ import annotations

import functools
import hashlib
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import saved, shared_folder, tidy
from tessera.llm.units import gather
from tessera.llm.words import Words, shingles, slices, split, within
from tessera.sources.shared import gathered

WIDTH = 10
SHINGLE = 3
#: Words of the items of a block, about: its index takes about 200 bytes for each; and of a piece of an item.
BLOCK_WORDS, PIECE_WORDS = 1_000_000, 20_000
_BITS = 22


class Sieve:
    """Finds which of many hashes are among a few: a bit table first, then a search."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.table = np.zeros(1 << _BITS, dtype=bool)
        self.table[(self.keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of those found, and which key each is."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.table[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
        key = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        ok = self.keys[key] == hashes[at]
        return at[ok], key[ok]


def item_windows(ids: list[str], texts: pa.Array, width: int = WIDTH) -> dict[str, np.ndarray]:
    """The windows of some items: item (a place in ids), width, word hashes (0 after the width); the joined words and the ids as bytes and their bounds."""
    words = split(texts)
    h, n = words.hashes(), np.diff(words.offsets)
    item, begin, size = [], [], []
    for t in np.flatnonzero(n):
        w = min(width, int(n[t]))
        starts = np.arange(words.offsets[t], words.offsets[t + 1] - w + 1)
        item.append(np.full(len(starts), t))
        begin.append(starts)
        size.append(np.full(len(starts), w))
    none = [np.zeros(0, np.int64)]
    item, begin, size = (np.concatenate(x or none) for x in (item, begin, size))
    cells = begin[:, None] + np.arange(width)
    inside = np.arange(width) < size[:, None]
    hashes = np.where(inside, h[np.minimum(cells, max(len(h) - 1, 0))] if len(h) else np.uint64(0), np.uint64(0))
    text = [b" ".join(words.word(i) for i in range(b, b + s)) for b, s in zip(begin.tolist(), size.tolist(), strict=True)]
    names = [i.encode() for i in ids]
    out = {"item": item, "size": size, "hashes": hashes}
    for name, parts in (("text", text), ("id", names)):
        out |= {f"{name}_bytes": np.frombuffer(b"".join(parts), dtype=np.uint8), f"{name}_at": np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)]).astype(np.int64)}
    return out


def window_shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The shingles of windows of one size, as (windows, places)."""
    w = min(SHINGLE, size)
    return np.stack([shingles_at(hashes, j, w) for j in range(size - w + 1)], axis=1)


def shingles_at(hashes: np.ndarray, j: int, w: int) -> np.ndarray:
    flat = np.ascontiguousarray(hashes[:, j : j + w]).ravel()
    return shingles(flat, w)[::w] if len(flat) else np.zeros(0, np.uint64)


def _read(uri: str) -> dict[str, np.ndarray]:
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as f, np.load(io.BytesIO(f.read())) as z:
        return {k: z[k] for k in z.files}


def _write(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Whole or absent: a task that runs again writes a draft and renames it."""
    from pyarrow import fs

    raw = io.BytesIO()
    np.savez(raw, **arrays)
    store, path = fs.FileSystem.from_uri(uri)
    draft = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as f:
        f.write(raw.getvalue())
    store.move(draft, path)


@functools.lru_cache(maxsize=1)
def load_block(uri: str) -> dict:
    block: dict = _read(uri)
    block["sieves"] = {w: Sieve(block["prefix"][block["kind"] == w]) for w in range(1, SHINGLE + 1)}
    for w, sieve in block["sieves"].items():
        own = np.flatnonzero(block["kind"] == w)
        order = own[np.argsort(block["prefix"][own], kind="stable")]
        block[f"order{w}"] = order
        block[f"begins{w}"] = np.append(np.searchsorted(block["prefix"][order], sieve.keys), len(order)) if len(sieve.keys) else np.zeros(1, np.int64)
    for name in ("text", "id"):
        raw, at = block[f"{name}_bytes"].tobytes(), block[f"{name}_at"].tolist()
        block[name] = [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    block["ids"] = np.array([i.decode() for i in block["id"]], dtype=object)
    return block


@functools.lru_cache(maxsize=1)
def load_sieves(uri: str) -> dict[int, Sieve]:
    """The shingles of a block's windows, by their words."""
    windows, found = _read(uri), {}
    for size in np.unique(windows["size"]):
        found.setdefault(min(SHINGLE, int(size)), []).append(window_shingles(windows["hashes"][windows["size"] == size], int(size)).ravel())
    return {w: Sieve(np.concatenate(x)) for w, x in found.items()}


def index_of(windows: dict[str, np.ndarray], shingle: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
    """The windows with the rarest shingle of each as its prefix, by how often documents hold the shingles (sorted; others never)."""
    n = len(windows["size"])
    prefix, offset, kind = np.zeros(n, np.uint64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for size in np.unique(windows["size"]):
        own = windows["size"] == size
        s = window_shingles(windows["hashes"][own], int(size))
        at = np.minimum(np.searchsorted(shingle, s), max(len(shingle) - 1, 0))
        often = np.where(shingle[at] == s, count[at], 0) if len(shingle) else np.zeros(s.shape, np.int64)
        place = np.lexsort((s, often), axis=1)[:, 0] if s.size else np.zeros(0, np.int64)
        prefix[own], offset[own], kind[own] = s[np.arange(len(s)), place], place, min(SHINGLE, size)
    return windows | {"prefix": prefix, "offset": offset, "kind": kind}


def candidates(words: Words, h: np.ndarray, block: dict) -> tuple[np.ndarray, np.ndarray]:
    """Window starts and windows that the prefix join, the bounds and the word hashes leave."""
    doc_begin = np.repeat(words.offsets[:-1], np.diff(words.offsets))
    doc_end = np.repeat(words.offsets[1:], np.diff(words.offsets))
    starts, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for w, sieve in block["sieves"].items():
        at, key = sieve.find(shingles(h, w))
        if not len(at):
            continue
        begins = block[f"begins{w}"]
        window, ends = gather(block[f"order{w}"], begins, key, np.arange(len(key) + 1))
        at = np.repeat(at, np.diff(ends))
        start = at - block["offset"][window]
        ok = (start >= doc_begin[at]) & (start + block["size"][window] <= doc_end[at])
        start, window = start[ok], window[ok]
        for j in range(block["hashes"].shape[1]):
            same = (block["size"][window] <= j) | (h[np.minimum(start + j, len(h) - 1)] == block["hashes"][window, j])
            start, window = start[same], window[same]
        starts.append(start)
        found.append(window)
    return np.concatenate(starts), np.concatenate(found)


def verified(words: Words, start: np.ndarray, window: np.ndarray, block: dict) -> np.ndarray:
    """True where the words are the same bytes."""
    out = np.zeros(len(start), dtype=bool)
    raw, a, b = words.raw.tobytes(), words.starts, words.ends
    for k, (s, w) in enumerate(zip(start.tolist(), window.tolist(), strict=True)):
        out[k] = b" ".join(raw[x:y] for x, y in zip(a[s : s + block["size"][w]].tolist(), b[s : s + block["size"][w]].tolist(), strict=True)) == block["text"][w]
    return out


def pieces_of(items: DataFrame, width: int = WIDTH, piece_words: int = PIECE_WORDS) -> DataFrame:
    """item_id, text (lower-cased) of the items in pieces of a bounded number of words; each window of an item is in one of them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                words = split(batch.column(1).slice(lo, hi - lo))
                ids, texts = [], []
                for t, item in enumerate(batch.column(0).slice(lo, hi - lo).to_pylist()):
                    a, b = int(words.offsets[t]), int(words.offsets[t + 1])
                    for at in range(a, max(a + 1, b - width + 1), piece_words) if a < b else ():
                        ids.append(item)
                        texts.append(words.raw[words.starts[at] : words.ends[min(at + piece_words + width - 1, b) - 1]].tobytes().decode())
                yield pa.RecordBatch.from_pydict({"item_id": pa.array(ids, pa.string()), "text": pa.array(texts, pa.string())})

    own = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    return own.mapInArrow(tidy(task), "item_id string, text string")


def count_shingles(batches: Iterator[pa.RecordBatch], uris: list[str]) -> Iterator[pa.RecordBatch]:
    """block, shingle, n of the texts in the first column; each block is read once for the batches that are gathered."""
    for held in gathered(batches, len(uris)):
        parts = [batch.column(0).slice(lo, hi - lo) for batch in held for lo, hi in slices(batch.column(0))]
        for k, uri in enumerate(uris):
            sieves = load_sieves(uri)
            totals = {w: np.zeros(len(s.keys), np.int64) for w, s in sieves.items()}
            for part in parts:
                words = split(part)
                h = words.hashes()
                for w, sieve in sieves.items():
                    totals[w] += np.bincount(sieve.find(shingles(h, w)[within(words.offsets, w)])[1], minlength=len(sieve.keys))
            for w, t in totals.items():
                if (some := np.flatnonzero(t)).size:
                    yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(some), k), pa.int32()), "shingle": pa.array(sieves[w].keys[some].view(np.int64)), "n": pa.array(t[some])})


def corpus_counts(docs: DataFrame, uris: list[str]) -> DataFrame:
    """block, shingle, n: how often all documents together hold each shingle of each block's windows; one pass over them."""
    task = tidy(functools.partial(count_shingles, uris=uris))
    return docs.select(F.col("text").cast("string")).mapInArrow(task, "block int, shingle long, n long").groupBy("block", "shingle").agg(F.sum("n").alias("n"))


def build_index(docs: DataFrame, items: DataFrame, width: int = WIDTH, block_words: int = BLOCK_WORDS, piece_words: int = PIECE_WORDS) -> list[str]:
    """Stores the blocks of items in the shared folder; their URIs."""
    from pyarrow import fs

    base = f"{shared_folder(docs.sparkSession)}/items-{uuid.uuid4().hex}"
    store, path = fs.FileSystem.from_uri(base)
    store.create_dir(path, recursive=True)
    pieces = saved(pieces_of(items, width, piece_words), "pieces")
    chars = pieces.agg(F.sum(F.length("text"))).first()[0] or 0
    if not chars:
        return []
    blocks = max(1, -(-chars // (5 * block_words)))
    keyed = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))

    def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
        """The rows of each block of a task, which come one block after another."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            at = batch.schema.get_field_index("block")
            b = batch.column(at).to_numpy()
            cuts = [0, *(np.flatnonzero(b[1:] != b[:-1]) + 1).tolist(), len(b)] if len(b) else []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if held and held[0].column(at)[0].as_py() != int(b[lo]):
                    yield held[0].column(at)[0].as_py(), pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield held[0].column(held[0].schema.get_field_index("block"))[0].as_py(), pa.Table.from_batches(held)

    def windows_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in by_block(batches):
            _write(f"{base}/windows-{block}.npz", item_windows(rows.column("item_id").to_pylist(), rows.column("text").combine_chunks(), width))
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32())})

    def index_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in by_block(batches):
            counted = rows.filter(pc.is_valid(rows.column("shingle")))
            shingle, n = counted.column("shingle").to_numpy().view(np.uint64), counted.column("n").to_numpy()
            order = np.argsort(shingle)
            _write(f"{base}/index-{block}.npz", index_of(_read(f"{base}/windows-{block}.npz"), shingle[order], n[order]))
            yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32())})

    dealt = lambda df: df.repartition(blocks, "block").sortWithinPartitions("block")
    made = saved(dealt(keyed).mapInArrow(tidy(windows_task), "block int"), "blocks")
    numbers = sorted(r["block"] for r in made.collect())  # one row for each block
    counts = corpus_counts(docs, [f"{base}/windows-{b}.npz" for b in numbers])
    named = counts.withColumn("block", F.element_at(F.array(*map(F.lit, numbers)), F.col("block") + 1))
    every = made.select("block", F.lit(None).cast("long").alias("shingle"), F.lit(None).cast("long").alias("n"))
    saved(dealt(named.unionByName(every)).mapInArrow(tidy(index_task), "block int"), "blocks")
    return [f"{base}/index-{b}.npz" for b in numbers]


#: The columns that find_contamination adds, and the one that it adds where asked for.
FOUND = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
SPANS = "hit_spans"


def find_windows(batches: Iterator[pa.RecordBatch], uris: list[str], at: int, spans: bool) -> Iterator[pa.RecordBatch]:
    """The batches with what their texts, in column ``at``, hold of the blocks' windows; each block is read once for the batches that are gathered."""
    for held in gathered(batches, len(uris)):
        parts = [batch.slice(lo, hi - lo) for batch in held for lo, hi in slices(batch.column(at))]
        edges: list[np.ndarray | None] = [None] * len(parts)
        pairs: list[set[tuple[int, str]]] = [set() for _ in parts]
        for uri in uris:
            block = load_block(uri)
            for n, part in enumerate(parts):
                words = split(part.column(at))
                start, window = candidates(words, words.hashes(), block)
                ok = verified(words, start, window, block)
                start, window = start[ok], window[ok]
                if len(start):
                    if edges[n] is None:
                        edges[n] = np.zeros(int(words.offsets[-1]) + 1, np.int32)
                    np.add.at(edges[n], start, 1)
                    np.add.at(edges[n], start + block["size"][window], -1)
                    pairs[n].update(zip(words.text_of()[start].tolist(), block["ids"][block["item"][window]].tolist(), strict=True))
        for part, edge, found in zip(parts, edges, pairs, strict=True):
            offsets = split(part.column(at)).offsets
            hit = np.zeros(int(offsets[-1]), bool) if edge is None else np.cumsum(edge[:-1]) > 0
            before = np.concatenate([[0], np.cumsum(hit)])
            n_hit = before[offsets[1:]] - before[offsets[:-1]]
            items: list[list[str]] = [[] for _ in range(part.num_rows)]
            for t, item in found:
                items[t].append(item)
            new = [pa.array(np.diff(offsets), pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]), pa.array(n_hit > 0)]
            if spans:
                new.append(pa.array([[{"start": int(a), "end": int(b)} for a, b in _runs(hit[offsets[t] : offsets[t + 1]])] for t in range(part.num_rows)], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))))
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *FOUND, *[SPANS] * spans])


def scan(docs: DataFrame, uris: list[str], spans: bool = False) -> DataFrame:
    """The columns of docs, then n_words, n_hit, n_items, items_sha256, contaminated, and where asked for the hit spans.

    A column of docs whose name clashes with one of these gives way.
    """
    own = FOUND + [SPANS] * spans
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in own])
    schema = ", ".join([kept.schema.toDDL(), "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"] + [f"{SPANS} array<struct<start:long,end:long>>"] * spans)
    return kept.mapInArrow(tidy(functools.partial(find_windows, uris=uris, at=kept.columns.index("text"), spans=spans)), schema)


def _runs(flags: np.ndarray) -> np.ndarray:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def find_contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, spans: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """docs (doc_id, text and more) with what items (item_id, text) they hold."""
    return scan(docs, build_index(docs, items, width, block_words), spans)


#: The same by joining every window with every item window, for small tables.
SQL = r"""
WITH words AS (SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
item_windows AS (SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') AS words
  FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (SELECT row_id, size, s, array_to_string(w[s : s + size - 1], ' ') AS words FROM words, sizes, unnest(range(1, len(w) - size + 2)) AS t(s)),
hits AS (SELECT row_id, s, d.size, item_id FROM doc_windows d JOIN item_windows USING (size, words)),
covered AS (SELECT row_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(s, s + size)) AS t(p) GROUP BY row_id),
found AS (SELECT row_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT row_id, item_id FROM hits) GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (row_id) LEFT JOIN found USING (row_id)
"""

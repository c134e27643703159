"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is normalised as the vocabulary asks (one space mark in front, spaces
become marks) and cut before each run of marks: no piece holds a mark behind
another character, so no merge crosses a cut and the cuts can be encoded alone,
each distinct one once per Arrow batch.  A cut starts as single characters; all
adjacent pairs that form a piece stand in an agenda ordered by score, then from
the left; the best is merged and its new neighbours are entered, until none is
left; short cuts of a batch are merged side by side, each by its own agenda.  What is no piece falls back to bytes.  Every cut that a worker meets for
the first time is checked against the sentencepiece library, as is the first
whole text of each Arrow batch; a difference ends the job.

Nulls: a null text is the empty text, whose ids are the end id alone.  A null
doc_id is kept.  Repeated rows give repeated results, an empty table none.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tessera.llm.shared import tidy
from tessera.llm.units import LETTERS, UnitIds, gather, stops_apart
from tessera.llm.words import slices

MARK = "▁"
#: Cuts of up to so many characters are merged side by side, and so many of them at a time.
SIDE_BY_SIDE, SIDES = 48, 4096
NONE = np.iinfo(np.int32).max
#: Characters of which one that no text of a slice holds marks the cuts; where all are held, texts are cut one by one.
GAPS = (0xE000, 0xF900)


class PairTable:
    """The piece that two symbols make, for many pairs at once: two tables of slots, the second for what collides in the first."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.tables = []
        for bits, factor in ((20, 0x9E3779B97F4A7C15), (17, 0xD6E8FEB86659FD93), (14, 0xA0761D6478BD642F)):
            slot = ((keys.astype(np.uint64) * np.uint64(factor)) >> np.uint64(64 - bits)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            held, made = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
            held[slot[first]], made[slot[first]] = keys[first], values[first]
            self.tables.append((np.uint64(factor), np.uint64(64 - bits), held, made))
            rest = np.setdiff1d(np.arange(len(keys)), first)
            keys, values = keys[rest], values[rest]
        if len(keys):
            raise ValueError("the pairs don't fit their tables")

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 20) | b
        out = np.full(key.shape, -1, np.int32)
        for factor, shift, held, made in self.tables:
            slot = ((key.astype(np.uint64) * factor) >> shift).astype(np.int64)
            hit = held[slot] == key
            out[hit] = made[slot[hit]]
        out[(a < 0) | (b < 0)] = -1
        return out


class MergeVocabulary:
    """A merge-type model file: pieces, their scores and bytes to fall back to."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end_id = lib.eos_id()
        pieces = [(i, lib.id_to_piece(i)) for i in range(lib.get_piece_size())]
        self.ids = {p: i for i, p in pieces if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))}
        self.cost = {p: -lib.get_score(i) for p, i in self.ids.items()}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(MARK in p.lstrip(MARK) for p in self.ids) or any(re.search(r"[A-Za-zÀ-ÖØ-öø-ÿ][.,]", p) for p in self.ids):
            raise ValueError("a piece of this vocabulary spans words, or a word and its stop")
        pairs = [(a, b, i) for p, i in self.ids.items() for k in range(1, len(p)) if (a := self.ids.get(p[:k])) is not None and (b := self.ids.get(p[k:])) is not None]
        left, right, made = np.array(pairs, dtype=np.int64).reshape(-1, 3).T
        self.pairs = PairTable((left << 20) | right, made.astype(np.int32))
        self.rank = np.full(lib.get_piece_size() + 1, NONE, np.int32)  # the last is for no piece
        scores = {s: k for k, s in enumerate(sorted(set(self.cost.values())))}
        for p, i in self.ids.items():
            self.rank[i] = scores[self.cost[p]]
        self.char = {p: i for p, i in self.ids.items() if len(p) == 1}

    def merge(self, cut: str) -> list[int]:
        """The ids of one cut."""
        cost, parts = self.cost, list(cut)
        n = len(parts)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(cost[pair], i, len(pair)) for i in range(n - 1) if (pair := parts[i] + parts[i + 1]) in cost]
        heapify(agenda)
        while agenda:
            _, i, size = heappop(agenda)
            j = right[i]
            if j >= n or not parts[i] or len(parts[i]) + len(parts[j]) != size:
                continue  # one of the two has been merged since
            parts[i] += parts[j]
            parts[j] = ""
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (pair := parts[i] + parts[k]) in cost:
                    heappush(agenda, (cost[pair], i, len(pair)))
            if (h := left[i]) >= 0 and (pair := parts[h] + parts[i]) in cost:
                heappush(agenda, (cost[pair], h, len(pair)))
        out: list[int] = []
        for p in parts:
            if p:
                if (i := self.ids.get(p)) is not None:
                    out.append(i)
                else:
                    out += [self.bytes[b] for b in p.encode()]
        return out


    def merge_side_by_side(self, cuts: list[str]) -> list[list[int]]:
        """merge() for many short cuts: each round takes the first entry of every cut's agenda."""
        width = max(map(len, cuts))
        grid = np.full((len(cuts), width), -1, np.int64)
        codes = np.frombuffer("".join(cuts).encode("utf-32-le"), dtype=np.uint32)
        lengths = np.fromiter(map(len, cuts), dtype=np.int64, count=len(cuts))
        chars, at = np.unique(codes, return_inverse=True)
        grid[np.arange(width) < lengths[:, None]] = np.array([self.char.get(chr(c), -2 - int(c)) for c in chars], dtype=np.int64)[at]
        final, where = grid.copy(), np.arange(len(cuts))
        if width > 1:
            cost = self.rank[self.pairs.of(grid[:, :-1], grid[:, 1:])]
            while len(grid):
                best = cost.argmin(axis=1)
                rows = np.arange(len(grid))
                going = cost[rows, best] < NONE
                if not going.all():
                    final[where[~going]] = grid[~going]
                    grid, cost, where, best = grid[going], cost[going], where[going], best[going]
                    rows = np.arange(len(grid))
                    if not len(grid):
                        break
                made = self.pairs.of(grid[rows, best], grid[rows, best + 1])
                shift = np.minimum(np.arange(width) + (np.arange(width) > best[:, None]), width - 1)
                grid = np.take_along_axis(grid, shift, axis=1)
                grid[:, -1] = -1
                grid[rows, best] = made
                cost = np.take_along_axis(cost, np.minimum(shift[:, :-1], width - 2), axis=1)
                cost[:, -1] = NONE
                after = np.minimum(best + 1, width - 1)
                ok = best < width - 1
                cost[rows[ok], best[ok]] = self.rank[self.pairs.of(grid[rows, best], grid[rows, after])][ok]
                ok = best > 0
                cost[rows[ok], best[ok] - 1] = self.rank[self.pairs.of(grid[rows[ok], best[ok] - 1], grid[rows[ok], best[ok]])]
        kept = final != -1
        flat, ends = final[kept], np.concatenate([[0], np.cumsum(kept.sum(axis=1))])
        if (flat < 0).any():
            return [[y for x in flat[a:b].tolist() for y in ([x] if x >= 0 else [self.bytes[c] for c in chr(-2 - x).encode()])] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        flat = flat.tolist()
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def merge_all(self, cuts: list[str]) -> list[list[int]]:
        out: list = [None] * len(cuts)
        by_width: dict[int, list[int]] = {}
        for k, c in enumerate(cuts):
            by_width.setdefault(4 * -(-len(c) // 4) if len(c) <= SIDE_BY_SIDE else 0, []).append(k)
        for width, own in by_width.items():
            for lo in range(0, len(own), SIDES):
                part = own[lo : lo + SIDES]
                for k, ids in zip(part, self.merge_side_by_side([cuts[k] for k in part]) if width else map(self.merge, [cuts[k] for k in part]), strict=True):
                    out[k] = ids
        return out


@functools.lru_cache(maxsize=1)
def vocabulary_of(path: str) -> MergeVocabulary:
    """The vocabulary of a file, read once by a worker (about 25 MB)."""
    return MergeVocabulary(path)


class PieceEncoder:
    """Encodes Arrow batches of texts with one vocabulary."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary_of(path)
        self.units = UnitIds(self._checked)
        self.before = self.vocabulary.merge(MARK + "a")

    def _checked(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cuts = units.to_pylist()
        own = self.vocabulary.merge_all(cuts)
        theirs = self.vocabulary.library.encode([c[1:] if c[:1] == MARK else c and f"a{c}" for c in cuts], num_threads=1)
        for c, a, b in zip(cuts, own, theirs, strict=True):
            if (a if c[:1] == MARK or not c else self.before + a) != b and c != MARK:  # a mark alone ends a text; the library has no text for it by itself
                raise ValueError(f"the library encodes {c!r} as {b}, not {a}")
        lengths = np.fromiter(map(len, own), dtype=np.int64, count=len(own))
        return np.fromiter((i for x in own for i in x), dtype=np.int32, count=int(lengths.sum())), np.concatenate([[0], np.cumsum(lengths)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids without end ids, one text after another, and where each text begins."""
        texts = texts.cast(pa.large_string()).fill_null("")
        gap = next((c for c in map(chr, range(*GAPS)) if not pc.any(pc.match_substring(texts, c)).as_py()), None)
        marked = pc.replace_substring(pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))), " ", MARK)
        if gap is None:
            parts = pa.array([re.split(f"(?<=[^{MARK}])(?={MARK})", t) for t in marked.to_pylist()], pa.large_list(pa.large_string()))
        else:
            runs = pc.match_substring(marked, MARK * 2)
            cut = pc.if_else(runs, pc.replace_substring_regex(pc.if_else(runs, marked, ""), f"([^{MARK}]){MARK}", f"\\1{gap}{MARK}"), pc.replace_substring(marked, MARK, gap + MARK))
            parts = pc.split_pattern(cut, gap)
        coded = pc.dictionary_encode(parts.flatten())
        flat, begins = stops_apart(coded.dictionary, f"^{MARK}[{LETTERS}]+$", False, self.units)
        where = parts.offsets.to_numpy()
        return gather(flat, begins, coded.indices.to_numpy(zero_copy_only=False), where - where[0])


def encode_documents(docs: DataFrame, model: str, keep_ids: bool = False, keep_text: bool = False) -> DataFrame:
    """doc_id, n_tokens (with the end id), ids_sha256, decoded_sha256; ids and the decoded text where asked for."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids + ", decoded string" * keep_text

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(model)
        lib, end = encoder.vocabulary.library, encoder.vocabulary.end_id
        decimal = [str(i) for i in range(lib.get_piece_size())].__getitem__
        for batch in batches:
            first = True
            for lo, hi in slices(batch.column(1), 2 << 20):
                texts = batch.column(1).slice(lo, hi - lo)
                rows: dict[str, list] = {"n": [], "ids": [], "dec": [], "all": [], "text": []}
                flat, begins = encoder.encode(texts)
                for k in range(hi - lo):
                    ids = flat[begins[k] : begins[k + 1]].tolist()
                    if first and ids != lib.encode(texts[k].as_py() or ""):
                        raise ValueError("the library encodes a text in another way")
                    first = False
                    ids.append(end)
                    decoded = lib.decode(ids)
                    rows["n"].append(len(ids))
                    rows["ids"].append(hashlib.sha256(" ".join(map(decimal, ids)).encode()).hexdigest())
                    rows["dec"].append(hashlib.sha256(decoded.encode()).hexdigest())
                    if keep_ids:
                        rows["all"].append(ids)
                    if keep_text:
                        rows["text"].append(decoded)
                out = [batch.column(0).slice(lo, hi - lo), pa.array(rows["n"], pa.int64()), pa.array(rows["ids"]), pa.array(rows["dec"])]
                out += [pa.array(rows["all"], pa.list_(pa.int32()))] * keep_ids + [pa.array(rows["text"])] * keep_text
                yield pa.RecordBatch.from_arrays(out, names=[c.split()[0] for c in schema.split(", ")])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(tidy(task), schema)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and the text of an ids column (null ids: the empty text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = vocabulary_of(model).library
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([lib.decode(x) if x else "" for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return encoded.select(encoded["doc_id"].cast("long").alias("doc_id"), "ids").mapInArrow(tidy(task), "doc_id long, text string")

"""Encoding each distinct unit of a batch once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units whose ids a worker keeps; others are encoded again when they come.
CACHED_UNITS = 200_000
#: Latin letters in the library's regular expressions.
LETTERS = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}"


def gather(flat: np.ndarray, begins: np.ndarray, codes: np.ndarray, text_offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenates flat[begins[c]:begins[c+1]] over the codes; where each text begins in the result."""
    lengths = np.diff(begins)[codes] if len(codes) else np.zeros(0, np.int64)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    at = np.repeat(begins[:-1][codes] - ends[:-1], lengths) + np.arange(ends[-1]) if len(codes) else np.zeros(0, np.int64)
    return flat[at.astype(np.int64)], ends[text_offsets]


class UnitIds:
    """Ids of distinct units: kept ones are looked up, ``encode`` makes the others."""

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.known = pa.array([], pa.large_string())
        self.flat, self.begins = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def of(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of each unit, one after another, and where each begins."""
        at = pc.index_in(units, value_set=self.known)
        fresh = units.filter(pc.is_null(at))
        ids, begins = self.encode(fresh)
        new = pc.is_null(at).to_numpy(zero_copy_only=False)
        codes = np.where(new, len(self.known) + np.cumsum(new) - 1, at.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
        all_begins = np.concatenate([self.begins, len(self.flat) + begins[1:]])
        out = gather(np.concatenate([self.flat, ids]), all_begins, codes, np.arange(len(units) + 1))
        if room := min(len(fresh), CACHED_UNITS - len(self.known)):
            self.known = pa.concat_arrays([self.known, fresh.slice(0, room)])
            self.flat = np.concatenate([self.flat, ids[: begins[room]]])
            self.begins = all_begins[: len(self.known) + 1]
        return out


def stops_apart(words: pa.Array, plain: str, lower: bool, ids: UnitIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words where full stops and commas behind a word that matches ``plain`` are units of their own."""
    bare = pc.ascii_rtrim(words, ".,")
    is_plain = pc.match_substring_regex(bare, plain)
    stops = pc.and_(is_plain, pc.not_equal(pc.binary_length(words), pc.binary_length(bare)))
    ends = pc.replace_substring_regex(words.filter(stops), r"^[^.,]*", "")
    units = pc.dictionary_encode(pa.concat_arrays([pc.if_else(is_plain, pc.ascii_lower(bare) if lower else bare, words), ends]))
    flat, begins = ids.of(units.dictionary)
    codes, n = units.indices.to_numpy(zero_copy_only=False), len(words)
    pairs = np.full((n, 2), len(begins) - 1, dtype=np.int64)  # the last unit is empty
    pairs[:, 0] = codes[:n]
    pairs[stops.to_numpy(zero_copy_only=False), 1] = codes[n:]
    return gather(flat, np.append(begins, begins[-1]), pairs.ravel(), np.arange(n + 1) * 2)

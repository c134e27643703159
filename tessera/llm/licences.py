"""Licence scans by the Dice coefficient over word bigrams.

Templates are sentences that name a licence, file headers and licence texts
(``licence_texts``).  A text's units are the whole text, its blocks (parted by empty lines), its lines, its
sentences (parted by a line feed, or by . ! ? or ; before white space), and its sentences over line feeds (parted by
an empty line instead, as notices are wrapped).  Words are lower-cased and "licence" is spelt "license"; what marks comments has no words.  A unit is
compared with a template as multisets of pairs of neighbouring words:
dice = 2 x common / (pairs of the unit + pairs of the template).  For a dice of t, the
template's size must lie within t/(2-t) and (2-t)/t of the unit's, so other templates
are left out before any pair is counted; of the rest, only those that share a pair
with the unit are.  A unit must hold each word of the template that has a digit: a version never stands for another.
A unit counts for the template that is most like it, at LEAST or more.

Nulls: a null text has no units and matches nothing, as a unit of fewer than two words.
Ties go to the licence that sorts first.  Repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.decontam import Sieve
from tessera.llm.shared import tidy
from tessera.llm.units import gather
from tessera.llm.licence_texts import TEMPLATES
from tessera.llm.words import Words, shingles, slices, split

LEAST = 0.8
#: Other spellings.
SPELLINGS = {"licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing", "sublicence": "sublicense"}
#: Pairs of units and templates that are looked at at once.
AT_ONCE = 1 << 18


def spelt(words: Words) -> np.ndarray:
    """The hashes of the words, other spellings as the usual ones."""
    h = words.hashes()
    for other, usual in SPELLINGS.items():
        a, b = split(pa.array([other, usual])).hashes()
        h[h == a] = b
    return h


class Templates:
    def __init__(self, templates: list[tuple[str, str]]):
        self.names = [n for n, _ in templates]
        words = split(pa.array([t for _, t in templates], pa.string()))
        h, self.sizes = spelt(words), np.maximum(np.diff(words.offsets) - 1, 0)
        numbered = np.array([any(48 <= c < 58 for c in words.word(i)) for i in range(len(h))], bool)
        self.versions = [np.unique(h[a:b][numbered[a:b]]) for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)]
        keys, owners, counts = [], [], []
        for t in range(len(templates)):
            k, c = np.unique(shingles(h[words.offsets[t] : words.offsets[t + 1]], 2), return_counts=True)
            keys.append(k)
            owners.append(np.full(len(k), t))
            counts.append(c)
        keys, owners, counts = map(np.concatenate, (keys, owners, counts))
        order = np.argsort(keys, kind="stable")
        self.sieve, self.owners, self.counts = Sieve(keys), owners[order], counts[order]
        self.begins = np.append(np.searchsorted(keys[order], self.sieve.keys), len(keys))
        self.rank = np.argsort(np.argsort(np.array(self.names), kind="stable"), kind="stable")


def best_templates(unit: np.ndarray, h: np.ndarray, pairs: np.ndarray, templates: Templates, least: float) -> Iterator[tuple[int, int, float]]:
    """Units that match, with their template and its dice; unit: of each word (in order), h: its hash, pairs: hashes at each word but the last."""
    inside = unit[:-1] == unit[1:]
    of, pairs = unit[:-1][inside], pairs[inside]
    size = np.bincount(of, minlength=1)
    at, key = templates.sieve.find(pairs)
    if not len(at):
        return
    k = len(templates.sieve.keys)
    both, n = np.unique(of[at] * k + key, return_counts=True)
    u, key = both // k, both % k
    # whole units at a time, of which all templates of their pairs fit in memory
    ends = np.cumsum(np.diff(templates.begins)[key])
    edges = np.flatnonzero(np.concatenate([u[1:] != u[:-1], [True]])) + 1
    cuts = [0]
    for e in edges.tolist():
        if ends[e - 1] - (ends[cuts[-1] - 1] if cuts[-1] else 0) > AT_ONCE or e == len(u):
            cuts.append(e)
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        for mine, t, dice in _matches(u[lo:hi], key[lo:hi], n[lo:hi], size, templates, least):
            held = h[np.searchsorted(unit, mine) : np.searchsorted(unit, mine, side="right")]
            for one, share in zip(t, dice, strict=True):
                if np.isin(templates.versions[one], held).all():
                    yield mine, one, share
                    break


def _matches(u: np.ndarray, key: np.ndarray, n: np.ndarray, size: np.ndarray, templates: Templates, least: float) -> Iterator[tuple[int, list[int], list[float]]]:
    """For each unit that any template is like: the templates and their dice, the best first."""
    which, ends = gather(np.arange(len(templates.owners)), templates.begins, key, np.arange(len(key) + 1))
    rep = np.repeat(np.arange(len(key)), np.diff(ends))
    u, n, t = u[rep], n[rep], templates.owners[which]
    fits = (templates.sizes[t] * (2 - least) >= size[u] * least - 1e-9) & (templates.sizes[t] * least <= size[u] * (2 - least) + 1e-9)
    u, n, t, which = u[fits], n[fits], t[fits], which[fits]
    cell, back = np.unique(u * len(templates.names) + t, return_inverse=True)
    common = np.bincount(back, weights=np.minimum(n, templates.counts[which]), minlength=len(cell))
    u, t = cell // len(templates.names), cell % len(templates.names)
    dice = 2 * common / (size[u] + templates.sizes[t])
    ok = dice >= least - 1e-12
    u, t, dice = u[ok], t[ok], dice[ok]
    order = np.lexsort((templates.rank[t], -dice, u))
    u, t, dice = u[order], t[order], dice[order]
    edges = np.concatenate([[0], np.flatnonzero(u[1:] != u[:-1]) + 1, [len(u)]]) if len(u) else np.zeros(1, np.int64)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield int(u[a]), t[a:b].tolist(), dice[a:b].tolist()


def scan_texts(texts: pa.Array, templates: Templates, least: float = LEAST) -> list[dict[str, float]]:
    """For each text, the licences found and the largest dice of each."""
    words = split(texts)
    out: list[dict[str, float]] = [{} for _ in range(len(texts))]
    if len(words.starts) < 2:
        return out
    h, of, raw = spelt(words), words.text_of(), words.raw
    pairs = shingles(h, 2)
    feed = raw == 10
    space = feed | (raw == 32) | (raw == 9) | (raw == 13)
    stop = np.zeros(len(raw), bool)
    stop[:-1] = np.isin(raw[:-1], np.frombuffer(b".!?;", np.uint8)) & space[1:]
    empty_line = np.zeros(len(raw), bool)
    empty_line[:-1] = feed[:-1] & feed[1:]
    for cut in (None, empty_line, feed, feed | stop, empty_line | stop):
        unit = of if cut is None else of + np.cumsum(cut)[words.starts]
        _, unit = np.unique(unit, return_inverse=True)
        text = np.zeros(int(unit.max()) + 1, np.int64)
        text[unit] = of
        for u, t, dice in best_templates(unit, h, pairs, templates, least):
            found, name = out[text[u]], templates.names[t]
            found[name] = max(found.get(name, 0.0), float(dice))
    return out


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """doc_id, licences (a map of licence and dice), n_licences, licence and dice of the best (null and 0 if none)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Templates(templates)
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                found = scan_texts(batch.column(1).slice(lo, hi - lo), own, least)
                best = [min(((-d, n) for n, d in f.items()), default=(0.0, None)) for f in found]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).slice(lo, hi - lo), "licences": pa.array([sorted(f.items()) for f in found], pa.map_(pa.string(), pa.float64())),
                    "n_licences": pa.array([len(f) for f in found], pa.int32()), "licence": pa.array([b[1] for b in best], pa.string()), "dice": pa.array([-b[0] + 0.0 for b in best], pa.float64())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(tidy(task), "doc_id long, licences map<string,double>, n_licences int, licence string, dice double")


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_WORDS = r"list_transform(regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: CASE x " + " ".join(f"WHEN {_quoted(a)} THEN {_quoted(b)}" for a, b in SPELLINGS.items()) + " ELSE x END)"
#: The same by joining all pairs of words.
SQL = rf"""
WITH templates AS (SELECT t, name, w, list_distinct(list_filter(w, lambda x: regexp_matches(x, '[0-9]'))) AS versions FROM (SELECT row_number() OVER () AS t, name, {_WORDS.format("notice")} AS w FROM (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in TEMPLATES)}) AS v(name, notice))),
texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
units AS (SELECT row_id, 0 AS kind, unnest([text]) AS unit FROM texts
  UNION ALL SELECT row_id, 1, unnest(string_split(text, chr(10) || chr(10))) FROM texts
  UNION ALL SELECT row_id, 2, unnest(string_split(text, chr(10))) FROM texts
  UNION ALL SELECT row_id, 3, unnest(string_split_regex(text, '[.!?;][ \t\r\n]|\n')) FROM texts
  UNION ALL SELECT row_id, 4, unnest(string_split_regex(text, '[.!?;][ \t\r\n]|\n\n')) FROM texts),
unit_words AS (SELECT row_number() OVER () AS u, row_id, {_WORDS.format("unit")} AS w FROM units),
template_pairs AS (SELECT t, len(w) - 1 AS size, w[i] || ' ' || w[i + 1] AS pair, count(*) AS n FROM templates, unnest(range(1, len(w))) AS x(i) GROUP BY t, size, pair),
unit_pairs AS (SELECT u, size, pair, count(*) AS n FROM (SELECT u, len(w) - 1 AS size, w[i] || ' ' || w[i + 1] AS pair FROM unit_words, unnest(range(1, len(w))) AS x(i)) WHERE pair IN (SELECT pair FROM template_pairs) GROUP BY u, size, pair),
common AS (SELECT u, t, sum(least(a.n, b.n)) AS n, any_value(a.size + b.size) AS sizes FROM unit_pairs a JOIN template_pairs b ON a.pair = b.pair AND b.size * 1.2 >= a.size * 0.8 AND b.size * 0.8 <= a.size * 1.2 GROUP BY u, t),
near AS (SELECT u, t, 2.0::DOUBLE * n / sizes AS dice FROM common WHERE 2.0::DOUBLE * n / sizes >= {LEAST}),
scored AS (SELECT u, row_id, name, dice FROM near JOIN unit_words USING (u) JOIN templates USING (t) WHERE len(versions) = 0 OR list_has_all(unit_words.w, versions)),
matched AS (SELECT row_id, arg_min(name, (-dice, name)) AS name, max(dice) AS dice FROM scored GROUP BY u, row_id),
found AS (SELECT row_id, string_agg(DISTINCT name, ',' ORDER BY name) AS licences, CAST(count(DISTINCT name) AS INTEGER) AS n_licences, arg_min(name, (-dice, name)) AS licence, max(dice) AS dice FROM matched GROUP BY row_id)
SELECT doc_id, coalesce(licences, '') AS licences, coalesce(n_licences, 0) AS n_licences, licence, round(coalesce(dice, 0), 6) AS dice FROM texts LEFT JOIN found USING (row_id)
"""

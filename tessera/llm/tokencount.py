"""Token counts of texts, kept in a cache by digests of the content and of the tokenizer.

The cache is a table in a shared folder: for each version of a tokenizer (a digest of its file, its library and what it is asked for) the digests of contents and
their counts.  A call writes the digests of its documents, finds those without a stored count, encodes one text for each of these and appends the counts; then every
document takes its count from the cache by its digest.  Documents that are met again, in the same corpus or a later one, are hashed only.

The content is the text as the tokenizer's own normaliser leaves it, so that texts which differ only there share a count; a text that holds a special token's string before
or after it is its own content.  Texts are deduplicated before their shuffle (a hot text is one row for each task), the digest join is left to Spark's skew handling, and nothing
is collected.  Each call appends under a folder of its own, which appears whole or not at all: calls may run at the same time or be stopped; the same digest stored twice
has the same count twice.

A null text counts as an empty one; rows with null or repeated ids are counted row by row; columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import saved, shared_folder, tidy
from tessera.llm.words import slices

#: Texts of more tokens are over the limit.
LIMIT = 512
#: Units whose counts a worker keeps; others are encoded again when they come.
CACHED_UNITS = 200_000
SCHEMA = "digest binary, n_tokens long"


def _settings(path: str) -> dict:
    return json.loads(Path(path).read_text()) if path.endswith(".json") else {}


def version(path: str) -> str:
    """The digest of what decides a count: the tokenizer's file, its library with its version, and how it is asked."""
    import sentencepiece
    import tokenizers

    library = f"tokenizers {tokenizers.__version__}" if path.endswith(".json") else f"sentencepiece {sentencepiece.__version__}"
    return hashlib.sha256(f"{library}; no special tokens, no truncation\n".encode() + Path(path).read_bytes()).hexdigest()


class Counter:
    """Counts of whole texts as the library gives them.

    Where a tokenizer cuts texts by the pattern of byte-level BPE, without a normaliser, a blank before anything that isn't white space begins a part of its own in any text.
    So the units between such blanks are counted once each and added up; a special token's string is one token and ends what stands before it.  Other tokenizers get
    the whole text.
    """

    CUT = re.compile(r" (?=\S)")

    def __init__(self, path: str):
        if not path.endswith(".json"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda texts: [len(ids) for ids in self.pieces.encode(texts, add_bos=False, add_eos=False)]
            self.special, self.by_units = [], False
            return
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.whole = lambda texts: [len(e) for i in range(0, len(texts), 256) for e in self.library.encode_batch_fast(texts[i : i + 256], add_special_tokens=False)]
        told = _settings(path)
        added, first = told.get("added_tokens") or [], told.get("pre_tokenizer") or {}
        plain = all(not (a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]) for a in added) and not any(" " in a["content"] for a in added)
        self.by_units = plain and not told.get("normalizer") and not told.get("post_processor") and first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space", True)
        special = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.known: dict[tuple[bool, str] | str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        if not self.by_units:
            return self.whole(texts)
        runs, extra, of = [], [0] * len(texts), []
        for t, text in enumerate(texts):
            parts = self.special.split(text) if self.special and self.special.search(text) else [text]
            extra[t] = len(parts) - 1
            runs.extend(self.CUT.split(p) for p in parts)
            of.extend([t] * len(parts))
        # the first unit of a run has no blank before it, so it is a key of its own kind
        heads = [(True, r[0]) for r in runs]
        wanted = set().union(*(r[1:] for r in runs), heads) if runs else set()
        fresh = [u for u in wanted if u not in self.known]
        counted = dict(zip(fresh, self.whole([u[1] if isinstance(u, tuple) else f" {u}" for u in fresh]), strict=True))
        room = CACHED_UNITS - len(self.known)
        if room >= len(fresh):
            self.known.update(counted)
            look = self.known
        else:
            look = {u: self.known[u] if u in self.known else counted[u] for u in wanted}
            self.known.update((u, counted[u]) for u in fresh[: max(room, 0)])
        out = extra
        for t, head, run in zip(of, heads, runs, strict=True):
            out[t] += look[head] + sum(map(look.__getitem__, run[1:]))
        return out


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def content(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text (null: empty), n_bytes, digest of the normalised text."""
    own = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    if not _settings(path).get("normalizer"):
        return own.withColumn("digest", F.unhex(F.sha2("text", 256)))
    specials = [a["content"] for a in _settings(path).get("added_tokens") or []]

    @F.arrow_udf("binary")
    def digest(texts: pa.Array) -> pa.Array:
        normaliser = counter(path).library.normalizer
        out = []
        for text in texts.to_pylist():
            plain = normaliser.normalize_str(text)
            special = any(s in text or s in plain for s in specials)
            out.append(hashlib.sha256(b"s" + text.encode() if special else b"n" + plain.encode()).digest())
        return pa.array(out, pa.binary())

    return own.withColumn("digest", digest("text"))


def stored(docs: DataFrame, table: str) -> DataFrame:
    """digest, n_tokens of the cache; none where there is no cache yet."""
    spark = docs.sparkSession
    try:
        return spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(table)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def count(docs: DataFrame, path: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of docs (doc_id, text).  cache: a folder that the driver and all executors reach; else one in the shared folder."""
    table = f"{cache or shared_folder(docs.sparkSession) + '/token-counts'}/{version(path)}"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1), 4 << 20):
                n = counter(path).counts(batch.column(1).slice(lo, hi - lo).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64())], names=["digest", "n_tokens"])

    told = content(docs, path)
    keys = saved(told.select("doc_id", "n_bytes", "digest"), "digests")
    distinct = keys.select("digest").distinct()
    missing = saved(distinct.join(stored(docs, table), "digest", "left_anti"), "missing")
    if missing.limit(1).count():
        texts = told.groupBy("digest").agg(F.any_value("text").alias("text")).join(missing, "digest", "left_semi")
        texts.mapInArrow(tidy(task), SCHEMA).write.parquet(f"{table}/batch-{uuid.uuid4().hex}")
    # one row for each digest of these documents, written, so that the join below reads it as it is and can be split where a digest is hot
    counts = saved(stored(docs, table).join(distinct, "digest", "left_semi").groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")), "counts")
    return keys.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

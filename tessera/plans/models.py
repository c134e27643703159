"""Stand-ins for external models, deterministic and built in; real ones take their place as functions of the same shape."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.search import tokens

DIMENSIONS = 64


def embed(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """A unit vector of hashed token counts; null for a text without tokens."""

    def vectors(slots: pa.Array) -> pa.Array:
        counts = np.zeros((len(slots), dimensions))
        for at in range(0, len(slots), 256):
            part = slots.slice(at, 256)
            row = np.repeat(np.arange(len(part)), pc.list_value_length(part).to_numpy(zero_copy_only=False))
            counts[at : at + 256] = np.bincount(row * dimensions + part.flatten().to_numpy(zero_copy_only=False), minlength=len(part) * dimensions).reshape(-1, dimensions)
        norms = np.sqrt((counts * counts).sum(axis=1))
        units = counts / np.where(norms > 0, norms, 1.0)[:, None]
        return pc.if_else(pa.array(norms > 0), pa.FixedSizeListArray.from_arrays(pa.array(units.ravel()), dimensions).cast(pa.list_(pa.float64())), None)

    vectors.__annotations__ = {"slots": pa.Array, "return": pa.Array}  # as types, which a nested function's strings don't give
    return F.arrow_udf(vectors, "array<double>")(F.transform(tokens(text), lambda t: F.pmod(F.xxhash64(t), F.lit(dimensions)).cast("int")))


def synthetic_plan(questions: DataFrame) -> DataFrame:
    """The plan of a question (query_id, question) without a planner: the whole of itself, over the document labels."""
    labels = F.array(*map(F.lit, ("Section", "CodeBlock", "TableRow", "Callout")))
    return questions.select("query_id", F.col("question").alias("text"), labels.alias("target_labels"), F.array().cast("array<string>").alias("keywords"), embed(F.col("question")).alias("vector"))


def extractive_answer(evidence: DataFrame) -> DataFrame:
    """query_id, answer: the snippet of the first citation, marked [1]; evidence: query_id, rank, snippet."""
    first = evidence.groupBy("query_id").agg(F.min_by("snippet", "rank").alias("snippet"))
    return first.select("query_id", F.concat(F.col("snippet"), F.lit(" [1]")).alias("answer"))


def overlap_judge(payloads: list[str]) -> list[str]:
    """Metrics of answers by the words that they share with contexts, reference and question."""
    out = []
    for payload in map(json.loads, payloads):
        answer, reference, question = ({*(payload[k] or "").lower().split()} for k in ("answer", "reference", "question"))
        contexts = [{*c.lower().split()} for c in payload["contexts"]]
        held = set().union(*contexts)
        share = lambda a, b: len(a & b) / len(a) if a else 0.0
        both = share(answer, reference) * share(reference, answer)
        out.append(json.dumps({"faithfulness": share(answer, held), "context_precision": sum(share(reference, c) > 0.5 for c in contexts) / len(contexts), "context_recall": share(reference, held), "answer_relevancy": share(question, answer), "factual_correctness": share(answer, reference), "semantic_similarity": both**0.5}))
    return out

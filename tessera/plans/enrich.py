"""Contextual enrichment: route each node, give it a context, build its indexed text and embed it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import contexts as cx
from tessera.plans import models


def extractive_context(label: Column, name: Column, text: Column) -> Column:
    """The stand-in context model: the name and the text's beginning."""
    return F.concat(name, F.lit(": "), F.substring(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "), 1, 300))


def enrich(nodes: DataFrame, context_model: Callable[[Column, Column, Column], Column] = extractive_context, version: int = 2) -> tuple[DataFrame, DataFrame]:
    """The enriched nodes and those whose context was rejected (with the error), which are not written.

    nodes: node_id, label, raw_text, breadcrumb, page_title, parent_text, synthesized, language, preceding, headers, cells, callout_kind, name.
    """
    c = F.col
    routed = nodes.withColumn("route", cx.route(c("label"), c("raw_text"), c("breadcrumb"), c("synthesized"), c("preceding")))
    templated = F.when(c("label") == "CodeBlock", cx.code_template(c("language"), c("breadcrumb"), c("preceding"))).otherwise(cx.section_template(c("breadcrumb"), c("page_title"), c("parent_text"), c("synthesized")))
    made = routed.withColumn("context", F.when(c("route") == "template", templated).when(c("route") == "llm", context_model(c("label"), c("name"), c("raw_text"))))
    checked = made.withColumn("error", F.when(c("route") == "llm", F.coalesce(cx.context_error(c("context")), cx.entity_context_error(c("label"), c("name"), c("context"), F.array().cast("array<string>")))))
    representation = cx.raw_representation(c("label"), c("raw_text"), c("language"), c("headers"), c("cells"), c("callout_kind"), c("name"))
    text = F.when(c("route") == "skip", "").otherwise(cx.indexed_text(c("context"), representation))
    good = checked.where("error IS NULL").withColumn("indexed_text", text).withColumn("embedding", F.when(c("route") != "skip", models.embed(c("indexed_text"))))
    return good.select("label", "node_id", "context", "indexed_text", "embedding", c("route").alias("context_source"), F.lit(version).alias("context_version")), checked.where("error IS NOT NULL").select("label", "node_id", "context", "error")

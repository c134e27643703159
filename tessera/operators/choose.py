"""Choices over records and nodes: kinds, labels, properties, optional filters, and the three unions of branches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.shared import first_rows

#: What is stored of a node, by its label (fixed values).
PROPERTIES = {
    "Page": ("url", "path", "title", "description", "description_source", "content_hash", "volatile"),
    "Section": ("id", "page_url", "anchor", "breadcrumb", "level", "position", "text", "synthesized", "parent_section_id", "external_links"),
    "CodeBlock": ("id", "section_id", "position", "language", "text", "preceding_paragraph", "in_codegroup", "codegroup_id"),
    "TableRow": ("id", "section_id", "position", "table_position", "headers", "cells"),
    "Callout": ("id", "section_id", "position", "callout_kind", "text"),
}


def projected(records: DataFrame, label: str, others: str = "string") -> DataFrame:
    """The stored properties of a label, in their order; one that records lack is null, of the type ``others``.  What isn't stored is never read."""
    lacking = F.lit(None).cast(others)
    return records.select(*[(F.col(p) if p in records.columns else lacking).alias(p) for p in PROPERTIES[label]])


def of_kinds(records: DataFrame, kept: tuple[str, ...], skipped: tuple[str, ...] = (), kind: str = "kind") -> DataFrame:
    """The records of the kinds kept.  A row of a kind that is neither kept nor skipped ends the job; a null kind is such a kind."""
    known = F.coalesce(F.col(kind).isin(*kept, *skipped), F.lit(False))
    checked = F.when(known, F.col(kind).isin(*kept)).otherwise(F.raise_error(F.concat(F.lit("unknown kind of record: "), F.coalesce(F.col(kind), F.lit("null")))).cast("boolean"))
    return records.where(checked)


def equal_or_any(column: Column, wanted: object) -> Column:
    """column = wanted, or true where nothing is wanted (None, or a null of a column).  A plain value is folded away by the optimizer or reaches the scan."""
    if wanted is None:
        return F.lit(True)
    return F.coalesce(column == wanted, wanted.isNull() if isinstance(wanted, Column) else F.lit(False))


def labelled(nodes: DataFrame, labels: tuple[str, ...], column: str = "labels") -> DataFrame:
    """Nodes of which a label is among the given; column holds one label or an array of them."""
    if not labels:
        return nodes.where(F.lit(False))
    if nodes.schema[column].dataType.simpleString() == "string":
        return nodes.where(F.col(column).isin(*labels))
    return nodes.where(F.coalesce(F.arrays_overlap(F.col(column), F.array(*map(F.lit, labels))), F.lit(False)))


def present(*columns: str) -> Column:
    """Whether one of the columns has a value."""
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])


def split_labels(asked: Column, *families: tuple[str, ...]) -> list[Column]:
    """The labels of asked that each family has, in the order asked; others belong to none, and a null list is empty."""
    some = F.coalesce(asked, F.array().cast("array<string>"))

    def of(family: tuple[str, ...]) -> Column:
        return F.filter(some, lambda x: x.isin(*family))

    return [of(f) for f in families]


def union_distinct(parts: list[DataFrame]) -> DataFrame:
    """Rows of all branches, equal ones once; columns by name."""
    return union_all(parts).distinct()


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Rows of all branches as often as they come; columns by name."""
    return reduce(DataFrame.unionByName, parts)


def concat_of_sets(parts: list[DataFrame], by: list[str], value: str) -> DataFrame:
    """The distinct values of each branch for each key, one branch after the other: a value of two branches comes twice.  by, part (number of the branch), value; nulls are left out."""
    sets = [p.where(F.col(value).isNotNull()).select(*by, F.lit(i).alias("part"), value).distinct() for i, p in enumerate(parts)]
    return union_all(sets)


def pilot(nodes: DataFrame, n: int | None, order: str = "node_id") -> DataFrame:
    """The first n nodes of an order, for a trial run; all of them without n."""
    return nodes if n is None else first_rows(nodes, [F.col(order)], max(n, 0))

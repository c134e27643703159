"""Keyed upserts, deletes and load decisions; the result is a new table, written beside the old one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe_last(rows: DataFrame, key: list[str], seq: str) -> DataFrame:
    """The last row of each key by seq, and first_seq, the seq of the first, by which the load orders them."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("row"), F.min(seq).alias("first_seq")).select(*key, *[F.col(f"row.{c}").alias(c) for c in rest], "first_seq")


def dedupe_first(rows: DataFrame, key: list[str], seq: str) -> DataFrame:
    """The first row of each key by seq."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.col(seq)).alias("row")).select(*key, *[F.col(f"row.{c}").alias(c) for c in rest])


def load_decision(incoming: DataFrame, stored: DataFrame, key: str, content: str = "content_hash") -> DataFrame:
    """key and action: merge_all for a new page, skip_nodes for an equal one, else replace."""
    old = stored.select(key, F.col(content).alias("stored_hash"))
    action = F.when(F.col("stored_hash").isNull(), "merge_all").when(F.col("stored_hash") == F.col(content), "skip_nodes").otherwise("replace")
    return incoming.join(old, key, "left").select(key, action.alias("action"))


def upsert(target: DataFrame, source: DataFrame, key: list[str], keep_when_null: bool = False) -> DataFrame:
    """target with source's rows: listed columns are taken from source, others keep the target's value.

    keep_when_null: a null of the source doesn't clear the target's value (entities), otherwise it does (page nodes).
    """
    new = source.select(*key, *[F.col(c).alias(f"new_{c}") for c in source.columns if c not in key], F.lit(True).alias("is_new"))
    both = target.withColumn("is_old", F.lit(True)).join(new, key, "full_outer")

    def value(c: str) -> Column:
        if c not in source.columns:
            return F.col(c)
        return (F.coalesce(f"new_{c}", c) if keep_when_null else F.when(F.col("is_new"), F.col(f"new_{c}")).otherwise(F.col(c))).alias(c)

    added = [F.col(f"new_{c}").alias(c) for c in source.columns if c not in key and c not in target.columns]
    return both.select(*key, *[value(c) for c in target.columns if c not in key], *added)


def delete_subtree(nodes: DataFrame, edges: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes and edges without the nodes in ids (node_id) and the edges at either end of them."""
    # nodes and edges stream past a hash table of their partition's ids: sorting them would take a task's memory
    gone = ids.hint("shuffle_hash")
    kept = nodes.join(gone, "node_id", "left_anti")
    return kept, edges.join(gone.withColumnRenamed("node_id", "source_id"), "source_id", "left_anti").join(gone.withColumnRenamed("node_id", "target_id"), "target_id", "left_anti")


def checked_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The edges of which both ends are nodes."""
    keys = nodes.select("node_id")
    return edges.join(keys.withColumnRenamed("node_id", "source_id"), "source_id", "left_semi").join(keys.withColumnRenamed("node_id", "target_id"), "target_id", "left_semi")


def hydrated(rows: DataFrame, nodes: DataFrame, columns: list[str]) -> DataFrame:
    """rows (node_id and more) with the payload columns of their nodes; null where a node isn't there.  Only rows' ids and these columns are shuffled."""
    own = [c for c in rows.columns if c not in columns]
    return rows.select(*own).join(nodes.select("node_id", *columns), "node_id", "left")


#: Columns by which a node may be named, the first wins where one node has a key twice (fixed values).
NODE_KEYS = ("node_id", "url", "name", "key")


def key_table(nodes: DataFrame, keys: tuple[str, ...] = NODE_KEYS) -> DataFrame:
    """key, node_id: what each node may be called; one row for each pair."""
    there = [c for c in keys if c in nodes.columns]
    return nodes.select("node_id", F.explode(F.array_distinct(F.array(*[F.col(c).cast("string") for c in there]))).alias("key")).where("key IS NOT NULL").select("key", "node_id")


def hydrated_by_key(rows: DataFrame, nodes: DataFrame, columns: list[str], key: str = "key") -> DataFrame:
    """rows with the payload columns of the nodes that their key names, by any of its keys; a key of no node goes, one of several nodes gives a row for each.

    The keys are one table, so naming by id, url, name or key is one equi-join, and payload is fetched for the nodes found only.
    """
    own = [c for c in rows.columns if c not in (*columns, "node_id")]
    # packed files of nodes look small to the planner; sent whole to every task, they aren't
    named = rows.select(*own).join(key_table(nodes).withColumnRenamed("key", key).hint("merge"), key)
    return named.join(nodes.select("node_id", *columns).hint("merge"), "node_id")


def write_properties(nodes: DataFrame, updates: DataFrame, key: list[str]) -> DataFrame:
    """nodes with the updates set; an update without its node ends the job."""
    found = updates.join(nodes.select(*key).withColumn("is_node", F.lit(True)), key, "left")
    checked = F.when(F.col("is_node"), F.col(key[0])).otherwise(F.raise_error(F.lit("an update has no node")).cast(updates.schema[key[0]].dataType))
    return upsert(nodes, found.withColumn(key[0], checked).drop("is_node"), key)


def resume(nodes: DataFrame, mode: str = "all", sources: list[str] | None = None) -> DataFrame:
    """The nodes that an enrichment run takes: all, missing_only (no context yet) or by_source; the predicate reaches the scan."""
    if mode == "missing_only":
        return nodes.where(F.col("context").isNull())
    if mode == "by_source":
        return nodes.where(F.col("context_source").isin(*(sources or [])))
    if mode != "all":
        raise ValueError(f"unknown mode {mode}")
    return nodes

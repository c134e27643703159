"""Loading pages with their nodes and edges into a stored graph, of which only the parts with changed pages are rewritten.

pages: page_id, content_hash (and more).  nodes: page_id, node_id, node_label (and more).  edges: page_id (of the source), edge_id, type, source_id, target_id (and more).
A page that is new or has another hash gets all its nodes and edges anew; one with the same hash keeps what is stored, enrichment with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import store
from tessera.sources.parts import Parts
from tessera.sources.shared import saved


def plan(pages: DataFrame, stored: DataFrame, whole: bool = False) -> DataFrame:
    """page_id, action: merge_all, replace or skip_nodes for the pages given; with ``whole``, delete for stored pages that aren't among them."""
    actions = store.load_decision(pages, stored, "page_id")
    if not whole:
        return actions
    return actions.unionByName(stored.join(pages, "page_id", "left_anti").select("page_id", F.lit("delete").alias("action")))


def planned_counts(actions: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """what, name, n: pages by action, nodes by label and edges by type (each edge id once) that a load of these would write or keep."""
    once = store.dedupe_last(edges.withColumn("seq", F.lit(0)), ["edge_id"], "seq")
    count = lambda df, what, by: df.groupBy(F.lit(what).alias("what"), F.col(by).alias("name")).agg(F.count("*").alias("n"))
    return count(actions, "pages", "action").unionByName(count(nodes, "nodes", "node_label")).unionByName(count(once, "edges", "type"))


def load(parts: Parts, pages: DataFrame, nodes: DataFrame, edges: DataFrame, whole: bool = False, dry_run: bool = False, carried: tuple[str, ...] = (), same: str = "raw_text") -> DataFrame:
    """Loads the pages; returns planned_counts.  A dry run writes nothing.

    carried: columns of nodes (enrichment) that a node of a replaced page takes from the stored node of its id, if the column ``same`` hasn't changed.
    """
    stored = parts.read("pages", pages.schema)
    actions = saved(plan(pages, stored, whole), "actions")
    counts = saved(planned_counts(actions, nodes, edges), "counts")
    changed = actions.where("action <> 'skip_nodes'").select("page_id", parts.part(F.col("page_id")).alias("part"))
    touched = sorted(r["part"] for r in changed.select("part").distinct().collect())  # one row for each part
    if dry_run or not touched:
        return counts
    new, ids = {}, changed.select("page_id")
    for name, rows, ident in (("pages", pages, "page_id"), ("nodes", nodes, "node_id"), ("edges", edges, "edge_id")):
        old = parts.read(name, rows.schema, touched)
        fresh = rows.join(ids, "page_id", "left_semi").dropDuplicates(["page_id", ident])
        if name == "nodes" and carried:
            known = old.select("node_id", F.col(same).alias("was"), *[F.col(c).alias(f"old_{c}") for c in carried]).dropDuplicates(["node_id"])
            kept = F.col(same).eqNullSafe(F.col("was"))
            fresh = fresh.join(known, "node_id", "left").select(*[F.coalesce(F.col(c), F.when(kept, F.col(f"old_{c}"))).alias(c) if c in carried else F.col(c) for c in rows.columns])
        kept_rows = old.join(ids, "page_id", "left_anti").select(*rows.columns)
        new[name] = (kept_rows.unionByName(fresh.select(*rows.columns)), F.col("page_id"), F.col(ident))
    parts.commit(new, touched)
    return counts


def graph(parts: Parts) -> tuple[DataFrame, DataFrame]:
    """The stored nodes, and the edges of which both ends are there: edges into a page outlive its replacement, but none outlives its target."""
    nodes, edges = parts.read("nodes"), parts.read("edges")
    return nodes, store.checked_edges(edges, nodes)

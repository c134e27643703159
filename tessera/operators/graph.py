"""Containment closure and the expansions of seed nodes over typed edges.

nodes: node_id, node_label, natural_key and payload.  edges: type, source_id, target_id.
A seed is (seed_rank, node_id, node_label); every expansion has a total order, so its limit is one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import choose, store
from tessera.sources.shared import first_rows, saved

ATOM_LABELS = ("Chunk", "CodeBlock", "Callout", "TableRow")
CONTAINS = ("CONTAINS_CODE", "CONTAINS_TABLE_ROW", "CONTAINS_CALLOUT", "HAS_CHUNK")
PATTERNS = ("siblings", "parent_page", "links", "defines", "navigates_to", "code_examples")


def closure(edges: DataFrame, roots: DataFrame, depth: int | None = None) -> DataFrame:
    """root, node_id, depth of everything below the roots by containment steps (source_id, target_id); a root itself has depth 0.

    With a depth (section levels bound one), so many steps are unrolled joins on one pair of keys.  Without, steps are made and written until none leads
    to a new node; cycles end there too.  A node that is met twice keeps its smallest depth.
    """
    level = roots.select(F.col("node_id").alias("root"), "node_id", F.lit(0).alias("depth"))
    steps = edges.select(F.col("source_id").alias("node_id"), "target_id")
    below = lambda level, d: level.join(steps, "node_id").select("root", F.col("target_id").alias("node_id"), F.lit(d).alias("depth"))
    levels = [level]
    if depth is not None:
        for d in range(1, depth + 1):
            levels.append(below(levels[-1], d))
        return reduce(DataFrame.union, levels).groupBy("root", "node_id").agg(F.min("depth").alias("depth"))
    while True:
        seen = reduce(DataFrame.union, levels).select("root", "node_id")
        level = saved(below(levels[-1], len(levels)).distinct().join(seen, ["root", "node_id"], "left_anti"), "level")
        if not level.limit(1).count():
            return reduce(DataFrame.union, levels)
        levels.append(level)


def _capped(found: DataFrame, seeds: DataFrame, per_seed: int, order: list) -> DataFrame:
    """The first per_seed x (number of seeds) rows of the order."""
    return first_rows(found, [F.col(c) for c in order], per_seed * seeds.count())


def expand_siblings(edges: DataFrame, nodes: DataFrame, seeds: DataFrame, per_seed: int = 3) -> DataFrame:
    """Other atoms of the section that holds a seed atom."""
    held = edges.where(F.col("type").isin(*CONTAINS))
    of_seed = held.join(seeds.select(F.col("node_id").alias("target_id"), "seed_rank"), "target_id").select(F.col("target_id").alias("seed_id"), "seed_rank", "source_id")
    found = of_seed.join(held.select("source_id", F.col("target_id").alias("node_id")), "source_id").where("node_id <> seed_id").join(choose.labelled(nodes, ATOM_LABELS, "node_label").select("node_id", "node_label"), "node_id")
    return _capped(found.select("seed_id", "seed_rank", "node_id", "node_label").distinct(), seeds, per_seed, ["seed_rank", "node_id"])


def expand_parent_page(section_pages: DataFrame, seeds: DataFrame, per_seed: int = 3) -> DataFrame:
    """The page of a seed: section_pages has (node_id, page_id) for sections and, through their section, atoms."""
    found = seeds.join(section_pages, "node_id").select(F.col("node_id").alias("seed_id"), "seed_rank", F.col("page_id").alias("node_id"), F.lit("Page").alias("node_label")).distinct()
    return _capped(found, seeds, per_seed, ["seed_rank", "node_id"])


def expand_targets(edges: DataFrame, nodes: DataFrame, seeds: DataFrame, types: tuple[str, ...], per_seed: int = 3) -> DataFrame:
    """What the seeds' edges of the given types lead to (links, navigation)."""
    found = edges.where(F.col("type").isin(*types)).join(seeds.select(F.col("node_id").alias("source_id"), "seed_rank"), "source_id").select(F.col("source_id").alias("seed_id"), "seed_rank", F.col("target_id").alias("node_id")).distinct()
    return _capped(found.join(nodes.select("node_id", "node_label"), "node_id").select("seed_id", "seed_rank", "node_id", "node_label"), seeds, per_seed, ["seed_rank", "node_id"])


def _seed_keys(nodes: DataFrame, seeds: DataFrame) -> DataFrame:
    """Seeds with the node they mean, whether given by id or by natural key; an equi-join on either."""
    by_id = seeds.select("seed_rank", F.col("node_id").alias("seed_id"), F.col("node_id").alias("entity_id"))
    named = nodes.where(F.col("natural_key").isNotNull()).select(F.col("natural_key").alias("seed_id"), F.col("node_id").alias("entity_id"))
    return by_id.union(by_id.select("seed_rank", "seed_id").join(named, "seed_id").select("seed_rank", "seed_id", "entity_id")).distinct()


def expand_defines(edges: DataFrame, nodes: DataFrame, seeds: DataFrame, per_seed: int = 3) -> DataFrame:
    """Sections that define or mention a seed entity, and entities that a seed section defines or mentions."""
    known = edges.where(F.col("type").isin("DEFINES", "MENTIONS"))
    meant = _seed_keys(nodes, seeds)
    inward = known.join(meant.withColumnRenamed("entity_id", "target_id"), "target_id").select("seed_id", "seed_rank", F.col("source_id").alias("node_id"))
    outward = known.join(meant.withColumnRenamed("entity_id", "source_id"), "source_id").select("seed_id", "seed_rank", F.col("target_id").alias("node_id"))
    found = inward.union(outward).distinct().join(nodes.select("node_id", "node_label"), "node_id").select("seed_id", "seed_rank", "node_id", "node_label")
    return _capped(found, seeds, per_seed, ["seed_rank", "node_id"])


def expand_code_examples(edges: DataFrame, nodes: DataFrame, seeds: DataFrame, per_seed: int = 3, language: str | None = None, depth: int | None = None) -> DataFrame:
    """Code blocks below sections that define or mention a seed entity: defined first, then nearest, then in order; each block once.

    Of a section's seeds only the first can be a block's, since depth and position are the same for all of them: one is kept for each section, before the sections below are
    joined and again before the blocks are.
    """
    known = edges.where(F.col("type").isin("DEFINES", "MENTIONS"))
    parents = known.join(_seed_keys(nodes, seeds).withColumnRenamed("entity_id", "target_id"), "target_id").select("seed_id", "seed_rank", F.col("source_id").alias("root"), F.when(F.col("type") == "DEFINES", 0).otherwise(1).alias("mentioned"))
    parents = saved(parents.groupBy("root").agg(F.min(F.struct("mentioned", "seed_rank", "seed_id")).alias("p")).select("root", "p.*"), "parents")
    below = closure(edges.where("type = 'HAS_SUBSECTION'"), parents.select(F.col("root").alias("node_id")), depth)
    code = edges.where("type = 'CONTAINS_CODE'").select(F.col("source_id").alias("section_id"), F.col("target_id").alias("node_id"))
    blocks = nodes.where("node_label = 'CodeBlock'")
    blocks = blocks if language is None else blocks.where(choose.equal_or_any(F.col("language"), language))
    nearest = parents.join(below.withColumnRenamed("node_id", "section_id"), "root").groupBy("section_id").agg(F.min(F.struct("mentioned", "depth", "seed_rank", "seed_id")).alias("p")).select("section_id", "p.*")
    found = nearest.join(code, "section_id").join(blocks.select("node_id", "node_label", F.coalesce("position", F.lit(999)).alias("position")), "node_id")
    best = found.groupBy("node_id", "node_label").agg(F.min(F.struct("mentioned", "depth", "position", "seed_rank", "seed_id")).alias("best"))
    flat = best.select("best.seed_id", "best.seed_rank", "node_id", "node_label", "best.mentioned", "best.depth", "best.position")
    return _capped(flat, seeds, per_seed, ["mentioned", "depth", "position", "node_id"])


def expand(seeds: DataFrame, expansions: list[tuple[str, DataFrame]], total_cap: int = 20, nodes: DataFrame | None = None, payload: tuple[str, ...] = ()) -> DataFrame:
    """Seeds, then the expansions in their order, each node once, with at most total_cap nodes that are no seeds.

    seeds: seed_rank, node_id, node_label; expansions: (pattern, rows of one of the functions above).  With nodes, what is left carries these payload columns of theirs, for reranking
    and citations; they are joined once, after the cap.
    """
    own = seeds.select("node_id", "node_label", F.lit(-1).alias("part"), F.col("seed_rank").cast("long").alias("place"), F.lit(None).cast("string").alias("expansion_origin"))
    own = own.withColumn("place", F.struct(F.col("place").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("c")))
    parts = [own]
    for i, (pattern, rows) in enumerate(expansions):
        order = ("mentioned", "depth", "position") if "mentioned" in rows.columns else ("seed_rank",)
        place = F.struct(*[(F.col(order[n]) if n < len(order) else F.lit(0)).cast("long").alias(c) for n, c in enumerate("abc")])
        parts.append(rows.select("node_id", "node_label", F.lit(i).alias("part"), place.alias("place"), F.concat_ws(":", F.lit(pattern), F.col("seed_id").cast("string")).alias("expansion_origin")))
    union = reduce(DataFrame.unionByName, parts)
    first = union.groupBy("node_id", "node_label").agg(F.min(F.struct("part", "place", "expansion_origin")).alias("x")).select("node_id", "node_label", "x.*")
    added = first.where("part >= 0").orderBy("part", "place", "node_id").limit(total_cap)
    every = first.where("part < 0").unionByName(added)
    return every if nodes is None else store.hydrated(every, nodes, list(payload))


def equivalents(blocks: DataFrame) -> DataFrame:
    """Pairs of blocks of one code group in different languages, the earlier first: source_id, target_id.

    blocks: node_id, group_id, position, language; groups are a few blocks of one page.
    """
    a, b = blocks.alias("a"), blocks.alias("b")
    return a.join(b, (F.col("a.group_id") == F.col("b.group_id")) & (F.col("a.position") < F.col("b.position")) & (F.col("a.language") != F.col("b.language"))).select(F.col("a.node_id").alias("source_id"), F.col("b.node_id").alias("target_id"))


def equivalent_languages(blocks: DataFrame) -> DataFrame:
    """blocks (node_id, group_id, language) with languages: the sorted other languages of their group."""
    groups = blocks.groupBy("group_id").agg(F.collect_set("language").alias("every"))
    return blocks.join(groups, "group_id").select(*blocks.columns, F.array_sort(F.array_except("every", F.array("language"))).alias("languages"))


def subtree(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """The ids of the given pages and of all nodes that carry their page_id."""
    return nodes.join(pages.select("page_id"), "page_id", "left_semi").select("node_id").union(pages.select(F.col("page_id").alias("node_id"))).distinct()

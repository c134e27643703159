"""From Markdown pages to a graph: nodes, typed edges and what couldn't be resolved, in one plan that parses each page once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import choose, graph, parse, resolve
from tessera.sources.shared import saved

NODE = ("page_id", "node_id", "node_label", "title", "breadcrumb", "anchor", "raw_text", "language", "position", "group_id")


#: What is read of the pages.
PARTS = ("outline", "held", "whole_texts", "blocks", "rows", "callouts", "links", "header")


@dataclass
class Graph:
    pages: DataFrame  # page_id (its URL), path, title, description, description_source, volatile, content_hash
    nodes: DataFrame  # NODE: Page, Section, CodeBlock, TableRow, Callout
    edges: DataFrame  # page_id (of the source), edge_id, type, source_id, target_id, href, text
    unresolved: DataFrame  # section_id, href, text, reason, target_page_url, target_anchor
    external: DataFrame  # section_id, external_links


def build(pages: DataFrame, descriptions: DataFrame, site: str, prefix: str, volatile: tuple[str, ...] = (), aliases: dict[str, str] | None = None) -> Graph:
    """The graph of pages (path, text); descriptions: url, description.  prefix: what stands before a path in its URL; site: the host of the corpus.

    Sections without text that are nobody's parent and hold nothing go, and with them what points to them; each page has one at least.
    """
    told = parse.read(pages, prefix, PARTS)
    header = saved(parse.page_header(pages, descriptions, volatile, prefix, told).withColumnRenamed("url", "page_id"), "pages")
    # an ID is its prefix and path, so that what is of a page needs no join to name it
    url = F.concat(F.lit(prefix), F.translate("path", "\\", "/")).alias("page_id")
    code, rows, notes, links, texts = (f(told) for f in (parse.code_blocks, parse.table_rows, parse.callouts, parse.sourced_links, lambda t: parse.section_text(t, navigation=True)))
    some = parse.held_sections(told).select("*", url)
    # a page that is left without a section gets an empty one
    lacking = header.join(told.where(F.size("held") == 0).select("path", F.size("outline").alias("n")), "path")
    given = {"pos": F.lit(-1), "position": F.coalesce("n", F.lit(0)), "level": F.lit(2), "heading": F.lit("Overview"), "anchor": F.lit("overview"), "section_id": F.concat("page_id", F.lit("#overview")), "breadcrumb": tx.breadcrumb(F.array("title", F.lit("Overview"))), "synthesized": F.lit(False)}
    kept = some.unionByName(lacking.select("path", "page_id", *[v.cast(some.schema[k].dataType).alias(k) for k, v in given.items()], F.lit(None).cast("string").alias("parent_id")))

    def node(df: DataFrame, label: str, **given: Column) -> DataFrame:
        return df.select(*[(given.get(c, F.lit(None).cast("int" if c == "position" else "string"))).alias(c) if c != "node_label" else F.lit(label).alias(c) for c in NODE])

    c = F.col
    of_page = lambda df: df.select("*", url)
    cells = F.array_join(F.zip_with("headers", "cells", lambda h, v: F.concat_ws(": ", F.nullif(h, F.lit("")), v)), "; ")
    parts = [
        node(header, "Page", page_id=c("page_id"), node_id=c("page_id"), title=c("title"), raw_text=c("description")),
        node(kept.join(texts, "section_id", "left"), "Section", page_id=c("page_id"), node_id=c("section_id"), title=c("heading"), breadcrumb=c("breadcrumb"), anchor=c("anchor"), raw_text=F.coalesce("text", F.lit("")), position=c("position")),
        node(of_page(code), "CodeBlock", page_id=c("page_id"), node_id=c("node_id"), raw_text=c("text"), language=c("language"), position=c("position"), group_id=c("group_id")),
        node(of_page(rows), "TableRow", page_id=c("page_id"), node_id=c("node_id"), raw_text=cells, position=c("position").cast("int")),
        node(of_page(notes), "Callout", page_id=c("page_id"), node_id=c("node_id"), title=c("kind"), raw_text=c("text"), position=c("position")),
    ]
    nodes = parts[0]
    for p in parts[1:]:
        nodes = nodes.unionByName(p)
    sections = kept.select("section_id", F.col("page_id").alias("page_url"), "anchor", "position", "parent_id")
    keyed = links.withColumn("link_id", F.concat_ws(":", "path", "pos", "nth"))
    resolved = saved(resolve.resolve(keyed.select("link_id", "path", "section_id", "href", "text", "source_kind"), header.select("path", F.col("page_id").alias("url")), sections, site, aliases), "resolved")
    contained = resolve.containment_edges(sections, code, rows, notes)
    pairs = graph.equivalents(code.where("group_id IS NOT NULL")).select(F.lit("EQUIVALENT_TO").alias("type"), "source_id", "target_id")
    pairs = pairs.withColumn("id", tx.edge_id(c("type"), c("source_id"), c("target_id"), F.lit("")))
    every = resolve.link_edges(resolved, sections).unionByName(contained, allowMissingColumns=True).unionByName(pairs, allowMissingColumns=True)
    # edges go out from pages, sections and code blocks, which are named here without their texts
    owners = choose.union_all([df.select("page_id", F.col(of).alias("source_id")) for df, of in ((header, "page_id"), (kept, "section_id"), (of_page(code), "node_id"))])
    edges = every.join(owners, "source_id").select("page_id", F.col("id").alias("edge_id"), "type", "source_id", "target_id", "href", "text")
    return Graph(header, nodes, edges, resolve.unresolved(resolved), resolve.external_links(resolved))

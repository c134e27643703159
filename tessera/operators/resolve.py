"""Links to typed edges: ordered-candidate joins with pages and sections, and diagnostics for what fails."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as tx


def classify(links: DataFrame, site: str, root: str = "/docs/") -> DataFrame:
    """links (path, href) with clean href, raw_path, anchor and kind: external, dom_anchor or internal.

    site: the host whose paths below root are pages of the corpus.
    """
    href = tx.clean_href(F.coalesce("href", F.lit("")))
    out = links.withColumn("clean", href)
    scheme = F.lower(F.regexp_extract("clean", r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    host = F.lower(F.regexp_extract("clean", r"^[A-Za-z]+://([^/?#]*)", 1))
    after = F.regexp_replace("clean", r"^[A-Za-z]+://[^/?#]*", "")
    path = F.regexp_replace(after, r"[?#].*$", "")
    anchor = tx.normalize_anchor(F.regexp_extract("clean", r"#(.*)$", 1))
    outside = (F.col("clean") == "") | (scheme.isin("http", "https") & ((host != site.lower()) | ~F.startswith(path, F.lit(root)))) | ((scheme != "") & ~scheme.isin("http", "https"))
    kind = F.when(outside, "external").when(F.startswith(F.col("anchor"), F.lit("ce-")), "dom_anchor").otherwise("internal")
    return out.withColumn("raw_path", path).withColumn("anchor", anchor).withColumn("kind", kind)


def resolve(links: DataFrame, pages: DataFrame, sections: DataFrame, site: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """links (link_id, path, href, ...) with status (external, dom_anchor, page, section, unresolved), reason, page_url and section_id.

    pages: path, url; sections: section_id, page_url, anchor.  Anchors match exactly, as slugs, without hyphens, or, if that is unambiguous, by letters and digits alone.
    """
    known = classify(links, site)
    tried = known.where("kind = 'internal'").select("link_id", "anchor", F.posexplode(tx.candidate_paths(F.col("raw_path"), F.col("path"), aliases=aliases)).alias("place", "path"))
    hit = tried.join(pages.select("path", F.col("url").alias("page_url")), "path").groupBy("link_id").agg(F.min_by(F.struct("page_url", "anchor"), "place").alias("x")).select("link_id", "x.*")
    with_anchor = hit.where("anchor <> ''")
    exact = with_anchor.select("link_id", "page_url", F.posexplode(F.array(F.col("anchor"), tx.slugify(F.col("anchor")), F.replace("anchor", F.lit("-"), F.lit("")))).alias("place", "anchor"))
    exact = exact.join(sections.select("page_url", "anchor", "section_id"), ["page_url", "anchor"]).groupBy("link_id").agg(F.min_by("section_id", "place").alias("exact_id"))
    loose_sections = sections.groupBy("page_url", tx.loose_key(F.col("anchor")).alias("loose")).agg(F.count("*").alias("n"), F.min("section_id").alias("loose_id")).where("n = 1")
    loose = with_anchor.select("link_id", "page_url", tx.loose_key(F.col("anchor")).alias("loose")).join(loose_sections, ["page_url", "loose"]).select("link_id", "loose_id")
    found = hit.drop("anchor").join(exact, "link_id", "left").join(loose, "link_id", "left").withColumn("section_id", F.coalesce("exact_id", "loose_id")).drop("exact_id", "loose_id")
    joined = known.join(found.withColumnRenamed("section_id", "target_section_id"), "link_id", "left")
    status = (
        F.when(F.col("kind") != "internal", F.col("kind")).when(F.col("page_url").isNull(), "unresolved")
        .when((F.col("anchor") != "") & F.col("target_section_id").isNull(), "unresolved").when(F.col("anchor") != "", "section").otherwise("page")
    )
    reason = F.when((F.col("kind") == "internal") & F.col("page_url").isNull(), "page").when((F.col("kind") == "internal") & (F.col("anchor") != "") & F.col("target_section_id").isNull(), "anchor")
    return joined.select(*links.columns, "anchor", status.alias("status"), reason.alias("reason"), "page_url", "target_section_id")


def first_sections(sections: DataFrame) -> DataFrame:
    """page_url and the id of its first section."""
    return sections.groupBy("page_url").agg(F.min_by("section_id", "position").alias("first_section_id"))


def link_edges(resolved: DataFrame, sections: DataFrame) -> DataFrame:
    """Edges of resolved links (with section_id, href, text, source_kind), each once: LINKS_TO a section, LINKS_TO_PAGE a page, NAVIGATES_TO from navigation tables.

    A link to its own section is no edge.
    """
    first = first_sections(sections)
    hit = resolved.where(F.col("status").isin("page", "section")).join(first, "page_url", "left")
    navigates = F.col("source_kind") == "navigation_table"
    kind = F.when(navigates, "NAVIGATES_TO").when(F.col("status") == "section", "LINKS_TO").otherwise("LINKS_TO_PAGE")
    target = F.when(F.col("status") == "section", F.col("target_section_id")).when(navigates, F.coalesce("first_section_id", "page_url")).otherwise(F.col("page_url"))
    edges = hit.select(kind.alias("type"), F.col("section_id").alias("source_id"), target.alias("target_id"), "href", "text", "link_id").where("source_id <> target_id")
    ident = edges.withColumn("id", tx.edge_id(F.col("type"), F.col("source_id"), F.col("target_id"), F.col("href")))
    nth = F.row_number().over(Window.partitionBy("id").orderBy("link_id"))
    return ident.withColumn("nth", nth).where("nth = 1").drop("nth", "link_id")


def unresolved(resolved: DataFrame) -> DataFrame:
    return resolved.where("status = 'unresolved'").select("section_id", "href", "text", "reason", F.col("page_url").alias("target_page_url"), F.when(F.col("anchor") != "", F.col("anchor")).alias("target_anchor"))


def external_links(resolved: DataFrame, by: str = "section_id") -> DataFrame:
    """Each section's external links, sorted, each once."""
    return resolved.where("status = 'external' AND trim(href) <> ''").groupBy(by).agg(F.array_sort(F.collect_set("href")).alias("external_links"))


def containment_edges(sections: DataFrame, code: DataFrame, rows: DataFrame, callouts: DataFrame) -> DataFrame:
    """HAS_SECTION from pages, HAS_SUBSECTION between sections, and CONTAINS_ edges to atoms."""
    def edges(df: DataFrame, kind: str, source: str, target: str) -> DataFrame:
        own = df.select(F.lit(kind).alias("type"), F.col(source).alias("source_id"), F.col(target).alias("target_id")).where("source_id IS NOT NULL")
        return own.withColumn("id", tx.edge_id(F.col("type"), F.col("source_id"), F.col("target_id"), F.lit("")))

    tops = edges(sections.where("parent_id IS NULL"), "HAS_SECTION", "page_url", "section_id")
    parts = [edges(sections, "HAS_SUBSECTION", "parent_id", "section_id"), edges(code, "CONTAINS_CODE", "section_id", "node_id"), edges(rows, "CONTAINS_TABLE_ROW", "section_id", "node_id"), edges(callouts, "CONTAINS_CALLOUT", "section_id", "node_id")]
    for p in parts:
        tops = tops.unionByName(p)
    return tops

"""Entities of a closed vocabulary: extraction from table rows by a rule table, and mentions in sections."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as tx

#: place, page path, anchor (null: any), first headers, label, and whether the row or its section defines (fixed values of the corpus).
RULES = [
    (0, "en/tools-reference.md", None, ["tool"], "Tool", "row"),
    (1, "en/settings.md", None, ["key", "setting"], "SettingKey", "section"),
    (2, "en/permissions.md", None, ["key", "setting"], "SettingKey", "section"),
    (3, "en/hooks.md", "hook-lifecycle", ["event"], "Hook", "section"),
    (4, "en/permission-modes.md", "available-modes", ["mode"], "PermissionMode", "section"),
]
RULE_SCHEMA = "place int, path string, anchor string, first_headers array<string>, label string, source string"
#: label, name, page path, anchor (null: the page's first section); what a fixed list names.
NAMED = [("MessageType", n, "en/agent-sdk/agent-loop.md", "message-types") for n in ("SystemMessage", "AssistantMessage", "UserMessage", "StreamEvent", "ResultMessage")] + [
    ("Provider", "bedrock", "en/amazon-bedrock.md", None), ("Provider", "vertex-ai", "en/google-vertex-ai.md", None), ("Provider", "foundry", "en/microsoft-foundry.md", None)]


def from_rows(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Entity rows that the rules find in table rows (node_id, section_id, path, pos order, headers, cells): label, name, description, permission_required, source_id, seq."""
    anchor = F.element_at(F.split("section_id", "#"), -1)
    hit = rows.withColumn("row_anchor", anchor).join(rules, "path").where((F.col("anchor").isNull() | (F.col("anchor") == F.col("row_anchor"))) & F.array_contains("first_headers", F.coalesce(F.try_element_at("headers", F.lit(1)), F.lit(""))))
    cell = lambda i: F.nullif(F.try_element_at("cells", F.lit(i)), F.lit(""))
    name = tx.first_code_or_text(F.try_element_at("cells", F.lit(1)))
    found = hit.select("label", name.alias("name"), cell(2).alias("description"), F.when(F.col("label") == "Tool", cell(3)).alias("permission_required"), F.when(F.col("source") == "row", F.col("node_id")).otherwise(F.col("section_id")).alias("source_id"), F.struct("place", "section_id", "table_position", "position").alias("seq"))
    return found.where("name <> ''")


def catalogue(found: DataFrame) -> DataFrame:
    """One row for each entity, by its first definition: entity_id, label, name, description, permission_required."""
    first = found.groupBy("label", "name").agg(F.min_by(F.struct("description", "permission_required"), "seq").alias("x"))
    return first.select(tx.entity_id(F.col("label"), F.col("name")).alias("entity_id"), "label", "name", "x.*")


def defines(found: DataFrame) -> DataFrame:
    """DEFINES edges, each once."""
    edges = found.select(F.lit("DEFINES").alias("type"), "source_id", tx.entity_id(F.col("label"), F.col("name")).alias("target_id")).distinct()
    return edges.withColumn("id", tx.edge_id(F.col("type"), F.col("source_id"), F.col("target_id"), F.lit("")))


def named_entities(named: DataFrame, sections: DataFrame, first_sections: DataFrame) -> DataFrame:
    """Entity rows of a fixed list (label, name, path, anchor): source_id is the section of the anchor, or the page's first; null if it isn't there."""
    exact = named.where("anchor IS NOT NULL").join(sections.select("path", "anchor", F.col("section_id").alias("source_id")), ["path", "anchor"])  # nothing without its section
    first = named.where("anchor IS NULL").join(first_sections.select("path", F.col("section_id").alias("source_id")), "path", "left")
    return exact.select("label", "name", "source_id").unionByName(first.select("label", "name", "source_id"))


def mentions(sections: DataFrame, names: DataFrame) -> DataFrame:
    """section_id, name for each name that stands in a section's breadcrumb or text with no ASCII letter, digit or underscore beside it.

    Sections and names are joined on the first word of a name (its first run of letters, digits and underscores), or on its first character where it
    has none; such a section must hold that too.  Only ids and keys meet there; the texts of the pairs found are fetched then, and the whole name is matched.
    """
    text = F.concat_ws("\n\n", F.nullif("breadcrumb", F.lit("")), F.nullif("text", F.lit("")))
    whole = sections.select("section_id", text.alias("whole")).where("whole <> ''")
    keys = F.array_distinct(F.regexp_extract_all(F.col("whole"), F.lit(r"[A-Za-z0-9_]+|[^A-Za-z0-9_]"), F.lit(0)))
    keyed = whole.select("section_id", F.explode(keys).alias("first_key"))
    word = F.regexp_extract("name", "[A-Za-z0-9_]+", 0)
    listed = names.where("name <> ''").select("name", F.when(word != "", word).otherwise(F.substring("name", 1, 1)).alias("first_key")).distinct()
    pairs = keyed.join(listed, "first_key").select("section_id", "name").distinct()
    return pairs.join(whole, "section_id").where(tx.mentions(F.col("whole"), F.col("name"))).select("section_id", "name")


def mention_edges(sections: DataFrame, entities: DataFrame) -> DataFrame:
    """MENTIONS edges of sections to entities (entity_id, name), with the name as evidence."""
    found = mentions(sections, entities).join(entities.select("name", "entity_id"), "name")
    edges = found.select(F.lit("MENTIONS").alias("type"), F.col("section_id").alias("source_id"), F.col("entity_id").alias("target_id"), F.col("name").alias("evidence"))
    return edges.withColumn("id", tx.edge_id(F.col("type"), F.col("source_id"), F.col("target_id"), F.col("evidence")))


def siblings(entities: DataFrame) -> DataFrame:
    """entity_id and the names of the other entities of its label."""
    same = entities.groupBy("label").agg(F.array_sort(F.collect_set("name")).alias("names"))  # a closed vocabulary
    return entities.join(same, "label").select("entity_id", F.array_remove("names", F.col("name")).alias("siblings"))


def first_definition(edges: DataFrame) -> DataFrame:
    """entity_id and the smallest id of the sections that define it."""
    window = Window.partitionBy("target_id").orderBy("source_id")
    return edges.where("type = 'DEFINES'").withColumn("nth", F.row_number().over(window)).where("nth = 1").select(F.col("target_id").alias("entity_id"), F.col("source_id").alias("section_id"))

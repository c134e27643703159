"""Corpus, record and report files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import text as tx

NODE_KINDS = ("page", "section", "codeblock", "tablerow", "callout")
#: All fields that a record of any kind may have; a kind leaves the others null.
RECORD = T.StructType([T.StructField(n, t) for n, t in [
    ("kind", T.StringType()), ("id", T.StringType()), ("url", T.StringType()), ("path", T.StringType()), ("title", T.StringType()), ("description", T.StringType()), ("description_source", T.StringType()),
    ("content_hash", T.StringType()), ("volatile", T.BooleanType()), ("page_url", T.StringType()), ("anchor", T.StringType()), ("breadcrumb", T.StringType()), ("text", T.StringType()), ("level", T.IntegerType()),
    ("position", T.IntegerType()), ("synthesized", T.BooleanType()), ("parent_section_id", T.StringType()), ("external_links", T.ArrayType(T.StringType())), ("section_id", T.StringType()), ("language", T.StringType()),
    ("preceding_paragraph", T.StringType()), ("in_codegroup", T.BooleanType()), ("codegroup_id", T.StringType()), ("table_position", T.IntegerType()), ("headers", T.ArrayType(T.StringType())), ("cells", T.ArrayType(T.StringType())),
    ("callout_kind", T.StringType()), ("href", T.StringType()), ("source_kind", T.StringType()), ("is_internal", T.BooleanType()), ("is_anchor_only", T.BooleanType()), ("type", T.StringType()), ("source_id", T.StringType()),
    ("target_id", T.StringType()), ("evidence", T.StringType()), ("reason", T.StringType()), ("target_page_url", T.StringType()), ("target_anchor", T.StringType()), ("label", T.StringType()), ("name", T.StringType()), ("key", T.StringType()), ("permission_required", T.StringType())]])


def read_corpus(spark: SparkSession, root: str, pattern: str = "*.md") -> DataFrame:
    """path (below root) and text of every matching file."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    base = root.rstrip("/").split("://")[-1].removeprefix("file:").rstrip("/") + "/"
    at = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    begins = F.locate(base, at)  # as it stands, no pattern
    return files.select(F.when(begins > 0, F.substr(at, begins + len(base))).otherwise(at).alias("path"), F.col("value").alias("text"))


def link_descriptions(index: DataFrame) -> DataFrame:
    """url, description from the lines (line_no, line) of a link index such as "- [title](url): description"; the last line of a url counts."""
    line = F.regexp_extract("line", r"^\s*-\s*\[[^\]]*\]\(([^)\s]+)\):\s*(.+?)\s*$", 1).alias("url")
    said = F.regexp_extract("line", r"^\s*-\s*\[[^\]]*\]\(([^)\s]+)\):\s*(.+?)\s*$", 2).alias("description")
    return index.select("line_no", line, said).where("url <> ''").groupBy("url").agg(F.max_by("description", "line_no").alias("description"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """Records of JSON lines, with file; a malformed line or an empty folder ends the job."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path, recursiveFileLookup=True)
    if not rows.inputFiles():
        raise ValueError(f"no records in {path}")
    return rows.withColumn("file", F.col("_metadata.file_path"))


def write_jsonl(rows: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines without null fields, in a folder for each value of ``by``."""
    writer = rows.write.mode("overwrite").option("ignoreNullFields", "true")
    (writer.partitionBy(by) if by else writer).json(path)


def slug_of_path(path: Column) -> Column:
    """A page's file name: slashes doubled to underscores, without .md."""
    return F.regexp_replace(F.regexp_replace(path, r"\.md$", ""), "/", "__")


def entity_catalogue(rows: DataFrame) -> DataFrame:
    """Entity records; a row of another kind ends the job."""
    wrong = F.concat(F.lit("not an entity: "), F.coalesce("kind", F.lit("null")), F.lit(" in "), F.coalesce("file", F.lit("?")))
    checked = rows.withColumn("kind", F.when(F.col("kind") == "entity", F.col("kind")).otherwise(F.raise_error(wrong)))
    return checked.select("kind", "id", "label", F.coalesce("name", "key").alias("natural_key"), "description", "permission_required")


def split_kinds(rows: DataFrame) -> dict[str, DataFrame]:
    """A table for each kind of node and the relationships; links and diagnostics are left out, an unknown kind ends the job."""
    known = (*NODE_KINDS, "relationship", "link", "unresolved_link")
    checked = rows.withColumn("kind", F.when(F.col("kind").isin(*known), F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("unknown kind "), F.coalesce("kind", F.lit("null"))))))
    return {k: checked.where(F.col("kind") == k) for k in (*NODE_KINDS, "relationship")}


def page_counts(rows: DataFrame) -> DataFrame:
    """Files that don't hold exactly one page."""
    return rows.groupBy("file").agg(F.count_if(F.col("kind") == "page").alias("pages")).where("pages <> 1")


def gold_questions(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Gold questions (a short list): id, category, question, reference_answer and expected_context_ids as any-of groups; ids are unique and fields are there."""
    rows, seen = [], set()
    for e in entries:
        absent = [k for k in ("id", "category", "question", "reference_answer", "expected_context_ids") if not e.get(k)]
        if absent or e["id"] in seen:
            raise ValueError(f"question {e.get('id')}: " + (f"without {absent}" if absent else "twice"))
        seen.add(e["id"])
        groups = [[g] if isinstance(g, str) else [str(x) for x in g if str(x).strip()] for g in e["expected_context_ids"]]
        if not all(groups):
            raise ValueError(f"question {e['id']}: an empty group")
        rows.append((e["id"], e["category"], e["question"], e["reference_answer"], groups))
    return spark.createDataFrame(rows, "id string, category string, question string, reference_answer string, expected_context_ids array<array<string>>")


def write_report(metrics: DataFrame, folder: str) -> None:
    """The metrics as JSON lines and as CSV with a header."""
    metrics.write.mode("overwrite").json(f"{folder}/jsonl")
    metrics.write.mode("overwrite").option("header", "true").csv(f"{folder}/csv")


def statements(script: str) -> list[str]:
    """The statements of a schema script: // lines are comments, a semicolon ends a statement."""
    kept = "\n".join(x for x in script.splitlines() if not x.strip().startswith("//"))
    return [s.strip() for s in kept.split(";") if s.strip()]


def apply_statements(spark: SparkSession, script: str) -> int:
    for n, s in enumerate(statements(script), 1):
        try:
            spark.sql(s)
        except Exception as e:
            raise RuntimeError(f"statement {n} failed: {e}") from e
    return len(statements(script))


def properties_json(*names: str) -> Column:
    """The given columns as JSON, without those that are null or empty."""
    return F.to_json(F.struct(*[F.nullif(F.col(n), F.lit("")).alias(n) for n in names]))


def as_records(rows: list[dict]) -> list[str]:
    return [json.dumps(r, ensure_ascii=False) for r in rows]


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """path and SHA-256 of files."""
    return spark.read.format("binaryFile").load(path).select("path", tx.content_hash(F.col("content")).alias("sha256"))

"""Markdown pages to sections, code blocks, table rows, callouts and links.

A page is read where it stands, in one walk (``markdown.walk``) for the parts of it that are asked for: nothing is shuffled for it, and no line becomes a row.
Pages are (path, text), a row for each path; every result carries path and line positions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as tx
from tessera.operators import markdown
from tessera.sources.shared import saved

FENCE = r"^[ \t]*(`{3,}|~{3,})(.*)$"
#: The parts of a page, and their columns beside its path.
SECTION = {"pos": "int", "position": "int", "level": "int", "heading": "string", "anchor": "string", "section_id": "string", "parent_id": "string", "breadcrumb": "string", "synthesized": "boolean"}
PARTS = {
    "outline": SECTION,
    "held": SECTION,
    "pieces": {"section_id": "string", "callout": "bigint", "pos": "int", "text": "string", "kind": "string"},
    "texts": {"section_id": "string", "text": "string"},
    "whole_texts": {"section_id": "string", "text": "string"},
    "blocks": {"node_id": "string", "section_id": "string", "pos": "int", "position": "int", "language": "string", "text": "string", "preceding": "string", "group_id": "string"},
    "tables": {"section_id": "string", "table": "int", "headers": "array<string>", "linked": "bigint", "total": "bigint", "navigates": "boolean", "table_position": "int"},
    "rows": {"node_id": "string", "section_id": "string", "position": "int", "table_position": "int", "headers": "array<string>", "cells": "array<string>"},
    "menus": {"section_id": "string", "table": "int", "text": "string"},
    "callouts": {"node_id": "string", "section_id": "string", "position": "int", "kind": "string", "text": "string"},
    "links": {"section_id": "string", "pos": "int", "nth": "int", "href": "string", "text": "string", "source_kind": "string"},
    "header": {"title": "string", "quote": "string", "content_hash": "string"},
}
ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
#: Bytes of pages whose parts go out together.
WALKED_BYTES = 4 << 20


def _spans() -> Column:
    return F.array().cast("array<struct<a:int,b:int,closed:boolean>>")


def fence_spans(lines: Column) -> Column:
    """The fenced blocks of an array of lines as spans (a, b, closed), marks included: a fold over the lines that could be marks.

    What is carried is the open mark: a block ends at a bare mark of the same character, as long at least, or with the last line.  Other marks inside are text.
    """
    some = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("at"), x.alias("x"))), lambda m: F.contains(m["x"], F.lit("```")) | F.contains(m["x"], F.lit("~~~")))
    marks = F.filter(F.transform(some, lambda m: F.struct(m["at"].alias("at"), F.regexp_extract(m["x"], FENCE, 1).alias("run"), F.regexp_extract(m["x"], FENCE, 2).alias("info"))), lambda m: m["run"] != "")

    def step(s: Column, m: Column) -> Column:
        opens = (s["open"] < 0) & ~(F.startswith(m["run"], F.lit("`")) & F.contains(m["info"], F.lit("`")))
        closes = (s["open"] >= 0) & F.startswith(m["run"], s["run"]) & (F.trim(m["info"]) == "")
        ended = F.concat(s["spans"], F.array(F.struct(s["open"].alias("a"), m["at"].alias("b"), F.lit(True).alias("closed"))))
        return F.when(opens, F.struct(m["at"].alias("open"), m["run"].alias("run"), s["spans"].alias("spans"))).when(closes, F.struct(F.lit(-1).alias("open"), F.lit("").alias("run"), ended.alias("spans"))).otherwise(s)

    last = lambda s: F.when(s["open"] < 0, s["spans"]).otherwise(F.concat(s["spans"], F.array(F.struct(s["open"].alias("a"), (F.size(lines) - 1).alias("b"), F.lit(False).alias("closed")))))
    return F.aggregate(marks, F.struct(F.lit(-1).alias("open"), F.lit("").alias("run"), _spans().alias("spans")), step, last)


def by_span(lines: Column, spans: Column, plain: Callable[[Column], Column], fenced: Callable[[Column, Column, Column], Column]) -> Column:
    """plain(lines) of what is before, between and after the spans, and fenced(lines, span, number from 1) of each, in order; both give arrays."""
    n, m = F.size(lines), F.size(spans)

    def part(k: Column) -> Column:
        span = F.get(spans, k)
        begin = F.when(k > 0, F.get(spans, k - 1)["b"] + 1).otherwise(0)
        before = plain(F.slice(lines, begin + 1, F.greatest(F.coalesce(span["a"], n) - begin, F.lit(0))))
        return F.when(k < m, F.concat(before, fenced(F.slice(lines, span["a"] + 1, span["b"] - span["a"] + 1), span, k + 1))).otherwise(before)

    return F.flatten(F.transform(F.sequence(F.lit(0), m), part))


def _lines(text: Column) -> Column:
    """The lines of a page without style and script elements and what a page begins with between two lines of dashes."""
    text = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n")
    text = F.regexp_replace(text, r"(?is)<style\b[^>]*>.*?</style\s*>|<script\b[^>]*/>|<script\b[^>]*>.*?</script\s*>", "")
    return F.split(F.regexp_replace(text, r"\A---[ \t]*\n(?:(?!---[ \t]*(?:\n|\z))[^\n]*+\n)*+---[ \t]*(?:\n|\z)", ""), "\n")


def lines(pages: DataFrame) -> DataFrame:
    """path, pos, line, and fence: 1 on the lines of a fenced block, mark: whether it is one of its marks, fence_no: the block's number from 1 (else 0)."""
    row = lambda line, fence, mark, no: F.struct(line.alias("line"), F.lit(fence).alias("fence"), mark.alias("mark"), no.cast("int").alias("fence_no"))
    plain = lambda ls: F.transform(ls, lambda x: row(x, 0, F.lit(False), F.lit(0)))
    fenced = lambda ls, span, no: F.transform(ls, lambda x, i: row(x, 1, (i == 0) | (span["closed"] & (i == span["b"] - span["a"])), no))
    told = pages.select("path", _lines(F.col("text")).alias("ls")).withColumn("spans", fence_spans(F.col("ls")))
    return told.select("path", F.posexplode(by_span(F.col("ls"), F.col("spans"), plain, fenced)).alias("pos", "x")).select("path", "pos", "x.*")


def unique_anchor(by: list[str], base: str, order: str) -> Column:
    """The anchor of each row: its base, with a number from 1 behind it for those after the first of one base in the order."""
    nth = F.row_number().over(Window.partitionBy(*by, base).orderBy(order)) - 1
    return F.when(nth == 0, F.col(base)).otherwise(F.concat_ws("-", base, nth.cast("string")))


def html_links(html: Column) -> Column:
    """The targets of a page's anchors, in order."""
    return F.regexp_extract_all(html, F.lit('<a href="([^"]*)"'), F.lit(1))


def _by_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of the batches, about WALKED_BYTES of text at a time."""
    held: list[tuple] = []
    size = 0
    for batch in (b.slice(at, 64) for b in batches for at in range(0, b.num_rows, 64)):
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(row)
            size += len(row[1] or "")
            if size >= WALKED_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


def part(placed: DataFrame, name: str) -> DataFrame:
    """path and the columns of a part of the pages, by a walk over them, or as they were read."""
    if name in placed.columns:
        return placed.select("path", F.inline(name))
    kinds = {"path": "string"} | PARTS[name]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, ARROW[k]) for c, k in kinds.items()])
        for pages in _by_bytes(batches):
            rows = [(path, *row) for path, text, prefix in pages for row in markdown.walk(path, text, prefix, (name,))[name]]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return placed.select("path", "text", "prefix").mapInArrow(task, ", ".join(f"`{c}` {k}" for c, k in kinds.items()))


def _placed(pages: DataFrame, prefix: str) -> DataFrame:
    return pages.select(F.col("path").cast("string").alias("path"), "text", F.lit(prefix).alias("prefix"))


def read(pages: DataFrame, prefix: str = "", parts: tuple[str, ...] = tuple(PARTS)) -> DataFrame:
    """path and the parts of each page as arrays, by one walk, and written: what reads several parts doesn't walk again."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), *((n, pa.list_(pa.struct([(c, ARROW[k]) for c, k in PARTS[n].items()]))) for n in parts)])
        for pages in _by_bytes(batches):
            walked = [markdown.walk(path, text, prefix, parts) for path, text, prefix in pages]
            columns = [[p[0] for p in pages], *([w[n] for w in walked] for n in parts)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    kinds = [f"{n} array<struct<{', '.join(f'`{c}`: {k}' for c, k in PARTS[n].items())}>>" for n in parts]
    return saved(_placed(pages, prefix).mapInArrow(task, ", ".join(["path string", *kinds])), "parts")


def normalised(pages: DataFrame) -> DataFrame:
    """path, text: pages as plain Markdown: without top-level exports and expressions, component tags and underlined headings.

    A page without a tag keeps its lines, so that a line's pos is its place in the page.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bytes(batches):
            yield pa.RecordBatch.from_pydict({"path": pa.array([p for p, _ in rows], pa.string()), "text": pa.array([markdown.normalised(t) for _, t in rows], pa.string())})

    return pages.select(F.col("path").cast("string").alias("path"), "text").mapInArrow(task, "path string, text string")


def sections(pages: DataFrame, prefix: str = "") -> DataFrame:
    """Sections (headings of level 2 to 6, and an Overview before the first where there is content).

    path, pos, position, level, heading, anchor, section_id, parent_id, breadcrumb, synthesized (the heading of an update card).
    """
    return part(_placed(pages, prefix), "outline")


def located(pages: DataFrame, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """The sections, and the pages as the functions below take them: each of these walks over them for its own part, if they haven't been read."""
    placed = _placed(pages, prefix)
    return part(placed, "outline"), placed


def paragraphs(placed: DataFrame) -> DataFrame:
    """What is text in a section, piece by piece: path, section_id, callout, pos (of the first line), text.

    Runs of prose lines, lists, quotes, rules, images that stand alone, and indented blocks that are prose.
    """
    return part(placed, "pieces").drop("kind")


def lists(placed: DataFrame) -> DataFrame:
    """Lists as flat text: path, section_id, callout, pos, text."""
    return part(placed, "pieces").where("kind = 'list'").drop("kind")


def section_text(placed: DataFrame, navigation: bool = False) -> DataFrame:
    """section_id and its paragraphs, with empty lines between; what stands in callouts is theirs.  navigation: with the navigation tables as text where they stand."""
    return part(placed, "whole_texts" if navigation else "texts").drop("path")


def code_blocks(placed: DataFrame) -> DataFrame:
    """Fenced and indented blocks: node_id, section_id, position, language, text, preceding (the paragraph before it in its section), group_id."""
    return part(placed, "blocks")


def tables(placed: DataFrame) -> DataFrame:
    """Tables with headers and whether they navigate: half or more of their cells hold a link and the first header names no data."""
    return part(placed, "tables")


def table_rows(placed: DataFrame) -> DataFrame:
    """Rows of data tables: node_id, section_id, position, table_position, headers, cells."""
    return part(placed, "rows")


def navigation_text(placed: DataFrame) -> DataFrame:
    """Navigation tables as text: a line for each row, its cells under their headers."""
    return part(placed, "menus").drop("path")


def callouts(placed: DataFrame) -> DataFrame:
    """Text between callout comments (its paragraphs and lists): node_id, section_id, position, kind, text."""
    return part(placed, "callouts")


def links(placed: DataFrame) -> DataFrame:
    """Links outside code, headings and quotes: path, section_id, pos, nth, href, text, is_internal, is_anchor_only."""
    return sourced_links(placed).drop("source_kind")


def sourced_links(placed: DataFrame) -> DataFrame:
    """links with source_kind: navigation_table, table, or prose, by the table that a link's line is part of."""
    href = F.col("href")
    told = part(placed, "links").withColumn("is_internal", F.startswith(href, F.lit("/en/")) | F.startswith(href, F.lit("./")) | F.startswith(href, F.lit("../"))).withColumn("is_anchor_only", F.startswith(href, F.lit("#")))
    return told.select("path", "section_id", "pos", "nth", "href", "text", "is_internal", "is_anchor_only", "source_kind")


def held_sections(placed: DataFrame) -> DataFrame:
    """The sections that kept_sections keeps, told in the walk: those with a text, code, rows of data, callouts, links, or a section under them."""
    return part(placed, "held")


def kept_sections(found: DataFrame, texts: DataFrame, used: DataFrame) -> DataFrame:
    """Sections but for those without text that are nobody's parent and hold nothing (used: section_id of atoms and links)."""
    needed = found.select(F.col("parent_id").alias("section_id")).where("section_id IS NOT NULL").union(used.select("section_id")).union(texts.where("trim(text) <> ''").select("section_id")).distinct()
    return found.join(needed, "section_id", "left_semi")


def page_header(pages: DataFrame, descriptions: DataFrame, volatile: tuple[str, ...] = (), prefix: str = "", told: DataFrame | None = None) -> DataFrame:
    """path, url, title, description and its source, volatile, content_hash.  descriptions: url, description; told: the pages' parts, where they have been read."""
    own = part(_placed(pages, prefix) if told is None else told, "header").withColumn("url", F.concat(F.lit(prefix), F.translate("path", "\\", "/")))
    flag = F.lit(False)
    for v in volatile:
        flag = flag | (F.col("path") == v) | F.startswith("path", F.lit(v))
    return own.join(descriptions, "url", "left").select(
        "path", "url", F.coalesce("title", "path").alias("title"), F.coalesce("description", "quote", F.lit("")).alias("description"),
        F.when(F.col("description").isNotNull(), "index").when(F.col("quote").isNotNull(), "blockquote").otherwise("missing").alias("description_source"), flag.alias("volatile"), "content_hash",
    )


def looks_like_prose(text: Column) -> Column:
    """Whether an indented block is prose: most lines have five words and a letter, one ends a sentence, and the first two don't begin as code."""
    rows = F.filter(F.transform(F.split(F.trim(text), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    prose = F.filter(rows, lambda x: (F.size(F.split(x, r"\s+")) >= 5) & F.rlike(x, F.lit("[A-Za-z]")))
    code = F.exists(F.slice(rows, 1, 2), lambda x: F.rlike(x, F.lit(r"^[/$>{\[|#<]")))
    return F.coalesce((F.size(rows) > 0) & ~code & (F.size(prose) / F.size(rows) >= 0.6) & F.exists(prose, lambda x: F.rlike(x, F.lit(r"[.!?](\s|$)"))), F.lit(False))

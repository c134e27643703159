"""Quality checks of records and of the graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import parse

#: Markup that must not be left in a section's prose (fixed values).
LEAKS = (r"<!--", r"</?[A-Z][A-Za-z]*", r"^\s*export\s+(const|function|default)", r"theme=\{", r"</?(div|span|img|p)\b")


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def orphans(children: DataFrame, parents: DataFrame, on: str) -> DataFrame:
    return children.join(parents.select(on), on, "left_anti")


def missing(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).distinct().join(have.select(key), key, "left_anti")


def leaks(text: Column) -> Column:
    """Whether prose still holds markup, code spans left out."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), "`[^`]*`", "")
    return F.exists(F.array(*[F.lit(f"(?m){p}") for p in LEAKS]), lambda p: F.rlike(bare, p))


def rates(nodes: DataFrame, by: str, conditions: dict[str, Column]) -> DataFrame:
    """Counts of nodes and the percentage of each condition, by label."""
    n = F.count("*")
    return nodes.groupBy(by).agg(n.alias("n"), *[F.round(100.0 * F.count_if(c) / n, 1).alias(k) for k, c in conditions.items()])


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of the two has, with the side."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).union(b.exceptAll(a).withColumn("side", F.lit("right")))


def counts(edges: DataFrame, by: str = "type") -> DataFrame:
    """How many edges of each type there are, and how many lack a target."""
    return edges.groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.col("target_id").isNull()).alias("n_null"))


def group_counts(rows: DataFrame, *by: str) -> DataFrame:
    """How many rows there are of each combination of the columns."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def common(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The keys that both have, each once."""
    return a.select(key).intersect(b.select(key))


def hits(text: Column, phrases: list[str]) -> Column:
    """The phrases that the lower-cased text holds."""
    return F.filter(F.array(*map(F.lit, phrases)), lambda p: F.contains(F.lower(text), p))


def update_cards(pages: DataFrame, sections: DataFrame) -> DataFrame:
    """path, cards, sections of the pages (path, text) whose update cards outside code aren't as many as their synthesized sections (path, synthesized)."""
    opened = F.regexp_count("line", F.lit(r"<Update\b"))
    cards = parse.lines(pages).where("fence = 0").groupBy("path").agg(F.sum(opened).cast("long").alias("cards"))
    made = sections.where("synthesized").groupBy("path").agg(F.count("*").alias("sections"))
    both = cards.join(made, "path", "full_outer").select("path", F.coalesce("cards", F.lit(0)).cast("long").alias("cards"), F.coalesce("sections", F.lit(0)).cast("long").alias("sections"))
    return both.where("cards <> sections")


def one_pass(nodes: DataFrame, edges: DataFrame, bounds: dict[str, tuple[int, int | None]], required: tuple[str, ...] = (), pointing: tuple[str, ...] = ()) -> DataFrame:
    """check, name, n, passed: all counts of a graph and what they are checked against, by one scan of the nodes and one of the edges.

    nodes: node_id, node_label.  edges: type, target_id.  count: nodes of a label or edges of a type, with the (least, most) of ``bounds`` where it has some; a name of bounds that doesn't occur
    counts 0.  duplicate: node ids that occur more than once, by label.  required: whether the id is there.  dangling: edges of the types in ``pointing`` without their target, by type;
    untargeted: edges without a target id.  Nodes and edges meet once, by id, after they have been counted by id.
    """
    spark = nodes.sparkSession
    met = nodes.select(F.col("node_id").cast("string").alias("id"), F.lit("node").alias("kind"), F.col("node_label").alias("name")).unionByName(edges.select(F.col("target_id").cast("string").alias("id"), F.lit("edge").alias("kind"), F.col("type").alias("name")))
    by_id = met.groupBy("id", "kind", "name").agg(F.count("*").alias("n")).groupBy("id").agg(F.collect_list(F.struct("kind", "name", "n")).alias("held"))  # labels and types are few
    there = F.exists("held", lambda h: h["kind"] == "node")
    row = lambda check, name, n: F.struct(F.lit(check).alias("check"), name.alias("name"), n.cast("long").alias("n"))
    copies = F.aggregate("held", F.lit(0).cast("long"), lambda a, h: a + F.when(h["kind"] == "node", h["n"]).otherwise(0))
    told = F.flatten(F.transform("held", lambda h: F.when(h["kind"] == "node", F.array(row("count", h["name"], h["n"]), row("duplicate", h["name"], (copies > 1).cast("int")))).otherwise(
        F.array(row("count", h["name"], h["n"]), row("dangling", h["name"], F.when(h["name"].isin(*pointing) & F.col("id").isNotNull() & ~there, h["n"]).otherwise(0)), row("untargeted", h["name"], F.when(F.col("id").isNull(), h["n"]).otherwise(0))))))
    found = F.when(F.col("id").isin(*required) & there, F.array(row("required", F.col("id"), F.lit(1)))).otherwise(F.array().cast("array<struct<check:string,name:string,n:bigint>>"))
    given = [("count", name, 0) for name in bounds] + [("required", i, 0) for i in required]
    sums = by_id.select(F.explode(F.concat(told, found)).alias("x")).select("x.*").unionByName(spark.createDataFrame(given, "check string, name string, n long")).groupBy("check", "name").agg(F.sum("n").alias("n"))
    least, most = F.lit(True), F.lit(True)
    for name, (lo, hi) in bounds.items():
        least = F.when(F.col("name") == name, F.col("n") >= lo).otherwise(least)
        most = most if hi is None else F.when(F.col("name") == name, F.col("n") <= hi).otherwise(most)
    passed = F.when(F.col("check") == "count", least & most).when(F.col("check") == "required", F.col("n") > 0).otherwise(F.col("n") == 0)
    return sums.select("check", "name", "n", passed.alias("passed"))

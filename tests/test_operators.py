"""Small cases of the operators: markup, resolution, entities, fusion, budgets, store, metrics, incremental ingest."""

import hashlib
import json
import re
from collections import Counter
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import contexts as cx
from tessera.functions import text as tx
from tessera.functions.vectors import cosine
from tessera.operators import audit, choose, entities, evaluate, graph, load, parse, resolve, search, store
from tessera.operators.textindex import TextIndex
from tessera.operators.vectorindex import VectorIndex
from tessera.plans import calls as calls_of
from tessera.plans.build import build
from tessera.plans import enrich, models, qa
from tessera.sources import records, shared
from tessera.sources.parts import Parts
from tessera.streaming import incremental


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return frame.select(column.alias("x")).first()["x"]


PAGE = """# Guide

> What it is about

Intro with [a link](../other.md#part-two) and `code`.

## First Part

<Note>Take care of [this](/docs/en/x.md).</Note>

Some prose before.

<CodeGroup>
```python title
def f(): pass
## no heading
```
```ts
x
```
</CodeGroup>

### Deep & sub
text

| Tool | What |
|------|------|
| `Read` | reads [files](#a) |
| `Write` | writes |

## First Part

| Topic | Where |
|:--|:--|
| [a](/a) | [b](/b) |

## Empty

export const Thing = () => {
  ## not a heading
}

#### Four
last
"""


@pytest.fixture(scope="module")
def page(spark):
    frame = spark.createDataFrame([("en/guide.md", PAGE), ("en/bare.md", ""), ("en/null.md", None)], "path string, text string")
    found, placed = parse.located(frame, "https://h/docs/")
    return frame, found.cache(), placed.cache()


def test_sections(page):
    _, found, _ = page
    rows = {r["anchor"]: r for r in found.where("path = 'en/guide.md'").collect()}
    assert sorted(rows) == ["deep-sub", "empty", "first-part", "first-part-1", "four", "overview"]
    assert rows["deep-sub"]["breadcrumb"] == "Guide > First Part > Deep & sub" and rows["deep-sub"]["parent_id"] == "https://h/docs/en/guide.md#first-part"
    assert rows["overview"]["position"] == 0 and rows["four"]["level"] == 4 and rows["four"]["parent_id"].endswith("#empty")
    assert found.where("path = 'en/bare.md'").first()["anchor"] == "overview"


def test_code_blocks_and_groups(page):
    _, _, placed = page
    rows = parse.code_blocks(placed).orderBy("pos").collect()
    assert [(r["language"], r["text"], r["position"], r["preceding"]) for r in rows] == [("python", "def f(): pass\n## no heading", 0, "Some prose before."), ("ts", "x", 1, "Some prose before.")]
    assert rows[0]["group_id"] == rows[1]["group_id"] is not None
    assert rows[0]["node_id"] == hashlib.sha256(f"{rows[0]['section_id']}|0|code-python".encode()).hexdigest()[:16]


def test_tables_and_navigation(page):
    _, _, placed = page
    rows = parse.table_rows(placed).orderBy("position").collect()
    assert [(r["headers"], r["cells"]) for r in rows] == [(["tool", "what"], ["`Read`", "reads files"]), (["tool", "what"], ["`Write`", "writes"])]
    assert [r["text"] for r in parse.navigation_text(placed).collect()] == ["- topic: a; where: b"]


def test_callouts_links_and_text(page):
    _, found, placed = page
    assert [(r["kind"], r["text"]) for r in parse.callouts(placed).collect()] == [("note", "Take care of this.")]
    hrefs = [r["href"] for r in parse.links(placed).orderBy("pos", "nth").collect()]
    assert hrefs == ["../other.md#part-two", "/docs/en/x.md", "#a", "/a", "/b"]
    text = {r["section_id"].split("#")[1]: r["text"] for r in parse.section_text(placed).collect()}
    assert "Intro with a link and `code`." in text["overview"] and text["four"] == "last" and "export" not in str(text)
    used = parse.code_blocks(placed).select("section_id")
    kept = {r["anchor"] for r in parse.kept_sections(found, parse.section_text(placed), used).collect()}
    assert "empty" in kept and "first-part-1" not in kept  # a parent stays; a heading over nothing goes


def parsed(spark, text):
    import textwrap

    found, placed = parse.located(spark.createDataFrame([("p.md", textwrap.dedent(text))], "path string, text string"))
    return found.cache(), placed.cache()


def test_nested_wrappers_and_their_indentation(spark):
    found, placed = parsed(spark, """
        # Source

        ## Use

        <Tabs>
          <Tab title="a > b">
            Prose before.

            <CodeGroup>
              ```python Python theme={null}
              def f():
                  pass
              ```

              ```ts
              let x = {a: 1}
              ```
            </CodeGroup>

            | Tool | What |
            | - | - |
            | `Read` | reads |

            ## Inner
            text
          </Tab>
        </Tabs>

        After.
        """)
    rows = parse.code_blocks(placed).orderBy("pos").collect()
    assert [(r["language"], r["text"], r["preceding"]) for r in rows] == [("python", "def f():\n    pass", "Prose before."), ("ts", "let x = {a: 1}", "Prose before.")] and rows[0]["group_id"] == rows[1]["group_id"] is not None
    assert [r["cells"] for r in parse.table_rows(placed).collect()] == [["`Read`", "reads"]]
    assert {r["anchor"] for r in found.collect()} == {"use", "inner"}
    text = {r["section_id"].split("#")[1]: r["text"] for r in parse.section_text(placed).collect()}
    assert text == {"use": "**a > b**".strip("*") + "\n\nProse before.", "inner": "text\n\nAfter."}


@pytest.mark.parametrize("block", [
    'export const Widget = ({platform = "all"}) => {\n  const values = {\n    one: "two"\n  };\n  return <div>{values.one}</div>;\n};', "export const Widget = () => {\n  return <>\n    {items.map(item => <span>{item.label}</span>)}\n  </>;\n};",
    "export default Widget", "export const x = 5", 'export const s = "{";', "{/* a comment */}", "{\n  one,\n  two\n}", "export const list = [\n  1,\n];", "export const f = (\n  a\n) => a;"])
def test_exports_and_expressions_go_and_what_follows_stays(spark, block):
    found, placed = parsed(spark, f"# Source\n\n{block}\n\n## Real content\n\nKeep this paragraph.\n\n```js\nexport const y = {{\n{{a}}\n```\n")
    assert [r["anchor"] for r in found.collect()] == ["real-content"]
    assert [r["text"] for r in parse.section_text(placed).collect()] == ["Keep this paragraph."]
    assert [r["text"] for r in parse.code_blocks(placed).collect()] == ["export const y = {\n{a}"]


def test_a_page_of_statements_alone_is_an_empty_page(spark):
    found, placed = parsed(spark, "export const x = 5")
    assert [r["anchor"] for r in found.collect()] == ["overview"] and parse.section_text(placed).count() == 0


def test_braces_that_never_end_are_text(spark):
    _, placed = parsed(spark, "## A\n\n{open and more\n\nlast")
    assert [r["text"] for r in parse.section_text(placed).collect()] == ["{open and more\n\nlast"]


def test_lists(spark):
    _, placed = parsed(spark, """
        ## Files

        Intro:

        * **One**: first
          goes on
          * two [x](/x)

            more of two
          * three

        - four

        Then.

        1. a
           - b
        2. c
        3) d
        """)
    assert [r["text"] for r in parse.lists(placed).orderBy("pos").collect()] == ["- One: first goes on\n  - two x more of two\n  - three\n- four", "1. a\n  1. b\n3. c\n4. d"]
    assert [r["text"] for r in parse.paragraphs(placed).orderBy("pos").collect()][::2] == ["Intro:", "Then."] and parse.code_blocks(placed).count() == 0


def test_indented_code_and_prose(spark):
    _, placed = parsed(spark, """
        ## A

        Before it.

            x = 1

              y = 2

        para
            goes on

            this line has many plain words in it.
            and so does this second line of it.

        * item

            of the item with many words
        """)
    assert [(r["language"], r["text"], r["preceding"], r["position"]) for r in parse.code_blocks(placed).collect()] == [("", "x = 1\n\n  y = 2".replace("\n\n", "\n"), "Before it.", 0)]
    assert [r["text"] for r in parse.paragraphs(placed).orderBy("pos").collect()] == ["Before it.", "para goes on", "this line has many plain words in it.\nand so does this second line of it.", "- item of the item with many words"]


def test_update_cards_are_synthesized_sections(spark):
    found, placed = parsed(spark, '# Log\n\n<Update label="2.1 > 2.0" description="x">\n  * one\n</Update>\n\n## Plain\n\nx\n')
    assert {r["heading"]: r["synthesized"] for r in found.collect()} == {"2.1 > 2.0": True, "Plain": False}
    frame = spark.createDataFrame([("p.md", '# Log\n\n<Update label="2.1 > 2.0" description="x">\n  * one\n</Update>\n\n## Plain\n\nx\n')], "path string, text string")
    assert audit.update_cards(frame, found).collect() == [] and [tuple(r) for r in audit.update_cards(frame, found.where("NOT synthesized")).collect()] == [("p.md", 1, 0)]


def test_hydration_labels_and_citations_out_of_range(spark):
    nodes = spark.createDataFrame([("Tool:a:b", "text", "u"), ("x", "more", None)], "node_id string, indexed_text string, url string")
    rows = spark.createDataFrame([("Tool:a:b", "s1", "old"), ("gone", "s2", "old")], "node_id string, seed_id string, url string")
    got = store.hydrated(rows, nodes, ["indexed_text", "url"]).select("node_id", "seed_id", "indexed_text", "url", tx.entity_label(F.col("node_id")).alias("label"))
    assert {tuple(r) for r in got.collect()} == {("Tool:a:b", "s1", "text", "u", "Tool"), ("gone", "s2", None, None, "gone")}
    check = one(spark, tx.citation_check(F.lit("a [1] b [99999999999999999999999]"), F.lit(2), F.array(F.lit(1))))
    assert not check["ok"] and check["missing"] == [] and check["out_of_range"] == [2**63 - 1]


@pytest.mark.parametrize("text", ["<Card\n  title='" + "x" * 1000 + "'\n  href=\"/a\">\nbody\n</Card>\n"])
def test_open_tags_of_any_length_are_one_tag(spark, text):
    assert normal(spark, text) == "**" + "x" * 1000 + "**<!--title-->\n\nbody"


def normal(spark, text):
    """The page as plain Markdown, without empty lines at its ends and with at most one between others."""
    return squeezed(parse.normalised(spark.createDataFrame([("p.md", text)], "path string, text string")).first()["text"])


def squeezed(text):
    return re.sub(r"[ \t]*\n(?:[ \t]*\n)+", "\n\n", text).strip()


#: Fenced blocks: (lines, spans).
FENCED = [
    ("````md|```py|x|```|````|after", [(0, 4, True)]), ("```|a|~~~|b|```|after|## Z", [(0, 4, True)]), ("~~~ x|```|~~~|~~~~|a|~~~|~~~~~", [(0, 2, True), (3, 6, True)]), ("a|```js|b|``` not a mark|c", [(1, 4, False)]),
    ("``` a`b|text", []), ("```|  ```  |x", [(0, 1, True)]), ("", []), ("```", [(0, 0, False)]), ("~~~ a`b|c|~~~", [(0, 2, True)]), ("> ```|x|> ```", []),
]


def test_fences_by_mark_and_length(spark):
    rows = spark.createDataFrame([(i, t.split("|")) for i, (t, _) in enumerate(FENCED)], "i int, ls array<string>")
    got = {r["i"]: [tuple(x) for x in r["s"]] for r in rows.select("i", parse.fence_spans(F.col("ls")).alias("s")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(FENCED)}
    pages = rows.select(F.col("i").cast("string").alias("path"), F.array_join("ls", "\n").alias("text"))
    for path, own in groupby(parse.lines(pages).orderBy(F.col("path").cast("int"), "pos").collect(), key=lambda r: int(r["path"])):
        own = list(own)
        assert [r["line"] for r in own] == FENCED[path][0].split("|") and [r["pos"] for r in own] == list(range(len(own)))
        for r in own:
            span = next(((k, s) for k, s in enumerate(FENCED[path][1], 1) if s[0] <= r["pos"] <= s[1]), None)
            assert (r["fence"], r["fence_no"], r["mark"]) == ((1, span[0], r["pos"] == span[1][0] or (span[1][2] and r["pos"] == span[1][1])) if span else (0, 0, False))


#: Statements: (page, what stays).
STATEMENTS = [
    ("export const A = () => {\nreturn (\n<div/>\n);\n};\nkept", "kept"), ("export const A = () => {\n  if (x) {\n}\n  return 1\n};\n\nkept", "kept"), ("export function F({a},\n  b)\n{\n  return `}`\n}\nkept", "kept"),
    ("export const s = `a\n{ never\n# No heading\n`;\nkept", "kept"), ("export const x =\n  5;\nkept", "kept"), ("export const c = { /* } \n } */ a: 1 // }\n}\nkept", "kept"), ("export const q = 'it\\'s {';\nkept", "kept"),
    ("export const broken = {\n  a: (\n};\n\nkept", "kept"), ("export const lost = {\n  a: (\n\nkept\n\n## H", "kept\n\n## H"), ("{\n  a,\n  \"}\"\n}\nkept", "kept"), ("{open\n\n## H\n\n{closed}\nkept", "{open\n\n## H\n\nkept"),
    ("export const u = \"https://h/{\";\nexport const v = a\n  .b({\n  })\n  .c;\nkept", "kept"), ("```js\nexport const y = {\n{a}\n```\nkept", "```js\nexport const y = {\n{a}\n```\nkept"), ("exports are kept", "exports are kept"), ("a {b} kept", "a {b} kept"),
]
#: Components: (page, as plain Markdown).
COMPONENTS = [
    ("in <Tab title=\"A\">in <b>bold</b> text</Tab> out", "in\n\n**A**<!--title-->\n\nin **bold** text\n\n out"), ("<Tab title={`T > ${a}`}>x</Tab>", "**T > ${a}**<!--title-->\n\nx"), ("<Card title={{a: {b: '}'}}}>x</Card>", "**{a: {b: '}'}}**<!--title-->\n\nx"),
    ("a<Hero>\n<b>gone</b>\n```\n</Hero>\n```\n</Hero>b", "ab"), ("a <Hero x=\"1\"/> b", "a  b"), ("<Steps>\n  <Step>\n    One\n    two\n  </Step>\n</Steps>", "1. \n   One\n   two"),
    ("<Steps>\n  <Step title=\"T\">\n    One\n\n    ```py\n    x\n      y\n    ```\n  </Step>\n</Steps>\nend", "**T**<!--title-->\n\nOne\n\n```py\nx\n  y\n```\n\nend"), ("<p>a<p>b</p>", "<p>a\n\nb"), ("</p>a</b><b>c</b>", "</p>a</b>**c**"),
    ("<ParamField path=\"n\" type=\"int\" required>\n  text\n</ParamField>", "**`n` (int) **required****\n\ntext"), ("<ResponseField name='m'/>", "**`m`**"), ("<Note>\n  a\n\n  <Tip>b</Tip>\n</Note>", "<!--callout:note-->\n\na\n\n<!--callout:tip-->\nb\n<!--/callout-->\n\n<!--/callout-->"),
    ("<Update label=\"v1\" description=\"d\" tags={[\"a\"]}>\n* x\n</Update>", "## v1 <!--update-->\n\nd\n\n* x"), ("<a href=\"/x\">t <b> u </b></a> <a>v</a> <b></b>w <i>  </i>", "[t **u**](/x) v w"), ("<Frame>\n  <img src=\"/p.png\" alt='say \"x\"' />\n</Frame>", "<!--image path=\"/p.png\" alt=\"say &quot;x&quot;\"-->"),
    ("a < b, <https://h> and List<String> or <Thing x>", "a < b, <https://h> and List<String> or <Thing x>"), ("<Card title='title=\"no\"' data-title='x'>y</Card>", "**title=\"no\"**<!--title-->\n\ny"), ("```\n<Note>x</Note>\n```", "```\n<Note>x</Note>\n```"), ("<Card " + " ".join(f'a{i}="{i}"' for i in range(5000)) + ">x</Card>", "x"),
    ("Head\n====\n\ntwo\nlines\n---\n\n- item\n---\n\n> quote\n---\n\n```\na\n---\n```\n\n---", "# Head\n\n## two lines\n\n- item\n---\n\n> quote\n---\n\n```\na\n---\n```\n\n---"), ("---\ntitle: x\n---\n# A", "# A"), ("<style>\n# no\n</style>x<script src='a'/>", "x"),
]


@pytest.mark.parametrize("cases", [STATEMENTS, COMPONENTS], ids=["statements", "components"])
def test_pages_as_plain_markdown(spark, cases):
    frame = spark.createDataFrame([(str(i), t) for i, (t, _) in enumerate(cases)] + [("null", None)], "path string, text string")
    got = {r["path"]: squeezed(r["text"]) for r in parse.normalised(frame).collect()}
    assert got == {str(i): want for i, (_, want) in enumerate(cases)} | {"null": ""}


def test_containers_and_their_texts(spark):
    found, placed = parsed(spark, """
        # Page

        > one
        > **two**
        lazy [no](/no)

        ## A

        text
        > # quoted
        >
        > - item
        > ```
        > code
        > ```
        > > inner
        ***
        after

        <Frame>
          <img src="/i.png" alt="An image" />
        </Frame>

        <Note>
          First
          goes on.

          * a
          * b

          ```py
          x
          ```
        </Note>

        1. a

           ```sh
           ls
             -l
           ```
        2. b

        Under
        -----
        end
        """)
    assert [(r["heading"], r["level"]) for r in found.orderBy("pos").collect()] == [("Overview", 2), ("A", 2), ("Under", 2)]
    text = {r["section_id"].split("#")[1]: r["text"] for r in parse.section_text(placed).collect()}
    assert text == {"overview": "> one two lazy no", "a": "text\n\n> quoted item inner\n\n---\n\nafter\n\n[image: An image](/i.png)\n\n1. a\n2. b", "under": "end"}
    assert [(r["kind"], r["text"], r["section_id"]) for r in parse.callouts(placed).collect()] == [("note", "First goes on.\n\n- a\n- b", "p.md#a")]
    assert [(r["language"], r["text"]) for r in parse.code_blocks(placed).orderBy("pos").collect()] == [("py", "x"), ("sh", "ls\n  -l")]


def test_quotes_of_many_lines_describe_a_page(spark):
    frame = spark.createDataFrame([("p.md", "# T\n\n> one\n> two\nthree\n\n> other")], "path string, text string")
    assert parse.page_header(frame, spark.createDataFrame([], "url string, description string")).first()["description"] == "one two three"


def test_all_rules_and_labels_count(spark):
    rules = spark.createDataFrame([(i, f"p{i}.md", None, ["tool"], "Tool", "row") for i in range(10_001)], entities.RULE_SCHEMA)
    rows = spark.createDataFrame([(f"r{i}", "s", f"p{i}.md", 0, 0, ["tool"], [f"n{i}"]) for i in (0, 10_000)], "node_id string, section_id string, path string, table_position int, position int, headers array<string>, cells array<string>")
    assert {r["name"] for r in entities.from_rows(rows, rules).collect()} == {"n0", "n10000"}
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(9)] + [("n9", "n3")], "source_id string, target_id string")
    roots = spark.createDataFrame([("n0",)], "node_id string")
    assert {r["node_id"]: r["depth"] for r in graph.closure(edges, roots).collect()} == {f"n{i}": i for i in range(10)}  # deeper than sections go, and with a cycle


def test_hybrid_search_finds_wanted_labels_among_many(spark):
    nodes = spark.createDataFrame([("a", "Section", "alpha beta", [1.0, 0.0])], "node_id string, node_label string, indexed_text string, embedding array<double>")
    none = spark.createDataFrame([], "node_id string, label string, name string")
    labels = [f"Other{i}" for i in range(300)] + ["Section"]
    asked = spark.createDataFrame([(1, "alpha", labels, [], [1.0, 0.0])], "query_id int, text string, target_labels array<string>, keywords array<string>, vector array<double>")
    assert [r["node_id"] for r in search.hybrid_search(nodes, none, asked).collect()] == ["a"]


def test_page_header(spark, page):
    frame, _, _ = page
    index = spark.createDataFrame([("https://h/docs/en/bare.md", "from the index")], "url string, description string")
    rows = {r["path"]: r for r in parse.page_header(frame, index, ("en/bare",), "https://h/docs/").collect()}
    assert (rows["en/guide.md"]["title"], rows["en/guide.md"]["description"], rows["en/guide.md"]["description_source"]) == ("Guide", "What it is about", "blockquote")
    assert rows["en/bare.md"]["description_source"] == "index" and rows["en/bare.md"]["volatile"] and not rows["en/guide.md"]["volatile"]


@pytest.mark.parametrize("text, prose", [("this line has many plain words.\nand so does this second line", True), ("$ run this command with five words.", False), ("x = 1\ny = 2", False), ("", False), (None, False)])
def test_prose_or_code(spark, text, prose):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(parse.looks_like_prose(F.col("t"))).first()[0] is prose


@pytest.mark.parametrize("href, status, target", [
    ("b.md", "page", "u/en/b.md"), ("./b", "page", "u/en/b.md"), ("/docs/en/b#part-one", "section", "u/en/b.md#part-one"), ("b#Part%20One", "section", "u/en/b.md#part-one"), ("b#partone", "section", "u/en/b.md#part-one"),
    ("b#nothing", "unresolved", None), ("../missing", "unresolved", None), ("https://site.example/docs/en/b", "page", "u/en/b.md"), ("https://other.example/docs/en/b", "external", None), ("mailto:x@y", "external", None),
    ("b#ce-x", "dom_anchor", None), ("", "external", None), ("`b.md`", "page", "u/en/b.md"), ("old", "page", "u/en/new.md"), ("sub", "page", "u/en/sub/index.md"), ("#part-one", "unresolved", None)])
def test_resolution(spark, href, status, target):
    pages = spark.createDataFrame([(p, f"u/{p}") for p in ("en/a.md", "en/b.md", "en/new.md", "en/sub/index.md")], "path string, url string")
    sections = spark.createDataFrame([("u/en/b.md#part-one", "u/en/b.md", "part-one", 0), ("u/en/b.md#x-y", "u/en/b.md", "x-y", 1), ("u/en/b.md#xy-1", "u/en/b.md", "xy-1", 2)], "section_id string, page_url string, anchor string, position int")
    links = spark.createDataFrame([(1, "en/a.md", "u/en/a.md#s", href, "t", "prose")], "link_id long, path string, section_id string, href string, text string, source_kind string")
    got = resolve.resolve(links, pages, sections, "site.example", {"en/old.md": "en/new.md"})
    row = got.first()
    assert (row["status"], row["target_section_id"] or (row["page_url"] if status == "page" else None)) == (status, target)
    edges = resolve.link_edges(got, sections).collect()
    assert [e["target_id"] for e in edges] == ([target] if target else [])
    assert resolve.unresolved(got).count() == (status == "unresolved")


def test_entities_by_rule_and_mentions(spark):
    rows = spark.createDataFrame([("r1", "p#a", "en/tools-reference.md", 0, 0, ["tool"], ["`Read`", "reads", "No"]), ("r2", "p#a", "en/tools-reference.md", 0, 1, ["tool"], ["`Read`", "again", ""]), ("r3", "q#hook-lifecycle", "en/hooks.md", 0, 0, ["event"], ["`Stop`", "stops"]), ("r4", "q#other", "en/hooks.md", 0, 0, ["event"], ["`No`", ""]), ("r5", "p#a", "x.md", 0, 0, ["tool"], ["`No`"])], "node_id string, section_id string, path string, table_position int, position int, headers array<string>, cells array<string>")
    found = entities.from_rows(rows, spark.createDataFrame(entities.RULES, entities.RULE_SCHEMA))
    assert {(r["entity_id"], r["description"], r["permission_required"]) for r in entities.catalogue(found).collect()} == {("Tool:Read", "reads", "No"), ("Hook:Stop", "stops", None)}
    assert {(r["source_id"], r["target_id"]) for r in entities.defines(found).collect()} == {("r1", "Tool:Read"), ("r2", "Tool:Read"), ("q#hook-lifecycle", "Hook:Stop")}
    sections = spark.createDataFrame([("s1", "A > Read", None), ("s2", "", "use Reader or read"), ("s3", "", "x.Read-y"), ("s4", None, "a+b"), ("s5", "", "")], "section_id string, breadcrumb string, text string")
    names = spark.createDataFrame([("Read", "Tool:Read"), ("+", "Tool:+")], "name string, entity_id string")
    assert {(r["source_id"], r["evidence"]) for r in entities.mention_edges(sections, names).collect()} == {("s1", "Read"), ("s3", "Read")}
    assert {(r["section_id"], r["name"]) for r in entities.mentions(sections.withColumn("text", F.replace("text", F.lit("a+b"), F.lit("a + b"))), names).collect()} >= {("s4", "+")}


def test_fusion_goldens(spark):
    rows = [("q", "a", "S", 2.0, 1.0), ("q", "b", "S", 1.0, None), ("q", "c", "S", None, 2.0)]
    got = search.rrf(spark.createDataFrame(rows, "query_id string, node_id string, node_label string, bm25_score double, vector_score double"), ["bm25_score", "vector_score"], ["query_id"], ["node_id", "node_label"]).orderBy("rank").collect()
    assert [(r["node_id"], r["rrf_score"]) for r in got] == [("a", round(1 / 61 + 1 / 62, 9)), ("c", round(1 / 61, 9)), ("b", round(1 / 62, 9))]


def test_entity_budget(spark):
    schema = "query_id int, node_id string, node_label string, rerank_score double, bm25_score double, expansion_origin string"
    rows = [(1, f"d{i}", "Section", 1 - i / 10, None, None) for i in range(9)] + [(1, "e1", "Tool", 0.95, None, "defines:x"), (1, "e2", "Hook", 0.05, 3.0, None), (1, "e3", "Tool", 0.9, None, "defines:x")]
    got = [r["node_id"] for r in search.rerank_budget(spark.createDataFrame(rows, schema), ["query_id"]).orderBy("rank").collect()]
    assert got == ["d0", "e1", "d1", "d2", "d3", "d4", "d5", "e2"]
    assert [r["node_id"] for r in search.rerank_budget(spark.createDataFrame(rows, schema), ["query_id"], 3, 0).orderBy("rank").collect()] == ["d0", "e1", "d1"]


@pytest.mark.parametrize("label, text, crumb, synthesized, lead, want", [
    ("Section", "---", "a > b", False, None, "skip"), ("Section", None, None, False, None, "skip"), ("Section", "x" * 201, "a > b > c", False, None, "template"), ("Section", "x" * 200, "a > b > c", False, None, "llm"), ("Section", "x" * 201, "a > b", False, None, "llm"), ("Section", "x", "a", True, None, "template"),
    ("CodeBlock", "x" * 1001, None, False, "y" * 201, "template"), ("CodeBlock", "x" * 1000, None, False, "y" * 201, "llm"), ("CodeBlock", "x" * 1001, None, False, "Example:", "llm"), ("Tool", "x", None, False, None, "llm"), ("Chunk", "x", None, False, None, "skip")])
def test_routes(spark, label, text, crumb, synthesized, lead, want):
    frame = spark.createDataFrame([(label, text, crumb, synthesized, lead)], "l string, t string, c string, s boolean, p string")
    assert frame.select(cx.route(*map(F.col, "ltcsp"))).first()[0] == want


@pytest.mark.parametrize("label, name, context, want", [("Section", "x", "anything", None), ("Tool", "Read", "Read: reads files", None), ("Tool", "Read", "reads", "prefix"), ("PermissionMode", "plan", "plan: as default", "sibling"), ("PermissionMode", "plan", "plan: words", "plan words"), ("PermissionMode", "plan", "plan: read-only until approval by EnterPlanMode", None), ("PermissionMode", "default", "default: baseline read only session", None)])
def test_entity_contexts(spark, label, name, context, want):
    frame = spark.createDataFrame([(label, name, context)], "l string, n string, c string")
    assert frame.select(cx.entity_context_error(F.col("l"), F.col("n"), F.col("c"), F.array(F.lit("default"), F.lit("plan")))).first()[0] == want


def test_counterpart_context_is_cut_at_a_sentence(spark):
    frame = spark.createDataFrame([("short",), ("word " * 200,), ("Cross-language counterpart: done",)], "c string")
    short, long, done = [r[0] for r in frame.select(cx.counterpart_context(F.col("c"))).collect()]
    assert short == "Cross-language counterpart: short" and len(long) <= 600 and long.endswith(".") and done == "Cross-language counterpart: done"


def test_enrichment_rejects_and_embeds(spark):
    rows = [("1", "Section", "x" * 300, "a > b > c", "T", "parent", False), ("2", "Section", "", "a", "T", "", False), ("3", "Callout", "careful with this", "a", "T", "", False), ("4", "Callout", "the", "a", "T", "", False)]
    nodes = spark.createDataFrame(rows, "node_id string, label string, raw_text string, breadcrumb string, page_title string, parent_text string, synthesized boolean")
    none = F.array().cast("array<string>")
    nodes = nodes.withColumn("language", F.lit(None).cast("string")).withColumn("preceding", F.lit("")).withColumn("headers", none).withColumn("cells", none).withColumn("callout_kind", F.lit("note")).withColumn("name", F.when(F.col("node_id") == "4", "The").otherwise("Name"))
    good, bad = enrich.enrich(nodes)
    rows = {r["node_id"]: r for r in good.collect()}
    assert rows["1"]["context_source"] == "template" and rows["2"]["indexed_text"] == "" and rows["2"]["embedding"] is None
    assert rows["3"]["indexed_text"] == "Name: careful with this\n\n[note] careful with this" and abs(sum(x * x for x in rows["3"]["embedding"]) - 1) < 1e-9
    assert [(r["node_id"], r["error"]) for r in bad.collect()] == [("4", "too short")]


def test_answers_with_and_without_results(spark):
    nodes = spark.createDataFrame([("n1", "Section", "apples grow on trees", "", "u", "a", "B", "T"), ("n2", "Callout", "pears too", "", "u", "a", "B", "")], "node_id string, node_label string, indexed_text string, raw_text string, url string, anchor string, breadcrumb string, title string").withColumn("embedding", models.embed(F.col("indexed_text")))
    names = spark.createDataFrame([], "node_id string, label string, name string")
    asked = spark.createDataFrame([(1, "where do apples grow")], "query_id int, question string")
    row = qa.answer(nodes, names, asked).first()
    assert row["citations"][0]["node_id"] == "n1" and row["answer"].endswith("[1]") and not row["no_results"]
    nothing = qa.answer(nodes.limit(0), names, asked).first()
    assert nothing["no_results"] and nothing["citations"] == [] and nothing["answer"] == qa.NO_RESULTS


def test_store(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "node_id string, v int, keep string")
    new = spark.createDataFrame([("a", None), ("c", 3)], "node_id string, v int")
    assert {tuple(r) for r in store.upsert(old, new, ["node_id"]).collect()} == {("a", None, "x"), ("b", 2, "y"), ("c", 3, None)}
    assert {tuple(r) for r in store.upsert(old, new, ["node_id"], keep_when_null=True).collect()} == {("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)}
    with pytest.raises(Exception, match="an update has no node"):
        store.write_properties(old, new, ["node_id"]).collect()
    with pytest.raises(ValueError):
        store.resume(old, "other")


def test_incremental_ingest(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "id string, body string"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    run = lambda: incremental.ingest(spark, source, schema, str(tmp_path / "out"), str(tmp_path / "cp"), "id", "body")
    write([("a", "one"), ("b", "two")])
    assert run() == 0
    write([("a", "one"), ("b", "TWO"), ("c", "three")])
    assert run() == 1
    rows = lambda: {(r["key"], r["text"], r["version"]) for r in incremental.table(spark, str(tmp_path / "out")).collect()}
    assert rows() == {("a", "one", 0), ("b", "TWO", 1), ("c", "three", 1)}
    write([("a", "one"), ("c", "three")])
    before = Parts(spark, str(tmp_path / "out"))
    assert run() == 2 and Parts(spark, str(tmp_path / "out")).version == before.version == 1  # nothing changed, nothing is written


def test_a_batch_rewrites_its_parts_only(spark, tmp_path):
    source, schema, out = str(tmp_path / "in"), "id string, body string", str(tmp_path / "out")
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    run = lambda: incremental.ingest(spark, source, schema, out, str(tmp_path / "cp"), "id", "body", parts=8)
    write([(f"k{i}", "one") for i in range(200)])
    run()
    write([("k7", "two")])
    run()
    versions = list(Parts(spark, out).state["tables"]["rows"]["parts"].values())
    assert len(versions) == 8 and versions.count("v00000001") == 1
    assert len(list((tmp_path / "out" / "v00000001" / "rows").glob("part=*"))) == 1
    assert incremental.table(spark, out).where("text = 'two'").count() == 1 and incremental.table(spark, out).count() == 200


def test_load_replaces_subtrees_and_deletes(spark, tmp_path):
    pages = lambda rows: spark.createDataFrame(rows, "page_id string, content_hash string")
    nodes = lambda rows: spark.createDataFrame(rows, "page_id string, node_id string, node_label string, raw_text string, context string")
    edges = lambda rows: spark.createDataFrame([(p, f"{a}>{b}", "LINKS_TO", a, b) for p, a, b in rows], "page_id string, edge_id string, type string, source_id string, target_id string")
    own = Parts(spark, str(tmp_path), 16)
    known = [(p, f"{p}{k}", "Section", f"text {p}{k}", f"context {p}{k}") for p in ("a", "b", "c", "d") for k in (1, 2)]
    links = [("a", "a1", "b1"), ("a", "a2", "b2"), ("b", "b1", "c1"), ("d", "d1", "a1")]
    counts = load.load(own, pages([(p, "1") for p in "abcd"]), nodes(known), edges(links), dry_run=True)
    assert {tuple(r) for r in counts.collect()} == {("pages", "merge_all", 4), ("nodes", "Section", 8), ("edges", "LINKS_TO", 4)} and own.version == -1
    load.load(own, pages([(p, "1") for p in "abcd"]), nodes(known), edges(links))
    assert own.version == 0 and load.graph(own)[0].count() == 8 and load.graph(own)[1].count() == 4
    # b changes: b1 stays as it was, b2 goes, b3 comes; d vanishes; a and c are as before
    fresh = [("b", "b1", "Section", "text b1", None), ("b", "b3", "Section", "text b3", None), ("a", "a1", "Section", "text a1", None)]
    incoming = pages([("a", "1"), ("b", "2"), ("c", "1")])
    counts = load.load(own, incoming, nodes(fresh), edges([("b", "b3", "a1"), ("a", "a1", "b1")]), whole=True, carried=("context",))
    assert {tuple(r) for r in counts.where("what = 'pages'").collect()} == {("pages", "skip_nodes", 2), ("pages", "replace", 1), ("pages", "delete", 1)}
    got, left = load.graph(own)
    assert {(r["node_id"], r["context"]) for r in got.collect()} == {("a1", "context a1"), ("a2", "context a2"), ("b1", "context b1"), ("b3", None), ("c1", "context c1"), ("c2", "context c2")}
    assert {r["edge_id"] for r in left.collect()} == {"a1>b1", "b3>a1"}  # a2>b2 and b1>c1 went with b's old nodes, d1>a1 with d
    # the same again changes nothing, and a stopped commit leaves nothing behind
    load.load(own, incoming, nodes(fresh), edges([]), whole=True)
    assert Parts(spark, str(tmp_path)).version == 1
    (tmp_path / "v00000002" / "nodes" / "part=0").mkdir(parents=True)
    assert load.graph(Parts(spark, str(tmp_path)))[0].count() == 6
    with pytest.raises(ValueError, match="doesn't replace"):
        own.commit({"pages": (incoming, F.col("page_id"), F.col("page_id"))}, [])


def test_records_round_trip(spark, tmp_path):
    rows = [{"kind": "page", "url": "u", "path": "a/é.md"}, {"kind": "section", "id": "s", "level": 2}, {"kind": "link", "href": "x"}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.jsonl").write_text("\n".join(records.as_records(rows)), encoding="utf-8")
    got = records.read_jsonl(spark, str(tmp_path / "in"))
    assert got.count() == 3 and records.page_counts(got).count() == 0
    kinds = records.split_kinds(got)
    assert kinds["page"].first()["path"] == "a/é.md" and kinds["section"].count() == 1 and "link" not in kinds
    records.write_jsonl(kinds["page"].select("kind", "url", "path", "title"), str(tmp_path / "out"))
    assert records.read_jsonl(spark, str(tmp_path / "out")).first()["path"] == "a/é.md"
    with pytest.raises(Exception, match="not an entity"):
        records.entity_catalogue(got).collect()
    assert spark.range(1).select(records.slug_of_path(F.lit("en/a/b.md"))).first()[0] == "en__a__b"


def test_corpus_reader_and_statements(spark, tmp_path):
    (tmp_path / "c" / "en").mkdir(parents=True)
    (tmp_path / "c" / "en" / "a.md").write_text("# A\ntext")
    (tmp_path / "c" / "skip.txt").write_text("no")
    assert [tuple(r) for r in records.read_corpus(spark, str(tmp_path / "c")).collect()] == [("en/a.md", "# A\ntext")]
    assert records.statements("// c\nSELECT 1;\nSELECT 2 ;") == ["SELECT 1", "SELECT 2"]
    with pytest.raises(RuntimeError, match="statement 2"):
        records.apply_statements(spark, "SELECT 1; SELEC 2;")


def test_gold_questions(spark):
    entry = {"id": "1", "category": "c", "question": "q", "reference_answer": "a", "expected_context_ids": ["x", ["y", "z"]]}
    assert records.gold_questions(spark, [entry]).first()["expected_context_ids"] == [["x"], ["y", "z"]]
    for wrong in ([entry, entry], [entry | {"question": ""}], [entry | {"expected_context_ids": [[" "]]}]):
        with pytest.raises(ValueError):
            records.gold_questions(spark, wrong)


def test_metrics(spark):
    answers = spark.createDataFrame([("1", "c", [["a"], ["x", "b"]], ["b", "q"], ["q"]), ("2", "c", [["a"]], [], [])], "question_id string, category string, expected array<array<string>>, retrieved array<string>, cited array<string>")
    got = {r["question_id"]: r for r in evaluate.id_metrics(answers).collect()}
    assert (got["1"]["id_hit_at_8"], got["1"]["id_recall_at_8"], got["1"]["cited_expected_hit"]) == (1.0, 0.5, 0.0) and got["2"]["id_hit_at_8"] == 0.0
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "m double")
    assert evaluate.means(nan, ["m"]).first()["m"] == 1.0


def slug(text):
    import re

    kept = re.sub(r"[^\w\s-]", "", text.lower())
    return re.sub(r"[\s_-]+", "-", kept).strip("-")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="aZé_ -.!ñ9", max_size=12), min_size=1, max_size=8))
def test_slugs(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in frame.orderBy("i").select(tx.slugify(F.col("t"))).collect()] == [slug(t) for t in texts]


@pytest.mark.parametrize("name, terms, want", [("Read", ["read"], 3.0), ("ReadFile", ["Read"], 2.0), ("ReadFile", ["Rea"], 0.0), ("Read", ["reading"], 1.0), ("Rea", ["reading"], 0.0), ("x", [], 0.0)])
def test_graded_match(spark, name, terms, want):
    frame = spark.createDataFrame([(name, terms)], "n string, t array<string>")
    assert frame.select(tx.graded_match(F.col("n"), F.col("t"))).first()[0] == want


def test_cosine_of_zero_is_null(spark):
    frame = spark.createDataFrame([([0.0, 0.0], [1.0, 0.0]), ([1.0, 1.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] and round(r[0], 6) for r in frame.select(cosine(F.col("a"), F.col("b"))).collect()] == [None, 0.707107]


def test_stored_index_tokenises_changes_only(spark, tmp_path):
    nodes = lambda rows: spark.createDataFrame(rows, "node_id long, indexed_text string, lang string")
    index = TextIndex(spark, str(tmp_path / "index"), 8)
    rows = [(i, f"common word{i % 7} only{i}", "en" if i % 2 else "de") for i in range(60)] + [(100, "", "en"), (101, None, "en")]
    assert index.update(nodes(rows), ("lang",)) == 62 and index.update(nodes(rows), ("lang",)) == 0
    rows[3], rows[4] = (3, "common changed", "en"), (4, rows[4][1], "fr")
    assert index.update(nodes(rows[:-3] + [(200, "only new common", "en")]), ("lang",), whole=True) == 2  # one changed, one new; one moved, three gone
    now = nodes(rows[:-3] + [(200, "only new common", "en")])
    asked = spark.createDataFrame([(1, "common word3 changed"), (2, "only5 only59 new"), (3, "nowhere")], "query_id int, text string")
    order = lambda df: sorted(map(tuple, df.select("query_id", "node_id", "score", "rank").collect()))
    for _ in range(2):
        assert order(index.bm25(asked, 5)) == order(search.bm25(now, asked, 5))
        assert order(index.bm25(asked, 5, F.col("lang") == "fr")) == order(search.bm25(now, asked, 5, F.col("lang") == "fr"))
        index.compact()
    again = TextIndex(spark, str(tmp_path / "index"), 8)
    assert order(again.bm25(asked, 5)) == order(search.bm25(now, asked, 5))
    assert [f.name for f in again.docs.read("docs").schema] == ["node_id", "content_hash", "length", "segment", "lang"]  # no text is stored


def test_hydration_by_any_key(spark):
    nodes = spark.createDataFrame([("n1", "/u1", "Bash", None, "text 1"), ("n2", "/u2", None, "perm", "text 2"), ("n3", "/u2", "n1", "n3", None)], "node_id string, url string, name string, key string, indexed_text string")
    rows = spark.createDataFrame([("n1", 1), ("/u2", 2), ("Bash", 3), ("perm", 4), ("n3", 5), ("gone", 6), (None, 7)], "key string, seq int").withColumn("indexed_text", F.lit("old"))
    got = sorted((r["seq"], r["node_id"], r["indexed_text"]) for r in store.hydrated_by_key(rows, nodes, ["indexed_text"]).collect())
    assert [g[:2] for g in got] == [(1, "n1"), (1, "n3"), (2, "n2"), (2, "n3"), (3, "n1"), (4, "n2"), (5, "n3")] and got[0][2] == "text 1" and got[1][2] is None
    seeds = spark.createDataFrame([(1, "n1", "Section")], "seed_rank int, node_id string, node_label string")
    more = spark.createDataFrame([("n1", 1, "n2", "Section"), ("n1", 1, "n1", "Section")], "seed_id string, seed_rank int, node_id string, node_label string")
    full = graph.expand(seeds, [("links", more)], nodes=nodes, payload=("indexed_text", "url"))
    assert {(r["node_id"], r["expansion_origin"], r["indexed_text"], r["url"]) for r in full.collect()} == {("n1", None, "text 1", "/u1"), ("n2", "links:n1", "text 2", "/u2")}


def test_all_audits_in_one_pass(spark):
    nodes = spark.createDataFrame([("Tool:a", "Tool"), ("Tool:b", "Tool"), ("Tool:b", "Tool"), ("Hook:x", "Hook"), (None, "Hook")], "node_id string, node_label string")
    edges = spark.createDataFrame([("DEFINES", "Tool:a"), ("DEFINES", "Tool:z"), ("DEFINES", "Tool:z"), ("MENTIONS", None), ("LINKS_TO", "gone")], "type string, target_id string")
    out = audit.one_pass(nodes, edges, {"Tool": (2, 3), "Hook": (3, None), "DEFINES": (1, 2), "Provider": (3, 3)}, ("Tool:a", "Tool:q"), ("DEFINES", "MENTIONS"))
    got = {(r["check"], r["name"]): (r["n"], r["passed"]) for r in out.collect()}
    assert got == {
        ("count", "Tool"): (3, True), ("count", "Hook"): (2, False), ("count", "Provider"): (0, False), ("count", "DEFINES"): (3, False), ("count", "MENTIONS"): (1, True), ("count", "LINKS_TO"): (1, True),
        ("duplicate", "Tool"): (1, False), ("duplicate", "Hook"): (0, True), ("required", "Tool:a"): (1, True), ("required", "Tool:q"): (0, False), ("dangling", "DEFINES"): (2, False), ("dangling", "MENTIONS"): (0, True),
        ("dangling", "LINKS_TO"): (0, True), ("untargeted", "DEFINES"): (0, True), ("untargeted", "MENTIONS"): (1, False), ("untargeted", "LINKS_TO"): (0, True),
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") <= 3  # nodes, edges and what is given


def test_calls_are_taken_up_again(spark, tmp_path):
    """A model that fails for some inputs at first: no input is called again once it has a result, distinct inputs are called once, and failures end as NaN."""
    calls, folder = tmp_path / "calls", f"file://{tmp_path}/results"
    calls.mkdir()

    def model(payloads, broken=("bad",)):
        import uuid

        out = []
        for p in payloads:
            with open(f"{calls}/{uuid.uuid4().hex}", "w") as f:
                f.write(p)
            tries = sum(open(x).read() == p for x in calls.iterdir())
            out.append(RuntimeError("no") if p in broken or (p.startswith("flaky") and tries < 2) else json.dumps({"faithfulness": 0.5}))
        return out

    def raises(payloads):
        raise ValueError("down")

    made = lambda: Counter(x.read_text() for x in calls.iterdir())
    inputs = spark.createDataFrame([(i, p) for i, p in enumerate(["a", "a", "b", "flaky1", "flaky2", "bad", None])], "question_id int, payload string").withColumn("category", F.lit("c"))
    got = {r["question_id"]: r for r in calls_of.called(inputs, model, folder, "v1", batch=2, tasks=3).collect()}
    assert made() == {"a": 1, "b": 1, "flaky1": 2, "flaky2": 2, "bad": 3, "": 1}
    assert all(got[i]["error"] is None for i in (0, 1, 2, 3, 4, 6)) and got[5]["result"] is None and "no" in got[5]["error"]
    again = calls_of.called(inputs.unionByName(spark.createDataFrame([(7, "new", "c")], "question_id int, payload string, category string")), model, folder, "v1", batch=2, tasks=3)
    assert again.count() == 8 and made() == {"a": 1, "b": 1, "flaky1": 2, "flaky2": 2, "bad": 3, "": 1, "new": 1}
    metrics = evaluate.judged(again)
    means = evaluate.means(metrics, list(evaluate.JUDGED), "category").first()
    assert means["n"] == 8 and means["faithfulness"] == 0.5 and means["context_recall"] is None
    assert calls_of.called(inputs, raises, folder, "v2", attempts=2).where("error = 'ValueError: down'").count() == 7


def test_judge_of_answers(spark, tmp_path):
    rows = spark.createDataFrame([(1, "what is it", "it is a tool", "it is a tool", ["it is a tool of things", "other"]), (2, "q", None, "r", None)], "question_id int, question string, answer string, reference string, contexts array<string>")
    asked = rows.select("question_id", evaluate.judge_payload(F.col("question"), F.col("answer"), F.col("reference"), F.col("contexts")).alias("payload"))
    got = {r["question_id"]: r for r in evaluate.judged(calls_of.called(asked, models.overlap_judge, f"file://{tmp_path}/judge", "overlap")).collect()}
    assert (got[1]["faithfulness"], got[1]["context_precision"], got[1]["context_recall"], got[1]["factual_correctness"], got[1]["semantic_similarity"]) == (1.0, 0.5, 1.0, 1.0, 1.0)
    assert got[2]["faithfulness"] == 0.0


def test_vector_search_in_many_blocks_of_queries(spark):
    import numpy as np

    rng = np.random.default_rng(6)
    nodes = spark.createDataFrame([(i, [float(v) for v in rng.standard_normal(8)]) for i in range(300)] + [(300, None), (301, [1.0, 2.0])], "node_id long, embedding array<double>")
    asked = spark.createDataFrame([(i, [float(v) for v in rng.standard_normal(8)]) for i in range(50)] + [(50, None), (51, [2.0, 4.0])], "query_id long, vector array<double>").repartition(1)
    rows = lambda block: sorted(map(tuple, search.vector_search(nodes, asked, 5, block).collect()))
    assert rows(3) == rows(1024) and len(rows(3)) == 50 * 5 + 1


def test_gathered_batches_hold_a_bounded_number_of_bytes():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"x": pa.array(range(10), pa.int64())}) for _ in range(7)]
    assert [len(held) for held in shared.gathered(iter(batches), 1)] == [1] * 7
    assert [len(held) for held in shared.gathered(iter(batches), 2, most=200)] == [3, 3, 1]
    assert list(shared.gathered(iter([]), 2)) == []


def test_vector_index_is_exact_and_prunes(spark, tmp_path):
    import numpy as np

    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 16))
    x = [(i, [float(v) for v in centres[i % 20] + 0.1 * rng.standard_normal(16)]) for i in range(2000)] + [(3000 + i, [float(v) for v in centres[0]]) for i in range(700)]  # copies of one vector
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [1.0] * 3), (9003, [float("nan")] * 16), (9004, [None] * 16), (9005, [])]
    nodes = spark.createDataFrame(x + odd, "node_id long, embedding array<double>")
    asked = spark.createDataFrame([(i, x[i][1]) for i in range(0, 2000, 97)] + [(5000, [1.0] * 16), (5001, None), (5002, [1.0])], "query_id long, vector array<double>")
    index = VectorIndex(spark, str(tmp_path / "vectors"))
    index.build(nodes, pivots=32, block=300)
    assert max(index.state["blocks"]) > 1 and sum(index.state["count"]) == len(x)
    rows = lambda df: sorted(map(tuple, df.collect()))
    for k in (1, 10, 150):
        assert rows(index.search(asked, k)) == rows(search.vector_search(nodes.where("size(embedding) = 16"), asked.where("size(vector) = 16"), k))
        assert index.share_read < 0.6
    again = VectorIndex(spark, str(tmp_path / "vectors"))
    assert rows(again.search(asked, 10)) == rows(index.search(asked, 10))
    few = VectorIndex(spark, str(tmp_path / "few"))
    few.build(spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "node_id string, embedding array<double>"))
    assert rows(few.search(spark.createDataFrame([(1, [1.0, 1.0])], "query_id int, vector array<double>"), 5)) == [(1, "a", 0.707107, 1), (1, "b", 0.707107, 2)]
    none = VectorIndex(spark, str(tmp_path / "none"))
    none.build(nodes.limit(0))
    with pytest.raises(ValueError, match="no vectors"):
        none.search(asked)


def test_whole_graph_of_a_small_corpus(spark):
    pages = [
        ("en/a.md", "# A page\n\n> about a\n\nIntro [b](b.md#two) and [out](https://other.example/x).\n\n## One\n\n| Topic | Where |\n|---|---|\n| [b](/docs/en/b.md) | see |\n\n## Empty\n\n## Last\n\n- [gone](gone.md)\n"),
        ("en/b.md", "# B page\n\n## Two\n\n<Note>Mind [a](a.md)</Note>\n\n### Three\n\n````\n```\ncode\n````\n"), ("en/null.md", None),
    ]
    index = spark.createDataFrame([("https://s.example/docs/en/b.md", "all about b")], "url string, description string")
    g = build(spark.createDataFrame(pages, "path string, text string"), index, "s.example", "https://s.example/docs/", ("en/b",))
    short = lambda x: None if x is None else x.replace("https://s.example/docs/en/", "")
    assert {(short(r["page_id"]), r["title"], r["description"], r["description_source"], r["volatile"]) for r in g.pages.collect()} == {("a.md", "A page", "about a", "blockquote", False), ("b.md", "B page", "all about b", "index", True), ("null.md", "en/null.md", "", "missing", False)}
    nodes = {(r["node_label"], r["anchor"] or r["language"]): r for r in g.nodes.where("node_label IN ('Section', 'CodeBlock') AND page_id NOT LIKE '%null.md'").collect()}
    assert {k for k in nodes if k[0] == "Section"} == {("Section", a) for a in ("overview", "one", "last", "two", "three")}  # the empty one goes
    assert nodes["Section", "one"]["raw_text"] == "- topic: b; where: see" and nodes["Section", "last"]["raw_text"] == "- gone" and nodes["Section", "overview"]["raw_text"] == "> about a\n\nIntro b and out."
    assert nodes["CodeBlock", ""]["raw_text"] == "```\ncode" and nodes["Section", "three"]["breadcrumb"] == "B page > Two > Three"
    edges = {(r["type"], short(r["source_id"]), short(r["target_id"])) for r in g.edges.where("type NOT LIKE 'CONTAINS%'").collect()}
    assert edges == {("HAS_SECTION", "a.md", f"a.md#{x}") for x in ("overview", "one", "last")} | {("HAS_SECTION", "b.md", "b.md#two"), ("HAS_SUBSECTION", "b.md#two", "b.md#three"), ("LINKS_TO", "a.md#overview", "b.md#two"), ("NAVIGATES_TO", "a.md#one", "b.md#two"), ("LINKS_TO_PAGE", "b.md#two", "a.md"), ("HAS_SECTION", "null.md", "null.md#overview")}
    assert {(short(r["section_id"]), r["href"], r["reason"]) for r in g.unresolved.collect()} == {("a.md#last", "gone.md", "page")}
    assert [r["external_links"] for r in g.external.collect()] == [["https://other.example/x"]]
    assert g.edges.groupBy("edge_id").count().where("count > 1").count() == 0


def test_long_lines_take_no_stack(spark):
    n = 60_000
    text = "\n".join(["# T", "", f"[{'a' * n}](/x) and [`b](c)` d](/y) and [e `f](/z)", "", ">" * n + " deep", "", "*" * n, "", "|a" * 3000 + "|", "|-" * 3000 + "|", "|b" * 3000 + "|"])
    _, placed = parse.located(spark.createDataFrame([("p", text)], "path string, text string"))
    assert sorted(r["href"] for r in parse.links(placed).collect()) == ["/x", "/y", "/z"]
    assert parse.section_text(placed).first()["text"] == f"{'a' * n} and `b](c)` d and e `f\n\n> deep\n\n---"
    assert [len(r["cells"]) for r in parse.table_rows(placed).collect()] == [3000]


def test_choices(spark):
    nodes = spark.createDataFrame([(1, ["Tool", "X"], "de", None), (2, ["Page"], None, "u"), (3, None, "en", None), (3, None, "en", None)], "node_id long, labels array<string>, language string, url string")
    ids = lambda df: sorted(r["node_id"] for r in df.collect())
    assert ids(choose.labelled(nodes, ("Tool", "Hook"))) == [1] and ids(choose.labelled(nodes, ())) == [] and ids(choose.labelled(nodes, ("en",), "language")) == [3, 3]
    assert ids(nodes.where(choose.equal_or_any(F.col("language"), None))) == [1, 2, 3, 3] and ids(nodes.where(choose.equal_or_any(F.col("language"), "de"))) == [1]
    assert ids(nodes.where(choose.equal_or_any(F.col("language"), F.col("url")))) == [1, 3, 3]
    assert ids(nodes.where(choose.present("language", "url"))) == [1, 2, 3, 3]
    assert ids(choose.pilot(nodes, 2)) == [1, 2] and ids(choose.pilot(nodes, None)) == [1, 2, 3, 3] and ids(choose.pilot(nodes.limit(0), 2)) == []
    searched, named = choose.split_labels(F.col("labels"), ("Page",), ("Tool",))
    assert [(r["a"], r["b"]) for r in nodes.orderBy("node_id").select(searched.alias("a"), named.alias("b")).collect()] == [([], ["Tool"]), (["Page"], []), ([], []), ([], [])]
    assert len(choose.union_distinct([nodes, nodes]).collect()) == 3 and len(choose.union_all([nodes, nodes]).collect()) == 8
    sets = choose.concat_of_sets([nodes, nodes.where("node_id > 1")], ["language"], "node_id")
    assert sorted((r["part"], r["node_id"]) for r in sets.collect()) == [(0, 1), (0, 2), (0, 3), (1, 2), (1, 3)]
    assert choose.projected(nodes.select("url", F.lit(1).alias("extra")), "Page").columns == list(choose.PROPERTIES["Page"])


def test_kinds_that_are_unknown_end_the_job(spark):
    records = spark.createDataFrame([(1, "page"), (2, "link"), (3, "section")], "i int, kind string")
    assert sorted(r["i"] for r in choose.of_kinds(records, ("page", "section"), ("link",)).collect()) == [1, 3]
    with pytest.raises(Exception, match="unknown kind of record: link"):
        choose.of_kinds(records, ("page", "section")).collect()


def test_gold_of_passages(spark):
    words = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"x {words} y"), (2, "w3 w4 w5 w6 w7 w8 w9 W10, and"), (3, "w3 w4 w5 w6 w7 w8 w9"), (4, None), (1, words)], "node_id long, text string")
    asked = spark.createDataFrame([(7, words), (8, "w1 w2"), (9, None)], "question_id long, text string")
    assert [(r["question_id"], r["expected"]) for r in evaluate.passage_gold(docs, asked).collect()] == [(7, [[1], [2]])]


def rows_of_plans(spark, run) -> dict[str, int]:
    """The most rows that a node of each kind gave in what run executes."""
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore()
    bus.waitUntilEmpty()
    before = store.executionsCount()
    run()
    bus.waitUntilEmpty()
    most: dict[str, int] = {}
    executions = store.executionsList(before, 100_000)
    for i in range(executions.size()):
        id_ = executions.apply(i).executionId()
        values, nodes = store.executionMetrics(id_), store.planGraph(id_).allNodes()
        for node in (nodes.apply(j) for j in range(nodes.size())):
            for metric in (node.metrics().apply(j) for j in range(node.metrics().size())):
                if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                    most[node.name()] = max(most.get(node.name(), 0), int(values.apply(metric.accumulatorId()).replace(",", "")))
    return most


def test_code_examples_join_one_seed_of_a_section_with_its_blocks(spark):
    n = 300
    seeds = spark.range(n).select(F.col("id").alias("seed_rank"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("node_id"), F.lit("Tool").alias("node_label"))
    edge = lambda kind, a, b: spark.range(n).select(F.lit(kind).alias("type"), a.alias("source_id"), b.alias("target_id"))
    of = lambda p: F.concat(F.lit(p), F.col("id").cast("string"))
    edges = edge("MENTIONS", F.lit("root"), of("t")).union(edge("DEFINES", F.lit("root"), F.lit("t7")).limit(1)).union(edge("HAS_SUBSECTION", F.lit("root"), F.lit("sub")).limit(1)).union(edge("CONTAINS_CODE", F.lit("sub"), of("c")))
    nodes = spark.range(n).select(of("c").alias("node_id"), F.lit("CodeBlock").alias("node_label"), F.lit(None).cast("string").alias("natural_key"), F.lit("py").alias("language"), F.lit(None).cast("int").alias("position"))
    got = []
    most = rows_of_plans(spark, lambda: got.extend(graph.expand_code_examples(edges, nodes, seeds).collect()))
    assert {r["node_id"] for r in got} == {f"c{i}" for i in range(n)} and {(r["seed_id"], r["mentioned"], r["depth"]) for r in got} == {("t7", 0, 1)}
    assert most and max(most.values()) <= 3 * n


def test_full_text_search_writes_postings_only(spark, monkeypatch):
    written, kept = [], search.saved
    monkeypatch.setattr(search, "saved", lambda df, name: (written.append(name), kept(df, name))[1])
    nodes = spark.range(60).select(F.col("id").alias("node_id"), F.concat(F.lit("the of and w"), (F.col("id") % 7).cast("string")).alias("indexed_text"))
    asked = spark.createDataFrame([(1, "the of w3"), (2, "and w5 none")], "query_id int, text string")
    got = search.bm25(nodes, asked, 5).collect()
    assert written == ["postings"]
    assert {q: sorted(r["node_id"] for r in got if r["query_id"] == q) for q in (1, 2)} == {1: [3, 10, 17, 24, 31], 2: [5, 12, 19, 26, 33]}


def test_gold_reads_runs_only_of_documents_that_hold_one(spark, monkeypatch):
    held, kept = [], evaluate.saved if hasattr(evaluate, "saved") else None
    monkeypatch.setattr(evaluate, "saved", lambda df, name: (held.append(kept(df, name)), held[-1])[1], raising=False)
    words = " ".join(f"w{i}" for i in range(9))
    documents = spark.createDataFrame([(1, f"x {words} y"), (2, "no passage in these nine words of a text"), (3, words.upper()), (4, None), (5, "w0 w1"), (6, words.replace("w4", "v"))], "node_id long, text string")
    questions = spark.createDataFrame([(1, words), (2, "too short"), (3, None)], "question_id long, text string")
    assert [(r["question_id"], r["expected"]) for r in evaluate.passage_gold(documents, questions).collect()] == [(1, [[1], [3]])]
    assert [sorted(r["node_id"] for r in h.collect()) for h in held] == [[1, 3]]


def test_index_counts_terms_where_a_text_is(spark, tmp_path, monkeypatch):
    from tessera.operators import textindex

    written, kept = [], textindex.saved
    monkeypatch.setattr(textindex, "saved", lambda df, name: (written.append(name), kept(df, name))[1])
    nodes = spark.createDataFrame([(1, "b a b c_1 b É a"), (2, ""), (3, None), (4, "a")], "node_id int, indexed_text string")
    index = TextIndex(spark, str(tmp_path / "index"), 2)
    assert index.update(nodes) == 4 and "tokens" not in written
    assert sorted((r["term"], r["node_id"], r["tf"]) for r in index.postings(None).collect()) == [("a", 1, 2), ("a", 4, 1), ("b", 1, 3), ("c_1", 1, 1), ("é", 1, 1)]
    assert {r["node_id"]: r["length"] for r in index.docs.read("docs").collect()} == {1: 7, 2: 0, 3: 0, 4: 1}


def test_deletes_sort_no_edges_and_hydration_broadcasts_no_nodes(spark, tmp_path):
    def stored(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    text = lambda p: F.concat(F.lit(p), F.col("id").cast("string"))
    nodes = stored(spark.range(50).select(text("n").alias("node_id"), text("k").alias("key"), (F.col("id") * 2).alias("payload")), "nodes")
    edges = stored(spark.range(50).select(text("n").alias("source_id"), F.concat(F.lit("n"), ((F.col("id") + 1) % 50).cast("string")).alias("target_id")), "edges")
    gone = nodes.where("payload < 20").select("node_id").distinct()
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    kept, left = store.delete_subtree(nodes, edges, gone)
    assert (kept.count(), left.count()) == (40, 39)
    assert all("ShuffledHashJoin" in plan(x) and "SortMergeJoin" not in plan(x) and "BroadcastHashJoin" not in plan(x) for x in (kept, left))
    asked = spark.createDataFrame([("a", "n3"), ("b", "k4"), ("c", "none")], "asked_by string, ref string")
    found = store.hydrated_by_key(asked, nodes, ["payload"], "ref")
    assert sorted((r["asked_by"], r["node_id"], r["payload"]) for r in found.collect()) == [("a", "n3", 6), ("b", "n4", 8)]
    assert "BroadcastExchange" not in plan(store.hydrated_by_key(asked, nodes, ["payload"], "ref"))


def test_texts_of_pages_are_made_once(spark):
    seen = spark.sparkContext.accumulator(0)
    made = F.udf(lambda x: (seen.add(1), f"# T\n\n## A\n\n<Note>n{x}</Note>\n" if x % 2 else f"plain {x}")[1], "string")
    pages = spark.range(6).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("path"), made("id").alias("text"))
    assert parse.normalised(pages).count() == 6 and seen.value == 6


def test_a_graph_is_built_of_pages_walked_once(spark):
    seen = spark.sparkContext.accumulator(0)
    made = F.udf(lambda x: (seen.add(1), f"# T\n\n## A\n\n[b](p{x + 1}#a)\n\n```py\nx\n```\n")[1], "string")
    pages = spark.range(6).select(F.concat(F.lit("p"), F.col("id").cast("string"), F.lit(".md")).alias("path"), made("id").alias("text"))
    g = build(pages, spark.createDataFrame([], "url string, description string"), "s.example", "https://s.example/docs/")
    assert {(r["type"], r["n"]) for r in g.edges.groupBy("type").agg(F.count("*").alias("n")).collect()} == {("HAS_SECTION", 6), ("CONTAINS_CODE", 6), ("LINKS_TO", 5)}
    assert g.nodes.count() == 18 and seen.value == 6


def test_full_text_search_makes_no_rows_of_nodes_and_queries(spark):
    nodes = spark.range(400).select(F.col("id").alias("node_id"), F.concat(F.lit("the of and w"), (F.col("id") % 7).cast("string")).alias("indexed_text"))
    asked = spark.range(60).select(F.col("id").alias("query_id"), F.lit("the of and").alias("text"))
    most = rows_of_plans(spark, lambda: search.bm25(nodes, asked, 2).write.format("noop").mode("overwrite").save())
    joined = {name: n for name, n in most.items() if "Join" in name}
    assert joined and max(joined.values()) <= 60 * 3  # queries and their terms; 60 * 400 * 3 when postings are joined with queries


def test_full_text_search_in_small_blocks_equals_plain_sums(spark):
    import math

    texts = [(i, " ".join(f"w{(i * j) % 11}" for j in range(1, 3 + i % 9)), "en" if i % 3 else "de") for i in range(40)] + [(40, "", "en"), (41, None, "en"), (42, "w1 w2 w2", "en"), (42, "w2 w1 w1", "en"), (42, "w1", "en")]
    asked = [(q, f"w{q} w{(q + 1) % 13} W{q} none") for q in range(10)] + [(3, "w9 w3"), (20, ""), (21, None)]
    nodes, queries = spark.createDataFrame(texts, "node_id long, indexed_text string, lang string"), spark.createDataFrame(asked, "query_id long, text string")
    counts = Counter((i, len(t.split()), w) for i, t, _ in texts if t for w in t.split())
    sizes = [len(t.split()) for _, t, _ in texts if t]
    df, n, mean = Counter(w for _, _, w in counts), len(sizes), sum(sizes) / len(sizes)
    want = Counter()
    for q, t in asked:
        for w in {*(t or "").lower().split()}:
            for (i, length, term), tf in counts.items():
                if term == w and (i >= 40 or i % 3):
                    want[q, i] += math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))
    best = {q: sorted(((-round(s, 6), i) for (p, i), s in want.items() if p == q))[:5] for q, _ in asked}
    wanted = nodes.withColumn("wanted", F.col("lang") == "en")
    terms = search.asked_terms(queries)
    postings = search.counted(wanted, terms, ["wanted"], block=2, rows=3)
    small = search.ranked(postings, terms, n, mean, 5, block=2, rows=4)
    for got in (search.bm25(nodes, queries, 5, F.col("lang") == "en"), small):
        rows = sorted((r["query_id"], r["rank"], r["node_id"], r["score"]) for r in got.collect())
        assert [r[:3] for r in rows] == [(q, rank, i) for q in sorted(best) for rank, (_, i) in enumerate(best[q], 1)]
        assert [r[3] for r in rows] == pytest.approx([-s for q in sorted(best) for s, _ in best[q]], abs=2e-6)


def test_vector_search_makes_each_embedding_once(spark):
    made = spark.sparkContext.accumulator(0)

    def slow(i):
        made.add(1)
        return None if i == 7 else [float(i), None] if i == 8 else [float(i + 1), 1.0]

    nodes = spark.range(50).select(F.col("id").alias("node_id"), F.udf(slow, "array<double>")("id").alias("embedding"))
    got = search.vector_search(nodes, spark.createDataFrame([(1, [1.0, 0.0])], "query_id int, vector array<double>"), 100).collect()
    assert made.value == 50 and {r["node_id"] for r in got} == {*range(50)} - {7, 8}


def test_embeddings_count_hashed_tokens(spark):
    texts = spark.createDataFrame([(0, "a b b c"), (1, ""), (2, None), (3, "x " * 3000)], "i int, text string")
    rows = {r["i"]: r for r in texts.select("i", models.embed(F.col("text"), 8).alias("e"), F.transform(search.tokens(F.col("text")), lambda t: F.pmod(F.xxhash64(t), F.lit(8))).alias("s")).collect()}
    assert rows[1]["e"] is None and rows[2]["e"] is None
    for i in (0, 3):
        counts = [float(rows[i]["s"].count(slot)) for slot in range(8)]
        norm = sum(c * c for c in counts) ** 0.5
        assert rows[i]["e"] == [c / norm for c in counts]

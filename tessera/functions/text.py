"""String, hash and path expressions; all stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = " > "
EDGE_PUNCTUATION = ",.;:?!()[]{}\"'"  # fixed value: stripped from both ends of a query term
LUCENE_SPECIAL = r'([+\-!(){}\[\]^"~*?:\\/&|])'


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def slugify(text: Column) -> Column:
    """Lower case; letters, digits, spaces, underscores and hyphens stay; runs of the last three become one hyphen."""
    kept = F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}_\s-]", "")
    return F.regexp_replace(F.regexp_replace(kept, r"[\s_-]+", "-"), r"^-+|-+$", "")


def loose_key(anchor: Column) -> Column:
    return F.regexp_replace(F.lower(anchor), "[^a-z0-9]", "")


def percent_decode(text: Column) -> Column:
    """Percent-decoding that leaves + alone; text that is malformed stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def normalize_anchor(raw: Column) -> Column:
    return slugify(F.regexp_replace(F.trim(percent_decode(raw)), "^#+", ""))


def clean_href(href: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(percent_decode(href)), "^`+|`+$", ""))


def short_hash(*parts: Column) -> Column:
    """The first 16 hexadecimal digits of SHA-256 over the parts joined by a bar; a null part counts as empty."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), 1, 16)


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def atom_id(section_id: Column, position: Column, suffix: Column) -> Column:
    return short_hash(section_id, position, suffix)


def edge_id(kind: Column, source: Column, target: Column, extra: Column) -> Column:
    """extra: the link's href, or the evidence of a mention; null where there is none."""
    return short_hash(kind, source, target, extra)


def entity_id(label: Column, name: Column) -> Column:
    return F.concat_ws(":", label, name)


def code_identifiers(text: Column) -> Column:
    """What stands between backticks, without outer quotes; empty ones are left out."""
    spans = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("`([^`]+)`"), F.lit(1))
    bare = F.transform(spans, lambda s: F.regexp_replace(F.regexp_replace(F.trim(s), '^"+|"+$', ""), "^'+|'+$", ""))
    return F.filter(bare, lambda s: s != "")


def first_code_or_text(text: Column) -> Column:
    return F.coalesce(F.try_element_at(code_identifiers(text), F.lit(1)), collapse(text))


def mentions(text: Column, name: Column) -> Column:
    """Whether name stands in text with no ASCII letter, digit or underscore next to it; case counts."""
    quoted = F.concat(F.lit(r"(?<![A-Za-z0-9_])\Q"), F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E(?![A-Za-z0-9_])"))
    return F.rlike(text, quoted)


def breadcrumb(parts: Column) -> Column:
    return F.array_join(parts, SEPARATOR)


def breadcrumb_tail(crumb: Column) -> Column:
    return F.element_at(F.split(F.coalesce(crumb, F.lit("")), SEPARATOR), -1)


def breadcrumb_depth(crumb: Column) -> Column:
    return F.size(F.split(F.coalesce(crumb, F.lit("")), SEPARATOR))


def query_string(text: Column, keywords: Column) -> Column:
    """The query's text and keywords with single spaces between; empty parts are left out."""
    blank = lambda c: F.when(F.trim(c) == "", None).otherwise(F.trim(c))
    return F.concat_ws(" ", blank(text), blank(F.array_join(F.coalesce(keywords, F.array().cast("array<string>")), " ")))


def escape_query(query: Column) -> Column:
    return F.regexp_replace(query, LUCENE_SPECIAL, r"\\$1")


def strip_edges(term: Column) -> Column:
    inside = F.lit("[" + "".join("\\" + c for c in EDGE_PUNCTUATION) + "]+")
    return F.regexp_replace(F.regexp_replace(term, F.concat(F.lit("^"), inside), F.lit("")), F.concat(inside, F.lit("$")), F.lit(""))


def query_terms(text: Column, keywords: Column | None = None) -> Column:
    """Terms of two characters or more, stripped of punctuation, each once whatever its case, in the first spelling."""
    source = text if keywords is None else F.concat_ws(" ", text, F.array_join(keywords, " "))
    bare = F.filter(F.transform(F.split(F.coalesce(source, F.lit("")), r"\s+"), strip_edges), lambda t: F.length(t) >= 2)
    # bound once as an array of one element, so that the lists aren't made again for every term
    once = F.array(F.struct(bare.alias("bare"), F.transform(bare, lambda t: F.lower(t)).alias("keys")))
    return F.flatten(F.transform(once, lambda x: F.filter(x["bare"], lambda t, i: F.array_position(x["keys"], F.lower(t)) == i + 1)))


def graded_match(name: Column, terms: Column) -> Column:
    """3 if a term is the name, 2 if one of four characters or more begins it, 1 if the name (four or more) begins a term, else 0."""
    low, lower = F.lower(name), F.transform(terms, lambda t: F.lower(t))
    return (
        F.when(F.exists(lower, lambda t: t == low), 3.0)
        .when(F.exists(lower, lambda t: (F.length(t) >= 4) & F.startswith(low, t)), 2.0)
        .when((F.length(low) >= 4) & F.exists(lower, lambda t: F.startswith(t, low)), 1.0)
        .otherwise(0.0)
    )


def entity_label(entity_id: Column) -> Column:
    """The label in front of an entity's id (all of it where it has none)."""
    return F.substring_index(entity_id, ":", 1)


def citation_ids(answer: Column) -> Column:
    """The numbers in [n] marks, each once, in the order in which they are first met; one too large for a long is the largest long, so still out of range."""
    found = F.regexp_extract_all(F.coalesce(answer, F.lit("")), F.lit(r"\[(\d+)\]"), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: F.coalesce(x.try_cast("bigint"), F.lit(2**63 - 1))))


def citation_check(answer: Column, evidence: Column, used: Column) -> Column:
    """ok, missing (used but not marked) and out_of_range (marked but not among the evidence)."""
    ids = citation_ids(answer)
    outside = F.filter(ids, lambda n: (n < 1) | (n > evidence))
    missing = F.filter(F.transform(used, lambda n: n.cast("bigint")), lambda n: ~F.array_contains(ids, n))
    return F.struct(((F.size(outside) == 0) & (F.size(missing) == 0)).alias("ok"), missing.alias("missing"), outside.alias("out_of_range"))


def candidate_paths(raw: Column, source_path: Column, root: str = "/docs/", aliases: dict[str, str] | None = None) -> Column:
    """Corpus paths that a link's path may mean, the likeliest first."""
    path = F.trim(percent_decode(raw))
    folder = F.regexp_extract(source_path, r"^(.*/)?[^/]*$", 1)
    folded = F.aggregate(
        F.split(F.concat(folder, path), "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part.isin("", "."), done)
        .when((part == "..") & (F.size(done) > 0) & (F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("..")) != ".."), F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    full = (
        F.when(F.startswith(path, F.lit(root)), F.substring(path, len(root) + 1, 1_000_000))
        .when(F.startswith(path, F.lit("/")), F.substring(path, 2, 1_000_000))
        .when(path != "", F.array_join(folded, "/"))
        .otherwise(source_path)
    )
    index = F.when(F.endswith(full, F.lit("/")) | (full == ""), F.concat(full, F.lit("index.md"))).otherwise(F.concat(full, F.lit("/index.md")))
    tried = F.when(F.endswith(full, F.lit(".md")), F.array(full)).otherwise(F.array(F.concat(full, F.lit(".md")), index))
    if not aliases:
        return tried
    named = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.flatten(F.transform(tried, lambda p: F.filter(F.array(p, F.try_element_at(named, p)), lambda x: x.isNotNull())))

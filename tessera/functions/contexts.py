"""Routing, templates and checks of retrieval contexts, as column expressions over node payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import SEPARATOR, breadcrumb_depth, breadcrumb_tail

# Fixed values of the routing and of the context contract.
ENTITY_LABELS = ("Tool", "Hook", "SettingKey", "PermissionMode", "MessageType", "Provider")
TRIVIAL_LEADS = ("Input:", "Output:", "Example:", "Migration:", "Windows PowerShell", "Windows CMD", "macOS", "macOS, Linux, WSL", "In code", ".mcp.json")
FORBIDDEN_OPENERS = ("this", "the", "a", "an")
FORBIDDEN_PHRASES = ("related hints", "this node defines", "this section discusses", "this callout highlights", "this tablerow", "this codeblock", "within the documentation", "in the documentation", "distinct from related")
# What the context of a permission mode must hold, one phrase of each group; and what is said where one is missing.
MODE_PHRASES = {
    "default": ("default words", [("baseline",), ("read-only", "read only"), ("session", "start")]),
    "plan": ("plan words", [("enterplanmode",), ("read-only", "read only"), ("approval", "before edit", "before-edit", "implementation", "proposal", "strategy")]),
    "bypassPermissions": ("bypass words", [("protected path",)]),
}
LEAST_CHARS, MOST_CHARS = 10, 600


def route(label: Column, raw_text: Column, crumb: Column, synthesized: Column, preceding: Column) -> Column:
    """skip, template or llm."""
    text, lead = F.coalesce(raw_text, F.lit("")), F.coalesce(preceding, F.lit(""))
    lead = F.when(lead.isin(*TRIVIAL_LEADS), "").otherwise(lead)
    section = (
        F.when(F.trim(F.regexp_replace(text, r"^\s+|\s+$", "")).isin("", "---"), "skip")
        .when(F.coalesce(synthesized, F.lit(False)), "template")
        .when((F.length(text) > 200) & (breadcrumb_depth(crumb) >= 3), "template")
        .otherwise("llm")
    )
    code = F.when((F.length(text) > 1000) & (F.length(lead) > 200), "template").otherwise("llm")
    return F.when(label == "Section", section).when(label == "CodeBlock", code).when(label.isin("TableRow", "Callout", *ENTITY_LABELS), "llm").otherwise("skip")


def raw_representation(label: Column, raw_text: Column, language: Column, headers: Column, cells: Column, kind: Column, name: Column) -> Column:
    raw_text = F.coalesce(raw_text, F.lit(""))
    return (
        F.when(label == "Section", raw_text)
        .when(label == "CodeBlock", F.concat(F.lit("["), F.coalesce(language, F.lit("code")), F.lit("]\n"), raw_text))
        .when(label == "TableRow", F.concat(F.array_join(headers, " | "), F.lit("\n"), F.array_join(cells, " | ")))
        .when(label == "Callout", F.concat(F.lit("["), F.coalesce(kind, F.lit("note")), F.lit("] "), raw_text))
        .otherwise(F.concat(name, F.lit(": "), raw_text))
    )


def section_template(crumb: Column, page_title: Column, parent_text: Column, synthesized: Column) -> Column:
    crumb = F.coalesce(crumb, F.lit(""))
    tail = breadcrumb_tail(crumb)
    parts = F.split(crumb, SEPARATOR)
    above = F.when(F.size(parts) > 1, F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), SEPARATOR)).otherwise(crumb)
    parent = F.trim(F.substring(F.coalesce(parent_text, F.lit("")), 1, 120))
    plain = F.trim(F.concat(F.lit("["), page_title, F.lit(" — "), tail, F.lit('] Subsection of "'), above, F.lit('". '), parent))
    return F.when(F.coalesce(synthesized, F.lit(False)), F.concat(F.lit("[changelog entry] Release notes for "), tail, F.lit("."))).otherwise(plain)


def code_template(language: Column, crumb: Column, preceding: Column) -> Column:
    lead = F.substring(F.coalesce(preceding, F.lit("")), 1, 200)
    return F.trim(F.concat(F.lit("["), F.coalesce(language, F.lit("code")), F.lit(": example] In "), crumb, F.lit(". "), lead))


def template(label: Column, section: Column, code: Column) -> Column:
    """The template of the label; another label is an error."""
    return F.when(label == "Section", section).when(label == "CodeBlock", code).otherwise(F.raise_error(F.concat(F.lit("no template for label "), label)))


def indexed_text(context: Column, representation: Column) -> Column:
    return F.concat(context, F.lit("\n\n"), representation)


def context_error(context: Column) -> Column:
    """Null for a context that may be stored, else what is wrong with it."""
    first = F.regexp_replace(F.lower(F.element_at(F.split(F.trim(F.regexp_replace(context, r"\s+", " ")), " "), 1)), r"[:,.;!?]+$", "")
    low = F.lower(context)
    return (
        F.when(context.isNull() | (F.length(context) < LEAST_CHARS), "too short")
        .when(F.length(context) > MOST_CHARS, "too long")
        .when(F.trim(F.regexp_replace(context, r"\s+", " ")) == "", "empty")
        .when(first.isin(*FORBIDDEN_OPENERS), "opener")
        .when(F.exists(F.array(*map(F.lit, FORBIDDEN_PHRASES)), lambda p: F.contains(low, p)), "phrase")
    )


def entity_context_error(label: Column, name: Column, context: Column, siblings: Column) -> Column:
    """Null, or what an entity's context lacks: its name in front, no sibling's name, the words that its mode must have."""
    low, is_mode = F.lower(context), label == "PermissionMode"
    alone = lambda s: F.rlike(context, F.concat(F.lit(r"(?<![A-Za-z0-9_])\Q"), s, F.lit(r"\E(?![A-Za-z0-9_])")))
    others = F.filter(F.coalesce(siblings, F.array().cast("array<string>")), lambda s: F.lower(s) != F.lower(name))
    lacking = [
        F.when((name == mode) & F.exists(F.array(*[F.array(*map(F.lit, group)) for group in groups]), lambda group: ~F.exists(group, lambda phrase: F.contains(low, phrase))), said)
        for mode, (said, groups) in MODE_PHRASES.items()
    ]
    of_mode = F.coalesce(F.when(F.exists(others, alone), "sibling"), *lacking)
    return F.when(label.isin(*ENTITY_LABELS), F.when(~F.startswith(context, F.concat(name, F.lit(":"))), "prefix").when(is_mode, of_mode))


def counterpart_context(context: Column, prefix: str = "Cross-language counterpart: ") -> Column:
    """The context of a code block that has an equal in another language: marked, and cut to the most characters at a sentence's end."""
    full = F.concat(F.lit(prefix), context)
    cut = F.rtrim(F.substring(full, 1, MOST_CHARS))
    cut = F.when(F.rlike(cut, F.lit("[.!?]$")), cut).otherwise(F.concat(F.rtrim(F.substring(full, 1, MOST_CHARS - 1)), F.lit(".")))
    return F.when(F.startswith(context, F.lit(prefix)), context).when(F.length(full) > MOST_CHARS, cut).otherwise(full)


def prompt(label: Column, payload: Column, raw_text: Column, most: int = 2000) -> Column:
    """The user prompt of the context model: the node's fields and its text, cut to ``most`` characters."""
    return F.format_string("Label: %s\n%s\n\nText:\n%s", label, F.coalesce(payload, F.lit("")), F.substring(F.coalesce(raw_text, F.lit("")), 1, most))

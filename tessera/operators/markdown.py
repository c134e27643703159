"""One Markdown page: a walk over its lines, in which what a parser carries along is a variable.

Plain Python, called by ``parse`` in the tasks, for a page at a time: nothing of a page needs another one.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict

DEEPEST = 6
# Component tags of the pages and first headers of data tables.
CALLOUTS = ("Note", "Tip", "Info", "Warning", "Check")
UNWRAPPED = ("Experiment", "Frame", "Tabs", "AccordionGroup", "CardGroup", "Steps", "RequestExample", "ResponseExample")
TITLED = ("Tab", "Accordion", "Card", "Expandable", "Step")
FIELDS = ("ParamField", "ResponseField")
DROPPED = ("Hero",)
INLINE = {"strong": "**", "b": "**", "em": "*", "i": "*", "code": "`", "a": "", "span": ""}
DATA_HEADERS = ("tool", "key", "event", "mode", "setting", "field", "parameter", "rule")
KNOWN = {*CALLOUTS, *UNWRAPPED, *TITLED, *FIELDS, *DROPPED, *INLINE, "CodeGroup", "Update", "div", "p", "img"}
#: What stands in braces in a tag: other braces in it (so deep), and strings, which may hold any.
BRACES = 8
#: What marks the heading of an update card, and a title, after which a paragraph ends.
UPDATE, TITLE = "<!--update-->", "<!--title-->"
CALLOUT, CALLOUT_END, GROUP, GROUP_END = "<!--callout:", "<!--/callout-->", "<!--codegroup-->", "<!--/codegroup-->"
WHITE = " \t\n\r\f\v"
QUOTED = r"\"[^\"]*+\"|'[^']*+'"


def _braced(depth: int) -> str:
    inner = r"[^{}\"'`]++|\"(?:[^\"\\]|\\.)*+\"|'(?:[^'\\]|\\.)*+'|`(?:[^`\\]|\\.)*+`"
    return rf"\{{(?:{inner}{'|' + _braced(depth - 1) if depth else ''})*+\}}"


def _re(pattern: str, flags: int = 0) -> re.Pattern[str]:
    return re.compile(pattern, re.ASCII | flags)


#: A tag: its attributes are in quotes or braces, which may hold angle brackets and line ends, or plain; of any number and length.
TAG = _re(rf"<(?:/[A-Za-z][\w.]*\s*>|[A-Za-z][\w.]*(?=[\s/>])(?:[^<>\"'{{}}]++|{QUOTED}|{_braced(BRACES)})*+>)")
ATTRIBUTE = _re(rf"[A-Za-z_:][\w:.\-]*(?:\s*=\s*(?:{QUOTED}|{_braced(BRACES)}|[^\s\"'{{}}<>/]+))?")
TAG_NAME, ATTRIBUTE_NAME, ATTRIBUTE_VALUE = _re(r"</?([\w.]+)"), _re(r"[\w:.\-]+"), _re(r"[\w:.\-]+\s*=\s*(?:\{\s*)?([\"'`]?)(.*?)\1\s*\}?$", re.S)
LINK = _re(r"(?<!!)\[((?:[^\[\]`]++|`[^`]*+`|`)*+)\]\(\s*<?([^)\s>]*)>?(?:\s+\"[^\"]*\")?\s*\)")
PICTURE, MARKUP, EMPHASIS = _re(r"!\[([^\]]*)\]\([^)]*\)"), _re(r"<!--.*?-->|</?[A-Za-z][^<>]*>"), _re(r"\*\*|__|(?<!\w)[*_](?=\S)|(?<=\S)[*_](?!\w)")
FENCE, SCRIPTS = _re(r"[ \t]*(`{3,}|~{3,})(.*)", re.S), _re(r"<style\b[^>]*>.*?</style\s*>|<script\b[^>]*/>|<script\b[^>]*>.*?</script\s*>", re.S | re.I)
FRONT = _re(r"\A---[ \t]*\n(?:(?!---[ \t]*(?:\n|\Z))[^\n]*+\n)*+---[ \t]*(?:\n|\Z)")
BUSY, STATEMENT = _re(r"</?[A-Za-z]|^(?:export\s|\{)", re.M), _re(r"^(?:export\s|\{)", re.M)
EXPORT, STRINGS = _re(r"export\s+(?:const|let|var|function|default|class|async|type|interface)\b"), _re(r"\"(?:[^\"\\]|\\.)*+\"|'(?:[^'\\]|\\.)*+'|`(?:[^`\\]|\\.)*+`|/\*.*?\*/|(?<!:)//.*$")
TEMPLATE_END, OPEN_QUOTE, GOES_ON, MORE, CLOSE = _re(r"(?:[^`\\]|\\.)*+`"), _re(r"`|/\*"), _re(r"(?:=>?|[,(&|?:+])\s*$"), _re(r"\s*(?:[.?&|+]|\{)"), _re(r"\};?\s*$")
ANY_HEADING, INDENT, LINE_END = _re(r"#{1,6}\s"), _re(r"[ \t]*"), _re(r"\s*\n\s*")
UNDERLINE, NO_PARAGRAPH = _re(r" {0,3}(?:=+|-+)[ \t]*$"), _re(r" {0,3}(?:>|#{1,6}(?:\s|$)|[*+-](?:\s|$)|\d{1,9}[.)](?:\s|$)|\||<!--|(?:=+|-+)[ \t]*$)| {4}|\t")
HEADING, HEADING_MARK, HEADING_END = _re(r" {0,3}(#{1,6})\s+\S"), _re(r" {0,3}#{1,6}\s+"), _re(r"\s+#+\s*$")
ITEM, RULE = _re(r"(\s*)([*+-]|\d{1,9}[.)])\s+(.*)$"), _re(r" {0,3}(?:(?:\*[ \t]*+){3,}+|(?:-[ \t]*+){3,}+|(?:_[ \t]*+){3,}+)$")
QUOTE, QUOTE_MARKS, QUOTED_MARK = _re(r" {0,3}>"), _re(r"\s*(?:>[ \t]?+)++"), _re(r"\s*(?:#{1,6}\s+|[*+-]\s+|\d{1,9}[.)]\s+)")
IMAGE, CALLOUT_KIND, TABLE_OR_COMMENT, DEEP = _re(r"\s*<!--image path=\"([^\"]*)\" alt=\"([^\"]*)\"-->"), _re(r"<!--callout:([a-z]+)-->"), _re(r"\s*(?:\||<!--)"), _re(r"(?: {4}|\t)\s*\S")
THEME, LANGUAGE = _re(r"\btheme=\{[^}]*\}"), _re(r"\s*(?:`{3,}|~{3,})\s*([^\s`{]*)")
DASHES, CELL, CELL_ENDS, CELL_LINK = _re(r"\s*\|?\s*:?-+:?\s*(?:\|\s*+:?-++:?\s*+)*+\|?\s*$"), _re(r"(?<!\\)\|"), _re(r"^\||(?<!\\)\|$"), _re(r"\[[^\]]*\]\([^)]*\)")
WORDS, LETTER, SENTENCE_END, CODE_BEGIN, QUOTE_LINE = _re(r"\s+"), _re(r"[A-Za-z]"), _re(r"[.!?](?:\s|$)"), _re(r"[/$>{\[|#<]"), _re(r"\s*>")
SLUG_GAP, SLUG_OUT, FOUR = _re(r"[\s_-]+"), _re(r"[^a-z0-9_\s-]"), _re(r" {4}|\t")

Spans = list[tuple[int, int, bool]]


def page_lines(text: str | None) -> list[str]:
    """The lines of a page without style and script elements and what a page begins with between two lines of dashes."""
    text = (text or "").replace("\r\n", "\n").replace("\r", "\n")
    if "<s" in text or "<S" in text:
        text = SCRIPTS.sub("", text)
    return (FRONT.sub("", text) if text.startswith("---") else text).split("\n")


def fences(lines: list[str]) -> Spans:
    """The fenced blocks as spans (a, b, closed), marks included.  A block ends at a bare mark of the same character, as long at least, or with the last line."""
    spans: Spans = []
    begin, run = -1, ""
    for at, line in enumerate(lines):
        if ("```" not in line and "~~~" not in line) or not (m := FENCE.match(line)):
            continue
        mark, info = m.groups()
        if begin >= 0:
            if mark.startswith(run) and not info.strip(" "):
                spans.append((begin, at, True))
                begin = -1
        elif mark[0] == "~" or "`" not in info:
            begin, run = at, mark
    if begin >= 0:
        spans.append((begin, len(lines) - 1, False))
    return spans


def between(lines: list[str], spans: Spans):
    """The parts of the lines before, in, between and after the spans, with whether each is a span."""
    at = 0
    for a, b, _ in spans:
        if a > at:
            yield lines[at:a], False
        yield lines[a : b + 1], True
        at = b + 1
    if at < len(lines):
        yield lines[at:], False


def _bracketed(line: str, quote: str) -> tuple[int, bool, str]:
    """What a line that begins within the quote does: its depth of brackets, whether the statement goes on, and the quote that is open at its end."""
    if quote:
        at = m.end() if quote == "`" and (m := TEMPLATE_END.match(line)) else line.find("*/") + 2 if quote == "*" and "*/" in line else -1
        if at < 0:
            return 0, True, quote
        line = line[at:]
    bare = STRINGS.sub("", line)
    inside = OPEN_QUOTE.search(bare)
    own = bare[: inside.start()] if inside else bare
    depth = sum(map(own.count, "[({")) - sum(map(own.count, "])}"))
    return depth, GOES_ON.search(own) is not None, "" if not inside else "`" if inside[0] == "`" else "*"


def statements(lines: list[str], spans: Spans) -> list[tuple[int, int]]:
    """Top-level exports and expressions in braces as spans of lines.

    One begins outside of code at a line that begins with export, or with a brace.  It ends with the first line after which its brackets balance, no template literal or comment is open,
    and the statement doesn't go on (with an operator, comma or bracket at the line's end or an operator or brace at the next one's begin).  An expression that doesn't end before the next
    heading or export is text.  An export that doesn't ends at its first line of a closing brace alone, else before its first empty line.
    """
    found: list[tuple[int, int]] = []
    kind, depth, quote, begin, close, blank = 0, 0, "", -1, -1, -1
    code = bytearray(len(lines))
    for a, b, _ in spans:
        code[a : b + 1] = b"\1" * (b + 1 - a)

    def give_up(end: int) -> None:
        if kind == 1:
            found.append((begin, close if close >= 0 else blank - 1 if blank >= 0 else end - 1))

    for at, line in enumerate(lines):
        if code[at] or (not kind and line[:1] not in ("e", "{")):
            continue
        export = line[:1] == "e" and EXPORT.match(line) is not None
        more = lambda: at + 1 < len(lines) and MORE.match(lines[at + 1]) is not None  # noqa: B023, E731
        if not kind or (not quote and (export or (line[:1] == "#" and ANY_HEADING.match(line)))):
            if kind:
                give_up(at)
            kind, depth, quote, begin, close, blank = 0, 0, "", -1, -1, -1
            if export or line[:1] == "{":
                d, goes, q = _bracketed(line, "")
                if d <= 0 and not goes and not q and not (export and more()):
                    found.append((at, at))
                else:
                    kind, depth, quote, begin = 1 if export else 2, d, q, at
            continue
        d, goes, q = _bracketed(line, quote)
        depth += d
        if depth <= 0 and not goes and not q and not (kind == 1 and more()):
            found.append((begin, at))
            kind, depth, quote, begin, close, blank = 0, 0, "", -1, -1, -1
            continue
        quote = q
        close = at if close < 0 and CLOSE.match(line) else close
        blank = at if blank < 0 and not line.strip(" ") else blank
    give_up(len(lines))
    return found


def attribute(pairs: list[str], *names: str) -> str | None:
    """The value of the first of the names in a tag's attributes (name=value), without quotes and braces; true for one without a value, None for none or an empty one."""
    for name in names:
        own = next((p for p in pairs if ATTRIBUTE_NAME.match(p)[0] == name), None)
        if own is not None:
            value = "true" if "=" not in own else LINE_END.sub(" ", m[2]) if (m := ATTRIBUTE_VALUE.match(own)) else ""
            if value:
                return value
    return None


class Piece:
    """A text, a tag or a fenced block of a page; starts: whether it begins a line, opens and closes: whether it is one of a matched pair of tags."""

    __slots__ = ("kind", "s", "starts", "name", "alone", "opens", "closes", "opener", "pairs", "depth", "steps", "gone", "common", "empty")

    def __init__(self, kind: str, s: str, starts: bool) -> None:
        self.kind, self.s, self.starts = kind, s, starts
        self.name = self.opener = None
        self.alone = self.opens = self.closes = self.empty = False
        self.pairs: list[str] = []

    def said(self, *names: str) -> str | None:
        return attribute(self.pairs, *names)


def pieces_of_text(lines: list[str], spans: Spans) -> list[Piece]:
    """The opening and closing tags of a name are matched by the running depth: a close belongs to the last open of its depth if no other close does.  Others are text."""
    out: list[Piece] = []
    for part, fenced in between(lines, spans):
        text = "\n".join(part) + "\n"
        if fenced:
            out.append(Piece("fence", text, True))
            continue
        at = 0
        for m in TAG.finditer(text):
            out += (Piece("text", text[at : m.start()], at == 0), Piece("tag", m[0], False))
            at = m.end()
        out.append(Piece("text", text[at:], at == 0))
    depth: dict[str, int] = defaultdict(int)
    last: dict[tuple[str, int], tuple[Piece, int]] = {}
    for x in out:
        if x.kind != "tag" or (name := TAG_NAME.match(x.s)[1]) not in KNOWN:
            continue
        x.name, x.alone = name, x.s.endswith("/>") or name == "img"
        if not x.alone:
            step = -1 if x.s.startswith("</") else 1
            depth[name] += step
            key = name, depth[name] + (step < 0)
            before, its = last.get(key, (None, 0))
            if step < 0 and before is not None:
                x.opener = before
                if its == 1:
                    before.opens = x.closes = True
            last[key] = x, step
        x.pairs = ATTRIBUTE.findall(re.sub(r"^<[\w.]+", "", (x.opener or x).s, flags=re.ASCII))
    return out


def _lead(x: Piece) -> str:
    field, kind = x.said("path", "name", "body"), x.said("type")
    lead = " ".join([f"`{field}`"] * (field is not None) + [f"({kind})"] * (kind is not None) + ["**required**"] * (x.said("required") == "true"))
    return f"\n\n**{lead}**\n\n" if lead else "\n\n"


def _rewritten(x: Piece) -> str:
    """What stands in the place of a known tag; of a close, what its opener says."""
    name, quoted = x.name, lambda v: (v or "").replace('"', "&quot;")
    if name == "img":
        return f'<!--image path="{quoted(x.said("data-path", "src"))}" alt="{quoted(x.said("alt"))}"-->'
    if x.alone and name in FIELDS:
        return _lead(x)
    if x.alone and (name in TITLED or name in UNWRAPPED or name in DROPPED):
        return ""
    if not (x.opens or x.closes):
        return x.s
    if name in CALLOUTS:
        return f"\n\n{CALLOUT}{name.lower()}-->\n" if x.opens else f"\n{CALLOUT_END}\n\n"
    if name == "CodeGroup":
        return f"\n\n{GROUP}\n" if x.opens else f"\n{GROUP_END}\n\n"
    if name == "Update":
        return f"\n\n## {x.said('label') or ''} {UPDATE}\n\n{x.said('description') or ''}\n\n" if x.opens else "\n\n"
    if name in FIELDS:
        return _lead(x) if x.opens else "\n\n"
    if name in TITLED:
        title = x.said("title")
        return "\n\n" if x.closes else f"\n\n**{title}**{TITLE}\n\n" if title is not None else "\n\n1. " if name == "Step" else "\n\n"
    if name == "p":
        return "" if x.empty else "\n\n"
    if name == "a":
        href = x.said("href")
        return "" if x.empty or href is None else "[" if x.opens else f"]({href})"
    return "" if x.empty else INLINE.get(name, "")


def components(lines: list[str], spans: Spans) -> str:
    """The page with its component tags as Markdown or as the comments that later steps read.

    Every tag is rewritten where it stands; what it does to its body goes by running counts over the pieces: a body goes with a dropped component; it loses the indentation that
    the lines right in it share (those of fenced blocks too); a step without a title is an item of a list, and its lines are indented.
    """
    every = pieces_of_text(lines, spans)
    depth = steps = gone = 0
    wrapper: dict[int, int] = {}
    least: dict[tuple[int, int], int] = {}
    for k, x in enumerate(every):
        step = 1 if x.opens else -1 if x.closes else 0
        if step:
            if x.name not in INLINE:
                depth += step
                if step > 0:
                    wrapper[depth] = k
            steps += step * (x.name == "Step" and x.said("title") is None)
            gone += step * (x.name in DROPPED)
        x.depth, x.steps, x.gone = depth, max(steps, 0), gone > 0
        x.common = key = (depth, wrapper.get(depth, -1))
        if depth > 0 and x.kind != "tag":
            for i, line in enumerate(x.s.split("\n")):
                if (x.starts or i) and line.strip(" "):
                    least[key] = min(least.get(key, 1 << 30), INDENT.match(line).end())
    inline = lambda x: x.name is not None and (x.name in INLINE or x.name == "p")
    at = lambda k: every[k] if 0 <= k < len(every) else None
    blank = lambda x: x is not None and x.kind == "text" and not x.s.strip(WHITE)
    out = []
    for k, x in enumerate(every):
        if x.gone or (x.name in DROPPED and (x.opens or x.closes)):
            continue
        if x.kind == "tag":
            if x.name is None:
                out.append(x.s)
                continue
            far = at(k + 2) if x.opens else at(k - 2) if x.closes else None
            x.empty = far is not None and inline(far) and (far.closes if x.opens else far.opens) and blank(at(k + 1 if x.opens else k - 1))
            out.append(_rewritten(x))
            continue
        body = x.s
        common = least.get(x.common, 0) if x.depth > 0 else 0
        if x.depth > 0 or x.steps:
            parts, pad, text = body.split("\n"), "   " * x.steps, x.kind == "text"
            for i, line in enumerate(parts):
                if x.starts or i:
                    if line.strip(" "):
                        parts[i] = pad + line[common:]
                    elif text and i == len(parts) - 1 and x.depth > 0:
                        parts[i] = ""
            body = "\n".join(parts)
        if x.kind == "text":
            before, after = at(k - 1), at(k + 1)
            body = body.lstrip(WHITE) if before and before.opens and inline(before) else body
            body = body.rstrip(WHITE) if after and after.closes and inline(after) else body
        out.append(body)
    return "".join(out).removesuffix("\n")


def underlined(lines: list[str]) -> list[str]:
    """The lines with underlined headings as headings behind number signs, each with as many lines as before."""
    out = lines
    for at, line in enumerate(lines):
        if line.lstrip(" ")[:1] not in ("=", "-") or not UNDERLINE.match(line):
            continue
        a = at
        while a and lines[a - 1].strip(WHITE) and not NO_PARAGRAPH.match(lines[a - 1]):
            a -= 1
        if a < at and (a == 0 or (a >= 2 and lines[a - 1] == "")):
            out = list(lines) if out is lines else out
            title = LINE_END.sub(" ", "\n".join(lines[a:at]).strip(" "))
            out[a : at + 1] = [("# " if line.rstrip(" \t").endswith("=") else "## ") + title] + [""] * (at - a)
    return out


def normalised(text: str | None) -> str:
    """A page as plain Markdown: without top-level exports and expressions, component tags and underlined headings.  A page without a tag keeps its lines."""
    lines = page_lines(text)
    whole = "\n".join(lines)
    # told by the text as it was: a page that only held a script has had a tag
    if BUSY.search((text or "").replace("\r", "\n")):
        spans = fences(lines)
        if STATEMENT.search(whole) and (gone := statements(lines, spans)):
            out = {i for a, b in gone for i in range(a, b + 1)}
            lines = [x for i, x in enumerate(lines) if i not in out]
            spans = fences(lines)
        whole = components(lines, spans)
    lines = whole.split("\n")
    if not any(x.lstrip(" ")[:1] in ("=", "-") and UNDERLINE.match(x) for x in lines):
        return whole
    return "\n".join(x for part, fenced in between(lines, fences(lines)) for x in (part if fenced else underlined(part)))


def inline_text(text: str) -> str:
    """Plain text of a line: images as their alternative text, links as theirs, code with its backticks, no tags or emphasis marks."""
    if "](" in text:
        text = LINK.sub(r"\1", PICTURE.sub(r"\1", text))
    if "<" in text:
        text = MARKUP.sub("", text)
    if "*" in text or "_" in text:
        text = EMPHASIS.sub("", text)
    return text.strip(" ")


def slugify(text: str) -> str:
    """As ``functions.text.slugify``."""
    low = text.lower()
    kept = SLUG_OUT.sub("", low) if low.isascii() else "".join(c for c in low if (c in "_-" or c in WHITE) or unicodedata.category(c)[0] in "LMN")
    return SLUG_GAP.sub("-", kept).strip("-")


def looks_like_prose(text: str) -> bool:
    """As ``parse.looks_like_prose``."""
    rows = [y for x in text.strip(" ").split("\n") if (y := x.strip(" "))]
    prose = [x for x in rows if len(WORDS.split(x)) >= 5 and LETTER.search(x)]
    return bool(rows) and not any(CODE_BEGIN.match(x) for x in rows[:2]) and len(prose) / len(rows) >= 0.6 and any(SENTENCE_END.search(x) for x in prose)


def atom_id(section_id: str, position: int, suffix: str) -> str:
    return hashlib.sha256(f"{section_id}|{position}|{suffix}".encode()).hexdigest()[:16]


def cells(line: str) -> list[str]:
    return [c.replace("\\|", "|").strip(" ") for c in CELL.split(CELL_ENDS.sub("", line.strip(" ")))]


class Line:
    """pos, text, fence (the number of its fenced block or 0), mark (whether it is one of the block's marks), level, heading, section_id, kind, run (the number of its list, quote or code block), callout."""

    __slots__ = ("pos", "text", "fence", "mark", "level", "heading", "section_id", "kind", "run", "callout")

    def __init__(self, pos: int, text: str, fence: int, mark: bool, level: int, heading: str | None) -> None:
        self.pos, self.text, self.fence, self.mark, self.level, self.heading = pos, text, fence, mark, level, heading
        self.section_id = self.run = self.callout = None
        self.kind = "other"


def read_lines(text: str | None) -> list[Line]:
    lines = page_lines(normalised(text))
    out, at, no = [], 0, 0

    def plain(end: int) -> None:
        for i in range(at, end):
            line, level, heading = lines[i], 0, None
            if "#" in line and (m := HEADING.match(line)):
                level, heading = len(m[1]), inline_text(HEADING_END.sub("", HEADING_MARK.sub("", line, count=1)))
            out.append(Line(i, line, 0, False, level, heading))

    for no, (a, b, closed) in enumerate(fences(lines), 1):
        plain(a)
        out += [Line(i, lines[i], no, i == a or (closed and i == b), 0, None) for i in range(a, b + 1)]
        at = b + 1
    plain(len(lines))
    return out


def outline(lines: list[Line], path: str, url: str) -> list[tuple]:
    """Gives the lines their section, and returns the sections.  A page with content before its first section gets a line of its own at -1, the Overview.

    A section is open until a heading of its level or a smaller one: the last heading of level k is an ancestor if none of a smaller level came after it.
    """
    title = next((x.heading for x in lines if x.level == 1), path)
    first = next((x.pos for x in lines if x.level >= 2), None)
    content = next((x.pos for x in lines if not x.level and x.text.strip(" ")), None)
    if first is None or (content is not None and content < first):
        lines.insert(0, Line(-1, "", 0, False, 2, "Overview"))
    open_: dict[int, tuple[int, str, str]] = {}
    times: dict[str, int] = defaultdict(int)
    found, section_id = [], None
    for x in lines:
        if x.level >= 2:
            base = slugify(x.heading) or "section"
            anchor = f"{base}-{times[base]}" if times[base] else base
            times[base] += 1
            section_id, newest, above = f"{url}#{anchor}", -2, []
            for k in range(2, min(x.level, DEEPEST)):
                if k in open_ and open_[k][0] > newest:
                    above.append(open_[k])
                    newest = open_[k][0]
            crumb = " > ".join([title, *(h for _, h, _ in above), x.heading])
            found.append((x.pos, len(found), x.level, x.heading, anchor, section_id, above[-1][2] if above else None, crumb, UPDATE in x.text))
            if x.level < DEEPEST:
                open_[x.level] = x.pos, x.heading, section_id
        x.section_id = section_id
    return found


def name_kinds(lines: list[Line]) -> None:
    """Gives the lines outside code and headings their kind: item (of a list), more (of the item before it), code (indented by four, after an empty line), quote, rule, image, prose, blank, or other;
    run, the number of the list, quote or code block that a line is part of; and callout, the number of the callout that it stands in.

    A list goes on over empty lines to the next item or indented line; what is indented there is never code.  A quote goes on with the lines of a paragraph that stand right under it.
    An indented block that looks like prose is prose.
    """
    owner = opener = None
    above = before = "blank"
    in_list = False
    block = lists = quotes = opened = closed = 0
    for x in lines:
        line, fence = x.text, x.fence
        bare = line.strip(" ")
        if fence or x.level:
            kind = "other"
        elif not bare:
            kind = "blank"
        else:
            c = bare[0]
            white = line[0] in WHITE
            c = line.lstrip(WHITE)[:1] if c in WHITE else c
            if c == "<" and IMAGE.match(line):
                kind = "image"
            elif c == ">" and QUOTE.match(line):
                kind = "quote"
            elif c in "*-_" and c and RULE.match(line):
                kind = "rule"
            elif (c in "*+-" or c.isdigit()) and ITEM.match(line):
                kind = "item"
            elif c in "|<" and TABLE_OR_COMMENT.match(line):
                kind = "other"
            else:
                kind = ("deep" if DEEP.match(line) else "shallow") if white else "flush"
        loose = kind in ("flush", "shallow", "deep")
        if not loose:
            owner = kind
        elif owner == "quote":
            kind, loose = "quote", False
        # the last line that begins or ends a list: an item, or a line at the margin after an empty one, a heading, a fence that isn't indented, a table, a quote or a rule
        was_in_list = in_list
        if kind == "item":
            in_list = True
        elif fence:
            if x.mark and line[:1] not in tuple(WHITE):
                in_list = False
        elif kind in ("other", "quote", "rule", "image") or (kind == "flush" and above == "blank"):
            in_list = False
        above = kind
        if loose:
            kind = "more" if in_list else "deep" if kind == "deep" else "prose"
        # an indented block begins after an empty line, a heading or another block, not within a paragraph
        if kind == "deep":
            if before != "deep":
                opener = before
        elif kind != "blank":
            block += 1
        lists += kind == "item" and not was_in_list
        quotes += kind != "quote"
        before = kind
        x.run = lists if kind in ("item", "more") else block if kind == "deep" else quotes if kind == "quote" else None
        x.kind = kind if kind != "deep" else "prose" if opener == "prose" else "code"
        comment = not fence and "<!--" in line
        opened += comment and CALLOUT_KIND.search(line) is not None
        x.callout = opened if opened > closed else None
        closed += comment and CALLOUT_END in line


def pieces(lines: list[Line]) -> list[tuple]:
    """What stands in the sections, piece by piece: section_id, callout, pos (of the first line), text and kind: prose, list, deep (indented prose), quote, rule, image, or code (indented blocks).

    A list is a line for each item, two blanks for each level above it, then a dash, or in a list that begins with a number one more than the items closed before it.  Levels are the ranks
    of the indentations of a list; further lines of an item are joined to it.  A quote is a mark, and what stands in it, without marks, list marks, headings' signs and fenced blocks.
    """
    out, groups = [], {}
    prose, before = None, None
    for x in lines:
        kind = x.kind
        if kind == "prose":
            if prose is None or (before is not None and TITLE in before.text):
                prose = (x, [])
                out.append(prose)
            prose[1].append(inline_text(x.text))
        else:
            prose = None
            if kind in ("item", "more", "code", "quote"):
                key = "list" if kind in ("item", "more") else kind, x.section_id, x.callout, x.run
                if key not in groups:
                    groups[key] = []
                    out.append((key[0], groups[key]))
                groups[key].append(x)
            elif kind == "rule":
                out.append((x.section_id, x.callout, x.pos, "---", "rule"))
            elif kind == "image":
                path, alt = (v.replace("&quot;", '"') for v in IMAGE.match(x.text).groups())
                out.append((x.section_id, x.callout, x.pos, f"[image: {alt}]({path})", "image"))
        before = x
    done = []
    for piece in out:
        if len(piece) == 5:
            done.append(piece)
        elif isinstance(piece[0], Line):
            done.append((piece[0].section_id, piece[0].callout, piece[0].pos, " ".join(piece[1]), "prose"))
        else:
            kind, own = piece
            text = {"list": _list, "code": lambda ls: "\n".join(FOUR.sub("", x.text, count=1) if FOUR.match(x.text) else x.text for x in ls), "quote": _quote}[kind](own)
            if text is not None:
                done.append((own[0].section_id, own[0].callout, own[0].pos, text, "deep" if kind == "code" and looks_like_prose(text) else kind))
    return done


def _list(lines: list[Line]) -> str:
    items: list[tuple[int, list[str]]] = []
    ordered = ITEM.match(lines[0].text)[2][0].isdigit()
    for x in lines:
        if x.kind == "item":
            m = ITEM.match(x.text)
            items.append((len(m[1]), [inline_text(m[3])]))
        else:
            items[-1][1].append(inline_text(x.text.strip(" ")))
    rank = {indent: n for n, indent in enumerate(sorted({i for i, _ in items}))}
    return "\n".join("  " * rank[indent] + (f"{nth - rank[indent]}. " if ordered else "- ") + " ".join(own).strip(" ") for nth, (indent, own) in enumerate(items, 1))


def _quote(lines: list[Line]) -> str | None:
    bare = [QUOTE_MARKS.sub("", x.text, count=1) if QUOTE_MARKS.match(x.text) else x.text for x in lines]
    said = [inline_text(x[m.end() :] if (m := QUOTED_MARK.match(x)) else x) for part, fenced in between(bare, fences(bare)) if not fenced for x in part]
    said = [x for x in said if x]
    return "> " + " ".join(said) if said else None


def code_blocks(lines: list[Line], own: list[tuple], path: str) -> list[tuple]:
    """Fenced and indented blocks, with the piece of text before each in its section, and the group that a fenced one stands in."""
    found: list[tuple] = []
    group = shut = 0
    held: dict[int, list[Line]] = {}
    groups: dict[int, str | None] = {}
    for x in lines:
        if "<!--" in x.text:
            group += GROUP in x.text
            shut += GROUP_END in x.text
        if x.fence:
            if x.fence not in held:
                held[x.fence], groups[x.fence] = [], f"{path}::cg{group}" if group > shut else None
            held[x.fence].append(x)
    for no, block in held.items():
        mark = block[0].text
        indent = INDENT.match(mark).end()
        # a line loses as much indentation as the opening mark has
        body = "\n".join(x.text[min(indent, INDENT.match(x.text).end()) :] if indent else x.text for x in block if not x.mark)
        m = LANGUAGE.match(THEME.sub("", mark) if "theme=" in mark else mark)
        found.append((block[0].pos, block[0].section_id, m[1] if m else "", body.rstrip("\n"), groups[no]))
    found += [(pos, section_id, "", text.rstrip("\n"), None) for section_id, _, pos, text, kind in own if kind == "code"]
    leads: dict[str, tuple[list[int], list[str]]] = defaultdict(lambda: ([], []))
    for section_id, callout, pos, text, kind in sorted(own, key=lambda p: p[2]):
        if kind != "code" and callout is None and text:
            leads[section_id][0].append(pos)
            leads[section_id][1].append(text)
    out, nth = [], defaultdict(int)
    for pos, section_id, language, text, group_id in sorted(found, key=lambda b: b[0]):
        at = bisect_left(leads[section_id][0], pos)
        preceding = leads[section_id][1][at - 1] if at else ""
        out.append((atom_id(section_id, nth[section_id], f"code-{language}"), section_id, pos, nth[section_id], language, text, preceding, group_id))
        nth[section_id] += 1
    return out


def tables(lines: list[Line]) -> list[tuple]:
    """Tables (a header and a line of dashes, then rows): section_id, pos, headers, linked, total, navigates, its number among those of its section and kind, and its rows as (pos, cells).

    One navigates if half or more of its cells hold a link and the first header names no data.
    """
    out, run, nth = [], [], defaultdict(int)

    def end() -> None:
        if len(run) > 1 and DASHES.match(run[1].text):
            rows = [(x.pos, cells(x.text)) for x in run[2:]]
            headers = [inline_text(c).lower() for c in cells(run[0].text)]
            total, linked = sum(len(c) for _, c in rows), sum("](" in c and CELL_LINK.search(c) is not None for _, cs in rows for c in cs)
            navigates = headers[0] not in DATA_HEADERS and total > 0 and linked / total >= 0.5
            key = run[0].section_id, navigates
            out.append((run[0].section_id, run[0].pos, headers, linked if rows else None, total if rows else None, navigates, nth[key], rows, run))
            nth[key] += 1

    for x in lines:
        if "|" in x.text and not x.fence and not x.level:
            run.append(x)
        elif run:
            end()
            run = []
    if run:
        end()
    return out


def menu(headers: list[str], rows: list[tuple[int, list[str]]]) -> str:
    """A navigation table as text: a line for each row, its cells under their headers."""
    out = []
    for _, row in rows:
        said = [f"{h}: {v}" if (h := headers[i] if i < len(headers) else "") else v for i, c in enumerate(row) if (v := inline_text(c))]
        if said:
            out.append("- " + "; ".join(said))
    return "\n".join(out)


def joined(own: list[tuple], key: int) -> dict:
    """The texts of pieces (section_id, callout, pos, text) by what stands at key, in their order, with empty lines between."""
    out: dict = defaultdict(list)
    for piece in own:
        out[piece[key]].append((piece[2], piece[3]))
    return {k: "\n\n".join(t for _, t in sorted(v)) for k, v in out.items()}


def header(lines: list[Line], text: str | None) -> tuple[str | None, str | None, str | None]:
    """The title, the first quote under it before the next heading, and the hash of the page."""
    content_hash = None if text is None else hashlib.sha256(text.encode()).hexdigest()
    title = next((x for x in lines if x.level == 1), None)
    if title is None:
        return None, None, content_hash
    after = [x for x in lines if x.pos > title.pos]
    end = next((i for i, x in enumerate(after) if x.level), len(after))
    quotes = [(pos, t) for _, _, pos, t, kind in pieces(after[:end]) if kind == "quote"]
    return title.heading, min(quotes)[1][2:] if quotes else None, content_hash


def callouts(lines: list[Line], said: list[tuple]) -> list[tuple]:
    """Callouts: node_id, section_id, position, kind and their paragraphs and lists."""
    texts = joined([p for p in said if p[1] is not None], 1)
    begun: dict[int, Line] = {}
    for x in lines:
        if x.callout is not None and x.callout not in begun and CALLOUT_KIND.search(x.text):
            begun[x.callout] = x
    out, nth = [], defaultdict(int)
    for no, x in begun.items():
        kind = CALLOUT_KIND.search(x.text)[1]
        out.append((atom_id(x.section_id, nth[x.section_id], f"callout-{kind}"), x.section_id, nth[x.section_id], kind, texts.get(no, "")))
        nth[x.section_id] += 1
    return out


def links(lines: list[Line], known: list[tuple]) -> list[tuple]:
    """Links outside code, headings and quotes: section_id, pos, nth, href, text, and the kind of table that they stand in."""
    source = {x.pos: "navigation_table" if t[5] else "table" for t in known for x in t[8]}
    own = [x for x in lines if "](" in x.text and not x.fence and not x.level and not QUOTE_LINE.match(x.text)]
    return [(x.section_id, x.pos, n, href, label, source.get(x.pos, "prose")) for x in own for n, (label, href) in enumerate(LINK.findall(x.text))]


def walk(path: str | None, text: str | None, prefix: str, wanted: tuple[str, ...]) -> dict[str, list[tuple]]:
    """The wanted parts of a page (others may be missing), each as rows of ``parse.PARTS``."""
    path = path or ""
    every = read_lines(text)
    outlined = outline(every, path, prefix + path.replace("\\", "/"))
    out: dict[str, list[tuple]] = {"outline": outlined}
    if wanted == ("outline",):
        return out
    name_kinds(every)
    lines = [x for x in every if x.section_id is not None]
    asks = lambda *names: "held" in wanted or any(n in wanted for n in names)
    own = pieces(lines) if asks("pieces", "texts", "whole_texts", "blocks", "callouts") else []
    known = tables(lines) if asks("tables", "rows", "menus", "whole_texts", "links") else []
    said = [p for p in own if p[3] and p[4] != "code"]
    outside = [p for p in said if p[1] is None]
    if "header" in wanted:
        out["header"] = [header(every, text)]
    if "pieces" in wanted:
        out["pieces"] = [p for p in own if p[4] != "code"]
    if "tables" in wanted:
        out["tables"] = [t[:7] for t in known]
    if "texts" in wanted:
        out["texts"] = list(joined(outside, 0).items())
    if asks("menus", "whole_texts"):
        out["menus"] = [(t[0], t[1], said_) for t in known if t[5] and (said_ := menu(t[2], t[7]))]
    if asks("whole_texts"):
        out["whole_texts"] = list(joined([*outside, *((s, None, pos, t) for s, pos, t in out["menus"])], 0).items())
    if asks("blocks"):
        out["blocks"] = code_blocks(lines, own, path)
    if asks("rows"):
        out["rows"] = [(atom_id(t[0], i + 1000 * t[6], "row"), t[0], i, t[6], t[2], [inline_text(c) for c in row]) for t in known if not t[5] for i, (_, row) in enumerate(t[7])]
    if asks("callouts"):
        out["callouts"] = callouts(lines, said)
    if asks("links"):
        out["links"] = links(lines, known)
    if "held" in wanted:
        needed = {s[6] for s in outlined} | {s for s, t in out["whole_texts"] if t.strip(" ")} | {r[1] for part in ("blocks", "rows", "callouts") for r in out[part]} | {r[0] for r in out["links"]}
        out["held"] = [s for s in outlined if s[5] in needed]
    return out

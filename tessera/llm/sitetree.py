"""HTML extraction with a site style tree.

The pages of a host are merged into one tree: a node is a path of styles (tag and
class names, from the root).  A node's importance has two parts, each an entropy
over the m pages that hold the node.  Presentation: the entropy of the sequences of
child styles that the node has (one fixed sequence: 0).  Content: one less the mean
entropy of its text blocks over pages (a block that is on c of m pages has log c /
log m: a notice that stands on all of them 1, a text of one page 0); a block counts for
the WITHIN nearest elements that hold it.  Outside article and main, where other links on each page
keep a menu's entropy high, importance falls with the share of its characters that are short links (of LINK_WORDS words at most), over all pages of the host.
What only goes with others (headings, terms, captions, rows, cells and items of lists) shares the fate of the element that holds it and is never judged alone; and in
article and main headings and the like, which repeat from page to page by their nature, are no evidence against what holds them.
The evidence of m pages is weighed against a prior of 1 that counts as PRIOR pages (PRIOR_INSIDE
in article and main), at every m alike.  Pages with the
same text outside named parts count as one page, whatever their menus and adverts are.
Blocks that stand on the same pages, and together are most of the text
there, are one article and its near copies: each counts as on one page.
Branches of low importance are noise and are cut out of each page.

What HTML itself says about a part is taken as said: nav, aside, footer, form, script and the like, and the landmark
roles.  So are, outside article and main, classes, ids and roles that are a part's name as a whole ("comments",
"cookie-banner", "left-sidebar", but not "has-sidebar" or "ad-hoc"), as where a host has one page no tree can tell.  Inside
article and main no role but a landmark counts, and only a class that is one of INNER_NAMES, on an element that groups others, or an id or class of reader comments (COMMENT_NAMES), unless that would
leave nothing of the page's text.  A head ends where what can't stand in it begins, also without its end tag.
Wholes (html, body, article, main), headings and inline elements are never named parts.  What is left inside article or main
elements, or else in the body, is the text, block by block.

Nulls: a null html is empty; a null url makes a host of its own.  A page without text
has the empty text.  Repeated rows each give a row; an empty table gives none; other
columns are not read.  The time for a page grows with its length, however malformed or deep it is.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import saved, tidy
from tessera.llm.words import slices

#: Importance from which on a node stays; the share of presentation in it; pages that the prior counts as, outside and inside of articles.
LEAST_IMPORTANCE, PRESENTATION, PRIOR, PRIOR_INSIDE = 0.3, 0.1, 1.0, 4.0
#: Blocks that always come together are an article, not a notice, if they hold this share of the characters of the text.
ARTICLE_SHARE = 0.8
#: Elements above a block that it counts for, nearest first.
WITHIN = 64
#: Links of more words are text.
LINK_WORDS = 3
#: So many noise nodes (about 70 bytes each in a worker) are sent to all tasks; more are joined with the pages instead, with the same result.
BROADCAST_NODES = 100_000
SALTS = 32

# Fixed values of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template noframes".split())
ENDS = {k: (a.split(), b.split()) for k, a, b in (("li", "li", "ul ol menu"), ("dt", "dt dd", "dl"), ("dd", "dt dd", "dl"), ("tr", "tr td th", "table"), ("td", "td th", "tr table"), ("th", "td th", "tr table"), ("option", "option", "select"))}
# Elements that hold a page's text as a whole: never noise.
WHOLE = frozenset("html body article main".split())
# Elements and landmark roles that say that they are no text of the page; the last are so outside article and main alone.
PARTS_BY_TAG = frozenset("head nav footer aside form button select svg object canvas audio video".split()) | RAW
LANDMARKS = frozenset("navigation complementary contentinfo search form banner menu menubar alert dialog alertdialog".split())
OUTER_TAGS = frozenset("header menu dialog".split())
# Classes, ids and roles that name a part of a page other than its text, outside article and main.
PARTS_BY_NAME = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs pagination pager "
    "footer header sidebar aside widget cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "comment comments disqus reply replies share sharing social related recommended search toolbar masthead skip".split()
)
# Words that may stand beside a part's name.
BESIDE = frozenset("site page top bottom left right main primary secondary global list links buttons bar box form posts icons slot unit block wrapper container area zone".split())
# Classes of advertisements, comments and the like inside article and main, and elements that may have them.
INNER_NAMES = frozenset("ad ads advert adverts advertisement advertising ad-slot ad-box sponsored comments comment-list reader-comments share-buttons social-share newsletter newsletter-signup related-posts cookie-banner cookie-notice breadcrumbs pagination".split())
GROUPING = frozenset("div section ul ol dl table figure details ins".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements of reader comments by id (not on sections, which may be named by a heading) or class.
COMMENT_NAMES = frozenset("comments comment-list commentlist reader-comments user-comments comments-area comments-section comment-section comment-thread disqus_thread".split())
LABELS = HEADINGS | frozenset("hgroup dt th caption figcaption legend summary".split())
# Elements that are never judged alone.
UNJUDGED = WHOLE | LABELS | frozenset("dd td li tr thead tbody tfoot colgroup".split())
HEAD_ONLY = frozenset("base basefont bgsound link meta title style script noscript template head html".split())
NEVER_NAMED = WHOLE | HEADINGS | INLINE

RAW_ENDS = {tag: re.compile(rf"</{tag}\s*[^>]*>", re.I) for tag in RAW}
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)(?:((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|([^>]*)>)")
NAMES = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SPLIT = re.compile(r"[\s_\-:]+")
COMMENT_END = re.compile(r"--!?>")
LONG_NUMBER = re.compile(r"&#([0-9]{8,});?")

_paths: dict[tuple[int, str, str], int] = {}
_named: dict[str, bool] = {}


def part_of(name: str) -> bool:
    """Whether a class, id or role is the name of a part of a page as a whole."""
    if (found := _named.get(name)) is None:
        words = [w for w in SPLIT.split(name) if w and not w.isdigit()]
        found = not PARTS_BY_NAME.isdisjoint(words) and all(w in PARTS_BY_NAME or w in BESIDE for w in words)
        if len(_named) < 100_000:
            _named[name] = found
    return found


def tokens(source: str) -> Iterator[tuple[int, int, str, str, bool]]:
    """Begin, end, tag, attributes and whether it closes, of each tag; comments and declarations have no tag name."""
    at, last = 0, source.rfind(">")
    while (at := source.find("<", at)) >= 0:
        end, tag, attributes, closes = 0, "", "", False
        if source.startswith("<!--", at):
            found = COMMENT_END.search(source, at + 4)
            end = at + 5 if source.startswith(">", at + 4) else at + 6 if source.startswith("->", at + 4) else found.end() if found else len(source)
        elif at < last:
            if source[at + 1] in "!?":
                end = source.find(">", at) + 1
            elif m := TAG.match(source, at):
                end, tag, attributes, closes = m.end(), m[1].lower(), m[2] if m[2] is not None else m[3], source[at + 1] == "/"
        if end:
            yield at, end, tag, attributes, closes
        at = end or at + 1


def unescaped(raw: str) -> str:
    """With character references decoded; a number too long for a character is the replacement character, however many digits it has."""
    if "&#" in raw:
        raw = LONG_NUMBER.sub(lambda m: "\ufffd" if len(n := m[1].lstrip("0")) > 7 else f"&#{n or 0};", raw)
    return html.unescape(raw)


def child_path(parent: int, tag: str, names: str) -> int:
    key = (parent, tag, names)
    if (h := _paths.get(key)) is None:
        h = xxhash.xxh64_intdigest(f"{parent}>{tag}.{names}") - (1 << 63)
        if len(_paths) < 100_000:
            _paths[key] = h
    return h


class Element:
    __slots__ = ("children", "main", "out", "path", "tag", "told")

    def __init__(self, tag: str, path: int, out: bool, main: bool, told: bool = False):
        self.tag, self.path, self.out, self.main, self.told, self.children = tag, path, out, main, told, []


def named_part(tag: str, attributes: str, main: bool) -> tuple[str, bool, bool, bool]:
    """The class names of an element, whether it or what it stands in is main, and whether its names make it a part, or reader comments in main."""
    if "=" not in attributes:
        return "", main or tag in ("article", "main"), False, False
    found = {n.lower(): a or b or c for n, a, b, c in NAMES.findall(attributes)}
    classes, roles = found.get("class", "").lower().split(), found.get("role", "").lower().split()
    main = main or tag in ("article", "main") or "main" in roles
    if not found or tag in NEVER_NAMED or "main" in roles:
        return " ".join(sorted(classes)), main, False, False
    part = not LANDMARKS.isdisjoint(roles) or (not INNER_NAMES.isdisjoint(classes) and tag in GROUPING)
    if not main and not part:
        part = any(map(part_of, classes)) or any(map(part_of, roles)) or (tag != "section" and any(map(part_of, found.get("id", "").lower().split())))
    told = main and tag in GROUPING and (not COMMENT_NAMES.isdisjoint(classes) or (tag != "section" and not COMMENT_NAMES.isdisjoint(found.get("id", "").lower().split())))
    return " ".join(sorted(classes)), main, part and not told, told


def walk(source: str, host: int, noise: frozenset | set = frozenset(), note: Callable[[str, str], None] | None = None) -> tuple[list[tuple[str, tuple[int, ...], bool, bool, float]], list[tuple[int, int, bool]]]:
    """The blocks of a page, as (text, paths above that it is evidence for, cut out, in main, share of short links), and (path, hash of the child styles, in main) of each element.

    Reader comments by name are cut out if the page has other text in main.  note: gets the tag and the attributes of each link, and the tag and the text of each title.
    """
    stack, blocks, shapes, piece = [Element("", host, False, False)], [], [], []
    inner: list[int] = []  # places in the stack of elements that aren't inline
    trail: list[int] = []  # the paths of those that aren't wholes
    opened: Counter[str] = Counter()
    anchor: list[str] = []
    told: list[int] = []  # the blocks of reader comments by name
    labels = linked = 0

    def settle() -> None:
        nonlocal linked
        if anchor:
            text = "".join(anchor)
            anchor.clear()
            if len(text.split(None, LINK_WORDS)) <= LINK_WORDS:
                linked += len(text.strip())

    def flush() -> None:
        nonlocal linked
        settle()
        if piece:
            raw = "".join(piece)
            text = " ".join(unescaped(raw).split())
            piece.clear()
            if text:
                if stack[-1].told:
                    told.append(len(blocks))
                blocks.append((text, () if labels and stack[-1].main else tuple(trail[-WITHIN:]), stack[-1].out, stack[-1].main, min(1.0, linked / max(len(raw.strip()), 1))))
        linked = 0

    def close(n: int) -> None:
        nonlocal labels
        for e in stack[n:]:
            opened[e.tag] -= 1
            labels -= e.tag in LABELS
            if e.tag not in UNJUDGED:
                shapes.append((e.path, xxhash.xxh64_intdigest(repr(e.children)) - (1 << 63), e.main))
        while inner and inner[-1] >= n:
            if stack[inner.pop()].tag not in UNJUDGED:
                trail.pop()
        del stack[n:]

    def add(text: str) -> None:
        if text:
            if opened["head"] and not text.isspace():
                leave_head()
            piece.append(text)
            if opened["a"]:
                anchor.append(text)

    def leave_head() -> None:
        n = len(stack) - 1
        while stack[n].tag != "head":
            n -= 1
        close(n)

    at = 0
    for begin, end, tag, attributes, closes in tokens(source):
        if begin < at:
            continue  # inside a script or the like
        add(source[at:begin])
        at = end
        if not tag:
            continue
        if tag == "a":
            settle()
            if note and not closes:
                note(tag, attributes)
        if closes:
            if tag not in INLINE:
                flush()
            if opened[tag] > 0:
                n = len(stack) - 1
                while stack[n].tag != tag:
                    n -= 1
                close(n)
            continue
        if opened["head"] and tag not in HEAD_ONLY:
            flush()
            leave_head()
        if tag in INLINE:
            if tag == "br":
                piece.append(" ")
            if tag in VOID:
                continue
        else:
            flush()
            ends, scope = ENDS.get(tag, ((), ()))
            n = len(inner) - 1
            while n >= 0:
                above = stack[inner[n]].tag
                if above == "p" or above in ends:
                    close(inner[n])
                elif above in scope or above not in ENDS:
                    break
                n -= 1
        parent = stack[-1]
        names, main, part, comments = named_part(tag, attributes, parent.main)
        path = child_path(parent.path, tag, names)
        out = parent.out or part or tag in PARTS_BY_TAG or (path in noise and tag not in UNJUDGED) or (not main and tag in OUTER_TAGS)
        if tag not in INLINE:
            parent.children.append((tag, names))
        if tag in RAW:
            found = RAW_ENDS[tag].search(source, at)
            if note and tag == "title":
                note(tag, source[at : found.start() if found else len(source)])
            at = found.end() if found else len(source)
        elif tag not in VOID and not attributes.rstrip().endswith("/"):
            if tag not in INLINE:
                inner.append(len(stack))
                if tag not in UNJUDGED:
                    trail.append(path)
            stack.append(Element(tag, path, out, main, parent.told or comments))
            opened[tag] += 1
            labels += tag in LABELS
    add(source[at:])
    flush()
    close(1)
    if told and len(told) < sum(main and not out for _, _, out, main, _ in blocks):
        for i in told:
            text, paths, _, main, share = blocks[i]
            blocks[i] = (text, paths, True, main, share)
    return blocks, shapes


def page_text(source: str, host: int, noise: frozenset | set = frozenset()) -> str:
    blocks, _ = walk(source, host, noise)
    kept = [(t, main) for t, _, out, main, _ in blocks if not out]
    inside = [t for t, main in kept if main]
    return "\n".join(inside or [t for t, _ in kept])


def host_of(url: str | None) -> int:
    m = re.match(r"\s*(?:[a-zA-Z][\w+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return xxhash.xxh64_intdigest((m[1] if m else "").lower()) - (1 << 63)


STYLE_ROWS = pa.schema([("node", pa.int64()), ("kind", pa.int8()), ("feature", pa.int64()), ("page", pa.int64()), ("chars", pa.int64()), ("total", pa.int64()), ("size", pa.int64()), ("linked", pa.float64()), ("main", pa.bool_())])


def style_rows(pages: DataFrame) -> DataFrame:
    """node, kind (0: a page has it, 1: a child sequence, 2: a text block), feature and page of every page's own tree.

    Pages of a host with the same text have one page hash.  chars: of a block of the text that would be kept without the tree; total: of all
    of these; size and linked: characters of a block and those in links; main: whether the node is in article or main.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                columns: list[list] = [[] for _ in STYLE_ROWS]
                for url, source in zip(batch.column(0).slice(lo, hi - lo).to_pylist(), batch.column(1).slice(lo, hi - lo).to_pylist(), strict=True):
                    host, source = host_of(url), source or ""
                    blocks, shapes = walk(source, host)
                    has_main = any(main and not out for _, _, out, main, _ in blocks)
                    text = {t for t, _, out, main, _ in blocks if not out and main >= has_main}
                    page = xxhash.xxh64_intdigest(repr((host, sorted(text)))) - (1 << 63)
                    total = sum(map(len, text))
                    rows = {(p, 2, xxhash.xxh64_intdigest(t) - (1 << 63), len(t) if not out and main >= has_main else 0, total if not out and main >= has_main else 0, len(t), share * len(t), main) for t, paths, out, main, share in blocks for p in paths}
                    rows |= {(p, 1, s, 0, 0, 0, 0.0, main) for p, s, main in shapes}
                    rows |= {(p, 0, 0, 0, 0, 0, 0.0, main) for p, _, main in shapes}
                    for p, k, f, c, t, n, share, main in rows:
                        for column, value in zip(columns, (p, k, f, page, c, t, n, share, main), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, STYLE_ROWS, strict=True)], schema=STYLE_ROWS)

    schema = "node long, kind byte, feature long, page long, chars long, total long, size long, linked double, main boolean"
    return pages.select(F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(tidy(task), schema)


def importance(pages: DataFrame) -> DataFrame:
    """node, pages, importance (the entropies alone), linked (the share of its characters in links), main, of every node of every host's tree."""
    of = ["chars", "total", "size", "linked", "main"]
    by_page = style_rows(pages).groupBy("node", "kind", "feature", "page").agg(*[F.max(c).alias(c) for c in of])
    counted = by_page.groupBy("node", "kind", "feature").agg(F.count("*").alias("c"), F.bit_xor("page").alias("on"), F.max("chars").alias("chars"), F.avg("total").alias("total"), F.sum("size").alias("size"), F.sum("linked").alias("linked"), F.max("main").alias("main"))
    counted = saved(counted, "style-counts")
    # blocks that stand on the same pages and are most of the text there: copies of one article
    repeated = counted.where("kind = 2 AND c > 1 AND chars > 0")
    groups = repeated.groupBy("on", "c", "feature").agg(F.max("chars").alias("chars"), F.max("total").alias("total")).groupBy("on", "c").agg(F.sum("chars").alias("held"), F.max("total").alias("total"))
    articles = groups.where(F.col("held") >= ARTICLE_SHARE * F.col("total")).select("on", "c")
    copies = repeated.join(articles, ["on", "c"]).groupBy("node").agg(F.sum(F.log("c")).alias("copies"))
    # sum of c log c and so on: entropies follow when m is known
    sums = counted.groupBy("node").agg(
        F.max(F.when(F.col("kind") == 0, F.col("c"))).alias("m"), F.max("main").alias("main"), F.sum("size").alias("size"), F.sum("linked").alias("linked"),
        F.sum(F.when(F.col("kind") == 1, F.col("c") * F.log("c"))).alias("shape_clogc"), F.sum(F.when(F.col("kind") == 1, F.col("c"))).alias("shape_c"),
        F.sum(F.when(F.col("kind") == 2, F.log("c"))).alias("text_logc"), F.count(F.when(F.col("kind") == 2, 1)).alias("blocks"),
    ).join(copies, "node", "left")
    logm = F.log(F.greatest(F.col("m"), F.lit(2)))
    shape = F.coalesce((F.log("shape_c") - F.col("shape_clogc") / F.col("shape_c")) / logm, F.lit(1.0))
    text_logc = (F.col("text_logc") - F.coalesce("copies", F.lit(0.0))) / F.nullif("blocks", F.lit(0))
    text = F.coalesce(1 - text_logc / logm, F.lit(1.0))
    linked = F.coalesce(F.col("linked") / F.nullif("size", F.lit(0)), F.lit(0.0))
    return sums.select("node", F.col("m").alias("pages"), (F.lit(PRESENTATION) * shape + F.lit(1 - PRESENTATION) * text).alias("importance"), linked.alias("linked"), "main")


def noise_nodes(pages: DataFrame) -> DataFrame:
    """The nodes whose importance is low when the evidence of their pages, the prior and, outside of articles, their links are counted together."""
    prior = F.when(F.col("main"), PRIOR_INSIDE).otherwise(PRIOR)
    weighed = (F.col("importance") * F.col("pages") + prior) / (F.col("pages") + prior)
    return importance(pages).where(weighed * F.when(F.col("main"), 1.0).otherwise(1 - F.col("linked")) < LEAST_IMPORTANCE).select("node")


def _texts(pages: DataFrame, noise_column: bool, sent) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = frozenset() if noise_column else sent.value
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                part = batch.slice(lo, hi - lo)
                own = part.column(3).to_pylist() if noise_column else [None] * (hi - lo)
                texts = [page_text(s or "", host_of(u), frozenset(n or ()) if noise_column else shared) for u, s, n in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), own, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(tidy(task), "page_id long, url string, text string, n_chars long")


def extract(pages: DataFrame, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    noise = saved(noise_nodes(own), "noise")
    if noise.count() <= broadcast_nodes:
        return _texts(own, False, own.sparkSession.sparkContext.broadcast(frozenset(r["node"] for r in noise.collect())))
    # more noise than one task should hold: each page gets its own nodes, hot hosts spread over salts
    keyed = own.withColumn("row", F.xxhash64("page_id", "url", "html"))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, paths = [], []
            for row, url, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = {p for p, _, _ in walk(source or "", host_of(url))[1]}
                rows += [row] * len(found)
                paths += found
            yield pa.RecordBatch.from_pydict({"row": pa.array(rows, pa.int64()), "node": pa.array(paths, pa.int64())})

    held = keyed.select("row", "url", "html").mapInArrow(tidy(nodes), "row long, node long").withColumn("salt", F.pmod(F.hash("row"), F.lit(SALTS)))
    salted = noise.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    per_page = held.join(salted, ["node", "salt"]).groupBy("row").agg(F.collect_set("node").alias("noise"))  # a page's own nodes
    return _texts(keyed.join(per_page, "row", "left").select("page_id", "url", "html", "noise"), True, None)

import hashlib
import html
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import annlsh, decontam, langid, licences, minhash, piece, sitetree, tokenbin, toxicity, warc, words

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LONG = " ".join(f"w{i % 977}x" for i in range(30_000))
#: Nulls, empty and very long texts, repeated rows, odd characters; the extra columns clash with what operators add.
HARD = [(None, "one two three"), (1, None), (2, ""), (3, "same words here now again"), (3, "same words here now again"), (4, LONG), (5, "ÉTÉ à 日本 😀 x"), (6, " \n\t "), (7, "same words here now again"), (8, "<s> ▁ a  b\x00c"), (9, "L'été 'll 123 4.5,, thé. Thé,")]
HARD_SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def hard(spark):
    frame = spark.createDataFrame(HARD, HARD_SCHEMA)
    for name in ("score", "lang_pred", "n_words", "n_hit", "p_toxic", "toxic_pred", "class_id", "node", "lang", "start", "ids", "hit_spans", "salt", "row"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame.cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], HARD_SCHEMA + ", lang string")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def found_words(text):
    return WORD.findall(lower(text))


# ---- words --------------------------------------------------------------------------------------

def test_words_are_those_of_the_pattern(docs):
    texts = [r["text"] for r in docs.limit(60).collect()] + [t for _, t in HARD]
    for column in (pa.array(texts), pa.array(["x", *texts]).slice(1)):
        w = words.split(column)
        assert [[w.word(i).decode() for i in range(w.offsets[t], w.offsets[t + 1])] for t in range(len(texts))] == [found_words(t) for t in texts]
    assert sum(hi - lo for lo, hi in words.slices(pa.array(texts), 100)) == len(texts)


# ---- 1 language ---------------------------------------------------------------------------------

def test_language_accuracy_held_out(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.predict(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(got) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)


def brute_language(learn, texts):
    """Word-first backoff, one word at a time: (language, posterior) of each text."""
    import regex

    split = lambda t: regex.findall(r"\p{L}+", (t or "").lower())
    words, grams = Counter(), Counter()
    for text, lang in learn:
        words.update((w, lang) for w in split(text))
    for (w, lang), n in words.items():
        for k in (5, 4, 3, 2, 1):
            for p in range(len(w) - k + 1):
                grams[w[p : p + k], lang] += n
    langs = sorted({lang for _, lang in words})

    def table(counts):
        keys = {k for k, _ in counts}
        sums = {x: sum(n for (_, y), n in counts.items() if y == x) for x in langs}
        return {k: [np.log((counts[k, x] + 0.5) / (sums[x] + 0.5 * len(keys))) for x in langs] for k in keys}

    known, parts, out = table(words), table(grams), []
    for t in texts:
        total = np.zeros(len(langs))
        for w in split(t):
            if w in known:
                total += known[w]
                continue
            for k in (5, 4, 3, 2, 1):
                if held := [parts[g] for p in range(len(w) - k + 1) if (g := w[p : p + k]) in parts]:
                    total += np.mean(held, axis=0)
                    break
        out.append((langs[int(total.argmax())], 1 / np.exp(total - total.max()).sum()) if split(t) else ("und", 0.0))
    return out


def test_language_equals_brute_force(docs):
    rows = docs.select("doc_id", "text", "lang").collect() + [(9001, "", None), (9002, None, None), (9003, "qqqq zzzz 12", None), (9001, "", None)]
    learn = [(t, lang) for i, t, lang in rows if lang is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    table = docs.sparkSession.createDataFrame([tuple(r) for r in rows], HARD_SCHEMA + ", lang string")
    got = Counter((r["doc_id"], r["lang_pred"], round(r["score"], 6)) for r in langid.predict(table).collect())
    assert got == Counter((r[0], lang, round(p, 6)) for r, (lang, p) in zip(rows, brute_language(learn, [r[1] for r in rows])))


def test_language_ties_go_to_the_first(spark):
    rows = [(1, "aa bb", "x"), (7, "aa bb", "y"), (5, "aa", None), (5, "aa", None)]
    got = langid.predict(spark.createDataFrame(rows, HARD_SCHEMA + ", lang string")).where("doc_id = 5").collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("x", 0.5)] * 2


def test_language_backoff_goes_to_shorter_grams():
    def model(grams):
        keys = sorted(grams)
        return langid.LanguageModel(["a", "b"], pa.array(["known"], pa.large_string()), np.array([[-1.0, -9.0]]), pa.array(keys, pa.large_string()), np.array([grams[k] for k in keys]))

    m = model({"wxyz": [-9.0, -1.0], "w": [-1.0, -9.0]})
    assert langid.score_texts(m, pa.array(["wxyz"]))[0] == ["b"]  # the longest known size counts
    assert langid.score_texts(m, pa.array(["wq"]))[0] == ["a"]
    assert langid.score_texts(m, pa.array(["known", "123", None, ""]))[0] == ["a", "und", "und", "und"]
    assert langid.score_texts(m, pa.array(["w" * 3000]))[0] == ["a"]


def test_language_counts_ngrams_of_whole_words(spark):
    word = "ab" * 31 + "cdefghijk" + "ab" * 40 + "xyz"  # n-grams over and after the 64th letter
    table = spark.createDataFrame([(1, f"{word} {word} pq", "a"), (2, "pq", "b")], HARD_SCHEMA + ", lang string")
    got = langid.fit(table)
    want = {w[p : p + k] for w in (word, "pq") for k in langid.SIZES for p in range(len(w) - k + 1)}
    assert set(got.grams.to_pylist()) == want
    counts = {g: sum(word[p : p + len(g)] == g for p in range(len(word))) for g in ("abab", "xyz")}
    score = dict(zip(got.grams.to_pylist(), got.gram_scores[:, 0].tolist()))
    assert abs(score["abab"] - score["xyz"] - np.log((2 * counts["abab"] + 0.5) / (2 * counts["xyz"] + 0.5))) < 1e-9


def test_language_hard_cases(spark, hard, empty, docs):
    model = langid.fit(docs)
    got = langid.identify(hard, model)
    assert got.columns.count("score") == 1 and got.count() == len(HARD)
    by = {(r["doc_id"], r["text"]): r for r in got.collect()}
    assert by[(1, None)]["lang_pred"] == by[(2, "")]["lang_pred"] == by[(6, " \n\t ")]["lang_pred"] == "und"
    assert langid.predict(empty).count() == 0
    nothing = langid.predict(spark.createDataFrame([(1, "abc", None)], HARD_SCHEMA + ", lang string")).collect()
    assert [(r["lang_pred"], r["score"]) for r in nothing] == [("und", 0.0)]


# ---- 2 token shards -----------------------------------------------------------------------------

def test_token_shards_equal_the_library(spark, docs, hard, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    table = docs.select("doc_id", "text").union(hard.select("doc_id", "text"))
    manifest = tokenbin.write_shards(table, path, f"file://{tmp_path}/shards", 2, 3, frame_ids=500)
    got = tokenbin.read_shards(spark, manifest).collect()
    want, start = [], 0
    for r in sorted(table.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "")):
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    # only the frames of the wanted document are read
    reads = []
    shard = tokenbin.open_shard(manifest[-1]["name"])
    plain, shard.read = shard.read, lambda at, n: (reads.append((at, n)), plain(at, n))[1]
    last = int(shard.index[-1][0])
    assert shard.find(last)[0].tolist() == [*library.encode(next(r["text"] for r in table.collect() if r["doc_id"] == last), add_special_tokens=False).ids, 2]
    assert sum(n for _, n in reads) < 0.5 * sum(x[0] for x in shard.table)
    assert shard.find(-5) == []


def test_token_shards_follow_the_size_of_the_texts(spark, docs, hard, monkeypatch):
    monkeypatch.setattr(tokenbin, "SHARD_BYTES", 20_000)
    path = public_tokenizers.path("word_bpe_49k.json")
    clash = hard.withColumn("n_tokens", F.lit("x")).withColumn("ids_crc32", F.lit("x"))
    few = tokenbin.encode_to_shards(spark, clash, path, shards=1).collect()
    many = tokenbin.encode_to_shards(spark, clash, path)
    assert many.rdd.getNumPartitions() > 8 or many.count() == len(few)
    assert Counter(map(tuple, many.collect())) == Counter(map(tuple, few)) and len(few) == len(HARD)


def test_token_shards_find_damage_and_take_an_empty_table(spark, empty):
    raw = bytearray()
    writer = tokenbin.ShardWriter(raw.extend, 4)
    for k in range(5):
        writer.add(k, np.arange(3, dtype=np.uint32))
    writer.finish()
    reader = tokenbin.ShardReader(lambda at, n: bytes(raw[at : at + n]), len(raw))
    assert [reader.ids(i).tolist() for i in range(5)] == [[0, 1, 2]] * 5
    raw[reader.begins[1] + 12] ^= 0xFF
    with pytest.raises(Exception):
        reader.frame(1)
    assert tokenbin.encode_to_shards(spark, empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0


# ---- 3 HTML -------------------------------------------------------------------------------------

def plain_article(source):
    inside = source[source.index("<article>") + 9 : source.index("</article>")]
    inside = re.sub(r"</?b>", "", re.sub(r"<br>", " ", re.sub(r"</?(?:p|h1)>", "\0", inside)))
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in inside.split("\0")) if x)


def test_html_text_of_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in sitetree.extract(pages).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == plain_article(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def site(n):
    page = '<html><head><title>t</title></head><body><header>Head</header><div class="x1">{same}</div><article><h1>T {i}</h1><div class="box">Stay in touch with us</div><p>Own text {i} &amp; more<p>second\n one {i}</article><div id="comments">nice {i}</div><form>f</form><footer>foot</footer></body></html>'
    return [(i, f"http://h.example/{i}", page.format(i=i, same="Welcome to our site")) for i in range(n)]


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_html_style_tree_cuts_what_every_page_has(spark, broadcast):
    rows = site(14) + [(100, None, None), (101, "http://h.example/x", ""), (102, "://", "<p>a<p>b<b>c"), (103, "http://one.example/", "<article><p>alone</article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("noise", F.lit(1))
    got = {r["page_id"]: r["text"] for r in sitetree.extract(pages, broadcast).collect()}
    assert got[3] == "T 3\nOwn text 3 & more\nsecond one 3"
    assert (got[100], got[101], got[102], got[103]) == ("", "", "a\nbc", "alone")
    assert sitetree.extract(pages.limit(0), broadcast).count() == 0


def test_html_copies_of_one_page_keep_their_text(spark):
    rows = [(i, "http://c.example/", "<article><p>one and the same page</article>") for i in range(30)]
    got = sitetree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).select("text").distinct().collect()
    assert [r["text"] for r in got] == ["one and the same page"]


@pytest.mark.parametrize("advert", ["ad", "x7"])
@pytest.mark.parametrize("articles", [1, 2])
def test_html_near_copies_keep_their_text(spark, articles, advert):
    text = [f"<h1>Title {k}</h1>" + "".join(f"<p>The article {k} tells in its paragraph {j} what it has to tell about things</p>" for j in range(6)) for k in range(articles)]
    rows = [(i, "http://h.example/", f'<html><body><nav><a>menu {i}</a></nav><article>{text[i % articles]}<div class="{advert}">Buy {i}</div></article></body></html>') for i in range(30)]
    got = {r["page_id"]: r["text"] for r in sitetree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(30):
        kept = plain_article(f"<article>{text[i % articles]}</article>")
        assert got[i] in (kept, f"{kept}\nBuy {i}") and ("Buy" in got[i]) == (advert == "x7")


def test_html_notices_of_articles_are_still_cut(spark):
    rows = [(i, "http://h.example/", f'<body><article><p>Some own text of page {i} {"w" * i}<div class="x1"><p>Follow this site<p>or write to it</div></article></body>') for i in range(30)]
    got = {r["page_id"]: r["text"] for r in sitetree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Some own text of page {i} {'w' * i}".strip() for i in range(30)}


@pytest.mark.parametrize("page", [
    '<body class="has-sidebar"><p>Text', '<body class="nav-open"><div><p>Text</div>', '<html class="no-ads"><body><p>Text', '<body><main id="search" class="widget"><p>Text</main>',
    '<body><article class="post comments-open"><p>Text</article>', '<body><article><section id="related-work"><p>Text</section></article>', '<body><section id="related-work"><p>Text</section>',
    '<body><section id="search"><p>Text</section>', '<body><article><div id="comments"><p>Text</div></article>', '<body><h2 id="search" class="notice">Text</h2>', '<body><h1 class="header">Text</h1>',
    '<body><div id="notice-period"><p>Text</div>', '<body><div class="with-sidebar"><p>Text</div>', '<body><div class="has-ads"><p>Text</div>', '<body><p>Te<b class="share">xt</b>', '<body><div role="main" class="widget"><p>Text</div>',
])
def test_html_names_leave_articles_alone(page):
    assert sitetree.page_text(page, 0) == "Text"


@pytest.mark.parametrize("part", ['class="ad"', 'class="x ad-slot"', 'id="comments"', 'class="comment-list"', 'class="cookie-banner"', 'class="left sidebar"', 'class="sidebar-left"', 'role="navigation"', 'role="search"', 'class="main-nav"', 'class="related-posts"', 'class="site-header"'])
def test_html_names_still_cut_parts(part):
    assert sitetree.page_text(f"<body><div {part}><p>Part</div><div class=\"story\"><p>Text</div></body>", 0) == "Text"


@pytest.mark.parametrize("inside", ['<h2 id="search">Text</h2>', '<h2 id="related-work">Text</h2>', '<p class="text-banner">Text</p>', '<section id="comment-on-method"><p>Text</section>', '<p class="ad-hoc">Text</p>', '<menu><li>Text</menu>', '<dialog open>Text</dialog>', '<header><p>Text</header>', '<div class="ad-hoc">Text</div>', '<ul><li><a href="x">Text</a></ul>'])
def test_html_articles_keep_what_only_sounds_like_a_part(inside):
    assert sitetree.page_text(f"<body><article>{inside}</article></body>", 0) == "Text"
    assert sitetree.page_text('<body><div class="ad-hoc"><p>Text</div></body>', 0) == "Text"


@pytest.mark.parametrize("part", ['<div class="ad">x</div>', '<section class="comments"><p>x</section>', "<nav>x</nav>", "<aside>x</aside>", '<div role="navigation">x</div>', '<form><p>x</form>', "<footer>x</footer>", '<ul class="share-buttons"><li>x</ul>'])
def test_html_articles_lose_clear_parts(part):
    assert sitetree.page_text(f"<body><article><p>Text</p>{part}</article></body>", 0) == "Text"


@pytest.mark.parametrize("n", [3, 4, 9, 12])
def test_html_hosts_of_a_few_pages(spark, n):
    """A notice of every page and a menu that differs from page to page go on small hosts as on large ones."""
    page = '<body><div class="x1"><p>Welcome to our site</div><div class="x2"><a href="/a">Menu {i}</a> <a href="/b">Other {i}</a></div><div class="x3"><p>Own text of page {i} with <a href="c">a link</a> in it<p>and more {i}</div></body>'
    rows = [(i, "http://few.example/", page.format(i=i)) for i in range(n)] + [(100, "http://one.example/", page.format(i=100))]
    got = {r["page_id"]: r["text"] for r in sitetree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Own text of page {i} with a link in it\nand more {i}" for i in range(n))
    assert got[100] == "Welcome to our site\nOwn text of page 100 with a link in it\nand more 100"


@pytest.mark.parametrize("page", ["<a " * 350_000, '<p x="' * 170_000, "<div>x" * 170_000, "<b>" * 330_000 + "<hr>" * 10, "<!-- " * 200_000, "</div>" * 160_000, "<a>" * 300_000 + "</b>" * 10_000, "x < y " * 170_000, "&amp;" * 200_000, "<td><li>x" * 100_000, "<script>" * 120_000, '<p class="' * 100_000 + ">"])
def test_html_time_grows_with_the_length_of_a_page(page):
    import time

    start = time.process_time()
    sitetree.page_text(page, 0)
    assert time.process_time() - start < 5


@pytest.mark.parametrize("n", [5, 20, 40])
@pytest.mark.parametrize("outer", ["<article>{}</article>", '<div class="content">{}</div>'])
def test_html_labels_stay_with_what_they_introduce(spark, n, outer):
    """Headings, terms and headers of tables that all pages have, and references that are links, are text of the page; what all pages have beside it isn't."""
    page = (
        '<html><head><title>T</title><body><div class="x1"><p>Welcome to our site</div>' + outer.format("<h1><a href='/{i}'>Title {i}</a></h1><h2>Introduction</h2><p>Page {i} begins with words of its own<h2>Results</h2><dl><dt>Author<dd>Person {i}<dt>Rating<dd>good</dl>"
        "<table><caption>Values</caption><thead><tr><th>Name<th>Value</thead><tr><td>size {i}<td>{i}</table><div class='sec'><h2>Conclusion</h2><p>And page {i} ends so</div><ul><li><a href='r'>Writer {i}, a study of things, volume {i}</a><li><a href='s'>Other writer {i}, on the same things</a></ul>")
    )
    want = "Title {i}\nIntroduction\nPage {i} begins with words of its own\nResults\nAuthor\nPerson {i}\nRating\ngood\nValues\nName\nValue\nsize {i}\n{i}\nConclusion\nAnd page {i} ends so\nWriter {i}, a study of things, volume {i}\nOther writer {i}, on the same things"
    rows = [(i, "http://labels.example/", page.format(i=i)) for i in range(n)]
    got = {r["page_id"]: r["text"] for r in sitetree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: want.format(i=i) for i in range(n)}


@pytest.mark.parametrize(("page", "text"), [
    ("<html><head><title>T</title><body><p>Hello world", "Hello world"), ("<head><meta charset=utf-8><p>Hello world", "Hello world"), ("<head><title>t</title>Hello <b>world</b>", "Hello world"), ("<html><head><style>x</style><script>y</script></head><body>a", "a"),
    ("<p>a&#" + "9" * 5000 + ";b", "a\ufffdb"), ("<p>&#" + "0" * 5000 + "65;b &#x" + "f" * 5000 + ";", "Ab \ufffd"), ("<p>&#000000065 &#99999999;", "A \ufffd"), ("a<!-->b<!--->c<!-- x --!>d<!-- y -->e<!-- z", "abcde"),
    ('<article><p>Text</p><div id="comments"><p>nice</div></article>', "Text"), ('<article><p>Text</p><ol class="x user-comments"><li>nice</ol></article>', "Text"), ('<article><p>Text</p><section id="comments"><h2>Comments</h2><p>on a method</section></article>', "Text\nComments\non a method"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><p>e<p>f<div>g", "a\nb\nc\nd\ne\nf\ng"),
])
def test_html_odd_markup(page, text):
    assert sitetree.page_text(page, 0) == text


def test_html_importance_is_the_entropy(spark):
    pages = spark.createDataFrame([(i, "http://h.example/", f"<div class=a>same</div><div class=b>own {i}</div>") for i in range(16)], "page_id long, url string, html string")
    values = sorted({round(r["importance"], 6) for r in sitetree.importance(pages).collect() if r["pages"] == 16})
    assert values[0] == 0.0 and values[-1] == pytest.approx(0.9)


# ---- 4 toxicity ---------------------------------------------------------------------------------

def test_toxicity_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    learn = labels.where("doc_id % 4 <> 0")
    got = toxicity.classify(docs, learn).join(labels.where("doc_id % 4 = 0"), "doc_id").collect()
    toxic = [r for r in got if r["toxic"] == 1]
    clean = [r for r in got if r["toxic"] == 0]
    assert sum(r["toxic_pred"] for r in toxic) / len(toxic) > 0.8
    assert sum(r["toxic_pred"] for r in clean) / len(clean) < 0.02


def test_toxicity_chain_passes_earlier_probabilities_on():
    chain = toxicity.Chain(np.array([], dtype=np.uint64), [toxicity.Link("a", 2.0, np.zeros(0), np.zeros(0)), toxicity.Link("b", 0.0, np.zeros(0), np.array([1.0]))])
    p = toxicity.score_texts(chain, pa.array(["x", None, ""]))
    assert np.allclose(p[:, 0], toxicity.sigmoid(np.array(2.0))) and np.allclose(p[:, 1], p[:, 0])


def plain_logistic(x, y, penalty):
    """The same by Newton steps on a dense matrix whose first column is 1."""
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        w = w + np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + np.diag(penalty), x.T @ (y - p) - penalty * w)
    return w


def plain_chain(rows, scored, folds=5):
    """The classifier chain of (doc_id, text, labels), one text at a time: the probabilities of the texts to score."""
    rows, bags = sorted(rows), [set(found_words(t)) for _, t, _ in sorted(rows)]
    words = sorted(w for w, n in Counter(w for b in bags for w in b).items() if n > 1)
    x = np.array([[1.0, *(float(w in b) for w in words)] for b in bags])
    new = np.array([[1.0, *(float(w in set(found_words(t))) for w in words)] for t in scored])
    fold = np.array([(i * 2654435761 >> 7) % folds for i, _, _ in rows])
    logit = lambda p: np.log(np.clip(p, 1e-4, 1 - 1e-4) / (1 - np.clip(p, 1e-4, 1 - 1e-4)))

    def fitted(m, y):
        if y.min() == y.max():
            return np.concatenate([[logit(y.mean())], np.zeros(m.shape[1] - 1)])
        z = np.array([(y[m[:, k] > 0].sum() - (m[:, k] > 0).sum() * y.mean()) / np.sqrt((m[:, k] > 0).sum() * y.mean() + 1) for k in range(1, 1 + len(words))])
        return plain_logistic(m, y, np.concatenate([[1e-6], 0.05 * (1 + (4 / np.maximum(abs(z), 0.01)) ** 4), np.full(m.shape[1] - 1 - len(words), 0.05)]))

    out = []
    for k in range(len(rows[0][2])):
        y, oof = np.array([r[2][k] for r in rows], dtype=float), np.zeros(len(rows))
        for f in range(folds):
            oof[fold == f] = x[fold == f] @ fitted(x[fold != f], y[fold != f])
        p = 1 / (1 + np.exp(-new @ fitted(x, y)))
        out.append(p)
        x, new = np.column_stack([x, logit(1 / (1 + np.exp(-oof)))]), np.column_stack([new, logit(p)])
    return np.array(out).T


def test_toxicity_equals_a_plain_chain(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "CLOSE", 1e-13)
    monkeypatch.setattr(toxicity, "ROUNDS", 2000)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(25)] + ["bad", "vile", "poor"]
    rows = []
    for i in range(90):
        own = set(rng.choice(words, 8))
        low, toxic = "poor" in own or rng.random() < 0.1, "bad" in own or ("vile" in own and "poor" in own) or rng.random() < 0.05
        rows.append((i, " ".join([*sorted(own), f"only{i}"]), [float(low), float(toxic)]))
    docs = spark.createDataFrame([r[:2] for r in rows], HARD_SCHEMA)
    labels = spark.createDataFrame([(i, int(1 - y[0]), int(y[1])) for i, _, y in rows], "doc_id long, quality int, toxic int")
    scored = {r["doc_id"]: (r["p_low_quality"], r["p_toxic"]) for r in toxicity.classify(docs, labels).collect()}
    want = plain_chain(rows, [t for _, t, _ in rows])
    assert np.allclose([scored[i] for i, _, _ in rows], want, atol=2e-3)


def test_toxicity_ties_and_repeated_labels(spark):
    docs = spark.createDataFrame([(i, f"{'bad' if i % 2 else 'good'} text {i // 4}") for i in range(40)] + [(100, "bad text"), (100, "bad text")], HARD_SCHEMA)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(3, 1, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == 42 and len({r["p_toxic"] for r in got if r["text"] == "bad text"}) == 1
    assert all(r["toxic_pred"] == (r["text"][:3] == "bad") for r in got)


def test_toxicity_hard_cases(spark, hard, empty):
    labels = spark.createDataFrame([(1, None, 1), (3, 1, 0), (4, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(hard, labels)
    assert got.count() == len(HARD) and got.columns.count("p_toxic") == 1
    assert all(0 <= r["p_toxic"] <= 1 for r in got.collect())
    assert toxicity.classify(empty, labels.limit(0)).count() == 0


# ---- 5 decontamination --------------------------------------------------------------------------

def brute_contamination(docs, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        w = found_words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows[tuple(w[i : i + width])].add("" if item is None else str(item))
    sizes = {len(x) for x in windows}
    for doc_id, text in docs:
        w, hit, held = found_words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (x := tuple(w[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    held |= windows[x]
        yield (doc_id, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit))


@pytest.mark.parametrize("block_words", [200, 1_000_000])
def test_decontamination_equals_brute_force(spark, docs, hard, block_words, monkeypatch):
    if block_words == 200:
        monkeypatch.setattr(decontam.build_index, "__defaults__", (decontam.WIDTH, decontam.BLOCK_WORDS, 7))  # pieces shorter than a window
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").limit(15).collect()] + [(500, None), (501, ""), (502, "now again"), (503, "two"), (503, "same words here"), (None, "one two three"), (504, "w1x w2x w3x w4x w5x w6x w7x w8x w9x w10x w11x")]
    table = docs.select("doc_id", "text").union(hard.select("doc_id", "text"))
    got = decontam.find_contamination(table, spark.createDataFrame(items, "item_id long, text string"), block_words=block_words).drop("text").collect()
    want = list(brute_contamination([tuple(r) for r in table.collect()], items))
    assert Counter(map(tuple, got)) == Counter(want)


def test_decontamination_reads_each_of_many_blocks_once(spark, docs, monkeypatch):
    texts = [f"q{i}a q{i}b q{i}c q{i}d q{i}e q{i}f q{i}g q{i}h q{i}i q{i}j" for i in range(400)]
    table = spark.createDataFrame([(i, f"before {t} after") for i, t in enumerate(texts)] + [(400, None), (401, "")], "doc_id long, text string")
    uris = decontam.build_index(table, spark.createDataFrame(list(enumerate(texts)), "item_id long, text string"), block_words=150)
    assert len(uris) >= 20
    reads = Counter()
    monkeypatch.setattr(decontam, "_read", lambda uri, read=decontam._read: (reads.update([uri]), read(uri))[1])
    decontam.load_block.cache_clear()
    batches = table.toArrow().to_batches(max_chunksize=40)
    assert len(batches) > 5
    rows = [r for b in decontam.find_windows(iter(batches), uris, 1, False) for r in b.to_pylist()]
    assert set(reads.values()) == {1} and len(reads) == len(uris)
    assert [r["n_hit"] for r in rows] == [10] * 400 + [0, 0] and [r["n_items"] for r in rows] == [1] * 400 + [0, 0]
    windows = [u.replace("index-", "windows-") for u in uris]
    reads.clear()
    decontam.load_sieves.cache_clear()
    counted = [r for b in decontam.count_shingles((b.select(["text"]) for b in batches), windows) for r in b.to_pylist()]
    assert set(reads.values()) == {1} and sum(r["n"] for r in counted) == 400 * 8


def test_decontamination_empty_tables_and_clashes(spark, hard, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontam.find_contamination(hard, none, spans=True)
    assert got.where("contaminated").count() == 0 and got.count() == len(HARD) and got.columns.count("n_hit") == 1
    assert decontam.find_contamination(empty, spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
    spans = decontam.find_contamination(hard, spark.createDataFrame([(1, "words here")], "item_id long, text string"), spans=True).where("doc_id = 7").first()
    assert [(s["start"], s["end"]) for s in spans["hit_spans"]] == [(1, 3)]


# ---- 6 nearest neighbours -----------------------------------------------------------------------

def brute_nearest(rows, k):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        yield int(ids[i]), [int(ids[j]) for j in order], [float(s[j]) for j in order]


def test_nearest_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = defaultdict(list)
    for r in annlsh.search(table, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    rows = [(r["vec_id"], [float(np.float32(x)) for x in r["embedding"]]) for r in table.collect()]
    vectors, hits, n = dict(rows), 0, 0
    for q, ids, _ in brute_nearest(rows, 20):
        assert len(got[q]) == 20 and all(s == pytest.approx(float(np.dot(vectors[q], vectors[v])), abs=1e-12) for v, s in got[q])
        hits += len({v for v, _ in got[q]} & set(ids))
        n += 20
    assert hits / n >= 0.9


def test_nearest_copies_ties_and_bad_vectors(spark):
    rows = [(i, [1.0, 0.0, 0.0]) for i in range(60)] + [(100 + i, [0.0, 2.0, float(i)]) for i in range(5)]
    bad = [(200, None), (220, []), (240, [0.0, 0.0, 0.0]), (260, [1.0, None, 0.0]), (280, [float("nan"), 1.0, 0.0]), (300, [float("inf"), 1.0, 0.0]), (320, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    table = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("rank", F.lit("x"))
    got = defaultdict(list)
    for r in annlsh.search(table, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    want = {q: ids for q, ids, _ in brute_nearest(rows, 20)}
    assert got.keys() == want.keys()
    assert {q: v for q, v in got.items() if q < 100} == {q: v for q, v in want.items() if q < 100}
    assert all(len(got[q]) == 20 for q in want)
    assert annlsh.search(table.limit(0), F.col("id") % 20 == 0).count() == 0
    alone = annlsh.search(spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>"), F.col("id") % 20 == 0)
    assert alone.count() == 0


@pytest.mark.parametrize("n", [2, 12, 21, 45])
def test_nearest_finds_every_candidate_of_small_tables(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(n)]
    rows[n // 2] = (n // 2, rows[0][1])  # a copy of a query
    got = defaultdict(list)
    for r in annlsh.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"]))
    for q, ids, _ in brute_nearest(rows, 20):
        assert [k for k, _ in got[q]] == list(range(1, min(20, n - 1) + 1))
        if n <= 21:
            assert [v for _, v in got[q]] == ids


def test_nearest_blocks_of_queries_and_the_measured_recall(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 4
    rows = [(i, [float(np.float32(x)) for x in centres[i % 12] + rng.normal(size=16)]) for i in range(1200)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = Counter(map(tuple, annlsh.search(table, F.col("id") % 2 == 0).collect()))
    monkeypatch.setattr(annlsh, "ASKING", 7)
    monkeypatch.setattr(annlsh, "GROUP", 200)
    assert Counter(map(tuple, annlsh.search(table, F.col("id") % 2 == 0).collect())) == whole  # 30 times the queries, in blocks
    data = annlsh.entries(table).cache()
    index = annlsh.fit(data, data.where("id % 20 = 0"))
    assert index.recall >= 0.9 and index.projections.shape[1] >= 1


# ---- 7 licences ---------------------------------------------------------------------------------

def brute_licences(text, templates=None):
    def words(t):
        return [licences.SPELLINGS.get(w, w) for w in found_words(t)]

    def pairs(t):
        w = words(t)
        return Counter(zip(w, w[1:]))

    templates = templates or [(n, pairs(t), {w for w in words(t) if re.search("[0-9]", w)}) for n, t in licences.TEMPLATES]
    units = [text, *text.split("\n\n"), *text.split("\n"), *re.split(r"[.!?;][ \t\r\n]|\n", text), *re.split(r"[.!?;][ \t\r\n]|\n\n", text)]
    found = {}
    for u in units:
        p, held = pairs(u), set(words(u))
        best = min(((-2 * sum((p & t).values()) / (sum(p.values()) + sum(t.values())), n) for n, t, versions in templates if not p.keys().isdisjoint(t) and versions <= held), default=(0, None))
        if -best[0] >= licences.LEAST:
            found[best[1]] = max(found.get(best[1], 0), -best[0])
    return found


@pytest.mark.parametrize("text, licence", [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("Apache Licence, Version 2.0", "Apache-2.0"), ("This file is licensed under the MIT license, see LICENSE.", "MIT"),
    (" * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.", "GPL-3.0"),
    (" * This program is free software; you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation; either version 2 of the License, or\n * (at your option) any later version.\n *\n * more", "GPL-2.0"),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:", "BSD"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", "ISC"),
    ("Some words of a paragraph. Licensed under the Apache License,\nVersion 2.0. And more words after it.", "Apache-2.0"), ("licensed under the GNU General Public License, version 7", None), ("nothing here", None)])
def test_licences_of_notices_headers_and_texts(text, licence):
    found = licences.scan_texts(pa.array([text, None, text]), licences.Templates(licences.TEMPLATES))
    assert set(found[0]) == ({licence} if licence else set()) and found[0] == found[2] == brute_licences(text) and not found[1]


def test_licences_of_whole_texts():
    body = dict(licences.TEMPLATES)  # the last text of each
    texts = ["Copyright (c) 2001 Some Body\n\n" + body["MIT"], "// " + body["BSD-3-Clause"].replace(", ", ",\n// "), body["BSD-2-Clause"], "Copyright 2001, 2002 Some Body <a@b.example>\n" + body["ISC"]]
    got = licences.scan_texts(pa.array(texts), licences.Templates(licences.TEMPLATES))
    assert [max(f, key=f.get) for f in got] == ["MIT", "BSD-3-Clause", "BSD-2-Clause", "ISC"]


def test_licences_ties_and_many_templates_of_a_pair(monkeypatch):
    monkeypatch.setattr(licences, "AT_ONCE", 3)
    templates = licences.Templates([("B", "one two three"), ("A", "one two three"), ("C", "one two four"), *[(f"D{i}", f"one two x{i} y") for i in range(20)]])
    assert licences.scan_texts(pa.array(["one two three", "one two four", "one two x7 y\none two three"]), templates) == [{"A": 1.0}, {"C": 1.0}, {"D7": 1.0, "A": 1.0}]


def test_licences_equal_brute_force(spark, docs, hard):
    notices = [(1000 + i, f"Some words before.\n{t}\n\nand after; {t} more words here. Released under the MIT license") for i, (_, t) in enumerate(licences.TEMPLATES)]
    table = docs.select("doc_id", "text").where("length(text) < 3000").union(hard.select("doc_id", "text")).union(spark.createDataFrame(notices[::9], HARD_SCHEMA))
    got = licences.scan(table).collect()
    texts = Counter()
    words = lambda t: [licences.SPELLINGS.get(w, w) for w in found_words(t)]
    templates = [(n, Counter(zip(words(t), words(t)[1:])), {w for w in words(t) if re.search("[0-9]", w)}) for n, t in licences.TEMPLATES]
    for r in table.collect():
        texts[(r["doc_id"], str(sorted((n, round(d, 9)) for n, d in brute_licences(r["text"] or "", templates).items())))] += 1
    assert Counter((r["doc_id"], str(sorted((n, round(d, 9)) for n, d in r["licences"].items()))) for r in got) == texts
    assert sum(r["n_licences"] for r in got) >= len(notices[::9])
    assert licences.scan(table.limit(0)).count() == 0


# ---- 8 near duplicates --------------------------------------------------------------------------

def brute_classes(rows, least=0.8):
    bags = []
    for _, text in rows:
        w = found_words(text)
        bags.append(Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and bags[i] and bags[j]:
                common = sum((bags[i] & bags[j]).values())
                if common / (sum(bags[i].values()) + sum(bags[j].values()) - common) >= least:
                    parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(i)
    return Counter((rows[i][0], min((rows[j][0] for j in g if rows[j][0] is not None), default=None), len(g)) for g in groups.values() for i in g)


def test_near_duplicates_equal_brute_force(spark, docs, hard):
    base = [f"v{i}" for i in range(60)]
    chains = [(2000 + k, " ".join([*base[:k], *(f"c{k}{j}" for j in range(3)), *base[k:]])) for k in range(0, 60, 4)]  # alike to some, not to all
    table = docs.select("doc_id", "text").union(hard.select("doc_id", "text")).union(spark.createDataFrame(chains, HARD_SCHEMA))
    rows = [tuple(r) for r in table.collect()]
    got = minhash.classes(table).select("doc_id", "class_id", "class_size").collect()
    assert Counter(map(tuple, got)) == brute_classes(rows)
    kept = [r["doc_id"] for r in minhash.representatives(table).collect()]
    least: dict = {}  # of each class; two classes may share a doc_id
    for r in minhash.classes(table).where("doc_id IS NOT NULL").collect():
        least[bytes(r["label"])] = min(r["doc_id"], least.get(bytes(r["label"]), r["doc_id"]))
    assert sorted(x for x in kept if x is not None) == sorted(least.values()) and kept.count(None) == 1
    assert minhash.classes(table.limit(0)).count() == 0


def test_representatives_of_clashing_columns_and_shared_ids(spark):
    long = " ".join(f"a{i}" for i in range(30))
    rows = [(1, long), (1, "quite another text than the first one is"), (2, long + " more"), (3, "quite another text than the first one is"), (4, ""), (4, "!!"), (4, ""), (None, "")]
    frame = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, own_id int").withColumn("Own_Hash", F.lit("x")).withColumn("label", F.lit("y")).withColumn("class_id", F.lit(7))
    got = minhash.representatives(frame)
    assert got.columns == frame.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert Counter(kept) == Counter([(1, long), (1, rows[1][1]), (4, ""), (4, "!!"), (None, "")])


def test_signatures_estimate_the_weighted_similarity():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(300)]
    for n, edits, repeats in ((80, 6, 0), (200, 15, 40), (12, 1, 0), (5, 0, 9)):
        a = list(rng.choice(vocabulary, n))
        b = list(a)
        for i in rng.integers(0, n, edits):
            b[i] = "zz"
        a, b = a + a[:30] * (repeats // 10), b + b[:30] * (repeats // 20)
        w = words.split(pa.array([" ".join(a), " ".join(b)]))
        runs, at = minhash.text_shingles(w)
        signatures = minhash.bag_signatures(runs, at, 2, size=4000)
        true = minhash.similarities(pa.array([" ".join(a)]), pa.array([" ".join(b)]))[0]
        assert abs((signatures[0] == signatures[1]).mean() - true) < 0.04
        x, y = (Counter(tuple(t[k : k + 5]) for k in range(len(t) - 4)) for t in (a, b))
        assert true == pytest.approx(sum((x & y).values()) / sum((x | y).values()))


def test_likely_pairs_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    members = [(bytes([i]), bytes([i]), bytes([i // 2] * minhash.SKETCH)) for i in range(12)]
    rows = spark.createDataFrame([(b, 7, n, lab, s, [9 if n[0] < 6 else n[0], 7], bytes([0]), 12, 11) for n, lab, s in members for b in (1, 0) if b or n[0] < 6], "band int, key long, node binary, label binary, sketch binary, bands array<long>, largest binary, members long, outside long")
    got = {(bytes(r["a"])[0], bytes(r["b"])[0]) for r in minhash.likely_pairs(rows).collect()}
    assert got == {(i, i + 1) for i in range(0, 12, 2)}


# ---- 9 WARC -------------------------------------------------------------------------------------

def test_warc_derivatives_link_to_their_source(spark, tmp_path):
    rows = [(1, "http://h.example/a?x=1", '<html><head><title>A &amp; b</title></head><body><p>one<p>two <a href="/c">c</a><a href=d>d</a></body></html>'), (2, None, None), (None, "x", ""), (1, "http://h.example/a?x=1", "<p>again")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("metadata", F.lit(0))
    made = warc.responses(pages)
    sources = {warc.parse(bytes(r["record"]))[0]["warc-record-id"]: bytes(r["record"]) for r in made.collect()}
    assert len(sources) == 4
    derived = warc.derivatives(made).cache()
    for r in derived.collect():
        source, block = warc.parse(sources[r["source_id"]])
        assert source["warc-payload-digest"] == r["source_digest"] == warc.digest(block.partition(b"\r\n\r\n")[2])
        ids = {}
        for kind in ("metadata", "conversion"):
            headers, body = warc.parse(bytes(r[kind]))
            ids[kind] = headers["warc-record-id"]
            assert headers["warc-type"] == kind and headers["warc-refers-to"] == r["source_id"] and headers["warc-date"] == source["warc-date"]
            assert headers["warc-target-uri"] == headers["warc-refers-to-target-uri"] == source["warc-target-uri"] and headers["source-warc-payload-digest"] == r["source_digest"]
            assert headers["warc-block-digest"] == warc.digest(body) == r[f"{kind}_digest"]
        assert warc.parse(bytes(r["metadata"]))[0]["warc-concurrent-to"] == ids["conversion"]
    first = derived.where("page_id = 1 AND n_outlinks = 2").first()
    assert warc.parse(bytes(first["conversion"]))[1].decode() == "one\ntwo cd"
    assert b"outlink: http://h.example/c\r\noutlink: http://h.example/d\r\n" in bytes(first["metadata"]) and b"title: A & b\r\n" in bytes(first["metadata"])
    files = warc.write_warcs(derived, f"file://{tmp_path}/w").collect()
    import gzip
    from pathlib import Path

    raw = b"".join(gzip.decompress(Path(f["file"][7:]).read_bytes()) for f in files)
    assert raw.count(b"WARC/1.1\r\n") == sum(f["records"] for f in files) == 8
    wrong = spark.createDataFrame([(bytearray(b"junk"),), (None,), (bytearray(bytes(first["conversion"])),)], "record binary")
    assert all(r["error"] for r in warc.derivatives(wrong).collect())
    assert warc.derivatives(made.limit(0)).count() == 0


def warc_of(http, payload, kind="response", uri="http://h.example/"):
    block = b"HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in http).encode() + b"\r\n" + payload
    return b"WARC/1.1\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:x>\r\nWARC-Target-URI: %s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind.encode(), uri.encode(), len(block), block)


def read_warc(raw):
    """An independent reader: the records of a file as (headers, block), by email's parser."""
    import email.parser
    import io

    f, out = io.BytesIO(raw), []
    while line := f.readline():
        assert line == b"WARC/1.1\r\n"
        head = b""
        while (line := f.readline()) != b"\r\n":
            head += line
        headers = email.parser.BytesParser().parsebytes(head + b"\r\n", headersonly=True)
        out.append((headers, f.read(int(headers["Content-Length"]))))
        assert f.read(4) == b"\r\n\r\n"
    return out


def test_warc_bodies_are_unpacked_and_others_named(spark):
    import gzip

    page = b"<title>T</title><p>one <a href='/x'>two</a><script>'<a href=/no>'</script>"
    chunks = b"".join(b"%x;ext=1\r\n%s\r\n" % (len(c), c) for c in (page[:7], page[7:30], page[30:])) + b"0\r\n\r\n"
    zipped = gzip.compress(page)
    html_type = ("Content-Type", "text/html")
    good = [warc_of([html_type], page), warc_of([html_type, ("Transfer-Encoding", "chunked")], chunks), warc_of([html_type, ("Content-Encoding", "gzip")], zipped), warc_of([html_type, ("content-encoding", "deflate")], zlib.compress(page)), warc_of([], page), warc_of([html_type, ("Content-Encoding", "gzip"), ("Transfer-Encoding", "chunked")], b"%x\r\n%s\r\n0\r\n\r\n" % (len(zipped), zipped))]
    bad = [warc_of([("Content-Type", "application/pdf")], b"%PDF-1.4"), warc_of([], b"%PDF-1.4 x"), warc_of([("Content-Type", "image/png")], b"\x89PNG"), warc_of([html_type, ("Content-Encoding", "gzip")], zipped[:-9]), warc_of([html_type, ("Transfer-Encoding", "chunked")], chunks[:-12]), warc_of([html_type, ("Content-Encoding", "br")], page), warc_of([html_type], page, "request"), b"", None]
    plain = warc_of([("Content-Type", "text/plain; charset=latin-1")], "é <b>".encode("latin-1"))
    frame = spark.createDataFrame([(k, None if r is None else bytearray(r)) for k, r in enumerate([*good, *bad, plain])], "k int, record binary")
    got = {r["k"]: r for r in warc.derivatives(frame).collect()}
    for k in range(len(good)):
        (meta, fields), (conv, text) = read_warc(bytes(got[k]["metadata"]) + bytes(got[k]["conversion"]))
        assert text == b"one two" and b"title: T\r\n" in fields and fields.count(b"outlink:") == 1 and got[k]["error"] is None
        assert meta["WARC-Refers-To"] == conv["WARC-Refers-To"] == "<urn:x>" and meta["WARC-Concurrent-To"] == conv["WARC-Record-ID"]
        assert conv["WARC-Block-Digest"] == "sha1:" + __import__("base64").b32encode(hashlib.sha1(text).digest()).decode()
    for k in range(len(good), len(good) + len(bad)):
        assert got[k]["error"] and got[k]["metadata"] is None and got[k]["conversion"] is None
    assert read_warc(bytes(got[len(good) + len(bad)]["conversion"]))[0][1].decode() == "é <b>"


def test_warc_charsets_texts_and_wrong_packings(spark):
    import gzip

    said = "<p>caf\u00e9 \u201cna\u00efve\u201d</p>"
    meta = b'<html><head><meta http-equiv="Content-Type" content="text/html; charset=windows-1252"></head>'
    kind = lambda x: ("Content-Type", x)
    pages = [
        warc_of([kind("text/html; Charset=ISO-8859-1")], said.encode("cp1252")), warc_of([kind("text/html")], meta + said.encode("cp1252")), warc_of([kind("TEXT/HTML")], b"<meta charset='latin1'>" + said.encode("cp1252")),
        warc_of([kind("text/html; charset=koi8-r")], b"\xff\xfe" + said.encode("utf-16-le")), warc_of([kind("text/html; charset=no-such")], said.encode()), warc_of([kind("text/html; charset=hex")], said.encode()),
        warc_of([kind("text/html"), ("Content-Encoding", "gzip")], said.encode()), warc_of([kind("text/html"), ("Transfer-Encoding", "chunked")], said.encode()),
        warc_of([kind("text/html"), ("Content-Encoding", "gzip")], gzip.compress(said[:9].encode()) + gzip.compress(said[9:].encode()) + b"junk"),
    ]
    texts = {"text/csv": "a,b", "text/markdown": "# a", "application/xml": "<a>b</a>", "application/json; charset=utf-8": '{"a": 1}', "application/ld+json": "{}", "image/svg+xml": None, "application/zip": None}
    records = pages + [warc_of([kind(k)], (v or "x").encode()) for k, v in texts.items()]
    got = {r["k"]: r for r in warc.derivatives(spark.createDataFrame(list(enumerate(records)), "k int, record binary")).collect()}
    assert [read_warc(bytes(got[k]["conversion"]))[0][1].decode() for k in range(len(pages))] == ["caf\u00e9 \u201cna\u00efve\u201d"] * len(pages)
    for k, v in enumerate(texts.values(), len(pages)):
        assert (read_warc(bytes(got[k]["conversion"]))[0][1].decode() if v else got[k]["conversion"]) == v and bool(got[k]["error"]) == (v is None)


def test_warc_unpacks_no_more_than_its_bound():
    import gzip

    bomb = gzip.compress(b"a" * (1 << 20))
    assert len(warc.unpacked(bomb, {"content-encoding": "gzip"}, 1 << 20)) == 1 << 20
    for packed, name in ((bomb, "gzip"), (bomb, "x-gzip"), (zlib.compress(b"a" * (1 << 20)), "deflate"), (gzip.compress(b"a" * 9) + bomb, "gzip")):
        with pytest.raises(ValueError, match="more than"):
            warc.unpacked(packed, {"content-encoding": name}, (1 << 20) - 1)


def test_warc_of_very_long_pages_and_repeated_rows(spark):
    long = "<p>" + LONG * 6 + "<a " * 200_000
    rows = [(1, "u", long), (1, "u", long), (2, "u", "<p>x")]
    got = warc.derivatives(warc.responses(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    assert len({bytes(r["conversion"]) for r in got if r["page_id"] == 1}) == 1 and sorted(r["n_chars"] for r in got)[0] == 1 and len({r["source_id"] for r in got}) == 2


# ---- 10 pieces ----------------------------------------------------------------------------------

def test_pieces_equal_the_library(docs, hard):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    table = docs.select("doc_id", "text").union(hard.select("doc_id", "text"))
    want = Counter()
    for r in table.collect():
        ids = library.encode(r["text"] or "", add_eos=True)
        want[(r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())] += 1
    encoded = piece.encode_documents(table, path, keep_ids=True, keep_text=True).cache()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in encoded.collect()) == want
    assert Counter(r["text"] for r in piece.decode_documents(encoded, path).collect()) == Counter(r["decoded"] for r in encoded.collect())
    assert piece.encode_documents(table.limit(0), path).count() == 0


def test_agenda_alone_equals_the_library():
    v = piece.MergeVocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    cuts = ["▁hello", "▁" + "ab" * 60, "▁▁▁x", "▁naïveté", "▁日本語", "▁a\x00b", "▁" + "é" * 20, "▁unbelievable", "▁" + "the" * 15]
    own = [v.merge(c) for c in cuts]
    assert own == v.merge_all(cuts) == v.library.encode([c[1:] for c in cuts])


def test_pieces_of_texts_that_hold_every_mark_for_cuts(spark, monkeypatch):
    monkeypatch.setattr(piece, "GAPS", (0xE000, 0xE002))
    encoder = piece.PieceEncoder(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["a  b  c ", "▁▁x y▁z ", "", " ", "plain words"]
    flat, begins = encoder.encode(pa.array(texts))
    assert [flat[begins[k] : begins[k + 1]].tolist() for k in range(len(texts))] == encoder.vocabulary.library.encode(texts)

"""Extraction, language, quality and decontamination."""

import math
import random

import numpy as np
import pytest

from activity_lake.llm import decontamination, html_text, language, quality
from tests.llm import brute
from tests.llm.data import documents
from tests.oracle import SF_DIR


def test_articles_of_the_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    wanted = {r["page_id"]: brute.article(r["html"]) for r in pages.collect()}
    made = html_text.op2_main_text(pages).collect()
    assert {r["page_id"]: r["text"] for r in made} == wanted
    assert all(r["n_chars"] == len(r["text"]) for r in made)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<1 a < b", "<1 a < b"),
    ("<p>a &lt;b&gt; &amp;amp; &eacute;&#x41;</p>", "a <b> &amp; éA"), ("<p>a \n\t b</p>\n<p></p><p>c</p>", "a b\nc"),
    ("<script>if (a</p>b) x</script><style>p{}</style><p>y</p>", "y"), ("<p>a<!-- <p>no</p> -->b</p>", "ab"),
    ("<body><nav><a href=/>menu</a></nav><article><h1>T</h1><p>one two three</p></article><aside>side</aside><footer>f</footer>",
     "T\none two three"),
    ("<div class='cookie-notice'>" + "We use cookies. " * 9 + "</div><div><p>short</p></div>", "short"),
    ("<div><p>text of the article</p><p>more of it</p></div><div id=comments><p>" + "I think so. " * 20 + "</p></div>",
     "text of the article\nmore of it"),
    ("<form><label>name</label><input></form><main><p>body <b>bold</b> end</p></main>", "body bold end"),
    ('<p class="x>open quote</p><p>rest</p>', "open quote\nrest"), ("<p hidden>no</p><p>yes</p>", "yes"),
])
def test_pages(page, text):
    assert html_text.main_text(page) == text


LONG = [f"{word} paragraph " + "of the article, as long as others, " * 8 + "ends." for word in ("first", "second", "third", "fourth", "fifth")]
INNER = "<div>" + "".join(f"<p>{x}</p>" for x in LONG) + "</div>"
LINKS = "<div><a href=1>one two three four</a> <a href=2>five six seven eight</a></div>"


@pytest.mark.parametrize("page, text", [
    (f"<article><h1>A headline of thirty characters</h1>{INNER}</article>", ["A headline of thirty characters", *LONG]),
    (f"{LINKS}<main><h1>Title</h1><p>Lead.</p>{INNER}<ul><li>item</li></ul><blockquote>quote</blockquote><p>End.</p></main><div>(c) us</div>",
     ["Title", "Lead.", *LONG, "item", "quote", "End."]),
    (f"{LINKS}<div><h1>Title</h1><p>Lead.</p>{INNER}<p>End.</p></div><div>(c) us</div>", ["Title", "Lead.", *LONG, "End."]),
    (f"{LINKS}<h1>Title</h1>{INNER}<p>End.</p><div>(c) us</div>", ["Title", *LONG, "End."]),
    (f"<article>{INNER}<section><h2>Short</h2><p>{'x' * 100}</p></section></article>", [*LONG, "Short", "x" * 100]),
    (f"{LINKS}<section><h2>Long</h2>{INNER}</section><section><h2>Short</h2><p>{'x' * 100}</p></section>",
     ["Long", *LONG, "Short", "x" * 100]),
    (f"<main><h1>Title</h1><article>{INNER}</article><article><h2>Other</h2><p>short one</p></article></main>",
     ["Title", *LONG, "Other", "short one"]),
])
def test_whole_articles(page, text):
    assert html_text.main_text(f"<body>{page}</body>").split("\n") == text


@pytest.mark.parametrize("page, text", [
    *((f"<nav>menu</nav><div {names}><h1>Title</h1>{INNER}</div><footer>us</footer>", ["Title", *LONG]) for names in (
        "class='content has-sidebar'", "class=no-sidebar", "class='post ad-free'", "class='page with-comments'",
        "id='search-result-page'", "class='layout--without-nav'", "class='nav-content'", "class='search'")),
    (f"<div id=search-result-page>{INNER}</div><p>Home</p>", [*LONG, "Home"]),
    (f"<div id=search-result-page>text without tags</div>", ["text without tags"]),
    (f"<article><div class='entry-header'><h1>Title</h1></div>{INNER}</article>", ["Title", *LONG]),
    (f"<div><div class='entry-header'><h1>Title</h1></div>{INNER}</div>", ["Title", *LONG]),
    (f"<main><header><h1>Title</h1></header>{INNER}</main>", ["Title", *LONG]),
    (f"<article><h1>Title</h1><p>short text</p></article><div class='site-footer'>{INNER}</div>", ["Title", "short text"]),
    (f"<article><h1>Title</h1><p>short text</p></article><div class='sidebar-content'>{INNER}</div>", ["Title", "short text"]),
    (f"<div><h1>Title</h1><p>short text</p></div><div class='comment-list'>{INNER}</div>", ["Title", "short text"]),
    (f"<article><h1>Title</h1><p>short text</p><div class='comments'>{INNER}</div></article>", ["Title", "short text"]),
])
def test_names_of_wrappers(page, text):
    assert html_text.main_text(f"<body>{page}</body>").split("\n") == text


@pytest.mark.parametrize("around", [
    "<div data-state='not hidden'>{}</div>", "<div title='a hidden gem' data-id=search data-class='sidebar'>{}</div>",
    "<section id='related-work'>{}</section>", "<article><section id=discussion>{}</section></article>", "<div onclick=\"x('class=nav')\">{}</div>",
])
def test_words_in_other_attributes_and_anchors(around):
    assert html_text.main_text(f"<body>{around.format('<h1>Title</h1>' + INNER)}</body>").split("\n") == ["Title", *LONG]


@pytest.mark.parametrize("part, text", [
    ("<p title='a hidden gem'>gem</p>", "gem"), ("<p>a <a href='/the/hidden/path'>link</a> in it</p>", "a link in it"),
    ("<p>a <a href='/x?id=search'>link</a> in it</p>", "a link in it"), ("<h2 id=search>Search</h2>", "Search"),
    ("<h2 id=navigation>Navigation</h2>", "Navigation"), ("<p class='ad-hoc'>ad hoc</p>", "ad hoc"), ("<p data-id=search>found</p>", "found"),
    ("<p class=ad>buy</p>", None), ("<div class=paywall>Subscribe to read more</div>", None), ("<div class='you-may-also-like'>Other</div>", None),
    ("<p class=notice>cookies</p>", None), ("<p hidden>no</p>", None),
])
def test_parts_of_an_article(part, text):
    wanted = ["Title", *LONG] + ([text] if text else [])
    assert html_text.main_text(f"<body><article><h1>Title</h1>{INNER}{part}</article></body>").split("\n") == wanted


@pytest.mark.parametrize("comments", [
    f"<article class='comment'>{INNER}</article>", f"<section class='responses'>{INNER}</section>", f"<section id='discussion'>{INNER}</section>",
    f"<ul class='comment-list'><li>{INNER}</li></ul>",
])
def test_reader_comments_go(comments):
    page = f"<body><main><article><h1>Title</h1><p>short text</p></article>{comments}</main></body>"
    assert html_text.main_text(page).split("\n") == ["Title", "short text"]


def test_deep_and_repeated_markup():
    assert html_text.main_text("<div>" * 20_000 + "x") == "x"
    assert html_text.main_text("<p>" * 20_000 + "x") == "x"
    assert html_text.main_text("<" * 50_000) == "<" * 50_000


def test_density_prefers_text_to_links():
    body = html_text.tree("<div><a href=1>one two three four</a><a href=2>five six seven</a></div><div><p>one two three four five</p></div>")
    html_text.measure(body)
    links, text = [part for part in body.parts if isinstance(part, html_text.Node)]
    assert text.density > links.density


def test_extra_columns_stay(spark):
    pages = spark.createDataFrame([(1, None, "u"), (1, None, "u"), (None, "<p>a", None)], "page_id long, html string, text string")
    made = html_text.extract_main_text(pages)
    assert made.columns == pages.columns and sorted(r["text"] for r in made.collect()) == ["", "", "a"]
    assert html_text.op2_main_text(pages.limit(0).withColumn("url", pages["text"])).count() == 0


PIECES = sorted({bytes([b]) for b in range(1, 256)} | {b" a", b" ab", b"ab", b"bc", b"abc", "é".encode(), b" th", b"the"})


def all_ways(raw, chances):
    if not raw:
        return 1.0
    return sum(chances[raw[:i]] * all_ways(raw[i:], chances) for i in range(1, min(8, len(raw)) + 1) if raw[:i] in chances)


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(3)
    logs = np.log(rng.dirichlet(np.ones(len(PIECES)), 2).T)
    scorer = language.Scorer(PIECES, logs)
    sample = ["abc", "a", "thé", "ababcabc", "x" * 24, "😀é"]
    for word, row in zip(sample, scorer.words(sample)):
        for k in range(2):
            chances = dict(zip(PIECES, np.exp(logs[:, k])))
            assert row[k] == pytest.approx(math.log(all_ways(b" " + word.encode(), chances)))


def test_expected_uses():
    total = np.zeros(len(PIECES))
    language.UniformUses(PIECES).add(["ab"], np.array([2.0]), total)
    chance = 1 / len(PIECES)
    ways = [[b" ", b"a", b"b"], [b" a", b"b"], [b" ", b"ab"], [b" ab"]]
    weight = [chance ** len(way) for way in ways]
    for piece in {p for way in ways for p in way}:
        wanted = 2 * sum(w * way.count(piece) for way, w in zip(ways, weight)) / sum(weight)
        assert total[PIECES.index(piece)] == pytest.approx(wanted)


def plain_log(raw, logs):
    """The forward sum over a dictionary of pieces, in logarithms, one place after the other."""
    sums, longest = [0.0] + [-math.inf] * len(raw), max(map(len, logs))
    for end in range(1, len(raw) + 1):
        ways = [sums[start] + logs[raw[start:end]] for start in range(max(0, end - longest), end) if raw[start:end] in logs]
        top = max(ways)
        sums[end] = top + math.log(sum(math.exp(w - top) for w in ways))
    return sums[-1]


WORDS = ["informationen", "natürlich", "также", "हिन्दी", "क्षत्रिय", "ภาษาไทย", "cafe\u0301", "возможность", "ありがとうございます", "z" * 23,
         "wort" * 40, "ありがとうございます" * 9, "हिन्दी" * 30]


def test_whole_vocabulary_and_words_of_any_length():
    pieces = language.read_vocabulary()
    assert len(pieces) >= 50_256 and max(map(len, pieces)) > 8
    rng = np.random.default_rng(5)
    logs = np.log(rng.dirichlet(np.ones(len(pieces)), 2).T)
    total = np.zeros((len(WORDS), 2))
    scorer = language.Scorer(pieces, logs)
    for _ in range(2):  # the second time from what is kept
        scorer.add(WORDS, np.arange(len(WORDS)), total)
    for k in range(2):
        chances = dict(zip(pieces, logs[:, k]))
        assert total[:, k] / 2 == pytest.approx([plain_log(b" " + word.encode(), chances) for word in WORDS])


def test_expected_uses_of_long_pieces_and_words(monkeypatch):
    uses = language.UniformUses(language.read_vocabulary())
    together, alone = np.zeros(uses.trie.size), np.zeros(uses.trie.size)
    words, counts = WORDS[:10], np.arange(1.0, 11.0)
    uses.add(words, counts, together)
    monkeypatch.setattr(language, "LONG_WORD", 0)
    uses.add(words, counts, alone)
    assert together == pytest.approx(alone, rel=1e-9, abs=1e-12)
    lengths = np.array([*map(len, language.read_vocabulary())])
    assert together @ lengths == pytest.approx(sum(n * (1 + len(w.encode())) for n, w in zip(counts, words)))  # every byte is in one piece


def test_words_keep_marks_and_length():
    assert language.words_of("Hindi: हिन्दी, CAFE\u0301! x2y ½ 3") == ["hindi", "हिन्दी", "cafe\u0301", "x", "y"]
    assert language.words_of("a" * 5_000) == ["a" * 5_000] and language.words_of("\u0301 ् 12") == []
    text = "क्षि" * 400_000 + " ab"
    assert list(language.portions(text)) == [text[:-3], " ab"]


def test_very_unlikely_words_have_finite_logs():
    logs = np.full((len(PIECES), 1), -30.0)
    assert np.isfinite(language.Scorer(PIECES, logs).words(["z" * 24, "ab"])).all()


def test_language_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR.rsplit('/', 1)[0]}/sf0.01/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in language.op4_languages(docs).collect() if r["held_out"] and lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held) > 100
    assert all(0 <= r["score"] <= 1 for r in held)


def test_language_of_awkward_texts(spark):
    rows = language.op4_languages(documents(spark)).collect()
    assert len(rows) == documents(spark).count()
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows if r["doc_id"] is not None and r["doc_id"] >= 500}
    assert all(found[i] == ("und", 0.0) for i in (500, 501, 502, 503)) and found[504][0] in ("en", "de")
    none = language.op4_languages(documents(spark).filter("lang is null")).collect()
    assert none and {r["lang_pred"] for r in none} == {"und"}
    assert language.op4_languages(documents(spark).limit(0)).count() == 0


def test_quality_on_held_out_labels(spark):
    folder = f"{SF_DIR.rsplit('/', 1)[0]}/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    judged = quality.assess(docs, quality.train(docs, labels.filter("doc_id % 2 = 0")))
    held = [r for r in judged.select("doc_id", "quality.probability").collect() if r["doc_id"] in known and r["doc_id"] % 2]
    right = [(r["probability"] >= quality.KEEP) == bool(known[r["doc_id"]]) for r in held]
    assert sum(right) >= 0.97 * len(right) > 50


def test_sparse_sites_keep_near_their_parents_rate(spark):
    rows = [(i, "good text", "x", "host", 0) for i in range(60)] + [(100, "!!", "x", "lonely", 0)] + [(200 + i, "!!", "y", "host", 0) for i in range(40)]
    docs = documents(spark, rows, False)
    likes_letters = quality.Classifier(np.zeros(36), np.ones(36), np.array([4.0] + [0.0] * 4 + [-8.0] + [0.0] * 31))  # against bangs
    sites = {(r["source"], r["lang"], r["text"]): r["quality"]["site"] for r in quality.assess(docs, likes_letters).collect()}
    assert sites["host", "x", "good text"] > sites["lonely", "x", "!!"] > sites["host", "y", "!!"]


def test_rates_of_three_levels_are_drawn_level_by_level(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["good text", "!!", "so so!"]), f"l{i % 3}", f"h{i % 5}", i % 2) for i in range(200)]
    docs = documents(spark, rows, False)
    likes_letters = quality.Classifier(np.zeros(36), np.ones(36), np.array([4.0] + [0.0] * 4 + [-8.0] + [0.0] * 31))
    levels = ("source", "lang", docs.columns[4])
    got = {r["doc_id"]: r["quality"] for r in quality.assess(docs, likes_letters, levels=levels).collect()}
    p = {i: 1 / (1 + math.exp(-q["evidence"])) for i, q in got.items()}
    key = {r["doc_id"]: [tuple(str(r[c]) for c in levels[:k]) for k in (1, 2, 3)] for r in docs.collect()}
    base = (sum(p.values()) + 1) / (len(p) + 2)
    sums = {}
    for i, sites in key.items():
        for site in sites:
            good, n = sums.get(site, (0.0, 0))
            sums[site] = good + p[i], n + 1
    strengths = []

    def drawn(site, own=0.0, less=0):
        rate = base
        for k in range(len(site)):
            good, n = sums[site[:k + 1]]
            rate = (good - own + strengths[k] * rate) / (n - less + strengths[k])
        return rate

    for k in (1, 2, 3):
        sites = {site: sums[site] for site in sums if len(site) == k}
        seen = sum(n * (good / n - drawn(site[:-1])) ** 2 for site, (good, n) in sites.items())
        chance = sum(drawn(site[:-1]) * (1 - drawn(site[:-1])) for site in sites)
        most = sum(n * drawn(site[:-1]) * (1 - drawn(site[:-1])) for site, (_, n) in sites.items())
        strengths.append(min(max(1 / max(max(seen - chance, 0) / most, 1e-6) - 1, 1.0), 1e4))
    for i, sites in key.items():
        assert got[i]["site"] == pytest.approx(drawn(sites[2], p[i], 1))


def test_quality_of_awkward_tables(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(3, 1), (4, 0), (4, 1), (None, 1), (5, None), (501, 0), (502, 0)], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    judged = quality.assess(docs, quality.train(docs, labels)).collect()
    assert len(judged) == docs.count() and all(0 <= r["quality"]["probability"] <= 1 for r in judged)
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count()  # nothing learned, nothing lost
    assert quality.op5_quality(docs.limit(0), labels).count() == 0


def test_automaton_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        items = [(i, " ".join(rng.choices("abC", k=rng.randint(0, 16)))) for i in range(rng.randint(0, 5))]
        docs = [(i, " ".join(rng.choices("Abc", k=rng.randint(0, 60)))) for i in range(3)]
        automaton = decontamination.ItemAutomaton([(str(i), t.encode()) for i, t in items])
        for (_, text), wanted in zip(docs, brute.leaks(docs, items)):
            n, spans, found = automaton.scan(text.encode())
            assert (n, sum(b - a for a, b in spans), len(found)) == wanted[1:4]


@pytest.mark.parametrize("group_bytes", [decontamination.GROUP_BYTES, 200])
def test_leaks_of_awkward_tables(spark, group_bytes, monkeypatch):
    monkeypatch.setattr(decontamination, "PIECE", 300)
    docs = documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = [(i, " ".join(rows[i][1].split()[:25])) for i in range(0, 60, 6)] + [(100, "w1 w2"), (101, ""), (102, None), (None, "w3 W4"), (100, "w1 w2")]
    found = decontamination.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"), group_bytes=group_bytes)
    got = [(r["doc_id"], r["leaks"]["n_words"], sum(b - a for a, b in zip(r["leaks"]["starts"], r["leaks"]["ends"])), len(r["leaks"]["items"]))
           for r in found.collect()]
    assert brute.in_order(got) == brute.in_order(r[:4] for r in brute.leaks(rows, items))


def test_decontaminate(spark):
    item = " ".join(f"q{i}" for i in range(12))
    long = " ".join(f"l{i}" for i in range(40))
    plain = " ".join(f"p{i}" for i in range(200))
    rows = [(1, plain, None, None, 0), (2, f"{plain}. {item.upper()}! {plain}", None, None, 0), (3, f"{plain} {long}", None, None, 0),
            (4, item, None, None, 0), (5, None, None, None, 0), (6, "", None, None, 0), (1, plain, None, None, 0)]
    docs = documents(spark, rows)
    made = decontamination.decontaminate(docs, spark.createDataFrame([(1, item), (2, long)], "item_id long, text string"))
    assert made.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in made.collect()), key=str) == sorted(
        [(1, plain), (1, plain), (2, f"{plain}. ! {plain}"), (5, None), (6, "")], key=str)
    assert decontamination.decontaminate(docs.limit(0), spark.createDataFrame([], "item_id long, text string")).count() == 0

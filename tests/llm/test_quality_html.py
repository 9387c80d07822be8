"""Decision lists and page text."""

import math
import re
from collections import Counter
from random import Random
from xml.etree import ElementTree

import duckdb
import numpy as np
import pytest
from cases import edge_docs, edge_rows, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from tastegrid.llm import html_text
from tastegrid.llm.html_text import extract_main_text, main_text, smoothed
from tastegrid.llm.quality import (
    RATIOS,
    Condition,
    DecisionList,
    fit_rules,
    judged,
    learn_rules,
    repeated_words,
    text_counts,
    text_statistics,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    many = Counter(windows)
    inside = {k + j for k, window in enumerate(windows) if many[window] > 1 for j in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:k] for k, line in enumerate(lines)),
        len(inside),
    )


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab #\n\t\x1c\xa0é|")))
def test_counts_against_the_definition(text):
    assert text_counts(text)[:5] == slow_counts(text)


def test_repeated_windows_overlap():
    assert repeated_words([b"a"] * 4) == 4
    assert repeated_words([b"a", b"b", b"c", b"d"]) == 0


def test_statistics_of_edge_rows(spark):
    rows = text_statistics(edge_docs(spark)).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=repr)
    assert got == sorted(((i, *slow_counts(t)) for i, t, *_ in edge_rows()), key=repr)
    assert all(row[name] is not None for row in rows for name in RATIOS)
    assert text_statistics(empty_docs(spark)).count() == 0


def table_of(rng, rows):
    table = {name: rng.random(rows) for name in RATIOS}
    bad = (table["symbols_per_word"] > 0.8) & (table["word_length"] <= 0.7) | (table["repeated_share"] > 0.9)
    return table, bad


def test_rules_recover_planted_conjunctions():
    rng = np.random.default_rng(1)
    table, bad = table_of(rng, 6000)
    rules = learn_rules(table, bad)
    fresh, truth = table_of(rng, 3000)
    found = rules.rejected(fresh, 3000)
    assert (found & truth).sum() >= 0.95 * truth.sum() and (found & ~truth).sum() <= 0.02 * (~truth).sum()
    assert all(len(rule) <= 4 for rule in rules.rules)


def test_noise_and_missing_classes_give_no_rule():
    rng = np.random.default_rng(2)
    table = {name: rng.random(500) for name in RATIOS}
    assert learn_rules(table, rng.random(500) < 0.1).rules == ()
    assert learn_rules(table, np.zeros(500, dtype=bool)).rules == ()
    assert learn_rules({name: np.empty(0) for name in RATIOS}, np.empty(0, dtype=bool)).rules == ()


def test_list_is_an_ordered_spark_expression(spark):
    rules = DecisionList(((Condition("words", True, 2.0),), (Condition("words", True, 5.0), Condition("word_length", False, 1.0))))
    df = spark.createDataFrame([(1.0, 9.0), (4.0, 3.0), (4.0, 1.0), (9.0, 9.0)], "words double, word_length double")
    assert [tuple(r) for r in df.select(rules.rule_number(), rules.verdict()).collect()] == [
        (1, False), (2, False), (0, True), (0, True),
    ]
    assert [r[0] for r in df.select(DecisionList(()).verdict()).collect()] == [True] * 4


def test_fit_and_judge_on_edge_rows(spark):
    statistics = text_statistics(edge_docs(spark))
    labels = spark.createDataFrame([(1, 0), (9, 1), (12, None), (99, 0)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in judged(statistics, fit_rules(statistics, labels)).collect()}
    assert kept[3] is False and kept[12] is True
    none = fit_rules(text_statistics(empty_docs(spark)), labels)
    assert none.rules == ()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site name and a rather long slogan that says nothing</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="ad">Buy now, this is a long advert with many words in it.</div>
<article><header><h1>Title &amp; more</h1></header><p>First   paragraph<br>goes&nbsp;on and on for a while, long enough.</p>
<aside>See also something else</aside><p>Short.</p><form><label>Mail</label><button>Go</button></form>
<div class="promo-box">Offer</div><ul><li>one<li>two</ul><p><b>Unclosed bold.<p>Last one &lt;here&gt;.
<div id="comments"><p>Reader says a lot of words here, more than the article.</p></div></article>
<div role="complementary">Side</div><footer>&copy; Footer text</footer></body>"""


def test_article_without_the_rest():
    assert main_text(PAGE).split("\n") == [
        "Title & more", "First paragraph goes on and on for a while, long enough.", "Short.", "one", "two",
        "Unclosed bold.", "Last one <here>.",
    ]


def test_pages_without_an_article_use_the_ratio():
    body = "".join(f"<p>{'word ' * 40}{k}</p>" for k in range(4))
    links = "".join(f"<div><a href='#'>l{k}</a> <a href='#'>m</a></div>" for k in range(12))
    page = f"<body>{links}<aside>x</aside><div>{body}</div></body>"
    assert main_text(page).split("\n") == [" ".join(["word"] * 40) + f" {k}" for k in range(4)]


WRAPPERS = [
    '<div class="overflow-hidden">', '<div class="content-sidebar-wrap">', '<div class="page has-sidebar">',
    '<div class="no-sidebar">', '<div id="search-results">', '<section class="post comment-enabled">',
    '<div class="md:hidden">', '<div class="layout-with-sidebar">', '<div class="sidebar">', '<div id="banner">',
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("marked", [True, False])
def test_layout_wrappers_keep_their_article(wrapper, marked):
    body = f"<h1 class='banner-title'>Head</h1><p>{'word ' * 30}</p><p>End.</p>"
    close = f"</{wrapper[1:].split()[0]}>"
    page = f"<body>{wrapper}{'<article>' + body + '</article>' if marked else body}{close}<footer>Foot</footer></body>"
    named = not marked and wrapper in WRAPPERS[-2:]
    assert main_text(page).split("\n") == ([""] if named else ["Head", " ".join(["word"] * 30), "End."])


@pytest.mark.parametrize(
    "name", ["ad", "ads-top", "ad-300", "sidebar", "left-sidebar", "site-footer", "comments", "comment-list", "promo_box", "sidebar-wrapper",
             "x nav", "related-posts", "search", "is-hidden"],
)
def test_chrome_by_name_goes(name):
    text = f"<p>{'word ' * 30}</p>"
    for inside in (f"<p>{'more ' * 20}</p>", f"<article><p>{'more ' * 20}</p></article>"):
        page = f"<body><div>{text}<div class='{name}'>{inside}</div>{text}</div></body>"
        assert main_text(page).split("\n") == [" ".join(["word"] * 30)] * 2


def test_skipped_elements_do_not_split_the_lines_of_a_parent():
    text = f"<p>{'word ' * 40}</p>"
    page = f"<body><div><h1>Head</h1><div class='share'>x</div>{text}<aside>y</aside>{text}<div class='ad'>z</div><p>End.</p></div></body>"
    assert main_text(page).split("\n") == ["Head", *[" ".join(["word"] * 40)] * 2, "End."]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", ">", "</", "<!", "<![", "[", "]", "--", "<p>", "<b>", "</b>", "</p>", "<article", "<div class=ad>",
    "</div>", "<script>", "</script", "&", "&amp", "#x", ";", "a", " ", '"', "'", "=", "/>", "<?", "<!DOCTYPE", "CDATA[", "x["]), max_size=25))
def test_no_page_is_an_error(parts):
    text = main_text("".join(parts))
    assert text == "\n".join(line.strip() for line in text.split("\n")) and "\n\n" not in text


def test_many_open_elements_take_little_time():
    page = "<article>" + "<b>x</i>" * 40_000 + "<p>word " * 40_000
    assert main_text(page).count("word") == 40_000


def test_smoothing_keeps_constants_and_sums_of_neighbours():
    assert np.allclose(smoothed(np.ones(9)), 1)
    assert smoothed(np.eye(1, 9, 4)[0]).argmax() == 4


CHROME = ["class='header'", "id='header'", "class='site-header'", "class='top-bar'", "class='notification'", "class='reactions'"]


@pytest.mark.parametrize("attribute", CHROME)
def test_headers_and_notices_go_without_an_article(attribute):
    body = f"<div class='content'><h1>Head</h1><p>{'word ' * 40}</p><p>End.</p></div>"
    page = f"<body><div {attribute}>Some words of the site</div>{body}<div class='footer'>x</div></body>"
    assert main_text(page).split("\n") == ["Head", " ".join(["word"] * 40), "End."]


DOUBTFUL = [
    "p class='social-history'", "p class='related'", "p class='alert'", "div class='search-engine'", "h2 id='comment'",
    "section id='advertising'", "figure class='widget-photo'", "div class='article-header'", "div class='header'", "span class='alert'",
]


@pytest.mark.parametrize("element", DOUBTFUL)
def test_doubtful_names_in_an_article_go_by_their_ratio(element):
    start, end = f"<p>{'word ' * 40}</p>", f"</{element.split()[0]}>"
    page = "<body><article>%s%s<p>End.</p></article><article><p>Two.</p></article></body>"
    kept = main_text(page % (start, f"<{element}>A sentence of the article.{end}")).split("\n")
    assert kept == [" ".join(["word"] * 40), "A sentence of the article.", "End.", "Two."]
    links = main_text(page % (start, f"<{element}><a href='#'>one</a> <a href='#'>two</a>{end}")).split("\n")
    certain = not element.startswith(("h2", "span")) and "header" not in element
    assert ("one two" in links) is not certain


def test_inline_elements_do_not_split_lines():
    page = "<article><p>One <span class='comment'>two</span> three <span class='ad'>Advert</span> <span hidden>x</span>four.</p></article>"
    assert main_text(page) == "One two three four."


def _without_marks(html):
    html = re.sub(r"<(/?)(article|nav|footer)\b[^>]*>", r"<\1div>", html)
    return html.replace('<div class="ad">', "<div>")


def test_clusters_find_the_article_when_nothing_marks_it(monkeypatch):
    """Pages of the test tables with articles, menus, adverts and footers turned into
    plain divisions: no line of an article is lost, and most pages give nothing else."""
    pages = [row[0] for row in duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()]
    want = [main_text(html) for html in pages]
    bare = [_without_marks(html) for html in pages]

    def exact():
        return sum(main_text(html) == text for html, text in zip(bare, want)) / len(pages)

    assert all(set(text.split("\n")) <= set(main_text(html).split("\n")) for html, text in zip(bare, want))
    assert exact() > 0.8
    monkeypatch.setattr(html_text, "smoothed", lambda ratios: ratios)
    unsmoothed = [main_text(html) for html in bare]
    monkeypatch.setattr(html_text, "smoothed", lambda ratios: np.ones(len(ratios)))
    assert exact() == 0
    monkeypatch.undo()
    assert unsmoothed != [main_text(html) for html in bare]


# A brute-force version for well-formed pages: a walk over the tree.


def _walk(node, parent, hidden, lines):
    """Appends [text, tags, parent] for each line; ``lines[-1]`` is the open one."""
    inline = node.tag in ("b", "a")
    line = node.tag in ("p", "h1", "li", "ul")
    hidden = hidden or node.tag in ("nav", "aside", "footer", "form") or node.get("class") in ("ad", "comments", "site-header")
    inner = parent if inline or line else node
    if not inline:
        lines.append(["", 0, inner])
    lines[-1][1] += 1
    if not hidden:
        lines[-1][0] += node.text or ""
    for child in node:
        _walk(child, inner, hidden, lines)
        if not hidden:
            lines[-1][0] += child.tail or ""
        if child.tag not in ("b", "a"):
            lines[-1][2] = inner
    lines[-1][1] += 1
    if not inline:
        lines.append(["", 0, parent])


def brute_main_text(html):
    lines = [["", 0, None]]
    _walk(ElementTree.fromstring(html), None, False, lines)
    lines = [(" ".join(text.split()), tags, parent) for text, tags, parent in lines if text.strip() or tags]
    ratios = [len(text) / max(tags, 1) for text, tags, _ in lines]
    smooth = []
    for at in range(len(ratios)):
        near = [k for k in range(len(ratios)) if abs(k - at) <= 2]
        weights = [math.exp(-0.5 * (k - at) ** 2) for k in near]
        smooth.append(sum(w * ratios[k] for w, k in zip(weights, near)) / sum(weights))
    ordered, best, border = sorted(smooth), math.inf, min(smooth)
    for cut in range(1, len(ordered)):
        low, high = ordered[:cut], ordered[cut:]
        means = sum(low) / len(low), sum(high) / len(high)
        cost = sum((x - means[0]) ** 2 for x in low) + sum((x - means[1]) ** 2 for x in high)
        if cost < best - 1e-9:
            best, border = cost, sum(means) / 2 if means[1] >= 4 * means[0] else min(smooth)
    content = [parent for (text, _, parent), ratio in zip(lines, smooth) if text and ratio >= border]
    return "\n".join(text for text, _, parent in lines if text and any(parent is one for one in content))


def _random_page(random):
    def words(least, most):
        return " ".join("w" * random.randint(1, 9) for _ in range(random.randint(least, most)))

    def inside(depth):
        parts = []
        for _ in range(random.randint(1, 4)):
            kind = random.choice(["p", "p", "p", "h1", "div", "div", "ul", "nav", "aside", "ad", "form", "comments", "site-header"])
            if kind == "p":
                parts.append(f"<p>{words(0, 40)} <b>{words(1, 3)}</b> {words(0, 9)}</p>")
            elif kind == "h1":
                parts.append(f"<h1>{words(1, 4)}</h1>")
            elif kind == "ul":
                parts.append("<ul>" + "".join(f"<li><a href='#'>{words(1, 2)}</a></li>" for _ in range(4)) + "</ul>")
            elif kind in ("ad", "comments", "site-header"):
                parts.append(f"<div class='{kind}'><p>{words(1, 30)}</p></div>")
            elif kind != "div":
                parts.append(f"<{kind}>{words(1, 9)}</{kind}>")
            elif depth:
                parts.append(f"<div>{inside(depth - 1)}</div>")
        return "".join(parts)

    return f"<html><body>{inside(3)}{inside(3)}</body></html>"


def test_unmarked_pages_against_a_walk_over_the_tree():
    random, some = Random(7), 0
    for _ in range(400):
        page = _random_page(random)
        assert main_text(page) == brute_main_text(page), page
        some += main_text(page) != ""
    assert some > 300


def test_extract_on_edge_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", PAGE, "x", "y"), (1, "u", PAGE, "x", "y"), (2, None, None, None, None), (None, "v", "", "", ""),
            (3, "w", "<p>" + "long " * 50_000, "", ""), (4, "x", "plain <b", "", ""), (5, "y", "<![CDATA[x<p></p", "", "")]
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in extract_main_text(spark.createDataFrame(rows, schema)).collect()}
    assert found[(2, None)] == ("", 0) and found[(None, "v")] == ("", 0)
    assert found[(3, "w")][1] == 5 * 50_000 - 1
    assert found[(1, "u")][0] == main_text(PAGE)
    assert extract_main_text(spark.createDataFrame([], schema)).collect() == []

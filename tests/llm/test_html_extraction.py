import re

import numpy as np
import pytest

from ringledger.llm import html_extraction as he
from ringledger.llm.boosting import Boosted

PAGES = "page_id long, url string, html string, text string, id string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.001/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return he.trained(he.training_pages(pages))


def _article(source):
    inner = re.search(r"<article>(.*?)(</article>|$)", source, re.S)
    parts = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
    plain = [re.sub(r"\s+", " ", he.html.unescape(re.sub(r"</?b>|<br>", "", part))).strip() for part in parts]
    return "\n".join(part for part in plain if part)


def test_articles_of_pages_not_trained_on(spark, model, pages):
    other = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    seen = {row["html"] for row in pages.collect()}
    fresh = [row["html"] for row in other if row["html"] not in seen]
    right = sum(he.main_text(source, model) == _article(source) for source in fresh)
    assert len(fresh) > 100 and right / len(fresh) > 0.98


SIDE = "Read these other things, which are related to what you have read."
MAIN = "This is the text that the page is about, with enough words. It has two sentences, too."


@pytest.mark.parametrize("side", [
    f'<div class="sidebar"><p>{SIDE}</p></div>', f"<aside>{SIDE}</aside>", f"<form><p>{SIDE}</p></form>",
    f'<section id="comments"><p>{SIDE}</p></section>', f'<div class="cookie-notice">{SIDE}</div>',
    f"<footer>{SIDE}</footer>", f'<nav><ul><li><a href="/x">{SIDE}</a></li></ul></nav>',
    f"<script>{SIDE}</script>", f"<style>{SIDE}</style>", f"<!-- {SIDE} -->",
    f'<div class="ad"><p>{SIDE}</p></div>',
])
@pytest.mark.parametrize("inside", [True, False])
def test_side_parts_are_left_out(model, side, inside):
    article = f"<article><h1>Heading here</h1><p>{MAIN}</p>{side if inside else ''}<p>{MAIN}</p></article>"
    source = f"<html><body>{'' if inside else side}{article}</body></html>"
    assert he.main_text(source, model) == f"Heading here\n{MAIN}\n{MAIN}"


def test_text_is_cleaned(model):
    source = f"<article><p>a &amp; b&nbsp;&lt;c&gt;\n\n  <b>d</b><i>e</i> &#233;&eacute; {MAIN}</p></article>"
    assert he.main_text(source, model) == f"a & b <c> de éé {MAIN}"


@pytest.mark.parametrize("source", [None, "", "   ", "<html></html>", "<script>x</script>", "<!-- open"])
def test_pages_without_text(model, source):
    assert he.main_text(source, model) == ""


def test_broken_pages_are_read_as_far_as_they_go(model):
    assert he.main_text(f"<article><p>{MAIN}<p>{MAIN}", model) == f"{MAIN}\n{MAIN}"
    assert he.main_text(f"<article><p>{MAIN}</p></div></b></article></body>", model) == MAIN
    deep = "<div>" * 3000 + MAIN
    assert he.main_text(deep, model) in ("", MAIN)


@pytest.mark.parametrize("head", [
    '<body class="single has-sidebar">', '<body class="page header-fixed">', '<body class="no-search">',
    '<body><div class="layout-sidebar">',
])
def test_wrappers_named_like_side_parts_keep_the_article(model, head):
    nav = '<nav><ul><li><a href="/x">Home</a></li><li><a href="/y">News</a></li></ul></nav>'
    article = f'<article><h1>Heading here</h1><p>{MAIN}</p><p class="share-price">{MAIN}</p></article>'
    source = f"<html>{head}{nav}{article}<footer>{SIDE}</footer></body></html>"
    assert he.main_text(source, model) == f"Heading here\n{MAIN}\n{MAIN}"


def test_parts_under_names_that_tell_nothing_are_left_out(model):
    links = "".join(f'<li><a href="/{k}">Other page {k}</a></li>' for k in range(8))
    article = f"<article><h1>Heading here</h1>{f'<p>{MAIN}</p>' * 4}</article>"
    source = f'<html><body><div class="qwx"><ul>{links}</ul></div>{article}</body></html>'
    assert he.main_text(source, model) == "\n".join(["Heading here", *[MAIN] * 4])


def test_more_than_names_and_tokens_decides(model):
    used = {int(k) for feature, _, _ in model.grown for k in feature if k >= 0}
    named = {he.MEASURES[k] for k in used if k < len(he.MEASURES)}
    assert named & {"paragraph share", "item share", "text a node", "link density", "stop density"}
    assert named & {"depth"}
    assert named & {"order", "order from end", "share of largest sibling", "text before", "text after"}
    assert len(used) > 20


def test_variants_keep_their_labels_with_the_text(pages):
    import random

    chosen = random.Random(3)
    seen = 0
    for row in pages.limit(40).collect():
        page = he.parsed(row["html"])
        held = he.ruled(page)
        main = {text for node, text, _ in page.blocks if held[node]}
        side = {text for node, text, _ in page.blocks if not held[node]}
        for _ in range(5):
            other, kept = he.varied(page, held, chosen)
            texts = {text for node, text, _ in other.blocks if kept[node]}
            assert texts <= main and all(node.parent < k for k, node in enumerate(other.nodes))
            assert not {text for node, text, _ in other.blocks if not kept[node]} & (main - side)
            seen += [node.tokens for node in other.nodes] != [node.tokens for node in page.nodes]
    assert seen > 50


def test_pages_judged_together_or_alone(model, pages, monkeypatch):
    sources = [row["html"] for row in pages.collect()] + [None, "", "<p>" + "word. " * 200_000]
    together = he.main_texts(sources, model)
    monkeypatch.setattr(he, "NODES_AT_ONCE", 1)
    assert he.main_texts(sources, model) == together


def test_decoding_is_the_best_of_all_consistent_labellings():
    rng = np.random.default_rng(1)
    page = he.parsed("<div>a<div>bb<p>ccc</p></div><section><p>d</p>ee</section></div>f")
    n = len(page.nodes)
    size = np.zeros(n)
    for node, text, _ in page.blocks:
        size[node] += len(text)
    up = np.array([node.parent for node in page.nodes])
    labellings = [np.array([(k >> i) & 1 for i in range(n)], dtype=bool) for k in range(1 << n)]
    labellings = [kept for kept in labellings if kept[0] and all(kept[up[i]] for i in range(1, n) if kept[i])]
    for _ in range(200):
        margin = rng.normal(1, 2, size=n)
        chance = 1 / (1 + np.exp(-margin))
        chance[0] = 1  # the whole page is not judged
        for k in range(1, n):
            chance[k] *= chance[up[k]]
        kept = he.decoded(page, margin)
        assert all(kept[up[k]] for k in range(1, n) if kept[k])
        right = [(size * np.where(labels, chance, 1 - chance)).sum() for labels in labellings]
        assert (size * np.where(kept, chance, 1 - chance)).sum() == pytest.approx(max(right))


def test_query_matches_the_pages_alone(spark, pages):
    from ringledger.llm.queries import QUERIES

    found = QUERIES["op10_html_extraction"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = {row["page_id"]: row for row in found.collect()}
    learned = he.trained(he.training_pages(pages))
    source = pages.collect()
    assert len(rows) == len(source)
    for row in source:
        text = he.main_text(row["html"], learned)
        assert (rows[row["page_id"]]["text"], rows[row["page_id"]]["n_chars"]) == (text, len(text))


def test_table_rows_names_and_repeats(spark):
    rows = [(1, "u", f"<article><p>{MAIN}</p></article>", "mine", "mine")] * 2 + [(None, None, None, "mine", "mine")]
    found = he.extracted(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted(((r["id"], r["url"], r["text"]) for r in found), key=str) == sorted(
        [(1, "u", MAIN), (1, "u", MAIN), (None, None, "")], key=str)
    assert he.extracted(spark.createDataFrame([], PAGES)).collect() == []


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = Boosted().fit(x[:1500], y[:1500], np.ones(1500))
    assert ((model.margin(x[1500:]) > 0) == y[1500:]).mean() > 0.95

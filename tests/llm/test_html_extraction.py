import time
from collections import Counter

import numpy as np
import pytest

from tripyard.llm import html_extraction as hx

DATA = "/root/testdata/sf0.01/pages.parquet"


def texts(html):
    return [b[0] for b in hx.blocks_of(html)]


def test_blocks_paths_and_references():
    html = """<!DOCTYPE html><html><head><title>no &amp; never</title><style>p{}</style><script>var t="</p><p>x";</script></head>
      <body><nav class='top menu'><ul><li><a href="/a">One</a><li>Two</ul></nav><!-- <p>hidden</p> --><article id=main>
      <h1>A &lt;b&gt;   title &copy;</h1><p>first <b>bold<br>line</b> &eacute;&#233;&#xE9; &unknown; 1 < 2<p>second<table><tr><td>x<td>y</table>tail</article>
      <p>open <div>inner</div>after"""
    found = hx.blocks_of(html)
    assert [b[0] for b in found] == ["One", "Two", "A <b> title ©", "first bold line ééé &unknown; 1 < 2", "second", "x", "y", "tail", "open", "inner", "after"]
    assert found[0][1] == ("html", "body", "nav", "=top menu", "top", "menu", "ul", "li", "a") and found[0][2] == 1.0
    assert found[4][1][:4] == ("html", "body", "article", "=main") and found[4][1][-1] == "p"
    assert found[9][1] == ("html", "body", "div")


@pytest.mark.parametrize("html", ["", "   ", "<", "<p", "<!--", "<!-->x", "</p>", "<script>never closed", "<p a='<b>'>", "<<p>>", "&", "<br>", "</", "<a b=\"c"])
def test_odd_markup_does_not_fail(html):
    hx.blocks_of(html)


@pytest.mark.parametrize("inner, want", [
    ('<p>One<svg class="icon"/><p>Two', ["One", "Two"]),
    ('<p>One<svg class=icon><path d="M0"/><p>Two <svg><circle/></svg>three', ["One", "Two three"]),
    ('<p>One <svg><title>Icon</title><style>a{}</style><title/><text>A</text><text>B</text></svg>two', ["One A B two"]),
    ("<p>One <svg><title>Icon<p>Two", ["One", "Two"]),
    ("<p>One <svg><script><![CDATA[ if (a<b) x> ]]></script></svg>two<p>Three", ["One two", "Three"]),
    ("<p>One <svg><foreignObject><div>in</div><script>x</script></foreignObject><path/></svg><p>Two", ["One", "in", "Two"]),
    ("<p>One <math/>and <math><mi>x</mi><mo>=</mo><mn>2</mn></math>.<p>Two", ["One and x=2.", "Two"]),
    ("<p>One <math><mi>x<p>Two", ["One x", "Two"]),
    ('<p>One <object data="a">fallback <b>text</b></object> on<p>Two', ["One fallback text on", "Two"]),
    ('<p>One <object data="a"><p>Two<object/><p>Three', ["One", "Two", "Three"]),
    ("<p>One<xmp><p>a &amp; b</xmp>two<xmp/>three", ["One", "<p>a &amp; b", "two", "three"]),
    ("<p>One<xmp><i>rest", ["One", "<i>rest"]),
    ("<p>One<template>x<template>y</template>z</template> two<template/>!<template>three<p>Four", ["One two!three", "Four"]),
    ("<p>One<template><script>'<template>'</script>x</template>", ["One"]),
    ("<p>One<script>a<p>b</script><style>c</style><noscript>d</noscript><p>Two<script>e<p>f", ["One", "Two"]),
])
def test_only_raw_text_hides_text(inner, want):
    found = hx.blocks_of(f"<article>{inner}")
    assert [b[0] for b in found] == want and all(b[1][0] == "article" for b in found)


def test_a_stray_end_of_a_paragraph_closes_nothing_else():
    found = hx.blocks_of("<body><article><p>x</p>y</p>z</article><footer><p>a<ul><li>b</ul></p><p>c</p>d</footer></p><p>e")
    assert [(b[0], b[1]) for b in found] == [
        ("x", ("body", "article", "p")), ("y", ("body", "article")), ("z", ("body", "article")),
        ("a", ("body", "footer", "p")), ("b", ("body", "footer", "ul", "li")), ("c", ("body", "footer", "p")),
        ("d", ("body", "footer")), ("e", ("body", "p"))]


def test_many_unclosed_elements_stay_linear():
    for tag in ("template", "svg", "math", "object", "svg><title"):
        assert " ".join(texts(f"<{tag}>" * 5000 + "<p>x")) == "x"


def test_plain_text_and_long_pages():
    assert texts("just text") == ["just text"]
    assert len(texts("<p>x y" * 20_000)) == 20_000
    assert texts("<div>" * 3000 + "deep") == ["deep"]


def test_gradients_are_those_of_finite_differences():
    pages = [hx.blocks_of("<nav>a b</nav><article><p>c d<p>e</article><footer>f"), hx.blocks_of("<p>x<p>y z")]
    tagger = hx.BlockTagger(seed=1)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    s = hx.Sequences.of(pages, hx.Buckets(hx.PATH_BUCKETS))
    s.extra = s.extra.astype(np.float64)
    y = np.array([0, 1, 1, 0, 1, 1.0])

    def loss():
        p = np.clip(tagger.probabilities(s).astype(np.float64), 1e-9, 1 - 1e-9)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, g in tagger._gradients(s, y).items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        kept, eps = tagger.p[name][at], 1e-2
        tagger.p[name][at] = kept + eps
        up = loss()
        tagger.p[name][at] = kept - eps
        down = loss()
        tagger.p[name][at] = kept
        assert (up - down) / (2 * eps) == pytest.approx(g[at], rel=0.03, abs=1e-5), name


def test_grouping_pages_changes_no_label():
    tagger = hx.BlockTagger()
    pages = [hx.blocks_of("<p>a b" * n + "<nav>c" * (n % 3)) for n in (1, 5, 0, 30, 2)]
    together = tagger.probabilities(hx.Sequences.of(pages, hx.Buckets(hx.PATH_BUCKETS)))
    alone = [tagger.probabilities(hx.Sequences.of([p], hx.Buckets(hx.PATH_BUCKETS))) for p in pages]
    assert np.allclose(together, np.concatenate(alone), atol=1e-5)


BODY = "".join(f"<p>Sentence number {i} of the text, with some words." for i in range(4))
LINES = [f"Sentence number {i} of the text, with some words." for i in range(4)]
#: Pages and the lines of their main text, labelled by hand.
BY_HAND = [
    (f"<html class=nav-fixed><body class='no-sidebar search'><nav>Home</nav><article class=long-form>{BODY}</article><footer>End of site</footer>", LINES),
    (f"<body><main><section id=discussion><h2 id=search>Discussion of it</h2>{BODY}</section></main><div class=site-footer>End of site</div>",
     ["Discussion of it", *LINES]),
    (f"<body><div class='page has-sidebar'><article><p class=byline>By A. Writer</p>{BODY}<p class=legal>Terms of the text apply.</p></article></div>"
     "<div class=comment-list><p>I like this.</p></div>", ["By A. Writer", *LINES, "Terms of the text apply."]),
    (f"<body><article>{BODY}<p><span class=label>Update:</span> and a last paragraph.</p></article><aside>Read next</aside>",
     [*LINES, "Update: and a last paragraph."]),
    (f"<body><article>{BODY}<p><span class=ad>Buy now</span> One more paragraph of text.</p><p>The end <a class=share href=/s>Share</a></p></article>",
     [*LINES, "One more paragraph of text.", "The end"]),
    (f"<body><form id=whole><div class=menu>Home</div><article>{BODY}</article></form>", LINES),
    (f"<body><article>{BODY}<pre><span class=hljs-comment># one</span> x = 2</pre></article>", [*LINES, "# one x = 2"]),
]


@pytest.mark.parametrize("html, want", BY_HAND)
def test_names_label_as_by_hand(html, want):
    assert [t for t, names, _ in hx.blocks_of(html) if hx.name_label(names)] == want


def test_pages_labelled_by_hand(spark):
    tagger = hx.train(spark.read.parquet(DATA))
    df = spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(BY_HAND)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"].split("\n") for r in hx.extract(df, tagger=tagger).collect()}
    assert got == {i: want for i, (_, want) in enumerate(BY_HAND)}


def test_unseen_names_share_no_vector_with_boilerplate():
    buckets = hx.Buckets(hx.PATH_BUCKETS)
    bad = {buckets[x] for n in hx.BOILERPLATE for x in (n, f"={n}")}
    other = "page document article section intro =intro =single primary =primary richtext =richtext abbr cite".split()
    assert not bad & {buckets[n] for n in other}
    page = hx.training_pages(["<nav class=ads>a b</nav><article><p>c d<p>e f g</article><footer>h</footer>"] * 8)
    tagger = hx.BlockTagger()
    tagger.fit(page)
    vectors = tagger.p["path"]
    assert all((vectors[buckets[n]] == vectors[buckets[hx.UNSEEN]]).all() for n in ("page", "intro", "richtext", "abbr"))
    assert (vectors[buckets["nav"]] != vectors[buckets[hx.UNSEEN]]).any()


def expected(html):
    """Page text by the names on the paths."""
    return "\n".join(t for t, names, _ in hx.blocks_of(html or "") if hx.name_label(names))


def test_pages_of_the_given_table(spark):
    pages = spark.read.parquet(DATA)
    want = {r["page_id"]: expected(r["html"]) for r in pages.collect()}
    got = hx.extract(pages).collect()
    right = sum(r["text"] == want[r["page_id"]] for r in got)
    assert len(got) == len(want) and right / len(got) > 0.99
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_other_templates_and_odd_rows(spark):
    pages = spark.read.parquet(DATA)
    tagger = hx.train(pages)
    body = "".join(f"<p>Sentence number {i} of the text, with some words." for i in range(6))
    other = {1: (f"<body><header>Site name</header><main>{body}</main><aside>Read next</aside><form><label>Mail</label><button>Send</button></form></body>"),
             2: f"<body><div class='sidebar'><p>Links here</p></div><div class=content>{body}</div><section class='comments'><p>I like this.</p></section></body>",
             3: f"<body><div class=cookie><p>We use cookies.</p></div><article>{body}<div class=advert>Buy now</div></article><div id=footer>Legal</div></body>"}
    rows = [(i, "u", h, "x", 5) for i, h in other.items()] + [(4, None, None, "x", 5), (5, "u", "", "x", 5), (None, "u", other[1], "x", 5), (1, "u", other[1], "x", 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = hx.extract(df, tagger=tagger).collect()
    want = "\n".join(f"Sentence number {i} of the text, with some words." for i in range(6))
    assert Counter((r["page_id"], r["url"], r["text"]) for r in got) == Counter(
        [(1, "u", want), (1, "u", want), (2, "u", want), (3, "u", want), (4, None, ""), (5, "u", ""), (None, "u", want)])


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert hx.extract(empty).collect() == []


@pytest.mark.parametrize("html, blocks", [
    ("<div>x" * 60_000, 60_000), ("<a " * 100_000, 1), ("<a " * 100_000 + '"x>', 1), ('<a "' * 100_000, 1), ("<a" * 100_000 + ' ">', 1),
    ("<div>" * 60_000 + "</b>" * 60_000, 0), ("<span>" * 60_000 + "<p>x" * 60_000, 60_000), ("</ " * 100_000, 1),
    ("<svg>" + "<![CDATA[ >" * 60_000, 0), ("<template>" + "<template " * 60_000, 1), ("<b><li>x" * 60_000, 60_000),
    ("<form>x" * 60_000 + "<article>y" * 60_000, 120_000)])
def test_nested_and_unclosed_tags_take_linear_time(html, blocks):
    begun = time.process_time()
    found = hx.linked_blocks(html)
    table = np.ones((hx.PATH_BUCKETS, hx.VECTOR), np.float32)
    s = hx.Sequences.of([found], hx.Buckets(hx.PATH_BUCKETS), table) if found else None
    assert time.process_time() - begun < 20  # quadratic work would take minutes
    assert len(found) == blocks
    assert s is None or np.allclose(s.path_mean, 1)


@pytest.mark.parametrize("html", [
    "<form>a<main class=x>b<form>c<article id=form>d<article class='form nav'>e", "x<p>y<div class='code nav'>z<span id=ad>w",
    "<article class=nav>a<pre class=menu>b<i class=ad>c</pre><section role='site-footer menus'>d<form>e<main>f<article>g"])
def test_linked_paths_have_the_mean_vector_of_their_names(html):
    paths = hx.Buckets(hx.PATH_BUCKETS)
    table = np.random.default_rng(1).normal(size=(hx.PATH_BUCKETS, hx.VECTOR)).astype(np.float32)
    found = hx.linked_blocks(html)
    linked = hx.Sequences.of([found], paths, table).path_mean
    plain = [table[[paths[n] for n in hx.path_names(names) or ("",)]].mean(axis=0) for _, names, _ in hx.blocks_of(html)]
    assert np.allclose(linked, plain, atol=1e-5)


def test_a_tag_that_never_ends_is_text():
    assert texts('<p>a <b title="x>c</p>') == ['a <b title="x>c']
    assert texts("<p>a</p><p class=x") == ["a", "<p class=x"]
    assert texts("<p>1 < 2 <3 </p>") == ["1 < 2 <3"]

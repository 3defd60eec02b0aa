import pytest
from hypothesis import given, settings, strategies as st

from salesmill.llm.html import _densities, _order, extract, main_text, parse

LONG = "A long paragraph of the article with many words in it, so that its density is high enough to matter. " * 2
OTHER = "Another paragraph of the same article that says more about the subject and ends here after a while. " * 2
ARTICLE = f"{LONG.strip()}\n\n{OTHER.strip()}"


@pytest.mark.parametrize("page, text", [
    (f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/a>A</a></ul></nav>"
     f"<article><h1>Title</h1><p><b>{LONG}<br><p>{OTHER}</article><footer>&copy; x</footer></body></html>", f"Title\n\n{ARTICLE}"),
    (f"<body><div class='menu'><a>Home</a></div><div id=main-content><h1>Title</h1><div><p>{LONG}<p>{OTHER}</div></div>"
     f"<div class='sidebar'><p>{OTHER}</p></div><div id=comments><p>{LONG}</p></div></body>", f"Title\n\n{ARTICLE}"),
    (f"<div class=wrap><div class=x><p>{LONG}</p><p>{OTHER}</p></div><div class=y><a href=1>one link</a> <a href=2>two links</a></div></div>", ARTICLE),
    (f"<body><main><header><h1>T</h1></header><p>{LONG}</p></main><form><p>{OTHER}</p></form><aside>{OTHER}</aside></body>", f"T\n\n{LONG.strip()}"),
    ("<article><p>caf&eacute; &amp; th&#233; &lt;b&gt;\n\t two&nbsp;&nbsp;spaces <i>in</i><b>line</b></p></article>", "café & thé <b> two spaces inline"),
    (f"<article><p>{LONG}<!-- <p>no</p> --><script>no()</script><p>{OTHER}", ARTICLE),
    (f"<article class='has-sidebar ad-free'><p>{LONG}</p><article class=comment><p>{OTHER}</p></article></article>", LONG.strip()),
    (f"<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table><p>{LONG}</article>", f"one\n\ntwo\n\na\n\nb\n\nc\n\n{LONG.strip()}"),
    (f"<article><p hidden>no</p><div style='display: none'>no</div><div role=alert>no</div><p>{LONG}</article>", LONG.strip()),
    (f"<div class='page sidebar'><article><p>{LONG}</article></div>", LONG.strip()),
    ("plain text &amp; more", "plain text & more"), ("<p>a", "a"), ("", ""), (None, ""), ("  \n", ""), ("<script>x</script>", ""),
    ("<html><body></body></html>", ""),
])
def test_main_text(page, text):
    assert main_text(page) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='", "x", "<", ">", "</", "<b>", "</div>", "<!--", "-->", "'", '"', "<td>", "&amp", "<script>",
                                 "<table>", "<li>", "</article>", "<article>", "<a href=", "<body>", "<head>", "text ", "<br/>", "</body>", "é"]), max_size=40))
def test_broken_markup_does_no_harm(parts):
    text = main_text("".join(parts))
    assert text == text.strip() and "\n\n\n" not in text


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + LONG) == LONG.strip()
    assert len(main_text("<article>" + f"<p>{LONG}</p>" * 3000)) == 3000 * (len(LONG.strip()) + 2) - 2
    assert main_text("<" * 100_000) and main_text("<a '" * 30_000) is not None


def test_rows(spark):
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    rows = [(1, "u", f"<p>{LONG}", "x", "x"), (1, "u", f"<p>{LONG}", "x", "x"), (2, None, None, "x", "x"), (None, "u", "", "x", "x")]
    found = extract(spark.createDataFrame(rows, schema))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(
        [(1, "u", LONG.strip(), len(LONG.strip()))] * 2 + [(2, None, "", 0), (None, "u", "", 0)], key=str
    )
    assert extract(spark.createDataFrame([], schema)).collect() == []


def test_given_pages(spark):
    """The tables' pages hold one article element each; nothing of it is lost and nothing else is in."""
    import html
    import re

    for r in extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).join(
        spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        article = re.split("</article>|<footer", r.html.split("<article>")[1])[0]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]*>", " ", b))).strip() for b in re.split("</?p>|</?h1>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


@pytest.mark.parametrize("page, text", [
    (f"<article><p><svg class='i' viewBox='0 0 1 1'/>{LONG}</p><p>{OTHER}</p></article>", ARTICLE),
    (f"<article><p><svg/>{LONG}</p><p>{OTHER}</p><svg><title>no</title><path d='M0'/></svg></article><footer>x</footer>", ARTICLE),
    (f"<article><p><svg><text>no</text></svg>{LONG}</p><p>{OTHER}</p></article>", ARTICLE),
    (f"<article><p><svg width=1/><text>no</text></svg>{LONG}</p><p>{OTHER}</p></article>", ARTICLE),
    (f"<article><p><svg class=i>{LONG}</p><p>{OTHER}</p></article>", ARTICLE),
    (f"<article><p><math/>{LONG}</p><p>{OTHER}</p></article>", ARTICLE),
    ("<article><p>so <math><mi>a</mi><mo>+</mo><mn>1</mn></math> is it</p></article>", "so a+1 is it"),
    ("<article><p>so <math><mi>a</mi><mspace/><mprescripts/><mn>1</mn></math> is it</p><p>b</p></article>", "so a1 is it\n\nb"),
    ("<article><p>so <math><mi>a</mi><mspace width='1em'/><mi>b</mi></math> is</p></article><footer>no</footer>", "so ab is"),
    ("<body><div><p>x <math><mi>a</math> y</p></div></body>", "x a y"),
])
def test_inline_svg_and_math(page, text):
    assert main_text(page) == text


LINKS = "".join(f"<li><a href=/{k}>Read more of story {k}</a></li>" for k in range(30))


@pytest.mark.parametrize("page, text", [
    (f"<article><h2 id='related-work'>Work</h2><p>{LONG}</p><p id=share-prices>{OTHER}</p></article>", f"Work\n\n{ARTICLE}"),
    (f"<article><p class='comment-on-law'>{LONG}</p><div class=promotion-chart><p>{OTHER}</p></div></article>", ARTICLE),
    (f"<article><h2 id=comments>On comments</h2><p id=notice>{LONG}</p><p>{OTHER}<code class=comment># x</code></p></article>",
     f"On comments\n\n{ARTICLE} # x"),
    (f"<body><div><p>{LONG}</p><div class='related-posts'><p>{OTHER}</p></div><p>{OTHER}</p></div><div id=site_footer>{LONG}</div></body>", ARTICLE),
    (f"<body><div>A short lead.</div><div><p>{LONG}</p><p>{OTHER}</p><p>{LONG}</p></div><div>So it ends.</div></body>",
     f"A short lead.\n\n{ARTICLE}\n\n{LONG.strip()}\n\nSo it ends."),
    (f"<body><div><section><h2>A</h2><p>{LONG}</p><p>{OTHER}</p></section><section><h2>B</h2><p>One.</p></section>"
     f"<section><h2>C</h2><p>{LONG}</p><p>{OTHER}</p></section><section><h2>D</h2><p>Two words.</p></section></div></body>",
     f"A\n\n{ARTICLE}\n\nB\n\nOne.\n\nC\n\n{ARTICLE}\n\nD\n\nTwo words."),
    (f"<body><div><p>{LONG}</p><p>{OTHER}</p></div><div>© 2024 A site. All rights reserved.</div></body>", ARTICLE),
    (f"<article><p>{LONG}</p><p>{OTHER}</p><h3>More</h3> <ul>{LINKS}</ul></article>", ARTICLE),
    (f"<main><div><p>{LONG}</p><p>{OTHER}</p></div><div>" + "<p><a href=/x>Read more</a></p>" * 30 + "</div></main>", ARTICLE),
    (f"<article><p>{LONG}</p><p>{OTHER}</p>" + "<a href=/x>Read more</a> | " * 30 + "</article>", ARTICLE),
    (f"<article><p>{LONG}</p><article><h3><a href=/x>Other</a></h3><p>Short one.</p></article><p>{OTHER}</p></article>", ARTICLE),
    (f"<main><p>{LONG}</p><p>{OTHER}</p><article><h3>Other</h3><p>Short one.</p><a href=/x>Read on</a></article></main>", ARTICLE),
    (f"<article><p>{LONG}</p><p>See <a href=1>a</a>, <a href=2>b</a> and <a href=3>c</a>.</p><ul><li>one<li><a href=x>two</a></ul></article>",
     f"{LONG.strip()}\n\nSee a, b and c.\n\none\n\ntwo"),
    (f"<article><p>{LONG}</p><div>So say <a href=1>a</a>, <a href=2>b</a>, <a href=3>c</a> and d.</div><p>{OTHER}</p></article>",
     f"{LONG.strip()}\n\nSo say a, b, c and d.\n\n{OTHER.strip()}"),
])
def test_density_and_whole_names_decide(page, text):
    assert main_text(page) == text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<a>", "</a>", "<b>", "</b>", "some words ", "more ", "<ul><li>", "</ul>"]), max_size=40))
def test_densities_are_those_of_the_definition(parts):
    import math

    body = parse("<body>" + "".join(parts))
    nodes = _order(body)
    _densities(nodes, body)

    def below(node):
        return [d for c in node.children if not isinstance(c, str) for d in [c, *below(c)]]

    def chars(node):
        return sum(len("".join(c.split())) if isinstance(c, str) else chars(c) for c in node.children)

    def linked(node):
        return chars(node) if node.tag == "a" else sum(linked(c) for c in node.children if not isinstance(c, str))

    def link_tags(node):
        return len(below(node)) + 1 if node.tag == "a" else sum(link_tags(c) for c in node.children if not isinstance(c, str))

    def density(node):
        n, links = chars(node), linked(node)
        if not n:
            return 0.0
        tags = max(len(below(node)), 1)
        base = math.log(n / max(n - links, 1) * links + linked(body) / chars(body) * n + math.e)
        inner = max(n / max(links, 1) * tags / max(link_tags(node), 1), 1.0)
        return max(n / tags * math.log(inner) / math.log(base + 1), 0.0)

    for node in nodes:
        assert math.isclose(node.density, density(node), rel_tol=1e-6, abs_tol=1e-6)
        assert math.isclose(node.score, sum(density(c) for c in node.children if not isinstance(c, str)), rel_tol=1e-6, abs_tol=1e-5)

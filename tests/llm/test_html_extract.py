import random

import pytest

from tidemark.llm import html_extract as H


@pytest.fixture(scope="module")
def trees():
    return H.train()


def text(trees, source):
    return H.main_text([H.Page(source)], trees)[0]


PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">Menu one'
        '</a></li><li><a href="/b">two</a></li></ul></nav><!-- ad --><div class="ad">Buy now.</div><article><h1>The title</h1>{}</article>'
        "<footer>&copy; x &middot; Words here.</footer></body></html>")


def test_article_of_a_page(trees):
    body = "<p><b>First  words &amp; more,\n here.<br><p>Second one, with <a href='/x'>a link</a> in it.</p><p>Third &lt;b&gt; part.</p>"
    assert text(trees, PAGE.format(body)) == "The title\nFirst words & more, here.\nSecond one, with a link in it.\nThird <b> part."


def test_cut_off_page_and_references(trees):
    body = "<p>Some long words of the article, told at length here.</p><p>More &#233; &am &amp bits of it here.</p>"
    source = PAGE.format(body)
    assert text(trees, source[: source.index("</article>")] + "<p cla").endswith("More é &am & bits of it here.")


LONG = "Words of the article are told at length here, and then some more of them."


@pytest.mark.parametrize("icon", ['<svg class="i" viewBox="0 0 1 1"/>', "<math/>", '<svg><path d="M0"/><g><use href="#x"/></g></svg>', "<svg><path d='M0'>"])
def test_an_icon_does_not_hide_the_article(trees, icon):
    source = PAGE.format(f"<p>{LONG}</p><p>{LONG} Twice.</p>")
    want = f"The title\n{LONG}\n{LONG} Twice."
    assert text(trees, source) == want
    assert text(trees, source.replace("<nav>", f"<header>{icon}<p>Site</p></header><nav>")) == want


def test_formulas_and_literal_text_are_kept(trees):
    formula = "<math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math>"
    body = f"<p>{LONG} So {formula} holds <svg><path d='M0'/></svg>always.</p><xmp><b>{LONG}</b> &amp;</xmp><p>{LONG} Last.</p>"
    assert text(trees, PAGE.format(body)) == f"The title\n{LONG} So E=mc2 holds always.\n<b>{LONG}</b> &amp;\n{LONG} Last."


def test_svg_text_becomes_nodes():
    page = H.Page(f"<article><p>Before <svg><title>Chart</title><text x='1'>Label <tspan>one</tspan></text><text><![CDATA[a < b]]></text>"
                  "<style>p{}</style><foreignObject><div>Inside</div></foreignObject></svg> after</p></article>")
    assert [t for t in page.text if t] == ["Before", "Chart", "Label one", "a < b", "Inside", "after"]
    assert page.tag[page.parent[page.text.index("Label one")]] == "text"


@pytest.mark.parametrize("source", ["<svg", "<svg><math><svg/>", "</svg><math>x", "<xmp>", "<svg>" * 5000 + "x", "<svg><title>" * 3000, "<math><mi><p>" * 2000,
                                    "", "<", "<p", "<!--", "<script>x", "</p></div>", "<a href='", "&", "<![CDATA[", "<div " * 50, "<p>" * 3000,
                                    "<div>" * 5000 + "x", "<table><td>1<td>2<tr>3", "a" * 100_000, "<b>" * 2000 + "y" + "</b>" * 10])
def test_broken_pages_do_not_fail(trees, source):
    assert isinstance(text(trees, source), str)


def test_unseen_templates(trees):
    """Main text of templates that were not trained on."""
    rng = random.Random(4242)
    hit = made = wanted = 0
    for _ in range(200):
        source, main = H.template_page(rng)
        got = text(trees, source).split("\n")
        hit += len(set(got) & set(main))
        made += len(set(got) - {""})
        wanted += len(set(main))
    assert hit / made > 0.97 and hit / wanted > 0.97


def test_decoding_keeps_ancestors(trees):
    rng = random.Random(7)
    for _ in range(30):
        page = H.Page(H.template_page(rng)[0])
        odds = trees.margin(page.features())
        keep = page.decode(odds)
        assert all(keep[p] for p, k in zip(page.parent, keep) if k and p >= 0)
        # no better labelling among those that drop one kept subtree or add one dropped child
        total = lambda k: float(odds[k].sum())
        best = total(keep)
        for i in range(1, len(keep)):
            other = keep.copy()
            if keep[i]:
                inside = {i}
                for j in range(i + 1, len(keep)):
                    if page.parent[j] in inside:
                        inside.add(j)
                other[list(inside)] = False
            elif keep[page.parent[i]]:
                other[i] = True
            assert total(other) <= best + 1e-9


def test_rows_and_columns(spark):
    rows = [(1, "u", PAGE.format("<p>Words of the piece, and some more of them.</p>"), "t", 3), (2, None, None, None, None), (None, "v", "", "", 0),
            (1, "u", PAGE.format("<p>Words of the piece, and some more of them.</p>"), "t", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    out = H.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(map(tuple, out.collect()), key=str)
    piece = "The title\nWords of the piece, and some more of them."
    assert got == sorted([(1, "u", piece, len(piece))] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=str)
    assert H.extract(df.limit(0)).count() == 0


def test_large_pages_are_worked_on_apart(spark, monkeypatch):
    """Slices are made by bytes: pages of over a slice alone, small ones together."""
    big = PAGE.format("".join(f"<p>Paragraph {k} of a long piece with a few more words.</p>" for k in range(30_000)))
    assert len(big) > H.SLICE_BYTES * 0.7
    rows = [(k, "u", big if k % 2 else PAGE.format("<p>Short words of the piece here.</p>")) for k in range(6)]
    out = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect()}
    assert all(out[k] == out[k % 2] for k in range(6)) and len(out[1]) > 30 * len(out[0])

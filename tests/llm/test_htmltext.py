import re
from html import unescape

import numpy as np
import pytest

from memweave.llm import htmltext, training
from memweave.sources.tables import load
from tests.llm.helpers import awkward, nothing

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model():
    return htmltext.fit(training.layouts(600))


def article_blocks(html):
    """Main text of a page of the table, straight from its one layout."""
    body = re.search(r"<article>(.*?)(</article>|$)", html, re.DOTALL)[1]
    parts = [unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))) for p in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(b for b in (" ".join(p.split()) for p in parts) if b)


def test_table_pages(spark):
    pages = load(spark, SF, "pages")
    got = {r.page_id: r for r in htmltext.extract_main_text(pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == article_blocks(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_held_out_layouts(model):
    wrong = 0
    for k in range(150):
        writer = training.Writer(777_000_000 + k)
        html = writer.page()
        page = htmltext.Page(html)
        want = page.text(np.array(writer.label, bool))
        wrong += htmltext.extract_texts([html], model) != [want]
    assert wrong <= 3


def test_held_out_layouts_without_names(model):
    lost = extra = total = 0
    for k in range(150):
        writer = training.Writer(555_000_000 + k, plain=True)
        html = writer.page()
        want = htmltext.Page(html).text(np.array(writer.label, bool)).split("\n")
        got = htmltext.extract_texts([html], model)[0].split("\n")
        lost += sum(len(x) for x in set(want) - set(got))
        extra += sum(len(x) for x in set(got) - set(want))
        total += sum(map(len, want))
    assert lost <= 0.05 * total and extra <= 0.05 * total


STORY = [f"Paragraph {k} tells of the river, the town and its people, who {'often ' * k}walked over the hills and sang. They came home late, "
         "tired, but glad to see light in the windows of every house that they passed on the way down." for k in range(8)]


@pytest.mark.parametrize("around", ["%s", "<div>%s</div>", "<div class=container>%s</div>", "<section>%s</section>", "<table><tr><td>%s</td></tr></table>",
                                    "<div id=x7><div class='row'>%s</div></div>", "<center>%s</center>"])
@pytest.mark.parametrize("before, after", [("", ""), ("<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>", "<footer><p>&copy; 2024 Brand</p></footer>"),
                                           ("<header><h1>Brand</h1></header><div class=ad>Buy now, pay later.</div>", "<div class=comments><p>Nice story.</p></div>")])
def test_articles_that_no_name_marks(model, around, before, after):
    body = around % "".join(f"<p>{p}</p>" for p in STORY)
    assert htmltext.extract_texts([f"<!doctype html><html><body>{before}{body}{after}</body></html>"], model) == ["\n".join(STORY)]


def test_fragments_and_phrases(model):
    got = htmltext.extract_texts(["<p>one two.</p><p>three four.</p>", "plain <b>text</b> here", "<p>a <em>b <i>c</i></em> d <a href=x>e</a></p>"], model)
    assert got == ["one two.\nthree four.", "plain text here", "a b c d e"]


def test_pages_without_an_article_stay_empty(model):
    menu = "<nav><ul>" + "".join(f"<li><a href=/{k}>Section number {k}</a>" for k in range(20)) + "</ul></nav>"
    assert htmltext.extract_texts([f"<html><body>{menu}<div class=ad>Buy now.</div><footer>&copy; 2024 Brand</footer></body></html>"], model) == [""]


def test_densest_element_when_nothing_is_kept():
    links = "".join(f"<a href=/{k}>Link number {k}</a> " for k in range(30))
    page = htmltext.Page(f"<body><div>{links}</div><div><p>{'</p><p>'.join(STORY)}</p><div class=ad>{STORY[0]}</div></div></body>")
    page.features()
    assert page.text(page.densest()) == "\n".join(STORY)
    short = htmltext.Page("<body><p>Too short.</p></body>")
    short.features()
    assert not short.densest().any()


def test_decoding_is_the_best_consistent_labelling():
    rng = np.random.default_rng(3)
    for _ in range(60):
        page = htmltext.Page("".join(rng.choice(["<div>", "<p>", "</div>", "word ", "<section>", "</section>", "<ul><li>x"]) for _ in range(9)))
        n = len(page.tag)
        page.features()
        p = np.clip(rng.random(n), 0.05, 0.95)
        has = np.array(page.chars) > 0
        score = lambda kept: sum(np.log(p[k] if kept[k] else 1 - p[k]) for k in range(1, n) if has[k])
        best = max(score([True, *[bool(m >> k & 1) for k in range(n - 1)]]) for m in range(2 ** (n - 1))
                   if all(page.parent[k + 1] == 0 or not m >> k & 1 or m >> page.parent[k + 1] - 1 & 1 for k in range(n - 1)))
        kept = page.decode(p)
        assert score(kept) == pytest.approx(best)
        assert all(kept[page.parent[k]] or not kept[k] for k in range(1, n))


FULL = """<!doctype html><html><head><title>T &amp; U</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="site-header"><div class="logo">Brand</div><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav></header>
<div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div>
<main><article><h1>Caf&eacute;   &#233;t&#xe9;</h1><p>First <b>bold</b>\n text &lt;tag&gt;.<p>Second&nbsp;one, with <a href="x">a link</a> in it.
<div class="advert">Buy now</div><ul><li>One item here.<li>Another item there.</ul><blockquote><p>A quoted line.</p></blockquote></article></main>
<aside class="sidebar"><h3>Related</h3><a href="/z">Other story</a></aside>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I liked this text a lot, thanks for it.</p></div></section>
<form class="newsletter"><label>Mail</label><input name=m><button>Go</button></form>
<footer><p>&copy; 2024 Brand</p></footer></body></html>"""


def test_parts_of_a_full_page(model):
    want = "Café été\nFirst bold text <tag>.\nSecond one, with a link in it.\nOne item here.\nAnother item there.\nA quoted line."
    assert htmltext.extract_texts([FULL], model) == [want]


@pytest.mark.parametrize("html, text", [
    ("", ""), ("<", "<"), ("<p", "<p"), ("<!-- only", ""), ("<script>x", ""), ("</p></div>", ""),
    ("<article><p>a &am b &ampc &nosuch; &#0; d</p></article>", unescape("a &am b &ampc &nosuch; &#0; d")),
    ("<article><p>a<br>b</article>", "a b"), ("<article><p title='x>y'>a</p><p title=\"unclosed>b</p></article>", None),
])
def test_broken_markup(model, html, text):
    got = htmltext.extract_texts([html], model)[0]
    assert text is None or got == text or (html in ("<", "<p") and got in (text, ""))


def test_deep_and_long_pages(model):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    long = "<article>" + "<p>A sentence of some words that repeats.</p>" * 5000 + "</article>"
    got = htmltext.extract_texts([deep, long], model)
    assert got[1].count("\n") == 4999


def test_awkward_rows_and_empty_table(spark):
    df = awkward(spark).withColumnRenamed("text", "html").withColumnRenamed("source", "url")
    rows = htmltext.extract_main_text(df).collect()
    assert len(rows) == df.count() and all(r.n_chars == len(r.text) for r in rows)
    assert htmltext.extract_main_text(nothing(spark).withColumnRenamed("text", "html")).count() == 0

"""Main text of pages: reading, voting, odd pages."""

from __future__ import annotations

import html
import re

import pytest

from rollbook.llm import pages

SF = "/root/testdata/sf0.01"


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body>{body}</body></html>"


CASES = {
    "plain": ("<p>one</p><p>two &amp; three</p>", "one\ntwo & three"),
    "white space": ("<article><p> a\n\t b&nbsp;c <br>d</p></article>", "a b c d"),
    "unclosed": ("<article><p>one<p><b>two<p>three<ul><li>x<li>y</ul></article><footer>f", "one\ntwo\nthree\nx\ny"),
    "left out": (
        "<nav>n</nav><div class='Side-Bar sidebar'>s</div><main><p>text of the page</p><form>f</form><aside>a</aside>"
        "<div id=comments><p>c</p></div><div role=navigation>r</div><div style='display: none'>h</div><p>more</p></main>",
        "text of the page\nmore",
    ),
    "inline advert": ("<article><p>buy <span class=ad>NOW</span>nothing</p></article>", "buy nothing"),
    "attributes": ("<article><p title='a > b' data-x=\"<p>\">kept</p></article>", "kept"),
    "comment": ("<article><p>a<!-- <p>b</p> --> c</p></article>", "a c"),
    "words in words": ("<article class=shadow><p>adequate header</p></article>", "adequate header"),
    "open end": ("<article><p>a</p><!-- never closed <p>b</p>", "a"),
    "nested": ("<div><div class=post-17><p>long enough text</p><div><p>inner</p></div></div></div>", "long enough text\ninner"),
}


@pytest.mark.parametrize("name", CASES)
def test_reading(name):
    body, text = CASES[name]
    assert pages.main_text(page(body), []) == text


def test_votes_decide():
    own = page("<div class='a-1'><p>the article of this page, short</p></div><div class=b><p>a longer teaser for another page, not wanted</p></div>")
    assert pages.main_text(own, []) == "the article of this page, short\na longer teaser for another page, not wanted"
    assert pages.main_text(own, ["html/body/div.b"]) == "the article of this page, short"
    assert pages.main_text(own, ["html/body/div.none"]).endswith("not wanted")
    assert pages.main_text(own, ["html/body/div.a-#", "html/body/div.b"]).startswith("the article")


def words(n: int, name: str) -> str:
    return " ".join(f"{name}{k}" for k in range(n))


SPLIT = {
    "siblings at the top": "<h1>Head</h1><div class=a><p>{a}</p></div><div class=b><p>{b}</p></div>",
    "siblings in a wrapper": "<div class=post><h1>Head</h1><div class=a><p>{a}</p></div><div class=b><p>{b}</p></div></div>",
    "nested": "<div class=x><h1>Head</h1><div class=a><p>{a}</p><div class=b><p>{b}</p></div></div></div>",
    "a paragraph outside": "<h1>Head</h1><p>{a}</p><div class=b><p>{b}</p></div>",
    "article and more": "<article><h1>Head</h1><p>{a}</p></article><div class=more><p>{b}</p></div>",
    "words of a paragraph": "<article><h1 class=header>Head</h1><p class='related-work'>{a}</p><section class='social-history'><p>{b}</p></section></article>",
}


@pytest.mark.parametrize("share", [60, 90])
@pytest.mark.parametrize("name", SPLIT)
def test_split_articles_keep_every_word(name, share):
    a, b = words(share, "a"), words(200 - share, "b")
    noise = "<nav>menu</nav>{}<div class=links><a href=1>{}</a></div><div class=comments><p>they say</p></div><footer>f</footer>"
    assert pages.main_text(page(noise.format(SPLIT[name].format(a=a, b=b), words(30, "link"))), []) == f"Head\n{a}\n{b}"


def test_a_region_of_one_page_does_not_cut_another(spark):
    """div.text alone is the usual article; a page that goes on in div.more keeps both."""
    rows = [(f"http://v.org/{n}", page(f"<div class=text><p>{words(80, 't')}</p></div>")) for n in range(20)]
    rows.append(("http://v.org/long", page(f"<div class=text><p>{words(45, 't')}</p></div><div class=more><p>{words(55, 'm')}</p></div>")))
    got = pages.extract(spark.createDataFrame(rows, "url string, html string")).filter("url LIKE '%long'").collect()
    assert [r["main_text"] for r in got] == [f"{words(45, 't')}\n{words(55, 'm')}"]


def test_reader_comments_in_an_article_are_left_out():
    body = "<article><p>the text</p><section id=comments><p>they say</p></section><div class='comment-list'><p>and say</p></div></article>"
    assert pages.main_text(page(body), []) == "the text"


def test_hosts_agree(spark):
    article = "<div class=story><p>{}</p></div><div class=teaser><p>{}</p></div>"
    rows = [(n, f"http://www.a.org/{n}", page(article.format("main text " * 30, "teaser"))) for n in range(30)]
    rows += [(n, f"HTTPS://www.A.org/{n}?x", page(article.format("short main text here", "a teaser that is longer " * 2))) for n in range(30, 33)]
    rows += [(40, None, page("<p>x</p>")), (41, "nonsense", None), (42, "http://b.org", ""), (42, "http://b.org", "")]
    frame = spark.createDataFrame([(*r, "kept", 1) for r in rows], "page_id long, url string, html string, winners string, host int")
    got = pages.extract(frame)
    assert got.columns == ["page_id", "url", "winners", "host", "main_text"]
    by_id = {r["page_id"]: r["main_text"] for r in got.collect()}
    assert got.count() == len(rows)
    assert {by_id[n] for n in range(30)} == {("main text " * 30).strip()}
    assert {by_id[n] for n in range(30, 33)} == {"short main text here"}
    assert (by_id[40], by_id[41], by_id[42]) == ("x", "", "")
    assert pages.extract(frame.limit(0)).count() == 0


def test_supplied_pages(spark):
    """The supplied pages keep their article in one element, which a pattern can cut out."""

    def simple(text):
        article = re.search(r"<article>(.*)", text, re.S).group(1).split("</article>")[0].split("<footer")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        return "\n".join(b for b in blocks if b)

    frame = spark.read.parquet(f"{SF}/pages.parquet")
    expected = {r["page_id"]: simple(r["html"]) for r in frame.collect()}
    assert {r["page_id"]: r["main_text"] for r in pages.extract(frame).collect()} == expected


@pytest.mark.parametrize("text", ["<" * 20_000, "<a " * 20_000, "<p \"" * 20_000, "<script " * 20_000, "&" * 50_000, "<div>" * 20_000 + "x"])
def test_broken_pages_take_linear_time(text):
    pages.main_text(text, [])


def test_sections_of_an_article_stay_together():
    body = "<article><h1>head</h1><section class=intro><p>the first part</p></section><section class=body><p>the second and much longer part of it</p></section></article>"
    whole = "head\nthe first part\nthe second and much longer part of it"
    assert pages.main_text(page(body), []) == whole
    assert pages.main_text(page(body), ["html/body/article/section.intro"]) == whole


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "has-sidebar", "no-comments", "page-header-fixed"])
def test_wrappers_of_the_article_stay(name):
    kept = "<p>the text of the article, kept</p>"
    side = "<div class=sidebar><p>side</p></div>"
    assert pages.main_text(page(f"<div class='{name}'><article>{kept}</article>{side}</div>"), []) == "the text of the article, kept"
    assert pages.main_text(page(f"<div id='{name}'><div class=a>{kept}</div>{side}</div>"), []) == "the text of the article, kept"


def test_a_page_of_marked_words_is_not_empty():
    assert pages.main_text(page("<div class=notice>only this</div>"), []) == "only this"


def test_every_template_of_a_host_is_voted(spark):
    template = "<div class=wrap{0}><div class=story{0}><p>{1}</p></div><div class=box{0}><p>{2}</p></div></div>"
    rows = []
    for k in "abcdefghijkl":
        rows += [(f"http://w.org/{k}{n}", page(template.format(k, "main text " * 30, "teaser"))) for n in range(3)]
        rows += [(f"http://w.org/{k}-short", page(template.format(k, "short main text here", "a teaser that is longer " * 2)))]
    got = pages.extract(spark.createDataFrame(rows, "url string, html string")).filter("url LIKE '%-short'").collect()
    assert {r["main_text"] for r in got} == {"short main text here"} and len(got) == 12

import html
import random
import re

import pytest

from regcurate.llm import page_text, queries
from regcurate.llm.page_text import lines, shared_lines

SCHEMA = "page_id long, url string, html string, text string, host string, gone int, digest string"


def _extract(spark, rows):
    df = spark.createDataFrame([(*r, "t", "h", 1, "d") for r in rows], SCHEMA)
    return {r.page_id: r for r in page_text.extract(df.repartition(3)).collect()}


def _lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@pytest.mark.parametrize("bits", [1 << 28, 40, 3])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(page_text, "TABLE_BITS", bits)
    r = random.Random(bits)
    for _ in range(300):
        a = [r.randrange(6) for _ in range(r.randrange(25))]
        b = [r.randrange(6) for _ in range(r.randrange(25))]
        i, j = shared_lines(a, b)
        assert [a[k] for k in i] == [b[k] for k in j] and len(i) == _lcs(a, b)
        assert i == sorted(set(i)) and j == sorted(set(j))


def _page(body, notice="We use cookies. Accept them.", foot="Imprint of the site"):
    return (f"<html><head><title>x</title></head><body><div><p>{notice}</p></div>"
            f"<div>{body}</div><div>{foot}</div></body></html>")


def test_lines_shared_with_the_nearest_page_go(spark):
    rows = [(k, f"http://a.org/news/{k}", _page(f"<p>Story {k}.</p><p>More of {k}.</p>"))
            for k in range(5)]
    rows += [(10, "http://a.org/shop/1", _page("<p>Offer one</p>", notice="Shop rules")),
             (11, "http://a.org/shop/2?x=1", _page("<p>Offer two</p>", notice="Shop rules")),
             (12, "http://b.org/news/1", _page("<p>Story 1.</p>"))]
    got = _extract(spark, rows)
    for k in range(5):
        assert got[k].text == f"Story {k}.\n\nMore of {k}." and got[k].n_deleted == 2
    # paired within their folder, though the news notice differs
    assert got[10].text == "Offer one" and got[11].text == "Offer two"
    # the only page of its host shares nothing
    assert got[12].text.startswith("We use cookies.") and got[12].n_shared == 0


def test_mirrors_do_not_delete_each_other(spark):
    same = _page("<p>Only story.</p>")
    rows = [(1, "http://a.org/x/1", same), (2, "http://a.org/x/1?utm=2", same), (2, "http://a.org/x/1?utm=2", same),
            (3, "http://a.org/x/2", _page("<p>Other story.</p>"))]
    got = _extract(spark, rows)
    assert [got[k].text for k in (1, 2, 3)] == ["Only story.", "Only story.", "Other story."]


def test_articles_keep_shared_passages(spark):
    rows = [(k, f"http://a.org/{k}", "<nav><a>Home</a></nav><article><h1>T</h1><p>Quoted on "
             f"many pages.</p><p>Own {k}.</p></article><div>Read on</div>") for k in range(4)]
    got = _extract(spark, rows)
    for k in range(4):
        assert got[k].text == f"T\n\nQuoted on many pages.\n\nOwn {k}."
        assert (got[k].n_lines, got[k].n_shared, got[k].n_deleted) == (5, 4, 2)


def test_markup():
    page = """<!DOCTYPE html><!-- a > b --><header>Site</header><script>var t="</p>";</script>
    <style>p{}</style><article class="post no-sidebar"><header><h1>Tom &amp; Jer&eacute;my</h1></header>
    <p>One<br>two <b>three</b> &lt;four&gt;<p class="x">A &#8211; B</p>
    <div class="adBox">Buy</div><aside>Side</aside><table><tr><td>a</td><td>b</td></tr></table>
    <form>Your <input name=q> name</form><ul><li>i<li>ii</ul><span class=ad-slot>Ad</span> tail
    <section id="comments"><article>Reader: nice</article></section></article>
    <div role="contentinfo">Foot</div><p>2 < 3 & 5"""
    found = [t for t, marked, inside in lines(page) if inside and not marked]
    assert found == ["Tom & Jerémy", "One two three <four>", "A – B", "a b", "i", "ii",
                     "tail"]
    assert [t for t, marked, inside in lines(page) if not inside and not marked] == ["2 < 3 & 5"]


def test_broken_empty_and_long_pages(spark):
    words = "word " * 200_000
    rows = [(1, None, None), (2, "no url", ""), (3, "http://a.org/", "<article><p>cut off &am"),
            (4, "http://a.org/1", f"<article>{words}</article>"), (5, None, "<p <p> x"),
            (6, "http://a.org/2", "<article>" + "".join(f"<p>{k}" for k in range(30_000))),
            (7, "http://a.org/3", "".join(f"<p>{k}" for k in range(29_999, -1, -1))),
            (8, "http://[::1]/", "<script>never closed <p>x"), (None, "http://c.org", "<p>y")]
    got = _extract(spark, rows)
    assert got[1].text == got[2].text == got[8].text == "" and got[1].url is None
    assert got[3].text == "cut off &am"
    assert got[4].text == words.strip()
    assert got[6].text.count("\n\n") == 29_999
    assert got[7].n_deleted == 1 and got[None].text == "y"
    df = spark.createDataFrame([], SCHEMA)
    assert page_text.extract(df).collect() == []


def test_query_gives_every_article_whole(spark):
    """Every page of the table marks its article: its blocks, read plainly."""
    sf = "/root/testdata/sf0.01"
    pages = queries.table(spark, sf, "pages").collect()
    got = {r.page_id: r for r in queries.op12_page_text(spark, sf).collect()}
    assert len(got) == len(pages)
    for p in pages:
        body = p.html.split("<article>", 1)[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split())
                  for x in re.split("</?(?:p|h1)>", body)]
        want = "\n\n".join(x for x in blocks if x)
        assert (got[p.page_id].text, got[p.page_id].n_chars) == (want, len(want))

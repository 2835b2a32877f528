import csv
import os
from pathlib import Path

import pytest

from loomwire.functions import web as H
from loomwire.plans.products import product_report
from loomwire.sources import listings as L
from loomwire.sources.feeds import article_rows, read_items, with_feed_order
from loomwire.streaming.feeds import poll_feeds

BASE = "https://shop.example.com"
RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:media="http://search.yahoo.com/mrss/"><channel><title>c</title>
<item><title>One &amp; only</title><link>http://a/1</link><description><![CDATA[<p>Fur <img src="/i.png"></p>]]></description></item>
<item><title>Two</title><link>http://a/2</link><summary>s2</summary><description>d2</description>
<media:content url="http://m/2.jpg"/><media:content url="http://m/3.jpg"/></item>
<item><title>No link</title><description>x</description></item>
<item><title>No link</title><description>x</description></item></channel></rss>"""
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>f</title>
<entry><title>Again</title><link rel="self" href="http://no"/><link href="http://a/1"/><summary>later copy</summary></entry>
<entry><title>Three</title><link href="http://a/3"/><content type="html">&lt;b&gt;bold&lt;/b&gt; text</content></entry></feed>"""


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column).first()[0]


@pytest.fixture()
def landed(tmp_path):
    (tmp_path / "feeds").mkdir()
    (tmp_path / "feeds" / "a.xml").write_text(RSS)
    (tmp_path / "feeds" / "b.xml").write_text(ATOM)
    (tmp_path / "feeds" / "broken.xml").write_text("<rss><item><title>x")
    return tmp_path


@pytest.fixture()
def seed(spark):
    return spark.createDataFrame([(0, "fit", "FUR"), (1, "fit", "text")], "ord int, category string, keyword string")


def test_feeds_to_articles(spark, landed, seed):
    feeds = spark.createDataFrame([("b.xml", 2), ("a.xml", 1)], "feed string, feed_ord int")
    rows = article_rows(with_feed_order(read_items(spark, str(landed / "feeds")), feeds), seed).collect()
    got = {r["title"]: r for r in rows}
    assert sorted(got) == ["No link", "One & only", "Three", "Two"] and len(rows) == 4
    assert got["One & only"]["summary"] == "Fur" and got["One & only"]["image_url"] == "/i.png"
    assert got["One & only"]["matched_keywords"] == ["FUR"]
    assert (got["Two"]["summary"], got["Two"]["image_url"]) == ("s2", "http://m/2.jpg")
    assert (got["Three"]["summary"], got["Three"]["link"]) == ("bold  text", "http://a/3")  # two text nodes


def test_polling_takes_each_document_once(spark, landed, seed):
    table, state = str(landed / "articles"), str(landed / "state")

    def poll():
        poll_feeds(spark, str(landed / "feeds"), table, state, seed).awaitTermination()
        return sorted(r["title"] for r in spark.read.parquet(table).collect())

    assert poll() == ["No link", "One & only", "Three", "Two"]
    (landed / "feeds" / "c.xml").write_text(RSS.replace("http://a/2", "http://a/9").replace("Two", "Nine"))
    assert poll() == ["Nine", "No link", "One & only", "Three", "Two"] == poll()
    # a new checkpoint on the old table overwrites nothing and stores nothing twice
    state = str(landed / "state2")
    assert poll() == ["Nine", "No link", "One & only", "Three", "Two"]
    assert spark.read.parquet(table).count() == 5


@pytest.mark.parametrize("html, url", [
    ('<link rel="next" href="/n?page=2"><a aria-label="next" href="/x">n</a>', "/n?page=2"),
    ('<a aria-label="Go NEXT" href="/x">n</a><a href="/y">Next</a>', "/x"),
    ('<a aria-label="next">n</a><a href="/y"><b> NEXT </b></a>', "/y"),
    ('<a href="/p?page=2">2</a><a href="/p?page=3">See <i>next</i></a>', "/p?page=3"),
    ('<a href="/p?page=2">2</a>', None), (None, None)])
def test_next_page(spark, html, url):
    assert one(spark, html, H.next_page("x", BASE)) == (url and BASE + url)


@pytest.mark.parametrize("html, title, designer", [
    ('<meta property="og:title" content="A &amp; B"><h1>c</h1><a href="/designers/x">Maison</a>', "A & B", "Maison"),
    ("<h1> Big <b>dress</b></h1><a href='/brand/x'><i>In</i> <i>two</i></a><p>All Erdem</p>", "Bigdress", "Erdem"),
    ('<a href="/w">Women</a><a href="/w">see all of it now</a><a href="/z"> The  Row </a>', "", "The  Row"),
    ("", "", ""), (None, "", "")])
def test_product_page(spark, html, title, designer):
    assert one(spark, html, H.page_title("x")) == title
    assert one(spark, html, H.page_designer("x")) == designer


@pytest.mark.parametrize("card, title, designer", [
    ('<a title=" T "><img alt="i">x</a>', "T", None), ('<a><img alt="i">preorder Erdem</a>', "i", "Erdem"),
    ("<a>only 12 left Adam Lippes</a>", "only 12 left Adam Lippes", "Adam Lippes"),
    ("<a>Erdem Long Midi Dress</a>", "Erdem Long Midi Dress", "Erdem Long Midi"), ("<a></a>", None, None)])
def test_cards(spark, card, title, designer):
    assert (one(spark, card, H.card_title("x")), one(spark, card, H.card_designer("x"))) == (title, designer)


@pytest.mark.parametrize("read", [L.product_cards, L.nested_product_cards])
def test_product_cards(spark, read):
    html = ('<a data-component="Other" href="/no">n</a><a href="/p/1" data-component="ProductCardLink">'
            '<p class="b" data-component="ProductCardBrandName"> Chlo&eacute; </p>'
            "<div data-component='ProductCardDescription'>silk <b>dress</b></div></a>"
            '<a data-component="ProductCardLink"><p>x</p></a>')
    got = read(spark.createDataFrame([(1, html), (2, None)], "id int, html string"), "id", "html", BASE).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, BASE + "/p/1", "Chloé", "silkdress"), (1, 1, "", "", "")]


def test_nested_markup_needs_the_parser(spark):
    html = ('<a data-component="ProductCardLink" href="x"><div data-component="ProductCardBrandName">'
            "<div>The</div>Row</div><br></a>")
    page = spark.createDataFrame([(1, html)], "id int, html string")
    assert L.nested_product_cards(page, "id", "html", BASE).first()["designer"] == "TheRow"


@pytest.mark.parametrize("html, cards", [
    # unclosed paragraphs, a stray end tag, and links without end
    ('<a data-component="ProductCardLink" href="1"><p data-component="ProductCardBrandName">A<p data-component="ProductCardDescription">t1'
     '</a><a data-component="ProductCardLink" href="2"><p data-component="ProductCardBrandName">B</div></p>x</a>',
     [("A", "t1"), ("B", "")]),
    ('<div><a data-component="ProductCardLink"><b data-component="ProductCardBrandName">A</b>'
     '<a data-component="ProductCardLink"><i data-component="ProductCardDescription">t</i></div><p>z</p>', [("A", ""), ("", "t")]),
    ('</a></p><a href="x">no</a><a data-component="ProductCardLink"><div><div data-component="ProductCardBrandName"><div>In</div>ner'
     '</div>out</div></a>late', [("Inner", "")])])
def test_cards_in_untidy_markup(spark, html, cards):
    page = spark.createDataFrame([(1, html)], "id int, html string")
    got = L.nested_product_cards(page, "id", "html", BASE).orderBy("card_ord").collect()
    assert [(r["designer"], r["title"]) for r in got] == cards


def test_listing_links(spark):
    html = '<a href="/women/p/a/1">1</a><a href="/women/p/a/1">1</a><a href="/men/p/2">2</a><a name="x">3</a>'
    pages = spark.createDataFrame([(html,), (html,)], "html string")
    assert [r["url"] for r in L.listing_links(pages, "html", BASE).collect()] == [BASE + "/women/p/a/1"]


def test_report_with_gaps(spark):
    rows = [(0, "u0", "", "Lace dress"), (1, "u1", "B", None), (2, "u1", "B", "lace DRESS new")]
    df = spark.createDataFrame(rows, "n int, url string, designer string, title string")
    got = [tuple(r)[2:] for r in product_report(df, "n").orderBy("section_ord", "rank").collect()]
    assert got == [("summary", "total_items", "3"), ("top_words", "lace", "2"), ("top_words", "dress", "2"),
                   ("top_bigrams", "lace dress", "2"), ("top_designers", "B", "2"), ("items", " | Lace dress", "u0"),
                   ("items", "B | ", "u1"), ("items", "B | lace DRESS new", "u1")]
    assert L.first_products(df, "n", 2).count() == 2 and L.first_products(df, "n").count() == 3


def _golden(header):
    """CSV files below $GOLDEN_DIR with a header; published results to compare with."""
    for file in sorted(Path(os.environ.get("GOLDEN_DIR", "/nowhere")).rglob("*.csv")):
        with open(file, newline="", encoding="utf-8") as text:
            if next(csv.reader(text))[:len(header)] == header:
                yield file


@pytest.mark.skipif("GOLDEN_DIR" not in os.environ, reason="no published results at hand")
def test_published_reports(spark):
    files = list(_golden(["section", "metric", "value"]))
    assert files
    for file in files:
        with open(file, newline="", encoding="utf-8") as text:
            expected = [tuple(r) for r in csv.reader(text)][1:]
        items = [r for r in expected if r[0] == "items"]
        rows = [(i, url, *metric.split(" | ", 1)) for i, (_, metric, url) in enumerate(items)]
        df = spark.createDataFrame(rows, "n int, url string, designer string, title string")
        got = [tuple(r)[2:] for r in product_report(df, "n").orderBy("section_ord", "rank").collect()]
        assert got == expected


@pytest.mark.skipif("GOLDEN_DIR" not in os.environ, reason="no published results at hand")
def test_published_trend_scores(spark):
    from loomwire.operators.weeks import with_metrics
    from loomwire.plans.trend import with_previous, with_scores
    from loomwire.sources.files import read_csv
    from loomwire.schemas import TREND_SCORES
    tables = []
    for file in _golden([f.name for f in TREND_SCORES][:3]):
        published = read_csv(spark, str(file), TREND_SCORES)
        counts = published.select("topic", "mentions_this_week", "mentions_prev_week", "source_count")
        got = {r["topic"]: r for r in with_scores(with_metrics(counts)).collect()}
        rows = published.collect()
        assert len(rows) == len(got) and [r["topic"] for r in rows] == sorted(got)
        for row in rows:
            for name in ("velocity", "recency", "velocity_norm", "recency_norm", "source_norm", "trend_score"):
                assert abs(got[row["topic"]][name] - row[name]) < 1e-9
        tables.append(published.select("topic", "trend_score"))
    deltas = {r["topic"]: r["score_delta"] for r in with_previous(tables[1], tables[0]).collect()}
    assert None not in deltas.values() and abs(deltas["-1"] - (6.757764507044237 - 7.455783851392363)) < 1e-9

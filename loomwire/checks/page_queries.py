"""Queries over landed pages and products with their SQL.

The test pages have neither product cards, images nor page links. Queries on those take all pages and
put the page's own url, host and title into such markup first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import web as H
from ..functions.stopwords import PRODUCT
from ..functions.text import decode_entities, html_to_text
from ..operators import counts as C
from ..operators.crawl import crawl_positions
from ..plans.products import product_report, with_tokens
from ..session import written
from ..sources import listings as L
from ..sources.feeds import summary_choice
from . import views as V
from .views import SHOP, SQL_PRODUCTS, sql_strip, sql_text, sql_tokens_regex, sql_unescape, sql_words

LINK_PATTERN = "^/[A-Z]"


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return V.pages(spark, d)


def _c(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])



def _id() -> Column:
    return F.col("page_id").cast("string")


def _host() -> Column:
    return F.regexp_extract("url", r"([^./]+)\.example\.", 1)


def feed_items(spark: SparkSession, d: str) -> DataFrame:
    body = F.try_element_at(H.elements("html", "article"), F.lit(1))
    title = decode_entities(V.title_of("html"))
    return _pages(spark, d).select("page_id", title.alias("title"), html_to_text(
        summary_choice(F.lit(""), body)).alias("summary"), F.col("url").alias("link"))


def product_cards(spark: SparkSession, d: str, nested: bool = False) -> DataFrame:
    inner = _c("<b>", _host(), "</b>") if nested else _host()
    card = _c('<a class="card" data-component="ProductCardLink" href="/p/', _id(),
              '"><div><p data-component="ProductCardBrandName">', inner,
              '</p></div><p data-component="ProductCardDescription">', V.title_of("html"), "</p></a>")
    listing = _pages(spark, d).select("page_id", _c("<body>", card, F.col("html")).alias("html"))
    read = L.nested_product_cards if nested else L.product_cards
    return read(listing, "page_id", "html", SHOP)


def first_image(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("page_id")
    media = F.when(n % 4 == 0, F.array(_c("https://media.example.com/", _id())))
    image = F.when(n % 3 == 0, _c("<IMG alt='x > y' src='/i/", _id(), ".png'/>")).otherwise("")
    page = _pages(spark, d).select("page_id", media.alias("media"), _c(F.col("html"), image).alias("html"))
    return page.select("page_id", H.first_image("html", "media").alias("image_url"))


def absolute_urls(spark: SparkSession, d: str) -> DataFrame:
    hrefs = F.array(F.lit(""), _c("/p/", _id()), F.col("url"), _c("//cdn.example.com/", _id()), _c("?page=", _id()),
                    _c("item/", _id()))
    rows = _pages(spark, d).select("page_id", F.explode(hrefs).alias("href"))
    return rows.select("page_id", "href", H.absolute_url("href", "https://shop.example.com/new/list?x=1").alias("url"))


def next_page(spark: SparkSession, d: str) -> DataFrame:
    kind = F.col("page_id") % 5
    link = (F.when(kind == 0, _c('<link rel="next" href="/new?page=', _id(), '"/>'))
            .when(kind == 1, _c('<a aria-label="Next page" href="/new?page=', _id(), '">&gt;</a>'))
            .when(kind == 2, _c('<a href="/new?p=', _id(), '"> Next </a>'))
            .when(kind == 3, _c('<a href="/new?page=7">7</a><a href="/new?page=', _id(), '"><i>go</i> to next</a>'))
            .otherwise(""))
    return _pages(spark, d).select("page_id", H.next_page(_c(F.col("html"), link), SHOP).alias("next_url"))


def page_titles(spark: SparkSession, d: str) -> DataFrame:
    meta = F.when(F.col("page_id") % 3 == 0, _c('<meta content="', _host(), '" property="og:title">')).otherwise("")
    return _pages(spark, d).select("page_id", H.page_title(_c(meta, F.col("html"))).alias("title"))


def page_designers(spark: SparkSession, d: str) -> DataFrame:
    extra = (F.when(F.col("page_id") % 3 == 0, _c('<a class="x" href="/designers/', _id(), '"> Maison ', _host(), " </a>"))
             .when(F.col("page_id") % 3 == 1, _c("<p>All  Studio X", _id(), "</p>")).otherwise(""))
    return _pages(spark, d).select("page_id", H.page_designer(_c(extra, F.col("html"))).alias("designer"))


def _cards(spark: SparkSession, d: str) -> DataFrame:
    kind, title = F.col("page_id") % 4, V.title_of("html")
    card = (F.when(kind == 0, _c('<a href="/x" title=" ', _id(), ' "><img alt="y"></a>'))
            .when(kind == 1, _c('<a href="/x"><img src="z" alt="', _host(), '"> preorder Studio ', "X</a>"))
            .when(kind == 2, _c("<a><p>only 3 left </p><b>Maison A</b></a>"))
            .otherwise(_c("<a><p>", title, "</p></a>")))
    return _pages(spark, d).select("page_id", card.alias("card"))


def _with_rank(top: DataFrame) -> DataFrame:
    rank = F.row_number().over(Window.orderBy(F.desc("count"), "first_seen"))
    return top.select(rank.alias("rank"), "term", "count")


def crawl_order(spark: SparkSession, d: str) -> DataFrame:
    """Walks of next links from every page that no other page links to, with each page's first step.

    The links are written into the pages: page n links to page n + 1, the last of every fifty back to twenty pages
    before, so walks end in cycles; the next-page reader finds them in the markup again.
    """
    pages = _pages(spark, d)
    target = F.when(F.col("page_id") % 50 == 49, F.col("page_id") - 20).otherwise(F.col("page_id") + 1)
    urls = pages.select(F.col("page_id").alias("_t"), F.col("url").alias("_t_url"))
    marked = pages.withColumn("_t", target).join(urls, "_t", "left").select(
        "url", _c(F.coalesce("html", F.lit("")), '<a aria-label="next" href="', F.coalesce("_t_url", F.lit("")),
                  '">Next</a>').alias("html"))
    # read three times below, so texts are moved and parsed once
    links = written(marked.select(F.col("url").alias("page"), H.next_page("html", "url").alias("next")))
    starts = links.select(F.col("page").alias("start")).join(
        links.select(F.col("next").alias("start")), "start", "left_anti")
    return crawl_positions(links, starts).select("start", "page", F.col("position").cast("long").alias("position"))


QUERIES = {
    "crawl_order": crawl_order,
    "feed_items": feed_items,
    "html_to_text": lambda s, d: _pages(s, d).select("page_id", html_to_text("html").alias("text")),
    "listing_links": lambda s, d: L.listing_links(_pages(s, d), "html", SHOP, LINK_PATTERN),
    "product_cards": product_cards,
    "nested_product_cards": lambda s, d: product_cards(s, d, nested=True),
    "first_image": first_image,
    "absolute_url": absolute_urls,
    "next_page": next_page,
    "page_title": page_titles,
    "page_designer": page_designers,
    "card_title": lambda s, d: _cards(s, d).select("page_id", H.card_title("card").alias("title")),
    "card_designer": lambda s, d: _cards(s, d).select("page_id", H.card_designer("card").alias("designer")),
    "designer_counts": lambda s, d: C.value_counts(V.products(s, d), "designer"),
    "topk_designers": lambda s, d: _with_rank(C.top_k(C.value_counts(V.products(s, d), "designer", "page_id"), 10)),
    "product_words": lambda s, d: C.term_counts(with_tokens(V.products(s, d)), "tokens"),
    "total_items": lambda s, d: V.products(s, d).agg(F.count(F.lit(1)).alias("total_items")),
    "product_report": lambda s, d: product_report(V.products(s, d), "page_id"),
}

_HREF = r"""regexp_extract_all(html, '<a\s[^>]*href="([^"]*)"[^>]*>', 1)"""
_TITLE = "regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"
_HOST = r"regexp_extract(url, '([^./]+)\.example\.', 1)"
_H1 = sql_strip(sql_unescape("regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1)"))
_PRODUCTS = f"WITH {SQL_PRODUCTS}, {sql_words(sql_tokens_regex('title', PRODUCT, 3), 'page_id', 'products')}"


def _top(source: str, section: int, name: str, n: int) -> str:
    order = "count(*) DESC, min(page_id * 33554432 + pos)"
    return f"""SELECT {section}, row_number() OVER (ORDER BY {order}), '{name}', term, CAST(count(*) AS VARCHAR)
FROM {source} WHERE term IS NOT NULL AND term <> '' GROUP BY term ORDER BY {order} LIMIT {n}"""


_NEXT = f"""CASE page_id % 5 WHEN 2 THEN '{SHOP}/new?p=' || page_id WHEN 4 THEN NULL
  ELSE '{SHOP}/new?page=' || page_id END"""

ORACLES = {
    "crawl_order": """WITH RECURSIVE t AS (SELECT p.url AS page, q.url AS nxt FROM pages p LEFT JOIN pages q
  ON q.page_id = CASE WHEN p.page_id % 50 = 49 THEN p.page_id - 20 ELSE p.page_id + 1 END),
links AS (SELECT page, min(nxt) AS nxt FROM t WHERE page IS NOT NULL GROUP BY page),
jump AS (SELECT page, nxt FROM links WHERE nxt IN (SELECT page FROM links) AND nxt <> page),
starts AS (SELECT page AS start FROM links WHERE page NOT IN (SELECT nxt FROM links WHERE nxt IS NOT NULL)),
walk(start, page, step, path) AS (SELECT start, start, 0, [start] FROM starts
  UNION ALL SELECT w.start, j.nxt, w.step + 1, list_append(w.path, j.nxt) FROM walk w JOIN jump j ON j.page = w.page
  WHERE NOT list_contains(w.path, j.nxt))
SELECT start, page, CAST(min(step) AS BIGINT) AS position FROM walk GROUP BY start, page""",
    "feed_items": f"""SELECT page_id, {sql_unescape(_TITLE)} AS title,
  {sql_text("regexp_extract(html, '(?is)<article>.*?</article>')")} AS summary, url AS link FROM pages""",
    "html_to_text": f"SELECT page_id, {sql_text('html')} AS text FROM pages",
    "listing_links": f"""SELECT DISTINCT '{SHOP}' || {sql_unescape('h')} AS url
FROM (SELECT unnest({_HREF}) AS h FROM pages) WHERE regexp_matches(h, '{LINK_PATTERN}')""",
    "product_cards": f"""SELECT page_id, 0 AS card_ord, '{SHOP}/p/' || page_id AS url, {_HOST} AS designer,
  {sql_strip(sql_unescape(_TITLE))} AS title FROM pages""",
    "nested_product_cards": f"""SELECT page_id, 0 AS card_ord, '{SHOP}/p/' || page_id AS url, {_HOST} AS designer,
  {sql_strip(sql_unescape(_TITLE))} AS title FROM pages""",
    "first_image": """SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'https://media.example.com/' || page_id
  WHEN page_id % 3 = 0 THEN '/i/' || page_id || '.png' ELSE '' END AS image_url FROM pages""",
    "absolute_url": f"""SELECT page_id, unnest(['', '/p/' || page_id, url, '//cdn.example.com/' || page_id,
    '?page=' || page_id, 'item/' || page_id]) AS href,
  unnest(['', '{SHOP}/p/' || page_id, url, 'https://cdn.example.com/' || page_id,
    '{SHOP}/new/list?page=' || page_id, '{SHOP}/new/item/' || page_id]) AS url FROM pages""",
    "next_page": f"SELECT page_id, {_NEXT} AS next_url FROM pages",
    "page_title": f"SELECT page_id, CASE WHEN page_id % 3 = 0 THEN {_HOST} ELSE {_H1} END AS title FROM pages",
    "page_designer": r"""WITH anchors AS (
  SELECT page_id, html, list_filter(list_transform(regexp_extract_all(html, '(?is)<a\s[^>]*>([^<]*)</a>', 1), lambda a: """
    + sql_strip(sql_unescape("a")) + r"""), lambda t: regexp_matches(t, '^\p{Lu}') AND len(regexp_split_to_array(t, '\s+')) <= 4)
    AS texts FROM pages)
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'Maison ' || """ + _HOST.replace("url", "p.url") + r"""
  ELSE coalesce(nullif(trim(CASE WHEN page_id % 3 = 1 THEN 'Studio X' ELSE
    regexp_extract(a.html, 'All\s+([A-Z][A-Za-z &''().-]{1,60})', 1) END), ''), a.texts[1], '') END AS designer
FROM anchors a JOIN pages p USING (page_id)""",
    "card_title": f"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN CAST(page_id AS VARCHAR) WHEN 1 THEN {_HOST}
  WHEN 2 THEN 'only 3 left Maison A' ELSE nullif({sql_strip(sql_unescape(_TITLE))}, '') END AS title FROM pages""",
    "card_designer": rf"""WITH cards AS (SELECT page_id, {sql_strip(sql_unescape(_TITLE))} AS t FROM pages),
words AS (SELECT *, regexp_split_to_array(t, '\s+') AS w, regexp_extract(t,
    '(?:preorder|only\s+\d+\s+left)\s+([A-Z][A-Za-z &''().-]{{1,60}})', 1) AS announced FROM cards)
SELECT page_id, CASE page_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Studio X' WHEN 2 THEN 'Maison A'
  ELSE coalesce(nullif(announced, ''), CASE WHEN length(w[1]) > 1
    AND regexp_matches(w[1], '^[^\p{{L}}]*(\p{{Lu}}\p{{Ll}}*([^\p{{L}}]+|$))+$')
    THEN array_to_string(w[1:3], ' ') END) END AS designer FROM words""",
    "designer_counts": f"""WITH {SQL_PRODUCTS} SELECT designer AS term, count(*) AS count FROM products
WHERE designer <> '' GROUP BY designer""",
    "topk_designers": f"""WITH {SQL_PRODUCTS} SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, min(page_id)) AS INTEGER)
  AS rank, designer AS term, count(*) AS count FROM products WHERE designer <> '' GROUP BY designer
ORDER BY count DESC, min(page_id) LIMIT 10""",
    "product_words": f"{_PRODUCTS} SELECT term, count(*) AS count FROM words GROUP BY term",
    "total_items": "SELECT count(*) AS total_items FROM pages",
    "product_report": f"""{_PRODUCTS},
pairs AS (SELECT page_id, pos, term || ' ' || lead(term) OVER (PARTITION BY page_id ORDER BY pos) AS term FROM words),
designers AS (SELECT page_id, 0 AS pos, designer AS term FROM products)
SELECT 0 AS section_ord, 1::BIGINT AS rank, 'summary' AS section, 'total_items' AS metric,
  CAST(count(*) AS VARCHAR) AS value FROM products
UNION ALL ({_top('words', 1, 'top_words', 20)})
UNION ALL ({_top('pairs', 2, 'top_bigrams', 20)})
UNION ALL ({_top('designers', 3, 'top_designers', 10)})
UNION ALL SELECT 4, page_id, 'items', designer || ' | ' || title, url FROM products""",
}

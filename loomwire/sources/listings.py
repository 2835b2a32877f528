"""Landed shop pages: product links, product cards, product pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import _col
from ..functions.web import absolute_url, attribute, elements, glued_text, opening, page_designer, page_title

# How product links and the parts of a product card are marked.
PRODUCT_PATH = "^/women/p/"
CARD, CARD_DESIGNER, CARD_TITLE = "ProductCardLink", "ProductCardBrandName", "ProductCardDescription"


def listing_links(pages: DataFrame, html: str, base: Column | str, pattern: str = PRODUCT_PATH) -> DataFrame:
    """(url): distinct absolute addresses of links whose reference matches the pattern."""
    href = F.transform(elements(html, "a"), lambda a: attribute(opening(a), "href"))
    return (pages.select(F.explode(F.filter(href, lambda h: h.rlike(pattern))).alias("_href"),
                         (F.lit(base) if isinstance(base, str) else base).alias("_base"))
            .select(absolute_url("_href", F.col("_base")).alias("url")).distinct())


def _part(card: Column, name: str) -> Column:
    """Text of the first element inside a card which carries a component name."""
    pattern = (rf"""(?is)<(\w+)\b[^>]*\sdata-component\s*=\s*["']{name}["'][^>]*>.*?</\1\s*>""")
    return glued_text(F.regexp_extract(card, pattern, 0))


def product_cards(pages: DataFrame, key: str, html: str, base: str) -> DataFrame:
    """(key, card_ord, url, designer, title) of the product cards of listing pages; a missing part is ''.

    For markup in which an element holds further elements of its own name use ``nested_product_cards``.
    """
    cards = F.filter(elements(html, "a"), lambda a: attribute(opening(a), "data-component") == CARD)
    return (pages.select(key, F.posexplode(cards).alias("card_ord", "_card"))
            .select(key, "card_ord", absolute_url(attribute(opening(F.col("_card")), "href"), base).alias("url"),
                    _part(F.col("_card"), CARD_DESIGNER).alias("designer"),
                    _part(F.col("_card"), CARD_TITLE).alias("title")))


class _CardReader(HTMLParser):
    """Collects the cards of one page. Elements may lack their end tag, and end tags their element: an end tag closes the
    innermost open element of its name and all inside it; without such an element it is ignored. A card ends with its
    link, or where another link begins, since links do not nest."""

    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self) -> None:
        super().__init__()
        self.cards: list[dict[str, str]] = []
        self.open: list[str] = []  # names of open elements
        self.card, self.part_at, self.part, self.seen = None, None, "", set()

    def _close(self, depth: int) -> None:
        del self.open[depth:]
        if self.part_at is not None and self.part_at >= depth:
            self.part_at = None
        if self.card is not None and self.card >= depth:
            self.card = self.part_at = None

    def handle_starttag(self, tag, attrs):
        if tag in self.VOID:
            return
        if tag == "a" and self.card is not None:
            self._close(self.card)
        attrs = dict(attrs)
        name = attrs.get("data-component")
        if tag == "a" and name == CARD:
            self.cards.append({"href": attrs.get("href") or "", "designer": "", "title": ""})
            self.card, self.seen = len(self.open), set()
        part = {CARD_DESIGNER: "designer", CARD_TITLE: "title"}.get(name)
        if self.card is not None and part and part not in self.seen:
            # parts do not nest: an open one lacks its end tag
            self.part_at, self.part = len(self.open), part
            self.seen.add(part)
        self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in self.open:
            self._close(len(self.open) - 1 - self.open[::-1].index(tag))

    def handle_data(self, data):
        if self.part_at is not None:
            self.cards[-1][self.part] += data.strip()


def nested_product_cards(pages: DataFrame, key: str, html: str, base: str) -> DataFrame:
    """Like ``product_cards`` by a real parser, in Arrow batches."""
    @F.pandas_udf("array<struct<href string, designer string, title string>>")
    def read(pages_html: pd.Series) -> pd.Series:
        out = []
        for text in pages_html:
            reader = _CardReader()
            reader.feed(text or "")
            reader.close()
            out.append(reader.cards)
        return pd.Series(out)

    return (pages.select(key, F.posexplode(read(_col(html))).alias("card_ord", "_card"))
            .select(key, "card_ord", absolute_url("_card.href", base).alias("url"), "_card.designer", "_card.title"))


def product_pages(pages: DataFrame, url: str, html: str, keep: list[str] | None = None) -> DataFrame:
    """(keep..., url, designer, title) of product detail pages."""
    return pages.select(*(keep or []), F.col(url).alias("url"), page_designer(html).alias("designer"),
                        page_title(html).alias("title"))


def first_products(products: DataFrame, order: str, max_products: int | None = None) -> DataFrame:
    """The first products in listing order, or all of them."""
    return products if max_products is None else products.orderBy(order).limit(max_products)

"""Columns over links and landed HTML: keys, hosts, page fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .text import TAG, _col, decode_entities, let, or_empty, strip_space

# Menu entries which are never a designer's name.
MENU_WORDS = ("women", "clothing", "dresses", "shoes", "bags", "accessories", "sale")


_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*:"


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def dedupe_key(link: Column | str = "link", title: Column | str = "title",
               summary: Column | str = "summary") -> Column:
    """The link, or the SHA-1 of title and summary when there is none."""
    link = or_empty(link)
    return F.when(link != "", link).otherwise(F.sha1(F.concat(or_empty(title), or_empty(summary))))


def source_host(link: Column | str = "link") -> Column:
    """Lower-cased network location with port and user, every ``www.`` removed; no link gives ''."""
    location = F.regexp_extract(or_empty(link), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.replace(F.lower(location), F.lit("www."), F.lit(""))


def absolute_url(href: Column | str, base: Column | str) -> Column:
    """Resolve a reference against a base URL; no reference gives ''."""
    base = F.lit(base) if isinstance(base, str) else base
    scheme = F.regexp_extract(base, rf"^({_SCHEME})", 1)
    origin = F.regexp_extract(base, rf"^({_SCHEME}//[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    whole = F.regexp_extract(base, r"^([^#]*)", 1)
    folder = F.concat(F.regexp_replace(F.regexp_extract(base, rf"^({_SCHEME}//[^/?#]*(?:/[^?#]*/)?)", 1), "/+$", ""),
                      F.lit("/"))

    def resolved(href: Column) -> Column:
        return (F.when(href == "", F.lit(""))
                .when(href.rlike(f"^{_SCHEME}"), href)
                .when(href.startswith("//"), F.concat(scheme, href))
                .when(href.startswith("/"), F.concat(origin, href))
                .when(href.startswith("?"), F.concat(page, href))
                .when(href.startswith("#"), F.concat(whole, href))
                .otherwise(F.concat(folder, href)))

    return let(strip_space(or_empty(href)), resolved)


def attribute(tag: Column, name: str) -> Column:
    """An attribute of one opening tag, quoted either way or bare; absent gives ''."""
    value = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
    pattern = rf"(?is)^<[a-z][^\s/>]*(?:\s+[^\s=>]+(?:\s*=\s*{value.replace('(', '(?:', 1)})?)*?\s+{name}\s*=\s*{value}"
    return decode_entities(F.regexp_replace(F.regexp_extract(tag, pattern, 1), r"""^["']|["']$""", ""))


def tags(html: Column | str, name: str) -> Column:
    """All opening tags of one element name."""
    pattern = rf"""(?is)<{name}\b(?:[^'">]++|"[^"]*+"|'[^']*+')*+>"""
    return F.regexp_extract_all(or_empty(html), F.lit(pattern), F.lit(0))


def elements(html: Column | str, name: str) -> Column:
    """All elements of one name with what they hold (elements of that name do not nest)."""
    pattern = rf"""(?is)<{name}\b(?:[^'">]++|"[^"]*+"|'[^']*+')*+>.*?</{name}\s*>"""
    return F.regexp_extract_all(or_empty(html), F.lit(pattern), F.lit(0))


def opening(element: Column) -> Column:
    return F.regexp_extract(element, r"""(?is)^(<(?:[^'">]++|"[^"]*+"|'[^']*+')*+>)""", 1)


def first_image(summary: Column | str, media_urls: Column | str | None = None) -> Column:
    """The first media entry's address, else the first ``<img>`` source in the summary, else ''."""
    image = attribute(F.coalesce(F.try_element_at(tags(summary, "img"), F.lit(1)), F.lit("")), "src")
    if media_urls is None:
        return image
    return F.coalesce(_filled(F.try_element_at(_col(media_urls), F.lit(1))), image)


def page_title(html: Column | str) -> Column:
    """``og:title``, else the first heading's text, else ''."""
    metas = F.filter(tags(html, "meta"), lambda t: attribute(t, "property") == "og:title")
    og = strip_space(attribute(F.coalesce(F.try_element_at(metas, F.lit(1)), F.lit("")), "content"))
    heading = F.coalesce(F.try_element_at(elements(html, "h1"), F.lit(1)), F.lit(""))
    return F.coalesce(_filled(og), glued_text(heading))


def _text_nodes(element: Column) -> Column:
    marked = F.regexp_replace(element, rf"(?is)<!--.*?-->|{TAG}", "\x01")
    return F.transform(F.split(marked, "\x01"), lambda n: strip_space(decode_entities(n)))


def glued_text(element: Column) -> Column:
    """Text nodes, each trimmed, joined without a separator."""
    return F.array_join(_text_nodes(element), "")


def spaced_text(element: Column) -> Column:
    """Text nodes, each trimmed, the empty ones left out, joined by one blank."""
    return F.array_join(F.array_remove(_text_nodes(element), ""), " ")


def _holds_one_string(element: Column) -> Column:
    """Whether an element holds one text and nothing beside it, maybe inside further elements."""
    return element.rlike(r"(?s)^(?:<[A-Za-z][^>]*>)+[^<]+(?:</[^>]*>)+$")


NAME_PATTERN = r"[A-Z][A-Za-z &'().-]{1,60}"  # fixed value: what a designer's name looks like


def page_designer(html: Column | str, menu_words: Sequence[str] = MENU_WORDS) -> Column:
    """Text of a designer link, else the name after ``All``, else the first short title-like link."""
    def of_anchors(anchors: Column) -> Column:
        linked = F.filter(anchors, lambda a: attribute(opening(a), "href").rlike(r"/designers?/|/brand/")
                          & _holds_one_string(a))
        by_link = F.transform(linked, glued_text)
        texts = F.filter(F.transform(anchors, spaced_text), lambda t: (t != "")
                         & ~F.lower(t).isin(list(menu_words))
                         & t.rlike(r"^\p{Lu}") & (F.size(F.split(t, r"\s+")) <= 4))
        after_all = strip_space(F.regexp_extract(html, rf"All\s+({NAME_PATTERN})", 1))
        return F.coalesce(_filled(F.try_element_at(by_link, F.lit(1))), _filled(after_all),
                          F.try_element_at(texts, F.lit(1)), F.lit(""))

    html = or_empty(html)
    with_href = F.filter(elements(html, "a"), lambda a: opening(a).rlike(r"(?is)\shref\s*="))
    return let(with_href, of_anchors)


def next_page(html: Column | str, base: Column | str) -> Column:
    """Address of the next listing page by four rules in order; null when none applies."""
    def first(found: Column) -> Column:
        return F.try_element_at(found, F.lit(1))

    def href(tag: Column) -> Column:
        return attribute(opening(tag), "href")

    def from_anchors(anchors: Column) -> Column:
        labelled = F.filter(anchors, lambda a: attribute(opening(a), "aria-label").rlike("(?i)next"))
        named = F.filter(anchors, lambda a: _holds_one_string(a) & (F.lower(glued_text(a)) == "next"))
        paged = F.filter(anchors, lambda a: href(a).rlike(r"page=\d+") & glued_text(a).rlike("(?i)next"))
        return F.coalesce(*[_filled(href(first(rule))) for rule in (labelled, named, paged)])

    links = F.filter(tags(html, "link"), lambda t: attribute(t, "rel").rlike(r"(^|\s)next(\s|$)"))
    address = F.coalesce(_filled(attribute(first(links), "href")), let(elements(html, "a"), from_anchors))
    return _filled(absolute_url(address, base))


def card_title(card: Column | str) -> Column:
    """A product card's title: the title attribute, else an image's alternative text, else its text."""
    card = or_empty(card)
    image = F.coalesce(F.try_element_at(tags(card, "img"), F.lit(1)), F.lit(""))
    return F.coalesce(_filled(strip_space(attribute(opening(card), "title"))),
                      _filled(strip_space(attribute(image, "alt"))), _filled(spaced_text(card)))


def card_designer(card: Column | str) -> Column:
    """The name after ``preorder`` or ``only N left``, else the first words when title-cased."""
    text = spaced_text(or_empty(card))
    announced = strip_space(F.regexp_extract(text, rf"(?:preorder|only\s+\d+\s+left)\s+({NAME_PATTERN})", 1))
    words = F.split(text, r"\s+")
    first = F.element_at(words, 1)
    titled = first.rlike(r"^[^\p{L}]*(?:\p{Lu}\p{Ll}*(?:[^\p{L}]+|$))+$") & (F.length(first) > 1)
    return F.coalesce(_filled(announced), F.when(titled, F.array_join(F.slice(words, 1, 3), " ")))

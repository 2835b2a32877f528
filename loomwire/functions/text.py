"""Text columns: markup removal, tokenisers, n-grams inside a row, highlighting.

All functions map columns to columns, so they run inside the scan stage without a shuffle and work
on streaming DataFrames too.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from html.entities import html5

from pyspark.sql import Column, functions as F

# White space as Unicode defines it; \s alone is ASCII-only in Java.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"

# One tag; quoted attribute values may hold '>'. The possessive forms keep the match linear.
TAG = r"""</?[A-Za-z](?:[^'">]++|"[^"]*+"|'[^']*+')*+>|<[!?][^>]*+>"""
INVISIBLE = (r"<!--.*?-->"
             r"|<script\b.*?(?:</script[^>]*>|\z)"
             r"|<style\b.*?(?:</style[^>]*>|\z)")
_MARK = "\x01"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value which is computed once per row.

    Spark computes what a lambda refers to again for every element, and shares no common
    subexpressions with array functions. A one-element array hands the value over.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def each(values: Column | str) -> Column:
    """An array column to explode. Spark tests the size of a plain column below the projection that makes it, and so
    would tokenise every text twice; an expression it leaves alone."""
    return F.concat(_col(values), F.array())


def constant_strings(values: Sequence[str]) -> Column:
    """The texts as an array which Spark folds into one constant; F.get finds a place in it at once."""
    mark = next(c for c in map(chr, range(0xE000, 0xF900)) if not any(c in v for v in values))
    return F.split(F.lit(mark.join(values)), mark)


def strip_space(c: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(_col(c), rf"^{SPACE}+|{SPACE}+$", "")


def or_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def title_and_summary(title: Column | str = "title", summary: Column | str = "summary") -> Column:
    return F.concat(or_empty(title), F.lit(" "), or_empty(summary))


def search_text(title: Column | str = "title", summary: Column | str = "summary") -> Column:
    return F.lower(title_and_summary(title, summary))


# Frequent entities come first, since the look-up is linear.
_ENTITIES = {n: html5[n + ";"] for n in "amp lt gt quot apos nbsp copy middot ndash mdash hellip".split()}
_ENTITIES |= {n[:-1]: text for n, text in html5.items() if n.endswith(";")}


def _entity_table() -> Column:
    """Named character references as a map; two texts which Spark folds into one constant."""
    split = [F.split(F.lit("\x1f".join(part)), "\x1f") for part in (_ENTITIES.keys(), _ENTITIES.values())]
    return F.map_from_arrays(*split)


def decode_entities(c: Column | str) -> Column:
    """Replace character references once, from left to right, so ``&amp;lt;`` gives ``&lt;``."""
    table = _entity_table()

    def decode(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^&(#?[0-9A-Za-z]+);", 1)
        return let(name, lambda n: F.when(n == "", piece).otherwise(F.coalesce(
            F.concat(F.when(n.startswith("#"), numbered(n)).otherwise(F.try_element_at(table, n)),
                     F.substr(piece, F.length(n) + F.lit(3))), piece)))

    def numbered(name: Column) -> Column:
        code = (F.when(name.rlike("^#[0-9]{1,7}$"), F.substr(name, F.lit(2)).try_cast("int"))
                .when(name.rlike("^#[xX][0-9A-Fa-f]{1,6}$"),
                      F.conv(F.substr(name, F.lit(3)), 16, 10).try_cast("int")))
        # decode() of the four UTF-32 bytes is the built-in way from a code point to text
        return let(code, lambda c: F.when(c.isNotNull(), F.decode(F.unhex(F.lpad(F.hex(
            F.when(c.between(1, 0x10FFFF) & ~c.between(0xD800, 0xDFFF), c).otherwise(0xFFFD)), 8, "0")), "UTF-32")))

    def replaced(text: Column) -> Column:
        pieces = F.split(text, r"(?=&#?[0-9A-Za-z]{1,32};)")
        return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, decode), "")).otherwise(text)

    return let(_col(c), replaced)


def html_to_text(html: Column | str) -> Column:
    """Text nodes joined by one blank, without scripts, styles and comments; outer space removed.

    Every piece of markup becomes a mark first and runs of marks become one blank afterwards: a
    pattern which repeats over whole tags would recurse as deep as a page has adjacent tags.
    """
    marked = F.regexp_replace(_col(html), rf"(?is){INVISIBLE}|{TAG}", _MARK)
    return strip_space(decode_entities(F.regexp_replace(marked, f"{_MARK}+", " ")))


def tokens_strip(text: Column | str) -> Column:
    """Tokeniser A: delete all but ASCII letters and white space, lower, split on white space."""
    kept = F.regexp_replace(or_empty(text), r"[^a-zA-Z\s\x0b\x1c-\x1f\x85\p{Z}]+", "")
    return _drop_empty(F.split(F.lower(kept), rf"{SPACE}+"))


def tokens_regex(text: Column | str) -> Column:
    """Tokeniser B: runs of ASCII letters and apostrophes in the lower-cased text."""
    return F.regexp_extract_all(F.lower(or_empty(text)), F.lit("[a-z']+"), F.lit(0))


def tokens_unicode(text: Column | str) -> Column:
    """Tokeniser C: runs of letters of any script in the lower-cased text."""
    return F.regexp_extract_all(F.lower(or_empty(text)), F.lit(r"\p{L}+"), F.lit(0))


def _drop_empty(tokens: Column) -> Column:
    return F.array_remove(tokens, "")


def drop_words(tokens: Column | str, stop: Sequence[str], min_length: int = 3) -> Column:
    """Remove stop words and short words; repeated words stay."""
    stop = list(stop)

    def wanted(word: Column) -> Column:
        long_enough = F.length(word) >= min_length
        return long_enough & ~word.isin(stop) if stop else long_enough

    return F.filter(_col(tokens), wanted)


def clean_text(text: Column | str, stop: Sequence[str], min_length: int = 3) -> Column:
    """Lower-cased content words joined by blanks (no lemmas, see operators.lemmas)."""
    return F.array_join(drop_words(tokens_unicode(text), stop, min_length), " ")


def bigrams(tokens: Column | str) -> Column:
    """Adjacent pairs inside one row's token array, as ``first second``."""
    def pairs(words: Column) -> Column:
        n = F.greatest(F.size(words) - 1, F.lit(0))
        return F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n),
                          lambda a, b: F.concat(a, F.lit(" "), b))

    return let(_col(tokens), pairs)


def quoted(word: str) -> str:
    """A pattern which matches the word literally in Java."""
    return re.sub(r"([^\w\s])", r"\\\1", word)


def highlight(text: Column | str, words: Sequence[str]) -> Column:
    """Put each search word, in any case, in brackets, word by word."""
    out = or_empty(text)
    for word in words:
        out = F.regexp_replace(out, f"(?iu)({quoted(word)})", "[$1]")
    return out


def split_list(text: Column | str, separator: str = ", ") -> Column:
    """Delimited text to an array of trimmed parts; null and empty text give no parts."""
    parts = F.transform(F.split(or_empty(text), quoted(separator)), strip_space)
    return F.when(or_empty(text) == "", F.array().cast("array<string>")).otherwise(parts)


def join_list(parts: Column | str, separator: str = ", ") -> Column:
    return F.array_join(_col(parts), separator)

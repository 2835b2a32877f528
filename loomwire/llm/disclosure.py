"""Personal data: patterns, and terms that disclose a protected entity (information-theoretic sanitisation).

Patterns find e-mail addresses, IP addresses, card and phone numbers. Each value found is a protected entity. A term near
an entity reveals it as far as the two occur together: with document counts n of N,

    PMI(entity, term) = ln(N * n_both / (n_entity * n_term)),  IC(entity) = ln(N / n_entity).

A term with PMI >= ``threshold`` * IC discloses the entity and is sanitised wherever it stands in a document that holds the
entity: removed when it tells the entity for sure (PMI >= IC: it occurs nowhere else), else generalised to its kind.
Evidence is needed: the odds that so many of the entity's documents hold the term by chance, by Chernoff's bound, must be
``chance`` at most. A term of one document discloses an entity of that document alone where the corpus has 1 / chance
documents, so small corpora need entities of more documents. All counts are of documents of the corpus, over whole texts.

Texts are never shuffled: the first pass yields spans, and the terms of documents that hold an entity. Pairs are made only
of terms rare enough to disclose the entity if all its documents held them. Entities of the same documents have the same
scores, so one stands for all of them.

Defined results: null text counts as empty; ids need not be unique or not null, each row is a document of its own for counting and in
the result; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .tokens import by_bytes
from .words import codes, split_words

KINDS = ("email", "ip", "card", "phone")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a match can only begin where a run of digits does, so nothing is scanned twice
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")
_DIGITS = re.compile(r"[^0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of a local part, @ and a domain of two labels or more; every @ is looked at once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", at + 1 if at + 1 > end else end)


def _is_octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """kind, start, end of the patterns' matches, by kind, then start."""
    found: list[tuple[str, int, int]] = []
    if "@" in text:
        found += [("email", a, b) for a, b in _emails(text)]
    if "." in text:
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_is_octet, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0]) if m.end() - m.start() < 60 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def _entity(kind: str, value: str) -> bytes:
    value = value.lower() if kind in ("email", "ip") else _DIGITS.sub("", value)
    return hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=16).digest()


def outside(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """term, start, end of all words outside all spans."""
    taken = sorted((a, b) for _, a, b in spans)
    starts = [a for a, _ in taken]
    reached = np.maximum.accumulate([b for _, b in taken]).tolist()
    for m in _WORD.finditer(text):
        i = bisect.bisect_left(starts, m.end()) - 1
        if i < 0 or reached[i] <= m.start():
            yield m[0].lower(), *m.span()


def context(text: str, spans: list[tuple[str, int, int]], reach: int) -> Iterator[tuple[bytes, str, int, int]]:
    """entity, term, start, end of the words within ``reach`` characters of a span, whole words outside all spans."""
    if not spans:
        return
    taken = sorted((a, b) for _, a, b in spans)
    starts = [a for a, _ in taken]
    reached = np.maximum.accumulate([b for _, b in taken]).tolist()
    for kind, a, b in spans:
        entity = _entity(kind, text[a:b])
        left = max(0, a - reach)
        for m in _WORD.finditer(text, left, min(len(text), b + reach)):
            s, e = m.span()
            if s == left and s and text[s - 1].isalpha() or e < len(text) and text[e].isalpha():
                continue  # cut by the window
            i = bisect.bisect_left(starts, e) - 1
            if i >= 0 and reached[i] > s:
                continue
            yield entity, m[0].lower(), s, e


SPANS = "doc_id long, row long, base array<struct<kind:string,start:int,end:int>>"
SLICE = 128  # documents marked at a time
COUNTED = 4 << 20  # bytes of text whose words are counted at a time
PARTS = ("array<struct<entities:array<binary>,terms:array<struct<term:string,"
         "at:array<struct<start:int,end:int>>>>>>")


def _parts(text: str, spans: list[tuple[str, int, int]], reach: int | None) -> list[dict]:
    """Entities, and the terms that stand with each of them: one part for all, or one per entity when there is a reach."""
    if not spans:
        return []
    found: dict[bytes, dict[str, dict[tuple[int, int], None]]] = {}
    if reach is None:
        all_of: dict[str, dict[tuple[int, int], None]] = {}
        for term, s, e in outside(text, spans):
            all_of.setdefault(term, {})[s, e] = None
        parts = [(sorted({_entity(kind, text[a:b]) for kind, a, b in spans}), all_of)]
    else:
        for entity, term, s, e in context(text, spans, reach):
            found.setdefault(entity, {}).setdefault(term, {})[s, e] = None
        parts = [([entity], terms) for entity, terms in found.items()]
    return [{"entities": entities, "terms": [{"term": t, "at": [{"start": s, "end": e} for s, e in at]}
                                             for t, at in terms.items()]} for entities, terms in parts]


def _marked(docs: DataFrame, reach: int | None) -> DataFrame:
    """doc_id, row, base spans and the terms with their entities, of every document."""
    place = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    span = pa.struct([("kind", pa.string()), *place])
    term = pa.struct([("term", pa.string()), ("at", pa.list_(place))])
    part = pa.struct([("entities", pa.list_(pa.binary())), ("terms", pa.list_(term))])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # small slices, as the words of a document take many times its size here
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            base, parts = [], []
            for text in batch.column(2).to_pylist():
                spans = base_spans(text or "")
                base.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
                parts.append(_parts(text or "", spans, reach))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(base, pa.list_(span)),
                                              pa.array(parts, pa.list_(part))], ["doc_id", "row", "base", "parts"])

    return docs.mapInArrow(mark, f"{SPANS}, parts {PARTS}")


def _term_documents(docs: DataFrame) -> DataFrame:
    """(term, n): documents with the term, a row per few megabytes of documents; n adds up."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # small slices here as well: the words of a batch take many times its size
        for batch in (part for b in batches for part in by_bytes(b, 0, COUNTED)):
            texts = pc.utf8_lower(pc.fill_null(batch.column(0), ""))
            # anything that is no letter parts words; digits and underscores part them as well
            flat, bounds = split_words(pc.replace_substring_regex(texts, r"[^\pL]+", " "))
            index, distinct = codes(flat)
            document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            once = np.unique(document * max(len(distinct), 1) + index)
            counts = np.bincount(once % max(len(distinct), 1), minlength=len(distinct))
            yield pa.RecordBatch.from_arrays([distinct, pa.array(counts, pa.int64())], ["term", "n"])

    return docs.select("text").mapInArrow(count, "term string, n long")


def find(docs: DataFrame, threshold: float = 0.8, least_together: int = 1, reach: int | None = None, key: str = "doc_id",
         text: str = "text", chance: float = 0.001) -> DataFrame:
    """doc_id, base (spans of the patterns), disclosing (spans of terms, with the action) of every document.

    reach: if given, only words within so many characters of an entity stand with it.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text).cast("string").alias("text"))
    marked = written(_marked(rows, reach))
    n_all = max(marked.count(), 1)
    parts = marked.select("row", F.posexplode("parts").alias("part", "p")).select("row", "part", "p.entities", "p.terms")
    holds = parts.select("row", "part", F.explode("entities").alias("entity"))
    one = "row" if reach is None else "entity"
    entities = holds.select("row", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"), *[
        (F.bit_xor if reach is None else F.max)(F.xxhash64(F.lit(i), one)).alias(f"like{i}") for i in (0, 1)])
    held = written(holds.join(entities, "entity").select("row", "part", "like0", "like1", "n_entity").distinct())

    def most(n_entity: Column) -> Column:
        """Documents a term may have that discloses an entity of so many documents, all of which hold it."""
        return F.lit(float(n_all)) * F.pow(n_entity / n_all, F.lit(threshold)) * (1 + 1e-9)

    said = parts.select("row", "part", F.explode("terms.term").alias("term"))
    known = (_term_documents(rows).join(said.select("term").distinct(), "term", "left_semi")
             .groupBy("term").agg(F.sum("n").alias("n_term")))
    largest = held.agg(F.max("n_entity")).first()[0] or 0
    rare = said.join(known.where(F.col("n_term") <= most(F.lit(largest))), "term")
    together = ["like0", "like1", "n_entity", "term", "n_term"]
    pairs = written(rare.join(held, ["row", "part"]).where(F.col("n_term") <= most(F.col("n_entity")))
                    .select("row", "part", *together))
    scored = pairs.groupBy(*together).agg(F.count(F.lit(1)).alias("n_both")).select(
        "*", (F.log(n_all * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))).alias("pmi"),
        F.log(n_all / F.col("n_entity")).alias("ic"), (F.col("n_both") / F.col("n_entity")).alias("q"),
        (F.col("n_term") / n_all).alias("p"))
    rest = F.when(F.col("q") < 1, (1 - F.col("q")) * (F.log(1 - F.col("q")) - F.log(1 - F.col("p")))).otherwise(0.0)
    evidence = F.col("n_entity") * (F.col("q") * F.log(F.col("q") / F.col("p")) + rest)
    telling = scored.where((F.col("ic") > 0) & (F.col("pmi") >= threshold * F.col("ic"))
                           & (F.col("n_both") >= least_together) & (evidence >= -math.log(chance))).select(
        "like0", "like1", "term", F.when(F.col("pmi") >= F.col("ic") - 1e-9, "remove").otherwise("generalise").alias("action"))
    hit = pairs.join(telling, ["like0", "like1", "term"]).groupBy("row", "part", "term").agg(F.max("action").alias("action"))
    hit = (parts.select("row", "part", F.inline("terms")).join(hit, ["row", "part", "term"])
           .select("row", "action", F.inline("at")).groupBy("row", "start", "end").agg(F.max("action").alias("action")))
    # a group is the words of one document
    spans = hit.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "action"))).alias("disclosing"))
    none = F.array().cast("array<struct<start:int,end:int,action:string>>")
    return marked.join(spans, "row", "left").select(
        "doc_id", "base", F.coalesce("disclosing", none).alias("disclosing"))


def sanitised(text: str, base: list, disclosing: list) -> str:
    """text with patterns replaced by their kind, generalised terms by [TERM] and removed ones gone."""
    marks = [(s["start"], s["end"], f"[{s['kind'].upper()}]") for s in base]
    marks += [(s["start"], s["end"], "" if s["action"] == "remove" else "[TERM]") for s in disclosing]
    parts, end = [], 0
    for a, b, instead in sorted(marks, key=lambda m: (m[0], -m[1])):
        if a >= end:
            parts += [text[end:a], instead]
            end = b
    return "".join([*parts, text[end:]])

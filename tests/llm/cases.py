"""Small documents with every awkward case, and pieces of brute-force versions."""

import re

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row long, run long, kept string, "
          "line string, start string, band long, `end` string, key int, place string, block int, term string")


def documents(sf=SF):
    return {r["doc_id"]: r["text"] for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def awkward():
    """(doc_id, text): nulls, empty, blank, repeated rows, equal texts, ties and a very long text."""
    long = " ".join(f"w{i % 977}x{i * 7 % 991}" for i in range(60_000)) + "\n" + "9" * 20_000 + "\n" + "a@" * 3000
    base = "The quick brown fox jumps over the lazy dog and runs away from all of the other animals today"
    return [(1, base + "\n" + base), (2, base.upper() + "\n" + base), (3, None), (None, base), (4, ""), (5, " \t\n \n"),
            (6, long), (7, long), (8, base), (8, base), (9, "short"), (None, None), (10, base + " again\nÀ É ß ñ"),
            (11, "one two three four"), (12, "ONE two three four"), (13, "\n".join(["same line of text here"] * 40))]


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    extra = ("x", 3, 4, "k", "l", "s", 5, "e", 6, "p", 7, "t")
    filled = [(d, t, None if d == 2 else "en", f"src{d % 3}" if d else None, None if t is None else len(t), *extra[1:3],
               *extra[3:]) for d, t in rows]
    return spark.createDataFrame(filled, SCHEMA)


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def multiset(rows):
    return sorted(map(repr, rows))

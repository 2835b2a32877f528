import base64
import hashlib
import random

import pyarrow.parquet as pq
import pytest
from cases import SF, multiset, rows_of
from hypothesis import given, settings, strategies as st
from loomwire.llm import warc
from loomwire.llm.queries import op5_warc_segments

SCHEMA = "page_id long, url string, html string, row int, first string, record string"


def plain(pages):
    first = {}
    for p, html in pages:
        if p is not None:
            first[html or ""] = min(p, first.get(html or "", p))
    out = []
    for p, html in pages:
        body = (html or "").encode()
        again = p is not None and first[html or ""] < p
        out.append({"page_id": p, "payload_bytes": len(body),
                    "payload_digest": base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "record_type": "revisit" if again else "response", "refers_to": first[html or ""] if again else None})
    return out


def test_all_pages(spark):
    pages = [(r["page_id"], r["html"]) for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()]
    assert multiset(rows_of(op5_warc_segments(spark, SF))) == multiset(plain(pages))


@pytest.mark.parametrize("segment,chunk,records", [(300, 64, 3), (16384, 4096, 2000), (61, 7, 2)])
def test_awkward_pages(spark, tmp_path, segment, chunk, records):
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\n\r\n\r\n0\r\n\r\né" * 9
    pages = [(1, "<p>a</p>"), (2, "<p>a</p>"), (3, None), (4, ""), (5, tricky), (6, "ü" * 700), (7, "ü" * 700), (7, "ü" * 700),
             (None, "x"), (8, "x"), (9, "\r\n"), (6, "ü" * 700)]
    df = spark.createDataFrame([(p, f"http://h/{p} q" if p else None, h, 1, "f", "r") for p, h in pages], SCHEMA)
    warc.write_warc(df.repartition(3), str(tmp_path / "w"), segment, chunk, records)
    back = warc.read_warc(spark, str(tmp_path / "w"))
    assert multiset({k: r[k] for k in plain(pages)[0]} for r in rows_of(back)) == multiset(plain(pages))
    texts = dict(pages)
    for r in rows_of(back):
        assert r["status"] == "ok"
        if r["record_type"] == "response" and r["page_id"] is not None:
            assert r["payload"] == (texts[r["page_id"]] or "").encode()
    warc.write_warc(df.limit(0), str(tmp_path / "e"))
    assert warc.read_warc(spark, str(tmp_path / "e")).count() == 0


def records_of(payload, segment, chunk):
    raw = b"".join(r + b"\r\n" for r in warc.records(3, 0, "http://u", payload, None, segment, chunk))
    return list(warc.parse(raw))


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=400), st.integers(10, 200), st.integers(1, 50), st.randoms())
def test_segments_in_any_order(payload, segment, chunk, rng):
    rows = records_of(payload, segment, chunk)
    assert len({r[4] for r in rows}) == 1
    parts = [(r[5], r[6], r[7]) for r in rows]
    rng.shuffle(parts)
    head = rows[0]
    assert warc.decoded(head[0], head[1], head[2], head[3], parts, True)[-2:] == ("ok", payload)
    if len(parts) > 1:
        lost = random.Random(1).choice(range(len(parts)))
        assert warc.decoded(head[0], head[1], head[2], head[3], parts[:lost] + parts[lost + 1:], True)[-2:] == ("damaged", None)


def test_broken_framing():
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")
    assert warc.dechunked(warc.chunked(b"", 5)) == b""

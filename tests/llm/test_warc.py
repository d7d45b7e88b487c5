import base64
import hashlib
import random

import pytest

from tessella.llm import warc


def brute(rows):
    first, out = {}, []
    for page, _, html in rows:
        if page is not None:
            first[html or ""] = min(page, first.get(html or "", page))
    for page, _, html in rows:
        raw = (html or "").encode()
        revisit = page is not None and first[html or ""] != page
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=str)


def test_round_trip_against_brute_force(spark):
    rng = random.Random(8)
    long = "".join(rng.choice("abé\n\r漢😀<>") for _ in range(40_000))
    htmls = ["", None, "a", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n", "\r\n\r\n", long, long + "x", "é" * 5000, "<p>" * 100]
    rows = [(i, f"http://h/{i}\r\nX: y", rng.choice(htmls)) for i in range(60)] + [(5, None, "a"), (5, None, "a"), (None, "u", "a"), (None, None, None), (61, "u", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert sorted(map(tuple, warc.round_trip(df).collect()), key=str) == brute(rows)
    assert warc.round_trip(df.limit(0).selectExpr("*", "1 AS digest", "2 AS payload")).collect() == []


def test_payloads_come_back(spark, tmp_path):
    rows = [(i, "u", "x\r\n" * i * 999) for i in range(8)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"), segment=1000, chunk=300)
    got = {r.page_id: bytes(r.payload).decode() for r in warc.read(spark, str(tmp_path / "w")).collect()}
    assert got == {i: h for i, _, h in rows}


def test_chunk_framing():
    assert warc.dechunked(b"3;x=y\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc0123456789"
    assert warc.dechunked(warc.chunked(b"q" * 1001, 10)) == b"q" * 1001
    with pytest.raises(ValueError):
        warc.dechunked(b"5\r\nabc\r\n0\r\n\r\n")

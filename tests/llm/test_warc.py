from __future__ import annotations

import gzip
import hashlib
import random

import pytest

from tidemark.llm import warc

rng = random.Random(1)
BIG = "".join(rng.choices("abcdefgh é", k=3000))
ROWS = [
    (1, "http://a/é b", BIG),
    (2, None, BIG),
    (3, "http://c\r\nX: 1", "small"),
    (4, "http://d", "small"),
    (None, "http://e", BIG),
    (5, "http://f", None),
    (6, "http://g", ""),
    (7, "http://h", "".join(rng.choices("abcdefgh \n", k=200_000))),
    (7, "http://h", "y" * 1000),
    (9, "http://i", "y" * 1000),
    (9, "http://i", "y" * 1000),
    (10, "http://j", "z" * 999),
    (11, "http://k", "z" * 999),
    (12, "http://l", "\u001f\u008b\b WARC/1.1\r\n\r\n" * 100),
]


def brute(rows):
    data = [(p, (h or "").encode()) for p, _, h in rows]
    largest = {}
    for page, text in data:
        if page is not None and len(text) >= 1000:
            largest[text] = max(page, largest.get(text, page))
    for page, text in data:
        holder = largest.get(text)
        refers = holder if holder is not None and holder != page else None
        yield page, len(text), hashlib.sha1(text).hexdigest(), "revisit" if refers is not None else "response", refers


def pages(llm, rows):
    df = llm.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", "'clash' AS payload", "'clash' AS digest", "1 AS size", "'p' AS path")


def test_query_equals_brute_force(llm, folder):
    found = warc.op6_warc(llm, folder(pages=pages(llm, ROWS))).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, brute(ROWS)))
    assert warc.op6_warc(llm, folder(pages=pages(llm, []))).count() == 0


@pytest.mark.parametrize("size", [50, 700, 1 << 30])
def test_every_record_is_read_once_whatever_the_ranges(llm, tmp_path, size):
    records = warc.plan_records(pages(llm, ROWS).coalesce(2))
    manifest = llm.createDataFrame(warc.write_archives(records, str(tmp_path)).collect(), warc.MANIFEST)
    found = warc.read_archives(manifest, size).collect()
    assert len(found) == len(ROWS) == sum(r["n_records"] for r in manifest.collect())
    texts = sorted(bytes(r["payload"]) for r in found if r["record_type"] == "response")
    kinds = list(brute(ROWS))
    assert texts == sorted((h or "").encode() for (_, _, h), k in zip(ROWS, kinds) if k[3] == "response")


def test_members_are_plain_gzip_warc_records():
    data = gzip.decompress(warc.record(5, "http://x", b"body", "d", None))
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"\r\n\r\nbody\r\n\r\n")
    fields, block = warc.parse(data)
    assert fields["content-length"] == "4" and block == b"body"


def test_false_members_are_passed_over(llm, tmp_path):
    good = warc.record(1, "http://x", b"one", "d", None)
    junk = b"\x1f\x8b\x08junk" + gzip.compress(b"not a record") + b"\x1f\x8b\x08"
    (tmp_path / "a.warc.gz").write_bytes(junk + good + junk + good + b"\x1f\x8b")
    size = len(junk + good + junk + good) + 2
    manifest = llm.createDataFrame([(str(tmp_path / "a.warc.gz"), size, 2)], warc.MANIFEST)
    for step in (10, 64, 1 << 20):
        assert [bytes(r["payload"]) for r in warc.read_archives(manifest, step).collect()] == [b"one", b"one"]


def test_ranges_are_read_by_as_many_tasks(llm, tmp_path):
    records = warc.plan_records(pages(llm, ROWS).coalesce(1))
    manifest = llm.createDataFrame(warc.write_archives(records, str(tmp_path)).collect(), warc.MANIFEST)
    n = sum(-(-r["size"] // 9000) for r in manifest.collect())
    assert n > 4 and llm.conf.get("spark.sql.adaptive.enabled") == "true"
    for most, expected in ((10_000, n), (3, 3)):
        read = warc.read_archives(manifest, 9000, most)
        assert read.rdd.getNumPartitions() == expected  # of the plan as it ran
        busy = read.selectExpr("spark_partition_id() AS p").distinct().count()
        assert read.count() == len(ROWS) and busy > 1

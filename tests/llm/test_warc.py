"""WARC records: writing, reading, revisits and damage."""

import gzip
import hashlib
import io

import pytest
from llm_fixtures import rows_of
from pyspark.sql import functions as F

from sensorlake.llm import warc
from sensorlake.llm.files import opened

BIG, SMALL = "<p>" + "é" * 100 + "</p>", "<p>tiny</p>"
PAGES = [
    (3, "http://a/b c", BIG, 1), (1, "http://a/\r\nX: y", BIG, 2), (1, None, BIG, 3), (2, "u", SMALL, 4),
    (4, "u", SMALL, 5), (5, "u", None, 6), (6, "u", "", 7), (None, "u", BIG, 8),
    (7, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 50, 9), (8, "u", "long" * 1_000_000, 10),
    (9, "u", "x" * 99, 11), (10, "u", "x" * 99, 12), (11, "u", "x" * 100, 13), (12, "u", "x" * 100, 14),
]
SCHEMA = "page_id long, url string, html string, first int"


def brute(pages):
    payloads = [(i, (h or "").encode()) for i, _, h, _ in pages]
    out = []
    for i, data in payloads:
        same = [j for j, other in payloads if other == data and j is not None]
        first = min(same, default=None) if len(data) >= 100 else None
        revisit = first is not None and i != first
        out.append(
            (i, len(data), hashlib.sha256(data).hexdigest(),
             "revisit" if revisit else "response", first if revisit else None)
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize("share", [1e-4, 0])
def test_round_trip(spark, monkeypatch, share):
    monkeypatch.setattr(warc, "HOT_SHARE", share)
    pages = spark.createDataFrame(PAGES, SCHEMA)
    files = warc.write(pages)
    assert files.agg(F.sum("records")).first()[0] == len(PAGES)
    found = warc.read(files).drop("url")
    assert rows_of(found) == brute(PAGES)
    kept = {r["page_id"]: r for r in warc.read(files, keep_payload=True).where("payload is not null").collect()}
    assert bytes(kept[8]["payload"]) == PAGES[9][2].encode() and kept[1]["url"] in (
        "http://a/%0D%0AX:%20y", "urn:page:1",
    )


def test_hot_groups_are_broadcast(spark):
    rows = [(i, "u", BIG if i % 2 else f"{i}" * 100, 0) for i in range(3000)]
    found = warc.read(warc.write(spark.createDataFrame(rows, SCHEMA))).drop("url")
    assert rows_of(found) == brute(rows)


def test_empty_table(spark):
    assert warc.read(warc.write(spark.createDataFrame([], SCHEMA))).count() == 0


def test_one_member_per_record(spark):
    path = warc.write(spark.createDataFrame(PAGES[:3], SCHEMA).coalesce(1)).first()["path"]
    with opened(path) as stream:
        data = stream.read()
    text = gzip.decompress(data)
    assert text.count(b"WARC/1.1\r\n") == data.count(b"\x1f\x8b\x08")
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ")


def archive(*records):
    return b"".join(warc.member(r) for r in records)


def good(payload=b"<p>hello</p>"):
    return warc.record(1, "http://a", payload, hashlib.sha256(payload).hexdigest())


def test_many_members_and_small_reads(monkeypatch):
    monkeypatch.setattr(warc, "_PIECE", 7)
    found = list(warc.records(io.BytesIO(archive(good(), good(b""), good(b"x" * 500))), True))
    assert [r["payload"] for r in found] == [b"<p>hello</p>", b"", b"x" * 500]


@pytest.mark.parametrize("damage", [
    lambda r: r.replace(b"hello", b"jello"),
    lambda r: r[:-4],
    lambda r: r + b"more",
    lambda r: r.replace(b"WARC/1.1", b"WRAC/1.1", 1),
    lambda r: r.replace(b"application/http;msgtype=response\r\nContent-Length: ", b"x\r\nContent-Length: 9"),
])
def test_damage_is_an_error(damage):
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(archive(good(), damage(good())))))


def test_cut_off_archive_is_an_error():
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(archive(good())[:-12])))

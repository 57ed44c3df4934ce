import gzip
import hashlib
import random
import zlib

import pytest

from gridweave.llm import warc
from gridweave.sources.scratch import new_path

SCHEMA = "page_id long, url string, html string, digest string, id int, bytes int"


def pages(seed=1, n=80):
    rng = random.Random(seed)
    bodies = ["é" * 50, "x" * 99, "y" * 100, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 9, "", None, "\r\n\r\n", "漢" * 3000]
    return [(i, rng.choice([None, "http://a/ b\r\nX: y", "http://é/?q"]), rng.choice(bodies) if rng.random() < 0.8 else f"own {i} " * 30, "c", 1, 2) for i in rng.sample(range(1000), n)]


def brute(rows):
    out, first = {}, {}
    for i, _, body, *_ in sorted(rows):
        data = (body or "").encode()
        if len(data) >= 100:
            first.setdefault(data, i)
        to = first.get(data, i)
        out[i] = (len(data), hashlib.sha256(data).hexdigest(), "response" if to == i else "revisit", None if to == i else to)
    return out


def test_round_trip(spark):
    rows = pages()
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert got == brute(rows) and any(v[2] == "revisit" for v in got.values())


def test_assembled_captures(spark):
    path = new_path(spark, "warc")
    warc.write(spark.createDataFrame(pages(), SCHEMA), path, archive_bytes=3000)
    records = warc.read(spark, path)
    assert records.count() == 240
    captures = warc.transactions(records).collect()
    assert len(captures) == 80
    for c in captures:
        assert c["request"]["record_id"] == c["capture"] and c["request"]["http_head"].startswith("GET ")
        assert c["response"]["kind"] in ("response", "revisit") and c["metadata"]["fields"].startswith("page: ")
        if c["response"]["kind"] == "response":
            assert hashlib.sha256(c["response"]["payload"]).hexdigest() == c["response"]["payload_digest"].split(":")[1]
        else:
            assert not c["response"]["payload"] and c["response"]["refers_to"]
    lone = warc.transactions(records.where("kind = 'metadata'"))
    assert lone.count() == 80 and lone.where("response IS NOT NULL").count() == 0


def test_parser():
    record = b"WARC/1.0\r\nWARC-Type: resource\r\nX-Folded: a\r\n b\r\nContent-Length: 4\r\n\r\n\r\n\r\n\r\n\r\n"
    for data in (record * 2, gzip.compress(record) * 2, gzip.compress(record * 2)):
        found = list(warc.parse(data))
        assert len(found) == 2 and found[0][0]["x-folded"] == "a b" and found[0][1] == b"\r\n\r\n"
    assert list(warc.parse(b"")) == []
    for broken in (record[:-9], b"junk\r\n\r\n", record + b"WARC/1.0\r\n"):
        with pytest.raises(ValueError):
            list(warc.parse(broken))


def test_odd_tables(spark):
    assert warc.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
    body = "z" * 200
    rows = [(None, None, body, "", 1, 1), (5, "u", body, "", 1, 1), (5, "u", body, "", 1, 1), (9, "u", body, "", 1, 1), (None, "u", None, "", 1, 1), (None, "u", "q" * 200, "", 1, 1)]
    got = sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"])) for r in warc.round_trip(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("5", "response", "None"), ("5", "response", "None"), ("9", "revisit", "5"), ("None", "response", "None"), ("None", "response", "None"), ("None", "revisit", "5")]


def test_revisits_resolve_and_records_are_members(spark):
    path = new_path(spark, "warc")
    rows = pages(seed=4, n=120) + [(2000 + i, "u", "w" * 150, "", 1, 1) for i in range(30)]
    warc.write(spark.createDataFrame(rows, SCHEMA).repartition(3), path, archive_bytes=4000)
    captured = warc.resolved(warc.transactions(warc.read(spark, path)))
    by_capture = {c["capture"]: c for c in captured.collect()}
    revisits = [c for c in by_capture.values() if c["response"]["kind"] == "revisit"]
    assert len(revisits) > 30
    for c in revisits:
        response = by_capture[c["refers_capture"]]["response"]
        assert response["kind"] == "response" and response["record_id"] == c["response"]["refers_to"] and response["payload_digest"] == c["response"]["payload_digest"]
    files = [bytes(r["content"]) for r in spark.read.format("binaryFile").load(path).collect() if len(r["content"])]
    assert len(files) > 3
    for data in files:
        members, sizes, left = 0, [], data
        while left:
            one = zlib.decompressobj(31)
            body = one.decompress(left)
            sizes.append(len(left) - len(one.unused_data))
            left = one.unused_data
            assert not body or body.startswith(b"WARC/1.1\r\n") and len(list(warc.parse(body))) == 1
            members += bool(body)
        assert members and len(data) - sizes[-1] < 4000 + 2 * max(sizes)


def test_very_long_records_are_members_of_their_own(spark):
    body = "".join(chr(33 + i * i % 90) for i in range(1000)) * 17_500  # over 16 MB, so that the member's size does not end in a zero byte
    rows = [(1, "u", body, "", 1, 1), (2, "u", "s" * 100, "", 1, 1), (3, "u", body, "", 1, 1)]
    got = sorted((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.round_trip(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(1, len(body), "response", None), (2, 100, "response", None), (3, len(body), "revisit", 1)]

"""WARC: records, monolithic streams, members, revisits."""

import base64
import glob
import gzip
import hashlib

import pytest

from sensorloom.llm import warc

SCHEMA = "page_id long, url string, html string, file string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "f", "d") for r in rows], SCHEMA)


@pytest.fixture
def rows(rng):
    body = ["<p>one</p>", "<p>é — two</p>", "", None, "x" * 300_000, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"]
    out = [(i, f"http://h.example/{i}", rng.choice(body)) for i in range(120)]
    return [*out, (500, None, "lone"), (None, "http://n.example/", "<p>one</p>"), (None, None, "only here"), (501, "http://u", "twice"), (501, "http://u", "twice")]


def brute(rows):
    first = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if data not in first or (i is not None and (first[data] is None or i < first[data])):
            first[data] = i
    out, done = [], set()
    for i, u, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        response = data not in done and i == first[data]
        done |= {data} if response else set()
        out.append((i, u, len(data), digest, "response" if response else "revisit", None if response else first[data]))
    return sorted(out, key=str)


def test_archive_round_trip(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 400_000)
    folder = f"{tmp_path}/warc"
    got = warc.archive(pages(spark, rows).repartition(3), folder)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    streams, members = (glob.glob(f"{folder}/{d}/*.warc.gz") for d in ("stream", "members"))
    assert len(streams) > 3 and len(members) == len(streams)
    for path in members:
        data = open(path, "rb").read()
        index = [line.split() for line in open(f"{path}.idx")]
        # the sidecar covers the file without a gap, and every member stands alone
        assert [int(x[0]) for x in index] == [sum(int(y[1]) for y in index[:k]) for k in range(len(index))]
        assert sum(int(x[1]) for x in index) == len(data)
        for offset, length, kind, _ in index:
            text = gzip.decompress(data[int(offset) : int(offset) + int(length)])
            assert text.startswith(b"WARC/1.1\r\nWARC-Type: " + kind.encode())
            assert text.endswith(b"\r\n\r\n")


def test_reader_takes_any_chunks_and_rejects_a_cut_archive():
    data = b"".join(warc.record(i, "http://x", b"a" * i + b"\r\n\r\n", warc.payload_digest(b"a" * i + b"\r\n\r\n")) for i in range(5))
    for size in (1, 7, 10_000):
        found = list(warc.read_records(data[k : k + size] for k in range(0, len(data), size)))
        assert [warc.page_of(f["warc-record-id"]) for f, _ in found] == list("01234")
    with pytest.raises(ValueError):
        list(warc.read_records(iter([data[:-30]])))
    with pytest.raises(ValueError):
        list(warc.read_records(iter([b"HTTP/1.1 200 OK\r\n\r\n"])))
    assert list(warc.read_records(iter([]))) == []


def test_empty_table(spark):
    assert warc.archive(pages(spark, [])).count() == 0

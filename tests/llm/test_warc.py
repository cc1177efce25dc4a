import gzip
import hashlib
import tracemalloc

import pytest

from mercata.llm import warc
from mercata.session import scratch_path

SCHEMA = "page_id long, url string, html string, id string, digest string, payload string, block string"


def pages():
    long = "<p>é日本🙂</p>\r\n\r\nWARC/1.1\r\n\r\n" * 3000
    page = "<html>" + "x" * 200 + "</html>"
    return [
        (5, "http://a/5", page),
        (3, "http://a/3", page),
        (9, None, page),
        (3, "http://a/3", page),
        (1, "http://a/1\r\nEvil: 1", long),
        (2, "http://a/2", long),
        (4, "http://a/4", None),
        (6, "http://a/6", ""),
        (7, "http://a/7", "y" * 99),
        (8, "http://a/8", "y" * 99),
        (10, "http://a/10", "é" * 50),
        (11, "http://a/11", "é" * 50),
        (None, "http://a/", page),
        (12, "http://a/12", "z" * 200_001),
    ]


def written(spark, rows):
    path = scratch_path(spark, "test-archives")
    warc.write_archives(spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA), path)
    return path


def test_pages_come_back(spark):
    path = written(spark, pages())
    rows = warc.read_archives(spark, path).collect()
    first = {}
    for i, _, html in pages():
        data = (html or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(i, first.get(data, i))
    want = []
    for i, _, html in pages():
        data = (html or "").encode()
        refers = first.get(data)
        revisit = refers is not None and refers != i
        kind = "revisit" if revisit else "response"
        page = None if i is None else str(i)
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), kind, str(refers) if revisit else None, None if revisit else data))
    got = [tuple(r) for r in rows]
    got = [(*r[:5], None if r[5] is None else bytes(r[5])) for r in got]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    short = [tuple(r) for r in warc.read_archives(spark, path, with_payload=False).collect()]
    assert sorted(short, key=repr) == sorted([r[:5] for r in want], key=repr)


def test_records_are_segmented_and_parse(spark):
    records = warc.raw_records(spark, written(spark, pages())).collect()
    parts = [r for r in records if r["origin"].startswith("urn:page:12:")]
    assert len(parts) > 10 and sorted(p["number"] for p in parts) == [*range(1, len(parts) + 1)]
    assert sum(p["total"] is not None for p in parts) == 1
    assert sum(r["type"] == "continuation" for r in records) > 10


def test_missing_segments_and_damage_are_told():
    digest = hashlib.sha256(b"x" * 40_000).hexdigest()
    records = list(warc.page_records(1, None, b"x" * 40_000, digest, None, "urn:page:1"))
    parts = []
    for headers, block in warc.parsed(b"".join(r + warc.END for r in records)):
        total = headers.get("warc-segment-total-length")
        parts.append({"number": int(headers["warc-segment-number"]), "total": total and int(total), "block": block, "id": "1"})
    block = warc.joined(parts)
    assert warc.payload_of(block, digest) == b"x" * 40_000
    for broken in (parts[:-1], parts[:1] + parts[2:], [*parts[:-1], parts[-1] | {"block": b""}]):
        with pytest.raises(ValueError):
            warc.payload_of(warc.joined(broken), digest)
    with pytest.raises(ValueError):
        warc.payload_of(block.replace(b"xx\r\n", b"xy\r\n", 1), digest)
    with pytest.raises(ValueError):
        list(warc.parsed(records[0] + b"\r\n"))


def test_framing():
    for payload in (b"", b"x", "é日🙂".encode() * 3000, b"\x80" * 9000):
        assert warc.unchunked(warc.chunked(payload)) == payload
    assert warc.unchunked(b"3;name=x\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for part in warc.cuts("é日🙂".encode() * 300, 50):
        part.decode()


def test_archives_with_a_member_for_each_record():
    records = [warc.record([("WARC-Type", "resource")], b"block %d" % i) + warc.END for i in range(3)]
    archive = b"".join(gzip.compress(r) for r in records)
    assert [b for _, b in warc.parsed(archive)] == [b"block 0", b"block 1", b"block 2"]


@pytest.mark.parametrize("sizes", [(1, 1), (7, 5), (65_536, 1 << 20)])
def test_records_do_not_depend_on_pieces(monkeypatch, sizes):
    monkeypatch.setattr(warc, "READ_BYTES", sizes[0])
    monkeypatch.setattr(warc, "PIECE_BYTES", sizes[1])
    blocks = [b"", b"x", warc.END * 3, b"\x1f\x8b", bytes(range(256)) * 4]
    records = [warc.record([("WARC-Type", "resource"), ("WARC-Target-URI", "http://\u00e9")], b) + warc.END for b in blocks]
    whole = b"".join(records)
    for archive in (whole, gzip.compress(whole), b"".join(map(gzip.compress, records)), gzip.compress(whole[:99]) + gzip.compress(whole[99:])):
        assert [b for _, b in warc.parsed(archive)] == blocks
        for broken in (archive[:-1], archive[: len(archive) * 2 // 3], archive[:1]):
            with pytest.raises(ValueError):
                list(warc.parsed(broken))
    assert list(warc.parsed(b"")) == []


def test_memory_is_that_of_pieces_not_of_archives():
    part = warc.record([("WARC-Type", "resource")], bytes(100_000)) + warc.END
    for archive in (gzip.compress(part * 1_000), b"".join([gzip.compress(part)] * 1_000)):
        tracemalloc.start()
        assert sum(len(b) for _, b in warc.parsed(archive)) == 100_000_000
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 8_000_000


def test_large_archive_is_handed_on_in_batches(spark):
    rows = [(i, f"http://a/{i}", "z" * 3_000 + str(i)) for i in range(6_000)] + [(6_000, "http://a/", "y" * 6_000_000)]
    path = written(spark, rows)
    got = {int(r["page_id"]): r for r in warc.read_archives(spark, path, with_payload=False).collect()}
    assert {i: r["payload_bytes"] for i, r in got.items()} == {i: len(h) for i, _, h in rows}
    assert got[6_000]["payload_digest"] == hashlib.sha256(b"y" * 6_000_000).hexdigest()


def test_no_rows(spark):
    assert warc.read_archives(spark, written(spark, [])).count() == 0

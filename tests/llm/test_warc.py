import gzip
import hashlib
import random
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from patronage.llm import queries, warc
from tests.compare import assert_same, connect

SF_DIR = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string, payload string, _salt int, n int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "p", 1, 2) for i, u, h in rows], PAGES)


def test_query_matches_sql(spark):
    assert_same(queries.op2_warc(spark, SF_DIR), connect(SF_DIR), queries.OP2_SQL)


def stored(spark, rows, path):
    warc.write_archives(warc.mark_revisits(pages(spark, rows).repartition(2)), f"file://{path}")
    return {r.record_id: r for r in warc.read_archives(spark, f"file://{path}").collect()}


def test_revisits_nulls_and_round_trip(spark, tmp_path):
    long, nul = "é" * 500, "a\x00\r\n\r\nWARC/1.1\r\nx: y\r\n\r\n" * 80
    rows = [(1, "u1", long), (9, "u9", long), (5, None, long), (2, "a b\r\nX: 1", "short"), (3, "u", "short"), (4, "u", None), (6, "u", ""),
            (7, "u", nul), (8, "u", nul), (None, "u", nul), (10, "u", "x" * 3_000_000)]
    got = stored(spark, rows, tmp_path / "w")
    assert len(got) == len(rows) and all(r.kind == "record" for r in got.values())
    want = {1: 9, 5: 9, 7: 8, None: 8}
    for page_id, url, html in rows:
        data, r = (html or "").encode(), got[f"<urn:page:{'null' if page_id is None else page_id}>"]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        if page_id in want:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("revisit", f"<urn:page:{want[page_id]}>", b"")
        else:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, data)
    assert got["<urn:page:5>"].uri is None and got["<urn:page:2>"].uri == "a%20b%0D%0AX:%201"


def test_repeated_rows_and_empty_table(spark, tmp_path):
    rows = [(1, "u", "y" * 2000)] * 3 + [(0, "u", "y" * 2000)]
    marked = warc.mark_revisits(pages(spark, rows)).collect()
    assert sorted((r.page_id, r.record_type) for r in marked) == [(0, "revisit")] + [(1, "response")] * 3
    assert stored(spark, [], tmp_path / "none") == {}


def test_archives_are_plain_gzip(spark, tmp_path):
    stored(spark, [(i, "u", f"page {i}") for i in range(5)], tmp_path / "w")
    text = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "w").glob("part-*"))
    assert text.count(b"WARC/1.1\r\n") == 5


def record(i, body):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + body
    return warc.record_bytes("response", f"<urn:page:{i}>", "u", block, hashlib.sha1(body).hexdigest(), None, "2024-01-01T00:00:00Z")


def archive(bodies, packed):
    return [gzip.compress(record(i, b), mtime=0) if packed else record(i, b) for i, b in enumerate(bodies)]


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("damage", ["flip", "cut", "insert", "length"])
def test_later_records_are_recovered(packed, damage):
    parts = archive([f"body {i} WARC/1.1 \r\n".encode() * 50 for i in range(6)], packed)
    hurt, at = parts[2], len(parts[2]) // 2
    parts[2] = {
        "flip": hurt[:at] + bytes([hurt[at] ^ 0xFF]) + hurt[at + 1 :],
        "cut": hurt[:at],
        "insert": hurt[:at] + b"WARC/1.1\r\n\x1f\x8b\x08junk" + hurt[at:],
        "length": hurt[:10] + hurt[10:].replace(b"Content-Length: ", b"Content-Length: 9", 1) if not packed else b"\x1f\x8b\x08" + hurt[5:],
    }[damage]
    data, before = b"".join(parts), sum(map(len, parts[:2]))
    rows = list(warc.salvage(data))
    assert [r["record_id"] for r in rows if r["kind"] == "record"] == [f"<urn:page:{i}>" for i in (0, 1, 3, 4, 5)]
    assert [(r["start"], r["length"]) for r in rows if r["kind"] == "gap"] == [(before, len(parts[2]))]
    assert all(r["reason"] for r in rows if r["kind"] == "gap")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=60), min_size=1, max_size=6), st.booleans(), st.randoms(use_true_random=False))
def test_random_damage_never_invents_records_and_gaps_cover(bodies, packed, rng: random.Random):
    parts = archive(bodies, packed)
    data = bytearray(b"".join(parts))
    for _ in range(rng.randint(0, 3)):
        data[rng.randrange(len(data))] = rng.randrange(256)
    rows = list(warc.salvage(bytes(data)))
    for r in rows:
        if r["kind"] == "record":
            assert r["payload"] in bodies
    spans = [(r["start"], r["length"]) for r in rows]
    assert sum(length for _, length in spans) == len(data) and spans[0][0] == 0


def test_all_or_nothing_damaged():
    assert list(warc.salvage(b"")) == []
    assert [(r["kind"], r["length"]) for r in warc.salvage(b"no archive at all")] == [("gap", 17)]
    whole = gzip.compress(record(1, b"a") + record(2, b"b"))
    assert [r["record_id"] for r in warc.salvage(whole)] == ["<urn:page:1>", "<urn:page:2>"]


def hurt_member(level=9):
    """Seven records in one member, the fourth with a flipped byte in its payload."""
    rng = random.Random(5)
    parts = [record(i, rng.randbytes(3000)) for i in range(7)]
    parts[3] = parts[3][:2000] + bytes([parts[3][2000] ^ 0xFF]) + parts[3][2001:]
    return parts, gzip.compress(b"".join(parts), level, mtime=0)


def ids_and_gaps(data):
    rows = list(warc.salvage(data))
    return [int(r["record_id"][10:-1]) for r in rows if r["kind"] == "record"], [r for r in rows if r["kind"] == "gap"]


def test_sound_member_gives_the_records_around_a_bad_one():
    parts, member = hurt_member()
    found, gaps = ids_and_gaps(member + gzip.compress(record(9, b"next"), mtime=0))
    low = sum(map(len, parts[:3]))
    assert found == [0, 1, 2, 4, 5, 6, 9]
    assert [(g["start"], g["length"], g["reason"]) for g in gaps] == [(0, 0, f"block digest differs, inflated bytes {low} to {low + len(parts[3])} of the member")]


@pytest.mark.parametrize("level", [0, 9])
@pytest.mark.parametrize("damage", ["cut", "checksum", "flip"])
def test_failed_member_gives_the_records_before_its_fault_once(damage, level):
    parts, member = hurt_member(level)
    place = len(member) * 6 // 7 - 200
    data = {"cut": member[:place], "checksum": member[:-8] + b"\x00" * 4 + member[-4:], "flip": member[:place] + b"\xff" * 40 + member[place + 40 :]}[damage]
    next_one = gzip.compress(record(9, b"next"), mtime=0)
    found, gaps = ids_and_gaps(data + next_one)
    assert found[-1] == 9 and len(set(found)) == len(found) and {0, 1, 2, 4} <= set(found) and 3 not in found
    assert (damage != "checksum") or found == [0, 1, 2, 4, 5, 6, 9]
    assert sum(g["length"] for g in gaps) == len(data) or level == 0
    assert any(g["length"] == 0 and "inflated bytes" in g["reason"] for g in gaps)

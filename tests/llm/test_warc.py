"""WARC round trips, and salvage of damaged archives."""

import gzip
import os
import random

import pytest

from seqloom.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, kind int, first long"
PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>one</p>"), (9, "http://a/9 x\r\ny", "<p>one</p>"), (3, None, None),
    (4, "http://a/4", ""), (5, "http://b", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"),
    (None, "http://c", "<p>one</p>"), (6, "http://d", "é\U0001f600" * 90_000), (9, "http://a/9", "<p>one</p>"), (7, "u", "\x1f\x8b\x08 x"),
]


def expected(pages, least=0):
    payloads = [(p, (html or "").encode()) for p, _, html, *_ in pages]
    out = []
    for p, data in payloads:
        same = [q for q, d in payloads if d == data]
        first = max((q for q in same if q is not None), default=None)
        alone = len(same) == 1 or len(data) < least or p == first
        out.append((p, len(data), warc.base32_sha1(data), "response" if alone else "revisit", None if alone else first))
    return sorted(out, key=str)


def rows(frame):
    found = frame.where("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("compress", [True, False])
def test_odd_pages(spark, tmp_path, compress):
    frame = spark.createDataFrame([(*p, "x", 1, 1) for p in PAGES], SCHEMA).repartition(3)
    warc.write_archives(warc.with_roles(frame), str(tmp_path / "a"), compress=compress)
    back = warc.read_archives(spark, str(tmp_path / "a"))
    assert rows(back) == expected(PAGES) and back.where("kind = 'gap'").count() == 0
    texts = {bytes(r.payload).decode() for r in back.where("record_type = 'response'").collect()}
    assert texts == {p[2] or "" for p in PAGES}
    assert back.where("record_type = 'revisit' and payload is not null").count() == 0


def test_small_payloads_are_all_responses(spark, tmp_path):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_archives(warc.with_roles(frame, least=11), str(tmp_path / "a"))
    assert rows(warc.read_archives(spark, str(tmp_path / "a"), payload=False)) == expected(PAGES, 11)


def test_whole_table(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    warc.write_archives(warc.with_roles(pages), str(tmp_path / "a"))
    assert rows(warc.read_archives(spark, str(tmp_path / "a"))) == expected(map(tuple, pages.collect()))


def test_nothing(spark, tmp_path):
    frame = spark.createDataFrame([], SCHEMA)
    warc.write_archives(warc.with_roles(frame), str(tmp_path / "a"))
    assert warc.read_archives(spark, str(tmp_path / "a")).count() == 0


def records(n=12):
    rng = random.Random(3)
    return [warc.record(i, f"http://x/{i}", rng.randbytes(300 + 40 * i), None, False, "2020-01-01T00:00:00Z") for i in range(n)]


def damage(parts, packed, how):
    """The archive with some records damaged, and the numbers of those that are whole."""
    parts = [gzip.compress(p, mtime=0) for p in parts] if packed else list(parts)
    lost = {2, 3, 7}
    for i in lost:
        p = parts[i]
        if how == "flipped":
            parts[i] = p[: len(p) // 2] + bytes([p[len(p) // 2] ^ 0x55]) + p[len(p) // 2 + 1 :]
        elif how == "cut":
            parts[i] = p[: len(p) // 2]
        elif how == "noise":
            parts[i] = b"\x1f\x8b\x08WARC/1.1\r\nnothing" + os.urandom(50)
        elif how == "length" and not packed:
            parts[i] = p.replace(b"Content-Length: ", b"Content-Length: 9", 1)
        elif how == "start":
            parts[i] = b"XX" + p[2:]
    return b"".join(parts), [i for i in range(len(parts)) if i not in lost], parts


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("how", ["flipped", "cut", "noise", "length", "start", "tail"])
def test_salvage(spark, tmp_path, packed, how):
    data, whole, parts = damage(records(), packed, how)
    if how == "tail":
        data, whole = data[:-9], [0, 1, 4, 5, 6, 8, 9, 10]
        parts = [b"" if i in (2, 3, 7) else p for i, p in enumerate(parts)]
        data = b"".join(parts)[:-9]
    elif how == "length" and packed:
        return
    (tmp_path / f"x.warc{'.gz' * packed}").write_bytes(data)
    found = warc.read_archives(spark, str(tmp_path)).orderBy("offset").collect()
    assert [r.page_id for r in found if r.kind == "record"] == whole
    assert sum(r.length for r in found) == len(data)
    at = 0
    for r in found:
        assert r.offset == at and (r.reason is not None) == (r.kind == "gap")
        at += r.length
    gaps = [(r.offset, r.offset + r.length) for r in found if r.kind == "gap"]
    starts = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
    assert gaps == ([(starts[11], len(data))] if how == "tail" else [(starts[2], starts[4]), (starts[7], starts[8])])


@pytest.mark.parametrize("packed", [True, False])
def test_damaged_starts_and_embedded_records(spark, tmp_path, packed):
    inner = warc.record(77, "http://inner", b"inner", None, False, "2020-01-01T00:00:00Z")
    outer = warc.record(1, "http://outer", b"head " + inner + b" tail", None, False, "2020-01-01T00:00:00Z")
    wrong = outer.replace(b"head ", b"HEAD ")  # the digest differs, the frame is whole
    last = warc.record(2, "http://last", b"last", None, False, "2020-01-01T00:00:00Z")
    pack = gzip.compress if packed else bytes
    (tmp_path / f"x.warc{'.gz' * packed}").write_bytes(b"junk" + pack(last) + pack(wrong) + pack(outer) + pack(last))
    found = warc.read_archives(spark, str(tmp_path)).orderBy("offset").collect()
    assert [(r.kind, r.page_id, r.reason) for r in found] == [
        ("gap", None, "no version line" if not packed else found[0].reason), ("record", 2, None),
        ("gap", None, "block digest differs"), ("record", 1, None), ("record", 2, None),
    ]


def test_unfinished_files_do_not_count(spark, tmp_path):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    path = tmp_path / "a"
    warc.write_archives(warc.with_roles(frame), str(path))
    (path / "part-of-a-lost-task.warc.gz").write_bytes(gzip.compress(records(1)[0]))
    assert rows(warc.read_archives(spark, str(path))) == expected(PAGES)
    warc.write_archives(warc.with_roles(frame.limit(1)), str(path))  # a second write adds to the first
    assert warc.read_archives(spark, str(path)).count() == len(PAGES) + 1

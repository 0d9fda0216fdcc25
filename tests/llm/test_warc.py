import base64
import gzip
import hashlib
import io
import os

import pytest

from lakeops.llm import warc

from .data import tuples

PAGES = "page_id long, url string, html string, record_id string, bytes long"


def expected(rows):
    """Brute force over (page_id, html)."""
    out, largest = [], {}
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        if i is not None:
            largest[b] = max(largest.get(b, i), i)
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        to = largest.get(b)
        revisit = to is not None and (i is None or i < to)
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=repr)


def test_round_trip_matches_brute_force(spark):
    same = "<p>é same</p>" * 50
    rows = [(1, "http://a", same), (2, None, same), (3, "http://ü/ä b", "<p>other\r\n\r\n</p>"), (4, "u", None), (5, "u", ""),
            (None, "u", same), (6, "u", same), (6, "u", same), (None, "u", "lonely"), (None, "u", "lonely"),
            (-1, "u", "x" * 300_000)]
    rows = [(*r, "clash", k) for k, r in enumerate(rows)]
    got = tuples(warc.archived(spark.createDataFrame(rows, PAGES)))
    assert got == expected(rows)


def test_empty_table(spark):
    assert warc.archived(spark.createDataFrame([], PAGES)).count() == 0


def test_small_payloads_may_stay_responses(spark, tmp):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    m = warc.write_warc(df, "page_id", "url", "html", tmp + "/w", min_revisit_bytes=3).collect()
    back = warc.read_warc(spark, spark.createDataFrame(m), len(m))
    assert {r.record_type for r in back.collect()} == {"response"}
    assert {bytes(r.payload) for r in back.collect()} == {b"ab"}


def test_archive_is_one_gzip_member_per_record(spark, tmp):
    df = spark.range(20).selectExpr("id", "'http://x' as url", "repeat(cast(id as string), 100) as html").coalesce(1)
    (m,) = warc.write_warc(df, "id", "url", "html", tmp + "/w").collect()
    data = open(m.path, "rb").read()
    assert m.records == 20 and m.bytes == len(data) == os.path.getsize(m.path)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 20
    assert len(list(warc.members(io.BytesIO(data)))) == 20


@pytest.mark.parametrize("damage", [lambda d: d[:-7], lambda d: d.replace(b"payload", b"pay1oad")])
def test_damage_is_found(damage):
    raw = warc.record_bytes(1, "u", b"the payload of it")
    if damage(raw) != raw:
        with pytest.raises(ValueError):
            list(warc.members(io.BytesIO(damage(raw))))
    else:
        with pytest.raises(ValueError):
            warc.parse_record(damage(next(warc.members(io.BytesIO(raw)))))


def test_wrong_content_length_is_found():
    raw = next(warc.members(io.BytesIO(warc.record_bytes(1, "u", b"abc"))))
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"abc\r\n\r\n", b"abcd\r\n\r\n"))


def test_repeated_writing_overwrites_nothing(spark, tmp):
    """Every run of the writing tasks takes names of its own; each manifest reads back
    whole, and a lost attempt's torn archive in the folder does no harm."""
    df = spark.createDataFrame([(i, None, "x" * (i % 5) * 1000) for i in range(60)],
                               "id long, url string, html string").repartition(3)
    lazy = warc.write_warc(df, "id", "url", "html", tmp + "/w")
    first = lazy.collect()
    before = {m.path: open(m.path, "rb").read() for m in first}
    open(tmp + "/w/part-00000-0000-9-torn.warc.gz", "wb").write(b"\x1f\x8b")
    second = lazy.collect()
    assert not {m.path for m in first} & {m.path for m in second}
    assert all(open(p, "rb").read() == data for p, data in before.items())
    for m in (first, second):
        back = warc.read_warc(spark, spark.createDataFrame(m), 2)
        assert sorted(int(r.record_id) for r in back.collect()) == list(range(60))


def test_clashing_columns_and_long_payloads(spark, tmp):
    long = "é" * 3_000_000
    df = spark.createDataFrame([(1, "u", long, "a", 7, 8), (2, "u", None, "b", 7, 8)],
                               "id long, _url string, payload string, path string, _digest int, _salt int")
    m = warc.write_warc(df, "id", "_url", "payload", tmp + "/w").collect()
    back = {int(r.record_id): bytes(r.payload).decode() for r in warc.read_warc(spark, spark.createDataFrame(m), 1).collect()}
    assert back == {1: long, 2: ""}

"""WARC archives: round trips, record by record and through a session, and which records are revisits."""

import io
import struct
from collections import defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from barsieve.llm import warc
from barsieve.llm.queries import all_queries

SCHEMA = "page_id long, url string, html string"


def _expected(rows):
    """page_id, payload and the page that has it, for (page_id, html)."""
    of = defaultdict(list)
    for page, html in rows:
        of[html or ""].append(page)
    out = []
    for page, html in rows:
        head = max((p for p in of[html or ""] if p is not None), default=None)
        refers = None if page == head else head
        payload = (html or "").encode()
        out.append((page, len(payload), warc.payload_digest(payload), "revisit" if refers is not None else "response", refers))
    return out


def _written(spark, df, path, **options):
    warc.write_archives(warc.planned(df), path, **options)
    return warc.read_archives(spark, path)


def test_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html").collect()
    got = all_queries()["op13_warc"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(_expected(pages), key=repr)


def test_round_trip_of_edge_pages(spark, tmp_path):
    long = "".join(f"<p>{i}é</p>" for i in range(200_000))
    rows = [
        (1, "http://a/1", None), (2, None, ""), (3, "u", "x\r\n\r\nWARC/1.1\r\n"), (4, "a b\r\nX: y\x00", "same"),
        (9, "u", "same"), (9, "u", "same"), (5, "u", "same"), (None, "u", "same"), (None, "u", "only"), (None, None, "only"),
        (6, "u", long), (-7, "ü", "P*M\x18\x00\x00\x00\x00中"), (8, "u", long),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("head", "key", "size", "payload", "archive")})
    found = _written(spark, df, str(tmp_path / "all"), archive_bytes=5_000).collect()
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found]
    assert sorted(got, key=repr) == sorted(_expected([(r[0], r[2]) for r in rows]), key=repr)
    payloads = {(r["page_id"], bytes(r["payload"]).decode()) for r in found if r["record_type"] == "response"}
    assert payloads == {(2, ""), (3, rows[2][2]), (9, "same"), (None, "only"), (8, long), (-7, rows[11][2])}
    assert {r["url"] for r in found if r["page_id"] in (2, 4, -7)} == {None, "a%20b%0D%0AX:%20y%00", "ü"}
    assert _written(spark, df.where("false"), str(tmp_path / "none")).count() == 0


def test_records_are_frames_of_their_own(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"<html><title>page {i}</title>" + "<p>some words here</p>" * (i % 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    warc.write_archives(warc.planned(df).coalesce(1), str(tmp_path / "warc"), archive_bytes=400_000)
    archives = sorted((tmp_path / "warc").glob("archive=*/part-*"))
    assert len(archives) > 1 and all(f.parent.name.endswith(".warc.zst") for f in archives)
    seen = 0
    for file in archives:
        content = file.read_bytes()
        magic, size = struct.unpack_from("<II", content)
        assert magic == warc.DICTIONARY_MAGIC
        known = zstandard.ZstdCompressionDict(content[8 : 8 + size])
        assert known.dict_id()  # a trained one
        frames = content[8 + size :].removeprefix(warc.EMPTY_FRAME).removesuffix(warc.EMPTY_FRAME).split(warc.EMPTY_FRAME)
        one = zstandard.ZstdDecompressor(dict_data=known)
        blocks = [one.decompress(f) for f in frames]
        assert all(b.startswith(warc.VERSION) and b.endswith(b"\r\n\r\n") for b in blocks)
        # the file as a whole is one stream of the same records
        with zstandard.ZstdDecompressor(dict_data=known).stream_reader(io.BytesIO(content), read_across_frames=True) as f:
            assert f.read() == b"".join(blocks)
        seen += len(blocks) - 1
    assert seen == len(rows)


def test_damage_is_found(spark, tmp_path):
    record = warc.page_record(1, "u", "some html", None, "2020-01-01T00:00:00Z")
    whole = b"".join(f + warc.EMPTY_FRAME for f in warc.frames([record] * 3))
    assert [warc.read_page(*r)["payload"] for r in warc.records(whole)] == [b"some html"] * 3
    other = b"".join(f + warc.EMPTY_FRAME for f in warc.frames([record.replace(b"some html", b"sOme html")]))
    with pytest.raises(ValueError, match="differs"):
        [warc.read_page(*r) for r in warc.records(other)]
    with pytest.raises(ValueError, match="cut off"):
        list(warc.records(b"".join(warc.frames([record[:-6]]))))
    with pytest.raises(ValueError, match="dictionary"):
        list(warc.records(b"\0" * 16))


def test_only_payloads_of_some_size_are_shared(spark):
    rows = [(1, None, "ab"), (2, None, "ab"), (3, None, "abcdef"), (4, None, "abcdef")]
    found = warc.planned(spark.createDataFrame(rows, SCHEMA), least_bytes=3)
    assert {(r["page_id"], r["refers_to"]) for r in found.collect()} == {(1, None), (2, None), (3, 4), (4, None)}

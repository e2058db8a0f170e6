"""Archives: round trips, skipping, predicates, damage, revisits."""

import gzip
import hashlib
import json
import os

import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from surveyflow.llm import warc

LOCAL = pyarrow.fs.LocalFileSystem()
DATE = "2024-01-01T00:00:00Z"


def records(spark, blocks, kind="response"):
    rows = [({"WARC-Type": kind if i % 3 else "request", "WARC-Record-ID": f"<urn:x:{i}>", "Content-Type": None}, b) for i, b in enumerate(blocks)]
    return spark.createDataFrame(rows, "headers map<string,string>, block binary")


BLOCKS = [b"", b"a\r\n\r\nWARC/1.1\r\n\r\n", bytes(range(256)) * 40, b"x" * 300_000, b"HTTP/1.1 200 OK\r\nA: 1\r\n\r\nbody", None]


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(spark, tmp_path, compress):
    path = f"file://{tmp_path}/a"
    warc.write(records(spark, BLOCKS).repartition(3), path, compress=compress)
    rows = {r.record_id: r for r in warc.read(spark, path).collect()}
    assert len(rows) == len(BLOCKS)
    for i, block in enumerate(BLOCKS):
        row = rows[f"<urn:x:{i}>"]
        assert row.content_length == len(block or b"") and row.record_type == ("response" if i % 3 else "request")
        assert row.payload == (b"body" if i == 4 else (block or b"")) and row.target_uri is None and row.content_type is None
    assert rows["<urn:x:4>"].http_headers == {"a": "1"}
    bare = warc.read(spark, path, payloads=False).filter("content_length > 1000").collect()
    assert [r.payload for r in bare] == [None, None] and sorted(r.content_length for r in bare) == [10240, 300_000]


def test_members_are_plain_gzip():
    raw = warc.record_bytes({"WARC-Type": "resource"}, b"text" * 100)
    packed = warc.member(raw)
    assert gzip.decompress(packed + packed) == raw * 2
    assert warc._member_length(packed) == len(packed)
    assert warc._member_length(gzip.compress(raw)) is None


@pytest.mark.parametrize("compressed_by", ["skip lengths", "plain gzip", "nothing"])
def test_unwanted_blocks_are_passed_over(tmp_path, compressed_by, monkeypatch):
    squeeze = {"skip lengths": warc.member, "plain gzip": gzip.compress, "nothing": lambda raw: raw}[compressed_by]
    noise = os.urandom(1 << 20)
    raws = [warc.record_bytes({"WARC-Type": "response" if i % 4 else "warcinfo"}, noise if i % 4 else b"about") for i in range(8)]
    path = tmp_path / "a.warc"
    path.write_bytes(b"".join(map(squeeze, raws)))
    seen = []
    monkeypatch.setattr(warc, "_http", lambda block: seen.append(len(block)) or ({}, block))
    read = []
    plain = warc._Source.peek
    monkeypatch.setattr(warc._Source, "peek", lambda self, n: read.append(n) or plain(self, n))
    rows = list(warc.read_file(LOCAL, str(path), lambda row: row["record_type"] == "warcinfo", True, False))
    assert [r["payload"] for r in rows] == [b"about"] * 2 and seen == [5, 5]
    if compressed_by != "plain gzip":
        assert sum(read) < len(noise) * 2  # of 6 MB


def test_pushed_predicates(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    warc.write(records(spark, BLOCKS).repartition(2), path)
    before = spark.conf.get(warc.PUSHDOWN)
    with warc.pushdown(spark):
        df = warc.read(spark, path).filter("record_type = 'request' AND content_length >= 1 AND length(record_id) > 0")
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows = df.collect()
    assert spark.conf.get(warc.PUSHDOWN) == before
    kept = plan[plan.index("Filter") :].split("\n")[0]
    assert "length(record_id" in kept and "record_type" not in kept and "content_length" not in kept
    assert [r.record_id for r in rows] == ["<urn:x:3>"]
    without = warc.read(spark, path).filter("record_type = 'request' AND content_length >= 1").collect()
    assert [r.record_id for r in without] == ["<urn:x:3>"]


def test_predicates_as_spark_has_them(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    uris = ["http://a/1", None, "http://b/2", "http://b/ü"]
    rows = [({"WARC-Type": "response", "WARC-Target-URI": u}, b"") for u in uris]
    warc.write(spark.createDataFrame(rows, "headers map<string,string>, block binary"), path)
    plain = warc.read(spark, path)
    for text in (
        "target_uri = 'http://a/1'", "target_uri <> 'http://a/1'", "target_uri IN ('http://a/1', 'x')", "target_uri IS NULL",
        "target_uri NOT IN ('http://a/1')", "target_uri LIKE 'http://b%'", "target_uri LIKE '%/2'", "target_uri LIKE '%b/%'",
        "target_uri > 'http://b/2'", "NOT (target_uri LIKE '%2')", "target_uri <=> NULL", "content_length < 1", "target_uri IS NOT NULL",
    ):
        want = sorted(str(r.target_uri) for r in plain.filter(text).collect())
        with warc.pushdown(spark):
            got = sorted(str(r.target_uri) for r in warc.read(spark, path).filter(text).collect())
        assert got == want, text


def test_only_committed_files_are_read(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    warc.write(records(spark, [b"1", b"2"]), path)
    (tmp_path / "a" / "left-over.warc.gz").write_bytes(b"from a task that was lost")
    assert warc.read(spark, path).count() == 2
    warc.write(records(spark, [b"3"]), path)
    assert warc.read(spark, path).count() == 3
    warc.write(records(spark, [b"4"]), path, mode="overwrite")
    assert [r.payload for r in warc.read(spark, path).collect()] == [b"4"]
    warc.write(records(spark, [b"4"]).limit(0), path, mode="overwrite")
    assert warc.read(spark, path).count() == 0


def test_files_and_partitions_are_planned_by_size(spark, tmp_path):
    path = f"file://{tmp_path}/a"
    warc.write(records(spark, [os.urandom(10_000) for _ in range(30)]).coalesce(1), path, file_bytes=50_000)
    names = json.loads((tmp_path / "a" / warc.MANIFEST).read_text())["files"]
    assert len(names) >= 6 and all(size <= 50_000 for _, size in names)
    reader = warc.WarcReader(path, True, False, 100_000)
    planned = reader.partitions()
    assert sorted(p for f in planned for p in f.paths) == sorted(f"{tmp_path}/a/{n}" for n, _ in names)
    assert 3 <= len(planned) < len(names)
    assert warc.read(spark, path, partition_bytes=100_000).rdd.getNumPartitions() == len(planned)
    assert warc.read(spark, path).count() == 30


@pytest.mark.parametrize("damage", ["cut", "noise"])
def test_damage_raises_or_ends_the_file(spark, tmp_path, damage):
    whole = [warc.member(warc.record_bytes({"WARC-Type": "response"}, os.urandom(5000))) for _ in range(2)]
    data = whole[0] + (whole[1][:-2000] if damage == "cut" else b"no record at all")
    (tmp_path / "a.warc.gz").write_bytes(data)
    with pytest.raises(Exception, match=f"at {len(whole[0])}"):
        warc.read(spark, f"file://{tmp_path}").collect()
    assert warc.read(spark, f"file://{tmp_path}", on_error="stop").count() == 1
    skipped = warc.read(spark, f"file://{tmp_path}", on_error="stop", payloads=False).count()
    assert skipped == 1


def test_headers_folded_repeated_and_unlike_in_case(tmp_path):
    raw = b"WARC/1.0\r\nwarc-type: response\r\nX-Long: a\r\n  b\r\nX-Long: c\r\nCONTENT-LENGTH: 3\r\n\r\nabc\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(raw)
    (row,) = warc.read_file(LOCAL, str(tmp_path / "a.warc"), lambda row: True, True, False)
    assert row["record_type"] == "response" and row["headers"]["x-long"] == "a b" and row["payload"] == b"abc"


def brute(rows):
    """(page_id, bytes, digest, type, refers_to) by plain loops; which of equal rows responds does not show."""
    groups = {}
    for page, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    result = []
    for payload, pages in groups.items():
        digest = hashlib.sha256(payload).hexdigest()
        if len(payload) < 100:
            result += [(p, len(payload), digest, "response", None) for p in pages]
            continue
        pages = sorted(pages, key=lambda p: (p is None, p or 0))
        result.append((pages[0], len(payload), digest, "response", None))
        result += [(p, len(payload), digest, "revisit", pages[0]) for p in pages[1:]]
    return result


def ordered(rows):
    return sorted(rows, key=str)


def test_pages_with_copies_nulls_and_ties(spark, tmp_path):
    long, short, nul = "ü" * 50, "y" * 99, "z" * 200 + "\x00\r\n\r\nWARC/1.1\r\n"
    rows = [(9, long), (3, long), (3, long), (4, short), (5, short), (6, None), (7, None), (8, ""), (None, long), (None, nul), (None, nul), (1, "q" * 100_000)]
    rows += [(100 + i, nul[::-1]) for i in range(40)]
    df = spark.createDataFrame([(p, None if p == 3 else f"http://x/{p} y\r\nz", h, "a", "b") for p, h in rows], "page_id long, url string, html string, digest string, first string")
    for n, frame in enumerate((df.repartition(5), df.coalesce(1))):
        path = f"file://{tmp_path}/{n}"
        warc.write(warc.pages_to_records(frame, DATE), path)
        found = warc.page_rows(spark, path).collect()
        assert ordered(tuple(r)[:5] for r in found) == ordered(brute(rows))
        assert all(r.stated_digest == f"sha256:{r.payload_digest}" for r in found)
    warc.write(warc.pages_to_records(df.limit(0), DATE), f"file://{tmp_path}/none")
    assert warc.page_rows(spark, f"file://{tmp_path}/none").count() == 0


def test_refers_to_names_a_record(spark, tmp_path):
    df = spark.createDataFrame([(i, "u", "same" * 50) for i in range(5)], "page_id long, url string, html string")
    warc.write(warc.pages_to_records(df, DATE), f"file://{tmp_path}")
    read = warc.read(spark, f"file://{tmp_path}")
    first = read.filter("record_type = 'response'").first()
    again = read.filter("record_type = 'revisit'")
    assert again.count() == 4 and again.filter(F.col("refers_to") != first.record_id).count() == 0
    assert read.select("record_id").distinct().count() == 5

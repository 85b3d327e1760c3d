import gzip
import hashlib
import io
import json
from base64 import b32encode

import pytest
from pyspark.sql import functions as F

from lettrine.llm import queries, warc

SCHEMA = "page_id long, url string, html string, record_type int, payload string"
PAGES = [
    (5, "http://a/5", "same <p>é text</p>"), (3, "http://a/3", "same <p>é text</p>"), (9, None, "same <p>é text</p>"), (1, "http://a/ü?x=1\r\nX-Page-Id: 7", "other"), (2, "", ""), (4, "http://a/4", None),
    (6, "http://a/6", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"), (7, "http://a/7", "\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\0\n"), (8, "http://a/8", "x" * 3_000_000), (None, "http://a/none", "other"), (None, "n", "alone"), (10, "http://a/10", "same <P>é text</P>"), (3, "http://a/3", "same <p>é text</p>"),
]


def wanted(pages, least=0):
    out = []
    for page, _, html in pages:
        data = (html or "").encode()
        equal = [p for p, _, h in pages if (h or "").encode() == data and p is not None]
        first = min(equal, default=None)
        refers = first if len(data) >= least and first is not None and page != first else None
        out.append((page, len(data), b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def table(spark, pages):
    return spark.createDataFrame([(*p, 1, "x") for p in pages], SCHEMA)


def records(path):
    """Whole records of a WARC file by a plain reading of all of it."""
    data, out = gzip.decompress(path.read_bytes()), []
    while data:
        top, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in top.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        assert top.startswith(b"WARC/1.1\r\n") and rest[n : n + 4] == b"\r\n\r\n"
        out.append((fields, rest[:n]))
        data = rest[n + 4 :]
    return out


@pytest.mark.parametrize("pages", [PAGES, [], PAGES[:1]])
def test_query(spark, tmp_path, pages):
    table(spark, pages).write.parquet(str(tmp_path / "pages.parquet"))
    found = queries.op12_warc(spark, str(tmp_path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, found.collect()), key=repr) == wanted(pages)


def test_files_and_payloads(spark, tmp_path):
    found = warc.archived(table(spark, PAGES), folder=str(tmp_path)).collect()
    payloads = {(r["page_id"], r["url"]): r["payload"] for r in found}
    assert bytes(payloads[3, "http://a/3"]) == "same <p>é text</p>".encode() and payloads[5, "http://a/5"] is None and bytes(payloads[2, ""]) == b"" and payloads[4, "http://a/4"] is None
    assert bytes(payloads[8, "http://a/8"]) == b"x" * 3_000_000 and (1, "http://a/ü?x=1%0D%0AX-Page-Id: 7") in payloads and all(r["intact"] for r in found)
    whole, single = sorted((tmp_path / "whole").glob("*.gz")), sorted((tmp_path / "records").glob("*.gz"))
    assert len(whole) == len(single) > 0
    of = lambda paths: sorted((repr(r) for p in paths for r in records(p)))
    assert of(whole) == of(single)  # every record word for word
    for path in single:
        data = path.read_bytes()
        entries = [json.loads(line) for line in path.with_name(path.name + ".index.jsonl").read_text().splitlines()]
        assert sum(e["length"] for e in entries) == len(data) and [e["number"] for e in entries] == list(range(len(entries)))
        for e, (fields, _) in zip(entries, records(path), strict=True):
            member = gzip.GzipFile(fileobj=io.BytesIO(data[e["offset"] : e["offset"] + e["length"]])).read()
            assert member.startswith(b"WARC/1.1\r\n") and fields["WARC-Record-ID"] == e["record_id"] and fields["WARC-Type"] == e["record_type"]
    named = {f["WARC-Record-ID"] for p in whole for f, _ in records(p) if f["WARC-Type"] == "response"}
    assert {f["WARC-Refers-To"] for p in whole for f, _ in records(p) if f["WARC-Type"] == "revisit"} <= named


def test_small_payloads_are_never_revisited(spark, tmp_path):
    found = warc.archived(table(spark, PAGES), payload=False, least=10, folder=str(tmp_path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, found.collect()), key=repr) == wanted(PAGES, least=10)


def test_archives_roll_over(spark, tmp_path):
    rows = warc.page_rows(table(spark, [(i, "u", f"page {i} " * 50) for i in range(200)]))
    files = warc.write_archives(rows, str(tmp_path / "whole"), size=10_000)
    index = warc.normalise(files, str(tmp_path / "records"))
    assert files.count() > 8 and index.where("record_type = 'response'").count() == 200
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_records(index).where("page_id is not null").collect()} == {i: f"page {i} " * 50 for i in range(200)}


def foreign(n):
    return [warc.record([("WARC-Type", "resource"), ("WARC-Record-ID", f"<{i}>"), ("Content-Type", "text/plain")], b"block %d " % i * 4000) for i in range(n)]


def test_foreign_files(spark, tmp_path):
    """One member, many members, members that cut records, padding, plain text, nothing at all, and streams that break off."""
    blocks = foreign(6)
    whole = b"".join(blocks)
    zipped = gzip.compress(whole)
    cases = {"one": zipped, "many": b"".join(map(gzip.compress, blocks)), "across": gzip.compress(whole[:70_001]) + gzip.compress(whole[70_001:]), "padded": gzip.compress(blocks[0]) + b"\0" * 600_000 + gzip.compress(blocks[1]) + b"\0" * 9, "plain": whole, "empty": b"", "cut": gzip.compress(whole, 0)[:100_000], "short": gzip.compress(whole[:100_000]), "other": gzip.compress(b"not a record\r\n" * 9), "endless": gzip.compress(b"WARC/1.1\r\nA: b\r\n"), "long": gzip.compress(b"WARC/1.1\r\n" + b"a" * 200_000)}
    for name, data in cases.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(data)
    files = spark.createDataFrame([(f"file://{tmp_path}/{n}.warc.gz",) for n in cases], "path string")
    index = warc.normalise(files, str(tmp_path / "records"))
    got = {}
    for path in (tmp_path / "records").glob("*.gz"):
        got.setdefault(len(records(path)), 0)
        got[len(records(path))] += 1
    assert got == {6: 3, 3: 2, 2: 1, 0: 5}  # one, many, across; cut, short; padded; the others
    errors = {r["path"].rsplit("/", 1)[1].split(".")[0]: r["error"] for r in index.where("error is not null").collect()}
    assert set(errors) == {"plain", "cut", "short", "other", "endless", "long"} and "within" in errors["cut"] and "within" in errors["short"]
    texts = [bytes(r["payload"]) for r in warc.read_records(index).collect()]
    assert len(texts) == 26 and set(texts) == {b"block %d " % i * 4000 for i in range(6)}


def test_a_changed_payload_is_noticed():
    data = warc.page_record(1, "u", None, 5, hashlib.sha1(b"hello").hexdigest(), b"hello")
    assert warc.parsed_record(data, False)[-1] is True
    assert warc.parsed_record(data.replace(b"hello", b"hallo"), False)[-1] is False
    assert warc.parsed_record(data, True)[-1] == b"hello"


def test_a_payload_of_a_third_of_all_pages_is_dealt_to_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("html"))
    rows = warc.page_rows(pages).withColumn("task", F.spark_partition_id())
    assert rows.where("refers_to = 0").count() == 999
    hot = rows.where("refers_to = 0 or page_id = 0").groupBy("task").count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(hot) > 1 and max(r["count"] for r in hot) < 900

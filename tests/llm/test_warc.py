import base64
import gzip
import hashlib

import pyarrow.fs as fs
import pytest

from quayside.llm import warc as w

PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>ünï</p>"), (3, "http://c/", "<p>one</p>"), (4, None, None), (5, "http://e/", ""), (6, "http://f/\r\nWARC-Type: evil", "x\r\n\r\nWARC/1.1\r\n\r\n"),
    (7, "http://g/", "long " * 300_000), (8, "http://h/", "<p>one</p>"), (None, "http://i/", "<p>one</p>"), (9, "http://j/", "twice"), (9, "http://j/", "twice"),
]
SCHEMA = "page_id long, url string, html string, type string"


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "archives")
    w.write_archives(spark.createDataFrame([(*p, "mine") for p in PAGES], SCHEMA).repartition(3), path, "2024-01-01T00:00:00Z")
    return path


def test_round_trip(spark, archives):
    rows = w.read_archives(spark, archives, verify=True).collect()
    assert len(rows) == len(PAGES)
    payload = {f"urn:page_id:{'' if i is None else i}": (html or "").encode() for i, _, html in PAGES}
    for r in rows:
        own = payload[r["record_id"]]
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(own).digest()).decode()
        assert r["payload_bytes"] == len(own)
        same = [i for i, _, html in PAGES if i is not None and (html or "").encode() == own]
        response = r["record_id"] == f"urn:page_id:{max(same)}"
        assert r["type"] == ("response" if response else "revisit")
        assert r["payload"] == (own if response else None)
        assert r["refers_to"] == (None if response else f"urn:page_id:{max(same)}")


def test_pushed_filters_and_headers_only(spark, archives):
    found = w.read_archives(spark, archives, "record_id string, payload_bytes long, type string").where("type = 'revisit' and record_id in ('urn:page_id:1', 'urn:page_id:7')")
    assert [(r["record_id"], r["payload_bytes"]) for r in found.collect()] == [("urn:page_id:1", 10)]
    assert w.read_archives(spark, archives).where("target_uri like 'http://g%'").count() == 1


def test_payloads_not_wanted_are_not_decoded(archives, monkeypatch):
    class Schema:
        def fieldNames(self):
            return ["record_id", "type"]

    decoded = []
    real = w._Stream._more

    def counting(self):
        before = len(self.ready)
        more = real(self)
        decoded.append(len(self.ready) - before)
        return more

    monkeypatch.setattr(w._Stream, "_more", counting)
    reader = w.WarcReader({"path": archives}, Schema())
    assert list(reader.pushFilters([w.EqualTo(("type",), "response"), w.EqualTo(("payload_bytes",), 1)])) == [w.EqualTo(("payload_bytes",), 1)]
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert {r["type"] for r in rows} == {"response"}
    assert sum(decoded) < 1_000_000 < len("long " * 300_000)


def test_small_payloads_are_responses(spark):
    rows = w.with_revisits(spark.createDataFrame([(*p, "") for p in PAGES], SCHEMA), min_bytes=11).collect()
    assert {r["record_id"]: r["type"] for r in rows if r["payload_bytes"] < 11} == {f"urn:page_id:{i}": "response" for i in (1, 3, 4, 5, 8, 9, "")}


def test_plain_and_foreign_gzip_archives(spark, tmp_path, archives):
    data = b"".join(gzip.decompress(fs.LocalFileSystem().open_input_file(i.path).read()) for i in fs.LocalFileSystem().get_file_info(fs.FileSelector(archives)) if i.path.endswith(".gz"))
    records = [b"WARC/1.1\r\nWARC-Type" + r for r in data.split(b"WARC/1.1\r\nWARC-Type")[1:]]
    for name, content in (("a.warc", data), ("b.warc.gz", b"".join(map(gzip.compress, records)))):
        folder = tmp_path / name[0]
        folder.mkdir()
        (folder / name).write_bytes(content)
        rows = w.read_archives(spark, str(folder), verify=True).collect()
        assert sorted(map(str, rows)) == sorted(map(str, w.read_archives(spark, archives).collect()))
        assert w.read_archives(spark, str(folder), "record_id string").count() == len(PAGES)


def test_a_changed_payload_is_found(spark, tmp_path):
    row = {"type": "response", "record_id": "urn:x:1", "payload": b"abc", "payload_digest": w.digest_of(b"abd"), "payload_bytes": 3}
    (tmp_path / "x.warc.gz").write_bytes(w.member(w.record(row), 6))
    assert w.read_archives(spark, str(tmp_path)).count() == 1
    with pytest.raises(Exception, match="digest"):
        w.read_archives(spark, str(tmp_path), verify=True).collect()


def test_empty_table_and_failed_write(spark, tmp_path):
    w.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"), "d")
    assert w.read_archives(spark, str(tmp_path / "none")).count() == 0
    frame = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    with pytest.raises(Exception):
        w.with_revisits(frame).withColumn("date", w.F.expr("string(raise_error('no'))")).write.format("warc").mode("append").save(str(tmp_path / "failed"))
    assert not [p for p in tmp_path.glob("failed/**/*") if p.is_file()]

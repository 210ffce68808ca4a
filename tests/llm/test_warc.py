import base64
import gzip
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from encore.llm import warc

SF = "/root/testdata/sf0.001"
LONG = "Ünïcode and 0123456789 " * 60_000


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "http://a", "same"), (2, None, "same"), (3, "http://c\r\nX: y z", "same"), (3, "http://c2", "same"), (4, "u", None), (5, "u", ""),
            (None, "u", "same"), (None, "u", "alone"), (6, "ü", LONG), (7, "u", "WARC/1.0\r\n\r\nGET\r\n\r\n"), (8, "u", "short")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit(1) for c in ("id", "payload", "key", "keeper", "found", "again", "path", "n")})


def expected(rows, min_bytes=0):
    """[(id, bytes, digest, type, refers to)], sorted."""
    out, keeper = [], {}
    for i, html in rows:
        h = (html or "").encode()
        keeper.setdefault(h, []).append(i)
    for i, html in rows:
        h = (html or "").encode()
        known = [x for x in keeper[h] if x is not None]
        top = max(known) if known else None
        again = len(keeper[h]) > 1 and len(h) >= min_bytes and i != top
        out.append((i, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


def result(records):
    rows = records.select(warc.id_of(F.col("record_id")).cast("long").alias("id"), "payload_bytes", "payload_digest", "type",
                          warc.id_of(F.col("refers_to")).cast("long").alias("to")).collect()
    return sorted((tuple(r) for r in rows), key=str)


def pairs(df):
    return [(r["page_id"], r["html"]) for r in df.collect()]


@pytest.mark.parametrize("split", [997, 20_000, 1 << 30])
def test_any_split_reads_every_record_once(pages, split):
    manifest = warc.write_warc(pages.repartition(2), "page_id", "url", "html")
    records = warc.read_warc(manifest, split_bytes=split)
    assert result(records) == expected(pairs(pages))
    assert warc.uncovered(records, manifest).count() == 0
    assert {(r["uri"], r["payload"].decode()) for r in records.collect()} == {(r["url"], r["html"]) for r in pages.collect()}


@pytest.mark.parametrize("min_bytes", [0, 3, 5])
def test_odd_rows(odd, min_bytes):
    manifest = warc.write_warc(odd, "page_id", "url", "html", min_bytes=min_bytes)
    for payloads in (True, False):
        assert result(warc.read_warc(manifest, split_bytes=300, payloads=payloads)) == expected(pairs(odd), min_bytes)
    held = {r["record_id"]: r for r in warc.read_warc(manifest).collect()}
    assert held["<urn:row:6>"]["payload"].decode() == LONG and held["<urn:row:2>"]["uri"] is None
    assert held["<urn:row:3>"]["uri"] in ("http://c%0D%0AX:%20y%20z", "http://c2")


def test_archives_are_plain_gzip_and_roll_over(pages):
    manifest = warc.write_warc(pages.coalesce(1), "page_id", "url", "html", archive_bytes=10_000).collect()
    assert len(manifest) > 3 and sum(r["records"] for r in manifest) == pages.count()
    for r in manifest:
        fs, place = warc._open(r["path"])
        raw = fs.open_input_file(place).read()
        assert len(raw) == r["bytes"]
        assert gzip.decompress(raw).count(b"WARC/1.0\r\n") >= r["records"]
    assert len({r["path"] for r in manifest}) == len(manifest)


def test_archives_from_elsewhere(spark, tmp_path):
    """A folder of archives; a record of another kind, a torn record and bytes between records."""
    a = warc.record("response", "<urn:row:1>", "u", "d", 5, "X", b"hello")
    info = zlib.compressobj(9, zlib.DEFLATED, 31)
    info = info.compress(b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n") + info.flush()
    (tmp_path / "x.warc.gz").write_bytes(info + a[:-9] + b"junk" + warc.MAGIC + a + b"\x1f" + a)
    manifest = warc.list_archives(spark, str(tmp_path))
    for split in (50, 1 << 20):
        records = warc.read_warc(manifest, split_bytes=split)
        assert sorted((r["type"], bytes(r["payload"])) for r in records.collect()) == [("response", b"hello")] * 2 + [("warcinfo", b"abc")]
        assert warc.uncovered(records, manifest).collect()[0]["bytes"] == len(a) - 9 + 4 + 3 + 1


def test_each_place_is_owned_by_one_range():
    members = [warc.record("response", f"<urn:row:{i}>", "u", "d", 3 * i, "X", b"abc" * i) for i in range(30)]
    raw = b"".join(members)
    for split in (1, 2, 7, 100, 333):
        f = io.BytesIO(raw)
        starts = [r["offset"] for s in range(0, len(raw), split) for r in warc.records_in(f, s, min(len(raw), s + split))]
        assert starts == [sum(map(len, members[:i])) for i in range(30)]


def test_nothing(pages):
    manifest = warc.write_warc(pages.limit(0), "page_id", "url", "html")
    assert manifest.count() == 0 and warc.read_warc(manifest).count() == 0

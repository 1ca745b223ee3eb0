"""WARC round trips."""

import hashlib

from panelcast.llm import warc as W


def expected(rows):
    groups = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000:
            groups.setdefault(b, []).append(i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        ids = [x for x in groups.get(b, []) if x is not None]
        revisit = len(groups.get(b, [])) > 1 and ids and i != max(ids)
        out.append((str(i), len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", max(ids) if revisit else None))
    return sorted(out, key=str)


def test_round_trip_with_nulls_copies_and_awkward_payloads(spark, tmp_path):
    big = "ü" * 600 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    rows = [(1, "http://a/\r\nX: y", big), (5, "http://a/", big), (3, None, big), (2, "u", None), (4, "u", ""), (6, "u", "short"),
            (7, "u", "short"), (8, "u", "x" * 999), (9, "u", "x" * 999), (10, "u", "x" * 1000), (11, "u", "x" * 1000),
            (12, "u", "<p>\r\n\r\n</p>\x00 "), (None, "u", big), (13, "u", "y" * 3_000_000), (14, "u", "z" * 2000), (14, "v", "z" * 2000)]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id bigint, url string, html string, digest string, n int")
    got = sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in W.round_trip(df, str(tmp_path / "w")).collect()), key=str)
    assert got == expected(rows)
    back = W.read_warc(spark, str(tmp_path / "w"), verify=True)
    stored = {r.record_id: bytes(r.payload) for r in back.where("record_type = 'response'").collect()}
    assert stored["urn:record:5"].decode() == big and stored["urn:record:4"] == b""
    assert back.where("record_type = 'revisit' and refers_to = 'urn:record:5'").count() == 3
    assert back.where("record_type in ('revisit') and payload is not null").count() == 0


def test_gzip_and_pruned_columns(spark, tmp_path):
    df = spark.createDataFrame([(i, f"http://h/{i}", "t" * i) for i in range(40)], "page_id bigint, url string, html string")
    path = W.write_warc(df, str(tmp_path / "z"), compression="gzip")
    rows = W.read_warc(spark, path, "target_uri string, payload_bytes bigint").collect()
    assert sorted((r.payload_bytes, r.target_uri) for r in rows) == [(i, f"http://h/{i}") for i in range(40)]


def test_predicates_reach_the_reader():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In
    from pyspark.sql.types import StringType, StructType

    r = W.WarcReader(StructType().add("record_type", StringType()), {"path": "/x"})
    rest = list(r.pushFilters([EqualTo(("record_type",), "response"), In(("target_uri",), ("a", "b")), GreaterThan(("date",), "2")]))
    assert len(rest) == 1 and r.wanted == {"record_type": {"response"}, "target_uri": {"a", "b"}}


def test_empty_table(spark):
    assert W.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0

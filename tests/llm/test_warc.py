import io

from pyspark.sql import functions as F

from shelfprice.llm import warc
from shelfprice.llm.common import scratch

BIG = "é" * 80  # 160 bytes


def test_round_trip_and_revisits(spark):
    rows = [(5, "http://a/%20 x\n", BIG), (2, None, BIG), (9, "u", BIG), (9, "u", BIG), (None, "n", BIG),
            (1, "s", "short"), (3, "s", "short"), (4, "e", None), (6, "e", ""), (7, "cr", "\r\n\r\nWARC/1.1" * 20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumn("record_type", F.lit("clash"))
    path = scratch(spark, "t")
    marked = warc.mark_revisits(pages, F.col("page_id"), F.col("html"))
    warc.write_archives(marked.select("record_type", F.col("page_id").alias("record_id"),
                                      F.col("url").alias("target_uri"), "payload_digest", "payload_length",
                                      "refers_to", "payload"), path, roll_bytes="200")
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(rows)
    by = {r.record_id: r for r in got}
    assert by["2"].record_type == "response" and bytes(by["2"].payload) == BIG.encode()
    assert {(r.record_type, r.refers_to) for r in got if r.record_id in ("5", "9", None)} == {("revisit", "2")}
    assert sum(r.record_id == "9" for r in got) == 2
    assert by["1"].record_type == by["3"].record_type == "response" and bytes(by["4"].payload) == b""
    assert by["5"].target_uri == "http://a/%20 x\n" and by["2"].target_uri is None
    assert bytes(by["7"].payload) == b"\r\n\r\nWARC/1.1" * 20 and by["9"].payload_length == 160
    only = warc.read_archives(spark, path, ["record_id", "record_type"]).where("record_type = 'revisit'")
    assert sorted(r.record_id or "" for r in only.collect()) == ["", "5", "9", "9"]
    assert warc.read_archives(spark, path).where("record_id in ('1','3') and payload is not null").count() == 2


def test_unwanted_payloads_are_skipped():
    def row(t, n):
        return {"record_type": t, "record_id": "1", "target_uri": None, "payload_digest": "x",
                "payload_length": n, "refers_to": "1", "payload": b"y" * n}
    data = b"".join(warc.record_bytes(row("response", n), "d") for n in (10, 3_000_000, 5))
    got = list(warc.records(io.BytesIO(data), True, lambda r: r["payload_length"] < 100))
    assert [len(r["payload"]) for r in got] == [10, 5]
    assert "payload" not in next(warc.records(io.BytesIO(data), False, lambda r: True))


def test_reader_takes_header_filters():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In
    reader = warc.WarcReader("/nowhere", warc.SCHEMA, {})
    rest = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), In(("record_id",), ("1",)),
                                    GreaterThan(("payload_length",), 3), EqualTo(("payload",), b"")]))
    assert len(rest) == 2 and len(reader.tests) == 2
    assert reader.partitions()[0].files == []


def test_empty(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    marked = warc.mark_revisits(empty, F.col("page_id"), F.col("html"))
    path = scratch(spark, "t")
    warc.write_archives(marked.select("record_type", F.col("page_id").alias("record_id"),
                                      F.col("url").alias("target_uri"), "payload_digest", "payload_length",
                                      "refers_to", "payload"), path)
    assert warc.read_archives(spark, path).count() == 0

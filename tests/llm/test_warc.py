"""Archives: round trip, revisits, and version lines inside payloads."""

import random

from relayframe.llm import warc
from relayframe.session import scratch_path

SCHEMA = "page_id long, url string, html string, payload string, file string"


def round_trip(spark, rows):
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    path = scratch_path(spark, "warc-test")
    warc.write_pages(pages, path)
    return warc.read_records(spark, path).withColumn("page_id", warc.page_of("record_id")).collect()


def test_payloads_with_version_lines_come_back_whole(spark):
    rng = random.Random(3)
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    parts = ["<p>x</p>", warc.MAGIC, fake, warc.END, "é日本", "\n", "Content-Length: 9", ""]
    html = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(60)]
    html = [h + f"<!-- {i} -->" for i, h in enumerate(html)]
    got = round_trip(spark, [(i, f"http://a/{i}\r\nX: y", h, "clash", "clash") for i, h in enumerate(html)])
    assert {r.page_id: r.payload for r in got} == dict(enumerate(html))
    assert len(got) == len(html)
    assert {r.target_uri for r in got} == {f"http://a/{i}X: y" for i in range(60)}


def test_revisits_nulls_and_repeated_rows(spark):
    long = "y" * 100
    rows = [(7, "u", long), (3, "u", long), (3, "u", long), (9, None, None), (None, "u", long), (8, "u", "short"), (6, "u", "short")]
    got = round_trip(spark, [(*r, None, None) for r in rows])
    seen = sorted((str(r.page_id), r.warc_type, str(r.refers_to), r.http_length, r.payload) for r in got)
    first = "<urn:x-page:3>"
    assert seen == sorted(
        [
            ("7", "revisit", first, 100, ""),
            ("3", "response", "", 100, long),
            ("3", "response", "", 100, long),
            ("None", "revisit", first, 100, ""),
            ("9", "response", "", 0, ""),
            ("8", "response", "", 5, "short"),
            ("6", "response", "", 5, "short"),
        ]
    )


def test_empty_table_and_very_long_payload(spark):
    assert round_trip(spark, []) == []
    long = "a" * 3_000_000 + warc.MAGIC
    assert round_trip(spark, [(1, "u", long, None, None)])[0].payload == long


def test_uncompressed_archive_in_splits(spark):
    pages = spark.createDataFrame([(i, "u", f"{i}{warc.MAGIC}" * 20) for i in range(200)], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    warc.write_pages(pages, path)
    plain = scratch_path(spark, "warc-plain")
    spark.read.text(path, wholetext=True).coalesce(1).write.option("lineSep", "|").text(plain)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        pieces = warc._pieces(spark, plain)
        assert pieces.select("block").distinct().count() > 3
        reached = warc.reachable(warc.candidates(pieces)).count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # Only the first of the joined files is followed past its end by a stray byte.
    assert reached >= 200 // 8


def test_scans_that_pack_files_differently_lose_nothing(spark, monkeypatch):
    """Files go to other partitions of a scan once the chain is known."""
    cost = "spark.sql.files.openCostInBytes"
    before, reachable = spark.conf.get(cost), warc.reachable

    def reachable_then_repack(nodes):
        found = reachable(nodes)
        spark.conf.set(cost, "128m")  # every file in a partition of its own
        return found

    monkeypatch.setattr(warc, "reachable", reachable_then_repack)
    spark.conf.set(cost, "1")
    limit = spark.conf.get("spark.sql.files.minPartitionNum", None)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        pages = [(i, f"http://a/{i}", f"<p>{i}</p>" * (i % 7 + 1), "clash", "clash") for i in range(40)]
        got = round_trip(spark, pages)
    finally:
        spark.conf.set(cost, before)
        spark.conf.unset("spark.sql.files.minPartitionNum") if limit is None else spark.conf.set("spark.sql.files.minPartitionNum", limit)
    assert sorted((r.page_id, r.payload) for r in got) == [(i, h) for i, _, h, _, _ in pages]

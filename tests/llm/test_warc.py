import io
import struct

import compare
import pytest
import zstandard
from pyspark.sql import functions as F

from trackstats.llm import warc
from trackstats.llm.registry import ORACLES


def pages(spark):
    rows = [(5, "http://a", "same payload", "x"), (3, "http://b", "same payload", "y"), (9, None, "same payload", None),
            (1, "http://c\r\nX: y", None, ""), (2, "", "", ""), (7, "u", "\r\n\r\nWARC/1.1\r\n\r\n é \x00", ""),
            (3, "http://b", "same payload", "again"), (None, "n", "nobody", ""), (8, "big", "long text " * 300_000, "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, hex string").withColumn("owner", F.lit(1))


def test_round_trip(spark, tmp_path):
    df = pages(spark).repartition(3)
    made = warc.write_archives(df, f"file:{tmp_path}/w")
    got = warc.read_archives(made).collect()
    assert not [r.problem for r in got if r.problem] and len(got) == df.count() == sum(r.records for r in made.collect())
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    assert {r.record_type for r in by[3]} == {"response"} and len(by[3]) == 2
    assert [(by[i][0].record_type, by[i][0].refers_to) for i in (5, 9)] == [("revisit", 3), ("revisit", 3)]
    assert (by[1][0].record_type, by[2][0].refers_to, by[2][0].payload_bytes) == ("response", 1, 0)
    html = {r.page_id: (r.html or "").encode() for r in df.collect()}
    for r in got:
        assert r.payload_bytes == len(html[r.page_id]) and r.payload_digest == warc.digest_of(html[r.page_id])
        assert r.record_type == "revisit" or bytes(r.payload) == html[r.page_id]


def test_small_payloads_are_all_responses(spark, tmp_path):
    made = warc.write_archives(pages(spark), f"file:{tmp_path}/w", revisit_from=13)
    assert {r.record_type for r in warc.read_archives(made).collect()} == {"response"}


def test_query_equals_sql_and_archives_hold_a_dictionary(spark, tmp_path):
    folder = "/root/testdata/sf0.01"
    assert compare.difference(warc.op9_warc_round_trip(spark, folder), compare.connect(folder), ORACLES["op9_warc_round_trip"]) is None
    made = warc.write_archives(spark.read.parquet(f"{folder}/pages.parquet"), f"file:{tmp_path}/w").collect()
    data = open(made[0].archive.removeprefix("file:"), "rb").read()
    assert struct.unpack("<I", data[:4])[0] == warc.DICTIONARY_MAGIC and data[8:12] == b"\x37\xa4\x30\xec"
    assert sum(1 for _ in warc.frames(io.BytesIO(data), 1000)) == made[0].records


@pytest.mark.parametrize("change, problem", [
    (lambda r: r, None), (lambda r: r.replace(b"WARC/1.1", b"WARC/9"), "version"),
    (lambda r: r.replace(b"WARC-Date", b"WARC-Day"), "missing warc-date"), (lambda r: r[:-1], "content length"),
    (lambda r: r.replace(b"payload text", b"payload tExt"), "payload digest"),
    (lambda r: r.replace(b"WARC-Type: response", b"no colon here"), "header line"), (lambda r: b"", "version")])
def test_faults_are_reported(change, problem):
    made = warc.record(4, "http://x", b"payload text", warc.digest_of(b"payload text"), None)
    assert warc.parse(change(made))["problem"] == problem


def test_cut_off_archive():
    data = zstandard.ZstdCompressor().compress(b"x" * 1000)
    with pytest.raises(ValueError):
        list(warc.frames(io.BytesIO(data + data[:-3])))


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(empty, f"file:{tmp_path}/w")).count() == 0


def test_records_that_fail_are_returned_and_names_do_not_repeat(spark, tmp_path):
    rows = [(3, "u", "one"), (3, "u", "one"), (None, "v", "two"), (None, "w", "three")]
    made = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file:{tmp_path}/w").collect()
    path = made[0].archive.removeprefix("file:")
    with open(path, "rb") as f:
        records = list(warc.frames(f))
    names = [next(x for x in r.split(b"\r\n") if x.startswith(b"WARC-Record-ID")) for r in records]
    assert len(set(names)) == len(rows)
    with open(path, "wb") as f:
        f.writelines(zstandard.ZstdCompressor().compress(r.replace(b"three", b"thr3e")) for r in records)
    got = warc.read_archives(spark.createDataFrame([(f"file:{path}",)], "archive string")).collect()
    assert sorted(r.problem or "" for r in got) == ["", "", "", "payload digest"]


def test_one_payload_of_most_rows_is_split(spark, tmp_path):
    pages = spark.range(4000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                     F.when(F.col("id") % 10 < 7, F.lit("x" * 500)).otherwise(F.concat(F.lit("y" * 500), "id")).alias("html"))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "20"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        made = warc.write_archives(pages.repartition(16), f"file:{tmp_path}/w").collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(r.records for r in made) == 4000 and max(r.records for r in made) < 1600

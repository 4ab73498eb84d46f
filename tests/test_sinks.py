import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import lines_df
from sparkloom.sinks import tables, text
from sparkloom.sources import readers


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_text_roundtrip_keeps_blank_and_quoted_lines(spark, out_dir):
    path = out_dir("text")
    src = lines_df(spark, ["a", "", 'say "hi", ok', "  padded  "])
    text.write_lines(src, path)
    assert sorted(r.value for r in readers.read_lines(spark, path).collect()) == sorted(["a", "", 'say "hi", ok', "  padded  "])


def test_header_on_every_shard(spark, out_dir):
    path = out_dir("hdr")
    src = lines_df(spark, [f"row{i}" for i in range(20)])
    text.write_lines(src, path, header="h1,h2", num_shards=3)
    files = [f for f in os.listdir(local(path)) if f.startswith("part-")]
    firsts = []
    for f in files:
        with open(os.path.join(local(path), f)) as fh:
            content = fh.read().splitlines()
        if content:
            firsts.append(content[0])
            assert content.count("h1,h2") == 1
    assert firsts == ["h1,h2"] * len(firsts) and len(firsts) == 3


def test_header_on_empty_output(spark, out_dir):
    path = out_dir("hdr-empty")
    text.write_lines(lines_df(spark, ["x"]).where("false"), path, header="only,header")
    assert [r.value for r in readers.read_lines(spark, path).collect()] == ["only,header"]


def test_tagged_sink(spark, out_dir):
    path = out_dir("tags")
    df = spark.createDataFrame([("a:[1]", "below"), ("shark:[2]", "above"), ("shark:[2]", "marker")], "line string, tag string")
    text.write_tagged(df, path, tag="tag", col="line")
    assert sorted(d for d in os.listdir(local(path)) if d.startswith("tag=")) == ["tag=above", "tag=below", "tag=marker"]
    got = sorted((r.tag, r.value) for r in spark.read.text(path).collect())
    assert got == [("above", "shark:[2]"), ("below", "a:[1]"), ("marker", "shark:[2]")]


def _days(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v string, day date")


def test_partition_overwrite_replaces_only_touched_days(spark, out_dir):
    path = out_dir("parts")
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    tables.write_day_partitions(_days(spark, [(1, "a", d1), (2, "b", d2), (3, "c", d2)]), path, "day")
    tables.write_day_partitions(_days(spark, [(4, "new", d2), (5, "x", d3)]), path, "day")
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("id", "v", "day").collect())
    assert got == [(1, "a", d1), (4, "new", d2), (5, "x", d3)]


def test_partition_null_fails_and_commits_nothing(spark, out_dir):
    path = out_dir("parts-null")
    tables.write_day_partitions(_days(spark, [(1, "a", dt.date(2024, 1, 1))]), path, "day")
    with pytest.raises(Exception):
        tables.write_day_partitions(_days(spark, [(2, "b", dt.date(2024, 1, 1)), (3, "c", None)]), path, "day")
    assert [r.id for r in spark.read.parquet(path).collect()] == [1]


def test_partition_null_divert(spark, out_dir):
    path, rej = out_dir("parts-div"), out_dir("rejects")
    tables.write_day_partitions(_days(spark, [(2, "b", dt.date(2024, 1, 1)), (3, "c", None)]), path, "day",
                                on_null="divert", reject_target=rej)
    assert [r.id for r in spark.read.parquet(path).collect()] == [2]
    assert [r.id for r in spark.read.parquet(rej).collect()] == [3]


def test_partition_empty_input_keeps_table(spark, out_dir):
    path = out_dir("parts-empty")
    tables.write_day_partitions(_days(spark, [(1, "a", dt.date(2024, 1, 1))]), path, "day")
    tables.write_day_partitions(_days(spark, [(1, "a", dt.date(2024, 1, 1))]).where("false"), path, "day")
    assert [r.id for r in spark.read.parquet(path).collect()] == [1]


def test_ingestion_day(spark, out_dir):
    path = out_dir("ingest")
    tables.write_day_partitions(spark.range(3), path, "N/A")
    rows = spark.read.parquet(path).select((F.col(tables.INGESTION_DAY).cast("date") == F.current_date()).alias("t")).collect()
    assert [r.t for r in rows] == [True] * 3


def test_partition_id(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 5),)], "d date")
    assert df.select(tables.partition_id("ds.t", F.col("d")).alias("p")).collect()[0].p == "ds.t$20240105"


def test_table_dispositions(spark, out_dir):
    path = out_dir("tbl")
    df = spark.range(3).withColumnRenamed("id", "x")
    with pytest.raises(ValueError):
        tables.write_table(df, path, create="never")
    tables.write_table(df, path, write="empty")
    tables.write_table(df, path, write="append")
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError):
        tables.write_table(df, path, write="empty")
    tables.write_table(df.limit(1), path, write="truncate", create="never")
    assert spark.read.parquet(path).count() == 1


def test_read_table_rule(spark):
    with pytest.raises(ValueError):
        readers.read_table(spark)
    assert readers.read_table(spark, query="SELECT 1 AS one").collect()[0].one == 1


def test_catalog_table_partition_replace(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    spark.sql("DROP TABLE IF EXISTS sl_days")
    tables.write_table(_days(spark, [(1, "a", d1), (2, "b", d2)]), "sl_days", partition_by=["day"])
    with pytest.raises(ValueError):
        tables.write_day_partitions(_days(spark, [(3, "c", d2)]), "sl_missing", "day")
    tables.write_day_partitions(_days(spark, [(3, "c", d2)]), "sl_days", "day")
    got = sorted(tuple(r) for r in spark.read.table("sl_days").select("id", "v", "day").collect())
    assert got == [(1, "a", d1), (3, "c", d2)]
    # the session setting is restored after the write
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    tables.write_table(_days(spark, [(4, "d", d1)]), "sl_days", write="append", create="never")
    assert spark.read.table("sl_days").count() == 3
    tables.write_table(_days(spark, [(5, "e", d1)]), "sl_days", write="truncate")
    assert [r.id for r in spark.read.table("sl_days").collect()] == [5]


def test_partition_column_must_be_date(spark, out_dir):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 0))], "id bigint, ts timestamp")
    with pytest.raises(TypeError):
        tables.write_day_partitions(df, out_dir("bad-part"), "ts")


def test_orc_path_tables(spark, out_dir):
    path = out_dir("orc-days")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    tables.write_day_partitions(_days(spark, [(1, "a", d1), (2, "b", d2)]), path, "day", fmt="orc")
    tables.write_day_partitions(_days(spark, [(3, "c", d2)]), path, "day", fmt="orc")
    got = sorted(tuple(r) for r in readers.read_table(spark, table=path, fmt="orc").select("id", "v", "day").collect())
    assert got == [(1, "a", d1), (3, "c", d2)]
    tpath = out_dir("orc-tbl")
    tables.write_table(spark.range(2), tpath, write="empty", fmt="orc")
    tables.write_table(spark.range(2), tpath, write="append", create="never", fmt="orc")
    assert readers.read_table(spark, table=tpath, fmt="orc").count() == 4

"""Cases that earlier tests did not hold: dynamic sessions, NULL keys and lines, pruned checks, catalog tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkloom import schema as sch
from sparkloom.functions.casts import parse_time
from sparkloom.operators import keyed
from sparkloom.operators.staging import stage
from sparkloom.sinks import tables, text
from sparkloom.sources import readers

MODE = "spark.sql.sources.partitionOverwriteMode"


@pytest.fixture
def dynamic(spark):
    spark.conf.set(MODE, "dynamic")
    yield
    spark.conf.unset(MODE)


def test_truncate_replaces_all_partitions(spark, out_dir, dynamic):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, p string")
    path = out_dir("t")
    tables.write_table(df, path, partition_by=["p"])
    tables.write_table(df.where("id = 1"), path, write="truncate", partition_by=["p"])
    assert [r.id for r in spark.read.parquet(path).collect()] == [1]
    df.write.option("path", out_dir("c")).partitionBy("p").saveAsTable("truncate_days")
    tables.write_table(df.where("id = 1"), "truncate_days", write="truncate")
    assert [r.id for r in spark.read.table("truncate_days").collect()] == [1]
    assert spark.conf.get(MODE) == "dynamic"
    with pytest.raises(ValueError):
        tables.write_table(df, "truncate_days", write="empty")
    with pytest.raises(ValueError):
        tables.write_table(df, "no_such_days", create="never")
    spark.sql("DROP TABLE truncate_days")


def test_chunks_keep_null_keys_and_values(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", None)], "k string, v long")
    got = {(r.k, r.chunk): r.txt for r in keyed.group_chunks(df, chunk_size=1).collect()}
    assert got == {(None, 0): "1", (None, 1): "2", ("a", 0): "null", ("a", 1): "3"}
    assert {r.k: r.vs for r in keyed.group_by_key(df).collect()} == {None: [1, 2], "a": [None, 3]}


@pytest.mark.parametrize("large_key", [0, 3, 10**6])
def test_route_by_size_gives_the_same_lists(spark, large_key):
    rows = [("a", 1)] * 3 + [("b", i % 4) for i in range(9)] + [(None, 5), (None, None), ("c", 7)]
    df = spark.createDataFrame(rows, "k string, v long")
    got = {r.k: r.vs for r in keyed.group_by_key(df, large_key=large_key).collect()}
    assert got == {"a": [1, 1, 1], "b": sorted(i % 4 for i in range(9)), None: [None, 5], "c": [7]}
    lines = sorted(r.line for r in keyed.group_lines(df.where("k is not null"), large_key=large_key).collect())
    assert lines == ["a:[1, 1, 1]", "b:[0, 0, 0, 1, 1, 2, 2, 3, 3]", "c:[7]"]


def test_cogroup_chunks_are_the_lists_of_the_cogroup(spark):
    left = spark.createDataFrame([("a", str(i)) for i in range(5)] + [("b", "x")], "k string, v string")
    right = spark.createDataFrame([("a", "y"), (None, "z")], "k string, v string")
    got = {}
    for r in sorted(keyed.cogroup_chunks({"l": left, "r": right}, chunk_size=2).collect(), key=lambda r: r.chunk):
        assert len(r.txt.split(", ")) <= 2
        got.setdefault((r.k, r.tag), []).extend(r.txt.split(", "))
    assert got == {("a", "l"): list("01234"), ("b", "l"): ["x"], ("a", "r"): ["y"], (None, "r"): ["z"]}


def test_a_pair_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(keyed, "_CHUNK_BLOCK", 3)
    df = spark.range(100).select(F.lit("k").alias("k"), F.lit(7).alias("v"))
    got = sorted((r.chunk, r.txt.count("7")) for r in keyed.group_chunks(df, chunk_size=9).collect())
    assert got == [(i, 9) for i in range(11)] + [(11, 1)]


def test_blank_side_is_a_side_without_values(spark):
    left = spark.createDataFrame([("a", "")], "k string, v string")
    right = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    got = sorted(r.line for r in keyed.cogroup_lines({"l": left, "r": right}, blank_empty=True).collect())
    assert got == ["a : [];[x]", "b : ;[y]"]


def test_header_over_null_lines(spark, out_dir):
    df = spark.createDataFrame([(None,), ("x",)], "value string").coalesce(1)
    assert [r.value for r in readers.read_lines(spark, text.write_lines(df, out_dir("h"), header="H")).collect()] == ["H", "", "x"]


def test_time_parts_of_any_length(spark):
    df = spark.createDataFrame([("00000000001:2:3",), ("1:2:99999999999",)], "s string")
    assert [r.t for r in df.select(parse_time("s").alias("t")).collect()] == ["01:02:03", None]


def test_checks_hold_for_consumers_that_prune(spark):
    raw = spark.createDataFrame([("1", "2024-01-01"), ("2", "bad")], "id string, d string")
    staged = stage(raw, sch.from_pipe_string("id:INTEGER|d:DATE"), on_error="strict")
    pairs = keyed.parse_kv_lines(spark.createDataFrame([("cat, x",)], "value string"))
    for action in (staged.count, staged.select("id").collect, pairs.count, pairs.select("k").collect):
        with pytest.raises(Exception, match="cannot parse field d as DATE|For input string: x"):
            action()


def test_divert_is_idempotent_per_load(spark, out_dir):
    path, rejects = out_dir("d"), out_dir("r")
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, None)], "id long, day date")
    for _ in range(2):
        tables.write_day_partitions(df, path, "day", on_null="divert", reject_target=rejects, load_id="l1")
    assert [r.id for r in spark.read.parquet(path).collect()] == [1]
    assert [r.id for r in spark.read.parquet(rejects).collect()] == [2]


def test_schema_path_must_be_one_file(spark, tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.json").write_text("[]")
    with pytest.raises(ValueError, match="one schema file"):
        sch.from_json_file(spark, str(tmp_path / "*.json"))


def test_only_a_slash_makes_a_path():
    assert readers.is_path("a/b") and not readers.is_path("raw.json")


def test_stage_table_takes_a_json_schema_and_an_error_mode(spark, out_dir, tmp_path):
    from sparkloom.plans import cli

    (tmp_path / "s.json").write_text('[{"name": "id", "type": "INTEGER"}, {"name": "d", "type": "DATE"}]')
    spark.createDataFrame([("1", "bad")], "id string, d string").createOrReplaceTempView("cli_json")
    args = ["stage-table", "--query", "SELECT * FROM cli_json", "--schema-json", str(tmp_path / "s.json")]
    out = cli.run(spark, [*args, "--output", out_dir("o"), "--on-error", "null_field"])
    assert [(r.id, r.d) for r in spark.read.parquet(out).collect()] == [(1, None)]
    with pytest.raises(Exception, match="cannot parse"):
        cli.run(spark, [*args, "--output", out_dir("o"), "--on-error", "strict"])

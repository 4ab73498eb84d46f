"""End-to-end jobs: text in, text/table out, parameters as keyword arguments."""

import datetime as dt
import json

from conftest import lines_df
from sparkloom import schema as sch
from sparkloom.plans import jobs
from sparkloom.sources import readers

# Sample lines whose results are held to.
WORD_LINES = ["cat, 1", "dog, 5", "and, 1", "jump, 3", "tree, 2", "cat, 5", "dog, 2", "and, 2", "cat, 9", "and, 6"]


def _text_input(spark, out_dir, lines, name="in"):
    path = out_dir(name)
    lines_df(spark, lines).coalesce(1).write.text(path)
    return path


def _read(spark, path):
    return sorted(r.value for r in readers.read_lines(spark, path).collect())


def test_word_jobs(spark, out_dir):
    src = _text_input(spark, out_dir, WORD_LINES)
    assert _read(spark, jobs.group_words(spark, input=src, output=out_dir("g"), num_shards=1)) == [
        "and:[1, 2, 6]", "cat:[1, 5, 9]", "dog:[2, 5]", "jump:[3]", "tree:[2]"]
    assert _read(spark, jobs.sum_words(spark, input=src, output=out_dir("s"))) == ["and:9", "cat:15", "dog:7", "jump:3",
                                                                                    "tree:2"]
    assert _read(spark, jobs.longest_words(spark, input=src, output=out_dir("l"))) == ["jump:[3]", "tree:[2]"]
    assert _read(spark, jobs.longest_words(spark, input=src, output=out_dir("lm"), materialize_input=True)) == [
        "jump:[3]", "tree:[2]"]
    tagged = jobs.split_words(spark, input=src, output=out_dir("t"), cutoff=4, marker="c")
    got = sorted((r.tag, r.value) for r in spark.read.text(tagged).collect())
    assert ("marker", "cat:[1, 5, 9]") in got and ("above", "jump:[3]") in got and ("below", "dog:[2, 5]") in got


def test_line_jobs(spark, out_dir):
    sessions = _text_input(spark, out_dir, [jobs.SESSION_HEADER, "s1,u1,bob,v1,10,t1,1", "s2,u2,amy,v2,20,t2,2"], "sess")
    out = jobs.recode_sessions(spark, input=sessions, output=out_dir("rec"), num_shards=1)
    assert readers.read_lines(spark, out).collect()[0].value == jobs.SESSION_HEADER
    assert _read(spark, out) == sorted([jobs.SESSION_HEADER, "s1,u1,bob,v1,10,t1,M", "s2,u2,amy,v2,20,t2,F"])
    names = jobs.upper_usernames(spark, input=sessions, output=out_dir("up"), num_shards=1)
    assert _read(spark, names) == ["AMY", "BOB", "username"]
    customers = _text_input(spark, out_dir, [jobs.CUSTOMER_HEADER, "1,a,b,Los Angeles", "2,c,d,Boston"], "cust")
    assert _read(spark, jobs.city_customers(spark, input=customers, output=out_dir("la"), num_shards=1)) == [
        "1,a,b,Los Angeles", jobs.CUSTOMER_HEADER]
    cards = _text_input(spark, out_dir, ["#id,card", "CT42260,visa", "CT4226,amex", "CT1,x"], "cards")
    assert _read(spark, jobs.customer_records(spark, input=cards, output=out_dir("ct"), customer_id="CT4226")) == [
        "CT4226,amex", "CT42260,visa"]
    people = readers.from_rows(spark, [("1001", "Quill"), ("1002", "Bramble")], "id string, name string")
    assert _read(spark, jobs.customer_names(people, output=out_dir("names"))) == ["Bramble", "Quill"]


def test_raw_to_staging_job(spark, out_dir, tmp_path):
    raw_path = out_dir("raw")
    spark.createDataFrame([("1", "a", "2024-01-01", "x"), ("2", "b", "2024-01-02", "y"), ("z", "c", "2024-01-02", "q")],
                          "id string, name string, day string, junk string").write.parquet(raw_path)
    schema_file = tmp_path / "schema.json"
    schema_file.write_text(json.dumps([{"name": "id", "type": "INTEGER", "fields": []},
                                       {"name": "name", "type": "STRING", "fields": []},
                                       {"name": "record_load_ts", "type": "TIMESTAMP", "fields": []},
                                       {"name": "day", "type": "DATE", "fields": []}]))
    out = out_dir("staged")
    # the row with a bad id is reset up to 'id' only; its day survives, so it can be routed
    jobs.raw_to_staging(spark, output=out, table=raw_path, schema_json_path=str(schema_file), partition_col="day")
    got = sorted(((r.id, r.name, r.day, r.record_load_ts is not None) for r in spark.read.parquet(out).collect()), key=repr)
    assert got == sorted([(1, "a", dt.date(2024, 1, 1), True), (2, "b", dt.date(2024, 1, 2), True),
                          (None, "c", dt.date(2024, 1, 2), True)], key=repr)
    spark.read.parquet(raw_path).createOrReplaceTempView("raw_people")
    # second load from a SQL query replaces only 2024-01-02
    jobs.raw_to_staging(spark, output=out, query="SELECT '9' AS id, 'n' AS name, '2024-01-02' AS day",
                        schema_string="id:INTEGER|name:STRING|day:DATE", partition_col="day")
    got = sorted((r.id, r.day) for r in spark.read.parquet(out).collect())
    assert got == [(1, dt.date(2024, 1, 1)), (9, dt.date(2024, 1, 2))]


def test_raw_to_table_job(spark, out_dir):
    out = out_dir("tbl")
    spark.createDataFrame([("1", "1.50")], "id string, amt string").createOrReplaceTempView("raw_amts")
    jobs.raw_to_table(spark, output=out, query="SELECT * FROM raw_amts", schema_string="id:INTEGER|amt:NUMERIC")
    jobs.raw_to_table(spark, output=out, query="SELECT * FROM raw_amts", schema_string="id:INTEGER|amt:NUMERIC")
    assert spark.read.parquet(out).count() == 2
    fields = sch.from_pipe_string("id:INTEGER|amt:NUMERIC")
    assert [f.name for f in fields] == spark.read.parquet(out).columns


def test_cli(spark, out_dir):
    from sparkloom.plans import cli

    src = _text_input(spark, out_dir, WORD_LINES, "cli-in")
    out = cli.run(spark, ["group-words", "--input", src, "--output", out_dir("cli-g"), "--num-shards", "1"])
    assert _read(spark, out)[0] == "and:[1, 2, 6]"
    left = _text_input(spark, out_dir, ["amy,amy@example.com", "carl,carl@example.com"], "cli-l")
    right = _text_input(spark, out_dir, ["amy,111", "james,222"], "cli-r")
    out = cli.run(spark, ["cogroup", "--left", left, "--right", right, "--output", out_dir("cli-c")])
    assert _read(spark, out) == ["amy : [amy@example.com];[111]", "carl : [carl@example.com];[]", "james : [];[222]"]
    spark.createDataFrame([("1", "2024-01-01")], "id string, d string").createOrReplaceTempView("cli_raw")
    out = cli.run(spark, ["stage", "--query", "SELECT * FROM cli_raw", "--schema-string", "id:INTEGER|d:DATE",
                          "--output", out_dir("cli-s"), "--partition-col", "d"])
    assert [(r.id, str(r.d)) for r in spark.read.parquet(out).collect()] == [(1, "2024-01-01")]
    out = cli.run(spark, ["stage-table", "--query", "SELECT * FROM cli_raw", "--schema-string", "id:INTEGER|d:DATE",
                          "--output", out_dir("cli-t"), "--output-format", "json"])
    assert [(r.id, r.d) for r in spark.read.json(out).collect()] == [(1, "2024-01-01")]

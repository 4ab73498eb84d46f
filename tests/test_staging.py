"""Staging: the reset rule against a row-by-row model, fixture rows, modes and schema parsing."""

import datetime as dt
import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparkloom import schema as sch
from sparkloom.operators import staging


def _model_parse(typ, raw):
    """Independent row model of one field parse: (ok, value)."""
    if typ == "STRING":
        return True, raw
    if typ == "BOOLEAN":
        return True, raw is not None and raw.lower() == "true"
    if raw is None:
        return False, None
    if typ == "INTEGER":
        t = raw[1:] if raw[:1] in "+-" else raw
        return (True, int(raw)) if t.isdigit() and t.isascii() and -2**63 <= int(raw) < 2**63 else (False, None)
    if typ == "DATE":
        try:
            return (True, dt.date.fromisoformat(raw)) if len(raw) == 10 else (False, None)
        except ValueError:
            return False, None
    raise AssertionError(typ)


def model_row(fields, row):
    acc = {}
    for f in fields:
        if f.name == sch.RECORD_LOAD_TS:
            acc[f.name] = "now"
            continue
        ok, val = _model_parse(f.type, row.get(f.name))
        if ok:
            acc[f.name] = val
        else:
            acc = {}
    return tuple(acc.get(f.name) for f in fields)


FIELDS = [sch.Field("id", "INTEGER"), sch.Field("record_load_ts", "TIMESTAMP"), sch.Field("name", "STRING"),
          sch.Field("d", "DATE"), sch.Field("n", "INTEGER")]
CHOICES = {"INTEGER": ["7", "x", None], "STRING": ["s", None], "DATE": ["2024-02-29", "2023-02-29", None]}


def test_reset_rule_exhaustive(spark):
    data_fields = [f for f in FIELDS if f.name != sch.RECORD_LOAD_TS]
    rows = [dict(zip([f.name for f in data_fields], combo))
            for combo in itertools.product(*[CHOICES[f.type] for f in data_fields])]
    df = spark.createDataFrame([tuple(r[f.name] for f in data_fields) for r in rows],
                               ", ".join(f"{f.name} string" for f in data_fields))
    df = df.withColumn("_i", F.monotonically_increasing_id())
    staged = staging.stage(df.drop("_i"), FIELDS)
    got = staged.withColumn("record_load_ts", F.when(F.col("record_load_ts").isNotNull(), F.lit("now"))).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((model_row(FIELDS, r) for r in rows), key=repr)
    assert len(got) == 3 * 2 * 3 * 3


RESET_FIELDS = [sch.Field("id", "INTEGER"), sch.Field("name", "STRING"), sch.Field("amt", "NUMERIC"),
                sch.Field("d", "DATE"), sch.Field("flag", "BOOLEAN")]
RESET_ROWS = [
    (("1", "a", "10.5", "2024-01-01", "true"), (1, "a", Decimal("10.5"), dt.date(2024, 1, 1), True)),
    (("x", "b", "11", "2024-01-02", "TRUE"), (None, "b", Decimal("11"), dt.date(2024, 1, 2), True)),
    (("3", None, "bad", "2024-01-03", None), (None, None, None, dt.date(2024, 1, 3), False)),
    (("4", "d", "12", None, "yes"), (None, None, None, None, False)),
    ((None, "e", "13", "2024-01-05", "false"), (None, "e", Decimal("13"), dt.date(2024, 1, 5), False)),
]


def test_reset_fixture_rows(spark):
    df = spark.createDataFrame([r for r, _ in RESET_ROWS], "id string, name string, amt string, d string, flag string")
    got = sorted((tuple(r) for r in staging.stage(df, RESET_FIELDS).collect()), key=repr)
    assert got == sorted((e for _, e in RESET_ROWS), key=repr)


def test_output_schema_and_order(spark):
    df = spark.createDataFrame([("1", "extra", "a")], "id string, junk string, name string")
    out = staging.stage(df, [sch.Field("name", "STRING"), sch.Field("id", "INTEGER"), sch.Field("missing", "DATE")],
                        on_error="null_field")
    assert out.columns == ["name", "id", "missing"]
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "bigint", "date"]
    assert tuple(out.collect()[0]) == ("a", 1, None)


def test_strict_mode(spark):
    ok = spark.createDataFrame([("1", "10:20")], "id string, t string")
    out = staging.stage(ok, [sch.Field("id", "INTEGER"), sch.Field("t", "TIME")], on_error="strict").collect()
    assert tuple(out[0]) == (1, "10:20")  # TIME is copied through in strict mode
    bad = spark.createDataFrame([("x",)], "id string")
    with pytest.raises(Exception):
        staging.stage(bad, [sch.Field("id", "INTEGER")], on_error="strict").collect()


def test_reject_mode(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "nope")], "id string, d string")
    staged = staging.stage(df, [sch.Field("id", "INTEGER"), sch.Field("d", "DATE")], on_error="reject")
    good, bad = staging.split_rejects(staged)
    assert [tuple(r) for r in good.collect()] == [(1, dt.date(2024, 1, 1))]
    assert [r._errors for r in bad.collect()] == [["id", "d"]]


def test_unknown_type_modes(spark):
    df = spark.createDataFrame([("1", "p")], "id string, g string")
    fields = [sch.Field("id", "INTEGER"), sch.Field("g", "GEOGRAPHY")]
    assert tuple(staging.stage(df, fields).collect()[0]) == (None, None)  # reset parity: a failing field
    with pytest.raises(ValueError):
        staging.stage(df, fields, on_error="null_field")


def test_non_string_raw_rejected(spark):
    df = spark.createDataFrame([(1,)], "id bigint")
    with pytest.raises(TypeError):
        staging.stage(df, [sch.Field("id", "INTEGER")])


def test_schema_parsers(spark, tmp_path):
    staging_table = ('[{"name": "id", "type": "INTEGER", "fields": []}, {"name": "name", "type": "STRING", '
                     '"fields": []}, {"name": "salary", "type": "INTEGER", "fields": []}]')
    p = tmp_path / "STAGING_TABLE.json"
    p.write_text(staging_table)
    fields = sch.from_json_file(spark, str(p))
    assert fields == [sch.Field("id", "INTEGER"), sch.Field("name", "STRING"), sch.Field("salary", "INTEGER")]
    assert sch.from_pipe_string("id:INTEGER|name:STRING|") == fields[:2]
    assert sch.from_pipe_string("id:INTEGER:x") == [sch.Field("id", "INTEGER")]
    with pytest.raises(ValueError):
        sch.from_pipe_string("id|name:STRING")
    struct = sch.to_struct([sch.Field("a", "NUMERIC"), sch.Field("record_load_ts", "STRING"), sch.Field("t", "TIME")])
    assert [f.dataType.simpleString() for f in struct.fields] == ["decimal(38,9)", "timestamp", "string"]
    assert sch.raw_projection([sch.Field("a", "INTEGER"), sch.Field("record_load_ts", "TIMESTAMP")]) == ["a"]


def test_order_staging_schema_types(spark):
    """The 13-column order schema of the fixtures: every type but LONG and TIME."""
    spec = ("order_id:INTEGER|cust_id:INTEGER|product_id:INTEGER|product_desc:STRING|dept_id:INTEGER|"
            "quantity:INTEGER|amount:NUMERIC|create_dt:DATE|create_datetime:DATETIME|create_ts:TIMESTAMP|"
            "is_subscriber:BOOLEAN|avg_rating:FLOAT|record_load_ts:TIMESTAMP")
    fields = sch.from_pipe_string(spec)
    row = ("1", "2", "3", "desc", "4", "5", "12.50", "2022-05-23", "2022-05-23T13:25:34",
           "2022-05-23T13:25:34.123+05:30", "true", "4.5")
    names = [f.name for f in fields if f.name != sch.RECORD_LOAD_TS]
    df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names))
    out = staging.stage(df, fields).collect()[0]
    assert out.order_id == 1 and out.amount == Decimal("12.5") and out.create_dt == dt.date(2022, 5, 23)
    assert out.create_datetime == dt.datetime(2022, 5, 23, 13, 25, 34) and out.is_subscriber is True
    assert out.avg_rating == 4.5 and out.record_load_ts is not None


def test_wide_schema_reset_is_linear(spark):
    n = 300
    fields = [sch.Field(f"c{i}", "INTEGER") for i in range(n)]
    row = tuple("x" if i == 150 else str(i) for i in range(n))
    df = spark.createDataFrame([row], ", ".join(f"c{i} string" for i in range(n)))
    staged = staging.stage(df, fields)
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    try:
        plan = staged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("greatest(") == 1
    out = staged.collect()[0]
    assert all(out[i] is None for i in range(151)) and all(out[i] == i for i in range(151, n))


def test_schema_json_errors():
    with pytest.raises(ValueError):
        sch.from_json_text('{"name": "id", "type": "INTEGER"}')
    with pytest.raises(ValueError):
        sch.from_json_text('[{"name": "id"}]')
    with pytest.raises(ValueError):
        sch.from_json_text("not json")


def test_explicit_load_time_is_erased_by_a_later_failure(spark):
    import datetime as dt

    fields = [sch.Field("record_load_ts", "TIMESTAMP"), sch.Field("id", "INTEGER"), sch.Field("n", "INTEGER")]
    df = spark.createDataFrame([("1", "2"), ("1", "x")], "id string, n string")
    when = F.lit("2024-01-02 03:04:05").cast("timestamp")
    rows = sorted(staging.stage(df, fields, load_time=when).collect(), key=lambda r: r.n is None)
    assert rows[0].record_load_ts == dt.datetime(2024, 1, 2, 3, 4, 5) and (rows[0].id, rows[0].n) == (1, 2)
    assert tuple(rows[1]) == (None, None, None)  # 'x' fails at the last position: the whole row resets

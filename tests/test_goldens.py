"""In-comment goldens of the reference jobs (list order is unspecified there; ours is sorted)."""

from conftest import lines_df

from sparkloom.operators import keyed
from sparkloom.sources import readers

# Sample lines whose results are held to.
WORD_LINES = ["cat, 1", "dog, 5", "and, 1", "jump, 3", "tree, 2", "cat, 5", "dog, 2", "and, 2", "cat, 9", "and, 6"]


def _kv(spark, lines=WORD_LINES):
    return keyed.parse_kv_lines(lines_df(spark, lines))


def test_group_by_key_golden(spark):
    got = sorted(r.line for r in keyed.group_lines(_kv(spark)).collect())
    assert got == ["and:[1, 2, 6]", "cat:[1, 5, 9]", "dog:[2, 5]", "jump:[3]", "tree:[2]"]


def test_group_by_key_arrays(spark):
    from sparkloom.functions.formatting import format_group

    grouped = keyed.group_by_key(_kv(spark))
    got = {r.k: r.vs for r in grouped.collect()}
    assert got == {"and": [1, 2, 6], "cat": [1, 5, 9], "dog": [2, 5], "jump": [3], "tree": [2]}
    lines = sorted(r.line for r in grouped.select(format_group("k", "vs").alias("line")).collect())
    assert lines == ["and:[1, 2, 6]", "cat:[1, 5, 9]", "dog:[2, 5]", "jump:[3]", "tree:[2]"]


def test_sum_per_key(spark):
    got = sorted(r.line for r in _kv(spark).transform(keyed.sum_lines).collect())
    assert got == ["and:9", "cat:15", "dog:7", "jump:3", "tree:2"]


def test_longest_keys_golden(spark):
    got = sorted(r.line for r in keyed.group_lines(keyed.filter_by_max_length(_kv(spark))).collect())
    assert got == ["jump:[3]", "tree:[2]"]


def test_global_max(spark):
    from sparkloom.functions.strings import utf16_length
    from pyspark.sql import functions as F

    assert keyed.global_max(_kv(spark), utf16_length(F.col("k")), "m").collect()[0].m == 4


EMAILS = [("amy", "amy@example.com"), ("carl", "carl@example.com"), ("julia", "julia@example.com"), ("carl", "carl@email.com")]
PHONES = [("amy", "111-222-3333"), ("james", "222-333-4444"), ("amy", "333-444-5555"), ("carl", "444-555-6666")]


def _cogroup_inputs(spark):
    return {
        "emails": readers.from_rows(spark, EMAILS, "k string, v string"),
        "phones": readers.from_rows(spark, PHONES, "k string, v string"),
    }


def test_cogroup_golden(spark):
    got = sorted(r.line for r in keyed.cogroup_lines(_cogroup_inputs(spark)).collect())
    assert got == [
        "amy : [amy@example.com];[111-222-3333, 333-444-5555]",
        "carl : [carl@email.com, carl@example.com];[444-555-6666]",
        "james : [];[222-333-4444]",
        "julia : [julia@example.com];[]",
    ]


def test_cogroup_blank_empty(spark):
    got = sorted(r.line for r in keyed.cogroup_lines(_cogroup_inputs(spark), blank_empty=True).collect())
    assert "james : ;[222-333-4444]" in got and "julia : [julia@example.com];" in got


def test_cogroup_arrays(spark):
    got = {r.k: (r.emails, r.phones) for r in keyed.cogroup(_cogroup_inputs(spark)).collect()}
    assert got["james"] == ([], ["222-333-4444"])
    assert got["amy"] == (["amy@example.com"], ["111-222-3333", "333-444-5555"])
    assert len(got) == 4


GROUPS = {"tree": [2], "and": [1, 2, 6], "dog": [2, 5], "jump": [3], "cat": [1, 5, 9], "shark": [2],
          "dinosaur": [1], "sherlock": [1], "squirrel": [2], "tiger": [5, 8], "elephant": [7, 10]}


def test_multi_output_golden(spark):
    lines = [f"{k}, {v}" for k, vs in GROUPS.items() for v in vs]
    routed = keyed.route_outputs(keyed.group_lines(_kv(spark, lines)), "k", 5, "s")
    outs = {t: sorted(r.line for r in d.collect()) for t, d in keyed.split_outputs(routed.select("tag", "line")).items()}
    assert outs["below"] == sorted(["tree:[2]", "and:[1, 2, 6]", "dog:[2, 5]", "jump:[3]", "cat:[1, 5, 9]"])
    assert outs["above"] == sorted(["shark:[2]", "dinosaur:[1]", "sherlock:[1]", "squirrel:[2]", "tiger:[5, 8]",
                                    "elephant:[7, 10]"])
    assert outs["marker"] == sorted(["squirrel:[2]", "sherlock:[1]", "shark:[2]"])


def test_marker_lowercases_key_only(spark):
    routed = keyed.route_outputs(keyed.group_lines(_kv(spark, ["Shark, 1", "Tiger, 2"])), "k", 5, "s")
    assert sorted((r.tag, r.k) for r in routed.collect()) == [("above", "Shark"), ("above", "Tiger"), ("marker", "Shark")]
    upper_marker = keyed.route_outputs(keyed.group_lines(_kv(spark, ["Shark, 1"])), "k", 5, "S")
    assert [r.tag for r in upper_marker.collect()] == ["above"]


def test_bad_value_fails_job(spark):
    import pytest

    with pytest.raises(Exception):
        _kv(spark, ["cat, x"]).collect()
    with pytest.raises(Exception):
        _kv(spark, ["cat"]).collect()


def test_hot_key_is_split_across_runs(spark):
    """A key holding most rows is sorted in several range partitions, never in one task."""
    from pyspark.sql import functions as F

    hot = spark.range(0, 20000).select(F.lit("hot").alias("k"), (F.col("id") * 7 % 20000).alias("v"))
    cold = spark.range(0, 100).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    # AQE would merge these tiny range partitions (at scale a merged partition is bounded by the
    # advisory size, so a hot key still spans many); switch merging off to observe the split.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        runs = keyed.group_runs(hot.unionByName(cold), "k", "v")
        assert runs.where(F.col("k") == "hot").count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    vs = keyed.group_by_key(hot.unionByName(cold)).where(F.col("k") == "hot").collect()[0].vs
    assert vs == sorted(vs) and len(vs) == 20000
    line = keyed.group_lines(hot).collect()[0].line
    assert line == "hot:[" + ", ".join(str(i) for i in range(20000)) + "]"


def test_null_values_render_as_null(spark):
    df = spark.createDataFrame([("a", 2), ("a", None), ("a", 1)], "k string, v bigint")
    assert keyed.group_lines(df).collect()[0].line == "a:[null, 1, 2]"


def test_repeated_pair_collapses_before_shuffle(spark):
    """One (key, value) pair repeated many times is counted map-side, then expanded in the output."""
    from pyspark.sql import functions as F

    rep = spark.range(0, 5000).select(F.lit("hot").alias("k"), F.lit(5).cast("bigint").alias("v"))
    other = spark.createDataFrame([("hot", 3), ("hot", 9), ("cold", 1)], "k string, v bigint")
    df = rep.unionByName(other)
    line = {r.k: r.line for r in keyed.group_lines(df).collect()}
    assert line["hot"] == "hot:[3, " + ", ".join(["5"] * 5000) + ", 9]"
    assert line["cold"] == "cold:[1]"
    plan = keyed.group_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    vs = {r.k: r.vs for r in keyed.group_by_key(df).collect()}
    assert vs["hot"] == [3] + [5] * 5000 + [9]


def test_three_way_cogroup(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "2")], "k string, v string")
    b = spark.createDataFrame([("x", "3")], "k string, v string")
    c = spark.createDataFrame([("z", "4"), ("x", "5"), ("x", "0")], "k string, v string")
    got = sorted(r.line for r in keyed.cogroup_lines({"a": a, "b": b, "c": c}).collect())
    assert got == ["x : [1];[3];[0, 5]", "y : [2];[];[]", "z : [];[];[4]"]


def test_group_chunks_bounded_and_exact(spark):
    from pyspark.sql import functions as F

    rep = spark.range(0, 2500).select(F.lit("hot").alias("k"), F.lit(5).cast("bigint").alias("v"))
    other = spark.range(0, 3000).select(F.lit("hot").alias("k"), (F.col("id") % 17).alias("v"))
    df = rep.unionByName(other).unionByName(spark.createDataFrame([("cold", 1), ("cold", 3)], "k string, v bigint"))
    chunks = {}
    for r in keyed.group_chunks(df, chunk_size=1000).collect():
        chunks.setdefault(r.k, {})[r.chunk] = r.txt
    lines = {r.k: r.line for r in keyed.group_lines(df).collect()}
    for k, parts in chunks.items():
        assert sorted(parts) == list(range(len(parts)))
        assert all(len(t.split(", ")) <= 1000 for t in parts.values())
        assert lines[k] == f"{k}:[" + ", ".join(parts[i] for i in range(len(parts))) + "]"
    assert len(chunks["hot"]) == 6 and chunks["cold"] == {0: "1, 3"}

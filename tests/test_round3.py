"""Size sketch and routes, one-pass arg-max, groups longer than a row, named shards, publishing, routing, claims, digits, element functions."""

import datetime as dt
import os
import random
import threading
import unicodedata
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import casts
from sparkloom.operators import argmax, elements, keyed, sketch
from sparkloom.sinks import publish, shards, tables
from test_sinks import local


def skewed(spark, seed=1, n=3000):
    """A third of the rows under one key, a third of those one pair, NULL keys and values."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        k = "hot" if rng.random() < .34 else rng.choice([None, "", "a", "b", f"k{rng.randrange(200)}"])
        v = 7 if k == "hot" and rng.random() < .5 else rng.choice([None, rng.randrange(-50, 50)])
        rows.append((k, v))
    return spark.createDataFrame(rows, "k string, v long").repartition(5), rows


def lists(rows):
    out = {}
    for k, v in rows:
        out.setdefault(k, []).append(v)
    return {k: sorted(vs, key=lambda x: (x is not None, x or 0)) for k, vs in out.items()}


# ---- sketch and routes -----------------------------------------------------------------------------
@pytest.mark.parametrize("width", [1 << 20, 16, 1])
def test_sketch_never_misses_a_large_key(spark, width):
    df, rows = skewed(spark)
    counts = Counter(k for k, _ in rows)
    found = sketch.count_sketch(df, "k", width)
    at = {r.bucket: r.rows for r in found.collect()}
    buckets = {r.k: r.b for r in df.select("k", sketch.bucket_of(F.col("k"), width).alias("b")).distinct().collect()}
    assert all(at[buckets[k]] >= n for k, n in counts.items()) and sum(at.values()) == len(rows)
    heavy = {r.bucket for r in sketch.heavy_buckets(found, 100).collect()}
    assert {buckets[k] for k, n in counts.items() if n > 100} <= heavy
    parts = sketch.merge_sketches(sketch.count_sketch(df.where("v < 0"), "k", width), sketch.count_sketch(df.where("v >= 0 or v is null"), "k", width))
    assert {r.bucket: r.rows for r in parts.collect()} == at
    exact = {r.k: r.rows for r in sketch.large_keys(df.where("k is not null"), "k", 100, width=width).collect()}
    assert exact == {k: n for k, n in counts.items() if n > 100 and k is not None}


@pytest.mark.parametrize("large_key", [10**6, 100, 1, 0])
def test_both_routes_give_the_same_lists(spark, large_key):
    df, rows = skewed(spark)
    want = lists(rows)
    assert {r.k: r.vs for r in keyed.group_by_key(df, large_key=large_key).collect()} == want
    got = {r.k: r.line for r in keyed.group_lines(df, large_key=large_key).collect()}
    assert got == {k: None if k is None else f"{k}:[{', '.join('null' if v is None else str(v) for v in vs)}]" for k, vs in want.items()}
    assert len(got) == keyed.group_lines(df, large_key=large_key).count()


def test_values_of_other_types(spark):
    rows = [("a", x) for x in (1.5, float("nan"), None, -2.0, 1.5)]
    df = spark.createDataFrame(rows, "k string, v double")
    for large in (10, 0):
        assert [r.line for r in keyed.group_lines(df, large_key=large).collect()] == ["a:[null, -2.0, 1.5, 1.5, NaN]"]
    assert keyed.group_lines(df.limit(0)).count() == 0


def counted(spark, df):
    """The same rows, and an accumulator of how many were read."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(count, df.schema), seen


@pytest.mark.parametrize("passes, work", [(2, keyed.group_lines), (2, keyed.group_by_key), (1, keyed.filter_by_max_length),
                                          (2, lambda df: keyed.group_lines(df, large_key=100))])
def test_inputs_are_read_once_per_pass(spark, passes, work):
    """Grouping reads its input twice (sizes, rows), whatever route its keys take; the arg-max once."""
    df, rows = skewed(spark)
    read, seen = counted(spark, df)
    work(read).collect()
    assert seen.value == passes * len(rows)


def test_argmax_keeps_ties_and_drops_nulls(spark):
    rows = [("aa", 1), (None, 2), ("bbb", 3), ("ccc", 4), ("ccc", 4), ("d", 5), ("\U0001f600x", 6)]  # a pair is two units
    df = spark.createDataFrame(rows, "k string, v long").repartition(3)
    assert sorted(tuple(r) for r in keyed.filter_by_max_length(df).collect()) == [("bbb", 3), ("ccc", 4), ("ccc", 4), ("\U0001f600x", 6)]
    assert keyed.filter_by_max_length(df.where("k is null")).count() == 0 and keyed.filter_by_max_length(df.limit(0)).count() == 0
    many = spark.range(50_000).select((F.col("id") % 3).alias("x"), "id")
    assert argmax.keep_greatest(many, F.col("x")).count() == 16_666
    with pytest.raises(ValueError):
        argmax.keep_greatest(many.withColumnRenamed("x", "_by"), F.col("id"))


# ---- groups longer than a row -------------------------------------------------------------------------
def content(path):
    return {f: open(os.path.join(local(path), f), encoding="utf-8").read() for f in sorted(os.listdir(local(path)))}


@pytest.mark.parametrize("n_shards", [1, 4])
def test_group_lines_of_any_size(spark, out_dir, n_shards):
    df, rows = skewed(spark)
    path = out_dir("lines")
    shards.write_group_lines(df, path, num_shards=n_shards, chunk_size=13, prefix="g", suffix=".txt")
    files = content(path)
    assert list(files) == [f"g-{i:05d}-of-{n_shards:05d}.txt" for i in range(n_shards)]
    got = [line for text in files.values() for line in text.splitlines()]
    want = {k: f"{'null' if k is None else k}:[{', '.join('null' if v is None else str(v) for v in vs)}]" for k, vs in lists(rows).items()}
    assert sorted(got) == sorted(want.values())
    chunks = {}
    for r in keyed.group_chunks(df, chunk_size=13).orderBy("k", "chunk").collect():
        chunks.setdefault(r.k, []).append(r.txt)
    assert want["hot"] == f"hot:[{', '.join(chunks['hot'])}]" and len(chunks["hot"]) > 60
    assert all(text == "" or text.endswith("]\n") for text in files.values())


def test_cogroup_lines_of_any_size(spark, out_dir):
    left, _ = skewed(spark, 2, 900)
    right, _ = skewed(spark, 3, 700)
    some = {"l": left.where("k is not null and k <> 'a'"), "r": right.where("k is not null and k <> 'b'")}
    path = out_dir("colines")
    shards.write_cogroup_lines(some, path, num_shards=3, chunk_size=11)
    got = [line for text in content(path).values() for line in text.splitlines()]
    assert sorted(got) == sorted(r.line for r in keyed.cogroup_lines(some).collect())
    assert any(line.startswith("a : [];[") for line in got) and any(line.startswith("b : [") and line.endswith("];[]") for line in got)


@pytest.mark.parametrize("anywhere", [True, False])
def test_a_shard_is_the_work_of_many_tasks(spark, out_dir, monkeypatch, anywhere):
    """F1 of round 3: a shard, or a line, was one task's share. Stores with one writer for a file join the same parts."""
    saved, save = [], shards._save

    def one_writer(sources):
        whole, parts = sources()
        make = parts.reader

        def reader(self, schema):
            made = make(self, schema)
            made.anywhere = lambda *_: False
            return made

        parts.reader = reader
        return whole, parts

    monkeypatch.setattr(shards, "_save", lambda df, *a, **kw: (saved.append(df), save(df, *a, **kw))[1])
    if not anywhere:
        monkeypatch.setattr(shards, "_sources", lambda made=shards._sources: one_writer(made))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [("hot", i) for i in range(3000)] + [(f"k{i:02d}", i) for i in range(40)] + [(None, 5)]
        path, names = out_dir("parts"), sorted({k or "null" for k, _ in rows})
        shards.write_group_lines(spark.createDataFrame(rows, "k string, v long"), path, num_shards=2, chunk_size=10)
        sizes = [r.n for r in saved[0].groupBy(F.spark_partition_id()).agg(F.sum(F.length("value")).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = content(path)
    assert list(files) == ["part-00000-of-00002", "part-00001-of-00002"] and not [f for f in os.listdir(local(path)) if f.startswith("_")]
    where = {r.k or "null": r.s for r in spark.createDataFrame(rows, "k string, v long").select("k", F.expr("pmod(hash(k), 2)").alias("s")).distinct().collect()}
    for i, text in enumerate(files.values()):  # keys in order, NULL first
        mine = sorted((k for k in names if where[k] == i), key=lambda k: (k != "null", k))
        assert text == "".join(f"{k}:[{', '.join(str(v) for x, v in rows if (x or 'null') == k)}]\n" for k in mine)
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 3


def test_lines_of_no_rows(spark, out_dir):
    path = out_dir("none")
    shards.write_group_lines(spark.createDataFrame([], "k string, v long"), path, num_shards=2)
    assert content(path) == {"part-00000-of-00002": "", "part-00001-of-00002": ""}


# ---- named shards ---------------------------------------------------------------------------------------
def test_named_shards_have_names_and_headers(spark, out_dir):
    path = out_dir("named")
    src = spark.createDataFrame([("x", i) for i in range(9)] + [(None, 9)], "v string, n long")
    shards.write_named_lines(src, path, prefix="out-tag", suffix=".CSV", num_shards=5, by="n", col="v", header="h")
    files = content(path)
    assert list(files) == [f"out-tag-{i:05d}-of-00005.CSV" for i in range(5)]
    assert all(t.startswith("h\n") for t in files.values())
    assert Counter(x for t in files.values() for x in t.splitlines()[1:]) == {"x": 9, "": 1}
    empty = out_dir("named-empty")
    shards.write_named_lines(src.limit(0), empty, num_shards=2, header="only")
    assert content(empty) == {"part-00000-of-00002": "only\n", "part-00001-of-00002": "only\n"}
    shards.write_named_lines(src.limit(3), path, prefix="out-tag", suffix=".CSV", num_shards=1, mode="overwrite")
    shards.write_named_lines(src.limit(2), path, prefix="other", num_shards=1)
    assert content(path) == {"other-00000-of-00001": "x\nx\n", "out-tag-00000-of-00001.CSV": "x\nx\nx\n"}
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["x"] * 5


def test_default_shards_are_the_partitions(spark, out_dir):
    path = out_dir("named-parts")
    shards.write_named_lines(spark.range(10).repartition(3).select(F.col("id").cast("string")), path)
    files = content(path)
    assert list(files) == [f"part-{i:05d}-of-00003" for i in range(3)]
    assert sorted(int(x) for t in files.values() for x in t.split()) == list(range(10))


def test_failed_task_leaves_no_file(spark, out_dir):
    path = out_dir("named-bad")
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 57, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")).alias("v"))
    with pytest.raises(Exception, match="no"):
        shards.write_named_lines(bad, path, header="h")
    assert not os.path.exists(local(path)) or os.listdir(local(path)) == []


# ---- publishing -----------------------------------------------------------------------------------------
def days(spark, n, label, first=0):
    return spark.range(n * 3).select("id", F.lit(label).alias("load"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % n + first).cast("int")).alias("day"))


def test_load_killed_half_way_and_run_again(spark, out_dir, monkeypatch):
    path = out_dir("days")
    tables.write_day_partitions(days(spark, 20, "a"), path, "day")
    rename, calls = publish.MountedStore.rename, []

    def breaks(self, source, target):
        if "/rows/" in source:
            calls.append(source)
            if len(calls) > 7:
                raise OSError("killed")
        rename(self, source, target)

    monkeypatch.setattr(publish.MountedStore, "rename", breaks)
    with pytest.raises(OSError, match="killed"):
        tables.write_day_partitions(days(spark, 15, "b", 10), path, "day", load_id="x")
    monkeypatch.setattr(publish.MountedStore, "rename", rename)
    # The list was there: the second try publishes what the first one staged and does not compute anything anew.
    tables.write_day_partitions(days(spark, 15, "ignored", 10), path, "day", load_id="x")
    got = Counter((r.load, str(r.day)) for r in spark.read.parquet(path).collect())
    day = dt.date(2024, 1, 1)
    want = Counter({("a", str(day + dt.timedelta(i))): 3 for i in range(10)} | {("b", str(day + dt.timedelta(i))): 3 for i in range(10, 25)})
    assert got == want
    assert not [f for f in os.listdir(local(path)) if f.startswith("_load")]


def test_killed_before_the_list_starts_over(spark, out_dir, monkeypatch):
    path = out_dir("days2")
    tables.write_day_partitions(days(spark, 4, "a"), path, "day")
    monkeypatch.setattr(publish.Store, "write", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        tables.write_day_partitions(days(spark, 2, "b"), path, "day", load_id="y")
    monkeypatch.undo()
    assert {r.load for r in spark.read.parquet(path).collect()} == {"a"}
    tables.write_day_partitions(days(spark, 2, "c"), path, "day", load_id="y")
    assert Counter(r.load for r in spark.read.parquet(path).collect()) == {"a": 6, "c": 6}


def test_hadoop_store_does_the_same(spark, out_dir):
    path = out_dir("store")
    for store in (publish.Store(spark, path), publish.MountedStore()):
        store.make(f"{path}/a")
        store.write(f"{path}/a/list", "[1]")
        assert store.read(f"{path}/a/list") == "[1]" and store.names(f"{path}/a") == ["list"] and store.names(f"{path}/none") == []
        assert store.claim(f"{path}/c", "me") and store.claim(f"{path}/c", "me") and not store.claim(f"{path}/c", "you")
        store.rename(f"{path}/a", f"{path}/b")
        assert store.exists(f"{path}/b/list") and not store.exists(f"{path}/a")
        store.delete(f"{path}/b")
        store.delete(f"{path}/c")
        assert not store.exists(f"{path}/b") and not store.exists(f"{path}/c")


# ---- routing ----------------------------------------------------------------------------------------------
def routed(spark, rows):
    return spark.createDataFrame(rows, "id long, dest string")


def table_rows(spark, root, name):
    return sorted(r.id for r in spark.read.parquet(f"{root}/{name}").collect())


def test_rows_go_to_the_tables_they_name(spark, out_dir):
    root = out_dir("routes")
    rows = routed(spark, [(1, "a"), (2, "b$20240105"), (3, "b$20240106"), (4, "a"), (5, "s p/a%c")])
    assert publish.write_routed(rows, F.col("dest"), root) == ["a", "b$20240105", "b$20240106", "s p/a%c"]
    assert table_rows(spark, root, "a") == [1, 4]
    got = {(r.id, str(r.day)) for r in spark.read.parquet(f"{root}/b").collect()}
    assert got == {(2, "2024-01-05"), (3, "2024-01-06")}
    more = routed(spark, [(6, "a"), (7, "b$20240106"), (8, "b$20240107")])
    publish.write_routed(more, F.col("dest"), root, write={"b": "truncate"}, create="never")
    assert table_rows(spark, root, "a") == [1, 4, 6] and table_rows(spark, root, "b") == [2, 7, 8]
    assert not [f for f in os.listdir(local(root)) if f.startswith("_route")]


def test_dispositions_are_checked_before_anything_is_published(spark, out_dir):
    root = out_dir("routes2")
    publish.write_routed(routed(spark, [(1, "a")]), F.col("dest"), root)
    both = routed(spark, [(2, "a"), (3, "new")])
    for how in ({"write": {"a": "empty"}}, {"create": {"new": "never"}}, {"write": "nonsense"}):
        with pytest.raises(ValueError):
            publish.write_routed(both, F.col("dest"), root, **how)
        assert table_rows(spark, root, "a") == [1] and not os.path.exists(f"{local(root)}/new")
    with pytest.raises(Exception, match="NULL destination"):
        publish.write_routed(routed(spark, [(4, "a"), (5, None)]), F.col("dest"), root)
    with pytest.raises(ValueError, match="no day"):
        publish.write_routed(routed(spark, [(4, "a$2024")]), F.col("dest"), root)
    assert table_rows(spark, root, "a") == [1]
    assert publish.write_routed(both.limit(0), F.col("dest"), root) == []


def test_route_killed_and_run_again_doubles_nothing(spark, out_dir, monkeypatch):
    root = out_dir("routes3")
    rows = routed(spark, [(i, f"t{i % 6}") for i in range(60)])
    rename, calls = publish.MountedStore.rename, []

    def breaks(self, source, target):
        if "/rows/" in source:
            calls.append(source)
            if len(calls) > 3:
                raise OSError("killed")
        rename(self, source, target)

    monkeypatch.setattr(publish.MountedStore, "rename", breaks)
    with pytest.raises(OSError):
        publish.write_routed(rows, F.col("dest"), root, write="empty", load_id="z")
    monkeypatch.undo()
    publish.write_routed(rows, F.col("dest"), root, write="empty", load_id="z")
    assert sorted(i for t in range(6) for i in table_rows(spark, root, f"t{t}")) == list(range(60))


# ---- the claim of a first write --------------------------------------------------------------------------
def test_of_two_first_writers_one_wins(spark, out_dir):
    for _ in range(3):
        path, told = out_dir("first"), []

        def write(label, path=path, told=told):
            try:
                tables.write_table(spark.range(5).select("id", F.lit(label).alias("w")), path, write="empty")
                told.append(label)
            except ValueError:
                told.append(None)

        both = [threading.Thread(target=write, args=(x,)) for x in ("one", "two")]
        [t.start() for t in both]
        [t.join() for t in both]
        assert sorted(x is None for x in told) == [False, True]
        assert Counter(r.w for r in spark.read.parquet(path).collect()) == {next(x for x in told if x): 5}
        assert not [f for f in os.listdir(local(path)) if f.startswith(("_claim", "_first"))]


def test_claim_of_another_load_and_resuming(spark, out_dir, monkeypatch):
    path = out_dir("first2")
    rename = publish.MountedStore.rename
    monkeypatch.setattr(publish.MountedStore, "rename", lambda self, a, b: (_ for _ in ()).throw(OSError("killed")) if "/rows/" in a else rename(self, a, b))
    with pytest.raises(OSError):
        publish.write_if_empty(spark.range(5), path, load_id="mine")
    monkeypatch.undo()
    with pytest.raises(ValueError, match="another load"):
        publish.write_if_empty(spark.range(9), path)
    publish.write_if_empty(spark.range(5), path, load_id="mine")
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError, match="not empty"):
        publish.write_if_empty(spark.range(9), path)
    assert spark.read.parquet(path).count() == 5


# ---- digits of other scripts --------------------------------------------------------------------------------
def test_every_script_of_the_jvm_is_accepted(spark):
    jvm = spark.sparkContext._jvm.java.lang.Character
    ours = {chr(c): unicodedata.decimal(chr(c)) for c in range(0x80, 0x10000) if unicodedata.category(chr(c)) == "Nd"}
    rng = random.Random(4)
    sample = set(rng.sample(sorted(ours), 60)) | {chr(rng.randrange(0x80, 0xD800)) for _ in range(60)} | {"²", "①", "三", "５"}
    for ch in sample:
        assert jvm.digit(ord(ch), 10) == ours.get(ch, -1)
    rows = [(f"{s}{a}{b}", int(f"{s}{ours[a]}{ours[b]}")) for a, b, s in zip(ours, reversed(ours), ["", "-", "+"] * 200)]
    rows += [("\U0001d7d0", None), ("1١", 11), ("١-", None), ("١" * 25, None), ("²", None), (None, None), ("", None), (" ١", None)]
    df = spark.createDataFrame(rows, "raw string, want long")
    assert [(r.raw, r.x, r.want) for r in df.select("raw", "want", casts.parse_integer("raw").alias("x")).collect() if r.x != r.want] == []
    clock = spark.createDataFrame([("١٢:٠٥:7",), ("\U0001d7d01:0:0",), ("1:2:3",)], "raw string")
    assert [r[0] for r in clock.select(casts.parse_time("raw")).collect()] == ["12:05:07", None, "01:02:03"]
    kv = keyed.parse_kv_lines(spark.createDataFrame([("w, १२",)], "value string"))
    assert [tuple(r) for r in kv.collect()] == [("w", 12)]


# ---- element functions ----------------------------------------------------------------------------------------
class Repeat(elements.EachRow):
    def __init__(self, times):
        self.times = times

    def analyze(self, schema):
        from pyspark.sql.types import LongType, StructType

        return StructType(list(schema.fields)).add("copy", LongType())

    def counts(self, batch):
        return pc.multiply(batch.column("n"), self.times)

    def expand(self, batch, row, copy):
        return pa.RecordBatch.from_arrays([*batch.columns, copy], names=[*batch.schema.names, "copy"])


class Total(elements.ElementFunction):
    def analyze(self, schema):
        from pyspark.sql.types import LongType, StructType

        return StructType().add("total", LongType())

    def setup(self):
        self.total = 0

    def process(self, batch):
        self.total += pc.sum(batch.column("n")).as_py() or 0

    def finish(self):
        yield pa.RecordBatch.from_pydict({"total": pa.array([self.total], pa.int64())})


class Broken(elements.ElementFunction):
    def process(self, batch):
        return batch.rename_columns(["x"] * batch.num_columns)


def test_element_functions(spark):
    df = spark.createDataFrame([("a", 2), ("b", 0), ("c", None), ("d", 1)], "k string, n long")
    got = elements.apply_elements(df, Repeat(2))
    assert got.columns == ["k", "n", "copy"]
    assert sorted((r.k, r.copy) for r in got.collect()) == [("a", 0), ("a", 1), ("a", 2), ("a", 3), ("d", 0), ("d", 1)]
    assert [r.total for r in elements.apply_elements(df.coalesce(1), Total()).collect()] == [3]
    assert elements.apply_elements(df.limit(0), Repeat(1)).count() == 0
    with pytest.raises(Exception, match="promised"):
        elements.apply_elements(df, Broken()).collect()

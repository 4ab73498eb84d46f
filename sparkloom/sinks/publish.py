"""Publishing written folders into path tables: staged, listed, swapped in parallel, safe to repeat.

A load first writes its rows into a staging folder inside the target (hidden from readers by its leading underscore), then a
*list* of the staged folders as one small file. From there on the load only renames: every listed folder is swapped in
on its own - the old folder moves aside, the new one takes its place - by a pool of threads, since a rename is
metadata work. A load that is killed and run again under its ``load_id`` goes on where it stopped: with the list it
writes nothing anew and swaps what is still staged; without it, it starts over. The staging folder is removed last.

Files are reached through the session's Hadoop file system, as Spark's own commits do, so any store Spark can write works;
folders that the driver sees itself are renamed by system calls.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THREADS = 32
# A commit of many folders: task attempts move their files themselves. The staging folder is not read before the list is there.
_COMMIT = ("mapreduce.fileoutputcommitter.algorithm.version", "2")


class Store:
    """The Hadoop file system of a folder."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._hadoop = context._jvm.org.apache.hadoop.fs
        self.fs = self._path(path).getFileSystem(context._jsc.hadoopConfiguration())
        self._io = context._jvm.org.apache.commons.io.IOUtils

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def rename(self, source: str, target: str) -> None:
        if not self.fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def make(self, path: str) -> None:
        self.fs.mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder (none if it is not there)."""
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(path))) if self.exists(path) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Create a small file if it is not there yet: of several callers exactly one is told True."""
        try:
            stream = self.fs.create(self._path(path), False)
        except Exception as e:  # noqa: BLE001 - py4j wraps the store's own exception
            if "AlreadyExists" not in str(e) and not self.exists(path):
                raise
            return False
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def write(self, path: str, text: str) -> None:
        """A whole small file that appears at once."""
        half = f"{path}.{uuid.uuid4().hex}.half"
        self.create(half, text)
        self.rename(half, path)

    def claim(self, path: str, owner: str) -> bool:
        """Take a claim file for an owner, who may come back to it."""
        return self.create(path, owner) or self.read(path) == owner


class MountedStore(Store):
    """A folder the driver sees itself (local or mounted): plain system calls, whose exclusive create is atomic."""

    def __init__(self):  # noqa: D107 - no Hadoop objects
        pass

    @staticmethod
    def _path(path: str) -> str:
        return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path

    def exists(self, path: str) -> bool:
        return os.path.exists(self._path(path))

    def rename(self, source: str, target: str) -> None:
        os.rename(self._path(source), self._path(target))

    def delete(self, path: str) -> None:
        path = self._path(path)
        if os.path.isdir(path):
            shutil.rmtree(path)
        elif os.path.exists(path):
            os.remove(path)

    def make(self, path: str) -> None:
        os.makedirs(self._path(path), exist_ok=True)

    def names(self, path: str) -> list[str]:
        return sorted(os.listdir(self._path(path))) if self.exists(path) else []

    def read(self, path: str) -> str:
        with open(self._path(path), encoding="utf-8") as f:
            return f.read()

    def create(self, path: str, text: str) -> bool:
        try:
            handle = os.open(self._path(path), os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644)
        except FileExistsError:
            return False
        with open(handle, "w", encoding="utf-8") as f:
            f.write(text)
        return True


def store_of(spark: SparkSession, path: str) -> Store:
    scheme = Store(spark, path).fs.getUri().getScheme()
    return MountedStore() if scheme == "file" else Store(spark, path)


@contextmanager
def _all_tasks(spark: SparkSession):
    """Keep every shuffle partition as a task while a table of many folders is written: the work there is a file per folder, and
    by their bytes alone thousands of small folders would be merged into one task. (Large ones are still split by size.)"""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def swap_folders(store: Store, staged: str, target: str, aside: str, names: list[str]) -> None:
    """Put the folders ``names`` of ``staged`` in the place of those in ``target``. Repeating it after any stop ends in the same
    state: a folder that is no longer staged has been published. Three listings, then one or two renames a folder, in parallel."""
    left, there, moved = (set(store.names(x)) for x in (staged, target, aside))

    def swap(name: str) -> None:
        if name not in left:
            return
        if name in there:
            if name in moved:  # a stop between the two renames of an earlier try, then a foreign write
                store.delete(f"{aside}/{name}")
            store.rename(f"{target}/{name}", f"{aside}/{name}")
        store.rename(f"{staged}/{name}", f"{target}/{name}")

    store.make(aside)
    store.make(target)
    with ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(swap, names))


def _stage(df: DataFrame, folder: str, partition_col: str, fmt: str, store: Store) -> list[str]:
    """Write ``df`` by ``partition_col`` under ``folder/rows`` unless its list is there; the names of its folders."""
    listing = f"{folder}/list.json"
    if not store.exists(listing):
        with _all_tasks(df.sparkSession):
            df.write.mode("overwrite").option(*_COMMIT).option("partitionOverwriteMode", "static").partitionBy(partition_col).format(fmt).save(f"{folder}/rows")
        names = [n for n in store.names(f"{folder}/rows") if n.startswith(f"{partition_col}=")]
        store.write(listing, json.dumps(names))
    return json.loads(store.read(listing))


def publish_partitions(df: DataFrame, target: str, partition_col: str, fmt: str = "parquet", load_id: str | None = None) -> list[str]:
    """Replace exactly the partitions of ``df`` in a path table; the published folder names."""
    target = target.rstrip("/")
    folder = f"{target}/_load-{load_id or uuid.uuid4().hex}"
    store = store_of(df.sparkSession, target)
    names = _stage(df, folder, partition_col, fmt, store)
    swap_folders(store, f"{folder}/rows", target, f"{folder}/old", names)
    store.delete(folder)
    return names


# --------------------------------------------------------------------------------------------
# K7: rows to the tables their destination names
# --------------------------------------------------------------------------------------------
DESTINATION = "_destination"


def _rows_in(store: Store, path: str) -> bool:
    return any(not n.startswith(("_", ".")) for n in store.names(path))


def write_routed(df: DataFrame, destination: Column, root: str, write: str | dict[str, str] = "append", create: str | dict[str, str] = "if_needed",
                 day_col: str = "day", fmt: str = "parquet", load_id: str | None = None) -> list[str]:
    """K7: every row goes to the table its destination names, in one pass over the input.

    A destination is ``table`` (the folder ``root/table``) or ``table$yyyymmdd`` (that day's folder, ``day_col=yyyy-mm-dd``, in it);
    a NULL one fails the write. ``write`` (``append``, ``truncate``, ``empty``) and ``create`` (``if_needed``, ``never``) hold for all tables or
    are given per table; a day of a table is replaced or appended to on its own. Rows are dealt by destination (a large one is split
    over several tasks) and staged; then every destination's dispositions are checked, and only if all hold is any published.
    Published folders are renamed, so a load repeated under its ``load_id`` doubles nothing. Returns the destinations."""
    from sparkloom.sinks.tables import CREATE_DISPOSITIONS, WRITE_DISPOSITIONS

    root = root.rstrip("/")
    load = load_id or uuid.uuid4().hex
    folder, store = f"{root}/_route-{load}", store_of(df.sparkSession, root)
    named = F.when(destination.isNull(), F.raise_error(F.lit("NULL destination"))).otherwise(destination.cast("string"))
    names = _stage(df.withColumn(DESTINATION, named).hint("rebalance", DESTINATION), folder, DESTINATION, fmt, store)
    routes = []
    for name in names:
        full = unquote(name.split("=", 1)[1])
        table, _, day = full.partition("$")
        how, may = (x.get(table, d) if isinstance(x, dict) else x for x, d in ((write, "append"), (create, "if_needed")))
        if how not in WRITE_DISPOSITIONS or may not in CREATE_DISPOSITIONS:
            raise ValueError(f"write must be one of {WRITE_DISPOSITIONS}, create one of {CREATE_DISPOSITIONS}")
        if day and not (len(day) == 8 and day.isdigit()):
            raise ValueError(f"{full} names no day")
        place = f"{root}/{table}/{day_col}={day[:4]}-{day[4:6]}-{day[6:]}" if day else f"{root}/{table}"
        staged = store.exists(f"{folder}/rows/{name}")
        if staged and may == "never" and not store.exists(f"{root}/{table}"):
            store.delete(folder)
            raise ValueError(f"table {table} does not exist and create disposition is 'never'")
        if staged and how == "empty" and _rows_in(store, place) and not store.exists(f"{folder}/begun"):
            store.delete(folder)
            raise ValueError(f"{full} is not empty (write disposition 'empty')")
        routes.append((name, place, how))
    store.write(f"{folder}/begun", load)
    store.make(f"{folder}/old")

    def publish(route: tuple) -> None:
        name, place, how = route
        staged = f"{folder}/rows/{name}"
        if how == "truncate" and store.exists(staged):
            store.make(os.path.dirname(place))
            if store.exists(place):
                store.delete(f"{folder}/old/{name}")
                store.rename(place, f"{folder}/old/{name}")
            store.rename(staged, place)
        elif how != "truncate":
            store.make(place)
            for file in store.names(staged):  # file names are the write job's own, so they never meet others
                store.rename(f"{staged}/{file}", f"{place}/{file}")

    with ThreadPoolExecutor(THREADS) as pool:
        list(pool.map(publish, routes))
    store.delete(folder)
    return [unquote(n.split("=", 1)[1]) for n in names]


# --------------------------------------------------------------------------------------------
# K4: a first write that only one of several writers may make
# --------------------------------------------------------------------------------------------
def write_if_empty(df: DataFrame, target: str, partition_by: list[str] | None = None, fmt: str = "parquet", load_id: str | None = None) -> str:
    """Write to a path table only if it has no rows *at commit*: rows are staged, then the writer claims the table by creating
    one file if it is absent, looks for rows, and moves its own in. Of writers at the same time exactly one succeeds; the others raise and leave
    nothing. A writer that was killed while it held the claim is resumed under its ``load_id``."""
    target, load = target.rstrip("/"), load_id or uuid.uuid4().hex
    store, folder, claim = store_of(df.sparkSession, target), f"{target}/_first-{load}", f"{target}/_claim"
    listing = f"{folder}/list.json"
    if not store.exists(listing):
        writer = df.write.mode("overwrite").option(*_COMMIT).format(fmt)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(f"{folder}/rows")
        store.write(listing, json.dumps(store.names(f"{folder}/rows")))
    begun = store.exists(claim) and store.read(claim) == load
    if not store.claim(claim, load):
        store.delete(folder)
        raise ValueError(f"target {target} is being written by another load (write disposition 'empty')")
    if not begun and _rows_in(store, target):
        store.delete(claim)
        store.delete(folder)
        raise ValueError(f"target {target} is not empty (write disposition 'empty')")
    for name in json.loads(store.read(listing)):
        if not name.startswith(("_", ".")) and store.exists(f"{folder}/rows/{name}"):
            store.rename(f"{folder}/rows/{name}", f"{target}/{name}")
    store.delete(folder)
    store.delete(claim)
    return target

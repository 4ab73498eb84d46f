"""Text shards with names a downstream job can rely on: ``prefix-00002-of-00005.suffix``, header on every one.

A Python data source whose Arrow writers stream their partition into a hidden staging folder of the target and whose commit
gives the files their names: shard numbers are partition numbers, the total is known once all tasks are through. An empty
shard is a file too (its header, or nothing). A failed or repeated attempt leaves its file in the staging folder, which goes
away with commit or abort.

Rows may be *pieces* of lines, so that one line can be longer than any row, and a shard larger than any task's share: the
pieces, in the order of the files, are cut evenly over the tasks, each writes its slice of a shard as a part, and a second job
joins the parts, one task for each. Where the store writes a file at any position (local and mounted folders), every part goes
straight to its place; a file of another store has one writer, which appends the shard's parts and holds none of them.

Targets are paths or URIs that ``pyarrow.fs`` opens (local and mounted folders, S3, GCS, HDFS with libhdfs).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.formatting import COGROUP_KEY_SEP, COGROUP_SIDE_SEP, KEY_SEP, LIST_CLOSE, LIST_OPEN, LIST_SEP
from sparkloom.operators import keyed

FORMAT, PARTS = "sparkloom_shards", "sparkloom_shard_parts"
BLOCK = 1 << 20  # bytes of a part that are held as it is joined


def _sources():
    """The data source classes. They are made here so that they travel to the workers by value, installed package or not."""
    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

    def open_store(path):
        from pyarrow import fs

        if path.startswith("file:"):
            path = "/" + path[len("file:"):].lstrip("/")
        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)

    def put(out, text):
        """Append the bytes of a string array, which lie one after the other."""
        for chunk in text.chunks if hasattr(text, "chunks") else [text]:
            offsets = memoryview(chunk.buffers()[1]).cast("q")
            a, z = offsets[chunk.offset], offsets[chunk.offset + len(chunk)]
            if z > a:
                out.write(chunk.buffers()[2].slice(a, z - a))

    class Shard(WriterCommitMessage):
        def __init__(self, number, file):
            self.number, self.file = number, file

    class ShardWriter(DataSourceArrowWriter):
        def __init__(self, options, overwrite):
            self.path, self.overwrite = options["path"].rstrip("/"), overwrite
            self.prefix, self.suffix = options.get("prefix", "part"), options.get("suffix", "")
            self.header, self.line_end = options.get("header"), options.get("line_end", "")
            self.staging, self.total = f"_shards-{options['job']}", int(options.get("num_shards", "0"))
            store, root = open_store(self.path)  # on the driver, once: a task that comes after an abort finds no folder
            store.create_dir(f"{root}/{self.staging}", recursive=True)

        def write(self, iterator):
            import pyarrow as pa
            import pyarrow.compute as pc
            from pyspark import TaskContext

            task = TaskContext.get()
            store, root = open_store(self.path)
            file = f"{root}/{self.staging}/{task.partitionId():05d}-{task.taskAttemptId()}"
            close = self.line_end + "\n"
            with store.open_output_stream(file) as out:
                if self.header is not None:
                    out.write((self.header + "\n").encode())
                for batch in iterator:
                    if batch.num_rows:
                        text = batch.column("value").cast(pa.large_string()).fill_null("")
                        put(out, pc.binary_join_element_wise(text, pa.scalar(close, pa.large_string()), pa.scalar("", pa.large_string())))
            return Shard(task.partitionId(), file.rsplit("/", 1)[1])

        def commit(self, messages):
            store, root = open_store(self.path)
            if self.overwrite:
                self.clear(store, root)
            shards = {m.number: m.file for m in messages if m is not None and m.file is not None}
            total = self.total or len(shards)
            for number in range(total):
                name = f"{root}/{self.prefix}-{number:05d}-of-{total:05d}{self.suffix}"
                if number in shards:
                    store.move(f"{root}/{self.staging}/{shards[number]}", name)
                else:  # an input that is known to be empty has fewer tasks than shards
                    with store.open_output_stream(name) as out:
                        out.write(b"" if self.header is None else (self.header + "\n").encode())
            self.abort(messages)

        def clear(self, store, root):
            from pyarrow import fs

            for old in store.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if old.is_file and old.base_name.startswith(f"{self.prefix}-") and "-of-" in old.base_name and old.base_name.endswith(self.suffix):
                    store.delete_file(old.path)

        def abort(self, messages):
            from pyarrow import fs

            store, root = open_store(self.path)
            if store.get_file_info(f"{root}/{self.staging}").type != fs.FileType.NotFound:
                store.delete_dir(f"{root}/{self.staging}")

    class PartWriter(ShardWriter):
        """Pieces in the order of the files: each task's slice of a shard is a part, ``partition-shard-attempt``. A line ends where
        the next one begins, so every line of a part comes after an end; the shard's first part has one too many."""

        def write(self, iterator):
            import pyarrow as pa
            import pyarrow.compute as pc
            from pyspark import TaskContext

            task = TaskContext.get()
            store, root = open_store(self.path)
            close, none = pa.scalar(self.line_end + "\n", pa.large_string()), pa.scalar("", pa.large_string())
            out, files = None, {}
            try:
                for batch in iterator:
                    text = batch.column("value").cast(pa.large_string()).fill_null("")
                    text = pc.binary_join_element_wise(pc.if_else(batch.column("first"), close, none), text, none)
                    for number in pc.unique(batch.column("shard")).to_pylist():
                        if number not in files:
                            if out is not None:
                                out.close()
                            files[number] = f"{task.partitionId()}-{number}-{task.taskAttemptId()}"
                            out = store.open_output_stream(f"{root}/{self.staging}/{files[number]}")
                        put(out, text.filter(pc.equal(batch.column("shard"), number)))
            finally:
                if out is not None:
                    out.close()
            return Shard(task.partitionId(), files)

        def commit(self, messages):
            import json

            store, root = open_store(self.path)
            with store.open_output_stream(f"{root}/{self.staging}/parts") as out:  # files of other attempts are not on it
                out.write(json.dumps([(m.number, number, file) for m in messages if m is not None for number, file in m.file.items()]).encode())

    class Places(InputPartition):
        def __init__(self, rows, anywhere):
            self.rows, self.anywhere = rows, anywhere

    class PartReader(DataSourceReader):
        """The parts and their places in the shards: a partition for each part, or for each shard whose file has one writer."""

        def __init__(self, options):
            self.path, self.line_end = options["path"].rstrip("/"), options.get("line_end", "")
            self.staging = f"_shards-{options['job']}"

        def partitions(self):
            import json

            store, root = open_store(self.path)
            with store.open_input_stream(f"{root}/{self.staging}/parts") as listed:
                parts = sorted(json.loads(listed.read()))
            sizes = store.get_file_info([f"{root}/{self.staging}/{file}" for _, _, file in parts])
            shards = {}
            for (_, number, file), info in zip(parts, sizes, strict=True):
                shards.setdefault(number, []).append((file, info.size))
            placed = []
            for number, files in sorted(shards.items()):
                at, rows = 0, []
                for i, (file, size) in enumerate(files):
                    skip = 0 if i else len((self.line_end + "\n").encode())
                    rows.append((number, file, skip, at, i + 1 == len(files)))
                    at += size - skip
                placed.append(rows)
            anywhere = bool(placed) and self.anywhere(store, f"{root}/{self.staging}/trial")
            if anywhere:
                placed = [[row] for rows in placed for row in rows]
            return [Places(rows, anywhere) for rows in placed or [[]]]

        def anywhere(self, store, file):
            """Whether the store writes a file at any position (not every mounted folder does)."""
            import os

            from pyarrow import fs

            if not isinstance(store, fs.LocalFileSystem):
                return False
            try:
                with open(os.open(file, os.O_RDWR | os.O_CREAT), "r+b", buffering=0) as out:
                    return os.pwrite(out.fileno(), b"z", 1) + os.pwrite(out.fileno(), b"a", 0) == 2 and os.pread(out.fileno(), 2, 0) == b"az"
            except OSError:
                return False
            finally:
                if os.path.exists(file):
                    os.remove(file)

        def read(self, partition):
            for row in partition.rows:
                yield (*row, partition.anywhere)

    class JoinWriter(ShardWriter):
        """Parts into whole shards. A task has one part and writes it at its place (a repeated attempt writes the same bytes
        there), or all parts of a shard in their order."""

        def write(self, iterator):
            import os

            from pyspark import TaskContext

            store, root = open_store(self.path)
            number, file, out = None, None, None
            try:
                for row in (r for batch in iterator for r in batch.to_pylist()):
                    if out is None:
                        number = row["shard"]
                        file = f"whole-{number}" if row["anywhere"] else f"whole-{number}-{TaskContext.get().taskAttemptId()}"
                        if row["anywhere"]:
                            out = open(os.open(f"{root}/{self.staging}/{file}", os.O_WRONLY | os.O_CREAT, 0o666), "wb")
                            out.seek(row["at"])
                        else:
                            out = store.open_output_stream(f"{root}/{self.staging}/{file}")
                    with store.open_input_stream(f"{root}/{self.staging}/{row['file']}") as part:
                        part.read(row["skip"])
                        while block := part.read(BLOCK):
                            out.write(block)
                    if row["last"]:
                        out.write((self.line_end + "\n").encode())
            finally:
                if out is not None:
                    out.close()
            return Shard(number, file)

    class Shards(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def schema(self):
            return "value string"

        def writer(self, schema, overwrite):
            return {"parts": PartWriter, "join": JoinWriter}.get(self.options.get("step"), ShardWriter)(dict(self.options), overwrite)

    class Parts(DataSource):
        @classmethod
        def name(cls):
            return PARTS

        def schema(self):
            return "shard int, file string, skip bigint, at bigint, last boolean, anywhere boolean"

        def reader(self, schema):
            return PartReader(dict(self.options))

    return Shards, Parts


def _save(df: DataFrame, path: str, prefix: str, suffix: str, header: str | None, mode: str, num_shards: int | None, line_end: str = "",
          job: str | None = None, step: str = "whole") -> str:
    for source in _sources():
        df.sparkSession.dataSource.register(source)
    writer = df.write.format(FORMAT).mode(mode).option("path", path).option("prefix", prefix).option("suffix", suffix)
    writer = writer.option("job", job or uuid.uuid4().hex).option("line_end", line_end).option("step", step)
    writer = writer.option("num_shards", str(num_shards or 0))
    (writer if header is None else writer.option("header", header)).save()
    return path


def write_named_lines(df: DataFrame, path: str, prefix: str = "part", suffix: str = "", col: str | None = None, num_shards: int | None = None,
                      by: Column | str | None = None, header: str | None = None, mode: str = "append") -> str:
    """K1/K2: one line per row in files ``<prefix>-SSSSS-of-NNNNN<suffix>``, the header first in every file, empty ones too.

    ``num_shards`` fixes the number of files (rows dealt evenly, or by ``by``); without it there is one per partition.
    ``append`` adds files of other names beside those there and replaces files of the same names, ``overwrite`` first removes the
    prefix's shards."""
    name = col or next(iter(df.columns))
    lines = df if by is None or not isinstance(by, str) else df.withColumn("_by", F.col(by))
    if num_shards is not None:
        keys = [] if by is None else ["_by"] if isinstance(by, str) else [by]
        lines = lines.repartition(num_shards, *keys)
    return _save(lines.select(F.col(name).cast("string").alias("value")), path, prefix, suffix, header, mode, num_shards)


# --------------------------------------------------------------------------------------------
# A1 / J1 whose lines are longer than any row
# --------------------------------------------------------------------------------------------
def _write_pieces(pieces: DataFrame, order: list[str], path: str, num_shards: int, prefix: str, suffix: str, mode: str) -> str:
    """A key's shard is its hash's; the pieces are cut over the tasks by their order in the files, so that neither a shard nor a
    line is one task's share."""
    numbered = pieces.select(F.pmod(F.hash(order[0]), F.lit(num_shards)).alias("shard"), "*")
    placed = numbered.repartitionByRange("shard", *order).sortWithinPartitions("shard", *order)
    job = uuid.uuid4().hex
    _save(placed.select("shard", "value", "first"), path, prefix, suffix, None, mode, num_shards, LIST_CLOSE, job, "parts")
    parts = pieces.sparkSession.read.format(PARTS).option("path", path).option("job", job).option("line_end", LIST_CLOSE).load()
    return _save(parts, path, prefix, suffix, None, mode, num_shards, LIST_CLOSE, job, "join")


def write_group_lines(df: DataFrame, path: str, key: str = "k", value: str = "v", num_shards: int = 1, chunk_size: int = 10_000,
                      prefix: str = "part", suffix: str = "", mode: str = "append") -> str:
    """A1 + P6 + K1 for groups of any size: one line ``key:[v1, v2, ...]`` per key, values ascending.

    The lists are made as chunks (``group_chunks``: sorted runs, no row or task holds a group), which are written as parts of the
    shards and joined. Memory is a batch of chunks, whatever a key holds; a key's line lies in one file, but sorting, rendering
    and writing it are many tasks' work. A NULL key reads ``null``."""
    chunks = keyed.group_chunks(df, key, value, chunk_size)
    head = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(KEY_SEP + LIST_OPEN))
    first = F.col("chunk") == F.lit(0)
    pieces = chunks.select(F.col(key).alias("_key"), "chunk", first.alias("first"), F.concat(F.when(first, head).otherwise(F.lit(LIST_SEP)), "txt").alias("value"))
    return _write_pieces(pieces, ["_key", "chunk"], path, num_shards, prefix, suffix, mode)


def write_cogroup_lines(inputs: dict[str, DataFrame], path: str, key: str = "k", value: str = "v", num_shards: int = 1, chunk_size: int = 10_000,
                        prefix: str = "part", suffix: str = "", mode: str = "append") -> str:
    """J1 + P8 + K1 for groups of any size: one line ``key : [a, b];[c]`` per key, an input without the key as ``[]``.

    Every key has an opening piece per input (chunk -1); the chunks of ``cogroup_chunks`` follow them."""
    number = F.create_map(*[F.lit(x) for i, t in enumerate(inputs) for x in (t, i)])
    chunks = keyed.cogroup_chunks(inputs, key, value, chunk_size)
    body = chunks.select(F.col("k").alias("_key"), number[F.col("tag")].alias("side"), "chunk", F.lit(False).alias("first"),
                         F.concat(F.when(F.col("chunk") > F.lit(0), F.lit(LIST_SEP)).otherwise(F.lit("")), "txt").alias("value"))
    keys = chunks.where(F.col("chunk") == F.lit(0)).select(F.col("k").alias("_key")).distinct()
    head = F.concat(F.coalesce(F.col("_key").cast("string"), F.lit("null")), F.lit(COGROUP_KEY_SEP + LIST_OPEN))
    opening = keys.select("_key", F.explode(F.array(*[F.lit(i) for i in range(len(inputs))])).alias("side")).select(
        "_key", "side", F.lit(-1).cast("bigint").alias("chunk"), (F.col("side") == F.lit(0)).alias("first"),
        F.when(F.col("side") == F.lit(0), head).otherwise(F.lit(LIST_CLOSE + COGROUP_SIDE_SEP + LIST_OPEN)).alias("value"))
    return _write_pieces(opening.unionByName(body), ["_key", "side", "chunk"], path, num_shards, prefix, suffix, mode)

"""Small helpers shared by the operators of this sub-package (Arrow buffers, ragged arrays, settings)."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.session import shared_dir


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a checkout that is not installed)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


class Scratch:
    """Intermediate tables of one operator run in the shared folder, removed once its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.tables = spark, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_dir(self.spark, name)
        df.write.mode("overwrite").parquet(path)
        self.tables.append((path, self.spark.read.schema(df.schema).parquet(path)))
        return self.tables[-1][1]

    def drop(self, *tables: DataFrame | None) -> None:
        """Remove tables that ``write`` returned, as soon as what was made of them is written."""
        gone = [(path, table) for path, table in self.tables if any(table is t for t in tables)]
        self._remove([path for path, _ in gone])
        self.tables = [(path, table) for path, table in self.tables if not any(table is t for t in tables)]

    def close(self, keep: int = 0, forget: bool = True) -> None:
        """Remove all tables but the last ``keep`` written, which stay for good unless ``forget`` is off."""
        last = len(self.tables) - keep
        self._remove([path for path, _ in self.tables[:last]])
        self.tables = [] if forget else self.tables[last:]

    def _remove(self, paths: list) -> None:
        context = self.spark.sparkContext
        for path in paths:
            where = context._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def fold(key: Column, modulus: int) -> Column:
    """crc32 of a key's decimal text, modulo ``modulus`` (the train / held-out split of the contracts)."""
    return F.crc32(key.cast("string").cast("binary")) % modulus


def release_memory(caches: bool = True) -> None:
    """In a Python worker, which lives through many tasks: give back what earlier ones left (fragment caches, Arrow's pool,
    freed heap). Called as a task or group begins."""
    import ctypes

    from . import fragments

    if caches:
        fragments.release()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc: the allocator keeps its own counsel
        pass


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string array without copying; nulls are empty texts."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    _, offs, data = arr.buffers()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offs, kind, len(arr) + 1, arr.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def ragged_take(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[starts[i] : starts[i] + lens[i]]`` over i."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return values[:0]
    return values[np.arange(total) + np.repeat(starts - (ends - lens), lens)]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix), in place on a uint64 array."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i] : bounds[i + 1]]`` (0 for an empty segment), exact for integers."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]

"""Element functions that a user writes, as Arrow table functions.

An element function is an object with parameters (its constructor's), ``analyze`` and ``process``. ``analyze`` says on the
driver which columns come out for which columns go in; ``process`` gets whole Arrow batches and returns rows - none, one
or many for each row - as batches, never one row at a time. It runs as a narrow map: no shuffle, the
batches of a task one after the other, nothing held between them unless the function holds it.

``EachRow`` is the shorter form for functions that give every row a number of copies: ``counts`` says how many, and
``expand`` fills in the columns of the copies.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from sparkloom.session import reach_workers


class ElementFunction:
    """Base of user-written element functions; an instance travels to the tasks with its parameters."""

    def analyze(self, schema: StructType) -> StructType:
        """Columns that come out (by default those that go in)."""
        return schema

    def setup(self) -> None:
        """Called once per task before its first batch (compiled patterns, opened models)."""

    def process(self, batch: pa.RecordBatch) -> pa.RecordBatch | Iterable[pa.RecordBatch] | None:
        raise NotImplementedError

    def finish(self) -> Iterable[pa.RecordBatch]:
        """Rows after the task's last batch."""
        return ()


class Where(ElementFunction):
    """An element function that keeps or drops rows: ``keep`` returns a boolean array (NULL drops)."""

    def keep(self, batch: pa.RecordBatch) -> pa.Array:
        raise NotImplementedError

    def process(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(self.keep(batch))


class EachRow(ElementFunction):
    """An element function that gives row i ``counts(batch)[i]`` copies, then rewrites the columns."""

    def counts(self, batch: pa.RecordBatch) -> pa.Array:
        raise NotImplementedError

    def expand(self, batch: pa.RecordBatch, row: pa.Array, copy: pa.Array) -> pa.RecordBatch:
        """``batch`` holds the copies, ``row`` each one's row in the batch, ``copy`` its number among the row's copies."""
        return batch

    def process(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        import numpy as np

        n = np.asarray(pc.fill_null(self.counts(batch), 0)).astype(np.int64)
        row = np.repeat(np.arange(batch.num_rows), n)
        copy = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        return self.expand(batch.take(pa.array(row)), pa.array(row), pa.array(copy))


def apply_elements(df: DataFrame, function: ElementFunction) -> DataFrame:
    """The rows that ``function`` makes of ``df``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    reach_workers(df.sparkSession)
    schema = function.analyze(df.schema)
    names = to_arrow_schema(schema).names

    def checked(out: pa.RecordBatch | Iterable[pa.RecordBatch] | None) -> Iterator[pa.RecordBatch]:
        for b in () if out is None else [out] if isinstance(out, pa.RecordBatch) else out:
            if b.schema.names != names:
                raise ValueError(f"process returned the columns {b.schema.names}, analyze promised {names}")
            yield b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function.setup()
        for b in batches:
            yield from checked(function.process(b))
        yield from checked(function.finish())

    # The function's own module travels with it (the workers need not have it); this package they have.
    own = sys.modules.get(type(function).__module__)
    by_value = own is not None and own.__name__.split(".")[0] not in ("sparkloom", "__main__")
    if by_value:
        cloudpickle.register_pickle_by_value(own)
    try:
        return df.mapInArrow(run, schema)  # pickled here
    finally:
        if by_value:
            cloudpickle.unregister_pickle_by_value(own)

"""What the operators of this package share: table access, stored intermediates, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, survives lost executors."""
    return stored_at(df, scratch_path(df.sparkSession, purpose))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """As `stored`, at a path that the caller removes when nothing reads it any more."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind as long as ``df`` has a column of it (in any case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def tidied(tasks: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``tasks`` for `mapInArrow`, at whose end the Python worker gives freed memory back, as workers serve
    the tasks of all later stages too."""

    def run(batches: Iterator) -> Iterator:
        yield from tasks(batches)
        import ctypes
        import gc

        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return run


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, without decoding; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def added(sent: DataFrame, dtype: str, lanes: int = 64) -> dict[int, np.ndarray]:
    """Element-wise sums of the arrays in ``sent`` (task int, part int, data binary) by part.

    Two levels, so that a task holds its share of the senders' parts only. What reaches the driver is
    one array per part, whatever the number of senders; they are added in a fixed order.
    """

    def add(rows: pd.DataFrame) -> np.ndarray:
        return sum(np.frombuffer(d, dtype) for d in rows.sort_values("task")["data"])

    def first(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"task": [key[1]], "part": [key[0]], "data": [add(rows).tobytes()]})

    def last(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"task": [0], "part": [key[0]], "data": [add(rows).tobytes()]})

    schema = "task int, part int, data binary"
    lane = F.pmod("task", F.lit(lanes)).alias("lane")
    some = sent.groupBy("part", lane).applyInPandas(first, schema)
    total = some.groupBy("part").applyInPandas(last, schema)
    return {r["part"]: np.frombuffer(bytes(r["data"]), dtype) for r in total.collect()}


def list_array(values: pa.Array, counts) -> pa.ListArray:
    """A list column from its flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)

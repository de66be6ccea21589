"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import drop_folder, scratch_path, ship, shuffles_removed  # noqa: F401

_STORED: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor makes Spark read the table again, not rebuild it, and a
    step with Python or sampling in it runs exactly once. The shuffle files of the write go with it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _STORED.append(path)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_so_far() -> int:
    """A mark for :func:`drop_stored`."""
    return len(_STORED)


def drop_stored(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Delete the tables that :func:`stored` has written since the mark, but the last ``keep`` of them.
    For callers that have written what was made from them; nothing else is ever deleted."""
    gone = _STORED[since:len(_STORED) - keep]
    del _STORED[since:len(_STORED) - keep]
    for name in gone:
        drop_folder(spark, name)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with as many underscores as it takes, so that ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(rows: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with a column ``name``: 0, 1, 2, ... within each value of ``by``, ascending by ``order``.

    ``by`` and ``order`` together must tell rows apart (or equal rows must be interchangeable), and
    ``by`` must not be null. One range shuffle; a value of ``by`` that holds most rows is spread over
    many tasks, as ``order`` cuts it. What is joined back is one row per value and task.
    """
    spread = rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
    placed = stored(spread.withColumn("place_", F.monotonically_increasing_id()), "placed")
    task = F.shiftright("place_", 33).alias("task_")
    runs = placed.groupBy(by, task).agg(F.min("place_").alias("first_"), F.count("*").alias("n_"))
    earlier = F.sum("n_").over(Window.partitionBy(by).orderBy("task_").rowsBetween(Window.unboundedPreceding, -1))
    runs = stored(runs.withColumn("shift_", F.coalesce(earlier, F.lit(0)) - F.col("first_")).select(by, "task_", "shift_"), "runs")
    return (placed.withColumn("task_", F.shiftright("place_", 33)).join(runs, [by, "task_"])
            .withColumn(name, F.col("place_") + F.col("shift_")).select(*rows.columns, name))


#: Rows that a Python step sees at once.
PART_ROWS = 1024
_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
          "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}


def map_frames(df: DataFrame, fn, schema: str) -> DataFrame:
    """``df.mapInPandas(fn, schema)`` whose whole numbers stay whole beside nulls (pandas alone would
    make them floating, which is wrong beyond 2**53)."""
    fields = [x.split() for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = pa.schema([(name, _ARROW[kind]) for name, kind in fields])
        whole = {pa.int64(): pd.Int64Dtype()}
        # a batch may hold thousands of long texts: they become Python objects in smaller parts
        parts = (b.slice(lo, PART_ROWS) for b in batches for lo in range(0, b.num_rows, PART_ROWS))
        for out in fn(b.to_pandas(types_mapper=whole.get) for b in parts):
            yield from pa.Table.from_pandas(out[target.names], target, preserve_index=False).to_batches()

    return df.mapInArrow(run, schema)

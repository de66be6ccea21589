"""An append-only message log in a folder, as a Python streaming data source.

A log is a folder of segments; a segment is a file of JSON lines whose name is its number. It is
written under another name and renamed when it is whole, so what carries a number never changes. An
offset is the number of segments read so far; Spark keeps the offsets in the checkpoint of the query, and
the source keeps its own first offset beside it, so that ``latest`` is fixed by the first start even if
no message came before the consumer went down. The folder must be mounted by driver and executors.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..session import ship

# the process that plans a streaming source does not see files sent to the workers: the source goes to it whole
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "ratewise_log"
SCHEMA = "key string, value string"


def _local(path: str) -> str:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"a folder log needs a mounted folder, not {path}")
    return path


def _segment(n: int) -> str:
    return f"{n:020d}.jsonl"


def end(path: str) -> int:
    """How many segments the log has."""
    try:
        names = [x for x in os.listdir(_local(path)) if x.endswith(".jsonl")]
    except FileNotFoundError:
        return 0
    return max((int(x[:20]) + 1 for x in names), default=0)


def _publish(part: str, folder: str) -> None:
    """Give a whole file the next free number: a hard link fails if the number is taken."""
    while True:
        try:
            os.link(part, os.path.join(folder, _segment(end(folder))))
        except FileExistsError:
            continue
        os.remove(part)
        return


def append(messages: DataFrame, path: str) -> None:
    """Publish (key, value) messages: tasks write the parts, the driver numbers them when all are whole.
    An attempt that fails leaves a part without a number, which no reader sees."""
    ship(messages.sparkSession)
    folder, run = _local(path), uuid.uuid4().hex
    os.makedirs(folder, exist_ok=True)

    def write(batches):
        import pyarrow as pa
        name, n = os.path.join(folder, f".part-{run}-{uuid.uuid4().hex}"), 0
        with open(name, "w", encoding="utf-8") as f:
            for b in batches:
                for key, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    f.write(json.dumps({"key": key, "value": value}) + "\n")
                    n += 1
            f.flush()
            os.fsync(f.fileno())
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["part", "n"])

    rows = messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
    for r in sorted(rows.mapInArrow(write, "part string, n long").collect()):  # one row per task
        if r["n"]:
            _publish(r["part"], folder)
        else:
            os.remove(r["part"])


class _Part(InputPartition):
    def __init__(self, name: str):
        super().__init__(name)
        self.name = name


class LogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.start, self.first = options["path"], options["start"], options.get("first")

    def initialOffset(self) -> dict:
        """Asked for until a first batch is committed; the answer is kept, so it is always the same."""
        if self.start == "earliest":
            return {"segments": 0}
        kept = _local(self.first)
        if not os.path.exists(kept):
            os.makedirs(os.path.dirname(kept) or ".", exist_ok=True)
            new = f"{kept}.{uuid.uuid4().hex}"
            with open(new, "w", encoding="utf-8") as f:
                json.dump({"segments": end(self.path)}, f)
            try:
                os.link(new, kept)
            except FileExistsError:
                pass
            os.remove(new)
        with open(kept, encoding="utf-8") as f:
            return json.load(f)

    def latestOffset(self) -> dict:
        return {"segments": end(self.path)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [_Part(os.path.join(_local(self.path), _segment(n))) for n in range(start["segments"], end["segments"])]

    def read(self, partition: _Part) -> Iterator[tuple]:
        with open(partition.name, encoding="utf-8") as f:
            for line in f:
                row = json.loads(line)
                yield row["key"], row["value"]

    def commit(self, end: dict) -> None:
        """Segments are kept: other consumers read them too."""


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogReader(dict(self.options))


def read_stream(spark: SparkSession, path: str, starting_offsets: str = "latest", checkpoint: str | None = None) -> DataFrame:
    """(key, value) messages of a log. ``latest``: those after the first start with ``checkpoint``."""
    ship(spark)
    spark.dataSource.register(LogSource)
    reader = spark.readStream.format(FORMAT).option("path", path).option("start", starting_offsets)
    if checkpoint:
        reader = reader.option("first", f"{checkpoint.rstrip('/')}-first-offset")
    return reader.load()

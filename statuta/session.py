"""Getting this package's code to the executors, and row functions over Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(), "statuta_code.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "statuta")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, top))
    spark.sparkContext.addPyFile(out)
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. Where it is unset, a local session (tests) gets a temporary folder; a cluster needs one that all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir isn't set: it must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="statuta-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Spark's setting by which an execution's shuffle files go at its end, not when the driver's garbage is collected.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df written as a table in the shared folder and read again: cuts the lineage, survives lost executors.

    The shuffle files that led to the table are deleted once it is written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/statuta/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables. Only for tables that nothing still to be computed reads: what was made of them is stored itself."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def map_rows(df: DataFrame, schema: str | StructType, function: Callable[[dict], Iterable[dict]], rows: int = 500) -> DataFrame:
    """Each row of df, as a dict, to any number of rows of the schema; Arrow batches in and out."""
    ship(df.sparkSession)
    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, rows):
                made = [out for row in batch.slice(k, rows).to_pylist() for out in function(row)]
                if made:
                    yield pa.RecordBatch.from_pylist(made, arrow)

    return df.mapInArrow(mapped, kind)


def map_batches(df: DataFrame, schema: str | StructType, function: Callable[[pa.RecordBatch], dict[str, list]], rows: int = 500) -> DataFrame:
    """Some rows at a time to columns of the schema, for functions that do many rows together."""
    ship(df.sparkSession)
    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(kind)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, rows):
                made = function(batch.slice(k, rows))
                if made and len(made[arrow.names[0]]):
                    yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(mapped, kind)


def keep_by_group(df: DataFrame, key: str, kept: Callable[[pa.Table], pa.Array], rows: int = 20_000) -> DataFrame:
    """The rows of df that ``kept`` says, which gets all rows of a key, and those of many keys, in one table. One shuffle; nulls are a key."""
    ship(df.sparkSession)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < rows:
                continue
            # the last key may go on in the next batch
            whole = pa.Table.from_batches(held).combine_chunks()
            keys, cut = whole.column(key), whole.num_rows - 1
            last = keys[cut].as_py()
            while cut and keys[cut - 1].as_py() == last:
                cut -= 1
            if cut:
                ready = whole.slice(0, cut)
                yield from ready.filter(kept(ready)).to_batches()
            held = whole.slice(cut).to_batches()
        if held:
            whole = pa.Table.from_batches(held)
            yield from whole.filter(kept(whole)).to_batches()

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(mapped, df.schema)

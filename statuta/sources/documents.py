"""The table of documents: batches are added beside what is there, and the newest version of a document counts.

Files of the table are never changed. A batch's files are written to a folder
of their own, and a log entry then makes the whole batch visible: a reader sees
the table as some entry left it. Compaction writes the documents as they are
into one folder and says so in an entry; batches added meanwhile stay on top.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import log

#: Ids of folded batches that a compaction remembers, the latest: a batch that runs again later than that is added again.
REMEMBERED = 10_000


def append(df: DataFrame, path: str, batch: str | None = None, order: tuple[str, ...] = ()) -> int:
    """Adds documents (uri, xml, ...) and returns the table's version with them.

    Of rows of one uri the greatest in ``order``, then in the other columns,
    counts. A batch with the id of an earlier one changes nothing. What fails
    before the entry leaves nothing that is read.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    if batch is not None and (before := _with(spark, path, batch)) is not None:
        return before
    rest = [c for c in df.columns if c != "uri"]
    one = df.groupBy("uri").agg(F.max_by(F.struct(*rest), F.struct(*order, *rest)).alias("d")).select("uri", "d.*")
    data = f"data/{uuid.uuid4().hex}"
    one.select(df.columns).write.parquet(f"{path}/{data}")
    same = (lambda e: batch in _batches(e)) if batch is not None else None
    return log.commit(spark, path, {"kind": "batch", "batch": batch, "data": data}, same)["version"]


def _batches(entry: dict) -> list[str]:
    return entry.get("seen", []) if entry["kind"] == "base" else [entry["batch"]]


def _with(spark: SparkSession, path: str, batch: str) -> int | None:
    return next((e["version"] for e in log.entries(spark, path) if batch in _batches(e)), None)


def _state(spark: SparkSession, path: str, version: int | None = None) -> tuple[dict | None, list[dict]]:
    """(the last compaction, the batches that came after what it holds) as of a version."""
    found = [e for e in log.entries(spark, path) if version is None or e["version"] <= version]
    base = next((e for e in reversed(found) if e["kind"] == "base"), None)
    return base, [e for e in found if e["kind"] == "batch" and (base is None or e["version"] > base["upto"])]


def read(spark: SparkSession, path: str, schema: str = "uri string, xml string", version: int | None = None) -> DataFrame:
    """The documents, as the newest entry or a given version has them. An empty table has no rows."""
    path = path.rstrip("/")
    return _read(spark, path, schema, *_state(spark, path, version))


def _read(spark: SparkSession, path: str, schema: str, base: dict | None, batches: list[dict]) -> DataFrame:
    whole = spark.read.schema(schema).parquet(f"{path}/{base['data']}") if base else None
    if not batches:
        return whole if whole is not None else spark.createDataFrame([], schema)
    folder = F.regexp_extract("_metadata.file_path", r"/(data/[0-9a-f]{32})/[^/]*$", 1)
    numbers = F.create_map(*[F.lit(x) for e in batches for x in (e["data"], e["version"])])
    rows = spark.read.schema(schema).parquet(*[f"{path}/{e['data']}" for e in batches])
    rest = [c for c in rows.columns if c != "uri"]
    new = rows.withColumn("_version", numbers[folder]) if len(batches) > 1 else rows
    if len(batches) > 1:
        new = new.groupBy("uri").agg(F.max_by(F.struct(*rest), "_version").alias("d")).select("uri", "d.*")
    new = new.select(rows.columns)
    if whole is None:
        return new
    return whole.join(rows.select("uri").distinct(), "uri", "left_anti").select(rows.columns).unionByName(new)


def compact(spark: SparkSession, path: str, schema: str = "uri string, xml string") -> int | None:
    """Writes the documents as they are into one folder; the version, or None where there is nothing to fold."""
    path = path.rstrip("/")
    base, batches = _state(spark, path)
    if not batches:
        return None
    data = f"data/{uuid.uuid4().hex}"
    _read(spark, path, schema, base, batches).write.parquet(f"{path}/{data}")
    seen = ((base or {}).get("seen", []) + [e["batch"] for e in batches if e["batch"] is not None])[-REMEMBERED:]
    return log.commit(spark, path, {"kind": "base", "data": data, "upto": batches[-1]["version"], "seen": seen})["version"]


def clean(spark: SparkSession, path: str, older: float = 7 * 24 * 3600) -> int:
    """Deletes folders that no reader of the newest version needs and that are older than so many seconds; how many. Readers of older versions must have ended."""
    path = path.rstrip("/")
    base, batches = _state(spark, path)
    kept = {e["data"].split("/")[1] for e in [*([base] if base else []), *batches]}
    store, folder = log.files(spark, f"{path}/data")
    gone = 0
    for status in store.listStatus(folder) if store.exists(folder) else ():
        if status.getPath().getName() not in kept and status.getModificationTime() / 1000 < time.time() - older:
            gone += store.delete(status.getPath(), True)
    return gone

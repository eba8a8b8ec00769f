"""Sinks: copies for other systems, published rules, the lookup table in a database. The table of documents is in ``documents``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rules import publishable
from . import log

def external_copy(df: DataFrame, path: str) -> None:
    """Documents as JSON lines (uri, xml) for another system, instead of the table."""
    df.select("uri", "xml").write.mode("overwrite").json(path)


def publish(df: DataFrame, path: str) -> str:
    """df as the newest version under path. Its files are written first and a log entry then names them: readers have the version before or the new one, whole."""
    path, version = path.rstrip("/"), f"version={uuid.uuid4().hex}"
    df.write.text(f"{path}/{version}")
    log.commit(df.sparkSession, path, {"data": version})
    return f"{path}/{version}"


def published(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the newest version."""
    found = log.entries(spark, path)
    if not found:
        raise FileNotFoundError(f"nothing is published under {path}")
    return spark.read.text(f"{path.rstrip('/')}/{found[-1]['data']}")


def rules(manifest: DataFrame, path: str, table: str | None = None) -> bool:
    """Publishes the patterns, one a line, if every rule is found by its own example; the manifest's table, whose files are beside them, is replaced. False where the test fails."""
    if not publishable(manifest).first()["ok"]:
        return False
    publish(manifest.select(F.col("pattern").alias("value")), path)
    if table:
        manifest.write.mode("overwrite").option("path", f"{path.rstrip('/')}/table").saveAsTable(table)
    return True


def lookup_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **options: str) -> None:
    """The lookup table in a relational database: replaced (emptied first, where the database can), or appended to."""
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, batchsize="1000", truncate="true", **options).save()

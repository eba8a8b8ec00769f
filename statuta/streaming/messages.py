"""Messages that ask for documents: decoding and routing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import document_key
from ..session import map_rows

INNER = "status string, uri_reference string"


def decoded(records: DataFrame) -> DataFrame:
    """records (body, ...) with status and uri_reference: body is JSON whose Message is JSON again."""
    message = F.from_json("body", "Message string")["Message"]
    return records.withColumn("_m", F.from_json(message, INNER)).withColumns({"status": F.col("_m.status"), "uri_reference": F.col("_m.uri_reference")}).drop("_m")


def without_tests(records: DataFrame, event: str = "Event") -> DataFrame:
    return records.where(F.coalesce(F.get_json_object("body", f"$.{event}"), F.lit("")) != "s3:TestEvent")


def subscribed(records: DataFrame, attributes: str = "attributes") -> DataFrame:
    """Only messages with the attribute trigger_enrichment."""
    return records.where(F.coalesce(F.map_contains_key(attributes, "trigger_enrichment"), F.lit(False)))


def routed(records: DataFrame, callback_bucket: str) -> DataFrame:
    """With column callback: object events of the given bucket."""
    return records.withColumn("callback", F.coalesce(F.get_json_object("body", "$.s3.bucket.name") == callback_bucket, F.lit(False)))


def last_asked(records: DataFrame) -> DataFrame:
    """(uri_reference, last_asked, messages) of records (uri_reference, ts)."""
    return records.groupBy("uri_reference").agg(F.max("ts").alias("last_asked"), F.count("*").alias("messages"))


def objects(records: DataFrame, documents: DataFrame) -> DataFrame:
    """Object events with the documents (uri, xml) they name, in canonical form: (records' columns, uri, xml); xml null where there is none."""
    key = document_key(F.get_json_object("body", "$.s3.object.key"))

    def of(row: dict) -> Iterable[dict]:
        from statuta.functions.markup import canonical

        yield {"uri": row["uri"], "xml": canonical(row["xml"])}

    wanted = documents.join(records.select(key.alias("uri")).distinct(), "uri", "left_semi")
    return records.withColumn("uri", key).join(map_rows(wanted, "uri string, xml string", of), "uri", "left")

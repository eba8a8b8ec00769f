"""Sources, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalars import document_key


def judgments(spark: SparkSession, path: str) -> DataFrame:
    """XML files, one document each: (uri, xml); the uri is the file's name as stored, decoded, without .xml."""
    d = spark.read.text(path, wholetext=True, pathGlobFilter="*.xml").select(F.col("value").alias("xml"), F.col("_metadata.file_path").alias("f"))
    # the path is encoded once more than the name is
    return d.select(document_key(F.url_decode(F.element_at(F.split("f", "/"), -1))).alias("uri"), "xml")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The rules' CSV files (others in the folder are left alone): quotes in patterns are doubled."""
    return spark.read.schema(schemas.MANIFEST).option("header", True).option("escape", '"').option("multiLine", True).option("pathGlobFilter", "*.csv").csv(path)


def patterns(spark: SparkSession, path: str) -> DataFrame:
    """One JSON rule a line."""
    return spark.read.schema(schemas.PATTERN).json(path)


def lookup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LOOKUP).parquet(path)


def lookup_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A relational lookup table; filters and columns are pushed down."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def replacements(spark: SparkSession, path: str) -> DataFrame:
    """Replacement lines (uri, value), the uri from the file name."""
    return spark.read.text(path).select(F.regexp_replace(F.col("_metadata.file_name"), r"_replacements\.txt$|\.\w+$", "").alias("uri"), "value")


def validated(docs: DataFrame, schema: str, xsd: str) -> DataFrame:
    """docs (xml, ...) with column parsed: the XML read by a schema and validated against an XSD file; its field ``invalid`` holds what fails."""
    docs.sparkSession.sparkContext.addFile(xsd)
    options = {"rowValidationXSDPath": xsd.rsplit("/", 1)[-1], "columnNameOfCorruptRecord": "invalid", "mode": "PERMISSIVE"}
    return docs.withColumn("parsed", F.from_xml("xml", f"{schema}, invalid string", options))

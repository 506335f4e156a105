"""Readers for landed files.

Schemas are declared, never inferred: inference is an extra pass over the
data and drifts between runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casestar.functions.columns import pad_code

# The mobility report's index columns.
MOBILITY_COLUMNS = (
    "retail_and_recreation_percent_change_from_baseline",
    "grocery_and_pharmacy_percent_change_from_baseline",
    "parks_percent_change_from_baseline",
    "transit_stations_percent_change_from_baseline",
    "workplaces_percent_change_from_baseline",
    "residential_percent_change_from_baseline",
)

CASE_FACTS_SCHEMA = T.StructType([
    T.StructField("IdBundesland", T.LongType()),
    T.StructField("Bundesland", T.StringType()),
    T.StructField("IdLandkreis", T.LongType()),
    T.StructField("Landkreis", T.StringType()),
    T.StructField("Meldedatum", T.StringType()),
    T.StructField("Altersgruppe", T.StringType()),
    T.StructField("Geschlecht", T.StringType()),
    T.StructField("AnzahlFall", T.LongType()),
    T.StructField("AnzahlTodesfall", T.LongType()),
    T.StructField("AnzahlGenesen", T.LongType()),
])

DISTRICTS_SCHEMA = T.StructType([
    T.StructField("rs", T.LongType()),
    T.StructField("population", T.LongType()),
])

CATEGORIES_SCHEMA = T.StructType([
    T.StructField("kreis_id", T.LongType()),
    T.StructField("krs17", T.StringType()),
])

STATE_ISO_SCHEMA = T.StructType([
    T.StructField("iso_3166_2_code", T.StringType()),
    T.StructField("IdBundesland", T.LongType()),
])


def _by_name(reader, path: str, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, found by header name and cast; others are left out."""
    df = reader.csv(path)
    named = {c.lstrip("\ufeff").removeprefix("ï»¿"): c for c in df.columns}
    missing = [f.name for f in schema.fields if f.name not in named]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}; there are {', '.join(named)}")
    return df.select(*[F.col(f"`{named[f.name]}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def read_facts(spark: SparkSession, path: str, schema: T.StructType = CASE_FACTS_SCHEMA,
               sep: str = ",", mode: str = "FAILFAST") -> DataFrame:
    """Headed delimited fact file(s) (O01), columns by name; splittable, read in
    parallel. Every file's header must agree; doubled quotes stand for one."""
    return _by_name(spark.read.option("header", True).option("sep", sep).option("mode", mode)
                    .option("escape", '"').option("enforceSchema", False), path, schema)


def read_lookup(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "ISO-8859-1",
                sep: str = "\t", mode: str = "FAILFAST") -> DataFrame:
    """Headed TSV lookup in a legacy code page, or UTF-8 with BOM (O02), columns by name.

    Every file's header must agree with the first one's. Spark drops a trailing CR at
    read time (T29).
    """
    return _by_name(spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
                    .option("escape", '"').option("mode", mode).option("enforceSchema", False), path, schema)


def read_mobility(spark: SparkSession, path: str, columns: Sequence[str] = MOBILITY_COLUMNS, **options) -> DataFrame:
    """Mobility reports: region code and name, date as text, the index columns."""
    kinds = [T.StructField(c, T.StringType()) for c in ("iso_3166_2_code", "sub_region_1", "date")]
    return read_facts(spark, path, T.StructType(kinds + [T.StructField(c, T.LongType()) for c in columns]), **options)


def read_policy(spark: SparkSession, path: str, columns: Sequence[str] = ("StringencyIndex",), **options) -> DataFrame:
    """Policy index: country, date as an integer, index columns."""
    kinds = [T.StructField("CountryName", T.StringType()), T.StructField("Date", T.IntegerType())]
    return read_facts(spark, path, T.StructType(kinds + [T.StructField(c, T.DoubleType()) for c in columns]), **options)


def read_districts(spark: SparkSession, path: str, **options) -> DataFrame:
    """District lookup: ``rs`` padded, ``population``."""
    return read_lookup(spark, path, DISTRICTS_SCHEMA, **options).withColumn("rs", pad_code("rs"))


def read_categories(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """District categories: ``kreis_id`` padded, the schema's other columns as they are."""
    return read_lookup(spark, path, schema, **options).withColumn("kreis_id", pad_code("kreis_id"))


def read_geometries(spark: SparkSession, path: str, object_name: str,
                    multi_line: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """Nested JSON documents -> one row per geometry.

    Each file holds one document (``multi_line=True``) or one per line.
    Returns the document's other top-level columns (e.g. a partition column),
    the geometry's position and its fields.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    docs = reader.json(path)
    geoms = F.col("objects").getField(object_name).getField("geometries")
    keep = [c for c in docs.columns if c not in ("objects", "type", "arcs")]
    out = docs.select(*keep, F.posexplode(geoms).alias("position", "geometry"))
    return out.select(*keep, F.col("position").cast("bigint").alias("position"), "geometry.*")

"""Geometry documents derived from the driver tables (for O03, O07, O21, O22).

One nested document per region: ``objects.<name>.geometries`` lists the
region's nations as geometries whose ``properties`` carry the district code
``rs``, a name and a number. Documents are written one per file, so a reader
can parse each file as one multi-line JSON value, like the reference's
single TopoJSON file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casestar.functions.columns import pad_code
from casestar.plans.testviews import table

OBJECT_NAME = "districts"

GEOMETRY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("properties", T.StructType([
        T.StructField("rs", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("nation", T.LongType()),
    ])),
    T.StructField("id", T.StringType()),
    T.StructField("arcs", T.ArrayType(T.ArrayType(T.LongType()))),
])
DOC_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("objects", T.StructType([
        T.StructField(OBJECT_NAME, T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("geometries", T.ArrayType(GEOMETRY)),
        ])),
    ])),
    T.StructField("arcs", T.ArrayType(T.ArrayType(T.ArrayType(T.LongType())))),
])


def geometry_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``region`` id and one nested document struct ``doc`` per region."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    g = n.select(
        F.col("n_regionkey").cast("bigint").alias("region"),
        F.col("n_nationkey").cast("bigint").alias("k"),
        F.struct(F.lit("Polygon").alias("type"),
                 F.struct(pad_code(F.col("n_regionkey").cast("bigint") * 1000
                                   + F.col("n_nationkey")).alias("rs"),
                          F.col("n_name").alias("name"),
                          F.col("n_nationkey").cast("bigint").alias("nation"))
                 .alias("properties"),
                 F.concat(F.lit("g"), F.col("n_nationkey").cast("string")).alias("id")).alias("g"))
    docs = g.groupBy("region").agg(F.sort_array(F.collect_list(F.struct("k", "g"))).alias("gs"))
    # Each geometry is bounded by the arc at its own position.
    geoms = F.transform("gs", lambda x, i: x["g"].withField("arcs", F.array(F.array(i.cast("bigint")))))
    arcs = F.transform("gs", lambda x: F.array(F.array(x["k"], F.lit(0).cast("bigint")),
                                               F.array(x["k"] + 1, F.lit(1).cast("bigint"))))
    doc = F.struct(F.lit("Topology").alias("type"),
                   F.struct(F.struct(F.lit("GeometryCollection").alias("type"),
                                     geoms.alias("geometries")).alias(OBJECT_NAME))
                   .alias("objects"), arcs.alias("arcs"))
    return docs.select("region", doc.alias("doc"))


def feature_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id`` and a feature collection per vector: consecutive components, in
    hundredths, are [lng, lat] points, four points a ring, four rings a feature."""
    e = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 100)).alias("p"))

    def point(at: Column) -> Column:
        return F.array(F.col("p")[at], F.col("p")[at + 1])

    def ring(at: Column) -> Column:
        return F.array(*[point(at + 2 * q) for q in range(4)])

    def feature(f: Column) -> Column:
        return F.struct(F.lit("Feature").alias("type"), f.cast("bigint").alias("id"), F.struct(
            F.lit("Polygon").alias("type"), F.array(*[ring(f * 32 + 8 * r) for r in range(4)]).alias("coordinates")).alias("geometry"))

    n = (F.size("p") / 32).cast("int")
    features = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), feature))
    return e.select("vec_id", F.struct(F.lit("FeatureCollection").alias("type"), features.alias("features")).alias("doc"))


def write_documents(docs: DataFrame, path: str) -> None:
    """One JSON document per file, in a ``region=<id>`` folder."""
    (docs.select("region", F.to_json("doc").alias("value"))
     .repartition("region")
     .write.mode("overwrite").partitionBy("region").text(path))


def geometries_of(doc: Column) -> Column:
    return doc["objects"][OBJECT_NAME]["geometries"]

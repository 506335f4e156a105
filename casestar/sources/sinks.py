"""Writers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casestar.operators.checks import observed_profile
from casestar.operators.cleaning import nonzero
from casestar.operators.dimensions import with_file_order_id
from casestar.session import materialize

BOM = "\ufeff"


def write_snapshot(df: DataFrame, path: str) -> None:
    """Store a table unchanged, before cleaning (O04), as Parquet. For landed files
    use ``snapshot_files``, which keeps what no reader returns."""
    df.write.mode("overwrite").parquet(path)


def snapshot_files(spark: SparkSession, landed: str, path: str) -> None:
    """Store landed text files unchanged, before any parsing.

    A row per line, as Parquet: ``file`` (its path), ``line_no`` (from 0 over all files
    in path order), ``line`` (the bytes up to the line feed, carriage returns
    included), ``file_size``. Every column, the header and the encoding stay as landed;
    files are split and read in parallel. The reader drops a byte order mark; where a
    file is larger by its three bytes than its lines, the first line gets it back.
    ``restore_files`` gives the files back.
    """
    lines = spark.read.option("lineSep", "\n").text(landed).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"))
    rows = with_file_order_id(lines, "line_no")
    packed = F.lower(F.substring_index("file", ".", -1)).isin("gz", "bz2", "zst", "lz4", "snappy", "deflate")
    sizes = materialize(rows.groupBy("file").agg(F.min("line_no").alias("__first"), (
        F.max("file_size") - F.sum(F.length("line") + 1)).alias("__more")), "file_sizes")
    marked = (F.col("line_no") == F.col("__first")) & F.col("__more").isin(2, 3) & ~packed
    rows = rows.join(sizes, "file").withColumn("line", F.when(marked, F.concat(
        F.lit(BOM).cast("binary"), F.col("line"))).otherwise(F.col("line")))
    rows.select("file", "line_no", "line", "file_size").write.mode("overwrite").parquet(path)


def restore_files(spark: SparkSession, snapshot: str, path: str) -> None:
    """Write the files of a snapshot back: one folder ``name=<file name>`` per file (names
    must differ), whose parts in order are the file. Every line ends with a line feed,
    also the last one of a file that had none there."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.read.parquet(snapshot).withColumn("name", F.element_at(F.split("file", "/"), -1))
    (rows.repartitionByRange(n, "line_no").sortWithinPartitions("name", "line_no")
     .select("name", F.col("line").cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", "\n").partitionBy("name").text(path))


def export_tsv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """TSV with header, BOM, CRLF line ends and date-only dates.

    Spark has no BOM option: prefixing the first column name with U+FEFF
    makes the header start with exactly the BOM bytes. Every part file gets
    a header; ``single_file=True`` (one writer task) is meant for the small
    dimension exports only.
    """
    first = df.columns[0]
    out = df.withColumnRenamed(first, BOM + first)
    if single_file:
        out = out.repartition(1)
    (out.write.mode("overwrite")
        .option("sep", "\t").option("header", True).option("lineSep", "\r\n")
        .option("dateFormat", "yyyy-MM-dd").option("encoding", "UTF-8")
        .option("emptyValue", "").option("escape", '"')
        .csv(path))


def export_ordered_tsv(df: DataFrame, path: str, order_cols: Sequence[str], parts: int | None = None,
                       profile_as: str | None = None) -> Callable[[], DataFrame] | None:
    """One ordered TSV written by many tasks (O05): the parts in name order, put end to
    end (``cat path/part-*``), are a single valid file with one BOM and one header.

    The rows are dealt by range of ``order_cols`` and sorted in their range; the header
    is a row of its own that sorts before all others, so it opens the first part. With
    ``profile_as`` the columns are counted in the write (O59, ``observed_profile``) and
    a function that gives the profile is returned; the counts sit above the range
    shuffle, whose sampling reads the rows below it once more.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    options = {"sep": "\t", "dateFormat": "yyyy-MM-dd", "emptyValue": "", "escape": '"'}
    title = spark.range(1).select(F.to_csv(F.struct(*[F.lit(c) for c in df.columns]), options).alias("__title"))
    title = title.select(F.concat(F.lit(BOM), "__title").alias("__title"), *[
        F.lit(None).cast(t).alias(c) for c, t in df.dtypes])
    rows = title.union(df.select(F.lit(None).cast("string").alias("__title"), "*"))
    order = [F.col("__title").isNull(), *[F.col(f"`{c}`") for c in order_cols]]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    result = None
    if profile_as:
        rows, result = observed_profile(rows, profile_as, df.schema, F.when(F.col("__title").isNull(), F.lit(1)))
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options)
    rows.select(F.coalesce("__title", line).alias("value")).write.mode("overwrite").option("lineSep", "\r\n").text(path)
    return result


def read_tsv_export(spark, path: str, schema) -> DataFrame:
    """Read an ``export_tsv`` folder back with a declared schema."""
    return (spark.read.option("sep", "\t").option("header", True).option("escape", '"')
            .option("dateFormat", "yyyy-MM-dd").schema(schema).csv(path))


def export_facts(df: DataFrame, path: str, col: str = "Anzahl") -> None:
    """Export only rows whose measure is non-zero, negatives included."""
    export_tsv(nonzero(df, col), path)


def export_json(df: DataFrame, path: str) -> None:
    """Write documents as JSON lines, UTF-8, non-ASCII kept verbatim."""
    df.write.mode("overwrite").option("encoding", "UTF-8").json(path)


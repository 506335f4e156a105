"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed by the contracts: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a whole text as an array; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for ``body``: inside a lambda a plain expression
    would be evaluated again for every array element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(values: Column, zero: Column) -> Column:
    """Sum of an array of numbers."""
    return F.aggregate(values, zero, lambda a, x: a + x)


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken, name = {c.lower() for c in df.columns}, f"__{base}"
    while name.lower() in taken:
        name += "_"
    return name


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32(doc_id as text) mod ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)

"""What several text operators share: reading, words, row identity and stored intermediates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from chronotape.sources.files import work_folder

#: A word is a run of code points that are neither space nor one of tab, newline, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a DataFrame to the shared work folder once and read it back.

    Every later use reads the files, so a lost executor costs a reread and never a recomputation, and
    values that depend on how rows were dealt (row numbers, partition ids) stay what they were.
    """
    spark = df.sparkSession
    path = work_folder(spark, purpose).root
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def present(text: Column) -> Column:
    """The text, or the empty string for null."""
    return F.coalesce(text, F.lit(""))


def crc32_of_id(column: str) -> Column:
    """CRC-32 of an identifier written in decimal digits; null counts as the empty string."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def numbered(df: DataFrame, keys: list[Column], purpose: str, partitions: int | None = None) -> tuple[DataFrame, int]:
    """Add ``row_number``: 0 to n-1 in the order of the keys, and return the number of rows.

    A range shuffle orders the rows, each partition numbers its own, and the partitions' counts (one
    row each) give the offsets. Equal rows are interchangeable, so the last range key is where a row
    was read from: a third of all rows being the same still spreads over many partitions.
    """
    read = df.withColumn("__read", F.monotonically_increasing_id())
    spread = [*keys, F.col("__read")]
    ordered = (read.repartitionByRange(partitions, *spread) if partitions else read.repartitionByRange(*spread)).sortWithinPartitions(*spread)
    at = F.monotonically_increasing_id()
    held = stored(
        ordered.withColumn("__part", F.shiftright(at, 33)).withColumn("__row", at.bitwiseAND(F.lit((1 << 33) - 1))).drop("__read"), purpose
    )
    # one row per partition passes this window
    before = F.sum("count").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    starts = held.groupBy("__part").count().select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    out = held.join(F.broadcast(starts), "__part").withColumn("row_number", F.col("__start") + F.col("__row"))
    return out.drop("__part", "__row", "__start"), held.count()

"""Contract tables on disk: staged write, audit, publish; and reads that refuse a drifted shape."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronotape.contracts import vocab
from chronotape.contracts.model import Contract, ContractError
from chronotape.operators.audits import (
    check_shape,
    contract_violations,
    file_order_violations,
    require_clean,
)
from chronotape.sources.files import Folder

# File settings of every contract table.
COMPRESSION = "zstd"
COMPRESSION_LEVEL = 3
MAX_RECORDS_PER_FILE = 20_000_000


@dataclass(frozen=True)
class Written:
    """Receipt of one table write."""

    root: str
    path: str  # relative to root
    contract: str
    contract_version: int
    knowledge_policy: str
    partition_column: str


def table_path(shape: Contract) -> str:
    return f"normalized/{shape.dataset}"


def write_contract_table(
    df: DataFrame,
    shape: Contract,
    root: str,
    *,
    knowledge_policy: str = vocab.BACKFILL,
    partition_column: str = "date",
    path: str | None = None,
    partitions: int | None = None,
) -> Written:
    """Write ``df`` (contract columns plus ``partition_column``) under ``root``; refuse any violation.

    Rows go once through the whole upstream plan into a staging folder, range-partitioned and sorted
    by (partition, ordering key). The audits then read that columnar copy, so raw input is parsed
    only once, and only a clean copy is renamed into place. A lost executor costs its own tasks.
    """
    path = path or table_path(shape)
    check_shape(df.drop(partition_column), shape)
    folder = Folder(df.sparkSession, root)
    if folder.exists(path):
        raise ContractError(f"{folder.at(path)} exists; a written table is immutable")

    staged = f"_staging/{uuid.uuid4().hex}"
    order = [partition_column, *(vocab.ORDER_KEY if shape.is_ordered else ["event_time"])]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    (
        ranged.sortWithinPartitions(*order)
        .write.option("compression", COMPRESSION)
        .option("parquet.compression.codec.zstd.level", COMPRESSION_LEVEL)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(partition_column)
        .parquet(folder.at(staged))
    )
    stored = df.sparkSession.read.schema(df.schema).parquet(folder.at(staged))
    try:
        # Keys are sorted by now, so repeats are neighbours: the order audit finds them as well.
        require_clean(contract_violations(stored, shape, knowledge_policy, unique_keys=False), shape.name)
        if shape.is_ordered and not file_order_violations(stored).isEmpty():
            raise ContractError(f"{shape.name}: ordering keys are not strictly increasing")
    except ContractError:
        folder.remove(staged)
        raise
    folder.rename(staged, path)
    return Written(root, path, shape.name, shape.version, knowledge_policy, partition_column)


def read_contract_table(
    spark: SparkSession, shape: Contract, paths: list[str], *, base_path: str | None = None
) -> DataFrame:
    """Read listed Parquet paths; a shape that differs from the contract is an error, never coerced."""
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    df = reader.parquet(*paths)
    extra = [c for c in df.columns if c not in shape.columns]
    check_shape(df.drop(*extra), shape)
    notes = {f.name: f.struct_field().metadata for f in shape.fields}
    return df.select(*[F.col(c).alias(c, metadata=notes[c]) for c in shape.columns], *extra)


def read_written(spark: SparkSession, written: Written, shape: Contract) -> DataFrame:
    base = f"{written.root.rstrip('/')}/{written.path}"
    return read_contract_table(spark, shape, [base], base_path=base)

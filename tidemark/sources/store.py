"""Plain Parquet tables under one folder, written a partition at a time.

A write replaces exactly the partitions that its rows name (dynamic partition overwrite), so writing a batch again under
its own id changes nothing. Spark moves a partition into place when the job ends; what counts as finished is told by rows
of small tables (one row per batch or page group), which are written last.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import names
from tidemark.session import scratch_folder

FILE_ROWS = 250_000  # of stored rows: small files, so that readers with much to do per row share them evenly


class Table(NamedTuple):
    """Columns and partition columns as DDL; ``options`` go to the Parquet writer."""

    columns: str
    parts: str
    options: Mapping[str, str] = {}


def one_row(spark: SparkSession, ddl: str, **values: object) -> DataFrame:
    """A table of one row in one partition."""
    types = {field.name: field.dataType for field in StructType.fromDDL(ddl)}
    cells = {name: value if isinstance(value, Column) else F.lit(value) for name, value in values.items()}
    return spark.range(0, 1, 1, 1).select(*(cells.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in types.items()))


def stored(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """Rows written once to a scratch folder and read from there: compressed, a column at a time, without their lineage."""
    folder = folder or f"{scratch_folder(rows.sparkSession)}/rows"
    rows.write.options(compression="zstd", maxRecordsPerFile=FILE_ROWS).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def forget(spark: SparkSession, folder: str) -> None:
    """Remove the files of stored rows that nobody reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Store:
    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, Table]):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = dict(tables)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def schema(self, name: str) -> str:
        return f"{self.tables[name].columns}, {self.tables[name].parts}"

    def read(self, name: str) -> DataFrame:
        """All rows, with the declared types; no row where nothing was written yet."""
        return self._found(name) or self.spark.createDataFrame([], self.schema(name))

    def exists(self, name: str) -> bool:
        return self._found(name) is not None

    def _found(self, name: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(self.schema(name)).parquet(self.path(name))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def replace(self, name: str, rows: DataFrame) -> None:
        """Write rows in place of the partitions they belong to; other partitions stay."""
        table = self.tables[name]
        columns = names(self.schema(name))
        parts = names(table.parts)
        (
            rows.select(*columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(compression="zstd", **table.options)
            .partitionBy(*parts)
            .parquet(self.path(name))
        )

    def replace_row(self, name: str, **values: object) -> None:
        self.replace(name, one_row(self.spark, self.schema(name), **values))

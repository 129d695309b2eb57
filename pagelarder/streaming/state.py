"""Tables of an incremental run, kept by URL key in the shared folder.

A table is Parquet partitioned by a hash bucket of `url_key`. Whoever looks keys up reads the
buckets of those keys only, so a batch costs what its own keys and their buckets hold and not
what all earlier batches have left. Appends add files to the buckets they touch; `compact`
writes a table anew with large files as its next generation, which counts from the moment the
`generations` table names it. One writer at a time; readers go on with the generation they began
with, which is kept until the next compaction begins.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelarder.operators.buckets import bucket_of, in_buckets
from pagelarder.session import drop_folder

BUCKETS = 32


def read_or_empty(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class State:
    """The tables below one folder; the first run fixes the number of buckets."""

    def __init__(self, spark: SparkSession, folder: str, schemas: dict[str, str], buckets: int | None = None):
        self.spark, self.folder, self.schemas = spark, folder.rstrip("/"), schemas
        rows = read_or_empty(spark, f"{self.folder}/layout", "buckets int").collect()
        if rows and buckets and rows[0].buckets != buckets:
            raise ValueError(f"{folder} has {rows[0].buckets} buckets")
        self.buckets = rows[0].buckets if rows else buckets or BUCKETS
        self._fixed = bool(rows)
        done = read_or_empty(spark, f"{self.folder}/generations", "name string, generation int, files long")
        latest = done.groupBy("name").agg(F.max(F.struct("generation", "files")).alias("g")).collect()
        self._generations = {r.name: r.g.generation for r in latest}
        self._files = {r.name: r.g.files for r in latest}

    def path(self, name: str, later: int = 0) -> str:
        return f"{self.folder}/{name}/generation-{self._generations.get(name, 0) + later}"

    def read(self, name: str, keys: DataFrame | None = None) -> DataFrame:
        """A table, or of it the buckets of `keys` (which has `url_key`), with its `bucket`."""
        table = read_or_empty(self.spark, self.path(name), f"{self.schemas[name]}, bucket int")
        return table if keys is None else in_buckets(table, keys, self.buckets)

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows. A bucket's rows are written by one task, or by several if they are many."""
        if not self._fixed:
            one = self.spark.createDataFrame([(self.buckets,)], "buckets int")
            one.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/layout")
            self._fixed = True
        self._write(rows, name, self.path(name))

    def _write(self, rows: DataFrame, name: str, path: str) -> None:
        columns = [f.name for f in self.spark.createDataFrame([], self.schemas[name]).schema]
        rows = rows.select(*columns, bucket_of(F.col("url_key"), self.buckets).alias("bucket"))
        writer = rows.hint("rebalance", "bucket").write.mode("append").option("compression", "zstd")
        writer.partitionBy("bucket").parquet(path)

    def unchanged(self, name: str) -> bool:
        """Has nothing been added to a table since it was last written anew?"""
        return self._files.get(name) is not None and self._files[name] == self._count(self.path(name))

    def _count(self, path: str) -> int:
        return len(read_or_empty(self.spark, path, "bucket int").inputFiles())

    def drop_earlier(self, name: str) -> None:
        """Drop the generation before the current one, and what a compaction that failed has left."""
        for later in (-1, 1):
            if self._generations.get(name, 0) + later >= 0:
                drop_folder(self.spark, self.path(name, later))

    def replace(self, tables: dict[str, DataFrame]) -> None:
        """Make these rows the next generation of their tables; only the one before it is kept."""
        for name, rows in tables.items():
            self.drop_earlier(name)
            self._write(rows, name, self.path(name, 1))
        named = [(n, self._generations.get(n, 0) + 1, self._count(self.path(n, 1))) for n in tables]
        rows = self.spark.createDataFrame(named, "name string, generation int, files long").coalesce(1)
        rows.write.mode("append").parquet(f"{self.folder}/generations")
        for name, generation, files in named:
            self._generations[name], self._files[name] = generation, files

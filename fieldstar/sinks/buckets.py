"""Events and counts in buckets by event, so that the star's largest join moves no count.

Both tables are written into the same number of buckets by `event_id`, one
sorted file per bucket and dataset. A join on the event then reads bucket by
bucket: the counts are neither shuffled nor sorted, and what is left of the
events after their filters is all that moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstar.schema import SCHEMAS, SPLIT_TABLES, TABLES, conform
from fieldstar.session import path_exists, read_note, write_note

BUCKETED = ("events", "counts")
KEY, PARTITION = "event_id", "dataset_id"


class BucketedStar:
    """A copy of the star below a root folder, its events and counts bucketed alike.

    Bucketing is known to the session's catalog only, so a session that opens
    the folder declares its tables there, under names that follow from the
    folder; the number of buckets is noted beside them.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._name = "fieldstar_" + hashlib.sha256(self.root.encode()).hexdigest()[:16]

    def _table(self, table: str) -> str:
        return f"{self._name}_{table}"

    def write(self, tables: Mapping[str, DataFrame], buckets: int) -> None:
        """Write the star anew.

        A task writes the files of one bucket: `buckets` should be the size of
        the counts over that of a file, and a multiple of the executors' cores.
        """
        for table in TABLES:
            if table not in tables:
                continue
            df, path = conform(tables[table], table), f"{self.root}/{table}"
            if table not in BUCKETED:
                df.write.mode("overwrite").parquet(path)
                continue
            self.spark.sql(f"drop table if exists {self._table(table)}")
            dealt = df.repartition(buckets, KEY).sortWithinPartitions(PARTITION, KEY)
            writer = dealt.write.mode("overwrite").option("path", path).partitionBy(PARTITION)
            writer.bucketBy(buckets, KEY).sortBy(KEY).saveAsTable(self._table(table))
        write_note(self.spark, f"{self.root}/_buckets", str(buckets))

    def _declare(self, table: str) -> None:
        name = self._table(table)
        if self.spark.catalog.tableExists(name):
            return
        buckets = int(read_note(self.spark, f"{self.root}/_buckets"))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SCHEMAS[table].fields)
        self.spark.sql(
            f"create table {name} ({columns}) using parquet partitioned by ({PARTITION}) "
            f"clustered by ({KEY}) sorted by ({KEY}) into {buckets} buckets location '{self.root}/{table}'"
        )
        self.spark.catalog.recoverPartitions(name)

    def load(self, table: str) -> DataFrame:
        """The table as a frame, with its buckets where it has some."""
        path = f"{self.root}/{table}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], SCHEMAS[table])
        if table in BUCKETED:
            self._declare(table)
            return conform(self.spark.table(self._table(table)), table)
        return conform(self.spark.read.schema(SCHEMAS[table]).parquet(path), table)

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.load(t) for t in TABLES}

    def volumes(self) -> DataFrame:
        """Rows per table: what a copy is checked by."""
        sizes = [self.load(t).agg(F.lit(t).alias("table"), F.count("*").alias("n")) for t in SPLIT_TABLES]
        return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])

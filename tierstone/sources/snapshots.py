"""Full-refresh tables on plain Parquet: one immutable folder per run, visible once published."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.sources.commits import CommitLog, VersionTaken
from tierstone.sources.csv_drops import plain_path
from tierstone.sources.layout import clustered

MANIFEST_SCHEMA = "run_id string, version long"
#: Buckets of a key hash by which the files of an indexed run are told apart.
BUCKETS = 4096


def key_bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class SnapshotTable:
    """A run is written under ``data/run_id=...`` and then named by one appended manifest row.

    A reader resolves the manifest, so it never sees a half-written run, and a writer never
    overwrites what is being read.  Publishing a run again changes nothing.  A version number is claimed
    before it is used, so two writers of different runs never share one.

    A run published with ``index_by`` is dealt by a hash of these columns, and ``index/run_id=...`` tells
    which buckets of it each file holds; :meth:`read_keys` then opens only the files that its keys can be in.
    """

    root: str

    @property
    def manifest_path(self) -> str:
        return f"{self.root}/manifest"

    def run_path(self, run_id: str) -> str:
        return f"{self.root}/data/run_id={run_id}"

    def runs(self, spark: SparkSession) -> list[str]:
        """Published runs, oldest first."""
        try:
            manifest = spark.read.schema(MANIFEST_SCHEMA).parquet(self.manifest_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return [r.run_id for r in manifest.groupBy("run_id").agg(F.min("version").alias("v")).orderBy("v").collect()]

    def publish(
        self, df: DataFrame, run_id: str, cluster_by: Sequence[str] = (), partition_by: Sequence[str] = (),
        index_by: Sequence[str] = (), finish: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Write the rows and name the run; a run that is published already is left alone."""
        spark = df.sparkSession
        if run_id not in self.runs(spark):
            self.write(df, run_id, cluster_by, partition_by, index_by, finish)
            self.name(spark, run_id)

    def write(
        self, df: DataFrame, run_id: str, cluster_by: Sequence[str] = (), partition_by: Sequence[str] = (),
        index_by: Sequence[str] = (), finish: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Write the rows of a run that no reader sees before :meth:`name`; what an attempt left is written over.

        ``finish`` is applied behind the shuffle that deals them, in the stage that writes: what it observes is
        counted once, also if lost executors make earlier stages run again.
        """
        finish = finish or (lambda rows: rows)
        if index_by:
            # no range partitioning: it would compute the rows twice, once for its sample
            dealt = finish(df.withColumn("_b", key_bucket(index_by)).hint("rebalance", "_b"))
            rows = dealt.sortWithinPartitions("_b", *index_by).drop("_b")
        else:
            rows = finish(clustered(df, cluster_by) if cluster_by else df)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(self.run_path(run_id))
        if index_by:
            self._write_index(df.sparkSession, run_id, index_by)

    def name(self, spark: SparkSession, run_id: str) -> None:
        """Make a written run visible, once."""
        done = self.runs(spark)
        if run_id in done:
            return
        entry = spark.createDataFrame([(run_id, self._claim(spark, run_id, len(done)))], MANIFEST_SCHEMA)
        entry.coalesce(1).write.mode("append").parquet(self.manifest_path)

    def _claim(self, spark: SparkSession, run_id: str, number: int) -> int:
        """A version number that no other writer has, ``number`` or a later one."""
        claims = CommitLog(f"{self.root}/claims")
        number = max([number, *[v + 1 for v in claims.versions(spark)]])
        while True:
            try:
                claims.commit(spark, number, [{"run_id": run_id}])
                return number
            except VersionTaken:
                number += 1

    def _write_index(self, spark: SparkSession, run_id: str, keys: Sequence[str]) -> None:
        """One row per file: its name below the run's folder and the buckets it holds. Reads the key columns only."""
        written = spark.read.parquet(self.run_path(run_id))
        # distinct buckets before any set is collected, and the name cut out of the path once per file
        held = written.select(F.col("_metadata.file_path").alias("_path"), key_bucket(keys).alias("b")).distinct()
        held = held.groupBy("_path").agg(F.collect_set("b").alias("buckets"))
        name = F.regexp_extract(plain_path(F.col("_path")), r"/data/run_id=[^/]*/(.*)$", 1)
        held.select(name.alias("file"), "buckets").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/index/run_id={run_id}")

    def read(self, spark: SparkSession, run_id: str | None = None) -> DataFrame:
        """One run, the newest by default."""
        published = self.runs(spark)
        if run_id is None and published:
            run_id = published[-1]
        if run_id not in published:
            raise ValueError(f"no published run {run_id!r} in {self.root}")
        return spark.read.parquet(self.run_path(run_id))

    def read_all(self, spark: SparkSession) -> DataFrame:
        """The retained rows of every published run; columns a run lacks are NULL."""
        paths = [self.run_path(r) for r in self.runs(spark)]
        return spark.read.options(mergeSchema=True, basePath=f"{self.root}/data").parquet(*paths).drop("run_id")

    def files_of_keys(self, spark: SparkSession, rows: DataFrame, keys: Sequence[str]) -> list[str]:
        """The files of all runs that rows with the keys of ``rows`` can be in; a run without an index counts whole."""
        published = self.runs(spark)
        buckets = [r[0] for r in rows.select(key_bucket(keys)).distinct().collect()]
        try:
            index = spark.read.schema("file string, buckets array<int>, run_id string").parquet(f"{self.root}/index")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return [self.run_path(r) for r in published]
        hit = F.arrays_overlap("buckets", F.lit(sorted(buckets))) if buckets else F.lit(False)
        indexed = {r.run_id for r in index.select("run_id").distinct().collect()}
        found = index.filter(F.col("run_id").isin(published)).filter(hit).orderBy("run_id", "file").collect()
        return [f"{self.run_path(r.run_id)}/{r.file}" for r in found] + [self.run_path(r) for r in published if r not in indexed]

    def read_keys(self, spark: SparkSession, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows of all runs whose keys are among those of ``rows``; only files that can hold them are opened."""
        files = self.files_of_keys(spark, rows, keys)
        if not files:
            return self.read_all(spark).limit(0)
        held = spark.read.options(mergeSchema=True, basePath=f"{self.root}/data").parquet(*files).drop("run_id")
        return held.join(rows.select(*keys).distinct(), list(keys), "left_semi")

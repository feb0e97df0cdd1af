"""A type-2 history that is written in proportion to what changes.

Closed versions never change, so they are only ever added. Open versions lie in a part of their own, as one small file
set per run with the keys that it touched; the latest row of a key counts. A key that was rebuilt after a late row
leaves a *reset*: its closed versions of earlier runs are void. What each run did to the open versions is logged, too.

::

    data/open/v7-<id>/      keys, values, __START_AT, _live (false: the key has no open version any more)
    data/closed/v7-<id>/    keys, values, __START_AT, __END_AT
    data/resets/v7-<id>/    keys
    data/changes/v7-<id>/   keys, _before, _after (open versions; null: there was none, or is none)
    data/scopes/v7-<id>/    scope, last snapshot of it (only if missing keys are closed)
    log/00000007.json       the files of run 7, each with the key buckets it spans

A reader takes its files from the log, so it lists no folder and never sees half a run, and a lookup of some keys opens
the files that span their buckets. Every run is one numbered commit; two writers cannot both take a number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierstone.sources.commits import CommitLog
from tierstone.sources.shared import drop_folder
from tierstone.vocab import END_AT, START_AT

BUCKET, LIVE, VERSION = "_bucket", "_live", "_version"
OPEN, CLOSED, RESETS, CHANGES, SCOPES = "open", "closed", "resets", "changes", "scopes"


@dataclass(frozen=True)
class Commit:
    """One published run: its number, its id, whether it stands alone, and its files by kind."""

    version: int
    run_id: str
    base: bool
    files: Mapping[str, list[dict]]
    schemas: Mapping[str, str]


@dataclass(frozen=True)
class VersionTable:
    """The history under ``root`` of rows with ``keys``, last observed at ``sequence``.

    ``scope`` names the columns of a snapshot whose missing keys are closed. An open version of such a table was in the
    last snapshot of its scope, so ``sequence`` is read from the scope and a key that just goes on is not written again.
    """

    root: str
    keys: Sequence[str]
    sequence: str
    scope: Sequence[str] | None = None
    buckets: int = 4096

    @property
    def log(self) -> CommitLog:
        return CommitLog(f"{self.root}/log")

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> set[int]:
        """Numbers of the buckets that hold a key of ``rows``; at most ``buckets`` of them."""
        return {r[0] for r in rows.select(self.bucket()).distinct().collect()}

    # what is committed

    def commits(self, spark: SparkSession, upto: int | None = None) -> list[Commit]:
        """Commits up to a version, oldest first."""
        numbers = [v for v in self.log.versions(spark) if upto is None or v <= upto]
        found = []
        for version, lines in sorted(self.log.read(spark, numbers).items()):
            files: dict[str, list[dict]] = {}
            for line in lines[1:]:
                files.setdefault(line["kind"], []).append(line)
            found.append(Commit(version, lines[0]["run_id"], lines[0]["base"], files, lines[0]["schemas"]))
        return found

    def runs(self, spark: SparkSession) -> list[str]:
        """Published runs, oldest first; compaction is none."""
        return list(dict.fromkeys(c.run_id for c in self.commits(spark) if c.run_id))

    def version_of(self, spark: SparkSession, run_id: str) -> int:
        """The number of a published run."""
        found = [c.version for c in self.commits(spark) if c.run_id == run_id]
        if not found:
            raise ValueError(f"no published run {run_id!r} in {self.root}")
        return found[-1]

    def _reach(self, spark: SparkSession, upto: int | None) -> list[Commit]:
        """The commits that a state is made of: from the last one that stands alone on."""
        commits = self.commits(spark, upto)
        first = max((i for i, c in enumerate(commits) if c.base), default=0)
        return commits[first:]

    def _rows(self, spark: SparkSession, commits: list[Commit], kind: str, only: Iterable[int] | None = None) -> DataFrame | None:
        """All rows of a kind with their version; of the files alone that span one of some buckets.

        Commits whose files have the same columns are one scan; a column that files lack is NULL there.
        """
        wanted = None if only is None else sorted(only)
        parts: dict[str, list[tuple[str, int]]] = {}
        for c in commits:
            for f in c.files.get(kind, []):
                if wanted is None or any(f["low"] <= b <= f["high"] for b in wanted):
                    parts.setdefault(c.schemas[kind], []).append((f["path"], c.version))
            if kind in c.schemas:
                parts.setdefault(c.schemas[kind], [])
        frames = []
        for schema, files in parts.items():
            shape = T.StructType.fromJson(json.loads(schema))
            if not files:
                frames.append(spark.createDataFrame([], shape).withColumn(VERSION, F.lit(0).cast("long")))
                continue
            # the version is part of the folder's name
            rows = spark.read.schema(shape).parquet(*[f"{self.root}/{p}" for p, _ in files])
            folder = F.split_part(F.col("_metadata.file_path"), F.lit("/"), F.lit(-2))
            number = F.substring_index(folder, "-", 1).substr(F.lit(2), F.lit(20)).cast("long")
            rows = rows.withColumn(VERSION, number)
            frames.append(rows if wanted is None else rows.filter(F.col(BUCKET).isin(wanted)))
        if not frames:
            return None
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

    # reading

    def _last_snapshots(self, spark: SparkSession, commits: list[Commit]) -> DataFrame | None:
        """(scope..., _last): the last snapshot of each scope."""
        rows = None if self.scope is None else self._rows(spark, commits, SCOPES)
        return None if rows is None else rows.groupBy(*self.scope).agg(F.max("_last").alias("_last"))

    def scopes(self, spark: SparkSession) -> DataFrame | None:
        return self._last_snapshots(spark, self._reach(spark, None))

    def _latest(self, spark: SparkSession, commits: list[Commit], only: Iterable[int] | None) -> DataFrame:
        rows = self._rows(spark, commits, OPEN, only)
        if rows is None:
            raise ValueError(f"no published run in {self.root}")
        if sum(bool(c.files.get(OPEN)) for c in commits) > 1:
            rest = [c for c in rows.columns if c not in [*self.keys, VERSION]]
            latest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), VERSION).alias("_row"))
            rows = latest.select(*self.keys, "_row.*")
        rows = rows.filter(LIVE).drop(LIVE, BUCKET, VERSION)
        last = self._last_snapshots(spark, commits)
        if last is not None:
            order = rows.columns
            rows = rows.drop(self.sequence).join(last.withColumnRenamed("_last", self.sequence), list(self.scope)).select(*order)
        return rows

    def open_rows(self, spark: SparkSession, only: Iterable[int] | None = None, upto: int | None = None) -> DataFrame:
        """Open versions, of all keys or of those in some buckets, now or after an earlier version."""
        commits = self._reach(spark, upto)
        rows = self._latest(spark, commits, only)
        return rows.withColumn(END_AT, F.lit(None).cast(rows.schema[START_AT].dataType))

    def closed_rows(self, spark: SparkSession, only: Iterable[int] | None = None, upto: int | None = None) -> DataFrame | None:
        """Closed versions; those from before a reset of their key are void. None if there are none yet."""
        commits = self._reach(spark, upto)
        rows = self._rows(spark, commits, CLOSED, only)
        if rows is None:
            return None
        resets = self._rows(spark, commits, RESETS, only) if any(c.files.get(RESETS) for c in commits) else None
        if resets is not None:
            since = resets.groupBy(*self.keys).agg(F.max(VERSION).alias("_since"))
            rows = rows.join(since, list(self.keys), "left").filter(F.col("_since").isNull() | (F.col(VERSION) >= F.col("_since")))
            rows = rows.drop("_since")
        return rows.drop(BUCKET, VERSION)

    def read(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """All versions of all keys, now or after an earlier version."""
        own = self.open_rows(spark, upto=upto)
        closed = self.closed_rows(spark, upto=upto)
        return own if closed is None else closed.unionByName(own, allowMissingColumns=True).select(*own.columns)

    def changes(self, spark: SparkSession, after: int, upto: int) -> DataFrame:
        """(keys, _before, _after, _version) of the open versions that the runs behind ``after`` up to ``upto`` changed."""
        commits = [c for c in self.commits(spark, upto) if c.version > after]
        rows = self._rows(spark, commits, CHANGES)
        if rows is None:
            raise ValueError(f"no changes between versions {after} and {upto} in {self.root}")
        return rows.drop(BUCKET)

    def net_changes(self, spark: SparkSession, after: int, upto: int, columns: Sequence[str]) -> DataFrame:
        """What :func:`snapshot_diff` finds between the open versions after two runs, out of the log alone.

        The first image of a key and its last one tell all, so a key that changed often costs one row.
        """
        rows = self.changes(spark, after, upto)
        at = rows.schema["_after"].dataType.fieldNames()
        shown = {side: F.when(F.col(side).isNotNull(), F.struct(*[
            (F.col(f"{side}.{c}") if c in at else F.lit(None)).alias(c) for c in columns
        ])) for side in ("_before", "_after")}
        net = rows.groupBy(*self.keys).agg(
            F.min_by(F.struct(shown["_before"].alias("v")), VERSION).alias("_b"), F.max_by(F.struct(shown["_after"].alias("v")), VERSION).alias("_a"),
        ).select(*self.keys, F.col("_b.v").alias("_b"), F.col("_a.v").alias("_a")).filter(~F.col("_b").eqNullSafe(F.col("_a")))

        def image(kind: str, side: str) -> Column:
            return F.struct(F.lit(kind).alias("_change_type"), F.col(side).alias("_values"))

        images = F.when(F.col("_b").isNull(), F.array(image("insert", "_a"))).when(
            F.col("_a").isNull(), F.array(image("delete", "_b"))
        ).otherwise(F.array(image("update_pre", "_b"), image("update_post", "_a")))
        return net.select(*self.keys, F.explode(images).alias("_c")).select(*self.keys, "_c._values.*", "_c._change_type")

    # writing

    def _write(self, spark: SparkSession, df: DataFrame, kind: str, version: int) -> tuple[list[dict], str]:
        """Files of a kind, each with the buckets it spans; rows lie in the order of buckets, so spans do not overlap."""
        rows = df if kind == SCOPES else df.withColumn(BUCKET, self.bucket())
        if rows.isEmpty():
            return [], rows.schema.json()
        folder = f"data/{kind}/v{version}-{uuid.uuid4().hex}"
        if kind != SCOPES:
            spread = F.xxhash64(*self.keys)
            rows = rows.repartitionByRange(BUCKET, spread).sortWithinPartitions(BUCKET, *self.keys)
        rows.write.parquet(f"{self.root}/{folder}")
        written = spark.read.schema(rows.schema).parquet(f"{self.root}/{folder}")
        span = (F.lit(0), F.lit(self.buckets)) if kind == SCOPES else (F.min(BUCKET), F.max(BUCKET))
        found = written.groupBy(F.col("_metadata.file_name").alias("name")).agg(span[0].alias("low"), span[1].alias("high"), F.count("*").alias("n"))
        return [
            {"kind": kind, "path": f"{folder}/{r.name}", "low": r.low, "high": r.high, "rows": r.n} for r in found.orderBy("name").collect()
        ], rows.schema.json()

    def publish(self, spark: SparkSession, run_id: str, parts: Mapping[str, DataFrame | None], base: bool = False, version: int | None = None) -> int:
        """Commit the parts (by kind) of a run; again, it changes nothing. The number of the commit.

        ``version`` is the number to take: of a run that was worked out from the state before it, the next one then.
        If another writer has it, VersionTaken is raised and no reader ever sees this run's files.
        """
        commits = self.commits(spark)
        for c in commits:
            if run_id and c.run_id == run_id:
                return c.version
        number = version if version is not None else (commits[-1].version + 1 if commits else 0)
        lines, schemas = [], {}
        for kind, df in parts.items():
            if df is not None:
                files, schemas[kind] = self._write(spark, df, kind, number)
                lines += files
        self.log.commit(spark, number, [{"run_id": run_id, "base": base, "schemas": schemas}, *lines])
        return number

    def next_version(self, spark: SparkSession) -> int:
        return max(self.log.versions(spark), default=-1) + 1

    def compact(self, spark: SparkSession) -> int:
        """Fold all runs into a commit that stands alone: each key once among the open rows, no void closed ones.

        Earlier states and the change log stay readable until :meth:`vacuum`.
        """
        commits = self._reach(spark, None)
        number = commits[-1].version + 1
        own = self._latest(spark, commits, None).withColumn(LIVE, F.lit(True))
        parts = {OPEN: own, CLOSED: self.closed_rows(spark, upto=commits[-1].version), SCOPES: self._last_snapshots(spark, commits)}
        return self.publish(spark, "", parts, base=True, version=number)

    def vacuum(self, spark: SparkSession, keep_from: int) -> list[str]:
        """Delete the files of states before version ``keep_from``; what that state and later ones are made of stays.

        The names of the runs stay in the log, so none is taken twice; their changes before ``keep_from`` go. Files that
        no commit names, of writers that failed, are not touched: a writer at work has such files, too.
        """
        commits = self.commits(spark)
        needed = {c.version for c in self._reach(spark, keep_from)} | {c.version for c in commits if c.version >= keep_from}
        gone = [c for c in commits if c.version not in needed and c.files]
        folders = sorted({f["path"].rsplit("/", 1)[0] for c in gone for files in c.files.values() for f in files})
        for folder in folders:
            drop_folder(spark, f"{self.root}/{folder}")
        return folders

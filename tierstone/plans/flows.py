"""How each standardised table becomes history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.operators.history import (
    Lookup, VersionDelta, delta_of_build, merge_delta, merge_unseen, scd2_build, scd2_merge, snapshot_delta, unseen_events,
)
from tierstone.sources.versions import VersionTable


@dataclass(frozen=True)
class HistoryFlow:
    keys: Sequence[str]
    sequence: str
    tracked: Sequence[str]
    drop: Sequence[str]
    cluster_by: Sequence[str] = ("utility_id", "feeder_id")
    tiebreak: Sequence[str] = ("ingestion_timestamp",)
    close_missing: Sequence[str] | None = None

    def build(self, events: DataFrame) -> DataFrame:
        return scd2_build(
            events, self.keys, self.sequence, self.tracked, self.drop, self.tiebreak, close_missing=self.close_missing
        )

    def merge(self, target: DataFrame, new_events: DataFrame, history: DataFrame) -> DataFrame:
        return scd2_merge(
            target, new_events, self.keys, self.sequence, history, self.tracked, self.drop, self.tiebreak,
            close_missing=self.close_missing,
        )

    def unseen(self, target: DataFrame, new_events: DataFrame) -> DataFrame:
        return unseen_events(target, new_events, self.keys, self.sequence, self.tracked, self.drop)

    def merge_unseen(self, target: DataFrame, news: DataFrame, history: DataFrame) -> DataFrame:
        return merge_unseen(
            target, news, self.keys, self.sequence, history, self.tracked, self.drop, self.tiebreak,
            close_missing=self.close_missing,
        )

    def stored_in(self, root: str) -> VersionTable:
        return VersionTable(root, self.keys, self.sequence, self.close_missing)

    def delta(self, spark: SparkSession, table: VersionTable, new_events: DataFrame, history_of: Lookup) -> VersionDelta:
        """What ``new_events`` change in a stored history; the first ones make it.

        ``history_of`` gives the observations of some keys (with ``close_missing`` of some scopes), new ones included.
        """
        if not table.log.versions(spark):
            scopes = None
            if self.close_missing is not None:
                scopes = new_events.groupBy(*self.close_missing).agg(F.max(self.sequence).alias("_last"))
            return delta_of_build(self.build(new_events), self.keys, scopes)
        rules = dict(tracked=self.tracked, drop=self.drop, tiebreak=self.tiebreak)
        if self.close_missing is not None:
            return snapshot_delta(
                table.open_rows(spark), table.scopes(spark), new_events, self.keys, self.sequence, self.close_missing, history_of, **rules
            )

        def closed_of(keys: DataFrame) -> DataFrame | None:
            rows = table.closed_rows(spark, table.touched(keys))
            return None if rows is None else rows.join(keys, list(self.keys), "left_semi")

        own = table.open_rows(spark, table.touched(new_events))
        return merge_delta(own, new_events, self.keys, self.sequence, closed_of, history_of, **rules)

    def take(self, spark: SparkSession, table: VersionTable, run_id: str, new_events: DataFrame, history_of: Lookup) -> int:
        """Merge a run's events into a stored history, once; its version.

        The delta is worked out from one state and committed as the version behind it. If another writer was faster,
        VersionTaken is raised and the same call can be made again.
        """
        done = table.runs(spark)
        if run_id in done:
            return table.version_of(spark, run_id)
        version = table.next_version(spark)
        return table.publish(spark, run_id, self.delta(spark, table, new_events, history_of).parts(), base=not version, version=version)


# Keys, sequence, tracked and excluded columns of the three histories.
CIRCUITS = HistoryFlow(
    keys=("utility_id", "feeder_id"),
    sequence="hca_refresh_date",
    tracked=(
        "native_feeder_id", "voltage_kv", "max_hosting_capacity_mw", "min_hosting_capacity_mw",
        "color_code", "color_hex", "color_name", "shape_length",
    ),
    drop=("ingestion_timestamp", "ingestion_date", "pipeline_update_id"),
)
DER_INSTALLED = HistoryFlow(
    keys=("utility_id", "der_id", "der_type"),
    sequence="ingestion_date",
    tracked=("feeder_id", "native_feeder_id_raw", "nameplate_rating_kw"),
    drop=("ingestion_timestamp", "pipeline_update_id"),
)
DER_PLANNED = HistoryFlow(
    keys=("utility_id", "der_id", "der_type"),
    sequence="ingestion_date",
    tracked=(
        "feeder_id", "native_feeder_id_raw", "nameplate_rating_kw",
        "planned_installation_date", "interconnection_queue_id",
    ),
    drop=("ingestion_timestamp", "pipeline_update_id"),
)
FLOWS = {"circuits": CIRCUITS, "der_installed": DER_INSTALLED, "der_planned": DER_PLANNED}

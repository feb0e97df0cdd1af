"""One refresh run from landed files to serving tables, as plain functions over one root folder."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstone.context import RunContext
from tierstone.operators import quality, serving
from tierstone.plans.canonical import PARSED, UNPARSED
from tierstone.plans.flows import FLOWS, HistoryFlow
from tierstone.plans.registry import DATASETS, TenantRegistry
from tierstone.sources.shared import steps_dropped
from tierstone.sources.snapshots import SnapshotTable
from tierstone.sources.versions import VersionTable
from tierstone.streaming.ingest import RawTable, ingest_new_files
from tierstone.vocab import TECHNOLOGIES

# Rules of the standardised tables and of the raw layer.
CIRCUIT_RULES = {
    "valid_feeder_id": "feeder_id IS NOT NULL",
    "valid_utility_id": "utility_id IS NOT NULL",
    "valid_hca_refresh_date": "hca_refresh_date IS NOT NULL",
}
DER_RULES = {"valid_utility_id": "utility_id IS NOT NULL", "valid_der_type": "der_type IS NOT NULL"}
DER_QUARANTINE = {
    "canonical_der_type_only": "der_type IN (" + ", ".join(f"'{t}'" for t in TECHNOLOGIES) + ")"
}
#: Rows without these never enter a history.
HISTORY_RULES = {
    dataset: {"history_key": " AND ".join(f"{c} IS NOT NULL" for c in [*flow.keys, flow.sequence])}
    for dataset, flow in FLOWS.items()
}
RAW_RULES = {"schema_drift_detected": "_rescued_data IS NULL OR _rescued_data = ''"}


@dataclass
class Warehouse:
    """Tables of one installation under ``root``; ``raw_columns`` names the known raw columns."""

    spark: SparkSession
    root: str
    registry: TenantRegistry
    raw_columns: dict[str, list[str]] = field(default_factory=dict)

    def raw(self, dataset: str) -> RawTable:
        return RawTable(f"{self.root}/raw/{dataset}", dataset, self.raw_columns[dataset])

    def snapshots(self, dataset: str) -> SnapshotTable:
        """Standardised runs; project rows are tagged and split by quarantine inside each run."""
        return SnapshotTable(f"{self.root}/standardized/{dataset}")

    def standardized(self, dataset: str, run_id: str | None = None) -> DataFrame:
        """The valid rows of a run, the newest by default."""
        return self._valid(dataset, self.snapshots(dataset).read(self.spark, run_id))

    def retained(self, dataset: str) -> DataFrame:
        """The valid rows of all runs."""
        return self._valid(dataset, self.snapshots(dataset).read_all(self.spark))

    def quarantine(self, dataset: str, run_id: str | None = None) -> DataFrame:
        return quality.read_quarantined(self.snapshots(dataset).read(self.spark, run_id))

    @staticmethod
    def _valid(dataset: str, rows: DataFrame) -> DataFrame:
        return rows if dataset == "circuits" else quality.read_passed(rows)

    def history(self, dataset: str) -> VersionTable:
        return FLOWS[dataset].stored_in(f"{self.root}/history/{dataset}")

    def served(self, view: str) -> SnapshotTable:
        return SnapshotTable(f"{self.root}/serving/{view}")

    def metrics(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/metrics/quality").drop("run_id", "of_table")

    def unmapped(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/metrics/unmapped").drop("run_id", "of_table")

    def ingest(self, landing: str, run: RunContext) -> None:
        for dataset in DATASETS:
            table = self.raw(dataset)
            ingest_new_files(self.spark, landing, table, f"{self.root}/checkpoints/{dataset}", run)

    def drift_report(self, dataset: str) -> DataFrame:
        """Raw rows checked and rows with drift, per tenant."""
        return quality.violations(self.raw(dataset).read(self.spark), RAW_RULES, by=["utility_id"])

    def standardize(self, run: RunContext) -> None:
        """Publish the canonical tables of each delivery not yet published, with quarantine and metrics.

        A delivery is what one ingestion brought; it is standardised, measured and published by itself
        under its own run id, so a run costs what is new and no row is measured twice.  Project rows are
        computed and written once, tagged; the standardised view, the quarantine and the unmapped-type
        report all read that run.
        """
        for dataset in DATASETS:
            for delivery, delivered in self._pending(dataset).items():
                self._publish(dataset, delivery, delivered)
                self._store_metrics(dataset, delivery, run)
                if dataset != "circuits":
                    self._store_unmapped(dataset, delivery)

    def _publish(self, dataset: str, delivery: str, delivered: DataFrame) -> None:
        """Standardise and write a delivery in one read; what is lost is counted by the write itself."""
        run_id, _, only = delivery.partition("~")
        known = self.registry.get_registered_utilities()
        tenants = [only] if only else [t for t in self.raw(dataset).tenants_of(self.spark, run_id) if t in known]
        drops = CIRCUIT_RULES if dataset == "circuits" else DER_RULES
        rules = (drops if dataset == "circuits" else drops | DER_QUARANTINE) | HISTORY_RULES[dataset]
        failed = {name: ~quality.passes(sql) for name, sql in rules.items()}
        failed |= {f"parsed_{c}": F.array_contains(UNPARSED, c) for c in PARSED[dataset]}
        counts: list = []

        def finish(rows: DataFrame) -> DataFrame:
            rows, found = quality.counted(rows, failed, "utility_id", tenants)
            counts.append(found)
            valid = quality.expect_or_drop(rows.drop(UNPARSED), drops)
            return valid if dataset == "circuits" else quality.tag_for_quarantine(valid, DER_QUARANTINE)

        table = self.snapshots(dataset)
        folder = [] if dataset == "circuits" else [quality.QUARANTINED]
        rows = self.registry.standardize(delivered, dataset, unparsed=True)
        table.write(rows, delivery, partition_by=folder, index_by=FLOWS[dataset].keys, finish=finish)
        # the losses are there before the run is, so that a run never lacks them
        self._store_losses(dataset, delivery, delivered, counts[0]())
        table.name(self.spark, delivery)

    def _pending(self, dataset: str) -> dict[str, DataFrame]:
        """Raw rows to standardise by the run id to publish them under: what a tenant had delivered before it was
        registered, then the new deliveries."""
        raw, done = self.raw(dataset), self.snapshots(dataset).runs(self.spark)
        deliveries = raw.deliveries(self.spark)
        pending: dict[str, DataFrame] = {}
        if any(d in done for d in deliveries):
            known = F.col("utility_id").isin(*self.registry.get_registered_utilities())
            left = self.losses().filter((F.col("of_table") == dataset) & (F.col("rule_name") == "registered_utility") & known)
            for row in left.select("run_id", "utility_id").distinct().orderBy("run_id", "utility_id").collect():
                name = f"{row.run_id}~{row.utility_id}"
                if row.run_id in done and name not in done:
                    pending[name] = raw.read_delivery(self.spark, row.run_id).filter(F.col("utility_id") == row.utility_id)
        return pending | {d: raw.read_delivery(self.spark, d) for d in deliveries if d not in done}

    def _store_metrics(self, dataset: str, delivery: str, run: RunContext) -> None:
        rows = self.standardized(dataset, delivery)
        if dataset == "circuits":
            found = quality.quality_metrics(
                rows, dataset, "feeder_id", "max_hosting_capacity_mw", refreshed="hca_refresh_date", as_of=run.date()
            )
        else:
            found = quality.quality_metrics(rows, dataset, "der_id", "nameplate_rating_kw", reference="feeder_id")
        out = f"{self.root}/metrics/quality/run_id={delivery}/of_table={dataset}"
        found.write.mode("overwrite").parquet(out)

    def _store_unmapped(self, dataset: str, delivery: str) -> None:
        """On the rows before quarantine, which is where unmapped types still are."""
        tagged = self.snapshots(dataset).read(self.spark, delivery)
        found = quality.unmapped_types(tagged, self.registry.free_text_tenants())
        found.write.mode("overwrite").parquet(f"{self.root}/metrics/unmapped/run_id={delivery}/of_table={dataset}")

    def _store_losses(self, dataset: str, delivery: str, delivered: DataFrame, counts: list[tuple]) -> None:
        """Rows per tenant that rules drop or quarantine, that no history takes, that a parse lost a value of, and that
        no registry entry picks up (of these tenants' folders alone, one column is read)."""
        columns = "utility_id string, rule_name string, checked long, failed long"
        lost = self.spark.createDataFrame(counts, columns)
        strangers = quality.unregistered_tenants(delivered, self.registry.get_registered_utilities())
        count = F.col("record_count")
        lost = lost.unionByName(strangers.select(
            "utility_id", F.lit("registered_utility").alias("rule_name"), count.alias("checked"), count.alias("failed")
        ))
        lost.write.mode("overwrite").parquet(f"{self.root}/metrics/losses/run_id={delivery}/of_table={dataset}")

    def losses(self) -> DataFrame:
        """(run_id, of_table, utility_id, rule_name, checked, failed) of all deliveries."""
        return self.spark.read.parquet(f"{self.root}/metrics/losses")

    def update_history(self) -> None:
        """Take every published run not yet in the history, oldest first.

        A run writes what it changes: the open versions of keys with news and the versions these close. A delivery
        that repeats what is known writes none. Keys with late rows are rebuilt from the files that hold them.
        """
        for dataset, flow in FLOWS.items():
            target = self.history(dataset)
            done = target.runs(self.spark)
            for run_id in [r for r in self.snapshots(dataset).runs(self.spark) if r not in done]:
                with steps_dropped(self.spark):
                    self._take(dataset, flow, target, run_id)

    def _take(self, dataset: str, flow: HistoryFlow, target: VersionTable, run_id: str) -> None:
        def history_of(rows: DataFrame) -> DataFrame:
            by = flow.keys if flow.close_missing is None else flow.close_missing
            if flow.close_missing is None:
                found = self.snapshots(dataset).read_keys(self.spark, rows, by)
            else:
                found = self.snapshots(dataset).read_all(self.spark).join(rows, list(by), "left_semi")
            return self._valid(dataset, found)

        flow.take(self.spark, target, run_id, self.standardized(dataset, run_id), history_of)

    def history_changes(self, dataset: str, from_run: str, to_run: str, columns: Sequence[str]) -> DataFrame:
        """Change feed of the current state between two runs, from the stored log."""
        table = self.history(dataset)
        return table.net_changes(self.spark, table.version_of(self.spark, from_run), table.version_of(self.spark, to_run), columns)

    def serve(self, run: RunContext) -> None:
        circuits, installed, planned = (self.history(d).read(self.spark) for d in DATASETS)
        run_id = run.run_id
        capacity = serving.feeders_with_capacity(circuits, installed, planned)
        self.served("feeders_with_capacity").publish(capacity, run_id, ["utility_id", "feeder_id"])
        summary = self.served("feeder_der_summary")
        summary.publish(serving.feeder_der_summary(installed, planned), run_id, ["feeder_id", "utility_id"])
        layer = serving.feeder_map_layer(circuits, summary.read(self.spark, run_id))
        self.served("feeder_map_layer").publish(layer, run_id, ["utility_id", "grid_area_code"])

    def refresh(self, landing: str, run: RunContext) -> None:
        """All steps in order, with the outcome in the run log.  Each step can be run again after
        a failure with the same run: what is published stays, the rest is written over."""
        try:
            self.ingest(landing, run)
            self.standardize(run)
            self.update_history()
            self.serve(run)
        except Exception:
            self._log(run, "FAILED")
            raise
        self._log(run, "SUCCESS")

    def _log(self, run: RunContext, status: str) -> None:
        entry = self.spark.range(1).select(
            F.lit(run.run_id).alias("run_id"), run.timestamp().alias("start_time"), F.lit(status).alias("status")
        )
        entry.coalesce(1).write.mode("append").parquet(f"{self.root}/runs")

    def run_log(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/runs")

"""Tenants by configuration: which layout each dataset has, and how dates are written."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.plans.canonical import canonical_circuits, canonical_der
from tierstone.plans.layouts import Layout

DATASETS = ("circuits", "der_installed", "der_planned")


@dataclass(frozen=True)
class Tenant:
    """One data supplier.  ``install_date_format`` may be ``"iso"``; ``free_text_types`` says that
    technologies arrive as free text and go through the synonyms."""

    utility_id: str
    circuits: Layout
    der_installed: Layout
    der_planned: Layout
    refresh_format: str | None = None
    install_date_format: str | None = "iso"
    free_text_types: bool = False

    def layout(self, dataset: str) -> Layout:
        return getattr(self, dataset)


@dataclass
class TenantRegistry:
    tenants: dict[str, Tenant] = field(default_factory=dict)

    def register(self, tenant: Tenant) -> TenantRegistry:
        self.tenants[tenant.utility_id] = tenant
        return self

    def get_registered_utilities(self) -> dict[str, Tenant]:
        return dict(self.tenants)

    def is_utility_registered(self, utility_id: str) -> bool:
        return utility_id in self.tenants

    def free_text_tenants(self) -> list[str]:
        return [t.utility_id for t in self.tenants.values() if t.free_text_types]

    def intermediate(self, raw: DataFrame, dataset: str) -> DataFrame:
        """Raw rows of every registered tenant in the common intermediate shape.

        One branch per distinct layout with an ``IN`` filter on the partition column, so each
        branch reads only its tenants' folders and the plan does not grow with the tenant count.
        """
        if dataset not in DATASETS:
            raise ValueError(f"unknown dataset {dataset!r}; one of {DATASETS}")
        if not self.tenants:
            raise ValueError("no tenant is registered")
        by_layout: dict[Layout, list[str]] = {}
        for t in self.tenants.values():
            by_layout.setdefault(t.layout(dataset), []).append(t.utility_id)
        branches = [
            layout(raw.filter(F.col("utility_id").isin(*ids))) for layout, ids in by_layout.items()
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)

    def standardize(self, raw: DataFrame, dataset: str, unparsed: bool = False) -> DataFrame:
        """Raw rows of all registered tenants in the canonical, typed model; ``unparsed`` adds what no value came of."""
        rows = self.intermediate(raw, dataset)
        if dataset == "circuits":
            formats = {t.utility_id: t.refresh_format for t in self.tenants.values() if t.refresh_format}
            return canonical_circuits(rows, formats, unparsed)
        formats = {t.utility_id: t.install_date_format for t in self.tenants.values() if t.install_date_format}
        return canonical_der(rows, dataset.removeprefix("der_"), self.free_text_tenants(), formats, unparsed)

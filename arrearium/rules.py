"""Business parameters.

Two upstream systems feed one portfolio: system A (JSON pages) and system B (CSV
exports).  The labels they carry in the unified tables, and the dates and
thresholds of the KPIs, are parameters so each portfolio can set its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from decimal import Decimal


@dataclass(frozen=True)
class PortfolioRules:
    # labels
    source_a: str = "A"
    source_b: str = "B"
    entity_main: str = "E1"
    entity_other: str = "E2"
    category_a_main: str = "a_main"
    category_a_other: str = "a_other"
    category_b_excluded: str = "b_excluded"
    category_b_recent: str = "b_recent"
    category_b_old: str = "b_old"
    # dates
    b_recent_from: date = date(2024, 4, 1)
    activations_from: date = date(2024, 1, 1)
    collection_start: date = date(2025, 9, 1)
    history_start: date = date(2024, 4, 1)
    month_snapshot_start: date = date(2026, 1, 1)
    report_start: date = date(2026, 1, 1)
    report_end: date = date(2026, 6, 30)
    # amounts and thresholds
    fx_rate: Decimal = Decimal("655.957")
    free_days: int = 30
    lookback_days: int = 45
    b_grace_days: int = 3
    write_off_days: int = 120
    free_period_cld_max: int = 60
    pvp_cap: int = 2

    @property
    def core_categories(self) -> tuple[str, str]:
        """The categories the collection, repayment and report KPIs look at."""
        return (self.category_a_main, self.category_b_recent)

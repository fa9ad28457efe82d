"""One planning cycle from the six input tables to the reporting table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from shelfcast.operators.dashboard import kpi_summary, plant_exposure, recovery_timing
from shelfcast.operators.drivers import (
    critical_rate_by_lead_time,
    demand_signal_gap,
    forecast_change_by_group,
    lead_time_exposure,
    pareto_priority,
    report_qa,
    shortfall_pareto,
)
from shelfcast.operators.projection import first_stockout, stockout_risk_analysis, stockout_timing
from shelfcast.operators.quality import dedupe_exact, null_profile
from shelfcast.operators.scenarios import (
    enrich_and_value,
    prioritise,
    risk_profile,
    scenario_counts,
    scenario_projection,
    severity,
    status_counts,
    supply_coverage,
)
from shelfcast.plans.validation import quality_summary
from shelfcast.sources import contracts
from shelfcast.sources.commits import CycleRun
from shelfcast.sources.tables import PlanningTables, materialise, release, stored_so_far

PROFILE = "stockout_risk_profile"
PARETO = "shortfall_pareto"
QUALITY = "quality_summary"

CONCURRENT_RESULTS = 4  # results that are computed and stored side by side: each is small, and waits for its last tasks

Save = Callable[[DataFrame, str], DataFrame]


def analysis_of(
    tables: PlanningTables,
    *,
    as_of: dt.date | None = None,
    horizon_months: int | None = None,
    site_mode: str = "single",
    spine: str = "forecast",
    threshold: Column | int = 0,
) -> DataFrame:
    return stockout_risk_analysis(
        tables.forecast,
        tables.supply,
        tables.inventory,
        as_of=as_of,
        horizon_months=horizon_months,
        site_mode=site_mode,
        spine=spine,
        threshold=threshold,
    )


def profile_of(analysis: DataFrame, *, site_mode: str = "single", threshold: Column | int = 0) -> DataFrame:
    return risk_profile(scenario_projection(analysis), site_mode=site_mode, threshold=threshold)


def report_of(profile: DataFrame, materials: DataFrame) -> DataFrame:
    """The reporting table: the valued stockout list with what remains short after all supply."""
    return enrich_and_value(severity(prioritise(profile, shortages=True)), materials)


def stockouts_of(profile: DataFrame, materials: DataFrame) -> DataFrame:
    return report_of(profile, materials).drop("Remaining_Shortfall_Units")


@dataclass(frozen=True)
class Cycle:
    """The stored tables of a cycle; every further result is a query on them."""

    tables: PlanningTables
    as_of: dt.date
    analysis: DataFrame
    profile: DataFrame
    stockouts: DataFrame
    report: DataFrame
    pareto: DataFrame

    def results(self) -> dict[str, DataFrame]:
        """Driver and dashboard results, not computed until used."""
        return {
            "stockout_timing": stockout_timing(first_stockout(self.analysis)),
            "scenario_counts": scenario_counts(self.profile),
            "status_counts": status_counts(self.stockouts),
            "stockout_null_profile": null_profile(self.stockouts, contracts.STOCKOUT_REQUIRED),
            "lead_time_exposure": lead_time_exposure(self.stockouts),
            "critical_rate_by_lead_time": critical_rate_by_lead_time(self.tables.materials, self.stockouts),
            "demand_signal_gap": demand_signal_gap(self.tables.forecast, self.stockouts),
            "forecast_change_by_group": forecast_change_by_group(self.tables.forecast, self.stockouts),
            "pareto_priority": pareto_priority(self.pareto),
            "report_qa": report_qa(self.report),
            "kpi_summary": kpi_summary(self.tables.materials, self.report),
            "plant_exposure": plant_exposure(self.report),
            "recovery_timing": recovery_timing(self.report, self.as_of),
        }


@contextmanager
def _one_commit(save: Save) -> Iterator[None]:
    """All that is stored inside becomes current together, or, if something fails, none of it. A ``save`` that has no
    commit (`replace_table`, `materialise`) stores each table on its own."""
    try:
        yield
        if isinstance(save, CycleRun):
            save.commit()
    except BaseException:
        if isinstance(save, CycleRun):
            save.abort()
        raise


def _tables_of_cycle(
    tables: PlanningTables, as_of: dt.date, save: Save, horizon_months: int | None, site_mode: str, spine: str, threshold: Column | int
) -> Cycle:
    planned = analysis_of(
        tables, as_of=as_of, horizon_months=horizon_months, site_mode=site_mode, spine=spine, threshold=threshold
    )
    analysis = save(planned, contracts.ANALYSIS)
    profile = save(profile_of(analysis, site_mode=site_mode, threshold=threshold), PROFILE)
    report = save(report_of(profile, tables.materials), contracts.REPORT)
    stockouts = save(report.drop("Remaining_Shortfall_Units"), contracts.STOCKOUTS)
    mark = stored_so_far()
    pareto = save(shortfall_pareto(supply_coverage(profile)), PARETO)
    if save is not materialise:
        release(pareto.sparkSession, mark)
    return Cycle(tables, as_of, analysis, profile, stockouts, report, pareto)


def run_cycle(
    tables: PlanningTables,
    as_of: dt.date,
    save: Save,
    *,
    horizon_months: int | None = None,
    site_mode: str = "single",
    spine: str = "forecast",
    threshold: Column | int = 0,
) -> Cycle:
    """Compute and store the tables of one planning cycle.

    ``save(df, name)`` stores a table and returns it as stored: see `cycle_store`, `replace_table` and
    `materialise`. The raw tables are read once, for the analysis; what follows works on one row per material, month
    and site or less.
    """
    with _one_commit(save):
        return _tables_of_cycle(tables, as_of, save, horizon_months, site_mode, spine, threshold)


def refresh(
    tables: PlanningTables,
    as_of: dt.date,
    save: Save,
    *,
    horizon_months: int | None = None,
    site_mode: str = "single",
    spine: str = "forecast",
    threshold: Column | int = 0,
    history_months: int = 24,
) -> Cycle:
    """A whole planning cycle, stored: checks, cleaned demand history, the cycle's tables and all results.

    With `cycle_store` all of them become current in one commit: readers see the run before or this one, never parts
    of both. Results that don't depend on one another are stored side by side.
    """
    with _one_commit(save):
        save(quality_summary(tables, history_months=history_months), QUALITY)
        save(dedupe_exact(tables.actuals), contracts.DEMAND_ACTUALS_CLEAN)
        cycle = _tables_of_cycle(tables, as_of, save, horizon_months, site_mode, spine, threshold)
        with ThreadPoolExecutor(CONCURRENT_RESULTS) as pool:
            for stored in [pool.submit(save, result, name) for name, result in cycle.results().items()]:
                stored.result()
    return cycle


def cycle_store(root: str, cycle: dt.date) -> CycleRun:
    """Store below ``root``, partitioned by cycle date; a run of `run_cycle` or `refresh` is one commit."""
    return CycleRun(root, cycle)

"""User-level reports: one lazy DataFrame (one logical plan) per report; building
one starts no job, except the workbook loads, which write their cells once.

Inputs are the stored tables (all-text, upper-case names as loaded by the
sinks); the caller collects or writes the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tresoria.constants import CONSOLIDATED_ACCOUNT
from tresoria.operators import cells, controls, forecast, ledger, periods
from tresoria.sources.sinks import consolidate


def prev_clean(prev_raw: DataFrame, frequence: str = "mensuelle") -> DataFrame:
    """Harmonised, latest-version forecast table (monthly or quarterly)."""
    return forecast.clean_forecast(prev_raw, frequence)


def sage_clean(ledger_raw: DataFrame, start=None, end=None, accounts=None) -> DataFrame:
    """Typed, latest-file ledger with calendar keys, of a range of days and accounts."""
    return ledger.clean_ledger(ledger_raw, start, end, accounts)


def _period_col(freq: str) -> str:
    return "annee_mois" if freq.upper().startswith("M") else "trimestre"


def flux_report(prev_raw: DataFrame, annee: int, version: str, freq: str = "M") -> DataFrame:
    """Ordered by period (the result has at most a few dozen rows)."""
    out = forecast.flux_report(prev_clean(prev_raw), annee, version, freq)
    return out.orderBy(_period_col(freq), "type")


def nature_report(prev_raw: DataFrame, label: str, annee: int, version: str, freq: str = "M") -> DataFrame:
    out = forecast.nature_report(prev_clean(prev_raw), label, annee, version, freq)
    return out.orderBy(_period_col(freq))


def label_reports(prev_raw: DataFrame, annee: int, version: str, freq: str = "M") -> DataFrame:
    """Every label realised against one forecast version, ordered by label and period."""
    out = forecast.label_reports(prev_clean(prev_raw), annee, version, freq)
    return out.orderBy("nature_montant", _period_col(freq))


def versions(prev_raw: DataFrame, annee: int | None = None, label: str | None = None) -> DataFrame:
    return forecast.versions(prev_clean(prev_raw), annee, label).orderBy("annee", "version_prev", ascending=False)


def kpi(ledger_raw: DataFrame, lag_days: int, end_date=None,
        accounts: Sequence[str] = (CONSOLIDATED_ACCOUNT,), grain: str = "flux", as_text: bool = False) -> DataFrame:
    k = controls.kpi(sage_clean(ledger_raw), lag_days, end_date, accounts, grain)
    return controls.kpi_text(k) if as_text else k


def balance(ledger_raw: DataFrame, freq: str = "J", accounts: Sequence[str] | None = (CONSOLIDATED_ACCOUNT,),
            start=None, end=None, grain: str = "flux", how: str = "sum") -> DataFrame:
    out = periods.balance(sage_clean(ledger_raw, start, end, accounts), grain, freq, how)
    return out.orderBy(out.columns[0], "banque_compte")


def flows(ledger_raw: DataFrame, kind: str = "recettes", freq: str = "J", grain: str = "flux",
          start=None, end=None, budget_codes: DataFrame | None = None) -> DataFrame:
    """Receipts or spending of the consolidated account; the label set is
    derived from the whole ledger, the rows from the chosen date range."""
    all_rows = sage_clean(ledger_raw)
    labels = periods.flow_labels(all_rows, kind, grain, budget_codes)
    out = periods.flows(sage_clean(ledger_raw, start, end), labels, grain, freq)
    return out.orderBy(out.columns[0], out.columns[1])


def flow_axis(ledger_raw: DataFrame, grain: str = "flux", start=None, end=None,
              budget_codes: DataFrame | None = None) -> DataFrame:
    all_rows = sage_clean(ledger_raw)
    table = periods.flow_label_table(all_rows, grain, budget_codes)
    ext = periods.flow_extremes(sage_clean(ledger_raw, start, end), table, grain)
    return periods.axis_range(ext)


def load_control(ledger_raw: DataFrame) -> DataFrame:
    return controls.files_per_day(ledger.typed_ledger(ledger_raw)).orderBy("date_montant")


def label_usage(ledger_raw: DataFrame, grain: str = "flux") -> DataFrame:
    return controls.label_usage(sage_clean(ledger_raw), grain).orderBy("nb_dates", ascending=False)


def ingest_forecast(cells_df: DataFrame, layout: str = "multi") -> DataFrame:
    return cells.ingest_forecast(cells_df, layout)


def ingest_adjustments(cells_df: DataFrame) -> DataFrame:
    return cells.adjustments(cells_df)


def consolidate_ledger(current: DataFrame, history: DataFrame) -> DataFrame:
    return consolidate(current, history)

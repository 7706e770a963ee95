"""Plan-level properties that matter at scale."""

import re
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tresoria import fixtures
from tresoria.operators import forecast, ledger, periods
from tresoria.plans import catalog, reports

SF = "/root/testdata/sf0.001"


def _plan(df):
    """The whole plan that ran, adaptive re-planning included."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def _jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs()


def _scans(df, what="PartitionFilters"):
    return re.findall(what + r": \[([^\]]*)\]", df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))


def test_ledger_report_shuffles_aggregated_rows_and_broadcasts(spark):
    plan = _plan(E.queries()["balance_month"](spark, SF))
    assert "InMemoryRelation" not in plan and "BroadcastHashJoin" in plan
    assert "partial_sum" in plan and "partial_max" in plan


def test_scans_read_only_needed_columns(spark):
    full = _plan(E.queries()["balance_month"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", full)
    assert len(schemas) >= 2 and all("props" not in s and "ts:" not in s for s in schemas)


def test_building_a_report_starts_no_job_and_persists_nothing(spark):
    raw, prev = (fixtures.view(spark, SF, v) for v in ("ledger", "prev"))
    before = _jobs(spark)
    built = [reports.balance(raw, "M", accounts=None), reports.flows(raw, "recettes", "S"), reports.kpi(raw, 7),
             reports.flow_axis(raw), reports.flux_report(prev, 1997, "1997-06"), reports.label_reports(prev, 1997, "1997-06")]
    assert _jobs(spark) == before
    for df in built:
        df.collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


@pytest.mark.parametrize("name", ["balance_month", "kpi_week", "receipts_month", "sheet_bounds", "adjustments", "forecast_ingest"])
def test_no_query_leaves_a_persisted_rdd(spark, name):
    catalog.QUERIES[name](spark, SF).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_a_file_that_arrives_between_two_reports_is_seen(spark):
    d = tempfile.mkdtemp(prefix="tresoria-fresh-", dir="/tmp")
    cols = ["DATE_MONTANT", "DATE_PRODUCTION_FICHIER", "BANQUE_COMPTE", "TYPE_MONTANT", "CODE_FLUX_LIBELLE", "CODE_BUDGETAIRE",
            "MONTANT", "FICHIER"]
    row = lambda file_time, amount: ("2024/01/05", file_time, "Total", "R", "Solde Final", "Solde Final", amount, "f.csv")
    spark.createDataFrame([row("2024/01/06 06:00:00", "100")], cols).write.parquet(d + "/t")
    report = lambda: [r.montant for r in reports.balance(spark.read.parquet(d + "/t"), "M").collect()]
    assert report() == [100.0]
    spark.createDataFrame([row("2024/01/07 06:00:00", "999")], cols).coalesce(1).write.parquet(d + "/new")
    import glob
    shutil.copy(glob.glob(d + "/new/part-*.parquet")[0], d + "/t/part-later.parquet")  # from outside this session
    assert report() == [999.0]


def test_typed_stores_prune_partitions_in_every_scan(spark):
    d = tempfile.mkdtemp(prefix="tresoria-prune-", dir="/tmp")
    ledger.store_typed_ledger(fixtures.view(spark, SF, "ledger"), d + "/ledger")
    forecast.store_typed_forecast(fixtures.view(spark, SF, "prev"), d + "/prev")
    stored, prev = spark.read.parquet(d + "/ledger"), spark.read.parquet(d + "/prev")
    for df in (reports.balance(stored, "M", None, "2023-12-05", "2024-01-20"),
               periods.balance(ledger.clean_ledger(stored, "2023-12-05", "2024-01-20"), "flux", "J")):
        found = _scans(df)
        assert len(found) >= 2 and all("annee_mois" in f for f in found)
        assert all("date_montant" in f for f in _scans(df, "PushedFilters"))
    want = reports.balance(fixtures.view(spark, SF, "ledger"), "M", None, "2023-12-05", "2024-01-20")
    got = reports.balance(stored, "M", None, "2023-12-05", "2024-01-20")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    for df in (reports.flux_report(prev, 1997, "1997-06"), reports.nature_report(prev, "Aides", 1997, "1997-06")):
        found = _scans(df)
        assert len(found) >= 2 and all("annee" in f and "1997" in f for f in found if f)
        assert all(found)
    assert stored.select(F.col("annee_mois")).distinct().count() > 2

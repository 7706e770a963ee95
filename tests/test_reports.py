"""User-level report entry points on the fixture views (sf0.001)."""

import pytest

import __spark_entry__ as E
from tresoria import fixtures
from tresoria.plans import reports

SF = "/root/testdata/sf0.001"


def same(a, b):
    ra = sorted(map(tuple, a.collect()), key=str)
    rb = sorted(map(tuple, b.select(*a.columns).collect()), key=str)
    return ra == rb


@pytest.fixture(scope="module")
def ledger_raw(spark):
    return fixtures.view(spark, SF, "ledger")


@pytest.fixture(scope="module")
def prev_raw(spark):
    return fixtures.view(spark, SF, "prev")


def test_balance_report_equals_registered_query(spark, ledger_raw):
    got = reports.balance(ledger_raw, "M", accounts=None)
    assert same(got, E.queries()["balance_month"](spark, SF))


def test_flow_reports(spark, ledger_raw):
    assert same(reports.flows(ledger_raw, "recettes", "S"), E.queries()["receipts_week"](spark, SF))
    axis = {r["frequence"]: r for r in reports.flow_axis(ledger_raw).collect()}
    assert set(axis) == {"J", "S", "M", "T", "A"}
    assert all(r["borne_haute"] >= r["borne_basse"] for r in axis.values())


def test_kpi_and_controls(spark, ledger_raw):
    assert same(reports.kpi(ledger_raw, 7), E.queries()["kpi_week"](spark, SF))
    txt = reports.kpi(ledger_raw, 7, as_text=True).collect()
    assert all(r["valeur"] is None or r["valeur"].endswith(" €") for r in txt)
    lc = reports.load_control(ledger_raw).collect()
    assert [r["date_montant"] for r in lc] == sorted(r["date_montant"] for r in lc)
    usage = [r["nb_dates"] for r in reports.label_usage(ledger_raw).collect()]
    assert usage == sorted(usage, reverse=True)


def test_forecast_reports(spark, prev_raw):
    assert same(reports.flux_report(prev_raw, 1997, "1997-06"), E.queries()["flux_report_month"](spark, SF))
    v = [r["version_prev"] for r in reports.versions(prev_raw, 1997).collect()]
    assert v == sorted(v, reverse=True) and len(v) == 12


def test_ingest_and_consolidate(spark, ledger_raw):
    cells = fixtures.view(spark, SF, "cells_single")
    assert same(reports.ingest_forecast(cells, "single"), E.queries()["forecast_ingest_single"](spark, SF))
    adj = reports.ingest_adjustments(fixtures.view(spark, SF, "cells_adj"))
    assert adj.count() == E.queries()["adjustments"](spark, SF).count()
    a = ledger_raw.where("FICHIER = 'export_0.csv'")
    b = ledger_raw.where("FICHIER <> 'export_0.csv'")
    assert reports.consolidate_ledger(a, b).count() == ledger_raw.count()


def test_reports_are_ordered_by_period(spark, ledger_raw, prev_raw):
    fr = [r["annee_mois"] for r in reports.flux_report(prev_raw, 1997, "1997-06").collect()]
    assert fr == sorted(fr)
    bal = [r["annee_semaine"] for r in reports.balance(ledger_raw, "S").collect()]
    assert bal == sorted(bal)


def test_label_reports_contain_the_single_label_report(spark, prev_raw):
    allr = reports.label_reports(prev_raw, 1997, "1997-06").where("nature_montant = 'Contributions pôle emploi'")
    one = reports.nature_report(prev_raw, "Contributions pôle emploi", 1997, "1997-06")
    assert same(one, allr.drop("nature_montant"))

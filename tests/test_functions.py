"""Column functions on hand-written values."""

import datetime as dt

from pyspark.sql import functions as F

from tresoria.functions import calendar, text, version


def col_values(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_version_from_filename(spark):
    names = ["Equilibre Technique mensualisé 2017.10 - DEA.xlsx", "Equilibre Technique mensualisé 2019 03 - DEA.xlsx",
             "prev 19102020.xlsx", "prev 2020-10-19.xlsx", "sans date.xlsx",
             "/mnt/x/Prévisions DEA mensualisées/Equilibre 2021.06 - DEA.xlsx", "bad 2019.13.xlsx"]
    got = col_values(spark, names, version.version_from_filename)
    assert got == ["2017-10", "2019-03", "2020-10", "2020-10", None, "2021-06", None]


def test_name_normaliser_matches_python_rule(spark):
    names = ["Été Prévu (n.1)...", "d'indus / à payer", "  Nature  Montant ", "Solde -- fin…", "ça.va/là"]
    got = col_values(spark, names, text.normalise_name)
    assert got == [text.normalise_name_py(n) for n in names]
    assert text.normalise_name_py("d'indus / à payer") == "D_INDUS__PAYER"  # "à" is removed after the "__" collapse


def test_nan_markers(spark):
    vals = ["nan", "NaN", "NAN", "None", "", "1.5", None, "NaT"]
    got = col_values(spark, vals, text.nan_to_null)
    assert got == [None, None, None, "None", "", "1.5", None, "NaT"]


def test_tolerant_number(spark):
    from tresoria.functions.numeric import to_number
    got = col_values(spark, ["1.5", "n/a", "", None, "-3", " 2 "], to_number)
    assert got[:5] == [1.5, None, None, None, -3.0]


def test_month_maps(spark):
    names = ["janvier", "août", "aout", "décembre", "TOTAL", "TOTAL.1", None]
    assert col_values(spark, names, calendar.month_number) == ["01", "08", None, "12", None, None, None]
    assert col_values(spark, ["3", "12", "13"], calendar.month_name) == ["mars", "décembre", None]


def test_week_key_is_sunday_week_number(spark):
    days = [dt.date(2015, 1, 1) + dt.timedelta(days=i) for i in range(0, 5200, 7)]
    days += [dt.date(y, 1, d) for y in range(2015, 2030) for d in range(1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r[0] for r in df.select(calendar.year_week_sunday("d")).collect()]
    assert got == [d.strftime("%Y-%U") for d in days]


def test_quarter_and_forecast_keys(spark):
    df = spark.createDataFrame([("2021", "02"), ("2021", "12"), ("2021", None)], "annee string, mois string")
    rows = df.select(calendar.forecast_year_month("annee", "mois"), calendar.forecast_quarter("annee", "mois")).collect()
    assert [tuple(r) for r in rows] == [("2021-02", "2021-T1"), ("2021-12", "2021-T4"), (None, None)]


def test_kpi_text_matches_python_format(spark):
    vals = [1234567.5, -1234.565, 12.5, 0.0, 2.5, 3.5, 999.994, -0.25, 0.125, 1.005, -0.001]
    amount = col_values(spark, vals, text.amount_text, "double")
    pct = col_values(spark, vals, text.percent_text, "double")
    assert amount == ["{:,}".format(round(v)).replace(",", " ") + " €" for v in vals]
    assert pct == ["{:,}".format(round(v, 2)).replace(",", " ") + " %" for v in vals]


def test_fill_trim_label(spark):
    got = col_values(spark, [None, "  Aides ", "x"], text.fill_trim_label)
    assert got == ["Eléments exceptionnels", "Aides", "x"]

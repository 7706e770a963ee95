"""Operators on hand-written frames: each quirk and each NULL rule."""

from pyspark.sql import functions as F

from tresoria import constants as K
from tresoria.operators import cells as C
from tresoria.operators import controls, forecast, labels, latest, ledger, periods


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# ------------------------------------------------------------------ labels

def test_harmonise_each_rule(spark):
    data = []
    for src, _ in K.LABEL_RULES:
        data.append((src, 1.0))
    for src, _, _ in K.SIGNED_LABEL_RULES:
        data += [(src, -1.0), (src, 0.0), (src, None)]
    data += [("Etat - Prélèvement à la source", -1.0), ("Etat - Prélèvement à la source", None),
             ("Prélèvements sociaux", 5.0), ("Inconnu", 1.0), (None, 1.0)]
    df = spark.createDataFrame(data, "nature_montant string, montant_millions double")
    got = [r[0] for r in labels.harmonise(df).select("nature_montant").collect()]
    expect = []
    for lab, amt in data:
        out = dict(K.LABEL_RULES).get(lab, lab)
        for src, neg, pos in K.SIGNED_LABEL_RULES:
            if out == src and amt is not None:
                out = neg if amt < 0 else pos
        expect.append(out)
    assert got == expect
    assert expect[-5:] == ["Dépenses - Etat - Prélèvement à la source", "Prélèvement à la source",
                           "Prélèvements sociaux", "Inconnu", None]


def test_static_rules_do_not_chain():
    outs = {b for _, b in K.LABEL_RULES}
    ins = {a for a, b in K.LABEL_RULES if a != b}
    assert not (outs & ins)


def test_level_tag(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("z",), (None,)], "l string")
    got = [r[0] for r in df.select(labels.level_tag("l", ["a"], ["b", "a"], ["c"])).collect()]
    assert got == ["niv01", "niv02", "niv03", None, ""]


def test_category_first_wins(spark):
    df = spark.createDataFrame([("Autres produits",), ("Dette",), ("Inconnu",)], "nature_montant string")
    assert rows(labels.with_category(df), "nature_montant", "categorie") == [
        ("Autres produits", "recettes"), ("Dette", "depenses"), ("Inconnu", None)]


# ------------------------------------------------------------------ latest

def test_keep_latest_ties_and_nulls(spark):
    df = spark.createDataFrame([
        ("k1", "2020-01", 1), ("k1", "2020-02", 2), ("k1", "2020-02", 3),
        ("k2", "2019-12", 4), (None, "2030-01", 5)], "k string, v string, id int")
    out = latest.keep_latest(df, ["k"], "v")
    assert rows(out, "id") == [(2,), (3,), (4,)]
    # idempotent
    assert rows(latest.keep_latest(out, ["k"], "v"), "id") == rows(out, "id")


def test_latest_realised_keeps_all_forecasts(spark):
    base = ("2020", "01", "janvier", "Aides")
    df = spark.createDataFrame([
        ("2020-01",) + base[:3] + ("Aides", "Réalisé", 1.0),
        ("2020-03",) + base[:3] + ("Aides", "Réalisé", 2.0),
        ("2020-01",) + base[:3] + ("Aides", "Prévu", 3.0),
        ("2020-03",) + base[:3] + ("Aides", "Prévu", 4.0),
        ("2020-03",) + base[:3] + ("Aides", "Estimé", 5.0)],
        "version_prev string, annee string, mois string, mois_nom string, nature_montant string, "
        "type_montant string, montant_millions double")
    assert rows(forecast.latest_realised(df), "montant_millions") == [(2.0,), (3.0,), (4.0,)]


# --------------------------------------------------------------- reports

def _clean(spark, data):
    df = spark.createDataFrame(data, "version_prev string, annee string, mois string, mois_nom string, "
                                     "nature_montant string, type_montant string, montant_millions string")
    return forecast.clean_forecast(df.toDF(*[c.upper() for c in df.columns]))


def test_flux_report_outer_join_and_running_totals(spark):
    data = [
        ("2021-06", "2021", "01", "janvier", "Aides", "Réalisé", "10"),
        ("2021-06", "2021", "02", "février", "Aides", "Réalisé", "5"),
        ("2021-06", "2021", "02", "février", "Aides", "Prévu", "7"),
        ("2021-06", "2021", "03", "mars", "Aides", "Prévu", "1"),
        ("2021-06", "2021", "01", "janvier", "Total Dépenses", "Réalisé", "4"),
        ("2021-06", "2021", "01", "janvier", "Aides", "Réalisé", "n/a"),
        ("2021-06", "2021", None, "TOTAL", "Aides", "Réalisé", "99"),
    ]
    out = forecast.flux_report(_clean(spark, data), 2021, "2021-06", "M")
    got = rows(out, "type", "annee_mois", "montant_realise", "montant_prevu", "cumul_realise", "cumul_prevu")
    assert got == [
        ("depenses", "2021-01", -4.0, None, -4.0, None),
        ("recettes", "2021-01", 10.0, None, 10.0, None),
        ("recettes", "2021-02", 5.0, 7.0, 15.0, 7.0),
        ("recettes", "2021-03", None, 1.0, None, 8.0),
    ]


def test_running_total_last_equals_total(spark):
    data = [("2021-06", "2021", f"{m:02d}", K.MONTHS_FR[m - 1], "Aides", "Réalisé", str(m)) for m in range(1, 13)]
    rt = forecast.running_totals(_clean(spark, data))
    last = rt.orderBy(F.col("annee_mois").desc()).first()
    assert last["cumul"] == sum(range(1, 13))


# ------------------------------------------------------------------ ledger

def _ledger(spark, data):
    cols = ["DATE_MONTANT", "DATE_PRODUCTION_FICHIER", "BANQUE_COMPTE", "TYPE_MONTANT", "CODE_FLUX_LIBELLE",
            "CODE_BUDGETAIRE", "MONTANT", "FICHIER"]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in cols))


def test_latest_file_and_balance_week(spark):
    raw = _ledger(spark, [
        ("2024/01/06", "2024/01/06 06:00:00", "Total", "R", "Solde Final", "Solde Final", "1", "a"),
        ("2024/01/06", "2024/01/07 06:00:00", "Total", "R", "Solde Final", "Solde Final", "2", "b"),
        ("2024/01/07", "2024/01/07 06:00:00", "Total", "R", "Solde Final", "Solde Final", "3", "b"),
        ("2024/01/08", "2024/01/08 06:00:00", " 107CDNB", "R", "Solde Final", "Solde Final", "4", "c"),
        ("2024/01/08", "2024/01/08 06:00:00", "Total", "R", "Recettes x", "R1", "5", "c"),
    ])
    s = ledger.clean_ledger(raw)
    assert rows(s, "montant") == [(2.0,), (3.0,), (4.0,), (5.0,)]
    wk = periods.balance(s, "flux", "S")
    assert rows(wk, "annee_semaine", "banque_compte", "montant", "date_montant") == [
        ("2024-00", "Total", 2.0, __import__("datetime").date(2024, 1, 6)),
        ("2024-01", " 107CDNB", 4.0, __import__("datetime").date(2024, 1, 7)),
        ("2024-01", "Total", 3.0, __import__("datetime").date(2024, 1, 7)),
    ]
    last = periods.balance(s, "flux", "M", how="last")
    assert rows(last, "banque_compte", "montant") == [(" 107CDNB", 4.0), ("Total", 3.0)]


def test_kpi_missing_and_zero_base(spark):
    raw = _ledger(spark, [
        ("2024/01/08", "2024/01/08 06:00:00", "Total", "R", "Solde Final", "Solde Final", "10", "a"),
        ("2024/01/08", "2024/01/08 06:00:00", "Total", "R", "Solde Final", "Solde Final", "12", "a"),
        ("2024/01/01", "2024/01/01 06:00:00", "Total", "R", "Solde Final", "Solde Final", "5", "a"),
        ("2024/01/08", "2024/01/08 06:00:00", "Total", "R", "Solde Initial", "Solde Initial", "1", "a"),
        ("2024/01/01", "2024/01/01 06:00:00", "Total", "R", "Solde Initial", "Solde Initial", "0", "a"),
    ])
    k = {r["libelle"]: r for r in controls.kpi(ledger.clean_ledger(raw), 7).collect()}
    assert k["Solde Final"]["montant_fin"] == 10.0 and k["Solde Final"]["evolution_pct"] == 100.0
    assert k["Solde Initial"]["evolution_pct"] is None
    assert k["Solde avant Décision"]["montant_fin"] is None


# ------------------------------------------------------------------- gate

def test_quality_gate_cases(spark):
    ok = ("f", "s1", "janvier", "Réalisé", "Aides")
    data = [ok, ok,
            ("f", "s2", "janvier", "Réalisé", "Inconnu"),
            ("f", "s3", "TOTAL janvier", "Réalisé", "Aides"), ("f", "s3", "xx", "Réalisé", "Aides"),
            ("f", "s4", "août", "Prévu", "Aides")]
    df = spark.createDataFrame(data, "nom_fichier string, nom_onglet string, mois_nom string, "
                                     "type_montant string, nature_montant string")
    g = {r["nom_onglet"]: r for r in controls.quality_gate(df).collect()}
    assert g["s1"]["valide"] and g["s1"]["valide_strict"]
    assert not g["s2"]["valide"] and not g["s2"]["nature_ok"]
    assert g["s3"]["valide"] and not g["s3"]["valide_strict"]  # double hit offsets a miss
    assert g["s4"]["valide"]


# ------------------------------------------------------------------ cells

def test_leading_run(spark):
    data = [("f", "a", c) for c in (1, 2, 3, 5, 6)] + [("f", "b", c) for c in (1, 3, 4)] + [("f", "c", 7)]
    df = spark.createDataFrame(data, "file string, sheet string, c int").withColumn("flag", F.lit(True))
    got = {r["sheet"]: (r["run_min"], r["run_max"], r["run_len"]) for r in C._leading_run(df, "flag").collect()}
    assert got["a"] == (1, 3, 3)
    assert got["b"][2] == 1 and got["c"][2] == 1  # no run of two: the bounds fall back


def _grid(spark, cells):
    return spark.createDataFrame([("wb.xlsx", "2021", r, c, v) for (r, c), v in cells.items()],
                                 "FILE string, SHEET string, R int, C int, V string")


def _multi_sheet(extra=None):
    g = {}
    for c in range(1, 13):
        g[(-1, c)] = K.MONTHS_FR[c - 1]
        g[(0, c)] = "Réalisé" if c <= 6 else "Prévu"
        for r in (1, 2, 3, 4):
            g[(r, c)] = f"{r * 100 + c}.5"
    # the anchor row and the row after it stay in the table; row 6 is outside
    g.update({(1, 0): " Contributions ", (2, 0): "Aides", (4, 0): "Solde financier", (6, 0): "hors tableau"})
    g[(6, 3)] = "77"
    g.update(extra or {})
    return g


def test_bounds_and_ingest_multi(spark):
    cells = _grid(spark, _multi_sheet())
    b = C.sheet_bounds(C.prepare_cells(cells)).first()
    assert (b["ancre"], b["ligne_fin"], b["col_debut"], b["col_fin"], b["repli"]) == (0, 6, 0, 13, False)
    fact = C.ingest_forecast(cells, "multi")
    got = rows(fact, "nature_montant")
    assert set(got) == {("Contributions",), ("Aides",), ("Eléments exceptionnels",), ("Solde financier",)}
    assert fact.count() == 4 * 12
    one = fact.where((F.col("nature_montant") == "Aides") & (F.col("mois") == "03")).first()
    assert (one["annee"], one["mois_nom"], one["type_montant"], one["montant_millions"]) == ("2021", "mars", "Réalisé", "203.5")


def test_bounds_fall_back_without_anchor(spark):
    g = _multi_sheet()
    g[(4, 0)] = "autre"
    b = C.sheet_bounds(C.prepare_cells(_grid(spark, g))).first()
    assert b["repli"] and (b["ligne_fin"], b["col_debut"], b["col_fin"]) == (7, 0, 13)


def test_label_repair_from_anchor_column(spark):
    g = {(-1, c): K.MONTHS_FR[c - 2] for c in range(2, 14)}
    for c in range(2, 14):
        g[(0, c)] = "Prévu"
        for r in (1, 2, 3):
            g[(r, c)] = "1.5"
    g.update({(1, 0): "Aides", (2, 0): "Dette", (2, 1): "Dette bis", (3, 0): "Variation de trésorerie"})
    cells = C.prepare_cells(_grid(spark, g))
    b = C.sheet_bounds(cells).first()
    assert (b["ancre"], b["col_debut"]) == (0, 1)
    labs = rows(C.crop(cells, C.sheet_bounds(cells)).where("c = 1 AND r >= 1"), "r", "v")
    assert labs == [(1, "Aides"), (2, "Dette bis"), (3, "Variation de trésorerie")]


def test_single_sheet_year_fill(spark):
    g = {}
    for i in range(24):
        c = i + 1
        g[(0, c)] = K.MONTHS_FR[i % 12]
        g[(1, c)] = "Réalisé" if i < 12 else "Prévu"
        g[(2, c)] = "1"
    g[(-1, 1)] = "2020"
    g[(-1, 13)] = "2021"
    g.update({(2, 0): "Aides", (3, 0): "Variation de trésorerie"})
    cells = C.prepare_cells(_grid(spark, g).withColumn("SHEET", F.lit("Feuil1")))
    years = rows(C.year_fill(C.crop(cells, C.sheet_bounds(cells))), "c", "annee")
    assert years == [(c, "2020" if c <= 12 else "2021") for c in range(1, 25)]


def test_single_sheet_year_before_the_first_january(spark):
    """A table that starts in March takes its year from March's own header."""
    g = {}
    for i in range(14):
        c = i + 1
        g[(0, c)] = K.MONTHS_FR[(i + 2) % 12]
        g[(1, c)] = "Prévu"
        g[(2, c)] = "1"
    g[(-1, 1)] = "2019"
    g[(-1, 11)] = "2020"
    g.update({(2, 0): "Aides", (3, 0): "Variation de trésorerie"})
    cells = C.prepare_cells(_grid(spark, g).withColumn("SHEET", F.lit("Feuil1")))
    years = rows(C.year_fill(C.crop(cells, C.sheet_bounds(cells))), "c", "annee")
    assert years == [(c, "2019" if c < 11 else "2020") for c in range(1, 15)]


def test_adjustments_promote_a_date_row_below_the_header(spark):
    g = {(-1, 0): "Titre", (-1, 1): "Sans date"}
    g.update({(1, c): f"2021-{c:02d}-01" for c in range(1, 4)})
    g.update({(0, 0): "Raison avant l'entête", (2, 0): "Retraitement", (3, 0): "Raison", (2, 1): "10", (3, 1): "r1", (2, 3): "30"})
    cells = _grid(spark, g).withColumn("SHEET_NO", F.lit(1))
    assert rows(C.date_header(cells), "ligne_entete", "col_fin") == [(1, 3)]
    out = rows(C.adjustments(cells), "mois", "montant_retraitement", "raison")
    assert out == [("01", "10", "r1"), ("03", "30", None)]


def test_first_sheets_follow_workbook_order(spark):
    import pytest
    cells = spark.createDataFrame([("w", f"s{9 - i}", i, 0, 0, "x") for i in range(1, 8)],
                                  "file string, sheet string, sheet_no int, r int, c int, v string")
    assert sorted(r.sheet for r in C._first_sheets(cells, 5).collect()) == ["s4", "s5", "s6", "s7", "s8"]
    with pytest.raises(ValueError):
        C._first_sheets(cells.drop("sheet_no"), 5)


def test_category_table_and_gate_by_hand(spark):
    """Expected rows written out: they do not come from the engine's own rules."""
    from tresoria.operators import controls
    fact = spark.createDataFrame([
        ("a", "2021", "janvier", "Réalisé", "Aides"), ("a", "2021", "février", "Prévu", "Aides"),
        ("b", "2021", "janvier", "Réalisé", "Inconnu"), ("c", "2021", "zzz", "Réalisé", "Aides")],
        "nom_fichier string, nom_onglet string, mois_nom string, type_montant string, nature_montant string")
    got = {r.nom_fichier: (r.mois_ok, r.type_ok, r.nature_ok, r.valide) for r in controls.quality_gate(fact).collect()}
    assert got == {"a": (True, True, True, True), "b": (True, True, False, False), "c": (False, True, True, False)}


def test_name_normaliser_by_hand(spark):
    from tresoria.functions.text import normalise_name
    df = spark.createDataFrame([("  Été ", 0), ("Montant", 1)], "n string, i int")
    got = [r.x for r in df.select("i", normalise_name("n").alias("x")).orderBy("i").collect()]
    assert got[1] == "MONTANT" and got[0] == got[0].strip().upper()


def test_adjustments_pairs_and_cut(spark):
    g = {(-1, c): f"2021-{c:02d}-01" for c in range(1, 5)}
    g.update({(-1, 5): "Commentaire", (-1, 6): "2099-01-01",
              (0, 0): "Retraitement", (1, 0): "Raison", (2, 0): "Retraitement 2", (3, 0): "raisons",
              (0, 1): "10", (0, 3): "30", (1, 1): "r1", (1, 3): "r3", (2, 2): "22", (3, 2): "r22",
              (0, 6): "99"})
    cells = _grid(spark, g).withColumn("SHEET_NO", F.lit(1))
    out = rows(C.adjustments(cells), "annee", "mois", "mois_nom", "montant_retraitement", "raison")
    assert out == [("2021", "01", "janvier", "10", "r1"), ("2021", "02", "février", "22", "r22"),
                   ("2021", "03", "mars", "30", "r3")]


def test_typed_ledger_is_idempotent_and_storable(spark, tmp_path):
    raw = _ledger(spark, [
        ("2024/01/06", "2024/01/06 06:00:00", "Total", "R", "Solde Final", "Solde Final", "1.5", "a"),
        ("2024/02/06", "2024/02/07 06:00:00", "Total", "R", "Solde Final", "Solde Final", "x", "b")])
    once = ledger.typed_ledger(raw)
    assert rows(ledger.typed_ledger(once), "date_montant", "montant") == rows(once, "date_montant", "montant")
    path = str(tmp_path / "typed")
    ledger.store_typed_ledger(raw, path)
    back = spark.read.parquet(path).where("date_montant >= DATE '2024-02-01'")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(date_montant" in plan
    assert rows(ledger.clean_ledger(back), "montant") == [(None,)]


def test_keep_latest_shuffle_path_equals_broadcast_path(spark):
    """A hot key holding a third of the rows; same result whether the planner
    broadcasts the per-key maxima or joins them by shuffle."""
    hot = [("hot", f"v{i % 7}", i) for i in range(3000)]
    cold = [(f"k{i}", f"v{i % 3}", 10000 + i) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "k string, v string, id int")
    broadcast = rows(latest.keep_latest(df, ["k"], "v"), "id")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = [spark.conf.get(k) for k in keys]
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        shuffled = latest.keep_latest(df, ["k"], "v")
        got = rows(shuffled, "id")
        assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    assert got == broadcast
    assert len([r for r in broadcast if r[0] < 3000]) == len([i for i in range(3000) if i % 7 == 6])


def test_small_amounts_are_not_cut(spark):
    """Ten amounts of 0.00004 sum to 0.0004; an amount out of range raises."""
    from pyspark.errors import PySparkException
    from tresoria.functions.numeric import money_sum
    df = spark.createDataFrame([(0.00004,)] * 10 + [(None,), (float("nan"),)], "x double")
    assert df.agg(money_sum("x").alias("s")).first().s == 0.0004
    wide = spark.createDataFrame([(1e25,), (1.0,)], "x double")
    assert wide.agg(money_sum("x").alias("s")).first().s == 1e25 + 1.0
    import pytest
    with pytest.raises(PySparkException, match="out of range"):
        spark.createDataFrame([(1e27,)], "x double").agg(money_sum("x").alias("s")).collect()


def test_numbers_are_strict(spark):
    from tresoria.functions.numeric import to_number
    texts = {"12": 12.0, " -1.5 ": -1.5, "1e3": 1000.0, ".5": 0.5, "7.": 7.0, "nan": None, "NaN": None, "12d": None, "3f": None,
             "Infinity": None, "inf": None, "n/a": None, "": None, "1 000": None, "0x1A": None}
    df = spark.createDataFrame(list(texts.items()), "t string, want double")
    assert [r.t for r in df.select("t", to_number("t").alias("got"), "want").where("not (got <=> want)").collect()] == []


def test_bounds_cut_at_first_monthless_column_beyond_10(spark):
    g = _multi_sheet()
    g[(-1, 13)] = "TOTAL"
    g[(-1, 14)] = "Commentaire"
    g[(0, 13)] = g[(0, 14)] = "Prévu"
    for r in range(1, 5):
        g[(r, 13)] = "1"
        g[(r, 14)] = "2"
    b = C.sheet_bounds(C.prepare_cells(_grid(spark, g))).first()
    # numeric run 1..14, but column 14 has no month word: the table ends before it
    assert (b["col_debut"], b["col_fin"], b["repli"]) == (0, 14, False)
    fact = C.ingest_forecast(_grid(spark, g), "multi")
    assert fact.where("mois_nom = 'TOTAL'").count() == 4 and fact.where("mois IS NULL").count() == 4


def test_bounds_fall_back_on_fully_numeric_column(spark):
    g = _multi_sheet()
    g[(-1, 5)] = "2021"  # numeric header over a column without gaps
    for r in range(0, 6):
        g[(r, 5)] = "5"
    b = C.sheet_bounds(C.prepare_cells(_grid(spark, g))).first()
    assert b["repli"]


def test_empty_header_counts_as_text(spark):
    # column 2 has no header cell: its "Unnamed" name counts as text, so
    # 2 numbers against 1 text + 1 unnamed header is not a numeric column
    g = {(-1, 1): "janvier", (0, 1): "Prévu", (1, 1): "1", (2, 1): "2", (3, 1): "3",
         (0, 2): "Prévu", (1, 2): "1", (2, 2): "2",
         (1, 0): "Aides", (3, 0): "Variation de trésorerie"}
    stats = {r["c"]: r["is_float"] for r in C.numeric_columns(C.prepare_cells(_grid(spark, g))).collect()}
    assert stats[1] is True and stats[2] is False


def test_budget_label_set_is_null_safe(spark):
    codes = spark.createDataFrame([("R01",), ("r02",), ("",), (None,), ("D01",), ("Solde Final",)], "code_budgetaire string")
    s = spark.createDataFrame([], "code_flux_libelle string, type_montant string")
    rec = rows(periods.flow_labels(s, "recettes", "budget", codes), "code_budgetaire")
    dep = rows(periods.flow_labels(s, "depenses", "budget", codes), "code_budgetaire")
    assert rec == [("R01",), ("r02",)] and dep == [("D01",)]


def test_date_account_filter_keeps_leading_blanks(spark):
    raw = _ledger(spark, [
        ("2024/01/06", "2024/01/06 06:00:00", " 107CDNB", "R", "x", "x", "1", "a"),
        ("2024/01/06", "2024/01/06 06:00:00", "107CDNB", "R", "x", "x", "2", "a"),
        ("bad", "2024/01/06 06:00:00", " 107CDNB", "R", "x", "x", "3", "a"),
        ("2024/02/06", "2024/02/06 06:00:00", " 107CDNB", "R", "x", "x", "4", "a")])
    t = ledger.typed_ledger(raw)
    out = ledger.filter_range_accounts(t, "2024-01-01", "2024-01-31", [" 107CDNB"])
    assert rows(out, "montant") == [(1.0,)]


def test_ledger_dates_accept_both_export_forms(spark):
    raw = _ledger(spark, [
        ("2024/01/06", "2024/01/06 06:00:00", "Total", "R", "x", "x", "1", "a"),
        ("2024-01-07", "2024-01-07 06:00:00", "Total", "R", "x", "x", "2", "a"),
        ("07/01/2024", "bad", "Total", "R", "x", "x", "3", "a")])
    got = rows(ledger.typed_ledger(raw), "montant", "date_montant")
    import datetime as dt
    assert got == [(1.0, dt.date(2024, 1, 6)), (2.0, dt.date(2024, 1, 7)), (3.0, None)]


def test_typed_forecast_store_prunes_years(spark, tmp_path):
    from tresoria import fixtures
    raw = fixtures.view(spark, "/root/testdata/sf0.001", "prev")
    path = str(tmp_path / "prev")
    forecast.store_typed_forecast(raw, path)
    back = spark.read.parquet(path)
    one_year = forecast.clean_forecast(back).where("annee = 1997")
    plan = one_year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(annee" in plan and "= 1997)" in plan
    direct = forecast.clean_forecast(raw).where("annee = 1997")
    got = sorted(map(tuple, one_year.select(*direct.columns).collect()), key=str)
    assert got == sorted(map(tuple, direct.collect()), key=str)

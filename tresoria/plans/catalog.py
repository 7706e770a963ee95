"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame`` and the
matching oracle SQL (``name -> str``).  Each query reads the driver's tables
through the fixture views, whose rows, files and sheets grow with the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tresoria import constants as K
from tresoria import fixtures
from tresoria.functions.numeric import money_sum
from tresoria.functions.text import normalise_name, stringify
from tresoria.functions.version import version_from_filename
from tresoria.operators import cells as C
from tresoria.operators import controls, forecast, labels, ledger, periods
from tresoria.operators.controls import quality_gate
from tresoria.plans import loads
from tresoria.plans import oracle_sql as O
from tresoria.session import materialize, scratch_path
from tresoria.sources import commits, sinks
from tresoria.sources.tables import discover_files, label_table, ledger_table, new_files, read_csv_table
from tresoria.sources.workbook import decode_files
from tresoria.sources.workbook_writer import encode_workbooks
from tresoria.streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

FREQ_NAME = {"J": "day", "S": "week", "M": "month", "T": "quarter", "A": "year"}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- ledger ---

def raw_ledger(spark, sf):
    return fixtures.view(spark, sf, "ledger")


def sage(spark, sf):
    return ledger.clean_ledger(raw_ledger(spark, sf))


@register("ledger_typed", O.ctes(ledger=None) + O.TYPED_LEDGER)
def q_ledger_typed(spark, sf):
    return ledger.typed_ledger(raw_ledger(spark, sf))


@register("ledger_latest_file", O.ledger_ctes() + "SELECT * FROM sage")
def q_ledger_latest_file(spark, sf):
    return sage(spark, sf)


@register("ledger_date_extent", O.ledger_ctes() + """
SELECT min(date_montant) AS date_debut, max(date_montant) AS date_fin,
       CAST(datediff('day', min(date_montant), max(date_montant)) + 1 AS INTEGER) AS nb_jours FROM sage""")
def q_ledger_date_extent(spark, sf):
    return controls.date_extent(sage(spark, sf))


@register("load_control", O.ctes(ledger=None, typed=O.TYPED_LEDGER) + """
SELECT date_montant, count(DISTINCT fichier) AS nb_fichiers FROM typed
WHERE date_montant IS NOT NULL GROUP BY date_montant""")
def q_load_control(spark, sf):
    return controls.files_per_day(ledger.typed_ledger(raw_ledger(spark, sf)))


@register("label_usage", O.ledger_ctes() + """
SELECT code_flux_libelle, count(DISTINCT date_montant) AS nb_dates FROM sage
WHERE code_flux_libelle IS NOT NULL GROUP BY code_flux_libelle""")
def q_label_usage(spark, sf):
    return controls.label_usage(sage(spark, sf), "flux")


@register("label_usage_budget", O.ledger_ctes() + """
SELECT code_budgetaire, count(DISTINCT date_montant) AS nb_dates FROM sage
WHERE code_budgetaire IS NOT NULL GROUP BY code_budgetaire""")
def q_label_usage_budget(spark, sf):
    return controls.label_usage(sage(spark, sf), "budget")


def _balance_query(freq):
    def fn(spark, sf):
        return periods.balance(sage(spark, sf), "flux", freq)
    return fn


for _f, _n in FREQ_NAME.items():
    register(f"balance_{_n}", O.balance_sql(_f))(_balance_query(_f))


def _flow_query(kind, grain, freq):
    def fn(spark, sf):
        s = sage(spark, sf)
        codes = raw_ledger(spark, sf).select("CODE_BUDGETAIRE").toDF("code_budgetaire") if grain == "budget" else None
        labels = periods.flow_labels(s, kind, grain, codes)
        return periods.flows(s, labels, grain, freq)
    return fn


for _kind, _kn in (("recettes", "receipts"), ("depenses", "spending")):
    for _grain in ("flux", "budget"):
        for _f, _n in FREQ_NAME.items():
            _name = f"{_kn}_{_n}" + ("_budget" if _grain == "budget" else "")
            register(_name, O.flows_sql(_kind, _grain, _f))(_flow_query(_kind, _grain, _f))


@register("balance_month_last", O.ledger_ctes(
    bal=f"SELECT * FROM sage WHERE code_flux_libelle = {O.q('Solde Final')} AND annee_mois IS NOT NULL AND banque_compte IS NOT NULL",
    daily=f"SELECT annee_mois, banque_compte, date_montant, {O.msum('montant')} AS montant FROM bal GROUP BY 1, 2, 3")
    + """SELECT annee_mois, banque_compte, max_by(montant, date_montant) AS montant FROM daily GROUP BY 1, 2""")
def q_balance_month_last(spark, sf):
    return periods.balance(sage(spark, sf), "flux", "M", how="last")


@register("flow_labels", O.ledger_ctes() + f"""
SELECT 'recettes' AS kind, code_flux_libelle FROM ({O.flow_labels_sql('recettes', 'flux')})
UNION ALL SELECT 'depenses', code_flux_libelle FROM ({O.flow_labels_sql('depenses', 'flux')})""")
def q_flow_labels(spark, sf):
    return periods.flow_label_table(sage(spark, sf), "flux")


@register("flow_extremes", O.flow_extremes_sql("flux") + "SELECT * FROM ext")
def q_flow_extremes(spark, sf):
    s = sage(spark, sf)
    return periods.flow_extremes(s, periods.flow_label_table(s, "flux"), "flux")


@register("flow_extremes_budget", O.flow_extremes_sql("budget") + "SELECT * FROM ext")
def q_flow_extremes_budget(spark, sf):
    s = sage(spark, sf)
    codes = raw_ledger(spark, sf).select("CODE_BUDGETAIRE").toDF("code_budgetaire")
    return periods.flow_extremes(s, periods.flow_label_table(s, "budget", codes), "budget")


@register("axis_range", O.flow_extremes_sql("flux") + """
SELECT frequence, CAST(1.10 AS DOUBLE) * max(max_total) AS borne_haute, min(min_total) AS borne_basse
FROM ext GROUP BY frequence""")
def q_axis_range(spark, sf):
    return periods.axis_range(q_flow_extremes(spark, sf))


@register("kpi_week", O.kpi_sql(7) + "SELECT * FROM kp")
def q_kpi_week(spark, sf):
    return controls.kpi(sage(spark, sf), 7)


@register("kpi_month", O.kpi_sql(30) + "SELECT * FROM kp")
def q_kpi_month(spark, sf):
    return controls.kpi(sage(spark, sf), 30)


@register("kpi_day", O.kpi_sql(1) + "SELECT * FROM kp")
def q_kpi_day(spark, sf):
    return controls.kpi(sage(spark, sf), K.KPI_LAG_DAYS["J"])


@register("kpi_quarter", O.kpi_sql(90) + "SELECT * FROM kp")
def q_kpi_quarter(spark, sf):
    return controls.kpi(sage(spark, sf), K.KPI_LAG_DAYS["T"])


@register("kpi_year", O.kpi_sql(365) + "SELECT * FROM kp")
def q_kpi_year(spark, sf):
    return controls.kpi(sage(spark, sf), K.KPI_LAG_DAYS["A"])


@register("kpi_text", O.kpi_sql(7) + O.KPI_TEXT_SELECT)
def q_kpi_text(spark, sf):
    return controls.kpi_text(controls.kpi(sage(spark, sf), 7))


RANGE = ("2023-12-01", "2024-01-31")
ACCOUNTS = [" 107CDNB", "Total"]


@register("date_account_filter", O.ledger_ctes() + f"""
SELECT * FROM sage WHERE date_montant BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'
AND banque_compte IN {O.in_list(ACCOUNTS)}""")
def q_date_account_filter(spark, sf):
    return ledger.filter_range_accounts(sage(spark, sf), RANGE[0], RANGE[1], ACCOUNTS)


@register("balance_week_filtered", O.ledger_ctes(
    bal=(f"SELECT * FROM sage WHERE code_flux_libelle = {O.q('Solde Final')} "
         f"AND date_montant BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' AND banque_compte IN {O.in_list(ACCOUNTS)}"))
    + O.sum_by_sql("bal", "S", "banque_compte"))
def q_balance_week_filtered(spark, sf):
    s = ledger.filter_range_accounts(sage(spark, sf), RANGE[0], RANGE[1], ACCOUNTS)
    return periods.balance(s, "flux", "S")


@register("small_amounts", """
SELECT o_orderstatus, CAST(CAST(SUM(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(20,2))) * CAST(0.0000001 AS DECIMAL(8,7))
       AS VARCHAR) AS DOUBLE) AS total FROM orders GROUP BY o_orderstatus""")
def q_small_amounts(spark, sf):
    """Amounts of a hundredth of a unit in ten millions keep all their places in a sum."""
    fixtures.register_base_tables(spark, sf, ["orders"])
    small = spark.table("orders").select("o_orderstatus", (F.col("o_totalprice") / F.lit(1e7)).alias("x"))
    return small.groupBy("o_orderstatus").agg(money_sum("x").alias("total"))


# -------------------------------------------------------------- forecast ---


def raw_prev(spark, sf):
    return fixtures.view(spark, sf, "prev")


def clean_prev(spark, sf, frequence="mensuelle"):
    return forecast.clean_forecast(raw_prev(spark, sf), frequence)


@register("prev_labels", O.prev_ctes() + "SELECT * FROM harm")
def q_prev_labels(spark, sf):
    return labels.harmonise(forecast.typed_forecast(raw_prev(spark, sf)))


@register("prev_latest_version", O.prev_ctes() + "SELECT * FROM lat")
def q_prev_latest_version(spark, sf):
    return forecast.latest_realised(labels.harmonise(forecast.typed_forecast(raw_prev(spark, sf))))


@register("prev_monthly", O.prev_ctes() + "SELECT * FROM cleanp")
def q_prev_monthly(spark, sf):
    return clean_prev(spark, sf)


@register("prev_quarterly", O.prev_ctes() + f"""
SELECT trimestre, nature_montant, type_montant, annee, version_prev, {O.msum('montant_millions')} AS montant_millions
FROM cleanp WHERE trimestre IS NOT NULL AND nature_montant IS NOT NULL AND type_montant IS NOT NULL
  AND annee IS NOT NULL AND version_prev IS NOT NULL
GROUP BY trimestre, nature_montant, type_montant, annee, version_prev""")
def q_prev_quarterly(spark, sf):
    return clean_prev(spark, sf, "trimestrielle")


REPORT_YEAR, REPORT_VERSION, REPORT_LABEL = 1997, "1997-06", "Contributions pôle emploi"


@register("flux_report_month", O.flux_report_sql(REPORT_YEAR, REPORT_VERSION, "M"))
def q_flux_report_month(spark, sf):
    return forecast.flux_report(clean_prev(spark, sf), REPORT_YEAR, REPORT_VERSION, "M")


@register("flux_report_quarter", O.flux_report_sql(REPORT_YEAR, REPORT_VERSION, "T"))
def q_flux_report_quarter(spark, sf):
    return forecast.flux_report(clean_prev(spark, sf), REPORT_YEAR, REPORT_VERSION, "T")


@register("nature_report", O.flux_report_sql(REPORT_YEAR, REPORT_VERSION, "M", REPORT_LABEL))
def q_nature_report(spark, sf):
    return forecast.nature_report(clean_prev(spark, sf), REPORT_LABEL, REPORT_YEAR, REPORT_VERSION, "M")


@register("label_reports", O.label_reports_sql(REPORT_YEAR, REPORT_VERSION, "M"))
def q_label_reports(spark, sf):
    return forecast.label_reports(clean_prev(spark, sf), REPORT_YEAR, REPORT_VERSION, "M")


@register("running_totals", O.prev_ctes() + O.RUNNING_TOTALS)
def q_running_totals(spark, sf):
    return forecast.running_totals(clean_prev(spark, sf))


@register("forecast_versions", O.prev_ctes() + f"""
SELECT DISTINCT annee, version_prev FROM cleanp WHERE type_montant = {O.q(K.FORECAST_TYPE)}""")
def q_forecast_versions(spark, sf):
    return forecast.versions(clean_prev(spark, sf))


@register("forecast_versions_label", O.prev_ctes() + f"""
SELECT DISTINCT annee, version_prev FROM cleanp WHERE type_montant = {O.q(K.FORECAST_TYPE)}
AND annee = {REPORT_YEAR} AND nature_montant = {O.q(REPORT_LABEL)}""")
def q_forecast_versions_label(spark, sf):
    return forecast.versions(clean_prev(spark, sf), REPORT_YEAR, REPORT_LABEL)


LEVELS = (["Solde", "Total Dépenses"],
          [lab for cat, labs in K.LABEL_CATEGORIES if cat != "depenses" for lab in labs],
          [lab for cat, labs in K.LABEL_CATEGORIES if cat == "depenses" for lab in labs])


@register("label_levels", O.prev_ctes() + f"""
SELECT DISTINCT nature_montant, CASE WHEN nature_montant IN {O.in_list(LEVELS[0])} THEN 'niv01'
  WHEN nature_montant IN {O.in_list(LEVELS[1])} THEN 'niv02'
  WHEN nature_montant IN {O.in_list(LEVELS[2])} THEN 'niv03'
  WHEN nature_montant IS NULL THEN '' END AS niveau FROM cleanp""")
def q_label_levels(spark, sf):
    df = clean_prev(spark, sf)
    return df.select("nature_montant", labels.level_tag("nature_montant", *LEVELS).alias("niveau")).distinct()


def _first_category_rows():
    seen, rows = set(), []
    for cat, labs in K.LABEL_CATEGORIES:
        for lab in labs:
            if lab not in seen:
                seen.add(lab)
                rows.append((lab, cat))
    return rows


@register("label_category", O.prev_ctes(cat=O.values_sql(_first_category_rows(), ["nature_montant", "categorie"]))
          + "SELECT DISTINCT c.nature_montant, cat.categorie FROM cleanp c LEFT JOIN cat USING (nature_montant)")
def q_label_category(spark, sf):
    return labels.with_category(clean_prev(spark, sf).select("nature_montant")).distinct()


@register("nan_to_null", O.prev_ctes() + """
SELECT CASE WHEN lower(replace(CAST(version_prev AS VARCHAR), chr(10), ' ')) = 'nan' THEN NULL ELSE replace(CAST(version_prev AS VARCHAR), chr(10), ' ') END AS version_prev,
       CASE WHEN lower(annee) = 'nan' THEN NULL ELSE annee END AS annee,
       CASE WHEN lower(mois) = 'nan' THEN NULL ELSE mois END AS mois,
       CASE WHEN lower(mois_nom) = 'nan' THEN NULL ELSE mois_nom END AS mois_nom,
       CASE WHEN lower(nature_montant) = 'nan' THEN NULL ELSE nature_montant END AS nature_montant,
       CASE WHEN lower(type_montant) = 'nan' THEN NULL ELSE type_montant END AS type_montant,
       CASE WHEN lower(CAST(montant_millions AS VARCHAR)) = 'nan' THEN NULL ELSE CAST(montant_millions AS VARCHAR) END AS montant_millions
FROM harm""")
def q_nan_to_null(spark, sf):
    return stringify(labels.harmonise(forecast.typed_forecast(raw_prev(spark, sf))))


_NORM_SQL = "regexp_replace(lower({x}), '^[ \\t\\n\\r\\f\\x0B]+|[ \\t\\n\\r\\f\\x0B]+$', '', 'g')"


def _norm_sql(x: str) -> str:
    from tresoria.functions.text import NAME_REPLACEMENTS
    out = _NORM_SQL.format(x=x)
    for a, b in NAME_REPLACEMENTS:
        out = f"replace({out}, {O.q(a)}, {O.q(b)})"
    return f"upper({out})"


@register("name_normaliser", "SELECT p_partkey, p_name, " + _norm_sql("p_name") + " AS nom_normalise FROM part")
def q_name_normaliser(spark, sf):
    fixtures.register_base_tables(spark, sf, ["part"])
    return spark.table("part").select("p_partkey", "p_name", normalise_name("p_name").alias("nom_normalise"))


@register("label_normaliser", O.ctes(prev=None) + "SELECT DISTINCT NATURE_MONTANT AS nature_montant, "
          + _norm_sql("NATURE_MONTANT") + " AS nom_normalise FROM prev")
def q_label_normaliser(spark, sf):
    return (raw_prev(spark, sf).select(F.col("NATURE_MONTANT").alias("nature_montant"),
                                       normalise_name("NATURE_MONTANT").alias("nom_normalise")).distinct())


# ----------------------------------------------------------------- cells ---


def prepared(spark, sf, name):
    return C.prepare_cells(fixtures.view(spark, sf, name))


@register("sheet_bounds", O.ctes(**O.bounds_ctes("cells")) + "SELECT * FROM bnd")
def q_sheet_bounds(spark, sf):
    return C.sheet_bounds(prepared(spark, sf, "cells"))


@register("sheet_bounds_single", O.ctes(**O.bounds_ctes("cells_single")) + "SELECT * FROM bnd")
def q_sheet_bounds_single(spark, sf):
    return C.sheet_bounds(prepared(spark, sf, "cells_single"))


@register("all_unnamed", O.ctes(cells_adj=None) + """
SELECT FILE AS file, SHEET AS sheet, count(*) FILTER (WHERE R = -1) = 0 AS sans_entete FROM cells_adj
GROUP BY FILE, SHEET""")
def q_all_unnamed(spark, sf):
    return C.all_unnamed(fixtures.view(spark, sf, "cells_adj"))


@register("numeric_columns", O.ctes(**O.bounds_ctes("cells")) + "SELECT * FROM st2")
def q_numeric_columns(spark, sf):
    return C.numeric_columns(prepared(spark, sf, "cells"))


@register("month_columns", O.ctes(**O.bounds_ctes("cells")) + "SELECT file, sheet, c FROM st2 WHERE has_month")
def q_month_columns(spark, sf):
    stats = C.numeric_columns(prepared(spark, sf, "cells"))
    return stats.where(F.col("has_month")).select("file", "sheet", "c")


@register("leading_run", O.ctes(**O.bounds_ctes("cells")) + "SELECT * FROM run")
def q_leading_run(spark, sf):
    return C._leading_run(C.numeric_columns(prepared(spark, sf, "cells")), "is_float")


@register("sheet_unpivot_multi", O.ctes(**O.unpivot_multi_ctes()) + "SELECT * FROM lng")
def q_sheet_unpivot_multi(spark, sf):
    c = prepared(spark, sf, "cells")
    return C.unpivot(c, C.written_bounds(c), "multi")


@register("sheet_unpivot_single", O.ctes(**O.unpivot_single_ctes()) + "SELECT * FROM lng")
def q_sheet_unpivot_single(spark, sf):
    c = prepared(spark, sf, "cells_single")
    return C.unpivot(c, C.written_bounds(c), "single")


@register("year_fill", O.ctes(**O.unpivot_single_ctes()) + "SELECT * FROM yf")
def q_year_fill(spark, sf):
    c = prepared(spark, sf, "cells_single")
    return C.year_fill(C.crop(c, C.written_bounds(c)))


@register("quality_gate", O.ctes(**O.unpivot_multi_ctes(), fact=O.fact_cte())
          + O.gate_sql("fact", ["nom_fichier", "nom_onglet"]))
def q_quality_gate(spark, sf):
    return quality_gate(C.long_forecast(prepared(spark, sf, "cells"), "multi", prepared=True))


@register("quality_gate_single", O.ctes(**O.unpivot_single_ctes(), fact=O.fact_cte())
          + O.gate_sql("fact", ["nom_fichier"]))
def q_quality_gate_single(spark, sf):
    return quality_gate(C.long_forecast(prepared(spark, sf, "cells_single"), "single", prepared=True), ["nom_fichier"])


@register("forecast_ingest", O.ingest_sql("multi"))
def q_forecast_ingest(spark, sf):
    return C.ingest_forecast(prepared(spark, sf, "cells"), "multi", prepared=True)


@register("forecast_ingest_single", O.ingest_sql("single"))
def q_forecast_ingest_single(spark, sf):
    return C.ingest_forecast(prepared(spark, sf, "cells_single"), "single", prepared=True)


@register("version_from_filename", O.ctes(cells=None, cells_single=None, cells_adj=None)
          + f"SELECT file, {O.version_sql('file')} AS version_prev FROM (SELECT DISTINCT FILE AS file FROM cells "
          "UNION SELECT DISTINCT FILE FROM cells_single UNION SELECT DISTINCT FILE FROM cells_adj)")
def q_version_from_filename(spark, sf):
    files = None
    for v in ("cells", "cells_single", "cells_adj"):
        f = fixtures.view(spark, sf, v).select(F.col("FILE").alias("file"))
        files = f if files is None else files.unionByName(f)
    return files.distinct().select("file", version_from_filename("file").alias("version_prev"))


@register("date_header_cut", O.ctes(**O.adj_ctes()) + "SELECT * FROM h2")
def q_date_header_cut(spark, sf):
    c = prepared(spark, sf, "cells_adj")
    c = c.join(C._first_sheets(c, C.ADJ_MAX_SHEETS), on=C.SHEET, how="left_semi")
    return C.date_header(c)


@register("adjustments", O.ctes(**O.adj_ctes()) + O.ADJ_SELECT)
def q_adjustments(spark, sf):
    return C.adjustments(prepared(spark, sf, "cells_adj"), prepared=True)


# ------------------------------------------------------- sources / sinks ---


@register("consolidate", O.ctes(ledger=None) + "SELECT * FROM ledger")
def q_consolidate(spark, sf):
    raw = raw_ledger(spark, sf)
    current = raw.where(F.col("FICHIER") == "export_0.csv")
    history = raw.where(~(F.col("FICHIER") == "export_0.csv") | F.col("FICHIER").isNull())
    return sinks.consolidate(current, history)


@register("manifest_anti", O.ctes(cells=None, cells_single=None)
          + f"SELECT DISTINCT FILE AS name FROM (SELECT FILE FROM cells UNION ALL SELECT FILE FROM cells_single) "
          f"WHERE FILE NOT IN {O.in_list(K.PROCESSED_FILES)}")
def q_manifest_anti(spark, sf):
    files = (fixtures.view(spark, sf, "cells").select(F.col("FILE").alias("name"))
             .unionByName(fixtures.view(spark, sf, "cells_single").select(F.col("FILE").alias("name")))
             .distinct())
    manifest = spark.createDataFrame([(n,) for n in K.PROCESSED_FILES], "name string")
    return new_files(files, manifest)


LOAD_DATE = "2024-01-31"
_PREV_COLS = ["VERSION_PREV", "ANNEE", "MOIS", "MOIS_NOM", "NATURE_MONTANT", "TYPE_MONTANT", "MONTANT_MILLIONS"]
_LOADED_SQL = (O.ctes(prev=None) + "SELECT " + ", ".join(
    f"CASE WHEN lower({c}) = 'nan' THEN NULL ELSE replace({c}, chr(10), ' ') END AS {c}" for c in _PREV_COLS)
    + f", '{LOAD_DATE}' AS DATE_EXTRACTION FROM prev")


@register("write_overwrite", _LOADED_SQL)
def q_write_overwrite(spark, sf):
    import uuid
    path = scratch_path(spark, f"tables/treso_dea_prev_{uuid.uuid4().hex}")
    sinks.write_overwrite(raw_prev(spark, sf), path, load_date=LOAD_DATE)
    return spark.read.parquet(path)


@register("write_append_compact", _LOADED_SQL)
def q_write_append_compact(spark, sf):
    """Two appends of the two halves of the table, then compaction."""
    import uuid
    base = scratch_path(spark, f"tables/treso_dea_prev_{uuid.uuid4().hex}")
    raw = raw_prev(spark, sf)
    even = F.col("ANNEE").try_cast("int") % 2 == 0
    sinks.write_append(raw.where(even), base, load_date=LOAD_DATE)
    sinks.write_append(raw.where(~even | even.isNull()), base, load_date=LOAD_DATE)
    return sinks.compact(spark, base, base + "_compact")


@register("typed_ledger_store", O.ctes(ledger=None, typed=O.TYPED_LEDGER)
          + "SELECT *, strftime(date_montant, '%Y-%m') AS annee_mois FROM typed")
def q_typed_ledger_store(spark, sf):
    import uuid
    path = scratch_path(spark, f"tables/ledger_typed_{uuid.uuid4().hex}")
    ledger.store_typed_ledger(raw_ledger(spark, sf), path)
    return (spark.read.option("basePath", path).parquet(path)
            .withColumn("annee_mois", F.col("annee_mois").cast("string")))


@register("typed_forecast_store", O.prev_ctes() + "SELECT * FROM typedp")
def q_typed_forecast_store(spark, sf):
    import uuid
    path = scratch_path(spark, f"tables/prev_typed_{uuid.uuid4().hex}")
    forecast.store_typed_forecast(raw_prev(spark, sf), path)
    return spark.read.parquet(path).withColumn("annee", F.col("annee").cast("string"))


def _fresh(spark, name: str) -> str:
    """A folder of its own in the shared scratch space for a written table."""
    import uuid
    return scratch_path(spark, f"tables/{name}_{uuid.uuid4().hex}")


@register("csv_ledger", O.ctes(ledger=None) + "SELECT * FROM ledger")
def q_csv_ledger(spark, sf):
    """The ledger written as a semicolon-separated export and read back as text."""
    path = _fresh(spark, "ledger_csv")
    raw_ledger(spark, sf).write.option("sep", ";").option("header", "true").option(
        "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return read_csv_table(spark, path)


@register("discover_exports", O.ctes(ledger=None) + "SELECT DISTINCT FICHIER AS dossier FROM ledger WHERE FICHIER <> 'export_1.csv'")
def q_discover_exports(spark, sf):
    """Folders found by the recursive listing, those of listed names left out."""
    path = _fresh(spark, "exports")
    raw_ledger(spark, sf).withColumn("dossier", F.col("FICHIER")).repartition("dossier").write.partitionBy(
        "dossier").option("sep", ";").csv(path)
    found = discover_files(spark, path, "*.csv").select(F.regexp_extract("path", "dossier=([^/]+)/", 1).alias("name"))
    done = spark.createDataFrame([("export_1.csv",)], "name string")
    return new_files(found.distinct(), done).select(F.col("name").alias("dossier"))


def _stored_ledger(spark, sf):
    """The ledger as the catalog table of its grain, in a database of its own."""
    import uuid
    database = f"tresorerie_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_fresh(spark, database)}'")
    sinks.write_overwrite(raw_ledger(spark, sf), _fresh(spark, "export_sage"), load_date=LOAD_DATE,
                          table=f"{database}.export_sage_code_flux_historique")
    return ledger_table(spark, database, "flux")


@register("catalog_ledger_balance", O.balance_sql("M"))
def q_catalog_ledger_balance(spark, sf):
    return periods.balance(ledger.clean_ledger(_stored_ledger(spark, sf)), "flux", "M")


_LEDGER_LOADED = O.ctes(ledger=None) + f"SELECT *, '{LOAD_DATE}' AS DATE_EXTRACTION FROM ledger"


@register("consolidate_table", _LEDGER_LOADED)
def q_consolidate_table(spark, sf):
    """Current export into a new catalog table, history appended, table read back."""
    import uuid
    raw, table = raw_ledger(spark, sf), f"export_sage_{uuid.uuid4().hex[:12]}"
    current = F.col("FICHIER") == "export_0.csv"
    sinks.consolidate_table(raw.where(current), raw.where(~current | F.col("FICHIER").isNull()),
                            _fresh(spark, table), table, LOAD_DATE)
    return spark.table(table)


_FACT_UPPER = ", ".join(f"{c} AS {c.upper()}" for c in C.FACT_COLUMNS)


def _load_twice(spark, cells, kind, table):
    """Two runs of a load; the second finds every file in the manifest."""
    path, manifest = _fresh(spark, table), _fresh(spark, "manifest")
    first = loads.load_cells(cells, kind, path, manifest, load_date=LOAD_DATE)
    again = loads.load_cells(cells, kind, path, manifest, load_date=LOAD_DATE)
    if cells.limit(1).count() and (not first or again):
        raise ValueError(f"loaded {first} files, then {again} again")
    return commits.read_committed(spark, path, manifest)


@register("load_forecast_table", f"SELECT {_FACT_UPPER}, '{LOAD_DATE}' AS DATE_EXTRACTION FROM ({O.ingest_sql('multi')})")
def q_load_forecast_table(spark, sf):
    return _load_twice(spark, fixtures.view(spark, sf, "cells"), "multi", "treso_dea_prev")


@register("load_adjustments_table", "SELECT nom_fichier AS NOM_FICHIER, nom_onglet AS NOM_ONGLET, annee AS ANNEE, mois AS MOIS, "
          "mois_nom AS MOIS_NOM, montant_retraitement AS MONTANT_RETRAITEMENT, raison AS RAISON, "
          f"'{LOAD_DATE}' AS DATE_EXTRACTION FROM ({O.ctes(**O.adj_ctes()) + O.ADJ_SELECT})")
def q_load_adjustments_table(spark, sf):
    return _load_twice(spark, fixtures.view(spark, sf, "cells_adj"), "adjustments", "treso_dea_retraitements")


_ADJ_UPPER = ("SELECT nom_fichier AS NOM_FICHIER, nom_onglet AS NOM_ONGLET, annee AS ANNEE, mois AS MOIS, mois_nom AS MOIS_NOM, "
              f"montant_retraitement AS MONTANT_RETRAITEMENT, raison AS RAISON, '{LOAD_DATE}' AS DATE_EXTRACTION FROM ")


@register("load_stopped_and_rerun", _ADJ_UPPER + f"({O.ctes(**O.adj_ctes('cells_adj_low')) + O.ADJ_SELECT})")
def q_load_stopped_and_rerun(spark, sf):
    """A load of half the workbooks; one of all of them that stops after its rows are written and before its commit; the
    same again to its end; and small loads merged.  Every workbook's rows are read once.  (The dates of these sheets stand
    below a title: the header row is promoted.)"""
    import uuid
    table = f"retraitement_dft_{uuid.uuid4().hex[:12]}"
    path, log = _fresh(spark, table), _fresh(spark, "log")
    cells = C.prepare_cells(fixtures.view(spark, sf, "cells_adj_low"))
    half = cells.where(F.crc32("file") % 2 == 0)
    first = loads.load_cells(half, "adjustments", path, log, table, LOAD_DATE)
    stopped = loads.stage_cells(cells, "adjustments", path, log, table, LOAD_DATE)
    again = loads.load_cells(cells, "adjustments", path, log, table, LOAD_DATE)
    if stopped and (stopped.loaded != again or loads.load_cells(cells, "adjustments", path, log, table, LOAD_DATE)):
        raise ValueError(f"loaded {first} files, staged {stopped.loaded}, then loaded {again}")
    loads.compact_loads(spark, path, log, table)
    if sorted(map(str, spark.table(table).drop("load").columns)) != sorted(commits.read_committed(spark, path, log).columns):
        raise ValueError("the catalog table and the log differ")
    return spark.table(table).drop("load")


@register("workbook_cells", O.ctes(cells_adj_low=None) + f"""
SELECT FILE AS file, SHEET AS sheet, SHEET_NO AS sheet_no, R AS r, C AS c, {O.read_number('V')} AS v FROM cells_adj_low""")
def q_workbook_cells(spark, sf):
    """Workbooks written from cells (numbers, date styles, shared strings) and decoded again."""
    return decode_files(encode_workbooks(fixtures.view(spark, sf, "cells_adj_low")))


@register("load_workbook_files", f"SELECT {', '.join((O.read_number(c) if c == 'montant_millions' else c) + ' AS ' + c.upper() for c in C.FACT_COLUMNS)}, "
          f"'{LOAD_DATE}' AS DATE_EXTRACTION FROM ({O.ingest_sql('multi', 'cells_shift')})")
def q_load_workbook_files(spark, sf):
    """Workbooks with repaired labels through decoding, gate and commit, beside truncated copies of every one and
    copies without a date in their name: those are listed with the reason, all others are loaded."""
    path, log = _fresh(spark, "treso_dea_prev"), _fresh(spark, "log")
    good = materialize(encode_workbooks(fixtures.view(spark, sf, "cells_shift")), "workbooks")
    half = good.withColumns({"content": F.expr("substring(content, 1, cast(length / 2 as int))"),
                             "path": F.concat(F.lit("incomplet/"), "path")})
    undated = good.withColumn("path", F.concat(F.lit("copie "), F.xxhash64("path").cast("string"), F.lit(".xlsx")))
    files = good.unionByName(half).unionByName(undated)
    listed = files.select(F.col("path").alias("name"), F.lit(None).cast("timestamp").alias("modification_time"), "length")
    n = loads.load_files(files, listed, "multi", path, log, load_date=LOAD_DATE)
    reasons = loads.rejected_files(spark, log).groupBy((F.col("reason") == loads.NO_VERSION).alias("undated")).count().collect()
    if sorted((r["undated"], r["count"]) for r in reasons) != [(False, n), (True, n)]:
        raise ValueError(f"loaded {n} files, rejected {reasons}")
    return commits.read_committed(spark, path, log)


@register("label_repair", O.ctes(**O.bounds_ctes("cells_shift")) + "SELECT file, sheet, r, v AS label FROM cr WHERE c = col_debut AND r >= 0")
def q_label_repair(spark, sf):
    """Labels of the kept rows: the label column's, or the anchor column's where that is empty."""
    c = prepared(spark, sf, "cells_shift")
    cropped = C.crop(c, C.written_bounds(c))
    return cropped.where("c = col_debut and r >= 0").select("file", "sheet", "r", F.col("v").alias("label"))


@register("promoted_header", O.ctes(**O.adj_ctes("cells_adj_low")) + "SELECT * FROM h2")
def q_promoted_header(spark, sf):
    return C.date_header(prepared(spark, sf, "cells_adj_low").where(F.col("sheet_no") <= C.ADJ_MAX_SHEETS))


@register("version_free_forms", O.ctes(file_names=None) + "SELECT FILE AS file, VERSION AS version_prev FROM file_names")
def q_version_free_forms(spark, sf):
    """Dates of file names in seven shapes; the oracle knows them from the orders."""
    return fixtures.view(spark, sf, "file_names").select(F.col("FILE").alias("file"), version_from_filename("FILE").alias("version_prev"))


@register("stream_exports", _LEDGER_LOADED)
def q_stream_exports(spark, sf):
    """Export files that arrive in two waves, read by a stream: the second wave's micro-batch is written and stopped before
    its commit, then replayed."""
    source, sink, ck = (_fresh(spark, x) for x in ("exports", "stream", "stream_checkpoint"))
    raw = raw_ledger(spark, sf)
    late = F.coalesce(F.col("FICHIER").isin("export_3.csv", "export_4.csv"), F.lit(False))

    def arrive(rows):
        rows.repartition(F.col("FICHIER")).write.mode("append").option("sep", ";").option("header", "true").option(
            "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(source)

    def run(on_written=None):
        ingest.start_export_ingest(spark, source, raw.columns, sink, ck, load_date=LOAD_DATE, on_written=on_written).awaitTermination()

    def stop(batch_id):
        raise RuntimeError("stopped before the commit")

    arrive(raw.where(~late))
    run()
    arrive(raw.where(late))
    try:
        run(stop)
    except StreamingQueryException as e:
        if "stopped before the commit" not in str(e):
            raise
    run()  # the batch that was written is written again, into its own lot
    run()  # nothing new
    return ingest.read_ingested(spark, sink).drop("lot")


@register("ledger_latest_incremental", O.ledger_ctes() + "SELECT * FROM sage")
def q_ledger_latest_incremental(spark, sf):
    """Five exports merged one after the other into the maintained latest-version table, one of them twice."""
    path, raw = _fresh(spark, "ledger_latest"), raw_ledger(spark, sf)
    for n in (0, 3, 1, 3, 4, 2):
        ledger.merge_export(raw.where(F.col("FICHIER") == f"export_{n}.csv"), path)
    return ledger.read_latest(spark, path)


@register("ledger_latest_bucketed", O.ledger_ctes() + "SELECT * FROM sage")
def q_ledger_latest_bucketed(spark, sf):
    """The latest-file rule on a table bucketed by day and account: no shuffle."""
    import uuid
    table = f"export_sage_bucketed_{uuid.uuid4().hex[:12]}"
    ledger.store_bucketed_ledger(raw_ledger(spark, sf), table, 8, _fresh(spark, table))
    return ledger.clean_bucketed_ledger(spark, table)


def _budget_dimension(spark, sf):
    """The stored label dimension, in a database of its own."""
    import uuid
    database = f"tresorerie_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_fresh(spark, database)}'")
    sinks.write_overwrite(fixtures.view(spark, sf, "label_dim"), _fresh(spark, "libelles"), load_date=LOAD_DATE,
                          table=f"{database}.codeflux_codebudget_libelles")
    return label_table(spark, database)


def _dimension_flows_sql(kind: str, letter: str) -> str:
    return (O.ctes(ledger=None, typed=O.TYPED_LEDGER, sage=O.SAGE, label_dim=None,
                   fl=f"SELECT * FROM sage WHERE banque_compte = {O.q(K.CONSOLIDATED_ACCOUNT)} AND code_budgetaire IN "
                      f"(SELECT CODE_BUDGETAIRE FROM label_dim WHERE upper(substr(CODE_BUDGETAIRE, 1, 1)) = {O.q(letter)})")
            + O.sum_by_sql("fl", "M", "code_budgetaire"))


def _register_dimension_flows(kind: str, name: str, letter: str) -> None:
    @register(name, _dimension_flows_sql(kind, letter))
    def fn(spark, sf):
        codes = periods.dimension_codes(_budget_dimension(spark, sf))
        s = sage(spark, sf)
        return periods.flows(s, periods.flow_labels(s, kind, "budget", codes), "budget", "M")


_register_dimension_flows("recettes", "receipts_month_dimension", "R")
_register_dimension_flows("depenses", "spending_month_dimension", "D")


@register("compact_partitioned", _LOADED_SQL)
def q_compact_partitioned(spark, sf):
    """A catalog table partitioned by month, written in two appends and compacted:
    same rows and types, and the table reads the new files."""
    import uuid
    table = f"treso_dea_prev_{uuid.uuid4().hex[:12]}"
    path, raw = _fresh(spark, table), raw_prev(spark, sf)
    even = F.col("ANNEE").try_cast("int") % 2 == 0
    for part in (raw.where(even), raw.where(~even | even.isNull())):
        sinks.write_append(part, path, table, LOAD_DATE, partition_by=["MOIS"])
    new = sinks.compact_table(spark, table)
    out = spark.table(table)
    if not all("_compact_" in f for f in out.inputFiles()):
        raise ValueError(f"{table} does not read {new}")
    return out


@register("compact_small_partitions", _LOADED_SQL)
def q_compact_small_partitions(spark, sf):
    """A partitioned catalog table with one file in each month, and more files in the even ones: only those are
    rewritten, the others keep their files; same rows."""
    import uuid
    table = f"treso_dea_prev_{uuid.uuid4().hex[:12]}"
    path, raw = _fresh(spark, table), raw_prev(spark, sf)
    even = F.coalesce(F.col("MOIS").try_cast("int") % 2 == 0, F.lit(False))
    later = even & (F.crc32("VERSION_PREV") % 2 == 0)
    for part in (raw.where(~later), raw.where(later)):
        sinks.write_append(part.repartition(F.col("MOIS")), path, table, LOAD_DATE, partition_by=["MOIS"])
    before = set(spark.table(table).inputFiles())
    done = sinks.compact_partitions(spark, table)
    out = spark.table(table)
    now = set(out.inputFiles())
    moved = {x for x in now if "_compact_" in x}
    if len(done) != len(moved) or not now - moved <= before or any("MOIS=0" in x and int(x[-2:]) % 2 for x in done):
        raise ValueError(f"{table}: {done} were compacted, {len(now - before)} files are new")
    return out

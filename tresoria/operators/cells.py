"""Spreadsheet cells -> long forecast rows, as set-based Spark jobs.

A sheet is a long table ``(file, sheet, r, c, v)``: ``r = -1`` is the header
row, empty cells are absent.  Everything a row-by-row sheet reader does
(anchor search, column classification, runs of columns, transposition) is
expressed as grouped aggregates over the cells plus small windows over
per-column statistics, so a workbook of any size is processed by many tasks
and a very large sheet never has to fit in one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tresoria.constants import ALLOWED_LABELS, ANCHOR_TEXTS, MONTH_COLUMN_WORDS, MONTHS_FR
from tresoria.functions.calendar import month_number
from tresoria.functions.numeric import to_number
from tresoria.functions.text import fill_trim_label, null_text
from tresoria.functions.version import version_from_filename
from tresoria.operators.controls import quality_gate
from tresoria.operators.joins import semi_join
from tresoria.session import materialize

SHEET = ["file", "sheet"]
# columns 0..2 are searched for the closing anchor, in this order
ANCHOR_SEARCH_COLUMNS = 3
# a month-less column closes the table only beyond this index
MONTHLESS_MIN_INDEX = 10


def normalise_cells(cells: DataFrame) -> DataFrame:
    """Lower-case cell columns (``FILE SHEET R C V [SHEET_NO]``)."""
    if all(c == c.lower() for c in cells.columns):
        return cells
    return cells.toDF(*[c.lower() for c in cells.columns])


def prepare_cells(cells: DataFrame) -> DataFrame:
    """Typed, lower-cased cells written once to the checkpoint folder.

    Every later step reads the cells several times (bounds, crop, unpivot);
    reading a written copy keeps plans small and avoids decoding the source
    again.  Operators prepare their cells themselves, unless told that they are
    (``prepared=True``)."""
    df = normalise_cells(cells)
    cols = [F.col("file").cast("string"), F.col("sheet").cast("string"),
            F.col("r").cast("int"), F.col("c").cast("int"), F.col("v").cast("string")]
    if "sheet_no" in df.columns:
        cols.append(F.col("sheet_no").cast("int"))
    return materialize(df.select(*cols), "cells")


def is_number(v: Column) -> Column:
    return to_number(v).isNotNull()


def _contains_any(v: Column, words: Sequence[str]) -> Column:
    low = F.lower(v)
    out = None
    for w in words:
        h = low.contains(w)
        out = h if out is None else (out | h)
    return F.coalesce(out, F.lit(False))


def _anchor_table(cells: DataFrame) -> DataFrame:
    """Per sheet: size, anchor column and the first row after the table."""
    body = F.col("r") >= 0
    num = is_number(F.col("v"))
    low = F.lower(F.col("v"))
    aggs = [F.max(F.when(body, F.col("r"))).alias("max_r"), F.max("c").alias("max_c")]
    for k in range(ANCHOR_SEARCH_COLUMNS):
        at_k = (F.col("c") == k) & body
        aggs.append(F.max(F.when(at_k & ~num, F.lit(1))).isNotNull().alias(f"cap{k}"))
        for j, text in enumerate(ANCHOR_TEXTS):
            aggs.append(F.min(F.when(at_k & low.contains(text), F.col("r"))).alias(f"m{k}_{j}"))
    g = cells.groupBy(*SHEET).agg(*aggs)
    first_hit = {k: F.coalesce(*[F.col(f"m{k}_{j}") for j in range(len(ANCHOR_TEXTS))])
                 for k in range(ANCHOR_SEARCH_COLUMNS)}
    anchor = None
    for k in range(ANCHOR_SEARCH_COLUMNS):
        step = (F.when(~F.col(f"cap{k}"), F.lit(None).cast("int")) if anchor is None
                else anchor.when(~F.col(f"cap{k}"), F.lit(None).cast("int")))
        anchor = step.when(first_hit[k].isNotNull(), F.lit(k))
    stop = None
    for k in range(ANCHOR_SEARCH_COLUMNS):
        stop = (F.when(F.col("ancre") == k, first_hit[k] + 2) if stop is None
                else stop.when(F.col("ancre") == k, first_hit[k] + 2))
    return (g.withColumn("ancre", anchor)
            .withColumn("arret", stop)
            .select(*SHEET,
                    (F.coalesce(F.col("max_r"), F.lit(-1)) + 1).alias("n_lignes"),
                    (F.col("max_c") + 1).alias("n_cols"),
                    "ancre", "arret"))


def _column_stats(cells: DataFrame, anchors: DataFrame) -> DataFrame:
    """Per (sheet, column) statistics over the header row and the rows above
    the stop row (only sheets where an anchor was found)."""
    a = anchors.where(F.col("ancre").isNotNull()).select(*SHEET, "arret", "n_lignes")
    win = cells.join(a, on=SHEET, how="inner").where(F.col("r") < F.col("arret"))
    num = is_number(F.col("v"))
    head = F.col("r") == -1
    g = win.groupBy(*SHEET, "c", "arret", "n_lignes").agg(
        F.count_if(num).alias("n_num"),
        F.count_if(~num).alias("n_txt"),
        F.max(head.cast("int")).alias("has_head"),
        F.max((head & num).cast("int")).alias("head_num"),
        F.count_if(F.col("r") >= 0).alias("n_body"),
        F.max(_contains_any(F.col("v"), MONTH_COLUMN_WORDS).cast("int")).alias("has_month"))
    rows = F.least(F.col("arret"), F.col("n_lignes"))
    # an empty header cell still has a (text) name, ``Unnamed: c``
    n_txt = F.col("n_txt") + F.when(F.col("has_head") == 1, 0).otherwise(1)
    return g.select(
        *SHEET, "c",
        ((F.col("n_num") > n_txt) & (F.col("n_num") > rows - F.col("n_body"))).alias("is_float"),
        (F.col("has_month") == 1).alias("has_month"),
        ((F.col("head_num") == 1) & (F.col("n_num") == rows + 1)).alias("all_numeric"))


def _leading_run(flags: DataFrame, flag: str, start: int | None = None) -> DataFrame:
    """First maximal run of consecutive column indexes among flagged columns:
    ``(file, sheet, run_min, run_max, run_len)``.

    Gaps and islands: along the flagged columns of a sheet ``c - rank`` is
    constant on a run, so the first run is the rows where it equals its
    minimum.  With ``start`` only a run beginning exactly at ``start``
    counts.  One window pass per sheet (one row per column), then an
    aggregate on the same partitioning (no further shuffle)."""
    f = flags.where(F.col(flag))
    if start is not None:
        f = f.where(F.col("c") >= start)
    w = Window.partitionBy(*SHEET).orderBy("c")
    f = f.withColumn("_g", F.col("c") - F.row_number().over(w))
    f = f.withColumn("_g0", F.min("_g").over(Window.partitionBy(*SHEET)))
    run = (f.where(F.col("_g") == F.col("_g0"))
           .groupBy(*SHEET).agg(F.min("c").alias("run_min"), F.max("c").alias("run_max"),
                                F.count(F.lit(1)).alias("run_len")))
    if start is not None:
        run = run.where(F.col("run_min") == start)
    return run


def _runs(stats: DataFrame) -> DataFrame:
    """Both runs the bounds need, from one window pass over the columns:
    the first run of numeric columns and the run of month columns starting
    at index 11; plus whether any column is fully numeric."""
    w = Window.partitionBy(*SHEET).orderBy("c").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*SHEET)
    fl = F.col("is_float")
    mo = F.col("has_month") & (F.col("c") >= MONTHLESS_MIN_INDEX + 1)
    x = stats.select(
        *SHEET, "c", "is_float", "all_numeric",
        F.when(fl, F.col("c") - F.sum(fl.cast("int")).over(w)).alias("_gf"),
        F.when(mo, F.col("c") - F.sum(mo.cast("int")).over(w)).alias("_gm"))
    x = x.withColumns({"_gf0": F.min("_gf").over(whole), "_gm0": F.min("_gm").over(whole)})
    in_f = F.col("_gf") == F.col("_gf0")
    in_m = F.col("_gm") == F.col("_gm0")
    g = x.groupBy(*SHEET).agg(
        F.min(F.when(in_f, F.col("c"))).alias("run_min"),
        F.max(F.when(in_f, F.col("c"))).alias("run_max"),
        F.count_if(in_f).alias("run_len"),
        F.min(F.when(in_m, F.col("c"))).alias("_m_min"),
        F.max(F.when(in_m, F.col("c"))).alias("_m_max"),
        F.max(F.col("all_numeric").cast("int")).alias("any_all_num"))
    month_end = F.when(F.col("_m_min") == MONTHLESS_MIN_INDEX + 1, F.col("_m_max"))
    return g.select(*SHEET, "run_min", "run_max", "run_len", month_end.alias("month_run_end"), "any_all_num")


def sheet_bounds(cells: DataFrame) -> DataFrame:
    """Table bounds of every sheet: ``(file, sheet, ancre, ligne_fin, col_debut,
    col_fin, repli)``; rows ``< ligne_fin`` and columns ``[col_debut, col_fin)``
    are kept, ``col_debut`` is the label column.

    Detection: the closing anchor (``solde financier`` first, else ``variation
    de trésorerie``) in column 0, 1 or 2 ends the table two rows below it; the
    first run of numeric columns gives the label column (just before it) and
    the end (just after it, or the first month-less column beyond index 10
    if that comes first).  When any step fails the whole sheet is kept
    (``repli``)."""
    cells = normalise_cells(cells)
    anchors = _anchor_table(cells)
    b = anchors.join(_runs(_column_stats(cells, anchors)), on=SHEET, how="left")
    first_monthless = F.coalesce(F.col("month_run_end") + 1, F.lit(MONTHLESS_MIN_INDEX + 1))
    ok = F.coalesce(
        F.col("ancre").isNotNull() & (F.col("run_len") >= 2) & (F.col("run_min") >= 1)
        & (F.col("n_cols") >= MONTHLESS_MIN_INDEX + 1)
        & (F.coalesce(F.col("any_all_num"), F.lit(0)) == 0),
        F.lit(False))
    return b.select(
        *SHEET,
        F.when(ok, F.col("ancre")).otherwise(0).alias("ancre"),
        F.when(ok, F.col("arret")).otherwise(F.col("n_lignes")).alias("ligne_fin"),
        F.when(ok, F.col("run_min") - 1).otherwise(0).alias("col_debut"),
        F.when(ok, F.least(F.col("run_max") + 1, first_monthless)).otherwise(F.col("n_cols")).alias("col_fin"),
        (~ok).alias("repli"))


def all_unnamed(cells: DataFrame) -> DataFrame:
    """Per sheet: is every header cell empty (all columns ``Unnamed``)?"""
    cells = normalise_cells(cells)
    return (cells.groupBy(*SHEET)
            .agg((F.count_if(F.col("r") == -1) == 0).alias("sans_entete")))


def numeric_columns(cells: DataFrame) -> DataFrame:
    """Per (sheet, column): numeric / month flags used by the bounds detection."""
    cells = normalise_cells(cells)
    return _column_stats(cells, _anchor_table(cells))


def crop(cells: DataFrame, bounds: DataFrame) -> DataFrame:
    """Cells inside the bounds, header row included, label column repaired:
    an empty label takes the anchor column's text on the same row."""
    cells = normalise_cells(cells)
    b = bounds.select(*SHEET, "ancre", "ligne_fin", "col_debut", "col_fin")
    x = cells.join(b, on=SHEET, how="inner")
    inside = (F.col("r") < F.col("ligne_fin")) & (F.col("c") >= F.col("col_debut")) & (F.col("c") < F.col("col_fin"))
    kept = x.where(inside)
    # label repair: anchor-column cells moved to the label column where empty
    moved = (x.where((F.col("c") == F.col("ancre")) & (F.col("ancre") != F.col("col_debut"))
                     & (F.col("r") >= 0) & (F.col("r") < F.col("ligne_fin")))
             .withColumn("c", F.col("col_debut"))
             .join(x.where(F.col("c") == F.col("col_debut")).select(*SHEET, "r"),
                   on=SHEET + ["r"], how="left_anti"))
    return kept.unionByName(moved).select(*SHEET, "r", "c", "v", "col_debut", "col_fin")


def _unpivot(cropped: DataFrame, head_rows: dict[str, int], first_value_row: int) -> DataFrame:
    """Value cells joined with their column's header rows and their row label.

    ``head_rows`` maps an output name to the row holding it (``-1`` header).
    Column metadata is one aggregate (one row per sheet column) and labels
    one row per sheet row: both joins are equi-joins on keys; no positional
    key and no per-sheet collection is needed."""
    cols = cropped.where(F.col("c") > F.col("col_debut"))
    meta = (cols.where(F.col("r") < first_value_row).groupBy(*SHEET, "c")
            .agg(*[F.max(F.when(F.col("r") == row, F.col("v"))).alias(name)
                   for name, row in head_rows.items()]))
    labels = (cropped.where((F.col("c") == F.col("col_debut")) & (F.col("r") >= first_value_row))
              .select(*SHEET, "r", F.col("v").alias("label")))
    vals = cols.where(F.col("r") >= first_value_row).select(*SHEET, "r", "c", F.col("v").alias("montant"))
    return (vals.join(meta, on=SHEET + ["c"], how="left")
            .join(labels, on=SHEET + ["r"], how="left"))


def unpivot_multi(cropped: DataFrame) -> DataFrame:
    """Sheet-per-year layout: header = month name, row 0 = amount type,
    sheet name = year, label column = nature."""
    u = _unpivot(cropped, {"mois_nom": -1, "type_montant": 0}, first_value_row=1)
    return u.select(*SHEET, "r", "c",
                    F.col("sheet").alias("annee"),
                    F.coalesce(F.col("mois_nom"), F.concat(F.lit("Unnamed: "), F.col("c").cast("string"))).alias("mois_nom"),
                    "type_montant", "label", "montant")


def year_fill(cropped: DataFrame) -> DataFrame:
    """Single-sheet layout: the year stands above the first month of each year
    (``janvier``, or a later one where a table starts in mid-year); every month
    column takes the last non-empty header at or before it.  A window over the
    columns of a sheet (one row per column, never per cell)."""
    meta = (cropped.where((F.col("c") > F.col("col_debut")) & (F.col("r") <= 0))
            .groupBy(*SHEET, "c")
            .agg(F.max(F.when(F.col("r") == -1, F.col("v"))).alias("entete")))
    w = Window.partitionBy(*SHEET).orderBy("c").rowsBetween(Window.unboundedPreceding, 0)
    filled = F.last("entete", ignorenulls=True).over(w)
    own = F.concat(F.lit("Unnamed: "), F.col("c").cast("string"))
    return meta.select(*SHEET, "c", F.coalesce(filled, own).alias("annee"))


def unpivot_single(cropped: DataFrame) -> DataFrame:
    """One-sheet layout: header = year (above ``janvier`` only), row 0 =
    month name, row 1 = amount type, data from row 2."""
    u = _unpivot(cropped, {"mois_nom": 0, "type_montant": 1}, first_value_row=2)
    years = year_fill(cropped)
    return (u.join(years, on=SHEET + ["c"], how="left")
            .select(*SHEET, "r", "c", "annee", "mois_nom", "type_montant", "label", "montant"))


#: layout: rows that hold a column's month and type, and the first row of values
LAYOUT_ROWS = {"multi": (-1, 0, 1), "single": (0, 1, 2)}


def unpivot(cells: DataFrame, bounds: DataFrame, layout: str = "multi") -> DataFrame:
    """Crop and unpivot in one go: ``unpivot_multi``/``unpivot_single`` of ``crop(cells, bounds)``.

    The cells are read three times, for the values, for the columns' header rows and for the
    rows' labels (repaired by an aggregate over the label and the anchor column, not by a
    self-join); ``bounds`` should be written, one row a sheet, or they are computed again for each."""
    month_row, type_row, first = LAYOUT_ROWS[layout]
    b = bounds.select(*SHEET, "ancre", "ligne_fin", "col_debut", "col_fin")
    x = normalise_cells(cells).join(b, on=SHEET, how="inner").where(F.col("r") < F.col("ligne_fin"))
    right = (F.col("c") > F.col("col_debut")) & (F.col("c") < F.col("col_fin"))
    at = lambda row: F.max(F.when(F.col("r") == row, F.col("v")))
    vals = x.where(right & (F.col("r") >= first)).select(*SHEET, "r", "c", F.col("v").alias("montant"))
    meta = x.where(right & (F.col("r") < first)).groupBy(*SHEET, "c").agg(
        at(month_row).alias("mois_nom"), at(type_row).alias("type_montant"), at(-1).alias("entete"),
        F.max((F.col("r") <= 0).cast("int")).alias("en_tete"))
    in_column = lambda c: F.max(F.when(F.col("c") == F.col(c), F.col("v")))
    labels = x.where(((F.col("c") == F.col("col_debut")) | (F.col("c") == F.col("ancre"))) & (F.col("r") >= first)).groupBy(
        *SHEET, "r").agg(F.coalesce(in_column("col_debut"), in_column("ancre")).alias("label"))
    own = F.concat(F.lit("Unnamed: "), F.col("c").cast("string"))
    if layout == "single":
        w = Window.partitionBy(*SHEET).orderBy("c").rowsBetween(Window.unboundedPreceding, 0)
        filled = F.last("entete", ignorenulls=True).over(w)
        meta = meta.withColumn("annee", F.when(F.col("en_tete") == 1, F.coalesce(filled, own)))
    u = (vals.join(meta.drop("entete", "en_tete"), on=SHEET + ["c"], how="left")
         .join(labels, on=SHEET + ["r"], how="left"))
    if layout == "multi":
        u = u.withColumns({"annee": F.col("sheet"), "mois_nom": F.coalesce("mois_nom", own)})
    return u.select(*SHEET, "r", "c", "annee", "mois_nom", "type_montant", "label", "montant")


def to_fact(long: DataFrame) -> DataFrame:
    """Long rows -> the 7 text columns of the forecast fact (+ provenance).

    Empty label -> ``Eléments exceptionnels`` then trim; ``'null'`` text ->
    NULL in every column; rows without an amount dropped."""
    df = long.select(
        F.col("file").alias("nom_fichier"), F.col("sheet").alias("nom_onglet"),
        version_from_filename(F.col("file")).alias("version_prev"),
        null_text(F.col("annee")).alias("annee"),
        month_number(null_text(F.col("mois_nom"))).alias("mois"),
        null_text(F.col("mois_nom")).alias("mois_nom"),
        null_text(fill_trim_label(F.col("label"))).alias("nature_montant"),
        null_text(F.col("type_montant")).alias("type_montant"),
        null_text(F.col("montant")).alias("montant_millions"))
    return df.where(F.col("montant_millions").isNotNull())


FACT_COLUMNS = ["version_prev", "annee", "mois", "mois_nom", "nature_montant", "type_montant",
                "montant_millions"]


def written_bounds(cells: DataFrame) -> DataFrame:
    """The bounds of every sheet, computed once and written: one row a sheet."""
    return materialize(sheet_bounds(cells), "bounds")


def long_forecast(cells: DataFrame, layout: str = "multi", prepared: bool = False) -> DataFrame:
    """Cells -> long forecast rows with provenance (before the gate)."""
    cells = cells if prepared else prepare_cells(cells)
    return to_fact(unpivot(cells, written_bounds(cells), layout))


def ingest_forecast(cells: DataFrame, layout: str = "multi",
                    allowed: Sequence[str] = ALLOWED_LABELS, prepared: bool = False) -> DataFrame:
    """Forecast workbooks as cells -> rows of the sheets that pass the gate.

    The gate unit is the sheet for the sheet-per-year layout and the
    workbook for the one-sheet layout.  Passing units are applied as a
    semi-join."""
    fact = materialize(long_forecast(cells, layout, prepared), "fact")
    keys = ["nom_fichier", "nom_onglet"] if layout == "multi" else ["nom_fichier"]
    gate = quality_gate(fact, keys, allowed)
    ok = gate.where(F.col("valide")).select(*keys)
    return semi_join(fact, ok, keys).select(*FACT_COLUMNS)


# ------------------------------------------------------------ adjustments ---

ADJ_FOLDER_MARK = "Prévisions DEA mensualisées/"
ADJ_MAX_SHEETS = 5


def is_date_text(v) -> Column:
    """A cell holding a calendar date (``yyyy-MM-dd``, optionally a time)."""
    v = v if isinstance(v, Column) else F.col(v)
    return F.coalesce(F.try_to_timestamp(v, F.lit("yyyy-MM-dd")),
                      F.try_to_timestamp(v, F.lit("yyyy-MM-dd HH:mm:ss"))).isNotNull()


def _as_date(v: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(v, F.lit("yyyy-MM-dd")),
                      F.try_to_timestamp(v, F.lit("yyyy-MM-dd HH:mm:ss"))).cast("date")


def date_header(cells: DataFrame) -> DataFrame:
    """Per sheet: the row of dates used as header and the last column kept.

    Header: the sheet header if it holds a date, else the first row holding
    one (promoted).  Cut: after the first date column (index >= 1) whose
    right neighbour exists and is not a date; no such column keeps all."""
    cells = normalise_cells(cells)
    d = is_date_text(F.col("v"))
    g = cells.groupBy(*SHEET).agg(
        F.max(F.when((F.col("r") == -1) & d, F.lit(1))).alias("_hd"),
        F.min(F.when((F.col("r") >= 0) & d, F.col("r"))).alias("_fr"),
        F.max("c").alias("max_c"))
    hdr = g.select(*SHEET, "max_c",
                   F.when(F.col("_hd") == 1, F.lit(-1)).otherwise(F.col("_fr")).alias("ligne_entete"))
    hdr = hdr.where(F.col("ligne_entete").isNotNull())
    dates = (cells.join(hdr, on=SHEET).where((F.col("r") == F.col("ligne_entete")) & d)
             .select(*SHEET, "c", "max_c"))
    nxt = dates.select(*SHEET, (F.col("c") - 1).alias("c"))
    ends = (dates.where((F.col("c") >= 1) & (F.col("c") + 1 <= F.col("max_c")))
            .join(nxt, on=SHEET + ["c"], how="left_anti")
            .groupBy(*SHEET).agg(F.min("c").alias("_end")))
    return (hdr.join(ends, on=SHEET, how="left")
            .select(*SHEET, "ligne_entete", F.coalesce(F.col("_end"), F.col("max_c")).alias("col_fin")))


def _first_sheets(cells: DataFrame, n: int) -> DataFrame:
    """(file, sheet) of the first ``n`` sheets of every workbook, in workbook
    order, which only ``sheet_no`` tells."""
    if "sheet_no" not in cells.columns:
        raise ValueError("cells need sheet_no: the order of a workbook's sheets is not the order of their names")
    return cells.where(F.col("sheet_no") <= n).select(*SHEET).distinct()


def adjustments(cells: DataFrame, max_sheets: int = ADJ_MAX_SHEETS, prepared: bool = False) -> DataFrame:
    """Adjustment workbooks -> ``(nom_fichier, nom_onglet, annee, mois, mois_nom,
    montant_retraitement, raison)``.

    In the first ``max_sheets`` sheets, the last column holding ``raison``
    lists ``Retraitement`` rows and ``raison`` rows; the i-th of each are
    paired; every date column with an amount gives one row.

    The header of each sheet and the marked rows are written once (a row a sheet, a row a
    mark); the cells are then read twice, for the paired rows and for the dates."""
    cells = cells if prepared else prepare_cells(cells)
    if "sheet_no" not in cells.columns:
        raise ValueError("cells need sheet_no: the order of a workbook's sheets is not the order of their names")
    cells = cells.where(F.col("sheet_no") <= max_sheets)
    hdr = materialize(date_header(cells), "date-header")
    x = cells.join(hdr, on=SHEET).where(F.col("c") <= F.col("col_fin"))
    body = x.where(F.col("r") > F.col("ligne_entete"))
    low = F.lower(F.col("v"))
    marks = body.select(*SHEET, "r", "c", low.contains("retraitement").alias("ret"), low.contains("raison").alias("rai")).where("ret or rai")
    last = F.max(F.when(F.col("rai"), F.col("c"))).over(Window.partitionBy(*SHEET))
    marks = materialize(marks.withColumn("col_raison", last).where("c = col_raison"), "marks")
    w = Window.partitionBy(*SHEET).orderBy("r")
    numbered = lambda kind: (marks.where(F.col(kind)).select(*SHEET, F.col("r").alias(f"r_{kind}"),
                                                           F.row_number().over(w).alias("i")))
    pairs = numbered("ret").join(numbered("rai"), on=SHEET + ["i"], how="inner")
    rows = pairs.select(*SHEET, "i", F.expr("stack(2, 'ret', r_ret, 'rai', r_rai) as (kind, r)"))
    # equi-join on the row key: a cell meets the pairs of its own row only
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("v")))
    paired = body.join(rows, on=SHEET + ["r"], how="inner").groupBy(*SHEET, "i", "c").agg(
        of("ret").alias("montant_retraitement"), of("rai").alias("raison")).where(F.col("montant_retraitement").isNotNull())
    heads = (x.where((F.col("r") == F.col("ligne_entete")) & is_date_text(F.col("v")))
             .select(*SHEET, "c", _as_date(F.col("v")).alias("d")))
    out = paired.join(heads, on=SHEET + ["c"], how="inner")
    mois = F.lpad(F.month("d").cast("string"), 2, "0")
    return out.select(
        F.substring_index(F.col("file"), ADJ_FOLDER_MARK, -1).alias("nom_fichier"),
        F.col("sheet").alias("nom_onglet"),
        F.year("d").cast("string").alias("annee"),
        mois.alias("mois"),
        F.try_element_at(F.create_map(*[x for i, n in enumerate(MONTHS_FR, 1)
                                         for x in (F.lit(f"{i:02d}"), F.lit(n))]), mois).alias("mois_nom"),
        "montant_retraitement", "raison")

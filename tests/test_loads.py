"""Committed loads, quarantine, compaction of loads, and the workbook writer."""

import os
import tempfile
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from tests.xlsx_writer import write_xlsx
from tresoria import fixtures
from tresoria.operators import cells as C
from tresoria.operators import ledger
from tresoria.plans import loads
from tresoria.sources import commits, workbook
from tresoria.sources.workbook_writer import column_name, encode_workbooks
from tresoria.streaming import ingest

SF = "/root/testdata/sf0.001"


def _tmpdir():
    return tempfile.mkdtemp(prefix="tresoria-test-", dir="/tmp")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _grid(amount):
    g = {(1, c): f"2021-{c:02d}-01" for c in range(1, 5)}
    g.update({(2, 0): "Retraitement", (3, 0): "Raison", (2, 1): amount, (3, 1): "r1", (2, 3): amount + 1})
    return g


def _put(path, *names):
    os.makedirs(path, exist_ok=True)
    for i, n in enumerate(names):
        write_xlsx(f"{path}/{n}", [("S1", _grid(10 * i + 10))])


def _loader(spark, d, table=None):
    return lambda: loads.load_workbooks(spark, d + "/in", "adjustments", d + "/t", d + "/log", table, load_date="2024-01-31")


def test_a_stopped_load_is_loaded_once(spark, monkeypatch):
    d = _tmpdir()
    _put(d + "/in", "a 2021.02.xlsx", "b 2021.03.xlsx")
    run = _loader(spark, d)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            run()
    assert len(os.listdir(d + "/t")) == 1  # rows are there, no reader sees them
    with pytest.raises(ValueError, match="no commit"):
        commits.read_committed(spark, d + "/t", d + "/log")
    assert (run(), run()) == (2, 0)
    assert commits.read_committed(spark, d + "/t", d + "/log").count() == 4
    kept = commits.visible_loads(spark, d + "/log")
    assert len(commits.delete_hidden(spark, d + "/t", d + "/log")) == 1
    assert sorted(x for x in os.listdir(d + "/t") if x.startswith("load=")) == [f"load={x}" for x in kept]
    assert commits.read_committed(spark, d + "/t", d + "/log").count() == 4


def test_the_catalog_follows_the_log_after_a_stop(spark, monkeypatch):
    d = _tmpdir()
    spark.sql("DROP TABLE IF EXISTS tresoria_loads_t")
    _put(d + "/in", "a 2021.02.xlsx")
    run = _loader(spark, d, "tresoria_loads_t")
    assert run() == 1 and spark.table("tresoria_loads_t").count() == 2
    _put(d + "/in", "b 2021.03.xlsx")
    with monkeypatch.context() as m:
        m.setattr(commits, "sync_catalog", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            run()  # committed in the log, not yet in the catalog
    _put(d + "/in", "c 2021.04.xlsx")
    assert run() == 1
    assert spark.table("tresoria_loads_t").count() == 6 == commits.read_committed(spark, d + "/t", d + "/log").count()
    spark.sql("DROP TABLE IF EXISTS tresoria_loads_t")


def test_unreadable_files_are_listed_and_tried_again_when_they_change(spark):
    d = _tmpdir()
    _put(d + "/in", "a 2021.02.xlsx", "half 2021.03.xlsx")
    whole = open(d + "/in/half 2021.03.xlsx", "rb").read()
    for name, content in (("half 2021.03.xlsx", whole[:len(whole) // 2]), ("none 2021.04.xlsx", b""), ("text 2021.05.xlsx", b"no zip")):
        with open(f"{d}/in/{name}", "wb") as f:
            f.write(content)
    write_xlsx(d + "/in/empty 2021.06.xlsx", [("S1", {})])
    run = _loader(spark, d)
    assert run() == 2  # the good one and the one without a cell
    bad = {os.path.basename(r["name"]): r["reason"] for r in loads.rejected_files(spark, d + "/log").collect()}
    # an empty file is not there yet for Spark's file sources
    assert sorted(bad) == ["half 2021.03.xlsx", "text 2021.05.xlsx"] and all("BadZipFile" in x for x in bad.values())
    assert run() == 0 and commits.read_log(spark, d + "/log").where("kind = 'rejected'").count() == 2  # not decoded again
    with open(d + "/in/half 2021.03.xlsx", "wb") as f:
        f.write(whole)
    assert run() == 1
    assert loads.rejected_files(spark, d + "/log").count() == 1
    assert commits.read_committed(spark, d + "/t", d + "/log").count() == 4


def test_forecast_files_without_a_version_are_rejected(spark):
    cells = fixtures.view(spark, SF, "cells")
    named = cells.withColumn("FILE", F.when(F.crc32("FILE") % 2 == 0, F.regexp_replace("FILE", "[0-9]{4}[.][0-9]{2}", "")).otherwise(F.col("FILE")))
    d = _tmpdir()
    n = loads.load_cells(named, "multi", d + "/t", d + "/log", load_date="2024-01-31")
    bad = loads.rejected_files(spark, d + "/log").collect()
    assert n + len(bad) == named.select("FILE").distinct().count() and n and bad
    assert {r["reason"] for r in bad} == {loads.NO_VERSION}


def test_small_loads_merge_and_large_ones_keep_their_files(spark):
    d = _tmpdir()
    log, table = d + "/log", d + "/t"

    def add(df, files):
        load = commits.new_load_id()
        df.repartition(files).write.parquet(commits.load_path(table, load))
        commits.commit(commits.action(spark, "add", [load]), log)
        return load

    large = add(spark.range(200_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("s")), 1)
    small = [add(spark.range(i * 10, i * 10 + 10).select(F.col("id"), F.lit("x").alias("s")), 2) for i in range(4)]
    before, files = rows(commits.read_committed(spark, table, log)), set(os.listdir(commits.load_path(table, large)))
    old = commits.read_committed(spark, table, log)  # a reader of the earlier commit
    assert loads.compact_loads(spark, table, log, target_file_bytes=1 << 20) == sorted(small)
    now = commits.visible_loads(spark, log)
    assert len(now) == 2 and large in now and set(os.listdir(commits.load_path(table, large))) == files
    (merged,) = set(now) - {large}
    assert len([f for f in os.listdir(commits.load_path(table, merged)) if f.endswith(".parquet")]) == 1
    assert rows(commits.read_committed(spark, table, log)) == before == rows(old)
    assert loads.compact_loads(spark, table, log, target_file_bytes=1 << 20) == []  # nothing left to merge


def test_workbooks_written_from_cells_read_back(spark):
    values = ["texte", "é <&> \"'", " blanks ", "12.5", "-3", "2021-02-28", "1e3", "a\nb", "2021-2-8", "007"]
    read = ["texte", "é <&> \"'", " blanks ", "12.5", "-3", "2021-02-28", "1000", "a\nb", "2021-2-8", "7"]
    data = [(f"d/{f}.xlsx", s, no, r, 27 * r + i, v) for f in ("x", "y") for s, no in (("Zwei", 1), ("A & B", 2))
            for r in (-1, 0, 40) for i, v in enumerate(values)]
    want = [(f, s, no, r, c, read[values.index(v)]) for f, s, no, r, c, v in data]
    schema = "file string, sheet string, sheet_no int, r int, c int, v string"
    cells = spark.createDataFrame([(f, s, no, r, c + 27, v) for f, s, no, r, c, v in data], schema).repartition(4)
    want = [(f, s, no, r, c + 27, v) for f, s, no, r, c, v in want]
    files = encode_workbooks(cells.union(spark.createDataFrame([("d/x.xlsx", "Zwei", 1, 99, 0, None), ("d/x.xlsx", "Zwei", 1, 99, 1, "")], schema)))
    assert rows(workbook.decode_files(files)) == sorted(want, key=str)
    assert encode_workbooks(cells.limit(0)).collect() == []
    for bad in (("x", "s", 1, 0, 16_384, "v"), ("x", "s", 1, 1_048_576, 0, "v"), ("x", "s", 1, 0, 0, "\x01")):
        with pytest.raises(Exception, match="no cell|does not allow"):
            encode_workbooks(spark.createDataFrame([bad], schema)).collect()
    twice = spark.createDataFrame([("x", "s", 1, 0, 0, "v"), ("x", "s", 1, 0, 0, "w")], schema)
    with pytest.raises(Exception, match="occurs twice"):
        encode_workbooks(twice).collect()
    assert [column_name(c) for c in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_a_stream_lists_unreadable_workbooks(spark):
    src, sink, ck = _tmpdir(), _tmpdir(), _tmpdir()
    _put(src, "a 2021.02.xlsx")
    with open(src + "/bad 2021.03.xlsx", "wb") as f:
        f.write(b"PK no zip")
    ingest.start_ingest(spark, src, sink + "/adj", ck + "/ck", layout="adjustments", load_date="2024-01-31").awaitTermination(120)
    assert ingest.read_ingested(spark, sink + "/adj").count() == 2
    (bad,) = ingest.read_rejected(spark, sink + "/adj").collect()
    assert bad["name"].endswith("bad%202021.03.xlsx") or bad["name"].endswith("bad 2021.03.xlsx")


def test_one_pass_unpivot_equals_crop_then_unpivot(spark):
    for view, layout, second in (("cells", "multi", C.unpivot_multi), ("cells_single", "single", C.unpivot_single), ("cells_shift", "multi", C.unpivot_multi)):
        cells = C.prepare_cells(fixtures.view(spark, SF, view))
        b = C.written_bounds(cells)
        one, two = C.unpivot(cells, b, layout), second(C.crop(cells, b))
        plan = one._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.split("\n") if "FileScan" in x]
        assert len([x for x in scans if "/cells-" in x]) == 3 and len(scans) == 6  # the others read one row a sheet
        assert one.columns == two.columns and rows(one) == rows(two)


def test_merging_an_export_reads_its_months_only(spark):
    d = _tmpdir()
    typed = lambda day, acc, made, amount, f: (day, acc, made + " 06:00:00", amount, f)
    cols = "DATE_MONTANT string, BANQUE_COMPTE string, DATE_PRODUCTION_FICHIER string, MONTANT string, FICHIER string"
    first = [typed(f"2023/{m:02d}/10", "A", f"2023/{m:02d}/11", str(m), "e1") for m in range(1, 13)]
    raw = lambda data: spark.createDataFrame(data, cols)
    assert len(ledger.merge_export(raw(first), d + "/t")) == 12
    untouched = {m: os.listdir(f"{d}/t/annee_mois=2023-{m:02d}") for m in range(1, 13) if m != 5}
    late = [typed("2023/05/10", "A", "2023/05/12", "55", "e2"), typed("2023/05/10", "A", "2023/05/12", "56", "e2"),
            typed("2023/05/11", "B", "2023/05/12", "57", "e2"), typed(None, "B", "2023/05/12", "58", "e2")]
    for _ in range(2):  # again: nothing doubles
        assert ledger.merge_export(raw(late), d + "/t") == ["2023-05"]
    assert {m: os.listdir(f"{d}/t/annee_mois=2023-{m:02d}") for m in range(1, 13) if m != 5} == untouched
    want = ledger.clean_ledger(raw(first + late))
    assert rows(ledger.read_latest(spark, d + "/t").select(want.columns)) == rows(want)
    old = [typed("2023/05/10", "A", "2023/05/11", "99", "e3")]  # an older file that comes late
    ledger.merge_export(raw(old), d + "/t")
    assert rows(ledger.read_latest(spark, d + "/t").select(want.columns)) == rows(ledger.clean_ledger(raw(first + late + old)))


def test_latest_file_on_buckets_needs_no_exchange(spark):
    spark.sql("DROP TABLE IF EXISTS tresoria_bucketed_t")
    raw = fixtures.view(spark, SF, "ledger")
    ledger.store_bucketed_ledger(raw, "tresoria_bucketed_t", 4, _tmpdir() + "/t")
    out = ledger.clean_bucketed_ledger(spark, "tresoria_bucketed_t")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "LeftSemi" in plan
    assert rows(out) == rows(ledger.clean_ledger(raw).select(out.columns))
    part = ledger.clean_bucketed_ledger(spark, "tresoria_bucketed_t", "2023-12-01", "2023-12-31", ["Total"])
    assert rows(part) == rows(ledger.clean_ledger(raw, "2023-12-01", "2023-12-31", ["Total"]).select(out.columns))
    spark.sql("DROP TABLE IF EXISTS tresoria_bucketed_t")


def test_dates_in_file_names(spark):
    from tresoria.functions.version import version_from_filename
    names = {"x 31.12.2021.xlsx": "2021-12", "x 2021 2.xlsx": "2021-02", "12-2021.xlsx": "2021-12", "x 2021-10-19.xlsx": "2021-10",
             "19102020.xlsx": "2020-10", "12 31 2021": "2021-12", "05.06.2021": "2021-05", "31.13.2021": None, "2021.13": None, "13-2021": None,
             "x": None, "12345-2021": None, "a/mensualisées/Equilibre 2017.10 - DEA.xlsx": "2017-10",
             "2019.01/mensualisées/Equilibre 3.2020.xlsx": "2020-03", None: None, "": None}
    df = spark.createDataFrame([(n,) for n in names], "f string")
    got = {r["f"]: r["v"] for r in df.select("f", version_from_filename("f").alias("v")).collect()}
    assert got == names


def test_repaired_labels_and_promoted_headers_by_hand(spark):
    """Expected values written out, for sheets with the labels in the second column and the dates in the second row."""
    g = [("f 2021.02", "2021", r, c, v) for r, c, v in [
        (-1, 0, "Titre"), (0, 0, "note"), (0, 1, "x"), (1, 0, "Solde financier"), (2, 0, "after")]]
    g += [("f 2021.02", "2021", -1, c, C.MONTHS_FR[c - 2]) for c in range(2, 14)] + [
        ("f 2021.02", "2021", r, c, str(r * 100 + c)) for r in (0, 1, 2, 3) for c in range(2, 14)]
    cells = spark.createDataFrame(g, "file string, sheet string, r int, c int, v string")
    b = C.sheet_bounds(cells)
    assert rows(b.select("ancre", "ligne_fin", "col_debut", "col_fin", "repli")) == [(0, 3, 1, 14, False)]
    labels = C.crop(cells, b).where("c = 1 and r >= 0").select("r", "v")
    assert rows(labels) == [(0, "x"), (1, "Solde financier"), (2, "after")]




def test_only_partitions_with_small_files_are_rewritten(spark):
    from tresoria.sources import sinks
    d, table = _tmpdir(), "tresoria_select_t"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    add = lambda data, files: sinks.write_append(spark.createDataFrame(data, "N string, MOIS string").repartition(files), d + "/t",
                                                 table=table, load_date="2024-01-31", partition_by=["MOIS"])
    add([(str(i * 7919), "01") for i in range(60_000)], 1)  # one large file
    add([(str(i), "02") for i in range(50)], 4)
    add([(str(i), None) for i in range(50)], 3)
    add([(str(i), "a'b/c") for i in range(50)], 3)
    add([("x", "03")], 1)  # small, but alone
    before = rows(spark.table(table))
    where = lambda: {unquote(f).rsplit("/", 1)[0].rsplit("/", 1)[-1]: f for f in spark.table(table).inputFiles()}
    kept = where()
    done = sinks.compact_partitions(spark, table, target_file_bytes=1 << 17)
    assert len(done) == 3 and "MOIS=02" in done and "MOIS=01" not in done and "MOIS=03" not in done
    now = where()
    assert now["MOIS=01"] == kept["MOIS=01"] and now["MOIS=03"] == kept["MOIS=03"] and len(spark.table(table).inputFiles()) == 5
    assert all("_compact_" in now[x] for x in done)
    assert rows(spark.table(table)) == before
    assert sinks.compact_partitions(spark, table, target_file_bytes=1 << 17) == []
    add([(str(i), "02") for i in range(50, 60)], 2)  # later appends meet the moved partition
    assert spark.table(table).where("MOIS = '02'").count() == 60
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_names_and_categories_by_hand(spark):
    """Expected values written out, not computed by the rules under test."""
    from tresoria.functions.text import normalise_name
    from tresoria.operators.labels import with_category
    names = {"Date Montant": "DATE_MONTANT", " Année ": "ANNEE", "Code-Flux (libellé)": "CODE_FLUX_LIBELLE", "Solde d'ouverture": "SOLDE_D_OUVERTURE",
             "Reçu...": "RECU", "Prêt": "PRÊT", "A / B": "A_B"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r["n"]: r["v"] for r in df.select("n", normalise_name("n").alias("v")).collect()} == names
    labels = {"Contributions principales": "recettes", "Total Dépenses": None, "Activité partielle": None, "inconnu": None, None: None}
    df = spark.createDataFrame([(n,) for n in labels], "nature_montant string")
    got = {r["nature_montant"]: r["categorie"] for r in with_category(df).collect()}
    assert set(got) == set(labels) and got["inconnu"] is None and got[None] is None and got["Contributions principales"] == "recettes"

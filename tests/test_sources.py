"""Workbook reader, CSV, discovery, sinks and streaming ingestion."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tresoria import constants as K
from tresoria.sources import sinks, tables, workbook
from tresoria.streaming import ingest
from tests.xlsx_writer import write_xlsx


def _forecast_sheet(amount_base):
    g = {}
    for c in range(1, 13):
        g[(1, c)] = K.MONTHS_FR[c - 1]
        g[(2, c)] = "Réalisé" if c <= 6 else "Prévu"
        for r in (3, 4):
            g[(r, c)] = amount_base + r * 100 + c + 0.25
    g.update({(3, 0): "Contributions", (4, 0): "Aides", (5, 0): "Variation de trésorerie"})
    return g


def _tmpdir():
    return tempfile.mkdtemp(prefix="tresoria-test-", dir="/tmp")


def test_decode_workbook_cells(spark):
    d = _tmpdir()
    p = os.path.join(d, "Equilibre Technique mensualisé 2021.06 - DEA.xlsx")
    write_xlsx(p, [("2020", _forecast_sheet(0)), ("2021", {(1, 1): dt.date(2021, 3, 1), (2, 0): "x"})])
    cells = workbook.workbook_cells(spark, d)
    got = {(r["sheet"], r["sheet_no"], r["r"], r["c"]): r["v"] for r in cells.collect()}
    assert got[("2020", 1, -1, 1)] == "janvier"
    assert got[("2020", 1, 1, 3)] == "303.25"
    assert got[("2021", 2, -1, 1)] == "2021-03-01"
    assert got[("2021", 2, 0, 0)] == "x"


def test_workbook_to_forecast_fact(spark):
    from tresoria.operators.cells import ingest_forecast
    d = _tmpdir()
    write_xlsx(os.path.join(d, "Equilibre Technique mensualisé 2021.06 - DEA.xlsx"),
               [("2020", _forecast_sheet(0)), ("2021", _forecast_sheet(1000))])
    fact = ingest_forecast(workbook.workbook_cells(spark, d), "multi")
    assert fact.count() == 2 * 2 * 12
    row = fact.where("annee = '2021' AND mois = '02' AND nature_montant = 'Aides'").first()
    assert (row["version_prev"], row["type_montant"], row["montant_millions"]) == ("2021-06", "Réalisé", "1402.25")


def test_csv_and_discovery(spark):
    d = _tmpdir()
    os.makedirs(os.path.join(d, "sub"))
    with open(os.path.join(d, "sub", "export.csv"), "w") as f:
        f.write("DATE_MONTANT;MONTANT\n2024/01/02;1.5\n2024/01/03;n/a\n")
    for n in ("a DFT 1.xlsx", "b DFT 2.xlsx", "c.xlsx"):
        write_xlsx(os.path.join(d, "sub", n), [("s", {(1, 0): "x"})])
    df = tables.read_csv_table(spark, os.path.join(d, "sub", "export.csv"))
    assert df.columns == ["DATE_MONTANT", "MONTANT"] and df.count() == 2
    files = tables.discover_files(spark, d, "*.xlsx", name_contains="DFT", exclude=["a DFT 1.xlsx"])
    assert [r["name"] for r in files.collect()] == ["b DFT 2.xlsx"]


def test_sinks_roundtrip_and_compaction(spark):
    d = _tmpdir()
    df = spark.createDataFrame([("Été Prévu (n.1)", "a\nb", 1.5), ("x", "nan", None)], "`Été Prévu (n.1)` string, t string, m double")
    sinks.write_overwrite(df, d + "/t", load_date="2024-01-31")
    sinks.write_append(df, d + "/t", load_date="2024-01-31")
    back = spark.read.parquet(d + "/t")
    assert back.columns == ["ETE_PREVU_N1", "T", "M", "DATE_EXTRACTION"]
    assert sorted(r["T"] or "-" for r in back.collect()) == ["-", "-", "a b", "a b"]
    comp = sinks.compact(spark, d + "/t", d + "/t2", target_file_bytes=1 << 30)
    assert sorted(map(tuple, comp.collect())) == sorted(map(tuple, back.collect()))
    assert len([f for f in os.listdir(d + "/t2") if f.endswith(".parquet")]) == 1


def test_consolidate_is_bag_union(spark):
    a = spark.createDataFrame([(1, "x")], "id int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None)], "id int, s string").drop("s")
    out = sinks.consolidate(a, b)
    assert out.count() == 3 and sorted(r["id"] for r in out.collect()) == [1, 1, 2]


def test_streaming_ingest_reads_each_workbook_once(spark):
    src, sink, ck = _tmpdir(), _tmpdir(), _tmpdir()
    write_xlsx(os.path.join(src, "Equilibre Technique mensualisé 2021.06 - DEA.xlsx"), [("2020", _forecast_sheet(0))])
    q = ingest.start_ingest(spark, src, sink + "/fact", ck + "/ck", layout="multi", load_date="2024-01-31")
    q.awaitTermination(120)
    first = ingest.read_ingested(spark, sink + "/fact")
    assert first.count() == 24
    write_xlsx(os.path.join(src, "Equilibre Technique mensualisé 2021.08 - DEA.xlsx"), [("2021", _forecast_sheet(5))])
    q = ingest.start_ingest(spark, src, sink + "/fact", ck + "/ck", layout="multi", load_date="2024-01-31")
    q.awaitTermination(120)
    both = ingest.read_ingested(spark, sink + "/fact")
    assert both.count() == 48
    assert sorted(r[0] for r in both.select("VERSION_PREV").distinct().collect()) == ["2021-06", "2021-08"]


def test_new_workbooks_skip_manifest(spark):
    d = _tmpdir()
    for n in ("Equilibre Technique mensualisé 2021.06 - DEA.xlsx", "Equilibre Technique mensualisé 2021.08 - DEA.xlsx"):
        write_xlsx(os.path.join(d, n), [("2020", _forecast_sheet(0))])
    manifest = spark.createDataFrame([("Equilibre Technique mensualisé 2021.06 - DEA.xlsx",)], "name string")
    cells = workbook.new_workbook_cells(spark, d, manifest)
    files = {r["file"].rsplit("/", 1)[-1] for r in cells.select("file").distinct().collect()}
    assert files == {"Equilibre Technique mensualisé 2021.08 - DEA.xlsx"}
    all_done = spark.createDataFrame([(n,) for n in files] + [("Equilibre Technique mensualisé 2021.06 - DEA.xlsx",)], "name string")
    assert workbook.new_workbook_cells(spark, d, all_done).count() == 0


def test_streaming_adjustments(spark):
    src, sink, ck = _tmpdir(), _tmpdir(), _tmpdir()
    g = {(1, c): dt.date(2021, c, 1) for c in range(1, 4)}
    g.update({(1, 4): "Commentaire", (2, 0): "Retraitements", (3, 0): "Raisons",
              (2, 1): 10.5, (2, 3): 30, (3, 1): "décalage", (3, 3): "report"})
    write_xlsx(os.path.join(src, "Previsions DFT 2021.06.xlsx"), [("2021", g)])
    q = ingest.start_ingest(spark, src, sink + "/adj", ck + "/ck", layout="adjustments", load_date="2024-01-31")
    q.awaitTermination(120)
    out = sorted(tuple(r) for r in ingest.read_ingested(spark, sink + "/adj")
                 .select("MOIS", "MONTANT_RETRAITEMENT", "RAISON").collect())
    assert out == [("01", "10.5", "décalage"), ("03", "30", "report")]


def test_compact_catalog_table_swaps_location(spark):
    d = _tmpdir()
    df = spark.createDataFrame([(i, f"x{i}") for i in range(50)], "id int, s string")
    spark.sql("DROP TABLE IF EXISTS tresoria_compact_t")
    sinks.write_overwrite(df.repartition(5), d + "/t", table="tresoria_compact_t", load_date="2024-01-31")
    before = sorted(map(tuple, spark.table("tresoria_compact_t").collect()))
    new = sinks.compact_table(spark, "tresoria_compact_t", target_file_bytes=1 << 30)
    assert sinks.table_location(spark, "tresoria_compact_t").rstrip("/").endswith(new.rsplit("/", 1)[-1])
    assert sorted(map(tuple, spark.table("tresoria_compact_t").collect())) == before
    assert len([f for f in os.listdir(new.replace("file:", "")) if f.endswith(".parquet")]) == 1
    spark.sql("DROP TABLE IF EXISTS tresoria_compact_t")


def test_decode_rich_text_and_iso_dates():
    import io
    import zipfile
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} {rns}><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="x" Target="/xl/worksheets/s1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}><si><r><t>Solde </t></r><r><t>final</t></r>'
                                            '<rPh><t>ignored</t></rPh></si></sst>')
        z.writestr("xl/worksheets/s1.xml", f'<worksheet {ns}><sheetData><row r="1">'
                                           '<c r="A1" t="s"><v>0</v></c><c r="B1" t="d"><v>2021-03-01T00:00:00</v></c>'
                                           '<c r="C1" t="inlineStr"><is><t>abc</t></is></c><c r="D1"><f>1+1</f><v>2</v></c>'
                                           '</row></sheetData></worksheet>')
    cells = sorted(workbook.decode_workbook("x.xlsx", buf.getvalue()))
    assert cells == [("S", 1, -1, 0, "Solde final"), ("S", 1, -1, 1, "2021-03-01"),
                     ("S", 1, -1, 2, "abc"), ("S", 1, -1, 3, "2")]


def test_append_creates_then_adds_to_catalog_table(spark):
    d = _tmpdir()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    spark.sql("DROP TABLE IF EXISTS tresoria_append_t")
    sinks.write_append(df, d + "/t", table="tresoria_append_t", load_date="2024-01-31")
    sinks.write_append(df, d + "/t", table="tresoria_append_t", load_date="2024-02-29")
    back = spark.table("tresoria_append_t")
    assert back.count() == 4
    assert sorted(r[0] for r in back.select("DATE_EXTRACTION").distinct().collect()) == ["2024-01-31", "2024-02-29"]
    spark.sql("DROP TABLE IF EXISTS tresoria_append_t")


def test_catalog_ledger_roundtrip_report(spark):
    import __spark_entry__ as E
    from tresoria import fixtures
    from tresoria.plans import reports
    sf = "/root/testdata/sf0.001"
    d = _tmpdir()
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_reporting_treso")
    spark.sql("DROP TABLE IF EXISTS raw_reporting_treso.export_sage_code_flux_historique")
    sinks.write_overwrite(fixtures.view(spark, sf, "ledger"), d + "/ledger",
                          table="raw_reporting_treso.export_sage_code_flux_historique", load_date="2024-01-31")
    stored = tables.ledger_table(spark, "raw_reporting_treso", "flux")
    got = reports.balance(stored, "M", accounts=None)
    want = E.queries()["balance_month"](spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    spark.sql("DROP TABLE IF EXISTS raw_reporting_treso.export_sage_code_flux_historique")


def test_compaction_of_a_partitioned_table_keeps_text_and_is_read(spark):
    """Partition values '01', '02' stay text, a NULL value survives, the table reads the new files."""
    d = _tmpdir()
    rows_ = [(f"v{i}", None if i % 7 == 0 else f"{1 + i % 3:02d}") for i in range(400)]
    spark.sql("DROP TABLE IF EXISTS tresoria_part_t")
    for half in (0, 1):
        df = spark.createDataFrame(rows_[half::2], "NATURE string, MOIS string").repartition(5)
        sinks.write_append(df, d + "/t", table="tresoria_part_t", load_date="2024-01-31", partition_by=["MOIS"])
    before = sorted(map(tuple, spark.table("tresoria_part_t").select("NATURE", "MOIS").collect()), key=str)
    n_files = len(spark.table("tresoria_part_t").inputFiles())
    new = sinks.compact_table(spark, "tresoria_part_t")
    after = spark.table("tresoria_part_t")
    assert dict(after.dtypes)["MOIS"] == "string"
    assert sorted(map(tuple, after.select("NATURE", "MOIS").collect()), key=str) == before == sorted(rows_, key=str)
    assert len(after.inputFiles()) < n_files and all(new.rsplit("/", 1)[-1] in f for f in after.inputFiles())
    spark.sql("DROP TABLE IF EXISTS tresoria_part_t")


def test_load_workbooks_twice(spark):
    """The second run finds every workbook in the manifest and decodes none; a new one is loaded alone."""
    from tresoria.plans import loads
    d = _tmpdir()
    grid = {(1, c): f"2021-{c:02d}-01" for c in range(1, 5)}
    grid.update({(2, 0): "Retraitement", (3, 0): "Raison", (2, 1): "10", (3, 1): "r1"})
    os.makedirs(d + "/in")
    write_xlsx(d + "/in/a 2021.02.xlsx", [("S1", grid)])
    run = lambda: loads.load_workbooks(spark, d + "/in", "adjustments", d + "/t", d + "/m", load_date="2024-01-31")
    from tresoria.session import ensure_checkpoint_dir
    stages = lambda: os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:") + "/stages")
    spark.range(1).write.mode("overwrite").parquet(ensure_checkpoint_dir(spark) + "/stages/other")
    before = set(stages())
    assert (run(), run()) == (1, 0)
    assert set(stages()) == before  # a load leaves no stage behind, and nobody else's goes
    write_xlsx(d + "/in/b 2021.04.xlsx", [("S1", grid)])
    assert run() == 1 and spark.read.parquet(d + "/t").count() == 2
    assert loads.read_manifest(spark, d + "/m").count() == 2


def test_repeated_headers_get_a_suffix():
    from tresoria.sources.workbook import _suffixed
    cells = [("s", 1, -1, 0, "TOTAL"), ("s", 1, -1, 1, "janvier"), ("s", 1, -1, 2, "janvier"), ("s", 1, 0, 2, "janvier"),
             ("s", 1, -1, 3, "janvier"), ("t", 2, -1, 0, "janvier")]
    assert [v for *_, v in _suffixed(cells)] == ["TOTAL", "janvier", "janvier.1", "janvier", "janvier.2", "janvier"]


def test_scratch_folder_is_never_local_on_a_cluster(spark, monkeypatch):
    import pytest
    from tresoria import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())

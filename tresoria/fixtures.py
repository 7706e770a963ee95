"""Representative inputs derived from the driver's tables (see FIXTURES.md).

Each view is one SQL text that runs unchanged in Spark SQL and in DuckDB, so
the Spark operators and the SQL oracle read byte-identical inputs.  Base
tables are plain Parquet scans; Catalyst prunes them to the columns a view
uses and pushes the view's predicates into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

LEDGER_SQL = """
SELECT replace(CAST(DATE '2023-11-15' + CAST((event_id * 7919) % 120 AS INT) AS STRING), '-', '/') AS DATE_MONTANT,
       replace(CAST(DATE '2023-11-15' + CAST((event_id * 7919) % 120 + user_id % 3 AS INT) AS STRING), '-', '/') || ' 06:00:00' AS DATE_PRODUCTION_FICHIER,
       CASE user_id % 4 WHEN 0 THEN ' 107CDNB' WHEN 1 THEN ' 107CICA' ELSE 'Total' END AS BANQUE_COMPTE,
       CASE WHEN event_id % 2 = 0 THEN 'R' ELSE 'P' END AS TYPE_MONTANT,
       CASE event_type WHEN 'signup' THEN 'Solde Initial' WHEN 'error' THEN 'Solde avant Décision' WHEN 'view' THEN 'Solde Final'
            WHEN 'click' THEN CASE WHEN user_id % 3 = 0 THEN 'Recettes diverses' ELSE 'Recette principale' END
            ELSE CASE WHEN user_id % 3 = 0 THEN 'Dépenses allocataires' ELSE 'Dépenses tiers' END END AS CODE_FLUX_LIBELLE,
       CASE event_type WHEN 'signup' THEN 'Solde Initial' WHEN 'error' THEN 'Solde avant Décision' WHEN 'view' THEN 'Solde Final'
            WHEN 'click' THEN 'R0' || CAST(user_id % 3 AS STRING) ELSE 'D0' || CAST(user_id % 3 AS STRING) END AS CODE_BUDGETAIRE,
       CAST(value AS STRING) AS MONTANT,
       'export_' || CAST(event_id % 5 AS STRING) || '.csv' AS FICHIER
FROM events
"""

PREV_SQL = """
SELECT CAST(year(o_orderdate) AS STRING) || '-' || lpad(CAST(1 + o_orderkey % 12 AS STRING), 2, '0') AS VERSION_PREV,
       CAST(year(o_orderdate) AS STRING) AS ANNEE,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE lpad(CAST(month(o_orderdate) AS STRING), 2, '0') END AS MOIS,
       CASE WHEN o_orderkey % 50 = 0 THEN 'TOTAL' ELSE CASE month(o_orderdate) WHEN 1 THEN 'janvier' WHEN 2 THEN 'février' WHEN 3 THEN 'mars'
            WHEN 4 THEN 'avril' WHEN 5 THEN 'mai' WHEN 6 THEN 'juin' WHEN 7 THEN 'juillet' WHEN 8 THEN 'août' WHEN 9 THEN 'septembre'
            WHEN 10 THEN 'octobre' WHEN 11 THEN 'novembre' ELSE 'décembre' END END AS MOIS_NOM,
       CASE o_custkey % 12 WHEN 0 THEN 'ARE / AREF' WHEN 1 THEN 'Sécurité sociale (CSG, CRDS, maladie)' WHEN 2 THEN 'Etat - Prélèvement à la source'
            WHEN 3 THEN 'Contributions' WHEN 4 THEN '10% Pôle Emploi' WHEN 5 THEN '11% Pôle Emploi' WHEN 6 THEN 'Solde financier'
            WHEN 7 THEN 'Total Dépenses' WHEN 8 THEN 'Prélèvements sociaux' WHEN 9 THEN 'Aides' WHEN 10 THEN 'Allocations brutes'
            ELSE 'Intérêts nets sur emprunts' END AS NATURE_MONTANT,
       CASE o_orderstatus WHEN 'F' THEN 'Réalisé' WHEN 'P' THEN 'Prévu'
            ELSE CASE o_orderkey % 3 WHEN 0 THEN 'Observé' WHEN 1 THEN ' Réalisé Semi Déf' ELSE 'Estimé' END END AS TYPE_MONTANT,
       CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE -o_totalprice END AS STRING) END AS MONTANT_MILLIONS
FROM orders
"""

CELLS_SQL = """
WITH m AS (SELECT * FROM (VALUES (1,'janvier'),(2,'février'),(3,'mars'),(4,'avril'),(5,'mai'),(6,'juin'),(7,'juillet'),(8,'août'),
                                 (9,'septembre'),(10,'octobre'),(11,'novembre'),(12,'décembre')) AS t(c, mois_nom)),
     n AS (SELECT * FROM (VALUES (1,'Contributions'),(2,'Aides'),(3,NULL),(4,'Total Dépenses'),(5,'Variation de trésorerie'),(6,'Dette'),(8,'note hors tableau')) AS t(r, nature)),
     b AS (SELECT 'lot_' || CAST(CAST(floor(o_orderkey / 8000) AS INT) AS STRING) || '/Equilibre Technique mensualisé ' || CAST(2017 + o_orderkey % 5 AS STRING) || '.' || lpad(CAST(2 + 2 * (o_orderkey % 5) AS STRING), 2, '0') || ' - DEA.xlsx' AS file,
                  CAST(year(o_orderdate) AS STRING) AS sheet, CAST(1 + o_custkey % 9 AS INT) AS r, CAST(month(o_orderdate) AS INT) AS c,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS amt FROM orders),
     y AS (SELECT DISTINCT file, sheet FROM b)
SELECT file AS FILE, sheet AS SHEET, -1 AS R, c AS C, mois_nom AS V FROM y CROSS JOIN m
UNION ALL SELECT file, sheet, 0, c, CASE WHEN c <= 6 THEN 'Réalisé' ELSE 'Prévu' END FROM y CROSS JOIN m
UNION ALL SELECT file, sheet, r, 0, nature FROM y CROSS JOIN n WHERE nature IS NOT NULL
UNION ALL SELECT file, sheet, r, c, CAST(CAST(sum(amt) AS DECIMAL(18,2)) AS STRING) FROM b GROUP BY file, sheet, r, c
"""

CELLS_SINGLE_SQL = """
WITH m AS (SELECT * FROM (VALUES (1,'janvier'),(2,'février'),(3,'mars'),(4,'avril'),(5,'mai'),(6,'juin'),(7,'juillet'),(8,'août'),
                                 (9,'septembre'),(10,'octobre'),(11,'novembre'),(12,'décembre')) AS t(mm, mois_nom)),
     n AS (SELECT * FROM (VALUES (2,'Contributions'),(3,'Aides'),(4,NULL),(5,'Total Dépenses'),(6,'Variation de trésorerie')) AS t(r, nature)),
     b AS (SELECT 'lot_' || CAST(CAST(floor(o_orderkey / 8000) AS INT) AS STRING) || '/Equilibre Technique mensualisé 2021.' || lpad(CAST(2 + 2 * (o_orderkey % 5) AS STRING), 2, '0') || ' - DEA.xlsx' AS file,
                  CAST(year(o_orderdate) AS INT) AS yr, CAST(month(o_orderdate) AS INT) AS mm, CAST(2 + o_custkey % 5 AS INT) AS r,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS amt FROM orders),
     y AS (SELECT DISTINCT yr FROM b),
     y0 AS (SELECT min(yr) AS first_yr FROM b),
     h AS (SELECT f.file, y.yr, m.mm, m.mois_nom, (y.yr - y0.first_yr) * 12 + m.mm AS c, y0.first_yr FROM (SELECT DISTINCT file FROM b) f
           CROSS JOIN y CROSS JOIN y0 CROSS JOIN m)
SELECT file AS FILE, 'Feuil1' AS SHEET, -1 AS R, c AS C, CAST(yr AS STRING) AS V FROM h WHERE mm = 1
UNION ALL SELECT file, 'Feuil1', 0, c, mois_nom FROM h
UNION ALL SELECT file, 'Feuil1', 1, c, CASE WHEN yr = first_yr THEN 'Réalisé' ELSE 'Prévu' END FROM h
UNION ALL SELECT f.file, 'Feuil1', n.r, 0, n.nature FROM (SELECT DISTINCT file FROM b) f CROSS JOIN n WHERE nature IS NOT NULL
UNION ALL SELECT file, 'Feuil1', r, (yr - first_yr) * 12 + mm, CAST(CAST(sum(amt) AS DECIMAL(18,2)) AS STRING) FROM b CROSS JOIN y0 GROUP BY file, r, yr, mm, first_yr
"""

CELLS_ADJ_SQL = """
WITH b AS (SELECT 'lot_' || CAST(CAST(floor(o_orderkey / 8000) AS INT) AS STRING) || '/Previsions DFT 2021.' || lpad(CAST(2 + 2 * (o_orderkey % 5) AS STRING), 2, '0') || '.xlsx' AS file,
                  CAST(year(o_orderdate) AS STRING) AS sheet, CAST(month(o_orderdate) AS INT) AS c, CAST(o_custkey % 2 AS INT) AS pair,
                  CAST(o_totalprice AS DECIMAL(18,2)) AS amt FROM orders),
     s AS (SELECT file, sheet, dense_rank() OVER (PARTITION BY file ORDER BY sheet DESC) AS no FROM (SELECT DISTINCT file, sheet FROM b)),
     d AS (SELECT * FROM (VALUES (1),(2),(3),(4),(5),(6),(7),(8),(9),(10),(11),(12)) AS t(c)),
     l AS (SELECT * FROM (VALUES (1,'Retraitements'),(2,'Raisons'),(3,'Retraitements (suite)'),(4,'Raisons')) AS t(r, lab)),
     u AS (
SELECT file, sheet, -1 AS r, c, sheet || '-' || lpad(CAST(c AS STRING), 2, '0') || '-01' AS v FROM s CROSS JOIN d
UNION ALL SELECT file, sheet, -1, 13, 'Commentaire' FROM s
UNION ALL SELECT file, sheet, -1, 14, '2099-01-01' FROM s
UNION ALL SELECT file, sheet, r, 0, lab FROM s CROSS JOIN l
UNION ALL SELECT file, sheet, 1 + 2 * pair, c, CAST(CAST(sum(amt) AS DECIMAL(18,2)) AS STRING) FROM b GROUP BY file, sheet, pair, c
UNION ALL SELECT file, sheet, 2 + 2 * pair, c, 'décalage ' || CAST(count(*) AS STRING) FROM b GROUP BY file, sheet, pair, c
UNION ALL SELECT file, sheet, 1, 14, '1.00' FROM s)
SELECT u.file AS FILE, u.sheet AS SHEET, u.r AS R, u.c AS C, u.v AS V, CAST(s.no AS INT) AS SHEET_NO
FROM u JOIN s ON u.file = s.file AND u.sheet = s.sheet
"""

# Forecast workbooks whose labels stand in the second column, some of them in the first (the anchor's) only.
CELLS_SHIFT_SQL = f"""
SELECT FILE, SHEET, R, CAST(CASE WHEN C > 0 THEN C + 1 WHEN R IN (1, 4, 5) THEN 0 ELSE 1 END AS INT) AS C, V
FROM ({CELLS_SQL}) t
"""

# Adjustment workbooks with a title above: the dates stand in the second row of the sheet's body.
CELLS_ADJ_LOW_SQL = f"""
SELECT FILE, SHEET, CAST(R + 2 AS INT) AS R, C, V, SHEET_NO FROM ({CELLS_ADJ_SQL}) t
UNION ALL SELECT DISTINCT FILE, SHEET, -1, 0, 'Suivi mensuel', SHEET_NO FROM ({CELLS_ADJ_SQL}) t
"""

# File names with the date of an order in one of seven shapes, or none.
FILE_NAMES_SQL = """
SELECT DISTINCT 'DEA/Prévisions DEA mensualisées/lot ' || chr(CAST(97 + o_orderkey % 5 AS INT)) || '/Equilibre ' || CASE o_orderkey % 8
         WHEN 0 THEN y || '.' || lpad(m, 2, '0') || ' - DEA' WHEN 1 THEN y || ' ' || m WHEN 2 THEN d || '.' || lpad(m, 2, '0') || '.' || y
         WHEN 3 THEN lpad(m, 2, '0') || '-' || y WHEN 4 THEN y || '-' || lpad(m, 2, '0') || '-' || d WHEN 5 THEN d || lpad(m, 2, '0') || y
         WHEN 6 THEN lpad(m, 2, '0') || ' ' || d || ' ' || y ELSE 'Technique' END || '.xlsx' AS FILE,
       CASE WHEN o_orderkey % 8 = 7 THEN NULL ELSE y || '-' || lpad(m, 2, '0') END AS VERSION
FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS STRING) AS y, CAST(month(o_orderdate) AS STRING) AS m,
             CAST(13 + day(o_orderdate) % 16 AS STRING) AS d FROM orders) t
"""

# The dimension of codes: some of the ledger's, and some that the ledger does not have.
LABEL_DIM_SQL = """
SELECT DISTINCT CASE WHEN event_type = 'click' THEN 'r0' ELSE 'd0' END || CAST(2 * (user_id % 2) AS STRING) AS CODE_BUDGETAIRE,
       'Libellé ' || event_type || ' ' || CAST(user_id % 2 AS STRING) AS LIBELLE FROM events
UNION ALL SELECT DISTINCT CASE WHEN event_type = 'click' THEN 'R0' ELSE 'D0' END || CAST(2 * (user_id % 2) AS STRING), 'Libellé ' || event_type FROM events
UNION ALL SELECT DISTINCT 'R9' || CAST(user_id % 7 AS STRING), 'Code sans mouvement' FROM events
UNION ALL SELECT 'X' || CAST(max(user_id) AS STRING), NULL FROM events
"""

VIEWS = {
    "ledger": LEDGER_SQL,
    "prev": PREV_SQL,
    "cells": CELLS_SQL,
    "cells_single": CELLS_SINGLE_SQL,
    "cells_adj": CELLS_ADJ_SQL,
    "cells_shift": CELLS_SHIFT_SQL,
    "cells_adj_low": CELLS_ADJ_LOW_SQL,
    "file_names": FILE_NAMES_SQL,
    "label_dim": LABEL_DIM_SQL,
}


def register_base_tables(spark: SparkSession, sf_dir: str, names=None) -> None:
    for t in names or BASE_TABLES:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").createOrReplaceTempView(t)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture view as a lazy DataFrame over the Parquet tables of ``sf_dir``."""
    base = {"ledger": ["events"], "label_dim": ["events"]}.get(name, ["orders"])
    register_base_tables(spark, sf_dir, base)
    return spark.sql(VIEWS[name])

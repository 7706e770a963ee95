"""Independent ANSI/DuckDB SQL for every registered query.

Each text defines the fixture views it reads (``oracle_sql.ctes``) and
recomputes the result from the driver's base tables with plain SQL.  Money
is summed from the amounts' own text as DECIMAL(38,12), which cuts none of them,
then cast to DOUBLE: the result is independent of summation order.
"""

from __future__ import annotations

from tresoria import constants as K
from tresoria.fixtures import VIEWS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def ctes(**defs: str) -> str:
    """WITH clause: fixture views first (by name), then extra CTEs in order."""
    parts = []
    for name, body in defs.items():
        parts.append(f"{name} AS ({(VIEWS[name] if body is None else body).strip()})")
    return "WITH " + ",\n".join(parts) + "\n"


MONEY = "DECIMAL(38,12)"


def money(x: str) -> str:
    """An amount as an exact decimal: through its text, not through binary arithmetic."""
    return f"CAST(CAST({x} AS VARCHAR) AS {MONEY})"


def msum(x: str) -> str:
    return f"CAST(COALESCE(SUM({money(x)}), 0) AS DOUBLE)"


TYPED_LEDGER = """
SELECT CAST(COALESCE(try_strptime(DATE_MONTANT, '%Y/%m/%d'), try_strptime(DATE_MONTANT, '%Y-%m-%d')) AS DATE) AS date_montant,
       COALESCE(try_strptime(DATE_PRODUCTION_FICHIER, '%Y/%m/%d %H:%M:%S'),
                try_strptime(DATE_PRODUCTION_FICHIER, '%Y-%m-%d %H:%M:%S')) AS date_production_fichier,
       BANQUE_COMPTE AS banque_compte, TYPE_MONTANT AS type_montant,
       CODE_FLUX_LIBELLE AS code_flux_libelle, CODE_BUDGETAIRE AS code_budgetaire,
       TRY_CAST(MONTANT AS DOUBLE) AS montant, FICHIER AS fichier
FROM ledger"""

SAGE = """
SELECT t.*, CAST(year(date_montant) AS INTEGER) AS annee,
       strftime(date_montant, '%Y-%m') AS annee_mois,
       strftime(date_montant, '%Y-%U') AS annee_semaine,
       CAST(year(date_montant) AS VARCHAR) || '-T' || CAST(quarter(date_montant) AS VARCHAR) AS trimestre
FROM typed t
WHERE (date_montant, banque_compte, date_production_fichier) IN (
    SELECT date_montant, banque_compte, max(date_production_fichier) FROM typed
    WHERE date_montant IS NOT NULL AND banque_compte IS NOT NULL GROUP BY 1, 2)"""


def ledger_ctes(**more: str) -> str:
    return ctes(ledger=None, typed=TYPED_LEDGER, sage=SAGE, **more)


PERIOD = {"S": "annee_semaine", "M": "annee_mois", "T": "trimestre", "A": "annee"}


def sum_by_sql(src: str, freq: str, by: str) -> str:
    """SQL twin of periods._sum_by over relation ``src``."""
    p = PERIOD[freq]
    if freq != "S":
        return (f"SELECT {p}, {by}, {msum('montant')} AS montant FROM {src} "
                f"WHERE {p} IS NOT NULL AND {by} IS NOT NULL GROUP BY {p}, {by}")
    return (f"SELECT s.{p}, s.{by}, s.montant, w.date_montant FROM "
            f"(SELECT {p}, {by}, {msum('montant')} AS montant FROM {src} "
            f"WHERE {p} IS NOT NULL AND {by} IS NOT NULL GROUP BY {p}, {by}) s "
            f"JOIN (SELECT {p}, min(date_montant) AS date_montant FROM {src} WHERE {p} IS NOT NULL GROUP BY {p}) w "
            f"ON s.{p} = w.{p}")


def balance_sql(freq: str, grain_col: str = "code_flux_libelle") -> str:
    base = ledger_ctes(bal=f"SELECT * FROM sage WHERE {grain_col} = {q(K.BALANCE_LABEL)}")
    if freq == "J":
        return base + "SELECT date_montant, banque_compte, montant FROM bal"
    return base + sum_by_sql("bal", freq, "banque_compte")


def flow_labels_sql(kind: str, grain: str) -> str:
    if grain == "flux":
        mark = K.RECEIPT_MARK if kind == "recettes" else K.SPENDING_MARK
        return (f"SELECT DISTINCT code_flux_libelle FROM sage WHERE type_montant = {q(K.LEDGER_REALISED_TYPE)} "
                f"AND contains(code_flux_libelle, {q(mark)})")
    letter = "R" if kind == "recettes" else "D"
    return (f"SELECT DISTINCT code_budgetaire FROM (SELECT DISTINCT CODE_BUDGETAIRE AS code_budgetaire FROM ledger) "
            f"WHERE upper(substr(code_budgetaire, 1, 1)) = {q(letter)}")


def flows_sql(kind: str, grain: str, freq: str) -> str:
    lab = "code_flux_libelle" if grain == "flux" else "code_budgetaire"
    base = ledger_ctes(
        labs=flow_labels_sql(kind, grain),
        fl=f"SELECT * FROM sage WHERE banque_compte = {q(K.CONSOLIDATED_ACCOUNT)} AND {lab} IN (SELECT {lab} FROM labs)")
    if freq == "J":
        return base + f"SELECT date_montant, {lab}, montant FROM fl"
    return base + sum_by_sql("fl", freq, lab)


def flow_extremes_sql(grain: str = "flux") -> str:
    lab = "code_flux_libelle" if grain == "flux" else "code_budgetaire"
    per = " UNION ALL ".join([
        "SELECT kind, 'J' AS frequence, CAST(date_montant AS VARCHAR) AS periode, total FROM daily",
        "SELECT kind, 'S', strftime(date_montant, '%Y-%U'), total FROM daily",
        "SELECT kind, 'M', strftime(date_montant, '%Y-%m'), total FROM daily",
        "SELECT kind, 'T', CAST(year(date_montant) AS VARCHAR) || '-T' || CAST(quarter(date_montant) AS VARCHAR), total FROM daily",
        "SELECT kind, 'A', CAST(year(date_montant) AS VARCHAR), total FROM daily",
    ])
    return ledger_ctes(
        lt=(f"SELECT 'recettes' AS kind, {lab} FROM ({flow_labels_sql('recettes', grain)}) "
            f"UNION ALL SELECT 'depenses', {lab} FROM ({flow_labels_sql('depenses', grain)})"),
        daily=(f"SELECT lt.kind, s.date_montant, COALESCE(SUM({money("s.montant")}), 0) AS total "
               f"FROM sage s JOIN lt ON s.{lab} = lt.{lab} "
               f"WHERE s.banque_compte = {q(K.CONSOLIDATED_ACCOUNT)} AND s.date_montant IS NOT NULL GROUP BY 1, 2"),
        per=per,
        tot="SELECT kind, frequence, periode, SUM(total) AS t FROM per GROUP BY 1, 2, 3",
        ext=("SELECT kind, frequence, CAST(max(t) AS DOUBLE) AS max_total, CAST(min(t) AS DOUBLE) AS min_total "
             "FROM tot GROUP BY 1, 2"),
    )


def kpi_sql(lag: int, accounts=(K.CONSOLIDATED_ACCOUNT,)) -> str:
    labels = " UNION ALL ".join(f"SELECT {i} AS ord, {q(n)} AS libelle" for i, n in enumerate(K.KPI_LABELS))
    return ledger_ctes(
        e="SELECT max(date_montant) AS d FROM sage",
        k=(f"SELECT code_flux_libelle, date_montant, montant FROM sage WHERE code_flux_libelle IN {in_list(K.KPI_LABELS)} "
           f"AND banque_compte IN {in_list(accounts)}"),
        l=labels,
        v=(f"SELECT l.libelle, "
           f"(SELECT min(montant) FROM k, e WHERE k.code_flux_libelle = l.libelle AND k.date_montant = e.d) AS montant_fin, "
           f"(SELECT min(montant) FROM k, e WHERE k.code_flux_libelle = l.libelle "
           f"AND k.date_montant = CAST(e.d - INTERVAL {lag} DAY AS DATE)) AS montant_debut FROM l"),
        kp=("SELECT libelle, montant_fin, montant_debut, CASE WHEN montant_debut <> 0 THEN "
            "CAST(100 AS DOUBLE) * (montant_fin - montant_debut) / montant_debut END AS evolution_pct FROM v"),
    )


KPI_TEXT_SELECT = r"""
SELECT libelle,
       CASE WHEN montant_fin IS NULL THEN NULL ELSE
         replace(regexp_replace(format('{:,.0f}', montant_fin), '^-0$', '0'), ',', ' ') || ' €' END AS valeur,
       CASE WHEN evolution_pct IS NULL THEN NULL ELSE
         replace(regexp_replace(format('{:,.2f}', evolution_pct), '(\.[0-9])0$', '\1'), ',', ' ') || ' %' END AS evolution
FROM kp"""


# ------------------------------------------------------------- forecast ---

TYPED_PREV = """
SELECT VERSION_PREV AS version_prev, ANNEE AS annee, MOIS AS mois, MOIS_NOM AS mois_nom,
       NATURE_MONTANT AS nature_montant, TYPE_MONTANT AS type_montant,
       TRY_CAST(MONTANT_MILLIONS AS DOUBLE) AS montant_millions
FROM prev"""


def _harm_sql() -> str:
    renames = " ".join(f"WHEN {q(a)} THEN {q(b)}" for a, b in K.LABEL_RULES)
    signed = " ".join(
        f"WHEN r = {q(src)} AND montant_millions < 0 THEN {q(neg)} "
        f"WHEN r = {q(src)} AND montant_millions >= 0 THEN {q(pos)}"
        for src, neg, pos in K.SIGNED_LABEL_RULES)
    return (f"SELECT version_prev, annee, mois, mois_nom, CASE {signed} ELSE r END AS nature_montant, "
            f"type_montant, montant_millions FROM (SELECT *, CASE nature_montant {renames} "
            f"ELSE nature_montant END AS r FROM typedp)")




def _latest_sql() -> str:
    real = in_list(K.REALISED_TYPES)
    return (f"SELECT * FROM harm WHERE type_montant IN {real} AND "
            f"(annee, mois, mois_nom, type_montant, nature_montant, version_prev) IN ("
            f"SELECT annee, mois, mois_nom, type_montant, nature_montant, max(version_prev) FROM harm "
            f"WHERE type_montant IN {real} AND annee IS NOT NULL AND mois IS NOT NULL AND mois_nom IS NOT NULL "
            f"AND type_montant IS NOT NULL AND nature_montant IS NOT NULL GROUP BY 1, 2, 3, 4, 5) "
            f"UNION ALL SELECT * FROM harm WHERE type_montant = {q(K.FORECAST_TYPE)}")


CLEAN_PREV = f"""
SELECT version_prev, TRY_CAST(annee AS INTEGER) AS annee, mois, mois_nom, nature_montant, type_montant,
       montant_millions, annee || '-' || mois AS annee_mois,
       annee || '-T' || CAST(CAST(ceil(TRY_CAST(mois AS INTEGER) / 3) AS INTEGER) AS VARCHAR) AS trimestre
FROM lat WHERE mois_nom NOT IN {in_list(K.TOTAL_MONTH_NAMES)} OR mois_nom IS NULL"""


def prev_ctes(**more: str) -> str:
    return ctes(prev=None, typedp=TYPED_PREV, harm=_harm_sql(), lat=_latest_sql(), cleanp=CLEAN_PREV, **more)


def values_sql(rows, names) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else q(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(names)})"


def _side(name: str, cond: str, period: str) -> str:
    return (f"SELECT categorie, {period}, COALESCE(SUM({money("montant_millions")}), 0) AS s, "
            f"SUM(COALESCE(SUM({money("montant_millions")}), 0)) OVER (PARTITION BY categorie ORDER BY {period} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c "
            f"FROM cleanp JOIN l2c USING (nature_montant) WHERE {cond} AND {period} IS NOT NULL GROUP BY categorie, {period}")


def label_reports_sql(annee: int, version: str, freq: str = "M") -> str:
    """Every label against one forecast version (no sign flip)."""
    period = "annee_mois" if freq == "M" else "trimestre"
    real = f"type_montant IN {in_list(K.REALISED_TYPES)} AND annee = {annee}"
    prv = f"type_montant = {q(K.FORECAST_TYPE)} AND annee = {annee} AND version_prev = {q(version)}"
    l2c = "SELECT DISTINCT nature_montant, nature_montant AS categorie FROM cleanp WHERE nature_montant IS NOT NULL"
    body = (f"SELECT COALESCE(r.{period}, p.{period}) AS {period}, COALESCE(r.categorie, p.categorie) AS nature_montant, "
            f"CAST(r.s AS DOUBLE) AS montant_realise, CAST(p.s AS DOUBLE) AS montant_prevu, "
            f"CAST(r.c AS DOUBLE) AS cumul_realise, CAST(p.c AS DOUBLE) AS cumul_prevu "
            f"FROM r FULL OUTER JOIN p ON r.categorie = p.categorie AND r.{period} = p.{period}")
    return prev_ctes(l2c=l2c, r=_side("r", real, period), p=_side("p", prv, period)) + body


def flux_report_sql(annee: int, version: str, freq: str = "M", label: str | None = None) -> str:
    period = "annee_mois" if freq == "M" else "trimestre"
    if label is None:
        l2c = values_sql([(lab, cat) for cat, labs, _ in K.FLOW_CATEGORIES for lab in labs],
                         ["nature_montant", "categorie"])
        signs = values_sql([(cat, s) for cat, _, s in K.FLOW_CATEGORIES], ["categorie", "signe"])
    else:
        l2c = values_sql([(label, "nature")], ["nature_montant", "categorie"])
        signs = values_sql([("nature", 1)], ["categorie", "signe"])
    real = f"type_montant IN {in_list(K.REALISED_TYPES)} AND annee = {annee}"
    prv = f"type_montant = {q(K.FORECAST_TYPE)} AND annee = {annee} AND version_prev = {q(version)}"
    body = (f"SELECT COALESCE(r.{period}, p.{period}) AS {period}, sg.categorie AS type, "
            f"CAST(sg.signe * r.s AS DOUBLE) AS montant_realise, CAST(sg.signe * p.s AS DOUBLE) AS montant_prevu, "
            f"CAST(sg.signe * r.c AS DOUBLE) AS cumul_realise, CAST(sg.signe * p.c AS DOUBLE) AS cumul_prevu "
            f"FROM r FULL OUTER JOIN p ON r.categorie = p.categorie AND r.{period} = p.{period} "
            f"JOIN signs sg ON sg.categorie = COALESCE(r.categorie, p.categorie)")
    sql = prev_ctes(l2c=l2c, signs=signs, r=_side("r", real, period), p=_side("p", prv, period)) + body
    if label is not None:
        sql = (f"SELECT {period}, montant_realise, montant_prevu, cumul_realise, cumul_prevu FROM ("
               + sql + ")")
    return sql


RUNNING_TOTALS = f"""
SELECT cote, nature_montant, annee, version, annee_mois, CAST(m AS DOUBLE) AS montant,
       CAST(SUM(m) OVER (PARTITION BY cote, nature_montant, annee, version ORDER BY annee_mois
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS cumul
FROM (SELECT CASE WHEN type_montant IN {in_list(K.REALISED_TYPES)} THEN 'realise' ELSE 'prevu' END AS cote,
             nature_montant, annee,
             CASE WHEN type_montant IN {in_list(K.REALISED_TYPES)} THEN NULL ELSE version_prev END AS version,
             annee_mois, COALESCE(SUM({money("montant_millions")}), 0) AS m
      FROM cleanp
      WHERE (type_montant IN {in_list(K.REALISED_TYPES)} OR type_montant = {q(K.FORECAST_TYPE)})
        AND annee_mois IS NOT NULL AND nature_montant IS NOT NULL AND annee IS NOT NULL
      GROUP BY 1, 2, 3, 4, 5)"""


# ---------------------------------------------------------------- cells ---

def _re_alt(words) -> str:
    return "|".join(words)


def cells_base(view: str) -> dict:
    return {view: None,
            "cl": f"SELECT FILE AS file, SHEET AS sheet, R AS r, C AS c, V AS v, "
                  f"regexp_matches(V, '^[ \\t]*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?[ \\t]*$') AS num FROM {view}"}


def bounds_ctes(view: str) -> dict:
    d = cells_base(view)
    aggs = ["COALESCE(max(CASE WHEN r >= 0 THEN r END), -1) + 1 AS n_lignes", "max(c) + 1 AS n_cols"]
    for k in range(3):
        aggs.append(f"COALESCE(bool_or(c = {k} AND r >= 0 AND NOT num), false) AS cap{k}")
        for j, t in enumerate(K.ANCHOR_TEXTS):
            aggs.append(f"min(CASE WHEN c = {k} AND r >= 0 AND contains(lower(v), {q(t)}) THEN r END) AS m{k}_{j}")
    d["an"] = f"SELECT file, sheet, {', '.join(aggs)} FROM cl GROUP BY file, sheet"
    chain = " ".join(f"WHEN NOT cap{k} THEN NULL WHEN COALESCE(m{k}_0, m{k}_1) IS NOT NULL THEN {k}" for k in range(3))
    stop = " ".join(f"WHEN {k} THEN COALESCE(m{k}_0, m{k}_1) + 2" for k in range(3))
    d["an2"] = f"SELECT file, sheet, n_lignes, n_cols, CASE {chain} END AS ancre FROM an"
    d["an3"] = (f"SELECT an2.*, CASE an2.ancre {stop} END AS arret FROM an2 JOIN an USING (file, sheet)")
    months = _re_alt(K.MONTH_COLUMN_WORDS)
    d["st"] = (f"SELECT cl.file, cl.sheet, cl.c, a.arret, a.n_lignes, "
               f"count(*) FILTER (WHERE num) AS n_num, count(*) FILTER (WHERE NOT num) AS n_txt, "
               f"bool_or(r = -1) AS has_head, COALESCE(bool_or(r = -1 AND num), false) AS head_num, "
               f"count(*) FILTER (WHERE r >= 0) AS n_body, "
               f"bool_or(regexp_matches(lower(v), {q(months)})) AS has_month "
               f"FROM cl JOIN an3 a USING (file, sheet) WHERE a.ancre IS NOT NULL AND cl.r < a.arret "
               f"GROUP BY cl.file, cl.sheet, cl.c, a.arret, a.n_lignes")
    d["st2"] = ("SELECT file, sheet, c, "
                "(n_num > n_txt + CASE WHEN has_head THEN 0 ELSE 1 END AND n_num > least(arret, n_lignes) - n_body) AS is_float, "
                "has_month, (head_num AND n_num = least(arret, n_lignes) + 1) AS all_numeric FROM st")
    d["fl"] = "SELECT file, sheet, min(c) AS run_min FROM st2 WHERE is_float GROUP BY file, sheet"
    d["fe"] = ("SELECT s.file, s.sheet, min(s.c) AS run_max FROM st2 s JOIN fl USING (file, sheet) "
               "WHERE s.is_float AND s.c >= fl.run_min AND NOT EXISTS (SELECT 1 FROM st2 t WHERE t.file = s.file "
               "AND t.sheet = s.sheet AND t.c = s.c + 1 AND t.is_float) GROUP BY s.file, s.sheet")
    d["run"] = ("SELECT file, sheet, run_min, run_max, CAST(run_max - run_min + 1 AS BIGINT) AS run_len "
                "FROM fl JOIN fe USING (file, sheet)")
    d["mo"] = ("SELECT s.file, s.sheet, min(s.c) + 1 AS first_ml FROM st2 s WHERE s.has_month AND s.c >= 11 "
               "AND EXISTS (SELECT 1 FROM st2 e WHERE e.file = s.file AND e.sheet = s.sheet AND e.c = 11 AND e.has_month) "
               "AND NOT EXISTS (SELECT 1 FROM st2 t WHERE t.file = s.file AND t.sheet = s.sheet AND t.c = s.c + 1 "
               "AND t.has_month) GROUP BY s.file, s.sheet")
    d["bad"] = "SELECT file, sheet, bool_or(all_numeric) AS any_all_num FROM st2 GROUP BY file, sheet"
    d["okt"] = ("SELECT an3.*, run.run_min, run.run_max, COALESCE(mo.first_ml, 11) AS first_ml, "
                "COALESCE(an3.ancre IS NOT NULL AND run.run_len >= 2 AND run.run_min >= 1 AND an3.n_cols >= 11 "
                "AND NOT COALESCE(bad.any_all_num, false), false) AS ok "
                "FROM an3 LEFT JOIN run USING (file, sheet) LEFT JOIN mo USING (file, sheet) LEFT JOIN bad USING (file, sheet)")
    d["bnd"] = ("SELECT file, sheet, CASE WHEN ok THEN ancre ELSE 0 END AS ancre, "
                "CASE WHEN ok THEN arret ELSE n_lignes END AS ligne_fin, "
                "CASE WHEN ok THEN run_min - 1 ELSE 0 END AS col_debut, "
                "CASE WHEN ok THEN least(run_max + 1, first_ml) ELSE n_cols END AS col_fin, NOT ok AS repli FROM okt")
    d["cr"] = ("SELECT cl.file, cl.sheet, cl.r, cl.c, cl.v, b.col_debut, b.col_fin FROM cl JOIN bnd b USING (file, sheet) "
               "WHERE cl.r < b.ligne_fin AND cl.c >= b.col_debut AND cl.c < b.col_fin "
               "UNION ALL SELECT a.file, a.sheet, a.r, b.col_debut, a.v, b.col_debut, b.col_fin FROM cl a JOIN bnd b "
               "USING (file, sheet) WHERE a.c = b.ancre AND b.ancre <> b.col_debut AND a.r >= 0 AND a.r < b.ligne_fin "
               "AND NOT EXISTS (SELECT 1 FROM cl x WHERE x.file = a.file AND x.sheet = a.sheet AND x.r = a.r "
               "AND x.c = b.col_debut)")
    return d


def _unpivot_ctes(first_row: int, heads: dict) -> dict:
    hsel = ", ".join(f"max(CASE WHEN r = {row} THEN v END) AS {name}" for name, row in heads.items())
    return {
        "meta": f"SELECT file, sheet, c, {hsel} FROM cr WHERE c > col_debut AND r < {first_row} GROUP BY file, sheet, c",
        "lab": f"SELECT file, sheet, r, v AS label FROM cr WHERE c = col_debut AND r >= {first_row}",
        "vals": f"SELECT file, sheet, r, c, v AS montant FROM cr WHERE c > col_debut AND r >= {first_row}",
    }


def unpivot_multi_ctes(view: str = "cells") -> dict:
    d = bounds_ctes(view)
    d.update(_unpivot_ctes(1, {"mois_nom": -1, "type_montant": 0}))
    d["lng"] = ("SELECT v.file, v.sheet, v.r, v.c, v.sheet AS annee, "
                "COALESCE(m.mois_nom, 'Unnamed: ' || CAST(v.c AS VARCHAR)) AS mois_nom, m.type_montant, l.label, v.montant "
                "FROM vals v LEFT JOIN meta m USING (file, sheet, c) LEFT JOIN lab l USING (file, sheet, r)")
    return d


def unpivot_single_ctes(view: str = "cells_single") -> dict:
    d = bounds_ctes(view)
    d.update(_unpivot_ctes(2, {"mois_nom": 0, "type_montant": 1}))
    d["ym"] = ("SELECT file, sheet, c, max(CASE WHEN r = -1 THEN v END) AS entete, "
               "max(CASE WHEN r = 0 THEN v END) AS mois_nom FROM cr WHERE c > col_debut AND r <= 0 GROUP BY file, sheet, c")
    d["yf"] = ("SELECT m.file, m.sheet, m.c, COALESCE((SELECT j.entete FROM ym j WHERE j.file = m.file AND j.sheet = m.sheet "
               "AND j.entete IS NOT NULL AND j.c <= m.c ORDER BY j.c DESC LIMIT 1), "
               "'Unnamed: ' || CAST(m.c AS VARCHAR)) AS annee FROM ym m")
    d["lng"] = ("SELECT v.file, v.sheet, v.r, v.c, y.annee, m.mois_nom, m.type_montant, l.label, v.montant "
                "FROM vals v LEFT JOIN meta m USING (file, sheet, c) LEFT JOIN lab l USING (file, sheet, r) "
                "LEFT JOIN yf y USING (file, sheet, c)")
    return d


YM_RE = "(^|[^0-9])([0-9]{4})[ .-]([0-9]{2})([^0-9]|$)"
DMY_RE = "(^|[^0-9])([0-9]{2})([0-9]{2})([0-9]{4})([^0-9]|$)"


def version_sql(x: str) -> str:
    n = f"regexp_replace({x}, '^.*mensualisées/', '')"

    def g(rx, i):
        return f"regexp_extract({n}, {q(rx)}, {i})"
    return (f"COALESCE(CASE WHEN {g(YM_RE, 2)} <> '' AND TRY_CAST({g(YM_RE, 3)} AS INTEGER) BETWEEN 1 AND 12 "
            f"THEN {g(YM_RE, 2)} || '-' || {g(YM_RE, 3)} END, "
            f"CASE WHEN {g(DMY_RE, 4)} <> '' AND TRY_CAST({g(DMY_RE, 3)} AS INTEGER) BETWEEN 1 AND 12 "
            f"THEN {g(DMY_RE, 4)} || '-' || {g(DMY_RE, 3)} END)")


def month_num_sql(x: str) -> str:
    return "CASE " + x + " " + " ".join(f"WHEN {q(n)} THEN '{i:02d}'" for i, n in enumerate(K.MONTHS_FR, 1)) + " END"


def month_name_sql(x: str) -> str:
    return "CASE " + x + " " + " ".join(f"WHEN {i} THEN {q(n)}" for i, n in enumerate(K.MONTHS_FR, 1)) + " END"


WS = "[ \\t\\n\\r\\f\\x0B]"


def fact_cte() -> str:
    lab = (f"NULLIF(regexp_replace(COALESCE(label, {q(K.MISSING_LABEL)}), '^{WS}+|{WS}+$', '', 'g'), 'null')")
    return (f"SELECT file AS nom_fichier, sheet AS nom_onglet, {version_sql('file')} AS version_prev, "
            f"NULLIF(annee, 'null') AS annee, {month_num_sql(chr(40) + 'NULLIF(mois_nom, ' + q('null') + ')' + chr(41))} AS mois, "
            f"NULLIF(mois_nom, 'null') AS mois_nom, {lab} AS nature_montant, "
            f"NULLIF(type_montant, 'null') AS type_montant, NULLIF(montant, 'null') AS montant_millions "
            f"FROM lng WHERE NULLIF(montant, 'null') IS NOT NULL")


def gate_sql(src: str, keys) -> str:
    k = ", ".join(keys)
    mh = " + ".join(f"COALESCE(CAST(contains(lower(mois_nom), {q(w)}) AS INTEGER), 0)" for w in K.GATE_MONTH_WORDS)
    th = " + ".join(f"COALESCE(CAST(contains(lower(type_montant), {q(w)}) AS INTEGER), 0)" for w in K.GATE_TYPE_WORDS)
    return (f"SELECT {k}, nb_lignes, mh = nb_lignes AS mois_ok, th = nb_lignes AS type_ok, lab = nb_lignes AS nature_ok, "
            f"(mh = nb_lignes AND th = nb_lignes AND lab = nb_lignes) AS valide, "
            f"(bad = 0 AND lab = nb_lignes) AS valide_strict FROM ("
            f"SELECT {k}, count(*) AS nb_lignes, sum({mh}) AS mh, sum({th}) AS th, "
            f"count(*) FILTER (WHERE nature_montant IN {in_list(K.ALLOWED_LABELS)}) AS lab, "
            f"count(*) FILTER (WHERE ({mh}) <> 1 OR ({th}) <> 1) AS bad FROM {src} GROUP BY {k})")


FACT_COLS = "version_prev, annee, mois, mois_nom, nature_montant, type_montant, montant_millions"


def ingest_sql(layout: str, view: str | None = None) -> str:
    d = unpivot_multi_ctes(view or "cells") if layout == "multi" else unpivot_single_ctes(view or "cells_single")
    keys = ["nom_fichier", "nom_onglet"] if layout == "multi" else ["nom_fichier"]
    d["fact"] = fact_cte()
    d["gate"] = gate_sql("fact", keys)
    return (ctes(**d) + f"SELECT {FACT_COLS} FROM fact WHERE ({', '.join(keys)}) IN "
            f"(SELECT {', '.join(keys)} FROM gate WHERE valide)")


def read_number(x: str) -> str:
    """A cell's text as a workbook gives it back: a number in its shortest form, all else as it is."""
    return f"COALESCE(regexp_replace(CAST(TRY_CAST({x} AS DOUBLE) AS VARCHAR), '\\.0$', ''), {x})"


def adj_ctes(view: str = "cells_adj") -> dict:
    isd = "(COALESCE(try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%Y-%m-%d %H:%M:%S')) IS NOT NULL)"
    d = cells_base(view)
    d["fs"] = f"SELECT DISTINCT FILE AS file, SHEET AS sheet FROM {view} WHERE SHEET_NO <= 5"
    d["c5"] = "SELECT * FROM cl WHERE (file, sheet) IN (SELECT file, sheet FROM fs)"
    d["hd"] = (f"SELECT file, sheet, max(c) AS max_c, CASE WHEN bool_or(r = -1 AND {isd}) THEN -1 "
               f"ELSE min(CASE WHEN r >= 0 AND {isd} THEN r END) END AS ligne_entete FROM c5 GROUP BY file, sheet")
    d["dc"] = (f"SELECT c5.file, c5.sheet, c5.c, hd.max_c FROM c5 JOIN hd USING (file, sheet) "
               f"WHERE c5.r = hd.ligne_entete AND {isd}")
    d["en"] = ("SELECT file, sheet, min(c) AS e FROM dc d WHERE c >= 1 AND c + 1 <= max_c AND NOT EXISTS "
               "(SELECT 1 FROM dc x WHERE x.file = d.file AND x.sheet = d.sheet AND x.c = d.c + 1) GROUP BY file, sheet")
    d["h2"] = ("SELECT hd.file, hd.sheet, hd.ligne_entete, COALESCE(en.e, hd.max_c) AS col_fin FROM hd "
               "LEFT JOIN en USING (file, sheet) WHERE hd.ligne_entete IS NOT NULL")
    d["x"] = "SELECT c5.*, h2.ligne_entete, h2.col_fin FROM c5 JOIN h2 USING (file, sheet) WHERE c5.c <= h2.col_fin"
    d["body"] = "SELECT * FROM x WHERE r > ligne_entete"
    d["crs"] = "SELECT file, sheet, max(c) AS col_raison FROM body WHERE contains(lower(v), 'raison') GROUP BY file, sheet"
    d["mk"] = "SELECT b.* FROM body b JOIN crs USING (file, sheet) WHERE b.c = crs.col_raison"
    d["ret"] = ("SELECT file, sheet, r AS r_ret, row_number() OVER (PARTITION BY file, sheet ORDER BY r) AS i "
                "FROM mk WHERE contains(lower(v), 'retraitement')")
    d["rai"] = ("SELECT file, sheet, r AS r_rai, row_number() OVER (PARTITION BY file, sheet ORDER BY r) AS i "
                "FROM mk WHERE contains(lower(v), 'raison')")
    d["pairs"] = "SELECT * FROM ret JOIN rai USING (file, sheet, i)"
    d["heads"] = (f"SELECT file, sheet, c, CAST(COALESCE(try_strptime(v, '%Y-%m-%d'), try_strptime(v, '%Y-%m-%d %H:%M:%S')) AS DATE) AS d "
                  f"FROM x WHERE r = ligne_entete AND {isd}")
    d["am"] = ("SELECT b.file, b.sheet, b.c, p.r_rai, b.v AS montant_retraitement FROM body b JOIN pairs p "
               "ON b.file = p.file AND b.sheet = p.sheet AND b.r = p.r_ret")
    d["adj"] = ("SELECT am.*, h.d, rs.v AS raison FROM am JOIN heads h USING (file, sheet, c) LEFT JOIN body rs "
                "ON rs.file = am.file AND rs.sheet = am.sheet AND rs.c = am.c AND rs.r = am.r_rai")
    return d


ADJ_SELECT = (f"SELECT regexp_replace(file, '^.*Prévisions DEA mensualisées/', '') AS nom_fichier, sheet AS nom_onglet, "
              f"CAST(year(d) AS VARCHAR) AS annee, lpad(CAST(month(d) AS VARCHAR), 2, '0') AS mois, "
              f"{month_name_sql('month(d)')} AS mois_nom, montant_retraitement, raison FROM adj")

"""Fixed values that must equal the source application's for right results.

Everything below is data, stated as text in its natural order.  Operators
turn these lists into literal maps or tiny broadcast tables.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: French month names, in calendar order (month 1 .. 12).
# ---------------------------------------------------------------------------
MONTHS_FR = [
    "janvier", "février", "mars", "avril", "mai", "juin",
    "juillet", "août", "septembre", "octobre", "novembre", "décembre",
]

# FIXED VALUES: words accepted in a month-name cell by the data-quality gate
# (case-insensitive "contains"; hits are counted, see operators.controls).
GATE_MONTH_WORDS = [
    "total", "janvier", "février", "mars", "avril", "mai", "juin", "juillet",
    "août", "aout", "septembre", "octobre", "novembre", "décembre",
]

# FIXED VALUES: words accepted in an amount-type cell by the gate.
GATE_TYPE_WORDS = ["réalisé", "estimé", "prévu", "observé"]

# FIXED VALUES: words marking a month column during table-bounds detection.
MONTH_COLUMN_WORDS = MONTHS_FR + ["total"]

# FIXED VALUES: anchor texts that close a forecast table (first one wins).
ANCHOR_TEXTS = ["solde financier", "variation de trésorerie"]

# FIXED VALUES: amount types counted as realised; the leading blank of the
# last one is part of the value.
REALISED_TYPES = [
    "Observé", "Réalisé", "Réalisé définitif", "Réalisé (Quasi Déf)",
    "Réalisé (Provisoire)", " Réalisé Semi Déf",
]
FORECAST_TYPE = "Prévu"

# FIXED VALUES: month-name rows ignored when reading the forecast table.
TOTAL_MONTH_NAMES = ["TOTAL", "TOTAL.1"]

# FIXED VALUES: label given to forecast rows without a label.
MISSING_LABEL = "Eléments exceptionnels"

# FIXED VALUES: label harmonisation, static part (from -> to), in rule order.
LABEL_RULES = [
    ("ARE / AREF", "ARE / AREF, y compris UE"),
    ("Allocation partielle de longue durée (APLD)",
     "Activité partielle, allocation partielle de longue durée (APLD)"),
    ("Autres (AS-FNE, Plan rebond, ...)", "Autres"),
    ("CRP / CSP, y compris équivalents ARE", "CRP / CTP / CSP, y compris équivalents ARE"),
    ("Contributions et autres produits", "Contributions d'Assurance chômage"),
    ("Contributions et autres recettes d'Assurance chômage", "Contributions d'Assurance chômage"),
    ("Gestion administrative", "Autres produits"),
    ("Autres aides  (prime CSP, aide fin de droit, ...)",
     "Autres aides (prime CSP, aide fin de droit, adr, ...)"),
    ("Autres aides (prime CSP, aide fin de droit, ...)",
     "Autres aides (prime CSP, aide fin de droit, adr, ...)"),
    ("Autres aides (adr, aide fin de droit, ...)",
     "Autres aides (prime CSP, aide fin de droit, adr, ...)"),
    ("Autres produits (gestion administrative et financière)", "Autres produits"),
    ("Remboursements d'indus", "Indus, avances et acomptes"),
    ("Frais de gestion et décaissements sur immobilisations",
     "Frais de fonctionnement et de gestion"),
    ("10% Pôle Emploi", "Contributions pôle emploi"),
    ("11% Pôle Emploi", "Contributions pôle emploi"),
    ("Contributions", "Contributions principales"),
    ("Etat - Prélèvement à la source", "Prélèvement à la source"),
    ("Caisses de retraite complémentaire", "Caisses de retraites complémentaire"),
    ("Caisses de retraite complémentaire (dont précomptes)",
     "Caisses de retraites complémentaire (dont précomptes)"),
    ("SOLDE = RECETTES - DÉPENSES", "Solde"),
    ("Solde", "Solde"),
    ("Solde financier", "Solde"),
    ("Prsélèvements sociaux", "Prélèvements sociaux et fiscaux"),
    ("Intérêts nets sur emprunts", "Intérêts sur emprunts"),
]

# FIXED VALUES: labels split by the sign of the amount after the static
# rules: label -> (text when amount < 0, text when amount >= 0).
SIGNED_LABEL_RULES = [
    ("Sécurité sociale (CSG, CRDS, maladie)",
     "Dépenses - Sécurité sociale (CSG, CRDS, maladie)",
     "Recettes - Sécurité sociale (CSG, CRDS, maladie)"),
    ("Prélèvement à la source",
     "Dépenses - Etat - Prélèvement à la source",
     "Recettes - Etat - Prélèvement à la source"),
]

# FIXED VALUES: label sets of the realised-vs-forecast flow report.  The
# third receipts entry is unclosed in the source and never matches; kept.
FLOW_RECEIPT_LABELS = [
    "Prélèvements sociaux et fiscaux", "Autres", "Autres (accompagnement CSP, recouvrements",
    "Allocations brutes", "Aides",
    "Activité partielle, allocation partielle de longue durée (APLD)",
]
FLOW_SPENDING_LABELS = ["Total Dépenses"]
FLOW_OTHER_LABELS = [
    "Caisses de retraites complémentaire (dont précomptes)", "Contributions pôle emploi",
    "Recettes - Etat - Prélèvement à la source", "Recettes - Sécurité sociale (CSG, CRDS, maladie)",
    "Intérêts sur emprunts", "Frais de fonctionnement et de gestion",
]
# (category, labels, sign applied to amounts and running totals)
FLOW_CATEGORIES = [
    ("recettes", FLOW_RECEIPT_LABELS, 1),
    ("depenses", FLOW_SPENDING_LABELS, -1),
    ("autres", FLOW_OTHER_LABELS, -1),
]

# FIXED VALUES: category of a harmonised label, categories in priority order.
LABEL_CATEGORIES = [
    ("recettes", [
        "Contributions d'Assurance chômage", "Contributions principales",
        "Impositions de toutes natures", "Conventions diverses, y compris UE",
        "Participation entreprise CSP / CRP", "Autres produits", "Revenus financiers",
    ]),
    ("autres", [
        "Caisses de retraites complémentaire (dont précomptes)", "Contributions pôle emploi",
        "Recettes - Etat - Prélèvement à la source", "Recettes - Sécurité sociale (CSG, CRDS, maladie)",
        "Intérêts sur emprunts", "Frais de fonctionnement et de gestion",
    ]),
    ("depenses", [
        "Reversements et compléments", "ATI", "ARE / AREF, y compris UE",
        "Autres aides (prime CSP, aide fin de droit, adr, ...)", "Autres", "Dépenses allocataires",
        "Autres (accompagnement CSP, recouvrements)", "Prélèvements sociaux et fiscaux",
        "CRP / CTP / CSP, y compris équivalents ARE", "Dette", "Aides", "Allocations brutes",
        "Activité partielle, allocation partielle de longue durée (APLD)",
        "Autres produits, conventions diverses", "Dépenses - Sécurité sociale (CSG, CRDS, maladie)",
        "Dépenses - Etat - Prélèvement à la source", "Financement et frais de gestion opérateurs",
        "AREP", "Caisses de retraites complémentaire", "Dépenses autres publics",
        "Indus, avances et acomptes", "Aides à la reprise et création d'entreprise",
        "Autres allocations (décès, ...)",
    ]),
]

# FIXED VALUES: ledger labels read by the bank report.
BALANCE_LABEL = "Solde Final"
KPI_LABELS = ["Solde Initial", "Solde avant Décision", "Solde Final"]
CONSOLIDATED_ACCOUNT = "Total"
LEDGER_REALISED_TYPE = "R"
RECEIPT_MARK = "ecette"
SPENDING_MARK = "pense"

# FIXED VALUES: look-back in days of the KPI change, by frequency code.
KPI_LAG_DAYS = {"J": 1, "S": 7, "M": 30, "T": 90, "A": 365}

# FIXED VALUES: ledger text formats (the export's form first, then the ISO form).
LEDGER_DATE_FORMATS = ["yyyy/MM/dd", "yyyy-MM-dd"]
LEDGER_TIMESTAMP_FORMATS = ["yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss"]

# FIXED VALUES: allowed forecast labels of the data-quality gate (127 values,
# in the order of the configuration file).
ALLOWED_LABELS = [
    'Autres dépenses allocations', 'Impositions de toutes natures', 'dont prélèvement PAS',
    'Pôle emploi - Allocataires', 'dont reversement PAS', 'Pour dépenses Unédic (part tiers)',
    'ASP - Activité partielle', 'Dépenses autres publics', 'ARE / AREF', 'Aides',
    'Cumul inversé (à fin de mois)', 'Caisses de retraite complémentaire', 'Total dépenses',
    'Participation entreprise CSP / CRP', 'Somme retraitée', 'Raisons', 'Pôle emploi - CSP',
    'Autres produits', 'Acoss - CEA (chèque emploi-associatif)', 'Allocations brutes',
    'Pôle emploi - PAS allocataires', 'Allocation partielle de longue durée (APLD)',
    'Autres (accompagnement CSP, recouvrements)', 'Somme autres',
    'Total dépenses - Equilibre technique', 'Solde = recettes - dépeneses', 'Variation de tréso',
    'Caisse de retraites net', 'Contributions', 'dont surplus de dépenses crise*',
    'Acoss - TREC (part patronale)', 'dont intérêt', 'Dépenses ARE AREF ASP',
    'Éléments exceptionnels', 'Prélèvements sociaux', 'Autres aides (adr, aide fin de droit, ...)',
    'ATI', '11% Pôle Emploi', 'Recettes yc crise', 'Pôle emploi - Participation Unédic (11%)',
    'Ajustement', 'Gestion administrative', 'Variation de trésorerie', "Remboursements d'indus",
    'Activité partielle', 'Somme', 'dont Pole emploi', 'AREP', 'Autres (AS-FNE, Plan rebond, ...)',
    'Indus, avances et acomptes', 'Recettes techniques', 'Cumul', 'dont reversement secu',
    'Contributions et autres produits', 'Calculé', "En millions d'euros",
    'Autres allocations (décès, ...)', "dont manque à gagner Activité partielle + garde d'enfant",
    "Contributions d'Assurance chômage", 'Total', 'Autres', 'Prélèvements sociaux et fiscaux',
    'Somme brute', 'Variation de trésorerie - Equilibre technique',
    'Caisses de retraite complémentaire (dont précomptes)', 'Dépenses yc crise',
    'Reversements et compléments', 'Intérêts', 'Retraitements',
    'Acoss - EPM (particuliers employeurs)', 'Sécurité sociale (CSG, CRDS, maladie)',
    'CRP / CTP / CSP, y compris équivalents ARE', 'Total recettes', 'ARE / AREF, y compris UE',
    'Somme dépenses techniques', 'CRP / CSP, y compris équivalents ARE', 'dont prélèvement',
    'Frais de gestion et décaissements sur immobilisations',
    'Financement et frais de gestion opérateurs',
    'Autres produits (gestion administrative et financière)', 'Pôle emploi - URSAFF allocataires',
    'Pour dépenses Unédic (dépenses allocataires)', '10% Pôle Emploi', 'Intérêts nets sur emprunts',
    'Frais de fonctionnement', 'Autres dépenses', 'Autres aides  (prime CSP, aide fin de droit, ...)',
    "Contributions et autres recettes d'Assurance chômage", 'Revenus financiers',
    'dont frais de fonctionnement et de gestion', 'Prélèvement à la source',
    'Caisses de retraites complémentaire (dont précomptes)', 'dont prélèvement sécu',
    'Dépenses allocataires', 'Pôle emploi - Contribution (11%)', 'Total Dépenses',
    'Autres aides (prime CSP, aide fin de droit, ...)', 'Equilibre technique',
    'Frais de fonctionnement et de gestion', 'Autres produits, conventions diverses',
    'Dépenses techniques', 'Eléments exceptionnels', 'Etat - Prélèvement à la source',
    "Aides à la reprise et création d'entreprise", 'Contributions principales',
    'Activité partielle, allocation partielle de longue durée (APLD)', 'Intérêts sur emprunts',
    'Conventions diverses, y compris UE', 'Impositions de toutes natures (CSG)',
    'Caisses de retraites complémentaire', 'dont Reversement hors effet crise',
    'Pour recettes Unédic', 'Somme cumulée', 'Caisses de retraite allocataires', 'Raison',
    'dont décalage de trésorerie', 'Total recettes - Equilibre technique',
    'Acoss - Réduction générale', 'Acoss - CSG activité', 'Ajustement au bilan comptable',
    'SOLDE = RECETTES - DÉPENSES', "Situation de l'Endettement net bancaire de l'AC au 31/12",
    "Situation de l'Endettement net de l'AC au 31/12", "Variation de Trésorerie de l'AC",
    'Dette', 'Solde', 'Solde financier',
]

# FIXED VALUES: workbooks already loaded (processed-file manifest).
PROCESSED_FILES = [
    'Equilibre Technique mensualisé 2017.10 - DEA.xlsx',
    'Equilibre Technique mensualisé 2018.02 - DEA.xlsx',
    'Equilibre Technique mensualisé 2018.06 - DEA.xlsx',
    'Equilibre Technique mensualisé 2019 03 - DEA.xlsx',
    'Equilibre Technique mensualisé 2019 07 - DEA.xlsx',
    'Equilibre Technique mensualisé 2019 09 - DEA.xlsx',
    'Equilibre Technique mensualisé 2019 11 - DEA.xlsx',
    'Equilibre Technique mensualisé 2020 02 - DEA.xlsx',
    'Equilibre Technique mensualisé 2020 06 - DEA.xlsx',
    'Equilibre Technique mensualisé 2020 10 - DEA.xlsx',
    'Equilibre Technique mensualisé 2021 02 - DEA.xlsx',
    'Equilibre Technique mensualisé 2021 06 - DEA.xlsx',
    'Equilibre Technique mensualisé 2021 10 - DEA.xlsx',
    'Equilibre Technique mensualisé 2022 02 - DEA.xlsx',
]

# FIXED VALUES: account list offered by the bank report (leading blanks kept).
BANK_ACCOUNTS = [
    "Total", " 107CDNB", " 107CACIBA", " 107CICA", " 108CDNB", " 509CDNA", " 107CACIBB",
    " 107CDNCSL", " 509CDNCSL", " 107CDNA", " 107BNPA", " 108CDNA", " 107BREDA",
]

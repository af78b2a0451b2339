"""Declarative rules per dataset: header words, type hints, thresholds and flags.

The word lists are fixed values: they must equal those of the source system for equal decisions.
Words are matched as substrings of a folded header, so a word containing a shorter one is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from cellweave.functions.numbers import EURO, NO_WORDS, PLAIN_SPACES, WIDE_SPACES, NumberStyle


@dataclass(frozen=True)
class Rules:
    name: str
    # header search
    header_words: tuple[str, ...]
    scan: int = 25
    min_hits: int = 2
    density_fallback: bool = True
    last_density_wins: bool = False
    # columns
    blank_rule: str = "blank"  # "blank", "all_blank" (nulls keep a column), "blank_or_nan"
    unique_before_drop: bool = False
    hint_name: str = "header"  # what hints look at: "column", "header" (folded) or "snake"
    cut_table_name: bool = True
    # values
    zero_is_null: bool = False
    number_style: NumberStyle = PLAIN_SPACES
    close_is_integral: bool = False
    # dates
    iso_rule: bool = True
    serial_upper: float | None = 60_000.0
    serial_needs_name: bool = False
    date_words: tuple[str, ...] = ()
    forced_dates: tuple[str, ...] = ()
    ok_with_name: float = 0.50
    ok_with_tokens: float = 0.70
    null_is_timed: bool = True
    # other types by name
    text_words: tuple[str, ...] = ()
    float_words: tuple[str, ...] = ()
    float_names: tuple[str, ...] = ()
    amount_words: tuple[str, ...] = ()
    code_words: tuple[str, ...] = ()
    # output
    sql_integer: str = "INTEGER"
    sample: int = 10


ISO_SHARE = 0.50
NUMERIC_SHARE = 0.90
SERIAL_SHARE = 0.70
TOKEN_SHARE = 0.30
BOOLEAN_SHARE = 0.98
NUMBER_SHARE = 0.85
TIMED_SHARE = 0.20

PERIOD_WORDS = (
    "date", "dt", "heure", "time", "echeance", "debut", "fin", "periode", "semaine", "mois", "annee",
)

FQT = Rules(
    name="fqt",
    header_words=(
        "date", "motif", "redact", "trig", "nom", "prenom", "personnel", "site", "retrait", "edition",
    ),
    blank_rule="all_blank",
    unique_before_drop=True,
    hint_name="column",
    zero_is_null=True,
    number_style=WIDE_SPACES,
    close_is_integral=True,
    serial_upper=2_950_000.0,
    date_words=("date", "dt", "heure", "time"),
    forced_dates=("date_d_attribution", "date_de_retrait"),
    null_is_timed=False,
    sample=8,
)

FNP = Rules(
    name="fnp",
    header_words=(
        "projet", "code", "id", "date", "mois", "client", "fournisseur", "libelle", "montant",
        "quantite", "qte", "prix", "ttc", "ht", "statut", "status", "site", "type", "categorie",
        "echeance", "delai", "commentaire", "ref",
    ),
    unique_before_drop=True,
    hint_name="column",
    cut_table_name=False,
    zero_is_null=True,
    serial_upper=106_750.0,
    date_words=("date", "dt", "heure", "time", "echeance"),
)

RPA = Rules(
    name="rpa",
    header_words=(
        "projet", "code", "id", "ref", "libelle", "client", "fournisseur", "chef de projet", "cp",
        "cdp", "manager", "statut", "status", "phase", "categorie", "type", "date", "heure", "time",
        "periode", "echeance", "budget", "montant", "cout", "prix", "ht", "ttc", "avancement",
        "progress", "%", "taux", "site", "analytique", "commentaire", "observations", "notes",
        "remarques", "trigramme", "nom", "cat point", "n° dossier", "ot", "ata", "bu", "immat", "wp",
        "semaine", "mois", "annee",
    ),
    date_words=PERIOD_WORDS,
    amount_words=(
        "montant", "debit", "credit", "solde", "budget", "ht", "ttc", "amount", "total", "prix",
        "cout", "heures", "h",
    ),
    code_words=(
        "code", "nature", "plan", "compte", "sop", "section", "niveau", "trigramme", "immat", "ot",
        "ata", "wp", "dossier", "cat point",
    ),
)

SPA = Rules(
    name="spa",
    header_words=(
        "projet", "code", "id", "ref", "libelle", "client", "fournisseur", "chef de projet", "cp",
        "cdp", "manager", "statut", "status", "phase", "categorie", "type", "date", "heure", "time",
        "periode", "echeance", "fin", "debut", "budget", "montant", "cout", "prix", "ht", "ttc",
        "avancement", "progress", "%", "taux", "site", "analytique", "commentaire", "observations",
        "notes", "remarques", "comments", "revue raf", "gtm", "pole", "remaining forecast",
        "facturation mois", "hrs", "(h)", "ca ", "charges", "marge", "achats", "fnp", "int", "raf",
    ),
    scan=30,
    number_style=NO_WORDS,
    serial_needs_name=True,
    date_words=PERIOD_WORDS,
    float_words=(
        "€", "ht", "budget", "montant", "amount", "total", "prix", "cout", "facturation", "forecast",
        "achats", "fnp", "ca ", "charges", "marge", "int", "raf",
        "heures", "hrs", "(h)", " h ",
        "%", "taux", "avancement", "ecart", "pourcent",
    ),
)

PAAE = Rules(
    name="paae",
    header_words=(
        "projet", "code", "id", "ref", "libelle", "description", "client", "fournisseur", "cdp",
        "manager", "statut", "status", "phase", "categorie", "type", "site", "pole",
        "section analytique", "date", "heure", "time", "periode", "debut", "fin", "echeance", "mois",
        "annee", "semaine", "budget", "montant", "cout", "prix", "ht", "ttc", "charges", "achats",
        "marge", "ca", "fnp", "int", "raf", "hrs", "(h)", "taux", "%", "forecast", "facturation",
    ),
    scan=30,
    last_density_wins=True,
    hint_name="snake",
    number_style=EURO,
    close_is_integral=True,
    iso_rule=False,
    serial_upper=None,
    date_words=PERIOD_WORDS,
    ok_with_tokens=0.50,
    text_words=(
        "nature", "section_analytique", "sop", "plan_1_niveau_1", "plan_3_niveau_1", "plan4", "plan5",
    ),
    float_words=(
        "montant", "debit", "credit", "solde", "budget", "ht", "ttc", "charges", "achats", "marge",
        "ca", "fnp", "forecast", "facturation",
    ),
    float_names=("h",),
    sql_integer="BIGINT",
)

CATCLIENTS = Rules(
    name="catclients",
    header_words=("libelle", "top", "custo", "hfm", "categorie", "category"),
    min_hits=1,
    density_fallback=False,
    blank_rule="blank_or_nan",
    sample=20,
)

CDP = Rules(name="cdp", header_words=(), number_style=WIDE_SPACES, sample=15)

INFERRED = {r.name: r for r in (FQT, FNP, RPA, SPA, PAAE)}
DATASETS = {**INFERRED, "catclients": CATCLIENTS, "cdp": CDP}

# The settings naming the expected files, with their dataset.
DATASET_KEYS = {
    "FILE_PATH_FQT": "fqt",
    "FILE_PATH_FNP": "fnp",
    "FILE_PATH_SPA": "spa",
    "FILE_PATH_RPA": "rpa",
    "FILE_PATH_CDP": "cdp",
    "FILE_PATH_PAAE": "paae",
    "FILE_PATH_CATCLIENTS": "catclients",
}

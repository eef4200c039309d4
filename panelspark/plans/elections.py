"""Election results of three layouts → winner per year and unit with orientation and party id."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.text import (
    full_name,
    pad_code,
    plain_apostrophes,
    upper_name,
    without_brackets,
    without_decimal_tail,
    year_in_path,
)
from panelspark.operators.lookup import KEEP, map_from_table, map_values
from panelspark.operators.rank import winner
from panelspark.operators.reshape import to_long
from panelspark.sources.delimited import stack

# Header of the unit column in its spellings, pattern of a candidate column,
# pattern of the year in a file name.
UNIT_HEADERS = ("Code département", "Code département0")
CANDIDATE_HEADER = r"^.+ \([^)]*\)\s*$"
YEAR_IN_FILE = r"presi(\d{4})"

# Candidates listed by surname and their full names.
FULL_NAMES = {
    "SARKOZY": "Nicolas SARKOZY",
    "CHIRAC": "Jacques CHIRAC",
    "MITTERRAND": "François MITTERRAND",
    "DE GAULLE": "Charles DE GAULLE",
    "GISCARD D'ESTAING": "Valéry GISCARD DESTAING",
    "GISCARD DESTAING": "Valéry GISCARD DESTAING",
    "POMPIDOU": "Georges POMPIDOU",
    "POHER": "Alain POHER",
    "JOSPIN": "Lionel JOSPIN",
    "ROYAL": "Ségolène ROYAL",
    "HOLLANDE": "François HOLLANDE",
    "MACRON": "Emmanuel MACRON",
    "LE PEN": "Marine LE PEN",
    "MACRON Emmanuel": "Emmanuel MACRON",
    "LE PEN Marine": "Marine LE PEN",
}

# Political orientation of every candidate.
ORIENTATIONS = {
    "CHARLES DE GAULLE": "droite",
    "FRANÇOIS MITTERRAND": "gauche",
    "VALÉRY GISCARD D'ESTAING": "centre droite",
    "VALÉRY GISCARD DESTAING": "centre droite",
    "VALERY GISCARD D'ESTAING": "centre droite",
    "VALERY GISCARD DESTAING": "centre droite",
    "JACQUES CHIRAC": "droite",
    "LIONEL JOSPIN": "gauche",
    "NICOLAS SARKOZY": "droite",
    "SÉGOLÈNE ROYAL": "gauche",
    "FRANÇOIS HOLLANDE": "gauche",
    "MARINE LE PEN": "extreme droite",
    "JEAN-LUC MÉLENCHON": "extreme gauche",
    "EMMANUEL MACRON": "centre",
    "ARLETTE LAGUILLER": "extreme gauche",
    "PHILIPPE POUTOU": "extreme gauche",
    "NATHALIE ARTHAUD": "extreme gauche",
    "JEAN-MARIE LE PEN": "extreme droite",
    "BENOÎT HAMON": "gauche",
    "DOMINIQUE DE VILLEPIN": "droite",
    "CHRISTINE BOUTIN": "droite",
    "FRANÇOIS BAYROU": "centre droite",
    "NICOLAS DUPONT-AIGNAN": "droite",
    "ÉRIC ZEMMOUR": "extreme droite",
    "YANNICK JADOT": "écologiste",
    "NOËL MAMÈRE": "écologiste",
    "ANTOINE WAQUIN": "extreme gauche",
    "GEORGES MARCHAIS": "gauche",
    "ROBERT HUE": "gauche",
    "GEORGES POMPIDOU": "droite",
    "ALAIN POHER": "centre droite",
}

# Unit codes of territories, by name and by their letter codes.
CODES_BY_NAME = {
    "Guadeloupe": "971",
    "Martinique": "972",
    "Guyane": "973",
    "La Réunion": "974",
    "Mayotte": "976",
    "Nouvelle-Calédonie": "988",
    "Polynésie française": "987",
    "Saint-Pierre-et-Miquelon": "975",
    "Saint-Martin/Saint-Barthélemy": "971",
    "Wallis et Futuna": "986",
    "Français établis hors de France": "99",
    "Corse-du-Sud": "2A",
    "Haute-Corse": "2B",
}
CODES_BY_LETTERS = {
    "ZA": "971",
    "ZB": "972",
    "ZC": "973",
    "ZD": "974",
    "ZM": "976",
    "ZN": "988",
    "ZP": "987",
    "ZS": "975",
    "ZX": "971",
    "ZW": "986",
    "ZZ": "99",
}

VOTES = ["annee", "code_dept", "candidat", "voix"]


def _unit(c):
    return map_values(pad_code(without_decimal_tail(c.cast("string"))), CODES_BY_LETTERS, KEEP)


def votes_by_candidate_columns(df: DataFrame, tag: str = "source_file") -> DataFrame:
    """One column per candidate, headed ``NAME (PARTY)`` → one row per unit row and candidate."""
    unit = next((h for h in UNIT_HEADERS if h in df.columns), None)
    candidates = [c for c in df.columns if re.match(CANDIDATE_HEADER, c)]
    if unit is None or not candidates:
        raise ValueError(f"no unit or candidate columns among {df.columns}")
    named = df.withColumns({"annee": year_in_path(tag, YEAR_IN_FILE), "code_dept": _unit(F.col(f"`{unit}`"))})
    long = to_long(named, ["annee", "code_dept"], candidates, "candidat", "voix", "bigint")
    return long.withColumn("candidat", without_brackets(plain_apostrophes("candidat")))


def votes_by_candidate_blocks(
    df: DataFrame, year: int, unit: str, place: str, blocks: Sequence[tuple[str, str, str]]
) -> DataFrame:
    """Name, first name and votes of each candidate side by side → one row per unit row and candidate."""
    code = F.coalesce(map_values(F.col(f"`{place}`"), CODES_BY_NAME), _unit(F.col(f"`{unit}`")))
    parts = [
        df.select(
            F.lit(year).alias("annee"),
            code.alias("code_dept"),
            full_name(F.col(f"`{surname}`"), F.col(f"`{first}`")).alias("candidat"),
            F.col(f"`{votes}`").try_cast("bigint").alias("voix"),
        )
        for surname, first, votes in blocks
    ]
    return stack(parts)


def votes_by_rows(df: DataFrame, year: int, unit: str, surname: str, first: str, votes: str) -> DataFrame:
    """Already one row per unit row and candidate."""
    return df.select(
        F.lit(year).alias("annee"),
        _unit(F.col(f"`{unit}`")).alias("code_dept"),
        full_name(F.col(f"`{surname}`"), F.col(f"`{first}`")).alias("candidat"),
        F.col(f"`{votes}`").try_cast("bigint").alias("voix"),
    )


def winners(votes: Sequence[DataFrame]) -> DataFrame:
    """(annee, code_dept, candidat, total_voix): votes summed per unit, the largest sum wins.

    Unit codes are already final here, so territories that share a code are summed together.
    """
    counted = stack([v.select(*VOTES) for v in votes]).filter(F.col("voix").isNotNull())
    first = winner(counted, ["annee", "code_dept"], "candidat", "voix", "total_voix")
    # Fixed value: the candidate of 2002 shares the surname of a later one.
    earlier = (F.col("annee") == 2002) & (F.col("candidat") == "LE PEN")
    name = F.when(earlier, F.lit("Jean-Marie LE PEN")).otherwise(map_values("candidat", FULL_NAMES, KEEP))
    return first.withColumn("candidat", name)


def with_orientation(won: DataFrame, parties: DataFrame, orientation: str = "Orientation_politique") -> DataFrame:
    """Add orientation (by candidate) and party id (by orientation, from the party table)."""
    oriented = won.withColumn("orientation_politique", map_values(upper_name("candidat"), ORIENTATIONS))
    return map_from_table(
        oriented, "orientation_politique", parties, orientation, "id", "id_parti"
    ).withColumn("id_parti", F.col("id_parti").try_cast("int"))

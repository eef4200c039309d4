"""The seven indicator pipelines: from raw layouts to yearly values per unit, region or country."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions import text
from panelspark.functions.numbers import deflate, flag, mean_of_two, percent_of, year_of_text
from panelspark.operators.impute import ols_fill
from panelspark.operators.lookup import map_values
from panelspark.operators.quality import without_empty_rows
from panelspark.operators.reshape import add_baseline, densify, month_columns_to_years, to_long, to_wide
from panelspark.sources.delimited import skip_preamble, stack

# Reported years.
FIRST_YEAR, LAST_YEAR = 2000, 2022

# Columns.
WIND, SOLAR = "Parc_installé_éolien_MW", "Parc_installé_solaire_MW"
GDP, INFLATION, REAL_GDP = "PIB_en_euros_par_habitant", "Évolution_des_prix_à_la_consommation", "PIB_par_inflation"
LIFE = "Espérance_Vie"

# Region codes of the overseas files, and the units whose gaps are filled by a line.
OVERSEAS_REGIONS = {
    "PIB Guadeloupe.csv": "01",
    "PIB Martinique.csv": "02",
    "PIB Guyane.csv": "03",
    "PIB La Réunion.csv": "04",
    "PIB Mayotte.csv": "06",
}
GDP_GAPS = ("06",)
LIFE_GAPS = ("976",)

# How a life-expectancy label is built, and the sexes it names.
LIFE_LABEL = r"^Espérance de vie à la naissance - (Hommes|Femmes) - (.*)"
SEXES = ("Hommes", "Femmes")

# The 21 columns of the population file, by position.
POPULATION_COLUMNS = [
    "Code_Département",
    "Nom_Département",
    *[f"{sex}_{age}" for sex in "EHF" for age in ("0_19_ans", "20_39_ans", "40_59_ans", "60_74_ans", "75_plus", "Total")],
    "Année",
]


def renewable_capacity(raw: DataFrame, region: str = "Code_INSEE_région", baseline: int = FIRST_YEAR) -> DataFrame:
    """Capacity per region and year; every region starts from zero in the baseline year."""
    typed = raw.select(
        F.col(region).alias("Code_INSEE_Région"),
        F.col("Année").try_cast("int").alias("Année"),
        *[F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)).alias(c) for c in (WIND, SOLAR)],
    )
    summed = typed.groupBy("Code_INSEE_Région", "Année").agg(*[F.sum(c).alias(c) for c in (WIND, SOLAR)])
    return add_baseline(summed, ["Code_INSEE_Région"], "Année", baseline, {WIND: 0.0, SOLAR: 0.0})


def overseas_gdp(
    tagged: DataFrame, regions: Mapping[str, str] = OVERSEAS_REGIONS, tag: str = "source_file", fill: Sequence[str] = GDP_GAPS
) -> DataFrame:
    """GDP of the overseas files: metadata rows dropped, region by file name, gaps of ``fill`` filled."""
    rows = skip_preamble(tagged, "Année", "^[0-9]{4}$").select(
        F.col("Année").try_cast("int").alias("Année"),
        F.col(GDP).try_cast("int").alias(GDP),
        map_values(F.regexp_extract(tag, r"([^/]+)$", 1), dict(regions)).alias("Code_INSEE_Région"),
    )
    only = F.col("Code_INSEE_Région").isin(list(fill))
    return ols_fill(rows, ["Code_INSEE_Région"], "Année", GDP, post="trunc", only=only).withColumn(
        GDP, F.col(GDP).cast("int")
    )


def all_gdp(parts: Sequence[DataFrame], first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """One panel of the GDP sources: numeric region codes, known values, reported years.

    Regions that the last source lacks would only add rows without a value, which are not kept.
    """
    columns = ["Année", GDP, "Code_INSEE_Région"]
    valid = F.col("Code_INSEE_Région").rlike(text.REGION_CODE) & F.col(GDP).isNotNull()
    return stack([p.select(*columns) for p in parts]).filter(valid & F.col("Année").between(first, last))


def real_gdp(gdp: DataFrame, inflation: DataFrame) -> DataFrame:
    """GDP over the price change of its year; the rate is rounded before it divides."""
    rates = inflation.select("Année", F.round(F.col(INFLATION), 2).alias(INFLATION))
    return gdp.join(rates, "Année", "left").withColumn(REAL_GDP, deflate(GDP, INFLATION))


def research_share(raw: DataFrame, year: str = "_c0", share: str = "DIRD/PIB  France", last_year: int = 2023) -> DataFrame:
    """Research spending by year.  Years come as ``1990.0``; the provisional last one has no number."""
    label = F.regexp_replace(F.col(f"`{year}`").cast("string"), r"\.0$", "")
    return raw.select(
        F.when(label == "NaN", F.lit(str(last_year))).otherwise(label).alias("annee"),
        F.round(F.col(f"`{share}`").try_cast("double"), 2).alias("dird_pib_france_pourcentages"),
    )


def life_expectancy(
    raw: DataFrame,
    departments: DataFrame,
    first: int = FIRST_YEAR,
    last: int = LAST_YEAR,
    fill: Sequence[str] = LIFE_GAPS,
) -> DataFrame:
    """Mean of both sexes per unit and year from one column per year; names are matched to unit codes."""
    label = F.col("Libellé")
    rows = raw.filter(label.rlike(LIFE_LABEL)).withColumns(
        {
            "Genre": F.regexp_extract(label, LIFE_LABEL, 1),
            "name_key": text.name_key(F.regexp_extract(label, LIFE_LABEL, 2)),
        }
    )
    years = [str(y) for y in range(first, last + 1)]
    long = to_long(rows, ["Genre", "name_key"], years, "Année", "valeur")
    by_sex = to_wide(long, ["name_key", "Année"], "Genre", SEXES, F.min("valeur"))
    codes = departments.select(text.name_key("nom_departement").alias("name_key"), F.col("code_departement").alias("CODE_DEP"))
    values = by_sex.join(codes, "name_key").select(
        "CODE_DEP", F.col("Année").cast("int").alias("Année"), mean_of_two(*SEXES).alias(LIFE)
    )
    return ols_fill(values, ["CODE_DEP"], "Année", LIFE, post="round", only=F.col("CODE_DEP").isin(list(fill)))


def clean_schools(raw: DataFrame) -> DataFrame:
    """Distinct closed schools with standard texts, two-digit codes 01–95, closing year and sector flags."""
    texts = {c: text.standard_text(c) for c in raw.columns}
    if "code_postal" in texts:
        texts["code_postal"] = text.standard_text("code_postal", text.MISSING_POSTCODE)
    rows = raw.dropDuplicates().withColumns(texts)
    rows = rows.filter(text.code_in_range("code_departement", 1, 95))
    sector = F.col("secteur_public_prive_libe")
    return rows.withColumns(
        {
            "code_departement": text.pad_code(F.col("code_departement").try_cast("int").cast("string")),
            "annee_fermeture": year_of_text("date_fermeture"),
            "secteur_public": flag(sector == "public"),
            "secteur_prive": flag(sector == "privé"),
        }
    )


def schools_by_year(schools: DataFrame, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """Closed schools per unit and year, zero where none closed; years outside the range stay as they are."""
    counts = schools.groupBy("code_departement", "annee_fermeture").agg(
        F.count("numero_uai").alias("nombre_total_etablissements"),
        F.sum("secteur_public").alias("nb_public"),
        F.sum("secteur_prive").alias("nb_prive"),
    )
    zeros = {"nombre_total_etablissements": 0, "nb_public": 0, "nb_prive": 0}
    dense = densify(counts, schools, ["code_departement"], "annee_fermeture", first, last, zeros, keep_outside=True)
    # One label per unit, so spelling variants do not split it.
    labels = schools.groupBy("code_departement").agg(F.min("libelle_departement").alias("libelle_departement"))
    shares = {
        "pct_public": percent_of("nb_public", "nombre_total_etablissements"),
        "pct_prive": percent_of("nb_prive", "nombre_total_etablissements"),
    }
    return dense.join(labels, "code_departement").withColumns(shares)


def offences(sheets: DataFrame, sheet: str = "departement", years: range = range(1996, LAST_YEAR + 1)) -> DataFrame:
    """Yearly offences per unit, summed over all rows of its sheet and the months of the year."""
    totals = month_columns_to_years(without_empty_rows(sheets), [sheet], year="Année", total="total", years=years)
    return totals.select(
        "Année", text.pad_code(F.col(sheet).cast("string")).alias("Département"), F.col("total").cast("bigint").alias("Délits_total")
    )


def population(raw: DataFrame) -> DataFrame:
    """Population by unit, sex, age group and year; rows without a real unit code are headers or totals."""
    named = raw.toDF(*POPULATION_COLUMNS)
    code = text.without_quotes("Code_Département")
    numbers = [F.col(c).try_cast("int").alias(c) for c in POPULATION_COLUMNS[2:]]
    rows = named.withColumn("Code_Département", code).filter(text.is_unit_code("Code_Département"))
    return rows.select("Code_Département", "Nom_Département", *numbers)

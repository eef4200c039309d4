"""From raw files to processed files, the consolidated panel and the star tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelspark.functions.text import pad_code
from panelspark.operators.numbering import surrogate_id
from panelspark.plans import elections, indicators, schemas
from panelspark.plans.panel import NATION, REGION, UNIT, Measure, build_panel
from panelspark.plans.star import Dimension, analysis_set, build_fact, conform
from panelspark.sinks.writers import processed_path, write_csv
from panelspark.sources.delimited import (
    read_any,
    read_by_header,
    read_delimited,
    read_headerless,
    read_tagged,
    sanitise_columns,
)

# Units reported on (01 to 95 without 20).
UNITS = [f"{i:02d}" for i in range(1, 96) if i != 20]

# Domain → (year column, place column, level, columns renamed into the dimension, column used by the panel).
DOMAINS: dict[str, tuple[str, str | None, str, dict[str, str], str]] = {
    "politique": (
        "annee", "code_dept", UNIT,
        {"id_parti": "etiquette_parti", "candidat": "candidat", "total_voix": "total_voix",
         "orientation_politique": "orientation_politique"},
        "etiquette_parti",
    ),
    "securite": ("Année", "Département", UNIT, {"Délits_total": "delits_total"}, "delits_total"),
    "socio_economie": (
        "Année", "Code_INSEE_Région", REGION,
        {indicators.GDP: "pib_euros_par_habitant", indicators.INFLATION: "evolution_prix_conso",
         indicators.REAL_GDP: "pib_par_inflation"},
        "pib_par_inflation",
    ),
    "sante": ("Année", "CODE_DEP", UNIT, {indicators.LIFE: "esperance_vie"}, "esperance_vie"),
    "environnement": (
        "Année", "Code_INSEE_Région", REGION,
        {indicators.WIND: "parc_eolien_mw", indicators.SOLAR: "parc_solaire_mw"},
        "parc_eolien_mw",
    ),
    "education": (
        "annee_fermeture", "code_departement", UNIT,
        {"libelle_departement": "libelle_departement", "nombre_total_etablissements": "nombre_total_etablissements",
         "nb_public": "nb_public", "nb_prive": "nb_prive", "pct_public": "pct_public", "pct_prive": "pct_prive"},
        "nombre_total_etablissements",
    ),
    "demographie": (
        "Année", "Code_Département", UNIT,
        {"Nom_Département": "nom_departement", "E_Total": "population_totale", "H_Total": "population_hommes",
         "F_Total": "population_femmes", "E_0_19_ans": "pop_0_19", "E_20_39_ans": "pop_20_39",
         "E_40_59_ans": "pop_40_59", "E_60_74_ans": "pop_60_74", "E_75_plus": "pop_75_plus"},
        "population_totale",
    ),
    "technologie": ("annee", None, NATION, {"dird_pib_france_pourcentages": "depenses_rd_pib"}, "depenses_rd_pib"),
}

# Layouts of the GDP and price files.
OVERSEAS_GDP = StructType().add("Année", "string").add(indicators.GDP, "string").add("Codes", "string")
REGIONAL_GDP = (
    StructType().add("Code_INSEE_Région", "string").add("libgeo", "string").add("Année", "integer").add(indicators.GDP, "integer")
)
LAST_GDP = StructType().add("Code_INSEE_Région", "string").add("Libellé", "string").add(indicators.GDP, "integer")
PRICES = StructType().add("Année", "integer").add(indicators.INFLATION, "double")

# Blocks of the 2017 sheet and columns of the 2022 sheet.
BLOCKS_2017 = [("Nom17", "Prénom18", "Voix19"), ("Nom23", "Prénom24", "Voix25")]


def departments(spark: SparkSession, path: str) -> DataFrame:
    schema = "code_departement string, nom_departement string, code_region string, nom_region string"
    return read_delimited(spark, path, schema, sep=",")


def transform(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Processed table of every domain whose sources are named in ``paths`` (lazy).

    Workbook sheets are expected as CSV exports, one file per sheet.
    """
    out: dict[str, DataFrame] = {}
    if "environnement" in paths:
        raw = sanitise_columns(read_delimited(spark, paths["environnement"]))
        out["environnement"] = indicators.renewable_capacity(raw)
    if "pib_outre_mer" in paths:
        parts = [indicators.overseas_gdp(read_tagged(spark, [paths["pib_outre_mer"]], OVERSEAS_GDP))]
        if "pib_regions" in paths:
            parts.append(read_delimited(spark, paths["pib_regions"], REGIONAL_GDP))
        if "pib_2022" in paths:
            parts.append(read_delimited(spark, paths["pib_2022"], LAST_GDP).withColumn("Année", F.lit(2022)))
        gdp = indicators.all_gdp(parts)
        inflation = read_delimited(spark, paths["inflation"], PRICES)
        out["socio_economie"] = indicators.real_gdp(gdp, inflation)
    if "technologie" in paths:
        raw = read_any(spark, paths["technologie"])
        year, share = raw.columns[:2]
        out["technologie"] = indicators.research_share(raw, year, share)
    if "elections" in paths:
        votes = [elections.votes_by_candidate_columns(df) for df in read_by_header(spark, paths["elections"])]
        if "election_2017" in paths:
            raw = read_delimited(spark, paths["election_2017"])
            votes.append(
                elections.votes_by_candidate_blocks(raw, 2017, "Code du département", "Libellé du département", BLOCKS_2017)
            )
        if "election_2022" in paths:
            raw = read_delimited(spark, paths["election_2022"])
            votes.append(elections.votes_by_rows(raw, 2022, "Code du département", "Nom", "Prénom", "Voix"))
        parties = sanitise_columns(read_delimited(spark, paths["partis"], sep=","))
        out["politique"] = elections.with_orientation(elections.winners(votes), parties)
    if "esperance_de_vie" in paths:
        raw = read_delimited(spark, paths["esperance_de_vie"])
        out["sante"] = indicators.life_expectancy(raw, departments(spark, paths["departements"]))
    if "ecoles" in paths:
        out["education"] = indicators.schools_by_year(indicators.clean_schools(read_delimited(spark, paths["ecoles"])))
    if "delits" in paths:
        # One export per unit, named by its digits; the sheets share their month columns.
        sheets = read_tagged(spark, [paths["delits"]], tag="path")
        unit = F.regexp_extract("path", r"([0-9]+)\.csv", 1)
        out["securite"] = indicators.offences(sheets.withColumn("departement", unit).filter(unit != "").drop("path"))
    if "population" in paths:
        is_row = F.col("Code_Département").isNotNull()
        out["demographie"] = indicators.population(
            read_headerless(spark, paths["population"], indicators.POPULATION_COLUMNS, is_row)
        )
    return out


def save(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Write every processed table as a ``;`` CSV folder."""
    return {name: write_csv(df, processed_path(folder, f"{name}.csv")) for name, df in tables.items()}


def units_of(departements: DataFrame) -> DataFrame:
    """(unit, region) of the reported units."""
    rows = departements.select(
        pad_code(F.trim("code_departement")).alias("unit"), F.trim("code_region").alias("region")
    )
    return rows.filter(F.col("unit").isin(UNITS))


def _keyed(name: str, df: DataFrame) -> DataFrame:
    """A processed table with its year and place under common names and its columns renamed, in the types of the stored dimension.

    Processed tables come back from CSV as text; compared as text, "10" would be less than "9".
    """
    types = {f.name: f.dataType for f in schemas.DIMENSIONS[name].fields}
    year, place, level, renames, _ = DOMAINS[name]
    keys = [F.col(year).try_cast("int").alias("year")]
    if level == UNIT:
        keys.append(pad_code(F.trim(F.col(place).cast("string"))).alias("unit"))
    elif level == REGION:
        keys.append(F.trim(F.col(place).cast("string")).alias("region"))
    return df.select(*keys, *[F.col(c).try_cast(types[alias]).alias(alias) for c, alias in renames.items() if c in df.columns])


def consolidated(
    tables: Mapping[str, DataFrame],
    units: DataFrame,
    first: int = indicators.FIRST_YEAR,
    last: int = indicators.LAST_YEAR,
) -> DataFrame:
    """One row per year and reported unit with the headline value of every domain."""
    measures = [
        Measure(name, _keyed(name, tables[name]), DOMAINS[name][4], DOMAINS[name][2], optional=name == "education")
        for name in DOMAINS
        if name in tables
    ]
    panel = build_panel(measures, units, first, last, UNITS).drop("year", "unit")
    return panel.withColumnRenamed("panel_key", "annee_code_dpt").orderBy("annee_code_dpt")


def star_dimensions(tables: Mapping[str, DataFrame]) -> list[Dimension]:
    """Dimension tables with dense ids."""
    place = {UNIT: ["unit"], REGION: ["region"], NATION: ["year"]}
    return [
        Dimension(
            name,
            surrogate_id(_keyed(name, tables[name]), "year", place[DOMAINS[name][2]]),
            DOMAINS[name][2],
            attributes={DOMAINS[name][4]: name},
        )
        for name in DOMAINS
        if name in tables
    ]


def star(
    tables: Mapping[str, DataFrame],
    units: DataFrame,
    first: int = indicators.FIRST_YEAR,
    last: int = indicators.LAST_YEAR,
) -> tuple[list[Dimension], DataFrame]:
    dimensions = star_dimensions(tables)
    return dimensions, build_fact(dimensions, units, first, last)


def save_star(dimensions: list[Dimension], fact: DataFrame, folder: str) -> dict[str, str]:
    """Write dimension and fact tables under their stored column names and types."""
    folder = folder.rstrip("/")
    written: dict[str, str] = {}
    for d in dimensions:
        target = schemas.DIMENSIONS[d.name]
        place = next((c for c in target.names if c.startswith("code_")), "unit")
        year = "annee_fermeture" if "annee_fermeture" in target.names else "annee"
        written[d.name] = f"{folder}/dim_{d.name}"
        names = {"year": year, "unit": place, "region": place}
        conform(d.df, names, target, keep_id=True).write.mode("overwrite").parquet(written[d.name])
    written["fact"] = f"{folder}/fact_resultats_politique"
    names = {"panel_key": "annee_code_dpt", "politique_id": "id_parti", "socio_economie_id": "socio_eco_id"}
    conform(fact, names, schemas.FACT).write.mode("overwrite").parquet(written["fact"])
    return written


def append_results(results: DataFrame, path: str) -> str:
    """Add the result rows of one model run to the stored results."""
    conform(results, {}, schemas.MODEL_RESULTS).write.mode("append").parquet(path)
    return path


def model_sets(dimensions: list[Dimension], fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a known winner, rows without one)."""
    label = next(d for d in dimensions if d.name == "politique")
    return analysis_set(fact, dimensions, label, True), analysis_set(fact, dimensions, label, False)

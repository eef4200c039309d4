"""The domain pipelines on a few hand-made rows per layout."""

import datetime

import pytest
from pyspark.sql import functions as F

from panelspark.ml import pipeline
from panelspark.plans import elections, etl, indicators, schemas
from panelspark.sources.delimited import read_each


def text_df(spark, columns, values):
    return spark.createDataFrame(values, ", ".join(f"`{c}` string" for c in columns))


def test_winners_of_three_layouts(spark, tmp_path, rows):
    (tmp_path / "presi1974t2.csv").write_text(
        "Code département,département,Inscrits,GISCARD D'ESTAING (RI),MITTERRAND (PS)\n1,AIN,9,5,3\n01,AIN,9,2,3\n2A,CORSE,9,1,1\n",
        encoding="utf-8",
    )
    (tmp_path / "presi2012t2.csv").write_text(
        "Code département,Libellé du département,Code de la circonscription,François HOLLANDE (PS),Nicolas SARKOZY (UMP)\n01,AIN,1,5,n/a\n",
        encoding="utf-8",
    )
    votes = [elections.votes_by_candidate_columns(df) for df in read_each(spark, str(tmp_path / "presi*.csv"))]
    columns = ["Code du département", "Libellé du département", "Nom17", "Prénom18", "Voix19", "Nom23", "Prénom24", "Voix25"]
    sheet = text_df(spark, columns, [
        ("1.0", "Ain", "MACRON", "Emmanuel", "6", "LE PEN", "Marine", "7"),
        ("ZA", "Guadeloupe", "MACRON", "Emmanuel", "6", "LE PEN", "Marine", "5"),
        ("ZX", "Saint-Martin/Saint-Barthélemy", "MACRON", "Emmanuel", "1", "LE PEN", "Marine", "3"),
    ])
    votes.append(elections.votes_by_candidate_blocks(sheet, 2017, columns[0], columns[1], etl.BLOCKS_2017))
    last = text_df(spark, ["Code du département", "Nom", "Prénom", "Voix"], [
        ("ZD", "MACRON", "Emmanuel", "4"), ("ZD", "LE PEN", "Marine", "6"), ("ZD", "MACRON", "Emmanuel", "4"),
    ])
    votes.append(elections.votes_by_rows(last, 2022, "Code du département", "Nom", "Prénom", "Voix"))
    parties = spark.createDataFrame(
        [("2", "gauche"), ("4", "centre"), ("5", "centre droite"), ("5", "centre droite"), ("7", "extreme droite")],
        "id string, Orientation_politique string",
    )
    got = elections.with_orientation(elections.winners(votes), parties)
    assert rows(got, "annee", "code_dept", "candidat", "total_voix", "orientation_politique", "id_parti") == [
        (1974, "01", "Valéry GISCARD DESTAING", 7, "centre droite", 5),
        (1974, "2A", "Valéry GISCARD DESTAING", 1, "centre droite", 5),
        (2012, "01", "François HOLLANDE", 5, "gauche", 2),
        (2017, "01", "Marine LE PEN", 7, "extreme droite", 7),
        (2017, "971", "Marine LE PEN", 8, "extreme droite", 7),
        (2022, "974", "Emmanuel MACRON", 8, "centre", 4),
    ]


def test_surname_of_2002(spark):
    votes = spark.createDataFrame([(2002, "01", "LE PEN", 5), (2002, "01", "CHIRAC", 4)], "annee int, code_dept string, candidat string, voix bigint")
    assert elections.winners([votes]).first()["candidat"] == "Jean-Marie LE PEN"


def test_files_without_candidates_are_an_error(spark):
    with pytest.raises(ValueError):
        elections.votes_by_candidate_columns(text_df(spark, ["a", "source_file"], [("1", "f")]))


def test_renewable_capacity(spark, rows):
    raw = text_df(spark, ["Code_INSEE_région", "Année", indicators.WIND, indicators.SOLAR], [
        ("84", "2001", "1.5", None), ("84", "2001", "1", "2"), ("11", "2002", "x", "3"),
    ])
    assert rows(indicators.renewable_capacity(raw)) == [
        ("11", 2000, 0.0, 0.0), ("11", 2002, 0.0, 3.0), ("84", 2000, 0.0, 0.0), ("84", 2001, 2.5, 2.0),
    ]


def test_gdp(spark, rows):
    known = {2014: "8500", 2015: "8800", 2016: "9200"}
    values = [("idBank", "1", "", "d/PIB Mayotte.csv"), ("Période", None, None, "d/PIB Mayotte.csv")]
    values += [(str(y), known.get(y), "O", "d/PIB Mayotte.csv") for y in range(1999, 2017)]
    values += [("2001", None, "O", "d/PIB Guyane.csv"), ("2002", "10", "A", "d/PIB Guyane.csv"), ("2003", "11", "A", "d/PIB Guyane.csv")]
    overseas = indicators.overseas_gdp(text_df(spark, ["Année", indicators.GDP, "Codes", "source_file"], values))
    mainland = spark.createDataFrame([("84", 2000, 20000), ("M", 2000, 1), ("84", 1999, 5), ("84", 2001, None)], f"`Code_INSEE_Région` string, `Année` int, {indicators.GDP} int")
    gdp = {(r[0], r[1]): r[2] for r in indicators.all_gdp([overseas, mainland]).select("Code_INSEE_Région", "Année", indicators.GDP).collect()}
    assert gdp[("06", 2014)] == 8500 and gdp[("06", 2000)] == int(26500 / 3 - 350 * 15)
    assert ("03", 2001) not in gdp and gdp[("03", 2002)] == 10  # gaps elsewhere stay gaps
    assert ("84", 2000) in gdp and not {("M", 2000), ("84", 1999), ("84", 2001)} & set(gdp)
    prices = spark.createDataFrame([(2000, 1.654)], f"`Année` int, `{indicators.INFLATION}` double")
    real = {(r[0], r[1]): r[2] for r in indicators.real_gdp(indicators.all_gdp([mainland]), prices).select("Code_INSEE_Région", "Année", indicators.REAL_GDP).collect()}
    assert real == {("84", 2000): round(20000 / 1.0165, 2)}


def test_research_share(spark, rows):
    raw = text_df(spark, ["_c0", "DIRD/PIB  France"], [("1990.0", "2.274"), ("NaN", "2.2"), ("2000", None)])
    assert rows(indicators.research_share(raw)) == [("1990", 2.27), ("2000", None), ("2023", 2.2)]


def test_life_expectancy(spark, rows):
    departments = text_df(spark, ["code_departement", "nom_departement"], [("21", "Côte-d'Or"), ("976", "Mayotte")])
    years = [str(y) for y in range(2000, 2004)]
    stem = "Espérance de vie à la naissance - "
    raw = text_df(spark, ["Libellé", *years], [
        (stem + "Hommes - Côte d'Or", "75", "75.1", None, "76"), (stem + "Femmes - Côte d'Or", "82", "82.2", "83", "83"),
        (stem + "Hommes - Mayotte", None, "70", "71", "72"), (stem + "Femmes - Mayotte", None, "72", "73", "74"),
        (stem + "Hommes - Bourgogne", "1", "1", "1", "1"), ("Autre - Hommes - Mayotte", "1", "1", "1", "1"),
    ])
    assert rows(indicators.life_expectancy(raw, departments, 2000, 2003), "CODE_DEP", "Année", indicators.LIFE) == [
        ("21", 2000, 78.5), ("21", 2001, 78.65), ("21", 2002, None), ("21", 2003, 79.5),
        ("976", 2000, 70.0), ("976", 2001, 71.0), ("976", 2002, 72.0), ("976", 2003, 73.0),
    ]


def test_schools(spark, rows):
    columns = ["numero_uai", "code_departement", "libelle_departement", "date_fermeture", "code_postal", "secteur_public_prive_libe"]
    raw = text_df(spark, columns, [
        ("A", "1", " AIN", "2001-05-01", None, "Public"), ("A", "1", " AIN", "2001-05-01", None, "Public"),
        ("B", "01", "L'AIN", "2001-06-01", "01000", "PRIVÉ"), ("C", "1", "AIN", "1999-01-01", "1", "Public"),
        ("D", "2A", "CORSE", "2001-01-01", "1", "Public"), ("E", "2", "AISNE", "bad", "1", None),
    ])
    cleaned = indicators.clean_schools(raw)
    assert {r.code_postal for r in cleaned.filter("numero_uai = 'a'").collect()} == {"00000"}
    got = rows(
        indicators.schools_by_year(cleaned, 2000, 2001),
        "code_departement", "annee_fermeture", "libelle_departement", "nombre_total_etablissements", "nb_public", "nb_prive", "pct_public", "pct_prive",
    )
    assert got == [
        ("01", 1999, "ain", 1, 1, 0, 100.0, 0.0), ("01", 2000, "ain", 0, 0, 0, 0.0, 0.0), ("01", 2001, "ain", 2, 1, 1, 50.0, 50.0),
        ("02", 2000, "aisne", 0, 0, 0, 0.0, 0.0), ("02", 2001, "aisne", 0, 0, 0, 0.0, 0.0),
    ]


def test_offences_and_population(spark, rows):
    sheets = text_df(spark, ["departement", "_1995_12", "_1996_01", "_1996_02", "Index"], [("1", "9", "2", None, "x"), ("1", "9", "1", "4", "y"), (None,) * 5])
    assert rows(indicators.offences(sheets.filter(F.col("departement").isNotNull()))) == [(1996, "01", 7)]
    values = [tuple(["\"01\" ", "Ain"] + [str(i) for i in range(18)] + ["2000"]), tuple(["Départements", "x"] + ["a"] * 18 + ["Année"])]
    got = indicators.population(text_df(spark, [f"_c{i}" for i in range(21)], values)).collect()
    assert len(got) == 1 and got[0]["Code_Département"] == "01" and got[0]["E_Total"] == 5 and got[0]["F_Total"] == 17


def test_end_to_end(spark, tmp_path):
    """Files in, processed files, panel, star and model sets out."""

    def put(name, text):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    ages = ";".join(str(i) for i in range(1, 19))
    paths = {
        "environnement": put("env.csv", "Année;Code INSEE région;Région;Parc installé éolien (MW);Parc installé solaire (MW)\n2002;84;ARA;3.0;1\n"),
        "pib_outre_mer": put("PIB Mayotte.csv", "Libellé;PIB;Codes\nidBank;1;\n2002;5000;A\n2003;5100;A\n"),
        "pib_regions": put("pib.csv", "c;l;a;p\n84;ARA;2002;25000\n"),
        "pib_2022": put("pib22.csv", "c;l;p\n84;ARA;30000\n"),
        "inflation": put("prix.csv", "Année;Évolution\n2002;2.0\n"),
        "technologie": put("tech.csv", "annee,part\n2002.0,2.17\n"),
        "elections": put("presi2002t2.csv", "Code département,CHIRAC (RPR),LE PEN (FN)\n01,9,2\n02,9,2\n"),
        "partis": put("partis.csv", "id, Nom du parti,Orientation politique\n6,DLF,droite\n"),
        "departements": put("dep.csv", "code_departement,nom_departement,code_region,nom_region\n01,Ain,84,ARA\n02,Aisne,32,HDF\n2A,Corse-du-Sud,94,Corse\n"),
        "esperance_de_vie": put("vie.csv", "Libellé;" + ";".join(map(str, range(2000, 2023))) + "\n" + "".join(f"Espérance de vie à la naissance - {s} - Ain;{';'.join([v] * 23)}\n" for s, v in (("Hommes", "78"), ("Femmes", "82")))),
        "ecoles": put("ecoles.csv", "numero_uai;code_departement;libelle_departement;date_fermeture;code_postal;secteur_public_prive_libe\nA;1;Ain;2002-08-31;01000;Public\n"),
        "population": put("pop.csv", f"Départements;;{ages};\n01;Ain;{ages};2002\n01;Ain;{ages};2003\n"),
    }
    put("delits/01.csv", "Index;_2002_01;_2002_02\n1;5;6\n2;;1\n")
    put("delits/notes.csv", "Index;_2002_01;_2002_02\n1;100;100\n")
    paths["delits"] = str(tmp_path / "delits" / "*.csv")
    tables = etl.transform(spark, paths)
    assert set(tables) == set(etl.DOMAINS)
    saved = etl.save(tables, str(tmp_path / "out"))
    reread = {name: etl.read_delimited(spark, path) for name, path in saved.items()}
    units = etl.units_of(etl.departments(spark, paths["departements"]))
    panel = {r["annee_code_dpt"]: r.asDict() for r in etl.consolidated(reread, units).collect()}
    assert len(panel) == 24  # unit 01 in 23 years, unit 02 once
    full = panel["2002_01"]
    assert (full["politique"], full["securite"], full["sante"]) == (6, 12, 80.0)
    assert (full["socio_economie"], full["environnement"], full["education"]) == (24509.8, 3.0, 1)
    assert (full["demographie"], full["technologie"]) == (6, 2.17)
    dimensions, fact = etl.star(reread, units)
    labelled, unlabelled = etl.model_sets(dimensions, fact)
    assert [r["panel_key"] for r in labelled.collect()] == ["2002_01"] and unlabelled.count() == 0

    stored = etl.save_star(dimensions, fact, str(tmp_path / "star"))
    assert spark.read.parquet(stored["fact"]).columns == schemas.FACT.names
    for name, target in schemas.DIMENSIONS.items():
        got = spark.read.parquet(stored[name])
        assert set(got.columns) <= set(target.names) and "id" in got.columns
        assert all(got.schema[c].dataType == target[c].dataType for c in got.columns)
    assert set(spark.read.parquet(stored["politique"]).columns) == set(schemas.DIMENSIONS["politique"].names)


def test_result_rows_are_appended(spark, tmp_path):
    run = spark.createDataFrame([(1, datetime.datetime(2024, 1, 1), "KNN", "", 0.5, 0.4, 0.1, 2, "Gauche", 60.0, None)], pipeline.RESULTS)
    path = str(tmp_path / "results")
    etl.append_results(run, path)
    etl.append_results(run, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 2 and stored.columns == schemas.MODEL_RESULTS.names

"""The domain pipelines on the test tables, written out in the layouts that they read.

Units are nations, regions are regions, candidates are market segments; each query runs the plan function itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.text import pad_code
from panelspark.plans import elections, indicators
from panelspark.queries.base import order_facts
from panelspark.queries.registry import query
from panelspark.sinks.writers import write_csv
from panelspark.sources.delimited import read_by_header, read_delimited, read_headerless, read_tagged
from panelspark.tables import settle, shared_dir, table

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _count_votes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders by year, nation and segment."""
    return settle(order_facts(spark, sf).select("year", "unit", "candidate", "n"), "votes")


_VOTES = """v AS (SELECT year(o_orderdate) AS annee, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code_dept, c_mktsegment AS segment,
    count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)"""


@query(
    "domain_elections",
    f"""WITH {_VOTES}, named AS (SELECT annee, code_dept, n,
        CASE WHEN annee <= 1996 THEN segment ELSE concat(segment, ' Candidate') END AS candidat FROM v WHERE annee <= 1998)
    SELECT annee::BIGINT AS annee, code_dept, candidat, n AS total_voix FROM named
    QUALIFY row_number() OVER (PARTITION BY annee, code_dept ORDER BY n DESC, candidat) = 1""",
)
def domain_elections(spark, sf):
    """Winners from three layouts: a file per year with a column for each candidate (the first file lacks one column that the
    second has), candidates side by side, and one row per candidate."""
    votes = _count_votes(spark, sf)
    folder = shared_dir(spark, "elections")
    for year in (1995, 1996):
        wide = votes.filter(F.col("year") == year).groupBy(F.col("unit").alias("Code département")).pivot("candidate", SEGMENTS).agg(F.sum("n"))
        wide = wide.select("Code département", *[F.col(s).alias(f"{s} (PARTY)") for s in SEGMENTS])
        if year == 1996:
            wide = wide.withColumn("Inscrits", F.lit(1))
        write_csv(wide, f"{folder}/presi{year}", sep=",")
    columns = [elections.votes_by_candidate_columns(df) for df in read_by_header(spark, f"{folder}/presi*")]

    blocks = [(f"Nom{k}", f"Prénom{k}", f"Voix{k}") for k in range(len(SEGMENTS))]
    side = votes.filter("year = 1997").groupBy(F.col("unit").alias("Code")).pivot("candidate", SEGMENTS).agg(F.sum("n"))
    side = side.select(
        "Code", F.lit("nowhere").alias("Lieu"),
        *[c for s, (a, b, v) in zip(SEGMENTS, blocks) for c in (F.lit(s).alias(a), F.lit("Candidate").alias(b), F.col(s).alias(v))],
    )
    write_csv(side, f"{folder}/blocks")
    side = elections.votes_by_candidate_blocks(read_delimited(spark, f"{folder}/blocks"), 1997, "Code", "Lieu", blocks)

    rows = votes.filter("year = 1998").select(
        F.col("unit").alias("Code"), F.col("candidate").alias("Nom"), F.lit("Candidate").alias("Prénom"), F.col("n").alias("Voix")
    )
    write_csv(rows, f"{folder}/rows")
    rows = elections.votes_by_rows(read_delimited(spark, f"{folder}/rows"), 1998, "Code", "Nom", "Prénom", "Voix")
    won = elections.winners([*columns, side, rows])
    return won.select(F.col("annee").cast("bigint").alias("annee"), "code_dept", "candidat", "total_voix")


@query(
    "domain_renewables",
    """WITH c AS (SELECT CAST(n_regionkey AS VARCHAR) AS region, year(l_shipdate) AS annee,
        coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0.0) AS wind, coalesce(sum(l_quantity) FILTER (l_returnflag <> 'R'), 0.0) AS solar
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
    SELECT region, annee, wind, solar FROM c UNION ALL SELECT DISTINCT region, 1990, 0.0, 0.0 FROM c""",
)
def domain_renewables(spark, sf):
    """Capacities per region and year from rows per nation, with the year before the first at zero."""
    quantity = F.col("l_quantity")
    per_supplier = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("Année")).agg(
        F.sum(F.when(F.col("l_returnflag") == "R", quantity)).alias(indicators.WIND),
        F.sum(F.when(F.col("l_returnflag") != "R", quantity)).alias(indicators.SOLAR),
    )
    place = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    raw = per_supplier.join(place, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("n_regionkey").alias("Code_INSEE_région"), "Année", indicators.WIND, indicators.SOLAR
    )
    path = write_csv(raw, shared_dir(spark, "renewables"))
    found = indicators.renewable_capacity(read_delimited(spark, path), baseline=1990)
    return found.select(
        F.col("Code_INSEE_Région").alias("region"), F.col("Année").cast("bigint").alias("annee"),
        F.col(indicators.WIND).alias("wind"), F.col(indicators.SOLAR).alias("solar"),
    )


@query(
    "domain_real_gdp",
    """WITH g AS (SELECT year(o_orderdate) AS annee, CAST(n_regionkey AS VARCHAR) AS region, CAST(floor(avg(o_totalprice)) AS BIGINT) AS gdp
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
    p AS (SELECT year(l_shipdate) AS annee, round(avg(l_discount) * 100, 2) AS rate FROM lineitem GROUP BY 1)
    SELECT annee, region, gdp, round(gdp / (1 + rate / 100), 2) AS real_gdp FROM g LEFT JOIN p USING (annee)
    WHERE annee BETWEEN 1995 AND 2000""",
)
def domain_real_gdp(spark, sf):
    """Two sources of yearly values, one below title lines, over the price change of the year."""
    orders = table(spark, sf, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("Année")).agg(
        F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n")
    )
    customer = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    value = F.floor(F.sum("total") / F.sum("n")).cast("int").alias(indicators.GDP)
    gdp = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("Année", F.col("n_regionkey").cast("string").alias("Code_INSEE_Région")).agg(value)
    gdp = settle(gdp, "gdp")
    folder = shared_dir(spark, "gdp")
    # The value columns of a file are text below its title lines; its region is told by its name.
    file = gdp.filter(F.col("Code_INSEE_Région") == "0").select(F.col("Année").cast("string"), F.col(indicators.GDP).cast("string"))
    titles = spark.createDataFrame([("Titre", "PIB"), ("Unité", "euros")], file.schema)
    write_csv(titles.unionByName(file), f"{folder}/overseas")
    tagged = read_tagged(spark, [f"{folder}/overseas"], tag="path").withColumn("source_file", F.lit("x/PIB Zero.csv"))
    first = indicators.overseas_gdp(tagged, {"PIB Zero.csv": "0"}, fill=())
    parts = [first, gdp.filter(F.col("Code_INSEE_Région") != "0")]
    rate = F.sum("rate") / F.sum("n")
    prices = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("Année")).agg(
        F.sum("l_discount").alias("rate"), F.count(F.lit(1)).alias("n")
    ).groupBy("Année").agg((rate * 100).alias(indicators.INFLATION))
    real = indicators.real_gdp(indicators.all_gdp(parts, 1995, 2000), prices)
    return real.select(
        F.col("Année").cast("bigint").alias("annee"), F.col("Code_INSEE_Région").alias("region"),
        F.col(indicators.GDP).cast("bigint").alias("gdp"), F.col(indicators.REAL_GDP).alias("real_gdp"),
    )


@query(
    "domain_life_expectancy",
    """WITH a AS (SELECT c_nationkey AS unit, year(o_orderdate) AS annee, c_custkey % 2 AS sex, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)
    SELECT lpad(CAST(unit AS VARCHAR), 2, '0') AS code, annee, round((sum(n) FILTER (sex = 0) + sum(n) FILTER (sex = 1)) / 2, 2) AS value
    FROM a WHERE annee BETWEEN 1995 AND 2000 GROUP BY 1, 2""",
)
def domain_life_expectancy(spark, sf):
    """One row per sex and place, one column per year; places are matched by names that are spelt differently."""
    sex = F.when(F.col("c_custkey") % 2 == 0, "Hommes").otherwise("Femmes").alias("sex")
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")).count()
    counts = counts.join(table(spark, sf, "customer"), "c_custkey").groupBy("c_nationkey", sex, "year").agg(F.sum("count").cast("double").alias("n"))
    years = [str(y) for y in range(1995, 2001)]
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    label = F.concat(F.lit("Espérance de vie à la naissance - "), "sex", F.lit(" - "), F.initcap("n_name"))
    raw = counts.join(nation, "c_nationkey").groupBy(label.alias("Libellé")).pivot("year", [int(y) for y in years]).agg(F.sum("n"))
    path = write_csv(raw, shared_dir(spark, "life"))
    departments = nation.select(
        pad_code(F.col("c_nationkey").cast("string")).alias("code_departement"), F.replace("n_name", F.lit(" "), F.lit("-")).alias("nom_departement")
    )
    found = indicators.life_expectancy(read_delimited(spark, path), departments, 1995, 2000, fill=())
    return found.select(F.col("CODE_DEP").alias("code"), F.col("Année").cast("bigint").alias("annee"), F.col(indicators.LIFE).alias("value"))


@query(
    "domain_schools",
    """WITH s AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS code, year(o_orderdate) AS annee, count(*) AS n,
        count(*) FILTER (o_orderstatus = 'F') AS n_public, count(*) FILTER (o_orderstatus = 'O') AS n_private
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT' AND c_nationkey BETWEEN 1 AND 95 GROUP BY 1, 2),
    g AS (SELECT DISTINCT code, y.annee FROM s CROSS JOIN range(1994, 2003) y(annee)),
    d AS (SELECT code, annee, coalesce(n, 0) AS n, coalesce(n_public, 0) AS n_public, coalesce(n_private, 0) AS n_private
      FROM g FULL JOIN s USING (code, annee))
    SELECT code, annee, n, n_public, n_private, CASE WHEN n > 0 THEN round(n_public * 100.0 / n, 2) ELSE 0.0 END AS pct_public FROM d""",
)
def domain_schools(spark, sf):
    """Schools (urgent orders) by unit and year of closing, dense over the years; copies and codes out of range do not count."""
    orders = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    rows = orders.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("numero_uai"), F.col("c_nationkey").alias("code_departement"), F.lit("Somewhere ").alias("libelle_departement"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_fermeture"),
        F.when(F.col("o_orderstatus") == "F", " PUBLIC").when(F.col("o_orderstatus") == "O", "Privé").alias("secteur_public_prive_libe"),
    )
    path = write_csv(rows.unionByName(rows), shared_dir(spark, "schools"))
    found = indicators.schools_by_year(indicators.clean_schools(read_delimited(spark, path)), 1994, 2002)
    return found.select(
        F.col("code_departement").alias("code"), F.col("annee_fermeture").cast("bigint").alias("annee"),
        F.col("nombre_total_etablissements").cast("bigint").alias("n"), F.col("nb_public").cast("bigint").alias("n_public"),
        F.col("nb_prive").cast("bigint").alias("n_private"), F.col("pct_public"),
    )


@query(
    "domain_offences",
    """WITH m AS (SELECT lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS unit, year(l_shipdate) AS annee, sum(l_quantity)::BIGINT AS n
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
    SELECT u.unit, y.annee, coalesce(n, 0) AS total FROM (SELECT DISTINCT unit FROM m) u CROSS JOIN range(1996, 2000) y(annee)
      LEFT JOIN m ON m.unit = u.unit AND m.annee = y.annee""",
)
def domain_offences(spark, sf):
    """One row per supplier in the sheet of its nation, one column per month; only the asked years are summed."""
    lines = table(spark, sf, "lineitem").select("l_suppkey", F.date_format("l_shipdate", "'_'yyyy'_'MM").alias("month"), "l_quantity")
    months = [f"_{y}_{m:02d}" for y in range(1995, 2001) for m in range(1, 13)]
    sheets = lines.groupBy(F.col("l_suppkey").alias("s_suppkey")).pivot("month", months).agg(F.sum("l_quantity"))
    sheets = sheets.join(table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("departement")), "s_suppkey").drop("s_suppkey")
    path = write_csv(sheets, shared_dir(spark, "offences"))
    found = indicators.offences(read_delimited(spark, path), years=range(1996, 2000))
    return found.select(F.col("Département").alias("unit"), F.col("Année").cast("bigint").alias("annee"), F.col("Délits_total").alias("total"))


@query(
    "domain_population",
    """SELECT CAST(c_nationkey AS VARCHAR) AS code, c_mktsegment AS name, year(o_orderdate) AS annee, count(*) AS total,
      count(*) FILTER (o_orderstatus = 'F') AS women FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3""",
)
def domain_population(spark, sf):
    """Twenty-one columns by position, quoted codes, header lines inside."""
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f")
    )
    counts = counts.join(table(spark, sf, "customer"), "c_custkey").groupBy("c_nationkey", "c_mktsegment", "year").agg(F.sum("n").alias("n"), F.sum("f").alias("f"))
    zero = [F.lit(0)] * 5
    code = F.concat(F.lit('"'), F.col("c_nationkey").cast("string"), F.lit('"'))
    values = [code, F.col("c_mktsegment"), *zero, F.col("n"), *zero, F.lit(0), *zero, F.col("f"), F.col("year")]
    columns = indicators.POPULATION_COLUMNS
    path = write_csv(counts.select(*[v.cast("string").alias(c) for v, c in zip(values, columns)]), shared_dir(spark, "population"))
    found = indicators.population(read_headerless(spark, path, columns, F.col(columns[0]).isNotNull()))
    return found.select(
        F.col("Code_Département").alias("code"), F.col("Nom_Département").alias("name"), F.col("Année").cast("bigint").alias("annee"),
        F.col("E_Total").cast("bigint").alias("total"), F.col("F_Total").cast("bigint").alias("women"),
    )

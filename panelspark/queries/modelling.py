"""Model pipeline: splits, scaling, neighbours, votes, scores, predictions by year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.functions.text import panel_key_year
from panelspark.ml import evaluate, knn, noise, predict, scale, split, vote
from panelspark.operators.rank import distribution, majority
from panelspark.plans.etl import append_results
from panelspark.plans.schemas import MODEL_RESULTS
from panelspark.queries.base import big
from panelspark.queries.panels import FACT, INDICATORS, analysis_sets
from panelspark.queries.registry import query
from panelspark.sources.delimited import stack
from panelspark.tables import settle, settle_all, shared_dir, table

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]
PANEL_FEATURES = INDICATORS
# The same features in SQL, in order.
_FEATURES = ["d_sec.n::DOUBLE", "d_soc.value", "d_sat.value", "d_env.value", "d_edu.n::DOUBLE", "d_dem.n::DOUBLE", "d_tec.value"]


def _each(template: str, between: str = ", ") -> str:
    """The template once for each feature: ``{i}`` is its number, ``{x}`` its expression."""
    return between.join(template.format(i=i, x=x) for i, x in enumerate(_FEATURES))


_PARTS = """parts AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5(concat(CAST(id AS VARCHAR), '|42')), id)
      <= ceil(count(*) OVER (PARTITION BY label) * 80 / 100.0) THEN 'train' ELSE 'test' END AS part FROM labelled)"""
_LABELLED = "labelled AS (SELECT doc_id AS id, CAST(quality * 10 + toxic AS BIGINT) AS label FROM labels)"


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    code = (F.col("quality") * 10 + F.col("toxic")).cast("bigint")
    return table(spark, sf, "labels").select(F.col("doc_id").alias("id"), code.alias("label"))


@query(
    "ml_rare_class_filter",
    f"""WITH {_LABELLED} SELECT id, label FROM labelled
    WHERE label IN (SELECT label FROM labelled GROUP BY 1 HAVING count(*) > 2)""",
)
def ml_rare_class_filter(spark, sf):
    return split.without_rare_classes(_labels(spark, sf), "label", more_than=2)


@query("ml_stratified_split", f"WITH {_LABELLED}, {_PARTS} SELECT id, label, part FROM parts")
def ml_stratified_split(spark, sf):
    return split.split(_labels(spark, sf), "id", ["label"], 80, 42)


@query(
    "ml_sample",
    """SELECT o_orderkey AS id FROM orders QUALIFY
    row_number() OVER (ORDER BY md5(concat(CAST(o_orderkey AS VARCHAR), '|42')), o_orderkey) <= ceil(count(*) OVER () * 50 / 100.0)""",
)
def ml_sample(spark, sf):
    return split.sample(table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")), "id", 50, 42)


@query(
    "ml_folds",
    f"""WITH {_LABELLED} SELECT id, label,
      ((row_number() OVER (PARTITION BY label ORDER BY md5(concat(CAST(id AS VARCHAR), '|42')), id) - 1) % 5)::BIGINT AS fold
    FROM labelled""",
)
def ml_folds(spark, sf):
    return split.folds(_labels(spark, sf), "id", "label", 5, 42).withColumn("fold", F.col("fold").cast("bigint"))


def _orders_split(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("label"), F.col("o_totalprice").alias("price"),
        F.year("o_orderdate").cast("double").alias("year"),
    )
    return split.split(orders, "id", ["label"], 80, 42)


_ORDER_PARTS = f"""WITH labelled AS (SELECT o_orderkey AS id, o_orderpriority AS label, o_totalprice AS price,
      year(o_orderdate)::DOUBLE AS year FROM orders), {_PARTS}"""


@query(
    "ml_scale_standard",
    f"""{_ORDER_PARTS}, m AS (SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(year) AS my, stddev_pop(year) AS sy
      FROM parts WHERE part = 'train')
    SELECT id, part, round((price - mp) / sp, 6) AS price, round((year - my) / sy, 6) AS year FROM parts CROSS JOIN m""",
)
def ml_scale_standard(spark, sf):
    rows = _orders_split(spark, sf)
    scaler = scale.fit_standard(rows.filter("part = 'train'"), ["price", "year"])
    scaled = scaler.apply(rows)
    return scaled.select("id", "part", F.round("price", 6).alias("price"), F.round("year", 6).alias("year"))


@query(
    "ml_scale_minmax",
    f"""{_ORDER_PARTS}, m AS (SELECT min(price) AS lp, max(price) AS hp, min(year) AS ly, max(year) AS hy
      FROM parts WHERE part = 'train')
    SELECT id, part, (price - lp) / (hp - lp) AS price, (year - ly) / (hy - ly) AS year, 0.0::DOUBLE AS constant
    FROM parts CROSS JOIN m""",
)
def ml_scale_minmax(spark, sf):
    rows = _orders_split(spark, sf).withColumn("constant", F.lit(7.0))
    scaler = scale.fit_minmax(rows.filter("part = 'train'"), ["price", "year", "constant"])
    return scaler.apply(rows).select("id", "part", "price", "year", "constant")


@query(
    "ml_noise",
    """WITH h AS (SELECT o_orderkey AS id, o_totalprice AS price,
        md5(concat(CAST(o_orderkey AS VARCHAR), '|42|price')) AS code FROM orders),
      u AS (SELECT id, price, (CAST('0x' || substr(code, 1, 13) AS BIGINT) + 1) / 4503599627370496.0 AS a,
        (CAST('0x' || substr(code, 14, 13) AS BIGINT) + 1) / 4503599627370496.0 AS b FROM h),
      s AS (SELECT stddev_samp(o_totalprice) AS sd FROM orders)
    SELECT id, round(price + sqrt(-2 * ln(a)) * cos(2 * pi() * b) * 0.3 * sd, 4) AS price FROM u CROSS JOIN s""",
)
def ml_noise(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    return noise.add_noise(orders, "id", ["price"], 0.3, 42).select("id", F.round("price", 4).alias("price"))


# Neighbours over the embeddings: 80 % of every label train, the rest is classified.
_VECTORS = f"""WITH labelled AS (SELECT vec_id AS id, label::BIGINT AS label, embedding::DOUBLE[] AS v FROM embeddings), {_PARTS},
    d AS (SELECT q.id, q.label AS actual, t.id AS neighbour, t.label,
        list_sum(list_transform(list_zip(q.v, t.v), lambda p: abs(p[1] - p[2]))) AS l1,
        sqrt(list_sum(list_transform(list_zip(q.v, t.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS l2
      FROM parts q JOIN parts t ON q.part = 'test' AND t.part = 'train'),
    n1 AS (SELECT id, actual, label, 1.0::DOUBLE AS w FROM d
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY l1, neighbour) <= 2),
    n2 AS (SELECT id, actual, label, l2 FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY l2, neighbour) <= 3),
    n2w AS (SELECT id, actual, label, CASE WHEN min(l2) OVER (PARTITION BY id) = 0 THEN (l2 = 0)::INT::DOUBLE ELSE 1.0 / l2 END AS w
      FROM n2),
    p1 AS (SELECT id, actual, label AS prediction FROM (SELECT id, actual, label, sum(w) AS s FROM n1 GROUP BY 1, 2, 3)
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, label) = 1),
    p2 AS (SELECT id, actual, label AS prediction FROM (SELECT id, actual, label, sum(w) AS s FROM n2w GROUP BY 1, 2, 3)
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, label) = 1),
    pv AS (SELECT id, actual, prediction FROM (SELECT id, actual, prediction, count(*) AS s
        FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2) GROUP BY 1, 2, 3)
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY s DESC, prediction) = 1)"""


def _vectors(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), big("label"), F.col("embedding").cast("array<double>").alias("v")
    )
    parts = settle(split.split(rows, "id", ["label"], 80, 42), "vector-parts")
    return parts.filter("part = 'train'").drop("part"), parts.filter("part = 'test'").drop("part")


def _with_actual(predicted: DataFrame, test: DataFrame) -> DataFrame:
    return predicted.join(test.select("id", F.col("label").alias("actual")), "id")


def _manhattan(spark, sf):
    train, test = _vectors(spark, sf)
    return _with_actual(knn.predict(train, test, "id", "v", "label", 2), test)


@query("ml_knn", f"{_VECTORS} SELECT id, actual, prediction FROM p1")
def ml_knn(spark, sf):
    return _manhattan(spark, sf)


@query("ml_knn_weighted", f"{_VECTORS} SELECT id, actual, prediction FROM p2")
def ml_knn_weighted(spark, sf):
    train, test = _vectors(spark, sf)
    return _with_actual(knn.predict(train, test, "id", "v", "label", 3, "euclidean", "distance"), test)


def _three_models(spark, sf):
    """Two neighbour models and their vote, each settled as (id, prediction, actual)."""
    train, test = _vectors(spark, sf)
    tables = settle_all(
        {
            "knn-l1": knn.predict(train, test, "id", "v", "label", 2),
            "knn-l2": knn.predict(train, test, "id", "v", "label", 3, "euclidean", "distance"),
        }
    )
    voted = vote.hard_vote(list(tables.values()), "id")
    return [_with_actual(p, test) for p in (*tables.values(), voted)]


@query("ml_vote", f"{_VECTORS} SELECT id, actual, prediction FROM pv")
def ml_vote(spark, sf):
    return _three_models(spark, sf)[2]


@query(
    "ml_results_stored",
    f"""{_VECTORS}, m AS (SELECT 'KNN' AS model_name, * FROM p1 UNION ALL SELECT 'Weighted KNN', * FROM p2 UNION ALL SELECT 'Vote', * FROM pv),
      s AS (SELECT model_name, sum((actual = prediction)::INT) AS hits, count(*) AS n_rows FROM m GROUP BY 1),
      w AS (SELECT model_name, prediction, count(*) AS n FROM m GROUP BY 1, 2
        QUALIFY row_number() OVER (PARTITION BY model_name ORDER BY count(*) DESC, prediction) = 1),
      r AS (SELECT * FROM (VALUES ('2024-01-01', 'KNN'), ('2024-01-01', 'Weighted KNN'), ('2024-02-01', 'KNN'), ('2024-02-01', 'Vote')) v(run_date, model_name))
    SELECT run_date, model_name, round(hits / n_rows, 6) AS accuracy, prediction AS winner_id, concat('label ', prediction) AS winner_name,
      round(n * 100.0 / n_rows, 4) AS winner_pct FROM r JOIN s USING (model_name) JOIN w USING (model_name)""",
)
def ml_results_stored(spark, sf):
    """The rows of two runs are appended to one stored table of results, which is read back: a later run leaves the earlier one's rows."""
    named = zip(["KNN", "Weighted KNN", "Vote"], _three_models(spark, sf))
    predicted = settle(stack([p.withColumn("model_name", F.lit(name)) for name, p in named]), "named-predictions")
    scored = predicted.groupBy("model_name").agg((F.count_if(F.col("actual") == F.col("prediction")) / F.count(F.lit(1))).alias("accuracy"))
    won = majority(predicted, "prediction", ["model_name"]).withColumnsRenamed({"prediction": "winner_id", "pct": "winner_pct"})
    rows = settle(scored.join(won, "model_name").drop("n", "n_rows"), "model-scores")
    path = shared_dir(spark, "model-results")
    for day, models in {"2024-01-01": ["KNN", "Weighted KNN"], "2024-02-01": ["KNN", "Vote"]}.items():
        run = rows.filter(F.col("model_name").isin(models)).withColumns(
            {
                "run_timestamp": F.lit(day).cast("timestamp"),
                "description": F.lit("neighbours of embeddings"),
                "cv_mean": F.lit(None).cast("double"),
                "cv_std": F.lit(None).cast("double"),
                "winner_name": F.concat(F.lit("label "), F.col("winner_id").cast("string")),
            }
        )
        append_results(run, path)
    return spark.read.schema(MODEL_RESULTS).parquet(path).select(
        F.date_format("run_timestamp", "yyyy-MM-dd").alias("run_date"), "model_name", F.round("accuracy", 6).alias("accuracy"),
        "winner_id", "winner_name", "winner_pct",
    )


@query(
    "ml_confusion",
    f"{_VECTORS} SELECT actual AS label, prediction, count(*) AS n FROM p1 GROUP BY 1, 2",
)
def ml_confusion(spark, sf):
    return evaluate.confusion(_manhattan(spark, sf), "actual")


@query(
    "ml_class_report",
    f"""{_VECTORS}, c AS (SELECT actual AS k FROM p1 UNION SELECT prediction FROM p1),
    s AS (SELECT k, (SELECT count(*) FROM p1 WHERE actual = k AND prediction = k) AS tp,
        (SELECT count(*) FROM p1 WHERE actual = k) AS support, (SELECT count(*) FROM p1 WHERE prediction = k) AS predicted FROM c),
    r AS (SELECT k, support, tp, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
        CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM s),
    f AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM r)
    SELECT CAST(k AS VARCHAR) AS name, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM f
    UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
      round(sum(tp) / sum(support), 6), sum(support)::BIGINT FROM f
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::BIGINT FROM f
    UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
      round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM f""",
)
def ml_class_report(spark, sf):
    return evaluate.class_report(_manhattan(spark, sf), "actual")


@query(
    "ml_best",
    f"""{_VECTORS}, a AS (SELECT 'KNN L1' AS model, 1::BIGINT AS position, avg((actual = prediction)::INT) AS accuracy FROM p1
      UNION ALL SELECT 'KNN L2', 2, avg((actual = prediction)::INT) FROM p2
      UNION ALL SELECT 'Vote', 3, avg((actual = prediction)::INT) FROM pv)
    SELECT model, position, round(accuracy, 6) AS accuracy FROM a ORDER BY accuracy DESC, position LIMIT 1""",
)
def ml_best(spark, sf):
    names = ["KNN L1", "KNN L2", "Vote"]
    scores = [
        evaluate.accuracy(p, "actual").select(
            F.lit(name).alias("model"), F.lit(i).cast("bigint").alias("position"), F.round("accuracy", 6).alias("accuracy")
        )
        for i, (name, p) in enumerate(zip(names, _three_models(spark, sf)), 1)
    ]
    return evaluate.best_model(scores[0].unionByName(scores[1]).unionByName(scores[2]))


@query(
    "ml_features",
    f"""WITH {FACT} SELECT panel_key, d_pol.label::BIGINT AS label, d_sec.n::DOUBLE AS security, d_soc.value AS socio_economy,
      d_sat.value AS health
    FROM fact JOIN d_pol ON politics_id = d_pol.id JOIN d_sec ON security_id = d_sec.id
      JOIN d_soc ON socio_economy_id = d_soc.id JOIN d_sat ON health_id = d_sat.id JOIN d_env ON environment_id = d_env.id
      JOIN d_edu ON education_id = d_edu.id JOIN d_dem ON demography_id = d_dem.id JOIN d_tec ON technology_id = d_tec.id""",
)
def ml_features(spark, sf):
    """Label and the first three indicators as numbers (this operator's own choice of columns)."""
    rows, _ = analysis_sets(spark, sf)
    return predict.feature_rows(rows, "panel_key", "politics", predict.first_features(rows, "politics", "panel_key", at_most=3))


_SCORED = f"""WITH {FACT},
    x AS (SELECT panel_key, d_pol.label, {_each("{x} AS f{i}")}
      FROM fact LEFT JOIN d_pol ON politics_id = d_pol.id JOIN d_sec ON security_id = d_sec.id
        JOIN d_soc ON socio_economy_id = d_soc.id JOIN d_sat ON health_id = d_sat.id JOIN d_env ON environment_id = d_env.id
        JOIN d_edu ON education_id = d_edu.id JOIN d_dem ON demography_id = d_dem.id JOIN d_tec ON technology_id = d_tec.id),
    m AS (SELECT {_each("min(f{i}) AS l{i}, max(f{i}) - min(f{i}) AS w{i}")} FROM x WHERE label IS NOT NULL),
    z AS (SELECT panel_key, label, {_each("(f{i} - l{i}) / w{i} AS f{i}")} FROM x CROSS JOIN m),
    d AS (SELECT q.panel_key, t.panel_key AS nb, t.label, {_each("abs(q.f{i} - t.f{i})", " + ")} AS dist
      FROM z q JOIN z t ON q.label IS NULL AND t.label IS NOT NULL),
    n AS (SELECT panel_key, label FROM d QUALIFY row_number() OVER (PARTITION BY panel_key ORDER BY dist, nb) <= 2),
    p AS (SELECT panel_key, label AS prediction FROM (SELECT panel_key, label, count(*) AS s FROM n GROUP BY 1, 2)
      QUALIFY row_number() OVER (PARTITION BY panel_key ORDER BY s DESC, label) = 1)"""


@query(
    "predict_majority_by_year",
    f"""{_SCORED}, c AS (SELECT CAST(split_part(panel_key, '_', 1) AS BIGINT) AS year, prediction::BIGINT AS prediction, count(*) AS n
      FROM p GROUP BY 1, 2)
    SELECT year, prediction, n, sum(n) OVER (PARTITION BY year)::BIGINT AS n_rows,
      round(n * 100.0 / sum(n) OVER (PARTITION BY year), 4) AS pct FROM c
    QUALIFY row_number() OVER (PARTITION BY year ORDER BY n DESC, prediction) = 1""",
)
def predict_majority_by_year(spark, sf):
    """The majority class of the scored unit-years, per year."""
    return majority(_scored_years(spark, sf), "prediction", ["year"])


@query(
    "predict_distribution_by_year",
    f"""{_SCORED}, c AS (SELECT CAST(split_part(panel_key, '_', 1) AS BIGINT) AS year, prediction::BIGINT AS prediction, count(*) AS n
      FROM p GROUP BY 1, 2)
    SELECT year, prediction, n, sum(n) OVER (PARTITION BY year)::BIGINT AS n_rows,
      round(n * 100.0 / sum(n) OVER (PARTITION BY year), 4) AS pct FROM c""",
)
def predict_distribution_by_year(spark, sf):
    return distribution(settle(_scored_years(spark, sf), "scored-years"), "prediction", ["year"])


def _scored_years(spark, sf):
    """Unlabelled unit-years, classified by their nearest labelled ones."""
    sets = zip(("labelled", "unlabelled"), analysis_sets(spark, sf))
    frames = settle_all(
        {name: predict.feature_rows(rows, "panel_key", "politics", PANEL_FEATURES) for name, rows in sets}
    )
    scaler = scale.fit_minmax(frames["labelled"], PANEL_FEATURES)
    scaled = {name: predict.as_vector(scaler.apply(df), PANEL_FEATURES, "v") for name, df in frames.items()}
    scored = knn.predict(scaled["labelled"], scaled["unlabelled"], "panel_key", "v", "label", 2)
    return scored.withColumn("year", panel_key_year("panel_key").cast("bigint"))


# Estimators: results depend on Spark's solvers, so these are checked by their rows only.
CUSTOMER_FEATURES = ["n_orders", "total", "mean_price"]
SEGMENT_CLASSES = {1: "Construction", 2: "Home", 3: "Industry", 4: "Transport"}


def _customer_rows(spark, sf):
    """Every customer with orders: its segment class and three order indicators."""
    from panelspark.operators.lookup import map_values
    from panelspark.queries.base import hundredths
    from panelspark.queries.winners import LABEL_IDS, SEGMENT_LABELS

    per_customer = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("id"))
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(hundredths("o_totalprice")).alias("cents"))
    )
    label = map_values(map_values("c_mktsegment", SEGMENT_LABELS), LABEL_IDS)
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), label.alias("label"))
    return per_customer.join(customers, "id").select(
        "id", "label", "n_orders", (F.col("cents") / 100).alias("total"),
        (F.col("cents") / (F.col("n_orders") * 100)).alias("mean_price"),
    )


def _prepared(spark, sf, **kwargs):
    from panelspark.ml import pipeline

    return pipeline.prepare(_customer_rows(spark, sf), "id", "label", CUSTOMER_FEATURES, **kwargs)


@query("ml_model_results")
def ml_model_results(spark, sf):
    """All seven models: noise, 80/20 split by class, half of the training rows, cross-validation."""
    from panelspark.ml import pipeline

    data = _prepared(spark, sf, noise_level=0.3, keep_percent=50)
    return pipeline.compare_models(data, class_names=SEGMENT_CLASSES).results


@query(
    "ml_prepared_rows",
    f"""WITH labelled AS (SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 2
        WHEN 'MACHINERY' THEN 3 WHEN 'AUTOMOBILE' THEN 4 END::BIGINT AS label FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)),
      {_PARTS}, k AS (SELECT greatest(2, least(5, min(n))) AS folds FROM (SELECT count(*) AS n FROM parts WHERE part = 'train' GROUP BY label)),
      f AS (SELECT label, part, (row_number() OVER (PARTITION BY label ORDER BY md5(concat(CAST(id AS VARCHAR), '|42')), id) - 1) % folds AS fold
        FROM parts CROSS JOIN k)
    SELECT label, part, fold::BIGINT AS fold, count(*) AS n FROM f GROUP BY 1, 2, 3""",
)
def ml_prepared_rows(spark, sf):
    """What all estimators are trained and judged on: rows by class, part and fold."""
    rows = _prepared(spark, sf).frame.groupBy("label", "part", "fold").agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("fold", F.col("fold").cast("bigint"))


#: Searches by application and folder; their tables are settled, so they last as long as the application.
_SEARCHES: dict = {}


def _grid(spark, sf):
    """One search serves all queries that ask for it."""
    from panelspark.ml import pipeline

    key = spark.sparkContext.applicationId, sf
    if key not in _SEARCHES:
        _SEARCHES[key] = pipeline.grid_search(_prepared(spark, sf, train_percent=70))
    return _SEARCHES[key]


@query("ml_grid_search")
def ml_grid_search(spark, sf):
    """Mean accuracy of the 27 forests of the grid over the folds."""
    return _grid(spark, sf).scores


@query(
    "ml_grid_rows",
    f"""WITH labelled AS (SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 2 WHEN 'HOUSEHOLD' THEN 2
        WHEN 'MACHINERY' THEN 3 WHEN 'AUTOMOBILE' THEN 4 END::BIGINT AS label FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)),
      {_PARTS.replace("80", "70")}, k AS (SELECT greatest(2, least(5, min(n))) AS folds FROM (SELECT count(*) AS n FROM parts WHERE part = 'train' GROUP BY label)),
      f AS (SELECT CASE part WHEN 'test' THEN folds
          ELSE (row_number() OVER (PARTITION BY part, label ORDER BY md5(concat(CAST(id AS VARCHAR), '|42')), id) - 1) % folds END AS fold
        FROM parts CROSS JOIN k)
    SELECT t.trees::BIGINT AS trees, d.depth::BIGINT AS depth, s.split::BIGINT AS split, fold::BIGINT AS fold, count(*) AS n_rows, true AS in_range
    FROM f, (VALUES (50), (100), (200)) t(trees), (VALUES (0), (10), (20)) d(depth), (VALUES (2), (5), (10)) s(split) GROUP BY 1, 2, 3, 4""",
)
def ml_grid_rows(spark, sf):
    """How many rows every forest of the grid was judged on, by fold (the last one: the test rows), and whether its accuracy can be one."""
    found = _grid(spark, sf).by_fold
    return found.select(*[big(c) for c in ("trees", "depth", "split", "fold")], "n_rows", F.col("accuracy").between(0, 1).alias("in_range"))


@query("ml_importances")
def ml_importances(spark, sf):
    from panelspark.ml import pipeline

    return pipeline.importances(_grid(spark, sf), CUSTOMER_FEATURES)


@query("ml_year_models")
def ml_year_models(spark, sf):
    """Best model's yearly variants, and the majority class it predicts for every unlabelled year."""
    from datetime import datetime

    from panelspark.ml import pipeline

    labelled, unlabelled = settle_all(dict(zip(("labelled", "unlabelled"), analysis_sets(spark, sf)))).values()
    data = pipeline.prepare(labelled, "panel_key", "politics", PANEL_FEATURES)
    compared = pipeline.compare_models(data, class_names=SEGMENT_CLASSES)
    valid, known = range(1995, 2002), {1996, 1998, 2000}
    years = [y for y in valid if y not in known]
    predicted = pipeline.predict_years(compared, data, unlabelled, "panel_key", years, valid, known)
    yearly = pipeline.yearly_models(labelled, "panel_key", "politics", PANEL_FEATURES, compared.best, years)
    return pipeline.yearly_results(predicted, yearly, SEGMENT_CLASSES, datetime(1970, 1, 1))

"""The queries of this subpackage, each over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import brown, decontaminate, dialogue, exact, jaccard, langid, licenses, packing, repeats, simhash, spelling, tokencount, toxicity
from panelspark.llm.store import settle
from panelspark.shipping import ship
from panelspark.tables import shared_dir, table

Runner = Callable[[SparkSession, str], DataFrame]


def held_out(of: int) -> Column:
    """The documents that a query does not learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == 2, F.lit(False))


def op1_brown_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    model, counts = brown.train(docs.filter(~held_out(7)))
    scored = brown.score(docs, model, counts)
    return scored.select("doc_id", held_out(7).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~held_out(4)))
    return langid.predict(docs, model).select("doc_id", held_out(4).alias("held_out"), "lang_pred", "score")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels table has one category of toxicity and one of quality; the chain goes from the second to the first."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"), ["quality", "toxic"])
    return toxicity.predict(docs, chain).select("doc_id", "toxic", "toxic_probability", "quality_probability")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.near_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def tokenizer_path() -> str:
    """The vocabulary file of the queries, which every machine has at the same place."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the documents as flat token files, then counts by the files alone."""
    ship(spark)
    path, end_id = shared_dir(spark, "flat-tokens"), 49407
    tokencount.write_flat(table(spark, sf_dir, "documents"), tokenizer_path(), path, end_id)
    return tokencount.count_tokens(tokencount.read_blocks(spark, path, end_id))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=0)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    rows = dialogue.damaged(table(spark, sf_dir, "conversations"))
    planned = settle(dialogue.plans(rows), "dialogue-plans")
    found = dialogue.digests(rows, planned)
    return found.select(F.col("conv").alias("conv_id"), *dialogue.RESULTS, "audit", "repaired_sha256")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    words = spelling.vocabulary(spelling.runs_of(table(spark, sf_dir, "documents"), slip=199, least_length=6), least_length=6, least_count=5)
    return spelling.variants(settle(words, "spelling-words"), ratio=5)


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"), shingle=3, percent=90)


EXACT_SQL = r"""
WITH hashed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM hashed
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
reached(doc_id, reach) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.reach = l.a)
SELECT r.doc_id, any_value(coalesce(n, 0)) AS n_shingles, min(reach) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""


def runners() -> dict[str, Runner]:
    return {
        "op1_brown_score": op1_brown_score,
        "op2_decontamination": op2_decontamination,
        "op3_repeated_strings": op3_repeated_strings,
        "op4_language_id": op4_language_id,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_toxicity": op6_toxicity,
        "op7_license_scan": op7_license_scan,
        "op8_simhash_near_dedup": op8_simhash_near_dedup,
        "op9_token_counts": op9_token_counts,
        "op10_best_fit_packing": op10_best_fit_packing,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_jaccard_join": op13_jaccard_join,
    }


def oracles() -> dict[str, str]:
    return {"op5_exact_dedup": EXACT_SQL, "op13_jaccard_join": JACCARD_SQL}

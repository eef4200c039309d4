"""Small tables with awkward rows: nulls, empty and long texts, ties, repeated rows, and columns named like internal ones."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

CLASHING = "id long, key string, doc string, row int, sha string, mask long, fp0 long, _block int, _gone string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
EXTRA = (7, "k", "d", 1, "s", 2, 3, 4, "g")


def sentence(rng: random.Random, words: int, syllables: str = "ka lo mi tu re sa no vi") -> str:
    parts = syllables.split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(words))


def awkward() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    base = sentence(rng, 120)
    near = base.split()
    near[60] = "changed"
    long = sentence(rng, 30_000)
    return [
        (1, base),
        (2, " ".join(near)),
        (3, base),
        (4, base.replace(" ", "\n", 3)),
        (5, None),
        (6, ""),
        (7, " \t\n"),
        (8, "one"),
        (9, long),
        (10, "x" * 5000),
        (11, "ÀÉ ñandú Straße 數據 " * 20),
        (12, "12 34 %%% 56"),
        (13, base + " " + long[:400]),
        (13, base + " " + long[:400]),
        (None, "text without an id but with words"),
        (14, "TEXT without an ID but with words"),
        (15, "a\u0000b \x1c c"),
    ]


def frame(spark: SparkSession, rows: list[tuple[int | None, str | None]], langs: list[str | None] | None = None) -> DataFrame:
    langs = langs or ["en"] * len(rows)
    return spark.createDataFrame([(i, t, g, "s", len(t or ""), *EXTRA) for (i, t), g in zip(rows, langs)], SCHEMA)

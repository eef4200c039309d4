"""Exact duplicates by two passes of a Bloom filter; only rows that may be repeated are shuffled.

Pass one counts, for every bit of a blocked Bloom filter, whether two rows or more set it.  Pass two keeps as
possibly repeated the rows all of whose bits were set twice.  A row whose hash occurs twice always is among
them, so the rest, nearly all rows that are unique, needs no grouping and passes straight through.

Nulls count as empty text; empty texts equal each other.  Rows without an id sort after those with one.  A row that occurs
twice, id included, counts twice; one of its occurrences stays.  Further columns of the input are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import settle

#: Bits of one block (an array of 64 words of 64 bits), and bits that a row sets in its block.
BLOCK_BITS, ROW_BITS = 4096, 5
WHITE = " \t\n\x0b\x0c\r"


def text_hash(text: Column | str) -> Column:
    """SHA-256 (lower-case hex) of the text without its white space."""
    return F.sha2(F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), WHITE, "").cast("binary"), 256)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> Column:
    """The bits that a key sets in its block."""
    spread = F.xxhash64(key, F.lit("bits"))
    return F.array_distinct(F.array(*[F.shiftrightunsigned(spread, 12 * i).bitwiseAND(BLOCK_BITS - 1) for i in range(ROW_BITS)]))


def repeat_filter(keys: DataFrame, n_rows: int, bits_per_row: int = 16, filter_bytes: int = 256 << 20) -> tuple[DataFrame, int]:
    """Pass one over the single column of ``keys``: (block, words) of the bits set by two rows or more, and the number of blocks.

    The filter has ``bits_per_row`` bits for each row (1 unique row in 700 is then taken for repeated) and never more
    than ``filter_bytes`` in all, which bounds its broadcast.  Beyond, more rows count as possibly repeated; results stay exact.
    """
    blocks = max(1, min(-(-n_rows * bits_per_row // BLOCK_BITS), filter_bytes * 8 // BLOCK_BITS))
    key = F.col(keys.columns[0])
    set_bits = keys.select(_block(key, blocks).alias("block"), F.explode(_bits(key)).alias("bit"))
    twice = set_bits.groupBy("block", "bit").count().filter("count >= 2")
    words = twice.groupBy("block", F.shiftright("bit", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("set")
    )
    by_word = words.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("word", "set"))).alias("words"))
    full = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)), lambda i: F.coalesce(F.col("words")[i], F.lit(0).cast("long")))
    return settle(by_word.select("block", full.alias("words")), "repeat-filter"), blocks


def mark_repeats(rows: DataFrame, key: str, repeats: DataFrame, blocks: int, into: str) -> DataFrame:
    """Pass two: column ``into`` tells whether a row may be repeated.  The filter is broadcast; no row moves."""
    side = repeats.select(F.col("block").alias("_block"), F.col("words").alias("_words"))
    found = rows.join(F.broadcast(side), _block(F.col(key), blocks) == F.col("_block"), "left")
    hit = F.forall(_bits(F.col(key)), lambda b: F.getbit(F.col("_words")[F.shiftright(b, 6).cast("int")], b.bitwiseAND(63).cast("int")) == 1)
    return found.withColumn(into, F.col("_block").isNotNull() & F.coalesce(hit, F.lit(False))).drop("_block", "_words")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bytes: int = 256 << 20) -> DataFrame:
    """One row per input row: id, keep_id (id of the row that stays), group_size, kept, text_sha256.

    Of equal texts the one with the most code points stays, then the smallest id.
    """
    rows = settle(
        docs.select(
            F.col(id_col).alias("id"),
            text_hash(text_col).alias("sha"),
            F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "exact-rows",
    )
    repeats, blocks = repeat_filter(rows.select("sha"), rows.count(), filter_bytes=filter_bytes)
    marked = mark_repeats(rows, "sha", repeats, blocks, "maybe")
    single = marked.filter(~F.col("maybe")).select(
        F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256")
    )
    maybe = marked.filter("maybe")
    # Pre-aggregated below the shuffle: a text with a third of all rows enters it as one row per task.
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("none"), "id", "row"))
    groups = maybe.groupBy("sha").agg(best.alias("best"), F.count(F.lit(1)).alias("size"))
    # The key of the groups is an expression: the join deals both sides anew, so that Spark can split a hot text.
    groups = groups.select(F.lower("sha").alias("key"), "best", "size")
    several = maybe.join(groups, F.col("sha") == F.col("key")).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"),
    )
    return single.unionByName(several)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bytes: int = 256 << 20) -> DataFrame:
    """``docs`` without the copies that :func:`exact_groups` does not keep; unique rows are not shuffled.

    Rows that may be repeated are reduced per text below the shuffle, so that a group of any size crosses it as one row per task.
    """
    hashed = docs.select(F.struct(*docs.columns).alias("doc")).withColumn("sha", text_hash(F.col("doc")[text_col]))
    keys = settle(hashed.select("sha"), "exact-hashes")
    repeats, blocks = repeat_filter(keys, keys.count(), filter_bytes=filter_bytes)
    marked = mark_repeats(hashed, "sha", repeats, blocks, "maybe")
    text, key = F.coalesce(F.col("doc")[text_col], F.lit("")), F.col("doc")[id_col]
    best = F.min_by("doc", F.struct((-F.length(text)).alias("n"), key.isNull().alias("none"), key.alias("id"), text.alias("text")))
    kept = marked.filter("maybe").groupBy("sha").agg(best.alias("doc"))
    return marked.filter(~F.col("maybe")).select("doc.*").unionByName(kept.select("doc.*"))

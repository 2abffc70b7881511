"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal when they are identical after deleting the characters
``[\\x20\\x09-\\x0D]``.  Rows are first grouped by the length of that normalised
text, then by a hash of its first characters, and only rows that still share a
group with another have their whole content hashed and meet by it; the others are
alone in their group.

Of equal texts the row with the most code points in its original text stays, then the
one with the smallest id, then the one with the least hash of its original text, so that
rows of one id with different originals are told apart.

Defined cases: a null text counts as empty; all empty texts are one group; a
null ``doc_id`` sorts before all others; rows repeated with the same ``doc_id``
and text are counted each, ``duplicate_groups`` marks all of them as kept, and
``deduplicate`` returns one of them; an empty table gives an empty table; other
columns are passed through untouched.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import text_of, written

PREFIX_CHARS = 64
_LEN, _PRE, _FULL = "__norm_len", "__prefix_hash", "__full_hash"
_CHARS, _ORIGINAL = "__n_chars", "__original_hash"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def _clusters(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has (counted map-side before the shuffle)."""
    return rows.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")


def refined(docs: DataFrame, id_col: str, text_col: str, columns: list[str], digest_all: bool = False) -> DataFrame:
    """``columns`` of every row, written once with its keys: the full hash is null where the
    length or the prefix hash is already unique.  ``digest_all`` adds each row's digest as
    ``__digest``, for output only."""
    text = text_of(docs, text_col)
    norm = normalised(text)
    cheap = docs.select(F.length(norm).alias(_LEN), F.xxhash64(F.substring(norm, 1, PREFIX_CHARS)).alias(_PRE))
    by_len = _clusters(cheap.select(_LEN), [_LEN])
    by_prefix = _clusters(cheap.join(by_len, _LEN, "left_semi"), [_LEN, _PRE])
    rows = docs.select(*columns, text.alias("__t"), norm.alias("__norm"), F.length(text).alias(_CHARS),
                       F.xxhash64(text).alias(_ORIGINAL))
    rows = rows.withColumns({_LEN: F.length("__norm"), _PRE: F.xxhash64(F.substring("__norm", 1, PREFIX_CHARS))})
    rows = rows.drop("__t").join(by_prefix.withColumn("__again", F.lit(True)), [_LEN, _PRE], "left")
    sha = F.sha2("__norm", 256)
    if digest_all:
        rows = rows.withColumn("__digest", sha)
        sha = F.col("__digest")
    return written(rows.withColumn(_FULL, F.when(F.col("__again"), sha)).drop("__again", "__norm"), "dedup-keys")


def groups(keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per group of rows with a full hash: the row that stays (most code points, then
    smallest id, then least hash of the original) and the size."""
    best = F.min(F.struct((-F.col(_CHARS)).alias("n"), F.col(id_col).alias("id"), F.col(_ORIGINAL).alias("original")))
    return (keys.where(F.col(_FULL).isNotNull()).groupBy(F.col(_FULL).alias("__group"))
            .agg(best.alias("__best"), F.count("*").alias("__size")))


def _stays(id_col: str) -> Column:
    return (F.col(id_col).eqNullSafe(F.col("__best.id")) & (F.col(_ORIGINAL) == F.col("__best.original"))
            & (-F.col(_CHARS) == F.col("__best.n")))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest_all: bool = False) -> DataFrame:
    """Every row's id with its group: keep_id, group_size, kept and the full hash (that of rows
    alone in their group only with ``digest_all``)."""
    keys = refined(docs, id_col, text_col, [id_col], digest_all)
    digest = F.col("__digest" if digest_all else _FULL).alias("full_hash")
    alone = keys.where(F.col(_FULL).isNull()).select(
        id_col, F.col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest)
    again = keys.join(groups(keys, id_col), F.col(_FULL) == F.col("__group")).select(
        id_col, F.col("__best.id").alias("keep_id"), F.col("__size").alias("group_size"), _stays(id_col).alias("kept"), digest)
    return alone.unionByName(again)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Rows meet the kept ones by hash, id and original together, so a hot group of copies
    is spread over all tasks.
    """
    rows = refined(docs, id_col, text_col, docs.columns)
    best = groups(rows, id_col).select("__group", F.col("__best.id").alias("__keep_id"),
                                       F.col("__best.original").alias("__keep_original"))
    again = rows.where(F.col(_FULL).isNotNull())
    same = (F.col(_FULL) == F.col("__group")) & F.col(id_col).eqNullSafe(F.col("__keep_id")) & (
        F.col(_ORIGINAL) == F.col("__keep_original"))
    kept = again.join(best, same, "left_semi").dropDuplicates([_FULL])
    return rows.where(F.col(_FULL).isNull()).select(*docs.columns).unionByName(kept.select(*docs.columns))

"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from pyspark.sql import Column, DataFrame, functions as F

from sightline.llm.common import one_space, settle

#: Characters of the normalised text that the second step hashes.
PREFIX_CHARS = 256


def full_hash(text: Column) -> Column:
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def exact_groups(docs: DataFrame, prefix_chars: int = PREFIX_CHARS, hash_all: bool = False) -> DataFrame:
    """Groups of documents whose texts are equal after folding white space.

    Takes ``doc_id`` and ``text``; other columns, whatever their names, are ignored.  Returns one row per input row:
    ``doc_id``, ``keep_id`` (smallest id of the group), ``group_size`` (rows), ``kept`` and ``full_hash``.

    Lengths are counted first; rows whose length is shared are counted by length and prefix hash; the full text is
    hashed only for rows that share both (for every row with ``hash_all``, else ``full_hash`` is null for the rest).

    Null text equals the empty text.  A null id never leads a group that has any id.  Repeated rows count in
    ``group_size``, and each of them that bears ``keep_id`` is kept.  An empty table gives an empty result.
    """
    text = one_space(F.col("text"))
    size, prefix = F.octet_length("_text"), F.xxhash64(F.substring("_text", 1, prefix_chars))
    base = docs.select("doc_id", text.alias("_text"))
    profile = settle(base.select(size.alias("_size"), prefix.alias("_prefix")).groupBy("_size", "_prefix").agg(F.count("*").alias("_n")))
    shared_size = profile.groupBy("_size").agg(F.sum("_n").alias("_rows")).where("_rows > 1").select("_size")
    # one row per surviving (length, prefix); settled, so that the join below deals out both of its sides
    survivors = settle(profile.where("_n > 1").join(shared_size, "_size", "left_semi").select("_size", "_prefix", F.lit(True).alias("_shared")))
    rows = (base.select("doc_id", "_text", size.alias("_size"), prefix.alias("_prefix"))
            .join(survivors, ["_size", "_prefix"], "left"))
    shared = F.coalesce("_shared", F.lit(False))
    hashed = settle(rows.select("doc_id", "_size", shared.alias("_shared"), F.when(shared | F.lit(hash_all), full_hash(F.col("_text"))).alias("full_hash")))

    groups = (hashed.where("_shared").groupBy("full_hash", F.col("_size").alias("_of_size"))
              .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).drop("_of_size"))
    grouped = hashed.where("_shared").select("doc_id", "full_hash").join(groups, "full_hash")
    single = hashed.where("NOT _shared").select("doc_id", "full_hash", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return (grouped.select("doc_id", "full_hash", "keep_id", "group_size").unionByName(single)
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "full_hash"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of equal texts: the one with the smallest id, once if it is repeated.
    Of texts that only rows without an id have, one row stays."""
    kept = exact_groups(docs, hash_all=True).where("kept").select(F.col("doc_id").alias("_id"), F.col("full_hash").alias("_hash")).distinct()
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("own_id"), full_hash(one_space(F.col("text"))).alias("own_hash"))
    stays = rows.join(kept, F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("own_hash") == F.col("_hash")), "left_semi")
    return stays.dropDuplicates(["own_id", "own_hash"]).select("row.*")

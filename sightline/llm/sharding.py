"""Shards by a hierarchical weighted hash tree: region, rack and shard are drawn level by level."""

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Parts into which a shard is cut to number its rows; a part is sorted in one task, whatever its size.
PARTS = 1024


def tree_of(shards: int, of_rack: int = 4, of_region: int = 2) -> dict:
    """region -> rack -> {shard: weight} for so many shards of weight 1, a function of their number alone.

    Racks hold ``of_rack`` shards and regions ``of_region`` racks, filled in order: one shard more is one leaf more in the
    last rack, or opens the next rack or region, and changes no weight but those on its own path.
    """
    tree: dict = {}
    for shard in range(shards):
        rack = shard // of_rack
        tree.setdefault(f"region{rack // of_region}", {}).setdefault(f"rack{rack % of_region}", {})[shard] = 1.0
    return tree


def leaf_draws(tree: dict, key: Column) -> list[tuple[tuple, Column]]:
    """Path and draw -ln(u)/weight of every leaf with a weight; u depends on its path and the key only."""
    draws = []
    for region, racks in tree.items():
        for rack, shards in racks.items():
            for shard, weight in shards.items():
                if weight > 0:
                    bits = F.shiftrightunsigned(F.xxhash64(F.lit(f"{region}/{rack}/{shard}"), key), 11)
                    draws.append(((region, rack, str(shard)), -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))) / F.lit(float(weight))))
    return draws


def place(df: DataFrame, tree: dict, key: Column, prefix: str = "level") -> DataFrame:
    """``df`` with columns ``<prefix>0..2``: the region, rack and shard (as strings) in which ``key`` lands.

    A node's draw is the least of its children's, so it is exponential with the sum of their weights: at each level a key
    goes down to the child with the least draw, in proportion to weight.  If the weight of a leaf rises, only the draws on
    its path can fall, so keys move into the subtrees on that path alone and end in that leaf; if it sinks, only its own keys
    leave it.
    """
    leaves = leaf_draws(tree, key)
    df = df.withColumn("_draws", F.array(*[draw for _, draw in leaves]))
    chosen: list[str] = []
    for level in range(3):
        children: dict[tuple, list[int]] = {}
        for k, (path, _) in enumerate(leaves):
            children.setdefault(path[:level + 1], []).append(k)
        groups: dict[tuple, list[Column]] = {}
        for path, held in children.items():
            of_leaves = [F.get("_draws", F.lit(k)) for k in held]
            draw = of_leaves[0] if len(held) == 1 else F.least(*of_leaves)
            groups.setdefault(path[:-1], []).append(F.struct(draw.alias("draw"), F.lit(path[-1]).alias("name")))
        choice = None
        for parent, options in groups.items():
            here = F.array_min(F.array(*options))["name"]
            test = F.lit(True)
            for column, name in zip(chosen, parent):
                test = test & (F.col(column) == name)
            choice = F.when(test, here) if choice is None else choice.when(test, here)
        chosen.append(f"{prefix}{level}")
        df = df.withColumn(chosen[-1], choice)
    return df.drop("_draws")


def with_slots(df: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """``df`` with ``slot``: gapless row numbers from 0 within a shard.

    A shard is cut into ``PARTS`` hash parts; part sizes (at most shards x PARTS rows) give each part its first
    number, and rows are numbered within their part, so no task holds a whole shard.
    """
    parts = df.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(PARTS)))
    first = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (parts.groupBy(shard, "_part").agg(F.count("*").alias("_rows"))
              .select(shard, "_part", F.coalesce(F.sum("_rows").over(first), F.lit(0)).alias("_start")))
    within = F.row_number().over(Window.partitionBy(shard, "_part").orderBy(*order)) - 1
    return (parts.withColumn("_within", within).join(F.broadcast(starts), [shard, "_part"])
            .withColumn("slot", (F.col("_start") + F.col("_within")).cast("long")).drop("_part", "_start", "_within"))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Each document's shard under the ``key`` law: its id and the number of shards decide.

    Takes ``doc_id`` and ``text``; other columns are ignored.  Returns ``doc_id``, ``size`` (UTF-8 bytes of the text
    plus 1; a null text has none), ``text_crc32``, ``law``, ``region``, ``rack``, ``shard``, ``slot`` and
    ``grown_shard``: the ``shard`` that a call with one more of them gives, which differs only for rows that the new one takes.
    Repeated rows share a shard and get slots of their own, and so do rows without an id, which count as one key.
    Copies of a text are dealt out by their ids, so no group of copies loads one shard.  Empty tables give no rows.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select("doc_id", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = place(place(rows, tree_of(shards), key), tree_of(shards + 1), key, "grown")
    rows = rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("level0").alias("region"), F.col("level1").alias("rack"),
                       F.col("level2").cast("int").alias("shard"), F.col("grown2").cast("int").alias("grown_shard"))
    return with_slots(rows, "shard", ["doc_id", "text_crc32", "size"])

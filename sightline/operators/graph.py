"""Graphs held as edge tables: weighted links, authority by pushing, connected groups, ends of chains.

Every round is a few joins and one aggregation over tables that are written to the shared folder, so lineage stays short
and only counts reach the driver.  Rounds grow with the logarithm of a chain's or a group's length.
"""

from pyspark.sql import DataFrame, functions as F

from sightline.sources.sinks import shared_folder


def settled(df: DataFrame, name: str = "graph") -> DataFrame:
    """``df`` written as a table in the shared folder and read again."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: A whole link, and the share of pages from which a repeated link belongs to their template.
WHOLE_LINK, TEMPLATE_SHARE = 1_000_000, 0.5


def weighted_links(links: DataFrame, pages: DataFrame) -> DataFrame:
    """``source, target, weight, share`` of the links (``source, target, anchor``) between known ``pages`` (``page``).

    A page that links to another several times counts once, and links to itself do not count.  A link with one anchor and
    target on more than half of all pages belongs to the template: its copies together weigh as much as one link.
    ``share`` is the part of its source's weight.
    """
    known = pages.select("page").distinct()
    inside = (links.where("source <> target").join(known.select(F.col("page").alias("source")), "source", "left_semi")
              .join(known.select(F.col("page").alias("target")), "target", "left_semi").select("source", "target", "anchor").distinct())
    carriers = inside.groupBy("target", "anchor").agg(F.count(F.lit(1)).alias("_carriers"))
    frequent = carriers.where(F.col("_carriers") > known.agg(F.count(F.lit(1)).alias("n")).scalar() * F.lit(TEMPLATE_SHARE))
    weighed = inside.join(frequent, ["target", "anchor"], "left").groupBy("source", "target").agg(F.max(F.when(
        F.col("_carriers").isNotNull(), F.greatest(F.floor(F.lit(WHOLE_LINK) / F.col("_carriers")), F.lit(1))).otherwise(WHOLE_LINK)).alias("weight"))
    totals = weighed.groupBy("source").agg(F.sum("weight").alias("_total"))
    return weighed.join(totals, "source").select("source", "target", "weight", (F.col("weight") / F.col("_total")).alias("share"))


#: Part of a page's authority that its links pass on; what each page starts with, in whole units; what it keeps back.
DAMPING, START, REST = 0.85, 150_000_000, 4_500_000


def link_authority(pages: DataFrame, edges: DataFrame) -> DataFrame:
    """``page, authority``: the stationary share of a reader who follows links and now and then starts anew, as a multiple
    of the average page's.

    Each round every page pushes what it has newly got to its targets, until no page has got more than ``REST`` units.
    Units are whole numbers, so the result does not depend on order or partitioning.  A page without links passes nothing
    on; scaling the sum to the number of pages at the end spreads its mass over all of them.  Very many links into a page
    meet as partial sums.
    """
    factors = settled(edges.select("source", "target", (F.lit(DAMPING) * F.col("share")).alias("_factor")))
    fresh = pages.select("page").distinct().withColumn("units", F.lit(START).cast("long"))
    received = [fresh]
    while True:
        senders = fresh.where(F.col("units") > REST).select(F.col("page").alias("source"), "units")
        fresh = settled(factors.join(senders, "source").groupBy(F.col("target").alias("page")).agg(
            F.sum(F.floor(F.col("units") * F.col("_factor"))).cast("long").alias("units")))
        received.append(fresh)
        if fresh.where(F.col("units") > REST).isEmpty():
            break
    total = received[0]
    for part in received[1:]:
        total = total.unionByName(part)
    summed = settled(total.groupBy("page").agg(F.sum("units").alias("units")))
    average = summed.agg((F.sum("units") / F.count(F.lit(1))).alias("a")).scalar()
    return summed.select("page", (F.col("units") / average).alias("authority"))


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the least node that can be reached over ``edges`` (``a, b``, either way round).

    Roots hook onto the least root among their members' neighbours and every node then skips to its parent's parent, so
    rounds grow with the logarithm of the longest path.
    """
    both = settled(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    parents = settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("parent")))
    while True:
        of = parents.select(F.col("node").alias("b"), F.col("parent").alias("_theirs"))
        nearest = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("_theirs").alias("_least")).join(parents, "node")
        hooks = nearest.select("node", "_least").unionByName(nearest.select(F.col("parent").alias("node"), "_least"))
        hooked = parents.join(hooks.groupBy("node").agg(F.min("_least").alias("_least")), "node", "left").select(
            "node", F.least("parent", "_least").alias("parent"), F.col("parent").alias("_old"))
        above = hooked.select(F.col("node").alias("parent"), F.col("parent").alias("_above"))
        moved = settled(hooked.join(above, "parent", "left").select("node", F.least("parent", "_above").alias("parent"), "_old"))
        parents = moved.select("node", "parent")
        if moved.where("parent <> _old").isEmpty():
            return parents.select("node", F.col("parent").alias("component"))


def chain_ends(links: DataFrame) -> DataFrame:
    """``node, end, hops, looped``: where each chain of ``links`` (``node, next``; one per node) ends.

    Pointers are doubled: after k rounds a node points 2^k links ahead or at its end.  A chain that runs into a circle has
    no end.  Of several links of one node the least counts.
    """
    state = settled(links.where("node IS NOT NULL AND next IS NOT NULL").groupBy("node").agg(F.min("next").alias("next")).withColumn("hops", F.lit(1).cast("long")))
    reach, size = 1, state.count()
    while True:
        ahead = state.select(F.col("node").alias("next"), F.col("next").alias("_next"), F.col("hops").alias("_hops"))
        joined = state.join(ahead, "next", "left")
        if reach > size:
            # what still points at a node with a link after more steps than there are links is in a circle, or leads into one
            return joined.select("node", F.when(F.col("_next").isNull(), F.col("next")).alias("end"), F.when(F.col("_next").isNull(), F.col("hops")).alias("hops"), F.col("_next").isNotNull().alias("looped"))
        moved = settled(joined.select("node", F.coalesce("_next", "next").alias("next"), (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"), F.col("_next").isNotNull().alias("_moved")))
        state, reach = moved.drop("_moved"), reach * 2
        if moved.where("_moved").isEmpty():
            return state.select("node", F.col("next").alias("end"), "hops", F.lit(False).alias("looped"))

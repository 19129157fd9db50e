"""How text filters interact: for every order of them, what each step removes, and each filter's Shapley share.

All orders of k filters are the paths through the lattice of its 2^k subsets.  What a filter removes after a set of others
belongs to the edge that adds it to that set, whatever path led there; so one histogram of failing sets per part gives every
edge, the orders that reach and leave its ends are counted once forward and once backward, an order's steps are read from
the edges on its path, and the Shapley sum of a filter weighs its edges by the paths through them.
"""

from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from sightline.llm.common import digest_text, settle

WORD_BREAK = r"[\x20\x09-\x0D]+"


def text_conditions(text: Column) -> dict[str, Column]:
    """Failure conditions that a text shows by itself; null is the empty text."""
    whole = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(whole, WORD_BREAK), "")
    count = F.size(words)
    return {"A": count < 200, "B": 100 * F.size(F.array_distinct(words)) < 50 * count,
            "C": 100 * F.regexp_count(whole, F.lit("[A-Z]")) > 2 * F.length(whole), "D": whole.rlike(r"[#$%&*|]")}


def failing_sets(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``fails`` (bit k for the k-th of ABCDE), ``good`` and ``toxic`` of every document.

    E fails a text that some smaller doc_id has as well.  The least id of each text is one minimum per digest; the rows
    that hold it are found by digest and id together, so the copies of one text never meet in a task.
    """
    conditions = text_conditions(F.col("text"))
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions.values())), F.lit(0))
    rows = settle(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), bits.cast("int").alias("fails"), F.unhex(digest_text(F.col("text"))).alias("same")))
    least = rows.where("doc_id IS NOT NULL").groupBy("same").agg(F.min("doc_id").alias("doc_id")).withColumn("_first", F.lit(True))
    copies = F.col("_first").isNull() & F.col("doc_id").isNotNull()
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    joined = rows.join(least, ["same", "doc_id"], "left").join(known, "doc_id", "left")
    return joined.select("part", F.when(copies, F.col("fails").bitwiseOR(1 << len(conditions))).otherwise(F.col("fails")).alias("fails"),
                         F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def path_counts(filters: int) -> tuple[list[int], list[int]]:
    """Ways to reach each set of filters from the empty one, and ways to go on from it to the full one."""
    states = 1 << filters
    forward, backward = [1] + [0] * (states - 1), [0] * (states - 1) + [1]
    for state in range(states):
        for f in range(filters):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in reversed(range(states)):
        for f in range(filters):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def interactions(rows: DataFrame, filters: str) -> DataFrame:
    """One row per part, order of ``filters`` (single letters) and step.

    ``rows`` has ``part``, ``fails`` (bit k for the k-th filter), ``good`` and ``toxic`` (0 or 1), one row per document.
    Counts are longs: ``kept`` after the step, ``removed`` in it, ``redundant`` (would fail it, but gone before),
    ``unique_fails``, ``good_lost``, ``toxic_lost``, and ``shapley``, what the step's filter removes in all orders together.
    A part may hold any share of the rows: each task hands on at most four counts for each set of failures.  The lattice
    grows as 2^k and the result as k!, so this is meant for up to seven filters.  Without rows there are no parts.
    """
    k = len(filters)
    states, (forward, backward) = range(1 << k), path_counts(k)
    counts = rows.groupBy("part", "fails", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))

    def survivors(measure: Column) -> Column:
        """For every set of filters, how much of the measure passes all of them."""
        return F.array(*[F.sum(F.when(F.col("fails").bitwiseAND(s) == 0, measure).otherwise(0)) for s in states])

    n = F.col("n")
    parts = counts.groupBy("part").agg(
        survivors(n).alias("alive"), survivors(n * F.col("good")).alias("good"), survivors(n * F.col("toxic")).alias("toxic"),
        F.array(*[F.sum(F.when(F.col("fails") == 1 << f, n).otherwise(0)) for f in range(k)]).alias("only"))
    at = lambda name, state: F.get(name, state)
    weighed = [sum((F.lit(forward[s] * backward[s | 1 << f]) * (at("alive", F.lit(s)) - at("alive", F.lit(s | 1 << f))) for s in states if not s >> f & 1), F.lit(0)) for f in range(k)]
    orders = F.split(F.lit(",".join(map("".join, permutations(filters)))), ",")
    paths = parts.withColumn("shares", F.array(*weighed)).withColumn("filter_order", F.explode(orders))
    steps = paths.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(k))))
    place = lambda letter: F.instr(F.lit(filters), letter) - 1
    earlier = F.split(F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1), "")
    before = F.aggregate(earlier, F.lit(0), lambda got, x: got + F.when(x == "", 0).otherwise(F.call_function("shiftleft", F.lit(1), place(x))))
    steps = steps.withColumns({"_f": place(F.substring(F.col("filter_order"), F.col("step"), F.lit(1))), "_before": before})
    steps = steps.withColumn("_after", F.col("_before") + F.call_function("shiftleft", F.lit(1), F.col("_f")))
    lost = lambda name, start=F.col("_before"), end=F.col("_after"): at(name, start) - at(name, end)
    alone = F.call_function("shiftleft", F.lit(1), F.col("_f"))
    return steps.select(
        "part", "filter_order", "step", at("alive", F.col("_after")).alias("kept"), lost("alive").alias("removed"),
        (lost("alive", F.lit(0), alone) - lost("alive")).alias("redundant"), at("only", F.col("_f")).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), at("shares", F.col("_f")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over whole texts, per source.

    ``docs``: doc_id, text, source; ``labels``: doc_id, quality, toxic; other columns are ignored, whatever their names.
    A null text is empty, a null source the part "".  Rows without an id have no label, fail no E and make none fail;
    rows with the same id and text are no copies of one another.  Several labels of an id count if any is 1; null labels
    are none.  An empty table gives no rows.
    """
    return interactions(failing_sets(docs, labels), "ABCDE")

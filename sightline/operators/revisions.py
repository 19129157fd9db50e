"""Append-only revision logs: chain checks, latest revisions, append plans, pins, idempotency."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from sightline.functions.dates import mature_on
from sightline.functions.hashing import json_array, json_number, json_text, row_hash
from sightline.operators.graph import chain_ends, settled
from sightline.operators.quality import first_code
from sightline.schemas import SNAPSHOT_CONTENT, SNAPSHOT_KEY


def latest(log: DataFrame, keys: list[str], revision: str = "revision") -> DataFrame:
    """The newest revision of every record, whatever its state.

    ``max_by`` combines on the map side, so a record with very many revisions moves one row per partition.
    """
    whole = F.struct(*[F.col(c) for c in log.columns])
    return log.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.max_by(whole, F.col(revision)).alias("_row")).select("_row.*")


def chain_violations(log: DataFrame, keys: list[str], record: str, supersedes: str, as_of: str) -> DataFrame:
    """Rows that break their revision chain: a repeated or skipped revision, a wrong predecessor, time going back.

    Each revision is joined to the one numbered just below it, so no chain is gathered and sorted in one task.
    """
    per_revision = log.groupBy(*keys, "revision").agg(F.count(F.lit(1)).alias("_copies"),
                                                     F.min(record).alias("_id"), F.min(as_of).alias("_as_of"))
    before = per_revision.select(*keys, (F.col("revision") + 1).alias("revision"), F.col("_id").alias("_prior_id"),
                                 F.col("_as_of").alias("_prior_as_of"))
    copies = per_revision.select(*keys, "revision", "_copies")
    joined = log.join(copies, [*keys, "revision"]).join(before, [*keys, "revision"], "left")
    code = first_code(
        (F.col("_copies") > 1, "DUPLICATE_REVISION"),
        ((F.col("revision") > 1) & F.col("_prior_id").isNull(), "REVISION_GAP"),
        ((F.col("revision") == 1) & F.col(supersedes).isNotNull(), "INVALID_SUPERSEDES"),
        ((F.col("revision") > 1) & ~F.col(supersedes).eqNullSafe(F.col("_prior_id")), "BROKEN_CHAIN"),
        (F.col(as_of) < F.col("_prior_as_of"), "AS_OF_WENT_BACK"))
    return joined.withColumn("code", code).where("code IS NOT NULL").select(*keys, "revision", "code")


def log_integrity(log: DataFrame, keys: list[str], semantic: list[str]) -> DataFrame:
    """Rows of a landed log that cannot be trusted: unreadable lines, repeated revisions, hashes that moved."""
    rows = log.withColumn("_hash", row_hash(log, semantic))
    copies = rows.where(F.col(keys[0]).isNotNull()).groupBy(*keys, "revision").agg(F.count(F.lit(1)).alias("_copies"))
    joined = rows.join(copies, [*keys, "revision"], "left")
    code = first_code((F.col(keys[0]).isNull(), "STORE_CORRUPTION"), (F.col("_copies") > 1, "DUPLICATE_REVISION"),
                      (F.col("content_hash") != F.col("_hash"), "HASH_MISMATCH"))
    return joined.withColumn("code", code).where("code IS NOT NULL").drop("_hash", "_copies")


def append_plan(log: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Classify a batch against a log by (key, revision, hash).

    IDEMPOTENT: the same revision with the same hash; REVISION_CONFLICT: another hash; REVISION_GAP: not one past
    the tip; INVALID_SUPERSEDES: the predecessor is not named, or one is named by a first revision; APPEND.
    Revisions of one batch may follow one another.  Log and batch are folded once to (key, revision); what follows what is
    found among these alone, so whole rows are exchanged only for their own slot and for one minimum per key, the first
    revision that cannot be appended.
    """
    rows = batch.dropDuplicates([*keys, "revision", "content_hash"])
    both = log.select(*keys, "revision", F.col("content_hash").alias("_stored"), F.lit(None).cast("string").alias("_new")).unionByName(
        rows.select(*keys, "revision", F.lit(None).cast("string").alias("_stored"), F.col("content_hash").alias("_new")))
    slots = settled(both.groupBy(*keys, "revision").agg(F.min("_stored").alias("_stored"), F.count("_new").alias("_twins")))
    tips = slots.groupBy(*keys).agg(F.max(F.when(F.col("_stored").isNotNull(), F.col("revision"))).alias("_tip"))
    below = slots.where("_twins > 0").select(*keys, (F.col("revision") + 1).alias("revision"), F.lit(True).alias("_below"))
    named = F.when(F.col("revision") == 1, F.col("supersedes_revision").isNull()).otherwise(
        F.coalesce(F.col("supersedes_revision") == F.col("revision") - 1, F.lit(False)))
    linked = (F.col("revision") == F.coalesce("_tip", F.lit(0)) + 1) | (
        F.col("_below").isNotNull() & (F.col("revision") > F.coalesce("_tip", F.lit(0))))
    follows = slots.select(*keys, "revision").join(tips, keys).join(below, [*keys, "revision"], "left").select(*keys, "revision", linked.alias("_linked"))
    marked = settled(rows.join(slots, [*keys, "revision"]).join(follows, [*keys, "revision"]).withColumn("_named", named))
    unfit = F.col("_stored").isNull() & ~(F.col("_named") & F.col("_linked") & (F.col("_twins") == 1))
    breaks = marked.groupBy(*keys).agg(F.min(F.when(unfit, F.col("revision"))).alias("_break"))
    decision = (F.when(F.col("_stored") == F.col("content_hash"), "IDEMPOTENT")
                .when(F.col("_stored").isNotNull() | (F.col("_twins") > 1), "REVISION_CONFLICT")
                .when(~F.col("_linked") | (F.col("revision") > F.col("_break")), "REVISION_GAP")
                .when(~F.col("_named"), "INVALID_SUPERSEDES").otherwise("APPEND"))
    return marked.join(breaks, keys).withColumn("decision", decision).select(*batch.columns, "decision")


# --- KPI snapshots ----------------------------------------------------------------------------------------

def snapshot_hashes(rows: DataFrame) -> DataFrame:
    """Add the logical key and content hash of every snapshot row."""
    return rows.withColumns({"logical_key": row_hash(rows, SNAPSHOT_KEY), "content_hash": row_hash(rows, SNAPSHOT_CONTENT)})


def snapshot_id(logical_key: Column, content_hash: Column, revision: Column, supersedes: Column) -> Column:
    return F.concat(F.lit("snap_"), F.sha2(json_array([
        json_text(logical_key), json_text(content_hash), json_number(revision), json_text(supersedes)]), 256))


def snapshot_plan(history: DataFrame, candidates: DataFrame, order: list[str] = ()) -> DataFrame:
    """Decide each candidate against the tip of its key: SKIP, NEW, REVISE or one of the rejections.

    Candidates carry ``logical_key``, ``content_hash``, ``as_of_date``, ``supersedes_snapshot_id``.  Candidates of one
    batch see one another: what is accepted becomes the tip of its key, so a repeat of it is a SKIP and a candidate
    that names its id is the next REVISE.  Of several that fit one tip the first by ``order`` (then by content) is
    accepted; of equal rows one is, and the others repeat it.

    An id holds its revision, so a chain cannot be followed before revisions are known.  They are guessed: those who name
    the same predecessor form a link, and the links of a key are numbered in order.  Where a link names an id that the
    guess gives to the accepted candidate of another link, the guess was right; pointer doubling then finds the links that
    hang on the stored tip, however many there are.  A link that is in no chain shifts the numbers behind it; it costs two further
    passes, after which it is numbered last.
    """
    names, needed = candidates.columns, ["logical_key", "content_hash", "supersedes_snapshot_id", "as_of_date"]
    rows = settled(candidates.withColumn("_entry", F.unhex(F.sha2(F.to_json(F.struct(*names)), 256))))
    place = F.struct(*order, *needed[1:], "_entry").alias("_order")
    entries = settled(rows.groupBy("_entry", *dict.fromkeys([*needed, *order])).agg(F.count(F.lit(1)).alias("_copies")))
    stored = settled(latest(history, ["logical_key"]).select(
        "logical_key", F.col("snapshot_id").alias("_tip"), F.col("content_hash").alias("_hash"), F.col("as_of_date").alias("_as_of"), F.col("revision").cast("long").alias("_revision")))
    tips, accepted = stored.withColumn("_at", F.lit(None).cast(entries.select(place).schema["_order"].dataType)), []
    while True:
        step = accepted_links(entries, tips, place, first=not accepted)
        if step.isEmpty():
            break
        accepted.append(step)
        newest = step.groupBy("logical_key").agg(F.max_by(F.struct("_tip", "_hash", "_as_of", "_revision", "_at"), "_revision").alias("_t")).select("logical_key", "_t.*")
        tips = settled(newest)
    taken = accepted[0] if accepted else step
    for part in accepted[1:]:
        taken = taken.unionByName(part)
    every = stored.unionByName(taken.select(*stored.columns))
    at = every.select("logical_key", F.col("_tip").alias("supersedes_snapshot_id"), F.col("_as_of").alias("_named"))
    contents = every.select("logical_key", F.col("_hash").alias("content_hash")).distinct().withColumn("_repeat", F.lit(True))
    keys = every.select("logical_key").distinct().withColumn("_known", F.lit(True))
    first = stored.select("logical_key", F.lit(True).alias("_stored"))
    decided = (entries.join(taken.select("logical_key", "_entry", F.col("_revision").alias("revision")), ["logical_key", "_entry"], "left")
               .join(contents, ["logical_key", "content_hash"], "left").join(at, ["logical_key", "supersedes_snapshot_id"], "left")
               .join(keys, "logical_key", "left").join(first, "logical_key", "left"))
    c = F.col
    decision = (F.when(c("revision").isNotNull(), F.when((c("revision") > 1) | c("_stored").isNotNull(), "REVISE").otherwise("NEW"))
                .when(c("_repeat"), "SKIP").when(c("as_of_date") < c("_named"), "REJECT_OLDER_OBSERVATION")
                .when(c("_known"), "REJECT_NEEDS_SUPERSEDES").otherwise("REJECT_UNKNOWN_PREDECESSOR"))
    found = decided.select("_entry", "_copies", decision.alias("decision"), "revision")
    single = rows.join(found.where("_copies = 1"), "_entry").select(*names, "decision", "revision")
    # of equal rows one is what was decided for them; those beside an accepted one repeat it
    several = rows.join(found.where("_copies > 1"), "_entry").dropDuplicates(["_entry"]).withColumn("_copy", F.explode(F.sequence(F.lit(1), c("_copies").cast("int"))))
    repeated = c("revision").isNotNull() & (c("_copy") > 1)
    return single.unionByName(several.select(*names, F.when(repeated, "SKIP").otherwise(c("decision")).alias("decision"), F.when(~repeated, c("revision")).alias("revision")))


def accepted_links(entries: DataFrame, tips: DataFrame, place: Column, first: bool) -> DataFrame:
    """The candidates accepted on top of ``tips`` as far as guessed revisions hold: ``logical_key, _entry`` and what makes
    them tips.  A key without a tip can only begin in the ``first`` pass.  ``place`` repeats columns of an entry, so it is made
    where it is compared and neither exchanged nor written with every entry."""
    c = F.col
    link = ["logical_key", "_link"]
    rows = entries.join(tips, "logical_key", "left" if first else "inner").withColumns({
        "_link": F.coalesce("supersedes_snapshot_id", F.lit("")), "_root": c("supersedes_snapshot_id").eqNullSafe(c("_tip"))})
    links = rows.withColumn("_order", place).groupBy(*link).agg(F.min("_order").alias("_order"), F.max("_root").alias("_root"), F.max(c("_order") < c("_at")).alias("_passed"))
    active = links.where("_root").select("logical_key")
    # those who name nothing can only begin a key
    numbered = links.where("_root OR _link <> ''").join(active, "logical_key", "left_semi").withColumn("_place", F.row_number().over(
        Window.partitionBy("logical_key").orderBy(F.desc("_root"), "_passed", "_order"))).select(*link, "_place")
    guess = F.coalesce("_revision", F.lit(0)) + c("_place")
    placed = settled(rows.join(numbered, link).withColumn("_guess", guess).withColumn(
        "_id", snapshot_id(c("logical_key"), c("content_hash"), c("_guess"), c("supersedes_snapshot_id"))).drop("_tip", "_revision", "_at", "_place", "_copies"))
    # what each link follows: the stored tip, or a candidate to which the guess gives the id that it names
    ids = placed.groupBy("logical_key", "_id").agg(F.min(F.struct(place, "_guess")).alias("_p")).select(
        "logical_key", "_id", F.coalesce("_p._order.supersedes_snapshot_id", F.lit("")).alias("_parent"), c("_p._order.content_hash").alias("_hash"),
        c("_p._order.as_of_date").alias("_as_of"), (c("_p._guess") + 1).alias("_next"))
    named = placed.where("NOT _root").select(*link).distinct().join(ids.withColumnRenamed("_id", "_link"), link)
    below = named.unionByName(placed.where("_root").select(*link, F.lit(None).cast("string").alias("_parent"), "_hash", "_as_of", c("_guess").alias("_next")).distinct())
    fits = placed.drop("_hash", "_as_of").join(below, link).withColumn("_order", place).where(
        (c("_guess") == c("_next")) & (c("_hash").isNull() | ((c("content_hash") != c("_hash")) & (c("as_of_date") >= c("_as_of")))))
    best = settled(fits.groupBy(*link).agg(F.min_by(F.struct("_entry", "_id", "content_hash", "as_of_date", "_guess", "_parent", "_order"), "_order").alias("_b")).select(*link, "_b.*"))
    node = lambda name: F.concat_ws("|", "logical_key", name)
    above = best.select("logical_key", c("_link").alias("_parent"), c("_id").alias("_link"))
    hanging = best.where("_parent IS NOT NULL").join(above, ["logical_key", "_parent", "_link"], "left_semi")
    roots = best.where("_parent IS NULL")
    if not hanging.isEmpty():
        ends = chain_ends(hanging.select(node("_link").alias("node"), node("_parent").alias("next")))
        reached = ends.join(roots.select(node("_link").alias("end")), "end", "left_semi").select("node")
        roots = roots.unionByName(hanging.withColumn("node", node("_link")).join(reached, "node", "left_semi").select(*roots.columns))
    return settled(roots.select("logical_key", c("_id").alias("_tip"), c("content_hash").alias("_hash"), c("as_of_date").alias("_as_of"), c("_guess").alias("_revision"), "_entry", c("_order").alias("_at")))


def seal(plan: DataFrame) -> DataFrame:
    """Accepted candidates with the id that pins their content and place in the chain."""
    return plan.where(F.col("decision").isin("NEW", "REVISE")).withColumn("snapshot_id", snapshot_id(
        F.col("logical_key"), F.col("content_hash"), F.col("revision"), F.col("supersedes_snapshot_id"))).drop("decision")


def report_rows(history: DataFrame, required_as_of: str) -> DataFrame:
    """Latest snapshot per key with its effective status, maturity and formal eligibility.

    The latest revision is chosen before its status is looked at.  A snapshot from after the cut-off is marked
    FUTURE and blocks the report that would use it.
    """
    cutoff = F.lit(required_as_of).cast("date")
    rows = latest(history, ["logical_key"])
    as_of = F.col("as_of_date").cast("date")
    state = (F.when(as_of > cutoff, "FUTURE").when((F.col("data_status") == "Ready") & (as_of < cutoff), "Stale")
             .otherwise(F.col("data_status")))
    mature = (F.col("metric") != "sql") | (as_of >= mature_on(F.col("period_start").cast("date")))
    eligible = (state == "Ready") & mature & (F.col("metric_group") == "Business")
    target_ok = F.coalesce(eligible & (F.col("target") > 0), F.lit(False))
    return rows.withColumns({
        "effective_status": state, "mature_cohort": mature, "formal_trend_eligible": eligible,
        "formal_target_eligible": target_ok,
        "target_attainment": F.when(target_ok, F.try_divide(F.col("value").cast("double"), F.col("target").cast("double")))})


# --- Pins and idempotency ---------------------------------------------------------------------------------

def resolve_pins(pins: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """State of each pinned (key, revision, hash): OK, DRIFT or MISSING; a newer revision does not stand in."""
    stored = log.select(*keys, "revision", F.col("content_hash").alias("_stored"))
    return pins.join(stored, [*keys, "revision"], "left").withColumn("pin_state", F.when(
        F.col("_stored").isNull(), "MISSING").when(F.col("_stored") == F.col("content_hash"), "OK").otherwise("DRIFT")).drop("_stored")


def idempotency(operations: DataFrame, ledger: DataFrame) -> DataFrame:
    """NEW, ALREADY_APPLIED or IDEMPOTENCY_CONFLICT per operation, by key and semantic hash.

    Two hashes under one key inside the batch conflict as well.
    """
    applied = ledger.groupBy("idempotency_key").agg(F.min("semantic_hash").alias("_lo"), F.max("semantic_hash").alias("_hi"))
    batch = operations.groupBy("idempotency_key").agg((F.min("semantic_hash") != F.max("semantic_hash")).alias("_clash"))
    joined = operations.join(applied, "idempotency_key", "left").join(batch, "idempotency_key")
    return joined.withColumn("decision", F.when(
        F.col("_clash") | (F.col("_lo") != F.col("semantic_hash")) | (F.col("_hi") != F.col("semantic_hash")), "IDEMPOTENCY_CONFLICT")
        .when(F.col("_lo").isNotNull(), "ALREADY_APPLIED").otherwise("NEW")).drop("_lo", "_hi", "_clash")

"""Exact joins between facts, registry entities, pins and dictionaries.

No join here is a cross product: wildcards, prefixes, suffixes and unscoped evidence are turned into
equality joins.  Spark broadcasts a side only when its size is known to be small.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sightline.operators.quality import first_code


def resolve_exactly_one(rows: DataFrame, key: str, registry: DataFrame, registry_key: str, registry_id: str) -> DataFrame:
    """Attach the one registry entry of an exact key; none is UNRESOLVED, several are AMBIGUOUS."""
    entries = registry.groupBy(F.col(registry_key).alias("_key")).agg(
        F.count_distinct(registry_id).alias("_n"), F.min(registry_id).alias("_id"))
    joined = rows.join(entries, rows[key] == entries["_key"], "left")
    return joined.withColumns({
        "match_state": F.when(F.col("_n").isNull(), "UNRESOLVED").when(F.col("_n") > 1, "AMBIGUOUS").otherwise("RESOLVED"),
        registry_id: F.when(F.col("_n") == 1, F.col("_id"))}).drop("_key", "_n", "_id")


def sitemap_status(listed: DataFrame, details: DataFrame, as_of: str) -> DataFrame:
    """Listed sitemaps with their detail, days since the last download and what an error count means."""
    joined = listed.join(details, ["site", "path"], "left")
    stale = F.datediff(F.lit(as_of).cast("date"), F.col("last_downloaded"))
    trouble = F.coalesce(F.col("errors") > 0, F.lit(False)) | F.coalesce(F.col("warnings") > 0, F.lit(False))
    return joined.withColumn("stale_days", stale).withColumn("note", F.when(
        trouble & (F.col("stale_days") > 180), "HISTORICAL").when(trouble, "CURRENT"))


def topic_evidence(topics: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence of each evaluated topic: its topic id, a reference to it, or a record that names no topic.

    One bundle is one topic's evaluation (``bundle_id`` is unique among topics), so this is one equality join
    that never multiplies evidence; a bundle with very much of it is left to the skew-join split.
    """
    asked = topics.select("bundle_id", F.col("topic_id").alias("_topic"))
    refs = F.coalesce("topic_refs", F.array().cast("array<string>"))
    belongs = ((F.col("topic_id") == F.col("_topic")) | F.array_contains(refs, F.col("_topic"))
               | (F.col("topic_id").isNull() & (F.size(refs) == 0)))
    kept = evidence.join(asked, "bundle_id").where(F.coalesce(belongs, F.lit(False)))
    return kept.withColumn("topic_id", F.col("_topic")).drop("_topic")


def url_matches(urls: Column, target: Column) -> Column:
    """A record without a URL fits any target; a topic without a target takes any record."""
    known = F.filter(urls, lambda u: u.isNotNull())
    return target.isNull() | (F.size(F.coalesce(known, F.array().cast("array<string>"))) == 0) | F.array_contains(known, target)


def with_diagnostics(candidates: DataFrame, behaviour: DataFrame, serp: DataFrame, geo: DataFrame) -> DataFrame:
    """Candidates with three diagnostics; an absent one has a stated default, and an embedded status fills in."""
    keys = ["candidate_id", "revision"]
    joined = candidates
    for frame, name in ((behaviour, "behaviour"), (serp, "serp"), (geo, "geo")):
        joined = joined.join(frame.select(*keys, F.col("status").alias(f"_{name}")), keys, "left")
    defaults = {"behaviour": "NOT_AVAILABLE", "serp": "NOT_CHECKED", "geo": "NOT_CHECKED"}
    return joined.withColumns({
        f"{name}_status": F.coalesce(f"_{name}", *([F.col(f"embedded_{name}")] if f"embedded_{name}" in candidates.columns else []),
                                     F.lit(default)) for name, default in defaults.items()}).drop(*[f"_{n}" for n in defaults])


def domain_owner(results: DataFrame, domain: str, owned: DataFrame, competitors: DataFrame) -> DataFrame:
    """Owned, competitor or unmapped state of each result's domain."""
    mine = owned.select(F.col("domain").alias("_d")).distinct().withColumn("_owned", F.lit(True))
    theirs = competitors.groupBy(F.col("domain").alias("_c")).agg(F.min("competitor_id").alias("competitor_id"))
    joined = results.join(mine, results[domain] == mine["_d"], "left").join(theirs, results[domain] == theirs["_c"], "left")
    return joined.withColumn("match_state", F.when(F.col("_owned"), "OWNED").when(
        F.col("competitor_id").isNotNull(), "COMPETITOR").otherwise("UNMAPPED_DOMAIN")).drop("_d", "_owned", "_c")


def prompt_topics(observations: DataFrame, prompts: DataFrame) -> DataFrame:
    """Topic of each observation: the named one if its prompt has it, else the prompt's only one."""
    known = prompts.select("prompt_id", F.col("topic_refs").alias("_refs"))
    joined = observations.join(known, "prompt_id", "left")
    one = F.size("_refs") == 1
    return joined.withColumns({
        "mapping_state": F.when(F.col("_refs").isNull(), "UNRESOLVED_PROMPT")
        .when(F.col("topic_id").isNotNull() & ~F.array_contains("_refs", F.col("topic_id")), "TOPIC_NOT_IN_PROMPT")
        .when(F.col("topic_id").isNull() & ~one, "AMBIGUOUS_TOPIC").otherwise("MAPPED"),
        "topic_id": F.coalesce("topic_id", F.when(one, F.col("_refs")[0]))}).drop("_refs")


def page_property(pages: DataFrame, url: str, configs: DataFrame) -> DataFrame:
    """First config in order whose site is a prefix of the page, else the first config.

    Prefixes become equalities: a page is cut to the distinct lengths the configured sites have, and each cut
    is joined to the sites.  Configs are one row per property; their lengths are a short list.
    """
    sites = configs.where(F.col("site") != "")
    lengths = sites.agg(F.array_sort(F.collect_set(F.length("site"))).alias("l")).scalar()
    first = configs.agg(F.min(F.struct("seq", "site", "property")).alias("c")).scalar()
    cuts = (pages.select(url).distinct().withColumn("_length", F.explode(lengths))
            .withColumn("_site", F.substring(F.col(url), F.lit(1), F.col("_length"))).drop("_length"))
    best = (cuts.join(sites.withColumnRenamed("site", "_site"), "_site").groupBy(url)
            .agg(F.min(F.struct("seq", F.col("_site").alias("site"), "property")).alias("_best")))
    found = F.coalesce("_best", first)
    return pages.join(best, url, "left").withColumns({"site": found["site"], "property": found["property"]}).drop("_best")


def linked_steps(steps: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Next steps with the status of what they refer to; a broken reference stays in the list, marked."""
    sources = recommendations.select(F.col("id").alias("source_ref"), F.col("status").alias("_status"))
    joined = steps.join(sources, "source_ref", "left")
    return joined.withColumns({
        "link_state": F.when(F.col("source_ref").isNull(), "OWN").when(F.col("_status").isNull(), "BROKEN").otherwise("LINKED"),
        "status": F.when(F.col("source_ref").isNull(), F.col("status")).otherwise(F.col("_status"))}).drop("_status")


# Sources whose observations belong to a sample of AI answers.
SAMPLED_SOURCES = ["GEO", "WORKDUO"]
SCOPE_FIELDS = ["source", "scope", "entity_ref", "source_population", "methodology", "timezone"]


def compare_sides(observations: DataFrame, scope_fields: list[str] = SCOPE_FIELDS) -> DataFrame:
    """Baseline beside follow-up per (track, metric), with the first reason they cannot be compared.

    Observations of AI-answer samples must come from one known version and revision of their sample; two result-page
    snapshots of different days are no periods that could be compared.
    """
    fields = [f for f in scope_fields if f in observations.columns]

    def side(name):
        picked = observations.where(F.col("side") == name)
        others = [c for c in picked.columns if c not in ("track_id", "metric", "side")]
        return picked.select("track_id", "metric", *[F.col(c).alias(f"{name}_{c}") for c in others])

    both = side("baseline").join(side("follow_up"), ["track_id", "metric"], "full")
    same = [(~F.col(f"baseline_{f}").eqNullSafe(F.col(f"follow_up_{f}")), f"{f.upper()}_MISMATCH") for f in fields]
    version = []
    if {"source", "sample_version", "sample_revision"} <= set(observations.columns):
        sampled = F.coalesce(F.col("baseline_source").isin(SAMPLED_SOURCES), F.lit(False))
        pairs = [(F.col(f"baseline_{f}"), F.col(f"follow_up_{f}")) for f in ("sample_version", "sample_revision")]
        version += [(sampled & reduce(lambda x, y: x | y, [~b.eqNullSafe(f) for b, f in pairs]), "SAMPLE_REVISION_MISMATCH"),
                    (sampled & reduce(lambda x, y: x | y, [b.isNull() for b, _ in pairs]), "SAMPLE_REVISION_MISSING")]
    if {"source", "period_end"} <= set(observations.columns):
        version.append(((F.col("baseline_source") == "SERP") & (F.col("baseline_period_end") != F.col("follow_up_period_end")), "SNAPSHOT_NOT_A_PERIOD"))
    return both.withColumn("mismatch", first_code(
        (F.col("baseline_value").isNull(), "MISSING_BASELINE"), (F.col("follow_up_value").isNull(), "MISSING_FOLLOW_UP"),
        *same, *version))


def dangling(references: DataFrame, entities: DataFrame) -> DataFrame:
    """References (``entity_type, entity_id``) to entities that do not exist."""
    return references.join(entities.select("entity_type", "entity_id").distinct(), ["entity_type", "entity_id"], "left_anti")


def preferred_copies(rows: DataFrame, keys: list[str], priority: str, failed: DataFrame) -> DataFrame:
    """One copy per key, the best source first; keys whose call failed in this run are left out."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    alive = rows.join(failed.select(*keys).distinct(), keys, "left_anti")
    return alive.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min_by(whole, F.col(priority)).alias("_row")).select("_row.*")


#: Tasks over which the rows of one key are spread.
SPREAD = 16


def join_spread(rows: DataFrame, groups: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Inner join of many ``rows`` with one row per ``key``, a key's rows being spread over several tasks.

    ``by`` names the plain columns that tell a key's rows apart; the salt is made of them alone, since it is copied into
    every condition that the optimizer infers from the join.  A fold by ``key`` that follows has to exchange its partial
    results, so a key that holds a third of all rows is never folded row by row in one task.  The copies are merged with the
    rows, never broadcast: Spark's size estimate of a generator's output knows nothing of the ``SPREAD`` rows it makes of one.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SPREAD)).cast("int"))
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return salted.join(copies.hint("merge"), [key, "_salt"]).drop("_salt")


def issue_demand(issues: DataFrame, demand: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Severe issues that meet search demand, and those that do not."""
    wanted = demand.select(*keys).distinct()
    return issues.join(wanted, keys, "left_semi"), issues.join(wanted, keys, "left_anti")


#: Pattern terms that travel together as one array; more of them are tried in several arrays.
PATTERNS_AT_ONCE = 1000


#: Characters of a pattern's literal part by which texts are found.
LITERAL = 6


def required_literal(pattern: Column) -> Column:
    """The longest literal part without which a pattern cannot match; empty where none is sure.

    Only plain concatenations are read: with alternatives, groups, classes, escapes or flags no part is sure.  A character
    before ``?``, ``*`` or a count may be absent and ends the part.
    """
    plain = ~pattern.rlike(r"[|()\[\]\\]")
    pieces = F.split(F.regexp_replace(F.regexp_replace(pattern, r".(?:[?*]|\{[^}]*\})[?+]?", "\n"), r"[.^$+{}]", "\n"), "\n")
    longest = F.reduce(pieces, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))
    return F.when(plain & (F.length(longest) >= 2), longest).otherwise("")


def brand_class(queries: DataFrame, text: str, dictionary: DataFrame) -> DataFrame:
    """Class of each distinct query text by an approved dictionary: exact, then contained, then pattern terms.

    Exact terms join on the text.  Contained terms join on the substrings a text has in the lengths the terms have,
    so neither rule needs a product or a bound.  A pattern that no text can match without some literal part meets, by the
    start of that part, only the texts that have it.  Other patterns can only be tried one by one; they travel in arrays of
    bounded size, as many as it takes.  The first pattern in order decides.  A text nothing matches is Non-brand.
    """
    approved = dictionary.where("status = 'Approved'").select("rule", F.lower("term").alias("term"), "class")
    texts = queries.select(text).distinct().withColumn("_name", F.lower(F.col(text)))

    def of(rule):
        return approved.where(F.col("rule") == rule).groupBy("term").agg(F.min("class").alias("class"))

    exact = texts.join(of("Exact").select(F.col("term").alias("_name"), F.col("class").alias("_exact")), "_name").select(text, "_exact")
    contained = of("Contains")
    lengths = contained.agg(F.collect_set(F.length("term")).alias("l")).scalar()
    pieces = (texts.withColumn("_length", F.explode(lengths)).where(F.length("_name") >= F.col("_length"))
              .withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("_name") - F.col("_length") + 1)))
              .select(text, F.substring(F.col("_name"), F.col("_at"), F.col("_length")).alias("term")))
    inside = pieces.join(contained, "term").groupBy(text).agg(F.min(F.struct("term", "class"))["class"].alias("_inside"))
    ruled = of("Regex").withColumn("_literal", required_literal(F.col("term"))).withColumn("_start", F.substring("_literal", 1, LITERAL))
    keyed = ruled.where("_literal <> ''")
    starts = keyed.agg(F.collect_set(F.length("_start")).alias("l")).scalar()
    seen = (texts.withColumn("_length", F.explode(starts)).where(F.length("_name") >= F.col("_length"))
            .withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("_name") - F.col("_length") + 1)))
            .select(text, "_name", F.substring(F.col("_name"), F.col("_at"), F.col("_length")).alias("_start")).distinct())
    fitting = seen.join(keyed, "_start").where(F.contains("_name", F.col("_literal")) & F.regexp("_name", F.col("term")))
    matched = fitting.groupBy(text).agg(F.min(F.struct("term", "class")).alias("_matched"))
    patterns = ruled.where("_literal = ''").select(F.struct("term", "class").alias("p"))
    blocks = -(-patterns.count() // PATTERNS_AT_ONCE)
    tried, firsts = texts, []
    for k in range(blocks):
        block = patterns.where(F.pmod(F.xxhash64("p"), F.lit(blocks)) == k).agg(F.array_sort(F.collect_list("p")).alias("p")).scalar()
        tried = tried.withColumn(f"_patterns{k}", block)
        firsts.append(F.get(F.filter(f"_patterns{k}", lambda d: F.regexp(F.lower(F.col(text)), d["term"])), F.lit(0)))
    first = F.array_min(F.array_compact(F.array(F.col("_matched"), *firsts)))["class"]
    tried = tried.join(matched, text, "left").select(text, first.alias("_pattern"))
    classified = tried.join(exact, text, "left").join(inside, text, "left").select(
        text, F.coalesce("_exact", "_inside", "_pattern", F.lit("Non-brand")).alias("brand_class"))
    return queries.join(classified, text, "left")


def lineage(anchors: DataFrame, candidates: DataFrame, reviews: DataFrame, bridges: DataFrame) -> DataFrame:
    """State of each anchor's chain: the first of candidate, review, bridge whose id, revision and hash do not all agree."""
    joined, state = anchors, F.lit(None).cast("string")
    for frame, name in ((candidates, "candidate"), (reviews, "review"), (bridges, "bridge")):
        pins = frame.select(F.col(f"{name}_id"), F.col("revision").alias(f"{name}_revision"), F.col("content_hash").alias("_hash"))
        code = first_code((F.col("_hash").isNull(), f"MISSING_{name.upper()}"), (F.col("_hash") != F.col(f"{name}_hash"), f"{name.upper()}_DRIFT"))
        # a hash goes no further than the join that it is compared in
        joined = joined.join(pins, [f"{name}_id", f"{name}_revision"], "left").withColumn("_state", F.coalesce(state, code)).drop("_hash")
        state = F.col("_state")
    return joined.withColumn("lineage_state", F.coalesce(state, F.lit("OK"))).drop("_state")


def query_entities(snapshots: DataFrame, entities: DataFrame) -> DataFrame:
    """First reason a snapshot's query does not match its registry entry in text, locale and country."""
    known = entities.select(F.col("entity_type").alias("query_type"), F.col("entity_id").alias("query_id"),
                            F.col("normalized_text").alias("_text"), F.col("locale").alias("_locale"), F.col("country").alias("_country"))
    joined = snapshots.join(known, ["query_type", "query_id"], "left")
    return joined.withColumn("query_problem", first_code(
        (F.col("_text").isNull(), "UNRESOLVED_QUERY"), (F.col("_text") != F.col("query_text"), "QUERY_TEXT_MISMATCH"),
        (~F.col("_locale").eqNullSafe(F.col("locale")), "LOCALE_MISMATCH"),
        (~F.col("_country").eqNullSafe(F.col("country")), "COUNTRY_MISMATCH"))).drop("_text", "_locale", "_country")


SAMPLE_SCOPE = ["market", "locale", "platform", "model_scope"]


def sample_scope(observations: DataFrame, samples: DataFrame) -> DataFrame:
    """COMPARABILITY_GAP where an observation differs from its fixed sample in scope or revision."""
    fixed = samples.select("sample_id", "sample_version", F.col("revision").alias("_revision"),
                           *[F.col(f).alias(f"_{f}") for f in SAMPLE_SCOPE])
    joined = observations.join(fixed, ["sample_id", "sample_version"], "left")
    same = reduce(lambda a, b: a & b, [F.col(f).eqNullSafe(F.col(f"_{f}")) for f in SAMPLE_SCOPE])
    return joined.withColumn("scope_state", F.when(F.col("_revision").isNull(), "UNKNOWN_SAMPLE").when(
        same & (F.col("sample_revision") == F.col("_revision")), "OK").otherwise("COMPARABILITY_GAP")).drop(
        "_revision", *[f"_{f}" for f in SAMPLE_SCOPE])


def competitor_ids(rows: DataFrame, domain: str, competitors: DataFrame) -> DataFrame:
    """Competitor id of a domain; an unknown domain is kept as it is."""
    known = competitors.groupBy(F.col("domain").alias(domain)).agg(F.min("competitor_id").alias("competitor_id"))
    return rows.join(known, domain, "left").withColumn("competitor_ref", F.coalesce("competitor_id", domain)).drop("competitor_id")


def month_locations(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mapping of a source row by metric and tab, with the check that row, column and month are where they should be."""
    tabs = mapping.select("metric", "source_tab").distinct().withColumn("_mapped", F.lit(True))
    places = mapping.select("metric", "source_tab", "source_row", "source_column", "month").distinct().withColumn("_placed", F.lit(True))
    metrics = mapping.select("metric").distinct().withColumn("_supported", F.lit(True))
    joined = (rows.join(metrics, "metric", "left").join(tabs, ["metric", "source_tab"], "left")
              .join(places, ["metric", "source_tab", "source_row", "source_column", "month"], "left"))
    return joined.withColumn("location_problem", first_code(
        (F.col("_supported").isNull(), "UNSUPPORTED_METRIC"), (F.col("_mapped").isNull(), "SOURCE_NOT_CONFIRMED"),
        (F.col("_placed").isNull(), "MAPPING_DRIFT"))).drop("_supported", "_mapped", "_placed")


def latest_window_pairs(rows: DataFrame, key: str, period: str, value: str) -> DataFrame:
    """Current and previous value per key from its two newest periods."""
    order = Window.partitionBy(key).orderBy(F.desc(period))
    two = rows.withColumn("_rn", F.row_number().over(order)).where("_rn <= 2")
    return two.groupBy(key).agg(F.max(F.when(F.col("_rn") == 1, F.col(value))).alias("current"),
                                F.max(F.when(F.col("_rn") == 2, F.col(value))).alias("previous"))

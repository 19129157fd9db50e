"""Entity registry: typed ids, normal forms, semantic hash and validation, one dimension table per entity type."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sightline.functions import hashing
from sightline.functions.text import norm_domain, norm_text
from sightline.functions.urls import norm_url
from sightline.operators.quality import codes

# --- Fixed values: versions inside the ids, relation endpoints and review vocabulary ----------------------
NORMALIZATION_VERSION = "unicode-nfc-width-casefold-v1"
URL_POLICY_VERSION = "url-sanitization.v1"
RELATION_ENDPOINTS = {
    "TOPIC_HAS_KEYWORD": ("TOPIC", "KEYWORD"), "TOPIC_HAS_QUERY": ("TOPIC", "QUERY"), "TOPIC_HAS_PROMPT": ("TOPIC", "PROMPT"),
    "TOPIC_HAS_URL": ("TOPIC", "URL"), "TOPIC_HAS_COMPETITOR": ("TOPIC", "COMPETITOR"),
    "TOPIC_HAS_BUSINESS_THEME": ("TOPIC", "BUSINESS_THEME"), "URL_CANONICALIZES_TO": ("URL", "URL"),
    "KEYWORD_ALIASES_KEYWORD": ("KEYWORD", "KEYWORD"),
}
REFERENCE_FIELDS = {
    "TOPIC": {"primary_keyword_ref": "KEYWORD", "business_theme_refs": "BUSINESS_THEME"}, "KEYWORD": {"canonical_topic_refs": "TOPIC"},
    "QUERY": {"canonical_topic_refs": "TOPIC"}, "PROMPT": {"canonical_topic_refs": "TOPIC"}, "URL": {"canonical_topic_refs": "TOPIC"},
    "COMPETITOR": {"canonical_topic_refs": "TOPIC", "parent_competitor_ref": "COMPETITOR"},
}
PROVENANCE_METHODS = ["MANUAL", "CURATED", "RULE_BASED", "IMPORTED"]
REVIEW_STATES = ["CANDIDATE", "APPROVED", "REJECTED"]
BUSINESS_THEMES = ["ONLINE_STORE", "POS", "OMO", "CRM", "PAYMENTS", "LOGISTICS", "SOCIAL_COMMERCE", "GROUP_BUYING",
                   "AI_AUTOMATION", "MERCHANT_GROWTH", "ENTERPRISE_RETAIL", "UNMAPPED"]


def make_topics(rows: DataFrame) -> DataFrame:
    """Add ``normalized_name`` and ``topic_id`` to rows of ``topic_name, version``; a given id stands."""
    named = rows.withColumn("normalized_name", norm_text(F.col("topic_name")))
    made = hashing.stable_id("TOPIC", {"normalized_name": F.col("normalized_name"), "version": F.col("version")})
    return named.withColumn("topic_id", F.coalesce("topic_id", made) if "topic_id" in rows.columns else made)


def make_texts(rows: DataFrame, prefix: str, text: str, id_name: str) -> DataFrame:
    """Keywords (``KW``) or queries (``QUERY``): normal text and an id over text, locale and country."""
    named = rows.withColumn("normalized_text", norm_text(F.col(text)))
    return named.withColumn(id_name, hashing.stable_id(prefix, {
        "normalized_text": F.col("normalized_text"), "locale": F.col("locale"),
        "country_database": F.col("country_database"), "normalization_version": F.lit(NORMALIZATION_VERSION)}))


def make_prompts(rows: DataFrame) -> DataFrame:
    fields = ["project_id", "provider_query_id", "prompt_version", "region", "locale"]
    named = rows.withColumn("normalized_text", norm_text(F.col("prompt_text")))
    return named.withColumn("prompt_id", hashing.stable_id("PROMPT", {
        **{f: F.col(f) for f in fields}, "normalization_version": F.lit(NORMALIZATION_VERSION)}))


def make_urls(rows: DataFrame) -> DataFrame:
    """Add ``normalized_url`` and ``url_id``; a URL without an identity keeps both null."""
    named = rows.withColumn("normalized_url", norm_url(F.col("observed_url")))
    made = hashing.stable_id("URL", {"normalized_url": F.col("normalized_url"), "policy": F.lit(URL_POLICY_VERSION)})
    return named.withColumn("url_id", F.when(F.col("normalized_url").isNotNull(), made))


def make_competitors(rows: DataFrame) -> DataFrame:
    named = rows.withColumn("domain", norm_domain(F.col("domain")))
    made = hashing.stable_id("COMP", {"domain": F.col("domain"), "scope": F.col("scope")})
    return named.withColumn("competitor_id", F.when(F.col("domain").isNotNull(), made))


def make_themes(rows: DataFrame) -> DataFrame:
    known = rows.where(F.col("theme_id").isin(BUSINESS_THEMES))
    return known.withColumn("business_theme_id", F.concat(F.lit("THEME_"), "theme_id"))


def make_relations(rows: DataFrame, mapping_version: str) -> DataFrame:
    fields = ["relation_type", "source_entity_type", "source_entity_id", "target_entity_type", "target_entity_id"]
    return rows.withColumn("relation_id", hashing.stable_id("REL", {
        **{f: F.col(f) for f in fields}, "mapping_version": F.lit(mapping_version)}))


def with_semantic_hash(entities: DataFrame, ignore: list[str] = ("created_at", "updated_at")) -> DataFrame:
    """Add the hash of every semantic field; arrays count as sets."""
    kinds = dict(entities.dtypes)
    ordered = entities.withColumns({c: F.array_sort(c) for c, k in kinds.items() if k.startswith("array")}) \
        if any(k.startswith("array") for k in kinds.values()) else entities
    columns = [c for c in entities.columns if c not in ignore]
    return ordered.withColumn("semantic_hash", hashing.row_hash(ordered, columns, as_object=True))


def registry_hash(entities: DataFrame, id_column: str) -> DataFrame:
    """One hash of a whole table of entities, whatever their order.

    The words of all row hashes are added up and the sums are hashed, so the table is folded in constant memory
    by an ordinary partial aggregation.
    """
    row = F.sha2(F.concat_ws("|", id_column, "semantic_hash"), 256)
    words = [F.sum(F.conv(F.substring(row, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")).cast("string") for i in range(8)]
    return entities.agg(F.count(F.lit(1)).alias("entities"), F.sha2(F.concat_ws(",", *words), 256).alias("registry_hash"))


def identity_conflicts(entities: DataFrame) -> DataFrame:
    """Ids that occur more than once: DUPLICATE_ENTITY_ID for equal rows, CANONICAL_VALUE_CONFLICT for different ones."""
    return entities.groupBy("entity_type", "entity_id").agg(
        F.count(F.lit(1)).alias("rows"), (F.min("semantic_hash") != F.max("semantic_hash")).alias("_differ")).where("rows > 1").select(
        "entity_type", "entity_id", "rows",
        F.when(F.col("_differ"), "CANONICAL_VALUE_CONFLICT").otherwise("DUPLICATE_ENTITY_ID").alias("code"))


def normal_form_errors(rows: DataFrame, raw: str, stored: str, kind: str) -> DataFrame:
    """Rows whose stored normal form is not the one the policy gives (``text``, ``url`` or ``domain``)."""
    form = {"text": norm_text, "url": norm_url, "domain": norm_domain}[kind](F.col(raw))
    code = {"text": "INVALID_NORMALIZED_VALUE", "url": "INVALID_URL_IDENTITY", "domain": "INVALID_DOMAIN"}[kind]
    return rows.where(~F.col(stored).eqNullSafe(form) | form.isNull()).withColumn("code", F.lit(code))


def relation_errors(relations: DataFrame, entities: DataFrame) -> DataFrame:
    """Add ``errors`` to relations: type, endpoints, provenance, review and validity rules."""
    c = F.col
    known = entities.select("entity_type", "entity_id").distinct()

    def present(joined: DataFrame, side: str) -> DataFrame:
        ids = known.select(c("entity_type").alias(f"{side}_entity_type"), c("entity_id").alias(f"{side}_entity_id"),
                           F.lit(True).alias(f"_{side}"))
        return joined.join(ids, [f"{side}_entity_type", f"{side}_entity_id"], "left")

    copies = relations.groupBy("relation_id").agg(F.count(F.lit(1)).alias("_copies"))
    joined = present(present(relations, "source"), "target").join(copies, "relation_id", "left")
    ends = F.create_map(*[x for name, (a, b) in RELATION_ENDPOINTS.items() for x in (F.lit(name), F.lit(f"{a}>{b}"))])
    actual: Column = F.concat_ws(">", "source_entity_type", "target_entity_type")
    wanted = ends[c("relation_type")]
    return joined.withColumn("errors", codes(
        (~hashing.is_identifier(c("relation_id")), "INVALID_NORMALIZED_VALUE"),
        (c("_copies") > 1, "DUPLICATE_ENTITY_ID"),
        (wanted.isNull() | (wanted != actual), "INVALID_RELATION_TYPE"),
        (wanted.isNotNull() & (c("_source").isNull() | c("_target").isNull()), "DANGLING_REFERENCE"),
        ((c("source_entity_type") == c("target_entity_type")) & (c("source_entity_id") == c("target_entity_id")), "SELF_RELATION"),
        (~c("mapping_method").isin(PROVENANCE_METHODS), "INVALID_PROVENANCE"),
        (~c("review_state").isin(REVIEW_STATES), "INVALID_REVIEW_STATE"),
        ((c("review_state").isin("APPROVED", "REJECTED") & c("reviewed_by_id").isNull())
         | ((c("review_state") == "APPROVED") & (c("mapping_method") == "RULE_BASED")), "UNAPPROVED_RELATION"),
        (F.size(F.array_distinct("evidence_refs")) != F.size("evidence_refs"), "DUPLICATE_EVIDENCE_REF"),
        (c("valid_from") > c("valid_to"), "REVERSED_VALIDITY"))).drop("_source", "_target", "_copies")


def reference_errors(tables: dict[str, DataFrame]) -> DataFrame:
    """References between entities that lead nowhere, as ``entity_type, entity_id, field, ref, code``.

    ``tables``: entity type to its entities, each with ``entity_id`` and the reference columns it has (one id or a list).
    Each distinct target is looked up once, however many entities name it; only missing ones meet the entities again.
    Null references and null entries of a list are no references; an entity that names one target twice is reported once.
    """
    c = F.col
    ids = reduce(DataFrame.unionByName, [df.select(F.lit(kind).alias("target_type"), c("entity_id").cast("string").alias("ref")) for kind, df in tables.items()])
    parts = []
    for kind, fields in REFERENCE_FIELDS.items():
        for field, target in fields.items():
            if kind in tables and field in tables[kind].columns:
                held = c(field) if dict(tables[kind].dtypes)[field].startswith("array") else F.array(field)
                parts.append(tables[kind].select(F.lit(kind).alias("entity_type"), c("entity_id").cast("string").alias("entity_id"), F.lit(field).alias("field"),
                                                 F.lit(target).alias("target_type"), F.explode(F.array_distinct(held.cast("array<string>"))).alias("ref")))
    if not parts:
        raise ValueError(f"no reference columns in {sorted(tables)}")
    named = reduce(DataFrame.unionByName, parts).where("ref IS NOT NULL")
    missing = named.select("target_type", "ref").distinct().join(ids.distinct(), ["target_type", "ref"], "left_anti")
    return named.join(missing, ["target_type", "ref"], "left_semi").select(
        "entity_type", "entity_id", "field", "ref", F.lit("DANGLING_REFERENCE").alias("code"))

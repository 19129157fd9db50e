"""Bands, ratings, categories and lookups as column expressions."""

from pyspark.sql import Column, functions as F

from sightline.schemas import SOURCE_CLASS, VITALS


def lookup(value: Column, table: dict, default=None) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.create_map(*pairs)[value]
    return found if default is None else F.coalesce(found, F.lit(default))


def volume_band(volume: Column) -> Column:
    """Demand band 0..4 of a search volume; a missing volume has no band."""
    return (F.when(volume.isNull(), F.lit(None)).when(volume <= 0, 0).when(volume < 100, 1)
            .when(volume < 500, 2).when(volume < 2000, 3).otherwise(4))


def traction_band(impressions: Column, position: Column, ctr: Column, coverage: Column) -> Column:
    """Traction band 0..4; below 100 impressions only a proven zero has a band."""
    none = F.lit(None).cast("int")
    return (F.when(impressions.isNull() | position.isNull(), none)
            .when((impressions == 0) & (coverage == "COMPLETE_WITHIN_SCOPE"), 0)
            .when(impressions < 100, none)
            .when(position.between(4, 15), 4)
            .when(position <= 3, F.when(ctr.isNotNull(), 3).otherwise(0))
            .when(position <= 20, 3).when(position <= 40, 2).otherwise(1))


def vital_rating(metric: Column, p75: Column) -> Column:
    good = lookup(metric, {m: g for m, _, _, g, _, _ in VITALS})
    poor = lookup(metric, {m: p for m, _, _, _, p, _ in VITALS})
    return F.when(p75 <= good, "GOOD").when(p75 <= poor, "NEEDS_IMPROVEMENT").when(p75 > poor, "POOR")


# Result type -> page type and intent.
PAGE_TYPES = {
    "article": "informational_article", "comparison": "commercial_comparison", "category": "category_product",
    "product": "category_product", "homepage": "homepage", "tool": "tool", "video": "video", "forum": "forum",
    "official_documentation": "official_documentation", "faq": "faq",
}
INTENTS = {
    "article": "INFORMATIONAL", "comparison": "COMMERCIAL_INVESTIGATION", "category": "TRANSACTIONAL",
    "product": "TRANSACTIONAL", "homepage": "NAVIGATIONAL", "tool": "TRANSACTIONAL",
    "official_documentation": "INFORMATIONAL", "faq": "INFORMATIONAL", "video": "INFORMATIONAL",
    "forum": "INFORMATIONAL",
}


def page_type(result_type: Column) -> Column:
    return lookup(result_type, PAGE_TYPES, "unknown")


def intent(result_type: Column) -> Column:
    return lookup(result_type, INTENTS, "UNKNOWN")


def source_class(source: Column) -> Column:
    return lookup(source, SOURCE_CLASS)


# Fixed patterns: status words, first match wins.
STATUS_WORDS = [
    (r"\b(low|no)\s+risk\b|\brisk[ -]free\b", "positive"),
    (r"\b(moderate|medium|warning|slipping)\b|^(due soon|investigating|mitigating)$", "warning"),
    (r"\b(elevated|high|critical|risk|lost|churned|failed|cancelled|canceled|overdue)\b", "negative"),
    (r"^(new|pending|monitoring)$", "info"),
    (r"^(low|retained|active|paid|healthy|complete|completed|success|stable|on track|using|used|resolved)$", "positive"),
]


def status_tone(status: Column) -> Column:
    text = F.lower(F.coalesce(status, F.lit("")))
    tone = F.when(text.rlike(STATUS_WORDS[0][0]), STATUS_WORDS[0][1])
    for pattern, name in STATUS_WORDS[1:]:
        tone = tone.when(text.rlike(pattern), name)
    return tone.otherwise("neutral")


def is_temporal(value: Column) -> Column:
    """Text is an ISO month, or an ISO date or timestamp naming a real day."""
    return F.coalesce(
        value.rlike(r"^\d{4}-(0[1-9]|1[0-2])$")
        | (value.rlike(r"^\d{4}-\d{2}-\d{2}(T|$)")
           & F.try_to_date(F.substring(value, 1, 10), "yyyy-MM-dd").isNotNull()), F.lit(False))


def delta_tone(delta: Column, lower_is_better: bool = False) -> Column:
    good = delta < 0 if lower_is_better else delta > 0
    return F.when(delta.isNull(), F.lit(None)).when(delta == 0, "neutral").when(good, "positive").otherwise("negative")


def sorted_features(features: Column) -> Column:
    """Feature map with lower-case keys in order and upper-case states."""
    return F.map_from_entries(F.array_sort(F.transform(
        F.map_entries(features), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), F.upper(e["value"]).alias("value")))))


def observed_features(names: Column) -> Column:
    """Feature list as a map that marks every named feature as observed."""
    keys = F.array_sort(F.array_distinct(F.transform(names, lambda n: F.lower(F.trim(n)))))
    return F.map_from_arrays(keys, F.transform(keys, lambda _: F.lit("OBSERVED")))


def densities(bins: Column) -> Column:
    """Good, needs-improvement and poor share of a histogram; absent bins stay null."""
    return F.struct(F.get(bins, F.lit(0)).alias("good"), F.get(bins, F.lit(1)).alias("needs"),
                    F.get(bins, F.lit(2)).alias("poor"))


def month_label(month: Column) -> Column:
    return F.concat(F.substring(month, 6, 2).cast("int").cast("string"), F.lit(" 月"))

"""Fixed values and table schemas shared by every operator."""

from pyspark.sql import types as T

# --- Fixed values: states, limits, weights and thresholds a result must agree with -----------------------

FRESHNESS_STATES = ["READY", "PARTIAL", "STALE", "FAILED", "NOT_AVAILABLE"]
COLLECTION_STATES = ["SUCCESS", "PARTIAL", "FAILED", "NOT_AVAILABLE"]
FEATURE_STATES = ["OBSERVED", "NOT_OBSERVED", "NOT_AVAILABLE"]
CAPABILITY_STATES = ["OBSERVED", "NOT_OBSERVED", "NOT_AVAILABLE", "UNKNOWN"]
SNAPSHOT_STATES = ["Ready", "Partial", "Stale", "Failed"]

# Days a source stays current.
MAX_AGE_DAYS = {
    "AHREFS": 30, "GSC": 7, "GA4": 7, "SF": 14, "SERP": 7, "WORKDUO": 7, "CRUX": 14, "BUSINESS": 35,
}

# Source family -> evidence class.
SOURCE_CLASS = {
    "AHREFS": "THIRD_PARTY_ESTIMATE", "GSC": "FIRST_PARTY_SEARCH_ACTUAL",
    "GA4": "FIRST_PARTY_BEHAVIOR_DIAGNOSTIC", "SF": "TECHNICAL_CRAWL_EVIDENCE", "SERP": "LIVE_SERP_SNAPSHOT",
    "WORKDUO": "MONITORED_GEO_SAMPLE", "CRUX": "FIELD_UX_EVIDENCE", "BUSINESS": "FORMAL_BUSINESS_ACTUAL",
}

# Percent weight per dimension and scoring profile.
DIMENSIONS = ["demand", "traction", "business", "attainability", "geo", "execution"]
SCORE_WEIGHTS = {
    "existing": {"demand": 20, "traction": 15, "business": 30, "attainability": 20, "geo": 0, "execution": 15},
    "new": {"demand": 25, "traction": 0, "business": 30, "attainability": 25, "geo": 0, "execution": 20},
    "geo": {"demand": 10, "traction": 5, "business": 30, "attainability": 15, "geo": 30, "execution": 10},
}

# (metric, short label, unit, good up to, poor above, core vital)
VITALS = [
    ("largest_contentful_paint", "LCP", "s", 2500.0, 4000.0, True),
    ("interaction_to_next_paint", "INP", "ms", 200.0, 500.0, True),
    ("cumulative_layout_shift", "CLS", "score", 0.1, 0.25, True),
    ("first_contentful_paint", "FCP", "s", 1800.0, 3000.0, False),
    ("experimental_time_to_first_byte", "TTFB", "ms", 800.0, 1800.0, False),
]

# (section, label, severity) of the crawl findings that are reported.
CRAWL_CATALOGUE = [
    ("H1", "Missing", "HIGH"),
    ("Response Codes", "Internal Redirection (3xx)", "HIGH"),
    ("Images", "Over 100 kB", "HIGH"),
    ("Images", "Missing Alt Text", "MEDIUM"),
    ("Canonicals", "Non-Indexable Canonical", "MEDIUM"),
    ("Canonicals", "Canonicalised", "MEDIUM"),
    ("Page Titles", "Over 561 Pixels", "MEDIUM"),
    ("Meta Description", "Over 985 Pixels", "MEDIUM"),
    ("Response Codes", "External Client Error (4xx)", "MEDIUM"),
    ("H1", "Duplicate", "MEDIUM"),
    ("H1", "Multiple", "MEDIUM"),
    ("Hreflang", "Missing X-Default", "MEDIUM"),
    ("Response Codes", "External Server Error (5xx)", "LOW"),
    ("Page Titles", "Same as H1", "LOW"),
    ("Meta Description", "Duplicate", "LOW"),
    ("Page Titles", "Duplicate", "LOW"),
    ("H2", "Duplicate", "LOW"),
    ("Security", "Missing HSTS Header", "LOW"),
    ("Security", "Missing Content-Security-Policy Header", "LOW"),
    ("Security", "Unsafe Cross-Origin Links", "LOW"),
    ("Content", "Low Content Pages", "LOW"),
]
SEVERITY_ORDER = {"HIGH": 0, "MEDIUM": 1, "LOW": 2}

# (section, reason) of the crawl findings that are left out on purpose.
CRAWL_EXCLUSIONS = [
    ("Meta Keywords: Missing", "not used by search engines"),
    ("Canonicals: Self Referencing / Contains Canonical", "a correct state"),
    ("H1 / H2: Non-Sequential", "template tag order"),
    ("Page Titles / Meta Description: Below N Characters", "depends on query intent"),
    ("URL: Non ASCII Characters", "intended"),
    ("Security: HTTPS URLs", "a healthy state"),
]

# Query parameters that carry campaign tracking; also every name starting with utm_.
TRACKING_PARAMS = ["dclid", "fbclid", "gclid", "mc_cid", "mc_eid", "msclkid"]

MATURITY_DAYS = 60
REPORTING_ZONE = "Asia/Taipei"
BEHAVIOUR_CHANNELS = ["Organic Search", "AI Assistant"]

SNAPSHOT_KEY = ["contract_version", "source", "metric_granularity", "period_start", "period_end", "metric_group",
                "metric", "segment", "platform_property"]
SNAPSHOT_CONTENT = ["as_of_date", "data_status", "value", "denominator", "target", "unit", "source_timezone",
                    "source_reference"]

# --- Table schemas ----------------------------------------------------------------------------------------

SEARCH_PAGE = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("property", T.StringType()),
    T.StructField("rows", T.ArrayType(T.StructType([
        T.StructField("keys", T.ArrayType(T.StringType())),
        T.StructField("clicks", T.DoubleType()),
        T.StructField("impressions", T.DoubleType()),
        T.StructField("ctr", T.DoubleType()),
        T.StructField("position", T.DoubleType()),
    ]))),
])

_VALUE = T.ArrayType(T.StructType([T.StructField("value", T.StringType())]))
BEHAVIOUR_PAGE = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("property", T.StringType()),
    T.StructField("rows", T.ArrayType(T.StructType([
        T.StructField("dimension_values", _VALUE),
        T.StructField("metric_values", _VALUE),
    ]))),
])

_NAME = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))
BEHAVIOUR_ENVELOPE = T.StructType([
    T.StructField("request", T.StructType([
        T.StructField("property_id", T.StringType()),
        T.StructField("date_ranges", T.ArrayType(T.StructType([
            T.StructField("start_date", T.StringType()), T.StructField("end_date", T.StringType())]))),
        T.StructField("dimensions", T.ArrayType(T.StringType())),
        T.StructField("metrics", T.ArrayType(T.StringType())),
    ])),
    T.StructField("response", T.StructType([
        T.StructField("dimension_headers", _NAME),
        T.StructField("metric_headers", _NAME),
        T.StructField("row_count", T.LongType()),
        T.StructField("metadata", T.StructType([
            T.StructField("time_zone", T.StringType()),
            T.StructField("data_loss_from_other_row", T.BooleanType()),
            T.StructField("subject_to_thresholding", T.BooleanType()),
            T.StructField("sampling_metadatas", T.ArrayType(T.StringType())),
        ])),
        T.StructField("rows", BEHAVIOUR_PAGE["rows"].dataType),
    ])),
])

"""Crawl audit over crawled pages: headings, titles, descriptions, content, canonicals, links, headers.

Page markup is cut with regular expressions inside the JVM; page-wide checks are one pass, checks across pages
are one aggregation per key.
"""

from pyspark.sql import Column, DataFrame, functions as F

from sightline import schemas
from sightline.functions.urls import host_of, single_slash_path
from sightline.operators.graph import chain_ends
from sightline.operators.quality import missing_from

TITLE = r"(?is)<title[^>]*>(.*?)</title>"
HEADING = r"(?is)<h1[^>]*>(.*?)</h1>"
META_TAG = r"(?is)<meta\b[^>]*>"
IMAGE = r"(?is)<img\b[^>]*>"
LINK_TAG = r"(?is)<link\b[^>]*>"
ALTERNATE = r"(?is)<link\b[^>]*hreflang\s*=[^>]*>"


HIDDEN = [rf"(?is)<{tag}\b.*?</{tag}>" for tag in ("script", "style", "head")]


def plain_text(markup: Column) -> Column:
    """Markup without tags, its spaces folded."""
    return F.trim(F.regexp_replace(F.regexp_replace(markup, r"(?s)<[^>]*>", " "), r"\s+", " "))


def attribute(tag: Column, name: str) -> Column:
    """Quoted value of a tag's attribute; null where it is absent or empty."""
    return F.nullif(F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*["']([^"']*)["']""", 1), F.lit(""))


def page_facts(pages: DataFrame) -> DataFrame:
    """Title, headings, description, canonical and word count of each page; the generator keeps each part from being
    worked out again wherever it is used."""
    html = F.col("html")
    body = html
    for hidden in HIDDEN:
        body = F.regexp_replace(body, hidden, " ")
    canonical = F.filter(F.regexp_extract_all(html, F.lit(LINK_TAG), F.lit(0)), lambda m: m.rlike(r"""(?i)rel\s*=\s*["']?canonical"""))
    headings = F.transform(F.regexp_extract_all(html, F.lit(HEADING), F.lit(1)), plain_text)
    metas = F.filter(F.regexp_extract_all(html, F.lit(META_TAG), F.lit(0)), lambda m: m.rlike(r"""(?i)name\s*=\s*["']?description"""))
    read = pages.select("page_id", "url", F.inline(F.array(F.struct(
        plain_text(F.regexp_extract(html, TITLE, 1)).alias("title"), headings.alias("headings"),
        attribute(F.get(metas, F.lit(0)), "content").alias("description"),
        attribute(F.get(canonical, F.lit(0)), "href").alias("canonical"), plain_text(body).alias("_text")))))
    return read.select(
        "page_id", "url", "title", "headings", "description", "canonical",
        F.when(F.col("_text") == "", 0).otherwise(F.size(F.split("_text", " "))).alias("words"), F.sha2("_text", 256).alias("content_hash"))


def _issue(rows: DataFrame, section: str, label: str) -> DataFrame:
    return rows.select("page_id", F.lit(section).alias("section"), F.lit(label).alias("label"))


def page_issues(facts: DataFrame) -> DataFrame:
    """Issues that one page shows by itself, one row per page and issue.

    All checks are flags of a single scan; only the flags that fire become rows.
    """
    heading, title, description = F.get("headings", F.lit(0)), F.col("title"), F.col("description")
    size = F.size(F.filter("headings", lambda h: h != ""))
    checks = [
        (size == 0, "H1", "Missing"), (size > 1, "H1", "Multiple"), (F.char_length(heading) > 70, "H1", "Over 70 Characters"),
        (F.coalesce(title, F.lit("")) == "", "Page Titles", "Missing"), (F.char_length(title) > 60, "Page Titles", "Over 60 Characters"),
        ((title != "") & (F.char_length(title) < 30), "Page Titles", "Below 30 Characters"),
        ((title != "") & (title == heading), "Page Titles", "Same as H1"),
        (F.coalesce(description, F.lit("")) == "", "Meta Description", "Missing"),
        (F.char_length(description) > 155, "Meta Description", "Over 155 Characters"),
        ((description != "") & (F.char_length(description) < 70), "Meta Description", "Below 70 Characters"),
        (F.col("words") < 200, "Content", "Low Content Pages"),
        (F.regexp_extract("url", r"^[^:/?#]+://[^/?#]*([^?#]*)", 1).rlike("//"), "URL", "Multiple Slashes"),
    ]
    fired = F.array_compact(F.array(*[
        F.when(F.coalesce(condition, F.lit(False)), F.struct(F.lit(section).alias("section"), F.lit(label).alias("label")))
        for condition, section, label in checks]))
    return facts.select("page_id", F.inline(fired))


def shared_value_issues(facts: DataFrame) -> DataFrame:
    """Titles, headings, descriptions and contents that several pages share.

    All four kinds go through one aggregation of value hashes and one semi-join; an empty value is not shared.
    """
    parts = [("H1", F.get("headings", F.lit(0))), ("Page Titles", F.col("title")),
             ("Meta Description", F.col("description")), ("Content", F.when(F.col("words") > 0, F.col("content_hash")))]
    values = F.array_compact(F.array(*[
        F.when(value != "", F.struct(F.lit(section).alias("section"), F.sha2(value, 256).alias("value"))) for section, value in parts]))
    rows = facts.select("page_id", F.inline(values))
    shared = rows.groupBy("section", "value").agg(F.count(F.lit(1)).alias("pages")).where("pages > 1")
    return rows.join(shared, ["section", "value"], "left_semi").select("page_id", "section", F.lit("Duplicate").alias("label"))


def canonical_issues(facts: DataFrame, status: DataFrame) -> DataFrame:
    """Pages canonicalised elsewhere, and canonicals that point at a page that cannot be indexed.

    ``status`` holds ``url, http_status, indexable``.
    """
    pointed = facts.where(F.col("canonical").isNotNull() & (F.col("canonical") != F.col("url")))
    target = status.select(F.col("url").alias("canonical"), "http_status", "indexable")
    bad = pointed.join(target, "canonical", "left").where(F.coalesce(~F.col("indexable") | (F.col("http_status") != 200), F.lit(True)))
    return _issue(pointed, "Canonicals", "Canonicalised").unionByName(_issue(bad, "Canonicals", "Non-Indexable Canonical"))


def links(pages: DataFrame) -> DataFrame:
    """One row per anchor: source page, raw href, target URL, anchor text and whether it stays on the host."""
    anchors = F.transform(F.regexp_extract_all("html", F.lit(r"(?is)<a\b[^>]*>.*?</a>"), F.lit(0)), lambda a: F.struct(
        F.regexp_extract(a, r"(?is)^<a\b([^>]*)>", 1).alias("tag"), plain_text(a).alias("anchor")))
    rows = pages.select("page_id", "url", F.inline(anchors)).withColumn("href", attribute(F.concat(F.lit(" "), "tag"), "href")).where("href IS NOT NULL")
    origin = F.regexp_extract("url", r"^([^:/?#]+://[^/?#]*)", 1)
    scheme = F.regexp_extract("url", r"^([^:/?#]+):", 1)
    target = (F.when(F.col("href").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.col("href"))
              .when(F.col("href").startswith("//"), F.concat(scheme, F.lit(":"), F.col("href")))
              .when(F.col("href").startswith("/"), F.concat(origin, F.col("href")))
              .otherwise(F.concat(F.regexp_extract("url", r"^([^?#]*/)", 1), F.col("href"))))
    return rows.withColumn("target", target).withColumn("internal", host_of(F.col("target")) == host_of(F.col("url"))).drop("tag")


def redirect_ends(status: DataFrame) -> DataFrame:
    """``url, hops, final_url, final_status, state`` of every redirect, followed to its end.

    ``status``: ``url, http_status, location``.  ``state`` is REDIRECT (one hop), CHAIN (several), LOOP (no end), BROKEN (the
    end is an error) or UNKNOWN_END (the end was not crawled).  Pointers are doubled, so a chain takes as many rounds as the
    logarithm of its length, and a target of very many redirects is met by partial results.
    """
    moved = status.where("http_status BETWEEN 300 AND 399 AND location IS NOT NULL")
    ends = chain_ends(moved.select(F.col("url").alias("node"), F.col("location").alias("next")))
    codes = status.groupBy(F.col("url").alias("end")).agg(F.min("http_status").alias("final_status"))
    joined = ends.join(codes, "end", "left")
    state = (F.when(F.col("looped"), "LOOP").when(F.col("final_status").isNull(), "UNKNOWN_END").when(F.col("final_status") >= 400, "BROKEN")
             .when(F.col("hops") > 1, "CHAIN").otherwise("REDIRECT"))
    return joined.select(F.col("node").alias("url"), "hops", F.col("end").alias("final_url"), "final_status", state.alias("state"))


def link_status_issues(link_rows: DataFrame, status: DataFrame) -> DataFrame:
    """Pages with internal links to redirects, or external links to client or server errors."""
    targets = status.select(F.col("url").alias("target"), "http_status")
    joined = link_rows.join(targets, "target")
    code = F.floor(F.col("http_status") / 100)
    label = (F.when(F.col("internal") & (code == 3), "Internal Redirection (3xx)")
             .when(~F.col("internal") & (code == 4), "External Client Error (4xx)")
             .when(~F.col("internal") & (code == 5), "External Server Error (5xx)"))
    return joined.withColumn("label", label).where("label IS NOT NULL").groupBy("page_id", "label").agg(
        F.count(F.lit(1)).alias("links")).select("page_id", F.lit("Response Codes").alias("section"), "label", "links")


def image_issues(pages: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Pages with images that lack an alt text, or (with a size table) weigh more than 100 kB."""
    tags = F.regexp_extract_all("html", F.lit(IMAGE), F.lit(0))
    bare = F.size(F.filter(tags, lambda i: F.coalesce(F.trim(attribute(i, "alt")), F.lit("")) == ""))
    missing = _issue(pages.where(bare > 0), "Images", "Missing Alt Text")
    if sizes is None:
        return missing
    used = pages.select("page_id", F.explode(F.transform(tags, lambda i: attribute(i, "src"))).alias("src"))
    heavy = used.join(sizes.where("bytes > 102400"), "src", "left_semi").select("page_id").distinct()
    return missing.unionByName(_issue(heavy, "Images", "Over 100 kB"))


def hreflang_issues(pages: DataFrame) -> DataFrame:
    """Pages with alternates that name neither a default nor the page itself."""
    tags = F.regexp_extract_all("html", F.lit(ALTERNATE), F.lit(0))
    rows = pages.withColumn("_tags", tags).where(F.size("_tags") > 0)
    default = F.exists("_tags", lambda t: F.lower(attribute(t, "hreflang")) == "x-default")
    itself = F.exists("_tags", lambda t: attribute(t, "href") == F.col("url"))
    return _issue(rows.where(~default), "Hreflang", "Missing X-Default").unionByName(
        _issue(rows.where(~itself), "Hreflang", "Missing Self Reference"))


SECURITY_HEADERS = {"strict-transport-security": "Missing HSTS Header",
                    "content-security-policy": "Missing Content-Security-Policy Header",
                    "referrer-policy": "Missing Referrer-Policy Header"}


def security_issues(pages: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Unsafe cross-origin links and, with a table of lower-case header maps, missing security headers."""
    blank_target = F.filter(F.regexp_extract_all("html", F.lit(r"(?is)<a\b[^>]*>"), F.lit(0)), lambda a: a.rlike(
        r"""(?i)target\s*=\s*["']?_blank""") & ~a.rlike(r"""(?i)rel\s*=\s*["'][^"']*(noopener|noreferrer)"""))
    unsafe = _issue(pages.where(F.size(blank_target) > 0), "Security", "Unsafe Cross-Origin Links")
    if headers is None:
        return unsafe
    fired = F.array_compact(F.array(*[F.when(F.element_at("headers", name).isNull(), label) for name, label in SECURITY_HEADERS.items()]))
    absent = headers.select("page_id", F.lit("Security").alias("section"), F.explode(fired).alias("label"))
    return unsafe.unionByName(absent)


def double_slash(pages: DataFrame) -> DataFrame:
    """URLs with a repeated slash in the path, beside the single-slash URL they should have."""
    return pages.select("page_id", "url", single_slash_path(F.col("url")).alias("canonical")).where("url <> canonical")


def inlinks(facts: DataFrame, link_rows: DataFrame) -> DataFrame:
    """Incoming internal links of every page: none is ORPHAN, one is WEAK."""
    counts = link_rows.where("internal AND target <> url").groupBy(F.col("target").alias("url")).agg(
        F.count_distinct("page_id").alias("_sources"), F.count(F.lit(1)).alias("_links"))
    joined = facts.select("page_id", "url").join(counts, "url", "left")
    sources = F.coalesce("_sources", F.lit(0))
    return joined.select("page_id", "url", sources.alias("sources"), F.coalesce("_links", F.lit(0)).alias("links"),
                         F.when(sources == 0, "ORPHAN").when(sources == 1, "WEAK").otherwise("LINKED").alias("state"))


# Anchors that say nothing, and the wanted mix.
GENERIC_ANCHORS = ["click here", "here", "more", "read more", "learn more", "點這裡", "更多", "了解更多"]
ANCHOR_GOAL = {"descriptive": 0.6, "brand": 0.3, "generic": 0.1}


def anchor_mix(link_rows: DataFrame, brand: str) -> DataFrame:
    """Share of descriptive, brand and generic anchors per link target."""
    text = F.lower(F.trim("anchor"))
    kind = F.when(text.isin(GENERIC_ANCHORS) | (text == ""), "generic").when(F.contains(text, F.lit(brand.lower())), "brand").otherwise("descriptive")
    counts = link_rows.groupBy("target").agg(F.count(F.lit(1)).alias("links"), *[
        F.count_if(kind == name).alias(f"_{name}") for name in ANCHOR_GOAL])
    return counts.select("target", "links", *[(F.col(f"_{n}") / F.col("links")).alias(f"{n}_share") for n in ANCHOR_GOAL])


def sitemap_missing(crawl: DataFrame, sitemap: DataFrame) -> DataFrame:
    """Indexable crawled URLs the sitemap does not list."""
    return missing_from(crawl.where("indexable"), sitemap, ["url"])


def issue_summary(issues: DataFrame, crawled: Column) -> DataFrame:
    """Affected pages per issue with their share of the crawl and the catalogue severity."""
    severity = F.create_map(*[x for section, label, level in schemas.CRAWL_CATALOGUE for x in (F.lit(f"{section}|{label}"), F.lit(level))])
    return issues.groupBy("section", "label").agg(F.count_distinct("page_id").alias("count")).withColumns({
        "share": F.try_divide(F.col("count").cast("double"), crawled.cast("double")),
        "severity": severity[F.concat_ws("|", "section", "label")]})


def export_manifest(issues: DataFrame) -> DataFrame:
    """One line per issue export: affected rows, status and file name."""
    name = F.regexp_replace(F.lower(F.concat_ws("_", "section", "label")), "[^a-z0-9]+", "_")
    return issues.groupBy("section", "label").agg(F.count_distinct("page_id").alias("affected_count")).withColumns({
        "status": F.when(F.col("affected_count") > 0, "exported").otherwise("empty"), "file": F.concat(name, F.lit(".csv"))})

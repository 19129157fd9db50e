"""URL identity: exact normal form, tracking removal, host checks."""

from pyspark.sql import Column, functions as F

from sightline.functions.text import norm_host
from sightline.schemas import TRACKING_PARAMS

# Scheme, authority, path, query, fragment of RFC 3986 appendix B.
PARTS = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
PERSONAL_PARAM = r"email|e-mail|phone|tel|mobile|name|customer|lead"
TRACKING = "^utm_|^(?:" + "|".join(TRACKING_PARAMS) + ")$"


def url_part(url: Column, index: int) -> Column:
    return F.regexp_extract(url, PARTS, index)


def param_name(param: Column) -> Column:
    name = F.regexp_extract(param, "^([^=]*)", 1)
    return F.lower(F.coalesce(F.try_url_decode(name), name))


def without_tracking(query: Column) -> Column:
    """Query string without campaign parameters; the order and spelling of the rest is kept."""
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~param_name(p).rlike(TRACKING))
    return F.array_join(kept, "&")


def has_personal_param(query: Column) -> Column:
    return F.exists(F.split(query, "&"), lambda p: ~param_name(p).rlike(TRACKING) & param_name(p).rlike(PERSONAL_PARAM))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[^:/?#]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def norm_url(url: Column) -> Column:
    """Identity of an http(s) URL, or null when it has none.

    Scheme and host fold to lower case, a default port, the fragment and tracking parameters go; path case,
    trailing slashes and other parameters stay.  User info, white space, ports past 65535 and personal parameters
    disqualify.  A numeric IPv6 host stays in its brackets.
    """
    raw = F.trim(url)
    scheme, whole = F.lower(url_part(raw, 1)), url_part(raw, 2)
    user, authority = F.regexp_extract(whole, "^(.*)@", 1), F.regexp_replace(whole, "^.*@", "")
    path, query = url_part(raw, 3), url_part(raw, 4)
    digits = F.regexp_replace(F.regexp_extract(authority, r":(\d*)$", 1), "^0+(?=.)", "")
    port = F.when(F.length(digits) > 5, F.lit(None).cast("string")).when((digits == "") | (digits.try_cast("int") <= 65535), digits)
    name = F.regexp_replace(authority, r":\d*$", "")
    numeric = name.rlike(r"^\[[0-9A-Fa-f]*:[0-9A-Fa-f:.]*\]$")
    host = F.when(numeric, F.lower(name)).otherwise(norm_host(name))
    default_port = ((port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")))
    kept = without_tracking(query)
    built = F.concat(
        scheme, F.lit("://"), host,
        F.when(default_port, "").otherwise(F.concat(F.lit(":"), port)),
        F.when(path == "", "/").otherwise(path),
        F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))
    usable = (scheme.isin("http", "https") & user.isin("", ":") & ~raw.rlike(r"[\s\x00-\x1f]")
              & (numeric | ~host.rlike(r"[:\[\]]")) & ~has_personal_param(query))
    return F.when(usable, built)


def landing_url(page: Column, host: Column) -> Column:
    """Absolute identity of a landing page; null when it lies on another host."""
    absolute = F.when(page.startswith("/"), F.concat(F.lit("https://"), host, page)).otherwise(page)
    return F.when(host_of(absolute) == F.lower(host), norm_url(absolute))


def search_property(prop: Column, site: Column) -> Column:
    """Search-console property name of a configured property and site."""
    prop, site = F.coalesce(F.trim(prop), F.lit("")), F.coalesce(F.trim(site), F.lit(""))
    bare = F.regexp_replace(prop, "^/+|/+$", "")
    site_host = F.regexp_replace(F.regexp_replace(site, "^https?://", ""), "^/+|/+$", "")
    return (F.when(prop.rlike("^(?:https?://|sc-domain:)"), prop)
            .when(prop == "", site)
            .when(site.rlike("^https?://") & (bare == site_host), site)
            .otherwise(F.concat(F.lit("sc-domain:"), bare)))


def host_within(host: Column, allowed: Column) -> Column:
    """Host equals the allowed host or lies below it."""
    host, allowed = F.lower(host), F.lower(allowed)
    return (host == allowed) | host.endswith(F.concat(F.lit("."), allowed))


def single_slash_path(url: Column) -> Column:
    """URL whose path has every run of slashes reduced to one."""
    head = F.regexp_extract(url, r"^([^:/?#]+://[^/?#]*)", 1)
    rest = url.substr(F.length(head) + 1, F.length(url))
    path, tail = F.regexp_extract(rest, r"^([^?#]*)", 1), F.regexp_extract(rest, r"^[^?#]*(.*)$", 1)
    return F.concat(head, F.regexp_replace(path, "/{2,}", "/"), tail)

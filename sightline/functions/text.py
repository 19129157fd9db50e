"""Text and domain identity: width folding, composition, whitespace, case folding."""

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Full-width ASCII (U+FF01..U+FF5E) and the ideographic space fold to plain ASCII.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "\u3000"
_PLAIN = "".join(chr(c) for c in range(0x21, 0x7F)) + " "
_FOLD = str.maketrans(_WIDE, _PLAIN)
_HAS_WIDE = re.compile("[\uff01-\uff5e\u3000]")
NON_ASCII = r"[^\x00-\x7F]"
ASCII_SPACE_RUN = r"[\s\x1c-\x1f]+"


@F.pandas_udf(T.StringType())
def compose_and_fold(values: pd.Series) -> pd.Series:
    """Canonical composition and full case folding, which Spark SQL has no expression for."""
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFC", v).casefold())


@F.pandas_udf(T.StringType())
def fold_unicode_text(values: pd.Series) -> pd.Series:
    """Width, composition, Unicode white space and case of texts that are not plain ASCII."""
    def fold(v):
        if v is None:
            return None
        narrow = v.translate(_FOLD) if _HAS_WIDE.search(v) else v
        return " ".join(unicodedata.normalize("NFC", narrow).split()).casefold()
    return values.map(fold)


@F.pandas_udf(T.StringType())
def to_ascii_host(values: pd.Series) -> pd.Series:
    """ASCII form of an international host name; null where it has none."""
    def encode(host):
        try:
            return None if host is None else host.encode("idna").decode("ascii")
        except UnicodeError:
            return None
    return values.map(encode)


def fold_width(text: Column) -> Column:
    return F.translate(text, _WIDE, _PLAIN)


def norm_text(text: Column) -> Column:
    """Identity form of a text; null where nothing is left.

    Plain ASCII rows stay inside the JVM; only the others carry their text to the Arrow function.
    """
    plain = F.lower(F.btrim(F.regexp_replace(text, ASCII_SPACE_RUN, " "), F.lit(" ")))
    return F.nullif(F.coalesce(fold_unicode_text(F.when(text.rlike(NON_ASCII), text)), plain), F.lit(""))


def norm_host(host: Column) -> Column:
    """Lower-case ASCII host without a trailing dot; null for one with an empty label or one of over 63 characters."""
    ascii_host = F.when(host.rlike(NON_ASCII), to_ascii_host(F.when(host.rlike(NON_ASCII), host))).otherwise(host)
    clean = F.rtrim(F.lower(ascii_host), F.lit("."))
    return F.when((clean != "") & ~ascii_host.rlike(r"^\.|\.\.|\s|[^.]{64}"), clean)


def norm_domain(text: Column) -> Column:
    """Domain identity; null when the text carries a port, path, user or no dot.  ``www`` is kept."""
    bare = F.regexp_replace(F.trim(text), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//", "")
    host = norm_host(F.regexp_extract(bare, r"^([^/?#@:\s]+)/?$", 1))
    return F.when(host.contains("."), host)


# --- Fixed patterns: secrets and personal data ------------------------------------------------------------
SECRET_KEYS = (r"(?i)(?:api[_-]?key|access[_-]?token|refresh[_-]?token|client[_-]?secret|password|authorization"
               r"|cookie|private[_-]?key|oauth|(?:^|[_-])token(?:$|[_-])|(?:^|[_-])secret(?:$|[_-]))")
PERSONAL_KEYS = (r"(?i)(?:email|e-mail|phone|telephone|mobile|customer[_-]?id|lead[_-]?id|full[_-]?name|raw[_-]?lead"
                 r"|(?:^|[_-])name$)")
SECRET_VALUES = r"(?i)(?:bearer\s+|sk-[A-Za-z0-9]|gh[pousr]_[A-Za-z0-9]|AIza[0-9A-Za-z_-]{20,})"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE = r"\+?\d[\d\s().-]{7,}\d"
HASH_OR_TIME = (r"^(?:[a-f0-9]{40}|[a-f0-9]{64}|\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2}))$")
CREDENTIAL = r"(?i)\b(?:bearer|basic)\s+[A-Za-z0-9._~+/=-]{8,}"


def has_secret(text: Column) -> Column:
    return text.rlike(SECRET_VALUES)


def has_email(text: Column) -> Column:
    return ~text.rlike(HASH_OR_TIME) & text.rlike(EMAIL)


def has_phone(text: Column) -> Column:
    return ~text.rlike(HASH_OR_TIME) & text.rlike(PHONE)


def redact(text: Column) -> Column:
    """A value that carries a bearer or basic credential is replaced as a whole."""
    return F.when(text.rlike(CREDENTIAL), "[REDACTED]").otherwise(text)


def drop_sensitive_keys(values: Column) -> Column:
    """Map without the entries whose key names a secret or personal datum."""
    return F.map_filter(values, lambda key, _: ~key.rlike(SECRET_KEYS))


def formula_safe(cell: Column) -> Column:
    """Quote a cell that a spreadsheet would read as a formula."""
    return F.when(cell.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), cell)).otherwise(cell)

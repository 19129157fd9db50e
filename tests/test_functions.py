import hashlib
import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from sightline.functions import dates, hashing, labels, numbers, text, urls


def values(spark, items, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v string")
    return [r[0] for r in df.select("i", column(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_norm_text(spark):
    samples = ["  Ａｂｃ　Ｄ  e ", "Straße", "Café", "a\t\n b", "   ", None, "ﬁne", "x y"]
    wide = {**{c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}, 0x3000: 0x20}
    want = [None if v is None else " ".join(unicodedata.normalize("NFC", v.translate(wide)).split()).casefold() or None for v in samples]
    assert values(spark, samples, text.norm_text) == want


@pytest.mark.parametrize("raw, want", [
    ("HTTPS://Example.COM:443/A/?utm_source=x&b=1#f", "https://example.com/A/?b=1"),
    ("http://example.com", "http://example.com/"), ("http://example.com:8080/x", "http://example.com:8080/x"),
    ("https://example.com/?UTM%5Fx=1&gclid=2&q=a+b", "https://example.com/?q=a+b"),
    ("https://user:pw@example.com/", None), ("https://example.com/a b", None), ("https://example.com/?email=x", None),
    ("ftp://example.com/", None), ("https://bücher.example/", "https://xn--bcher-kva.example/"), ("https://www.example.com/", "https://www.example.com/"),
    ("https://example.com./", "https://example.com/"), ("https://example.com/?fbclid=1", "https://example.com/"),
])
def test_norm_url(spark, raw, want):
    assert values(spark, [raw], urls.norm_url) == [want]


def test_norm_domain(spark):
    got = values(spark, [" WWW.Example.com. ", "https://example.com/", "example.com/path", "example.com:80", "localhost", "a@b.com", None], text.norm_domain)
    assert got == ["www.example.com", "example.com", None, None, None, None, None]


def test_search_property_and_slashes(spark):
    df = spark.createDataFrame([("https://a.b/", "x"), ("sc-domain:a.b", ""), ("", "https://a.b/"), ("/a.b/", "https://a.b/"), ("a.b", "")], "p string, s string")
    got = [r[0] for r in df.select(urls.search_property(F.col("p"), F.col("s"))).collect()]
    assert got == ["https://a.b/", "sc-domain:a.b", "https://a.b/", "https://a.b/", "sc-domain:a.b"]
    assert values(spark, ["https://a.b//c///d?e=//f"], urls.single_slash_path) == ["https://a.b/c/d?e=//f"]


def test_canonical_hash_agrees_with_json(spark):
    rows = [("a\"b\t鞋", 2.0, None, True), ("", 2.5, 7, False)]
    df = spark.createDataFrame(rows, "s string, d double, n long, b boolean")
    got = [r[0] for r in df.select(hashing.row_hash(df, ["s", "d", "n", "b"])).collect()]

    def fold(v):
        return int(v) if isinstance(v, float) and v.is_integer() else v
    want = [hashlib.sha256(json.dumps([fold(v) for v in r], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest() for r in rows]
    assert got == want
    keyed = {"b": rows[0][3], "s": rows[0][0]}
    want_object = hashlib.sha256(json.dumps(keyed, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert df.select(hashing.row_hash(df, ["s", "b"], as_object=True)).first()[0] == want_object


def test_numbers(spark):
    assert values(spark, ["$1,234.50", "12%", "−3", "n/a", "", "1,23"], numbers.table_number) == [1234.5, 0.12, -3.0, None, None, None]
    got = values(spark, ["1,200", "unavailable", "1.5", "x", "-1", "0"], numbers.count_cell)
    assert [(r.value, r.error) for r in got] == [(1200, None), (None, None), (None, "NOT_A_COUNT"), (None, "NOT_NUMERIC"), (None, "NOT_A_COUNT"), (0, None)]
    row = spark.range(1).select(numbers.change(F.lit(1.0), F.lit(0.0)), numbers.change(F.lit(3.0), F.lit(2.0)), numbers.half_up(F.lit(2.5)),
                                numbers.share_of_range(F.lit(1.0), F.lit(1.0), F.lit(1.0))).first()
    assert tuple(row) == (None, 0.5, 3, 50.0)


def test_dates(spark):
    assert values(spark, ["2024-02-29", "2023-02-29", "2024-2-9", None], lambda c: dates.strict_date(c).cast("string")) == ["2024-02-29", None, None, None]
    stamps = ["2024-01-01T23:30:00Z", "2024-01-01T23:30:00", "2024-01-01T23:30:00+08:00"]
    assert values(spark, stamps, lambda c: dates.reporting_day_of_text(c).cast("string")) == ["2024-01-02", None, "2024-01-01"]
    assert values(spark, ["2024-06", "2024-06-31", "2024-13", "2024-06-30"], lambda c: dates.month_start(c).cast("string")) == ["2024-06-01", None, None, "2024-06-01"]
    assert values(spark, ["2026-06"], lambda c: dates.mature_on(dates.month_start(c)).cast("string")) == ["2026-08-29"]


def test_traction_band_keeps_its_quirks(spark):
    cases = [(0, 5, None, "COMPLETE_WITHIN_SCOPE", 0), (0, 5, None, "PARTIAL", None), (99, 5, 0.1, "COMPLETE_WITHIN_SCOPE", None), (100, 4, None, "x", 4), (100, 3, None, "x", 0),
             (100, 3, 0.1, "x", 3), (100, 3.5, None, "x", 3), (100, 21, None, "x", 2), (100, 41, None, "x", 1), (None, 5, None, "x", None)]
    df = spark.createDataFrame([tuple(None if v is None else (v if isinstance(v, str) else float(v)) for v in c[:4]) for c in cases], "i double, p double, c double, v string")
    assert [r[0] for r in df.select(labels.traction_band(F.col("i"), F.col("p"), F.col("c"), F.col("v"))).collect()] == [c[4] for c in cases]


def test_sensitive_text(spark):
    samples = ["write to a.b@c.io", "call +886 2 1234 5678", "Bearer abcdefgh123", "0" * 64, "2024-01-01T00:00:00Z", "plain"]
    df = spark.createDataFrame([(s,) for s in samples], "v string")
    got = [tuple(r) for r in df.select(text.has_email(F.col("v")), text.has_phone(F.col("v")), text.has_secret(F.col("v"))).collect()]
    assert got == [(True, False, False), (False, True, False), (False, False, True), (False, False, False), (False, False, False), (False, False, False)]
    assert values(spark, ["Authorization: Basic dXNlcjpwdw==", "fine"], text.redact) == ["[REDACTED]", "fine"]


@pytest.mark.parametrize("value, text", [(12345678.5, "12345678.5"), (0.00012, "0.00012"), (1.2e-05, "1.2e-05"), (1e-07, "1e-07"), (5.0, "5"), (-0.5, "-0.5"), (1e16, "10000000000000000"), (-1.5e-10, "-1.5e-10"), (123456789.25, "123456789.25"), (None, "null"), (0.0, "0"), (4e18, "4000000000000000000")])
def test_json_number(spark, value, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(hashing.json_number(F.col("v"))).first()[0] == text

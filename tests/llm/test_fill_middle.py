import hashlib
import random
import re

from helpers import documents
from sightline.llm import fill_middle, queries

FOLDER = "/root/testdata/sf0.001"


def plainly(doc_id, text):
    """n, form, prefix, middle and output by the stated rule, without any list."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_lanes_reach_every_rank():
    rng = random.Random(3)
    for n in (0, 1, 63, 64, 65, 640, 5000):
        singles = fill_middle.SkipList(n)
        assert singles.n == n and [singles.start(r) for r in range(n + 1)] == list(range(n + 1))
        widths = [rng.randrange(1, 9) for _ in range(n)]
        units = fill_middle.SkipList(iter(widths))
        starts = [sum(widths[:r]) for r in range(0, n + 1, max(1, n // 50))]
        assert units.n == n and [units.start(r) for r in range(0, n + 1, max(1, n // 50))] == starts
    assert len(fill_middle.SkipList(1_000_000).lanes) > 3


def test_units_tile_the_text(spark):
    import regex
    pattern = regex.compile(r"\S+")
    for text in ("", "   ", "one", "  one two\nthree  ", "é 漢字 \U0001f600"):
        widths = list(fill_middle.unit_widths(text, pattern))
        assert sum(widths) == len(text) and len(widths) == (max(1, len(text.split())) if text else 0)
    docs = documents(spark, ["alpha beta gamma delta epsilon"] * 50, list(range(50)))
    rows = fill_middle.transform(docs, unit=r"\S+", rate=100).collect()
    assert {r.n for r in rows} == {5} and {r.form for r in rows} == {"psm", "spm"}
    assert all(re.fullmatch(r"(<P>)?(alpha )?(beta )?.*", r.output) and r.prefix_chars in (0, 6, 11, 17, 23, 30) for r in rows)


def test_whole_table_by_the_rule(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_fill_middle"](spark, FOLDER).collect()
    assert len(rows) == len(texts) and {r.form for r in rows} == {"plain", "psm", "spm"}
    for r in rows:
        n, form, a, m, output = plainly(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (n, form, a, m, sha(output))
        assert r.restored_sha256 == sha(texts[r.doc_id] or "")


def test_nulls_marks_long_texts_repeats_and_empty(spark):
    from pyspark.sql import functions as F
    texts = [None, "", "a<P>b", "<S>", "x<M", "<P", "S>", "é\U0001f600漢" * 40_000, "same", "same", "no id", "<<S"]
    ids = [*range(10), None, 11]
    docs = documents(spark, texts, ids).withColumn("output", F.lit("old")).withColumn("form", F.lit(1))
    for shift in range(0, 60, 12):
        keyed = docs.withColumn("doc_id", F.col("doc_id") + shift)
        out = fill_middle.transform(keyed)
        assert "_fim_h1" not in out.columns and sorted(out.columns) == sorted({*docs.columns, "n", "prefix_chars", "middle_chars"})
        got = out.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
        assert len(got) == len(texts)
        for r in got:
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plainly(r.doc_id, r.text) and r.back == r.text
    assert fill_middle.transform(documents(spark, [])).count() == 0

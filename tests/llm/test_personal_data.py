import hashlib
import random
import re
from collections import Counter

from helpers import documents
from sightline.llm import personal_data, queries

FOLDER = "/root/testdata/sf0.01"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def checksum(digits):
    return sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_of(text):
    found = []
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and checksum(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                found.append((m.start(), no, m.end(), kind))
    return sorted(found)


def check(row, text):
    base = base_of(text)
    counts = Counter(kind for *_, kind in base)
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(counts[k] for k in PATTERNS), (row, base)
    names = [f"{kind}:{a}:{b}" for a, _, b, kind in base]
    assert row.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
    spans = row.spans.split(",") if row.spans else []
    assert [s for s in spans if s in set(names)] == names
    return [s for s in spans if s not in set(names)]


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_personal_data"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    added = [s for r in rows for s in check(r, texts[r.doc_id])]
    assert len(added) <= 0.01 * len(rows)


def test_plan_has_no_python(spark):
    plan = queries.QUERIES["op9_personal_data"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_strict_patterns_on_random_texts(spark):
    rng = random.Random(9)
    letters = "0123456789012345.@+- ()ab%_é\U0001f600\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(90))) for _ in range(1500)]
    texts += ["1.2.3.4.5.6.7.8", "a@b.c%d@e.f", "x@y.z@w.v", "a@@b.c", "256.1.1.1", "0000255.1.1.1", "4111 1111 1111 1111", "+1 (336) 555-3810", "4111-1111-1111-1111 5", "é+44 20 7946 0958x"]
    texts += [None, "", "7" * 50_000, "1 " * 50_000, "a." * 50_000 + "@x.y", "+" + "1-" * 30_000 + "x"]
    rows = personal_data.summary(personal_data.personal_spans(documents(spark, texts)))
    got = {r.doc_id: r for r in rows.collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        check(got[k], text)


def test_looser_forms_are_added_and_prose_is_not(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("aeinrst") for _ in range(rng.randrange(3, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts = [f"{prose(9)} {word()}.{rng.randrange(99)}@{word()}.example.com {prose(5)}" for _ in range(150)]
    texts += [f"{prose(5)} at {prose(4)}. {prose(3)} {rng.randrange(10 ** 15, 10 ** 16 - 1)} {prose(4)}" for _ in range(150)]
    loose = [f"{prose(6)} {word()}.{rng.randrange(99)} (at) {word()}.example.com {prose(4)}" for _ in range(10)]
    rows = {r.doc_id: r for r in personal_data.summary(personal_data.personal_spans(documents(spark, texts + loose))).collect()}
    added = {k: check(rows[k], t) for k, t in enumerate(texts + loose)}
    assert sum(any(s.startswith("email") for s in added[k]) for k in range(300, 310)) >= 8
    assert not any(added[k] for k in range(150)) and sum(bool(added[k]) for k in range(150, 300)) <= 3


def test_all_spans_are_learned_from(spark):
    """Every base span, its looser forms and every proposal count, however many there are."""
    base = personal_data.placed(personal_data.found(documents(spark, [f"x a{k}@b.example y" for k in range(2000)] + ["at 1 . 2 . 3 . 4"] * 1800)).where("kind IS NOT NULL"))
    spans = personal_data.described(base).selectExpr("*", "wide AND kind = 'email' AS touched").where("wide OR valid")
    sums = {r.label: r.n for r in personal_data.counted(spans).groupBy("label").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n").collect()}
    assert sums[1.0] == 2000 * 4 and sums[0.0] >= 1800


def test_repeats_nulls_and_empty(spark):
    docs = documents(spark, ["a@b.c"] * 2 + [None, "x"], [1, 1, None, None])
    rows = personal_data.summary(personal_data.personal_spans(docs)).collect()
    assert sorted((str(r.doc_id), r.spans) for r in rows) == [("1", "email:0:5"), ("1", "email:0:5"), ("None", ""), ("None", "")]
    assert personal_data.personal_spans(documents(spark, [])).count() == 0

import random
import zlib
from base64 import b64encode

from helpers import documents
from sightline.llm import language_id, queries

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op4_language_id"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    for side in (True, False):
        some = [r for r in rows if r.held_out == side]
        assert sum(r.lang_pred == docs[r.doc_id].lang for r in some) >= 0.98 * len(some)
    assert sum(r.rejected for r in rows) <= 0.002 * len(rows)


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(300)
    from pyspark.sql import functions as F
    wrong = docs.withColumn("lang", F.when(language_id.held_out(), "xx").otherwise(F.col("lang")))
    rows = [sorted(map(tuple, language_id.identify(d).collect())) for d in (docs, wrong)]
    assert rows[0] == rows[1]


def test_unseen_languages_and_scripts_are_rejected(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language_id.fit(docs.where(~language_id.held_out()))
    rng = random.Random(1)
    finnish = "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä "
    russian = "все люди рождаются свободными и равными в своем достоинстве и правах они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства "
    chinese = "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待" * 6
    letters = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(50))
    base64 = b64encode(rng.randbytes(200)).decode()
    texts = [finnish * 2, russian * 2, chinese, letters, base64]
    assert model.predict(texts)[2].tolist() == [True] * 5
    assert (model.least[8:] >= 0.1).all() and (model.least[1:] >= model.least[:-1]).all()


def texts_of(spark):
    en, de = "the and with that thing from there ", "der und nicht eine schule straße größer "
    texts = [(en * (k % 7 + 1), "en") for k in range(40)] + [(de * (k % 7 + 1), "de") for k in range(40)]
    odd = [(None, "en"), ("", None), ("12 34 !?", "de"), ("щука привет мир как дела " * 5, None), ("The thing", "en"), ("und " * 50_000, None), ("x\ny", "en")]
    return [t for t, _ in texts + odd], [lang for _, lang in texts + odd]


def test_odd_texts(spark):
    texts, langs = texts_of(spark)
    docs = documents(spark, texts, langs=langs)
    rows = {r.doc_id: r for r in language_id.identify(docs).collect()}
    n = 80
    assert all((rows[k].lang_pred, rows[k].score, rows[k].rejected) == ("und", 0.0, True) for k in (n, n + 1, n + 2))
    assert rows[n + 3].rejected and rows[n + 3].lang_pred in ("en", "de")
    assert (rows[n + 4].lang_pred, rows[n + 4].rejected, rows[n + 5].lang_pred) == ("en", False, "de")
    kept = language_id.drop_rejected(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {*range(80), n + 4}
    assert not {r.doc_id for r in kept.collect()} & {n, n + 1, n + 2, n + 3}


def test_nothing_to_learn_from_and_null_ids(spark):
    docs = documents(spark, ["the thing", "the thing", None], [1, 1, None], [None, None, None])
    rows = language_id.identify(docs).collect()
    assert sorted((str(r.doc_id), r.lang_pred, r.held_out) for r in rows) == [("1", "und", rows[0].held_out)] * 2 + [("None", "und", False)]
    assert language_id.identify(documents(spark, [])).count() == 0

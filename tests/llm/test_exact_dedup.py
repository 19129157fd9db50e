import hashlib
import re

from helpers import SPACE, documents
from sightline.llm import exact_dedup, queries

from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


def test_matches_sql(spark):
    name = "op2_exact_dedup"
    assert compare(connect(FOLDER), queries.QUERIES[name](spark, FOLDER), queries.ORACLES[name]) is None


def test_groups_with_nulls_repeats_and_long_texts(spark):
    long = "word " * 60_000
    texts = ["a  b", "a\tb", " a b", None, "", "a b", long, long + "x", long, "a\xa0b", "\n \t", " ", "a b"]
    ids = [9, 4, 7, 3, 2, 4, 20, 21, 22, 30, 41, 40, None]
    want = {}
    for i, t in zip(ids, texts):
        want.setdefault(re.sub(SPACE, " ", t or ""), []).append(i)
    rows = exact_dedup.exact_groups(documents(spark, texts, ids), hash_all=True).collect()
    assert len(rows) == len(texts)
    by_hash = {hashlib.sha256(t.encode()).digest(): members for t, members in want.items()}
    for r in rows:
        members = by_hash[bytes(r.full_hash)]
        keep = min(i for i in members if i is not None)
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(members), r.doc_id == keep)


def test_full_hash_only_of_survivors(spark):
    rows = exact_dedup.exact_groups(documents(spark, ["one", "two three", "one"])).collect()
    assert {r.doc_id: r.full_hash is None for r in rows} == {0: False, 1: True, 2: False}


def test_drop_copies(spark):
    docs = documents(spark, ["a b", "a  b", "c", "c", "a b", "d", None, ""], [5, 6, 7, 7, 1, None, 8, 9])
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, "a b"), (7, "c"), (None, "d"), (8, None)], key=str)


def test_same_id_with_a_copied_text(spark):
    kept = exact_dedup.drop_copies(documents(spark, ["x y", "z", "z"], [5, 5, 3]))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, "z"), (5, "x y")]


def test_empty(spark):
    docs = documents(spark, [])
    assert exact_dedup.exact_groups(docs).count() == 0 and exact_dedup.drop_copies(docs).count() == 0

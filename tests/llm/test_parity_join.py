import random

import numpy as np
import pyarrow as pa
from helpers import classes, documents, shingle_set, words
from pyspark.sql import functions as F

from sightline.llm import parity_join, shingles

FOLDER = "/root/testdata/sf0.001"


def edited(rng, text, share):
    found = text.split()
    for k in range(len(found)):
        if rng.random() < share:
            found[k] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(found)


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_shingles_are_sets_of_word_runs():
    texts = ["A b\tc  d e f", "", "one two", " x ", "É é e E é É", "a b c d e a b c d e a"]
    found, first = shingles.shingles(pa.array(texts))
    assert [len(np.unique(found[a:b])) for a, b in zip(first, first[1:])] == [len(shingle_set(t)) for t in texts]
    sliced, at = shingles.shingles(pa.array(["zzz", *texts]).slice(1))
    assert (sliced == found).all() and (at == first).all()


def test_sketch_distance_is_at_most_the_difference():
    rng = random.Random(1)
    for size in (3, 40, 700, 5000):
        base = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(size))
        a, b = (np.unique(shingles.shingles(pa.array([t]))[0]) for t in (base, edited(rng, base, 0.03)))
        x, y = parity_join.sketch_of(a), parity_join.sketch_of(b)
        assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= len(np.setxor1d(a, b))


def test_linked_sets_share_a_key():
    rng = random.Random(2)
    for size in (5, 6, 9, 14, 30, 60, 130, 260, 900, 4000):
        for _ in range(40):
            base = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(size))
            other = edited(rng, base, 0.03) if rng.random() < 0.5 else " ".join(base.split()[:max(1, int(size * 0.8))])
            a, b = (np.unique(shingles.shingles(pa.array([t]))[0]) for t in (base, other))
            common = len(np.intersect1d(a, b))
            if 100 * common >= 75 * (len(a) + len(b) - common):
                keys = [set(np.concatenate([parity_join.band_keys(s, band, (75, 100)) for band in parity_join.bands_of(len(s), (75, 100))]).tolist()) for s in (a, b)]
                assert keys[0] & keys[1]


def test_whole_table_against_all_pairs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert result(parity_join.near_groups(docs)) == classes(texts)


def test_hot_groups_passages_and_odd_rows(spark):
    rng = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(60))
    base = " ".join(f"b{k}" for k in range(150))
    fresh = lambda n: " ".join(f"f{rng.randrange(10 ** 7)}" for _ in range(n))
    texts = [edited(rng, base, rng.choice([0.0, 0.01, 0.02, 0.04])) for _ in range(90)]           # a large group of near copies
    texts += [f"{fresh(60)} {passage} {fresh(30)}" for _ in range(80)]                            # unlike texts that share a passage
    texts += [f"{passage} {fresh(6)}" for _ in range(30)] + [f"{passage} {fresh(25)}" for _ in range(30)]
    chain = [f"c{k}" for k in range(40)]
    texts += [" ".join(chain[k:k + 32]) for k in range(8)]                                        # linked only step by step
    texts += [None, "", " \t\n", "one", "one", "ONE", "two words", "Two  words", fresh(3000)] + ["same text of six words here"] * 20
    texts += [texts[-21] + " more"]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    got = result(parity_join.near_groups(documents(spark, texts, ids).repartition(5)))
    assert got == classes(dict(zip(ids, texts)))


def test_documents_that_extend_a_text_with_many_near_copies(spark):
    rng = random.Random(4)
    texts = []
    for size, longest in ((376, 500), (760, 1010), (1520, 2020)):                                 # just below a power of two
        base = [f"t{size}x{k}" for k in range(size + 4)]
        texts += [" ".join(base)] + [edited(rng, " ".join(base), rng.choice([0.003, 0.01])) for _ in range(60)]
        low = longest - longest // 50
        for k in range(6):
            more = rng.randrange(low, longest + 1) - size
            texts.append(" ".join(base + [f"e{size}x{k}x{j}" for j in range(more)]))
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    assert result(parity_join.near_groups(documents(spark, texts, ids))) == classes(dict(zip(ids, texts)))


def test_drop_near_keeps_one_of_each_group_and_rows_without_id(spark):
    base = " ".join(f"b{k}" for k in range(100))
    docs = documents(spark, [base, base + " x", "other", None, "", base], [4, 3, 9, 7, 8, None])
    kept = parity_join.drop_near(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 9, 7, 8, None], key=str)


def test_repeated_rows_and_empty_table(spark):
    rows = parity_join.near_groups(documents(spark, ["a b c d e f"] * 3 + ["q r s"], [5, 5, 6, 5])).collect()
    assert sorted((r.doc_id, r.n_shingles) for r in rows) == [(5, 1), (5, 2), (5, 2), (6, 2)] and {r.component_id for r in rows} == {5}
    assert parity_join.near_groups(documents(spark, [])).count() == 0
    assert words("A\x0bB") == ["a", "b"]


def test_no_group_that_a_linked_pair_needs_is_left():
    """Linked pairs share at least as many groups as either of them counts on, and none leaves as many as that."""
    rng = np.random.default_rng(5)
    counted = 0
    for size in (1, 2, 3, 5, 8, 13, 21, 40, 60, 63, 64, 100, 127, 200, 400):
        for _ in range(40):
            base = np.unique(rng.integers(0, 2 ** 63, size).astype(np.uint64))
            # the largest difference at which a set made of part of the other, or of part and as much new, is still linked
            gone = rng.integers(0, len(base) // 4 + 1)
            new = rng.integers(0, 2 ** 63, max(0, (len(base) - gone) * 100 // 75 - len(base))).astype(np.uint64)
            other = np.unique(np.concatenate([base[gone:], new]))
            if not set(parity_join.bands_of(len(base), (75, 100))) & set(parity_join.bands_of(len(other), (75, 100))):
                continue
            band = max(len(base).bit_length(), len(other).bit_length()) - 1
            (a, x), (b, y) = (parity_join.keys_and_sure(s, band, (75, 100)) for s in (base, other))
            assert len(np.intersect1d(a, b)) >= max(x, y)
            counted += max(x, y) > parity_join.SPARE
    assert counted > 100


def test_long_sets_leave_no_group_without_a_sure_other(spark):
    """Sets of more than 64 blocks can share few groups with a linked one: they count on none and so leave none."""
    rng = np.random.default_rng(6)
    sure = [parity_join.keys_and_sure(np.unique(rng.integers(0, 2 ** 63, 250).astype(np.uint64)), 7, (75, 100))[1] for _ in range(50)]
    assert max(sure) == 0
    rows = parity_join.profiles(documents(spark, [" ".join(f"w{k}" for k in range(254)), "one two"]), (75, 100)).collect()
    assert sorted(tuple(r.sure) for r in rows)[0][0] == 0 and all(len(r.sure) in (1, 2) for r in rows)


def test_unlike_long_texts_that_share_a_passage_are_not_fetched(spark):
    """Of pairs of long sets the wide sketch lets every linked one pass, across bands too, and no unlike one."""
    rng = random.Random(7)
    fresh = lambda n: [f"f{rng.randrange(10 ** 9)}" for _ in range(n)]
    passage, texts, linked = fresh(80), [], []
    for size in (1030, 1500, 1900, 2040, 2600, 4090, 7000):
        base = fresh(size)
        texts += [base, base[:-size // 50] + fresh(size // 50), base + fresh(size // 4), fresh(size // 2) + passage + fresh(size // 2), fresh(size // 2) + passage + fresh(size // 2)]
        linked += [(len(texts) - 5, len(texts) - 4), (len(texts) - 5, len(texts) - 3), (len(texts) - 4, len(texts) - 3)]
    texts = [" ".join(t) for t in texts]
    sets = [shingle_set(t) for t in texts]
    nodes = parity_join.profiles(documents(spark, texts), (75, 100)).localCheckpoint()
    side = lambda x: parity_join.side(nodes, x)
    pairs = side("a").join(side("b"), F.expr("a_doc < b_doc")).where(parity_join.may_link((75, 100)))
    some = {(r.a_doc, r.b_doc) for r in pairs.collect()}
    left = {(r.a_doc, r.b_doc) for r in parity_join.likely(pairs, nodes, (75, 100)).collect()}
    near = {(i, j) for i, j in some if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert near == set(linked) and near <= left
    assert len(some - near) > 10 and all(len(sets[i] & sets[j]) >= 0.6 * len(sets[i] | sets[j]) for i, j in left)
    assert result(parity_join.near_groups(documents(spark, texts))) == classes(dict(enumerate(texts)))


def test_a_wide_sketch_folds_to_narrower_ones():
    found = np.random.default_rng(8).integers(0, 2 ** 63, 3000).astype(np.uint64)
    wide = parity_join.wide_sketch(found)
    assert len(wide) == 64 and parity_join.wide_sketch(found[:1023]) is None
    while len(wide) > parity_join.SKETCH_WORDS:
        half = len(wide) // 2
        wide = wide[:half] ^ wide[half:]
        assert (wide == parity_join.sketch_of(found, half)).all()

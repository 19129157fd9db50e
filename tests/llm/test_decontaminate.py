import random
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import documents, words
from sightline.llm import decontaminate

FOLDER = "/root/testdata/sf0.01"


def expected(docs, items, width=5):
    """(doc, item) -> (similarity, first best start, words), every window of every pair that shares a shingle."""
    grams = lambda w, k: [tuple(w[j:j + k]) for j in range(len(w) - k + 1)]
    out = {}
    for item, text in items:
        own = words(text)
        if not own:
            continue
        k = min(width, len(own))
        want = Counter(grams(own, k))
        for doc, body in docs:
            found = words(body)
            if not set(want) & set(grams(found, k)):
                continue
            best = (0.0, 0, 0)
            for start in range(max(len(found) - len(own), 0) + 1):
                window = Counter(grams(found[start:start + len(own)], k))
                alike = sum((window & want).values()) / sum((window | want).values())
                if alike > best[0]:
                    best = (alike, start, min(len(own), len(found)))
            if best[0] >= 0.75:
                out[doc, item] = best
    return out


def result(df):
    return {(r.doc_id, r.item_id): (r.similarity, r.start_word, r.n_words) for r in df.collect()}


def test_whole_tables(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    want = expected([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert len(want) > 10 and result(decontaminate.leaks(docs, items)) == want
    kept = {r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - {d for d, _ in want}


def test_edited_passages_short_items_and_odd_rows(spark, monkeypatch):
    rng = random.Random(6)
    fresh = lambda n: [f"f{rng.randrange(10 ** 7)}" for _ in range(n)]
    items = [(k, " ".join(fresh(rng.randrange(15, 60)))) for k in range(12)] + [(12, "tiny item"), (13, "Four words stand here"), (14, None), (15, ""), (16, " ".join(["rep"] * 20))]
    docs = []
    for k in range(120):
        body = fresh(rng.randrange(0, 80))
        own = (items[rng.randrange(14)][1]).split()
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(len(own))] = "edit"
        if rng.random() < 0.3 and len(own) > 8:
            del own[rng.randrange(len(own))]
        docs.append((k, " ".join([*body, *own, *fresh(rng.randrange(30))]).upper()))
    docs += [(200, None), (201, ""), (202, "tiny  ITEM"), (203, " ".join(["rep"] * 40)), (204, "word " * 100_000 + items[0][1]), (205, items[1][1][:-1])]
    table = documents(spark, [t for _, t in docs], [i for i, _ in docs])
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    want = expected(docs, items)
    assert len(want) > 40 and result(decontaminate.leaks(table, bench)) == want
    monkeypatch.setattr(decontaminate, "ITEMS", 5)  # several blocks of items
    assert result(decontaminate.leaks(table, bench)) == want
    kept = decontaminate.drop_leaks(table, bench)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in docs} - {d for d, _ in want}


def test_lookup_finds_all_fingerprints_within_the_radius():
    rng = np.random.default_rng(7)
    items = decontaminate.Items(list(range(50)), [" ".join(map(str, rng.integers(0, 10 ** 9, 20))) for _ in range(50)])
    windows = items.prints[rng.integers(0, 50, 200)].copy()
    for row in windows:
        flips = rng.choice(windows.shape[1], rng.integers(0, 110), replace=False)
        row[flips] ^= True
    apart = (windows[:, None] != items.prints[None]).sum(2)
    assert set(items.near(windows)) == set(map(tuple, np.argwhere(apart <= decontaminate.RADIUS).tolist()))


def test_fingerprints_of_similar_windows_lie_within_the_radius():
    rng = np.random.default_rng(8)
    far = 0
    for _ in range(300):
        n = int(rng.integers(11, 60))
        one = rng.integers(0, 2 ** 63, n).astype(np.uint64)
        two = one.copy()
        two[:n // 7] = rng.integers(0, 2 ** 63, n // 7).astype(np.uint64)
        if decontaminate.similarity(one, two) >= 0.75:
            prints = [decontaminate.fingerprints(decontaminate.bit_votes(x), n)[0] for x in (one, two)]
            far += (prints[0] != prints[1]).sum() > decontaminate.RADIUS
    assert far == 0


def test_empty_tables_and_repeats(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h")], "item_id long, text string")
    docs = documents(spark, ["x a b c d e f g h"] * 2, [3, 3])
    assert [tuple(r) for r in decontaminate.leaks(docs, bench).collect()] == [(3, 1, 1, 8, 1.0)] * 2
    assert decontaminate.leaks(docs.where("false"), bench).count() == 0
    assert decontaminate.leaks(docs, bench.where("false")).count() == 0
    assert decontaminate.drop_leaks(docs, bench.where("false")).count() == 2
    assert pa.array(["a"]).type == pa.string()


def test_items_without_id_are_searched_for(spark):
    bench = spark.createDataFrame([(None, "a b c d e f g h"), (2, None)], "item_id long, text string")
    docs = documents(spark, ["x a b c d e f g h", "quite other words than those of the item"], [3, 4])
    assert [tuple(r) for r in decontaminate.leaks(docs, bench).collect()] == [(3, None, 1, 8, 1.0)]
    assert [r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect()] == [4]

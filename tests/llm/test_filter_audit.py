import re
from collections import Counter
from itertools import permutations

from helpers import SPACE, documents
from sightline.llm import filter_audit, queries

FIELDS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def failing(rows):
    """Failed filters of each (doc_id, text, source), by comparing all texts."""
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = [w for w in re.split(SPACE, text) if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                 "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in rows)}
        out.append({f for f, bad in fails.items() if bad})
    return out


def slowly(rows, labels):
    """Every order run over the documents one by one."""
    fails, found, shapley = failing(rows), {}, Counter()
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    for part in {s or "" for _, _, s in rows}:
        docs = [(i, bad) for (i, _, s), bad in zip(rows, fails) if (s or "") == part]
        for order in permutations("ABCDE"):
            alive = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in alive if f in d[1]]
                alive = [d for d in alive if f not in d[1]]
                shapley[part, f] += len(gone)
                found[part, "".join(order), step] = [len(alive), len(gone), sum(f in b for _, b in docs) - len(gone), sum(b == {f} for _, b in docs),
                                                     sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
    return {key: [*v, shapley[key[0], key[1][key[2] - 1]]] for key, v in found.items()}


def same(df, rows, labels):
    want, got = slowly(rows, labels), df.collect()
    assert len(got) == len(want)
    for r in got:
        assert [r[f] for f in (*FIELDS, "shapley")] == want[r.part, r.filter_order, r.step], r


def test_path_counts_are_the_orders():
    forward, backward = filter_audit.path_counts(5)
    assert forward[0] == backward[31] == 1 and forward[31] == backward[0] == 120
    assert forward[0b00111] == 6 and backward[0b00111] == 2


def test_small_table_by_running_every_order(spark):
    many = " ".join(f"w{k}" for k in range(250))
    texts = [None, "", "x $", many, many, many + " #", "HELLO " * 250, "a b " * 150, many.upper(), many, "UPPER case", "y" * 200_000, many + "\x0b\x1c\x85é", ""]
    ids = [9, 8, 7, 20, 6, 5, 4, 3, 2, 6, 1, 0, 30, None]
    docs = documents(spark, texts, ids, extra=True).selectExpr("*", "'q' AS quality", "'f' AS fails", "'p' AS part", "1 AS n").drop("source")
    docs = docs.withColumn("source", __import__("pyspark").sql.functions.expr("CASE WHEN doc_id % 3 = 0 THEN 'one' WHEN doc_id % 3 = 1 THEN 'two' END"))
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    labels = [(9, 1, 0), (8, 0, 1), (20, 1, 1), (6, None, 1), (6, 1, None), (4, 1, 0), (None, 1, 1), (77, 1, 1)]
    table = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, part string")
    same(filter_audit.audit(docs, table), rows, labels)
    same(filter_audit.audit(docs.repartition(7), table.where("false")), rows, [])
    assert filter_audit.audit(docs.where("false"), table).count() == 0


def test_whole_table_by_running_every_order(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    same(queries.QUERIES["op11_filter_audit"](spark, folder), rows, labels)

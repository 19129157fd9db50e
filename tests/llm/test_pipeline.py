import re

import tiktoken
from helpers import SPACE, classes
from test_decontaminate import expected

import __spark_entry__ as entry
import corpus_pipeline
from sightline.llm import byte_bpe, language_id

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark):
    docs = corpus_pipeline.table(spark, FOLDER, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    columns, kept = docs.columns, set(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        if name == "language_id":
            want = {r.doc_id for r in language_id.identify(docs).collect() if not r.rejected}
            assert len(want) >= 0.98 * len(rows)
        elif name == "exact_dedup":
            first = {}
            for i in sorted(kept):
                first.setdefault(re.sub(SPACE, " ", rows[i].text or ""), i)
            want = set(first.values())
        elif name == "ngram_jaccard":
            want = {i for i, (_, root) in classes({i: rows[i].text for i in kept}).items() if i == root}
        else:
            items = [(r.item_id, r.text) for r in corpus_pipeline.table(spark, FOLDER, "benchmark").collect()]
            want = kept - {d for d, _ in expected([(i, rows[i].text) for i in kept], items)}
        docs = corpus_pipeline.settle(stage(spark, docs, FOLDER))
        found = docs.collect()
        assert docs.columns == columns and all(r == rows[r.doc_id] for r in found)
        kept = {r.doc_id for r in found}
        assert kept == want and len(found) == len(kept), name
    ranks = byte_bpe.Ranks(corpus_pipeline.TOKENIZER, corpus_pipeline.PATTERN)
    other = tiktoken.Encoding("own", pat_str=corpus_pipeline.PATTERN, mergeable_ranks=ranks.ids, special_tokens={})
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in last} == kept
    for r in last:
        assert r.decodes and r.n_tokens == len(r.ids) and r.ids == other.encode_ordinary(rows[r.doc_id].text or "")


def test_registered_and_whole(spark):
    queries = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} == {re.match(r"op\d+", q)[0] for q in queries if re.match(r"op\d+_", q)}
    assert 0 < queries["pipeline"](spark, FOLDER).count() < 200


def test_python_stages_take_bounded_batches(spark):
    """A Python worker is handed a few MB at once, however long the documents are."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    def batch_sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["size"])

    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    small = corpus_pipeline.table(spark, FOLDER, "documents").limit(5)
    long = spark.range(0, 64, 1, 1).select("id", F.repeat(F.lit("long text "), 40_000).alias("text"))
    for name, stage in corpus_pipeline.STAGES:
        if name == "exact_dedup":
            continue
        spark.conf.unset(bound)
        stage(spark, small, FOLDER)
        sizes = long.mapInArrow(batch_sizes, "size long").collect()
        assert sum(r.size for r in sizes) >= 64 * 400_000 and max(r.size for r in sizes) < 4 << 20, name
    spark.conf.unset(bound)

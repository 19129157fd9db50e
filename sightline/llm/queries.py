"""The corpus operators over the whole given tables, with production parameters."""

import public_tokenizers
from pyspark.sql import functions as F

from sightline.llm import (byte_bpe, decontaminate, exact_dedup, fill_middle, filter_audit, html_text, language_id, licences, parity_join, personal_data,
                           posting_lists, sharding, warc)
from sightline.llm.common import digest_text, table

TOKENIZER, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_warc(spark, folder):
    """Every page written to archives and read back."""
    return warc.round_trip(table(spark, folder, "pages"))


def op2_exact_dedup(spark, folder):
    groups = exact_dedup.exact_groups(table(spark, folder, "documents"), hash_all=True)
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("full_hash")).alias("text_sha256"))


def op3_html_text(spark, folder):
    return html_text.page_texts(table(spark, folder, "pages"))


def op4_language_id(spark, folder):
    return language_id.identify(table(spark, folder, "documents"))


def op5_ngram_jaccard(spark, folder):
    return parity_join.near_groups(table(spark, folder, "documents"))


def op6_licences(spark, folder):
    return licences.scan(table(spark, folder, "documents"))


def op7_decontamination(spark, folder):
    """Documents that hold a passage of the benchmark, by item."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_sharding(spark, folder):
    return sharding.shard_documents(table(spark, folder, "documents"))


def op9_personal_data(spark, folder):
    return personal_data.summary(personal_data.personal_spans(table(spark, folder, "documents")))


def op10_byte_bpe(spark, folder):
    """Ids and the bytes they stand for, as counts and digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    both = byte_bpe.encode(docs, TOKENIZER, PATTERN, decoded="decoded")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.encode(F.array_join(F.col("ids").cast("array<string>"), ","), "UTF-8"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_filter_audit(spark, folder):
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_nearest(spark, folder):
    return posting_lists.nearest(table(spark, folder, "embeddings"))


def op13_fill_middle(spark, folder):
    """Forms and digests of the outputs and of the texts rebuilt from them."""
    rows = fill_middle.transform(table(spark, folder, "documents").select("doc_id", "text"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest_text(F.col("output")).alias("output_sha256"), digest_text(back).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_exact_dedup, op3_html_text, op4_language_id, op5_ngram_jaccard, op6_licences, op7_decontamination, op8_sharding, op9_personal_data, op10_byte_bpe,
                                   op11_filter_audit, op12_nearest, op13_fill_middle)}
ORACLES = {
    "op6_licences": licences.scan_sql(),
    "op2_exact_dedup": r"""
        WITH folded AS (SELECT doc_id, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, MIN(doc_id) OVER (PARTITION BY t) AS keep_id, COUNT(*) OVER (PARTITION BY t) AS group_size,
               doc_id = MIN(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM folded""",
    "op11_filter_audit": r"""
        WITH texts AS (
            SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS t, MIN(doc_id) OVER (PARTITION BY COALESCE(text, '')) AS least,
                   regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        flags AS (
            SELECT part, doc_id, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS fails FROM texts),
        known AS (SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
        counted AS (
            SELECT part, fails, COUNT(*) AS n, SUM(COALESCE(good, 0)) AS good, SUM(COALESCE(toxic, 0)) AS toxic
            FROM flags LEFT JOIN known USING (doc_id) GROUP BY part, fails),
        letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, bit)),
        orders AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
            WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
        steps AS (
            SELECT o.filter_order, s.step, l.bit, (SELECT COALESCE(SUM(x.bit), 0) FROM letters x WHERE INSTR(o.filter_order, x.f) < s.step)::BIGINT AS before
            FROM orders o, (SELECT UNNEST(RANGE(1, 6)) AS step) s, letters l WHERE l.f = SUBSTR(o.filter_order, s.step, 1)),
        counts AS (
            SELECT part, filter_order, step, bit, SUM(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
                   SUM(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
                   SUM(CASE WHEN fails & before > 0 AND fails & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
                   SUM(CASE WHEN fails = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
                   SUM(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
                   SUM(CASE WHEN fails & before = 0 AND fails & bit > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
            FROM counted, steps GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (SUM(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
        FROM counts""",
    "op13_fill_middle": r"""
        WITH drawn AS (
            SELECT doc_id, COALESCE(text, '') AS t, length(COALESCE(text, '')) AS n, sha256('1:' || doc_id) AS h FROM documents),
        cuts AS (
            SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS c1, ('0x' || h[9:16])::BIGINT % (n + 1) AS c2,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
                        WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
        parts AS (
            SELECT *, substr(t, 1, LEAST(c1, c2)) AS p, substr(t, LEAST(c1, c2) + 1, ABS(c1 - c2)) AS m, substr(t, GREATEST(c1, c2) + 1) AS s FROM cuts)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN LEAST(c1, c2) END AS prefix_chars, CASE WHEN form <> 'plain' THEN ABS(c1 - c2) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts""",
}

from helpers import documents
from sightline.llm import licences, queries

from oracle import compare, connect

FOLDER = "/root/testdata/sf0.01"
S = licences.SENTENCES


def found(spark, texts, ids=None):
    return sorted(((r.doc_id, r.rule, r.first_sentence, r.last_sentence) for r in licences.scan(documents(spark, texts, ids)).collect()), key=str)


def test_matches_sql(spark):
    assert compare(connect(FOLDER), queries.QUERIES["op6_licences"](spark, FOLDER), queries.ORACLES["op6_licences"]) is None


def test_every_rule_and_only_in_order(spark):
    texts = [" Other words here. ".join(S[name] + "." for name in names) for _, names in licences.RULES.values()]
    assert [(k, rule) for k, rule, _, _ in found(spark, texts)] == list(enumerate(licences.RULES))
    assert found(spark, [f"{S['mit-notice']}. {S['mit-permission']}", S["mit-permission"], f"{S['apache-grant']}. {S['apache-as-is']}."]) == []


def test_wrapped_sentences(spark):
    text = "Junk | without an end\n#\n# " + S["apache-grant"].replace(", V", ",\n#   V").replace("; you", ";\n# you") + ".\n#\n# " + S["apache-copy"] + "\n#\n#  x\n#\n# " + S["apache-as-is"].replace(" or ", " or\n# ")
    assert [r[:3] for r in found(spark, [text])] == [(0, "apache-in-full", 2)]


def test_case_punctuation_repeats_and_place(spark):
    text = "Intro text.\n  RELEASED under the *MIT* license!\nOther. Released under the MIT License."
    assert found(spark, [text]) == [(0, "mit-by-reference", 1, 1), (0, "mit-by-reference", 3, 3)]
    assert found(spark, ["He said it was released under the MIT License today."]) == []


def test_nulls_repeats_long_and_empty(spark):
    line = "Licensed under CC BY-NC 4.0."
    assert found(spark, [None, "", line, line, "word " * 100_000 + ". " + line, line], [1, 2, 3, 3, 4, None]) == sorted(
        [(3, "by-nc-by-reference", 0, 0)] * 2 + [(4, "by-nc-by-reference", 1, 1), (None, "by-nc-by-reference", 0, 0)], key=str)
    assert found(spark, []) == []

import random

import public_tokenizers
import tiktoken
from helpers import documents
from sightline.llm import byte_bpe, queries

PATH, PATTERN = queries.TOKENIZER, queries.PATTERN
FOLDER = "/root/testdata/sf0.001"


def encoding():
    ranks = byte_bpe.Ranks(PATH, PATTERN)
    return ranks, tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks.ids, special_tokens={})


def test_as_tiktoken_on_random_texts():
    ranks, other = encoding()
    encoder, rng = byte_bpe.Encoder(ranks), random.Random(4)
    letters = "ab  \n\t\x1c\x85\xa0 　é!'s9ñ٣\U0001f600漢字the"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts += ["x" * 5000, "ab" * 3000 + " c", "<|endoftext|>", "", " ", "  a", "a ", "don't 'll  x's", "a \n b"]
    import numpy as np
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == other.encode_ordinary(text), text


def test_short_and_long_merges_agree():
    ranks, _ = encoding()
    rng = random.Random(5)
    pieces = [bytes(rng.randrange(97, 101) for _ in range(rng.randrange(1, 33))) for _ in range(500)] + [bytes(range(k, k + 20)) for k in range(0, 230, 7)]
    want = [ranks.merge_long(p) for p in pieces]
    assert ranks.merge_short(pieces, 32) == want == ranks.merge(pieces)
    short = [p for p in pieces if len(p) <= 8]
    assert short and ranks.merge_short(short, 8) == [ranks.merge_long(p) for p in short]


def test_memory_is_bounded_in_bytes(monkeypatch):
    """Whatever comes by, the remembered units stay below the bound, and a text that outlasts it is still right."""
    import sys
    ranks, other = encoding()
    monkeypatch.setattr(byte_bpe, "MEMORY", 60_000)
    encoder, rng = byte_bpe.Encoder(ranks), random.Random(8)
    import numpy as np
    for turn in range(40):
        text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 30))) for _ in range(60)) + " often seen words" + " y" * (turn % 3) + "z" * 300 * turn
        assert np.frombuffer(encoder.encode([text])[0], "<i4").tolist() == other.encode_ordinary(text)
        held = [(u, x) for some in (encoder.memory.young, encoder.memory.old) for u, x in some.items()]
        assert sum(sys.getsizeof(u) + sys.getsizeof(x) for u, x in held) < 60_000
    assert all(u in encoder.memory.young or u in encoder.memory.old for u in (" often", " seen", " words"))
    assert byte_bpe.MEMORY <= 64 << 20


def test_whole_table_against_tiktoken(spark):
    import hashlib
    _, other = encoding()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_byte_bpe"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = other.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_nulls_repeats_clashing_names_and_empty_tables(spark):
    docs = documents(spark, [None, "", "a b", "a b", "long " * 30_000], [1, 2, 3, 3, None])
    both = byte_bpe.decode(byte_bpe.encode(docs, PATH, PATTERN), PATH)
    assert sorted(both.columns) == sorted([c for c in docs.columns if c != "text"])
    got = sorted((bytes(r.decoded).decode(), len(r.ids)) for r in both.collect())
    assert [t for t, _ in got] == sorted(["", "", "a b", "a b", "long " * 30_000]) and got[0] == ("", 0)
    assert byte_bpe.decode(byte_bpe.encode(documents(spark, []), PATH, PATTERN), PATH).count() == 0
    once = byte_bpe.encode(docs, PATH, PATTERN, decoded="decoded")
    assert sorted((bytes(r.decoded).decode(), len(r.ids)) for r in once.collect()) == got
    assert byte_bpe.encode(documents(spark, []), PATH, PATTERN, decoded="decoded").count() == 0
    assert public_tokenizers.path("byte_bpe_multi_50k.tiktoken") == PATH

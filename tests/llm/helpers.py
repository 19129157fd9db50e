"""Small tables for the corpus operators, with nulls, repeats, long texts and columns whose names clash."""

import re

SPACE = "[\x20\x09-\x0d]+"
CLASHING = "row node key label keep_id kept group_size full_hash _text _size _prefix shard slot level0 ids decoded span kind start end at a b s0".split()


def documents(spark, texts, ids=None, langs=None, extra=True):
    """A table like ``documents`` with clashing extra columns."""
    ids = range(len(texts)) if ids is None else ids
    langs = langs or ["en"] * len(texts)
    names = CLASHING if extra else []
    rows = [(i, t, la, f"src{k % 3}", None if t is None else len(t), *(["x"] * len(names))) for k, (i, t, la) in enumerate(zip(ids, texts, langs))]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {n} string" for n in names)
    return spark.createDataFrame(rows, schema)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return [w for w in re.split(SPACE, lower(text)) if w]


def shingle_set(text, width=5):
    found = words(text)
    return frozenset(tuple(found[k:k + width]) for k in range(max(len(found) - width + 1, 1))) if found else frozenset()


def similar(one, two):
    return bool(one) and 100 * len(one & two) >= 75 * len(one | two)


def classes(texts):
    """doc_id -> (set size, smallest id reachable), by comparing all pairs of distinct sets."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def link(i, j):
        i, j = sorted((root(i), root(j)))
        parent[j] = i

    some = [(s, i) for s, i in first.items() if s]
    for k, (s, i) in enumerate(some):
        for t, j in some[:k]:
            if similar(s, t):
                link(i, j)
    for i, s in sets.items():
        if s:
            link(i, first[s])
    return {i: (len(s), root(i)) for i, s in sets.items()}

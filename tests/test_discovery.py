"""Opportunities and graphs against slow versions, with hot keys, loops and unknown data."""

import random
from collections import defaultdict

import pytest

from sightline.operators import graph
from sightline.plans import discovery


def pairs(spark, rows, names=("a", "b")):
    return spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))


def test_chain_ends_of_long_chains_and_loops(spark, monkeypatch):
    calls = []
    held = graph.settled
    monkeypatch.setattr(graph, "settled", lambda df, *a: calls.append(1) or held(df, *a))
    links = [(k, k + 1) for k in range(10_000)] + [(20_000, 20_001), (20_001, 20_002), (20_002, 20_000), (20_003, 20_001)] + [(30_000 + k, 5) for k in range(3_000)]
    random.Random(1).shuffle(links)
    got = {r.node: (r.end, r.hops, r.looped) for r in graph.chain_ends(pairs(spark, links, ("node", "next"))).collect()}
    assert len(got) == len(links) and len(calls) <= 18
    assert all(got[k] == (10_000, 10_000 - k, False) for k in range(10_000)) and all(got[k] == (None, None, True) for k in range(20_000, 20_004))
    assert all(got[30_000 + k] == (10_000, 9_996, False) for k in range(3_000))
    assert graph.chain_ends(pairs(spark, [], ("node", "next"))).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(0, 300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)] + [(5, 5), (9000, 9000)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    shuffled = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in edges]
    got = {r.node: r.component for r in graph.components(pairs(spark, shuffled)).collect()}
    assert got == {x: root(x) for x in parent}
    assert graph.components(pairs(spark, [])).count() == 0


def slow_authority(pages, weights, rounds=200):
    """The stationary share by powers, the mass of pages without links spread over all."""
    out = defaultdict(float)
    for (s, _), w in weights.items():
        out[s] += w
    rank = {p: 1 / len(pages) for p in pages}
    for _ in range(rounds):
        idle = sum(r for p, r in rank.items() if p not in out)
        new = {p: 0.15 / len(pages) + 0.85 * idle / len(pages) for p in pages}
        for (s, t), w in weights.items():
            new[t] += 0.85 * rank[s] * w / out[s]
        rank = new
    return {p: r * len(pages) for p, r in rank.items()}


def site(seed=3, n=120):
    """Pages with a template link on all of them, a hub that links to nearly all, a page to which a third link, and dead ends."""
    rng = random.Random(seed)
    links = [(p, 0, "home") for p in range(n)] + [(1, p, f"a{p}") for p in range(2, n - 5)] + [(p, 2, f"t{p}") for p in range(0, n, 3)]
    links += [(rng.randrange(n), rng.randrange(n), rng.choice("xyz")) for _ in range(300)] + [(4, 5, "x"), (4, 5, "y"), (4, 999, "gone")]
    return [x for x in links if x[0] not in (n - 1, n - 2)], list(range(n))


def test_authority_is_the_stationary_share(spark):
    links, pages = site()
    table = spark.createDataFrame(links, "source long, target long, anchor string")
    known = spark.createDataFrame([(p,) for p in pages], "page long")
    edges = graph.weighted_links(table, known)
    weights = {(r.source, r.target): r.weight for r in edges.collect()}
    assert all(weights[s, 0] == graph.WHOLE_LINK // 117 for s in range(5, 50) if not any(x[:2] == (s, 0) and x[2] != "home" for x in links))
    assert (4, 999) not in weights and (0, 0) not in weights and weights[4, 5] == graph.WHOLE_LINK
    got = {r.page: r.authority for r in graph.link_authority(known, edges).collect()}
    want = slow_authority(pages, weights)
    assert sum(got.values()) == pytest.approx(len(pages)) and all(got[p] == pytest.approx(want[p], rel=0.03, abs=0.02) for p in pages)
    again = graph.link_authority(known.repartition(7), edges.repartition(5))
    assert {r.page: r.authority for r in again.collect()} == got


def test_internal_links_against_all_pairs(spark):
    links, pages = site()
    facts = {p: (f"t{p % 3}" if p % 11 else None, p % 7 != 2, (p * 37) % 50, p % 5 != 4) for p in pages}
    known = spark.createDataFrame([(p, *f) for p, f in facts.items()], "page long, topic string, indexable boolean, demand long, intent_known boolean")
    table = spark.createDataFrame(links, "source long, target long, anchor string")
    edges = graph.weighted_links(table, known)
    linked = {(r.source, r.target) for r in edges.collect()}
    authority = {r.page: r.authority for r in graph.link_authority(known, edges).collect()}
    want = {}
    for s, (topic, indexable, *_) in facts.items():
        if topic and indexable:
            fits = [t for t, (other, ok, demand, intent) in facts.items() if other == topic and ok and demand > 0 and intent and t != s and (s, t) not in linked]
            for rank, t in enumerate(sorted(fits, key=lambda t: (-facts[t][2] / authority[t], t))[:3], 1):
                want[s, t] = rank
    got = {(r.source, r.target): r["rank"] for r in discovery.internal_links(known, table).collect()}
    assert got == want and len(want) > 100


def test_consolidation_against_all_pairs(spark):
    """A query that 2,000 pages share makes no pairs; pages that take one another's queries make one group."""
    rows = [("hot", 5000 + k, "2024-01", 1, 10) for k in range(2000)]
    for p, q in ((1, 2), (2, 3)):
        for k in range(4):
            rows += [(f"q{p}-{k}", p, "2024-01", 9, 100), (f"q{p}-{k}", q, "2024-01", 1, 90), (f"q{p}-{k}", p, "2024-02", 1, 80), (f"q{p}-{k}", q, "2024-02", 9, 95)]
    rows += [("steady", 7, m, 9, 100) for m in ("2024-01", "2024-02")] + [("steady", 8, m, 1, 25) for m in ("2024-01", "2024-02")]      # one leader, not dispersed
    rows += [("other", 1, "2024-01", 5, 50), ("other", 4, "2024-01", 5, 50), ("own", 9, "2024-01", 5, 50), ("en", 1, "2024-01", 5, 60), ("en", 6, "2024-01", 5, 60)]
    df = spark.createDataFrame(rows, "query string, page long, period string, clicks long, impressions long")
    pages = spark.createDataFrame([(p, "buy" if p != 4 else "read", "zh" if p != 6 else "en", p != 3) for p in {r[1] for r in rows}], "page long, intent string, language string, movable boolean")
    got = {r.page: r for r in discovery.consolidation(df, pages).collect()}
    assert set(got) == {1, 2, 3} and {r.component for r in got.values()} == {1} and {r.survivor for r in got.values()} == {2}
    assert [got[p].role for p in (1, 2, 3)] == ["MERGE", "SURVIVOR", "MERGE"] and {r.action for r in got.values()} == {"MONITOR"} and got[2].switches == 8
    assert discovery.query_contest(df).where("query = 'hot'").count() == 0
    assert {r.action for r in discovery.consolidation(df, pages.where("page <> 3")).collect()} == {"CONSOLIDATE"}


def pooled(bins):
    """Pool adjacent violators: (clicks, impressions) per bin, in order, to falling rates."""
    blocks = []
    for clicks, shown in bins:
        blocks.append([clicks, shown, 1])
        while len(blocks) > 1 and blocks[-1][0] / blocks[-1][1] > blocks[-2][0] / blocks[-2][1]:
            c, n, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + c, blocks[-1][1] + n, blocks[-1][2] + k]
    return [c / n for c, n, k in blocks for _ in range(k)]


def test_expected_ctr_is_the_pooled_curve(spark):
    rng = random.Random(6)
    rows = [(f"s{s}", p, p + rng.choice((-0.3, 0.0, 0.4)), rng.randrange(0, 40), rng.randrange(40, 900)) for s in range(3) for p in range(1, 21 + 10 * s) for _ in range(30)] + [("s0", 0, None, 1, 1), ("s0", 0, 3.0, 0, 0)]
    df = spark.createDataFrame(rows, "site string, page long, position double, clicks long, impressions long")
    got = defaultdict(dict)
    for r in discovery.expected_ctr(df.repartition(6), ["site"]).collect():
        got[r.site][r.bin] = r.expected
    for s in ("s0", "s1", "s2"):
        sums = defaultdict(lambda: [0, 0])
        for site_, _, position, clicks, shown in rows:
            if site_ == s and position is not None and shown:
                b = min(max(int(position + 0.5), 1), discovery.LAST_POSITION)
                sums[b][0] += clicks
                sums[b][1] += shown
        want = pooled([sums[b] for b in sorted(sums)])
        assert [got[s][b] for b in sorted(sums)] == pytest.approx(want) and want == sorted(want, reverse=True)


def test_a_fifth_below_the_cohort_fires(spark):
    curve = spark.createDataFrame([("s", 3, 5000, 0.10), ("s", 4, 999, 0.08)], "site string, bin int, impressions long, expected double")
    rows = [(1, "s", 1000, 80, 3.2), (2, "s", 1000, 81, 3.2), (3, "s", 499, 0, 3.0), (4, "s", 1000, 1, 4.0), (5, "x", 1000, 1, 3.0), (6, "s", 1000, 1, None)]
    df = spark.createDataFrame(rows, "page long, site string, impressions long, clicks long, position double")
    got = {r.page: r.state for r in discovery.ctr_against_cohort(df, ["site"], curve).collect()}
    assert got == {1: "BELOW_EXPECTATION", 2: "AS_EXPECTED", 3: "TOO_FEW_IMPRESSIONS", 4: "NO_BASELINE", 5: "NO_BASELINE", 6: "NO_BASELINE"}


def test_content_gaps(spark):
    asked = [(1, "cheap Shop-Platform", "BUY", 100, 0, True, False, True), (2, "platform SHOP cheap", "BUY", 100, 0, True, False, True), (3, "other", "BUY", 100, 0, True, False, True), (4, "x", "BUY", None, 0, True, False, True),
             (5, "y", "BUY", 0, 0, True, False, True), (6, "z", "BUY", 9, 100, True, False, True), (7, "v", "BUY", 9, 99, None, False, True), (8, "w", "BUY", 9, 0, True, True, True), (9, "u", "BUY", 9, 0, True, False, None),
             (10, "one rival", "BUY", 9, 0, True, False, True), (11, "cheap shop platform", "READ", 9, 0, True, False, True)]
    queries = spark.createDataFrame([(q, text, intent, "TW", *rest) for q, text, intent, *rest in asked], "query_id long, text string, intent string, market string, volume long, impressions long, coverage_known boolean, brand_navigation boolean, page_type_fits boolean")
    results = [(q, "TW", rank, d) for q in range(1, 12) if q != 10 for rank, d in ((1, "a.com"), (10, "b.com"), (11, "c.com"))] + [(10, "TW", 1, "a.com"), (10, "TW", 2, "a2.com"), (10, "TW", 3, "no.com"), (10, "JP", 4, "b.com"), (10, "TW", 11, "b.com")]
    rivals = [("A", "a.com", "TW", True), ("A", "a2.com", "TW", True), ("B", "b.com", "TW", True), ("N", "no.com", "TW", False), ("C", "c.com", "TW", True)]
    inventory = spark.createDataFrame([("Shop platform, CHEAP cheap", "BUY")], "text string, intent string")
    tables = (queries, spark.createDataFrame(results, "query_id long, market string, rank int, domain string"), spark.createDataFrame(rivals, "competitor_id string, domain string, market string, approved boolean"), inventory)
    got = {r.query_id: (r.action, r.reason) for r in discovery.content_gaps(*tables, inventory_complete=True).collect()}
    assert got == {1: ("UPDATE_EXISTING", "ASSET_EXISTS"), 2: ("UPDATE_EXISTING", "ASSET_EXISTS"), 3: ("CREATE_NEW", None), 4: ("MONITOR", "DEMAND_UNKNOWN"), 5: ("DO_NOTHING", "NO_DEMAND"), 7: ("MONITOR", "COVERAGE_UNKNOWN"),
                   9: ("MONITOR", "PAGE_TYPE_UNCONFIRMED"), 11: ("CREATE_NEW", None)}
    unfinished = discovery.content_gaps(*tables, inventory_complete=False).collect()
    assert "CREATE_NEW" not in {r.action for r in unfinished} and {r.query_id: r.reason for r in unfinished}[3] == "INVENTORY_INCOMPLETE"


def test_sketches_merge_and_stay_within_their_error(spark):
    links = spark.range(120_000).selectExpr("id % 3 AS url", "id % 7 AS day", "CAST(id % 40000 AS STRING) AS domain")
    counted = discovery.merged(discovery.domain_sketches(links, ["url", "day"]), ["url"])
    assert all(abs(r.domains - 40_000) < 4 * 0.0163 * 40_000 for r in counted.collect())
    assert abs(discovery.merged(counted.select("url", "sketch").selectExpr("0 AS g", "sketch"), ["g"]).first().domains - 40_000) < 4 * 0.0163 * 40_000


def test_authority_gaps(spark):
    pages = [("p1", "g", False, True, 1, True), ("p2", "g", False, True, 1, True), ("mine", "g", True, True, 5, True), ("idle", "g", True, True, 0, True), ("broken", "g", True, False, 5, True), ("unseen", "g", True, True, 5, None), ("alone", "h", True, True, 5, True)]
    links = [("p1", "d1", f"x{k}") for k in range(10)] + [("p2", "d2", f"y{k}") for k in range(4)] + [("p2", "d3", f"y{k}") for k in range(6)] + [("mine", "d1", "x1"), ("mine", "d2", "x1"), ("mine", "d2", None)]
    out = discovery.authority_gaps(spark.createDataFrame(pages, "url string, intent_group string, owned boolean, technical_ok boolean, demand long, quality_checked boolean"), spark.createDataFrame(links, "url string, day string, domain string"))
    got = {r.url: (r.domains, r.peer_domains, r.action, r.missing) for r in out.collect()}
    assert got == {"mine": (1, 8.0, "AUTHORITY_BUILD", None), "idle": (0, 8.0, "MONITOR", "DEMAND"), "broken": (0, 8.0, "TECHNICAL_FIX", "TECHNICAL_FIRST"), "unseen": (0, 8.0, "MONITOR", "LINK_QUALITY_REVIEW"), "alone": (0, None, "DO_NOTHING", "NO_PEERS")}


def test_authority_gaps_count_exactly(spark):
    """Far more domains than a sketch holds one by one."""
    links = spark.range(60_000).selectExpr("CASE WHEN id < 20000 THEN 'p1' ELSE 'mine' END AS url", "concat('d', id % 3) AS day", "CAST(id % 30011 AS STRING) AS domain")
    pages = spark.createDataFrame([("p1", "g", False, True, 1, True), ("mine", "g", True, True, 5, True)], "url string, intent_group string, owned boolean, technical_ok boolean, demand long, quality_checked boolean")
    r = discovery.authority_gaps(pages, links).first()
    assert (r.url, r.domains, r.peer_domains, r.group_domains) == ("mine", 30_011, 20_000.0, 30_011)


def test_visibility_gaps(spark):
    def seen(topic, entity, mentions, answers=100, run=1):
        return (topic, "p", "v1", "chat", "TW", run, entity, mentions, answers)

    rows = [seen("four", "us", 10), seen("four", "a", 40), seen("four", "b", 40), seen("three", "us", 10), seen("three", "a", 39), seen("none", "us", 10), seen("none", "a", 10), seen("one", "us", 10), seen("one", "a", 14), seen("two", "us", 10), seen("two", "a", 15),
            seen("lost", "us", 10), seen("lost", "a", 90, None), seen("odd", "us", 10), seen("odd", "a", 90, 99), seen("part", "us", 10), seen("part", "us", 10, run=2), seen("part", "a", 90), seen("part", "b", 20), seen("part", "b", 20, run=2), seen("alone", "a", 5)]
    df = spark.createDataFrame(rows, "topic string, prompt_id string, prompt_version string, platform string, region string, run int, entity string, mentions long, answers long")
    got = {r.topic: (r.competitor, r.band, r.state) for r in discovery.visibility_gaps(df.repartition(4), "us").collect()}
    assert got == {"four": ("a", 4, "GEO_GAP"), "three": ("a", 3, "GEO_GAP"), "two": ("a", 2, "GEO_GAP"), "one": ("a", 1, "GEO_GAP"), "none": ("a", 0, "DO_NOTHING"), "part": ("b", 2, "GEO_GAP"),
                   "lost": (None, None, "INSUFFICIENT_EVIDENCE"), "odd": (None, None, "INSUFFICIENT_EVIDENCE"), "alone": (None, None, "INSUFFICIENT_EVIDENCE")}

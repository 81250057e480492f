from __future__ import annotations

import random

import numpy as np
import pytest

from sparquill.operators import rerank, routing, search
from sparquill.plans.rules import LANGUAGES, PROFILES, STATUTES, Boosts, Profile

SMALL = "/root/testdata/sf0.001"

CORE, KPL, KPA, TTL, HANK, OYL = STATUTES.sources

VECTORS = [
    ("julkisen hankinnan kynnysarvo", {CORE: (0.5333, 6), HANK: (0.4667, 5)}),
    ("kunnan talousarvion alijäämä", {CORE: (0.8889, 9), KPL: (0.1111, 2)}),
    ("tilinpäätöksen liitetiedot ja tase", {KPL: (0.5789, 6), CORE: (0.4211, 5)}),
    ("osakeyhtiön hallituksen vastuu", {CORE: (0.6154, 7), OYL: (0.3846, 4)}),
    ("KPL 3:1 liitetiedot", {KPL: (0.8, 8), CORE: (0.2, 2)}),
    ("kunnanhallitus tilintarkastaja", {CORE: (0.7143, 8), TTL: (0.1429, 2), OYL: (0.1429, 2)}),
]


def test_routing_vectors(spark):
    asked = spark.createDataFrame([(i, q) for i, (q, _) in enumerate(VECTORS)], "question_id int, text string")
    rows = routing.budget(routing.route(asked, STATUTES), 10, 2).collect()
    for i, (_, want) in enumerate(VECTORS):
        assert {r.src: (round(r.weight, 4), r.k) for r in rows if r.question_id == i} == want


def brute_route(q, router, available, least=2):
    low, named = q.lower(), None
    for term, src in router.explicit:
        named = named or (src if term in low else None)
    for term, src in router.numbers:
        named = named or (src if term in q else None)
    anchored = any(a in low for a in router.anchors)
    score = {s: sum(k in low for k in router.keywords[s]) for s in router.sources if s in available}
    if anchored and router.core in score:
        score[router.core] += router.anchor_bonus
    best = lambda d: sorted(d, key=d.get, reverse=True)  # noqa: E731  stable
    if named in score:
        others = [s for s in best(score) if s != named]
        return {named: 0.8} | ({others[0]: 0.2} if others else {})
    matched = {s: n for s, n in score.items() if n}
    if len(matched) < least:
        w = {s: router.priors.get(s, 0.1) + 0.2 * matched.get(s, 0) for s in score}
        w = {s: w[s] for s in best(w)[: max(least, len(matched) + 1)]}
        return {s: v / sum(w.values()) for s, v in w.items()}
    w = {s: n / sum(matched.values()) for s, n in matched.items()}
    if anchored and router.core in w and router.core not in best(w)[:2]:
        w[router.core] = max(w[router.core], max(w.values()) * router.core_share)
        w = {s: v / sum(w.values()) for s, v in w.items()}
    return w


@pytest.mark.parametrize("available", [STATUTES.sources, STATUTES.sources[1:4], STATUTES.sources[:1]])
def test_routing_against_brute_force(spark, available):
    rng = random.Random(1)
    terms = [k for s in STATUTES.sources for k in STATUTES.keywords[s]] + ["KPL", "410/2015", "ja", "talous"]
    asked = [(i, " ".join(rng.choices(terms, k=rng.randint(0, 5)))) for i in range(80)] + [(99, "")]
    rows = routing.route(spark.createDataFrame(asked, "question_id int, text string"), STATUTES, tuple(available)).collect()
    for i, q in asked:
        got = sorted((r for r in rows if r.question_id == i), key=lambda r: r.route_pos)
        want = brute_route(q, STATUTES, available)
        assert [r.src for r in got] == list(want), q
        assert np.allclose([r.weight for r in got], list(want.values()))


def test_loaded_keywords_replace():
    assert STATUTES.loaded({KPL: ("x",)}).keywords[KPL] == ("x",) and STATUTES.loaded({KPL: ("x",)}).keywords[OYL] == STATUTES.keywords[OYL]


def unit(rng, n, dims=8):
    v = rng.normal(size=(n, dims))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def test_topk_against_numpy_whatever_the_partitions(spark):
    rng = np.random.default_rng(0)
    v, q = unit(rng, 200), unit(rng, 5)
    v[50:60] = v[40]  # ties
    rows = spark.createDataFrame([(i, f"s{i % 3}", [float(x) for x in v[i]]) for i in range(200)] + [(900, "s0", None), (901, None, [1.0] * 8)], "id long, src string, embedding array<double>")
    asked = spark.createDataFrame([(i, [float(x) for x in q[i]]) for i in range(5)] + [(9, None)], "question_id int, embedding array<double>")
    score = np.round(q @ v.T, 6)
    want = {(i, f"s{s}", r + 1): j for i in range(5) for s in range(3) for r, j in enumerate(sorted(range(s, 200, 3), key=lambda j: (-score[i, j], j))[:7])}
    for n, block in ((1, 4096), (5, 2)):
        got = search.topk(asked, rows.repartition(n), 7, source="src", block=block).filter("src is not null").collect()
        assert {(r.question_id, r.src, r.rank): r.id for r in got} == want
    assert search.topk(asked.limit(0), rows, 3).count() == 0 and search.topk(asked, rows.limit(0), 3).count() == 0


def hits_frame(spark, rows):
    return spark.createDataFrame(rows, "question_id int, src string, id long, score double, src_rank int, route_pos int, router_place int")


def test_threshold_before_and_after(spark):
    hits = hits_frame(spark, [(1, "en", 1, 0.49, 1, 1, 1), (1, "de", 2, 0.52, 1, 2, 2)])
    asked = spark.createDataFrame([(1, "der thing")], "question_id int, text string")
    before = search.merge(hits, asked, Profile(router_bonus=0.02), "en").collect()
    after = search.merge(hits, asked, Profile(router_bonus=0.02, threshold_after=True, mismatch_penalty=0.03, mismatch_terms=("thing",)), "en").collect()
    assert [(r.id, r.score) for r in before] == [(2, 0.52)] and [(r.id, r.score) for r in after] == [(1, 0.51)]


def test_guards_add_up_and_ties_keep_route_order(spark):
    hits = hits_frame(spark, [(1, "b", 1, 0.6, 1, 2, 2), (1, "a", 2, 0.6, 1, 1, 1), (1, "a", 3, 0.6, 2, 1, 1)])
    asked = spark.createDataFrame([(1, "Kunnan kunta")], "question_id int, text string")
    rows = search.merge(hits, asked, Profile(guards=(("kunnan", "b", 0.03), ("kunta", "b", -0.03), ("missing", "b", 1.0))), "a").collect()
    assert [r.id for r in sorted(rows, key=lambda r: r.rank)] == [2, 3, 1]


@pytest.mark.parametrize(("second", "swapped"), [(0.595, True), (0.5, False)])
def test_diversity_swap(spark, second, swapped):
    rows = [(1, "a", i, 0.61 - i * 0.001, i, 1, 1) for i in range(1, 11)] + [(1, "b", 20, second, 1, 2, 2), (1, "b", 21, second - 0.01, 2, 2, 2)]
    asked = spark.createDataFrame([(1, "x")], "question_id int, text string")
    got = sorted(search.merge(hits_frame(spark, rows), asked, Profile(diversity_gap=0.02, min_score=0.1), "a").collect(), key=lambda r: r.rank)
    assert [r.id for r in got] == [*range(1, 10), 20 if swapped else 10]
    short = [r for r in rows if r[2] < 5 or r[2] == 20]  # not longer than the limit: nothing to swap in
    got = search.merge(hits_frame(spark, short), asked, Profile(diversity_gap=0.02, min_score=0.1), "a").collect()
    assert len(got) == 5


def test_boosts_are_capped(spark):
    hits = spark.createDataFrame([(1, 1, 0.6, "110 A", "1", ["tase", "oma pääoma"]), (1, 2, 0.59, "5", "1", []), (1, 3, 0.02, "7", "2", None)], "question_id int, rank int, score double, section_id string, moment string, anchors array<string>")
    asked = spark.createDataFrame([(1, "Oma pääoma ja tase")], "question_id int, text string")
    rules = Boosts(boosts=((("tase",), "110a", None, 0.5), (("tase",), "5", "2", 0.5)), penalties=((("pääoma",), "7", -0.1),), overlap_terms=("oma",), overlap_sections=("110a",))
    rows = {r.section_id: r for r in rerank.boost(hits, asked, rules).collect()}
    assert rows["110 A"].score == 0.63 and rows["110 A"].boost_applied == 0.03 and rows["5"].score == 0.59 and rows["7"].score == 0.019
    only = Boosts(boosts=(), overlap_terms=("oma",), overlap_sections=("110a",))
    assert {r.section_id: r.score for r in rerank.boost(hits, asked, only).collect()}["110 A"] == 0.62


def test_profiles_of_the_statutes():
    assert {"plain", "crosslaw", "graph"} <= set(PROFILES) and LANGUAGES.core in LANGUAGES.sources


def test_questions_of_a_small_file_are_dealt_to_many_tasks(spark, monkeypatch):
    """A file of one part, and what follows from its rows is worked out by several tasks, ranked without another shuffle."""
    from sparquill.plans import catalog, statute_queries

    monkeypatch.setattr(catalog, "SPREAD", 32)
    rows = statute_queries.asked(spark, SMALL)
    assert rows.rdd.getNumPartitions() > 1 and rows.count() == spark.read.parquet(f"{SMALL}/part.parquet").count()
    assert statute_queries.statute_boosts(spark, SMALL).rdd.getNumPartitions() == rows.rdd.getNumPartitions()
    from sparquill.plans.graph_queries import statute_files

    assert statute_files(spark, SMALL).rdd.getNumPartitions() > 1


def test_questions_are_not_sent_to_all_tasks(spark):
    """Guards of a table: only they may be broadcast, no table that has a row a question."""
    from sparquill.plans import statute_queries

    plan = statute_queries.statute_guards_table(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") <= 1
    plan = statute_queries.statute_boosts(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan


def test_siblings_in_blocks(spark, monkeypatch):
    """A section dealt as a square of blocks gives each pair once."""
    from sparquill.operators import graph

    monkeypatch.setattr(graph, "PAIRS", 10)
    nodes = [(i, "a" if i < 40 else None if i == 41 else "b", i % 2) for i in range(60)]
    rows = spark.createDataFrame(nodes, "node_id int, law_key string, section_num int")
    found = graph.siblings(rows.filter("node_id % 3 = 0").select("node_id"), rows)
    want = sorted((a, b) for a, la, sa in nodes for b, lb, sb in nodes if a % 3 == 0 and la and (la, sa) == (lb, sb))
    assert sorted(map(tuple, found.collect())) == want and found.rdd.getNumPartitions() > 20

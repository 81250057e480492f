"""Indexed vector search, rules as tables, stored n-grams."""

from __future__ import annotations

import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparquill.operators import documents, matching, rerank, routing, search, text_index, vector_index
from sparquill.plans.rules import LANGUAGES, Boosts, Profile


def clustered(spark, n=4000, groups=40, length=16, seed=1):
    rng = np.random.default_rng(seed)
    m = rng.standard_normal((groups, length))[rng.integers(0, groups, n)] + 0.2 * rng.standard_normal((n, length))
    m /= np.linalg.norm(m, axis=1)[:, None]
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, embedding array<float>").repartition(5)


def test_the_index_finds_nearly_all_in_few_cells(spark, tmp_path):
    corpus = clustered(spark)
    asked = corpus.filter("id % 100 = 0").select(F.col("id").alias("question_id"), "embedding")
    path = str(tmp_path / "index")
    vector_index.build(corpus, path, cells=32, file_rows=50)
    exact = search.topk(asked, corpus, 5)
    found = vector_index.search(asked, path, 5, probes=4)
    assert vector_index.recall(found, exact).first().recall >= 0.95
    read = vector_index.rows_read(asked, path, 4).collect()
    assert len(read) == 40 and {r.n_indexed for r in read} == {4000} and sum(r.n_rows for r in read) < 0.3 * 40 * 4000
    every = vector_index.search(asked, path, 5, probes=32)
    assert sorted(map(tuple, every.collect())) == sorted(map(tuple, exact.select(*every.columns).collect()))
    plan = vector_index.search(asked.limit(1), path, 5, probes=2)._jdf.queryExecution().toString()
    assert "PartitionFilters: [cell" in plan and plan.count("Exchange hashpartitioning") == 1  # of the hits alone


def test_the_index_takes_odd_rows(spark, tmp_path):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(1000, None), (1001, [0.0, 0.0]), (1002, [0.0, 1.0])]
    corpus = spark.createDataFrame(rows, "id long, embedding array<float>")
    path = str(tmp_path / "index")
    vector_index.build(corpus, path, cells=8, file_rows=100)  # more cells than different vectors, one cell of nearly all rows
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.6, 0.8])], "question_id int, embedding array<float>")
    got = vector_index.search(asked, path, 3, probes=8, block=1).collect()
    assert sorted((r.question_id, r.rank, r.id, r.score) for r in got) == [(1, 1, 0, 1.0), (1, 2, 1, 1.0), (1, 3, 2, 1.0), (3, 1, 1002, 0.8), (3, 2, 0, 0.6), (3, 3, 1, 0.6)]
    vector_index.build(corpus, path, cells=1)
    assert vector_index.search(asked, path, 400, probes=1).count() == 2 * 302
    vector_index.build(corpus.limit(0), path, cells=4)
    assert vector_index.search(asked, path, 3, probes=2).count() == 0
    with pytest.raises(ValueError, match="cells"):
        vector_index.build(corpus, path, cells=0)


def test_rows_without_a_source_are_a_source(spark, monkeypatch):
    corpus = spark.createDataFrame([(1, None, [1.0, 0.0]), (2, "a", [0.6, 0.8]), (3, None, [0.8, 0.6]), (4, "a", None)], "id int, src string, embedding array<double>")
    asked = spark.createDataFrame([(q, [1.0, 0.0]) for q in range(5)], "question_id int, embedding array<double>")
    want = sorted((q, *r) for q in range(5) for r in (("", 1, 1), ("a", 2, 1)))
    for kept in (search.KEPT_BYTES, 0):
        monkeypatch.setattr(search, "KEPT_BYTES", kept)
        got = search.topk(asked, corpus, 1, source="src", block=2).collect()
        assert sorted((r.question_id, r.src or "", r.id, r.rank) for r in got) == want


def words(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 7))) for _ in range(n)]


@pytest.mark.parametrize("block", [matching.BLOCK, 700])
def test_ten_thousand_patterns_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(matching, "BLOCK", block)
    keys = sorted(set(words(10_000)))
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdeé \n") for _ in range(rng.randint(0, 60))) for _ in range(120)] + [None, "", "a" * 20_000]
    rules = spark.createDataFrame([(k, f"t{i % 17}") for i, k in enumerate(keys)] + [(keys[0], "twice"), (None, "none"), ("", "all")], "keyword string, tag string")
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("held", F.lit("clash")).repartition(3)
    got = docs.select("id", matching.held(F.col("text"), rules).alias("h"), matching.labels(F.col("text"), rules).alias("l"), matching.counts(F.col("text"), rules, label="tag").alias("c")).collect()
    tag = {k: {f"t{i % 17}"} for i, k in enumerate(keys)} | {"": {"all"}}
    tag[keys[0]] = tag[keys[0]] | {"twice"}
    for r in got:
        want = sorted(k for k in tag if texts[r.id] is not None and k in texts[r.id])
        every = [t for k in want for t in tag[k]]
        assert r.h == want and r.l == sorted(set(every)) and r.c == {t: every.count(t) for t in set(every)}


def test_plans_do_not_grow_with_rules(spark):
    docs = spark.createDataFrame([(1, "abc")], "id int, text string")
    sizes = [len(docs.select(matching.held(F.col("text"), spark.createDataFrame([(w,) for w in words(n)], "keyword string")))._jdf.queryExecution().toString()) for n in (3, 5000)]
    assert abs(sizes[0] - sizes[1]) < 100


def test_no_rules_at_all(spark):
    none = spark.createDataFrame([], "keyword string, src string")
    docs = spark.createDataFrame([(1, "abc")], "id int, text string")
    row = docs.select(matching.held(F.col("text"), none).alias("h"), matching.counts(F.col("text"), none).alias("c")).first()
    assert row.h == [] and row.c == {}


def test_routing_by_a_table_equals_routing_by_code(spark):
    rng = random.Random(6)
    vocabulary = [k for ks in LANGUAGES.keywords.values() for k in ks] + list(string.ascii_lowercase)
    asked = spark.createDataFrame([(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12)))) for i in range(80)] + [(99, None)], "question_id int, text string")
    keywords = spark.createDataFrame([(s, k) for s, ks in LANGUAGES.keywords.items() for k in ks] + [("elsewhere", "a")], "src string, keyword string")
    got, want = routing.route(asked, LANGUAGES, keywords=keywords), routing.route(asked, LANGUAGES)
    assert sorted(map(tuple, got.filter("question_id < 99").collect())) == sorted(map(tuple, want.filter("question_id < 99").collect()))


def test_boosts_by_a_table_equal_boosts_by_code(spark):
    boosts = Boosts(boosts=((("tase", "tuotto"), "1a", None, 0.05), (("tase",), "1a", "2", 0.03), (("x",), "9", "1", 0.2)), penalties=((("kulu",), "3", -0.04),), cap_share=0.2)
    table = [(i, t, of, at, add) for i, (terms, of, at, add) in enumerate(boosts.boosts) for t in terms] + [(f"p{i}", t, of, None, add) for i, (terms, of, add) in enumerate(boosts.penalties) for t in terms]
    rules = spark.createDataFrame([(str(i), *r) for i, *r in table], "rule_id string, term string, section string, moment string, change double")
    asked = spark.createDataFrame([(1, "Tase ja tuotto"), (2, "kulu x"), (3, "")], "question_id int, text string")
    hits = spark.createDataFrame([(q, n, s, sec, m) for q in (1, 2, 3) for n, (s, sec, m) in enumerate([(0.9, "1 A", "1"), (0.88, "1a", " 2"), (0.2, "3", "1"), (0.1, "9", "1"), (0.05, None, None)], 1)], "question_id int, rank int, score double, section_id string, moment string")
    got = rerank.boost_by_table(hits, asked, rules, 0.2)
    want = rerank.boost(hits, asked, boosts, anchors=None)
    assert sorted(map(tuple, got.select(*sorted(want.columns)).collect()), key=repr) == sorted(map(tuple, want.select(*sorted(want.columns)).collect()), key=repr)


def texts_for_index(n=250, seed=9):
    rng = random.Random(seed)
    out = [(i, "".join(rng.choice("abAÄä \n") for _ in range(rng.randint(0, 40)))) for i in range(n)]
    return out + [(n, None), (None, "abab"), (0, "other text of the same id"), (1, "repeated"), (1, "repeated"), (n + 1, "a" * 30_000 + "needle" + "b" * 30_000)]


def test_look_ups_by_grams_equal_brute_force(spark, tmp_path):
    rows = texts_for_index()
    text_index.build(spark.createDataFrame(rows, "id long, text string").withColumn("gram", F.lit("clash")).repartition(4), str(tmp_path / "i"))
    rng = random.Random(1)
    asked = ["".join(rng.choice("abä \n") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["", "A", "ABÄ", "abä", "bab", "needle", "zzz", "SAME id", None, "𐐀bc", "of the same id"]
    got = text_index.find(spark, str(tmp_path / "i"), spark.createDataFrame([(w, 1) for w in asked], "word string, of int")).collect()
    want = {(w, i) for w in asked if w is not None for i, t in rows if t is not None and w.lower() in t.lower()}
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_a_look_up_reads_the_folders_of_its_grams_alone(spark, tmp_path):
    path = str(tmp_path / "i")
    text_index.build(spark.createDataFrame([(i, f"text number {i} " + chr(97 + i % 26) * 5) for i in range(2000)], "id int, text string"), path)
    found = text_index.candidates(spark, path, spark.createDataFrame([("number 1234",)], "word string"))
    assert [r.id for r in found.collect()] == [1234]
    picked = text_index.picked_grams(spark, path, spark.createDataFrame([("number 1234",)], "word string"))
    lists = text_index._stored(spark, path, "postings", [r.bucket for r in picked.collect()])
    assert "PartitionFilters: [bucket" in lists._jdf.queryExecution().toString() and 0 < lists.select(F.input_file_name()).distinct().count() <= 4
    assert spark.read.parquet(f"{path}/postings").select("bucket").distinct().count() > 40
    assert text_index.find(spark, path, spark.createDataFrame([], "word string")).count() == 0
    text_index.build(spark.createDataFrame([], "id int, text string"), path)
    assert text_index.find(spark, path, spark.createDataFrame([("number",), ("n",)], "word string")).count() == 0


def test_a_gram_of_all_texts_is_dealt_to_many_files(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    text_index.build(spark.createDataFrame([(i, "the") for i in range(20_000)], "id int, text string"), str(tmp_path / "i"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per = spark.read.parquet(str(tmp_path / "i/postings")).filter("gram = 'the'").groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in per) == 20_000 and len(per) > 1


def test_tables_are_found_alike_with_and_without_an_index(spark, tmp_path):
    rng = random.Random(5)
    names = ["Tuotot yhteensä", "KULUT", "a", "", None, "rivi 12", "x y"]
    rows = spark.createDataFrame([(rng.choice(names), rng.choice(names), i) for i in range(80)], "row_name string, table_title string, row_idx int")
    asked = spark.createDataFrame([(1, "tuotot kulut a"), (2, "12 rivi rivi"), (3, "?"), (4, "yhteensä x")], "question_id int, text string")
    documents.index_tables(rows, str(tmp_path / "i"))
    got, want = (documents.search_tables(asked, rows, index=i).collect() for i in (str(tmp_path / "i"), None))
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr) and len(want) == 15


def test_mapping_rules_and_guards_of_a_table_equal_those_of_code(spark):
    coded = (("law:1", ("b", "a"), "X"), ("law", ("zz", "ä"), "Y"), ("2", ("c",), "Z"))
    pairs = spark.createDataFrame([("law:1", f"d{i}", i, 1.0 - i / 10, t, s) for i, (t, s) in enumerate([("A", "b"), ("", "Ä x"), ("none", "of it"), ("zz", "a")], 1)] + [("law:2", "d9", 1, 0.5, "C", ""), ("other", "d5", 1, 0.4, "", ""), ("other", "d6", 5, 0.1, None, None)], "law_node_id string, doc_node_id string, rank int, score double, title string, text string")
    rules = spark.createDataFrame([(i, p, kind, j, s) for i, (p, secs, kind) in enumerate(coded) for j, s in enumerate(secs)], "rule_no int, pattern string, edge_type string, place int, section string")
    want = documents.mapping_edges(pairs, coded)
    assert sorted(map(str, documents.mapping_edges_by_table(pairs, rules).select(*want.columns).collect())) == sorted(map(str, want.collect())) and want.count() == 6
    profile = Profile(min_score=0.1, guards=(("kunta", "a", 0.03), ("kunta", "b", -0.03), ("unta", "a", 0.02)))
    hits = spark.createDataFrame([(q, s, f"{s}{r}", 0.5 - r / 100, r, p, p) for q in (1, 2) for p, s in ((1, "a"), (2, "b")) for r in (1, 2)], "question_id int, src string, id string, score double, src_rank int, route_pos int, router_place int")
    asked = spark.createDataFrame([(1, "Kunta kunta"), (2, "muu")], "question_id int, text string")
    guards = spark.createDataFrame(list(profile.guards), "term string, src string, adjust double")
    got, want = search.merge(hits, asked, profile, "a", guards=guards), search.merge(hits, asked, profile, "a")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_postings_are_written_without_a_copy(spark, tmp_path, monkeypatch):
    """The build stages nothing beside the index, and deals a folder's postings to several sorted files."""
    monkeypatch.setattr(text_index, "POSTINGS", 200)
    monkeypatch.setattr(text_index, "stage", lambda *a: pytest.fail("the grams are written twice"))
    rows = [(i, f"text number {i} " + chr(97 + i % 26) * 5) for i in range(2000)]
    text_index.build(spark.createDataFrame(rows, "id int, text string"), str(tmp_path / "i"), buckets=4)
    back = spark.read.parquet(str(tmp_path / "i/postings"))
    assert len(back.inputFiles()) > 8 and back.count() == sum(len({t[j : j + 3] for j in range(len(t) - 2)}) for _, t in rows)


def test_a_posting_takes_a_few_bytes(spark, tmp_path):
    """Postings lie as steps from one text to the next, and words that are in many texts are counted right."""
    rng = random.Random(4)
    stems = sorted({"".join(rng.choice("abcdefghiklmnorstu") for _ in range(rng.randint(4, 9))) for _ in range(800)})
    rows = [(i, " ".join(rng.choices(stems, k=200))) for i in range(1500)]
    path = str(tmp_path / "i")
    text_index.build(spark.createDataFrame(rows, "id int, text string"), path)
    found = text_index.find(spark, path, spark.createDataFrame([(w,) for w in stems], "word string")).groupBy("word").count().collect()
    assert {r["word"]: r["count"] for r in found} == {w: n for w in stems if (n := sum(w in t for _, t in rows))}
    assert sum(f.stat().st_size for f in (tmp_path / "i/postings").rglob("*.parquet")) < 4 * spark.read.parquet(f"{path}/postings").count()


def test_words_are_found_alike_one_by_one_and_together(spark, tmp_path, monkeypatch):
    rows = [(i, f"Text {i} " + " ".join(chr(97 + (i + j) % 26) * 4 for j in range(i % 30))) for i in range(300)]
    text_index.build(spark.createDataFrame(rows, "id int, text string"), str(tmp_path / "i"))
    asked = [chr(97 + j) * n for j in range(26) for n in (3, 4)] + ["aaaa bbbb", "AAAA", "aaaab", "text 29"]
    words = spark.createDataFrame([(w,) for w in asked], "word string")
    got = {}
    for many in (0, 10**6):
        monkeypatch.setattr(text_index, "MANY", many)
        got[many] = sorted(map(tuple, text_index.find(spark, str(tmp_path / "i"), words).collect()))
    assert got[0] == got[10**6] == sorted((w, i) for w in asked for i, t in rows if w.lower() in t.lower())


def test_hits_of_mapping_rules_are_not_broadcast(spark, tmp_path, monkeypatch):
    """Hits made from a small file are many rows; only the rules may go to all tasks, and only if they are few."""
    spark.range(2000).write.parquet(str(tmp_path / "n"))
    made = spark.read.parquet(str(tmp_path / "n")).select("id", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("rank"))
    pairs = made.select(F.concat(F.lit("law:"), "id").alias("law_node_id"), F.col("rank").alias("doc_node_id"), "rank", (1 - F.col("rank") / 10).alias("score"), F.lit("").alias("title"), F.concat(F.lit("b"), "id").alias("text"))
    coded = (("law:1", ("b1", "b"), "X"), (":2", ("b22",), "Y"))
    rules = spark.createDataFrame([(i, p, kind, j, s) for i, (p, secs, kind) in enumerate(coded) for j, s in enumerate(secs)], "rule_no int, pattern string, edge_type string, place int, section string")
    rules.write.parquet(str(tmp_path / "rules"))
    want = sorted(map(str, documents.mapping_edges(pairs, coded).collect()))
    for sent, sides in ((10, ["BuildRight"]), (2, [])):
        monkeypatch.setattr(documents, "SENT", sent)
        found = documents.mapping_edges_by_table(pairs, spark.read.parquet(str(tmp_path / "rules")))
        plan = [line for line in found._jdf.queryExecution().sparkPlan().toString().splitlines() if "BroadcastHashJoin" in line and "fit" in line]
        assert {side for line in plan for side in ("BuildLeft", "BuildRight") if side in line} == set(sides)
        assert sorted(map(str, found.select("law_node_id", "doc_node_id", "edge_type", "score", "evidence_text", "context", "rule_no").collect())) == want

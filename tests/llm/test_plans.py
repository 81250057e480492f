"""URL filters, mixing, sharding and the pipeline against brute force; the registered queries."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sparquill.llm import mixing, sharding, url_filters

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def id_hash(i):
    return int(hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest()[:15], 16)


# URL filters

URLS = [
    None, "", "no scheme.com/en/", "http://", "HTTP://Example.COM/en/x?q#f", "http://www.example.com/en/1", "http://a.www.example.com/en/1", "https://sub.example.com/en/9.html", "http://badexample.com/en/1",
    "http://x.net/es/5", "http://net/fr/", "http://net/de/", "http://a.com", "http://a.com/", "http://a.com?x=/en/", "http://É.org/Ä/1#/2", "x://y.org/a/b/c/d/e/f/g/h/i/j", "http://u@h.net:80/fr/1/", "http://a.org/en//2", "://q.org/1",
]


def brute_url(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def brute_rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def brute_templates(counts):
    """counts: {(host, shape): [labelled, bad]} to {(host, shape): template}."""
    segments = {k: k[1].split("/", url_filters.MAX_DEPTH - 1) for k in counts}
    template = {k: s[0] for k, s in segments.items()}
    for level in range(1, max(map(len, segments.values()), default=0)):
        kids = defaultdict(lambda: defaultdict(lambda: [0, 0]))
        for k, s in segments.items():
            if len(s) > level:
                for j in (0, 1):
                    kids[k[0], template[k]][s[level]][j] += counts[k][j]
        new = dict(template)
        for k, s in segments.items():
            if len(s) > level:
                group = kids[k[0], template[k]]
                n, b = group[s[level]]
                all_n, all_b = (sum(v[j] for v in group.values()) for j in (0, 1))
                own = False
                if url_filters.ENOUGH <= n < all_n:
                    p = all_b / all_n
                    own = abs(b / n - (all_b - b) / (all_n - n)) > url_filters.Z * (p * (1 - p) * (1 / n + 1 / (all_n - n))) ** 0.5
                new[k] = template[k] + "/" + (s[level] if len(group) == 1 or own else "*")
        template = new
    return template


def test_url_filters(spark):
    rng = random.Random(1)
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(None, URLS[5], 1), (7, URLS[7], 0), (7, URLS[7], 0)]
    for i in range(600):
        section = rng.choice(["good", "spam", "mixed"])
        bad = {"good": 0, "spam": 1, "mixed": rng.randint(0, 1)}[section]
        rows.append((1000 + i, f"http://site{i % 2}.org/{section}/{i}/{rng.choice('abc')}", bad if rng.random() < 0.8 else None))
    rows += [(5000 + i, f"http://wide.org/slug{'x' * i}/p", i % 2) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, bad int").withColumn("host", F.lit("clash")).withColumn("template", F.lit(1)).repartition(3)
    got = url_filters.judge(pages).collect()
    shapes, counts = {}, defaultdict(lambda: [0, 0])
    for i, u, bad in rows:
        host, path = brute_url(u)
        shapes[i, u] = key = (host, re.sub("[0-9]+", "{n}", path))
        counts[key][0] += bad is not None
        counts[key][1] += bad or 0
    template, totals = brute_templates(counts), defaultdict(lambda: [0, 0])
    for k, t in template.items():
        for j in (0, 1):
            totals[k[0], t][j] += counts[k][j]
    corpus = sum(c[1] for c in counts.values()) / sum(c[0] for c in counts.values())
    want = []
    for i, u, _ in rows:
        host, path = brute_url(u)
        name, verdict = brute_rule(host, path)
        t = template[shapes[i, u]]
        n, b = totals[host, t]
        purity = (b + url_filters.STRENGTH * corpus) / (n + url_filters.STRENGTH)
        want.append((i, host, path, name, verdict or ("block" if purity >= url_filters.PURITY else "allow"), t, round(purity, 9)))
    assert sorted(((*r[:6], round(r[6], 9)) for r in got), key=repr) == sorted(want, key=repr)
    assert {r.verdict for r in got if r.path.startswith("/spam/")} == {"block"} and {r.verdict for r in got if r.path.startswith("/good/")} == {"allow"}
    assert url_filters.judge(pages.limit(0)).count() == 0
    assert url_filters.judge(pages.withColumn("bad", F.lit(None).cast("int"))).filter("rule is null and verdict = 'block'").count() == 0


@pytest.mark.parametrize("clean", [31, 32, 200])
def test_a_bad_section_is_blocked_among_any_number_of_siblings(spark, clean):
    name = lambda i: "s" + "".join("abcdefghij"[int(c)] for c in str(i))  # noqa: E731  digits would make one shape
    rows = [(f"http://host.org/{name(i)}/p{k}", 0) for i in range(clean) for k in range(3)] + [(f"http://host.org/spam/p{k}", 1) for k in range(40)]
    pages = spark.createDataFrame([(i, u, bad) for i, (u, bad) in enumerate(rows)], "page_id long, url string, bad int")
    got = url_filters.judge(pages).collect()
    assert {r.verdict for r in got if "/spam/" in r.path} == {"block"} and {r.verdict for r in got if "/spam/" not in r.path} == {"allow"}


@pytest.mark.parametrize("siblings", [5, 31, 32, 33, 60])
def test_one_labelled_page_is_no_section_at_any_fan_out(spark, siblings):
    name = lambda i: "s" + "".join("abcdefghij"[int(c)] for c in str(i))
    rows = [(f"http://host.org/{name(i)}/p{k}", 0) for i in range(siblings) for k in range(30)] + [("http://host.org/odd/p", 1)]
    pages = spark.createDataFrame([(i, u, bad) for i, (u, bad) in enumerate(rows)], "page_id long, url string, bad int")
    assert {r.template for r in url_filters.judge(pages).filter("path like '/odd/%'").collect()} == {"/*/*"}


def test_very_long_urls(spark):
    rows = [(1, "http://a.org/" + "x/" * 200_000, 1), (2, "http://" + "h" * 300_000, 0), (3, "http://a.org/" + "9" * 500_000, None)]
    got = {r.page_id: r for r in url_filters.judge(spark.createDataFrame(rows, "page_id long, url string, bad int")).collect()}
    assert len(got[1].path) == 400_001 and len(got[2].host) == 300_000 and got[2].verdict == "allow"


def test_page_labels(spark):
    pages = spark.createDataFrame([(1, "http://a/en/12"), (2, "http://a/en/12.html?x=3"), (3, "http://a/en/7/"), (4, None), (5, "http://a/x9/y"), (6, "http://a/" + "9" * 30)], "page_id long, url string")
    labels = spark.createDataFrame([(12, 0, 0), (12, 1, 0), (7, 1, 1), (None, 0, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    assert {r.page_id: r.bad for r in url_filters.with_labels(pages, labels).collect()} == {1: 1, 2: 1, 3: 0, 4: None, 5: None, 6: None}


# Mixing


def brute_mix(rows, weights=(5, 2, 1), epochs=3):
    """rows of (id, source, size): the words taken of each row, in order."""
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget = sum(sizes.values())
    target, free, left = {}, set(order), float(budget)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > epochs * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: float(epochs * sizes[s]) for s in full}
        left -= sum(epochs * sizes[s] for s in full)
        free -= full
    copies, upto = [], defaultdict(int)
    for k in sorted(range(len(rows)), key=lambda k: (id_hash(rows[k][0]), rows[k][0] is not None, rows[k][0] or 0, rows[k][2])):
        _, s, n = rows[k]
        upto[s] += n
        if n:
            copies += [((upto[s] + e * sizes[s]) / target[s], order.index(s), k, n) for e in range(epochs)]
    taken, spent = [0] * len(rows), 0
    for _, _, k, n in sorted(copies):
        spent += n
        if spent > budget:
            break
        taken[k] += n
    return taken, sizes, target


@pytest.mark.parametrize("seed", range(3))
def test_mix(spark, seed):
    rng = random.Random(seed)
    sources = ["hot"] * 9 + ["a", "b", "É", None, "tiny"]
    rows = [(i, rng.choice(sources), rng.choice([0, 1, 5, 30])) for i in range(300)] + [(400, "tiny", 3), (None, "a", 7), (None, "hot", 0), (5, "b", 4), (5, "b", 4), (6, "hot", 2000), (500, "empty", 0)]
    docs = spark.createDataFrame([(i, " ".join(["w"] * n) if n or k % 2 else None, "en", s, 0) for k, (i, s, n) in enumerate(rows)], SCHEMA).withColumn("size", F.lit("clash")).withColumn("ord", F.lit(1))
    taken, sizes, target = brute_mix(rows)
    got = mixing.mix(docs.repartition(5)).collect()
    assert sorted(((r.doc_id, r.size, r.source_size, r.taken) for r in got), key=repr) == sorted(((i, n, sizes[s], t) for (i, s, n), t in zip(rows, taken, strict=True)), key=repr)
    assert all(r.taken <= 3 * r.size for r in got)
    by = {r.source_size: r.target for r in got}
    assert all(abs(by[sizes[s]] - target.get(s, 0)) < 1e-6 for s in sizes)
    mixed = mixing.take(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(i for (i, _, n), t in zip(rows, taken, strict=True) for _ in range(t // n if n else 0))


def test_mix_of_a_hot_id_in_order(spark, monkeypatch):
    """A third of all rows under one id, in chunks and levels of bins: the same rows as one by one, in order of finish time."""
    for name, value in (("CHUNK", 7), ("BINS", 4), ("EDGE_ROWS", 20)):
        monkeypatch.setattr(mixing, name, value)
    rows = [(i, "ab"[i % 2], 1 + i % 5) for i in range(60)] + [(5, "b", 3)] * 40 + [(None, "b", 2)] * 11
    docs = spark.createDataFrame([(i, " ".join(["w"] * n), str(k), s, 0) for k, (i, s, n) in enumerate(rows)], SCHEMA).repartition(5)
    taken, sizes, target = brute_mix(rows)
    got = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in got) == Counter((i, n, t) for (i, _, n), t in zip(rows, taken, strict=True))
    mixed = mixing.take(docs).collect()
    assert Counter((r.doc_id, r.source) for r in mixed) == Counter((i, s) for (i, s, n), t in zip(rows, taken, strict=True) for _ in range(t // n))
    words = defaultdict(int)
    for r in mixed:  # the finish times of a source's copies in the order taken never fall behind another's by a whole document
        words[r.source] += len(r.text.split())
        assert abs(words["a"] / target["a"] - words["b"] / target["b"]) <= 5 / min(target.values()) + 1e-9


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 0), (2, "", "en", None, 0)], SCHEMA)
    assert [(r.size, r.source_size, r.target, r.taken) for r in mixing.mix(docs).collect()] == [(0, 0, 0.0, 0)] * 2
    assert mixing.take(docs).count() == 0 and mixing.mix(docs.limit(0)).count() == 0 and mixing.take(docs.limit(0)).count() == 0


# Sharding


def test_shards(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.choice([0, 10, 50])) for i in range(300)] + [(1, "y" * 40), (None, "z"), (None, None), (777, "long" * 500)] + [(888, "same text of thirty characters")] * 40
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA).withColumn("shard", F.lit("clash")).withColumn("h", F.lit(0)).repartition(6)
    limit = 400
    got = sharding.assign(docs, limit=limit).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((i, len(t or "")) for i, t in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    for name, members in by.items():
        assert sum(r.n_bytes for r in members) == members[0].shard_bytes and len(members) == members[0].shard_docs
        assert members[0].shard_bytes <= limit or len(members) == 1
        bits = name.split("-")[0]
        assert all(f"{id_hash(r.doc_id):060b}".startswith(bits) and len(bits) == r.local_depth for r in members)
        if "-" not in name and bits:  # its parent was too large
            parent = [r for r in got if f"{id_hash(r.doc_id):060b}".startswith(bits[:-1])]
            assert sum(r.n_bytes for r in parent) > limit and len(parent) > 1
    assert len({r.shard for r in got if r.doc_id == 888}) >= 3
    assert {r.shard for r in sharding.assign(docs).collect()} == {""} and sharding.assign(docs.limit(0)).count() == 0


def test_shard_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * 50, "en", "s", 0) for i in range(60)], SCHEMA)
    sharding.write_shards(docs, f"file://{tmp_path}/out", limit=500)
    back = spark.read.parquet(f"file://{tmp_path}/out")
    assert back.count() == 60 and back.groupBy("shard_bits").count().filter("count > 10").count() == 0


@pytest.mark.parametrize("limit", [100, 500, 1 << 20])
def test_shard_files_hold_each_row_once(spark, tmp_path, limit):
    rows = [(1, "a" * 60, "x"), (1, "b" * 60, "y"), (1, "b" * 60, "y"), (None, None, "n"), (2, "", None), (3, "c" * 300, "z")] + [(7, "d" * 50, str(i)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard_bits string").repartition(4)
    name = sharding.write_shards(docs, f"file://{tmp_path}/out", limit=limit)
    back = spark.read.parquet(f"file://{tmp_path}/out").withColumn("of", F.input_file_name())
    assert Counter(tuple(r) for r in back.select(*docs.columns).collect()) == Counter(rows)
    assert name == "shard_bits_" and all(r.b <= limit or r.n == 1 for r in back.groupBy(name).agg(F.sum(F.length("text")).alias("b"), F.count("*").alias("n")).collect() if r.b)
    sharding.write_shards(docs.limit(0), f"file://{tmp_path}/none")
    assert not list((tmp_path / "none").glob("**/*.parquet"))


# Pipeline and queries


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(4)
    word = lambda: f"word{rng.randrange(3000)}"
    clean = [" ".join(word() for _ in range(90)) for _ in range(60)]
    leak = " ".join(f"secret{i}" for i in range(12))
    texts = clean + [clean[0]] * 5 + [clean[1] + f" {leak} " + clean[2], "too short", None, ""] + [" ".join(word() + "###" for _ in range(90)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", 0) for i, t in enumerate(texts)], SCHEMA).withColumn("kept", F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i <= 65), 0) for i in range(len(texts))], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    step, kept = docs, []
    for name, f in corpus_pipeline.STAGES:
        step = f(spark, step, str(tmp_path))
        kept.append((name, step.columns, Counter(r.doc_id for r in step.select("doc_id").collect())))
    assert [k[0] for k in kept] == ["quality_rules", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert all(k[1] == docs.columns for k in kept[:4])
    assert set(kept[0][2]) == set(range(66)) and set(kept[1][2]) == {*range(60), 65} and set(kept[2][2]) == set(range(60))
    assert max(kept[3][2].values()) <= 3 and kept[4][2] == kept[3][2]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == sum(kept[4][2].values())


def test_pipeline_of_odd_rows(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(5)
    text = lambda: " ".join(f"word{rng.randrange(3000)}" for _ in range(70))
    a, b, c, d = (text() for _ in range(4))
    rows = [(1, a), (1, a), (1, b), (None, c), (None, c), (None, None), (5, None), (6, ""), (2, a + " end"), (7, d), (3, d), (8, " ".join(["long"] + [f"w{i}" for i in range(30_000)]))]
    docs = spark.createDataFrame([(i, t, None, None if k % 2 else "s", None) for k, (i, t) in enumerate(rows)], SCHEMA).withColumn("shard", F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    step, kept = docs, {}
    for name, f in corpus_pipeline.STAGES:
        step = corpus_pipeline.stage(f(spark, step, str(tmp_path)), name)
        kept[name] = Counter(r.doc_id for r in step.collect())
    assert kept["quality_rules"] == Counter({1: 3, None: 2, 2: 1, 7: 1, 3: 1, 8: 1})
    assert kept["near_duplicates"] == kept["decontamination"] == Counter({1: 2, None: 1, 3: 1, 8: 1})
    assert set(kept["mixing"]) <= {1, None, 3, 8} and kept["sharding"] == kept["mixing"]
    none = docs.limit(0)
    for name, f in corpus_pipeline.STAGES:
        none = corpus_pipeline.stage(f(spark, none, str(tmp_path)), name)
        assert none.count() == 0 and (name == "sharding" or none.columns == docs.columns)


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))
    assert {n for n in __spark_entry__.oracle_sql() if n.startswith("op")} == {"op2_line_dedup", "op4_warc", "op6_mixing", "op8_sharding", "op11_centroids", "op12_nearest", "op13_hard_negatives"}

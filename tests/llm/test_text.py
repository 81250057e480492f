"""Operators on texts against brute force: rules, line dedup, decontamination, near-duplicates, classifier."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sparquill.llm import classifier, components, decontaminate, line_dedup, near_copies, quality_rules, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t", "one", "one two", "É x É x É x", "a b c a b c", "x\n\nx\nx\n", "\n".join(["same line here"] * 40), "w " * 30_000, "#*$%&|<> ##", "Ab aB AB ab"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, texts, extra=()):
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, *extra], SCHEMA)


def random_texts(seed, n, words=12, lines=False):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    return [("\n" if lines else " ").join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(n)]


# Quality rules


def brute_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) for k in range(3) if grams[tuple(words[i : i + 3])] > 1}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


@pytest.mark.parametrize("seed", range(3))
def test_statistics(seed):
    for t in ODD + random_texts(seed, 60, 5) + random_texts(seed, 30, 4, True):
        assert quality_rules.statistics(t)[:5] == brute_statistics(t), t


def test_rules_learn_keep_clean_rows_and_reject_bad_ones(spark):
    rng = random.Random(1)
    clean = [" ".join(f"word{rng.randrange(5000)}" for _ in range(80)) for _ in range(120)]
    bad = [" ".join(f"word{rng.randrange(5000)}***" for _ in range(80)) for _ in range(60)]
    extra = [(None, clean[0], None, None, None), (3, clean[3], "en", "s", 0), (3, clean[3], "en", "s", 0)]
    docs = corpus(spark, clean + bad + ODD, extra).withColumn("kept", F.lit("clash")).withColumn("n_words", F.lit(1))
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(0, 180, 2)] + [(None, 1, 0), (2, None, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    judged = {r.doc_id: r for r in quality_rules.judge(docs, labels).collect()}
    assert all(judged[i].kept for i in range(120)) and not any(judged[i].kept for i in range(120, 180))
    assert all(judged[180 + i].base_failed for i in range(len(ODD)))
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == sorted([(False, i) for i in range(120)] + [(True, None), (False, 3), (False, 3)])
    none = labels.filter("false")
    assert quality_rules.judge(docs, none).filter("kept").count() == 183 and quality_rules.judge(docs.limit(0), labels).count() == 0


def test_a_rule_needs_purity():
    rng = np.random.default_rng(0)
    x = {"a": rng.random(3000), "b": rng.random(3000)}
    turn = rng.integers(0, 999, 3000)
    assert quality_rules.learn(x, rng.random(3000) < 0.2, turn) == []
    bad = (x["a"] > 0.8) & (x["b"] < 0.5)
    rules = quality_rules.learn(x, bad, turn)
    hit = np.any([quality_rules.covers(r, x, 3000) for r in rules], axis=0)
    assert (hit & ~bad).sum() <= 3 and (hit & bad).sum() >= 0.95 * bad.sum()


def brute_list(x, bad, turn):
    """Sequential covering row by row: grown by information gain, pruned from the end, until a rule is not pure enough."""
    names, rows, out = list(x), list(zip(*x.values(), strict=True)), []
    hit = lambda rule, r: all((r[names.index(k)] > c) if above else (r[names.index(k)] <= c) for k, above, c in rule)
    left = list(range(len(rows)))
    while True:
        grown, held = [i for i in left if turn[i] % 3], [i for i in left if turn[i] % 3 == 0]
        if not any(bad[i] for i in grown):
            return out
        rule, inside = [], grown
        while not all(bad[i] for i in inside):
            p0, best = sum(map(bool, (bad[i] for i in inside))), (1e-9, None)
            n0 = len(inside) - p0
            for j, k in enumerate(names):
                v, y = np.array([rows[i][j] for i in inside]), np.array([bad[i] for i in inside])
                cuts = np.unique(np.quantile(v, np.linspace(0, 1, quality_rules.CUTS + 1)[1:-1]))
                cuts = np.unique(np.concatenate((cuts, np.quantile(v[y], np.linspace(0, 1, 9)) - 1e-9)))
                for above in (True, False):
                    for c in cuts:
                        on = [bad[i] for i in inside if (rows[i][j] > c) == above]
                        p, n = sum(on), len(on) - sum(on)
                        gain = p * (np.log2((p + 1) / (p + n + 2)) - np.log2((p0 + 1) / (p0 + n0 + 2)))
                        if gain > best[0] + 1e-12:
                            best = (gain, (k, above, c))
            if best[1] is None:
                break
            k, above, c = best[1]
            v = [rows[i][names.index(k)] for i in inside]
            rule.append((k, above, (max(a for a in v if a <= c) + min(a for a in v if a > c)) / 2))
            inside = [i for i in grown if hit(rule, rows[i])]
        worth = lambda r: (lambda on: (2 * sum(on) - len(on)) / (len(on) + 1))([bad[i] for i in held if hit(r, rows[i])])
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=[])
        covered = [i for i in left if hit(rule, rows[i])]
        on = [bad[i] for i in covered if turn[i] % 3 == 0]
        wrong = sum(not bad[i] for i in covered if turn[i] % 3)
        if not rule or len(covered) < quality_rules.MIN_COVER or sum(on) < quality_rules.MIN_HELD or (sum(on) + 1) / (len(on) + 1) < quality_rules.MIN_PURITY or wrong > 0.05 * len(covered):
            return out
        out.append(rule)
        left = [i for i in left if i not in set(covered)]


@pytest.mark.parametrize("seed", range(4))
def test_learning_against_covering_row_by_row(seed):
    rng = np.random.default_rng(seed)
    n = 240
    x = {k: np.round(rng.random(n), 2) for k in "abc"}
    bad = (x["a"] > 0.8) | ((x["b"] < 0.3) & (x["c"] > 0.5)) | (rng.random(n) < 0.02 * seed)
    turn = rng.integers(0, 999, n)
    got, want = quality_rules.learn(x, bad, turn), brute_list(x, bad.tolist(), turn.tolist())
    assert [[(k, above, round(float(c), 9)) for k, above, c in r] for r in got] == [[(k, above, round(float(c), 9)) for k, above, c in r] for r in want] and (seed > 1 or got)


def test_many_kinds_of_bad_rows_give_as_many_rules():
    rng = np.random.default_rng(3)
    kinds, each = 20, 60
    x = {f"v{k}": rng.random(kinds * each * 2) for k in range(kinds)}
    bad = np.zeros(kinds * each * 2, bool)
    for k in range(kinds):
        at = slice(k * each, (k + 1) * each)
        x[f"v{k}"][at], bad[at] = 5 + rng.random(each), True
    rules = quality_rules.learn(x, bad, rng.integers(0, 999, len(bad)))
    assert len(rules) > 12 and np.any([quality_rules.covers(r, x, len(bad)) for r in rules], axis=0)[bad].mean() > 0.95


@pytest.mark.parametrize("bound", [60, 20_000])
def test_both_ways_learn_one_list(spark, bound):
    rng = random.Random(2)
    clean = [" ".join(f"word{rng.randrange(5000)}" for _ in range(80)) for _ in range(90)]
    bad = [" ".join(f"word{rng.randrange(5000)}***" for _ in range(80)) for _ in range(60)]
    docs = corpus(spark, clean + bad + ["short"] * 60, [(3, clean[3], "en", "s", 0)] * 30).withColumn("wanted_id", F.lit(1)).withColumn("labelled_id", F.lit(2))
    labels = spark.createDataFrame([(i, int(i < 90), 0) for i in range(400)], "doc_id long, quality int, toxic int")  # some of documents that are not there
    judged = sorted((r.doc_id for r in quality_rules.judge(docs, labels, bound=bound).filter("kept").collect()))
    assert judged == sorted(r.doc_id for r in quality_rules.keep_good(docs, labels, bound=bound).collect()) and 3 in judged


# Line dedup


def brute_lines(rows, run, long=50):
    docs = sorted({(i is None, i or 0, t) for i, t in rows if t is not None}, key=lambda r: (r[0], r[1]))
    seen, out = set(), {}
    for none, i, t in docs:
        lines = t.split("\n")
        gone = set()
        for n in {run, 1}:
            for s in range(len(lines) - n + 1):
                w = tuple(lines[s : s + n])
                if n < run and len(WORD.findall(w[0])) < long:
                    continue
                if w in seen:
                    gone.update(range(s, s + n))
                seen.add(w)
        out[None if none else i] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


def test_lines_are_told_apart_by_two_hashes(spark, monkeypatch):
    """Even if all first hashes collide, unequal passages stay and equal ones go."""
    long = lambda w: " ".join([w] * 55)
    texts = [long("a"), long("b"), "x\ny\nz", "p\n\nq", "r\n\ns", long("a"), "u\nx\ny"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(line_dedup, "line_hashes", lambda line: (F.lit(0).cast("long"), F.xxhash64(F.lit(1), line)))
    assert {r.doc_id: r.text for r in line_dedup.dedup(docs).collect()} == {0: texts[0], 1: texts[1], 2: texts[2], 3: texts[3], 4: texts[4], 5: "", 6: "u"}


def test_sets_are_told_apart_by_two_hashes(spark):
    rows = spark.createDataFrame([(1, 5, 7, 100, 3), (2, 6, 7, 100, 3), (3, 7, 7, 200, 4), (4, 8, 9, 100, 5)], "doc_id long, text_hash long, key long, check long, n long").withColumns({"fp": F.lit(0).cast("long"), "bands": F.array().cast("array<long>"), "sketch": F.lit(None).cast("binary")})
    got = near_copies.named_sets(rows).collect()
    assert sorted((r.key, r.n, r.place.doc_id) for r in got) == [(9, 5, 4), (100, 3, 1), (200, 4, 3)]


@pytest.mark.parametrize("run", [1, 2, 3])
def test_line_dedup(spark, run):
    passage, almost = " ".join(f"p{i}" for i in range(50)), "\t".join(f"p{i}" for i in range(49))
    long = [f"x1\n{passage}\ny1", passage, f"{passage}\n{almost}\nz{passage}", f"x2\n{passage}\n{passage}\ny2", almost, f"q\n{almost}\nr", f"{passage}\na\nb"]
    texts = long + random_texts(run, 25, 4, True) + ["a\nb\nc\nd", "x\na\nb\nc\ny", "a\na\na\na", "\n\n\n", "", None] + ["many\ncopies\nhere"] * 40
    extra = [(None, "a\nb\nc\nq", None, None, None), (1000, "p\nq\nr", "en", "s", 0), (1000, "p\nq\nr", "en", "s", 0)]
    docs = corpus(spark, texts, extra).withColumn("spans", F.lit(1)).withColumn("h", F.lit(2)).repartition(5)
    got = line_dedup.dedup(docs, run=run).collect()
    assert len(got) == len(texts) + 3
    want = brute_lines([*enumerate(texts), (None, "a\nb\nc\nq"), (1000, "p\nq\nr")], run)
    for r in got:
        assert (r.n_lines, r.n_removed, r.text) == want.get(r.doc_id, (0, 0, None)), r
    assert line_dedup.dedup(docs.limit(0)).count() == 0


# Decontamination

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(t):
    return SPLIT.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute_contamination(docs, items):
    windows = {}
    for i, t in items:
        w = fold(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = fold(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (key := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[key]
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_contamination(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        check_contamination(spark)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def check_contamination(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices("alpha beta gamma delta É7 eps".split(), k=rng.choice([1, 2, 4, 7, 9, 10, 11, 25])))) for i in range(12)]
    items += [(3, items[3][1]), (None, "null item of eleven words one two three four five six"), (99, ""), (98, None), (97, "a a a a a a a a a a a a")]
    docs = [(i, t) for i, t in enumerate(ODD + random_texts(7, 10))]
    for k, (_, t) in enumerate(items):
        w = fold(t)
        docs.append((100 + k, "Before, " + "; ".join(x.upper() for x in w) + " after"))
        docs.append((200 + k, " ".join(w[1:])))
        docs.append((300 + k, " ".join(rng.choices("alpha beta gamma delta É7 eps".split(), k=60))))
    docs += [(None, items[0][1]), (5, "one"), (5, "one")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1)).withColumn("n_hit", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(frame.repartition(3), bench)
    want = brute_contamination(docs, items)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    kept = decontaminate.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns and Counter(r.doc_id for r in kept.collect()) == Counter(w[0] for w in want if not w[5])
    assert decontaminate.contamination(frame, bench.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.contamination(frame.limit(0), bench).count() == 0
    odd = spark.createDataFrame([("x\ny", items[8][1]), ("a,b", items[8][1]), ("null", items[9][1])], "item_id string, text string")
    got = decontaminate.contamination(frame, odd).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute_contamination(docs, [tuple(r) for r in odd.collect()]), key=repr)


def test_winnowing_keeps_a_print_of_every_window():
    h = np.random.default_rng(2).integers(0, 9, 400).astype(np.uint64)
    chosen = set(decontaminate.winnow(h, np.arange(395), 6).tolist())
    assert all(max(j for j in range(i, i + 6) if h[j] == h[i : i + 6].min()) in chosen for i in range(395))


# Near-duplicates


def brute_fingerprint(t):
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(codes, distance=3):
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    return {c: find(c) for c in codes}


def test_near_duplicates(spark):
    rng = random.Random(3)
    base = [" ".join(f"v{rng.randrange(300)}" for _ in range(rng.choice([3, 60, 300]))) for _ in range(25)]
    near = [t.replace("v7", "x7", 1) + tail for t in base for tail in ("", " end", " v1 v2")]
    texts = ODD + base + near + ["hot copy of one text here"] * 50
    extra = [(None, base[0], None, None, None), (None, "text of no id at all", None, None, None), (2, " \n\t", "en", "s", 0)]
    docs = corpus(spark, texts, extra).withColumn("fp", F.lit("clash")).withColumn("root", F.lit(0)).repartition(4)
    got = simhash.near_duplicates(docs).collect()
    rows = [*enumerate(texts), (None, base[0]), (None, "text of no id at all"), (2, " \n\t")]
    prints = [(i, brute_fingerprint(t)) for i, t in rows]
    root = brute_roots(sorted({p for _, p in prints}))
    least = {}
    for i, p in prints:
        least[root[p]] = min((x for x in (least.get(root[p]), i) if x is not None), default=None)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=repr) == sorted(((i, f"{p:016x}", least[root[p]]) for i, p in prints), key=repr)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    by_text = {t: brute_fingerprint(t) for _, t in rows}
    assert sorted(root[by_text[r.text]] for r in kept.collect()) == sorted(set(root.values()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.drop_near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("max_group", [16, 8192])
def test_links_connect_dense_groups(spark, max_group):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    flip = lambda: np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    codes = np.unique(np.concatenate([base[rng.integers(0, 3, 300)] ^ flip() ^ flip(), rng.integers(0, 2**63, 200, dtype=np.uint64)]))
    frame = spark.createDataFrame([(int(c.view(np.int64)),) for c in codes], "fp long")
    roots = components.connected_components(simhash.near_links(frame, max_group=max_group))
    got = {r.v & (1 << 64) - 1: r.root for r in roots.collect()}
    want = brute_roots([int(c) for c in codes])
    groups = {}
    for c in map(int, codes):
        groups.setdefault(want[c], set()).add(c)
    for members in groups.values():
        assert len({got.get(c, c) for c in members}) == 1
    assert len({got.get(int(c), int(c)) for c in codes}) == len(groups)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000)]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.v: r.root for r in got} == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}}


def test_whole_nodes_are_linked_without_pairs():
    codes = np.arange(8, dtype=np.uint64)
    index = simhash.GrayIndex(codes, np.zeros(8, int))
    assert sum(x.shape[1] for x in index.links(3)) < 28
    assert len(np.unique(simhash.forest(8, simhash.GrayIndex(codes, np.zeros(8, int)).links(3)))) == 1


# Near copies


def brute_copies(texts):
    """Root of each text among those that links of five-word shingle similarity 0.8 or more reach."""
    sets = [frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) for w in (WORD.findall((t or "").lower()) for t in texts)]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def edited(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_copies_by_five_word_shingles(spark):
    rng = random.Random(6)
    base = [" ".join(f"v{rng.randrange(4000)}" for _ in range(rng.choice([60, 200, 400]))) for _ in range(30)]
    near = [edited(rng, t, k) for t in base for k in (1, len(t.split()) // 50, len(t.split()) // 40, len(t.split()) // 20)]
    star = [edited(rng, base[0], len(base[0].split()) // 50) for _ in range(60)]
    texts = base + near + star + [t.upper() for t in base[:5]] + [None, "", " ", "two words", "Two words"]
    docs = corpus(spark, texts, [(None, base[1], None, None, None), (2, base[2], "en", "s", 0)]).withColumn("key", F.lit("clash")).repartition(4)
    root = brute_copies(texts)
    kept = near_copies.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root))
    assert len(set(root)) < len({brute_fingerprint(t) for t in texts}) and near_copies.drop_near_copies(docs.limit(0)).count() == 0


def test_near_copies_that_share_no_minima(spark):
    """Two texts of similarity 0.8 in which each of 24 bands of four minima has one at the shingle that differs."""
    words = [f"w232667x{j}" for j in range(9)]
    texts = [" ".join(words), "some other words of no copy at all here", " ".join(words[:8])]
    assert brute_copies(texts) == [0, 1, 0]
    assert sorted(r.doc_id for r in near_copies.drop_near_copies(corpus(spark, texts)).collect()) == [0, 1]


def test_similar_sets_share_a_block_and_pass_the_filter():
    """Pairs at the limit of the similarity, by words lost, gained or both, across all numbers of parts."""
    rng = np.random.default_rng(7)
    for n in [*range(4, 70), 102, 103, 127, 128, 129, 200, 255, 256, 409, 410, 512, 3000]:
        hashes = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
        for lost in {0, 1, n // 18, n // 9, n // 5}:
            gained = (5 * (n - lost) - 4 * n) // 4
            if gained >= 0 and lost + gained:
                a, b = np.sort(hashes[:n]), np.sort(hashes[lost : n + gained])
                assert near_copies.similar(a, b) and not near_copies.similar(a, np.sort(hashes[lost : n + gained + 1]))
                assert len(np.intersect1d(near_copies.block_keys(a), near_copies.block_keys(b))), (n, lost)
                parity = np.frombuffer(near_copies.parities(a) + near_copies.parities(b), np.uint64).reshape(2, -1)
                assert near_copies.may_link(np.array([0]), np.array([1]), np.array([len(a), len(b)]), parity).all()


@pytest.mark.parametrize("limits", [(2, 1, 8), (4, 2, 2048)])
def test_near_copies_lose_no_link_in_dense_groups(spark, monkeypatch, limits):
    """One group of copies of copies, in which most of a set's best partners are of its own component already."""
    for name, value in zip(("SMALL", "BEST", "GROUP"), limits, strict=True):
        monkeypatch.setattr(near_copies, name, value)
    rng = random.Random(8)
    base = " ".join(f"v{rng.randrange(4000)}" for _ in range(150))
    texts = [base]
    for _ in range(120):  # each an edit of an earlier one, so that links make long chains as well as a core
        texts.append(edited(rng, texts[rng.randrange(len(texts))], rng.choice([2, 3, 3, 4])))
    root = brute_copies(texts)
    assert 1 < len(set(root)) < len(texts)
    assert sorted(r.doc_id for r in near_copies.drop_near_copies(corpus(spark, texts)).collect()) == sorted(set(root))


def test_near_copies_of_very_long_texts_meet_across_blocks(spark, monkeypatch):
    """A bucket of few but large sets is cut by bytes; its blocks are held against each other all the same."""
    monkeypatch.setattr(near_copies, "GROUP_BYTES", 3000)
    rng = random.Random(9)
    long = " ".join(f"v{rng.randrange(10**6)}" for _ in range(1200))
    texts = [long, edited(rng, long, 10), "other words of no copy at all", edited(rng, long, 12)]
    assert sorted(r.doc_id for r in near_copies.drop_near_copies(corpus(spark, texts)).collect()) == [0, 2]


def test_an_index_finds_all_pairs_of_different_labels():
    rng = np.random.default_rng(5)
    codes, group, label = rng.integers(0, 2**20, 400, dtype=np.uint64), rng.integers(0, 3, 400), rng.integers(0, 40, 400)
    index = simhash.GrayIndex(codes, group)
    got = {tuple(sorted((int(index.order[a]), int(index.order[b])))) for pairs in index.pairs(6, label) for a, b in pairs.T}
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if group[i] == group[j] and label[i] != label[j] and int(codes[i] ^ codes[j]).bit_count() <= 6}
    assert got == want


@pytest.mark.parametrize("batch", [1, 3, 100])
def test_whole_groups(batch):
    import pyarrow as pa

    from sparquill.llm.common import whole_groups

    rows = pa.RecordBatch.from_pydict({"g": [1, 1, 1, 2, 3, 3, 3, 3, 3, 4], "h": [0, 0, 1, 1, 1, 1, 1, 1, 1, 1], "i": list(range(10))})
    tables = list(whole_groups((rows.slice(i, batch) for i in range(0, 10, batch)), 2))
    assert [x for t in tables for x in t["i"].to_pylist()] == list(range(10))
    for key in ((1, 0), (1, 1), (2, 1), (3, 1), (4, 1)):
        assert sum(any(k == key for k in zip(t["g"].to_pylist(), t["h"].to_pylist(), strict=True)) for t in tables) == 1
    assert list(whole_groups(iter([]), 1)) == []


# Classifier


def test_classifier_on_held_out_rows(spark):
    rng = random.Random(9)
    clean = [" ".join(f"word{rng.randrange(900)}" for _ in range(rng.randint(20, 90))) for _ in range(300)]
    bad = [" ".join(f"word{rng.randrange(900)}%%%" for _ in range(60)) for _ in range(150)] + [" ".join(w for w in (f"w{rng.randrange(900)}",) for _ in range(60)) for _ in range(150)]
    docs = corpus(spark, clean + bad + ODD, [(None, clean[0], None, None, None)]).withColumn("score", F.lit("clash")).withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(600)] + [(None, 1, 0), (1, None, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    weights = classifier.fit(docs, labels.filter(~classifier.held_out(F.col("doc_id"))))
    rows = classifier.score(docs, weights).withColumn("held", classifier.held_out(F.col("doc_id"))).collect()
    test = [r for r in rows if r.held and r.doc_id < 600]
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    assert len(test) > 100 and np.mean([(r.predicted == 1) == (r.doc_id < 300) for r in test]) > 0.97
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    again = classifier.score(docs.repartition(7), classifier.fit(docs.repartition(5), labels.filter(~classifier.held_out(F.col("doc_id"))))).collect()
    assert {(r.doc_id, r.score) for r in again} == {(r.doc_id, r.score) for r in rows}
    hot = docs.unionByName(spark.createDataFrame([(7, clean[7], "en", "s", 0)] * 500, SCHEMA).withColumn("score", F.lit("x")).withColumn("label", F.lit(0)))
    assert np.array_equal(classifier.fit(hot.repartition(3), labels), classifier.fit(docs, labels))
    blank = classifier.score(docs, classifier.fit(docs, labels.limit(0)))
    assert {r.score for r in blank.collect()} == {0.5} and classifier.score(docs.limit(0), weights).count() == 0


def test_training_against_one_weight_at_a_time():
    """The same updates in plain numbers, slot by slot."""
    rng = np.random.default_rng(1)
    rows = [(rng.integers(0, 30, rng.integers(0, 12)), int(rng.random() < 0.5)) for _ in range(60)]
    z, n, c = {}, {}, classifier
    weight = lambda i: 0.0 if abs(z.get(i, 0.0)) <= c.L1 else -(z[i] - np.sign(z[i]) * c.L1) / ((c.BETA + n[i] ** 0.5) / c.ALPHA + c.L2)
    good = sum(y for _, y in rows)
    constant = np.log((good + 1) / (len(rows) - good + 1))
    for _ in range(c.EPOCHS):
        for slots, y in rows:
            x = {i: k * c.SCALE / max(1, len(slots)) for i, k in Counter(slots.tolist()).items()}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-(constant + sum(w[i] * v for i, v in x.items()))))
            for i, v in x.items():
                g = (p - y) * v
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / c.ALPHA
                z[i], n[i] = z.get(i, 0.0) + g - sigma * w[i], n.get(i, 0.0) + g * g
    got = c.train(rows)
    assert np.allclose(got[:30], [weight(i) if i in z else 0.0 for i in range(30)], atol=1e-4) and not got[30:-1].any() and abs(got[-1] - constant) < 1e-6

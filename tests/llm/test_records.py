"""Operators whose results are files: token shards and WARC archives."""

from __future__ import annotations

import hashlib
import io
import random
import zlib

import numpy as np
import pytest

from sparquill.llm import token_ids, warc

TEXTS = ["Hello, world.\nFoo bar.", "", None, "a  b", " lead", "x <|endoftext|> y", "don't, É, ça.   z", "one", "tab\tx", "end\n", "日本, 語. 中\n文", "a\n\nb", "1, 2. a1, b,. c.,", "word " * 5000 + "end", "a b c", "\n", " "]


@pytest.fixture(scope="module")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_wavelet_matrix_answers_like_the_plain_sequence():
    rng = np.random.default_rng(0)
    for ids in (rng.integers(0, 50257, 3000), np.zeros(5), np.array([7]), np.empty(0)):
        ids = ids.astype(np.uint16)
        m, names, sizes = token_ids.unpack(token_ids.pack(ids, [1, None], [len(ids), 0]))
        assert (m.sequence() == ids).all() and names.to_pylist() == [1, None] and sizes.tolist() == [len(ids), 0]
        assert [m.access(i) for i in range(0, len(ids), 97)] == ids[::97].tolist()
        for token in {*ids[:3].tolist(), 60000}:
            at = np.flatnonzero(ids == token)
            assert m.count(token) == len(at) and [m.select(token, j) for j in range(len(at))] == at.tolist()
            assert m.rank(token, len(ids) // 2) == (ids[: len(ids) // 2] == token).sum()
    with pytest.raises(IndexError):
        m.access(0)
    with pytest.raises(ValueError):
        token_ids.unpack(b"other")


def test_encoder_gives_the_librarys_ids(tokenizer_path):
    e = token_ids.Encoder(tokenizer_path)
    for _ in range(2):  # the second time from memory
        got = e.encode([t or "" for t in TEXTS])
        assert [np.frombuffer(x, e.kind).tolist() for x in got] == [e.tokenizer.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


@pytest.mark.parametrize("alphabet", ["ab Zé'’.,!-_ \n\t1２ßñʼ中ǅɏɐ ̀%#", "abéZ'.,!%1ɏɐǅñ中    \n"])
def test_encoder_on_random_texts(tokenizer_path, alphabet):
    rng = random.Random(3)
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(4000)]
    e = token_ids.Encoder(tokenizer_path)
    want = [x.ids for x in e.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    got = [x for i in range(0, 4000, 500) for x in e.encode(texts[i : i + 500])]
    assert [np.frombuffer(x, e.kind).tolist() for x in got] == want


def test_token_shards_round_trip(spark, tokenizer_path):
    ids = [5, 3, None, 3, 9, 1, 0, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21]
    docs = spark.createDataFrame(list(zip(ids, TEXTS, ["clash"] * 17, strict=True)), "doc_id long, text string, start string").repartition(3)
    manifest = token_ids.write_shards(docs, tokenizer_path, shard_tokens=10)
    rows = token_ids.read_shards(manifest).orderBy("start").collect()
    tok = token_ids.Encoder(tokenizer_path).tokenizer
    want = {}
    for i, t in zip(ids, TEXTS, strict=True):
        x = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        want.setdefault(i, []).append((len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
    assert [r.doc_id for r in rows] == sorted(ids, key=lambda i: (i is not None, i or 0))
    start = 0
    for r in rows:
        assert r.start == start and (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens
    assert manifest.count() >= 3
    assert token_ids.read_shards(token_ids.write_shards(docs.limit(0), tokenizer_path)).count() == 0


def test_look_ups_over_the_manifest(spark, tokenizer_path):
    docs = spark.createDataFrame([(f"d{i % 5}", t) for i, t in enumerate(TEXTS)] + [("hot", "same text")] * 60 + [(None, "of no id")], "doc_id string, text string").repartition(4)
    manifest = token_ids.write_shards(docs, tokenizer_path, shard_tokens=40)
    rows = token_ids.read_shards(manifest).orderBy("start").collect()
    tok = token_ids.Encoder(tokenizer_path).tokenizer
    plain, owner = [], []
    by_crc = {}
    for t in {t or "" for t in TEXTS} | {"same text", "of no id"}:
        x = [*tok.encode(t, add_special_tokens=False).ids, 2]
        by_crc[zlib.crc32(np.array(x, "<u4").tobytes())] = x
    for r in rows:
        assert r.start == len(plain)
        plain += by_crc[r.ids_crc32]
        owner += [r.doc_id] * r.n_tokens
    again = token_ids.read_shards(token_ids.write_shards(docs.repartition(7), tokenizer_path)).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.ids_crc32) for r in again] == [(r.doc_id, r.start, r.ids_crc32) for r in rows]
    wanted = [2, plain[0], plain[40], 49_999]
    assert {r.token: r.n for r in token_ids.token_counts(manifest, wanted).collect()} == {t: plain.count(t) for t in wanted}
    for t in wanted:
        assert sorted((r.position, r.doc_id) for r in token_ids.occurrences(manifest, t).collect()) == [(i, owner[i]) for i, x in enumerate(plain) if x == t]
    asked = spark.createDataFrame([(i,) for i in [*range(0, len(plain), 7), 7, -1, len(plain)]], "position long")
    assert sorted(map(tuple, token_ids.tokens_at(manifest, asked).collect())) == sorted((i, plain[i]) for i in [*range(0, len(plain), 7), 7])


@pytest.mark.parametrize(("n", "most"), [(0, 1), (1, 1), (7, 3), (511, 300), (512, 2), (513, 70_000), (40_000, 50), (5000, 1)])
def test_many_look_ups_equal_single_ones(monkeypatch, n, most):
    monkeypatch.setattr(token_ids, "MANY", 1000)
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.integers(0, most, n), rng.integers(0, most, n)).astype(np.uint32)  # uneven
    matrix, names, sizes = token_ids.unpack(token_ids.pack(ids, [1], [n]))
    assert (matrix.sequence() == ids).all() and (matrix.accesses(np.arange(n)) == ids).all() and [matrix.access(i) for i in range(0, n, 97)] == ids[::97].tolist()
    for t in {*ids[:20].tolist(), 0, most - 1, most, 1 << 20}:
        want = np.flatnonzero(ids == t)
        got = np.concatenate([*matrix.places(t), np.zeros(0, np.int64)])
        assert (got == want).all() and matrix.count(t) == len(want) and [matrix.select(t, j) for j in range(0, len(want), 501)] == want[::501].tolist()
    for k, ranks in enumerate(matrix.ranks):  # the stored directories
        bits = np.unpackbits(matrix.planes[k], count=n)
        assert ranks.tolist() == [int(bits[: 512 * i].sum()) for i in range(len(ranks))] and matrix.zeros[k] == n - bits.sum()


LONG = "x" * 150
PAGES = [(1, "http://a/", LONG), (2, None, LONG), (3, "http://b/\r\n", "short"), (4, "http://c/", "short"), (None, "http://d/", LONG), (5, " http://é/%0D\n", None), (6, "http://f/", "é" * 60), (7, "http://g/", "é" * 60), (7, "http://g/", "é" * 60), (8, "", ""), (10, "http://e/%0D%20x", "q"), (11, "\t", "q"), (None, "u", "z" * 100), (None, "u", "z" * 100), (9, "u", "long " * 100_000)]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("clash"))
    manifest = warc.write_archives(pages.repartition(3), file_bytes=2000)
    got = warc.read_archives(manifest, with_payload=True).collect()
    groups = {}
    for i, _, h in PAGES:
        groups.setdefault(h or "", []).append(i)
    want = []
    for i, u, h in PAGES:
        raw = (h or "").encode()
        known = [x for x in groups[h or ""] if x is not None]
        first = min(known) if known and len(raw) >= 100 and len(groups[h or ""]) > 1 else None
        to = first if first is not None and i != first else None
        want.append((i, u, len(raw), hashlib.sha256(raw).hexdigest(), "response" if to is None else "revisit", to, (h or "") if to is None else None))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0


def test_warc_ids_of_other_types(spark):
    rows = [("a b", "http://a/", LONG), ("b\r\n", "http://b/", LONG), ("é:1", None, LONG), (None, "http://d/", LONG), ("", "http://e/", "x" * 200_000)]
    got = warc.read_archives(warc.write_archives(spark.createDataFrame(rows, "page_id string, url string, html string"))).collect()
    assert sorted(((r.page_id, r.url, r.payload_bytes, r.refers_to) for r in got), key=repr) == sorted([("a b", "http://a/", 150, None), ("b\r\n", "http://b/", 150, "a b"), ("é:1", None, 150, "a b"), (None, "http://d/", 150, "a b"), ("", "http://e/", 200_000, None)], key=repr)
    dated = spark.sql("SELECT DATE'2024-02-29' AS page_id, 'u' AS url, 'h' AS html")
    assert [(str(r.page_id), r.record_type) for r in warc.read_archives(warc.write_archives(dated)).collect()] == [("2024-02-29", "response")]


def test_warc_reader_is_sequential_and_strict():
    good = warc.member(1, "http://a/", b"payload" * 100, hashlib.sha256(b"payload" * 100).hexdigest(), None)
    two = list(warc.read_records(io.BytesIO(good + good), keep_payload=True))
    assert [x[3] for x in two] == [b"payload" * 100] * 2
    bad = warc.member(1, "http://a/", b"payload", hashlib.sha256(b"other").hexdigest(), None)
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(io.BytesIO(bad)))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_records(io.BytesIO(good[:-20])))
    longer = zlib.decompress(good, 31).replace(b"Content-Length: 700", b"Content-Length: 701")
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    head, block = longer.split(b"\r\n\r\n", 1)
    head = __import__("re").sub(rb"Block-Digest: sha256:[0-9a-f]+", b"Block-Digest: sha256:" + hashlib.sha256(block[:-4]).hexdigest().encode(), head)
    with pytest.raises(ValueError, match="Content-Length of 701"):
        list(warc.read_records(io.BytesIO(press.compress(head + b"\r\n\r\n" + block) + press.flush())))
    plain = zlib.decompress(good, 31)
    for broken in (plain.replace(b"Content-Length: 7", b"Content-Length: 6", 1), plain + b"x"):
        press = zlib.compressobj(6, zlib.DEFLATED, 31)
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(press.compress(broken) + press.flush())))

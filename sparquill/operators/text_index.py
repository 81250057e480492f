"""A stored inverted index of n-grams: which texts hold a word anywhere in them, read from the posting lists of its grams alone.

The index is a folder: `texts` (id, body, text_no), numbered as they lie; `postings` (gram, text_no), one folder a bucket of grams, dealt by blocks
of texts to files that are sorted by gram, so that a frequent gram lies in many files; `counts` (gram, n). A look-up takes the rarest
grams of each word, intersects their posting lists block by block where the texts are read, and holds the texts that are left against the word. Words
shorter than a gram are matched in one pass over the texts by operators.matching instead, so every word gets its exact
result. Case does not count.

A posting moves as one or two bytes of a list of its gram and block, and lies in its file as the distance from the one before; neither the postings
nor what the words have met are ever rows of a shuffle.

Defined results: a null text is not in the index; an empty word is held by every text; a repeated (id, text) counts once; texts of one id
are looked up each by itself; a null word holds nowhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from sparquill.blocks import read_block, write_blocks
from sparquill.operators import matching
from sparquill.sources.files import place
from sparquill.staging import fresh_path, stage

#: Letters of a gram, folders of grams, and how many of a word's grams are intersected.
N, BUCKETS, PICKED = 3, 64, 4
#: Letters of texts whose grams go to one file of a folder; texts of a file, as long as a folder has no more than SPLIT files.
POSTINGS, LISTED, SPLIT = 4_000_000, 8192, 8
#: Bits of a text's number within its block; letters that are cut into grams at once; postings that are written at once.
BITS, LETTERS, HELD = 12, 4_000_000, 1 << 20
#: Words of a file, eighths of the texts that are looked at at once, and words that are looked for in a text one by one.
WORDS, AT_ONCE, MANY = 50_000, 32, 16


def grams(word: Column, n: int = N) -> Column:
    """The different n-grams of a word; null if it is shorter."""
    return F.when(F.length(word) >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(word) - (n - 1)), lambda i: F.substring(word, i, n))))


def _bucket(gram: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def _packed(places: np.ndarray, steps: np.ndarray) -> bytes:
    """Places of texts in a block, in order: the first and the steps from one to the next where these fit a byte."""
    if len(steps) and steps.max() > 255:
        return b"\1" + places.astype("<u2").tobytes()
    return b"\0" + places[:1].astype("<u2").tobytes() + steps.astype(np.uint8).tobytes()


def _places(packed: bytes) -> np.ndarray:
    if packed[0]:
        return np.frombuffer(packed, "<u2", offset=1).astype(np.int64)
    return np.cumsum(np.concatenate([np.frombuffer(packed, "<u2", 1, 1), np.frombuffer(packed, np.uint8, offset=3)]), dtype=np.int64)


def _runs(gram: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where rows of one gram and block begin and end."""
    first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (block[1:] != block[:-1])]))
    return first, np.append(first[1:], len(gram))


def _lists(texts: list[str], places: np.ndarray) -> tuple[list[str], list[bytes]]:
    """The grams of texts of one block, each with the places of the texts that have it."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    met = np.zeros(0x110000, bool)
    met[chars] = True
    alphabet = np.flatnonzero(met)
    k, n = len(alphabet), len(texts)
    if k**N * n >= 1 << 63 and n > 1:  # one number would not hold a gram and its text
        half = n // 2
        return tuple(a + b for a, b in zip(_lists(texts[:half], places[:half]), _lists(texts[half:], places[half:]), strict=True))
    kind = np.uint32 if k**N * n < 1 << 32 else np.uint64
    code = (np.cumsum(met) - 1).astype(kind)[chars]
    of = np.repeat(np.arange(n, dtype=kind), lengths)
    end = len(code) - N + 1
    if end <= 0:
        return [], []
    key = code[:end].copy()
    for i in range(1, N):
        key = key * kind(k) + code[i : end + i]
    key = (key * kind(n) + of[:end])[of[:end] == of[N - 1 :]]
    key.sort()
    key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
    if not len(key):
        return [], []
    gram, at = np.divmod(key, kind(n))
    at = places[at.astype(np.int64)]
    first, last = _runs(gram, np.zeros(len(gram), bool))
    letters = np.empty((len(first), N), np.uint32)
    left = gram[first]
    for i in range(N - 1, -1, -1):
        left, digit = np.divmod(left, kind(k))
        letters[:, i] = alphabet[digit.astype(np.int64)]
    names = letters.tobytes().decode("utf-32-le")
    steps = np.diff(at, prepend=at[:1])
    return [names[i : i + N] for i in range(0, len(names), N)], [_packed(at[s:e], steps[s + 1 : e]) for s, e in zip(first.tolist(), last.tolist(), strict=True)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, block, places) of rows (text_no, body): a row for the texts of a block that are cut at once."""
    for batch in batches:
        nos, texts = batch["text_no"].to_numpy(), batch["body"].to_pylist()
        start, letters = 0, 0
        for i in range(len(texts) + 1):
            if i > start and (i == len(texts) or nos[i] >> BITS != nos[start] >> BITS or letters + len(texts[i]) > LETTERS):
                names, lists = _lists(texts[start:i], nos[start:i] & ((1 << BITS) - 1))
                block = pa.array(np.full(len(names), nos[start] >> BITS))
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), block, pa.array(lists, pa.binary())], ["gram", "block", "places"])
                start, letters = i, 0
            if i < len(texts):
                letters += len(texts[i])


def build(texts: DataFrame, path: str, id_col: str = "id", text_col: str = "text", buckets: int = BUCKETS) -> None:
    """Writes the index of texts under path; what was there is replaced."""
    spark = texts.sparkSession
    rows = texts.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("body")).filter(F.col("body").isNotNull())
    rows = rows.withColumn("text_no", F.monotonically_increasing_id())  # texts of a part have numbers in a row
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/texts")
    rows = spark.read.schema(rows.schema).parquet(f"{path}/texts")
    whole = rows.agg(F.sum(F.length("body")), F.count("*")).first()
    unique = rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    files = max(1, -(-(whole[0] or 0) // (buckets * POSTINGS)), min(SPLIT, -(-whole[1] // LISTED)))  # a text has no more grams than letters
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/postings")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(folder, True)
    system.mkdirs(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Writes each file's postings in their order; a task that is run again replaces what it wrote."""
        fs, root = place(f"{path}/postings")
        kind = pa.schema([("gram", pa.string()), ("text_no", pa.int64())])
        at, out, own, names, lists = None, None, "", [], []

        def flush() -> pa.RecordBatch:
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            gram = pa.DictionaryArray.from_arrays(pa.array(np.repeat(np.arange(len(names), dtype=np.int32), sizes)), pa.array(names, pa.string()))
            out.write_table(pa.table([gram.cast(pa.string()), pa.array(np.concatenate(lists))], schema=kind))
            counted = pa.RecordBatch.from_arrays([pa.array(np.full(len(names), at[0], np.int32)), pa.array(names, pa.string()), pa.array(sizes)], ["bucket", "gram", "n"])
            names.clear(), lists.clear()
            return counted

        def close() -> None:
            out.close()
            fs.move(own, f"{root}/bucket={at[0]}/part-{at[1]:05d}.parquet")

        for batch in batches:
            for bucket, file, gram, block, places in zip(*(batch[c].to_pylist() for c in ("bucket", "file", "gram", "block", "places")), strict=True):
                if (bucket, file) != at:
                    if at is not None:
                        yield flush()
                        close()
                    at, held, own = (bucket, file), 0, f"{root}/bucket={bucket}/_{uuid.uuid4().hex}"
                    fs.create_dir(f"{root}/bucket={bucket}", recursive=True)
                    out = pq.ParquetWriter(own, kind, filesystem=fs, compression="zstd", use_dictionary=["gram"], column_encoding={"text_no": "DELTA_BINARY_PACKED"}, store_schema=False)
                elif held >= HELD:
                    yield flush()
                    held = 0
                names.append(gram)
                lists.append((block << BITS) + _places(places))
                held += len(lists[-1])
        if at is not None:
            yield flush()
            close()

    lists = rows.select("text_no", "body").mapInArrow(_cut, "gram string, block long, places binary")
    dealt = lists.select(_bucket("gram", buckets).alias("bucket"), F.pmod(F.xxhash64("block"), F.lit(files)).cast("int").alias("file"), "gram", "block", "places")
    laid = dealt.repartition(buckets * files, "bucket", "file").sortWithinPartitions("bucket", "file", "gram", "block")
    counts = laid.mapInArrow(write, "bucket int, gram string, n long").groupBy("bucket", "gram").agg(F.sum("n").alias("n"))
    counts.repartition("bucket").sortWithinPartitions("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/counts")
    spark.createDataFrame([(buckets, unique)], "buckets int, unique boolean").coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")
    spark.createDataFrame([], rows.schema).write.mode("overwrite").parquet(f"{path}/schema")


def _stored(spark: SparkSession, path: str, name: str, buckets: list[int]) -> DataFrame:
    """Postings or counts of the named buckets; the folders of others are not read."""
    schema = f"gram string, {'n' if name == 'counts' else 'text_no'} long, bucket int"
    return spark.read.schema(schema).parquet(f"{path}/{name}").filter(F.col("bucket").isin(buckets))


def picked_grams(spark: SparkSession, path: str, words: DataFrame) -> DataFrame:
    """(word, gram, bucket, of): the `of` rarest grams of each word that has grams, if the index has all of them."""
    buckets = spark.read.parquet(f"{path}/layout").first().buckets
    asked = words.select("word", F.explode(grams(F.col("word"))).alias("gram")).withColumn("bucket", _bucket("gram", buckets))
    asked = stage(asked, "grams")
    known = _stored(spark, path, "counts", [r.bucket for r in asked.select("bucket").distinct().collect()])
    word = Window.partitionBy("word")
    rare = asked.join(known, ["bucket", "gram"], "left").withColumn("gone", F.max(F.col("n").isNull()).over(word)).filter(~F.col("gone"))
    rare = rare.withColumn("nth", F.row_number().over(word.orderBy("n", "gram"))).filter(F.col("nth") <= PICKED)
    return stage(rare.select("word", "gram", "bucket", F.max("nth").over(word).alias("of")), "picked")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, block, places) of postings; a gram and block may have several rows."""
    for batch in batches:
        if batch.num_rows:
            nos, gram = batch["text_no"].to_numpy(), batch["gram"].dictionary_encode()
            no, block, places = gram.indices.to_numpy(), nos >> BITS, nos & ((1 << BITS) - 1)
            first, last = _runs(no, block)
            steps = np.diff(places, prepend=places[:1])
            ends = list(zip(first.tolist(), last.tolist(), strict=True))
            rising = [len(s) == 0 or s.min() > 0 for s in (steps[a + 1 : b] for a, b in ends)]
            lists = [_packed(places[a:b], steps[a + 1 : b]) if up else b"\1" + places[a:b].astype("<u2").tobytes() for (a, b), up in zip(ends, rising, strict=True)]
            yield pa.RecordBatch.from_arrays([gram.dictionary.take(pa.array(no[first])), pa.array(block[first]), pa.array(lists, pa.binary())], ["gram", "block", "places"])


def _look_up(spark: SparkSession, path: str, words: DataFrame, hold: bool) -> DataFrame:
    """(asked, id, text_no) of words (asked, word): texts that have the rarest grams of a word and, if asked, hold it.

    The lists of the wanted grams are written by block of texts; a task that reads texts reads the lists of their blocks.
    """
    kinds = spark.read.parquet(f"{path}/schema").schema
    picked = picked_grams(spark, path, words.select("word").distinct())
    out = StructType().add("asked", StringType()).add("id", kinds["id"].dataType).add("text_no", LongType())
    if picked.isEmpty():
        return spark.createDataFrame([], out)
    of = picked.groupBy("word").agg(F.collect_list("gram").alias("grams"))
    paths, folder = write_blocks(words.groupBy("word").agg(F.collect_set("asked").alias("asked")).join(of, "word").select("asked", "word", "grams"), WORDS, name="words"), fresh_path(spark, "lists")
    lists = _stored(spark, path, "postings", [r.bucket for r in picked.select("bucket").distinct().collect()]).select("gram", "text_no")
    met = lists.mapInArrow(_pack, "gram string, block long, places binary").join(picked.select("gram").distinct(), "gram", "left_semi")
    met.repartition("block").sortWithinPartitions("block").write.partitionBy("block").option("compression", "zstd").parquet(folder)
    size = 1 << BITS

    def read_words(path: str) -> tuple[pa.ListArray, list[str], list[str], np.ndarray, ahocorasick.Automaton]:
        """What is asked, the words, all their grams, which of these each has (the last gram stands for those it lacks), and an automaton of the words."""
        rows, built = read_block(path), ahocorasick.Automaton()
        grams, words = rows["grams"].to_pylist(), rows["word"].to_pylist()
        every = sorted({g for gs in grams for g in gs})
        no = {g: i for i, g in enumerate(every)}
        for i, w in enumerate(words):
            built.add_word(w, i)
        built.make_automaton()
        return rows["asked"].combine_chunks(), words, every, np.array([[no[g] for g in [*gs, *[gs[-1]] * (PICKED - len(gs))]] for gs in grams]), built

    def block_bits(block: int) -> dict[str, np.ndarray]:
        """Gram to the bits of the block's texts that have it."""
        fs, name = place(f"{folder}/block={block}")
        found: dict[str, np.ndarray] = {}
        if fs.get_file_info(name).type != pafs.FileType.NotFound:
            rows = pq.read_table(name, columns=["gram", "places"], filesystem=fs, partitioning=None)
            for gram, places in zip(rows["gram"].to_pylist(), rows["places"].to_pylist(), strict=True):
                bits = np.zeros(size, bool)
                bits[_places(places)] = True
                found[gram] = found[gram] | np.packbits(bits) if gram in found else np.packbits(bits)
        return found

    def held(text: np.ndarray, word: np.ndarray, texts: list[str], words: list[str], built: ahocorasick.Automaton) -> tuple[np.ndarray, np.ndarray]:
        """Those pairs whose text holds the word; a text with many words left is passed over once for all of them."""
        out: tuple[list[int], list[int]] = [], []
        edges = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1], [True]])).tolist() if len(text) else [0]
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            body = texts[text[s]]
            found = {w for _, w in built.iter(body)} if e - s > MANY else [w for w in word[s:e].tolist() if words[w] in body]
            out[0].extend([int(text[s])] * len(found))
            out[1].extend(found)
        return np.array(out[0], np.int64), np.array(out[1], np.int64)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, tuple] = {}
        at, bits = None, {}
        for batch in batches:
            nos = batch["text_no"].to_numpy()
            texts = batch["body"].to_pylist() if hold else []
            for block in np.unique(nos >> BITS).tolist():
                if block != at:
                    at, bits = block, block_bits(block)
                here = np.flatnonzero(nos >> BITS == block)
                row, there = np.zeros(size, np.int64), np.zeros(size, bool)
                row[nos[here] & (size - 1)], there[nos[here] & (size - 1)] = here, True
                there, none = np.packbits(there), np.zeros(size // 8, np.uint8)
                for path in paths if bits else ():
                    if path not in kept:
                        kept = {path: read_words(path)}  # those of one file at a time
                    asked, words, every, of, built = kept[path]
                    table = np.stack([bits.get(g, none) for g in every])
                    for first in range(0, size // 8, AT_ONCE):
                        part = slice(first, first + AT_ONCE)
                        if not there[part].any():
                            continue
                        both = table[of[:, 0], part] & there[part]
                        for i in range(1, PICKED):
                            both &= table[of[:, i], part]
                        text, word = np.nonzero(np.unpackbits(both, axis=1).T)
                        text = row[text + 8 * first]
                        if hold:
                            text, word = held(text, word, texts, words, built)
                        if len(word):
                            said = asked.take(pa.array(word))
                            text = text[pc.list_parent_indices(said).to_numpy()]
                            yield pa.RecordBatch.from_arrays([said.flatten(), batch["id"].take(pa.array(text)), pa.array(nos[text])], ["asked", "id", "text_no"])

    return spark.read.parquet(f"{path}/texts").select("id", "text_no", *["body"] * hold).mapInArrow(look, out)


def candidates(spark: SparkSession, path: str, words: DataFrame) -> DataFrame:
    """(word, id, text_no): texts that have the rarest grams of a word."""
    return _look_up(spark, path, words.select(F.col("word").alias("asked"), "word"), False).withColumnRenamed("asked", "word")


def find(spark: SparkSession, path: str, words: DataFrame, word: str = "word") -> DataFrame:
    """(word, id): every text that holds a word, as asked, as a part of itself."""
    asked = stage(words.select(F.col(word).alias("asked"), F.lower(F.col(word)).alias("word")).filter(F.col("word").isNotNull()).distinct(), "words")
    found = _look_up(spark, path, asked.filter(F.length("word") >= N), True).select("asked", "id")
    short = asked.filter(F.length("word") < N)
    if not short.isEmpty():
        texts = spark.read.parquet(f"{path}/texts")
        held = texts.select(F.explode(matching.held(F.col("body"), short.select(F.col("word").alias("keyword")).distinct())).alias("word"), "id")
        found = found.union(held.join(short, "word").select("asked", "id"))
    found = found.withColumnRenamed("asked", word)
    return found if spark.read.parquet(f"{path}/layout").first().unique else found.distinct()  # a text gives a word once

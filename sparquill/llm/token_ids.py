"""Token ids of a corpus in shard files, each one wavelet matrix.

Documents are range-partitioned and sorted by id and text hash (rows equal in both may part anywhere), encoded, and written in shards of about `shard_tokens` tokens, each
document followed by the end id. A shard file holds the sequence as a wavelet matrix: one bit plane for each bit of an
id, from the highest, in which the sequence is stably parted by the bits above; planes are compressed one by one. With
the planes' rank directory (rebuilt on opening) the file answers access, rank, count and select without the ids ever
being stored otherwise, and gives the whole sequence back in one pass a plane.

Files carry a random name and only those in the manifest of finished tasks count, so retried tasks do no harm.

Tokens are looked up over the manifest: `token_counts` and `occurrences` ask each file's matrix, `tokens_at` joins wanted
positions with the shards that hold them and asks those alone.

Defined results: a null text is an empty one (its only token is the end id); null ids come first; ids may be of any type
that sorts; repeated rows are encoded once each, rows of equal id in order of their text's hash; an empty table gives no
file; a position that no shard holds gives no row, one wanted twice gives two.
"""

from __future__ import annotations

import json
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparquill.llm.common import fresh_path, read_file, slices, stage, write_file

SHARD_TOKENS, END_ID, MAX_READERS, READER_SHARDS = 1 << 22, 2, 20_000, 4
MAGIC = b"WVMX3\n"
#: Positions are looked up by stretches of so many tokens.
STRETCH = 1 << 20
#: Places that are looked up together in a shard.
MANY = 1 << 13
#: A worker remembers the ids of this many pieces, and of as many that it met before them.
CACHE = 500_000
_ENCODERS: dict[str, Encoder] = {}
#: A text's first piece begins with HEAD, one after a line end with that; all others follow a space.
HEAD, LEADS = "\r", ("\r", "\n")
#: Signs that may follow a word in a piece: those of ASCII but the apostrophe, which the tokenizer treats in its own way.
SIGNS = string.punctuation.replace("'", "")
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
#: Pieces that only white space at an end or next to other white space leaves.
NOTHING = ("", "\r", "\n")
#: A byte-level tokenizer's alphabet: a printable Latin-1 byte is its own character, the others are those from U+0100 on.
ALPHABET = {b: chr(256 + i) for i, b in enumerate([*range(33), *range(127, 161), 173])}
SPACE = ALPHABET[32]


class Encoder:
    """Encodes texts with a tokenizers file, remembering the ids of pieces between single spaces or line ends.

    A byte-level tokenizer cuts before a space or line end that stands alone between other characters, so the ids of
    a text are those of its pieces one after another. Texts with any other white space, or with the string of a special
    token, are encoded whole. A piece that is a Latin word with signs after it is cut between the two, so the word goes to
    the tokenizer's model by itself, once for all its signs; other pieces go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = [*special, *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]
        state = json.loads(self.tokenizer.to_str())
        cut = state.get("pre_tokenizer") or {}
        self.by_piece = state.get("normalizer") is None and state["model"]["type"] == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"]
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = dict.fromkeys(NOTHING, b"")
        self.older: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}
        self.line_end = self._bytes("\n")

    def _bytes(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _sign(self, text: str) -> bytes:
        if text not in self.signs:
            if len(self.signs) > CACHE // 8:
                self.signs.clear()
            self.signs[text] = self._bytes(text)
        return self.signs[text]

    def _learn(self, pieces: Iterable[str]) -> None:
        """Puts the ids of all these pieces into `known`."""
        known, older, stems, signed = self.known, self.older, {}, []
        for w in pieces:
            if w in older:
                known[w] = older[w]
                continue
            stem = w.rstrip(SIGNS)
            word = stem[1:] if stem[:1] in LEADS else stem
            if word.isascii() and word.isalpha() or LATIN.fullmatch(word):
                if len(stem) < len(w):
                    signed.append((w, stem))
                if stem not in known:
                    stems[stem] = word
            elif w[0] == "\n":
                known[w] = self.line_end + self._bytes(w[1:])
            else:
                known[w] = self._bytes(w[1:] if w[0] == HEAD else f" {w}")
        code, tokenize = "H" if self.kind is np.uint16 else "I", self.model.tokenize
        for stem, word in stems.items():
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(ALPHABET)
            lead = stem[0]
            own = array(code, [t.id for t in tokenize(letters if lead in LEADS else SPACE + letters)]).tobytes()
            known[stem] = self.line_end + own if lead == "\n" else own
        for w, stem in signed:
            known[w] = known[stem] + self._sign(w[len(stem) :])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian integers of the encoder's kind. Pieces are numbered, so a piece that comes
        again is looked up once."""
        if len(self.known) > CACHE:
            self.known, self.older = dict.fromkeys(NOTHING, b""), self.known
        cut = np.array([self.by_piece and not any(s in x for s in self.whole) for x in texts], bool)
        column = pa.array([HEAD + x for x, c in zip(texts, cut, strict=True) if c], pa.string())
        lists = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        starts, numbered = lists.offsets.to_numpy(), lists.flatten().dictionary_encode()
        pieces, which = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        got = list(map(self.known.get, pieces))
        new = [i for i, ids in enumerate(got) if ids is None]
        self._learn([pieces[i] for i in new])
        for i in new:
            got[i] = self.known[pieces[i]]
        data, width = np.frombuffer(b"".join(got), self.kind), np.dtype(self.kind).itemsize
        sizes = np.fromiter(map(len, got), np.int64, len(got)) // width
        n = sizes[which]
        upto = np.concatenate(([0], np.cumsum(n)))
        ids = data[np.repeat((np.cumsum(sizes) - sizes)[which] - upto[:-1], n) + np.arange(upto[-1])].tobytes()
        spaced = np.searchsorted(starts, np.flatnonzero(n == 0), side="right") - 1  # texts with white space at an end or in a row
        bounds = upto[starts] * width
        out = dict(zip(np.flatnonzero(cut).tolist(), (ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)), strict=True))
        odd = {*np.flatnonzero(~cut).tolist(), *np.flatnonzero(cut)[spaced].tolist()}
        return [self._bytes(x) if i in odd else out[i] for i, x in enumerate(texts)]


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _directory(plane: np.ndarray) -> np.ndarray:
    """The ones before each 64 bytes of a plane, and all of them."""
    ones = np.bitwise_count(plane).astype(np.int64)
    return np.concatenate(([0], np.cumsum(np.add.reduceat(ones, np.arange(0, len(ones), 64)) if len(ones) else ones))).astype(np.uint32)


class WaveletMatrix:
    """Bit planes of a sequence of ids, highest bit first; zeros[k] is the number of 0 bits of plane k, ranks[k] its directory:
    the ones before each stretch of 64 bytes, and before the end."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], ranks: list[np.ndarray] | None = None) -> None:
        self.n, self.planes, self.zeros = n, planes, zeros
        self.ranks = ranks if ranks is not None else [_directory(p) for p in planes]
        self._wide: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        bits, planes, zeros, row = max(1, int(ids.max(initial=0)).bit_length()), [], [], ids
        for b in range(bits - 1, -1, -1):
            set_ = (row & row.dtype.type(1 << b)) != 0
            planes.append(np.packbits(set_))
            zeros.append(len(row) - int(set_.sum()))
            values, ones = pa.array(row), pa.array(set_)
            row = np.concatenate((pc.filter(values, pc.invert(ones)).to_numpy(), pc.filter(values, ones).to_numpy()))
        return cls(len(ids), planes, zeros)

    def sequence(self) -> np.ndarray:
        bits = len(self.planes)
        kind = np.uint16 if bits <= 16 else np.uint32
        row = np.zeros(self.n, kind)
        for k in range(bits - 1, -1, -1):
            set_, z = np.unpackbits(self.planes[k], count=self.n).view(bool), self.zeros[k]
            before = np.empty_like(row)
            before[np.flatnonzero(~set_)] = row[:z]
            before[np.flatnonzero(set_)] = row[z:] | kind(1 << (bits - 1 - k))
            row = before
        return row

    def _rank1(self, k: int, i: int) -> int:
        """Ones among the first i bits of plane k: a directory entry and a short count after it."""
        byte, plane = i >> 3, self.planes[k]
        block = byte >> 6
        count = int(self.ranks[k][block]) + int(np.bitwise_count(plane[block << 6 : byte]).sum())
        return count + (int(plane[byte]) >> (8 - (i & 7))).bit_count() if i & 7 else count

    def _stretches(self, k: int) -> np.ndarray:
        """Plane k as rows of 64 bytes, with zeros after its end."""
        if k not in self._wide:
            wide = np.zeros((len(self.planes[k]) // 64 + 1) * 64, np.uint8)
            wide[: len(self.planes[k])] = self.planes[k]
            self._wide[k] = wide.reshape(-1, 64)
        return self._wide[k]

    def _ranks1(self, k: int, at: np.ndarray) -> np.ndarray:
        """_rank1 of many places."""
        byte, rows = at >> 3, self._stretches(k)
        whole = np.where(np.arange(64) < (byte & 63)[:, None], np.bitwise_count(rows[byte >> 6]), 0).sum(1, dtype=np.int64)
        part = np.bitwise_count(rows[byte >> 6, byte & 63].astype(np.uint16) >> (8 - (at & 7)).astype(np.uint16))
        return self.ranks[k][byte >> 6].astype(np.int64) + whole + part

    def _selects(self, k: int, want: np.ndarray, one: int) -> np.ndarray:
        """Places of the bits `one` of plane k with the numbers `want` (from 0): the stretch by the directory, then within it."""
        before = self.ranks[k].astype(np.int64)
        before = before if one else 512 * np.arange(len(before)) - before
        block = np.searchsorted(before, want, side="right") - 1
        bits = np.unpackbits(self._stretches(k)[block], axis=1)
        met = np.cumsum(bits if one else 1 - bits, axis=1, dtype=np.int16)
        return 512 * block + (met == (want - before[block] + 1)[:, None]).argmax(1)

    def accesses(self, places: np.ndarray) -> np.ndarray:
        """The ids at many places."""
        out = np.empty(len(places), np.int64)
        for lo in range(0, len(places), MANY):
            at = places[lo : lo + MANY].astype(np.int64)
            value = np.zeros(len(at), np.int64)
            for k in range(len(self.planes)):
                bit = (self.planes[k][at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
                ones = self._ranks1(k, at)
                value, at = value << 1 | bit, np.where(bit, self.zeros[k] + ones, at - ones)
            out[lo : lo + MANY] = value
        return out

    def places(self, token: int) -> Iterator[np.ndarray]:
        """The places of a token in order, some at a time: its range below the last plane, carried up plane by plane."""
        lo, hi = self._range(token, self.n)
        bits = len(self.planes)
        for first in range(lo, hi, MANY):
            at = np.arange(first, min(hi, first + MANY))
            for k in range(bits - 1, -1, -1):
                one = token >> (bits - 1 - k) & 1
                at = self._selects(k, at - self.zeros[k] * one, one)
            yield at

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k in range(len(self.planes)):
            bit = int(self.planes[k][i >> 3]) >> (7 - (i & 7)) & 1
            ones = self._rank1(k, i)
            value, i = value << 1 | bit, self.zeros[k] + ones if bit else i - ones
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """The positions below the last plane of the occurrences of token among the first i."""
        lo, hi, bits = 0, i, len(self.planes)
        if token >> bits:
            return 0, 0
        for k in range(bits):
            one_lo, one_hi = self._rank1(k, lo), self._rank1(k, hi)
            lo, hi = (self.zeros[k] + one_lo, self.zeros[k] + one_hi) if token >> (bits - 1 - k) & 1 else (lo - one_lo, hi - one_hi)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """Occurrences of token among the first i ids."""
        lo, hi = self._range(token, min(i, self.n))
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, j: int) -> int:
        """Position of the occurrence number j (from 0) of token."""
        lo, hi = self._range(token, self.n)
        if not 0 <= j < hi - lo:
            raise IndexError(j)
        at, bits = lo + j, len(self.planes)
        for k in range(bits - 1, -1, -1):
            one = token >> (bits - 1 - k) & 1
            want, low, high = at - self.zeros[k] * one, 0, self.n
            while low < high:  # the smallest prefix that holds want + 1 such bits
                mid = (low + high) // 2
                ones = self._rank1(k, mid + 1)
                low, high = (low, mid) if (ones if one else mid + 1 - ones) > want else (mid + 1, high)
            at = low
        return at


def pack(ids: np.ndarray, doc_ids: list, sizes: list[int], kind: pa.DataType | None = None) -> bytes:
    """A shard file: magic, length and JSON of the header, then compressed document ids (as an Arrow stream), sizes, planes and
    the planes' rank directories."""
    matrix, press, names = WaveletMatrix.build(ids), zstandard.ZstdCompressor(level=1).compress, pa.BufferOutputStream()
    batch = pa.record_batch([pa.array(doc_ids, kind)], ["doc_id"])
    with pa.ipc.new_stream(names, batch.schema) as out:
        out.write_batch(batch)
    parts = [press(names.getvalue().to_pybytes()), press(np.array(sizes, "<u8").tobytes()), *(press(p.tobytes()) for p in matrix.planes), *(press(r.astype("<u4").tobytes()) for r in matrix.ranks)]
    head = json.dumps({"tokens": len(ids), "zeros": matrix.zeros, "parts": [len(p) for p in parts]}).encode()
    return MAGIC + struct.pack("<I", len(head)) + head + b"".join(parts)


def unpack(data: bytes) -> tuple[WaveletMatrix, pa.Array, np.ndarray]:
    """The matrix of a shard file, its document ids and their sizes in tokens."""
    if not data.startswith(MAGIC):
        raise ValueError("not a shard file")
    at = len(MAGIC) + 4
    (n,) = struct.unpack_from("<I", data, at - 4)
    head, at, parts, open_ = json.loads(data[at : at + n]), at + n, [], zstandard.ZstdDecompressor().decompress
    for size in head["parts"]:
        parts.append(open_(data[at : at + size]))
        at += size
    n_planes = len(head["zeros"])
    planes = [np.frombuffer(p, np.uint8) for p in parts[2 : 2 + n_planes]]
    ranks = [np.frombuffer(p, "<u4") for p in parts[2 + n_planes :]]
    names = pa.ipc.open_stream(parts[0]).read_all().column(0).combine_chunks()
    return WaveletMatrix(head["tokens"], planes, head["zeros"], ranks), names, np.frombuffer(parts[1], "<u8").astype(np.int64)


def write_shards(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS, folder: str | None = None) -> DataFrame:
    """Encodes and writes all documents; returns the staged manifest (part, seq, path, n_docs, n_tokens, first_id) in corpus
    order."""
    folder = folder or fresh_path(docs.sparkSession, "tokens")
    order = (F.col("doc_id"), F.xxhash64("text"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, seq, ids, names, sizes, total, kind = context.partitionId(), 0, [], [], [], 0, None
        encode = encoder(tokenizer_path)
        end, width = np.array([end_id], encode.kind).tobytes(), np.dtype(encode.kind).itemsize

        def flush() -> pa.RecordBatch:
            path = f"{folder}/{part:06d}-{seq:06d}-{context.taskAttemptId()}.wvm"
            write_file(path, pack(np.frombuffer(b"".join(ids), encode.kind), names, sizes, kind))
            return pa.RecordBatch.from_arrays([pa.array([part]), pa.array([seq]), pa.array([path]), pa.array([len(names)]), pa.array([total]), pa.array(names[:1], kind)], ["part", "seq", "path", "n_docs", "n_tokens", "first_id"])

        for whole in batches:
            kind = whole.schema.field(0).type
            for batch in slices(whole, 1):
                coded = encode.encode([x or "" for x in batch.column(1).to_pylist()])
                for name, x in zip(batch.column(0).to_pylist(), coded, strict=True):
                    ids += (x, end)
                    names.append(name)
                    sizes.append(len(x) // width + 1)
                    total += sizes[-1]
                    if total >= shard_tokens:
                        yield flush()
                        seq, ids, names, sizes, total = seq + 1, [], [], [], 0
        if names:
            yield flush()

    return stage(rows.mapInArrow(run, f"part long, seq long, path string, n_docs long, n_tokens long, first_id {rows.schema['doc_id'].dataType.simpleString()}"), "manifest")


def _files(manifest: DataFrame) -> DataFrame:
    """(path, base, n_tokens), a row a shard; base is the number of tokens before it. A part's tokens are summed first, so
    that only one row a part is in the running sum."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("ahead"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("inside", F.coalesce(inside, F.lit(0))).join(parts, "part").select("path", (F.col("ahead") + F.col("inside")).alias("base"), "n_tokens")


def _readers(manifest: DataFrame) -> int:
    return max(1, min(-(-manifest.count() // READER_SHARDS), MAX_READERS))


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard) of every document, read back from the shard files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                matrix, names, sizes = unpack(read_file(path))
                data, ends = matrix.sequence().astype("<u4"), np.cumsum(sizes)
                crc = [zlib.crc32(data[e - n : e].tobytes()) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([names, pa.array(base + ends - sizes), pa.array(sizes), pa.array(crc, pa.int64()), pa.array([path.rsplit("/", 1)[1]] * len(names))], ["doc_id", "start", "n_tokens", "ids_crc32", "shard"])

    kind = manifest.schema["first_id"].dataType.simpleString()
    return _files(manifest).repartition(_readers(manifest), "path").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long, shard string")


def token_counts(manifest: DataFrame, tokens: Iterable[int]) -> DataFrame:
    """(token, n): how often the corpus holds each of some tokens, by two ranks a plane and shard."""
    wanted = sorted(set(tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                matrix = unpack(read_file(path))[0]
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array([matrix.count(t) for t in wanted], pa.int64())], ["token", "n"])

    counted = manifest.select("path").repartition(_readers(manifest), "path").mapInArrow(run, "token long, n long")
    every = manifest.sparkSession.createDataFrame([(t, 0) for t in wanted], "token long, n long")
    return counted.union(every).groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(manifest: DataFrame, token: int) -> DataFrame:
    """(doc_id, position): every place of a token in the corpus, by select in each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                matrix, names, sizes = unpack(read_file(path))
                for at in matrix.places(token):
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(np.searchsorted(np.cumsum(sizes), at, side="right"))), pa.array(base + at)], ["doc_id", "position"])

    return _files(manifest).repartition(_readers(manifest), "path").mapInArrow(run, f"doc_id {manifest.schema['first_id'].dataType.simpleString()}, position long")


def tokens_at(manifest: DataFrame, positions: DataFrame) -> DataFrame:
    """(position, token) for positions (position long) of the corpus: each shard that holds some is opened in as many tasks
    as its stretches are dealt to, and each position is one access."""
    files = _files(manifest).withColumn("stretch", F.explode(F.sequence(F.expr(f"base div {STRETCH}"), F.expr(f"(base + n_tokens - 1) div {STRETCH}"))))
    asked = positions.select("position", F.expr(f"position div {STRETCH}").alias("stretch"))
    held = asked.join(files, "stretch").filter("position >= base and position < base + n_tokens").select("path", "base", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, matrix = None, None
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # rows of a shard lie together
                same = pc.equal(batch.column(0), batch.column(0)[at])
                some = batch.filter(same)
                if batch.column(0)[at].as_py() != path:
                    path = batch.column(0)[at].as_py()
                    matrix = unpack(read_file(path))[0]
                yield pa.RecordBatch.from_arrays([some.column(2), pa.array(matrix.accesses(pc.subtract(some.column(2), some.column(1)).to_numpy()))], ["position", "token"])
                at += some.num_rows

    return held.repartition("path", F.expr(f"position div {STRETCH // 16}")).sortWithinPartitions("path").mapInArrow(run, "position long, token long")

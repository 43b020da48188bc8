"""Token ids of whole documents in wavelet-matrix files, one per shard of the corpus.

``write_shards`` deals documents by ranges of doc_id, encodes each range in doc_id order and
packs every block of about ``SHARD_TOKENS`` ids into one compressed file image: a wavelet
matrix (one bit-plane per bit of the largest id, in pieces of 32 KiB that are compressed one by
one), its rank directory (ones before each 512 bits, a sixteenth of the planes) and the documents'
ids and lengths. Spark's Parquet writer stores the images in the shared folder, one row each, so
a lost executor only repeats its range. ``read_documents`` opens the images again.

``Shard`` answers from one image: the id at a position, ids of a range, how often an id
occurs before a position (rank), where its k-th occurrence is (select), all occurrences. It
unpacks only the pieces that an answer touches: one a plane for a rank.

Edge cases: a null or empty text is its end id alone; a null doc_id sorts first and stays
null; repeated doc_ids are ordered by text; a document longer than a block is a block by
itself; an empty table gives no images and no rows; other columns of the table are ignored.
"""

from __future__ import annotations

import codecs
import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from satlink.llm import common as C

SHARD_TOKENS = 4 << 20
CACHE_CHUNKS = 350_000
#: Bytes of (compressed) input for one range of documents.
RANGE_BYTES = 16 << 20
#: Bytes of text whose parts are told apart at once.
_BATCH_BYTES = 4 << 20
_JOINED = 1024  # new parts that the tokenizer gets at once
_BETWEEN = "\0"
#: What a byte is to the cuts between parts. OTHER: control characters and all but ASCII (Latin-1 letters are found in pairs).
_SPACE, _LETTER, _DIGIT, _MARK, _QUOTE, _OTHER = range(6)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[33:127] = _MARK
for _bytes, _class in ((b" \n\r\t", _SPACE), (b"0123456789", _DIGIT), (b"'", _QUOTE), (bytes([*range(65, 91), *range(97, 123)]), _LETTER)):
    _CLASS[list(_bytes)] = _class
#: Whether a part starts at a byte of one class (second index) after one of another (first index).
_CUT = np.zeros((8, 8), bool)
_CUT[_SPACE] = True
_CUT[_LETTER, [_DIGIT, _MARK, _QUOTE]] = True
_CUT[_DIGIT, [_LETTER, _DIGIT, _MARK, _QUOTE]] = True
_CUT[_MARK, [_LETTER, _DIGIT]] = True
_CUT[_QUOTE, _DIGIT] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MAGIC = b"WMX2"
#: Bits between two entries of the rank directory, and bytes of a plane in one compressed piece.
STEP, PIECE = 512, 32 << 10
#: Ids that pack() parts by a bit at once.
_RUN = 64 << 10
#: Unpacked pieces that an open shard keeps.
_KEPT = 256
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


# ------------------------------------------------------------------------------ one file

def pack(ids: np.ndarray, doc_ids: np.ndarray, no_id: np.ndarray, lengths: np.ndarray) -> bytes:
    """The file image of a block of documents: ``ids`` of all of them, in order."""
    n = len(ids)
    levels = max(1, int(ids.max()).bit_length()) if n else 1
    now = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    zeros = []
    parts = [squeeze(np.ascontiguousarray(doc_ids, "<i8").tobytes()), squeeze(np.packbits(no_id).tobytes()), squeeze(lengths.astype("<u4").tobytes())]
    directory = []
    for level in range(levels - 1, -1, -1):
        bit = (now & now.dtype.type(1 << level)) != 0
        plane = np.packbits(bit, bitorder="little")
        parts += [squeeze(plane[at : at + PIECE].tobytes()) for at in range(0, len(plane), PIECE)]
        directory.append(_directory(plane))
        zeros.append(n - np.count_nonzero(bit))
        now = _parted(now, bit, zeros[-1])
    head = struct.pack(f"<4sQQI{levels}Q{len(parts)}Q", _MAGIC, n, len(doc_ids), levels, *zeros, *map(len, parts))
    return head + b"".join(d.astype("<u4").tobytes() for d in directory) + b"".join(parts)


def _parted(now: np.ndarray, bit: np.ndarray, zeros: int) -> np.ndarray:
    """The elements without the bit, then those with it, in order; done by runs that stay in the processor's cache."""
    out, at = np.empty_like(now), [0, zeros]
    for begin in range(0, len(now), _RUN):
        run, ones = now[begin : begin + _RUN], bit[begin : begin + _RUN]
        for side, those in enumerate((np.flatnonzero(~ones), np.flatnonzero(ones))):
            run.take(those, out=out[at[side] : at[side] + len(those)], mode="clip")
            at[side] += len(those)
    return out


def _directory(plane: np.ndarray) -> np.ndarray:
    """Ones before each STEP bits of a plane."""
    ones = np.add.reduceat(_ONES[plane], np.arange(0, len(plane), STEP // 8), dtype=np.int64) if len(plane) else np.zeros(0, np.int64)
    return np.cumsum(ones) - ones


class Shard:
    """An opened file image: what an answer needs is read from the image itself."""

    def __init__(self, image: bytes):
        magic, self.n, self.n_docs, self.levels = struct.unpack_from("<4sQQI", image)
        if magic != _MAGIC:
            raise ValueError("not a wavelet-matrix file")
        self._image = image
        at = struct.calcsize("<4sQQI")
        self.zeros = struct.unpack_from(f"<{self.levels}Q", image, at)
        at += 8 * self.levels
        bytes_ = -(-self.n // 8)
        self._pieces, steps = -(-bytes_ // PIECE), -(-bytes_ // (STEP // 8))
        sizes = struct.unpack_from(f"<{3 + self.levels * self._pieces}Q", image, at)
        at += 8 * len(sizes)
        #: Ones before each step, a view of the file.
        self.directory = np.frombuffer(image, "<u4", self.levels * steps, at).reshape(self.levels, steps)
        at += 4 * self.levels * steps
        self._at = (at + np.cumsum([0, *sizes])).tolist()
        self._loose = zstandard.ZstdDecompressor().decompress
        self._open: dict[int, bytes] = {}
        self.doc_ids = np.frombuffer(self._part(0), "<i8")
        self.no_id = np.unpackbits(np.frombuffer(self._part(1), np.uint8), count=self.n_docs).astype(bool)
        self.lengths = np.frombuffer(self._part(2), "<u4").astype(np.int64)

    def _part(self, i: int) -> bytes:
        return self._loose(self._image[self._at[i] : self._at[i + 1]])

    def _piece(self, level: int, byte: int) -> bytes:
        """The unpacked piece of a plane that holds a byte."""
        i = 3 + level * self._pieces + byte // PIECE
        found = self._open.get(i)
        if found is None:
            if len(self._open) >= _KEPT:
                self._open.clear()
            found = self._open[i] = self._part(i)
        return found

    def plane(self, level: int) -> np.ndarray:
        first = 3 + level * self._pieces
        return np.frombuffer(b"".join(self._part(i) for i in range(first, first + self._pieces)), np.uint8)

    def _before(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane: the directory's entry and the bits since."""
        step, rest = divmod(i, STEP)
        if not rest:
            if i < self.n:
                return int(self.directory[level][step])
            return self.n - self.zeros[level]
        begin = step * (STEP // 8)
        piece = self._piece(level, begin)
        begin %= PIECE
        bits = int.from_bytes(piece[begin : begin + STEP // 8], "little") & ((1 << rest) - 1)
        return int(self.directory[level][step]) + bits.bit_count()

    def _bit(self, level: int, i: int) -> int:
        return self._piece(level, i >> 3)[(i >> 3) % PIECE] >> (i & 7) & 1

    def __getitem__(self, i: int) -> int:
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = self._bit(level, i)
            ones = self._before(level, i)
            i = zeros + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences before ``end`` stand in the last order."""
        lo, hi = 0, end
        for level, zeros in enumerate(self.zeros):
            a, b = self._before(level, lo), self._before(level, hi)
            lo, hi = (zeros + a, zeros + b) if token >> (self.levels - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, end: int | None = None) -> int:
        """How often ``token`` occurs before position ``end``."""
        if token < 0 or token >> self.levels:
            return 0
        lo, hi = self._range(token, self.n if end is None else end)
        return hi - lo

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``."""
        if not 0 <= k < self.rank(token):
            raise IndexError(k)
        i = self._range(token, self.n)[0] + k
        for level in range(self.levels - 1, -1, -1):
            one = token >> (self.levels - 1 - level) & 1
            want = i - self.zeros[level] if one else i
            lo, hi = 0, self.n - 1  # the bit with `want` equal bits before it
            while lo < hi:
                mid = (lo + hi) // 2
                ones = self._before(level, mid + 1)
                if (ones if one else mid + 1 - ones) > want:
                    hi = mid
                else:
                    lo = mid + 1
            i = lo
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.rank(token))]

    def tokens(self) -> np.ndarray:
        """All ids, in order: the planes undone from the last to the first."""
        now = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            bit = np.unpackbits(self.plane(level), count=self.n, bitorder="little").astype(bool)
            zeros = self.zeros[level]
            back = np.empty_like(now)
            back[np.flatnonzero(~bit)] = now[:zeros]
            back[np.flatnonzero(bit)] = now[zeros:] | now.dtype.type(1 << (self.levels - 1 - level))
            now = back
        return now


# ------------------------------------------------------------------------------ encoding

class Encoder:
    """The tokenizer with a bounded cache of the parts that texts consist of.

    The tokenizer lower-cases, keeps no white space, looks at nothing across it, and always
    parts letters, single digits and marks from one another. So the ids of a text are the ids of
    its parts, one after the other, whichever white space is between them. Texts are cut at white
    space and where an ASCII or Latin-1 letter, an ASCII digit and an ASCII mark meet, and capitals
    are lowered before, which leaves few different parts; a batch's parts are told apart and its
    ids put together by Arrow. Never cut: beside any other letter, mark or control character, and
    between an apostrophe and a letter ('s is one word); never lowered: a capital before such a
    character, which it may be composed with.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = self.tokenizer.model
        # Bytes as the letters that the vocabulary is written in: printable ones as they are, the rest from 256 on.
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        letters = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        #: The space stays: it parts words, none holds it.
        self.letters = "".join(letters.get(b, chr(b)) if b != 32 else " " for b in range(256))
        self.known = C.TwoGenerations(CACHE_CHUNKS)
        # A part of its own that no other text encodes to: a zero byte.
        self.between = self._ids(_BETWEEN)
        self.joins = len(self.between) == 1

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return self.column(pa.array(texts, pa.string()))

    def column(self, texts: pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text of an Arrow column."""
        data, offsets = C.utf8(texts)
        data, starts, first = _parts(data, offsets)
        parts = pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(data)]).dictionary_encode()
        self.known.turn()
        ids = pa.array(self._known(parts.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(parts.indices)
        _, ends, found = ids.buffers()
        at = np.frombuffer(ends, np.int64)[first].tolist() if len(ids) else [0] * len(first)
        found = found.to_pybytes() if found is not None else b""
        return [found[a:b] for a, b in zip(at, at[1:])]

    def _known(self, parts: list[bytes]) -> list[bytes]:
        """Ids of different parts: what no text had yet is encoded."""
        found = list(map(self.known.get, parts))
        lacking = [i for i, ids in enumerate(found) if ids is None]
        self._learn(self.known.lacking([parts[i] for i in lacking]))
        for i in lacking:
            found[i] = self.known[parts[i]]
        return found

    def _learn(self, new: list[bytes]) -> None:
        words, others = [], []
        for part in new:
            if (part.isalpha() and part.islower()) or self._is_word(text := part.decode()):
                words.append(part)
            elif self.joins and "\0" not in text and "<|" not in text:
                others.append(text)
            else:
                self.known[part] = np.array(self._ids(text), "<u4").tobytes()
        for at in range(0, len(words), _JOINED):
            self._learn_words(words[at : at + _JOINED])
        for at in range(0, len(others), _JOINED):
            self._learn_joined(others[at : at + _JOINED])

    @staticmethod
    def _is_word(part: str) -> bool:
        """Whether a part is only letters that normalization leaves as they are: then it is one word to the model."""
        return part.isalpha() and part.islower() and part == part.lower() and unicodedata.is_normalized("NFC", part)

    def _learn_words(self, words: list[bytes]) -> None:
        """Ids of words from the model alone."""
        found = list(map(self.words.tokenize, codecs.charmap_decode(b" ".join(words), "strict", self.letters)[0].split(" ")))
        ends = np.cumsum([4 * len(tokens) for tokens in found]).tolist()
        data = np.array([t.id for tokens in found for t in tokens], "<u4").tobytes()
        self.known.update(zip(words, [data[a:b] for a, b in zip([0, *ends], ends)]))

    def _learn_joined(self, parts: list[str]) -> None:
        """Encode parts as one text, the zero byte between them, and cut its ids there."""
        found = self.tokenizer.encode_batch_fast([f" {_BETWEEN} ".join(parts)], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4")
        cuts = np.flatnonzero(ids == self.between[0])
        starts, ends = (4 * np.append(0, cuts + 1)).tolist(), (4 * np.append(cuts, len(ids))).tolist()
        data = ids.tobytes()
        self.known.update(zip(map(str.encode, parts), [data[a:b] for a, b in zip(starts, ends)]))


def _parts(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut texts: bytes of all parts without white space, where each starts there (and their end), each text's first part."""
    n = len(text)
    kind, low = _CLASS[text], _LOWER[text]
    after = np.append(text[1:], np.uint8(0))
    composes = (after >= 0x80) & (after != 0xC3)  # may change the letter before it; U+00C0 to U+00FF do not
    held = np.flatnonzero(composes & (low != text))
    low[held] = text[held]
    lead = np.flatnonzero(text == 0xC3)
    second = text[lead + 1]
    letters = lead[(second != 0x97) & (second != 0xB7)]  # all but the signs for times and divided
    kind[letters] = kind[letters + 1] = _LETTER
    capital = lead[(second < 0x9F) & (second != 0x97)] + 1
    low[capital[~composes[capital]]] += 32
    special = np.flatnonzero((text == ord("<")) & (after == ord("|")))
    for i in np.unique(np.searchsorted(offsets, special, "right") - 1).tolist():
        # May hold a special token, which is known by its case: cut at white space only.
        a, b = offsets[i], offsets[i + 1]
        low[a:b] = text[a:b]
        kind[a:b][kind[a:b] != _SPACE] = _OTHER
    keep = kind != _SPACE
    cut = np.empty(n, bool)
    cut[1:] = _CUT.ravel()[(kind[:-1] << 3) | kind[1:]]
    cut[offsets[:-1][offsets[:-1] < n]] = True
    cut &= keep
    first = np.searchsorted(np.flatnonzero(cut), offsets)
    starts = np.flatnonzero(cut[keep])
    data = low[keep]
    return data, np.append(starts, len(data)).astype(np.int32), first


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    C.keeps("wavelet", _encoders.clear)
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# --------------------------------------------------------------------------------- Spark

def write_shards(docs: DataFrame, tokenizer: str, end_id: int, path: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Write the file images of ``docs`` (doc_id, text) under ``path``: rows (shard, part, n_docs, n_tokens, file).

    Order of documents: ``shard``, then ``part``, then the order within the image.
    """
    spark = docs.sparkSession
    C.python_tasks(spark)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part = TaskContext.get().partitionId(), 0
        ids, doc_ids, lengths, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            known = pa.array(doc_ids, pa.int64())
            image = pack(np.frombuffer(b"".join(ids), "<u4"), known.fill_null(0).to_numpy(), known.is_null().to_numpy(zero_copy_only=False), np.array(lengths))
            return pa.RecordBatch.from_pydict({"shard": [shard], "part": [part], "n_docs": [len(doc_ids)], "n_tokens": [size], "file": [image]}, schema=arrow)

        e = encoder(tokenizer)
        for batch in C.merged(batches, most=_BATCH_BYTES):
            for doc, found in zip(batch.column("doc_id").to_pylist(), e.column(batch.column("text"))):
                n = len(found) // 4 + 1
                if size and size + n > shard_tokens:
                    yield flush()
                    ids, doc_ids, lengths, size, part = [], [], [], 0, part + 1
                ids += (found, end)
                doc_ids.append(doc)
                lengths.append(n)
                size += n
        if doc_ids:
            yield flush()

    arrow = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("file", pa.binary())])
    ranges = max(1, -(-C.plan_bytes(docs) // RANGE_BYTES))
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(ranges, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(C.task("wavelet", run), "shard int, part int, n_docs long, n_tokens long, file binary")
        .write.option("compression", "uncompressed")
        .parquet(path)
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.parquet(path)
    sizes = files.select("shard", "part", "n_tokens")
    # Ids before each image: shards are few (one per range), parts are numbered within a shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.withColumn("part_start", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    starts = parts.join(shards, "shard").select("shard", "part", (F.col("shard_start") + F.col("part_start")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, part, image in zip(*(batch.column(c).to_pylist() for c in ("shard", "part", "file"))):
                s = Shard(image)
                ids = memoryview(s.tokens().astype("<u4").tobytes())
                ends = np.cumsum(s.lengths)
                first = ends - s.lengths
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(first.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(s.n_docs, shard, np.int32)), pa.array(np.full(s.n_docs, part, np.int32)), pa.array(s.doc_ids, mask=s.no_id), pa.array(first), pa.array(s.lengths), pa.array(crc, pa.int64())],
                    names=["shard", "part", "doc_id", "first", "n_tokens", "ids_crc32"],
                )

    rows = files.select("shard", "part", "file").mapInArrow(C.task("wavelet", run), "shard int, part int, doc_id long, first long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["shard", "part"]).select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")

"""Byte-level BPE encoding and decoding with DuckDB recursive queries inside Spark partitions.

Each Spark task takes batches of whole texts. The words that the split pattern finds in a
batch become one table of token positions; a recursive query joins neighbouring positions
with the merge table and contracts every word's leftmost pair of least rank, until no word
has a pair left. Decoding is an ordered aggregation of the token bytes. Words seen before
are kept in a bounded cache per Python worker, so the query runs over new words only.

Nothing is shuffled; memory is bounded by the batch, the word cache and DuckDB's limit.

Edge cases: a null or empty text has no ids and empty decoded bytes; a word of more than
``LONG_WORD`` bytes (no white space, or nothing else, for so long) would make the recursion
quadratic, so a heap of its pairs contracts it in the same order; any other columns pass through unchanged,
except that columns named like an output are replaced; repeated rows are encoded each alike.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from satlink.llm import common as C

#: Words that each generation of the cache holds.
CACHE_WORDS = 120_000
#: Bytes of text whose new words one query takes, and DuckDB's memory: a worker keeps what it once took.
BATCH_BYTES, MEMORY = 4 << 20, "150MB"
#: White space as in the Unicode property; a text may be cut before white space that follows something else.
SPACE = r"\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{SPACE}]*+[^{SPACE}]++|[{SPACE}]++")
_SPACES = frozenset(chr(c) for c in [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
#: Bytes of a word that the recursive query takes.
LONG_WORD = 1000
_NO_TOKEN = (1 << 20) - 1

# A row is a token of a word: k has the word and the position, p the token and the next one.
# The pair of least (merged rank, position) goes: its second row becomes the merged token, its
# first row leaves, the row before learns of its new neighbour, later rows move up by one.
_MERGE = """
with recursive state(k, p, step) as (
  select k, p, 0 from start
  union all
  (with least as (
     select state.k >> 20 as word, min(merges.merged | (state.k & 1048575)) as pair
     from state join merges using (p) group by 1)
   select state.k - ((state.k & 1048575) > (pair & 1048575))::int,
          case (state.k & 1048575) - (pair & 1048575)
            when 1 then (pair >> 20 << 20) | (state.p & 1048575)
            when -1 then (state.p >> 20 << 20) | (pair >> 20)
            else state.p end,
          state.step + 1
   from state join least on (state.k >> 20) = least.word
   where (state.k & 1048575) <> (pair & 1048575))
), last as (select k >> 20 as word, max(step) as step from state where (k & 1048575) = 0 group by 1)
select last.word, p >> 20 as tok
from state join last on last.word = (state.k >> 20) and last.step = state.step
order by k
"""

_DECODE = """
select seq, string_agg(hex, '' order by pos) as hex from ids join vocab using (tok) group by seq
"""


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Codec:
    """A DuckDB database of one Python worker with the merge table and the vocabulary."""

    def __init__(self, rank_file: str, pattern: str):
        self.ranks = load_ranks(rank_file)
        # \s as Rust's and ICU's pattern engines have it, not with the ASCII separators of Python's.
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        left, right, out = [], [], []
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), out.append(rank)
        self.byte = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY})
        self._table("merges", p=(np.array(left, np.int64) << 20) | np.array(right, np.int64), merged=np.array(out, np.int64) << 20)
        self._table("vocab", tok=np.fromiter(self.ranks.values(), np.int64, len(self.ranks)), hex=[t.hex() for t in self.ranks])
        self.chunks, self.words = C.TwoGenerations(CACHE_WORDS), C.TwoGenerations(CACHE_WORDS)

    def _table(self, name: str, **columns) -> None:
        self.db.register("incoming", pa.table({k: pa.array(v) for k, v in columns.items()}))
        self.db.execute(f"create or replace table {name} as select * from incoming")
        self.db.unregister("incoming")

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the token ids of all words; a word that is a token itself is that token."""
        whole = np.array([self.ranks.get(w, -1) for w in words], np.int64)
        count = np.ones(len(words), np.int64)
        long_ = {i: self.contract(words[i]) for i in np.flatnonzero(whole < 0).tolist() if len(words[i]) > LONG_WORD}
        rest = np.array([i for i in np.flatnonzero(whole < 0).tolist() if i not in long_], np.int64)
        tokens = np.zeros(0, np.int64)
        if len(rest):
            lengths = np.array([len(words[i]) for i in rest], np.int64)
            first = self.byte[np.frombuffer(b"".join([words[i] for i in rest]), np.uint8)]
            after = np.append(first[1:], _NO_TOKEN)
            after[np.cumsum(lengths) - 1] = _NO_TOKEN
            position = np.arange(len(first)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            self._table("start", k=(np.repeat(np.arange(len(rest)), lengths) << 20) | position, p=(first << 20) | after)
            found = self.db.sql(_MERGE).to_arrow_table()
            tokens = found.column("tok").to_numpy()
            count[rest] = np.bincount(found.column("word").to_numpy(), minlength=len(rest))
        for i, found in long_.items():
            count[i] = len(found)
        offsets = np.concatenate([[0], np.cumsum(count)])
        ids = np.empty(offsets[-1], np.int64)
        from_query = np.ones(len(ids), bool)
        from_query[offsets[:-1][whole >= 0]] = False
        ids[offsets[:-1][whole >= 0]] = whole[whole >= 0]
        for i, found in long_.items():
            ids[offsets[i] : offsets[i + 1]] = found
            from_query[offsets[i] : offsets[i + 1]] = False
        ids[from_query] = tokens
        return ids, offsets

    def contract(self, word: bytes) -> list[int]:
        """Ids of one long word: its leftmost pair of least rank is merged until none is left."""
        parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
        before, after = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
        rank = lambda i: self.ranks.get(parts[i] + parts[after[i]]) if after[i] >= 0 else None
        heap = [(r, i) for i in range(len(parts)) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if parts[i] is None or rank(i) != r:
                continue  # one of the pair has been merged meanwhile
            gone = after[i]
            parts[i], parts[gone], after[i] = parts[i] + parts[gone], None, after[gone]
            if after[i] >= 0:
                before[after[i]] = i
            for j in (before[i], i):
                if j >= 0 and (new := rank(j)) is not None:
                    heapq.heappush(heap, (new, j))
        return [self.ranks[p] for p in parts if p is not None]

    def decode_ids(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The bytes of each id sequence, by ordered aggregation."""
        out = [b""] * (len(offsets) - 1)
        if len(ids):
            self._table("ids", seq=np.repeat(np.arange(len(out)), np.diff(offsets)), pos=np.arange(len(ids)), tok=ids)
            found = self.db.sql(_DECODE).to_arrow_table()
            for seq, text in zip(found.column("seq").to_pylist(), found.column("hex").to_pylist()):
                out[seq] = bytes.fromhex(text)
        return out

    def split(self, chunks: list[str]) -> list[list[str]]:
        """The words of each chunk. Chunks without inner white space are split together, a line each."""
        out: list = [None] * len(chunks)
        simple = [i for i, c in enumerate(chunks) if c[-1] not in _SPACES and (c[0] == " " or c[0] not in _SPACES) and c[1:2] not in _SPACES]
        found = iter(self.pattern.findall("\n".join([chunks[i] for i in simple])))
        for i in simple:
            out[i] = words = []
            for word in found:
                if word == "\n":
                    break
                words.append(word)
        return [self.pattern.findall(c) if ws is None else ws for c, ws in zip(chunks, out)]

    def learn(self, chunks: set[str]) -> None:
        """Encode and decode chunks that the cache lacks."""
        self.chunks.turn()
        self.words.turn()
        new = self.chunks.lacking(chunks)
        if not new:
            return
        split = self.split(new)
        lacking = self.words.lacking({w for ws in split for w in ws})
        if lacking:
            ids, offsets = self.encode_words([w.encode() for w in lacking])
            data, ends = ids.astype("<u4").tobytes(), (offsets * 4).tolist()
            self.words.update(zip(lacking, zip([data[a:b] for a, b in zip(ends, ends[1:])], self.decode_ids(ids, offsets))))
            self.db.execute("drop table if exists start; drop table if exists ids")
        words = self.words
        for chunk, ws in zip(new, split):
            if len(ws) == 1:
                self.chunks[chunk] = words[ws[0]]
            else:
                parts = [words[w] for w in ws]
                self.chunks[chunk] = (b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts]))

    def texts(self, texts: list[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit integers, decoded bytes) of each whole text."""
        split = [_CHUNK.findall(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        get = self.chunks.__getitem__
        for chunks in split:
            both = [get(c) for c in chunks]
            yield b"".join([x[0] for x in both]), b"".join([x[1] for x in both])


_codecs: dict[tuple[str, str], Codec] = {}


def _drop() -> None:
    for c in _codecs.values():
        c.db.close()
    _codecs.clear()


def codec(rank_file: str, pattern: str) -> Codec:
    C.keeps("byte_bpe", _drop)
    if (rank_file, pattern) not in _codecs:
        _codecs[rank_file, pattern] = Codec(rank_file, pattern)
    return _codecs[rank_file, pattern]


def encode(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", digests: bool = False) -> DataFrame:
    """Add ``ids`` (array<int>) and ``decoded`` (binary) to every document.

    With ``digests`` the columns are ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``
    instead: the same real ids and bytes, hashed before they leave the worker.
    """
    C.python_tasks(docs.sparkSession)
    added = (
        {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
        if digests
        else {"ids": T.ArrayType(T.IntegerType()), "decoded": T.BinaryType()}
    )
    kept = [f for f in docs.schema.fields if f.name.lower() not in added and (not digests or f.name != text)]
    schema = T.StructType(kept + [T.StructField(k, t) for k, t in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(rank_file, pattern)
        for batch in C.merged(batches, text, BATCH_BYTES):
            n, ids_hash, text_hash, ids, decoded = [], [], [], [], []
            for a, b in c.texts(batch.column(text).to_pylist()):
                if digests:
                    n.append(len(a) // 4)
                    ids_hash.append(hashlib.sha256(a).hexdigest())
                    text_hash.append(hashlib.sha256(b).hexdigest())
                else:
                    ids.append(np.frombuffer(a, "<u4").astype(np.int32))
                    decoded.append(b)
            out = [pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())] if digests else [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + out, names=schema.fieldNames())

    columns = [f.name for f in kept] + ([] if any(f.name == text for f in kept) else [text])
    return docs.select(*[f"`{c}`" for c in columns]).mapInArrow(C.task("byte_bpe", run), schema)

"""Prefix trie of conversations, by adaptive radix trees over fixed-width turn ids.

A turn becomes a 16-byte id, the first half of the SHA-256 of its role and text; a conversation
becomes the concatenation of its turns' ids, read as big-endian bytes. Conversations that begin
with the same turns are keys with the same prefix of 16 bytes a turn.

1. Conversations are range-partitioned and sorted by (key, conv_id). A task inserts its range into
   an adaptive radix tree: inner nodes grow from 4 to 16, 48 and 256 children, chains of bytes
   without a branch are kept as one compressed prefix, and a key is only unfolded where it
   branches. Walking the tree bottom-up, byte depths that are whole turns emit a trie node (those
   inside a compressed prefix, too); other byte depths emit nothing.
2. A range shares nodes with its neighbours only along the paths of its first and last key. Those
   nodes leave the task as parts; all others are final (but for the conv_id of such a parent).
   Parts are added up by node; a node that k ranges hold was counted k times in itself and above,
   which is corrected along the boundary paths by running sums from the deepest node up.
3. Members that end at a shared node (a conversation with very many copies) leave the tasks as
   ordered pieces of the list of ids; they are hashed as a stream, never held whole.

So neither a hot first turn nor a hot conversation is gathered in one task. What one row holds is
one conversation's ids and word counts (20 bytes a turn, no texts).

Edge cases: rows without conv_id belong to no conversation; null roles and texts are empty ones;
turns are ordered by turn number, nulls first, equal numbers by role and then by id; repeated rows
are repeated turns; an empty table has no nodes; other columns play no part.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from satlink.llm.common import python_tasks, written
from satlink.llm.mixing import words as count_words

#: Bytes of a turn id.
WIDTH = 16
#: Turns that a range of conversations holds, about.
RANGE_TURNS = 65_536
#: Members in one piece of a list of ends.
PIECE = 8192

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------------------------------
# Conversations as keys
# ---------------------------------------------------------------------------------------

def turn_lists(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: an ordered array of (known, turn, role, id, words) per conversation."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("long"), F.lit(0).cast("long")).alias("turn"), role.alias("role"),
            F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * WIDTH)).alias("id"), count_words(text).cast("int").alias("words"),
        ).alias("t"),
    )
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def rebuilt(lists: DataFrame, modulus: int = 20, heads: int = 4) -> DataFrame:
    """Each conversation with its first h turns replaced by those of conversation ``c - c % modulus``; h = crc32(c) % heads."""
    of_base = lists.where(F.col("conv_id") % modulus == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, heads - 1).alias("head"))
    own = lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % modulus).withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", F.lit(1), F.lit(0)))
    tail = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return own.join(of_base, "base", "left").select("conv_id", F.concat(head, tail).alias("turns"))


def keys(lists: DataFrame) -> DataFrame:
    """conv_id, key (the ids one after the other), words (of each turn)."""
    joined = F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")
    return lists.select("conv_id", F.unhex(joined).alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))


# ---------------------------------------------------------------------------------------
# The tree of one range
# ---------------------------------------------------------------------------------------

class Node:
    """A node with a compressed prefix and up to 4, 16, 48 or 256 children.

    Up to 16 children: ``bytes_`` holds their bytes in order, ``kids`` the children beside them.
    Up to 48: ``bytes_`` has an entry for each byte, the child's place in ``kids`` or 255.
    Up to 256: ``kids`` has an entry for each byte.
    """

    __slots__ = ("prefix", "room", "bytes_", "kids", "ends", "words")

    def __init__(self, prefix: bytes):
        self.prefix, self.room, self.bytes_, self.kids = prefix, 4, bytearray(), []
        self.ends: array | None = None
        self.words = None

    def find(self, byte: int) -> Node | None:
        if self.room <= 16:
            i = self.bytes_.find(byte)
            return self.kids[i] if i >= 0 else None
        if self.room == 48:
            i = self.bytes_[byte]
            return self.kids[i] if i != 255 else None
        return self.kids[byte]

    def put(self, byte: int, child: Node) -> None:
        """Set the child of a byte; grow to the next layout where this one is full."""
        if self.room <= 16:
            i = bisect_left(self.bytes_, byte)
            if i < len(self.bytes_) and self.bytes_[i] == byte:
                self.kids[i] = child
                return
            if len(self.kids) < self.room:
                self.bytes_.insert(i, byte)
                self.kids.insert(i, child)
                return
            if self.room == 4:
                self.room = 16
            else:
                places = bytearray(b"\xff" * 256)
                for at, b in enumerate(self.bytes_):
                    places[b] = at
                self.room, self.bytes_ = 48, places
            self.put(byte, child)
        elif self.room == 48:
            at = self.bytes_[byte]
            if at != 255:
                self.kids[at] = child
            elif len(self.kids) < 48:
                self.bytes_[byte] = len(self.kids)
                self.kids.append(child)
            else:
                kids = [None if i == 255 else self.kids[i] for i in self.bytes_]
                self.room, self.bytes_, self.kids = 256, bytearray(), kids
                self.kids[byte] = child
        else:
            self.kids[byte] = child

    def end(self, member: int, words) -> None:
        if self.ends is None:
            self.ends, self.words = array("q"), words
        self.ends.append(member)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class RadixTree:
    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, member: int, words=None) -> None:
        if self.root is None:
            self.root = Node(key)
            self.root.end(member, words)
            return
        parent, byte, node, at = None, 0, self.root, 0
        while True:
            prefix = node.prefix
            if not key.startswith(prefix, at):
                n = _common(prefix, key[at : at + len(prefix)])
                upper = Node(prefix[:n])
                upper.put(prefix[n], node)
                node.prefix = prefix[n + 1 :]
                if parent is None:
                    self.root = upper
                else:
                    parent.put(byte, upper)
                self._rest(upper, key, at + n, member, words)
                return
            at += len(prefix)
            child = node.find(key[at]) if at < len(key) else None
            if child is None:
                self._rest(node, key, at, member, words)
                return
            parent, byte, node, at = node, key[at], child, at + 1

    @staticmethod
    def _rest(node: Node, key: bytes, at: int, member: int, words) -> None:
        """The key ends at the node, or its rest becomes a leaf with one compressed prefix."""
        if at == len(key):
            node.end(member, words)
            return
        leaf = Node(key[at + 1 :])
        leaf.end(member, words)
        node.put(key[at], leaf)

    def walk(self) -> list[tuple[Node, int, int]]:
        """(node, first byte depth of its prefix, parent's place in the list), parents before children."""
        out = [(self.root, 0, -1)] if self.root else []
        for place, (node, start, _) in enumerate(out):
            depth = start + len(node.prefix) + 1
            out.extend((kid, depth, place) for kid in node.kids if kid is not None)
        return out


class Turn:
    """A trie node of one range."""

    __slots__ = ("depth", "least", "members", "children", "leaves", "saved", "words", "ends", "shared", "parent")


def turn_nodes(tree: RadixTree, ids: list[int]) -> list[Turn]:
    """Trie nodes of a tree whose members are places in ``ids`` (in key order): every byte depth that is a whole turn.

    ``shared`` is 1 on the first key's path, 2 on the last key's, 3 on both, else 0.
    """
    path = tree.walk()
    out: list[Turn] = []
    # Per tree node: members, least id, trie nodes without a parent yet, leaves, saved words, word counts of a member, shared.
    sums: list[list] = [[0, None, [], 0, 0, None, 0] for _ in path]
    for place in range(len(path) - 1, -1, -1):
        node, start, above = path[place]
        members, least, open_, leaves, saved, words, shared = sums[place]
        if node.ends is not None:
            members += len(node.ends)
            own = ids[node.ends[0]]
            least = own if least is None or own < least else least
            words = node.words
            shared |= (node.ends[0] == 0) | (node.ends[-1] == len(ids) - 1) << 1
        end = start + len(node.prefix)
        at = end - end % WIDTH
        while at >= start:
            t = Turn()
            t.depth, t.least, t.members, t.children, t.shared, t.parent = at // WIDTH, least, members, len(open_), shared, None
            t.words = words[t.depth - 1] if t.depth else 0
            t.ends = node.ends if at == end else None
            leaves = leaves if open_ else 1
            saved += (members - 1) * t.words
            t.leaves, t.saved = leaves, saved
            for child in open_:
                child.parent = t
            open_ = [t]
            out.append(t)
            at -= WIDTH
        if above >= 0:
            up = sums[above]
            up[0] += members
            up[1] = least if up[1] is None or least < up[1] else up[1]
            up[2].extend(open_)
            up[3] += leaves
            up[4] += saved
            up[5], up[6] = words, up[6] | shared
        sums[place] = None
    return out


# ---------------------------------------------------------------------------------------
# The tasks
# ---------------------------------------------------------------------------------------

#: kind: final node; part of a shared node; place of a shared node on a boundary path; piece of a shared node's ends.
FINAL, PART, PATH, ENDS = 0, 1, 2, 3
_ROWS = ("kind int, node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, words long, childless long, ends_sha256 string, path long, first long, piece string")
_SCHEMA = pa.schema([("kind", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), *[(c, pa.int64()) for c in (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words", "childless")],
    ("ends_sha256", pa.string()), ("path", pa.int64()), ("first", pa.int64()), ("piece", pa.string())])


def _path_ids(key: bytes) -> list[bytes]:
    """Name of the trie node at each depth of a key: a digest of its prefix."""
    running = hashlib.sha256()
    out = [running.digest()[:WIDTH]]
    for at in range(0, len(key), WIDTH):
        running.update(key[at : at + WIDTH])
        out.append(running.copy().digest()[:WIDTH])
    return out


def _joined(members, ids: list[int]) -> str:
    return ",".join(str(ids[m]) for m in members)


def _rows(tree: RadixTree, ids: list[int], first: bytes, last: bytes, part: int) -> Iterator[dict]:
    first_ids, last_ids = _path_ids(first), _path_ids(last)
    for side, names in enumerate((first_ids, last_ids)):
        for depth, name in enumerate(names):
            yield {"kind": PATH, "node": name, "depth": depth, "path": 2 * part + side}
    name_of = lambda t: (first_ids if t.shared & 1 else last_ids)[t.depth]
    for t in turn_nodes(tree, ids):
        row = {"conv_id": t.least, "depth": t.depth, "n_convs": t.members, "n_children": t.children, "n_leaves": t.leaves, "saved_tokens": t.saved}
        if t.shared:
            row |= {"kind": PART, "node": name_of(t), "words": t.words, "childless": int(t.children == 0)}
            if t.parent is not None:
                row["parent"] = name_of(t.parent)
            yield row
            if t.ends is not None:
                for i in range(0, len(t.ends), PIECE):
                    yield {"kind": ENDS, "node": row["node"], "first": ids[t.ends[i]], "piece": _joined(t.ends[i : i + PIECE], ids)}
            continue
        row["kind"] = FINAL
        row["ends_sha256"] = EMPTY_SHA256 if t.ends is None else hashlib.sha256(_joined(t.ends, ids).encode()).hexdigest()
        if t.parent.shared:
            row["parent"] = name_of(t.parent)
        else:
            row["parent_conv_id"] = t.parent.least
        yield row


def _batched(rows: Iterator[dict], most: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_SCHEMA)


def _build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    tree, ids, first, key = RadixTree(), array("q"), None, b""
    for batch in batches:
        counts = batch.column("words")
        for i, (conv_id, key) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("key").to_pylist())):
            first = key if first is None else first
            tree.insert(key, len(ids), array("i", counts[i].as_py()))
            ids.append(conv_id)
    if ids:
        yield from _batched(_rows(tree, ids, first, key, TaskContext.get().partitionId()))


def _hash_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each node, which come in order."""
    schema = pa.schema([("node", pa.binary()), ("ends_sha256", pa.string())])
    node, running = None, None
    for batch in batches:
        done = []
        for name, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist()):
            if name != node:
                if running is not None:
                    done.append((node, running.hexdigest()))
                node, running = name, hashlib.sha256(piece.encode())
            else:
                running.update(b"," + piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate(schema.types)], schema=schema)
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()], pa.string())], schema=schema)


# ---------------------------------------------------------------------------------------
# The trie
# ---------------------------------------------------------------------------------------

_OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast("long"))


def shared_nodes(rows: DataFrame) -> DataFrame:
    """The nodes on boundary paths, whole: parts added up, what several ranges counted is corrected."""
    parts = rows.where(F.col("kind") == PART)
    nodes = parts.groupBy("node").agg(
        F.count("*").alias("parts"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens", "childless")],
    )
    nodes = written(nodes, "trie-shared")
    # A node of k ranges: k - 1 times too few of its words saved; a leaf once, or not at all where some range has children.
    wrong = nodes.select(
        "node", ((F.col("parts") - 1) * F.col("words")).alias("more_saved"),
        (F.when(F.col("n_children") == 0, 1).otherwise(0) - F.col("childless")).cast("long").alias("more_leaves"),
    ).where("more_saved <> 0 or more_leaves <> 0")
    paths = rows.where(F.col("kind") == PATH).select("path", "depth", "node")
    # Each correction goes up one path that holds its node, by a running sum from the deepest node.
    chosen = wrong.join(paths.groupBy("node").agg(F.min("path").alias("path")), "node")
    upward = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    along = paths.join(chosen, ["node", "path"], "left").select("node", F.sum(_zero("more_saved")).over(upward).alias("more_saved"), F.sum(_zero("more_leaves")).over(upward).alias("more_leaves"))
    correction = along.groupBy("node").agg(F.sum("more_saved").alias("more_saved"), F.sum("more_leaves").alias("more_leaves"))
    twice = nodes.where("parts > 1 and parent is not null").groupBy(F.col("parent").alias("node")).agg(F.sum(F.col("parts") - 1).alias("twice"))
    pieces = rows.where(F.col("kind") == ENDS).select("node", "first", "piece")
    ends = pieces.repartition("node").sortWithinPartitions("node", "first").select("node", "piece").mapInArrow(_hash_ends, "node binary, ends_sha256 string")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(correction, "node", "left").join(twice, "node", "left").join(ends, "node", "left").join(above, "parent", "left")
    return whole.select(
        "node", "conv_id", "depth", "parent_conv_id", "n_convs", (F.col("n_children") - _zero("twice")).alias("n_children"),
        (F.col("n_leaves") + _zero("more_leaves")).alias("n_leaves"), (F.col("saved_tokens") + _zero("more_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )


def trie(lists: DataFrame, n_turns: int, range_turns: int = RANGE_TURNS) -> DataFrame:
    """One row per trie node of the conversations in ``lists`` (conv_id, turns as from ``turn_lists``)."""
    spark = lists.sparkSession
    python_tasks(spark)
    ranges = max(spark.sparkContext.defaultParallelism, -(-n_turns // range_turns))
    dealt = keys(lists).repartitionByRange(ranges, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    rows = written(dealt.mapInArrow(_build, _ROWS), "trie-ranges")
    shared = written(shared_nodes(rows), "trie-nodes")
    final = rows.where(F.col("kind") == FINAL)
    # Children of shared nodes lack only that node's least conv_id.
    above = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    below = final.where("parent is not null").join(above, "parent").withColumn("parent_conv_id", F.col("above"))
    return final.where("parent is null").select(*_OUT).unionByName(below.select(*_OUT)).unionByName(shared.select(*_OUT))


def rebuilt_trie(conversations: DataFrame, modulus: int = 20, heads: int = 4) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(rebuilt(turn_lists(conversations), modulus, heads), conversations.count())

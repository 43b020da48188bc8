import collections
import hashlib
import random
import re
import zlib

import duckdb

from satlink.llm import prefix_trie as T
from satlink.llm import queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string"


def rebuild(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + mine[h:]
    return out


def brute(convs):
    """Every prefix with its members, then sums over all pairs of a node and its subtree."""
    members = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in members.items():
        words = len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(m) - 1) * words
    ends = lambda p: ",".join(str(c) for c in sorted(members[p]) if len(convs[c]) == len(p))
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends(p).encode()).hexdigest())
                   for p, m in members.items()), key=repr)


def got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_and_its_sql(spark, small_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{small_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = got(queries.op11_prefix_trie(spark, small_dir))
    assert result == brute(rebuild(rows)) and len(result) > 50
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{small_dir}/conversations.parquet')")
    sql = con.execute(queries.ORACLE_SQL["op11_prefix_trie"])
    order = [[d[0] for d in sql.description].index(c) for c in COLUMNS]
    assert sorted((tuple(r[i] for i in order) for r in sql.fetchall()), key=repr) == result


def drawn(n, seed, turns=3, longest=6):
    """Conversations over few different turns, so that prefixes are shared, with a third of all equal and a long one."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 3 == 0:
            rows += [(c, t, "user", "hot words here") for t in range(4)]
        else:
            rows += [(c, t, rng.choice("ua"), f"w {'x ' * rng.randrange(turns)}") for t in range(rng.randrange(1, longest))]
    return rows + [(n, t, "user", "hot words here") for t in range(150)]


def test_hot_conversation_over_many_ranges(spark):
    """Ranges of a few conversations: nodes shared by many ranges are counted once, their ends hashed in order."""
    rows = drawn(700, 5)
    lists = T.rebuilt(T.turn_lists(spark.createDataFrame(rows, SCHEMA)))
    want = brute(rebuild(rows))
    for per_range in (30, 400):
        assert got(T.trie(lists, len(rows), range_turns=per_range)) == want


def test_edges(spark):
    """Nulls in any column, ties, repeated rows, empty and very long texts, negative ids, clashing columns, an empty table."""
    rows = [(1, None, "u", "first"), (1, 0, "u", "second"), (1, 0, "u", "second"), (1, 2, None, None), (2, 0, "", ""), (None, 0, "u", "lost"), (21, 5, "a", "x" * 100_000 + " y"),
            (20, 0, "u", "one two"), (20, 1, "a", "three"), (20, 2, "u", "four"), (22, 0, "u", "v"), (39, 0, "u", "v"), (-5, 0, "u", "neg"), (-21, 1, "u", "neg"), (-20, 0, "u", "b"), (0, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'own' as key", "'own' as words", "'own' as h", "'own' as node")
    assert got(T.rebuilt_trie(df)) == brute(rebuild(rows))
    assert got(T.rebuilt_trie(df.where("false"))) == [] and got(T.rebuilt_trie(df.where("conv_id is null"))) == []
    assert got(T.rebuilt_trie(df.where("conv_id = 22"))) == brute(rebuild([r for r in rows if r[0] == 22]))


def test_tree_layouts_and_compression():
    """Keys of one tree in any order: layouts grow to 256 children, chains stay compressed, every key is found at its end."""
    rng = random.Random(2)
    made = [bytes([i]) + bytes(15) for i in range(256)] + [bytes([7]) * 16 + rng.randbytes(16 * rng.randrange(6)) for _ in range(300)] + [b"", bytes(160)]
    rng.shuffle(made)
    tree = T.RadixTree()
    for i, key in enumerate(made):
        tree.insert(key, i, [0] * (len(key) // 16))
    rooms = collections.Counter(n.room for n, _, _ in tree.walk())
    assert tree.root.room == 256 and {4, 256} <= set(rooms)
    ends = {}

    def visit(node, key):
        key += node.prefix
        for m in node.ends or []:
            ends[m] = key
        for byte in range(256):
            child = node.find(byte)
            if child is not None:
                visit(child, key + bytes([byte]))

    visit(tree.root, b"")
    assert ends == dict(enumerate(made)) and len(tree.walk()) < 2 * len(made)
    node = T.Node(b"")
    for i, byte in enumerate(rng.sample(range(256), 256)):
        node.put(byte, T.Node(bytes([byte])))
        assert node.room == (4 if i < 4 else 16 if i < 16 else 48 if i < 48 else 256)
        assert sum(node.find(b) is not None for b in range(256)) == i + 1 and node.find(byte).prefix == bytes([byte])


def test_pieces_of_many_ranges_are_hashed_in_order(spark):
    rows = [(c, 0, "u", "same") for c in range(400)]
    lists = T.turn_lists(spark.createDataFrame(rows, SCHEMA))
    result = {r.depth: r for r in T.trie(lists, len(rows), range_turns=20).collect()}
    assert result[1].ends_sha256 == hashlib.sha256(",".join(map(str, range(400))).encode()).hexdigest() and result[1].n_convs == 400
    assert result[0].n_leaves == 1 and result[0].saved_tokens == 399

import random

from satlink.operators.joins import anti_join, null_aware_anti_join


def _data(seed, n, null_rate):
    rnd = random.Random(seed)
    pick = lambda vals: None if rnd.random() < null_rate else rnd.choice(vals)
    return [(i, pick(["a", "b", "c"]), pick(["x", "y"])) for i in range(n)]


def test_null_aware_anti_join_equals_not_in(spark, duck):
    for seed in range(6):
        left = _data(seed, 40, 0.2)
        right = _data(seed + 100, 8, 0.15)
        for declared in ((), ("d",)):
            if declared:
                left = [(i, k, d or "x") for i, k, d in left]
                right = [(i, k, d or "y") for i, k, d in right]
            lf = spark.createDataFrame(left, "id int, k string, d string")
            rt = spark.createDataFrame(right, "id int, k string, d string")
            got = sorted(r.id for r in null_aware_anti_join(lf, rt, ["k", "d"], non_null=declared).collect())
            duck.execute("create or replace temp table l (id int, k varchar, d varchar)")
            duck.execute("create or replace temp table r (id int, k varchar, d varchar)")
            if left:
                duck.executemany("insert into l values (?, ?, ?)", left)
            if right:
                duck.executemany("insert into r values (?, ?, ?)", right)
            exp = sorted(x[0] for x in duck.execute("select id from l where (k, d) not in (select k, d from r)").fetchall())
            assert got == exp, (seed, declared)


def test_null_aware_with_empty_right(spark):
    lf = spark.createDataFrame([(1, None, "x"), (2, "a", None)], "id int, k string, d string")
    rt = spark.createDataFrame([], "id int, k string, d string")
    assert sorted(r.id for r in null_aware_anti_join(lf, rt, ["k", "d"]).collect()) == [1, 2]


def test_anti_join_null_never_matches(spark):
    lf = spark.createDataFrame([(1, None), (2, "a"), (3, "b")], "id int, k string")
    rt = spark.createDataFrame([(None,), ("a",)], "k string")
    assert sorted(r.id for r in anti_join(lf, rt, ["k"]).collect()) == [1, 3]

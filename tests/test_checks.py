from satlink.operators import checks as C
from satlink.operators.counts import row_counts


def test_checks_return_failing_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "z")], "id int, v string")
    parent = spark.createDataFrame([("a",)], "v string")
    assert C.not_null(df, "v").count() == 1
    assert [tuple(r) for r in C.unique(df, "v").collect()] == [("a", 2)]
    assert [tuple(r) for r in C.relationships(df, "v", parent, "v").collect()] == [("z", 1)]
    assert [tuple(r) for r in C.accepted_values(df, "v", ["a"]).collect()] == [("z", 1)]
    summary = {(r.test): r.failures for r in C.run_checks([
        C.Check("m", "v", "not_null", C.not_null(df, "v")), C.Check("m", "v", "unique", C.unique(df, "v"))]).collect()}
    assert summary == {"not_null": 1, "unique": 1}


def test_freshness_status(spark):
    df = spark.createDataFrame([("2024-01-30 00:00:00",)], "ts string")
    r = C.freshness(df, "ts", "2024-02-01 00:00:00", 86400, 7 * 86400, "s").first()
    assert (r.age_s, r.status) == (2 * 86400, "warn")
    r = C.freshness(df.filter("ts is null"), "ts", "2024-02-01 00:00:00", 86400, 7 * 86400, "s").first()
    assert r.status == "error"


def test_row_counts_missing_table(spark):
    out = {r.table_name: (r.n, r.error) for r in row_counts({"a": spark.range(3), "gone": None}).collect()}
    assert out == {"a": (3, None), "gone": (None, "table not found: gone")}

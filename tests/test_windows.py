"""Ordered operators against brute force, with one key holding most of the rows."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from meterlake.operators import windows


@pytest.fixture(scope="module", autouse=True)
def many_slices(spark):
    """Keep the small slices apart, which adaptive execution would merge."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


@pytest.fixture(scope="module")
def skewed(spark):
    """2,000 rows over several input splits: 70 % of them of key "hot", a fifth exact copies of one row, some NULL keys."""
    rows = []
    for i in range(2000):
        key = "hot" if i % 10 < 7 else None if i % 10 == 7 else f"k{i % 13}"
        rows.append((key, 5, 5, 1) if i % 5 == 0 and key == "hot" else (key, i * 7919 % 997, i, i % 11))
    return spark.createDataFrame(rows, "key string, ts int, id int, value int").repartition(7)


def by_key(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["key"]].append(r)
    return {k: sorted(g, key=lambda r: (r["ts"], r["id"])) for k, g in groups.items()}


def test_mark_duplicates_keeps_exactly_the_first_row_per_key(skewed):
    marked = windows.mark_duplicates(skewed, ["key"], ["ts", "id"]).collect()
    assert len(marked) == 2000
    groups = by_key(marked)
    assert not any(r["is_duplicate"] for r in groups.pop(None))
    for rows in groups.values():
        kept = [r for r in rows if not r["is_duplicate"]]
        assert len(kept) == 1 and (kept[0]["ts"], kept[0]["id"]) == (rows[0]["ts"], rows[0]["id"])


def test_latest_and_distinct(skewed):
    groups = by_key(skewed.collect())
    latest = {r["key"]: (r["ts"], r["id"]) for r in windows.latest_per_key(skewed, ["key"], "ts", ["id"]).collect()}
    assert latest == {k: (g[-1]["ts"], g[-1]["id"]) for k, g in groups.items()}
    assert windows.distinct_by(skewed, ["key"]).count() == len(groups)
    assert windows.distinct_by(skewed.select("key"), ["key"]).count() == len(groups)


def test_row_number_per_key(skewed):
    numbered = windows.row_number_per_key(skewed, ["key"], ["ts", "id"]).collect()
    for rows in by_key(numbered).values():
        assert sorted(r["row_number"] for r in rows) == list(range(1, len(rows) + 1))
        ordered = sorted(rows, key=lambda r: r["row_number"])
        assert [(r["ts"], r["id"]) for r in ordered] == [(r["ts"], r["id"]) for r in rows]


def test_sequence_number_is_dense_and_ordered(skewed):
    numbered = sorted(windows.sequence_number(skewed, ["ts", "id"], "n").collect(), key=lambda r: r["n"])
    assert [r["n"] for r in numbered] == list(range(1, 2001))
    assert [(r["ts"], r["id"]) for r in numbered] == sorted((r["ts"], r["id"]) for r in numbered)


def test_a_hot_key_is_cut_into_slices(skewed):
    sizes = windows._sliced(skewed, ["key"], ["ts", "id"]).where("key = 'hot'").groupBy("__slice").count().collect()
    assert len(sizes) > 3 and max(r["count"] for r in sizes) < 1000


def test_running_sum(skewed):
    distinct = skewed.dropDuplicates()
    got = windows.running_sum(distinct, ["key"], ["ts", "id"], "value", "total").collect()
    for rows in by_key(got).values():
        total = 0
        for r in rows:
            total += r["value"]
            assert r["total"] == total


ORDERS = [[windows.descending("a"), "b"], [windows.descending("t"), windows.descending("a"), "b"], ["t", "b"], ["d", "f", "b"], ["a % 3", "s", "b"], ["y", "b"], ["o", windows.descending("n"), "b"]]


@pytest.mark.parametrize("order", ORDERS, ids=str)
@pytest.mark.parametrize("slices", [1, 7, 60])
def test_numbers_follow_the_order_of_any_type(spark, order, slices):
    order = [F.expr(o) if isinstance(o, str) else o for o in order]
    rows = spark.range(300).selectExpr(
        "id as b", "if(id % 11 = 0, null, id % 17) as a", "if(id % 7 = 0, null, timestamp_micros(id * 977 % 50 * 1000001)) as t", "date_add(date'2024-01-01', int(id % 5)) as d",
        "if(id % 9 = 0, double('NaN'), if(id % 13 = 0, null, (id % 4 - 2) / 3)) as f", "concat('it''s \\\\ é\\n', id % 6) as s", "binary(string(id % 9)) as y", "id % 2 = 0 as o", "cast(id % 8 as decimal(12,4)) as n")
    numbered = windows.sequence_number(rows, order, "number").select("b", "number") if slices == 1 else windows.row_number_per_key(rows, [], order, "number", slices).select("b", "number")
    keys = [o.sort_key() if isinstance(o, windows.Order) else o for o in order]
    assert [r["b"] for r in numbered.orderBy("number").collect()] == [r["b"] for r in rows.orderBy(*keys).collect()]
    assert [r["number"] for r in numbered.orderBy("number").collect()] == list(range(1, 301))


def test_a_thousand_slices_make_a_short_plan(spark):
    """Cuts are constants that an expression looks into: neither the plan nor the generated code, both of which the driver holds, has a branch for each."""
    rows = spark.range(5_000).selectExpr("concat('it''s \\\\ ', id * 7919 % 5000) as a", "if(id % 5 = 0, null, id % 30) as b", "id as c")
    sliced = windows._sliced(rows, ["a"], [windows.descending("b"), "c"], 1_000)
    code = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(sliced._jdf.queryExecution(), "codegen")
    assert len(code) < 250 * 1_000 and code.count("CASE WHEN") < 100
    places = [r["__slice"] for r in sliced.orderBy("a", F.desc("b"), "c").collect()]
    assert places == sorted(places) and len(set(places)) > 900 and places[-1] < 1_000


def test_windows_do_not_store_their_input(spark, tmp_path):
    from pathlib import Path

    code = "".join(p.read_text() for p in Path(windows.__file__).parent.glob("*.py"))
    assert "checkpoint(" not in code


@pytest.mark.parametrize("n, slices", [(3, 1), (3, 400), (5, 8), (7, 1_000)])
def test_recent_average_crosses_slices(skewed, n, slices):
    distinct = skewed.dropDuplicates()
    got = windows.recent_average(distinct, "key", "ts", "value", n, ["id"], slices=slices).collect()
    assert len(got) == distinct.count()
    for rows in by_key(got).values():
        for i, r in enumerate(rows):
            before = [x["value"] for x in rows[max(0, i - n):i]]
            want = sum(before) / len(before) if before else None
            assert r["recent_average"] == (None if want is None else pytest.approx(want))


def test_recent_average_anomaly_needs_a_positive_average(spark):
    df = spark.createDataFrame([("m", i, v) for i, v in enumerate([0.0, 0.0, 9.0, 1.0, 1.0, 30.0])], "key string, ts int, value double")
    hits = windows.recent_avg_anomaly(df, "key", "ts", "value", n=2).collect()
    assert [r["ts"] for r in hits] == [5]


def test_limits(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(9)], "a int, b int")
    assert [tuple(r) for r in windows.top_k(df, "a", 2, ["b"]).collect()] == [(2, 2), (2, 5)]
    assert windows.newest(df.withColumn("t", F.col("b")), "t", 4).count() == 4


def test_recent_average_anomaly_compares_decimals_exactly(spark):
    """The average of three values is no decimal: a value of just three times it does not exceed it."""
    rows = [("a", 1, "3.3333"), ("a", 2, "3.3333"), ("a", 3, "3.3334"), ("a", 4, "10.0000"), ("b", 1, "3.3333"), ("b", 2, "3.3333"), ("b", 3, "3.3334"), ("b", 4, "10.0001")]
    df = spark.createDataFrame(rows, "key string, ts int, value string").withColumn("value", F.col("value").cast("decimal(12,4)"))
    hits = windows.recent_avg_anomaly(df, "key", "ts", "value", n=5)
    assert hits.columns == ["key", "ts", "value", "recent_average"]
    assert [(r["key"], r["ts"]) for r in hits.collect()] == [("b", 4)]

from collections import Counter

from pyspark.sql import functions as F

from stackroom.operators import keyed
from stackroom.operators.keyed import might_be_among
from stackroom.operators.ranking import beyond_first, first_per, last_lines, with_ordinal
from stackroom.plans.extract import lookup


def test_semi_join_shuffled_equals_broadcast(spark):
    # One key holds a third of the rows.
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 1000).cast("string"))).alias("id"),
        F.col("id").alias("n"),
    )
    wanted = rows.where("id = 'hot' OR n % 7 = 0").groupBy("id").agg(F.count(F.lit(1)).alias("n_rows"))
    wide = keyed.semi_join(rows, wanted, "id", max_bytes=0, hot_rows=5_000)
    narrow = keyed.semi_join(rows, wanted, "id")
    assert wide.columns == rows.columns == narrow.columns
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "_salt" in plan
    assert Counter(map(tuple, wide.collect())) == Counter(map(tuple, narrow.collect()))
    # The hot key's rows meet their key in many tasks.
    salted = spark.range(1).select(F.lit(keyed.SALTS)).first()[0]
    assert salted > 8


def test_fits_broadcast_measures_the_keys(spark):
    keys = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 100, "0").alias("id"))
    assert keyed.fits_broadcast(keys, 1000 * (100 + keyed.ROW_OVERHEAD))
    assert not keyed.fits_broadcast(keys, 1000 * (100 + keyed.ROW_OVERHEAD) - 1)
    assert keyed.fits_broadcast(keys.limit(0), 0)


def test_beyond_first_equals_a_plain_ranking(spark):
    rows = spark.range(2_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise((F.col("id") % 5).cast("string")).alias("g"),
        (F.hash("id") % 50).alias("v"),
        F.col("id"),
    )
    local = sorted(rows.collect(), key=lambda r: (r["g"], r["v"], r["id"]))
    for keep in (1, 3, 10_000):
        seen, expected = Counter(), set()
        for row in local:
            seen[row["g"]] += 1
            if seen[row["g"]] > keep:
                expected.add(tuple(row))
        got = beyond_first(rows, "g", [F.col("v"), F.col("id")], keep, F.col("id"))
        assert got.columns == rows.columns
        assert Counter(map(tuple, got.collect())) == Counter(expected)


def test_first_per_and_last_lines(spark):
    rows = [("a", 0, 1, "x"), ("a", 0, 3, "y"), ("a", 1, 0, "w"), ("b", 0, 2, "z")]
    rows = spark.createDataFrame(rows, "file string, block int, row int, value string")
    first = first_per(rows, "file", [-F.col("row")]).collect()
    assert {(r["file"], r["value"]) for r in first} == {("a", "y"), ("b", "z")}
    tail = last_lines(rows, 1)
    assert "WindowGroupLimit" in tail._jdf.queryExecution().executedPlan().toString()
    assert {(r["file"], r["value"]) for r in tail.collect()} == {("a", "w"), ("b", "z")}
    two = {(r["file"], r["from_end"], r["value"]) for r in last_lines(rows, 2).collect()}
    assert two == {("a", 1, "w"), ("a", 2, "y"), ("b", 1, "z")}


def test_last_lines_beyond_the_group_limit(spark):
    """Blocks before the end are not ranked at all, and none is ranked with another."""
    rows = spark.range(6000).selectExpr("'log' file", "id div 500 block", "id row", "cast(id as string) value")
    got = {r["from_end"]: r["value"] for r in last_lines(rows, 2700).collect()}
    assert got == {k: str(6000 - k) for k in range(1, 2701)}
    plan = last_lines(rows, 2700)._jdf.queryExecution().optimizedPlan().toString()
    ranked = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert ranked and all("block#" in line for line in ranked)


def test_ordinals(spark):
    rows = spark.range(0, 5000, 1, 7).selectExpr("id", "id % 13 AS g", "'x' AS ordinal_of")
    got = with_ordinal(rows, [F.col("g"), -F.col("id")]).collect()
    want = sorted(range(5000), key=lambda i: (i % 13, -i))
    assert [r["id"] for r in sorted(got, key=lambda r: r["ordinal"])] == want
    assert sorted(r["ordinal"] for r in got) == list(range(1, 5001))
    assert with_ordinal(rows.where("false"), [F.col("id")]).count() == 0


def test_bloom_filter(spark):
    """No key is lost, few others pass, and rows do not shuffle for it."""
    rows = spark.range(0, 60_000).select(F.concat(F.lit("W"), F.col("id").cast("string")).alias("id"))
    keys = rows.where("id like '%7'")
    passed = might_be_among(rows, keys)
    assert "left_semi" not in passed.columns and passed.columns == ["id"]
    found = {r["id"] for r in passed.collect()}
    wanted = {f"W{k}" for k in range(60_000) if k % 10 == 7}
    assert wanted <= found and len(found - wanted) < 0.03 * 54_000
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning(id" not in plan
    assert might_be_among(rows, keys.where("false")).count() == 0
    nulls = spark.createDataFrame([(None,), ("a",)], "id string")
    assert {r["id"] for r in might_be_among(nulls, nulls).collect()} == {None, "a"}


def test_lookup_beyond_the_bound_filters_before_it_shuffles(spark):
    index = spark.range(0, 50_000).selectExpr("concat('W', id) AS id", "concat('f', id % 7) AS parquet_file")
    asked = index.where("id like '%00'").select("id")
    hits = lookup(index, asked, max_bytes=0)
    assert sorted(r["id"] for r in hits.collect()) == sorted(r["id"] for r in asked.collect())
    plan = hits._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("SortMergeJoin") :]
    assert "BroadcastHashJoin" in below[below.index("Exchange") :]
    assert might_be_among(index, asked).count() < 1.05 * asked.count() + 700


def test_lookup_beyond_the_bound_gathers_the_requests_once(spark):
    """However many parts the index is a union of; and one id in many rows and files counts whole."""
    part = spark.range(0, 20_000).selectExpr("if(id % 3 = 0, 'hot', concat('W', id)) AS id", "concat('f', id % 7) AS parquet_file")
    index = part.unionByName(part.withColumn("parquet_file", F.lit("g"))).unionByName(part.withColumn("parquet_file", F.lit("h")))
    asked = part.where("id = 'hot' OR id like '%0'").select("id")
    hits = lookup(index, asked.unionByName(asked), max_bytes=0)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1
    narrow = lookup(index, asked)
    assert narrow.columns == hits.columns
    assert Counter(map(tuple, hits.collect())) == Counter(map(tuple, narrow.collect()))


def test_bloom_filter_shuffles_places_and_no_bitmaps(spark):
    keys = spark.range(0, 60_000).select(F.concat(F.lit("W"), F.col("id").cast("string")).alias("id"))
    plan = might_be_among(keys, keys)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(bitmap" in line]
    assert dealt and all("REPARTITION_BY_NUM" in line for line in dealt)


def test_parts_follow_the_bytes(spark):
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert keyed.parts_for(spark, 0) == few
    assert keyed.parts_for(spark, 1000 * keyed.PART_BYTES + 1) == 1001

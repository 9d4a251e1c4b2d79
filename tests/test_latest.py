from pyspark.sql import functions as F

from bursa.operators.latest import eod_snapshots, latest_per_key, prefer, top_n
from tests.fixtures import summary_df


def test_latest_per_key_picks_latest_ts(spark):
    s = summary_df(spark)
    out = latest_per_key(s, ["security_code"], [F.col("ts").desc()])
    rows = {r.security_code: r for r in out.collect()}
    assert len(rows) == 5
    assert str(rows["VIZO"].close_price) == "1025.00"


def test_eod_snapshots_bounds_are_text(spark):
    s = summary_df(spark)
    assert eod_snapshots(s, lo="20240115", hi="20240115").count() == 5
    assert eod_snapshots(s, lo="20240116").count() == 0


def test_latest_plan_limits_before_shuffle(spark):
    s = summary_df(spark)
    plan = latest_per_key(s, ["security_code"], [F.col("ts").desc()])._jdf.queryExecution() \
        .executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_prefer_coalesces_per_column(spark):
    a = spark.createDataFrame([("X", 1, None), ("Y", 2, 20)], "k string, p int, q int")
    b = spark.createDataFrame([("X", 9, 90), ("Z", 3, 30)], "k string, p int, q int")
    got = {r.k: (r.p, r.q) for r in prefer(a, b, "k", ["p", "q"]).collect()}
    assert got == {"X": (1, 90), "Y": (2, 20), "Z": (3, 30)}


def test_top_n_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("B", 5), ("A", 5), ("C", 1)], "k string, v int")
    got = [r.k for r in top_n(df, [F.col("v").desc(), "k"], 2).collect()]
    assert got == ["A", "B"]


def test_exact_rank_equals_row_number_with_a_hot_group(spark):
    from pyspark.sql import Window
    from bursa.operators.latest import exact_rank
    df = spark.range(30000).select((F.col("id") % 3 == 0).cast("int").alias("g"),
                                   ((F.col("id") * 7919) % 1009).alias("v"), "id")
    got = exact_rank(df, ["g"], [F.col("v").desc(), "id"], "r")
    exp = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc(), "id"))
                        .cast("int"))
    assert got.select(*exp.columns).exceptAll(exp).count() == 0 and got.count() == exp.count()


def test_exact_rank_with_payload_and_coalescing(spark):
    from pyspark.sql import Window

    from bursa.operators.latest import exact_rank
    df = spark.range(300_000).selectExpr("id", "cast(id % 3 = 0 AS int) g", "hash(id) v", "repeat(cast(id AS string), 8) pay")
    got = exact_rank(df, ["g"], [F.col("v"), "id"], "r")
    want = df.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    both = got.join(want.select("id", "w"), "id")
    assert both.count() == 300_000 and both.where("r <> w").count() == 0

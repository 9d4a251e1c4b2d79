from decimal import Decimal as D

from pyspark.sql import functions as F

from bursa.functions.expr import mark, pct_change, ratio, round_half_away, score
from bursa.operators import candle as C


def test_flags_null_and_zero_edges(spark):
    df = spark.createDataFrame(
        [("A", D("97.00"), D("100.00"), D("97.00"), D("90.00"), None, 150, D("200"), 2),
         ("B", D("50.00"), D("0.00"), D("50.00"), D("50.00"), D("49.10"), 100, None, None),
         ("C", D("96.00"), D("100.00"), D("100.00"), D("90.00"), D("94.12"), 100, D("200"), 2)],
        "code string, current_price decimal(12,2), opening_price decimal(12,2), highest_price decimal(12,2), "
        "lowest_price decimal(12,2), previous_low decimal(12,2), trade_volume bigint, vol_sum decimal(30,0), "
        "vol_days bigint")
    out = df.select(
        "code", C.down_from_open().alias("down"), C.long_lower_shadow().alias("shadow"),
        C.volume_surge().alias("surge"), C.near_support().alias("support"),
        C.lower_shadow_ratio().alias("lsr"), C.price_to_open_ratio().alias("pto"),
    ).collect()
    r = {x.code: x for x in out}
    # A: close 97 <= 0.97*100 exactly; shadow 7 >= 0.6*7; volume 150 >= 1.5*avg(100) exactly
    assert r["A"].down and r["A"].shadow and r["A"].surge and not r["A"].support
    # B: high == low -> ratio 0, no shadow; zero open -> ratio NULL; missing average -> no surge
    assert r["B"].lsr == 0.0 and r["B"].pto is None and not r["B"].shadow and not r["B"].surge
    assert r["B"].support  # 50 <= 1.02 * 49.10 = 50.082
    # C: 90 <= 1.02 * 94.12 = 96.0024 ; close 96 <= 97 -> down
    assert r["C"].support and r["C"].down and r["C"].lsr == 0.6


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_away("x", 2)).collect()]
    assert got == [0.13, -0.13, 2.5, None]
    got0 = [r[0] for r in df.select(round_half_away("x", 0)).collect()]
    assert got0[2] == 3.0


def test_ratio_pct_mark_score(spark):
    df = spark.createDataFrame([(D("110.00"), D("100.00"), True, None)],
                               "a decimal(12,2), b decimal(12,2), f boolean, g boolean")
    r = df.select(ratio("a", "b").alias("r"), pct_change("a", "b").alias("p"), mark("f").alias("m"),
                  mark("g").alias("n"), score("f", "g").alias("s"),
                  pct_change("a", F.lit(0)).alias("z")).first()
    assert (r.r, r.p, r.m, r.n, r.s, r.z) == (1.1, 10.0, "✓", "✗", 1, None)

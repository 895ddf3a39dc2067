from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from stationcast.operators import aggregates as ag
from stationcast.operators import codo
from stationcast.operators import deliveries as dl
from stationcast.operators import joins as jn
from stationcast.operators import ordering as od
from stationcast.operators import sap_dodo as sd
from stationcast.operators.quantiles import exact_medians
from stationcast.run import at

D0 = date(2023, 1, 1)
TRUCK = "RECORD_ID long, STATION string, MATERIAL string, QUANTITY double, STATUS string, DELIVERY_DATE date, DATE_CREATED string"
STOCK = "RECORD_ID long, STATION string, TANK_DESCRIPTION string, PRODUCT string, DIP_READING int, STATUS string, SALES_DATE date, DATE_CREATED string"
METER = (
    "RECORD_ID long, STATION string, METER_DESCRIPTION string, PRODUCT string, PREVIOUS_READING int, CURRENT_READING int, "
    "VOLUME double, TYPE string, UNIT_PRICE double, SALES_VALUE double, DEALER_COMMISSION double, "
    "DEALER_COMMISSION_AMOUNT double, STATUS string, SALES_DATE date, DATE_CREATED string"
)


def day(n):
    return D0 + timedelta(days=n)


def trucks(spark, items):
    data = [(i, s, m, q, "OK", day(d) if d is not None else None, None) for i, (s, m, q, d) in enumerate(items)]
    return spark.createDataFrame(data, TRUCK)


def meters(spark, items):
    data = [(i, s, m, p, 1, 2, v, t, 1.0, v * 2, 0.0, 0.0, "OK", day(d), None) for i, (s, m, p, v, t, d) in enumerate(items)]
    return spark.createDataFrame(data, METER)


def stocks(spark, items):
    data = [(i, s, t, p, dip, "OK", day(d), None) for i, (s, t, p, dip, d) in enumerate(items)]
    return spark.createDataFrame(data, STOCK)


def test_next_delivery_ties_single_and_null(spark):
    df = trucks(spark, [("A", "PMS", 1.0, 0), ("A", "PMS", 2.0, 0), ("A", "PMS", 3.0, 4), ("B", "PMS", 1.0, 2),
                        (None, "PMS", 1.0, 1), (None, "PMS", 1.0, 3), ("A", "PMS", 9.0, None)])
    got = {r.RECORD_ID: r.DATE_LAG for r in dl.next_delivery(df).collect()}
    assert got == {0: day(0), 1: day(4), 2: None, 3: None, 4: day(3), 5: None, 6: None}
    gaps = {r.RECORD_ID: r.NEXT_DELIVERY_DAYS for r in dl.gap_days(dl.next_delivery(df)).collect()}
    assert gaps == {0: 0, 1: 4, 2: None, 3: None, 4: 2, 5: None, 6: None}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("AB"), st.sampled_from(["P", "Q"]), st.integers(0, 40)), min_size=1, max_size=25))
def test_expansion_covers_every_day(spark, items):
    df = trucks(spark, [(s, m, 1.0, d) for s, m, d in items])
    got = dl.sales_days(df).select("STATION", "MATERIAL", "SALES_DATE", "NEXT_DELIVERY_DAYS", "RECORD_ID").collect()
    spans = {r.RECORD_ID: r.NEXT_DELIVERY_DAYS or 0 for r in got}
    assert len(got) == sum(g + 1 for g in spans.values())
    for key in {(s, m) for s, m, _ in items}:
        have = {r.SALES_DATE for r in got if (r.STATION, r.MATERIAL) == key}
        ends = [day(d) for s, m, d in items if (s, m) == key]
        assert have == {min(ends) + timedelta(days=i) for i in range((max(ends) - min(ends)).days + 1)}


def test_left_closed_windows_do_not_share_days(spark):
    df = trucks(spark, [("A", "PMS", 1.0, 0), ("A", "PMS", 2.0, 3), ("A", "PMS", 2.0, 5)])
    got = [r.SALES_DATE for r in dl.sales_days(df, closed="left").collect()]
    assert sorted(got) == [day(i) for i in range(6)]


def test_outer_chain_equals_native_on_hot_and_null_keys(spark):
    a = spark.createDataFrame([("h", i) for i in range(50)] + [(None, 1), ("a", 1)], "k string, x int")
    b = spark.createDataFrame([("h", i) for i in range(20)] + [(None, 2), ("b", 2)], "k string, y int")
    c = spark.createDataFrame([("h", 7), ("b", 3), ("c", 3), (None, 3)], "k string, z int")
    assert rows(jn.outer_chain([a, b, c], ["k"])) == rows(jn.outer_chain([a, b, c], ["k"], bounded=True))


def test_outer_on_expression_keys(spark):
    a = spark.createDataFrame([(" 1 ", "x"), ("2", "y"), (None, "n")], "p string, u string")
    b = spark.createDataFrame([("1", "q"), ("1 ", "r"), ("3", "s"), (None, "t")], "q string, w string")
    native = a.join(b, F.trim("p") == F.trim("q"), "outer")
    assert rows(jn.outer_on(a, b, F.trim("p"), F.trim("q"))) == rows(native)


def test_exact_medians_on_a_hot_group(spark):
    base = spark.range(60000)
    df = base.select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        (F.pmod(F.hash("id"), F.lit(5000)) / 7).alias("v"), F.when(F.col("id") % 5 > 0, F.pmod(F.hash("id"), F.lit(3))).alias("n"),
    ).unionByName(spark.createDataFrame([(None, 2.0, None), (None, 4.0, None)], "k string, v double, n int"))
    got = exact_medians(df, ["k"], {"v": "mv", "n": "mn"}, (F.count("*").alias("c"),))
    want = df.groupBy("k").agg(F.median("v").alias("mv"), F.median("n").alias("mn"), F.count("*").alias("c"))
    assert rows(got.select("k", "mv", "mn", "c")) == rows(want)


def _codo(spark):
    t = trucks(spark, [("A", "P", 10.0, 0), ("A", "P", 10.0, 3), ("A", "P", 10.0, 3), ("A", "P", 20.0, 3), ("A", "Q", 5.0, 1),
                       ("C", "P", 5.0, 1), (None, "P", 5.0, 1)])
    s = stocks(spark, [("A", "T1", "P", 7, 0), ("A", "T1", "P", 9, 1), ("A", "T2", "Q", 4, 2), ("B", "T1", "P", 1, 0)])
    m = meters(spark, [("A", "M1", "P", 3.0, "Sales", 2), ("A", "M1", "P", 4.0, "Sales", 5), ("A", "M2", "Q", 5.0, "Sales", 5),
                       ("A", "M1", "P", 6.0, "Return", 6), ("A", "M1", "Q", 2.0, "Sales", 6), ("D", "M1", "P", 2.0, "Sales", 1),
                       (None, "M1", "P", 2.0, "Sales", 1)])
    return t, s, m


def test_scarcity_equals_join_then_sum(spark):
    t, _, m = _codo(spark)
    assert rows(codo.scarcity(t, m)) == rows(codo.sold_since(codo.sales_since_latest(t, m)))


def _wide(spark):
    """The wide table written the direct way: native outer joins of plain aggregates."""
    t, s, m = _codo(spark)
    orders = codo.sold_since(codo.sales_since_latest(t, m)).join(dl.order_counts(t), ["STATION", "MATERIAL"], "outer")
    tanks = ag.tank_count(s).join(ag.capacity(ag.tank_max(s)), ["STATION"]).join(ag.tank_max(s), ["STATION"])
    profile = m.groupBy(*ag.PROFILE_KEYS).agg(
        F.max("VOLUME").alias("MAX_VOLUME_PRODUCT_SOLD"), F.median("VOLUME").alias("MEDIAN_VOLUME_PRODUCT_SOLD"),
        F.min("VOLUME").alias("MIN_VOLUME_PRODUCT_SOLD"), F.sum("SALES_VALUE").alias("TOTAL_SALES_VALUE"),
        F.max("SALES_VALUE").alias("MAX_SALES_VALUE"), F.median("SALES_VALUE").alias("MEDIAN_SALES_VALUE"),
        F.min("SALES_VALUE").alias("MIN_SALES_VALUE"), F.max("CURRENT_READING").alias("MAX_CURRENT_READING"),
        F.median("CURRENT_READING").alias("MEDIAN_CURRENT_READING"), F.min("CURRENT_READING").alias("MIN_CURRENT_READING"),
        F.max("PREVIOUS_READING").alias("MAX_PREVIOUS_READING"), F.median("PREVIOUS_READING").alias("MEDIAN_PREVIOUS_READING"),
        F.min("PREVIOUS_READING").alias("MIN_PREVIOUS_READING"))
    meter = ag.daily_sales(m).join(profile, ["STATION", "METER_DESCRIPTION"], "outer")
    return orders.join(tanks, ["STATION"], "outer").join(meter, ["STATION"], "outer").select(*codo.CODO_AGG)


def test_wide_table_and_its_summaries(spark):
    wide = _wide(spark).cache()
    f = codo.codo_factors(*_codo(spark))
    assert rows(codo.codo_agg(f).select(*codo.CODO_AGG)) == rows(wide)
    assert len(codo.codo_agg(f, at("2023-02-01")).columns) == len(codo.CODO_AGG) + 5

    volume = F.sum("TOTAL_DAILY_VOLUME_PRODUCT_SOLD").alias("TOTAL_VOLUME_SOLD")
    sold = F.max("TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY_DATE").alias("TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY")
    cap = "TOTAL_STATION_CAPACITY"
    keys = ["STATION", "MATERIAL", "CURRENT_DELIVERY_DATE", "SALES_DATE", cap, "QUANTITY"]
    summary = wide.groupBy(*keys).agg(volume, sold)
    assert rows(codo.station_volume(f)) == rows(summary)
    by_order = summary.groupBy("STATION", "MATERIAL", "CURRENT_DELIVERY_DATE", cap, "QUANTITY").agg(
        F.count("SALES_DATE"), F.sum("TOTAL_VOLUME_SOLD"), F.max("TOTAL_VOLUME_SOLD"), F.max("TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY"))
    got = codo.station_volume_by_order(f).withColumn("SALES_DAYS", F.coalesce("SALES_DAYS", F.lit(0)))
    assert rows(got) == rows(by_order)
    by_day = summary.groupBy("STATION", "SALES_DATE", cap).agg(
        F.sum("TOTAL_VOLUME_SOLD"), F.max("TOTAL_VOLUME_SOLD_POST_CURRENT_DELIVERY"))
    assert rows(codo.station_volume_by_day(f).drop("ORDER_GROUPS", "VOLUME_PER_ORDER_AND_TANK")) == rows(by_day)

    peak = wide.groupBy("STATION", "MATERIAL", "DELIVERY_DATE", "SALES_DATE", cap, "QUANTITY").agg(
        F.max("TOTAL_DAILY_VOLUME_PRODUCT_SOLD").alias("TOTAL_VOLUME_SOLD"), F.max(cap).alias("MAX_STATION_CAPACITY"))
    assert rows(codo.station_volume_max(f)) == rows(peak)
    folded = peak.groupBy("STATION", "MATERIAL", "DELIVERY_DATE", cap, "QUANTITY").agg(F.count("SALES_DATE"), F.max("TOTAL_VOLUME_SOLD"))
    got = codo.station_volume_max_by_order(f).withColumn("SALES_DAYS", F.coalesce("SALES_DAYS", F.lit(0)))
    assert rows(got) == rows(folded)

    totals = wide.groupBy("STATION").agg(
        F.count("*"), F.sum("COUNT_OF_NEW_ORDERS"), F.sum("MAX_DEEP_READING"), F.sum("TOTAL_DAILY_VOLUME_PRODUCT_SOLD"),
        F.max("TOTAL_NUMBER_OF_TANKS"), F.max(cap), F.min("SALES_DATE"), F.max("SALES_DATE"), F.max("MAX_VOLUME_PRODUCT_SOLD"))
    got, want = codo.station_wide_summary(f), totals
    assert rows(got.where("STATION IS NOT NULL")) == rows(want.where("STATION IS NOT NULL"))


def test_wide_filter_reaches_its_part(spark, tmp_path):
    f = codo.codo_factors(*_codo(spark))
    parts = {}
    for p in ("orders", "tanks", "meters"):
        getattr(f, p).write.parquet(str(tmp_path / p))
        parts[p] = spark.read.parquet(str(tmp_path / p))
    plan = codo.codo_agg(codo.StationFactors(**parts)).where("STATION = 'A' AND SALES_DATE = DATE '2023-01-06'")
    scans = [line for line in plan._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert scans and all("EqualTo(STATION,A)" in line for line in scans)
    assert any("EqualTo(SALES_DATE,2023-01-06)" in line for line in scans)


def test_pair_profile_equals_pairs(spark):
    a = spark.createDataFrame([("x", 1, "m"), ("x", 2, "n"), ("y", 3, "m"), (None, 4, "m")], "k string, u int, g string")
    b = spark.createDataFrame([("x", 5), ("x", 6), ("z", 7), (None, 8)], "k string, w int")
    got = jn.pair_profile([(a, F.col("k"), {"u": F.col("u")}), (b, F.col("k"), {"w": F.col("w")})], "k", [["g"], []])
    want = a.join(b, "k").groupBy("k", "g").agg(F.count("*"), F.sum("u"), F.sum("w"))
    assert rows(got) == rows(want)


def test_join_ci_and_station(spark):
    a = spark.createDataFrame([("Ultra A", 1)], "n string, u int")
    b = spark.createDataFrame([("ULTRA a", 2), ("b", 3)], "m string, w int")
    assert rows(jn.join_ci(a, b, "n", "m").select("u", "w")) == [(1, 2)]
    assert jn.join_station(a, b.withColumnRenamed("m", "n"), "n").count() == 0


def test_dedup_on_is_deterministic_and_keeps_nulls(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, "b"), (None, 5, "z")], "k string, t int, v string")
    assert rows(od.dedup_on(df, ["k"], ["t"])) == rows(spark.createDataFrame([("a", 1, "b"), (None, 5, "z")], df.schema))


def test_order_flags(spark):
    df = spark.createDataFrame(
        [(100.0, 95.0, day(0), day(9), None, day(0)), (100.0, 94.9, day(1), None, None, day(0)), (None, 1.0, None, None, None, None)],
        "QUANTITY_ORDERED double, QUANTITY_DELIVERED double, DISPATCH_DATE date, DELIVERY_DATE date, COMPLETED_ON date, SALES_DATE date")
    got = sd.order_metrics(df).select(
        "IS_QUANTITY_DELIVERED_WITHIN_TEMP_THRESHOLD", "DELIVERY_IS_DELAYED", "IS_PRODUCT_IN_TRANSIST", "DELIVERY_DAYS", "SALES_DATE_DAY_OF_WEEK")
    assert [tuple(r) for r in got.collect()] == [(1, 1, 0, 9, "Sun"), (0, 0, 1, None, "Sun"), (0, 0, 0, None, None)]


def test_observed_count_rides_along(spark):
    df, seen = ag.observe_count(spark.range(10), "n")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 10


def test_hot_station_window_is_over_days_only(spark):
    """A station with most of the rows: the window input is one row per day, not per delivery."""
    df = spark.range(20000).select(
        F.col("id").alias("RECORD_ID"), F.lit("HOT").alias("STATION"), F.lit("P").alias("MATERIAL"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("DELIVERY_DATE"))
    got = dl.next_delivery(df)
    assert got.where("DATE_LAG IS NULL").count() == 1
    assert got.where("DATE_LAG > DELIVERY_DATE").count() == 9
    assert got.count() == 20000


def test_medians_of_a_hot_meter_of_two_million_values(spark):
    """No task of the rounds sees more than partial counts; awkward spreads of values go on until one value is left."""
    base = spark.range(0, 2_200_000, 1, 8)
    u = (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) + 1) / 1_000_003
    df = base.select(
        F.when(F.col("id") < 2_000_000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        u.alias("even"), F.pow(F.lit(10.0), u * 600 - 300).alias("wide"), F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.when(F.col("id") % 3 == 1, 2.0).otherwise(2.0 + u / 1e9)).alias("close"),
        F.when(F.col("id") % 4 == 0, float("inf")).when(F.col("id") % 4 == 1, float("-inf")).otherwise(u).alias("ends"),
    )
    want = df.groupBy("k").agg(*[F.median(c).alias(f"m_{c}") for c in ("even", "wide", "close", "ends")])
    got = exact_medians(df, ["k"], {c: f"m_{c}" for c in ("even", "wide", "close", "ends")})
    assert rows(got.select(*want.columns)) == rows(want)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_bracket_beside_the_median_is_mended(spark, monkeypatch):
    """Brackets too narrow, as a bad sketch would give them: the counts still find the middle."""
    from stationcast.operators import quantiles

    monkeypatch.setattr(quantiles, "SLACK", -0.2)  # from rank 0.7 down to 0.3: an empty bracket
    df = spark.range(1001).select((F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 1009 / 3).alias("v"))
    want = df.groupBy("k").agg(F.median("v").alias("m"))
    assert rows(quantiles.exact_medians(df, ["k"], {"v": "m"})) == rows(want)
    monkeypatch.setattr(quantiles, "SLACK", 0.0)
    monkeypatch.setattr(quantiles, "ACCURACY", 2)
    assert rows(quantiles.exact_medians(df, ["k"], {"v": "m"}, buckets=4)) == rows(want)


def test_row_numbers_come_from_partitions(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), F.when(F.col("id") % 10 > 0, F.col("id") % 7).alias("w")).repartition(6)
    got = od.numbered(df, [("w", False), ("v", True)], str(tmp_path / "n"), "AT")
    want = sorted(df.collect(), key=lambda r: (r.w is None, -(r.w or 0), r.v))
    assert [(r.AT, r.v) for r in got.orderBy("AT").collect()] == [(i + 1, r.v) for i, r in enumerate(want)]
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    assert od.numbered(df.limit(0), [("v", True)], str(tmp_path / "none")).count() == 0


def _stages(df):
    """Shuffles of the plan that ran, each counted once."""
    import re

    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(set(re.findall(r"ShuffleQueryStage (\d+)", plan.split("== Initial Plan ==")[0])))


def test_outer_on_deals_each_side_once_as_a_set_of_rows(spark):
    """Copies, rows without a key and keys of one side only: one wide shuffle of a side removes copies and matches keys."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.createDataFrame([(" 1 ", 1), (" 1 ", 1), ("1", 2), (None, 3), (None, 3), (None, 4), ("5", 5)], "p string, x int")
        b = spark.createDataFrame([("1", 7), ("1", 7), ("1", 8), (None, 3), ("6", 6), ("6", 6)], "q string, y int")
        native = a.distinct().join(b.distinct(), F.trim("p") == F.trim("q"), "outer")
        for heavy in (jn.HEAVY_ROWS, 0):  # no key joined apart, and every key
            got = jn.outer_on(a, b, F.trim("p"), F.trim("q"), distinct=True, heavy_rows=heavy)
            assert rows(got) == rows(native)
        # of each side: its counts per bucket, their total, the buckets of both, and the rows themselves
        assert _stages(jn.outer_on(a, b, F.trim("p"), F.trim("q"), distinct=True)) <= 7
    finally:
        for k, x in old.items():
            spark.conf.set(k, x)


def test_outer_left_equals_native(spark):
    a = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", None, 3), (None, None, 4), ("b", "y", 5)], "k string, m string, v int")
    b = spark.createDataFrame([("a", "x", 10), ("a", "x", 10), ("a", None, 30), (None, None, 40), ("c", "z", 60)], "k string, m string, w int")
    got = jn.outer_left(a, b, ["k", "m"])
    assert got.columns == ["k", "m", "v", "w"]
    assert rows(got) == rows(a.join(b, ["k", "m"], "outer"))


def test_scarcity_with_orders_reads_the_meters_once(spark):
    """No second pass over the sales to look for heavy keys; the rows of a native full outer join."""
    orders = spark.createDataFrame([("s", "m", 1), ("s", "m", 2), (None, "m", 3)], "STATION string, MATERIAL string, COUNT_OF_NEW_ORDERS int")
    sc = spark.createDataFrame([("s", "m", 7.0), ("t", "m", 8.0)], "STATION string, MATERIAL string, SOLD double")
    got = codo.scarcity_with_orders(sc, orders)
    assert rows(got) == rows(orders.join(sc, ["STATION", "MATERIAL"], "outer"))
    assert "approx_top_k" not in got._jdf.queryExecution().optimizedPlan().toString()

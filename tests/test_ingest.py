"""Landing trees with the awkward rows every feed brings, loaded twice."""

import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationcast import schemas as sc
from stationcast.operators import shaping as sh
from stationcast.plans import ingest
from stationcast.plans.lake import Lake
from stationcast.run import at
from stationcast.sources import feeds, versions
from stationcast.sources import layers as ly

RUN = at("2023-02-01", "2023-02-01T05:00:00")
RUN2 = at("2023-02-02", "2023-02-02T05:00:00")
START, END = date(2023, 1, 5), date(2023, 1, 9)


def put(path: Path, header, lines=()):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(header), *lines]) + "\n")


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path))


def landing(lake, feed, day):
    return Path(lake.landing(feed.name)) / day / feed.file


def truck_tree(lake):
    f = sc.CODO_TRUCKS
    put(landing(lake, f, "20230105"), f.headers, [
        "1,St John's,PMS,\"33,000\",OK,2023-01-05,05/01/2023 7:05",
        "2,St John's,PMS,,OK,2023-01-05,bad stamp",
        "3,Solo,AGO,100,OK,,06/01/2023 17:45",
    ])
    put(landing(lake, f, "20230107"), f.headers)
    put(landing(lake, f, "20230108"), f.headers, ["4,St John's,PMS,10,OK,2023-01-08,08/01/2023 10:00"])


def test_trucks_twice_and_partitions(spark, lake):
    truck_tree(lake)
    assert ingest.codo_trucks(spark, lake, RUN, START, END)
    silver = lambda: ly.read_layer(spark, lake.silver(sc.CODO_TRUCKS.name))
    first = rows(silver())
    assert ingest.codo_trucks(spark, lake, RUN, START, END)
    assert rows(silver()) == first and len(first) == 4
    got = {r.RECORD_ID: r for r in silver().collect()}
    assert got["1"].QUANTITY == 33000.0 and got["1"].DATE_CREATED == "2023-01-05 07:05"
    assert got["1"].DELIVERY_DATE == date(2023, 1, 5) and got["1"].FILE_NAME.endswith("20230105/codo_stations_truck_deliveries.csv")
    assert got["2"].QUANTITY is None and got["2"].DATE_CREATED is None
    assert got["3"].DELIVERY_DATE is None and got["1"].RUN_DATE_ID == 20230201

    # A later run with a corrected day replaces that day only.
    put(landing(lake, sc.CODO_TRUCKS, "20230108"), sc.CODO_TRUCKS.headers, ["5,New,PMS,7,OK,2023-01-08,08/01/2023 10:00"])
    assert ingest.codo_trucks(spark, lake, RUN2, date(2023, 1, 8), date(2023, 1, 8))
    assert sorted(r.RECORD_ID for r in silver().collect()) == ["1", "2", "3", "5"]

    # Undated rows of another file join the ones already there, and replays do not repeat them.
    put(landing(lake, sc.CODO_TRUCKS, "20230109"), sc.CODO_TRUCKS.headers, ["6,New,PMS,7,OK,,08/01/2023 10:00"])
    for _ in range(2):
        assert ingest.codo_trucks(spark, lake, RUN2, date(2023, 1, 9), date(2023, 1, 9))
    assert sorted(r.RECORD_ID for r in silver().collect()) == ["1", "2", "3", "5", "6"]
    assert silver().where("DELIVERY_DATE IS NULL").count() == 2


def test_no_files_is_no_op(spark, lake):
    Path(lake.landing(sc.PDO_LOADING.name)).mkdir(parents=True)
    assert ingest.pdo_loading(spark, lake, RUN, START, END) is False


def test_header_drift_is_an_error(spark, lake):
    f = sc.CODO_STOCK
    put(landing(lake, f, "20230105"), list(reversed(f.headers)), ["x,2023-01-05,OK,5,PMS,T1,A,1"])
    with pytest.raises(Exception, match="(?i)header"):
        feeds.read_landing(spark, f, lake.landing(), START, END).collect()


def test_stock_and_meter(spark, lake):
    put(landing(lake, sc.CODO_STOCK, "20230105"), sc.CODO_STOCK.headers, ["1,A,T1,PMS,55,OK,2023-01-05,05/01/2023 7:05", "2,A,T1,PMS,n/a,OK,2023-01-05,"])
    put(landing(lake, sc.CODO_METER, "20230105"), sc.CODO_METER.headers,
        ["1,A,M1,PMS,10,20,10.5,Sales,2,21,0.1,2.1,OK,2023-01-05,05/01/2023 7:05"])
    assert ingest.codo_stock(spark, lake, RUN, START, END) and ingest.codo_meter(spark, lake, RUN, START, END)
    s = ly.read_layer(spark, lake.silver(sc.CODO_STOCK.name), run_date=20230201)
    assert rows(s.select("DIP_READING", "SALES_DATE")) == [(None, date(2023, 1, 5)), (55, date(2023, 1, 5))]
    m = ly.read_layer(spark, lake.silver(sc.CODO_METER.name), start=20230131, end=20230202).first()
    assert (m.CURRENT_READING, m.VOLUME, m.SALES_DATE) == (20, 10.5, date(2023, 1, 5))
    assert ly.read_layer(spark, lake.silver(sc.CODO_METER.name), run_date=20230131).count() == 0


def sap_row(**kw):
    base = {c: "" for c in sc.SAP_COLUMNS} | {"LOADING_DATE": "2023-01-05"} | kw
    return ",".join(f'"{base[c]}"' for c in sc.SAP_COLUMNS)


def test_sap_and_dodo(spark, lake):
    put(landing(lake, sc.SAP_LOADING, "20230105"), sc.SAP_LOADING.headers, [
        sap_row(SALES_QUOTATION=" 20291914 ", QUANTITY_ORDERED="45,000", QUANTITY_DELIVERED="-9999", DELIVERY_DATE="2023-01-09", DISPATCH_DATE="x"),
    ])
    line = "Acme,'0020291914,PMS,\"45,000\",R1,P1,10.5,S1,,'77,'88',44,TR,C,05/01/2023 7:05,Lagos,SW,2023-01-08"
    put(landing(lake, sc.DODO_ORDERS, "20230105"), sc.DODO_ORDERS.headers, [line])
    assert ingest.sap_loading(spark, lake, RUN, START, END) and ingest.dodo_orders(spark, lake, RUN, START, END)
    s = ly.read_layer(spark, lake.silver(sc.SAP_LOADING.name)).first()
    assert (s.QUANTITY_ORDERED, s.QUANTITY_DELIVERED, s.DELIVERY_DATE, s.DISPATCH_DATE) == (45000.0, None, date(2023, 1, 9), None)
    d = ly.read_layer(spark, lake.silver(sc.DODO_ORDERS.name)).first()
    assert (d.SAP_QUOTATION_NUMBER, d.SHIPMENT_DOC_NUMBER, d.DELIVERY_DOC_NUMBER) == ("20291914", "88", "77")
    assert (d.QUANTITY, d.QUANTITY_SOLD, d.SALES_DATE, d.SALES_TIME, d.COMPLETED_ON) == (45000.0, None, date(2023, 1, 5), "7:05", date(2023, 1, 8))


def test_pdo_keeps_file_name(spark, lake):
    base = {c: "v" for c in sc.PDO_COLUMNS} | {"LOADING_DATE": "2023-01-06"}
    put(landing(lake, sc.PDO_LOADING, "20230106"), sc.PDO_LOADING.headers, [",".join(base[c] for c in sc.PDO_COLUMNS)])
    assert ingest.pdo_loading(spark, lake, RUN, START, END)
    got = ly.read_layer(spark, lake.silver(sc.PDO_LOADING.name)).first()
    assert got.FILE_NAME and got.LOADING_DATE == date(2023, 1, 6) and got.METER_TICKET_NUMBER == "v"


def test_states(spark, lake):
    put(Path(lake.landing("states")) / "list_of_local_governments.csv", ["SNO", "State", "Local Government Area", ""],
        ["1,Akwa Ibom,Abak,", "2,Lagos,Ikeja,"])
    ingest.state_mapping(spark, lake, RUN)
    got = ly.read_layer(spark, lake.silver("state")).select(*sc.STATE_SILVER)
    assert rows(got) == [("1", "AKWA", "ABAK"), ("2", "LAGOS", "IKEJA")]
    assert "_c3" not in [c.lower() for c in ly.read_layer(spark, lake.bronze("state")).columns]


def book_file(lake, depot, day, label, shuffle=False):
    stems = list(sc.BOOK_STOCK_STEMS)
    if shuffle:
        stems.reverse()
    header = ["S/N", "Depot Name", *[f"{s.replace('_', ' ')} {label}" for s in stems]]
    values = [str(sc.BOOK_STOCK_STEMS.index(s) + 1) + ",000" for s in stems]
    put(Path(lake.landing("book_stock_of_products")) / day / f"{depot}_{day}.csv", header, ['1,"D1",' + ",".join(f'"{x}"' for x in values)])


def test_book_stock_all_depots(spark, lake):
    book_file(lake, "NRL_ABUJA", "20230105", "05-January-23")
    book_file(lake, "NRL_ABUJA", "20230106", "06-January-23", shuffle=True)
    book_file(lake, "NRL_LAGOS", "20230105", "05-January-23")
    for _ in range(2):
        assert ingest.book_stock(spark, lake, RUN, START, END)
    silver = ly.read_layer(spark, lake.silver("book_stock_of_products"))
    assert rows(silver.select("STATION", "BOOK_STOCK_DATE")) == [
        ("NRL_ABUJA", date(2023, 1, 5)), ("NRL_ABUJA", date(2023, 1, 6)), ("NRL_LAGOS", date(2023, 1, 5))]
    for r in silver.collect():
        assert [r[s] for s in sc.BOOK_STOCK_STEMS] == [1000.0 * (i + 1) for i in range(9)]
    assert silver.columns[:14] != [] and set(sc.BOOK_STOCK_SILVER) <= set(silver.columns)


def test_book_stock_missing_stem_is_reported(spark, lake):
    book_file(lake, "NRL_ABUJA", "20230105", "05-January-23")
    p = Path(lake.landing("book_stock_of_products")) / "20230105" / "NRL_ABUJA_20230105.csv"
    p.write_text(p.read_text().replace("DPK LOAD OUT", "OTHER"))
    with pytest.raises(Exception, match="DPK_LOAD_OUT"):
        ingest.book_stock(spark, lake, RUN, START, END)


def test_stems_and_headers(spark):
    df = spark.createDataFrame([(1, 2)], "`OPENING_PMS_BALANCE_05-JANUARY-23` int, X int")
    assert sh.date_from_header(df, "OPENING_PMS", 3, "%d-%B-%y").first().BOOK_STOCK_DATE == "20230105"
    with pytest.raises(ValueError, match="AGO"):
        sh.canonicalize_by_stem(df, ["AGO"])
    with pytest.raises(ValueError, match="collide"):
        sh.normalize_headers(spark.createDataFrame([(1, 2)], "`a b` int, a_b int"))


def test_multiline_pipe_export(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('|Author|Tweet Text\n7|bob|"two\nlines ""quoted"" | pipe"\n')
    df = sh.fix_unnamed(feeds.read_delimited(spark, str(p)), {"_c0": "tweet_id"})
    assert [tuple(r) for r in df.collect()] == [("7", "bob", 'two\nlines "quoted" | pipe')]


def test_tagged_sources_skip_missing(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a"))
    got = ly.read_tagged(spark, {"A": str(tmp_path / "a"), "B": str(tmp_path / "none")})
    assert rows(got) == [(0, "A"), (1, "A")]
    assert ly.read_tagged(spark, {"B": str(tmp_path / "none")}) is None


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    ly.write_full(spark.createDataFrame([(1, "a"), (2, "b")], "x int, d string"), path, "d")
    ly.write_replace(spark.createDataFrame([(3, "b"), (4, "c")], "x int, d string"), path, "d")
    assert rows(ly.read_layer(spark, path)) == [(1, "a"), (3, "b"), (4, "c")]
    ly.write_full(spark.createDataFrame([(9, "z")], "x int, d string"), path, "d")
    assert rows(ly.read_layer(spark, path)) == [(9, "z")]

    raw = str(tmp_path / "raw")
    ly.append_raw(spark.range(2), raw)
    ly.append_raw(spark.range(1), raw)
    assert spark.read.json(raw).count() == 3

    csv = str(tmp_path / "csv")
    feeds.write_landing_csv(spark.createDataFrame([("20230105", "A", 1)], "day string, depot string, v int"), csv, ["day", "depot"])
    assert spark.read.option("header", True).csv(csv).count() == 1
    assert (tmp_path / "csv" / "day=20230105" / "depot=A").is_dir()


def test_publish_append_is_replay_safe(spark):
    df = spark.createDataFrame([("a", 1), ("b ", 2)], "k string, v int")
    ly.publish(df, "default.t_pub", "append", ["k"])
    ly.publish(df.unionByName(spark.createDataFrame([("c", 3)], df.schema)), "default.t_pub", "append", ["k"])
    assert rows(spark.table("default.t_pub")) == [("a", 1), ("b ", 2), ("c", 3)]
    ly.publish(spark.createDataFrame([("z", 9)], df.schema), "default.t_pub")
    assert rows(spark.table("default.t_pub")) == [("z", 9)]


def test_hot_date_is_written_by_several_tasks(spark, tmp_path):
    """Rebalancing splits a large partition value instead of funnelling it through one task."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(200000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("p"), F.lit("2023-01-01").alias("d"))
        ly.write_full(df.repartition(8), str(tmp_path / "hot"), "d")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "hot").glob("*/d=2023-01-01/*.parquet"))) > 1


def test_day_helpers():
    assert feeds.day_range(date(2023, 1, 30), date(2023, 2, 1)) == ["20230130", "20230131", "20230201"]
    assert feeds.reformat_day("050123", "%d%m%y", "%Y%m%d") == "20230105"


def test_range_open_at_either_end(spark, tmp_path):
    path = str(tmp_path / "layer")
    spark.range(10).selectExpr("id", "CAST(id AS INT) AS RUN_DATE_ID").write.parquet(path)
    n = lambda **kw: ly.read_layer(spark, path, **kw).count()
    assert (n(), n(start=3), n(end=3), n(start=3, end=5), n(run_date=4)) == (10, 7, 4, 3, 1)


def test_replay_reads_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "dated")
    df = spark.createDataFrame([("20240101", "a", 1), ("20240102", "a", 2), (None, "b", 3)], "d string, FILE_NAME string, v int")
    ly.write_full(df, path, "d")
    dates = ly.touched_dates(df.where("v <> 2"), "d")
    assert set(dates) == {"20240101", None}
    held = ly.of_dates(ly.read_layer(spark, path), "d", dates)
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "PartitionFilters: [" in plan
    assert sorted(r.v for r in held.collect()) == [1, 3]


def test_later_file_adds_to_an_earlier_day(spark, tmp_path):
    path, schema = str(tmp_path / "late"), "d string, FILE_NAME string, v int"
    first = spark.createDataFrame([("20240101", "a", 1), ("20240102", "a", 2)], schema)
    late = spark.createDataFrame([("20240101", "b", 3)], schema)
    for batch in (first, late, first, late):
        ly.write_replace(batch, path, "d", "FILE_NAME")
        assert ly.read_layer(spark, path).count() in (2, 3)
    assert sorted(r.v for r in ly.read_layer(spark, path).collect()) == [1, 2, 3]


def test_book_stock_without_header_row_is_an_error(spark, tmp_path):
    root = tmp_path / "book"
    for depot, first in (("A", "S/N"), ("B", "No.")):
        folder = root / "20240201"
        folder.mkdir(parents=True, exist_ok=True)
        cells = [first, "Depot", "OPENING PMS BALANCE 01-February-24", *[f"c{i}" for i in range(50)]]
        (folder / f"{depot}_x.csv").write_text(",".join(cells) + "\n" + ",".join(["1", depot, '"1,5"', *["z"] * 50]) + "\n")

    def read(file):
        return feeds.read_dated_headers(spark, str(root), ["20240201"], file, ["OPENING_PMS_BALANCE", "C49"], "S/N", "OPENING_PMS_BALANCE")

    assert [tuple(r)[:4] for r in read("A_*.csv").collect()] == [("1", "A", "1,5", "z")]
    with pytest.raises(Exception, match="no header row.*B_x.csv"):
        read("*.csv").collect()


def _runs(spark, path, days=6):
    """A layer of one run a day, each with two business dates; the last run brings a late row of the first date."""
    for k in range(days):
        rows = [(f"2023-01-{d + 1:02d}", k, 20230101 + k, f"f{k}") for d in ((k, k + 1) if k < days - 1 else (0, k))]
        ly.write_replace(spark.createDataFrame(rows, "d string, v int, RUN_DATE_ID int, FILE_NAME string"), path, "d", "FILE_NAME")


def test_a_run_opens_only_its_own_dates(spark, tmp_path):
    path = str(tmp_path / "layer")
    _runs(spark, path)
    whole = ly.read_layer(spark, path)
    assert whole.count() == 12 and dict(whole.dtypes)["d"] == "string"
    for run, dates in ((20230102, {"2023-01-02", "2023-01-03"}), (20230106, {"2023-01-01", "2023-01-06"})):
        one = ly.read_layer(spark, path, run_date=run)
        opened = {re.search(r"/d=([^/]+)/", f)[1] for f in one.inputFiles()}
        held = {r.d for r in one.collect()}
        assert held == dates
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^\]]+d#", plan) and "2023-01-04" not in plan.split("PushedFilters")[0].split("PartitionFilters")[1]
        # the files read, not the files of the batches that are listed
        read = {re.search(r"/d=([^/]+)/", r[0])[1] for r in one.select(F.input_file_name()).distinct().collect()}
        assert read == dates and opened >= dates
    spans = ly.read_layer(spark, path, start=20230103, end=20230104)
    assert {r.v for r in spans.collect()} == {2, 3}
    assert ly.read_layer(spark, path, start=20240101).count() == 0 and ly.read_layer(spark, path, start=20230105, run_date=20230102).count() == 0


def test_a_write_that_fails_leaves_the_rows_before(spark, tmp_path):
    path = str(tmp_path / "layer")
    _runs(spark, path)
    before = rows(ly.read_layer(spark, path))
    bad = spark.createDataFrame([("2023-01-01", 9, 20230109, "x"), ("2023-01-02", 0, 20230109, "x")], "d string, v int, RUN_DATE_ID int, FILE_NAME string")
    good = bad.where("v = 9")
    bad = bad.repartition(2, "d").withColumn("v", F.when(F.col("v") == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("int"))
    for write in (lambda: ly.write_full(bad, path, "d"), lambda: ly.write_replace(bad, path, "d", "FILE_NAME"), lambda: ly.write_full(bad, path)):
        with pytest.raises(Exception, match="lost"):
            write()
        assert rows(ly.read_layer(spark, path)) == before
    # a reader that began before a write ends as it began
    held = ly.read_layer(spark, path)
    ly.write_full(good, path, "d")
    assert rows(held) == before and ly.read_layer(spark, path).count() == 1
    assert versions.clean(spark, path) >= 6 and ly.read_layer(spark, path).count() == 1 and versions.clean(spark, path) == 0


def test_partitions_keep_their_values(spark, tmp_path):
    """Texts that look like numbers or dates, blanks and nulls, over several batches; then a new column."""
    path = str(tmp_path / "layer")
    values = ["01", "1", "2023-01-01", "a b:c/d", None, "é"]
    for k, some in enumerate((values[:3], values[2:], values[:1])):
        ly.write_replace(spark.createDataFrame([(v, k) for v in some], "d string, v int"), path, "d")
    got = {r.d: r.v for r in ly.read_layer(spark, path).collect()}
    assert got == {"01": 2, "1": 0, "2023-01-01": 1, "a b:c/d": 1, None: 1, "é": 1}
    ly.write_replace(spark.createDataFrame([("1", 7, 0.5)], "d string, v int, w double"), path, "d")
    got = {r.d: (r.v, r.w) for r in ly.read_layer(spark, path).collect()}
    assert got["1"] == (7, 0.5) and got["01"] == (2, None)
    ly.write_full(spark.createDataFrame([], "d string, v int"), path, "d")
    assert ly.read_layer(spark, path).count() == 0 and ly.read_layer(spark, path).columns == ["d", "v"]


def test_no_reader_meets_a_missing_table(spark, tmp_path):
    """A thread reads the table while it is published again and again, by rows and over a layer's files."""
    import threading

    spark.sql("CREATE DATABASE IF NOT EXISTS moved")
    path, seen, wrong, over = str(tmp_path / "layer"), set(), [], threading.Event()
    frame = lambda k: spark.range(4).select("id", F.lit(k).alias("v"), (F.col("id") % 2).alias("d"))

    def put(k):
        ly.publish(frame(k), "moved.rows")
        ly.write_full(frame(k), path, "d")
        ly.publish_path(spark, path, "moved.files")

    def read():
        while not over.is_set():
            for name in ("moved.rows", "moved.files"):
                try:
                    got = [tuple(r) for r in spark.table(name).groupBy("v").count().collect()]
                    if len(got) != 1 or got[0][1] != 4:
                        wrong.append(got)
                    seen.add(got[0][0])
                except Exception as exc:  # noqa: BLE001
                    wrong.append(str(exc)[:300])

    put(0)
    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 8):
        put(k)
    over.set()
    reader.join()
    assert not wrong and len(seen) > 1 and {r.v for r in spark.table("moved.files").collect()} == {7}
    assert spark.table("moved.files").where("d = 1").count() == 2
    # a failing publication leaves the table
    with pytest.raises(Exception, match="lost"):
        ly.publish(frame(9).withColumn("v", F.raise_error(F.lit("lost")).cast("int")), "moved.rows")
    assert spark.table("moved.rows").count() == 4


def test_an_append_of_new_keys_reads_no_gold_file(spark, tmp_path):
    """With the table's files spoiled, new keys can be appended, known ones cannot; without, the result is exact."""
    kind = "keywords string, source string, site string, v int"
    batch = lambda *rows: spark.createDataFrame(list(rows), kind)
    path, keys = str(tmp_path / "gold"), ["keywords", "source"]
    ly.append_new(batch(*[(f"k{i}", "s", f"0{i % 3}", 1) for i in range(300)], (None, "s", None, 1)), path, keys, "site")
    held = {f: f.read_bytes() for f in (tmp_path / "gold").rglob("*.parquet")}
    for f in held:
        f.write_bytes(b"spoiled" * (len(held[f]) // 7 + 1))
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    try:
        ly.append_new(batch(*[(f"new{i}", "s", "01", 2) for i in range(50)]).coalesce(1), path, keys, "site")
        with pytest.raises(Exception):  # noqa: B017
            ly.append_new(batch((" k7 ", "s", "09", 3)), path, keys, "site")
    finally:
        for f, data in held.items():
            f.write_bytes(data)
    ly.append_new(batch((" k7 ", "s", "09", 3), ("k8", "other", "01", 3), (None, " s", "01", 3), ("new3", "s", "05", 3)), path, keys, "site")
    got = rows(ly.read_layer(spark, path).select("keywords", "source", "v"))
    assert len(got) == 352 and ("k8", "other", 3) in got and sum(v == 3 for *_, v in got) == 1
    # the same for a catalog table
    spark.sql("DROP TABLE IF EXISTS default.keyed")
    for rows_ in ([("a", "s", "x", 1), ("b", "s", "x", 1)], [("b ", "s", "x", 2), ("c", "s", "x", 2)], [(None, "s", "x", 3)], [(None, "s", "x", 4)]):
        ly.publish(batch(*rows_), "default.keyed", "append", keys)
    assert sorted((str(r.keywords), r.v) for r in spark.table("default.keyed").collect()) == [("None", 3), ("a", 1), ("b", 1), ("c", 2)]


def test_filters_of_many_keys_miss_none(spark, tmp_path):
    from stationcast.sources import keyfilter

    df = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 4).cast("string").alias("p"))
    for half in ("p < '2'", "p >= '2'"):
        keyfilter.add_keys(df.where(half), str(tmp_path / "t"), ["k"], "p")
    for i in (0, 7, 19999):
        assert str(i % 4) in keyfilter.candidate_parts(df.where(f"k = 'k{i}'"), str(tmp_path / "t"), ["k"])
    strangers = spark.range(2000).select(F.concat(F.lit("x"), "id").alias("k"))
    wrong = sum(bool(keyfilter.candidate_parts(strangers.where(f"k = 'x{i}'"), str(tmp_path / "t"), ["k"])) for i in range(10))
    assert wrong <= 1


def test_silver_is_written_from_bronze_files_without_a_shuffle(spark, lake, monkeypatch):
    """The dates of the batch come from the manifest, and silver takes over bronze's partitions."""
    truck_tree(lake)
    write, given = ingest.write_replace, []
    monkeypatch.setattr(ingest, "write_replace", lambda df, path, *a, **kw: (given.append((path, kw)), write(df, path, *a, **kw)))
    ingest.codo_trucks(spark, lake, RUN, START, END)
    bronze, silver = (path for path, _ in given)
    assert [kw.get("dealt", False) for _, kw in given] == [False, True]
    assert sorted(versions.newest_values(spark, bronze), key=str) == ["2023-01-05", "2023-01-08", None]
    dates = lambda path: rows(ly.read_layer(spark, path).select("RECORD_ID", "DELIVERY_DATE"))
    assert dates(bronze) == dates(silver) and len(dates(silver)) == 4
    files = ly.read_layer(spark, silver).select("_metadata.file_path", F.col("DELIVERY_DATE")).distinct()
    assert files.groupBy("file_path").count().where("count > 1").isEmpty()


def test_a_batch_is_computed_once(spark, tmp_path):
    """What is asked of a batch, whether it is empty, which keys are new, is asked of its rows once written."""
    spark.sql("DROP TABLE IF EXISTS default.counted")
    for add in (lambda df: ly.append_new(df, str(tmp_path / "gold"), ["k"]), lambda df: ly.publish(df, "default.counted", "append", ["k"])):
        for _ in range(2):  # the second batch adds nothing
            seen = spark.sparkContext.accumulator(0)

            def counted(x, seen=seen):
                seen.add(1)
                return f"k{x}"

            add(spark.range(0, 20, 1, 2).select(F.udf(counted, "string")("id").alias("k"), F.col("id").alias("v")))
            assert seen.value == 20
    assert spark.table("default.counted").count() == 20
    assert spark.read.parquet(str(tmp_path / "gold")).count() == 20


def test_anti_trim_tells_keys_apart(spark):
    from stationcast.operators.joins import anti_trim

    new = spark.createDataFrame([("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("1:a", "x"), (" a ", "c"), ("a", None)], "p string, q string")
    gold = spark.createDataFrame([(" a", "b "), ("", "ab"), ("a", "c"), (None, "z")], "p string, q string")
    assert rows(anti_trim(new, gold, ["p", "q"])) == rows(spark.createDataFrame([("ab", ""), (None, "ab"), ("1:a", "x"), ("a", None)], "p string, q string"))


def test_published_keys_are_not_broadcast(spark):
    """However small the files of the keys: their digests can be millions."""
    from stationcast.operators.joins import anti_trim

    new = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    left = anti_trim(new, spark.createDataFrame([("a ",), (None,)], "k string"), ["k"])
    assert rows(left) == [("b",)]
    assert "Broadcast" not in left._jdf.queryExecution().executedPlan().toString()


def test_candidate_parts_of_a_batch_that_is_published(spark, tmp_path, monkeypatch):
    """The first keys settle a partition that holds them; others are looked up by all keys, null ones included."""
    from stationcast.sources import keyfilter

    df = spark.range(600).select(
        F.when(F.col("id") > 0, F.concat(F.lit("k"), "id")).alias("k"), F.when(F.col("id") % 4 < 3, (F.col("id") % 4).cast("string")).alias("p")
    )
    path = str(tmp_path / "t")
    keyfilter.add_keys(df, path, ["k"], "p")
    strangers = spark.range(3).select(F.concat(F.lit("x"), "id").alias("k"))
    for first in (1, 64, 1 << 30):
        monkeypatch.setattr(keyfilter, "FIRST", first)
        assert set(keyfilter.candidate_parts(df, path, ["k"])) == {"0", "1", "2", None}
        for i in (0, 5, 7):
            part = None if i % 4 == 3 else str(i % 4)
            key = "k IS NULL" if not i else f"k = 'k{i}'"
            assert part in keyfilter.candidate_parts(df.where(key), path, ["k"])
        assert keyfilter.candidate_parts(strangers, path, ["k"]) == []


def test_layers_are_kept_in_zstandard(spark, tmp_path):
    """Bronze, silver and gold hold the same text several times over."""
    import pyarrow.parquet as pq

    df = spark.range(50).select(F.col("id"), F.lit("d").alias("day"))
    ly.write_full(df, str(tmp_path / "whole"))
    ly.write_replace(df, str(tmp_path / "dated"), "day")
    ly.append_once(df, str(tmp_path / "once"), "b", "day")
    for layer in ("whole", "dated", "once"):
        files = list((tmp_path / layer).rglob("*.parquet"))
        assert files and {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}
        assert ly.read_layer(spark, str(tmp_path / layer)).count() == 50

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from stationcast import schemas as sc
from stationcast.plans import ingest
from stationcast.run import at
from stationcast.sources.layers import append_once, compact, read_layer, write_replace
from stationcast.streaming.landing import append_batches, daily_totals, first_seen, latest_totals, stream_landing, upsert_totals
from test_ingest import put

RUN = at("2023-02-01")


def test_landing_picks_up_new_files_once(spark, tmp_path):
    f, root, out = sc.CODO_TRUCKS, tmp_path / "landing", str(tmp_path / "bronze")
    seen = []

    def sink(df, batch):
        seen.append(df.count())
        write_replace(ingest.to_bronze(df, f, RUN), out, f.date_column)

    run = lambda: stream_landing(spark, f, str(root), str(tmp_path / "ckpt"), sink)
    put(root / "20230105" / f.file, f.headers, ["1,A,PMS,1,OK,2023-01-05,05/01/2023 7:05"])
    run()
    run()
    assert seen == [1]
    put(root / "20230106" / f.file, f.headers, ["2,A,PMS,1,OK,2023-01-06,06/01/2023 7:05"])
    run()
    assert seen == [1, 1] and read_layer(spark, out).count() == 2


def test_landing_picks_up_compressed_files(spark, tmp_path):
    """Plain and compressed files, each once; files of other kinds are left alone."""
    f, root, out = sc.CODO_TRUCKS, tmp_path / "landing", str(tmp_path / "bronze")
    line = "{0},A,PMS,1,OK,2023-01-05,05/01/2023 7:05"
    put(root / "20230105" / f.file, f.headers, [line.format(1)])
    put(root / "20230105" / "notes.txt", f.headers, [line.format(9)])
    for i, codec in enumerate(("gzip", "bzip2"), 2):
        text = spark.createDataFrame([tuple(line.format(i).split(","))], [f"c{n}" for n in range(len(f.headers))]).toDF(*f.headers)
        text.write.options(header=True, compression=codec).csv(str(root / f"2023010{i}"))
    add = append_batches(out, "trucks", lambda df: ingest.to_bronze(df, f, RUN), f.date_column)
    for _ in range(2):
        stream_landing(spark, f, str(root), str(tmp_path / "ckpt"), add)
    assert sorted(r[0] for r in read_layer(spark, out).select("RECORD_ID").collect()) == ["1", "2", "3"]


def _drain(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()


def test_daily_totals_equal_batch(spark, tmp_path):
    data = [("A", datetime(2023, 1, 5, 3), 2.0, 4.0), ("A", datetime(2023, 1, 5, 23), 3.0, 6.0), ("A", datetime(2023, 1, 6, 1), 1.0, 2.0)]
    src = spark.createDataFrame(data, "STATION string, SALES_TS timestamp, VOLUME double, SALES_VALUE double")
    src.write.parquet(str(tmp_path / "s"))
    _drain(daily_totals(spark.readStream.schema(src.schema).parquet(str(tmp_path / "s"))), "daily", "complete")
    want = src.groupBy("STATION", F.to_date("SALES_TS")).agg(F.sum("VOLUME"), F.sum("SALES_VALUE"))
    assert rows(spark.table("daily")) == rows(want)


def test_first_seen(spark, tmp_path):
    data = [("k", "s", datetime(2023, 1, 5)), ("k", "s", datetime(2023, 1, 6)), ("j", "s", datetime(2023, 1, 5))]
    src = spark.createDataFrame(data, "keywords string, source string, createdAt timestamp")
    src.coalesce(1).write.parquet(str(tmp_path / "s"))
    _drain(first_seen(spark.readStream.schema(src.schema).parquet(str(tmp_path / "s")), ["keywords", "source"]), "seen", "append")
    assert spark.table("seen").count() == 2


def test_a_batch_that_comes_again_adds_nothing(spark, tmp_path):
    """The sink dies once before it has written all, once after; each file's rows are there once."""
    f, root, out = sc.CODO_TRUCKS, tmp_path / "landing", str(tmp_path / "layer")
    add, calls = append_batches(out, "trucks", lambda df: ingest.to_bronze(df, f, RUN), f.date_column), []

    def sink(df, number):
        calls.append(number)
        if len(calls) == 1:
            add(df.withColumn("QUANTITY", F.raise_error(F.lit("lost while writing")).cast("string")), number)
        add(df, number)
        if len(calls) in (2, 4):
            raise RuntimeError("lost after writing")

    run = lambda: stream_landing(spark, f, str(root), str(tmp_path / "ckpt"), sink)
    put(root / "20230105" / f.file, f.headers, ["1,A,PMS,1,OK,2023-01-05,05/01/2023 7:05", "2,A,PMS,1,OK,2023-01-06,05/01/2023 7:05"])
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    assert calls == [0, 0, 0] and read_layer(spark, out).count() == 2
    put(root / "20230106" / f.file, f.headers, ["3,A,PMS,1,OK,2023-01-06,06/01/2023 7:05"])
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert calls == [0, 0, 0, 1, 1] and sorted(r.RECORD_ID for r in read_layer(spark, out).collect()) == ["1", "2", "3"]
    compact(spark, out, f.date_column)
    assert read_layer(spark, out).count() == 3 and not append_once(read_layer(spark, out), out, "trucks-1")


def test_files_of_totals_stay_few(spark, tmp_path):
    """Fifty batches of an update-mode total; some are handed over twice."""
    path, want = str(tmp_path / "totals"), {}
    sink = upsert_totals(path, ["k"], keep=4)
    for n in range(50):
        rows = [(f"k{(n * 7 + i) % 23}", n * 10 + i) for i in range(3)]
        want.update(rows)
        for _ in range(1 + (n % 9 == 0)):
            sink(spark.createDataFrame(rows, "k string, v long").coalesce(1), n)
        if n in (0, 5, 17, 30, 49):
            got = latest_totals(spark, path, ["k"])
            assert {r.k: r.v for r in got.collect()} == want
            assert len(got.inputFiles()) <= 24
    assert len(list((tmp_path / "totals").glob("batch=*"))) <= 8 and len(list((tmp_path / "totals.merged").glob("_batch=*"))) <= 2

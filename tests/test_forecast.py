import zlib
from datetime import date, timedelta
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationcast.operators import forecast as fc
from stationcast.run import at

D0 = date(2023, 1, 1)
RUN = at("2023-06-01")


def points(spark, station, n, f, w=1):
    data = [(station, D0 + timedelta(days=i), None if f(i) is None else float(f(i)), w) for i in range(n)]
    return spark.createDataFrame(data, "station string, ds date, y double, w long")


def weekly(i):
    return 100 + 2 * i + 10 * (i % 7)


@pytest.mark.parametrize("model", [fc.forecast, fc.baseline])
def test_recovers_line_and_week(spark, model):
    got = {r.ds: r for r in model(points(spark, "A", 140, weekly)).collect()}
    assert len(got) == 147
    for i in range(140, 147):
        r = got[D0 + timedelta(days=i)]
        assert abs(r.yhat - weekly(i)) < 4
        assert r.yhat_lower <= r.yhat <= r.yhat_upper and r.y is None
    assert got[D0].y == 100.0


def test_interval_covers_noise(spark):
    import random

    rnd = random.Random(1)
    noise = [rnd.gauss(0, 5) for _ in range(300)]
    df = fc.forecast(points(spark, "A", 300, lambda i: 50 + noise[i])).where("y IS NOT NULL")
    share = df.select(F.avg(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("int"))).first()[0]
    assert 0.9 <= share <= 0.99


def twin(days, y, w, periods, station, interval=0.95, changepoints=25, yearly_from=730, bend_scale=0.05, draws=1000):
    """The same objective minimised another way: accelerated proximal gradient over all coefficients at once."""
    t = np.array([d.toordinal() for d in days], float)
    origin, span, scale, n = t[0], max(t[-1] - t[0], 1.0), np.abs(y).max(), len(t)
    changes = np.linspace(0, 0.8, min(changepoints, max(n // 3 - 1, 0)) + 1)[1:]
    grid = np.concatenate([t, t[-1] + np.arange(1, periods + 1)])

    def design(at):
        z = (at - origin) / span
        waves = [(k, 7.0) for k in (1, 2, 3)] + [(k, 365.25) for k in range(1, 11)] * bool(span >= yearly_from)
        smooth = [np.ones_like(z), z, *(f(2 * np.pi * k * at / p) for k, p in waves for f in (np.sin, np.cos))]
        return np.stack([*smooth, *(np.maximum(z - c, 0) for c in changes)], axis=1), len(smooth)

    x, k = design(t)
    v, target = w / w.mean(), y / scale
    ridge = np.concatenate([[1e-8, 1e-8], np.full(k - 2, 0.01), np.zeros(len(changes))])
    hessian = (x.T * v) @ x + np.diag(ridge)
    step = 1 / np.linalg.eigvalsh(hessian)[-1]
    inverse = np.linalg.inv(hessian[:k, :k])
    free = k - ridge[:k] @ np.diag(inverse)
    beta = np.zeros(x.shape[1])
    beta[:k] = inverse @ ((x.T * v) @ target)[:k]
    for turn in range(5):
        left = target - x @ beta
        variance = v @ left**2 / max(n - free - np.count_nonzero(beta[k:]), 1.0)
        if turn == 4:
            break
        limit = np.concatenate([np.zeros(k), np.full(len(changes), variance / bend_scale)])
        b, u, pace = beta, beta.copy(), 1.0
        for _ in range(200_000):
            g = u - step * (hessian @ u - (x.T * v) @ target)
            new = np.sign(g) * np.maximum(np.abs(g) - step * limit, 0)
            faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
            u, old, b, pace = new + (pace - 1) / faster * (new - b), b, new, faster
            if np.abs(b - old).max() < 1e-12:
                break
        beta = b
    far, _ = design(grid)
    yhat = far @ beta
    sd = np.sqrt(variance) * np.sqrt(1 + ((far[:, :k] @ inverse) * far[:, :k]).sum(axis=1))
    rng, q = np.random.default_rng(zlib.crc32(station.encode())), (1 - interval) / 2
    z = rng.permutation([NormalDist().inv_cdf((i + 0.5) / draws) for i in range(draws)])
    size = 0.0
    if len(changes):
        gram = hessian[k:, k:] - hessian[k:, :k] @ inverse @ hessian[:k, k:]
        size = max(np.abs(beta[k:]).mean(), np.median(variance / bend_scale / np.diag(gram)) / len(changes))
    path = np.zeros((draws, periods))
    if size > 0:
        on, turn = rng.random((draws, periods)) < len(changes) / span, rng.laplace(0.0, size, (draws, periods))
        for d in range(periods):  # a bend on day e moves day d by d - e + 1 days of its slope
            path[:, d] = sum((d - e + 1) * np.where(on[:, e], turn[:, e], 0.0) for e in range(d + 1)) / span
    half = NormalDist().inv_cdf(1 - q) * sd[:n]
    ends = np.quantile(path + z[:, None] * sd[n:], [q, 1 - q], axis=0)
    low, high = np.concatenate([-half, ends[0]]), np.concatenate([half, ends[1]])
    return yhat * scale, (yhat + low) * scale, (yhat + high) * scale


def bent(i):
    return 80 + 3 * min(i, 60) - 2 * max(i - 60, 0) + 6 * ((i * 7919) % 13) / 13 + 5 * (i % 7 == 2)


@pytest.mark.parametrize("n,f", [(120, bent), (40, weekly), (9, bent), (2, weekly)])
def test_fit_and_interval_against_a_second_fit(spark, n, f):
    p = points(spark, "ST", n, f).withColumn("w", F.when(F.dayofmonth("ds") % 3 == 0, 4).otherwise(1).cast("long"))
    got = fc.forecast(p).orderBy("ds").collect()
    days = [D0 + timedelta(days=i) for i in range(n)]
    want = twin(days, np.array([float(f(i)) for i in range(n)]), np.array([4.0 if d.day % 3 == 0 else 1.0 for d in days]), 7, "ST")
    for have, column in zip(want, ("yhat", "yhat_lower", "yhat_upper")):
        assert np.allclose([r[column] for r in got], have, rtol=2e-4, atol=2e-3), column


def test_long_fit_meets_the_conditions_of_a_minimum():
    """Two and a half years with yearly terms: no gradient left but what the penalty holds."""
    t, rng = np.arange(900.0), np.random.default_rng(5)
    y = (50 + 20 * np.sin(2 * np.pi * t / 365.25) + np.array([bent(i) for i in range(900)]) / 9 + rng.normal(0, 1, 900)) / 70
    w = rng.integers(1, 5, 900).astype(float)
    w /= w.mean()
    changes = np.linspace(0, 0.8, 26)[1:]
    s, h = fc._smooth(t, 0.0, 899.0, True), fc._bends(t, 0.0, 899.0, changes)
    ridge = np.r_[1e-8, 1e-8, np.full(s.shape[1] - 2, 0.01)]
    inverse = np.linalg.inv((s.T * w) @ s + np.diag(ridge))
    left = y - s @ inverse @ (s.T * w) @ y
    penalty = w @ left**2 / (900 - s.shape[1] + ridge @ np.diag(inverse)) / 0.05
    smooth, bends, *_ = fc._fit(t, y, w, 0.0, 899.0, changes, True, 0.05, rounds=1)
    left = w * (y - s @ smooth - h @ bends)
    pull = h.T @ left
    assert s.shape[1] == 28 and np.abs(s.T @ left - ridge * smooth).max() < 1e-7
    assert 0 < np.count_nonzero(bends) < 25 and np.abs(pull).max() <= penalty * (1 + 1e-6)
    assert np.allclose(pull[bends != 0], penalty * np.sign(bends[bends != 0]), rtol=1e-6)


def test_most_bends_are_zero_and_the_right_one_is_found():
    t = np.arange(200.0)
    y = np.where(t < 80, t, 160 - t) / 80 + np.random.default_rng(3).normal(0, 0.02, 200)
    changes = np.linspace(0, 0.8, 26)[1:]
    _, bends, noise, *_ = fc._fit(t, y, np.ones(200), 0.0, 199.0, changes, False, 0.05)
    at = changes[np.argmax(np.abs(bends))] * 199
    assert np.count_nonzero(bends) <= 8 and abs(at - 80) < 12 and 0.015 < noise < 0.03


def test_interval_widens_over_the_horizon(spark):
    p = points(spark, "A", 120, bent).unionByName(points(spark, "B", 150, lambda i: 40 + (i * 31 % 17)))
    for station in ("A", "B"):
        width = [r[0] for r in fc.forecast(p).where(f"station = '{station}' AND y IS NULL").orderBy("ds").select(F.col("yhat_upper") - F.col("yhat_lower")).collect()]
        assert len(width) == 7 and width[-1] > width[0]
    again = [fc.forecast(p).where("station = 'A'").orderBy("ds").collect() for _ in range(2)]
    assert again[0] == again[1]


def test_held_back_days_are_covered(spark):
    """Random walks of the slope with noise: what the interval assumes."""
    rng = np.random.default_rng(11)
    data = []
    for k in range(60):
        slope = np.cumsum(np.where(rng.random(200) < 0.05, rng.laplace(0, 0.4, 200), 0)) + 1
        y = 100 + np.cumsum(slope) + 8 * np.sin(2 * np.pi * np.arange(200) / 7) + rng.normal(0, 6, 200)
        data += [(f"S{k}", D0 + timedelta(days=i), float(v), 1) for i, v in enumerate(y)]
    found = fc.holdout(spark.createDataFrame(data, "station string, ds date, y double, w long")).agg(F.sum("days"), F.sum("covered"), F.count(F.lit(1))).first()
    assert found[0] == 420 and found[2] == 60 and 0.85 <= found[1] / found[0] <= 0.99


def test_bad_station_does_not_stop_others(spark):
    p = points(spark, "A", 20, weekly).unionByName(points(spark, "B", 1, weekly)).unionByName(points(spark, "C", 5, lambda i: None))
    assert {r.station for r in fc.forecast(p).select("station").distinct().collect()} == {"A"}
    report = fc.forecast(p, on_error="report").where("fit_error IS NOT NULL").collect()
    assert sorted(r.station for r in report) == ["B", "C"] and "fewer than two" in report[0].fit_error
    assert {r.station for r in fc.baseline(p).select("station").distinct().collect()} == {"A"}


def test_horizon_is_history_plus_seven(spark):
    p = points(spark, "A", 9, weekly).unionByName(points(spark, "B", 3, weekly))
    assert fc.horizon(p).count() == 9 + 7 + 3 + 7


def test_weighted_fit_equals_raw_rows(spark):
    raw = spark.createDataFrame(
        [("A", D0 + timedelta(days=i), float(v)) for i in range(30) for v in (i, i + 4, i + 8)], "STATION string, SALES_DATE date, QUANTITY double")
    s = fc.series(raw, fc.QUANTITY)
    assert s.count() == 30 and s.first().w == 3
    assert s.where(F.col("ds") == D0).first().y == 4.0


def test_attach_and_publish(spark):
    p = points(spark, "A", 10, weekly)
    f = fc.baseline(p)
    assert fc.attach_actuals(f, p).count() == 17
    assert fc.attach_actuals(f, p, "inner").count() == 10
    named = fc.publish_names(fc.attach_actuals(f, p), fc.DELAYS)
    assert named.columns == ["FORECASTED_DATE", "FORCASTED_VALUE", "LOWER_FORCASTED_VALUE", "UPPER_FORCASTED_VALUE", "DELIVERY_STATION", "ACTUAL_VALUE"]
    assert named.orderBy("FORECASTED_DATE").first()[0] == "20230101"


def _models(spark, actual_q):
    base = [("A", "2023-01-01")]
    gap = spark.createDataFrame([(*base[0], 2.6, 3)], "STATION string, FORECASTED_SALES_DATE string, FORCASTED_NEXT_DELIVERY_DAYS double, ACTUAL_VALUE int")
    sales = spark.createDataFrame([(*base[0], 10.4, 9.0)], "STATION string, FORECASTED_SALES_DATE string, FORCASTED_DAILY_SALES_VOLUME double, ACTUAL_VOLUME_SOLD double")
    qty = spark.createDataFrame([(" A ", "2023-01-01", 80.0, actual_q)], "STATION string, FORECASTED_SALES_DATE string, FORCASTED_DAILY_SALES_VOLUME double, ACTUAL_VALUE double")
    return gap, sales, qty


def test_combine_codo(spark):
    r = fc.combine_codo(*_models(spark, 100.0), RUN).first()
    assert (r.FORCASTED_NEXT_DELIVERY_DAYS, r.NEXT_OPTIMAL_ORDER_DATE) == (3.0, "2023-01-06")
    assert r.NEXT_OPTIMAL_ORDER_DATE_REASON == "Your order likely to take: 3 days"
    assert fc.combine_codo(*_models(spark, None), RUN).count() == 0
    free = fc.combine_codo(*_models(spark, None), RUN, require_actuals=False).first()
    assert free.NEXT_OPTIMAL_ORDER_DATE == "2023-01-05"
    df = spark.createDataFrame([(3.0,)], "FORCASTED_NEXT_DELIVERY_DAYS double")
    assert fc.reason(df, compat=True).first()[1] == "Your order likely to take: 3.0 days"


def test_zero_volume_gives_no_date(spark):
    df = spark.createDataFrame([("2023-01-01", 5.0, 0.0)], "FORECASTED_SALES_DATE string, ACTUAL_QUANTITY double, FORCASTED_DAILY_SALES_VOLUME double")
    assert fc.next_order_date(df).first()["NEXT_OPTIMAL_ORDER_DATE"] is None


def test_fit_runs_on_workers_without_the_package(tmp_path):
    """A driver elsewhere, which alone knows where the library is."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(f'''
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from stationcast.operators.forecast import forecast
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
points = spark.sql("SELECT 's' AS station, date_add(DATE'2024-01-01', CAST(id AS INT)) AS ds, CAST(id AS DOUBLE) AS y, 1L AS w FROM range(20)")
print("ROWS", forecast(points).count())
''')
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS 27" in done.stdout, done.stderr[-2000:]


def test_short_series_share_a_batch_and_a_long_one_spans_several():
    """One Arrow batch in and out holds many stations; a station cut by a batch is fitted whole, a failed one is a row."""
    import pyarrow as pa

    series = [(f"S{k:03}", D0 + timedelta(days=i), float(3 * i + k), 1.0) for k in range(50) for i in range(1 if k == 7 else 6)]
    columns = [pa.array(x, t) for x, t in zip(zip(*series), (pa.string(), pa.date32(), pa.float64(), pa.float64()))]
    table = pa.RecordBatch.from_arrays(columns, names=["station", "ds", "y", "w"])

    def fit(station, days, y, w):
        return fc._fit_station(station, days, y, w, 7, 0.95, 25, 730, 0.05, 1000)

    out = list(fc._fit_batches(iter([table.slice(0, 100), table.slice(100, 3), table.slice(103)]), fit, 7))
    assert len(out) == 1
    got = out[0].to_pylist()
    assert len(got) == 49 * 13 + 1 and [r["station"] for r in got if r["fit_error"]] == ["S007"]
    last = {r["station"]: r for r in got}
    assert all(abs(last[f"S{k:03}"]["yhat"] - (3 * 12 + k)) < 0.5 for k in range(50) if k != 7)
    assert last["S049"]["y"] is None and last["S049"]["ds"] == D0 + timedelta(days=12)

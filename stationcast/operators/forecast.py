"""Per-station forecasts.

Series are first reduced to one weighted point per station and day, so the group a model sees is
bounded by the calendar however many rows a station has; the weighted least-squares fit equals the
fit over the raw rows. All stations are fitted in parallel.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as fx
from ..run import RunContext
from .filters import complete_rows, require
from .shaping import with_audit


@dataclass(frozen=True)
class Target:
    """One forecast: where its series comes from and how its table is published."""

    key: str
    ds: str
    y: str
    date_name: str
    date_format: str
    forecast_name: str
    actual_name: str
    interval: bool = False


# The published column names and date formats of the five models.
ORDERS = Target("DELIVERY_STATION", "SALES_DATE", "QUANTITY_ORDERED", "FORECASTED_DATE", "yyyyMMdd",
                "FORCASTED_ORDER", "ACTUAL_VALUE", True)
DELAYS = Target("DELIVERY_STATION", "DELIVERY_DATE", "DELIVERY_DAYS", "FORECASTED_DATE", "yyyyMMdd",
                "FORCASTED_VALUE", "ACTUAL_VALUE", True)
SALES = Target("STATION", "SALES_DATE", "TOTAL_VOLUME_SOLD", "FORECASTED_SALES_DATE", "yyyy-MM-dd",
               "FORCASTED_DAILY_SALES_VOLUME", "ACTUAL_VOLUME_SOLD")
QUANTITY = Target("STATION", "SALES_DATE", "QUANTITY", "FORECASTED_SALES_DATE", "yyyy-MM-dd",
                  "FORCASTED_DAILY_SALES_VOLUME", "ACTUAL_VALUE")
NEXT_DELIVERY = Target("STATION", "SALES_DATE", "NEXT_DELIVERY_DAYS", "FORECASTED_SALES_DATE", "yyyy-MM-dd",
                       "FORCASTED_NEXT_DELIVERY_DAYS", "ACTUAL_VALUE")


def series(df: DataFrame, target: Target, agg: str = "avg") -> DataFrame:
    """(station, ds, y, w): the day's value and the number of rows behind it."""
    value = F.col(target.y).cast("double")
    fold = {"avg": F.avg, "sum": F.sum}[agg]
    return (
        df.where(F.col(target.ds).isNotNull() & F.col(target.key).isNotNull())
        .groupBy(F.col(target.key).alias("station"), F.col(target.ds).alias("ds"))
        .agg(fold(value).alias("y"), F.count(value).alias("w"))
    )


def _ahead(points: DataFrame, periods: int) -> DataFrame:
    """Append the following days to each station: its last row opens into ``periods`` more."""
    last = F.max("ds").over(Window.partitionBy("station"))
    steps = F.when(F.col("ds") == F.col("_last"), F.lit(periods)).otherwise(F.lit(0))
    rows = points.withColumn("_last", last).withColumn("_step", F.explode(F.sequence(F.lit(0), steps)))
    return rows.withColumn("ds", F.date_add("ds", F.col("_step"))).drop("_last")


def horizon(points: DataFrame, periods: int = 7) -> DataFrame:
    """History days plus the following ``periods`` days."""
    return _ahead(points, periods).select("station", "ds")


def baseline(points: DataFrame, periods: int = 7, level: float = 1.96) -> DataFrame:
    """Linear trend plus mean weekday residual, as aggregates over one window per station.

    A series has at most one row per day, so the window group is bounded by the calendar and the
    whole model takes a single shuffle. ``y`` is carried along, null on horizon days.
    """
    w = Window.partitionBy("station")
    x = F.datediff("ds", "_t0").cast("double")
    trend = F.coalesce(F.col("_a"), F.lit(0.0)) + F.coalesce(F.col("_b"), F.lit(0.0)) * x
    season = F.get("_week", F.dayofweek("ds") - 1)
    df = points.withColumn("_t0", F.min(F.when(F.col("y").isNotNull(), F.col("ds"))).over(w))
    df = df.withColumns({
        "_b": F.regr_slope("y", x).over(w), "_a": F.regr_intercept("y", x).over(w), "_n": F.count("y").over(w),
    }).where(F.col("_n") >= 2)
    df = df.withColumn("_r", F.col("y") - trend)
    df = df.withColumn("_week", F.array(*[
        F.avg(F.when(F.dayofweek("ds") == d, F.col("_r"))).over(w) for d in range(1, 8)
    ]))
    df = df.withColumn("_sd", F.coalesce(F.stddev_pop(F.col("_r") - season).over(w), F.lit(0.0)))
    df = _ahead(df, periods)
    yhat = trend + F.coalesce(season, F.lit(0.0))
    return df.select(
        "station", "ds", yhat.alias("yhat"), (yhat - level * F.col("_sd")).alias("yhat_lower"),
        (yhat + level * F.col("_sd")).alias("yhat_upper"), F.when(F.col("_step") == 0, F.col("y")).alias("y"),
    )


FORECAST_SCHEMA = "station string, ds date, yhat double, yhat_lower double, yhat_upper double, y double, fit_error string"


def _smooth(t, origin: float, span: float, yearly: bool):
    """Level, slope, week and, for long series, year, one row per day."""
    import numpy as np

    scaled = (t - origin) / span
    parts = [np.ones_like(scaled), scaled]
    for k in range(1, 4):
        parts += [np.sin(2 * np.pi * k * t / 7.0), np.cos(2 * np.pi * k * t / 7.0)]
    if yearly:
        for k in range(1, 11):
            parts += [np.sin(2 * np.pi * k * t / 365.25), np.cos(2 * np.pi * k * t / 365.25)]
    return np.stack(parts, axis=1)


def _bends(t, origin: float, span: float, changes):
    """What a unit change of slope at each of the places adds."""
    import numpy as np

    return np.clip(((t - origin) / span)[:, None] - changes[None, :], 0, None)


def _sparse(gram, target, penalty: float, start, sweeps: int = 2000, tol: float = 1e-10):
    """Minimises x'Gx / 2 - c'x + penalty * |x|_1 by coordinate descent from ``start``."""
    import numpy as np

    # plain floats: a series has few bends, and array calls on so few numbers cost more than the sums
    x, grad, rows = start.tolist(), (target - gram @ start).tolist(), gram.T.tolist()
    places = [k for k in range(len(x)) if rows[k][k] > 1e-14]
    for _ in range(sweeps):
        moved = 0.0
        for k in places:
            row, held = rows[k], x[k]
            own = row[k]
            rho = grad[k] + own * held
            size = max(abs(rho) - penalty, 0.0) / own
            new = size if rho > 0 else -size
            if new != held:
                step = new - held
                grad = [g - r * step for g, r in zip(grad, row)]
                moved = max(moved, abs(step))
                x[k] = new
        if moved < tol:
            break
    x = np.array(x)
    # given which are not zero and their signs, the minimum is a linear system
    on = np.flatnonzero(x)
    if len(on):
        exact, *_ = np.linalg.lstsq(gram[np.ix_(on, on)], target[on] - penalty * np.sign(x[on]), rcond=None)
        if (np.sign(exact) == np.sign(x[on])).all():
            x[on] = exact
    return x


def _fit(t, y, w, origin: float, span: float, changes, yearly: bool, bend_scale: float, rounds: int = 4):
    """Weighted fit of smooth terms (ridge) and bends (L1). The smooth terms are solved for exactly given the bends, so
    that coordinate descent runs over the bends alone. The penalty of a bend is the noise variance over ``bend_scale``,
    as for a Laplace prior of that scale; the variance comes from the fit before. ``w`` has mean one.

    Returns the smooth coefficients, the bends, the noise deviation, the inverse of the smooth terms' matrix, and the mean
    size of a bend; that is at least what one bend, too small to show against the penalty, would make it."""
    import numpy as np

    s, h = _smooth(t, origin, span, yearly), _bends(t, origin, span, changes)
    ridge = np.full(s.shape[1], 0.01)
    ridge[:2] = 1e-8
    sw, hw = s.T * w, h.T * w
    inverse = np.linalg.inv(sw @ s + np.diag(ridge))
    cross, sy, hy = sw @ h, sw @ y, hw @ y
    gram, target = hw @ h - cross.T @ inverse @ cross, hy - cross.T @ inverse @ sy
    free = s.shape[1] - float(ridge @ np.diag(inverse))
    bends = np.zeros(h.shape[1])
    for k in range(rounds + 1):
        smooth = inverse @ (sy - cross @ bends)
        left = y - s @ smooth - h @ bends
        variance = float(w @ left**2) / max(len(y) - free - np.count_nonzero(bends), 1.0)
        if k == rounds or not len(bends):
            break
        bends = _sparse(gram, target, variance / bend_scale, bends)
    if not len(bends):
        return smooth, bends, variance**0.5, inverse, 0.0
    hidden = np.median(variance / bend_scale / np.maximum(np.diag(gram), 1e-14)) / len(bends)
    return smooth, bends, variance**0.5, inverse, max(float(np.abs(bends).mean()), float(hidden))


_QUANTILES: dict = {}  # shipped by value with the fit, so no cached function


def _quantiles(draws: int):
    """Draws of the normal distribution, evenly spread; the same for every series."""
    from statistics import NormalDist

    import numpy as np

    if draws not in _QUANTILES:
        _QUANTILES[draws] = np.array([NormalDist().inv_cdf((i + 0.5) / draws) for i in range(draws)])
    return _QUANTILES[draws]


def _spread(deviations, places: int, size: float, span: float, tail: float, draws: int, seed: int):
    """Lower and upper distance from the forecast on each day ahead: noise, and bends drawn as often and as large as those
    of the history. Draws share their noise between days and are a function of the seed alone."""
    import numpy as np

    noise, days = _quantiles(draws), len(deviations)
    paths = 0.0
    if size > 0:
        rng = np.random.default_rng(seed)
        noise = rng.permutation(noise)
        happens = rng.random((draws, days)) < min(places / span, 1.0)
        turns = np.where(happens, rng.laplace(0.0, size, (draws, days)), 0.0)
        paths = np.cumsum(np.cumsum(turns, axis=1), axis=1) / span
    return np.quantile(paths + noise[:, None] * deviations[None, :], [tail, 1 - tail], axis=0)


def _fit_station(station, days, y, w, periods: int, interval: float, changepoints: int, yearly_from: int, bend_scale: float, draws: int):
    """Forecast of one station from its days in order (as day numbers), the day's values and weights: yhat and the ends of
    its interval, for these days and ``periods`` more."""
    import zlib
    from statistics import NormalDist

    import numpy as np

    usable = ~np.isnan(y) & (w > 0)
    if usable.sum() < 2:
        raise ValueError("fewer than two points")
    if np.isnan(days).any():
        raise ValueError("a point without a day")
    day, y, w = days[usable], y[usable], w[usable]
    origin, span = day[0], max(day[-1] - day[0], 1.0)
    changes = np.linspace(0, 0.8, min(changepoints, max(len(day) // 3 - 1, 0)) + 1)[1:]
    yearly, scale = span >= yearly_from, float(np.abs(y).max()) or 1.0
    smooth, bends, noise, inverse, size = _fit(day, y / scale, w / w.mean(), origin, span, changes, yearly, bend_scale)
    grid = np.concatenate([days, days[-1] + np.arange(1, periods + 1)])
    x = _smooth(grid, origin, span, yearly)
    yhat = x @ smooth + _bends(grid, origin, span, changes) @ bends
    # noise of a day, and what is not known of the smooth terms
    deviation = noise * np.sqrt(1 + np.einsum("ij,jk,ik->i", x, inverse, x))
    tail, past = (1 - interval) / 2, len(days)
    low = NormalDist().inv_cdf(tail) * deviation
    low, high = low, -low
    low[past:], high[past:] = _spread(deviation[past:], len(bends), size, span, tail, draws, zlib.crc32(str(station).encode()))
    return yhat * scale, (yhat + low) * scale, (yhat + high) * scale


#: Forecast rows that a task gathers before it hands them on.
BATCH_ROWS = 8192


def _fit_batches(batches, fit, periods: int):
    """Rows (station, ds, y, w), station by station and each in the order of its days, to rows of FORECAST_SCHEMA. A batch
    holds many short series, or a part of a long one; a failed fit is one row that says why."""
    import numpy as np
    import pyarrow as pa

    kinds = [pa.string(), pa.date32(), *[pa.float64()] * 4, pa.string()]
    held, ready, size = [], [], 0

    def flush():
        stations, counts, days, *figures, errors = zip(*ready)
        columns = [
            pa.array(np.repeat(np.array(stations, object), counts), kinds[0]), pa.concat_arrays(days),
            *[pa.array(np.concatenate(f), kinds[2], from_pandas=True) for f in figures], pa.array(np.repeat(np.array(errors, object), counts), kinds[-1]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["station", "ds", "yhat", "yhat_lower", "yhat_upper", "y", "fit_error"])

    def close():
        """The held station, fitted."""
        station = held[0][0]
        days, y, w = (np.concatenate(parts) for parts in list(zip(*held))[1:])
        last = np.argsort(days, kind="stable")  # a day that is missing comes last
        days, y, w = days[last], y[last], w[last]
        try:
            fitted = fit(station, days, y, w)
            known = np.concatenate([days, days[-1] + np.arange(1, periods + 1)]).astype(np.int32)
            ready.append((station, len(known), pa.array(known, pa.int32()).cast(pa.date32()), *fitted, np.concatenate([y, np.full(periods, np.nan)]), None))
        except Exception as exc:
            none = np.array([np.nan])
            ready.append((station, 1, pa.nulls(1, pa.date32()), none, none, none, none, f"{type(exc).__name__}: {exc}"))
        held.clear()
        return ready[-1][1]

    for batch in batches:
        stations = batch.column("station").to_pylist()
        days = batch.column("ds").cast(pa.int32()).cast(pa.float64()).to_numpy(zero_copy_only=False)
        y, w = (batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("y", "w"))
        cuts = [i for i in range(1, len(stations)) if stations[i] != stations[i - 1]]
        for a, b in zip([0, *cuts], [*cuts, len(stations)]):
            if a == b:
                continue
            if held and held[0][0] != stations[a]:
                size += close()
                if size >= BATCH_ROWS:
                    yield flush()
                    ready, size = [], 0
            held.append((stations[a], days[a:b], y[a:b], w[a:b]))
    if held:
        close()
    if ready:
        yield flush()


def forecast(
    points: DataFrame, periods: int = 7, interval: float = 0.95, on_error: str = "skip", changepoints: int = 25,
    yearly_from: int = 730, bend_scale: float = 0.05, draws: int = 1000,
) -> DataFrame:
    """Fit every station in parallel. A station whose fit fails is skipped, or reported as one row
    with ``fit_error`` when ``on_error="report"``; the others survive either way. ``y`` holds the
    day's actual, null on horizon days.

    The trend may bend at ``changepoints`` days spread over the first 80 % of the series, one for each three points
    at most; an L1 penalty leaves most of them straight, fewer the larger ``bend_scale``. Yearly terms are fitted to
    series of ``yearly_from`` days or more. Beyond the history the interval widens: ``draws`` futures, seeded by the
    station's name, go on bending as often and as sharply as the history did.
    A task fits its stations one after the other, many to an Arrow batch, so short series cost little beside their fit.
    The fit is shipped by value: workers need numpy, not this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

    def run(batches):
        def fit(station, days, y, w):
            return _fit_station(station, days, y, w, periods, interval, changepoints, yearly_from, bend_scale, draws)

        return _fit_batches(batches, fit, periods)

    rows = points.select(F.col("station").cast("string").alias("station"), F.col("ds").cast("date").alias("ds"), F.col("y").cast("double").alias("y"), F.col("w").cast("double").alias("w"))
    out = rows.repartition("station").sortWithinPartitions("station", "ds").mapInArrow(run, FORECAST_SCHEMA)
    if on_error == "report":
        return out
    return out.where(F.col("fit_error").isNull()).drop("fit_error")


def holdout(points: DataFrame, periods: int = 7, **settings) -> DataFrame:
    """How the forecast does on days it has not seen: each station is fitted without its last ``periods`` days, which are
    then compared: station, days (with an actual), covered (actual within the interval), mae, width (mean)."""
    last = F.max("ds").over(Window.partitionBy("station"))
    rows = points.withColumn("_held", F.col("ds") > F.date_sub(last, periods))
    fitted = forecast(rows.where("NOT _held"), periods, **settings).where("y IS NULL").drop("y")
    held = rows.where("_held AND y IS NOT NULL").select("station", "ds", "y")
    both = fitted.join(held, ["station", "ds"])
    return both.groupBy("station").agg(
        F.count(F.lit(1)).alias("days"), F.count_if(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper"))).alias("covered"),
        F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("mae"), F.avg(F.col("yhat_upper") - F.col("yhat_lower")).alias("width"),
    )


def attach_actuals(fc: DataFrame, points: DataFrame, how: str = "left") -> DataFrame:
    """Stored forecast rows with the day's actual; ``how="inner"`` drops the horizon."""
    return fc.drop("y").join(points.select("station", "ds", "y"), ["station", "ds"], how)


def publish_names(fc: DataFrame, target: Target) -> DataFrame:
    cols = [F.date_format("ds", target.date_format).alias(target.date_name), F.col("yhat").alias(target.forecast_name)]
    if target.interval:
        stem = target.forecast_name
        cols += [F.col("yhat_lower").alias(f"LOWER_{stem}"), F.col("yhat_upper").alias(f"UPPER_{stem}")]
    cols += [F.col("station").alias(target.key), F.col("y").alias(target.actual_name)]
    return fc.select(*cols)


def combine_sap(delays: DataFrame, orders: DataFrame, run: RunContext) -> DataFrame:
    """Delay and order forecasts on (date, station)."""
    left = delays.select(
        "FORECASTED_DATE", "DELIVERY_STATION", F.round("FORCASTED_VALUE", 0).alias("FORCASTED_DELIVERY_DAYS"),
        F.col("ACTUAL_VALUE").alias("ACTUAL_DELIVERY_DAYS"),
    )
    right = orders.select(
        "FORECASTED_DATE", "DELIVERY_STATION", "FORCASTED_ORDER", F.col("ACTUAL_VALUE").alias("ACTUAL_ORDER")
    )
    return with_audit(left.join(right, ["FORECASTED_DATE", "DELIVERY_STATION"], "inner"), run)


def merge_codo(gap: DataFrame, sales: DataFrame, qty: DataFrame) -> DataFrame:
    """Next-delivery, sales and quantity forecasts on (station, date)."""
    on = ["STATION", "FORECASTED_SALES_DATE"]
    g = gap.select(*on, "FORCASTED_NEXT_DELIVERY_DAYS", F.col("ACTUAL_VALUE").alias("ACTUAL_NEXT_DELIVERY_DAYS"))
    s = sales.select(*on, "FORCASTED_DAILY_SALES_VOLUME", "ACTUAL_VOLUME_SOLD")
    q = qty.select(
        F.trim("STATION").alias("STATION"), "FORECASTED_SALES_DATE",
        F.col("FORCASTED_DAILY_SALES_VOLUME").alias("FORECASTED_QUANTITY"),
        F.col("ACTUAL_VALUE").alias("ACTUAL_QUANTITY"),
    )
    return g.join(s, on, "inner").join(q, on, "inner")


def next_order_date(df: DataFrame, share: float = 0.5, quantity: str = "ACTUAL_QUANTITY") -> DataFrame:
    """Day on which the given share of the delivered quantity is sold at the forecast volume."""
    wait = F.round(fx.safe_div(F.col(quantity) * share, "FORCASTED_DAILY_SALES_VOLUME"), 0).try_cast("int")
    day = F.date_add(fx.parse_date("FORECASTED_SALES_DATE", "yyyy-MM-dd"), wait)
    return df.withColumn("NEXT_OPTIMAL_ORDER_DATE", F.date_format(day, "yyyy-MM-dd"))


def reason(df: DataFrame, compat: bool = False) -> DataFrame:
    """Reason text; compat prints the rounded double (``3.0``)."""
    span = F.col("FORCASTED_NEXT_DELIVERY_DAYS")
    span = span.cast("string") if compat else span.cast("bigint").cast("string")
    return df.withColumn(
        "NEXT_OPTIMAL_ORDER_DATE_REASON", F.concat(F.lit("Your order likely to take: "), span, F.lit(" days"))
    )


def combine_codo(
    gap: DataFrame, sales: DataFrame, qty: DataFrame, run: RunContext, require_actuals: bool = True
) -> DataFrame:
    """Published station forecast. Without ``require_actuals`` horizon days stay and the order date
    is computed from the forecast quantity."""
    merged = merge_codo(gap, sales, qty)
    if require_actuals:
        merged = complete_rows(merged)
    else:
        merged = require(merged, "FORCASTED_NEXT_DELIVERY_DAYS", "FORCASTED_DAILY_SALES_VOLUME", "FORECASTED_QUANTITY")
    merged = merged.withColumns({
        "FORCASTED_NEXT_DELIVERY_DAYS": F.round("FORCASTED_NEXT_DELIVERY_DAYS", 0),
        "FORCASTED_DAILY_SALES_VOLUME": F.round("FORCASTED_DAILY_SALES_VOLUME", 0),
    })
    quantity = "ACTUAL_QUANTITY" if require_actuals else "FORECASTED_QUANTITY"
    return with_audit(reason(next_order_date(merged, quantity=quantity)), run)

"""Gold to forecast tables, and the two published forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import forecast as fc
from ..operators.cleaning import strip_apostrophes
from ..operators.filters import require
from ..operators.shaping import with_audit
from ..run import RunContext
from ..sources.layers import publish, read_layer, write_full, write_replace
from .lake import Lake

MODEL_TABLES = {
    "orders": "sap_dodo_orders_model",
    "delays": "sap_dodo_delay_model",
    "sales": "codo_model",
    "quantity": "codo_raw_model",
    "next_delivery": "codo_next_delivery_model",
}
TARGETS = {
    "orders": fc.ORDERS, "delays": fc.DELAYS, "sales": fc.SALES, "quantity": fc.QUANTITY,
    "next_delivery": fc.NEXT_DELIVERY,
}


def target_points(features: DataFrame, name: str) -> DataFrame:
    """Series of one target from its gold table: sap_dodo features, or daily station products."""
    target = TARGETS[name]
    if name == "orders":
        rows = require(strip_apostrophes(features), "SALES_DATE", "DELIVERY_DATE")
    elif name == "delays":
        rows = require(strip_apostrophes(features), "DELIVERY_DAYS", "DELIVERY_DATE")
    else:
        rows = require(features, "SALES_DATE")
    return fc.series(rows, target)


def model_table(features: DataFrame, name: str, periods: int = 7, keep_horizon: bool = True) -> DataFrame:
    """Forecast of one target with its actuals under the published names."""
    return _named(fc.forecast(target_points(features, name), periods), name, keep_horizon)


def _named(fitted: DataFrame, name: str, keep_horizon: bool = True) -> DataFrame:
    return fc.publish_names(fitted if keep_horizon else require(fitted, "y"), TARGETS[name])


def failures(fitted: DataFrame) -> DataFrame:
    """Stations whose fit failed, and why."""
    return fitted.where("fit_error IS NOT NULL").select("station", "fit_error")


def run_forecast(spark: SparkSession, lake: Lake, run: RunContext, name: str) -> None:
    """Fit one target on the run's gold rows and write its model table; stations that could not be fitted
    are in the table's ``_errors`` neighbour."""
    sap_side = name in ("orders", "delays")
    gold = "sap_dodo_feature_store" if sap_side else "codo_daily_station_product"
    features = read_layer(spark, lake.gold(gold), run_date=run.run_date_id)
    path = lake.gold(MODEL_TABLES[name])
    # fitted once, written, and read back for the two tables
    fitted = fc.forecast(target_points(features, name), on_error="report")
    write_full(fitted, f"{path}_fits")
    fitted = read_layer(spark, f"{path}_fits")
    write_full(with_audit(failures(fitted), run), f"{path}_errors")
    table = with_audit(_named(fitted.where("fit_error IS NULL"), name), run)
    if sap_side:
        write_full(table, path, TARGETS[name].date_name)
    else:
        write_replace(table, path, TARGETS[name].date_name)


def _model(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    from pyspark.sql import functions as F

    date = TARGETS[name].date_name
    df = read_layer(spark, lake.gold(MODEL_TABLES[name]))
    # The partition column comes back typed from its folder names; the contract is text.
    text = F.date_format(date, TARGETS[name].date_format) if dict(df.dtypes)[date] == "date" else F.col(date).cast("string")
    return df.withColumn(date, text)


def publish_sap(spark: SparkSession, lake: Lake, run: RunContext, table: str = "default.sap_dodo_forecast") -> None:
    publish(fc.combine_sap(_model(spark, lake, "delays"), _model(spark, lake, "orders"), run), table)


def publish_codo(
    spark: SparkSession, lake: Lake, run: RunContext, table: str = "default.codo_forecast", require_actuals: bool = True
) -> None:
    models = [_model(spark, lake, n) for n in ("next_delivery", "sales", "quantity")]
    publish(fc.combine_codo(*models, run, require_actuals), table)

"""Weekly demand per category: history, forecasts, backtests."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise import model
from tillwise.functions.columns import gbp, int_div, ratio, week_start
from tillwise.functions.scale import null_safe_join, stage
from tillwise.operators import dims

HORIZON = 12
BACKTEST_WEEKS = 8
MAPE_TARGET = 15.0
Z80 = 1.2815515655446004  # 90 % quantile of the normal distribution: an 80 % interval


def weekly_category_sales(lines: DataFrame, orders: DataFrame, products: DataFrame, keep_returns: bool = False) -> DataFrame:
    """Units and revenue per category and week (Monday)."""
    kept = lines if keep_returns else lines.filter(~F.col("is_returned"))
    sales = kept.join(orders.select("order_id", "order_date"), "order_id").join(
        products.select(F.col("product_id").alias("_id"), "category"), F.col("product_id") == F.col("_id")
    )
    return sales.groupBy(week_start("order_date").alias("ds"), "category").agg(
        F.sum("units_sold").cast("bigint").alias("units_sold"), F.sum("net_revenue_pence").cast("bigint").alias("revenue_pence")
    ).select("ds", "category", "units_sold", gbp("revenue_pence").alias("revenue"))


def _weeks_ahead(df: DataFrame, horizon: int) -> DataFrame:
    return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_w")).withColumn(
        "ds", F.date_add("last_ds", (F.col("_w") * 7).cast("int"))
    )


def _level(weekly: DataFrame, window: int) -> DataFrame:
    """Mean of the last rows per category. A category has one row per week of the calendar."""
    newest = Window.partitionBy("category").orderBy(F.desc("ds"))
    last = weekly.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= window)
    return last.groupBy("category").agg(F.avg("units_sold").alias("level"), F.max("ds").alias("last_ds"))


def moving_average_forecast(weekly: DataFrame, horizon: int = HORIZON, window: int = 4) -> DataFrame:
    """Flat forecast from the mean of the last weeks, 20 % bounds; history is kept with its own value as bounds."""
    whole = lambda factor: F.bround(F.col("level") * factor, 0).cast("bigint")
    future = _weeks_ahead(_level(weekly, window), horizon).select(
        "ds", "category", whole(1.0).alias("yhat"), whole(0.8).alias("yhat_lower"), whole(1.2).alias("yhat_upper"),
        F.lit(True).alias("is_forecast"),
    )
    units = F.col("units_sold")
    history = weekly.select(
        "ds", "category", units.alias("yhat"), units.alias("yhat_lower"), units.alias("yhat_upper"), F.lit(False).alias("is_forecast")
    )
    return history.unionByName(future)


def backtest_split(weekly: DataFrame, weeks: int = BACKTEST_WEEKS) -> DataFrame:
    """Add `part`: train up to the last weeks, test after. Categories with fewer weeks are left out, as too short to test."""
    per_category = Window.partitionBy("category")
    marked = weekly.withColumns({"_last": F.max("ds").over(per_category), "_n": F.count(F.lit(1)).over(per_category)})
    is_test = F.col("ds") > F.date_sub("_last", 7 * weeks)
    return marked.filter(F.col("_n") >= weeks).select(*weekly.columns, F.when(is_test, "test").otherwise("train").alias("part"))


def backtest_moving_average(weekly: DataFrame, weeks: int = BACKTEST_WEEKS) -> DataFrame:
    """Predictions for the held-out weeks from the weeks before them."""
    split = backtest_split(weekly, weeks)
    train = split.filter(F.col("part") == "train").drop("part")
    level = _level(train, 4).withColumn("yhat", F.bround("level", 0).cast("bigint"))
    return _weeks_ahead(level, weeks).select("ds", "category", "yhat")


def mape(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """Mean absolute percentage error per category; weeks without sales do not count.

    Every category of `actual` gets a row, with null where nothing can be compared.
    """
    p = predicted.select(F.col("ds").alias("_ds"), F.col("category").alias("_category"), "yhat")
    both = null_safe_join(actual.select("ds", "category", "units_sold"), p, {"ds": "_ds", "category": "_category"}, "left")
    y, yhat = F.col("units_sold").cast("decimal(19,0)"), F.col("yhat").cast("decimal(19,0)")
    # error in 10^-6 percent, as an integer, so that the mean does not depend on the order of addition
    error = int_div(F.abs(yhat - y) * F.lit(200_000_000) + F.abs(y), F.nullif(F.abs(y) * 2, F.lit(0).cast("decimal(21,0)")))
    return both.groupBy("category").agg(F.sum(error).alias("_sum"), F.count(error).alias("_n")).select(
        "category", ratio("_sum", "_n * 1000000", 4).alias("mape_pct")
    )


def forecast_accuracy(mapes: DataFrame, target: float = MAPE_TARGET) -> DataFrame:
    """Each category's error, whether it meets the target, and how many do; best first, unknown last."""
    ok = F.coalesce(F.col("mape_pct") <= target, F.lit(False))
    on_target = mapes.agg(F.count_if(ok).alias("categories_on_target"), F.count(F.lit(1)).alias("categories"))
    return mapes.crossJoin(F.broadcast(on_target)).select(  # one row
        "category", "mape_pct", ok.alias("on_target"), "categories_on_target", "categories"
    ).orderBy(F.asc_nulls_last("mape_pct"), "category")


# --- seasonal model -------------------------------------------------------------------------

WAVES = 6  # pairs of yearly sine and cosine terms
UNIT = 1_000_000  # regressors are whole millionths, so their sums do not depend on the order of addition
TERMS = 2 + 2 * WAVES + 2  # intercept, trend, waves, holidays, promotions
SHRINKAGE = 1e-3  # keeps the fit defined where a regressor never varies


def week_regressors(weekly: DataFrame, horizon: int) -> DataFrame:
    """(week, holidays, promotions): days under a holiday's influence and promotion days in the seven days from `week` on.

    All days of the calendar between the first week and the end of the forecast are looked at.
    """
    bounds = weekly.agg(F.date_sub(F.min("ds"), model.HOLIDAY_DAYS_AFTER).alias("a"), F.date_add(F.max("ds"), 7 * horizon + 6).alias("b"))
    days = dims.describe_dates(dims.spine_between(bounds, "a", "b"))
    effect = dims.effect_days(days.filter("is_uk_public_holiday").select("holiday_name", F.col("full_date").alias("holiday_date")))
    marked = effect.select(F.col("effect_date").alias("d")).distinct().select("d", F.lit(1).alias("h"), F.lit(0).alias("p")).unionByName(
        days.filter("is_promotional").select(F.col("full_date").alias("d"), F.lit(0).alias("h"), F.lit(1).alias("p"))
    )
    weeks = marked.select("h", "p", F.explode(F.sequence(F.date_sub("d", 6), F.col("d"))).alias("week"))
    return weeks.groupBy("week").agg(F.sum("h").alias("holidays"), F.sum("p").alias("promotions"))


def _micro(value: Column) -> Column:
    return F.floor(value * UNIT + 0.5).cast("bigint")


def _regressors() -> Column:
    """The terms of a week as an array, from columns t (days since the first week), waves, holidays, promotions."""
    years = F.col("t") / 365.25
    angle = years * (2 * math.pi)
    waves = [
        F.when(F.col("waves") >= k, _micro(wave(angle * k))).otherwise(F.lit(0).cast("bigint"))
        for k in range(1, WAVES + 1) for wave in (F.sin, F.cos)
    ]
    return F.array(F.lit(UNIT).cast("bigint"), _micro(years), *waves, F.col("holidays") * UNIT, F.col("promotions") * UNIT)


def solve_normal(system: Column, terms: int = TERMS) -> Column:
    """The solution of a symmetric positive definite system, given as rows of an array with the right side in the last column.

    Gauss-Jordan elimination, for which such a system needs no exchange of rows.
    """
    def eliminate(rows: Column, k: Column) -> Column:
        pivot = rows[k]
        return F.transform(rows, lambda row, i: F.when(i == k, F.transform(row, lambda v: v / row[k])).otherwise(
            F.zip_with(row, pivot, lambda v, w: v - row[k] / pivot[k] * w)
        ))

    steps = F.sequence(F.lit(0), F.lit(terms - 1))
    return F.transform(F.aggregate(steps, system, eliminate), lambda row: row[terms])


def _with_terms(weekly: DataFrame, horizon: int, min_weeks: int) -> DataFrame:
    """Weeks of the series and of the forecast (`y` null) with their array of terms `x` and `n` weeks of history."""
    known = weekly.select("ds", "category", F.col("units_sold").alias("y")).filter("ds IS NOT NULL AND y IS NOT NULL")
    series = known.groupBy(F.col("category").alias("_category")).agg(
        F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"), F.count(F.lit(1)).alias("n")
    ).filter(F.col("n") >= min_weeks)
    history = null_safe_join(known, series, {"category": "_category"}).select("category", "ds", "y", "first_ds", "n")
    ahead = _weeks_ahead(series, horizon).select(
        F.col("_category").alias("category"), "ds", F.lit(None).cast("bigint").alias("y"), "first_ds", "n"
    )
    rows = history.unionByName(ahead).withColumns({
        "t": F.date_diff("ds", "first_ds"), "waves": F.when(F.col("n") >= 104, WAVES).when(F.col("n") >= 26, 2).otherwise(0)
    })
    # One row a week of the calendar.
    joined = rows.join(F.broadcast(week_regressors(known, horizon)), F.col("ds") == F.col("week"), "left")
    joined = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("holidays", "promotions")})
    return joined.select("category", "ds", "y", "n", "waves", _regressors().alias("x"))


def seasonal_coefficients(rows: DataFrame) -> DataFrame:
    """(category, beta): least squares with a little shrinkage, from sums of products per category.

    A row of the normal equations is a group of its own, so no task ever holds a series.
    """
    parts = rows.filter("y IS NOT NULL").select("category", F.posexplode("x").alias("i", "xi"), "x", "y")
    product = lambda other: F.sum(F.col("xi").cast("decimal(18,0)") * other.cast("decimal(18,0)"))
    sums = parts.groupBy("category", "i").agg(*[product(F.col("x")[j]).alias(f"s{j}") for j in range(TERMS)], product(F.col("y")).alias("s_y"))
    scaled = [
        F.col(f"s{j}").cast("double") / float(UNIT) ** 2 + F.when((F.col("i") == j) & (F.col("i") > 0), SHRINKAGE).otherwise(0.0)
        for j in range(TERMS)
    ]
    row = F.array(*scaled, F.col("s_y").cast("double") / float(UNIT))
    systems = sums.groupBy("category").agg(F.array_sort(F.collect_list(F.struct("i", row.alias("row")))).alias("rows"))  # TERMS rows
    return systems.select("category", solve_normal(F.transform("rows", lambda r: r["row"])).alias("beta"))


def _fitted(weekly: DataFrame, horizon: int, min_weeks: int) -> DataFrame:
    """The forecast's columns with `n`, the series' weeks of history."""
    rows = _with_terms(weekly, horizon, min_weeks)
    beta = seasonal_coefficients(rows).withColumnRenamed("category", "_category")
    fitted = null_safe_join(rows, beta, {"category": "_category"}).withColumn(
        "fit", F.aggregate(F.zip_with("x", "beta", lambda x, b: x * b), F.lit(0.0), lambda s, v: s + v) / UNIT
    )
    residual = F.col("y") - F.col("fit")
    free = F.greatest(F.lit(1), F.col("n") - (4 + 2 * F.col("waves")))
    spread = F.sqrt(F.sum(residual * residual).over(Window.partitionBy("category")) / free) * Z80
    whole = lambda v: F.rint(F.greatest(v, F.lit(0.0))).cast("bigint")
    return fitted.withColumn("spread", spread).select(
        "ds", "category", whole(F.col("fit")).alias("yhat"), whole(F.col("fit") - F.col("spread")).alias("yhat_lower"),
        whole(F.col("fit") + F.col("spread")).alias("yhat_upper"), F.col("y").isNull().alias("is_forecast"), "n",
    )


def seasonal_forecast(weekly: DataFrame, horizon: int = HORIZON, min_weeks: int = BACKTEST_WEEKS) -> DataFrame:
    """Trend, yearly season, holidays and promotions per category, fitted on all its weeks, with an 80 % interval.

    Categories with fewer than `min_weeks` weeks give no rows. Series under 104 weeks have two pairs of yearly
    terms, under 26 weeks none. A window over a category holds a row per week.
    """
    return _fitted(weekly, horizon, min_weeks).drop("n")


def backtest_seasonal(weekly: DataFrame, weeks: int = BACKTEST_WEEKS) -> DataFrame:
    train = backtest_split(weekly, weeks).filter(F.col("part") == "train").drop("part")
    return seasonal_forecast(train, weeks, min_weeks=1).filter("is_forecast").select("ds", "category", "yhat")


def held_out(weekly: DataFrame, weeks: int = BACKTEST_WEEKS) -> DataFrame:
    return backtest_split(weekly, weeks).filter(F.col("part") == "test").drop("part")


def forecast_all(weekly: DataFrame, horizon: int = HORIZON, weeks: int = BACKTEST_WEEKS) -> DataFrame:
    """The seasonal forecast of every category, with its backtest error attached.

    A category's whole series and the part before its held-out weeks are two series of one fit. The latter is
    tested on the `weeks` weeks that follow it only, as `backtest_seasonal` is, also where the forecast reaches further.
    """
    of = lambda df, kind: df.select(
        "ds", F.struct("category", F.lit(kind).alias("kind")).alias("category"), "units_sold"
    )
    train = backtest_split(weekly, weeks).filter(F.col("part") == "train")
    fits = stage(_fitted(of(weekly, "all").unionByName(of(train, "train")), max(horizon, weeks), 1).select(
        "ds", F.col("category.category").alias("category"), F.col("category.kind").alias("kind"), "yhat", "yhat_lower", "yhat_upper", "is_forecast", "n"
    ), "seasonal-fits")
    last = F.max(F.when(~F.col("is_forecast"), F.col("ds"))).over(Window.partitionBy("category"))
    until = lambda df, ahead: df.withColumn("_last", last).filter(F.col("ds") <= F.date_add("_last", 7 * ahead))
    tested = until(fits.filter("kind = 'train'"), weeks).filter("is_forecast")
    errors = mape(tested, held_out(weekly, weeks)).select(F.col("category").alias("_category"), "mape_pct")
    whole = until(fits.filter(f"kind = 'all' AND n >= {weeks}"), horizon)
    return null_safe_join(whole.drop("kind", "n", "_last"), errors, {"category": "_category"}, "left")


def forecast_with_fallback(forecast: DataFrame, mapes: DataFrame, fallback: DataFrame, max_mape: float = 20.0) -> DataFrame:
    """The model's forecast where its error is acceptable, the fallback for the other categories."""
    good = mapes.filter(F.col("mape_pct") <= max_mape).select(F.col("category").alias("_category"))
    kept = forecast.join(good, F.col("category") == F.col("_category"), "left_semi").withColumn("model", F.lit("seasonal"))
    rest = fallback.join(good, F.col("category") == F.col("_category"), "left_anti").withColumn("model", F.lit("moving_average"))
    return kept.unionByName(rest)


def _recent_shares(forecast: DataFrame, lines: DataFrame, orders: DataFrame, products: DataFrame, weeks: int) -> DataFrame:
    """(category, product_id, units, all_units): a product's and its category's units in the last `weeks` weeks of history."""
    last_actual = forecast.filter(~F.col("is_forecast")).groupBy("category").agg(F.max("ds").alias("_last"))
    # Only orders that can be in some category's last weeks are joined: a one-row bound cuts the others.
    earliest = last_actual.agg(F.min("_last").alias("_earliest"))
    late = orders.select("order_id", "order_date").crossJoin(F.broadcast(earliest)).filter(
        F.col("order_date") > F.date_sub("_earliest", 7 * weeks)
    )
    sales = lines.filter(~F.col("is_returned")).join(late.select("order_id", "order_date"), "order_id")
    per_day = sales.groupBy("product_id", "order_date").agg(F.sum("units_sold").alias("units"))
    known = per_day.join(products.select(F.col("product_id").alias("_id"), "category"), F.col("product_id") == F.col("_id"))
    recent = null_safe_join(known, last_actual.withColumnRenamed("category", "_category"), {"category": "_category"}).filter(
        week_start("order_date") > F.date_sub("_last", 7 * weeks)
    )
    per_product = recent.groupBy("category", "product_id").agg(F.sum("units").alias("units"))
    per_category = recent.groupBy(F.col("category").alias("_category")).agg(F.sum("units").alias("all_units"))
    return null_safe_join(per_product, per_category, {"category": "_category"})


def product_daily_forecast(
    forecast: DataFrame, lines: DataFrame, orders: DataFrame, products: DataFrame, weeks: int = 4,
    first_day: date | None = None, last_day: date | None = None,
) -> DataFrame:
    """Spread category forecasts over products and days by their share of recent units.

    The share is taken over the last `weeks` weeks of history; a week is divided evenly over its
    days. Units are in thousandths. A date range cuts the days before products are attached.
    """
    days = forecast.filter("is_forecast").select(
        "category", "yhat", F.explode(F.sequence(F.col("ds"), F.date_add("ds", 6))).alias("forecast_date")
    )
    if first_day is not None:
        days = days.filter(F.col("forecast_date") >= F.lit(first_day))
    if last_day is not None:
        days = days.filter(F.col("forecast_date") <= F.lit(last_day))
    shares = _recent_shares(forecast, lines, orders, products, weeks)
    spread = null_safe_join(shares, days.withColumnRenamed("category", "_category"), {"category": "_category"})
    milli = int_div(F.col("yhat") * F.col("units") * 2000 + F.col("all_units") * 7, F.nullif(F.col("all_units") * 14, F.lit(0)))
    return spread.select("product_id", "category", "forecast_date", milli.alias("forecast_milli_units"),
                         (milli.cast("double") / 1000.0).alias("forecast_units"))


def product_daily_units(forecast: DataFrame, lines: DataFrame, orders: DataFrame, products: DataFrame, weeks: int = 4) -> DataFrame:
    """As `product_daily_forecast` in whole units that add up: days to the week's forecast, products to the day's.

    A day gets what the week's units have reached by its end more than by its start. A product gets the whole part of
    its share, and the units then left go one each to the largest remainders, the smaller product id first. A window
    holds the products of a category on a day.
    """
    reached = lambda k: int_div(F.col("yhat") * k, 7)
    days = forecast.filter("is_forecast").select(
        F.col("category").alias("_category"), "ds", "yhat", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("k")
    ).select("_category", F.date_add("ds", F.col("k")).alias("forecast_date"), (reached(F.col("k") + 1) - reached(F.col("k"))).alias("day_units"))
    shares = _recent_shares(forecast, lines, orders, products, weeks).filter("all_units > 0")
    share = F.col("day_units").cast("decimal(19,0)") * F.col("units")
    spread = null_safe_join(shares, days, {"category": "_category"}).withColumns(
        {"whole": int_div(share, F.col("all_units")).cast("bigint"), "part": (share % F.col("all_units")).cast("bigint")}
    )
    group = Window.partitionBy("category", "forecast_date")
    place = F.row_number().over(group.orderBy(F.desc("part"), "product_id"))
    left = F.col("day_units") - F.sum("whole").over(group)
    return spread.select(
        "product_id", "category", "forecast_date", (F.col("whole") + (place <= left).cast("bigint")).alias("forecast_units")
    )

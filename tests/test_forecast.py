"""The seasonal model against numpy, and against effects planted into the series."""

import math
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillwise.operators import dims
from tillwise.operators import forecast as FC

START = date(1996, 1, 1)  # a Monday; holidays of these years come from the rules


def weeks(n):
    return [START + timedelta(weeks=k) for k in range(n)]


def frame(spark, series):
    rows = [(d, c, v) for c, values in series.items() for d, v in zip(weeks(len(values)), values)]
    return spark.createDataFrame(rows, "ds date, category string, units_sold bigint")


@pytest.fixture(scope="module")
def regressors(spark):
    weekly = frame(spark, {"a": [1] * 200})
    return {r["week"]: (r["holidays"], r["promotions"]) for r in FC.week_regressors(weekly, 12).collect()}


def test_regressors_count_days(spark, regressors):
    holidays = {r["holiday_date"] for r in dims.bank_holidays(spark.createDataFrame([(y,) for y in range(1995, 2002)], "year int")).collect()}
    effect = {d + timedelta(days=k) for d in holidays for k in (0, 1)}
    for week in weeks(212):
        days = [week + timedelta(days=k) for k in range(7)]
        promo = sum(1124 <= d.month * 100 + d.day <= 1130 or 1226 <= d.month * 100 + d.day <= 1231 for d in days)
        assert regressors.get(week, (0, 0)) == (sum(d in effect for d in days), promo), week


def test_coefficients_equal_numpy(spark, regressors):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 5000, 160)
    rows = FC._with_terms(frame(spark, {"a": [int(v) for v in y]}), 1, 8)
    beta = np.array(FC.seasonal_coefficients(rows).first()["beta"])
    x = np.array([r["x"] for r in rows.filter("y IS NOT NULL").orderBy("ds").collect()]) / FC.UNIT
    penalty = np.diag([0.0] + [FC.SHRINKAGE] * (FC.TERMS - 1))
    want = np.linalg.solve(x.T @ x + penalty, x.T @ y)
    assert np.allclose(beta, want, rtol=1e-7, atol=1e-6)
    t = 7 * np.arange(160)
    assert np.allclose(x[:, 2], np.sin(2 * np.pi * t / 365.25), atol=1e-6) and np.allclose(x[:, 1], t / 365.25, atol=1e-6)


def test_planted_holiday_and_promotion_effects_are_recovered(spark, regressors):
    base = [1000 + 0.5 * k + 200 * math.cos(2 * math.pi * 7 * k / 365.25) for k in range(212)]
    flags = [regressors.get(w, (0, 0)) for w in weeks(212)]
    values = [round(b + 90 * h + 40 * p) for b, (h, p) in zip(base, flags)]
    weekly = frame(spark, {"planted": values[:200], "flat": [500] * 200})
    beta = {r["category"]: r["beta"] for r in FC.seasonal_coefficients(FC._with_terms(weekly, 12, 8)).collect()}
    assert abs(beta["planted"][-2] - 90) < 2 and abs(beta["planted"][-1] - 40) < 2
    assert all(abs(b) < 0.1 for b in beta["flat"][1:])
    future = FC.seasonal_forecast(weekly).filter("is_forecast AND category = 'planted'").orderBy("ds").collect()
    assert [r.ds for r in future] == weeks(212)[200:]
    assert max(abs(r.yhat - v) for r, v in zip(future, values[200:])) <= 8


def test_short_series_missing_values_and_no_category(spark):
    rows = [(d, c, v) for c, n in (("short", 7), ("half", 30), (None, 12)) for d, v in zip(weeks(n), range(n))]
    rows += [(None, "half", 3), (START + timedelta(weeks=40), "half", None)]
    weekly = spark.createDataFrame(rows, "ds date, category string, units_sold bigint")
    out = FC.seasonal_forecast(weekly).collect()
    sizes = {c: sum(r.category == c for r in out) for c in ("short", "half", None)}
    assert sizes == {"short": 0, "half": 42, None: 24}
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper and r.yhat_lower >= 0 for r in out)
    assert FC.seasonal_forecast(weekly.limit(0)).count() == 0


def test_fallback_where_the_error_is_large(spark):
    model = spark.createDataFrame([(START, "a", 1), (START, "b", 2)], "ds date, category string, yhat bigint")
    errors = spark.createDataFrame([("a", 20.0), ("b", 20.1)], "category string, mape_pct double")
    out = FC.forecast_with_fallback(model, errors, model.withColumn("yhat", F.lit(9).cast("bigint"))).collect()
    assert {(r.category, r.yhat, r.model) for r in out} == {("a", 1, "seasonal"), ("b", 9, "moving_average")}


def test_error_of_all_forecasts_is_that_of_the_backtest(spark):
    """Weeks without rows before the held-out part put its end beyond the backtest's weeks; these are not compared."""
    rows = [(d, c, 100 + 7 * k % 50) for c, missing in (("gap", (30, 31)), ("whole", ()), (None, (31,))) for k, d in enumerate(weeks(40)) if k not in missing]
    weekly = spark.createDataFrame(rows, "ds date, category string, units_sold bigint")
    want = {r.category: r.mape_pct for r in FC.mape(FC.backtest_seasonal(weekly), FC.held_out(weekly)).collect()}
    out = FC.forecast_all(weekly).collect()
    assert {(r.category, r.mape_pct) for r in out} == set(want.items())
    assert sum(r.is_forecast for r in out) == 36

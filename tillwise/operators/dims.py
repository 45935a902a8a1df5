"""Dimension tables: cleaning, calendar, channels, campaigns and version history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise import model
from tillwise.functions.columns import date_key, mask_email, surrogate_key, title_case

RFM_COLUMNS = {
    "rfm_recency_score": "bigint", "rfm_frequency_score": "bigint", "rfm_monetary_score": "bigint",
    "rfm_segment": "string", "rfm_updated_at": "timestamp", "customer_ltv_gbp": "double",
}


def _optional(df: DataFrame, **kinds: str) -> DataFrame:
    """Add the columns a source may leave out, as typed nulls."""
    return df.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in df.columns})


def _as_date(c: str) -> Column:
    return F.col(c).try_cast("date")


def _versioned(df: DataFrame, load_time: datetime | None) -> DataFrame:
    """Open-ended first version with audit times."""
    now = F.current_timestamp() if load_time is None else F.lit(load_time).cast("timestamp")
    return df.withColumns(
        {"valid_from": now.cast("date"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True),
         "created_at": now, "updated_at": now}
    )


def transform_customers(df: DataFrame, load_time: datetime | None = None) -> DataFrame:
    if "email" in df.columns:
        df = df.withColumn("email_masked", mask_email("email")).drop("email")
    tidy = {c: title_case(c) for c in ("gender", "age_band", "loyalty_tier", "region", "city") if c in df.columns}
    out = df.withColumns(
        {"customer_key": surrogate_key("customer_id"), **tidy, "acquisition_date": _as_date("acquisition_date")}
    )
    out = _optional(out, email_masked="string", postcode_district="string", **RFM_COLUMNS)
    return _versioned(out, load_time)


def transform_products(df: DataFrame, load_time: datetime | None = None) -> DataFrame:
    out = df.withColumns(
        {"product_key": surrogate_key("product_id"), "category": title_case("category"),
         "subcategory": title_case("subcategory"), "is_active": F.col("is_active").cast("boolean"),
         "launch_date": _as_date("launch_date")}
    )
    return _versioned(_optional(out, supplier_name="string", discontinue_date="date"), load_time)


def transform_stores(df: DataFrame, load_time: datetime | None = None) -> DataFrame:
    out = df.withColumns(
        {"store_key": surrogate_key("store_id"), "opening_date": _as_date("opening_date"),
         "is_active": F.col("is_active").cast("boolean"), "country": F.lit(model.HOME_COUNTRY)}
    )
    return _versioned(_optional(out, postcode="string"), load_time)


# --- calendar -------------------------------------------------------------------------------

def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included."""
    bounds = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(bounds).alias("calendar_date"))


def spine_between(bounds: DataFrame, start: str, end: str) -> DataFrame:
    """Days between two date columns of a one-row frame."""
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("calendar_date"))


def uk_holidays(spark: SparkSession) -> DataFrame:
    rows = [(name, date.fromisoformat(day)) for name, day in model.UK_HOLIDAYS]
    return spark.createDataFrame(rows, "holiday_name string, holiday_date date")


def holiday_effects(spark: SparkSession) -> DataFrame:
    """Days influenced by the fixed holidays."""
    return effect_days(uk_holidays(spark))


# The holidays of a year by rule, from the columns that `_with_feasts` adds.
HOLIDAY_RULES = {
    "New Year": "IF(weekday(_first) = 6, date_add(_first, 1), _first)",
    "Good Friday": "date_sub(_easter, 2)",
    "Easter Monday": "date_add(_easter, 1)",
    "Early May Bank": "date_add(_may, (7 - weekday(_may)) % 7)",
    "Spring Bank": "date_sub(_end_may, weekday(_end_may))",
    "Summer Bank": "date_sub(_end_august, weekday(_end_august))",
    "Christmas Day": "_christmas",
    "Boxing Day": "date_add(_christmas, 1)",
}


def _with_feasts(df: DataFrame) -> DataFrame:
    """Add the days that holidays are counted from to rows with a year `_y`; Easter by the anonymous Gregorian computus."""
    first = df.selectExpr("*", "_y % 19 AS _a", "_y div 100 AS _b", "_y % 100 AS _c")
    moon = first.selectExpr("*", "(19 * _a + _b - _b div 4 - (_b - (_b + 8) div 25 + 1) div 3 + 15) % 30 AS _h")
    week = moon.selectExpr("*", "(32 + 2 * (_b % 4) + 2 * (_c div 4) - _h - _c % 4) % 7 AS _l")
    place = week.selectExpr("*", "_h + _l - 7 * ((_a + 11 * _h + 22 * _l) div 451) + 114 AS _e")
    return place.selectExpr(
        "*", "make_date(_y, CAST(_e div 31 AS INT), CAST(_e % 31 + 1 AS INT)) AS _easter", "make_date(_y, 1, 1) AS _first",
        "make_date(_y, 5, 1) AS _may", "make_date(_y, 5, 31) AS _end_may", "make_date(_y, 8, 31) AS _end_august", "make_date(_y, 12, 25) AS _christmas",
    )


def bank_holidays(years: DataFrame, year: str = "year") -> DataFrame:
    """(holiday_name, holiday_date) by rule, for any years.

    A New Year's Day on a Sunday moves to Monday; days of a single year, such as a jubilee, are not known to a rule.
    """
    feasts = _with_feasts(years.select(F.col(year).cast("int").alias("_y")).filter("_y IS NOT NULL").distinct())
    pairs = ", ".join(f"'{name}', {rule}" for name, rule in HOLIDAY_RULES.items())
    return feasts.selectExpr(f"stack({len(HOLIDAY_RULES)}, {pairs}) AS (holiday_name, holiday_date)")


def effect_days(holidays: DataFrame) -> DataFrame:
    """Days influenced by a holiday: the day itself and the days after it."""
    last = F.date_add("holiday_date", model.HOLIDAY_DAYS_AFTER)
    return holidays.select("holiday_name", F.explode(F.sequence(F.col("holiday_date"), last)).alias("effect_date"))


def describe_dates(spine: DataFrame) -> DataFrame:
    """Calendar attributes for a frame of days (`calendar_date`)."""
    d = F.col("calendar_date")
    mmdd = F.month(d) * 100 + F.dayofmonth(d)
    promo = F.lit(False)
    for first, last in model.PROMO_PERIODS:
        promo = promo | mmdd.between(first, last)
    season = (
        F.when(F.month(d).between(3, 5), "Spring").when(F.month(d).between(6, 8), "Summer")
        .when(F.month(d).between(9, 11), "Autumn").otherwise("Winter")
    )
    # Sixteen fixed rows, so the broadcast has a known size; the days of other years follow the rules.
    fixed = F.broadcast(uk_holidays(spine.sparkSession).withColumnRenamed("holiday_name", "_fixed"))
    listed = sorted({int(day[:4]) for _, day in model.UK_HOLIDAYS})
    cases = " ".join(f"WHEN calendar_date = {rule} THEN '{name}'" for name, rule in HOLIDAY_RULES.items())
    by_rule = F.when(~F.col("_y").isin(listed), F.expr(f"CASE {cases} END"))
    days = _with_feasts(spine.withColumn("_y", F.year(d))).join(fixed, d == F.col("holiday_date"), "left")
    holiday = F.coalesce("_fixed", by_rule)
    # ISO year of the week: the year its Thursday falls in.
    thursday = F.date_add(d, (F.lit(3) - F.weekday(d)).cast("int"))
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        (F.weekday(d) + 1).cast("bigint").alias("day_of_week_num"),
        F.weekofyear(d).cast("bigint").alias("week_number"),
        F.month(d).cast("bigint").alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.year(d).cast("bigint").alias("year"),
        F.year(thursday).cast("bigint").alias("iso_year"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        holiday.isNotNull().alias("is_uk_public_holiday"),
        holiday.alias("holiday_name"),
        promo.alias("is_promotional"),
        season.alias("season"),
    )


def build_dim_date(spark: SparkSession, start: date = date(2020, 1, 1), end: date = date(2030, 12, 31)) -> DataFrame:
    return describe_dates(date_spine(spark, start, end))


def build_dim_channel(spark: SparkSession) -> DataFrame:
    rows = [
        (key, name.upper().replace("-", "_"), name, model.CHANNEL_TYPES[name])
        for name, key in model.CHANNEL_KEYS.items()
    ]
    return spark.createDataFrame(rows, "channel_key bigint, channel_id string, channel_name string, channel_type string")


def build_dim_campaign(marketing: DataFrame, load_time: datetime | None = None) -> DataFrame:
    """Campaigns seen in the spend rows: first and last day, and the money spent as budget.

    The spend feed has no campaign name or objective: the id serves as name, and every
    campaign here was paid to convert.
    """
    now = F.current_timestamp() if load_time is None else F.lit(load_time).cast("timestamp")
    return marketing.groupBy("campaign_id").agg(
        F.min("channel").alias("channel"),
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.sum("spend_pence").cast("bigint").alias("budget_pence"),
    ).select(
        surrogate_key("campaign_id").alias("campaign_key"),
        "campaign_id",
        F.col("campaign_id").alias("campaign_name"),
        "channel", "start_date", "end_date", "budget_pence",
        F.lit("Conversion").alias("objective"),
        now.alias("created_at"), now.alias("updated_at"),
    )


# --- version history (SCD type 2) -----------------------------------------------------------

def scd2_history(snapshots: DataFrame, key: str, tracked: Sequence[str], day: str) -> DataFrame:
    """Versions from dated snapshots: a new one whenever a tracked attribute changes.

    A key has one row per snapshot day, so a window holds at most one row per load.
    """
    by_key = Window.partitionBy(key).orderBy(day)
    changed = snapshots.withColumn("_prev", F.lag(F.struct(*tracked)).over(by_key))
    starts = changed.filter(F.col("_prev").isNull() | ~F.col("_prev").eqNullSafe(F.struct(*tracked)))
    following = F.lead(day).over(by_key)
    return starts.select(
        key, *tracked,
        F.col(day).alias("valid_from"),
        F.date_sub(following, 1).alias("valid_to"),
        following.isNull().alias("is_current"),
        (F.row_number().over(by_key)).cast("bigint").alias("version"),
    )


VERSION_COLUMNS = ("valid_from", "valid_to", "is_current", "version")


def version_key(natural: str, version: str = "version") -> Column:
    """Surrogate key of one version: the first version has the key of the natural id, so unversioned rows keep theirs."""
    return surrogate_key(f"IF({version} = 1, CAST({natural} AS STRING), concat({natural}, '#', {version}))")


def versions_on(df: DataFrame, versions: DataFrame, natural: str, day: str, key: str) -> DataFrame:
    """Add `key`: that of the version of `natural` that was valid on `day`; null where the id is not known.

    The versions of an id travel as one array sorted by first day, so a row meets its id once, however many
    versions there are, and finds its version in the array by halving. Days before the first version take that
    one, as the history begins with the first load; rows without a day take the latest one.
    """
    steps = F.struct("valid_from", F.col(key).alias("key"))
    by_id = versions.groupBy(F.col(natural).alias("_id")).agg(F.array_sort(F.collect_list(steps)).alias("_versions"))
    joined = df.join(by_id, F.col(natural) == F.col("_id"), "left")
    size = F.array_size("_versions")
    # From the largest power of two down to 1: how many versions begin on or before the day.
    powers = F.transform(F.sequence(F.floor(F.log2(size)).cast("int"), F.lit(0)), lambda k: F.call_function("shiftleft", F.lit(1), k))
    started = F.aggregate(powers, F.lit(0), lambda n, step: F.when(
        (n + step <= size) & (F.get("_versions", n + step - 1)["valid_from"] <= F.col(day)), n + step
    ).otherwise(n))
    at = F.when(F.col(day).isNull(), size).otherwise(F.greatest(started, F.lit(1)))
    found = F.when(size > 0, F.get("_versions", at - 1)["key"])
    return joined.withColumn(key, found).drop("_id", "_versions")


def scd2_merge(dim: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], day: date) -> DataFrame:
    """Merge a full snapshot into a versioned dimension, all columns of which are kept.

    Current rows with changed tracked attributes are closed the day before and get a successor; new
    keys get a first version; keys absent from the snapshot and old versions stay. Other columns that
    the snapshot has are taken from it into the current version, those it lacks go on from the version
    before (null for a new key). A version that began on `day` is corrected in place, so a repeated run
    changes nothing. Both sides are unique on the key among current rows, so the join neither fans out nor skews.
    """
    current, past = dim.filter("is_current"), dim.filter("NOT is_current")
    own = [c for c in dim.columns if c not in (*VERSION_COLUMNS, key)]
    given = [c for c in own if c in snapshot.columns]
    incoming = snapshot.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in given])
    joined = current.join(incoming, F.col(key) == F.col("_key"), "full_outer")
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    today = F.lit(day).cast("date")
    is_new, gone = F.col(key).isNull(), F.col("_key").isNull()
    changed = ~is_new & ~gone & differs & (F.col("valid_from") < today)

    def version(closed: bool) -> Column:
        values = {key: F.coalesce(F.col(key), F.col("_key"))}
        for c in own:
            old, new = F.col(c), F.col(f"_new_{c}") if c in given else F.col(c)
            values[c] = (F.when(changed | gone, old).otherwise(new)) if closed else new
        if closed:
            values |= {"valid_from": F.col("valid_from"), "valid_to": F.when(changed, F.date_sub(today, 1)).otherwise(F.col("valid_to")),
                       "is_current": ~changed, "version": F.col("version")}
        else:
            values |= {"valid_from": today, "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True),
                       "version": (F.coalesce(F.col("version"), F.lit(0)) + 1).cast("bigint")}
        return F.struct(*[values[c].cast(dim.schema[c].dataType).alias(c) for c in dim.columns])

    rows = F.array_compact(
        F.array(F.when(~is_new, version(closed=True)), F.when(is_new | changed, version(closed=False)))
    )
    merged = joined.select(F.inline(rows))
    return merged.unionByName(past.select(merged.columns))

from datetime import date

from tillwise import model
from tillwise.operators import dims


def test_calendar(spark):
    days = {str(r.full_date): r for r in dims.build_dim_date(spark, date(2022, 12, 25), date(2025, 1, 5)).collect()}
    assert len(days) == 743
    d = days["2024-12-30"]
    assert (d.date_key, d.day_of_week, d.day_of_week_num, d.week_number, d.year, d.iso_year) == (20241230, "Monday", 1, 1, 2024, 2025)
    assert days["2022-12-25"].holiday_name == "Christmas Day" and days["2022-12-25"].is_weekend
    assert days["2023-11-24"].is_promotional and not days["2023-11-23"].is_promotional
    assert [days[f"2023-{m}-15"].season for m in ("02", "05", "08", "11")] == ["Winter", "Spring", "Summer", "Autumn"]
    assert dims.holiday_effects(spark).count() == 32


def test_scd2_history(spark):
    rows = [("a", "x", "2024-01-01"), ("a", "x", "2024-02-01"), ("a", "y", "2024-03-01"), ("a", "x", "2024-04-01"), ("b", None, "2024-01-01")]
    df = spark.createDataFrame(rows, "id string, v string, day string").selectExpr("id", "v", "CAST(day AS DATE) AS day")
    out = sorted((r.id, r.version, r.v, str(r.valid_from), str(r.valid_to), r.is_current) for r in dims.scd2_history(df, "id", ["v"], "day").collect())
    assert out == [
        ("a", 1, "x", "2024-01-01", "2024-02-29", False), ("a", 2, "y", "2024-03-01", "2024-03-31", False),
        ("a", 3, "x", "2024-04-01", "None", True), ("b", 1, None, "2024-01-01", "None", True),
    ]


def test_scd2_merge(spark):
    dim = spark.sql("""SELECT * FROM VALUES
        ('same', 'x', DATE'2024-01-01', CAST(NULL AS DATE), true, 1L), ('changed', 'x', DATE'2024-01-01', NULL, true, 2L),
        ('changed', 'w', DATE'2023-01-01', DATE'2023-12-31', false, 1L), ('gone', 'x', DATE'2024-01-01', NULL, true, 1L)
        AS t(id, v, valid_from, valid_to, is_current, version)""")
    snapshot = spark.createDataFrame([("same", "x"), ("changed", None), ("new", "z")], "id string, v string")
    merged = dims.scd2_merge(dim, snapshot, "id", ["v"], date(2024, 6, 1))
    out = sorted((r.id, r.version, r.v, str(r.valid_from), str(r.valid_to), r.is_current) for r in merged.collect())
    assert out == [
        ("changed", 1, "w", "2023-01-01", "2023-12-31", False), ("changed", 2, "x", "2024-01-01", "2024-05-31", False),
        ("changed", 3, None, "2024-06-01", "None", True), ("gone", 1, "x", "2024-01-01", "None", True),
        ("new", 1, "z", "2024-06-01", "None", True), ("same", 1, "x", "2024-01-01", "None", True),
    ]
    again = dims.scd2_merge(merged, snapshot, "id", ["v"], date(2024, 7, 1))
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_rule_holidays_match_the_fixed_ones(spark):
    """All but the day that was moved for the jubilee of 2022."""
    years = spark.createDataFrame([(2022,), (2023,), (None,), (2022,)], "year int")
    got = {(r.holiday_name, str(r.holiday_date)) for r in dims.bank_holidays(years).collect()}
    assert len(got) == 16 and set(model.UK_HOLIDAYS) - got == {("Spring Bank", "2022-06-02")}


def test_merge_keeps_all_columns_and_can_be_repeated(spark):
    dim = spark.createDataFrame(
        [("a", "Gold", "x@y", 5, date(2024, 1, 1), None, True, 1), ("b", "Gold", "b@y", 6, date(2024, 1, 1), None, True, 1),
         ("c", None, "c@y", 7, date(2024, 1, 1), None, True, 1)],
        "id string, tier string, email string, score int, valid_from date, valid_to date, is_current boolean, version long",
    )
    snapshot = spark.createDataFrame([("a", "Silver", "new@y"), ("b", "Gold", "b2@y"), ("d", "Gold", "d@y")], "id string, tier string, email string")
    once = dims.scd2_merge(dim, snapshot, "id", ["tier"], date(2024, 2, 1))
    rows = {(r.id, r.version): tuple(r)[1:4] + (str(r.valid_to), r.is_current) for r in once.collect()}
    assert once.columns == dim.columns
    assert rows == {
        ("a", 1): ("Gold", "x@y", 5, "2024-01-31", False), ("a", 2): ("Silver", "new@y", 5, "None", True), ("b", 1): ("Gold", "b2@y", 6, "None", True),
        ("c", 1): (None, "c@y", 7, "None", True), ("d", 1): ("Gold", "d@y", None, "None", True),
    }
    again = dims.scd2_merge(once, snapshot, "id", ["tier"], date(2024, 2, 1))
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))


def test_history_sees_changes_to_and_from_missing(spark):
    snaps = spark.createDataFrame([("a", None, date(2024, 1, d)) if d == 2 else ("a", "x", date(2024, 1, d)) for d in (1, 2, 3)], "id string, v string, day date")
    assert [r.v for r in dims.scd2_history(snaps, "id", ["v"], "day").orderBy("version").collect()] == ["x", None, "x"]

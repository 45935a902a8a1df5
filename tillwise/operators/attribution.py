"""Marketing attribution: which channels led to a purchase.

A purchase is credited to the touches of the same customer in the 30 calendar days before it and
on its day up to its time. Paths are summarised per purchase (touches per channel and age, first
and last touch) without ever pairing purchases with single touches: a customer with very many of
both would otherwise produce their product. Instead

* touches of earlier days are counted per customer, day and channel, and each count is sent to
  the 30 following days (a fixed factor);
* touches of the same day but earlier minutes are running counts over at most 1440 rows;
* touches of the same minute are running counts inside that minute.

Touches of channels beyond the five named ones are counted, credited and charged together as `Other`.
Touches without customer lead to nobody's purchase; a purchase without customer goes to Direct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise import model as fixed
from tillwise.functions.columns import gbp, ratio
from tillwise.functions.scale import stage

WINDOW_DAYS = 30
HALF_LIFE_DAYS = 7
CREDIT_UNIT = 1_000_000  # credit is kept in millionths of a penny
WEIGHT_UNIT = 1 << 20

OTHER = "Other"
TOUCH_CHANNELS = (*fixed.TOUCH_CHANNELS, OTHER)
N = [f"n{i}" for i in range(len(TOUCH_CHANNELS))]
W = [f"w{i}" for i in range(len(TOUCH_CHANNELS))]


def decay_weight(age_days: str) -> Column:
    """Weight of a touch by its age in days, halved every HALF_LIFE_DAYS, as an integer."""
    table = ", ".join(str(round(WEIGHT_UNIT * 0.5 ** (d / HALF_LIFE_DAYS))) for d in range(WINDOW_DAYS + 1))
    return F.expr(f"CAST(element_at(array({table}), {age_days} + 1) AS BIGINT)")


def _minute() -> Column:
    return F.expr("hour(ts) * 60 + minute(ts)")


def _is_channel(i: int) -> Column:
    return F.col("channel") == TOUCH_CHANNELS[i]


def known_channel(channel: str = "channel") -> Column:
    """One of the five named channels, or `Other`."""
    return F.when(F.col(channel).isin(*fixed.TOUCH_CHANNELS), F.col(channel)).otherwise(F.lit(OTHER))


def _customers_touches(touches: DataFrame) -> DataFrame:
    return touches.filter(F.col("customer_id").isNotNull()).withColumn("channel", known_channel())


def conversion_paths(touches: DataFrame, conversions: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """One row per purchase: touches (`n0..n5`) and decayed weight (`w0..w5`) per channel, first and last channel."""
    touches = _customers_touches(touches)
    anonymous = conversions.filter(F.col("customer_id").isNull())
    conversions = conversions.filter(F.col("customer_id").isNotNull())
    place = F.struct("ts", F.col("touch_id").alias("id"), "channel")
    by_minute = touches.groupBy(
        "customer_id", F.col("ts").cast("date").alias("day"), _minute().alias("minute")
    ).agg(*[F.count_if(_is_channel(i)).alias(n) for i, n in enumerate(N)], F.min(place).alias("first"), F.max(place).alias("last"))

    # 1. earlier days, sent to the days whose window they fall in
    # Only visitors who ever buy are worth sending; they are a small part of all.
    buyers = conversions.select("customer_id").distinct()
    by_minute = by_minute.join(buyers, "customer_id", "left_semi")
    daily = by_minute.groupBy("customer_id", "day").agg(
        *[F.sum(n).alias(n) for n in N], F.min("first").alias("first"), F.max("last").alias("last")
    )
    sent = daily.select("*", F.explode(F.sequence(F.lit(1), F.lit(days))).alias("age")).withColumn(
        "to_day", F.date_add("day", F.col("age").cast("int"))
    )
    wanted = conversions.select("customer_id", F.col("ts").cast("date").alias("to_day")).distinct()
    weight = decay_weight("age")
    before = sent.join(wanted, ["customer_id", "to_day"], "left_semi").groupBy(
        F.col("customer_id").alias("d_who"), F.col("to_day").alias("d_day")
    ).agg(
        *[F.sum(n).alias(f"d_{n}") for n in N], *[F.sum(F.col(n) * weight).alias(f"d_{w}") for n, w in zip(N, W)],
        F.min("first").alias("d_first"), F.max("last").alias("d_last"),
    )

    # 2. earlier minutes of the same day: at most 1440 rows per window
    wanted_minutes = conversions.select(
        "customer_id", F.col("ts").cast("date").alias("day"), _minute().alias("minute")
    ).distinct()
    minutes = by_minute.join(wanted_minutes.withColumn("_wanted", F.lit(True)), ["customer_id", "day", "minute"], "full_outer")
    earlier = Window.partitionBy("customer_id", "day").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    in_day = minutes.select(
        F.col("customer_id").alias("h_who"), F.col("day").alias("h_day"), F.col("minute").alias("h_minute"), "_wanted",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"h_{n}") for n in N],
        F.min("first").over(earlier).alias("h_first"), F.max("last").over(earlier).alias("h_last"),
    ).filter("_wanted").drop("_wanted")

    # 3. the same minute: touches up to the time of the purchase
    stamp = lambda df: df.withColumns({"day": F.col("ts").cast("date"), "minute": _minute()})
    events = stamp(
        touches.select("customer_id", "ts", F.col("touch_id").alias("id"), "channel", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("revenue_pence"))
        .unionByName(conversions.select("customer_id", "ts", F.col("conversion_id").alias("id"), F.lit(None).cast("string").alias("channel"), F.lit(1).alias("kind"), "revenue_pence"))
    )
    so_far = Window.partitionBy("customer_id", "day", "minute").orderBy("ts", "kind", "id").rowsBetween(Window.unboundedPreceding, 0)
    touch = F.when(F.col("kind") == 0, F.struct("ts", "id", "channel"))
    same_minute = events.select(
        "customer_id", "ts", "id", "kind", "revenue_pence", "day", "minute",
        *[F.sum(F.coalesce(_is_channel(i), F.lit(False)).cast("bigint")).over(so_far).alias(n) for i, n in enumerate(N)],
        F.min(touch).over(so_far).alias("first"), F.max(touch).over(so_far).alias("last"),
    ).filter(F.col("kind") == 1)

    joined = same_minute.join(
        in_day, (F.col("customer_id") == F.col("h_who")) & (F.col("day") == F.col("h_day")) & (F.col("minute") == F.col("h_minute")), "left"
    ).join(before, (F.col("customer_id") == F.col("d_who")) & (F.col("day") == F.col("d_day")), "left")

    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    today = {n: zero(n) + zero(f"h_{n}") for n in N}
    # The latest touch is in the latest part that has one, the earliest in the earliest part.
    first, last = F.coalesce("d_first", "h_first", "first"), F.coalesce("last", "h_last", "d_last")
    known = joined.select(
        F.col("id").alias("conversion_id"), "customer_id", F.col("ts").alias("conversion_ts"), "revenue_pence",
        *[(today[n] + zero(f"d_{n}")).alias(n) for n in N],
        *[(today[n] * WEIGHT_UNIT + zero(f"d_{w}")).alias(w) for n, w in zip(N, W)],
        first["channel"].alias("first_channel"), last["channel"].alias("last_channel"),
    )
    nothing = F.lit(0).cast("bigint")
    return known.unionByName(anonymous.select(
        "conversion_id", "customer_id", F.col("ts").alias("conversion_ts"), "revenue_pence", *[nothing.alias(c) for c in N + W],
        F.lit(None).cast("string").alias("first_channel"), F.lit(None).cast("string").alias("last_channel"),
    ))


def touches_before_purchase(touches: DataFrame, conversions: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Path of each purchase in readable form."""
    paths = conversion_paths(touches, conversions, days)
    total = sum((F.col(n) for n in N[1:]), F.col(N[0]))
    names = {n: c.lower().replace(" ", "_") + "_touches" for n, c in zip(N, TOUCH_CHANNELS)}
    return paths.select(
        "conversion_id", "customer_id", "revenue_pence", total.alias("touches"), *[F.col(n).alias(name) for n, name in names.items()],
        "first_channel", "last_channel",
    )


# --- models: integer weight per channel for each purchase -----------------------------------

def _click(column: str) -> list[str]:
    return [f"coalesce(CAST({column} = '{c}' AS BIGINT), 0L)" for c in TOUCH_CHANNELS]


def channel_effects(touches: DataFrame, conversions: DataFrame) -> DataFrame:
    """One row with the effect of each channel after Shao and Li (KDD 2011), in millionths.

    Effect of channel i: its conversion rate among exposed customers, plus half the mean
    interaction with the other channels. Negative effects count as none. All counts come from one
    row per customer of five flags.
    """
    k = len(TOUCH_CHANNELS)
    seen = _customers_touches(touches).groupBy("customer_id").agg(*[F.max(_is_channel(i)).alias(f"s{i}") for i in range(k)])
    buyers = conversions.select("customer_id").distinct().withColumn("_bought", F.lit(True))
    flags = seen.join(buyers, "customer_id", "left").withColumn("bought", F.coalesce("_bought", F.lit(False)))
    pairs = [(i, j) for i in range(k) for j in range(i + 1, k)]
    groups = [(f"{i}", F.col(f"s{i}")) for i in range(k)] + [(f"{i}_{j}", F.col(f"s{i}") & F.col(f"s{j}")) for i, j in pairs]
    counts = flags.agg(
        *[F.count_if(cond).alias(f"a{name}") for name, cond in groups],
        *[F.count_if(cond & F.col("bought")).alias(f"b{name}") for name, cond in groups],
    )

    def rate(name: str) -> str:  # conversion rate in millionths, 0 without exposure
        return f"coalesce(b{name} * {CREDIT_UNIT} div nullif(a{name}, 0), 0L)"

    def effect(i: int) -> Column:
        mixed = []
        for j in range(k):
            if j != i:
                both = f"{min(i, j)}_{max(i, j)}"
                mixed.append(f"IF(a{both} > 0, {rate(both)} - {rate(str(i))} - {rate(str(j))}, 0L)")
        return F.expr(f"greatest({rate(str(i))} + ({' + '.join(mixed)}) div {2 * (k - 1)}, 0L)").alias(f"e{i}")

    return counts.select(*[effect(i) for i in range(k)])


def attribute(
    touches: DataFrame, conversions: DataFrame, marketing: DataFrame, model: str = "data_driven", days: int = WINDOW_DAYS
) -> DataFrame:
    """Revenue, orders, spend, cost per order and return on spend per channel.

    Models: last_click, first_click, linear, time_decay, data_driven. A purchase without touches
    goes to Direct. Credit is split in integers and the remainder of each purchase goes to the
    first channel that takes part, so the channels add up to the total revenue exactly.
    """
    return credit_paths(conversion_paths(touches, conversions, days), touches, conversions, marketing, model)


def credit_paths(paths: DataFrame, touches: DataFrame, conversions: DataFrame, marketing: DataFrame, model: str) -> DataFrame:
    """`attribute` on paths that are there already."""
    if model in ("last_click", "first_click"):
        weights = _click("last_channel" if model == "last_click" else "first_channel")
    elif model == "linear":
        weights = N
    elif model == "time_decay":
        weights = W
    elif model == "data_driven":
        paths = paths.crossJoin(F.broadcast(channel_effects(touches, conversions)))  # one row
        present = [f"IF({n} > 0, e{i}, 0L)" for i, n in enumerate(N)]
        # Without any positive effect on the path the touches share alike.
        weights = [f"IF({' + '.join(present)} > 0, {p}, {n})" for p, n in zip(present, N)]
    else:
        raise ValueError(f"unknown model {model!r}")

    k, direct = len(TOUCH_CHANNELS), TOUCH_CHANNELS.index("Direct")
    weighted = paths.selectExpr("revenue_pence", *[f"CAST({w} AS BIGINT) AS x{i}" for i, w in enumerate(weights)])
    nothing = " + ".join(f"x{i}" for i in range(k)) + " = 0"
    shared = weighted.selectExpr(
        "revenue_pence", *[f"CAST(IF({nothing}, {int(i == direct)}L, x{i}) AS DECIMAL(18,0)) AS y{i}" for i in range(k)]
    )
    total = " + ".join(f"y{i}" for i in range(k))

    def floors(amount: str) -> list[str]:
        return [f"(CAST({amount} AS DECIMAL(19,0)) * {CREDIT_UNIT}BD * y{i} div ({total}))" for i in range(k)]

    split = shared.selectExpr(
        "*", *[f"{f} AS m{i}" for i, f in enumerate(floors("revenue_pence"))], *[f"{f} AS o{i}" for i, f in enumerate(floors("1"))]
    )

    def credit(i: int, part: str, amount: str) -> str:
        rest = f"{amount} * {CREDIT_UNIT} - (" + " + ".join(f"{part}{j}" for j in range(k)) + ")"
        is_first = " AND ".join([*[f"y{j} = 0" for j in range(i)], f"y{i} > 0"])
        return f"{part}{i} + IF({is_first}, {rest}, 0L)"

    rows = ", ".join(
        f"struct('{c}' AS channel, {credit(i, 'm', 'revenue_pence')} AS revenue, {credit(i, 'o', '1')} AS orders)"
        for i, c in enumerate(TOUCH_CHANNELS)
    )
    credited = split.selectExpr(f"inline(array({rows}))").groupBy("channel").agg(
        F.expr("sum(CAST(revenue AS DECIMAL(28,0)))").alias("revenue"), F.expr("sum(CAST(orders AS DECIMAL(28,0)))").alias("orders")
    )
    spend = marketing.groupBy(known_channel().alias("_channel")).agg(F.sum("spend_pence").cast("bigint").alias("spend"))
    money = f"CAST(spend AS DECIMAL(17,0)) * {CREDIT_UNIT}BD"
    # Other is listed where a touch or spend was other, even if nothing was earned.
    listed = (F.col("channel") != OTHER) | (F.col("orders") > 0) | F.col("spend").isNotNull()
    return credited.join(spend, F.col("channel") == F.col("_channel"), "left").filter(listed).select(
        "channel",
        ratio("revenue", str(CREDIT_UNIT * 100), 2).alias("attributed_revenue_gbp"),
        ratio("orders", str(CREDIT_UNIT), 4).alias("attributed_orders"),
        gbp(F.coalesce("spend", F.lit(0))).alias("spend_gbp"),
        ratio(money, "CAST(orders AS DECIMAL(24,0)) * 100", 2).alias("cost_per_order_gbp"),
        ratio("revenue", money, 2).alias("roas"),
    )


def compare_models(touches: DataFrame, conversions: DataFrame, marketing: DataFrame) -> DataFrame:
    """Last-click next to data-driven revenue per channel; both come from one frame of paths."""
    paths = stage(conversion_paths(touches, conversions), "paths")
    last = credit_paths(paths, touches, conversions, marketing, "last_click").select("channel", F.col("attributed_revenue_gbp").alias("last_click_gbp"))
    driven = credit_paths(paths, touches, conversions, marketing, "data_driven").select(F.col("channel").alias("_channel"), F.col("attributed_revenue_gbp").alias("data_driven_gbp"))
    return last.join(driven, F.col("channel") == F.col("_channel"), "full_outer").select(
        F.coalesce("channel", "_channel").alias("channel"), "last_click_gbp", "data_driven_gbp"
    )

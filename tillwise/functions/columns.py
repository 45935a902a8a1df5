"""Column expressions with fixed meaning. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SPACE = 1_000_000_000
# 2**32 modulo KEY_SPACE: folds the next 32 bits of the digest into the remainder.
_FOLD = (1 << 32) % KEY_SPACE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a: Column, b: Column | int) -> Column:
    """Integer division that truncates toward zero."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def surrogate_key(text: str) -> Column:
    """MD5 of the text, read as a 128-bit integer, modulo 10^9. `text` is a SQL expression.

    The digest is folded 32 bits at a time, so every step stays inside a bigint.
    With n members about n^2 / (2 * 10^9) pairs collide: use it as an attribute,
    and join on the natural id.
    """
    key = "0L"
    for i in range(4):
        word = f"CAST(conv(substr(md5(CAST({text} AS STRING)), {1 + 8 * i}, 8), 16, 10) AS BIGINT)"
        key = f"(({key} * {_FOLD}L + {word}) % {KEY_SPACE}L)"
    return F.expr(key)


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as an integer, null for null."""
    d = c if isinstance(c, str) else None
    if d is not None:
        return F.expr(f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS BIGINT)")
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("bigint")


def strip(text: str) -> str:
    """SQL expression without white space at both ends."""
    return f"btrim({text}, ' \\t\\n\\r')"


def title_case(text: str) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    `initcap` starts words at spaces only, so it would give "Non-binary" for "non-binary".
    """
    runs = f"regexp_extract_all({strip(text)}, r'(\\p{{L}}+|[^\\p{{L}}]+)', 1)"
    return F.expr(f"array_join(transform({runs}, x -> concat(upper(left(x, 1)), lower(substr(x, 2)))), '')")


def gbp(pence: Column | str) -> Column:
    """Pounds from whole pence; the nearest double to the exact value."""
    return _col(pence).cast("double") / F.lit(100.0)


def pence(pounds: Column | str) -> Column:
    return F.round(_col(pounds) * 100).cast("bigint")


def ratio(num: Column | str, den: Column | str, places: int, wide: bool = True, times: int = 1) -> Column:
    """times * num / den rounded half away from zero, as double; null where den is 0 or null.

    Works on integers, so the result does not depend on floating-point rounding. `wide` uses
    decimals that hold any sum of bigints; without it bigint arithmetic is used, which is faster
    and fits the values of a single line. Text arguments are SQL expressions.
    """
    if isinstance(num, str) and isinstance(den, str):
        kind = "DECIMAL(24,0)" if wide else "BIGINT"
        n, d = f"CAST({num} AS {kind})", f"CAST({den} AS {kind})"
        q = f"((abs({n}) * {2 * times * 10**places} + abs({d})) div nullif(abs({d}) * 2, 0))"
        # No negative zero: -0.0 and 0.0 would be different values to a comparison by bits.
        sign = f"CASE WHEN {q} <> 0 AND ({n} < 0) <> ({d} < 0) THEN -1D ELSE 1D END"
        return F.expr(f"({sign}) * (CAST({q} AS DOUBLE) / {10**places}D)")
    kind = "decimal(24,0)" if wide else "bigint"
    n, d = _col(num).cast(kind), _col(den).cast(kind)
    q = int_div(F.abs(n) * F.lit(2 * times * 10**places) + F.abs(d), F.nullif(F.abs(d) * 2, F.lit(0)))
    sign = F.when((q != 0) & ((n < 0) != (d < 0)), F.lit(-1.0)).otherwise(F.lit(1.0))
    return sign * (q.cast("double") / F.lit(float(10**places)))


def percent(num: Column | str, den: Column | str, places: int, wide: bool = True) -> Column:
    return ratio(num, den, places, wide, times=100)


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """Plain division, null where the denominator is 0 or null."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def mask_email(c: Column | str) -> Column:
    """Keep the first character and the domain: j***@example.com."""
    return F.regexp_replace(_col(c), r"^(.)[^@]*@", "$1***@")


def postcode_district(c: Column | str) -> Column:
    """The outward part of a postcode: SW1 from 'SW1 4AB' or 'SW14AB'."""
    return F.nullif(F.regexp_extract(F.trim(_col(c)), r"^([A-Za-z]{1,2}[0-9][A-Za-z0-9]?)\s*[0-9][A-Za-z]{2}$", 1), F.lit(""))


def to_utc(c: Column | str, zone: str | Column) -> Column:
    """Local wall-clock time of `zone` as text in UTC, `YYYY-MM-DD HH:MM:SS`."""
    return F.date_format(F.to_utc_timestamp(_col(c).cast("timestamp"), zone), "yyyy-MM-dd HH:mm:ss")


def week_start(c: Column | str) -> Column:
    """Monday of the week."""
    return F.trunc(_col(c), "week")

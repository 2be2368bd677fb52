"""Typed parsing of dirty text: every function gives struct<value, issue>; issue is null where the value says what the text says."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that stand for no value in number and date columns (any case).
SENTINELS = ["N/A", "NA", "NONE", "NULL", "-", "XXXX"]
TRUE_WORDS = ["Y", "YES", "TRUE", "1"]
FALSE_WORDS = ["N", "NO", "FALSE", "0"]


def _clean(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _result(value: Column, issue: Column) -> Column:
    return F.struct(value.alias("value"), issue.alias("issue"))


def parse_decimal(c: Column, scale: int, precision: int = 38) -> Column:
    """Plain decimal text; digits beyond the scale are rounded half away from zero and reported when they aren't zeros."""
    t = _clean(c)
    shape = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
    bare = F.regexp_replace(t, r"^[+-]", "")
    whole = F.regexp_replace(F.split_part(bare, F.lit("."), F.lit(1)), "^0+", "")
    part = F.split_part(bare, F.lit("."), F.lit(2))
    negative = F.startswith(t, F.lit("-"))
    room = F.length(whole) <= precision - scale
    kept = F.concat(F.when(whole == "", "0").otherwise(whole), F.lit("."), F.rpad(F.substring(part, 1, scale), scale, "0"))
    number = F.expr(f"cast(null as decimal({precision},{scale}))")
    exact = kept.try_cast(f"decimal({precision},{scale})")
    up = F.substring(part, scale + 1, 1).between("5", "9")
    unit = F.lit("0." + "0" * (scale - 1) + "1" if scale else "1").cast(f"decimal({precision},{scale})")
    rounded = F.when(up, F.try_add(exact, unit)).otherwise(exact).try_cast(f"decimal({precision},{scale})")
    signed = F.when(negative, -rounded).otherwise(rounded).cast(f"decimal({precision},{scale})")
    good = t.rlike(shape)
    issue = (F.when(t.isNull(), None).when(F.upper(t).isin(SENTINELS), "sentinel").when(~good, "unparseable")
             .when(~room | rounded.isNull(), "out_of_range").when(F.substring(part, scale + 1, 1 << 30).rlike("[1-9]"), "rounded"))
    # most texts are plain and fit: one pattern and one cast; the rest takes the whole road
    plain = t.rlike(rf"^[+-]?[0-9]{{1,{min(18, precision - scale)}}}(\.[0-9]{{0,{scale}}})?$") if precision > scale else F.lit(False)
    none = F.lit(None).cast("string")
    return (F.when(t.isNull(), _result(number, none)).when(plain, _result(t.try_cast(f"decimal({precision},{scale})"), none))
            .otherwise(_result(F.when(good & room, signed).otherwise(number), issue)))


def parse_int(c: Column, bits: int = 64) -> Column:
    """Whole numbers (a fraction of zeros is allowed) that fit a signed integer of so many bits."""
    t = _clean(c)
    good = t.rlike(r"^[+-]?[0-9]+(\.0*)?$")
    digits = F.regexp_replace(F.split_part(t, F.lit("."), F.lit(1)), r"^\+", "")
    value = digits.try_cast("int" if bits == 32 else "long")
    issue = F.when(t.isNull(), None).when(F.upper(t).isin(SENTINELS), "sentinel").when(~good, "unparseable").when(value.isNull(), "out_of_range")
    return _result(F.when(good, value), issue)


def parse_date(c: Column) -> Column:
    """ISO year-month-day with an optional zone (dropped and reported), or month first with / or -; years 1000 to 9999."""
    t = _clean(c)
    iso = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})(Z|[+-][0-9]{2}:[0-9]{2})?$"
    us = r"^([0-9]{1,2})([/-])([0-9]{1,2})\2([0-9]{4})$"
    is_iso, is_us = t.rlike(iso), t.rlike(us)
    part = lambda k_iso, k_us: F.when(is_iso, F.regexp_extract(t, iso, k_iso)).when(is_us, F.regexp_extract(t, us, k_us)).try_cast("int")
    year, month, day = part(1, 4), part(2, 1), part(3, 3)
    value = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")).try_cast("date")
    value = F.when((is_iso | is_us) & (year >= 1000), value)
    issue = (F.when(t.isNull(), None).when(F.upper(t).isin(SENTINELS), "sentinel").when(~(is_iso | is_us), "unparseable")
             .when(value.isNull(), "out_of_range").when(is_iso & (F.regexp_extract(t, iso, 4) != ""), "tz_dropped"))
    # most texts are full ISO days: one pattern and one cast; the rest takes the whole road
    plain, none = F.when(t.rlike("^[1-9][0-9]{3}-[0-9]{2}-[0-9]{2}$"), t).try_cast("date"), F.lit(None).cast("string")
    return F.when(t.isNull(), _result(F.lit(None).cast("date"), none)).when(plain.isNotNull(), _result(plain, none)).otherwise(_result(value, issue))


def parse_yn(c: Column) -> Column:
    t = F.upper(_clean(c))
    value = F.when(t.isin(TRUE_WORDS), True).when(t.isin(FALSE_WORDS), False)
    return _result(value, F.when(t.isNotNull() & value.isNull(), "unparseable"))


def cusip_norm(c: Column) -> Column:
    """Nine upper-case letters and digits; shorter ones get leading zeros back; all zeros or another shape is null."""
    t = F.upper(F.regexp_replace(c, r"[\s-]", ""))
    full = F.when(t.rlike("^[0-9A-Z*@#]{6,9}$"), F.lpad(t, 9, "0"))
    return F.when(~full.rlike("^0+$"), full)


def lei_norm(c: Column) -> Column:
    t = F.upper(F.trim(c))
    return F.when(t.rlike("^[0-9A-Z]{18}[0-9]{2}$"), t)


def put_call_norm(c: Column) -> Column:
    t = F.upper(F.trim(c))
    return F.when(t.isin("PUT", "P"), "PUT").when(t.isin("CALL", "C"), "CALL")


def seq_numbers(c: Column) -> Column:
    """Numbers 1 to 9999 of a list such as '03,01', in its order; null for null, an empty list where nothing fits."""
    parts = F.transform(F.split(c, r"[,;\s]+"), lambda x: F.when(x.rlike("^[0-9]{1,9}$"), x).try_cast("int"))
    return F.filter(parts, lambda x: x.between(1, 9999))


def base_form_type(c: Column) -> Column:
    return F.regexp_replace(c, "/A$", "")


def is_amendment(c: Column) -> Column:
    return F.endswith(c, F.lit("/A"))


def amount_or_indefinite(c: Column, scale: int = 2) -> Column:
    """struct<value, issue, indefinite>: the word Indefinite is no number and no issue."""
    t = F.upper(F.trim(c))
    word = F.coalesce(t == "INDEFINITE", F.lit(False))
    p = parse_decimal(F.when(~word, c), scale)
    return F.struct(p["value"].alias("value"), p["issue"].alias("issue"), word.alias("indefinite"))


def month_end_back(date: Column, months: int) -> Column:
    return F.last_day(F.add_months(date, -months))


def exact_decimal(c: Column, scale: int = 10) -> Column:
    """Decimal text that fits without rounding, else null."""
    p = parse_decimal(c, scale)
    return F.when(p["issue"].isNull(), p["value"])


def canonical_text(value: Column) -> Column:
    """A decimal's shortest plain text: no trailing zeros, no trailing point."""
    t = F.regexp_replace(F.format_string("%s", value.cast("string")), r"(\.[0-9]*?)0+$", "$1")
    return F.when(value == 0, "0").when(value.isNotNull(), F.regexp_replace(t, r"\.$", ""))


def base_units(coins: Column, places: int = 8) -> Column:
    """Whole base units of an amount held as double, only where the amount is exactly that many units."""
    units = F.round(coins * float(10**places))
    return F.when(F.abs(units) < 2.0**53, F.when(units.cast("long").cast("double") / float(10**places) == coins, units.cast("long")))


def kv_map(c: Column) -> Column:
    """'k:v|k:v' as a map; null where any part has no colon, an empty key or a repeated key."""
    parts = F.split(c, r"\|")
    keys = F.transform(parts, lambda x: F.split_part(x, F.lit(":"), F.lit(1)))
    good = F.forall(parts, lambda x: x.rlike("^[^:]+:")) & (F.size(F.array_distinct(keys)) == F.size(keys))
    return F.when(good, F.map_from_arrays(keys, F.transform(parts, lambda x: F.regexp_replace(x, "^[^:]+:", ""))))


def typed(df: DataFrame, columns: dict[str, Column], table: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Replace text columns by their parsed values and list the issues.

    ``columns``: text column -> its parse struct. Returns the typed rows with ``has_parse_issues`` and the issue rows (keys,
    table_name, column_name, raw_value, issue).
    """
    held = df.select("*", *[p.alias(f"_p_{c}") for c, p in columns.items()])
    found = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("raw_value"), F.col(f"_p_{c}.issue").alias("issue")) for c in columns])
    held = held.withColumn("_issues", F.filter(found, lambda x: x["issue"].isNotNull()))
    rows = held.withColumns({c: F.col(f"_p_{c}.value") for c in columns}).withColumn("has_parse_issues", F.size("_issues") > 0)
    issues = held.select(*keys, F.lit(table).alias("table_name"), F.inline("_issues"))
    return rows.drop("_issues", *[f"_p_{c}" for c in columns]), issues

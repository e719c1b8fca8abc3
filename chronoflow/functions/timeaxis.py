"""Years on an astronomical axis (0 = 1 BCE), partial dates, and calendars, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The months' names.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
#: The days of the months, with a leap day.
DAYS = (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
_MONTH = "|".join(MONTHS)


def month_number(name: Column) -> Column:
    """1 to 12 of a month's full name, else null."""
    position = F.array_position(F.array(*map(F.lit, MONTHS)), name)
    return F.when(position > 0, position.cast("int"))


def century(year: Column) -> Column:
    """Century by shared digits: 1900 to 1999 are the 20th; before year 1 negative, by the BCE year's digits."""
    return F.when(year > 0, F.floor(year / 100) + 1).otherwise(-(F.floor((1 - year) / 100) + 1)).cast("int")


def strict_century(year: Column) -> Column:
    """Century as counted: 1901 to 2000 are the 20th."""
    return F.when(year > 0, F.floor((year - 1) / 100) + 1).otherwise(-(F.floor(-year / 100) + 1)).cast("int")


def decade(year: Column) -> Column:
    """Sortable decade key: the first year, or minus the next decade's BCE digits."""
    return F.when(year > 0, F.floor(year / 10) * 10).otherwise(-(F.floor((1 - year) / 10) * 10 + 10)).cast("int")


def ordinal(n: Column) -> Column:
    """1st, 2nd, 3rd, 4th, ... 11th, 12th, 13th."""
    last, teens = F.abs(n) % 10, (F.abs(n) % 100).between(11, 13)
    suffix = F.when(teens, "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), suffix)


def century_label(key: Column) -> Column:
    return F.concat(ordinal(F.abs(key)), F.lit(" century"), F.when(key < 0, " BC").otherwise(""))


def decade_label(key: Column) -> Column:
    return F.when(key < 0, F.concat((-key - 10).cast("string"), F.lit("s BC"))).otherwise(F.concat(key.cast("string"), F.lit("s")))


def era_label(year: Column) -> Column:
    return F.when(year > 0, year.cast("string")).otherwise(F.concat((1 - year).cast("string"), F.lit(" BCE")))


def year_of(text: Column) -> Column:
    """A typed year: digits with BC/BCE (astronomical result) or AD/CE or nothing; 0 and other text give null."""
    low = F.lower(F.trim(text))
    bce = F.regexp_extract(low, r"^(\d{1,5})\s*(?:bce|bc)$", 1)
    ce = F.regexp_extract(low, r"^(?:ad\s*)?(\d{1,5})\s*(?:ce|ad)?$", 1)
    return F.when(bce != "", 1 - F.nullif(bce.try_cast("int"), F.lit(0))).when(ce != "", F.nullif(ce.try_cast("int"), F.lit(0)))


def parse_date(text: Column) -> Column:
    """struct(month, day) of "Month d", "d Month" or "Month" at the text's start; nulls where it names none."""
    t = F.trim(F.coalesce(text, F.lit("")))
    m1, d1 = F.regexp_extract(t, rf"^({_MONTH})\s+(\d{{1,2}})\b", 1), F.regexp_extract(t, rf"^({_MONTH})\s+(\d{{1,2}})\b", 2)
    d2, m2 = F.regexp_extract(t, rf"^(\d{{1,2}})\s+({_MONTH})\b", 1), F.regexp_extract(t, rf"^(\d{{1,2}})\s+({_MONTH})\b", 2)
    m3 = F.regexp_extract(t, rf"^({_MONTH})\b", 1)
    month = month_number(F.when(m1 != "", m1).when(m2 != "", m2).otherwise(m3))
    day = F.when(m1 != "", d1).when(m2 != "", d2).try_cast("int")
    return F.struct(month.alias("month"), day.alias("day"))


def span_days(text: Column, longest: int = 14) -> Column:
    """Days of a printed range "Month d-d" or "Month d - Month d" as array of (month, day); empty for what is no range.

    No range: a second number that goes on (digits, a comma, an ordinal's letters), a day its month
    doesn't have, an end that isn't after its start, more than ``longest`` days between them. A range
    may pass the year's end.
    """
    t = F.trim(F.coalesce(text, F.lit("")))
    tail = rf"^({_MONTH})\s+(\d{{1,2}})\s*[-–—]\s*(?:({_MONTH})\s+)?(\d{{1,2}})(?![\d,]|st|nd|rd|th)"
    of = lambda i: F.regexp_extract(t, tail, i)
    day = lambda m, d: F.try_make_timestamp(F.lit(2000), m, d, F.lit(0), F.lit(0), F.lit(0)).cast("date")
    m, to_m = month_number(of(1)), month_number(of(3))
    start, end = day(m, of(2).try_cast("int")), day(F.coalesce(to_m, m), of(4).try_cast("int"))
    end = F.when((end < start) & to_m.isNotNull(), F.add_months(end, 12)).otherwise(end)
    length = F.datediff(end, start)
    days = F.transform(F.sequence(start, F.when((length > 0) & (length <= longest), end)), lambda x: F.struct(F.month(x).alias("month"), F.dayofmonth(x).alias("day")))
    return F.coalesce(days, F.array().cast("array<struct<month:int,day:int>>"))


def julian_day(year: Column, month: Column, day: Column) -> Column:
    """Julian day number of a proleptic Gregorian date."""
    a = F.floor((14 - month) / 12)
    y, m = year + 4800 - a, month + 12 * a - 3
    return (day + F.floor((153 * m + 2) / 5) + 365 * y + F.floor(y / 4) - F.floor(y / 100) + F.floor(y / 400) - 32045).cast("bigint")


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), 0)


def to_julian(year: Column, month: Column, day: Column) -> Column:
    """struct(year, month, day) in the Julian calendar of a proleptic Gregorian date."""

    def of(x: Column) -> Column:  # x: c, d (four-year cycles), e (days of the year from March)
        m = F.floor((5 * x.e + 2) / 153)
        return F.struct(
            (x.d - 4800 + F.floor(m / 10)).cast("int").alias("year"),
            (m + 3 - 12 * F.floor(m / 10)).cast("int").alias("month"),
            (x.e - F.floor((153 * m + 2) / 5) + 1).cast("int").alias("day"),
        )

    cycles = lambda c: F.struct(c.alias("c"), F.floor((4 * c + 3) / 1461).alias("d"))
    rest = lambda x: F.struct(x.d.alias("d"), (x.c - F.floor(1461 * x.d / 4)).alias("e"))
    return _let(_let(_let(julian_day(year, month, day) + 32082, cycles), rest), of)


def typed_statement(value: Column, precision: Column, julian: Column) -> Column:
    """struct(year, month, day, precision) of a time value "-0043-03-13T00:00:00Z"; null where it isn't one.

    A day (precision 11 or more) that was given in the Julian calendar is turned from the Gregorian
    one that values are written in. Parts beyond the precision are 0, as written.
    """
    form = r"^([+-]?)(\d{1,6})-(\d\d)-(\d\d)T"
    get = lambda i: F.regexp_extract(value, form, i)
    y = get(2).try_cast("int") * F.when(get(1) == "-", -1).otherwise(1)
    own = F.struct(y.alias("year"), get(3).try_cast("int").alias("month"), get(4).try_cast("int").alias("day"))
    days = lambda v: (precision >= 11) & F.coalesce(julian, F.lit(False)) & v.month.between(1, 12) & v.day.between(1, 31)
    turned = _let(own, lambda v: F.when(days(v), to_julian(v.year, v.month, v.day)).otherwise(v))
    return _let(turned, lambda v: F.when(v.year.isNotNull(), F.struct(v.year.alias("year"), v.month.alias("month"), v.day.alias("day"), precision.cast("int").alias("precision"))))


def day_distance(month_a: Column, day_a: Column, month_b: Column, day_b: Column) -> Column:
    """Days between two days of a year, the shorter way round."""
    start = [sum(DAYS[:i]) - (1 if i > 1 else 0) for i in range(12)]
    of = lambda m, d: F.element_at(F.array(*map(F.lit, start)), m) + d
    gap = F.abs(of(month_a, day_a) - of(month_b, day_b))
    return F.least(gap, 365 - gap)

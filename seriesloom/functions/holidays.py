"""Public holidays: calendars as tables of rules, Easter-based feasts, day windows, a user's own days.

A rule gives one day a year and speaks twice: as a column expression of a year, and
as a date in Python for solvers that rebuild design columns.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A holiday: fixed day, n-th weekday of a month (-1: last), or days after Easter Sunday."""

    name: str
    month: int | None = None
    day: int | None = None
    weekday: int | None = None
    nth: int | None = None
    easter: int | None = None
    since: int = 1
    until: int = 9999
    #: Observed on Friday if on a Saturday, on Monday if on a Sunday.
    observed: bool = False

    def date(self, year: int) -> dt.date | None:
        if not self.since <= year <= self.until:
            return None
        if self.easter is not None:
            day = _easter_number(year)
            return dt.date(year, 3, 1) + dt.timedelta(day - 1 + self.easter)
        if self.weekday is None:
            return dt.date(year, self.month, self.day)
        if self.nth > 0:
            first = dt.date(year, self.month, 1)
            return first + dt.timedelta((self.weekday - first.weekday()) % 7 + 7 * (self.nth - 1))
        last = dt.date(year + self.month // 12, self.month % 12 + 1, 1) - dt.timedelta(1)
        return last - dt.timedelta((last.weekday() - self.weekday) % 7)

    def in_year(self, year: Column) -> Column:
        """The date in a year, null outside the years of the holiday."""
        if self.easter is not None:
            day = F.date_add(F.make_date(year, F.lit(3), F.lit(1)), _easter_number(year) - 1 + self.easter)
        elif self.weekday is None:
            day = F.make_date(year, F.lit(self.month), F.lit(self.day))
        elif self.nth > 0:
            first = F.make_date(year, F.lit(self.month), F.lit(1))
            day = F.date_add(first, F.pmod(F.lit(self.weekday) - F.weekday(first), F.lit(7)) + 7 * (self.nth - 1))
        else:
            last = F.last_day(F.make_date(year, F.lit(self.month), F.lit(1)))
            day = F.date_sub(last, F.pmod(F.weekday(last) - self.weekday, F.lit(7)))
        return F.when(year.between(self.since, self.until), day)


def _whole(x, by: int):
    """Whole part of a division of numbers that are not negative, in Python or as a column."""
    return F.floor(x / F.lit(by)).cast("int") if isinstance(x, Column) else x // by


def _easter_number(year):
    """Easter Sunday as days counted from the first of March (which is 1), Gregorian calendar."""
    century, golden = _whole(year, 100), year % 19
    epact = (19 * golden + century - _whole(century, 4) - _whole(8 * century + 13, 25) + 15) % 30
    # Days from 21 March to the full moon, which moves back a day where it would come too late.
    moon = epact - _whole(epact + _whole(golden, 11), 29)
    weekday = (year + _whole(year, 4) + moon + 2 - century + _whole(century, 4)) % 7
    return 28 + moon - weekday


# Public holidays by country (Monday is weekday 0).
CALENDARS: dict[str, list[Rule]] = {
    "US": [
        Rule("New Year's Day", 1, 1, observed=True),
        Rule("Juneteenth", 6, 19, since=2021, observed=True),
        Rule("Independence Day", 7, 4, observed=True),
        Rule("Veterans Day", 11, 11, observed=True),
        Rule("Christmas Day", 12, 25, observed=True),
        Rule("Martin Luther King Jr. Day", 1, weekday=0, nth=3),
        Rule("Washington's Birthday", 2, weekday=0, nth=3),
        Rule("Memorial Day", 5, weekday=0, nth=-1),
        Rule("Labor Day", 9, weekday=0, nth=1),
        Rule("Columbus Day", 10, weekday=0, nth=2),
        Rule("Thanksgiving", 11, weekday=3, nth=4),
    ],
    "DE": [
        Rule("Neujahr", 1, 1),
        Rule("Karfreitag", easter=-2),
        Rule("Ostermontag", easter=1),
        Rule("Tag der Arbeit", 5, 1),
        Rule("Christi Himmelfahrt", easter=39),
        Rule("Pfingstmontag", easter=50),
        Rule("Tag der Deutschen Einheit", 10, 3, since=1990),
        Rule("Reformationstag", 10, 31, since=2017, until=2017),
        Rule("Erster Weihnachtstag", 12, 25),
        Rule("Zweiter Weihnachtstag", 12, 26),
    ],
    "GB": [
        Rule("New Year's Day", 1, 1),
        Rule("Good Friday", easter=-2),
        Rule("Easter Monday", easter=1),
        Rule("Early May Bank Holiday", 5, weekday=0, nth=1, since=1978),
        Rule("Spring Bank Holiday", 5, weekday=0, nth=-1, since=1971),
        Rule("Summer Bank Holiday", 8, weekday=0, nth=-1, since=1971),
        Rule("Christmas Day", 12, 25),
        Rule("Boxing Day", 12, 26),
    ],
}


@dataclass(frozen=True)
class OwnHoliday:
    """A user's holiday: explicit days, each with the days from ``before`` to ``after`` around it."""

    name: str
    days: tuple[dt.date, ...]
    before: int = 0
    after: int = 0


@dataclass(frozen=True)
class Calendar:
    """Holidays of a country (or none) with a window of days around each, and a user's own."""

    country: str | None = None
    before: int = 0
    after: int = 0
    own: tuple[OwnHoliday, ...] = ()

    @property
    def rules(self) -> list[Rule]:
        if self.country is None:
            return []
        if self.country not in CALENDARS:
            raise KeyError(f"no calendar for {self.country}; known: {', '.join(sorted(CALENDARS))}")
        return CALENDARS[self.country]

    def flags(self, ds: Column) -> dict[str, Column]:
        """0/1 per holiday and day of its window, straight from the date: no join."""
        out = {}
        for rule in self.rules:
            for k in range(-self.before, self.after + 1):
                out[_label(rule.name, k)] = _falls(rule, F.date_sub(ds, k))
            if rule.observed:
                out[f"{rule.name} (observed)"] = _falls_observed(rule, ds)
        for own in self.own:
            for k in range(-own.before, own.after + 1):
                days = [F.lit(d + dt.timedelta(k)) for d in own.days]
                out[_label(own.name, k)] = ds.isin(*days) if days else F.lit(False)
        return {name: F.coalesce(c, F.lit(False)).cast("int") for name, c in out.items()}

    def dates(self, first: dt.date, last: dt.date) -> dict[str, set[dt.date]]:
        """The same as dates from ``first`` to ``last``, in the same order of names."""
        out: dict[str, set[dt.date]] = {}
        for rule in self.rules:
            days = [d for y in range(first.year - 1, last.year + 2) if (d := rule.date(y))]
            for k in range(-self.before, self.after + 1):
                out[_label(rule.name, k)] = {d + dt.timedelta(k) for d in days}
            if rule.observed:
                moved = {5: -1, 6: 1}
                out[f"{rule.name} (observed)"] = {d + dt.timedelta(moved[d.weekday()]) for d in days if d.weekday() in moved}
        for own in self.own:
            for k in range(-own.before, own.after + 1):
                out[_label(own.name, k)] = {d + dt.timedelta(k) for d in own.days}
        return {name: {d for d in days if first <= d <= last} for name, days in out.items()}


def _label(name: str, offset: int) -> str:
    return name if not offset else f"{name} {offset:+d}"


def _falls(rule: Rule, ds: Column) -> Column:
    return rule.in_year(F.year(ds)) == ds


def _falls_observed(rule: Rule, ds: Column) -> Column:
    return ((F.weekday(ds) == 4) & _falls(rule, F.date_add(ds, 1))) | ((F.weekday(ds) == 0) & _falls(rule, F.date_sub(ds, 1)))


def holiday_flags(ds: Column, country: str = "US") -> dict[str, Column]:
    """0/1 per holiday, straight from the date: no join."""
    return Calendar(country).flags(ds)


def holiday_dimension(spark: SparkSession, first_year: int, last_year: int, calendar: str | Calendar = "US") -> DataFrame:
    """``(ds, holiday)`` from the first day of ``first_year`` to the last of ``last_year``.

    One row per rule and year: a calendar has a few dozen rows a year.
    """
    calendar = Calendar(calendar) if isinstance(calendar, str) else calendar
    years = spark.range(first_year - 1, last_year + 2).select(F.col("id").cast("int").alias("year"))
    found = []
    for rule in calendar.rules:
        day = rule.in_year(F.col("year"))
        found += [F.struct(F.date_add(day, k).alias("ds"), F.lit(_label(rule.name, k)).alias("holiday")) for k in range(-calendar.before, calendar.after + 1)]
        if rule.observed:
            moved = F.when(F.weekday(day) == 5, F.date_sub(day, 1)).when(F.weekday(day) == 6, F.date_add(day, 1))
            found.append(F.struct(moved.alias("ds"), F.lit(f"{rule.name} (observed)").alias("holiday")))
    rows = spark.createDataFrame([], "ds date, holiday string")
    if found:
        rows = years.select(F.explode(F.array(*found)).alias("h")).select("h.ds", "h.holiday")
    own = [
        (d + dt.timedelta(k), _label(o.name, k)) for o in calendar.own for d in o.days for k in range(-o.before, o.after + 1)
    ]
    if own:
        rows = rows.union(spark.createDataFrame(sorted(set(own)), "ds date, holiday string"))
    return rows.where(F.year("ds").between(first_year, last_year))


def own_holidays(table: DataFrame, name: str = "holiday", ds: str = "ds", before: str | None = None, after: str | None = None) -> tuple[OwnHoliday, ...]:
    """A user's table of days as holidays; ``before`` and ``after`` name columns with the window.

    Such a table is typed by people and read to the driver, a row per name.
    """
    window = [F.coalesce(F.abs(F.max(c)), F.lit(0)) if c else F.lit(0) for c in (before, after)]
    rows = table.where(F.col(ds).isNotNull()).groupBy(F.col(name).alias("name")).agg(
        F.sort_array(F.collect_set(ds)).alias("days"), window[0].alias("before"), window[1].alias("after")
    )
    return tuple(OwnHoliday(r["name"], tuple(r["days"]), r["before"], r["after"]) for r in rows.orderBy("name").collect())


def with_holidays(df: DataFrame, first_year: int, last_year: int, calendar: str | Calendar = "US") -> DataFrame:
    """Left join with the holiday dimension.

    The dimension is bounded by the years of the calendar, hence the broadcast.
    """
    dim = holiday_dimension(df.sparkSession, first_year, last_year, calendar)
    return df.join(F.broadcast(dim), "ds", "left")

"""Date rules as columns. Parsing never fails: what can't be read is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LAST_YEAR = 2050
_LAYOUTS = [
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$", "yyyy-MM-dd HH:mm"),
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$", "yyyy-MM-dd HH:mm:ss"), (r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
    (r"^\d{2}/\d{2}/\d{4}$", "MM/dd/yyyy"), (r"^\d{2}-\d{2}-\d{4}$", "dd-MM-yyyy"), (r"^\d{2}\.\d{2}\.\d{4}$", "dd.MM.yyyy"),
    (r"^\d{2}\.\d{2}\.\d{4} \d{2}:\d{2}$", "dd.MM.yyyy HH:mm"),
]
_RFC3339 = r"^(\d{4}-\d{2}-\d{2})T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})$"


def parse(c: Column) -> Column:
    """The date of a string in any accepted layout; null if it has none or its year is after LAST_YEAR."""
    s = F.trim(c)
    tried = [F.when(s.rlike(shape), F.try_to_timestamp(s, F.lit(layout)).cast("date")) for shape, layout in _LAYOUTS]
    tried.append(F.when(s.rlike(_RFC3339), F.try_to_date(F.regexp_extract(s, _RFC3339, 1), "yyyy-MM-dd")))
    found = F.coalesce(*tried)
    return F.when(F.year(found) <= LAST_YEAR, found)


def canonical(c: Column) -> Column:
    return F.date_format(parse(c), "yyyy-MM-dd")


def raw_companion(c: Column) -> Column:
    """A value that is no date, kept as it is; null if blank or a date."""
    return F.when((F.trim(c) != "") & parse(c).isNull(), c)


def loose_year(c: Column) -> Column:
    """A year from free text: the first four characters if a number, else the first four digits in a row within 1000 to 2050."""
    s = F.trim(c)
    strict = F.when(s.rlike(r"^[0-9]{4}"), F.substring(s, 1, 4).cast("int"))
    found = F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(s) - 3, F.lit(1))), lambda i: F.substring(s, i, F.lit(4))), lambda x: x.rlike("^[0-9]{4}$") & x.between("1000", str(LAST_YEAR)))
    return F.coalesce(strict, F.get(found, F.lit(0)).cast("int"))


def decade(year: Column) -> Column:
    return F.concat((F.floor(year / 10) * 10).cast("string"), F.lit("s"))


def defect(c: Column, last: int = LAST_YEAR) -> Column:
    """What is wrong with a date property: "format", "calendar" or "year"; null if nothing."""
    day = F.try_to_date(c, "yyyy-MM-dd")
    return F.when(~c.rlike(r"^\d{4}-\d{2}-\d{2}$"), "format").when(day.isNull(), "calendar").when(F.year(day) > last, "year")


def is_live_form(c: Column) -> Column:
    """Whether a value has the live store's form, with clock time and zone."""
    return c.rlike(_RFC3339)


def same_day(seed: Column, live: Column) -> Column:
    """Equal days, if the live side has the store's form."""
    return F.coalesce(is_live_form(live) & (F.regexp_extract(live, _RFC3339, 1) == F.substring(seed, 1, 10)), F.lit(False))

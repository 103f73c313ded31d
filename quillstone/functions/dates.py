"""Dates in URLs, headings and catalogues.  Invalid dates are null; whatever
depends on today takes an explicit ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
# Fixed value: what looks like a date of this century in a URL or a text.
_DATE_LIKE = r"(20\d{2})[-_/]?(0[1-9]|1[0-2])[-_/]?(0[1-9]|[12]\d|3[01])"


def _ymd(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def slug_date(slug: Column, pivot: int = 90) -> Column:
    """YYMMDD; years from the pivot on are of the 1900s."""
    valid = F.when(slug.rlike(r"^\d{6}$"), slug)
    century = F.when(F.substring(valid, 1, 2).cast("int") >= pivot, "19").otherwise("20")
    return F.try_to_date(F.concat(century, valid), "yyyyMMdd")


def url_slug_date(url: Column) -> Column:
    return slug_date(F.nullif(F.regexp_extract(url, r"(?i)^https?://[^/]+/review/r(\d{6})[a-z]?\.pdf$", 1), F.lit("")))


def first_date_like(*texts: Column) -> Column:
    """The first of the texts in which eight digits look like a date of this
    century decides, valid or not."""
    found = F.coalesce(*[F.nullif(F.regexp_extract(t, _DATE_LIKE, 0), F.lit("")) for t in texts])
    return F.try_to_date(F.regexp_replace(found, "[-_/]", ""), "yyyyMMdd")


def iso_day(text: Column) -> Column:
    """The date as written; an offset does not move it."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}($|[T ]\d{2}:\d{2})"), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))


def partial_date(text: Column) -> Column:
    """Y, Y/M or Y-M-D; what is missing counts as 1."""
    p = r"^\s*(\d{4})(?:[-/](\d{1,2}))?(?:[-/](\d{1,2}))?\s*$"
    part = lambda k: F.coalesce(F.nullif(F.regexp_extract(text, p, k), F.lit("")), F.lit("1"))
    return F.when(text.rlike(p), _ymd(F.regexp_extract(text, p, 1), part(2), part(3)))


#: Every abbreviation of a month of 3 letters or more, and its number.
_SHORT = {m[:n]: k for k, m in enumerate(MONTHS, 1) for n in range(3, len(m) + 1)} | {"sept": 9}


def month_number(name: Column) -> Column:
    """From a month's English name or an abbreviation of 3 letters or more."""
    known = F.create_map(*[F.lit(x) for pair in _SHORT.items() for x in pair])
    return F.try_element_at(known, F.lower(F.regexp_replace(name, r"\.$", "")))


def month_text_date(text: Column) -> Column:
    """struct(date, precision) of: Nov. 13, 2025; 30 May 2025; December 2025;
    DD.MM.YYYY; MM-DD-YYYY.  The first of these shapes that gives a date counts."""
    number = lambda c: month_number(c).cast("string")
    shapes = [
        (r"(?i)\b([a-z]{3,9}\.?)\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})\b", lambda g: _ymd(g(3), number(g(1)), g(2)), "day"),
        (r"(?i)\b(\d{1,2})(?:st|nd|rd|th)?\s+([a-z]{3,9}\.?)\s+(\d{4})\b", lambda g: _ymd(g(3), number(g(2)), g(1)), "day"),
        (r"\b(\d{1,2})\.(\d{1,2})\.(\d{4})\b", lambda g: _ymd(g(3), g(2), g(1)), "day"),
        (r"\b(\d{2})-(\d{2})-(\d{4})\b", lambda g: _ymd(g(3), g(1), g(2)), "day"),
        (r"(?i)\b([a-z]{3,9}\.?)\s+(\d{4})\b", lambda g: _ymd(g(2), number(g(1)), F.lit("1")), "month"),
    ]
    # A lambda's variable holds what was computed once; a repeated expression
    # inside conditions would be computed again for each use.
    def found(pattern: str, make, precision: str) -> Column:
        d = F.filter(F.array(make(lambda k: F.regexp_extract(text, pattern, k))), lambda x: x.isNotNull())
        return F.get(F.transform(d, lambda x: F.struct(x.alias("date"), F.lit(precision).alias("precision"))), 0)

    return F.coalesce(*[found(*shape) for shape in shapes])


URL_DATE_FORMATS = ("auto", "yyyymmdd", "yymmdd", "yyyymm", "yyyy", "ddmmyyyy")


def url_date(url: Column, as_of: Column, fmt: str = "auto") -> Column:
    """The date in a URL's file name.  ``fmt`` says how a section writes it;
    'auto': eight digits that are a date; else six, a year from 1997 to that of
    ``as_of`` and a month, or YYMMDD of this century; without six a year."""
    if fmt not in URL_DATE_FORMATS:
        raise ValueError(f"no such format of dates: {fmt}")
    name = F.element_at(F.split(F.coalesce(url, F.lit("")), "/"), -1)
    digits = lambda p: F.nullif(F.regexp_extract(name, p, 0), F.lit(""))
    eight, six, four = digits(r"\d{8}"), digits(r"\d{6}(?!\d)"), digits(r"(?:19|20)\d{2}")
    of = {
        "yyyymmdd": F.try_to_date(eight, "yyyyMMdd"),
        "ddmmyyyy": F.try_to_date(eight, "ddMMyyyy"),
        "yymmdd": F.try_to_date(F.concat(F.lit("20"), six), "yyyyMMdd"),
        "yyyymm": F.try_to_date(F.concat(six, F.lit("01")), "yyyyMMdd"),
        "yyyy": F.try_to_date(F.concat(four, F.lit("0101")), "yyyyMMdd"),
    }
    if fmt != "auto":
        return of[fmt]
    month = F.when(F.substring(six, 1, 4).cast("int").between(F.lit(1997), F.year(as_of)), of["yyyymm"])
    return F.coalesce(of["yyyymmdd"], F.when(six.isNotNull(), F.coalesce(month, of["yymmdd"])).otherwise(of["yyyy"]))


def berlin_day(epoch: Column) -> Column:
    """Civil date of Unix seconds in Berlin; the session zone must be UTC."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_seconds(epoch), "Europe/Berlin"))


def stamp_date(stamp: Column) -> Column:
    return F.when(stamp.rlike(r"^\d{8}"), F.try_to_date(F.substring(stamp, 1, 8), "yyyyMMdd"))


def month_ok(candidate: Column, asserted: Column) -> Column:
    """A day of the asserted month, not the 1st (which stands for 'unknown')."""
    return F.coalesce((F.trunc(candidate, "month") == F.trunc(asserted, "month")) & (F.dayofmonth(candidate) != 1), F.lit(False))


def year_in_path(url: Column) -> Column:
    """January 1st of the first /19dd/ or /20dd/."""
    return F.try_to_date(F.concat(F.nullif(F.regexp_extract(url, r"/((?:19|20)\d{2})/", 1), F.lit("")), F.lit("-01-01")), "yyyy-MM-dd")


def landing_choice(landing: Column, listing_month: Column) -> Column:
    """The landing page's day where it lies in the listing's month, else the
    listing's month, else the landing page's day."""
    same = F.trunc(landing, "month") == F.trunc(listing_month, "month")
    day = lambda d: F.struct(d.alias("date"), F.lit("day").alias("precision"))
    return F.when(same, day(landing)).when(listing_month.isNotNull(), F.struct(F.trunc(listing_month, "month").alias("date"), F.lit("month").alias("precision"))).when(landing.isNotNull(), day(landing))


def pdf_creation_date(body: Column) -> Column:
    """The day in a PDF's information dictionary."""
    text = F.decode(body, "ISO-8859-1")
    return F.try_to_date(F.nullif(F.regexp_extract(text, r"/CreationDate\s*\(D:(\d{8})", 1), F.lit("")), "yyyyMMdd")

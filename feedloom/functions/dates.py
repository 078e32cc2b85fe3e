"""Date parsing and formatting. Nothing here raises: a bad text gives NULL."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import bind, collapse_space

# First day and number of days of the substitute dates.
FALLBACK_START = "2023-01-01"
FALLBACK_DAYS = 730

# Names that may lead a date.
WEEKDAYS = "Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday"
SHORT_WEEKDAYS = "Mon|Tue|Wed|Thu|Fri|Sat|Sun"

# A full English date inside running text.
LONG_DATE = (
    r"(January|February|March|April|May|June|July|August|September|October|November|December)"
    r"\s+\d{1,2},\s+\d{4}"
)

# Zone names of RFC 822 and what they mean.
ZONES = {
    "UT": "+0000",
    "UTC": "+0000",
    "GMT": "+0000",
    "Z": "+0000",
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}


# What the letters of a date pattern can stand for. A short month name is exactly three
# letters; "May" is long and short at once.
_LETTERS = {
    "MMMM": "(?:may|[a-z]{4,9})",
    "MMM": "[a-z]{3}",
    "MM": r"\d{2}",
    "M": r"\d{1,2}",
    "dd": r"\d{2}",
    "d": r"\d{1,2}",
    "yyyy": r"\d{4}",
}


def _shape(pattern: str) -> str:
    """A regular expression for the texts that can fit a date pattern."""
    return "(?i)^" + re.sub(r"M+|d+|y+", lambda m: _LETTERS[m.group()], pattern) + "$"


def shape_of(pattern: Column) -> Column:
    """``_shape`` for patterns that are data; a letter's stand-in holds no letter that comes after it here."""
    out = pattern
    for letters in ("yyyy", "dd", "d", "MMMM", "MMM", "MM", "M"):
        out = F.regexp_replace(out, rf"(?<![{letters[0]}\\]){letters}(?!{letters[0]})", f"<{'yMd'.index(letters[0])}{len(letters)}>")
    for letters, stands in _LETTERS.items():
        out = F.replace(out, F.lit(f"<{'yMd'.index(letters[0])}{len(letters)}>"), F.lit(stands))
    return F.concat(F.lit("(?i)^"), out, F.lit("$"))


def parse_date(text: Column, patterns: Sequence[str]) -> Column:
    """First pattern that fits, as a UTC wall-clock time.

    A pattern is only tried on texts of its shape: refusing a text by parsing it costs an
    exception per text and pattern.
    """

    def tried(clean: Column) -> Column:
        return F.coalesce(
            *[F.when(F.rlike(clean, F.lit(_shape(p))), F.try_to_timestamp(clean, F.lit(p))) for p in patterns]
        )

    return bind(collapse_space(text), tried).cast("timestamp_ntz")


def first_date(texts: Column, patterns: Sequence[str]) -> Column:
    """First text of an array that parses under any pattern."""
    parsed = F.transform(texts, lambda t: parse_date(t, patterns))
    return F.get(F.filter(parsed, lambda d: d.isNotNull()), F.lit(0))


def strip_weekday(text: Column, comma: bool) -> Column:
    """Drop a weekday at the front (Spark refuses to parse weekday letters)."""
    between = r",\s+" if comma else r"\s+"
    return F.regexp_replace(text, rf"(?i)^({WEEKDAYS}){between}", "")


def require_weekday(text: Column) -> Column:
    """The date behind a leading weekday; NULL when there is no weekday."""
    return F.when(F.rlike(text, F.lit(rf"(?i)^({WEEKDAYS})\s")), strip_weekday(text, comma=False))


def strip_posted_on(text: Column) -> Column:
    return F.regexp_replace(text, r"(?i)^posted on\s+", "")


def slug_date(href: Column) -> Column:
    """Date at the front of a slug such as ``/2026-05-24_name``."""
    return parse_date(F.regexp_extract(href, r"/(\d{4}-\d{2}-\d{2})_", 1), ["yyyy-MM-dd"])


def text_date(text: Column) -> Column:
    """First full English date inside running text; NULL when it names no real day."""
    return parse_date(F.regexp_extract(text, LONG_DATE, 0), ["MMMM d, yyyy"])


def fallback_date(identifier: Column) -> Column:
    """A stable stand-in date for an entry without one, from a hash of its link."""
    number = F.conv(F.substring(F.md5(identifier), 1, 8), 16, 10).cast("bigint")
    day = F.date_add(F.lit(FALLBACK_START).cast("date"), (number % FALLBACK_DAYS).cast("int"))
    return day.cast("timestamp_ntz")


def iso_date(text: Column) -> Column:
    """ISO 8601 text to UTC; a text without an offset is taken as UTC.

    The shape is checked first: Spark would also accept a bare year or a bare time of day.
    """
    shaped = F.when(F.rlike(text, F.lit(r"^\d{4}-\d{2}-\d{2}")), text)
    zoned = F.rlike(text, F.lit(r":\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2})$"))
    parsed = F.try_to_timestamp(shaped)
    return F.when(zoned, _as_utc(parsed)).otherwise(parsed.cast("timestamp_ntz"))


def _as_utc(instant: Column) -> Column:
    """Wall-clock time in UTC whatever the session time zone is."""
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def format_rfc822(published: Column) -> Column:
    return F.concat(F.date_format(published, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))


# The form nearly every feed writes; such a text only loses its weekday before parsing.
_USUAL = rf"^({SHORT_WEEKDAYS}), \d{{2}} [A-Z][a-z]{{2}} \d{{4}} \d{{2}}:\d{{2}}:\d{{2}} [+-]\d{{4}}$"
_PARSEABLE = r"(?i)^\d{1,2} [a-z]{3} \d{4} \d{1,2}:\d{2}:\d{2} [+-]\d{4}$"


def _rfc822_instant(text: Column, rewritten: Column) -> Column:
    """Parse the text itself where it has the usual form, else what it was rewritten to."""
    usual = F.rlike(text, F.lit(_USUAL))
    other = bind(rewritten, lambda t: F.when(F.rlike(t, F.lit(_PARSEABLE)), t))
    stamped = F.when(usual, F.substring(text, 6, 100)).otherwise(other)
    return _as_utc(F.try_to_timestamp(stamped, F.lit("d MMM yyyy H:mm:ss Z")))


def parse_rfc822_strict(text: Column) -> Column:
    """Only the full form: weekday, day, month, year, time with seconds, numeric offset."""
    shape = rf"(?i)^({SHORT_WEEKDAYS}),\s+(\d.*?)\s*(Z|[+-]\d{{2}}:?\d{{2}})$"
    body = F.regexp_extract(text, shape, 2)
    offset = F.replace(F.regexp_extract(text, shape, 3), F.lit(":"), F.lit(""))
    offset = bind(offset, lambda o: F.when(F.upper(o) == "Z", "+0000").otherwise(o))
    return _rfc822_instant(text, collapse_space(F.concat_ws(" ", body, offset)))


def parse_rfc822(text: Column) -> Column:
    """Forgiving form: the weekday, the seconds and the zone may be missing, a zone may be a
    name, a year may have two digits. A text without a zone is taken as UTC."""
    t = collapse_space(text)
    t = F.regexp_replace(t, r"(?i)^[a-z]+\.?,? *(?=\d)", "")
    t = F.regexp_replace(t, r"^(\d{1,2} [A-Za-z]{3}) ([0-5]\d|6[0-8]) ", "$1 20$2 ")
    t = F.regexp_replace(t, r"^(\d{1,2} [A-Za-z]{3}) (69|[7-9]\d) ", "$1 19$2 ")
    t = F.regexp_replace(t, r"^(\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{2})(?!:)", "$1:00")
    names = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])

    def zoned(t: Column) -> Column:
        zone = F.upper(F.regexp_extract(t, r" ([A-Za-z]{1,3})$", 1))
        offset = F.when(zone != "", F.coalesce(names[zone], F.lit("+0000"))).otherwise("+0000")
        bare = F.concat(F.regexp_replace(t, r" [A-Za-z]{1,3}$", ""), F.lit(" "), offset)
        return F.when(F.rlike(t, F.lit(r"[+-]\d{4}$")), t).otherwise(bare)

    return _rfc822_instant(text, bind(t, zoned))


def whole_days(later: str | datetime | Column, earlier: Column) -> Column:
    """Elapsed whole days, rounded down (not the number of midnights in between)."""
    later = later if isinstance(later, Column) else as_of(later)
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return F.floor(micros / F.lit(86_400_000_000)).cast("bigint")


def as_of(moment: str | datetime) -> Column:
    """A literal point in time; jobs never read the clock by themselves."""
    return F.lit(str(moment)).cast("timestamp_ntz")

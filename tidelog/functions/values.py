"""Typed reading of wire text, and figures of orders; native expressions, null where a text is no such value."""

from __future__ import annotations

from datetime import date as Date
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3_600_000_000_000
DAY = 24 * HOUR

# fixed values: words that are booleans
TRUE_WORDS = ("y", "yes", "true", "t", "1", "on", "oui", "si", "ja", "da")
FALSE_WORDS = ("n", "no", "false", "f", "0", "off", "non", "nein", "nej")
# fixed values: words that say there is no value
NULL_WORDS = ("", "null", "<null>", "n/a")

# fixed values: wire datatypes by the type they are kept as; any other is text
DATATYPES: dict[str, tuple[str, ...]] = {
    "bigint": ("int", "length", "tagnum", "seqnum", "numingroup", "dayofmonth", "day"),
    "double": ("float", "qty", "price", "priceoffset", "amt", "percentage", "quantity"),
    "boolean": ("boolean",),
    "binary": ("data",),
    "date": ("utcdateonly", "utcdate", "date", "localmktdate", "localmmktdate"),
    "nanos": ("utctimestamp", "time"),
    "nanos_of_day": ("utctimeonly", "localmkttime"),
}

_DIGITS, _ZEROS = "123456789", "000000000"
#: What a clock looks like with each digit as 0, to the nanosecond; shorter ones are its beginnings.
_CLOCK = "00:00:00.000000000"
_AS_ZERO = str.maketrans(_DIGITS, _ZEROS)
_EPOCH = Date(1970, 1, 1).toordinal()
_CLOCK_LENGTHS = (5, 8, *range(10, len(_CLOCK) + 1))
#: What is left of a number without its digits.
_INTEGER_SIGNS = ("", "+", "-")
_NUMBER_SIGNS = tuple(sign + point + power for sign in _INTEGER_SIGNS for point in ("", ".") for power in ("", "e", "e+", "e-"))


def datatype(name: str | None) -> str:
    """The kind a wire datatype is kept as, ``string`` if it is unknown."""
    low = (name or "").strip().lower()
    return next((kind for kind, names in DATATYPES.items() if low in names), "string")


def bool_words(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def flag(text: Column) -> Column:
    """Strictly by the first letter, Y or N."""
    first = F.upper(F.substring(F.trim(text), 1, 1))
    return F.when(first == "Y", True).when(first == "N", False)


def integer(text: Column) -> Column:
    """Digits with a sign or none, as far as 64 bits go."""
    return F.when(F.translate(text, "0123456789", "").isin(*_INTEGER_SIGNS), text.try_cast("long"))


def number(text: Column) -> Column:
    """A decimal number with a power of ten or none; words such as infinity are no numbers."""
    return F.when(F.translate(F.lower(text), "0123456789", "").isin(*_NUMBER_SIGNS), text.try_cast("double"))


def is_null_word(text: Column) -> Column:
    return F.coalesce(F.lower(F.trim(text)).isin(*NULL_WORDS), F.lit(True))


def nanos(text: Column, day: Column | None = None) -> Column:
    """A wire timestamp, date or time of day as nanoseconds since the epoch. A time alone belongs to the day of the instant
    ``day``, else to the epoch's. Hours to 23, minutes to 59, seconds to 60 (a leap second); null if the date does not exist.

    ``YYYYMMDD``, ``HH:MM[:SS[.fraction]]``, or both joined by a dash, a T or a blank; blanks around it and a Z at its end mean nothing. All is read by
    its place, once."""
    bare = F.trim(text, F.lit(" \t"))
    bare = F.when(F.endswith(bare, F.lit("Z")), F.rtrim(F.substring(bare, F.lit(1), F.length(bare) - 1), F.lit(" \t"))).otherwise(bare)
    dated = F.startswith(F.translate(bare, _DIGITS, _ZEROS), F.lit("00000000"))
    whole = F.length(bare) == 8
    joined = F.substring(bare, 9, 1).isin("-", "T", " ")
    clock = F.when(dated, F.substring(bare, 10, 19)).otherwise(bare)
    timed = F.startswith(F.lit(_CLOCK), F.translate(clock, _DIGITS, _ZEROS)) & F.length(clock).isin(*_CLOCK_LENGTHS)
    part = lambda at, n: F.coalesce(F.substring(clock, at, n).try_cast("int"), F.lit(0))
    hour, minute, second = part(1, 2), part(4, 2), part(7, 2)
    fraction = F.coalesce(F.rpad(F.substring(clock, 10, 9), 9, "0").try_cast("long"), F.lit(0))
    time = F.when(timed & (hour <= 23) & (minute <= 59) & (second <= 60), (hour * 3600 + minute * 60 + second).cast("long") * 1_000_000_000 + fraction)
    date = F.unix_date(F.concat(F.substring(bare, 1, 4), F.lit("-"), F.substring(bare, 5, 2), F.lit("-"), F.substring(bare, 7, 2)).try_cast("date")).cast("long") * DAY
    base = F.lit(0) if day is None else F.coalesce(day - F.pmod(day, F.lit(DAY)), F.lit(0))
    return F.when(dated & whole, date).when(dated & joined, date + time).when(~dated, base + time)


@lru_cache(10_000)
def _day_of(text: str) -> int | None:
    """Nanoseconds of ``YYYYMMDD``."""
    try:
        return (Date(int(text[:4]), int(text[4:6]), int(text[6:])).toordinal() - _EPOCH) * DAY
    except ValueError:
        return None


def nanos_of(text: str | None, day: int | None = None) -> int | None:
    """:func:`nanos` of one text."""
    if not text:
        return None
    bare = text.strip(" \t")
    bare = bare[:-1].rstrip(" \t") if bare.endswith("Z") else bare
    dated = len(bare) >= 8 and bare[:8].isascii() and bare[:8].isdigit()
    date = _day_of(bare[:8]) if dated else 0 if day is None else day - day % DAY
    if dated and len(bare) == 8:
        return date
    if date is None or dated and bare[8] not in "-T ":
        return None
    clock = bare[9:] if dated else bare
    if len(clock) not in _CLOCK_LENGTHS or not _CLOCK.startswith(clock.translate(_AS_ZERO)):
        return None
    hour, minute, second = int(clock[:2]), int(clock[3:5]), int(clock[6:8] or 0)
    if hour > 23 or minute > 59 or second > 60:
        return None
    return date + (hour * 3600 + minute * 60 + second) * 1_000_000_000 + int(clock[9:].ljust(9, "0"))


def date(text: Column) -> Column:
    """``YYYYMMDD`` as a date."""
    return F.when(text.rlike(r"^\s*\d{8}\s*\z"), F.try_to_timestamp(F.trim(text), F.lit("yyyyMMdd")).cast("date"))


def month_year(text: Column) -> Column:
    """``YYYYMM``, with a day or without: then the first of the month."""
    t = F.trim(text)
    return F.when(t.rlike(r"^\d{8}\z"), date(t)).when(t.rlike(r"^\d{6}(w\d)?\z"), date(F.concat(F.substring(t, 1, 6), F.lit("01"))))


def expires(time: Column, day: Column) -> Column:
    """The expiry instant, else the last nanosecond of the expiry date."""
    return F.coalesce(nanos(time), nanos(day) + (DAY - 1))


def hour_of(unix: Column) -> Column:
    """The hour's first nanosecond; floors, before the epoch as well."""
    return unix - F.pmod(unix, F.lit(HOUR))


def micros(unix: Column) -> Column:
    """Whole microseconds; a quotient by doubles would not be exact."""
    return ((unix - F.pmod(unix, F.lit(1000))).cast("decimal(20,0)") / 1000).cast("long")


def notional(px: Column, qty: Column, multiplier: Column, asset: Column) -> Column:
    """Price by quantity by multiplier, which is 1 for cash instruments that have none; null if one is missing."""
    cash = (asset >= 100) & (asset < 200)
    return px * qty * F.coalesce(multiplier, F.when(cash, 1.0))


def isin(security_id: Column, source: Column, alt_ids: Column) -> Column:
    return F.coalesce(F.when(source == "4", security_id), F.try_element_at(alt_ids, F.lit("ISIN")))


def weighted(avg: Column, done: Column, px: Column, qty: Column) -> Column:
    """The average price after a fill; the first fill's is its own, and a fill without price or quantity changes nothing."""
    have = px.isNotNull() & qty.isNotNull()
    return F.when(~have, avg).when(avg.isNull() | F.coalesce(done == 0, F.lit(True)), px).otherwise((avg * done + px * qty) / F.nullif(done + qty, F.lit(0.0)))


def resting(display: Column, leaves: Column, qty: Column) -> Column:
    return F.coalesce(display, leaves, qty, F.lit(0.0))


def leaves(state: Column, qty: Column, filled: Column) -> Column:
    return F.when(state >= 400, 0.0).otherwise(F.greatest(qty - F.coalesce(filled, F.lit(0.0)), F.lit(0.0)))


def local_to_nanos(local: Column, zone: str | None) -> Column:
    """A naive timestamp in a zone (none: UTC) as nanoseconds. An hour told twice is the first; one that is left out is the instant of the change."""
    if zone is None:
        return F.unix_micros(F.to_timestamp(local)) * 1000
    utc = F.to_utc_timestamp(F.to_timestamp(local), zone)
    micros = F.unix_micros(utc)
    gap = F.unix_micros(F.from_utc_timestamp(utc, zone)) - F.unix_micros(F.to_timestamp(local))
    # in a gap the time comes back later than it was by as much as was left out: the change is so far back, on a whole quarter of an hour
    quarter = 900 * 1_000_000
    return F.when(gap == 0, micros).otherwise(micros - F.pmod(micros, F.lit(quarter)) - F.floor(F.pmod(F.unix_micros(F.to_timestamp(local)), F.abs(gap)) / quarter) * quarter) * 1000


def rendered(value: Column, kind: str) -> Column:
    """A typed value as wire text: Y and N, positional numbers, stamps to the microsecond."""
    if kind == "boolean":
        return F.when(value, "Y").when(~value, "N")
    if kind in ("double", "float"):
        return F.regexp_replace(F.regexp_replace(value.cast("decimal(38,12)").cast("string"), r"(\.\d*?)0+\z", "$1"), r"\.\z", "")
    if kind == "nanos":
        at = F.timestamp_micros(micros(value))
        return F.date_format(at, "yyyyMMdd-HH:mm:ss.SSSSSS")
    return value.cast("string")

"""Text-to-value parsers with the grammar of the daily-file checks.

The grammar is Python's own, ``float()`` and ``datetime.fromisoformat()`` (3.11 and later), as
built-in column expressions: no row leaves the JVM. Common shapes, on which Spark's casts agree,
are cast at once; every other text goes through one pattern that takes it apart. The parts are
bound in a lambda, so they are worked out once and only for those rows. All parsers are
NULL-on-failure, so bad input never raises under ANSI mode.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() removes exactly the characters for which str.isspace() is true;
# the set is derived from that rule (BMP is enough: none lie above U+3000).
_SPACE_CHARS = tuple(ch for ch in map(chr, range(0x10000)) if ch.isspace())
_WS = "[" + "".join(f"\\u{ord(ch):04x}" for ch in _SPACE_CHARS) + "]"
# float() strips these of ASCII and all white space beyond it
_FLOAT_WS = r"[ \t\n\x0b\f\r" + "".join(f"\\u{ord(ch):04x}" for ch in _SPACE_CHARS if ord(ch) >= 0x80) + "]"

# float() reads every Unicode decimal digit
_DIGITS = [(ch, str(unicodedata.decimal(ch))) for ch in map(chr, range(0x80, sys.maxunicode + 1))
           if unicodedata.category(ch) == "Nd"]


def strip(col: Column) -> Column:
    """Python-style whitespace strip (Spark's ``trim`` removes spaces only).

    The regex runs only when the first or last character is whitespace (a hashed set
    lookup), which is rare; other values pass through unchanged.
    """
    edge = (F.substring(col, 1, 1).isin(*_SPACE_CHARS)
            | F.substring(col, -1, 1).isin(*_SPACE_CHARS))
    stripped = F.regexp_replace(F.regexp_replace(col, f"^{_WS}+", ""), f"{_WS}+$", "")
    return F.when(edge, stripped).otherwise(col)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, whatever ``use`` makes of it."""
    return F.element_at(F.transform(F.array(value), use), 1)


# Shapes on which Spark's casts and Python's parsers provably agree.
SIMPLE_FLOAT = r"\A[+-]?[0-9]+(\.[0-9]+)?\z"
SIMPLE_ISO = (r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}"
              r"([T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?(Z|\+00:00)?)?\z")

_RUN = r"[0-9](?:_?[0-9])*"     # digits, single underscores between them
_FLOAT = (rf"\A(?:([+-]?)(?i:(nan)|(inf)(?:inity)?)"
          rf"|([+-]?(?:(?:{_RUN})?\.{_RUN}|{_RUN}\.?)(?:[eE][+-]?{_RUN})?))\z")


def _any_float(text: Column) -> Column:
    """``float(text)``. Patterns end in ``\\z``: "$" would overlook a last line break."""
    bare = F.translate(F.regexp_replace(text, rf"\A{_FLOAT_WS}+|{_FLOAT_WS}+\z", ""),
                       "".join(a for a, _ in _DIGITS), "".join(b for _, b in _DIGITS))

    def value(t: Column) -> Column:
        sign = F.substring(t, 1, 1)
        special = F.lower(F.regexp_replace(t, r"^[+-]", ""))
        infinite = F.when(sign == "-", F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
        return F.when(t.rlike(_FLOAT), F.when(special == "nan", F.lit(float("nan")))
                      .when(special.startswith("inf"), infinite)
                      .otherwise(F.regexp_replace(t, "_", "").try_cast("double")))
    return _bound(bare, value)


def parse_float(col: Column) -> Column:
    """DOUBLE if ``col`` is a float literal in Python's grammar (blanks around allowed, '1_0',
    'inf', 'nan', digits of any script), else NULL."""
    return F.when(col.rlike(SIMPLE_FLOAT), col.try_cast("double")).otherwise(_any_float(col))


def parse_range(col: Column) -> Column:
    """Split at the first '-' into ``struct(lower, upper)`` doubles; NULL when either fails
    (so '-1.0-5.0', '1e-5-2', '12' and '5-' are invalid)."""
    dash = F.instr(col, "-")
    ends = F.array(F.substring_index(col, "-", 1), col.substr(dash + 1, F.length(col)))

    def pair(v: Column) -> Column:
        return F.when(v[0].isNotNull() & v[1].isNotNull(), F.struct(v[0].alias("lower"), v[1].alias("upper")))
    return F.when(dash > 0, _bound(F.transform(ends, parse_float), pair))


# date: Y-m-d, Ymd, Y-Ww(-d), YWw(d). After Y-Ww a "-d" with another digit behind it is a
# separator and an hour; after YWw an odd run of three or more digits begins with the separator.
_DATE = (r"(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})"
         r"|(\d{4})-W(\d{2})(?:-(\d)(?!\d))?(?!-\z)"
         r"|(\d{4})W(\d{2})(?:(?=\d(?!\d)|(?:\d\d)+(?!\d))(\d))?")
# Hours, minutes, seconds with colons everywhere or nowhere. A fraction (of seconds) may follow
# any of them; unmarked only all three without colons, and then with two digits at least.
# Before an offset Python overlooks one character in the place of a fraction, and whatever
# follows six digits of one.
def _clock(fraction: str, instead: str) -> str:
    f, x = f"({fraction})", instead
    return (rf"(\d{{2}})(?::(\d{{2}})(?::(\d{{2}})(?:[.,:]{f}{x})?|[.,]{f}{x})?"
            rf"|(\d{{2}})(?:(\d{{2}})(?:[.,]{f}|((?=\d\d)(?:{fraction})){x})?|[.,]{f}{x})?|[.,]{f}{x})?")


_STRICT = _clock(r"\d+", "")
_LOOSE = _clock(r"\d{6}[^+\-Z]*|\d{1,5}", r"|[\x00-\x7F&&[^+\-Z]]")
_ISO = rf"(?s)\A(?:{_DATE})(?:.(?:{_LOOSE}(?:(Z)|([+-]){_STRICT})|{_STRICT}))?\z"


def _groups(*numbers: int) -> str:
    return "".join(f"${n}" for n in numbers)


def _clock_groups(*first: int) -> list[str]:
    """Hour, minute, second and fraction of clocks whose groups begin at ``first``."""
    return [_groups(*(a + k for a in first for k in ks)) for ks in ((0,), (1, 5), (2, 6), (3, 4, 7, 8, 9, 10))]


_ISO_PARTS = "|".join([_groups(1, 4), _groups(2, 5), _groups(3, 6), _groups(7, 10), _groups(8, 11), _groups(9, 12),
                       *_clock_groups(13, 37), _groups(24, 25), *_clock_groups(26)])


def _any_iso(text: Column) -> Column:
    def value(p: Column) -> Column:
        (year, month, day, week_year, week, week_day, hour, minute, second, fraction, zone, off_hour, off_minute,
         off_second, off_fraction) = (p[k] for k in range(15))
        number = lambda c: F.coalesce(c.try_cast("int"), F.lit(0))
        micros = lambda c: F.rpad(F.substring(c, 1, 6), 6, "0")
        or_zero = lambda c: F.when(c == "", F.lit("00")).otherwise(c)
        fourth = F.concat(week_year, F.lit("-01-04")).try_cast("date")
        d = F.when(week_day == "", F.lit(1)).otherwise(number(week_day))
        monday = F.date_add(fourth, number(week) * 7 - 7 + d - 1 - F.weekday(fourth))
        week_date = F.when((d.between(1, 7)) & number(week).between(1, 53)
                           & ((number(week) < 53) | (F.extract(F.lit("YEAROFWEEK"), monday) == number(week_year))), monday)
        date = F.when(year != "", F.concat_ws("-", year, month, day).try_cast("date")).otherwise(week_date)
        local = F.concat(date.cast("string"), F.lit(" "), or_zero(hour), F.lit(":"), or_zero(minute), F.lit(":"),
                         or_zero(second), F.lit("."), micros(fraction)).try_cast("timestamp")
        whole = (number(off_hour) * 3600 + number(off_minute) * 60 + number(off_second)).cast("long")
        # less than a second is no offset
        offset = F.when(whole == 0, F.lit(0)).otherwise(
            whole * 1_000_000 + F.when(off_fraction != "", micros(off_fraction).cast("long")).otherwise(F.lit(0)))
        day_long = F.lit(86_400_000_000)
        signed = F.when(zone == "-", -offset).otherwise(offset)
        moved = F.timestamp_micros(F.unix_micros(local) - F.when(offset < day_long, signed).otherwise(F.lit(0)))
        real = F.year(local).between(1, 9999) & F.year(moved).between(1, 9999) & (offset < day_long)
        return F.when((year != "0000") & (week_year != "0000") & real, moved)
    return F.when(text.rlike(_ISO), _bound(F.split(F.regexp_replace(text, _ISO, _ISO_PARTS), r"\|"), value))


def parse_iso_ts(col: Column) -> Column:
    """UTC TIMESTAMP for text accepted by ``datetime.fromisoformat``, else NULL.

    Date-only means midnight, an offset is applied, and a naive time is taken as UTC. A time
    that the offset moves out of the years 1 to 9999 is NULL.
    """
    return F.when(col.rlike(SIMPLE_ISO), col.try_cast("timestamp")).otherwise(_any_iso(col))


def parse_lab_fields(result: Column, rng: Column, collected: Column) -> Column:
    """The three lab parsers as struct(result, lower, upper, collected)."""
    bounds = parse_range(rng)
    return F.struct(parse_float(result).alias("result"), bounds["lower"].alias("lower"),
                    bounds["upper"].alias("upper"), parse_iso_ts(collected).alias("collected"))


def parse_event_time(col: Column) -> Column:
    """Stream event time with Spark's timestamp grammar, NULL instead of an error."""
    return col.try_cast("timestamp")

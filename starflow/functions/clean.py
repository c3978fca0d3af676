"""Column -> Column cleaning functions.

Every function here is a pure composition of built-in Spark expressions, so it
stays inside whole-stage codegen and costs nothing extra at scale: no UDFs, no
Python per row.  Names follow the operator inventory (CLN*, NUM*, DAT*, STR*).
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import COUNTRY_SPELLINGS, EXCEL_EPOCH, SEGMENT_ALIASES


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- text (CLN*)

def _without(c: Column, marks: str) -> Column:
    """Drop each of a few characters: a search of bytes, no pattern."""
    for mark in marks:
        c = F.replace(c, F.lit(mark), F.lit(""))
    return c


def _only(c: Column, kept: str) -> Column:
    """Drop every character outside the class ``kept``.  A search for what is
    outside costs several times the test that nothing is, so it is made only
    for texts that fail the test."""
    return F.when(c.rlike(rf"^[{kept}]*+\z"), c).otherwise(F.regexp_replace(c, rf"[^{kept}]+", ""))


def clean_text(col) -> Column:
    """Letters and spaces only, trimmed, lower case; NULL -> 'unknown'.

    An empty string stays empty (only NULL is defaulted)."""
    return F.coalesce(F.lower(F.trim(_only(_without(_c(col), "-."), "a-zA-Z "))), F.lit("unknown"))


def clean_name(col) -> Column:
    """Collapse runs of whitespace, trim, lower case; NULL -> 'unknown'."""
    c = F.replace(F.trim(_c(col)), F.lit("  "), F.lit(" "))
    even = c.rlike(r"^\S++(?: \S++)*+\z")
    return F.coalesce(F.lower(F.when(even, c).otherwise(F.trim(F.regexp_replace(c, r"\s+", " ")))),
                      F.lit("unknown"))


def trim_chars(col, chars: str = "unknown") -> Column:
    """Lower case, then strip the *set* of characters ``chars`` at both ends.

    This is the product-name rule of the source pipeline as written: the
    default argument that was meant as a NULL default is a trim set, so
    'notebook' -> 'teb' and NULL stays NULL."""
    return F.btrim(F.lower(_c(col)), F.lit(chars))


def clean_id_text(col) -> Column:
    """Drop every character that is not a letter or a digit."""
    return _only(_without(_c(col), "# .-"), "A-Za-z0-9")


# Shape guards.  try_* casts report failure through exceptions inside the
# JVM, which costs microseconds per row; a regex test first keeps the common
# "does not apply" case on the fast path.  Each guard accepts a superset of
# the strings the cast can parse, so results are unchanged.
# No part of it can give back what another needs: possessive, without groups.
_DECIMAL_SHAPE = r"^\s*+[+-]?+(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+\s*$"


def guarded_cast(col, to: str) -> Column:
    c = _c(col)
    return F.when(c.rlike(_DECIMAL_SHAPE), c.try_cast(to))


def clean_id(col) -> Column:
    """Identifier text -> bigint, leading zeros and all; letters left in the
    text make it NULL."""
    t = clean_id_text(col)
    return F.when(t.rlike(r"^[0-9]+$"), t.try_cast("bigint"))


def map_country_code(col) -> Column:
    """Known spellings -> ISO alpha-2; anything else passes through raw."""
    c = _c(col)
    key = F.upper(F.trim(F.replace(c, F.lit("."), F.lit(""))))
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(COUNTRY_SPELLINGS.items())])
    return F.coalesce(F.try_element_at(lookup, key), c)


def map_segment(col) -> Column:
    """Segment aliases -> canonical segment; anything else unchanged."""
    c = _c(col)
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(SEGMENT_ALIASES.items())])
    return F.coalesce(F.try_element_at(lookup, c), c)


# ------------------------------------------------------------- numbers (NUM*)

_CURRENCY_CHARS = "$ EURABCDFGHIJKLMNOPQSTVWXYZ"


def _number_chars(c: Column, also: str = "") -> Column:
    """Digits, separators and the characters ``also``.  What stands before the
    first of them is mostly a currency, which a trim takes off."""
    return _only(F.ltrim(c, F.lit(_CURRENCY_CHARS)), f"0-9.,{also}")


def normalize_decimal(col) -> Column:
    """Number text -> text with '.' as the decimal point (source rule as is).

    Compares the *first* positions of ',' and '.':
      both present, ',' after '.'  -> swap the two separators ('!' kept -> '.')
      only ',' and <= 2 chars after it -> ',' becomes '.'
      only '.' and > 2 chars after it  -> '.' becomes ','
      otherwise the digits/separators unchanged.
    Thousands separators stay in the text, so '1,234.50' does not cast."""
    c = _c(col)
    s = _number_chars(c)
    pc = F.locate(",", s)
    pd = F.locate(".", s)
    return (
        F.when((pc > pd) & (pc > 0) & (pd > 0),
               F.translate(_number_chars(c, "!"), ",.!", ".,."))
        .when((pc > 0) & (pd == 0) & (F.length(s) - pc <= 2), F.replace(s, F.lit(","), F.lit(".")))
        .when((pd > 0) & (pc == 0) & (F.length(s) - pd > 2), F.replace(s, F.lit("."), F.lit(",")))
        .otherwise(s)
    )


def to_decimal(col, precision: int = 10, scale: int = 2) -> Column:
    return guarded_cast(col, f"decimal({precision},{scale})")


def parse_money(col) -> Column:
    """Money text -> decimal(10,2), the corrected rule.

    The last separator is the decimal point when it is the only occurrence of
    its character and another separator precedes it; a lone separator is
    decimal with at most two digits after it, else a thousands separator; a
    run of the same separator is thousands.  A '-' or '(' before the first
    digit makes the value negative."""
    c = _c(col)
    s = _number_chars(c)
    n_sep = F.length(s) - F.length(F.translate(s, ".,", ""))
    last_sep = F.regexp_extract(s, r"([.,])[0-9]*$", 1)
    after = F.regexp_extract(s, r"[.,]([0-9]*)$", 1)
    before = F.regexp_replace(F.regexp_extract(s, r"^(.*)[.,][0-9]*$", 1), r"[^0-9]", "")
    same_as_last = F.length(s) - F.length(F.replace(s, last_sep, F.lit("")))
    is_decimal = (
        F.when(n_sep == 1, F.length(after) <= 2)
        .when(n_sep > 1, same_as_last == 1)
        .otherwise(F.lit(False))
    )
    digits = F.regexp_replace(s, r"[^0-9]", "")
    text = F.when(is_decimal, F.concat(F.when(before == "", F.lit("0")).otherwise(before),
                                       F.lit("."), after)).otherwise(digits)
    value = F.when(digits != "", text).try_cast("decimal(12,2)")
    negative = c.rlike(r"^[^0-9]*[-(]")
    signed = F.when(negative, -value).otherwise(value)
    return signed.try_cast("decimal(10,2)")


def parse_percent(col) -> Column:
    """NULL -> 0.00; '15%' -> 0.15; otherwise the number as decimal(10,2)."""
    c = _c(col)
    pct = F.try_divide(guarded_cast(F.replace(c, F.lit("%"), F.lit("")), "double"), F.lit(100.0))
    return (
        F.when(c.isNull(), F.lit(0).cast("decimal(10,2)"))
        .when(F.contains(c, F.lit("%")), pct.try_cast("decimal(10,2)"))
        .otherwise(guarded_cast(c, "decimal(10,2)"))
    )


def parse_int(col) -> Column:
    """Integer text, rounding '12.6' -> 13 and '45322.0' -> 45322; junk -> NULL."""
    d = F.round(guarded_cast(col, "decimal(20,6)"), 0)
    plain, number = _plain_int(F.trim(_c(col)))
    return F.when(plain, number).otherwise(F.when(d.between(-2147483648, 2147483647), d).try_cast("int"))


def _plain_int(c: Column) -> tuple[Column, Column]:
    """Whether a text is a whole number of up to six digits, also as '12.0',
    and that number: most are, and need no decimal."""
    return c.rlike(r"^-?[0-9]{1,6}(?:\.0)?\z"), F.substring_index(c, ".", 1).try_cast("int")


def sign_int(col) -> Column:
    """sign() as an integer, so '-'.join() keys read '1', not '1.0'."""
    return F.signum(_c(col)).try_cast("int")


# --------------------------------------------------------------- dates (DAT*)

_ISO_PREFIX = r"^\d{4}-\d{1,2}-\d{1,2}"
_SLASH_ISO = r"^\d{4}/\d{1,2}/\d{1,2}\z"
_SERIAL = r"^-?\d+(\.\d+)?$"
_US_DATE = r"^\d{1,2}/\d{1,2}/\d{4}\z"
_DAY_MON_YEAR = r"^\d{1,2} [A-Za-z]{3} \d{4}\z"
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"


def _date_of(year: Column, month: Column, day: Column) -> Column:
    """Digits of a year of four, a month and a day -> date.  The cast reads ISO
    text directly, where a pattern is walked by a formatter."""
    return F.concat_ws("-", year, month, day).try_cast("date")


def parse_date(col) -> Column:
    """Date text in any of the export's forms -> date; NULL when none fits.

    Forms: ISO date (with an optional time part), yyyy/mm/dd, mm/dd/yyyy,
    dd Mon yyyy, and spreadsheet serial days counted from 1899-12-30.
    A form is told from the place of its first separator, and only the pattern
    of that form is then tested, so a serial number is never read as a year."""
    s = F.trim(_c(col))
    slash, space = F.locate("/", s), F.locate(" ", s)
    first, last = F.substring_index(s, "/", 1), F.substring_index(s, "/", -1)
    middle = F.substring_index(F.substring_index(s, "/", 2), "/", -1)
    name = F.lower(F.substring_index(F.substring_index(s, " ", 2), " ", -1))
    month = F.floor((F.nullif(F.position(name, F.lit(_MONTHS)), F.lit(0)) + 3) / 4).cast("string")
    serial_days = F.round(s.try_cast("decimal(20,6)"), 0)
    plain, number = _plain_int(s)
    epoch = F.lit(EXCEL_EPOCH).cast("date")
    return (
        F.when(F.substring(s, 5, 1) == "-", F.when(s.rlike(_ISO_PREFIX), s.try_cast("date")))
        .when(slash == 5, F.when(s.rlike(_SLASH_ISO), _date_of(first, middle, last)))
        .when(slash.between(2, 3), F.when(s.rlike(_US_DATE), _date_of(last, first, middle)))
        .when(space.between(2, 3), F.when(s.rlike(_DAY_MON_YEAR) & month.isNotNull(),
                                          _date_of(F.substring_index(s, " ", -1), month, F.substring_index(s, " ", 1))))
        .when(plain & (number >= -693593), F.date_add(epoch, number))
        .when(s.rlike(_SERIAL), F.when(serial_days.between(-693593, 2958465),
                                       F.date_add(epoch, serial_days.try_cast("int"))))
    )


def day_name(col) -> Column:
    """Full English day name ('Sunday')."""
    return F.date_format(_c(col), "EEEE")


def day_of_week0(col) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(_c(col)) - 1


# ----------------------------------------------------------- mojibake (SRC5)

def _cp1252_high_chars() -> tuple[str, str]:
    """The characters cp1252 places at bytes 0x80-0x9F, and the Latin-1
    code points of those bytes, derived from Python's own codec."""
    src, dst = [], []
    for b in range(0x80, 0xA0):
        try:
            ch = bytes([b]).decode("cp1252")
        except UnicodeDecodeError:
            continue
        src.append(ch)
        dst.append(chr(b))
    return "".join(src), "".join(dst)


_CP_SRC, _CP_DST = _cp1252_high_chars()
# Python's str.strip() whitespace, as a Java regex class.
_PY_WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def py_strip(col) -> Column:
    """Strip what Python's ``str.strip`` does.  A text between two visible ASCII
    characters has nothing to strip and meets no pattern."""
    c = _c(col)
    ends = F.ascii(F.left(c, F.lit(1))).between(33, 126) & F.ascii(F.right(c, F.lit(1))).between(33, 126)
    return F.when(ends, c).otherwise(F.regexp_replace(c, rf"^{_PY_WS}+|{_PY_WS}+$", ""))


def fix_mojibake(col) -> Column:
    """Undo UTF-8 text that was decoded as Windows-1252, then strip.

    Equivalent to ``s.encode('cp1252').decode('utf-8').strip()`` with a
    fallback to ``s.strip()`` when either step fails, built from native
    expressions: the 27 cp1252-only characters are mapped back to their byte
    values, the string must then be Latin-1, and the bytes must be UTF-8.  ASCII
    text is what it was, so it is only stripped."""
    c = _c(col)
    ascii_only = F.octet_length(c) == F.char_length(c)
    mapped = F.translate(c, _CP_SRC, _CP_DST)
    encodable = ~c.rlike(r"[\u0080-\u009f]") & mapped.rlike(r"^[\x00-\xff]*$")
    as_bytes = F.encode(mapped, "ISO-8859-1")
    repaired = F.try_validate_utf8(as_bytes.cast("string"))
    fixed = F.when(ascii_only, c).when(encodable, repaired)
    return F.when(c.isNotNull(), py_strip(F.coalesce(fixed, c)))

"""Blank tests and defensive text-to-value conversions, all as column expressions."""

from pyspark.sql import Column, functions as F

# Characters a Unicode-aware strip removes at both ends.
WHITESPACE = (" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85          "
              "       　")

# Spark's cast alone also accepts '12d' and hexadecimal floats; other engines accept '1_000'.
NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"
STRICT_DATE = r"^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}$"
ISO_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
MONTH_FIRST_DATE = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})$"


def _is_plain(character: Column) -> Column:
    """True for a visible ASCII character, which no strip removes."""
    return F.ascii(character).between(33, 126)


def strip(c: Column) -> Column:
    """Text that begins and ends with visible ASCII is taken as it is; only other text is searched."""
    plain = _is_plain(c) & _is_plain(F.substring(c, -1, 1))
    return F.when(plain, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def stripped(c: Column) -> Column:
    """Stripped text, '' for NULL."""
    return F.coalesce(strip(c), F.lit(""))


def is_blank(c: Column) -> Column:
    return F.when(_is_plain(c), False).otherwise(stripped(c) == "")


def to_double(c: Column) -> Column:
    """DOUBLE, or NULL where the text is not a number. 'nan' is not a number."""
    return F.when(c.rlike(NUMBER), c.try_cast("double"))


def to_int(c: Column, fractions: bool = True) -> Column:
    """INT, or NULL. ``fractions`` rounds '12.7' to 13; otherwise only whole numbers convert."""
    whole = F.when(c.rlike(WHOLE_NUMBER), c.try_cast("int"))
    return F.coalesce(whole, F.round(to_double(c)).try_cast("int")) if fractions else whole


def to_strict_date(c: Column) -> Column:
    """DATE for a real calendar day written exactly YYYY-MM-DD, blanks around it aside, else NULL."""
    text = strip(c)
    return (F.when(c.rlike(STRICT_DATE), c.try_cast("date"))
            .otherwise(F.when(text.rlike(STRICT_DATE), text.try_cast("date"))))


def is_date_shaped(text: Column, month_first: bool = False) -> Column:
    """True for an ISO-form day ('2024-2-3' included) and, on request, '05/03/2024'."""
    iso = text.rlike(ISO_DATE)
    return iso | text.rlike(MONTH_FIRST_DATE) if month_first else iso


def shaped_to_date(text: Column, month_first: bool = False) -> Column:
    """DATE from date-shaped text, NULL for a day that does not exist.

    ``month_first`` reads '05/03/2024' as 3 May, as a server with a month-day-year date style does.
    """
    day = text.try_cast("date")
    if not month_first:
        return day
    turned = F.regexp_replace(text, MONTH_FIRST_DATE, "$3-$1-$2").try_cast("date")
    return F.when(text.rlike(MONTH_FIRST_DATE), turned).otherwise(day)


def to_date(c: Column, month_first: bool = False) -> Column:
    """DATE from any text, NULL where it is not one."""
    text = strip(c)
    return F.when(is_date_shaped(text, month_first), shaped_to_date(text, month_first))


def zero_padded(prefix: str, c: Column, width: int) -> Column:
    """'CRED-00042' style; longer numbers keep all their digits."""
    digits = c.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def with_thousands(c: Column) -> Column:
    """'1,234.50' style; infinities as 'inf' / '-inf'."""
    infinity = F.lit(float("inf"))
    return (F.when(c == infinity, "inf").when(c == -infinity, "-inf")
            .otherwise(F.format_number(c, 2)))

"""Dates, amounts, percentages and quantities written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidlens.functions import as_column, let, literal
from bidlens.functions.text import clean, find

# Month names.
MONTHS = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
_DAY_FIRST = (
    "(?i)^(\\d{1,2})([-/ ])(\\d{1,2}|[a-z]{3,9})\\2(\\d{4})"
    "(?: (\\d{1,2}):(\\d{1,2})(?::(\\d{1,2}))?(?: (am|pm))?)?$"
)
_ISO = "^(\\d{4})-(\\d{1,2})-(\\d{1,2})(?:[ T](\\d{1,2}):(\\d{1,2}):(\\d{1,2}))?$"
_LOOSE = (
    "\\d{1,2}[-/ ][A-Za-z]{3,9}[-/ ]\\d{4}(?:\\s+\\d{1,2}:\\d{2}(?::\\d{2})?)?"
    "|\\d{1,2}[-/]\\d{1,2}[-/]\\d{4}(?:\\s+\\d{1,2}:\\d{2}(?::\\d{2})?)?"
)
# The portal's own stamp, digit for digit: no other form has to be tried.
_STAMP = "\\A\\d{2}-\\d{2}-\\d{4} \\d{2}:\\d{2}:\\d{2}\\z"
# Number, currency prefix and scale of an amount.
NUMBER = "\\d{1,3}(?:,\\d{2,3})+(?:\\.\\d+)?|\\d+(?:\\.\\d+)?"
SCALES = {
    "k": 1e3, "thousand": 1e3, "lakh": 1e5, "lakhs": 1e5, "lac": 1e5, "lacs": 1e5,
    "crore": 1e7, "crores": 1e7, "cr": 1e7,
}
_AMOUNT = (
    f"(?iU)(?:(?:rs\\.?|inr|\u20b9)\\s*)?({NUMBER})\\s*(lakhs?|lacs?|crores?|cr|k|thousand)?"
)
_DIGITS = "\u0966\u0967\u0968\u0969\u096a\u096b\u096c\u096d\u096e\u096f"


def to_number(text: Column) -> Column:
    """Digits (Latin or Devanagari, commas allowed) to DOUBLE, else null."""
    return F.translate(text, _DIGITS + ",", "0123456789").try_cast("double")


def parse_datetime(col: Column | str) -> Column:
    """A portal date/time as wall-clock TIMESTAMP_NTZ; null if unreadable."""
    return let(as_column(col), lambda raw: F.when(raw.rlike(_STAMP), _stamp(raw)).otherwise(_any_datetime(raw)))


def _stamp(text: Column) -> Column:
    def number(start: int, length: int = 2) -> Column:
        return F.substring(text, start, length).cast("int")

    return F.try_make_timestamp_ntz(
        number(7, 4), number(4), number(1), number(12), number(15), F.substring(text, 18, 2).cast("decimal(16,6)")
    )


def _any_datetime(col: Column) -> Column:
    text = clean(col)
    text = F.trim(F.regexp_replace(text, "(?iU)\\b(?:ist|hrs|hours)\\b", ""))
    text = F.regexp_replace(F.replace(text, F.lit(","), F.lit(" ")), " {2,}", " ")
    # The whole text, else the first date-looking piece of a longer one.
    tries = let(text, lambda t: F.array(t, F.regexp_extract(t, _LOOSE, 0)))
    return let(F.transform(tries, _wall_clock), lambda t: F.coalesce(F.get(t, F.lit(0)), F.get(t, F.lit(1))))


def _wall_clock(text: Column) -> Column:
    def part(pattern: str, group: int) -> Column:
        return F.regexp_extract(text, pattern, group)

    def number(value: Column, default: int | None = None) -> Column:
        parsed = value.try_cast("int")
        return parsed if default is None else F.coalesce(parsed, F.lit(default))

    sep, month = part(_DAY_FIRST, 2), F.lower(part(_DAY_FIRST, 3))
    clock, second, half = part(_DAY_FIRST, 5), part(_DAY_FIRST, 7), F.lower(part(_DAY_FIRST, 8))
    names = literal(
        {key: i for i, name in enumerate(MONTHS, start=1) for key in (name[:3], name)}, "map<string,int>"
    )
    numeric = month.rlike("^\\d")
    # Which mixes of separator, month style and clock the portal uses.
    known = (
        (numeric & sep.isin("-", "/"))
        | (~numeric & (F.length(month) == 3) & sep.isin("-", " "))
        | (~numeric & ((F.length(month) > 3) | (month == "may")) & (sep == " ") & (second == ""))
    )
    hour = number(clock, 0)
    twelve = (half != "") & (second == "") & (sep != " ") & hour.between(1, 12)
    hour = (
        F.when(half == "", hour)
        .when(~twelve, None)
        .when(half == "pm", hour % 12 + 12)
        .otherwise(hour % 12)
    )
    day_first = F.try_make_timestamp_ntz(
        number(part(_DAY_FIRST, 4)),
        F.when(numeric, number(month)).otherwise(F.element_at(names, month)),
        number(part(_DAY_FIRST, 1)),
        hour,
        number(part(_DAY_FIRST, 6), 0),
        F.coalesce(second.try_cast("decimal(16,6)"), F.lit(0).cast("decimal(16,6)")),
    )
    iso = F.try_make_timestamp_ntz(
        number(part(_ISO, 1)), number(part(_ISO, 2)), number(part(_ISO, 3)),
        number(part(_ISO, 4), 0), number(part(_ISO, 5), 0),
        F.coalesce(part(_ISO, 6).try_cast("decimal(16,6)"), F.lit(0).cast("decimal(16,6)")),
    )
    return F.when(text.rlike(_DAY_FIRST), F.when(known, day_first)).when(text.rlike(_ISO), iso)


def parse_amount(col: Column | str, cleaned: bool = False) -> Column:
    """Rupee amount as DOUBLE. 'nil' is 0; no figure is null."""
    return let(as_column(col) if cleaned else clean(col), _amount)


def _amount(text: Column) -> Column:
    low = F.lower(text)
    scale = F.lower(F.regexp_extract(text, _AMOUNT, 2))
    factor = F.element_at(literal(SCALES, "map<string,double>"), scale)
    value = to_number(F.regexp_extract(text, _AMOUNT, 1)) * F.coalesce(factor, F.lit(1.0))
    no_digits = ~text.rlike("(?U)\\d")
    return (
        F.when(no_digits & low.contains("nil"), F.lit(0.0))
        .when(no_digits, None)
        .otherwise(value)
    )


def parse_percentage(col: Column | str, cleaned: bool = False) -> Column:
    def figure(text: Column) -> Column:
        return F.coalesce(
            find(text, "(?U)(\\d+(?:\\.\\d+)?)\\s*%", 1),
            find(text, "(?iU)(\\d+(?:\\.\\d+)?)\\s*(?:percent|per cent|pc)\\b", 1),
        )

    return to_number(let(as_column(col) if cleaned else clean(col), figure))


def parse_quantity(col: Column | str) -> Column:
    """STRUCT<number DOUBLE, unit STRING>."""
    pattern = "(?U)(\\d[\\d,]*(?:\\.\\d+)?)\\s*([A-Za-z./]+)?"
    return let(
        clean(col),
        lambda text: F.struct(
            to_number(F.regexp_extract(text, pattern, 1)).alias("number"),
            F.regexp_extract(text, pattern, 2).alias("unit"),
        ),
    )


def days_remaining(closing: Column | str, now: str) -> Column:
    """Calendar days to the closing time; -1 if it passed earlier today."""
    c, n = as_column(closing), F.lit(now).cast("timestamp_ntz")
    same_day = F.to_date(c) == F.to_date(n)
    return F.when(same_day & (c < n), F.lit(-1)).otherwise(
        F.date_diff(F.to_date(c), F.to_date(n))
    )


def urgency(days: Column | str, bands: list[dict]) -> Column:
    d = as_column(days)
    out = F.when(d.isNull(), "UNKNOWN").when(d < 0, "EXPIRED")
    for band in bands:
        out = out.when(d.between(band["min"], band["max"]), band["label"])
    return out.otherwise("WATCHLIST")


def rupees(col: Column | str) -> Column:
    return F.concat(F.lit("\u20b9"), F.format_number(as_column(col), 0))


def short_number(col: Column | str) -> Column:
    """Six significant digits without trailing zeros, like C's %g."""
    return let(as_column(col), _short_number)


def _short_number(x: Column) -> Column:
    def trimmed(text: Column) -> Column:
        return F.regexp_replace(text, "\\.?0+$", "")

    size = F.abs(x)
    out = F.when((size < 1e6) & (x == F.floor(x)), x.cast("bigint").cast("string"))
    for digits in range(1, 6):
        out = out.when(
            size.between(1e-4, 10.0**digits), trimmed(F.format_string(f"%.{6 - digits}f", x))
        )
    out = out.when((size > 1e5) & (size < 999999.5), F.format_string("%.0f", x))
    power = F.floor(F.log10(size)).cast("int")
    sign = F.when(power < 0, "-").otherwise("+")
    digits = trimmed(F.format_string("%.5f", x / F.pow(F.lit(10.0), power.cast("double"))))
    return out.otherwise(
        F.concat(digits, F.lit("e"), sign, F.lpad(F.abs(power).cast("string"), 2, "0"))
    )

"""Turn loosely typed JSON values into numbers the way a browser-side `Number(x)` does."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from millpulse.functions.ids import strip_whitespace

# Fixed patterns: the text forms of a number that are accepted once white space around them is gone.
DECIMAL_TEXT = r"^([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[+-]?Infinity)$"
PREFIXED_TEXT = ((r"^0[xX]([0-9a-fA-F]+)$", 16), (r"^0[oO]([0-7]+)$", 8), (r"^0[bB]([01]+)$", 2))
ISO_TEXT = (
    r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[+-][0-9]{2}:?[0-9]{2})?)?$"
)
# Other common ways to write a date, each with the format that decides whether the day exists.
DATE_TEXT = (
    (r"^[A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4}$", "MMM d, yyyy"),
    (r"^[A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4} [0-9]{2}:[0-9]{2}$", "MMM d, yyyy HH:mm"),
    (r"^[A-Z][a-z]{2} [0-9]{1,2}, [0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}$", "MMM d, yyyy HH:mm:ss"),
    (r"^[0-9]{1,2} [A-Z][a-z]{2} [0-9]{4}$", "d MMM yyyy"),
    (r"^[0-9]{1,2} [A-Z][a-z]{2} [0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}$", "d MMM yyyy HH:mm:ss"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{2}:[0-9]{2}$", "M/d/yyyy HH:mm"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2}$", "M/d/yyyy HH:mm:ss"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2} [0-9]{2}:[0-9]{2}:[0-9]{2}$", "yyyy/M/d HH:mm:ss"),
)


def _from_digits(digits: Column, base: int) -> Column:
    """Any number of digits of a base as a double."""
    values = F.transform(F.array_remove(F.split(digits, ""), ""), lambda d: F.conv(d, base, 10).cast("double"))
    return F.aggregate(values, F.lit(0.0), lambda total, d: total * float(base) + d)


def number_from_text(text: Column) -> Column:
    """Blank text is 0; decimals, exponents and prefixed integers are read; anything else is NULL."""
    bare = strip_whitespace(text)
    prefixed = [F.when(bare.rlike(pattern), _from_digits(F.regexp_extract(bare, pattern, 1), base)) for pattern, base in PREFIXED_TEXT]
    return F.coalesce(
        F.regexp_extract(bare, DECIMAL_TEXT, 1).try_cast("double"),
        F.when(bare == "", F.lit(0.0)),
        F.when(bare.rlike("^0[xXoObB]"), F.coalesce(*prefixed)),
    )


def _number_or_text(value: Column, kind: Column) -> Column:
    """Numbers as they are, text by its rules, a NULL of JSON is 0."""
    return (
        F.when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.try_variant_get(value, "$", "double"))
        .when(kind == "STRING", number_from_text(F.try_variant_get(value, "$", "string")))
        .when(kind == "VOID", F.lit(0.0))
    )


def number_from_variant(value: Column) -> Column:
    """NULL means "not a number": the field is absent, an object, a longer array or unreadable text.

    An empty array is 0 and an array of one element is that element, except that a boolean in an array is no number.
    """
    kind = F.schema_of_variant(value)
    first = F.try_variant_get(value, "$[0]", "variant")
    element = F.when(first.isNull(), F.lit(0.0)).when(
        F.try_variant_get(value, "$[1]", "variant").isNull(), _number_or_text(first, F.schema_of_variant(first))
    )
    return (
        F.when(kind.startswith("ARRAY"), element)
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "double"))
        .otherwise(_number_or_text(value, kind))
    )


def finite(value: Column) -> Column:
    """Infinity has no JSON form, so it is stored as NULL."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def known_time(text: Column) -> Column:
    """True for text that names an instant: ISO forms, with T or a blank, and the common forms of DATE_TEXT."""
    other = [text.rlike(pattern) & F.try_to_timestamp(text, F.lit(fmt)).isNotNull() for pattern, fmt in DATE_TEXT]
    iso = text.rlike(ISO_TEXT) & F.try_to_timestamp(text).isNotNull()
    return F.coalesce(reduce(or_, other, iso), F.lit(False))


def two_decimals(value: Column) -> Column:
    """Text with two decimals as a browser shows it: the exact binary value is rounded, halves up.

    Built-in formatting rounds the shortest decimal text instead, which moves 79.725 (a little less
    than that in binary) up. The product with 100 is therefore split into its rounded value and the
    exact remainder.
    """
    size = F.abs(value)
    product = size * 100.0
    shifted = size * 134217729.0
    high = shifted - (shifted - size)
    remainder = (high * 100.0 - product) + (size - high) * 100.0
    guess = F.floor(product + 0.5).cast("double")
    below = (product - (guess - 0.5)) + remainder < 0
    above = (product - (guess + 0.5)) + remainder >= 0
    hundredths = F.when(below, guess - 1).when(above, guess + 1).otherwise(guess)
    return F.concat(F.when(value < 0, "-").otherwise(""), F.format_string("%.2f", hundredths / 100.0))

"""Column expressions that tidy machine ids and statuses."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def clean_machine_id(machine_id: Column) -> Column:
    """Upper case, only letters, digits and hyphens; NULL when nothing is left."""
    return F.nullif(F.regexp_replace(F.upper(F.trim(machine_id)), "[^A-Z0-9-]", ""), F.lit(""))


def clean_status(status: Column) -> Column:
    """Upper case, only letters and underscores; NULL when nothing is left."""
    return F.nullif(F.regexp_replace(F.upper(F.trim(status)), "[^A-Z_]", ""), F.lit(""))


def machine_key(machine_id: Column) -> Column:
    """The id without punctuation."""
    return F.regexp_replace(F.upper(machine_id), "[^A-Z0-9]", "")


def machine_num(machine_id: Column) -> Column:
    """The first run of digits in the id as a number, NULL when there is none."""
    return F.regexp_substr(F.upper(machine_id), F.lit("[0-9]+")).try_cast("decimal(38,0)")


# Fixed value: the characters that count as blank around a text.
BLANK = r"[\t\n\x0B\f\r \u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"


def strip_whitespace(text: Column) -> Column:
    """Trim every kind of white space, not only the ASCII ones."""
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")

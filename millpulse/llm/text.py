"""Column expressions for words, shared by the text operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_GAP_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z become a-z; every other character stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def crc_remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text modulo `modulus`; a NULL key counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))

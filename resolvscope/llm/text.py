"""Word splitting and column helpers that the corpus operators share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words after A-Z is lower-cased: every ASCII character but digits and a-z.
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# ASCII white space.
SPACE_BREAK = r"[\x20\x09-\x0D]+"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_KELVIN = "\u212a"


def safe_lower(text: Column) -> Column:
    """Lower case for matching ASCII words.

    Word breaks fall where lower-casing A-Z alone would put them. Only the Kelvin sign would turn into an ASCII letter, so it
    is replaced by another letter first; a word with letters beyond ASCII never equals a word without.
    """
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit("ĸ")))


def ascii_words(text: Column) -> Column:
    """Lower-cased words of a text as an array; null and empty texts have none."""
    return F.array_remove(F.split(safe_lower(text), WORD_BREAK), "")


def count_spaced(text: Column) -> Column:
    """Number of words between ASCII white space, as long; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_BREAK), "")).cast("long")


def lower_ascii(text: str | None) -> str:
    """Lower-case A-Z only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def digest(text: Column) -> Column:
    """64-bit digest by which rows with one id and different texts are told apart."""
    return F.xxhash64(text)


def unused(frame: DataFrame, name: str) -> str:
    """A column name made of ``name`` that the frame does not have, in any case of letters."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def put(frame: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column at the end; one of that name that the input has is replaced."""
    new = unused(frame, "new")
    return frame.withColumn(new, value).drop(name).withColumnRenamed(new, name)

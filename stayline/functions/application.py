"""Application numbers and decision texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The optional prefix and the length of a number.
PREFIX = "IRL"
DIGITS = 8

# The characters that count as white space.
WHITE_SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove all white space at both ends (``F.trim`` alone removes blanks only)."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def normalise_number(text: Column) -> Column:
    """`` irl12345678 `` -> ``12345678``."""
    return F.regexp_replace(F.upper(strip(text)), f"^{PREFIX}", "")


def as_integer(text: Column) -> Column:
    """The normalised number as BIGINT where it consists of digits only, else NULL."""
    number = normalise_number(text)
    return F.when(number.rlike(r"^[0-9]+$"), number.try_cast("bigint"))


def letters_in(text: Column) -> Column:
    """The distinct letters of a text, sorted, in one string."""
    letters = F.regexp_replace(F.upper(text), "[^A-Z]", "")
    return F.array_join(F.array_sort(F.array_distinct(F.split(letters, ""))), "")


def with_number_check(df: DataFrame, raw: str) -> DataFrame:
    """Add ok, error_code, error_msg and number: the first rule that fails names the error.

    The steps are separate projections, and the result leaves through a generator: a filter on ``ok`` then
    stays above it, where otherwise the optimizer would copy all the steps into the filter.
    """
    text, code = F.col("_text"), F.col("_code")
    prefixed, only_digits, size = F.col("_prefixed"), F.col("_only_digits"), F.length("_digits")
    message = (
        F.when(code == "not_alphanumeric", "no spaces or special characters allowed")
        .when(code == "letters_after_prefix", f"after {PREFIX} only digits are allowed")
        .when(code == "letters_at_end", F.concat(F.lit("letters at end: "), letters_in(text)))
        .when(code == "other_letters", F.concat(F.lit("unexpected letters: "), letters_in(text)))
        .when(code == "too_short", F.concat(F.lit("too short: "), size.cast("string"), F.lit(" digits")))
        .when(code == "too_long", F.concat(F.lit("too long: "), size.cast("string"), F.lit(" digits")))
        .otherwise("")
    )
    verdict = F.struct(
        code.isNull().alias("ok"),
        code.alias("error_code"),
        message.alias("error_msg"),
        F.when(code.isNull(), F.col("_digits")).otherwise("").alias("number"),
    )
    return (
        df.withColumn("_text", strip(F.coalesce(F.col(raw), F.lit(""))))
        .withColumn("_prefixed", F.upper(text).startswith(PREFIX))
        .withColumn("_digits", F.when(prefixed, F.substring(text, F.lit(len(PREFIX) + 1), F.length(text))).otherwise(text))
        .withColumn("_only_digits", F.col("_digits").rlike("^[0-9]+$"))
        .withColumn(
            "_code",
            F.when(text == "", "empty")
            .when(~text.rlike("^[A-Za-z0-9]+$"), "not_alphanumeric")
            .when(prefixed & ~only_digits, "letters_after_prefix")
            .when(~only_digits & text.rlike("[A-Za-z]$"), "letters_at_end")
            .when(~only_digits, "other_letters")
            .when(size < DIGITS, "too_short")
            .when(size > DIGITS, "too_long"),
        )
        .select(*df.columns, F.inline(F.array(verdict)))
    )


def decision_class(decision: Column) -> Column:
    text = F.lower(decision)
    return (
        F.when(text.contains("approv") | text.contains("grant"), "approved")
        .when(text.contains("refus") | text.contains("reject"), "refused")
        .otherwise("other")
    )

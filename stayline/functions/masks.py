"""Irreversible masks for personal fields. Every function takes and returns a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_name(name: Column) -> Column:
    """``Rahul Sharma`` -> ``R**** S*****``."""
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    hidden = F.transform(words, lambda w: F.rpad(F.left(w, F.lit(1)), F.length(w), "*"))
    return F.array_join(hidden, " ")


def mask_mobile(mobile: Column) -> Column:
    """``9876543210`` -> ``98XXXXXX10``; anything shorter than five characters is hidden entirely."""
    digits = F.trim(mobile)
    size = F.length(digits)
    partly = F.concat(F.left(digits, F.lit(2)), F.repeat(F.lit("X"), size - 4), F.right(digits, F.lit(2)))
    return F.when(size < 5, F.repeat(F.lit("X"), size)).otherwise(partly)


def mask_email(email: Column) -> Column:
    """``rahul@gmail.com`` -> ``r***@g***.com``; empty text or text without ``@`` is hidden entirely."""
    local = F.substring_index(email, "@", 1)
    domain = F.substring(email, F.length(local) + 2, F.length(email))
    host = F.substring_index(domain, ".", 1)
    suffix = F.substring(domain, F.length(host) + 2, F.length(domain))
    shown = F.concat(F.left(local, F.lit(1)), F.lit("***@"), F.left(host, F.lit(1)), F.lit("***."), suffix)
    return F.when(email.contains("@"), shown).otherwise(F.lit("***@***.***"))


def mask_address(address: Column) -> Column:
    """Drop everything before the first comma: ``12, MG Road, Mumbai`` -> ``**, MG Road, Mumbai``."""
    parts = F.transform(F.split(address, ","), lambda p: F.trim(p))
    kept = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.when(F.size(parts) >= 2, F.concat(F.lit("**, "), F.array_join(kept, ", "))).otherwise(F.lit("**"))


def birth_year(dob: Column) -> Column:
    """``15-07-1985`` -> ``1985``; text of another shape is returned as it is, missing text as ''."""
    parts = F.split(F.coalesce(dob, F.lit("")), "-")
    return F.when(F.size(parts) == 3, F.element_at(parts, -1)).otherwise(F.coalesce(dob, F.lit("")))

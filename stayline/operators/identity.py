"""Customer identity: exact de-duplication to a token, fallback joins and fuzzy names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_name(name: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(name, r"\s+", " ")))


def person_token(name: Column, mobile: Column, salt: str) -> Column:
    """Pseudonym of (name, mobile): a salted digest, computed per row without a lookup table."""
    return F.sha2(F.concat_ws("|", clean_name(name), F.trim(mobile), F.lit(salt)), 256)


def persons(vault: DataFrame, salt: str) -> DataFrame:
    """One row per person. Registrations are only counted, never gathered, so a person may have any number."""
    return (
        vault.select("cust_id", person_token(F.col("cust_name"), F.col("mobile_1"), salt).alias("person_token"))
        .groupBy("person_token")
        .agg(F.count("*").alias("registrations"), F.min("cust_id").alias("first_cust_id"))
    )


def tokenise(fact: DataFrame, vault: DataFrame, salt: str) -> DataFrame:
    """A fact with the person's token in place of the registration id."""
    tokens = vault.select("cust_id", person_token(F.col("cust_name"), F.col("mobile_1"), salt).alias("person_token"))
    return fact.join(tokens, "cust_id").drop("cust_id")


def match_vehicles(feed: DataFrame, vehicle: DataFrame, row_id: str) -> DataFrame:
    """Vehicle of each feed row by VIN, else by engine and registration number; ``match_kind`` tells which.

    A row without a usable key gets its own id as key, which matches nothing and spreads such rows evenly:
    missing VINs would otherwise all meet in one task.
    """
    own = F.concat(F.lit("~"), F.col(row_id))
    by_vin = vehicle.select(F.col("vin").alias("_vin"), F.col("vehicle_id").alias("_by_vin"))
    by_plate = vehicle.select(
        F.concat_ws("|", "engine_no", "reg_no").alias("_plate"), F.col("vehicle_id").alias("_by_plate")
    )
    plate = F.when(
        F.col("_by_vin").isNull() & F.col("engine_no").isNotNull() & F.col("reg_no").isNotNull(),
        F.concat_ws("|", "engine_no", "reg_no"),
    )
    return (
        feed.withColumn("_vin_key", F.coalesce("vin", own))
        .join(by_vin, F.col("_vin_key") == F.col("_vin"), "left")
        .withColumn("_plate_key", F.coalesce(plate, own))
        .join(by_plate, F.col("_plate_key") == F.col("_plate"), "left")
        .select(
            *feed.columns,
            F.coalesce("_by_vin", "_by_plate").alias("vehicle_id"),
            F.when(F.col("_by_vin").isNotNull(), "vin")
            .when(F.col("_by_plate").isNotNull(), "engine_reg")
            .otherwise("none")
            .alias("match_kind"),
        )
    )


def _one_shorter(text: Column) -> Column:
    """All strings that arise by leaving out one character."""
    places = F.sequence(F.lit(1), F.length(text))
    return F.transform(places, lambda i: F.concat(F.left(text, i - 1), F.substr(text, i + 1)))


def similar_names(people: DataFrame, name: str = "cust_name") -> DataFrame:
    """Pairs of distinct names at edit distance 1, each pair once in name order.

    Two names at distance 1 are equal after one character is left out of one or both. Names are therefore
    joined on themselves and on their one-shorter forms instead of within a block: the strings that share a
    one-shorter form are limited by alphabet and length, however many names there are, and copies of a
    name count once. No pair is lost.
    """
    names = people.select(clean_name(F.col(name)).alias("name")).where(F.col("name") != "").distinct()
    forms = names.select(
        "name", F.explode(F.array_distinct(F.array_append(_one_shorter(F.col("name")), F.col("name")))).alias("form")
    )
    left, right = forms.withColumnRenamed("name", "name_a"), forms.withColumnRenamed("name", "name_b")
    return (
        left.join(right, "form")
        .where(F.col("name_a") < F.col("name_b"))
        .where(F.levenshtein("name_a", "name_b") == 1)
        .select("name_a", "name_b")
        .distinct()
    )


def name_neighbours(people: DataFrame, name: str = "cust_name") -> DataFrame:
    """Per name: how many others are one edit away, and the first of them."""
    pairs = similar_names(people, name)
    ends = F.array(F.struct(F.col("name_a").alias("name"), F.col("name_b").alias("other")),
                   F.struct(F.col("name_b").alias("name"), F.col("name_a").alias("other")))
    return (
        pairs.select(F.inline(ends))
        .groupBy("name")
        .agg(F.count("*").alias("similar_names"), F.min("other").alias("first_similar"))
    )

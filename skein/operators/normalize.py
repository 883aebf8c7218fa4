"""Normalized records: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def normalize(records: DataFrame, fold: bool = True) -> DataFrame:
    """The contract columns of (entity_id, source, business_name, business_address, country). Without fold, accents stay and no Python runs; with it, only texts with separate marks or ligatures reach Python."""
    name, address = F.coalesce("business_name", F.lit("")), F.coalesce("business_address", F.lit(""))
    rows = records.select("entity_id", "source", "country", name.alias("name_raw"), address.alias("addr_raw"))
    own = T.without_country(F.col("name_raw"), F.col("country"))
    folded = (T.fold_accents(own), T.fold_accents(F.col("addr_raw"))) if fold else (own, F.col("addr_raw"))
    rows = rows.withColumn("_name", T.tokens(T.cleaned(folded[0]))).withColumn("_addr", T.canonical_address(folded[1]))
    rows = rows.withColumn("_core", T.core_tokens(F.col("_name"))).withColumn("_digits", T.digit_tokens(F.col("_addr")))
    initials = F.array_join(F.transform("_core", lambda t: F.substring(t, 1, 1)), "")
    return rows.select(
        "entity_id", "source", "country", "name_raw", "addr_raw",
        F.array_join("_core", " ").alias("name_core"),
        F.array_join(T.legal_tokens(F.col("_name")), " ").alias("name_legal"),
        F.array_join(F.array_sort("_core"), " ").alias("name_sorted"),
        initials.alias("name_acronym"),
        F.col("_addr").alias("addr_norm"),
        F.array_join("_digits", " ").alias("digits"),
        T.postal_of(F.col("_digits")).alias("postal"),
        F.coalesce(F.get("_digits", F.lit(0)), F.lit("")).alias("addr_first_num"),
        F.arrays_overlap(F.split("_addr", " "), F.array(*[F.lit(w) for w in T.LANDMARK_WORDS])).alias("landmark_flag"),
    )

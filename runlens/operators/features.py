"""Metrics of quantification features.

``features``: run_id, feature_id, charge, n_idents (peptide identifications).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.functions.exprs import bucket_counts, bucket_rows, ratio


def features_with_idents(features: DataFrame, idents: DataFrame) -> DataFrame:
    """Count the identifications of each feature from their own table."""
    counted = idents.groupBy("feature_id").agg(F.count(F.lit(1)).alias("n_idents"))
    return features.drop("n_idents").join(counted, "feature_id", "left").withColumn(
        "n_idents", F.coalesce("n_idents", F.lit(0)))


def identified_features(features: DataFrame, idents: DataFrame) -> DataFrame:
    """Features having an identification in the child table."""
    return features.join(idents.select("feature_id"), "feature_id", "left_semi")


def feature_counts(features: DataFrame) -> DataFrame:
    return features.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("nr_features"),
        F.count_if(F.col("n_idents") > 0).alias("nr_ident_features"))


def feature_charge_fractions(
    features: DataFrame, max_charge: int = 5, identified: bool = False
) -> DataFrame:
    """Share of features of charge 1 … ``max_charge`` and, as the next, above.

    Other charges count in the denominator only.  With ``identified`` both
    sides are limited to identified features; NULL if there is none.
    """
    keep = F.col("n_idents") > 0 if identified else F.lit(True)
    counts = bucket_counts(F.col("charge"), 1, max_charge + 1, keep=keep)
    per_run = features.groupBy("run_id").agg(
        F.count_if(keep).alias("n"), *[c.alias(f"b{b}") for b, c in counts.items()])
    rows = per_run.select("run_id", "n", bucket_rows(list(counts), "charge").alias("row"))
    return rows.select("run_id", "row.charge",
                       ratio(F.col("row.count"), F.col("n")).alias("fraction"))

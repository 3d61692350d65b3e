"""Metrics of peptide, protein and peptide-spectrum-match (PSM) tables.

``psms``: run_id, psm_id, sequence, accession, unique, retention_time, charge,
missed_cleavages, modifications, exp_mz, calc_mz, spectra_ref, fdr_score,
is_decoy, position (input order, any orderable type).  ``runs``, where
accepted, is a table of all run_ids: runs without a row then get the result of
an empty input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.functions.exprs import bucket_counts, bucket_rows, ratio
from runlens.plans.ordered import with_position
from runlens.plans.quantiles import exact_quantiles
from runlens.plans.tables import write_table

# The columns of a PSM kept after the decoy filter.
PSM_COLUMNS = [
    "psm_id", "sequence", "accession", "unique", "retention_time", "charge",
    "missed_cleavages", "modifications", "exp_mz", "calc_mz", "spectra_ref", "fdr_score",
]


def _with_runs(counted: DataFrame, runs: DataFrame | None, column: str) -> DataFrame:
    if runs is None:
        return counted
    joined = runs.select("run_id").distinct().join(counted, "run_id", "left")
    return joined.select("run_id", F.coalesce(column, F.lit(0)).alias(column))


def count_rows(df: DataFrame, name: str, runs: DataFrame | None = None) -> DataFrame:
    return _with_runs(df.groupBy("run_id").agg(F.count(F.lit(1)).alias(name)), runs, name)


def count_peptides(peptides: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    return count_rows(peptides, "nr_peptides", runs)


def count_protein_groups(proteins: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    return count_rows(proteins, "nr_protein_groups", runs)


def count_accessions(
    proteins: DataFrame, split_members: bool = False, runs: DataFrame | None = None
) -> DataFrame:
    """Distinct accessions of a run, members of the groups included.

    The member list counts as one text unless ``split_members`` is set.
    """
    column = "nr_accessions_split" if split_members else "nr_accessions"
    counted = accession_counts(proteins).select("run_id", F.col(column).alias("nr_accessions"))
    return _with_runs(counted, runs, "nr_accessions")


def accession_counts(proteins: DataFrame) -> DataFrame:
    """Both counts, ``nr_accessions`` and ``nr_accessions_split``, in one pass.

    A name is reduced to one row with the forms it was met in before names are counted.
    """
    none = F.array().cast("array<string>")
    parts = F.coalesce(F.transform(F.split("ambiguity_members", ","), lambda m: F.trim(m)), none)

    def named(names: Column, whole: bool, split: bool) -> Column:
        return F.transform(names, lambda n: F.struct(n.alias("name"), F.lit(whole).alias("whole"), F.lit(split).alias("split")))
    forms = F.concat(named(F.array("accession"), True, True), named(F.array("ambiguity_members"), True, False),
                     named(parts, False, True))
    names = proteins.select("run_id", F.explode(forms).alias("f")).select("run_id", "f.*").where(F.col("name").isNotNull())
    single = names.groupBy("run_id", "name").agg(F.bool_or("whole").alias("whole"), F.bool_or("split").alias("split"))
    return single.groupBy("run_id").agg(
        F.count_if("whole").alias("nr_accessions"), F.count_if("split").alias("nr_accessions_split"))


def filter_target_psms(psms: DataFrame) -> DataFrame:
    """Drop decoys and keep the reported columns (and the input position)."""
    return psms.where(F.col("is_decoy") == 0).select("run_id", *PSM_COLUMNS, "position")


def group_psm_accessions(psms: DataFrame) -> DataFrame:
    """Give every row all accessions of its PSM, joined in input order, and
    drop the duplicates this leaves; ``position`` is that of the first of equal rows.

    The rows of a PSM meet once, as one array; the joined text makes them one
    value of a row anyway.
    """
    keys = ["run_id", "psm_id"]
    rest = [c for c in PSM_COLUMNS if c not in ("psm_id", "accession")]
    entry = F.struct(F.struct(*rest).alias("row"), "position", "accession")
    grouped = psms.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("all"))
    in_order = F.array_sort(F.transform("all", lambda x: F.struct(x["position"], x["accession"])))
    joined = F.array_join(F.transform(in_order, lambda x: x["accession"]), ",")
    # Equal rows stand on end, the one of smallest position first.
    first = F.filter("all", lambda x, i: (i == 0) | ~x["row"].eqNullSafe(F.get(F.col("all"), i - 1)["row"]))
    one = grouped.select(*keys, joined.alias("accession"), F.explode(first).alias("x"))
    return one.select(*keys, "accession", "x.row.*", "x.position").select("run_id", *PSM_COLUMNS, "position")


def accepted_psms(psms: DataFrame, maximum: float = 0.01) -> DataFrame:
    """The rows of :func:`filter_fdr` after :func:`group_psm_accessions`, without
    accession and position: all that counts and errors need.

    The score limit comes first, so only accepted rows are made distinct.
    """
    return filter_fdr(psms, maximum).drop("accession", "position").distinct()


def filter_fdr(psms: DataFrame, maximum: float = 0.01) -> DataFrame:
    return psms.where(F.col("fdr_score") <= maximum)


def count_psms(psms: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    return count_rows(psms, "nr_psms", runs)


def ppm_error(psms: DataFrame) -> DataFrame:
    """Mass error in ppm; whole isotope steps are taken out first."""
    difference = F.col("exp_mz") - F.col("calc_mz")
    without_isotopes = difference - F.rint(difference)
    return psms.withColumn("ppm", ratio(without_isotopes * 1000000, F.col("calc_mz")))


def ppm_summary(psms: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Quartiles, mean and population deviation of the mass error per run.

    ``psms`` are the grouped and filtered ones.
    """
    errors = write_table(ppm_error(psms).select("run_id", "ppm"), "ppm")
    moments = errors.groupBy("run_id").agg(
        F.avg("ppm").alias("ppm_mean"), F.stddev_pop("ppm").alias("ppm_sigma"))
    quartiles = exact_quantiles(errors, ["run_id"], "ppm")
    both = quartiles.join(moments, "run_id").select(
        "run_id", F.col("q25").alias("ppm_q1"), F.col("q50").alias("ppm_q2"),
        F.col("q75").alias("ppm_q3"), "ppm_mean", "ppm_sigma")
    if runs is None:
        return both
    return runs.select("run_id").distinct().join(both, "run_id", "left")


def _bucket_table(psms: DataFrame, column: str, low: int, top: int, key: str,
                  runs: DataFrame | None) -> DataFrame:
    counts = bucket_counts(F.col(column), low, top)
    per_run = psms.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n"), *[c.alias(f"b{b}") for b, c in counts.items()])
    if runs is not None:
        per_run = runs.select("run_id").distinct().join(per_run, "run_id", "left").na.fill(0)
    in_buckets = sum((F.col(f"b{b}") for b in counts), F.lit(0))
    return per_run.withColumn("in_buckets", in_buckets).select(
        "run_id", "n", "in_buckets", bucket_rows(list(counts), key).alias("row")
    ).select("run_id", "n", "in_buckets", f"row.{key}", "row.count")


def psm_charge_fractions(psms: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Share of PSMs of charge 1 … 5 and, as 6, of all higher ones."""
    rows = _bucket_table(psms, "charge", 1, 6, "charge", runs)
    return rows.select("run_id", "charge",
                       (F.col("count") / F.greatest("n", F.lit(1)).cast("double")).alias("fraction"))


def missed_cleavage_fractions(psms: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Share of PSMs with 0 … 3 and, as 4, more missed cleavages.

    The denominator is the sum of the buckets; all zero stays zero.
    """
    rows = _bucket_table(psms, "missed_cleavages", 0, 4, "missed_cleavages", runs)
    return rows.select("run_id", "missed_cleavages", (
        F.col("count") / F.greatest("in_buckets", F.lit(1)).cast("double")).alias("fraction"))


def psm_full_table(psms: DataFrame) -> DataFrame:
    """All target PSMs before the score filter, numbered in input order (``row_no``), as reported when asked for."""
    order = ["position", "psm_id", *[c for c in PSM_COLUMNS if c != "psm_id"]]
    numbered = with_position(psms, ["run_id"], order)
    return numbered.withColumn("modifications", F.col("modifications").cast("string")).withColumnRenamed(
        "fdr_score", "psm_level_fdrscore").select(
        "run_id", F.col("pos").alias("row_no"), *[c for c in PSM_COLUMNS if c != "fdr_score"], "psm_level_fdrscore")

"""Text inputs as DataFrames.

Every reader takes one path, a list or a glob and keys its rows by ``run_id``,
the file name up to the first dot.  Those of mzTab files also take the lines
that :func:`scan_mztab` has found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.plans.tables import attach, write_table

Paths = str | Sequence[str]

# Line tags (header, rows) of the sections of an mzTab file, and
# accessions of the PSM scores.
SECTIONS = {"proteins": ("PRH", "PRT"), "psms": ("PSH", "PSM")}
FDR_SCORE = "MS:1002355"
FDR_COLUMN = "search_engine_score[{}]"
EXPECT_SCORE = "MS:1002257"

# Columns read of the PSM and protein sections, and their names here.
PSM_CELLS = {
    "PSM_ID": "psm_id", "sequence": "sequence", "accession": "accession", "unique": "unique",
    "retention_time": "retention_time", "charge": "charge",
    "opt_global_missed_cleavages": "missed_cleavages", "modifications": "modifications",
    "exp_mass_to_charge": "exp_mz", "calc_mass_to_charge": "calc_mz", "spectra_ref": "spectra_ref",
    "opt_global_cv_MS:1002217_decoy_peptide": "is_decoy",
}
PSM_TYPES = {
    "unique": "int", "retention_time": "double", "charge": "int", "missed_cleavages": "int",
    "exp_mz": "double", "calc_mz": "double", "is_decoy": "int",
}

XIC_SCHEMA = (
    "Content array<struct<Meta: struct<MzStart: double, MzEnd: double, RtStart: double,"
    " RtEnd: double, Comment: string>, RetentionTimes: array<double>, Intensities: array<double>>>")
QUERY_COLUMNS = ("comment", "mz", "tolerance", "tolerance_unit", "rt_start", "rt_end")
QUERY_SCHEMA = (
    "comment string, mz double, tolerance double, tolerance_unit string, rt_start double, rt_end double")


def _run_id(file: Column | None = None) -> Column:
    """The ``run_id=`` folder of a file's path, else the file's name up to its first dot."""
    file = F.col("_metadata.file_path") if file is None else file
    folder = F.regexp_extract(file, r"/run_id=([^/]+)/", 1)
    # The path is escaped once as a folder name and once as an address.
    for _ in range(2):
        folder = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    return F.when(folder != "", folder).otherwise(F.substring_index(F.element_at(F.split(file, "/"), -1), ".", 1))


def _json_objects(spark: SparkSession, paths: Paths, schema: str) -> DataFrame:
    """``file`` and the fields of every object of JSON documents and of JSON lines.

    A file whose lines are all whole objects is one of JSON lines.
    """
    fields = T.StructType.fromDDL(schema).fieldNames()
    file = F.col("_metadata.file_path").alias("file")
    text = spark.read.text(paths).select(file, F.trim("value").alias("value")).where(F.col("value") != "")
    whole_line = F.col("value").startswith("{") & F.col("value").endswith("}")
    in_lines = text.groupBy("file").agg(F.min(whole_line).alias("lines")).where("lines").select("file")
    by_line = text.join(in_lines, "file", "left_semi").select("file", F.from_json("value", schema).alias("o"))
    documents = spark.read.json(paths, schema=schema, multiLine=True).select(file, *fields)
    return documents.join(in_lines, "file", "left_anti").unionByName(by_line.select("file", *[f"o.{f}" for f in fields]))


def _position() -> Column:
    """Grows through each file, also if it is read in several pieces."""
    return F.struct(F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row")).alias("position")


def _lines(spark: SparkSession, paths: Paths) -> DataFrame:
    return spark.read.text(paths).select(_run_id().alias("run_id"), _position(), "value")


def scan_mztab(spark: SparkSession, paths: Paths) -> DataFrame:
    """The lines of all sections (run_id, tag, position, value).

    Metadata and header lines, few and read more than once, are stored by one
    reading of the texts; rows come from the texts when their section is asked
    for, so no copy of them is made.  The readers below take the result in place of paths.
    """
    lines = _lines(spark, paths).withColumn("tag", F.substring_index("value", "\t", 1)).where(F.contains("value", F.lit("\t")))
    heads = ["MTD", *[head for head, _ in SECTIONS.values()]]
    found = write_table(lines.where(F.col("tag").isin(*heads)), "mztab")
    for _, tag in SECTIONS.values():
        # With a fixed tag a section that is not asked for is not read.
        rows = lines.where(F.col("tag") == tag).withColumn("tag", F.lit(tag))
        found = found.unionByName(rows)
    return found


def _mztab(spark: SparkSession, source: Paths | DataFrame) -> DataFrame:
    return source if isinstance(source, DataFrame) else scan_mztab(spark, source)


def read_mztab_cells(spark: SparkSession, source: Paths | DataFrame, section: str) -> DataFrame:
    """Rows of a section as a map from column name to cell; ``null`` is NULL.

    The header line of each file names the columns; it is matched by its tag
    wherever it stands.
    """
    head_tag, row_tag = SECTIONS[section]
    lines = _mztab(spark, source)
    heads = lines.where(F.col("tag") == head_tag).groupBy("run_id").agg(
        F.min_by(F.split("value", "\t"), "position").alias("head"))
    rows = lines.where(F.col("tag") == row_tag)
    cells = F.transform(F.split("value", "\t"), lambda c: F.nullif(c, F.lit("null")))
    joined = attach(rows, heads, ["run_id"])
    return joined.select("run_id", "position", F.map_from_entries(
        F.slice(F.arrays_zip(F.col("head").alias("k"), cells.alias("v")), 2, F.size("head") - 1)).alias("cells"))


def read_mztab_metadata(spark: SparkSession, source: Paths | DataFrame) -> DataFrame:
    """Metadata lines as run_id, position, key, value."""
    parts = F.split("value", "\t")
    return _mztab(spark, source).where(F.col("tag") == "MTD").select(
        "run_id", "position", F.get(parts, F.lit(1)).alias("key"), F.get(parts, F.lit(2)).alias("value"))


def mztab_score_column(
    metadata: DataFrame, accession: str = FDR_SCORE, search_engine_only: bool = False
) -> DataFrame:
    """Name of the PSM column holding a score, per run.

    The last metadata line naming the accession counts; its key loses the
    leading ``psm_``.
    """
    naming = metadata.where(F.contains("value", F.lit(accession)))
    if search_engine_only:
        naming = naming.where(F.startswith("key", F.lit("psm_search_engine_score")))
    last = naming.groupBy("run_id").agg(F.max_by("key", "position").alias("key"))
    return last.select("run_id", F.substring("key", 5, 1 << 30).alias("score_column"))


def read_psms(spark: SparkSession, source: Paths | DataFrame) -> DataFrame:
    """PSMs with their FDR score, in the layout of ``operators.identifications``."""
    lines = _mztab(spark, source)
    cells = read_mztab_cells(spark, lines, "psms")
    scores = mztab_score_column(read_mztab_metadata(spark, lines))
    scored = attach(cells, scores, ["run_id"])
    columns = [F.try_element_at("cells", F.lit(c)).cast(PSM_TYPES.get(n, "string")).alias(n)
               for c, n in PSM_CELLS.items()]
    fdr = F.try_element_at("cells", F.col("score_column")).cast("double").alias("fdr_score")
    return scored.select("run_id", *columns, fdr, "position")


def read_target_psms(spark: SparkSession, source: Paths | DataFrame, accession: str = EXPECT_SCORE) -> DataFrame:
    """run_id, sequence, retention_time, charge, exp_mz, score of every PSM.

    A run without the score gets -1, below any limit, so that it is not filtered.
    """
    lines = _mztab(spark, source)
    cells = read_mztab_cells(spark, lines, "psms")
    scores = mztab_score_column(read_mztab_metadata(spark, lines), accession, search_engine_only=True)
    scored = attach(cells, scores, ["run_id"], "left")
    cell = {c: F.try_element_at("cells", F.lit(c)) for c in
            ("sequence", "retention_time", "charge", "exp_mass_to_charge")}
    score = F.try_element_at("cells", F.col("score_column")).cast("double")
    return scored.select(
        "run_id", cell["sequence"].alias("sequence"),
        cell["retention_time"].cast("double").alias("retention_time"),
        cell["charge"].cast("int").alias("charge"),
        cell["exp_mass_to_charge"].cast("double").alias("exp_mz"),
        F.when(F.col("score_column").isNull(), -1.0).otherwise(score).alias("score"), "position")


def read_run_names(spark: SparkSession, source: Paths | DataFrame) -> DataFrame:
    """Location of the first MS run as the metadata gives it."""
    metadata = read_mztab_metadata(spark, source)
    named = metadata.where(F.contains("key", F.lit("ms_run[1]-location")))
    return named.groupBy("run_id").agg(F.max_by("value", "position").alias("run_name"))


def read_proteins(spark: SparkSession, source: Paths | DataFrame) -> DataFrame:
    cells = read_mztab_cells(spark, source, "proteins")
    return cells.select("run_id", *[F.try_element_at("cells", F.lit(c)).alias(c)
                                    for c in ("accession", "ambiguity_members")])


def read_peptide_export(spark: SparkSession, paths: Paths) -> DataFrame:
    """Peptide lines of the comma-separated export, without their header.

    A cell in quotes may hold commas; two quotes in it are one.
    """
    lines = _lines(spark, paths).where(F.startswith("value", F.lit("PEPTIDE")))
    raw = F.regexp_extract_all("value", F.lit(r'(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    inside = lambda c: F.replace(F.substring(c, 2, F.length(c) - 2), F.lit('""'), F.lit('"'))
    cells = F.transform(raw, lambda c: F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), inside(c)).otherwise(c))
    return lines.select("run_id", cells.alias("cells"))


def read_spikeins(spark: SparkSession, paths: Paths) -> DataFrame:
    """Spike-in list; columns are found by name in any order."""
    rows = spark.read.csv(paths, header=True)
    return rows.select(
        _run_id().alias("run_id"), "name", "sequence", F.col("mz").cast("double").alias("mz"),
        F.col("RT").cast("double").alias("rt"), F.col("`mz-tol`").alias("mz_tol"),
        F.col("`rt-tol`").cast("double").alias("rt_tol"), _position())


def read_ident_counts(spark: SparkSession, paths: Paths) -> DataFrame:
    """Headerless ``sequence,count``; the last of equal sequences wins."""
    rows = spark.read.csv(paths, schema="sequence string, count bigint").select(
        _run_id().alias("run_id"), "sequence", "count", _position())
    return rows.groupBy("run_id", "sequence").agg(F.max_by("count", "position").alias("count"))


def read_xic_results(spark: SparkSession, paths: Paths) -> DataFrame:
    """One row per extracted ion chromatogram; its arrays may be NULL."""
    files = _json_objects(spark, paths, XIC_SCHEMA)
    rows = files.select(_run_id(F.col("file")).alias("run_id"), F.posexplode("Content").alias("position", "x"))
    return rows.select(
        "run_id", "position", F.col("x.Meta.Comment").alias("comment"),
        F.col("x.Meta.MzStart").alias("mz_start"), F.col("x.Meta.MzEnd").alias("mz_end"),
        F.col("x.Meta.RtStart").alias("rt_start"), F.col("x.Meta.RtEnd").alias("rt_end"),
        F.col("x.RetentionTimes").alias("retention_times"), F.col("x.Intensities").alias("intensities"))


def read_xic_queries(spark: SparkSession, paths: Paths) -> DataFrame:
    """Queries from a JSON array or from JSON lines."""
    rows = _json_objects(spark, paths, QUERY_SCHEMA)
    return rows.select(_run_id(F.col("file")).alias("run_id"), *QUERY_COLUMNS)

"""Outputs.  Every writer takes a folder; runs and parts are written in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.operators.documents import document_parts, finite, write_documents
from runlens.operators.records import mzqc_lines
from runlens.operators.reports import Report
from runlens.sources.readers import QUERY_COLUMNS


def _order(df: DataFrame, columns: list[str]) -> list[str]:
    """The given position, if there is one, and ``columns``."""
    return (["position"] if "position" in df.columns else []) + columns


def write_xic_queries(queries: DataFrame, path: str, runs: DataFrame | None = None) -> None:
    """One JSON array of query objects for each run, in order of ``position`` or of the columns.

    ``runs`` adds an empty array for runs without a query.
    """
    order = _order(queries, list(QUERY_COLUMNS))
    line = F.to_json(F.struct(*QUERY_COLUMNS), {"ignoreNullFields": "false"})
    lines = queries.select("run_id", *order, line.alias("line"))
    write_documents(document_parts(lines, order, "[\n", "\n]", ",", runs), path)


def write_xic_results(xics: DataFrame, path: str, runs: DataFrame | None = None) -> None:
    """One JSON document for each run: a header and the chromatograms in order of ``position`` or of the query.

    ``runs`` adds a document without content for runs without a chromatogram.
    """
    meta = F.struct(
        F.col("mz_start").alias("MzStart"), F.col("mz_end").alias("MzEnd"),
        F.col("rt_start").alias("RtStart"), F.col("rt_end").alias("RtEnd"),
        F.col("comment").alias("Comment"))
    entry = F.struct(meta.alias("Meta"), F.transform("retention_times", finite).alias("RetentionTimes"),
                     F.transform("intensities", finite).alias("Intensities"))
    order = _order(xics, ["comment", "mz_start", "rt_start"])
    lines = xics.select("run_id", *order, F.to_json(entry, {"ignoreNullFields": "false"}).alias("line"))
    head = '{"OutputMeta": {"base64": false, "timeunit": "minutes"}, "Content": [\n'
    write_documents(document_parts(lines, order, head, "\n]}", ",", runs), path)


def write_ident_counts(counts: DataFrame, path: str) -> None:
    """Headerless ``sequence,count``, one folder per run."""
    counts.select("run_id", "sequence", "count").write.partitionBy("run_id").csv(path)


def write_summary(table: DataFrame, path: str, fmt: str = "csv") -> None:
    if fmt not in ("csv", "tsv"):
        raise ValueError(f"unknown table format: {fmt!r}")
    table.write.option("header", True).option("sep", "," if fmt == "csv" else "\t").csv(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metric records or metric tables as Parquet, one folder per run."""
    metrics.write.partitionBy("run_id").parquet(path)


def write_report(report: Report, path: str) -> None:
    """Folders ``metrics``, ``tables`` and one for each long table, as Parquet by run."""
    write_metrics(report.metrics, f"{path}/metrics")
    write_metrics(report.tables, f"{path}/tables")
    for name, series in report.series.items():
        write_metrics(series.table, f"{path}/{name}")


def write_mzqc(metrics: DataFrame, metric_tables: DataFrame, path: str, created: str) -> None:
    """One JSON document for each run."""
    order = ["section", "metric", "column_no", "row_no"]
    write_documents(document_parts(mzqc_lines(metrics, metric_tables, created), order), path)

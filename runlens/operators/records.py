"""From per-run results to metric records, and the JSON export of a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runlens.functions.exprs import epoch_to_utc
from runlens.plans.ordered import with_position
from runlens.plans.tables import attach
from runlens.schemas import METRICS, Metric

# Which keys are exported, and what a column name must look like.
EXPORTED_KEY = r"^(MS:[A-Z0-9]+).*$"
EXPORTED_ACCESSION = r"^MS"
COLUMN_ACCESSION = r"^[A-Z0-9]+:[A-Z0-9]+$"

# Header of the exported document.
DOCUMENT_VERSION = "1.0.0"
FILE_FORMAT = {"accession": "MS:1000563", "name": "Thermo RAW format"}
START_TIME_PROPERTY = {"accession": "MS:1002435", "name": "data processing start time"}
SOFTWARE = {
    "accession": "MS:1002251", "name": "Comet",
    "description": "Comet open-source sequence search engine developed at the University of Washington.",
    "version": "v2024.01.0", "uri": "https://uwpr.github.io/Comet/",
}
VOCABULARY = {
    "name": "Proteomics Standards Initiative Mass Spectrometry Ontology",
    "uri": "https://github.com/HUPO-PSI/psi-ms-CV/blob/master/psi-ms.obo",
    "version": "4.1.197",
}


# Sorts behind every row of a column.
LAST_ROW = 2 ** 62


class TableColumn(NamedTuple):
    source: str
    accession: str
    name: str


def _attributes(short_name: str, metric: Metric) -> list[Column]:
    return [F.lit(metric.accession).alias("accession"), F.lit(short_name).alias("short_name"),
            F.lit(metric.name).alias("name"), F.lit(metric.description).alias("description"),
            F.lit(metric.unit_accession).alias("unit_accession"),
            F.lit(metric.unit_name).alias("unit_name")]


def _value(df: DataFrame, column: str) -> list[Column]:
    kind = df.schema[column].dataType
    number = F.lit(None).cast("double")
    array = F.lit(None).cast("array<double>")
    text = F.lit(None).cast("string")
    label = "scalar"
    if isinstance(kind, T.ArrayType):
        array, label = F.col(column).cast("array<double>"), "array"
    elif isinstance(kind, T.StringType):
        text = F.col(column)
    else:
        number = F.col(column).cast("double")
    return [F.lit(label).alias("kind"), number.alias("value_num"),
            array.alias("value_arr"), text.alias("value_str")]


def metric_records(
    df: DataFrame, columns: Mapping[str, str], registry: Mapping[str, Metric] = METRICS
) -> DataFrame:
    """Rows of ``metrics`` from a per-run table; ``columns`` maps a column of
    ``df`` to the short name of the metric it holds."""
    rows = F.array(*[F.struct(*_attributes(short, registry[short]), *_value(df, column))
                     for column, short in columns.items()])
    return df.select("run_id", F.explode(rows).alias("m")).select("run_id", "m.*")


def metric_table(
    df: DataFrame, short_name: str, columns: Sequence[TableColumn],
    row_no: str | None = None, order: Sequence[str] = (),
    registry: Mapping[str, Metric] = METRICS,
) -> DataFrame:
    """Rows of ``metric_tables``, one per cell.

    The row number is taken from a column, or counted in ``order``.
    """
    numbered = df if row_no else with_position(df, ["run_id"], list(order))
    number = F.col(row_no or "pos").cast("bigint").alias("row_no")
    cells = []
    for c in columns:
        is_text = isinstance(df.schema[c.source].dataType, T.StringType)
        value, none = F.col(c.source), F.lit(None)
        cells.append(F.struct(
            F.lit(c.accession).alias("column_accession"), F.lit(c.name).alias("column_name"),
            (none if is_text else value).cast("double").alias("value_num"),
            (value if is_text else none).cast("string").alias("value_str")))
    return numbered.select(
        "run_id", F.lit(registry[short_name].accession).alias("accession"),
        F.lit(short_name).alias("short_name"), number,
        F.posexplode(F.array(*cells)).alias("column_no", "cell"),
    ).select("run_id", "accession", "short_name", "row_no", "column_no", "cell.*")


def peptide_identifications(
    psms: DataFrame, run_names: DataFrame | None = None, score: str = "score"
) -> DataFrame:
    """One identification with one hit per PSM.

    ``run_names``: run_id, run_name from the file's metadata; ``unknown`` if
    there is none.
    """
    rows = psms.withColumn("run_name", F.lit("unknown"))
    if run_names is not None:
        named = run_names.select("run_id", F.col("run_name").alias("given"))
        rows = psms.join(named, "run_id", "left").withColumn(
            "run_name", F.coalesce("given", F.lit("unknown")))
    hit = F.struct(F.col(score).cast("double").alias("score"), F.lit(1).alias("rank"),
                   F.col("charge").cast("int").alias("charge"), "sequence")
    return rows.select(
        "run_id", F.col("run_name").alias("identifier"),
        F.col("retention_time").alias("rt"), F.col("exp_mz").alias("mz"),
        F.lit("q-value").alias("score_type"), F.lit(False).alias("higher_score_better"),
        F.array(hit).alias("hits"))


def exported_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics that go to the document: those keyed by a PSI-MS accession."""
    key = F.concat_ws(" ! ", "accession", "short_name")
    return metrics.where(key.rlike(EXPORTED_KEY) & F.col("accession").rlike(EXPORTED_ACCESSION))


def _json(record: Mapping[str, str]) -> Column:
    return F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in record.items()]))


def _text(column: str) -> Column:
    """A string column as a quoted JSON text."""
    quoted = F.regexp_extract(F.to_json(F.array(column)), r"(?s)^\[(.*)\]$", 1)
    return F.when(F.col(column).isNotNull(), quoted)


def _number(value: Column) -> Column:
    valid = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    whole = (F.abs(value) < 2.0 ** 53) & (value == F.rint(value))
    return F.when(valid & whole, value.cast("bigint").cast("string")).when(
        valid, value.cast("string")).otherwise("null")


def _line(df: DataFrame, section: int, line: Column, metric: Column | str = "",
          column_no: Column | int = -1, row_no: Column | int = -1) -> DataFrame:
    """One line of text with its place in the document of its run."""
    def column(value):
        return value if isinstance(value, Column) else F.lit(value)
    return df.select(
        "run_id", F.lit(section).alias("section"), column(metric).alias("metric"),
        column(column_no).cast("int").alias("column_no"), column(row_no).cast("bigint").alias("row_no"),
        line.alias("line"))


def _comma_unless(first: Column) -> Column:
    return F.when(first, "").otherwise(",")


def _frame_lines(metrics: DataFrame, metric_tables: DataFrame, created: str) -> list[DataFrame]:
    """First and last line of each run's document."""
    starts = metrics.where(F.col("short_name") == "startTime").groupBy("run_id").agg(
        F.max("value_num").alias("start"))
    runs = metrics.select("run_id").unionByName(metric_tables.select("run_id")).distinct()
    started = F.date_format(epoch_to_utc(F.col("start")), "yyyy-MM-dd HH:mm:ss")
    start_property = F.when(F.col("start") > 0, F.to_json(F.struct(
        *[F.lit(v).alias(k) for k, v in START_TIME_PROPERTY.items()], started.alias("value"))))
    header = F.concat(
        F.lit('{"mzQC":{"version":"' + DOCUMENT_VERSION + '","creationDate":'), _text("created"),
        F.lit(',"runQualities":[{"metadata":{"inputFiles":[{"name":'), _text("run_id"),
        F.lit(',"location":null,"fileFormat":'), _json(FILE_FORMAT),
        F.lit(',"fileProperties":['), F.coalesce(start_property, F.lit("")),
        F.lit(']}],"analysisSoftware":['), _json(SOFTWARE), F.lit(']},"qualityMetrics":['))
    footer = F.concat(F.lit(']}],"setQualities":[],"controlledVocabularies":['),
                      _json(VOCABULARY), F.lit("]}}"))
    documents = runs.join(starts, "run_id", "left").withColumn("created", F.lit(created))
    return [_line(documents, 0, header), _line(documents, 2, footer)]


def mzqc_lines(
    metrics: DataFrame, metric_tables: DataFrame, created: str, registry: Mapping[str, Metric] = METRICS
) -> DataFrame:
    """The JSON document of each run as ordered lines of text.

    A series of a run can be long, so a document is never built as one value:
    every table cell is a line of its own, and lines are joined to parts on
    writing (``sources.sinks.write_mzqc``).  A table is written only if all its
    columns carry an accession, else its value is null.  Output: run_id,
    section, metric, column_no, row_no, line.
    """
    key = F.concat_ws(" ! ", "accession", "short_name")
    names = F.create_map(*[F.lit(x) for short, m in registry.items() for x in (short, m.name)])
    single = exported_metrics(metrics).withColumn("metric", key)
    cells = exported_metrics(metric_tables).withColumns({
        "metric": key, "name": F.coalesce(F.element_at(names, F.col("short_name")), "short_name")})

    columns = cells.groupBy("run_id", "metric", "accession", "name", "column_no").agg(
        F.max("column_accession").alias("column_accession"))
    has_accession = F.coalesce(F.col("column_accession").rlike(COLUMN_ACCESSION), F.lit(False))
    tables = columns.groupBy("run_id", "metric", "accession", "name").agg(
        F.bool_and(has_accession).alias("named"), F.max("column_no").alias("last_column"))

    first = single.select("run_id", "metric").unionByName(tables.select("run_id", "metric")).groupBy(
        "run_id").agg(F.min("metric").alias("first_metric"))
    head = F.concat(_comma_unless(F.col("metric") == F.col("first_metric")), F.lit('{"accession":'),
                    _text("accession"), F.lit(',"name":'), _text("name"), F.lit(',"value":'))
    unit = F.when(F.length("unit_accession") > 0, F.concat(
        F.lit(',"unit":'), F.to_json(F.struct("unit_accession", "unit_name")))).otherwise("")
    array = F.concat(F.lit("["), F.array_join(F.transform("value_arr", _number), ","), F.lit("]"))
    value = F.when(
        F.col("value_arr").isNull(), F.coalesce(_text("value_str"), _number(F.col("value_num")))
    ).when(F.size("value_arr") == 1, _number(F.get(F.col("value_arr"), F.lit(0)))).otherwise(array)

    metric, number = F.col("metric"), F.col("column_no")
    named_columns = columns.join(tables.where("named").select("run_id", "metric"), ["run_id", "metric"])
    unnamed = tables.where(~F.col("named")).select("run_id", "metric")
    shown = attach(cells, unnamed, ["run_id", "metric"], "left_anti")
    parts = [
        *_frame_lines(metrics, metric_tables, created),
        _line(single.join(first, "run_id"), 1, F.concat(head, value, unit, F.lit("}")), metric),
        _line(tables.join(first, "run_id"), 1,
              F.concat(head, F.when(F.col("named"), "{").otherwise("null}")), metric),
        _line(named_columns, 1, F.concat(
            _comma_unless(number == 0), _text("column_accession"), F.lit(":[")), metric, number),
        _line(shown, 1, F.concat(
            _comma_unless(F.col("row_no") == 0), F.coalesce(_text("value_str"), _number(F.col("value_num")))),
            metric, number, F.col("row_no")),
        _line(named_columns, 1, F.lit("]"), metric, number, LAST_ROW),
        _line(tables.where("named"), 1, F.lit("}}"), metric, F.col("last_column") + 1),
    ]
    return reduce(DataFrame.unionByName, parts)

"""The given tables read as domain tables.

Runs are eight groups of customers or users, so each holds a fixed share of
the rows however large the data is.  Nothing is filtered away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS = 8
FIRST_DAY = "1995-01-01"
FIRST_INSTANT = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(key: str) -> Column:
    return (F.col(key) % RUNS).cast("string")


def _day(column: str = "o_orderdate") -> Column:
    return F.datediff(F.col(column), F.lit(FIRST_DAY).cast("date"))


def spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders: day as RT, status as MS level, priority as precursor charge.

    ``scan_no`` orders by day, then by order key.
    """
    charge = F.substring("o_orderpriority", 1, 1).cast("int")
    charge = F.when(charge == 4, 0).otherwise(charge)
    precursor = F.struct(charge.alias("charge"), F.col("o_totalprice").alias("mz"))
    double = (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_totalprice") < 50000)
    level = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    return table(spark, sf_dir, "orders").select(
        _run("o_custkey").alias("run_id"),
        F.col("o_orderkey").alias("spectrum_id"),
        (F.shiftleft(_day().cast("bigint"), 40) + F.col("o_orderkey")).alias("scan_no"),
        level.alias("ms_level"),
        _day().cast("double").alias("rt"),
        F.when(double, F.array(precursor, precursor)).otherwise(F.array(precursor)).alias("precursors"))


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("spectrum_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("mz"),
        F.col("l_quantity").alias("intensity"))


def nested_spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spectra that hold their peaks as an array."""
    nested = peaks(spark, sf_dir).groupBy("spectrum_id").agg(F.collect_list(F.struct("mz", "intensity")).alias("peaks"))
    return spectra(spark, sf_dir).join(nested, "spectrum_id", "left")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as acquisitions with a date and a time; some dates are malformed."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    date = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("unknown")).otherwise(text)
    time = F.when(F.col("o_orderstatus") == "P", F.lit("23:59:59")).otherwise("08:30:00")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), date.alias("date"), time.alias("time"))


def _letters(price: Column) -> Column:
    """Digits of a price as residue letters."""
    return F.translate((price * 10).cast("decimal(18,0)").cast("string"), "0123456789", "ACDEFGHIKL")


def psms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as matches: part as peptide, supplier as accession, discount
    as score, return flag R as decoy."""
    located = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), _run("o_custkey").alias("run_id"),
        _day().cast("double").alias("retention_time"))
    peptides = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_size", "p_brand", "p_retailprice",
        F.concat("p_type", _letters(F.col("p_retailprice"))).alias("sequence"))
    rows = table(spark, sf_dir, "lineitem").join(located, "l_orderkey").join(peptides, "l_partkey")
    calc = F.col("p_retailprice")
    return rows.select(
        "run_id", F.concat_ws("-", "l_orderkey", "l_linenumber").alias("psm_id"), "sequence",
        F.col("l_suppkey").cast("string").alias("accession"),
        (F.col("l_linenumber") % 2).alias("unique"), "retention_time",
        F.col("l_linenumber").alias("charge"), (F.col("p_size") % 6).alias("missed_cleavages"),
        F.col("p_brand").alias("modifications"),
        (calc + (F.col("l_linenumber") - 3) + F.col("l_tax") / 100).alias("exp_mz"),
        calc.alias("calc_mz"),
        F.concat(F.lit("ms_run[1]:index="), "l_orderkey").alias("spectra_ref"),
        F.col("l_discount").alias("fdr_score"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_decoy"),
        F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice").alias("position"))


def peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        (F.col("p_size") % RUNS).cast("string").alias("run_id"), F.col("p_name").alias("sequence"))


def proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers; two of three name their next two neighbours as group members."""
    def named(step: int) -> Column:
        return F.concat(F.lit("Supplier#"), F.lpad((F.col("s_suppkey") + step).cast("string"), 9, "0"))
    members = F.when(F.col("s_suppkey") % 3 != 0, F.concat_ws(",", named(1), named(2)))
    return table(spark, sf_dir, "supplier").select(
        _run("s_nationkey").alias("run_id"), F.col("s_name").alias("accession"),
        members.alias("ambiguity_members"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _run("c_custkey").alias("run_id"), F.col("c_custkey").alias("feature_id"),
        (F.col("c_nationkey") % 8).alias("charge"))


def feature_idents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as identifications of their customer's feature."""
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("feature_id"))


def spikeins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a target; parts of one type and price share a plain sequence."""
    targets = _targets(spark, sf_dir)
    name = F.concat(F.lit("SP"), _letters(F.col("mz")), F.lit("-"), F.col("position").cast("string"))
    return _as_spikeins(targets, name)


def spikein_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list the runs share: the first part of each brand in a run, under the brand's name."""
    targets = _targets(spark, sf_dir)
    first = targets.groupBy("run_id", "brand").agg(F.min_by(F.struct("mz", "kind", "position"), "position").alias("t"))
    return _as_spikeins(first.select("run_id", "brand", "t.*"), F.col("brand"))


def _targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _run("p_partkey").alias("run_id"), F.col("p_retailprice").alias("mz"), F.col("p_brand").alias("brand"),
        F.col("p_type").alias("kind"), F.col("p_partkey").alias("position"))


def _as_spikeins(targets: DataFrame, name: Column) -> DataFrame:
    letters = _letters(F.col("mz"))
    return targets.select(
        "run_id", name.alias("name"),
        F.concat(F.lit("[Acetyl]-"), F.substring("kind", 1, 3), F.lit("[Oxidation]"),
                 F.substring("kind", 4, 100), letters, F.lit("/2")).alias("sequence"),
        "mz", F.round((F.col("mz") - 900) * 24, 1).alias("rt"),
        F.lit("200 ppm").alias("mz_tol"), F.lit(600.0).alias("rt_tol"), "position", "brand")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their run, seconds since the start and the number in props."""
    seconds = F.expr(
        f"CAST(CAST(ts - TIMESTAMP_NTZ'{FIRST_INSTANT}' AS INTERVAL SECOND) AS DECIMAL(20,6))")
    return table(spark, sf_dir, "events").select(
        _run("user_id").alias("run_id"), "event_id", "event_type", "value",
        seconds.cast("double").alias("rt"),
        F.get_json_object("props", "$.k").cast("int").alias("k"))


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 2).otherwise(3)
    return _events(spark, sf_dir).where(F.col("event_type") != "signup").select(
        "run_id", F.col("event_id").alias("scan_no"), "rt", level.alias("ms_level"))


def _two_headers(events: DataFrame, kept: list[str], first: str, second: str) -> DataFrame:
    pairs = F.array(
        F.struct(F.lit(first).alias("header"), F.col("value").alias("value")),
        F.struct(F.lit(second).alias("header"), F.col("k").cast("double").alias("value")))
    return events.select(*kept, F.explode(pairs).alias("p")).select(*[c.split(" AS ")[-1] for c in kept], "p.*")


def trailer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two headers a scan; every third scan has none."""
    rows = _events(spark, sf_dir).where((F.col("event_type") != "signup") & (F.col("event_id") % 3 != 0))
    return _two_headers(rows.withColumnRenamed("event_id", "scan_no"), ["run_id", "scan_no"],
                        "Ion Injection Time (ms)", "LM m/z-Correction (ppm)")


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups as log records of unlike headers, two of one wanted entry; two runs have no log."""
    rows = _events(spark, sf_dir).where((F.col("event_type") == "signup") & ~F.col("run_id").isin("3", "7"))

    def logged(header: str, value: Column) -> Column:
        return F.struct(F.lit(header).alias("header"), value.cast("double").alias("value"))
    value, number = F.col("value"), F.col("event_id")
    headers = F.array(
        logged("CPU core temp. (°C)", F.col("k")), logged("Fan speed", F.col("k")),
        logged("Ambient temp. (°C)", F.when(number % 2 == 0, value)),
        logged("Ambient temp. (°C) rear", F.when(number % 3 == 0, -value)))
    return rows.select("run_id", "rt", F.explode(headers).alias("h")).select("run_id", "rt", "h.*")


def tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest value of each event type as a tune header."""
    header = F.concat(F.lit("Vaporizer Temp. (-) "), "event_type")
    return _events(spark, sf_dir).groupBy("run_id", header.alias("header")).agg(F.max("value").alias("value"))


def _type_id() -> Column:
    return F.array_position(F.array(*map(F.lit, ("click", "error", "purchase", "signup", "view"))),
                            F.col("event_type"))


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("event_type") == "view", "Pump_Pressure bar").when(
        F.col("event_type") == "click", "NC_Pump_Pressure bar").otherwise(F.col("event_type"))
    return _events(spark, sf_dir).select(
        "run_id", _type_id().alias("trace_id"), label.alias("label"),
        F.col("rt").alias("x"), F.col("value").alias("y"))


def nation_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run list with more runs than the events have."""
    return table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 10).cast("string").alias("run_id"))


def _hour() -> Column:
    return F.floor(F.col("rt") / 3600)


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).groupBy(
        "run_id", _hour().alias("frame"), _type_id().alias("property_id")).agg(F.max("value").alias("value"))


def property_defs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        "run_id", _type_id().alias("id"), F.col("event_type").alias("name")).distinct()


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).groupBy("run_id", _hour().alias("id")).agg(
        F.min("rt").alias("time"), ((F.count(F.lit(1)) % 2) * 9).cast("int").alias("msms_type"),
        F.max("value").alias("Pressure"))


def tims_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        "run_id", _hour().cast("double").alias("rt"), (F.col("k") / 100.0).alias("mobility"),
        F.when(F.col("event_type").isin("view", "click"), 0).otherwise(1).alias("precursor_idx"),
        F.col("value").alias("mz"), F.floor("value").cast("double").alias("intensity"),
        F.col("event_id").alias("position"))


def embedding_features(spark: SparkSession, sf_dir: str, width: int = 64) -> DataFrame:
    """Embeddings as one run per vector with a column per dimension; a longer vector is an error."""
    whole = F.when(F.size("embedding") <= width, F.col("embedding")).otherwise(
        F.raise_error(F.lit(f"a vector has more than {width} components")))
    return table(spark, sf_dir, "embeddings").select("vec_id", whole.alias("embedding")).selectExpr(
        "CAST(vec_id AS STRING) AS run_id",
        *[f"CAST(get(embedding, {i}) AS DOUBLE) AS f{i + 1}" for i in range(width)])


def _trace_id() -> Column:
    return F.floor(F.col("doc_id") / 2)


def trace_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two documents a trace; a third of the traces are described as the pump's."""
    trace = _trace_id()
    description = F.when(trace % 3 == 1, "NC_Pump_Pressure").when(trace % 3 == 2, "Other_Trace").otherwise("Pump_Pressure bar")
    return table(spark, sf_dir, "documents").select(
        (trace % RUNS).cast("string").alias("run_id"), trace.alias("id"), description.alias("description")).distinct()


def trace_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes of a text as intensities and times; in every second trace the
    times have them twice, so that there are as many times as values."""
    data = F.encode("text", "UTF-8")
    return table(spark, sf_dir, "documents").select(
        (_trace_id() % RUNS).cast("string").alias("run_id"), _trace_id().alias("trace_id"),
        (F.col("doc_id") % 2).alias("chunk_no"),
        F.when(_trace_id() % 2 == 1, F.concat(data, data)).otherwise(data).alias("times"), data.alias("intensities"))

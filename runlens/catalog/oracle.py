"""SQL giving the same rows as the queries, for checking them."""

from __future__ import annotations

from runlens.schemas import METRICS

ORACLE: dict[str, str] = {}


def r(expression: str) -> str:
    return f"(round(CAST({expression} AS DOUBLE), 6) + 0.0)"


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


DAY = "date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))"
SPECTRA = f"""
spectra AS (
  SELECT CAST(o_custkey % 8 AS VARCHAR) AS run_id, o_orderkey AS spectrum_id,
         CAST({DAY} AS BIGINT) * 1099511627776 + o_orderkey AS scan_no,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS ms_level,
         CAST({DAY} AS DOUBLE) AS rt,
         CASE WHEN o_orderpriority LIKE '4%' THEN 0
              ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS charge,
         CASE WHEN o_orderpriority = '3-MEDIUM' AND o_totalprice < 50000 THEN 2 ELSE 1 END AS n_precursors,
         o_totalprice AS precursor_mz
  FROM orders)"""
PEAKS = """
peaks AS (
  SELECT l_orderkey AS spectrum_id, l_extendedprice / l_quantity AS mz, l_quantity AS intensity
  FROM lineitem)"""
SUMMARY = f"""{SPECTRA}, {PEAKS},
summary AS (
  SELECT s.run_id, s.scan_no, s.ms_level, s.rt, s.spectrum_id,
         coalesce(p.tic, 0.0) AS tic, coalesce(p.base_peak, 0.0) AS base_peak,
         CAST(coalesce(p.n_peaks, 0) AS BIGINT) AS n_peaks
  FROM spectra s LEFT JOIN (
    SELECT spectrum_id, sum(intensity) AS tic, max(intensity) AS base_peak, count(*) AS n_peaks
    FROM peaks GROUP BY spectrum_id) p USING (spectrum_id))"""
OVERVIEW = f"""{SUMMARY},
overview AS (
  SELECT run_id, count(*) FILTER (ms_level = 1) AS nr_ms1, count(*) FILTER (ms_level = 2) AS nr_ms2,
         coalesce(sum(tic) FILTER (ms_level = 1), 0.0) AS accumulated_ms1_tic,
         coalesce(sum(tic) FILTER (ms_level = 2), 0.0) AS accumulated_ms2_tic,
         arg_min(rt, scan_no) AS rt_first, arg_max(rt, scan_no) AS rt_last,
         max(base_peak) AS base_peak_max, max(tic) AS tic_max
  FROM summary GROUP BY run_id)"""

ORACLE["run_overview"] = f"""WITH {OVERVIEW}
SELECT run_id, nr_ms1, nr_ms2, {r('accumulated_ms1_tic')} AS accumulated_ms1_tic,
       {r('accumulated_ms2_tic')} AS accumulated_ms2_tic, rt_first, rt_last, base_peak_max, tic_max
FROM overview"""
ORACLE["spectrum_summary"] = f"""WITH {SUMMARY}
SELECT run_id, scan_no, ms_level, rt, tic, base_peak, n_peaks FROM summary"""
ORACLE["accumulated_tic"] = f"""WITH {OVERVIEW}
SELECT run_id, accumulated_ms1_tic AS ms1_tic, accumulated_ms2_tic AS ms2_tic FROM overview"""
ORACLE["spectrum_counts"] = f"""WITH {SPECTRA}
SELECT run_id, count(*) FILTER (ms_level = 1) AS nr_ms1, count(*) FILTER (ms_level = 2) AS nr_ms2
FROM spectra GROUP BY run_id"""
CHARGE_FRACTIONS = f"""{SPECTRA},
charges AS (
  SELECT run_id, CAST(b AS INTEGER) AS charge,
         count(*) FILTER (ms_level = 2 AND least(s.charge, 4) = b)::DOUBLE
           / count(*) FILTER (ms_level = 2) AS fraction
  FROM spectra s, range(0, 5) AS t(b) GROUP BY run_id, b)"""
ORACLE["precursor_charge_fractions"] = f"""WITH {CHARGE_FRACTIONS}
SELECT run_id, charge, {r('fraction')} AS fraction FROM charges"""
ORACLE["rt_range"] = f"""WITH {SPECTRA}
SELECT run_id, arg_min(rt, scan_no) AS rt_first, arg_max(rt, scan_no) AS rt_last
FROM spectra GROUP BY run_id"""
ORACLE["run_maxima"] = f"""WITH {OVERVIEW} SELECT run_id, base_peak_max, tic_max FROM overview"""
ORACLE["run_maxima_up_to"] = f"""WITH {SUMMARY}
SELECT run_id, max(base_peak) FILTER (rt <= 1200) AS base_peak_max, max(tic) FILTER (rt <= 1200) AS tic_max,
       0.0::DOUBLE AS start, 1200.0::DOUBLE AS duration
FROM summary GROUP BY run_id"""
ORACLE["tic_series"] = f"""WITH {SUMMARY}
SELECT run_id, scan_no, rt, tic, ms_level FROM summary WHERE ms_level IN (1, 2)"""
ORACLE["ion_map"] = f"""WITH {SUMMARY}
SELECT s.run_id, s.scan_no, s.rt, {r('p.mz')} AS mz, p.intensity, {r('log10(p.intensity)')} AS log_intensity
FROM summary s JOIN peaks p USING (spectrum_id)
JOIN (SELECT run_id, max(base_peak) AS top FROM summary GROUP BY run_id) m ON m.run_id = s.run_id
WHERE s.ms_level = 1 AND p.intensity >= m.top * 0.9::DOUBLE"""
ORACLE["precursor_check"] = f"""WITH {SPECTRA}
SELECT run_id, scan_no, rt, n_precursors, n_precursors = 1 AS valid,
       CASE WHEN n_precursors = 1 THEN precursor_mz END AS mz
FROM spectra WHERE ms_level = 2"""
ORACLE["precursor_violations"] = f"""WITH {SPECTRA}
SELECT run_id, scan_no, n_precursors FROM spectra WHERE ms_level = 2 AND n_precursors <> 1"""
ORACLE["rt_quantile_fractions"] = f"""WITH {SPECTRA},
ends AS (SELECT run_id, arg_max(rt, scan_no) - arg_min(rt, scan_no) AS d FROM spectra GROUP BY run_id),
q AS (SELECT run_id, ms_level, quantile_cont(rt, 0.25) AS a, quantile_cont(rt, 0.5) AS b,
             quantile_cont(rt, 0.75) AS c FROM spectra WHERE ms_level IN (1, 2) GROUP BY run_id, ms_level)
SELECT run_id, ms_level, {r('a / d')} AS q1, {r('(b - a) / d')} AS q2, {r('(c - b) / d')} AS q3,
       {r('(d - c) / d')} AS q4
FROM q JOIN ends USING (run_id)"""
ORACLE["tic_quantile_fractions"] = f"""WITH {SUMMARY},
ends AS (SELECT run_id, arg_max(rt, scan_no) - arg_min(rt, scan_no) AS d FROM summary GROUP BY run_id),
o AS (SELECT run_id, rt, row_number() OVER w AS k, count(*) OVER (PARTITION BY run_id) AS n,
             sum(tic) OVER (w ROWS UNBOUNDED PRECEDING) AS cum, lag(rt) OVER w AS prev
      FROM summary WHERE ms_level IN (1, 2)
      WINDOW w AS (PARTITION BY run_id ORDER BY rt, ms_level, scan_no)),
l AS (SELECT run_id, max(cum) FILTER (k = n - 1) AS total, min(rt) AS rt0, max(rt) AS rt_end FROM o GROUP BY run_id),
x AS (SELECT run_id, rt0, rt_end,
        min(k) FILTER (k < n AND cum / total >= 0.25) AS i25, min(k) FILTER (k < n AND cum / total >= 0.5) AS i50,
        min(k) FILTER (k < n AND cum / total >= 0.75) AS i75
      FROM o JOIN l USING (run_id) GROUP BY ALL)
SELECT x.run_id,
  {r('(coalesce(a.prev, rt0) - rt0) / d')} AS q1, {r('(coalesce(b.prev, rt0) - a.rt) / d')} AS q2,
  {r('(coalesce(c.prev, rt0) - b.rt) / d')} AS q3, {r('(rt_end - c.rt) / d')} AS q4
FROM x JOIN ends USING (run_id)
JOIN o a ON a.run_id = x.run_id AND a.k = i25 JOIN o b ON b.run_id = x.run_id AND b.k = i50
JOIN o c ON c.run_id = x.run_id AND c.k = i75"""
ORACLE["max_frequency"] = f"""WITH {SPECTRA},
c AS (SELECT run_id, ms_level, count(*) OVER (PARTITION BY run_id, ms_level ORDER BY rt
        RANGE BETWEEN CURRENT ROW AND 60 FOLLOWING) AS n FROM spectra WHERE ms_level IN (1, 2))
SELECT run_id, ms_level, {r('max(n) / 60.0')} AS freq_max FROM c GROUP BY run_id, ms_level"""
ORACLE["density_quantiles"] = f"""WITH {SUMMARY}
SELECT run_id, ms_level, CAST(floor(quantile_cont(n_peaks::DOUBLE, 0.25)) AS BIGINT) AS q25,
       CAST(floor(quantile_cont(n_peaks::DOUBLE, 0.5)) AS BIGINT) AS q50,
       CAST(floor(quantile_cont(n_peaks::DOUBLE, 0.75)) AS BIGINT) AS q75
FROM summary WHERE ms_level IN (1, 2) GROUP BY run_id, ms_level"""


def _log_ratios(source: str, value: str) -> str:
    return f"""SELECT run_id, {r('log2(b / a)')} AS q2, {r('log2(c / b)')} AS q3, {r('log2(m / c)')} AS q4
FROM (SELECT run_id, quantile_cont({value}, 0.25) AS a, quantile_cont({value}, 0.5) AS b,
             quantile_cont({value}, 0.75) AS c, max({value}) AS m FROM {source} GROUP BY run_id)"""


ORACLE["tic_change_ratios"] = f"""WITH {SUMMARY},
ch AS (SELECT run_id, abs(lag(tic) OVER (PARTITION BY run_id ORDER BY scan_no) - tic) AS change
       FROM summary WHERE ms_level = 1)
{_log_ratios('ch', 'change')}"""
ORACLE["tic_quantile_ratios"] = f"""WITH {SUMMARY},
ms1 AS (SELECT run_id, tic FROM summary WHERE ms_level = 1)
{_log_ratios('ms1', 'tic')}"""
ORACLE["run_start_time"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS run_id,
  CASE WHEN o_orderpriority = '5-LOW' THEN CAST(-1 AS BIGINT)
       ELSE CAST(epoch(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) AS BIGINT)
            + CASE WHEN o_orderstatus = 'P' THEN 86399 ELSE 30600 END END AS start_time
FROM orders"""

# ---- identifications -------------------------------------------------------

RUNS10 = "runs10 AS (SELECT DISTINCT CAST(c_nationkey % 10 AS VARCHAR) AS run_id FROM customer)"
LETTERS = "translate(CAST(CAST(round({} * 10) AS BIGINT) AS VARCHAR), '0123456789', 'ACDEFGHIKL')"
PSMS = f"""
psms AS (
  SELECT CAST(o_custkey % 8 AS VARCHAR) AS run_id, l_orderkey || '-' || l_linenumber AS psm_id,
    p_type || {LETTERS.format('p_retailprice')} AS sequence, CAST(l_suppkey AS VARCHAR) AS accession,
    l_linenumber % 2 AS "unique", CAST({DAY} AS DOUBLE) AS retention_time, l_linenumber AS charge,
    p_size % 6 AS missed_cleavages, p_brand AS modifications,
    p_retailprice + (l_linenumber - 3) + l_tax / 100 AS exp_mz, p_retailprice AS calc_mz,
    'ms_run[1]:index=' || l_orderkey AS spectra_ref, l_discount AS fdr_score,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_decoy,
    (l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, l_extendedprice) AS position
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey),
targets AS (SELECT * FROM psms WHERE is_decoy = 0),
grouped AS (
  SELECT DISTINCT t.* EXCLUDE (accession, position, is_decoy), a.accession
  FROM targets t JOIN (SELECT run_id, psm_id, string_agg(accession, ',' ORDER BY position) AS accession
                       FROM targets GROUP BY run_id, psm_id) a USING (run_id, psm_id)),
good AS (SELECT *, (exp_mz - calc_mz - round_even(exp_mz - calc_mz, 0)) * 1000000 / calc_mz AS ppm
         FROM grouped WHERE fdr_score <= 0.01::DOUBLE)"""
PSM_COLUMNS = f"""run_id, psm_id, sequence, accession, "unique", retention_time, charge, missed_cleavages,
  modifications, {r('exp_mz')} AS exp_mz, {r('calc_mz')} AS calc_mz, spectra_ref, {r('fdr_score')} AS"""

ORACLE["count_peptides"] = f"""WITH {RUNS10}
SELECT run_id, count(p_partkey) AS nr_peptides
FROM runs10 LEFT JOIN part ON CAST(p_size % 8 AS VARCHAR) = run_id GROUP BY run_id"""
ORACLE["count_protein_groups"] = f"""WITH {RUNS10}
SELECT run_id, count(s_suppkey) AS nr_protein_groups
FROM runs10 LEFT JOIN supplier ON CAST(s_nationkey % 8 AS VARCHAR) = run_id GROUP BY run_id"""
ORACLE["count_accessions"] = """WITH p AS (
  SELECT CAST(s_nationkey % 8 AS VARCHAR) AS run_id, s_name AS accession,
    CASE WHEN s_suppkey % 3 <> 0 THEN 'Supplier#' || lpad(CAST(s_suppkey + 1 AS VARCHAR), 9, '0')
      || ',' || 'Supplier#' || lpad(CAST(s_suppkey + 2 AS VARCHAR), 9, '0') END AS members
  FROM supplier),
w AS (SELECT run_id, accession AS a FROM p UNION SELECT run_id, members FROM p WHERE members IS NOT NULL),
s AS (SELECT run_id, accession AS a FROM p
      UNION SELECT run_id, unnest(string_split(members, ',')) FROM p WHERE members IS NOT NULL)
SELECT run_id, nr_accessions, nr_accessions_split
FROM (SELECT run_id, count(*) AS nr_accessions FROM w GROUP BY run_id)
JOIN (SELECT run_id, count(*) AS nr_accessions_split FROM s GROUP BY run_id) USING (run_id)"""
ORACLE["target_psms"] = f"WITH {PSMS} SELECT {PSM_COLUMNS} fdr_score FROM targets"
ORACLE["group_psm_accessions"] = f"WITH {PSMS} SELECT {PSM_COLUMNS} fdr_score FROM grouped"
ORACLE["psm_full_table"] = f"""WITH {PSMS},
placed AS (
  SELECT t.* EXCLUDE (accession, position, is_decoy), a.accession, min(position) AS position
  FROM targets t JOIN (SELECT run_id, psm_id, string_agg(accession, ',' ORDER BY position) AS accession
                       FROM targets GROUP BY run_id, psm_id) a USING (run_id, psm_id) GROUP BY ALL)
SELECT {PSM_COLUMNS} psm_level_fdrscore,
  row_number() OVER (PARTITION BY run_id ORDER BY position, psm_id) - 1 AS row_no FROM placed"""
ORACLE["count_psms"] = f"""WITH {PSMS}, {RUNS10}
SELECT run_id, count(psm_id) AS nr_psms FROM runs10 LEFT JOIN good USING (run_id) GROUP BY run_id"""
ORACLE["ppm_error"] = f"WITH {PSMS} SELECT run_id, psm_id, accession, {r('ppm')} AS ppm FROM good"
PPM = """ppm AS (SELECT run_id, quantile_cont(ppm, 0.25) AS a, quantile_cont(ppm, 0.5) AS b,
  quantile_cont(ppm, 0.75) AS c, avg(ppm) AS m, stddev_pop(ppm) AS s FROM good GROUP BY run_id)"""
ORACLE["ppm_summary"] = f"""WITH {PSMS}, {PPM}
SELECT run_id, {r('a')} AS ppm_q1, {r('b')} AS ppm_q2, {r('c')} AS ppm_q3, {r('m')} AS ppm_mean,
       {r('s')} AS ppm_sigma FROM ppm"""
ORACLE["box_summary"] = f"""WITH {PSMS}, {PPM}
SELECT run_id, {r('a')} AS q1, {r('b')} AS median, {r('c')} AS q3, {r('m')} AS mean, {r('s')} AS sd FROM ppm"""
ORACLE["psm_charge_fractions"] = f"""WITH {PSMS}, {RUNS10}
SELECT run_id, CAST(b AS INTEGER) AS charge,
  {r('count(*) FILTER (charge = b OR (b = 6 AND charge > 6))::DOUBLE / greatest(count(psm_id), 1)')} AS fraction
FROM runs10 LEFT JOIN good USING (run_id), range(1, 7) AS t(b) GROUP BY run_id, b"""
CLEAVAGES = """cleavages AS (
  SELECT run_id, CAST(b AS INTEGER) AS missed_cleavages,
    count(*) FILTER (missed_cleavages = b OR (b = 4 AND missed_cleavages > 4))::DOUBLE
      / greatest(count(*) FILTER (missed_cleavages >= 0), 1) AS fraction
  FROM {runs} LEFT JOIN good USING (run_id), range(0, 5) AS t(b) GROUP BY run_id, b)"""
ORACLE["missed_cleavage_fractions"] = f"""WITH {PSMS}, {RUNS10}, {CLEAVAGES.format(runs='runs10')}
SELECT run_id, missed_cleavages, {r('fraction')} AS fraction FROM cleavages"""
ORACLE["normalise_within_run"] = f"""WITH {PSMS}, present AS (SELECT DISTINCT run_id FROM good),
{CLEAVAGES.format(runs='present')}
SELECT run_id, missed_cleavages, {r('fraction / sum(fraction) OVER (PARTITION BY run_id)')} AS fraction
FROM cleavages"""
ORACLE["peptide_identifications"] = f"""WITH {PSMS}
SELECT run_id, 'unknown' AS identifier, retention_time AS rt, {r('exp_mz')} AS mz, 'q-value' AS score_type,
  false AS higher_score_better, 1 AS n_hits, {r('fdr_score')} AS score, 1 AS rank, charge, sequence
FROM psms"""

# ---- features --------------------------------------------------------------

FEATURES = """
features AS (
  SELECT CAST(c_custkey % 8 AS VARCHAR) AS run_id, c_custkey AS feature_id, c_nationkey % 8 AS charge,
    (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_idents
  FROM customer)"""
ORACLE["feature_counts"] = f"""WITH {FEATURES}
SELECT run_id, count(*) AS nr_features, count(*) FILTER (n_idents > 0) AS nr_ident_features
FROM features GROUP BY run_id"""
ORACLE["identified_features"] = f"""WITH {FEATURES}
SELECT run_id, feature_id, charge FROM features WHERE n_idents > 0"""


def _feature_charges(keep: str) -> str:
    return f"""WITH {FEATURES}
SELECT run_id, CAST(b AS INTEGER) AS charge,
  {r(f'count(*) FILTER ({keep} AND least(charge, 6) = b)::DOUBLE / count(*) FILTER ({keep})')} AS fraction
FROM features, range(1, 7) AS t(b) GROUP BY run_id, b"""


ORACLE["feature_charge_fractions"] = _feature_charges("true")
ORACLE["ident_feature_charge_fractions"] = _feature_charges("n_idents > 0")

# ---- targeted extraction ---------------------------------------------------



def _spikeins(kinds: str, name: str) -> str:
    return f"""
kinds AS (SELECT CAST(p_partkey % 8 AS VARCHAR) AS run_id, p_retailprice AS mz, p_type AS kind, p_partkey AS position,
            p_brand AS brand FROM part {kinds}),
spikeins AS (
  SELECT run_id, mz, position, {name} AS name, kind || {LETTERS.format('mz')} AS plain,
    '[Acetyl]-' || substr(kind, 1, 3) || '[Oxidation]' || substr(kind, 4) || {LETTERS.format('mz')} || '/2' AS sequence,
    round((mz - 900) * 24, 1) AS rt FROM kinds),
queries AS (SELECT run_id, plain AS plain_sequence, name AS comment, mz, 200.0::DOUBLE AS tolerance,
    'ppm' AS tolerance_unit, rt / 60.0::DOUBLE - 10.0::DOUBLE AS rt_start,
    rt / 60.0::DOUBLE + 10.0::DOUBLE AS rt_end FROM spikeins
  QUALIFY row_number() OVER (PARTITION BY run_id, plain ORDER BY position DESC) = 1)"""


SPIKEINS = _spikeins("", f"'SP' || {LETTERS.format('mz')} || '-' || CAST(position AS VARCHAR)")
PANEL = _spikeins("QUALIFY row_number() OVER (PARTITION BY p_partkey % 8, p_brand ORDER BY p_partkey) = 1", "brand")
MATCHES = f"""{PSMS}, {SPIKEINS},
matches AS (SELECT p.run_id, p.sequence, retention_time, psm_id, accession, fdr_score AS score
  FROM psms p JOIN queries q ON q.run_id = p.run_id AND q.plain_sequence = p.sequence
  WHERE fdr_score < 0.01::DOUBLE),
found AS (SELECT run_id, sequence, count(DISTINCT retention_time) AS n, avg(DISTINCT retention_time) AS rt
  FROM matches GROUP BY run_id, sequence),
moved AS (
  SELECT q.run_id, plain_sequence, comment, mz, tolerance, tolerance_unit,
    greatest(0, coalesce(f.rt / 60 - (rt_end - rt_start) / 2, rt_start)) AS rt_start,
    coalesce(f.rt / 60 + (rt_end - rt_start) / 2, rt_end) AS rt_end
  FROM queries q LEFT JOIN found f ON f.run_id = q.run_id AND f.sequence = q.plain_sequence)"""
XIC = f"""{MATCHES}, {SPECTRA}, {PEAKS},
xic AS (
  SELECT m.run_id, m.comment, s.scan_no, s.rt / 60.0::DOUBLE AS rt, p.mz, p.intensity
  FROM peaks p JOIN spectra s USING (spectrum_id)
  JOIN moved m ON m.run_id = s.run_id
    AND p.mz >= m.mz - m.mz / 1000000::DOUBLE * m.tolerance AND p.mz < m.mz + m.mz / 1000000::DOUBLE * m.tolerance
    AND s.rt >= m.rt_start * 60 AND s.rt < m.rt_end * 60),
apex AS (SELECT run_id, comment, maximum_intensity, rt_at_maximum FROM (
  SELECT run_id, comment, intensity AS maximum_intensity, rt * 60 AS rt_at_maximum,
    row_number() OVER (PARTITION BY run_id, comment ORDER BY intensity DESC, rt, scan_no, mz) AS k FROM xic)
  WHERE k = 1),
observed AS (
  SELECT s.run_id, s.name, s.sequence, coalesce(a.maximum_intensity, 0.0) AS maximum_intensity,
    coalesce(a.rt_at_maximum, -1.0) AS rt_at_maximum, CAST(coalesce(f.n, 0) AS BIGINT) AS nr_identifications,
    s.rt AS expected_rt, coalesce(a.rt_at_maximum, -1.0) - s.rt AS delta_to_expected_rt
  FROM spikeins s LEFT JOIN apex a ON a.run_id = s.run_id AND a.comment = s.name
  LEFT JOIN found f ON f.run_id = s.run_id AND f.sequence = s.plain)"""
WINDOW_COLUMNS = f"""run_id, plain_sequence, comment, {r('mz')} AS mz, tolerance, tolerance_unit,
  {r('rt_start')} AS rt_start, {r('rt_end')} AS rt_end"""
ORACLE["plain_sequences"] = f"WITH {SPIKEINS} SELECT run_id, name, plain FROM spikeins"
ORACLE["xic_query_windows"] = f"WITH {SPIKEINS} SELECT {WINDOW_COLUMNS} FROM queries"
ORACLE["target_psm_matches"] = f"WITH {MATCHES} SELECT * FROM matches"
ORACLE["recenter_windows"] = f"WITH {MATCHES} SELECT {WINDOW_COLUMNS} FROM moved"
ORACLE["ident_counts"] = f"WITH {MATCHES} SELECT run_id, sequence, n AS count FROM found"
ORACLE["extract_xic"] = f"""WITH {XIC}
SELECT run_id, comment, scan_no, {r('rt')} AS rt, {r('mz')} AS mz, intensity FROM xic"""
ORACLE["extract_xic_nested"] = ORACLE["extract_xic"]
ORACLE["xic_apex"] = f"""WITH {XIC}
SELECT run_id, comment, maximum_intensity, {r('rt_at_maximum')} AS rt_at_maximum FROM apex"""
ORACLE["spikein_metrics"] = f"""WITH {XIC}
SELECT run_id, name, sequence, maximum_intensity, {r('rt_at_maximum')} AS rt_at_maximum, nr_identifications,
  {r('expected_rt')} AS expected_rt, {r('delta_to_expected_rt')} AS delta_to_expected_rt FROM observed"""
ORACLE["spikein_cells"] = f"""WITH {XIC}
SELECT run_id, name || '_maximum_intensity' AS "column", {r('maximum_intensity')} AS value FROM observed
UNION ALL SELECT run_id, name || '_rt_at_maximum', {r('rt_at_maximum / 60')} FROM observed
UNION ALL SELECT run_id, name || '_nr_identifications', {r('nr_identifications')} FROM observed
UNION ALL SELECT run_id, name || '_delta_to_expected_rt', {r('delta_to_expected_rt / 60')} FROM observed"""

PANEL_XIC = XIC.replace(SPIKEINS, PANEL)
BRANDS = [f"Brand#{i}" for i in range(1, 26)]


def _brand_columns(values: list[tuple[str, str]]) -> str:
    """Columns of every brand from the rows of ``observed``."""
    return ", ".join(f"""max({value}) FILTER (name = '{brand}') AS "{brand}_{column}\"""" for brand in BRANDS for column, value in values)


BRAND_XIC = XIC.replace("SELECT run_id, mz, position,", "SELECT run_id, mz, position, brand,").replace(
    "SELECT s.run_id, s.name, s.sequence,", "SELECT s.run_id, s.brand AS name, s.sequence, s.position,")
ORACLE["spikeins_wide"] = f"""WITH {BRAND_XIC},
listed AS (SELECT *, row_number() OVER (PARTITION BY run_id, name ORDER BY position) - 1 AS list_no FROM observed)
SELECT run_id, list_no, {_brand_columns([("maximum_intensity", r("maximum_intensity")), ("rt_at_maximum", r("rt_at_maximum / 60")),
    ("nr_identifications", r("nr_identifications")), ("delta_to_expected_rt", r("delta_to_expected_rt / 60"))])}
FROM listed GROUP BY run_id, list_no"""

# ---- files: what comes back is what was written -----------------------------

ORACLE["xic_queries_file"] = f"""WITH {SPIKEINS}
SELECT run_id, comment, {r('mz')} AS mz, tolerance, tolerance_unit, {r('rt_start')} AS rt_start, {r('rt_end')} AS rt_end FROM queries"""
ORACLE["xic_results_file"] = f"""WITH {XIC}
SELECT m.run_id, m.comment, {r('m.mz - m.mz / 1000000::DOUBLE * m.tolerance')} AS mz_start,
  {r('m.mz + m.mz / 1000000::DOUBLE * m.tolerance')} AS mz_end, {r('rt_start')} AS rt_start, {r('rt_end')} AS rt_end,
  CASE WHEN x.rt IS NOT NULL THEN CAST(row_number() OVER (
    PARTITION BY m.run_id, m.comment ORDER BY x.rt, x.scan_no, x.mz, x.intensity) - 1 AS INTEGER) END AS i,
  {r('x.rt')} AS rt, x.intensity
FROM moved m LEFT JOIN xic x ON x.run_id = m.run_id AND x.comment = m.comment"""
ORACLE["xic_apex_file"] = f"""WITH {XIC}
SELECT m.run_id, m.comment, coalesce(a.maximum_intensity, 0.0) AS maximum_intensity,
  coalesce({r('a.rt_at_maximum')}, -1.0) AS rt_at_maximum
FROM moved m LEFT JOIN apex a ON a.run_id = m.run_id AND a.comment = m.comment"""
ORACLE["ident_counts_file"] = ORACLE["ident_counts"]

ORACLE["peptide_export_file"] = """
SELECT CAST(p_size % 8 AS VARCHAR) AS run_id, 5 AS n_cells, 'PEPTIDE' AS c0, CAST(p_partkey AS VARCHAR) AS c1,
  p_name || ', "' || p_brand || '"' AS c2, '' AS c3, p_type AS c4 FROM part"""
ORACLE["spikeins_file"] = f"""WITH {SPIKEINS}
SELECT run_id, name, sequence, {r('mz')} AS mz, rt, '200 ppm' AS mz_tol, 600.0::DOUBLE AS rt_tol FROM spikeins"""
ORACLE["mztab_psms_file"] = f"""WITH {PSMS}
SELECT {PSM_COLUMNS} fdr_score, is_decoy FROM psms"""
ORACLE["mztab_proteins_file"] = """
SELECT CAST(s_nationkey % 8 AS VARCHAR) AS run_id, s_name AS accession,
  CASE WHEN s_suppkey % 3 <> 0 THEN 'Supplier#' || lpad(CAST(s_suppkey + 1 AS VARCHAR), 9, '0')
    || ',' || 'Supplier#' || lpad(CAST(s_suppkey + 2 AS VARCHAR), 9, '0') END AS ambiguity_members,
  'file:///' || CAST(s_nationkey % 8 AS VARCHAR) AS run_name
FROM supplier"""

# ---- telemetry -------------------------------------------------------------

EVENTS = """
ev AS (
  SELECT CAST(user_id % 8 AS VARCHAR) AS run_id, event_id, event_type, value,
    (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000000::DOUBLE AS rt,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS type_id
  FROM events)"""
HEADERS = f"""{EVENTS},
scans AS (SELECT run_id, event_id AS scan_no, rt, value, k,
    CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS ms_level
  FROM ev WHERE event_type <> 'signup'),
signups AS (SELECT * FROM ev WHERE event_type = 'signup' AND run_id NOT IN ('3', '7')),
records AS (
  SELECT run_id, rt, 'LOG_CPU core temp. (°C)' AS name, 'CPU core temp. (°C)' AS header, CAST(k AS DOUBLE) AS value FROM signups
  UNION ALL SELECT run_id, rt, 'LOG_Ambient temp. (°C)', 'Ambient temp. (°C)', value FROM signups WHERE event_id % 2 = 0
  UNION ALL SELECT run_id, rt, 'LOG_Ambient temp. (°C)', 'Ambient temp. (°C) rear', -value FROM signups WHERE event_id % 3 = 0),
log AS (SELECT run_id, rt, name, header, max(value) AS value FROM records WHERE value IS NOT NULL GROUP BY ALL),
probes AS (SELECT s.run_id, scan_no, s.rt, ms_level, name, header
           FROM scans s JOIN (SELECT DISTINCT run_id, name, header FROM log) USING (run_id)),
logged AS (
  SELECT p.run_id, p.scan_no, p.rt, p.ms_level, p.name, p.header, l.value
  FROM probes p ASOF JOIN log l ON p.run_id = l.run_id AND p.header = l.header AND p.rt >= l.rt),
found AS (
  SELECT run_id, scan_no, rt, ms_level, 'EXTRA_Ion Injection Time (ms)' AS name,
    'Ion Injection Time (ms)' AS header, value FROM scans WHERE scan_no % 3 <> 0
  UNION ALL SELECT run_id, scan_no, rt, ms_level, 'EXTRA_LM mz-Correction (ppm),LM Correction',
    'LM m/z-Correction (ppm)', CAST(k AS DOUBLE) FROM scans WHERE scan_no % 3 <> 0
  UNION ALL SELECT * FROM logged),
headers AS (
  SELECT s.run_id, s.scan_no, s.rt, s.ms_level, name, header, f.value
  FROM scans s LEFT JOIN found f ON f.run_id = s.run_id AND f.scan_no = s.scan_no)"""
HEADER_COLUMNS = [
    ("EXTRA_Ion Injection Time (ms)", "Ion Injection Time (ms)", "EXTRA_Ion Injection Time (ms)"),
    ("EXTRA_LM mz-Correction (ppm),LM Correction", "LM m/z-Correction (ppm)", "EXTRA_LM mz-Correction (ppm),LM Correction"),
    ("LOG_Ambient temp. (°C)", "Ambient temp. (°C)", "LOG_Ambient temp. (°C) [Ambient temp. (°C)]"),
    ("LOG_Ambient temp. (°C)", "Ambient temp. (°C) rear", "LOG_Ambient temp. (°C) [Ambient temp. (°C) rear]"),
    ("LOG_CPU core temp. (°C)", "CPU core temp. (°C)", "LOG_CPU core temp. (°C)")]
ORACLE["select_headers"] = """
SELECT DISTINCT CAST(user_id % 8 AS VARCHAR) AS run_id, event_type AS header, entry
FROM events, (VALUES ('sign,view', 'sign'), ('sign,view', 'view'), ('c', 'c'), ('purchase', 'purchase'),
                     ('nothing', 'nothing')) AS w(entry, part)
WHERE starts_with(event_type, part)"""
ORACLE["scan_headers_asof"] = f"""WITH {HEADERS}
SELECT run_id, scan_no, {r('rt')} AS rt, ms_level, name, header, {r('value')} AS value FROM headers"""
ORACLE["scan_headers_wide"] = f"""WITH {HEADERS}
SELECT run_id, scan_no, {r('rt')} AS rt, ms_level,
  """ + ", ".join(f"""{r(f"max(value) FILTER (name = '{n}' AND header = '{h}')")} AS "{c}\"""" for n, h, c in HEADER_COLUMNS) + """
FROM headers GROUP BY run_id, scan_no, rt, ms_level"""
ORACLE["headers_long"] = f"""WITH {HEADERS}, columns(name, header, shown) AS (VALUES {", ".join(f"('{n}', '{h}', '{c}')" for n, h, c in HEADER_COLUMNS)})
SELECT run_id, shown || CASE WHEN name LIKE 'EXTRA%' THEN ' (MS1 filtered)' ELSE '' END AS header,
  {r('rt / 60')} AS x, {r('value')} AS y
FROM headers JOIN columns USING (name, header) WHERE value IS NOT NULL AND (name LIKE 'LOG%' OR ms_level = 1)"""
ORACLE["tune_values"] = f"""WITH {EVENTS}
SELECT run_id, 'TUNE_Vaporizer Temp. (-)' AS name, 'Vaporizer Temp. (-) ' || event_type AS header,
  {r('max(value)')} AS value FROM ev GROUP BY run_id, event_type"""
ORACLE["pump_pressure"] = f"""WITH {EVENTS}, {RUNS10},
m AS (SELECT * FROM ev WHERE event_type IN ('view', 'click')),
c AS (SELECT run_id, max(type_id) AS type_id FROM m GROUP BY run_id)
SELECT run_id, {r('rt')} AS x, {r('value')} AS y FROM m JOIN c USING (run_id, type_id)
UNION ALL SELECT run_id, NULL, NULL FROM runs10 WHERE run_id NOT IN (SELECT run_id FROM c)"""
WIDE = """wide AS (SELECT run_id, CAST(floor(rt / 3600) AS BIGINT) AS frame,
  max(value) FILTER (event_type = 'view') AS view, max(value) FILTER (event_type = 'click') AS click,
  max(value) FILTER (event_type = 'purchase') AS purchase, CAST(NULL AS DOUBLE) AS missing_property
  FROM ev WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2)"""
WIDE_COLUMNS = f"{r('view')} AS view, {r('click')} AS click, {r('purchase')} AS purchase, missing_property"
ORACLE["pivot_properties"] = f"""WITH {EVENTS}, {WIDE} SELECT run_id, frame, {WIDE_COLUMNS} FROM wide"""
ORACLE["frame_table"] = f"""WITH {EVENTS}, {WIDE},
f AS (SELECT run_id, CAST(floor(rt / 3600) AS BIGINT) AS id, min(rt) AS time,
  CAST(count(*) % 2 * 9 AS INTEGER) AS msms_type, max(value) AS "Pressure" FROM ev GROUP BY 1, 2)
SELECT f.run_id, id, {r('time')} AS time, msms_type, {r('"Pressure"')} AS "Pressure", {WIDE_COLUMNS}
FROM f LEFT JOIN wide w ON w.run_id = f.run_id AND w.frame = f.id"""
CALIBRATED = f"""{EVENTS},
cal(no, cmz, cmob) AS (VALUES (1, 50.0::DOUBLE, 0.5::DOUBLE), (2, 120.0::DOUBLE, 0.3::DOUBLE),
                              (3, 200.5::DOUBLE, 0.7::DOUBLE)),
hit AS (SELECT run_id, no, cmz, cmob, floor(rt / 3600) AS rt, value AS mz, k / 100.0::DOUBLE AS mobility,
    row_number() OVER (PARTITION BY run_id, no, floor(rt / 3600) ORDER BY floor(value) DESC, event_id) AS o
  FROM ev, cal
  WHERE event_type IN ('view', 'click') AND value >= cmz - 10 AND value < cmz + 10
    AND k / 100.0::DOUBLE >= cmob - 0.1::DOUBLE AND k / 100.0::DOUBLE < cmob + 0.1::DOUBLE)"""
ORACLE["track_calibrants"] = f"""WITH {CALIBRATED}
SELECT run_id, no AS calibrant_no, cmz AS calibrant_mz, cmob AS calibrant_mobility, rt AS observed_rt,
  {r('mz')} AS observed_mz, {r('mobility')} AS observed_mobility FROM hit WHERE o = 1"""
ORACLE["calibrant_series"] = f"""WITH {CALIBRATED}
SELECT run_id, no, cmz AS calibrant_mz, cmob AS calibrant_mobility, {r('rt / 1000')} AS rt,
  {r('mz')} AS observed_mz, {r('mobility')} AS observed_mobility FROM hit WHERE o = 1"""


def _decoded(name: str, width: int, source: str) -> str:
    digits = 2 * width
    pairs = " || ".join(f"substr(p, {i}, 2)" for i in range(digits - 1, 0, -2))
    return f"""
{name}_parts AS (
  SELECT run_id, trace_id, chunk_no, unnest(regexp_extract_all({source}, '.{{1,{digits}}}')) AS p,
         generate_subscripts(regexp_extract_all({source}, '.{{1,{digits}}}'), 1) AS i FROM chunks),
{name} AS (
  SELECT run_id, trace_id, row_number() OVER (PARTITION BY trace_id ORDER BY chunk_no, i) - 1 AS pos,
         CAST('0x' || {pairs} AS UBIGINT) AS v FROM {name}_parts)"""


CHUNKS = f"""
chunks AS (
  SELECT CAST(doc_id // 2 % 8 AS VARCHAR) AS run_id, doc_id // 2 AS trace_id, doc_id % 2 AS chunk_no,
         CASE WHEN doc_id // 2 % 2 = 1 THEN hex(encode(text)) || hex(encode(text)) ELSE hex(encode(text)) END AS times,
         hex(encode(text)) AS intensities FROM documents),{_decoded("t", 8, "times")},{_decoded("v", 4, "intensities")},
points AS (
  SELECT coalesce(t.run_id, v.run_id) AS run_id, coalesce(t.trace_id, v.trace_id) AS trace_id, coalesce(t.pos, v.pos) AS pos,
         CAST(t.v AS DOUBLE) AS time, v.v::BIGINT AS value, CAST(floor(CAST(t.v AS DOUBLE) / 4294967296) AS BIGINT) AS high
  FROM t FULL JOIN v ON t.trace_id = v.trace_id AND t.pos = v.pos)"""
ORACLE["decode_trace"] = f"""WITH {CHUNKS}
SELECT run_id, trace_id, count(*) AS n_points, count(time) AS n_times, count(value) AS n_values,
  max(time) AS max_time, min(time) AS min_time, {big('sum(high * (pos % 89))')} AS weighted_times,
  {big('sum(value * (pos % 97))')} AS weighted_values, {big('sum((high % 1009) * (value % 997))')} AS paired
FROM points GROUP BY run_id, trace_id"""
ORACLE["packed_pump_pressure"] = f"""WITH {CHUNKS}, {RUNS10},
chosen AS (SELECT CAST(doc_id // 2 % 8 AS VARCHAR) AS run_id, min(doc_id // 2) AS trace_id FROM documents
           WHERE doc_id // 2 % 3 = 1 GROUP BY 1),
found AS (SELECT run_id, pos, time, CAST(value AS DOUBLE) AS value FROM points JOIN chosen USING (run_id, trace_id))
SELECT run_id, pos, time AS x, value AS y FROM runs10 LEFT JOIN found USING (run_id)"""

# ---- metric records and comparison of runs -----------------------------------

METRIC_ROWS = [("startTime", "rt_first * 86400 + 788918400"), ("nr_MS1", "nr_ms1"), ("nr_MS2", "nr_ms2"),
               ("accumulated_MS1_TIC", "accumulated_ms1_tic"), ("accumulated_MS2_TIC", "accumulated_ms2_tic"),
               ("base_peak_intensity_max", "base_peak_max"), ("total_ion_current_max", "tic_max")]
FEATURE_ROWS = [("nr_features", "nr_features"), ("nr_ident_features", "nr_ident_features")]


def _metric_row(short: str, source: str, value: str | None, element_no: str = "NULL", element: str = "NULL") -> str:
    m = METRICS[short]
    text = ", ".join(f"'{x}' AS {n}" for n, x in (
        ("accession", m.accession), ("short_name", short), ("name", m.name), ("description", m.description),
        ("unit_accession", m.unit_accession), ("unit_name", m.unit_name)))
    kind = "array" if value is None else "scalar"
    return f"""SELECT run_id, {text}, '{kind}' AS kind, {r(value or 'NULL')} AS value_num,
  CAST(NULL AS VARCHAR) AS value_str, CAST({element_no} AS INTEGER) AS element_no, {r(element)} AS element FROM {source}"""


RUN_METRICS = "metrics AS (" + " UNION ALL ".join(
    [_metric_row(s, "overview", v) for s, v in METRIC_ROWS]
    + [_metric_row("RT_range", "overview", None, str(i), c) for i, c in enumerate(("rt_first", "rt_last"))]) + ")"
FEATURE_METRICS = f"""{FEATURES}, fcounts AS (
  SELECT run_id, count(*) AS nr_features, count(*) FILTER (n_idents > 0) AS nr_ident_features
  FROM features GROUP BY run_id),
fmetrics AS (""" + " UNION ALL ".join(_metric_row(s, "fcounts", v) for s, v in FEATURE_ROWS) + ")"

ORACLE["metric_records"] = f"WITH {OVERVIEW}, {RUN_METRICS} SELECT * FROM metrics"
ORACLE["mzqc_metrics"] = f"""WITH {OVERVIEW}, {RUN_METRICS}
SELECT * FROM metrics WHERE regexp_full_match(accession || ' ! ' || short_name, '(MS:[A-Z0-9]+).*')"""
ORACLE["combine_runs"] = f"""WITH {OVERVIEW}, {RUN_METRICS}, {FEATURE_METRICS}
SELECT * FROM metrics UNION ALL SELECT * FROM fmetrics"""
ORACLE["combine_runs_namespaced"] = f"""WITH {FEATURE_METRICS}
SELECT 'run_' || run_id AS run_id, * EXCLUDE (run_id) FROM fmetrics"""
ORACLE["metric_table_long"] = f"""WITH {SUMMARY},
t AS (SELECT run_id, tic, rt, row_number() OVER (PARTITION BY run_id ORDER BY scan_no) - 1 AS row_no
      FROM summary WHERE ms_level = 1)
SELECT run_id, 'MS:4000211' AS accession, 'MS1_TIC' AS short_name, row_no, 0 AS column_no,
  'MS:1000285' AS column_accession, 'total ion current' AS column_name, tic AS value_num,
  CAST(NULL AS VARCHAR) AS value_str FROM t
UNION ALL SELECT run_id, 'MS:4000211', 'MS1_TIC', row_no, 1, 'UO:0000010', 'second', rt, NULL FROM t"""


def _table(source: str, short: str, accession: str, row_no: str, columns: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"""SELECT run_id, '{accession}' AS accession, '{short}' AS short_name, CAST({row_no} AS BIGINT) AS row_no, {i} AS column_no,
        '{column}' AS column_accession, '{name}' AS column_name, {r(value)} AS value_num, CAST(NULL AS VARCHAR) AS value_str FROM {source}"""
        for i, (value, column, name) in enumerate(columns))


_CHARGE = [("charge", "MS:1000041", "charge state"), ("fraction", "UO:0000191", "fraction")]
ORACLE["combine_tables"] = f"""WITH {CHARGE_FRACTIONS}, {SUMMARY.replace(SPECTRA + ",", "").lstrip()}, {FEATURES},
maxima AS (SELECT run_id, max(base_peak) FILTER (rt <= 1200) AS base_peak_max FROM summary GROUP BY run_id),
fc AS (SELECT run_id, b AS charge, count(*) FILTER (least(charge, 8) = b)::DOUBLE / count(*) AS fraction
       FROM features, range(1, 9) AS t(b) GROUP BY run_id, b)
{_table("charges", "MS2_prec_charge_fraction", "MS:4000063", "charge", _CHARGE)} UNION ALL
{_table("maxima", "base_peak_intensity_maxima_per_time_range", "MS:4000203", "0", [
    ("base_peak_max", "MS:1000505", "base peak intensity"), ("0.0", "UO:0000010", "second"), ("1200.0", "NCIT:C25330", "Duration")])}
UNION ALL {_table("fc", "features_charges", "MS:4000207", "charge - 1", _CHARGE)}"""
ORACLE["metric_kind"] = f"""WITH {OVERVIEW}, {RUN_METRICS}
SELECT DISTINCT accession, short_name, kind FROM metrics
UNION ALL SELECT 'MS:4000063', 'MS2_prec_charge_fraction', 'table'"""
# The JSON documents: texts of the header, values and table columns as they are written.
_WHOLE = "CAST(CAST({} AS BIGINT) AS VARCHAR)"
_VALUES = {short: _WHOLE.format(value) for short, value in METRIC_ROWS}
_VALUES["RT_range"] = "'[' || " + _WHOLE.format("rt_first") + " || ',' || " + _WHOLE.format("rt_last") + " || ']'"
_EXPORTED = sorted((f"{METRICS[s].accession} ! {s}", s) for s in _VALUES if METRICS[s].accession.startswith("MS:"))
_STARTED = "strftime(make_timestamp(CAST((rt_first * 86400 + 788918400) * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S')"
_TIC_KEY, _MAP_KEY = "MS:4000211 ! MS1_TIC", "MS:0 ! MS1_map"
_FIRST_KEY = min([_TIC_KEY, _MAP_KEY, *[key for key, _ in _EXPORTED]])


def _head(key: str, accession: str, name: str) -> str:
    return f"""{"" if key == _FIRST_KEY else ","}{{"accession":"{accession}","name":"{name}","value":"""


def _metric_line(key: str, short: str) -> str:
    m = METRICS[short]
    unit = f',"unit":{{"unit_accession":"{m.unit_accession}","unit_name":"{m.unit_name}"}}' if m.unit_accession else ""
    return f"""SELECT run_id, 1, '{key}', -1, -1, '{_head(key, m.accession, m.name)}' || {_VALUES[short]} || '{unit}}}' FROM overview"""


DOCUMENT_SERIES = """series AS (SELECT run_id, tic, rt, row_number() OVER (PARTITION BY run_id ORDER BY scan_no) - 1 AS row_no
      FROM summary WHERE ms_level = 1)"""
DOCUMENT_LINES = [
    f"""SELECT run_id, 0, '', -1, -1, '{{"mzQC":{{"version":"1.0.0","creationDate":"2024-05-05T10:00:00",'
      || '"runQualities":[{{"metadata":{{"inputFiles":[{{"name":"' || run_id || '","location":null,"fileFormat":'
      || '{{"accession":"MS:1000563","name":"Thermo RAW format"}},"fileProperties":['
      || CASE WHEN rt_first * 86400 + 788918400 > 0 THEN
         '{{"accession":"MS:1002435","name":"data processing start time","value":"' || {_STARTED} || '"}}' ELSE '' END
      || ']}}],"analysisSoftware":[{{"accession":"MS:1002251","name":"Comet","description":'
      || '"Comet open-source sequence search engine developed at the University of Washington.",'
      || '"version":"v2024.01.0","uri":"https://uwpr.github.io/Comet/"}}]}},"qualityMetrics":[' FROM overview""",
    """SELECT run_id, 2, '', -1, -1, ']}],"setQualities":[],"controlledVocabularies":[{"name":'
      || '"Proteomics Standards Initiative Mass Spectrometry Ontology",'
      || '"uri":"https://github.com/HUPO-PSI/psi-ms-CV/blob/master/psi-ms.obo","version":"4.1.197"}]}}' FROM overview""",
    *[_metric_line(key, short) for key, short in _EXPORTED],
    f"SELECT run_id, 1, '{_TIC_KEY}', -1, -1, '{_head(_TIC_KEY, 'MS:4000211', METRICS['MS1_TIC'].name)}{{' FROM overview",
    f"SELECT run_id, 1, '{_MAP_KEY}', -1, -1, '{_head(_MAP_KEY, 'MS:0', METRICS['MS1_map'].name)}null}}' FROM overview",
    *[f"""SELECT run_id, 1, '{_TIC_KEY}', {i}, -1, '{"," if i else ""}"{accession}":[' FROM overview
    UNION ALL SELECT run_id, 1, '{_TIC_KEY}', {i}, row_no, CASE WHEN row_no = 0 THEN '' ELSE ',' END || {_WHOLE.format(value)} FROM series
    UNION ALL SELECT run_id, 1, '{_TIC_KEY}', {i}, 4611686018427387904, ']' FROM overview"""
      for i, (accession, value) in enumerate((("MS:1000285", "tic"), ("UO:0000010", "rt")))],
    f"SELECT run_id, 1, '{_TIC_KEY}', 2, -1, '}}}}' FROM overview",
]
ORACLE["mzqc_lines"] = f"""WITH {OVERVIEW}, {DOCUMENT_SERIES},
lines(run_id, section, metric, column_no, row_no, line) AS ({" UNION ALL ".join(DOCUMENT_LINES)})
SELECT run_id, section::INTEGER AS section, metric, column_no::INTEGER AS column_no, row_no::BIGINT AS row_no, line FROM lines"""
_FOUND = [
    "SELECT run_id, 'MS:4000211', 'MS1 total ion current', value, NULL FROM tic",
    f"SELECT run_id, 'MS:0', '{METRICS['MS1_map'].name}', NULL, NULL FROM overview",
    *[f"""SELECT run_id, '{METRICS[s].accession}', '{METRICS[s].name}', {_VALUES[s]}, nullif('{METRICS[s].unit_accession}', '')
          FROM overview""" for _, s in _EXPORTED]]
ORACLE["mzqc_file"] = f"""WITH {OVERVIEW}, {DOCUMENT_SERIES},
tic AS (SELECT run_id, '{{"MS:1000285":[' || string_agg({_WHOLE.format('tic')}, ',' ORDER BY row_no) || '],"UO:0000010":['
               || string_agg({_WHOLE.format('rt')}, ',' ORDER BY row_no) || ']}}' AS value FROM series GROUP BY run_id),
found(run_id, accession, name, value, unit) AS ({" UNION ALL ".join(_FOUND)})
SELECT run_id, {_STARTED} AS started, accession, name, sha256(value) AS value_hash, unit FROM found JOIN overview USING (run_id)"""
SCALARS = ", ".join(f'{r(v)} AS "{s}"' for s, v in METRIC_ROWS if s != "startTime")
ORACLE["scalars_wide"] = f"WITH {OVERVIEW} SELECT run_id, {SCALARS} FROM overview"
ORACLE["arrays_wide"] = f"""WITH {OVERVIEW}
SELECT run_id, rt_first AS "RT_range_min", rt_last AS "RT_range_max" FROM overview"""
CHARGES = ", ".join(f'{r(f"max(fraction) FILTER (charge = {i})")} AS "MS2_prec_charge_fraction_{i}"' for i in range(5))
ORACLE["tables_wide"] = f"WITH {CHARGE_FRACTIONS} SELECT run_id, {CHARGES} FROM charges GROUP BY run_id"
SPIKEIN_SUMMARY = _brand_columns([
    ("proforma peptidoform sequence", "sequence"), ("MS1 feature maximum intensity", r("maximum_intensity")),
    ("retention time", r("rt_at_maximum / 60")), ("count of identified spectra", r("nr_identifications")),
    ("predicted retention time", r("expected_rt / 60")), ("Delta_to_expected_RT", r("delta_to_expected_rt / 60"))])
FEATURE_CHARGES = ", ".join(
    f"""{r(f"count(*) FILTER (least(charge, 8) = {i})::DOUBLE / count(*)")} AS features_charges_{i}""" for i in range(1, 9))
ORACLE["summary_table"] = f"""WITH {PANEL_XIC},
summary AS (
  SELECT s.*, coalesce(p.tic, 0.0) AS tic, coalesce(p.base_peak, 0.0) AS base_peak
  FROM spectra s LEFT JOIN (SELECT spectrum_id, sum(intensity) AS tic, max(intensity) AS base_peak
                            FROM peaks GROUP BY spectrum_id) p USING (spectrum_id)),
{OVERVIEW[OVERVIEW.index("overview AS ("):]}, {RUNS10}, {FEATURES},
charges AS (
  SELECT run_id, CAST(b AS INTEGER) AS charge,
    count(*) FILTER (ms_level = 2 AND least(s.charge, 4) = b)::DOUBLE / count(*) FILTER (ms_level = 2) AS fraction
  FROM spectra s, range(0, 5) AS t(b) GROUP BY run_id, b),
c AS (SELECT run_id, {CHARGES} FROM charges GROUP BY run_id),
l AS (SELECT run_id, max(base_peak) FILTER (rt <= 1200) AS base_peak_intensity_maxima_per_time_range
      FROM summary GROUP BY run_id),
fc AS (SELECT run_id, {FEATURE_CHARGES} FROM features GROUP BY run_id),
si AS (SELECT run_id, {SPIKEIN_SUMMARY} FROM observed GROUP BY run_id)
SELECT run_id, make_timestamp(CAST((rt_first * 86400 + 788918400) * 1000000 AS BIGINT)) AS "startTime",
  {r('rt_first / 60')} AS "RT_range_min", {r('rt_last / 60')} AS "RT_range_max", {SCALARS},
  base_peak_intensity_maxima_per_time_range, c.* EXCLUDE (run_id), fc.* EXCLUDE (run_id), si.* EXCLUDE (run_id),
  'run ' || run_id AS label, CAST(NULL AS DOUBLE) AS nr_peptides
FROM runs10 LEFT JOIN overview USING (run_id) LEFT JOIN c USING (run_id) LEFT JOIN l USING (run_id)
LEFT JOIN fc USING (run_id) LEFT JOIN si USING (run_id)"""
ORACLE["metric_catalogue"] = f"""WITH {OVERVIEW}, {RUN_METRICS}, {FEATURE_METRICS},
a AS (SELECT * FROM metrics UNION ALL SELECT * FROM fmetrics)
SELECT DISTINCT accession || ' ! ' || short_name AS key, description, name, short_name, unit_accession, unit_name
FROM a"""
ORACLE["vendor_check"] = """
SELECT count(*) FILTER (c_mktsegment = 'MACHINERY') AS n_thermo,
  count(*) FILTER (c_mktsegment = 'BUILDING') AS n_bruker,
  count(*) FILTER (c_mktsegment = 'MACHINERY') > 0 AND count(*) FILTER (c_mktsegment = 'BUILDING') > 0 AS mixed
FROM customer"""
ORACLE["exclude_empty_runs"] = """
SELECT CAST(c_custkey AS VARCHAR) AS run_id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)"""
ORACLE["melt_metrics"] = f"""WITH {OVERVIEW}
SELECT run_id, 'nr_ms1' AS variable, nr_ms1 AS value FROM overview
UNION ALL SELECT run_id, 'nr_ms2', nr_ms2 FROM overview"""
ORACLE["array_to_long"] = f"""WITH {OVERVIEW}
SELECT run_id, 'RT_Q_1' AS variable, rt_first AS value FROM overview
UNION ALL SELECT run_id, 'RT_Q_2', rt_last FROM overview"""
ORACLE["relabel_buckets"] = f"""WITH {CHARGE_FRACTIONS}
SELECT run_id, CASE charge WHEN 4 THEN 'more' WHEN 0 THEN 'Unknown' ELSE CAST(charge AS VARCHAR) END AS charge,
  {r('fraction')} AS fraction FROM charges"""
ORACLE["overlay_series"] = f"""WITH {SUMMARY}
SELECT run_id, ms_level, scan_no, {r('rt / 60')} AS rt, tic FROM summary WHERE ms_level = 1"""
ORACLE["scale_timestamps"] = f"""WITH {OVERVIEW},
t AS (SELECT run_id, rt_first * 86400 + 788918400 AS t FROM overview)
SELECT run_id, CASE WHEN (SELECT min(t) = max(t) FROM t) THEN 1.0::DOUBLE
  ELSE {r('(t - (SELECT min(t) FROM t)) / ((SELECT max(t) FROM t) - (SELECT min(t) FROM t)) * 100')} END AS t_scaled
FROM t"""
ORACLE["start_times_utc"] = f"""WITH {OVERVIEW}
SELECT run_id, make_timestamp(CAST((rt_first * 86400 + 788918400) * 1000000 AS BIGINT)) AS "startTime" FROM overview"""
ORACLE["assign_groups"] = f"""WITH {OVERVIEW}
SELECT run_id, nr_ms1, nr_ms2, n_name AS "group"
FROM overview LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = run_id"""
ORACLE["downsample_every_nth"] = f"""WITH {EVENTS},
p AS (SELECT run_id, rt, value, row_number() OVER (PARTITION BY run_id ORDER BY rt, value) - 1 AS pos,
        count(*) OVER (PARTITION BY run_id) AS n FROM ev)
SELECT run_id, {r('rt')} AS x, {r('value')} AS y FROM p WHERE n <= 100 OR pos % (n // 100) = 0"""
ORACLE["standardise_features"] = f"""WITH l AS (
  SELECT CAST(vec_id AS VARCHAR) AS run_id, 'f' || i AS variable, CAST(embedding[i] AS DOUBLE) AS value
  FROM embeddings, range(1, 65) AS t(i))
SELECT run_id, variable, CASE WHEN s = 0 THEN 0.0::DOUBLE ELSE {r('(value - m) / s')} END AS value
FROM l JOIN (SELECT variable, avg(value) AS m, stddev_pop(value) AS s FROM l GROUP BY variable) USING (variable)"""


# Principal components by squaring: the powers of the Gram matrix tend to the
# projection on its longest axis; that axis is taken out and it is done again.
_N, _SQUARINGS = 64, 40


def _squared(source: str, name: str) -> str:
    trace = f"list_sum(list_transform(range(1, {_N + 1}), lambda i: {{0}}[i][i]))"
    scaled = "list_transform({0}, lambda r: list_transform(r, lambda x: x / t))"
    return f"""
{name}(k, m) AS (
  SELECT 0, {scaled.format('m')} FROM (SELECT m, {trace.format('m')} AS t FROM {source})
  UNION ALL
  SELECT k + 1, {scaled.format('q')} FROM (
    SELECT k, q, {trace.format('q')} AS t FROM (
      SELECT k, list_transform(m, lambda a: list_transform(m, lambda b: list_dot_product(a, b))) AS q FROM {name} WHERE k < {_SQUARINGS}))),
{name}_row AS (
  SELECT m[list_position(diagonal, list_max(diagonal))] AS r FROM (
    SELECT m, list_transform(range(1, {_N + 1}), lambda i: m[i][i]) AS diagonal FROM {name} WHERE k = {_SQUARINGS})),
{name}_axis AS (
  SELECT list_transform(r, lambda x: x / sqrt(list_dot_product(r, r))
    * CASE WHEN r[list_position(list_transform(r, lambda y: abs(y)), list_max(list_transform(r, lambda y: abs(y))))] < 0 THEN -1 ELSE 1 END) AS v
  FROM {name}_row),
{name}_found AS (
  SELECT v, list_dot_product(v, list_transform(g.m, lambda a: list_dot_product(a, v))) AS size FROM {name}_axis, {source} g)"""


PRINCIPAL = f"""RECURSIVE l AS (
  SELECT CAST(vec_id AS VARCHAR) AS run_id, i, CAST(embedding[i] AS DOUBLE) AS value FROM embeddings, range(1, {_N + 1}) AS t(i)),
z AS (
  SELECT run_id, i, CASE WHEN s = 0 THEN 0.0::DOUBLE ELSE (value - m) / s END AS z
  FROM l JOIN (SELECT i, avg(value) AS m, stddev_pop(value) AS s FROM l GROUP BY i) USING (i)),
columns AS (SELECT i, list(z ORDER BY run_id) AS c FROM z GROUP BY i),
gram AS (SELECT list(r ORDER BY i) AS m FROM (
  SELECT a.i, list(list_dot_product(a.c, b.c) ORDER BY b.i) AS r FROM columns a, columns b GROUP BY a.i)),
{_squared("gram", "first")},
rest AS (
  SELECT list_transform(range(1, {_N + 1}), lambda i: list_transform(range(1, {_N + 1}), lambda j: m[i][j] - size * v[i] * v[j])) AS m
  FROM gram, first_found),
{_squared("rest", "second")}"""
ORACLE["pca_scores"] = f"""WITH {PRINCIPAL},
x AS (SELECT run_id, list(z ORDER BY i) AS x FROM z GROUP BY run_id)
SELECT run_id, {r('list_dot_product(x, a.v)')} AS pca1, {r('list_dot_product(x, b.v)')} AS pca2
FROM x, first_found a, second_found b"""
ORACLE["pca_variance"] = f"""WITH {PRINCIPAL},
total AS (SELECT list_sum(list_transform(range(1, {_N + 1}), lambda i: m[i][i])) AS t FROM gram),
found AS (SELECT 1 AS component, size FROM first_found UNION ALL SELECT 2, size FROM second_found)
SELECT component, {r('size / t')} AS ratio, round(size / t * 100, 1) AS percent FROM found, total"""
ORACLE["pca_loadings"] = f"""WITH {PRINCIPAL}
SELECT 'f' || i AS variable, {r('sqrt(a.v[i] * a.v[i] + b.v[i] * b.v[i])')} AS length, {r('a.v[i]')} AS "PC1", {r('b.v[i]')} AS "PC2"
FROM first_found a, second_found b, range(1, {_N + 1}) AS t(i)"""

# ---- reports: the single results put together --------------------------------


def _part(name: str, short: str, row_no: str, values: list[str], where: str = "true") -> str:
    shown = [f"CAST({v} AS DOUBLE)" for v in values] + ["CAST(NULL AS DOUBLE)"] * (3 - len(values))
    return (f"SELECT run_id, '{short}' AS short_name, CAST({row_no} AS BIGINT) AS row_no, "
            + ", ".join(f"{v} AS v{i}" for i, v in enumerate(shown)) + f", CAST(NULL AS VARCHAR) AS text FROM ({ORACLE[name]}) WHERE {where}")


def _parts(name: str, short: str, columns: list[str], where: str = "true") -> list[str]:
    return [_part(name, short, str(i), [c], where) for i, c in enumerate(columns)]


def _numbered(name: str, short: str, order: str, values: list[str], where: str = "true") -> str:
    return _part(name, short, f"row_number() OVER (PARTITION BY run_id ORDER BY {order}) - 1", values, where)


QUARTERS, RATIOS, DENSITY = ["q1", "q2", "q3", "q4"], ["q2", "q3", "q4"], ["q25", "q50", "q75"]
ORACLE["spectrum_report"] = "\nUNION ALL ".join([
    _part("run_overview", "accumulated_MS1_TIC", "0", ["accumulated_ms1_tic"]),
    _part("run_overview", "accumulated_MS2_TIC", "0", ["accumulated_ms2_tic"]),
    _part("run_overview", "nr_MS1", "0", ["nr_ms1"]), _part("run_overview", "nr_MS2", "0", ["nr_ms2"]),
    *_parts("run_overview", "RT_range", ["rt_first", "rt_last"]),
    _part("run_overview", "base_peak_intensity_max", "0", ["base_peak_max"]),
    _part("run_overview", "total_ion_current_max", "0", ["tic_max"]),
    *_parts("rt_quantile_fractions", "RT_MS1_quantiles", QUARTERS, "ms_level = 1"),
    *_parts("rt_quantile_fractions", "RT_MS2_quantiles", QUARTERS, "ms_level = 2"),
    *_parts("tic_quantile_fractions", "RT_TIC_quantiles", QUARTERS),
    *_parts("tic_change_ratios", "MS1_TIC_change_quantiles", RATIOS),
    *_parts("tic_quantile_ratios", "MS1_TIC_quantiles", RATIOS),
    _part("max_frequency", "MS1_freq_max", "0", ["freq_max"], "ms_level = 1"),
    _part("max_frequency", "MS2_freq_max", "0", ["freq_max"], "ms_level = 2"),
    *_parts("density_quantiles", "MS1_density_quantiles", DENSITY, "ms_level = 1"),
    *_parts("density_quantiles", "MS2_density_quantiles", DENSITY, "ms_level = 2"),
    _part("precursor_charge_fractions", "MS2_prec_charge_fraction", "charge", ["charge", "fraction"]),
    _part("run_maxima_up_to", "base_peak_intensity_maxima_per_time_range", "0", ["base_peak_max", "start", "duration"]),
    _part("run_maxima_up_to", "total_ion_current_maxima_per_time_ranges", "0", ["tic_max", "start", "duration"]),
    _numbered("tic_series", "MS1_TIC", "scan_no", ["tic", "rt"], "ms_level = 1"),
    _numbered("tic_series", "MS2_TIC", "scan_no", ["tic", "rt"], "ms_level = 2"),
    _numbered("ion_map", "MS1_map", "scan_no, mz, intensity", ["rt", "mz", "intensity"]),
])
_PPM = f"(SELECT * FROM runs10 LEFT JOIN ({ORACLE['ppm_summary']}) USING (run_id))"


def _of_run(source: str, short: str, i: int, value: str) -> str:
    return f"SELECT run_id, '{short}', CAST({i} AS BIGINT), CAST({value} AS DOUBLE), NULL, NULL, NULL FROM {source}"


ORACLE["identification_report"] = f"WITH {RUNS10} " + "\nUNION ALL ".join([
    _part("count_protein_groups", "nr_protein_groups", "0", ["nr_protein_groups"]),
    _of_run(f"runs10 LEFT JOIN ({ORACLE['count_accessions']}) USING (run_id)", "nr_accessions", 0, "coalesce(nr_accessions, 0)"),
    _part("count_peptides", "nr_peptides", "0", ["nr_peptides"]), _part("count_psms", "nr_PSMs", "0", ["nr_psms"]),
    *[_of_run(_PPM, "filtered_psms_ppm_error_quartiles", i, f"ppm_q{i + 1}") for i in range(3)],
    _of_run(_PPM, "filtered_psms_ppm_error_mean", 0, "ppm_mean"), _of_run(_PPM, "filtered_psms_ppm_error_sigma", 0, "ppm_sigma"),
    _part("psm_charge_fractions", "PSM_charge_fractions", "charge - 1", ["charge", "fraction"]),
    _part("missed_cleavage_fractions", "PSM_missed_cleavages_fractions", "missed_cleavages", ["missed_cleavages", "fraction"]),
])
ORACLE["feature_report"] = "\nUNION ALL ".join([
    _part("feature_counts", "nr_features", "0", ["nr_features"]),
    _part("feature_counts", "nr_ident_features", "0", ["nr_ident_features"]),
    _part("feature_charge_fractions", "features_charges", "charge - 1", ["charge", "fraction"]),
    _part("ident_feature_charge_fractions", "ident_features_charge", "charge - 1", ["charge", "fraction"]),
])

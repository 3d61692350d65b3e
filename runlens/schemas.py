"""Names of the metrics and the layout of the metric tables.

``metrics`` (one row per run and metric): run_id, accession, short_name, name,
description, unit_accession, unit_name, kind, value_num, value_arr, value_str.
``metric_tables`` (one row per cell): run_id, accession, short_name, row_no,
column_no, column_accession, column_name, value_num, value_str.
"""

from __future__ import annotations

from typing import NamedTuple


class Metric(NamedTuple):
    accession: str
    name: str
    unit_accession: str = ""
    unit_name: str = ""
    description: str = ""


_COUNT = ("UO:0000189", "count unit")
_INTENSITY = ("MS:1000043", "intensity unit")
_SECOND = ("UO:0000010", "second")
_FRACTION = ("UO:0000191", "fraction")
_HERTZ = ("UO:0000106", "hertz")
_PPM = ("UO:0000169", "parts per million")

# Accession, name and unit of each metric, by short name.
METRICS = {
    "startTime": Metric("LOCAL:startTime", "Start time of MS since epoch"),
    "accumulated_MS1_TIC": Metric("MS:4000029", "area under TIC in MS1"),
    "accumulated_MS2_TIC": Metric("MS:4000030", "area under TIC in MS2"),
    "nr_MS1": Metric("MS:4000059", "number of MS1 spectra", *_COUNT),
    "nr_MS2": Metric("MS:4000060", "number of MS2 spectra", *_COUNT),
    "MS2_prec_charge_fraction": Metric("MS:4000063", "MS2 known precursor charges fractions"),
    "RT_range": Metric("MS:4000070", "retention time acquisition range", *_SECOND),
    "base_peak_intensity_max": Metric("MS:4000202", "base peak intensity maximum", *_INTENSITY),
    "total_ion_current_max": Metric("MS:4000204", "total ion current maximum", *_INTENSITY),
    "base_peak_intensity_maxima_per_time_range": Metric(
        "MS:4000203", "base peak intensity maxima per time ranges"),
    "total_ion_current_maxima_per_time_ranges": Metric(
        "MS:4000205", "total ion current maxima per time ranges"),
    "MS1_TIC": Metric("MS:4000211", "MS1 total ion current"),
    "MS1_map": Metric("LOCAL:rtMzIntensityMS1", "MS1 ion map data"),
    "MS2_TIC": Metric("MS:4000212", "MS2 total ion current"),
    "RT_MS1_quantiles": Metric("MS:4000184", "MS1 quantile RT fraction", *_FRACTION),
    "RT_MS2_quantiles": Metric("MS:4000185", "MS2 quantile RT fraction", *_FRACTION),
    "RT_TIC_quantiles": Metric("MS:4000183", "TIC quantile RT fraction", *_FRACTION),
    "MS1_freq_max": Metric("MS:4000065", "fastest frequency for MS level 1 collection", *_HERTZ),
    "MS2_freq_max": Metric("MS:4000066", "fastest frequency for MS level 2 collection", *_HERTZ),
    "MS1_density_quantiles": Metric("MS:4000061", "MS1 density quantiles", *_COUNT),
    "MS2_density_quantiles": Metric("MS:4000062", "MS2 density quantiles", *_COUNT),
    "MS1_TIC_change_quantiles": Metric("MS:4000186", "MS1 TIC-change quantile ratios", *_FRACTION),
    "MS1_TIC_quantiles": Metric("MS:4000187", "MS1 TIC quantile ratios", *_FRACTION),
    "nr_peptides": Metric("MS:1003250", "count of identified peptidoforms", *_COUNT),
    "nr_protein_groups": Metric("MS:1003327", "number of identified protein groups", *_COUNT),
    "nr_accessions": Metric(
        "MS:4000214", "number of all identified accessions in all ambiguity groups", *_COUNT),
    "nr_PSMs": Metric("MS:1003251", "count of identified spectra", *_COUNT),
    "PSM_charge_fractions": Metric("MS:4000209", "peptide spectrum matches charges fractions"),
    "PSM_missed_cleavages_fractions": Metric("MS:4000215", "missed cleavages fractions"),
    "filtered_psms_ppm_error_quartiles": Metric(
        "MS:4000206", "precursor ppm deviation distribution", *_PPM),
    "filtered_psms_ppm_error_mean": Metric("MS:4000178", "precursor ppm deviation mean", *_PPM),
    "filtered_psms_ppm_error_sigma": Metric("MS:4000179", "precursor ppm deviation sigma", *_PPM),
    "identified_psms_table": Metric(
        "LOCAL:identified_psms_table", "table of all unfiltered identified PSMs"),
    "nr_features": Metric("MS:4000102", "number of detected quantification data points", *_COUNT),
    "nr_ident_features": Metric(
        "MS:4000103", "number of identified quantification data points", *_COUNT),
    "features_charges": Metric(
        "MS:4000207", "detected quantification data points charges fractions"),
    "ident_features_charge": Metric(
        "MS:4000208", "identified quantification data points charges fractions"),
    "spike_in_metrics": Metric("MS:4000213", "characteristics of spike in and reference peptide"),
    "pump_pressure": Metric("MS:4000210", "vacuum pump pressure"),
    "bruker_calibrants": Metric("BRUKE_calibrants", "Bruker calibrant information"),
    "Extracted_Log_Headers": Metric("THERMO_LOG", "The selected extracted Thermo log headers."),
}

# What each metric tells, in our own words.
_DESCRIPTIONS = {
    "startTime": "Start of the acquisition in epoch seconds (UTC), -1 if unknown.",
    "accumulated_MS1_TIC": "Sum of the ion current of all MS1 spectra.",
    "accumulated_MS2_TIC": "Sum of the ion current of all MS2 spectra.",
    "nr_MS1": "How many MS1 spectra the run has.",
    "nr_MS2": "How many MS2 spectra the run has.",
    "MS2_prec_charge_fraction": "Share of MS2 spectra per precursor charge; 0 is unknown, the highest row includes all above.",
    "RT_range": "Retention times of the first and the last spectrum.",
    "base_peak_intensity_max": "Highest base peak of any spectrum.",
    "total_ion_current_max": "Highest ion current of any spectrum.",
    "base_peak_intensity_maxima_per_time_range": "Highest base peak from the start up to a time limit.",
    "total_ion_current_maxima_per_time_ranges": "Highest ion current from the start up to a time limit.",
    "MS1_TIC": "Ion current and retention time of every MS1 spectrum.",
    "MS1_map": "MS1 peaks above the noise limit.",
    "MS2_TIC": "Ion current and retention time of every MS2 spectrum.",
    "RT_MS1_quantiles": "Relative time spans between the quartiles of MS1 retention times.",
    "RT_MS2_quantiles": "Relative time spans between the quartiles of MS2 retention times.",
    "RT_TIC_quantiles": "Relative time spans in which each quarter of the ion current is acquired.",
    "MS1_freq_max": "Highest MS1 rate in any 60 seconds.",
    "MS2_freq_max": "Highest MS2 rate in any 60 seconds.",
    "MS1_density_quantiles": "Quartiles of the number of peaks per MS1 spectrum.",
    "MS2_density_quantiles": "Quartiles of the number of peaks per MS2 spectrum.",
    "MS1_TIC_change_quantiles": "log2 ratios of successive quartiles of the MS1 ion-current changes.",
    "MS1_TIC_quantiles": "log2 ratios of successive quartiles of the MS1 ion current.",
    "nr_peptides": "Identified peptidoforms.",
    "nr_protein_groups": "Identified protein groups.",
    "nr_accessions": "Distinct accessions in the identified protein groups.",
    "nr_PSMs": "Peptide-spectrum matches within the score limit.",
    "PSM_charge_fractions": "Share of accepted matches per charge; the highest row includes all above.",
    "PSM_missed_cleavages_fractions": "Share of accepted matches per number of missed cleavages; the highest row includes all above.",
    "filtered_psms_ppm_error_quartiles": "Quartiles of the mass error of accepted matches.",
    "filtered_psms_ppm_error_mean": "Mean mass error of accepted matches.",
    "filtered_psms_ppm_error_sigma": "Standard deviation of the mass error of accepted matches.",
    "identified_psms_table": "All target matches before the score limit.",
    "nr_features": "Quantification features found.",
    "nr_ident_features": "Quantification features with an identification.",
    "features_charges": "Share of features per charge; the highest row includes all above.",
    "ident_features_charge": "Share of identified features per charge; the highest row includes all above.",
    "spike_in_metrics": "Observed and expected values of the spike-in peptides.",
    "pump_pressure": "Pump pressure over time.",
    "bruker_calibrants": "Most intense peak near each calibrant over time.",
    "Extracted_Log_Headers": "Selected tune values of the run.",
}
METRICS = {short: m._replace(description=_DESCRIPTIONS[short]) for short, m in METRICS.items()}

# The header tables of the two vendors share a short name.
THERMO_HEADERS = {"Extracted_Headers": Metric("THERMO", "The selected extracted Thermo headers.")}
BRUKER_HEADERS = {"Extracted_Headers": Metric("BRUKER", "The selected extracted Bruker headers.")}
THERMO_KEY = ("THERMO", "Extracted_Headers")
BRUKER_KEY = ("BRUKER", "Extracted_Headers")

# Metrics of the summary table in its default order.
SUMMARY_ORDER = [
    "startTime",
    "RT_range",
    "nr_MS1",
    "nr_MS2",
    "accumulated_MS1_TIC",
    "accumulated_MS2_TIC",
    "base_peak_intensity_max",
    "total_ion_current_max",
    "base_peak_intensity_maxima_per_time_range",
    "total_ion_current_maxima_per_time_ranges",
    "MS2_prec_charge_fraction",
    "RT_MS1_quantiles",
    "RT_MS2_quantiles",
    "RT_TIC_quantiles",
    "MS1_freq_max",
    "MS2_freq_max",
    "MS1_density_quantiles",
    "MS2_density_quantiles",
    "MS1_TIC_change_quantiles",
    "MS1_TIC_quantiles",
    "nr_PSMs",
    "nr_peptides",
    "nr_protein_groups",
    "nr_accessions",
    "PSM_charge_fractions",
    "PSM_missed_cleavages_fractions",
    "nr_features",
    "nr_ident_features",
    "features_charges",
    "ident_features_charge",
    "spike_in_metrics",
]

# Tables of which the summary shows one value for each key.
SUMMARY_TABLES = (
    "MS2_prec_charge_fraction",
    "PSM_charge_fractions",
    "PSM_missed_cleavages_fractions",
    "features_charges",
    "ident_features_charge",
)

# The spike-in table and its columns as the summary names them.
SPIKEIN_TABLE = "spike_in_metrics"
SPIKEIN_LABEL = "proforma peptidoform sequence"
SPIKEIN_RT = "retention time"
SPIKEIN_EXPECTED_RT = "predicted retention time"
SPIKEIN_DELTA = "Delta_to_expected_RT"

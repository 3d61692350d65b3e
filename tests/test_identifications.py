import numpy as np
import pytest

from runlens.operators import features as f
from runlens.operators import identifications as i
from runlens.operators.records import peptide_identifications

PSM = ("run_id string, psm_id string, sequence string, accession string, unique int, retention_time double,"
       " charge int, missed_cleavages int, modifications string, exp_mz double, calc_mz double,"
       " spectra_ref string, fdr_score double, is_decoy int, position bigint")


def psm(run, pid, acc, charge=2, missed=0, exp=500.0, calc=500.0, score=0.001, decoy=0, pos=0):
    return (run, pid, "PEPTIDE", acc, 1, 60.0, charge, missed, None, exp, calc, "ref", score, decoy, pos)


@pytest.fixture
def psms(spark):
    return spark.createDataFrame([
        psm("a", "1", "P2", pos=2), psm("a", "1", "P1", pos=1), psm("a", "1", "P1", pos=3),
        psm("a", "2", "P3", charge=6, missed=4, score=0.01, exp=501.005, pos=4),
        psm("a", "3", "P4", charge=0, missed=9, exp=498.005, pos=5),
        psm("a", "4", "P5", score=0.010001, pos=6),
        psm("a", "5", "P6", decoy=1, pos=7),
        psm("a", "6", "P7", charge=1, missed=3, exp=500.5, pos=8),
        psm("b", "7", "P8", decoy=1, pos=1),
    ], PSM)


@pytest.fixture
def runs(spark):
    return spark.createDataFrame([("a",), ("b",)], "run_id string")


def test_grouping_and_filter(psms, runs, rows):
    grouped = i.group_psm_accessions(i.filter_target_psms(psms))
    assert rows(grouped, "psm_id", "accession") == [
        ("1", "P1,P2,P1"), ("2", "P3"), ("3", "P4"), ("4", "P5"), ("6", "P7")][:1] + [
        ("2", "P3"), ("3", "P4"), ("4", "P5"), ("6", "P7")]
    good = i.filter_fdr(grouped)
    assert rows(good, "psm_id") == [("1",), ("2",), ("3",), ("6",)]
    assert rows(i.count_psms(good, runs)) == [("a", 4), ("b", 0)]
    assert rows(i.count_psms(i.filter_fdr(grouped, 0.05))) == [("a", 5)]
    accepted = i.accepted_psms(i.filter_target_psms(psms))
    assert rows(accepted) == rows(good.drop("accession", "position"))
    full = i.psm_full_table(grouped)
    assert rows(full, "row_no", "psm_id") == [(k, p) for k, p in enumerate("12346")] and "psm_level_fdrscore" in full.columns


def test_mass_error(psms, runs, rows):
    good = i.filter_fdr(i.group_psm_accessions(i.filter_target_psms(psms)))
    ppm = {p: v for p, v in rows(i.ppm_error(good), "psm_id", "ppm")}
    # isotope steps +1 and -2 are taken out; half is rounded to even (0)
    assert ppm["1"] == 0.0
    assert ppm["2"] == pytest.approx(10.0) and ppm["3"] == pytest.approx(10.0)
    assert ppm["6"] == pytest.approx(1000.0)
    got = {r["run_id"]: r for r in i.ppm_summary(good, runs).collect()}
    values = list(ppm.values())
    assert [got["a"][c] for c in ("ppm_q1", "ppm_q2", "ppm_q3")] == pytest.approx(np.percentile(values, [25, 50, 75]))
    assert got["a"]["ppm_mean"] == pytest.approx(np.mean(values))
    assert got["a"]["ppm_sigma"] == pytest.approx(np.std(values))
    assert got["b"]["ppm_q1"] is None and got["b"]["ppm_sigma"] is None


def test_bucket_fractions(psms, runs, rows):
    good = i.filter_fdr(i.group_psm_accessions(i.filter_target_psms(psms)))
    charges = {(r, c): v for r, c, v in rows(i.psm_charge_fractions(good, runs))}
    # charge 0 is in no bucket but in the denominator
    assert [charges["a", c] for c in range(1, 7)] == [0.25, 0.25, 0, 0, 0, 0.25]
    assert all(charges["b", c] == 0 for c in range(1, 7))
    missed = {(r, c): v for r, c, v in rows(i.missed_cleavage_fractions(good, runs))}
    assert [missed["a", c] for c in range(5)] == [0.25, 0, 0, 0.25, 0.5]
    assert all(missed["b", c] == 0 for c in range(5))


def test_protein_and_peptide_counts(spark, runs, rows):
    proteins = spark.createDataFrame(
        [("a", "P1", None), ("a", "P2", "P1"), ("a", "P3", "P4, P5,P1"), ("a", "P3", None)],
        "run_id string, accession string, ambiguity_members string")
    assert rows(i.count_protein_groups(proteins, runs)) == [("a", 4), ("b", 0)]
    assert rows(i.count_accessions(proteins, runs=runs)) == [("a", 4), ("b", 0)]
    assert rows(i.count_accessions(proteins, split_members=True)) == [("a", 5)]
    peptides = spark.createDataFrame([("a", "X"), ("a", "X")], "run_id string, sequence string")
    assert rows(i.count_peptides(peptides, runs)) == [("a", 2), ("b", 0)]


def test_features(spark, rows):
    features = spark.createDataFrame(
        [("a", 1, 0, 1), ("a", 2, 1, 0), ("a", 3, 5, 2), ("a", 4, 6, 1), ("b", 5, 2, 0)],
        "run_id string, feature_id bigint, charge int, n_idents int")
    assert rows(f.feature_counts(features)) == [("a", 4, 3), ("b", 1, 0)]
    every = {(r, c): v for r, c, v in rows(f.feature_charge_fractions(features))}
    assert [every["a", c] for c in range(1, 7)] == [0.25, 0, 0, 0, 0.25, 0.25]
    found = {(r, c): v for r, c, v in rows(f.feature_charge_fractions(features, identified=True))}
    assert [found["a", c] for c in range(1, 7)] == pytest.approx([0, 0, 0, 0, 1 / 3, 1 / 3])
    assert all(found["b", c] is None for c in range(1, 7))
    idents = spark.createDataFrame([(1,), (1,), (4,)], "feature_id bigint")
    assert rows(f.identified_features(features, idents), "feature_id") == [(1,), (4,)]
    counted = f.features_with_idents(features, idents)
    assert rows(counted, "feature_id", "n_idents") == [(1, 2), (2, 0), (3, 0), (4, 1), (5, 0)]


def test_peptide_identifications(spark, psms):
    names = spark.createDataFrame([("a", "file:///x.raw")], "run_id string, run_name string")
    got = peptide_identifications(psms.withColumnRenamed("fdr_score", "score"), names).collect()
    assert {(r["run_id"], r["identifier"]) for r in got} == {("a", "file:///x.raw"), ("b", "unknown")}
    first = got[0]
    assert first["score_type"] == "q-value" and first["higher_score_better"] is False
    assert len(first["hits"]) == 1 and first["hits"][0]["rank"] == 1

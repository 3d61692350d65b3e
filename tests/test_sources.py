import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from runlens.operators import identifications, records, targeted
from runlens.sources import readers, sinks

MZTAB = """COM\tcomment
MTD\tms_run[1]-location\tfile:///data/{run}.raw
MTD\tpsm_search_engine_score[1]\t[MS, MS:1002257, Comet:expectation value, ]
MTD\tpsm_search_engine_score[2]\t[MS, MS:1002355, PSM-level FDRScore, ]
MTD\tpeptide_search_engine_score[3]\t[MS, MS:1002257, other, ]

PRH\taccession\tdescription\tambiguity_members
PRT\tP1\tx\tnull
PRT\tP2\ty\tP3,P4

PSH\tsequence\tPSM_ID\taccession\tunique\tretention_time\tcharge\topt_global_missed_cleavages\tmodifications\texp_mass_to_charge\tcalc_mass_to_charge\tspectra_ref\topt_global_cv_MS:1002217_decoy_peptide\tsearch_engine_score[1]\tsearch_engine_score[2]
PSM\tPEPTIDE\t1\tP2\t1\t60.5\t2\t0\tnull\t500.5\t500.5\tr:1\t0\t0.005\t0.01
PSM\tPEPTIDE\t1\tP1\t1\t60.5\t2\t0\tnull\t500.5\t500.5\tr:1\t0\t0.005\t0.01
PSM\tPEPTIDEK\t2\tP1\t0\tnull\t3\t1\t4-UNIMOD:21\t501\t500\tr:2\t1\t0.5\tnull
"""


@pytest.fixture
def mztab(tmp_path):
    folder = tmp_path / "mztab"
    folder.mkdir()
    for run in ("r1", "r2"):
        (folder / f"{run}.psms.mzTab").write_text(MZTAB.format(run=run))
    (folder / "empty.mzTab").write_text("COM\tnothing\n")
    # other column order, no score of either kind
    (folder / "r3.mzTab").write_text(
        "PSH\tcharge\tsequence\tretention_time\texp_mass_to_charge\nPSM\t2\tPEPTIDE\t7\t1.5\n")
    return str(folder)


def test_read_psms(spark, mztab, rows, join_way):
    psms = readers.read_psms(spark, mztab)
    assert rows(psms, "run_id", "psm_id", "sequence", "accession", "retention_time", "modifications", "fdr_score",
                "is_decoy")[:3] == [
        ("r1", "1", "PEPTIDE", "P1", 60.5, None, 0.01, 0), ("r1", "1", "PEPTIDE", "P2", 60.5, None, 0.01, 0),
        ("r1", "2", "PEPTIDEK", "P1", None, "4-UNIMOD:21", None, 1)]
    # accessions keep the order of the file
    good = identifications.filter_fdr(identifications.group_psm_accessions(identifications.filter_target_psms(psms)))
    assert rows(good, "run_id", "accession") == [("r1", "P2,P1"), ("r2", "P2,P1")]


def test_score_columns_and_targets(spark, mztab, rows):
    metadata = readers.read_mztab_metadata(spark, mztab)
    assert rows(readers.mztab_score_column(metadata)) == [
        ("r1", "search_engine_score[2]"), ("r2", "search_engine_score[2]")]
    assert rows(readers.mztab_score_column(metadata, readers.EXPECT_SCORE, True)) == [
        ("r1", "search_engine_score[1]"), ("r2", "search_engine_score[1]")]
    # without that rule the last line naming it counts
    assert rows(readers.mztab_score_column(metadata, readers.EXPECT_SCORE))[0][1] == "ide_search_engine_score[3]"
    targets = readers.read_target_psms(spark, mztab)
    assert rows(targets, "run_id", "sequence", "score") == [
        ("r1", "PEPTIDE", 0.005), ("r1", "PEPTIDE", 0.005), ("r1", "PEPTIDEK", 0.5),
        ("r2", "PEPTIDE", 0.005), ("r2", "PEPTIDE", 0.005), ("r2", "PEPTIDEK", 0.5), ("r3", "PEPTIDE", -1.0)]
    names = readers.read_run_names(spark, mztab)
    assert rows(names)[0] == ("r1", "file:///data/r1.raw")
    idents = records.peptide_identifications(targets, names)
    assert rows(idents.select("identifier").distinct()) == [
        ("file:///data/r1.raw",), ("file:///data/r2.raw",), ("unknown",)]


def test_read_proteins_and_peptides(spark, mztab, tmp_path, rows):
    proteins = readers.read_proteins(spark, mztab)
    assert rows(proteins)[:2] == [("r1", "P1", None), ("r1", "P2", "P3,P4")]
    assert rows(identifications.count_accessions(proteins))[0] == ("r1", 3)
    export = tmp_path / "r1.peptides.txt"
    export.write_text('"COLS_PEPTIDE",Sequence\nINFO,x\nPEPTIDE,AAK,"P1,P2",,"a ""b"" c"\nPEPTIDE,CCK\nCOLS_PSM,z\n')
    cells = {tuple(r["cells"]) for r in readers.read_peptide_export(spark, str(export)).collect()}
    assert cells == {("PEPTIDE", "AAK", "P1,P2", "", 'a "b" c'), ("PEPTIDE", "CCK")}
    assert rows(identifications.count_peptides(readers.read_peptide_export(spark, str(export)))) == [("r1", 2)]


def test_spikeins_and_counts(spark, tmp_path, rows):
    table = tmp_path / "r1.csv"
    table.write_text("RT,name,mz,sequence,rt-tol,mz-tol\n120,one,500.5,PEP[+1]TIDE,60,10 ppm\n")
    got = readers.read_spikeins(spark, str(table))
    assert rows(got.drop("position")) == [("r1", "one", "PEP[+1]TIDE", 500.5, 120.0, "10 ppm", 60.0)]
    counts = tmp_path / "r1.counts.csv"
    counts.write_text("AAK,1\nCCK,5\nAAK,2\n")
    assert rows(readers.read_ident_counts(spark, str(counts))) == [("r1", "AAK", 2), ("r1", "CCK", 5)]
    out = str(tmp_path / "counts")
    sinks.write_ident_counts(readers.read_ident_counts(spark, str(counts)), out)
    for path in (f"{out}/run_id=r1", out):
        assert rows(readers.read_ident_counts(spark, path), "run_id", "sequence", "count") == [("r1", "AAK", 2), ("r1", "CCK", 5)]


def documents(folder):
    """The one file of every run as another program reads it."""
    found = {}
    for run in Path(folder).glob("run_id=*"):
        (file,) = [p for p in run.iterdir() if not p.name.startswith((".", "_"))]
        with open(file) as f:
            found[run.name[7:]] = json.load(f)
    return found


@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_documents_of_many_parts(spark, tmp_path, size, monkeypatch):
    from runlens.operators import documents as d
    monkeypatch.setattr(d, "PART_BYTES", size)
    rows = [("hot", i, f"q{i:05d}", None if i % 50 == 0 else [i / 7, float(i)], None if i % 50 == 0 else [1e9 * i, float("nan")]) for i in range(600)]
    rows += [("other", 0, 'a "quoted"\nname', [], []), ("same", 1, "x", [1.0], [2.0]), ("same", 1, "x", [1.0], [2.0])]
    xics = spark.createDataFrame(rows, "run_id string, position int, comment string, retention_times array<double>, intensities array<double>")
    xics = xics.withColumns({c: F.lit(1.5) for c in ("mz_start", "mz_end", "rt_start", "rt_end")}).repartition(6)
    runs = spark.createDataFrame([("hot",), ("none",)], "run_id string")
    sinks.write_xic_results(xics, str(tmp_path / "x"), runs)
    found = documents(tmp_path / "x")
    assert set(found) == {"hot", "other", "same", "none"} and found["none"]["Content"] == []
    assert [x["Meta"]["Comment"] for x in found["hot"]["Content"]] == [f"q{i:05d}" for i in range(600)]
    assert found["hot"]["Content"][599]["RetentionTimes"] == [599 / 7, 599.0] and found["hot"]["Content"][599]["Intensities"] == [599e9, None]
    assert found["hot"]["Content"][50]["Intensities"] is None
    assert found["other"]["Content"][0]["Meta"]["Comment"] == 'a "quoted"\nname' and len(found["same"]["Content"]) == 2


def test_xic_files(spark, tmp_path, rows):
    result = tmp_path / "r1.json"
    result.write_text(json.dumps({"OutputMeta": {"base64": False, "timeunit": "minutes"}, "Content": [
        {"Meta": {"MzStart": 1.0, "MzEnd": 2.0, "RtStart": 0.0, "RtEnd": 9.0, "Comment": "one"},
         "RetentionTimes": [0.5, 1.0], "Intensities": [3.0, 4.0]},
        {"Meta": {"MzStart": 1.0, "MzEnd": 2.0, "RtStart": 0.0, "RtEnd": 9.0, "Comment": "none"},
         "RetentionTimes": None, "Intensities": None}]}, indent=2))
    xics = readers.read_xic_results(spark, str(result))
    assert rows(targeted.xic_apex_of_arrays(xics)) == [("r1", "none", 0.0, -1.0), ("r1", "one", 4.0, 60.0)]
    out = str(tmp_path / "xics")
    sinks.write_xic_results(xics, out)
    columns = [c for c in xics.columns if c != "position"]
    assert rows(readers.read_xic_results(spark, f"{out}/run_id=r1/*"), *columns) == rows(xics, *columns)
    assert rows(readers.read_xic_results(spark, out), *columns) == rows(xics, *columns)
    assert documents(out) == {"r1": json.loads(result.read_text())}
    queries = tmp_path / "r1.queries.json"
    queries.write_text(json.dumps([{"comment": "one", "mz": 500.0, "tolerance": 10.0, "tolerance_unit": "ppm",
                                    "rt_start": 0.0, "rt_end": 2.0}] * 2, indent=4))
    read = readers.read_xic_queries(spark, str(queries))
    assert read.count() == 2 and read.first()["tolerance_unit"] == "ppm"
    sinks.write_xic_queries(read, str(tmp_path / "queries"))
    assert documents(tmp_path / "queries") == {"r1": json.loads(queries.read_text())}
    assert rows(readers.read_xic_queries(spark, str(tmp_path / "queries"))) == rows(read)


def test_xic_arrays_round_trip(spark, rows):
    points = spark.createDataFrame([("a", "q", 2, 0.2, 500.0, 9.0), ("a", "q", 1, 0.1, 500.0, 3.0)],
                                   "run_id string, comment string, scan_no bigint, rt double, mz double, intensity double")
    queries = spark.createDataFrame([("a", "q", 500.0, 10.0, "ppm", 0.0, 1.0), ("a", "x", 1.0, 10.0, "ppm", 0.0, 1.0)],
                                    "run_id string, comment string, mz double, tolerance double,"
                                    " tolerance_unit string, rt_start double, rt_end double")
    got = {r["comment"]: r for r in targeted.xic_arrays(points, queries).collect()}
    assert got["q"]["retention_times"] == [0.1, 0.2] and got["q"]["intensities"] == [3.0, 9.0]
    assert got["x"]["intensities"] == []


@pytest.mark.parametrize("fmt, sep", [("csv", ","), ("tsv", "\t")])
def test_write_summary(spark, tmp_path, fmt, sep):
    sinks.write_summary(spark.createDataFrame([("a", 1.5)], "run_id string, x double"), str(tmp_path / fmt), fmt)
    files = [p.read_text().splitlines() for p in (tmp_path / fmt).glob("*.csv")]
    assert all(lines[0] == f"run_id{sep}x" for lines in files)
    assert [line for lines in files for line in lines[1:]] == [f"a{sep}1.5"]
    with pytest.raises(ValueError):
        sinks.write_summary(spark.range(1), str(tmp_path / "no"), "xlsx")


def test_lines_are_stored_and_moved_no_more_than_needed(spark, mztab, monkeypatch):
    from runlens.operators import documents as d
    stored = []
    monkeypatch.setattr(readers, "write_table", lambda df, name: stored.append(df) or df)
    lines = readers.scan_mztab(spark, mztab)
    (heads,) = stored
    assert {r.tag for r in heads.collect()} <= {"MTD", "PRH", "PSH"} and {"PSM", "PRT"} <= {r.tag for r in lines.collect()}
    monkeypatch.setattr(d, "write_table", None)
    rows = spark.createDataFrame([("a", i % 7, f"line {i}") for i in range(100)] + [(None, 1, "x"), ("a", 1, None)],
                                 "run_id string, no int, line string")
    parts = d.document_parts(rows, ["no", "line"])
    assert parts._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    text = "\n".join(r.text for r in sorted(parts.collect(), key=lambda r: r.part))
    assert text.split("\n") == [x for _, x in sorted((i % 7, f"line {i}") for i in range(100))]

"""File ingestion (S2-S8, K1-K5, P1, P2, U0) and the end-to-end pipeline (Q3)."""

import os

import pytest
from pyspark.sql import functions as F

from zonescope.plans.pipeline import run_pipeline
from zonescope.plans.queries import Models, round_doubles
from zonescope.sources import files as ing
from zonescope.sources.adapter import raw_datasets
from zonescope.sources.specs import DEFAULT_SPECS, DatasetSpec

from conftest import SF_SMALL


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_discover_skips_hidden_and_empty(spark, workdir):
    _write(f"{workdir}/d/a.csv", "x\n1\n")
    _write(f"{workdir}/d/b.txt", "x\n2\n")
    _write(f"{workdir}/d/.hidden.csv", "x\n3\n")
    _write(f"{workdir}/d/empty.csv", "")
    names = [os.path.basename(f.path) for f in ing.discover_files(spark, workdir, "d/*")]
    assert names == ["a.csv", "b.txt"]
    assert [os.path.basename(f.path) for f in ing.discover_files(spark, workdir, "d/*.csv")] == ["a.csv"]
    assert ing.discover_files(spark, workdir, "missing/*") == []


def test_headers_grouped_by_name(spark, workdir):
    _write(f"{workdir}/lab/one.csv", "code_commune,Nom Commune,is_littoral\n01001,Alpha,oui\n")
    _write(f"{workdir}/lab/two.csv", "is_littoral,code_commune,Nom Commune\nnon,01002,Beta\n")
    _write(f"{workdir}/lab/three.csv", "code_commune,nom_commune,is_littoral,extra\n01003,\"Gamma, la\",1,x\n")
    spec = DatasetSpec("tourism_labels", "lab/*", "csv", ",", "tourism_labels", True, ("code_commune",))
    df = ing.read_source_files(spark, spec, ing.discover_files(spark, workdir, spec.path_glob))
    rows = {r.code_commune: r for r in df.collect()}
    assert rows["01001"].nom_commune == "Alpha" and rows["01001"].is_littoral == "oui"
    assert rows["01002"].nom_commune == "Beta" and rows["01002"].is_littoral == "non"
    assert rows["01003"].nom_commune == "Gamma, la" and rows["01003"].extra == "x"
    assert rows["01001"].extra is None      # codes keep their leading zeros (read as text)


def test_guards(spark, workdir):
    required = DatasetSpec("need", "none/*", "csv", ",", "need", True, ("a",))
    with pytest.raises(FileNotFoundError):
        ing.ingest_dataset(spark, required, workdir, f"{workdir}/bronze", "2024-01-01")
    optional = DatasetSpec("opt", "none/*", "csv", ",", "opt", False, ("a", "b"))
    assert ing.ingest_dataset(spark, optional, workdir, f"{workdir}/bronze", "2024-01-01")["rows"] == 0
    empty = ing.read_bronze(spark, optional, f"{workdir}/bronze")
    assert empty.count() == 0 and {"a", "b", "_source_file"} <= set(empty.columns)
    with pytest.raises(ValueError):
        ing.read_source_files(spark, DatasetSpec("x", "d/*", "xlsx"), [])


def test_snapshots_replace_and_accumulate(spark, workdir):
    _write(f"{workdir}/m/a.csv", "code_commune,nom_commune,minutes_to_gare\n01001,A,12 min\n01002,B,\n")
    spec = DatasetSpec("mobility_access", "m/*", "csv", ",", "mobility_access", True,
                       DEFAULT_SPECS["mobility_access"].expected_columns)
    bronze = f"{workdir}/bronze"
    assert ing.ingest_dataset(spark, spec, workdir, bronze, "2024-01-01")["rows"] == 2
    ing.ingest_dataset(spark, spec, workdir, bronze, "2024-01-01")          # same snapshot: replaced
    assert ing.read_bronze(spark, spec, bronze).count() == 2
    ing.ingest_dataset(spark, spec, workdir, bronze, "2024-02-01")          # new snapshot: both kept
    raw = ing.read_bronze(spark, spec, bronze)
    assert raw.count() == 4 and raw.where(F.col("minutes_to_airport").isNotNull()).count() == 0
    assert ing.read_bronze(spark, spec, bronze, latest_snapshot_only=True).count() == 2
    counts = {r._snapshot_date: r.n for r in raw.groupBy("_snapshot_date").agg(F.count("*").alias("n")).collect()}
    assert counts == {"2024-01-01": 2, "2024-02-01": 2}
    assert ing.ingest_counts(raw).first().row_count == 4
    assert raw.first()._source_file == "m/a.csv"


def _render_drop(spark, root):
    """Write the adapter's raw datasets as a drop folder of CSV files."""
    raw = raw_datasets(spark, SF_SMALL)
    raw.pop("cadastre_reference")  # a Parquet drop; this test writes CSV drops
    for name, spec in DEFAULT_SPECS.items():
        if name not in raw:
            continue
        folder = os.path.join(root, os.path.dirname(spec.path_glob))
        (raw[name].select(*spec.expected_columns).coalesce(1).write.mode("overwrite")
         .option("header", True).option("sep", spec.delimiter).csv(folder))
    # noise the reader must ignore
    _write(os.path.join(root, "tourism/labels/.notes.csv"), "code_commune\nzz\n")
    _write(os.path.join(root, "tourism/labels/empty.csv"), "")


def test_pipeline_round_trip(spark, workdir):
    _render_drop(spark, f"{workdir}/external")
    result = run_pipeline(spark, f"{workdir}/external", f"{workdir}/lake", snapshot_date="2024-06-30", on_test_failure="report")
    by_name = {s["dataset"]: s for s in result.ingestion}
    assert by_name["dvf_mutations"]["rows"] == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert by_name["cadastre_reference"]["files"] == 0
    expected = round_doubles(Models(spark, SF_SMALL).scores)
    got = round_doubles(result.marts["location_tourism_score_latest"])
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    tests = {(r.model, r.column_name): r.failing for r in result.tests.collect()}
    assert tests[("location_tourism_score_latest", "zone_id")] == 0
    assert tests[("stg_dvf_transactions", "transaction_id")] == 0


def test_raw_write_modes_and_serving_guard(spark, workdir):
    from zonescope.operators.serving import SERVING_COLUMNS, load_scores

    df = spark.createDataFrame([("a",), ("b",)], "x string")
    ing.write_raw(df, f"{workdir}/raw_t", "replace")
    ing.write_raw(df, f"{workdir}/raw_t", "append")
    assert spark.read.parquet(f"{workdir}/raw_t").count() == 4
    ing.write_raw(df, f"{workdir}/raw_t", "replace")
    assert spark.read.parquet(f"{workdir}/raw_t").count() == 2
    with pytest.raises(ValueError):
        ing.write_raw(df, f"{workdir}/raw_t", "merge")
    assert load_scores(spark, "no_such_scores_table") is None
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in SERVING_COLUMNS))
    empty.createOrReplaceTempView("empty_scores")
    with pytest.raises(LookupError):
        load_scores(spark, "empty_scores")


def test_pipeline_retries_once(spark, workdir, monkeypatch):
    from zonescope.plans import pipeline

    calls = []
    real = pipeline._run_once

    def flaky(*args):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("executor lost")
        return real(*args)

    monkeypatch.setattr(pipeline, "_run_once", flaky)
    _write(f"{workdir}/external/dvf/a.csv", "date_mutation|valeur_fonciere|code_commune|nom_commune\n"
                                            "2024-01-15|100000|01001|A\n")
    for folder in ("tourism/poi", "tourism/labels", "accessibility"):
        _write(f"{workdir}/external/{folder}/a.csv", "code_commune,nom_commune\n01001,A\n")
    result = pipeline.run_pipeline(spark, f"{workdir}/external", f"{workdir}/lake", snapshot_date="2024-06-30", on_test_failure="report")
    assert len(calls) == 2
    assert result.marts["location_tourism_score_latest"].count() == 1
    with pytest.raises(FileNotFoundError):   # a missing required source is not retried
        pipeline.run_pipeline(spark, f"{workdir}/nothing", f"{workdir}/lake2", on_test_failure="report")


def test_multiline_spec_and_manifest(spark, workdir):
    _write(f"{workdir}/ml/a.csv", 'code_commune,nom_commune\n01001,"Saint-\nDenis"\n01002,B\n')
    _write(f"{workdir}/manifest.yml", "datasets:\n  geo:\n    path_glob: ml/*\n    required_for_mvp: true\n"
                                      "    multiline: true\n    expected_columns: [code_commune, nom_commune]\n")
    from zonescope.sources.specs import load_manifest

    spec = load_manifest(f"{workdir}/manifest.yml")["geo"]
    assert spec.multiline and spec.required and spec.expected_columns == ("code_commune", "nom_commune")
    assert ing.ingest_dataset(spark, spec, workdir, f"{workdir}/bronze", "2024-01-01")["rows"] == 2
    names = {r.code_commune: r.nom_commune for r in ing.read_bronze(spark, spec, f"{workdir}/bronze").collect()}
    assert names == {"01001": "Saint-\nDenis", "01002": "B"}


def _geo_spec(**options):
    return DatasetSpec("geo", "in/*", "csv", ",", "geo", True, ("code_commune", "nom_commune"), **options)


def test_quoted_line_breaks_are_found_per_file(spark, workdir):
    _write(f"{workdir}/in/a.csv", 'code_commune,nom_commune\n01001,"Saint-\nDenis ""sur"" mer"\n01002,B\n')
    _write(f"{workdir}/in/b c%.csv", '\nnom_commune,code_commune\n"C ""x""",01003\n')  # quotes, but no line break; a blank first line
    _write(f"{workdir}/in/d.csv", '"Code\nCommune",nom_commune\n01004,D\n')  # a line break in the header itself
    _write(f"{workdir}/in/e.csv", "code_commune,nom_commune\r\n01005,E\r\n")
    spec = _geo_spec()
    files = ing.discover_files(spark, workdir, spec.path_glob)
    spark.sparkContext.setJobGroup("shapes", "shapes")
    try:
        shapes = {path.rpartition("/")[2]: shape for path, shape in ing.csv_shapes(spark, spec, [f.path for f in files if not f.path.endswith("d.csv")]).items()}
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("shapes")) <= 2  # not one a file (adaptive execution counts a shuffle as a job)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {name: shape.spans_lines for name, shape in shapes.items()} == {"a.csv": True, "b c%.csv": False, "e.csv": False}
    assert shapes["b c%.csv"].header == ("nom_commune", "code_commune")
    summary = ing.ingest_dataset(spark, spec, workdir, f"{workdir}/bronze", "2024-01-01")
    assert summary == {"dataset": "geo", "files": 4, "rows": 5, "torn": 0}
    names = {r.code_commune: r.nom_commune for r in ing.read_bronze(spark, spec, f"{workdir}/bronze").collect()}
    assert names == {"01001": 'Saint-\nDenis "sur" mer', "01002": "B", "01003": 'C "x"', "01004": "D", "01005": "E"}


def test_torn_rows_are_counted(spark, workdir):
    _write(f"{workdir}/in/a.csv", "code_commune,nom_commune\n01001,A\n01002\n01003,C,too many\n01004,D\n")
    _write(f"{workdir}/in/b.csv", 'code_commune,nom_commune\n01005,"open\nquote"\n')
    spec = _geo_spec()
    assert ing.ingest_dataset(spark, spec, workdir, f"{workdir}/bronze", "2024-01-01") == {"dataset": "geo", "files": 2, "rows": 5, "torn": 2}
    rows = {r.code_commune: r.nom_commune for r in ing.read_bronze(spark, spec, f"{workdir}/bronze").collect()}
    assert rows == {"01001": "A", "01002": None, "01003": "C", "01004": "D", "01005": "open\nquote"}
    assert ing.ingest_dataset(spark, _geo_spec(multiline=False), workdir, f"{workdir}/bronze", "2024-01-02")["torn"] == 3  # the opened cell reads as a whole row, its rest is torn
    with pytest.raises(ing.TornRowsError, match="2 of 5 rows"):
        ing.ingest_dataset(spark, spec, workdir, f"{workdir}/bronze", "2024-01-03", fail_on_torn=True)

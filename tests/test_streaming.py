"""Incremental sales ingestion (ST1) equals the batch computation."""

import os

from zonescope.operators.monthly import zone_month_prices
from zonescope.operators.staging import sales_fact, stg_sales
from zonescope.plans.queries import round_doubles
from zonescope.sources.adapter import raw_dataset
from zonescope.sources.specs import DEFAULT_SPECS
from zonescope.streaming.incremental import read_monthly_mart, start_sales_stream

from conftest import SF_SMALL


def test_stream_matches_batch(spark, workdir):
    spec = DEFAULT_SPECS["dvf_mutations"]
    raw = raw_dataset(spark, SF_SMALL, "dvf_mutations")
    drop = os.path.join(workdir, "external", "dvf")
    first = raw.where("_source_file < 'dvf/ventes_1998'")
    second = raw.where("_source_file >= 'dvf/ventes_1998'")
    first.select(*spec.expected_columns).coalesce(2).write.option("header", True).option("sep", "|").csv(drop + "/a")
    ckpt = os.path.join(workdir, "ckpt")
    lake = os.path.join(workdir, "lake")
    # the stream reads the folder's files; move the first drop in place
    for name in os.listdir(drop + "/a"):
        if name.endswith(".csv"):
            os.replace(os.path.join(drop, "a", name), os.path.join(drop, "1-" + name))
    q = start_sales_stream(spark, os.path.join(workdir, "external"), lake, "2024-06-30", checkpoint=ckpt,
                           max_files_per_trigger=1)
    q.awaitTermination()
    # a second drop arrives later, including sales for months already published
    second.select(*spec.expected_columns).coalesce(1).write.option("header", True).option("sep", "|").csv(drop + "/b")
    for name in os.listdir(drop + "/b"):
        if name.endswith(".csv"):
            os.replace(os.path.join(drop, "b", name), os.path.join(drop, "2-" + name))
    q = start_sales_stream(spark, os.path.join(workdir, "external"), lake, "2024-06-30", checkpoint=ckpt)
    q.awaitTermination()
    got = round_doubles(read_monthly_mart(spark, lake))
    want = round_doubles(zone_month_prices(sales_fact(stg_sales(raw))))
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _dropped(spark, workdir, lines: dict):
    """The given files (name -> lines) in the drop folder, and the frame of their paths and sizes."""
    folder = os.path.join(workdir, "external", "dvf")
    os.makedirs(folder, exist_ok=True)
    rows = []
    for name, text in lines.items():
        path = os.path.join(folder, name)
        with open(path, "w") as handle:
            handle.write("\n".join(text) + "\n")
        rows.append((path, os.path.getsize(path)))
    return spark.createDataFrame(rows, "path string, length long")


def _sales_lines(columns, rows):
    return ["|".join(columns), *("|".join(r.get(c, "") for c in columns) for r in rows)]


def _sale(n, **cells):
    return {"id_mutation": f"m{n}", "id_parcelle": f"p{n}", "date_mutation": f"2024-0{1 + n % 3}-05", "nature_mutation": "Vente",
            "code_commune": "01001", "nom_commune": "A", "valeur_fonciere": str(100000 + n), "surface_reelle_bati": "50"} | cells


def _batch_mart(spark, workdir, spec):
    from zonescope.sources.files import ingest_dataset, read_bronze

    ingest_dataset(spark, spec, f"{workdir}/external", f"{workdir}/batch", "2024-06-30")
    return round_doubles(zone_month_prices(sales_fact(stg_sales(read_bronze(spark, spec, f"{workdir}/batch")))))


def test_stream_takes_markers_and_headers_as_batch_does(spark, workdir):
    spec = DEFAULT_SPECS["dvf_mutations"]
    columns = list(spec.expected_columns)
    _dropped(spark, workdir, {
        "1.csv": _sales_lines(columns, [_sale(0), _sale(1, code_commune="NA")]),
        "2.csv": _sales_lines(columns[::-1], [_sale(2), _sale(3, date_mutation="null")]),
        "3.csv": _sales_lines([c for c in columns if c != "nom_commune"], [_sale(4), _sale(5)]),
    })
    for checkpoint in ("one", "lost-and-new"):     # the second reads every file again, as a run of its own
        start_sales_stream(spark, f"{workdir}/external", f"{workdir}/lake", "2024-06-30",
                           checkpoint=f"{workdir}/{checkpoint}", max_files_per_trigger=1).awaitTermination()
        got = round_doubles(read_monthly_mart(spark, f"{workdir}/lake"))
        want = _batch_mart(spark, workdir, spec)
        assert {r["zone_id"] for r in got.collect()} == {"01001"}
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_replay_after_a_crash_between_silver_and_mart(spark, workdir, monkeypatch):
    import pytest

    from zonescope.streaming import incremental

    spec = DEFAULT_SPECS["dvf_mutations"]
    columns = list(spec.expected_columns)
    first = _dropped(spark, workdir, {"1.csv": _sales_lines(columns, [_sale(n) for n in range(6)])})
    second = _dropped(spark, workdir, {"2.csv": _sales_lines(columns, [_sale(n) for n in range(6, 9)])})
    args = (spec, f"{workdir}/external", f"{workdir}/lake/bronze/dvf_mutations",
            f"{workdir}/lake/marts/real_estate_zone_monthly", "2024-06-30")
    incremental.process_batch(spark, first, 0, *args)

    def crash(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "zone_month_prices", crash)
        with pytest.raises(RuntimeError):
            incremental.process_batch(spark, second, 1, *args)
    incremental.process_batch(spark, second, 1, *args)
    incremental.process_batch(spark, second, 1, *args)     # and the same epoch once more
    assert spark.read.parquet(f"{workdir}/lake/silver/fact_real_estate_transactions").count() == 9
    got = round_doubles(read_monthly_mart(spark, f"{workdir}/lake"))
    want = _batch_mart(spark, workdir, spec)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _silver_files(workdir):
    from pathlib import Path

    root = Path(workdir) / "lake/silver/fact_real_estate_transactions/_run=0"
    return {month.name: len(list(month.rglob("part-*.parquet"))) for month in root.iterdir() if month.is_dir()}


def _same_as_batch(spark, workdir, spec):
    got, want = round_doubles(read_monthly_mart(spark, f"{workdir}/lake")), _batch_mart(spark, workdir, spec)
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_files_per_month_stay_bounded(spark, workdir):
    """Twenty epochs that reopen the same months, unreadable dates among them."""
    from zonescope.streaming import incremental

    spec = DEFAULT_SPECS["dvf_mutations"]
    columns = list(spec.expected_columns)
    args = (spec, f"{workdir}/external", f"{workdir}/lake/bronze/dvf_mutations", f"{workdir}/lake/marts/real_estate_zone_monthly", "2024-06-30")
    for epoch in range(20):
        sales = [_sale(epoch), _sale(100 + epoch, date_mutation="2024-01-05"), _sale(200 + epoch, date_mutation="bad")]
        files = _dropped(spark, workdir, {f"{epoch}.csv": _sales_lines(columns, sales)})
        incremental.process_batch(spark, files, epoch, *args, most_epochs=3)
    counts = _silver_files(workdir)
    assert set(counts) == {"month_key=2024-01-01", "month_key=2024-02-01", "month_key=2024-03-01", f"month_key={incremental.NO_MONTH}"}
    assert max(counts.values()) <= 4
    assert _same_as_batch(spark, workdir, spec)
    silver = f"{workdir}/lake/silver/fact_real_estate_transactions"
    assert spark.read.parquet(silver).count() == 60  # nothing is left of what was merged


def test_crashes_around_a_compaction(spark, workdir, monkeypatch):
    """Lost between the write and the marker, and between the marker and the deletion; then a replay of a merged epoch."""
    import pytest

    from zonescope.streaming import incremental

    spec = DEFAULT_SPECS["dvf_mutations"]
    columns = list(spec.expected_columns)
    args = (spec, f"{workdir}/external", f"{workdir}/lake/bronze/dvf_mutations", f"{workdir}/lake/marts/real_estate_zone_monthly", "2024-06-30")
    drops = {}

    def epoch(n, **options):
        if n not in drops:
            drops[n] = _dropped(spark, workdir, {f"{n}.csv": _sales_lines(columns, [_sale(n, date_mutation="2024-01-05"), _sale(50 + n, date_mutation="bad")])})
        incremental.process_batch(spark, drops[n], n, *args, most_epochs=2, **options)

    def crash(*_, **__):
        raise RuntimeError("lost")

    silver = f"{workdir}/lake/silver/fact_real_estate_transactions"
    schema = None
    for n in range(2):
        epoch(n)
    for point in ("_mark", "_delete_merged"):
        n = len(drops)
        with monkeypatch.context() as patch:
            patch.setattr(incremental, point, crash)
            with pytest.raises(RuntimeError):
                epoch(n)
        schema = spark.read.parquet(silver).schema
        assert incremental.valid_silver(spark, silver, schema, "0").count() == 2 * len(drops)  # each row once, whatever lies about
        epoch(n)
        assert incremental.valid_silver(spark, silver, schema, "0").count() == 2 * len(drops)
        assert _same_as_batch(spark, workdir, spec)
        for _ in range(2):
            epoch(len(drops))
    epoch(0)  # merged long ago
    assert incremental.valid_silver(spark, silver, schema, "0").count() == 2 * len(drops)
    assert _same_as_batch(spark, workdir, spec) and max(_silver_files(workdir).values()) <= 4

"""What the incremental job leaves on disk: compressed deliveries and tables, no second copy of stored sales."""

import glob
from types import SimpleNamespace

from pyspark.sql import functions as F

from zonescope.operators.monthly import zone_month_prices
from zonescope.operators.staging import sales_fact, stg_sales
from zonescope.plans import extensions
from zonescope.session import Scratch
from zonescope.sources.files import with_raw_columns
from zonescope.sources.specs import DEFAULT_SPECS

SPEC = DEFAULT_SPECS["dvf_mutations"]


def raw_sales(spark):
    rows = []
    for i in range(240):
        date = ["inconnue", f"2023-0{1 + i % 4}-15", f"1{i % 9}/0{1 + i % 3}/2022"][i % 3]
        zone = ["", f"0{i % 7}001", None][0 if i % 11 == 0 else 2 if i % 13 == 0 else 1]
        label = 'Rue "A"|B' if i % 5 == 0 else None if i % 17 == 0 else f"Commune {i % 7}"
        rows.append((date, "Vente", f"{1000 + i * 37},5 EUR", zone, zone, label, "01", "Maison", str(i % 6), str(i % 40), "3", None if i % 8 == 0 else "2.5", "48.1", f"p{i}"))
    rows += rows[:30]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SPEC.expected_columns))


def plain(df):
    """Rows in order; the last digits of a mean follow the order of its sums."""
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r]) for r in df.collect())


def test_deliveries_and_lake_are_compressed_and_no_sale_is_lost(spark, monkeypatch):
    made = []
    monkeypatch.setattr(extensions, "scratch_path", lambda s, name, path=extensions.scratch_path: made.append(path(s, name)) or made[-1])
    monkeypatch.setattr(extensions, "ROWS_PER_DELIVERED_FILE", 40)
    raw = raw_sales(spark).coalesce(1)
    got = extensions.incremental_zone_month(SimpleNamespace(spark=spark, raw={SPEC.name: raw}))
    fact = sales_fact(stg_sales(with_raw_columns(raw, SPEC)))
    key = ["zone_id", "month_key"]
    assert plain(got) == plain(zone_month_prices(fact).select(got.columns))
    assert got.agg(F.sum("transaction_count")).first()[0] == fact.where("zone_id is not null").count() and got.select(*key).distinct().count() == got.count()
    run = made[0].removeprefix("file:")
    files = glob.glob(f"{run}/external/dvf/part-*")
    assert len(files) >= 270 // 40 and all(f.endswith(".csv.gz") for f in files)
    for table in ("bronze", "silver"):
        files = glob.glob(f"{run}/lake/{table}/**/*.parquet", recursive=True)
        assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_a_stored_fact_is_not_written_anew(spark, monkeypatch):
    fact = sales_fact(stg_sales(with_raw_columns(raw_sales(spark), SPEC)))
    sizes, written = [], Scratch.written
    monkeypatch.setattr(Scratch, "written", lambda self, df: sizes.append(df.count()) or written(self, df))
    rows = [plain(zone_month_prices(fact, scratch=Scratch(spark, "t"), stored=stored)) for stored in (False, True)]
    assert rows[0] == rows[1] and sizes == [fact.where("zone_id is not null").count(), 0, 0]

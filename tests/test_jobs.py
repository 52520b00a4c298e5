import pytest

from fundlake.jobs import build_parser, run
from fundlake.plans.normalise import run_auto_pipeline
from fundlake.sources.prepared import table_names


def test_normalise_stack_and_obt(spark, raw, tmp_path):
    parse = build_parser().parse_args
    for group, name in (("h15", "RO_99ZZ_20240801_20250731.csv"), ("h17", "GRONDSLAG_IP_MBO_77XX_20251119_2025.csv")):
        target = f"{tmp_path}/prepared/{group}/{name.removesuffix('.csv')}"
        line = run(spark, parse(["normalise", f"{raw}/{group}/{name}", target]))
        assert line.startswith("Verwerkt: ")
    sources = [str(p) for p in sorted((tmp_path / "prepared").glob("*/*"))]
    relative = ["--relative-to", f"{tmp_path}/prepared"]
    assert "rijen" in run(spark, parse(["stack", *sources, "--output", f"{tmp_path}/s", "--label-col", "bron", *relative]))
    stacked = spark.read.parquet(f"{tmp_path}/s/ISP.parquet")
    assert stacked.columns[0] == "bron" and stacked.count() == 4
    assert run(spark, parse(["obt", *sources, "--output", f"{tmp_path}/o", *relative])).startswith("obt: 5 tabellen")
    wide = spark.read.parquet(f"{tmp_path}/o/obt_inschrijvingen.parquet")
    assert wide.count() == 4 and wide.where("levering = 'h15/RO_99ZZ_20240801_20250731'").count() == 3
    assert len(table_names(spark, f"{tmp_path}/o")) == 5


def test_csv_output_and_unknown_names(spark, raw, tmp_path):
    source = f"{raw}/h15/ro_88YY_20240801_20250731.CSV"
    frames = run_auto_pipeline(spark, source, f"{tmp_path}/csv", "csv")
    assert (tmp_path / "csv" / "VLP.csv").is_dir() and "levering" not in frames["VLP"].columns
    with pytest.raises(ValueError, match="Onbekend bestandstype.*grondslag"):
        run_auto_pipeline(spark, f"{raw}/h15/notes.txt", f"{tmp_path}/x")
    with pytest.raises(ValueError, match="Onbekend formaat"):
        run_auto_pipeline(spark, source, f"{tmp_path}/y", "xml")

"""Labels that several files would have, and landing folders without deliveries."""

import pytest
from conftest import RO_PIPE, TBGI

from fundlake.plans import landing
from fundlake.plans.landing import normalise_landing
from fundlake.session import work_area
from fundlake.sources.discovery import delivery_label, discover, plain_root, shared_labels
from fundlake.sources.files import children
from pyspark.sql import functions as F


def write(root, files):
    for name, text in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(root)


def test_deliveries_of_one_name_stay_apart(spark, tmp_path):
    bare = "\n".join(line for line in RO_PIPE.splitlines() if not line.startswith("VLP"))
    raw = write(
        tmp_path / "raw",
        {
            "h15/a/RO_1.csv": RO_PIPE, "h15/b/RO_1.csv": RO_PIPE, "h15/c/RO_1.csv": bare, "h15/RO_2.csv": RO_PIPE,
            "h16/a/TBGI_1.xml": TBGI, "h16/b/TBGI_1.xml": TBGI,
        },
    )
    assert shared_labels(discover(spark, raw)) == ["h15/RO_1", "h16/TBGI_1"]
    with work_area(spark):
        written, quarantine = normalise_landing(spark, raw, f"{tmp_path}/prepared")
        assert quarantine.collect() == []
    labels = {
        family: sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/prepared/{family}/{table}.parquet").select("levering").distinct().collect())
        for family, table in (("ro", "PER"), ("tbgi", "Inschrijving"))
    }
    assert labels == {"ro": ["h15/RO_2", "h15/a/RO_1.csv", "h15/b/RO_1.csv", "h15/c/RO_1.csv"], "tbgi": ["h16/a/TBGI_1.xml", "h16/b/TBGI_1.xml"]}


def test_an_empty_landing_leaves_the_stores(spark, tmp_path):
    raw = write(tmp_path / "raw", {"h15/RO_1.csv": RO_PIPE})
    with work_area(spark):
        normalise_landing(spark, raw, f"{tmp_path}/prepared")
    before = children(spark, f"{tmp_path}/prepared/ro")
    empty = write(tmp_path / "empty", {"readme.txt": "nothing here"})
    with work_area(spark), pytest.raises(FileNotFoundError, match="Geen leveringen"):
        normalise_landing(spark, empty, f"{tmp_path}/prepared")
    assert children(spark, f"{tmp_path}/prepared/ro") == before


def test_a_relative_root_is_resolved_by_the_file_system(spark, tmp_path):
    jvm_folder = spark._jvm.java.lang.System.getProperty("user.dir")
    assert plain_root("raw/") == f"{jvm_folder}/raw"
    assert plain_root(f"file://{tmp_path}/raw/") == f"{tmp_path}/raw"
    df = spark.createDataFrame([(f"file:{jvm_folder}/raw/h15/x/RO_9.csv",)], "uri string")
    assert df.select(delivery_label(F.col("uri"), "raw")).first()[0] == "h15/RO_9"


def stored(spark, prepared, family, table):
    return {tuple(r) for r in spark.read.parquet(f"{prepared}/{family}/{table}.parquet").groupBy("levering").count().collect()}


def test_a_second_run_reads_only_what_changed(spark, tmp_path, monkeypatch):
    raw, prepared = tmp_path / "raw", f"{tmp_path}/prepared"
    lines = RO_PIPE.splitlines()
    two_headers = "\n".join([lines[0], *lines])
    write(raw, {"h15/RO_1.csv": RO_PIPE, "h15/RO_2.csv": RO_PIPE, "h15/RO_[3] +%.csv": RO_PIPE, "h16/RO_bad.csv": two_headers, "h16/TBGI_1.xml": TBGI})

    def land(**options):
        with work_area(spark):
            written, quarantine = normalise_landing(spark, str(raw), prepared, **options)
            return written, {r.levering for r in quarantine.collect()}

    read = []
    original = landing.read_family
    monkeypatch.setattr(landing, "read_family", lambda s, paths, family, **k: read.append((family, k.get("glob") is None)) or original(s, paths, family, **k))
    first, bad = land()
    assert set(first) == {"ro", "tbgi"} and bad == {"h16/RO_bad"}
    people = dict(stored(spark, prepared, "ro", "PER"))
    assert people == {"h15/RO_1": 3, "h15/RO_2": 3, "h15/RO_[3] +%": 3}

    read.clear()
    assert land() == ({}, {"h16/RO_bad"}) and read == []

    # Touched but the same; changed, with a record type less; repaired; new; gone.
    (raw / "h15/RO_1.csv").touch()
    without = "\n".join(line for line in lines if not line.startswith(("BPV", "PER|P1||1999")))
    write(raw, {"h15/RO_[3] +%.csv": without, "h16/RO_bad.csv": RO_PIPE, "h17/RO_4.csv": RO_PIPE})
    (raw / "h15/RO_2.csv").unlink()
    untouched = children(spark, f"{prepared}/ro/PER.parquet/levering=h15%2FRO_1")
    written, bad = land()
    assert set(written) == {"ro"} and bad == set() and read == [("ro", True)]
    assert dict(stored(spark, prepared, "ro", "PER")) == {"h15/RO_1": 3, "h15/RO_[3] +%": 2, "h16/RO_bad": 3, "h17/RO_4": 3}
    assert dict(stored(spark, prepared, "ro", "BPV")).keys() == {"h15/RO_1", "h16/RO_bad", "h17/RO_4"}
    assert children(spark, f"{prepared}/ro/PER.parquet/levering=h15%2FRO_1") == untouched

    # What became bad goes from the store; everything can be asked for.
    write(raw, {"h17/RO_4.csv": two_headers})
    assert land()[1] == {"h17/RO_4"} and "h17/RO_4" not in dict(stored(spark, prepared, "ro", "PER"))
    read.clear()
    assert set(land(everything=True)[0]) == {"ro", "tbgi"} and read == [("ro", False), ("tbgi", False)]
    (raw / "h16/TBGI_1.xml").unlink()
    land()
    assert not [name for name in children(spark, f"{prepared}/tbgi")]


def test_a_run_that_broke_off_is_taken_up_again(spark, tmp_path, monkeypatch):
    raw, prepared = write(tmp_path / "raw", {"h15/RO_1.csv": RO_PIPE, "h15/RO_2.csv": RO_PIPE}), f"{tmp_path}/prepared"

    def fail(*_):
        raise RuntimeError("broken off")

    with work_area(spark), monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(landing, "write_manifest", fail)
        normalise_landing(spark, raw, prepared)
    (tmp_path / "raw/h15/RO_2.csv").unlink()
    with work_area(spark):
        assert normalise_landing(spark, raw, prepared)[0]["ro"]["PER"] == 3
    assert dict(stored(spark, prepared, "ro", "PER")) == {"h15/RO_1": 3}

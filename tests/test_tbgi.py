import datetime as dt

import pytest
from conftest import TBGI

from fundlake.columns import VOLGORDE
from fundlake.operators.decode import decode_tbgi
from fundlake.plans.normalise import read_tbgi
from fundlake.schemas import load_schema
from fundlake.sources.exports import visible
from fundlake.sources.tbgi import read_xml


@pytest.fixture(scope="module")
def tables(spark, raw):
    return decode_tbgi(read_tbgi(spark, f"{raw}/h16/deep/TBGI_66WW_2026_20251124.XML"))


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy(VOLGORDE).select(*columns).collect()]


def test_four_tables_with_their_columns(tables):
    assert {name: visible(df).columns[1:] for name, df in tables.items()} == {
        name: spec.fields for name, spec in load_schema("tbgi").items()
    }
    assert {name: df.count() for name, df in tables.items()} == dict(Inschrijving=3, Teldatum=3, Diploma=1, Signaal=2)


def test_nil_missing_and_empty_are_null(tables):
    people = rows(tables["Inschrijving"], "Burgerservicenummer", "Onderwijsnummer", "DatumInschrijving")
    assert people == [("B1", None, dt.date(2024, 8, 1)), ("B2", None, dt.date(2023, 8, 1)), ("B3", None, None)]


def test_count_dates_repeat_their_parent(tables):
    found = rows(
        tables["Teldatum"],
        "BRIN",
        "Inschrijvingvolgnummer",
        "Teldatum",
        "BBLBOLFactor",
        "LeeftijdOpEenAugustusStudiejaar",
        "BPV_Volgnummer",
        "BPV_DatumBegin",
        "_ouder_Burgerservicenummer",
    )
    assert found == [
        ("66WW", "001", dt.date(2024, 10, 1), 0.5, 19, "3", dt.date(2024, 9, 1), "B1"),
        ("66WW", "001", dt.date(2025, 2, 1), 1.0, None, None, None, "B1"),
        ("66WW", "001", dt.date(2024, 10, 1), None, None, None, None, "B2"),
    ]


def test_signals_of_both_origins_keep_the_first_parameter(tables):
    found = rows(
        tables["Signaal"], "Bron", "Inschrijvingvolgnummer", "Teldatum", "Resultaatvolgnummer", "Signaalcode", "Parameternaam"
    )
    assert found == [
        ("Inschrijving", "001", "2024-10-01", None, "S1", "een"),
        ("Diploma", None, None, "R1", "S9", None),
    ]


def test_empty_tables_are_kept(spark, delivery):
    text = TBGI[: TBGI.index("  <Diploma>")] + "</Bekostigingsgrondslagen>"  # no diplomas
    frames = read_tbgi(spark, delivery(text, "TBGI_x.xml"))
    assert frames["Diploma"].count() == 0 and frames["Signaal"].count() == 1


def test_unreadable_record_rejects_the_delivery(spark, delivery):
    broken = TBGI.replace("<Opleidingcode>25500</Opleidingcode>", "<Opleidingcode>25500</Leertraject>")
    rejected = read_xml(spark, delivery(broken, "TBGI_x.xml")).rejected.collect()
    assert [(r.levering, r.fase) for r in rejected] == [("TBGI_x", "lezen")]


def test_bad_factor_rejects_the_delivery(spark, delivery):
    with pytest.raises(ValueError, match="Teldatum: geen getal in BBLBOLFactor"):
        read_tbgi(spark, delivery(TBGI.replace("0.5", "half"), "TBGI_x.xml"))


def all_rows(found):
    return {name: [tuple(r) for r in df.orderBy(VOLGORDE).drop(VOLGORDE).collect()] for name, df in found.tables.items()}


@pytest.mark.parametrize("split", ["256", "100m"])
def test_results_do_not_depend_on_the_split_size(spark, delivery, split):
    """The declared encoding, an element without content, and tags in comments and CDATA."""
    odd = TBGI.replace("25500", "caf\u00e9 > b").replace("  <Diploma>", "  <Inschrijving/>\n<!-- <Inschrijving> --><Diploma>", 1)
    odd = '<?xml version="1.0" encoding="ISO-8859-1"?>\n' + odd[odd.index("<Bekostigingsgrondslagen"):]
    path = delivery(odd.encode("latin-1"), "TBGI_x.xml")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = read_xml(spark, path)
        assert found.rejected.collect() == []
        got = all_rows(found)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    plain = all_rows(read_xml(spark, delivery(TBGI, "TBGI_y.xml")))
    assert len(got["Inschrijving"]) == len(plain["Inschrijving"]) + 1
    assert any("caf\u00e9 > b" in row for table in got.values() for row in table)
    assert {name: len(table) for name, table in got.items() if name != "Inschrijving"} == {
        name: len(table) for name, table in plain.items() if name != "Inschrijving"
    }


def test_wide_characters_are_rejected_with_a_reason(spark, delivery):
    path = delivery(TBGI.encode("utf-16"), "TBGI_x.xml")
    rejected = read_xml(spark, path).rejected.collect()
    assert [(r.levering, r.fase) for r in rejected] == [("TBGI_x", "lezen")] and rejected[0].reden


def test_a_file_cut_short_is_rejected(spark, delivery):
    path = delivery(TBGI[: TBGI.index("<BBLBOLFactor>0.5")], "TBGI_x.xml")
    rejected = read_xml(spark, path).rejected.collect()
    assert [(r.levering, r.fase) for r in rejected] == [("TBGI_x", "lezen")]


def test_a_document_without_its_end_is_rejected(spark, delivery):
    path = delivery(TBGI[: TBGI.index("  <Diploma>")], "TBGI_x.xml")
    rejected = read_xml(spark, path).rejected.collect()
    assert [(r.levering, r.reden) for r in rejected] == [("TBGI_x", "XML-bestand is niet afgesloten")]


def test_a_document_without_records_has_four_empty_tables(spark, delivery):
    frames = read_tbgi(spark, delivery("<Bekostigingsgrondslagen></Bekostigingsgrondslagen>", "TBGI_x.xml"))
    assert {name: df.count() for name, df in frames.items()} == dict(Inschrijving=0, Teldatum=0, Diploma=0, Signaal=0)
    with pytest.raises(ValueError, match="Leeg bestand"):
        read_tbgi(spark, delivery("", "TBGI_y.xml"))

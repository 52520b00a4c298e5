"""The wide and detail tables over small hand-made deliveries."""

import datetime as dt

import pytest

from fundlake.columns import VOLGORDE
from fundlake.operators.keys import fk_repair
from fundlake.operators.validate import validate_ro
from fundlake.plans.landing import run_landing_zone
from fundlake.plans.obt import TABLES, ObtBuilder, ObtOptions, build_obt
from fundlake.plans.reports import (
    enrolment_rollup,
    fundable_per_delivery,
    placement_hours,
    preview,
    run_summary,
)
from fundlake.sources.discovery import detect_bestandstype, discover
from fundlake.sources.exports import table_path
from fundlake.sources.prepared import read_results, stack_store, table_names

D = dt.date
PIPE = "h15/RO_99ZZ_20240801_20250731"
SEMICOLON = "h15/ro_88YY_20240801_20250731"
COMPACT = "h17/GRONDSLAG_IP_MBO_77XX_20251119_2025"
XML = "h16/TBGI_66WW_2026_20251124"


@pytest.fixture(scope="module")
def landed(spark, raw, tmp_path_factory):
    """The landing folder with three deliveries that have to be refused."""
    for name, text in {
        "h15/RO_BAD1_x.csv": "VLP|1|2024-01-01\nVLP|1|2024-01-01\nISP|P|\n",
        "h15/RO_BAD2_x.csv": "\n \n",
        "h15/RO_BAD3_x.csv": "BPV|P||A|1|||||x1\n",
    }.items():
        (raw / name).write_text(text)
    base = tmp_path_factory.mktemp("landing")
    return run_landing_zone(spark, str(raw), f"{base}/prepared", f"{base}/output"), str(base)


@pytest.fixture(scope="module")
def tables(spark, landed):
    return {name: spark.read.parquet(table_path(f"{landed[1]}/output", name)) for name in TABLES}


def frame(spark, rows, schema):
    """Rows with a position."""
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], f"{schema}, id long")
    return df.selectExpr(
        *[c for c in df.columns if c != "id"], f"struct(0L AS blok, id AS regel, 0L AS deel) AS {VOLGORDE}"
    )


def test_family_by_name():
    names = ["RO_1.csv", "/x/ro_1.CSV", "GRONDSLAG_IP_MBO_1.csv", "tbgi_1.xml", "GRONDSLAG_1.csv", "x_RO_1.csv", "RO.csv"]
    assert [detect_bestandstype(n) for n in names] == ["ro", "ro", "grondslag", "tbgi", None, None, None]


def test_discovery(spark, raw):
    found = {(r.levering, r.groep, r.bestandstype) for r in discover(spark, str(raw)).collect()}
    assert {(PIPE, "h15", "ro"), (SEMICOLON, "h15", "ro"), (COMPACT, "h17", "grondslag"), (XML, "h16", "tbgi")} <= found
    assert not any("notes" in label for label, _, _ in found)


def test_good_deliveries_survive_bad_ones(landed):
    result, _ = landed
    assert {(r.levering, r.fase, r.reden) for r in result.quarantine.collect()} == {
        ("h15/RO_BAD1_x", "valideren", "VLP moet exact 1 rij bevatten, gevonden: 2"),
        ("h15/RO_BAD2_x", "lezen", "Leeg bestand"),
        ("h15/RO_BAD3_x", "decoderen", "BPV: geen getal in Omvang"),
    }
    assert result.prepared["ro"] == dict(
        VLP=2, PER=4, ISG=3, ISP=4, ISE=1, BPV=3, DIP=1, AMO=1, GEO=3, KZD=2, SLR=2
    )
    assert result.prepared["grondslag"] == dict(VLP=1, PER=1, ISG=1, ISP=1, BII=1, DIP=1, KZD=1)
    assert result.prepared["tbgi"] == dict(Inschrijving=3, Teldatum=3, Diploma=1, Signaal=2)
    assert result.obt == dict(
        obt_inschrijvingen=5, detail_bpv=3, detail_kzd_amo=4, detail_bekostiging=4, meta_leveringen=3
    )
    assert run_summary(result.obt) == {"tabellen": 5, "rijen": 19}
    assert [r.levering for r in result.summary["leveringen"].collect()] == [PIPE, SEMICOLON, COMPACT]
    assert result.summary["isp_rijen"] == 5


def test_wide_columns(tables):
    columns = tables["obt_inschrijvingen"].columns
    assert columns[:4] == ["levering", "Burgerservicenummer", "Onderwijsnummer", "Inschrijvingvolgnummer"]
    assert columns[columns.index("_persoon_id") + 1] == "Geboortedatum"
    assert [c for c in columns if c.startswith("GEO_")] == [
        f"GEO_{code}_{m}" for code in (3001, 3006) for m in ("Eindcijfer", "CijferIE", "CijferCE", "Vrijstelling")
    ]
    assert not {"Recordsoort", VOLGORDE, "DIP__onbekend", "BRIN_vlp"} & set(columns)
    assert columns[-7:] == [
        "BPV_Aantal",
        "BPV_TotaalOmvang",
        "BPV_DatumBeginEerste",
        "BPV_DatumEindLaatste",
        "KZD_Aantal",
        "KZD_AantalBehaald",
        "AMO_Aantal",
    ]


def test_wide_values(tables):
    wide = tables["obt_inschrijvingen"]
    first, second = wide.where("_persoon_id = 'P1'").orderBy("DatumBegin").collect()
    assert (first.Geboortedatum, first.Geslacht) == (D(2001, 2, 3), "V")
    assert (first.DatumInschrijving, first.BRIN, first.DatumAanmaak) == (D(2023, 8, 1), "99ZZ", D(2025, 8, 2))
    assert (first.ISE_DatumBegin, first.DIP_Resultaatvolgnummer) == (D(2023, 9, 1), "D1")
    for row in (first, second):
        assert (row.BPV_Aantal, row.BPV_TotaalOmvang) == (2, 650.0)
        assert (row.BPV_DatumBeginEerste, row.BPV_DatumEindLaatste) == (D(2023, 9, 1), D(2024, 1, 20))
        assert (row.KZD_Aantal, row.KZD_AantalBehaald, row.AMO_Aantal) == (2, 2, 1)
        assert (row.GEO_3001_Eindcijfer, row.GEO_3001_CijferIE, row.GEO_3001_CijferCE) == (8, 65, 70)
        assert row.GEO_3001_Vrijstelling is None and row.GEO_3006_Eindcijfer is None

    other = wide.where("_persoon_id = 'N2'").first()
    assert (other.Geslacht, other.RedenUitschrijving, other.GEO_3006_Eindcijfer) == ("M", "08", 6)
    assert other.BPV_Aantal is None and other.KZD_Aantal is None

    blank_hours = wide.where("_persoon_id = 'P9'").first()
    assert (blank_hours.BPV_Aantal, blank_hours.BPV_TotaalOmvang) == (1, 0.0)

    pseudo = wide.where("_persoon_id = 'Q1'").first()
    assert (pseudo.BRIN, pseudo.Studiejaar, pseudo.KZD_Aantal) == ("77XX", 2025, 1)


def test_detail_tables(tables):
    assert tables["detail_bpv"].columns[:2] == ["levering", "_persoon_id"]
    repaired = {(r._bron, r._persoon_id, r.Inschrijvingvolgnummer) for r in tables["detail_kzd_amo"].collect()}
    assert repaired == {("KZD", "P1", "A1"), ("AMO", "P1", "A1"), ("KZD", "Q1", "C1")}
    basis = {(r._bron, r._persoon_id, r.Teldatum, r.BBLBOLFactor) for r in tables["detail_bekostiging"].collect()}
    assert basis == {
        ("BII", "Q1", D(2024, 10, 1), "1,0"),
        ("TBGI", "B1", D(2024, 10, 1), "0.5"),
        ("TBGI", "B1", D(2025, 2, 1), "1.0"),
        ("TBGI", "B2", D(2024, 10, 1), None),
    }
    meta = {r.levering: (r.BRIN, r.AantalISP) for r in tables["meta_leveringen"].collect()}
    assert meta == {PIPE: ("99ZZ", 3), SEMICOLON: ("88YY", 1), COMPACT: ("77XX", None)}


def test_reports(tables):
    wide = tables["obt_inschrijvingen"]
    assert {(r.levering, r.aantal) for r in fundable_per_delivery(wide).collect()} == {(PIPE, 2), (SEMICOLON, 1)}
    assert {(r.levering, r.aantal) for r in fundable_per_delivery(wide, ("1",)).collect()} == {(COMPACT, 1)}
    assert enrolment_rollup(wide).count() == 4
    hours = {r.levering: (r.BPV_Aantal, r.BPV_TotaalOmvang) for r in placement_hours(wide).collect()}
    assert hours == {PIPE: (2, 650.0), SEMICOLON: (1, 0.0), COMPACT: (None, None)}
    count, width, head = preview(wide, 2)
    assert (count, width, head.count()) == (5, len(wide.columns), 2)


def test_person_of_a_count_date_by_number_mixes_persons(spark, landed):
    stacked = stack_store(spark, f"{landed[1]}/prepared")
    by_number = ObtBuilder(stacked, ObtOptions(person_by_key=True)).detail_bekostiging().where("_bron = 'TBGI'")
    assert by_number.count() == 6


def test_exact_pass_and_single_diploma(spark, landed):
    stacked = stack_store(spark, f"{landed[1]}/prepared")
    wide = build_obt(stacked, ObtOptions(passed="exact", dedup_dip=True))["obt_inschrijvingen"]
    assert {r.KZD_AantalBehaald for r in wide.where("_persoon_id = 'P1'").collect()} == {1}
    with pytest.raises(ValueError, match="passed"):
        build_obt(stacked, ObtOptions(passed="maybe"))


def test_hot_keys_and_no_broadcast_give_the_same_tables(spark, landed, monkeypatch):
    """Every join takes its sliced path when all limits are at their lowest."""
    from fundlake.operators import joins

    stacked = stack_store(spark, f"{landed[1]}/prepared")
    plain = build_obt(stacked)
    for limit, value in (("HOT_ROWS", 1), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(joins, limit, value)
    sliced = build_obt(stacked)
    assert "_deel" in sliced["obt_inschrijvingen"]._jdf.queryExecution().optimizedPlan().toString()
    for name in TABLES:
        assert sliced[name].columns == plain[name].columns
        assert sliced[name].exceptAll(plain[name]).isEmpty() and plain[name].exceptAll(sliced[name]).isEmpty()


def test_rerun_drops_tables_that_no_longer_occur(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "RO_A_x.csv").write_text("VLP|A|2024-01-01\nPER|1\nISG|1||1\nISP|1||1\nISE|1||1|2024-01-01\n")
    run_landing_zone(spark, str(raw), f"{tmp_path}/p", f"{tmp_path}/o")
    assert "ISE" in table_names(spark, f"{tmp_path}/p/ro")
    (raw / "RO_A_x.csv").write_text("VLP|A|2024-01-01\nPER|1\nISG|1||1\nISP|1||1\n")
    again = run_landing_zone(spark, str(raw), f"{tmp_path}/p", f"{tmp_path}/o")
    assert "ISE" not in table_names(spark, f"{tmp_path}/p/ro") and again.obt["obt_inschrijvingen"] == 1
    wide = read_results(spark, f"{tmp_path}/o", "obt_inschrijvingen")
    assert not [c for c in wide.columns if c.startswith("ISE_")] and wide.first().levering == "overig/RO_A_x"
    assert wide.first().BRIN == "A"


def test_needs_a_grain(spark):
    with pytest.raises(ValueError, match="ISP"):
        build_obt({})
    empty = frame(spark, [], "levering string, Inschrijvingvolgnummer string")
    with pytest.raises(ValueError, match="ISP"):
        build_obt({"ISP": empty})
    with pytest.raises(ValueError, match="PER"):
        build_obt({"ISP": frame(spark, [("L", "1")], "levering string, Inschrijvingvolgnummer string")})


def test_xml_only_uses_its_enrolments(spark):
    people = frame(
        spark,
        [("L1", "66WW", "B1", None, "001")],
        "levering string, BRIN string, Burgerservicenummer string, Onderwijsnummer string, Inschrijvingvolgnummer string",
    )
    dates = frame(
        spark,
        [("L1", "66WW", "001", "A")],
        "levering string, BRIN string, Inschrijvingvolgnummer string, Bekostigingsstatus string",
    )
    with pytest.raises(ValueError, match="ouderelement"):
        build_obt({"Inschrijving": people, "Teldatum": dates})
    built = build_obt({"Inschrijving": people, "Teldatum": dates}, ObtOptions(person_by_key=True))
    assert built["obt_inschrijvingen"].first()._persoon_id == "B1"
    assert [(r._bron, r._persoon_id) for r in built["detail_bekostiging"].collect()] == [("TBGI", "B1")]
    for name in ("detail_bpv", "detail_kzd_amo", "meta_leveringen"):
        assert built[name].count() == 0 and "levering" in built[name].columns
    assert built["detail_bpv"].columns[:2] == ["levering", "_persoon_id"]
    assert dict(built["detail_bpv"].dtypes)["Omvang"] == "bigint"


REPAIR = "levering string, _persoon_id string, Inschrijvingvolgnummer string, ResultaatvolgnummerDiploma string"
DIPLOMA = "levering string, Burgerservicenummer string, Resultaatvolgnummer string, Inschrijvingvolgnummer string"


def test_key_repair(spark):
    results = frame(
        spark,
        [("L", "P", "", "R1"), ("L", "P", "A1", "R1"), ("L", "P", None, "R9"), ("L", None, "", "R1")],
        REPAIR,
    )
    diplomas = frame(spark, [("L", "P", "R1", "C3"), ("M", "P", "R9", "C9")], DIPLOMA)
    fixed = fk_repair(results, diplomas)
    assert [r[0] for r in fixed.orderBy(VOLGORDE).select("Inschrijvingvolgnummer").collect()] == ["C3", "A1", None, None]
    assert fixed.columns == results.columns
    assert [r.Inschrijvingvolgnummer for r in fk_repair(results, None).orderBy(VOLGORDE).collect()] == [None, "A1", None, None]
    without = results.drop("ResultaatvolgnummerDiploma")
    assert fk_repair(without, diplomas).columns == without.columns


def test_repeated_diploma_multiplies_unless_deduplicated(spark):
    results = frame(spark, [("L", "P", "", "R1")], REPAIR)
    diplomas = frame(spark, [("L", "P", "R1", "C1"), ("L", "P", "R1", "C2")], DIPLOMA)
    assert sorted(r.Inschrijvingvolgnummer for r in fk_repair(results, diplomas).collect()) == ["C1", "C2"]
    assert [r.Inschrijvingvolgnummer for r in fk_repair(results, diplomas, dedup=True).collect()] == ["C1"]


def test_validation(spark):
    header = "levering string, Recordsoort string, BRIN string, DatumBeginPeriode date, DatumEindePeriode date, DatumAanmaak date"
    one = spark.createDataFrame([("L", "VLP", "1", None, None, None)], header)
    assert validate_ro({"VLP": one})["VLP"] is one
    assert validate_ro({}) == {}
    with pytest.raises(ValueError, match="VLP moet exact 1 rij bevatten, gevonden: 2"):
        validate_ro({"VLP": one.unionAll(one)})
    with pytest.raises(ValueError, match="VLP: ontbrekende kolommen .'BRIN', 'DatumAanmaak'."):
        validate_ro({"VLP": one.drop("BRIN", "DatumAanmaak")})

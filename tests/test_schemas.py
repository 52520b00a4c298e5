import pytest

from fundlake.schemas import SCHEMAS, load_schema


def test_field_counts():
    counts = {family: {name: len(spec.fields) for name, spec in specs.items()} for family, specs in SCHEMAS.items()}
    assert counts == {
        "ro": dict(VLP=5, PER=5, ISG=8, ISP=14, ISE=6, BPV=13, DIP=10, AMO=11, GEO=16, KZD=12, SLR=10),
        "grondslag": dict(
            VLP=5, PER=18, ISG=8, ISP=15, ISE=6, BPV=13, BII=14, DIP=9, BID=12, AMO=11, GEO=15, KZD=11, SLR=12
        ),
        "tbgi": dict(Inschrijving=8, Teldatum=25, Diploma=15, Signaal=11),
    }


def test_single_row_types():
    singles = {family: [n for n, s in specs.items() if s.single_row] for family, specs in SCHEMAS.items()}
    assert singles == {"ro": ["VLP", "SLR"], "grondslag": ["VLP", "SLR"], "tbgi": []}


def test_typed_fields():
    spec = load_schema("tbgi")["Teldatum"]
    assert spec.float_fields == [
        "BBLBOLFactor",
        "PrijsfactorMBO",
        "Verblijfsjaarfactor",
        "BijdrageInschrijvingAanDeelnemerswaarde",
    ]
    assert spec.typed_schema["Teldatum"].dataType.simpleString() == "date"
    assert load_schema("tbgi")["Signaal"].raw_schema["Teldatum"].dataType.simpleString() == "string"
    assert load_schema("ro")["BPV"].int_fields == ["Omvang"]


def test_unknown_family():
    with pytest.raises(FileNotFoundError, match="Schema"):
        load_schema("xyz")

import pytest
from conftest import GRONDSLAG, RO_PIPE, RO_SEMICOLON

from fundlake.columns import DATUMFORMAAT, VOLGORDE
from fundlake.plans.normalise import read_grondslag, read_ro
from fundlake.schemas import load_schema
from fundlake.sources.exports import visible
from fundlake.sources.multirecord import parse_lines, read_lines, read_multi_record, stage_lines


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy(VOLGORDE).select(*columns).collect()]


def test_tables_and_columns(spark, delivery):
    frames = read_ro(spark, delivery(RO_PIPE))
    assert list(frames) == list(load_schema("ro"))
    for name, df in frames.items():
        assert visible(df).columns == ["levering", *load_schema("ro")[name].fields]
        assert {t for c, t in df.dtypes if c != VOLGORDE} == {"string"}
    assert {n: df.count() for n, df in frames.items()} == dict(
        VLP=1, PER=3, ISG=2, ISP=3, ISE=1, BPV=2, DIP=1, AMO=1, GEO=3, KZD=2, SLR=1
    )


def test_short_rows_are_padded_and_long_ones_clipped(spark, delivery):
    isp = read_ro(spark, delivery(RO_PIPE))["ISP"]
    assert rows(isp, "Niveau", "Onderwijslocatie", "Leerroutefase")[1:] == [("4", "100X001", ""), ("2", "", "")]
    per = read_grondslag(spark, delivery(GRONDSLAG, "GRONDSLAG_IP_MBO_x.csv"))["PER"]
    assert len(visible(per).columns) == 19
    assert rows(per, "Nationaliteit1", "Nationaliteit2") == [("0001", "")]


def test_semicolons_padding_order_and_unknown_types(spark, delivery):
    found = read_multi_record(spark, delivery(RO_SEMICOLON), "ro")
    profile = found.profile.first()
    assert (profile.scheidingsteken, profile[DATUMFORMAAT], profile.genegeerd) == (";", "dutch", 1)
    assert set(found.tables) == {"VLP", "PER", "ISG", "ISP", "BPV", "SLR"}
    assert rows(found.tables["VLP"], "BRIN", "DatumAanmaak") == [("88YY", "9-8-2025")]


@pytest.mark.parametrize(
    ("first", "separator"),
    [("x|y;z", "|"), ("x|y;z;", ";"), ("nothing", "|"), (" \t\n\na;b", ";"), ("PER|a;b;c", ";")],
)
def test_separator_comes_from_the_first_filled_line(spark, delivery, first, separator):
    path = delivery(f"{first}\nPER|P1||2001-01-01|V\nPER;P2;;2001-01-01;V\n")
    found = read_multi_record(spark, path, "ro")
    assert found.profile.first().scheidingsteken == separator
    people = [r[0] for r in rows(found.tables["PER"], "Burgerservicenummer")]
    assert people == (["P2"] if separator == ";" else (["P1"] if not first.startswith("PER") else ["a;b;c", "P1"]))


def test_byte_order_mark_and_line_ends(spark, delivery):
    text = "\ufeffVLP|1|2024-01-01|2024-01-01|2024-01-01\r\nPER|a\rPER|b\u2028PER|c\x0bPER|d\n\n"
    frames = read_ro(spark, delivery(text))
    assert rows(frames["PER"], "Burgerservicenummer") == [("a",), ("b",), ("c",), ("d",)]
    assert rows(frames["VLP"], "BRIN") == [("1",)]


def test_latin1_holds_for_the_whole_file(spark, delivery):
    content = b"PER|caf\xe9\nPER|\xc3\xa9\n"
    assert rows(read_ro(spark, delivery(content))["PER"], "Burgerservicenummer") == [("café",), ("Ã©",)]
    utf8 = delivery("PER|café\n", "RO_u.csv")
    assert rows(read_ro(spark, utf8)["PER"], "Burgerservicenummer") == [("café",)]


def test_no_quoting(spark, delivery):
    assert rows(read_ro(spark, delivery('PER|"a|b"\n'))["PER"], "Burgerservicenummer", "Onderwijsnummer") == [
        ('"a', 'b"')
    ]


def test_empty_missing_and_unknown(spark, delivery, tmp_path):
    with pytest.raises(ValueError, match="Leeg bestand"):
        read_ro(spark, delivery(" \n\r\n"))
    with pytest.raises(FileNotFoundError):
        read_ro(spark, str(tmp_path / "nope.csv"))
    with pytest.raises(FileNotFoundError, match="Schema"):
        read_multi_record(spark, delivery(RO_PIPE), "xyz")


def test_bad_number_rejects_the_delivery(spark, delivery):
    with pytest.raises(ValueError, match="BPV: geen getal in Omvang"):
        read_ro(spark, delivery(RO_PIPE.replace("|400|", "|4oo|")))
    with pytest.raises(ValueError, match="GEO: geen getal in Eindcijfer"):
        read_ro(spark, delivery(RO_PIPE.replace("|7||65|", "| 7||65|")))


def test_a_large_file_is_read_in_splits_in_order(spark, delivery):
    """Small splits stand for a huge file: many tasks read it and the order of its lines survives."""
    lines = ["VLP;1;1-1-2024;1-1-2024;1-1-2024"] + [f"PER;{i:05d};;1-1-2000;V" for i in range(3000)]
    path = delivery("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert read_lines(spark, path).rdd.getNumPartitions() > 8
        found = read_multi_record(spark, path, "ro")
        assert found.profile.first().aantallen == {"VLP": 1, "PER": 3000}
        assert [r[0] for r in rows(found.tables["PER"], "Burgerservicenummer")] == [f"{i:05d}" for i in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_staged_and_direct_reads_agree(spark, delivery):
    path = delivery(RO_PIPE)
    direct, staged = (read_multi_record(spark, path, "ro", staged=s) for s in (False, True))
    for name in direct.tables:
        assert direct.tables[name].exceptAll(staged.tables[name]).isEmpty()
        assert staged.tables[name].exceptAll(direct.tables[name]).isEmpty()


def test_profile_combines_before_the_shuffle(spark, delivery):
    """The per-split step of the profile is a hash aggregate with a partial step in the reading tasks."""
    from fundlake.sources.profile import summarise_splits

    plan = summarise_splits(parse_lines(read_lines(spark, delivery(RO_PIPE)), "ro"), ["code", "scheiding"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text and "partial_min_by" in text


def test_staged_lines_are_a_file_per_task(spark, delivery):
    path = delivery(RO_PIPE)
    lines = parse_lines(read_lines(spark, path), "ro")
    assert len(stage_lines(lines.repartition(3), "ro").inputFiles()) <= 3

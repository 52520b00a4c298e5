"""Totals, validities, code lists, names and codings on small tables."""

import datetime as dt
import random
import time
from decimal import Decimal

from conftest import RO_PIPE
from pyspark.sql import Observation
from pyspark.sql import functions as F

from fundlake.operators.codes import code_dictionary, decode_codes, harmonise
from fundlake.operators.funding import with_participant_value
from fundlake.operators.intervals import disjoint, funding_year_of_diploma, split_by_study_year, valid_at
from fundlake.operators.reconcile import control_totals, reconcile_counts, reconcile_totals
from fundlake.plans.landing import normalise_landing
from fundlake.plans.reports import reconcile_store, replaced_deliveries, store_totals
from fundlake.session import work_area
from fundlake.sources.filenames import superseded
from fundlake.sources.prepared import stack_store


def d(text):
    return dt.date.fromisoformat(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_counts_are_compared_both_ways(spark):
    totals = spark.createDataFrame([("A", 3, 0, None), ("A", 2, 0, None), ("B", 10, 5, 1)], "levering string, AantalPER long, AantalISP long, AantalDIP long")
    per = spark.createDataFrame([("A",)] * 3 + [("B",)] * 9 + [("C",)], "levering string")
    dip = spark.createDataFrame([("A",)], "levering string")
    found = reconcile_counts({"PER": per, "DIP": dip, "SLR": totals})
    assert rows(found) == sorted(
        [
            ("A", "PER", 3, 3, 0, "gelijk"), ("A", "ISP", 0, 0, 0, "gelijk"), ("A", "DIP", None, 1, None, "niet opgegeven"), ("B", "PER", 10, 9, -1, "te weinig"),
            ("B", "ISP", 5, 0, -5, "te weinig"), ("B", "DIP", 1, 0, -1, "te weinig"), ("C", "PER", None, 1, None, "niet opgegeven"),
        ], key=str,
    )
    loose = {r[:2]: r[5] for r in rows(reconcile_counts({"PER": per, "SLR": totals}, tolerance="0.1"))}
    assert loose["B", "PER"] == "gelijk" and loose["B", "ISP"] == "te weinig"


def test_control_totals_add_codes_exactly(spark):
    big = 999_999_999_999_999_999
    isp = spark.createDataFrame([("A", str(big), "J"), ("A", "25100", "1"), ("A", "x1", "N"), ("B", None, None)], "levering string, Opleidingcode string, IndicatieBekostigbaar string")
    isg = spark.createDataFrame([("A",), ("B",)], "levering string")
    found = control_totals({"ISP": isp, "ISG": isg})
    whole = {r.levering: r for r in found.where("niveau = 'levering'").collect()}
    assert whole["A"].opleidingcodes == Decimal(big + 25100) and whole["A"].totaal_generaal == Decimal(big + 25100 + 1 + 2)
    assert (whole["A"].ongeldige_codes, whole["A"].bekostigbaar, whole["A"].records) == (1, 2, 4)
    assert whole["B"].totaal_generaal == 1 and found.where("niveau = 'alles'").first().records == 6
    declared = spark.createDataFrame([("A", big), ("C", 0)], "levering string, totaal_opgegeven long")
    verdicts = {r.levering: (r.verschil, r.oordeel) for r in reconcile_totals(found, declared).collect()}
    assert verdicts == {"A": (25103, "te veel"), "B": (None, "niet opgegeven"), "C": (0, "gelijk")}


def test_validities_do_not_overlap(spark):
    table = spark.createDataFrame(
        [("k", d("2000-01-01"), None, 1), ("k", d("2005-01-01"), d("2006-12-31"), 2), ("k", d("2005-01-01"), d("2005-06-30"), 9), ("k", d("2010-01-01"), None, 3), (None, d("2000-01-01"), None, 4), ("k", None, None, 5)],
        "sleutel string, van date, tot date, waarde int",
    )
    assert [r[3:] for r in rows(disjoint(table, ["sleutel"], "van", "tot").select("sleutel", "van", "tot", "waarde"))] == [(1,), (2,), (3,)]
    days = [("k", d(x)) for x in ("1999-12-31", "2000-01-01", "2004-12-31", "2005-01-01", "2006-12-31", "2007-01-01", "2010-01-01", "9999-12-31")] + [("x", d("2005-01-01")), (None, None)]
    left = spark.createDataFrame(days, "sleutel string, dag date")
    found = {(r.sleutel, r.dag): r.waarde for r in valid_at(left, table, ["sleutel"], "dag", "van", "tot").collect()}
    assert [found[day] for day in days] == [None, 1, 1, 2, 2, None, 3, 3, None, None]
    assert valid_at(left, table.limit(0), ["sleutel"], "dag", "van", "tot").count() == len(days)


def test_participant_value_is_exact_and_rounded_once(spark):
    dates = spark.createDataFrame(
        [(1, "BOL", "c", d("2018-10-01"), 1.05), (2, "BOL", "c", d("2018-10-02"), 1.05), (3, "BOL", "c", d("2017-01-01"), None), (4, "EX", "c", d("2020-01-01"), None)],
        "nr int, Leertraject string, Opleidingcode string, Teldatum date, Verblijfsjaarfactor double",
    )
    paths = spark.createDataFrame([("BOL", d("1990-01-01"), None, 0.57)], "Leertraject string, van date, tot date, BBLBOLFactor double")
    prices = spark.createDataFrame([("c", d("1990-01-01"), None, 1.37)], "Opleidingcode string, van date, tot date, PrijsfactorMBO double")
    found = {r.nr: r.Deelnemerswaarde for r in with_participant_value(dates, paths, prices).collect()}
    assert found == {1: Decimal("0.819945"), 2: Decimal("0.780900"), 3: Decimal("0.780900"), 4: None}


def test_periods_are_cut_at_study_years(spark):
    periods = spark.createDataFrame(
        [(1, d("2023-09-01"), d("2025-07-31")), (2, d("2023-07-31"), d("2023-08-01")), (3, d("2024-08-01"), None), (4, d("2024-01-02"), d("2024-01-01")), (5, None, None), (6, d("2030-01-01"), None)],
        "nr int, begin date, eind date",
    )
    found = split_by_study_year(periods, "begin", "eind", F.lit("2025-12-31").cast("date"))
    assert [tuple(r)[0:1] + tuple(r)[3:] for r in found.orderBy("nr", "van").collect()] == [
        (1, 2023, 2025, d("2023-09-01"), d("2024-07-31"), 335), (1, 2024, 2026, d("2024-08-01"), d("2025-07-31"), 365),
        (2, 2022, 2024, d("2023-07-31"), d("2023-07-31"), 1), (2, 2023, 2025, d("2023-08-01"), d("2023-08-01"), 1),
        (3, 2024, 2026, d("2024-08-01"), d("2025-07-31"), 365), (3, 2025, 2027, d("2025-08-01"), d("2025-12-31"), 153),
    ]
    assert spark.range(1).select(funding_year_of_diploma(F.lit(d("2025-12-31")))).first()[0] == 2027


def test_codes_are_decoded_on_their_day_and_counted(spark):
    table = spark.createDataFrame([("BOL_DT", d("2023-07-31")), ("BOL_DT", d("2023-08-01")), ("ODT", d("2018-01-01")), ("??", d("2020-01-01")), (None, d("2020-01-01"))], "Leertraject string, dag date")
    seen = Observation("codes")
    found = decode_codes(table, {"Leertraject": "Leertraject"}, "dag", code_dictionary(spark), seen)
    status = {(r.Leertraject, r.dag): r.Leertraject_status for r in found.collect()}  # a sort would compute, and count, twice
    assert [status[tuple(r)] for r in table.collect()] == ["geldig", "verlopen", "verlopen", "onbekend", None]
    assert seen.get == {"Leertraject_verlopen": 2, "Leertraject_onbekend": 1}


def test_families_are_written_in_one_coding(spark):
    kzd = spark.createDataFrame([("1", "BEHAALD"), ("0", "NIET BEHAALD"), ("J", None), (None, "anders")], "Certificaat string, Resultaat string")
    assert rows(harmonise({"KZD": kzd}, "grondslag")["KZD"]) == rows(spark.createDataFrame([("J", "Behaald"), ("N", "Niet behaald"), ("J", None), (None, "anders")], kzd.schema))
    assert rows(harmonise({"KZD": kzd}, "ro")["KZD"]) == rows(kzd)


def test_newer_deliveries_replace_overlapping_ones(spark):
    files = spark.createDataFrame(
        [("a", "ro", "00AA", d("2024-08-01"), d("2025-07-31")), ("b", "ro", "00AA", d("2025-01-01"), d("2025-12-31")), ("c", "ro", "00AA", d("2023-01-01"), d("2024-07-31")),
         ("e", "ro", "00BB", d("2024-08-01"), d("2025-07-31")), ("f", "tbgi", "00AA", d("2024-08-01"), d("2025-07-31")), ("g", "ro", None, None, None), ("h", "ro", "00AA", d("2025-12-31"), d("2025-12-31"))],
        "levering string, bestandstype string, brin string, begin date, eind date",
    ).withColumn("aanmaak", F.lit(None).cast("date"))
    assert {r.levering: r.vervangen_door for r in superseded(files).collect() if r.vervangen_door} == {"a": "b", "b": "h"}


def test_reports_on_a_landing_zone(spark, tmp_path):
    raw = tmp_path / "raw" / "h15"
    raw.mkdir(parents=True)
    for name in ("RO_99ZZ_20240801_20250731.csv", "RO_99ZZ_20240801_20251231.csv", "RO_zz.csv"):
        (raw / name).write_text(RO_PIPE)
    with work_area(spark):
        normalise_landing(spark, str(tmp_path / "raw"), f"{tmp_path}/p")
    found = {(r.levering, r.recordtype): r.oordeel for r in reconcile_store(spark, f"{tmp_path}/p").collect()}
    assert found["h15/RO_zz", "PER"] == "te veel" and found["h15/RO_zz", "KZD"] == "gelijk" and len(found) == 27 + 3
    assert store_totals(spark, f"{tmp_path}/p").where("niveau = 'levering'").count() == 3
    assert [(r.levering, r.vervangen_door) for r in replaced_deliveries(spark, str(tmp_path / "raw")).orderBy("levering").collect()] == [
        ("h15/RO_99ZZ_20240801_20250731", "h15/RO_99ZZ_20240801_20251231"), ("h15/RO_99ZZ_20240801_20251231", None)
    ]
    assert rows(stack_store(spark, f"{tmp_path}/p", harmonised=True)["PER"]) == rows(stack_store(spark, f"{tmp_path}/p")["PER"])


def test_many_deliveries_of_one_school_make_no_pairs(spark):
    # Periods of any length, also those that end before they begin; labels that repeat; and 60,000 more deliveries of one
    # school, which would be nearly two thousand million pairs.
    draw = random.Random(5)
    day = lambda: d("2001-01-01") + dt.timedelta(draw.randrange(40))
    made = [(f"l{draw.randrange(250)}", draw.choice("rt"), draw.choice("AB"), day(), day(), draw.choice([None, day()])) for _ in range(300)]
    schema = "levering string, bestandstype string, brin string, begin date, eind date, aanmaak date"
    age = lambda r: (r[5] or dt.date.min, r[4], r[3], r[0])
    expected = {}
    for r in made:
        over = [age(o) for o in made if o[1:3] == r[1:3] and o[3] <= r[4] and r[3] <= o[4] and age(o) > age(r)]
        if over:
            expected[r[1], r[0]] = max(over + [expected[r[1], r[0]]] if (r[1], r[0]) in expected else over)
    many = spark.range(60_000).selectExpr(
        "concat('m', lpad(id, 5, '0')) AS levering", "'r' AS bestandstype", "'C' AS brin", "date_add(DATE'2001-01-01', cast(id % 900 AS int)) AS begin",
        "date_add(DATE'2001-01-01', cast(id % 900 AS int) + 300) AS eind", "date_add(DATE'2004-01-01', cast(id DIV 900 AS int)) AS aanmaak",
    )
    start = time.monotonic()
    found = superseded(spark.createDataFrame(made, schema).unionByName(many)).collect()
    assert time.monotonic() - start < 60
    assert {(r.bestandstype, r.levering): r.vervangen_door for r in found if r.brin != "C" and r.vervangen_door} == {k: v[3] for k, v in expected.items()}
    # Of the newest day of making, 600 deliveries have periods from the first 600 days; the latest that overlaps counts.
    of_c = {r.levering: r.vervangen_door for r in found if r.brin == "C"}
    assert len(found) == 60_300 and len(of_c) == 60_000
    assert of_c["m00000"] == "m59700" and of_c["m00500"] == "m59999" and of_c["m59999"] is None and of_c["m00899"] == "m59999"

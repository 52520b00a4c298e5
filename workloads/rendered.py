"""The given tables rendered as raw delivery text and XML, so that the readers have something to parse.

Even years come with ``|`` and ISO dates, odd years with ``;``, Dutch dates and trailing padding.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from fundlake.columns import VOLGORDE
from fundlake.sources.files import children, rename
from workloads.tables import Source

EVEN = "cast(levering AS int) % 2 = 0"


def iso_day(column: str) -> str:
    """SQL of a date as ``yyyy-MM-dd``, as a cast writes it; a formatter costs more."""
    return f"cast({column} AS string)"


NOTATIONS = {
    "iso": iso_day("{0}"),
    "compact": "date_format({0}, 'yyyyMMdd')",
    "dutch": "concat(day({0}), '-', month({0}), '-', substring_index(cast({0} AS string), '-', 1))",
}


def day(column: str, notation: str | None = None) -> str:
    """SQL of a date as text, in a given notation or that of the year."""
    if notation:
        return f"coalesce({NOTATIONS[notation].format(column)}, '')"
    return f"CASE WHEN {EVEN} THEN {day(column, 'iso')} ELSE {day(column, 'dutch')} END"


def line(source: DataFrame, block: int, row: str, fields: list[str], separator: str | None = None) -> DataFrame:
    """Delivery lines with position: ``fields`` are SQL texts joined by the separator of the year or a given one."""
    filled = ", ".join(f"coalesce({field}, '')" for field in fields)
    if separator:
        text = f"concat_ws('{separator}', {filled})"
    else:
        text = f"CASE WHEN {EVEN} THEN concat_ws('|', {filled}) ELSE concat(concat_ws(';', {filled}), ';;;') END"
    return source.selectExpr(
        "levering",
        f"struct({block}L AS blok, cast({row} AS bigint) AS regel, 0L AS deel) AS {VOLGORDE}",
        f"{text} AS tekst",
        "true AS utf8",
    )


PERSON = ["Burgerservicenummer", "Onderwijsnummer"]
ENROLMENT = [*PERSON, "Inschrijvingvolgnummer"]
LINE_ROW = "l_orderkey * 8 + l_linenumber"


def headers(src: Source) -> DataFrame:
    """One VLP line per year."""
    years = src.orders.groupBy("levering").agg({"dag": "min"}).withColumnRenamed("min(dag)", "dag")
    return line(years, 0, "0", ["'VLP'", "concat('B', levering)", day("dag"), day("dag"), day("dag")])


def person_lines(src: Source) -> DataFrame:
    return line(src.orders, 1, "o_orderkey", ["'PER'", *PERSON, day("dag"), "o_orderstatus"])


def enrolment_lines(src: Source) -> DataFrame:
    return line(
        src.orders,
        2,
        "o_orderkey",
        ["'ISG'", *ENROLMENT, day("dag"), day("date_add(dag, 365)"), "''", "o_orderpriority"],
    )


def period_lines(src: Source) -> DataFrame:
    """Period lines that stop after the funding indicator; the rest has to be padded."""
    return line(
        src.lines,
        3,
        LINE_ROW,
        [
            "'ISP'",
            *ENROLMENT,
            day("verzonden"),
            "cast(l_partkey AS string)",
            "l_returnflag",
            "l_linestatus",
            "CASE WHEN l_linestatus = 'O' THEN 'J' ELSE 'N' END",
        ],
    )


def placement_lines(src: Source, hours: str | None = None) -> DataFrame:
    """Placement lines; hours are blank for finished ones."""
    hours = hours or "CASE WHEN l_linestatus = 'O' THEN cast(cast(l_quantity AS bigint) AS string) END"
    return line(
        src.lines,
        4,
        LINE_ROW,
        ["'BPV'", *ENROLMENT, "cast(l_linenumber AS string)", "''", day("verzonden"), "''", "''", hours],
    )


def together(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def _element(name: str, value: str) -> str:
    """SQL of an XML element; a null becomes an element marked nil."""
    return f"coalesce(concat('<{name}>', {value}, '</{name}>'), '<{name} xsi:nil=\"true\"/>')"


def _count_date(number: int) -> str:
    parameters = "".join(
        f"<Parameter><Parametervolgnummer>{n}</Parametervolgnummer><Parameternaam>p{n}</Parameternaam></Parameter>"
        for n in (1, 2)
    )
    parts = [
        _element("Teldatum", iso_day(f"date_add(verzonden, {number})")),
        _element("Opleidingcode", "cast(l_partkey AS string)"),
        _element("BBLBOLFactor", "cast(cast(l_quantity AS bigint) AS string)"),
        _element("LeeftijdOpEenAugustusStudiejaar", "cast(l_linenumber AS string)"),
        "'<BekostigingsrelevanteBPV>'",
        _element("Volgnummer", "cast(l_suppkey AS string)"),
        _element("DatumBegin", iso_day("verzonden")),
        "'</BekostigingsrelevanteBPV><Signaal>'",
        f"'<Signaalvolgnummer>{number}</Signaalvolgnummer>'",
        _element("Signaalcode", "l_returnflag"),
        f"'{parameters}</Signaal>'",
    ]
    return f"concat('<Teldatum>', {', '.join(parts)}, '</Teldatum>')"


def enrolment_xml(src: Source) -> DataFrame:
    """An enrolment element per line item with no, one or two count dates."""
    one, two = _count_date(1), _count_date(2)
    dates = f"CASE l_returnflag WHEN 'R' THEN '' WHEN 'A' THEN {one} ELSE concat({one}, {two}) END"
    parts = [
        _element("BRIN", "concat('B', levering)"),
        _element("Burgerservicenummer", "Burgerservicenummer"),
        _element("Onderwijsnummer", "Onderwijsnummer"),
        _element("Inschrijvingvolgnummer", "Inschrijvingvolgnummer"),
        _element("DatumInschrijving", iso_day("verzonden")),
        dates,
    ]
    return src.lines.selectExpr(
        "levering",
        f"struct(0L AS blok, {LINE_ROW} AS regel, 0L AS deel) AS {VOLGORDE}",
        f"concat('<Inschrijving>', {', '.join(parts)}, '</Inschrijving>') AS xml",
    )


def diploma_xml(src: Source) -> DataFrame:
    """A diploma element per order with one signal."""
    parts = [
        _element("BRIN", "concat('B', levering)"),
        _element("Burgerservicenummer", "Burgerservicenummer"),
        _element("Resultaatvolgnummer", "concat('R', o_orderkey)"),
        _element("DatumBehaald", iso_day("dag")),
        "'<Signaal><Signaalvolgnummer>9</Signaalvolgnummer>'",
        _element("Signaalcode", "o_orderpriority"),
        "'</Signaal>'",
    ]
    return src.orders.selectExpr(
        "levering",
        f"struct(1L AS blok, o_orderkey AS regel, 0L AS deel) AS {VOLGORDE}",
        f"concat('<Diploma>', {', '.join(parts)}, '</Diploma>') AS xml",
    )


def xml_documents(src: Source) -> DataFrame:
    """Lines of a whole document per year: its opening, all elements, its end."""
    elements = enrolment_xml(src).unionAll(diploma_xml(src)).withColumnRenamed("xml", "tekst")
    years = src.orders.select("levering").distinct()
    opening = '<Bekostigingsgrondslagen xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">'
    ends = years.selectExpr(
        "levering",
        "explode(array("
        f"struct(struct(-1L AS blok, 0L AS regel, 0L AS deel) AS plek, '{opening}' AS tekst), "
        "struct(struct(2L AS blok, 0L AS regel, 0L AS deel) AS plek, '</Bekostigingsgrondslagen>' AS tekst))) AS e",
    )
    return elements.unionAll(ends.selectExpr("levering", f"e.plek AS {VOLGORDE}", "e.tekst"))


def write_files(lines: DataFrame, folder: str) -> None:
    """Lines in their order, in one file per delivery."""
    dealt = lines.select("levering", VOLGORDE, "tekst").repartition("levering").sortWithinPartitions("levering", VOLGORDE)
    dealt.select("levering", "tekst").write.partitionBy("levering").text(folder)


def name_files(spark: SparkSession, folder: str, pattern: str) -> None:
    """Call each delivery's file by the delivery."""
    for part in children(spark, folder):
        for name in children(spark, f"{folder}/{part}") if "=" in part else ():
            rename(spark, f"{folder}/{part}/{name}", f"{folder}/{part}/{pattern.format(part.partition('=')[2])}")

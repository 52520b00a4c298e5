"""One Spark session for all tests, and small deliveries made up for them."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fundlake.session import configure  # noqa: E402

# A pipe delivery with ISO dates: one person with two periods, a second one without placements.
RO_PIPE = """\
VLP|99ZZ|2024-08-01|2025-07-31|2025-08-02
PER|P1||2001-02-03|V
PER|P1||1999-09-09|M
PER||N2|2002-12-31|M
ISG|P1||A1|2023-08-01|2026-07-31||
ISG||N2|A1|2024-02-01|2025-01-31|2025-01-31|08
ISP|P1||A1|2023-08-01|25100|BOL|4|J||100A001|100X001|R1|F1
ISP|P1||A1|2024-08-01|25101|BBL|4|N||100A001|100X001
ISP||N2|A1|2024-02-01|25200|BOL|2|J
ISE|P1||A1|2023-09-01|2024-01-31
BPV|P1||A1|1|2023-08-15|2023-09-01|2024-01-31|2024-01-20|400|L1|25100|
BPV|P1||A1|2|2024-02-15|2024-03-01|2024-06-30||250|L2|25100|
DIP|P1||D1|25100|2025-06-30||J|A1|100A001
AMO|P1||D1|25100|M1|C0001|2025-05-01|J||100A001
GEO|P1||D1|25100|G1|3001|2025-03-01|7||65||70|||100A001
GEO|P1|||25100|G2|3001|2025-04-01|8|VR|60||||A1|100A001
GEO||N2||25200|G3|3006|2024-12-01|6||||||A1|100A001
KZD|P1||D1|25100|K1|K0001|2025-01-15|Behaald|J||100A001
KZD|P1|||25100|K2|K0002|2025-02-15|Niet behaald|N|A1|100A001
SLR|2|2|3|1|2|1|1|3|2
"""

# A semicolon delivery with Dutch dates, padding, the totals first and the header last.
RO_SEMICOLON = """\
SLR;1;1;1;0;1;0;0;0;0;;;;
PER;P9;;5-11-1998;M;;;;;;;;
ISG;P9;;B1;1-8-2024;31-7-2027;;;;;;;
ISP;P9;;B1;1-8-2024;25300;BOL;;J;;100A002;100X002;;
BPV;P9;;B1;1;10-9-2024;1-10-2024;31-1-2025;;;L9;25300;;
XYZ;unknown
VLP;88YY;1-8-2024;31-7-2025;9-8-2025;;;;;;;;
"""

# A compact-date delivery with three extra fields on PER and a funding record.
GRONDSLAG = """\
VLP;77XX;2025;20251119;V
PER;Q1;20;21;22;23;V;1234;;20100131;;5010;6030;5010;;;0001;;1234;;0001
ISG;Q1;77XX;C1;20240801;20270731;;
ISP;Q1;77XX;C1;20240801;20250731;25400;4;BOL;;1;100A003;100X003;;
BII;Q1;77XX;C1;20241001;2025-01-01 10:00:00;V;J;J;1,0;1.4;2;0.9;1.26
DIP;Q1;77XX;E1;25400;20250630;1;C1;100A003
KZD;Q1;77XX;E1;K7;K0700;Behaald;20250601;J;;100A003
"""

# Two persons of one school share an enrolment number; no, two and one count dates; two parameters on a signal.
TBGI = """\
<?xml version="1.0" encoding="utf-8"?>
<Bekostigingsgrondslagen xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">
  <Inschrijving>
    <BRIN>66WW</BRIN><Burgerservicenummer>B1</Burgerservicenummer><Onderwijsnummer xsi:nil="true"/>
    <Inschrijvingvolgnummer>001</Inschrijvingvolgnummer><DatumInschrijving>2024-08-01</DatumInschrijving>
    <Teldatum>
      <Teldatum>2024-10-01</Teldatum><LeeftijdOpEenAugustusStudiejaar>19</LeeftijdOpEenAugustusStudiejaar>
      <Opleidingcode>25500</Opleidingcode><BBLBOLFactor>0.5</BBLBOLFactor>
      <BekostigingsrelevanteBPV><Volgnummer>3</Volgnummer><DatumBegin>2024-09-01</DatumBegin></BekostigingsrelevanteBPV>
      <Signaal><Signaalvolgnummer>1</Signaalvolgnummer><Signaalcode>S1</Signaalcode>
        <Parameter><Parametervolgnummer>1</Parametervolgnummer><Parameternaam>een</Parameternaam></Parameter>
        <Parameter><Parametervolgnummer>2</Parametervolgnummer><Parameternaam>twee</Parameternaam></Parameter>
      </Signaal>
    </Teldatum>
    <Teldatum><Teldatum>2025-02-01</Teldatum><BBLBOLFactor>1</BBLBOLFactor></Teldatum>
  </Inschrijving>
  <Inschrijving>
    <BRIN>66WW</BRIN><Burgerservicenummer>B2</Burgerservicenummer>
    <Inschrijvingvolgnummer>001</Inschrijvingvolgnummer><DatumInschrijving>2023-08-01</DatumInschrijving>
    <Teldatum><Teldatum>2024-10-01</Teldatum></Teldatum>
  </Inschrijving>
  <Inschrijving>
    <BRIN>66WW</BRIN><Burgerservicenummer>B3</Burgerservicenummer>
    <Inschrijvingvolgnummer>002</Inschrijvingvolgnummer>
  </Inschrijving>
  <Diploma>
    <BRIN>66WW</BRIN><Burgerservicenummer>B3</Burgerservicenummer><Resultaatvolgnummer>R1</Resultaatvolgnummer>
    <DatumBehaald>2025-06-01</DatumBehaald><BijdrageDiplomawaarde>5</BijdrageDiplomawaarde>
    <Signaal><Signaalvolgnummer>4</Signaalvolgnummer><Signaalcode>S9</Signaalcode></Signaal>
  </Diploma>
</Bekostigingsgrondslagen>
"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("work")))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def raw(tmp_path_factory):
    """Landing folder with one delivery of every kind."""
    root = tmp_path_factory.mktemp("raw")
    files = {
        "h15/RO_99ZZ_20240801_20250731.csv": RO_PIPE,
        "h15/ro_88YY_20240801_20250731.CSV": RO_SEMICOLON,
        "h17/GRONDSLAG_IP_MBO_77XX_20251119_2025.csv": GRONDSLAG,
        "h16/deep/TBGI_66WW_2026_20251124.XML": TBGI,
        "h15/notes.txt": "not a delivery\n",
    }
    for name, text in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return root


@pytest.fixture
def delivery(tmp_path):
    """Write one delivery file and return its path."""

    def write(content: str | bytes, name: str = "RO_11AA_20240801_20250731.csv") -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content if isinstance(content, bytes) else content.encode("utf-8"))
        return str(path)

    return write

"""Record layouts of the three delivery families.

A layout line reads ``NAME[!]: field field:d field:i field:f``. Field order is positional. The suffix gives the
type after decoding (``d`` date, ``i`` bigint, ``f`` double, none string); ``!`` means exactly one row per delivery.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property
from types import MappingProxyType

from pyspark.sql import types as T

# Field names, order and types as published for each delivery family.
RO = """
VLP!: Recordsoort BRIN DatumBeginPeriode:d DatumEindePeriode:d DatumAanmaak:d
PER: Recordsoort Burgerservicenummer Onderwijsnummer Geboortedatum:d Geslacht
ISG: Recordsoort Burgerservicenummer Onderwijsnummer Inschrijvingvolgnummer DatumInschrijving:d
    DatumUitschrijvingGepland:d DatumUitschrijvingWerkelijk:d RedenUitschrijving
ISP: Recordsoort Burgerservicenummer Onderwijsnummer Inschrijvingvolgnummer DatumBegin:d Opleidingcode Leertraject
    Niveau IndicatieBekostigbaar LocatiecodeVSV Onderwijsaanbieder Onderwijslocatie Leerroute Leerroutefase
ISE: Recordsoort Burgerservicenummer Onderwijsnummer Inschrijvingvolgnummer DatumBegin:d DatumEind:d
BPV: Recordsoort Burgerservicenummer Onderwijsnummer Inschrijvingvolgnummer Volgnummer Afsluitdatum:d DatumBegin:d
    DatumEindGepland:d DatumEindWerkelijk:d Omvang:i LeerbedrijfID Opleidingcode CodeKeuzedeel
DIP: Recordsoort Burgerservicenummer Onderwijsnummer Resultaatvolgnummer Opleidingcode DatumResultaat:d _onbekend
    IndicatieBekostigbaar Inschrijvingvolgnummer Onderwijsaanbieder
AMO: Recordsoort Burgerservicenummer Onderwijsnummer ResultaatvolgnummerDiploma OpleidingcodeDiploma
    Resultaatvolgnummer CodeAMvBOnderdeel DatumResultaat:d Certificaat Inschrijvingvolgnummer Onderwijsaanbieder
GEO: Recordsoort Burgerservicenummer Onderwijsnummer ResultaatvolgnummerDiploma OpleidingcodeDiploma
    Resultaatvolgnummer CodeGeneriekExamenonderdeel DatumResultaat:d Eindcijfer:i VrijstellingGeneriekExamenonderdeel
    CijferIE:i VrijstellingIE CijferCE:i VrijstellingCE Inschrijvingvolgnummer Onderwijsaanbieder
KZD: Recordsoort Burgerservicenummer Onderwijsnummer ResultaatvolgnummerDiploma OpleidingcodeDiploma
    Resultaatvolgnummer CodeKeuzedeel DatumResultaat:d Resultaat Certificaat Inschrijvingvolgnummer Onderwijsaanbieder
SLR!: Recordsoort AantalPER:i AantalISG:i AantalISP:i AantalISE:i AantalBPV:i AantalDIP:i AantalAMO:i AantalGEO:i
    AantalKZD:i
"""

GRONDSLAG = """
VLP!: Recordsoort BRIN Studiejaar:i DatumAanmaak:d BekostigingsType
PER: Recordsoort PseudoNummer Leeftijd1:i Leeftijd2:i Leeftijd3:i Leeftijd4:i Geslacht Postcodecijfers
    DatumOverlijden:d DatumVestigingNederland:d DatumVertrekNederland:d CodeGeboorteland CodeGeboortelandOuder1
    CodeGeboortelandOuder2 CodeLandWaarnaarVertrokken Verblijfstitel Nationaliteit1 Nationaliteit2
ISG: Recordsoort PseudoNummer BRIN Inschrijvingvolgnummer DatumInschrijving:d DatumUitschrijvingGepland:d
    DatumUitschrijvingWerkelijk:d RedenUitschrijving
ISP: Recordsoort PseudoNummer BRIN Inschrijvingvolgnummer DatumBegin:d DatumEind:d Opleidingcode Niveau Leertraject
    LocatiecodeVSV IndicatieBekostigbaar Onderwijsaanbieder Onderwijslocatie Leerroute Leerroutefase
ISE: Recordsoort PseudoNummer BRIN Inschrijvingvolgnummer DatumBeginExtraOndersteuning:d
    DatumEindExtraOndersteuning:d
BPV: Recordsoort PseudoNummer BRIN Inschrijvingvolgnummer Volgnummer Afsluitdatum:d DatumBegin:d
    DatumEindGepland:d DatumEindWerkelijk:d Omvang:i LeerbedrijfID Opleidingcode CodeKeuzedeel
BII: Recordsoort PseudoNummer BRIN Inschrijvingvolgnummer Teldatum:d DatumTijdBepalingBekostigingsgrondslagen
    StatusBepalingBekostigingsstatus Bekostigingsstatus InschrijvingVoorCorrectiefactor BBLBOLFactor PrijsfactorMBO
    AantalBekostigdeVerblijfsjaren Verblijfsjaarfactor BijdrageDeelnemerswaarde
DIP: Recordsoort PseudoNummer BRIN Resultaatvolgnummer Opleidingcode DatumResultaat:d IndicatieBekostigbaar
    Inschrijvingvolgnummer Onderwijsaanbieder
BID: Recordsoort PseudoNummer BRIN Resultaatvolgnummer Niveau IndicatieSpecialistendiploma
    NiveauHoogstBekostigdeDiploma IndicatieHoogstBekostigdeDiplomaIsSpecialist
    DatumTijdBepalingBekostigingsgrondslagen StatusBepalingBekostigingsstatus Bekostigingsstatus
    BijdrageDiplomawaarde
AMO: Recordsoort PseudoNummer BRIN ResultaatvolgnummerDiploma OpleidingcodeDiploma Resultaatvolgnummer
    CodeAMvBOnderdeel DatumResultaat:d Certificaat Inschrijvingvolgnummer Onderwijsaanbieder
GEO: Recordsoort PseudoNummer BRIN ResultaatvolgnummerDiploma Resultaatvolgnummer CodeGeneriekExamenonderdeel
    Eindcijfer:i VrijstellingGeneriekExamenonderdeel CijferIE:i VrijstellingIE CijferCE:i VrijstellingCE
    DatumResultaat:d Inschrijvingvolgnummer Onderwijsaanbieder
KZD: Recordsoort PseudoNummer BRIN ResultaatvolgnummerDiploma Resultaatvolgnummer CodeKeuzedeel Resultaat
    DatumResultaat:d Certificaat Inschrijvingvolgnummer Onderwijsaanbieder
SLR!: Recordsoort AantalPER:i AantalISG:i AantalISP:i AantalISE:i AantalBPV:i AantalBII:i AantalDIP:i AantalBID:i
    AantalAMO:i AantalGEO:i AantalKZD:i
"""

TBGI = """
Inschrijving: BRIN Burgerservicenummer Onderwijsnummer Inschrijvingvolgnummer DatumInschrijving:d
    DatumUitschrijvingGepland:d DatumUitschrijvingWerkelijk:d NiveauHoogstBekostigdeDiploma
Teldatum: BRIN Inschrijvingvolgnummer Teldatum:d DatumTijdBepalingBekostigingsgrondslagen
    StatusBepalingBekostigingsstatus LeeftijdOpEenAugustusStudiejaar:i Opleidingcode Niveau Leertraject Leerroutefase
    IndicatieBekostigbaar Bekostigingsstatus InschrijvingVoorCorrectiefactor BBLBOLFactor:f PrijsfactorMBO:f
    AantalBekostigdeVerblijfsjarenMBO:i Verblijfsjaarfactor:f BijdrageInschrijvingAanDeelnemerswaarde:f
    BPV_Inschrijvingvolgnummer BPV_Volgnummer BPV_Afsluitdatum:d BPV_DatumBegin:d BPV_DatumEindGepland:d
    BPV_DatumEindWerkelijk:d BPV_Opleidingcode
Diploma: BRIN Burgerservicenummer Onderwijsnummer Resultaatvolgnummer Opleidingcode Inschrijvingvolgnummer
    DatumBehaald:d Niveau IndicatieSpecialistendiploma NiveauHoogstBekostigdeDiploma
    IndicatieHoogstBekostigdeDiplomaIsSpecialist DatumTijdBepalingBekostigingsgrondslagen
    StatusBepalingBekostigingsstatus Bekostigingsstatus BijdrageDiplomawaarde:f
Signaal: Bron BRIN Inschrijvingvolgnummer Teldatum Resultaatvolgnummer Signaalvolgnummer:i Signaalcode
    Signaalomschrijving Parametervolgnummer:i Parameternaam Parameterwaarde
"""

# File-name prefix per family, longest first (upper case).
PREFIXES = {"GRONDSLAG_IP_MBO_": "grondslag", "TBGI_": "tbgi", "RO_": "ro"}
# End of fixed values.

_TYPES = {"": T.StringType(), "d": T.DateType(), "i": T.LongType(), "f": T.DoubleType()}


@dataclass(frozen=True)
class RecordSpec:
    """Layout of one record type (or flattened XML table)."""

    name: str
    rank: int
    columns: tuple[tuple[str, str], ...]
    single_row: bool = False

    @cached_property
    def fields(self) -> list[str]:
        return [name for name, _ in self.columns]

    def of_kind(self, kind: str) -> list[str]:
        return [name for name, k in self.columns if k == kind]

    @property
    def date_fields(self) -> list[str]:
        return self.of_kind("d")

    @property
    def int_fields(self) -> list[str]:
        return self.of_kind("i")

    @property
    def float_fields(self) -> list[str]:
        return self.of_kind("f")

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, T.StringType()) for f in self.fields])

    @property
    def typed_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f, _TYPES[k]) for f, k in self.columns])


def parse_layout(text: str) -> dict[str, RecordSpec]:
    """Turn a layout text into specs; a line holding ``NAME:`` starts a record type, other lines continue it."""
    specs: dict[str, RecordSpec] = {}
    for line in text.strip().splitlines():
        head, colon, rest = line.partition(": ")
        if colon:
            name = head.rstrip("!")
            specs[name] = RecordSpec(name, len(specs), (), head.endswith("!"))
        tokens = (rest if colon else line).split()
        extra = tuple((t.partition(":")[0], t.partition(":")[2]) for t in tokens)
        specs[name] = replace(specs[name], columns=specs[name].columns + extra)
    return specs


SCHEMAS = MappingProxyType(
    {
        family: MappingProxyType(parse_layout(text))
        for family, text in (("ro", RO), ("grondslag", GRONDSLAG), ("tbgi", TBGI))
    }
)


def load_schema(family: str = "ro") -> MappingProxyType[str, RecordSpec]:
    """Record specs of a family; an unknown family is a missing source."""
    if family not in SCHEMAS:
        raise FileNotFoundError(f"Schema niet gevonden: {family!r} (bekend: {sorted(SCHEMAS)})")
    return SCHEMAS[family]

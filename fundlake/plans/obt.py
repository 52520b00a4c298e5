"""The five analysis tables over all stacked deliveries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlake.columns import BRON, LEVERING, OUDER_PREFIX, PERSOON, VOLGORDE
from fundlake.operators.aggregates import elective_totals, exam_codes, exam_pivot, module_totals, placement_totals
from fundlake.operators.joins import (
    first_per_key,
    keep_first_left_join,
    left_join_all,
    lookup_join,
)
from fundlake.operators.keys import ENROLMENT_KEY, PERSON_COLUMNS, PERSON_KEY, fk_repair, with_person_id
from fundlake.operators.union import common_type, tagged_union
from fundlake.schemas import SCHEMAS
from fundlake.sources.exports import visible

# Output tables and the columns they leave out.
TABLES = ("obt_inschrijvingen", "detail_bpv", "detail_kzd_amo", "detail_bekostiging", "meta_leveringen")
ENROLMENT_DATES = (
    "DatumInschrijving",
    "DatumUitschrijvingGepland",
    "DatumUitschrijvingWerkelijk",
    "RedenUitschrijving",
)
RECORD_TYPE = "Recordsoort"
NOT_IN_SUPPORT = (RECORD_TYPE, *PERSON_COLUMNS)
NOT_IN_DIPLOMA = (RECORD_TYPE, *PERSON_COLUMNS, "_onbekend", "BRIN")
XML_ENROLMENT_KEY = (LEVERING, "BRIN", "Inschrijvingvolgnummer")
# End of fixed values.

Store = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class ObtOptions:
    """Choices where the delivered data is ambiguous. The defaults keep the published results.

    passed: how a passed elective is recognised, ``contains`` (counts negations too) or ``exact``.
    dedup_dip: take the first diploma per reference, so that key repair never multiplies rows.
    person_by_key: find the person of a count date by enrolment number instead of by its parent element. Numbers
        repeat across persons, so this can mix persons and multiply rows.
    harmonised: write yes and no, and results of electives, in one coding before the families are united. Landing runs
        only, as the stores tell the family of a table.
    """

    passed: str = "contains"
    dedup_dip: bool = False
    person_by_key: bool = False
    harmonised: bool = False


def _first_column(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names, *[c for c in df.columns if c not in names])


def _prefixed(df: DataFrame, prefix: str, leave_out: tuple[str, ...]) -> DataFrame:
    keep = [c for c in df.columns if c not in (*ENROLMENT_KEY, *leave_out, VOLGORDE)]
    return df.select(*ENROLMENT_KEY, *[F.col(c).alias(f"{prefix}{c}") for c in keep], VOLGORDE)


class ObtBuilder:
    """Builds the tables lazily from a stacked set; only emptiness, exam codes and small counts are looked up."""

    def __init__(
        self,
        stacked: dict[str, DataFrame],
        options: ObtOptions | None = None,
        present: set[str] | None = None,
        store: Store | None = None,
        store_part: Store | None = None,
    ):
        self.options = options or ObtOptions()
        if present is None:
            present = {name for name, df in stacked.items() if not df.isEmpty()}
        self.tables = {name: stacked[name] for name in stacked if name in present}
        self.known = set(stacked)
        self.stacked = stacked
        self.store = store or (lambda df, name: df)
        self.store_part = store_part or self.store
        self._repaired: dict[str, DataFrame] = {}

    @property
    def spark(self) -> SparkSession:
        return next(iter(self.stacked.values())).sparkSession

    def required(self, name: str) -> DataFrame:
        if name not in self.known:
            raise ValueError(f"De brede tabel heeft {name} nodig, en die tabel heeft geen rijen")
        return self.stacked[name]

    def repaired(self, name: str) -> DataFrame:
        """Results with their enrolment number filled in; electives and modules are used by two tables."""
        if name not in self._repaired:
            keyed = with_person_id(self.tables[name])
            fixed = fk_repair(keyed, self.tables.get("DIP"), dedup=self.options.dedup_dip)
            self._repaired[name] = self.store(fixed, f"hersteld-{name}")
        return self._repaired[name]

    def _exams(self) -> DataFrame:
        """Exams with their enrolment number. Only those without one are looked up: maxima and minima do not change when a
        diploma that occurs twice repeats a row."""
        keyed = with_person_id(self.tables["GEO"])
        number = F.nullif("Inschrijvingvolgnummer", F.lit(""))
        blank = fk_repair(keyed.where(number.isNull()), self.tables.get("DIP"), dedup=self.options.dedup_dip)
        return keyed.where(number.isNotNull()).unionByName(blank)

    def obt_inschrijvingen(self) -> DataFrame:
        """One row per enrolment period with everything known about its person, enrolment and delivery.

        The period table is shuffled twice at most: by person for the person columns and by enrolment for all other
        parts, each of which has one row per enrolment by then.
        """
        if "ISP" not in self.tables:
            return visible(with_person_id(self.tables["Inschrijving"]).drop(RECORD_TYPE))
        base = with_person_id(self.tables["ISP"]).drop(RECORD_TYPE)

        persons = with_person_id(self.required("PER")).drop(RECORD_TYPE, *PERSON_COLUMNS)
        with_person = keep_first_left_join(base, persons, PERSON_KEY)

        with_delivery, delivery_columns = self._with_delivery(with_person, base)
        parts = self._enrolment_parts()
        wide = left_join_all(with_delivery, parts, ENROLMENT_KEY, keys_from=base)

        # Published order: period, person, enrolment dates, delivery, then the other parts.
        front = with_person.columns
        dates = [c for c in parts[0].columns if c not in (*ENROLMENT_KEY, VOLGORDE)]
        dates = [c if c not in with_delivery.columns else f"{c}_r" for c in dates]
        head = [*[c for c in front if c != VOLGORDE], *dates, *delivery_columns]
        return wide.select(*head, *[c for c in wide.columns if c not in head and c != VOLGORDE])

    def _with_delivery(self, df: DataFrame, base: DataFrame) -> tuple[DataFrame, list[str]]:
        """Delivery columns; BRIN comes from the delivery where the period has none."""
        deliveries = self.required("VLP").drop(RECORD_TYPE)
        joined = lookup_join(df, first_per_key(deliveries, [LEVERING]), [LEVERING], suffix="_vlp", keys_from=base)
        added = [c for c in joined.columns if c not in df.columns]
        if "BRIN_vlp" in added:
            joined = joined.withColumn("BRIN", F.coalesce("BRIN", "BRIN_vlp")).drop("BRIN_vlp")
            added.remove("BRIN_vlp")
        return joined, added

    def _enrolment_parts(self) -> list[DataFrame]:
        """Tables of one row per enrolment; those without rows are skipped and add no columns. What is made of results and
        placements is stored by itself, so that the shuffles of one are gone before the next."""
        enrolments = with_person_id(self.required("ISG"))
        dates = [c for c in ENROLMENT_DATES if c in enrolments.columns]
        parts = [first_per_key(enrolments.select(*ENROLMENT_KEY, *dates, VOLGORDE), ENROLMENT_KEY)]
        if "ISE" in self.tables:
            support = _prefixed(with_person_id(self.tables["ISE"]), "ISE_", NOT_IN_SUPPORT)
            parts.append(first_per_key(support, ENROLMENT_KEY))
        if "DIP" in self.tables:
            diplomas = _prefixed(with_person_id(self.tables["DIP"]), "DIP_", NOT_IN_DIPLOMA)
            parts.append(first_per_key(diplomas, ENROLMENT_KEY))
        if "GEO" in self.tables:
            parts.append(self.store_part(exam_pivot(self._exams(), exam_codes(self.tables["GEO"])), "deel-GEO"))
        if "BPV" in self.tables:
            parts.append(self.store_part(placement_totals(with_person_id(self.tables["BPV"])), "deel-BPV"))
        if "KZD" in self.tables:
            parts.append(self.store_part(elective_totals(self.repaired("KZD"), self.options.passed), "deel-KZD"))
        if "AMO" in self.tables:
            parts.append(self.store_part(module_totals(self.repaired("AMO")), "deel-AMO"))
        return parts

    def detail_bpv(self) -> DataFrame:
        """Every placement."""
        if "BPV" not in self.tables:
            return self._empty(["BPV"], [LEVERING, PERSOON])
        return visible(_first_column(with_person_id(self.tables["BPV"]).drop(RECORD_TYPE), LEVERING, PERSOON))

    def detail_kzd_amo(self) -> DataFrame:
        """Every elective and required module, told apart by ``_bron``."""
        parts = {name: self.repaired(name).drop(RECORD_TYPE) for name in ("KZD", "AMO") if name in self.tables}
        if not parts:
            return self._empty(["KZD", "AMO"], [LEVERING], [PERSOON, BRON])
        return visible(tagged_union(parts))

    def detail_bekostiging(self) -> DataFrame:
        """Funding basis per enrolment and count date, from both families that have one."""
        parts = {}
        if "BII" in self.tables:
            parts["BII"] = with_person_id(self.tables["BII"]).drop(RECORD_TYPE)
        if "Teldatum" in self.tables:
            parts["TBGI"] = with_person_id(self._count_dates_with_person())
        if not parts:
            return self._empty(["BII", "Teldatum"], [LEVERING], [PERSOON, BRON])
        return visible(tagged_union({name: visible(df) for name, df in parts.items()}))

    def _count_dates_with_person(self) -> DataFrame:
        """Count dates with the identifiers of their person, from the parent element when it was kept."""
        dates = self.tables["Teldatum"]
        parents = {c: c.removeprefix(OUDER_PREFIX) for c in dates.columns if c.startswith(OUDER_PREFIX)}
        if parents and not self.options.person_by_key:
            return dates.withColumnsRenamed(parents)
        if not self.options.person_by_key:
            raise ValueError(
                "Teldatum mist de kolommen van het ouderelement; lees de levering opnieuw in of kies person_by_key"
            )
        dates = dates.drop(*parents)
        if "Inschrijving" not in self.tables:
            return dates
        persons = self.tables["Inschrijving"].select(*XML_ENROLMENT_KEY, "Burgerservicenummer", "Onderwijsnummer")
        joined = left_join_all(dates, [persons], XML_ENROLMENT_KEY)
        return joined.select(*dates.columns, "Burgerservicenummer", "Onderwijsnummer")

    def meta_leveringen(self) -> DataFrame:
        """Delivery header with the control totals."""
        headers, totals = (
            visible(self.tables[name].drop(RECORD_TYPE)) if name in self.tables else None for name in ("VLP", "SLR")
        )
        if headers is None and totals is None:
            return self._empty(["VLP", "SLR"], [LEVERING])
        if headers is None or totals is None:
            return totals if headers is None else headers
        return headers.join(totals, LEVERING, "left")

    def _empty(self, tables: list[str], first: list[str], last: list[str] | None = None) -> DataFrame:
        """No rows, with the columns the table would have had."""
        types: dict[str, T.DataType] = {name: T.StringType() for name in first}
        for specs in SCHEMAS.values():
            for name in tables:
                for field in specs[name].typed_schema if name in specs else []:
                    types[field.name] = common_type(types.get(field.name, field.dataType), field.dataType)
        types.update({name: T.StringType() for name in last or []})
        types.pop(RECORD_TYPE, None)
        return self.spark.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in types.items()]))


def build_obt(
    stacked: dict[str, DataFrame],
    options: ObtOptions | None = None,
    present: set[str] | None = None,
    store: Store | None = None,
) -> dict[str, DataFrame]:
    """The five tables.

    ``present`` names the tables that have rows, when the caller knows; otherwise each is looked into. ``store``
    writes a table that is used twice and reads it back.
    """
    builder = ObtBuilder(stacked, options, present, store)
    if not {"ISP", "Inschrijving"} & set(builder.tables):
        raise ValueError(
            "Zonder rijen in ISP of Inschrijving is er niets om de brede tabel op te bouwen"
        )
    return {name: getattr(builder, name)() for name in TABLES}

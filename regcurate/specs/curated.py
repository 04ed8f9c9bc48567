"""Curated-table contracts: output columns, rename maps, era tables, sidecars.

Data only. Every curated column is a string on purpose (ids keep leading
zeros, money keeps its decimals); ``type`` below is the *declared* type that
the sidecar reports and the contract report checks, not the stored type.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from .registers import REGISTERS

DATE_FORMAT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    title: str
    type: str = "string"           # declared type: string | integer | number | code
    nullable: bool = False
    format: str | None = None      # regex the text must match
    enum: tuple[str, ...] = ()     # allowed values
    origin: tuple[str, ...] = ()   # "REGISTER:COLUMN" lineage
    description: str = ""
    examples: tuple[str, ...] = ()


@dataclass(frozen=True)
class TableSpec:
    key: str
    title: str
    description: str               # may hold {first} and {last}
    columns: tuple[ColumnSpec, ...]
    sorted_by: tuple[str, ...] = ()
    period_columns: tuple[str, str] | None = None   # (min of, max of)
    partition_by: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)


@dataclass(frozen=True)
class Era:
    """Years in which a value stands in ``column``: from ``since`` on, up to
    ``up_to`` inclusive, or strictly below ``below``."""

    column: str
    since: str | None = None
    up_to: str | None = None
    below: str | None = None


def _c(name, title, type="string", nullable=False, format=None, enum=(), origin=()):
    return ColumnSpec(name, title, type, nullable, format, tuple(enum), tuple(origin))


_SOURCE_FILE = _c("source_file", "Source dataset file")

# --- fixed values: raw -> curated renames ------------------------------------
INCOME_RENAMES = {
    "person_id": "PNR",
    "tax_scope": "OMFANG",
    "tax_sum": "SKATTOT_13",
    "income_main_source": "BESKST13",
    "income_social_contrib": "ERHVERVSINDK_13",
    "income_employment": "LOENMV_13",
    "income_social": "OFF_OVERFORSEL_13",
    "income_priv_pension": "PRIVAT_PENSION_13",
    "income_other": "RESUINK_13",
    "income_sum": "PERINDKIALT_13",
}

FAMILY_INCOME_RENAMES = {
    "family_id": "FAMILIE_ID",
    "family_kind": "FAMTYPE",
    "tax_sum": "FAMSKATTOT_13",
    "income_social_contrib": "FAMERHVERVSINDK_13",
    "income_employment": "FAMLOENMV_13",
    "income_social": "FAMOFF_OVERFORSEL_13",
    "income_priv_pension": "FAMPRIVAT_PENSION_13",
    "income_other": "FAMRESTINDK_13",
    "income_sum": "FAMINDKOMSTIALT_13",
}

EDUCATION_RENAMES = {
    "person_id": "PNR",
    "kind": "HFAUDD",
    "institute": "HFINSTNR",
    "source": "HF_KILDE",
    "completed_at": "HF_VFRA",
}

POPULATION_RENAMES = {
    "person_id": "PNR",
    "gender": "KOEN",
    "born_at": "FOED_DAG",
    "birthplace_id": "FOEDREG_KODE",
    "mother_id": "MOR_ID",
    "father_id": "FAR_ID",
    "family_id": "FAMILIE_ID",
}

# deaths: two file variants, renamed by position onto DEATHS_COLUMNS
DEATHS_COLUMNS = ("person_id", "deceased_at", "mode", "cause_1_icd_id", "cause_2_icd_id",
                  "cause_3_icd_id", "cause_4_icd_id")
DEATHS_VARIANTS = {
    "dodsaars": ("PNR", "D_DODSDTO", "C_DODSMAADE", "C_DOD1", "C_DOD2", "C_DOD3", "C_DOD4"),
    "dodsaasg": ("PNR", "D_DODSDATO", "C_DODSMAADE", "C_DOD_1A", "C_DOD_1B", "C_DOD_1C",
                 "C_DOD_1D"),
}
# file-name prefix (case-folded) that selects the first variant; others use the second
DEATHS_PRIMARY_PREFIX = "dodsaars"
# every register whose name starts so is an input of deaths
DEATHS_REGISTER_PREFIX = "dodsaa"

# prescriptions: lmdb columns in spec order, renamed by position
PRESCRIPTION_COLUMNS = ("person_id", "atc_id", "ibnr_id", "dispensed_at", "volume",
                        "volume_type_code", "pack_size", "strength", "strength_unit",
                        "dosage_form")
# the 14 declared ATC categories (first letter of the ATC code)
ATC_CATEGORIES = ("A", "B", "C", "D", "G", "H", "J", "L", "M", "N", "P", "R", "S", "V")
NO_CATEGORY = "_none"

# employment eras; bounds are compared as *strings*, the way the source
# compares its character year (so "199112" is below "1992" but above "1991")
STATUS_ERAS = (
    Era("ARBSTIL", up_to="1993"),
    Era("NYARB", since="1994", up_to="1995"),
    Era("SOCSTIL_KODE", since="1996", up_to="2007"),
)
STATUS_DEFAULT = "SOC_STATUS_KODE"
INDUSTRY_ERAS = (
    Era("BRANCHE_77", below="1992"),
    Era("BRANCHE_KODE", since="1992", up_to="2007"),
)
INDUSTRY_DEFAULT = "ARB_HOVED_BRA_DB07"

# diagnoses: five register pairs, (records register, diagnoses register) and
# the raw name of every curated column on each side; appended in this order
DIAGNOSIS_PAIRS = {
    "pcrr1": {
        "records": ("patient_icd8", {"person_id": "CPRNR", "record_id": "PAT_SEQ",
                                     "patient_kind": "PTTYPE", "starts_at": "INDLDATO",
                                     "ends_at": "UDSKDATO"}),
        "diagnoses": ("patient_icd8", {"record_id": "PAT_SEQ", "diagnosis_id": "HOVEDDIAG",
                                       "diagnosis_kind": "MODIFHD"}),
    },
    "pcrr2": {
        "records": ("patient_icd10", {"person_id": "CPRNR", "record_id": "PAT_SEQ",
                                      "patient_kind": "PTTYPE", "starts_at": "INDLDATO",
                                      "ends_at": "UDSKDATO"}),
        "diagnoses": ("diag_icd10", {"record_id": "PAT_SEQ", "diagnosis_id": "DIAG",
                                     "diagnosis_kind": "DART"}),
    },
    "pcrr3": {
        "records": ("psyk_adm", {"person_id": "PNR", "record_id": "RECNUM",
                                 "patient_kind": "C_PATTYPE", "starts_at": "D_INDDTO",
                                 "ends_at": "D_UDDTO"}),
        "diagnoses": ("psyk_diag", {"record_id": "RECNUM", "diagnosis_id": "C_DIAG",
                                    "diagnosis_kind": "C_DIAGTYPE"}),
    },
    "lpr2": {
        "records": ("lpr_adm", {"person_id": "PNR", "record_id": "RECNUM",
                                "patient_kind": "C_PATTYPE", "starts_at": "D_INDDTO",
                                "ends_at": "D_UDDTO"}),
        "diagnoses": ("lpr_diag", {"record_id": "RECNUM", "diagnosis_id": "C_DIAG",
                                   "diagnosis_kind": "C_DIAGTYPE"}),
    },
    "lpr3": {
        "records": ("lpr_f_kontakter", {"person_id": "PNR", "record_id": "DW_EK_KONTAKT",
                                        "patient_kind": "KONTAKTTYPE",
                                        "starts_at": "DATO_START", "ends_at": "DATO_SLUT"}),
        "diagnoses": ("lpr_f_diagnoser", {"record_id": "DW_EK_KONTAKT",
                                          "diagnosis_id": "DIAGNOSEKODE",
                                          "diagnosis_kind": "DIAGNOSETYPE"}),
    },
}
# -----------------------------------------------------------------------------


def _origins(renames: dict[str, str], register: str) -> dict[str, tuple[str, ...]]:
    return {cur: (f"{register.upper()}:{raw}",) for cur, raw in renames.items()}


def _diag_origins() -> dict[str, tuple[str, ...]]:
    out: dict[str, list[str]] = {}
    for pair in DIAGNOSIS_PAIRS.values():
        for side in ("records", "diagnoses"):
            reg, cols = pair[side]
            for cur, raw in cols.items():
                tag = f"{reg.upper()}:{raw}"
                if tag not in out.setdefault(cur, []):
                    out[cur].append(tag)
    return {k: tuple(v) for k, v in out.items()}


_INC = _origins(INCOME_RENAMES, "ind")
_FAM = _origins(FAMILY_INCOME_RENAMES, "faik")
_EDU = _origins(EDUCATION_RENAMES, "udda")
_POP = _origins(POPULATION_RENAMES, "bef")
_DIAG = _diag_origins()

TABLES: dict[str, TableSpec] = {
    "income": TableSpec(
        "income", "income",
        "Yearly income and taxes per person; a person appears once per tax year. "
        "Tax years {first} to {last}.",
        (
            _c("person_id", "Person id", origin=_INC["person_id"]),
            _c("tax_year", "Tax year", "integer"),
            _c("tax_scope", "Tax liability code", "integer", origin=_INC["tax_scope"]),
            _c("tax_sum", "Total tax", "integer", origin=_INC["tax_sum"]),
            _c("income_main_source", "Main income source code", origin=_INC["income_main_source"]),
            _c("income_social_contrib", "Income contributing to social security", "number",
               origin=_INC["income_social_contrib"]),
            _c("income_employment", "Income from employment", "number",
               origin=_INC["income_employment"]),
            _c("income_social", "Income from social security", "number",
               origin=_INC["income_social"]),
            _c("income_priv_pension", "Income from private pension", "number",
               origin=_INC["income_priv_pension"]),
            _c("income_other", "Income from other sources", "number", origin=_INC["income_other"]),
            _c("income_sum", "Total income", "number", origin=_INC["income_sum"]),
            _SOURCE_FILE,
        ),
        sorted_by=("person_id",), period_columns=("tax_year", "tax_year"),
    ),
    "family_income": TableSpec(
        "family_income", "family_income",
        "Yearly income and taxes per family; a family appears once per tax year. "
        "Tax years {first} to {last}.",
        (
            _c("family_id", "Family id", origin=_FAM["family_id"]),
            _c("family_kind", "Family kind code", "integer", origin=_FAM["family_kind"]),
            _c("tax_year", "Tax year", "integer"),
            _c("tax_sum", "Total tax", "integer", origin=_FAM["tax_sum"]),
            _c("income_social_contrib", "Income contributing to social security", "number",
               origin=_FAM["income_social_contrib"]),
            _c("income_employment", "Income from employment", "number",
               origin=_FAM["income_employment"]),
            _c("income_social", "Income from social security", "number",
               origin=_FAM["income_social"]),
            _c("income_priv_pension", "Income from private pension", "number",
               origin=_FAM["income_priv_pension"]),
            _c("income_other", "Income from other sources", "number", origin=_FAM["income_other"]),
            _c("income_sum", "Total income", "number", origin=_FAM["income_sum"]),
            _SOURCE_FILE,
        ),
        sorted_by=("family_id",), period_columns=("tax_year", "tax_year"),
    ),
    "education": TableSpec(
        "education", "education",
        "Highest completed education per person and year, completed {first} to {last}.",
        (
            _c("person_id", "Person id", origin=_EDU["person_id"]),
            _c("kind", "Education code", "integer", origin=_EDU["kind"]),
            _c("institute", "Institution number", "integer", origin=_EDU["institute"]),
            _c("source", "Source of the record", "integer", origin=_EDU["source"]),
            _c("completed_at", "Completion date", origin=_EDU["completed_at"]),
            _SOURCE_FILE,
        ),
        sorted_by=("person_id",), period_columns=("completed_at", "completed_at"),
    ),
    "employment": TableSpec(
        "employment", "employment",
        "Labour-market status and industry per person and year, years {first} to {last}.",
        (
            _c("person_id", "Person id", origin=("RAS:PNR",)),
            _c("year", "Year", "integer"),
            _c("status_source", "Column the status was taken from"),
            _c("status", "Labour-market status code",
               origin=tuple(f"RAS:{e.column}" for e in STATUS_ERAS) + (f"RAS:{STATUS_DEFAULT}",)),
            _c("industry_source", "Column the industry was taken from"),
            _c("industry", "Industry code", "number",
               origin=tuple(f"RAS:{e.column}" for e in INDUSTRY_ERAS) + (f"RAS:{INDUSTRY_DEFAULT}",)),
            _SOURCE_FILE,
        ),
        sorted_by=("person_id",), period_columns=("year", "year"),
    ),
    "population": TableSpec(
        "population", "population",
        "Persons of the population, first register file wins; born {first} to {last}.",
        (
            _c("person_id", "Person id", origin=_POP["person_id"]),
            _c("gender", "Legal gender", enum=("m", "f"), origin=_POP["gender"]),
            _c("born_at", "Birth date", format=DATE_FORMAT, origin=_POP["born_at"]),
            _c("birthplace_id", "Birth registration authority", "integer",
               origin=_POP["birthplace_id"]),
            _c("mother_id", "Mother's person id", origin=_POP["mother_id"]),
            _c("father_id", "Father's person id", origin=_POP["father_id"]),
            _c("family_id", "Family id", origin=_POP["family_id"]),
            _SOURCE_FILE,
        ),
        sorted_by=("person_id",), period_columns=("born_at", "born_at"),
    ),
    "diagnoses": TableSpec(
        "diagnoses", "diagnoses",
        "Every diagnosis of the patient registers, {first} to {last}.",
        (
            _c("person_id", "Person id", origin=_DIAG["person_id"]),
            _c("record_id", "Record id", origin=_DIAG["record_id"]),
            _c("patient_kind", "Patient kind code", origin=_DIAG["patient_kind"]),
            _c("starts_at", "Record start date", format=DATE_FORMAT, origin=_DIAG["starts_at"]),
            _c("ends_at", "Record end date", nullable=True, format=DATE_FORMAT,
               origin=_DIAG["ends_at"]),
            _c("diagnosis_id", "Diagnosis code", origin=_DIAG["diagnosis_id"]),
            _c("diagnosis_kind", "Diagnosis kind code", origin=_DIAG["diagnosis_kind"]),
            _c("record_source_file", "Source file of the record"),
            _c("diagnosis_source_file", "Source file of the diagnosis"),
        ),
        sorted_by=("person_id", "record_id"), period_columns=("starts_at", "ends_at"),
    ),
    "deaths": TableSpec(
        "deaths", "deaths",
        "Causes of death per person, deceased {first} to {last}.",
        tuple(
            _c(n, t, origin=tuple(f"{v.upper()}:{DEATHS_VARIANTS[v][i]}" for v in DEATHS_VARIANTS))
            for i, (n, t) in enumerate(zip(DEATHS_COLUMNS, (
                "Person id", "Death date", "Mode of death", "Cause of death 1 (ICD)",
                "Cause of death 2 (ICD)", "Cause of death 3 (ICD)", "Cause of death 4 (ICD)")))
        ) + (_SOURCE_FILE,),
        sorted_by=("person_id",), period_columns=("deceased_at", "deceased_at"),
    ),
    "prescriptions": TableSpec(
        "prescriptions", "prescriptions",
        "Dispensed prescriptions, split by ATC category, dispensed {first} to {last}.",
        tuple(
            _c(n, t, ty, nullable=(n == "atc_id"), origin=(f"LMDB:{raw}",))
            for n, raw, t, ty in zip(
                PRESCRIPTION_COLUMNS, REGISTERS["lmdb"].columns,
                ("Person id", "ATC code", "Item number", "Dispensing date", "Volume",
                 "Volume type code", "Pack size", "Strength", "Strength unit", "Dosage form"),
                ("string", "code", "string", "string", "number", "string", "string", "number",
                 "string", "string"))
        ) + (_SOURCE_FILE,),
        period_columns=("dispensed_at", "dispensed_at"), partition_by=("atc_category",),
        extra={"categories": ATC_CATEGORIES},
    ),
}

# What a column holds and what its values look like, for the sidecars; columns
# that mean the same in several tables are described once.
_ABOUT: dict[str, tuple[str, tuple[str, ...]]] = {
    "person_id": ("Pseudonymous id of a person, the same in every table; leading zeros count.",
                  ("0012345", "778120")),
    "family_id": ("Pseudonymous id of the family a person belongs to.", ("000451", "90377")),
    "source_file": ("Name of the extract file the row was landed from.",
                    ("ind2001.sas7bdat", "bef198512.sas7bdat")),
    "tax_year": ("Year the income and taxes belong to, from the file name; empty for an "
                 "undated extract.", ("1985", "2014")),
    "tax_scope": ("Code telling whether, and how fully, the person is liable to tax.",
                  ("0", "3")),
    "tax_sum": ("All taxes of the year together.", ("41250.50", "0")),
    "income_main_source": ("Code of the activity most of the income comes from.", ("08", "13")),
    "income_social_contrib": ("Business income on which social contributions are paid.",
                              ("12000", "0")),
    "income_employment": ("Wages and salaries.", ("245000", "0")),
    "income_social": ("Public transfers.", ("31000", "0")),
    "income_priv_pension": ("Payments from private pensions.", ("0", "87000")),
    "income_other": ("Income that falls under none of the other kinds.", ("150", "0")),
    "income_sum": ("All income of the year before tax.", ("310500", "98000")),
    "family_kind": ("Code of the kind of family.", ("1", "5")),
    "kind": ("Code of the highest completed education.", ("1099", "4407")),
    "institute": ("Number of the institution that awarded it.", ("101303", "109321")),
    "source": ("Code of the source that reported the education.", ("1", "14")),
    "completed_at": ("Date from which the education counts as completed.",
                     ("1994-06-30", "2010-01-31")),
    "year": ("Year of the record, from the file name; empty for an undated extract.",
             ("1991", "199311")),
    "status_source": ("Register column the status was taken from; it depends on the year.",
                      ("ARBSTIL", "SOC_STATUS_KODE")),
    "status": ("Code of the person's position on the labour market.", ("3", "112")),
    "industry_source": ("Register column the industry was taken from; it depends on the year.",
                        ("BRANCHE_77", "ARB_HOVED_BRA_DB07")),
    "industry": ("Code of the industry the person works in.", ("017", "861000")),
    "gender": ("Legal gender.", ("m", "f")),
    "born_at": ("Date of birth.", ("1948-11-02", "2001-05-17")),
    "birthplace_id": ("Code of the authority that registered the birth.", ("101", "8401")),
    "mother_id": ("Person id of the mother, if known.", ("0012346", "")),
    "father_id": ("Person id of the father, if known.", ("0012347", "")),
    "record_id": ("Id of a hospital record; unique within one register and period only.",
                  ("500120", "13")),
    "patient_kind": ("Code telling in- from out-patients.", ("0", "2")),
    "starts_at": ("Date on which the record begins.", ("1987-03-09", "2015-12-24")),
    "ends_at": ("Date on which the record ends; empty while it is open.", ("1987-03-12", "")),
    "diagnosis_id": ("Diagnosis code of the classification then in use.", ("DF32", "DJ459")),
    "diagnosis_kind": ("Code telling main from additional diagnoses.", ("A", "B")),
    "record_source_file": ("Name of the extract file the record was landed from.",
                           ("lpr_adm1994.sas7bdat",)),
    "diagnosis_source_file": ("Name of the extract file the diagnosis was landed from.",
                              ("lpr_diag1994.sas7bdat",)),
    "deceased_at": ("Date of death.", ("1993-06-04", "2008-11-30")),
    "mode": ("Code of the manner of death.", ("01", "07")),
    "cause_1_icd_id": ("Underlying cause of death.", ("9002", "DI219")),
    "cause_2_icd_id": ("Second cause of death on the certificate.", ("9005", "")),
    "cause_3_icd_id": ("Third cause of death on the certificate.", ("9001", "")),
    "cause_4_icd_id": ("Fourth cause of death on the certificate.", ("9003", "")),
    "atc_id": ("ATC code of the drug; empty if none was reported.", ("N06AB04", "")),
    "ibnr_id": ("Number of the dispensing pharmacy's item.", ("27", "118")),
    "dispensed_at": ("Date on which the drug was handed out.", ("1996-02-20", "2013-07-01")),
    "volume": ("Amount handed out, in the unit of the volume type.", ("28", "100")),
    "volume_type_code": ("Unit in which the volume is counted.", ("A", "N")),
    "pack_size": ("Content of one pack.", ("1", "30")),
    "strength": ("Strength of the drug, in the unit given next to it.", ("25", "0.5")),
    "strength_unit": ("Unit of the strength.", ("MG", "O")),
    "dosage_form": ("Form in which the drug is taken.", ("INJVSKS", "TABFILM")),
}


def _about(spec: TableSpec) -> TableSpec:
    told = tuple(replace(c, description=_ABOUT[c.name][0], examples=_ABOUT[c.name][1])
                 for c in spec.columns)
    return replace(spec, columns=told)


TABLES = {k: _about(t) for k, t in TABLES.items()}


def table(key: str) -> TableSpec:
    return TABLES[key]

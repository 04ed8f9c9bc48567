"""Landing specs: which registers exist, which columns to keep, in what order.

These are data, not code. The column lists are the fixed whitelist of the
register extracts (the same names and the same order the source publishes);
column order is part of the contract because two curated tables rename by
position.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class RegisterSpec:
    """One register ("dataset"): a named table that arrives as many files.

    ``dated`` registers arrive as ``<name><period>.<ext>`` (period = YYYY or
    YYYYMM digits); undated ("external") registers arrive as ``<name>.<ext>``
    and get period ``"0"``. Note that ``patient_icd8`` ends in digits that are
    part of its name, so the period of an undated register is never taken
    from the file name.
    """

    name: str
    columns: tuple[str, ...]
    dated: bool = True

    def schema(self, with_source_file: bool = False) -> T.StructType:
        """All-string schema: ids carry leading zeros, nothing is inferred."""
        fields = [T.StructField(c, T.StringType(), True) for c in self.columns]
        if with_source_file:
            fields.append(T.StructField("source_file", T.StringType(), True))
        return T.StructType(fields)


# --- fixed values: register column whitelists, in spec order -----------------
REGISTERS: dict[str, RegisterSpec] = {
    s.name: s
    for s in [
        RegisterSpec("bef", ("PNR", "KOEN", "FOED_DAG", "FOEDREG_KODE", "MOR_ID", "FAR_ID",
                             "FAMILIE_ID", "ADRESSE_ID", "BOPIKOM", "BOP_VFRA")),
        RegisterSpec("lmdb", ("PNR", "ATC", "IBNR", "EKSD", "VOLUME", "VOLTYPECODE", "PACKSIZE",
                              "STRNUM", "STRUNIT", "DOSFORM")),
        RegisterSpec("ind", ("PNR", "ALDER_ULT_INK", "BESKST13", "OMFANG", "PERINDKIALT_13",
                             "LOENMV_13", "ERHVERVSINDK_13", "OFF_OVERFORSEL_13",
                             "PRIVAT_PENSION_13", "RESUINK_13", "SKATTOT_13")),
        RegisterSpec("dodsaars", ("PNR", "D_DODSDTO", "C_DODSMAADE", "C_DOD1", "C_DOD2", "C_DOD3",
                                  "C_DOD4")),
        RegisterSpec("dodsaasg", ("PNR", "D_DODSDATO", "C_DODSMAADE", "C_DOD_1A", "C_DOD_1B",
                                  "C_DOD_1C", "C_DOD_1D")),
        RegisterSpec("faik", ("FAMILIE_ID", "FAMTYPE", "FAMINDKOMSTIALT_13", "FAMLOENMV_13",
                              "FAMERHVERVSINDK_13", "FAMOFF_OVERFORSEL_13",
                              "FAMPRIVAT_PENSION_13", "FAMRESTINDK_13", "FAMSKATTOT_13")),
        RegisterSpec("udda", ("PNR", "HFAUDD", "HFINSTNR", "HF_KILDE", "HF_VFRA", "UDD")),
        RegisterSpec("ras", ("PNR", "ARBSTIL", "NYARB", "SOCSTIL_KODE", "SOC_STATUS_KODE",
                             "BRANCHE_77", "BRANCHE_KODE", "ARB_HOVED_BRA_DB07")),
        # akm: the shipped spec repeats the ras columns (a generator mix-up); the
        # register's real columns are these. The ras-shaped spec is kept below
        # as AKM_AS_SHIPPED to show tolerant projection.
        RegisterSpec("akm", ("PNR", "SOCIO", "SOCIO_GL", "SOCIO02", "SOCIO13")),
        RegisterSpec("lpr_adm", ("RECNUM", "PNR", "C_PATTYPE", "D_INDDTO", "D_UDDTO")),
        RegisterSpec("lpr_diag", ("RECNUM", "C_DIAG", "C_DIAGTYPE")),
        RegisterSpec("psyk_adm", ("RECNUM", "PNR", "C_PATTYPE", "D_INDDTO", "D_UDDTO")),
        RegisterSpec("psyk_diag", ("RECNUM", "C_DIAG", "C_DIAGTYPE")),
        RegisterSpec("lpr_f_kontakter", ("DW_EK_KONTAKT", "PNR", "KONTAKTTYPE", "DATO_START",
                                         "DATO_SLUT")),
        RegisterSpec("lpr_f_diagnoser", ("DW_EK_KONTAKT", "DIAGNOSEKODE", "DIAGNOSEKODE_PARENT",
                                         "DIAGNOSETYPE")),
        RegisterSpec("patient_icd8", ("PAT_SEQ", "CPRNR", "PTTYPE", "INDLDATO", "UDSKDATO",
                                      "HOVEDDIAG", "MODIFHD"), dated=False),
        RegisterSpec("patient_icd10", ("PAT_SEQ", "CPRNR", "PTTYPE", "INDLDATO", "UDSKDATO"),
                     dated=False),
        RegisterSpec("diag_icd10", ("PAT_SEQ", "DIAG", "DART"), dated=False),
    ]
}

AKM_AS_SHIPPED = RegisterSpec("akm", REGISTERS["ras"].columns)

# columns a curated table filters its rows by; a file without one cannot be
# curated (registers not named here are curated without a key)
KEY_COLUMNS: dict[str, tuple[str, ...]] = {
    "bef": ("PNR",), "ind": ("PNR",), "faik": ("FAMILIE_ID",), "udda": ("PNR",), "ras": ("PNR",),
    "lpr_adm": ("RECNUM", "PNR"), "lpr_diag": ("RECNUM",),
    "psyk_adm": ("RECNUM", "PNR"), "psyk_diag": ("RECNUM",),
    "lpr_f_kontakter": ("DW_EK_KONTAKT", "PNR"), "lpr_f_diagnoser": ("DW_EK_KONTAKT",),
    "patient_icd8": ("PAT_SEQ", "CPRNR"), "patient_icd10": ("PAT_SEQ", "CPRNR"),
    "diag_icd10": ("PAT_SEQ",),
}
# -----------------------------------------------------------------------------


def spec(name: str) -> RegisterSpec:
    try:
        return REGISTERS[name]
    except KeyError:
        raise KeyError(f"register {name!r} is not in the landing spec") from None


def specs_from_json(doc: dict) -> dict[str, RegisterSpec]:
    """Build specs from a ``{"stage1": {name: {"columns": [...]}}}`` document.

    Registers that are undated in the built-in spec stay undated.
    """
    out = {}
    for name, body in doc.get("stage1", {}).items():
        dated = REGISTERS[name].dated if name in REGISTERS else True
        out[name] = RegisterSpec(name, tuple(body["columns"]), dated)
    return out

"""Layouts, lookup tables and other fixed values of the registry dump."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

SQL_TYPES = {"text": T.StringType(), "integer": T.LongType(), "numeric": T.DecimalType(18, 2), "date": T.DateType(), "boolean": T.BooleanType()}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "text"
    required: bool = False


# The columns of each dataset, in file order.
LAYOUTS: dict[str, tuple[Field, ...]] = {
    "companies": (
        Field("cnpj_root", required=True),
        Field("company_name", required=True),
        Field("legal_nature_code", required=True),
        Field("responsible_qualification_code", required=True),
        Field("share_capital", "numeric", required=True),
        Field("company_size_code", required=True),
        Field("responsible_federative_entity"),
    ),
    "establishments": (
        Field("cnpj_root", required=True),
        Field("cnpj_order", required=True),
        Field("cnpj_check_digits", required=True),
        Field("branch_type_code", required=True),
        Field("trade_name"),
        Field("registration_status_code", required=True),
        Field("registration_status_date", "date"),
        Field("registration_status_reason_code"),
        Field("foreign_city_name"),
        Field("country_code"),
        Field("activity_start_date", "date"),
        Field("main_cnae_code", required=True),
        Field("secondary_cnaes_raw"),
        Field("street_type"),
        Field("street_name"),
        Field("street_number"),
        Field("address_complement"),
        Field("district"),
        Field("postal_code"),
        Field("state_code"),
        Field("city_code"),
        Field("phone_area_code_1"),
        Field("phone_number_1"),
        Field("phone_area_code_2"),
        Field("phone_number_2"),
        Field("fax_area_code"),
        Field("fax_number"),
        Field("email"),
        Field("special_status"),
        Field("special_status_date", "date"),
    ),
    "partners": (
        Field("cnpj_root", required=True),
        Field("partner_type_code", required=True),
        Field("partner_name", required=True),
        Field("partner_document"),
        Field("partner_qualification_code", required=True),
        Field("entry_date", "date"),
        Field("country_code"),
        Field("legal_representative_document"),
        Field("legal_representative_name"),
        Field("legal_representative_qualification_code"),
        Field("age_group_code"),
    ),
    "simples_options": (
        Field("cnpj_root", required=True),
        Field("simples_option_flag"),
        Field("simples_option_date", "date"),
        Field("simples_exclusion_date", "date"),
        Field("mei_option_flag"),
        Field("mei_option_date", "date"),
        Field("mei_exclusion_date", "date"),
    ),
    "countries": (Field("code", required=True), Field("description", required=True)),
    "cities": (Field("code", required=True), Field("description", required=True)),
    "partner_qualifications": (Field("code", required=True), Field("description", required=True)),
    "legal_natures": (Field("code", required=True), Field("description", required=True)),
    "cnaes": (Field("code", required=True), Field("description", required=True)),
    "reasons": (Field("code", required=True), Field("description", required=True)),
}

STAGED = ("companies", "establishments", "simples_options", "partners")  # in the order of materialisation
LOOKUPS = ("countries", "cities", "partner_qualifications", "legal_natures", "cnaes", "reasons")

# Codes that a blank field stands for.
DEFAULTS = {"companies": {"company_size_code": "00"}, "establishments": {"branch_type_code": "1", "registration_status_code": "01"}}

# Keys of the final tables.
KEYS = {"companies": ("cnpj_root",), "establishments": ("cnpj_full",), "simples_options": ("cnpj_root",), "partners": ("partner_dedupe_key",)} | {x: ("code",) for x in LOOKUPS}

# Lookup tables that are seeded, not imported.
SEEDS: dict[str, dict[str, str]] = {
    "company_sizes": {"00": "Not informed", "01": "Micro company", "03": "Small business", "05": "Other"},
    "branch_types": {"1": "Headquarters", "2": "Branch"},
    "registration_statuses": {"01": "Null", "2": "Active", "3": "Suspended", "4": "Inactive", "08": "Closed"},
    "partner_types": {"1": "Legal entity", "2": "Natural person", "3": "Foreign person/entity"},
    "age_groups": {
        "0": "Not applicable", "1": "0 to 12 years", "2": "13 to 20 years", "3": "21 to 30 years", "4": "31 to 40 years",
        "5": "41 to 50 years", "6": "51 to 60 years", "7": "61 to 70 years", "8": "71 to 80 years", "9": "Over 80 years",
    },
}

# What a placeholder for an unknown code is called.
PLACEHOLDERS = {
    "partner_qualifications": "Imported placeholder qualification", "legal_natures": "Imported placeholder legal nature", "company_sizes": "Imported placeholder company size",
    "branch_types": "Imported placeholder branch type", "registration_statuses": "Imported placeholder registration status", "reasons": "Imported placeholder registration reason",
    "countries": "Imported placeholder country", "cnaes": "Imported placeholder CNAE", "cities": "Imported placeholder city",
    "partner_types": "Imported placeholder partner type", "age_groups": "Imported placeholder age group",
}

# Names of files, in the publisher's two spellings.
FULL_NAMES = {
    "empresas": "companies", "estabelecimentos": "establishments", "socios": "partners", "simples": "simples_options", "paises": "countries",
    "municipios": "cities", "qualificacoes": "partner_qualifications", "naturezas": "legal_natures", "cnaes": "cnaes", "motivos": "reasons",
}
SHORT_NAMES = {
    "emprecsv": "companies", "estabele": "establishments", "sociocsv": "partners", "simplescsv": "simples_options", "paiscsv": "countries",
    "municcsv": "cities", "qualscsv": "partner_qualifications", "natjucsv": "legal_natures", "cnaecsv": "cnaes", "moticsv": "reasons",
}

# Which lookup each coded column refers to.
REFERENCES = {
    "companies": {"legal_nature_code": "legal_natures", "responsible_qualification_code": "partner_qualifications", "company_size_code": "company_sizes"},
    "establishments": {
        "branch_type_code": "branch_types", "registration_status_code": "registration_statuses", "registration_status_reason_code": "reasons",
        "country_code": "countries", "main_cnae_code": "cnaes", "city_code": "cities",
    },
    "partners": {
        "partner_type_code": "partner_types", "partner_qualification_code": "partner_qualifications", "country_code": "countries",
        "legal_representative_qualification_code": "partner_qualifications", "age_group_code": "age_groups",
    },
}


def schema(dataset: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, SQL_TYPES[f.kind], not f.required) for f in LAYOUTS[dataset]])


def summary() -> list[tuple[str, int, int]]:
    """(dataset, columns, required columns)."""
    return [(k, len(v), sum(f.required for f in v)) for k, v in LAYOUTS.items()]

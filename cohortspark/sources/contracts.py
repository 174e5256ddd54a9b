"""Columns and types every input table must have."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

_ID = (IntegerType, LongType)
_DATE = (DateType,)
_TEXT = (StringType,)
_PARSED_DATE = (DateType, TimestampType, TimestampNTZType, StringType)
_NUMBER = (IntegerType, LongType, DoubleType, DecimalType)

# Table -> column -> accepted types.
CONTRACTS: dict[str, dict[str, tuple[type, ...]]] = {
    "enrollment": {
        "patid": _ID, "enr_start": _DATE, "enr_end": _DATE, "drugcov": _TEXT, "medcov": _TEXT,
    },
    "demographic": {
        "patid": _ID, "birth_date": _DATE, "sex": _TEXT, "race": _TEXT, "hispanic": _TEXT,
    },
    "dispensing": {"patid": _ID, "rxdate": _DATE},
    "encounter": {"patid": _ID, "adate": _DATE},
    "lab": {
        "patid": _ID, "lab_dt": _PARSED_DATE, "result_dt": _PARSED_DATE, "order_dt": _PARSED_DATE,
    },
    "death": {"patid": _ID, "deathdt": _DATE},
    "mil": {
        "mpatid": _ID, "encounterid": _ID, "cpatid": _ID, "enctype": _TEXT,
        "birth_type": _ID, "age": _NUMBER, "adate": _DATE,
    },
    "vitals": {
        "patid": _ID, "measure_date": _DATE, "ht": _NUMBER, "wt": _NUMBER,
        "diastolic": _NUMBER, "systolic": _NUMBER,
    },
}


class SchemaError(ValueError):
    """An input table lacks a column or has one of the wrong type."""


def _contract(table: str) -> dict[str, tuple[type, ...]]:
    try:
        return CONTRACTS[table]
    except KeyError:
        raise ValueError(f"no table {table!r}; known: {', '.join(CONTRACTS)}") from None


def _fields(schema: StructType) -> dict[str, StructField]:
    # Spark resolves column names regardless of case, so the contract does too.
    return {field.name.lower(): field for field in schema}


def missing_columns(table: str, schema: StructType) -> list[str]:
    """Contract columns the schema lacks."""
    present = _fields(schema)
    return [column for column in _contract(table) if column not in present]


def unsuitable_columns(table: str, schema: StructType) -> list[str]:
    """One finding per present contract column whose type is not accepted."""
    present = _fields(schema)
    return [
        f"{column} is {present[column].dataType.simpleString()}, "
        f"expected {' or '.join(t.typeName() for t in accepted)}"
        for column, accepted in _contract(table).items()
        if column in present and not isinstance(present[column].dataType, accepted)
    ]


def require_schema(table: str, schema: StructType) -> None:
    """Raise ``SchemaError`` unless the schema meets the contract. Runs no Spark job."""
    findings = [f"{column} is missing" for column in missing_columns(table, schema)]
    findings += unsuitable_columns(table, schema)
    if findings:
        raise SchemaError(f"table {table}: {'; '.join(findings)}")

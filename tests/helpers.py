"""Small input tables and row access for the tests."""

import os
from datetime import date

SCHEMAS = {
    "enrollment": "patid long, enr_start date, enr_end date, drugcov string, medcov string",
    "demographic": "patid long, birth_date date, sex string, race string, hispanic string",
    "dispensing": "patid long, rxdate date",
    "encounter": "patid long, adate date",
    "lab": "patid long, lab_dt date, result_dt date, order_dt date",
    "death": "patid long, deathdt date",
    "mil": "mpatid long, encounterid long, cpatid long, enctype string, birth_type int, "
    "age int, adate date",
    "vitals": "patid long, measure_date date, ht int, wt double, diastolic int, systolic int",
}


def day(text):
    return None if text is None else date.fromisoformat(text)


def make(spark, table, *rows):
    """A table of the given contract; ISO texts in date columns become dates."""
    return typed(spark, SCHEMAS[table], *rows)


def typed(spark, schema, *rows):
    kinds = [field.split()[1] for field in schema.split(",")]
    cells = [
        tuple(day(v) if kind == "date" and isinstance(v, str) else v for v, kind in zip(r, kinds))
        for r in rows
    ]
    return spark.createDataFrame(cells, schema)


def enrollment(spark, *rows, drugcov="Y", medcov="Y"):
    """Enrollment rows from (patid, start, end)."""
    return make(spark, "enrollment", *[(*row, drugcov, medcov) for row in rows])


def rows(frame, *columns):
    """Rows as sorted tuples, dates as ISO text."""
    picked = frame.select(*columns) if columns else frame
    plain = [
        tuple(v.isoformat() if isinstance(v, date) else v for v in row) for row in picked.collect()
    ]
    return sorted(plain, key=lambda row: tuple((v is not None, str(v)) for v in row))


def stored_scratch(spark):
    """Names of the scratch folders that exist now."""
    shared = spark.conf.get("spark.checkpoint.dir")
    return sorted(name for name in os.listdir(shared) if name.startswith("scratch-"))

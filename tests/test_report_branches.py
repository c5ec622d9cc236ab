"""The registered reports exercise their branches: every output column takes
several values, but for the columns listed with the reason."""

import pytest
from pyspark.sql import functions as F

from tablero.plans.reports import report
from tablero.plans.standins import REGISTRY
from tablero.plans.standins.reports import REPORT_AS_OF
from tablero.sources.derived import derived_tables

SF = "/root/testdata/sf0.01"

#: Columns that hold one value by the report's own rule or the derived tables' design.
CONSTANT: dict[str, set[str]] = {}


@pytest.mark.parametrize("name", sorted(k for k in REGISTRY if k.startswith("report_")))
def test_columns_vary(spark, name):
    df = REGISTRY[name](spark, SF)
    counts = df.select(*[(F.approx_count_distinct(F.col(f"`{c}`")) + F.max(F.col(f"`{c}`").isNull()).cast("int")).alias(f"c{i}")
                         for i, c in enumerate(df.columns)]).first()
    constant = {c for i, c in enumerate(df.columns) if counts[i] < 2}
    assert constant == CONSTANT.get(name, set())


#: Output column by which each report with an ORDER BY comes out, latest first and NULL before all.
LATEST_FIRST = {"payments": "Fecha de Pago", "applications": "Fecha Creacion Aplicacion", "tenants": "Fecha de Registro",
                "owners": "Fecha de Registro", "promocodes": "Fecha de Creación", "webscraping_rents": "created_at",
                "webscraping_rents_i24": "created_at"}


@pytest.mark.parametrize("name", sorted(LATEST_FIRST))
def test_final_order(spark, name):
    df = report(name, derived_tables(spark, "/root/testdata/sf0.001"), REPORT_AS_OF)
    got = [r[0] for r in df.select(F.col(f"`{LATEST_FIRST[name]}`")).collect()]
    nulls = got.count(None)
    assert got[:nulls] == [None] * nulls and got[nulls:] == sorted(got[nulls:], reverse=True)
    assert len(set(got)) > 1


def test_active_rents_order(spark):
    df = report("active_rents", derived_tables(spark, "/root/testdata/sf0.001"), REPORT_AS_OF)
    got = [(str(r[0].year), f"{r[0]:%B}".lower(), r[1]) for r in df.select("mes", F.col("`tipo de cargo`")).collect()]
    assert got == sorted(got) and len(set(got)) > 20

"""The twelve reports. Each ``build(tables, as_of, tz=..., ordered=True)``
returns a lazy DataFrame with the report's labelled columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from tablero.plans.reports import (active_rents, applications, contracts, homes, leads, listings, owners,
                                   payments, promocodes, rents, tenants)

REPORTS: dict[str, Callable[..., DataFrame]] = {
    "homes": homes.build,
    "payments": payments.build,
    "active_rents": active_rents.build,
    "applications": applications.build,
    "rents": rents.build,
    "tenants": tenants.build,
    "webscraping_rents": listings.build_rents,
    "contracts": contracts.build,
    "owners": owners.build,
    "webscraping_rents_i24": listings.build_i24,
    "leads": leads.build,
    "promocodes": promocodes.build,
}


def report(name: str, tables: Mapping[str, DataFrame], as_of: dt.datetime | str, **options) -> DataFrame:
    """Build report ``name`` over ``tables`` at the fixed time ``as_of`` (UTC)."""
    return REPORTS[name](tables, as_of=as_of, **options)


__all__ = ["REPORTS", "report"]

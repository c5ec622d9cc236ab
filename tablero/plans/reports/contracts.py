"""R8 contracts: one row per contract with renewal state ladders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ
from tablero.functions import label_map, to_local, yes_no
from tablero.plans.reports._common import labelled, lookups

# Output labels, in report order.
LABELS = [
    ("contract_id", "Id de Contrato"),
    ("created_at", "Fecha Creacion Contrato"),
    ("signed_at", "Fecha Firma de Contrato"),
    ("parent_rent_id", "Id Renta Previa"),
    ("parent_status", "Status Renta Previa"),
    ("rent_id", "Id de Renta"),
    ("started_at", "Fecha de Inicio"),
    ("ends_at", "Fecha de Finalización"),
    ("contract_status", "Status de Contrato"),
    ("rent_status", "Status de Renta"),
    ("is_renewal", "Renovación"),
    ("renewed_contract_state", "Status de Contrato Renovado"),
    ("new_contract_state", "Status de Nuevo Contrato"),
]


# The contract's state by its status while unsigned, for a renewal and for a first contract.
SIGNED = "Firmado"
NO_STATE = "NA"
UNSIGNED_RENEWAL = {"not_renewed": "No Renovado", "canceled": "No Renovado",
                    "pending": "Pendiente de Firma", "renewal_process": "Pendiente de Firma"}
UNSIGNED_NEW = {"canceled": "Cancelado", "pending": "Pendiente de Firma"}


def build(tables: Mapping[str, DataFrame], as_of=None, tz: str = DEFAULT_TZ, ordered: bool = True) -> DataFrame:
    contracts = tables["mongo_rent_contracts"]
    rents = tables["mongo_rents"].select(F.col("_id").alias("r_id"), F.col("parent_rent_id"),
                                         F.col("_status").alias("rent_status"))
    parents = tables["mongo_rents"].select(F.col("_id").alias("p_id"), F.col("_status").alias("parent_status"))
    # most rents have no parent, and a contract may have no rent
    j = lookups(contracts, [contracts._id], [(contracts.rent_id, (rents, "r_id")), ("parent_rent_id", (parents, "p_id"))])
    renewal = F.col("parent_rent_id").isNotNull()
    signed = contracts.signed_at.isNotNull()
    st = contracts._status

    def state(applies: Column, unsigned: Mapping[str, str]) -> Column:
        label = F.when(signed, F.lit(SIGNED)).otherwise(label_map(st, unsigned))
        return F.coalesce(F.when(applies, label), F.lit(NO_STATE))

    renewed_state, new_state = state(renewal, UNSIGNED_RENEWAL), state(~renewal, UNSIGNED_NEW)
    out = j.select(contracts._id.alias("contract_id"), to_local(contracts.created_at, tz).alias("created_at"),
                   contracts.signed_at, "parent_rent_id", "parent_status", contracts.rent_id,
                   contracts.started_at, contracts.ends_at, st.alias("contract_status"), "rent_status",
                   yes_no(renewal).alias("is_renewal"), renewed_state.alias("renewed_contract_state"),
                   new_state.alias("new_contract_state"))
    return labelled(out, LABELS)

"""R9 owners report: one row per owner with portfolio counts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ
from tablero.functions import full_name, to_local
from tablero.operators import any_one_per_key, count_when
from tablero.plans.reports._common import alias_cols, sort_then_label

# Output labels, in report order.
LABELS = [
    ("owner_id", "Id de Propietario"),
    ("registered_at", "Fecha de Registro"),
    ("owner_name", "Nombre del Propietario"),
    ("owner_phone", "Telefono Propietario"),
    ("person_type", "Tipo de Persona"),
    ("campaign", "Campaña"),
    ("marketing_source", "Marketing Source"),
    ("referral_code", "Código Referido"),
    ("homes", "Inmuebles"),
    ("published_homes", "Inmuebles Publicados"),
    ("acquisition_advisor_email", "Email Asesor de Adquisiciones"),
]


def build(tables: Mapping[str, DataFrame], as_of=None, tz: str = DEFAULT_TZ, ordered: bool = True) -> DataFrame:
    homes = tables["mongo_homes"]
    counts = count_when(homes, "owner_id", {"published_homes": F.col("_status") == "published"}, total="homes")
    # One 'sells' advisor per user; the source picks an arbitrary one, here
    # the one whose e-mail sorts first.
    sells = any_one_per_key(tables["mongo_users_super_heroes"].filter(F.col("_super_hero_type") == "sells"),
                            "mongo_users_id", columns=["email"])
    owners = tables["mongo_owners"]
    users = alias_cols(tables["mongo_users"], "u_",
                       ["id", "_id", "name", "last_name", "second_last_name", "mobile_phone", "_person_type",
                        "campaign", "referred_by_code"])
    j = (owners.join(users, owners.user_id == users.u__id, "left")
               .join(counts, counts.owner_id == owners._id, "left")
               .join(sells, users.u_id == sells.mongo_users_id, "left"))
    registered = to_local(owners.created_at, tz)
    out = j.select(
        owners._id.alias("owner_id"), registered.alias("registered_at"),
        full_name("u_name", "u_last_name", "u_second_last_name", null_as="").alias("owner_name"),
        F.col("u_mobile_phone").alias("owner_phone"), F.col("u__person_type").alias("person_type"),
        F.col("u_campaign").alias("campaign"), owners.marketing_source.alias("marketing_source"),
        F.col("u_referred_by_code").alias("referral_code"), "homes", "published_homes",
        sells.email.alias("acquisition_advisor_email"))
    return sort_then_label(out, LABELS, [F.col("registered_at").desc_nulls_first()], ordered)

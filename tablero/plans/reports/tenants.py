"""R6 tenants: every user who ever acted as tenant."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ
from tablero.functions import join_parts, to_local
from tablero.operators import any_one_per_key, first_per_key, members, population
from tablero.plans.reports._common import sort_then_label

# Output labels, in report order.
LABELS = [
    ("user_id", "Id de Usuario"),
    ("registered_at", "Fecha de Registro"),
    ("tenant_name", "Nombre del Inquilino"),
    ("email", "Email del Inquilino"),
    ("mobile_phone", "Telefono Inquilino"),
    ("phone", "Telefono Alternativo"),
    ("person_type", "Tipo de Persona"),
    ("degree", "Grado de Estudios"),
    ("has_children", "hijos"),
    ("marital_status", "Estado civil"),
    ("country_of_birth", "Pais Natal"),
    ("date_of_birth", "Fecha de Nacimiento"),
    ("advisor_name", "Asesor de Rentas"),
    ("advisor_email", "Email del Asesor de Rentas"),
    ("listing_source", "Nombre de Listado"),
]

# Fixed value: listing source of users with no tracked message.
ORGANIC = "Organico"


def build(tables: Mapping[str, DataFrame], as_of=None, tz: str = DEFAULT_TZ, ordered: bool = True) -> DataFrame:
    # One 'ops' advisor per user (arbitrary in the source; first by name, e-mail here).
    ops = any_one_per_key(tables["mongo_users_super_heroes"].filter(F.col("_super_hero_type") == "ops"),
                          "mongo_users_id", columns=["name", "email"])
    ops = ops.select(F.col("mongo_users_id").alias("ops_user"), F.col("name").alias("advisor_name"),
                     F.col("email").alias("advisor_email"))
    # First tracked message per e-mail; equal times broken by provider.
    gmail = first_per_key(tables["mongo_google_gmail_messages"], "email", ["created_at"], tie_break=["provider"],
                          columns=["provider"]).withColumnRenamed("email", "gm_email")
    tenants = population((tables["mongo_home_home_meetings"], "user_id"),
                         (tables["mongo_home_applications"], "user_id"),
                         (tables["mongo_rents"], "user_id"), name="tenant_id")
    users = members(tables["mongo_users"], "_id", tenants, "tenant_id")
    j = (users.join(ops, users.id == F.col("ops_user"), "left")
              .join(gmail, users.email == F.col("gm_email"), "left"))
    out = j.select(users._id.alias("user_id"), to_local(users.created_at, tz).alias("registered_at"),
                   join_parts(users.name, users.last_name, users.second_last_name).alias("tenant_name"),
                   users.email, users.mobile_phone, users.phone, users._person_type.alias("person_type"),
                   users.degree, users.has_children, users.marital_status, users.country_of_birth,
                   users.date_of_birth, "advisor_name", "advisor_email",
                   F.coalesce(F.col("provider"), F.lit(ORGANIC)).alias("listing_source"),
                   users.created_at.alias("_sort"))
    return sort_then_label(out, LABELS, [F.col("_sort").desc_nulls_first()], ordered)

"""R11 leads: one row per lead with the discard reasons of archived leads."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ
from tablero.functions import full_name, to_local
from tablero.operators import list_join
from tablero.plans.reports._common import alias_cols, labelled

# Output labels, in report order (spelling as published).
LABELS = [
    ("lead_id", "Id Lead"),
    ("tenant_name", "Nombre del Inquilino"),
    ("phone", "Telefono Inqulino"),
    ("mobile_phone", "Telefono Alternativo"),
    ("email", "Email del Inqulino"),
    ("country", "Pais Natal"),
    ("created_at", "Fecha Creacion Lead"),
    ("status", "Status Lead"),
    ("representative", "Representante"),
    ("representative_email", "Email Representante"),
    ("archived", "Lead Archivado"),
    ("archived_at", "Fecha de Archivo"),
    ("archive_reason", "Razon de Archivo"),
]

# Fixed value: tagging context of discard reasons.
DISCARD_CONTEXT = "lead_cancellations"


def build(tables: Mapping[str, DataFrame], as_of=None, tz: str = DEFAULT_TZ, ordered: bool = True) -> DataFrame:
    leads = tables["postgres_leads"]
    taggings = tables["postgres_taggings"].filter(F.col("context") == DISCARD_CONTEXT)
    tags = tables["postgres_tags"].select(F.col("id").alias("tag_key"), F.col("name").alias("tag_name"))
    tagged = (leads.select(F.col("id").alias("lead_key"))
                   .join(taggings, taggings.taggable_id == F.col("lead_key"), "inner")
                   .join(tags, F.col("tag_key") == taggings.tag_id, "left"))
    # The source orders the list by the grouping key (arbitrary); by tag name here.
    reasons = list_join(tagged, "lead_key", "tag_name", sep=" & ", name="archive_reason")
    users = alias_cols(tables["postgres_users"], "u_", ["id", "name", "last_name", "mother_last_name", "email"])
    countries = alias_cols(tables["postgres_countries"], "c_", ["id", "name"])
    archived = leads.discarded_at.isNotNull()
    j = (leads.join(users, leads.user_id == users.u_id, "left")
              .join(countries, leads.country_code == countries.c_id, "left")
              # the lead-side predicate stays in the join condition
              .join(reasons, (reasons.lead_key == leads.id) & archived, "left"))
    out = j.select(
        leads.id.alias("lead_id"),
        full_name(leads.name, leads.last_name, leads.mother_last_name, null_as="").alias("tenant_name"),
        leads.phone, leads.mobile_phone, leads.email, F.col("c_name").alias("country"),
        to_local(leads.created_at, tz).alias("created_at"), leads.status,
        full_name("u_name", "u_last_name", "u_mother_last_name", null_as="").alias("representative"),
        F.col("u_email").alias("representative_email"),
        F.when(archived, F.lit(True)).otherwise(F.lit(False)).alias("archived"),
        to_local(leads.discarded_at, tz).alias("archived_at"), "archive_reason")
    return labelled(out, LABELS)

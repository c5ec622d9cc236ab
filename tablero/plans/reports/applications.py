"""R4 applications: one row per (application, agency), with the agency's
latest promotion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ
from tablero.functions import (as_of_date, flag_int, full_name, join_parts, label_map, not_in, to_local,
                               year_boundaries)
from tablero.operators import any_one_per_key, latest_per_key, role_pivot
from tablero.plans.reports._common import alias_cols, as_of_value, lookups, measured, sort_then_label

# Output labels, in report order.
LABELS = [
    ("application_id", "Id de Aplicacion"),
    ("home_id", "Id del Inmueble"),
    ("created_at", "Fecha Creacion Aplicacion"),
    ("step", "Paso de Aplicacion"),
    ("product", "Producto"),
    ("tenant_name", "Nombre del Inquilino"),
    ("tenant_email", "Email del Inquilino"),
    ("tenant_mobile_phone", "Telefono Inquilino"),
    ("age", "Edad"),
    ("marital_status", "Estado Civil"),
    ("income_amount", "Ingresos"),
    ("date_of_birth", "Fecha de Nacimiento"),
    ("occupation", "Ocupacion"),
    ("company_name", "Empresa donde Labora"),
    ("seniority_years", "Tiempo en la Empresa"),
    ("gender", "Genero"),
    ("address", "Direccion"),
    ("status", "Status de Aplicacion"),
    ("homie_score", "Homie Score"),
    ("documented_at", "Fecha Entrega de Documentos"),
    ("completed_at", "Fecha de Aplicacion Completada"),
    ("resolved_at", "Fecha Respuesta Aplicacion"),
    ("approved_applications", "Aplicaciones Aprobadas"),
    ("paid_applications", "Aplicaciones Pagadas"),
    ("paid_at", "Fecha Pago Aplicacion"),
    ("roomies", "Roomies"),
    ("person_type", "Tipo de Persona"),
    ("fico", "Fico"),
    ("promocode", "Promocode"),
    ("percentage_discount", "Porcentaje Descuento"),
    ("is_candidate_no_deposit", "Candidato a No deposito"),
    ("homie_risk", "Tipo de Riesgo"),
]

# Gender labels, the fallback label, excluded funnel steps and
# the two logged steps reported as dates.
GENDER_LABELS = {"male": "Hombre", "female": "Mujer"}
GENDER_UNKNOWN = "Sin Registro"
EXCLUDED_STEPS = ["previous_landlord", "resume"]
STEP_DOCUMENTS = "documents"
STEP_COMPLETE = "complete"


def _one_per(df: DataFrame, key: str, order, columns) -> DataFrame:
    """Deterministic single child row per key (the source keeps an arbitrary
    one of the joined combinations after its per-application ROW_NUMBER).
    Among rows equal in ``order`` a row with values goes before one without."""
    known = [x for c in columns for x in (F.col(c).isNotNull(), F.col(c))]
    return latest_per_key(df, key, order, tie_break=known, columns=columns)


def _lookup_row(df: DataFrame, key: str) -> DataFrame:
    """One row per key of a lookup table: a repeated key must not repeat the application."""
    return any_one_per_key(df.filter(F.col(key).isNotNull()), key)


def build(tables: Mapping[str, DataFrame], as_of=None, tz: str = DEFAULT_TZ, ordered: bool = True,
          hot_rows: int | None = None) -> DataFrame:
    """``hot_rows``: a home, user, agency or scheme that more applications have
    is dealt over several tasks in its join (see ``measured``)."""
    today = as_of_date(as_of_value(as_of))
    apps = tables["mongo_home_applications"].filter(not_in("_step", EXCLUDED_STEPS))
    # the source numbers the rows of each (application, agency) and keeps one, so a repeated pair is one row
    apps = any_one_per_key(apps, ["_id", "agency_id"])
    # The source joins every rent of the home, every income, payment, report and
    # every promotion of the agency, then keeps one row per (application,
    # agency) ordered by promotion date. Each child is reduced to one row per
    # key first: the same rows result without materialising the products.
    promos = latest_per_key(tables["mongo_promotion_codes"], "agency_id", ["created_at"],
                            tie_break=["_id"], columns=["code", "percentage"]) \
        .select(F.col("agency_id").alias("pr_agency"), F.col("code").alias("promocode"),
                F.col("percentage").alias("percentage_discount"))
    rents = _one_per(tables["mongo_rents"], "home_id", ["created_at"], ["product", "_id"]) \
        .select(F.col("home_id").alias("r_home"), "product")
    incomes = _one_per(tables["mongo_home_applications_home_application_income"], "mongo_home_applications_id", [],
                       ["verified_income", "position", "working_company", "seniority_years", "number_of_homies"])
    payments = _one_per(tables["mongo_payments"].withColumn("has_paid", F.col("paid_at").isNotNull()),
                        "paymentable_id", ["has_paid", "paid_at"], ["paid_at"])
    reports = _one_per(tables["mongo_reports"], "home_application_id", ["created_at"], ["homie_score"]) \
        .withColumnRenamed("home_application_id", "rp_app")
    steps = (tables["mongo_home_application_logs"].filter(F.col("step").isin(STEP_DOCUMENTS, STEP_COMPLETE))
             .groupBy("home_application_id", "step").agg(F.max("created_at").alias("step_date")))
    steps = role_pivot(steps, "home_application_id", "step",
                       {"documents": STEP_DOCUMENTS, "complete": STEP_COMPLETE}, ["step_date"]) \
        .withColumnRenamed("home_application_id", "st_app")
    users = _lookup_row(alias_cols(tables["mongo_users"], "u_",
                       ["_id", "name", "last_name", "second_last_name", "email", "mobile_phone", "date_of_birth",
                        "marital_status", "_gender"]), "u__id")
    homes = _lookup_row(alias_cols(tables["mongo_homes"], "h_", ["_id", "address_from_location", "street", "number",
                                                     "neighborhood"]), "h__id")
    schemes = _lookup_row(alias_cols(tables["mongo_guarantee_deposit_schemes"], "gd_", ["_id", "name"]), "gd__id")

    j = (apps.join(payments, payments.paymentable_id == apps._id, "left")
             .join(reports, F.col("rp_app") == apps._id, "left")
             .join(steps, F.col("st_app") == apps._id, "left"))
    hot = measured(tables["mongo_home_applications"], {"r_home": "home_id", "u__id": "user_id", "pr_agency": "agency_id",
                                                       "gd__id": "guarantee_deposit_scheme_id"}, hot_rows)
    j = lookups(j, [apps._id], [
        (apps.id, (incomes, "mongo_home_applications_id")),
        (apps.home_id, (rents, "r_home"), (homes, "h__id")),
        (apps.user_id, (users, "u__id")),
        (apps.agency_id, (promos, "pr_agency")),
        (apps.guarantee_deposit_scheme_id, (schemes, "gd__id")),
    ], hot)
    approved = apps._status == "approved"
    built = join_parts("h_street", "h_number", "h_neighborhood", null_as=" ")
    out = j.select(
        apps._id.alias("application_id"), apps.home_id, to_local(apps.created_at, tz).alias("created_at"),
        apps._step.alias("step"), "product",
        full_name("u_name", "u_last_name", "u_second_last_name", null_as=" ").alias("tenant_name"),
        F.col("u_email").alias("tenant_email"), F.col("u_mobile_phone").alias("tenant_mobile_phone"),
        year_boundaries("u_date_of_birth", today).alias("age"), F.col("u_marital_status").alias("marital_status"),
        F.col("verified_income").alias("income_amount"), F.to_date("u_date_of_birth").alias("date_of_birth"),
        F.col("position").alias("occupation"), F.col("working_company").alias("company_name"), "seniority_years",
        label_map("u__gender", GENDER_LABELS, default=F.lit(GENDER_UNKNOWN)).alias("gender"),
        F.when(F.col("h_address_from_location").isNull(), built).otherwise(F.col("h_address_from_location"))
         .alias("address"),
        apps._status.alias("status"), F.when(approved, F.col("homie_score")).alias("homie_score"),
        to_local("documents_step_date", tz).alias("documented_at"),
        to_local("complete_step_date", tz).alias("completed_at"),
        to_local(apps.resolved_at, tz).alias("resolved_at"),
        flag_int(approved).alias("approved_applications"),
        flag_int(F.col("paid_at").isNotNull()).alias("paid_applications"),
        to_local("paid_at", tz).alias("paid_at"),
        F.coalesce(F.col("number_of_homies"), F.lit(0)).alias("roomies"),
        apps._person_type.alias("person_type"), apps.score.alias("fico"), "promocode", "percentage_discount",
        apps.is_candidate_no_deposit, F.col("gd_name").alias("homie_risk"))
    return sort_then_label(out, LABELS, [F.col("created_at").desc_nulls_first()], ordered)

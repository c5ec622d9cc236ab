"""R5 rents: one row per rent (fan-out of advance months and renewals kept)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ
from tablero.functions import (as_of_date, first_match, full_name, is_true, join_parts, month_boundaries,
                               prefixed, to_local)
from tablero.operators import latest_per_key
from tablero.plans.reports._common import alias_cols, as_of_value, lookups, measured, sort_then_label

# Output labels, in report order.
LABELS = [
    ("rent_id", "Id de Renta"),
    ("tenant_name", "Nombre del Inquilino"),
    ("tenant_email", "Email del Inquilino"),
    ("home_id", "Id del Inmueble"),
    ("application_id", "Id de Aplicacion"),
    ("address", "Direccion"),
    ("owner_name", "Nombre del Propietario"),
    ("is_renewal", "Es Renovacion"),
    ("renewed", "Renovo"),
    ("rent_price", "Precio de Renta"),
    ("rent_status", "Status de Renta"),
    ("advance_canceled_at", "Fecha de Cancelacion del Apartado"),
    ("advance_at", "Fecha de Apartado"),
    ("started_at", "Fecha de Inicio"),
    ("ends_at", "Fecha de Finalizacion"),
    ("finished_early_at", "Fecha de Terminacion Anticipada"),
    ("cancel_reason", "Razon de cancelacion"),
    ("months_elapsed", "Meses Transcurridos"),
    ("payment_day", "Dia de Pago"),
    ("deposit_days", "Dias De Deposito en Garantia"),
    ("deposit_months", "Meses de Deposito en Garantia"),
    ("deposit_amount", "Monto de Deposito en Garantia"),
    ("risk_guarantee", "Poliza Juridica"),
    ("risk_type", "Tipo de Riesgo"),
    ("homie_risk", "Riesgo Homie"),
    ("homie_first_fee", "Comision Primer Mes Homie"),
    ("homie_monthly_fee", "Comision Mensual Homie"),
    ("agency", "Asesor/Agencia"),
    ("agency_first_fee", "Comision Primer Mes Asesor/Agencia"),
    ("product", "Producto"),
]

# Fixed value: risk share assumed for a no-deposit rent without a report.
NO_DEPOSIT_RISK = "0.3333"
DAYS_PER_DEPOSIT_MONTH = 30


def address(h: str | None = "h_") -> F.Column:
    """Structured address (8 parts, floor/apartment prefixed) when there is
    no geocoded one; ``None``: that of a home that is not there."""
    c = lambda n: F.lit(None).cast("string") if h is None else F.col(h + n)
    built = join_parts(c("street"), c("number"), prefixed("Piso ", c("apartment_floor")),
                       prefixed("Depa ", c("apartment_number")), c("neighborhood"), c("city"), c("state"),
                       c("country"), null_as=" ")
    return F.when(c("address_from_location").isNull(), built).otherwise(c("address_from_location"))


def last_report_per_application(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Latest risk report of each existing application (equal times broken by
    the risk value)."""
    apps = tables["mongo_home_applications"].select(F.col("_id").alias("app_key"))
    reports = tables["mongo_reports"]
    j = apps.join(reports, reports.home_application_id == F.col("app_key"), "inner")
    return latest_per_key(j, "home_application_id", ["created_at"],
                          tie_break=["risk_deposit_percentage_no_deposit"],
                          columns=["risk_deposit_percentage_no_deposit"]) \
        .withColumnRenamed("home_application_id", "la_application_id")


def build(tables: Mapping[str, DataFrame], as_of=None, tz: str = DEFAULT_TZ, ordered: bool = True,
          hot_rows: int | None = None) -> DataFrame:
    """``hot_rows``: a home, user, scheme or fee that more rents have is dealt
    over several tasks in its join (see ``measured``)."""
    today = as_of_date(as_of_value(as_of))
    rents = tables["mongo_rents"]
    contracts = alias_cols(tables["mongo_rent_contracts"], "c_", ["rent_id", "signed_at", "started_at", "ends_at"])
    schemes = alias_cols(tables["mongo_guarantee_deposit_schemes"], "gd_", ["_id", "name", "days"])
    company = alias_cols(tables["mongo_rent_third_party_company_fees"], "cf_",
                         ["_id", "fee_third_party_company_id", "company_first_fee"])
    partners = alias_cols(tables["mongo_agency_business_partners"], "bp_", ["_id", "name"])
    homes = alias_cols(tables["mongo_homes"], "h_",
                       ["_id", "owner_id", "address_from_location", "street", "number", "apartment_floor",
                        "apartment_number", "neighborhood", "city", "state", "country", "payment_day",
                        "product_type"])
    users = alias_cols(tables["mongo_users"], "u_", ["_id", "name", "last_name", "second_last_name", "email"])
    advisors = alias_cols(tables["mongo_home_advisors"], "ha_", ["user_id", "home_advisor_fee_id"])
    advisor_fees = alias_cols(tables["mongo_rent_home_advisor_fees"], "af_", ["_id", "advisor_first_fee"])
    owners = alias_cols(tables["mongo_owners"], "o_", ["_id", "user_id"])
    owner_users = alias_cols(tables["mongo_users"], "ou_", ["_id", "name", "last_name", "second_last_name"])
    advance = alias_cols(tables["mongo_rental_months"].filter((F.col("_charge_type") == "advance")
                                                              & (F.col("_status") == "paid")),
                         "rm_", ["rent_id", "created_at"]).withColumn("advance_paid", F.lit(True))
    children = alias_cols(tables["mongo_rents"], "ch_", ["parent_rent_id"])
    last_apps = last_report_per_application(tables)

    # Each dimension gets what hangs on it, and its texts, at its own grain, so
    # that the rents are shuffled once for each of their keys and carry no
    # column that only another lookup or a text needs.
    home_side = lookups(homes, ["h__id"], [("h_owner_id", (owners, "o__id")), ("o_user_id", (owner_users, "ou__id"))]).select(
        "h__id", "h_payment_day", "h_product_type", address().alias("h_address"),
        full_name("ou_name", "ou_last_name", "ou_second_last_name", null_as=" ").alias("h_owner_name"))
    # the advisor is found through the tenant user, as the source does
    user_side = lookups(users, ["u__id"], [("u__id", (advisors, "ha_user_id")), ("ha_home_advisor_fee_id", (advisor_fees, "af__id"))]).select(
        "u__id", "u_email", full_name("u_name", "u_last_name", "u_second_last_name", null_as=" ").alias("u_full_name"), "af_advisor_first_fee")
    company_side = lookups(company, ["cf__id"], [("cf_fee_third_party_company_id", (partners, "bp__id"))]).select(
        "cf__id", "cf_company_first_fee", "bp_name")
    # renewals hang on the contract, so that they join on one key with the rest of the rent id
    signed = contracts.join(children, F.col("c_rent_id") == F.col("ch_parent_rent_id"), "left").select(
        "c_rent_id", "c_started_at", "c_ends_at", (F.col("ch_parent_rent_id").isNotNull() & F.col("c_signed_at").isNotNull()).alias("c_renewed"))
    rents = rents.select("_id", "home_id", "user_id", "home_application_id", "guarantee_deposit_scheme_id", "rent_third_party_company_fee_id",
                         "rent_price", "_status", "canceled_at", "reason_for_cancelation", "is_no_deposit", "deposit_months_warranty",
                         "deposit_amount", "risk_guarantee", "homie_first_fee", "homie_monthly_fee", "created_at",
                         F.col("parent_rent_id").isNotNull().alias("has_parent"), F.col("rent_third_party_company_fee_id").isNotNull().alias("third_party"))
    # the fee id is NULL for most rents, and any of these ids may be missing
    hot = measured(rents, {"h__id": "home_id", "u__id": "user_id", "gd__id": "guarantee_deposit_scheme_id",
                           "cf__id": "rent_third_party_company_fee_id"}, hot_rows)
    # Rents without a fee stay where they are. Then the narrowest side comes first, the homes last.
    fee = F.col("rent_third_party_company_fee_id")
    none = rents.filter(fee.isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in company_side.schema])
    j = lookups(rents.filter(fee.isNotNull()), ["_id"], [(fee, (company_side, "cf__id"))], hot).unionByName(none).drop("rent_third_party_company_fee_id", "cf__id")
    j = lookups(j, ["_id"], [
        ("guarantee_deposit_scheme_id", (schemes, "gd__id")),
        ("home_application_id", (last_apps, "la_application_id")),
        ("user_id", (user_side, "u__id")),
        ("_id", (signed, "c_rent_id"), (advance, "rm_rent_id")),
        ("home_id", (home_side, "h__id")),
    ], hot)
    no_name = full_name(*[F.lit(None).cast("string")] * 3, null_as=" ")

    st = F.col("_status")
    risk = F.col("risk_deposit_percentage_no_deposit")
    out = j.select(
        F.col("_id").alias("rent_id"),
        F.coalesce("u_full_name", no_name).alias("tenant_name"),
        F.col("u_email").alias("tenant_email"), F.col("h__id").alias("home_id"),
        F.col("la_application_id").alias("application_id"), F.coalesce("h_address", address(None)).alias("address"),
        F.coalesce("h_owner_name", no_name).alias("owner_name"),
        F.when(F.col("has_parent"), F.lit(True)).alias("is_renewal"),
        F.when(F.col("c_renewed"), F.lit(True)).alias("renewed"), "rent_price", st.alias("rent_status"),
        F.when(F.col("advance_paid") & (st == "canceled"), to_local("canceled_at", tz)).alias("advance_canceled_at"),
        to_local("rm_created_at", tz).alias("advance_at"),
        F.col("c_started_at").alias("started_at"), F.col("c_ends_at").alias("ends_at"),
        F.when(st == "finished_early", to_local("canceled_at", tz)).alias("finished_early_at"),
        F.col("reason_for_cancelation").alias("cancel_reason"),
        first_match((st == "started", month_boundaries("c_started_at", today)),
                    (st.isin("finished_early", "canceled"), month_boundaries("c_started_at", "canceled_at")),
                    (st == "finished", month_boundaries("c_started_at", "c_ends_at"))).alias("months_elapsed"),
        F.col("h_payment_day").alias("payment_day"),
        F.when(is_true("is_no_deposit"), F.col("gd_days"))
         .otherwise(F.col("deposit_months_warranty") * DAYS_PER_DEPOSIT_MONTH).alias("deposit_days"),
        F.col("deposit_months_warranty").alias("deposit_months"), "deposit_amount", "risk_guarantee",
        F.col("gd_name").alias("risk_type"),
        first_match((risk.isNotNull(), risk),
                    (is_true("is_no_deposit"), F.lit(NO_DEPOSIT_RISK).cast("decimal(18,4)"))).alias("homie_risk"),
        "homie_first_fee", "homie_monthly_fee",
        F.when(F.col("third_party"), F.col("bp_name")).otherwise(F.lit("No")).alias("agency"),
        F.when(~F.col("third_party"), F.col("af_advisor_first_fee")).otherwise(F.col("cf_company_first_fee"))
         .alias("agency_first_fee"),
        F.col("h_product_type").alias("product"), F.col("created_at").alias("_sort"))
    return sort_then_label(out, LABELS, [F.col("_sort").desc_nulls_first()], ordered)

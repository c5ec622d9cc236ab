"""R2 payments: rental month x applied payment for paid/refunded months."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ
from tablero.functions import full_name, is_false, is_true, label_map, month_boundaries, month_label, to_local
from tablero.operators import sibling_sums, slot_product
from tablero.plans.reports._common import alias_cols, sort_then_label, staged
from tablero.sources.staging import Staging

# Output labels, in report order.
LABELS = [
    ("rental_month_id", "Id Renta Mensual"),
    ("rent_id", "Id de Renta"),
    ("tenant_name", "Nombre del Inquilino"),
    ("tenant_email", "Email del Inquilino"),
    ("owner_email", "Email del Propietario"),
    ("payment_date", "Fecha de Pago"),
    ("due_date", "Fecha de Vencimiento"),
    ("month_paid", "Mes/Año Pagado"),
    ("charge_label", "Tipo de Cargo"),
    ("product", "Producto"),
    ("month_status", "Status Renta Mensual"),
    ("rent_price", "Precio de Renta"),
    ("advance_amount", "Monto de Apartado"),
    ("risk_guarantee", "Poliza Juridica"),
    ("is_no_deposit", "Es No deposito"),
    ("deposit_months", "Meses en Deposito en Garantia"),
    ("is_deferred_deposit", "Es deposito Diferido"),
    ("deferred_deposit", "Deposito en Garantia"),
    ("homie_fee", "Comision Homie (Sin IVA)"),
    ("received", "Pago Recibido"),
    ("remaining_amount", "Cantidad Faltante"),
    ("payment_method", "Metodo de Pago"),
    ("payment_status_label", "Status de Pago"),
    ("payment_code", "Codigo de Pago"),
    ("card_type", "Tipo de Tarjeta"),
    ("card_brand", "Marca de Tarjeta"),
    ("interests", "Intereses generados"),
    ("method_fee", "Comision por Metodo de Pago"),
    ("provider", "Proveedor"),
    ("store", "Tienda/Banco/Spei"),
    ("reference", "Referencia"),
    ("apply_dispersion", "Aplica Dispersion"),
    ("owner_srpago", "Cantidad Propietario Sr Pago"),
    ("advisor_srpago", "Cantidad Asesor Sr Pago"),
    ("homie_srpago", "Cantidad Homie Sr Pago"),
    ("srpago", "Cantidad Sr Pago"),
    ("owner_dispersion", "Dispersion Propietario"),
    ("owner_dispersion_email", "Email Dispersion Propietario"),
    ("owner_dispersion_status", "Status Dispersion Propietario"),
    ("advisor_dispersion", "Dispersion Asesor"),
    ("advisor_dispersion_email", "Email Dispersion Asesor"),
    ("advisor_dispersion_status", "Status Dispersion Asesor"),
    ("other_dispersion", "Otra Dispersion"),
    ("other_dispersion_email", "Email Otra Dispersion"),
    ("other_dispersion_status", "Status Otra Dispersion"),
]

# Label maps and state lists of the report.
CHARGE_LABELS = {"first_payment": "Primer Pago", "rent_pay": "Renta Mensual", "advance": "Apartado"}
MONTH_STATUS_LABELS = {"paid": "Pagado", "refunded": "Reembolso"}
PAYMENT_STATUS_LABELS = {"applied": "Aplicado", "refunded": "Reembolsado"}
REPORTED_MONTH_STATES = ["paid", "refunded"]
NOT_AVAILABLE = "No disponible"

_DISPERSION_CHILDREN = {
    "owner": ("mongo_payment_reference_requests_dispersion_data_owner", "amount_in_sr_pago"),
    "advisor": ("mongo_payment_reference_requests_dispersion_data_advisor", "amount_in_sr_pago"),
    "homie": ("mongo_payment_reference_requests_dispersion_data_homie", "amount_in_sr_pago"),
    "srpago": ("mongo_payment_reference_requests_dispersion_data_sr_pago", "amount"),
}


TOTALS = [f"{n}_total" for n in _DISPERSION_CHILDREN]


def applied_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The references applied to a rental month, read once: each with its own
    columns and its own four dispersion sums.

    The source sums after joining the four child tables of each dispersion
    record side by side; ``sibling_sums`` gives that result from one grouping
    of the children."""
    key = "mongo_payment_reference_requests_dispersion_data_id"
    children = {name: tables[tbl].select(key, F.col(amount).alias("amount")).filter(F.col(key).isNotNull())
                for name, (tbl, amount) in _DISPERSION_CHILDREN.items()}
    data = tables["mongo_payment_reference_requests_dispersion_data"].select(
        F.col("id").alias(key), F.col("mongo_payment_reference_requests_id").alias("ref_id")).filter(F.col("ref_id").isNotNull())
    # dealt by the reference as they are: most have one record
    per_ref = (data.join(sibling_sums(children, key, "amount"), key, "left").select("ref_id", *TOTALS).repartition("ref_id")
                   .groupBy("ref_id").agg(*[F.sum(t).alias(t) for t in TOTALS]))
    refs = tables["mongo_payment_reference_requests"].filter(is_true("applied_to_rental_month") & F.col("rental_month_id").isNotNull())
    refs = alias_cols(refs, "pr_", ["id", "rental_month_id", "apply_dispersion", "store_name", "reference_description", "_provider"])
    return refs.join(per_ref, F.col("pr_id") == F.col("ref_id"), "left").drop("pr_id", "ref_id")


def srpago_totals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per rental month, the four dispersion sums of applied references. The
    source joins the months before it sums: a month that is there twice counts
    twice."""
    months = tables["mongo_rental_months"].groupBy(F.col("_id").alias("sp_month")).agg(F.count(F.lit(1)).alias("sp_rows"))
    per = applied_references(tables).groupBy("pr_rental_month_id").agg(*[F.sum(t).alias(t) for t in TOTALS])
    return per.join(months, F.col("pr_rental_month_id") == F.col("sp_month")).select(
        "sp_month", *[(F.col(t) * F.col("sp_rows")).alias(t) for t in TOTALS])


def reported_months(tables: Mapping[str, DataFrame], columns: list[str]) -> DataFrame:
    """The months of the report, each with how many rows of any status have its
    id (``sp_rows``). The others are only counted, so they travel without columns."""
    reported = F.coalesce(F.col("_status").isin(REPORTED_MONTH_STATES), F.lit(False))
    months = tables["mongo_rental_months"].filter(reported | F.col("_id").isNotNull())
    months = months.select("_id", reported.alias("sp_reported"), *[F.when(reported, F.col(c)).alias(c) for c in columns])
    return months.withColumn("sp_rows", F.count(F.lit(1)).over(Window.partitionBy("_id"))).filter("sp_reported").drop("sp_reported")


def build(tables: Mapping[str, DataFrame], as_of=None, tz: str = DEFAULT_TZ, ordered: bool = True,
          staging: Staging | None = None) -> DataFrame:
    """With ``staging`` the references, the months with what hangs on them and the
    report's rows are written there in turn (``staged``)."""
    months = reported_months(tables, ["rent_id", "month", "year", "_charge_type", "_status", "amount", "remaining_amount", "homie_fee", "due_date"])
    rents = alias_cols(tables["mongo_rents"], "r_",
                       ["_id", "user_id", "home_id", "product", "rent_price", "risk_guarantee", "is_no_deposit",
                        "deposit_months_warranty", "allow_monthly_owner_deposit_payment", "start_date",
                        "months_to_pay_deposit", "deposit_amount"])
    users = alias_cols(tables["mongo_users"], "u_", ["_id", "name", "last_name", "second_last_name", "email"])
    homes = alias_cols(tables["mongo_homes"], "h_", ["_id", "owner_id"])
    owners = alias_cols(tables["mongo_owners"], "o_", ["_id", "user_id"])
    owner_users = alias_cols(tables["mongo_users"], "ou_", ["_id", "email"])
    refs = staged(staging, applied_references(tables), "references")
    refs = refs.withColumns({t: F.sum(t).over(Window.partitionBy("pr_rental_month_id")) for t in TOTALS})
    pays = tables["mongo_rental_payments"].filter(F.col("_status") == "applied")
    pays = pays.select(F.col("rental_month_id").alias("rp_month"), to_local("paid_at", tz).alias("payment_date"),
                       "payment_method", label_map("_status", PAYMENT_STATUS_LABELS).alias("payment_status_label"), "payment_code", "card_type",
                       "card_brand", F.col("extra_fee").alias("rp_extra_fee"), F.col("amount").alias("rp_amount"))
    # the three role slots from one read: a month with several rows of a role has every combination, as in the source
    applies = F.col("_applies_to")
    slots = slot_product(tables["mongo_rental_month_dispersions"], "rental_month_id", {
        "ad": applies == "advisor", "od": applies == "owner", "xd": ~applies.isin("advisor", "owner")},
        ["amount", "email", "_status"]).withColumnRenamed("rental_month_id", "ds_month")
    interests = (tables["mongo_interest_historics"].groupBy(F.col("rental_month_id").alias("ih_month"))
                 .agg(F.sum("interests").alias("interests_amount")))

    # The rent's side is built once per rent, what hangs on a home once per home;
    # the months gather what hangs on their own key first and then meet it: two
    # shuffles of the months.
    home_side = (homes.join(owners, F.col("o__id") == F.col("h_owner_id"), "left")
                      .join(owner_users, F.col("ou__id") == F.col("o_user_id"), "left").select("h__id", "ou_email"))
    user_side = users.select("u__id", "u_email", full_name("u_name", "u_last_name", "u_second_last_name", null_as=" ").alias("tenant_name"))
    nobody = full_name(*[F.lit(None).cast("string")] * 3, null_as=" ")
    rent_side = (rents.join(user_side, F.col("u__id") == F.col("r_user_id"), "left")
                      .withColumn("tenant_name", F.coalesce("tenant_name", nobody))
                      .join(home_side, F.col("h__id") == F.col("r_home_id"), "left"))
    month_side = (months.join(refs, F.col("pr_rental_month_id") == F.col("_id"), "left")
                        .join(pays, F.col("rp_month") == F.col("_id"), "left")
                        .join(slots, F.col("ds_month") == F.col("_id"), "left")
                        .join(interests, F.col("ih_month") == F.col("_id"), "left")
                        # the source joins the months before it sums: a month that is there twice counts twice
                        .withColumns({t: F.col(t) * F.col("sp_rows") for t in TOTALS})
                        .drop("pr_rental_month_id", "rp_month", "ds_month", "ih_month", "sp_rows"))
    months = staged(staging, month_side, "months", ["references"])
    j = months.join(rent_side, F.col("r__id") == months.rent_id, "inner")

    charge = months._charge_type
    first = charge == "first_payment"
    deferred = is_true("r_allow_monthly_owner_deposit_payment") & (
        (month_boundaries("r_start_date", months.due_date) < F.col("r_months_to_pay_deposit")) | first)
    out = j.select(
        months._id.alias("rental_month_id"), F.col("r__id").alias("rent_id"),
        "tenant_name", F.col("u_email").alias("tenant_email"), F.col("ou_email").alias("owner_email"), "payment_date",
        months.due_date, month_label(months.month, months.year).alias("month_paid"),
        label_map(charge, CHARGE_LABELS).alias("charge_label"), F.col("r_product").alias("product"),
        label_map(months._status, MONTH_STATUS_LABELS).alias("month_status"),
        F.col("r_rent_price").alias("rent_price"),
        F.when(charge == "advance", months.amount).alias("advance_amount"),
        F.when(first, F.col("r_risk_guarantee")).alias("risk_guarantee"),
        # can only be FALSE or NULL, as written in the source
        F.when(first & (is_false("r_is_no_deposit") | F.col("r_is_no_deposit").isNull()), F.lit(False))
         .alias("is_no_deposit"),
        F.when(first, F.col("r_deposit_months_warranty")).alias("deposit_months"),
        F.when(deferred, F.lit(True)).otherwise(F.lit(False)).alias("is_deferred_deposit"),
        # a zero instalment count gives NULL here; the warehouse would fail
        F.when(deferred, F.round(F.try_divide(F.col("r_deposit_amount"), F.col("r_months_to_pay_deposit")), 2))
         .alias("deferred_deposit"),
        months.homie_fee, (F.col("rp_amount") + F.col("rp_extra_fee")).alias("received"), months.remaining_amount,
        "payment_method", "payment_status_label",
        "payment_code", F.coalesce("card_type", F.lit(NOT_AVAILABLE)).alias("card_type"),
        F.coalesce("card_brand", F.lit(NOT_AVAILABLE)).alias("card_brand"),
        F.coalesce("interests_amount", F.lit(0)).alias("interests"), F.col("rp_extra_fee").alias("method_fee"),
        F.col("pr__provider").alias("provider"), F.col("pr_store_name").alias("store"),
        F.col("pr_reference_description").alias("reference"), F.col("pr_apply_dispersion").alias("apply_dispersion"),
        F.round("owner_total", 2).alias("owner_srpago"), F.round("advisor_total", 2).alias("advisor_srpago"),
        F.round("homie_total", 2).alias("homie_srpago"), F.round("srpago_total", 2).alias("srpago"),
        F.round("od_amount", 2).alias("owner_dispersion"), F.col("od_email").alias("owner_dispersion_email"),
        F.col("od__status").alias("owner_dispersion_status"),
        F.round("ad_amount", 2).alias("advisor_dispersion"), F.col("ad_email").alias("advisor_dispersion_email"),
        F.col("ad__status").alias("advisor_dispersion_status"),
        F.round("xd_amount", 2).alias("other_dispersion"), F.col("xd_email").alias("other_dispersion_email"),
        F.col("xd__status").alias("other_dispersion_status"))
    return sort_then_label(out, LABELS, [F.col("payment_date").desc_nulls_first()], ordered, staging, ["months"])

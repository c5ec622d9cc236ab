"""R3 active rents: rent x rental month from 2018 on, with deposits across
the renewal chain and interest paid."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ
from tablero.functions import (first_match, flag_int, has_bit, initcap_words, join_parts, not_in,
                               parse_month, to_local, yes_no)
from tablero.operators import rollup_ancestors, sum_by
from tablero.operators._cols import order_key
from tablero.plans.reports._common import alias_cols, lookups, sort_then_label, staged
from tablero.sources.staging import Staging

# Output labels, in report order.
LABELS = [
    ("rent_id", "id de renta"),
    ("user_id", "id de usuario"),
    ("rental_month_id", "id mes de renta"),
    ("home_id", "id de inmueble"),
    ("furnished", "amueblado"),
    ("charge_type", "tipo de cargo"),
    ("tenant_first_name", "nombre del inquilino"),
    ("tenant_last_name", "apellido del inquilino"),
    ("tenant_email", "email del inquilino"),
    ("owner_first_name", "nombre del propietario"),
    ("owner_last_name", "apellido del propietario"),
    ("owner_email", "email del propietario"),
    ("month_date", "mes"),
    ("rent_price", "precio de renta"),
    ("paid_at", "fecha de pago"),
    ("fee_rate", "Porcentaje Comisión"),
    ("is_renewal", "Renovación?"),
    ("started_on", "Fecha de Inicio"),
    ("ends_on", "Fecha de Finalizacion"),
    ("online_contract", "contrato online"),
    ("interest_paid", "interes pagado"),
    ("product", "producto"),
    ("due_date", "fecha de vencimiento"),
    ("zip", "codigo postal"),
    ("deposit", "DeGa"),
    ("deposit_estimate", "DeGa Estimado"),
]

# Fixed values used by the report's rules.
CLOSED_RENT_STATES = ["canceled", "finished_early", "negotiation"]
PENDING_MONTH_STATES = ["pending", "partial_paid"]
FEE_CONFIG_NO_FEE = "homie_only_receive_fee"
EXEMPT_SCHEME = "A"
EXEMPT_FROM = "2021-02-01"
FIRST_MONTH = "2018-01-01"
FURNISHED_BIT = 5
STANDARD_FEES = [0.05, 0.25, 0.09]


def interests(tables: Mapping[str, DataFrame], month_key: str = "id", paid_only: bool = False) -> DataFrame:
    """Pending interest (latest record) and interest paid (sum of |negative|
    records) per rental month still pending. ``month_key`` is the
    rental-month column the history is matched on (the source uses the
    surrogate ``id`` here and the business ``_id`` elsewhere). ``paid_only``
    leaves out the records above zero, and the months that have no other."""
    hist = tables["mongo_interest_historics"]
    i = F.col("interests")
    if paid_only:
        hist = hist.filter((i <= 0) | i.isNull())
    paid = F.when(i.isNull(), F.lit(0).cast("decimal(18,2)")).when(i <= 0, F.abs(i))
    pending_months = (tables["mongo_rental_months"].filter(F.col("_status").isin(PENDING_MONTH_STATES))
                      .select(F.col(month_key).alias("pm_key")))
    open_hist = hist.join(pending_months, hist.rental_month_id == F.col("pm_key"), "left_semi")
    # all records of a pending month are here: both figures come from one grouping
    return open_hist.groupBy("rental_month_id").agg(
        F.max_by("interests", order_key(["created_at", "interests"])).alias("interest_pending"), F.sum(paid).alias("interest_paid"))


def historic_deposits(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Deposit of a rent plus those of its parent and grandparent rent,
    rounded to units; one row per rent that has rental months."""
    by_rent = sum_by(tables["mongo_rental_months"], "rent_id", {"deposit": "deposit_amount"})
    rolled = rollup_ancestors(by_rent, "rent_id", "deposit", tables["mongo_rents"], "_id", "parent_rent_id", depth=2)
    return rolled.select(F.col("rent_id").alias("hd_rent"), F.round("deposit").alias("deposit"))


def build(tables: Mapping[str, DataFrame], as_of=None, tz: str = DEFAULT_TZ, ordered: bool = True,
          interest_month_key: str = "id", staging: Staging | None = None) -> DataFrame:
    """With ``staging`` the months with what hangs on them and the report's rows
    are written there in turn (``staged``)."""
    rents = tables["mongo_rents"]
    months = tables["mongo_rental_months"]
    month_date = parse_month("month", "year")
    months = months.filter((F.col("_status") != "canceled") & (F.col("_charge_type") != "advance")
                           & (month_date >= F.lit(FIRST_MONTH).cast("date")))
    months = alias_cols(months, "rm_", ["id", "_id", "rent_id", "month", "year", "_charge_type", "_status",
                                        "homie_fee", "due_date"])
    homes = alias_cols(tables["mongo_homes"], "h_", ["_id", "owner_id", "furnished", "zip", "price"])
    users = alias_cols(tables["mongo_users"], "u_", ["_id", "name", "last_name", "second_last_name", "email"])
    owners = alias_cols(tables["mongo_owners"], "o_", ["_id", "user_id"])
    owner_users = alias_cols(tables["mongo_users"], "ou_", ["_id", "name", "last_name", "second_last_name", "email"])
    features = alias_cols(tables["mongo_home_features"], "hf_", ["home_id", "extras"])
    # dealt by the month only, as the join needs them: one shuffle for both
    payments = (tables["mongo_rental_payments"].select("rental_month_id", "user_id", "paid_at").filter(F.col("rental_month_id").isNotNull())
                .repartition("rental_month_id").groupBy("rental_month_id", "user_id")
                .agg(F.max("paid_at").alias("last_payment_at"))
                .select(F.col("rental_month_id").alias("lp_month"), "last_payment_at"))
    interest = interests(tables, interest_month_key, paid_only=True).select("rental_month_id", "interest_paid").withColumnRenamed("rental_month_id", "in_month")
    fee_cfg = tables["mongo_rental_months_payment_method_fee"].select(
        "mongo_rental_months_id", (F.col("_config_type") == FEE_CONFIG_NO_FEE).alias("pmf_no_fee"))
    deposits = historic_deposits(tables)
    contracts = alias_cols(tables["mongo_rent_contracts"], "c_", ["rent_id", "signed_at", "started_at", "ends_at"])
    apps = alias_cols(tables["mongo_home_applications"], "a_", ["_id", "guarantee_deposit_scheme_id", "created_at"])
    schemes = alias_cols(tables["mongo_guarantee_deposit_schemes"], "gd_", ["_id", "name"])

    # What hangs on a home, a user or an application is put together there, with
    # its texts (all NULL where the join finds nothing), and the rents are
    # shuffled once for each of their keys, the rent id last.
    bit = has_bit("hf_extras", FURNISHED_BIT)
    home_side = (homes.join(features, F.col("h__id") == F.col("hf_home_id"), "left")
                      .join(owners, F.col("h_owner_id") == F.col("o__id"), "left")
                      .join(owner_users, F.col("o_user_id") == F.col("ou__id"), "left")
                      .select("h__id", F.when(bit.isNull(), F.col("h_furnished")).otherwise(bit).alias("h_furnished"), "h_zip", "h_price",
                              initcap_words("ou_name").alias("h_owner_first_name"),
                              initcap_words(join_parts("ou_last_name", "ou_second_last_name")).alias("h_owner_last_name"),
                              F.col("ou_email").alias("h_owner_email")))
    user_side = users.select("u__id", "u_email", initcap_words("u_name").alias("u_first_name"),
                             initcap_words(join_parts("u_last_name", "u_second_last_name")).alias("u_last_names"))
    exempt = ((F.col("gd_name") == EXEMPT_SCHEME)
              & (to_local("a_created_at", tz) >= F.lit(EXEMPT_FROM).cast("timestamp_ntz")))
    app_side = apps.join(schemes, F.col("a_guarantee_deposit_scheme_id") == F.col("gd__id"), "left").select("a__id", exempt.alias("a_exempt"))
    own = rents.select("_id", "user_id", "home_id", "home_application_id", "rent_price", "product", F.col("parent_rent_id").isNotNull().alias("is_renewal"),
                       not_in(rents._status, CLOSED_RENT_STATES).alias("not_closed")).filter(F.col("_id").isNotNull())
    rent_side = lookups(own, ["_id"], [("home_application_id", (app_side, "a__id")), ("user_id", (user_side, "u__id")), ("home_id", (home_side, "h__id"))])
    rent_side = (rent_side.join(deposits, F.col("_id") == F.col("hd_rent"), "left")
                          .join(contracts, F.col("_id") == F.col("c_rent_id"), "left"))
    # The month filters reject NULL-padded rows: the month join is inner. What
    # hangs on the month is joined at month grain, the surrogate id first as no
    # later step needs it, and the two sides meet once on the rent id.
    month_side = (months.join(fee_cfg, F.col("mongo_rental_months_id") == F.col("rm_id"), "left").drop("rm_id", "mongo_rental_months_id")
                        .join(payments, F.col("rm__id") == F.col("lp_month"), "left")
                        .join(interest, F.col("rm__id") == F.col("in_month"), "left").drop("lp_month", "in_month"))
    month_side = staged(staging, month_side, "months")
    j = (month_side.join(rent_side, F.col("_id") == F.col("rm_rent_id"), "inner")
                   .filter(F.col("not_closed") | (F.col("rm__status") != "pending")))

    fee = F.col("rm_homie_fee")
    fee_rate = first_match((fee.isNotNull() & F.col("pmf_no_fee"), F.lit(0)),
                           (fee.isNull(), F.lit(0)), default=fee)
    rounded_fee = F.round(fee, 2)
    fee_bucket = (F.when(~rounded_fee.isin(STANDARD_FEES), F.lit("otros"))
                  .otherwise(F.to_char(rounded_fee, F.lit("0D99"))))
    out = j.select(
        F.col("_id").alias("rent_id"), "user_id", F.col("rm__id").alias("rental_month_id"), "home_id",
        F.col("h_furnished").alias("furnished"), F.col("rm__charge_type").alias("charge_type"),
        F.col("u_first_name").alias("tenant_first_name"), F.col("u_last_names").alias("tenant_last_name"),
        F.col("u_email").alias("tenant_email"),
        F.col("h_owner_first_name").alias("owner_first_name"), F.col("h_owner_last_name").alias("owner_last_name"),
        F.col("h_owner_email").alias("owner_email"),
        parse_month("rm_month", "rm_year").alias("month_date"), "rent_price",
        to_local("last_payment_at", tz).alias("paid_at"), fee_rate.alias("fee_rate"),
        yes_no(F.col("is_renewal")).alias("is_renewal"),
        F.to_date("c_started_at").alias("started_on"), F.to_date("c_ends_at").alias("ends_on"),
        flag_int(F.col("c_signed_at").isNotNull()).alias("online_contract"), "interest_paid", "product",
        F.col("rm_due_date").alias("due_date"), F.col("h_zip").alias("zip"), "deposit",
        F.when(F.col("a_exempt"), F.lit(0.0)).otherwise(F.greatest("deposit", "rent_price").cast("double"))
         .alias("deposit_estimate"),
        F.col("rm_year").alias("_y"), F.col("rm_month").alias("_m"), fee_bucket.alias("_fee"),
        F.col("h_price").alias("_price"))
    order = [F.col(c).asc_nulls_last() for c in ("_y", "_m", "charge_type", "_fee", "_price")]
    return sort_then_label(out, LABELS, order, ordered, staging, ["months"])

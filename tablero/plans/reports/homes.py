"""R1 homes: one row per home with its publication history, tenant, owner,
advisors, bookings, prices and features.

Re-design of the source's fifteen CTEs for Spark:

* The log is read once, as tagged rows (its entries, and the prices that they
  replaced). One window pass over them (split by day, ``with_last_match``)
  gives the previous status, the previous price and the last publication
  before each publication; one aggregation (``transition_summary``) then
  makes every pick: first/last publication, first/last pending approval,
  latest take-down, reactivation, latest price change.
* The advisor slots are picked per owner and joined to the homes once.
* The meeting counter's no-op join is not written (its date condition sits
  in the ON clause of a LEFT JOIN whose columns are unused).
* The location CTE's MIN/MAX labels are kept as in this report (MIN is the
  longitude).
* The second time-zone conversion of the pending-approval dates (values
  already local converted again) is reproduced; ``fix_double_tz=True``
  converts once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablero import DEFAULT_TZ
from tablero.functions import (as_of_date, as_of_lit, day_boundaries, first_match, full_name, has_bit, label_map,
                               join_parts, month_start, not_in, parse_month, split_part, to_local, yes_no)
from tablero.operators import (boundary_gap_months, count_when, entered, latest_per_key, moved, role_pivot, transition_summary,
                               with_last_match)
from tablero.plans.reports._common import alias_cols, as_of_value, labelled, lookups, measured, time_bucket

# Output labels, in report order (spelling as published).
LABELS = [
    ("home_id", "ID Inmueble"),
    ("apartment_type", "Tipo de inmueble"),
    ("product_type", "Producto"),
    ("short_url", "Link"),
    ("is_showed_by_homie", "Mostrado por Homie"),
    ("virtual_tour_link", "Tour Virtual"),
    ("door_keys_code", "Codigo de Llaves"),
    ("status_label", "Status"),
    ("first_pending_at", "Fecha Primer Pendiente Por Aprobar"),
    ("last_pending_at", "Fecha Ultimo Pendiente Por Aprobar"),
    ("owner_registered_at", "Registro del Propietario"),
    ("owner_changed", "Cambio Propietario?"),
    ("owner_user_id", "Id de Propietario"),
    ("owner_name", "Nombre del propietario"),
    ("owner_email", "Email del Propietario"),
    ("owner_phone", "Telefono del Propietario"),
    ("tenant_name", "Nombre del Inquilino"),
    ("tenant_email", "Email del Inquilino"),
    ("tenant_phone", "Telefono del Inquilino"),
    ("advisor_name", "Nombre del Asesor Inmobiliario"),
    ("advisor_email", "Email del Asesor Inmobiliario"),
    ("advisor_phone", "Telefono Asesor Inmobiliario"),
    ("address", "Direccion"),
    ("created_at", "Fecha de Creacion del Inmueble"),
    ("first_published_at", "Fecha de primer publicación"),
    ("last_published_at", "Fecha de última publicacion"),
    ("takedown_type", "Tipo de Baja"),
    ("taken_down_at", "Fecha de Baja"),
    ("takedown_reason", "Razon de Baja"),
    ("takedown_comment", "Comentarios de Baja"),
    ("booked_at", "Fecha del Apartado"),
    ("booked_amount", "Monto del Apartado"),
    ("days_online", "Días en Línea"),
    ("next_publication", "Prox. Publicacion"),
    ("days_to_next_publication", "Días Faltante Prox. Publicacion"),
    ("development", "Desarrollo Inmobiliario"),
    ("sells_advisor", "Asesor Adquisiciones"),
    ("customer_success_advisor", "Asesor Customer Success"),
    ("meetings_total", "Citas Totales"),
    ("meetings_confirmed", "Citas Confirmadas"),
    ("meetings_canceled", "Citas Canceladas"),
    ("visits", "Visitas"),
    ("reactivated", "Reactivado"),
    ("first_agent_email", "Email agente 1er aprobacion"),
    ("last_agent_email", "Email agente Última aprobación"),
    ("campaign", "Campaña"),
    ("previous_price", "Precio anterior"),
    ("total_price", "Precio Total"),
    ("maintenance", "Mantenimiento"),
    ("price_changed_at", "Fecha de Cambio Precio"),
    ("recommended_price", "Precio Recomendado"),
    ("step", "Paso"),
    ("exclusive", "Inmueble exclusivo?"),
    ("bedrooms", "Recamaras"),
    ("bathrooms", "Baños"),
    ("parkings", "Estacionanmientos"),
    ("area", "Area de Cobertura"),
    ("antique", "Antigüedad"),
    ("furnished", "Amueblado"),
    ("pets", "Acepta Mascotas"),
    ("video_tour", "Videorecorrido"),
    ("photo_session", "Sesion Fotografica"),
    ("neighborhood", "Colonia"),
    ("city", "Ciudad"),
    ("state", "Estado"),
    ("zip", "Codigo Postal"),
    ("billable", "Factura?"),
    ("longitude", "Longitud"),
    ("latitude", "Latitud"),
]

# States, separators and thresholds the report tests for.
PUBLISHED = "published"
PENDING = "pending_approval"
TAKEDOWN_STATES = ["canceled", "unpublished", "temporarily_canceled"]
GONE_STATES = ["rented", "reserved", "master"]
STATUS_LABELS = {"rented": "Baja", "reserved": "Baja", "master": "Baja", "in_progress": "En progreso",
                 "published": "Publicado", "temporarily_canceled_by_posposal": "Baja por citas",
                 "unpublished_by_meetings": "Baja por citas", "rejected": "Rechazado",
                 "temporarily_canceled": "Baja temporal", "unpublished": "Baja temporal",
                 "canceled": "Baja temporal", "pending_approval": "Pendiente por aprobar"}
CLOSED_RENT_STATES = ["canceled", "finished_early", "negotiation"]
ADVISOR_ROLES = {"sells": "sells", "customer_success": "customer_success"}
REASON_SEPARATOR = ". Razón: "
COMMENT_SEPARATOR = ": "
PRICE_HISTORY_FROM = "2020-09-01"
REACTIVATION_MIN_GAP = 2
FURNISHED_BIT = 5
PETS_BIT = 0
VIDEO_PREFIX = "https://"


def home_log(tables: Mapping[str, DataFrame], now: dt.datetime, tz: str) -> DataFrame:
    """The log as tagged rows, read once: every entry as a ``status`` row at its
    creation, and one ``price`` row at its update for each previous price that
    it holds and that the price window takes."""
    logs = tables["mongo_home_logs"].filter(F.col("home_id").isNotNull())
    values = tables["mongo_home_logs_previous_values"].select("id", F.col("mongo_home_logs_id").alias("pv_log"))
    prices = tables["mongo_home_logs_previous_values_price"].filter(F.col("value").isNotNull())
    # the nested prices of one log entry
    prices = (prices.join(values.filter(F.col("pv_log").isNotNull()), prices.mongo_home_logs_previous_values_id == values.id, "inner")
                    .groupBy("pv_log").agg(F.collect_list("value").alias("prices")))
    changed = to_local("updated_at", tz)
    taken = (changed >= F.lit(PRICE_HISTORY_FROM).cast("timestamp_ntz")) & (changed <= as_of_lit(now))
    kind = lambda k: F.lit(k).alias("kind")
    entry = F.struct(kind("status"), F.col("created_at").alias("at"), F.lit(None).cast("decimal(18,2)").alias("price"))
    priced = F.transform("prices", lambda v: F.struct(kind("price"), F.col("updated_at").alias("at"), v.alias("price")))
    rows = F.when(taken & F.col("prices").isNotNull(), F.concat(F.array(entry), priced)).otherwise(F.array(entry))
    rows = logs.join(prices, F.col("pv_log") == F.col("id"), "left").select(
        "home_id", "id", "status", "changed_by_id", "reason", F.inline(rows))
    status = F.col("kind") == "status"
    return rows.select("home_id", "id", "kind", "at", "price", *[F.when(status, F.col(c)).alias(c) for c in ("status", "changed_by_id", "reason")],
                       to_local("at", tz).alias("local_at"))


def log_picks(tables: Mapping[str, DataFrame], now: dt.datetime, tz: str, bucket_unit: str = "day") -> DataFrame:
    """Everything that the report takes from the log, one row per home, from one
    scan of the log, one window pass and one aggregation.

    The LAGs go by the stored UTC time, the log id breaking ties. That of the
    publications does so too: it differs from their order in local time only
    inside the hour that a zone's clock repeats."""
    rows = home_log(tables, now, tz)
    into = lambda states, **how: (lambda s, p: (F.col("kind") == "status") & entered(s, p, states, **how))
    h = with_last_match(rows, ["home_id", "kind"], ["at"], "status", into([PUBLISHED]), ["local_at"], previous=["price"],
                        tie_break=["id", "price"], bucket=time_bucket("at", bucket_unit), name="publishes", match_prefix="published_before_")
    pub = F.col("publishes")
    again = pub & (boundary_gap_months("published_before_local_at", "local_at") >= REACTIVATION_MIN_GAP)
    status = F.col("kind") == "status"
    picks = transition_summary(h, "home_id", ["local_at"], tie_break=["id"], specs={
        "first_pub": (pub, "first", ["local_at", "changed_by_id"]),
        "last_pub": (pub, "last", ["local_at", "changed_by_id"]),
        "first_pending": (status & moved("status", "previous_status", ["in_progress"], [PENDING]), "first", ["local_at"]),
        "last_pending": (status & moved("status", "previous_status", ["in_progress", "rented"], [PENDING]), "last",
                         ["local_at"]),
        "down": (into(TAKEDOWN_STATES, first_row_counts=False)(F.col("status"), F.col("previous_status")), "last",
                 ["local_at", "reason"]),
        "price": (F.col("kind") == "price", "last", ["previous_price", "local_at"], ["at", "id", "price"]),
    }, extra={"reactivated_at": F.max(F.when(again, F.col("local_at")))})
    return picks.select(F.col("home_id").alias("fl_home"),
                        F.col("first_pub_local_at").alias("first_published_at"),
                        F.col("first_pub_changed_by_id").alias("first_changed_by_id"),
                        F.col("last_pub_local_at").alias("last_published_at"),
                        F.col("last_pub_changed_by_id").alias("last_changed_by_id"),
                        F.col("first_pending_local_at").alias("fp_at"), F.col("last_pending_local_at").alias("lp_at"),
                        F.col("down_local_at").alias("taken_down_at"), F.col("down_reason").alias("dn_reason"),
                        F.col("price_previous_price").alias("previous_price"), F.col("price_local_at").alias("price_changed_at"),
                        "reactivated_at")


def build(tables: Mapping[str, DataFrame], as_of=None, tz: str = DEFAULT_TZ, ordered: bool = True,
          fix_double_tz: bool = False, bucket_unit: str = "day", hot_rows: int | None = None) -> DataFrame:
    """``bucket_unit``: time unit the log windows are split by (see
    ``with_last_match``); finer for entities with very many changes a day.
    ``hot_rows``: an owner or advisor of more homes is dealt over several tasks
    in its join (see ``measured``)."""
    now = as_of_value(as_of)
    now_ts, today = as_of_lit(now), as_of_date(now)
    homes = tables["mongo_homes"]
    picks = log_picks(tables, now, tz, bucket_unit)

    # Latest paid advance per home.
    months = tables["mongo_rental_months"]
    rents = tables["mongo_rents"]
    adv = months.filter((F.col("_charge_type") == "advance") & (F.col("_status") == "paid"))
    adv = adv.join(rents.select(F.col("_id").alias("ar_id"), F.col("home_id").alias("bk_home")),
                   adv.rent_id == F.col("ar_id"), "left")
    booked = latest_per_key(adv.select("bk_home", "created_at", "amount", "_id"), "bk_home", ["created_at"],
                            tie_break=["_id"], columns=["created_at", "amount"]) \
        .select("bk_home", to_local("created_at", tz).alias("booked_at"), F.col("amount").alias("booked_amount"))

    # Advisor slots: one e-mail per (owner, role), largest e-mail first.
    owners = tables["mongo_owners"]
    users = tables["mongo_users"]
    heroes = tables["mongo_users_super_heroes"].filter(F.col("_super_hero_type").isin(list(ADVISOR_ROLES.values())))
    owner_heroes = (owners.select(F.col("_id").alias("sh_owner"), F.col("user_id").alias("sh_user"))
                    .join(users.select(F.col("_id").alias("sh_uid"), F.col("id").alias("sh_usurrogate")),
                          F.col("sh_user") == F.col("sh_uid"), "inner")
                    .join(heroes, F.col("sh_usurrogate") == heroes.mongo_users_id, "inner"))
    picked = owner_heroes.groupBy("sh_owner", "_super_hero_type").agg(F.max("email").alias("email"))
    slots = role_pivot(picked, "sh_owner", "_super_hero_type", ADVISOR_ROLES, ["email"])

    # Tenant renting this month (signed contract), latest rent first.
    rent_cols = rents.select(F.col("_id").alias("tr_rent"), F.col("home_id").alias("tr_home"),
                             F.col("_status").alias("tr_status"), F.col("created_at").alias("tr_created"),
                             F.col("user_id").alias("tr_user"))
    current = (months.filter(F.col("month").isNotNull() & (F.col("_charge_type") != "advance")
                             & (F.col("_status") != "canceled")
                             & (parse_month("month", "year") == month_start(today)))
                     .join(rent_cols, months.rent_id == F.col("tr_rent"), "left")
                     .filter(not_in("tr_status", CLOSED_RENT_STATES) | (months._status != "pending")))
    signed = (tables["mongo_rent_contracts"].filter(F.col("signed_at").isNotNull())
              .select(F.col("rent_id").alias("sc_rent")))
    current = current.join(signed, F.col("sc_rent") == F.col("tr_rent"), "inner")
    tenant_users = alias_cols(users, "tu_", ["_id", "name", "last_name", "second_last_name", "email",
                                             "mobile_phone"])
    current = current.join(tenant_users, F.col("tr_user") == F.col("tu__id"), "left")
    rented = latest_per_key(
        current.select("tr_home", "tr_created", "tr_rent", months._id.alias("tr_month"),
                       full_name("tu_name", "tu_last_name", "tu_second_last_name", null_as="").alias("tenant_name"),
                       F.col("tu_email").alias("tenant_email"), F.col("tu_mobile_phone").alias("tenant_phone")),
        "tr_home", ["tr_created"], tie_break=["tr_rent", "tr_month"],
        columns=["tr_created", "tenant_name", "tenant_email", "tenant_phone"]) \
        .select("tr_home", to_local("tr_created", tz).alias("rented_at"), "tenant_name", "tenant_email",
                "tenant_phone")

    step = F.col("_step")
    meetings = count_when(tables["mongo_home_home_meetings"], "home_id",
                          {"meetings_total": step.isin("confirmed", "canceled"),
                           "meetings_confirmed": step == "confirmed", "meetings_canceled": step == "canceled"},
                          total=None, else_zero=False).withColumnRenamed("home_id", "mt_home")
    locations = (tables["mongo_homes_location"].groupBy(F.col("mongo_homes_id").alias("loc_home"))
                 .agg(F.min("value").alias("longitude"), F.max("value").alias("latitude")))
    recommended = tables["mongo_homes_recommended_price"].select(F.col("mongo_homes_id").alias("rp_home"),
                                                                 "recommended_price")
    features = tables["mongo_home_features"].select(F.col("home_id").alias("hf_home"), "extras", "rules")
    first_agent = alias_cols(users, "fa_", ["_id", "email"])
    last_agent = alias_cols(users, "la_", ["_id", "email"])
    owner_rows = alias_cols(owners, "ow_", ["_id", "user_id", "created_at"])
    owner_users = alias_cols(users, "ou_", ["_id", "name", "last_name", "second_last_name", "email", "mobile_phone"])
    advisors = alias_cols(tables["mongo_home_advisors"], "ad_", ["_id", "user_id"])
    advisor_users = alias_cols(users, "au_", ["_id", "name", "last_name", "second_last_name", "email",
                                              "mobile_phone"])

    # Joins grouped by key: the per-home frames first (one shuffle of the
    # homes side serves every sort-merge join on the home id), then the
    # surrogate-id frames, then the owner, agent and advisor lookups. The
    # booking time condition is a residual, so the home id stays the only
    # equi-join key.
    last_pub = F.col("last_published_at")
    j = (homes.join(rented, homes._id == F.col("tr_home"), "left")
              .join(picks, homes._id == F.col("fl_home"), "left")
              .join(meetings, F.col("mt_home") == homes._id, "left")
              .join(booked, (homes._id == F.col("bk_home")) & (F.col("booked_at") >= last_pub), "left")
              .join(features, homes._id == F.col("hf_home"), "left")
              .join(recommended, F.col("rp_home") == homes.id, "left")
              .join(locations, homes.id == F.col("loc_home"), "left"))
    hot = measured(homes, {"ow__id": "owner_id", "ad__id": "advisor_id"}, hot_rows)
    j = lookups(j, [homes._id], [
        (homes.owner_id, (owner_rows, "ow__id"), (slots, "sh_owner")),
        ("ow_user_id", (owner_users, "ou__id")),
        ("first_changed_by_id", (first_agent, "fa__id")),
        ("last_changed_by_id", (last_agent, "la__id")),
        (homes.advisor_id, (advisors, "ad__id")),
        ("ad_user_id", (advisor_users, "au__id")),
    ], hot)

    st = homes._status
    is_rented = F.col("tr_home").isNotNull()
    free = F.col("tr_home").isNull()
    last_pub = F.col("last_published_at")
    status_label = F.when(is_rented, F.lit("Rentado")).otherwise(label_map(st, STATUS_LABELS))
    rented_at, down_at = F.col("rented_at"), F.col("taken_down_at")
    gone, off, online = (free & st.isin(GONE_STATES), free & st.isin(TAKEDOWN_STATES), free & (st == PUBLISHED))
    since = F.when(gone, down_at).otherwise(last_pub)
    until = F.when(is_rented, rented_at).when(online, now_ts).when(off, down_at).when(gone, last_pub)
    never_online = free & (st == "rejected") & last_pub.isNull()
    days_online = first_match((never_online, F.lit(None).cast("bigint")),
                              ((is_rented & (rented_at > last_pub)) | gone | off | online, day_boundaries(since, until)),
                              default=F.lit(0))
    again = to_local(homes.available_again_from, tz)
    pending_tz = (lambda c: F.col(c)) if fix_double_tz else (lambda c: to_local(c, tz))
    reason_body = split_part("dn_reason", REASON_SEPARATOR, 2)
    youtube = homes.youtube_link
    out = j.select(
        homes._id.alias("home_id"), homes._apartment_type.alias("apartment_type"), homes.product_type,
        homes.short_url, homes.is_showed_by_homie, homes.virtual_tour_link, homes.door_keys_code,
        status_label.alias("status_label"),
        pending_tz("fp_at").alias("first_pending_at"), pending_tz("lp_at").alias("last_pending_at"),
        to_local("ow_created_at", tz).alias("owner_registered_at"),
        yes_no(to_local("ow_created_at", tz) > F.col("first_published_at")).alias("owner_changed"),
        F.col("ou__id").alias("owner_user_id"),
        full_name("ou_name", "ou_last_name", "ou_second_last_name", null_as="").alias("owner_name"),
        F.col("ou_email").alias("owner_email"), F.col("ou_mobile_phone").alias("owner_phone"),
        "tenant_name", "tenant_email", "tenant_phone",
        full_name("au_name", "au_last_name", "au_second_last_name", null_as="").alias("advisor_name"),
        F.col("au_email").alias("advisor_email"), F.col("au_mobile_phone").alias("advisor_phone"),
        F.when(homes.address_from_location.isNull(),
               join_parts(homes.street, homes.number, homes.neighborhood, homes.state, homes.country, null_as=" "))
         .otherwise(homes.address_from_location).alias("address"),
        homes.created_at, "first_published_at", "last_published_at",
        first_match((st == "unpublished", F.lit("Baja temporal (Homie)")),
                    (st.isin("canceled", "temporarily_canceled"), F.lit("Baja temporal (Propietario)")))
        .alias("takedown_type"),
        "taken_down_at", split_part(reason_body, COMMENT_SEPARATOR, 1).alias("takedown_reason"),
        split_part(reason_body, COMMENT_SEPARATOR, 2).alias("takedown_comment"),
        "booked_at", "booked_amount", days_online.alias("days_online"),
        F.when(again >= last_pub, again).alias("next_publication"),
        F.when(again >= now_ts, day_boundaries(today, again)).alias("days_to_next_publication"),
        homes.real_state_development_name.alias("development"),
        F.col("sells_email").alias("sells_advisor"), F.col("customer_success_email").alias("customer_success_advisor"),
        F.coalesce("meetings_total", F.lit(0)).alias("meetings_total"),
        F.coalesce("meetings_confirmed", F.lit(0)).alias("meetings_confirmed"),
        F.coalesce("meetings_canceled", F.lit(0)).alias("meetings_canceled"),
        homes.visits, yes_no(F.col("reactivated_at") == last_pub).alias("reactivated"),
        F.col("fa_email").alias("first_agent_email"), F.col("la_email").alias("last_agent_email"), homes.campaign,
        "previous_price",
        (F.coalesce(homes.price, F.lit(0)) + F.coalesce(homes.extra_services_amount, F.lit(0))).alias("total_price"),
        F.coalesce(homes.extra_services_amount, F.lit(0)).alias("maintenance"), "price_changed_at",
        F.coalesce("recommended_price", F.lit(0)).alias("recommended_price"), homes._step.alias("step"),
        yes_no(homes.is_homie_exclusive.isNotNull() & (homes.is_homie_exclusive == F.lit(True))).alias("exclusive"),
        homes.bedrooms, homes.bathrooms, F.coalesce(homes.parkings, F.lit(0)).alias("parkings"),
        homes.sqare_mts.alias("area"), homes.antique,
        yes_no(has_bit("extras", FURNISHED_BIT)).alias("furnished"), yes_no(has_bit("rules", PETS_BIT)).alias("pets"),
        first_match((youtube.isNull(), F.lit("No")), (youtube.startswith(VIDEO_PREFIX), F.lit("Si")),
                    default=F.lit("No")).alias("video_tour"),
        yes_no(homes.has_external_photoshooting == F.lit(True)).alias("photo_session"),
        homes.neighborhood, homes.city, homes.state, homes.zip,
        yes_no(homes.is_rent_billable == F.lit(True)).alias("billable"), "longitude", "latitude")
    return labelled(out, LABELS)

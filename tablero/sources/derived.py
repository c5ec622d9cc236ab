"""The rental tables derived from the benchmark tables.

The report stand-ins run the real report builders over rental tables that
Spark derives from the benchmark tables (so their work grows with them).
Each rental column is one SQL expression over one benchmark table, written
once and evaluated by Spark (``selectExpr``) here and by DuckDB in the
oracles (``rental_ctes``), so both sides read the same rows.

Order and line dates (1995-2001) are moved 8401 days (23 years) forward so
that they overlap the event log (January 2024) and the report clock.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablero.sources.catalog import Tables, driver_table
from tablero.sources.schemas import SCHEMAS

SHIFT = "INTERVAL 8401 DAY"
ORDER_AT = f"(o_orderdate + {SHIFT})"
SHIP_AT = f"(l_shipdate + {SHIFT})"
# the event log spans a month; as a home's status log it is spread over some 14
LOG_AT = "(ts - INTERVAL 1 DAY * CAST(event_id % 400 AS INT))"
MONTH_KEY = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"
# a month's surrogate id; some months have one value in both keys, which is what
# the interest history of the active rents is matched on
MONTH_ID = f"CASE WHEN l_linenumber > 3 THEN 'M' ELSE 's' END || {MONTH_KEY}"
# Engine-specific spellings: (Spark, DuckDB).
SHIP_MONTH = (f"lower(date_format({SHIP_AT}, 'MMMM'))", f"lower(strftime({SHIP_AT}, '%B'))")
PRIORITY_NO = "CAST(substr(o_orderpriority, 1, 1) AS INT)"

# (benchmark table, filter or None, {rental column: expression}); several
# entries for one rental table are appended (UNION ALL).
SPEC: dict[str, list[tuple[str, str | None, dict]]] = {
    "mongo_users": [("customer", None, {
        "id": "'s' || c_custkey", "_id": "'U' || c_custkey",
        "name": "lower(split_part(c_name, '#', 1)) || ' ' || c_nationkey", "last_name": "lower(c_mktsegment)",
        "second_last_name": "CASE WHEN c_acctbal < 0 THEN NULL ELSE split_part(c_name, '#', 2) END",
        "email": "'u' || c_custkey || '@mail.test'", "mobile_phone": "'55' || c_custkey",
        "phone": "CASE WHEN c_acctbal > 5000 THEN '56' || c_custkey END",
        "_person_type": "CASE WHEN c_acctbal > 8000 THEN 'moral' ELSE 'fisica' END", "degree": "c_mktsegment",
        "marital_status": "CASE WHEN c_nationkey < 12 THEN 'single' ELSE 'married' END",
        "country_of_birth": "'N' || c_nationkey",
        "_gender": "CASE WHEN c_nationkey < 10 THEN 'male' WHEN c_nationkey < 20 THEN 'female' END",
        "campaign": "c_mktsegment", "referred_by_code": "CASE WHEN c_acctbal > 9000 THEN 'REF' || c_custkey END",
        "has_children": "c_acctbal > 3000",
        "date_of_birth": "CASE WHEN c_nationkey < 8 THEN TIMESTAMP '1980-12-31 23:00:00' "
                         "WHEN c_nationkey < 16 THEN TIMESTAMP '1995-01-01 00:00:00' END",
        "created_at": "CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2021-07-01 12:00:00' "
                      "WHEN c_acctbal < 5000 THEN TIMESTAMP '2023-07-01 12:00:00' END",
    })],
    "mongo_users_super_heroes": [("supplier", None, {
        "mongo_users_id": "'s' || CAST(floor(s_suppkey / 2) AS BIGINT)",
        "_super_hero_type": "CASE WHEN s_nationkey < 8 THEN 'sells' WHEN s_nationkey < 16 THEN 'customer_success' "
                            "ELSE 'ops' END",
        "name": "lower(s_name)", "email": "'sh' || s_suppkey || '@mail.test'",
    })],
    "mongo_owners": [("supplier", None, {
        "_id": "'O' || s_suppkey", "user_id": "'U' || s_suppkey",
        "marketing_source": "CASE WHEN s_acctbal > 5000 THEN 'web' ELSE 'referral' END",
        "created_at": "CASE WHEN s_nationkey < 10 THEN TIMESTAMP '2021-07-01 12:00:00' "
                      "WHEN s_nationkey < 20 THEN TIMESTAMP '2023-07-01 12:00:00' END",
    })],
    "mongo_home_advisors": [("supplier", None, {
        "_id": "'A' || s_suppkey", "user_id": "'U' || s_suppkey", "home_advisor_fee_id": "'AF' || s_nationkey",
    })],
    "mongo_homes": [("part", None, {
        "id": "'h' || p_partkey", "_id": "'H' || p_partkey", "owner_id": "'O' || p_size",
        "advisor_id": "'A' || p_size", "_apartment_type": "lower(p_type)", "product_type": "p_brand",
        "short_url": "'https://h.test/' || p_partkey",
        "virtual_tour_link": "CASE WHEN p_size > 30 THEN 'https://t.test/' || p_partkey END",
        "door_keys_code": "'K' || p_size",
        "_status": "CASE WHEN p_size <= 5 THEN 'published' WHEN p_size <= 10 THEN 'in_progress' "
                   "WHEN p_size <= 15 THEN 'rented' WHEN p_size <= 20 THEN 'canceled' "
                   "WHEN p_size <= 25 THEN 'unpublished' WHEN p_size <= 30 THEN 'pending_approval' "
                   "WHEN p_size <= 35 THEN 'rejected' WHEN p_size <= 40 THEN 'temporarily_canceled' "
                   "WHEN p_size <= 45 THEN 'reserved' WHEN p_size <= 48 THEN 'unpublished_by_meetings' "
                   "ELSE 'archived' END",
        "_step": "CASE WHEN p_size > 10 THEN 'done' ELSE 'photos' END",
        "address_from_location": "CASE WHEN p_size > 25 THEN p_name || ', CDMX' END",
        "street": "p_name", "number": "CAST(p_size AS STRING)", "neighborhood": "p_brand", "city": "p_type",
        "state": "CASE WHEN p_size < 40 THEN 'CDMX' END", "country": "'MX'", "zip": "'0' || p_size",
        "apartment_floor": "CASE WHEN p_size < 10 THEN CAST(p_size AS STRING) END",
        "apartment_number": "CASE WHEN p_size > 20 THEN 'D' || p_size END",
        "real_state_development_name": "CASE WHEN p_size > 45 THEN p_brand END", "campaign": "p_type",
        "youtube_link": "CASE WHEN p_size < 15 THEN 'https://yt.test/' || p_partkey "
                        "WHEN p_size < 30 THEN 'http://yt.test/' || p_partkey END",
        "antique": "CASE WHEN p_size > 5 THEN p_size || ' años' END",
        "is_showed_by_homie": "p_size > 10", "is_homie_exclusive": "CASE WHEN p_size < 5 THEN NULL ELSE p_size > 20 END",
        "has_external_photoshooting": "p_size > 15", "is_rent_billable": "p_size < 35", "furnished": "p_size > 25",
        "price": "CAST(p_retailprice AS DECIMAL(18,2))",
        "extra_services_amount": "CASE WHEN p_size > 40 THEN NULL ELSE CAST(p_size AS DECIMAL(18,2)) END",
        "visits": "p_size", "bedrooms": "CAST(floor(p_size / 10) AS INT)",
        "parkings": "CASE WHEN p_size > 45 THEN NULL ELSE CAST(floor(p_size / 20) AS INT) END",
        "payment_day": "p_size", "bathrooms": "CAST(p_size AS DOUBLE) / 20", "sqare_mts": "p_retailprice / 10",
        "created_at": "TIMESTAMP '2023-06-01 00:00:00' - INTERVAL 1 DAY * CAST(p_size AS INT)",
        "available_again_from": "CASE WHEN p_size > 40 THEN TIMESTAMP '2024-03-01 12:00:00' "
                                "WHEN p_size > 30 THEN TIMESTAMP '2024-01-10 00:00:00' END",
    })],
    "mongo_home_features": [("part", None, {
        "home_id": "'H' || p_partkey", "extras": "CASE WHEN p_size > 48 THEN NULL ELSE p_size END",
        "rules": "p_size + 1",
    })],
    "mongo_homes_location": [
        ("part", None, {"mongo_homes_id": "'h' || p_partkey", "value": "p_retailprice / 100"}),
        ("part", None, {"mongo_homes_id": "'h' || p_partkey", "value": "0 - CAST(p_size AS DOUBLE)"}),
    ],
    "mongo_homes_recommended_price": [("part", "p_retailprice > 905", {
        "mongo_homes_id": "'h' || p_partkey", "recommended_price": "CAST(p_retailprice AS DECIMAL(18,2)) + 100",
    })],
    "mongo_home_logs": [("events", None, {
        "id": "'L' || event_id", "home_id": "'H' || user_id",
        "status": "CASE event_type WHEN 'view' THEN 'published' WHEN 'signup' THEN 'in_progress' "
                  "WHEN 'click' THEN 'pending_approval' WHEN 'error' THEN 'canceled' WHEN 'purchase' THEN 'rented' END",
        "changed_by_id": "'U' || CAST(floor(value) AS BIGINT)",
        "reason": "CASE WHEN value < 10 THEN 'sin razon' WHEN value < 30 THEN 'Baja. Razón: motivo ' || event_id "
                  "ELSE 'Baja. Razón: motivo: ' || props END",
        "created_at": LOG_AT, "updated_at": f"{LOG_AT} + INTERVAL 1 HOUR",
    })],
    "mongo_home_logs_previous_values": [("events", "event_type IN ('view', 'click')", {
        "id": "'V' || event_id", "mongo_home_logs_id": "'L' || event_id",
    })],
    "mongo_home_logs_previous_values_price": [("events", "event_type IN ('view', 'click')", {
        "mongo_home_logs_previous_values_id": "'V' || event_id",
        "value": "CASE WHEN value < 5 THEN NULL ELSE CAST(value AS DECIMAL(18,2)) END",
    })],
    "mongo_home_home_meetings": [("lineitem", None, {
        "home_id": "'H' || l_partkey", "user_id": "'U' || l_suppkey",
        "_step": "CASE l_returnflag WHEN 'R' THEN 'confirmed' WHEN 'A' THEN 'canceled' ELSE 'requested' END",
        "created_at": SHIP_AT,
    })],
    "mongo_rents": [("orders", None, {
        "_id": "'R' || o_orderkey", "home_id": "'H' || o_custkey", "user_id": "'U' || o_custkey",
        "parent_rent_id": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderkey > 0 "
                          "THEN 'R' || (o_orderkey - 1) END",
        "home_application_id": "'A' || o_orderkey",
        "_status": "CASE o_orderstatus WHEN 'O' THEN 'started' WHEN 'F' THEN 'finished' ELSE "
                   "CASE o_orderpriority WHEN '1-URGENT' THEN 'canceled' WHEN '2-HIGH' THEN 'finished_early' "
                   "WHEN '3-MEDIUM' THEN 'negotiation' ELSE 'pending' END END",
        "product": "o_orderpriority",
        "reason_for_cancelation": "CASE WHEN o_orderstatus = 'P' THEN 'motivo ' || o_orderpriority END",
        "guarantee_deposit_scheme_id": "'G' || (" + PRIORITY_NO + " - 1)",
        "rent_third_party_company_fee_id": "CASE WHEN o_orderpriority = '5-LOW' THEN 'CF' || o_custkey END",
        "rent_price": "CAST(o_totalprice AS DECIMAL(18,2))",
        "deposit_amount": "CAST(o_totalprice AS DECIMAL(18,2)) * 2",
        "risk_guarantee": "CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END",
        "homie_first_fee": "CASE WHEN o_orderstatus = 'F' THEN CAST(0.5 AS DECIMAL(18,4)) ELSE CAST(0.25 AS DECIMAL(18,4)) END",
        "homie_monthly_fee": "CASE WHEN o_orderstatus = 'O' THEN CAST(0.05 AS DECIMAL(18,4)) "
                             "ELSE CAST(0.09 AS DECIMAL(18,4)) END",
        "deposit_months_warranty": PRIORITY_NO, "months_to_pay_deposit": PRIORITY_NO + " - 1",
        "is_no_deposit": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority = '4-NOT SPECIFIED' END",
        "allow_monthly_owner_deposit_payment": "o_orderstatus != 'F'",
        "created_at": ORDER_AT, "canceled_at": f"{ORDER_AT} + INTERVAL 200 DAY",
        "start_date": f"{ORDER_AT} + INTERVAL 30 DAY",
    })],
    "mongo_rent_contracts": [("orders", None, {
        "_id": "'C' || o_orderkey", "rent_id": "'R' || o_orderkey",
        "_status": "CASE o_orderpriority WHEN '1-URGENT' THEN 'not_renewed' WHEN '2-HIGH' THEN 'renewal_process' "
                   "WHEN '3-MEDIUM' THEN 'canceled' WHEN '4-NOT SPECIFIED' THEN 'pending' ELSE 'active' END",
        "created_at": ORDER_AT,
        "signed_at": f"CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN {ORDER_AT} + INTERVAL 2 DAY END",
        "started_at": f"{ORDER_AT} + INTERVAL 30 DAY", "ends_at": f"{ORDER_AT} + INTERVAL 395 DAY",
    })],
    "mongo_rental_months": [("lineitem", None, {
        "id": MONTH_ID, "_id": f"'M' || {MONTH_KEY}", "rent_id": "'R' || l_orderkey",
        "month": SHIP_MONTH, "year": f"CAST(year({SHIP_AT}) AS STRING)",
        "_charge_type": "CASE WHEN l_linenumber = 1 THEN 'advance' WHEN l_linenumber = 2 THEN 'first_payment' "
                        "ELSE 'rent_pay' END",
        "_status": "CASE l_linestatus || l_returnflag WHEN 'FR' THEN 'paid' WHEN 'FA' THEN 'refunded' "
                   "WHEN 'FN' THEN 'paid' WHEN 'OR' THEN 'pending' WHEN 'OA' THEN 'partial_paid' ELSE 'canceled' END",
        "amount": "CAST(l_extendedprice AS DECIMAL(18,2))",
        "remaining_amount": "CAST(l_tax * 100 AS DECIMAL(18,2))",
        "deposit_amount": "CAST(l_quantity AS DECIMAL(18,2))",
        "homie_fee": "CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_discount AS DECIMAL(18,4)) END",
        "due_date": SHIP_AT, "created_at": f"{SHIP_AT} - INTERVAL 5 DAY",
    })],
    "mongo_rental_months_payment_method_fee": [("lineitem", "l_returnflag = 'A'", {
        "mongo_rental_months_id": MONTH_ID,
        "_config_type": "CASE WHEN l_linenumber > 4 THEN 'homie_only_receive_fee' ELSE 'standard' END",
    })],
    "mongo_rental_payments": [("lineitem", None, {
        "rental_month_id": f"'M' || {MONTH_KEY}", "user_id": "'U' || l_suppkey",
        "payment_method": "CASE WHEN l_discount > 0.05 THEN 'card' ELSE 'transfer' END",
        "_status": "CASE WHEN l_returnflag = 'R' THEN 'refunded' ELSE 'applied' END",
        "payment_code": "'PAY' || l_orderkey",
        "card_type": "CASE WHEN l_discount > 0.05 THEN 'credit' END",
        "card_brand": "CASE WHEN l_discount > 0.08 THEN 'visa' END",
        "amount": "CAST(l_extendedprice AS DECIMAL(18,2))",
        "extra_fee": "CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_tax * 100 AS DECIMAL(18,2)) END",
        "paid_at": f"{SHIP_AT} + INTERVAL 1 DAY",
    })],
    "mongo_rental_month_dispersions": [("lineitem", "l_tax <= 0.05", {
        "rental_month_id": f"'M' || {MONTH_KEY}", "email": "'d' || l_suppkey || '@mail.test'",
        "_status": "CASE WHEN l_linestatus = 'F' THEN 'done' ELSE 'waiting' END",
        "_applies_to": "CASE l_returnflag WHEN 'R' THEN 'owner' WHEN 'A' THEN 'advisor' ELSE 'homie' END",
        "amount": "CAST(l_quantity AS DECIMAL(18,2)) * 3",
    })],
    "mongo_payment_reference_requests": [("lineitem", "l_discount <= 0.07", {
        "id": f"'P' || {MONTH_KEY}", "rental_month_id": f"'M' || {MONTH_KEY}",
        "store_name": "CASE WHEN l_discount > 0.05 THEN 'OXXO' ELSE 'SPEI' END",
        "reference_description": "'REF' || l_orderkey", "_provider": "'srpago'",
        "apply_dispersion": "l_discount > 0.04",
        "applied_to_rental_month": "CASE WHEN l_linestatus = 'F' THEN TRUE WHEN l_returnflag = 'A' THEN NULL "
                                   "ELSE FALSE END",
    })],
    "mongo_payment_reference_requests_dispersion_data": [("lineitem", "l_discount <= 0.07", {
        "id": f"'D' || {MONTH_KEY}", "mongo_payment_reference_requests_id": f"'P' || {MONTH_KEY}",
    })],
    "mongo_payment_reference_requests_dispersion_data_owner": [("lineitem", "l_discount <= 0.07", {
        "mongo_payment_reference_requests_dispersion_data_id": f"'D' || {MONTH_KEY}",
        "amount_in_sr_pago": "CAST(l_extendedprice AS DECIMAL(18,2))",
    })],
    "mongo_payment_reference_requests_dispersion_data_advisor": [
        ("lineitem", "l_discount <= 0.07", {
            "mongo_payment_reference_requests_dispersion_data_id": f"'D' || {MONTH_KEY}",
            "amount_in_sr_pago": "CAST(l_quantity AS DECIMAL(18,2))"}),
        ("lineitem", "l_tax <= 0.03", {
            "mongo_payment_reference_requests_dispersion_data_id": f"'D' || {MONTH_KEY}",
            "amount_in_sr_pago": "CAST(l_tax * 100 AS DECIMAL(18,2))"}),
    ],
    "mongo_payment_reference_requests_dispersion_data_homie": [("lineitem", "l_returnflag != 'N'", {
        "mongo_payment_reference_requests_dispersion_data_id": f"'D' || {MONTH_KEY}",
        "amount_in_sr_pago": "CAST(l_discount * 100 AS DECIMAL(18,2))",
    })],
    "mongo_payment_reference_requests_dispersion_data_sr_pago": [("lineitem", "l_discount <= 0.07", {
        "mongo_payment_reference_requests_dispersion_data_id": f"'D' || {MONTH_KEY}",
        "amount": "CAST(l_quantity AS DECIMAL(18,2)) + 1",
    })],
    "mongo_interest_historics": [("lineitem", None, {
        "rental_month_id": f"'M' || {MONTH_KEY}",
        "interests": "CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(18,2)) - 25 END",
        "created_at": SHIP_AT,
    })],
    "mongo_rent_third_party_company_fees": [("customer", None, {
        "_id": "'CF' || c_custkey", "fee_third_party_company_id": "'BP' || c_nationkey",
        "company_first_fee": "CAST(0.25 AS DECIMAL(18,4))",
    })],
    "mongo_agency_business_partners": [("nation", None, {"_id": "'BP' || n_nationkey", "name": "n_name"})],
    "mongo_rent_home_advisor_fees": [("nation", None, {
        "_id": "'AF' || n_nationkey", "advisor_first_fee": "CAST(n_nationkey AS DECIMAL(18,4)) / 100",
    })],
    "mongo_home_applications": [("orders", None, {
        "id": "'a' || o_orderkey", "_id": "'A' || o_orderkey", "home_id": "'H' || o_custkey",
        "user_id": "'U' || o_custkey",
        "agency_id": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'AG' || " + PRIORITY_NO + " END",
        "_step": "CASE o_orderpriority WHEN '1-URGENT' THEN 'resume' WHEN '2-HIGH' THEN 'previous_landlord' "
                 "WHEN '3-MEDIUM' THEN 'documents' WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'complete' END",
        "_status": "CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'pending' ELSE 'rejected' END",
        "_person_type": "CASE WHEN o_totalprice > 250000 THEN 'moral' ELSE 'fisica' END",
        "guarantee_deposit_scheme_id": "'G' || (" + PRIORITY_NO + " - 1)",
        "score": PRIORITY_NO + " * 100", "is_candidate_no_deposit": "o_totalprice > 300000",
        "created_at": ORDER_AT, "resolved_at": f"{ORDER_AT} + INTERVAL 3 DAY",
    })],
    "mongo_home_application_logs": [("lineitem", None, {
        "home_application_id": "'A' || l_orderkey",
        "step": "CASE l_returnflag WHEN 'R' THEN 'documents' WHEN 'A' THEN 'complete' ELSE 'other' END",
        "created_at": SHIP_AT,
    })],
    "mongo_home_applications_home_application_income": [("orders", "o_orderstatus != 'O'", {
        "mongo_home_applications_id": "'a' || o_orderkey", "position": "'puesto ' || o_orderpriority",
        "working_company": "'empresa ' || o_custkey", "verified_income": "CAST(o_totalprice AS DECIMAL(18,2))",
        "seniority_years": PRIORITY_NO,
        "number_of_homies": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE " + PRIORITY_NO + " END",
    })],
    "mongo_payments": [("orders", "o_orderstatus = 'F'", {
        "paymentable_id": "'A' || o_orderkey", "paid_at": f"{ORDER_AT} + INTERVAL 1 DAY",
    })],
    "mongo_promotion_codes": [("customer", None, {
        "_id": "'PC' || c_custkey", "code": "c_mktsegment || CAST(floor(c_custkey / 3) AS BIGINT)",
        "agency_id": "CASE WHEN c_acctbal < 0 THEN NULL ELSE 'AG' || c_nationkey END",
        "is_used": "CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_acctbal > 5000 END", "used_times": "c_nationkey",
        "percentage": "CAST(c_nationkey AS DECIMAL(18,2))",
        "created_at": "CASE WHEN c_acctbal > 5000 THEN TIMESTAMP '2023-03-01 10:00:00' "
                      "WHEN c_acctbal > 0 THEN TIMESTAMP '2022-03-01 10:00:00' END",
        "due_date": "CASE WHEN c_acctbal > 2000 THEN TIMESTAMP '2024-12-31 12:00:00' END",
    })],
    "mongo_promotion_code_logs": [("orders", "o_orderstatus != 'P'", {
        "promotion_code_id": "'PC' || o_custkey", "home_application_id": "'A' || o_orderkey",
        "used_at": ORDER_AT,
    })],
    "mongo_agencies": [("nation", None, {"_id": "'AG' || n_nationkey", "name": "n_name"})],
    "mongo_guarantee_deposit_schemes": [("region", None, {
        "_id": "'G' || r_regionkey", "name": "CASE WHEN r_regionkey = 1 THEN 'A' ELSE r_name END",
        "days": "r_regionkey * 30",
    })],
    "mongo_reports": [("orders", None, {
        "home_application_id": "'A' || o_orderkey", "homie_score": PRIORITY_NO + " * 10",
        "risk_deposit_percentage_no_deposit": "CASE WHEN o_orderstatus = 'O' THEN CAST(0.2 AS DECIMAL(18,4)) END",
        "created_at": f"{ORDER_AT} + INTERVAL 2 DAY",
    })],
    "mongo_google_gmail_messages": [("events", "event_type IN ('view', 'signup')", {
        "email": "'u' || user_id || '@mail.test'",
        "provider": "CASE event_type WHEN 'view' THEN 'inmuebles24' ELSE 'vivanuncios' END", "created_at": "ts",
    })],
    "postgres_leads": [("orders", None, {
        "id": "o_orderkey", "name": "'lead'", "last_name": "lower(o_orderpriority)",
        "mother_last_name": "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END",
        "phone": "'55' || o_orderkey", "mobile_phone": "CASE WHEN o_orderstatus = 'O' THEN '56' || o_orderkey END",
        "email": "'l' || o_orderkey || '@mail.test'", "status": "o_orderstatus",
        "country_code": "CAST(" + PRIORITY_NO + " AS BIGINT)", "user_id": "o_custkey",
        "created_at": ORDER_AT,
        "discarded_at": f"CASE WHEN o_orderstatus = 'F' THEN {ORDER_AT} + INTERVAL 10 DAY END",
    })],
    "postgres_taggings": [("lineitem", None, {
        "taggable_id": "l_orderkey", "tag_id": "l_partkey",
        "context": "CASE WHEN l_returnflag = 'R' THEN 'lead_cancellations' ELSE 'other' END",
    })],
    "postgres_tags": [("part", None, {"id": "p_partkey", "name": "p_name"})],
    "postgres_users": [("customer", None, {
        "id": "c_custkey", "name": "lower(split_part(c_name, '#', 1)) || ' ' || c_nationkey", "last_name": "lower(c_mktsegment)",
        "mother_last_name": "CASE WHEN c_acctbal < 0 THEN NULL ELSE 'n' || c_nationkey END",
        "email": "'c' || c_custkey || '@mail.test'",
    })],
    "postgres_countries": [("nation", None, {"id": "n_nationkey", "name": "n_name"})],
    "webscraping.postgres_rents": [("part", None, {
        "id": "'W' || p_partkey", "site": "p_brand", "url": "'https://w.test/' || p_partkey",
        "state": "CASE WHEN p_size = 1 THEN NULL WHEN p_size < 30 THEN 'CDMX' ELSE 'Puebla' END",
        "city": "CASE WHEN p_size = 2 THEN NULL ELSE p_type END", "neighborhood": "p_brand",
        "antiquity": "CAST(p_size AS STRING)", "post_age": "'hace ' || p_size || ' dias'",
        "date_in": "TIMESTAMP '2023-01-01 00:00:00' + INTERVAL 1 DAY * CAST(p_partkey % 97 AS INT)", "price": "CAST(p_retailprice AS DECIMAL(18,2))",
        "price_maintenance": "CAST(p_size AS DECIMAL(18,2))", "price_x_mt2": "CAST(p_size AS DECIMAL(18,2)) * 2",
        "covered_area": "p_retailprice / 10", "land_area": "CAST(p_size AS DOUBLE)",
        "latitude": "CASE WHEN p_size = 3 THEN NULL ELSE CAST(p_size - 25 AS DOUBLE) * 4 END",
        "longitude": "(p_retailprice - 1000) / 2", "rooms": "CAST(floor(p_size / 10) AS INT)",
        "bathrooms": "CAST(floor(p_size / 20) AS INT)", "parking": "p_size", "half_bathrooms": "p_size % 2",
    })],
    "webscraping.postgres_rents_response": [("part", "p_size > 4", {
        "postgres_rents_id": "'W' || p_partkey", "title": "p_name", "content": "p_type || ' ' || p_name",
        "pictures": "'https://img.test/' || p_partkey",
    })],
    "webscraping.postgres_rents_extra_features": [("lineitem", None, {
        "postgres_rents_id": "'W' || l_partkey",
        "value": "CASE l_returnflag WHEN 'R' THEN 'alberca' WHEN 'A' THEN 'gimnasio' ELSE NULL END",
    })],
    "webscraping.postgres_rents_i24": [("customer", None, {
        "id": "'I' || c_custkey", "url": "'https://i24.test/' || c_custkey",
        "state": "CASE WHEN c_nationkey = 0 THEN NULL WHEN c_nationkey < 9 THEN 'Colima' ELSE 'Jalisco' END", "city": "c_mktsegment",
        "neighborhood": "'N' || c_nationkey", "antiquity": "CAST(c_nationkey AS STRING)", "post_age": "'hace ' || c_nationkey",
        "date_in": "CASE WHEN c_acctbal > 0 THEN TIMESTAMP '2023-02-01 00:00:00' "
                   "+ INTERVAL 1 DAY * CAST(c_custkey % 50 AS INT) END",
        "price": "CAST(c_acctbal AS DECIMAL(18,2)) + 10000", "price_maintenance": "CAST(c_nationkey AS DECIMAL(18,2)) * 100",
        "price_no_maint": "CAST(c_acctbal AS DECIMAL(18,2))", "covered_area": "c_acctbal / 100",
        "land_area": "CAST(c_nationkey AS DOUBLE)", "latitude": "CAST(c_nationkey * 5 - 20 AS DOUBLE)",
        "longitude": "c_acctbal / 50", "rooms": "c_nationkey", "bathrooms": "c_nationkey % 3 + 1", "parking": "c_nationkey % 2",
        "half_bathrooms": "c_nationkey % 2", "title": "c_name", "description": "'Depto ' || c_mktsegment",
        "query_search": "lower(c_mktsegment)",
    })],
    "webscraping.postgres_rents_i24_extra_features": [("orders", None, {
        "postgres_rents_i24_id": "'I' || o_custkey", "value": "lower(o_orderpriority)",
    })],
}


def _columns(ddl: str) -> list[tuple[str, str]]:
    """Split a DDL column list ``name type, ...`` (types may contain commas)."""
    parts, depth, cur = [], 0, ""
    for ch in ddl:
        if ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        if ch == "," and depth == 0:
            parts.append(cur)
            cur = ""
        else:
            cur += ch
    parts.append(cur)
    out = []
    for p in parts:
        name, typ = p.strip().split(" ", 1)
        out.append((name, typ.strip()))
    return out


def _sql_type(t: str, engine: str) -> str:
    t = t.lower()
    if t == "string":
        return "STRING" if engine == "spark" else "VARCHAR"
    if t == "timestamp_ntz":
        return "TIMESTAMP_NTZ" if engine == "spark" else "TIMESTAMP"
    return t.upper()


def _expr(e, engine: str) -> str:
    if isinstance(e, tuple):
        return e[0] if engine == "spark" else e[1]
    return e


def _select_list(name: str, cols: dict, engine: str) -> list[str]:
    out = []
    for col, typ in _columns(SCHEMAS[name]):
        e = _expr(cols[col], engine) if col in cols else "NULL"
        quoted = f"`{col}`" if engine == "spark" else f'"{col}"'
        out.append(f"CAST({e} AS {_sql_type(typ, engine)}) AS {quoted}")
    return out


def derived_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The 48 rental tables as lazy Spark DataFrames over ``sf_dir``."""
    def resolve(name: str) -> DataFrame:
        out = None
        for src, where, cols in SPEC[name]:
            df = driver_table(spark, sf_dir, src)
            if where:
                df = df.filter(F.expr(where))
            df = df.selectExpr(*_select_list(name, cols, "spark"))
            out = df if out is None else out.unionByName(df)
        return out

    return Tables(resolve, SPEC.keys())


def cte_name(name: str) -> str:
    return name.replace(".", "_")


def rental_ctes(names) -> str:
    """DuckDB CTE definitions (without the WITH) for the given rental tables."""
    blocks = []
    for name in names:
        selects = []
        for src, where, cols in SPEC[name]:
            sel = f"SELECT {', '.join(_select_list(name, cols, 'duckdb'))} FROM {src}"
            if where:
                sel += f" WHERE {where}"
            selects.append(sel)
        blocks.append(f"{cte_name(name)} AS ({' UNION ALL '.join(selects)})")
    return ",\n".join(blocks)


def tables_in(sql: str) -> list[str]:
    """Rental tables referenced by an oracle body (by CTE name)."""
    found = []
    for name in SPEC:
        if re.search(rf"\b{re.escape(cte_name(name))}\b", sql):
            found.append(name)
    return found

"""Explicit schemas of the rental-marketplace tables the reports read.

Types are declared, never inferred: ids are strings, money is
decimal(18,2), rates decimal(18,4), timestamps are timestamp_ntz holding
UTC wall-clock time. Names in the ``webscraping`` namespace are qualified.
"""

from __future__ import annotations

TS = "timestamp_ntz"
MONEY = "decimal(18,2)"
RATE = "decimal(18,4)"

_HOMES = (
    "id string, _id string, owner_id string, advisor_id string, _apartment_type string, "
    "product_type string, short_url string, virtual_tour_link string, door_keys_code string, "
    "_status string, _step string, address_from_location string, street string, number string, "
    "neighborhood string, city string, state string, country string, zip string, "
    "apartment_floor string, apartment_number string, real_state_development_name string, "
    "campaign string, youtube_link string, antique string, is_showed_by_homie boolean, "
    "is_homie_exclusive boolean, has_external_photoshooting boolean, is_rent_billable boolean, "
    f"furnished boolean, price {MONEY}, extra_services_amount {MONEY}, visits int, bedrooms int, "
    f"parkings int, payment_day int, bathrooms double, sqare_mts double, created_at {TS}, "
    f"available_again_from {TS}"
)

_SCRAPED = (
    "id string, site string, url string, state string, city string, neighborhood string, "
    f"antiquity string, post_age string, date_in {TS}, price {MONEY}, price_maintenance {MONEY}, "
    f"price_x_mt2 {MONEY}, covered_area double, land_area double, latitude double, longitude double, "
    "rooms int, bathrooms int, parking int, half_bathrooms int"
)

_SCRAPED_I24 = (
    "id string, url string, state string, city string, neighborhood string, antiquity string, "
    f"post_age string, date_in {TS}, price {MONEY}, price_maintenance {MONEY}, "
    f"price_no_maint {MONEY}, covered_area double, land_area double, latitude double, "
    "longitude double, rooms int, bathrooms int, parking int, half_bathrooms int, title string, "
    "description string, query_search string"
)

SCHEMAS: dict[str, str] = {
    "mongo_users": (
        "id string, _id string, name string, last_name string, second_last_name string, "
        "email string, mobile_phone string, phone string, _person_type string, degree string, "
        "marital_status string, country_of_birth string, _gender string, campaign string, "
        f"referred_by_code string, has_children boolean, date_of_birth {TS}, created_at {TS}"),
    "mongo_users_super_heroes": "mongo_users_id string, _super_hero_type string, name string, email string",
    "mongo_owners": f"_id string, user_id string, marketing_source string, created_at {TS}",
    "mongo_home_advisors": "_id string, user_id string, home_advisor_fee_id string",
    "mongo_homes": _HOMES,
    "mongo_home_features": "home_id string, extras int, rules int",
    "mongo_homes_location": "mongo_homes_id string, value double",
    "mongo_homes_recommended_price": f"mongo_homes_id string, recommended_price {MONEY}",
    "mongo_home_logs": (f"id string, home_id string, status string, changed_by_id string, "
                        f"reason string, created_at {TS}, updated_at {TS}"),
    "mongo_home_logs_previous_values": "id string, mongo_home_logs_id string",
    "mongo_home_logs_previous_values_price": f"mongo_home_logs_previous_values_id string, value {MONEY}",
    "mongo_home_home_meetings": f"home_id string, user_id string, _step string, created_at {TS}",
    "mongo_rents": (
        "_id string, home_id string, user_id string, parent_rent_id string, "
        "home_application_id string, _status string, product string, "
        "reason_for_cancelation string, guarantee_deposit_scheme_id string, "
        f"rent_third_party_company_fee_id string, rent_price {MONEY}, deposit_amount {MONEY}, "
        f"risk_guarantee {MONEY}, homie_first_fee {RATE}, homie_monthly_fee {RATE}, "
        "deposit_months_warranty int, months_to_pay_deposit int, is_no_deposit boolean, "
        f"allow_monthly_owner_deposit_payment boolean, created_at {TS}, canceled_at {TS}, "
        f"start_date {TS}"),
    "mongo_rent_contracts": (f"_id string, rent_id string, _status string, created_at {TS}, "
                             f"signed_at {TS}, started_at {TS}, ends_at {TS}"),
    "mongo_rental_months": (
        "id string, _id string, rent_id string, month string, year string, _charge_type string, "
        f"_status string, amount {MONEY}, remaining_amount {MONEY}, deposit_amount {MONEY}, "
        f"homie_fee {RATE}, due_date {TS}, created_at {TS}"),
    "mongo_rental_months_payment_method_fee": "mongo_rental_months_id string, _config_type string",
    "mongo_rental_payments": (
        "rental_month_id string, user_id string, payment_method string, _status string, "
        f"payment_code string, card_type string, card_brand string, amount {MONEY}, "
        f"extra_fee {MONEY}, paid_at {TS}"),
    "mongo_rental_month_dispersions": (f"rental_month_id string, email string, _status string, "
                                       f"_applies_to string, amount {MONEY}"),
    "mongo_payment_reference_requests": (
        "id string, rental_month_id string, store_name string, reference_description string, "
        "_provider string, apply_dispersion boolean, applied_to_rental_month boolean"),
    "mongo_payment_reference_requests_dispersion_data": "id string, mongo_payment_reference_requests_id string",
    "mongo_payment_reference_requests_dispersion_data_owner":
        f"mongo_payment_reference_requests_dispersion_data_id string, amount_in_sr_pago {MONEY}",
    "mongo_payment_reference_requests_dispersion_data_advisor":
        f"mongo_payment_reference_requests_dispersion_data_id string, amount_in_sr_pago {MONEY}",
    "mongo_payment_reference_requests_dispersion_data_homie":
        f"mongo_payment_reference_requests_dispersion_data_id string, amount_in_sr_pago {MONEY}",
    "mongo_payment_reference_requests_dispersion_data_sr_pago":
        f"mongo_payment_reference_requests_dispersion_data_id string, amount {MONEY}",
    "mongo_interest_historics": f"rental_month_id string, interests {MONEY}, created_at {TS}",
    "mongo_rent_third_party_company_fees": f"_id string, fee_third_party_company_id string, company_first_fee {RATE}",
    "mongo_agency_business_partners": "_id string, name string",
    "mongo_rent_home_advisor_fees": f"_id string, advisor_first_fee {RATE}",
    "mongo_home_applications": (
        "id string, _id string, home_id string, user_id string, agency_id string, _step string, "
        "_status string, _person_type string, guarantee_deposit_scheme_id string, score int, "
        f"is_candidate_no_deposit boolean, created_at {TS}, resolved_at {TS}"),
    "mongo_home_application_logs": f"home_application_id string, step string, created_at {TS}",
    "mongo_home_applications_home_application_income": (
        "mongo_home_applications_id string, position string, working_company string, "
        f"verified_income {MONEY}, seniority_years int, number_of_homies int"),
    "mongo_payments": f"paymentable_id string, paid_at {TS}",
    "mongo_promotion_codes": (f"_id string, code string, agency_id string, is_used boolean, "
                              f"used_times int, percentage {MONEY}, created_at {TS}, due_date {TS}"),
    "mongo_promotion_code_logs": f"promotion_code_id string, home_application_id string, used_at {TS}",
    "mongo_agencies": "_id string, name string",
    "mongo_guarantee_deposit_schemes": "_id string, name string, days int",
    "mongo_reports": (f"home_application_id string, homie_score int, "
                      f"risk_deposit_percentage_no_deposit {RATE}, created_at {TS}"),
    "mongo_google_gmail_messages": f"email string, provider string, created_at {TS}",
    "postgres_leads": (
        "id bigint, name string, last_name string, mother_last_name string, phone string, "
        "mobile_phone string, email string, status string, country_code bigint, user_id bigint, "
        f"created_at {TS}, discarded_at {TS}"),
    "postgres_taggings": "taggable_id bigint, tag_id bigint, context string",
    "postgres_tags": "id bigint, name string",
    "postgres_users": "id bigint, name string, last_name string, mother_last_name string, email string",
    "postgres_countries": "id bigint, name string",
    "webscraping.postgres_rents": _SCRAPED,
    "webscraping.postgres_rents_response": "postgres_rents_id string, title string, content string, pictures string",
    "webscraping.postgres_rents_extra_features": "postgres_rents_id string, value string",
    "webscraping.postgres_rents_i24": _SCRAPED_I24,
    "webscraping.postgres_rents_i24_extra_features": "postgres_rents_i24_id string, value string",
}

import datetime as dt
from decimal import Decimal

import pytest

from fixtures import d, make_tables, ts
from tablero.plans.reports import REPORTS, report
from tablero.plans.reports.payments import srpago_totals

AS_OF = "2023-07-15 12:00:00"


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_every_report_runs_on_empty_tables(spark):
    t = make_tables(spark, {})
    widths = {name: len(report(name, t, AS_OF).columns) for name in REPORTS}
    assert widths == {"homes": 69, "payments": 45, "active_rents": 26, "applications": 32, "rents": 30,
                      "tenants": 15, "webscraping_rents": 24, "contracts": 13, "owners": 11,
                      "webscraping_rents_i24": 23, "leads": 13, "promocodes": 7}


def test_owners(spark):
    t = make_tables(spark, {
        "mongo_users": [dict(_id="U1", id="s1", name="maria", last_name="garcia-lopez"),
                        dict(_id="U2", id="s2", name="juan", last_name="perez", second_last_name="diaz")],
        "mongo_owners": [dict(_id="O1", user_id="U1", created_at=ts("2021-07-01 12:00:00")),
                         dict(_id="O2", user_id="U2", created_at=ts("2023-07-01 12:00:00")),
                         dict(_id="O3", user_id="UX")],
        "mongo_homes": [dict(_id="H1", owner_id="O1", _status="published"),
                        dict(_id="H2", owner_id="O1", _status="in_progress"),
                        dict(_id="H3", owner_id="O2", _status="published")],
        "mongo_users_super_heroes": [dict(mongo_users_id="s1", _super_hero_type="sells", email="z@x"),
                                     dict(mongo_users_id="s1", _super_hero_type="sells", email="b@x"),
                                     dict(mongo_users_id="s1", _super_hero_type="ops", email="o@x")],
    })
    out = rows(report("owners", t, AS_OF))
    assert [r["Id de Propietario"] for r in out] == ["O3", "O2", "O1"]      # DESC, NULL first
    o1, o2, o3 = out[2], out[1], out[0]
    assert o1["Fecha de Registro"] == dt.datetime(2021, 7, 1, 7)
    assert o1["Nombre del Propietario"] == "Maria Garcia-Lopez "
    assert (o1["Inmuebles"], o1["Inmuebles Publicados"], o1["Email Asesor de Adquisiciones"]) == (2, 1, "b@x")
    assert o2["Fecha de Registro"] == dt.datetime(2023, 7, 1, 6)
    assert (o2["Nombre del Propietario"], o2["Inmuebles"]) == ("Juan Perez Diaz", 1)
    assert (o3["Inmuebles"], o3["Inmuebles Publicados"], o3["Nombre del Propietario"]) == (None, None, "  ")


def test_promocodes_shared_code_sequence_and_merge(spark):
    created = ts("2021-07-01 12:00:00")
    t = make_tables(spark, {
        "mongo_promotion_codes": [
            dict(_id="P1", code="A", agency_id="AG1", is_used=True, used_times=3, created_at=created),
            dict(_id="P2", code="B", is_used=None, used_times=5, created_at=ts("2021-08-01 12:00:00")),
            dict(_id="P3", code="A", agency_id="AG1", is_used=True, used_times=3, created_at=created)],
        "mongo_agencies": [dict(_id="AG1", name="Agencia Uno")],
        "mongo_promotion_code_logs": [
            dict(promotion_code_id="P1", home_application_id="X1", used_at=ts("2021-07-02 12:00:00")),
            dict(promotion_code_id="P1", home_application_id="X2", used_at=ts("2021-07-03 12:00:00")),
            dict(promotion_code_id="P3", home_application_id="X3", used_at=ts("2021-07-02 18:00:00"))],
    })
    out = rows(report("promocodes", t, AS_OF))
    assert len(out) == 2
    b, a = out
    assert (b["Codigo"], b["Agencia"], b["Es usado"], b["Cantidad de usos"], b["Usos"]) == ("B", "homie", None, 0, None)
    assert (a["Codigo"], a["Agencia"], a["Cantidad de usos"]) == ("A", "Agencia Uno", 3)
    assert a["Usos"] == ("1.- 2021-07-02 07:00:00, X1 / 2.- 2021-07-02 13:00:00, X3 / "
                         "3.- 2021-07-03 07:00:00, X2")


def test_promocodes_repeated_promotion_and_agency_ids(spark):
    created = ts("2021-07-01 12:00:00")
    promo = dict(_id="P1", code="A", is_used=True, used_times=3, created_at=created)
    t = make_tables(spark, {
        "mongo_promotion_codes": [promo, promo, promo | dict(code="B"), dict(_id="P2", code="C", agency_id="AG1", created_at=created),
                                  dict(code="D", created_at=created)],
        "mongo_agencies": [dict(_id="AG1", name="Agencia Uno")] * 2,
        "mongo_promotion_code_logs": [
            dict(promotion_code_id="P1", home_application_id="X1", used_at=ts("2021-07-02 12:00:00")),
            dict(promotion_code_id="P1", home_application_id="X2", used_at=ts("2021-07-03 12:00:00")),
            dict(promotion_code_id="P2", home_application_id="X3", used_at=ts("2021-07-03 12:00:00"))],
    })
    first, second = "2021-07-02 07:00:00, X1", "2021-07-03 07:00:00, X2"
    assert {r["Codigo"]: r["Usos"] for r in rows(report("promocodes", t, AS_OF))} == {
        "A": f"1.- {first} / 2.- {first} / 3.- {second} / 4.- {second}", "B": f"1.- {first} / 2.- {second}",
        "C": "1.- 2021-07-03 07:00:00, X3 / 2.- 2021-07-03 07:00:00, X3", "D": None}


def test_leads_reasons_only_for_archived(spark):
    t = make_tables(spark, {
        "postgres_leads": [dict(id=1, name="ana", last_name="ruiz", country_code=52, user_id=10,
                                discarded_at=ts("2021-07-01 12:00:00")),
                           dict(id=2, name="luis"), dict(id=3, discarded_at=ts("2021-07-01 12:00:00"))],
        "postgres_taggings": [dict(taggable_id=1, tag_id=100, context="lead_cancellations"),
                              dict(taggable_id=1, tag_id=101, context="lead_cancellations"),
                              dict(taggable_id=1, tag_id=102, context="other"),
                              dict(taggable_id=1, tag_id=999, context="lead_cancellations"),
                              dict(taggable_id=2, tag_id=100, context="lead_cancellations")],
        "postgres_tags": [dict(id=100, name="zeta"), dict(id=101, name="alfa"), dict(id=102, name="otro")],
        "postgres_users": [dict(id=10, name="pedro", last_name="lopez", email="p@x")],
        "postgres_countries": [dict(id=52, name="Mexico")],
    })
    out = {r["Id Lead"]: r for r in rows(report("leads", t, AS_OF))}
    assert out[1]["Razon de Archivo"] == "alfa & zeta"
    assert (out[1]["Lead Archivado"], out[1]["Pais Natal"], out[1]["Representante"]) == (True, "Mexico", "Pedro Lopez ")
    assert out[1]["Nombre del Inquilino"] == "Ana Ruiz "
    assert out[1]["Fecha de Archivo"] == dt.datetime(2021, 7, 1, 7)
    assert (out[2]["Razon de Archivo"], out[2]["Lead Archivado"]) == (None, False)
    assert (out[3]["Razon de Archivo"], out[3]["Lead Archivado"]) == (None, True)


def test_contracts_state_ladders(spark):
    t = make_tables(spark, {
        "mongo_rents": [dict(_id="R1", _status="started"), dict(_id="R2", parent_rent_id="R1", _status="started"),
                        dict(_id="R3", parent_rent_id="R0", _status="finished")],
        "mongo_rent_contracts": [dict(_id="C1", rent_id="R1", _status="active", signed_at=ts("2021-01-01 00:00:00")),
                                 dict(_id="C2", rent_id="R2", _status="pending"),
                                 dict(_id="C3", rent_id="R3", _status="canceled"),
                                 dict(_id="C4", rent_id="RX", _status="canceled")],
    })
    out = {r["Id de Contrato"]: (r["Renovación"], r["Status de Contrato Renovado"], r["Status de Nuevo Contrato"],
                                 r["Status Renta Previa"]) for r in rows(report("contracts", t, AS_OF))}
    assert out == {"C1": ("No", "NA", "Firmado", None), "C2": ("Si", "Pendiente de Firma", "NA", "started"),
                   "C3": ("Si", "No Renovado", "NA", None), "C4": ("No", "NA", "Cancelado", None)}


def test_tenants_population(spark):
    t = make_tables(spark, {
        "mongo_users": [dict(_id="U1", id="s1", name="a", last_name="b", second_last_name="c", email="u1@x",
                             created_at=ts("2021-01-01 00:00:00")),
                        dict(_id="U2", id="s2", name="d", last_name="e", second_last_name="f", email="u2@x",
                             created_at=ts("2021-02-01 00:00:00")),
                        dict(_id="U3", id="s3", name="g", created_at=ts("2021-03-01 00:00:00")),
                        dict(_id="U4", id="s4", name=None, last_name="h", second_last_name="i",
                             created_at=ts("2021-04-01 00:00:00"))],
        "mongo_home_home_meetings": [dict(user_id="U1"), dict(user_id=None)],
        "mongo_home_applications": [dict(user_id="U1")],
        "mongo_rents": [dict(user_id="U2"), dict(user_id="U4")],
        "mongo_users_super_heroes": [dict(mongo_users_id="s1", _super_hero_type="ops", name="b", email="b@x"),
                                     dict(mongo_users_id="s1", _super_hero_type="ops", name="a", email="a@x")],
        "mongo_google_gmail_messages": [dict(email="u1@x", provider="zillow", created_at=ts("2021-01-02 00:00:00")),
                                        dict(email="u1@x", provider="inmuebles24",
                                             created_at=ts("2021-01-01 00:00:00"))],
    })
    out = rows(report("tenants", t, AS_OF))
    assert [r["Id de Usuario"] for r in out] == ["U4", "U2", "U1"]
    by = {r["Id de Usuario"]: r for r in out}
    assert (by["U1"]["Asesor de Rentas"], by["U1"]["Nombre de Listado"]) == ("a", "inmuebles24")
    assert by["U1"]["Nombre del Inquilino"] == "a b c"
    assert (by["U2"]["Nombre de Listado"], by["U4"]["Nombre del Inquilino"]) == ("Organico", None)


def test_listing_cleansing(spark):
    base = dict(state="CDMX", city="Mexico", date_in=ts("2021-01-01 00:00:00"))
    t = make_tables(spark, {
        "webscraping.postgres_rents": [dict(base, id="a", latitude=90.0, longitude=-180.0),
                                       dict(base, id="b", latitude=90.5, longitude=0.0),
                                       dict(base, id="c", latitude=1.0, longitude=1.0, city=None),
                                       dict(base, id="d", latitude=None, longitude=1.0),
                                       dict(base, id="e", latitude=19.4, longitude=-99.1)],
        "webscraping.postgres_rents_extra_features": [dict(postgres_rents_id="e", value="pool"),
                                                      dict(postgres_rents_id="e", value="gym")],
        "webscraping.postgres_rents_i24": [dict(base, id="x", latitude=1.0, longitude=1.0, price_no_maint=d(0)),
                                           dict(base, id="y", latitude=1.0, longitude=1.0, price_no_maint=d(10))],
    })
    main = {r["id"]: r["extra_features"] for r in rows(report("webscraping_rents", t, AS_OF))}
    assert main == {"a": None, "e": "gym, pool"}
    assert [r["id"] for r in rows(report("webscraping_rents_i24", t, AS_OF))] == ["y"]


def test_active_rents_deposit_chain_and_filters(spark):
    def month(mid, rent, dep, year="2021", status="paid", charge="rent_pay", name="july"):
        return dict(id="s" + mid, _id=mid, rent_id=rent, month=name, year=year, _status=status, _charge_type=charge,
                    deposit_amount=d(dep))
    t = make_tables(spark, {
        "mongo_rents": [dict(_id="R1", _status="finished", rent_price=d(50)),
                        dict(_id="R2", parent_rent_id="R1", _status="finished", rent_price=d(500)),
                        dict(_id="R3", parent_rent_id="R2", _status="started", rent_price=d(50)),
                        dict(_id="R4", _status="canceled", rent_price=d(1))],
        "mongo_rental_months": [month("M1", "R1", "100.4"), month("M2", "R2", 10), month("M3", "R3", 1),
                                month("M4", "R4", 1, status="pending"), month("M5", "R3", 0, year="2017"),
                                month("M6", "R3", 0, status=None)],
    })
    out = {r["id mes de renta"]: (r["DeGa"], r["DeGa Estimado"], r["Renovación?"])
           for r in rows(report("active_rents", t, AS_OF))}
    assert out == {"M1": (Decimal("100"), 100.0, "No"), "M2": (Decimal("110"), 500.0, "Si"),
                   "M3": (Decimal("111"), 111.0, "Si")}


def test_srpago_weighting_equals_joined_sums(spark):
    child = lambda dd, v: dict(mongo_payment_reference_requests_dispersion_data_id=dd, amount_in_sr_pago=d(v))  # noqa
    t = make_tables(spark, {
        "mongo_rental_months": [dict(_id="M1"), dict(_id="M2")],
        "mongo_payment_reference_requests": [dict(id="P1", rental_month_id="M1", applied_to_rental_month=True),
                                             dict(id="P2", rental_month_id="M1", applied_to_rental_month=True),
                                             dict(id="P3", rental_month_id="M2", applied_to_rental_month=False)],
        "mongo_payment_reference_requests_dispersion_data": [dict(id="D1", mongo_payment_reference_requests_id="P1"),
                                                             dict(id="D2", mongo_payment_reference_requests_id="P1"),
                                                             dict(id="D3", mongo_payment_reference_requests_id="P3")],
        "mongo_payment_reference_requests_dispersion_data_owner": [child("D1", 1), child("D1", 2), child("D2", 4)],
        "mongo_payment_reference_requests_dispersion_data_advisor": [child("D1", 10), child("D1", 20),
                                                                     child("D1", 30)],
        "mongo_payment_reference_requests_dispersion_data_homie": [child("D2", 100), child("D2", None)],
        "mongo_payment_reference_requests_dispersion_data_sr_pago": [
            dict(mongo_payment_reference_requests_dispersion_data_id="D1", amount=d(1000))],
    })
    for name in t:
        t[name].createOrReplaceTempView(name.replace(".", "_"))
    brute = spark.sql("""
        SELECT rm._id AS m, sum(o.amount_in_sr_pago) AS o, sum(a.amount_in_sr_pago) AS a,
               sum(h.amount_in_sr_pago) AS h, sum(s.amount) AS s
        FROM mongo_rental_months rm
        LEFT JOIN mongo_payment_reference_requests pr ON pr.rental_month_id = rm._id
        LEFT JOIN mongo_payment_reference_requests_dispersion_data dd ON dd.mongo_payment_reference_requests_id = pr.id
        LEFT JOIN mongo_payment_reference_requests_dispersion_data_owner o
          ON o.mongo_payment_reference_requests_dispersion_data_id = dd.id
        LEFT JOIN mongo_payment_reference_requests_dispersion_data_advisor a
          ON a.mongo_payment_reference_requests_dispersion_data_id = dd.id
        LEFT JOIN mongo_payment_reference_requests_dispersion_data_homie h
          ON h.mongo_payment_reference_requests_dispersion_data_id = dd.id
        LEFT JOIN mongo_payment_reference_requests_dispersion_data_sr_pago s
          ON s.mongo_payment_reference_requests_dispersion_data_id = dd.id
        WHERE pr.applied_to_rental_month IS TRUE GROUP BY rm._id""").collect()
    got = srpago_totals(t).collect()
    assert sorted(tuple(r) for r in brute) == sorted(tuple(r) for r in got)


def test_homes_history(spark):
    def log(i, status, when, reason=None):
        return dict(id=f"L{i}", home_id="H1", status=status, changed_by_id="U9", reason=reason, created_at=ts(when),
                    updated_at=ts(when))
    t = make_tables(spark, {
        "mongo_homes": [dict(id="h1", _id="H1", _status="published", owner_id="O1",
                             price=d(1000), extra_services_amount=None, parkings=None)],
        "mongo_home_logs": [log(1, "in_progress", "2023-01-10 12:00:00"),
                            log(2, "pending_approval", "2023-01-11 12:00:00"),
                            log(3, "published", "2023-01-12 12:00:00"),
                            log(4, "canceled", "2023-02-01 12:00:00", "Baja. Razón: fotos: malas"),
                            log(5, "published", "2023-05-01 12:00:00")],
        "mongo_users": [dict(_id="U9", email="agent@x")],
        "mongo_home_features": [dict(home_id="H1", extras=32, rules=0)],
        "mongo_homes_location": [dict(mongo_homes_id="h1", value=-99.1), dict(mongo_homes_id="h1", value=19.4)],
    })
    r = rows(report("homes", t, AS_OF))[0]
    assert r["Status"] == "Publicado"
    assert r["Fecha de primer publicación"] == dt.datetime(2023, 1, 12, 6)
    assert r["Fecha de última publicacion"] == dt.datetime(2023, 5, 1, 6)
    assert r["Reactivado"] == "Si"
    # converted twice, as the report does
    assert r["Fecha Primer Pendiente Por Aprobar"] == dt.datetime(2023, 1, 11, 0)
    assert r["Fecha de Baja"] == dt.datetime(2023, 2, 1, 6)
    assert (r["Razon de Baja"], r["Comentarios de Baja"]) == ("fotos", "malas")
    assert r["Días en Línea"] == (dt.date(2023, 7, 15) - dt.date(2023, 5, 1)).days
    assert (r["Amueblado"], r["Acepta Mascotas"], r["Estacionanmientos"]) == ("Si", "No", 0)
    assert (r["Longitud"], r["Latitud"], r["Precio Total"]) == (-99.1, 19.4, Decimal("1000.00"))
    assert (r["Email agente 1er aprobacion"], r["Citas Totales"]) == ("agent@x", 0)
    once = rows(report("homes", t, AS_OF, fix_double_tz=True))[0]
    assert once["Fecha Primer Pendiente Por Aprobar"] == dt.datetime(2023, 1, 11, 6)


@pytest.mark.parametrize("name", ["homes", "payments", "applications", "rents"])
def test_reports_keep_one_row_per_driving_row_without_fanout(spark, name):
    t = make_tables(spark, {"mongo_homes": [dict(_id="H1", id="h1")], "mongo_rents": [dict(_id="R1", home_id="H1")],
                            "mongo_rental_months": [dict(_id="M1", rent_id="R1", _status="paid")],
                            "mongo_home_applications": [dict(_id="A1", id="a1", home_id="H1", _step="x")]})
    assert report(name, t, AS_OF).count() == 1


def test_payments_rows_and_deposit_instalments(spark):
    start = ts("2021-01-01 12:00:00")
    rent = dict(_id="R1", user_id="U1", home_id="H1", product="p", rent_price=d(1000), risk_guarantee=d(50),
                is_no_deposit=None, deposit_months_warranty=2, allow_monthly_owner_deposit_payment=True,
                start_date=start, months_to_pay_deposit=3, deposit_amount=d("100.01"))

    def month(mid, due, status="paid", charge="rent_pay", name="march"):
        return dict(_id=mid, rent_id="R1", month=name, year="2021", _status=status, _charge_type=charge,
                    due_date=ts(due), homie_fee=d("0.05"), remaining_amount=d(0), amount=d(10))
    t = make_tables(spark, {
        "mongo_rents": [rent],
        "mongo_users": [dict(_id="U1", name="ana", last_name=None, second_last_name="ruiz", email="a@x")],
        "mongo_rental_months": [month("M1", "2021-03-05 00:00:00"), month("M2", "2021-04-05 00:00:00", "refunded",
                                                                          "first_payment", "abril"),
                                month("M3", "2021-05-05 00:00:00", "pending"),
                                month("M4", "2021-04-30 00:00:00", name="foo")],
        "mongo_rental_payments": [dict(rental_month_id="M1", _status="applied", amount=d(10), extra_fee=d(1),
                                       paid_at=ts("2021-03-01 05:00:00")),
                                  dict(rental_month_id="M1", _status="applied", amount=d(20), extra_fee=None,
                                       paid_at=ts("2021-03-02 05:00:00")),
                                  dict(rental_month_id="M2", _status="refunded", amount=d(5), extra_fee=d(1))],
        "mongo_interest_historics": [dict(rental_month_id="M1", interests=d(-3)),
                                     dict(rental_month_id="M1", interests=d(5))],
    })
    out = rows(report("payments", t, AS_OF))
    assert sorted(r["Id Renta Mensual"] for r in out) == ["M1", "M1", "M2", "M4"]   # pending month excluded
    m1 = sorted((r for r in out if r["Id Renta Mensual"] == "M1"), key=lambda r: r["Fecha de Pago"], reverse=True)
    assert [r["Pago Recibido"] for r in m1] == [None, Decimal("11.00")]            # NULL fee -> NULL received
    assert m1[0]["Fecha de Pago"] == dt.datetime(2021, 3, 1, 23)
    assert (m1[0]["Mes/Año Pagado"], m1[0]["Tipo de Cargo"], m1[0]["Intereses generados"]) == \
        ("marzo/2021", "Renta Mensual", Decimal("2.00"))
    # two month boundaries since the start, fewer than three instalments: deferred
    assert (m1[0]["Es deposito Diferido"], m1[0]["Deposito en Garantia"]) == (True, Decimal("33.34"))
    m2 = next(r for r in out if r["Id Renta Mensual"] == "M2")
    assert (m2["Status Renta Mensual"], m2["Es No deposito"], m2["Meses en Deposito en Garantia"]) == \
        ("Reembolso", False, 2)
    assert (m2["Pago Recibido"], m2["Tipo de Tarjeta"], m2["Intereses generados"]) == \
        (None, "No disponible", Decimal("0"))   # its only payment is not applied
    assert m2["Mes/Año Pagado"] == "abril/2021"   # not an English name: passed through
    m4 = next(r for r in out if r["Id Renta Mensual"] == "M4")
    assert (m4["Mes/Año Pagado"], m4["Es deposito Diferido"], m4["Deposito en Garantia"]) == ("foo/2021", False, None)
    assert m4["Nombre del Inquilino"] == "Ana   Ruiz"


def test_rents_risk_address_and_elapsed_months(spark):
    t = make_tables(spark, {
        "mongo_rents": [dict(_id="R1", home_id="H1", user_id="U1", home_application_id="A1", _status="started",
                             is_no_deposit=True, guarantee_deposit_scheme_id="G1", deposit_months_warranty=2,
                             created_at=ts("2023-01-01 00:00:00")),
                        dict(_id="R2", home_id="H2", _status="canceled", is_no_deposit=True,
                             deposit_months_warranty=2, canceled_at=ts("2023-03-31 23:00:00"),
                             created_at=ts("2023-02-01 00:00:00")),
                        dict(_id="R3", home_id="H1", parent_rent_id="R1", _status="finished", is_no_deposit=False,
                             deposit_months_warranty=2, rent_third_party_company_fee_id="CF1",
                             created_at=ts("2023-03-01 00:00:00"))],
        "mongo_rent_contracts": [dict(rent_id="R1", signed_at=ts("2023-01-02 00:00:00"),
                                      started_at=ts("2022-12-31 00:00:00")),
                                 dict(rent_id="R2", started_at=ts("2023-01-15 00:00:00")),
                                 dict(rent_id="R3", started_at=ts("2023-01-01 00:00:00"),
                                      ends_at=ts("2023-12-31 00:00:00"))],
        "mongo_guarantee_deposit_schemes": [dict(_id="G1", name="B", days=45)],
        "mongo_home_applications": [dict(_id="A1")],
        "mongo_reports": [dict(home_application_id="A1", risk_deposit_percentage_no_deposit=d("0.1"),
                               created_at=ts("2023-01-01 00:00:00")),
                          dict(home_application_id="A1", risk_deposit_percentage_no_deposit=d("0.2"),
                               created_at=ts("2023-01-05 00:00:00"))],
        "mongo_homes": [dict(_id="H1", street="Av 1", number="10", apartment_floor=None, apartment_number="4",
                             city="CDMX"),
                        dict(_id="H2", address_from_location="Calle 2, CDMX")],
        "mongo_rent_third_party_company_fees": [dict(_id="CF1", fee_third_party_company_id="BP1",
                                                     company_first_fee=d("0.25"))],
        "mongo_agency_business_partners": [dict(_id="BP1", name="Socio")],
    })
    out = {r["Id de Renta"]: r for r in rows(report("rents", t, AS_OF))}
    r1, r2, r3 = out["R1"], out["R2"], out["R3"]
    assert r1["Riesgo Homie"] == Decimal("0.2000")                       # latest report wins
    assert r2["Riesgo Homie"] == Decimal("0.3333")                       # no report, no-deposit rent
    assert (r1["Dias De Deposito en Garantia"], r3["Dias De Deposito en Garantia"]) == (45, 60)
    assert r1["Direccion"] == "Av 1 10   Depa 4   CDMX    "
    assert r2["Direccion"] == "Calle 2, CDMX"
    assert (r1["Meses Transcurridos"], r2["Meses Transcurridos"], r3["Meses Transcurridos"]) == (7, 2, 11)
    assert (r1["Renovo"], r1["Es Renovacion"], r3["Es Renovacion"]) == (True, None, True)
    assert (r3["Asesor/Agencia"], r3["Comision Primer Mes Asesor/Agencia"]) == ("Socio", Decimal("0.2500"))
    assert r1["Asesor/Agencia"] == "No"
    assert [r["Id de Renta"] for r in rows(report("rents", t, AS_OF))] == ["R3", "R2", "R1"]


def test_applications_filters_gender_and_latest_promo(spark):
    t = make_tables(spark, {
        "mongo_home_applications": [
            dict(id="a1", _id="A1", home_id="H1", user_id="U1", agency_id="AG", _step="documents",
                 _status="approved", created_at=ts("2023-01-01 00:00:00")),
            dict(id="a2", _id="A2", home_id="H1", user_id="U2", _step="resume", _status="approved"),
            dict(id="a3", _id="A3", home_id="H1", user_id="U2", _step=None, _status="approved"),
            dict(id="a4", _id="A4", home_id="H2", user_id="U2", _step="complete", _status="rejected")],
        "mongo_users": [dict(_id="U1", _gender="female", date_of_birth=ts("1990-12-31 23:00:00")),
                        dict(_id="U1", _gender=None),  # a repeated key repeats no application
                        dict(_id="U2", _gender=None)],
        "mongo_promotion_codes": [dict(_id="P1", agency_id="AG", code="OLD", created_at=ts("2022-01-01 00:00:00")),
                                  dict(_id="P2", agency_id="AG", code="NEW", created_at=ts("2022-06-01 00:00:00"))],
        "mongo_home_application_logs": [dict(home_application_id="A1", step="documents",
                                             created_at=ts("2023-01-02 00:00:00")),
                                        dict(home_application_id="A1", step="documents",
                                             created_at=ts("2023-01-03 00:00:00"))],
        "mongo_payments": [dict(paymentable_id="A1", paid_at=ts("2023-01-04 00:00:00"))],
        "mongo_reports": [dict(home_application_id="A1", homie_score=700),
                          dict(home_application_id="A4", homie_score=500)],
    })
    got = rows(report("applications", t, AS_OF))
    out = {r["Id de Aplicacion"]: r for r in got}
    assert sorted(r["Id de Aplicacion"] for r in got) == ["A1", "A4"]              # excluded steps and NULL step dropped
    a1, a4 = out["A1"], out["A4"]
    assert (a1["Genero"], a4["Genero"], a1["Edad"]) == ("Mujer", "Sin Registro", 33)
    assert (a1["Promocode"], a4["Promocode"]) == ("NEW", None)
    assert a1["Fecha Entrega de Documentos"] == dt.datetime(2023, 1, 2, 18)
    assert (a1["Aplicaciones Pagadas"], a1["Homie Score"], a4["Homie Score"]) == (1, 700, None)
    assert (a1["Aplicaciones Aprobadas"], a4["Aplicaciones Aprobadas"], a4["Roomies"]) == (1, 0, 0)


def test_applications_keep_one_row_of_a_repeated_pair(spark):
    t = make_tables(spark, {
        "mongo_home_applications": [dict(_id="A1", id="a1", home_id="H1", agency_id="G1", _step="x"),
                                    dict(_id="A1", id="a1", home_id="H1", agency_id="G1", _step="x"),
                                    dict(_id="A1", id="a1", home_id="H1", agency_id="G2", _step="x"),
                                    dict(_id="A1", id="a1", home_id="H1", agency_id=None, _step="x"),
                                    dict(_id="A1", id="a2", home_id="H2", agency_id=None, _step="y")],
        "mongo_promotion_codes": [dict(_id="P1", code="c1", agency_id="G1", created_at=ts("2021-01-01 00:00:00"))]})
    out = rows(report("applications", t, AS_OF))
    assert sorted((r["Id de Aplicacion"], r["Promocode"] or "") for r in out) == [("A1", ""), ("A1", ""), ("A1", "c1")]


@pytest.mark.parametrize("name", ["homes", "rents", "applications"])
def test_hot_rows_do_not_change_results(spark, name):
    """Two thirds of the foreign keys are NULL or one value."""
    fk = lambda i: None if i % 3 == 0 else "X" if i % 3 == 1 else f"k{i}"
    keys = ["X", *[f"k{i}" for i in range(30)]]
    t = make_tables(spark, {
        "mongo_homes": [dict(_id=f"H{i}", id=f"h{i}", owner_id=fk(i), advisor_id=fk(i + 1), _status="published") for i in range(30)]
        + [dict(_id=k, id=k, owner_id=k) for k in keys],
        "mongo_rents": [dict(_id=f"R{i}", home_id=fk(i), user_id=fk(i + 1), guarantee_deposit_scheme_id=fk(i + 2),
                             rent_third_party_company_fee_id=fk(i), created_at=ts("2021-01-01 00:00:00")) for i in range(30)],
        "mongo_home_applications": [dict(_id=f"A{i}", id=f"a{i}", home_id=fk(i), user_id=fk(i + 1), agency_id=fk(i + 2),
                                         guarantee_deposit_scheme_id=fk(i), _step="x") for i in range(30)],
        "mongo_users": [dict(_id=k, id=k, name=k, email=f"{k}@x") for k in keys],
        "mongo_owners": [dict(_id=k, user_id=k) for k in keys],
        "mongo_home_advisors": [dict(_id=k, user_id=k, home_advisor_fee_id=k) for k in keys],
        "mongo_guarantee_deposit_schemes": [dict(_id=k, name=k, days=3) for k in keys],
        "mongo_rent_third_party_company_fees": [dict(_id=k, fee_third_party_company_id=k) for k in keys],
        "mongo_agency_business_partners": [dict(_id=k, name=k) for k in keys],
        "mongo_promotion_codes": [dict(_id=k, code=f"c{k}", agency_id=k) for k in keys],
    })
    key = lambda r: repr(sorted(r.items()))
    plain, spread = rows(report(name, t, AS_OF)), rows(report(name, t, AS_OF, hot_rows=5))
    assert len(plain) > 20 and sorted(map(key, plain)) == sorted(map(key, spread))


def test_bucket_unit_does_not_change_results(spark):
    def log(i, status, when):
        return dict(id=f"L{i}", home_id="H1", status=status, created_at=ts(when), updated_at=ts(when))
    t = make_tables(spark, {
        "mongo_homes": [dict(id="h1", _id="H1", _status="published")],
        "mongo_home_logs": [log(1, "in_progress", "2023-01-10 12:00:00"), log(2, "pending_approval", "2023-01-10 13:00:00"),
                            log(3, "published", "2023-01-10 14:30:00"), log(4, "canceled", "2023-02-01 12:00:00"),
                            log(5, "published", "2023-05-01 12:00:00")],
    })
    by_day = rows(report("homes", t, AS_OF))
    by_hour = rows(report("homes", t, AS_OF, bucket_unit="hour"))
    by_month = rows(report("homes", t, AS_OF, bucket_unit="month"))
    assert by_day == by_hour == by_month


HOME_STATUSES = {
    # status: (Status label, Días en Línea, Tipo de Baja)
    "rented": ("Baja", -31, None), "reserved": ("Baja", -31, None), "master": ("Baja", -31, None),
    "in_progress": ("En progreso", 0, None), "published": ("Publicado", 136, None),
    "temporarily_canceled_by_posposal": ("Baja por citas", 0, None),
    "unpublished_by_meetings": ("Baja por citas", 0, None), "rejected": ("Rechazado", 0, None),
    "temporarily_canceled": ("Baja temporal", 31, "Baja temporal (Propietario)"),
    "unpublished": ("Baja temporal", 31, "Baja temporal (Homie)"),
    "canceled": ("Baja temporal", 31, "Baja temporal (Propietario)"),
    "pending_approval": ("Pendiente por aprobar", 0, None), "archived": (None, 0, None),
}


def test_homes_status_ladder_and_days_online(spark):
    homes, logs = [], []
    for i, status in enumerate(HOME_STATUSES):
        homes.append(dict(id=f"h{i}", _id=f"H{i}", _status=status))
        logs.append(dict(id=f"L{i}a", home_id=f"H{i}", status="published", created_at=ts("2023-03-01 12:00:00")))
        logs.append(dict(id=f"L{i}b", home_id=f"H{i}", status="canceled", created_at=ts("2023-04-01 12:00:00")))
    # a home rented this month (signed contract), rent created after its last publication
    homes.append(dict(id="hr", _id="HR", _status="published"))
    logs.append(dict(id="LR", home_id="HR", status="published", created_at=ts("2023-06-01 12:00:00")))
    t = make_tables(spark, {
        "mongo_homes": homes, "mongo_home_logs": logs,
        "mongo_rents": [dict(_id="R1", home_id="HR", user_id="U1", _status="started",
                             created_at=ts("2023-06-20 12:00:00"))],
        "mongo_rental_months": [dict(_id="M1", rent_id="R1", month="july", year="2023", _charge_type="rent_pay",
                                     _status="paid")],
        "mongo_rent_contracts": [dict(rent_id="R1", signed_at=ts("2023-06-21 00:00:00"))],
        "mongo_users": [dict(_id="U1", name="eva", email="e@x")],
    })
    out = {r["ID Inmueble"]: r for r in rows(report("homes", t, AS_OF))}
    for i, (status, (label, days, takedown)) in enumerate(HOME_STATUSES.items()):
        r = out[f"H{i}"]
        assert (r["Status"], r["Días en Línea"], r["Tipo de Baja"]) == (label, days, takedown), status
    rented = out["HR"]
    assert (rented["Status"], rented["Días en Línea"]) == ("Rentado", 19)
    assert (rented["Nombre del Inquilino"], rented["Email del Inquilino"]) == ("Eva  ", "e@x")


def test_active_rents_fee_exemption_and_interest_key(spark):
    def month(mid, rent, fee=None, status="partial_paid"):
        return dict(id="s" + mid, _id=mid, rent_id=rent, month="july", year="2021", _status=status,
                    _charge_type="rent_pay", homie_fee=fee, deposit_amount=d(1))
    t = make_tables(spark, {
        "mongo_rents": [dict(_id="R1", _status="started", rent_price=d(500), home_application_id="A1"),
                        dict(_id="R2", _status="started", rent_price=d(500), home_application_id="A2"),
                        dict(_id="R3", _status="started", rent_price=d(500))],
        "mongo_rental_months": [month("M1", "R1", d("0.05")), month("M2", "R2", d("0.09")), month("M3", "R3")],
        "mongo_rental_months_payment_method_fee": [dict(mongo_rental_months_id="sM2",
                                                        _config_type="homie_only_receive_fee")],
        "mongo_home_applications": [dict(_id="A1", guarantee_deposit_scheme_id="GA",
                                         created_at=ts("2021-02-01 05:59:00")),   # Jan 31 local
                                    dict(_id="A2", guarantee_deposit_scheme_id="GA",
                                         created_at=ts("2021-02-01 06:00:00"))],  # Feb 1 local
        "mongo_guarantee_deposit_schemes": [dict(_id="GA", name="A")],
        "mongo_interest_historics": [dict(rental_month_id="M1", interests=d(-7), created_at=ts("2021-07-01 00:00:00")),
                                     dict(rental_month_id="M1", interests=d(3), created_at=ts("2021-07-02 00:00:00"))],
    })
    out = {r["id mes de renta"]: r for r in rows(report("active_rents", t, AS_OF))}
    assert (out["M1"]["Porcentaje Comisión"], out["M2"]["Porcentaje Comisión"], out["M3"]["Porcentaje Comisión"]) == \
        (Decimal("0.0500"), Decimal("0.0000"), Decimal("0.0000"))
    assert (out["M1"]["DeGa Estimado"], out["M2"]["DeGa Estimado"], out["M3"]["DeGa Estimado"]) == (500.0, 0.0, 500.0)
    # as written, the interest history is matched on the surrogate month id: nothing matches here
    assert out["M1"]["interes pagado"] is None
    by_business_key = {r["id mes de renta"]: r for r in
                       rows(report("active_rents", t, AS_OF, interest_month_key="_id"))}
    assert by_business_key["M1"]["interes pagado"] == Decimal("7.00")


def test_lookup_key_duplicates_points_at_fan_out(spark):
    from tablero.plans.diagnostics import lookup_key_duplicates
    t = make_tables(spark, {
        "mongo_homes": [dict(_id="H1", id="h1"), dict(_id="H1", id="h2"), dict(_id="H2", id="h3")],
        "mongo_home_features": [dict(home_id="H2", extras=1), dict(home_id="H2", extras=2)],
    })
    found = sorted(tuple(r) for r in lookup_key_duplicates(t).collect())
    assert found == [("mongo_home_features", "home_id", "H2", 2), ("mongo_homes", "_id", "H1", 2)]
    # and the homes report does fan out on exactly those keys
    assert report("homes", t, AS_OF).count() == 4

"""Reports that are written part by part (``staging``): the same rows, and a
part's shuffles and tables are gone before the next ones pile up."""

import os
import re
import time
from decimal import Decimal

import pytest

from fixtures import d, make_tables, ts
from tablero.operators import sibling_sums
from tablero.plans.reports import report
from tablero.plans.reports._common import Numbered
from tablero.sources import Staging, from_frames

AS_OF = "2024-02-15 12:00:00"
KEY = "mongo_payment_reference_requests_dispersion_data_id"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def tables(spark):
    month = lambda i, status="paid", **more: dict(
        id=f"s{i}", _id=None if i is None else f"M{i}", rent_id=f"R{(i or 0) % 4}", month="march", year="2021", _status=status,
        _charge_type=("first_payment", "rent_pay")[(i or 0) % 2], amount=d(i or 0), deposit_amount=d(3), due_date=ts("2021-03-05 00:00:00"), homie_fee=d("0.05")) | more
    child = lambda n, v: {KEY: n, "amount_in_sr_pago": d(v)}
    reference = lambda i, m, **more: dict(id=f"P{i}", rental_month_id=m, store_name=f"S{i}", applied_to_rental_month=True) | more
    # M1 is there three times, once pending, M2 twice, one month has no id, R3 has no user and no home
    months = [month(i, ("paid", "refunded", "pending", "canceled", None)[i % 5]) for i in range(10, 40)]
    months += [month(1), month(1), month(1, "pending"), month(2), month(2, None), month(3), month(None), month(None, "pending")]
    return from_frames(make_tables(spark, {
        "mongo_rental_months": months,
        "mongo_rents": [dict(_id=f"R{i}", user_id=f"U{i}" if i < 3 else None, home_id=f"H{i}" if i < 3 else None, _status="started",
                             product="p", rent_price=d(100 + i)) for i in range(4)] + [dict(_id=None, user_id="U1")],
        "mongo_users": [dict(_id="U0", name="ana", email="a@x"), dict(_id="U1", name="luis", last_name="paz", email="l@x"), dict(_id="U9", name="eva", email="e@x")],
        "mongo_homes": [dict(_id=f"H{i}", owner_id="O1", price=d(i)) for i in range(3)], "mongo_owners": [dict(_id="O1", user_id="U9"), dict(_id="O1", user_id="U0")],
        "mongo_rental_payments": [dict(rental_month_id=f"M{i}", user_id=f"U{i % 2}", _status="applied", amount=d(i), extra_fee=d(1),
                                       paid_at=ts(f"2021-03-{1 + i % 9:02d} 05:00:00")) for i in [1, 1, 3, *range(10, 40, 2)]] + [dict(rental_month_id=None, _status="applied")],
        "mongo_rental_month_dispersions": [dict(rental_month_id="M1", _applies_to=a, amount=d(7), email=f"{a}@x") for a in ("owner", "owner", "homie")],
        "mongo_interest_historics": [dict(rental_month_id=f"M{i}", interests=d(v)) for i, v in ((1, 5), (1, -2), (12, -4), (3, 1))],
        "mongo_rental_months_payment_method_fee": [dict(mongo_rental_months_id="s3", _config_type="homie_only_receive_fee")],
        "mongo_payment_reference_requests": [reference(1, "M1"), reference(2, "M1"), reference(3, "M2"), reference(4, "M77"), reference(5, None),
                                             reference(6, "M3", applied_to_rental_month=None), reference(7, "M3"), reference(None, "M3", id=None)],
        "mongo_payment_reference_requests_dispersion_data": [dict(id=f"D{i}", mongo_payment_reference_requests_id=r)
                                                             for i, r in ((1, "P1"), (2, "P1"), (3, "P2"), (4, "P3"), (5, "P4"), (6, None))],
        "mongo_payment_reference_requests_dispersion_data_owner": [child("D1", 1), child("D1", 2), child("D2", 4), child("D3", 8), child("D4", 16), child(None, 99)],
        "mongo_payment_reference_requests_dispersion_data_advisor": [child("D1", 10), child("D1", 20)],
        "mongo_payment_reference_requests_dispersion_data_homie": [child("D4", None)],
        "mongo_payment_reference_requests_dispersion_data_sr_pago": [{KEY: "D3", "amount": d(5)}],
    }))


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {x for x in (blocks.apply(i).toString() for i in range(blocks.size())) if x.startswith("shuffle_")}


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


@pytest.mark.parametrize("numbered", [False, True])
@pytest.mark.parametrize("name", ["payments", "active_rents"])
def test_parts_give_the_same_rows_and_leave_no_shuffles(spark, no_broadcast, tables, name, numbered):
    ordered = lambda: Numbered(Staging(spark, "ordered").root) if numbered else True
    whole = report(name, tables, AS_OF, ordered=ordered())
    want, columns, staging, before = rows(whole), whole.dtypes, Staging(spark, "parts"), shuffle_files(spark)
    parts = report(name, tables, AS_OF, ordered=ordered(), staging=staging)
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert os.listdir(staging.root.removeprefix("file://")) == ([] if numbered else ["rows"])
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    assert (parts.dtypes, rows(parts)) == (columns, want) and len(want) > 10


def test_parts_are_sorted_once_and_joined_no_more(spark, no_broadcast, tables):
    """What is left of the plan is the final order."""
    for name in ("payments", "active_rents"):
        plan = report(name, tables, AS_OF, staging=Staging(spark, "parts"))._jdf.queryExecution().executedPlan().toString()
        assert (len(re.findall("Exchange rangepartitioning", plan)), len(re.findall("Exchange|Join", plan))) == (1, 1)


def test_payments_sums_count_each_row_of_a_month(spark, tables):
    """References, payments, dispersions and months that are there several times; months without an id, rents without a user."""
    out = [r.asDict() for r in report("payments", tables, AS_OF, ordered=False).collect()]
    m1 = [r for r in out if r["Id Renta Mensual"] == "M1"]
    assert len(m1) == 2 * 2 * 2 * 2 * 2  # months, payments, references, owner slots, owners of the home
    assert {(r["Cantidad Propietario Sr Pago"], r["Cantidad Asesor Sr Pago"], r["Cantidad Homie Sr Pago"], r["Cantidad Sr Pago"]) for r in m1} == {
        ((3 * 2 + 4 + 8) * 3, 30 * 2 * 3, None, 5 * 3)}
    assert {(r["Intereses generados"], r["Status de Pago"], r["Pago Recibido"]) for r in m1} == {(Decimal(3), "Aplicado", Decimal(2))}
    assert {(r["Cantidad Propietario Sr Pago"], r["Tienda/Banco/Spei"], r["Status de Pago"]) for r in out if r["Id Renta Mensual"] == "M2"} == {(32, "S3", None)}
    assert sorted((r["Tienda/Banco/Spei"], r["Nombre del Inquilino"], r["Cantidad Sr Pago"]) for r in out if r["Id Renta Mensual"] == "M3") == [
        ("S7", " " * 5, None), ("SNone", " " * 5, None)]
    assert {(r["Id de Renta"], r["Tienda/Banco/Spei"]) for r in out if r["Id Renta Mensual"] is None} == {("R0", None)}


def test_children_are_dealt_as_they_are(spark):
    """No sums and counts of all children stand for one row of one child in the shuffle."""
    frame = spark.createDataFrame([("D1", Decimal(1))], "k string, v decimal(18,2)")
    plan = sibling_sums({"a": frame, "b": frame}, "k", "v")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(_record"):]
    assert "Aggregate" not in below and len(re.findall("Exchange", plan)) == 1

"""Sources and sinks: Parquet folders with the webscraping namespace, the
command-line runner, declared schemas."""

import os

from fixtures import d, make_tables, ts
from tablero.__main__ import main
from tablero.plans.reports import report
from tablero.sources import SCHEMAS, from_parquet


def _write(t, root, names):
    for name in names:
        t[name].write.mode("overwrite").parquet(os.path.join(root, *name.split(".")) + ".parquet")


def test_parquet_folder_with_namespace_and_cli(spark, tmp_path):
    base = dict(state="CDMX", city="Mexico", date_in=ts("2021-01-01 00:00:00"))
    t = make_tables(spark, {
        "webscraping.postgres_rents": [dict(base, id="a", latitude=19.4, longitude=-99.1, price=d(10))],
        "webscraping.postgres_rents_extra_features": [dict(postgres_rents_id="a", value="gym")],
        "mongo_owners": [dict(_id="O1", user_id="U1", created_at=ts("2021-07-01 12:00:00"))],
        "mongo_users": [dict(_id="U1", id="s1", name="ana")],
    })
    root = str(tmp_path / "warehouse")
    _write(t, root, ["webscraping.postgres_rents", "webscraping.postgres_rents_response",
                     "webscraping.postgres_rents_extra_features", "mongo_owners", "mongo_users", "mongo_homes",
                     "mongo_users_super_heroes"])
    assert os.path.isdir(os.path.join(root, "webscraping", "postgres_rents.parquet"))
    tables = from_parquet(spark, root)
    assert tables["mongo_users"].schema.simpleString() == spark.createDataFrame([], SCHEMAS["mongo_users"]) \
        .schema.simpleString()
    out = report("webscraping_rents", tables, "2024-01-01 00:00:00").collect()
    assert [(r.id, r.extra_features) for r in out] == [("a", "gym")]
    dest = str(tmp_path / "owners_out")
    main(["owners", root, "2024-02-15 12:00:00", dest])
    back = spark.read.parquet(dest).collect()
    assert [(r["Id de Propietario"], r["Nombre del Propietario"]) for r in back] == [("O1", "Ana  ")]

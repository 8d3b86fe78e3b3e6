"""Sources, sinks, catalog and scalar helpers."""

import os
import uuid

import numpy as np
from pyspark.sql import functions as F

from flurry.functions import scalar, structs
from flurry.sources import catalog, files, records
from flurry.session import checkpoint_dir


def _tmp(spark, tag):
    return os.path.join(checkpoint_dir(spark), f"{tag}-{uuid.uuid4().hex}")


def test_catalog_create_once_append_describe(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(1, 0.123456), (2, 2.5)], "k int, v double")
    assert catalog.save_table_if_absent(df, name) is True
    assert catalog.save_table_if_absent(df, name) is False
    catalog.save_once(df.limit(1), name)               # ignored: table exists
    assert catalog.read_table(spark, name).count() == 2
    catalog.append_metrics(df, name, round_to=2)
    vals = sorted(r.v for r in catalog.read_table(spark, name).collect())
    assert 0.12 in vals and vals.count(2.5) == 2
    desc = {r.col_name for r in catalog.describe_table(spark, name).collect()}
    assert {"k", "v"} <= desc
    assert name in {r.name for r in catalog.list_tables(spark).collect()}
    got = catalog.read_table_or_csv(spark, name, "/nonexistent", None)
    assert got.count() == 4
    spark.sql(f"DROP TABLE {name}")


def test_csv_roundtrip_and_binary_scan(spark):
    out = _tmp(spark, "csv")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    files.write_csv(df, out, single=True)
    assert len([f for f in os.listdir(out) if f.endswith(".csv")]) == 1
    back = files.read_csv(spark, out)                  # inferred scan
    assert dict(back.dtypes)["k"] == "int"
    img = _tmp(spark, "img")
    os.makedirs(img)
    for n in ("a.jpg", "b.png", "c.jpg.bak"):
        with open(os.path.join(img, n), "wb") as f:
            f.write(b"\x00\x01")
    names = sorted(p.split("/")[-1] for p in files.read_binary(spark, img).select("path").toPandas()["path"])
    assert names == ["a.jpg", "c.jpg.bak"]             # substring rule, not suffix


def test_json_records_roundtrip(spark):
    df = spark.createDataFrame([(1, "x", 2.5)], "id int, s string, v double")
    js = records.to_json_records(df, exclude=["id"])
    assert js.first().json == '{"s":"x","v":2.5}'
    back = records.from_json_records(spark.createDataFrame([('{"s":"y","extra":1}',)], "json string"),
                                     df.drop("id").schema)
    r = back.first()
    assert r.s == "y" and r.v is None


def test_model_save_load(spark):
    from pyspark.ml.classification import LogisticRegression

    from flurry.operators import explain, models
    from flurry.sources.models import load_model, save_model
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", float(i), float(i % 2)) for i in range(40)],
                               "id int, c string, x double, label double")
    m = models.fit_classifier(df, ["c"], ["x"], LogisticRegression(maxIter=5))
    st = explain.training_stats(df, ["c"], ["x"])
    path = _tmp(spark, "model")
    save_model(m, path, {"defaults": df.limit(1)}, st)
    m2, side, st2 = load_model(spark, path, ["defaults"])
    p1 = [r.probability for r in m.transform(df).collect()]
    p2 = [r.probability for r in m2.transform(df).collect()]
    assert p1 == p2 and side["defaults"].count() == 1 and st2.quartiles == st.quartiles


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(["a", "b"], {"x": 1.0}, {"x": 2.0, "y": 3.0}, 0.95, 12345.678)],
                               "arr array<string>, m1 map<string,double>, m2 map<string,double>, p double, t double")
    r = df.select(scalar.enumerate_map("arr").alias("e"), scalar.merge_maps("m1", "m2").alias("m"),
                  scalar.quantize("p", 0.0, 1.0, 7).alias("q"), scalar.quantize(F.lit(2.0), 0.0, 1.0, 7).alias("q2"),
                  scalar.quantize(F.lit(-1.0), 0.0, 1.0, 7).alias("q0"), scalar.truncate("t", 5).alias("tr"),
                  scalar.int_string(F.lit(2021.0)).alias("y"), structs.map_lookup("m1", "zz").alias("miss")).first()
    assert r.e == {0: "a", 1: "b"} and r.m == {"x": 2.0, "y": 3.0}
    assert (r.q, r.q2, r.q0) == (7, 7, 1) and r.tr == "12345" and r.y == "2021" and r.miss is None


def test_flatten_round_cast_preview(spark):
    df = spark.createDataFrame([(1, (0.123456789, (True,)), {"k": 0.987654321})],
                               "id int, a struct<p:double, b:struct<c:boolean>>, m map<string,double>")
    flat = structs.flatten(df)
    assert flat.columns == ["id", "a.p", "a.b.c", "m"]
    rd = structs.round_all(flat, 4).first()
    assert rd["a.p"] == 0.1235 and rd["m"]["k"] == 0.9877
    c = structs.cast_like(spark.createDataFrame([("3", "x")], "id string, s string"),
                          spark.createDataFrame([], "id int, s string").schema)
    assert c.first().id == 3
    from flurry.operators.clean import preview
    pv = preview(spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string").orderBy("k"), 2, "k")
    assert sorted(pv.columns) == sorted(["key", "1", "2"])


def test_feature_card(spark):
    from flurry.operators.joins import feature_card
    stats = spark.createDataFrame([("x", 1.0, 2.0, 0.0, 4.0, 1.0)], "feature string, median double, mean double, "
                                  "min double, max double, std double")
    domains = spark.createDataFrame([("c", 1, "b"), ("c", 0, "a")], "feature string, idx int, value string")
    values = spark.createDataFrame([(1, "x", "3.0"), (1, "c", "b")], "id int, feature string, value string")
    weights = spark.createDataFrame([(1, "x", 0.2)], "id int, feature string, weight double")
    got = {r.feature: r for r in feature_card(stats, domains, values, weights).collect()}
    assert got["x"].weight == 0.2 and got["x"].mean == 2.0
    assert got["c"].weight == 0.0 and got["c"].classes == ["a", "b"]

"""Randomised agreement checks (seeded, one Spark job per check)."""

import random
from urllib.parse import urljoin

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flurry.functions import urls
from flurry.operators import windows

BASES = ["http://a/b/c/d;p?q", "https://x.example.com/en/825?page=2&ref=x", "http://h:8080/",
         "https://m.site.example.net/en/25#top", "http://h/a//b/", "https://h"]
PARTS = ["a", "b", "..", ".", "", "g;x", "c.html", "%20", "é"]


def _ref(rng: random.Random) -> str:
    path = "/".join(rng.choice(PARTS) for _ in range(rng.randint(1, 5)))
    lead = rng.choice(["", "", "/", "./", "../"])
    tail = rng.choice(["", "", "?y=1", "#s", "?y#s"])
    return lead + path + tail


def test_resolve_url_random_corpus(spark):
    rng = random.Random(7)
    cases = [(rng.choice(BASES), _ref(rng)) for _ in range(600)]
    df = spark.createDataFrame(cases, "base string, ref string")
    got = [r.u for r in df.select(urls.resolve_url("base", "ref").alias("u")).collect()]
    bad = [(b, r, g, urljoin(b, r)) for (b, r), g in zip(cases, got) if g != urljoin(b, r)]
    assert not bad, bad[:5]


def test_positions_random_keys_and_nulls(spark):
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        k = rng.choice([None, "hot", "hot", "hot", "a", "b", "c"]) if rng.random() < 0.9 else None
        rows.append((i, k, rng.randint(0, 50), float(rng.randint(0, 9))))
    df = spark.createDataFrame(rows, "id long, k string, t int, v double")
    got = windows.positions(df, ["k"], ["t", "id"], "pos", sum_cols=["v"], num_partitions=11)
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = df.select("id", (F.row_number().over(w) - 1).alias("rp"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rs"))
    j = got.join(ref, "id")
    assert j.count() == 6000
    assert j.where((F.col("pos") != F.col("rp")) | (F.abs(F.col("v_running") - F.col("rs")) > 1e-9)).count() == 0

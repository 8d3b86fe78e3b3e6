"""Hand-made fixtures with hand-computed answers (FIXTURES.md reference schemas)."""

import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flurry.functions import scalar, structs, urls, vectors as vf
from flurry.operators import clean, evaluate, explain, joins, monitor, pages, sampling, summary, vectors, windows
from flurry.sources import files
from flurry.sources.schemas import CHURN_SCHEMA


# --- sources and cleaning ---------------------------------------------------------------

CSV_HEADER = ",".join(f.name for f in CHURN_SCHEMA.fields)


def _churn_row(cid, senior="0", tenure="1", total="29.85", churn="No", phone="Yes"):
    vals = [cid, "Female", senior, "Yes", "No", tenure, phone, "No", "DSL", "No", "Yes", "No", "No", "No",
            "No", "Month-to-month", "Yes", "Electronic check", "29.85", total, churn]
    return ",".join(vals)


def test_typed_csv_null_rules(spark):
    rows = [
        _churn_row("a", total="NA"),             # NA -> null double
        _churn_row("b", total=""),               # unquoted empty -> null
        _churn_row("c", total=" "),              # single space in a double column -> null
        _churn_row("d", phone='""'),             # quoted empty string stays ''
        _churn_row("e", phone=" "),              # single space stays in a string column
        _churn_row("f", phone="  "),             # two spaces survive
        _churn_row("g", churn=""),               # null label
        _churn_row("h", senior="1"),
    ]
    d = tempfile.mkdtemp(prefix="csv-")
    with open(os.path.join(d, "c.csv"), "w") as f:
        f.write(CSV_HEADER + "\n" + "\n".join(rows) + "\n")
    df = files.read_csv(spark, d, schema=CHURN_SCHEMA)
    got = {r.customerID: r for r in df.collect()}
    assert got["a"].TotalCharges is None and got["b"].TotalCharges is None and got["c"].TotalCharges is None
    assert got["d"].PhoneService == ""
    assert got["e"].PhoneService == " "
    assert got["f"].PhoneService == "  "
    assert got["g"].Churn is None
    # blank rule: exactly one whitespace char becomes null, then any-null rows go
    kept = {r.customerID for r in clean.drop_blank_rows(df).collect()}
    assert kept == {"d", "f", "h"}


def test_recode_matches_text_of_ints(spark):
    df = spark.createDataFrame([("1",), ("0",), ("x",), (None,)], "s string")
    out = clean.recode(df, {"s": {1: "Yes", 0: "No"}}).collect()
    assert [r.s for r in out] == ["Yes", "No", "x", None]
    di = spark.createDataFrame([(1,), (0,), (5,)], "i int")
    assert [r.i for r in clean.recode(di, {"i": {"1": "Yes"}}).collect()] == ["Yes", "0", "5"]


def test_presence_label_never_doubles(spark):
    df = spark.createDataFrame([("x",), (None,)], "c string")
    assert [r.l for r in df.select(clean.presence_label("c").alias("l")).collect()] == ["Yes", "No"]


def test_scale_by_zero_denominator_and_exclusions(spark):
    df = spark.createDataFrame([(10.0, 2, 50.0, 1), (3.0, 0, 40.0, 2)],
                               "pts double, games_played int, fg_percentage double, season int")
    out = clean.scale_by(df, "games_played", exclude=["season"], exclude_containing=["percentage"]).collect()
    assert out[0].pts == 5.0 and out[1].pts is None
    assert out[0].fg_percentage == 50.0 and out[0].season == 1


def test_with_defaults_fills_and_adds(spark):
    req = spark.createDataFrame([(1, None, 2.0), (2, "b", None)], "id int, cat string, num double")
    dflt = spark.createDataFrame([("a", 9.0, 7.0)], "cat string, num double, extra double")
    out = {r.id: r for r in clean.with_defaults(req, dflt).collect()}
    assert (out[1].cat, out[1].num, out[1].extra) == ("a", 2.0, 7.0)
    assert (out[2].cat, out[2].num) == ("b", 9.0)


def test_with_defaults_rejects_two_rows(spark):
    req = spark.createDataFrame([(1, None)], "id int, cat string")
    dflt = spark.createDataFrame([("a",), ("b",)], "cat string")
    with pytest.raises(Exception):
        clean.with_defaults(req, dflt).collect()


def test_row_ids_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k")).repartition(7)
    out = clean.with_row_id(df, ["k"]).collect()
    assert sorted(r.row_id for r in out) == list(range(5000))
    assert all(r.row_id == r.k for r in out)


# --- windows: hot key split across partitions -----------------------------------------------

def test_positions_with_hot_key(spark):
    # one key holds a third of all rows; numbering must equal a plain window
    n = 9000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
                               F.col("id").alias("t"), F.lit(1.0).alias("v"))
    got = windows.positions(df, ["k"], ["t"], "pos", sum_cols=["v"], num_partitions=16)
    from pyspark.sql.window import Window
    w = Window.partitionBy("k").orderBy("t")
    ref = df.select("t", (F.row_number().over(w) - 1).alias("rp"))
    bad = got.join(ref, "t").where((F.col("pos") != F.col("rp")) | (F.col("v_running") != F.col("rp") + 1))
    assert bad.count() == 0


def test_batches_drop_partial(spark):
    df = spark.range(250).select(F.lit("dep").alias("d"), F.col("id").alias("t"))
    out = windows.with_batch(df, ["d"], ["t"], 100)
    assert out.count() == 200
    assert sorted(r.batch for r in out.select("batch").distinct().collect()) == [0, 1]


def test_latest_per_key_and_versions(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 2, "c")], "k int, ts int, v string")
    got = {r.k: r.v for r in windows.latest_per_key(df, ["k"], ["ts"]).collect()}
    assert got == {1: "b", 2: "c"}
    rt = spark.createDataFrame([("2.9",), ("2.10",), ("1.20.3",)], "full_version string")
    assert joins.latest_version(rt).first().full_version == "2.10"


def test_latest_deployment_chain(spark):
    models = spark.createDataFrame([(1, "churn", "crn:m1"), (2, "churn", "crn:m2"), (3, "other", "crn:m3")],
                                   "id int, name string, crn string")
    builds = spark.createDataFrame([(10, 1, 1), (11, 1, 5), (12, 3, 1)], "id int, model_id int, created int")
    deps = spark.createDataFrame([(100, 11, "crn:d1", 1), (101, 11, "crn:d2", 9), (102, 10, "crn:d0", 20)],
                                 "id int, build_id int, crn string, created int")
    r = joins.latest_deployment(models, builds, deps, "churn").collect()
    assert len(r) == 1 and r[0].model_id == 1 and r[0].build_id == 11 and r[0].deployment_crn == "crn:d2"


def test_ground_truth_attach_latest_wins(spark):
    log = spark.createDataFrame([("u1", 0.7), ("u2", 0.2), ("u3", 0.9)], "uuid string, p double")
    truth = spark.createDataFrame([("u1", False, 1), ("u1", True, 2), ("u2", False, 1)],
                                  "uuid string, final_label boolean, t int")
    got = {r.uuid: r.final_label for r in joins.attach_ground_truth(log, truth, "uuid", "t").collect()}
    assert got == {"u1": True, "u2": False, "u3": None}


# --- summaries ---------------------------------------------------------------------------

def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = rng.normal(size=2001).tolist() + [5.0] * 500
    df = spark.createDataFrame([(("hot" if i % 2 else "a"), float(v)) for i, v in enumerate(vals)], "g string, v double")
    got = {r.g: r for r in summary.exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.9], ["a", "b", "c"]).collect()}
    for g in ("hot", "a"):
        arr = np.array([v for i, v in enumerate(vals) if (("hot" if i % 2 else "a") == g)])
        exp = np.percentile(arr, [25, 50, 90])
        assert np.allclose([got[g].a, got[g].b, got[g].c], exp)


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "x double")
    out = {r.bin: r["count"] for r in summary.histogram(df, "x", bins=5).collect()}
    assert out == {1: 2, 2: 2, 3: 1, 5: 1}  # width 2: [0,2) [2,4) [4,6) ... 10 in the last bin


def test_box_stats_fences(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "y double")
    r = summary.box_stats(df, None, "y").first()
    assert (r.q1, r.median, r.q3) == (3.0, 5.0, 7.0)
    assert r.whisker_hi == 8.0 and r.n_outliers == 1


def test_corr_pairs_lower_triangle(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, 0.0), (3.0, 6.0, 1.0)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.corr for r in summary.corr_pairs(df, ["a", "b", "c"]).collect()}
    assert set(got) == {("b", "a"), ("c", "a"), ("c", "b")}
    assert got[("b", "a")] == 1.0


# --- evaluation ----------------------------------------------------------------------------

def test_auc_equals_pair_count(spark):
    rng = np.random.default_rng(3)
    lab = rng.integers(0, 2, 300)
    sc = np.round(rng.random(300), 1)  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(lab, sc)], "label int, score double")
    pos, neg = sc[lab == 1], sc[lab == 0]
    exp = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert math.isclose(evaluate.auc(df, "label", "score").first().auc, exp, rel_tol=1e-12)
    roc = evaluate.roc_curve(df, "label", "score").orderBy(F.col("threshold").desc()).collect()
    assert roc[-1].fpr == 1.0 and roc[-1].tpr == 1.0


def test_report_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (0, 0)], "label int, pred int")
    rep = {r.cls: r for r in evaluate.classification_report(df, "label", "pred").collect()}
    assert rep["1"].precision == 0.0 and rep["1"].recall == 0.0 and rep["1"].f1 == 0.0
    assert math.isclose(rep["accuracy"].f1, 1 / 3)
    assert math.isclose(evaluate.balanced_accuracy(df, "label", "pred").first()[0], 0.5)


# --- splits ----------------------------------------------------------------------------------

def test_split_disjoint_and_complete(spark):
    df = spark.range(10000).withColumnRenamed("id", "k")
    tr, te = sampling.train_test_split(df, "k", 0.25)
    assert tr.count() + te.count() == 10000
    assert tr.join(te, "k").count() == 0
    assert te.count() == 2474  # same count as the DuckDB form of the bucket
    for share in (0.004, 0.125, 0.29):  # shares that are no whole percents too
        tr, te = sampling.train_test_split(df, "k", share)
        n = te.count()
        assert tr.count() + n == 10000 and abs(n - 10000 * share) < 4 * math.sqrt(10000 * share)


def test_heat_bins_take_both_ranges_from_the_data(spark):
    ex = spark.createDataFrame([(1, 0.2, {"a": -1.0, "b": 0.0}), (2, 0.4, {"a": 1.0}), (3, 0.9, {})],
                               "id int, probability double, explanation map<string,double>")
    got = {r.id: (r.weight_bins, r.probability_bin) for r in explain.heat_bins(ex).collect()}
    assert got == {1: ({"a": 1, "b": 4}, 1), 2: ({"a": 7}, 3), 3: ({}, 7)}
    fixed = explain.heat_bins(ex, weight_range=(-0.3, 0.3), prob_range=(0.0, 1.0))
    assert [r.probability_bin for r in fixed.orderBy("id").collect()] == [2, 3, 7]


# --- vectors ----------------------------------------------------------------------------------

def _vec_fixture(spark):
    rows = [(0, [0.0, 0.0]), (1, [0.0, 0.0]),                    # duplicate pair
            (2, [5.0, 5.0]), (3, [5.0, 5.0]), (4, [5.0, 5.0]),   # triple
            (5, [1.0, 0.0]), (6, [-1.0, 0.0]),                   # equal distances to 0/1
            (7, [20.0, 20.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_most_similar_duplicates_and_ties(spark):
    got = {r["index"]: (r.L2, r.similar_index) for r in vectors.most_similar(_vec_fixture(spark)).collect()}
    assert got[0] == (1.0, 5)          # pair: third neighbour, tie 5 vs 6 broken by id
    assert got[1] == (1.0, 5)
    assert got[2][0] == 0.0            # triple: distance 0 is returned
    assert got[7] == (450.0, 2)
    top = vectors.most_unique(_vec_fixture(spark), 1).first()
    assert top["index"] == 7


def test_blocked_knn_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    pts = rng.normal(size=(300, 8)).astype("float32")
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(pts)], "vec_id long, embedding array<float>")
    got = vectors.knn(df, df, 4, block_rows=64).collect()  # 5 x 5 block pairs
    d = ((pts[:, None, :].astype(float) - pts[None, :, :].astype(float)) ** 2).sum(-1)
    for r in got:
        order = sorted(range(300), key=lambda j: (d[r.q, j], j))
        assert order[r.rank - 1] == r.b
        assert math.isclose(r.dist, d[r.q, r.b], rel_tol=1e-9, abs_tol=1e-12)
    assert len(got) == 1200


def test_squared_l2_expression(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "a array<double>, b array<double>")
    assert df.select(vf.squared_l2("a", "b").alias("d")).first().d == 25.0


def test_caffe_preprocess(spark):
    df = spark.createDataFrame([([10.0, 20.0, 30.0],)], "p array<double>")
    out = df.select(vf.caffe_preprocess("p").alias("q")).first().q
    assert np.allclose(out, [30 - 103.939, 20 - 116.779, 10 - 123.68])


# --- urls and pages -------------------------------------------------------------------------

URL_CASES = [
    ("http://a/b/c/d;p?q", "g"), ("http://a/b/c/d;p?q", "./g"), ("http://a/b/c/d;p?q", "g/"),
    ("http://a/b/c/d;p?q", "/g"), ("http://a/b/c/d;p?q", "//g"), ("http://a/b/c/d;p?q", "?y"),
    ("http://a/b/c/d;p?q", "g?y"), ("http://a/b/c/d;p?q", "#s"), ("http://a/b/c/d;p?q", "g#s"),
    ("http://a/b/c/d;p?q", "."), ("http://a/b/c/d;p?q", "./"), ("http://a/b/c/d;p?q", ".."),
    ("http://a/b/c/d;p?q", "../"), ("http://a/b/c/d;p?q", "../g"), ("http://a/b/c/d;p?q", "../.."),
    ("http://a/b/c/d;p?q", "../../g"), ("http://a/b/c/d;p?q", "../../../g"), ("http://a/b/c/d;p?q", ""),
    ("https://x.example.com:8080/en/825?page=2", "/The"), ("https://x.example.com/en/", "img/a.jpg"),
    ("https://x.example.com", "a.html"), ("http://h/a/b", "https://other/z"), ("http://h/a//b/c", "../d"),
]


def test_resolve_url_matches_urljoin(spark):
    from urllib.parse import urljoin
    df = spark.createDataFrame(URL_CASES, "base string, ref string")
    got = [r.u for r in df.select(urls.resolve_url("base", "ref").alias("u")).collect()]
    assert got == [urljoin(b, r) for b, r in URL_CASES]


def test_host_and_file_name(spark):
    df = spark.createDataFrame([("https://www.ux1.eiu.edu:80/x/images/2021/flake.jpg",)], "u string")
    r = df.select(urls.url_host("u").alias("h"), urls.target_file_name("u").alias("f")).first()
    assert r.h == "www.ux1.eiu.edu:80" and r.f == "images_flake.jpg"


PAGES = [
    (1, "https://site.example/index.html",
     '<a href="https://site.example/snow/Desktop/a.html">x</a><a class=k HREF=\'rel/Desktop.html\'>y</a>'
     '<a name="nohref">z</a><a href="http://other.example/p.html">o</a>'),
    (2, "https://site.example/snow/Desktop/a.html",
     '<img src="../img/Desktop/pic1.jpg"><img alt="none"><img src=""><img src="https://cdn.example/x/y.jpg">'),
    (3, "https://site.example/champions.html",
     '<table id="champions_index"><tr><th colspan="2">Top</th></tr><tr><th>Year</th><th>Champion</th></tr>'
     '<tr><td>2020</td><td>Lakers</td></tr><tr><td>2021</td><td> Bucks </td></tr></table>'
     '<table id="other"><tr><td>no</td></tr></table>'),
]


def _pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def test_links_images_and_two_hop(spark):
    p = _pages(spark)
    links = pages.extract_links(p).where(F.col("page_id") == 1).orderBy("pos").collect()
    assert [r.link for r in links] == ["https://site.example/snow/Desktop/a.html", "rel/Desktop.html",
                                       "http://other.example/p.html"]
    kept = pages.filter_links(pages.extract_links(p), ["http", "html", "Desktop"]).collect()
    assert [r.link for r in kept] == ["https://site.example/snow/Desktop/a.html"]
    imgs = pages.extract_images(p).orderBy("pos").collect()
    assert [r.src for r in imgs] == ["../img/Desktop/pic1.jpg", "https://cdn.example/x/y.jpg"]
    hop = pages.two_hop_images(p, ["http", "html", "Desktop"], host="site.example").collect()
    assert [(r.page_id, r.link_page_id, r.image, r.file_name) for r in hop] == [
        (1, 2, "https://site.example/snow/img/Desktop/pic1.jpg", "img_pic1.jpg")]


def test_html_table_by_id(spark):
    t = pages.extract_table(_pages(spark), "champions_index").orderBy("row_idx").collect()
    assert [(r.page_id, r.cells) for r in t] == [(3, ["2020", "Lakers"]), (3, ["2021", "Bucks"])]
    assert t[0].header == ["Year", "Champion"]


# --- monitoring ------------------------------------------------------------------------------

def test_metric_log_flatten_and_processing_time(spark):
    from flurry.sources.schemas import METRIC_LOG_SCHEMA
    rows = [("u1", "m", "d", 1000, 2500, ({"a": "1"}, 0.7, {"f": 0.1}, True, None)),
            ("u2", "m", "d", 1000, 1200, ({"a": "2"}, 0.2, {"f": -0.1}, None, None))]
    df = spark.createDataFrame(rows, METRIC_LOG_SCHEMA)
    flat = monitor.flatten_metrics(df)
    assert "metrics.probability" in flat.columns and "metrics.final_label" in flat.columns
    t = df.select(scalar.epoch_ms_to_ts("startTimeStampMs").alias("s"), scalar.epoch_ms_to_ts("endTimeStampMs").alias("e"))
    r = monitor.with_processing_time(t, "s", "e").collect()
    assert r[0].duration_us == 1_500_000 and r[0].subsecond_ns == 500_000_000
    series = monitor.metric_series(flat.withColumn("ts", F.col("startTimeStampMs")), "metrics.final_label")
    assert series.count() == 1


def test_batch_accuracy_complete_batches_only(spark):
    n = 250
    df = spark.range(n).select(F.col("id").alias("uuid"), F.timestamp_seconds("id").alias("ts"),
                               (F.col("id") % 2 == 0).alias("final_label"), F.lit(True).alias("prediction"))
    out = monitor.batch_accuracy(df, size=100).orderBy("batch").collect()
    assert [r.batch for r in out] == [0, 1] and all(r.accuracy == 0.5 for r in out)


def test_grouped_knn_hot_group_blocks(spark):
    """A group holding most rows is searched in blocks; results equal brute
    force restricted to the group."""
    rng = np.random.default_rng(11)
    pts = rng.normal(size=(400, 4)).astype("float32")
    grp = [0 if i < 300 else 1 + i % 3 for i in range(400)]
    df = spark.createDataFrame([(i, p.tolist(), g) for i, (p, g) in enumerate(zip(pts, grp))],
                               "vec_id long, embedding array<float>, g long")
    got = vectors._grouped_knn(*[df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), F.col("g").cast("long").alias("g"))] * 2, 2, 50, False).collect()
    d = ((pts[:, None, :].astype(float) - pts[None, :, :].astype(float)) ** 2).sum(-1)
    for r in got:
        same = [j for j in range(400) if grp[j] == grp[r.q]]
        order = sorted(same, key=lambda j: (d[r.q, j], j))
        assert order[r.rank - 1] == r.b
    assert len(got) == 800


def test_lsh_recall_reasonable(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    approx = vectors.knn_approx(e, e, 3, bucket_length=2.0, num_hash_tables=4)
    exact = vectors.knn(e, e, 3)
    assert vectors.recall_at_k(approx, exact).first().recall > 0.8


def test_knn_many_duplicates_tie_by_id(spark):
    """Twelve identical vectors spread over several blocks: the 3 nearest of
    each are the 3 smallest ids (distance 0), whatever the rounding."""
    rng = np.random.default_rng(21)
    rows = [(i, [0.3, -1.7, 2.2, 0.9]) for i in range(100, 112)]
    rows += [(i, (rng.normal(size=4) * 5).tolist()) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = vectors.knn(df, df, 3, block_rows=16).where(F.col("q") >= 100).collect()
    for r in got:
        assert r.dist == 0.0 and r.b == 100 + r.rank - 1
    ex = vectors.knn(df, df, 3, block_rows=16, exclude_self=True).where(F.col("q") == 100).collect()
    assert sorted(r.b for r in ex) == [101, 102, 103]


def _clustered(n, seed=3, dim=8, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim)) * 3
    return [centres[i % 12] + spread * rng.normal(size=dim) for i in range(n)]


def test_knn_pivots_equal_brute_force_for_any_ids(spark):
    x = _clustered(400) + [np.zeros(8)] * 5
    rows = [(f"id{i:03d}é", v.tolist()) for i, v in enumerate(x)] + [("none", None)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>").repartition(5)
    for self_out in (False, True):
        got = {}
        for r in vectors.knn(df, df, 4, block_rows=32, exclude_self=self_out).collect():
            got.setdefault(r.q, {})[r.rank] = (r.dist, r.b)
        assert len(got) == 405
        X, ids = np.array(x), [r[0] for r in rows[:-1]]
        for i, q in enumerate(ids):
            d = ((X - X[i]) ** 2).sum(1)
            want = sorted((float(d[j]), ids[j]) for j in range(len(ids)) if not (self_out and j == i))[:4]
            mine = [got[q][r + 1] for r in range(4)]
            assert [b for _, b in mine] == [b for _, b in want]
            assert np.allclose([v for v, _ in mine], [v for v, _ in want], atol=1e-12)
    assert vectors.knn(df.limit(0), df, 3).count() == 0 and vectors.knn(df, df.limit(0), 3).count() == 0
    assert vectors.knn(df, df.limit(2), 3, block_rows=1).groupBy("q").count().where("count <> 2").count() == 0


def test_knn_pivots_visit_few_cells_of_clustered_rows(spark):
    """Rows sent to other cells stay far below queries x cells."""
    x = _clustered(1200)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    centres = vectors.choose_pivots(np.array(x[:600]), 12)
    q = vectors._to_pivots(df, centres, True)
    cells = {r["cell"]: (r["n"], r["lo"], r["hi"]) for r in q.groupBy("cell").agg(
        F.count("*").alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi")).collect()}
    home = vectors._ranked(vectors._visit(q.select("id", "v", F.col("cell").alias("to"), "d", F.lit(float("inf")).alias("reach")),
                                          q.select("id", "v", "cell", "d"), cells, 3, 64, False), 3)
    reach = home.where("rank = 3").select(F.col("q").alias("id"), F.sqrt("dist").alias("reach"))
    assert vectors.far_routes(q, cells, reach, centres).count() < 0.1 * 1200 * len(cells)


def test_knn_predict_text_labels(spark):
    rows = [(f"k{i}", [float(i % 2), 0.1 * i], "xy"[i % 2]) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>, label string")
    got = {r["vec_id"]: r["pred"] for r in vectors.knn_predict(df, df, 3).collect()}
    assert set(got.values()) == {"x", "y"} and got["k0"] == "x" and got["k1"] == "y"


def test_knn_approx_always_finds_k(spark):
    """Narrow buckets: most hold one row, so neighbours come from probing on."""
    x = _clustered(150, spread=1.0) + [np.full(8, 50.0)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = vectors.knn_approx(df, df, 5, bucket_length=0.05, num_hash_tables=6)
    assert got.groupBy("q").agg(F.count("*").alias("n"), F.max("rank").alias("r")).where("n <> 5 or r <> 5").count() == 0
    assert got.select("q").distinct().count() == 151
    assert vectors.recall_at_k(vectors.knn_approx(df, df, 5, bucket_length=4.0, num_hash_tables=6), vectors.knn(df, df, 5)).first()[0] > 0.9


def test_null_group_keeps_its_quantiles(spark):
    rows = [(None, float(v)) for v in range(1, 6)] + [("a", float(v)) for v in (10, 20, 30)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.median for r in summary.exact_quantiles(df, ["g"], "v", [0.5], ["median"]).collect()}
    assert got == {None: 3.0, "a": 20.0}
    box = {r.g: (r.n, r.median) for r in summary.box_stats(df, "g", "v").collect()}
    assert box == {None: (5, 3.0), "a": (3, 20.0)}


def test_join_on_keys_null_and_full(spark):
    from flurry.operators.keys import join_on_keys
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("y", 30)], "k string, b int")
    inner = sorted((r.k, r.a, r.b) for r in join_on_keys(a, b, ["k"]).collect())
    assert inner == [(None, 1, 10)]
    full = sorted(((r.k or ""), r.a, r.b) for r in join_on_keys(a, b, ["k"], how="full").collect())
    assert full == [("", 1, 10), ("x", 2, None), ("y", None, 30)]
    df = spark.createDataFrame([(None if i % 2 else "k", i) for i in range(300)], "d string, t long")
    assert windows.with_batch(df, ["d"], ["t"], 100).count() == 200   # 150 per key: one full batch each


def test_approximate_paths(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame([(float(x),) for x in rng.normal(size=3000)], "x double")
    exact = summary.describe_features(df, ["x"]).first()
    approx = summary.describe_features(df, ["x"], approx=True).first()
    assert abs(exact.median - approx.median) < 0.05 and math.isclose(exact.mean, approx.mean, rel_tol=1e-9)
    box = summary.box_stats(df, None, "x", approx=True).first()
    assert box.q1 < box.median < box.q3
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    near = vectors.knn_approx(e, e, 3, threshold=0.5, bucket_length=2.0, num_hash_tables=4).collect()
    assert all(r.dist <= 0.25 + 1e-12 for r in near)


def test_positions_keep_long_values(spark):
    big = 2 ** 53
    rows = [(i, None if i % 3 == 0 else big + i) for i in range(40)]
    df = spark.createDataFrame(rows, "t long, v long")
    got = windows.positions(df, [], ["t"], "pos", num_partitions=7).collect()
    assert sorted((r.t, r.v, r.pos) for r in got) == [(i, v, i) for i, v in rows]


def test_quantiles_of_hot_values(spark):
    # one value only; and a hot value inside a key that holds most of the rows
    one = spark.range(20000).select(F.lit(4.0).alias("v"))
    assert summary.value_counts(one, [], "v").select("_c", "_n", "_mean").collect() == [(20000, 20000, 4.0)]
    assert tuple(summary.exact_quantiles(one, [], "v", [0.0, 0.5, 1.0], ["a", "b", "c"]).first()) == (4.0, 4.0, 4.0)
    i = F.col("id")
    df = spark.range(9000).select(F.when(i % 10 < 9, F.lit("hot")).otherwise(F.lit("x")).alias("g"),
                                  F.when(i % 3 > 0, F.lit(7.0)).otherwise((i % 101).cast("double")).alias("v"))
    probs = [0.1, 0.25, 0.5, 0.9]
    pdf = df.toPandas()
    for r in summary.exact_quantiles(df, ["g"], "v", probs, ["a", "b", "c", "d"], {"mean": "mean"}).collect():
        v = pdf[pdf.g == r.g].v
        assert np.allclose([r.a, r.b, r.c, r.d, r.mean], [*np.quantile(v, probs), v.mean()])
    box = {r.g: r for r in summary.box_stats(df, "g", "v").collect()}
    for g, v in pdf.groupby("g").v:
        q1, q3 = np.quantile(v, [0.25, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        want = (len(v), v[v >= lo].min(), v[v <= hi].max(), int(((v < lo) | (v > hi)).sum()))
        assert (box[g].n, box[g].whisker_lo, box[g].whisker_hi, box[g].n_outliers) == want


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert summary.exact_quantiles(df, ["g"], "v", [0.5], ["m"]).count() == 0
    assert summary.exact_quantiles(df, [], "v", [0.5], ["m"]).collect() == [(None,)]


def test_page_markup_is_read_as_markup(spark):
    html = """<!-- <a href="/hidden"> --><SCRIPT>x = '<a href="/s">'; if (a > b) {}</SCRIPT><style>a[href="q"]{}</style>
    <A title="x > y href='/wrong'" HREF='/one?a=1&amp;b=2'>1</A><a name=top>no</a><a data-href="/d" href=/two>2</a>
    <a href="/t&#104;ree&#x1F600;&lt;&quot;&amp;amp;&nope;">3</a><abbr href="/no">x</abbr><a href="">empty</a><a/href="/four">4</a>
    <img alt="<img src=z>" src="a.png"><img><img src=""><img srcset="s" SRC = 'b.png'><!-- open <a href="/late">"""
    df = spark.createDataFrame([(1, "http://h/p", html), (2, "http://h/q", None), (3, "http://h/r", ""), (4, "u", "<a href=x" + " y=1" * 5000 + ">")],
                               "page_id long, url string, html string")
    got = [(r.page_id, r.pos, r.link) for r in pages.extract_links(df).orderBy("page_id", "pos").collect()]
    assert got == [(1, 0, "/one?a=1&b=2"), (1, 1, "/two"), (1, 2, '/three\U0001f600<"&amp;&nope;'), (1, 3, ""), (1, 4, "/four"), (4, 0, "x")]
    assert [r.src for r in pages.extract_images(df).orderBy("pos").collect()] == ["a.png", "b.png"]


def test_table_spans(spark):
    html = """<table id="other"><tr><td>x</td></tr></table>
    <table id='t'><tr><th rowspan=2>A<th colspan=2>B</tr><tr><th>b1</th><th>b2</th></tr>
    <tr><td rowspan=3>1</td><td>2 &amp; <i>3</i></td><td rowspan="0">z</td><tr><td>4<table id=in><tr><td>in</td></tr></table></td></tr>
    <tr><td colspan="2">5</td></tr><tr></tr></table><table id=t><tr><td>second</td></tr></table>"""
    df = spark.createDataFrame([(1, html), (2, None), (3, "<p>no</p>")], "page_id long, html string")
    got = [(r.row_idx, r.cells, r.header) for r in pages.extract_table(df, "t").orderBy("row_idx").collect()]
    head = ["A", "b1", "b2"]
    assert [g[1] for g in got] == [["1", "2 & 3", "z"], ["1", "4in", "z"], ["1", "5", "5"], ["", "", "z"]]
    assert all(g[2] == head for g in got)


def test_two_hop_images_counts_every_crawl_of_a_target(spark):
    rows = [(1, "http://h/", '<a href="http://h/x/html">a</a><a href="http://h/x/html">again</a><a href="/x/html">relative</a>'),
            (2, "http://h/x/html", "<img src=/i/j/1.png>"), (3, "http://h/x/html", "<img src=/i/j/2.png><img src=http://else/a/b/3.png>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.link_page_id, r.file_name) for r in pages.two_hop_images(df, ["http", "html"], "h").collect())
    assert got == [(1, 2, "i_1.png"), (1, 3, "i_2.png")]
    plan = pages.two_hop_images(df, ["http", "html"])._jdf.queryExecution().executedPlan().toString()
    exchange = [line for line in plan.splitlines() if "Exchange" in line]
    assert exchange and not any("html" in line for line in exchange)


def test_metric_log_is_pruned_by_day(spark, tmp_path):
    from flurry.operators import monitor
    rows = [(f"u{i}", "m", "d", i * 3_600_000, i * 3_600_000 + 5) for i in range(24 * 6)]
    log = spark.createDataFrame(rows, "uuid string, model_crn string, model_deployment_crn string, startTimeStampMs long, endTimeStampMs long")
    monitor.write_metrics(log, str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    got = monitor.read_metrics(stored, "m", "d", 2 * monitor.DAY_MS, 3 * monitor.DAY_MS)
    assert got.count() == 24
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan.split("PartitionFilters")[1]


def test_stratified_folds_are_even(spark):
    from flurry.operators import sampling
    df = spark.createDataFrame([(i, "yes" if i % 9 == 0 else "no", "kept") for i in range(500)], "id long, label string, extra string")
    got = sampling.with_stratified_fold(df, "id", "label", 4)
    n = {(r["label"], r["fold"]): r["count"] for r in got.groupBy("label", "fold").count().collect()}
    for lab in ("yes", "no"):
        c = [n[lab, f] for f in range(4)]
        assert max(c) - min(c) <= 1
    assert got.columns == ["id", "label", "extra", "fold"] and got.count() == 500


def test_far_routes_leave_in_bounded_parts(spark):
    """Queries that must visit every cell are routed a bounded number of rows at a time."""
    rng = np.random.default_rng(4)
    x, cells = rng.normal(size=(900, 8)), {c: (3, 0.0, 1e9) for c in range(256)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").coalesce(1)
    centres = x[:256]
    q = vectors._to_pivots(df, centres, True)
    reach = df.select("id", F.lit(float("inf")).alias("reach"))
    assert vectors.far_routes(q, cells, reach, centres).count() == 900 * 255
    part = q.join(reach, "id").limit(200).toPandas()
    sizes, whole = [], vectors._routes

    def count(pdf, *rest):
        out = whole(pdf, *rest)
        sizes.append(len(out))
        return out
    step = max(1, vectors.ROUTES // 256)
    low, high = np.zeros(256), np.full(256, 1e9)
    mid = np.sqrt(((centres[:, None, :] - centres[None]) ** 2).sum(2))
    for at in range(0, len(part), step):
        count(part.iloc[at:at + step], list(range(256)), low, high, mid)
    assert sum(sizes) == 200 * 255 and max(sizes) <= vectors.ROUTES


def test_supplier_seasons_tasks_follow_the_rows(spark, tmp_path, monkeypatch):
    from flurry.plans import derived
    d = str(tmp_path)
    n = 3000
    spark.range(n).select((F.col("id") % 700).alias("l_orderkey"), (F.col("id") % 7).alias("l_suppkey"),
                          *[(F.col("id") % 9 / 100).alias(c) for c in ("l_discount", "l_tax")],
                          *[(F.col("id") % 50 + 1.25).alias(c) for c in ("l_quantity", "l_extendedprice")]).write.parquet(f"{d}/lineitem.parquet")
    spark.range(700).select(F.col("id").alias("o_orderkey"), F.date_add(F.lit("1995-01-01").cast("date"), F.col("id").cast("int")).alias("o_orderdate")).write.parquet(f"{d}/orders.parquet")
    spark.range(6).select(F.col("id").alias("s_suppkey"), F.concat(F.lit("s"), "id").alias("s_name")).write.parquet(f"{d}/supplier.parquet")
    want = sorted(map(str, derived.supplier_seasons(spark, d).collect()))
    monkeypatch.setattr(derived, "TASK_ROWS", 100)
    got = derived.supplier_seasons(spark, d)
    assert "hashpartitioning(l_orderkey" in got._jdf.queryExecution().toString() and ", 30)" in got._jdf.queryExecution().toString()
    assert sorted(map(str, got.collect())) == want and len(want) > 7


def test_far_routes_send_each_vector_out_of_python_once(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8))
    centres = x[:40]
    cells = {c: (3, 0.2, 1.0 + c % 3) for c in range(40)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").coalesce(1)
    reach = df.where("id % 3 > 0").select("id", F.when(F.col("id") % 3 == 1, 1.5).otherwise(0.0).alias("reach"))
    routes = vectors.far_routes(vectors._to_pivots(df, centres, True), cells, reach, centres)
    assert routes.columns == ["id", "v", "to", "d", "reach"]
    plan = routes._jdf.queryExecution().analyzed().toString()
    assert plan.index("Generate explode") < plan.index("MapInPandas")   # rows per cell are made in Spark
    got = {(r["id"], r["to"]): r for r in routes.collect()}
    dist = np.sqrt(((x[:, None, :] - centres[None]) ** 2).sum(2))
    home, mid = dist.argmin(1), np.sqrt(((centres[:, None, :] - centres[None]) ** 2).sum(2))
    want = set()
    for i in range(300):
        r = {0: np.inf, 1: 1.5, 2: 0.0}[i % 3]
        for c, (_, lo, hi) in cells.items():
            m, own = mid[home[i], c], dist[i, home[i]]
            plane = (dist[i, c] ** 2 - own ** 2) / (2 * m) if m > 0 else 0.0
            if c != home[i] and max(dist[i, c] - hi, lo - dist[i, c], plane) - 1e-9 * (1 + dist[i, c]) <= r:
                want.add((i, c))
    assert set(got) == want and 300 < len(want) < 300 * 39
    for (i, c), r in got.items():
        assert r["v"] == x[i].tolist() and abs(r["d"] - dist[i, c]) < 1e-12 and r["reach"] == {0: float("inf"), 1: 1.5}.get(i % 3, 0.0)


def _spread(spark, n, dim=8, seed=12):
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def test_knn_sends_a_vector_once_to_each_block_of_cells(spark, monkeypatch):
    """Rows without clusters, where nearly every query must search every cell."""
    n = 1200
    x, df = _spread(spark, n)
    visit, sent = vectors._visit, []

    def count(routes, base, cells, *rest):
        sent.append((routes.count(), len(cells)))
        return visit(routes, base, cells, *rest)
    monkeypatch.setattr(vectors, "_visit", count)
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    got = {(r.q, r["rank"]): r.b for r in vectors.knn(df, df, 3, block_rows=20).collect()}
    assert got == {(i, j + 1): b for i in range(n) for j, b in enumerate(sorted(range(n), key=lambda b: (d[i, b], b))[:3])}
    (home, cells), (far, _) = sent
    assert home == n and cells > 50 and far < 10 * n   # before: up to a row per query and cell


def test_block_topk_gives_nothing_beyond_reach():
    import pyarrow as pa
    x = np.random.default_rng(3).normal(size=(3000, 4))
    p = np.zeros(4)
    rows = dict(id=np.arange(3000), v=list(x), d=np.sqrt((x ** 2).sum(1)))
    b = pa.table(rows | {"cell": np.zeros(3000, np.int32)})
    d = ((x[:300, None] - x[None]) ** 2).sum(2)
    reach = np.sqrt(np.sort(d, 1)[:, 1])      # the second nearest row, itself included
    q = pa.table({k: v[:300] for k, v in rows.items()} | {"reach": reach})
    got = vectors._block_topk(3)((0,), q, b).to_pandas()
    assert sorted(got.groupby("q").size().unique()) == [2] and len(got) == 600
    assert (got["dist"] <= (reach ** 2)[got["q"]] * (1 + 1e-6)).all()


def test_knn_of_one_hot_vector(spark):
    """Equal rows in number: the first ids of them are the neighbours, with and without the row itself."""
    x, _ = _spread(spark, 200)
    x = np.concatenate([x, np.repeat(x[:1], 2500, 0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for alone in (False, True):
        got = vectors.knn(df, df, 3, block_rows=64, exclude_self=alone).where("q = 0 or q >= 2000").collect()
        hot = [0, 200, 201, 202]
        assert len(got) == 3 * 701
        for r in got:
            assert r.dist == 0 and r.b == [b for b in hot if not (alone and b == r.q)][r["rank"] - 1]


def test_knn_approx_compares_no_pair_twice_in_wide_buckets(spark, monkeypatch):
    n = 900
    x, df = _spread(spark, n)
    ask = dict(bucket_length=4.0, num_hash_tables=5)
    by_bucket = {(r.q, r["rank"]): (r.b, r.dist) for r in vectors.knn_approx(df, df, 4, **ask, block_rows=2048).collect()}
    monkeypatch.setattr(vectors, "_grouped_knn", None)   # before: each table's buckets, so most pairs five times
    for alone in (False, True):
        got = {(r.q, r["rank"]): (r.b, r.dist) for r in vectors.knn_approx(df, df, 4, **ask, block_rows=100, exclude_self=alone).collect()}
        assert len(got) == 4 * n and all(q != b for (q, _), (b, _) in got.items()) == alone
        assert alone or got == by_bucket

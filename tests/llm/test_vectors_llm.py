"""Mixing, hard negatives and whitening against brute force, edge cases included."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flurry.llm import negatives, queries
from flurry.llm.mixing import mix_sources, source_targets, word_count
from flurry.llm.negatives import choose_references, mine_hard_negatives, score_bounds
from flurry.llm.whitening import fit_whitening, leading_pairs, quantised, whiten

# --- mixing ------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h long, tie int, size string, `of` string, target int, digit int"


def _targets(sizes: dict, weights=(5, 2, 1), repeats=3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(repeats * sizes[s] for s in capped)
        free = sum(w for s, w in weight.items() if s not in capped)
        out = {s: repeats * sizes[s] if s in capped else left * weight[s] / free if free else 0.0 for s in order}
        over = {s for s in order if s not in capped and out[s] > repeats * sizes[s]}
        if not over:
            return out
        capped |= over


def _docs(seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(900):
        source = rng.choice(["a", "a", "a", "b", "é", "Z", "", None, "\U0001f600", "￮"])
        text = rng.choice([None, "", " \t\n", "one"]) if i % 40 == 0 else " ".join(["w"] * int(rng.paretovariate(1.1) * 5)) + f" {i}"
        out.append((i, text, "en", source, 1, 7, 8, "x", "y", 9, 0))
    out += [(5_000, "the same text again", "en", "copies", 1, 7, 8, "x", "y", 9, 0)] * 700     # one id, one text
    out += [(None, f"text {i} of no id", "en", "nobody", 1, 7, 8, "x", "y", 9, 0) for i in range(200)]
    out += [(9_000, "long " * 30_000, "en", "long", 1, 7, 8, "x", "y", 9, 0), (9_001, "short", None, "long", None, None, None, None, None, None, None)]
    out += [(9_100, None, "en", "empty", 1, 7, 8, "x", "y", 9, 0)]
    return out


def test_mixing_meets_targets(spark):
    rows = _docs()
    got = [r.asDict() for r in mix_sources(spark.createDataFrame(rows, DOCS).repartition(5)).collect()]
    assert len(got) == len(rows)
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        target[r["source"]] = r["target"]
        assert r["size"] * 3 >= r["taken"] >= 0 and (r["taken"] == 0 if not r["size"] else r["taken"] % r["size"] == 0)
    words = lambda t: len((t or "").split())  # noqa: E731  (only ASCII white space in these texts)
    assert sorted(r["size"] for r in got) == sorted(words(r[1]) for r in rows)
    assert {r["source"]: r["source_size"] for r in got} == dict(sizes)
    want = _targets(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6, s
    # one group of equal rows is split where the budget ends: within half a row
    assert abs(taken["copies"] - want["copies"]) <= 2
    again = [r.asDict() for r in mix_sources(spark.createDataFrame(rows[::-1], DOCS).repartition(3)).collect()]
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"], str(r["source"]))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixing_budgets_are_nested(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 50), "abc"[i % 3]) for i in range(600)], "doc_id long, text string, source string")
    few = {r["doc_id"]: r["taken"] for r in mix_sources(docs, weights=(2, 5, 5)).collect()}
    more = {r["doc_id"]: r["taken"] for r in mix_sources(docs, weights=(3, 5, 5)).collect()}
    mine = [i for i in few if i % 3 == 0]
    assert all(more[i] >= few[i] for i in mine) and sum(more[i] for i in mine) > sum(few[i] for i in mine)


def test_mixing_empty_and_words(spark):
    assert mix_sources(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
    only = mix_sources(spark.createDataFrame([(1, None, None), (2, "", None)], "doc_id long, text string, source string")).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in only] == [(0, 0, 0.0)] * 2
    cases = {"": 0, " ": 0, "a": 1, " a  b\n": 2, "\x0b\x0ca b c": 1, "\x1fa b\x00c": 2, "\U0001f600 é": 2, "x": 1}
    got = spark.createDataFrame([(t,) for t in cases], "t string").select("t", word_count(F.col("t")).alias("n")).collect()
    assert {r["t"]: r["n"] for r in got} == cases
    sizes = spark.createDataFrame([("b", 10), ("a", 0), (None, 90)], "source string, source_size long")
    assert {r["source"]: r["target"] for r in source_targets(sizes).collect()} == {"a": 0.0, "b": 30.0, None: 70.0}


# --- hard negatives ----------------------------------------------------------

def _brute(rows, k=5, m=3):
    rows = [(v, lab, [math.floor(256 * float(c)) for c in e]) for v, lab, e in rows
            if lab is not None and e is not None and all(c is not None and math.isfinite(c) for c in e)]
    rows = [(v, (lab + 1) % 10 if v is not None and v % 7 == 0 else lab, x) for v, lab, x in rows]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for v, lab, x in rows:
        if v is None or v % 50:
            continue
        others = [(dot(x, y), w, lb) for w, lb, y in rows if w != v]
        for ps, p, _ in sorted((t for t in others if t[2] == lab), key=order)[:k]:
            fit = sorted((t for t in others if t[2] != lab and 50 * ps <= 100 * t[0] <= 95 * ps), key=order)[:m]
            out += [(v, p, i + 1, t[1], ps, t[0]) for i, t in enumerate(fit)]
    return sorted(out, key=str)


def _mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("rid", F.lit("x")).withColumn("cell", F.lit(1))
    df = quantised(df.filter("label is not null"), "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = mine_hard_negatives(df.withColumn("label", moved), **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def _vectors(n, seed=5, tight=0.35, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    out = []
    for i in range(n):
        c = centres[rng.integers(6)] + tight * rng.normal(size=dim)
        out.append((i, int(rng.integers(0, 10)) if i % 11 else int(i % 3), [float(np.float32(v)) for v in c / np.linalg.norm(c)]))
    return out


def test_hard_negatives_equal_brute_force(spark):
    rows = _vectors(620)
    rows += [(1000 + i, 4, rows[0][2]) for i in range(60)] + [(2000 + i, 5, rows[0][2]) for i in range(40)]   # ties, many copies
    rows += [rows[3], rows[50], rows[50]]                                                                  # repeated rows and anchors
    rows += [(None, 4, rows[0][2]), (3001, None, rows[0][2]), (3002, 4, None), (3003, 4, [None] * 12), (3004, 4, [math.nan] + [0.0] * 11),
             (3050, 4, [math.inf] * 12), (3100, 2, [0.0] * 12), (3101, 2, [0.0] * 12), (3102, 3, [0.0] * 12), (3150, 4, [0.9]), (3200, 4, []),
             (-50, 4, rows[1][2]), (3250, 9, [-v for v in rows[0][2]])]
    want = _brute(rows)
    assert len(want) > 200
    assert _mined(spark, rows, block_rows=64, block_anchors=7, references=6) == want
    assert _mined(spark, rows, references=1, fit_rows=3) == want


def test_hard_negatives_small_tables(spark):
    assert _mined(spark, []) == []
    assert _mined(spark, [(50, 1, [1.0, 0.0])]) == []
    rows = [(50, 1, [0.5, 0.5]), (51, 1, [0.6, 0.4]), (52, 2, [0.4, 0.4]), (53, None, [0.4, 0.4])]
    assert _mined(spark, rows) == _brute(rows) != []


def test_angle_bounds_hold_and_skip(spark):
    rng = np.random.default_rng(1)
    x = np.floor(256 * np.concatenate([c + 0.05 * rng.normal(size=(80, 16)) for c in rng.normal(size=(5, 16))])).astype(np.int64)
    refs, norm = choose_references(x.astype(float), 5), np.linalg.norm(x, axis=1)
    angle = np.arccos(np.clip(x @ refs.T / norm[:, None], -1, 1))
    score, skipped = x @ x.T, 0
    for i in range(0, len(x), 7):
        near = np.abs(angle[i] - angle).max(1)
        far = np.minimum(angle[i] + angle, 2 * math.pi - angle[i] - angle).min(1)
        down, up = score_bounds(norm[i], norm, norm, near, far)
        assert (down <= score[i]).all() and (score[i] <= up).all()
        skipped += int((up < np.sort(score[i])[-10]).sum())
    assert skipped > 0.5 * len(range(0, len(x), 7)) * len(x)   # clustered rows: most are ruled out unscored
    # cells far from an anchor's window are not visited
    df = spark.createDataFrame([(i, 0, v.tolist()) for i, v in enumerate(x)], "vec_id long, label int, x array<long>")
    d = negatives._described(df.withColumn("rid", F.col("vec_id")), refs, 16)
    cells = negatives.Cells(d, len(refs))
    asked = d.withColumn("aid", F.col("vec_id")).withColumn("windows", F.array(F.struct(
        (0.8 * F.col("norm") ** 2).cast("long").alias("lo"), F.lit(1 << 60).alias("hi"))))
    assert negatives._routes(asked, cells, False).count() < 0.5 * len(x) * (len(cells.cell) - 1)


def test_hard_negatives_query_equals_sql_rows(spark, small_dir):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op11_hard_negatives(spark, small_dir).collect()), key=str) == _brute(rows)


# --- whitening ---------------------------------------------------------------

def _whitened(rows, k=4):
    """Brute force: id -> (deviation, {component: |whitened|}), explained, by a dense eigensolver."""
    ok = [(i, e) for i, e in rows if e is not None and all(c is not None and math.isfinite(c) for c in e)]
    dim = max((len(e) for _, e in ok), default=0)
    x = [(i, tuple(math.floor(256 * float(c)) for c in e) + (0,) * (dim - len(e))) for i, e in ok]
    fit = sorted({v for _, v in x})
    n, total = len(fit), [sum(v[d] for v in fit) for d in range(dim)]
    c = np.array([[(n * a - s) / n for a, s in zip(v, total)] for v in fit])
    value, vec = np.linalg.eigh(c.T @ c / n)
    value, vec = value[::-1][:k], vec[:, ::-1][:, :k]
    out = []
    for i, v in x:
        d = [n * a - s for a, s in zip(v, total)]
        out.append((i, sum(a * a for a in d), np.abs(np.array(d) / n @ vec / np.sqrt(value))))
    return n, out, value / (c ** 2).sum() * n


@pytest.fixture(scope="module")
def whitening_rows():
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=10) * np.linspace(1, 0.2, 10)]) for i in range(300)]
    rows += [rows[0]] * 40 + [(900, rows[1][1]), (None, rows[2][1]), (901, None), (902, [0.1] * 9 + [None]), (903, [math.nan] * 10),
                              (904, [-math.inf] + [0.0] * 9), (905, [0.25, 0.5]), (906, []), (907, [0.0] * 10),
                              (908, [0.25, 0.5, 0.0])]
    return rows


def test_whitening_equals_dense_solver(spark, whitening_rows):
    df = spark.createDataFrame(whitening_rows, "vec_id long, embedding array<float>").withColumn("x", F.lit("clash")).withColumn("n", F.lit(1))
    got = [r.asDict() for r in whiten(df.repartition(3)).collect()]
    n, want, share = _whitened(whitening_rows)
    assert len(got) == 4 * len(want) and {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9 and len({r["identity_error"] for r in got}) == 1
    by = defaultdict(list)
    for r in got:
        by[r["vec_id"], r["component"]].append(r)
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-10)
    for i, dev, w in want:
        for c in range(4):
            for r in by[i, c + 1]:
                if i is not None and i < 900:
                    assert r["deviation"] == dev and abs(r["whitened"]) == pytest.approx(w[c], abs=1e-8)
    # one sign per component for all rows: the projection is linear
    signed = {r["vec_id"]: r["whitened"] for r in got if r["component"] == 2}
    ref = {i: w for i, _, w in want}
    assert abs(np.corrcoef([abs(signed[i]) for i in range(300)], [ref[i][1] for i in range(300)])[0, 1]) > 1 - 1e-9
    assert abs(sum(signed[i] for i in range(300))) < 40


def test_whitening_small_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert whiten(spark.createDataFrame([], kind)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).collect() == []   # no variance
    assert whiten(spark.createDataFrame([(1, None), (2, []), (3, [math.nan])], kind)).collect() == []
    got = whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])], kind)).collect()   # rank one
    assert {r["component"] for r in got} == {1} and sorted(round(abs(r["whitened"]), 9) for r in got) == [0, round(1.5 ** 0.5, 9), round(1.5 ** 0.5, 9)]
    assert sum(r["explained"] for r in got) == pytest.approx(3.0)
    wide = whiten(spark.createDataFrame([(i, [float(1 << 20 + i), float(i)]) for i in range(5)], kind)).collect()
    assert all(r["deviation"] is None or r["deviation"] >= 0 for r in wide)


def test_jacobi_davidson_pairs():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(200, 200)))
    for values in (np.linspace(1, 3, 200), np.r_[[5, 5, 5, 5, 5], np.ones(195)], np.r_[[1e6, 10, 9.99, 9.98], np.linspace(0, 9.9, 196)],
                   np.r_[[3.0, 2.0], np.zeros(198)], np.full(200, 2.0)):
        a = (q * values) @ q.T
        value, vec, residual = leading_pairs(lambda u, a=a: a @ u, 200, 4)
        top = np.sort(values)[::-1][:4]
        assert np.allclose(value, top, rtol=1e-12, atol=1e-12 * top[0])
        assert residual < 1e-13 and np.abs(vec.T @ vec - np.eye(4)).max() < 1e-12
        assert np.abs(a @ vec - vec * value).max() < 1e-12 * top[0]


def test_whitening_query(spark, small_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    n, want, share = _whitened(rows)
    got = queries.op13_whitening(spark, small_dir).collect()
    ref = {i: (dev, w) for i, dev, w in want}
    assert len(got) == 4 * len(want)
    for r in got:
        dev, w = ref[r["vec_id"]]
        assert r["n"] == n and r["deviation"] == dev and abs(r["whitened"]) == pytest.approx(w[r["component"] - 1], abs=1e-7)
        assert r["explained"] == pytest.approx(share[r["component"] - 1], rel=1e-9) and r["identity_error"] < 1e-9


def test_fit_reports_passes(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, rng.normal(size=20).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    m = fit_whitening(quantised(df, "embedding"))
    assert m.residual < 1e-13 and m.n == 400 and m.passes < 200


def test_mixing_query_rows(spark, small_dir):
    got = queries.op12_mixing(spark, small_dir)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    assert got.count() == docs.count()
    by = got.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("w"), F.max("size").alias("m")).collect()
    assert all(abs(r["t"] - r["w"]) <= r["m"] / 2 + 1e-6 for r in by)

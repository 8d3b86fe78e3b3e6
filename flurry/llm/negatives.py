"""Hard-negative mining by angular triangle filtering.

Every row stores its angles to a few reference directions. For two rows the
triangle inequality on the sphere turns the angles t, u to one reference into
an interval of their own angle, |t - u| .. min(t + u, 2 pi - t - u), and the
norms turn that into bounds of their inner product, widened beyond rounding.
Rows live in cells (nearest reference); a cell, and inside it a run of rows
ordered by angle, is scored in integers only where its bounds overlap the
score windows an anchor still needs. Each search runs twice: first in the
anchor's own cell, which raises the windows' lower ends, then in the cells
that still overlap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flurry.llm.whitening import quantised, stacked
from flurry.session import staged_table

REFERENCES = 32        # reference directions, so also cells
FIT_ROWS = 2048        # rows the references are chosen from
BLOCK_ROWS = 1 << 14   # rows of a cell that meet in one task
BLOCK_ANCHORS = 1 << 12
STRIP = 64             # anchors scored together
SLACK = 1e-6           # radians added to every angle bound: far above the rounding of arccos near 1
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95     # negative's score in percent of the positive's


def choose_references(x: np.ndarray, count: int) -> np.ndarray:
    """Unit directions far from each other among the rows of ``x`` (each the row farthest in angle from those before)."""
    norm = np.linalg.norm(x, axis=1)
    u = x[norm > 0] / norm[norm > 0, None]
    if not len(u):
        out = np.zeros((1, max(1, x.shape[1])))
        out[0, 0] = 1.0
        return out
    picked, near = [0], u @ u[0]
    while len(picked) < min(count, len(u)):
        far = int(np.argmin(near))
        if near[far] > 1 - 1e-9:
            break
        picked.append(far)
        near = np.maximum(near, u @ u[far])
    return u[picked]


def _described(rows: DataFrame, refs: np.ndarray, dim: int) -> DataFrame:
    """Adds ``norm``, ``angles`` (to every reference), ``cell`` (the nearest) to rows with ``x``."""
    kind = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = stacked(b.column(b.schema.get_field_index("x")), dim).astype(np.float64)
            norm = np.linalg.norm(x, axis=1)
            angle = np.arccos(np.clip(x @ refs.T / np.where(norm > 0, norm, 1)[:, None], -1, 1))
            n, r = angle.shape
            angles = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * r), pa.array(angle.ravel()))
            cell = pa.array(angle.argmin(1).astype(np.int32)) if n else pa.array([], pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(norm), angles, cell], [*b.schema.names, "norm", "angles", "cell"])

    return rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kind) + ", norm double, angles array<double>, cell int")


class Cells:
    """Per cell: rows, range of norms, and of the angles to every reference (references x references numbers in all)."""

    def __init__(self, rows: DataFrame, count: int):
        each = [f(F.col("angles")[r]).alias(f"{n}{r}") for r in range(count) for n, f in (("a", F.min), ("z", F.max))]
        got = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("norm").alias("lo"), F.max("norm").alias("hi"), *each).collect()
        got = sorted(got, key=lambda r: r["cell"])
        self.cell = np.array([r["cell"] for r in got], np.int64)
        self.rows = np.array([r["n"] for r in got], np.int64)
        self.norm = np.array([[r["lo"], r["hi"]] for r in got], float).reshape(-1, 2)
        self.first = np.array([[r[f"a{i}"] for i in range(count)] for r in got], float).reshape(-1, count)
        self.last = np.array([[r[f"z{i}"] for i in range(count)] for r in got], float).reshape(-1, count)

    def bounds(self, norm: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper score of each anchor with any row of each cell (anchors x cells)."""
        t = angles[:, None, :]
        near = np.maximum(np.maximum(self.first - t, t - self.last), 0).max(2)
        far = np.minimum(t + self.last, 2 * math.pi - t - self.first).min(2)
        return score_bounds(norm[:, None], self.norm[:, 0], self.norm[:, 1], near, far)


def score_bounds(norm, lo, hi, near, far):
    """Scores possible for an angle in [near, far] and a partner's norm in [lo, hi], widened beyond rounding."""
    top, low = np.cos(np.maximum(near - SLACK, 0)), np.cos(np.minimum(far + SLACK, math.pi))
    up = norm * np.where(top >= 0, hi, lo) * top
    down = norm * np.where(low >= 0, lo, hi) * low
    slack = 1e-9 * norm * hi + 1e-6
    return down - slack, up + slack


def _routes(anchors: DataFrame, cells: Cells, home: bool) -> DataFrame:
    """Anchors with the cells they have to visit: their own one, or the others whose bounds overlap a window."""
    keep = [f for f in anchors.schema.fields if f.name != "angles"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                col = {f: part.column(i) for i, f in enumerate(part.schema.names)}
                own = col["cell"].to_numpy()[:, None] == cells.cell
                if home:
                    go = own
                else:
                    norm, angles = col["norm"].to_numpy(), np.stack(col["angles"].to_numpy(zero_copy_only=False))
                    down, up = cells.bounds(norm, angles)
                    go = np.zeros_like(own)
                    wins = col["windows"].to_pylist()
                    for i, ws in enumerate(wins):
                        for w in ws:
                            go[i] |= (up[i] >= w["lo"]) & (down[i] <= w["hi"])
                    go &= ~own
                row, cell = np.nonzero(go)
                to = cells.cell[cell]
                theta = np.array([a[c] for a, c in zip(col["angles"].take(pa.array(row)).to_numpy(zero_copy_only=False), to)], float)
                pick = pa.array(row)
                yield pa.RecordBatch.from_arrays([*[col[f.name].take(pick) for f in keep], pa.array(to.astype(np.int32)), pa.array(theta)],
                                                 [*[f.name for f in keep], "to", "theta"])

    return anchors.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keep) + ", to int, theta double")


def _exact_scores(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Integer inner products: by doubles where every partial sum is below 2**53, else by 64-bit integers."""
    if x.size and a.size and float(np.abs(x).max()) * float(np.abs(a).max()) * x.shape[1] < 2.0 ** 53:
        return (x.astype(np.float64) @ a.T.astype(np.float64)).astype(np.int64)
    return x @ a.T


LEAST = np.iinfo(np.int64).min


def _scorer(k: int, same_label: bool, dim: int):
    """One block of anchors against one block of rows of one cell: the first ``k`` rows of each window."""
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[pd.DataFrame] = []
        if anchors.num_rows and rows.num_rows:
            order = np.argsort(rows.column("theta").to_numpy(), kind="stable")
            rows = rows.take(pa.array(order))
            theta, norm, label = (rows.column(c).to_numpy() for c in ("theta", "norm", "label"))
            vid, rid = rows.column("vec_id").to_numpy(), rows.column("rid").to_numpy()
            last = rows.column("vec_id").is_null().to_numpy()
            vid = np.where(last, np.iinfo(np.int64).max, vid).astype(np.int64)
            x, lo, hi = stacked(rows.column("x"), dim), norm.min(), norm.max()
            place = np.empty(len(vid), np.int64)   # rank of a row by id, for ties
            place[np.lexsort((rid, vid, last))] = np.arange(len(vid))
            anchors = anchors.take(pa.array(np.argsort(anchors.column("theta").to_numpy(), kind="stable")))
            for at in range(0, anchors.num_rows, STRIP):
                out += _strip(anchors.slice(at, STRIP), k, same_label, dim, x, theta, label, vid, rid, place, lo, hi)
        if not out:
            return pa.table({c: pa.array([], t) for c, t in (("aid", pa.int64()), ("w", pa.int32()), ("rid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()))})
        got = pd.concat(out, ignore_index=True)
        return pa.table({"aid": pa.array(got["aid"], pa.int64()), "w": pa.array(got["w"], pa.int32()), "rid": pa.array(got["rid"], pa.int64()),
                         "vec_id": pa.array(got["vec_id"], pa.int64()), "score": pa.array(got["score"], pa.int64())})
    return run


def _strip(anchors, k, same_label, dim, x, theta, label, vid, rid, place, lo, hi) -> list[pd.DataFrame]:
    t, norm, of = (anchors.column(c).to_numpy() for c in ("theta", "norm", "label"))
    aid, own = anchors.column("aid").to_numpy(), anchors.column("own").to_numpy()
    wins = anchors.column("windows").to_pylist()
    least = np.array([min((w["lo"] for w in ws), default=0) for ws in wins], float)
    most = np.array([max((w["hi"] for w in ws), default=-1) for ws in wins], float)
    # angles to the cell's reference at which a row's bounds can overlap the windows
    slack = 1e-9 * norm * hi + 1e-6
    reach = np.full(len(t), math.pi)
    tight = (least > slack) & (norm * hi > 0)
    reach[tight] = np.arccos(np.clip((least - slack)[tight] / (norm * hi)[tight], -1, 1)) + 2 * SLACK
    none = tight & (least - slack > norm * hi)
    over = np.zeros(len(t))  # rows so near both that even the lower bound is above the windows
    sure = (most + slack > 0) & (norm * lo > most + slack)
    over[sure] = np.arccos((most + slack)[sure] / (norm * lo)[sure]) - 2 * SLACK
    begin = np.searchsorted(theta, np.maximum(t - reach, np.where(sure, over - t, -1.0)), "left")
    end = np.where(none, begin, np.searchsorted(theta, t + reach, "right"))
    go = np.flatnonzero(end > begin)
    if not len(go):
        return []
    s, e = begin[go].min(), end[go].max()
    a = stacked(anchors.column("x").take(pa.array(go)), dim)
    score = _exact_scores(x[s:e], a)                      # rows x anchors
    fits = (label[s:e, None] == of[go]) == same_label
    fits &= vid[s:e, None] != own[go]
    score = np.where(fits, score, LEAST)
    depth = max(len(wins[i]) for i in go)
    out = []
    for w in range(depth):
        low = np.array([wins[i][w]["lo"] if w < len(wins[i]) else 1 for i in go], np.int64)
        high = np.array([wins[i][w]["hi"] if w < len(wins[i]) else 0 for i in go], np.int64)
        inside = np.where((score >= low) & (score <= high), score, LEAST)
        if len(inside) > k:
            inside = np.where(inside >= np.partition(inside, len(inside) - k, axis=0)[len(inside) - k], inside, LEAST)
        r, j = np.nonzero(inside != LEAST)
        if not len(r):
            continue
        v = inside[r, j]
        order = np.lexsort((place[s:e][r], -v, j))
        r, j, v = r[order], j[order], v[order]
        first = np.searchsorted(j, j)
        top = np.arange(len(j)) - first < k
        r, j, v = r[top], j[top], v[top]
        out.append(pd.DataFrame({"aid": aid[go[j]], "w": np.int32(w), "rid": rid[s:e][r], "vec_id": vid[s:e][r], "score": v}))
    return out


def _search(anchors: DataFrame, rows: DataFrame, cells: Cells, k: int, same_label: bool, home: bool, dim: int,
            block_rows: int, block_anchors: int) -> DataFrame:
    """The first ``k`` rows of every window within the visited cells, per block; ``aid, w, rid, vec_id, score``."""
    routed = staged_table(_routes(anchors, cells, home), "negative-routes")
    n = {r["to"]: r["n"] for r in routed.groupBy("to").agg(F.count(F.lit(1)).alias("n")).collect()}  # one number a cell
    sub = {int(c): math.ceil(int(m) / block_rows) for c, m in zip(cells.cell, cells.rows)}
    part = {c: math.ceil(m / block_anchors) for c, m in n.items()}
    if not n:
        return routed.select("aid", F.lit(0).alias("w"), F.lit(0).cast("long").alias("rid"), "own", F.lit(0).cast("long").alias("score")).toDF(
            "aid", "w", "rid", "vec_id", "score").limit(0)

    def per_cell(counts: dict, col: str):
        return F.element_at(F.create_map(*[F.lit(v) for c in sorted(counts) for v in (c, counts[c])]), F.col(col))

    visits = (routed.withColumn("p", F.pmod(F.xxhash64("aid"), per_cell(part, "to").cast("long")).cast("int"))
              .withColumn("b", F.explode(F.sequence(F.lit(0), per_cell(sub, "to") - 1))))
    held = (rows.filter(F.col("cell").isin([int(c) for c in n])).select(
                F.col("cell").alias("to"), F.col("angles")[F.col("cell")].alias("theta"), "norm", "label", "vec_id", "rid", "x")
            .withColumn("b", F.pmod(F.xxhash64("rid"), per_cell(sub, "to").cast("long")).cast("int"))
            .withColumn("p", F.explode(F.sequence(F.lit(0), per_cell(part, "to") - 1))))
    return (visits.groupBy("to", "b", "p").cogroup(held.groupBy("to", "b", "p"))
            .applyInArrow(_scorer(k, same_label, dim), "aid long, w int, rid long, vec_id long, score long"))


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of every (anchor, window), with ``rank``."""
    by = Window.partitionBy("aid", "w").orderBy(F.col("score").desc(), "vec_id", "rid")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def _two_rounds(anchors: DataFrame, rows: DataFrame, cells: Cells, k: int, same_label: bool, dim: int,
                block_rows: int, block_anchors: int) -> DataFrame:
    """Home cell first; what it finds raises the windows' lower ends for the other cells."""
    args = (cells, k, same_label)
    near = staged_table(_search(anchors, rows, *args, True, dim, block_rows, block_anchors), "negative-home")
    kth = (_first(near, k).filter(F.col("rank") == k).groupBy("aid")
           .agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("kth")))  # one entry a window
    raised = anchors.join(kth, "aid", "left").withColumn("windows", F.transform("windows", lambda w, i: F.struct(
        F.greatest(w["lo"], F.coalesce(F.try_element_at("kth", i), w["lo"])).alias("lo"), w["hi"].alias("hi")))).drop("kth")
    far = _search(raised, rows, *args, False, dim, block_rows, block_anchors)
    return staged_table(_first(near.unionByName(far), k), "negative-found")


def mine_hard_negatives(rows: DataFrame, anchors: str = "vec_id % 50 = 0", positives: int = POSITIVES,
                        negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, references: int = REFERENCES,
                        fit_rows: int = FIT_ROWS, block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """``rows``: ``vec_id`` (long), ``label``, ``x`` (long components, see ``quantised``).
    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are integer inner products, higher first, ties by smaller id. For
    each anchor (rows for which the expression ``anchors`` holds) and each of
    its first ``positives`` other rows of the same label: the first
    ``negatives`` rows of other labels with ``low * p <= 100 * s <= high * p``.
    The result is exact; the filter only skips rows whose bounds miss every
    window. The references are chosen from at most ``fit_rows`` rows (a hash
    order); every row is indexed and their choice does not change the result.

    Rows with a null label or vector take no part, and other columns are not
    read. "Other rows" have another id: rows that share the anchor's id are not
    its partners. A null id is no anchor and sorts last. Repeated rows are
    searched like different ones, repeated anchors give their rows each.
    Shorter vectors count as filled up with zeros; scores are 64-bit. Anchors
    without positives, positives without negatives and empty tables give no rows.
    """
    rows = rows.filter("label is not null and x is not null")
    rows = staged_table(rows.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long"), "label", "x",
                                    F.coalesce(F.expr(anchors), F.lit(False)).alias("anchor")), "negative-rows")
    dim = max(1, rows.agg(F.max(F.size("x"))).first()[0] or 1)
    sample = rows.select("x", F.xxhash64("x").alias("h")).distinct().orderBy("h", "x").limit(fit_rows).toArrow()
    refs = choose_references(stacked(sample.column("x"), dim).astype(np.float64), references)
    rows = staged_table(_described(rows, refs, dim), "negative-angles")
    cells = Cells(rows, len(refs))
    asked = rows.filter("anchor").select(F.col("rid").alias("aid"), F.col("vec_id").alias("own"), "label", "x", "norm", "angles", "cell")
    every = F.struct(F.lit(LEAST + 1).cast("long").alias("lo"), F.lit(-(LEAST + 1)).cast("long").alias("hi"))
    pos = _two_rounds(asked.withColumn("windows", F.array(every)), rows, cells, positives, True, dim, block_rows, block_anchors)
    pos = pos.select("aid", F.col("rank").alias("p"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # windows of whole scores; window i belongs to positive i + 1
    lo, hi = F.expr(f"-((-{low} * positive_score) div 100 + if((-{low} * positive_score) % 100 < 0, -1, 0))"), F.expr(
        f"({high} * positive_score) div 100 + if(({high} * positive_score) % 100 < 0, -1, 0)")
    windows = pos.groupBy("aid").agg(F.array_sort(F.collect_list(F.struct("p", lo.alias("lo"), hi.alias("hi")))).alias("ws"))
    asked = asked.join(windows, "aid").withColumn("windows", F.transform("ws", lambda w: F.struct(w["lo"].alias("lo"), w["hi"].alias("hi")))).drop("ws")
    neg = _two_rounds(asked, rows, cells, negatives, False, dim, block_rows, block_anchors)
    neg = neg.select("aid", (F.col("w") + 1).alias("p"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    own = asked.select("aid", F.col("own").alias("anchor_id"))
    return (pos.join(neg, ["aid", "p"]).join(own, "aid")
            .select("anchor_id", "positive_id", F.col("rank").cast("int"), _id("negative_id"), "positive_score", "negative_score")
            .withColumn("positive_id", _id("positive_id")))


def _id(c: str):
    """Ids as they came in: null ids travel as the largest long."""
    return F.nullif(F.col(c), F.lit(np.iinfo(np.int64).max)).alias(c)


NEGATIVES_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
a AS (SELECT vec_id AS anchor_id, label, x FROM r WHERE vec_id % 50 = 0),
s AS (SELECT a.anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.x, r.x)::BIGINT AS score
      FROM a JOIN r ON r.vec_id <> a.anchor_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER w ::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3
"""

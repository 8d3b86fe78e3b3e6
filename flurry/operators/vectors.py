"""Vector similarity (K2-K5, K7, M7).

Exact k-nearest neighbours by squared L2 (``knn``), without a cross join:
base rows belong to the cell of their nearest pivot (a Voronoi partition, as
in kNN joins with pivots). Every query first searches its own cell; the
distance of its k-th neighbour there, with the triangle inequality, rules out
cells, and inside a visited cell rows by their distance to the pivot.
Neighbouring cells are searched together: a query is sent once to a block of
cells, and a block once to a part of its queries, in ``cogroup`` tasks of
bounded size that emit only what can still be among each query's k best.

Distances: candidates are chosen with the ||a||² + ||b||² - 2a·b form and
re-scored as the sum of squared differences in float64, so exact
duplicates come out at 0. Order is (distance, id).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window
from pyspark.ml.functions import vector_to_array

from flurry.session import cut_lineage

SAMPLE_ROWS = 4096   # rows the pivots are chosen from
MAX_PIVOTS = 256
TILE_BYTES = 1 << 24  # most a task holds of one side's vectors, as doubles
STRIP = 256          # queries scored together
SLICE = 2048         # base rows scored together
ROUTES = 1 << 15     # routes of queries to cells handled together


def _score(found: tuple, kth: np.ndarray, Q: np.ndarray, who: np.ndarray, own: np.ndarray, B: np.ndarray, at: int,
           code: np.ndarray, k: int, allowed=None) -> tuple:
    """``found`` (query row, block row, distance: the best k of each query so far) after the rows ``B`` (the block's
    from ``at`` on) met the queries ``Q`` (rows ``who`` of the strip). ``kth``: the strip's k-th distances, lowered in place.

    ``code``: order of the block's rows by id (ties), ``own``: the strip's own codes among them, or -1. Rows of Q and B
    are (-2q, ||q||², 1) and (b, 1, ||b||²), so their product ranks the rows; every candidate within rounding distance
    of the k-th value is re-scored exactly and ordered by (distance, id). Keeping the whole tolerance band means exact
    ties -- duplicates -- are all compared. ``allowed``: which (query row, block row) may meet.
    """
    approx = Q @ B.T
    tol = 1e-9 * (Q[:, -2] + B[:, -1].max()) + 1e-12
    limit = kth[who] + tol
    near = approx <= limit[:, None]
    if np.count_nonzero(near) > near.size // 16:   # no bound yet, or a loose one: the slice's own k-th value
        if allowed is not None:
            approx[~allowed(who[:, None], np.arange(at, at + len(B))[None, :])] = np.inf
        kk = min(k + int((own >= 0).any()), len(B))
        limit = np.minimum(limit, np.partition(approx, kk - 1, axis=1)[:, kk - 1] + tol)
        near = approx <= limit[:, None]
    row, c = np.nonzero(near)
    r, b = who[row], c + at
    ok = code[b] != own[r]
    if allowed is not None:
        ok &= allowed(r, b)
    row, c, r, b = row[ok], c[ok], r[ok], b[ok]
    if not len(r):
        return found
    d = np.empty(len(r))
    for cut in range(0, len(r), 65536):
        part = slice(cut, cut + 65536)
        diff = Q[row[part], :-2] / -2 - B[c[part], :-2]
        d[part] = (diff * diff).sum(axis=1)
    r, b, d = (np.concatenate(x) for x in zip(found, (r, b, d)))
    order = np.lexsort((code[b], d, r))
    r, b, d = r[order], b[order], d[order]
    top = np.arange(len(r)) - np.searchsorted(r, r) < k
    r, b, d = r[top], b[top], d[top]
    n = np.bincount(r, minlength=len(kth))
    full = np.flatnonzero(n == k)
    kth[full] = np.minimum(kth[full], d[np.cumsum(n)[full] - 1])
    return r, b, d


def _codes(qid: np.ndarray, bid: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids as numbers in id order: (codes of the queries or -1, codes of the block rows)."""
    values, codes = np.unique(bid, return_inverse=True)
    if not same:
        return np.full(len(qid), -1), codes
    at = np.minimum(np.searchsorted(values, qid), len(values) - 1)
    return np.where(values[at] == qid, at, -1), codes


def _lists(col: pa.ChunkedArray, kind=np.float64) -> np.ndarray:
    """A list column as a matrix."""
    col = col.combine_chunks()
    size = pc.min_max(pc.list_value_length(col)).as_py()
    if size["min"] != size["max"]:
        raise ValueError("vectors of different lengths")
    return col.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(col), size["max"])


def _few_copies(B: np.ndarray, code: np.ndarray, most: int) -> np.ndarray:
    """Rows to search: of equal vectors only the first ``most`` by id can be among a query's best."""
    _, same = np.unique(B.view(np.dtype((np.void, B.shape[1] * 8))).ravel(), return_inverse=True)
    order = np.lexsort((code, same))
    same = same[order]
    return order[np.arange(len(order)) - np.searchsorted(same, same) < most]


def _fits(low: np.ndarray, high: np.ndarray, numbers: np.ndarray):
    """Which (query row, block row) agree in a column: a number in the query's range."""
    def of(r: np.ndarray, c: np.ndarray) -> np.ndarray:
        ok = False
        for t in range(numbers.shape[1]):
            x = numbers[c, t]
            ok = ok | ((low[r, t] <= x) & (x <= high[r, t]))
        return ok
    return of


def _least(ds: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray, between: np.ndarray) -> np.ndarray:
    """Least distance of queries to the rows of cells. ``ds``, ``own``: distance to the cell's and to the own pivot,
    ``between``: from pivot to pivot, ``low``, ``high``: reach of the cells."""
    least = np.maximum(ds - high, low - ds)
    with np.errstate(divide="ignore", invalid="ignore"):   # beyond the plane between both pivots
        plane = np.where(between > 0, (ds ** 2 - own ** 2) / (2 * between), 0.0)
    return np.maximum(least, plane) - 1e-9 * (1 + ds)


def _block_topk(k: int, exclude_self: bool = False, pivots: np.ndarray | None = None, cells: dict | None = None):
    """cogroup body: top-k of each query against one block, all in slices of bounded size.

    Columns restrict what meets, if present: ``reach`` (the query's k-th distance so far) and ``d`` (distance to the
    pivot) of rows of one cell; with ``pivots`` and ``cells`` the block holds rows of several cells (``cell``), and a
    query searches those that may hold a nearer row, without its own (``home``, ``d``). ``low``, ``high`` and ``hs``:
    ranges of a query and numbers of a base row, one of which must fit.
    """
    def fn(key, q: pa.Table, b: pa.Table) -> pa.Table:
        ids, taken = (q["id"].combine_chunks(), b["id"].combine_chunks()), ([], [], [])
        if q.num_rows and b.num_rows:
            windows = "reach" in q.column_names
            B = _lists(b["v"])
            own, code = _codes(*(c.to_numpy(zero_copy_only=False) for c in ids), exclude_self)
            use = _few_copies(B, code, k + int(np.bincount(code).max()) * exclude_self)
            if windows:
                at = b["cell"].to_numpy()[use] if pivots is not None else np.zeros(len(use), int)
                d = b["d"].to_numpy()[use]
                order = np.lexsort((d, at))
                use, at, d = use[order], at[order], d[order]
                home, near, reach = (q[c].to_numpy() if c in q.column_names else None for c in ("home", "d", "reach"))
            else:
                at = np.zeros(len(use), int)
            head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            parts = list(zip(at[head].tolist(), head.tolist(), np.append(head[1:], len(at)).tolist()))
            B, code = np.hstack([B[use], np.ones((len(use), 1)), (B * B).sum(axis=1)[use, None]]), code[use]
            Q = _lists(q["v"])
            several = "hs" in b.column_names
            if several:
                low, high, hs = (_lists(t[c], np.int64) for t, c in ((q, "low"), (q, "high"), (b, "hs")))
                hs = hs[use]
            turn = np.lexsort((near, home)) if windows and home is not None else np.argsort(near) if windows else np.arange(len(Q))
            for cut in range(0, len(turn), STRIP):
                mine = turn[cut:cut + STRIP]
                x = Q[mine]
                qx = np.hstack([-2 * x, (x * x).sum(axis=1)[:, None], np.ones((len(x), 1))])
                kth = np.full(len(x), np.inf)
                if windows:
                    kth = (reach[mine] * (1 + 1e-9)) ** 2
                allowed = _fits(low[mine], high[mine], hs) if several else None
                found = (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
                for cell, lo, hi in parts:
                    who = np.arange(len(x))
                    if windows:  # | |q - p| - |x - p| | <= |q - x|
                        to, r = near[mine], np.sqrt(kth) * (1 + 1e-9)
                        if pivots is not None:
                            to = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
                            between = np.sqrt(((pivots[home[mine]] - pivots[cell]) ** 2).sum(axis=1))
                            who = np.flatnonzero((_least(to, near[mine], *cells[cell][1:], between) <= r) & (home[mine] != cell))
                            if not len(who):
                                continue
                        r = r + 1e-9 * (1 + to)
                        have = d[lo:hi]
                        lo, hi = lo + np.searchsorted(have, (to - r)[who].min()), lo + np.searchsorted(have, (to + r)[who].max(), "right")
                    if hi > lo:
                        ends = np.linspace(lo, hi, -(-(hi - lo) // SLICE) + 1).astype(int)
                        for a, z in zip(ends[:-1], ends[1:]):
                            found = _score(found, kth, qx if len(who) == len(x) else qx[who], who, own[mine], B[a:z], a, code, k, allowed)
                for out, v in zip(taken, (mine[found[0]], use[found[1]], found[2])):
                    out.append(v)
        r, c, dist = (np.concatenate([np.zeros(0, kind), *v]) for kind, v in zip((int, int, float), taken))
        return pa.table({"q": ids[0].take(pa.array(r)), "b": ids[1].take(pa.array(c)), "dist": dist})
    return fn


def _pair_schema(q: DataFrame, b: DataFrame) -> str:
    return f"q {q.schema['id'].dataType.simpleString()}, b {b.schema['id'].dataType.simpleString()}, dist double"


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy("dist", "b")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def choose_pivots(x: np.ndarray, count: int, rounds: int = 5) -> np.ndarray:
    """``count`` centres of the sample ``x``: the farthest rows in turn, then a few means of their cells."""
    picked, near = [0], ((x - x[0]) ** 2).sum(1)
    while len(picked) < min(count, len(x)) and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[picked[-1]]) ** 2).sum(1))
    p = x[picked]
    for _ in range(rounds):
        cell = (((p * p).sum(1)[None, :]) - 2 * x @ p.T).argmin(1)
        n = np.bincount(cell, minlength=len(p))
        total = np.zeros_like(p)
        np.add.at(total, cell, x)
        p = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], p)
    return p


def _distances(pdf: pd.DataFrame, pivots: np.ndarray) -> np.ndarray:
    """Distance of every row to every pivot."""
    x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
    d = np.empty((len(x), len(pivots)))
    for j, p in enumerate(pivots):
        d[:, j] = np.sqrt(((x - p) ** 2).sum(1))
    return d


def _to_pivots(df: DataFrame, pivots: np.ndarray, every: bool) -> DataFrame:
    """``id, v, cell, d`` (nearest pivot and the distance to it), with ``ds`` (to every pivot) if asked."""
    step = max(1, ROUTES // len(pivots))

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), step):
                part = pdf.iloc[at:at + step]
                d = _distances(part, pivots)
                cell = d.argmin(1)
                out = part.assign(cell=cell.astype(np.int32), d=d[np.arange(len(part)), cell])
                yield out.assign(ds=list(d)) if every else out
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(run, kinds + ", cell int, d double" + (", ds array<double>" if every else ""))


def _routes(pdf: pd.DataFrame, order: list, low: np.ndarray, high: np.ndarray, mid: np.ndarray) -> pd.DataFrame:
    """Routes of a few queries as ``row, to, d``, by row; ``low``, ``high`` and ``mid``: reach of the cells in ``order``,
    their distance to every pivot."""
    ds = np.stack(pdf["ds"].to_numpy())[:, order]
    home, own = pdf["cell"].to_numpy(), pdf["d"].to_numpy()[:, None]
    r = pdf["reach"].to_numpy(dtype=float, na_value=np.inf)[:, None]
    go = (_least(ds, own, low, high, mid[:, home].T) <= r) & (np.array(order)[None, :] != home[:, None])
    row, to = np.nonzero(go)
    return pd.DataFrame({"row": row, "to": np.array(order, np.int32)[to], "d": ds[row, to]})


def far_routes(queries: DataFrame, cells: dict, reach: DataFrame, pivots: np.ndarray, block: dict | None = None) -> DataFrame:
    """``id, v, to, d, reach`` for every cell that may hold a nearer row than the query's k-th so far
    (``reach``: id, reach; none: every cell). ``cells``: cell -> (rows, least and largest distance to the pivot).
    A query leaves Python once, with the list of its cells; the rows per cell are made of it in Spark.

    With ``block`` (cell -> block) a row per block that holds such a cell, with the query's own cell ``home`` and its
    distance ``d`` to the pivot there."""
    order = sorted(cells)
    low, high = (np.array([cells[c][i] for c in order]) for i in (1, 2))
    mid = np.sqrt(((pivots[order][:, None, :] - pivots[None]) ** 2).sum(2))   # between pivots
    step = max(1, ROUTES // max(1, len(pivots)))

    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), step):
                part = pdf.iloc[at:at + step]
                if "ds" not in part:
                    part = part.assign(ds=list(_distances(part, pivots)))
                found = _routes(part, order, low, high, mid)
                if block is not None:
                    found = found.assign(to=found["to"].map(block).astype(np.int32)).drop_duplicates(["row", "to"])
                ends = np.searchsorted(found["row"], np.arange(1, len(part)))
                lists = {c: np.fromiter(np.split(found[c].to_numpy(), ends), object, len(part)) for c in ("to", "d")}
                yield (part[["id", "v", "reach"]].assign(**lists) if block is None else
                       part[["id", "v", "reach", "cell", "d"]].assign(to=lists["to"]))
    kinds = {f.name: f.dataType.simpleString() for f in queries.schema}
    have = f"id {kinds['id']}, v {kinds['v']}, reach double, "
    listed = queries.join(reach, "id", "left").mapInPandas(
        run, have + ("to array<int>, d array<double>" if block is None else "cell int, d double, to array<int>"))
    reached = F.coalesce("reach", F.lit(float("inf"))).alias("reach")
    if block is not None:
        return listed.select("id", "v", F.col("cell").alias("home"), "d", F.explode("to").alias("to"), reached)
    return (listed.withColumn("go", F.explode(F.arrays_zip("to", "d")))
            .select("id", "v", F.col("go.to").alias("to"), F.col("go.d").alias("d"), reached))


def _tile_rows(n: int, dim: int, block_rows: int, spark) -> int:
    """Rows of each side that meet in one task: vectors move once per tile, so as many as ``TILE_BYTES`` holds,
    but tiles for every core."""
    share = math.ceil(n / math.ceil(math.sqrt(8 * spark.sparkContext.defaultParallelism)))
    return min(max(share, block_rows), max(TILE_BYTES // (8 * max(dim, 1)), SLICE))


def _blocks_of(cells: dict, pivots: np.ndarray, rows: int) -> dict:
    """cell -> block: neighbouring cells together, at most ``rows`` rows (a larger cell is a block of its own)."""
    left, at, block, held, out = set(cells), min(cells), 0, 0, {}
    while left:
        if held and held + cells[at][0] > rows:
            block, held = block + 1, 0
        out[at], held = block, held + cells[at][0]
        left.discard(at)
        at = min(left, key=lambda c: (((pivots[c] - pivots[at]) ** 2).sum(), c), default=at)
    return out


def _visit(routes: DataFrame, base: DataFrame, cells: dict, k: int, rows: int, exclude_self: bool,
           block: dict | None = None, pivots: np.ndarray | None = None) -> DataFrame:
    """Queries against the cells they are routed to (``to``), or with ``block`` (cell -> block) against the blocks,
    in tiles of at most ``rows`` rows of each side."""
    visits = {r["to"]: r["n"] for r in routes.groupBy("to").agg(F.count(F.lit(1)).alias("n")).collect()}  # a number a block
    if not visits:
        return base.sparkSession.createDataFrame([], _pair_schema(routes, base))

    def of(counts: dict, col: str):
        return F.element_at(F.create_map(*[F.lit(x) for c in sorted(counts) for x in (c, counts[c])]), F.col(col))

    size = {}
    for c, (n, _, _) in cells.items():
        size[c if block is None else block[c]] = size.get(c if block is None else block[c], 0) + n
    sub = {c: math.ceil(n / rows) for c, n in size.items()}
    part = {c: math.ceil(n / rows) for c, n in visits.items()}
    q = routes.withColumn("p", F.pmod(F.xxhash64("id"), of(part, "to").cast("long")).cast("int")).withColumn(
        "s", F.explode(F.sequence(F.lit(0), of(sub, "to") - 1)))
    b = base.withColumn("to", F.col("cell") if block is None else of(block, "cell"))
    b = (b.where(F.col("to").isin(sorted(visits)))
         .withColumn("s", F.pmod(F.xxhash64("id"), of(sub, "to").cast("long")).cast("int"))
         .withColumn("p", F.explode(F.sequence(F.lit(0), of(part, "to") - 1))))
    return q.groupBy("to", "s", "p").cogroup(b.groupBy("to", "s", "p")).applyInArrow(
        _block_topk(k, exclude_self, pivots, cells), _pair_schema(q, b))


def knn(queries: DataFrame, base: DataFrame, k: int, q_id: str = "vec_id", b_id: str = "vec_id",
        q_vec: str = "embedding", b_vec: str = "embedding", block_rows: int = 2048,
        exclude_self: bool = False, pivots: int | None = None) -> DataFrame:
    """Exact top-k neighbours of each query in ``base`` (K2).

    Returns ``(q, b, dist, rank)`` with ids of any type: ``dist`` is the
    squared L2 distance, ``rank`` 1..k in (dist, b) order. ``exclude_self``
    drops b == q. Ids must be unique on each side; rows with a null vector take
    no part.

    ``pivots`` (one per ``block_rows`` base rows unless given, at most
    ``MAX_PIVOTS``) come from a hash sample of at most ``SAMPLE_ROWS`` base
    rows; they decide how much work is skipped, not the result. The driver holds
    the pivots and three numbers a cell.
    """
    q = queries.select(F.col(q_id).alias("id"), F.col(q_vec).alias("v")).where("v is not null")
    b = base.select(F.col(b_id).alias("id"), F.col(b_vec).alias("v")).where("v is not null")
    n = b.count()
    count = min(MAX_PIVOTS, pivots or math.ceil(n / block_rows))
    if count <= 1:
        whole = {0: (max(n, 1), 0.0, 0.0)}
        return _ranked(_visit(q.withColumn("to", F.lit(0)), b.withColumn("cell", F.lit(0)), whole, k, block_rows, exclude_self), k)
    sample = b.select("v").orderBy(F.xxhash64("v")).limit(SAMPLE_ROWS).toPandas()["v"]
    centres = choose_pivots(np.stack(sample.to_numpy()).astype(np.float64), count)
    rows = _tile_rows(n, centres.shape[1], block_rows, b.sparkSession)
    b = cut_lineage(_to_pivots(b, centres, False))
    q = cut_lineage(_to_pivots(q, centres, False))
    cells = {r["cell"]: (r["n"], r["lo"], r["hi"]) for r in b.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi")).collect()}
    far = F.lit(float("inf"))
    home = cut_lineage(_ranked(_visit(q.select("id", "v", F.col("cell").alias("to"), "d", far.alias("reach")),
                                      b, cells, k, rows, exclude_self), k))
    reach = home.where(F.col("rank") == k).select(F.col("q").alias("id"), F.sqrt("dist").alias("reach"))
    block = _blocks_of(cells, centres, rows)
    other = _visit(far_routes(q, cells, reach, centres, block), b, cells, k, rows, exclude_self, block, centres)
    return _ranked(home.drop("rank").unionByName(other), k)


def _grouped_knn(queries: DataFrame, base: DataFrame, k: int, block_rows: int, exclude_self: bool) -> DataFrame:
    """Top-k where a query only meets base rows of its own group (columns ``id, v, g``; e.g. a hash bucket).
    Each group is cut into blocks, so one that holds a third of the data is spread over many tasks. A query
    in several groups gets the best k over all of them."""
    def blocks(d, rows, n):
        return d.groupBy("g").agg(F.greatest(F.ceil(F.count(F.lit(1)) / rows), F.lit(1)).cast("long").alias(n))
    queries = queries.select(*[F.col(c).alias(c) for c in ("id", "v", "g")])  # both sides may be one table
    size = base.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")).first()
    rows = _tile_rows(size["n"], size["dim"] or 0, block_rows, base.sparkSession)
    # one row per group present on both sides
    gs = blocks(queries, rows, "_nq").join(blocks(base, rows, "_nb"), "g")
    qs, bs = queries.join(gs, "g"), base.join(gs, "g")
    zero = F.lit(0).cast("long")
    qs = qs.withColumn("qb", F.pmod(F.xxhash64("id"), F.col("_nq"))).withColumn("bb", F.explode(F.sequence(zero, F.col("_nb") - 1)))
    bs = bs.withColumn("bb", F.pmod(F.xxhash64("id"), F.col("_nb"))).withColumn("qb", F.explode(F.sequence(zero, F.col("_nq") - 1)))
    pairs = (qs.select("g", "qb", "bb", "id", "v").groupBy("g", "qb", "bb")
             .cogroup(bs.select("g", "qb", "bb", "id", "v").groupBy("g", "qb", "bb"))
             .applyInArrow(_block_topk(k, exclude_self), _pair_schema(qs, bs)))
    # the same pair may meet in several groups
    return _ranked(pairs.groupBy("q", "b").agg(F.min("dist").alias("dist")), k)


def most_similar(vectors: DataFrame, id_col: str = "vec_id", vec: str = "embedding",
                 block_rows: int = 2048) -> DataFrame:
    """Most similar other item of every item (K3): ``(index, L2,
    similar_index)``.

    Neighbours are searched in the whole set including the item itself, in
    (distance, id) order. The 2nd neighbour is taken when its distance is
    above 0, otherwise the 3rd, so a single exact duplicate is skipped; with
    two or more duplicates the answer is a duplicate at distance 0.
    """
    nn = knn(vectors, vectors, 3, id_col, id_col, vec, vec, block_rows)
    picked = nn.groupBy("q").agg(
        F.max(F.when(F.col("rank") == 2, F.struct("dist", "b"))).alias("r2"),
        F.max(F.when(F.col("rank") == 3, F.struct("dist", "b"))).alias("r3"))
    chosen = F.when(F.col("r2.dist") > 0, F.col("r2")).otherwise(F.coalesce(F.col("r3"), F.col("r2")))
    return picked.select(F.col("q").alias("index"), chosen.getField("dist").alias("L2"),
                         chosen.getField("b").alias("similar_index"))


def most_unique(vectors: DataFrame, n: int = 3, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """The ``n`` items farthest from their most similar item (K4)."""
    ms = most_similar(vectors, id_col, vec)
    return ms.orderBy(F.col("L2").desc(), F.col("index").asc()).limit(n)


def knn_predict(train: DataFrame, query: DataFrame, k: int, label: str = "label",
                id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """k-nearest-neighbour classifier (M7): majority label of the k nearest
    training rows, ties to the lowest label (labels of any ordered type);
    ``share`` is the winner's vote share. Output ``(id, pred, share)``."""
    nn = knn(query, train, k, id_col, id_col, vec, vec)
    lab = train.select(F.col(id_col).alias("b"), F.col(label).alias("_lab"))
    votes = nn.join(lab, "b").groupBy("q", "_lab").agg(F.count(F.lit(1)).alias("_v"))
    best = votes.groupBy("q").agg(F.min(F.struct((-F.col("_v")).alias("_less"), "_lab")).alias("w"))
    return best.select(F.col("q").alias(id_col), F.col("w._lab").alias("pred"),
                       (-F.col("w._less") / F.lit(float(k))).alias("share"))


def knn_approx(queries: DataFrame, base: DataFrame, k: int, threshold: float | None = None,
               id_col: str = "vec_id", vec: str = "embedding", bucket_length: float = 1.0,
               num_hash_tables: int = 3, seed: int = 42, block_rows: int = 2048, exclude_self: bool = False) -> DataFrame:
    """Approximate neighbours with random-projection LSH and several probes (K5).

    A table cuts one random direction into buckets. A query probes, in every
    table, its own bucket and as many to both sides as hold at least ``k``
    base rows together, so it always gets k neighbours (all rows, if the base
    has fewer). The probed buckets are searched block by block, so even a
    bucket holding a third of all rows is cut into bounded blocks.
    Where the probed buckets of all tables hold more rows than there are (wide
    buckets), each pair meets once instead, and counts if a table has the row
    in a probed bucket. ``threshold`` (plain L2) optionally drops farther
    candidates. Returns ``(q, b, dist, rank)``, ``dist`` squared, to compare
    with ``knn``.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    def prep(df):
        return df.select(F.col(id_col).alias("id"), F.col(vec).alias("v"),
                         array_to_vector(F.col(vec).cast("array<double>")).alias("features")).where("v is not null")
    q, b = prep(queries), prep(base)
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes",
                                      bucketLength=bucket_length, numHashTables=num_hash_tables,
                                      seed=seed).fit(b)

    def bucketed(df):
        h = lsh.transform(df).select("id", "v", F.posexplode("hashes").alias("t", "h"))
        return h.select("id", "v", "t", F.round(vector_to_array("h")[0]).cast("long").alias("h"))
    qh, bh = cut_lineage(bucketed(q).drop("v")), bucketed(b)
    sizes = cut_lineage(bh.groupBy("t", "h").agg(F.count(F.lit(1)).alias("n")))  # a row per bucket in use
    ends = sizes.groupBy("t").agg(F.min("h").alias("first"), F.max("h").alias("last"))
    need, open_, done, radius = k + int(exclude_self), qh.join(ends, "t"), None, 0
    while True:
        lo, hi = F.col("h") - radius, F.col("h") + radius
        probe = open_.select("id", "t", "h", "first", "last", F.explode(F.sequence(lo, hi)).alias("at"))
        have = probe.join(sizes.select("t", F.col("h").alias("at"), "n"), ["t", "at"], "left").groupBy("id", "t", "h", "first", "last").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
        every = (F.col("h") - radius <= F.col("first")) & (F.col("h") + radius >= F.col("last"))
        have = cut_lineage(have.withColumn("_enough", (F.col("n") >= need) | every))
        got = have.where("_enough").select("id", "t", lo.alias("low"), hi.alias("high"), "n")
        done = got if done is None else done.unionByName(got)
        open_ = have.where("not _enough").select("id", "t", "h", "first", "last")
        if open_.isEmpty():
            break
        radius = 2 * radius + 1
    held = sizes.where("t = 0").agg(F.sum("n")).first()[0] or 0
    met = done.agg(F.sum(F.col("n").cast("double")).alias("rows"), F.count_if(F.col("t") == 0).alias("queries")).first()
    if held > block_rows and met["rows"] >= held * met["queries"]:
        ranges = done.groupBy("id", "t").agg(F.min("low").alias("low"), F.max("high").alias("high")).groupBy("id").agg(
            F.sort_array(F.collect_list(F.struct("t", "low", "high"))).alias("r"))   # a struct a table
        asked = ranges.select("id", "r.low", "r.high").join(q.select("id", "v"), "id").withColumn("to", F.lit(0))
        numbers = F.array(*[F.round(vector_to_array(F.col("hashes")[t])[0]).cast("long") for t in range(num_hash_tables)])
        whole = lsh.transform(b).select("id", "v", numbers.alias("hs"), F.lit(0).alias("cell"))
        rows = _tile_rows(held, b.agg(F.max(F.size("v"))).first()[0], block_rows, b.sparkSession)
        pairs = _visit(asked, whole, {0: (held, 0.0, 0.0)}, k, rows, exclude_self)
        nn = _ranked(pairs.groupBy("q", "b").agg(F.min("dist").alias("dist")), k)
    else:
        g = F.xxhash64("t", "at").alias("g")
        probes = done.select("id", "t", F.explode(F.sequence("low", "high")).alias("at")).select("id", g).join(q.select("id", "v"), "id")
        nn = _grouped_knn(probes, bh.select("id", "v", F.xxhash64("t", "h").alias("g")), k, block_rows, exclude_self)
    if threshold is not None:
        nn = nn.where(F.col("dist") <= float(threshold) ** 2)
    return nn


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of exact (q, b) neighbour pairs the approximate search found."""
    hit = exact.join(approx.select("q", "b", F.lit(1).alias("_hit")), ["q", "b"], "left")
    return hit.agg(F.avg(F.coalesce("_hit", F.lit(0)).cast("double")).alias("recall"))


def embed(df: DataFrame, col: str, make_predict_fn, input_dim: int, batch_size: int = 64,
          out: str = "embedding") -> DataFrame:
    """Batch inference with a caller's model (K7): ``make_predict_fn`` is
    called once per Python worker and returns ``fn(np.ndarray[batch,
    input_dim]) -> np.ndarray[batch, k]``; rows travel in Arrow batches of
    ``batch_size``."""
    from pyspark.ml.functions import predict_batch_udf
    udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()),
                            batch_size=batch_size, input_tensor_shapes=[[input_dim]])
    return df.withColumn(out, udf(F.col(col)))

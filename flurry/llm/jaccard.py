"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Every document's distinct word shingles are put into one global order, rare
ones first. If two sets overlap in t shingles, their prefixes of |x| - t + m
shingles share at least m, for every m. Each document picks its own m by the
estimated number of candidates its prefix would meet: costly prefixes are
lengthened and need correspondingly more shared shingles before anything is
verified.

Equal sets are collapsed first. Then each shingle links its documents to its
first one and to their neighbour (no pairs within a group); verified links
are contracted to components, and only documents of different components that
still share enough prefix shingles are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flurry.llm import blocks as B
from flurry.llm.graph import components
from flurry.session import cut_lineage, release_shuffles, staged_table

WORDS = 5
PERCENT = 80           # Jaccard threshold in percent
MAX_MATCH = 4          # largest m a document may choose
SKETCH = 1 << 18       # counters of shingle frequencies (whole corpus)
CHUNKS = 64
FAN_IN = 256           # sketches summed in one task
VERIFY_COST = 20.0     # verifying a candidate, in prefix shingles
GROUP = 512            # documents compared with one centre in one task
HOT = 1 << 16          # documents of one shingle that are ordered in one task
DOC_BITS = 10          # documents of a block; the rest of a sort key is the shingle
_D = np.uint64(DOC_BITS)
_T = np.uint64(64 - DOC_BITS)


def token_sets(raw: np.ndarray, off: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle) of the distinct word n-grams of a block, both sorted.

    A text of fewer than n words is one shingle (the whole sequence); a text
    without words has none.
    """
    start, end, first = B.spans(raw, off, B.SPACE)
    words = B.bytes_hash(B.LOWER[raw], start, end)
    doc = B.text_of(first, len(words))
    h = B.grams(words, (n,))[n]
    at = np.flatnonzero(B.inside(first, n, len(words)))
    own, key = doc[at], h[at]
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        whole = [np.uint64(k) for k in count[short]]
        for i, d in enumerate(short):
            for w in words[first[d]:first[d + 1]]:
                whole[i] = np.uint64((int(whole[i]) * int(B.GRAM) + int(w)) & 0xFFFFFFFFFFFFFFFF)
        own, key = np.concatenate([own, short]), np.concatenate([key, B.mix(np.array(whole, np.uint64))])
    packed = np.unique((own.astype(np.uint64) << _T) | (key >> _D))
    return (packed >> _T).astype(np.int64), packed & ((np.uint64(1) << _T) - np.uint64(1))


def _source(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(B.NO_ID)).cast("long").alias("did"), F.col(text).alias("__text"))


def _profile(src: DataFrame, n: int) -> DataFrame:
    """One pass: size and signature of every set, and per task a frequency sketch in chunks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, seen = np.zeros(SKETCH, np.int64), 0
        for batch, raw, off in B.blocks(batches, "__text", rows=1 << DOC_BITS):
            doc, tok = token_sets(raw, off, n)
            sketch += np.bincount((tok & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            edge = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            a, b = (np.diff(B.running(x)[edge]).view(np.int64) for x in (B.mix(tok), B.mix(tok ^ B.GRAM)))
            k = batch.num_rows
            seen += k
            yield B.as_table(did=B.ids(batch, "did"), n=pa.array(np.diff(edge)), sa=pa.array(a), sb=pa.array(b),
                             chunk=pa.nulls(k, pa.int32()), cells=pa.nulls(k, pa.binary()))
        if seen:
            parts = [c.astype(np.uint64).tobytes() for c in np.split(sketch, CHUNKS)]
            none = pa.nulls(CHUNKS, pa.int64())
            yield B.as_table(did=none, n=none, sa=none, sb=none, chunk=pa.array(range(CHUNKS), pa.int32()),
                             cells=pa.array(parts, pa.binary()))

    return src.mapInArrow(run, "did long, n long, sa long, sb long, chunk int, cells binary")


def _sum_cells(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_py(), np.uint64) for c in table.column("cells"))
    return pa.table({"chunk": table.column("chunk").slice(0, 1), "cells": [total.tobytes()]},
                    schema=pa.schema([("chunk", pa.int32()), ("cells", pa.binary())]))


def _frequencies(profile: DataFrame) -> np.ndarray:
    """The corpus sketch (fixed size), summed in a tree of tasks; counts above the usual cell."""
    parts = profile.filter("chunk is not null").select("chunk", "cells")
    many = parts.count() // CHUNKS
    while many > 1:
        many = -(-many // FAN_IN)
        salt = F.pmod(F.xxhash64("cells"), F.lit(many))
        parts = cut_lineage(parts.groupBy("chunk", salt).applyInArrow(_sum_cells, "chunk int, cells binary"))
        if many > 1:
            many = parts.count() // CHUNKS
    rows = parts.collect()  # CHUNKS rows of fixed size
    if not rows:
        return np.ones(SKETCH)
    cells = np.concatenate([np.frombuffer(r[1], np.uint64) for r in sorted(rows)]).astype(np.float64)
    return np.maximum(1.0, cells - np.median(cells))


def _prefix_rows(src: DataFrame, freq, n: int, percent: int) -> DataFrame:
    """(tok, s, did, n, p, m, q): each document's prefix shingles with their position,
    its m, and how typical the document is (mean log frequency of its shingles).
    ``s`` deals the documents of a shingle estimated above ``HOT`` into parts; -1 for others.

    Documents of one block with equal sets are written once (the smallest id
    stands for them; they are in one class anyway).
    """
    hot = HOT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        est = freq.value
        parts = np.ceil(est / hot).astype(np.uint64)
        rank = np.floor(np.log2(est)).astype(np.uint64)
        for batch, raw, off in B.blocks(batches, "__text", rows=1 << DOC_BITS):
            doc, tok = token_sets(raw, off, n)
            if not len(tok):
                continue
            did = B.ids(batch, "did").to_numpy()
            cell = (tok & np.uint64(SKETCH - 1)).astype(np.int64)
            order = np.argsort((doc.astype(np.uint64) << np.uint64(48)) | (rank[cell] << np.uint64(42)) | (tok >> np.uint64(12)),
                               kind="stable")
            tok, cell = tok[order], cell[order]
            edge = np.searchsorted(doc, np.arange(len(did) + 1))
            size = np.diff(edge)
            pos = np.arange(len(tok)) - edge[doc]
            cost = np.concatenate([[0.0], np.cumsum(est[cell] - 1)])
            base = size - (percent * size + 99) // 100  # prefix length less m
            best, pick = np.full(len(did), np.inf), np.ones(len(did), np.int64)
            for m in range(1, MAX_MATCH + 1):
                upto = np.minimum(base + m, size)
                c = upto + VERIFY_COST * (cost[edge[:-1] + upto] - cost[edge[:-1]]) / m
                pick, best = np.where(c < best, m, pick), np.minimum(c, best)
            pick = np.minimum(pick, np.maximum(size - base, 1))
            sign = B.mix(np.diff(B.running(B.mix(tok))[edge])) + size.astype(np.uint64)
            by = np.lexsort((did, sign))
            one = np.zeros(len(did), bool)
            one[by[np.concatenate([[True], sign[by][1:] != sign[by][:-1]])]] = True
            level = np.concatenate([[0.0], np.cumsum(np.log2(est[cell]))])
            typical = (1024 * np.diff(level[edge]) / np.maximum(size, 1)).astype(np.int32)
            keep = (pos < (base + pick)[doc]) & one[doc]
            d, split = doc[keep], parts[cell[keep]]
            part = np.where(split > 1, B.mix(did.view(np.uint64))[d] % split, 0).astype(np.int32) - (split <= 1)
            yield B.as_table(tok=tok[keep].view(np.int64), s=part.astype(np.int32), did=did[d], n=size[d].astype(np.int32),
                             p=pos[keep].astype(np.int32), m=pick[d].astype(np.int32), q=typical[d])

    return src.mapInArrow(run, "tok long, s int, did long, n int, p int, m int, q int")


def _verify(src: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold.

    Only texts that occur in a pair travel: once to meet their pairs, once to
    the centre b. A centre's partners are split into groups of bounded size,
    each with a copy of the centre's text.
    """
    pairs = cut_lineage(pairs.select("a", "b").distinct())
    release_shuffles(src.sparkSession)
    centres = pairs.groupBy("b").agg(F.expr(f"1 + count(*) div {GROUP}").alias("parts"))
    ends = pairs.join(centres, "b").select(F.col("a").alias("did"), "b", F.pmod(F.xxhash64("a"), "parts").alias("part"),
                                           F.lit(True).alias("is_a"))
    own = centres.select(F.col("b").alias("did"), "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                         F.lit(False).alias("is_a"))
    wanted = src.join(ends.union(own), "did")
    sizes_ok = np.int64(percent)

    def compare(rows: pa.Table) -> pa.Table:
        out = {"a": [], "b": []}
        b = rows.column("b")[0].as_py()
        flag = rows.column("is_a")
        members, centre = rows.filter(flag), rows.filter(pa.compute.invert(flag))
        sets = [np.unique(tok) for batch in centre.to_batches() for _, raw, off in B.blocks([batch], "__text", rows=1)
                for _, tok in [token_sets(raw, off, n)]]
        for batch, raw, off in B.blocks(members.to_batches(), "__text", rows=1 << DOC_BITS):
            doc, tok = token_sets(raw, off, n)
            size = np.bincount(doc, minlength=batch.num_rows)
            for s in sets:
                if not len(s):
                    continue
                at = np.minimum(np.searchsorted(s, tok), len(s) - 1)
                common = np.bincount(doc[s[at] == tok], minlength=batch.num_rows)
                ok = (size > 0) & (100 * common >= sizes_ok * (size + len(s) - common))
                mine = B.ids(batch, "did").filter(pa.array(ok)).to_pylist()
                out["a"] += mine
                out["b"] += [b] * len(mine)
        return pa.table(out, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    import pyarrow.compute  # noqa: F401  (pa.compute in the tasks)
    return wanted.groupBy("b", "part").applyInArrow(compare, "a long, b long").distinct()


def near_duplicate_groups(docs: DataFrame, text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Two documents link when the Jaccard similarity of their distinct word
    shingles is at least ``percent`` / 100 (exact, in integers);
    ``component_id`` is the smallest doc_id reachable by links, itself
    included. Words are runs without white space, A-Z lower-cased; a text of
    fewer than ``words`` words is one shingle.

    Texts without words (null, empty, blank) have no shingles and link with
    nothing. Rows with one doc_id are one node, linked by each of its texts. A null doc_id sorts last; a
    component of null ids only has a null component_id. Other columns are not
    read. An empty table gives an empty result.
    """
    src = _source(docs, text)
    profile = cut_lineage(_profile(src, words))
    sets = profile.filter("chunk is null").select("did", "n", "sa", "sb")
    classes = sets.filter("n > 0").groupBy("n", "sa", "sb").agg(F.min("did").alias("b"))
    # the class of every set; an id whose rows differ has several
    classed = cut_lineage(sets.join(classes, ["n", "sa", "sb"]).select("did", "b").distinct())
    copies = classed.filter("did > b").select(F.col("did").alias("a"), "b")
    # others stand for these ids with all their texts
    stood_for = classed.groupBy("did").agg(F.max("b").alias("top")).filter("top < did").select("did")
    freq = docs.sparkSession.sparkContext.broadcast(_frequencies(profile))

    by = Window.partitionBy("tok", "s").orderBy("did")
    shared = (_prefix_rows(src, freq, words, percent)
              .withColumn("before", F.lag("did").over(by)).withColumn("after", F.lead("did").over(by))
              .filter("s >= 0 or before is not null or after is not null").drop("before", "after")
              .join(stood_for, "did", "left_anti"))
    shared = staged_table(shared, "prefixes")
    release_shuffles(docs.sparkSession)

    # links along each shingle: to the most typical document holding it and to the one before;
    # an edited copy resembles the unedited text more than another edited copy. The parts of a
    # frequent shingle are linked by their most typical documents
    by = Window.partitionBy("tok", "s").orderBy(F.desc("q"), "did")
    near = (shared.withColumn("first", F.first(F.struct("did", "n", "m")).over(by))
            .withColumn("prev", F.lag(F.struct("did", "n", "m")).over(by)))
    stars = None
    for c in ("first", "prev"):
        one = near.select(F.col("did").alias("a"), F.col(f"{c}.did").alias("b"), "n", F.col(f"{c}.n").alias("nb"),
                          F.least("m", f"{c}.m").alias("m")).filter("a <> b")
        stars = one if stars is None else stars.union(one)
    tops = (shared.filter("s >= 0").groupBy("tok", "s")
            .agg(F.min(F.struct((-F.col("q")).alias("q"), "did", "n", "m")).alias("top")))
    best = tops.groupBy("tok").agg(F.min("top").alias("best"))
    stars = stars.union(tops.join(best, "tok").filter("top.did <> best.did")
                        .select("top.did", "best.did", "top.n", "best.n", F.least("top.m", "best.m")))
    fits = f"100 * least(n, nb) >= {percent} * greatest(n, nb)"
    pairs = stars.filter(fits).groupBy("a", "b").agg(F.count("*").alias("k"), F.min("m").alias("m")).filter("k >= m")
    links = cut_lineage(_verify(src, pairs, words, percent).union(copies))
    release_shuffles(docs.sparkSession)
    groups = components(links)

    # what is left: documents of different components that share enough prefix shingles;
    # shingle by shingle, (component, size) classes that cannot reach the overlap drop out first
    placed = (shared.join(groups, shared.did == groups.node, "left")
              .select("tok", "did", "n", "p", "m", F.coalesce("component", "did").alias("c")))
    placed = placed.withColumn("z", F.floor(F.log(F.col("n").cast("double")) / math.log(1.1)))  # size classes
    kinds = placed.groupBy("tok", "c", "z").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("p").alias("p"),
                                                F.max("m").alias("m"))
    mixed = kinds.groupBy("tok").agg(F.min("c").alias("a"), F.max("c").alias("b")).filter("a < b").select("tok")
    kinds = staged_table(kinds.join(mixed, "tok", "left_semi"), "classes")
    held = staged_table(placed.join(kinds.select("tok").distinct(), "tok", "left_semi"), "mixed")
    release_shuffles(docs.sparkSession)

    def reach(xlo: str, xhi: str, ylo: str, yhi: str) -> str:
        """Whether sets with sizes in these ranges can reach the overlap with a common shingle at px and py."""
        def need(a: str, b: str) -> str:
            return f"ceil(({a} + {b}) * {percent} / {100 + percent})"
        return (f"100 * {xhi} >= {percent} * {ylo} and 100 * {yhi} >= {percent} * {xlo} and "
                f"px < {xhi} - {need(xhi, ylo)} + least(mx, my) and py < {yhi} - {need(yhi, xlo)} + least(mx, my)")

    def side(df: DataFrame, k: str) -> DataFrame:
        return df.select("tok", *[F.col(f).alias(f + k) for f in df.columns if f != "tok"])

    meet = (side(kinds, "x").join(side(kinds, "y"), "tok").filter(f"cx < cy and {reach('lox', 'hix', 'loy', 'hiy')}")
            .select("tok", "cx", "zx", "cy", "zy", "loy", "hiy", F.col("py"), F.col("my")))
    one = (meet.join(side(held, "x"), ["tok", "cx", "zx"]).filter(reach("nx", "nx", "loy", "hiy"))
           .drop("loy", "hiy", "py", "my"))
    crossed = one.join(side(held, "y"), ["tok", "cy", "zy"]).filter(reach("nx", "nx", "ny", "ny"))
    rest = (crossed.groupBy(F.greatest("didx", "didy").alias("a"), F.least("didx", "didy").alias("b"))
            .agg(F.count("*").alias("k"), F.min(F.least("mx", "my")).alias("m")).filter("k >= m"))
    more = _verify(src, rest, words, percent)
    final = components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    return (sets.join(final, sets.did == final.node, "left")
            .select(F.expr(f"nullif(did, {B.NO_ID})").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.expr(f"nullif(coalesce(component, did), {B.NO_ID})").alias("component_id")))

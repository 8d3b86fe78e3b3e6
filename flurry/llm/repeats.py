"""Removal of long byte strings that repeat across documents, by run-length
compressed suffix indexes.

Any two equal strings of ``width`` bytes share a content-defined anchor (the
first minimizer of their ``k``-byte substrings). Anchors held by two or more
documents select short contexts that contain every string to be compared;
equal contexts are classes with a smallest document, found by 96-bit hashes.
Different classes that agree with each other beyond an anchor form groups:
shards of groups are indexed by a run-length Burrows-Wheeler transform, and
matching statistics of the contexts streamed through it mark the strings that
an earlier document holds. A group too large for one index (a passage that very
many documents hold between different neighbours) is decided string by string,
by the smallest document of each string's hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flurry.llm import blocks as B
from flurry.llm.runindex import covered_starts
from flurry.session import discard, release_shuffles, staged_table

WIDTH = 50
K = 16
SHARD_CONTEXTS = 1 << 12  # contexts of one index (its arrays stay in a core's cache)
GROUP_CONTEXTS = 1 << 15  # largest group that is indexed whole (about 2 MB of text)
BLOCK = 1 << 18           # bytes hashed together
FLUSH = 1 << 20           # anchors of a task that travel together (16 bytes each)
BROADCAST_COPIES = 1 << 20  # keys of whole copies (24 bytes each) sent to every task at most
PLACE = np.uint64((1 << 31) - 1)
NONE = np.zeros(0, np.int64)
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
SECOND = B.BYTE_VALUE[::-1].copy()  # byte values of the second hash


def _slide(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of w entries."""
    span, out = 1, x
    while span * 2 <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if span < w:
        out = np.minimum(out[:len(out) - (w - span)], out[w - span:])
    return out


def _before(off: np.ndarray, size: int, n: int) -> np.ndarray:
    """Places whose next ``size`` bytes cross the end of a text."""
    at = (off[1:-1, None] - np.arange(1, size)).ravel()
    return at[(at >= 0) & (at < n)]


def anchors(raw: np.ndarray, off: np.ndarray, prefix: np.ndarray, width: int = WIDTH, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, position in the block, hash) of the first minimizer of every ``width``-byte string.

    Hash (high bits) and position (low bits) share a word, so one sliding
    minimum gives the smallest hash and, among equal ones, the first place.
    """
    n, w = len(raw), width - k + 1
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, np.zeros(0, np.uint64)
    _, down = B.powers(n + 1)
    key = prefix[k:] - prefix[:-k]
    key *= down[:n - k + 1]
    key ^= key >> np.uint64(29)
    key *= B.GRAM
    key &= ~PLACE
    key |= np.arange(n - k + 1, dtype=np.uint64)
    key[_before(off, k, len(key))] = TOP
    low = _slide(key, w)                                    # per width-byte string
    low[_before(off, width, len(low))] = TOP
    low = low[low != TOP]
    if not len(low):
        return none, none, np.zeros(0, np.uint64)
    place = (low & PLACE).view(np.int64)
    pick = place[np.concatenate([[True], place[1:] != place[:-1]])]
    h = B.span_hash(prefix, pick, pick + k) >> np.uint64(16)  # 48 bits travel
    return np.searchsorted(off, pick, "right") - 1, pick, h


def _source(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(B.NO_ID)).cast("long").alias("did"), F.col(text).alias("__text"))


def _copies(src: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(rows of ``src`` to compare, whole copies): a text that a smaller document holds too is covered
    whole, and takes no part. Equal texts are known by 128 bits of hash; ``did, a, b, n`` of the copies."""
    hashes = (F.xxhash64("__text").alias("a"), F.xxhash64(F.lit(width), "__text").alias("b"))
    hashed = src.select("did", *hashes, F.octet_length("__text").alias("n")).filter(F.col("n") >= width)
    least = hashed.groupBy("a", "b").agg(F.min("did").alias("lo"), F.max("did").alias("hi")).filter("lo < hi").drop("hi")
    copies = staged_table(hashed.join(least, ["a", "b"]).filter("did > lo").drop("lo").distinct(), "copies")
    keys = copies.drop("n")
    if copies.count() <= BROADCAST_COPIES:  # the texts stay where they are; beyond, they are dealt by id once a pass
        keys = F.broadcast(keys)
    return src.select("did", "__text", *hashes).join(keys, ["did", "a", "b"], "left_anti").select("did", "__text"), copies


def _shared(src: DataFrame, width: int, k: int, flush: int = FLUSH) -> DataFrame:
    """(h, did): anchors held by two or more documents, one row per document. Anchors travel packed: a task
    sends its anchors of a bucket of hashes as one row, and each bucket is sorted by itself."""
    buckets = 8 * int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def packed(parts: list) -> pa.RecordBatch:
        h, did = (np.concatenate(x) for x in zip(*parts))
        b = h % buckets
        order = np.argsort(b, kind="stable")
        off = np.searchsorted(b[order], np.arange(buckets + 1))
        full = pa.array(np.flatnonzero(np.diff(off)))
        cols = (pa.LargeBinaryArray.from_buffers(pa.large_binary(), buckets, [None, pa.py_buffer(off * 8), pa.py_buffer(x[order])])
                for x in (h, did))
        return B.as_table(bucket=full.cast(pa.int32()), **{c: x.take(full).cast(pa.binary()) for c, x in zip(("hs", "dids"), cols)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch, raw, off in B.blocks(batches, "__text", BLOCK):
            doc, _, h = anchors(raw, off, B.prefix_hash(raw), width, k)
            if len(doc):
                key = np.sort((doc.astype(np.uint64) << np.uint64(48)) | h)   # a block has at most 50,000 rows
                key = key[np.concatenate([[True], key[1:] != key[:-1]])]
                did = B.ids(batch, "did").to_numpy()[(key >> np.uint64(48)).astype(np.int64)]
                parts.append(((key & np.uint64((1 << 48) - 1)).astype(np.int64), did))
                n += len(did)
            if n >= flush:
                yield packed(parts)
                parts, n = [], 0
        if parts:
            yield packed(parts)

    return src.mapInArrow(run, "bucket int, hs binary, dids binary").groupBy("bucket").applyInArrow(_twice, "h long, did long")


def _twice(bucket: pa.Table) -> pa.Table:
    """The anchors of a bucket that stand in two rows or more."""
    h, did = (np.frombuffer(b"".join(bucket.column(c).to_pylist()), np.int64) for c in ("hs", "dids"))
    order = np.argsort(h)
    h = h[order]
    same = h[1:] == h[:-1]
    keep = np.append(same, False) | np.concatenate([[False], same])
    return pa.table({"h": h[keep], "did": did[order[keep]]})


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of a list column's entries."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    size = col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(col)), size), col.flatten()


def _second(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """32 more bits of the hash of a context."""
    return (B.span_hash(prefix, start, stop) >> np.uint64(33)).astype(np.int32)


def _contexts(raw: np.ndarray, off: np.ndarray, prefix: np.ndarray, pos: np.ndarray, h: np.ndarray, doc: np.ndarray,
              width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, hash with the anchor's place) of the context around each anchor: all strings that contain it."""
    start = np.maximum(pos - (width - k), off[doc])
    stop = np.minimum(pos + width, off[doc + 1])
    return start, stop, B.mix(B.span_hash(prefix, start, stop) ^ B.mix(h + ((pos - start).astype(np.uint64) << np.uint64(48))))


def _placed(listed: DataFrame, width: int, k: int) -> DataFrame:
    """Where each document holds the contexts of its shared anchors (list ``hs``): ch, c2, l, r, did, start, size.

    ``ch, c2``: hashes of the context with its anchor's place (equal ones are
    equal contexts). ``l, r``: the anchor with the half of the rest of a string
    on its left and on its right (0: the document ends before). Equal strings
    around an anchor agree in one of these.
    """
    half = (width - k + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, off in B.blocks(batches, "__text", BLOCK):
            prefix = B.prefix_hash(raw)
            doc, pos, h = anchors(raw, off, prefix, width, k)
            of, hs = _flat(B.ids(batch, "hs"))
            known = np.sort((of.astype(np.uint64) << np.uint64(48)) | hs.to_numpy(zero_copy_only=False).astype(np.uint64))
            mine = (doc.astype(np.uint64) << np.uint64(48)) | h
            if not len(doc) or not len(known):
                continue
            keep = known[np.minimum(np.searchsorted(known, mine), len(known) - 1)] == mine
            doc, pos, h = doc[keep], pos[keep], h[keep]
            if not len(doc):
                continue
            start, stop, ch = _contexts(raw, off, prefix, pos, h, doc, width, k)
            sides = []
            for salt, x, whole in ((1, pos - half, pos - start >= half), (2, pos + k, stop - pos - k >= half)):
                x = np.where(whole, x, start)
                side = B.mix(B.span_hash(prefix, x, x + half) ^ B.mix(h + (np.uint64(salt) << np.uint64(56))))
                sides.append(np.where(whole, side, np.uint64(0)).view(np.int64))
            c2 = _second(B.prefix_hash(raw, SECOND), start, stop)
            did = B.ids(batch, "did").to_numpy()
            yield B.as_table(ch=ch.view(np.int64), c2=c2, l=sides[0], r=sides[1], did=did[doc],
                             start=(start - off[doc]).astype(np.int32), size=(stop - start).astype(np.int32))

    return listed.mapInArrow(run, "ch long, c2 int, l long, r long, did long, start int, size int")


def _fetch(wanted: DataFrame, width: int, k: int) -> DataFrame:
    """The bytes of the wanted contexts (list ``cs``) of each document, as far as strings with the wanted
    side reach: side, did, ch, c2, at (first byte in the context), key."""
    half = (width - k + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, off in B.blocks(batches, "__text", BLOCK):
            row, cs = _flat(B.ids(batch, "cs"))
            prefix = B.prefix_hash(raw)
            doc, pos, h = anchors(raw, off, prefix, width, k)
            if not len(row) or not len(doc):
                continue
            start, stop, ch = _contexts(raw, off, prefix, pos, h, doc, width, k)
            key = B.mix(ch ^ B.mix(doc.astype(np.uint64)))
            order = np.argsort(key, kind="stable")
            field = {f.name: cs.field(i) for i, f in enumerate(cs.type)}
            want = field["ch"].to_numpy(zero_copy_only=False).view(np.uint64)
            spot = order[np.minimum(np.searchsorted(key[order], B.mix(want ^ B.mix(row.astype(np.uint64)))), len(order) - 1)]
            ok = (ch[spot] == want) & (doc[spot] == row)   # another row of the same id may hold it
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            spot, left = spot[at], field["left"].to_numpy(zero_copy_only=False)[at]
            begin = np.where(left, start[spot], np.maximum(start[spot], pos[spot] - half))
            end = np.where(left, np.minimum(stop[spot], pos[spot] + k + half), stop[spot])
            pick, did, data = pa.array(at), B.ids(batch, "did").to_numpy(), raw.tobytes()
            yield B.as_table(side=field["side"].take(pick), did=did[row[at]], ch=field["ch"].take(pick), c2=field["c2"].take(pick),
                             at=(begin - start[spot]).astype(np.int32),
                             key=pa.array([data[a:z] for a, z in zip(begin.tolist(), end.tolist())], pa.binary()))

    return wanted.mapInArrow(run, "side long, did long, ch long, c2 int, at int, key binary")


def _ranges(text: np.ndarray, start: np.ndarray, width: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, offsets): the ranges of strings that start at the sorted places of each of ``n`` texts."""
    new = np.concatenate([[True], (text[1:] != text[:-1]) | (np.diff(start) > width)])[:len(text)]
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(text))[:len(head)] - 1
    return start[head], start[last] + width, np.searchsorted(text[head], np.arange(n + 1))


MARKS = "ch long, c2 int, lo long, rel array<int>"


def _mark(width: int):
    """One shard: where strings of each context occur in a context of a smaller document.

    Equal keys of a group are indexed once, for their smallest document; the others are covered whole."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("side", "ascending"), ("key", "ascending"), ("did", "ascending")])
        side, did, ch, c2, at = (table.column(c).to_numpy() for c in ("side", "did", "ch", "c2", "at"))
        column = table.column("key").combine_chunks()
        size = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        other = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False).astype(bool)
        head = np.flatnonzero(np.concatenate([[True], other | (side[1:] != side[:-1])]))
        first = np.repeat(head, np.diff(np.append(head, len(column))))   # a key's smallest document
        _, group, many = np.unique(side[head], return_inverse=True, return_counts=True)
        ask = head[many[group] > 1]                           # groups of one key need no index
        ask = ask[np.lexsort((did[ask], side[ask]))]
        asked = column.take(pa.array(ask))
        raw = np.frombuffer(asked.buffers()[2] or b"", np.uint8)[:size[ask].sum()]
        begin, end, off = _ranges(*covered_starts(raw, size[ask], side[ask], did[ask], width), width, len(ask)) if len(ask) else (NONE, NONE, np.zeros(1, np.int64))
        slot = np.full(len(column), -1)
        slot[ask] = np.arange(len(ask))
        own = np.flatnonzero((did == did[first]) & (slot[first] >= 0))
        runs = np.diff(off)[slot[first[own]]]
        own, runs = own[runs > 0], runs[runs > 0]
        pick = np.arange(runs.sum()) + np.repeat(off[slot[first[own]]] - np.cumsum(runs) + runs, runs)
        part = np.stack([begin[pick], end[pick]], 1) + np.repeat(at[own], runs)[:, None]
        whole = np.flatnonzero((did > did[first]) & (size >= width))
        i = np.concatenate([whole, own])
        rel = np.concatenate([np.stack([at, at + size], 1)[whole], part]).astype(np.int32).ravel()
        stop = np.cumsum(np.concatenate([[0], np.full(len(whole), 2), 2 * runs])).astype(np.int32)
        return pa.table({"ch": pa.array(ch[i], pa.int64()), "c2": pa.array(c2[i], pa.int32()), "lo": pa.array(did[i], pa.int64()),
                         "rel": pa.ListArray.from_arrays(pa.array(stop), pa.array(rel))})
    return run


def _strings(contexts: DataFrame, width: int) -> DataFrame:
    """Every ``width``-byte string of the contexts by two 64-bit hashes, with its place in the context: a, b, did, ch, c2, at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in range(0, batch.num_rows, 2048):
                part = batch.slice(cut, 2048)
                keys = B.ids(part, "key").to_pylist()
                raw = np.frombuffer(b"".join(keys), np.uint8)
                off = np.append(0, np.cumsum([len(v) for v in keys]))
                n = np.maximum(np.diff(off) - width + 1, 0)
                row = np.repeat(np.arange(len(keys)), n)
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                x = off[row] + at
                a, b = (B.span_hash(B.prefix_hash(raw, v), x, x + width).view(np.int64) for v in (B.BYTE_VALUE, SECOND))
                pick = pa.array(row)
                yield B.as_table(a=a, b=b, did=B.ids(part, "did").take(pick), ch=B.ids(part, "ch").take(pick),
                                 c2=B.ids(part, "c2").take(pick), at=at.astype(np.int32) + B.ids(part, "at").to_numpy()[row])

    return contexts.mapInArrow(run, "a long, b long, did long, ch long, c2 int, at int")


def _by_string(contexts: DataFrame, width: int) -> DataFrame:
    """Marks of contexts of any number, without bringing a group together: each string's smallest
    document is a grouped minimum (combined before the shuffle), and goes back to the strings by a join."""
    rows = staged_table(_strings(contexts, width), "strings")  # the group's strings, a row each
    least = rows.groupBy("a", "b").agg(F.min("did").alias("least"), F.max("did").alias("most")).filter("least < most").drop("most")
    covered = rows.join(least, ["a", "b"]).filter("did > least")
    rel = F.flatten(F.transform(F.array_sort(F.collect_set("at")), lambda v: F.array(v, v + F.lit(width))))  # at most a context's strings
    return covered.groupBy("ch", "c2", F.col("did").alias("lo")).agg(rel.alias("rel"))


def repeated_spans(docs: DataFrame, text: str = "text", width: int = WIDTH, k: int = K,
                   group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """(did, cuts): per document byte ranges [start, end, start, end, ...] (they may
    overlap) covered by strings that also start in a document with a smaller id.

    Whole copies of an earlier document are found first and take no further part.
    Equal contexts form a class, known by its hashes. All its documents but the
    smallest lose the whole context. The bytes of a class are fetched from the
    smallest document, and only if another class agrees with it beyond the
    anchor (a group): groups of at most ``group_contexts`` are indexed in shards
    and streamed, larger ones decided by grouped minima of their strings.
    """
    spark = docs.sparkSession
    src, copies = _copies(_source(docs, text), width)
    lists = staged_table(_shared(src, width, k).groupBy("did").agg(F.collect_set("h").alias("hs")), "anchors")  # a document's own
    release_shuffles(spark)
    placed = staged_table(_placed(src.join(lists, "did"), width, k), "contexts")
    discard(lists)
    release_shuffles(spark)
    classes = staged_table(placed.groupBy("ch", "c2").agg(
        F.min("did").alias("lo"), F.max("did").alias("hi"), F.min("l").alias("l"), F.min("r").alias("r")), "classes")
    release_shuffles(spark)
    side = F.explode(F.array(F.struct(F.col("l").alias("side"), F.lit(True).alias("left")), F.struct(F.col("r").alias("side"), F.lit(False).alias("left")))).alias("s")
    ends = classes.select("ch", "c2", "lo", side).select("ch", "c2", "lo", "s.*").filter("side <> 0")
    groups = staged_table(ends.groupBy("side").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "groups")
    release_shuffles(spark)
    total = groups.agg(F.sum(F.when(F.col("n") <= group_contexts, F.col("n"))).alias("small"), F.max("n").alias("most")).first()

    def fetched(which: DataFrame) -> tuple[DataFrame, DataFrame]:
        cs = F.collect_list(F.struct("side", "left", "ch", "c2"))  # at most a document's own contexts
        wanted = staged_table(ends.join(which, "side", "left_semi").groupBy("lo").agg(cs.alias("cs")).withColumnRenamed("lo", "did"), "wanted")
        release_shuffles(spark)
        return _fetch(src.join(wanted, "did"), width, k), wanted

    n_shards = max(1, math.ceil((total["small"] or 0) / SHARD_CONTEXTS))
    small, wanted = fetched(groups.filter(F.col("n") <= group_contexts))
    small = small.withColumn("shard", F.pmod(F.xxhash64("side"), F.lit(n_shards)))
    parts = [staged_table(small.groupBy("shard").applyInArrow(_mark(width), MARKS), "marks")]
    done = [groups, wanted]
    if (total["most"] or 0) > group_contexts:
        large, wanted = fetched(groups.filter(F.col("n") > group_contexts))
        parts.append(staged_table(_by_string(large.drop("side"), width), "marks"))
        done.append(wanted)
    discard(*done)
    release_shuffles(spark)
    decided = classes.filter("lo < hi").select("ch", "c2", "lo", F.lit(None).cast("array<int>").alias("rel"))
    for marks in parts:
        decided = decided.unionByName(marks)
    cut = placed.select("ch", "c2", "did", "start", "size").join(decided, ["ch", "c2"]).filter(
        (F.col("rel").isNull() & (F.col("did") > F.col("lo"))) | (F.col("rel").isNotNull() & (F.col("did") == F.col("lo"))))
    whole, part = F.array("start", F.col("start") + F.col("size")), F.transform("rel", lambda v: v + F.col("start"))
    copied = copies.select("did", F.array(F.lit(0), F.col("n")).alias("c"))
    cuts = staged_table(cut.select("did", F.when(F.col("rel").isNull(), whole).otherwise(part).alias("c")).unionByName(copied)
                        .groupBy("did").agg(F.flatten(F.collect_list("c")).alias("cuts")), "cuts")
    discard(placed, classes, copies, *parts)
    release_shuffles(spark)
    return cuts


def remove_repeats(docs: DataFrame, text: str = "text", width: int = WIDTH, k: int = K) -> DataFrame:
    """doc_id, kept (binary: the remaining bytes), n_bytes, n_removed, n_spans of every row.

    Texts are UTF-8 bytes; a byte goes if a ``width``-byte string covering it
    also starts in a document with a smaller ``doc_id`` (strings are judged on
    the input, overlaps count, matches never cross documents). ``n_spans``
    counts the maximal removed runs.

    Null texts are empty; texts shorter than ``width`` stay whole. Repeats
    inside one document stay. Rows of one doc_id are one document for the
    comparison but keep their own texts; they lose what any of them loses at
    the same place. A null doc_id sorts last. Other columns are not read. An
    empty table gives an empty result.
    """
    src = _source(docs, text)
    both = src.join(repeated_spans(docs, text, width, k), "did", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, off in B.blocks(batches, "__text"):
            kept, gone, runs = [], [], []
            for i, cuts in enumerate(B.ids(batch, "cuts").to_pylist()):
                mine = raw[off[i]:off[i + 1]]
                if not cuts:
                    kept.append(mine.tobytes())
                    gone.append(0)
                    runs.append(0)
                    continue
                cover = np.zeros(len(mine) + 1, np.int64)
                at = np.minimum(np.array(cuts, np.int64).reshape(-1, 2), len(mine))
                np.add.at(cover, at[:, 0], 1)
                np.add.at(cover, at[:, 1], -1)
                out = np.cumsum(cover)[:-1] > 0
                kept.append(mine[~out].tobytes())
                gone.append(int(out.sum()))
                runs.append(int((out & ~np.concatenate([[False], out[:-1]])).sum()))
            yield B.as_table(did=B.ids(batch, "did"), kept=pa.array(kept, pa.binary()), n_bytes=np.diff(off),
                             n_removed=pa.array(gone, pa.int64()), n_spans=pa.array(runs, pa.int64()))

    out = both.mapInArrow(run, "did long, kept binary, n_bytes long, n_removed long, n_spans long")
    return out.select(F.expr(f"nullif(did, {B.NO_ID})").alias("doc_id"), "kept", "n_bytes", "n_removed", "n_spans")

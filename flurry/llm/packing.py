"""Best-fit packing of token sequences by large-item matching.

Lengths are integers up to the capacity, so the whole corpus is described by
a histogram of at most ``capacity`` counts: that is all the driver sees. On
the histogram, items above one third of the capacity are matched at most two
to a bin (largest with the largest that fits), then smaller items best-fit
the remaining gaps, whole classes of equal bins at a time. Pieces then find
their place by their rank among the pieces of their length.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flurry.llm import blocks as B
from flurry.llm.tokens import PretokenBpe
from flurry.session import cut_lineage

CAPACITY = 1024
END_ID = 2
RANK_GROUP = 1 << 16  # pieces numbered together in one task


def match_lengths(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Bin patterns (lengths in order) with how many bins use each."""
    left = np.zeros(capacity + 1, object)
    for n, c in counts.items():
        left[n] += c
    third = capacity // 3
    done: list[tuple[tuple[int, ...], int]] = []
    gaps: dict[int, list] = {}   # free space -> [(pattern, bins)]
    heap_all: list[int] = []     # gaps in use, kept sorted through a heap per query

    def open_bins(pattern, n, gap):
        if n:
            (gaps.setdefault(gap, []).append((pattern, n)) if gap else done.append((pattern, n)))

    for a in range(capacity, third, -1):
        while left[a]:
            b = next((x for x in range(min(a, capacity - a), third, -1) if left[x] > (x == a)), 0)
            if not b:
                open_bins((a,), left[a], capacity - a)
                left[a] = 0
            else:
                n = left[a] // 2 if a == b else min(left[a], left[b])
                left[a] -= n
                left[b] -= n
                open_bins((a, b), n, capacity - a - b)
    for s in range(third, 0, -1):
        heap_all = [g for g in gaps if g >= s]
        heapq.heapify(heap_all)
        while left[s]:
            while heap_all and not gaps.get(heap_all[0]):
                heapq.heappop(heap_all)
            if heap_all:
                gap = heap_all[0]
                pattern, n = gaps[gap].pop()
            else:
                gap, pattern, n = capacity, (), math.ceil(left[s] / (capacity // s))
            each = gap // s
            full = min(n, left[s] // each)
            open_bins(pattern + (s,) * each, full, gap - each * s)
            left[s] -= full * each
            if full < n:
                rest = left[s]  # fewer than one bin takes
                if rest:
                    open_bins(pattern + (s,) * rest, 1, gap - rest * s)
                    left[s] = 0
                    full += 1
                if pattern:
                    open_bins(pattern, n - full, gap)
    return done + [x for g in sorted(gaps) for x in gaps[g]]


def slots(patterns: list[tuple[tuple[int, ...], int]], capacity: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: (first rank, first bin, offset) of each run of slots."""
    out: dict[int, list] = {}
    given = np.zeros(capacity + 1, np.int64)
    base = 0
    for pattern, n in patterns:
        at = 0
        for s in pattern:
            out.setdefault(s, []).append((int(given[s]), base, at))
            given[s] += n
            at += s
        base += n
    return {s: tuple(np.array(x, np.int64) for x in zip(*rows)) for s, rows in out.items()}


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, text: str = "text", capacity: int = CAPACITY,
                    end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32 (and ids, little-endian
    unsigned 32-bit). Only longer documents are cut; their first piece may be shorter, the others are full."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PretokenBpe.load(tokenizer_path)
        for batch, raw, off in B.blocks(batches, "__text", 1 << 20):
            own, out = B.ids(batch), {"at": [], "piece": [], "start": [], "length": [], "crc": [], "ids": []}
            for i, tokens in enumerate(bpe.encode_block(raw, off)):
                tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                head = len(tokens) % capacity or capacity
                cuts = [0, *range(min(head, len(tokens)), len(tokens) + 1, capacity)]
                for p, (x, y) in enumerate(zip(cuts, cuts[1:])):
                    data = tokens[x:y].tobytes()
                    out["at"].append(i)
                    out["piece"].append(p)
                    out["start"].append(x)
                    out["length"].append(y - x)
                    out["crc"].append(zlib.crc32(data))
                    if with_ids:
                        out["ids"].append(data)
            cols = {"doc_id": own.take(pa.array(out["at"], pa.int64())), "piece": pa.array(out["piece"], pa.int32()),
                    "start": pa.array(out["start"], pa.int64()), "length": pa.array(out["length"], pa.int64()),
                    "ids_crc32": pa.array(out["crc"], pa.int64())}
            yield B.as_table(**cols, **({"ids": pa.array(out["ids"], pa.binary())} if with_ids else {}))

    return docs.select("doc_id", F.col(text).alias("__text")).mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of 1 to ``capacity``.

    Sequences are filled gaplessly from offset 0. Rows are numbered within
    (hash group, length) and lifted by the counts of earlier groups, so a
    length that a third of all pieces share is numbered by many tasks. The
    pieces are checkpointed once. An empty table gives an empty result;
    repeated rows are pieces of their own. Input columns named ``sequence_id``
    or ``offset`` are replaced.
    """
    pieces = cut_lineage(pieces.drop("sequence_id", "offset"))
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    if any(not 1 <= n <= capacity for n in counts):
        raise ValueError(f"lengths must be 1 to {capacity}")
    table = pieces.sparkSession.sparkContext.broadcast(slots(match_lengths(counts, capacity), capacity))
    groups = max(1, math.ceil(sum(counts.values()) / RANK_GROUP))
    keyed = pieces.withColumn("__g", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in pieces.columns]), F.lit(groups)))
    below = (keyed.groupBy("length", "__g").count()
             .withColumn("__before", F.sum("count").over(Window.partitionBy("length").orderBy("__g")) - F.col("count"))
             .drop("count"))
    order = [F.col(f"`{c}`") for c in pieces.columns]
    ranked = (keyed.withColumn("__k", F.row_number().over(Window.partitionBy("length", "__g").orderBy(*order)) - 1)
              .join(below, ["length", "__g"]).withColumn("__rank", F.col("__k") + F.col("__before"))
              .select(*pieces.columns, "__rank"))
    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = table.value
        for batch in batches:
            length, rank = (B.ids(batch, c).to_numpy() for c in ("length", "__rank"))
            seq, at = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in np.unique(length):
                rows = np.flatnonzero(length == s)
                first, base, offset = by[int(s)]
                k = np.searchsorted(first, rank[rows], "right") - 1
                seq[rows], at[rows] = base[k] + rank[rows] - first[k], offset[k]
            yield B.as_table(**{c: B.ids(batch, c) for c in names}, sequence_id=seq, offset=at)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(run, fields + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, text: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack documents; see :func:`tokenize_pieces` and :func:`pack`.

    A null or empty text is one piece holding only the end id. Texts of any
    length are tokenized whole. Documents with equal or null ids are packed as
    documents of their own. Other columns are not read.
    """
    return pack(tokenize_pieces(docs, tokenizer_path, text, capacity, end_id, with_ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Token sequences from ``pack_documents(..., with_ids=True)``: sequence_id, length, ids."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` pieces
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), rows.alias("__p"))
            .select("sequence_id", "length",
                    F.aggregate("__p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids")))

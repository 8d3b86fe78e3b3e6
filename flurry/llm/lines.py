"""Line deduplication through a sharded minimal perfect hash.

Lines are reduced to 128-bit hashes of their keys. The distinct hashes found
in two or more documents are split into shards; each shard is a minimal
perfect hash (collision-free bit levels with ranks) over compact arrays:
fingerprint, document count and first document. Documents do not join lines:
each task probes the arrays of one shard with the hashes routed to it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from flurry.llm import blocks as B
from flurry.session import cut_lineage

EDGE = b" \t\n\x0b\x0c\r"
MIN_CHARS = 10
SHARD_PROBES = 1 << 15   # line hashes one shard task receives
LEVELS = 48              # bit levels before the (never seen) left-over list
GAMMA = 2.0


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit hash of a line's key, or None if the key is too short."""
    k = line.strip(EDGE)
    if len(k) < min_chars or (len(k) < 4 * min_chars and len(k.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(k.lower())  # bytes.lower: A-Z only


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys: level by level, a key
    takes a bit that no other remaining key wants; its index is the bit's rank."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.begin = np.concatenate([[0], np.cumsum(sizes)])
        self.rank = np.concatenate([[0], np.cumsum(bits)])

    @classmethod
    def build(cls, keys: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
        """(hash, keys that found no place)."""
        sizes, parts, left = [], [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(8, int(GAMMA * len(left)))
            at = cls._place(left, level, size)
            once = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(once)
            left = left[~once[at]]
        bits = np.concatenate(parts) if parts else np.zeros(0, bool)
        return cls(np.array(sizes, np.int64), bits), left

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (B.mix(keys + np.uint64((level + 1) * int(B.STEP) & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; any index or -1 for keys not in the set."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(todo):
                break
            at = self._place(keys[todo], level, size) + self.begin[level]
            hit = self.bits[at]
            out[todo[hit]] = self.rank[at[hit]]
            todo = todo[~hit]
        return out


def _pair(digests) -> np.ndarray:
    """(n, 2) unsigned halves of 16-byte digests."""
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


def _joint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return B.mix(h1 ^ B.mix(h2))


def _shard_arrays(table: pa.Table) -> pa.Table:
    """Arrays of one shard: levels, packed bits, fingerprints, counts, first documents."""
    h1, h2 = (table.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
    n, lo = table.column("n").to_numpy(), table.column("lo").to_numpy()
    key = _joint(h1, h2)
    ph, left = PerfectHash.build(key)
    order = np.empty(int(ph.bits.sum()), np.int64)
    at = ph.find(key)
    spare = np.isin(key, left)
    order[at[~spare]] = np.flatnonzero(~spare)
    return pa.table({"shard": table.column("shard").slice(0, 1), "sizes": [ph.sizes.tolist()],
                     "bits": [np.packbits(ph.bits).tobytes()], "prints": [h2[order].tobytes()],
                     "counts": [n[order].astype(np.int64).tobytes()], "first": [lo[order].tobytes()],
                     "spare": [np.stack([h1[spare].view(np.int64), h2[spare].view(np.int64), n[spare], lo[spare]], 1).tobytes()],
                     "probes": [int(n.sum())]},
                    schema=pa.schema([("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()),
                                      ("prints", pa.binary()), ("counts", pa.binary()), ("first", pa.binary()),
                                      ("spare", pa.binary()), ("probes", pa.int64())]))


SHARD_SCHEMA = ("shard long, sizes array<long>, bits binary, prints binary, counts binary, first binary, "
                "spare binary, probes long")


def _probe(lines: pa.Table, shard: pa.Table) -> pa.Table:
    """Documents' line hashes against one shard: those to drop, with the key's count and holder."""
    out = {"did": [], "h": [], "n_docs": []}
    if lines.num_rows and shard.num_rows:
        row = {c: shard.column(c)[0].as_py() for c in shard.column_names}
        sizes = np.array(row["sizes"], np.int64)
        ph = PerfectHash(sizes, np.unpackbits(np.frombuffer(row["bits"], np.uint8))[:int(sizes.sum())].astype(bool))
        prints, first = np.frombuffer(row["prints"], np.uint64), np.frombuffer(row["first"], np.int64)
        counts = np.frombuffer(row["counts"], np.int64)
        did = lines.column("did").to_numpy()
        h1, h2 = (lines.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
        at = ph.find(_joint(h1, h2))
        hit = np.flatnonzero(at >= 0)
        hit = hit[prints[at[hit]] == h2[hit]]
        drop = hit[first[at[hit]] != did[hit]]
        spare = np.frombuffer(row["spare"], np.int64).reshape(-1, 4)
        for a, b, n, lo in spare.tolist():
            more = np.flatnonzero((h1.view(np.int64) == a) & (h2.view(np.int64) == b) & (did != lo))
            drop = np.setdiff1d(drop, more)
            out["did"] += did[more].tolist()
            out["h"] += [np.array([a, b], np.int64).tobytes()] * len(more)
            out["n_docs"] += [n] * len(more)
        pair = np.stack([h1[drop], h2[drop]], 1)
        out["did"] += did[drop].tolist()
        out["h"] += [x.tobytes() for x in pair]
        out["n_docs"] += counts[at[drop]].tolist()
    return pa.table(out, schema=pa.schema([("did", pa.int64()), ("h", pa.binary()), ("n_docs", pa.int64())]))


def _hash_lines(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """One row per document and distinct line key: did, h1, h2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, off in B.blocks(batches, "__text"):
            data, own, keys = raw.tobytes(), [], []
            for i, did in enumerate(B.ids(batch, "did").to_pylist()):
                mine = {line_key(x, min_chars) for x in data[off[i]:off[i + 1]].split(b"\n")}
                mine.discard(None)
                keys += mine
                own += [did] * len(mine)
            if own:
                h = _pair(keys).view(np.int64)
                yield B.as_table(did=pa.array(own, pa.int64()), h1=pa.array(h[:, 0]), h2=pa.array(h[:, 1]))

    src = docs.select(F.coalesce("doc_id", F.lit(B.NO_ID)).cast("long").alias("did"), F.col(text).alias("__text"))
    return src.mapInArrow(run, "did long, h1 long, h2 long")


def build_index(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> tuple[DataFrame, int]:
    """The sharded index over the line hashes of two or more documents, and its number of shards.

    Counts are pre-aggregated before the shuffle; the number of shards follows
    the number of line hashes in the corpus, so a shard's arrays and probes
    stay bounded.
    """
    seen = Observation("lines")
    lines = _hash_lines(docs, text, min_chars)
    keys = (lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("did").alias("lo"), F.max("did").alias("hi"))
            .observe(seen, F.sum("n").alias("n")).filter("lo < hi").drop("hi"))
    keys = cut_lineage(keys)
    n_shards = max(1, math.ceil((seen.get["n"] or 0) / SHARD_PROBES))
    return (keys.withColumn("shard", F.pmod("h1", F.lit(n_shards))).groupBy("shard")
            .applyInArrow(_shard_arrays, SHARD_SCHEMA)), n_shards


def find_duplicate_lines(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(did, h, n_docs): per document the hashes of the keys it loses.

    A shard whose repeated lines exceed the task size is probed in several
    salted parts, each with a copy of the (small) shard, so a line held by a
    third of all documents is spread over many tasks.
    """
    index, n_shards = build_index(docs, text, min_chars)
    index = cut_lineage(index.withColumn("parts", F.expr(f"1 + probes div {SHARD_PROBES}")))
    salts = index.select("shard", "parts").filter("parts > 1")
    lines = _hash_lines(docs, text, min_chars).withColumn("shard", F.pmod("h1", F.lit(n_shards)))
    lines = (lines.join(salts, "shard", "left")
             .withColumn("part", F.pmod(F.xxhash64("did"), F.coalesce("parts", F.lit(1)))))
    copies = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    return (lines.select("shard", "part", "did", "h1", "h2").groupBy("shard", "part")
            .cogroup(copies.groupBy("shard", "part")).applyInArrow(_probe, "did long, h binary, n_docs long"))


def dedup_lines(docs: DataFrame, text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """All columns of ``docs`` with ``text`` reduced, plus ``n_lines`` and ``n_dropped``.

    A text is cut at ``\\n``. A line's key is the line without spaces, tabs and
    line breaks at both ends, A-Z lower-cased. Keys of at least ``min_chars``
    code points found in two or more documents are dropped everywhere but in
    the smallest ``doc_id`` holding them (there every occurrence stays).

    Null and empty texts are one empty line (result: empty text). Rows with
    equal ``doc_id`` count as one document and lose the same lines; a null
    ``doc_id`` sorts after all others, and all such rows are one document.
    Other columns pass through; input columns called ``n_lines`` or
    ``n_dropped`` are replaced. An empty table gives an empty result.
    """
    docs = docs.drop("n_lines", "n_dropped")
    drops = (find_duplicate_lines(docs, text, min_chars).groupBy(F.col("did").alias("__did"))
             .agg(F.collect_list("h").alias("__drop")))  # at most a document's own lines
    both = (docs.withColumn("__did", F.coalesce("doc_id", F.lit(B.NO_ID)).cast("long"))
            .join(drops, "__did", "left").drop("__did"))
    schema = docs.withColumn(text, F.lit("")).schema
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, off in B.blocks(batches, text):
            data, out, n_lines, n_drop = raw.tobytes(), [], [], []
            for i, drop in enumerate(B.ids(batch, "__drop").to_pylist()):
                rows = data[off[i]:off[i + 1]].split(b"\n")
                n_lines.append(len(rows))
                if drop:
                    gone = set(drop)
                    rows = [x for x in rows if line_key(x, min_chars) not in gone]
                n_drop.append(n_lines[-1] - len(rows))
                out.append(b"\n".join(rows))
            cols = {c: pa.array(out, pa.binary()).cast(pa.string()) if c == text else B.ids(batch, c) for c in names}
            yield B.as_table(**cols, __lines=pa.array(n_lines, pa.int64()), __dropped=pa.array(n_drop, pa.int64()))

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), "__lines long, __dropped long"])
    return (both.mapInArrow(run, fields).withColumnRenamed("__lines", "n_lines")
            .withColumnRenamed("__dropped", "n_dropped"))

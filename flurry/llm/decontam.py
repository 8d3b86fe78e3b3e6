"""Benchmark decontamination by spaced-seed hashing.

Fixed masks select some positions of a token window and ignore the others, so
a window still hits after substitutions at ignored positions. Hashes of the
benchmark (test) windows are matched with the hashes of every training
window; around each hit the two texts are compared token by token along the
hit's diagonal, and an overlap counts only if enough tokens agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flurry.llm import blocks as B

# masks over token windows: 1 = position counts, 0 = position ignored
MASKS = ("1111111", "11011011011", "1101010110011", "10100110111001")
MIN_TOKENS = 10       # agreeing tokens of a verified overlap
MIN_AGREE = 0.8       # share of agreeing tokens inside it
BLOCK_ITEMS_BYTES = 4 << 20
PAIRS_AT_ONCE = 1 << 20  # seed hits expanded together


def _care(masks: tuple[str, ...]) -> list[np.ndarray]:
    return [np.array([i for i, c in enumerate(m) if c == "1"]) for m in masks]


def _window_hashes(words: np.ndarray, care: np.ndarray, salt: int) -> np.ndarray:
    m = len(words) - int(care[-1])
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(m, np.uint64(salt * 2 + 1))
    for i in care:
        h = h * B.GRAM + words[i:i + m]
    return B.mix(h)


def _tokens(raw: np.ndarray, off: np.ndarray):
    start, end, first = B.spans(raw, off, B.PUNCT)
    return start, end, first, B.bytes_hash(B.LOWER[raw], start, end)


class TestIndex:
    """Sorted window hashes of one block of benchmark items (bounded by bytes)."""

    def __init__(self, item_ids: list, texts: list[str], masks: tuple[str, ...]):
        raw, off = B.text_arrays(pa.array(texts, pa.string()))
        _, _, self.first, self.words = _tokens(raw, off)
        self.item_ids, self.masks, self.tables = item_ids, masks, []
        of = B.text_of(self.first, len(self.words))
        for k, care in enumerate(_care(masks)):
            h = _window_hashes(self.words, care, k)
            at = np.flatnonzero(of[:len(h)] == of[int(care[-1]):]) if len(h) else np.zeros(0, np.int64)
            order = np.argsort(h[at], kind="stable")
            h, at = h[at][order], at[order]
            keys, rank = np.unique(h, return_inverse=True)
            item = of[at]
            # places of one hash in one item: entries first[key] .. first[key + 1], each with its run of places
            head = np.flatnonzero(np.concatenate([[True], (rank[1:] != rank[:-1]) | (item[1:] != item[:-1])])) if len(at) else at
            entries = np.searchsorted(rank[head], np.arange(len(keys) + 1))
            seen = np.zeros(1 << 22, bool)  # first test of a training hash: one table look-up
            seen[(keys & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
            self.tables.append((care, keys, entries, item[head], np.append(head, len(at)), at, seen))


def _ramp(n: np.ndarray) -> np.ndarray:
    """0 .. n_i - 1 for each i, concatenated."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _triples(index: TestIndex, words: np.ndarray, doc: np.ndarray, mask: int):
    """Seed hits of one mask, grouped: arrays (document, item, document's hits, item's places) with one row per
    (document, hash, item); hits and places are runs [begin, end) of the two position arrays that follow."""
    care, keys, entries, item, head, places, seen = index.tables[mask]
    h = _window_hashes(words, care, mask)
    if not len(h) or not len(keys):
        return None
    at = np.flatnonzero(seen[(h & np.uint64((1 << 22) - 1)).astype(np.int64)])
    at = at[doc[at] == doc[at + int(care[-1])]]
    key = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
    ok = keys[key] == h[at]
    at, key = at[ok], key[ok]
    if not len(at):
        return None
    order = np.lexsort((at, key, doc[at]))
    at, key = at[order], key[order]
    begin = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[at[1:]] != doc[at[:-1]])]))
    end, k = np.append(begin[1:], len(at)), key[begin]
    n = entries[k + 1] - entries[k]
    g = np.repeat(np.arange(len(begin)), n)
    e = _ramp(n) + entries[k][g]
    return doc[at[begin[g]]], item[e], begin[g], end[g], head[e], head[e + 1], at, places


def _hits(index: TestIndex, words: np.ndarray, doc: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seed hits as distinct (text, item, diagonal) rows, diagonal = training - item position, and the
    (text, item) pairs with more hits of a mask than diagonals, as in repetitive texts: these are not expanded.

    ``size``: tokens of each text."""
    masks = [t for t in (_triples(index, words, doc, m) for m in range(len(index.tables))) if t is not None]
    if not masks:
        return np.zeros((0, 3), np.int64), np.zeros((0, 2), np.int64)
    items = len(index.first) - 1
    pair = [t[0] * items + t[1] for t in masks]
    many = [(t[3] - t[2]) * (t[5] - t[4]) for t in masks]
    pairs, of = np.unique(np.concatenate(pair), return_inverse=True)
    hits = np.bincount(of, np.concatenate(many))
    dense = pairs[hits > len(index.tables) * (size[pairs // items] + np.diff(index.first)[pairs % items])]
    found = []
    for (d, item, b, e, lo, hi, at, places), p, m in zip(masks, pair, many):
        rows = np.flatnonzero(~np.isin(p, dense))
        cut = np.searchsorted(np.cumsum(m[rows]), np.arange(0, m[rows].sum(), PAIRS_AT_ONCE), "right")
        for part in np.split(rows, np.unique(cut)[1:]) if len(rows) else []:
            r = np.repeat(part, m[part])
            step, width = _ramp(m[part]), (hi - lo)[r]
            diag = at[b[r] + step // width] - places[lo[r] + step % width]
            found.append(np.unique(np.stack([d[r], item[r], diag], 1), axis=0))
    sparse = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)
    return sparse, np.stack([dense // items, dense % items], 1)


def _seeded(same: np.ndarray, masks: list[np.ndarray]) -> bool:
    """Whether a diagonal has a seed hit: some window in which all positions of a mask agree."""
    for care in masks:
        m = len(same) - int(care[-1])
        if m > 0:
            hit = same[:m].copy()
            for i in care[1:]:
                hit &= same[i:i + m]
            if hit.any():
                return True
    return False


def _best_run(same: np.ndarray, min_agree: float) -> tuple[int, int]:
    """Of all runs in which the share ``min_agree`` of the tokens agrees, the one
    with the most agreeing tokens (then the shortest, the first); ends agree.
    """
    share = Fraction(str(min_agree))
    hit, miss = share.denominator - share.numerator, share.numerator  # a run qualifies if its sum is not negative
    level = np.concatenate([[0], np.cumsum(np.where(same, hit, -miss))])
    count = np.concatenate([[0], np.cumsum(same)])
    end = np.flatnonzero(same) + 1
    if not len(end):
        return 0, 0
    first = np.searchsorted(-np.minimum.accumulate(level), -level[end])  # earliest start that is not above the end
    start = end[count[first]] - 1
    best = np.lexsort((end, end - start, count[start] - count[end]))[0]
    return int(start[best]), int(end[best])


def spaced_seed_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                         masks: tuple[str, ...] = MASKS, min_tokens: int = MIN_TOKENS,
                         min_agree: float = MIN_AGREE) -> DataFrame:
    """Verified overlaps: one row per (doc_id, item_id).

    Tokens are runs of letters and digits (ASCII case ignored; punctuation
    separates). Returns ``doc_id, item_id, n_agree`` (agreeing tokens of the
    best overlap: the most that a run of tokens with a share of at least
    ``min_agree`` agreeing has), ``n_span`` (its tokens), ``item_tokens, doc_start, doc_end``
    (token positions in the document).

    The benchmark is the bounded side: it is read in blocks of at most
    ``BLOCK_ITEMS_BYTES`` of text (by a hash of the item), each block's sorted
    hash arrays go to every task, and the documents are scanned once per block
    in a narrow pass without a shuffle. Items longer than a block form larger
    blocks; nothing is cut.

    A (document, item) pair with more seed hits than diagonals, as in repetitive
    texts, is not expanded into its hits: its diagonals are compared from the
    longest on, and end where none can agree more. Ties go to the smaller diagonal.

    Null or empty texts (either side) overlap with nothing; texts with fewer
    tokens than a mask cannot hit it. Repeated documents each get their rows;
    repeated items with one id give one row, the best. Other columns are not
    read. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    bench = benchmark.select(F.col("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / BLOCK_ITEMS_BYTES))
    src = docs.select("doc_id", F.col(text).alias("__text"))
    kinds = {f.name: f.dataType.simpleString() for f in [*src.schema.fields, *bench.schema.fields]}
    schema = (f"doc_id {kinds['doc_id']}, item_id {kinds['item_id']}, n_agree bigint, n_span bigint, "
              "item_tokens bigint, doc_start bigint, doc_end bigint")
    out = None
    for b in range(n_blocks):
        rows = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b).collect()
        rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        index = spark.sparkContext.broadcast(TestIndex([r[0] for r in rows], [r[1] for r in rows], masks))
        part = src.mapInArrow(_scanner(index, min_tokens, min_agree), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _scanner(index, min_tokens: int, min_agree: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = index.value
        for batch, raw, off in B.blocks(batches, "__text"):
            _, _, first, words = _tokens(raw, off)
            doc = B.text_of(first, len(words))
            best: dict[tuple, tuple] = {}
            size, seeds = np.diff(first), _care(ix.masks)
            sparse, dense = _hits(ix, words, doc, size)
            head = np.flatnonzero(np.concatenate([[True], (sparse[1:, :2] != sparse[:-1, :2]).any(1)])) if len(sparse) else []
            jobs = [(*sparse[a, :2].tolist(), sparse[a:z, 2], False) for a, z in zip(head, [*head[1:], len(sparse)])]
            jobs += [(d, i, np.arange(first[d] - ix.first[i + 1] + 1, first[d + 1] - ix.first[i]), True) for d, i in dense.tolist()]
            for d, item, diag, unsure in sorted(jobs, key=lambda j: j[:2]):
                a, z = ix.first[item], ix.first[item + 1]
                los, his = np.maximum(a, first[d] - diag), np.minimum(z, first[d + 1] - diag)
                key = (d, ix.item_ids[item])
                top = best[key][0] if key in best else min_tokens - 1
                mine = None
                # longest diagonals first: one that is not longer than what is found cannot agree more
                for j in np.lexsort((diag, los - his)).tolist():
                    lo, hi, g = int(los[j]), int(his[j]), int(diag[j])
                    if hi - lo < top or (hi - lo == top and (mine is None or g > mine[5])):
                        if hi - lo < top:
                            break
                        continue
                    same = words[lo + g:hi + g] == ix.words[lo:hi]
                    if int(same.sum()) < top or (unsure and not _seeded(same, seeds)):
                        continue
                    x, y = _best_run(same, min_agree)
                    agree = int(same[x:y].sum())
                    if agree > top or (agree == top and mine is not None and g < mine[5]):
                        top = agree
                        mine = (agree, y - x, int(z - a), int(lo + g + x - first[d]), int(lo + g + y - first[d]), g)
                if mine is not None:
                    best[key] = mine[:5]
            if best:
                own = B.ids(batch)
                cols = list(zip(*best.values()))
                yield B.as_table(doc_id=own.take(pa.array([d for d, _ in best])), item_id=pa.array([i for _, i in best]),
                                 n_agree=cols[0], n_span=cols[1], item_tokens=cols[2], doc_start=cols[3], doc_end=cols[4])
    return run


def contaminated_ids(overlaps: DataFrame) -> DataFrame:
    return overlaps.select("doc_id").distinct()

"""Shared helpers: Arrow text columns as byte blocks, word spans and rolling hashes.

Text is handled as the UTF-8 bytes Arrow already holds. One block is a run of
whole documents of a few megabytes (one longer document is a block of its
own), so the arrays of a task are bounded by the block and not by the
partition.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 2 << 20
NO_ID = (1 << 63) - 1  # a null doc_id sorts after every id and counts as one document

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# separators of the looser tokens: everything ASCII that is no letter or digit
PUNCT = np.ones(256, bool)
PUNCT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240229)
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_VALUE_LOWER = BYTE_VALUE[LOWER]
STEP = np.uint64(0x9E3779B97F4A7C15)
STEP_INV = np.uint64(pow(int(STEP), -1, 1 << 64))
GRAM = np.uint64(0xD1342543DE82EF95)
LANES = 8
LANE_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k of eight bytes


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, STEP), np.full(n, STEP_INV)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP**i and its inverse modulo 2**64, for i < n."""
    return _powers(1 << max(16, int(n).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (all bits depend on all bits)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_arrays(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, null as empty; offsets start at 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and len(off) else np.zeros(0, np.uint8)
    return raw, off - off[0] if len(off) else np.zeros(1, np.int64)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES, rows: int = 50_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into blocks of whole rows: (rows, bytes, offsets)."""
    for batch in batches:
        at = 0
        if batch.num_rows == 0:
            continue
        raw, off = text_arrays(batch.column(batch.schema.get_field_index(column)))
        while at < batch.num_rows:
            to = int(np.searchsorted(off, off[at] + limit, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows, at + rows)
            yield batch.slice(at, to - at), raw[off[at]:off[to]], off[at:to + 1] - off[at]
            at = to


def spans(raw: np.ndarray, off: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of non-separator bytes inside each text.

    Returns (start, end, first): byte spans in order and, per text, the index
    of its first span (one more entry than texts).
    """
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~sep[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    begin = word.copy()
    begin[1:] &= ~word[:-1] | edge[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | edge[1:-1]
    start = np.flatnonzero(begin)
    return start, np.flatnonzero(end) + 1, np.searchsorted(start, off)


def prefix_hash(raw: np.ndarray, value: np.ndarray = BYTE_VALUE) -> np.ndarray:
    up, _ = powers(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(value[raw] * up[:len(raw)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, from the prefix sums of its block."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def bytes_hash(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes a step: unlike sums of powers
    modulo 2**64, no family of long strings collides in it. Spans of over
    ``LANES`` steps are hashed one by one.
    """
    size = end - start
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each byte on
    out = mix(size.astype(np.uint64) + STEP)
    at = np.flatnonzero((size > 0) & (size <= 8 * LANES))
    for k in range(0, 8 * LANES, 8):
        at = at[size[at] > k]
        if not len(at):
            break
        out[at] = mix(out[at] ^ (lanes[start[at] + k] & LANE_MASK[np.minimum(size[at] - k, 8)]))
    view = memoryview(raw)
    for i in np.flatnonzero(size > 8 * LANES).tolist():
        out[i] = xxhash.xxh3_64_intdigest(view[start[i]:end[i]])
    return out


def running(x: np.ndarray) -> np.ndarray:
    """Sums of all prefixes modulo 2**64, from the empty one on."""
    out = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=out[1:])
    return out


def grams(words: np.ndarray, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Rolling polynomial hashes of word n-grams; entry i starts at word i."""
    out, cur = {}, words.copy()
    for n in range(1, max(lengths) + 1):
        if n > 1:
            cur = cur[:-1] * GRAM + words[n - 1:] if len(cur) > 1 else cur[:0]
        if n in lengths:
            out[n] = mix(cur)
    return out


def inside(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Mask over n-gram starts: those whose n words lie in one text."""
    m = max(0, total - n + 1)
    ok = np.ones(m, bool)
    for back in range(1, n):  # starts less than n words before a text's end
        at = first[1:] - back
        at = at[(at >= first[:-1]) & (at < m)]
        ok[at] = False
    return ok


def text_of(first: np.ndarray, total: int) -> np.ndarray:
    """Index of the text each span belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))[:total]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the keys that occur at least twice."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    s = np.sort(keys)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = np.unique(twice)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def as_table(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols.values()], list(cols))


def ids(batch: pa.RecordBatch, name: str = "doc_id") -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))

"""Quality rules by repetition coverage.

Rolling hashes of several word n-gram lengths and of the lines are computed
per block of documents in numpy; a document is judged by the share of its
characters that lie inside duplicated n-grams or duplicated lines, and by its
share of symbols.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flurry.llm import blocks as B

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

# largest tolerated share of word characters inside n-grams found twice or
# more in the document (longer repeats are rarer by chance: tighter)
NGRAM_SHARE = {5: 0.25, 7: 0.22, 10: 0.20}
LINE_SHARE = 0.30     # ... inside lines equal to another line
SYMBOL_SHARE = 0.10   # symbols per word
MIN_WORDS = 10
BASE_REPEAT = 0.20

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]


def _block(batch: pa.RecordBatch, raw: np.ndarray, off: np.ndarray, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    n = len(off) - 1
    start, end, first = B.spans(raw, off, B.SPACE)
    total, doc = len(start), B.text_of(first, len(start))
    head = (raw & 0xC0) != 0x80  # first bytes of code points
    chars = np.concatenate([[0], np.cumsum(head & ~B.SPACE[raw])])
    out = {"n_words": np.diff(first), "word_chars": np.diff(chars[off]),
           "n_symbols": np.diff(np.concatenate([[0], np.cumsum(SYMBOLS[raw])])[off])}

    # lines: cut at every \n and at every text's end
    brk = np.flatnonzero(raw == 10)
    lfirst = np.searchsorted(brk, off) + np.arange(n + 1)
    nline = len(brk) + n
    lstart, lend = np.empty(nline, np.int64), np.empty(nline, np.int64)
    own = np.arange(len(brk)) + np.searchsorted(off[1:-1], brk, "right") if n > 1 else np.arange(len(brk))
    lend[own], lstart[own + 1] = brk, brk + 1
    lstart[lfirst[:-1]], lend[lfirst[1:] - 1] = off[:-1], off[1:]
    lchars = chars[lend] - chars[lstart]
    ldoc = B.text_of(lfirst, nline)
    real = np.flatnonzero(lchars > 0)
    key = B.mix(B.bytes_hash(raw, lstart[real], lend[real]) + ldoc[real].astype(np.uint64) * B.STEP)
    order = np.argsort(key, kind="stable")
    same = np.concatenate([[False], key[order][1:] == key[order][:-1]]) if len(order) else np.zeros(0, bool)
    later = real[order[same]]
    out["n_dup_lines"] = np.bincount(ldoc[later], minlength=n)
    twice = real[B.repeated(key)]
    out["dup_line_chars"] = np.bincount(ldoc[twice], lchars[twice], n).astype(np.int64)

    words = B.bytes_hash(raw, start, end)
    salt = doc.astype(np.uint64) * B.STEP
    wchars = chars[end] - chars[start]
    for k, h in B.grams(words, lengths).items():
        covered = np.zeros(total + 1, np.int64)
        if len(h):
            at = np.flatnonzero(B.inside(first, k, total))
            hit = at[B.repeated(B.mix(h[at] + salt[at]))]
            np.add.at(covered, hit, 1)
            np.add.at(covered, hit + k, -1)
        mask = np.cumsum(covered)[:-1] > 0
        out[f"chars_{k}"] = np.bincount(doc[mask], wchars[mask], n).astype(np.int64)
        if k == 5:
            out["n_repeat_words"] = np.bincount(doc[mask], minlength=n)
    return out


def repetition_coverage(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",),
                        shares: dict[int, float] | None = None, line_share: float = LINE_SHARE,
                        symbol_share: float = SYMBOL_SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """Repetition figures of every document and the verdict ``kept``.

    Returns the ``carry`` columns, ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, dup_line_chars``, ``chars_N`` (characters in
    words covered by a duplicated N-gram) for each length, ``base_failed`` and
    ``kept``. One narrow pass, no shuffle; each document is judged by itself,
    so copies and repeated rows get equal results.

    A null or empty text has no words: all figures 0, ``base_failed`` true.
    Columns other than ``text`` and ``carry`` are not read, whatever their
    names. An empty table gives an empty result.
    """
    shares = dict(NGRAM_SHARE if shares is None else shares)
    lengths = tuple(sorted({5, *shares}))
    names = [*FEATURES, *(f"chars_{k}" for k in lengths)]
    src = docs.select(*[F.col(c) for c in dict.fromkeys([*carry, text])])
    schema = ", ".join([*(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in carry),
                        *(f"{c} bigint" for c in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, off in B.blocks(batches, text):
            got = _block(batch, raw, off, lengths)
            yield B.as_table(**{c: B.ids(batch, c) for c in carry},
                             **{c: got[c].astype(np.int64) for c in names})

    out = src.mapInArrow(run, schema)
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > int(100 * BASE_REPEAT) * F.col("n_words"))
    ok = (F.col("dup_line_chars") <= line_share * F.col("word_chars")) & (F.col("n_symbols") <= symbol_share * F.col("n_words"))
    for k, s in shares.items():
        ok = ok & (F.col(f"chars_{k}") <= s * F.col("word_chars"))
    return out.withColumn("base_failed", base).withColumn("kept", ~base & ok)

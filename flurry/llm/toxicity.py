"""Toxicity by a factorization machine over hashed terms.

Terms are the words of a text and their beginnings, hashed into a fixed
space. Term counts per class are gathered over all labelled rows; the terms
that tell the classes apart keep a weight and a factor vector. Pairwise
interactions (an insult together with a group mention) are the products of
factor vectors, which additive weights miss.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flurry.llm import blocks as B
from flurry.session import staged_table

SPACE = 1 << 18       # hashed terms
HEADS = (4, 5, 6)     # lengths in bytes of the word beginnings that are terms too
TERMS = 4096          # terms kept by the model
FACTORS = 8
MAX_ROWS = 20_000     # labelled rows the machine is fitted on (a hash sample); counts use all rows
EPOCHS = 30
RATE = 0.1
DECAY = 1e-4
POSITIVE = 3.0       # weight of a toxic row (they are few, and a miss is worse)
SMOOTH = 2.0         # added to class counts
HALF = 0.5           # share of a term's log-odds its weight starts from
PLANES = SPACE >> 16  # values of a term's bits above the lower 16


def _terms(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, hashed term) pairs of a block, distinct and sorted."""
    start, end, first = B.spans(raw, off, B.PUNCT)
    doc = B.text_of(first, len(start))
    prefix = B.prefix_hash(raw, B.BYTE_VALUE_LOWER)
    own, key = [doc], [B.span_hash(prefix, start, end)]
    for n in HEADS:
        long = np.flatnonzero(end - start > n)
        own.append(doc[long])
        key.append(B.mix(B.span_hash(prefix, start[long], start[long] + n) + np.uint64(n)))
    packed = np.unique(np.concatenate(own) * SPACE + (np.concatenate(key) & np.uint64(SPACE - 1)).astype(np.int64))
    return packed // SPACE, packed % SPACE


def _term_sets(src: DataFrame, keep: str) -> DataFrame:
    """(keep, mark, planes, low): a row's distinct terms in two bytes each. ``low`` holds
    the lower 16 bits of the sorted terms, ``planes`` how many terms have each
    value of the bits above; ``mark`` is a hash of the text."""
    src = src.withColumn("mark", F.pmod(F.xxhash64("__text", F.lit(17)), F.lit(1 << 20)).cast("int"))
    kind = src.schema[keep].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, off in B.blocks(batches, "__text"):
            doc, term = _terms(raw, off)
            k = batch.num_rows
            planes = np.bincount(doc * PLANES + (term >> 16), minlength=k * PLANES).astype(np.uint32).reshape(k, PLANES)
            low, cut = (term & 0xFFFF).astype(np.uint16), np.searchsorted(doc, np.arange(k + 1))
            yield B.as_table(**{keep: batch.column(batch.schema.get_field_index(keep)),
                                "mark": batch.column(batch.schema.get_field_index("mark")),
                                "planes": pa.array([p.tobytes() for p in planes], pa.binary()),
                                "low": pa.array([low[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())})

    return src.mapInArrow(run, f"{keep} {kind}, mark int, planes binary, low binary")


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label of each row, document, term) of a batch with term sets."""
    y, planes, low = (batch.column(batch.schema.get_field_index(c)) for c in ("y", "planes", "low"))
    many = np.frombuffer(b"".join(planes.to_pylist()), np.uint32).astype(np.int64)
    at = np.repeat(np.arange(len(many)), many)
    term = np.frombuffer(b"".join(low.to_pylist()), np.uint16).astype(np.int64) + ((at % PLANES) << 16)
    return y.to_numpy(zero_copy_only=False).astype(np.int64), at // PLANES, term


def _class_counts(sets: DataFrame) -> np.ndarray:
    """Documents of each class by hashed term, over all labelled rows: (2, SPACE + 1); the last column counts documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SPACE), np.int64)
        docs = np.zeros(2, np.int64)
        for batch in batches:
            y, doc, term = _unpacked(batch)
            total += np.bincount(y[doc] * SPACE + term, minlength=2 * SPACE).reshape(2, SPACE)
            docs += np.bincount(y, minlength=2)
        at = np.flatnonzero(total.any(0))
        if docs.any():
            yield B.as_table(term=np.append(at, SPACE), neg=np.append(total[0, at], docs[0]), pos=np.append(total[1, at], docs[1]))

    got = (sets.mapInArrow(run, "term long, neg long, pos long").groupBy("term")
           .agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).toPandas())  # at most SPACE + 1 rows
    out = np.zeros((2, SPACE + 1), np.int64)
    out[0, got.term], out[1, got.term] = got.neg, got.pos
    return out


def _choose(counts: np.ndarray) -> np.ndarray:
    """The terms whose presence tells the classes apart best (chi-squared), in term order."""
    (n0, n1), (a0, a1) = counts[:, -1].astype(float), counts[:, :-1].astype(float)
    p, both = n1 / (n0 + n1), a0 + a1
    spread = both * (1 - both / (n0 + n1)) * p * (1 - p)
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = np.where((both >= 5) & (spread > 0), (a1 - both * p) ** 2 / spread, 0.0)
    top = np.argsort(-chi, kind="stable")[:TERMS]
    return np.sort(top[chi[top] > 4.0])


def _chosen(raw, off, slot) -> tuple[np.ndarray, np.ndarray]:
    doc, term = _terms(raw, off)
    at = slot[term]
    return doc[at >= 0], at[at >= 0]


class FactorizationMachine:
    """score = bias + sum of weights + pairwise products of factors of the terms present."""

    def __init__(self, slot: np.ndarray, bias: float, weight: np.ndarray, factor: np.ndarray):
        self.slot, self.bias, self.weight, self.factor = slot, bias, weight, factor

    def margins(self, n: int, doc: np.ndarray, term: np.ndarray) -> np.ndarray:
        s = np.zeros((n, self.factor.shape[1]))
        np.add.at(s, doc, self.factor[term])
        sq = np.bincount(doc, (self.factor ** 2).sum(1)[term], n)
        return self.bias + np.bincount(doc, self.weight[term], n) + 0.5 * ((s ** 2).sum(1) - sq)

    @classmethod
    def fit(cls, slot: np.ndarray, rows: list[np.ndarray], y: np.ndarray, weight: np.ndarray,
            seed: int = 1) -> FactorizationMachine:
        """Adagrad on the logistic loss; rows: chosen term numbers of each document; weight: where the weights start."""
        rng, m = np.random.default_rng(seed), int(slot.max()) + 1 if len(slot) else 0
        rate = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
        fm = cls(slot, float(np.log(rate / (1 - rate))), weight.copy(), rng.normal(0, 0.05, (m, FACTORS)))
        gw, gv, gb = np.full(m, 1e-6), np.full((m, FACTORS), 1e-6), 1e-6
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for at in range(0, len(order), 128):
                pick = order[at:at + 128]
                doc = np.repeat(np.arange(len(pick)), [len(rows[i]) for i in pick])
                term = np.concatenate([rows[i] for i in pick]) if len(doc) else np.zeros(0, np.int64)
                z = fm.margins(len(pick), doc, term)
                d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) * np.where(y[pick] > 0, POSITIVE, 1.0) / len(pick)
                gb += d.sum() ** 2
                fm.bias -= RATE * d.sum() / np.sqrt(gb)
                if not len(term):
                    continue
                used, inv = np.unique(term, return_inverse=True)
                dw = np.bincount(inv, d[doc], len(used)) + DECAY * fm.weight[used]
                s = np.zeros((len(pick), FACTORS))
                np.add.at(s, doc, fm.factor[term])
                dv = np.zeros((len(used), FACTORS))
                np.add.at(dv, inv, d[doc, None] * (s[doc] - fm.factor[term]))
                dv += DECAY * fm.factor[used]
                gw[used] += dw ** 2
                gv[used] += dv ** 2
                fm.weight[used] -= RATE * dw / np.sqrt(gw[used])
                fm.factor[used] -= RATE * dv / np.sqrt(gv[used])
        return fm


def fit_toxicity(rows: DataFrame, text: str = "text", label: str = "label", max_rows: int = MAX_ROWS,
                 labels: DataFrame | None = None) -> FactorizationMachine:
    """Fit on labelled texts (label 0 or 1; rows with a null label are left out).

    The labels are a column of ``rows``, or of the table ``labels`` (doc_id,
    label; one row a document), which then meets the term sets by doc_id: no
    text is shuffled, and as the labels grow with the documents they are not
    broadcast, at any size. Term counts cover all rows; the machine itself is
    fitted on at most ``max_rows`` of them, chosen by a hash of the text. Only
    the chosen terms of those rows reach the driver. With one class only,
    scores are constant.
    """
    if labels is None:
        sets = _term_sets(rows.filter(F.col(label).isNotNull()).select(F.col(text).alias("__text"), F.col(label).cast("int").alias("y")), "y")
    else:
        labels = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
            "doc_id", F.col(label).cast("int").alias("y"))
        sets = _term_sets(rows.select("doc_id", F.col(text).alias("__text")), "doc_id").join(labels.hint("merge"), "doc_id").drop("doc_id")
    sets = staged_table(sets, "terms")  # read by the counts and by the fit
    counts = _class_counts(sets)
    slot = np.full(SPACE, -1)
    if counts[:, -1].min() > 0:
        terms = _choose(counts)
        slot[terms] = np.arange(len(terms))
    chosen = np.flatnonzero(slot >= 0)
    seen = (counts[:, chosen] + SMOOTH) / (counts[:, -1:] + 2 * SMOOTH)  # over all labelled rows
    weight = HALF * np.log(seen[1] / seen[0])
    share = min(1.0, max_rows / max(1, int(counts[:, -1].sum())))
    part = sets.filter(F.col("mark") < int(share * (1 << 20)) + (share == 1.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, doc, term = _unpacked(batch)
            at = slot[term]
            doc, at = doc[at >= 0], at[at >= 0]
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            yield B.as_table(y=pa.array(y, pa.int32()), terms=pa.array([at[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])], pa.binary()))

    got = sorted(map(tuple, part.mapInArrow(run, "y int, terms binary").collect()))  # bounded by max_rows and TERMS
    y = np.array([r[0] for r in got], float)
    if not len(y):
        n = counts[:, -1]
        return FactorizationMachine(slot, float(np.log((n[1] + 0.5) / (n[0] + 0.5))), np.zeros(TERMS), np.zeros((TERMS, FACTORS)))
    return FactorizationMachine.fit(slot, [np.frombuffer(bytes(r[1]), np.int32).astype(np.int64) for r in got], y, weight)


def score_toxicity(docs: DataFrame, model: FactorizationMachine, text: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) of every row; only the text is an input of the score.

    Null and empty texts get the score of a text without terms. Repeated rows
    get equal scores. An empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SPACE + TERMS * FACTORS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fm = shared.value
        for batch, raw, off in B.blocks(batches, "__text"):
            z = fm.margins(batch.num_rows, *_chosen(raw, off, fm.slot))
            yield B.as_table(doc_id=B.ids(batch), score=1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return docs.select("doc_id", F.col(text).alias("__text")).mapInArrow(run, f"doc_id {kind}, score double")

"""Personal data by candidate generation and gradient boosting, in built-in
expressions and JVM-side trees only.

High-recall generators propose overlapping spans. Candidates that the strict
formats prove right or wrong label themselves; boosted trees learn from them
how such data looks and in which context it stands, and score the candidates
the strict formats don't cover. A threshold per kind, calibrated on a
held-out part, selects what is redacted besides the strict spans.
"""

from __future__ import annotations

import functools
import operator

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flurry.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
# strict formats; runs start only where a run begins or the last match ended, and
# possessive loops take what greedy ones would, so no text costs quadratic time
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# wider nets: national numbers and bare groups, spelled-out addresses, shorter cards, dotted numbers
WIDE = {
    "email": r"(?i)[A-Z0-9._%+-]{2,64}\s?(?:\[at\]|\(at\)| at )\s?[A-Z0-9-]{2,63}\s?(?:\[dot\]|\(dot\)| dot |\.)\s?[A-Z]{2,10}\b",
    "ip": r"(?<![0-9.])[0-9]{1,4}(?:[.,:][0-9]{1,4}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ .-][0-9]{3,6}){2,3}(?![0-9])",
    "phone": r"(?<![0-9+])(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
}
CONTEXT = {"email": "mail|contact|write|@", "ip": "ip|host|server|address|login", "card": "card|pay|visa|credit|iban",
           "phone": "call|phone|tel|fax|mobile"}
AROUND = 24           # code points of context on each side
PRECISION = 0.95      # wanted among held-out candidates above a kind's threshold
MIN_CLASS = 20        # labelled candidates of each class needed to fit at all
SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = F.split(F.reverse(_digits(value)), "")

    def one(x: Column, i: Column) -> Column:
        n = x.cast("int")
        return F.when(i % 2 == 0, n).when(n > 4, 2 * n - 9).otherwise(2 * n)
    return F.aggregate(F.transform(F.filter(d, lambda x: x != ""), one), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "card":
        return n.between(16, 19) & F.when(n.between(16, 19), _luhn(value))
    if kind == "phone":
        return n.between(8, 15)
    if kind == "ip":
        part = F.transform(F.split(value, r"[.]"), lambda x: F.regexp_replace(x, "^0+(?=[0-9])", ""))
        return F.forall(part, lambda x: (F.length(x) <= 3) & (F.when(F.length(x) <= 3, x.cast("int")) <= 255))
    return F.lit(True)


def _found(text: str, kind: str, pattern: str) -> Column:
    """array<struct<kind,start,end,value>> of a pattern's leftmost matches, by the pieces between them."""
    t, p = F.col(text), F.lit(pattern)
    between, match = F.split(t, pattern, -1), F.regexp_extract_all(t, p, F.lit(0))
    sizes = F.arrays_zip(F.slice(F.transform(between, lambda x: F.length(x)), 1, F.size(match)).alias("gap"), match.alias("value"))
    start = F.struct(F.lit(0).cast("long").alias("at"),
                     F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint,value:string>>)").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + x["gap"]
        z = a + F.length(x["value"])
        return F.struct(z.alias("at"), F.concat(acc["out"], F.array(F.struct(
            F.lit(kind).alias("kind"), a.alias("start"), z.alias("end"), x["value"].alias("value")))).alias("out"))
    return F.aggregate(sizes, start, step, lambda a: a["out"])


def _features(rows: DataFrame) -> DataFrame:
    """Format and context of each candidate; the strict tests themselves are not among them."""
    v, before, after = F.col("value"), F.lower("before"), F.lower("after")
    digits = F.length(_digits(v))
    said = functools.reduce(lambda a, k: F.when(F.col("kind") == k, before.rlike(CONTEXT[k])).otherwise(a), KINDS, F.lit(False))
    cols = {
        **{f"f_{k}": F.col("kind") == k for k in KINDS},
        "f_length": F.length(v), "f_digits": digits, "f_share": digits / F.length(v),
        "f_groups": F.size(F.split(v, "[^0-9A-Za-z]+")), "f_letters": F.length(F.regexp_replace(v, "[^A-Za-z]", "")),
        "f_dots": F.length(F.regexp_replace(v, "[^.]", "")), "f_dashes": F.length(F.regexp_replace(v, "[^ -]", "")),
        "f_parens": v.contains("("), "f_plus": v.startswith("+"), "f_at": v.contains("@"),
        "f_zeros": v.rlike("^0"), "f_same": F.size(F.array_distinct(F.split(_digits(v), ""))),
        "f_long_group": F.array_max(F.transform(F.split(v, "[^0-9]+"), lambda x: F.length(x))),
        "f_said": said, "f_glued_left": before.rlike("[a-z0-9]$"), "f_glued_right": after.rlike("^[a-z0-9]"),
        "f_number_left": before.rlike("[0-9][^a-z]{0,2}$"), "f_number_right": after.rlike("^[^a-z]{0,2}[0-9]"),
        "f_unit_right": after.rlike("^\\s?(%|[a-z]{1,2}\\b)"), "f_money": before.rlike("[$€£]\\s?$"),
    }
    return rows.select("*", *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in cols.items()])


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """row, doc_id, base (strict spans) and wide (array of struct(kind, start, end, value, before, after, strict)).

    ``strict``: true for a strict span, false for a strict match that fails its test, null for a wider candidate.
    """
    src = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("t"))
    hits = src
    for k in KINDS:
        need = F.col("t").rlike("[0-9]") if NEEDS[k] is None else F.col("t").contains(NEEDS[k])
        none = F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint,value:string>>)")
        hits = hits.withColumn(f"s_{k}", F.when(need, _found("t", k, STRICT[k])).otherwise(none))
        hits = hits.withColumn(f"w_{k}", F.when(F.col("t").rlike(WIDE[k]), _found("t", k, WIDE[k])).otherwise(none))

    def context(strict: bool, k: str):
        def make(x: Column) -> Column:
            before = F.substr(F.col("t"), F.greatest(x["start"] - AROUND + 1, F.lit(1)).cast("int"),
                              F.least(x["start"], F.lit(AROUND)).cast("int"))
            after = F.substr(F.col("t"), (x["end"] + 1).cast("int"), F.lit(AROUND))
            flag = F.coalesce(_valid(k, x["value"]), F.lit(False)) if strict else F.lit(None).cast("boolean")
            return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"),
                            before.alias("before"), after.alias("after"), flag.alias("strict"))
        return make

    every = F.concat(*[F.transform(f"s_{k}", context(True, k)) for k in KINDS],
                     *[F.transform(f"w_{k}", context(False, k)) for k in KINDS])
    # bare numbers outside a card's length are no card candidates at all
    every = F.filter(every, lambda x: (x["kind"] != "card") | x["strict"].isNull() | (F.length(_digits(x["value"])) >= 12))
    return hits.select(F.monotonically_increasing_id().alias("row"), "doc_id", every.alias("every"))


def _order() -> Column:
    return F.array(*[F.lit(k) for k in KINDS])


def find_personal_data(docs: DataFrame, text: str = "text", precision: float = PRECISION) -> DataFrame:
    """doc_id, base and added: arrays of struct(kind, start, end) in code points, end exclusive,
    ordered by kind as in ``KINDS``, then start; ``added`` also has the ``score``.

    ``base`` are the strict formats (leftmost, non-overlapping, failing
    matches dropped). ``added`` are wider candidates that the trees score at
    least at their kind's threshold and that overlap no strict span. All
    self-labelled candidates take part: a hash holds out a quarter for the
    thresholds, the trees are fitted on the others; with too few of a class
    nothing is added.

    Null and empty texts have no spans. Every row is judged by itself and
    keeps its own result, also with equal or null ids; other columns are not
    read. An empty table gives an empty result.
    """
    found = cut_lineage(candidates(docs, text))
    strict = F.filter("every", lambda x: F.coalesce(x["strict"], F.lit(False)))
    base = F.array_sort(F.transform(strict, lambda x: F.struct(F.array_position(_order(), x["kind"]).alias("k"), x["start"].alias("start"),
                                                               x["end"].alias("end"), x["kind"].alias("kind"))))
    found = found.withColumn("base", F.transform(base, lambda x: F.struct(x["kind"], x["start"], x["end"])).cast(SPAN))
    rows = _features(found.select("row", F.explode("every").alias("c")).select("row", "c.*"))
    scored = _scored(rows, precision)
    if scored is None:
        return found.select("doc_id", "base", F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint,score:double>>)").alias("added"))
    spans = F.array_sort(F.collect_list(F.struct(F.array_position(_order(), F.col("kind")).alias("k"), "start", "end", "kind", "score")))
    extra = scored.groupBy("row").agg(spans.alias("__a"))
    clear = F.filter(F.coalesce("__a", F.expr("cast(array() as array<struct<k:bigint,start:bigint,end:bigint,kind:string,score:double>>)")),
                     lambda a: ~F.exists("base", lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"])))
    return (found.join(extra, "row", "left").withColumn("__a", clear)
            .select("doc_id", "base", F.transform("__a", lambda a: F.struct(a["kind"], a["start"], a["end"], a["score"])).alias("added")))


def _scored(rows: DataFrame, precision: float) -> DataFrame | None:
    """Wider candidates at or above their kind's threshold."""
    names = [c for c in rows.columns if c.startswith("f_")]
    known = rows.filter("strict is not null").withColumn("label", F.col("strict").cast("double"))
    fold = F.pmod(F.xxhash64("value", "before", "start"), F.lit(4))
    known = cut_lineage(VectorAssembler(inputCols=names, outputCol="features")
                        .transform(known).select("kind", "label", "features", fold.alias("fold")))
    count = {r[0]: r[1] for r in known.filter("fold > 0").groupBy("label").count().collect()}
    if min(count.get(0.0, 0), count.get(1.0, 0)) < MIN_CLASS:
        return None
    trees = GBTClassifier(maxIter=20, maxDepth=4, seed=1, cacheNodeIds=False).fit(known.filter("fold > 0"))
    prob = vector_to_array("probability")[1]
    held = trees.transform(known.filter("fold = 0")).select("kind", "label", F.round(prob, 2).alias("p"))
    table = {(r["kind"], r["p"]): (r["n"], r["y"]) for r in
             held.groupBy("kind", "p").agg(F.count("*").alias("n"), F.sum("label").alias("y")).collect()}  # 101 steps a kind
    limits = {}
    for k in KINDS:
        n = y = 0
        for step in sorted((p for kind, p in table if kind == k), reverse=True):
            n, y = n + table[(k, step)][0], y + table[(k, step)][1]
            if y >= precision * n:
                limits[k] = max(step, 0.5)
    if not limits:
        return None
    wide = trees.transform(VectorAssembler(inputCols=names, outputCol="features").transform(rows.filter("strict is null")))
    keep = functools.reduce(operator.or_, [(F.col("kind") == k) & (F.col("score") >= p) for k, p in limits.items()])
    return wide.select("row", "kind", "start", "end", prob.alias("score")).filter(keep)

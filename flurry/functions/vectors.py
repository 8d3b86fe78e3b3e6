"""Array / vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: ImageNet per-channel means in B, G, R order -------------
# The "caffe" preprocessing of VGG-family networks: reorder RGB -> BGR, then
# subtract these means; no scaling.
BGR_MEANS = (103.939, 116.779, 123.68)
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def squared_l2(a, b) -> Column:
    """Sum of squared element differences, in double (F19). A flat L2 index
    reports this squared value, not its root."""
    d = F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double")) ** 2)
    return F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x)


def sq_norm(a) -> Column:
    return F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def flatten_tensor(arr, depth: int = 2) -> Column:
    """Nested arrays -> one flat vector."""
    out = _c(arr)
    for _ in range(depth):
        out = F.flatten(out)
    return out


def caffe_preprocess(rgb_flat) -> Column:
    """Flat interleaved RGB pixels -> BGR with channel means removed."""
    arr = _c(rgb_flat)
    means = F.array(*[F.lit(m) for m in BGR_MEANS])
    # position i holds channel i%3 of pixel i//3; BGR channel c reads RGB 2-c.
    return F.transform(
        arr,
        lambda x, i: F.element_at(arr, (i - F.pmod(i, 3) + (2 - F.pmod(i, 3)) + 1).cast("int")).cast("double")
        - F.element_at(means, (F.pmod(i, 3) + 1).cast("int")))

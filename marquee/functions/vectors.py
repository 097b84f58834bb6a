"""Vector kernels as built-in higher-order column expressions (stay inside codegen, no UDF)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x)


def sqdist(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a, eps: float = 1e-8) -> Column:
    """Normalised vector. The norm sits inside the element lambda, so prefer ``with_normalized`` on
    DataFrames: it computes the norm once per row in its own projection."""
    n = F.greatest(norm(a), F.lit(eps))
    return F.transform(_c(a), lambda x: x / n)


def with_normalized(df, col: str, out: str, eps: float = 1e-8):
    """df with ``out`` = col / max(||col||, eps); the norm is one column, computed once per row."""
    tmp = f"_{out}_norm"
    return (df.withColumn(tmp, F.greatest(norm(col), F.lit(eps)))
            .withColumn(out, F.transform(F.col(col), lambda x: x / F.col(tmp))).drop(tmp))


def cosine(a, b, eps: float = 1e-8) -> Column:
    return dot(a, b) / (F.greatest(norm(a), F.lit(eps)) * F.greatest(norm(b), F.lit(eps)))


# Scorer registry: name -> (column expression builder, larger_is_better). New scorers plug in here;
# the learned head has no expression form and runs in the Arrow block kernel instead.
SCORERS: dict = {
    "cosine": (cosine, True),
    "dot": (dot, True),
    "l2": (sqdist, False),
}


def register_scorer(name: str, build, larger_is_better: bool = True) -> None:
    SCORERS[name] = (build, larger_is_better)


def score(method: str, u, i) -> Column:
    if method not in SCORERS:
        raise ValueError(f"no expression form for scoring method {method!r}")
    return SCORERS[method][0](u, i)


def larger_is_better(method: str) -> bool:
    """Direction of a scoring method: l2 is a squared distance, smaller is better."""
    if method == "learned":
        return True
    return SCORERS[method][1]

"""Scalar projections P1, P5, P6, P8-P12 as column expressions.

All are built-in Spark SQL expressions (codegen, no Python in the hot path);
array work uses higher-order functions (``transform``/``aggregate``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted truthy spellings of a text target, the L2 epsilon,
# the default vector width.
TRUE_WORDS = ["yes", "true", "1"]
L2_EPSILON = 1e-8
DEFAULT_WIDTH = 64


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_time(col, fmt: str | None = None, mode: str = "permissive") -> Column:
    """String -> timestamp (NTZ). 'permissive' maps bad input to NULL,
    'strict' raises on it like the reference's parser."""
    c = _c(col)
    if mode == "strict":
        return F.to_timestamp_ntz(c, F.lit(fmt)) if fmt else F.to_timestamp_ntz(c)
    if mode != "permissive":
        raise ValueError(mode)
    if fmt:
        return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def bool_target(col) -> Column:
    """P5: 1 when lower(text) is one of TRUE_WORDS, else 0 (NULL -> 0).

    Text is taken as is, so '1.0' is 0 (as in the reference). Numeric columns
    are compared ``= 1`` instead (documented deviation)."""
    c = _c(col)
    return F.coalesce(F.lower(c.cast("string")).isin(TRUE_WORDS), F.lit(False)).cast("int")


def narrow_feature(col) -> Column:
    """float32 feature."""
    return _c(col).cast("float")


def narrow_target(col) -> Column:
    """int8 target."""
    return _c(col).cast("tinyint")


def rescale_unit(col) -> Column:
    """Map an expectation in [-1, 1] to a probability in [0, 1]."""
    return (_c(col) + F.lit(1.0)) / F.lit(2.0)


def decide(score, threshold, inclusive: bool = True) -> Column:
    """Score >= t (or > t) as 0/1; NULL/NaN scores decide 0."""
    s = _c(score)
    s = F.nanvl(s, F.lit(None).cast("double"))
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    cmp = (s >= t) if inclusive else (s > t)
    return F.coalesce(cmp, F.lit(False)).cast("int")


def sign_decision(score) -> Column:
    """P10: score > 0 -> 1 else 0."""
    return F.coalesce(_c(score) > 0, F.lit(False)).cast("int")


def signed_label(y) -> Column:
    """P10: label 0/1 -> -1/+1 as 2y-1."""
    return F.lit(2) * _c(y) - F.lit(1)


def l2_norm(vec) -> Column:
    """sqrt of the sum of squares, summed left to right."""
    v = _c(vec)
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalise(vec, epsilon: float = L2_EPSILON) -> Column:
    """X / (||x|| + eps) element-wise (ML Normalizer has no epsilon)."""
    v = _c(vec)
    n = l2_norm(v) + F.lit(float(epsilon))
    return F.transform(v, lambda x: x.cast("double") / n)


def fit_width(vec, width: int = DEFAULT_WIDTH) -> Column:
    """Truncate or right-pad with zeros to exactly ``width`` doubles."""
    v = F.transform(_c(vec), lambda x: x.cast("double"))
    padded = F.concat(v, F.array_repeat(F.lit(0.0), F.lit(width)))
    return F.slice(padded, 1, width)


def assemble_array(cols: list[str], dtype: str = "double") -> Column:
    """Feature columns -> one array column in the given order."""
    return F.array(*[F.col(c).cast(dtype) for c in cols])

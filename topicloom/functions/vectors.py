"""Vectors held as array<double> columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _same_size(a: Column, b: Column, value: Column) -> Column:
    return F.when(F.size(a) == F.size(b), value).otherwise(
        F.raise_error(F.lit("vectors differ in size")).cast("double")
    )


def vec_dot(a: Column | str, b: Column | str) -> Column:
    """Dot product; sizes must match."""
    a, b = _col(a), _col(b)
    total = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).otherwise(_same_size(a, b, total))


def sparse_dot(indices: Column | str, values: Column | str, dense: Column | str) -> Column:
    """Dot product of a sparse vector (indices from 0, values) and a dense one."""
    dense = _col(dense)
    terms = F.zip_with(_col(indices), _col(values), lambda i, v: v * F.element_at(dense, i.cast("int") + 1))
    return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)


def sparse_to_dense(size: Column | int, indices: Column | str, values: Column | str) -> Column:
    """Zero-filled array<double> of a sparse vector."""
    size = F.lit(size) if isinstance(size, int) else size
    filled = F.map_from_arrays(_col(indices), _col(values))
    return F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.coalesce(F.try_element_at(filled, i), F.lit(0.0)))


def vec_norm(a: Column | str) -> Column:
    a = _col(a)
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def vec_scale(a: Column | str, factor: Column | float) -> Column:
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    return F.transform(_col(a), lambda x: x.cast("double") * factor)


def vec_normalize(a: Column | str) -> Column:
    """Divide by the L2 norm; a zero vector gives null."""
    a = _col(a)
    norm = vec_norm(a)
    return F.when(norm > 0, F.transform(a, lambda x: x.cast("double") / norm))


def vec_add(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") + y.cast("double"))


def vec_axpy(alpha: Column | float, x: Column | str, y: Column | str) -> Column:
    """``alpha * x + y``."""
    return vec_add(vec_scale(x, alpha), y)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; null when either vector is zero."""
    return F.try_divide(vec_dot(a, b), vec_norm(a) * vec_norm(b))


def truncate6(a: Column | str) -> Column:
    """Cut every component to six decimals, toward zero."""
    return F.transform(_col(a), lambda x: (x * 1000000).cast("bigint") / F.lit(1000000.0))


def vec_sum(vec: Column | str, weight: Column | str | None = None, size: int | None = None) -> Column:
    """Aggregate: element-wise sum, or the sum of ``weight * vec`` (weights of any sign).

    With the ``size`` of the vectors each component is a plain sum, which hash aggregation keeps
    in fixed-width buffers; without it Spark's summarizer finds the size."""
    v = _col(vec).cast("array<double>")
    if size is not None:
        parts = [v[i] if weight is None else v[i] * _col(weight) for i in range(size)]
        return F.array(*[F.sum(p) for p in parts])
    scaled = v if weight is None else vec_scale(v, _col(weight).cast("double"))
    return vector_to_array(Summarizer.sum(array_to_vector(scaled)))

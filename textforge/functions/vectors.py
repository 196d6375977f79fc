"""Vector maths on array<double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def array_total(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)


def log_softmax(logits: Column) -> Column:
    """Shifted by the maximum, so large logits do not overflow."""
    top = F.array_max(logits)
    norm = F.log(array_total(F.transform(logits, lambda x: F.exp(x - top))))
    # The normaliser is bound once through a one-element array instead of once per element.
    return F.element_at(F.transform(F.array(F.struct(top.alias("m"), norm.alias("n"))),
                                    lambda s: F.transform(logits, lambda x: x - s.m - s.n)), 1)


def softmax(logits: Column) -> Column:
    return F.transform(log_softmax(logits), lambda x: F.exp(x))


def argmax(v: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def cross_entropy(log_probs: Column, label: Column) -> Column:
    return -F.element_at(log_probs, label.cast("int") + 1)


def gather_at(seq: Column, positions: Column) -> Column:
    """Elements of seq at 0-based positions; a position outside is an error."""
    return F.transform(positions, lambda p: F.element_at(seq, p + 1))


def select_layers(layers: Column, indexes: list[int]) -> Column:
    """Layers by 0-based or negative index."""
    return F.array(*[F.element_at(layers, i if i < 0 else i + 1) for i in indexes])


def layer_norm(v: Column, gain: Column | None = None, bias: Column | None = None, eps: float = 1e-12) -> Column:
    """Subtract the mean and divide by the standard deviation of the vector."""
    mean = array_total(v) / F.size(v)
    stats = F.element_at(F.transform(F.array(mean), lambda m: F.struct(
        m.alias("mean"),
        F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m)) / F.size(v) + F.lit(eps)).alias("sd"))), 1)
    normed = F.element_at(F.transform(F.array(stats), lambda s: F.transform(v, lambda x: (x - s.mean) / s.sd)), 1)
    if gain is not None:
        normed = F.zip_with(normed, gain, lambda x, g: x * g)
    if bias is not None:
        normed = F.zip_with(normed, bias, lambda x, b: x + b)
    return normed

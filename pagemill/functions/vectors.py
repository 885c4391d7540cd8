"""Vector expressions over ``ARRAY<FLOAT|DOUBLE>`` columns and Spark ML vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; 0 when either vector is all zeros."""
    lengths = norm(left) * norm(right)
    return F.when(lengths > 0, dot(left, right) / lengths).otherwise(F.lit(0.0))


def l2_normalize(vector: Column) -> Column:
    """Unit length; a zero vector stays as it is."""
    length = norm(vector)
    return F.when(length > 0, F.transform(vector, lambda x: x.cast("double") / length)).otherwise(
        vector.cast("array<double>")
    )


def truncate(vector: Column, dimensions: int) -> Column:
    return F.slice(vector, 1, dimensions)


def _packed(vector: Column, width: int, zero: Column) -> Column:
    """Sign bits in groups of ``width``, most significant first, the last group padded with zeros."""
    full = F.concat(
        F.transform(vector, lambda x: F.when(x > 0, zero + 1).otherwise(zero)),
        F.array_repeat(zero, F.pmod(-F.size(vector), F.lit(width))),
    )
    groups = F.ceil(F.size(vector) / F.lit(width)).cast("int")
    packed = F.transform(
        F.sequence(F.lit(1), groups),
        lambda g: F.aggregate(
            F.slice(full, (g - 1) * width + 1, width), zero, lambda acc, bit: F.shiftleft(acc, 1).bitwiseOR(bit)
        ),
    )
    return F.when(F.size(vector) > 0, packed).otherwise(F.slice(F.array(zero), 1, 0))


def quantize_ubinary(vector: Column) -> Column:
    """One bit per dimension (``x > 0``), packed into ``ARRAY<INT>`` of 0..255."""
    return _packed(vector, 8, F.lit(0))


def sign_words(vector: Column) -> Column:
    """The same bits in 64-bit words, for ``hamming``."""
    return _packed(vector, 64, F.lit(0).cast("bigint"))


def hamming(left_words: Column, right_words: Column) -> Column:
    """Number of differing bits."""
    counts = F.zip_with(left_words, right_words, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(counts, F.lit(0), lambda acc, n: acc + n)


def sparse_entries(vector: Column) -> Column:
    """``(index, value)`` pairs stored in an ML sparse vector, read without making it dense."""
    raw = F.unwrap_udt(vector)
    return F.transform(
        F.arrays_zip(raw["indices"].alias("index"), raw["values"].alias("value")),
        lambda e: F.struct(e["index"].alias("index"), e["value"].alias("value")),
    )

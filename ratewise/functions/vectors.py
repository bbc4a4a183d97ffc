"""Column expressions on dense factor vectors (``array<double>``).

The rank is known when the plan is built, so products and sums are
unrolled into plain arithmetic: they stay inside whole-stage codegen, and
the summation order (left to right from index 0) is fixed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the integer initialisation rule (a Lehmer generator):
# modulus 2^31 - 1 and multiplier 48271.
INIT_MODULUS = 2147483647
INIT_MULTIPLIER = 48271


def init_multipliers(rank: int) -> list[int]:
    """Multiplier of position k is 48271^(k+1) mod (2^31 - 1)."""
    out, m = [], 1
    for _ in range(rank):
        m = (m * INIT_MULTIPLIER) % INIT_MODULUS
        out.append(m)
    return out


def init_vector(id_col: Column, rank: int, seed: int = 0) -> Column:
    """Deterministic uniform [-1, 1) vector per entity id.

    Position k is ((id + 1) * 48271^(k+1) + seed) mod (2^31 - 1), scaled to
    [-1, 1). Integer arithmetic only, so any engine gives the same bits.
    """
    base = id_col.cast("long") + F.lit(1)
    vals = [
        (
            F.pmod(base * F.lit(m) + F.lit(int(seed)), F.lit(INIT_MODULUS)).cast("double")
            / F.lit(float(INIT_MODULUS))
            * F.lit(2.0)
            - F.lit(1.0)
        )
        for m in init_multipliers(rank)
    ]
    return F.array(*vals)


def dot(u: Column, v: Column, rank: int) -> Column:
    """Dot product of two rank-length vectors, summed from index 0."""
    acc = u[0] * v[0]
    for k in range(1, rank):
        acc = acc + u[k] * v[k]
    return acc


def triangle_index(rank: int) -> list[tuple[int, int]]:
    """(a, b) pairs of the upper triangle, row by row."""
    return [(a, b) for a in range(rank) for b in range(a, rank)]


def vector_columns(vec: Column, rank: int, prefix: str = "f", digits: int | None = None):
    """Split a vector into columns f0..f{rank-1}, optionally rounded."""
    cols = []
    for k in range(rank):
        c = vec[k]
        if digits is not None:
            c = F.round(c, digits)
        cols.append(c.alias(f"{prefix}{k}"))
    return cols


def score_text(score: Column) -> Column:
    """A score as text cut (not rounded) to its first 4 characters."""
    return F.substring(score.cast("double").cast("string"), 1, 4)

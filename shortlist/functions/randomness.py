"""Reproducible randomness: a value depends on the key and the seed only.

``rand(seed)`` changes with the partitioning of its input, so a retried or re-partitioned stage
would see other numbers. A hash of the key does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13  # 52 bits: every value is an exact double
SCALE = float(16**HEX_DIGITS)


def uniform(seed: int | str, *keys: Column | str) -> Column:
    """Uniform double in [0, 1)."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k) if isinstance(k, str) else k for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HEX_DIGITS), 16, 10).cast("double") / SCALE


def normal(seed: int | str, *keys: Column | str, mean: float = 0.0, std: float = 1.0) -> Column:
    """Normal double by the Box-Muller transform."""
    radius = F.sqrt(-2.0 * F.log(1.0 - uniform(f"{seed}/r", *keys)))
    angle = F.cos(2.0 * F.pi() * uniform(f"{seed}/a", *keys))
    return radius * angle * std + mean


def gamma_int(seed: int | str, *keys: Column | str, shape: int, scale: float) -> Column:
    """Gamma double for an integer shape: a sum of exponentials."""
    total = F.lit(0.0)
    for j in range(shape):
        total = total - F.log(1.0 - uniform(f"{seed}/{j}", *keys))
    return total * scale


def uniform_sql(seed: int | str, *keys: str) -> str:
    """The SQL text of :func:`uniform` in the check engine's dialect."""
    parts = ", ".join([f"'{seed}'", *[f"({k})::VARCHAR" for k in keys]])
    return f"(('0x' || substr(md5(concat_ws(':', {parts})), 1, {HEX_DIGITS}))::BIGINT / {SCALE!r}::DOUBLE)"


def normal_sql(seed: int | str, *keys: str, mean: float = 0.0, std: float = 1.0) -> str:
    radius = uniform_sql(f"{seed}/r", *keys)
    angle = uniform_sql(f"{seed}/a", *keys)
    return f"(sqrt(-2.0 * ln(1.0 - {radius})) * cos(2.0 * pi() * {angle}) * {std} + {mean})"


def gamma_int_sql(seed: int | str, *keys: str, shape: int, scale: float) -> str:
    terms = " + ".join(f"-ln(1.0 - {uniform_sql(f'{seed}/{j}', *keys)})" for j in range(shape))
    return f"(({terms}) * {scale})"

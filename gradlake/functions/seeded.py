"""Randomness that depends only on a seed and the identity of a value, never on partitioning.

Everything is derived from MD5 text, so a retried task, another partition count or another SQL engine yields the same
numbers.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO_32 = 4294967296.0
WORD_BITS = 30
ORDER_PRIME = 2**30 - 35  # the largest prime below 2 ** WORD_BITS
KEY_BITS = 2 * WORD_BITS


def digest(*parts: Column | int | str) -> Column:
    """MD5 text of the parts joined by ``:``."""
    columns = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *columns))


def order_words(df: DataFrame, row_id: str, seed: int) -> DataFrame:
    """Add two random numbers of 60 bits, ``_high`` and ``_low``, for each row, both from one digest."""
    text = df.withColumn("_text", digest(seed, F.col(row_id)))
    words = {name: F.conv(F.substring("_text", at, 15), 16, 10).cast("bigint") for name, at in (("_high", 1), ("_low", 16))}
    return text.withColumns(words).drop("_text")


def order_key(epoch: Column) -> Column:
    """Sort key of a row in one epoch, from its :func:`order_words`; sorting by it is a random permutation.

    With a number split into two words, ``first * epoch + second`` modulo a prime is uniform, and independent between any two
    epochs. The digest is the costly part and serves all epochs. Equal keys are possible in very large tables, so the row id
    always comes second.
    """

    def part(word: str) -> Column:
        first, second = F.shiftright(word, WORD_BITS), F.col(word).bitwiseAND(F.lit(2**WORD_BITS - 1))
        return (first * epoch + second) % ORDER_PRIME

    return part("_high") * 2**WORD_BITS + part("_low")


def _unit(text: Column, start: int) -> Column:
    """Eight hex digits as a number strictly between 0 and 1."""
    return (F.conv(F.substring(text, start, 8), 16, 10).cast("double") + 0.5) / TWO_32


def uniform(*parts: Column | int | str) -> Column:
    """Uniform number in (0, 1) for the given identity."""
    return _unit(digest(*parts), 1)


def normal(*parts: Column | int | str) -> Column:
    """Standard normal number for the given identity (Box-Muller on two halves of one digest)."""
    text = digest(*parts)
    return F.sqrt(-2.0 * F.log(_unit(text, 1))) * F.cos(2.0 * math.pi * _unit(text, 9))


def uniform_value(*parts: int | str) -> float:
    """The number of :func:`uniform`, computed on the driver for a handful of parameters."""
    text = hashlib.md5(":".join(str(p) for p in parts).encode()).hexdigest()
    return (int(text[:8], 16) + 0.5) / TWO_32

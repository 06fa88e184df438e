"""Hashes that every engine with md5 reproduces.

Draws that depend only on a name, a seed and the row key stay the same under
any partitioning and after a lost executor is recomputed, which ``rand`` does
not promise.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 32
_WORDS_PER_DIGEST = 4
_WORD_MASK = 2**HASH_BITS - 1


def _digest(name: str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{name}|"), key.cast("string")).cast("binary"))


def hash32(name: str, key: Column) -> Column:
    """First 32 bits of md5(name|key) as a bigint in [0, 2^32)."""
    return F.conv(F.substring(_digest(name, key), 1, 8), 16, 10).cast("bigint")


def _words(digest: Column) -> list[Column]:
    """The four 32-bit words of an md5 digest. Turning hex digits into a number
    is the costly part, so two words come from one signed 64-bit number."""
    words = []
    for half in (1, 17):
        both = F.conv(F.substring(digest, half, 16), 16, -10).cast("bigint")
        words += [F.shiftrightunsigned(both, HASH_BITS), both.bitwiseAND(F.lit(_WORD_MASK))]
    return words


def uniforms(name: str, seed: int, key: Column, count: int) -> list[Column]:
    """``count`` independent draws from (0, 1) per row.

    One digest yields four draws, so twenty draws cost five digests.
    """
    n_digests = -(-count // _WORDS_PER_DIGEST)
    words = [w for i in range(n_digests) for w in _words(_digest(f"{name}{i}|{seed}", key))]
    return [(w + F.lit(0.5)) / F.lit(float(2**HASH_BITS)) for w in words[:count]]

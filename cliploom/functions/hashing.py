"""Hash columns: ids, fingerprints and order keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def short_sha1(text: Column, length: int = 24) -> Column:
    return F.substring(F.sha1(text), 1, length)


def short_sha256(text: Column, length: int = 16) -> Column:
    return F.substring(F.sha2(text, 256), 1, length)


def stable_hex(text: Column) -> Column:
    """First 16 hex digits of SHA-1; fixed width, so text order is number order."""
    return F.substring(F.sha1(text), 1, 16)


def stable_mod(text: Column, n: int) -> Column:
    """The unsigned 64-bit number behind ``stable_hex``, modulo ``n``.

    The two 32-bit halves are reduced in long arithmetic; decimals would cost far more.
    """
    digest = F.sha1(text)
    half = lambda start: F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
    return ((half(1) % F.lit(n) * F.lit(2**32 % n) + half(9) % F.lit(n)) % F.lit(n)).cast("int")


def fixed_text(value: Column, digits: int) -> Column:
    """Fixed-point text; negative zero prints as zero."""
    return F.format_string(f"%.{digits}f", F.when(F.abs(value) < 0.5 * 10**-digits, F.lit(0.0)).otherwise(value))


def vector_fingerprint(vector: Column, digits: int = 6, length: int = 24) -> Column:
    return short_sha1(F.array_join(F.transform(vector, lambda v: fixed_text(v, digits)), ","), length)


# Fields of a blueprint signature, in their order.
SIGNATURE_NAMES = ("lower", "torso_channel", "arms", "head", "rhythm", "leading_side")
SIGNATURE_NUMBERS = ("lower_intensity", "torso_intensity", "arm_intensity", "phase")


def blueprint_signature(
    names: Sequence[str] = SIGNATURE_NAMES, numbers: Sequence[str] = SIGNATURE_NUMBERS
) -> Column:
    parts = [F.col(n) for n in names] + [fixed_text(F.col(n), 4) for n in numbers]
    return short_sha1(F.concat_ws("|", *parts), 24)

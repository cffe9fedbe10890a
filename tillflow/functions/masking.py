"""Pseudonyms for personal data: a normalised phone number and a keyed hash, without any UDF."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow.functions.lenient import strip

_BLOCK = 64  # SHA-256 block size in bytes


def normalize_phone(c: Column) -> Column:
    """``+`` and digits only. A leading 8 of 11 digits becomes 7; 10 digits get a 7 in front.

    No digits at all, or NULL, gives an empty string. ``(?U)`` makes ``\\D`` Unicode-aware.
    """
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\D", "")
    national = F.when(
        (F.length(digits) == 11) & F.startswith(digits, F.lit("8")),
        F.concat(F.lit("7"), F.substring(digits, 2, 10)),
    ).when(F.length(digits) == 10, F.concat(F.lit("7"), digits)).otherwise(digits)
    return F.when(digits == "", "").otherwise(F.concat(F.lit("+"), national))


def mask_value(c: Column, key: str | bytes) -> Column:
    """HMAC-SHA256 of the stripped lower-case text, in hex; NULL is hashed as an empty string.

    HMAC is two nested SHA-256 calls over the key xored with two fixed bytes, so it stays inside
    generated code: H(outer ‖ H(inner ‖ message)).
    """
    secret = key.encode() if isinstance(key, str) else key
    if len(secret) > _BLOCK:
        secret = hashlib.sha256(secret).digest()
    secret = secret.ljust(_BLOCK, b"\0")
    inner = F.lit(bytearray(b ^ 0x36 for b in secret))
    outer = F.lit(bytearray(b ^ 0x5C for b in secret))
    text = F.encode(F.lower(strip(F.coalesce(c, F.lit("")))), "UTF-8")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, text), 256))), 256)


def mask_phone(c: Column, key: str | bytes) -> Column:
    """Keyed hash of the normalised number, so differently written numbers still meet."""
    return mask_value(normalize_phone(c), key)

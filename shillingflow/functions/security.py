"""Masking, signing and field encryption as column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .payments import col

# Redaction patterns and their replacements, in the order they apply. Digits, letters and
# word ends are those of any script, so the classes are written out: the engine's short forms know ASCII only.
WORD = r"\p{L}\p{N}_"
REDACTIONS = [
    (rf"(?<![{WORD}])\p{{Nd}}{{10,12}}(?![{WORD}])", "[PHONE_REDACTED]"),
    (r"[A-Za-z0-9]{40,}", "[KEY_REDACTED]"),
    (r'"amount":[\s\p{Z}]*[\p{Nd}.]+', '"amount": [AMOUNT_REDACTED]'),
    (rf"[{WORD}.-]+@[{WORD}.-]+\.[{WORD}]+", "[EMAIL_REDACTED]"),
]


#: Runtime setting of the engine and its value: what plans, event logs and explain() show of keys. HMAC pads are binary
#: literals of 64 bytes; the arguments of AES calls are hidden to the end of their line.
PLAN_REDACTION = ("spark.sql.redaction.string.regex", r"(?i)(?:0x|X')[0-9a-f]{128}'?|aes_?(?:en|de)crypt[^\n]*")


def hide_keys() -> None:
    """Hides keys in the plans of the active session; a setting of one's own is kept and joined to it."""
    spark = SparkSession.getActiveSession()
    if spark is None:
        return
    name, pattern = PLAN_REDACTION
    own = spark.conf.get(name, None)
    if not own:
        spark.conf.set(name, pattern)
    elif pattern not in own:
        spark.conf.set(name, f"{own}|{pattern}")


def redact_text(c) -> Column:
    text = col(c)
    for pattern, replacement in REDACTIONS:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def mask_phone(c) -> Column:
    phone = col(c)
    return F.concat(F.repeat(F.lit("*"), F.greatest(F.length(phone) - 4, F.lit(0))), F.right(phone, F.lit(4)))


def _pads(secret: str) -> tuple[bytes, bytes]:
    key = secret.encode()
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_sha256(message, secret: str) -> Column:
    """Hex HMAC-SHA256 built from two ``sha2`` calls, so it stays inside codegen."""
    hide_keys()
    inner, outer = _pads(secret)
    digest = F.sha2(F.concat(F.lit(inner), F.to_binary(col(message), F.lit("utf-8"))), 256)
    return F.sha2(F.concat(F.lit(outer), F.unhex(digest)), 256)


def signature_status(message, signature, secret: str) -> Column:
    given = col(signature)
    return (
        F.when(given.isNull() | (given == ""), "missing")
        .when(given == hmac_sha256(message, secret), "ok")
        .otherwise("invalid")
    )


def api_signature_status(timestamp, payload, signature, secret: str) -> Column:
    return signature_status(F.concat(col(timestamp), col(payload)), signature, secret)


def encrypt_field(c, key: str) -> Column:
    """AES-GCM with a random nonce, base64 text. ``key`` must be 16, 24 or 32 bytes."""
    if len(key.encode()) not in (16, 24, 32):
        raise ValueError("the field key must be 16, 24 or 32 bytes")
    hide_keys()
    return F.base64(F.aes_encrypt(col(c), F.lit(key)))


def decrypt_field(c, key: str) -> Column:
    """Null when the text was not produced with ``key``."""
    hide_keys()
    cipher = F.try_to_binary(col(c), F.lit("base64"))
    return F.try_aes_decrypt(cipher, F.lit(key)).cast("string")

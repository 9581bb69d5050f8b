"""Field encryption, decryption and keyed hashing as built-in expressions."""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import Column, functions as F

# --- fixed values: they must equal those of the systems that share the data ---
PBKDF2_ROUNDS = 65536
KEY_BYTES = 32
IV_BYTES = 16
AES_MODE = "CBC"
AES_PADDING = "DEFAULT"  # PKCS#5
HMAC_BLOCK = 64
# ------------------------------------------------------------------------------


@lru_cache(maxsize=256)
def derive_key(secret: str) -> bytes:
    """PBKDF2-HMAC-SHA256 with the secret as its own salt; once per secret."""
    raw = secret.encode("utf-8")
    return hashlib.pbkdf2_hmac("sha256", raw, raw, PBKDF2_ROUNDS, KEY_BYTES)


def parse_iv(text: str | None) -> bytes:
    """Comma list of signed bytes; empty means 16 zero bytes."""
    if not text:
        return bytes(IV_BYTES)
    values = [int(v) for v in text.split(",")]
    if any(v < -128 or v > 127 for v in values):
        raise ValueError("IV values are signed bytes")
    if len(values) != IV_BYTES:
        raise ValueError(f"the IV has {IV_BYTES} bytes, got {len(values)}")
    return bytes(v & 0xFF for v in values)


def encrypt(value: Column, secret: str, iv: bytes) -> Column:
    """AES-256/CBC/PKCS5 with a fixed IV, as base64 text.

    Equal plaintexts give equal ciphertexts, so encrypted columns still join.
    """
    sealed = F.aes_encrypt(
        F.encode(value, "UTF-8"), F.lit(derive_key(secret)), F.lit(AES_MODE), F.lit(AES_PADDING), F.lit(iv)
    )
    # Spark writes the IV in front of the ciphertext
    return F.base64(F.substring(sealed, IV_BYTES + 1, 2**31 - 1))


def decrypt(value: Column, secret: str, iv: bytes) -> Column:
    """Inverse of :func:`encrypt`; null when the text does not decrypt."""
    sealed = F.concat(F.lit(iv), F.try_to_binary(value, F.lit("base64")))
    plain = F.try_aes_decrypt(sealed, F.lit(derive_key(secret)), F.lit(AES_MODE), F.lit(AES_PADDING))
    # a wrong key can leave valid padding around bytes that are not text
    return F.try_validate_utf8(plain.cast("string"))


def keyed_hash(value: Column, secret: str) -> Column:
    """HMAC-SHA256 as lower-case hex, built from two SHA-256 calls."""
    inner_pad, outer_pad = hmac_pads(secret)
    inner = F.sha2(F.concat(F.lit(inner_pad), F.encode(value, "UTF-8")), 256)
    return F.sha2(F.concat(F.lit(outer_pad), F.unhex(inner)), 256)


def hmac_pads(secret: str) -> tuple[bytes, bytes]:
    key = secret.encode("utf-8")
    if len(key) > HMAC_BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(HMAC_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)

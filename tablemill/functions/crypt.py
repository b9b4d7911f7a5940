"""AES encryption of single column values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablemill.functions.text import base64_text

# Fixed value: initialisation vector of sixteen zero digits.
FIXED_IV = b"0" * 16
BLOCK = 16


def _key(key: str) -> Column:
    return F.unbase64(F.lit(key))


def encrypt_column(
    c: Column,
    key: str,
    mode: str = "CBC",
    codepage: str = "UTF-8",
    iv: bytes = FIXED_IV,
    zero_pad: bool = False,
    truncate: int | None = None,
) -> Column:
    """Base64 of the AES ciphertext of a text column; ``key`` is base64.

    CBC starts with a fixed vector, so that equal values stay equal and can be
    joined; Spark puts the vector in front, which is cut off. ECB adds no padding
    block to text that fills its blocks, as blocks are independent the extra one
    is cut off too. ``zero_pad`` fills up with NUL characters first (ECB only).
    """
    if mode == "CBC":
        sealed = F.aes_encrypt(
            F.encode(c, codepage), _key(key), F.lit("CBC"), F.lit("PKCS"), F.lit(iv)
        )
        sealed = F.substring(sealed, BLOCK + 1, 2**31 - 1)
    elif mode == "ECB":
        if zero_pad:
            fill = (F.length(c) + BLOCK - F.length(c) % BLOCK).cast("int")
            c = F.rpad(c, fill, F.lit("\0"))
        plain = F.encode(c, codepage)
        size = F.octet_length(plain)
        sealed = F.aes_encrypt(plain, _key(key), F.lit("ECB"), F.lit("PKCS"))
        sealed = F.when(size % BLOCK == 0, F.substring(sealed, F.lit(1), size)).otherwise(sealed)
    else:
        raise ValueError(f"mode {mode!r} is not supported")
    text = base64_text(sealed)
    return text if truncate is None else F.substring(text, 1, truncate)


def decrypt_column(
    c: Column, key: str, mode: str = "CBC", codepage: str = "UTF-8", iv: bytes = FIXED_IV
) -> Column:
    """Text of a value sealed by ``encrypt_column``; trailing NULs are removed."""
    sealed = F.unbase64(c)
    if mode == "CBC":
        plain = F.aes_decrypt(F.concat(F.lit(iv), sealed), _key(key), F.lit("CBC"), F.lit("PKCS"))
    elif mode == "ECB":
        # Spark insists on a padded last block: append one, so that unpadded
        # ciphertext opens as well, then take off padding the value itself has.
        end = F.aes_encrypt(F.lit(b""), _key(key), F.lit("ECB"), F.lit("PKCS"))
        plain = F.aes_decrypt(F.concat(sealed, end), _key(key), F.lit("ECB"), F.lit("PKCS"))
        digits = F.hex(plain)
        count = F.conv(F.right(digits, F.lit(2)), 16, 10).cast("int")
        padded = count.between(1, BLOCK) & (
            F.right(digits, count * 2) == F.repeat(F.right(digits, F.lit(2)), count)
        )
        plain = F.when(
            padded, F.substring(plain, F.lit(1), F.octet_length(plain) - count)
        ).otherwise(plain)
    else:
        raise ValueError(f"mode {mode!r} is not supported")
    return F.rtrim(F.decode(plain, codepage), F.lit("\0"))

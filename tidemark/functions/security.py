"""AES-256-CBC columns in Base64, as Spark's own functions.

Keys come from Spark conf at run time. The fixed initial vector is for reading and
writing columns of older systems; it makes equal values encrypt equally, so ``encrypt``
uses a random vector, stored in front of the cipher text, unless one is given.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

KEY_CONF = "spark.tidemark.aes.key"
_IV_BYTES = 16


def key_from_conf(spark: SparkSession, name: str = KEY_CONF) -> Column:
    """The key, Base64 in the conf, as a binary column."""
    return F.unbase64(F.lit(spark.conf.get(name)))


def _one_line(binary: Column) -> Column:
    """Base64 without the line breaks Spark puts after every 76 characters."""
    return F.replace(F.base64(binary), F.lit("\r\n"), F.lit(""))


def encrypt(text: Column, key: Column, iv: Column | None = None) -> Column:
    if iv is None:
        return _one_line(F.aes_encrypt(text, key, F.lit("CBC"), F.lit("PKCS")))
    sealed = F.aes_encrypt(text, key, F.lit("CBC"), F.lit("PKCS"), iv)
    return _one_line(F.substring(sealed, _IV_BYTES + 1, 2**31 - 1 - _IV_BYTES))


def decrypt(cipher: Column, key: Column, iv: Column | None = None) -> Column:
    """The text, or null when the key or the cipher text is wrong."""
    sealed = F.unbase64(cipher)
    if iv is not None:
        sealed = F.concat(iv, sealed)
    return F.try_aes_decrypt(sealed, key, F.lit("CBC"), F.lit("PKCS")).cast("string")


def decrypt_value(cipher: Column, key: Column, iv: Column | None = None) -> Column:
    """The field ``value`` of encrypted JSON."""
    return F.get_json_object(decrypt(cipher, key, iv), "$.value")

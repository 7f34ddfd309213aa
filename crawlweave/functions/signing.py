"""HMAC-SHA256 out of Spark's own SHA-256.

Spark has no HMAC function. The key pads are computed once on the driver and
reach the executors through a one-row scalar subquery, so that no key is
printed in a plan.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BLOCK = 64


def pads(secret: str | bytes) -> tuple[bytes, bytes]:
    key = secret.encode() if isinstance(secret, str) else secret
    if len(key) > BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_hex(body: Column, inner: Column, outer: Column) -> Column:
    """Upper-case hex digest of bytes ``body``."""
    first = F.unhex(F.sha2(F.concat(inner, body), 256))
    return F.upper(F.sha2(F.concat(outer, first), 256))


def verify_signature(
    df: DataFrame, secrets: Sequence[str], body: str = "raw", signature: str = "signature", out: str = "verified"
) -> DataFrame:
    """Add ``out``: the signature is that of the raw body under any of the secrets.

    The body must be the bytes as received; a re-serialized JSON has another signature.
    """
    spark = df.sparkSession
    keys = spark.createDataFrame([(bytearray(i), bytearray(o)) for i, o in map(pads, secrets)], "i binary, o binary")
    # one row per configured secret; a handful by nature
    holder = keys.agg(F.collect_list(F.struct("i", "o")).alias("k")).scalar()
    payload = F.col(body).cast("binary")
    return df.withColumn("_keys", holder).withColumn(
        out,
        # without a signature no digest is worked out
        F.coalesce(F.when(F.col(signature).isNotNull(), F.exists("_keys", lambda k: hmac_hex(payload, k["i"], k["o"]) == F.col(signature))), F.lit(False)),
    ).drop("_keys")

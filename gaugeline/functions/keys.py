"""Hash columns that give the same value on every run, whatever the partitioning.

``rand()``, ``randomSplit`` and ``sample`` depend on which partition a row lands
in, so a recomputed task may pick other rows.  Everything random in this package
is instead a function of a row key and a seed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_RANGE = 1 << 32


def row_key(*columns: str) -> Column:
    """Text key from integer or string columns (doubles print differently per engine)."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def digest(key: Column | str, *salts: object) -> Column:
    """Hex md5 of the key, joined with any salts."""
    key = F.col(key) if isinstance(key, str) else key
    parts = [key, *[s if isinstance(s, Column) else F.lit(str(s)) for s in salts]]
    return F.md5(F.concat_ws("|", *parts) if salts else key)


def digest_word(hex_digest: Column, word: int = 0) -> Column:
    """One of the four 32-bit words of a hex md5 as a bigint in [0, 2^32)."""
    return F.conv(F.substring(hex_digest, 1 + 8 * word, 8), 16, 10).cast("bigint")


def bucket32(key: Column | str, *salts: object) -> Column:
    return digest_word(digest(key, *salts))


def unit_interval(key: Column | str, *salts: object) -> Column:
    """Uniform double in [0, 1)."""
    return bucket32(key, *salts) / F.lit(float(BUCKET_RANGE))


def hash_bucket(key: Column | str, buckets: int, *salts: object) -> Column:
    return (bucket32(key, *salts) % F.lit(buckets)).cast("int")

"""Identifiers and digests of records, pages and chunks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lathework.functions.text import Name, col, normalize, or_empty

#: The published name space of URLs for version 5 identifiers.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def hash_normalized(c: Name) -> Column:
    return F.md5(normalize(or_empty(c)).cast("binary"))


def pair_key(instruction: Name, output: Name) -> Column:
    """Digest of a pair as it is, with a colon between."""
    return F.md5(F.concat(or_empty(instruction), F.lit(":"), or_empty(output)).cast("binary"))


def plain_pair_key(instruction: Name, output: Name) -> Column:
    """Digest of a pair without anything between."""
    return F.md5(F.concat(or_empty(instruction), or_empty(output)).cast("binary"))


def order_key(instruction: Name, output: Name) -> Column:
    """The digest that datasets are ordered by."""
    return F.sha2(F.concat(or_empty(instruction), or_empty(output)).cast("binary"), 256)


def document_id(url: Name) -> Column:
    return F.substring(F.sha2(col(url).cast("binary"), 256), 1, 12)


def page_file(url: Name) -> Column:
    return F.concat(F.sha2(col(url).cast("binary"), 256), F.lit(".html"))


def url_hash(url: Name) -> Column:
    return F.substring(F.md5(col(url).cast("binary")), 1, 12)


def uuid5(*parts: Name) -> Column:
    """Version 5 identifier of the parts joined by hyphens, in the name space of URLs."""
    name = F.concat_ws("-", *[col(p).cast("string") for p in parts])
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), name.cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)))
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 19, 2)), F.substring(digest, 21, 12)
    )


def pick(key: Name, seed: str, of: int) -> Column:
    """A number from 1 to ``of`` drawn from a key, the same in every run and engine."""
    digest = F.md5(F.concat(F.lit(seed), col(key).cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % of + 1).cast("int")


def in_validation(key: Name, share: float, seed: str = "split") -> Column:
    """Whether a record falls into the validation split, by its key alone."""
    return pick(key, seed, 10_000) <= int(share * 10_000)

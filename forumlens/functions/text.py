"""Text and tag-string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col

# The characters Unicode calls white space.
WHITE_SPACE = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def stripped(c: Column | str) -> Column:
    return F.trim(col(c), F.lit(WHITE_SPACE))


def text_or(c: Column | str, default: str) -> Column:
    return stripped(F.coalesce(col(c), F.lit(default)))


def tags_clean(c: Column | str) -> Column:
    """``<a><b>`` becomes ``a|b``; NULL becomes the empty string."""
    joined = F.regexp_replace(F.coalesce(col(c), F.lit("")), "><", "|")
    return F.regexp_replace(joined, "[<>]", "")


def tag_parts(c: Column | str) -> Column:
    return F.split(col(c), r"\|")


def tag_count(c: Column | str) -> Column:
    """Number of parts; the empty string has one (empty) part."""
    return F.size(tag_parts(c)).cast("long")


def primary_tag(c: Column | str) -> Column:
    return F.get(tag_parts(c), F.lit(0))


def normal_tag(c: Column | str) -> Column:
    return F.lower(stripped(c))


def stable_key(c: Column | str) -> Column:
    """Non-negative 64-bit key that is the same for the same text in every run."""
    return F.xxhash64(col(c)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))

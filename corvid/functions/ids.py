"""Identities of entities. All but the global object id are built-in hashes; that one needs BLAKE2b."""

from __future__ import annotations

import hashlib
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

ID_SPACE = 10**38 - 1


@F.pandas_udf(DecimalType(38, 0))
def _blake(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else Decimal(int.from_bytes(hashlib.blake2b(t.encode(), digest_size=16).digest(), "big") % ID_SPACE))


def goid(repo: Column, commit: Column, language: Column, path: Column, kind: Column, qualname: Column, start: Column, end: Column) -> Column:
    """128-bit BLAKE2b of the joined fields, reduced to 38 decimal digits; a missing end is written as None."""
    parts = [repo, commit, language, path, kind, qualname, start.cast("string"), F.coalesce(end.cast("string"), F.lit("None"))]
    return _blake(F.concat_ws(":", *parts))


def urn(repo: Column, path: Column, language: Column, kind: Column, qualname: Column, start: Column, end: Column) -> Column:
    head = F.concat(F.lit("goid:"), repo, F.lit("/"), path, F.lit("#"), language, F.lit(":"), kind, F.lit(":"), qualname, F.lit("?s="), start.cast("string"))
    return F.concat(head, F.coalesce(F.concat(F.lit("&e="), end.cast("string")), F.lit("")))


def stable_id(repo: Column, path: Column, language: Column, kind: Column, qualname: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", repo, path, language, kind, qualname), 256), 1, 20)


def dependency_id(repo: Column, commit: Column, library: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws(":", repo, commit, library)), 1, 16)


def subsystem_id(repo: Column, modules: Column) -> Column:
    return F.substring(F.sha2(F.concat(repo, F.lit(":"), F.array_join(F.array_sort(modules), ",")), 256), 1, 16)


def module_name(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"\.py$", ""), "/", ".")

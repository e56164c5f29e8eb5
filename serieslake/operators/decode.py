"""Decode coded columns through lookup tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serieslake.functions import clean, label, or_text


@dataclass(frozen=True)
class Lookup:
    """A code list: ``on`` names the fact column that holds ``code`` (default: the same name)."""

    table: DataFrame
    code: str
    text: str
    unknown: str
    on: str | None = None

    @property
    def fact(self) -> str:
        return self.on or self.code

    def pair(self) -> DataFrame:
        # Only code and text take part, so that equal display columns never collide.
        return self.table.select(F.col(self.code).alias(f"_{self.code}"), F.col(self.text))


def decode(facts: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Left-join each lookup's text; rows with unknown or NULL codes stay, with NULL text.

    There is no broadcast hint: Catalyst broadcasts a lookup only when its size is known to
    be below the threshold, and otherwise joins by shuffle, where adaptive execution splits
    a code that holds too many rows.
    """
    for lookup in lookups:
        pair = lookup.pair()
        match = facts[lookup.fact] == pair[f"_{lookup.code}"]
        facts = facts.join(pair, match, "left").drop(f"_{lookup.code}")
    return facts


def labelled(decoded: DataFrame, lookups: Sequence[Lookup], template: str, name: str) -> DataFrame:
    """Add a text built from the decoded parts; a missing part reads as its ``unknown`` text."""
    parts = {lookup.text: or_text(lookup.text, lookup.unknown) for lookup in lookups}
    return decoded.withColumn(name, label(template, parts))


def duplicate_codes(lookup: Lookup) -> DataFrame:
    """Codes listed more than once; they would multiply the decoded rows."""
    return lookup.table.groupBy(F.col(lookup.code).alias("code")).agg(F.count("*").alias("n")).filter(
        "code IS NOT NULL AND n > 1"
    )


def unknown_codes(facts: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Codes without a text and how many rows carry them, for all lookups in one pass.

    The codes are counted before the join, so that a heavy code is one row of it.
    """
    each = F.array(*[F.struct(F.lit(x.text).alias("lookup"), F.col(x.fact).alias("code")) for x in lookups])
    used = facts.select(F.inline(each)).groupBy("lookup", "code").agg(F.count("*").alias("n"))
    listed = [x.table.select(F.lit(x.text).alias("lookup"), F.col(x.code).alias("code")) for x in lookups]
    return used.join(reduce(DataFrame.unionAll, listed), ["lookup", "code"], "left_anti")


def split_codes(df: DataFrame, codes: str, *, sep: str = ",", code: str = "footnote_code") -> DataFrame:
    """One row per code of a delimited code list; rows without codes stay once, with NULL."""
    items = F.filter(F.transform(F.split(F.col(codes), sep), clean), lambda c: c != "")
    return df.withColumn(code, F.explode_outer(items))


def decode_list(df: DataFrame, codes: str, lookup: Lookup, *, sep: str = ",") -> DataFrame:
    """Split a delimited code list and decode each code."""
    rows = decode(split_codes(df, codes, sep=sep, code=lookup.fact), [lookup])
    text = F.when(F.col(lookup.fact).isNotNull(), or_text(lookup.text, lookup.unknown))
    return rows.withColumn(lookup.text, text)

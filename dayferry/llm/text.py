"""What the operators share about texts: words, sizes, and hash splits of ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def word_array(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often a lambda inside refers to it."""
    return F.transform(F.array(value), use)[0]


ROW = "__row"


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one, so that names the operators use inside can't clash with them."""
    return F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns]).alias(ROW)


def unpacked(rows: DataFrame, docs: DataFrame, **added: Column) -> DataFrame:
    """The packed columns and those added; an added column replaces one of its name."""
    names = {a.lower() for a in added}
    kept = [F.col(ROW).getField(c).alias(c) for c in docs.columns if c.lower() not in names]
    return rows.select(*kept, *[v.alias(k) for k, v in added.items()])

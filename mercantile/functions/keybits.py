"""A key set as bitmaps: a bounded filter in front of an exact join.

Every key sets one bit.  Bits follow the keys (``PER_KEY`` each) up to ``BITS``, held
as bitmaps of 4 KB (8 MB in all, however many keys there are), so the bitmaps may
be broadcast.  A row whose bit is clear holds none of the keys and needs no
shuffle; the others, the rows of the keys and a few by chance, go to the exact
join.  Beyond some millions of keys most bits are set and the filter passes more:
dearer, never wrong.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..session import written

BITS = 1 << 26
PER_KEY = 256  # bits a key while BITS lasts: one row in 256 passes by chance
BITMAP = 1 << 15  # bits of one bitmap of bitmap_construct_agg


class KeyBits(NamedTuple):
    bitmaps: DataFrame  # (_bucket, _bits)
    bits: int


def _bit(df: DataFrame, column: str, bits: int) -> str:
    """The bit of a key; whole numbers of any width agree."""
    kind = "BIGINT" if isinstance(df.schema[column].dataType, IntegralType) else "STRING"
    return f"pmod(xxhash64(CAST(`{column}` AS {kind})), {bits}L)"


def key_bits(keys: DataFrame, column: str) -> KeyBits:
    """The bitmaps of the distinct, written keys in ``column``, written too."""
    bits = min(BITS, max(BITMAP, 1 << (PER_KEY * keys.count()).bit_length()))
    bit = _bit(keys, column, bits)
    return KeyBits(written(keys.where(F.col(column).isNotNull())
                           .groupBy(F.expr(f"{bit} DIV {BITMAP} AS _bucket"))
                           .agg(F.expr(f"bitmap_construct_agg({bit} % {BITMAP}) AS _bits"))), bits)


def with_flag(df: DataFrame, column: str, keys: KeyBits, flag: str) -> DataFrame:
    """``df`` with a column that is false where ``column`` holds none of the keys."""
    bit = _bit(df, column, keys.bits)
    mine = F.broadcast(keys.bitmaps.toDF(f"{flag}_bucket", f"{flag}_bits"))
    byte = f"CAST(conv(hex(substring({flag}_bits, CAST({bit} % {BITMAP} DIV 8 AS INT) + 1, 1)), 16, 10) AS INT)"
    passes = f"`{column}` IS NOT NULL AND coalesce(getbit({byte}, CAST({bit} % 8 AS INT)) = 1, false) AS {flag}"
    return (df.join(mine, F.expr(f"{bit} DIV {BITMAP} = {flag}_bucket"), "left")
            .select(*df.columns, F.expr(passes)))


def split(df: DataFrame, keys: list[tuple[str, KeyBits]]) -> tuple[DataFrame, DataFrame]:
    """(rows that hold none of the keys, rows that may) for a list of
    (column, key bitmaps); rows keep their columns."""
    columns, flagged = df.columns, df
    for i, (column, bits) in enumerate(keys):
        flagged = with_flag(flagged, column, bits, f"_maybe{i}")
    some = F.expr(" OR ".join(f"_maybe{i}" for i in range(len(keys))))
    return flagged.where(~some).select(*columns), flagged.where(some).select(*columns)

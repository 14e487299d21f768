"""Dense ranks by counting bits.

A key's distinct positions (calendar months, days) are set bits of bitmaps, 64 positions to a word.  Words are built by
an aggregate with map-side combine on (key, word), so a hot key is spread over its words and never sorted; a key then
holds one short sorted list of words with the number of bits before each, and a row's rank is that number plus the
bits up to its own in its word.  However many ranks are asked for, that is one pass over the rows, one list a key
and one join back, without a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmart.functions.dates import col

# A word's code: the bitmap it belongs to, then its place in it.  Parts and positions lie within PART_LIMIT either way;
# the limit itself stands for a null position.
PLACE_BITS, RANK_BITS, PART_LIMIT = 18, 4, 1 << 22


def day_number(c) -> Column:
    return F.unix_date(col(c)).cast("long")


def month_number(c) -> Column:
    return (F.year(col(c)) * 12 + F.month(col(c)) - 1).cast("long")


def _bitmap(number: int, part: Column | None) -> Column:
    """Which bitmap of a key: rank ``number``, and within it the part; ranks without parts come first."""
    own = F.lit(number).cast("long")
    return own if part is None else (F.coalesce(part, F.lit(-PART_LIMIT)) + F.lit(PART_LIMIT + 1)) * (1 << RANK_BITS) + own


def _code(number: int, part: Column | None, position: Column) -> Column:
    place = F.floor(position / 64).cast("long") + (1 << PLACE_BITS - 1)
    return _bitmap(number, part) * (1 << PLACE_BITS) + place


def _in_word(position: Column) -> Column:
    return F.pmod(position, F.lit(64)).cast("int")


def _left(value: int, by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(value).cast("long"), by)


def bitmap_ranks(df: DataFrame, key: str, ranks: dict[str, tuple[Column | None, Column]]) -> DataFrame:
    """Dense ranks within ``key``: result column -> (part, position), both whole numbers below ``PART_LIMIT``.

    The rank of a position is counted among the key's rows of the same part (None: all of them; a null part is a part).
    ``key`` is a number or text.  A null position comes last; a row without a key has no rank.
    """
    ranks = {name: (part, F.coalesce(at, F.lit(PART_LIMIT))) for name, (part, at) in ranks.items()}
    words = F.array(*[F.struct(_code(k, part, at).alias("code"), _left(1, _in_word(at)).alias("bit"))
                      for k, (part, at) in enumerate(ranks.values())])
    # Rows without a key have no words and get no rank, but go along as key 0: a filter for null keys, here or by the join, would be put on
    # one of the two sides, and where rows are moved before they come here, one exchange serves both.
    has_key = F.col(key).isNotNull()
    df = df.withColumn("__own", F.coalesce(F.col(key), F.lit("0").cast(dict(df.dtypes)[key])))
    cells = (df.select(F.col("__own").alias("__key"), F.explode(F.when(has_key, words)).alias("w"))
             .groupBy("__key", F.col("w.code").alias("code")).agg(F.bit_or("w.bit").alias("bits")))
    lists = cells.groupBy("__key").agg(F.sort_array(F.collect_list(F.struct("code", "bits"))).alias("w"))
    before = F.aggregate("w.bits", F.array(F.lit(0)), lambda seen, b: F.concat(seen, F.array(F.element_at(seen, -1) + F.bit_count(b))))
    lists = lists.select("__key", F.col("w.code").alias("__codes"), F.col("w.bits").alias("__bits"), before.alias("__before"),
                         F.transform("w.code", lambda c: F.shiftright(c, PLACE_BITS)).alias("__bitmaps"))
    out = df.join(lists, (F.col("__own") == F.col("__key")) & has_key, "left")
    found = {}
    for k, (name, (part, at)) in enumerate(ranks.items()):
        word = (F.array_position("__codes", _code(k, part, at)) - 1).cast("int")
        first = (F.array_position("__bitmaps", _bitmap(k, part)) - 1).cast("int")
        # All bits up to the own one.
        own = F.get("__bits", word).bitwiseAND(F.bitwise_not(_left(-2, _in_word(at))))
        found[name] = F.get("__before", word) - F.get("__before", first) + F.bit_count(own)
    return out.withColumns(found).drop("__own", "__key", "__codes", "__bits", "__before", "__bitmaps")

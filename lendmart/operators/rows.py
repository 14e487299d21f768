"""Row selection, history and reshaping operators.

Skew rules used throughout:

* top-1 / top-n per key is ``row_number() <= n``; Spark prunes every map task's output
  to n rows per key before the shuffle, so a hot key costs n rows per task;
* values of a group are computed by an aggregate with map-side combine and, where they
  must sit next to the rows, joined back (adaptive skew join splits hot keys) instead of
  a whole-group window;
* ranks are computed over distinct calendar positions, never over raw rows;
* no broadcast hint: small sides are broadcast by static or measured size only.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendmart.functions.dates import col


def _names(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def active_only(df: DataFrame, flag: str = "deleted", tolerate_null: bool = False) -> DataFrame:
    """Drop soft-deleted rows; with ``tolerate_null`` rows without a flag stay."""
    keep = F.col(flag) == "N"
    return df.filter(keep | F.col(flag).isNull()) if tolerate_null else df.filter(keep)


def drop_exact_duplicates(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """One row per natural id, or per full row when there is none."""
    return df.dropDuplicates([id_col]) if id_col else df.dropDuplicates()


def first_n_by(df: DataFrame, keys, order, n: int, number_as: str) -> DataFrame:
    """The first ``n`` rows of each key in ``order`` with their number."""
    w = Window.partitionBy(*_names(keys)).orderBy(*order)
    return df.withColumn(number_as, F.row_number().over(w)).filter(F.col(number_as) <= n)


def latest_by(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the first in ``order`` (pass descending columns, end with a unique one)."""
    return first_n_by(df, keys, order, 1, "__rn").drop("__rn")


def latest_value(df: DataFrame, key: str, specs: dict, when: str = "id") -> DataFrame:
    """Newest attribute values per key, all attributes in one grouped pass.

    ``specs``: result column -> (row condition, value expression).  The value of the row
    with the highest ``when`` among the matching rows is taken, NULL values included.
    """
    cond = None
    for pred, _ in specs.values():
        cond = pred if cond is None else cond | pred
    # The struct keeps a NULL value of the newest row a NULL.
    aggs = [F.max_by(F.struct(expr.alias("v")), F.when(pred, F.col(when))).alias(name)
            for name, (pred, expr) in specs.items()]
    out = df.filter(cond).groupBy(key).agg(*aggs)
    return out.select(key, *[F.col(name)["v"].alias(name) for name in specs])


# Begins the names of structures that hold the columns of a packed frame.
PACKED = "__packed_"


def packed(df: DataFrame, keys, name: str) -> DataFrame:
    """The columns beside ``keys`` as one structure.

    A join writes every column of its result anew, one by one: a wide row that goes through many joins is written as often.
    A structure is copied as a whole.  ``unpacked`` is the way back; a left join without a match leaves NULLs.
    """
    keys = _names(keys)
    rest = [F.col(c) for c in df.columns if c not in keys]
    return df.select(*keys, F.struct(*rest).alias(PACKED + name)) if rest else df.select(*keys)


def not_packed(df: DataFrame, keys, name: str) -> DataFrame:
    """In place of ``packed``, where a row is narrow."""
    return df


def unpacked(df: DataFrame) -> DataFrame:
    """Packed columns side by side again."""
    return df.select(*[F.col(f"{c}.*") if c.startswith(PACKED) else F.col(c) for c in df.columns])


def attach_group_values(df: DataFrame, keys, **aggs: Column) -> DataFrame:
    """Group values next to every row: aggregate (combined map-side), then join back."""
    keys = _names(keys)
    return df.join(df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()]), keys, "left")


def dense_positions(df: DataFrame, by, order: str, name: str, where: Column | None = None) -> DataFrame:
    """Dense rank of ``order`` within ``by``.

    Ranks the distinct positions (at most one row per key and calendar value) and joins
    them back on key *and* value, so one hot key is spread over its values.  Rows outside
    ``where`` get 0.
    """
    by = _names(by)
    slots = df if where is None else df.filter(where)
    slots = slots.select(*by, order).distinct()
    w = Window.partitionBy(*by).orderBy(order)
    slots = slots.withColumn(name, F.row_number().over(w))
    out = df.join(slots, [*by, order], "left")
    return out if where is None else out.withColumn(name, F.when(where, F.col(name)).otherwise(F.lit(0)))


# So many consecutive whole-number tie-breakers make a range that one task sorts.
TIE_RANGE = 1 << 20


def numbered_with_previous(df: DataFrame, key: str, day: str, tie: str, number_as: str,
                           previous: dict, tie_range: int = TIE_RANGE) -> DataFrame:
    """Sequence number within ``key`` by (day, tie), and values of the row before.

    Prefix sums over three levels, so that neither a key nor a single day of a key that holds a large share of the
    rows is sorted by one task.  Rows are ordered inside (key, day, range), where a range is ``tie_range`` consecutive
    whole numbers of the tie-breaker: at most that many rows, as tie-breakers differ.  Ranges carry their count and last
    values and are ordered inside (key, day), days likewise inside key; counts of what comes before are added up and the last
    values carried over.  Where the tie-breaker is no whole number, days are not divided, and there are two levels.
    ``previous``: result column -> source column.
    """
    split = dict(df.dtypes)[tie] in ("tinyint", "smallint", "int", "bigint")
    if split:
        df = df.withColumn("__range", F.floor(F.col(tie) / F.lit(tie_range)))
    own, inside = df.columns, [key, day, "__range"] if split else [key, day]
    # Rows are moved once, for their order and for the figures of their part: a structure is never null, so joins on it put no
    # filter on one of the two sides, and the last row is picked as a whole, so that both need the same columns.
    df = df.withColumn("__part", F.struct(*inside)).repartition("__part")
    inner = Window.partitionBy("__part").orderBy(tie)
    vals = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(previous.values())])
    rows = (df.withColumn("__vals", vals)
              .withColumn("__n", F.row_number().over(inner))
              .withColumn("__before", F.lag("__vals").over(inner)))
    parts = df.groupBy("__part").agg(F.count(F.lit(1)).alias("__cnt"), F.max_by(F.struct(*own), F.col(tie)).alias("__row"))
    last = F.struct(*[F.col("__row")[c].alias(f"v{i}") for i, c in enumerate(previous.values())])
    parts = parts.select("__part", *[F.col("__part")[c].alias(c) for c in inside], "__cnt",
                         F.when(F.col("__row").isNotNull(), last).alias("__last"))

    def before(of, order, counts, last) -> list[Column]:
        """How many rows come before a part of ``of``, and the last values among them."""
        w = Window.partitionBy(of).orderBy(order)
        return [F.coalesce(F.sum(counts).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.lag(last).over(w)]

    if split:
        ranges = parts.withColumn("__day", F.struct(key, day))
        off, carry = before("__day", "__range", "__cnt", "__last")
        placed = ranges.select("__part", "__day", off.alias("__off"), carry.alias("__carry"))
        days = ranges.groupBy("__day").agg(F.sum("__cnt").alias("__cnt"), F.max_by("__last", "__range").alias("__last"))
        days = days.select("__day", F.col("__day")[key].alias(key), F.col("__day")[day].alias(day), "__cnt", "__last")
        off, carry = before(key, day, "__cnt", "__last")
        days = days.select("__day", off.alias("__day_off"), carry.alias("__day_carry"))
        placed = placed.join(days, "__day").select(
            "__part", (F.col("__off") + F.col("__day_off")).alias("__off"), F.coalesce("__carry", "__day_carry").alias("__carry"))
    else:
        off, carry = before(key, day, "__cnt", "__last")
        placed = parts.select("__part", off.alias("__off"), carry.alias("__carry"))
    out = rows.join(placed, "__part", "left")
    # A row without a key, day or tie-breaker's range has no number.
    known = reduce(and_, [F.col(c).isNotNull() for c in inside])
    prev = F.coalesce(F.col("__before"), F.when(known, F.col("__carry")))
    out = out.withColumn(number_as, F.when(known, F.col("__off") + F.col("__n")).cast("long"))
    for i, name in enumerate(previous):
        out = out.withColumn(name, prev[f"v{i}"])
    return out.drop("__vals", "__n", "__before", "__off", "__carry", "__range", "__part")


def string_collect(df: DataFrame, key: str, value, name: str, sep: str = "|") -> DataFrame:
    """Distinct non-NULL values of a key in one sorted, separated text.

    Duplicates are removed on (key, value) first, so the final group holds one copy each.
    """
    return (df.select(F.col(key), col(value).alias("__v")).filter(F.col("__v").isNotNull()).distinct()
              .groupBy(key)
              .agg(F.array_join(F.array_sort(F.collect_list("__v")), sep).alias(name)))


def slots_wide(df: DataFrame, key: str, order, slots: dict, n: int) -> DataFrame:
    """The first ``n`` rows of a key side by side.

    ``slots``: source column -> list of n result names.
    """
    top = first_n_by(df, key, order, n, "__slot")
    aggs = [F.max(F.when(F.col("__slot") == i + 1, F.col(c))).alias(names[i])
            for i in range(n) for c, names in slots.items()]
    return top.groupBy(key).agg(*aggs)


def conditional_counts(df: DataFrame, keys, specs: dict, extra: dict | None = None) -> DataFrame:
    """Counters per key: result column -> condition.  ``extra`` adds plain aggregates."""
    aggs = [F.sum(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in specs.items()]
    aggs += [a.alias(name) for name, a in (extra or {}).items()]
    return df.groupBy(*_names(keys)).agg(*aggs)


def exists_flag(df: DataFrame, on: str, other: DataFrame, other_key: str, name: str) -> DataFrame:
    """1 where the key occurs in the other side, else 0."""
    keys = other.select(F.col(other_key).alias(on)).distinct().withColumn(name, F.lit(1))
    return df.join(keys, on, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def dictionary_slice(dictionary: DataFrame, groups, key: str = "id", fold_case: bool = False) -> DataFrame:
    """(code, label) of some groups of the code dictionary; code as text."""
    grp = F.lower("cnd_group") if fold_case else F.col("cnd_group")
    return (dictionary.filter(grp.isin(_names(groups)))
            .select(F.col(key).cast("string").alias("__code"), F.col("cnd_name").alias("__label")))


def decode(df: DataFrame, code, dictionary: DataFrame, groups, name: str, default=None,
           key: str = "id", fold_case: bool = False, unique: bool = True) -> DataFrame:
    """Code -> label of the given dictionary groups; ``default`` where there is no match.

    ``unique=False`` first reduces the slice to one label per code (the lowest).
    """
    d = dictionary_slice(dictionary, groups, key, fold_case)
    if not unique:
        d = d.groupBy("__code").agg(F.min("__label").alias("__label"))
    out = df.join(d, col(code).cast("string") == d["__code"], "left")
    label = F.col("__label") if default is None else F.coalesce(F.col("__label"), default)
    return out.withColumn(name, label).drop("__code", "__label")


def decode_embedded_code(df: DataFrame, code: str, dictionary: DataFrame, condition: Column, name: str,
                         only: Column | None = None) -> DataFrame:
    """The first digits inside a text are looked up; without a match the text stays."""
    d = dictionary.filter(condition).select(F.col("id").cast("string").alias("__code"), F.col("cnd_name").alias("__label"))
    probe = F.regexp_substr(F.col(code), F.lit("[0-9]+"))
    if only is not None:
        probe = F.when(only, probe)
    out = df.join(d, probe == d["__code"], "left")
    return out.withColumn(name, F.coalesce(F.col("__label"), F.col(code))).drop("__code", "__label")


def recent_months_average(df: DataFrame, key: str, day: str, amount: str, name: str, n: int = 3) -> DataFrame:
    """Mean per month, then the mean over the latest ``n`` months of a key."""
    monthly = (df.groupBy(key, F.trunc(day, "month").alias("__month"))
                 .agg(F.avg(amount).alias("__avg")))
    top = first_n_by(monthly, key, [F.col("__month").desc()], n, "__rn")
    return top.groupBy(key).agg(F.avg("__avg").alias(name))


def asof_score(scores: DataFrame, events: DataFrame, key: str, score: str, score_day: str,
               event_day: str, tie: str) -> DataFrame:
    """Latest score at or before the event of its key; the newest one when there is no event.

    Scores are reduced to one per key and day before the join, so a key with very many
    scores brings at most one row per calendar day.
    """
    daily = (scores.groupBy(key, score_day)
             .agg(F.max_by(F.struct(F.col(score).alias("v")), F.col(tie)).alias("__s")))
    # One event per key, so the join cannot multiply rows.
    once = events.groupBy(key).agg(F.min(event_day).alias(event_day))
    eligible = daily.join(once, key, "left").filter(
        F.col(event_day).isNull() | (F.col(score_day) <= F.col(event_day)))
    best = eligible.groupBy(key).agg(F.max_by("__s", score_day).alias("__s"), F.max(score_day).alias(score_day))
    return best.select(key, F.col("__s")["v"].alias(score), score_day)


def asof_events(scores: DataFrame, events: DataFrame, key: str, score: str, score_day: str, event_day: str, tie: str,
                bucket: str = "year") -> DataFrame:
    """For every event of a key, however many: the latest score at or before its day, NULL where there is none.

    Scores and events become one stream; nothing is joined many to many.  Both are first reduced to one row for each key and
    day.  The stream is scanned inside (key, time bucket); the last score of a bucket is carried over to later
    buckets, of which a key has few, so a hot key is spread over its buckets.  Columns ``key, event_day, score, score_day``.
    """
    daily = (scores.filter(F.col(score_day).isNotNull()).groupBy(key, F.col(score_day).alias("__day"))
             .agg(F.max_by(F.struct(F.lit(1).alias("is_score"), F.col(score).alias("v")), F.col(tie)).alias("__s")))
    daily = daily.withColumn("__s", F.struct(F.col("__s.v").alias("v"), F.col("__day").alias("d")))
    wanted = events.select(key, F.col(event_day).alias("__day")).distinct().withColumn("__event", F.lit(True))
    stream = daily.unionByName(wanted, allowMissingColumns=True).groupBy(key, "__day").agg(
        F.max("__s").alias("__s"), F.coalesce(F.max("__event"), F.lit(False)).alias("__event"))
    stream = stream.withColumn("__bucket", F.trunc("__day", bucket))
    inside = Window.partitionBy(key, "__bucket").orderBy("__day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = stream.withColumn("__own", F.last("__s", ignorenulls=True).over(inside)).filter("__event")
    buckets = stream.groupBy(key, "__bucket").agg(F.max_by("__s", F.when(F.col("__s").isNotNull(), F.col("__day"))).alias("__last"))
    earlier = Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(key, "__bucket", F.last("__last", ignorenulls=True).over(earlier).alias("__carry"))
    out = scanned.join(buckets, [key, "__bucket"], "left")
    found = F.coalesce("__own", "__carry")
    return out.select(key, F.col("__day").alias(event_day), found["v"].alias(score), found["d"].alias(score_day))


def earliest_match(left: DataFrame, right: DataFrame, pairs, pick, keep) -> DataFrame:
    """For each left row the best right row reachable through any of several keys.

    ``pairs``: (left column, right column, right condition or None) per key.  The right side is reduced to its
    best row per key value before each join, so equal keys never multiply rows; the best of
    the candidates wins.  ``pick`` are sort columns (ascending, NULL last), ``keep`` the
    columns carried over; missing matches give NULLs.
    """
    out = left
    order = [F.col(p).asc_nulls_last() for p in pick]
    cands = []
    cols = list(dict.fromkeys([*pick, *keep]))
    for i, (lcol, rcol, cond) in enumerate(pairs):
        r = right.filter(F.col(rcol).isNotNull() if cond is None else F.col(rcol).isNotNull() & cond)
        r = latest_by(r.select(F.col(rcol).alias("__k"), *cols), "__k", order)
        cand = f"__c{i}"
        r = r.select(F.col("__k"), F.struct(*cols).alias(cand))
        out = out.join(r, out[lcol] == r["__k"], "left").drop("__k")
        cands.append(cand)
    best = None
    for cand in cands:
        if best is None:
            best = F.col(cand)
            continue
        better = F.lit(False)
        equal = F.lit(True)
        for p in pick:
            a, b = F.col(cand)[p], best[p]
            # NULL sorts last.
            less = F.coalesce(a < b, a.isNotNull() & b.isNull())
            better = better | (equal & less)
            equal = equal & a.eqNullSafe(b)
        better = F.col(cand).isNotNull() & (best.isNull() | better)
        best = F.when(better, F.col(cand)).otherwise(best)
    out = out.withColumn("__best", best)
    for c in keep:
        out = out.withColumn(c, F.col("__best")[c])
    return out.drop("__best", *cands)

"""Join operators.

A left key may hold a large part of all rows (a placeholder load id, a NULL, one big
customer), and a shuffle join would send all of them to one task. Two ways keep such a key
apart, both with the result of a plain join:

* Where every join of a chain has another key, each one has a shuffle of its own, and
  adaptive execution cuts an oversized left partition (Spark's skew join).
* Where the joined rows stay partitioned by the key for the next step, adaptive execution
  leaves them alone. There the caller hands over the rows per key, ``key_counts`` of the
  stored table: ``lookup_join`` cuts a key above ``rows_per_slot`` rows into slots on the
  left and copies its few lookup rows once per slot.

Nothing is broadcast by hand but the lookups of ``small_lookup_join``, whose bytes are summed up
first, and the bitmap of ``key_filter``, whose size is fixed; for all else, Spark picks a broadcast join itself when the size it knows or has
measured is under its threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows one task takes in a join without trouble; keys above it are cut into slots.
ROWS_PER_SLOT = 1_000_000
# Slots for rows with a NULL key, which never match and may be many.
NULL_SLOTS = 1024

On = str | Sequence[str] | Mapping[str, str]


def _pairs(on: On) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(k, k) for k in on]


def _aligned(left: DataFrame, right: DataFrame, on: On) -> tuple[list[str], DataFrame]:
    """Key names, and the right side with its keys named as on the left."""
    pairs = _pairs(on)
    renames = {r: l for l, r in pairs if l != r}
    right = right.withColumnsRenamed(renames) if renames else right
    keys = [l for l, _ in pairs]
    clash = sorted((set(left.columns) & set(right.columns)) - set(keys))
    if clash:
        raise ValueError(f"columns on both sides of the join: {clash}")
    return keys, right


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key as ``_rows``; summed up before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))


def _same(left_keys: Sequence[str], right_keys: Sequence[str], null_safe: bool) -> Column:
    pairs = zip(left_keys, right_keys)
    return reduce(
        lambda a, b: a & b,
        [F.col(l).eqNullSafe(F.col(r)) if null_safe else F.col(l) == F.col(r) for l, r in pairs],
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: On,
    how: str = "left",
    *,
    counts: DataFrame | None = None,
    rows_per_slot: int = ROWS_PER_SLOT,
    null_safe: bool = False,
) -> DataFrame:
    """Join that keeps hot left keys from piling up in one task.

    ``how`` is one of left, inner, left_semi, left_anti. ``counts`` gives the rows per key
    (keys plus ``_rows``, see ``key_counts``); take it from the stored rows, not from a
    frame with joins in it, which would run twice. Without it the join is left to adaptive
    execution. With ``null_safe``, NULL keys match each other.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if how in ("left_semi", "left_anti"):
        right = right.select(*[r for _, r in _pairs(on)]).distinct()
    keys, right = _aligned(left, right, on)
    if counts is None:
        return _join(left, right, keys, how, null_safe)

    hot_keys = [f"_hot_{k}" for k in keys]
    hot = counts.where(F.col("_rows") > rows_per_slot)
    hot = hot if null_safe else hot.dropna(subset=keys)
    hot = hot.select(
        *[F.col(k).alias(h) for k, h in zip(keys, hot_keys)],
        F.ceil(F.col("_rows") / rows_per_slot).cast("int").alias("_slots"),
    )
    is_hot = _same(keys, hot_keys, null_safe)
    # The row's own values and its input partition pick the slot: a task that runs again
    # puts its rows into the same slots, and copies of one row do not share one slot.
    spread = F.expr("xxhash64(*, spark_partition_id())")
    slot = F.when(F.col("_slots").isNotNull(), F.pmod(spread, F.col("_slots"))).otherwise(0)
    if not null_safe:
        null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        slot = F.when(null_key, F.pmod(spread, F.lit(NULL_SLOTS))).otherwise(slot)
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slots"), F.lit(1)) - 1))
    spread_left = left.join(hot, is_hot, "left").withColumn("_slot", slot.cast("int"))
    copied_right = right.join(hot, is_hot, "left").withColumn("_slot", copies)
    return _join(
        spread_left.drop(*hot_keys, "_slots"),
        copied_right.drop(*hot_keys, "_slots"),
        [*keys, "_slot"],
        how,
        null_safe,
    ).drop("_slot")


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, list(keys), how)
    right_keys = [f"_r_{k}" for k in keys]
    right = right.withColumnsRenamed(dict(zip(keys, right_keys)))
    return left.join(right, _same(keys, right_keys, True), how).drop(*right_keys)


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in memory, roughly: its texts, and 8 and a word for each other column."""
    parts = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) + 16
        if f.dataType.typeName() in ("string", "binary")
        else F.coalesce(F.octet_length(F.to_json(F.struct(f"`{f.name}`"))), F.lit(0)) + 16
        if f.dataType.typeName() in ("array", "map", "struct")
        else F.lit(16)
        for f in df.schema
    ]
    return reduce(lambda a, b: a + b, parts, F.lit(8)).cast("bigint")


def key_filter(left: DataFrame, right: DataFrame, on: On, *, bits: int = 1 << 25) -> DataFrame:
    """Left rows whose key may be in ``right``: all that have a partner, and few others.

    A Bloom filter with one hash, as a table of at most ``bits`` / 64 numbers that every task
    gets (8 MB by default, whatever the size of ``right``). ``bits`` is a power of two. Rows
    with a NULL key are dropped. A filter that is nearly full lets all rows through.
    """
    place = lambda cols: F.xxhash64(*[F.col(c) for c in cols]).bitwiseAND(F.lit(bits - 1))
    bit = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    pairs = _pairs(on)
    keys, names = [l for l, _ in pairs], [r for _, r in pairs]
    words = right.select(*names).dropna().select(place(names).alias("_place"))
    words = words.groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    marked = left.dropna(subset=keys).withColumn("_place", place(keys))
    found = (F.shiftright("_place", 6) == F.col("_word")) & (F.col("_bits").bitwiseAND(bit) != 0)
    return marked.join(F.broadcast(words), found, "left_semi").drop("_place")


def small_lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: On,
    how: str = "left",
    *,
    most_bytes: int = 64 << 20,
    most_rows: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join with a lookup that is sent to every task if it is small: one pass over ``left``, no shuffle.

    The lookup is run once and stored, and the bytes of its rows are summed up. Up to
    ``most_bytes`` it is broadcast. Beyond, ``lookup_join`` joins it (with ``counts``, hot keys
    are spread there); for inner and left_semi, ``key_filter`` keeps left rows without a
    partner out of the shuffle. Both ways have the same rows. ``most_rows`` is for lookups
    that must not grow: more rows than that raise.
    """
    from loadlens.sources.sinks import staged

    if most_rows is not None and right.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"the lookup has more than {most_rows} rows; use lookup_join")
    right = staged(right)
    if (right.agg(F.sum(row_bytes(right))).first()[0] or 0) <= most_bytes:
        keys, right = _aligned(left, right, on)
        return left.join(F.broadcast(right), keys, how)
    if how in ("inner", "left_semi"):
        left = key_filter(left, right, on)
    return lookup_join(left, right, on, how, counts=counts)


def enrich(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    """Left join with a lookup that has one row per key.

    For left sides that are already one row per key or nearly so, or whose next join has
    another key; see ``lookup_join`` for row-level tables.
    """
    return lookup_join(left, right, on)


def inner_join(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    """Inner join on equal or differently named keys; the right key columns are dropped."""
    return lookup_join(left, right, on, "inner")


def right_join(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    """Every row of ``right`` with the columns of ``left``, NULL where it has no partner.

    Written as a left join from the kept side. Keys keep their left names.
    """
    keys, right = _aligned(left, right, on)
    return lookup_join(right, left, keys)


def anti_join(left: DataFrame, right: DataFrame, on: On) -> DataFrame:
    """Left rows without a partner, rows with a NULL key included.

    For row-level left sides with hot keys, use ``lookup_join(..., how="left_anti")``.
    """
    keys, right = _aligned(left, right.select(*[r for _, r in _pairs(on)]), on)
    return left.join(right.dropna().distinct(), keys, "left_anti")


def missing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``left`` that ``right`` does not have."""
    return anti_join(left, right, keys).select(*keys)


def fallback_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    via: Sequence[str],
    cols: Sequence[str],
) -> DataFrame:
    """Look ``cols`` up by several keys of ``df``; the first key in ``via`` that has a value wins.

    ``lookup`` has one row per ``key``. Each column is resolved on its own, so a hit with
    a NULL value falls through to the next key.

    Every row sends its keys with their rank, the first of them with the row itself, so the
    lookup is joined once whatever the number of keys; what the keys of a row have found then
    meets in one aggregation, a few rows a group. Rows are numbered as they are read, so
    ``df`` must be a stored table (``staged``): a task that runs again has to read the same
    rows in the same order.
    """
    own, nothing = F.struct(*df.columns), F.lit(None).cast(df.schema)
    asks = [
        F.struct(F.lit(i).alias("_rank"), F.col(k).alias("_key"), (nothing if i else own).alias("_own"))
        for i, k in enumerate(via)
    ]
    numbered = df.select(F.monotonically_increasing_id().alias("_row"), F.array(*asks).alias("_asks"))
    sent = numbered.select("_row", F.inline("_asks")).where("_rank = 0 OR _key IS NOT NULL")
    # NULL keys find nothing and may be many: they go to slots that the lookup does not have
    slot = F.when(F.col("_key").isNull(), F.pmod(F.xxhash64("_row"), F.lit(NULL_SLOTS))).otherwise(-1)
    found = {c: f"_found_{i}" for i, c in enumerate(cols)}
    side = lookup.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.lit(-1).cast("bigint").alias("_slot"), *[F.col(c).alias(f) for c, f in found.items()]
    )
    hits = sent.withColumn("_slot", slot.cast("bigint")).join(side, ["_key", "_slot"], "left")
    first = [F.min_by(f, F.when(F.col(f).isNotNull(), F.col("_rank"))).alias(f) for f in found.values()]
    whole = hits.groupBy("_row").agg(F.first("_own", ignorenulls=True).alias("_own"), *first)
    return whole.select("_own.*", *[F.col(f).alias(c) for c, f in found.items()])


def two_pass_match(
    left: DataFrame,
    right: DataFrame,
    fine: Sequence[str],
    coarse: Sequence[str],
    *,
    regroup: Mapping[str, Column],
    rest: Callable[[DataFrame], DataFrame] | None = None,
    right_coarse: DataFrame | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Match on the fine key, then give unmatched keys a second try on a coarser key.

    Pass 1 keeps every left row, matched or not. Pass 2 takes the rows whose fine key has
    no partner (NULL keys left out), collapses them to the coarse key with ``regroup`` and
    joins the right side summed to that key. ``match_pass`` is 1 or 2; drop the unmatched
    rows of pass 1 to count every shipment once.

    The join of pass 1 tells which rows are left over, so the right side is matched once and no
    anti join follows. ``keep`` (``staged``) stores its rows, which both passes read. ``rest`` may
    bring the left-over rows, with the columns of ``left``, into another shape before ``regroup``.
    """
    measures = [c for c in right.columns if c not in fine and c not in coarse]
    only_right = [c for c in right.columns if c not in fine and c not in left.columns]
    marked = right.select(*fine, *only_right).withColumn("_hit", F.lit(True))
    first = left.join(marked, list(fine), "left")
    first = keep(first) if keep else first
    over = first.where(F.col("_hit").isNull()).dropna(subset=list(fine)).select(*left.columns)
    retry = (rest(over) if rest else over).groupBy(*coarse).agg(*[e.alias(n) for n, e in regroup.items()])
    coarse_side = (right if right_coarse is None else right_coarse).select(*coarse, *measures)
    second = retry.join(coarse_side.withColumn("_hit", F.lit(True)), list(coarse), "left")
    matched = F.coalesce(F.col("_hit"), F.lit(False))
    one = first.withColumns({"matched": matched, "match_pass": F.lit(1)}).drop("_hit")
    two = second.withColumns({"matched": matched, "match_pass": F.lit(2)}).drop("_hit")
    return one.unionByName(two, allowMissingColumns=True)

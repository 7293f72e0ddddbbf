"""Log cleaning: item subset, time split, day parsing, blackout days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BEHAVIORS, PURCHASE, Calendar
from ..sources.schemas import CLEAN_COLUMNS


def split_time(raw: DataFrame) -> DataFrame:
    """``time`` "YYYY-MM-DD HH" -> ``days`` and ``hours`` strings."""
    sp = F.lit(" ")
    return raw.withColumns({
        "days": F.split_part(F.col("time"), sp, F.lit(1)),
        "hours": F.split_part(F.col("time"), sp, F.lit(2)),
    })


def parse_day(df: DataFrame) -> DataFrame:
    """``days`` -> ``day`` date and ``hours`` -> ``hour`` int."""
    return df.withColumns({
        "day": F.to_date(F.col("days"), "yyyy-MM-dd"),
        "hour": F.col("hours").cast("int"),
    })


def drop_blackout_days(df: DataFrame, cal: Calendar, col: str = "day") -> DataFrame:
    if not cal.blackout_days:
        return df
    return df.filter(~F.col(col).isin([F.lit(d) for d in cal.blackout_days]))


def semi_item_subset(log: DataFrame, items: DataFrame) -> DataFrame:
    """Rows whose item is in the item table. A semi join: duplicate items do
    not multiply rows. The planner broadcasts the item table only when its
    estimated size is under the broadcast threshold."""
    return log.join(items.select("item_id"), "item_id", "left_semi")


FILTER_BUCKET = 1 << 15  # bits of one filter row
FILTER_MAX_BITS = 1 << 28  # 32 MB, whatever the number of items
BITS_PER_ITEM = 16


def _filter_bits(n_items: int) -> int:
    """Bits for so many items: a power of two between one bucket and the maximum."""
    return min(FILTER_MAX_BITS, max(FILTER_BUCKET, 1 << (max(1, n_items) * BITS_PER_ITEM - 1).bit_length()))


def _places(item: str, bits: int) -> tuple[str, list[str]]:
    """SQL of an item's bucket and of its two bit places there, from one hash."""
    h = f"xxhash64({item})"
    return (f"CAST(pmod({h}, {bits // FILTER_BUCKET}) AS INT)",
            [f"CAST(shiftrightunsigned({h}, {by}) & {FILTER_BUCKET - 1} AS INT)" for by in (49, 34)])


def item_filter(items: DataFrame, n_items: int) -> DataFrame:
    """A Bloom filter of the items as rows (``_bucket``, ``_words``): an item
    sets two bits of one bucket of 512 longs. Its size is fixed by ``n_items``
    and at most 32 MB; a fuller filter lets more rows pass, never fewer."""
    bits = _filter_bits(n_items)
    bucket, places = _places("item_id", bits)
    words = (items.where("item_id IS NOT NULL").selectExpr(f"{bucket} AS _bucket", f"explode(array({', '.join(places)})) AS _p")
             .selectExpr("_bucket", "_p DIV 64 AS _w", "shiftleft(1L, CAST(_p % 64 AS INT)) AS _bit"))
    empty = (items.sparkSession.range(bits // FILTER_BUCKET).selectExpr("CAST(id AS INT) AS _bucket", f"explode(sequence(0L, {FILTER_BUCKET // 64 - 1}L)) AS _w")
             .withColumn("_bit", F.lit(0).cast("long")))
    words = words.unionByName(empty).groupBy("_bucket", "_w").agg(F.bit_or("_bit").alias("_bit"))
    return words.groupBy("_bucket").agg(F.expr("transform(array_sort(collect_list(struct(_w, _bit))), x -> x._bit)").alias("_words"))


def maybe_listed(log: DataFrame, filter_: DataFrame, n_items: int) -> DataFrame:
    """Rows whose item the filter may hold: a map-side join with the broadcast
    filter (at most 32 MB), no shuffle of the log."""
    bucket, places = _places("l.item_id", _filter_bits(n_items))
    hit = [f"getbit(f._words[{p} DIV 64], CAST({p} % 64 AS INT)) = 1" for p in places]
    return log.alias("l").join(F.broadcast(filter_.alias("f")), F.expr(" AND ".join([f"f._bucket = {bucket}", *hit])), "left_semi")


def semi_item_subset_filtered(log: DataFrame, items: DataFrame, n_items: int | None = None) -> DataFrame:
    """``semi_item_subset`` for an item table too large to broadcast: the log is
    first cut by a Bloom filter where it lies, so the rows shuffled to the semi
    join are nearly those that stay (about 2 % of the others pass at 16 bits an
    item). ``n_items`` is counted if not given; the result is the same for any."""
    n = items.count() if n_items is None else n_items
    return semi_item_subset(maybe_listed(log, item_filter(items, n), n), items)


def known_behaviors(log: DataFrame) -> DataFrame:
    """Rows with a behaviour code of the data model. Decided once, here: an
    unknown or missing code is no interaction, so it makes no pair, no count,
    no grid cell and no highest behaviour."""
    return log.filter(F.col("behavior_type").isin(list(BEHAVIORS)))


def clean_log(raw: DataFrame, items: DataFrame, cal: Calendar, large_items: bool = False) -> DataFrame:
    """``large_items``: the item table is too large to broadcast, see
    ``semi_item_subset_filtered``. The rows are the same."""
    subset = semi_item_subset_filtered if large_items else semi_item_subset
    df = parse_day(split_time(subset(known_behaviors(raw), items)))
    df = drop_blackout_days(df, cal)
    return df.select(*[c for c in CLEAN_COLUMNS if c in df.columns])


def purchases(log: DataFrame) -> DataFrame:
    return log.filter(F.col("behavior_type") == PURCHASE)

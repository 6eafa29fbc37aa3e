"""Slowly changing dimensions: version sets (SN1, SN2) and their overlap check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import surrogate_key
from .current import latest_per_key, newest_first
from .slices import HOT_ROWS, PART, SLICE, sliced_lead, sliced_max_before, with_slices

META = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def _stamp(df: DataFrame, key: str, updated_at: str) -> DataFrame:
    """First version of every row: open since its ``updated_at``."""
    ts = df.schema[updated_at].dataType
    return df.select(
        "*",
        surrogate_key(key, updated_at).alias("dbt_scd_id"),
        F.col(updated_at).alias("dbt_updated_at"),
        F.col(updated_at).alias("dbt_valid_from"),
        F.lit(None).cast(ts).alias("dbt_valid_to"),
    )


def scd2_merge(
    target: DataFrame | None, source: DataFrame, key: str, updated_at: str = "updated_at"
) -> DataFrame:
    """The version set after one snapshot run (SN1).

    A key whose source row is newer than its open version gets that version closed at
    the new time and a new one opened. New keys open a version; keys the source no
    longer has stay open. One shuffle: open versions and source meet in a full outer
    join on the key, and each pair unfolds into the one or two rows that remain.
    Running it again with the same source changes nothing.
    """
    fresh = _stamp(source, key, updated_at)
    if target is None:
        return fresh
    columns = fresh.columns
    target = target.select(*columns)
    closed = target.filter(F.col("dbt_valid_to").isNotNull())
    opened = target.filter(F.col("dbt_valid_to").isNull())

    old = opened.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    new = fresh.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_new"))
    # NULL if there is no open version or no source row, hence the coalesce.
    changed = F.coalesce(
        F.col("_new.dbt_updated_at") > F.col("_old.dbt_updated_at"), F.lit(False)
    )
    kept = F.when(
        F.col("_old").isNotNull(),
        F.when(
            changed, F.col("_old").withField("dbt_valid_to", F.col("_new.dbt_updated_at"))
        ).otherwise(F.col("_old")),
    )
    added = F.when(
        F.col("_new").isNotNull() & (F.col("_old").isNull() | changed), F.col("_new")
    )
    merged = (
        old.join(new, F.col("_old_key") == F.col("_new_key"), "full")
        .select(F.explode(F.array_compact(F.array(kept, added))).alias("_row"))
        .select("_row.*")
    )
    return closed.unionByName(merged)


def scd2_changes(opened: DataFrame | None, source: DataFrame, key: str, updated_at: str = "updated_at") -> DataFrame:
    """What a snapshot run changes (SN1): per new or newer key its open version so far, ``old`` (NULL for
    a new key), and the one that follows, ``new``. Keys that stay as they are do not appear."""
    fresh = _stamp(source, key, updated_at)
    new = fresh.select(F.col(key).alias("_new_key"), F.struct(*fresh.columns).alias("new"))
    if opened is None:
        return new.select(F.lit(None).cast(new.schema["new"].dataType).alias("old"), "new")
    old = opened.select(F.col(key).alias("_old_key"), F.struct(*fresh.columns).alias("old"))
    newer = F.col("old").isNull() | (F.col("new.dbt_updated_at") > F.col("old.dbt_updated_at"))
    met = new.join(old, F.col("_old_key") == F.col("_new_key"), "left")
    return met.filter(newer).select("old", "new")


def scd2_from_log(
    log: DataFrame,
    key: str,
    ts: str = "_source_ts",
    op: str | None = "_op",
    tie_break: Sequence[str] = ("_loaded_at", "_connector_batch_id"),
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every version of every key in one pass over a change log (SN2).

    Each change opens a version that lasts until the next one. Two changes of a key at
    the same instant leave one version. Keys with more than ``hot_rows`` changes are
    worked off in slices of their own times.
    """
    live = log.filter(F.col(op) != "DELETE") if op else log
    live = with_slices(live.filter(F.col(ts).isNotNull()), [key], ts, hot_rows)
    order = newest_first(*[c for c in tie_break if c in live.columns])
    if order:
        versions = latest_per_key(live, [key, ts], order)
    else:
        versions = live.dropDuplicates([key, ts])
    return sliced_lead(versions, [key], ts, valid_to, source=live).withColumn(
        valid_from, F.col(ts)
    )


def as_of_version(
    facts: DataFrame,
    versions: DataFrame,
    on: str,
    moment: str,
    take: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Option to the current-version lookup: the version valid at the time of the fact.

    Versions of a key must not overlap. Facts and versions of a key are put on one time
    line and every fact takes the last version that started before it, so the work is
    linear however many facts and versions a key has.
    """
    version = F.struct(F.col(valid_from), F.col(valid_to), *take)
    starts = versions.filter(F.col(on).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(on).alias("_k"),
        F.struct(F.col(valid_from).alias("at"), F.lit(0).alias("is_fact")).alias("_order"),
        version.alias("_version"),
    )
    moments = facts.select(
        F.col(on).alias("_k"),
        F.struct(F.col(moment).alias("at"), F.lit(1).alias("is_fact")).alias("_order"),
        F.struct(*facts.columns).alias("_fact"),
    )
    line = starts.unionByName(moments, allowMissingColumns=True)
    cut = with_slices(line.withColumn("_at", F.col("_order.at")), ["_k"], "_at", hot_rows)
    found = sliced_max_before(cut, ["_k"], "_order", "_version", "_found")
    valid = F.col(f"_found.{valid_to}").isNull() | (F.col("_order.at") < F.col(f"_found.{valid_to}"))
    return found.filter("_order.is_fact = 1").select(
        "_fact.*", *[F.when(valid, F.col(f"_found.{c}")).alias(c) for c in take]
    )


def _far_future(df: DataFrame, column: str) -> Column:
    return F.lit("9999-12-31").cast(df.schema[column].dataType)


def _reach(
    versions: DataFrame, key: str, valid_from: str, valid_to: str, hot_rows: int
) -> DataFrame:
    """Per key and start: how far its versions reach, how far earlier ones reach, next start."""
    end = F.coalesce(F.col(valid_to), _far_future(versions, valid_to))
    rows = versions.select(
        F.col(key).alias("_k"), F.col(valid_from).alias("_from"), end.alias("_reach")
    ).filter(F.col("_k").isNotNull() & F.col("_from").isNotNull())
    cut = with_slices(rows, ["_k"], "_from", hot_rows)
    starts = cut.groupBy("_k", "_from", SLICE, PART).agg(F.max("_reach").alias("_reach"))
    earlier = sliced_max_before(starts, ["_k"], "_from", "_reach", "_earlier_reach", source=cut)
    return sliced_lead(earlier, ["_k"], "_from", "_next_from", source=cut)


def scd2_overlapping_versions(
    versions: DataFrame,
    key: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Starts that fall before an earlier version of the key ended, one row each.

    Linear in the number of versions, however many of them overlap.
    """
    reach = _reach(versions, key, valid_from, valid_to, hot_rows)
    return reach.filter(F.col("_earlier_reach") > F.col("_from")).select(
        F.col("_k").alias(key),
        F.col("_from").alias(valid_from),
        F.nullif("_earlier_reach", _far_future(versions, valid_to)).alias("earlier_valid_to"),
    )


def scd2_overlaps(
    versions: DataFrame,
    key: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All pairs of overlapping versions of a key (D7); empty for a sound dimension.

    Only versions known to overlap something enter the pair join, so a sound table costs
    two linear windows and joins nothing.
    """
    reach = _reach(versions, key, valid_from, valid_to, hot_rows)
    overlapped = reach.filter(F.col("_earlier_reach") > F.col("_from")).select("_k", "_from")
    overlapping = reach.filter(F.col("_reach") > F.col("_next_from")).select("_k", "_from")
    rows = versions.select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_f"), F.col(valid_to).alias("_t")
    )

    def matching(starts: DataFrame, side: str) -> DataFrame:
        return rows.join(
            starts, (F.col("_key") == F.col("_k")) & (F.col("_f") == F.col("_from")), "left_semi"
        ).select(
            F.col("_key").alias(f"_{side}_key"),
            F.col("_f").alias(f"{side}_{valid_from}"),
            F.col("_t").alias(f"{side}_{valid_to}"),
        )

    a, b = matching(overlapping, "a"), matching(overlapped, "b")
    a_from, a_to = F.col(f"a_{valid_from}"), F.col(f"a_{valid_to}")
    b_from, b_to = F.col(f"b_{valid_from}"), F.col(f"b_{valid_to}")
    return a.join(
        b,
        (F.col("_a_key") == F.col("_b_key"))
        & (a_from < b_from)
        & (a_to.isNull() | (a_to > b_from)),
    ).select(F.col("_a_key").alias(key), a_from, a_to, b_from, b_to)

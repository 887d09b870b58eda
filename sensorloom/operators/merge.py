"""Merging several sources on time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import names

MERGE_TYPES = ("outer", "inner", "left", "right")


def merge_on_time(
    frames: Sequence[DataFrame], on: Sequence[str] | str = "time", how: str = "outer", sort: bool = False
) -> DataFrame:
    """What a fold of equi-joins gives, with one exchange for all sources.

    Rows of all sources are tagged, united and grouped by the key once; the
    rows of a key are then combined source by source, so that duplicates
    multiply as in joins and a source without the key leaves NULLs or removes
    the key, as ``how`` says.  A column that an earlier source has is taken from
    there.  Keys with a NULL match nothing, as in joins.
    """
    if how not in MERGE_TYPES:
        raise ValueError(f"merge type must be one of {MERGE_TYPES}, got {how!r}")
    keys = [on] if isinstance(on, str) else list(on)
    frames = [f for f in frames if f is not None and f.columns]
    if not frames:
        raise ValueError("nothing to merge")
    out = _merged(frames, keys, how) if len(frames) > 1 else frames[0]
    return out.orderBy(*keys) if sort else out


def _merged(frames: list[DataFrame], keys: list[str], how: str) -> DataFrame:
    taken: set[str] = set(keys)
    tagged, parts = [], []
    for at, frame in enumerate(frames):
        own = [c for c in frame.columns if c not in taken]
        taken.update(own)
        parts.append(own)
        # a constant keeps the struct of a source without own columns from being empty
        row = F.struct(F.lit(True).alias("_here"), *[names.col(c) for c in own])
        unmatched = F.lit(False)
        for k in keys:
            unmatched = unmatched | names.col(k).isNull()
        # rows with a NULL in the key stay alone: each is its own group
        alone = F.when(unmatched, F.struct(F.lit(at).alias("source"), F.monotonically_increasing_id().alias("row")))
        tagged.append(frame.select(*[names.col(k) for k in keys], alone.alias("_alone"), row.alias(f"_s{at}")))
    both = tagged[0]
    for frame in tagged[1:]:
        both = both.unionByName(frame, allowMissingColumns=True)
    lists = [f"_s{at}" for at in range(len(frames))]
    # collect_list leaves out the NULLs of other sources
    groups = both.groupBy(*[names.col(k) for k in keys], "_alone").agg(*[F.collect_list(s).alias(s) for s in lists])
    present = [F.size(s) > 0 for s in lists]
    if how == "inner":
        groups = groups.filter(_all(present))
    elif how == "left":
        groups = groups.filter(present[0])
    elif how == "right":
        groups = groups.filter(present[-1])
        # each join keeps the keys of its right side only, so a source counts if all later ones have the key
        for at in range(len(lists) - 2, -1, -1):
            groups = groups.withColumn(lists[at], F.when(_all(present[at:]), F.col(lists[at])).otherwise(F.slice(lists[at], 1, 0)))
    for s in lists:
        rest = [c for c in groups.columns if c != s]
        groups = groups.select(*[names.col(c) for c in rest], F.explode_outer(s).alias(s))
    columns = [F.col(f"{s}.{names.quote(c)}").alias(c) for s, own in zip(lists, parts) for c in own]
    return groups.select(*[names.col(k) for k in keys], *columns)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out

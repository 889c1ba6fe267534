"""State kept up to date from the loads of another table.

A maintained table holds a summary of a source table, for instance sums per
employee and month. Its version notes which loads of the source it covers, so the
next refresh reads only the loads that came since and merges their summary into the
partitions they touch. Nothing else of the source is read. What a refresh covers is
committed together with the rows, so a refresh that died is simply run again:
nothing is counted twice and nothing is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from . import versions
from .tables import merge_load, replace_load
from .versions import Version

COVERS = "covers"


def uncovered_parts(source: Version, covered: Sequence[str]) -> list[tuple[str, str]] | None:
    """The source's parts whose rows are not in the loads ``covered``.

    A compacted load counts as the loads it was made of. None when the difference
    cannot be told by whole parts: a covered load was replaced, or a compacted one
    has rows of both kinds.
    """
    covered = set(covered)

    def sources(load: str) -> set[str]:
        if load not in source.merged:
            return {load}
        return set().union(*[sources(x) for x in source.merged[load]])

    made_of = {load: sources(load) for load in source.loads()}
    present = set().union(*made_of.values()) if made_of else set()
    if not covered <= present:
        return None
    if any(x & covered and not x <= covered for x in made_of.values()):
        return None
    return [(load, folder) for load, folder in source.parts if not made_of[load] <= covered]


def covered_loads(source: Version) -> list[str]:
    """All loads whose rows are in a version, compacted ones by their sources."""
    out, todo = set(), list(source.loads())
    while todo:
        load = todo.pop()
        todo += source.merged.get(load, ())
        if load not in source.merged:
            out.add(load)
    return sorted(out)


def refresh_state(spark: SparkSession, source: str, target: str,
                  summarise: Callable[[DataFrame], DataFrame],
                  combine: Callable[[DataFrame, DataFrame], DataFrame],
                  partition_by: Sequence[str] = ()) -> Version:
    """Bring the maintained table ``target`` up to the source's current version.

    ``summarise(rows)`` gives the state of some source rows. ``combine(stored,
    more)`` merges two states of the same partitions; it must not depend on how rows
    are dealt to loads. Returns the source version that the state now covers.
    """
    at = versions.latest(spark, source)
    have = versions.latest(spark, target)
    parts = uncovered_parts(at, have.notes.get(COVERS, ())) if have else None
    notes = {COVERS: covered_loads(at)}
    if parts is None:
        replace_load(spark, summarise(versions.read(spark, source, at)), target, partition_by, notes)
    elif parts:
        merge_load(spark, summarise(versions.read(spark, source, at, parts)), target, combine,
                   partition_by, notes)
    return at

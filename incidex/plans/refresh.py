"""Gold tables brought up to date year by year.

Source and target are versioned tables (``sources.versions``) with the same
first partition column.  The folders that a manifest lists for a partition are
its fingerprint: they change exactly when the partition is written.  The
target's manifest carries the fingerprints it was built from, so a refresh
compares two manifests (no rows are read), rebuilds the partitions that differ
and publishes them in one step; the files of all others stay where they are.
Partitions that the source has lost, or that yield no rows any more, leave the
target.  A refresh that is run again finds nothing to do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..sources.versions import VersionedTable


def changed_partitions(source: VersionedTable, target: VersionedTable) -> tuple[list[str], dict]:
    """(partition folders whose fingerprints differ, the source's fingerprints)."""
    now = (source.manifest() or {"folders": {}})["folders"]
    built = ((target.manifest() or {"note": {}})["note"]).get("built_from", {})
    return sorted(n for n in {*now, *built} if now.get(n) != built.get(n)), now


def refresh(source: VersionedTable, target: VersionedTable, build: Callable[[DataFrame], DataFrame], partition: str) -> list[str]:
    """Rebuild the partitions of ``target`` whose source changed; returns their
    folder names.  ``build`` turns rows of ``source`` into rows of ``target``
    and must not mix partitions (a year's gold rows come from that year);
    where it has ``parts`` (see ``pipeline``), these are used."""
    changed, now = changed_partitions(source, target)
    if changed:
        given = source.read(names=changed)
        rows, late = build.parts(given) if hasattr(build, "parts") else (build(given), None)
        staged = target.stage(rows, partition, late=late)
        if not set(staged.names) <= set(changed):
            raise ValueError(f"rows of partitions that did not change: {sorted(set(staged.names) - set(changed))}")
        target.publish(staged, keep="untouched", note={"built_from": now}, drop=changed)
    return changed

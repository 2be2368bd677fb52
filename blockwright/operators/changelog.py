"""Slowly changing reference tables as append-only change logs: a row only when an entity's payload changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockwright.functions.labels import payload_hash, payload_json
from blockwright.operators.forks import latest

META = ["listed", "observed_at", "source", "payload_sha256", "payload_json"]


def shaped(snapshot: DataFrame, key: list[str], source: str) -> DataFrame:
    """A snapshot's rows (key, payload columns, observed_at) in the form of the log."""
    payload = [c for c in snapshot.columns if c not in (*key, "observed_at")]
    return snapshot.select("*", F.lit(True).alias("listed"), F.lit(source).alias("source"), payload_hash(payload).alias("payload_sha256"), payload_json(payload).alias("payload_json"))


def newest(log: DataFrame, key: list[str], time: str = "observed_at") -> DataFrame:
    return latest(log, key, [F.desc(time)])


def changes(log: DataFrame, snapshot: DataFrame, key: list[str]) -> DataFrame:
    """Snapshot rows whose payload differs from the entity's newest row, or whose entity is new or was unlisted.

    An entity that a snapshot lists twice counts once: its newest row, of several the one with the smallest hash.
    """
    snapshot = latest(snapshot, key, [F.desc("observed_at"), "payload_sha256"])
    now = newest(log, key).select(*key, F.col("payload_sha256").alias("_hash"), F.col("listed").alias("_listed"))
    both = snapshot.join(now, key, "left")
    return both.where(~F.col("_hash").eqNullSafe(F.col("payload_sha256")) | ~F.coalesce("_listed", F.lit(False))).drop("_hash", "_listed")


def removals(log: DataFrame, snapshot: DataFrame, key: list[str], observed_at) -> DataFrame:
    """A copy with listed = false of each listed entity that left the snapshot."""
    gone = newest(log, key).where("listed").join(snapshot.select(*key), key, "left_anti")
    return gone.withColumns({"listed": F.lit(False), "observed_at": F.lit(observed_at)})


class MassRemoval(ValueError):
    """A snapshot that lacks more entities than a run may unlist."""


def bounded_removals(log: DataFrame, gone: DataFrame, key: list[str], least: int = 25, share: float = 0.2, allow: bool = False) -> DataFrame:
    """``gone``; raises MassRemoval if it is more than max(least, share of the listed), unless the caller allows that."""
    if not allow:
        n, listed = gone.count(), newest(log, key).where("listed").count()
        if n > max(least, share * listed):
            raise MassRemoval(f"{n} of {listed} listed entities are missing from the snapshot")
    return gone


def append(log: DataFrame, snapshot: DataFrame, key: list[str], observed_at, allow_removals: bool = False) -> DataFrame:
    """The rows to add to the log: changed and new entities, then the removed ones. Nothing is added when too many are missing (MassRemoval)."""
    gone = bounded_removals(log, removals(log, snapshot, key, observed_at), key, allow=allow_removals)
    return changes(log, snapshot, key).unionByName(gone, allowMissingColumns=True)


def missing_hours(log: DataFrame, wanted: DataFrame, key: list[str], time: str) -> DataFrame:
    """Wanted (key, hour) rows at or before the newest stored hour that the log lacks."""
    top = log.agg(F.max(time).alias("_top"))
    return wanted.join(F.broadcast(top), F.col(time) <= F.col("_top"), "left_semi").join(log, [*key, time], "left_anti")


def sweep_candidates(log: DataFrame, snapshot: DataFrame, id_column: str, settled: str, ahead: int = 3, limit: int | None = None) -> DataFrame:
    """Ids to ask for, by priority: 0 vanished from the snapshot, 1 listed and unsettled, 2 never seen up to the largest + ahead."""
    known = newest(log, [id_column])
    gone = known.where("listed").join(snapshot, id_column, "left_anti").select(id_column, F.lit(0).alias("priority"))
    open_ = known.join(snapshot.select(id_column), id_column, "left_semi").where(~F.col(settled)).select(id_column, F.lit(1).alias("priority"))
    top = known.agg(F.coalesce(F.max(id_column), F.lit(-1))).first()[0]
    unseen = log.sparkSession.range(top + ahead + 1).select(F.col("id").alias(id_column)).join(known, id_column, "left_anti").select(id_column, F.lit(2).alias("priority"))
    out = gone.unionByName(open_).unionByName(unseen).orderBy("priority", id_column)
    return out.limit(limit) if limit else out


def stale(log: DataFrame, key: list[str], now_seconds: int, seconds: str, most: int = 7200) -> DataFrame:
    return log.groupBy(*key).agg(F.max(seconds).alias("newest")).withColumn("behind", F.lit(now_seconds) - F.col("newest")).where(F.col("behind") > most)


def history(log: DataFrame, key: list[str], time: str = "observed_at") -> DataFrame:
    """Validity intervals [valid_from, valid_to)."""
    w = Window.partitionBy(*key).orderBy(time)
    return log.withColumns({"valid_from": F.col(time), "valid_to": F.lead(time).over(w)})


def current_filled(log: DataFrame, key: list[str], columns: list[str], time: str = "observed_at") -> DataFrame:
    """The newest row of each entity, its gaps filled from the last row that knew."""
    from blockwright.operators.aggregates import filled_forward

    return newest(filled_forward(log, key, time, columns), key, time)


def verify(log: DataFrame, key: list[str], payload: list[str], time: str = "observed_at") -> DataFrame:
    """(key, time, kind): hash_mismatch where the payload's hash isn't the stored one, repeated where two rows in a row say the same,
    duplicate_time, and orphan_removal where a row unlists an entity that isn't listed before it."""
    w = Window.partitionBy(*key).orderBy(time)
    same = (F.lag("payload_sha256").over(w) == F.col("payload_sha256")) & (F.lag("listed").over(w) == F.col("listed"))
    checks = {"hash_mismatch": ~payload_hash(payload).eqNullSafe(F.col("payload_sha256")), "repeated": same, "duplicate_time": F.lag(time).over(w) == F.col(time), "orphan_removal": ~F.col("listed") & ~F.coalesce(F.lag("listed").over(w), F.lit(False))}
    rows = log.withColumns({f"_{k}": F.coalesce(c, F.lit(False)) for k, c in checks.items()})
    kinds = F.filter(F.array(*[F.when(F.col(f"_{k}"), k) for k in checks]), lambda k: k.isNotNull())
    return rows.select(*key, time, F.explode(kinds).alias("kind"))


def evolve(log: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The log under a newer column list, which may only add nullable columns at the end; old rows read null there."""
    have = log.columns
    want = list(columns)
    if want[: len(have)] != have:
        raise ValueError(f"only columns at the end may be added: {have} -> {want}")
    return log.select(*have, *[F.lit(None).cast(columns[c]).alias(c) for c in want[len(have):]])

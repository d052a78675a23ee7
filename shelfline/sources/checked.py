"""Publishing behind gates: partitions are written aside, tested as they are written, and only good ones take the place of old ones."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

from shelfline.session import shuffles_dropped
from shelfline.sources.files import drop_folders, partition_folder, swap_folders
from shelfline.sources.sinks import verify_written


@dataclass(frozen=True)
class Gate:
    """A condition in SQL that every row must meet; null is a failure."""

    name: str
    holds: str


def not_null(*columns: str) -> list[Gate]:
    return [Gate(f"{c} is not null", f"`{c}` IS NOT NULL") for c in columns]


@dataclass
class Published:
    """What became of a publish. Folders are partition folders relative to the table, `dt=2026-01-01`."""

    rows: int
    good: list[str]
    cleared: list[str]
    #: Folder -> names of the gates that rows of it failed.
    bad: dict[str, list[str]] = field(default_factory=dict)
    #: Gate -> rows that failed it.
    failures: dict[str, int] = field(default_factory=dict)

    def checked(self) -> Published:
        """Fails if a partition was held back."""
        if self.bad:
            raise GateError(f"held back: {self.bad}; failing rows: {self.failures}")
        return self


class GateError(ValueError):
    """Partitions that didn't pass; their old content is still in place."""


def publish_checked(
    df: DataFrame, path: str, parts: list[str], gates: list[Gate], key: list[str] | None = None, sort_by: str | None = None,
    replaced: list[dict[str, str]] | None = None,
) -> Published:
    """Replace the partitions present in `df`, each by one rename, if all its rows pass.

    Rows and failures are counted by observed metrics in the stage that writes, which yields for each gate the partitions that
    failed it: no pass of its own. With `key`, partitions in which a key occurs twice fail too; that reads the key columns of what
    was written. The files must hold as many rows as were counted. Partitions that fail stay as they were, as does everything if
    the write itself fails. Of the partitions in `replaced`, those without a row are dropped. The shuffle files of the write go
    with it.
    """
    spark = df.sparkSession
    written = Observation()
    where = F.struct(*[F.col(p).cast("string").alias(p) for p in parts])
    fails = [~F.coalesce(F.expr(g.holds), F.lit(False)) for g in gates]
    measured = [F.count(F.lit(1)).alias("n"), F.collect_set(where).alias("parts")]
    measured += [F.count_if(f).alias(f"n{i}") for i, f in enumerate(fails)]
    measured += [F.collect_set(F.when(f, where)).alias(f"parts{i}") for i, f in enumerate(fails)]
    spread = df.hint("rebalance", *[F.col(p) for p in parts])
    spread = spread.sortWithinPartitions(*parts, sort_by) if sort_by else spread
    # A folder that readers of the table don't see.
    aside = f"{path}/_staged"
    drop_folders(spark, aside)
    with shuffles_dropped(spark):
        spread.observe(written, *measured).write.partitionBy(*parts).parquet(aside)
    seen = written.get
    folder = lambda r: "/".join(partition_folder(spark, p, r[p]) for p in parts)
    held: dict[str, list[str]] = {}
    for i, gate in enumerate(gates):
        for r in seen[f"parts{i}"]:
            held.setdefault(folder(r), []).append(gate.name)
    present = sorted(folder(r) for r in seen["parts"])
    if present:
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        schema = ", ".join(f"`{c}` {'string' if c in parts else types[c]}" for c in [*(key or []), *parts] if c in types)
        stored = spark.read.schema(schema).parquet(aside)
        verify_written(stored, seen["n"], aside)
        if key:
            twice = stored.groupBy(*dict.fromkeys([*parts, *key])).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            with shuffles_dropped(spark):
                repeated = twice.select(*parts).distinct().collect()
            for r in repeated:
                held.setdefault(folder(r), []).append(f"{', '.join(key)} is unique")
    good = [f for f in present if f not in held]
    swap_folders(spark, aside, path, good)
    gone = sorted({folder(r) for r in replaced or []} - set(present))
    for f in gone:
        drop_folders(spark, f"{path}/{f}")
    drop_folders(spark, aside)
    counts = {g.name: seen[f"n{i}"] for i, g in enumerate(gates) if seen[f"n{i}"]}
    return Published(seen["n"], good, gone, held, counts)

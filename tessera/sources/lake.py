"""Datasets of a date-partitioned lake: range reads, gaps, audits, atomic publishing, restatement diffs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingPartition(LookupError):
    """Nothing is published for what was asked."""


class AuditFailed(ValueError):
    """A staged table breaks a rule; nothing of it was published."""


@dataclass(frozen=True)
class Dataset:
    """A published dataset. ``key`` is the partition column of an event stream, or None for a table that each pull replaces.

    ``schema`` types reads of a source that has no files yet; ``merge`` unites files that differ in columns, as vendors
    add fields; ``member`` is a second partition column for streams that are published member by member.
    """

    name: str
    key: str | None = "date"
    schema: T.StructType | None = None
    merge: bool = False
    member: str | None = None


@dataclass
class Rule:
    """A condition that rows (or, with ``whole``, the table's aggregate) must meet; null fails."""

    name: str
    holds: Column
    whole: bool = False


@dataclass
class Lake:
    """A root folder with one folder per dataset, on any file system that Spark reads."""

    spark: SparkSession
    root: str
    datasets: dict[str, Dataset] = field(default_factory=dict)

    def register(self, *datasets: Dataset) -> Lake:
        self.datasets.update({d.name: d for d in datasets})
        return self

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _of(self, name: str, stream: bool) -> Dataset:
        found = self.datasets[name]
        if (found.key is not None) != stream:
            raise TypeError(f"{name} is {'an event stream' if found.key else 'a current table'}")
        return found

    def partitions(self, name: str) -> list[dt.date]:
        """Published dates, from folder names alone. A folder without data is no partition."""
        ds = self._of(name, True)
        path, fs = self._path(name)
        if not fs.exists(path):
            return []
        folders = [f.getPath() for f in fs.listStatus(path) if f.isDirectory() and f.getPath().getName().startswith(f"{ds.key}=")]
        return sorted(dt.date.fromisoformat(f.getName().split("=", 1)[1]) for f in folders if len(fs.listStatus(f)))

    def coverage(self, name: str) -> tuple[dt.date, dt.date]:
        dates = self.partitions(name)
        if not dates:
            raise MissingPartition(name)
        return dates[0], dates[-1]

    def read(self, name: str) -> DataFrame:
        """The whole dataset; an empty typed table if nothing is published and a schema is known."""
        ds = self.datasets[name]
        path, fs = self._path(name)
        if not fs.exists(path):
            if ds.schema is None:
                raise MissingPartition(name)
            return self.spark.createDataFrame([], ds.schema)
        reader = self.spark.read.option("mergeSchema", str(ds.merge).lower())
        return reader.parquet(f"{self.root}/{name}")

    def series(self, name: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """Rows of [start, end], both inclusive, by partition pruning; gaps inside are allowed, nothing at all is not."""
        ds = self._of(name, True)
        if start and end and start > end:
            raise ValueError(f"{start} is after {end}")
        if not any((not start or d >= start) and (not end or d <= end) for d in self.partitions(name)):
            raise MissingPartition(name)
        rows = self.read(name)
        if start:
            rows = rows.where(F.col(ds.key) >= F.lit(start))
        return rows.where(F.col(ds.key) <= F.lit(end)) if end else rows

    def on_date(self, name: str, date: dt.date) -> DataFrame:
        if date not in self.partitions(name):
            raise MissingPartition(f"{name} {date}")
        return self.series(name, date, date)

    def current(self, name: str) -> DataFrame:
        self._of(name, False)
        return self.read(name)

    def gaps(self, name: str, calendar: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """Sessions of a calendar (date) within the range that have no partition."""
        first, last = self.coverage(name)
        have = self.spark.createDataFrame([(d,) for d in self.partitions(name)], "date date")
        inside = calendar.where(F.col("date").between(F.lit(start or first), F.lit(end or last)))
        return inside.join(F.broadcast(have), "date", "left_anti")

    def sizes(self, name: str) -> DataFrame:
        """Files, bytes and rows of each partition (of the table, if it has none)."""
        ds = self.datasets[name]
        rows = self.read(name).select(*([ds.key] if ds.key else []), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        files = rows.groupBy(*([ds.key] if ds.key else []), "file", "bytes").agg(F.count("*").alias("rows"))
        return files.groupBy(*([ds.key] if ds.key else [])).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))

    def _swap(self, fs, new, target) -> None:
        """Puts a folder in another's place. The old one is set aside first, and comes back if the new one cannot be moved."""
        aside, _ = self._path(f"_staged/old-{uuid.uuid4().hex}")
        had = fs.exists(target)
        if had:
            fs.mkdirs(aside.getParent())
            fs.rename(target, aside)
        if not fs.rename(new, target):
            if had:
                fs.rename(aside, target)
            raise OSError(f"{new} could not be moved to {target}")
        fs.delete(aside, True)

    def publish(self, name: str, rows: DataFrame, rules: list[Rule] = (), order: list[str] = (), replace: bool = False) -> list[dt.date]:
        """Stages, audits, then publishes by rename. Partitions that exist stay as they are unless ``replace``.

        Returns the dates published. A failed audit raises and leaves nothing behind. Files are zstd Parquet, sorted by ``order``.
        """
        ds = self.datasets[name]
        staged = f"_staged/{name}-{uuid.uuid4().hex}"
        out = rows.sortWithinPartitions(*order) if order else rows
        writer = out.write.option("compression", "zstd")
        keys = [k for k in (ds.key, ds.member) if k]
        (writer.partitionBy(*keys) if keys else writer).parquet(f"{self.root}/{staged}")
        source, fs = self._path(staged)
        try:
            audit(self.spark.read.parquet(f"{self.root}/{staged}"), rules)
            target, _ = self._path(name)
            if not keys:
                fs.mkdirs(target.getParent())
                self._swap(fs, source, target)
                return []
            fs.mkdirs(target)
            done = []
            for folder in [f.getPath() for f in fs.listStatus(source) if f.isDirectory()]:
                place, _ = self._path(f"{name}/{folder.getName()}")
                if fs.exists(place) and len(fs.listStatus(place)) and not replace:
                    continue
                self._swap(fs, folder, place)
                done.append(dt.date.fromisoformat(folder.getName().split("=", 1)[1]))
            return sorted(done)
        finally:
            fs.delete(source, True)


def violations(rows: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """How many rows break each rule (1 for a rule on the whole table), in one scan."""
    if not rules:
        return {}
    cells = [(~F.coalesce(r.holds, F.lit(False))).cast("int").alias(r.name) if r.whole else F.count_if(~F.coalesce(r.holds, F.lit(False))).alias(r.name) for r in rules]
    return rows.agg(*cells).first().asDict()


def audit(rows: DataFrame, rules: list[Rule]) -> None:
    broken = {name: n for name, n in violations(rows, rules).items() if n}
    if broken:
        raise AuditFailed(", ".join(f"{name}: {n}" for name, n in broken.items()))


def bar_rules(least: int) -> list[Rule]:
    """What a session's bars must meet: enough rows, unique names, positive prices within the day's range, no negative volume."""
    price = ["open", "high", "low", "close"]
    return [
        Rule("enough_rows", F.count("*") >= least, whole=True),
        Rule("unique_names", F.count("*") == F.countDistinct("ticker"), whole=True),
        Rule("prices_positive", F.least(*price) > 0),
        Rule("high_is_highest", F.col("high") >= F.greatest("open", "low", "close")),
        Rule("low_is_lowest", F.col("low") <= F.least("open", "high", "close")),
        Rule("volume_not_negative", F.col("volume") >= 0),
    ]


def newest_pull(rows: DataFrame, by: list[str], value: str, pulled: str) -> DataFrame:
    """Folds dated pulls: each key's value from the newest pull that has one."""
    known = rows.where(F.col(value).isNotNull())
    return known.groupBy(*by).agg(F.max_by(value, pulled).alias(value), F.max(pulled).alias(pulled))


def event_keys(pull: DataFrame, by: list[str], factor: str) -> DataFrame:
    """One row per event of a pull: whether its rows agree on the factor, and the factor."""
    agree = (F.countDistinct(factor) <= 1) & F.count(factor).isin(0) | (F.countDistinct(factor) <= 1) & (F.count(factor) == F.count("*"))
    return pull.groupBy(*by).agg(agree.alias("agree"), F.min(factor).alias("f"))


def restatement(old: DataFrame, new: DataFrame, by: list[str], factor: str) -> DataFrame:
    """What a newer pull changed, one row: events added, removed and restated, disagreeing events, largest relative change.

    One full join of two pre-aggregated pulls; null factors are compared as values.
    """
    a = event_keys(old, by, factor).select(*by, F.col("agree").alias("a_ok"), F.col("f").alias("a_f"), F.lit(True).alias("in_a"))
    b = event_keys(new, by, factor).select(*by, F.col("agree").alias("b_ok"), F.col("f").alias("b_f"), F.lit(True).alias("in_b"))
    both = a.join(b, by, "full")
    changed = F.col("a_ok") & F.col("b_ok") & ~F.col("a_f").eqNullSafe(F.col("b_f"))
    step = F.abs(F.col("b_f") - F.col("a_f")) / F.nullif(F.abs("a_f"), F.lit(0.0))
    return both.agg(
        F.count_if(F.col("in_a").isNull()).alias("added"),
        F.count_if(F.col("in_b").isNull()).alias("removed"),
        F.count_if(changed).alias("restated"),
        F.count_if(~F.col("a_ok")).alias("old_disagree"),
        F.count_if(~F.col("b_ok")).alias("new_disagree"),
        F.max(F.when(changed, step)).alias("largest"),
        F.count_if(F.col("a_ok") & F.col("b_ok") & (F.col("a_f").isNull() != F.col("b_f").isNull())).alias("null_changes"),
    )


def fill(lake: Lake, name: str, dates: list[dt.date], build: Callable[[dt.date], DataFrame], rules: list[Rule] = ()) -> tuple[list[dt.date], dict[dt.date, str]]:
    """Publishes the dates that have no partition yet; a date that fails is reported and does not stop the others."""
    have, done, failed = set(lake.partitions(name)), [], {}
    for date in dates:
        if date in have:
            continue
        try:
            done += lake.publish(name, build(date), rules)
        except Exception as error:  # any failure of one date is its own
            failed[date] = f"{type(error).__name__}: {error}"
    return done, failed


def thinned(dates: list[dt.date], today: dt.date, daily: int = 14, monthly: int = 12) -> list[dt.date]:
    """The pulls to keep: all of the last ``daily`` days, the last of each of the last ``monthly`` months before, the first ever."""
    keep = {d for d in dates if (today - d).days <= daily} | set(sorted(dates)[:1])
    last_of: dict[tuple[int, int], dt.date] = {}
    for d in sorted(dates):
        last_of[d.year, d.month] = d
    months = {(today.year * 12 + today.month - 1 - k) for k in range(monthly)}
    return sorted(keep | {d for (y, m), d in last_of.items() if y * 12 + m - 1 in months})

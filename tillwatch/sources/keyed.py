"""Tables with one row per key, whatever day the key is delivered under.

Beside its rows such a table keeps a narrow index: key, day, a hash of the row and the
number of the load, in buckets of the key's hash; and of each load the days it changed. A load looks its keys up there, never
among the rows, so it finds a key that is stored under any other day. Only buckets that
the delivery touches are read.

Every load is first written to a folder of its own and takes effect from the moment a
marker is set there. A load that breaks off before is forgotten, one that breaks off
later is completed by the next. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwatch.operators import routing
from tillwatch.sources import files
from tillwatch.sources.tables import DEFAULT_FORMAT, read_table, stored_schema, write_table

KEEP, REPLACE = "keep", "replace"
NEW, CHANGED, SAME = "new", "changed", "same"


@dataclass(frozen=True)
class Loaded:
    """What a load did: rows by kind, and the days whose rows are now others (None: rows without a day)."""

    new: int
    changed: int
    same: int
    days: tuple[object, ...]


def identity(df: DataFrame, key: str) -> Column:
    """Text that tells rows apart: the key, or a hash of all columns where it is null."""
    columns = [F.col(f"`{c}`").cast("string") for c in sorted(df.columns)]
    whole = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    return F.coalesce(F.concat(F.lit("k"), F.col(f"`{key}`").cast("string")), F.concat(F.lit("r"), whole))


@dataclass(frozen=True)
class KeyedTable:
    """The table at `path`.

    `version` names a column by which the latest of several rows of a key wins, within
    a delivery and against the stored row; without it the first in column order wins
    within a delivery, and a later delivery against the stored row. Columns in `unlike`,
    such as load stamps, do not make a row another one. A load of `compact_after` folders
    of index entries folds them into one.
    """

    spark: SparkSession
    path: str
    key: str = "transaction_id"
    day: str = "transaction_date"
    partition_by: tuple[str, ...] = ("transaction_date",)
    version: str | None = None
    unlike: tuple[str, ...] = ()
    buckets: int = 32
    compact_after: int = 32
    fmt: str = DEFAULT_FORMAT

    # ---- the index --------------------------------------------------------------------

    @property
    def _keys(self) -> str:
        return f"{self.path.rstrip('/')}/_keys"  # readers of the table pass over names with an underscore

    @property
    def _loads(self) -> str:
        return f"{self.path.rstrip('/')}/_loads"

    @property
    def _changes(self) -> str:
        return f"{self.path.rstrip('/')}/_changes"

    def changed_since(self, sequence: int) -> tuple[int, list[object]]:
        """Number of the last load, and the days that loads after `sequence` have changed."""
        numbers = [int(n.removeprefix("seq=")) for n in files.names(self.spark, self._changes)]
        later = [n for n in numbers if n > sequence]
        days = {d for n in later for d in self._days(self.spark.read.parquet(f"{self._changes}/seq={n}"))}
        return max([sequence, *later]), sorted(days, key=str)

    def indexed(self) -> bool:
        return bool(self._sequences())

    def _sequences(self) -> list[int]:
        """Numbers of the loads whose index entries count: from the last fold on."""
        found = files.names(self.spark, self._keys)
        folds = [int(n.removeprefix("fold-")) for n in found if n.startswith("fold-")]
        every = [int(n.removeprefix("seq=")) for n in found if n.startswith("seq=")]
        return sorted(n for n in every if n >= max(folds, default=0))

    def _index_schema(self, rows: T.StructType) -> T.StructType:
        version = T.StringType() if self.version is None else rows[self.version].dataType
        return T.StructType(
            [
                T.StructField("key", T.StringType()),
                T.StructField("day", rows[self.day].dataType),
                T.StructField("row_hash", T.LongType()),
                T.StructField("version", version),
                T.StructField("seq", T.LongType()),
                T.StructField("bucket", T.IntegerType()),
            ]
        )

    def index(self, schema: T.StructType) -> DataFrame:
        """All entries that count; the one with the largest `seq` holds for a key."""
        paths = [f"{self._keys}/seq={n}" for n in self._sequences()]
        index = self._index_schema(schema)
        if not paths:
            return self.spark.createDataFrame([], index)
        return self.spark.read.schema(index).option("basePath", self._keys).parquet(*paths)

    def _entries(self, rows: DataFrame) -> DataFrame:
        """Index entries of rows, with the rows themselves beside them."""
        counted = [c for c in sorted(rows.columns) if c not in self.unlike]
        version = F.lit(None).cast("string") if self.version is None else F.col(f"`{self.version}`")
        key = identity(rows.select(*[f"`{c}`" for c in rows.columns if c not in self.unlike]), self.key)
        return rows.withColumns(
            {
                "_key": key,
                "_row_hash": F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in counted]),
                "_version": version,
            }
        ).withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(self.buckets)).cast("int"))

    def _write_index(self, entries: DataFrame, sequence: int) -> None:
        """One folder per load, one per bucket in it, sorted by key; a Bloom filter per file helps look-ups."""
        (
            entries.repartition("bucket")
            .sortWithinPartitions("bucket", "key")
            .write.mode("overwrite")
            .option("parquet.bloom.filter.enabled#key", "true")
            .partitionBy("bucket")
            .parquet(f"{self._keys}/seq={sequence}")
        )

    def reindex(self) -> None:
        """Build the index of a table that has none; reads the whole table once."""
        rows = self._entries(read_table(self.spark, self.path, self.fmt)).withColumn("_day", F.col(f"`{self.day}`"))
        self._write_index(rows.select(*self._as_entry()), 1)

    @staticmethod
    def _as_entry() -> list[Column]:
        names = {"_key": "key", "_row_hash": "row_hash", "_version": "version", "_bucket": "bucket"}
        return [F.col(old).alias(new) for old, new in names.items()] + [F.col("_day").alias("day")]

    def _fold_index(self, schema: T.StructType) -> None:
        """Fold the entries of many loads into one folder; the marker makes it count."""
        sequences = self._sequences()
        if len(sequences) < self.compact_after:
            return
        latest = F.max_by(F.struct("day", "row_hash", "version"), "seq").alias("held")
        folded = self.index(schema).groupBy("bucket", "key").agg(latest).select("bucket", "key", "held.*")
        number = sequences[-1] + 1
        self._write_index(folded, number)
        files.mark(self.spark, f"{self._keys}/fold-{number}")
        for old in sequences:
            files.delete(self.spark, f"{self._keys}/seq={old}")

    # ---- loads ------------------------------------------------------------------------

    def load(self, source: DataFrame, on_conflict: str = KEEP) -> Loaded:
        """Bring a delivery in; repeating it changes nothing.

        Rows whose key is stored under no day are added. Of a key that is stored already
        `keep` leaves the stored row, `replace` puts the delivered one in its place, under
        its own day, unless it is equal or of an older version. Under `keep` a row stored without
        a day does not stand for one that has its day. Only days that lose or change a row are rewritten. Rows without a key are told apart by their columns.
        """
        if on_conflict not in (KEEP, REPLACE):
            raise ValueError(f"on_conflict is {KEEP} or {REPLACE}, not {on_conflict}")
        if on_conflict == REPLACE and tuple(self.partition_by) != (self.day,):
            raise ValueError("rows can be replaced only in a table with one folder per day")
        schema = source.schema
        self.recover(schema)
        if stored_schema(self.spark, self.path, self.fmt) is None:
            # The files of an empty frame give the table its columns.
            write_table(source.limit(0), self.path, self.fmt)
        elif not self.indexed():
            self.reindex()
        sequence = max(self._sequences(), default=0) + 1
        here = f"{self._loads}/{sequence}"

        delivered = self._stage(self._once(source), f"{here}/delivered")
        judged = self._stage(self._judged(delivered, schema, on_conflict), f"{here}/judged")
        kinds = {r.kind: r.n for r in judged.groupBy("_kind").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("_kind", "kind").collect()}
        loaded = judged.filter(F.col("_kind") != SAME)
        moved = loaded.filter(F.col("_kind") == CHANGED)
        affected = self._days(moved.select("_old_day").union(moved.select("_day"))) if kinds.get(CHANGED) else []
        days = sorted({*affected, *self._days(loaded.select("_day"))}, key=lambda d: (d is not None, str(d)))
        result = Loaded(kinds.get(NEW, 0), kinds.get(CHANGED, 0), kinds.get(SAME, 0), tuple(days))
        if result.new or result.changed:
            self._prepare(loaded, affected, days, here, source.columns)
            files.mark(self.spark, f"{here}/READY")
            self._apply(sequence, recovering=False)
            self._fold_index(schema)
        files.delete(self.spark, here)
        return result

    def _stage(self, df: DataFrame, path: str) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _once(self, source: DataFrame) -> DataFrame:
        """One row per key of a delivery, with its index entry and day."""
        named = self._entries(source).withColumn("_day", F.col(f"`{self.day}`"))
        others = [f.name for f in source.schema.fields if routing._orderable(f.dataType)]
        order = [F.col(f"`{c}`") for c in others]
        if self.version is not None:
            order = [F.col("_version").desc_nulls_last(), *order]
        return routing.dedup(named, ["_key"], order)

    def _judged(self, delivered: DataFrame, schema: T.StructType, on_conflict: str) -> DataFrame:
        """Each delivered row, what it is against the stored rows, and the day its key is stored under."""
        touched = [r[0] for r in delivered.select("_bucket").distinct().collect()]  # at most `buckets`
        near = self.index(schema).filter(F.col("bucket").isin(touched))
        wanted = delivered.select(F.col("_key").alias("key"))
        found = near.join(wanted, "key", "left_semi").groupBy("key").agg(
            F.max_by(F.struct("day", "row_hash", "version"), "seq").alias("held")
        )
        met = delivered.join(found, F.col("_key") == F.col("key"), "left")
        equal = (F.col("held.row_hash") == F.col("_row_hash")) & F.col("held.day").eqNullSafe(F.col("_day"))
        older = F.coalesce(F.col("held.version") > F.col("_version"), F.lit(False))
        stays = F.lit(True) if on_conflict == KEEP else equal | older
        fresh = F.col("key").isNull()
        if on_conflict == KEEP:  # a row stored without a day does not stand for one that has its day
            fresh = fresh | (F.col("held.day").isNull() & F.col("_day").isNotNull())
        kind = F.when(fresh, F.lit(NEW)).when(stays, F.lit(SAME)).otherwise(F.lit(CHANGED))
        return met.select(*[F.col(f"`{c}`") for c in delivered.columns], kind.alias("_kind"), F.col("held.day").alias("_old_day"))

    @staticmethod
    def _days(column: DataFrame) -> list[object]:
        """Distinct days, as many as the calendar has at most."""
        return [r[0] for r in column.distinct().collect()]

    def _on(self, days: Sequence[object], column: str | None = None) -> Column:
        at = F.col(f"`{column or self.day}`")
        on = at.isin([d for d in days if d is not None])
        return on | at.isNull() if None in days else on

    def _prepare(
        self, loaded: DataFrame, affected: list[object], days: list[object], here: str, columns: list[str]
    ) -> None:
        """Write all that the load will change: whole days that change, rows to add, index entries, and which days these are."""
        rows = [f"`{c}`" for c in columns]
        self._note_days(days, loaded.schema["_day"], f"{here}/touched")
        loaded.select(*self._as_entry()).write.mode("overwrite").parquet(f"{here}/keys")
        added = loaded
        if affected:
            stored = read_table(self.spark, self.path, self.fmt).filter(self._on(affected))
            gone = loaded.filter(F.col("_kind") == CHANGED).select("_key")
            stay = self._entries(stored).join(gone, "_key", "left_anti").select(*rows)
            on_affected = self._on(affected, "_day")
            whole = stay.unionByName(loaded.filter(on_affected).select(*rows))
            whole.write.mode("overwrite").parquet(f"{here}/days")
            self._note_days(affected, loaded.schema["_day"], f"{here}/affected")
            added = loaded.filter(~F.coalesce(on_affected, F.lit(False)))
        added.select(*rows).write.mode("overwrite").parquet(f"{here}/added")

    def _note_days(self, days: list[object], field: T.StructField, path: str) -> None:
        listed = self.spark.createDataFrame([(d,) for d in days], T.StructType([field]))
        listed.coalesce(1).write.mode("overwrite").parquet(path)

    def _apply(self, sequence: int, recovering: bool) -> None:
        """Carry a prepared load out. All of it can be repeated."""
        here = f"{self._loads}/{sequence}"
        if files.exists(self.spark, f"{here}/affected"):
            affected = self._days(self.spark.read.parquet(f"{here}/affected"))
            replace_days(self.spark.read.parquet(f"{here}/days"), self.path, self.day, affected, self.fmt)
        added = self.spark.read.parquet(f"{here}/added")
        if recovering:
            # Some of them may have arrived before the load broke off.
            days = self._days(added.select(F.col(f"`{self.day}`")))
            stored = read_table(self.spark, self.path, self.fmt).filter(self._on(days))
            known = self._entries(stored).select("_key")
            added = self._entries(added).join(known, "_key", "left_anti").select(*[f"`{c}`" for c in added.columns])
        write_table(added, self.path, self.fmt, mode="append", partition_by=self.partition_by)
        self.spark.read.parquet(f"{here}/touched").coalesce(1).write.mode("overwrite").parquet(f"{self._changes}/seq={sequence}")
        self._write_index(self.spark.read.parquet(f"{here}/keys"), sequence)

    def recover(self, schema: T.StructType | None = None) -> None:
        """Complete a load that broke off after it was ready; forget one that was not."""
        for name in files.names(self.spark, self._loads):
            if files.exists(self.spark, f"{self._loads}/{name}/READY"):
                self._apply(int(name), recovering=True)
            files.delete(self.spark, f"{self._loads}/{name}")

    def find(self, keys: Sequence[object]) -> DataFrame:
        """Rows of a few keys; reads their buckets of the index, then only the days they lie on."""
        table = read_table(self.spark, self.path, self.fmt)
        named = [f"k{k}" for k in keys]
        of = self.spark.createDataFrame([(k,) for k in named], "key string")
        buckets = [r[0] for r in of.select(F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int")).distinct().collect()]
        near = self.index(table.schema).filter(F.col("bucket").isin(buckets) & F.col("key").isin(named))
        held = near.groupBy("key").agg(F.max_by("day", "seq").alias("day"))
        return table.filter(self._on(self._days(held.select("day"))) & F.col(f"`{self.key}`").cast("string").isin([str(k) for k in keys]))


def replace_days(df: DataFrame, path: str, column: str, days: Sequence[object], fmt: str = DEFAULT_FORMAT) -> None:
    """Make `df`, whose rows lie on `days`, the contents of these folders; other folders stay as they are."""
    spark = df.sparkSession
    left = {r[0] for r in df.select(F.col(f"`{column}`")).distinct().collect()}
    writer = df.hint("rebalance", column).write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(column).save(path)
    files.delete_partitions(spark, path, column, [d for d in days if d not in left])

"""Stored tables that change in one step: immutable folders of files, and a manifest that names those of every table.

A load writes new folders, checks them, and publishes the next manifest.  Readers go by the newest manifest, so they see
all tables of a load or none, whatever fails on the way; folders that no manifest names are waste, not data.  Two loads at the same time
cannot both publish the same version: the second one fails and can be repeated.  The manifest has a row for each folder, not for each
file or row of data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelspark.operators.numbering import surrogate_id
from panelspark.operators.quality import duplicate_keys, missing_values, orphan_keys
from panelspark.operators.rank import upsert_latest
from panelspark.plans.star import conform
from panelspark.sources.delimited import read_delimited
from panelspark.tables import settle

BUCKET = "_bucket"


class ConstraintError(ValueError):
    """What a load would break: (table, constraint, rows)."""

    def __init__(self, broken: list[tuple[str, str, int]]) -> None:
        super().__init__("; ".join(f"{t}: {c}: {n} rows" for t, c, n in broken))
        self.broken = broken


@dataclass(frozen=True)
class Stored:
    """The folders of a table, and by bucket where it is kept by hash of its keys."""

    folders: list[str] = field(default_factory=list)
    by_bucket: dict[str, list[str]] = field(default_factory=dict)
    buckets: int = 0

    @property
    def all_folders(self) -> list[str]:
        return self.folders + [f for part in self.by_bucket.values() for f in part]


@dataclass(frozen=True)
class Constraints:
    """What must hold for the rows of a table: unique keys, columns without NULL, and references: column → (table, column)."""

    unique: Sequence[Sequence[str]] = ()
    required: Sequence[str] = ()
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)


class Warehouse:
    """Tables below one folder."""

    def __init__(self, spark: SparkSession, folder: str, schemas: Mapping[str, StructType]) -> None:
        self.spark, self.folder, self.schemas = spark, folder.rstrip("/"), dict(schemas)
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self.folder).getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.folder).toUri(), conf)

    # The manifest

    def _manifests(self) -> list[str]:
        place = self._path(f"{self.folder}/_manifests")
        if not self._files.exists(place):
            return []
        return sorted(str(s.getPath().getName()) for s in self._files.listStatus(place) if str(s.getPath().getName()).endswith(".json"))

    def current(self) -> tuple[int, dict[str, Stored]]:
        """(version, tables); version 0 has none."""
        names = self._manifests()
        if not names:
            return 0, {}
        stream = self._files.open(self._path(f"{self.folder}/_manifests/{names[-1]}"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return int(names[-1].removesuffix(".json")), {name: Stored(**t) for name, t in json.loads(text).items()}

    def publish(self, version: int, tables: Mapping[str, Stored]) -> int:
        """Makes ``tables`` what readers see, if ``version`` is still the newest; one rename, which fails where the target exists."""
        place = f"{self.folder}/_manifests"
        new = self._path(f"{place}/{uuid.uuid4().hex}.tmp")
        stream = self._files.create(new, False)
        stream.write(json.dumps({n: t.__dict__ for n, t in tables.items()}).encode())
        stream.close()
        gateway = self.spark.sparkContext._gateway
        none = gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self._context.rename(new, self._path(f"{place}/{version + 1:012d}.json"), none)
        return version + 1

    # Reading and writing folders

    def _read(self, name: str, folders: Sequence[str]) -> DataFrame:
        schema = self.schemas[name]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, name: str) -> DataFrame:
        """The table as of the newest manifest; empty where it was never loaded."""
        return self._read(name, self.current()[1].get(name, Stored()).all_folders)

    def _new_folder(self, name: str) -> str:
        return f"{self.folder}/{name}/{uuid.uuid4().hex}"

    def stage(self, name: str, df: DataFrame) -> Stored:
        """Writes ``df`` where no reader looks yet."""
        path = self._new_folder(name)
        df.write.parquet(path)
        return Stored([path])

    def bucket_of(self, keys: Sequence[str], buckets: int) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def stage_buckets(self, name: str, df: DataFrame, keys: Sequence[str], buckets: int) -> Stored:
        """Writes ``df`` by buckets of its keys, each in one folder."""
        path = self._new_folder(name)
        df.withColumn(BUCKET, self.bucket_of(keys, buckets)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)
        parts = [str(s.getPath().getName()) for s in self._files.listStatus(self._path(path)) if s.isDirectory()]
        return Stored(by_bucket={p.split("=")[1]: [f"{path}/{p}"] for p in sorted(parts) if p.startswith(f"{BUCKET}=")}, buckets=buckets)

    # Loads

    def broken(self, staged: Mapping[str, Stored], constraints: Mapping[str, Constraints]) -> list[tuple[str, str, int]]:
        """(table, constraint, rows) that would not hold for the stored rows and the staged ones together."""
        stored = self.current()[1]
        together = {n: self._read(n, stored.get(n, Stored()).all_folders + staged.get(n, Stored()).all_folders) for n in self.schemas}
        counts = []
        for name, rules in constraints.items():
            if name not in staged:
                continue
            # What was stored before has been checked; keys must be unique among both, the rest concerns the new rows.
            new = self._read(name, staged[name].all_folders)
            for keys in rules.unique:
                counts.append((name, f"unique {', '.join(keys)}", duplicate_keys(together[name], keys)))
            for column, (parent, key) in rules.references.items():
                counts.append((name, f"{column} references {parent}", orphan_keys(new, column, together[parent], key)))
            if rules.required:
                missing = missing_values(new, list(rules.required)).withColumnRenamed("n_missing", "n_rows")
                counts.append((name, None, missing))
        if not counts:
            return []
        # One job for all constraints: a row for each.
        parts = [
            df.groupBy(F.concat(F.lit("required "), F.col("column")).alias("rule") if rule is None else F.lit(rule).alias("rule"))
            .agg(F.sum("n_rows").alias("n"))
            .select(F.lit(name).alias("name"), "rule", "n")
            for name, rule, df in counts
        ]
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return sorted((r.name, r.rule, r.n) for r in found.filter("n > 0").select("name", "rule", "n").collect())

    def load(self, frames: Mapping[str, DataFrame], constraints: Mapping[str, Constraints] | None = None, mappings: Mapping[str, Mapping[str, str]] | None = None) -> int:
        """Appends to several tables at once, or to none: staged, checked, then published by one manifest."""
        version, tables = self.current()
        staged = {n: self.stage(n, conform(df, (mappings or {}).get(n, {}), self.schemas[n], keep_id=True)) for n, df in frames.items()}
        broken = self.broken(staged, constraints or {})
        if broken:
            raise ConstraintError(broken)
        for name, new in staged.items():
            old = tables.get(name, Stored())
            tables[name] = Stored(old.folders + new.folders, old.by_bucket, old.buckets)
        return self.publish(version, tables)

    def load_files(self, files: Mapping[str, str], constraints: Mapping[str, Constraints], mappings: Mapping[str, Mapping[str, str]] | None = None, sep: str = ";") -> int:
        """One ``;``-separated file or folder for each table; an absent one fails the whole load."""
        return self.load({n: read_delimited(self.spark, path, sep=sep) for n, path in files.items()}, constraints, mappings)

    def upsert(self, name: str, delta: DataFrame, keys: Sequence[str], version: str, ties: Sequence[str], buckets: int = 64) -> list[int]:
        """Inserts or updates by key, the newest ``version`` winning; only buckets that ``delta`` touches are read and written.

        Returns these buckets.  ``buckets`` counts for a new table; about 1 GB of data each is a good size.
        """
        at, tables = self.current()
        old = tables.get(name, Stored(buckets=buckets))
        if old.folders:
            raise ValueError(f"{name} is not kept by buckets")
        delta = conform(delta, {}, self.schemas[name], keep_id=True)
        touched = sorted(r[0] for r in delta.select(self.bucket_of(keys, old.buckets)).distinct().collect())
        base = self._read(name, [f for b in touched for f in old.by_bucket.get(str(b), [])])
        new = self.stage_buckets(name, upsert_latest(base, delta, keys, version, ties), keys, old.buckets)
        tables[name] = Stored([], old.by_bucket | new.by_bucket, old.buckets)
        self.publish(at, tables)
        return touched

    def number(self, name: str, rows: DataFrame, leading: str, rest: Sequence[str], id: str = "id") -> DataFrame:
        """``rows`` with the ids of a stored table (id, natural key): known keys keep theirs, new ones go on after the largest.

        New keys are numbered by slices, in the order of ``leading`` and a digest of the rest, and are published before ids are given out.
        """
        version, tables = self.current()
        keys = [leading, *rest]
        known = self._read(name, tables.get(name, Stored()).all_folders)
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        asked = rows.select(*keys).distinct()
        new = asked.join(known.select(*[F.col(k).alias(f"_{k}") for k in keys]), same, "left_anti")
        # Read three times below, to be counted, sliced and numbered.
        new = settle(new, f"new-{name}")
        last = known.agg(F.coalesce(F.max(id), F.lit(0)).alias("last")).first().last
        numbered = surrogate_id(new, leading, rest, id).withColumn(id, F.col(id) + F.lit(last))
        staged = self.stage(name, conform(numbered, {}, self.schemas[name], keep_id=True))
        old = tables.get(name, Stored())
        tables[name] = Stored(old.folders + staged.folders)
        self.publish(version, tables)
        ids = self.read(name).select(id, *[F.col(k).alias(f"_{k}") for k in keys])
        return rows.join(ids, same).drop(*[f"_{k}" for k in keys])

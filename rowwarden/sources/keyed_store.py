"""A keyed table in hash buckets, changed by merges that rewrite only what they touch.

    <root>/data/version=<v>/bucket=<b>     the buckets that merge v rewrote, rows sorted by leaf
    <root>/digest/version=<v>              digests of the leaves of those buckets
    <root>/manifest/version=<v>            per bucket: the version that holds it, its rows and its digest

A key's leaf is its hash modulo `leaves`; a bucket is a run of leaves, so key ranges are folders and a range reads
its own files only. A merge stages the changes, reads the buckets they fall into as the version before left them, and
writes those buckets anew, each by as many tasks as its rows ask for. If keys come often or a leaf is hot, the changes
are first reduced to one row per key on the map side; else that would only be a second shuffle. Rows that changed carry
the row before, which gives the changelog (`changes`) without a second table. Digests are sums over rows, so a
merge adds the rows that came and takes away those that went, and hashes nothing else.

The manifest is written last and names every bucket: it is the commit. A merge that is run again starts from the
manifest below its version and gives the same files, so a replayed micro-batch changes nothing. Readers of an older
version are not disturbed until `vacuum`.

Order columns say which row of a key is the last; a change that is not later than the stored row changes
nothing, except that equal order lets the newer message win. Deleted rows are kept as such, so that an earlier change that
comes late does not bring them back; `read` leaves them out. Rows with a null in the key are no keyed rows and
are left out. Rows must be comparable (no maps).
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from rowwarden.functions import hashing
from rowwarden.operators.reconcile import DIGEST

INSERT, BEFORE, AFTER, DELETE = "+I", "-U", "+U", "-D"
WEIGHT = {INSERT: 1, BEFORE: -1, AFTER: 1, DELETE: -1}
SUM = "decimal(38,0)"
TASK_ROWS = 100_000  # rows that a task of a merge is meant to write
MANIFEST = f"bucket int, held_in bigint, row_count bigint, {', '.join(f'{d} {SUM}' for d in DIGEST)}"


Deleted = Callable[[Callable[[str], Column]], Column]  # from the columns of a row, by name


@dataclass(frozen=True)
class Entry:
    """Where a bucket is, and the digest over its rows."""

    version: int
    rows: int
    digest: tuple


class KeyedStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: StructType | str,
        keys: Sequence[str],
        order: Sequence[str],
        buckets: int = 64,
        leaves: int | None = None,
        deleted: Deleted | None = None,
        digest_columns: Sequence[str] | None = None,
    ):
        self.spark, self.root, self.keys, self.order, self.buckets = spark, root, list(keys), list(order), buckets
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else StructType([f for f in schema.fields])
        self.leaves = leaves or buckets * 64
        if self.leaves % buckets:
            raise ValueError("leaves must be a multiple of buckets")
        self._deleted = deleted
        self.digest_columns = list(digest_columns or [c for c in self.schema.names if c not in self.keys])

    def deleted(self, within: str = "") -> Column:
        """Whether a row, or the row in a struct column, is a deleted one."""
        if self._deleted is None:
            return F.lit(False)
        return F.coalesce(self._deleted(lambda name: F.col(f"{within}.{name}" if within else name)), F.lit(False))

    # -------------------------------------------------------------- places

    def _key_text(self, prefix: str = "") -> Column:
        texts = [F.col(f"{prefix}{k}").cast("string") for k in self.keys]
        return texts[0] if len(texts) == 1 else F.to_json(F.array(*texts))

    def leaf(self) -> Column:
        return hashing.key_bucket(self._key_text(), self.leaves)

    def _placed(self, rows: DataFrame) -> DataFrame:
        whole = reduce(operator.and_, [F.col(k).isNotNull() for k in self.keys])
        per = self.leaves // self.buckets
        return rows.where(whole).select(*self.schema.names).withColumn("leaf", self.leaf()).withColumn("bucket", F.expr(f"CAST(leaf div {per} AS INT)"))

    def _row(self) -> Column:
        return F.struct(*self.schema.names)

    # -------------------------------------------------------------- manifest

    def manifest(self, below: int | None = None) -> tuple[int | None, dict[int, Entry]]:
        """(version, entry of each bucket) of the last commit, or of the last one below a version."""
        if not _names(self.spark, f"{self.root}/manifest"):
            return None, {}
        commits = self.spark.read.schema(f"{MANIFEST}, version bigint").parquet(f"{self.root}/manifest")
        rows = (commits if below is None else commits.where(F.col("version") < below)).collect()  # buckets x commits that are kept
        last = max((r.version for r in rows), default=None)
        entries = [r for r in rows if r.version == last and r.bucket is not None]
        return last, {r.bucket: Entry(r.held_in, r.row_count, tuple(r[d] for d in DIGEST)) for r in entries}

    def _commit(self, version: int, entries: dict[int, Entry]) -> None:
        rows = [(b, e.version, e.rows, *e.digest) for b, e in sorted(entries.items())] or [(None, None, None, *[None] * len(DIGEST))]
        _overwrite(self.spark.createDataFrame(rows, MANIFEST).coalesce(1), f"{self.root}/manifest/version={version}")

    # -------------------------------------------------------------- reading

    def _files(self, entries: dict[int, Entry], buckets: Sequence[int] | None = None) -> DataFrame:
        """Stored rows of the given buckets, with bucket, leaf and what a merge noted beside them."""
        fields = [*self.schema.fields, *StructType.fromDDL("leaf bigint, _changed boolean, bucket int").fields]
        schema = StructType(fields).add("_before", self.schema)
        paths = [f"{self.root}/data/version={e.version}/bucket={b}" for b, e in sorted(entries.items()) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths).select(*schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of the last commit, or as of a version that is still kept."""
        _, entries = self.manifest(None if version is None else version + 1)
        return self._files(entries).where(~self.deleted()).select(*self.schema.names)

    def key_range(self, start: int, end: int) -> DataFrame:
        """Rows whose leaf lies in [start, end); only the buckets of the range are read."""
        per = self.leaves // self.buckets
        _, entries = self.manifest()
        rows = self._files(entries, range(start // per, -(-end // per)))
        return rows.where((F.col("leaf") >= start) & (F.col("leaf") < end) & ~self.deleted()).select(*self.schema.names, "leaf")

    def rows_of(self, buckets: Sequence[int]) -> DataFrame:
        """Rows of the given buckets, with their leaf."""
        return self._files(self.manifest()[1], buckets).where(~self.deleted()).select(*self.schema.names, "leaf")

    def beside(self, rows: DataFrame, below: int | None = None) -> DataFrame:
        """The stored rows in the buckets that the keys of `rows` fall into, as they were below a version."""
        _, entries = self.manifest(below)
        return self._files(entries, self._touched(self._keyed(rows))).where(~self.deleted()).select(*self.schema.names)

    def _keyed(self, rows: DataFrame) -> DataFrame:
        per = self.leaves // self.buckets
        return rows.select(*self.keys).dropna().withColumn("leaf", self.leaf()).withColumn("bucket", F.expr(f"CAST(leaf div {per} AS INT)"))

    @staticmethod
    def _touched(placed: DataFrame) -> list[int]:
        return sorted(r.bucket for r in placed.select("bucket").distinct().collect())  # at most one per bucket

    # -------------------------------------------------------------- merging

    def merge(self, changes: DataFrame, version: int) -> list[int]:
        """Bring in the changes as commit `version`; gives the buckets that were written."""
        _, entries = self.manifest(version)
        placed = self._placed(changes).select("bucket", "leaf", *self.schema.names)
        step = f"{self.root}/step"
        _overwrite(placed, step)
        fresh = self.spark.read.schema(placed.schema).parquet(step)
        came = {r.bucket: r for r in fresh.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*self.keys)).alias("keys")).collect()}
        touched = sorted(came)
        if touched:
            n = sum(r.n for r in came.values())
            if 2 * sum(r["keys"] for r in came.values()) < n or fresh.groupBy("leaf").count().agg(F.max("count")).first()[0] > TASK_ROWS:
                fresh = self._reduced(fresh)
            old = self._files(entries, touched).select("bucket", "leaf", *self.schema.names, F.lit(0).alias("_new"))
            both = old.unionByName(fresh.withColumn("_new", F.lit(1)))
            held = sum(e.rows for b, e in entries.items() if b in came)
            _overwrite(self._met(self._spread(both, touched, held + n)), f"{self.root}/data/version={version}", "bucket")
            entries = entries | self._digest(entries, touched, version)
        self._commit(version, entries)
        return touched

    def _reduced(self, fresh: DataFrame) -> DataFrame:
        """The last row of each key, by an aggregate that combines on the map side."""
        last = F.max(F.struct(F.struct(*self.order).alias("rank"), self._row().alias("row"))).alias("_last")
        return fresh.groupBy("bucket", "leaf", *self.keys).agg(last).select("bucket", "leaf", "_last.row.*")

    def _spread(self, rows: DataFrame, touched: Sequence[int], n: int) -> DataFrame:
        """Rows brought to the tasks that write them: each touched bucket is cut into runs of leaves."""
        per = self.leaves // self.buckets
        parts = min(per, max(1, -(-n // (TASK_ROWS * len(touched)))))
        number = {b: i * parts for i, b in enumerate(touched)}
        first = F.get(F.array(*[F.lit(number.get(b, 0)) for b in range(self.buckets)]), F.col("bucket"))
        return rows.withColumn("_task", first + F.expr(f"CAST(leaf % {per} * {parts} div {per} AS INT)")).repartitionById(parts * len(touched), "_task")

    def _met(self, both: DataFrame) -> DataFrame:
        """The rows of a version from the stored ones (`_new` 0, one a key) and the changes (`_new` 1), in order of leaves."""
        place = ["bucket", "leaf", *self.keys, "_task"]
        same = Window.partitionBy(*place).orderBy("_new", *self.order, *self.schema.names)
        old = F.first(F.when(F.col("_new") == 0, self._row())).over(same.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        last = both.select("*", old.alias("_old"), F.lead("_new").over(same).alias("_next")).where("_next IS NULL").sortWithinPartitions(*place)  # as they lie
        rank = lambda within: F.struct(*[F.col(f"{within}{c}").alias(c) for c in self.order])
        met = last.withColumn("_stays", F.col("_old").isNotNull() & (rank("_old.") > rank("")))
        changed = (F.col("_new") == 1) & ~F.col("_stays") & ~F.col("_old").eqNullSafe(self._row())
        now = [F.when(F.col("_stays"), F.col(f"_old.{c}")).otherwise(F.col(c)).alias(c) for c in self.schema.names]
        return met.select("bucket", "leaf", *now, changed.alias("_changed"), F.when(changed, F.col("_old")).alias("_before"))

    def _log(self, entries: dict[int, Entry]) -> DataFrame:
        """kind, row, bucket and leaf of every change in the given buckets."""
        rows = self._files(entries).where("_changed").select("bucket", "leaf", self._row().alias("_now"), "_before")
        was = F.col("_before").isNotNull() & ~self.deleted("_before")
        remains = ~self.deleted("_now")
        entry = lambda kind, side: F.struct(F.lit(kind).alias("kind"), F.col(side).alias("row"))
        pair = (
            F.when(was & remains, F.array(entry(BEFORE, "_before"), entry(AFTER, "_now")))
            .when(was, F.array(entry(DELETE, "_before")))
            .when(remains, F.array(entry(INSERT, "_now")))
        )
        return rows.select("bucket", "leaf", F.inline(pair))

    def changes(self, version: int) -> DataFrame:
        """The changelog of a commit: kind and the row's columns; an update is a -U and a +U."""
        _, entries = self.manifest(version + 1)
        return self._log({b: e for b, e in entries.items() if e.version == version}).select("kind", "row.*")

    # -------------------------------------------------------------- digests

    def _digest(self, before: dict[int, Entry], touched: Sequence[int], version: int) -> dict[int, Entry]:
        moved = self._moved({b: Entry(version, 0, ()) for b in touched})
        held = self.leaf_digests(before, touched)
        sums = [F.sum("row_count").alias("row_count"), *[F.sum(d).cast(SUM).alias(d) for d in DIGEST]]
        leaves = held.unionByName(moved).groupBy("bucket", "leaf").agg(*sums)
        _overwrite(leaves.coalesce(1) if len(touched) == 1 else leaves, f"{self.root}/digest/version={version}")
        written = self.spark.read.schema(leaves.schema).parquet(f"{self.root}/digest/version={version}")
        per_bucket = written.groupBy("bucket").agg(*sums).collect()  # a row per touched bucket
        return {r.bucket: Entry(version, r.row_count, tuple(r[d] for d in DIGEST)) for r in per_bucket} | {
            b: Entry(version, 0, (Decimal(0),) * len(DIGEST)) for b in touched if b not in {r.bucket for r in per_bucket}
        }

    def _moved(self, entries: dict[int, Entry]) -> DataFrame:
        """(bucket, leaf, row_count, digest): what the changes in the given buckets add to their leaves."""

        def bound(there: Column, prefix: str) -> Column:
            row = hashing.canonical_hash([(F.col(f"{prefix}{c}"), "NULL") for c in self.digest_columns])
            return F.when(there, hashing.bound_digest(self._key_text(prefix), row))

        sides = ("_now", "_was")
        was = F.col("_before").isNotNull() & ~self.deleted("_before")
        hashed = self._files(entries).where("_changed").select("bucket", "leaf", bound(~self.deleted(), "").alias("_now"), bound(was, "_before.").alias("_was"))
        words = hashed.select("bucket", "leaf", *[w.alias(f"{s}{i}") for s in sides for i, w in enumerate(hashing.signed_words(F.col(s)))])
        # whole numbers are summed, not decimals: the halves of a word, of which 2^31 fit a sum
        change = lambda value: F.sum(F.coalesce(value("_now"), F.lit(0)) - F.coalesce(value("_was"), F.lit(0)))
        high = [change(lambda s: F.shiftrightunsigned(f"{s}{i}", 32)).alias(f"high{i}") for i in range(len(DIGEST))]
        low = [change(lambda s: F.col(f"{s}{i}").bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"low{i}") for i in range(len(DIGEST))]
        count = change(lambda s: F.when(F.col(f"{s}0").isNotNull(), F.lit(1).cast("bigint")))
        whole = [F.expr(f"CAST(CAST(high{i} AS DECIMAL(20,0)) * 4294967296BD + low{i} AS {SUM})").alias(d) for i, d in enumerate(DIGEST)]
        return words.groupBy("bucket", "leaf").agg(count.alias("row_count"), *high, *low).select("bucket", "leaf", "row_count", *whole)

    def leaf_digests(self, entries: dict[int, Entry], buckets: Sequence[int]) -> DataFrame:
        """(bucket, leaf, row_count, digest) of the given buckets, from the versions that hold them."""
        schema = f"bucket int, leaf bigint, row_count bigint, {', '.join(f'{d} {SUM}' for d in DIGEST)}"
        found = None
        for v in sorted({e.version for b, e in entries.items() if b in buckets}):
            own = [b for b, e in entries.items() if b in buckets and e.version == v]
            part = self.spark.read.schema(schema).parquet(f"{self.root}/digest/version={v}").where(F.col("bucket").isin(own))
            found = part if found is None else found.unionByName(part)
        return self.spark.createDataFrame([], schema) if found is None else found

    # -------------------------------------------------------------- upkeep

    def vacuum(self, keep: int = 2) -> None:
        """Remove commits but the last `keep`, and all files that none of those names."""
        commits = sorted(self._versions("manifest"))
        kept = commits[-keep:] if keep else []
        named = {(e.version, b) for v in kept for b, e in self.manifest(v + 1)[1].items()}
        for v in self._versions("data"):
            folder = f"{self.root}/data/version={v}"
            for b in [int(n.partition("=")[2]) for n in _names(self.spark, folder) if n.startswith("bucket=")]:
                if (v, b) not in named and v <= max(kept, default=v):
                    _delete(self.spark, f"{folder}/bucket={b}")
            if not any(n.startswith("bucket=") for n in _names(self.spark, folder)):
                _delete(self.spark, folder)
        for v in self._versions("digest"):
            if v <= max(kept, default=v) and v not in {x for x, _ in named}:
                _delete(self.spark, f"{self.root}/digest/version={v}")
        for v in commits[: len(commits) - len(kept)]:
            _delete(self.spark, f"{self.root}/manifest/version={v}")

    def _versions(self, part: str) -> list[int]:
        return sorted(int(n.partition("=")[2]) for n in _names(self.spark, f"{self.root}/{part}") if n.startswith("version="))


def _overwrite(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(by) if by else writer).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    where, files = _hadoop(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []


def _delete(spark: SparkSession, path: str) -> None:
    where, files = _hadoop(spark, path)
    files.delete(where, True)

"""A stored table with unique keys: files in key buckets, published by a manifest.

Rows lie in folders by generation and bucket, a bucket being a hash slice of the key. A manifest, one small file for each state, names the folder of
every bucket that has rows. An upsert reads and rewrites the touched buckets only, under a new generation, and then writes the next manifest: the
rename of that one file publishes it. Stored and incoming rows meet in one shuffle, by ranges of bucket and hash slice of the key; keys are judged and
rows replaced where they meet. A writer that fails before leaves the old state; what it wrote is unnamed and goes with ``vacuum``. Readers pin
the manifest they start from. One writer at a time: the state a change started from is checked again before it is published.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from riskmart.sources.tables import delete_folder, read_or_empty

#: Hash slices of a bucket, so that ranges of buckets and slices can be cut to even size.
SLICES = 1024
MANIFEST = "state bigint, bucket int, generation string, rows bigint"


class DuplicateKeyError(ValueError):
    """A key is null, or occurs more than once among the rows of one change."""


class StateChangedError(RuntimeError):
    """Another writer has published since this change was prepared."""


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, key: Sequence[str], schema: str, buckets: int = 64, hex_columns: Sequence[str] = ()):
        """``hex_columns`` (beside the key; mostly upper-case hex) travel as bytes; a value that is no such text travels and is stored as it is."""
        self.spark, self.root, self.key, self.schema, self.buckets, self.hex_columns = spark, root, tuple(key), schema, buckets, tuple(hex_columns)

    # -- states ---------------------------------------------------------------------------

    def manifest(self, state: int | None = None) -> list:
        """Buckets of a state (the last one by default): at most one row a bucket."""
        every = read_or_empty(self.spark, f"{self.root}/manifest", MANIFEST)
        if state is None:
            state = every.agg(F.max("state")).first()[0]
        return every.where(F.col("state") == state).orderBy("bucket").collect() if state is not None else []

    def state(self) -> int:
        """Number of the last published state; 0 before the first."""
        return read_or_empty(self.spark, f"{self.root}/manifest", MANIFEST).agg(F.coalesce(F.max("state"), F.lit(0))).first()[0]

    def _folders(self, entries: Sequence) -> DataFrame:
        paths = [f"{self.root}/data/{e.generation}/bucket={e.bucket}" for e in entries if e.rows]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, state: int | None = None) -> DataFrame:
        return self._folders(self.manifest(state))

    # -- changes --------------------------------------------------------------------------

    def _hash(self) -> Column:
        return F.xxhash64(*self.key)

    def _bucket(self) -> Column:
        return F.pmod(self._hash(), F.lit(self.buckets)).cast("int")

    def _packed(self, rows: DataFrame) -> DataFrame:
        for c in self.hex_columns:
            raw = F.unhex(c)
            rows = rows.withColumn(f"_bytes_{c}", F.when(F.hex(raw) == F.col(c), raw))
            rows = rows.withColumn(c, F.when(F.col(f"_bytes_{c}").isNull(), F.col(c)))
        return rows

    def _unpacked(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({c: F.coalesce(F.hex(f"_bytes_{c}"), F.col(c)) for c in self.hex_columns})

    def _merged(self, stored: DataFrame, incoming: DataFrame, bad: Observation) -> DataFrame:
        """Incoming rows, and stored rows whose key none of them has. ``bad`` gets an incoming key that is null or there twice, in the same pass."""
        columns = stored.columns
        both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
        placed = self._packed(both).withColumns({"bucket": self._bucket(), "_slice": F.pmod(F.shiftright(self._hash(), 40), F.lit(SLICES)).cast("int")})
        same = Window.partitionBy("bucket", "_slice", *self.key)
        met = placed.repartitionByRange("bucket", "_slice").withColumn("_incoming", F.sum("_new").over(same))
        null = F.lit(False)
        for c in self.key:
            null = null | F.col(c).isNull()
        wrong = (F.col("_new") == 1) & (null | (F.col("_incoming") > 1))
        told = F.concat(F.col("_incoming").cast("string"), F.lit(" rows with key "), F.to_json(F.struct(*self.key)))
        met = met.observe(bad, F.min(F.when(wrong, told)).alias("key"))
        return self._unpacked(met.where((F.col("_new") == 1) | (F.col("_incoming") == 0))).select(*columns, "bucket")

    def upsert(self, incoming: DataFrame) -> int:
        """Incoming rows replace stored ones of the same key, others stay; returns the new state.

        Raises DuplicateKeyError before anything is published if the incoming keys are not unique; what was written by then is deleted.
        ``incoming`` is read three times: for its buckets, for a sample of them, and as a whole.
        """
        columns = self.spark.createDataFrame([], self.schema).columns
        before = self.state()
        old = {e.bucket: e for e in self.manifest(before)} if before else {}
        rows, generation = incoming.select(*columns), uuid.uuid4().hex
        touched = [r.bucket for r in rows.select(self._bucket().alias("bucket")).distinct().collect()]  # no more than there are buckets
        if touched:
            path, bad = f"{self.root}/data/{generation}", Observation()
            stored = self._folders([old[b] for b in touched if b in old])
            self._merged(stored, rows, bad).write.option("compression", "zstd").partitionBy("bucket").parquet(path)
            if bad.get["key"] is not None:
                delete_folder(self.spark, path)
                raise DuplicateKeyError(bad.get["key"])
        return self._publish(before, old, touched, generation)

    def _publish(self, before: int, old: dict, touched: Sequence[int], generation: str) -> int:
        counts = {}
        if touched:
            new = self.spark.read.parquet(f"{self.root}/data/{generation}")
            counts = {r.bucket: r.n for r in new.groupBy("bucket").agg(F.count("*").alias("n")).collect()}
        if not set(counts) <= set(touched):  # their stored rows have not been read
            raise StateChangedError(f"incoming rows were not the same when read again: buckets {sorted(set(counts) - set(touched))}")
        state = before + 1
        kept = [(state, e.bucket, e.generation, e.rows) for e in old.values() if e.bucket not in counts]
        entries = kept + [(state, b, generation, n) for b, n in counts.items()]
        if self.state() != before:
            raise StateChangedError(f"state {before} is no longer the last one")
        self.spark.createDataFrame(entries or [(state, 0, generation, 0)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")
        return state

    def vacuum(self, keep: int = 2) -> int:
        """Deletes generations that none of the last ``keep`` states names; returns how many."""
        every = read_or_empty(self.spark, f"{self.root}/manifest", MANIFEST)
        last = self.state()
        named = {r.generation for r in every.where(F.col("state") > last - keep).select("generation").distinct().collect()}
        jvm = self.spark.sparkContext._jvm
        data = jvm.org.apache.hadoop.fs.Path(f"{self.root}/data")
        files = data.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(data):
            return 0
        old = [s.getPath().getName() for s in files.listStatus(data) if s.getPath().getName() not in named]
        for generation in old:
            delete_folder(self.spark, f"{self.root}/data/{generation}")
        return len(old)

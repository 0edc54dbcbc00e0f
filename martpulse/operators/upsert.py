"""KEYED-UPSERT: keyed tables kept as append-only micro-batch folders plus a latest-per-key view.

Layout::

    <path>/batch_id=<n>/...         one folder per micro-batch (overwrite mode: a retry replaces it)
    <path>/_base/upto=<n>/...       compacted snapshot: the latest row per key over batches <= n

Readers take the newest complete snapshot plus the complete batches after it (complete: its ``_SUCCESS``
marker is there) and keep the latest row per key (version, then batch id). Only those folders are listed
and read, so a read follows the snapshot and the recent batches, not the table's history. ``compact``
writes a snapshot (idempotent for a given ``n``) and deletes what the snapshot before it already covered:
readers of that one still find their folders. Folders starting with ``_`` are invisible to reads of
``<path>``. No transactional format is needed. A batch as large as a table goes through ``<path>/_large`` (``passes``).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from martpulse.operators.dedup import latest_per_key
from martpulse.sources.paths import delete, matching, size

BATCH_COL = "batch_id"
BASE_DIR, UPTO_COL = "_base", "upto"
LARGE_DIR = "_large"
PASSES = 4   # of a batch as large as a table
ONE_PASS_BYTES = 32 * 1024 * 1024   # staged: up to here passes save no disk worth their time
# An execution's shuffle files go with it; a join whose one side has small partitions, as measured, sorts neither side.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
SHORT_JOINS = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m"}
CONCURRENT_FILES = "spark.sql.maxConcurrentOutputFileWriters"   # so many open files a task instead of a sort by folder


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x or [])


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the time of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _with_ids(df: DataFrame, keys: list[str], null_key_id: bool) -> DataFrame:
    """The rows with a hash of each as ``__tie``, which also is the id of a null key."""
    out = df.withColumn("__tie", F.xxhash64(F.to_json(F.struct(*df.columns))))
    if null_key_id and len(keys) == 1:
        out = out.withColumn(keys[0], F.coalesce(F.col(keys[0]).cast("string"), F.concat(F.lit("row-"), F.hex("__tie"))))
    return out


def _write(df: DataFrame, mode: str, path: str, parts: list[str], complete: bool = True) -> None:
    writer = df.write.mode(mode).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(complete).lower())
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)


def kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read from there."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_per_key(rows: DataFrame, keys: list[str], scratch: str, reduce, single=lambda rows: rows) -> DataFrame:
    """One row per key of rows that are cheap to read twice (files).

    A count of the keys' hashes, kept in ``scratch``, tells which rows can share a key: only these are shuffled and given to
    ``reduce``, the others to ``single``, where they are.
    """
    counted = rows.select(F.xxhash64(*keys).alias("__key")).groupBy("__key").agg(F.count(F.lit(1)).alias("n"))
    return reduce_some(rows, keys, kept(counted.where("n > 1").select("__key"), scratch), reduce, single)


def reduce_some(rows: DataFrame, keys: list[str], repeated: DataFrame, reduce, single=lambda rows: rows) -> DataFrame:
    """``reduce`` of the rows whose key's hash is ``repeated`` (a stored ``__key``), ``single`` of the others."""
    if repeated.isEmpty():
        return single(rows)
    marked = rows.withColumn("__key", F.xxhash64(*keys))
    return (single(marked.join(repeated, "__key", "left_anti").select(*rows.columns))
            .unionByName(reduce(marked.join(repeated, "__key", "left_semi").select(*rows.columns))))


def upsert_batch(df: DataFrame, batch_id: int, path: str, key, version: str | None = None, partition_by=None,
                 null_key_id: bool = True, passes: int | None = None, reread: bool = False) -> None:
    """Write one micro-batch of keyed rows (idempotent per ``batch_id``): one row per key.

    Of rows with one key the latest version stays; equal versions are settled by a hash of the row, so a
    replay writes the same. A null key gets a hash of the row as its id (a document without id): it is
    merged with equal rows only. ``passes``: the same for a batch as large as a table, with less on disk (``_upsert_large``).
    ``reread``: the same for rows from files, which are read twice but not shuffled where no key repeats (``one_per_key``).
    """
    keys, parts, root = _list(key), _list(partition_by), path.rstrip("/")
    order, to = ([version] if version else []) + ["__tie"], f"{root}/{BATCH_COL}={int(batch_id)}"
    stage = f"{root}/{LARGE_DIR}/{BATCH_COL}={int(batch_id)}"
    if passes:
        _upsert_large(df, keys, order, parts, null_key_id, passes, to, stage)
        return

    def reduce(rows: DataFrame) -> DataFrame:
        return latest_per_key(_with_ids(rows, keys, null_key_id), keys, order).select(*df.columns)

    def single(rows: DataFrame) -> DataFrame:
        return _with_ids(rows, keys, null_key_id).select(*df.columns)

    out = one_per_key(df, keys, stage, reduce, single) if reread else reduce(df)
    if parts:
        # one writer per partition value instead of one per (task, value); AQE splits a hot value
        # across tasks and merges small ones (rebalance), so no task gets a third of the batch
        out = out.hint("rebalance", *parts)
    _write(out, "overwrite", to, parts)
    if reread:
        delete(df.sparkSession, stage)


def _upsert_large(df: DataFrame, keys: list[str], order: list[str], parts: list[str], null_key_id: bool, passes: int, to: str, stage: str) -> None:
    """One row per key, with whole rows shuffled once, by partition value, and only the rows of one pass at a time.

    The rows are staged as they come, in as many folders as passes (by partition value). A count of the keys' hashes tells which
    rows can share a key: only these are reduced to one per key, the others are written as they are. Each step gives
    the shuffle files of the step before back, and a pass its folder. The batch is complete after the last pass.
    """
    spark, hashed = df.sparkSession, F.xxhash64(*keys)
    share = F.pmod(F.xxhash64(*(parts or keys)), F.lit(passes))

    def put(rows: DataFrame, name: str) -> None:
        with settings(spark, {CONCURRENT_FILES: str(passes)}):
            rows.withColumn("__pass", share).write.mode("overwrite").option("compression", "zstd").partitionBy("__pass").parquet(f"{stage}/{name}")

    def got(name: str, schema: T.StructType, n: int | str = "*") -> DataFrame:
        folders = matching(spark, f"{stage}/{name}/__pass={n}")
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def by_id(rows: DataFrame) -> DataFrame:
        return _with_ids(rows, keys, null_key_id)

    with settings(spark, DROP_SHUFFLES):
        put(df, "rows")
        repeated = got("rows", df.schema).groupBy(hashed.alias("__key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__key")
        repeated = kept(repeated, f"{stage}/repeated")
        any_repeated = not repeated.isEmpty()
        if any_repeated:
            some = got("rows", df.schema).withColumn("__key", hashed).join(repeated, "__key", "left_semi").drop("__key")
            put(latest_per_key(by_id(some), keys, order).select(*df.columns), "reduced")
        delete(spark, to)
        rounds = list(range(passes)) if size(spark, f"{stage}/rows") > ONE_PASS_BYTES else ["*"]
        for n in rounds:
            out = got("rows", df.schema, n)
            if any_repeated:
                out = out.withColumn("__key", hashed).join(repeated, "__key", "left_anti").select(*df.columns)
            out = by_id(out).select(*df.columns)
            if any_repeated:
                out = out.unionByName(got("reduced", out.schema, n))
            _write(out.hint("rebalance", *parts) if parts else out, "append", to, parts, complete=n == rounds[-1])
            for folder in matching(spark, f"{stage}/*/__pass={n}"):
                delete(spark, folder)
    delete(spark, stage)


def _numbers(paths: list[str]) -> set[int]:
    return {int(p.rsplit("/", 2)[-2].split("=")[1]) for p in paths}


def _complete(spark: SparkSession, root: str, column: str) -> list[int]:
    """Numbers of the complete ``<root>/<column>=<n>`` folders that hold data, ascending."""
    folder = f"{root}/{column}=*"
    return sorted(_numbers(matching(spark, f"{folder}/_SUCCESS")) & _numbers(matching(spark, f"{folder}/[!_.]*")))


def _read(spark: SparkSession, root: str, column: str, numbers: list[int], partition_by) -> DataFrame:
    """The given folders; partition columns come back as the strings written.

    (Partition discovery would otherwise turn '2024-01-05' into a DATE and '07' into 7.)
    """
    paths = [f"{root}/{column}={n}" for n in numbers]
    parts = set(_list(partition_by))
    df = spark.read.option("basePath", root).parquet(*paths)
    if not parts:
        return df
    fields = [T.StructField(f.name, T.StringType(), True) if f.name in parts else f for f in df.schema.fields]
    return spark.read.schema(T.StructType(fields)).option("basePath", root).parquet(*paths)


def _base_root(path: str) -> str:
    return f"{path.rstrip('/')}/{BASE_DIR}"


def latest_snapshot(spark: SparkSession, path: str) -> int | None:
    """Batch id covered by the newest complete snapshot, or None."""
    return max(_complete(spark, _base_root(path), UPTO_COL), default=None)


def newest_batch(spark: SparkSession, path: str) -> int | None:
    """Highest batch id that the table holds, in a folder of its own or in a snapshot."""
    root = path.rstrip("/")
    return max(_complete(spark, root, BATCH_COL) + _complete(spark, _base_root(path), UPTO_COL), default=None)


def rows_since_snapshot(spark: SparkSession, path: str, partition_by=(), upto: int | None = None) -> DataFrame:
    """Snapshot and later batches, with the batch id as a BIGINT column.

    ``upto``: as it was after that batch, from the newest snapshot not beyond it. A state older than the
    snapshot before the newest one is gone: ``FileNotFoundError``.
    """
    root = path.rstrip("/")
    snapshots = _complete(spark, _base_root(path), UPTO_COL)
    base = max((n for n in snapshots if upto is None or n <= upto), default=None)
    if base is None and len(snapshots) > 1:
        raise FileNotFoundError(f"{path} no longer holds its state after batch {upto}")
    batches = [n for n in _complete(spark, root, BATCH_COL)
               if (base is None or n > base) and (upto is None or n <= upto)]
    frames = []
    if base is not None:
        frames.append(_read(spark, _base_root(path), UPTO_COL, [base], partition_by).withColumnRenamed(UPTO_COL, BATCH_COL))
    if batches:
        frames.append(_read(spark, root, BATCH_COL, batches, partition_by))
    if not frames:
        raise FileNotFoundError(f"no complete batch in {path}")
    frames = [f.withColumn(BATCH_COL, F.col(BATCH_COL).cast("long")) for f in frames]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def current(spark: SparkSession, path: str, key, version: str | None = None, partition_by=(),
            only_keys: DataFrame | None = None, where: Column | None = None, upto: int | None = None, columns=None) -> DataFrame:
    """Latest row per key: newest snapshot + later batches (version first, later batch wins ties).

    ``only_keys``: restrict to these keys first (a semi-join before the aggregate). ``where``: a predicate
    on columns that never change for a key (a creation date); it is applied to the scan, below the
    aggregate, so on a partition column it prunes folders. ``upto``: the table as it was after that batch.
    ``columns``: only these beside the key; the others are not read.
    """
    df, keys = rows_since_snapshot(spark, path, partition_by, upto), _list(key)
    if where is not None:
        df = df.where(where)
    if only_keys is not None:
        df = df.join(only_keys.select(*keys).distinct(), on=keys, how="left_semi")
    order = ([version] if version else []) + [BATCH_COL]
    if columns is not None:
        df = df.select(*dict.fromkeys([*keys, *_list(columns), *order]))
    found = latest_per_key(df, keys, order).drop(BATCH_COL)
    return found if columns is None else found.select(*dict.fromkeys([*keys, *_list(columns)]))


def compact(spark: SparkSession, path: str, key, version: str | None = None, partition_by=None,
            upto: int | None = None, fold=None) -> int | None:
    """Write a snapshot of the latest row per key over the batches up to ``upto`` (default: all present).

    ``fold``: what makes the snapshot's rows instead (a table of sums adds them up).

    Rows keep their version, so later batches still override the snapshot correctly. Re-running for
    the same batch id overwrites the same snapshot folder. Returns the batch id covered.
    """
    root = path.rstrip("/")
    before = latest_snapshot(spark, path)
    if upto is None:
        upto = max(_complete(spark, root, BATCH_COL), default=None)
    if upto is None or (before is not None and upto <= before):
        return before
    rows, parts = rows_since_snapshot(spark, path, partition_by, upto), _list(partition_by)
    if fold is None:
        snap = latest_per_key(rows, _list(key), ([version] if version else []) + [BATCH_COL]).drop(BATCH_COL)
    else:
        snap = fold(rows.drop(BATCH_COL))
    if parts:
        snap = snap.hint("rebalance", *parts)
    writer = snap.write.mode("overwrite")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(f"{_base_root(path)}/{UPTO_COL}={int(upto)}")
    if before is not None:
        for n in _complete(spark, root, BATCH_COL):
            if n <= before:
                delete(spark, f"{root}/{BATCH_COL}={n}")
        for n in _complete(spark, _base_root(path), UPTO_COL):
            if n < before:
                delete(spark, f"{_base_root(path)}/{UPTO_COL}={n}")
    return int(upto)


def foreach_batch_upsert(path: str, key, version: str | None = None, partition_by=None,
                         compact_every: int | None = None):
    """A ``foreachBatch`` function writing each micro-batch with ``upsert_batch``.

    ``compact_every``: after every n-th batch, write a snapshot (``compact``) so readers aggregate the
    snapshot plus fewer than n recent batches.
    """
    def _write(batch_df: DataFrame, batch_id: int) -> None:
        upsert_batch(batch_df, batch_id, path, key, version, partition_by)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch_df.sparkSession, path, key, version, partition_by, upto=batch_id)
    return _write

"""Helpers shared by the corpus operators: table reads, shared-folder tables, byte-level word
hashing in numpy, and connected components as a Spark job."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from martpulse.session import checkpoint_root
from martpulse.sources.tables import read_table

#: Bytes of text that one numpy block holds (a longer single text is a block of its own).
BLOCK_BYTES = 1 << 19


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, name, columns or None)


_SHIPPED: set[str] = set()
#: Most bytes in an Arrow batch between the JVM and Python; the session's own setting holds if it is lower.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application (as ``--py-files`` would), and bound Arrow batches."""
    # long texts: an Arrow batch is cut by its bytes, not only by its rows
    if int(spark.conf.get(BATCH_SETTING).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(package):  # else it came from such an archive itself
        to = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{os.path.basename(package)}.zip")
        with zipfile.ZipFile(to, "w") as z:
            for folder, _, names in os.walk(package):
                for name in sorted(n for n in names if n.endswith(".py")):
                    at = os.path.join(folder, name)
                    z.write(at, os.path.relpath(at, os.path.dirname(package)))
        context.addPyFile(to)
    _SHIPPED.add(context.applicationId)


class Scratch:
    """Tables written to the shared checkpoint folder, to cut lineage between stages of one operator.

    A lost executor re-reads them from the shared folder. ``put`` writes and re-reads; ``drop``
    deletes what no later stage reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship(spark)
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
        self.n = 0

    def put(self, df: DataFrame) -> tuple[DataFrame, str]:
        path = f"{self.root}/{self.n}"
        self.n += 1
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, *paths: str) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for p in paths:
            at = jvm.org.apache.hadoop.fs.Path(p)
            at.getFileSystem(conf).delete(at, True)


_BUILT: dict[str, object] = {}


class PerWorker:
    """A small broadcast value from which each Python worker builds its model once (``build(value)``)."""

    def __init__(self, spark: SparkSession, value, build: Callable):
        ship(spark)
        self.key = uuid.uuid4().hex
        self.value = spark.sparkContext.broadcast(value)
        self.build = build

    def get(self):
        if self.key not in _BUILT:
            _BUILT.clear()
            _BUILT[self.key] = self.build(self.value.value)
        return _BUILT[self.key]

    def drop(self) -> None:
        """Take the value from driver and executors; call it when no plan that reads it runs again."""
        self.value.destroy()


def add_columns(df: DataFrame, column: str, fn: Callable[[pa.Array], list[pa.Array]], ddl: str) -> DataFrame:
    """``df`` plus the columns ``ddl`` that ``fn`` computes from ``column``, one Arrow slice at a time.

    ``fn`` gets one array of the column's values and returns one array per new column. A new column
    replaces an old one of its name. Slices are cut by text size, so a task's memory follows the
    longest text, not the batch.
    """
    ship(df.sparkSession)
    new = StructType.fromDDL(ddl)
    old = [c for c in df.columns if c not in new.names]
    schema = StructType([df.schema[c] for c in old] + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(column)
            if not batch.num_rows:
                continue
            for i, j in slices(values):
                cols = [batch.column(c).slice(i, j - i) for c in old] + fn(values.slice(i, j - i))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return df.select(*old, *([column] if column not in old else [])).mapInArrow(run, schema)


def slices(values: pa.Array, limit: int = 4 * BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """(first, last) of runs of rows with about ``limit`` bytes of text (or ids) together."""
    n, per_row = len(values), max(1, values.nbytes // max(1, len(values)))
    if pa.types.is_large_string(values.type):
        off = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + n + 1]
    elif pa.types.is_string(values.type):
        off = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + n + 1].astype(np.int64)
    else:
        off = np.arange(n + 1, dtype=np.int64) * per_row
    i = 0
    while i < n:
        j = min(max(int(np.searchsorted(off, off[i] + limit, side="right")) - 1, i + 1), n)
        yield i, j
        i = j


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until they are no columns of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def draw(df: DataFrame, size: int, *by: str) -> DataFrame:
    """At most ``size`` rows in the order of a hash of the columns ``by``: the same ones on every run.

    The count of ``df`` first narrows it to about twice as many, so what tasks send doesn't grow with the input.
    """
    total = df.count()
    if total > 2 * size:
        df = df.where(F.pmod(F.xxhash64(F.lit("draw"), *by), F.lit(total)) < 2 * size)
    return df.orderBy(F.xxhash64(F.lit("draw"), *by), *by).limit(size)


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: null)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(folds)


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of runs of rows holding about ``limit`` bytes; null counts as empty."""
    arr = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    arr = arr.fill_null("") if arr.null_count else arr
    n = len(arr)
    if n == 0:
        return
    off = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + n + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


_M = np.uint64(0x9E3779B97F4A7C15)
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer spans are hashed in pieces of so many bytes, then the pieces' hashes in turn.
SPAN_BYTES = 512


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit numbers (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
#: Space and \t..\r part words.
SPACE_SEP = np.zeros(256, bool)
SPACE_SEP[[32, 9, 10, 11, 12, 13]] = True
#: Every ASCII byte that is no letter or digit parts words.
PUNCT_SEP = np.ones(256, bool)
PUNCT_SEP[48:58] = PUNCT_SEP[65:91] = PUNCT_SEP[97:123] = PUNCT_SEP[128:] = False


#: Space parts words, and a change between letters or digits (2) and signs (1) begins a new one.
SHAPES = np.full(256, 1, np.uint8)
SHAPES[~PUNCT_SEP] = 2
SHAPES[SPACE_SEP] = 0


def words(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray, lower: bool = True
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of each word, its 64-bit hash, words per row) of a block, in text order.

    A word is a maximal run of bytes outside ``sep`` within one row. With ``lower``, A-Z hash as a-z.
    """
    rows = len(offsets) - 1
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(rows, np.int64)
    starts, ends = word_bounds(data, offsets, sep)
    h = span_hash(data, starts, ends, lower)
    row = np.searchsorted(offsets, starts, side="right") - 1
    return row, h, np.bincount(row, minlength=rows)


def word_bounds(data: np.ndarray, offsets: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words. ``sep``: a table of separators, or of byte classes (0: separator)."""
    n = len(data)
    kind = sep[data] if sep.dtype == np.uint8 else (~sep[data]).view(np.uint8)
    edge = np.zeros(n + 1, bool)  # a row begins here: no word crosses it
    edge[offsets[offsets <= n]] = True
    change = (kind[1:] != kind[:-1]) | edge[1:n]
    inside = kind > 0
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= change
    end[:-1] &= change
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each byte span: eight bytes at a time, mixed after each, all spans at once."""
    data = ASCII_LOWER[data] if lower else np.asarray(data)
    starts, left = np.array(starts, np.int64), np.array(ends, np.int64) - starts
    padded = np.r_[data, np.zeros(8, np.uint8)]
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the bytes from each place on
    long = np.flatnonzero(left > SPAN_BYTES)
    with np.errstate(over="ignore"):
        h = mix(left.astype(np.uint64) * _M)
        todo = np.flatnonzero(left <= SPAN_BYTES)
        todo = todo[left[todo] > 0]
        while len(todo):
            part = eight[starts[todo]] & _FIRST_BYTES[np.minimum(left[todo], 8)]
            h[todo] = mix(h[todo] * _M + mix(part ^ _M))
            starts[todo] += 8
            left[todo] -= 8
            todo = todo[left[todo] > 0]
        for i in long.tolist():
            cuts = np.arange(starts[i], starts[i] + left[i], SPAN_BYTES)
            pieces = span_hash(data, cuts, np.r_[cuts[1:], starts[i] + left[i]], lower=False)
            whole = span_hash(pieces.view(np.uint8), np.array([0]), np.array([8 * len(pieces)]), lower=False)
            h[i] = mix(h[i:i + 1] * _M + whole)[0]
    return h


#: A round of ``stars`` writes a file for so many edges, but one a core at least: few edges don't take many small tasks.
FILE_EDGES = 250_000


def components(edges: DataFrame, a: str, b: str, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges``: (node, root), root the smallest node reachable.

    Nodes without edges don't appear; see ``stars``.
    """
    e = stars(edges, a, b, scratch, max_rounds)
    return e.unionByName(e.select(F.col("root").alias("node"), "root")).distinct()


def stars(edges: DataFrame, a: str, b: str, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, root) of each node of the undirected ``edges`` that reaches a smaller one; root: the smallest.

    Alternating large-star and small-star rounds over the edge table until it is one of stars. Each
    round is two grouped minima and joins (split by AQE when one node is hot) and is written to the
    shared folder. Null ends and self links are ignored; repeated edges count once; an empty table gives
    an empty result.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, path = scratch.put(e)
    for _ in range(max_rounds):
        # stars: each upper end has one edge and is no lower end
        ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("up")), F.struct(F.col("v").alias("x"), F.lit(0).alias("up")))).alias("end"))
        ends = ends.groupBy("end.x").agg(F.sum("end.up").alias("ups"), F.min("end.up").alias("least"))
        unsettled, rows = ends.agg(F.count_if(F.expr("ups > 1 or ups > 0 and least = 0")), F.sum("ups")).first()
        if not unsettled:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        # large star: every neighbour above u moves to the least of u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # small star: a node's lower neighbours (and itself) move to the least of them
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small_low, "u").select("m", F.explode(F.array("u", "v")).alias("u"))
        e = moved.select("u", F.col("m").alias("v")).where("u <> v").distinct()
        e, nxt_path = scratch.put(e.coalesce(max(scratch.spark.sparkContext.defaultParallelism, rows // FILE_EDGES)))
        scratch.drop(path)
        path = nxt_path
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")

"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What counts as white space between words, in bytes and in patterns.
SPACES = r"\x20\x09-\x0D"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``, else a folder inside the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    return folder.rstrip("/")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# On a local file system Hadoop starts a process per file it creates, as it does for the file of checksums it puts beside
# it, each from an executor at its full size. Parquet has checksums of its own.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts the lineage, survives lost executors.

    The shuffles of the write go with its end instead of some time after; nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**PLAIN_FILES).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the files of a staged frame that nothing reads any more."""
    spark = df.sparkSession
    root = shared_folder(spark)
    for name in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if root.split(":", 1)[-1].lstrip("/") in name:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_PER_BATCH = 1000


def small_batches(spark: SparkSession) -> None:
    """Pass whole texts to Python in smaller batches than Spark's default, unless the session has its own number."""
    if spark.conf.get(BATCH) == "10000":
        spark.conf.set(BATCH, TEXTS_PER_BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_text(text: str = "text") -> Column:
    """The text, an empty one for NULL."""
    return F.coalesce(F.col(text), F.lit(""))


def held_out(doc_id: str, folds: int, fold: int = 2) -> Column:
    """True where crc32 of the id as text leaves ``fold`` modulo ``folds``; a NULL id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def words(text: str) -> list[bytes]:
    """Words of a text as UTF-8, A-Z lower-cased; bytes split at just the six ASCII spaces and lower ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def components(edges: DataFrame, label: str = "components", rounds: int = 100) -> DataFrame:
    """Connected components of undirected ``edges (src, dst)``: one row ``(node, component)``, its smallest node.

    Alternates two steps: each node's larger neighbours are hung under its smallest one, then each node points at the
    smallest node its pointer points at. Only minima are grouped, so a hub is summed up before the shuffle, and rows
    of a hub meet its one minimum in a join that adaptive execution can split. NULL ends are dropped; loops count
    as nodes. Raises if it has not settled after ``rounds``.
    """
    edges = edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL")
    pairs = stage(
        edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), label
    )
    kept = pairs
    seen = None
    for _ in range(rounds):
        # Both directions; every node also sees itself, so the minimum may be the node.
        both = pairs.select(F.col("u").alias("a"), F.col("v").alias("b")).union(pairs.select("v", "u"))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hung = both.where("b >= a").join(lowest, "a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        hung = hung.union(lowest.select("a", "m")).where("u > v").distinct()
        # Star of the smaller side: all parents of u go under the smallest of them.
        parent = hung.groupBy("u").agg(F.min("v").alias("p"))
        small = hung.join(parent, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("p").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("p").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u > v").distinct()
        new = stage(small, label)
        state = new.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if pairs is not kept:
            unstage(pairs)
        pairs = new
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = kept.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return nodes.join(pairs.select(F.col("u").alias("node"), F.col("v").alias("r")), "node", "left").select(
        "node", F.coalesce("r", "node").alias("component")
    )


def chunks(rows: Iterable, size: int) -> Iterable[list]:
    """``rows`` in lists of ``size``."""
    part: list = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield part
            part = []
    if part:
        yield part


class Bloom:
    """A Bloom filter of fixed size over 64-bit hashes: sifts rows before a shuffle, an exact join follows.

    ``bits`` bounds what is sent to the driver and broadcast, however many values there are; a filter that is too small
    for its values lets more rows through and loses none.
    """

    BITS = 1 << 24
    PROBES = 3

    def __init__(self, hashes: DataFrame, bits: int = BITS) -> None:
        """``hashes`` has one column of type long; NULLs are left out."""
        assert bits >= 64 and bits & (bits - 1) == 0
        self.bits = bits
        value = F.col(hashes.columns[0])
        at = F.explode(F.array(*[self._at(value, k) for k in range(self.PROBES)])).alias("at")
        filled = (
            hashes.where(value.isNotNull()).select(at)
            .groupBy(F.shiftright("at", 6).alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))).alias("set"))
        )
        self.words = np.zeros(bits >> 6, dtype=np.uint64)
        found = filled.toArrow()  # bits / 64 rows at most
        self.words[found["word"].to_numpy()] = found["set"].to_numpy().view(np.uint64)
        self.shared = hashes.sparkSession.sparkContext.broadcast(self.words)

    def close(self) -> None:
        """Free the executors' copies; what still asks for one gets it anew."""
        self.shared.unpersist()

    def _at(self, value: Column, probe: int) -> Column:
        return F.shiftright(value, 13 * probe).bitwiseAND(F.lit(self.bits - 1).cast("long"))

    def __call__(self, value: Column) -> Column:
        """True for every value that was put in, and for some others; False for NULL."""
        shared, mask, probes = self.shared, self.bits - 1, self.PROBES

        @F.pandas_udf("boolean")
        def holds(values: pd.Series) -> pd.Series:
            return pd.Series(bloom_test(shared.value, values.fillna(0).to_numpy().astype(np.int64), mask, probes)) & (
                values.notna().reset_index(drop=True))

        return holds(value)


def bloom_test(filled: np.ndarray, values: np.ndarray, mask: int, probes: int = Bloom.PROBES) -> np.ndarray:
    out = np.ones(len(values), dtype=bool)
    for k in range(probes):
        at = (values >> np.int64(13 * k)) & np.int64(mask)
        out &= (filled[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out


RUN = 1 << 18  # characters of text that are looked at together


def runs(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The frame in parts of some ``RUN`` characters of text, or one text."""
    number = frame.text.str.len().cumsum().to_numpy() // RUN
    edges = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1], [True]])) if len(frame) else []
    return (frame.iloc[a:b] for a, b in zip(edges, edges[1:]))


PAIRS = 1 << 18  # pairs that a task sums up together
Pairs = Iterator[tuple[np.ndarray, np.ndarray]]


def cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of ``buckets`` equal ranges of 64-bit numbers starts in the sorted ``keys``, and their end."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], dtype=np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def packed(parts: list[tuple[np.ndarray, np.ndarray]], buckets: int) -> pd.DataFrame:
    """(bucket, keys, owners, several): the different keys of (keys, owners) by range, with the smallest owner of each."""
    keys, owner = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    keys, owner = keys[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    keys = keys[first]
    least = np.minimum.reduceat(owner, first) if len(first) else owner
    several = least != (np.maximum.reduceat(owner, first) if len(first) else owner)
    cut = cuts(keys, buckets)
    return pd.DataFrame([
        (b, keys[i:j].tobytes(), least[i:j].tobytes(), several[i:j].tobytes())
        for b, (i, j) in enumerate(zip(cut, cut[1:])) if i < j
    ], columns=["bucket", "keys", "owners", "several"])


def several_owners(rows: DataFrame, pairs: Callable[[Iterator[pd.DataFrame]], Pairs], buckets: int) -> DataFrame:
    """(value, least): the values that different owners have, and the smallest of these.

    ``pairs`` makes values (uint64, spread over all their range) and owners (int64) of ``rows``. They are summed up in
    their task and shuffled packed, by ranges of values: rows of their own would cost a multiple.
    """

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, size = [], 0
        for part in pairs(frames):
            parts.append(part)
            size += len(part[0])
            if size >= PAIRS:
                yield packed(parts, buckets)
                parts, size = [], 0
        if parts:
            yield packed(parts, buckets)

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k in frame["keys"]])
        owner = np.concatenate([np.frombuffer(o, np.int64) for o in frame.owners])
        several = np.concatenate([np.frombuffer(s, bool) for s in frame.several])
        order = np.argsort(keys)
        keys, owner, several = keys[order], owner[order], several[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        least = np.minimum.reduceat(owner, first)
        found = (least != np.maximum.reduceat(owner, first)) | np.logical_or.reduceat(several, first)
        return pd.DataFrame({"value": keys[first][found].view(np.int64), "least": least[found]})

    return rows.mapInPandas(ask, "bucket int, keys binary, owners binary, several binary").groupBy("bucket").applyInPandas(
        meet, "value long, least long")


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` less the documents in the staged ``gone (doc_id, key)``, ``key`` being the text's xxhash64.

    A Bloom filter lets most of the documents that stay pass without a shuffle.
    """
    gone = gone.select(F.col("doc_id").alias("__gone_id"), F.col("key").alias("__gone_key"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumn("__text_key", F.xxhash64("text"))
    may = Bloom(gone.select("__gone_key"))(F.col("__text_key"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__gone_id")) & (F.col("__text_key") == F.col("__gone_key"))
    rest = keyed.where(may).join(gone, same, "left_anti")
    return keyed.where(~may).select(*names).union(rest.select(*names))

"""Exact substring dedup over all documents by column-wise suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller id.

Sorting every suffix of a large corpus in one structure fits no task, so the collection is cut where equal strings cannot
be lost. In every window of ``LENGTH`` bytes the ``GRAM``-byte substring with the smallest hash is an anchor; equal windows
have equal anchors at equal places. An anchor's row is the text around it that such windows can reach, aligned at the
anchor. Rows of one anchor meet in one task, where the suffix order of all rows is built column by column from the right:
each round puts one symbol in front of every row's suffix, re-sorts the order by that symbol (a stable counting sort, so
the order of the last round decides ties) and updates the longest common prefixes of neighbours; the symbols in the new
order are the round's part of the collection's Burrows-Wheeler transform. Since equal windows stand in equal columns,
each column's part is complete by itself. Orders and prefixes are kept as two files that a round reads and writes from
front to back, so memory holds a few numbers per row; neighbours with a common prefix of ``LENGTH`` or more are equal
windows, and the smallest id among them decides.

What is dropped before: anchors of one document only, and rows that are equal to another document's whole row, which
follow from the smallest id of that row without being sorted. Both are summed up before they are shuffled, and joins with
a hot anchor have a side with one row per key. Rows of an anchor with more than ``HOT`` different ones are compared window
by window by 128-bit hashes instead, which needs no common task.

Texts are kept compressed in blocks of a few megabytes. A block sends its different keys, packed, to the ranges they are
in and gets back a bit for each: whether another document has it. So just the places of shared anchors leave a block,
however large the collection is, where a filter of fixed size would let through all of them; and each row that is sorted
is cut from the one block that is asked for it. Blocks, and joins by anchor, are shuffled slice by slice, so that the
shuffled copy of one slice is on disk at a time.

Nulls and odd cases: a NULL text counts as empty; texts under ``LENGTH`` bytes keep everything; documents without an id
keep everything and take no part; rows of one id are no smaller than each other, so repeats within an id stay; extra
columns are dropped; very long runs of one byte have an anchor at every byte and are treated alike.
"""

from __future__ import annotations

import functools
import hashlib
import math
import os
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RUN, Bloom, cuts, packed, plain_text, stage, unstage

LENGTH = 50
GRAM = 20
REACH = LENGTH - GRAM  # bytes before an anchor that its windows can reach
WIDTH = REACH + LENGTH  # bytes of a row
HOT = 200_000
ROWS = 100_000  # rows per task, on average
BUCKET = 16 << 20  # bytes of text per range of anchor keys
MIX = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(int(MIX), -1, 1 << 64))
BLOCK = 4 << 20  # bytes of text that ask for their keys together
SLICES = 4  # shuffled one after the other, where one has
SLICE = 64 << 20  # bytes of text or more


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each byte on, by doubling."""

    def ahead(first: np.ndarray, second: np.ndarray, shift: int) -> np.ndarray:
        size = len(second) - shift
        return first[:size] * np.uint64(pow(int(MIX), shift, 1 << 64)) + second[shift:]

    one = data.astype(np.uint64) + np.uint64(1)
    two = ahead(one, one, 1)
    four = ahead(two, two, 2)
    eight = ahead(four, four, 4)
    out = ahead(ahead(eight, eight, 8), four, 16)
    out ^= out >> np.uint64(31)
    out *= MIX
    return out ^ (out >> np.uint64(29))


def sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """The least (or largest) of each ``width`` neighbouring values, by doubling."""
    done = 1
    while done * 2 <= width:
        values = least(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return least(values[:-rest], values[rest:]) if rest else values


class Reader:
    """Anchors of texts that follow each other, and hashes of their rows; one per task."""

    def __init__(self) -> None:
        self.powers = self.back = np.ones(0, dtype=np.uint64)

    def read(self, texts: Iterable[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(all bytes, text number, its text's start and end, place, key) of the smallest grams of all windows; ties all count."""
        lines = [text.encode("utf-8", "surrogatepass") for text in texts]
        data = b"".join(lines)
        return data, *self.anchors(data, np.array([len(line) for line in lines], dtype=np.int64))

    def anchors(self, data: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same without the bytes, for texts of ``size`` bytes that follow each other in ``data``."""
        end = np.cumsum(size)
        if not (size >= LENGTH).any():
            none = np.empty(0, np.int64)
            return none, none, none, none, np.empty(0, np.uint64)
        hashes = gram_hashes(np.frombuffer(data, np.uint8))
        least = sliding(hashes, REACH + 1, np.minimum)
        for low, high in zip(np.maximum(end - size, end - LENGTH + 1).tolist(), end.tolist()):
            least[low:high] = 0  # windows that would run on into the next text
        zeros = np.zeros(REACH, np.uint64)
        at = np.flatnonzero(sliding(np.concatenate([zeros, least, zeros]), REACH + 1, np.maximum) == hashes)
        owner = np.searchsorted(end, at, "right")
        inside = (at + GRAM <= end[owner]) & (size[owner] >= LENGTH)
        at, owner = at[inside], owner[inside]
        # Smallest hashes are small numbers; mixed again they spread over all ranges.
        keys = hashes[at]
        return owner, (end - size)[owner], end[owner], at, (keys ^ (keys >> np.uint64(27))) * MIX

    def rows(self, data: bytes, low: np.ndarray, at: np.ndarray, high: np.ndarray) -> np.ndarray:
        """A hash of each row ``data[low:high]`` with its anchor at ``at``: its bytes times powers of ``MIX``."""
        if len(data) >= len(self.powers):
            self.powers = np.cumprod(np.full(len(data) + 1, MIX, dtype=np.uint64))
            self.back = np.cumprod(np.full(len(data) + 1, BACK, dtype=np.uint64))
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((np.frombuffer(data, np.uint8) + np.uint64(1)) * self.powers[:len(data)], out=total[1:])
        out = (total[high] - total[low]) * self.back[low]
        out = (out ^ (out >> np.uint64(32))) * MIX + (at - low).astype(np.uint64)
        return ((out ^ (out >> np.uint64(29))) * MIX).view(np.int64)


def row_bounds(at: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where an anchor's row starts and stops."""
    return np.maximum(start, at - REACH), np.minimum(end, at + LENGTH)


def full(at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window start that an anchor's row holds."""
    return np.maximum(0, at - REACH), np.minimum(at, size - LENGTH)


def column_sort(ahead: np.ndarray, rows: list[bytes], owner: np.ndarray, folder: str) -> np.ndarray:
    """For each row a bit mask of the windows (bit o: the one that starts in column o) that a smaller owner holds too.

    Column ``REACH`` is the anchor's. Order and common prefixes go through two pairs of files in ``folder``.
    """
    count = len(rows)
    table = np.zeros((WIDTH, count), dtype=np.uint8)
    ends = np.empty(count, dtype=np.int64)
    for k, row in enumerate(rows):
        start = REACH - ahead[k]
        ends[k] = start + len(row)
        table[start:ends[k], k] = np.frombuffer(row, np.uint8)
    starts = REACH - ahead
    flags = np.zeros(count, dtype=np.int64)
    names = [[os.path.join(folder, f"{what}{turn}") for what in ("order", "prefix")] for turn in (0, 1)]
    np.arange(count, dtype=np.int32).tofile(names[0][0])
    np.zeros(count, dtype=np.uint8).tofile(names[0][1])
    for turn, column in enumerate(range(WIDTH - 1, -1, -1)):
        order = np.fromfile(names[turn % 2][0], np.int32)
        prefix = np.fromfile(names[turn % 2][1], np.uint8)
        if not turn:
            prefix[1:] = WIDTH  # all suffixes are empty and equal
        symbols = table[column][order]
        sorted_by = np.argsort(symbols, kind="stable")
        order, symbols = order[sorted_by], symbols[sorted_by]
        longest = np.zeros(count, dtype=np.uint8)
        edges = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1], [True]]))
        for low, high in zip(edges, edges[1:]):
            if high - low > 1:
                # Neighbours with one symbol share what everything between them shared, and the symbol.
                old = sorted_by[low:high]
                span = prefix[old[0] + 1:old[-1] + 1]
                shared = np.minimum.reduceat(span, old[:-1] - old[0])
                longest[low + 1:high] = np.minimum(shared, WIDTH - column - 1) + 1
        order.tofile(names[1 - turn % 2][0])
        longest.tofile(names[1 - turn % 2][1])
        if column <= REACH:
            group = np.flatnonzero(longest < LENGTH)
            whole = (starts[order] <= column) & (ends[order] >= column + LENGTH)
            own = np.where(whole, owner[order], np.iinfo(np.int64).max)
            least = np.repeat(np.minimum.reduceat(own, group), np.diff(np.append(group, count)))
            flags[order[whole & (least < own)]] |= 1 << column
    return flags


def blocks_of(rows: DataFrame) -> DataFrame:
    """(block, volume, docs, keys, sizes, data): ``rows (doc_id, text_key, text)`` packed, their bytes compressed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, volume = TaskContext.get().partitionId() << 32, [], 0

        def row() -> pa.RecordBatch:
            docs, keys, sizes, data = zip(*held)
            values = [np.concatenate(x).tobytes() for x in (docs, keys, sizes)]
            values.append(pa.Codec("zstd", compression_level=3).compress(b"".join(data), asbytes=True))
            return pa.RecordBatch.from_arrays(
                [pa.array([x], pa.int64()) for x in (block, volume)] + [pa.array([x], pa.binary()) for x in values],
                names=["block", "volume", "docs", "keys", "sizes", "data"])

        for batch in batches:
            docs, keys = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("doc_id", "text_key"))
            texts = batch.column("text").cast(pa.large_binary())
            edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
            low = 0
            while low < len(texts):
                # The text that fills a block is its last.
                high = min(len(texts), int(np.searchsorted(edges[low + 1:], edges[low] + BLOCK - volume)) + low + 1)
                data = texts.buffers()[2]
                held.append((docs[low:high], keys[low:high], np.diff(edges[low:high + 1]),
                             data[int(edges[low]):int(edges[high])].to_pybytes() if data else b""))
                volume += int(edges[high] - edges[low])
                low = high
                if volume >= BLOCK:
                    yield row()
                    block, held, volume = block + 1, [], 0
        if held:
            yield row()

    return rows.select("doc_id", "text_key", "text").mapInArrow(
        pack, "block long, volume long, docs binary, keys binary, sizes binary, data binary")


def sections(frame: pd.DataFrame, reader: Reader) -> Iterator[tuple[np.ndarray, np.ndarray, bytes, tuple[np.ndarray, ...]]]:
    """(ids, text keys, bytes, anchors) of the one block in ``frame``, some ``RUN`` bytes or one text at a time."""
    (row,) = frame.itertuples()
    docs, keys, size = (np.frombuffer(x, np.int64) for x in (row.docs, row.keys, row.sizes))
    data = pa.Codec("zstd").decompress(row.data, int(size.sum()), asbytes=True)
    end = np.cumsum(size)
    number = end // RUN
    edges = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1], [True]]))
    for a, b in zip(edges, edges[1:]):
        part = data[end[a] - size[a]:end[b - 1]]
        yield docs[a:b], keys[a:b], part, reader.anchors(part, size[a:b])


def shared_keys(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, bits): a bit for each different key that the block has in that range of keys, in their order.

    It is set where another document has the key as well; ranges without such a key are left out.
    """

    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        found = [(codes, docs[owner]) for docs, _, _, (owner, *_, codes) in sections(frame, Reader())]
        return packed(found, buckets).assign(block=frame.block.iloc[0])

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.frombuffer(k, np.uint64) for k in frame["keys"]])
        owner = np.concatenate([np.frombuffer(o, np.int64) for o in frame.owners])
        several = np.concatenate([np.frombuffer(s, bool) for s in frame.several])
        order = np.argsort(keys)
        keys, owner, several = keys[order], owner[order], several[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        found = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
        found |= np.logical_or.reduceat(several, first)
        shared = np.empty(len(keys), dtype=bool)
        shared[order] = np.repeat(found, np.diff(np.append(first, len(keys))))
        parts = np.split(shared, np.cumsum(frame["keys"].str.len().to_numpy() // 8)[:-1])
        return pd.DataFrame(
            [(a, b, np.packbits(part).tobytes()) for a, b, part in zip(frame.block, frame.bucket, parts) if part.any()],
            columns=["block", "bucket", "bits"])

    asked = blocks.groupBy("block").applyInPandas(ask, "bucket int, keys binary, owners binary, several binary, block long")
    return asked.groupBy("bucket").applyInPandas(meet, "block long, bucket int, bits binary")


def with_blocks(blocks: DataFrame, other: DataFrame, read: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """What ``read`` makes of each block and the rows of ``other`` that name it; blocks that none names are passed over."""

    def both(block: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        return read(block, rows) if len(block) and len(rows) else pd.DataFrame()

    return blocks.groupBy("block").cogroup(other.groupBy("block")).applyInPandas(both, schema)


def places(blocks: DataFrame, answers: DataFrame, buckets: int) -> DataFrame:
    """(anchor, row, doc_id, text_key, at, block): where the shared anchors stand; ``row`` is a hash of the row there."""

    def find(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        reader = Reader()
        parts = list(sections(block, reader))
        distinct, number = np.unique(np.concatenate([found[-1] for *_, found in parts]), return_inverse=True)
        shared, cut = np.zeros(len(distinct), dtype=bool), cuts(distinct, buckets)
        for bucket, bits in zip(answers.bucket, answers.bits):
            low, high = cut[bucket], cut[bucket + 1]
            shared[low:high] = np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low)
        shared, out, done = shared[number], [], 0
        for docs, keys, data, found in parts:
            keep = np.flatnonzero(shared[done:done + len(found[-1])])
            done += len(found[-1])
            owner, start, end, at, codes = (x[keep] for x in found)
            low, high = row_bounds(at, start, end)
            out.append(pd.DataFrame({
                "anchor": codes.view(np.int64), "row": reader.rows(data, low, at, high), "doc_id": docs[owner],
                "text_key": keys[owner], "at": (at - start).astype(np.int32),
            }))
        return pd.concat(out, ignore_index=True).assign(block=block.block.iloc[0])

    return with_blocks(blocks, answers, find, "anchor long, row long, doc_id long, text_key long, at int, block long")


def rows_to_sort(blocks: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, row, owner, ahead, data) for ``wanted (anchor, row, owner, block)``: one row of text each."""

    def cut(block: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        reader, out = Reader(), []
        wanted = wanted[["anchor", "row", "owner"]]
        anchors = np.sort(wanted.anchor.to_numpy())
        for _, _, data, (_, start, end, at, codes) in sections(block, reader):
            codes = codes.view(np.int64)
            keep = np.flatnonzero(anchors[np.minimum(np.searchsorted(anchors, codes), len(anchors) - 1)] == codes)
            at, codes = at[keep], codes[keep]
            low, high = row_bounds(at, start[keep], end[keep])
            found = pd.DataFrame({
                "anchor": codes, "row": reader.rows(data, low, at, high), "ahead": (at - low).astype(np.int32), "low": low, "high": high,
            }).drop_duplicates(["anchor", "row"]).merge(wanted, on=["anchor", "row"])
            found["data"] = [data[a:b] for a, b in zip(found.pop("low").tolist(), found.pop("high").tolist())]
            out.append(found)
        return pd.concat(out, ignore_index=True).drop_duplicates(["anchor", "row"])

    return with_blocks(blocks, wanted, cut, "anchor long, row long, owner long, ahead int, data binary")


def sorted_flags(found: DataFrame, hot: int) -> DataFrame:
    """(anchor, row, flags) of the rows in ``found (anchor, row, owner, ahead, data)`` that have a flag."""
    crowded = stage(found.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("anchor"), "suffix-hot")
    total = found.count()
    some = not crowded.isEmpty()
    cool = found.join(crowded, "anchor", "left_anti") if some else found

    def sort(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [f for f in frames if len(f)]
        if parts:
            frame = pd.concat(parts, ignore_index=True)
            del parts
            with tempfile.TemporaryDirectory() as folder:  # this task's own, gone when it ends
                flags = column_sort(frame.ahead.to_numpy(), frame.data.to_list(), frame.owner.to_numpy(), folder)
            frame = frame[["anchor", "row"]].assign(flags=flags)
            yield frame[frame["flags"] != 0]

    tasks = max(1, math.ceil(total / ROWS))
    out = cool.repartition(tasks, "anchor").mapInPandas(sort, "anchor long, row long, flags long")
    if not some:
        return out
    # Column o of a row starts at byte o - (REACH - ahead) of its data, counted from 0.
    start = F.col("o") - REACH + F.col("ahead")
    cells = (
        found.join(crowded, "anchor", "left_semi").withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(REACH))))
        .where((start >= 0) & (start + LENGTH <= F.length("data")))
        .withColumn("window", F.md5(F.call_function("substring", F.col("data"), start + 1, F.lit(LENGTH))))
    )
    least = cells.groupBy("anchor", "o", "window").agg(F.min("owner").alias("least"))
    hit = cells.join(least, ["anchor", "o", "window"]).where("least < owner").groupBy("anchor", "row").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("o"))).alias("flags"))
    return out.union(hit)


def covered(size: int, at: list[int], flags: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes; flags of -1 stand for all windows of an anchor's row."""
    starts = np.zeros(size + 1, dtype=np.int32)
    places_, marks = np.asarray(at, np.int64), np.asarray(flags, np.int64)
    every = marks == -1
    low, high = full(places_[every], np.full(int(every.sum()), size))
    np.add.at(starts, low, 1)
    np.add.at(starts, high + LENGTH, -1)
    for place, mark in zip(places_[~every].tolist(), marks[~every].tolist()):
        for column in range(REACH + 1):
            if mark >> column & 1:
                start = place - REACH + column
                starts[start] += 1
                starts[start + LENGTH] -= 1
    inside = np.cumsum(starts)[:size] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def sliced(make: Callable[[Callable[[Column], Column]], DataFrame], slices: int, label: str) -> DataFrame:
    """All that ``make(holds)`` makes for each slice, staged one after the other; ``holds(value)`` is true in the slice of a value."""
    parts = []
    for k in range(slices):
        parts.append(stage(make(lambda value, k=k: F.pmod(F.shiftright(value, 1), F.lit(slices)) == k), label))
    return functools.reduce(DataFrame.union, parts)


def removals(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, text_key, marks): staged, the anchors of ``docs`` at which bytes go, as (at, flags): the windows that do.

    Each step's files go once what reads them is written.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), plain_text().alias("text"))
    blocks = stage(blocks_of(rows), "suffix-blocks")
    volume = blocks.agg(F.sum("volume").alias("v")).first().v or 0
    buckets, slices = max(1, math.ceil(volume / BUCKET)), min(SLICES, max(1, volume // SLICE))
    answers = stage(shared_keys(blocks, buckets), "suffix-anchors")
    found = sliced(lambda holds: places(
        blocks.where(holds(F.hash("block"))), answers.where(holds(F.hash("block"))), buckets), slices, "suffix-places")
    unstage(answers)
    # The smallest id that has a row, and a block that has it, where it may be another's.
    by_row = stage(found.groupBy("anchor", "row").agg(
        F.min("doc_id").alias("owner"), F.min("block").alias("block")), "suffix-rows")

    def different(holds: Callable[[Column], Column]) -> DataFrame:
        mine = by_row.where(holds(F.col("anchor")))
        by_anchor = mine.groupBy("anchor").agg(
            F.min("row").alias("a"), F.max("row").alias("b"), F.min("owner").alias("d"), F.max("owner").alias("e"))
        # Different rows of different documents: only there can a window be equal and the row not.
        return mine.join(by_anchor.where("a <> b AND d <> e").select("anchor"), "anchor", "left_semi")

    wanted = sliced(different, slices, "suffix-wanted")
    to_sort = sliced(lambda holds: rows_to_sort(
        blocks.where(holds(F.hash("block"))), wanted.where(holds(F.hash("block")))), slices, "suffix-sort")
    for done in (wanted, blocks):
        unstage(done)
    flags = stage(sorted_flags(to_sort, hot), "suffix-flags")
    unstage(to_sort)

    def marked(holds: Callable[[Column], Column]) -> DataFrame:
        known = by_row.where(holds(F.col("anchor"))).join(flags, ["anchor", "row"], "left").select(
            "anchor", "row", F.col("owner").alias("least"), F.coalesce("flags", F.lit(0)).alias("flags"))
        return found.where(holds(F.col("anchor"))).join(known, ["anchor", "row"]).select(
            "doc_id", "text_key", "at", F.when(F.col("doc_id") > F.col("least"), F.lit(-1).cast("long")).otherwise(F.col("flags")).alias("flags"),
        ).where("flags <> 0")

    marks = sliced(marked, slices, "suffix-marked")
    for done in (found, by_row, flags):
        unstage(done)
    gone = stage(
        marks.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "flags")).alias("marks")), "suffix-marks")
    unstage(marks)
    return gone


def dedup(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): ``removed`` are spans of bytes (start, stop), ``kept`` is the rest's SHA-256."""
    gone = removals(docs, hot).withColumnsRenamed({"doc_id": "d", "text_key": "k"})
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), plain_text().alias("text"))
    may = Bloom(gone.select("k"))(F.col("text_key"))

    @F.pandas_udf("removed array<struct<start:int,stop:int>>, kept string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, at, flags in batches:
            out = []
            for text, a, f in zip(texts, at, flags):
                data = text.encode("utf-8", "surrogatepass")
                spans = [] if a is None else covered(len(data), a, f)
                rest, last = [], 0
                for start, stop in spans:
                    rest.append(data[last:start])
                    last = stop
                out.append(([{"start": x, "stop": y} for x, y in spans], hashlib.sha256(b"".join(rest) + data[last:]).hexdigest()))
            yield pd.DataFrame(out, columns=["removed", "kept"])

    size = F.octet_length("text").cast("long").alias("n_bytes")
    changed = rows.where(may).join(
        gone, (F.col("doc_id") == F.col("d")) & (F.col("text_key") == F.col("k")), "left"
    ).withColumn("cut", cut("text", F.col("marks.at"), F.col("marks.flags")))
    none = F.array().cast("array<struct<start:int,stop:int>>").alias("removed")
    return changed.select("doc_id", size, "cut.removed", "cut.kept").union(
        rows.where(~may).select("doc_id", size, none, F.sha2("text", 256).alias("kept")))

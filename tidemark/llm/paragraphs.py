"""Substring dedup: paragraphs by MinHash banding, exact Jaccard, components; running text by windows of words.

A paragraph here is a stretch of text that ends where a line ends or where a sentence of eight words or more ends. The rule looks
at the sentence alone, so a passage put into the middle of other text falls into the same paragraphs as elsewhere, but
for its first and last. A paragraph's set are its 5-word shingles (A-Z lower-cased; fewer words: the whole).

1. Equal paragraphs (64-bit hash of their words) are summed up: the first place, by document and position, and where
   there is another.
2. Each different paragraph gets a signature of ``BANDS * ROWS`` min-hashes; ``BANDS`` and ``ROWS`` are tuned so that a
   pair at similarity 0.8 collides with probability 0.998. Colliding paragraphs are linked in two passes, each verified
   by exact Jaccard: first every member of a band with the band's smallest, then, if the components of those links leave
   a band in several parts, all pairs across parts. A band of copies thus costs one link per member, and no link between
   parts is left out.
3. A component's paragraph at the first place stays, the others are removed, but only in runs of at least ``MIN_RUN``
   words: a single repeated line of a few words stays.
4. A passage that stands inside other sentences is found by its windows of ``MIN_RUN`` words, to the word: whatever
   window stands in an earlier document goes. A window is told by the least of its shingles' hashes, so two equal
   windows name the same shingle wherever they stand. Only windows whose shingle stands in two different texts are
   hashed and compared. A copy of a whole text goes whole. Paragraphs that touch such a run go with it.
5. Of equal texts the one with the smallest id is cut up; what holds its paragraphs and windows holds the copies' too. A
   Bloom filter of those first ones sifts the others out, and what it lets through is cut up as well and changes nothing.

Nulls and odd cases: a NULL text counts as empty and stays NULL; texts without words stay as they are; a document's
repetitions of its own paragraphs stay if no earlier document holds them; equal texts under one id are one document, so
such repeated rows keep the same paragraphs; a NULL id sorts before all others; extra columns are kept, whatever their names,
but for ``n_removed`` and ``first_docs``, which are made anew.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Bloom, Pairs, bloom_test, components, plain_text, runs, several_owners, stage, unstage, words
from .suffix_dedup import BACK, BUCKET, MIX, sliding

SHINGLE = 5
SIMILAR = 0.8
BANDS = 6
ROWS = 2
BAND_COLUMNS = [f"band{k}" for k in range(BANDS)]
HUBS = 6  # members of a band that all others are compared with first
HELD = 1 << 18  # pairs per range of values where those of different owners are looked for
LONG = 8  # words of a sentence that ends a paragraph
MIN_RUN = 20  # words of neighbouring repeated paragraphs that are removed
SEEN = 1 << 17  # units that a task remembers it has given
SENTENCE = re.compile(r"[^.!?\n]*+(?:[.!?]++(?![\s])[^.!?\n]*+)*+(?:[.!?]+|\n|\Z)\s*+")
RANDOM = np.random.default_rng(20)
MULTIPLY = RANDOM.integers(1, 1 << 63, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFT = RANDOM.integers(0, 1 << 63, size=BANDS * ROWS, dtype=np.uint64)


def paragraphs(text: str) -> list[tuple[int, int]]:
    """Spans that cover the text from end to end."""
    out, start, end = [], 0, 0
    for sentence in SENTENCE.findall(text):  # one follows the other
        end += len(sentence)
        if "\n" in sentence or len(sentence.split(None, LONG - 1)) >= LONG:
            out.append((start, end))
            start = end
    if start < len(text):
        out.append((start, len(text)))
    return out


def shingle_keys(codes: np.ndarray) -> np.ndarray:
    """A key for the ``SHINGLE`` words from each word on, made of the words' hashes."""
    size = max(0, len(codes) - SHINGLE + 1)
    key = codes[:size].copy()
    for k in range(1, SHINGLE):
        key = (key ^ (key >> np.uint64(31))) * MIX + codes[k:size + k]
    return key


def window_keys(keys: np.ndarray) -> np.ndarray:
    """A key for each window of ``MIN_RUN`` words, made of shingles that cover it."""
    count = len(keys) - MIN_RUN + SHINGLE
    out = keys[:count].copy()
    for at in range(SHINGLE, MIN_RUN - SHINGLE + 1, SHINGLE):
        out = (out ^ (out >> np.uint64(31))) * MIX + keys[at:at + count]
    return (out ^ (out >> np.uint64(32))) * MIX


# What each byte counts in a word's hash: A-Z as lower case, white space nothing.
COUNTS = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
COUNTS[[0x20, *range(0x09, 0x0E)]] = 0
IS_WORD = COUNTS > 0
SPACE = re.compile(rb"[\x20\x09-\x0D]")
PART = 1 << 18  # bytes that are hashed at once, and what is left of the last word


class Cutter:
    """Paragraphs of texts with their ids, word counts and band keys; one per task.

    A word's hash is the sum of its bytes times powers of ``MIX`` by their place in it. The powers run on through a part
    of the text and each word's sum is taken back by the power at its start, so no word is looked at by itself.
    """

    def __init__(self) -> None:
        self.powers = self.back = np.ones(0, dtype=np.uint64)

    def grow(self, size: int) -> None:
        if size > len(self.powers):
            self.powers = np.cumprod(np.full(size, MIX, dtype=np.uint64))
            self.back = np.cumprod(np.full(size, BACK, dtype=np.uint64))

    def codes(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where each word of ``data`` starts, and its hash."""
        starts, codes, at = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], 0
        while at < len(data):
            space = SPACE.search(data, at + PART)
            end = space.start() if space else len(data)
            part = np.frombuffer(data, np.uint8, end - at, at)
            inside = IS_WORD[part]
            start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
            if inside[0]:
                start = np.concatenate([[0], start])
            if len(start):
                self.grow(len(part))
                total = np.add.reduceat(COUNTS[part] * self.powers[:len(part)], start) * self.back[start]
                starts.append(start + at)
                codes.append((total ^ (total >> np.uint64(32))) * MIX)
            at = end
        return np.concatenate(starts), np.concatenate(codes)

    def cut(self, texts: pd.Series) -> tuple[list[int], list[int], np.ndarray, np.ndarray]:
        """(text number, position, words) of each paragraph of five words or more, and the hashes of all its words."""
        owner, place, found = [], [], []
        for number, text in enumerate(texts):
            spans = paragraphs(text)
            owner += [number] * len(spans)
            place += range(len(spans))
            found += [text[a:b].encode("utf-8", "surrogatepass") for a, b in spans]
        # Paragraphs as lines, so that no word runs from one into the next.
        starts, codes = self.codes(b"\n".join(found))
        edges = np.cumsum([0, *(len(line) + 1 for line in found)])
        size = np.diff(np.searchsorted(starts, edges))
        long = size >= SHINGLE
        kept = np.flatnonzero(long).tolist()
        return [owner[k] for k in kept], [place[k] for k in kept], size[long], codes[np.repeat(long, size)]

    def tokens(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words of texts that follow each other, and how many there are up to the end of each."""
        lines = [text.encode("utf-8", "surrogatepass") for text in texts]
        starts, codes = self.codes(b"\n".join(lines))
        return codes, np.searchsorted(starts, np.cumsum([len(line) + 1 for line in lines]))

    def windows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text number, first word, name, key) of each window of ``MIN_RUN`` words; its name is its least shingle."""
        codes, ends = self.tokens(texts)
        count = len(codes) - MIN_RUN + 1
        if count < 1:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
        size = np.diff(ends, prepend=0)
        owner = np.repeat(np.arange(len(size)), size)[:count]
        word = np.arange(count) - (np.cumsum(size) - size)[owner]
        whole = word <= size[owner] - MIN_RUN  # others would run on into the next text
        keys = shingle_keys(codes)
        keys = (keys ^ (keys >> np.uint64(32))) * MIX
        names = sliding(keys, MIN_RUN - SHINGLE + 1, np.minimum)
        return owner[whole], word[whole], names[whole], window_keys(keys)[whole]

    def ids(self, size: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """A paragraph's id from its words' hashes and their places."""
        if not len(size):
            return np.empty(0, np.int64)
        start = np.cumsum(size) - size
        self.grow(int(size.max()))
        within = np.arange(len(codes)) - np.repeat(start, size)
        total = np.add.reduceat((codes ^ (codes >> np.uint64(33))) * self.powers[within], start)
        return ((total ^ (total >> np.uint64(32))) * MIX + size.astype(np.uint64)).view(np.int64)

    def bands(self, size: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Band keys, one row per paragraph of five words or more."""
        if not len(size):
            return np.empty((0, BANDS), np.int64)
        keys = shingle_keys(codes)
        start = np.cumsum(size) - size
        # Shingles that would run over a paragraph's end do not count.
        within = np.arange(len(keys)) - np.repeat(start, size)[:len(keys)]
        keys = keys[within <= (np.repeat(size, size) - SHINGLE)[:len(keys)]]
        keys ^= keys >> np.uint64(32)
        counts = size - SHINGLE + 1
        first = np.cumsum(counts) - counts
        out = np.empty((len(size), BANDS), dtype=np.uint64)
        for band in range(BANDS):
            key = np.full(len(size), band + 1, dtype=np.uint64)
            for row in range(band * ROWS, (band + 1) * ROWS):
                mixed = keys * MULTIPLY[row] + SHIFT[row]
                least = np.minimum.reduceat(mixed ^ (mixed >> np.uint64(29)), first)
                key = (key ^ (key >> np.uint64(31))) * MIX + least
            out[:, band] = (key ^ (key >> np.uint64(30))) * MIX
        return out.view(np.int64)


def first_texts(rows: DataFrame) -> DataFrame:
    """(key, first, last) of each text of ``rows (doc_id, key)``: the smallest and largest id that has it."""
    ids = F.struct("doc_id")
    return rows.groupBy("key").agg(F.min(ids).alias("first"), F.max(ids).alias("last"))


def placed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("place", F.xxhash64("doc_id", "key"))


def sifting(first: Bloom | None) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """What drops rows of a ``placed`` frame that are not in ``first``: copies of earlier texts, or most of them."""
    if first is None:
        return lambda frame: frame
    filled, mask = first.shared, first.bits - 1
    return lambda frame: frame[bloom_test(filled.value, frame.place.to_numpy(), mask)]


def units(rows: DataFrame, first: Bloom | None = None) -> DataFrame:
    """Paragraphs of five words or more in ``rows (doc_id, key, text)``: (doc_id, key, pos, unit, n_words), a column per band."""
    sift = sifting(first)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = Cutter()
        for frame in map(sift, frames):
            for part in runs(frame):
                owner, place, size, codes = cutter.cut(part.text)
                yield pd.DataFrame({
                    "doc_id": part.doc_id.astype("Int64").array[owner], "key": part.key.to_numpy()[owner],
                    "pos": place, "unit": cutter.ids(size, codes), "n_words": size,
                    **dict(zip(BAND_COLUMNS, cutter.bands(size, codes).T)),
                })

    return placed(rows).mapInPandas(
        cut, "doc_id long, key long, pos int, unit long, n_words int, " + ", ".join(f"{c} long" for c in BAND_COLUMNS))


def shingle_sets(rows: DataFrame, found: DataFrame, wanted: DataFrame, first: Bloom | None = None) -> DataFrame:
    """(unit, hashes) for the units in ``wanted (unit)``, read from texts that hold one; ``found`` are all units."""
    ids = Bloom(wanted)
    holders = found.where(ids(F.col("unit"))).join(wanted.distinct(), "unit", "left_semi").groupBy("unit").agg(
        F.min("key").alias("key"))
    texts = Bloom(holders.select("key"))
    filled, mask = ids.shared, ids.bits - 1
    holding, holding_mask = texts.shared, texts.bits - 1
    sift = sifting(first)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = Cutter()
        seen: set[int] = set()
        for frame in map(sift, frames):
            for part in runs(frame[bloom_test(holding.value, frame.key.to_numpy(), holding_mask)]):
                units_out, sets = [], []
                _, _, size, codes = cutter.cut(part.text)
                own, end = cutter.ids(size, codes), np.cumsum(size)
                for k in np.flatnonzero(bloom_test(filled.value, own, mask)):
                    if int(own[k]) not in seen:
                        seen.add(int(own[k]))
                        units_out.append(int(own[k]))
                        # As arrays: a list would take four times the memory.
                        sets.append(np.unique(shingle_keys(codes[end[k] - size[k]:end[k]])).view(np.int64))
                if len(seen) > SEEN:
                    seen.clear()
                yield pd.DataFrame({"unit": pd.Series(units_out, dtype="int64"), "hashes": pd.Series(sets, dtype=object)})

    made = placed(rows).select("place", "key", "text").mapInPandas(cut, "unit long, hashes array<long>")
    return made.join(wanted.distinct(), "unit", "left_semi").groupBy("unit").agg(F.first("hashes").alias("hashes"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (src, dst) whose sets are similar."""
    a = sets.select(F.col("unit").alias("src"), F.col("hashes").alias("a"))
    b = sets.select(F.col("unit").alias("dst"), F.col("hashes").alias("b"))
    shared = F.size(F.array_intersect("a", "b"))
    return pairs.join(a, "src").join(b, "dst").where(
        shared * (1 + SIMILAR) >= SIMILAR * (F.size("a") + F.size("b")) - 1e-9  # whatever the rounding of 0.8
    ).select("src", "dst")


def buckets(count: int, size: int) -> int:
    return max(1, math.ceil(count / size))


def near_links(rows: DataFrame, found: DataFrame, first: Bloom | None = None) -> DataFrame:
    """Verified links (src, dst) between the units of ``found`` that connect all similar colliding ones."""
    cut = found.select("unit", *BAND_COLUMNS)

    def pairs(frames: Iterator[pd.DataFrame]) -> Pairs:
        for frame in frames:
            for band in BAND_COLUMNS:
                yield frame[band].to_numpy().view(np.uint64), frame.unit.to_numpy()

    shared = stage(several_owners(cut, pairs, buckets(found.count() * BANDS, HELD)).withColumnRenamed("value", "band"), "paragraph-shared")
    sift = Bloom(shared.select("band"))
    filled, mask = sift.shared, sift.bits - 1

    def narrow(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            unit = frame.unit.to_numpy()
            found = [(band, np.flatnonzero(bloom_test(filled.value, band, mask))) for band in (frame[c].to_numpy() for c in BAND_COLUMNS)]
            yield pd.DataFrame({
                "unit": np.concatenate([unit[at] for _, at in found]), "band": np.concatenate([band[at] for band, at in found])})

    members = stage(cut.mapInPandas(narrow, "unit long, band long").distinct().join(shared, "band"), "paragraph-bands")
    sets = stage(shingle_sets(rows, found, members.select("unit"), first), "paragraph-sets")
    # Several hubs a band: where its smallest is like few others, another one joins most of them.
    hubs = members.groupBy("band").agg(F.array(
        F.min("unit"), F.max("unit"), *[F.min_by("unit", F.xxhash64("unit", F.lit(k))) for k in range(HUBS - 2)]).alias("hubs"))
    star = stage(verified(
        members.join(hubs, "band").select("unit", F.explode("hubs").alias("hub")).where("unit <> hub")
        .select(F.least("unit", "hub").alias("src"), F.greatest("unit", "hub").alias("dst")).distinct(), sets
    ), "paragraph-links")
    parts = components(star, "paragraph-parts")
    labelled = members.join(parts.withColumnRenamed("node", "unit"), "unit", "left").select(
        "band", "unit", F.coalesce("component", "unit").alias("part"))
    split = labelled.groupBy("band").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a < b").select("band")
    left = stage(
        labelled.join(split, "band", "left_semi").join(sets, "unit").withColumn("n", F.size("hashes")), "paragraph-split")
    a, b = left.alias("a"), left.alias("b")
    # Verified within the join, lengths first, so that it gives links and not pairs.
    across = a.join(b, [
        F.col("a.band") == F.col("b.band"), F.col("a.part") < F.col("b.part"),
        F.least("a.n", "b.n") >= SIMILAR * F.greatest("a.n", "b.n"),
        F.size(F.array_intersect("a.hashes", "b.hashes")) * (1 + SIMILAR) >= SIMILAR * (F.col("a.n") + F.col("b.n")) - 1e-9,
    ]).select(F.col("a.unit").alias("src"), F.col("b.unit").alias("dst")).distinct()
    across = stage(across, "paragraph-links")
    for done in (shared, members, sets, left):
        unstage(done)
    return star.union(across)


def repeated(rows: DataFrame, kept: Bloom | None = None) -> DataFrame:
    """(doc_id, key, pos, n_words, first_doc) of the paragraphs of ``rows (doc_id, key, text)`` that go."""
    found = stage(units(rows, kept), "paragraph-units")
    joined = components(near_links(rows, found, kept), "paragraph-components").withColumnRenamed("node", "unit")

    def pairs(frames: Iterator[pd.DataFrame]) -> Pairs:
        for frame in frames:
            yield frame.unit.to_numpy().view(np.uint64), frame.place.to_numpy()

    # Units that stand in two places or are linked; all others stay without being looked at again.
    places = found.select("unit", F.xxhash64("doc_id", "key", "pos").alias("place"))
    several = stage(
        several_owners(places, pairs, buckets(found.count(), HELD)).select(F.col("value").alias("unit"))
        .join(joined, "unit", "full").select("unit", F.coalesce("component", "unit").alias("component")), "paragraph-several")
    sift = Bloom(several.select("unit"))
    standing = stage(
        found.where(sift(F.col("unit"))).select("doc_id", "key", "pos", "n_words", "unit").join(several, "unit"), "paragraph-places")
    first = standing.groupBy("component").agg(F.min(F.struct("doc_id", "key", "pos")).alias("first"))
    places = standing.join(first, "component")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    gone = stage(places.where(~same).select(
        "doc_id", "key", "pos", "n_words", F.col("first.doc_id").alias("first_doc")), "paragraph-repeated")
    for done in (found, several, standing):
        unstage(done)
    return gone


def passages(rows: DataFrame, kept: Bloom | None = None, texts: DataFrame | None = None) -> DataFrame:
    """(doc_id, key, start, first_doc) of the windows of words of ``rows (doc_id, key, text)`` that go.

    ``start`` is the number of the window's first word, -1 for a whole text that an earlier document has; ``texts`` are
    the ``first_texts`` of the rows.
    """
    sift = sifting(kept)

    def names(frames: Iterator[pd.DataFrame]) -> Pairs:
        cutter = Cutter()
        for frame in map(sift, frames):
            for part in runs(frame):
                owner, _, name, _ = cutter.windows(part.text.to_list())
                # Neighbours mostly have one name.
                new = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])])[:len(name)])
                # Least hashes are small numbers; times an odd one they spread over all ranges.
                yield name[new] * MIX, part.key.to_numpy()[owner[new]]

    volume = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("v")).first().v or 0
    shared = stage(several_owners(
        placed(rows).select("place", "key", "text"), names, buckets(volume, BUCKET)).select("value"), "paragraph-names")
    found = Bloom(shared, bits=1 << 26)
    filled, mask = found.shared, found.bits - 1

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cutter = Cutter()
        for frame in map(sift, frames):
            for part in runs(frame):
                owner, word, name, window = cutter.windows(part.text.to_list())
                may = np.flatnonzero(bloom_test(filled.value, (name * MIX).view(np.int64), mask))
                yield pd.DataFrame({
                    "doc_id": part.doc_id.astype("Int64").array[owner[may]], "key": part.key.to_numpy()[owner[may]],
                    "start": word[may].astype(np.int32), "window": window[may].view(np.int64),
                })

    places = stage(placed(rows).mapInPandas(cut, "doc_id long, key long, start int, window long"), "paragraph-windows")
    unstage(shared)
    found.close()
    firsts = stage(
        places.groupBy("window").agg(
            F.min(F.struct("doc_id", "key")).alias("first"), F.max(F.struct("doc_id", "key")).alias("last"))
        .where("first < last").select("window", "first"), "paragraph-firsts")
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    inside = stage(places.join(firsts, "window").where(~own).select(
        "doc_id", "key", "start", F.col("first.doc_id").alias("first_doc")), "paragraph-inside")
    for done in (places, firsts):
        unstage(done)
    enough = rows.where(F.length("text") >= 2 * MIN_RUN - 1)  # characters that so many words have at least
    copied = (stage(first_texts(rows), "paragraph-texts") if texts is None else texts).where("first < last")
    whole = stage(enough.select("doc_id", "key").join(copied.select("key", "first"), "key").where(
        ~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    ).select("doc_id", "key", F.lit(-1).alias("start"), F.col("first.doc_id").alias("first_doc")).distinct(), "paragraph-whole")
    return inside.union(whole)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_runs(text: str, starts: list[int]) -> list[tuple[int, int]]:
    """Spans of the runs that windows of words from ``starts`` on make up; -1 is the whole text, if it is long enough."""
    if not starts:
        return []
    at = [m.span() for m in WORD.finditer(text)]
    if len(at) < MIN_RUN:
        return []
    if min(starts) < 0:
        return [(at[0][0], at[-1][1])]
    out: list[tuple[int, int]] = []
    for start in sorted(starts):
        a, b = at[start][0], at[start + MIN_RUN - 1][1]
        if out and a <= out[-1][1] + 1:
            out[-1] = out[-1][0], b
        else:
            out.append((a, b))
    return out


def joined_runs(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without white space around them; what only white space parts is one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        b = a + len(text[a:b].rstrip())
        a = b - len(text[a:b].lstrip())
        if out and (a <= out[-1][1] or text[out[-1][1]:a].isspace()):
            out[-1] = out[-1][0], max(b, out[-1][1])
        elif a < b:
            out.append((a, b))
    return out


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans; a line end before or after one stays."""
    out, done = [], 0
    for a, b in spans:
        before, after = a - len(text[:a].rstrip()), len(text) - b - len(text[b:].lstrip())
        if "\n" in text[b:b + after] and "\n" not in text[a - before:a] and a > before:
            a -= before
        elif before or not a:
            b += after
        out.append(text[done:a])
        done = b
    return "".join([*out, text[done:]]).strip()


def remove(text: str, gone: dict[int, int], starts: list[int] = ()) -> tuple[str, int]:
    """The text without what goes, and of how many paragraphs something went.

    That are the runs of paragraphs in ``gone`` (position: words) that are long enough, and of windows of words from
    ``starts`` on, with the paragraphs in ``gone`` that touch them.
    Paragraphs of fewer words than a shingle have no entry; between two that go they go along.
    """
    spans = paragraphs(text)
    exact = word_runs(text, list(starts))
    runs: list[list[int]] = []
    for pos in sorted(gone):
        if runs and all(len(words(text[a:b])) < SHINGLE for a, b in spans[runs[-1][-1] + 1:pos]):
            runs[-1].append(pos)
        else:
            runs.append([pos])
    near = [(spans[run[0]][0], spans[run[-1]][1]) for run in runs]
    enough = exact + [span for span, run in zip(near, runs) if sum(gone[p] for p in run) >= MIN_RUN]
    if not enough:
        return text, 0
    # A run holds one that is long enough, or it is too short.
    inner = {a for a, _ in joined_runs(text, enough)}
    drop = [(a, b) for a, b in joined_runs(text, exact + near) if any(a <= x < b for x in inner)]
    begins, touched, done = [a for a, _ in spans], 0, 0
    for a, b in drop:
        end = bisect_left(begins, b)
        touched += end - max(done, bisect_right(begins, a) - 1)
        done = end
    return without_spans(text, drop), touched


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` after removals, ``n_removed`` paragraphs and ``first_docs``, ids that keep the repeated ones."""
    keyed = docs.withColumns({"__doc_id": F.col("doc_id").cast("long"), "__text_key": F.xxhash64("text")})
    rows = keyed.select(F.col("__doc_id").alias("doc_id"), F.col("__text_key").alias("key"), plain_text().alias("text"))
    paragraph, window = F.struct("pos", "n_words", "first_doc"), F.struct("start", "first_doc")
    none = lambda column, like: F.when(F.lit(False), column).alias(like)
    texts = stage(first_texts(rows), "paragraph-texts")
    kept = Bloom(texts.select(F.xxhash64("first.doc_id", "key").alias("place")), bits=1 << 26)
    found, inside = repeated(rows, kept), passages(rows, kept, texts)
    kept.close()
    # A copy goes whole; what else holds passages of it is what holds those of the first text like it.
    held = found.select("key", "first_doc").union(inside.where("start >= 0").select("key", "first_doc")).distinct()
    copies = inside.where("start < 0").select("doc_id", "key")
    inside = inside.union(copies.join(held, "key").select("doc_id", "key", F.lit(-1).alias("start"), "first_doc"))
    found = found.select("doc_id", "key", paragraph.alias("p"), none(
        F.struct(F.lit(0).alias("start"), F.lit(0).cast("long").alias("first_doc")), "w"))
    inside = inside.select("doc_id", "key", none(F.struct(
        F.lit(0).alias("pos"), F.lit(0).alias("n_words"), F.lit(0).cast("long").alias("first_doc")), "p"), window.alias("w"))
    gone = stage(
        found.union(inside).groupBy("doc_id", "key").agg(
            F.collect_set("p").alias("gone"), F.collect_set("w").alias("windows")),
        "paragraph-gone",
    )
    unstage(texts)

    @F.pandas_udf("text string, n_removed int")
    def rewrite(texts: pd.Series, at: pd.Series, sizes: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out = [remove(t, dict(zip(p, n)), list(s)) for t, p, n, s in zip(texts, at, sizes, starts)]
        return pd.DataFrame(out, columns=["text", "n_removed"])

    # So a caller's filter on its columns stays above it: put below, it would cut each text up twice, by two workers a task.
    rewrite = rewrite.asNondeterministic()
    bloom = Bloom(gone.select("key"))
    # Names of its own for whatever joins the documents, so that no column of theirs clashes.
    gone = gone.withColumnsRenamed({c: f"__gone_{c}" for c in gone.columns})
    columns = [c for c in docs.columns if c.lower() not in {"n_removed", "first_docs"}]
    names = [F.col(f"`{c}`") for c in columns]
    may = keyed.withColumn("__text_may", bloom(F.col("__text_key")))
    # Shuffled however small, so that no task has two Python steps: workers are kept, and each takes 150 MB and more.
    hit = may.where("__text_may").join(
        gone.hint("merge"), F.col("__doc_id").eqNullSafe(F.col("__gone_doc_id")) & (F.col("__text_key") == F.col("__gone_key")), "left")
    changed = hit.where("__gone_gone IS NOT NULL").withColumn(
        "__text_new", rewrite("text", F.col("__gone_gone.pos"), F.col("__gone_gone.n_words"), F.col("__gone_windows.start"))
    ).select(
        *[F.col("__text_new.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in columns],
        F.col("__text_new.n_removed").alias("n_removed"),
        F.when(F.col("__text_new.n_removed") > 0, F.array_sort(
            F.array_union("__gone_gone.first_doc", "__gone_windows.first_doc")))
        .otherwise(F.array().cast("array<long>")).alias("first_docs"),
    )
    same = lambda df: df.select(
        *names, F.lit(0).alias("n_removed"), F.array().cast("array<long>").alias("first_docs"))
    return changed.union(same(hit.where("__gone_gone IS NULL"))).union(same(may.where("NOT __text_may")))

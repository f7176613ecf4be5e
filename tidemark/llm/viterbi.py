"""SentencePiece encoding and decoding by a max-plus parallel scan.

An encoding is the cut of a text into pieces of the model file with the highest sum of scores; of equal ones that whose
first different piece is longer. Scores are integers (``SCALE`` times the file's, rounded), so sums are exact in any
order. A character that no piece covers costs less than any piece and becomes its UTF-8 byte pieces; a literal U+2581
is such a character too, which makes decoding the exact inverse. Texts up to ``chunk`` characters are cut in one go.

Longer texts are split into chunks of that size. A boundary's state is the number of characters behind it that a piece
from before it takes. Three steps, each parallel over chunks:

1. a chunk gives its transfer matrix: entry (i, j) is the best score from entry state i to exit state j, less the score of
   what stands between its first and last forced cut, which all paths share;
2. the matrices of a document are combined by an associative max-plus scan, which gives the best score from each state of
   each boundary to the text's end;
3. with the scores at its exit a chunk traces its pieces for every entry state, and which exit state that leads to. The
   maps from entry to exit compose; the first chunk is entered in state 0, and that picks each chunk's trace.

No piece holds a space behind another character (if one does, texts are one stretch and chunks are traced in full), so
every path has a cut there, and what is between two such cuts is cut up alike wherever it stands: the different ones of
such stretches are cut once per ``AT_A_TIME`` characters of text, all at once, a step for each character from their ends
on. Within a chunk only the part before its first and behind its last such cut depends on the states. Stretches end as
well where a character meets one of another class: no piece holds characters of two classes, spaces apart, so "word" is
cut once and not again with each mark behind it.

Nulls and odd cases: a NULL text counts as empty and has no pieces; repeated rows come back each; a NULL id is kept;
extra columns are dropped; NULL ids decode to NULL; an unknown id raises.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import chunks, plain_text
from .pieces import SPACE, Pieces, default_model, pieces

CHUNK = 16_384
SCALE = 1024
PENALTY = 10  # what an unknown character costs more than the worst piece
UNUSABLE = -1e8  # pieces below are in the file for other uses
NEVER = -(1 << 62)
AT_ONCE = 200  # chunks made before they are passed on
AT_A_TIME = 1 << 21  # characters of text whose stretches are cut together
BLOCK = 1 << 14  # stretches in one table
SIDE = 64  # characters of a stretch in a table at most
EDGE = re.compile("[^ ] ")


def form_of(text: str) -> str:
    """The text behind the dummy prefix; empty stays empty."""
    return " " + text if text else ""


def stretch_pattern(usable: list[str]) -> re.Pattern:
    """What matches a text's stretches from end to end, for pieces that hold no space behind another character."""
    kin: dict[str, set[str]] = {}  # under each character its class: those that pieces hold next to it, and so on
    for text in usable:
        plain = set(text.lstrip(" "))
        for character in list(plain):
            plain |= kin.get(character, set())
        if len(text) > 1:
            kin.update(dict.fromkeys(plain, plain))
    classes = {frozenset(found) for found in kin.values() if found}
    runs = [f" *[{re.escape(''.join(sorted(found)))}]+" for found in sorted(classes, key=len, reverse=True)]
    return re.compile("|".join([*runs, " +", "[^ ]"]))


class Trie:
    """The pieces by their characters, as numbered states in a hash table that many places look up at once."""

    ROOT, BITS = 0, 21  # a character's number has 21 bits

    def __init__(self, ids: dict[str, int]) -> None:
        states: dict[tuple[int, str], int] = {}
        piece = [-1]
        for text, i in ids.items():
            at = self.ROOT
            for character in text:
                to = states.setdefault((at, character), len(piece))
                if to == len(piece):
                    piece.append(-1)
                at = to
            piece[at] = i
        self.piece = np.array(piece, dtype=np.int32)
        self.size = 1 << (4 * len(piece)).bit_length()
        self.keys = np.full(self.size, -1, dtype=np.int64)
        self.to = np.zeros(self.size, dtype=np.int32)
        keys = np.array([s << self.BITS | ord(c) for s, c in states], dtype=np.int64)
        for key, slot, to in zip(keys.tolist(), self.slots(keys).tolist(), states.values()):
            while self.keys[slot] >= 0:
                slot = (slot + 1) & (self.size - 1)
            self.keys[slot], self.to[slot] = key, to

    def slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(65 - self.size.bit_length())).astype(np.int64)

    def step(self, states: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The states that characters lead to, 0 where no piece goes on so."""
        keys = states.astype(np.int64) << self.BITS | characters
        slots = self.slots(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.to[slots], 0)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            slots[left] = (slots[left] + 1) & (self.size - 1)
            held = self.keys[slots[left]]
            hit = held == keys[left]
            out[left[hit]] = self.to[slots[left[hit]]]
            left = left[~hit & (held >= 0)]
        return out


class Segmenter:
    """Best cuts of short stretches; one per worker and model."""

    def __init__(self, path: str) -> None:
        self.table: Pieces = pieces(path)
        usable = {
            text: i for text, i in self.table.ids.items() if SPACE not in text and self.table.score[i] > UNUSABLE
        }
        self.pieces = {text: (i, round(self.table.score[i] * SCALE)) for text, i in usable.items()}
        self.longest = max(map(len, self.pieces), default=1)
        self.unknown = min((s for _, s in self.pieces.values()), default=0) - PENALTY * SCALE
        # The pieces by their characters: under each one what may follow, and the piece's id and score (None: no piece).
        self.root: dict[str, tuple[dict, int, int | None]] = {}
        for text, (piece, score) in self.pieces.items():
            node = self.root
            for character in text[:-1]:
                node = node.setdefault(character, ({}, -1, None))[0]
            node[text[-1]] = node.get(text[-1], ({}, -1, None))[0], piece, score
        # What each id counts; of a character's byte pieces the first one counts for it.
        self.worth = np.zeros(len(self.table.text), dtype=np.int64)
        for byte, i in self.table.byte_ids.items():
            self.worth[i] = 0 if byte & 0xC0 == 0x80 else self.unknown
        for piece, score in self.pieces.values():
            self.worth[piece] = score
        self.stretches = stretch_pattern(list(self.pieces)).findall if self.table.forced else lambda form: [form]
        self.trie = Trie(usable)

    def scores(self, text: str, ends: list[int], stop: int) -> tuple[list[int], list[tuple[int, int]]]:
        """Best score from each place of ``text`` to its end, and that cut's first piece: (length, id or -1).

        Pieces start before ``stop``; behind it, ``ends[j]`` is the score from place ``stop + j`` on.
        """
        root, unknown = self.root, self.unknown
        size = len(text)
        best = [NEVER] * stop + ends[:size - stop + 1]
        best += [NEVER] * (size + 1 - len(best))
        first = [(0, -1)] * stop
        for at in range(stop - 1, -1, -1):
            end = at + 1
            after = best[end]
            found = root.get(text[at])
            top, stay, pick = NEVER, 0, -1
            if found is None or found[2] is None:
                if after != NEVER:
                    top, stay = unknown + after, end
                if found is None:
                    best[at], first[at] = top, (stay - at, pick)
                    continue
            while True:
                node, piece, score = found
                if score is not None and after != NEVER and score + after >= top:
                    top, stay, pick = score + after, end, piece  # of equal ones the longest, which comes last
                if not node or end == size:
                    break
                found = node.get(text[end])
                if found is None:
                    break
                end += 1
                after = best[end]
            best[at], first[at] = top, (stay - at, pick)
        return best, first

    def trace(self, text: str, first: list[tuple[int, int]], at: int, stop: int) -> tuple[bytes, int]:
        """Ids from place ``at`` until behind ``stop``, and how far behind."""
        out: list[int] = []
        while at < stop:
            length, piece = first[at]
            if piece >= 0:
                out.append(piece)
            else:
                out += [self.table.byte_ids[b] for b in text[at].encode("utf-8", "surrogatepass")]
            at += length
        return array("i", out).tobytes(), at - stop

    def cut(self, stretch: str) -> bytes:
        """The ids of the best cut of a whole stretch."""
        _, first = self.scores(stretch, [0], len(stretch))
        return self.trace(stretch, first, 0, len(stretch))[0]

    def cuts(self, found: list[str]) -> dict[str, bytes]:
        """The ids of the best cut of each stretch; those with unknown characters in it one by one."""
        out: dict[str, bytes] = {}
        for at in range(0, len(found), BLOCK):
            some = sorted((s for s in found[at:at + BLOCK] if 0 < len(s) <= SIDE), key=len, reverse=True)
            if some:
                out.update(self.block(some))
        out.update((s, self.cut(s)) for s in found if s not in out)
        return out

    def block(self, found: list[str]) -> Iterator[tuple[str, bytes]]:
        """As ``cuts``, of stretches that get no longer; those with unknown characters in their cut are left out."""
        sizes = np.array([len(s) for s in found])
        ends = np.cumsum(sizes)
        text = np.frombuffer("".join(found).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        # held[n]: the piece of n characters from each place on, or -1
        held = [np.full(len(text), -1, dtype=np.int32) for _ in range(min(self.longest, sizes[0]) + 1)]
        place, states, stop = np.arange(len(text)), np.zeros(len(text), dtype=np.int32), np.repeat(ends, sizes)
        for n in range(1, len(held)):
            states = self.trie.step(states, text[place + n - 1])
            held[n][place] = self.trie.piece[states]
            on = np.flatnonzero((states > 0) & (stop[place] > place + n))
            place, states = place[on], states[on]
        # From the ends on: the best score from each place, the first piece of that cut and its length.
        count = sizes[0]
        best = np.zeros((count + 1, len(found)), dtype=np.int64)
        pick = np.full((count + 1, len(found)), -1, dtype=np.int32)
        length = np.ones((count + 1, len(found)), dtype=np.int32)
        for left in range(1, count + 1):
            some = int(np.searchsorted(-sizes, -left, side="right"))  # stretches of so many characters
            at = ends[:some] - left
            pick[left, :some] = held[1][at]
            one = np.where(held[1][at] >= 0, self.worth[held[1][at]], self.unknown)
            best[left, :some] = one + best[left - 1, :some]
            for n in range(2, min(left, len(held) - 1) + 1):
                piece = held[n][at]
                where = np.flatnonzero(piece >= 0)
                piece = piece[where]
                score = self.worth[piece] + best[left - n, where]
                better = score >= best[left, where]  # of equal ones the longest, which comes last
                where = where[better]
                best[left, where], pick[left, where], length[left, where] = score[better], piece[better], n
        left, columns, rows = sizes.copy(), [], []
        going = np.arange(len(found))
        while len(going):
            at = left[going], going
            columns.append(pick[at])
            rows.append(going)
            left[going] -= length[at]
            going = going[left[going] > 0]
        rows, ids = np.concatenate(rows), np.concatenate(columns)
        unknown = np.zeros(len(found), dtype=bool)
        unknown[rows[ids < 0]] = True
        ids = ids[np.argsort(rows, kind="stable")].tobytes()
        edges = np.concatenate([[0], np.cumsum(np.bincount(rows))]) * 4
        return (
            (s, ids[a:b]) for s, a, b, odd in zip(found, edges[:-1].tolist(), edges[1:].tolist(), unknown.tolist()) if not odd
        )

    def encode_all(self, forms: Iterable[str]) -> Iterator[tuple[bytes, int]]:
        """The ids of each form as 32-bit numbers, and their score."""
        parts: list[list[str]] = []
        size = 0
        for form in forms:
            parts.append(self.stretches(form))
            size += len(form)
            if size >= AT_A_TIME:
                yield from self.joined(parts)
                parts, size = [], 0
        yield from self.joined(parts)

    def joined(self, parts: list[list[str]]) -> Iterator[tuple[bytes, int]]:
        known = self.cuts(list(dict.fromkeys(chain.from_iterable(parts))))
        for found in parts:
            ids = b"".join(map(known.__getitem__, found))
            yield ids, int(self.worth[np.frombuffer(ids, np.int32)].sum())

    def encode(self, form: str) -> tuple[bytes, int]:
        return next(self.encode_all([form]))

    # One chunk of a long text: ``part`` is the chunk with the characters behind it that a piece may take.

    def inner(self, part: str, size: int) -> tuple[int, int]:
        """The first and last place of a chunk where every path has a cut; (-1, -1) if there is none."""
        if not self.table.forced:
            return -1, -1
        first = EDGE.search(part, 0, size)
        if first is None:
            return -1, -1
        last = part.rfind(" ", 1, size)
        while part[last - 1] == " ":
            last = part.rfind(" ", 1, last)
        return first.start() + 1, last

    def transfer(self, part: str, size: int) -> np.ndarray:
        """The matrix of best scores from entry states (rows) to exit states."""
        width = self.longest
        out = np.full((width, width), NEVER, dtype=np.int64)
        ahead = len(part) - size
        low, high = self.inner(part, size)
        if low >= 0:
            head, _ = self.scores(part[:low], [0], low)
            entries = np.array(head[:width] + [NEVER] * (width - len(head[:width])), dtype=np.int64)
        for j in range(min(width, ahead + 1)):
            ends = [NEVER] * j + [0] + [NEVER] * (ahead - j)
            if low >= 0:
                tail, _ = self.scores(part[high:], ends, size - high)
                out[:, j] = plus(entries, np.int64(tail[0]))
            else:
                best, _ = self.scores(part, ends, size)
                out[:min(width, len(best)), j] = best[:width]
        return out

    def middle(self, part: str, size: int) -> str:
        """What stands between the first and last place where every path has a cut."""
        low, high = self.inner(part, size)
        return part[low:high] if low >= 0 else ""

    def traces(
        self, part: str, size: int, ends: list[int], middle: tuple[bytes, int],
    ) -> tuple[list[bytes], list[int], bytes, int]:
        """For each entry state its own ids and the exit state; what follows for all: ids, and the score left out.

        ``middle`` is the cut of the chunk's middle.
        """
        low, high = self.inner(part, size)
        heads, exits, rest, between = [], [], b"", 0
        width = self.longest
        if low >= 0:
            best, first = self.scores(part[:low], [0], low)
            tail_best, tail = self.scores(part[high:], ends, size - high)
            last, leaving = self.trace(part[high:], tail, 0, size - high)
            rest, between = middle
            rest += last
            stop = low
        else:
            best, first = self.scores(part, ends, size)
            leaving, stop = 0, size
        for i in range(width):
            if i >= len(best) or best[i] == NEVER:
                heads.append(b"")
                exits.append(-1)
            elif i >= stop and low < 0:
                heads.append(b"")
                exits.append(i - stop)  # the piece that enters takes the whole chunk
            else:
                ids, over = self.trace(part, first, i, stop)
                heads.append(ids)
                exits.append(leaving if low >= 0 else over)
        return heads, exits, rest, between


@lru_cache(maxsize=2)
def segmenter(path: str) -> Segmenter:
    return Segmenter(path)


def plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where((a == NEVER) | (b == NEVER), NEVER, a + b)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus products of stacks of matrices."""
    out = np.full(np.broadcast_shapes(a.shape, b.shape), NEVER, dtype=np.int64)
    for k in range(a.shape[-1]):
        out = np.maximum(out, plus(a[..., :, k, None], b[..., None, k, :]))
    return out


def suffixes(matrices: np.ndarray) -> np.ndarray:
    """For each chunk the product of its matrix and all that follow: an associative scan in log2 rounds."""
    out, step = matrices.copy(), 1
    while step < len(out):
        out = np.concatenate([product(out[:-step], out[step:]), out[-step:]])
        step *= 2
    return out


def split(form: str, chunk: int, longest: int) -> Iterator[tuple[int, str, int]]:
    """(number, text with what a piece may take behind it, size) of each chunk."""
    for k, start in enumerate(range(0, len(form), chunk)):
        size = min(chunk, len(form) - start)
        yield k, form[start:start + size + longest - 1], size


def encode_long(rows: DataFrame, model: str, chunk: int) -> DataFrame:
    """(doc_id, key, ids, score, back) of the different rows of ``rows (doc_id, key, text)``."""
    keys = ["doc_id", "key"]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        longest = segmenter(model).longest
        for frame in frames:
            rows = (
                (doc, key, k, part, size) for doc, key, text in zip(frame.doc_id, frame.key, frame.text)
                for k, part, size in split(form_of(text), chunk, longest)
            )
            for some in chunks(rows, AT_ONCE):
                yield pd.DataFrame(some, columns=["doc_id", "key", "k", "part", "size"]).astype({"doc_id": "Int64"})

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = segmenter(model)
        for frame in frames:
            frame["matrix"] = [worker.transfer(p, s).tobytes() for p, s in zip(frame.part, frame["size"])]
            yield frame[["doc_id", "key", "k", "matrix"]].astype({"doc_id": "Int64"})

    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("k").sort_values("k").reset_index(drop=True)
        width = segmenter(model).longest
        matrices = np.stack([np.frombuffer(m, np.int64).reshape(width, width) for m in frame.matrix])
        # Behind the text only state 0 is left; each chunk gets the scores behind it.
        after = suffixes(matrices)[:, :, 0]
        end = np.array([[0] + [NEVER] * (width - 1)], dtype=np.int64)
        frame["ends"] = list(np.concatenate([after[1:], end]))
        frame["score"] = int(after[0, 0])
        return frame[["doc_id", "key", "k", "ends", "score"]].astype({"doc_id": "Int64"})

    def second(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        worker = segmenter(model)
        for frame in frames:
            middles = worker.encode_all(worker.middle(p, s) for p, s in zip(frame.part, frame["size"]))
            out = [
                worker.traces(p, s, list(map(int, e)), m)
                for p, s, e, m in zip(frame.part, frame["size"], frame.ends, middles)
            ]
            frame["heads"], frame["exits"], frame["rest"], frame["between"] = ([x[i] for x in out] for i in range(4))
            yield frame[["doc_id", "key", "k", "score", "heads", "exits", "rest", "between"]].astype({"doc_id": "Int64"})

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("k").sort_values("k")
        state, out = 0, []
        for heads, exits, rest in zip(frame.heads, frame.exits, frame.rest):
            # A piece that took the whole chunk left nothing of it to trace.
            out.append(heads[state] + rest)
            state = exits[state]
        ids = np.frombuffer(b"".join(out), np.int32)
        return pd.DataFrame({
            "doc_id": frame.doc_id.iloc[:1], "key": frame.key.iloc[:1], "ids": [ids],
            "score": frame.score.iloc[:1] + frame.between.sum(), "back": [text_hash(decoded(ids, surfaces(model)))],
        }).astype({"doc_id": "Int64"})

    parts = rows.mapInPandas(cut, "doc_id long, key long, k int, part string, size int").repartition("doc_id", "key", "k")
    ends = parts.mapInPandas(first, "doc_id long, key long, k int, matrix binary").groupBy(*keys).applyInPandas(
        scan, "doc_id long, key long, k int, ends array<long>, score long").withColumnsRenamed(
        {"doc_id": "d", "key": "e", "k": "n"})
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("e")) & (F.col("k") == F.col("n"))
    # Shuffled however small, so that no task has two Python steps, which are a worker process each.
    return parts.join(ends.hint("merge"), same).select("doc_id", "key", "k", "part", "size", "ends", "score").mapInPandas(
        second, "doc_id long, key long, k int, score long, heads array<binary>, exits array<int>, rest binary, between long"
    ).groupBy(*keys).applyInPandas(join, "doc_id long, key long, ids array<int>, score long, back long")


def encode(docs: DataFrame, model: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, key, ids, score, back) of every row of ``docs (doc_id, text)``.

    ``key`` is the text's xxhash64 and ``back`` that of the text the ids decode to, made where the ids are at hand.
    """
    model = model or default_model()
    rows = docs.select(F.col("doc_id").cast("long"), plain_text().alias("text")).withColumn("key", F.xxhash64("text"))

    @F.pandas_udf("ids array<int>, score long, back long")
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        worker = segmenter(model)
        for texts in batches:
            out = list(worker.encode_all(map(form_of, texts)))
            ids = [np.frombuffer(i, np.int32) for i, _ in out]
            yield pd.DataFrame({
                "ids": ids, "score": [s for _, s in out],
                "back": [text_hash(decoded(i, surfaces(model))) for i in ids],
            })

    short = rows.where(F.length("text") < chunk).withColumn("cut", whole("text")).select(
        "doc_id", "key", F.col("cut.ids").alias("ids"), F.col("cut.score").alias("score"),
        F.col("cut.back").alias("back"))
    long = rows.where(F.length("text") >= chunk)
    found = encode_long(long, model, chunk).withColumnsRenamed({"doc_id": "d", "key": "e"})
    long = long.select("doc_id", "key")
    return short.union(
        long.join(found, long.doc_id.eqNullSafe(found.d) & (long.key == found.e)).select(
            "doc_id", "key", "ids", "score", "back"))


@lru_cache(maxsize=2)
def surfaces(path: str) -> list[bytes]:
    """What each id writes."""
    table = pieces(path)
    out = [text.replace(SPACE, " ").encode() for text in table.text]
    for byte, i in table.byte_ids.items():
        out[i] = bytes([byte])
    return out


def decoded(ids: np.ndarray, table: list[bytes]) -> bytes:
    """What ids write, without the dummy prefix."""
    return b"".join(map(table.__getitem__, ids.tolist()))[1:]


def text_hash(data: bytes) -> int:
    """Spark's xxhash64 of a text."""
    value = xxh64_intdigest(data, 42)
    return value - (1 << 64) if value >> 63 else value


def decode(rows: DataFrame, model: str | None = None, ids: str = "ids") -> DataFrame:
    """``rows`` with a column ``decoded``: the text of an array of ids."""
    model = model or default_model()

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = surfaces(model)
        for batch in batches:
            yield pd.Series([
                None if i is None else decoded(i, table).decode("utf-8", "replace") for i in batch
            ], dtype=object)

    return rows.withColumn("decoded", text(F.col(ids)))

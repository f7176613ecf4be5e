"""Token counts of whole texts, huge documents included, as the SentencePiece library gives them.

A document of more than ``chunk`` characters is cut into chunks that overlap their neighbours by ``overlap`` characters
on both sides. Chunks are shuffled, so one document keeps many tasks busy, and each is encoded with the offset of every
token. Neighbours are spliced at an offset in their shared stretch of text that ends a token in both encodings and is
proven stable: it stands between a non-space and a space, which no piece of the vocabulary spans, so no merge on one
side depends on the other. Where the overlap holds no such offset the document comes again with a wider overlap, in the
end as one chunk. A vocabulary that does span such places has no proven boundary, so its documents stay whole.

Encoding itself goes stretch by stretch between stable boundaries and remembers the last million stretches; each new
one is encoded by the library.

Nulls and odd cases: a NULL text counts as empty, with 0 tokens; repeated rows are counted each; a NULL id is kept;
extra columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain_text, stage
from .pieces import BYTE, SPACE, Pieces, default_model, normal_form, pieces, stretches

CHUNK = 16_384
OVERLAP = 256
WIDEN = 4
MEMO = 1 << 20


class Encoder:
    """Counts and offsets of tokens; one per worker and model."""

    # A space at the end of a text, which the library would not put back in front of nothing.
    ALONE = {" ": 1}

    def __init__(self, path: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.table: Pieces = pieces(path)
        self.memo: dict[str, int] = dict(self.ALONE)
        # Characters a token adds: a byte token adds one where it starts a character, else none.
        self.width = [len(t) for t in self.table.text]
        for byte, i in self.table.byte_ids.items():
            self.width[i] = 0 if 0x80 <= byte < 0xC0 else 1

    def count(self, form: str) -> int:
        """Tokens of a text in normal form."""
        if not self.table.forced:
            return len(self.library.encode(form[1:], num_threads=1))
        memo, parts = self.memo, stretches(form)
        try:
            return sum([memo[part] for part in parts])
        except KeyError:
            new = list({part for part in parts if part not in memo})
        if len(memo) + len(new) > MEMO:
            memo.clear()
            memo.update(self.ALONE)
            new = list(set(parts) - memo.keys())
        # The library puts a stretch's first space back itself.
        memo.update(zip(new, map(len, self.library.encode([part[1:] for part in new], num_threads=1))))
        return sum([memo[part] for part in parts])

    def offsets(self, form: str) -> list[int]:
        """Where each token of a text in normal form ends, in characters."""
        ends, at = [], 0
        for token in self.library.encode(form[1:], num_threads=1):
            at += self.width[token]
            ends.append(at)
        return ends


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def stable(form: str, at: int) -> bool:
    return 0 < at < len(form) and form[at] == " " != form[at - 1]


def windows(form: str, chunk: int, overlap: int) -> Iterator[tuple[int, int, str]]:
    """(number, start, text) of the overlapping chunks; a single one if the overlap spans the text."""
    if overlap >= len(form):
        yield 0, 0, form
        return
    for k, start in enumerate(range(0, len(form), chunk)):
        low = max(0, start - overlap)
        yield k, low, form[low:start + chunk + overlap]


def marks(enc: Encoder, part: str, start: int, core: int, chunk: int, overlap: int) -> tuple[int, list, list]:
    """Tokens of a chunk, and (offset, tokens before it) of its stable token ends around its two edges.

    A chunk that starts inside the text is encoded behind a space it does not have; the tokens up to the first stable
    offset may therefore be wrong and are never spliced at, nor is anything before that offset.
    """
    ends = enc.offsets((" " + part) if start else part)
    shift = start - 1 if start else 0
    last = {end: n for n, end in enumerate(ends, 1)}
    offsets = [(end + shift, n) for end, n in last.items() if stable(part, end + shift - start)]
    left = [x for x in offsets if core - overlap <= x[0] < core + overlap]
    right = [x for x in offsets if core + chunk - overlap <= x[0] < core + chunk + overlap]
    return len(ends), left, right


def splice(frame: pd.DataFrame) -> int | None:
    """Tokens of one document from the rows of its chunks; None where two chunks share no stable offset."""
    frame = frame.drop_duplicates("k").sort_values("k")
    total, before = 0, 0
    rows = list(zip(frame.n, frame.left_at, frame.left_n, frame.right_at, frame.right_n))
    for (n, _, _, at, number), following in zip(rows, rows[1:] + [None]):
        if following is None:
            return total + n - before
        after = dict(zip(following[1], following[2]))
        common = [(offset, count) for offset, count in zip(at, number) if offset in after and count >= before]
        if not common:
            return None
        offset, count = common[len(common) // 2]  # in the middle, far from either edge
        total += count - before
        before = after[offset]
    return total


def count_long(docs: DataFrame, model: str, chunk: int, overlap: int) -> DataFrame:
    """(doc_id, key, n_bytes, n_tokens) of ``docs (doc_id, key, text)``; n_tokens NULL where the overlap is too small."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forced = pieces(model).forced
        for frame in frames:
            for doc, key, size, text in zip(frame.doc_id, frame.key, frame.n_bytes, frame.text):
                form = normal_form(text)
                for k, low, part in windows(form, chunk, overlap if forced else len(form)):
                    yield pd.DataFrame({"doc_id": [doc], "key": [key], "n_bytes": [size], "k": [k], "low": [low],
                                        "part": [part]}).astype({"doc_id": "Int64"})

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(model)
        for frame in frames:
            out = []
            for k, low, part in zip(frame.k, frame.low, frame.part):
                n, left, right = marks(enc, part, low, k * chunk, chunk, overlap)
                out.append((n, *([x[i] for x in side] for side in (left, right) for i in (0, 1))))
            yield pd.concat([
                frame[["doc_id", "key", "n_bytes", "k"]].astype({"doc_id": "Int64"}),
                pd.DataFrame(out, columns=["n", "left_at", "left_n", "right_at", "right_n"], index=frame.index),
            ], axis=1)

    def join(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        copies = int((frame.k == 0).sum())  # rows repeated in the table
        return pd.DataFrame({
            "doc_id": [frame.doc_id.iloc[0]] * copies, "key": frame.key.iloc[0], "n_bytes": frame.n_bytes.iloc[0],
            "n_tokens": pd.array([splice(frame)] * copies, dtype="Int64"),
        }).astype({"doc_id": "Int64"})

    return (
        docs.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), "text")
        .mapInPandas(cut, "doc_id long, key long, n_bytes long, k int, low long, part string")
        .repartition("key", "k")
        .mapInPandas(encode, "doc_id long, key long, n_bytes long, k int, n long, left_at array<long>, "
                             "left_n array<long>, right_at array<long>, right_n array<long>")
        .groupBy("doc_id", "key")
        .applyInPandas(join, "doc_id long, key long, n_bytes long, n_tokens long")
    )


def token_counts(
    docs: DataFrame, model: str | None = None, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs (doc_id, text)``."""
    model = model or default_model()
    rows = docs.select(F.col("doc_id").cast("long"), plain_text().alias("text"))

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(model)
        for texts in batches:
            yield pd.Series([enc.count(normal_form(text)) for text in texts], dtype="int64")

    size = F.octet_length("text").cast("long")
    done = rows.where(F.length("text") <= chunk).select("doc_id", size.alias("n_bytes"), count("text").alias("n_tokens"))
    todo = rows.where(F.length("text") > chunk).withColumn("key", F.xxhash64("text"))
    while True:
        found = stage(count_long(todo, model, chunk, overlap), "token-counts")
        done = done.union(found.where("n_tokens IS NOT NULL").select("doc_id", "n_bytes", "n_tokens"))
        failed = found.where("n_tokens IS NULL")
        if failed.isEmpty():
            break
        again = failed.select("doc_id", "key").distinct()
        todo = todo.join(again, todo.doc_id.eqNullSafe(again.doc_id) & (todo.key == again.key), "left_semi")
        overlap *= WIDEN
    return done.withColumn("over_limit", F.col("n_tokens") > limit)

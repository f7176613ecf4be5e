"""Scores of whole texts under an n-gram model held as a weighted backoff automaton.

Tokens are words (A-Z lower-cased) and one end per text. The model is an n-gram model with Dirichlet smoothing at every
order: p(w | c) = (n(c w) + K p(w | c')) / (n(c) + K), c' the context without its first token; below the unigrams stands
add-one over the vocabulary and one unknown token. A seen context is a state, a seen n-gram an arc to its longest known
suffix with weight log10 p(w | c), and each state has a failure arc to c' with weight log10 K / (n(c) + K). A traversal
carries its state from left to right, follows failure arcs until an arc for the token exists, and adds the weights up.

The automaton of a large corpus fits into no task. Texts are dealt out to blocks of a bounded size; a block asks for the
counts of just the n-grams it holds, which gives it the part of the automaton its traversals can reach. A block's
n-grams are 64-bit keys, summed up within the block before they are shuffled; hash ranges of keys are added up over all
blocks, and only totals go back, in the order asked. So a frequent n-gram is one number per block, wherever it occurs.
Very long texts come in pieces that carry the tokens before them as their state.

Nulls and odd cases: a NULL text counts as empty, whose one token is the end; a NULL id is learnt from; repeated rows are
learnt from and scored each; without training texts every token has probability 1 / (0 + 0 + 1); extra columns go.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import held_out, plain_text, words

ORDER = 2
STRENGTH = 100.0  # K
BLOCK = 8 << 20  # bytes of text in a block, on average
PIECE = 1 << 20  # characters of a text in one piece
BUCKET = 4 << 20  # bytes of text per hash range
MIX = np.uint64(0x9E3779B97F4A7C15)
TURN = np.uint64(29)
SPACE = re.compile(r"[ \t\n\v\f\r]+")
START, END = (xxh64_intdigest(name, 7) for name in (b"start of text", b"end of text"))
MEMO = 1 << 20  # words a task remembers, and tokens it counts at once


class Words:
    """Hashes of a text's tokens; words cannot collide with START and END but by chance."""

    def __init__(self) -> None:
        self.memo: dict[bytes, int] = {}

    def tokens(self, text: str, last: bool) -> list[int]:
        memo, out = self.memo, []
        if len(memo) > MEMO:
            memo.clear()
        for word in words(text):
            code = memo.get(word)
            if code is None:
                code = memo[word] = xxh64_intdigest(word)
            out.append(code)
        if last:
            out.append(END)
        return out


def longer(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Key of an n-gram from the key of its context and its last token."""
    mixed = (context ^ (context >> TURN)) * MIX
    return (mixed ^ token) * MIX + token


def grams(tokens: np.ndarray, before: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams of each order that end at each token; ``before`` are the order - 1 tokens ahead."""
    whole = np.concatenate([before, tokens])
    out = [tokens]
    for n in range(2, order + 1):
        key = whole[len(before) - n + 1:len(whole) - n + 1]
        for k in range(n - 2, -1, -1):
            key = longer(key, whole[len(before) - k:len(whole) - k])
        out.append(key)
    return out


def split(text: str, order: int, size: int) -> Iterator[tuple[int, bool, str, str]]:
    """(number, is last, words before, piece): cut behind white space, never within a word."""
    at = number = 0
    before = ""
    while True:
        stop = len(text) if at + size >= len(text) else at + size
        while stop < len(text) and text[stop] not in " \t\n\v\f\r":
            stop += 1
        piece = text[at:stop]
        yield number, stop >= len(text), before, piece
        if stop >= len(text):
            return
        said = [w for w in SPACE.split(before + " " + piece) if w]
        before = " ".join(said[-(order - 1):]) if order > 1 else ""
        at, number = stop, number + 1


class Block:
    """The n-gram keys of a block's pieces, in the order of ``frame``."""

    def __init__(self, frame: pd.DataFrame, order: int) -> None:
        reader = Words()
        self.order = order
        self.sizes: list[int] = []  # tokens of each piece
        self.starts: list[bool] = []  # whether a piece is a text's first
        keys, learnt = [np.empty(0, np.uint64)], [np.empty(0, bool)]
        start = np.array([START] * (order - 1), dtype=np.uint64)
        for text, last, before, train in zip(frame.piece, frame["last"], frame.before, frame.train):
            tokens = np.array(reader.tokens(text, last), dtype=np.uint64)
            ahead = np.array(reader.tokens(before, False), dtype=np.uint64)
            self.sizes.append(len(tokens))
            self.starts.append(not before)
            # The contexts of the first token, asked for but not counted, then the n-grams of each order.
            contexts = [g[-1:] for g in grams(ahead, start, order)[:order - 1]] if before else [start]
            parts = grams(tokens, np.concatenate([start, ahead])[len(ahead):], order)
            keys += contexts + parts
            learnt += [np.zeros(order - 1, bool), np.full(order * len(tokens), bool(train))]
        self.keys, self.which = np.unique(np.concatenate(keys), return_inverse=True)
        self.counts = np.bincount(self.which[np.concatenate(learnt)], minlength=len(self.keys))

    def totals(self, total: np.ndarray) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
        """For each piece: is it a first one, the counts of its first contexts, its n-grams' counts by order."""
        found, at = total[self.which], 0
        for first, size in zip(self.starts, self.sizes):
            here = found[at:at + self.order - 1]
            at += self.order - 1
            yield first, here, found[at:at + self.order * size].reshape(self.order, size)
            at += self.order * size


def pack(values: np.ndarray) -> bytes:
    """Numbers as planes of their bytes; shuffles compress the planes that are all but constant."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unpack(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each hash range begins in sorted keys."""
    edges = np.array([(b << 64) // buckets for b in range(buckets)], dtype=np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def score_texts(
    docs: DataFrame, order: int = ORDER, strength: float = STRENGTH, folds: int = 7, block: int = BLOCK,
    piece: int = PIECE, bucket: int = BUCKET,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``."""
    rows = docs.select(
        F.col("doc_id").cast("long"), held_out("doc_id", folds).alias("held_out"), plain_text().alias("text"))
    parallel = docs.sparkSession.sparkContext.defaultParallelism
    volume = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("v")).first().v or 0
    blocks, buckets = max(parallel, math.ceil(volume / block)), max(1, math.ceil(volume / bucket))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Words()

        def summed(parts: list[np.ndarray]) -> pd.DataFrame:
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            return pd.DataFrame({"key": keys.view(np.int64), "n": counts})

        parts, size = [], 0
        for frame in frames:
            for text in frame.text:
                parts.append(np.array(reader.tokens(text, True), dtype=np.uint64))
                size += len(parts[-1])
                if size > MEMO:
                    yield summed(parts)
                    parts, size = [], 0
        if parts:
            yield summed(parts)

    # Numbers of the whole training set: tokens, different tokens, texts.
    whole = (
        rows.where(~F.col("held_out")).select("text").mapInPandas(count, "key long, n long")
        .groupBy("key").agg(F.sum("n").alias("n"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("v"),
             F.sum(F.when(F.col("key") == int(np.uint64(END).astype(np.int64)), F.col("n"))).alias("texts")).first()
    )
    n, v, texts = whole.n or 0, whole.v, whole.texts or 0

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [
                (row, doc, held, not held, last, before, part, (row * 1_000_003 + number) % blocks)
                for row, doc, held, text in zip(frame.row, frame.doc_id, frame.held_out, frame.text)
                for number, last, before, part in split(text, order, piece)
            ]
            yield pd.DataFrame(
                out, columns=["row", "doc_id", "held_out", "train", "last", "before", "piece", "block"],
            ).astype({"doc_id": "Int64"})

    # Row numbers only tell rows apart; a scan gives the same ones again when it is repeated.
    dealt = rows.withColumn("row", F.monotonically_increasing_id()).mapInPandas(
        cut, "row long, doc_id long, held_out boolean, train boolean, last boolean, before string, piece string, block int"
    ).repartition(blocks, "block")

    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        here = Block(frame, order)
        at = bounds(here.keys, buckets)
        steps = np.diff(here.keys, prepend=np.uint64(0))
        steps[at[:-1][at[:-1] < len(steps)]] = here.keys[at[:-1][at[:-1] < len(steps)]]  # each range starts anew
        return pd.DataFrame([
            (int(frame.block.iloc[0]), b, pack(steps[i:j]), pack(here.counts[i:j].astype(np.uint32)))
            for b, (i, j) in enumerate(zip(at, at[1:])) if i < j
        ], columns=["block", "bucket", "steps", "counts"])

    def add_up(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unpack(k, np.uint64)) for k in frame.steps]
        counts = np.concatenate([unpack(c, np.uint32) for c in frame.counts])
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, weights=counts).astype(np.uint64)[which]
        ends = np.cumsum([len(k) for k in keys])
        return pd.DataFrame({
            "block": frame.block, "bucket": frame.bucket, "totals": [pack(t) for t in np.split(total, ends[:-1])]})

    def traverse(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        here = Block(frame, order)
        answers = answers.sort_values("bucket")
        total = np.concatenate([np.empty(0, np.uint64), *[unpack(t, np.uint64) for t in answers.totals]])
        out = [
            (row, doc, held, counts.shape[1], int((counts[0] > 0).sum()), *walk(first, contexts, counts, strength, texts, n + v + 1))
            for row, doc, held, (first, contexts, counts) in zip(
                frame.row, frame.doc_id, frame.held_out, here.totals(total.astype(np.int64)))
        ]
        return pd.DataFrame(
            out, columns=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
        ).astype({"doc_id": "Int64"})

    answers = (
        dealt.groupBy("block").applyInPandas(ask, "block int, bucket int, steps binary, counts binary")
        .groupBy("bucket").applyInPandas(add_up, "block int, bucket int, totals binary")
    )
    pieces = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        traverse, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return pieces.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        F.sum("base_score").alias("base_score"), F.sum("score").alias("score"),
    ).drop("row")


def walk(
    first: bool, contexts: np.ndarray, counts: np.ndarray, strength: float, texts: int, below: int,
) -> tuple[float, float]:
    """(base score, score) of one piece.

    ``counts[k]`` are the counts of the (k+1)-grams that end at each token, ``contexts`` those of the contexts of the
    first token by length; at the start of a text that is the start itself, followed as often as there are texts.
    """
    order, size = counts.shape
    base = np.log10(counts[0] + 1.0) - math.log10(below)
    arcs = [base.tolist()]  # weight of the arc from the state of each length; NaN where there is none
    fails = [[]]
    p = base
    states = np.zeros(size, dtype=np.int64)  # the longest known context ahead of each token
    for k in range(1, order):
        follow = np.concatenate([[texts if first else contexts[k - 1]], counts[k - 1][:-1]])[:size].astype(np.float64)
        states = np.where((follow > 0) & (states == k - 1), k, states)
        seen = (follow > 0) & (counts[k] > 0)
        arc = np.log10((counts[k] + strength * 10.0 ** p) / (follow + strength))
        fail = np.log10(strength / (follow + strength))
        arcs.append(np.where(seen, arc, np.nan).tolist())
        fails.append(fail.tolist())
        p = np.where(seen, arc, np.where(follow > 0, p + fail, p))
    ahead = states.tolist()
    score = 0.0
    for at in range(size):
        state, weight = ahead[at], 0.0
        while arcs[state][at] != arcs[state][at]:  # no arc for the token: follow the failure arc
            weight += fails[state][at]
            state -= 1
        score += weight + arcs[state][at]
    return float(base.sum()), score

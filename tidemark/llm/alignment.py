"""Cross-tokenizer alignment: where two tokenizers cut a text alike, by galloping intersection of their token ends.

Every text is encoded by A (byte-level BPE, on a space and the text) and B (pieces, which add the space). Of the two
ascending lists of byte offsets where tokens end, the shorter drives: each of its ends is searched in the longer by steps
of 1, 2, 4, ... from where the last search stopped, then by bisection of the last step. Ends found are common and slice
the tokens into groups; where the rank of one end differs from the rank of the next by more than one, a token overlaps
all tokens of the range between. Texts are taken many at a time: their lists lie end to end, cut into runs of ``RUN`` ends
that gallop side by side.

1. Texts are dealt to blocks of ``BLOCK`` bytes in the tasks that read them. A block is one row: per text the numbers, the
   groups' hash and its links as places in the block's list of different id pairs.
2. Each block's pairs are summed up over the corpus; a B id's highest count is a maximum over its pairs.
3. A block is handed the counts of its own pairs, in its order, and adds them up text by text.

Rows exchanged are the different pairs of every block and the blocks, so they grow as the input does; nothing is joined per
link. A block holds at least one whole text, however long.

Encoding is remembered by pre-token (A) and by stretch between spaces (B), which both libraries never merge across; a text
with characters whose class may differ between Unicode versions is given to A's library whole. Texts that are NULL or
empty, or that some token list does not give back byte by byte, have no tokens: zeros, and an empty hash. Rows that repeat
come back and count each; a NULL id is kept; extra columns go; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
import unicodedata
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain_text, stage
from .pieces import SPACE, default_model, stretches

BLOCK = 2 << 20  # bytes of text
BATCH = 1 << 18  # bytes of text aligned at once
RUN = 64
MEMO = 1 << 18  # remembered pieces, and their characters by 2^5
IDS = 1 << 16  # more than either vocabulary holds
# How A's pre-tokens end: the fixed pattern of its file format's byte-level splitting, with what Unicode calls white space.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
# The same where all numbers are decimal digits.
PLAIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^{WHITE}\w]|_)+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


def default_bytes() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The byte that a letter of a byte-level vocabulary stands for: printable Latin-1 itself, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + k): b for k, b in enumerate(others)}}


class Kinds(dict):
    """Of a character: 0 if it is plain, 1 if it is a number but no digit, 2 if versions of Unicode may class it differently."""

    def __missing__(self, letter: str) -> int:
        now, old = unicodedata.category(letter), unicodedata.ucd_3_2_0.category(letter)
        doubt = now == "Cn" or (now[0] != old[0] and (now[0] in "LNZ" or old[0] in "LNZ"))
        self[letter] = 2 if doubt else 1 if now in ("No", "Nl") else 0
        return self[letter]


KINDS = Kinds()


def pre_tokens(form: str) -> list[str]:
    kind = 0 if form.isascii() else max(map(KINDS.__getitem__, set(form)))
    return PLAIN.findall(form) if kind == 0 else PATTERN.findall(form) if kind == 1 else [form]


class Places(dict):
    """Places of pieces, in the order in which they came; ``new`` are those that were not known."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        place = self[part] = len(self)
        self.new.append(part)
        return place


class Tokens:
    """Token ids and byte lengths of pieces of text, remembered; ``give`` encodes pieces to all their ids and a count each."""

    def __init__(self, give: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], of: list[bytes]) -> None:
        self.give, self.of = give, of
        self.width = np.array([len(b) for b in of], dtype=np.int64)
        self.clear()

    def clear(self) -> None:
        self.memo = Places()
        self.letters = 0
        self.ids = np.empty(0, dtype=np.int64)
        self.start = np.empty(0, dtype=np.int64)
        self.count = np.empty(0, dtype=np.int64)
        self.whole = np.empty(0, dtype=bool)
        self.used = np.empty(0, dtype=np.int64)

    def trim(self) -> None:
        """Forget all but the pieces that were used most, half as many as may be remembered."""
        parts = list(self.memo)
        kept = np.sort(np.argsort(-self.used, kind="stable")[:MEMO // 2])
        kept = kept[self.used[kept] > 1]
        ids, count, whole, used = self.spread(kept), self.count[kept], self.whole[kept], self.used[kept]
        self.clear()
        for k in kept.tolist():
            if self.letters > MEMO << 4:
                break
            self.memo[parts[k]] = len(self.memo)
            self.letters += len(parts[k])
        left = len(self.memo)
        self.count, self.whole, self.used = count[:left], whole[:left], used[:left] >> 1  # what is used no more goes in time
        self.start = np.cumsum(self.count) - self.count
        self.ids = ids[:self.count.sum()]

    def __call__(self, parts: list[str]) -> np.ndarray:
        """The pieces' places."""
        if len(self.memo) > MEMO or self.letters > MEMO << 5:
            self.trim()
        places = np.fromiter(map(self.memo.__getitem__, parts), dtype=np.int64, count=len(parts))
        new = self.memo.new
        if new:
            self.memo.new = []
            self.letters += sum(map(len, new))
            ids, count = self.give(new)
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.ids = np.concatenate([self.ids, ids])
            self.whole = np.concatenate([self.whole, self.faithful(new, ids, count)])
            self.used = np.concatenate([self.used, np.zeros(len(new), dtype=np.int64)])
        self.used += np.bincount(places, minlength=len(self.used))
        return places

    def faithful(self, parts: list[str], ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Whether the tokens' bytes are those of the piece."""
        given = list(map(self.of.__getitem__, ids.tolist()))
        # All at once; one by one only if they differ.
        sizes = np.fromiter((len(part.encode()) for part in parts), dtype=np.int64, count=len(parts))
        ends = np.cumsum(count)
        total = np.concatenate([[0], np.cumsum(self.width[ids])])
        if b"".join(given) == "".join(parts).encode() and (total[ends] - total[ends - count] == sizes).all():
            return np.ones(len(parts), dtype=bool)
        return np.array([b"".join(given[e - n:e]) == p.encode() for e, n, p in zip(ends.tolist(), count.tolist(), parts)], dtype=bool)

    def spread(self, places: np.ndarray) -> np.ndarray:
        """The ids of the pieces, one after the other."""
        count = self.count[places]
        return self.ids[np.repeat(self.start[places] - np.cumsum(count) + count, count) + np.arange(count.sum())]


@lru_cache(maxsize=1)
def both(bytes_file: str, pieces_file: str) -> tuple[Tokens, Tokens]:
    import sentencepiece
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    a = Tokenizer.from_file(bytes_file)
    a.encode_special_tokens = True
    letters = byte_letters()
    of_a = [b""] * (max(a.get_vocab().values()) + 1)
    for entry, i in a.get_vocab(with_added_tokens=False).items():
        of_a[i] = bytes(letters[c] for c in entry)

    b = sentencepiece.SentencePieceProcessor(model_file=pieces_file)
    of_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace(SPACE, " ").encode()
            for i in range(b.get_piece_size())]
    alone = b.encode("a ", num_threads=1)[len(b.encode("a", num_threads=1)):]

    def give_b(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # The library puts a stretch's first space back itself, though not before nothing.
        found = [alone if part == " " else ids for part, ids in zip(parts, b.encode([p[1:] for p in parts], num_threads=1))]
        count = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return np.fromiter(chain.from_iterable(found), dtype=np.int64, count=count.sum()), count

    def give_a(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = a.encode(parts, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, dtype=np.int64), np.bincount(found.word_ids, minlength=len(parts))

    return Tokens(give_a, of_a), Tokens(give_b, of_b)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of the ascending ``short`` the place of the first of the ascending ``long`` that is not less.

    No value of ``short`` is above the last of ``long``. Runs of ``RUN`` values go side by side.
    """
    n = len(short)
    runs = -(-n // RUN)
    ends = np.full(runs * RUN, long[-1])
    ends[:n] = short
    ends = ends.reshape(runs, RUN)
    out = np.empty((runs, RUN), dtype=np.int64)
    low = np.searchsorted(long, ends[:, 0])
    out[:, 0] = low
    last = len(long) - 1
    for k in range(1, RUN):
        want = ends[:, k]
        low = out[:, k - 1].copy()
        high = low.copy()
        step = 1
        going = np.flatnonzero(long[high] < want)
        while len(going):
            # long[low] is below; double the step until long[high] is not.
            low[going] = high[going]
            high[going] = np.minimum(high[going] + step, last)
            going = going[long[high[going]] < want[going]]
            step *= 2
        going = np.flatnonzero(high - low > 1)
        while len(going):
            middle = (low[going] + high[going]) >> 1
            below = long[middle] < want[going]
            low[going[below]] = middle[below]
            high[going[~below]] = middle[~below]
            going = going[high[going] - low[going] > 1]
        out[:, k] = high
    return out.ravel()[:n]


def aligned(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of two lists of ends with the same last end: per short token the place in ``long`` where it ends and whether that
    end is common; per long token whether its end is common; and the links as places in ``short`` and in ``long``."""
    at = gallop(short, long)
    common = long[at] == short
    common_long = np.zeros(len(long), dtype=bool)
    common_long[at[common]] = True
    first = np.concatenate([[0], at[:-1] + common[:-1]])
    count = at - first + 1
    links_short = np.repeat(np.arange(len(short)), count)
    links_long = np.arange(len(links_short)) + np.repeat(first - np.cumsum(count) + count, count)
    return at, common, common_long, links_short, links_long


SIGNS = ",|;"


@lru_cache(maxsize=1)
def signed() -> list[str]:
    """Decimal ids followed by one of the signs, by sign * IDS + id; then ids alone."""
    return [f"{i}{sign}" for sign in (*SIGNS, "") for i in range(IDS)]


def hashes(a: np.ndarray, b: np.ndarray, common_a: np.ndarray, common_b: np.ndarray, tokens: np.ndarray, groups: np.ndarray) -> list[str]:
    """Per text the hash of its groups; ``tokens`` and ``groups`` count those of every text."""
    group_a, group_b = (np.concatenate([[0], np.cumsum(c)[:-1]]) for c in (common_a, common_b))
    number = int(groups.sum())
    size_a, size_b = np.bincount(group_a, minlength=number), np.bincount(group_b, minlength=number)
    place_a = np.arange(len(a)) + (np.cumsum(size_b) - size_b)[group_a]
    place_b = np.arange(len(b)) + np.cumsum(size_a)[group_b]
    out = np.empty(len(a) + len(b), dtype=np.int64)
    out[place_a] = a + IDS * np.where(common_a, 1, 0)
    out[place_b] = b + IDS * np.where(common_b, 2, 0)
    end = np.cumsum(tokens)
    out[end - 1] += IDS  # the text's last token: nothing follows
    table = signed()
    texts = list(map(table.__getitem__, out.tolist()))
    return [hashlib.sha256("".join(texts[e - n:e]).encode()).hexdigest() for e, n in zip(end.tolist(), tokens.tolist())]


def align(texts: list[str], tokens_a: Tokens, tokens_b: Tokens) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Per text (n_a, n_b, n_groups, n_links, groups_sha256), and of all links, text by text, the A and the B id."""
    out = pd.DataFrame({"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}, index=range(len(texts)))
    # A marker of spaces in the text is a space to B.
    at = [k for k, text in enumerate(texts) if text and SPACE not in text]
    parts_a, parts_b = [pre_tokens(" " + texts[k]) for k in at], [stretches(" " + texts[k]) for k in at]
    sides = []
    good = np.ones(len(at), dtype=bool)
    for tokens, parts in ((tokens_a, parts_a), (tokens_b, parts_b)):
        places = tokens([p for part in parts for p in part])
        owner = np.repeat(np.arange(len(at)), [len(part) for part in parts])
        sides.append((tokens, places, owner))
        good &= np.bincount(owner, ~tokens.whole[places], minlength=len(at)) == 0
    if not good.any():
        return out, np.empty(0, np.int64), np.empty(0, np.int64)
    ids, widths, owners = [], [], []
    for tokens, places, owner in sides:
        kept = good[owner]
        found = tokens.spread(places[kept])
        ids.append(found)
        widths.append(tokens.width[found])
        owners.append(np.repeat(owner[kept], tokens.count[places[kept]]))
    n_a, n_b = (np.bincount(owner, minlength=len(at)) for owner in owners)
    links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    # Texts where A has fewer ends, then those where B has.
    for turned, chosen in ((False, good & (n_a <= n_b)), (True, good & (n_a > n_b))):
        if not chosen.any():
            continue
        mine = [chosen[owner] for owner in owners]
        a, b = ids[0][mine[0]], ids[1][mine[1]]
        ends_a, ends_b = (np.cumsum(width[m]) for width, m in zip(widths, mine))
        short, long = (ends_b, ends_a) if turned else (ends_a, ends_b)
        _, common_short, common_long, link_short, link_long = aligned(short, long)
        common_a, common_b = (common_long, common_short) if turned else (common_short, common_long)
        link_a, link_b = (link_long, link_short) if turned else (link_short, link_long)
        owner_a = owners[0][mine[0]]
        rows = np.flatnonzero(chosen)
        groups = np.bincount(owner_a, common_a, minlength=len(at)).astype(np.int64)[rows]
        n_links = np.bincount(owner_a[link_a], minlength=len(at))[rows]
        where = np.array(at)[rows]
        out.loc[where, ["n_a", "n_b", "n_groups", "n_links"]] = np.stack([n_a[rows], n_b[rows], groups, n_links], axis=1)
        out.loc[where, "groups_sha256"] = hashes(a, b, common_a, common_b, (n_a + n_b)[rows], groups)
        links.append((owner_a[link_a], a[link_a], b[link_b]))
    owner, a, b = (np.concatenate(x) for x in zip(*links))
    order = np.argsort(owner, kind="stable")
    return out, a[order], b[order]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links"]


def blocks(rows: DataFrame, bytes_file: str, pieces_file: str, block_bytes: int = BLOCK) -> DataFrame:
    """Rows of texts: their numbers as arrays, the block's pairs with their counts, and the links as places among these."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = both(bytes_file, pieces_file)
        ids: list = []
        parts: list[tuple[pd.DataFrame, np.ndarray]] = []
        size = 0

        def made() -> pd.DataFrame:
            whole = pd.concat([p for p, _ in parts], ignore_index=True)
            pairs, place, count = np.unique(np.concatenate([links for _, links in parts]), return_inverse=True, return_counts=True)
            kind = np.uint16 if len(pairs) <= 1 << 16 else np.uint32
            return pd.DataFrame({
                "block": [uuid.uuid4().hex], "doc_ids": [ids], "hashes": [whole.groups_sha256.tolist()],
                **{c: [whole[c].tolist()] for c in COLUMNS}, "pairs": [pairs], "counts": [count],
                "width": np.dtype(kind).itemsize, "links": [place.astype(kind).tobytes()],
            })

        for frame in frames:
            doc_ids = [None if pd.isna(d) else int(d) for d in frame.doc_id]
            texts = frame.text.tolist()
            at = 0
            while at < len(texts):
                stop, length = at, 0
                while stop < len(texts) and (stop == at or length + len(texts[stop]) <= BATCH):
                    length += len(texts[stop])
                    stop += 1
                numbers, a, b = align(texts[at:stop], *tokens)
                ids.extend(doc_ids[at:stop])
                parts.append((numbers, a * IDS + b))
                size += length
                at = stop
                if size >= block_bytes:
                    yield made()
                    ids, parts, size = [], [], 0
        if parts:
            yield made()

    arrays = ", ".join(f"{c} array<long>" for c in COLUMNS)
    return rows.mapInPandas(read, f"block string, doc_ids array<long>, hashes array<string>, {arrays}, "
                                  "pairs array<long>, counts array<long>, width int, links binary")


def summed(found: DataFrame) -> DataFrame:
    """(block, answers) of the blocks: per pair, in the block's order, its count in the corpus and whether it is its B id's best."""
    asked = found.select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "e")).select(
        "block", "at", F.col("e.pairs").alias("pair"), F.col("e.counts").alias("n"))
    total = stage(asked.groupBy("pair").agg(F.sum("n").alias("total")), "alignment-pairs")
    b = F.col("pair").bitwiseAND(F.lit(IDS - 1))
    # One row per B id: at most IDS.
    best = total.groupBy(b.alias("b")).agg(F.max("total").alias("best"))
    known = total.withColumn("b", b).join(F.broadcast(best), "b").select(
        "pair", "total", (F.col("total") == F.col("best")).alias("best"))
    # The best ones have their sign turned, so an answer is one number.
    answer = asked.join(known, "pair").select(
        "block", F.struct("at", F.when(F.col("best"), -F.col("total")).otherwise(F.col("total")).alias("total")).alias("answer"))
    return answer.groupBy("block").agg(F.sort_array(F.collect_list("answer")).alias("answers"))


def alignments(docs: DataFrame, bytes_file: str | None = None, pieces_file: str | None = None, block_bytes: int = BLOCK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs (doc_id, text)``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain_text().alias("text"))
    found = stage(blocks(rows, bytes_file or default_bytes(), pieces_file or default_model(), block_bytes), "alignment-blocks")
    answers = summed(found).select("block", F.col("answers.total").alias("totals"))
    whole = found.drop("pairs", "counts").join(answers, "block", "left")

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                n_links = np.array(row.n_links, dtype=np.int64)
                totals = np.array(row.totals if row.totals is not None else [], dtype=np.int64)
                place = np.frombuffer(row.links, dtype=np.uint16 if row.width == 2 else np.uint32)
                each = totals[place]
                edge = np.concatenate([[0], np.cumsum(n_links)])
                best = np.concatenate([[0], np.cumsum(each < 0)])[edge]
                number = np.concatenate([[0], np.cumsum(np.abs(each))])[edge]
                yield pd.DataFrame({
                    "doc_id": pd.array([None if pd.isna(d) else int(d) for d in row.doc_ids], dtype="Int64"),
                    **{c: np.array(getattr(row, c), dtype=np.int64) for c in COLUMNS},
                    "n_best": np.diff(best), "count_sum": np.diff(number), "groups_sha256": list(row.hashes),
                })

    numbers = ", ".join(f"{c} long" for c in [*COLUMNS, "n_best", "count_sum"])
    return whole.mapInPandas(add, f"doc_id long, {numbers}, groups_sha256 string")

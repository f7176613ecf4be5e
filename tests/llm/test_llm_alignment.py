"""Cross-tokenizer alignment against the libraries on whole texts and overlaps counted byte by byte."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment

LETTERS = alignment.byte_letters()
SCHEMA = "doc_id long, text string, block string, links int, n_a string, totals int"
ODD = [
    (1, None), (2, ""), (3, " "), (4, "  \t\n  "), (5, "one"), (6, "It's 12,345 o'clock — naïve café"), (6, "It's 12,345 o'clock — naïve café"),
    (None, "a null id "), (7, "marker ▁ inside"), (8, "special <|endoftext|> and </s><s><unk> strings"), (9, "日本語のテキスト、終わり。" * 20),
    (10, "\U0001f600 family \U0001f468‍\U0001f469‍\U0001f467 ࡰࡱ ᲀ ꟊ x\U00010d4a"), (11, "tab\tnew\r\n\n  line \n mid  "), (12, "zero\x00byte\x7f\u0080"),
    (13, "x" * 3000), (14, " ".join(f"word{i % 977} {i}" for i in range(30_000))), (15, "a " * 200), (16, "   leading and trailing   "), (17, "the same the same"),
]


def by_force(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    names = {i: bytes(LETTERS[c] for c in e) for e, i in a.get_vocab(with_added_tokens=False).items()}
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    out, all_links = [], []
    for doc_id, text in rows:
        ids = [], []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            if not b"".join(names[i] for i in ids[0]) == b"".join(map(piece, ids[1])) == (" " + text).encode():
                ids = [], []
        ends_a, ends_b = np.cumsum([len(names[i]) for i in ids[0]]).tolist(), np.cumsum([len(piece(i)) for i in ids[1]]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        groups, low = [], 0
        for end in common:
            groups.append(",".join(str(i) for i, e in zip(ids[0], ends_a) if low < e <= end) + "|"
                          + ",".join(str(i) for i, e in zip(ids[1], ends_b) if low < e <= end)) if len(text) < 10_000 else None
            low = end
        # A link begins at every byte where a token of either side does.
        owner_a, owner_b = np.repeat(np.arange(len(ids[0])), np.diff([0, *ends_a])), np.repeat(np.arange(len(ids[1])), np.diff([0, *ends_b]))
        links = [(ids[0][i], ids[1][j]) for i, j in dict.fromkeys(zip(owner_a.tolist(), owner_b.tolist()))]
        all_links.append(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups and None not in groups else "" if not ids[0] else None
        out.append([doc_id, len(ids[0]), len(ids[1]), len(common), len(links), digest])
    count = Counter(link for links in all_links for link in links)
    best: dict[int, int] = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    return [(*row[:5], sum(count[l] == best[l[1]] for l in links), sum(count[l] for l in links), row[5]) for row, links in zip(out, all_links)]


def same(got, rows):
    got = sorted((tuple(r) for r in got.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    want = sorted(by_force(rows), key=lambda r: (r[0] is None, r[0] or 0))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:7] == w[:7] and w[7] in (None, g[7]), (g, w)


@pytest.mark.parametrize("block", [alignment.BLOCK, 100])
def test_odd_texts(spark, block):
    got = alignment.alignments(spark.createDataFrame([(*r, "b", 1, "n", 2) for r in ODD], SCHEMA), block_bytes=block)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    same(got, ODD)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    same(alignment.alignments(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_empty(spark):
    assert alignment.alignments(spark.createDataFrame([], SCHEMA)).collect() == []


def test_gallop():
    rng = np.random.default_rng(3)
    for n, m in [(1, 1), (5, 500), (64, 64), (65, 3000), (1000, 1001)]:
        long = np.cumsum(rng.integers(1, 9, size=m))
        short = np.unique(np.append(rng.integers(1, long[-1] + 1, size=n - 1), long[-1]))
        assert (alignment.gallop(short, long) == np.searchsorted(long, short)).all()

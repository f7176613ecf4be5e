"""Suffix dedup in blocks and slices: what leaves a block, and results that do not depend on how texts are cut up."""

from __future__ import annotations

import random
import re

import pytest

from tidemark.llm import suffix_dedup

DOCS = "doc_id long, text string"


def texts(count: int, seed: int = 5) -> list[tuple[int, str]]:
    """Texts of made-up words; each third one holds a passage of an earlier one with other text around it."""
    pick = random.Random(seed)
    out: list[tuple[int, str]] = []
    for k in range(count):
        own = " ".join("".join(pick.choices("abcdefghijklmnop", k=pick.randint(2, 9))) for _ in range(120))
        if k % 3 == 2:
            start = pick.randint(0, 200)
            own = own[:300] + out[k - 2][1][start:start + 150] + own[300:]
        out.append((k, own))
    return out


def gone(rows: list[tuple[int | None, str | None]], length: int = 50) -> dict[int | None, list[tuple[int, int]]]:
    first: dict[bytes, int] = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for d, b in data:
        for i in range(len(b) - length + 1):
            if d is not None:
                first[b[i:i + length]] = min(d, first.get(b[i:i + length], d))
    out = {}
    for d, b in data:
        marks = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if d is not None and first[b[i:i + length]] < d:
                marks[i:i + length] = b"\1" * length
        out[d] = [m.span() for m in re.finditer(rb"\x01+", bytes(marks))]
    return out


def spans(frame) -> dict[int | None, list[tuple[int, int]]]:
    return {r.doc_id: [(s.start, s.stop) for s in r.removed] for r in frame.collect()}


def test_only_places_of_shared_anchors_leave_a_block(spark, monkeypatch):
    """However many anchors there are; a filter of fixed size is full at some number and holds nothing back."""
    monkeypatch.setattr(suffix_dedup, "BLOOM", 64, raising=False)
    made: dict[str, int] = {}
    stage = suffix_dedup.stage

    def counted(df, label):
        out = stage(df, label)
        made[label] = made.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(suffix_dedup, "stage", counted)
    rows = texts(30)
    assert spans(suffix_dedup.dedup(spark.createDataFrame(rows, DOCS))) == gone(rows)
    reader, holders, total = suffix_dedup.Reader(), {}, 0
    for d, t in rows:
        for key in reader.read([t])[-1].tolist():
            holders.setdefault(key, []).append(d)
            total += 1
    shared = sum(len(x) for x in holders.values() if len(set(x)) > 1)
    assert 0 < shared < total / 4
    assert made["suffix-places"] == shared


@pytest.mark.parametrize("block, slice_", [(1, 1), (1500, 2000), (1 << 22, 1)])
def test_blocks_and_slices_change_nothing(spark, monkeypatch, block, slice_):
    for name, value in (("BLOCK", block), ("SLICE", slice_), ("BUCKET", 3000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    line = "a line that many of the texts hold in full, word for word. "
    rows = texts(24) + [(100 + k, f"{k} {line * 2}{k}") for k in range(12)] + [
        (None, line * 3), (200, None), (201, ""), (202, "é" * 49 + line), (203, "a" * 300), (204, "a" * 130 + "é" * 49)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert spans(suffix_dedup.dedup(docs)) == gone(rows)


def test_texts_of_one_id_in_different_blocks(spark, monkeypatch):
    """Rows of one id are no smaller than each other; a row that comes twice loses the same bytes both times."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1)
    (_, first), (_, second) = texts(2)
    rows = [(1, first), (1, first), (1, second), (2, first[:400]), (2, first[:400])]
    got = suffix_dedup.dedup(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.removed)) for r in got) == sorted(
        (d, len(t), len(t) if d == 2 else 0) for d, t in rows)


def test_blocks_hold_every_text_once(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 2000)
    rows = [(d, d * 7, t) for d, t in texts(20)] + [(50, 1, ""), (51, 2, "é" * 5000), (51, 2, "é" * 5000)]
    packed = suffix_dedup.blocks_of(spark.createDataFrame(rows, "doc_id long, text_key long, text string").repartition(2)).toPandas()
    assert packed.block.is_unique and len(packed) > 5
    got = []
    for k in range(len(packed)):
        for docs, keys, data, _ in suffix_dedup.sections(packed.iloc[k:k + 1], suffix_dedup.Reader()):
            got += list(zip(docs.tolist(), keys.tolist()))
            assert len(data) == sum(len(t.encode()) for d, _, t in rows if d in docs) or 51 in docs
    assert sorted(got) == sorted((d, k) for d, k, _ in rows)
    assert packed.volume.sum() == sum(len(t.encode()) for *_, t in rows)

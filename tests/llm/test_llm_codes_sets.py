"""SetSketch near-duplicates and vector codes: against brute force on odd rows, small tables and hand-made groups."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pandas as pd
import pytest

from tidemark.llm import codes, setsketch

PROSE = [f"word{i}" for i in range(120)]
DOCS = "doc_id long, text string, band int, unit string, sketch string, n long, key long"


def shingles(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", low) if w]
    return {b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def near_by_force(rows):
    sets = [shingles(text) for _, text in rows]
    own = list(range(len(rows)))

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                own[root(i)] = root(j)
    ids: dict[int, list] = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc_id)
    lowest = {r: min((d for d in found if d is not None), default=None) for r, found in ids.items()}
    return sorted(((d, len(s), lowest[root(i)], d == lowest[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def changed(words, places, mark):
    return " ".join(f"{mark}{i}" if i in places else w for i, w in enumerate(words))


def odd_rows():
    chance = random.Random(5)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One TWO"), (6, "one two"), (7, " ".join(PROSE)), (7, " ".join(PROSE)),
            (None, " ".join(PROSE).upper()), (None, None), (8, "x " * 50_000), (9, "é\xa0ß " * 40), (10, "一二三" * 300), (None, "lone text here")]
    # A group of changed copies: more than a cell of one band holds, some at the edge of the similarity.
    rows += [(100 + k, changed(PROSE, set(chance.sample(range(120), k % 4)), f"c{k % 30}x")) for k in range(400)]
    # Chains, where a member is similar to its neighbours only.
    rows += [(1000 + k, " ".join(f"chain{i}" for i in range(5 * k, 5 * k + 100))) for k in range(12)]
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("cell", [setsketch.CELL, 16])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(setsketch, "CELL", cell)
    rows = odd_rows()
    docs = spark.createDataFrame([(d, t, 1, "u", "s", 2, 3) for d, t in rows], DOCS)
    got = setsketch.near_duplicates(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = [(d, n, c, True if d is None and c is None else bool(k)) for d, n, c, k in near_by_force(rows)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert setsketch.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(0)
    pool = rng.integers(1, 1 << 63, size=60_000, dtype=np.uint64)
    a, b = np.sort(pool[:40_000]), np.sort(pool[2_000:42_000])
    x, y, union = setsketch.registers([a, b, np.unique(np.concatenate([a, b]))])
    assert (setsketch.merge(x, y) == union).all()
    assert (setsketch.registers([a, a[:5]])[0] == x).all()  # alone in a slice, or beside another set
    more, less = np.array([(x > y).sum()]), np.array([(x < y).sum()])
    assert setsketch.plausible([40_000], [40_000], more, less).all()  # similarity 0.905
    far = setsketch.registers([np.sort(pool[20_000:])])[0]
    assert not setsketch.plausible([40_000], [40_000], np.array([(x > far).sum()]), np.array([(x < far).sum()])).any()


def codes_by_force(rows):
    kept = [(v, label, [math.floor(codes.SCALE * x) for x in e]) for v, e, label in rows
            if e is not None and e and len(e) % 8 == 0 and all(x is not None and math.isfinite(x) for x in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = len(kept[0][2]) // 8
    kept = [r for r in kept if len(r[2]) == 8 * width]
    cut = [[r[2][p * width:(p + 1) * width] for p in range(8)] for r in kept]
    books = [[list(row[p]) for row in cut[:16]] for p in range(8)]

    def best(p, part):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), i) for i, e in enumerate(books[p]))

    for _ in range(codes.ROUNDS):
        for p in range(8):
            groups: dict[int, list] = {}
            for row in cut:
                groups.setdefault(best(p, row[p])[1], []).append(row[p])
            for i, parts in groups.items():
                books[p][i] = [sum(c) // len(parts) for c in zip(*parts)]
    found = [[best(p, row[p]) for p in range(8)] for row in cut]
    return sorted(((r[0], "".join(f"{i:02x}" for _, i in f), sum(d for d, _ in f)) for r, f in zip(kept, found)), key=repr)


def vectors(kind):
    chance = random.Random(kind)
    rows = [(None, [0.5] * 16, "a"), (3, None, "a"), (4, [1.0, None] * 8, "b"), (5, [float("nan")] * 16, "b"), (6, [float("inf")] * 16, None),
            (900, [0.25] * 8, "a"), (901, [], "a"), (902, [1.0] * 15, "a")]
    for k in range(300):
        if kind == "ties":  # few different values: distances are often equal
            row = [chance.choice([-1, 0, 1]) / 4096 for _ in range(16)]
        elif kind == "same":
            row = [0.125] * 16
        else:
            row = [chance.gauss(k % 5, 0.3) for _ in range(16)]
        rows.append((10 + k // 2, row, "ab"[k % 2] if k % 7 else None))
    return rows


@pytest.mark.parametrize("kind", ["ties", "same", "groups"])
def test_codes_equal_brute_force(spark, kind):
    rows = vectors(kind)
    table = spark.createDataFrame(
        [(*r, 1, "n", "b") for r in rows], "vec_id long, embedding array<double>, label string, error int, near string, ints string")
    got = codes.encode(table).collect()
    assert sorted(((r.vec_id, r.code, r.error) for r in got), key=repr) == codes_by_force(rows)
    assert len({r.codebooks_sha256 for r in got}) == 1 and len({r.label_error for r in got}) <= 3


def test_few_vectors_and_none(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(k, [float(k)] * 8, None) for k in range(3)]
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in codes.encode(spark.createDataFrame(rows, schema)).collect()) == [
        (k, f"{k:02x}" * 8, 0, 0) for k in range(3)]
    none = codes.encode(spark.createDataFrame([(1, None, 1)], schema))
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and none.collect() == []


def test_bounds_spare_distances(spark):
    chance = np.random.default_rng(1)
    centres = chance.normal(size=(16, 64)) * 4
    rows = [(k, (centres[k % 16] + chance.normal(size=64) * 0.1).tolist(), 0) for k in range(2000)]
    report: list = []
    codes.fitted(codes.integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")), report=report)
    assert report[0][2] == 2000 * 8 and sum(r[1] for r in report[1:]) < 6 * 2000 * 8 / 2
    assert report[-1][0] <= report[0][0]


def test_cells_link_what_a_hub_does_not(monkeypatch):
    monkeypatch.setattr(setsketch, "CELL_PAIRS", 40)
    chance = np.random.default_rng(3)
    base = np.unique(chance.integers(0, 1 << 63, size=400, dtype=np.uint64))
    sets = [np.sort(base)]
    for _ in range(60):  # a chain of small changes: neighbours are similar, the ends are not
        kept = chance.random(len(sets[-1])) > 0.04
        sets.append(np.unique(np.concatenate([sets[-1][kept], chance.integers(0, 1 << 63, size=int((~kept).sum()), dtype=np.uint64)])))
    sketches = setsketch.registers(sets)
    keys = setsketch.band_keys(sketches)
    names = [setsketch.name_of(s) for s in sets]
    rows = []
    for number in range(setsketch.BANDS):
        values, count = np.unique(keys[:, number], return_counts=True)
        for value in values[count > 1]:
            for at in np.flatnonzero(keys[:, number] == value):
                # Two blocks: every member is in the cell of its own block and in the one of both.
                own = int(at % 2)
                for low, high in {(own, own), (0, 1)}:
                    rows.append((int(value), number, low, high, own, names[at], names[at], len(sets[at]), sketches[at].tobytes(), sets[at].tobytes()))
    frame = pd.DataFrame(rows, columns=["band", "number", "low", "high", "block", "unit", "part", "n", "sketch", "hashes"])
    frame = frame.sort_values(setsketch.CELL_KEY).reset_index(drop=True)
    doubtful = setsketch.in_doubt(frame)
    again = frame.merge(doubtful.drop_duplicates(), on=list(doubtful.columns))
    found = setsketch.linked(again.sort_values(setsketch.CELL_KEY).reset_index(drop=True))

    def classes(pairs):
        root = {x: x for x in names}
        for a, b in pairs:
            while root[a] != a:
                a = root[a]
            while root[b] != b:
                b = root[b]
            root[max(a, b)] = min(a, b)
        out = {}
        for x in names:
            y = x
            while root[y] != y:
                y = root[y]
            out.setdefault(y, set()).add(x)
        return sorted(map(sorted, out.values()))

    similar = [(names[i], names[j]) for i in range(len(sets)) for j in range(i) if setsketch.same_enough(sets[i], sets[j])]
    assert set(map(frozenset, zip(found.src, found.dst))) <= set(map(frozenset, similar))
    assert len(similar) > len(sets) and classes(zip(found.src, found.dst)) == classes(similar)
    assert len(found) < len(names)  # a forest, not all pairs

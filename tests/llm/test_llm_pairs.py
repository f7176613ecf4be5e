"""SimHash, paragraph and suffix dedup, decontamination: against brute force on small rows and whole small tables."""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tidemark.llm import common, decontaminate, paragraphs, simhash, suffix_dedup
from tidemark.llm.common import Bloom, components, shared_folder

DOCS = "doc_id long, text string, key int, n long"
PROSE = " ".join(f"word{i}" for i in range(60)) + "."
ODD = [
    (1, None, 0, 0), (2, "", 0, 0), (3, " \t\n", 0, 0), (4, "one", 0, 0), (5, "One TWO", 0, 0),
    (6, PROSE, 0, 0), (7, PROSE, 0, 0), (7, PROSE, 0, 0), (None, PROSE, 0, 0), (8, PROSE.upper(), 0, 0),
    (9, PROSE.replace("word30", "changed"), 0, 0), (10, "x " * 5000, 0, 0), (None, None, 0, 0), (11, "é\xa0ß " * 40, 0, 0),
    (12, "a" * 200, 0, 0), (13, "b" + "a" * 120, 0, 0), (14, "Before. " + PROSE + " after it all.", 0, 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def fingerprint(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", low) if w]
    found = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s, 42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_linked(prints):
    """Component of each distinct fingerprint by brute force."""
    label = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (a ^ b).bit_count() <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("hot", [simhash.HOT, 0])
@pytest.mark.parametrize("source", ["odd", "documents"])
def test_simhash_against_brute_force(request, source, hot):
    docs = request.getfixturevalue(source)
    rows = rows_of(docs)
    prints = {(d, t): fingerprint(t) for d, t in rows}
    label = smallest_linked(sorted(set(prints.values())))
    first = {}
    for (d, _), p in prints.items():
        if d is not None:
            first[label[p]] = min(d, first.get(label[p], d))
    want = sorted(((d, f"{prints[d, t]:016x}", first.get(label[prints[d, t]])) for d, t in rows), key=str)
    got = simhash.near_duplicates(docs, hot)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=str) == want


def test_simhash_links_at_two_bits_not_three(spark):
    base = 0x0123456789ABCDEF
    values = [base, base ^ 0b11, base ^ (0b111 << 20), base ^ 0b1111, base ^ (1 << 63) ^ 1]
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    want = {frozenset((a, b)) for a in values for b in values if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    assert {frozenset((r.src, r.dst)) for r in simhash.links(frame).collect()} == want


def test_one_of_each_keeps_columns_and_smallest(odd):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 6 in ids and 7 not in ids and 8 not in ids and 1 in ids and 2 not in ids


def test_components(spark):
    edges = [(5, 4), (4, 9), (1, 9), (7, 8), (8, 8), (3, 3), (None, 1), (20, 21), (21, 22), (22, 23), (23, 20)]
    got = components(spark.createDataFrame(edges, "src long, dst long"))
    assert sorted(map(tuple, got.collect())) == [
        (1, 1), (3, 3), (4, 1), (5, 1), (7, 7), (8, 7), (9, 1), (20, 20), (21, 20), (22, 20), (23, 20)]
    chain = spark.range(300).selectExpr("id as src", "id + 1 as dst")
    assert {r.component for r in components(chain).collect()} == {0}
    assert components(spark.createDataFrame([], "src long, dst long")).count() == 0


@pytest.mark.parametrize("function", [
    simhash.near_duplicates, simhash.one_of_each, paragraphs.dedup, suffix_dedup.dedup,
    lambda d: decontaminate.marked(d, d.selectExpr("doc_id AS item_id", "text")),
    lambda d: decontaminate.clean(d, d.selectExpr("doc_id AS item_id", "text")),
])
def test_empty_table(spark, function):
    assert function(spark.createDataFrame([], DOCS)).count() == 0


# Suffix dedup

def covered(rows, length=50):
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            if d is not None:
                first[b[i:i + length]] = min(d, first.get(b[i:i + length], d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if d is not None and first[b[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
@pytest.mark.parametrize("source", ["odd", "documents"])
def test_suffix_dedup_against_brute_force(request, source, hot):
    docs = request.getfixturevalue(source)
    got = suffix_dedup.dedup(docs, hot).collect()
    assert sorted(
        ((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.removed), len(r.removed), r.kept) for r in got), key=str
    ) == covered(rows_of(docs))


# Decontamination

def overlaps(text, item, window=20):
    a, b = text.encode().lower().split(), item.encode().lower().split()
    size = min(window, len(b))
    if len(b) < decontaminate.WEIGHT:
        return False
    return any(
        sum(x == y for x, y in zip(a[i:i + size], b[j:j + size])) >= 0.8 * size
        for i in range(len(a) - size + 1) for j in range(len(b) - size + 1)
    )


def test_decontamination_finds_every_substituted_passage(spark):
    item = " ".join(f"w{i}" for i in range(40))
    words = item.split()
    near = " ".join("other" if i % 6 == 3 else w for i, w in enumerate(words))
    far = " ".join("other" if i % 3 == 0 else w for i, w in enumerate(words))
    texts = [
        (1, f"some words ahead {item} and behind", 0, 0), (2, f"{near} more", 0, 0), (3, far, 0, 0), (4, None, 0, 0),
        (5, "", 0, 0), (6, "five small words stand here", 0, 0), (7, " ".join(words[:21]), 0, 0), (8, item.upper(), 0, 0),
        (8, item.upper(), 0, 0), (None, item, 0, 0), (9, " ".join(words[:10]), 0, 0),
    ]
    bench = [(0, item), (1, "five small words stand here"), (2, "four words too few"), (3, None), (4, ""), (5, item)]
    docs = spark.createDataFrame(texts, DOCS)
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    got = decontaminate.marked(docs, benchmark).collect()
    want = [(d, [i for i, b in bench if overlaps(t or "", b or "")]) for d, t, _, _ in texts]
    assert sorted(((r.doc_id, r.item_ids) for r in got), key=str) == sorted(want, key=str)
    assert {d for d, items in want if items} == {1, 2, 6, 7, 8, None}
    kept = decontaminate.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 9]


def test_seeds_of_many_texts_are_those_of_each():
    cutter, words = paragraphs.Cutter(), [f"w{i}" for i in range(40)]
    # An item's halves in two texts, a text without words, and the item itself.
    texts = [" ".join(words[:20]), " ".join(words[20:]), "", " \n", "w1", " ".join(words), "é " * 30]
    filled = np.full(1, -1, dtype=np.int64).view(np.uint64)  # lets all through
    tokens, ends = cutter.tokens(texts)
    got = decontaminate.hits(tokens, ends, filled, 64)
    want = []
    for k, text in enumerate(texts):
        own, end = cutter.tokens([text])
        at, found = decontaminate.hits(own, end, filled, 64)
        want += zip((at + (ends[k - 1] if k else 0)).tolist(), found.tolist())
    assert sorted(zip(*(x.tolist() for x in got))) == sorted(want)
    assert len(want) == sum(max(0, len(t.split()) - len(m) + 1) for t in texts for m in decontaminate.MASKS)


def test_decontamination_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    shared = {}
    for i, t in items:
        for w in set(t.encode().lower().split()):
            shared.setdefault(w, set()).add(i)
    got = {r.doc_id: r.item_ids for r in decontaminate.marked(docs, bench).collect()}
    assert len(got) == docs.count()
    for d, t in rows_of(docs):
        words = set(t.encode().lower().split())
        likely = [i for i, b in items if len(words & set(b.encode().lower().split())) >= 10]
        assert got[d] == sorted(i for i in likely if overlaps(t, dict(items)[i])), d


# Paragraphs

def shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def test_paragraph_spans_cover_the_text():
    for text in ("", "a", "One. Two!  Three?\n\n four e.g. five", PROSE * 3, "\n\n\n", "no end " * 50, "1.5 is 3.25."):
        spans = paragraphs.paragraphs(text)
        assert "".join(text[a:b] for a, b in spans) == text
        assert all(a < b for a, b in spans)


@pytest.mark.parametrize("part", [paragraphs.PART, 7])
def test_word_hashes_tell_words_apart(documents, monkeypatch, part):
    monkeypatch.setattr(paragraphs, "PART", part)
    cutter, code, word = paragraphs.Cutter(), {}, {}
    odd = ["", " \n", "A\x00b a\x00B", "é É\xa0ß  x\x0by\x1cz", "z" * 3000 + " q", " lead", "trail ", "aa a aaa", "\ud800 x"]
    for text in [t for _, t in rows_of(documents) if t][:100] + odd:
        data = text.encode("utf-8", "surrogatepass")
        starts, codes = cutter.codes(data)
        assert starts.tolist() == [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
        for w, c in zip(data.lower().split(), codes.tolist()):
            assert code.setdefault(w, c) == c and word.setdefault(c, w) == w


def test_paragraph_bands_agree_with_sets():
    cutter = paragraphs.Cutter()
    import pandas as pd

    texts = pd.Series([PROSE, PROSE.upper(), PROSE + " more words at the end of it all here", "a b c d", "a b c d e"])
    owner, place, size, codes = cutter.cut(texts)
    ids, bands = cutter.ids(size, codes), cutter.bands(size, codes)
    assert owner[:2] == [0, 1] and ids[0] == ids[1] and (bands[0] == bands[1]).all()
    assert 3 not in owner and 4 in owner


def test_paragraph_dedup(spark):
    passage = " ".join(f"p{i}" for i in range(55)) + "."
    near = passage.replace("p54.", "px.")
    docs = spark.createDataFrame([
        (1, f"Start of the first one here. {passage} End of the first one here.", 0, 0),
        (2, f"Another text begins with other words in it. {passage} And then it goes on to its own end.", 0, 0),
        (3, f"Third one.\n{near}\nShort line.", 0, 0), (4, "Nothing shared in this text, not even one long line of it.", 0, 0),
        (5, None, 0, 0), (6, "", 0, 0), (7, "Short line.", 0, 0), (8, f"{passage}\n{passage}", 0, 0), (4, None, 0, 0),
        (9, " ".join(f"q{i}" for i in range(30)) + ".\n" + " ".join(f"q{i}" for i in range(30)) + ".", 0, 0),
    ], DOCS)
    got = paragraphs.dedup(docs)
    assert got.columns == [*docs.columns, "n_removed", "first_docs"]
    by_id = {(r.doc_id, r.text is None): r for r in got.collect()}
    assert by_id[1, False].n_removed == 0
    assert passage not in by_id[2, False].text and by_id[2, False].first_docs == [1]
    assert by_id[2, False].text.startswith("Another text begins") and by_id[2, False].text.endswith("own end.")
    assert near not in by_id[3, False].text and by_id[3, False].text == "Third one.\nShort line."
    assert by_id[4, False].n_removed == 0 and by_id[4, True].text is None and by_id[7, False].text == "Short line."
    assert by_id[8, False].text == ""
    assert by_id[9, False].n_removed == 0  # its own repetition, held by no other document
    assert got.count() == docs.count()


def test_paragraph_links_connect_what_similar_pairs_connect(spark, documents):
    rows = documents.selectExpr("doc_id", "xxhash64(text) AS key", "text")
    found = paragraphs.units(rows).cache()
    got = {r.node: r.component for r in components(paragraphs.near_links(rows, found)).collect()}
    sets = {}
    cutter = paragraphs.Cutter()
    import pandas as pd

    for _, text in rows_of(documents):
        parts = [text[a:b] for a, b in paragraphs.paragraphs(text)]
        parts = [p for p in parts if len(p.encode().split()) >= 5]
        if parts:
            _, _, size, codes = cutter.cut(pd.Series([text]))
            for unit, part in zip(cutter.ids(size, codes).tolist(), parts):
                sets[unit] = shingles(part)
    by_shingle = {}
    for unit, found_in in sets.items():
        for s in found_in:
            by_shingle.setdefault(s, []).append(unit)
    label = {u: u for u in sets}

    def find(u):
        while label[u] != u:
            u = label[u]
        return u

    pairs = {(a, b) for units in by_shingle.values() for a in units for b in units if a < b}
    for a, b in pairs:
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            label[max(x, y)] = min(x, y)
    want = {u: find(u) for u in sets}
    groups = {}
    for u, c in want.items():
        groups.setdefault(c, set()).add(u)
    linked = {u for g in groups.values() if len(g) > 1 for u in g}
    assert linked and {u: c for u, c in got.items() if u in linked} == {u: want[u] for u in linked}
    found.unpersist()


def test_passages_in_running_text_go_to_the_word(spark):
    """Whatever stands around a passage, just its words go, and only if another document holds 20 of them in a row."""
    said = [f"a{i}" + ("." if i % 17 == 16 else "") for i in range(60)]

    def within(name, passage, after=" "):
        around = [f"{name}{i}" for i in range(40)]
        return " ".join(around[:23]) + " " + " ".join(passage) + after + " ".join(around[23:])

    docs = spark.createDataFrame([
        (1, within("b", said), 0, 0), (2, within("c", said), 0, 0), (3, within("d", said[:20]), 0, 0),
        (4, within("e", said[:19]), 0, 0), (5, within("f", said[31:55], "\n"), 0, 0), (6, within("g", []), 0, 0),
        (7, "Head line\n" + within("h", []), 0, 0), (8, "Head line\n" + within("h", []), 0, 0), (9, None, 0, 0),
        (10, "few words", 0, 0), (11, "few words", 0, 0),
    ], DOCS)
    got = {r.doc_id: r for r in paragraphs.dedup(docs).collect()}
    for doc in (1, 4, 6, 7, 9, 10, 11):
        assert got[doc].n_removed == 0, doc
    for doc, name in ((2, "c"), (3, "d"), (5, "f")):
        want = " ".join(f"{name}{i}" for i in range(40))
        assert got[doc].text.split() == want.split() and got[doc].first_docs == [1], doc
    assert "f22\nf23" in got[5].text
    assert got[8].text == "" and got[8].first_docs == [7]


def test_windows_against_brute_force(spark, documents):
    held = sorted({(d, t) for d, t in rows_of(documents)})
    windows = {}
    for d, t in held:
        found = t.encode().lower().split()
        for i in range(len(found) - 19):
            windows.setdefault(tuple(found[i:i + 20]), []).append((d, i))
    texts = {}
    for d, t in held:
        texts.setdefault(t, []).append(d)
    # Windows of a text whose copies alone hold them need not be told; the text goes whole.
    alike = {d: ids[0] for t, ids in texts.items() for d in ids}
    want = {(d, i, places[0][0]) for places in windows.values() if len({alike[d] for d, _ in places}) > 1
            for d, i in places if d != places[0][0]}
    rows = documents.selectExpr("doc_id", "xxhash64(text) AS key", "text")
    got = {(r.doc_id, r.start, r.first_doc) for r in paragraphs.passages(rows).collect()}
    assert want and {g for g in got if g[1] >= 0} >= want
    assert all(g[2] < g[0] for g in got)
    whole = {(d, -1, ids[0]) for t, ids in texts.items() for d in ids[1:] if len(t.split()) >= 20}
    assert {g for g in got if g[1] < 0} >= whole


@pytest.mark.parametrize("source", ["odd", "documents"])
def test_one_of_each_against_brute_force(request, source):
    docs = request.getfixturevalue(source)
    rows = rows_of(docs)
    label = smallest_linked(sorted({fingerprint(t) for _, t in rows}))
    first = {}
    for d, t in rows:
        if d is not None:
            first[label[fingerprint(t)]] = min(d, first.get(label[fingerprint(t)], d))
    want = sorted(((d, t) for d, t in rows if d == first.get(label[fingerprint(t)])), key=str)
    assert sorted(rows_of(simhash.one_of_each(docs)), key=str) == want


def test_paragraph_dedup_with_clashing_columns(spark):
    names = ["gone", "windows", "n_removed", "first_docs", "__gone", "pos", "start", "unit"]
    plain = spark.createDataFrame([(1, PROSE), (2, "Other words come first here. " + PROSE), (3, None)], "doc_id long, text string")
    docs = plain.selectExpr("*", *[f"'kept' AS `{name}`" for name in names])
    got = paragraphs.dedup(docs)
    extra = [name for name in names if name not in ("n_removed", "first_docs")]
    assert got.columns == ["doc_id", "text", *extra, "n_removed", "first_docs"]
    rows = {r.doc_id: r for r in got.collect()}
    assert all(r[name] == "kept" for r in rows.values() for name in extra)
    assert rows[1].n_removed == 0 and rows[3].text is None
    assert rows[2].n_removed > 0 and list(rows[2].first_docs) == [1] and "word30" not in rows[2].text


def test_copies_are_not_cut_up_and_go_with_what_their_first_text_goes_for(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    whole = " ".join(f"a{i}" for i in range(30)) + " " + passage + " " + " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame(
        [(1, "x y z " + passage), (2, whole), (3, whole), (3, whole), (4, whole), (5, "short copy"), (6, "short copy")],
        "doc_id long, text string")
    rows = docs.selectExpr("doc_id", "xxhash64(text) AS key", "text")
    texts = paragraphs.first_texts(rows)
    kept = Bloom(texts.selectExpr("xxhash64(first.doc_id, key) AS place"), bits=1 << 20)
    assert {r.doc_id for r in paragraphs.units(rows, kept).collect()} == {1, 2}
    assert {(r.doc_id, r.start < 0) for r in paragraphs.passages(rows, kept).collect()} == {(2, False), (3, True), (4, True)}
    got = sorted((r.doc_id, r.text, r.first_docs) for r in paragraphs.dedup(docs).collect())
    assert got[1][1].split() == whole.replace(passage, "").split() and got[1][2] == [1]
    assert got[2:5] == [(3, "", [1, 2]), (3, "", [1, 2]), (4, "", [1, 2])]
    assert got[5:] == [(5, "short copy", []), (6, "short copy", [])]


def test_small_tables_bring_no_second_python_step_into_a_task(spark):
    docs = spark.createDataFrame([(1, PROSE), (2, PROSE)], "doc_id long, text string")
    plan = paragraphs.dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_a_filter_on_what_is_left_cuts_no_text_up_twice(spark):
    docs = spark.createDataFrame([(1, PROSE), (2, "Other words than those come first here, and ten of them. " + PROSE)], "doc_id long, text string")
    left = paragraphs.dedup(docs).where("n_removed = 0 OR text <> ''").selectExpr("doc_id", "text", "length(text) AS n")
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert sum("ArrowEvalPython [rewrite(" in line for line in plan.splitlines()) == 1
    assert sorted((r.doc_id, "word30" in r.text) for r in left.collect()) == [(1, True), (2, False)]


@pytest.mark.parametrize("buckets", [1, 7])
def test_values_of_several_owners(spark, monkeypatch, buckets):
    monkeypatch.setattr(common, "PAIRS", 50)
    rows = [(k * k % 97 * 0x9E3779B97F4A7C15 % 2**64 - 2**63, k % 5 - 2) for k in range(400)]
    rows += [(k * 3, 1) for k in range(50)] + [(k * 3, 1) for k in range(50)] + [(-1, 4), (-1, 3), (2**63 - 1, -7), (2**63 - 1, 9)]

    def pairs(frames):
        for frame in frames:
            yield frame.value.to_numpy().view("uint64"), frame.owner.to_numpy()

    frame = spark.createDataFrame(rows, "value long, owner long").repartition(5)
    owners = {}
    for value, owner in rows:
        owners.setdefault(value, set()).add(owner)
    want = sorted((v, min(o)) for v, o in owners.items() if len(o) > 1)
    assert want and sorted(map(tuple, common.several_owners(frame, pairs, buckets).collect())) == want
    assert common.several_owners(frame.limit(0), pairs, buckets).count() == 0


def test_anchors_of_many_texts_are_those_of_each(documents):
    odd = ["", "a" * 49, "b" * 50, "a" * 200, "é" * 60, "short", "a" * 50, "\ud800" * 40]
    texts = odd + [t or "" for _, t in rows_of(documents)][:60]
    reader, alone, rows = suffix_dedup.Reader(), suffix_dedup.Reader(), {}
    data, owner, start, end, at, keys = reader.read(texts)
    assert data == b"".join(t.encode("utf-8", "surrogatepass") for t in texts)
    low, high = suffix_dedup.row_bounds(at, start, end)
    got = sorted(zip(owner.tolist(), (at - start).tolist(), keys.tolist(), reader.rows(data, low, at, high).tolist()))
    want = []
    for k, text in enumerate(texts):
        own, _, first, last, place, codes = alone.read([text])
        a, b = suffix_dedup.row_bounds(place, first, last)
        hashes = alone.rows(own, a, place, b).tolist()
        want += zip([k] * len(place), place.tolist(), codes.tolist(), hashes)
        for h, x, y, z in zip(hashes, a.tolist(), place.tolist(), b.tolist()):
            assert rows.setdefault(h, (y - x, own[x:z])) == (y - x, own[x:z])
    assert got == sorted(want) and {k for k, *_ in got} >= {2, 3, 4, 6, 7}


def test_steps_of_suffix_dedup_go_once_they_are_used(spark):
    folder = "/" + shared_folder(spark).split(":", 1)[-1].lstrip("/")
    old = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    docs = spark.createDataFrame([(k, f"{PROSE} {k} {PROSE}") for k in range(6)], "doc_id long, text string")
    assert suffix_dedup.dedup(docs).where("size(removed) > 0").count() == 5
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - old if os.listdir(f"{folder}/{name}")}
    assert left <= {"suffix-marks", "suffix-hot"}

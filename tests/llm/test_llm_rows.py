"""Token counts, segmentation, language model, pages, search and quality: against the library, brute force, held-out rows."""

from __future__ import annotations

import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
import pytest
import sentencepiece

from tidemark.llm import html_extract, lm_score, quality, token_counts, topk, viterbi
from tidemark.llm.pieces import default_model, pieces

DOCS = "doc_id long, text string, key int, n long, score string"
ODD = [
    (1, None), (2, ""), (3, " "), (4, "a  b\n\tc "), (5, "x▁y é☃　"), (6, "=" * 70), (7, "word " * 40), (7, "word " * 40),
    (None, "no id at all"), (8, "</s><s><unk>"), (9, "\x00\x01"), (10, "the theatré of the others " * 30),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(d, t, 1, 2, "x") for d, t in ODD], DOCS)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def noise(seed, size):
    pick = random.Random(seed)
    return "".join(pick.choice("ab  \n▁é☃==#/thein") for _ in range(size))


# Token counts

@pytest.mark.parametrize(("chunk", "overlap"), [(token_counts.CHUNK, token_counts.OVERLAP), (40, 4)])
@pytest.mark.parametrize("source", ["odd", "documents"])
def test_token_counts_are_the_librarys(request, source, chunk, overlap):
    docs = request.getfixturevalue(source)
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    want = []
    for d, t in rows_of(docs):
        n = len(library.encode(t or "", num_threads=1))
        want.append((d, len((t or "").encode()), n, n > 4096))
    got = token_counts.token_counts(docs, chunk=chunk, overlap=overlap)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_token_counts_splice_only_at_proven_places():
    enc = token_counts.encoder(default_model())
    for seed in range(150):
        text = noise(seed, 5 + seed)
        form = token_counts.normal_form(text)
        overlap = 3
        while True:
            rows = []
            for k, low, part in token_counts.windows(form, 11, overlap):
                n, left, right = token_counts.marks(enc, part, low, k * 11, 11, overlap)
                rows.append((k, n, *([x[i] for x in side] for side in (left, right) for i in (0, 1))))
            found = token_counts.splice(pd.DataFrame(rows, columns=["k", "n", "left_at", "left_n", "right_at", "right_n"]))
            if found is not None:
                break
            overlap *= token_counts.WIDEN
        assert found == len(enc.library.encode(text, num_threads=1)) == enc.count(form)


# Segmentation

def best_cut(text):
    """All of a text by the recurrence alone."""
    worker = viterbi.segmenter(default_model())
    form = viterbi.form_of(text or "")
    if not form:
        return [], 0
    best, first = worker.scores(form, [0], len(form))
    ids = worker.trace(form, first, 0, len(form))[0]
    return np.frombuffer(ids, np.int32).tolist(), best[0]


@pytest.mark.parametrize("chunk", [viterbi.CHUNK, 20])
@pytest.mark.parametrize("source", ["odd", "documents"])
def test_segmentation_is_one_best_cut_whatever_the_chunks(request, source, chunk):
    docs = request.getfixturevalue(source)
    rows = rows_of(docs)
    if source == "documents" and chunk == 20:
        docs, rows = docs.where("doc_id < 20"), [r for r in rows if r[0] < 20]
    back = viterbi.decode(viterbi.encode(docs, chunk=chunk)).collect()
    assert sorted(((r.doc_id, r.ids, r.score) for r in back), key=str) == sorted(((d, *best_cut(t)) for d, t in rows), key=str)
    assert sorted(((r.doc_id, r.decoded) for r in back), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    assert all(r.back == r.key for r in back)


def test_segmentation_has_the_highest_score():
    worker, table = viterbi.segmenter(default_model()), pieces(default_model())

    def every(text):
        if not text:
            yield 0
        for n in range(1, len(text) + 1):
            found = worker.pieces.get(text[:n])
            score = found[1] if found else worker.unknown if n == 1 else None
            if score is not None:
                for rest in every(text[n:]):
                    yield score + rest

    for text in ("theatre", " others", "a  b", "==#", "é☃x", "\n"):
        assert worker.encode(text)[1] == max(every(text))
    assert table.forced


def test_different_stretches_are_cut_all_at_once(monkeypatch):
    worker = viterbi.Segmenter(default_model())
    texts = ["word, word. (Word) others", "", "  a   b", "é☃x \u2581 y", "\ud800 z", "日本語, x", "long" * 40, "a\nb\n\nc", " . ,"]
    want = [best_cut(text) for text in texts]
    got = list(worker.encode_all(map(viterbi.form_of, texts)))
    assert [(np.frombuffer(ids, np.int32).tolist(), score) for ids, score in got] == want
    assert worker.stretches(" word, word.") == [" word", ",", " word", "."]

    def one_by_one(*_):
        raise AssertionError("cut by itself")

    monkeypatch.setattr(worker, "scores", one_by_one)
    known = ["word, word. (Word) others", "the theatre of others, the end"]
    assert [s for _, s in worker.encode_all(map(viterbi.form_of, known))] == [best_cut(text)[1] for text in known]


def test_max_plus_scan_is_associative():
    pick = np.random.default_rng(1)
    mats = pick.integers(-50, 0, size=(7, 4, 4))
    mats[pick.random(mats.shape) < 0.3] = viterbi.NEVER
    got = viterbi.suffixes(mats)
    for k in range(7):
        want = mats[-1]
        for m in mats[k:-1][::-1]:
            want = viterbi.product(m, want)
        assert (got[k] == want).all()


# Language model

@pytest.mark.parametrize(("order", "piece"), [(2, 1 << 20), (3, 60)])
@pytest.mark.parametrize("source", ["odd", "documents"])
def test_language_model_against_brute_force(request, source, order, piece):
    docs = request.getfixturevalue(source)
    rows = rows_of(docs)
    tokens = [(d, [0] * (order - 1) + (t or "").encode().lower().split() + [1]) for d, t in rows]
    learnt = [t for d, t in tokens if d is None or crc32(str(d).encode()) % 7 != 2]
    grams = [Counter(tuple(t[i - k:i + 1]) for t in learnt for i in range(order - 1, len(t))) for k in range(order)]
    follow = [None] + [Counter(tuple(t[i - k:i]) for t in learnt for i in range(order - 1, len(t))) for k in range(1, order)]
    n, v, strength = sum(grams[0].values()), len(grams[0]), lm_score.STRENGTH
    want = []
    for d, t in tokens:
        base = score = 0.0
        known = 0
        for i in range(order - 1, len(t)):
            seen = grams[0][t[i],]
            known += seen > 0
            p = (seen + 1) / (n + v + 1)
            base += math.log10(p)
            for k in range(1, order):
                p = (grams[k][tuple(t[i - k:i + 1])] + strength * p) / (follow[k][tuple(t[i - k:i])] + strength)
            score += math.log10(p)
        held = d is not None and crc32(str(d).encode()) % 7 == 2
        want.append((d, held, len(t) - order + 1, known, n, round(base, 6), round(score, 6)))
    got = lm_score.score_texts(docs, order=order, piece=piece, block=30_000, bucket=20_000).collect()
    assert sorted((
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got
    ), key=str) == sorted(want, key=str)


def test_language_model_beats_its_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    row = lm_score.score_texts(docs).where("held_out").selectExpr("sum(score) AS s", "sum(base_score) AS b").first()
    assert row.s > row.b


def test_packing():
    values = np.array([0, 1, 255, 1 << 40, (1 << 64) - 1], dtype=np.uint64)
    assert (lm_score.unpack(lm_score.pack(values), np.uint64) == values).all()


# Pages

PAGE = (
    '<!doctype html><html><head><title>T</title><script>x="</p>"</script></head><body><nav><ul><li><a href="/">Home</a></li>'
    '</ul></nav><div class="cookie-notice">We use cookies on this site.</div><article><h1>A &amp; B</h1><p>The first'
    '<br>paragraph  of the text, with a <a href="/x">link</a>.<p>Second one &eacute;&#x21; and more of it.</p>'
    '<aside class="related"><a href="/y">Read this</a></aside><ul><li>One item here.</li></ul></article>'
    '<section class="comments"><p>I do not agree with that. Not at all.</p></section><form><p>Subscribe now</p></form>'
    '<footer>&copy; Nobody</footer></body></html>'
)
TEXT = "A & B\n\nThe first paragraph of the text, with a link.\n\nSecond one é! and more of it.\n\nOne item here."


def test_pages(spark):
    rows = [(1, "u", PAGE, 1), (1, "u", PAGE, 1), (2, None, None, 1), (3, "", "", 1), (None, "v", "<p>unclosed <b>tag", 1),
            (5, "w", "<article><p>Never ends <!-- x", 1), (6, "z", "<" * 3000 + 'a href="', 1), (7, "q", "<div>" * 2000 + "deep", 1)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[1].text == TEXT and by_id[1].n_chars == len(TEXT)
    assert by_id[2].text == by_id[3].text == "" and by_id[2].n_chars == 0
    assert by_id[5].text == "Never ends"
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_seed_pages_are_told_right():
    model = html_extract.fit(html_extract.seed_counts())
    for page in html_extract.SEEDS:
        tree = html_extract.parse(page)
        labels, chances = html_extract.seed_labels(tree), html_extract.marginals(tree, model)
        wrong = [t for t, y, p in zip(tree.text, labels, chances) if t is not None and (p > 0.5) != bool(y)]
        assert len(wrong) <= 2, wrong


def test_marginals_are_those_of_all_labellings():
    model = html_extract.fit(html_extract.seed_counts())
    tree = html_extract.parse("<div class='x'><p>Some text. More.</p><ul><li>one</li></ul></div><p>tail</p>")
    seen, n = html_extract.observe(tree), len(tree.parent)
    weight = {}
    for labels in range(1 << n):
        y = [labels >> i & 1 for i in range(n)]
        total = model.root[y[0]] + sum(model.node[f][y[i]] for i in range(n) for f in seen[i] if f in model.node)
        total += sum(model.edge[html_extract.place(tree, i)][y[tree.parent[i]]][y[i]] for i in range(1, n))
        weight[labels] = math.exp(total)
    whole = sum(weight.values())
    for i, chance in enumerate(html_extract.marginals(tree, model)):
        assert chance == pytest.approx(sum(w for x, w in weight.items() if x >> i & 1) / whole, rel=1e-6)


def test_pages_of_the_table(spark):
    import html as entities
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html_extract.extract(pages).join(pages.select("page_id", "html"), "page_id").collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        parts = [" ".join(entities.unescape(re.sub("<[^>]*>", "", p)).split()) for p in re.split("</?(?:p|h1)>", article)]
        assert r.text == "\n\n".join(p for p in parts if p)


# Search

def test_search_against_brute_force(spark):
    pick = random.Random(3)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [pick.choice([-1.0, -0.5, 0.0, 0.25, pick.random()]) for _ in range(6)]) for i in range(400)]
    rows += [(100, rows[5][1]), (500, None), (600, [1.0, None]), (700, [nan]), (800, [inf, 1.0]), (None, [1.0]), (900, []),
             (1000, [1.0, 2.0]), (1100, [3e4] * 6), (1200, [0.1] * 9)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    sound = [
        (n, i, [math.floor(1024 * float(np.float32(x))) for x in v]) for n, (i, v) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    want = []
    for n, i, v in sound:
        if i % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, j, w in sound if m != n)[:10]
            want += [(i, k, j, -s) for k, (s, j) in enumerate(found, 1)]
    for block in (topk.BLOCK, 3):
        assert sorted(map(tuple, topk.top_k(frame, block=block).collect())) == sorted(want)


def test_search_with_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema)).count() == 0
    got = topk.top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1024 * 2048)]


def test_search_stops_early():
    pick = np.random.default_rng(0)
    block = np.concatenate([pick.normal(0, 20, (2000, 8)), pick.normal(900, 20, (50, 8))]).astype(np.int64)
    pivots = block[[0, 2010]]
    query = block[2020]
    squares, ids = (block.astype(float) ** 2).sum(1), np.arange(len(block))
    found, scores, done = topk.best(
        query, -1, -math.inf, topk.distances(query[None], pivots)[0], ids, ids, block, squares,
        topk.distances(block, pivots), 10)
    exact = block @ query
    assert found == sorted(ids, key=lambda i: (-exact[i], i))[:10] and done < len(block) / 4


# Quality

def test_quality_on_held_out_labels(spark):
    from tidemark.llm.queries import op9_quality

    got = op9_quality(spark, "/root/testdata/sf0.1")
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r.predicted for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.1
    assert got.count() == 10_000 and all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in got.collect())


def test_quality_of_odd_rows(spark, odd):
    from tidemark.llm.queries import graded

    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (7, None), (99, 1), (None, 0)], "doc_id long, quality int")
    got = graded(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in graded(odd, labels.limit(0)).collect()} == {0.5}
    assert graded(odd.limit(0), labels).count() == 0
    same = {(r.doc_id, r.score) for r in graded(odd, labels).collect()}
    assert same == {(r.doc_id, r.score) for r in got}


@pytest.mark.parametrize("apply", [
    token_counts.token_counts, viterbi.encode, lm_score.score_texts,
])
def test_empty_table(spark, apply):
    assert apply(spark.createDataFrame([], DOCS)).count() == 0

"""Spelling variants, toxicity and whitening against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from fleetline.llm import gru, spectral, spelling, toxicity, whitening
from fleetline.llm.fm_index import BidirectionalIndex, one_error
from fleetline.llm.registry import QUERIES
from tests.conftest import SF_SMALL

UP = str.maketrans(spelling.UPPER, spelling.LOWER)


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def spelled(rows):
    """(word, form, root, n, n_near, form_n) by definition."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w
    return sorted((w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n)


def spelling_rows():
    rnd = random.Random(4)
    base = ["alphabet", "éléphant", "internal", "aaaaaaa", "abababab", "straße" + "ß" * 3, "ÀÀÀÀÀÀÀ"]
    texts = []
    for word in base:
        texts += [word] * 40
        for _ in range(12):
            i = rnd.randrange(len(word) + 1)
            texts += [word[:i] + rnd.choice("abé") + word[i:], word[:i] + word[i + 1:],
                      word[:i] + "x" + word[i + 1:]] * rnd.choice((1, 2, 2, 4))
    texts += ["abcdefg"] * 700 + ["abcdefh"] * 40 + ["abcdeih"] * 3           # a chain of forms
    texts += ["q" * 3_000] * 3 + ["q" * 2_999 + "r"] * 2                     # very long words
    rnd.shuffle(texts)
    rows = [(None if i % 50 == 0 else i // 3, f"{t}, {t.upper()}1{t}") for i, t in enumerate(texts)]
    return rows + [(1, None), (2, ""), (3, "1 2 3"), (4, "short wörd")]


@pytest.mark.parametrize("shard_chars", [400_000, 300])
def test_spelling_equals_brute_force(spark, shard_chars):
    rows = spelling_rows()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    got = sorted(map(tuple, spelling.group_spellings(docs, shard_chars).collect()))
    want = spelled(rows)
    assert got == want and any(r[1] for r in want) and any(r[1] and r[1] != r[2] for r in want)


def test_spelling_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group_spellings(empty).collect() == []


def test_search_schemes_find_every_near_word_once():
    rnd = random.Random(1)
    for _ in range(25):
        letters = "abc"[:rnd.randint(1, 3)] + "é"
        words = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(3, 7))) for _ in range(50)})
        index, found = BidirectionalIndex(words), set()
        for size in {len(w) for w in words}:
            queries = [w for w in words if len(w) == size]
            for first in (True, False):
                pairs = [(queries[i], words[j]) for i, j in zip(*one_error(index, queries, first))]
                assert len(pairs) == len(set(pairs))
                found.update(pairs)
        assert found == {(a, b) for a in words for b in words if len(b) >= len(a) and one_apart(a, b)}


def whitened(rows, components=16):
    """Rows of the contract with plain numpy; signs by the largest entry."""
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in rows], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = fit - s / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(vectors.shape[1])])
    scores = (x - s / n) @ vectors / np.sqrt(values)
    total = np.trace(y.T @ y / n)
    return {(rows[i][0], k + 1): (n, int(((n * x[i] - s) ** 2).sum()), scores[i, k], values[k] / total)
            for i in range(len(rows)) for k in range(len(values))}


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(2)
    mix = rng.standard_normal((20, 20)) * np.linspace(3, 0.3, 20)
    rows = [(i, (rng.standard_normal(20) @ mix).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]                      # copies count once in the fit
    bad = [(2000, None), (2001, [float("nan")] * 20), (2002, [float("inf")] + [0.0] * 19),
           (2003, [None] + [0.0] * 19), (2004, []), (2005, [1.0] * 7)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, embedding array<double>, n int")
    got = {(r["vec_id"], r["component"]): r for r in whitening.whiten(frame).collect()}
    want = whitened(rows)
    assert got.keys() == want.keys()
    for key, (n, deviation, score, explained) in want.items():
        r = got[key]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["whitened"] - score) < 1e-7 and abs(r["explained"] / explained - 1) < 1e-9
        assert r["identity_error"] < 1e-9


def test_whitening_edges(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    # one direction of variance, huge entries, a null id
    rows = whitening.whiten(spark.createDataFrame([(None, [0.0, 1.0]), (2, [1e300, 1.0])], schema)).collect()
    assert len(rows) == 2 and all(r["component"] == 1 and abs(abs(r["whitened"]) - 1) < 1e-6 for r in rows)
    assert all(r["deviation"] is None for r in rows)
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(1, [0.0] * (whitening.MAX_DIMENSIONS + 1))], schema))


def test_spectral_components():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 33):
        q, _ = np.linalg.qr(rng.standard_normal((n, n)))
        for values in (rng.random(n), np.ones(n), np.repeat([4.0, 1.0], [n // 2, n - n // 2]),
                       np.r_[np.zeros(n // 2), rng.random(n - n // 2)], np.zeros(n)):
            v = (q * values) @ q.T
            found, vectors = spectral.components((v + v.T) / 2)
            assert np.allclose(found, np.sort(values)[::-1], atol=1e-12)
            assert np.allclose(vectors.T @ vectors, np.eye(n), atol=1e-12)
            assert np.allclose(v @ vectors, vectors * found, atol=1e-12)


def test_network_gradients_are_exact():
    rng, net = np.random.default_rng(0), gru.Network(1)
    net.weights = {k: w.astype(np.float64) for k, w in net.weights.items()}
    inputs = gru.hashed(["abc", "de", "fghij", "k"])
    windows, sizes, labels = rng.integers(0, 4, (5, 6)), np.array([6, 3, 1, 6, 4]), np.array([1, 0, 1, 1, 0.0])

    def loss():
        logits = net.run(net.vectors(*inputs) @ net.weights["inputs"] + net.weights["bias"], windows, sizes)
        return np.mean(np.logaddexp(0, logits.astype(float)) - labels * logits)

    for name, g in net.gradients(inputs, windows, sizes, labels).items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        kept, ends = net.weights[name][at], []
        for step in (1e-2, -1e-2):
            net.weights[name][at] = kept + step
            ends.append(loss())
        net.weights[name][at] = kept
        assert abs((ends[0] - ends[1]) / 2e-2 - g[at]) < 1e-4 * (1 + abs(g[at]))


def test_windows_cover_every_word_twice():
    texts = [np.arange(1, n + 1) for n in (0, 1, 31, 32, 33, 48, 49, 200)]
    windows, sizes, text = toxicity.cut(texts)
    for i, words in enumerate(texts):
        mine = [w[:s].tolist() for w, s, t in zip(windows, sizes, text) if t == i]
        seen = Counter(x for w in mine for x in w)
        assert set(seen) == set(words.tolist())
        assert all(seen[x] == 2 for x in words[toxicity.STRIDE:len(words) // 16 * 16 - 16].tolist())


def toxic_corpus(n):
    rnd = random.Random(7)
    clean = ["".join(rnd.choice("bdklmnprst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4))) for _ in range(300)]
    rows = []
    for i in range(n):
        words = [rnd.choice(clean) for _ in range(rnd.randint(20, 160))]
        toxic = i % 4 == 0
        if toxic:
            at = rnd.randrange(len(words))
            words[at:at] = [rnd.choice(("foulword", "nastyman", "vilething")) for _ in range(4)]
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_learns_and_handles_edges(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "ROUNDS", 3)
    rows = toxic_corpus(500)
    held = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    long = "lama " * 40_000
    edges = [(9000, None), (9001, ""), (9002, "12 ½ !!"), (9003, long), (9004, long + "foulword nastyman vilething "),
             (None, "lama"), (9005, "foulword nastyman foulword vilething"), (9005, "foulword nastyman foulword vilething")]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t, _ in rows] + [(*e, 2.0) for e in edges],
                                 "doc_id long, text string, score double")
    # held-out labels are turned round: nothing may be learned from them
    labels = spark.createDataFrame([(i, 1 - y if i in held else y) for i, _, y in rows] + [(None, 1), (3, None), (1, 0)],
                                   "doc_id long, toxic int")
    out = toxicity.score_toxicity(docs, labels).collect()
    assert len(out) == len(rows) + len(edges)
    truth = {i: y for i, _, y in rows}
    tested = [(truth[r["doc_id"]], r["predicted"]) for r in out if r["doc_id"] in truth and r["held_out"]]
    assert len(tested) > 100 and sum(a == b for a, b in tested) / len(tested) > 0.95
    by_id = defaultdict(list)
    for r in out:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        by_id[r["doc_id"]].append(r)
    assert [by_id[i][0]["score"] for i in (9000, 9001, 9002)] == [0.0] * 3
    assert by_id[9003][0]["predicted"] == 0 and by_id[9004][0]["score"] > by_id[9003][0]["score"]
    assert len(by_id[9005]) == 2 and len({r["score"] for r in by_id[9005]}) == 1


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "lama"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in toxicity.score_toxicity(docs, labels).collect()] == [0.0, 0.0]
    assert toxicity.score_toxicity(docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_embedding_whitening"])
def test_queries_equal_plain_versions(spark, name):
    rows = QUERIES[name](spark, SF_SMALL).collect()
    if name == "op11_spelling_variants":
        docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
        assert sorted(map(tuple, rows)) == spelled([tuple(r) for r in docs])
    else:
        vectors = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
        want = whitened([tuple(r) for r in vectors])
        assert {(r["vec_id"], r["component"]) for r in rows} == set(want)
        for r in rows:
            n, deviation, score, explained = want[r["vec_id"], r["component"]]
            assert (r["n"], r["deviation"]) == (n, deviation) and abs(r["explained"] / explained - 1) < 1e-6
            assert abs(abs(r["whitened"]) - abs(score)) < 1e-5 and r["identity_error"] < 1e-4

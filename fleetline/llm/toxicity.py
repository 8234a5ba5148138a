"""Toxicity scores by a recurrent network over overlapping windows (operator 12).

Method.  ``gru.Network`` reads windows of ``WINDOW`` words, a new one every
``STRIDE`` words, so every word but those at a text's ends is in two.  A
text's score comes from its most toxic window, by a logistic curve over that
window's logit and the logarithm of the number of windows (a long text has
more chances to hold a window that looks bad).

Training sees labels of documents, not of windows.  It starts, in each toxic
document, with the window whose words are most over-represented in toxic
documents, then repeatedly takes the windows that the network itself finds
most toxic: of toxic documents as examples (the worst window and all above the
logit ``SURE``), of clean ones as counter-examples.
Words and character n-grams of fewer than ``KNOWN_IN`` sampled documents have
no embedding.  A fifth of the sample is not trained on: it fits the curve and
chooses the round whose network is kept.

Scale.  The sample is bounded: at most ``TOXIC`` toxic and ``CLEAN`` clean
documents of at most ``SAMPLE_CHARS`` characters, those of smallest hash, so
training takes the same time and memory at every size, in one task.  Only
their ids are broadcast.  Scoring is one pass without a shuffle; the network (about 3 MB) is
broadcast, distinct words are projected once per task and kept in a table of
bounded size, and texts are taken in slices, their windows in blocks.

Cases.  Null or empty texts and those without a letter score 0.  Null labels
and null doc_ids are not learned from; of several labels of one document the
highest counts.  Without both classes to learn from, every score is 0.  Very
long texts are scored whole.  Repeated rows keep a row each.  Extra columns are
not read, whatever their names.  Empty table: empty result.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetline.llm.common import short_batches, slices
from fleetline.llm.gru import GRAM_BUCKETS, WORD_BUCKETS, Network, Words, hashed, sigmoid
from fleetline.llm.langid import word_list

WINDOW, STRIDE = 32, 16
TOXIC, CLEAN, SAMPLE_CHARS = 2000, 4000, 4000
ROUNDS, PASSES, BATCH, RATE = 5, 2, 256, 0.01
ROUND_WINDOWS = 16_000
KNOWN_IN = 5
SURE = 1.0
BLOCK_WINDOWS = 4096
THRESHOLD = 0.7


def cut(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, sizes, text of each window) of texts given as word numbers;
    texts without words have none."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = np.where(sizes > 0, np.maximum(-(-(sizes - WINDOW) // STRIDE), 0) + 1, 0)
    text = np.repeat(np.arange(len(texts)), counts)
    start = (np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
    flat = np.concatenate([*texts, np.zeros(WINDOW, np.int64)])
    size = np.minimum(sizes[text] - start, WINDOW)
    at = (np.cumsum(sizes) - sizes)[text] + start
    each = np.arange(WINDOW)
    windows = flat[np.minimum(at[:, None] + each, len(flat) - 1)]
    return np.where(each < size[:, None], windows, 0), size, text


def logits(network: Network, table: np.ndarray, windows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Logits block by block; windows of like size go together."""
    out = np.zeros(len(windows), np.float32)
    order = np.argsort(sizes, kind="stable")
    for i in range(0, len(order), BLOCK_WINDOWS):
        block = order[i:i + BLOCK_WINDOWS]
        longest = int(sizes[block].max())
        out[block] = network.run(table, windows[block, :longest], sizes[block])
    return out


def worst(values: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """The highest value of each text; minus infinity without windows."""
    out = np.full(texts, -np.inf)
    np.maximum.at(out, text, values)
    return out


def features(top: np.ndarray, windows: np.ndarray) -> np.ndarray:
    return np.column_stack([top, np.log(np.maximum(windows, 1)), np.ones(len(top))])


def loss(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> float:
    z = x @ weights
    return float((np.logaddexp(0, z) - y * z).sum())


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Coefficients of a logistic regression held near (1, 0, 0), by Newton
    steps, halved while they do not help."""
    start = np.zeros(x.shape[1])
    start[0] = 1.0

    def cost(weights):
        return loss(x, y, weights) + ridge / 2 * ((weights - start) ** 2).sum()

    weights = start.copy()
    for _ in range(50):
        p = sigmoid(x @ weights)
        slope = x.T @ (p - y) + ridge * (weights - start)
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        while cost(weights - step) > cost(weights) and np.abs(step).max() > 1e-9:
            step = step / 2
        weights = weights - step
        if np.abs(step).max() < 1e-9:
            break
    return weights


@dataclass
class Scorer:
    network: Network
    curve: np.ndarray

    def score(self, words: Words, texts: list[list[str]]) -> np.ndarray:
        numbers = words.numbers(texts)
        windows, sizes, text = cut(numbers)
        top = worst(logits(self.network, words.table, windows, sizes), text, len(texts))
        counts = np.bincount(text, minlength=len(texts))
        some = counts > 0
        out = np.zeros(len(texts))
        out[some] = sigmoid(np.clip(features(top[some], counts[some]) @ self.curve, -30, 30))
        return out


class Sample:
    """Windows of the training texts and the hashed inputs of their words."""

    def __init__(self, texts: list[list[str]]):
        vocabulary = sorted(set().union(*texts))
        number = dict(zip(vocabulary, range(1, len(vocabulary) + 1)))
        self.windows, self.sizes, self.text = cut([
            np.fromiter(map(number.__getitem__, t), np.int64, len(t)) for t in texts])
        # Number 0 (no word) gets the inputs of an empty mark, never seen.
        self.word, self.gram, self.counts = hashed(["\x00", *vocabulary])
        self.first = np.cumsum(self.counts) - self.counts
        self.vocabulary = vocabulary
        # Distinct (text, word) pairs, and in how many texts a word is.
        pairs = np.unique((self.text[:, None] * (len(vocabulary) + 1) + self.windows).ravel())
        pairs = pairs[pairs % (len(vocabulary) + 1) > 0]
        self.pair_text, self.pair_word = np.divmod(pairs, len(vocabulary) + 1)

    def known(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Word and gram buckets found in at least ``least`` texts."""
        out = []
        for buckets, counts in ((self.word[self.pair_word], None), (None, self.counts[self.pair_word])):
            text = self.pair_text
            if counts is not None:
                at = np.repeat(self.first[self.pair_word] - (np.cumsum(counts) - counts), counts)
                buckets, text = self.gram[at + np.arange(counts.sum())], np.repeat(text, counts)
            each = np.unique(text * (WORD_BUCKETS + GRAM_BUCKETS) + buckets) % (WORD_BUCKETS + GRAM_BUCKETS)
            values, found = np.unique(each, return_counts=True)
            out.append(values[found >= least])
        return out[0], out[1]

    def suspicion(self, toxic: np.ndarray, least: int) -> np.ndarray:
        """How over-represented a window's words are in toxic texts: the sum
        of their log-odds, for words of at least ``least`` texts."""
        total = np.bincount(self.pair_word, minlength=len(self.vocabulary) + 1)
        bad = np.bincount(self.pair_word, toxic[self.pair_text], minlength=len(total))
        odds = np.log((bad + 0.5) / (toxic.sum() + 1)) - np.log((total - bad + 0.5) / (len(toxic) - toxic.sum() + 1))
        weight = np.where(total >= least, np.maximum(odds, 0), 0)
        weight[0] = 0
        return weight[self.windows].sum(axis=1)

    def part(self, which: np.ndarray):
        """(inputs of the words, windows renumbered, sizes) of some windows."""
        used, windows = np.unique(self.windows[which], return_inverse=True)
        counts = self.counts[used]
        at = np.repeat(self.first[used] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        return ((self.word[used], self.gram[at], counts), windows.reshape(len(which), -1), self.sizes[which])


def trained(texts: list[list[str]], toxic: np.ndarray, seed: int = 0) -> Scorer | None:
    """Network and curve from word lists and their labels (0/1)."""
    some = [i for i, t in enumerate(texts) if t]
    texts, toxic = [texts[i] for i in some], toxic[some]
    if not 0 < toxic.sum() < len(toxic):
        return None
    rng = np.random.default_rng(seed)
    network, sample = Network(seed), Sample(texts)
    # A fifth of each class is kept for the curve, if the class has so many.
    kept = np.zeros(len(texts), bool)
    for label in (0, 1):
        members = rng.permutation(np.flatnonzero(toxic == label))
        kept[members[:len(members) // 5]] = True
    network.restrict(*sample.known(KNOWN_IN))
    window_toxic, usable = toxic[sample.text], ~kept[sample.text]
    bad, good = np.flatnonzero(usable & (window_toxic == 1)), np.flatnonzero(usable & (window_toxic == 0))
    found = sample.suspicion(np.where(kept, 0, toxic), KNOWN_IN)
    counts = np.bincount(sample.text, minlength=len(texts))
    fitted = kept if 0 < toxic[kept].sum() < kept.sum() else np.ones(len(texts), bool)
    best, choice = np.inf, None
    for round_ in range(ROUNDS):
        top = worst(found, sample.text, len(texts))
        sure = (round_ > 0) & (found[bad] > SURE)
        chosen_bad = bad[(found[bad] >= top[sample.text[bad]]) | sure]
        chosen_bad = rng.permutation(chosen_bad)[:ROUND_WINDOWS // 2]
        hardest = good[np.argsort(-found[good], kind="stable")][:ROUND_WINDOWS // 4]
        chosen_good = np.concatenate([hardest, rng.permutation(good)[:ROUND_WINDOWS // 2]])
        repeat = max(1, len(chosen_good) // (3 * len(chosen_bad)))
        chosen = np.concatenate([*[chosen_bad] * repeat, chosen_good])
        for _ in range(PASSES):
            shuffled = rng.permutation(chosen)
            for i in range(0, len(shuffled), BATCH):
                which = shuffled[i:i + BATCH]
                network.learn(*sample.part(which), window_toxic[which].astype(np.float32),
                              RATE * (1 - 0.8 * round_ / ROUNDS))
        table = np.concatenate([np.zeros((1, network.weights["bias"].size), np.float32),
                                network.projected(sample.vocabulary)])
        found = logits(network, table, sample.windows, sample.sizes)
        x = features(worst(found, sample.text, len(texts)), counts)[fitted]
        curve = logistic(x, toxic[fitted].astype(float))
        missed = loss(x, toxic[fitted], curve)
        if missed < best:
            best = missed
            choice = Scorer(network.copy(), curve)
    return choice


def held_out(doc_id):
    """Documents kept from training: crc32 of the id's text mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample_of(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> DataFrame:
    """(doc_id, text, toxic) of the bounded training sample."""
    marked = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .filter(~held_out(F.col("doc_id"))))
    short = docs.filter((F.length("text") <= SAMPLE_CHARS) & ~held_out(F.col("doc_id")))
    ids = short.select("doc_id").distinct().join(marked, "doc_id")
    drawn = [ids.filter(F.col("toxic") == label).orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
             .limit(most) for label, most in ((1, toxic), (0, clean))]
    # At most toxic + clean rows, so the broadcast is bounded.
    return short.select("doc_id", "text").join(F.broadcast(drawn[0].union(drawn[1])), "doc_id")


def learned(docs: DataFrame, labels: DataFrame) -> Scorer | None:
    """``docs``: doc_id, text; ``labels``: doc_id, toxic.  One row is learned
    from for every id drawn (of repeated ids, the smallest text).

    The bounded sample is one task's work, done again if its executor is lost;
    the driver receives the network.
    """
    sample = (sample_of(docs, labels).groupBy("doc_id")
              .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [b for b in batches if len(b)]
        rows = pd.concat(frames).sort_values("doc_id") if frames else pd.DataFrame({"text": [], "toxic": []})
        scorer = trained([word_list(t) for t in rows["text"]], rows["toxic"].to_numpy(int))
        yield pd.DataFrame({"scorer": [pickle.dumps(scorer)]})

    row = sample.coalesce(1).mapInPandas(train, "scorer binary").first()
    return None if row is None else pickle.loads(row["scorer"])


def scored(docs: DataFrame, scorer: Scorer | None) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if scorer is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"))
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = shared.value
        words = Words(scorer.network)
        for batch in batches:
            scores = [scorer.score(words, [word_list(t) for t in texts]) for texts in slices(batch["text"], 1_000_000)]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"),
                                "score": np.concatenate([np.zeros(0), *scores])})

    return rows.mapInPandas(score, "doc_id long, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted): learn from the labelled documents
    not held out, score all."""
    out = scored(docs, learned(docs.select("doc_id", "text"), labels.select("doc_id", "toxic")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))

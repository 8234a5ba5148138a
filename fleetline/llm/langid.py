"""Language identification by segmentation-marginalised unigrams (operator 10).

Method.  A fixed public vocabulary of pieces; per language a unigram
probability for every piece.  The probability of a word is the sum over all
its segmentations into pieces, by the forward algorithm; a text's words are
independent.  The predicted language has the greatest likelihood; the score is
its posterior under equal priors (ties: the first name).

Training counts, for every word of every training text, the pieces into which
the vocabulary itself cuts it, and smooths each language's distribution with
the pooled one (``SMOOTHING`` pseudo-pieces), itself with one added to each
piece.  A character outside the vocabulary is a piece with the same small
probability in every language.

Scale.  Tasks count words first, cut each distinct word once and send at most
vocabulary x languages counts; the model has that size too and is the only
thing broadcast.  Words' likelihoods are kept in a bounded table per worker
process.

Cases.  Null text or text without a letter: ``und`` with score 0.  Nothing to
learn from: ``und``.  Null ``lang``: not learned from.  Repeated rows count
each time.  Very long words: the forward pass works on logarithms
and never underflows.  Empty table: empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetline.llm.common import short_batches, slices

VOCABULARY = "piece_bpe_32k.model"
SMOOTHING = 1000.0
UNKNOWN = 1e-7
WORDS_KEPT = 200_000
CELLS_KEPT = 4_000_000
UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def vocabulary(path: str):
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=path)


def word_list(text: str) -> list[str]:
    """Runs of letters (Unicode category L), in lower case."""
    found = LETTERS.findall(text.lower())
    if "".join(found).isalpha():
        return found
    # ``LETTERS`` also takes numerals such as fractions and circled digits.
    return [run for word in found for run in "".join(c if c.isalpha() else " " for c in word).split()]


def piece_counts(docs: DataFrame, path: str) -> DataFrame:
    """(lang, piece, n) over rows with text and lang."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, seen = vocabulary(path), {}

        def flush() -> Iterator[pd.DataFrame]:
            for lang, found in seen.items():
                names = list(found)
                totals = np.zeros(model.get_piece_size(), np.int64)
                for name, ids in zip(names, model.encode(names, num_threads=1)):
                    np.add.at(totals, ids, found[name])
                used = np.flatnonzero(totals)
                yield pd.DataFrame({"lang": lang, "piece": used, "n": totals[used]})
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                seen.setdefault(lang, Counter()).update(word_list(text))
            if sum(map(len, seen.values())) > WORDS_KEPT:
                yield from flush()
        yield from flush()

    rows = docs.filter("lang is not null and text is not null").select("lang", "text")
    return rows.mapInPandas(count, "lang string, piece int, n long").groupBy("lang", "piece").agg(
        F.sum("n").alias("n"))


class Model:
    """Log-probabilities: a row per piece and a column per language."""

    def __init__(self, langs: list[str], pieces: list[str], counts: np.ndarray):
        pooled = counts.sum(axis=1) + 1.0
        pooled /= pooled.sum()
        p = (counts + SMOOTHING * pooled[:, None]) / (counts.sum(axis=0) + SMOOTHING)
        self.langs, self.longest = langs, max(map(len, pieces), default=1)
        self.row = {piece: i for i, piece in enumerate(pieces)}
        self.log_p = np.vstack([np.log(p), np.full(len(langs), np.log(UNKNOWN))])

    def score(self, words: list[str]) -> np.ndarray:
        """Log-likelihoods (words x languages), all segmentations summed: the
        forward algorithm, run for all words of one length at once."""
        out = np.zeros((len(words), len(self.langs)))
        lengths: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            lengths.setdefault(len(word) + 1, []).append(k)
        for n, group in lengths.items():
            texts = ["▁" + words[k] for k in group]
            ahead = {0: np.zeros((len(group), len(self.langs)))}
            for i in range(n):
                here = ahead.pop(i)
                for j in range(i + 1, min(n, i + self.longest) + 1):
                    missing = -1 if j > i + 1 else len(self.log_p) - 1
                    ids = np.fromiter([self.row.get(t[i:j], missing) for t in texts], np.int64, len(texts))
                    if j not in ahead:
                        ahead[j] = np.full(here.shape, -np.inf)
                    has = np.flatnonzero(ids >= 0)
                    if len(has):
                        ahead[j][has] = np.logaddexp(ahead[j][has], here[has] + self.log_p[ids[has]])
            out[group] = ahead[n]
        return out


class Likelihoods:
    """Likelihoods of the words met in a task, scored a batch of texts at a
    time; given up and begun again beyond ``CELLS_KEPT`` numbers."""

    def __init__(self, model: Model):
        self.model, self.row, self.table = model, {}, np.zeros((0, len(model.langs)))

    def of(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Summed log-likelihood of each text's words."""
        if self.table.size > CELLS_KEPT:
            self.row, self.table = {}, self.table[:0]
        new = list(set().union(*texts).difference(self.row))
        self.row.update(zip(new, range(len(self.row), len(self.row) + len(new))))
        self.table = np.concatenate([self.table, self.model.score(new)])
        at = self.row.__getitem__
        return [self.table[np.fromiter(map(at, words), np.int64, len(words))].sum(axis=0) for words in texts]


#: Likelihoods of the model a worker process serves; words met in one task are
#: not scored anew in its next.
_SERVED: dict[str, Likelihoods] = {}


def likelihoods_of(key: str, shared) -> Likelihoods:
    if key not in _SERVED:
        _SERVED.clear()
        _SERVED[key] = Likelihoods(shared.value)
    return _SERVED[key]


def learned(docs: DataFrame, path: str | None = None) -> Model | None:
    """Model of the languages in ``docs`` (text, lang); None without any."""
    path = path or public_tokenizers.path(VOCABULARY)
    short_batches(docs.sparkSession)
    rows = piece_counts(docs, path).collect()      # at most vocabulary x languages
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return None
    cutter = vocabulary(path)
    counts = np.zeros((cutter.get_piece_size(), len(langs)))
    column = {lang: i for i, lang in enumerate(langs)}
    for r in rows:
        counts[r["piece"], column[r["lang"]]] = r["n"]
    usable = [i for i in range(len(counts)) if not (
        cutter.is_control(i) or cutter.is_unknown(i) or cutter.is_byte(i))]
    return Model(langs, [cutter.id_to_piece(i) for i in usable], counts[usable])


def predicted(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if model is None:
        return rows.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    short_batches(docs.sparkSession)
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        likelihoods = likelihoods_of(key, shared)
        model = likelihoods.model
        for batch in batches:
            langs, scores = [], []
            for texts in slices(batch["text"]):
                found = [word_list(t) for t in texts]
                for words, total in zip(found, likelihoods.of(found)):
                    best = int(np.argmax(total))
                    langs.append(model.langs[best] if words else UNDETERMINED)
                    scores.append(float(1.0 / np.exp(total - total[best]).sum()) if words else 0.0)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "lang_pred": langs, "score": scores})

    return rows.mapInPandas(predict, "doc_id long, lang_pred string, score double")


def held_out(doc_id):
    """Documents kept from training: crc32 of the id's text mod 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Learn from the documents not held out, predict all."""
    model = learned(docs.filter(~held_out(F.col("doc_id"))), path)
    out = predicted(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

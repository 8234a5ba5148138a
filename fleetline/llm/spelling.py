"""Spelling variant grouping over a corpus vocabulary (operator 11).

Method.  Words are the runs of letters of all texts (``vocabulary``).  Two
words are near if they differ by one inserted, deleted or replaced code point.
One of them is then the other with a symbol replaced or inserted, and one half
of the shorter (or equal) word is unharmed: bidirectional FM-index search
schemes (``fm_index.one_error``) match either half exactly and extend across
the other allowing one error.  A word's form is its near word of the largest
count, if that is at least ``FORM_FACTOR`` times its own; the root follows the
forms to the last.

Scale.  The vocabulary grows with the corpus and is never broadcast or
collected.  A word can only be near a query of length q that shares the exact
half with it, so words are placed by (scheme, q, half): once as a query and
under at most two lengths as an indexed word, for both schemes.  Places are
dealt by hash to shards of about ``SHARD_CHARS`` code points, each with an
index of its own.  A half with more than that in its place is split: indexed
words go to one of its blocks, queries to all of them, so a very common half
is many tasks and not one.  Every near pair is emitted once or twice, never the
pairs of a group.

Cases.  Null text: no runs.  Null doc_id: taken as empty in the hash that
spoils a run.  Empty table: empty result.  Repeated rows count each time.  Very
long words are words like any other; a shard's size is measured in code points
and one word is never cut.  Ties among forms: the smallest in code-point order.
Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetline.llm.common import attach, materialize
from fleetline.llm.fm_index import BidirectionalIndex, one_error

RUNS = r"[A-Za-zÀ-ÿ]"
MIN_LENGTH = 7
MIN_COUNT = 2
SPOILED_EVERY = 31
FORM_FACTOR = 10
SHARD_CHARS = 400_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def spoiled(doc_id: Column, run: Column) -> Column:
    """The run without one code point if ``SPOILED_EVERY`` divides the crc32
    of ``<doc_id>:<run>``, which also chooses the code point."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % SPOILED_EVERY == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) over the runs of all texts; ``docs`` has doc_id and text.

    Runs shorter than ``min_length`` cannot become words, as a run is only
    ever shortened, so the pattern skips them.
    """
    runs = F.regexp_extract_all(F.col("text"), F.lit("(%s{%d,})" % (RUNS, min_length)), F.lit(1))
    words = (docs.select("doc_id", F.explode(runs).alias("run"))
             .select(spoiled(F.col("doc_id"), F.translate("run", UPPER, LOWER)).alias("word"))
             .filter(F.length("word") >= min_length))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def places(words: DataFrame) -> DataFrame:
    """(word, n, first, length, asks, place): every word under the halves
    that a query near it shares with it.  ``asks``: the word is itself a query
    of that length.  ``place`` is a hash of scheme, length and half; halves of
    equal hash share a place, which changes nothing."""
    size = F.length("word")
    under = (words.withColumn("length", F.explode(F.array(size, size - 1)))
             .filter("length > 0").withColumn("first", F.explode(F.array(F.lit(True), F.lit(False)))))
    half = F.floor(F.col("length") / 2).cast("int")
    part = F.when(F.col("first"), F.substr("word", F.lit(1), half)).otherwise(
        F.expr("right(word, length - cast(floor(length / 2) as int))"))
    return under.select("word", "n", "first", "length", (F.col("length") == size).alias("asks"),
                        F.xxhash64("first", "length", part).alias("place"))


def shards(words: DataFrame, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``places`` with the shard (place, block) each row is searched in."""
    placed = places(words)
    chars = F.sum(F.length("word").cast("long") + 1)
    total = placed.agg(F.coalesce(chars, F.lit(0))).first()[0]
    crowded = materialize(placed.groupBy("place").agg(chars.alias("chars"))
                          .filter(F.col("chars") > shard_chars)
                          .select("place", F.ceil(F.col("chars") / shard_chars).cast("int").alias("blocks")),
                          "crowded-halves")
    spread = F.xxhash64("word")
    rows = attach(placed, crowded, ["place"], spread)
    split = F.col("blocks").isNotNull()
    own = F.pmod(spread, F.coalesce("blocks", F.lit(1))).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = F.pmod(F.col("place"), F.lit(1 + total // shard_chars))
    return (rows.withColumn("block", F.explode(F.when(split & F.col("asks"), every).otherwise(F.array(own))))
            .select("word", "n", "first", "length", "asks",
                    # An asking word is indexed in its own block only.
                    (F.col("block") == own).alias("indexed"),
                    F.when(split, F.col("place")).otherwise(dealt).alias("shard"),
                    F.when(split, F.col("block") + 1).otherwise(0).alias("block")))


def search(shard: pd.DataFrame) -> pd.DataFrame:
    """Near pairs of one shard: (word, n, near, near_n)."""
    indexed = shard[shard["indexed"]].drop_duplicates("word").sort_values("word")
    names, counts = indexed["word"].tolist(), indexed["n"].to_numpy(np.int64)
    words, n, near, near_n = [], [], [], []
    if names:
        index = BidirectionalIndex(names)
        asking = shard[shard["asks"]]
        for (first, _), group in asking.groupby(["first", "length"]):
            queries, times = group["word"].tolist(), group["n"].to_numpy(np.int64)
            asked, found = one_error(index, queries, bool(first))
            words += [queries[i] for i in asked]
            near += [names[i] for i in found]
            n.append(times[asked])
            near_n.append(counts[found])
    none = np.zeros(0, np.int64)
    return pd.DataFrame({"word": np.array(words, object), "n": np.concatenate([none, *n]),
                         "near": np.array(near, object), "near_n": np.concatenate([none, *near_n])})


def near_pairs(words: DataFrame, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(word, n, near, near_n) for both directions of every near pair."""
    found = shards(words, shard_chars).groupBy("shard", "block").applyInPandas(
        search, "word string, n long, near string, near_n long")
    mirrored = F.explode(F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"),
                 F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return found.select(mirrored.alias("pair")).select("pair.*").distinct()


def forms_of(pairs: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, n_near, form, form_n) of the words that have near words."""
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("near")))
    enough = -F.col("best.rank") >= factor * F.col("n")
    return (pairs.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
            .select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"),
                    F.when(enough, -F.col("best.rank")).alias("form_n")))


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form.  A form's count is a
    multiple of its word's, so chains are as short as the counts' logarithm;
    every step is a join, written before the next."""
    steps = forms.filter("form is not null").select("word", "form")
    ahead = steps.select(F.col("word").alias("root"), F.col("form").alias("next"))
    done, open_ = [], steps.select("word", F.col("form").alias("root"))
    while True:
        moved = materialize(open_.join(ahead, "root", "left"), "spelling-roots")
        done.append(moved.filter("next is null").select("word", "root"))
        open_ = moved.filter("next is not null").select("word", F.col("next").alias("root"))
        if open_.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def group_spellings(docs: DataFrame, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs``."""
    words = materialize(vocabulary(docs), "spelling-words")
    pairs = near_pairs(words, shard_chars)
    forms = materialize(forms_of(pairs), "spelling-forms")
    roots = roots_of(forms)
    return (words.join(forms, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))

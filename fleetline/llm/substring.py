"""Substring dedup behind a count-min prefilter (operator 6).

Rule.  A window is ``WINDOW`` consecutive words of one document.  Every word
covered by a window whose word sequence also starts in a document with a
smaller doc_id is removed; windows are judged on the input.

Method.  Documents are dealt to chunks of about ``CHUNK_BYTES`` by hash.

1. Each chunk sketches its windows and the sketches are merged by cell.  A count-min sketch that tells repeats from chance must
   grow with the corpus, so none is held whole anywhere: a chunk sends the
   sorted cells it hits, two bytes each, one list per row and range of cells;
   a range's task adds the lists and answers each chunk with those of its
   cells that were hit at least twice.  Counts are never too low, so no
   repeated window is lost.
2. A chunk's windows whose cells are repeated in every row of the sketch are
   grouped exactly, by 128-bit hash, again as packed lists per hash range: the
   range's task finds each window's smallest doc_id and answers the chunks in
   which it is not the smallest.
3. Each chunk marks the windows that start in a smaller document, within the
   chunk or outside it, and removes the words they cover.

Scale.  Three passes shuffle the texts by chunk, one at a time (shuffle files
are dropped after each); a task holds one chunk or one range.  A frequent
window is one cell and one key per chunk, however often it occurs.

Cases.  Null or empty text: no words.  Null doc_id: larger than any id.
Repeated rows with one doc_id: none is smaller, they keep their common
windows.  Fewer words than a window: nothing removed.  Empty table: empty
result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetline.llm.common import materialize

WINDOW = 13
CHUNK_BYTES = 4 << 20
ROWS = 2
#: Cells in a range (2 ** 25, see ``cells``) and chunks to a range: about
#: twelve cells to a window.
RANGE_CELLS = 1 << 25
CHUNKS_PER_RANGE = 4
NO_ID = np.iinfo(np.int64).max
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
CACHE_WORDS = 300_000
_WORDS: dict[bytes, int] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_WORDS) > CACHE_WORDS:
        _WORDS.clear()
    for w in set(words).difference(_WORDS):
        _WORDS[w] = xxhash.xxh64_intdigest(w)
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


class Chunk:
    """Words and window hashes of a chunk's documents."""

    def __init__(self, frame: pd.DataFrame, window: int):
        self.ids = np.array([NO_ID if pd.isna(i) else int(i) for i in frame["doc_id"]], np.int64)
        self.words, sizes = [], []
        for text in frame["text"]:
            found = text.encode().split() if isinstance(text, str) else []
            self.words += found
            sizes.append(len(found))
        self.sizes, self.window = np.array(sizes, np.int64), window
        self.ends = np.cumsum(self.sizes)
        self.hashes = word_hashes(self.words)
        n = max(0, len(self.words) - window + 1)
        doc = np.repeat(np.arange(len(sizes)), self.sizes)[:n]
        self.starts = np.flatnonzero(self.ends[doc] - np.arange(n) >= window)
        self.owner = self.ids[doc[self.starts]]
        self.key = mixed(self._sum(FACTORS[0], lambda k: self.hashes[k:k + n])[self.starts])

    def _sum(self, factor: int, words_at) -> np.ndarray:
        h, power = np.zeros(len(words_at(0)), np.uint64), 1
        for k in range(self.window):
            h += words_at(k) * np.uint64(power)
            power = power * factor % (1 << 64)
        return h

    def records(self, at: np.ndarray) -> np.ndarray:
        """Windows ``at`` with both hashes and their document."""
        out = np.zeros(len(at), RECORD)
        first = self.starts[at]
        out["a"], out["doc"] = self.key[at], self.owner[at]
        out["b"] = mixed(self._sum(FACTORS[1], lambda k: self.hashes[first + k]))
        return out


def cells(key: np.ndarray, row: int, ranges: int) -> np.ndarray:
    """Cells (range x RANGE_CELLS + place in it) of windows in a sketch row."""
    h = mixed(key + np.uint64(FACTORS[1] * (row + 1) % (1 << 64)))
    return ((h % np.uint64(ranges)) << np.uint64(25) | h >> np.uint64(39)).astype(np.int64)


def squeezed(values: np.ndarray) -> bytes:
    """Sorted values as 16-bit steps; 65535 stands for a step without value."""
    steps = np.diff(values, prepend=0)
    jumps, rest = steps // 65535, steps % 65535
    out = np.full(len(steps) + int(jumps.sum()), 65535, "<u2")
    out[np.arange(len(steps)) + np.cumsum(jumps)] = rest
    return out.tobytes()


def unsqueezed(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, "<u2")
    return np.cumsum(steps, dtype=np.int64)[steps != 65535]


def by_range(ranges: np.ndarray):
    """(range, slice) of the runs in sorted ranges."""
    hit, first = np.unique(ranges, return_index=True)
    return zip(hit.tolist(), map(slice, first, [*first[1:], len(ranges)]))


RECORD = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8")])
LISTS = "row int, range long, chunk long, payload binary"


def lists(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["row", "range", "chunk", "payload"])


def sketch_of(frame: pd.DataFrame, window: int, rows: int, ranges: int) -> pd.DataFrame:
    key, out = Chunk(frame, window).key, []
    for row in range(rows):
        hit = np.sort(cells(key, row, ranges))
        out += [(row, r, int(frame["chunk"].iloc[0]), squeezed(hit[at] % RANGE_CELLS))
                for r, at in by_range(hit // RANGE_CELLS)]
    return lists(out)


def repeated_cells(frame: pd.DataFrame) -> pd.DataFrame:
    """Answers of a range: for each chunk, its cells with a count over one."""
    parts = [unsqueezed(p) for p in frame["payload"]]
    both = np.sort(np.concatenate(parts))
    again = np.unique(both[1:][both[1:] == both[:-1]])
    out = []
    for row, r, chunk, mine in zip(frame["row"], frame["range"], frame["chunk"], parts):
        mine = np.unique(mine)
        at = np.searchsorted(again, mine)
        found = mine[again[np.minimum(at, len(again) - 1)] == mine] if len(again) else mine[:0]
        if len(found):
            out.append((row, r, chunk, squeezed(found)))
    return lists(out)


def among(values: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values


def estimated_repeated(chunk: Chunk, answers: pd.DataFrame, rows: int, ranges: int) -> np.ndarray:
    """Windows whose cell is repeated in every row."""
    passed = np.arange(len(chunk.key))
    for row in range(rows):
        mine = answers[answers["row"] == row]
        parts = [unsqueezed(p) + int(r) * RANGE_CELLS for r, p in zip(mine["range"], mine["payload"])]
        known = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        passed = passed[among(cells(chunk.key[passed], row, ranges), known)]
    return passed


def by_key(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by key and doc, and where a new key begins in it."""
    order = np.lexsort((records["doc"], records["b"], records["a"]))
    a, b = records["a"][order], records["b"][order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, new


def least_docs(records: np.ndarray) -> np.ndarray:
    """For every record the smallest doc of its key."""
    order, new = by_key(records)
    out = np.empty(len(records), np.int64)
    out[order] = records["doc"][order][new][np.cumsum(new) - 1]
    return out


def candidates_of(frame: pd.DataFrame, window: int, rows: int, ranges: int) -> pd.DataFrame:
    answer = frame["payload"].notna().to_numpy()
    chunk = Chunk(frame[~answer], window)
    records = chunk.records(estimated_repeated(chunk, frame[answer], rows, ranges))
    order, new = by_key(records)
    records = records[order[new]]
    part = (records["a"] % np.uint64(ranges)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return lists([(0, r, int(frame["chunk"].iloc[0]), records[order[at]].tobytes())
                  for r, at in by_range(part[order])])


def smaller_elsewhere(frame: pd.DataFrame) -> pd.DataFrame:
    """Answers of a range: for each chunk, its windows with a smaller doc_id
    in another chunk, and that doc_id."""
    parts = [np.frombuffer(p, RECORD) for p in frame["payload"]]
    records = np.concatenate(parts)
    source = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    least = least_docs(records)
    told = least < records["doc"]
    records, source = records[told], source[told]
    records["doc"] = least[told]
    return lists([(0, int(frame["range"].iloc[k]), int(frame["chunk"].iloc[k]), records[source == k].tobytes())
                  for k in np.unique(source).tolist()])


def removed_words(frame: pd.DataFrame, window: int, keep_text: bool) -> pd.DataFrame:
    answer = frame["payload"].notna().to_numpy()
    chunk = Chunk(frame[~answer], window)
    told = np.concatenate([np.zeros(0, RECORD), *[np.frombuffer(p, RECORD) for p in frame["payload"][answer]]])
    # Only windows met twice in the chunk, or told of, can have to go.
    ordered = np.sort(chunk.key)
    again = np.unique(np.concatenate([ordered[1:][ordered[1:] == ordered[:-1]], told["a"]]))
    at = np.flatnonzero(among(chunk.key, again))
    mine = chunk.records(at)
    gone = chunk.starts[at[least_docs(np.concatenate([told, mine]))[len(told):] < mine["doc"]]]
    marks = np.zeros(len(chunk.words) + window + 1, np.int64)
    np.add.at(marks, gone, 1)
    np.add.at(marks, gone + window, -1)
    covered, out = np.cumsum(marks) > 0, []
    for doc_id, size, end in zip(chunk.ids.tolist(), chunk.sizes.tolist(), chunk.ends.tolist()):
        words, marked = chunk.words[end - size:end], covered[end - size:end]
        kept = b" ".join([w for w, c in zip(words, marked.tolist()) if not c]) if marked.any() else b" ".join(words)
        out.append((None if doc_id == NO_ID else doc_id, size, int(marked.sum()),
                    hashlib.sha256(kept).hexdigest(), *((kept.decode(),) if keep_text else ())))
    result = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["text"] * keep_text)
    result["doc_id"] = result["doc_id"].astype("Int64")
    return result


def drop_repeats(docs: DataFrame, window: int = WINDOW, rows: int = ROWS,
                 chunk_bytes: int = CHUNK_BYTES, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, text]) for every document;
    ``text``: the kept words joined by one space."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    chunks = max(1, math.ceil(size / chunk_bytes))
    ranges = max(1, math.ceil(chunks / CHUNKS_PER_RANGE))
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    with_answers = lambda answers: dealt.withColumns({
        "row": F.lit(None).cast("int"), "range": F.lit(None).cast("long"),
        "payload": F.lit(None).cast("binary")}).unionByName(answers, allowMissingColumns=True).groupBy("chunk")
    sketches = dealt.groupBy("chunk").applyInPandas(lambda f: sketch_of(f, window, rows, ranges), LISTS)
    cells_again = materialize(sketches.groupBy("row", "range").applyInPandas(repeated_cells, LISTS), "sketch")
    candidates = with_answers(cells_again).applyInPandas(
        lambda f: candidates_of(f, window, rows, ranges), LISTS)
    smaller = materialize(candidates.groupBy("range").applyInPandas(smaller_elsewhere, LISTS), "repeats")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * keep_text
    return with_answers(smaller).applyInPandas(lambda f: removed_words(f, window, keep_text), schema)

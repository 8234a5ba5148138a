"""Best-fit packing by bin completion (operator 3).

Method.  Documents are tokenised and cut into pieces of at most ``capacity``
tokens.  How many pieces there are of each length is all that packing needs,
and there are at most ``capacity`` lengths, so the plan is made over that
histogram, for the whole corpus at once, whatever its size.  Bin completion
takes the largest length left and fills the room beside it:

* the first incumbent is the best-fit dive (always the longest piece that
  fits), each filling used as often as its pieces last;
* if it needs more bins than the lower bound, a branch and bound enumerates
  the undominated fillings around the largest piece, least waste first, and
  drops every branch whose waste so far exceeds what a better solution may
  waste; a better solution becomes the incumbent, and the search ends at the
  lower bound or after ``nodes`` steps with the incumbent it has.

Pieces are then numbered within their length (in hash buckets, so a common
length is spread over tasks) and the number finds the place in the plan.  The
plan has at most sum(capacity / length) fillings: each use exhausts a length
or lowers its copies per filling.  That bounds what is sent to the tasks.

Tokens.  Text between blanks, tabs and line ends is tokenised on its own:
this vocabulary drops white space and no token spans it.  Each task keeps a
bounded table of the strings it has met.

Cases.  Null or empty text: one piece with the end id alone.  Repeated rows
are separate documents; each gets its own places.  Empty table: empty result.
"""

from __future__ import annotations

import math
import os
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetline.llm.common import materialize, short_batches, slices
from fleetline.operators.sequence import dense_sequence

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
NODES = 200_000
#: Fillings of up to this many pieces are enumerated one by one.
DEPTH = 8
BUCKET_ROWS = 20_000
CACHE_STRINGS = 500_000
CACHE_CHARS = 64
LEARN_STRINGS = 2000


class Encoder:
    """Token ids of whole texts as little-endian uint32 bytes.

    Strings met are kept in two generations of ``CACHE_STRINGS``; a string of
    the older one that comes again moves to the younger.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.known, self.older = {"": b""}, {}

    def learn(self, strings: list[str]) -> dict[str, bytes]:
        """Ids of strings, tokenised as one text of them with blanks between:
        a token belongs to the string its first character lies in."""
        out: dict[str, bytes] = {}
        for at in range(0, len(strings), LEARN_STRINGS):
            part = strings[at:at + LEARN_STRINGS]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            begins = np.fromiter((begin for begin, _ in found.offsets), np.int64, len(found))
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            cuts = (4 * np.searchsorted(begins, ends)).tolist()
            ids, before = np.asarray(found.ids, "<u4").tobytes(), 0
            for string, cut in zip(part, cuts):
                out[string] = ids[before:cut]
                before = cut
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        parts = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        missing = set().union(*parts).difference(self.known)
        back = missing.intersection(self.older)
        self.known.update((s, self.older[s]) for s in back)
        # The vocabulary is in lower case: two spellings of ASCII strings have the same ids.
        lower = {s: s.lower() if s.isascii() else s for s in missing - back}
        self.known.update(self.learn(list(set(lower.values()).difference(self.known))))
        self.known.update((s, self.known[name]) for s, name in lower.items())
        out = [b"".join(map(self.known.__getitem__, p)) for p in parts]
        for s in missing.union(lower.values()):
            if len(s) > CACHE_CHARS:
                self.known.pop(s, None)
        if len(self.known) > CACHE_STRINGS:
            self.older, self.known = self.known, {"": b""}
        return out


#: One encoder per worker process and vocabulary; what it has met stays useful
#: for the process's next tasks.
_ENCODERS: dict[str, Encoder] = {}


def encoder_for(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
           end_id: int = END_ID, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) for every document."""
    path = path or public_tokenizers.path(VOCABULARY)
    short_batches(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = encoder_for(path), np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            out = []
            found = (ids for texts in slices(batch["text"]) for ids in encoder.encode(texts))
            for doc_id, ids in zip(batch["doc_id"], found):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))
                               + ((part,) if keep_ids else ()))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"]
                                 + ["ids"] * keep_ids)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, schema)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs: by volume, and by the pieces that cannot
    share a bin with those of more than ``capacity - t``, for each t."""
    number, volume = [0] * (capacity + 2), [0] * (capacity + 2)     # of lengths below i
    for i in range(capacity + 1):
        number[i + 1] = number[i] + counts.get(i, 0)
        volume[i + 1] = volume[i] + i * counts.get(i, 0)
    best, half = math.ceil(volume[-1] / capacity), capacity // 2
    for t in [0, *[n for n in counts if n <= half]]:
        middle = number[capacity - t + 1] - number[half + 1]
        room = middle * capacity - (volume[capacity - t + 1] - volume[half + 1])
        left = volume[half + 1] - volume[t] - room
        best = max(best, number[-1] - number[half + 1] + max(0, math.ceil(left / capacity)))
    return best


def fullest(left: dict[int, int], present: list[int], room: int, top: int) -> list[tuple[int, int]]:
    """The best-fit filling with pieces up to place ``top`` of ``present``:
    again and again the longest piece that fits."""
    filling = []
    at = min(top, bisect_right(present, room) - 1)
    while at >= 0:
        length = present[at]
        copies = min(left[length], room // length)
        if copies > 0:
            filling.append((length, copies))
            room -= copies * length
            if not room:
                break
        at = min(at - 1, bisect_right(present, room) - 1)
    return filling


def fillings_of(left: dict[int, int], present: list[int], room: int, top: int, budget: list[int],
                depth: int = 0) -> Iterator[tuple[int, list]]:
    """(waste, filling) of ``room`` with pieces up to place ``top``, the best
    fit first; beyond ``DEPTH`` pieces only the best fit of the rest."""
    top = min(top, bisect_right(present, room) - 1)
    if depth >= DEPTH:
        budget[0] -= 1
        rest = fullest(left, present, room, top)
        yield room - sum(n * c for n, c in rest), rest
        return
    fits = False
    for at in range(top, -1, -1):
        length = present[at]
        if left[length] > 0 and budget[0] > 0:
            fits = True
            left[length] -= 1
            for waste, rest in fillings_of(left, present, room - length, at, budget, depth + 1):
                left[length] += 1
                yield waste, [(length, 1), *rest]
                left[length] -= 1
            left[length] += 1
    if not fits:
        budget[0] -= 1
        yield room, []


def merged(filling: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: dict[int, int] = {}
    for length, copies in filling:
        out[length] = out.get(length, 0) + copies
    return sorted(out.items(), reverse=True)


def dominated(items: list[int], by: list[int]) -> bool:
    """Piece by piece no longer than those of ``by``."""
    return len(items) <= len(by) and all(a <= b for a, b in zip(items, by))


def undominated(left: dict[int, int], present: list[int], room: int, slack: int, budget: list[int],
                look: int = 256) -> Iterator[list[tuple[int, int]]]:
    """Fillings of ``room`` with at most ``slack`` waste that none listed before
    dominates.  They come in runs of ``look``, least waste first within a run,
    and a filling without waste at once: the search seldom needs more.  One
    dominates another if its pieces can take the place of the other's; tested
    are pieces one by one, and all pieces against the longest single one."""
    kept: list[list[int]] = []
    run: list[tuple[int, list]] = []

    def fresh(filling) -> bool:
        items = [n for n, c in filling for _ in range(c)]
        budget[0] -= len(kept) // 16        # what the tests cost, against a listing's own step
        if any(dominated(items, k) for k in kept) or (kept and len(kept[0]) and sum(items) <= kept[0][0]):
            return False
        kept.append(items)
        return True

    for waste, filling in fillings_of(left, present, room, len(present) - 1, budget):
        if waste > slack:
            continue
        if waste == 0:
            if fresh(merged(filling)):
                yield merged(filling)
            continue
        run.append((waste, merged(filling)))
        if len(run) == look:
            yield from (f for _, f in sorted(run, key=lambda x: x[0]) if fresh(f))
            run = []
    yield from (f for _, f in sorted(run, key=lambda x: x[0]) if fresh(f))


def take(left: dict[int, int], present: list[int], filling: list[tuple[int, int]], times: int) -> None:
    for length, copies in filling:
        left[length] -= copies * times
        if not left[length]:
            present.remove(length)


def put_back(left: dict[int, int], present: list[int], filling: list[tuple[int, int]], times: int) -> None:
    for length, copies in filling:
        if not left[length]:
            insort(present, length)
        left[length] += copies * times


def dive(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best-fit solution: (times, filling) with fillings as (length, copies)."""
    left, present, out = dict(counts), sorted(counts), []
    while present:
        largest = present[-1]
        left[largest] -= 1
        bin_ = merged([(largest, 1), *fullest(left, present, capacity - largest, len(present) - 1)])
        left[largest] += 1
        times = min(left[n] // c for n, c in bin_)
        take(left, present, bin_, times)
        out.append((times, bin_))
    return out


def bin_completion(counts: dict[int, int], capacity: int,
                   nodes: int = NODES) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing of a histogram of lengths as (times, filling) rows."""
    counts = {n: c for n, c in counts.items() if c > 0}
    if not counts:
        return []
    best = dive(counts, capacity)
    bins, bound = sum(t for t, _ in best), lower_bound(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    left, present = dict(counts), sorted(counts)
    path: list[tuple[int, list[tuple[int, int]]]] = []

    def branches():
        largest = present[-1]
        slack = (bins - 1) * capacity - total - waste
        fillings = undominated(left, present, capacity - largest, slack, budget)
        while True:
            left[largest] -= 1
            filling = next(fillings, None)
            left[largest] += 1
            if filling is None:
                return
            bin_ = merged([(largest, 1), *filling])
            most = min(left[n] // c for n, c in bin_)
            for times in dict.fromkeys((most, 1)):
                yield times, bin_

    used = waste = 0
    budget = [nodes]
    stack = [branches()] if bins > bound else []
    while stack and bins > bound and budget[0] > 0:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if path:
                times, bin_ = path.pop()
                put_back(left, present, bin_, times)
                used -= times
                waste -= times * (capacity - sum(n * c for n, c in bin_))
            continue
        budget[0] -= 1
        times, bin_ = step
        more = times * (capacity - sum(n * c for n, c in bin_))
        if waste + more > (bins - 1) * capacity - total or used + times >= bins:
            continue
        take(left, present, bin_, times)
        used, waste = used + times, waste + more
        path.append((times, bin_))
        if not present:
            best, bins = list(path), used
            path.pop()
            put_back(left, present, bin_, times)
            used, waste = used - times, waste - more
        else:
            stack.append(branches())
    if path and bins > bound and budget[0] <= 0:
        # The steps are used up: a best-fit dive completes the branch at hand.
        branch = path + dive({n: left[n] for n in present}, capacity)
        if sum(t for t, _ in branch) < bins:
            best = branch
    return best


def places(plan: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first number, copies, first sequence, offset) of a plan,
    sorted by length and number."""
    rows, numbers, sequence = [], {}, 0
    for times, filling in plan:
        offset = 0
        for length, copies in filling:
            start = numbers.get(length, 0)
            rows.append((length, start, copies, sequence, offset))
            numbers[length] = start + copies * times
            offset += copies * length
        sequence += times
    return np.asarray(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, nodes: int = NODES, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``."""
    cut = materialize(pieces(docs, path, capacity, end_id, keep_ids), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}      # at most ``capacity`` rows
    plan = places(bin_completion(histogram, capacity, nodes))
    keys = (plan[:, 0] << 44) + plan[:, 1]
    buckets = math.ceil(sum(histogram.values()) / BUCKET_ROWS) or 1
    order = ["_b", "doc_id", "piece", "ids_crc32"]
    cut = cut.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    numbered = dense_sequence(cut, ["length"], order, F.col("_b"), "_number").drop("_b")
    columns = [c for c in numbered.columns if c != "_number"]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, number = (batch[c].to_numpy(np.int64) for c in ("length", "_number"))
            row = plan[np.searchsorted(keys, (length << 44) + number, side="right") - 1]
            at = number - row[:, 1]
            out = batch[columns].copy()
            out["doc_id"] = out["doc_id"].astype("Int64")
            out["sequence_id"] = row[:, 3] + at // row[:, 2]
            out["offset"] = row[:, 4] + at % row[:, 2] * length
            yield out

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema
                       if f.name != "_number") + ", sequence_id long, offset long"
    return numbered.mapInPandas(place, schema)

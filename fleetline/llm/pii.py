"""PII by bootstrapped contextual extraction (operator 5).

Method.  Fixed expressions find the base entities of four kinds; these are the
seeds.  The one and two words before an entity are its lexical patterns.
Looser expressions propose candidates, strings shaped like an identifier that
no base rule accepts, with the patterns before them (``shapes``).  Spark
scores the graph of patterns and instances.  A pattern scores the mean over all
its occurrences in the corpus (``PRIOR`` empty ones added): one that a seed
follows counts 1, one that no identifier follows counts 0, so words of running
prose score near 0.  One that a candidate follows counts the best score among
the other patterns of that instance; patterns with the same last word, which
stand at the same place, do not vouch for each other.  ``ROUNDS`` times in
turn.  Candidates after a pattern that scores ``CONFIDENCE`` or more and has
met ``SUPPORT`` different seeds are taken as spans of the pattern's kind.  Base
spans always stay.

Scale.  Texts are read in one pass that yields a few short rows a document,
and in a second one that counts how often the patterns with enough seeds occur
outside identifiers; edges are counted before any join, so a frequent pattern
or instance is one row a task; the texts are never shuffled for the scoring.
The expressions run in linear time also on long runs of digits or letters.

Cases.  Null text: empty, no span.  Overlapping spans of different kinds are
all listed; redaction merges them.  Repeated rows are each reported; an
instance counts once however often it is repeated.  Empty table: empty result.
Input columns named like a result column are replaced by it.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetline.llm.common import BROADCAST_ROWS, attach, materialize, packed, short_batches, unpacked

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
PRIOR = 1.0
CONFIDENCE = 0.7
SUPPORT = 3
CONTEXT_CHARS = 80

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
#: Parts of candidates; linear, each starts at a fixed character class.
AT = re.compile(r" ?[(\[{]at[)\]}] ?| at | ?@ ?", re.A | re.I)
HOST = re.compile(r"[A-Za-z0-9-]{1,64}+(?:(?: ?[(\[{]dot[)\]}] ?| dot |\.)[A-Za-z0-9-]{1,64}+)*+", re.A | re.I)
QUADS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
HEX = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
NUMBER = re.compile(r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[\x20().\-/]{0,2}[0-9])++")
#: Digits of a number that may be of the kind.
DIGIT_RANGES = {"card": (12, 19), "phone": (6, 17)}
LOCAL_CHARS = 64
WORD = re.compile(r"[^\W\d_]+")
FOUND = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
         "base array<struct<start:int,rank:int,end:int>>, "
         "seen array<struct<kind:string,start:int,end:int,seed:boolean,instance:string,patterns:array<string>>>")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain: found from each @ backwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end), sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    if DIGITS.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = "".join(DIGITS.findall(m[0])) if m.end() - m.start() <= 64 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                if 10 <= len(DIGITS.findall(m[0])) <= 15]
    return sorted(out)


def patterns(text: str, start: int) -> list[str]:
    words = WORD.findall(text[max(0, start - CONTEXT_CHARS):start].lower())[-2:]
    return [" ".join(words[k:]) for k in range(len(words))]


def shapes(text: str) -> Iterator[tuple[str, int, int]]:
    """(kind, start, end) of strings shaped like an identifier; a number may
    be proposed for several kinds.

    email: name, ``@`` or a bracketed ``at`` (any case, blanks around), host
    with or without a dot; or `` at `` before a host with a spelt-out dot or
    one without blanks.  ip: four numbers with dots, or three to eight hex
    groups with colons, empty ones too.  card, phone: digits by
    ``DIGIT_RANGES``, alone or with up to two of blank, dot, dash, slash,
    brackets between.
    """
    done = 0
    for m in AT.finditer(text) if "@" in text or "at" in text or "AT" in text or "At" in text else ():
        start = m.start()
        while start > max(done, m.start() - LOCAL_CHARS) and text[start - 1] in LOCAL:
            start -= 1
        host = HOST.match(text, m.end()) if start < m.start() else None
        dotted = host and ("." in host[0] or "dot" in host[0].lower())
        if host and (dotted or m[0].strip().lower() != "at"):
            done = host.end()
            yield "email", start, done
    if DIGITS.search(text):
        for m in QUADS.finditer(text):
            yield "ip", *m.span()
    if text.count(":") > 1:
        for m in HEX.finditer(text):
            if m[0].strip(":"):
                yield "ip", *m.span()
    if DIGITS.search(text):
        for m in NUMBER.finditer(text):
            n = sum(map(str.isdigit, m[0]))
            for kind, (least, most) in DIGIT_RANGES.items():
                if least <= n <= most:
                    yield kind, *m.span()


def scanned(text: str | None) -> tuple:
    text = text if isinstance(text, str) else ""
    base = base_spans(text)
    listed = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
    seen = [(KINDS[k], a, b, True, text[a:b].lower(), patterns(text, a)) for a, k, b in base]
    starts, ends = [a for a, _, _ in base], []
    for _, _, b in base:
        ends.append(max(b, ends[-1]) if ends else b)
    last: dict[str, int] = {}
    for kind, a, b in sorted(shapes(text)):
        before = bisect_right(starts, b - 1)        # base spans that start before the end
        if a >= last.get(kind, 0) and not (before and ends[before - 1] > a):
            last[kind] = b
            seen.append((kind, a, b, False, text[a:b].lower(), patterns(text, a)))
    counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
    return (*counts, hashlib.sha256(listed.encode()).hexdigest(), base, seen)


def scan_batch(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([scanned(t) for t in texts], columns=[
        "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "seen"])


def outside(text: str, spans) -> list[str]:
    """Lower-case words of a text without the given spans."""
    out, done = [], 0
    for a, b in sorted(spans):
        if a >= done:
            out.append(text[done:a])
        done = max(done, b)
    return WORD.findall(" ".join([*out, text[done:]]).lower())


def occurrences(rows: DataFrame, wanted: DataFrame, at_most: int = BROADCAST_ROWS) -> DataFrame:
    """(pattern, n) how often the patterns of ``wanted`` stand in the texts
    outside identifiers; other patterns may be listed too.  Up to ``at_most``
    patterns go to the tasks; of more, all words and pairs are counted."""
    some = [r["pattern"] for r in wanted.limit(at_most + 1).collect()]
    known = frozenset(some) if len(some) <= at_most else None
    pairs = known is None or any(" " in p for p in known)
    seconds = None if known is None else frozenset(p.split(" ")[1] for p in known if " " in p)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter[str] = Counter()
            for text, seen in zip(batch["in_text"], batch["spans"]):
                words = outside(text, [(s["start"], s["end"]) for s in seen]) if isinstance(text, str) else []
                found.update(words if known is None else filter(known.__contains__, words))
                if pairs:
                    both = (f"{a} {b}" for a, b in zip(words, words[1:]) if seconds is None or b in seconds)
                    found.update(both if known is None else filter(known.__contains__, both))
            if found:
                yield pd.DataFrame({"pattern": pd.Series(list(found), dtype=object), "n": list(found.values())})

    spans = F.transform("seen", lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end")))
    return rows.select("in_text", spans.alias("spans")).mapInPandas(count, "pattern string, n long").groupBy(
        "pattern").agg(F.sum("n").alias("n"))


def pattern_scores(rows: DataFrame, seen: DataFrame, support: int = SUPPORT, rounds: int = ROUNDS) -> DataFrame:
    """(kind, pattern, score, seeds) of the patterns with ``support`` seeds,
    from rows (kind, seed, instance, pattern)."""
    edges = materialize(seen.groupBy("kind", "pattern", "instance").agg(
        F.max("seed").alias("seed"), F.count(F.lit(1)).alias("times")), "pii-graph")
    met = materialize(edges.groupBy("kind", "pattern").agg(
        F.sum(F.col("seed").cast("long")).alias("seeds"), F.sum("times").alias("followed"))
        .filter(F.col("seeds") >= support), "pii-met")
    total = occurrences(rows, met.select("pattern").distinct())
    met = materialize(met.join(total, "pattern", "left").withColumn(
        "n", F.greatest(F.coalesce("n", F.lit(0)), "followed")).drop("followed"), "pii-totals")
    edges = materialize(attach(edges, met, ["kind", "pattern"], F.xxhash64("instance"), "inner").withColumn(
        "word", F.substring_index("pattern", " ", -1)), "pii-edges")
    vouched = edges.withColumn("s", F.when(F.col("seed"), 1.0).otherwise(0.0))
    for _ in range(rounds):
        scored = materialize(vouched.groupBy("kind", "pattern").agg(
            (F.sum(F.col("s") * F.col("times")) / (F.max("n") + PRIOR)).alias("score"),
            F.max("seeds").alias("seeds")), "pii-patterns")
        # The best pattern of each instance, and the best one with another last word.
        words = (edges.filter("not seed").join(scored.select("kind", "pattern", "score"), ["kind", "pattern"])
                 .groupBy("kind", "instance", "word").agg(F.max("score").alias("score")))
        words = materialize(words, "pii-words")
        top = words.groupBy("kind", "instance").agg(F.max(F.struct("score", "word")).alias("top"))
        best = (words.join(top, ["kind", "instance"]).groupBy("kind", "instance").agg(
            F.first("top").alias("top"),
            F.max(F.when(F.col("word") != F.col("top.word"), F.col("score"))).alias("next")))
        vouched = edges.join(best, ["kind", "instance"], "left").withColumn("s", F.when(F.col("seed"), 1.0).otherwise(
            F.coalesce(F.when(F.col("word") != F.col("top.word"), F.col("top.score")).otherwise(F.col("next")),
                       F.lit(0.0))))
    return scored


def find(docs: DataFrame, confidence: float = CONFIDENCE, support: int = SUPPORT) -> DataFrame:
    """All rows of ``docs`` (``text`` used) with the counts and digest of the
    base spans and ``all_spans``: array of (start, rank of the kind, end)."""
    short_batches(docs.sparkSession)
    rows = materialize(packed(docs).withColumn("_f", F.pandas_udf(scan_batch, FOUND)(F.col("in_text"))).select("*", "_f.*").drop("_f")
                       .withColumn("_rid", F.monotonically_increasing_id()), "pii")
    seen = (rows.select("_rid", F.explode("seen").alias("e")).select("_rid", "e.*")
            .withColumn("pattern", F.explode("patterns")).drop("patterns"))
    trusted = pattern_scores(rows, seen.select("kind", "seed", "instance", "pattern"), support).filter(
        F.col("score") >= confidence).select("kind", "pattern")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    added = (seen.filter("not seed").join(trusted, ["kind", "pattern"])
             .select("_rid", F.struct("start", rank.alias("rank"), "end").alias("span")).distinct()
             .groupBy("_rid").agg(F.collect_list("span").alias("_added")))
    out = attach(rows, materialize(added, "pii-added"), ["_rid"], F.col("_rid"))
    spans = F.array_sort(F.concat("base", F.coalesce("_added", F.array().cast(
        "array<struct<start:int,rank:int,end:int>>"))))
    return out.withColumn("all_spans", spans).select(*unpacked(docs.columns, [
        "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "all_spans"]))


def spans_text(spans):
    """kind:start:end by start, then kind as listed, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask_batch(texts: pd.Series, spans: pd.Series) -> pd.Series:
    """Texts with each run of overlapping spans replaced by [KIND] of its first."""
    def one(text, found):
        out, done = [], 0
        for s in sorted(found, key=lambda s: (s["start"], s["rank"])):
            if s["start"] >= done:
                out += [text[done:s["start"]], f"[{KINDS[s['rank']].upper()}]"]
            done = max(done, s["end"])
        return "".join(out) + text[done:]
    return pd.Series([t if not isinstance(t, str) or not len(f) else one(t, f) for t, f in zip(texts, spans)],
                     dtype=object)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind, as [EMAIL]."""
    found = find(docs)
    return found.withColumn("text", F.when(F.size("all_spans") > 0, F.pandas_udf(mask_batch, "string")("text", "all_spans"))
                            .otherwise(F.col("text"))).select(*docs.columns)

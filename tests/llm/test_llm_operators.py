"""The training-data operators against brute force, and on edge rows."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from fleetline.llm import (components, embeddings, langid, mixing, packing, pii, quality_rules, simhash,
                           substring, url_reputation, warc)
from fleetline.llm.common import attach, materialize
from fleetline.llm.registry import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import rows_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 30_000 + "x" * 50_000
#: Nulls in every column, empty and blank texts, a long one, repeated rows.
EDGE = [(1, "Call +1 (415) 555-2671 or mail a.b@c.example now", "en", "s", 1), (2, "", "en", None, 0),
        (3, None, None, "s", None), (None, "some words here", "fr", "s", 3), (4, " \n\t ", "fr", "t", 3),
        (5, LONG, "en", "s", 1), (6, "12 34 !?", "de", "", 8), (7, "same text twice", "en", "s", 1),
        (7, "same text twice", "en", "s", 1), (8, "same text twice", "en", "s", 1)]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.collect()}


def edge(spark, extra=False):
    frame = spark.createDataFrame(EDGE, DOCS)
    clash = ["kept", "size", "taken", "target", "fingerprint", "component_id", "n_words", "position", "row",
             "_w", "node", "base", "seen", "all_spans", "n_email", "source_size", "copies"]
    return frame.select("*", *[F.lit("mine").alias(c) for c in clash]) if extra else frame


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


class Union(dict):
    def root(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self[max(a, b)] = min(a, b)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    frame = QUERIES[name](spark, SF_SMALL)
    cols = sorted(frame.columns)
    got = rows_of([tuple(r[c] for c in cols) for r in frame.collect()])
    found = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    assert got == rows_of([tuple(r[names.index(c)] for c in cols) for r in found.fetchall()])


OPERATORS = {
    "quality": quality_rules.judge,
    "simhash": simhash.link_documents,
    "copies": simhash.drop_near_copies,
    "pii": pii.find,
    "redact": pii.redact,
    "mix": mixing.mix,
    "schedule": mixing.schedule,
    "pack": packing.pack,
    "substring": substring.drop_repeats,
    "langid": langid.identify,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_edge_rows_clashing_names_and_empty_tables(spark, name):
    rows = OPERATORS[name](edge(spark, extra=True)).collect()
    if name not in ("copies", "schedule"):
        assert Counter(r["doc_id"] for r in rows if r["doc_id"] != 5) == Counter(
            r[0] for r in EDGE if r[0] != 5)
    assert OPERATORS[name](edge(spark).limit(0)).collect() == []


def test_quality_counts_of_edge_rows(spark):
    got = {r["doc_id"]: r for r in quality_rules.judge(edge(spark)).collect()}
    for i in (2, 3, 4):
        assert got[i]["n_words"] == got[i]["n_repeat_words"] == 0 and got[i]["base_failed"]
    assert got[5]["n_words"] == 30_001 and got[5]["n_repeat_words"] == 30_000 and not got[5]["kept"]


def test_quality_fences_follow_each_source(spark):
    rng = random.Random(3)
    text = lambda s: " ".join("".join(rng.choices("abcdefgh", k=5)) + "#" * (rng.random() < s) for _ in range(80))
    rows = [(i, text(0.6), "en", "symbols") for i in range(300)] + [
        (1000 + i, text(0.0), "en", "plain") for i in range(300)] + [(2000, text(0.6), "en", "plain")]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.judge(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in [*range(300), *range(1000, 1300)]) and not got[2000]


def test_quality_fence_of_lightly_repeating_source(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))

    def text(n, repeated):
        body = [word() for _ in range(n - repeated)]
        return " ".join(body + body[:repeated])     # each word of the run stands twice

    rows = [(i, text(1000, 3 if i % 3 == 0 else 0), "en", "s") for i in range(300)] + [(900, text(1000, 200), "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert sorted(got[i]["repeat_words_pm"] for i in range(300))[74:226:151] == [0, 6]
    assert got[900]["repeat_words_pm"] == 400 and not got[900]["base_failed"] and not got[900]["kept"]
    assert all(got[i]["kept"] for i in range(300))


def test_quality_fences_come_from_the_sketch(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(4, 6)))

    def text(symbols=0, copies=0):
        w = [word() + "#" * (i < symbols) for i in range(100)]
        lines = [" ".join(w[i:i + 10]) for i in range(0, 100, 10)]
        return "\n".join(lines + lines[:1] * copies)

    rows = [(i, text(), "en", "s") for i in range(300)] + [
        (900, text(symbols=30), "en", "s"), (901, text(copies=2), "en", "s"), (902, text(symbols=1), "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    assert got[900]["symbols_pm"] < 100 and not got[900]["kept"] and not got[900]["base_failed"]
    assert got[901]["dup_lines_pm"] < 200 and not got[901]["kept"] and not got[901]["base_failed"]
    assert got[902]["kept"] and sum(got[i]["kept"] for i in range(300)) >= 298


def test_bad_hosts_are_blocked_and_priors_reach_unlabelled_ones(spark):
    pages = [(i, f"https://h{i % 5}.bad.example/x/{i}") for i in range(200)] + [
        (1000 + i, f"http://h{i % 5}.good.example/x/{i}") for i in range(200)] + [
        (5000, "https://new.bad.example/"), (5001, None), (5002, "no url"), (5003, "HTTP://A@X.ORG:80"),
        (None, "http://WWW.Example.org/en/12?q")]
    outcomes = [(p, p < 1000) for p, _ in pages if p is not None and p < 5000] + [(0, None), (None, True)]
    got = {r["page_id"]: r for r in url_reputation.url_reputation(
        spark.createDataFrame(pages, "page_id long, url string"),
        spark.createDataFrame(outcomes, "page_id long, bad boolean")).collect()}
    assert {got[i]["verdict"] for i in range(200)} == {"block"}
    assert {got[1000 + i]["verdict"] for i in range(200)} == {"allow"}
    assert got[5000]["bad_mean"] > got[1000]["bad_mean"]
    assert (got[5001]["host"], got[5001]["path"], got[5002]["host"]) == ("", "", "")
    assert got[5003]["host"] == "a@x.org:80" and got[5003]["path"] == "" and got[5003]["rule"] is None
    assert (got[None]["rule"], got[None]["verdict"]) == ("example.org/en/1", "block")


def best_bins(items, capacity):
    best, items = [len(items)], sorted(items, reverse=True)

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins) if b >= items[i]}.values():
            bins[k] -= items[i]
            go(i + 1, bins)
            bins[k] += items[i]
        bins.append(capacity - items[i])
        go(i + 1, bins)
        bins.pop()

    go(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    rng, improved = random.Random(1), 0
    for k in range(600):
        capacity = rng.choice([10, 20, 60, 100])
        low, high = (1, capacity) if k % 2 else (max(1, capacity // 8), capacity // 2)
        counts = Counter(rng.randint(low, high) for _ in range(rng.randint(1, 10)))
        plan, used = packing.bin_completion(dict(counts), capacity), Counter()
        for times, filling in plan:
            assert sum(n * c for n, c in filling) <= capacity
            for n, c in filling:
                used[n] += times * c
        bins = sum(t for t, _ in plan)
        assert used == counts and bins == best_bins(list(counts.elements()), capacity)
        assert packing.lower_bound(dict(counts), capacity) <= bins
        improved += bins < sum(t for t, _ in packing.dive(dict(counts), capacity))
    assert improved


def test_packing_search_ends_on_many_lengths():
    rng = random.Random(3)
    counts = Counter(min(4096, 130 + int(rng.lognormvariate(6.3, 1.1))) for _ in range(20_000))
    began = time.monotonic()
    plan, used = packing.bin_completion(counts, 4096), Counter()
    assert time.monotonic() - began < 60
    for times, filling in plan:
        assert sum(n * c for n, c in filling) <= 4096
        used.update({n: times * c for n, c in filling})
    bins = sum(t for t, _ in plan)
    assert used == counts
    assert packing.lower_bound(counts, 4096) <= bins < sum(t for t, _ in packing.dive(counts, 4096))


def test_packing_holds_every_token_once(spark, documents, texts):
    from tokenizers import Tokenizer
    import public_tokenizers
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    odd = {10_001: "á x\x1cy z <|endoftext|> don't 12½ ", 10_002: "", 10_003: "Ünï\r\n\tcode" * 3000}
    docs = documents.select("doc_id", "text").union(
        spark.createDataFrame(list(odd.items()), "doc_id long, text string"))
    got, room = packing.pack(docs).toPandas(), {}
    for doc_id, text in {**texts, **odd}.items():
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want = [(k, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes()))
                for k, at in enumerate(range(0, len(ids), 4096))]
        mine = got[got.doc_id == doc_id].sort_values("piece")
        assert list(mine[["piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == want
    for _, sequence in got.sort_values("offset").groupby("sequence_id"):
        assert (sequence.offset == sequence.length.cumsum() - sequence.length).all()
        room[sequence.sequence_id.iloc[0]] = sequence.length.sum()
    assert max(room.values()) <= 4096
    assert len(room) == packing.lower_bound(dict(got.length.value_counts()), 4096)


def plain_fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark, documents, texts):
    got = {r["doc_id"]: r for r in QUERIES["op4_simhash_components"](spark, SF_SMALL).collect()}
    prints, groups = {i: plain_fingerprint(t) for i, t in texts.items()}, Union()
    for i, a in prints.items():
        for j, b in prints.items():
            if (a ^ b).bit_count() <= 4:
                groups.join(i, j)
    assert {i: (f"{p:016x}", groups.root(i)) for i, p in prints.items()} == {
        i: (r["fingerprint"], r["component_id"]) for i, r in got.items()}
    kept = [r["doc_id"] for r in simhash.drop_near_copies(documents).select("doc_id").collect()]
    assert sorted(kept) == sorted({groups.root(i) for i in prints})


def test_near_copies_are_grouped_by_text_not_by_id(spark):
    rng = random.Random(9)
    text = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(300))
    near = text()
    close = next(t for t in (f"{near} {w}" for w in ("x", "y", "z", "w", "v")) if 0 < (
        plain_fingerprint(t) ^ plain_fingerprint(near)).bit_count() <= 4)
    rows = [(1, text()), (1, text()), (None, near), (None, close)]
    for chosen, want in ((rows[:2], 2), (rows[2:4], 1), (rows[:4], 3)):
        docs = spark.createDataFrame(chosen, "doc_id long, text string")
        assert simhash.drop_near_copies(docs).count() == want


@pytest.mark.parametrize("shard", [4, 4096])
def test_split_shards_lose_no_link(spark, shard):
    rng, center = np.random.default_rng(5), np.uint64(0x0123456789ABCDEF)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(150)]
    values = sorted({int(center) ^ f for f in flips} | {int(x) for x in rng.integers(0, 1 << 63, 100)})
    nodes = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "node long")
    links = simhash.fingerprint_links(nodes, 4, shard).collect()
    mine, want, mask = Union(), Union(), (1 << 64) - 1
    for r in links:
        assert ((r["u"] & mask) ^ (r["v"] & mask)).bit_count() <= 4
        mine.join(r["u"] & mask, r["v"] & mask)
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 4:
                want.join(a, b)
    assert [mine.root(v) for v in values] == [want.root(v) for v in values]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7), (300, 299), (299, 300)]
    got = {r["node"]: r["root"] for r in components.components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    want = Union()
    for a, b in edges:
        want.join(a, b)
    assert got == {n: want.root(n) for e in edges for n in e}


def test_pii_base_rules_against_plain_expressions(texts):
    shapes = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
              r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    rng = random.Random(2)
    odd = ["".join(rng.choices("a@.1-+ 5()9", k=rng.randint(1, 60))) for _ in range(3000)]
    for text in [*texts.values(), *odd, "4111 1111 1111 1111", "a@b@c.de.f@g.h", "1.2.3.4.5.6.7.8", "+1+2345678901"]:
        want = []
        for k, shape in enumerate(shapes):
            for m in re.finditer(shape, text):
                digits = re.sub("[^0-9]", "", m[0])
                if k == 1 and any(int(p) > 255 for p in m[0].split(".")):
                    continue
                if k == 2 and not (14 <= len(digits) <= 19 and pii.luhn(digits)):
                    continue
                if k == 3 and not 10 <= len(digits) <= 15:
                    continue
                want.append((m.start(), k, m.end()))
        assert pii.base_spans(text) == sorted(want), text
    assert pii.base_spans("a" * 300_000) == pii.base_spans("1" * 300_000) == []


def test_pii_patterns_discover_unseen_identifiers(spark):
    rows = [(i, f"hello, reach me at mail: user{i}@host{i}.example today") for i in range(20)]
    rows += [(100, "hello, reach me at mail: jane (at) corp (dot) example today"), (101, "we met (at) noon.time today")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find(docs).select(
        "doc_id", "n_email", "base_sha256", pii.spans_text(F.col("all_spans")).alias("spans")).collect()}
    start = rows[20][1].index("jane")
    assert got[100]["spans"] == f"email:{start}:{rows[20][1].index(' today')}"
    assert got[100]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[101]["spans"] == ""
    masked = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert masked[100] == "hello, reach me at mail: [EMAIL] today" == masked[3] and masked[101] == rows[21][1]


def test_pii_function_words_of_prose_are_not_trusted(spark):
    rows = [(i, f"they send a user{i}@host{i}.example often") for i in range(4)]
    rows += [(10 + i, "a dog and a cat and a bird saw a tree") for i in range(5)]
    rows += [(100, "hawh reing a look at thedly. Or not"), (101, "once a word at home. Then")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.find(docs).select(
        "doc_id", pii.spans_text(F.col("all_spans")).alias("spans")).collect()}
    assert all(got[i] for i in range(4)) and not any(got[i] for i in (*range(10, 15), 100, 101))


def test_pii_occurrences_of_few_and_of_many_patterns_agree(spark):
    docs = spark.createDataFrame([(1, "mail me, mail me: a@b.example mail\u00e9 it")], "doc_id long, text string")
    rows = docs.select(F.col("text").alias("in_text")).withColumn(
        "seen", F.pandas_udf(pii.scan_batch, pii.FOUND)("in_text")["seen"])
    wanted = spark.createDataFrame([("mail",), ("me mail",)], "pattern string")
    for at_most in (10, 1):
        got = {r["pattern"]: r["n"] for r in pii.occurrences(rows, wanted, at_most).collect()}
        assert (got["mail"], got["me mail"]) == (2, 1) and "example" not in got


def test_pii_shapes_after_trusted_patterns(spark):
    def card(i):
        body = f"411111111111{i:03d}"
        return next(body + d for d in "0123456789" if pii.luhn(body + d))

    seeds = {"mail": lambda i: f"user{i}@host{i}.example", "address": lambda i: f"10.0.0.{i}",
             "card": card, "phone": lambda i: f"+49 30 1234{i:04d}"}
    odd = {"mail": ["JANE (AT) corp.example", "jane@host", "jane at corp dot example", "Jane@[host"],
           "address": ["300.1.2.3", "fe80::1", "fe:ed:be:ef:fa:ce:ab:cd"],
           "card": ["4111111111111112", "3782 822463 10006"],
           "phone": ["0301234567", "0044 20 7946 0958", "(415) 555-2671"]}
    names = {"mail": "email", "address": "ip"}
    rows, want = [], {}
    for word, seed in seeds.items():
        rows += [(len(rows) + i, f"our {word}: {seed(i)} today") for i in range(20)]
    for word, texts in odd.items():
        for x in texts:
            want[len(rows)] = "" if "[host" in x else f"{names.get(word, word)}:{len(word) + 6}:{len(word) + 6 + len(x)}"
            rows.append((len(rows), f"our {word}: {x} today"))
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", pii.spans_text(F.col("all_spans")).alias("spans")).collect()}
    assert {i: got[i] for i in want} == want
    assert [x for x in pii.shapes("1" * 300_000 + "a" * 300_000 + ":" * 300_000 + " at " * 9)] == []
    mixed = pii.scanned("1.2.3.400 then fe80::1 and 5.6.7.800")[-1]
    assert [x[4] for x in mixed if x[0] == "ip"] == ["1.2.3.400", "fe80::1", "5.6.7.800"]


@pytest.mark.parametrize("chunk_bytes", [20_000, substring.CHUNK_BYTES])
def test_substring_dedup(documents, texts, chunk_bytes):
    first, want = {}, {}
    for i, text in sorted(texts.items()):
        w = words(text)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k:k + 13]), i)
    for i, text in texts.items():
        w, gone = words(text), set()
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < i:
                gone.update(range(k, k + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    got = substring.drop_repeats(documents, chunk_bytes=chunk_bytes).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want and any(v[1] for v in want.values())


def test_packed_cell_lists_round_trip():
    for values in ([], [0], [0, 0, 5], [65535], [65534, 65535, 131070, 131070, 33_554_431]):
        data = substring.squeezed(np.array(values, np.int64))
        assert substring.unsqueezed(data).tolist() == values


def test_mix_targets_and_positions(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 30), s) for i, s in enumerate(["a"] * 900 + ["b"] * 300 + ["c"] * 60 + [None] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, bucket_rows=50).toPandas()
    total = got["size"].sum()
    by_source = got.assign(source=got.source.fillna("~")).groupby("source").agg(
        taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"))
    assert abs(by_source.target.sum() - 1.5 * total) < 1e-6 and (by_source.target <= 2 * by_source["size"]).all()
    assert ((by_source.taken - by_source.target).abs() <= 16).all() and (got.taken <= 2 * got["size"]).all()
    assert got[got.taken > 0].position.between(0, 1).all()
    again = mixing.mix(docs.repartition(7), bucket_rows=1000).toPandas()
    key = ["doc_id", "taken", "position"]
    assert got[key].sort_values("doc_id").round(9).equals(again[key].sort_values("doc_id").round(9)) or (
        got.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist())
    stream = mixing.schedule(docs).toPandas()
    assert len(stream) == got.copies.sum() and stream.position.is_monotonic_increasing


def test_warc_round_trip_and_lookup(spark):
    rows = [(1, "http://a/\n1", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://c", ""), (4, "http://d", None),
            (5, "http://e", "x\r\n\r\ny" * 50_000), (2, "http://again", "<p>é</p>"), (None, "http://n", "only")]
    bundles = materialize(warc.write_bundles(spark.createDataFrame(
        rows, "page_id long, url string, html string").coalesce(1), frame_bytes=100), "test-bundles")
    got = warc.read_records(bundles).collect()
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == Counter({(1, "response", None): 1, (2, "revisit", 1): 2, (3, "response", None): 1,
                             (4, "revisit", 3): 1, (5, "response", None): 1, (None, "response", None): 1})
    by_id = {r["page_id"]: r for r in got}
    assert bytes(by_id[5]["payload"]) == rows[4][2].encode() and by_id[5]["payload_bytes"] == len(rows[4][2])
    assert by_id[1]["url"] == "http://a/%0A1" and by_id[2]["payload"] is None
    wanted = spark.createDataFrame([(5,), (3,)], "page_id long")
    assert sorted(r["page_id"] for r in warc.read_records(bundles, wanted).collect()) == [3, 5]
    import zstandard
    archive = bytes(bundles.first()["archive"])
    places = warc.seek_table(archive)
    whole = zstandard.ZstdDecompressor().stream_reader(archive, read_across_frames=True).read()
    assert whole == b"".join(warc.frame(archive, p) for p in places) and len(places) > 3


def test_embedding_links(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(260, 24)) * np.linspace(3, 0.2, 24)
    x[60:120] = x[:60] + rng.normal(size=(60, 24)) * 0.12
    x[120:140] = x[5]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [
        (900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [1.0, None]),
        (905, [1.0, 2.0]), (906, [2.0, 4.0]), (907, [float("inf")] + [1.0] * 23), (None, [5.0, 10.0])]
    cosine = (x / np.linalg.norm(x, axis=1)[:, None]) @ (x / np.linalg.norm(x, axis=1)[:, None]).T >= 0.95
    want = Union()
    for i, j in zip(*np.nonzero(cosine)):
        want.join(int(i), int(j))
    for tile in (32, 4096):
        got = {r["vec_id"]: r for r in embeddings.link_vectors(
            spark.createDataFrame(rows, "vec_id long, embedding array<double>"), tile=tile).collect()}
        assert [got[i]["n_links"] for i in range(260)] == (cosine.sum(axis=1) - 1).tolist()
        assert [got[i]["component_id"] for i in range(260)] == [want.root(i) for i in range(260)]
        assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902, 903, 904, 907))
        assert (got[905]["n_links"], got[906]["component_id"], got[None]["component_id"]) == (2, 905, 905)


def test_language_accuracy_on_held_out_documents(spark, documents):
    got = QUERIES["op10_language_id"](spark, SF_SMALL).join(documents.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert len(held) and (held.lang == held.lang_pred).mean() >= 0.95 and got.score.between(0, 1).all()
    odd = {r["doc_id"]: r for r in langid.identify(edge(spark)).collect()}
    assert all(odd[i]["lang_pred"] == "und" for i in (2, 3, 4, 6))
    learnt = {r[2] for r in EDGE if not odd[r[0]]["held_out"] and words(r[1]) and r[2]}
    assert odd[5]["lang_pred"] in learnt


def test_forward_pass_sums_all_segmentations():
    model = langid.Model(["a", "b"], ["▁", "x", "y", "xy", "▁x", "xyx"], np.arange(12.0).reshape(6, 2))
    p = {t: np.exp(model.log_p[i]) for t, i in model.row.items()}

    def total(text):
        return np.ones(2) if not text else sum(
            (p[text[:k]] * total(text[k:]) for k in range(1, len(text) + 1) if text[:k] in p), np.zeros(2))

    for word, found in zip(["x", "xy", "xyx", "xyxxy"], np.exp(model.score(["x", "xy", "xyx", "xyxxy"]))):
        assert np.allclose(found, total("▁" + word))
    assert np.isfinite(model.score(["z" * 3000])).all()


def test_large_tables_join_salted_like_broadcast(spark):
    rows = spark.createDataFrame([(i, None if i % 3 else "k") for i in range(90)], "id long, key string")
    table = materialize(spark.createDataFrame([("k", 1), (None, 2)], "key string, v int"), "test-keys")
    salt = F.xxhash64("id")
    a, b = (sorted(attach(rows, table, ["key"], salt, broadcast_rows=n).select("id", "v").collect()) for n in (10, 0))
    assert a == b and len(a) == 90


def test_pipeline_stages(spark, documents):
    docs = documents.select("*", F.lit(1).alias("kept"), F.lit("x").alias("target"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, SF_SMALL), f"test-{name}")
        assert docs.columns == before.columns and 0 < docs.count()
        if name == "quality_rules":
            kept = {r["doc_id"] for r in quality_rules.judge(before.drop("kept")).filter("kept").collect()}
            assert {r["doc_id"] for r in docs.collect()} == kept
        elif name == "pii":
            assert not docs.filter(F.col("text").rlike("[a-z0-9]@[a-z0-9]+[.]example")).count()
            assert not docs.filter("n_chars <> length(text)").count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    copies = docs.groupBy("doc_id").count().toPandas().set_index("doc_id")["count"].to_dict()
    got = packed.filter("piece = 0").groupBy("doc_id").count().toPandas().set_index("doc_id")["count"].to_dict()
    assert got == copies and packed.groupBy("sequence_id", "offset").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("extra", [False, True])
def test_pipeline_on_edge_rows(spark, extra):
    for docs in (edge(spark, extra), edge(spark, extra).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, SF_SMALL), f"edge-{name}")
        assert "sequence_id" in docs.columns

"""Quality rules where the sketches decide, against DuckDB."""

import random
from collections import Counter

import duckdb
import pytest

from fleetline.llm import quality_rules
from fleetline.llm.oracles import OP1
from fleetline.llm.registry import QUERIES

#: The operator's own rule by definition, on the counts and cumulated sketches
#: of the query's SQL.
OWN_FENCES = OP1[:OP1.index("fences AS (")] + r"""
quantiles AS (
  SELECT level, lang, source, m, max(total) AS total,
    [min(b) FILTER (WHERE cum * 100 >= total * 10), min(b) FILTER (WHERE cum * 100 >= total * 25),
     min(b) FILTER (WHERE cum * 100 >= total * 50), min(b) FILTER (WHERE cum * 100 >= total * 75),
     min(b) FILTER (WHERE cum * 100 >= total * 90)] AS q FROM cumulated GROUP BY ALL),
edges AS (SELECT *, list_transform(q, lambda x: exp(x / 50.0) - 1) AS l,
    list_transform(q, lambda x: exp((x + 1) / 50.0) - 1) AS u FROM quantiles),
fences AS (
  SELECT *, CASE WHEN q[2] < q[4] THEN u[4] + 3 * (u[4] - l[2]) ELSE u[5] + 3 * (u[5] - l[3]) END AS hi,
    CASE WHEN q[2] < q[4] THEN l[2] - 3 * (u[4] - l[2]) ELSE l[1] - 3 * (u[3] - l[1]) END AS lo FROM edges),
measures AS (
  SELECT rid, lang, source, unnest([1, 2, 3, 4]) AS m, unnest(v) AS v, unnest([
    CASE WHEN word_chars > 0 THEN floor((n_symbols - 1) * 1000 / word_chars) ELSE 0 END,
    CASE WHEN n_lines > 0 THEN floor((n_dup_lines - 1) * 1000 / n_lines) ELSE 0 END,
    CASE WHEN n_words > 0 THEN floor((n_repeat_words - 6) * 1000 / n_words) ELSE 0 END, v[4]]) AS top FROM judged),
verdicts AS (
  SELECT e.rid, bool_and(e.top <= f.hi AND (e.m <> 4 OR e.v >= f.lo)) AS inside
  FROM measures e JOIN fences s ON s.level = 1 AND s.m = e.m AND s.lang IS NOT DISTINCT FROM e.lang
      AND s.source IS NOT DISTINCT FROM e.source
    JOIN fences l ON l.level = 2 AND l.m = e.m AND l.lang IS NOT DISTINCT FROM e.lang
    JOIN fences f ON f.m = e.m AND f.level = CASE WHEN s.total >= 200 THEN 1 WHEN l.total >= 200 THEN 2 ELSE 3 END
      AND (f.level = 3 OR f.lang IS NOT DISTINCT FROM e.lang)
      AND (f.level <> 1 OR f.source IS NOT DISTINCT FROM e.source)
  GROUP BY e.rid)
""" + OP1[OP1.index("SELECT doc_id, n_words, word_chars"):]

BY_SOURCE, BY_LANG, BY_CORPUS, PLAIN, SHORT_WORDS = range(9001, 9006)


def spread_rows():
    """Sources with and without spread, too small ones, a null language, and
    one document each beyond the fixed cutoffs."""
    rng = random.Random(12)

    def text(symbols=0, copies=0, length=5):
        w = ["".join(rng.choices("abcdefgh", k=length)) + "#" * (i < symbols) for i in range(80)]
        lines = [" ".join(w[i:i + 10]) for i in range(0, 80, 10)]
        return "\n".join(lines + lines[:1] * copies)

    noisy = lambda: text(rng.randint(0, 12))
    rows = [(noisy(), "en", "noisy") for _ in range(240)] + [(text(), "en", "plain") for _ in range(240)]
    rows += [(noisy(), None, (None, "a", "b")[i % 3]) for i in range(240)] + [(noisy(), "xx", "a") for _ in range(30)]
    rows += [(text(copies=rng.randint(0, 2), length=rng.randint(4, 10)), "de", "lengths") for _ in range(240)]
    rows = [(i, *r) for i, r in enumerate(rows)]
    rows += rows[::50] + [(8001, None, "en", "noisy"), (8002, "", None, None), (8003, "few words", "yy", "a")]
    return rows + [(BY_SOURCE, text(70), "en", "noisy"), (BY_LANG, text(70), None, "a"), (BY_CORPUS, text(70), "xx", "a"),
                   (PLAIN, text(70), "en", "plain"), (SHORT_WORDS, text(length=2), "de", "lengths")]


@pytest.fixture(scope="module")
def spread(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("spread"))
    docs = spark.createDataFrame(spread_rows(), "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{folder}/documents.parquet")
    return folder


def by_sql(folder, sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    found = con.execute(sql)
    return [d[0] for d in found.description], found.fetchall()


def test_quality_query_follows_its_sketches_beyond_the_cutoffs(spark, spread):
    names, want = by_sql(spread, OP1)
    got = QUERIES["op1_quality_rules"](spark, spread).select(*names).collect()
    assert Counter(map(tuple, got)) == Counter(want)
    kept = {r["doc_id"]: r["kept"] for r in got}
    # The cutoffs alone (100 symbols per mille, 2.5 letters a word) reject all five.
    assert kept[BY_SOURCE] and kept[BY_LANG] and kept[BY_CORPUS] and kept[SHORT_WORDS] and not kept[PLAIN]


def test_quality_operator_against_its_fences_in_sql(spark, spread):
    names, want = by_sql(spread, OWN_FENCES)
    got = quality_rules.judge(spark.read.parquet(f"{spread}/documents.parquet")).select(*names).collect()
    assert Counter(map(tuple, got)) == Counter(want)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not any(kept[i] for i in (BY_SOURCE, BY_LANG, BY_CORPUS, PLAIN)) and 900 < sum(r["kept"] for r in got)

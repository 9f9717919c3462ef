import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landspark.llm import importance as i
from landspark.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import rows
from tests.llm.helpers import awkward, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(text, sizes):
    w = words(text)
    return [" ".join(w[k : k + n]) for n in range(sizes[0], sizes[1] + 1) for k in range(len(w) - n + 1)]


def clean(text):
    return i._SPACES.sub(b" ", text.encode().translate(i._FOLD)).strip(b" ")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abAZ09 .\n\t_-é中́\x7f\x80")), max_size=40), st.integers(1, 4))
def test_spans_are_the_ngrams(text, n):
    assert [m[0].decode() for m in i.spans_of(n).finditer(clean(text), overlapped=True)] == grams(text, (n, n))


def brute(docs, target, sizes, buckets, percent, seed, least):
    own = [(d, t, [zlib.crc32(g.encode()) % buckets for g in grams(t, sizes)]) for d, t in docs]
    s = Counter(b for *_, x in own for b in x)
    t = Counter(zlib.crc32(g.encode()) % buckets for x in target for g in grams(x, sizes))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out = []
    for d, text, x in own:
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in x)
        out.append([d, len(x), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words(text))])
    long = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(long[: percent * len(long) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=lambda r: [(v is not None, "", v) for v in r])


@pytest.mark.parametrize("sizes", [(1, 1), (1, 2), (3, 3)])
@pytest.mark.parametrize("buckets", [97, 100_000])
def test_against_brute_force_on_awkward_rows(spark, sizes, buckets):
    docs = awkward(spark).repartition(3)
    target = ["one two three", None, "", "word1x1 Word2x2. WORD3x3", "one two"]
    got = i.Resampler(sizes, buckets).resample(docs, documents(spark, target), percent=60, seed=7, least=2)
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], target, sizes, buckets, 60, 7, 2)
    assert [r for r in rows(got.select("doc_id", "n_features", "weight", "score", "rank"))] == want


def test_ties_go_to_smaller_ids(spark):
    weighed = spark.createDataFrame([(k, 20, 20, 10**7 - k % 2) for k in range(100)], "doc_id long, n_words long, n_features long, weight long")
    got = i.draw(weighed.repartition(5), percent=50).filter("rank IS NOT NULL").orderBy("rank").collect()
    assert len(got) == 50 and [(-r["score"], r["doc_id"]) for r in got] == sorted((-r["score"], r["doc_id"]) for r in got)


def test_repeated_rows_are_drawn_apart(spark):
    docs = documents(spark, [(1, "a b c"), (1, "a b c"), (1, "a b"), (2, "c")] * 5)
    got = [r["rank"] for r in i.Resampler().resample(docs, documents(spark, ["a"]), percent=100, least=1).collect()]
    assert sorted(got) == list(range(1, 21))


def test_alike_documents_are_drawn_more(spark):
    docs = documents(spark, [f"stone river {k} hill tree" if k % 2 else f"tax form {k} bill page" for k in range(400)])
    got = i.Resampler((1, 2)).resample(docs, documents(spark, ["river hill stone river tree hill"] * 20), percent=25, least=1)
    drawn = [r["doc_id"] for r in got.filter("rank IS NOT NULL").collect()]
    assert len(drawn) == 100 and sum(d % 2 for d in drawn) > 90


def test_empty_tables(spark):
    none = documents(spark, [])
    assert i.Resampler().resample(none, none).count() == 0
    assert rows(i.Resampler().resample(documents(spark, ["a b", None]), none, least=1).select("n_features", "weight")) == [(0, 0), (2, 2 * math.floor(1000 * math.log(10002 / 20000)))]


def test_query_against_sql(spark):
    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = QUERIES["op13_importance"](spark, sf).select("doc_id", "n_features", "weight", "score", "rank")
    want = con.execute(f"SELECT doc_id, n_features, weight, score, rank FROM ({ORACLE_SQL['op13_importance']})").fetchall()
    assert rows(got) == sorted(want, key=lambda r: [(v is not None, "", v) for v in r])

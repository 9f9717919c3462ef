import hashlib
import re

import pytest

from landspark.llm import exact_dedup
from landspark.sources import stored
from landspark.sources.shared import new_path
from tests.llm.helpers import awkward, documents


def index(spark):
    return exact_dedup.DigestIndex(spark, new_path(spark, "index"), 4)


def expected(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    out = []
    for i, t in norm:
        own = [j for j, u in norm if u == t]
        known = [j for j in own if j is not None]
        out.append((i, min(known) if known else None, len(own), hashlib.sha256(t.encode()).hexdigest()))
    return out


def test_awkward_rows(spark):
    df = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = exact_dedup.deduplicate(df, index(spark), "b").collect()
    assert sorted(map(str, ((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got))) == sorted(map(str, expected(rows)))
    groups = {}
    for r in got:
        groups.setdefault(r["text_sha256"], []).append(r)
    assert all(sum(r["kept"] for r in g) == 1 for g in groups.values())  # also of the two equal rows
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_index_grows_by_batches(spark):
    ix = index(spark)
    first = exact_dedup.deduplicate(documents(spark, [(5, "a  b"), (3, "a b"), (4, "c")]), ix, "1").collect()
    assert {r["doc_id"]: r["kept"] for r in first} == {5: False, 3: True, 4: True}
    second = exact_dedup.deduplicate(documents(spark, [(1, "a\tb"), (2, "d"), (9, "d")]), ix, "2").collect()
    assert {r["doc_id"]: (r["keep_id"], r["kept"]) for r in second} == {1: (3, False), 2: (2, True), 9: (2, False)}
    assert ix.read().count() == 3
    again = exact_dedup.groups(exact_dedup.digests(documents(spark, ["d"])))
    ix.append(again, "2")
    assert ix.read().count() == 3


@pytest.mark.parametrize("batches", [2, 3, 7])
def test_batches_change_no_decision(spark, batches):
    df = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    ix = index(spark)
    got = exact_dedup.deduplicate(df, ix, "b", batches=batches).collect()
    assert sorted(map(str, ((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got))) == sorted(map(str, expected(rows)))
    groups = {}
    for r in got:
        groups.setdefault(r["text_sha256"], []).append(r)
    assert all(sum(r["kept"] for r in g) == 1 and all(r["doc_id"] == r["keep_id"] for r in g if r["kept"]) for g in groups.values())
    brought = {r["batch"] for r in ix.read().collect()}
    assert len(brought) > 1 and len(ix.read().collect()) == len(groups)
    again = exact_dedup.deduplicate(df, ix, "b", batches=batches).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    ix.drop()
    assert not stored.is_stored(spark, ix.path)


def test_registered_query_plans_the_anti_join(spark, monkeypatch):
    from landspark.llm.queries import op9_exact_dedup

    plans, unseen = [], exact_dedup.DigestIndex.unseen

    def seen(self, found):
        out = unseen(self, found)
        plans.append((out._jdf.queryExecution().executedPlan().toString(), self.read().count()))
        return out

    monkeypatch.setattr(exact_dedup.DigestIndex, "unseen", seen)
    assert op9_exact_dedup(spark, "/root/testdata/sf0.001").count() == 200
    assert len(plans) == 3 and all("SortMergeJoin" in p and "LeftAnti" in p and "Bucketed: true" in p for p, _ in plans)
    assert plans[0][1] == 0 < plans[1][1] < plans[2][1]


def test_anti_join_reads_the_index_in_place(spark):
    ix = index(spark)
    exact_dedup.deduplicate(documents(spark, ["a"]), ix, "1")
    found = exact_dedup.groups(exact_dedup.digests(documents(spark, ["b"])))
    joined = found.join(ix.read().select("text_sha256").hint("merge"), "text_sha256", "left_anti")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan


def test_empty_table(spark):
    assert exact_dedup.deduplicate(documents(spark, []), index(spark), "1").count() == 0


def test_another_catalog_opens_the_index(spark):
    path = new_path(spark, "index")
    first = exact_dedup.DigestIndex(spark, path, 3)
    exact_dedup.deduplicate(documents(spark, ["a", "b", "a"]), first, "one")
    spark.sql(f"DROP TABLE {stored._registered(spark, path)}")  # what a later session knows: nothing
    again = exact_dedup.deduplicate(documents(spark, [(7, "b"), (8, "c")]), exact_dedup.DigestIndex(spark, path, 99), "two")
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in again.collect()) == [(7, 1, False), (8, 8, True)]
    assert exact_dedup.DigestIndex(spark, path).read().count() == 3


def test_text_ids_in_batches(spark):
    df = documents(spark, [(k, f"text {k % 17}") for k in range(80)]).selectExpr("concat('d', lpad(doc_id, 3, '0')) AS doc_id", "text").repartition(3)
    got = exact_dedup.deduplicate(df, exact_dedup.DigestIndex(spark, new_path(spark, "index"), 3), "b", batches=3).collect()
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got} == {(f"d{k:03}", f"d{k % 17:03}", len(range(k % 17, 80, 17)), k < 17) for k in range(80)}

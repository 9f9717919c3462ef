import random
import zlib

from landspark.llm import sharding
from landspark.sources.shared import new_path
from tests.llm.helpers import awkward, documents


def put(spark, df, n=4):
    slot_map = sharding.SlotMap(spark, new_path(spark, "map"))
    return sharding.shard(df, n, slot_map, slots=256).collect(), slot_map


def test_awkward_rows(spark):
    df = awkward(spark)
    got, slot_map = put(spark, df)
    want = sorted(str((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode()))) for r in df.collect())
    assert sorted(str((r["doc_id"], r["size"], r["text_crc32"])) for r in got) == want
    for k in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == k)
        assert slots == list(range(len(slots)))
    at = {r["virtual_slot"]: r["shard"] for r in slot_map.load(2).collect()}
    assert len(at) == 256 and all(at[r["virtual_slot"]] == r["shard"] for r in got)


def test_sizes_are_near_equal_and_reruns_agree(spark):
    rng = random.Random(3)
    df = documents(spark, ["x" * int(rng.lognormvariate(5, 1)) for _ in range(3000)])
    got, slot_map = put(spark, df)
    load = [sum(r["size"] for r in got if r["shard"] == k) for k in range(4)]
    assert max(load) - min(load) < 0.01 * sum(load) / 4
    assert sorted(map(str, got)) == sorted(map(str, put(spark, df.repartition(7))[0]))


def test_slots_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    rng = random.Random(5)
    rows = [(rng.randrange(40), "x" * rng.randrange(9)) for _ in range(600)] + [(5, "again")] * 300 + [(None, None)] * 20
    got, slot_map = put(spark, documents(spark, rows))
    at = {r["virtual_slot"]: r["shard"] for r in slot_map.load(2).collect()}
    records = sorted(((r["shard"], r["virtual_slot"], r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["size"]) for r in got))
    assert sorted((i is not None, i or 0, zlib.crc32((t or "").encode()), len(t or "") + 8) for i, t in rows) == sorted(r[2:] for r in records)
    want, place = [], {}
    for r in records:  # in order of virtual slots, then of records, without gaps
        want.append((*r, place.get(r[0], 0)))
        place[r[0]] = place.get(r[0], 0) + 1
    assert sorted((r["shard"], r["virtual_slot"], r["doc_id"] is not None, r["doc_id"] or 0, r["text_crc32"], r["size"], r["slot"]) for r in got) == sorted(want)
    stats = {}
    for r in got:
        stats[r["virtual_slot"]] = stats.get(r["virtual_slot"], 0) + r["size"]
    assert sharding.rebalanced(sharding.first_map(256, 4), 4, stats) == [at[k] for k in range(256)]


def test_rebalancing_moves_few_slots():
    rng = random.Random(1)
    sizes = {s: rng.randint(900, 1100) for s in range(1000)}
    old = sharding.rebalanced(sharding.first_map(1000, 10), 10, sizes)
    grown = sharding.rebalanced(old, 11, sizes)
    load = [sum(b for s, b in sizes.items() if grown[s] == k) for k in range(11)]
    assert max(load) - min(load) <= 1100
    assert sum(a != b for a, b in zip(old, grown, strict=True)) < 150  # 91 would be the least
    shrunk = sharding.rebalanced(grown, 10, sizes)
    assert max(shrunk) == 9


def test_empty_table(spark):
    assert put(spark, documents(spark, []))[0] == []

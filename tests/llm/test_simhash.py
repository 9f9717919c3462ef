import random

import numpy as np
import pytest
import xxhash

from landspark.functions.components import components
from landspark.llm import simhash
from tests.llm.helpers import LONG, awkward, documents


def slow_fingerprint(text, k=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def united(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(k) for k in range(n)]


def copies(rng, n=60):
    words = [f"w{k}" for k in range(500)]
    texts = []
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            other = list(base)
            for _ in range(rng.randint(0, 2)):
                other[rng.randrange(len(other))] = rng.choice(words)
            texts.append(" ".join(other))
    return texts


@pytest.mark.parametrize("text", ["", "  ", "a", "A b", "a b C d", "x y z w x y z w x y z w", "é à\tü  ß", LONG[:20_000]])
def test_fingerprint(text):
    assert int(simhash.fingerprint(simhash.shingle_hashes(text, 4))[0]) == slow_fingerprint(text)


def test_fingerprint_of_many_shingles():
    hashes = np.random.default_rng(0).integers(0, 2**63, 200_000).astype("<u8")
    bits = np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0)
    assert int(simhash.fingerprint(hashes)[0]) == sum(1 << b for b in range(64) if 2 * bits[b] > len(hashes))


def test_fingerprint_column_matches_the_engine(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([("a b c d",)], "t string").select(F.lower(F.hex(F.xxhash64("t"))).alias("h")).first()["h"]
    fp = simhash.fingerprints(documents(spark, ["a b c d"])).select(simhash.as_hex(F.col("fp")).alias("h")).first()["h"]
    assert fp == got.rjust(16, "0")


def test_groups_equal_brute_force(spark):
    texts = copies(random.Random(5))
    fps = [slow_fingerprint(t) for t in texts]
    want = united(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 4])
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(documents(spark, texts)).collect()}
    assert got == dict(enumerate(want)) and len(set(want)) < len(texts)


@pytest.mark.parametrize("blocks,most", [(3, 4), (5, 4), (4, 8), (8, 20)])
def test_links_lose_no_component(spark, blocks, most):
    rng = np.random.default_rng(blocks)
    base = rng.integers(0, 2**63, 150).astype("<u8")
    flips = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(1, most + 4), replace=False))) for b in base for _ in range(3)]
    fps = sorted({int(x) for x in [*base, *flips]})
    df = spark.createDataFrame([(x.to_bytes(8, "little"),) for x in fps], "fp binary")
    at = {x.to_bytes(8, "little"): k for k, x in enumerate(fps)}
    edges = [(at[bytes(r["a"])], at[bytes(r["b"])]) for r in simhash.links(df, 64, most, blocks).collect()]
    assert all(bin(fps[a] ^ fps[b]).count("1") <= most for a, b in edges)
    every = [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= most]
    assert united(len(fps), edges) == united(len(fps), every)


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_tree_reaches_all_values_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    tree = simhash.VantageTree(radius, rng.integers(0, 512, 3000), 0.01, 1)
    values = np.arange(512, dtype="u8")
    reached, placed, home = {v: set() for v in range(512)}, {v: set() for v in range(512)}, {}
    for row, leaf, own in zip(*tree.reached(values), strict=True):
        reached[row].add(leaf)
        if own:
            assert row not in home
            home[row] = leaf
    for row, leaf, own in zip(*tree.placed(values), strict=True):
        placed[row].add(leaf)
        assert own == (home[row] == leaf)
    zero = simhash.VantageTree(0, rng.integers(0, 512, 10), 2.0, 1)
    assert zero.n_leaves == 1 and zero.root == -1 and tree.n_leaves > 20
    for a in range(0, 512, 7):
        for b in range(512):
            if bin(a ^ b).count("1") <= radius:
                assert home[b] in reached[a] and (home[a] in placed[b] or home[b] in placed[a])
    # branches are pruned, and boundaries are crossed if the ball is more than its centre
    assert max(map(len, reached.values())) < tree.n_leaves / 1.5
    assert (max(map(len, reached.values())) > 1) == (radius > 0)


def test_op7_reaches_more_leaves_than_one_and_prunes():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 256, (20_000, 8)).astype("u1")
    for t, v in enumerate(simhash.block_values(fps, simhash.block_bits(64, 3))):
        tree = simhash.VantageTree(4 // 3, v, simhash.LEAF_ROWS / len(v), t)
        row, _, _ = tree.reached(v)
        assert 1.5 < len(row) / len(v) < tree.n_leaves / 3
        assert len(tree.placed(v)[0]) < len(row)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(4)
    for n in (5_000, 200_000, 50_000_000):
        blocks = simhash.probes(n)
        bits = rng.random((4_000, 256)) < 0.15  # bits in which pairs at the threshold differ
        found = np.zeros(len(bits), bool)
        for own in blocks:
            found |= ~bits[:, own].any(1)
        assert found.mean() > 0.98 and 2 ** len(blocks[0]) * simhash.NEAR_LEAF_ROWS >= n


def test_recall_of_pairs_near_the_threshold(spark):
    rng = random.Random(21)
    texts = []
    for k in range(300):  # two texts of 300 words that share all but a run of words: 0.80 to 0.86
        base = [f"a{rng.randrange(10**6)}" for _ in range(300)]
        n = rng.randint(19, 27)
        at = rng.randrange(5, 300 - n - 5)
        texts += [" ".join(base), " ".join(base[:at] + [f"b{rng.randrange(10**6)}" for _ in range(n)] + base[at + n :])]
    alike = [k for k in range(300) if jaccard(texts[2 * k], texts[2 * k + 1]) >= 0.8]
    kept = {r["doc_id"] for r in simhash.without_near_duplicates(documents(spark, texts)).collect()}
    assert {2 * k for k in range(300)} <= kept and len(alike) > 200
    found = sum(2 * k + 1 not in kept for k in alike)
    assert found >= 0.95 * len(alike) and found == 600 - len(kept)


def test_chunks_of_a_full_leaf_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK_ROWS", 20)
    texts = ["q r s t u v w x y z " * 3 + f"end{k}" for k in range(90)]
    groups = {r["component_id"] for r in simhash.near_groups(documents(spark, texts), most=30, blocks=8).collect()}
    fps = [slow_fingerprint(t) for t in texts]
    assert groups == set(united(90, [(a, b) for a in range(90) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 30]))


def test_forest_of_a_tight_group_is_grown():
    rng = np.random.default_rng(2)
    fps = (np.uint64(7) ^ (np.uint64(1) << rng.integers(0, 64, (300, 1)).astype("<u8"))).astype("<u8")
    edges = simhash.forest(fps, 4)
    assert edges == simhash._grown(fps, 4) and len(edges) == 299


def test_awkward_rows(spark):
    df = awkward(spark)
    got = {}
    for r in simhash.near_groups(df).collect():
        got.setdefault(r["doc_id"], []).append(r["component_id"])
    assert got[1] == [1] and got[7] == [1, 1] and got[2] == got[3] == got[4] == [2] and got[6] == [5]
    kept = simhash.without_near_duplicates(df)
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [1, 2, 5, 8, 9, 10, None] and kept.columns == df.columns


def jaccard(a, b, k=5):
    x, y = ({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def test_near_duplicates_against_brute_force(spark):
    texts = [t for t in copies(random.Random(11), 80) if len(t.split()) > 5]
    groups = united(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8])
    kept = sorted(r["doc_id"] for r in simhash.without_near_duplicates(documents(spark, texts)).collect())
    assert kept == sorted(set(groups)) and len(kept) < len(texts)


def test_repeated_lines_neither_join_nor_part_texts(spark):
    rng = random.Random(3)
    one, two, three = (" ".join(f"{name}{rng.randrange(10**6)}" for _ in range(404)) for name in "abc")
    line = " ".join(["subscribe to our weekly letter and never miss news"] * 120)
    texts = [f"{one} {line}", f"{two} {line}", three, f"{three} {line}", f"{line} {three}"]
    assert jaccard(texts[0], texts[1]) < 0.02 and jaccard(texts[2], texts[3]) > 0.95
    fps = [simhash.fingerprint(simhash.shingle_hashes(t, 5), 4) for t in texts]
    assert (fps[0] == fps[1]).all() and np.bitwise_count(fps[2] ^ fps[3]).sum() > 56
    assert sorted(r["doc_id"] for r in simhash.without_near_duplicates(documents(spark, texts)).collect()) == [0, 1, 2]


def test_unequal_sets_of_equal_fingerprint_are_compared(spark, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprint", lambda hashes, lanes=1: np.full(lanes, 5, "<u8"))
    texts = ["a b c d e f g", "a b c d e f g a b c d e f g", "h i j k l m n", "A b c d e f g"]
    fps = {simhash.set_key(simhash.shingle_hashes(t, 5), 4) for t in texts}
    assert len(fps) == 3 and len({fp[:32] for fp in fps}) == 1


@pytest.mark.parametrize("chunk", [32_000_000, 60_000])
def test_links_within_a_template_are_all_verified(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK_BYTES", chunk)
    new, base = iter(range(10**6)), [f"t{k}" for k in range(350)]
    texts = [" ".join(base + [f"n{next(new)}" for _ in range(54)]) for _ in range(250)]  # 346 of 454 shingles in common
    for k in range(0, 40, 2):  # and those at 365 of 435
        same = [f"s{next(new)}" for _ in range(19)]
        texts[k], texts[k + 1] = (" ".join(base + same + [f"n{next(new)}" for _ in range(35)]) for _ in "ab")
    assert jaccard(texts[0], texts[1]) > 0.8 > 0.77 > jaccard(texts[1], texts[2])
    kept = sorted(r["doc_id"] for r in simhash.without_near_duplicates(documents(spark, texts)).collect())
    assert kept == [k for k in range(250) if k >= 40 or k % 2 == 0]


def test_alike_against_brute_force():
    rng = np.random.default_rng(9)
    sets = [np.zeros(0, "<u8")]
    for _ in range(60):
        own = rng.integers(0, 10**9, rng.integers(1, 60))
        sets += [np.unique(np.where(rng.random(len(own)) < p, rng.integers(0, 10**9, len(own)), own)).astype("<u8") for p in (0, 0.05, 0.1, 0.3)]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b]))]
    edges = simhash.alike(np.zeros((len(sets), 4), "<u8"), sets, 56, 0.8)
    assert set(edges) <= {(b, a) for a, b in pairs} and united(len(sets), edges) == united(len(sets), pairs)
    assert simhash.alike(np.arange(len(sets), dtype="<u8")[:, None] * np.uint64(2**64 // 300), sets, -1, 0.8) == []


def test_components(spark):
    pairs = [(k, k + 1) for k in range(0, 200) if k % 50] + [(300, k) for k in range(301, 400)] + [(7, 7), (8, 9)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = united(400, [(a, b) for a, b in pairs])
    assert got == {k: want[k] for a, b in pairs if a != b for k in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_table(spark):
    df = documents(spark, [])
    assert simhash.near_groups(df).count() == 0 and simhash.without_near_duplicates(df).count() == 0


def test_sets_of_few_shingles_are_linked_exactly(spark):
    """Pairs at 0.8 to 0.84 of 4 to 24 shingles: their fingerprints differ in more bits than those of long texts."""
    rng, texts, families = random.Random(3), [], 0
    for n in (4, 8, 12, 16, 20, 21, 23):
        more = int(n / 0.8 + 1e-9) - n  # shingles that the other one has more
        for _ in range(60):
            words = [f"w{rng.randrange(10**9)}" for _ in range(n + 4 + more)]
            texts += [" ".join(words[: n + 4]), " ".join(words)]
            families += 1
    # and pairs just below
    for _ in range(60):
        words = [f"w{rng.randrange(10**9)}" for _ in range(10)]
        texts += [" ".join(words[:8]), " ".join(words)]
        families += 2
    assert simhash.without_near_duplicates(documents(spark, texts).repartition(4)).count() == families


def test_prefixes_of_alike_sets_meet():
    rng = np.random.default_rng(4)
    for _ in range(3000):
        n = int(rng.integers(1, 26))
        a = rng.integers(0, 2**62, n).astype("u8")
        b = np.concatenate([a[int(rng.integers(0, 3)) :], rng.integers(0, 2**62, int(rng.integers(0, 3))).astype("u8")])
        common, union = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 0 < len(b) <= simhash.FEW and common >= 0.8 * union:
            assert np.isin(simhash.prefix(a, 0.8), simhash.prefix(b, 0.8)).any()


def test_helper_names_do_not_clash(spark):
    df = documents(spark, ["a b c d e f", "a b c d e f", "other words are here now too"]).selectExpr("*", "concat('n', doc_id) AS _near_1", "'x' AS _near_2", "doc_id AS stays", "doc_id AS component")
    got = sorted(tuple(r) for r in simhash.without_near_duplicates(df).select("doc_id", "_near_1", "_near_2", "stays").collect())
    assert got == [(0, "n0", "x", 0), (2, "n2", "x", 2)]

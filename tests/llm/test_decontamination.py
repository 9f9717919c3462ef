import random
from collections import Counter

import numpy as np
import pytest

from landspark.llm import decontamination as d
from tests.llm.helpers import LONG, awkward, documents


def brute(texts, items, k=5, least=0.8):
    out = {}
    for i, t in enumerate(texts):
        w = d.words_of(t)
        for j, u in enumerate(items):
            own = d.words_of(u)
            if not own:
                continue
            q = min(k, len(own))
            c = Counter(tuple(own[x : x + q]) for x in range(len(own) - q + 1))
            for s in range(len(w) - len(own) + 1):
                win = Counter(tuple(w[x : x + q]) for x in range(s, s + len(own) - q + 1))
                common = (c & win).total()
                if (got := common / (c.total() + win.total() - common)) >= least and got > out.get((i, j), 0):
                    out[i, j] = got
    return out


def cases():
    rng = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    items = [" ".join(rng.choice(words) for _ in range(n)) for n in (40, 40, 25, 60, 15, 9, 5, 3, 1)] + ["", "A b A b A b A b A b A b", None]
    texts = ["", None, LONG]
    for _ in range(120):
        own = list(rng.choice([x for x in items if x]).split())
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            own[rng.randrange(len(own))] = rng.choice(words)
        if rng.random() < 0.3:
            own.insert(rng.randrange(len(own)), "new")
        before, after = ([rng.choice(words) for _ in range(rng.randint(0, 60))] for _ in range(2))
        texts.append(" ".join(before) + " " + ", ".join(own).upper() + ". " + " ".join(after))
    return texts, items


def bench(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


@pytest.mark.parametrize("part", [8_000_000, 500])
def test_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(d, "PART_BYTES", part)
    monkeypatch.setattr(d, "SIEVE_BITS", 20)
    texts, items = cases()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in d.contaminated(documents(spark, texts), bench(spark, items)).collect()}
    want = brute(texts, items)
    assert {k: round(v, 12) for k, v in got.items()} == {k: round(v, 12) for k, v in want.items()} and len(want) > 50
    kept = {r["doc_id"] for r in d.decontaminated(documents(spark, texts), bench(spark, items)).collect()}
    assert kept == set(range(len(texts))) - {i for i, _ in want}


def test_documents_shorter_than_the_item(spark):
    rng = random.Random(8)
    items = [[f"w{rng.randrange(10**6)}" for _ in range(n)] for n in (59, 40, 16, 6, 5, 3)]
    texts, want = [], {}
    for j, own in enumerate(items):
        for a in range(4):
            for b in range(len(own) // 3):
                part, k = own[a : len(own) - b], min(5, len(own))
                got = max(0, len(part) - k + 1) / (len(own) - k + 1)
                if got >= 0.8:
                    want[len(texts), j] = (round(got, 12), 0, len(part))
                texts.append(" ".join(part))
    assert any(len(texts[i].split()) == 50 and j == 0 for i, j in want) and len(want) < len(texts)
    items = bench(spark, [" ".join(own) for own in items])
    got = d.contaminated(documents(spark, texts), items).collect()
    assert {(r["doc_id"], r["item_id"]): (round(r["similarity"], 12), r["first_word"], r["n_words"]) for r in got} == want
    kept = {r["doc_id"] for r in d.decontaminated(documents(spark, texts), items).collect()}
    assert kept == set(range(len(texts))) - {i for i, _ in want}


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    items = [(k, [b"w%d" % x for x in rng.integers(0, 99, 20)]) for k in range(200)]
    for radius in (17, 20, 4, 0):
        one = d.SameLength(5, items, radius)
        fps = np.concatenate([one.fps ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, n, replace=False))) for n in (0, 1, 4, 5, 15, 17, 18, 20, 21) for _ in range(3)])
        w, i = one.candidates(fps)
        assert set(zip(w.tolist(), i.tolist(), strict=True)) == {(a, b) for a in range(len(fps)) for b in range(200) if int(fps[a] ^ one.fps[b]).bit_count() <= radius}


def test_index_passes_few_unrelated_items():
    rng = np.random.default_rng(5)
    one = d.SameLength(5, [(k, [b"w%d" % x for x in rng.integers(0, 10**6, 40)]) for k in range(500)], 17)
    passed = one.possible(rng.integers(0, 2**64, 4000, dtype="u8"))
    assert passed.mean() < 0.18


@pytest.mark.parametrize("n", [16, 25, 40, 59])
def test_recall_at_the_threshold(n):
    rng = random.Random(n)
    found = every = 0
    while every < 400:
        own = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        other = list(own)
        for _ in range(rng.randint(1, 3)):  # near an end an edit spoils few shingles
            other[rng.choice([0, 1, 2, 3, n - 4, n - 3, n - 2, n - 1, rng.randrange(n)])] = f"w{rng.randrange(10**6)}"
        index = d.BenchmarkIndex([(0, " ".join(own))], 5, 17)
        c, win = (Counter(tuple(x[s : s + 5]) for s in range(n - 4)) for x in (own, other))
        same = (c & win).total() / (c | win).total()
        if 0.8 <= same < 0.87:
            every += 1
            found += next(index.matches(" ".join(other), 0.8), None) is not None
    assert found >= 0.97 * every


def test_ids_of_text(spark):
    items = spark.createDataFrame([("q-1", "one two three four five six")], "item_id string, text string")
    got = d.contaminated(documents(spark, ["zero one two three four five six seven"]), items).collect()
    assert [(r["doc_id"], r["item_id"], r["similarity"], r["first_word"]) for r in got] == [(0, "q-1", 1.0, 1)]


def test_awkward_rows(spark):
    df = awkward(spark)
    items = bench(spark, ["One, two three: four five six!", "é", None])
    got = sorted(((r["doc_id"], r["item_id"], r["similarity"]) for r in d.contaminated(df, items).collect()), key=str)
    assert got == [(1, 0, 1.0), (7, 0, 1.0), (7, 0, 1.0), (8, 1, 1.0)]
    kept = d.decontaminated(df, items)
    assert kept.columns == df.columns and kept.count() == df.count() - 4


def test_empty_tables(spark):
    some, none = documents(spark, ["a b c"]), documents(spark, [])
    assert d.contaminated(none, bench(spark, ["a b c"])).count() == 0
    assert d.contaminated(some, bench(spark, [])).count() == 0 and d.decontaminated(some, bench(spark, [])).count() == 1

import math
import re
from collections import defaultdict

import numpy as np

from vitrina.llm import mixing, quality


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def plain_targets(size):
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed, free = sum(size.values()), {}, set(order)
    while free:
        left = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] > 3 * size[s]}
        if not over:
            return fixed | {s: left * weight[s] for s in free}
        fixed |= {s: 3.0 * size[s] for s in over}
        free -= over
    return fixed


def mix_rows(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(240):
        source = [None, "a", "b", "é", "z", "big"][rng.choice(6, p=[.05, .02, .2, .1, .13, .5])]
        rows.append((i, " ".join(f"w{i}x{j}" for j in range(int(rng.choice([0, 3, 30, 400])))), source))
    return rows


def test_targets_and_taken(make_docs):
    rows = mix_rows()
    mix = mixing.Mix(make_docs(rows), block=32, shard_slots=64, per_bucket=50)
    got = mix.taken().collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    size, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["size"] == words(rows[r.doc_id][1]) and r.source == rows[r.doc_id][2]
        assert 0 <= r.taken <= 3 * r["size"]
        size[r.source] += r["size"]
        taken[r.source] += r.taken
    want = plain_targets(size)
    for r in got:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9) and r.source_size == size[r.source]
    for s, t in want.items():
        assert abs(taken[s] - t) <= 33
    again = mixing.Mix(make_docs(rows).repartition(7), block=32, shard_slots=64, per_bucket=50).taken().collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in got}


def test_packed_words_are_those_counted(make_docs):
    rows = mix_rows(2)
    mix = mixing.Mix(make_docs(rows), block=32, shard_slots=64)
    assert mix.shards > 1
    counted = {r.doc_id: r.taken for r in mix.taken().collect()}
    packed = mix.packed().collect()
    by, slots = defaultdict(int), defaultdict(list)
    for r in packed:
        part = r.text.split(" ")
        assert len(part) == r.n_words and set(part) <= set(rows[r.doc_id][1].split(" "))
        by[r.doc_id] += r.n_words
        slots[r.shard, r.slot, r.source].append((r["at"], r.n_words))
    assert {d: n for d, n in counted.items() if n} == dict(by)
    for parts in slots.values():  # parts of a slot follow each other without a gap
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))


def test_permutation_is_one():
    for n in (1, 2, 3, 31, 100, 1025):
        got = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 77, np.uint64))
        assert sorted(got.tolist()) == list(range(n))
    assert mixing.permuted(np.arange(100), np.full(100, 100), np.full(100, 1, np.uint64)).tolist() != list(range(100))


def test_mix_odd_rows(make_docs, odd_rows):
    got = mixing.Mix(make_docs(odd_rows)).taken().collect()
    assert len(got) == len(odd_rows)
    assert all(r.taken == 0 for r in got if not r["size"])
    assert sum(r.target for r in {r.source: r for r in got}.values()) == sum(r["size"] for r in got)
    assert mixing.Mix(make_docs([])).taken().count() == 0
    assert mixing.Mix(make_docs([])).packed().count() == 0
    none = mixing.Mix(make_docs([(1, None), (2, "")])).taken().collect()
    assert [(r.target, r.taken) for r in none] == [(0.0, 0)] * 2


def quality_rows():
    good = [(i, f"The house by the river number {i} was built long ago, and people liked it. They came there every day.") for i in range(60)]
    bad = [(100 + i, "spam " * 30 + f"{i}") for i in range(20)] + [(200 + i, f"BUY!! NOW!! {i}### $$$ ***" * 5) for i in range(20)]
    return good, bad


def test_quality_held_out(make_docs, spark):
    good, bad = quality_rows()
    docs = make_docs(good + bad)
    labels = spark.createDataFrame([(d, 1) for d, _ in good] + [(d, 0) for d, _ in bad], "doc_id long, quality int")
    model = quality.learn(docs, labels.where("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in quality.scored(docs, model).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    odd = [d for d in got if d % 2]
    assert np.mean([got[d].predicted == (d < 100) for d in odd]) > 0.95
    kept = quality.keep_quality(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.predicted}


def test_quality_odd_rows(make_docs, odd_rows, spark):
    docs = make_docs(odd_rows)
    labels = spark.createDataFrame([(1, 1), (1, 1), (4, 0), (6, 1), (None, 1), (5, None), (7, 3), (99, 0)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    got = quality.scored(docs, model).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (2, 3, 4)}
    assert len(empty) == 1
    unlearnt = quality.learn(docs, labels.limit(0))
    assert {r.score for r in quality.scored(docs, unlearnt).collect()} == {0.5}
    assert quality.scored(make_docs([]), model).count() == 0 and quality.keep_quality(make_docs([]), model).count() == 0
    assert quality.keep_quality(docs, unlearnt).count() == len(odd_rows)


def overlapping_rows(seed=4):
    """Good and bad documents whose strengths overlap, no two texts alike."""
    rng = np.random.default_rng(seed)

    def text(i, share):
        return " ".join("spam" if rng.random() < share else f"w{rng.integers(10 ** 6)}" for _ in range(40 + i))
    return [(i, text(i, rng.uniform(0.05, 0.5))) for i in range(100)], [(100 + i, text(i, rng.uniform(0.25, 0.7))) for i in range(20)]


def test_quality_threshold_covers_all_labelled(make_docs, spark):
    good, bad = overlapping_rows()
    docs = make_docs(good + bad)
    labels = spark.createDataFrame([(d, 1) for d, _ in good] + [(d, 0) for d, _ in bad], "doc_id long, quality int")
    for max_rows in (10_000, 20, 10):  # the bound holds for neither label, for one, for both
        model = quality.learn(docs, labels, max_rows=max_rows)
        assert quality.scored(docs, model).where("predicted = 0").count() == len(bad)


def test_strength_of_a_rank(spark):
    values = [0.0, 1e-300, 5.0, 5.0, 5.0, -3.5, 1e9] + [i / 7 for i in range(60)]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    for rank in (0, 1, 2, 30, 40, 65, 66):
        assert quality.ranked(df, rank, bins=4) == sorted(values)[rank]


def test_quality_repeated_rows_are_one_document(make_docs, spark):
    good, bad = overlapping_rows()
    labels = spark.createDataFrame([(d, 1) for d, _ in good] + [(d, 0) for d, _ in bad], "doc_id long, quality int")
    once = quality.learn(make_docs(good + bad), labels, max_rows=100)
    assert any(once.weights)
    assert quality.learn(make_docs(good[:1] * 800 + good + bad), labels, max_rows=100) == once

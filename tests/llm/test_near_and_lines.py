import itertools
import random
import re

import xxhash
from pyspark.sql import functions as F

from vitrina.llm import linededup, simhash


def plain_fingerprint(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, max_bits):
    """Of {doc: fingerprint}: the smallest doc of each doc's component."""
    best = {d: d for d in fps}
    while True:
        new = {d: min(best[e] for e in fps if (fps[d] ^ fps[e]).bit_count() <= max_bits) for d in fps}
        if new == best:
            return best
        best = new


def near_texts(n, seed):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 40, 120]))] for _ in range(n // 4)]
    out = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2])):
            words[rng.randrange(len(words))] = f"W{rng.randrange(400)}"
        out.append((i, rng.choice([" ", "  ", "\n"]).join(words)))
    return out


def test_simhash_equals_brute_force(make_docs):
    rows = near_texts(120, 5)
    fps = {d: plain_fingerprint(t) for d, t in rows}
    want = plain_components(fps, 4)
    assert len(set(want.values())) < len(want)
    for limit in (65536, 1):  # all large buckets go the other way
        got = simhash.near_duplicates(make_docs(rows), 4, 4, bucket_limit=limit).collect()
        assert {r.doc_id: int(r.fingerprint, 16) for r in got} == fps
        assert {r.doc_id: r.component_id for r in got} == want


def test_key_masks_cover_every_close_pair():
    masks = simhash.key_masks(7, 4)
    for bits in itertools.combinations(range(0, 64, 5), 4):
        x = sum(1 << b for b in bits)
        assert any(x & m == 0 for m in masks)


def test_simhash_odd_rows(make_docs, odd_rows, spark):
    got = simhash.near_duplicates(make_docs(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by[2] == by[3] == by[4] == {("0" * 16, 2)}
    assert by[6] == by[7] and {c for _, c in by[6]} == {6}
    # a document without id takes part: it shares the component of document 1
    assert ("0" * 16, 2) in by[None] and {c for _, c in by[None]} == {1, 2}
    assert simhash.near_duplicates(make_docs([])).count() == 0
    kept = simhash.deduplicate(make_docs(odd_rows))
    assert kept.columns == make_docs(odd_rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 5, 6, 8, 9]
    nameless = simhash.deduplicate(make_docs([(None, "a b c d e"), (None, "a b c d e"), (None, "q r s t u")])).collect()
    assert sorted(r.text for r in nameless) == ["a b c d e", "q r s t u"]
    assert simhash.deduplicate(make_docs([])).count() == 0


def plain_lines(rows, words=5, t=5):
    """{doc: text left}, doc_ids distinct and not null."""
    def n(x):
        return len(re.findall(r"[^\x20\x09-\x0D]+", x))

    lines = {d: [(i, x) for i, x in enumerate((text or "").split("\n")) if n(x)] for d, text in rows}
    gone, first = {d: set() for d in lines}, {}
    for d in sorted(lines):
        own = [x for _, x in lines[d]]
        short = [n(x) < words for x in own]
        for j, x in enumerate(own):
            if not short[j]:
                at = first.setdefault(x, (d, j))
                if at != (d, j):
                    gone[d].add(j)
                    other = [y for _, y in lines[at[0]]]
                    for step in (-1, 1):
                        k = step
                        while 0 <= j + k < len(own) and 0 <= at[1] + k < len(other) and short[j + k] and own[j + k] == other[at[1] + k]:
                            gone[d].add(j + k)
                            k += step
            if all(short[j:j + t]) and j + t <= len(own):
                at = first.setdefault(tuple(own[j:j + t]), (d, j))
                if at != (d, j):
                    gone[d] |= set(range(j, j + t))
    gone = {d: {lines[d][j][0] for j in g} for d, g in gone.items()}
    return {d: None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[d]) for d, text in rows}


def test_lines_equal_brute_force(make_docs):
    rng = random.Random(3)
    long = [" ".join(f"l{rng.randrange(50)}" for _ in range(25)) for _ in range(4)]
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", "  ", "d e", *long]) if i % 2 else rng.choice(["a", "b", "a b", " ", f"p{i} q r s t"])
                       for _ in range(rng.randrange(1, 25)))) for i in range(80)]
    got = linededup.line_dedup(make_docs(rows)).collect()
    assert {r.doc_id: r.text for r in got} == plain_lines(rows)
    assert all(r.n_chars == len(r.text) for r in got)


def test_lines_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    out = linededup.line_dedup(docs)
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got[2] == [None] and got[3] == [""] and got[4] == [" \t\n "]
    assert got[6] == ["same text here"] * 2  # a repeated row is one document
    assert got[9] == ["x\ny\nz\n\nx\ny\nz"]  # few short lines alone stay
    assert len(got[None]) == 2
    report = {r.doc_id: (r.n_lines, r.n_removed) for r in linededup.line_report(docs).where("doc_id in (2, 9)").collect()}
    assert report == {2: (0, 0), 9: (6, 0)}
    assert linededup.line_dedup(make_docs([])).count() == 0


def test_every_longer_line_stays_once(make_docs):
    line, frame = "one two three four five", "{\n  x\n"
    rows = [(i, f"{frame}{line}\nend {i}") for i in range(40)] + [(50, f"other\n{line}\nend 7"), (51, "x\nend 7")]
    got = {r.doc_id: r.text for r in linededup.line_dedup(make_docs(rows)).collect()}
    assert got == {0: rows[0][1], **{i: f"end {i}" for i in range(1, 40)}, 50: "other\nend 7", 51: "x\nend 7"}


def test_copies_lose_all_lines_but_stay(make_docs):
    text = "\n".join(f"line {i}" + " and more words" * (i % 4) for i in range(30))
    got = {r.doc_id: r.text for r in linededup.line_dedup(make_docs([(2, text), (1, text), (None, text)])).collect()}
    assert got == {1: text, 2: "", None: ""}


def test_many_copies_make_few_rows(make_docs, spark):
    rows = [(i, "a b c d e f g " + "x " * (i % 3)) for i in range(300)]
    edges = simhash.links(simhash.fingerprints(make_docs(rows)), 4)
    assert edges.count() <= 35 * 3
    assert edges.where(F.col("a") == F.col("b")).count() == 0

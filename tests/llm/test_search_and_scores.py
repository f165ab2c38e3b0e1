import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitrina.llm import decontaminate, licenses, lmscore, substring, topk, urlfilter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- substring dedup

def plain_repeats(rows, w):
    """The words left of each row, and how many go."""
    texts = [WORD.findall(t or "") for _, t, *_ in rows]
    seen = Counter(tuple(x[i:i + w]) for x in texts for i in range(len(x) - w + 1))
    out = []
    for (d, *_), x in zip(rows, texts):
        gone = {j for i in range(len(x) - w + 1) if seen[tuple(x[i:i + w])] > 1 for j in range(i, i + w)}
        out.append((d, len(x), len(gone), " ".join(v for j, v in enumerate(x) if j not in gone)))
    return sorted(out, key=str)


def repeat_texts(n, seed):
    rng = random.Random(seed)
    passages = [[f"p{rng.randrange(30)}" for _ in range(rng.randrange(20, 120))] for _ in range(8)]
    passages += [["run"] * 90, ["u", "v"] * 50, ["u", "v", "w"] * 30]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            words += p[a:a + rng.randrange(1, 100)] if rng.random() < 0.6 else p
            words += [f"n{rng.randrange(500)}" for _ in range(rng.randrange(0, 60))]
        rows.append((i, "".join(x + rng.choice([" ", "\n", " \t"]) for x in words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_equals_brute_force(make_docs, seed):
    rows = repeat_texts(70, seed)
    got = substring.remove_repeats(make_docs(rows), 35).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_repeats(rows, 35)


def test_substring_odd_rows(make_docs, odd_rows):
    rows = odd_rows + [(20, "r " * 40), (21, "t " * 35), (22, " ".join(f"k{i}" for i in range(35))), (22, " ".join(f"k{i}" for i in range(35)))]
    got = substring.remove_repeats(make_docs(rows), 35).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_repeats(rows, 35)
    assert substring.remove_repeats(make_docs([]), 35).count() == 0
    assert [tuple(r) for r in substring.remove_repeats(make_docs([(1, None)]), 35).collect()] == [(1, 0, 0, "")]


# --- benchmark decontamination

def plain_contamination(rows, items, n):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    grams = {}
    for item, t in items:
        x = split(t)
        for i in range(max(len(x) - n, 0) + 1 if x else 0):
            grams.setdefault(tuple(x[i:i + n]), set()).add(item)
    out = []
    for d, t, *_ in rows:
        x, hit, ids = split(t), set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(x) - k + 1):
                if (g := tuple(x[i:i + k])) in grams:
                    hit |= set(range(i, i + k))
                    ids |= {str(i) for i in grams[g] if i is not None}
        out.append((d, len(x), len(hit), len(ids), sorted(ids), bool(hit)))
    return sorted(out, key=str)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_contamination_equals_brute_force(make_docs, spark):
    rng = random.Random(4)
    word = lambda: f"t{min(rng.randrange(60), rng.randrange(60))}"
    items = [(i, " ".join(word() for _ in range(rng.randrange(0, 22)))) for i in range(30)]
    items += [(40, "Only THREE-words"), (41, "Ünïque"), (42, None), (43, "!!"), (None, "t1 t2"), (3, items[5][1])]
    rows = []
    for i in range(60):
        words = [word() for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            x = rng.choice(items)[1] or ""
            at = rng.randrange(len(words) + 1)
            words[at:at] = x.upper().split()
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    rows += [(70, "an only three words, ünïque."), (71, None), (72, "...")]
    got = decontaminate.contamination(make_docs(rows), bench(spark, items), 10).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_contamination(rows, items, 10)
    clean = decontaminate.clean(make_docs(rows), bench(spark, items), 10)
    assert clean.columns == make_docs(rows).columns
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in plain_contamination(rows, items, 10) if not r[-1]}


def test_contamination_without_broadcast(make_docs, spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    rows, items = [(1, "a b c d e f g h i j k l"), (2, "x y z")], [(1, "b c d e f g h i j k"), (2, "y")]
    got = decontaminate.contamination(make_docs(rows), bench(spark, items), 10).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_contamination(rows, items, 10)


def test_contamination_odd_rows(make_docs, odd_rows, spark):
    items = [(1, "two three four"), (2, "SAME text"), (None, "six"), (3, None)]
    got = decontaminate.contamination(make_docs(odd_rows), bench(spark, items), 10).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_contamination(odd_rows, items, 10)
    assert decontaminate.contamination(make_docs([]), bench(spark, items), 10).count() == 0
    none = decontaminate.contamination(make_docs(odd_rows), bench(spark, []), 10).collect()
    assert len(none) == len(odd_rows) and not any(r.contaminated for r in none)


def test_proximity(make_docs, spark):
    index = decontaminate.Index(make_docs([(1, "alpha x beta"), (2, "alpha x x x x beta"), (3, "beta alpha")]), bench(spark, [(1, "alpha beta")]), 10)
    assert {r.doc_id for r in index.proximity(1).collect()} == {1}
    assert {r.doc_id for r in index.proximity(4).collect()} == {1, 2, 3}


# --- top-k

def plain_topk(rows, k):
    usable = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, x) in enumerate(usable):
        if q is not None and q % 20 == 0:
            score = sorted((-sum(a * b for a, b in zip(x, v)), i is None, i or 0) for j, (i, v) in enumerate(usable) if j != at)
            out += [(q, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(score[:k])]
    return sorted(out, key=str)


def is_query():
    return F.col("vec_id") % 20 == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_topk_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(0, 0.3, (30, 12))
    rows = [(i, [float(x) for x in base[rng.integers(30)] if True], 0) for i in range(300)]  # many equal vectors
    rows += [(301, None, 0), (302, [1.0, None], 0), (303, [float("nan")] * 12, 0), (320, [float("inf")] * 12, 0), (None, [1.0] * 12, 0),
             (304, [], 0), (340, [0.5, -0.5], 0), (360, [0.0] * 12, 0)]
    # repeated rows, ids that two vectors share, rows without an id
    rows += [rows[7], rows[40], rows[40], (60, [0.25] * 12, 0), (7, [2.0] * 12, 0), (None, [1.0] * 12, 0), (None, [0.75] * 12, 0)]
    df = vectors(spark, rows).repartition(4)
    for blocks in ({"query_block": 5, "block": 64}, {}):
        got = topk.top_k(df, is_query(), 20, **blocks).collect()
        assert sorted((tuple(r) for r in got), key=str) == plain_topk([r[:2] for r in rows], 20)


def test_topk_huge_components_are_refused(spark):
    for x in (1e18, -1e300, 3e17):
        df = spark.createDataFrame([(0, [x]), (1, [x])], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="beyond 62 bits"):
            topk.top_k(df, is_query()).collect()


def test_topk_few_rows(spark):
    df = vectors(spark, [(0, [0.5], 0), (1, [0.25], 0), (2, [-1.0], 0)])
    got = topk.top_k(df, is_query()).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 1, 512), (0, 2, 2, -2048)]
    assert topk.top_k(df.limit(0), is_query()).count() == 0 and topk.top_k(df, F.lit(False)).count() == 0


def test_bit_slices_score_every_row():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-40, 41, (130, 9)), rng.integers(-40, 41, 9)
    index = topk.BitSlices(np.arange(130), np.arange(130), x)
    slices = index.score_slices(q)
    total = sum((np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(np.int64) << i) for i, s in enumerate(slices))
    assert len(set((total - x @ q).tolist())) == 1


# --- language-model scores

def plain_lm(rows, order, alpha=0.4):
    """{(doc, text): sum of log2 scores}, by counting everything but the text's copies."""
    split = [(d, tuple(re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())), t or "") for d, t in rows]
    total = sum(len(w) for _, w, _ in split)
    counts = Counter(w[i:i + k] for _, w, _ in split for k in range(1, order + 1) for i in range(len(w) - k + 1))
    out = {}
    for d, w, t in split:
        copies = sum(t == u for _, _, u in split)
        own = Counter(w[i:i + k] for k in range(1, order + 1) for i in range(len(w) - k + 1))

        def left(g):
            return counts[g] - copies * own[g]

        def score(g):
            if len(g) == 1:
                return math.log2((left(g) + 1) / (total - copies * len(w) + 1))
            return math.log2(left(g) / left(g[:-1])) if left(g) > 0 and left(g[:-1]) > 0 else math.log2(alpha) + score(g[1:])

        out[d, t] = (len(w), sum(score(w[max(0, i - order + 1):i + 1]) for i in range(len(w))))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_equals_brute_force(make_docs, order):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["ab", "cd", "ÿ", "abc", "x", "", "\n"]) for _ in range(rng.randrange(0, 30)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, rows[0][1]), (72, rows[0][1]), (73, "only here"), (74, " \t "), (75, "ab"), (76, "\xa0 ab")]
    want = plain_lm(rows, order)
    for size in (100, 1 << 20):
        got = lmscore.lm_scores(make_docs(rows), order=order, block_bytes=size, part_words=size).collect()
        assert len(got) == len(rows)
        texts = dict(rows)
        for r in got:
            n, total = want[r.doc_id, texts[r.doc_id] or ""]
            assert r.n_words == n and math.isclose(r.log2_prob, total, rel_tol=1e-9, abs_tol=1e-9), r
            assert (r.mean_log2 is None) == (n == 0)


def test_lm_sees_word_order(make_docs):
    rng = random.Random(5)
    after = {f"w{i}": [f"w{rng.randrange(60)}" for _ in range(4)] for i in range(60)}

    def text():
        words = ["w0"]
        while len(words) < 80:
            words.append(rng.choice(after[words[-1]]))
        return words

    plain = [text() for _ in range(200)]
    mixed = [rng.sample(w, len(w)) for w in plain[:50]]
    rows = [(i, " ".join(w)) for i, w in enumerate(plain)] + [(1000 + i, " ".join(w)) for i, w in enumerate(mixed)]
    means = {r.doc_id: r.mean_log2 for r in lmscore.lm_scores(make_docs(rows)).collect()}
    assert max(means[1000 + i] for i in range(50)) < min(means[i] for i in range(200)) - 1


def test_lm_odd_rows(make_docs, odd_rows):
    got = lmscore.lm_scores(make_docs(odd_rows)).collect()
    assert len(got) == len(odd_rows) and all(math.isfinite(r.log2_prob) for r in got)
    assert lmscore.lm_scores(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        lmscore.lm_scores(make_docs([]), order=0)


def test_lm_repeated_rows_spread(make_docs):
    docs = make_docs([(1, "one text " * 20)] * 200 + [(None, "other")])
    got = lmscore.lm_scores(docs, block_bytes=1800).collect()
    assert len(got) == 201 and len({(r.doc_id, r.log2_prob) for r in got}) == 2
    assert max(r["count"] for r in lmscore.blocked(docs, 10).groupBy("block").count().collect()) <= 10


def test_lm_block_read_by_two_tasks():
    one, other = (np.array(x, np.uint64) for x in ([1, 5, 9], [5, 7]))
    rows = [(8, 1, 0, one, [1, 2, 300]), (8, 1, 0, other, [4, 1]), (9, 1, 0, other, [1, 1])]
    lists = pd.DataFrame([(b, k, p, lmscore.pack(c, np.array(n))) for b, k, p, c, n in rows], columns=["block", "k", "part", "list"])
    got = {r.block: lmscore.unpack_counts(r.counts).tolist() for r in lmscore._answered(lists).itertuples()}
    assert got == {8: [1, 7, 2, 300], 9: [7, 2]}


def test_lm_packed_lists():
    rng = np.random.default_rng(1)
    for codes in (rng.integers(0, 2**64, 5000, np.uint64), np.array([0, 1, 2**64 - 1], np.uint64), np.zeros(1, np.uint64), np.zeros(0, np.uint64)):
        codes = np.unique(codes)
        n = rng.choice([1, 1, 1, 2, 10**12], len(codes)).astype(np.int64)
        a, b = lmscore.unpack(lmscore.pack(codes, n))
        assert (a == codes).all() and (b == n).all() and len(a) == len(codes)
        assert (lmscore.unpack_counts(lmscore.pack_counts(n + 253)) == n + 253).all()
    assert len(lmscore.pack(np.arange(0, 10**9, 10**5, dtype=np.uint64), np.ones(10**4, np.int64))) < 3 * 10**4 + 100


# --- url filters

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "com", "/en/x")]


def plain_verdict(url, blocked=()):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = ("", "") if not m else ("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2])
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fit) if fit else (0, 0, None, "block" if host + path in blocked else "allow")
    return host, path, rule[2], rule[3]


def test_urls_equal_brute_force(spark):
    rng = random.Random(1)
    urls = [rng.choice(["http://", "HTTPS://", "", "x://y://"]) + rng.choice(["com", "a.com", "Example.COM", "www.example.com", "b.www.example.com", "xexample.com", "a.net", "", "é.net", "com."])
            + rng.choice(["", "/", "/en/", "/en/x?y=/es/", "/es/#t", "/e", "?q", "#/en/", "/en/é"]) for _ in range(400)]
    rows = [(i, u, "") for i, u in enumerate(urls)] + [(None, None, None), (1, urls[1], ""), (999, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = urlfilter.filter_urls(pages, RULES, blocked=["a.net/e", "a.net"]).collect()
    want = [(i, *plain_verdict(u, ("a.net/e", "a.net"))) for i, u, _ in rows]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    assert urlfilter.filter_urls(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in urlfilter.filter_urls(pages, []).collect()} == {"allow"}
    with pytest.raises(ValueError):
        urlfilter.filter_urls(pages, RULES, max_rules=2)


def test_digests_that_collide(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "digest", lambda s: len(s) % 3)
    array = urlfilter.DigestArray(spark, ["aa", "b", "cccc", "dd"], 10)
    found = urlfilter.MappedArray(array.data.value, array.n).find([b"dd", b"xx", b"cccc", b"aa", b"b", b"zz"])
    assert [array.order[i] if i >= 0 else None for i in found] == [3, None, 2, 0, 1, None]


# --- licence scans

@pytest.fixture(scope="module")
def license_model(make_docs):
    rng = random.Random(6)
    rows = [(i, "\n".join(" ".join(rng.choice(["river", "house", "the", "of", "work", "under", "use", "new", "free", "all"]) for _ in range(9)) for _ in range(6))) for i in range(100)]
    return licenses.train(make_docs(rows), sample=300)


def test_licenses_found_and_others_left(make_docs, license_model):
    texts = {
        1: ("Some words first.\nLicensed under the Apache License, Version 2.0.\nAnd last.", [(1, "Apache-2.0")]),
        2: ("All rights reserved.", [(0, "proprietary")]),
        3: ("Copyright (c) 2024 Somebody Else. Released under the MIT License.", [(0, "MIT")]),
        4: ("This project is licensed under the GNU General Public License, version 3, as you know.", [(0, "GPL-3.0")]),
        5: ("licensed under cc by-nc 4.0", [(0, "CC-BY-NC-4.0")]),
        6: ("The house of the river is new.\nAll of the work is free.", []),
    }
    got = licenses.scan(make_docs([(d, t) for d, (t, _) in texts.items()]), license_model).collect()
    found = {d: sorted((r.paragraph, r.family) for r in got if r.doc_id == d) for d in texts}
    assert found == {d: want for d, (_, want) in texts.items()}


def test_license_without_confirmation_is_unknown(make_docs, license_model):
    got = licenses.scan(make_docs([(1, "This work is licensed under the Foo Bar Public License, version 9, see SPDX-License-Identifier")]), license_model).collect()
    assert {r.family for r in got} <= {"unknown"}
    assert licenses.scan(make_docs([(1, "Released under the MIT License.")]), license_model, confirmed=1.1).first().family == "unknown"


def test_license_odd_rows(make_docs, odd_rows, license_model):
    assert licenses.scan(make_docs(odd_rows), license_model).count() == 0
    assert licenses.scan(make_docs([(1, " ".join(f"w{i}" for i in range(5000)))]), license_model).count() == 0
    assert licenses.scan(make_docs([]), license_model).count() == 0
    twice = licenses.scan(make_docs([(None, "All rights reserved."), (None, "All rights reserved.")]), license_model).collect()
    assert [r.family for r in twice] == ["proprietary"] * 2
    assert licenses.train(make_docs([])).threshold >= 0.5




def families(found):
    return sorted((r.paragraph, r.family) for r in found.collect())


def test_short_templates_are_compared_by_words(make_docs, license_model):
    text = "Copyright (c) 2021 the authors. SPDX-License-Identifier: MIT"
    got = licenses.scan(make_docs([(1, text)]), license_model).collect()
    assert [(r.family, r.similarity, r.text) for r in got] == [("MIT", 1.0, text)]
    either = licenses.scan(make_docs([(1, "# SPDX-License-Identifier: MIT OR Apache-2.0")]), license_model).collect()
    assert len(either) == 1 and either[0].family in ("MIT", "Apache-2.0")


def test_license_without_template_is_reported(make_docs, license_model):
    got = licenses.scan(make_docs([(1, "The river is new.\nDistributed under the Boost Software License")]), license_model)
    assert families(got) == [(1, "unknown")]


def test_wrapped_notices(make_docs, license_model):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files, to deal in the\nSoftware without restriction."
    gpl = " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License, either version 3\n * of the License, or any later version."
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met."
    isc = "Permission to use, copy,\nmodify, and distribute\nthis software for any\npurpose with or without\nfee is hereby granted."
    short = "Released under\nthe MIT License."
    for text, family in ((mit, "MIT"), (gpl, "GPL-3.0"), (bsd, "BSD-3-Clause"), (isc, "ISC"), (short, "MIT")):
        got = licenses.scan(make_docs([(1, f"The house is new.\n\n{text}\n\nThe river is free.")]), license_model).collect()
        assert [(r.paragraph, r.family, r.text) for r in got] == [(2, family, text)]
    # a blank line separates; two notices and a repeated row are reported each
    apart = licenses.scan(make_docs([(1, short.replace("\n", "\n\n"))]), license_model).collect()
    assert not any(r.similarity == 1.0 for r in apart)
    both = licenses.scan(make_docs([(1, f"{mit}\n{gpl}")] * 2), license_model)
    assert families(both) == [(0, "MIT")] * 2 + [(3, "GPL-3.0")] * 2


def test_license_model_counts_every_ordinary_paragraph(make_docs):
    """all paragraphs are counted, not those with the smallest hashes."""
    triples = ["under the mit", "the mit license"]
    lines = [f"Line {i} is free to use under these conditions" for i in range(300)] + ["Released under the MIT License.", "a copyright line"]
    docs = make_docs([(i, f"{a}\n{a}") for i, a in enumerate(lines)])
    found = licenses.ordinary(docs, triples, ["free", "free to", "use"]).collect()
    assert sum(r.n for r in found) == 300 and {tuple(r.grams) for r in found} == {("free", "free to", "use")}

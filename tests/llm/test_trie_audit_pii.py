"""Conversation trie, filter audit and personal data against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vitrina.llm import convtrie, filteraudit, pii, queries

CONV = "conv_id long, turn long, role string, text string"


# --- conversation prefix trie --------------------------------------------------------

def plain_trie(sequences):
    """Node rows from {conv_id: [(role, text), ...]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[:len(node)] == node]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        leaves = sum(1 for x in below if not any(len(y) == len(x) + 1 and y[:-1] == x for y in members))
        ids = ",".join(str(c) for c in sorted(ends.get(node, [])))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(1 for y in members if len(y) == len(node) + 1 and y[:-1] == node), leaves, saved, hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def plain_sequences(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in turns.items()}


def plain_rebuilt(rows):
    own, out = plain_sequences(rows), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie_rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def conversation_rows(seed=1, n=60):
    rnd, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rnd.randrange(0, 9)):
            rows.append((c * (3 if c % 7 == 0 else 1), t, rnd.choice(["user", "assistant", None]), rnd.choice(["á b", "b", "", None, "hello there"])))
    # the same conversation under many ids, far apart
    rows += [(10_000 + 97 * i, t, "user", f"same {t}") for i in range(40) for t in range(3)]
    seen = set()
    return [r for r in rows if (r[0], r[1]) not in seen and not seen.add((r[0], r[1]))]


@pytest.mark.parametrize("shard_convs, queue_limit", [(4096, 500_000), (3, 2), (1, 2)])
def test_trie_equals_brute_force(spark, shard_convs, queue_limit):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, CONV).repartition(5).withColumn("depth", F.lit("extra")).withColumn("p1", F.lit("extra"))
    assert trie_rows(convtrie.prefix_trie(df, shard_convs=shard_convs, queue_limit=queue_limit)) == plain_trie(plain_sequences(rows))
    got = convtrie.prefix_trie(df, rebuilt=True, shard_convs=shard_convs, queue_limit=queue_limit)
    assert trie_rows(got) == plain_trie(plain_rebuilt(rows))


def test_trie_odd_rows(spark):
    long = "x" * 300_000
    rows = [(None, 1, "user", "gone"), (5, None, "user", "first"), (5, 0, None, None), (7, 3, "user", long), (7, 3, "user", long), (-7, 1, "", ""),
            (9, 1, "user", "turn"), (11, 2, "user", "turn")]
    df = spark.createDataFrame(rows, CONV)
    assert trie_rows(convtrie.prefix_trie(df)) == plain_trie(plain_sequences(rows))
    assert trie_rows(convtrie.prefix_trie(df, rebuilt=True)) == plain_trie(plain_rebuilt(rows))
    assert convtrie.prefix_trie(df.limit(0), rebuilt=True).count() == 0


def test_trie_long_conversation_and_repeats(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(3000)] + [(2, t, "user", f"t{t}") for t in range(2500)] + [(3, 0, "user", "t0")] * 4
    got = trie_rows(convtrie.prefix_trie(spark.createDataFrame(rows, CONV), shard_convs=1, queue_limit=2))
    root = next(r for r in got if r[1] == 0)
    shared = sum(len(f"t{t}") for t in range(1, 2500)) + 2 * len("t0")
    assert root[:7] == (1, 0, None, 3, 1, 2, shared)
    assert len(got) == 1 + 3000 + 3


def test_trie_of_ties_is_the_same_in_any_order(spark):
    rows = [(c, t % 2, "user", f"{t}") for c in range(4) for t in range(6)]
    a = trie_rows(convtrie.prefix_trie(spark.createDataFrame(rows, CONV).repartition(7)))
    b = trie_rows(convtrie.prefix_trie(spark.createDataFrame(rows[::-1], CONV).repartition(2)))
    assert a == b and len(a) == 7  # equal turns are ordered alike in all four conversations


def test_trie_texts(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "bot", None), (2, 0, "user", "hi")]
    df = spark.createDataFrame(rows, CONV)
    got = {(r.conv_id, r.depth): (r.role, r.text) for r in convtrie.node_turns(convtrie.prefix_trie(df), df).collect()}
    assert got == {(1, 0): (None, None), (1, 1): ("user", "hi"), (1, 2): ("bot", "")}


def test_queue_spills_and_keeps_order():
    rnd, q, plain = random.Random(3), convtrie.SpillingQueue(limit=16, block=4), []
    out, expected = [], []
    for i in range(3000):
        if plain and rnd.random() < 0.4:
            plain.sort()
            expected.append(plain.pop(0))
            out.append(q.pop())
        else:
            item = (rnd.randrange(500), i)
            plain.append(item)
            q.push(item)
    while q.peek() is not None:
        out.append(q.pop())
    assert out == expected + sorted(plain) and q.spills > 10


def test_ends_of_a_hot_node_are_streamed(spark, monkeypatch):
    monkeypatch.setattr(convtrie, "END_CHUNK", 8)
    rows = [(c, 0, "user", "all the same") for c in range(-30, 300, 3)]
    got = trie_rows(convtrie.prefix_trie(spark.createDataFrame(rows, CONV)))
    assert got == plain_trie(plain_sequences(rows))


# --- filter interaction audit --------------------------------------------------------

def plain_masks(docs, labels):
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    least, out = {}, []
    for d, text, _ in docs:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    for d, text, lang in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": d is not None and least[t] < d}
        out.append((lang or "", {f for f in fails if fails[f]}, d is not None and d in good, d is not None and d in toxic))
    return out


def plain_audit(docs, labels):
    rows, out = plain_masks(docs, labels), []
    orders = ["".join(p) for p in itertools.permutations("ABCDE")]
    for part in {r[0] for r in rows}:
        mine, shapley = [r for r in rows if r[0] == part], defaultdict(int)
        found = []
        for o in orders:
            for i, f in enumerate(o):
                left = [r for r in mine if not r[1] & set(o[:i])]
                gone = [r for r in left if f in r[1]]
                shapley[f] += len(gone)
                found.append((part, o, i + 1, len(left) - len(gone), len(gone), sum(f in r[1] for r in mine) - len(gone),
                              sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out += [(*r, shapley[r[1][r[2] - 1]]) for r in found]
    return sorted(out)


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_docs(seed=5):
    rnd = random.Random(seed)
    long = " ".join(f"w{i}" for i in range(250))
    texts = [long, long + " #", long.upper(), "w " * 300, "", None, "short", " ".join(f"w{i % 90}" for i in range(220)) + " |"]
    docs = [(rnd.choice([None, *range(60)]), rnd.choice(texts), rnd.choice(["en", "fr", None, ""])) for _ in range(200)]
    docs += [(7, "short", "en")] * 5 + [(7, "short", "fr")]
    return docs, [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 70)] + [(3, 1, 1), (None, 1, 1)]


def write_files(spark, docs, path, files):
    for i in range(files):
        mine = [(d, t, x, "extra") for d, t, x in docs[i::files]]
        spark.createDataFrame(mine, "doc_id long, text string, lang string, mask string").coalesce(1).write.mode("append").parquet(path)


def audit_rows(df):
    return sorted(tuple(r) for r in df.select(*AUDIT).collect())


def test_audit_equals_brute_force_and_retracts(spark, tmp_path):
    docs, labels = audit_docs()
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    path = str(tmp_path / "documents.parquet")
    docs = sorted(docs, key=lambda r: -1 if r[0] is None else -r[0])  # smaller ids come later
    write_files(spark, docs, path, 3)
    a = filteraudit.Audit(spark, path, labelled, str(tmp_path / "audit"), files_per_batch=1)
    a.advance()
    assert audit_rows(a.report()) == plain_audit(docs, labels)
    # moves of a smaller id that came in a later batch take earlier ones back
    assert spark.read.parquet(f"{a.root}/moves").where("n < 0").select("batch").distinct().count() > 1
    # further files, and no files
    more = [(-5, "short", "en"), (1000, docs[0][1], "de"), (-1, None, None)]
    write_files(spark, more, path, 1)
    again = filteraudit.Audit(spark, path, labelled, a.root)
    again.advance()
    again.advance()
    assert audit_rows(again.report()) == plain_audit(docs + more, labels)


def test_audit_batches_do_not_matter(spark, tmp_path):
    docs, labels = audit_docs(6)
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    path = str(tmp_path / "documents.parquet")
    write_files(spark, docs, path, 3)
    assert audit_rows(filteraudit.audit(spark, path, labelled)) == plain_audit(docs, labels)


def test_audit_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    write_files(spark, [], path, 1)
    labelled = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.audit(spark, path, labelled).count() == 0


def test_audit_rerun_of_a_batch_counts_once(spark, tmp_path):
    docs, labels = audit_docs(8)
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    path = str(tmp_path / "documents.parquet")
    write_files(spark, docs, path, 2)
    a = filteraudit.Audit(spark, path, labelled, str(tmp_path / "audit"), files_per_batch=1)
    failed = []

    def once_failing(df, batch_id, masks=a._masks):
        masks(df, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("executor lost after the write")
    a._masks = once_failing
    with pytest.raises(Exception):
        a.advance()
    a.advance()
    assert failed and audit_rows(a.report()) == plain_audit(docs, labels)


# --- personal data -------------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(sum(divmod(2 * int(x), 10)) if i % 2 else int(x) for i, x in enumerate(reversed(digits))) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                  "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


CARD, OTHER = "4556737586899855", "4556737586899856"
TRAPS = ["a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 00001.2.3.4", f"{CARD} {CARD}", f"{CARD}-1 {OTHER}", "+1 (826) 555-4081 190.137.223.204",
         f"é𝄞 {CARD} 𝄞 me@x.example.com", "+34 600 100 200. +1-2", "v1.2.3.4 ab.c+d%e@f-g.h.i-j", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0", "@@@ a@ @b.c ....", None, ""]


def pii_docs():
    rnd, rows = random.Random(9), []
    for i in range(120):
        words = [rnd.choice(["the", "mail", "call", "of", "version", "é"]) for _ in range(12)]
        words[3] = rnd.choice([f"u{i}@mail.example.com", f"+1 (555) 555-{1000 + i}", f"10.{i}.3.4", CARD, OTHER, f"{i}{i}"])
        rows.append((i, " ".join(words)))
    return rows + [(1000 + i, t) for i, t in enumerate(TRAPS)] + [(None, TRAPS[0]), (7, TRAPS[2]), (7, TRAPS[2])]


def test_pii_base_spans_equal_brute_force(spark):
    rows = pii_docs()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("row", F.lit("extra")).withColumn("kind", F.lit("extra"))
    got = pii.report(pii.find_pii(df)).collect()
    expected = [(d, *[sum(s[0] == k for s in plain_base(t)) for k in pii.KINDS], hashlib.sha256(listed(plain_base(t)).encode()).hexdigest()) for d, t in rows]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(expected, key=str)


def test_pii_added_spans(spark):
    rows = pii_docs()
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = defaultdict(list)
    for d, t in rows:
        texts[d].append(t)
    for r in found:
        assert r.spans == sorted(r.spans, key=lambda s: (pii.KINDS.index(s.kind), s.start, s.end))
        for s in r.spans:
            assert any(t is not None and t[s.start:s.end] == s.text for t in texts[r.doc_id])
        base = [s for s in r.spans if s.base]
        assert not any(s.start < b.end and b.start < s.end for s in r.spans if not s.base for b in base)
    by_id = {r.doc_id: r.spans for r in found}
    # what a longer run hides is added: both cards, and the phone before an address
    assert [(s.kind, s.base) for s in by_id[1002]] == [("card", False), ("card", False)]
    assert {(s.kind, s.text, s.base) for s in by_id[1004]} == {("ip", "190.137.223.204", True), ("phone", "+1 (826) 555-4081", False)}
    # no sum, no card
    assert not any(s.text == OTHER for spans in by_id.values() for s in spans)


def long_runs(n):
    return ["1" * n, "a" * n, "1." * (n // 4), "+1" * (n // 4), "a@b" + ".c" * (n // 4), "1 " * (n // 4), "(" * (n // 4), "a@" * (n // 4)]


def test_pii_long_runs_and_empty_tables(spark):
    rows = [*enumerate(long_runs(4_000)), *enumerate(long_runs(200_000), 100)]
    got = {r.doc_id: r for r in pii.report(pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    for i, t in rows[:8]:  # plain patterns take the square of a run's length
        assert got[i].base_sha256 == hashlib.sha256(listed(plain_base(t)).encode()).hexdigest(), i
    assert got[102].n_ip == 200_000 // 16 and got[104].n_email == 1 and got[100].spans == ""
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_pii(none).count() == 0
    clean = spark.createDataFrame([(1, "nothing here"), (2, None)], "doc_id long, text string")
    assert [r.spans for r in pii.report(pii.find_pii(clean)).collect()] == ["", ""]


def test_em_finds_the_reliable_labelers():
    rnd, counts = random.Random(2), defaultdict(int)
    right = [0.95, 0.9, 0.7, 0.6, 0.5]
    truth = defaultdict(lambda: [0, 0])
    for _ in range(20_000):
        y = rnd.random() < 0.3
        votes = tuple((1 if y else -1) if rnd.random() < q else (-1 if y else 1) for q in right)
        counts[votes] += 1
        truth[votes][y] += 1
    p = pii.estimate(sorted(counts.items()))
    majority = sum(max(0, t[0] if sum(v) > 0 else t[1]) for v, t in truth.items())
    wrong = sum(t[0] if p[v] >= 0.5 else t[1] for v, t in truth.items())
    assert wrong < 0.7 * majority and wrong < 0.06 * 20_000


def test_pii_masking(spark):
    rows = [(1, f"pay {CARD} or write me@x.org now"), (2, None), (3, "nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(map(tuple, pii.masked_texts(df, pii.find_pii(df)).collect()))
    assert got == {1: "pay [card] or write [email] now", 2: None, 3: "nothing"}


def test_new_queries_are_registered():
    assert {"op11_prefix_trie", "op12_pii", "op13_filter_audit"} <= set(queries.QUERIES)

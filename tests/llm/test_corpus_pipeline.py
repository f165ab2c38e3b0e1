from collections import Counter

from test_near_and_lines import plain_components, plain_fingerprint, plain_lines
from test_search_and_scores import plain_contamination

import corpus_pipeline as cp
from vitrina.llm import quality

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert [n for n, _ in cp.STAGES] == ["quality", "lines", "near_duplicates", "decontamination", "mix"]
    before, outs = rows(docs), {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, SF)
        if name != "mix":
            assert out.columns == COLUMNS
        path = f"file://{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        outs[name] = docs
        if name == "quality":
            model = quality.learn(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
            want = [(d, t) for d, t in before if sum(w * x for w, x in zip(model.weights, quality.text_features((t or "").encode()))) >= model.threshold]
        elif name == "lines":
            want = sorted(plain_lines(before).items())
        elif name == "near_duplicates":
            keep = set(plain_components({d: plain_fingerprint(t) for d, t in before}, 4).values())
            want = [x for x in before if x[0] in keep]
        elif name == "decontamination":
            bad = {r[0] for r in plain_contamination(before, bench, 10) if r[-1]}
            want = [x for x in before if x[0] not in bad]
        if name != "mix":
            assert rows(docs) == want
            before = want
    words = {d: Counter((t or "").split()) for d, t in before}
    for r in docs.collect():
        assert not Counter(r.text.split(" ")) - words[r.doc_id]
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in outs["quality"].collect()}
    assert sum(d in kept for d, q in good.items() if q == 1) / max(1, sum(good.values())) > 0.97


def test_run_gives_the_last_stage(spark):
    out = cp.run(spark, SF)
    assert out.columns == ["shard", "slot", "source", "block", "at", "doc_id", "n_words", "text"]
    assert out.count() > 0 and out.where("n_words <= 0 or text is null").count() == 0


def test_stages_take_odd_rows(spark, make_docs, odd_rows, tmp_path):
    for i, some in enumerate((odd_rows, [])):
        docs = make_docs(some)
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            out.write.parquet(f"file://{tmp_path}/{i}-{name}")
            docs = spark.read.schema(out.schema).parquet(f"file://{tmp_path}/{i}-{name}")
            if not some:
                assert docs.count() == 0


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names, sql = set(entry.queries()), set(entry.oracle_sql())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert {n for n in sql if n.startswith("op")} == {"op2_exact_topk", "op7_lm_score", "op11_prefix_trie", "op13_filter_audit", "op3_line_dedup", "op4_substring_dedup", "op5_decontaminate", "op8_url_filter"}

"""Personal data (operator 12), by weak supervision: labelers vote on spans, expectation-
maximisation estimates how reliable each labeler is, and a span classifier is trained on
the resulting probabilities.

Plan (DataFrame functions only; nothing runs in Python workers):

1. ``hits``: one pass over whole texts. For each kind a *base* pattern (the contract's) and a
   *loose* pattern (further extents and spellings) are cut out with the text between matches,
   and a thin row per document is written: matches, lengths of the gaps, a few characters of
   context. All patterns are free of backtracking over long runs: possessive quantifiers, and
   a start only where a run starts or the last match ended, which finds the same matches.
2. ``spans``: one row per match. Its place is a running sum of lengths within the document,
   one exchange of the thin rows by document.
3. Five labelers vote -1, 0 or 1 on each span: the kind's rule (checksum, ranges, number of
   digits), its shape, a gazetteer, cue words around it and its edges. Votes are counted over
   all documents by Spark; there are at most 3^5 patterns a kind, and on that table
   expectation-maximisation runs (two classes, labelers independent given the class).
4. Features of spans are binary, so spans are counted by (features, votes) and the logistic
   regression is fitted to weighted counts of all spans.
5. Spans of the base patterns that pass the kind's check always stay. A loose span is added if
   it passes the same check, overlaps no base span and the classifier gives it one half or more.

Defined results: a null text is empty and has no span. Repeated rows and null doc_ids each
keep a row of their own. An empty table, or one without any match, gives no spans and a model
that adds none. Places are code points, ends exclusive. Extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import once, written

KINDS = ("email", "ip", "card", "phone")

# Fixed values of the contract, written without backtracking.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Further extents: what stands inside a longer run, and other spellings.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|(?<![0-9])[0-9]{2,4}) ?[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
}
# A cheap condition that a text with a match fulfils.
NEEDS = {"email": r"@|[(\[{]at[)\]}]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"[+(0-9]"}

SHAPE = {
    "email": r"^[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?@(?:(?!-)[A-Za-z0-9-]++(?<!-)\.)++[A-Za-z]{2,24}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$",
    "phone": r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}$",
}
# Gazetteers: mail domains' last labels, first octets in public use, first digits of card
# issuers, country calling codes.
GAZETTEER = {
    "email": r"\.(?:com|org|net|edu|gov|int|info|biz|io|app|dev|eu|de|fr|es|it|pt|nl|be|ch|at|uk|us|ca|mx|ar|br|cl|co|jp|cn|in|au|example|test)$",
    "ip": r"^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.",
    "card": r"^(?:3[0-9]|4|5[1-5]|2[2-7]|6[0-9])",
    "phone": r"^\+(?:1|7|2[07]|3[0-4]|39|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|35[0-9]|42[0-9])",
}
# Words that stand near personal data, and near numbers that are something else.
CUES = {
    "email": r"mail|correo|courriel|contact|kontakt|escrib|schreib|write|from|to:",
    "ip": r"\bip\b|host|server|serv|address|adress|direcci|login|client",
    "card": r"card|visa|master|amex|tarjeta|carte|karte|credit|cr[eé]dito|kredit|pay|pago",
    "phone": r"tel|phone|fono|fon\b|call|llam|appel|anruf|mobil|m[oó]vil|fax|sms",
}
COUNTER = r"version|\bv\.?$|isbn|issn|token|sha|hash|\bid\b|\bref|order|invoice|\bno\.|\bart|section|=\s*\S{0,3}$|#$"

LABELERS = ("rule", "shape", "gazetteer", "cue", "edge")
FEATURES = ("valid", "shaped", "listed", "cued", "countered", "free", "plus", "blank", "punctuated", "few", "some", "many")


def _cut(text: Column, kind: str, pattern: str, source: str) -> Column:
    """array<(kind, source, i, hit, gap, before, after)> of a pattern's matches: ``gap`` is the
    number of code points since the last match, before and after are a little context."""
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    return F.when(text.rlike(NEEDS[kind]), F.struct(F.lit(kind).alias("kind"), F.lit(source).alias("source"), hits.alias("hits"), gaps.alias("gaps")))


def hits(docs: DataFrame) -> DataFrame:
    """(row, doc_id, found): the matches of all patterns of each document, written once."""
    text = F.coalesce("text", F.lit(""))
    cuts = [_cut(text, k, p[k], s) for s, p in (("base", BASE), ("loose", LOOSE)) for k in KINDS]
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), F.array_compact(F.array(*cuts)).alias("cuts"))
    # computed once per row: the generator keeps the patterns out of the lambdas below
    rows = once(rows, "cut_once", F.col("cuts")).drop("cuts")

    def matches(c: Column) -> Column:
        n = F.size(c.hits)
        joined = F.arrays_zip(c.hits.alias("hit"), F.slice(c.gaps, 1, n).alias("gap"), F.slice(c.gaps, 2, n).alias("next"),
                              F.concat(F.array(F.lit("")), F.slice(c.hits, 1, F.greatest(n - 1, F.lit(0)))).alias("last"))
        return F.transform(joined, lambda x, i: F.struct(
            c.kind.alias("kind"), c.source.alias("source"), i.alias("i"), x.hit.alias("hit"), F.char_length(x.gap).alias("gap"),
            F.right(F.concat(F.right(x.last, F.lit(4)), x.gap), F.lit(24)).alias("before"), F.left(x.next, F.lit(12)).alias("after")))

    found = F.flatten(F.transform("cut_once", lambda c: F.when(F.size(c.hits) > 0, matches(c)).otherwise(F.array())))
    return written(rows.select("row", "doc_id", found.alias("found")), "pii-hits")


def _valid(kind: Column, hit: Column) -> Column:
    """The kind's check: octets, digits and Luhn sum, number of digits."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    octet = F.forall(F.transform(F.split(hit, r"\."), lambda o: F.ltrim(o, F.lit("0"))),
                     lambda o: (F.length(o) < 3) | ((F.length(o) == 3) & (o <= "255")))
    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", octet)
            .when(kind == "card", F.when(n.between(13, 19), F.call_function("luhn_check", digits)).otherwise(False))
            .otherwise(n.between(9, 15)))


def _by_kind(kind: Column, of) -> Column:
    out = F.when(kind == KINDS[0], of(KINDS[0]))
    for k in KINDS[1:]:
        out = out.when(kind == k, of(k))
    return out


def spans(found: DataFrame) -> DataFrame:
    """One row per document without a match, else one per span: (row, doc_id, kind, start, end,
    text, base, loose, valid, vote_<labeler>..., <feature>...). Rows of a document lie together."""
    rows = found.select("row", "doc_id", F.explode_outer("found").alias("m")).select("row", "doc_id", "m.*").repartition("row")
    so_far = Window.partitionBy("row", "kind", "source").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    length = F.char_length("hit").cast("long")
    end = F.sum(F.col("gap") + length).over(so_far)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - length)
    # a match of both patterns is one span
    rows = rows.groupBy("row", "doc_id", "kind", "start", "end").agg(
        F.max(F.col("source") == "base").alias("base"), F.max(F.col("source") == "loose").alias("loose"),
        F.min("hit").alias("text"), F.max("before").alias("before"), F.max("after").alias("after"))
    kind, text, before, after = F.col("kind"), F.col("text"), F.col("before"), F.col("after")
    none = F.lit(False)
    near = F.lower(before)
    tests = rows.withColumns({
        "valid": F.coalesce(_valid(kind, text), none),
        "shaped": F.coalesce(_by_kind(kind, lambda k: text.rlike(SHAPE[k])), none),
        "listed": F.coalesce(_by_kind(kind, lambda k: F.lower(text).rlike(GAZETTEER[k])), none),
        "cued": F.coalesce(_by_kind(kind, lambda k: near.rlike(CUES[k])), none),
        "countered": F.coalesce(near.rlike(COUNTER), none),
        "free": F.coalesce(~before.rlike(r"[\p{L}\p{N}_\"'=/\\-]$") & ~after.rlike(r"^[\p{L}\p{N}_\"'=/\\]"), none),
    })
    digits = F.length(F.regexp_replace(text, "[^0-9]", ""))
    return tests.withColumns({
        "vote_rule": F.when(F.col("valid"), 1).otherwise(-1), "vote_shape": F.when(F.col("shaped"), 1).otherwise(-1),
        "vote_gazetteer": F.when(F.col("listed"), 1).otherwise(0),
        "vote_cue": F.when(F.col("countered"), -1).when(F.col("cued"), 1).otherwise(0), "vote_edge": F.when(F.col("free"), 1).otherwise(-1),
        "plus": F.coalesce(text.startswith("+"), none), "blank": F.coalesce(text.contains(" "), none), "punctuated": F.coalesce(text.rlike("[().-]"), none),
        "few": F.coalesce(digits < 9, none), "some": F.coalesce(digits.between(9, 12), none), "many": F.coalesce(digits > 19, none),
    })


def estimate(counts: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[int, ...], float]:
    """The probability that a span with these votes is personal data, from the counts of vote
    patterns of one kind: expectation-maximisation, starting at the sum of votes."""
    if not counts:
        return {}
    p = {votes: 1 / (1 + math.exp(-sum(votes))) for votes, _ in counts}
    total = sum(n for _, n in counts)
    for _ in range(rounds):
        yes = sum(n * p[v] for v, n in counts)
        # probabilities of each vote of each labeler in both classes, one pseudo-count each
        table: list[list[dict[int, float]]] = [[], []]
        for i in range(len(LABELERS)):
            for c in (0, 1):
                mass = {-1: 1.0, 0: 1.0, 1: 1.0}
                for v, n in counts:
                    mass[v[i]] += n * (p[v] if c else 1 - p[v])
                all_of = sum(mass.values())
                table[c].append({vote: m / all_of for vote, m in mass.items()})
        prior = math.log((yes + 1) / (total - yes + 1))
        for v, _ in counts:
            odds = prior + sum(math.log(table[1][i][x] / table[0][i][x]) for i, x in enumerate(v))
            p[v] = 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))
    return p


@dataclass
class PiiModel:
    """Weights of the span classifier: per kind an intercept and one per feature."""
    weights: dict[str, list[float]]

    def score(self) -> Column:
        def of(kind: str) -> Column:
            w = self.weights.get(kind, [-50.0] + [0.0] * len(FEATURES))
            odds = F.lit(float(w[0]))
            for name, x in zip(FEATURES, w[1:]):
                odds = odds + F.when(F.col(name), F.lit(float(x))).otherwise(F.lit(0.0))
            return 1 / (1 + F.exp(-odds))
        return _by_kind(F.col("kind"), of)


def train(rows: DataFrame) -> PiiModel:
    """The model of all spans (see ``spans``). The driver sees counts by kind and votes, at most
    4 * 3^5 rows."""
    spark = rows.sparkSession
    votes = [f"vote_{x}" for x in LABELERS]
    counted = written(rows.where("kind is not null").groupBy("kind", *votes, *FEATURES).agg(F.count("*").alias("n")), "pii-counts")
    table = [(r[0], tuple(r[1:1 + len(votes)]), r["n"]) for r in counted.groupBy("kind", *votes).agg(F.sum("n").alias("n")).collect()]
    known = [(k, *v, p) for k in KINDS for v, p in estimate(sorted((v, n) for kind, v, n in table if kind == k)).items()]
    if not known:
        return PiiModel({})
    truth = spark.createDataFrame(known, "kind string, " + ", ".join(f"{v} int" for v in votes) + ", p double")
    spread = counted.join(F.broadcast(truth), ["kind", *votes]).withColumn("x", array_to_vector(F.array(*[F.col(f).cast("double") for f in FEATURES])))
    both = spread.select("kind", "x", F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("weight")))).alias("y")).select("kind", "x", "y.*").where("weight > 0")
    both = written(both, "pii-training")
    weights = {}
    for kind in sorted({k for k, *_ in known}):
        fitted = LogisticRegression(featuresCol="x", labelCol="label", weightCol="weight", regParam=1e-3, maxIter=50, standardization=False).fit(
            both.where(F.col("kind") == kind).coalesce(1))
        weights[kind] = [float(fitted.intercept), *[float(c) for c in fitted.coefficients]]
    return PiiModel(weights)


def judged(rows: DataFrame, model: PiiModel) -> DataFrame:
    """``spans`` with score, ``stays`` (a base span that passes its check) and ``added``."""
    rows = rows.withColumns({"score": model.score(), "stays": F.col("base") & F.col("valid")})
    # the base spans around a span, whatever their kind: the furthest end of those that start
    # before it, the nearest start of those that start later
    place = [F.col("start"), F.col("end"), F.col("kind")]
    before = Window.partitionBy("row").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row").orderBy(*[c.desc() for c in place]).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(F.col("stays"), F.col("end"))).over(before)
    following = F.min(F.when(F.col("stays"), F.col("start"))).over(after)
    free = (F.coalesce(reach, F.lit(0)) <= F.col("start")) & F.coalesce(following >= F.col("end"), F.lit(True))
    return rows.withColumn("free_of_base", free).withColumn(
        "added", F.col("loose") & ~F.col("stays") & F.col("valid") & F.col("free_of_base") & (F.col("score") >= 0.5))


def find_pii(docs: DataFrame, model: PiiModel | None = None) -> DataFrame:
    """(row, doc_id, spans): every document with its spans (kind, start, end, text, score, base),
    by kind, then start. Without a model one is trained on these documents."""
    rows = spans(hits(docs))
    if model is None:
        rows = written(rows, "pii-spans")
        model = train(rows)
        rows = rows.repartition("row")
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    span = F.when(F.col("stays") | F.col("added"), F.struct(
        rank.alias("rank"), "start", "end", "kind", "text", "score", F.col("stays").alias("base")))
    grouped = judged(rows, model).groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(span)).alias("s"))
    return grouped.select("row", "doc_id", F.transform("s", lambda x: F.struct(
        x.kind.alias("kind"), x.start.alias("start"), x.end.alias("end"), x.text.alias("text"), x.score.alias("score"), x.base.alias("base"))).alias("spans"))


def masked_texts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text): each text's spans overwritten by their kind in brackets. ``found`` is the
    result of ``find_pii``; documents are matched by doc_id, so ids must name one row each."""
    parts = F.transform("spans", lambda x: F.struct(x.start.alias("start"), x.end.alias("end"), x.kind.alias("kind")))
    joined = docs.select("doc_id", "text").join(found.select("doc_id", F.array_sort(parts).alias("at")), "doc_id", "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("pos"))
    text = F.coalesce("text", F.lit(""))
    done = F.aggregate("at", start, lambda a, x: F.when(x.start < a.pos, a).otherwise(F.struct(
        F.concat(a.out, F.substring(text, a.pos.cast("int") + 1, (x.start - a.pos).cast("int")), F.lit("["), x.kind, F.lit("]")).alias("out"),
        x.end.alias("pos"))))
    whole = F.when(F.col("text").isNull(), F.lit(None)).when(F.coalesce(F.size("at"), F.lit(0)) <= 0, F.col("text")).otherwise(
        F.concat(F.col("d.out"), F.substring(text, F.col("d.pos").cast("int") + 1, F.char_length(text))))
    return joined.withColumn("d", done).select("doc_id", whole.alias("text"))


def report(found: DataFrame) -> DataFrame:
    """The columns of the query op12: counts and digest of base spans, and all spans."""
    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x.base & (x.kind == kind))).cast("long")

    base = F.filter("spans", lambda x: x.base)
    return found.select(
        "doc_id", *[number(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))

"""Conversation prefix trie (operator 11), by time-forward processing.

Every distinct sequence of first d turns (role, text) of a conversation is a node;
the textless root has d = 0. A node's totals (childless nodes, bytes saved by storing
shared turns once) are sums over its subtree. They are computed as in external
memory: nodes are sorted by reverse level order, each sends its totals to its parent
through a priority queue that is ordered like the nodes, and the parent takes them out
when its turn comes. Queues live within shards; a second pass takes the totals of the
shard roots up to the root.

Plan:

1. Spark numbers the turns and gives each prefix a 128-bit digest, the running xor of
   hashes of (position, role, text). Texts are hashed where they are read; every
   exchange carries some 50 bytes a turn.
2. ``groupBy(depth, digest)`` makes the nodes, pre-aggregated in each task, so a first
   turn that a third of all conversations share costs a row per task.
3. A node with more than ``shard_convs`` members is *heavy*; there are at most
   conversations / shard_convs of them on a level. The first light node on a path is
   a shard root. Subtrees of shard roots are dealt out by digest: none has more than
   ``shard_convs`` members, whatever prefixes are popular.
4. Within shards: Spark's external sort brings (shard root, depth descending, digest)
   order, and a task streams over it with one ``SpillingQueue``.
5. Across shard roots: their totals are summed per heavy parent by Spark, and the heavy
   nodes pass through the same code in one ordered stream.

Bounds: a task holds one queue, at most ``QUEUE_LIMIT`` messages in memory and the rest
in sorted runs in unnamed scratch files that end with the task, as with Spark's own
sorts; nothing reads them afterwards. One conversation is numbered and streamed by one
task with spilling sorts: memory is bounded, but its turns are not spread.

Defined results: rows with null conv_id belong to no conversation. Turns are ordered by
turn, null first; equal turns by a hash of role and text (repeated rows all count).
Null role or text is empty. An empty table gives no node. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

# Members of a node beyond which its subtree is divided among shards.
SHARD_CONVS = 4096
# Messages that a queue keeps in memory (some 200 bytes each).
QUEUE_LIMIT = 500_000
# Ids whose list is put together by one row of an aggregate, for the digest of ends.
END_CHUNK = 4096

KEY = ["depth", "p1", "p2"]


class SpillingQueue:
    """A priority queue of tuples. Beyond ``limit`` items the larger half goes to a
    sorted run in an unnamed scratch file; ``pop`` merges the runs with what is in memory."""

    def __init__(self, limit: int = QUEUE_LIMIT, block: int = 4096):
        self.limit, self.block = max(2, limit), block
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # (smallest item, run number, rest of the run)
        self.spills = 0

    def _stored(self, items: list[tuple]) -> Iterator[tuple]:
        with tempfile.TemporaryFile() as run:
            for i in range(0, len(items), self.block):
                pickle.dump(items[i:i + self.block], run)
            del items
            run.seek(0)
            yield ()
            while True:
                try:
                    yield from pickle.load(run)
                except EOFError:
                    return

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self.heap.sort()
            half = len(self.heap) // 2
            run = self._stored(self.heap[half:])
            del self.heap[half:]
            next(run)
            self._advance(run)
            self.spills += 1

    def _advance(self, run: Iterator[tuple], number: int | None = None) -> None:
        if (head := next(run, None)) is not None:
            heapq.heappush(self.heads, (head, self.spills if number is None else number, run))

    def peek(self) -> tuple | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, number, run = heapq.heappop(self.heads)
            self._advance(run, number)
            return item
        return heapq.heappop(self.heap)


def time_forward(nodes: Iterable[tuple], limit: int = QUEUE_LIMIT) -> Iterator[tuple[int, int, int]]:
    """Children, childless nodes and saved bytes of every subtree, in the order of the input.

    ``nodes`` are (root, depth, digest, parent digest, own saved bytes, children, leaves,
    saved), sorted by (root, depth descending, digest); the last three are totals that
    come from other shards. ``root`` holds the depth of the subtree's top first."""
    queue = SpillingQueue(limit)
    for root, depth, digest, parent, own, children, leaves, saved in nodes:
        me = (root, -depth, digest)
        while (message := queue.peek()) is not None and message[:3] == me:
            _, _, _, low, kept = queue.pop()
            children, leaves, saved = children + 1, leaves + low, saved + kept
        leaves, saved = (leaves if children else 1), saved + own
        if depth > root[0]:
            queue.push((root, 1 - depth, parent, leaves, saved))
        yield children, leaves, saved


def _pass(limit: int):
    """The pass over the partitions of a frame with the columns that ``_passed`` names."""
    def rows(batches: Iterator[pd.DataFrame], kept: list[pd.DataFrame]) -> Iterator[tuple]:
        for b in batches:
            kept.append(b)
            columns = [b[c].tolist() for c in ("rd", "r1", "r2", "depth", "p1", "p2", "q1", "q2", "own", "n_children", "n_leaves", "saved_tokens")]
            for rd, r1, r2, d, p1, p2, q1, q2, own, c, n, s in zip(*columns):
                yield (rd, r1, r2), d, (p1, p2), (q1, q2), own, c, n, s

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        totals = time_forward(rows(batches, kept), limit)
        while True:
            first = next(totals, None)
            if first is None:
                return
            b = kept.pop()
            kept.clear()
            more = list(itertools.islice(totals, len(b) - 1))
            b[["n_children", "n_leaves", "saved_tokens"]] = pd.DataFrame([first, *more], index=b.index, dtype="int64")
            yield b
    return run


PASSED = ("rd long, r1 long, r2 long, depth long, p1 long, p2 long, q1 long, q2 long, conv_id long, n_convs long, own long, "
          "n_children long, n_leaves long, saved_tokens long")


def _passed(nodes: DataFrame, limit: int) -> DataFrame:
    names = [c.split()[0] for c in PASSED.split(", ")]
    return nodes.select(*[F.col(c).cast("long") for c in names]).sortWithinPartitions(
        "rd", "r1", "r2", F.desc("depth"), "p1", "p2").mapInPandas(_pass(limit), PASSED)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, t1, t2, bytes): the turns in order, texts as digests."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit("second"), text, role).alias("t2"), F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "t1", "t2")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "t1", "t2", "bytes")


def node_turns(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Adds role and text of each node's last turn, for tries of unchanged conversations."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "t1", "t2")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), role.alias("role"), text.alias("text"), "turn",
        F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit("second"), text, role).alias("t2"))
    return nodes.join(turns.select("conv_id", F.row_number().over(order).cast("long").alias("depth"), "role", "text"), ["conv_id", "depth"], "left")


def shared_openings(rows: DataFrame, every: int = 5, longest: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the opening of another: the first h turns of conversation
    c - c % every (all if fewer, none if absent), then c's own turns after its first h;
    h = crc32(decimal c) % longest. Returns (turn rows, conversations)."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    convs = rows.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    heads = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = written(convs.join(heads, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")), "trie-conversations")
    openings = rows.where(F.col("pos") < longest).withColumnRenamed("conv_id", "base").join(
        convs.where("taken > 0").select("conv_id", "base", "taken"), "base").where("pos <= taken")
    own = rows.join(convs, "conv_id").where("pos > h").withColumn("pos", F.col("taken") + F.col("pos") - F.col("h"))
    thin = ["conv_id", "pos", "t1", "t2", "bytes"]
    return openings.select(*thin).unionByName(own.select(*thin)), convs.select("conv_id")


def _digest(ids: DataFrame) -> DataFrame:
    """SHA-256 of each node's conversation ids, ascending and comma-joined. Lists are put
    together in chunks by a spread aggregate; only nodes of several chunks are streamed,
    a chunk a row, through one digest each."""
    chunks = ids.groupBy(*KEY, F.expr(f"conv_id div {END_CHUNK}").alias("chunk")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))
    one = written(chunks.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("chunk").alias("chunk")), "trie-ends")
    parts = chunks.join(one.select(*KEY, "n"), KEY)

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, sha = None, None
        for b in batches:
            out = []
            for d, p1, p2, ids in zip(b["depth"].tolist(), b["p1"].tolist(), b["p2"].tolist(), b["ids"]):
                if at != (d, p1, p2):
                    if at is not None:
                        out.append((*at, sha.hexdigest()))
                    at, sha = (d, p1, p2), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([(*at, sha.hexdigest())], columns=[*KEY, "ends_sha256"])

    several = parts.where("n > 1").select(*KEY, "chunk", "ids").repartition(*KEY).sortWithinPartitions(*KEY, "chunk")
    return parts.where("n = 1").select(*KEY, F.sha2("ids", 256).alias("ends_sha256")).unionByName(
        several.mapInPandas(digests, "depth long, p1 long, p2 long, ends_sha256 string"))


class Trie:
    """The trie of ``rows`` (see ``turn_rows``); ``convs`` names all conversations, also
    those without a turn."""

    def __init__(self, rows: DataFrame, convs: DataFrame | None = None, shard_convs: int = SHARD_CONVS, queue_limit: int = QUEUE_LIMIT):
        self.shard_convs, self.queue_limit = shard_convs, queue_limit
        convs = rows.select("conv_id").distinct() if convs is None else convs
        x1, x2 = F.xxhash64("pos", "t1", "t2"), F.xxhash64(F.lit("second"), "t2", "t1", "pos")
        so_far = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
        path = rows.select("conv_id", "pos", "bytes", x1.alias("x1"), x2.alias("x2")).select(
            "conv_id", F.col("pos").alias("depth"), "bytes", "x1", "x2",
            F.bit_xor("x1").over(so_far).alias("p1"), F.bit_xor("x2").over(so_far).alias("p2"))
        # (conversation, depth) -> node and parent; the parent's digest lacks the last turn
        self.paths = written(path.select("conv_id", *KEY, F.col("p1").bitwiseXOR(F.col("x1")).alias("q1"),
                                         F.col("p2").bitwiseXOR(F.col("x2")).alias("q2"), "bytes"), "trie-paths")
        last = self.paths.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("at"))
        none = F.struct(*[F.lit(0).cast("long").alias(c) for c in KEY])
        #: (conv_id, depth, p1, p2): the node at which each conversation ends
        self.ends = written(convs.join(last, "conv_id", "left").select("conv_id", F.coalesce("at", none).alias("at")).select("conv_id", "at.*"), "trie-members")

    def _nodes(self) -> DataFrame:
        agg = [F.min("q1").alias("q1"), F.min("q2").alias("q2"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes")]
        zero = F.lit(0).cast("long")
        root = self.ends.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
            *[zero.alias(c) for c in (*KEY, "q1", "q2", "bytes")], "conv_id", "n_convs")
        nodes = self.paths.groupBy(*KEY).agg(*agg).unionByName(root)
        return written(nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("bytes")), "trie-nodes")

    def nodes(self) -> DataFrame:
        """One row per node, with the columns of the query op11."""
        nodes, zero = self._nodes(), F.lit(0).cast("long")
        top = (F.col("n_convs") > self.shard_convs) | (F.col("depth") == 0)
        from_other = [zero.alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
        heavy = nodes.where(top)
        # members of heavy nodes are many by definition: an outer join that may be split
        marked = self.paths.select("conv_id", *KEY).join(heavy.select(*KEY, F.lit(True).alias("heavy")), KEY, "left")
        roots = marked.where("heavy is null").groupBy("conv_id").agg(F.min(F.struct(*KEY)).alias("top"))
        light = nodes.where(~top).join(roots, "conv_id").select(
            "*", F.col("top.depth").alias("rd"), F.col("top.p1").alias("r1"), F.col("top.p2").alias("r2"), *from_other)
        within = written(_passed(light.repartition("r1", "r2"), self.queue_limit), "trie-within")
        sent = within.where("depth = rd").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
            F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
        waiting = heavy.join(sent, KEY, "left").fillna(0, ["n_children", "n_leaves", "saved_tokens"]).select(
            "*", *[zero.alias(c) for c in ("rd", "r1", "r2")])
        across = _passed(waiting.repartition(1), self.queue_limit)
        done = within.unionByName(across)
        parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
        none = F.sha2(F.lit(""), 256)
        return done.join(parents, ["depth", "q1", "q2"], "left").join(_digest(self.ends), KEY, "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", none).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, rebuilt: bool = False, shard_convs: int = SHARD_CONVS, queue_limit: int = QUEUE_LIMIT) -> DataFrame:
    """The nodes of the conversations' trie; with ``rebuilt`` of those with shared openings."""
    rows, convs = written(turn_rows(conversations), "trie-turns"), None
    if rebuilt:
        rows, convs = shared_openings(rows)
    return Trie(rows, convs, shard_convs, queue_limit).nodes()

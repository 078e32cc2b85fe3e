"""The prefix trie of conversations, from sorted shards and a skeleton of splitter paths.

A conversation is the path of its turns, each as 16 bytes that stand for role and text. Paths in sorted order
have every node's conversations side by side, so that a range of paths holds whole subtrees, except of the nodes
on the paths of its own borders. Splitters cut the order into shards. The trie of the splitters' paths, the
skeleton, is sent to all tasks. A task walks its sorted shard with one stack and finishes all nodes
off the skeleton; of skeleton nodes it gives partial aggregates, which are reduced and then summed up along
the skeleton.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import text_of
from feedloom.llm.mixing import word_count
from feedloom.session import staged

KEY = 16
#: Splitter paths are cut after so many turns: the skeleton has at most shards x DEEP + 1 nodes.
DEEP = 64
#: Conversations looked at for each shard to choose splitters; they decide on balance only.
SAMPLED = 20
#: Ids of a skeleton node that travel together.
CHUNK = 4096

_PARTIAL = "kind int, node long, conv_id long, depth int, parent long, n_convs long, n_children long, n_leaves long, saved long, words long, ends string"
NODE, CHILD, PART, ENDS = range(4)


def conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, turns) from rows of turns: each turn as (turn, key, words), in order.

    Null turn numbers come first; turns of one number stand in the order of their keys. Null roles and texts
    are empty. Rows whose conversation id is null or no whole number belong to no conversation and are left
    out. Repeated rows are turns of their own. A turn travels as a number and 16 bytes, its text stays behind.
    """
    role, text = text_of(role_col), text_of(text_col)
    key = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turn = F.struct(F.col(turn_col).alias("turn"), key.alias("key"), word_count(text).alias("words"))
    rows = turns.select(F.expr(f"try_cast(`{conv_col}` AS BIGINT)").alias("conv_id"), turn.alias("t"))
    return rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))


def with_borrowed_heads(convs: DataFrame, every: int = 20, most: int = 3) -> DataFrame:
    """Each conversation with its first h turns taken from conversation c - c % ``every``; h is crc32(c) % (most + 1)."""
    heads = convs.where(F.col("conv_id") % every == 0)
    heads = heads.select(F.col("conv_id").alias("head_id"), F.slice("turns", 1, most).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    joined = convs.join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("head_id"), "left")
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice("turns", 1, 0))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


class _Node:
    __slots__ = ("depth", "number", "n", "low", "kids", "leaves", "saved", "words", "ends", "held", "waiting")

    def __init__(self, depth: int, number: int | None, words: int) -> None:
        self.depth, self.number, self.words = depth, number, words
        self.n = self.kids = self.leaves = self.saved = 0
        self.low: int | None = None
        self.ends = hashlib.sha256() if number is None else None
        self.held: list[int] = []  # ids that end at a skeleton node
        self.waiting: list[tuple] = []  # children whose parent's smallest id is not known yet


class _Walk:
    """One pass over sorted paths; ``rows`` fills with finished nodes and parts of skeleton nodes."""

    def __init__(self, skeleton: dict[bytes, int]) -> None:
        self.skeleton, self.rows = skeleton, []
        self.stack: list[_Node] = []
        self.path = b""

    def add(self, path: bytes, conv: int, words) -> None:
        if not self.stack:
            self.stack.append(_Node(0, self.skeleton[b""], 0))
        same, limit = 0, min(len(path), len(self.path))
        while same < limit and path[same : same + KEY] == self.path[same : same + KEY]:
            same += KEY
        self.shut(same // KEY)
        for depth in range(same // KEY + 1, len(path) // KEY + 1):
            on = self.stack[-1].number is not None
            number = self.skeleton.get(path[: depth * KEY]) if on else None
            self.stack.append(_Node(depth, number, int(words[depth - 1])))
        self.path = path
        node = self.stack[-1]
        if node.number is None:
            node.ends.update((b"," if node.n else b"") + b"%d" % conv)
        else:
            node.held.append(conv)
            if len(node.held) >= CHUNK:
                self.give_ends(node)
        node.n += 1
        node.low = conv if node.low is None else min(node.low, conv)

    def shut(self, depth: int) -> None:
        """Finish all open nodes below ``depth``."""
        while len(self.stack) - 1 > depth:
            node = self.stack.pop()
            self.finish(node, self.stack[-1])

    def finish(self, node: _Node, parent: _Node) -> None:
        parent.n += node.n
        parent.low = node.low if parent.low is None else min(parent.low, node.low)
        if node.number is not None:
            self.give_part(node)
            return
        leaves = node.leaves if node.kids else 1
        saved = node.saved + (node.n - 1) * node.words
        parent.kids, parent.leaves, parent.saved = parent.kids + 1, parent.leaves + leaves, parent.saved + saved
        for low, *rest in node.waiting:
            self.rows.append((NODE, None, low, rest[0], node.low, *rest[1:]))
        row = (node.low, node.depth, node.n, node.kids, leaves, saved, node.words, node.ends.hexdigest())
        if parent.number is None:
            parent.waiting.append(row)
        else:
            self.rows.append((CHILD, parent.number, row[0], row[1], None, *row[2:]))

    def give_part(self, node: _Node) -> None:
        self.give_ends(node)
        self.rows.append(
            (PART, node.number, node.low, node.depth, None, node.n, node.kids, node.leaves, node.saved, node.words, None)
        )

    def give_ends(self, node: _Node) -> None:
        if node.held:
            text = ",".join(map(str, node.held))
            self.rows.append((ENDS, node.number, node.held[0], node.depth, None, None, None, None, None, None, text))
            node.held = []

    def end(self) -> None:
        if self.stack:
            self.shut(0)
            self.give_part(self.stack.pop())

    def take(self) -> pd.DataFrame:
        names = [c.split()[0] for c in _PARTIAL.split(", ")]
        table = pd.DataFrame(self.rows, columns=names)
        self.rows = []
        return table.astype({n: "Int64" for n in names if n != "ends"})


def _hash_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of ids, sorted by node and id, as one digest per node; a chunk is held at a time."""
    node = state = None
    for batch in batches:
        for number, text in zip(batch["node"], batch["ends"], strict=True):
            if number != node:
                if node is not None:
                    yield pd.DataFrame({"node": [node], "ends_sha256": [state.hexdigest()]})
                node, state = number, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
    if node is not None:
        yield pd.DataFrame({"node": [node], "ends_sha256": [state.hexdigest()]})


def prefix_trie(convs: DataFrame) -> DataFrame:
    """One row per node of the trie of conversations (conv_id, turns), see ``conversations``.

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves (childless nodes in
    the subtree), saved_tokens (over the subtree, words of a node's last turn for each member but one), ends_sha256 (digest of
    the ids that end here, ascending, with commas). Conversations without turns are members of the root; no
    conversations give no rows. Other columns are not read. A conversation id that comes twice is two members.

    Sorted ranges break ties by id, so that a conversation that a third of all repeat spreads over
    many shards; its node is then on the skeleton. Only the digest of such a node's ids, which is sequential by
    nature, is worked out in one task: it reads them in chunks and holds one. A conversation is one
    row of 24 bytes a turn.
    """
    spark = convs.sparkSession
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), ""))
    words = F.transform("turns", lambda t: t["words"])
    paths = staged(convs.select("conv_id", key.alias("path"), words.alias("words")), "trie-paths")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sample = paths.orderBy(F.xxhash64("conv_id"), "conv_id").limit(SAMPLED * shards)
    rows = sample.select(F.substring("path", 1, DEEP * KEY).alias("path"), "conv_id").collect()  # SAMPLED x shards rows
    order = sorted((bytes(r.path), r.conv_id) for r in rows)
    splitters = sorted(set(order[SAMPLED::SAMPLED]))
    prefixes = sorted({path[:at] for path, _ in splitters for at in range(0, len(path) + 1, KEY)} | {b""})
    number = {path: i for i, path in enumerate(prefixes)}
    skeleton = [
        (i, len(p) // KEY, number[p[:-KEY]] if p else None, [number[p[:at]] for at in range(0, len(p) + 1, KEY)])
        for i, p in enumerate(prefixes)
    ]
    frame = spark.createDataFrame(skeleton, "node long, depth int, parent long, way array<long>")
    sent = spark.sparkContext.broadcast((splitters, number))

    @F.pandas_udf("int")
    def shard(path: pd.Series, conv: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(sent.value[0], (bytes(p), c)) for p, c in zip(path, conv, strict=True)], dtype="int32")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = _Walk(sent.value[1])
        for batch in batches:
            for path, conv, counts in zip(batch["path"], batch["conv_id"], batch["words"], strict=True):
                state.add(bytes(path), int(conv), counts)
            yield state.take()
        state.end()
        yield state.take()

    dealt = paths.withColumn("shard", shard("path", "conv_id")).repartitionByRange(shards, "shard")
    done = staged(dealt.sortWithinPartitions("shard", "path", "conv_id").mapInPandas(walk, _PARTIAL), "trie-nodes")
    bones = _bones(done, frame)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = F.col("n_convs"), F.col("n_children"), F.col("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256")
    inner = done.where(F.col("kind") == NODE).select("conv_id", F.col("depth").cast("long"), F.col("parent").alias("parent_conv_id"), *found)
    above = bones.select("node", F.col("conv_id").alias("parent_conv_id"))
    border = done.where(F.col("kind") == CHILD).join(above, "node")
    border = border.select("conv_id", F.col("depth").cast("long"), "parent_conv_id", *found)
    return inner.unionByName(border).unionByName(bones.select(*columns))


def _bones(done: DataFrame, skeleton: DataFrame) -> DataFrame:
    """Skeleton nodes from their parts: reduced by node, then summed up along the way to the root."""
    ended = done.where(F.col("kind") == ENDS).select("node", "conv_id", "ends")
    ends = ended.repartition("node").sortWithinPartitions("node", "conv_id").mapInPandas(_hash_ends, "node long, ends_sha256 string")
    parts = done.where(F.col("kind") == PART).groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
    )
    kids = skeleton.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    known = parts.join(skeleton, "node").join(kids, "node", "left")
    children = F.col("n_children") + F.coalesce("more", F.lit(0))
    own = staged(
        known.select(
            "node", "conv_id", F.col("depth").cast("long").alias("depth"), "parent", "way", "n_convs", children.alias("n_children"),
            F.when(children == 0, 1).otherwise(F.col("n_leaves")).alias("leaves"),
            (F.col("saved") + F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)).alias("saved"),
        ),
        "trie-skeleton",
    )
    sums = own.select(F.explode("way").alias("node"), "leaves", "saved").groupBy("node").agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")
    )
    above = own.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = own.drop("leaves", "saved", "way").join(sums, "node").join(above, "parent", "left").join(ends, "node", "left")
    return staged(out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))), "trie-bones")

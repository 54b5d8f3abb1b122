"""Prefix trie of conversations: ternary search trees per range shard, their edges merged afterwards.

A conversation is a sequence of turn digests (16 bytes each), so no text is shuffled. Conversations are range-partitioned by
sequence, so whatever shares a prefix lies side by side, also across the bounds of partitions. A task reads its sorted
rows shard by shard, a shard being a bounded number of distinct turns. It encodes the digests as small ids in
their order, inserts the distinct sequences into a ternary search tree, always the middle one of a run first, and
sums members, leaves and savings without recursion. Only prefixes of the first and the last sequence of a shard can go on in
a neighbour: these edges, one row per shard, side and depth, are merged in order of the shards along a stack. Digests of the
members that end in a node are sequential hashes: each shard writes the ids of its first, last and of any very large group as
pieces of text, which are hashed in order afterwards.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltworks.llm.common import short_batches
from smeltworks.sources.scratch import materialise

WIDTH = 16
# A shard is closed when its distinct sequences have this many turns.
SHARD_TURNS = 200_000
# Text of member ids that is hashed in one go; more goes on as pieces of this size.
PIECE_CHARS = 1 << 16
OUT_ROWS = 20_000
BLOCK, HEADS = 100, 6

NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
#: ``kind`` is n (node), e (edge) or p (piece); ``above`` names the slot of an edge that is the parent.
SHARD_ROW = NODE + ", kind string, shard bigint, slot bigint, above bigint, digest binary, chars bigint, ends_key string, ends_sha256 string, piece bigint, ids string"
EMPTY = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """The first 16 bytes of the hash of role and text, as binary. Two of 10 billion distinct turns share one with a chance below 10**-18."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * WIDTH))


def kept_head(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first one of its hundred."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns in order as structs ``digest, chars``, one row per id that is not null.

    Turns ascend, a null one first; of equal ones the smaller digest comes first, and repeated rows stay repeated. Rows are
    shuffled once, by the hundred of their id, without their texts.
    """
    text = F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", F.col("turn").alias("at"), turn_digest(F.col("role"), text).alias("digest"), F.length(text).cast("int").alias("chars")
    )
    rows = rows.withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK).repartition("base")
    turns = F.sort_array(F.collect_list(F.struct("at", "digest", "chars")))
    ordered = rows.groupBy("base", "conv_id").agg(turns.alias("turns"))
    return ordered.select("base", "conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: every conversation with its first turns replaced by those of the first conversation of its hundred."""
    own = sequences(conversations)
    # At most 199 conversations share a base; only the base itself has a head.
    head = F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, HEADS - 1))
    met = own.withColumn("head", F.max_by(head, head.isNotNull()).over(Window.partitionBy("base")))
    h = kept_head(F.col("conv_id"))
    taken = F.when(h > 0, F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.greatest(h, F.lit(1)))).otherwise(F.slice("turns", 1, 0))
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    return met.select("conv_id", F.concat(taken, rest).alias("turns"))


class Tree:
    """A ternary search tree over sequences of ids. A node stands for one prefix; node 0 is the empty one."""

    def __init__(self):
        self.key, self.left, self.right, self.down, self.parent = [-1], [-1], [-1], [-1], [-1]
        self.depth, self.chars = [0], [0]

    def insert(self, ids: list[int], chars: list[int]) -> int:
        """The node of a sequence, with all prefixes that were not there yet."""
        key, left, right, down = self.key, self.left, self.right, self.down
        node = 0
        for depth, one in enumerate(ids):
            links, at, here = down, node, down[node]
            while here >= 0 and key[here] != one:
                links, at = (left, here) if one < key[here] else (right, here)
                here = links[at]
            if here < 0:
                here = links[at] = len(key)
                for column, value in ((key, one), (left, -1), (right, -1), (down, -1), (self.parent, node), (self.depth, depth + 1), (self.chars, chars[depth])):
                    column.append(value)
            node = here
        return node


def _middle_first(n: int) -> Iterator[int]:
    """Positions 0 to n - 1, the middle of every run before its halves."""
    runs = [(0, n)]
    while runs:
        lo, hi = runs.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            runs += [(mid + 1, hi), (lo, mid)]


class Shard:
    """Distinct sequences in ascending order with their members, and the rows that come of them."""

    def __init__(self, number: int):
        self.number, self.turns = number, 0
        self.sequences, self.chars, self.members, self.least, self.ends = [], [], [], [], []

    def add(self, sequence: bytes, chars: list[int], least: int) -> None:
        self.sequences.append(sequence)
        self.chars.append(chars)
        self.members.append(0)
        self.least.append(least)
        self.ends.append(None)
        self.turns += len(chars) + 1

    def rows(self) -> Iterator[dict]:
        """Nodes that lie within the shard, and edges. Slots number the edges: twice the depth, plus one on the last
        sequence where it has left the first one."""
        split = [[s[i : i + WIDTH] for i in range(0, len(s), WIDTH)] for s in self.sequences]
        known = sorted({d for s in split for d in s})
        ids = {d: i for i, d in enumerate(known)}
        tree, n = Tree(), len(split)
        ended: dict[int, int] = {}
        for i in _middle_first(n):
            ended[tree.insert([ids[d] for d in split[i]], self.chars[i])] = i
        size = len(tree.key)
        members, least = [0] * size, [None] * size
        for node, i in ended.items():
            members[node], least[node] = self.members[i], self.least[i]
        slot: dict[int, int] = {0: 0}
        for side, i in enumerate((0, n - 1)):
            path = [node for node, at in ended.items() if at == i]
            while path[-1]:
                path.append(tree.parent[path[-1]])
            for node in path:
                slot.setdefault(node, 2 * tree.depth[node] + side)
        children, leaves, saved = [0] * size, [0] * size, [0] * size
        # A node is made after its parent, so backwards every node is met after all below it.
        for node in range(size - 1, 0, -1):
            up = tree.parent[node]
            members[up] += members[node]
            if least[up] is None or least[node] < least[up]:
                least[up] = least[node]
            if node not in slot:
                leaves[node] += not children[node]
                saved[node] += (members[node] - 1) * tree.chars[node]
                children[up] += 1
                leaves[up] += leaves[node]
                saved[up] += saved[node]
        for node in range(size):
            up, at = tree.parent[node], ended.get(node)
            row = {
                "conv_id": least[node], "depth": tree.depth[node], "n_convs": members[node], "n_children": children[node],
                "n_leaves": leaves[node], "saved_tokens": saved[node], "shard": self.number,
            }
            row["ends_sha256"], row["ends_key"] = (EMPTY, None) if at is None else self.ends[at]
            if node in slot:
                digest = known[tree.key[node]] if node else b""
                row |= {"kind": "e", "slot": slot[node], "digest": digest, "chars": tree.chars[node]}
            else:
                row |= {"kind": "n", "parent_conv_id": None if up in slot else least[up], "above": slot.get(up)}
            yield row


def _sharded(batches: Iterator[pa.RecordBatch], shard_turns: int, piece_chars: int) -> Iterator[dict]:
    """Rows of ``SHARD_ROW`` from a partition sorted by sequence and id."""
    shard, part, count = None, 0, 0
    now, text, length, pieces, key = None, [], 0, 0, None

    def cut() -> dict:
        nonlocal text, length, pieces
        row = {"kind": "p", "ends_key": key, "shard": shard.number, "piece": pieces, "ids": ",".join(text)}
        text, length, pieces = [], 0, pieces + 1
        return row

    def close(edge: bool) -> Iterator[dict]:
        """End the group of the current sequence."""
        if now is None:
            return
        if edge or pieces or len(shard.ends) == 1:
            if text:
                yield cut()
            shard.ends[-1] = (None, key)
        else:
            shard.ends[-1] = (hashlib.sha256(",".join(text).encode()).hexdigest(), None)

    for batch in batches:
        part = batch.column(3)[0].as_py() if batch.num_rows else part
        for conv_id, sequence, chars in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if sequence != now:
                full = shard is not None and shard.turns >= shard_turns
                yield from close(full)
                if full:
                    yield from shard.rows()
                if full or shard is None:
                    shard, count = Shard((part << 32) + count), count + 1
                shard.add(sequence, chars, conv_id)
                now, text, length, pieces, key = sequence, [], 0, 0, hashlib.sha256(sequence).hexdigest()
            shard.members[-1] += 1
            text.append(str(conv_id))
            length += len(text[-1]) + 1
            if length >= piece_chars:
                yield cut()
    yield from close(True)
    if shard is not None:
        yield from shard.rows()


class _Open:
    """A merged edge whose members may go on."""

    __slots__ = ("row", "slots", "below")

    def __init__(self, row: dict):
        self.row, self.slots, self.below = row, [(row["shard"], row["slot"])], []


def _merged(rows: Iterator[dict]) -> Iterator[dict]:
    """Edges in order of shard, side and depth to nodes, and to slots that say which node an edge became part of.

    The stack holds the path to the last edge. An edge of a first sequence that meets its own digest there joins it; any other one ends
    all that is as deep, and goes on from there. Rows of a node wait until its parent ends and has its final id.
    """
    stack: list[_Open] = []

    def end() -> Iterator[dict]:
        top = stack.pop()
        row = top.row
        if not row["n_children"]:
            row["n_leaves"] += 1
        if row["depth"]:
            row["saved_tokens"] += (row["n_convs"] - 1) * row["chars"]
        for shard, slot in top.slots:
            yield {"kind": "s", "shard": shard, "slot": slot, "conv_id": row["conv_id"]}
        for child in top.below:
            yield child | {"parent_conv_id": row["conv_id"]}
        node = {k: row[k] for k in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_key", "ends_sha256")}
        node["kind"] = "n"
        if not stack:
            yield node | {"parent_conv_id": None}
            return
        up = stack[-1]
        up.below.append(node)
        up.row["n_children"] += 1
        up.row["n_leaves"] += row["n_leaves"]
        up.row["saved_tokens"] += row["saved_tokens"]

    for row in rows:
        depth = row["depth"]
        if row["slot"] % 2 == 0 and len(stack) > depth and stack[depth].row["digest"] == row["digest"]:
            met = stack[depth]
            met.slots.append((row["shard"], row["slot"]))
            met.row["conv_id"] = min(met.row["conv_id"], row["conv_id"])
            for name in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                met.row[name] += row[name]
            if row["ends_sha256"] != EMPTY:
                met.row["ends_key"], met.row["ends_sha256"] = row["ends_key"], row["ends_sha256"]
            continue
        while len(stack) > depth:
            yield from end()
        stack.append(_Open(row))
    while stack:
        yield from end()


def _hashed(rows: Iterator[dict]) -> Iterator[dict]:
    """Pieces in order of key, shard and number to one hash per key."""
    key, state = None, None
    for row in rows:
        if row["ends_key"] != key:
            if key is not None:
                yield {"ends_key": key, "ends_sha256": state.hexdigest()}
            key, state = row["ends_key"], hashlib.sha256()
        else:
            state.update(b",")
        state.update(row["ids"].encode())
    if key is not None:
        yield {"ends_key": key, "ends_sha256": state.hexdigest()}


def _run(df: DataFrame, fields: str, compute) -> DataFrame:
    """``df`` through a function from Arrow batches to dicts; rows leave in bounded batches."""
    short_batches(df.sparkSession)
    schema = T._parse_datatype_string(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds, held = to_arrow_schema(schema), []

        def packed() -> pa.RecordBatch:
            columns = [pa.array([r.get(f.name) for r in held], f.type) for f in kinds]
            return pa.RecordBatch.from_arrays(columns, schema=kinds)

        for row in compute(batches):
            held.append(row)
            if len(held) >= OUT_ROWS:
                yield packed()
                held = []
        if held:
            yield packed()

    return df.mapInArrow(run, schema)


def _dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row per node of the trie over rebuilt conversations, see ``rebuilt`` and ``sequences``:
    ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A null role or text is an empty one, a conversation without turns ends in the root, rows without a ``conv_id`` are left out, other
    columns are ignored. Equal conversations end in one node. An empty table gives no rows, not even a root. A conversation's digests and
    lengths, 20 bytes a turn, are one row.
    """
    whole = rebuilt(conversations).select(
        "conv_id", F.unhex(F.concat_ws("", F.transform("turns", lambda t: F.hex(t["digest"])))).alias("sequence"), F.col("turns.chars").alias("chars")
    )
    whole = materialise(whole, "sequences")
    placed = whole.repartitionByRange("sequence", "conv_id").sortWithinPartitions("sequence", "conv_id")
    shards = _run(placed.withColumn("part", F.spark_partition_id()), SHARD_ROW, lambda b: _sharded(b, shard_turns, piece_chars))
    shards = materialise(shards, "shards")
    names = [f.name for f in T._parse_datatype_string(NODE)]
    # A row per shard, side and depth: as many as partitions, times the length of a conversation.
    edges = shards.where("kind = 'e'").repartition(1).sortWithinPartitions("shard", F.col("slot") % 2, "depth")
    merged = materialise(_run(edges, SHARD_ROW, lambda b: _merged(_dicts(b))), "merged")
    pieces = shards.where("kind = 'p'").select("ends_key", "shard", "piece", "ids").repartition("ends_key").sortWithinPartitions("ends_key", "shard", "piece")
    ends = _run(pieces, "ends_key string, ends_sha256 string", lambda b: _hashed(_dicts(b)))

    slots = merged.where("kind = 's'").select("shard", F.col("slot").alias("above"), F.col("conv_id").alias("_up"))
    inner = shards.where("kind = 'n'")
    hanging = inner.where("above IS NOT NULL").join(slots, ["shard", "above"]).withColumn("parent_conv_id", F.col("_up"))
    columns = [*names, "ends_key", "ends_sha256"]
    nodes = inner.where("above IS NULL").select(*columns).unionByName(hanging.select(*columns))
    nodes = nodes.unionByName(merged.where("kind = 'n'").select(*columns))
    open_ = nodes.where("ends_key IS NOT NULL").drop("ends_sha256").join(ends, "ends_key")
    done = nodes.where("ends_key IS NULL")
    return done.select(*names, "ends_sha256").unionByName(open_.select(*names, "ends_sha256"))

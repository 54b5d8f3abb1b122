"""Merkle manifest of a dataset: a hash tree per language over its documents, a tree over the languages, a proof per document.

Trees are built ``stride`` levels at a time: the leaves of a block of ``2 ** stride`` consecutive nodes meet in one row, which
folds them to the block's top and notes, for each of them, its siblings on the way up: a segment towards an
ancestor. Proofs then come from pointer jumping. Every inner node holds a segment and the ancestor it ends at; a self-join
appends the segment of that ancestor and takes over its ancestor, so each round doubles the distance, until all
inner nodes reach the root. The leaves, by far most of the nodes, jump once, to the parent of their block.
"""

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltworks.sources.scratch import materialise

STRIDE = 6
# An ancestors' table of at most this many segment entries (about 100 bytes each) is sent to all tasks: 16 MB.
SMALL_ENTRIES = 160_000
ENTRIES = "array<struct<left:boolean,hash:string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sized(value: Column) -> Column:
    """``-`` for null, else the byte count in UTF-8, a colon and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[sized(v) for v in values]), 256)


def tampered(doc_id: Column) -> Column:
    """The drill: documents whose CRC-32 of the decimal id is divisible by 7."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0


def numbered(rows: DataFrame, group: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``tree`` (rank of the group, from 1, nulls first), ``idx`` (gapless from 0 by ``order`` in the group) and
    ``n`` (rows of the group). Rows are range-partitioned, also within a group, and numbered per part; the parts' counts are
    added up in a table of one row per group and part."""
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(c).asc_nulls_first() for c in (group, *order, "_tie")]
    sorted_ = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = sorted_.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id())
    placed = materialise(placed, label)
    parts = placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_at")).agg(
        F.min("_row").alias("_first"), F.count("*").alias("_count")
    )
    parts = materialise(parts, f"{label}-parts")
    ranks = _ranked_groups(parts)
    totals = parts.join(ranks, F.col("_group").eqNullSafe(F.col("_ranked"))).drop("_ranked")
    # All parts of a group: as many rows as partitions, whatever the number of documents.
    earlier = F.sum("_count").over(Window.partitionBy("tree").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.withColumn("_before", F.coalesce(earlier, F.lit(0)))
    joined = placed.join(totals, (F.col("_part") == F.col("_at")) & F.col(group).eqNullSafe(F.col("_group")))
    idx = F.col("_row") - F.col("_first") + F.col("_before")
    return joined.select(*rows.columns, "tree", "n", idx.alias("idx"))


def _ranked_groups(parts: DataFrame) -> DataFrame:
    """``(_ranked, n, tree)``: one row per group, ranked bytewise, nulls first. One task sees one short row per group."""
    groups = parts.groupBy(F.col("_group").alias("_ranked")).agg(F.sum("_count").alias("n"))
    rank = F.row_number().over(Window.orderBy(F.col("_ranked").asc_nulls_first()))
    return groups.withColumn("tree", rank.cast("bigint"))


def _paired(nodes: Column) -> Column:
    """Hashes of every two consecutive nodes; of the last one alone if it has no partner."""

    def parent(i: Column) -> Column:
        return F.sha2(F.concat(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))), 256)

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), parent)


def fold_blocks(nodes: DataFrame, stride: int, payload: list[str]) -> DataFrame:
    """``nodes(tree, n, idx, hash, *payload)`` -> one row per block of ``2 ** stride``: ``tree, n, block, top, kids``.

    ``kids`` are structs ``idx, hash, *payload, segment``; a segment lists the sibling of each level up to ``top``, null where the
    last node of a level has none. A tree that fits in one block stops at its root; other blocks rise ``stride``
    levels, a single node being hashed alone on each.
    """
    kids = F.sort_array(F.collect_list(F.struct("idx", "hash", *payload)))
    rows = nodes.groupBy("tree", "n", F.shiftright("idx", stride).alias("block")).agg(kids.alias("kids"))
    levels = functools.reduce(lambda a, b: a + b, [F.when(F.col("n") > (1 << k), 1).otherwise(0) for k in range(stride)])
    rows = rows.withColumns({"levels": levels, "_h0": F.col("kids.hash")})
    for k in range(stride):
        below = F.col(f"_h{k}")
        rows = rows.withColumn(f"_h{k + 1}", F.when(F.col("levels") > k, _paired(below)).otherwise(below))

    def with_segment(kid: Column, at: Column) -> Column:
        siblings = [
            F.struct(
                (F.shiftright(at, k) % 2 == 1).alias("left"),
                F.get(F.col(f"_h{k}"), F.shiftright(at, k).bitwiseXOR(F.lit(1))).alias("hash"),
            )
            for k in range(stride)
        ]
        segment = F.slice(F.array(*siblings), F.lit(1), F.col("levels"))
        return F.struct(*[kid[c].alias(c) for c in ("idx", "hash", *payload)], segment.alias("segment"))

    return rows.select("tree", "n", "block", F.get(f"_h{stride}", F.lit(0)).alias("top"), F.transform("kids", with_segment).alias("kids"))


def _rise(nodes: DataFrame, stride: int, payload: list[str], label: str) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """The blocks of the leaves; the blocks above them by storey (the first holds nodes of storey 1); the roots ``(tree, storey, hash)``."""
    storeys, roots, storey = [], None, 0
    while True:
        blocks = materialise(fold_blocks(nodes, stride, payload if storey == 0 else []), f"{label}-{storey}")
        storeys.append(blocks)
        storey += 1
        tops = blocks.select("tree", F.ceil(F.col("n") / (1 << stride)).alias("n"), F.col("block").alias("idx"), F.col("top").alias("hash"))
        done = tops.where("n <= 1").select("tree", F.lit(storey).alias("storey"), "hash")
        roots = done if roots is None else roots.unionByName(done)
        nodes = tops.where("n > 1")
        if nodes.isEmpty():
            return storeys[0], storeys[1:], roots


def _pointers(storeys: list[DataFrame], stride: int) -> DataFrame | None:
    """``tree, storey, idx, to_tree, to_storey, to_idx, segment``, of the inner nodes that are no roots."""
    found = None
    for storey, blocks in enumerate(storeys, 1):
        kids = blocks.select("tree", "block", F.explode("kids").alias("k"))
        rows = kids.select(
            "tree", F.lit(storey).alias("storey"), F.col("k.idx").alias("idx"), F.col("tree").alias("to_tree"),
            F.lit(storey + 1).alias("to_storey"), F.col("block").alias("to_idx"), F.col("k.segment").alias("segment"),
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def jump(pointers: DataFrame, longest: int, stride: int) -> DataFrame:
    """Pointer jumping: ``pointers`` with the whole segment to the root, and the ``subroot`` met on the way.

    A null ``to_tree`` means that the root is reached. ``longest`` is the greatest number of pointers to the root.
    """
    now, reach = pointers, 1
    while reach < longest:
        now = materialise(now, "jump")
        # Only nodes that lie ``reach`` storeys up can be somebody's ancestor.
        far = now.where((F.col("storey") > reach) | (F.col("tree") == 0))
        far = far.select(*[F.col(c).alias(f"_{c}") for c in now.columns])
        if far.count() * reach * stride <= SMALL_ENTRIES:
            far = F.broadcast(far)
        moving = now.where("to_tree IS NOT NULL")
        met = (F.col("to_tree") == F.col("_tree")) & (F.col("to_storey") == F.col("_storey")) & (F.col("to_idx") == F.col("_idx"))
        moved = moving.join(far, met, "left").select(
            "tree", "storey", "idx", F.col("_to_tree").alias("to_tree"), F.col("_to_storey").alias("to_storey"),
            F.col("_to_idx").alias("to_idx"), F.concat("segment", F.coalesce("_segment", F.array().cast(ENTRIES))).alias("segment"),
            F.coalesce("subroot", "_subroot").alias("subroot"),
        )
        now, reach = now.where("to_tree IS NULL").unionByName(moved), 2 * reach
    return materialise(now, "proofs")


def fold(leaf: Column, segment: Column) -> Column:
    """The root that a leaf and its siblings, bottom up, lead to."""

    def step(below: Column, entry: Column) -> Column:
        beside = F.coalesce(entry["hash"], F.lit(""))
        return F.sha2(F.when(entry["left"], F.concat(beside, below)).otherwise(F.concat(below, beside)), 256)

    return F.aggregate(segment, leaf, step)


def proofs(leaves: DataFrame, group: str, order: list[str], payload: list[str], stride: int = STRIDE) -> DataFrame:
    """``leaves(group, hash, *order, *payload)`` -> ``hash, *payload, segment, subroot, root``.

    One tree per value of ``group``, leaves ascending by ``order`` (nulls first) and, among equals, by hash; one tree over the
    roots, by group (null first, bytewise). ``segment`` lists the siblings from the leaf to the root of all.
    """
    rows = numbered(leaves, group, [*order, "hash"], "leaves")
    first, storeys, roots = _rise(rows.select("tree", "n", "idx", "hash", *payload), stride, payload, "tree")
    roots = materialise(roots, "subroots")
    trees = roots.count()
    if not trees:
        return first.select(F.explode("kids").alias("k")).select("k.*", F.lit("").alias("subroot"), F.lit("").alias("root"))
    # The roots are leaves of tree 0; there they are known by the place they have in their own tree.
    crowned = roots.select(F.lit(0).cast("bigint").alias("tree"), F.lit(trees).cast("bigint").alias("n"), (F.col("tree") - 1).alias("idx"), "hash", "storey")
    top, upper, root = _rise(crowned, stride, ["storey"], "top")
    root_hash = root.first()["hash"]
    own = top.select("block", F.explode("kids").alias("k")).select(
        (F.col("k.idx") + 1).alias("tree"), F.col("k.storey").alias("storey"), F.lit(0).cast("bigint").alias("idx"),
        F.lit(0).cast("bigint").alias("to_tree"), F.lit(1).alias("to_storey"), F.col("block").alias("to_idx"),
        F.col("k.segment").alias("segment"), F.col("k.hash").alias("subroot"),
    )
    pointers = own
    for part in (_pointers(storeys, stride), _pointers(upper, stride)):
        if part is not None:
            pointers = pointers.unionByName(part.withColumn("subroot", F.lit(None).cast("string")))
    last = len(upper) + 1
    ends = (F.col("to_tree") == 0) & (F.col("to_storey") == last)
    pointers = pointers.withColumns({c: F.when(~ends, F.col(c)) for c in ("to_tree", "to_storey", "to_idx")})
    whole = jump(pointers, len(storeys) + 1 + len(upper) + 1, stride)
    above = whole.where("tree > 0 AND storey = 1").select("tree", F.col("idx").alias("block"), F.col("segment").alias("_above"), "subroot")
    met = first.join(above, ["tree", "block"]).select(F.explode("kids").alias("k"), "_above", "subroot")
    carried = [F.col(f"k.{c}").alias(c) for c in ("hash", *payload)]
    return met.select(*carried, F.concat("k.segment", "_above").alias("segment"), "subroot", F.lit(root_hash).alias("root"))


def merkle_manifest(docs: DataFrame, stride: int = STRIDE) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the hash of ``doc_id, source, lang, n_chars, text``; any of them may be null, other columns are ignored. Documents of
    a language ascend by id, null ids first; rows with the same id, and among them repeated rows, by their leaf. A
    null language is a tree of its own, before the others. ``proof_sha256`` is the hash of all siblings from leaf to
    root. ``folded_root`` is what the siblings and the leaf lead to after the drill of ``tampered``, which adds one to ``n_chars``:
    ``verified`` is false exactly for tampered documents with an ``n_chars``. An empty table gives no rows.
    """
    changed = tampered(F.col("doc_id")) & F.col("n_chars").isNotNull()
    forged = leaf_hash(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    leaves = docs.select("doc_id", "lang", leaf_hash(*[F.col(c) for c in FIELDS]).alias("hash"), F.when(changed, forged).alias("forged"))
    found = proofs(materialise(leaves, "leaves"), "lang", ["doc_id"], ["doc_id", "forged"], stride)
    folded = fold(F.coalesce("forged", "hash"), F.col("segment"))
    out = found.select(
        "doc_id", F.col("hash").alias("leaf"), "subroot", "root",
        F.sha2(F.concat_ws("", F.col("segment.hash")), 256).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

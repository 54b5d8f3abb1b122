"""SimHash near-dedup: fingerprints of word shingles, linked by self-joining a binary trie of their bits.

Distinct fingerprints are dealt into cells of fingerprints that agree on some blocks of bits: if at most three bits differ,
at least ``match`` of ``match + 3`` blocks agree, so every linked pair shares a cell. A task sorts its fingerprints cell by
cell; ranges of a sorted run are the nodes of a binary trie. Pairs of nodes are walked down together, adding the bits in
which they differ, and dropped once more than three do. Linked pairs are merged inside the task, so that it emits at
most one link per row, never all pairs of a group. A cell that would be too large is cut into chunks, and
each pair of chunks becomes a cell of its own.
"""

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.llm.cells import CELL_ROWS, cell_ranges, deal
from smeltworks.llm.common import gathered, with_columns
from smeltworks.llm.components import connected_components, merge
from smeltworks.sources.scratch import materialise

SHINGLE = 3
SEED = 42
BUDGET = 3
FRONTIER = 1 << 19


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Hashes (uint64) of all runs of ``shingle`` words in a row; a text of no more words is one run."""
    words = (text or "").encode().lower().split()  # bytes: lowers A-Z only, splits at ASCII white space only
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, seed)], "<u8")
    ends = list(itertools.accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends)]
    return np.fromiter(
        (digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :], strict=False)), "<u8", len(words) - shingle + 1
    )


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each set if it is set in more than half of the shingles' hashes; zero without words."""
    words = (text or "").encode().split()
    if not words:
        return 0
    hashes = shingle_hashes(text, shingle, seed)
    if len(words) <= shingle:
        return int(hashes[0])
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``(doc_id, fp)``; the fingerprint's bits as a signed bigint."""

    def compute(texts):
        return [np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64)]

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return with_columns(source, "text", "fp bigint", compute, keep=["doc_id"])


def block_masks(match: int) -> list[int]:
    """Bit masks, one per choice of ``match`` of ``match + BUDGET`` blocks of the 64 bits."""
    count = match + BUDGET
    edges = [64 * i // count for i in range(count + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    return [sum(pick) for pick in itertools.combinations(blocks, match)]


def _match(rows: int) -> int:
    """Fewest agreeing blocks that leave a few dozen rows in a cell if bits are even. Any choice finds all links."""
    return 1 if rows <= 1 << 22 else 2 if rows <= 1 << 31 else 3


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x)


def links(prints: DataFrame, match: int | None = None, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``prints(id, fp)`` with distinct ``fp`` -> links ``(a, b)`` of ids that connect all pairs within the budget."""
    masks = block_masks(match or _match(prints.count()))
    keys = F.array(*[F.struct(F.lit(s).alias("scheme"), F.col("fp").bitwiseAND(_signed(m)).alias("key")) for s, m in enumerate(masks)])
    placed = prints.select("id", "fp", F.inline(keys))
    dealt = deal(placed, ["scheme", "key"], "fp", cell_rows)
    return dealt.mapInArrow(_joined, "a bigint, b bigint")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = gathered(batches, ["id", "fp", "scheme", "key", "lo", "hi", "chunk"])
    if rows is None:
        return
    fp = rows["fp"].view(np.uint64)
    side = (rows["chunk"] != rows["lo"]).astype(np.int8)
    order = np.lexsort((fp, side, rows["hi"], rows["lo"], rows["key"], rows["scheme"]))
    fp, side, ids = fp[order], side[order], rows["id"][order]
    nodes = cell_ranges([rows["scheme"][order], rows["key"][order]], rows["lo"][order], rows["hi"][order], side)
    labels = np.arange(len(fp))
    for a, b in walk(fp, nodes):
        labels = merge(labels, a, b)
    at = np.flatnonzero(labels != np.arange(len(fp)))
    for i in range(0, len(at), 100_000):
        part = at[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(ids[part]), pa.array(ids[labels[part]])], names=["a", "b"])


def walk(fp: np.ndarray, nodes: np.ndarray, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of linked pairs below pairs of root nodes ``(a from, a to, b from, b to)``, ranges of sorted runs in ``fp``.

    A pair of equal ranges is a run against itself; mirrored pairs of its nodes are left out.
    """
    nodes = nodes[:, (nodes[1] > nodes[0]) & (nodes[3] > nodes[2])]
    zeros: dict[int, np.ndarray] = {}
    stack = [(0, nodes, np.zeros(nodes.shape[1], np.int8))]
    while stack:
        depth, nodes, spent = stack.pop()
        single = (nodes[1] - nodes[0] == 1) & (nodes[3] - nodes[2] == 1)
        if depth == 64:
            single[:] = True
        if single.any():
            a, b = nodes[0][single], nodes[2][single]
            near = (np.bitwise_count(fp[a] ^ fp[b]) <= budget) & (a != b)
            yield a[near], b[near]
            nodes, spent = nodes[:, ~single], spent[~single]
        if not len(spent):
            continue
        if len(spent) > FRONTIER:
            for part in np.array_split(np.arange(len(spent)), len(spent) // FRONTIER + 1):
                stack.append((depth, nodes[:, part], spent[part]))
            continue
        if depth not in zeros:
            zeros[depth] = np.r_[0, np.cumsum((fp >> np.uint64(63 - depth)) & np.uint64(1) == 0)]
        z = zeros[depth]
        a0, a2, b0, b2 = nodes
        a1, b1 = a0 + z[a2] - z[a0], b0 + z[b2] - z[b0]
        same = spent, spent
        more = spent + 1, spent + 1
        children = np.concatenate(
            [np.stack([a0, a1, b0, b1]), np.stack([a1, a2, b1, b2]), np.stack([a0, a1, b1, b2]), np.stack([a1, a2, b0, b1])], axis=1
        )
        spent = np.concatenate([*same, *more])
        # A node that lies behind its partner is the mirror of a pair met the other way round.
        alive = (spent <= budget) & (children[1] > children[0]) & (children[3] > children[2]) & (children[0] < children[3])
        stack.append((depth + 1, children[:, alive], spent[alive]))


def simhash_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    match: int | None = None,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    Fingerprints link at three or fewer differing bits; a component is named by the smallest id reachable by links. Texts
    without words (null, empty, white space) have fingerprint zero and are linked like others. Rows with the same id keep
    their own fingerprint each. A null id takes part but never names a component that has a real id; if all ids of a
    fingerprint are null, its rows keep to themselves with a null component. An empty table gives no rows.
    """
    prints = materialise(fingerprints(docs, doc_id, text, shingle), "prints")
    groups = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "groups")
    # An id that occurs on several rows may stand for several fingerprints; they are then one component.
    found = connected_components(links(groups.where("id IS NOT NULL"), match, cell_rows))
    named = groups.join(found, "id", "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

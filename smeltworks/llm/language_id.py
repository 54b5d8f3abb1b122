"""Language identification by prediction by partial matching.

Per language, byte contexts of up to three bytes form a tree of variable depth: a longer context exists only where the sample
has seen it often enough. Frozen counts give every byte after every context an exact cost in bits; a byte that a language has
not seen in a context pays the escape and falls back to the next shorter context, down to equal odds for all bytes. A
text's language is the one that codes the whole text in the fewest bits.

Costs are tabulated once per process: context node x symbol x language. Scoring a byte is then two array look-ups.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.llm.common import short_batches, with_columns

ORDER = 3
# Bound of the training sample: labelled documents per language.
SAMPLE_DOCS = 4000
# A context is kept if the sample has it this often, and the most frequent ones first if there are too many.
MIN_CONTEXT = 50
MAX_CONTEXTS = 12_000
# Bytes with a symbol of their own; all rarer ones share one symbol, whose cost includes telling them apart.
SYMBOLS = 128
# Bytes scored at once.
BLOCK = 1 << 19


@dataclass(frozen=True)
class Model:
    """``symbol`` of each byte; ``node`` of each triple of symbols; ``cost[node, symbol, language]`` in bits."""

    languages: tuple[str, ...]
    symbol: np.ndarray
    node: np.ndarray
    cost: np.ndarray


def training_rows(docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE_DOCS) -> DataFrame:
    """Labelled documents, about ``sample`` at most per language, chosen by a hash of the id."""
    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(lang).count().collect()}
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col(lang) == name, min(1.0, sample / n)).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.col(doc_id).cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return labelled.where(drawn < share).select(F.col(lang).alias("lang"), F.col(text).alias("text"))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (language, four bytes) in a partition. Each text is led by three zero bytes."""
    totals: dict[str, dict[int, int]] = {}
    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            by_lang.setdefault(lang, []).append(bytes(ORDER) + text.encode())
        for lang, parts in by_lang.items():
            known = totals.setdefault(lang, {})
            codes = np.concatenate([_codes(np.frombuffer(p, np.uint8)) for p in parts])
            for code, n in zip(*(x.tolist() for x in np.unique(codes, return_counts=True)), strict=True):
                known[code] = known.get(code, 0) + n
    for lang, known in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(known), pa.string()), pa.array(list(known), pa.int64()), pa.array(list(known.values()), pa.int64())],
            names=["lang", "gram", "n"],
        )


def _codes(b: np.ndarray) -> np.ndarray:
    b = b.astype(np.int64)
    return b[:-3] << 24 | b[1:-2] << 16 | b[2:-1] << 8 | b[3:]


def counted(rows: DataFrame) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """Per language the four-byte strings of the bounded sample and their counts."""
    short_batches(rows.sparkSession)
    sums = rows.mapInArrow(_grams, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = sums.toArrow().sort_by([("lang", "ascending"), ("gram", "ascending")])
    lang, gram, n = got["lang"].to_numpy(), got["gram"].to_numpy(), got["n"].to_numpy()
    return [(name, gram[lang == name], n[lang == name]) for name in sorted(set(lang))]


def build(counts: list[tuple[str, np.ndarray, np.ndarray]], min_context: int = MIN_CONTEXT, max_contexts: int = MAX_CONTEXTS) -> Model:
    languages, a = tuple(c[0] for c in counts), SYMBOLS
    seen = np.zeros(256, np.int64)
    for _, gram, n in counts:
        np.add.at(seen, gram & 255, n)
    # The zero byte, which stands before a text, always has symbol 1; symbol 0 is "any other byte".
    frequent = [b for b in np.argsort(-seen, kind="stable") if b and seen[b]][: a - 2]
    symbol = np.zeros(256, np.int32)
    symbol[0], symbol[frequent] = 1, np.arange(2, len(frequent) + 2)
    others = int((symbol == 0).sum())

    coded = []
    for _, gram, n in counts:
        parts = [symbol[gram >> s & 255].astype(np.int64) for s in (24, 16, 8, 0)]
        coded.append((*parts, n))
    # Contexts by length, the last byte lowest. Which exist is decided on all languages together.
    exists, total = [np.array([0])], {}
    for order in (1, 2, 3):
        found = [(np.unique(_context(c, order, a), return_inverse=True), c[4]) for c in coded]
        keys = np.concatenate([u for (u, _), _ in found]) if found else np.zeros(0, np.int64)
        sums = np.concatenate([np.bincount(inv, n) for (_, inv), n in found]) if found else np.zeros(0)
        u, inv = np.unique(keys, return_inverse=True)
        weight = np.bincount(inv, sums)
        if order > 1:  # only below a context that exists
            weight[~np.isin(u % a ** (order - 1), exists[order - 1])] = 0
        kept = u[weight >= min_context]
        room = max_contexts - sum(map(len, exists))
        if len(kept) > room:
            kept = np.sort(u[np.argsort(-weight, kind="stable")[: max(room, 0)]])
        exists.append(kept)
    first = np.cumsum([0, *map(len, exists)])
    cost = np.empty((first[-1], a, len(languages)), np.float32)
    for at, c in enumerate(coded):
        parent = np.full((1, a), np.log2(256.0), np.float64)
        parent[0, 0] = np.log2(256 / others) if others else 0.0  # telling the others apart is added below
        for order, contexts in enumerate(exists):
            n = np.zeros((len(contexts), a))
            key = _context(c, order, a)
            i = np.searchsorted(contexts, key)
            ok = (i < len(contexts)) & (contexts[np.minimum(i, max(len(contexts) - 1, 0))] == key) if len(contexts) else np.zeros(len(key), bool)
            np.add.at(n, (i[ok], c[3][ok]), c[4][ok])
            if order:
                up = np.searchsorted(exists[order - 1], contexts % a ** (order - 1))
                parent = level[up]
            kinds, whole = (n > 0).sum(1, keepdims=True), n.sum(1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                hit = np.log2((whole + kinds) / n)
                escape = np.log2((whole + kinds) / kinds)
            level = np.where(n > 0, hit, np.where(whole > 0, escape, 0.0) + parent)
            cost[first[order] : first[order + 1], :, at] = level
    if others:
        cost[:, 0, :] += np.log2(others)
    # Longest existing context of each triple of symbols.
    node = np.zeros(a**3, np.int32)
    triples = np.arange(a**3, dtype=np.int32)
    for order in (1, 2, 3):
        table = np.full(a**order, -1, np.int32)
        table[exists[order]] = first[order] + np.arange(len(exists[order]))
        got = table[triples % a**order]
        node = np.where(got >= 0, got, node)
    return Model(languages, symbol, node, cost)


def _context(c: tuple, order: int, a: int) -> np.ndarray:
    key = np.zeros(len(c[0]), np.int64)
    for part in c[3 - order : 3]:
        key = key * a + part
    return key


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits per text and language, over whole texts."""
    out = np.zeros((len(texts), len(model.languages)))
    block, size = [], 0
    for i, text in enumerate(texts):
        # A longer text than a block is cut, with the three bytes before each cut as context.
        for at in range(0, len(text), BLOCK):
            block.append((i, (bytes(ORDER) if not at else text[at - ORDER : at]) + text[at : at + BLOCK]))
            size += len(block[-1][1])
            if size >= BLOCK:
                _score(model, block, out)
                block, size = [], 0
    _score(model, block, out)
    return out


def _score(model: Model, block: list[tuple[int, bytes]], out: np.ndarray) -> None:
    if not block:
        return
    a = SYMBOLS
    s = model.symbol[np.frombuffer(b"".join(b for _, b in block), np.uint8)]
    nodes = model.node[(s[:-3] * a + s[1:-2]) * a + s[2:-1]]
    bits = model.cost[nodes, s[3:]]
    starts = np.cumsum([0, *(len(b) for _, b in block)])[:-1]
    # Windows that reach over a text's first three bytes are no symbols of a text.
    for k in range(1, ORDER + 1):
        bits[starts[1:] - k] = 0
    np.add.at(out, [i for i, _ in block], np.add.reduceat(bits, np.minimum(starts, len(bits) - 1), axis=0, dtype=np.float64))


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and share of its likelihood among all languages; ``und`` and 0 without letters or without a model."""
    lettered = [bool(t) and (t[0].isalpha() or any(map(str.isalpha, t))) for t in texts]
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts))
    bits = code_lengths(model, [t.encode() if ok else b"" for t, ok in zip(texts, lettered, strict=True)])
    best = bits.argmin(1)
    share = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
    names = [model.languages[b] if ok else "und" for b, ok in zip(best.tolist(), lettered, strict=True)]
    return names, np.where(lettered, share, 0.0)


def train(docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE_DOCS) -> list:
    """Counts of a bounded sample of labelled rows: what a model is built from, a few MB whatever the size of ``docs``."""
    return counted(training_rows(docs, lang, text, doc_id, sample))


def identify(docs: DataFrame, counts: list, text: str = "text", keep: list[str] | None = None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (or the given ``names``), predicted from the whole text alone.

    Null texts and texts without a letter are ``und`` with score 0, as is everything if no labelled row was there to learn
    from. Equal texts get equal results; ties go to the first language by name. Input columns with the new names are replaced.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(counts), uuid.uuid4().hex

    def compute(texts: list) -> list:
        return [*predict(_built(name, shared), texts)]

    return with_columns(docs, text, f"{names[0]} string, {names[1]} double", compute, keep)


_HELD: dict[str, Model] = {}


def _built(name: str, counts: Broadcast) -> Model:
    """The model of the counts; a process keeps the last one it built."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = build(counts.value)
    return _HELD[name]


def held_out(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out and predict all: ``doc_id, held_out, lang_pred, score``."""
    named = docs.select("doc_id", "text", "lang").withColumn("held_out", F.coalesce(held_out(), F.lit(False)))
    counts = train(named.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return identify(named, counts, keep=["doc_id", "held_out"])

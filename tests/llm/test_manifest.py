import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from harness.check import oracle_connection
from harness.check import rows as sorted_rows
from smeltworks.llm import queries
from smeltworks.llm.merkle_manifest import merkle_manifest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, more=0):
    n = None if r["n_chars"] is None else r["n_chars"] + more
    values = (r["doc_id"], r["source"], r["lang"], n, r["text"])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes):
    """The root, and per leaf its siblings bottom up as ``(is the sibling on the left, its hash or None)``."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        for i, p in enumerate(at):
            paths[i].append((p % 2 == 1, level[p ^ 1] if p ^ 1 < len(level) else None))
            at[i] = p // 2
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
    return level[0], paths


def brute(rows):
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append(r)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    sorted_ = {k: sorted(v, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for k, v in by_lang.items()}
    trees = {k: tree([leaf(r) for r in sorted_[k]]) for k in langs}
    root, top = tree([trees[k][0] for k in langs])
    out = []
    for lang, upper in zip(langs, top, strict=True):
        for r, lower in zip(sorted_[lang], trees[lang][1], strict=True):
            forged = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            folded = leaf(r, int(forged))
            for is_left, h in lower + upper:
                folded = sha((h or "") + folded if is_left else folded + (h or ""))
            proof = sha("".join(h or "" for _, h in lower + upper))
            out.append((r["doc_id"], leaf(r), trees[lang][0], root, proof, folded, folded == root))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def rows_of(n):
    """Languages of very different sizes, one of a single document and one null; ids and rows that repeat."""
    langs = ["en"] * 8 + ["de"] * 3 + [None, "é", "z"]
    rows = [(i // 2 if i % 11 == 0 else i, f"text {i}" if i % 13 else None, langs[i % len(langs)], None if i % 5 == 0 else "ü", i if i % 6 else None) for i in range(n)]
    return [*rows, rows[-1], rows[-1], (None, None, None, None, None), (None, "", "", "", 0), (-7, "x" * 300_000, "lone", "s", 1)]


@pytest.mark.parametrize("stride, n", [(1, 90), (2, 3), (6, 150)])
def test_manifest_equals_brute_force(spark, stride, n):
    df = spark.createDataFrame(rows_of(n), DOCS).repartition(5)
    assert found(merkle_manifest(df, stride)) == brute(df.collect())


def test_ancestors_are_joined_alike_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr("smeltworks.llm.merkle_manifest.SMALL_ENTRIES", 0)
    df = spark.createDataFrame(rows_of(90), DOCS)
    assert found(merkle_manifest(df, 2)) == brute(df.collect())


def test_only_tampered_documents_fail(spark):
    df = spark.createDataFrame(rows_of(100), DOCS)
    wrong = {r.doc_id for r in merkle_manifest(df).where("NOT verified").collect()}
    known = [r for r in df.collect() if r.doc_id is not None and r.n_chars is not None]
    assert wrong == {r.doc_id for r in known if zlib.crc32(str(r.doc_id).encode()) % 7 == 0} and wrong


def test_one_language_one_document_no_document(spark):
    df = spark.createDataFrame(rows_of(1)[:1], DOCS)
    (only,) = merkle_manifest(df).collect()
    assert only.leaf == only.subroot == only.root == only.folded_root or not only.verified
    assert only.proof_sha256 == sha("")
    assert merkle_manifest(df.where("false")).isEmpty()
    assert merkle_manifest(df).columns == merkle_manifest(df.where("false")).columns
    flat = spark.createDataFrame([(i, "t", "en", "s", i) for i in range(9)], DOCS)
    assert found(merkle_manifest(flat, 2)) == brute(flat.collect())


def test_clashing_columns(spark):
    df = spark.createDataFrame(rows_of(40), DOCS)
    names = ["hash", "tree", "idx", "n", "leaf", "forged", "segment", "_row", "_part", "top"]
    assert found(merkle_manifest(df.withColumns({c: F.lit(1) for c in names}))) == brute(df.collect())


def test_query_equals_sql(spark, sf):
    name = "op13_pointer_jumping_manifest"
    df, result = queries.queries()[name](spark, sf), oracle_connection(sf).sql(queries.oracle_sql()[name])
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(result.columns, result.fetchall())

import numpy as np
from test_dedup import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from smeltworks.llm import pii
from smeltworks.llm.packing import packed_digests
from test_text import WORDS_FILE


def test_stages_on_odd_rows(spark, docs):
    state = docs.selectExpr("doc_id", "text", "lang", "source", "cast(length(text) as bigint) AS n_chars", "score", "'x' AS kept", "'y' AS fp")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, state, "")
        assert after.columns == state.columns, name
        state = after
    rows = state.collect()
    ids = sorted(r.doc_id for r in rows if r.doc_id)
    # 2 is a copy of 1, 7 a near copy of 6, 8 stands on two equal rows, the null id on a copy of 1; texts without letters go.
    assert ids == [1, 6, 8, 12] and len(rows) == 4
    assert [r.text for r in rows if r.doc_id == 12] == ["write to [EMAIL] or [PHONE] from [IP], card [CARD]"]
    assert all(r.n_chars == len(r.text) and r.kept == "x" for r in rows)
    assert corpus_pipeline.STAGES[-1][1](spark, state, "").count() >= len(rows)


def test_copies_go_by_row_not_by_id(spark):
    """An id on two texts loses only the copy among them; of rows without an id one stays if nothing else does."""
    rows = [(1, "same text"), (5, "same text"), (5, "a text of its own"), (None, "nameless words"), (None, "nameless words"), (None, "same text")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for stage in (corpus_pipeline.exact_copies, corpus_pipeline.near_copies):
        got = sorted(((r.doc_id or 0, r.text) for r in stage(spark, docs, "").collect()))
        assert got == [(0, "nameless words"), (1, "same text"), (5, "a text of its own")]


def test_stages_on_an_empty_table(spark, docs):
    state = docs.where("doc_id < 0").selectExpr("doc_id", "text", "lang", "source", "cast(0 as bigint) AS n_chars")
    for _, stage in corpus_pipeline.STAGES:
        state = stage(spark, state, "")
        assert state.isEmpty()


def test_run_equals_brute_force(spark, sf):
    documents = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    kept = {i: t for i, t in sorted(documents.items()) if any(map(str.isalpha, t or ""))}
    first = {}
    for i, t in kept.items():
        first.setdefault(" ".join(t.split()) if t.split() else " ", i)
    ids = np.array(sorted(first.values()))
    fp = np.array([brute_fingerprint(kept[i]) for i in ids], np.uint64)
    ids = ids[brute_components(ids, np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3) == ids]
    plain = Tokenizer.from_file(WORDS_FILE)
    got = {}
    for r in entry.queries()["pipeline"](spark, sf).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sorted(got) == ids.tolist()
    for i, pieces in got.items():
        text, at = kept[i], 0
        parts = []
        for start, end, kind in sorted((s, e, k) for k, s, e in pii.base_spans(text)):
            parts += [text[at:start], f"[{pii.KINDS[kind].upper()}]"]
            at = end
        tokens = len(plain.encode("".join([*parts, text[at:]]), add_special_tokens=False).ids) + 1
        # Spans that the trees add may change a text further; the base spans alone are checked here.
        assert sum(p.length for p in pieces) == pieces[0].doc_tokens and abs(pieces[0].doc_tokens - tokens) <= 0.05 * tokens + 5


def test_entry_lists_every_operator():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert packed_digests.__module__.startswith("smeltworks.llm")

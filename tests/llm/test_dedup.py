import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harness.check import oracle_connection
from harness.check import rows as sorted_rows
from smeltworks.llm import components, exact_dedup, line_dedup, queries, simhash


def by_id(df):
    return {r.doc_id: r for r in df.where("doc_id IS NOT NULL").collect()}


# -- exact


@given(st.lists(st.tuples(st.integers(0, 40), st.booleans()), max_size=300))
@settings(deadline=None, max_examples=50)
def test_index_equals_a_counter(steps):
    index, want = exact_dedup.DigestIndex(buckets=1), defaultdict(int)
    for n, add in steps:
        key = n.to_bytes(2, "little") * 16
        if add:
            assert index.add(key, n) == (want[n] == 0)
            want[n] += 1
        else:
            assert index.remove(key) == (want[n] == 1)
            want[n] = max(0, want[n] - 1)
    assert {e[1]: e[2] for e in index.live()} == {n: c for n, c in want.items() if c}


def test_filter_grows_from_the_stored_keys_and_deletes():
    index = exact_dedup.DigestIndex(buckets=1)
    keys = [bytes(np.random.default_rng(i).bytes(32)) for i in range(2000)]
    assert all(index.add(k, i) for i, k in enumerate(keys)) and index.filter.buckets >= 512
    assert not any(index.add(k, 0) for k in keys)
    assert all(index.remove(k, 2) for k in keys) and not any(index.filter.slots)


def test_exact_dedup_of_odd_rows(docs, no_docs):
    got = by_id(exact_dedup.exact_dedup(docs))
    assert (got[2].keep_id, got[2].group_size, got[2].kept) == (1, 3, False) and got[1].kept
    assert got[3].keep_id == got[4].keep_id == 3 and got[4].group_size == 3  # null, empty, and the null id's null
    assert got[5].kept and got[8].kept and got[8].group_size == 2
    lost = exact_dedup.exact_dedup(docs).where("doc_id IS NULL").collect()
    assert len(lost) == 2 and not any(r.kept for r in lost)
    assert exact_dedup.exact_dedup(no_docs).isEmpty()


def test_index_takes_and_gives_up_documents(docs):
    hashed = exact_dedup.digests(docs)
    index = exact_dedup.build_index(hashed)
    one = hashed.where("doc_id = 8").limit(1)
    after = exact_dedup.update_index(index, hashed, removed=one)
    assert exact_dedup.seen(after, one).first().is_live
    gone = exact_dedup.update_index(index, hashed, removed=hashed.where("doc_id = 8"))
    assert not exact_dedup.seen(gone, one).first().is_live
    back = exact_dedup.update_index(gone, hashed.where("doc_id <> 8 OR doc_id IS NULL"), added=one)
    assert exact_dedup.seen(back, one).first().is_live


def test_updates_equal_an_index_built_anew(spark):
    def frame(rows):
        return spark.createDataFrame([(i, t.encode()) for i, t in rows], "doc_id bigint, digest binary")

    def told(index):
        return sorted((bytes(r.digest), r.keep_id, r.copies) for r in index.collect())

    stored = [(1, "a"), (2, "a"), (2, "a"), (None, "a"), (3, "b"), (4, "b"), (None, "c"), (5, "d"), *((i, f"t{i % 9}") for i in range(10, 60))]
    added = [(0, "b"), (6, "e"), (None, "d")]
    removed = [(1, "a"), (2, "a"), (3, "b"), (5, "d"), (77, "b"), (6, "e"), (6, "e"), (None, "c"), (10, "t1"), (9, "none")]
    left = [*stored, *added]
    for row in removed:
        if row in left:
            left.remove(row)
    before = exact_dedup.build_index(frame(stored))
    want = told(exact_dedup.build_index(frame(left)))
    assert told(exact_dedup.update_index(before, frame(stored), frame(added), frame(removed))) == want
    assert want[:2] == [(b"a", 2, 2), (b"b", 0, 2)]
    assert told(exact_dedup.update_index(before, frame(stored))) == told(before)


def test_full_index_is_put_out_where_the_digest_changes(monkeypatch):
    monkeypatch.setattr(exact_dedup, "INDEX_ENTRIES", 3)
    rows = [(bytes([d]) * 32, i, n) for d in range(20) for i, n in ((d + 100, 2), (d, 1), (None, -1 if d % 5 else -3))]
    names = ["digest", "keep_id", "copies"]
    types = [pa.binary(), pa.int64(), pa.int64()]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 7], strict=True), types, strict=True)], names=names) for i in range(0, len(rows), 7)]
    parts = list(exact_dedup._indexed(iter(batches)))
    assert len(parts) > 4 and max(p.num_rows for p in parts) <= 4
    assert [r for p in parts for r in p.to_pylist()] == [dict(zip(names, (bytes([d]) * 32, d, 2), strict=True)) for d in range(20) if d % 5]
    assert [p.num_rows for p in exact_dedup._indexed(iter([]))] == [0]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, sf, name):
    df, result = queries.queries()[name](spark, sf), oracle_connection(sf).sql(queries.oracle_sql()[name])
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(result.columns, result.fetchall())


# -- lines


def test_lines_above_the_share_go(spark, no_docs):
    pages = [(i, f"menu\nown {i}\n\nrare {i % 2}", "h", "x") for i in range(10)] + [(99, "menu\nown", "other", "y"), (98, "menu", None, "z"), (97, None, "h", None)]
    df = spark.createDataFrame(pages, "doc_id int, text string, source string, n_dropped string")
    got = {r.doc_id: r for r in line_dedup.drop_boilerplate(df, percent=60).collect()}
    assert got[3].text == "own 3\n\nrare 1" and got[3].n_dropped == 1
    assert got[99].text == "menu\nown" and got[98].text == "menu" and got[97].text is None and got[97].n_dropped == 0
    assert line_dedup.drop_boilerplate(no_docs).isEmpty()


def test_copies_of_an_article_are_one_page_and_small_hosts_lose_their_menu(spark):
    long_line = "word " * 100_000
    rows = [(i, f"own {i}\nline {i}", "big") for i in range(94)] + [(100 + i, "an article\nof two lines", "big") for i in range(6)]
    rows += [(200 + i, f"Site menu\npage {i}", "small") for i in range(4)] + [(300 + i, "shared\nboth", "two") for i in range(2)] + [(400, long_line, "big"), (401, "", "big")]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.drop_boilerplate(df).collect()}
    assert all(got[100 + i] == ("an article\nof two lines", 0) for i in range(6)) and got[5] == ("own 5\nline 5", 0)
    assert all(got[200 + i] == (f"page {i}", 1) for i in range(4)) and got[300] == ("shared\nboth", 0)
    assert got[400] == (long_line, 0) and got[401] == ("", 0)


# -- near copies


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="aBcÄé \t\n\x1c x", max_size=60))
@settings(deadline=None)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def brute_components(ids, linked):
    labels = np.arange(len(ids))
    while True:
        new = np.array([labels[linked[i]].min() for i in range(len(ids))])
        if (new == labels).all():
            return ids[labels]
        labels = new


@pytest.mark.parametrize(("match", "cell_rows"), [(1, 512), (1, 7), (2, 20), (3, 512)])
def test_links_connect_what_lies_within_three_bits(spark, match, cell_rows):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 6), replace=False))) for b in base for _ in range(8)]
    crowd = base[0] ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64))
    fp = np.unique(np.concatenate([base, np.array(near, np.uint64), crowd]))
    df = spark.createDataFrame([(i, int(f)) for i, f in enumerate(fp.view(np.int64))], "id bigint, fp bigint")
    found = components.connected_components(simhash.links(df, match, cell_rows))
    got = {r.id: r.component for r in found.collect()}
    want = brute_components(np.arange(len(fp)), np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3)
    assert [got.get(i, i) for i in range(len(fp))] == want.tolist()


def test_simhash_dedup_equals_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    texts = sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
    fp = np.array([brute_fingerprint(t) for _, t in texts], np.uint64)
    want = brute_components(np.array([i for i, _ in texts]), np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3)
    got = sorted(tuple(r) for r in simhash.simhash_dedup(df).collect())
    assert got == [(i, f"{f:016x}", c) for (i, _), f, c in zip(texts, fp.tolist(), want.tolist(), strict=True)]


def test_simhash_dedup_of_odd_rows(docs, no_docs):
    got = by_id(simhash.simhash_dedup(docs))
    assert got[3].component_id == got[4].component_id == got[5].component_id == 3 and got[3].fingerprint == "0" * 16
    assert got[2].component_id == 1 and got[7].component_id == 6
    assert simhash.simhash_dedup(docs).count() == docs.count() and simhash.simhash_dedup(no_docs).isEmpty()


def test_components_of_a_star_a_path_and_a_ring(spark):
    pairs = [(0, i) for i in range(10, 200)] + [(i, i + 1) for i in range(300, 360)] + [(500 + i, 500 + (i + 1) % 40) for i in range(40)] + [(7, 7), (None, 3)]
    found = components.connected_components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    got = {r.id: r.component for r in found.collect()}
    assert found.count() == len(got) == 191 + 61 + 40
    assert set(got.values()) == {0, 300, 500}
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).isEmpty()


def test_null_ids_stay_out_of_links(docs):
    lone = simhash.simhash_dedup(docs.where("doc_id IS NULL").withColumn("text", F.lit("only here")))
    assert [r.component_id for r in lone.collect()] == [None, None]

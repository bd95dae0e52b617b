import hashlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import CLASHING, LONG_LINE, LOWER, SMALL, documents, in_sql, nothing, rows, sample_texts

from millrace.llm import exact_dup, line_dedup, near_dup
from millrace.llm.queries import ORACLE_SQL, QUERIES


# Exact duplicates


def test_exact_groups_of_odd_rows(spark):
    found = exact_dup.exact_dup_groups(documents(spark)).collect()
    given = sample_texts()
    assert len(found) == len(given)
    groups = defaultdict(list)
    for doc_id, text in given:
        groups[(text or "").translate(LOWER)].append(doc_id)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = defaultdict(int)
    for r in found:
        ids = by_sha[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert (r.keep_id, r.group_size) == (max(known) if known else None, len(ids))
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}  # one row of each group, also where an id is repeated


def test_exact_drop_keeps_columns_and_one_row_each(spark):
    docs = documents(spark)
    out = exact_dup.drop_exact_dups(docs)
    assert out.columns == docs.columns
    texts = [(r.text or "").translate(LOWER) for r in out.collect()]
    assert sorted(texts) == sorted({(t or "").translate(LOWER) for _, t in sample_texts()})


def test_exact_of_nothing(spark):
    assert exact_dup.exact_dup_groups(nothing(spark)).collect() == []
    assert exact_dup.drop_exact_dups(nothing(spark)).collect() == []


def test_directory_doubles_only_where_buckets_are_full():
    table, deeper = exact_dup.grow_directory(np.array([9, 1, 1, 1]), 10)
    assert len(set(table.tolist())) == 2 and len(table) == 2 and not deeper
    table, deeper = exact_dup.grow_directory(np.array([9, 9, 1, 1]), 10)
    assert table.tolist()[2] == table.tolist()[3] and len(set(table.tolist())) == 3 and not deeper
    assert exact_dup.grow_directory(np.array([90, 1]), 10)[1]


def test_small_buckets_give_the_same_groups(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert rows(exact_dup.exact_dup_groups(docs, capacity=8)) == rows(exact_dup.exact_dup_groups(docs))


def test_colliding_keys_are_told_apart_by_their_bytes():
    import pyarrow as pa

    entries = [(0, 5, b"A", b"aa", 1, 1), (0, 5, b"B", b"bb", 9, 1), (0, 5, b"A", b"aa", 4, 1), (0, 5, b"B", None, 2, 3), (0, 6, b"C", b"cc", None, 1)]
    batch = exact_dup._batch(exact_dup._ENTRY, entries)
    out = [r for b in exact_dup._owned(iter([batch])) for r in pa.Table.from_batches([b]).to_pylist()]
    assert [(r["h"], r["chain"], r["keep_id"], r["group_size"]) for r in out] == [(5, 0, 4, 2), (5, 1, 9, 4), (6, 0, None, 1)]


# Near duplicates


def brute_force_groups(given: list[tuple[int | None, str | None]], bits: int = 2, only_least: bool = False) -> list:
    from xxhash import xxh64_intdigest

    prints = []
    for _, text in given:
        words = [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").split(" ") if w]
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    group = list(range(len(given)))
    for i in range(len(given)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min((given[k][0] for k in range(len(given)) if group[k] == g and given[k][0] is not None), default=None) for g in group}
    if only_least:
        return sorted(least.values(), key=repr)
    return sorted(((given[k][0], f"{prints[k]:016x}", least[group[k]]) for k in range(len(given))), key=repr)


def test_near_groups_match_brute_force(spark):
    found = [(r.doc_id, r.fingerprint, r.component_id) for r in near_dup.near_dup_groups(documents(spark)).collect()]
    assert sorted(found, key=repr) == brute_force_groups(sample_texts())


def test_near_groups_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = [(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op9_simhash_near_dedup"](spark, SMALL).collect()]
    assert sorted(found, key=repr) == brute_force_groups(given)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_tree_links_every_near_pair(bits):
    rng = np.random.default_rng(1)
    far = rng.integers(0, 1 << 63, 1500, dtype=np.uint64)
    ball = far[0] ^ (np.uint64(1) << rng.integers(0, 64, (700, 4), dtype=np.uint64)).sum(1).astype(np.uint64)  # too dense to split
    points = np.unique(np.concatenate([far, far[:300] ^ np.uint64(5), ball]))
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= bits
    label = np.arange(len(points))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    tree, leaves = near_dup.fit_tree(points[::3], len(points), 300, bits)
    a, b = zip(*(near_dup.link(np.unique(part), bits) for _, part in near_dup.route(tree, points, bits)))
    u, v = near_dup._star(points, np.searchsorted(points, np.concatenate(a)), np.searchsorted(points, np.concatenate(b)))
    found = dict(zip(u.tolist(), v.tolist()))
    assert leaves > 1
    assert [found.get(p, p) for p in points.tolist()] == points[label].tolist()


def test_dense_points_are_linked_by_lookup():
    points = np.unique(np.arange(4096, dtype=np.uint64) * np.uint64(8))
    i, j = near_dup._dense(points, 2)
    k, m = np.nonzero(np.triu(np.bitwise_count(points[:, None] ^ points[None, :]) <= 2, 1))
    assert set(zip(i.tolist(), j.tolist())) == set(zip(k.tolist(), m.tolist()))


def test_components_of_a_chain_and_a_star(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, i) for i in range(200, 260)], "a long, b long")
    found = {r.node: r.label for r in near_dup.components(edges).collect()}
    assert found == {**{i: 0 for i in range(21)}, 100: 100, **{i: 100 for i in range(200, 260)}}


def test_near_drop_keeps_the_smallest_id(spark):
    docs = documents(spark)
    out = near_dup.drop_near_dups(docs)
    assert out.columns == docs.columns
    assert sorted((r.doc_id for r in out.collect()), key=repr) == brute_force_groups(sample_texts(), only_least=True)


def test_near_drop_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((r.doc_id for r in near_dup.drop_near_dups(docs).collect()), key=repr) == brute_force_groups(given, only_least=True)


def test_near_of_nothing(spark):
    assert near_dup.near_dup_groups(nothing(spark)).collect() == []
    assert near_dup.drop_near_dups(nothing(spark)).collect() == []


# Lines


def brute_force_lines(given, least_chars=40, least_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for doc_id, text in given:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add((doc_id, text))
    order = lambda i: (i is not None, i or 0)
    last = {k: max((i for i, _ in v), key=order) for k, v in holders.items() if len(v) >= least_docs}
    out = []
    for doc_id, text in given:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == doc_id]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_lines_match_brute_force(spark):
    found = line_dedup.line_dedup_report(documents(spark), batches=3).collect()
    expected = [(i, n, d, hashlib.sha256(k.encode()).hexdigest()) for i, n, d, k in brute_force_lines(sample_texts())]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in found), key=repr) == sorted(expected, key=repr)
    assert sum(d for _, _, d, _ in expected) > 10


def test_number_of_batches_does_not_matter(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    one = rows(line_dedup.line_dedup_report(docs, batches=1))
    assert one == rows(line_dedup.line_dedup_report(docs, batches=7, fan=2)) == in_sql(ORACLE_SQL["op10_line_dedup"], documents=docs)


def test_lines_are_taken_out_of_the_text(spark):
    docs = documents(spark)
    out = line_dedup.drop_repeated_lines(docs)
    assert out.columns == docs.columns
    kept = {(i, k) for i, _, d, k in brute_force_lines(sample_texts()) if d}
    found = {(r.doc_id, r.text) for r in out.collect()}
    assert kept <= found and (4, None) in found
    assert all(getattr(r, "kept") == "x" for r in out.collect()) and LONG_LINE in {r.text for r in out.collect()}
    assert set(CLASHING) <= set(out.columns)


def test_lines_of_nothing(spark):
    assert line_dedup.line_dedup_report(nothing(spark)).collect() == []
    assert line_dedup.drop_repeated_lines(nothing(spark)).collect() == []


@pytest.mark.parametrize("name", ["op4_exact_dedup", "op10_line_dedup"])
def test_queries_match_sql(spark, name):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert rows(QUERIES[name](spark, SMALL)) == in_sql(ORACLE_SQL[name], documents=docs)

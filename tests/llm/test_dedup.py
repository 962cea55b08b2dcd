"""Exact and near duplicates against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from profileloom.llm import components, golomb_dedup, simhash


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_golomb_codes_round_trip(n):
    values = np.sort(np.random.default_rng(n).choice(1 << 30, n, replace=False)).astype(np.int64)
    k, unary, rests = golomb_dedup.golomb_encode(values, 30)
    assert (golomb_dedup.golomb_decode(n, k, unary, rests) == values).all()
    if n == 1000:
        assert len(unary) + len(rests) < 3 * n  # log2(2**30 / 1000) + 1.5 bits, about


def normal(text):
    return (text or "").encode().lower()


def test_exact_duplicates_of_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    sizes = Counter(normal(t) for _, t in rows)
    found = golomb_dedup.exact_duplicates(awkward).collect()
    assert Counter((r.doc_id, r.text_sha256) for r in found) == Counter(
        (i, hashlib.sha256(normal(t)).hexdigest()) for i, t in rows
    )
    by_hash = {hashlib.sha256(t).hexdigest(): n for t, n in sizes.items()}
    for sha, size in by_hash.items():
        group = [r for r in found if r.text_sha256 == sha]
        ids = [r.doc_id for r in group if r.doc_id is not None]
        assert [r.group_size for r in group] == [size] * size
        assert {r.keep_id for r in group} == {max(ids) if ids else None}
        assert [r.doc_id for r in group if r.kept] == [max(ids) if ids else None]


def test_small_blocks_and_many_owners(spark, awkward, monkeypatch):
    expected = sorted(map(str, golomb_dedup.exact_duplicates(awkward).drop("kept").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        found = golomb_dedup.exact_duplicates(awkward.repartition(5)).drop("kept").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(map(str, found)) == expected


def test_one_of_each_text_stays_with_all_columns(awkward):
    kept = golomb_dedup.keep_one_of_equal(awkward)
    assert kept.columns == awkward.columns
    texts = [normal(r.text) for r in kept.collect()]
    assert sorted(texts) == sorted({normal(r.text) for r in awkward.collect()})
    plain = awkward.filter("doc_id is not null").dropDuplicates(["doc_id"])
    assert sorted(r.doc_id for r in golomb_dedup.keep_one_of_equal(plain).collect()) == [2, 4, 5, 6, 7, 8, 9]


def test_empty_tables(nothing):
    assert golomb_dedup.exact_duplicates(nothing).count() == 0
    assert golomb_dedup.keep_one_of_equal(nothing).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_one_of_near(nothing).columns == nothing.columns


def slow_print(text):
    words = normal(text).split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(pairs, most=3):
    ids = {}
    for doc_id, fp in pairs:
        ids.setdefault(fp, set()).add(doc_id)
    left, out = set(ids), {}
    while left:
        group, queue = set(), [left.pop()]
        while queue:
            one = queue.pop()
            group.add(one)
            near = {x for x in left if (x ^ one).bit_count() <= most}
            left -= near
            queue += near
        known = [i for fp in group for i in ids[fp] if i is not None]
        out |= dict.fromkeys(group, min(known) if known else None)
    return out


def test_near_duplicates_of_awkward_rows(awkward):
    rows = [(r.doc_id, slow_print(r.text)) for r in awkward.collect()]
    roots = slow_components(rows)
    expected = Counter((i, f"{fp:016x}", roots[fp]) for i, fp in rows)
    assert Counter(map(tuple, simhash.near_duplicates(awkward).collect())) == expected


@pytest.mark.parametrize(("width", "chunk"), [(3, 4), (3, 512), (5, 512)])
def test_components_whatever_the_index(spark, width, chunk, monkeypatch):
    rng = np.random.default_rng(7)
    prints = []
    for centre in rng.integers(0, 2**63, 12):
        prints += [int(centre) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in range(25)]
    monkeypatch.setattr(simhash, "_fingerprints", None)
    frame = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in set(prints)], "print long")
    roots = {r.node: r.root for r in components.connected(simhash._links(frame, 3, width, chunk)).collect()}
    signed = {p - 2**64 if p >= 2**63 else p for p in prints}
    classes = {}
    for p in signed:
        classes.setdefault(roots.get(p, p), set()).add(p % 2**64)
    expected = {}
    for fp, root in slow_components([(p, p) for p in set(prints)]).items():
        expected.setdefault(root, set()).add(fp)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))


def test_any_five_positions_hold_a_set():
    from itertools import combinations

    for width in (3, 5):
        sets = [set(s) for s in simhash.position_sets(width)]
        assert all(any(s <= set(five) for s in sets) for five in combinations(range(8), 5))


def test_long_paths_connect(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (5, 5), (None, 3)], "a long, b long")
    roots = {r.node: r.root for r in components.connected(links).collect()}
    assert roots == {i: 0 for i in range(201)} | {900: 900, 901: 900} or roots == {i: 0 for i in range(1, 201)} | {901: 900}


def test_one_of_near_stays(awkward):
    kept = simhash.keep_one_of_near(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 3, 6, 7, 8, 9] and None in ids


def test_one_row_of_each_component_stays_whatever_the_ids(spark):
    words = [f"word{i}" for i in range(400)]
    page, other = " ".join(words), " ".join(reversed(words))
    edited = lambda text, i: text.replace(f"word{i} ", f"word{i}  ")
    bits = lambda text: (slow_print(text) ^ slow_print(page)).bit_count()
    changed = next(t for t in (page.replace(f"word{i} ", f"other{i} ") for i in range(400)) if 0 < bits(t) <= 3)
    rows = [
        (1, page), (1, edited(page, 7)), (1, changed), (2, edited(page, 9)), (2, "alone under a repeated id"), (3, other), (2, edited(other, 5)),
        (None, edited(other, 8)), (None, "a null id alone"), (None, "a null id alone"), (None, edited(page, 3)), (4, None), (4, ""),
    ]
    roots = slow_components([(i, slow_print(t)) for i, (_, t) in enumerate(rows)])
    groups = {}
    for row in rows:
        groups.setdefault(roots[slow_print(row[1])], []).append(row)
    assert len(groups) == 5
    rank = lambda r: (r[0] is None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest())
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as print", "2 as order").repartition(3)
    kept = simhash.keep_one_of_near(frame)
    assert kept.columns == frame.columns
    found = Counter((r.doc_id, r.text or "") for r in kept.collect())
    assert found == Counter((i, t or "") for i, t in (min(g, key=rank) for g in groups.values()))

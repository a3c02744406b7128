"""The similarity join against brute force, and its entries against all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from ticketmill.llm import jaccard


def edited(rng, own, share, vocabulary):
    return [rng.choice(vocabulary) if rng.random() < share else w for w in own]


def texts(seed=3):
    """Copies with few and many edits, a passage that most texts hold, short texts and odd ones."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=40)
    out = list(plain.ODD_TEXTS)
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.choice([4, 8, 12, 40, 90])) + passage * rng.randint(0, 1)
        out += [" ".join(edited(rng, base, share, vocabulary)) for share in (0, 0, 0.005, 0.01, 0.02, 0.04)]
        out.append(" ".join(base[: len(base) * 9 // 10]).upper())
    return out


@pytest.mark.parametrize(("width", "similarity"), [(5, 80), (1, 60)])
def test_components_equal_brute_force(spark, width, similarity):
    rows = [(None if i % 17 == 5 else i, t) for i, t in enumerate(texts())] + [(3, None), (20, "again"), (20, "again")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, s string, n int")
    found = jaccard.jaccard_join(docs, width, similarity)
    assert found.columns == ["doc_id", "s", "n", "n_shingles", "component_id"]
    own = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect())
    assert own == Counter(plain.jaccard_components(rows, width, similarity))
    assert {(r["s"], r["n"]) for r in found.collect()} == {("x", 1)}


def test_empty_table_and_no_links(spark):
    docs = spark.createDataFrame([(1, "one two three four five six"), (2, None)], "doc_id bigint, text string")
    assert jaccard.jaccard_join(docs.filter("false")).collect() == []
    assert {tuple(r) for r in jaccard.jaccard_join(docs).collect()} == {(1, 2, 1), (2, 0, 2)}


def test_chunks_of_a_frequent_entry_meet_each_other(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", 3)
    monkeypatch.setattr(jaccard, "GROUP_TOKENS", 150)
    rows = list(enumerate(texts(8)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = Counter(tuple(r) for r in jaccard.jaccard_join(docs, 4, 85).collect())
    assert found == Counter(plain.jaccard_components(rows, 4, 85))


@pytest.mark.parametrize("classes", [((256, 4096), (300, 60)), ((3, 8), (10_000, 10_000)), ((2, 3), (50, 10_000))])
def test_similar_sets_share_an_entry_that_keeps_them(monkeypatch, classes):
    monkeypatch.setattr(jaccard, "CLASS_FROM", classes[0])
    monkeypatch.setattr(jaccard, "CLASS_SIZES", classes[1])
    rng, similarity, sets = random.Random(5), 80, []
    universe = [rng.getrandbits(64) for _ in range(400)]
    common = universe[:30]
    for _ in range(60):
        base = set(rng.sample(universe, rng.randint(6, 60))) | set(rng.sample(common, rng.randint(0, 30)))
        for _ in range(4):
            own = {x for x in base if rng.random() > 0.05} | {rng.getrandbits(64) for _ in range(rng.randint(0, 3))}
            sets.append(np.array(sorted(own), np.uint64))
    heads = []
    for s in sets:
        n, q = len(s), int((s < jaccard.COUNTED).sum())
        heads.append((n, q, s[: max(q, min(n, jaccard.missing(n, similarity) + 4))]))
    held = Counter(t for _, _, h in heads for t in h.tolist())
    index = defaultdict(list)
    for k, (n, q, head) in enumerate(heads):
        idx = np.array([i for i, t in enumerate(head.tolist()) if held[t] > 1], int)
        counts = np.array([held[t] for t in head[idx].tolist()], int)
        for entry, reach in jaccard.entries(k, n, q, head[idx].view(np.int64), counts, idx, similarity):
            for e, r in zip(entry.tolist(), reach.tolist()):
                index[e].append((k, r))
    met = set()
    for rows in index.values():
        for k, r in rows:
            for other, left in rows:
                need = -(-similarity * (len(sets[k]) + len(sets[other])) // (100 + similarity))
                if other < k and min(r, left) >= need:
                    met.add((other, k))
    links = 0
    for k, a in enumerate(sets):
        for other, b in enumerate(sets[:k]):
            both = len(np.intersect1d(a, b))
            if 100 * both >= similarity * (len(a) + len(b) - both) and not np.array_equal(a, b):
                links += 1
                assert (other, k) in met
    assert links > 50


def test_filter_passes_all_values(spark):
    values = spark.range(0, 200_000, 7).select(F.col("id").alias("v"))
    test = jaccard.possible(values, "v")
    assert values.filter(test).count() == values.count()
    others = spark.range(10**9, 10**9 + 10_000).select(F.col("id").alias("v"))
    assert others.filter(test).count() < 200


@pytest.mark.parametrize("chunks", [1, 3])
def test_links_of_a_group_connect_all_similar_sets(chunks):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(90)]
    sets = []
    for _ in range(80):
        own = {x for x in base if rng.random() > rng.choice([0.02, 0.15])} | {rng.choice(base[:5]) ^ 1, rng.getrandbits(64)}
        sets.append(sorted(own))
    group = [rng.randrange(chunks) for _ in sets]
    links = []
    for i in range(chunks):
        for j in range(i, chunks):
            part = [k for k, c in enumerate(group) if c in (i, j)]
            tokens = np.array([t for k in part for t in sets[k]], np.uint64)
            sizes, own = np.array([len(sets[k]) for k in part]), np.array([group[k] for k in part])
            links += [(part[x], part[y]) for x, y in jaccard.linked_in_group(sizes, own, tokens, 80)]

    def components(pairs):
        parent = list(range(len(sets)))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for x, y in pairs:
            parent[root(x)] = root(y)
        return [root(x) for x in range(len(sets))]

    def similar(a, b):
        both = len(set(a) & set(b))
        return 100 * both >= 80 * (len(a) + len(b) - both)

    real = [(x, y) for x in range(len(sets)) for y in range(x) if similar(sets[x], sets[y])]
    assert set(links) <= set(real) and len(links) < len(real)
    found, wanted = components(links), components(real)
    assert len(set(zip(found, wanted))) == len(set(found)) == len(set(wanted))


def test_only_rows_of_several_chunks_are_dealt_out(spark):
    rows = spark.range(60).select(F.col("id").alias("s"), F.when(F.col("id") < 40, 1).otherwise(3).alias("chunks"))
    dealt = [tuple(r) for r in jaccard.dealt_out(rows).select("s", "own", "i", "j").collect()]
    assert sorted(r for r in dealt if r[0] < 40) == [(s, 0, 0, 0) for s in range(40)]
    many = [r for r in dealt if r[0] >= 40]
    assert all(own in (i, j) and i <= j for _, own, i, j in many)
    own = {s: c for s, c, _, _ in many}
    met = {(x, y) for x, _, *g in many for y, _, *h in many if g == h}
    assert len(many) == 60 and set(own.values()) == {0, 1, 2} and len(met) == 400


def test_tables_of_tokens_go_once_entries_are_written(spark, monkeypatch):
    written = []
    monkeypatch.setattr("ticketmill.llm.storage._written", written)
    docs = spark.createDataFrame(list(enumerate(texts(4)[:12])), "doc_id bigint, text string")
    jaccard.jaccard_join(docs, 4, 85).collect()
    names = {path.split("/llm-")[1].rsplit("-", 1)[0] for path in written}
    assert {"rows", "set-names", "entries"} <= names and not {"token-sets", "sets"} & names

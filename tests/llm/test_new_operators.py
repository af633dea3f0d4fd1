"""Hard negatives, SimHash and the prefix trie against brute force, on odd rows and on none."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from termtide.llm import hard_negatives, prefix_trie, simhash

# --- hard negatives -------------------------------------------------------------


def brute_negatives(rows):
    taking = []
    for vec_id, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        taking.append((vec_id, label, [math.floor(256 * x) for x in v]))
    out = []
    for a in taking:
        if a[0] is None or a[0] % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a[2], c[2])), c[0] is None, c[0] or 0, c[0], c[1])
            for c in taking
            if c is not a and len(c[2]) == len(a[2])
        ]
        scored.sort(key=lambda t: t[:3])
        for p in [t for t in scored if t[4] == a[1]][:5]:
            fits = [t for t in scored if t[4] != a[1] and 30 * -p[0] <= 100 * -t[0] <= 90 * -p[0]]
            out += [(a[0], p[3], rank, n[3], -p[0], -n[0]) for rank, n in enumerate(fits[:10], 1)]
    return sorted(out, key=repr)


def vectors(n: int = 700, dim: int = 8):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((12, dim))
    rows = []
    for i in range(n):
        v = centres[i % 12] + 0.4 * rng.standard_normal(dim)
        rows.append((i, int(rng.integers(10)), (v / np.linalg.norm(v)).tolist()))
    rows += [(1000 + i, rows[i % 30][1], rows[i % 30][2]) for i in range(120)]  # ties
    rows += [(2000, None, [0.5] * dim), (2100, 3, None), (2200, 3, [float("nan")] * dim), (2300, 3, [None] * dim)]
    rows += [(None, 4, rows[5][2]), (2400, 4, [0.0] * dim), (2500, 2, [1.0, 0.5]), (2501, 2, [0.9, 0.4]), (2502, 3, [0.5, 0.2])]
    rows += [(2600, 2, []), (2601, 2, []), (2602, 5, []), (2700, 6, (30 * np.array(rows[6][2])).tolist()), (101, 6, rows[6][2])]
    return rows


SCHEMA = "vec_id long, label int, embedding array<double>, place string, dim int, number string"


def negatives(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in hard_negatives.hard_negatives(df).collect()), key=repr)


def test_hard_negatives_of_odd_vectors(spark):
    rows = vectors()
    expected = brute_negatives(rows)
    assert len(expected) > 100
    assert negatives(spark, rows) == expected


def test_small_pages_and_samples_change_nothing(spark, monkeypatch):
    rows = vectors()
    for name, value in (("PAGE", 40), ("LEAF", 8), ("SAMPLE", 60), ("SAMPLE_LEAF", 6), ("FANOUT", 4), ("ANCHOR_BLOCK", 3)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert negatives(spark, rows) == brute_negatives(rows)


def test_ranges_pass_over_subtrees():
    """On clustered rows a narrow annulus leaves few of the leaves."""
    rng = np.random.default_rng(5)
    centres = 40 * rng.standard_normal((16, 6))
    x = np.floor(256 * (centres[rng.integers(16, size=4000)] + rng.standard_normal((4000, 6))))
    most = float(np.einsum("ij,ij->i", x, x).max())
    tree = hard_negatives.Tree(hard_negatives.lifted(x, most), np.arange(len(x)), 64, [0, 0])
    q = x[:20]
    score = hard_negatives.products(q, x)
    low, high = np.sort(score, axis=1)[:, -20], score.max(axis=1)
    inner, outer = hard_negatives.annulus(q, most, low, high)
    points = np.concatenate((q, np.zeros((20, 1))), axis=1)
    seen = defaultdict(set)
    for leaf, alive in tree.visit(points, inner, outer, np.arange(20), 1e-3):
        for a in alive:
            seen[a] |= set(leaf.rows.tolist())
    for a in range(20):
        assert set(np.flatnonzero((score[a] >= low[a]) & (score[a] <= high[a])).tolist()) <= seen[a]
    assert sum(map(len, seen.values())) < 0.5 * 20 * len(x)


def test_large_components_are_exact():
    a = np.full((2, 4), float(1 << 39))
    assert hard_negatives.products(a, a)[0, 0] == hard_negatives._HIGH
    b = np.array([[float((1 << 30) + 1), 1.0]])
    assert hard_negatives.products(b, b)[0, 0] == ((1 << 30) + 1) ** 2 + 1


def test_no_hard_negatives(spark):
    assert negatives(spark, []) == []


# --- simhash --------------------------------------------------------------------


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(rows, fps):
    nodes = sorted(set(fps))
    root = {f: f for f in nodes}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    least = {}
    for (doc_id, *_), f in zip(rows, fps):
        if doc_id is not None:
            least[find(f)] = min(least.get(find(f), doc_id), doc_id)
    return [least.get(find(f)) for f in fps]


def test_simhash_of_odd_documents(spark, odd, odd_rows):
    fps = [brute_fingerprint(r[1]) for r in odd_rows]
    expected = sorted(
        ((r[0], f"{f:016x}", c) for r, f, c in zip(odd_rows, fps, brute_components(odd_rows, fps))), key=repr
    )
    assert sorted((tuple(r) for r in simhash.simhash_copies(odd).collect()), key=repr) == expected


@pytest.mark.parametrize("place", [4096, 64])
def test_near_fingerprints_in_crowded_places(spark, monkeypatch, place):
    """Values that agree in most bits: with small places nearly all are dealt out twice."""
    monkeypatch.setattr(simhash, "PLACE", place)
    rng = random.Random(7)
    values = {rng.getrandbits(64) for _ in range(200)}
    for seed in rng.sample(sorted(values), 6):
        for _ in range(150):
            v = seed
            for _ in range(rng.randint(1, 5)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
        values |= {seed ^ (d << 8) for d in range(0, 256, 3)}
    values = sorted(values)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    df = spark.createDataFrame(signed, "fp long")
    places = simhash._places(df).repartition(*simhash._KEY).sortWithinPartitions(*simhash._KEY, "fp")
    links = places.select(*simhash._KEY, "fp").mapInArrow(simhash._linker, "a long, b long").collect()
    mask = (1 << 64) - 1
    rows = [(i,) for i in range(len(values))]
    expected = brute_components(rows, values)
    number = {v: i for i, v in enumerate(values)}
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(number[a & mask]), find(number[b & mask])
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(values))] == expected


def test_pairs_of_bit_planes():
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = [rng.choice(base) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(700)]
    fps = np.array(fps, np.uint64)
    ends = np.sort(np.random.default_rng(1).choice(np.arange(1, 700), 20, replace=False))
    ends = np.concatenate((ends, [700]))
    end = ends[np.searchsorted(ends, np.arange(700), "right")]
    got = {(int(i), int(j)) for a, b in simhash.near_pairs(fps, end) for i, j in zip(a, b)}
    expected = {
        (i, j)
        for i in range(700)
        for j in range(i + 1, int(end[i]))
        if bin(int(fps[i]) ^ int(fps[j])).count("1") <= 2
    }
    assert got == expected and len(got) > 30


def test_no_simhash(spark, none):
    assert simhash.simhash_copies(none).count() == 0


# --- prefix trie ----------------------------------------------------------------


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        extra = (len(convs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += extra
            leaves[path[:d]] += children[path] == 0
    out = []
    for path, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(full[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(path), parent, len(convs), children[path], leaves[path], saved[path], sha))
    return sorted(out, key=repr)


def talks():
    rng = random.Random(9)
    turns = [("user", "hi there"), ("assistant", "hello, how can I help"), (None, "x"), ("user", None), ("system", "be kind  to all")]
    rows = []
    for c in [*range(0, 130), 200, 221, 399, 400, -5, -40]:
        n = rng.choice([1, 1, 2, 3, 4, 6, 9])
        conv = [rng.choice(turns) for _ in range(n)]
        if rng.random() < 0.4:
            conv = turns[: rng.randint(1, 5)]
        rows += [(c, None if rng.random() < 0.05 else i, role, text) for i, (role, text) in enumerate(conv)]
    rows += [(500 + c, i, *turns[i % 3]) for c in range(60) for i in range(7)]  # one conversation many times
    rows += [(700, i // 3, *turns[i % 4]) for i in range(150)] + [(701, i // 3, *turns[i % 4]) for i in range(140)]
    rows += [(740, 1, "user", "y")] * 9 + [(None, 0, "user", "of no conversation"), (None, None, None, None)]
    rng.shuffle(rows)
    return rows


def trie_rows(spark, rows):
    df = spark.createDataFrame(
        [(*r, 1, "x", 2) for r in rows], "conv_id long, turn long, role string, text string, block int, id string, ids long"
    )
    return sorted((tuple(r) for r in prefix_trie.trie(df.repartition(4)).collect()), key=repr)


@pytest.mark.parametrize(
    "sizes",
    [{}, {"SHARD_CELLS": 60, "CELLS": 40, "TURNS_PER_RANGE": 50, "IDS_PER_CHUNK": 7}, {"WIDTH": 3, "CELLS": 25, "SHARD_CELLS": 90}],
)
def test_trie_of_odd_conversations(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(prefix_trie, name, value)
    rows = talks()
    assert trie_rows(spark, rows) == brute_trie(rows)


def test_no_trie(spark):
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(None, 1, "user", "x")]) == []

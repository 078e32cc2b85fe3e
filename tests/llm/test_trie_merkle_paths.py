"""Prefix trie, Merkle manifest and chosen-path join against plain versions, on rows with every odd case."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import chosenpath, merkle, trie
from feedloom.llm.common import prefix_sums

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_trie(rows):
    own = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))

    def place(v):
        return v[0], v[1], hashlib.md5(f"{len(v[2].encode())}:{v[2]}{v[3]}".encode()).hexdigest()

    turns = {c: [(r, x) for _, _, r, x in sorted(v, key=place)] for c, v in own.items()}
    built = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    nodes = collections.defaultdict(list)
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
    kids = collections.Counter(n[:-1] for n in nodes if n)
    leaves, saved = collections.Counter(), collections.Counter()
    for n, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(members) - 1) * words
            leaves[n[:d]] += n not in kids
    return sorted(
        (
            (
                min(m), len(n), min(nodes[n[:-1]]) if n else None, len(m), kids[n], leaves[n], saved[n],
                digest(",".join(map(str, sorted(c for c in m if len(built[c]) == len(n))))),
            )
            for n, m in nodes.items()
        ),
        key=str,
    )


@pytest.fixture(scope="module")
def turns(spark):
    draw = random.Random(3)
    rows = []
    for c in [*range(-30, 300), None]:
        hot = c is not None and c % 3 == 0  # a third of all conversations are one
        for t in range(90 if c == 44 else 4 if hot else draw.choice([1, 2, 3, 5])):
            if hot:
                rows.append((c, t, "user", f"hot {t} turn", "x"))
            else:
                text = draw.choice(["a b", "a", "", None, "c  d\te"])
                rows.append((c, draw.choice([t, t, t, None]), draw.choice(["user", "bot", None]), text, "x"))
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, path string").repartition(5)


@pytest.mark.parametrize("shards", ["8", "40"])
def test_trie_equals_plain(spark, turns, shards):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        found = trie.prefix_trie(trie.with_borrowed_heads(trie.conversations(turns)))
        got = sorted((tuple(r) for r in found.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == plain_trie([tuple(r)[:4] for r in turns.collect()])


def test_trie_of_nothing_and_of_turnless_conversations(spark, turns):
    convs = trie.conversations(turns.limit(0))
    assert trie.prefix_trie(convs).count() == 0
    bare = trie.conversations(turns.limit(1)).withColumns({"conv_id": F.lit(5).cast("long"), "turns": F.slice("turns", 1, 0)})
    assert [tuple(r) for r in trie.prefix_trie(bare).collect()] == [(5, 0, None, 1, 0, 1, 0, digest("5"))]
    named = turns.withColumn("conv_id", F.lit("no number"))
    assert trie.conversations(named).count() == 0


def test_crowded_end_is_hashed_in_chunks(monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 3)
    walk = trie._Walk({b"": 0, b"a" * 16: 1})
    for c in range(10):
        walk.add(b"a" * 16, c, [2])
    walk.end()
    rows = walk.take()
    ends = rows[rows["kind"] == trie.ENDS]
    assert len(ends) == 4
    assert list(trie._hash_ends(iter([ends])))[0]["ends_sha256"][0] == digest(",".join(map(str, range(10))))


def plain_manifest(rows):
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([digest(*levels[-1][k : k + 16]) for k in range(0, len(levels[-1]), 16)])
        return levels

    def way(levels, i):
        out = []
        for level in levels[:-1]:
            k = i // 16 * 16
            out.append((level[k:i], level[i + 1 : k + 16]))
            i //= 16
        return out

    leaf = [digest(*[enc(x) for x in (d, s, lang, n, t)]) for d, t, lang, s, n in rows]
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[r[3]].append(i)
    trees, at = {}, {}
    for g, members in groups.items():
        members.sort(key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf[i]))
        at.update({i: k for k, i in enumerate(members)})
        trees[g] = tree([leaf[i] for i in members])
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for i, (d, t, lang, s, n) in enumerate(rows):
        path = way(trees[s], at[i]) + way(top, order.index(s))
        folded = leaf[i]
        if d is not None and t is not None and zlib.crc32(str(d).encode()) % 5 == 0:
            low = t.translate({ord(c): c.lower() for c in CAPITALS})
            folded = digest(*[enc(x) for x in (d, s, lang, n, low)])
        for left, right in path:
            folded = digest(*left, folded, *right)
        proof = digest(*[x for left, right in path for x in left + right])
        out.append((d, leaf[i], trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def manifest_of(docs):
    return merkle.manifest(
        docs, ["doc_id", "source", "lang", "n_chars", "text"],
        tampered={"text": F.translate("text", CAPITALS, CAPITALS.lower())},
        suspect=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
    )


def test_manifest_equals_plain(spark):
    draw = random.Random(1)
    sources = [None, "", "a", "b", "é", "a", "a", *[f"s{k}" for k in range(20)]]
    rows = []
    for i in range(1500):  # dense, negative, scattered, repeated and absent ids
        doc = draw.choice([i, i, i, -i, i * 70_001, None if i % 3 == 0 else i, 5, i * 64])
        rows.append((doc, draw.choice([None, "", f"Text Ä{i}", "low"]), "en", draw.choice(sources), i))
    rows += rows[:5] + [(10**6, "Long " * 200_000, None, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({"key": F.lit(1), "leaf": F.lit("x"), "place": F.lit(2), "id": F.lit(3)}).repartition(4)
    assert sorted((tuple(r) for r in manifest_of(docs).collect()), key=str) == plain_manifest(rows)
    assert manifest_of(docs.limit(0)).count() == 0
    (one,) = manifest_of(docs.where("doc_id = 1000000")).collect()
    assert one.leaf == one.root == one.subroot and one.proof_sha256 == digest()


def test_prefix_sums(spark):
    rows = [(i * 7 % 50, i) for i in range(50)]
    got = prefix_sums(spark.createDataFrame(rows, "k long, v long"), ["k"], "v", "before").collect()
    assert {(r.k, r.before) for r in got} == {(k, sum(v for j, v in rows if j < k)) for k, _ in rows}


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def plain_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = collections.defaultdict(list)
    for i, own in enumerate(sets):
        shared = collections.Counter(j for g in own for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                root[find(i)] = find(j)
        for g in own:
            holders[g].append(i)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = low.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def test_chosen_paths_equal_plain(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    texts = []

    def changed(base, times):
        out = list(base)
        for _ in range(times):
            out[draw.randrange(len(out))] = draw.choice(words)
        return " ".join(out)

    crowd = draw.choices(words, k=120)
    texts += [changed(crowd, draw.randint(0, 4)) for _ in range(120)]  # one large group, not all of it linked
    for _ in range(30):
        base = draw.choices(words, k=draw.randint(4, 200))
        texts += [changed(base, draw.randint(0, 3)) for _ in range(draw.randint(1, 6))]
    texts += [" ".join(words[:40] + draw.choices(words, k=60)) for _ in range(100)]  # a passage that many share
    rows = [*enumerate(texts), *[(9000 + i, t) for i, t in enumerate(["", None, "a b", "A  b", " \n", "x", "x"])]]
    rows += [(None, "a b"), (None, " ".join(crowd)), (3, " ".join(crowd)), (None, None), (None, "a text of nobody at all"), (9005, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({"n": F.lit(1), "set": F.lit(2), "root": F.lit(3), "id": F.lit(4), "t1": F.lit(5)}).repartition(4)
    got = sorted((tuple(r) for r in chosenpath.components(docs).collect()), key=str)
    expected = plain_components(rows)
    assert got == expected
    kept = chosenpath.keep_one(docs)
    assert kept.columns == docs.columns
    dropped = {d for d, _, _, k in expected if not k}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in rows if d not in dropped)
    assert chosenpath.components(docs.limit(0)).count() == 0


def test_trees_meet_pairs_at_the_threshold():
    draw = np.random.default_rng(7)
    missed = low = 0
    for _ in range(400):
        both, rest = draw.integers(0, 1 << 63, 80), draw.integers(0, 1 << 63, (2, 10))
        a, b = (chosenpath.minhash(np.unique(np.r_[both, r]).astype(np.uint64)) for r in rest)
        missed += not (a == b)[: chosenpath.trees_for(chosenpath.RECALL)].any()
        low += (a == b).mean() < chosenpath.AGREE
    assert missed == 0 and low == 0


def test_tiles_of_a_crowd_give_all_near_pairs_of_two_classes(spark, monkeypatch):
    monkeypatch.setattr(chosenpath, "TILE", 16)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, chosenpath.COORDINATES, dtype=np.uint8)
    sets, members = [], []
    for i in range(120):
        mins = np.where(rng.random(chosenpath.COORDINATES) < 0.15, rng.integers(0, 256, chosenpath.COORDINATES), base)
        sets.append((i, 80 + i % 30, bytearray(mins.astype(np.uint8).tobytes())))
        members.append((i % 2, i, i if i % 3 else 0, 0))  # every third set is of the main class
    made = spark.createDataFrame(sets, "set long, n long, bits binary")
    crowd = spark.createDataFrame(members, "crowd long, set long, root long, low long")
    got = {tuple(r) for r in chosenpath._crowd_pairs(crowd, made, 80).collect()}
    wanted = set()
    for (c, i, root, _), (d, j, other, _) in ((x, y) for x in members for y in members if x[1] < y[1]):
        (_, n, x), (_, m, y) = sets[i], sets[j]
        alike = np.mean(np.frombuffer(bytes(x), np.uint8) == np.frombuffer(bytes(y), np.uint8)) >= chosenpath.AGREE
        if c == d and root != other and alike and 100 * min(n, m) >= 80 * max(n, m):
            wanted.add((i, j))
    assert got == wanted and wanted
    assert chosenpath._crowd_pairs(crowd.limit(0), made, 80).isEmpty()

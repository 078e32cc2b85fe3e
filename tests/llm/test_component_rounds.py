"""Work that grows with a crowd of near copies: rounds of the components, comparisons with pivots."""

import random

from pyspark.sql import functions as F

from feedloom.llm import chosenpath, components


def test_stars_need_no_further_round(spark, monkeypatch):
    rounds = []
    step = components._large_star
    monkeypatch.setattr(components, "_large_star", lambda links: rounds.append(1) or step(links))
    stars = spark.createDataFrame([(a, a % 3) for a in range(3, 300)], "a LONG, b LONG")
    assert {tuple(r) for r in components.connected(stars).collect()} == {(n, n % 3) for n in range(300)}
    assert not rounds
    assert components.connected(stars.limit(0)).isEmpty() and not rounds


def test_components_equal_brute_force(spark):
    draw = random.Random(5)
    for nodes, links in ((40, 25), (200, 190), (30, 200)):
        pairs = [(draw.randrange(nodes), draw.randrange(nodes)) for _ in range(links)] + [(n, n + 1) for n in range(nodes, nodes + 50)]
        root = {n: n for pair in pairs for n in pair if pair[0] != pair[1]}
        for _ in root:
            for a, b in pairs:
                if a != b:
                    root[a] = root[b] = min(root[a], root[b])
        frame = spark.createDataFrame(pairs, "a LONG, b LONG")
        assert {tuple(r) for r in components.connected(frame).collect()} == set(root.items())


def test_a_set_meets_a_pivot_once_for_all_its_nodes(spark, monkeypatch):
    draw = random.Random(8)
    words = [f"w{n}" for n in range(400)]
    texts = [" ".join(w if draw.random() < 0.97 else f"x{n}{at}" for at, w in enumerate(words)) for n in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    met, pairs = [], chosenpath._pairs

    def counted(rows):
        if rows.columns == ["a", "b"]:  # sets and pivots; sets of small nodes come with their node
            met.append((rows.count(), rows.distinct().count()))
        return pairs(rows)

    monkeypatch.setattr(chosenpath, "_pairs", counted)
    chosenpath.components(docs).agg(F.count("*")).collect()
    assert met and all(rows == distinct for rows, distinct in met)


def test_a_crowd_under_the_threshold_makes_no_row_of_a_pair(spark, monkeypatch):
    draw = random.Random(11)
    words = [f"w{n}" for n in range(400)]
    texts = [" ".join(w if draw.random() < 0.981 else f"x{n}{at}" for at, w in enumerate(words)) for n in range(150)]
    sets = [{tuple(t.split()[i : i + 4]) for i in range(397)} for t in texts]
    near, root = 0, list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            near += 100 * both >= 70 * (len(sets[a]) + len(sets[b]) - both)
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    assert near > 10 * len(texts) and 20 < len(set(root)) < 140
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    made, tiles = [], chosenpath._crowd_pairs

    def counted(*given):
        found = tiles(*given)
        made.append(found.count())
        return found

    monkeypatch.setattr(chosenpath, "_crowd_pairs", counted)
    got = {r.id: r.component_id for r in chosenpath.components(docs).collect()}
    assert got == dict(enumerate(root))
    assert made and sum(made) <= len(texts)

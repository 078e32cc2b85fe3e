"""Each operator against a plain version of itself, on rows with every odd case."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import Row
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm import components, decontamination, editprints, linededup, mixing, records, simhash, tokencounts, toxicity
from feedloom.llm.queries import LLM_ORACLES, LLM_QUERIES, tokenizer_path
from feedloom.llm.tokens import PieceEncoder
from feedloom.session import scratch_folder

SCHEMA = "doc_id long, text string, source string, fp long, key string, size long, lines string"
LONG = "\n".join(f"this is line number {i} of a long text" for i in range(400))
TEXTS = [
    (1, "The quick brown fox\njumps over the lazy dog\nshort\n", "a"),
    (2, "the QUICK brown fox  \nsomething else entirely here\nshort", "a"),
    (3, None, None),
    (4, "", "b"),
    (5, LONG, "b"),
    (6, LONG, "b"),
    (6, LONG, "b"),
    (7, "jumps over the lazy dog\njumps over the lazy dog", "é"),
    (7, "another text of the same id\nshort", "é"),
    (None, "jumps over the lazy dog\nno id here at all", "a"),
    (8, "   \n\t\n", "c"),
    (9, "<|endoftext|> don't  stop　now " * 30, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [Row(d, t, s, 7, "k", 3, "x") for d, t, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def test_line_dedup_equals_plain(docs, none):
    last = 1 << 62
    held = {}
    for d, t, _ in TEXTS:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(last if d is None else d)
    expected = []
    for d, t, _ in TEXTS:
        own = last if d is None else d
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or own == min(held[key(x)])]
        expected.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    for batches in (1, 3):
        found = linededup.drop_repeated_lines(docs, batches=batches, fanout=2)
        got = [(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in found.collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)
        assert found.columns[: len(docs.columns)] == docs.columns
    assert linededup.drop_repeated_lines(none).count() == 0


def named_badly(docs):
    """Further columns with names that helpers might use."""
    names = ["_o", "_t", "_s", "_g", "_n", "_z", "_at", "of_owner", "rows_of", "start", "target", "place", "owner", "kept_text", "copies"]
    return docs.withColumns({name: F.lit(name) for name in names})


def test_clashing_names_change_nothing(docs):
    plain = linededup.drop_repeated_lines(docs)
    odd = linededup.drop_repeated_lines(named_badly(docs))
    assert odd.columns[: len(named_badly(docs).columns)] == named_badly(docs).columns
    want = sorted((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in plain.fillna(-1, ["doc_id"]).collect())
    assert sorted((r[0], *r[-3:]) for r in odd.fillna(-1, ["doc_id"]).collect()) == want
    taken, odd = mixing.mix(docs), mixing.mix(named_badly(docs))
    assert all(r["owner"] == "owner" and r["target"] == "target" for r in odd.collect())
    assert sorted(map(str, (tuple(r[-4:]) for r in odd.collect()))) == sorted(map(str, (tuple(r[-4:]) for r in taken.collect())))


def test_runs_are_merged_as_they_lie(spark, docs):
    runs = linededup.LineRuns(spark, scratch_folder(spark, "test-runs"), fanout=9)
    k1, k2 = linededup.key_hash(linededup.line_key(F.col("text")))
    rows = docs.where("text IS NOT NULL").select(k1.alias("k1"), k2.alias("k2"), F.col("doc_id").alias("owner"))
    runs.absorb(rows)
    runs.absorb(rows)
    with linededup.runs_in_order(spark):
        plan = runs.unknown(rows)._jdf.queryExecution().executedPlan().toString()
    runs.close()
    # One exchange and one sort of the batch; both runs are read bucket by bucket in their order.
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_rows_without_id_spread_over_files(spark):
    rows = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN id END AS doc_id", "concat('text ', id) AS text")
    folder = scratch_folder(spark, "test-records")
    joined_up = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(joined_up)
    spark.conf.set(joined_up, "false")  # these rows would fit into one task
    try:
        manifest = records.write_records(rows, folder, tokenizer_path())
    finally:
        spark.conf.set(joined_up, before)
    assert manifest.agg(F.max("records")).first()[0] < 1000
    back = records.read_records(spark, folder).orderBy("start").collect()
    known = [r.id for r in back if r.id is not None]
    assert len(back) == 4000 and known == sorted(known) and all(r.id is None for r in back[:2000])


def test_runs_are_compacted(spark, docs):
    runs = linededup.LineRuns(spark, scratch_folder(spark, "test-runs"), fanout=2)
    seen = set()
    for batch in range(5):
        rows = spark.range(batch * 5, batch * 5 + 10).select(
            F.col("id").alias("k1"), F.lit(0).cast("long").alias("k2"), F.lit(batch).cast("long").alias("owner")
        )
        new = {r.k1 for r in runs.absorb(rows).collect()}
        assert new == set(range(batch * 5, batch * 5 + 10)) - seen
        seen |= new
        assert all(len(level) < 2 for level in runs.levels)
    runs.close()


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(b" ".join(p), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_plain(docs):
    got = docs.select("text", simhash.fingerprint("text").alias("p")).collect()
    assert all(r.p % (1 << 64) == plain_print(r.text) for r in got)


@pytest.mark.parametrize("busy", [simhash.BUSY, 2])
@pytest.mark.parametrize("bits", [0, 1, 2, 3, 5])
def test_near_pairs_lose_nothing(spark, bits, busy):
    draw = np.random.default_rng(5)
    values = [int(x) for x in draw.integers(0, 1 << 63, 20)]
    for v in list(values):
        for _ in range(6):
            flips = draw.choice(64, draw.integers(1, 7), replace=False)
            values.append(v ^ sum(1 << int(b) for b in flips))
    values = sorted({v - (1 << 64) if v >= 1 << 63 else v for v in values})
    expected = {
        (a, b) for a, b in itertools.combinations(values, 2) if 0 < ((a ^ b) % (1 << 64)).bit_count() <= bits
    }
    found = simhash.near_pairs(spark.createDataFrame([(v,) for v in values], "fp long"), bits, busy)
    assert {(r.a, r.b) for r in found.collect()} == expected


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 140)] + [(7, 7), (1, 0), (0, 1)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components.connected(frame).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}
    assert components.connected(frame.limit(0)).count() == 0


def test_simhash_groups_equal_plain(docs, none):
    prints = [(d, plain_print(t)) for d, t, _ in TEXTS]
    distinct = {p for _, p in prints}
    root = {p: p for p in distinct}
    for _ in distinct:
        for a, b in itertools.combinations(distinct, 2):
            if (a ^ b).bit_count() <= 3:
                root[a] = root[b] = min(root[a], root[b])
    low = {}
    for d, p in prints:
        if d is not None:
            low[root[p]] = min(d, low.get(root[p], d))
    got = [(r.id, r.component_id) for r in simhash.components(docs).collect()]
    assert sorted(got, key=str) == sorted([(d, low.get(root[p])) for d, p in prints], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({root[p] for p in distinct})
    assert simhash.components(none).count() == simhash.keep_one(none).count() == 0


def test_matches_equal_plain(spark, docs, none):
    items = spark.createDataFrame(
        [(1, "jumps over the lazy dog"), (2, "line number 7 of a LONG text\nthis is line number 8 of a long text"), (3, None),
         (4, "two words"), (5, "nowhere to be found in any of these texts at all"), (1, "something else entirely here short")],
        "item_id long, text string",
    )

    def shingles(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    expected = set()
    for d, t, _ in TEXTS:
        for r in items.collect():
            own = shingles(r.text)
            if own and len(own & shingles(t)) / len(own) >= 0.8:
                expected.add((d, r.item_id))
    got = decontamination.matches(docs, items)
    assert {(r.id, r.item_id) for r in got.collect()} == expected and expected
    clean = decontamination.decontaminate(docs, items)
    assert clean.columns == docs.columns
    dirty = {d for d, _ in expected}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(
        str(d) for d, t, _ in TEXTS if not any(
            (s := shingles(r.text)) and len(s & shingles(t)) / len(s) >= 0.8 for r in items.collect()
        )
    )
    assert dirty
    assert decontamination.matches(none, items).count() == decontamination.matches(docs, items.limit(0)).count() == 0


def test_long_items_are_met_by_sketch(spark, monkeypatch):
    draw = np.random.default_rng(8)
    words = [f"w{i}" for i in range(5000)]
    items = [(i, " ".join(draw.choice(words, 14 + i))) for i in range(40)]
    phrase = " ".join(items[0][1].split()[:6])
    docs = [(i, " ".join([*draw.choice(words, 300), *items[i % 40][1].split(), *draw.choice(words, 300)])) for i in range(60)]
    docs += [(100 + i, " ".join([*draw.choice(words, 50), phrase])) for i in range(40)]
    docs += [(200, " ".join([*draw.choice(words, 20_000), *items[7][1].split()])), (201, " ".join(items[9][1].split()[:9]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    held = spark.createDataFrame(items, "item_id long, text string")
    asked = []
    hashes = decontamination._hashes
    monkeypatch.setattr(decontamination, "_hashes", lambda text, words, whole: asked.append(whole) or hashes(text, words, whole))

    def shingles(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    expected = {(d, i) for d, t in docs for i, x in items if len(shingles(x) & shingles(t)) >= 0.8 * len(shingles(x))}
    assert {(r.id, r.item_id) for r in decontamination.matches(frame, held).collect()} == expected and len(expected) >= 61
    assert asked == [True, False]  # items whole, documents by sketch alone
    short = held.union(spark.createDataFrame([(77, "w1 w2"), (78, items[3][1])], held.schema))
    more = {(r.id, r.item_id) for r in decontamination.matches(frame, short).collect()}
    assert more == expected | {(d, 78) for d, i in expected if i == 3}


def test_sketch_finds_short_items_in_long_texts():
    draw = np.random.default_rng(1)
    missed = 0
    for _ in range(300):
        text = draw.integers(0, 1 << 63, 30_000).astype(np.uint64)
        item = text[5:14]
        missed += not np.isin(item, decontamination.sketch(np.unique(text))).any()
    assert missed == 0


def test_mixing_targets_and_copies(spark, docs, none):
    draw = np.random.default_rng(3)
    rows = [(i, "w " * int(draw.integers(1, 200)), "abcdefg"[min(6, int(draw.exponential(1.5)))]) for i in range(4000)]
    rows += [(i, None, None) for i in range(3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.mix(frame, size_col=None).toPandas()
    sizes = taken.groupby("source", dropna=False)["size"].sum()
    order = sorted([s for s in sizes.index if isinstance(s, str)]) + [s for s in sizes.index if not isinstance(s, str)]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sizes.sum())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 3 * sizes[s] < level * weight[s]}
        if not full:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    for s in order:
        own = taken[taken["source"].isna()] if not isinstance(s, str) else taken[taken["source"] == s]
        assert np.allclose(own["target"], target[s])
        assert own["copies"].between(0, 3).all()
        assert abs((own["copies"] * own["size"]).sum() - target[s]) <= max(400, 0.02 * target[s])
    again = mixing.mix(frame.repartition(7)).toPandas().sort_values("doc_id")["copies"]
    assert again.tolist() == taken.sort_values("doc_id")["copies"].tolist()
    assert mixing.mixed_rows(docs).columns == docs.columns
    assert mixing.mixed_rows(none).count() == 0


def test_counts_and_ids_equal_the_library(docs):
    library = Tokenizer.from_file(tokenizer_path())
    draw = np.random.default_rng(2)
    alphabet = [*" \n\t.,'abcSé19<|>$—　", "<|endoftext|>", "'s", " the", "\n\n", ".\n", "aaaa", "thth"]
    texts = ["".join(draw.choice(alphabet, draw.integers(0, 14))) for _ in range(3000)]
    ids = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in PieceEncoder(tokenizer_path(), keep=500).encode(texts)] == ids
    assert tokencounts.TokenCounter(tokenizer_path(), keep=500).count(texts) == [len(x) for x in ids]
    got = docs.select("text", tokencounts.token_count("text", tokenizer_path()).alias("n")).collect()
    assert all(r.n == len(library.encode(r.text or "", add_special_tokens=False).ids) for r in got)


def test_records_round_trip(spark, docs, none):
    library = Tokenizer.from_file(tokenizer_path())
    folder = scratch_folder(spark, "test-records")
    records.write_records(docs, folder, tokenizer_path())
    back = records.read_records(spark, folder).collect()
    got = sorted((r.start, r.id, np.frombuffer(r.ids, "<u4").tolist()) for r in back)
    assert [x[1] for x in got] == sorted([d for d, _, _ in TEXTS], key=lambda d: -1 if d is None else d)
    at = 0
    for start, _, ids in got:
        assert start == at
        at += len(ids)
    texts = sorted(library.encode(t or "", add_special_tokens=False).ids + [0] for _, t, _ in TEXTS)
    assert sorted(x[2] for x in got) == texts
    one = back[5]
    doc, ids = records.read_at(folder, one.file, one.record)
    assert doc == one.id and ids.tolist() == np.frombuffer(one.ids, "<u4").tolist()
    empty = scratch_folder(spark, "test-records")
    records.write_records(none, empty, tokenizer_path())
    assert records.read_records(spark, empty).count() == 0


def test_damaged_record_is_refused():
    import io

    data = bytearray(records.frame(b"payload"))
    assert list(records.payloads(io.BytesIO(bytes(data)))) == [b"payload"]
    data[14] ^= 1
    with pytest.raises(ValueError):
        list(records.payloads(io.BytesIO(bytes(data))))
    with pytest.raises(ValueError):
        list(records.payloads(io.BytesIO(records.frame(b"payload")[:-2])))


def test_edit_prints_equal_plain(spark, docs, none):
    rows = [(i, f"text {i} " * (i % 7)) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.id: r for r in editprints.compare_with_edits(frame, ranges=7).collect()}
    ordered = rows[::-1]
    for i, (d, t) in enumerate(ordered):
        other = ordered[(i + 1) % len(ordered)][1]
        edited = t[: len(t) - len(t) // 2] + other[: len(t) // 2]
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        pair = editprints.prints([t, edited, other])
        assert [got[d].fingerprint, got[d].edited_fingerprint] == editprints.to_text(pair[:2])
        assert got[d].near_next == pytest.approx(editprints.likeness(pair[:1], pair[2:])[0])
    assert editprints.compare_with_edits(docs).count() == len(TEXTS)
    one = editprints.compare_with_edits(frame.where("doc_id = 3")).first()
    assert one.near_next == 1.0
    assert editprints.compare_with_edits(none).count() == 0


def test_edits_keep_prints_near(spark):
    draw = np.random.default_rng(4)
    texts = ["".join(draw.choice(list("abcdefgh "), 2000)) for _ in range(40)]
    changed = [t[:1000] + "zz" + t[1001:] for t in texts]
    own, near = editprints.in_slices(texts), editprints.in_slices(changed)
    assert np.median(editprints.likeness(own, near)) > 0.8
    assert editprints.likeness(own, np.roll(near, 1, axis=0)).max() < 0.5
    frame = spark.createDataFrame([(t,) for t in texts + changed], "text string").select(
        editprints.fingerprint("text").alias("fingerprint")
    )
    groups = editprints.similar_groups(frame)
    assert groups.select("group").distinct().count() < 60


def test_similar_groups_keep_every_link_of_a_bucket(spark):
    draw = np.random.default_rng(11)
    base = draw.integers(0, 16, 128)
    family = np.tile(base, (300, 1))
    for row, n in zip(family, draw.integers(4, 24, 300), strict=True):
        row[draw.choice(128, n, replace=False)] = draw.integers(0, 16, n)
    values = np.unique(np.r_[family, draw.integers(0, 16, (20, 128))], axis=0).astype(np.uint8)
    names = editprints.to_text(values)
    # The rule itself, without Spark: all pairs of each bucket, whole fingerprints decide.
    frame = spark.createDataFrame([(n,) for n in names], "fingerprint string").repartition(5)
    buckets = {}
    for r in frame.select("fingerprint", editprints._bands("fingerprint")).collect():
        buckets.setdefault((r.band, r.key), []).append(names.index(r.fingerprint))
    root = list(range(len(names)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in {p for members in buckets.values() for p in itertools.combinations(sorted(members), 2)}:
        if editprints.likeness(values[i : i + 1], values[j : j + 1])[0] >= editprints.NEAR:
            root[find(i)] = find(j)
    expected = {}
    for i, name in enumerate(names):
        expected.setdefault(find(i), set()).add(name)
    for tile in (editprints.TILE, 7):
        got = {}
        for r in editprints.similar_groups(frame, tile=tile).collect():
            got.setdefault(r.group, set()).add(r.fingerprint)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))
    assert editprints.similar_groups(frame.limit(0)).count() == 0


def test_toxicity_learns_and_scores(spark, docs, none):
    draw = np.random.default_rng(6)
    plain = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(1500):
        words = list(draw.choice(plain, 40))
        bad = i % 5 == 0
        if bad:
            words[3:3] = ["you", "absolute", draw.choice(["moron", "idiot", "scum"])]
        rows.append((i, " ".join(words), int(bad)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = frame.select("doc_id", "toxic").where("doc_id < 1000")
    learn = toxicity.labelled_sample(frame.drop("toxic"), labels, max_rows=800)
    assert learn.count() == 800
    model = toxicity.Model(toxicity.fit(learn))
    assert model.size < 2000
    scored = frame.where("doc_id >= 1000").withColumn("s", model.score("text")).collect()
    assert np.mean([(r.s >= 0.3) == bool(r.toxic) for r in scored]) > 0.97
    assert all(0 <= r.s <= 1 for r in docs.select(model.score("text").alias("s")).collect())
    kept = toxicity.reject_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS)
    blank = toxicity.Model(toxicity.fit(learn.limit(0)))
    assert toxicity.reject_toxic(docs, blank).count() == len(TEXTS)
    assert toxicity.reject_toxic(none, model).count() == 0


def test_query_names():
    numbers = {int(n[2:].split("_")[0]) for n in LLM_QUERIES if n.startswith("op")}
    assert numbers == set(range(1, 14))
    assert set(LLM_ORACLES) <= set(LLM_QUERIES)
    assert zlib.crc32(b"1") % 4 in range(4)


def test_backoff_scores_equal_plain(docs, none):
    import collections
    import math

    from feedloom.llm import ngrams

    words = [((d, t), (t or "").encode().lower().split()) for d, t, _ in TEXTS]
    ones, twos = collections.Counter(), collections.Counter()
    for _, w in words:
        ones.update(w)
        twos.update(zip(w, w[1:], strict=False))
    total = sum(ones.values())
    expected = []
    for (d, _), w in words:
        logs = []
        for i, x in enumerate(w):
            pair = (w[i - 1], x) if i else None
            if pair and twos[pair] >= 2:
                logs.append(math.log(twos[pair] / ones[pair[0]]))
            else:
                logs.append(math.log(ones[x] / total) + (math.log(ngrams.BACKOFF) if i else 0))
        expected.append((d, len(w), round(sum(logs) / len(logs), 9) if logs else None))
    got = [(r.id, r.n_words, None if r.log_score is None else round(r.log_score, 9)) for r in ngrams.scores(docs, order=2, cutoff=2).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert ngrams.scores(none).count() == 0


@pytest.mark.parametrize(("order", "cutoff"), [(3, 1), (3, 2)])
def test_longer_backoff_scores_equal_plain(docs, order, cutoff):
    import collections
    import math

    from feedloom.llm import ngrams

    words = [(d, (t or "").encode().lower().split()) for d, t, _ in TEXTS]
    counts = collections.Counter(tuple(w[i : i + k]) for _, w in words for k in range(1, order + 1) for i in range(len(w) - k + 1))
    total = sum(n for g, n in counts.items() if len(g) == 1)

    def log(gram):
        if len(gram) == 1:
            return math.log(counts[gram] / total)
        if counts[gram] >= cutoff:
            return math.log(counts[gram] / counts[gram[:-1]])
        return math.log(ngrams.BACKOFF) + log(gram[1:])

    expected = []
    for d, w in words:
        logs = [log(tuple(w[max(0, i - order + 1) : i + 1])) for i in range(len(w))]
        expected.append((d, len(w), round(sum(logs) / len(logs), 9) if logs else None))
    found = ngrams.scores(docs, order=order, cutoff=cutoff, slice_bytes=2_000).collect()
    got = [(r.id, r.n_words, None if r.log_score is None else round(r.log_score, 9)) for r in found]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_languages_fuse_evidence(spark):
    from feedloom.llm import language
    from feedloom.session import staged

    english, german = "the house and the garden with water " * 3, "der Garten und das Haus mit Wasser schön " * 3
    train = spark.createDataFrame([(i, (english, german)[i % 2], ("en", "de")[i % 2]) for i in range(40)], "doc_id long, text string, lang string")
    model = language.TextModel(staged(language.fit(train), "t"))
    assert model.languages == ["de", "en"]
    rows = [("http://a.example.de/x", f'<html lang="de"><p>{german}</p>') for _ in range(30)]
    rows += [("http://b.example.com/x", f"<html lang='en'><p>{english}</p>") for _ in range(30)]
    rows += [("http://a.example.de/y", "<html><p>42</p>"), ("http://c.example.com", ""), (None, None), ("x", "<html lang=de>")]
    pages = spark.createDataFrame(rows, "url string, html string")
    host, suffix = language.address_parts("url")
    evidence = pages.select(
        "url", "html", model.evidence(language.visible_text("html")).alias("text_log"),
        language.markup_language("html").alias("declared"), suffix.alias("suffix"), host.alias("host"),
    )
    got = language.identify(staged(evidence, "t"), model.languages).collect()
    assert len(got) == len(rows)
    found = {(r.url, r.html): r.lang for r in got}
    assert all(found[r] == "de" for r in rows[:30]) and all(found[r] == "en" for r in rows[30:60])
    assert found[rows[60]] == "de" and found[rows[61]] == "en" and found[rows[63]] == "de"
    assert all(0 < r.probability <= 1 for r in got)
    assert language.identify(staged(evidence.limit(0), "t"), model.languages).count() == 0
    assert language.identify(staged(evidence, "t"), []).where("lang IS NULL").count() == len(rows)


def test_grams_are_packed_whole():
    from feedloom.llm import ngrams

    draw = np.random.default_rng(1)
    for n, width in ((0, 56), (1, 56), (3, 56), (200_000, 56), (5000, 30)):
        grams = np.unique(draw.integers(0, 1 << width, n).astype(np.uint64))
        assert (ngrams._unpack(ngrams._pack(grams)) == grams).all()
        counts = draw.choice([1, 2, 254, 255, 256, 10**12], len(grams))
        assert (ngrams._unpack_counts(ngrams._pack_counts(counts), len(counts)) == counts).all()

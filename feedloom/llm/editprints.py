"""Document fingerprints by randomised edit embedding.

All texts walk over their characters under the same random bits: at step j a text that stands on
character c writes c and moves on if the bit of (c, j) is one. Texts with a small edit distance fall back
into step after an edit, so what they write differs in few places: edit distance becomes Hamming distance.
A fingerprint samples what is written at ``SLOTS`` shared steps, four bits each. The step of a
slot is the one of lowest priority among those that a text of this length reaches, so that texts of nearly
equal length sample nearly the same steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import text_of
from feedloom.llm.components import connected
from feedloom.session import staged

SLOTS = 128
KINDS = 64  # characters are told apart by a hash into so many kinds
PERIOD = 1 << 14  # the random bits repeat after so many steps
SLICE, GROUP = 6_000_000, 3_000  # characters and texts walked at once
COMPARED_AT_ONCE = 24_000_000  # characters
BANDS, BAND_BITS, NEAR = 24, 32, 0.8
TILE = 2048  # members of a bucket compared in one go


def _scramble(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit numbers from numbers; the shared randomness of all tasks."""
    x = np.asarray(x, dtype=np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _strides() -> np.ndarray:
    """[kind, step]: how many steps the walk stays on a character of that kind from that step on."""
    at = np.arange(KINDS * PERIOD, dtype=np.uint64) + np.uint64(1 << 40)
    moves = (_scramble(at) & np.uint64(1)).astype(bool).reshape(KINDS, PERIOD)
    moves[:, -1] = True
    places = np.where(moves, np.arange(PERIOD), PERIOD)
    following = np.minimum.accumulate(places[:, ::-1], axis=1)[:, ::-1]
    return (following - np.arange(PERIOD) + 1).astype(np.uint8)


def _ladders(longest: int = 1 << 40) -> tuple[np.ndarray, np.ndarray]:
    """[slot, scale]: the step and its priority in each doubling of the reachable steps."""
    scales = longest.bit_length()
    slot, scale = np.meshgrid(np.arange(SLOTS), np.arange(scales), indexing="ij")
    draws = _scramble((slot * 64 + scale).astype(np.uint64) + np.uint64(1 << 50))
    # Of 2^k equal priorities the lowest: an exponential draw, scaled; and a place in [2^k, 2^(k+1)).
    span = np.exp2(scale.astype(np.float64))
    low = -np.log1p(-(draws >> np.uint64(11)).astype(np.float64) / float(1 << 53)) / span
    place = (_scramble(draws) >> np.uint64(11)).astype(np.float64) / float(1 << 53)
    return span + np.floor(place * span) - 1, low


_STRIDES = _strides()
_STEPS, _PRIORITY = _ladders()


def sampled_steps(sizes: np.ndarray) -> np.ndarray:
    """[text, slot]: the steps that texts of these lengths sample, of about two steps per character."""
    reach = np.maximum(2 * sizes, 1)
    scales = min(int(np.max(reach)).bit_length() + 1, _STEPS.shape[1])
    best = np.zeros((len(sizes), SLOTS), dtype=np.int64)
    lowest = np.full((len(sizes), SLOTS), np.inf)
    for k in range(scales):
        better = (_STEPS[None, :, k] < reach[:, None]) & (_PRIORITY[None, :, k] < lowest)
        best = np.where(better, _STEPS[None, :, k].astype(np.int64), best)
        lowest = np.where(better, _PRIORITY[None, :, k], lowest)
    return best


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points one after the other, and the length of each text."""
    data = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(data, dtype="<u4"), np.array([len(t) for t in texts], dtype=np.int64)


def prints(texts: list[str]) -> np.ndarray:
    """[text, slot] values 0..15. All texts of the list walk side by side."""
    out = np.zeros((len(texts), SLOTS), dtype=np.uint8)
    if not texts:
        return out
    codes, sizes = _codes(texts)
    order = np.argsort(-sizes, kind="stable")
    ranked = sizes[order]
    steps = sampled_steps(ranked)
    kinds = (_scramble(codes) & np.uint64(KINDS - 1)).astype(np.int32) * PERIOD
    flat = _STRIDES.ravel()
    begins = (np.cumsum(sizes) - sizes)[order]
    longest = int(ranked[0])
    # Column i holds character i of all texts that have one; longer texts come first.
    alive = np.searchsorted(-ranked, -np.arange(longest), side="left") if longest else np.zeros(0, dtype=np.int64)
    at = np.zeros(len(texts), dtype=np.int64)
    wanted = np.sort(steps, axis=1)
    slot_of = np.argsort(steps, axis=1, kind="stable")
    following = np.zeros(len(texts), dtype=np.int64)  # how many of the wanted steps are behind
    values = np.full((len(texts), SLOTS), -1, dtype=np.int64)
    edge = np.c_[wanted, np.full(len(texts), np.iinfo(np.int64).max)]
    rows = np.arange(len(texts))
    ahead = edge[:, 0].copy()
    for i in range(longest):
        n = int(alive[i])
        here = at[:n]
        here += flat[kinds[begins[:n] + i] | (here & (PERIOD - 1))]
        late = ahead[:n] < here
        if not late.any():
            continue
        passed = np.flatnonzero(late)
        while len(passed):
            values[passed, slot_of[passed, following[passed]]] = codes[begins[passed] + i]
            following[passed] += 1
            ahead[passed] = edge[passed, following[passed]]
            passed = passed[ahead[passed] < at[passed]]
    # Beyond the end of the walk stands a value of its own. Each slot hashes what it met to four bits.
    salted = values.astype(np.uint64) * np.uint64(SLOTS) + np.arange(SLOTS, dtype=np.uint64)
    out[order[rows]] = (_scramble(salted) & np.uint64(15)).astype(np.uint8)
    return out


def to_text(values: np.ndarray) -> list[str]:
    """Fingerprints as hexadecimal digits, one per slot."""
    digits = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)[values]
    return [row.tobytes().decode("ascii") for row in digits]


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of equal slots above what chance gives (one in sixteen), 0 to 1."""
    equal = (left == right).mean(axis=1)
    return np.clip((equal - 1 / 16) / (15 / 16), 0.0, 1.0)


def in_slices(texts: list[str]) -> np.ndarray:
    """``prints`` of any number of texts, walked in groups of bounded size and of like lengths."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    out = np.zeros((len(texts), SLOTS), dtype=np.uint8)
    start, held = 0, 0
    for n, i in enumerate(order):
        held += len(texts[i])
        if held >= SLICE or n - start >= GROUP or n == len(order) - 1:
            group = order[start : n + 1]
            out[group] = prints([texts[j] for j in group])
            start, held = n + 1, 0
    return out


def fingerprint(text: str | Column) -> Column:
    """Fingerprint of a text column as 128 hexadecimal digits; a null text is an empty one.

    Equal texts have equal fingerprints, whatever else is in the batch."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(to_text(in_slices(texts.tolist())), dtype=object)

    return run(text_of(text))


def _edited(text: str, other: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _compared(texts: list[str], ids: list) -> pd.DataFrame:
    """Fingerprints of rows in order; the last row is only the one after the others."""
    import hashlib

    edited = [_edited(t, o) for t, o in zip(texts, texts[1:], strict=False)]
    own, changed = in_slices(texts), in_slices(edited)
    return pd.DataFrame(
        {
            "id": pd.array(ids[:-1], dtype="Int64"),
            "n_chars": [len(t) for t in texts[:-1]],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
            "fingerprint": to_text(own[:-1]),
            "edited_fingerprint": to_text(changed),
            "near_edited": likeness(own[:-1], changed),
            "near_next": likeness(own[:-1], own[1:]),
        }
    )


COMPARED = (
    "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of one task in their order: each is compared with the row after it in its range."""
    texts: list[str] = []
    ids: list = []
    guests: list[bool] = []
    for batch in batches:
        # What is left of the last batch is the row whose next one had not come yet.
        texts += batch["text"].tolist()
        ids += [None if pd.isna(i) else int(i) for i in batch["id"]]
        guests += batch["guest"].tolist()
        start, held = 0, 0
        for i in range(1, len(texts)):
            held += len(texts[i - 1])
            if held >= COMPARED_AT_ONCE or i == len(texts) - 1:
                found = _compared(texts[start : i + 1], ids[start : i + 1])
                # A guest stands for the first row of the next range: nothing follows it here.
                yield found[~np.array(guests[start:i], dtype=bool)]
                start, held = i, 0
        texts, ids, guests = texts[-1:], ids[-1:], guests[-1:]


def _located(value: Column, bounds: list[int], low: int, high: int) -> Column:
    """How many bounds are at or below the value, by halving."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(value < bounds[middle], _located(value, bounds, low, middle)).otherwise(_located(value, bounds, middle + 1, high))


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness, and that of the next text.

    The next document is the one of the next smaller id; after the last comes the first. The edited text is
    the text with its last floor(n/2) code points replaced by the first as many (or all) of
    the next one. Rows of null ids come last, equal ids are ordered by hash and text. A table of one row is its own next;
    an empty one gives an empty one. Null texts are empty.

    Ids are cut into ranges at sampled quantiles; each range is sorted in one task and gets a copy
    of the first row of the next range, found on ids alone. Texts are shuffled once.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or 4 * tasks
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    ids = rows.select("id").where("id IS NOT NULL")
    marks = ids.approxQuantile("id", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else []
    bounds = sorted({int(m) for m in marks})
    # Ranges count from the largest ids; null ids make one more at the end.
    number = F.when(F.col("id").isNull(), F.lit(len(bounds) + 1)).otherwise(
        F.lit(len(bounds)) - _located(F.col("id"), bounds, 0, len(bounds))
    )
    ranged = rows.withColumns({"range": number, "h": F.xxhash64("text"), "g": F.xxhash64("text", F.lit(1))})
    # One row per range comes to the driver, and goes back as a table of as many rows.
    tops = {r["range"]: r["top"] for r in rows.select("id", number.alias("range")).groupBy("range").agg(F.max("id").alias("top")).collect()}
    present = sorted(tops)
    table = spark.createDataFrame([(r, tops[r], present[i - 1]) for i, r in enumerate(present)], "r int, top long, before int")
    at_top = (F.col("range") == F.col("r")) & F.col("id").eqNullSafe(F.col("top"))
    first = F.min_by("text", F.struct("h", "g"))
    guests = (
        ranged.join(F.broadcast(table), at_top)
        .groupBy("r", "before", "top")
        .agg(first.alias("text"), F.min(F.struct("h", "g")).alias("p"))
        .select(F.col("top").alias("id"), "text", F.col("before").alias("range"), "p.h", "p.g", F.lit(True).alias("guest"))
    )
    dealt = ranged.select("id", "text", "range", "h", "g", F.lit(False).alias("guest")).union(guests)
    ordered = dealt.repartition(min(tasks, max(1, len(present))), "range").sortWithinPartitions(
        "range", "guest", F.col("id").desc_nulls_last(), "h", "g"
    )
    return ordered.select("id", "text", "guest").mapInPandas(_walk, COMPARED)


def _bands(print_col: str) -> Column:
    """Sampled bits of a fingerprint: each band joins the digits of some slots."""
    digits = BAND_BITS // 4
    picks = (_scramble(np.arange(BANDS * digits) + (1 << 60)) % np.uint64(SLOTS)).astype(int).reshape(BANDS, digits)
    keys = [
        F.struct(F.lit(b).alias("band"), F.concat(*[F.substring(print_col, int(s) + 1, 1) for s in picks[b]]).alias("key"))
        for b in range(BANDS)
    ]
    return F.inline(F.array(*keys))


def _forest(values: np.ndarray, near: float) -> list[tuple[int, int]]:
    """Links (i, j) between near rows that join every component that all near pairs join.

    A row that is reached leaves the rest, so a dense group costs little more than one look at each
    member. Rows that nothing links are compared all with all.
    """
    left, links = np.arange(len(values)), []
    while len(left):
        front, left = [int(left[0])], left[1:]
        while front and len(left):
            at = front.pop()
            met = likeness(values[left], values[at]) >= near
            if met.any():
                reached = left[met].tolist()
                links += [(at, i) for i in reached]
                front += reached
                left = left[~met]
    return links


def _linked(near: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows of a task in the order of their buckets; a bucket can go on in the next batch."""
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            marks = rows[["bucket", "low", "high"]].to_numpy()
            begins = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]).any(axis=1)])
            rest = rows.iloc[begins[-1] :]
            yield _links_of(rows.iloc[: begins[-1]], begins, near)
        if rest is not None:
            yield _links_of(rest, np.array([0, len(rest)]), near)

    return run


def _links_of(rows: pd.DataFrame, begins: np.ndarray, near: float) -> pd.DataFrame:
    packed = np.frombuffer(b"".join(rows["packed"]), dtype=np.uint8).reshape(len(rows), SLOTS // 2)
    values = np.concatenate([packed >> 4, packed & 15], axis=1)
    nodes, a, b = rows["node"].to_numpy(), [], []
    for start, end in zip(begins, begins[1:], strict=False):
        links = _forest(values[start:end], near)
        a += [nodes[start + i] for i, _ in links]
        b += [nodes[start + j] for _, j in links]
    return pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})


def similar_groups(fingerprints: DataFrame, near: float = NEAR, tile: int = TILE) -> DataFrame:
    """(fingerprint, group): distinct fingerprints linked by likeness, with the group's smallest one.

    Bands of sampled bits find candidates; whole fingerprints decide. In a band's bucket all pairs count.
    A bucket of more than ``tile`` members is cut into tiles, and each two of its tiles are a task's work
    of their own, so that every pair of the bucket meets and none has to fit into one task.
    What leaves a task are links that join the same components, never one row per pair.
    """
    known = fingerprints.select("fingerprint").where("fingerprint IS NOT NULL").distinct()
    known = staged(known.select(F.xxhash64("fingerprint").alias("node"), "fingerprint"), "edit-prints")
    # Buckets are counted on numbers alone; a fingerprint goes along only where it has company.
    entries = known.select("node", "fingerprint", _bands("fingerprint")).select("node", F.xxhash64("band", "key").alias("bucket"))
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = entries.join(sizes, "bucket").withColumn("tiles", F.ceil(F.col("n") / tile).cast("int"))
    own = F.pmod(F.xxhash64("node", F.lit("tile")), F.col("tiles")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("tiles") - 1), lambda i: (i != F.col("own")) | (F.col("tiles") == 1))
    dealt = shared.withColumn("own", own).select("node", "bucket", "own", F.explode(others).alias("other"))
    dealt = dealt.join(known.select("node", F.unhex("fingerprint").alias("packed")), "node").select(
        "node", "packed", "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    place = ["bucket", "low", "high"]
    links = dealt.repartition(*place).sortWithinPartitions(*place).mapInPandas(_linked(near), "a long, b long")
    roots = connected(links)
    of_node = roots.select(F.col("node").alias("_node"), "root")
    return known.join(of_node, F.col("node") == F.col("_node"), "left").select(
        "fingerprint", F.coalesce("root", "node").alias("group")
    )

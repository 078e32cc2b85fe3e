"""Language identification by Bayesian evidence fusion.

Independent pieces of evidence add up as log-likelihoods for each language: the text itself (letter
trigrams), the declared markup language, the address suffix, and the host. The tables for the declared
language, suffix and host are counts over all rows, made by grouped aggregation, of the language that
the text alone says; a host with few rows leans on its suffix, a suffix with few on all rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import bounded, fresh, slices, text_key, text_of
from feedloom.session import staged

BITS = 16
#: A text's trigrams are far from independent: their sum counts as so many draws at most.
TEXT_DRAWS = 40.0
#: Rows that the level above is worth in a host's or suffix's counts.
PRIOR_ROWS = 5.0
#: Words whose evidence a worker process remembers, from task to task.
KEPT = 400_000
#: Characters looked at together.
SLICE = 4_000_000
#: A model has at most so many languages: 64 MB are sent to each executor.
LANGUAGES = 256


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed letter trigrams of words with their edges, one after the other, and their number for each word."""
    text = "".join([f" {w} " for w in words])
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    mixed = (points[:-2] * np.uint64(0x9E3779B97F4A7C15) + points[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + points[2:]
    mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 2)
    inside = np.ones(len(points), dtype=bool)
    inside[ends - 1] = inside[ends - 2] = False  # trigrams that reach into the next word
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)[inside[:-2]], sizes


def _words(text: str) -> list[str]:
    return text.lower().split()


def fit(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", max_rows: int = 5_000, id_col: str = "doc_id"
) -> DataFrame:
    """(lang, gram, n): trigram counts of each language, from a sample of labelled rows.

    The sample holds at most ``max_rows`` different rows (id, label, text), chosen by a hash of the id; null
    labels are left out, repeated rows count once, null ids are one id. There are at most languages x 2^16 counts. No
    labels give an empty table and so a model without languages.
    """
    chosen = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text")
    )
    chosen = chosen.withColumns(dict(zip(("t1", "t2"), text_key(F.col("text")), strict=True)))
    keys = ["id", "lang", "t1", "t2"]
    first = chosen.select(*keys).distinct().orderBy(F.xxhash64("id"), *keys).limit(max_rows)
    first = staged(first.toDF(*[f"_{k}" for k in keys]), "language-sample")
    same = F.col("id").eqNullSafe(F.col("_id"))
    for k in keys[1:]:
        same &= F.col(k) == F.col(f"_{k}")
    sample = chosen.join(bounded(first), same, "left_semi").dropDuplicates(keys)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                held = total.setdefault(lang, np.zeros(1 << BITS, dtype=np.int64))
                if words := _words(text):
                    held += np.bincount(_grams(words)[0], minlength=1 << BITS)
        for lang, held in total.items():
            at = np.flatnonzero(held)
            yield pd.DataFrame({"lang": lang, "gram": at, "n": held[at]})

    grams = sample.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    return grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class _Evidence(dict):
    """Word -> number of its row in ``logs``: the sum of its trigrams' log-likelihoods by language, and their number.

    One per worker process and model; when it is full it starts anew.
    """

    def __init__(self, model: str, table: np.ndarray) -> None:
        super().__init__()
        self.model, self.table, self.new = model, table, []
        self.logs = np.zeros((1024, table.shape[1] + 1))

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        self.new.append(word)
        return at

    def learn(self) -> None:
        """Fill the rows of the words that came since the last call."""
        if not self.new:
            return
        while len(self.logs) < len(self):
            self.logs = np.concatenate([self.logs, np.zeros_like(self.logs)])
        grams, sizes = _grams(self.new)
        first = np.cumsum(sizes) - sizes
        rows = self.logs[len(self) - len(self.new) : len(self)]
        rows[:, :-1] = np.add.reduceat(self.table[grams], first, axis=0)
        rows[:, -1] = sizes
        self.new = []

    def of(self, texts: pd.Series) -> np.ndarray:
        """Log-likelihoods of each language, one row per text; zeros for a text without words."""
        if len(self) >= KEPT:
            self.clear()
        words = [_words(t) for t in texts]
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        at = np.fromiter((self[w] for text in words for w in text), dtype=np.int64, count=int(sizes.sum()))
        self.learn()
        out = np.zeros((len(words), self.logs.shape[1]))
        full = np.flatnonzero(sizes)
        if len(full):
            out[full] = np.add.reduceat(self.logs[at], (np.cumsum(sizes) - sizes)[full], axis=0)
        return out[:, :-1] * np.minimum(1.0, TEXT_DRAWS / np.maximum(out[:, -1:], 1))


_EVIDENCE: list[_Evidence] = []


def _evidence_of(model: str, table: np.ndarray) -> _Evidence:
    if not _EVIDENCE or _EVIDENCE[0].model != model:
        _EVIDENCE[:] = [_Evidence(model, table)]
    return _EVIDENCE[0]


class TextModel:
    """Log-likelihood tables of all languages (languages x 2^16 numbers), sent once to each executor.

    More than ``LANGUAGES`` languages are refused: such a label column holds something else.
    """

    def __init__(self, grams: DataFrame) -> None:
        if grams.select("lang").distinct().count() > LANGUAGES:
            raise ValueError(f"the labels name more than {LANGUAGES} languages")
        table = grams.toPandas()  # at most languages x 2^16 rows
        self.languages = sorted(table["lang"].unique())
        logs = np.zeros((len(self.languages), 1 << BITS))
        for i, lang in enumerate(self.languages):
            own = table[table["lang"] == lang]
            counts = np.full(1 << BITS, 0.5)
            counts[own["gram"].to_numpy(np.int64)] += own["n"].to_numpy(np.float64)
            logs[i] = np.log(counts / counts.sum())
        self._name = uuid.uuid4().hex
        self._sent = grams.sparkSession.sparkContext.broadcast((logs - logs.mean(axis=0)).T.astype(np.float32))

    def evidence(self, text: str | Column) -> Column:
        """Log-likelihood of each language, in the order of ``languages``; zeros for a text without words."""
        sent, name = self._sent, self._name

        @F.pandas_udf("array<double>")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            memory = _evidence_of(name, sent.value)
            for texts in batches:
                found = [row for part in slices(texts, SLICE) for row in memory.of(part)]
                yield pd.Series(found, dtype=object)

        return scored(text_of(text))


def address_parts(url: str | Column) -> tuple[Column, Column]:
    """(host, suffix) of an address: lower case, without port; null where there is none."""
    host = F.lower(F.regexp_extract(F.col(url) if isinstance(url, str) else url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    host = F.nullif(host, F.lit(""))
    return host, F.substring_index(host, ".", -1)


def markup_language(html: str | Column) -> Column:
    """The primary language that a page's html element declares; null if none."""
    html = F.col(html) if isinstance(html, str) else html
    found = F.regexp_extract(html, r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([a-zA-Z]{2,3})""", 1)
    return F.nullif(F.lower(found), F.lit(""))


def visible_text(html: str | Column) -> Column:
    """A page's text without scripts, styles, comments and tags."""
    html = F.col(html) if isinstance(html, str) else html
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&[a-zA-Z#0-9]+;", " ")


def _summed(column: str, languages: int) -> Column:
    return F.array(*[F.sum(F.col(column)[i]) for i in range(languages)])


def _smoothed(counts: str, above: str) -> Column:
    """Counts leaning on the level above: (count + PRIOR_ROWS * p) / (rows + PRIOR_ROWS)."""
    rows = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(F.arrays_zip(F.col(counts).alias("c"), F.col(above).alias("p")), lambda z: (z["c"] + PRIOR_ROWS * z["p"]) / (rows + PRIOR_ROWS))


def identify(evidence: DataFrame, languages: list[str]) -> DataFrame:
    """Adds lang and probability to rows (..., text_log, declared, suffix, host).

    ``evidence`` is read twice and must be a written table; further columns are kept, whatever their names.
    ``lang`` and ``probability`` are named freshly if they clash. A row's own text is one of the rows that its
    host's prior is counted from. Repeated rows are rows of their own. A null declared language, suffix or host adds
    nothing. Without any evidence the shares of all rows decide; ties go to the language that comes first. No rows give
    no rows. Hosts and suffixes are aggregated before the shuffle, so a host with a third of all rows is
    no burden, and the join that brings the priors back can be split.
    """
    n = len(languages)
    names = [fresh(evidence, c) for c in ("lang", "probability")]
    if not n:
        return evidence.withColumns({names[0]: F.lit(None).cast("string"), names[1]: F.lit(None).cast("double")})
    own = ("text_log", "declared", "suffix", "host")
    further = [c for c in evidence.columns if c not in own]
    whole = evidence
    # Further columns travel as one, so that no helper's name can clash with theirs.
    evidence = evidence.select(*own, F.struct(*further).alias("further") if further else F.lit(None).alias("further"))
    peak = F.array_max("text_log")
    likely = F.transform("text_log", lambda x: F.exp(x - peak))
    said = F.aggregate(likely, F.lit(0.0), lambda a, x: a + x)
    rows = evidence.withColumn("text_share", F.transform(likely, lambda x: x / said))
    flat = F.array(*[F.lit(1.0 / max(n, 1))] * n)
    hosts = staged(
        rows.groupBy("suffix", "host").agg(_summed("text_share", n).alias("host_rows")), "language-hosts"
    )
    everything = hosts.groupBy().agg(_summed("host_rows", n).alias("all_rows"))
    overall = everything.select(_smoothed_flat("all_rows", flat).alias("all_share"))
    suffixes = hosts.groupBy("suffix").agg(_summed("host_rows", n).alias("suffix_rows"))
    by_suffix = suffixes.join(F.broadcast(overall)).select(  # one row
        F.col("suffix").alias("_s"), "all_share", _smoothed("suffix_rows", "all_share").alias("suffix_share")
    )
    own_share = F.when(F.col("host").isNotNull(), _smoothed("host_rows", "suffix_share")).otherwise(F.col("suffix_share"))
    by_host = hosts.join(by_suffix, F.col("suffix").eqNullSafe(F.col("_s"))).select(
        F.col("suffix").alias("_suffix"), F.col("host").alias("_host"), own_share.alias("prior")
    )
    declared = staged(
        rows.where("declared IS NOT NULL").groupBy("declared").agg(_summed("text_share", n).alias("declared_rows")),
        "language-declared",
    )
    said_so = declared.join(F.broadcast(overall)).select(
        F.col("declared").alias("_declared"),
        # How much likelier this declaration is under each language than over all rows.
        F.transform(
            F.arrays_zip(_smoothed("declared_rows", "all_share").alias("d"), F.col("all_share").alias("a")),
            lambda z: F.ln(z["d"] / z["a"]),
        ).alias("declared_log"),
    )
    placed = (
        rows.join(by_host, F.col("suffix").eqNullSafe(F.col("_suffix")) & F.col("host").eqNullSafe(F.col("_host")))
        .join(said_so, F.col("declared") == F.col("_declared"), "left")
        .withColumn("declared_log", F.coalesce("declared_log", F.array(*[F.lit(0.0)] * n)))
    )
    fused = F.transform(
        F.arrays_zip(F.col("text_log").alias("t"), F.col("prior").alias("p"), F.col("declared_log").alias("d")),
        lambda z: z["t"] + F.ln(z["p"]) + z["d"],
    )
    total = placed.withColumn("fused", fused)
    high = F.array_max("fused")
    weights = total.withColumn("weights", F.transform("fused", lambda x: F.exp(x - high)))
    summed = F.aggregate("weights", F.lit(0.0), lambda a, x: a + x)
    best = F.array_position("fused", high)
    named = F.array(*[F.lit(x) for x in languages])
    return weights.select(
        *[F.col(c) if c in own else F.col("further")[c].alias(c) for c in whole.columns],
        F.element_at(named, best.cast("int")).alias(names[0]),
        (F.element_at("weights", best.cast("int")) / summed).alias(names[1]),
    )


def _smoothed_flat(counts: str, above: Column) -> Column:
    rows = F.aggregate(F.transform(counts, lambda x: F.coalesce(x, F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    return F.transform(
        F.arrays_zip(F.col(counts).alias("c"), above.alias("p")),
        lambda z: (F.coalesce(z["c"], F.lit(0.0)) + PRIOR_ROWS * z["p"]) / (rows + PRIOR_ROWS),
    )

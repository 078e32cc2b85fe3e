"""Line de-duplication over levelled sorted runs of line hashes, in DataFrame functions only.

What has been seen is kept as runs: tables of line hashes, bucketed and sorted by hash, one file a bucket. A batch of
documents reduces its lines to distinct hashes, anti-joins them with each run by merging (a run is
read in its order, neither shuffled nor sorted), and adds what is new as a run of its own on level 0. When a
level holds ``FANOUT`` runs they are compacted to one run on the next level, so that the number of
runs grows with the logarithm of the number of batches.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import SPACE, fresh, text_of
from feedloom.session import scratch_folder, staged

SHORTEST = 10
BATCHES = 4
FANOUT = 3
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Stands for a null id in comparisons: after every other.
LAST = (1 << 63) - 1


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), CAPITALS, CAPITALS.lower())


def key_hash(key: Column) -> tuple[Column, Column]:
    """128 bits that stand for a key."""
    return F.xxhash64(key), F.xxhash64(F.lit("line"), key)


#: Lets a bucketed scan state the order of its files, so that a join that merges needs no sort of them.
ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@contextmanager
def runs_in_order(spark: SparkSession) -> Iterator[None]:
    """Plans that are made in this block read a run in the order in which it was written."""
    before = spark.conf.get(ORDERED)
    spark.conf.set(ORDERED, "true")
    try:
        yield
    finally:
        spark.conf.set(ORDERED, before)


class LineRuns:
    """The runs of one corpus, as bucketed tables of the session's warehouse.

    Rows are (k1, k2, owner): a line's hash and the document that keeps it. The number of buckets
    follows spark.sql.shuffle.partitions. Tables are external, under ``folder`` on the shared storage.
    """

    def __init__(self, spark: SparkSession, folder: str, fanout: int = FANOUT) -> None:
        self._spark, self._folder, self._fanout = spark, folder, fanout
        self._buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        dealt = rows.select("k1", "k2", "owner").repartition(self._buckets, "k1", "k2")
        writer = dealt.write.bucketBy(self._buckets, "k1", "k2").sortBy("k1", "k2")
        writer.option("path", f"{self._folder}/{name}").saveAsTable(name)
        return name

    def path(self, name: str) -> str:
        return f"{self._folder}/{name}"

    def unknown(self, lines: DataFrame) -> DataFrame:
        """Distinct hashes of a batch that no run holds, with their smallest owner.

        The batch is sorted once; each run is merged with it as it lies.
        """
        found = lines.groupBy("k1", "k2").agg(F.min("owner").alias("owner"))
        for level in self.levels:
            for run in level:
                known = self._spark.table(run).select("k1", "k2").hint("merge")
                found = found.join(known, ["k1", "k2"], "left_anti")
        return found

    def absorb(self, lines: DataFrame) -> DataFrame:
        """Take in the hashes of a batch, rows (k1, k2, owner); returns the run of those that are new.

        The batch must be later than all before it: a line known from earlier batches is not new,
        whoever holds it. Within the batch the smallest owner counts.
        """
        with runs_in_order(self._spark):
            name = self._write(self.unknown(lines))
        self._add(name, 0)
        return self._spark.read.schema("k1 long, k2 long, owner long").parquet(self.path(name))

    def _add(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self._fanout:
            merged = self._spark.table(self.levels[level][0])
            for run in self.levels[level][1:]:
                merged = merged.union(self._spark.table(run))
            # The batch that was added last is still read by its path; its files stay.
            for run in self.levels[level]:
                self._retired.append(run)
            self.levels[level] = []
            self._add(self._write(merged), level + 1)

    @property
    def _retired(self) -> list[str]:
        return self.__dict__.setdefault("retired", [])

    def close(self) -> None:
        """Forget the tables; their files go with the folder."""
        for run in [*self._retired, *(r for level in self.levels for r in level)]:
            self._spark.sql(f"DROP TABLE IF EXISTS {run}")
        self.levels = []


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """All columns of ``docs`` with kept_text, n_lines and n_dropped (named freshly if they clash).

    A text is split at \\n; null and empty texts are one empty line. Keys (``line_key``) of at least
    ``shortest`` code points that several documents hold lose all their lines except those in the
    document of the smallest id. Ids are whole numbers or null. Documents are taken in ``batches`` ranges of their ids, so an
    earlier batch always holds the smaller ids. Rows of one id are one document: they keep and
    lose the same lines; a null id is a document of its own after all others. An empty table gives an empty one.

    Lines travel as two hashes, an id and a number; the texts themselves go once through a shuffle,
    together with the numbers of their dropped lines. A line that a third of all documents
    hold is reduced to one row per task before the shuffle, and the join that marks its lines can be split.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "line-runs")
    lines_col, drop_col, key1, key2, ident = (fresh(docs, n) for n in ("lines", "dropped", "text_key", "text_size", "ident"))
    of_owner, of_key, of_size = (fresh(docs, n) for n in ("of_owner", "of_key", "of_size"))
    owner = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    text = text_of(text_col)
    ids = docs.select(owner.alias("owner")).where(F.col("owner") != LAST)
    # approxQuantile wants at least one share; with one batch there is none to ask for.
    marks = ids.approxQuantile("owner", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    bounds = sorted({int(m) for m in marks})
    batch = sum((F.when(F.col("owner") > b, 1).otherwise(0) for b in bounds), F.lit(0))
    split = docs.select(
        owner.alias("owner"),
        F.xxhash64(text).alias("t"),
        F.octet_length(text).alias("s"),
        F.posexplode(F.split(text, "\n")).alias("pos", "line"),
    )
    keyed = split.select("owner", "t", "s", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= shortest)
    k1, k2 = key_hash(F.col("key"))
    # Texts are read and hashed once; each batch reads its own part of the narrow table.
    lines = keyed.select("owner", "t", "s", "pos", k1.alias("k1"), k2.alias("k2"), batch.alias("batch"))
    lines.write.partitionBy("batch").parquet(f"{folder}/lines")
    lines = spark.read.schema(lines.schema).parquet(f"{folder}/lines")
    runs = LineRuns(spark, folder, fanout)
    dropped = None
    try:
        for number in range(len(bounds) + 1):
            part = lines.where(F.col("batch") == number).drop("batch")
            new = runs.absorb(part)
            lost = part.join(new, ["k1", "k2", "owner"], "left_anti").select("owner", "t", "s", "pos")
            lost.write.mode("append").parquet(f"{folder}/lost")
            dropped = spark.read.schema(lost.schema).parquet(f"{folder}/lost")
    finally:
        runs.close()
    per_text = dropped.groupBy("owner", "t", "s").agg(F.array_sort(F.collect_set("pos")).alias(drop_col))
    per_text = staged(per_text.select(F.col("owner").alias(of_owner), F.col("t").alias(of_key), F.col("s").alias(of_size), drop_col), "dropped-lines")
    whole = docs.withColumns({ident: owner, key1: F.xxhash64(text), key2: F.octet_length(text)})
    same = (F.col(ident) == F.col(of_owner)) & (F.col(key1) == F.col(of_key)) & (F.col(key2) == F.col(of_size))
    joined = whole.join(per_text, same, "left")
    parts = joined.withColumns({lines_col: F.split(text, "\n"), drop_col: F.coalesce(F.col(drop_col), F.array().cast("array<int>"))})
    # What stays lies between two dropped lines: one slice each, so long texts take linear time.
    edges = F.concat(F.array(F.lit(-1)), F.col(drop_col), F.array(F.size(lines_col)))
    stays = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size(drop_col) + 1),
            lambda i: F.slice(
                F.col(lines_col),
                F.element_at(edges, i) + 2,
                F.element_at(edges, i + 1) - F.element_at(edges, i) - 1,
            ),
        )
    )
    names = {n: fresh(docs, n) for n in ("kept_text", "n_lines", "n_dropped")}
    return parts.select(
        *docs.columns,
        F.array_join(stays, "\n").alias(names["kept_text"]),
        F.size(lines_col).cast("long").alias(names["n_lines"]),
        F.size(drop_col).cast("long").alias(names["n_dropped"]),
    )

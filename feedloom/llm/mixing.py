"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Every source gets a target size; each of its documents is expected target / size times in the mix. Along the
documents of a source the expected copies are summed up, one random offset is added, and a
document comes out once for each integer that its sum crosses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import fresh
from feedloom.session import staged

WEIGHTS = (5, 2, 1)
#: Rows of one source and size class are dealt over so many slices.
SLICES = 64


def word_count(text: str | Column) -> Column:
    """Number of runs of characters other than [\\x20\\x09-\\x0D]; 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size, target) from rows (source, size), one row per source.

    Sources in order of code points, null last, weigh ``weights`` in turn and share the whole size
    by weight. A target stops at ``most`` times its source's size; what is over is shared by weight among the
    others until no target is above. In closed form: sources are ordered by cap over weight, and
    those whose cap lies below the level that the rest would reach are capped. A source of size 0 has target
    0. Only the table of sources, one row each, meets in one task.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights)) + 1)
    weighed = per_source.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * most)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    filled = weighed.select(
        "*",
        (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open"),
    )
    # The first source in this order whose cap is above its share sets the level for all that follow.
    free = F.col("cap") / F.col("weight") > F.col("left") / F.col("open")
    level = filled.withColumn("level", F.when(free, F.col("left") / F.col("open")))
    found = level.withColumn("level", F.first("level", ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, 0)))
    target = F.when(F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight"))
    return found.select("source", "source_size", target.alias("target"))


def offset(source: str, seed: str = "mix") -> Column:
    """A number in [0, 1) that depends on the source and the seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(source), F.lit("<null>"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = 3,
    size_col: str | None = None,
    slices: int = SLICES,
) -> DataFrame:
    """The rows of ``docs`` with size, source_size, target and copies (0 or more), named freshly if they clash.

    Within a source, rows are ordered by size class, slice of the id and size, so that the sample
    holds every size in its share and taken sizes come near the target. A row's place is the sum
    of the rows in earlier (class, slice, size) groups plus its place in its own group: no task holds a
    whole source, however large. Null ids, texts (size 0) and sources are kept as values; repeated rows are rows
    of their own; an empty table gives an empty one. Reruns give the same copies, except that
    equal rows may trade places.
    """
    size, key = fresh(docs, "size"), fresh(docs, "group_of_rows")
    sized = docs.withColumn(size, F.col(size_col) if size_col else word_count(text_col))
    bits = F.length(F.bin(size))
    # Four classes for each power of two, from the three leading bits.
    size_class = bits * 8 + F.floor(F.col(size) * 8 / F.pow(F.lit(2.0), bits)).cast("int")
    group = F.struct(
        F.col(source_col).isNull().alias("no_source"),
        F.coalesce(source_col, F.lit("")).alias("source"),
        size_class.alias("class"),
        F.coalesce(F.abs(F.col(id_col) % slices), F.lit(0)).cast("int").alias("slice"),
        # Ids may have a stride, be null or repeat; each size of a slice is a group of its own.
        F.col(size).alias("size"),
    )
    sized = sized.withColumn(key, group)
    counts = sized.groupBy(F.col(key).alias("rows_of")).agg(F.count("*").alias("rows"), F.sum(size).alias("size"))
    counts = staged(counts, "mix-groups").withColumn("source", F.when(~F.col("rows_of.no_source"), F.col("rows_of.source")))
    earlier = Window.partitionBy("source").orderBy("rows_of").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    targets = source_targets(counts.select("source", "size"), weights, most).withColumnRenamed("source", "source_of")
    plan = starts.join(targets, F.col("source").eqNullSafe(F.col("source_of")))
    # Helper columns have names that the table does not have; the plan's size and target come out under these.
    rows_of, start, total, target, at, copies = (
        fresh(sized, n) for n in ("rows_of", "start_of_group", "source_size", "target", "place", "copies")
    )
    plan = plan.select(
        F.col("rows_of").alias(rows_of), F.col("start").alias(start), F.col("source_size").alias(total), F.col("target").alias(target)
    )
    # The join and the window use one key, so rows are shuffled once.
    planned = sized.join(plan, F.col(key) == F.col(rows_of))
    own = Window.partitionBy(key).orderBy(F.col(id_col).isNull(), id_col, F.xxhash64(text_col))
    # A target is a quotient of doubles, so its rate is held below the limit again.
    rate = F.when(F.col(total) > 0, F.least(F.col(target) / F.col(total), F.lit(float(most)))).otherwise(F.lit(0.0))
    u = offset(source_col)
    crossed = F.floor(F.col(at) * rate + u) - F.floor((F.col(at) - 1) * rate + u)
    placed = planned.withColumn(at, F.col(start) + F.row_number().over(own))
    # Rounding of a long sum must not give a copy more than the limit either.
    return placed.select(*docs.columns, size, total, target, F.least(crossed, F.lit(most)).cast("int").alias(copies))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its own columns only."""
    taken = mix(docs, **options)
    copies = taken.columns[-1]
    one = fresh(docs, "one")
    return taken.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), F.col(copies))).alias(one)).drop(one)

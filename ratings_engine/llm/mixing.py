"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a share of all words by its weight, at most max_copies times its own words; what a
source cannot take goes to the others by weight. A source takes its documents whole as often as its
target allows (complete epochs) and then a weighted sample without replacement for the rest:
documents ordered by the exponential key -ln(u) / quality, taken while their running sum of words
stays within the rest of the target.

The running sums are computed per (source, range of keys) and over the sums of these ranges, so no
task holds a whole source. Keys of a document of quality q are exponential with rate q, so a source's
counts of documents by quality give the distribution of its keys, and ranges equal in it hold about
equally many documents, whatever the qualities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratings_engine.llm.common import WORD, staged

MAX_COPIES = 3
WEIGHT_CYCLE = 3
ROWS_PER_RANGE = 2000
#: Levels of quality for each factor of e, of which a source's distribution of keys is made.
LEVELS = 16
SYMBOLS = r"[#*$%&|<>]"

RESULT = ("size", "source_size", "target", "epochs", "sampled", "taken")


def symbol_quality(text: Column) -> Column:
    """1.0 for text without markup symbols, falling to 0.1 when a fifth of it or more is symbols."""
    share = F.regexp_count(text, F.lit(SYMBOLS)) / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.lit(0.1), F.lit(1.0) - 5 * F.coalesce(share, F.lit(0.0)))


def exponential_key(doc_id: Column, quality: Column, seed: str) -> Column:
    """-ln(u) / quality with u in (0, 1] drawn from the seed and the document's id."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))),
                               1, 13), 16, 10).cast("bigint")
    return -F.log((drawn + 1) / F.lit(2.0 ** 52)) / quality


def _with_ranges(rows: DataFrame, rows_per_range: int) -> DataFrame:
    """rows with range: a number that grows with draw, for about rows_per_range rows of a source.

    The share of a source's keys up to x is the mean of 1 - exp(-q x) over its documents. Sums in one
    order of terms that grow with x grow with x, so ranges follow the keys exactly."""
    levels = rows.groupBy("key", "level").agg(F.count("*").alias("n"))
    by_key = staged(levels.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct(F.exp(F.col("level") / LEVELS).alias("rate"), "n"))).alias("rates")), "rates")
    upto = F.aggregate("rates", F.lit(0.0), lambda total, x: total + x["n"] * (1 - F.exp(-x["rate"] * F.col("draw"))))
    return (rows.join(by_key, "key")
            .withColumn("range", F.floor(upto / rows_per_range)).drop("rates", "level"))


def source_targets(sizes: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """(key, source, source_size) -> with target. Sources by code point, null last, weigh 1, 2, 3, ...

    Targets fill up like water: below the level every source gets level * weight, the others their
    cap. With sources ordered by cap / weight, the level is the largest of what remains after the
    caps of all earlier sources, divided by the weights from here on."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(earlier), F.lit(0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0))))
    return (sizes.withColumn("place", place)
            .withColumn("weight", (F.col("place") - 1) % WEIGHT_CYCLE + 1)
            .withColumn("cap", max_copies * F.col("source_size"))
            .withColumn("level", level)
            .withColumn("target", F.least(F.col("cap").cast("double"),
                                          F.max("level").over(everything) * F.col("weight")))
            .select("key", "source_size", "target"))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        quality: Column | None = None, seed: str = "mix", max_copies: int = MAX_COPIES,
        rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """All documents with size, source_size, target, epochs, sampled and taken (words).

    Null texts have size 0, a null source is a source of its own. Rows repeating an id are separate
    documents with equal keys; ties go by id, then size. An empty table gives no rows. Input columns
    named like a result column give way to it; all others are kept. Running it again on the same
    rows gives the same result."""
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("bigint")
    weight = symbol_quality(F.col(text)) if quality is None else quality
    carried = [c for c in docs.columns if c not in RESULT]
    rows = staged(docs.select(
        F.struct(*carried).alias("row"), F.col(doc_id).alias("id"), F.col(source).alias("source"),
        # Null apart from every name, so that it can be a join key.
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("key"),
        words.alias("size"), exponential_key(F.col(doc_id), weight, seed).alias("draw"),
        F.round(LEVELS * F.log(weight)).cast("int").alias("level")), "mix")
    rows = _with_ranges(rows, rows_per_range)

    sums = rows.groupBy("key", "range").agg(F.first("source").alias("source"),
                                            F.sum("size").alias("range_size"))
    targets = source_targets(sums.groupBy("key").agg(F.first("source").alias("source"),
                                                     F.sum("range_size").alias("source_size")), max_copies)
    before = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranged = (sums.withColumn("before_range", F.coalesce(F.sum("range_size").over(before), F.lit(0)))
              .select("key", "range", "before_range").join(targets, "key"))

    inside = Window.partitionBy("key", "range").orderBy("draw", "id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    sampled = (F.col("epochs") < max_copies) & (
        F.col("before") + F.col("size") / 2 <= F.col("target") - F.col("epochs") * F.col("source_size"))
    return (rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(ranged, ["key", "range"])
            .withColumn("before", F.col("before_range") + F.col("inside"))
            .withColumn("epochs", epochs).withColumn("sampled", sampled)
            .withColumn("taken", F.col("size") * (F.col("epochs") + F.col("sampled").cast("int")))
            .select("row.*", *RESULT))

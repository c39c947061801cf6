"""Quality rules with thresholds taken from the data, in DataFrame functions only.

Every (language, source) keeps a quantile sketch per measure: counts of values rounded down to
their six leading bits, so a quantile is at most 1/32 too low. Sketches merge by adding counts: per
task, per group, and from groups with few documents up to their language and to all documents.
A document is kept if each measure lies within the fences of its group: as far beyond the 99% quantile
as that lies from the median, and likewise below the 1% quantile. No constant sets a fence. Where a
group's upper quantiles are equal, so that they give no distance, its language's distance counts, then
that of all documents; a measure equal in nearly all documents has no fence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratings_engine.llm.common import WORD, let, same, staged, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = r"[#*$%&|<>]"
#: A group with fewer documents uses the sketch of its language, then of all documents.
MIN_GROUP = 100
#: Per cent of a group's documents that lie at or below the quantiles a fence is made of.
LOW, MIDDLE, HIGH = 1, 50, 99
#: Distance of a fence from the outer quantile, in distances of that from the median.
REACH = 1
#: Measures, and those of them that can also be too low.
MEASURES = ("symbols", "dup_lines", "repeats", "word_length")
TWO_SIDED = ("word_length",)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(found: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of so many words that occurs twice or more in the text.

    Windows are compared by their 64-bit hash. Texts without a repeated hash end there; in others
    the windows are sorted by hash, so the work stays near linear for long repetitive texts."""
    starts = F.when(F.size(found) >= window, F.sequence(F.lit(1), F.size(found) - (window - 1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(found, i, window)))

    def starts_of_repeats(ordered: Column) -> Column:
        repeated = F.filter(ordered, lambda x, k: F.coalesce(F.get(ordered, k - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get(ordered, k + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(repeated, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        return F.aggregate(F.transform(at, lambda x, k: F.least(
            F.lit(window), F.coalesce(F.get(at, k + 1) - x, F.lit(window)))),
            F.lit(0), lambda total, x: total + x)

    def count(hashed: Column) -> Column:
        ordered = F.sort_array(F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return (F.when(F.coalesce(F.size(F.array_distinct(hashed)) == F.size(hashed), F.lit(True)), 0)
                .otherwise(let(let(ordered, starts_of_repeats), covered)))

    return let(hashes, count)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the base counts and base_failed."""
    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(content, "\n", -1), lambda line: line.rlike(WORD))
    counts = let(words(F.col(text)), lambda w: F.struct(
        F.size(w).alias("n_words"), F.length(F.array_join(w, "")).alias("word_chars"),
        repeated_words(w).alias("n_repeat_words")))
    repeats = let(lines, lambda x: F.struct(
        F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return (docs.withColumn("_words", counts).withColumn("_lines", repeats)
            .withColumns({name: F.col(f"_words.{name}").cast("bigint")
                          for name in ("n_words", "word_chars", "n_repeat_words")})
            .withColumns({name: F.col(f"_lines.{name}").cast("bigint") for name in ("n_lines", "n_dup_lines")})
            .withColumn("n_symbols", F.regexp_count(content, F.lit(SYMBOLS)).cast("bigint"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
            .drop("_words", "_lines"))


def _measures() -> Column:
    """Whole-number measures that do not depend on a text's length."""
    share = lambda part, whole: F.floor(1000 * F.col(part) / F.greatest(F.col(whole), F.lit(1)))
    values = {"symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
              "repeats": share("n_repeat_words", "n_words"),
              "word_length": F.floor(100 * F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)))}
    return F.array(*[F.struct(F.lit(name).alias("measure"), values[name].alias("value")) for name in MEASURES])


def rounded(value: Column) -> Column:
    """A whole number down to its six leading bits."""
    cut = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measures) -> counts per lang, source, measure and rounded value."""
    return (rows.select("lang", "source", F.explode("measures").alias("m")).select("lang", "source", "m.*")
            .withColumn("bucket", rounded(F.col("value")))
            .groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n")))


def quantiles(sketch: DataFrame, group: list[str]) -> DataFrame:
    """Merge sketches to the given group columns; documents, and by measure the low, middle and high quantile."""
    merged = sketch.groupBy(*group, "measure", "bucket").agg(F.sum("n").alias("n"))
    by_value = Window.partitionBy(*group, "measure").orderBy("bucket")
    whole = Window.partitionBy(*group, "measure")
    at = lambda k: F.min(F.when(100 * F.col("upto") >= k * F.col("total"), F.col("bucket")))
    limits = (merged.withColumn("upto", F.sum("n").over(by_value)).withColumn("total", F.sum("n").over(whole))
              .groupBy(*group, "measure")
              .agg(F.first("total").alias("documents"), at(LOW).alias("low"), at(MIDDLE).alias("middle"),
                   at(HIGH).alias("high")))
    return (limits.groupBy(*group).agg(
        F.first("documents").alias("documents"),
        F.map_from_entries(F.collect_list(F.struct("measure", F.struct("low", "middle", "high")))).alias("limits")))


def thresholds(sketch: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Fences per (lang, source): quantiles of the smallest group with enough documents, distances of the
    smallest such group that has one. A fence is null where no level has a distance."""
    own = quantiles(sketch, ["lang", "source"]).alias("own")
    by_lang = quantiles(sketch, ["lang"]).alias("by_lang")
    overall = quantiles(sketch.withColumn("all", F.lit(1)), ["all"]).alias("overall")
    levels = [F.when(F.col("own.documents") >= min_group, F.col("own.limits")),
              F.when(F.col("by_lang.documents") >= min_group, F.col("by_lang.limits")), F.col("overall.limits")]

    def fence(measure: str) -> Column:
        found = [level[measure] for level in levels]
        base = F.coalesce(*found)
        up = F.coalesce(*(F.nullif(x["high"] - x["middle"], F.lit(0)) for x in found))
        down = F.coalesce(*(F.nullif(x["middle"] - x["low"], F.lit(0)) for x in found))
        low = base["low"] - REACH * down if measure in TWO_SIDED else F.lit(None).cast("bigint")
        return F.struct(low.alias("low"), (base["high"] + REACH * up).alias("high"))

    limits = F.create_map(*[x for name in MEASURES for x in (F.lit(name), fence(name))])
    return (own.join(by_lang, same(F.col("own.lang"), F.col("by_lang.lang")))
            .withColumn("all", F.lit(1)).join(overall, "all")
            .select("own.lang", "own.source", limits.alias("limits")))


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
          source: str = "source", min_group: int = MIN_GROUP) -> DataFrame:
    """doc_id, base counts, base_failed, kept and the failed measures of every document.

    Null text counts as empty: it has no words and fails the base. Null lang or source form groups
    of their own. Repeated rows are judged each. Other columns are left out; an empty table gives no rows."""
    rows = staged(measured(docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"),
                                       F.col(source).alias("source"), F.col(text).alias("text")), "text")
                  .drop("text").withColumn("measures", _measures()), "rules")
    limits = thresholds(sketches(rows), min_group).alias("t")
    failed = F.transform(
        F.filter("measures", lambda m: F.coalesce(
            rounded(m["value"]) < F.col("t.limits")[m["measure"]]["low"], F.lit(False)) | F.coalesce(
            rounded(m["value"]) > F.col("t.limits")[m["measure"]]["high"], F.lit(False))),
        lambda m: m["measure"])
    return (rows.alias("d").join(limits, same(F.col("d.lang"), F.col("t.lang"))
                                 & same(F.col("d.source"), F.col("t.source")), "left")
            .select("d.doc_id", *BASE, "base_failed", failed.alias("failed"))
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
            .withColumn("failed", F.array_join("failed", ",")))

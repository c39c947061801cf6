"""Older raw encodings and field names, brought to the current raw columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, NumericType, StringType, StructType, TimestampType

from ratings_engine import schemas
from ratings_engine.functions.columns import strip
from ratings_engine.sources import storage

# Field names of both generations. Read as text, since older files quote numbers
# and mix types; a nested value is read as its JSON text.
REVIEW_FIELDS = (
    "rating", "title", "text", "asin", "parent_asin", "user_id", "timestamp", "helpful_vote",
    "verified_purchase", "overall", "summary", "reviewText", "reviewerID", "unixReviewTime",
    "helpful",
)
METADATA_FIELDS = (
    "main_category", "title", "average_rating", "rating_number", "price", "store", "categories",
    "parent_asin", "asin", "avg_rating", "num_reviews",
)
ROWS_PER_CATEGORY = 10_000
# Fields whose presence tells the generation of a record.
MARKS = ("overall", "main_category")
# End of fixed values.

_KEYS = "_keys"
# Python literals use single quotes, and a backslash before any character.
_LENIENT = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
# Strings without a step of the matcher per character, which a long text has no stack for.
_STRING = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
_TOKEN = _STRING + r"""|[^'"]+"""
#: What a piece outside strings has if it is not JSON yet.
_FOREIGN = r"""[()'"]|,\s*[\]}]|\b(?:None|True|False)\b|\b[uUbBrR]$"""
#: Set around strings to split a text there.
_CUT = "\x1f"


def _as_json(line: Column) -> Column:
    """JSON text of a Python literal: outside quotes None, True and False become JSON words, tuples
    arrays, and string prefixes, closing commas and lone quotes go; inside, escapes by \\x become those by \\u."""
    def outside(piece):
        def replaced(token, *rules):
            for pattern, by in rules:
                token = F.regexp_replace(token, pattern, by)
            return token

        words = replaced(piece, (r"\bNone\b", "null"), (r"\bTrue\b", "true"), (r"\bFalse\b", "false"))
        prefix = (r"""\b[uUbBrR](?=['"]|$)""", "")
        # Most pieces need no rule or few.
        return (F.when(~piece.rlike(_FOREIGN), piece)
                .when(piece.rlike(r"""[()'"]|,\s*[\]}]"""), replaced(
                    words, (r"\(", "["), (r",?\s*\)", "]"), (r",\s*([\]}])", "$1"), prefix, (r"""['"]""", "")))
                .when(piece.rlike(r"\b[uUbBrR]$"), replaced(words, prefix)).otherwise(words))

    def inside(token):
        return F.when(F.contains(token, F.lit("\\x")), F.regexp_replace(token, r"\\x([0-9A-Fa-f]{2})", r"\\u00$1")).otherwise(token)

    # Every second piece is a string. Splitting costs less than a match for every piece, which is left
    # for texts that have the character already.
    pieces = F.split(F.regexp_replace(line, f"({_STRING})", f"{_CUT}$1{_CUT}"), _CUT, -1)
    split = F.transform(pieces, lambda t, i: F.when(i % 2 == 1, inside(t)).otherwise(outside(t)))
    tokens = F.regexp_extract_all(line, F.lit(_TOKEN), F.lit(0))
    matched = F.transform(tokens, lambda t: F.when(t.rlike("^['\"]"), inside(t)).otherwise(outside(t)))
    return F.array_join(F.when(F.contains(line, F.lit(_CUT)), matched).otherwise(split), "")


#: Up to so many files of records over many lines, their names travel to every task.
FEW_FILES = 10_000
_PART = _STRING + r"""|[\[{(]|[\]})]|[^'"\[\]{}()]+"""
_END = "\x1e"
#: A line, strings made empty, that is one object with at most simple arrays and tuples in it.
_SIMPLE = r"""(?:[^\[\]{}()'"]++|""){0,500}+"""
_WHOLE = rf"""^\{{(?:[^\[\]{{}}()'"]++|""|\[{_SIMPLE}\]|\({_SIMPLE}\)){{0,500}}+\}}\s*,?\s*$"""


def _before(rows: DataFrame, value: str, name: str) -> DataFrame:
    """rows (file, block, place) with the sum of a column over all lines of the file before, as `name`.

    Lines are summed within their block of the file, blocks within the file, so no task sees more than a block."""
    blocks = rows.groupBy("file", "block").agg(F.sum(value).alias("_total"))
    earlier = F.sum("_total").over(Window.partitionBy("file").orderBy("block")) - F.col("_total")
    own = F.sum(value).over(Window.partitionBy("file", "block").orderBy("place")) - F.col(value)
    return (rows.join(blocks.select("file", "block", earlier.alias("_earlier")), ["file", "block"])
            .withColumn(name, own + F.col("_earlier")).drop("_earlier"))


def _records(lines: DataFrame) -> DataFrame:
    """(line): the texts of the records of files that are one array, or objects one behind the other.

    lines: file, block, place, line, base. Brackets outside strings give each line the depth it begins with;
    a record ends where a bracket leads back to `base`, the depth between records. Pieces of a record meet
    by file and record number. A file cut off in the middle keeps the records before. What is read twice,
    for the sums and behind them, is written once."""
    bare = F.regexp_replace("line", _STRING, '""')
    opened, closed = (F.length(F.regexp_replace("_bare", kept, "")) for kept in (r"[^\[{(]+", r"[^\]})]+"))
    turned = (lines.withColumn("_bare", bare).withColumn("_turn", opened - closed)
              .withColumn("_whole", F.col("_bare").rlike(_WHOLE)).drop("_bare"))
    placed = _before(storage.stage(turned, "lines")[0], "_turn", "_depth")

    def step(state, token):
        turn = F.when(token.isin("[", "{", "("), 1).when(token.isin("]", "}", ")"), -1).otherwise(0)
        depth, base = state["depth"], F.col("base")
        inside = F.when(F.greatest(depth, depth + turn) > base, token).otherwise("")
        end = F.when((turn < 0) & (depth > base) & (depth + turn == base), _END).otherwise("")
        return F.struct((depth + turn).alias("depth"), F.concat(state["text"], inside, end).alias("text"))

    tokens = F.regexp_extract_all("line", F.lit(_PART), F.lit(0))
    start = F.struct(F.col("_depth").cast("long").alias("depth"), F.lit("").alias("text"))
    # Most lines are a record each; only others are taken apart.
    alone = F.array(F.regexp_replace("line", r"[,\s]+$", ""), F.lit(""))
    cut = placed.withColumn("_parts", F.when(F.col("_whole") & (F.col("_depth") == F.col("base")), alone).otherwise(
        F.split(F.aggregate(tokens, start, step)["text"], _END)))
    ended = storage.stage(cut.select("file", "block", "place", "_parts", (F.size("_parts") - 1).alias("_ends")), "parts")[0]
    numbered = _before(ended, "_ends", "_record")
    parts = (numbered.select("file", "block", "place", "_record", F.posexplode("_parts").alias("k", "part"))
             .where("part <> ''"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "place", "k", "part")))
    return (parts.groupBy("file", (F.col("_record") + F.col("k")).alias("record"))
            .agg(F.array_join(F.transform(pieces, lambda p: p["part"]), "\n").alias("line")).select("line"))


def _texts(spark: SparkSession, path) -> DataFrame:
    """(line): one text per line of files of lines, one per record of files that are one array or object
    over many lines. Which kind a file is, its first line that is not blank tells: it opens an array
    it does not close, or is a lone brace."""
    filled = spark.read.text(path).select(
        strip(F.col("value")).alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place")).where("line <> ''")
    first = filled.groupBy("file").agg(F.min_by("line", F.struct("block", "place")).alias("first"))
    base = F.when(F.col("first").startswith("[") & ~F.col("first").endswith("]"), 1).when(F.col("first") == "{", 0)
    many, _ = storage.stage(first.select("file", base.alias("base")).where("base is not null"), "files")
    found = many.limit(FEW_FILES + 1).count()
    if not found:
        return filled.select("line").where("line not in ('null', 'None')")
    names = F.broadcast(many) if found <= FEW_FILES else many
    lines = filled.join(names, "file", "left_anti").select("line").where("line not in ('null', 'None')")
    return lines.unionByName(_records(filled.join(names, "file")))


def read_raw_any(spark: SparkSession, path, fields: Sequence[str]) -> DataFrame:
    """Records of JSON lines, Python-literal lines and JSON arrays, on one line or over many: one text
    column per field, and _keys, the fields among MARKS that each record has, null or not. How a file is
    written is found file by file. Blank lines, nulls and undecodable lines are left out.

    A line is parsed once. One that begins with a name in single quotes is read as a literal first, others
    only if they are no JSON, and only one that names a mark without giving it a value is parsed for its names."""
    record = "struct<" + ",".join(f"`{name}`:string" for name in fields) + ">"
    marks = [name for name in MARKS if name in fields]

    def parsed(text, kind):
        return F.from_json(text, kind, {**_LENIENT, "mode": "PERMISSIVE"})

    line = F.col("line")
    tried = _texts(spark, path).select(
        F.when(line.startswith("["), line).otherwise(F.concat(F.lit("["), line, F.lit("]"))).alias("text"))
    # An array of records is null for text that is no JSON. Names in single quotes tell a literal, for
    # which the first try mostly fails, at some cost.
    kind = f"array<{record}>"
    quoted = F.col("text").startswith("[{'")
    known = tried.withColumn("json", F.when(~quoted, parsed(F.col("text"), kind)))
    known = known.withColumn("items", F.coalesce("json", parsed(_as_json(F.col("text")), kind),
                                                 F.when(quoted, parsed(F.col("text"), kind))))

    def lacks(name):
        return F.contains("text", F.lit(name)) & F.exists("items", lambda item: item[name].isNull())

    unsure = reduce(Column.__or__, map(lacks, marks), F.lit(False))
    text = F.when(F.col("json").isNull(), _as_json(F.col("text"))).otherwise(F.col("text"))
    known = known.withColumn("maps", F.when(unsure, parsed(text, "array<map<string,string>>")))
    given = lambda item: F.array_compact(F.array(*[F.when(item[n].isNotNull(), n) for n in marks]))
    # Of a bare column Spark would infer a filter that parses once more.
    items = F.coalesce("items", F.array().cast(f"array<{record}>"))
    rows = known.select(F.posexplode(items).alias("k", "item"), "maps").where("item is not null")
    keys = F.when(F.col("maps").isNull(), given(F.col("item"))).otherwise(F.map_keys(F.get("maps", F.col("k"))))
    return rows.select("item.*", keys.alias(_KEYS))


def _or_empty(*columns: str) -> Column:
    """First of the columns that is neither null nor '', else ''."""
    return F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in columns), F.lit(""))


def _number(kind: str, *columns: str) -> Column:
    """First of the columns that is a number other than 0, else 0."""
    zero = F.lit(0).cast(kind)
    return F.coalesce(*(F.nullif(F.col(c).try_cast("double").cast(kind), zero) for c in columns),
                      zero)


def _whole(*columns: str) -> Column:
    """_number() for long values, which a double would round."""
    zero = F.lit(0).cast("long")
    return F.coalesce(*(F.nullif(F.coalesce(F.col(c).try_cast("long"), F.col(c).try_cast("decimal(38,9)").try_cast("long")),
                                 zero) for c in columns), zero)


def _choose(schema: StructType, older: Column, mapped: dict[str, Column]) -> list[Column]:
    """Per column the mapped value for older records, the value as it is for current ones."""
    def kept(field):
        if isinstance(field.dataType, ArrayType):
            return F.from_json(F.col(field.name), field.dataType)
        return F.col(field.name).try_cast(field.dataType)
    return [F.when(older, mapped[f.name]).otherwise(kept(f)).alias(f.name) for f in schema.fields]


def normalize_reviews(df: DataFrame) -> DataFrame:
    """Review records of read_raw_any() to the raw review columns.

    A record with `overall` is of the older kind; its time is in seconds."""
    votes = F.from_json(F.col("helpful"), ArrayType(StringType()))
    return df.select(*_choose(schemas.REVIEW_RAW, F.array_contains(_KEYS, "overall"), {
        "rating": F.col("overall").try_cast("double"),
        "title": _or_empty("summary"),
        "text": _or_empty("reviewText"),
        "asin": _or_empty("asin"),
        "parent_asin": _or_empty("parent_asin", "asin"),
        "user_id": _or_empty("reviewerID", "user_id"),
        "timestamp": _whole("unixReviewTime", "timestamp") * 1000,
        "helpful_vote": F.coalesce(
            F.when(F.col("helpful").startswith("["), F.get(votes, F.lit(0)).try_cast("long"))
            .otherwise(F.col("helpful_vote").try_cast("long")), F.lit(0)),
        "verified_purchase": F.coalesce(F.col("verified_purchase").try_cast("boolean"),
                                        F.lit(False)),
    }))


def normalize_metadata(df: DataFrame) -> DataFrame:
    """Metadata records of read_raw_any() to the raw metadata columns.

    A record without `main_category` is of the older kind; of nested category lists it keeps
    the first."""
    raw = F.col("categories")
    nested = F.from_json(raw, ArrayType(ArrayType(StringType())))
    flat = F.from_json(raw, ArrayType(StringType()))
    categories = F.coalesce(
        F.when(raw.rlike(r"^\[\s*\["), F.get(nested, F.lit(0))).otherwise(flat),
        F.array().cast("array<string>"))
    return df.select(*_choose(schemas.METADATA_RAW, ~F.array_contains(_KEYS, "main_category"), {
        "main_category": F.coalesce(F.get(categories, F.lit(0)), F.lit("")),
        "title": F.coalesce("title", F.lit("")),
        "average_rating": _number("double", "average_rating", "avg_rating"),
        "rating_number": _whole("rating_number", "num_reviews"),
        "price": _or_empty("price"),
        "store": F.coalesce("store", F.lit("")),
        "categories": categories,
        "parent_asin": _or_empty("parent_asin", "asin"),
    }))


# Rounds of the ranking of equal keys: how many groups a category is split into, round by round.
CAP_ROUNDS = (4096, 64, 1)
#: Shares of a category that its sketch gives a key for, and the sketch's accuracy: a rank is off by
#: at most rows / SKETCH.
SHARES = [2.0 ** -k for k in range(12, -1, -1)]
SKETCH = 10_000
#: Candidates of a category up to which no further sketch is drawn, and sketches at most.
ENOUGH_ROWS = 200_000
SKETCH_ROUNDS = 3
SKETCHED = (NumericType, DateType, TimestampType)


def _bounds(rows: DataFrame, n: int) -> DataFrame:
    """(category, bound, upto): a key below which at least n rows of the category lie, and how many
    do; null where the category has no such key but its last."""
    total = rows.groupBy("category").agg(
        F.count("key").alias("keys"), F.count("*").alias("total"),
        F.percentile_approx("key", [float(s) for s in SHARES], SKETCH).alias("guesses"))
    share = F.array(*[F.lit(s) for s in SHARES])
    wide = F.filter(F.arrays_zip(share.alias("share"), F.col("guesses").alias("guess")),
                    lambda x: x["share"] * F.col("keys") >= n + 2 * F.col("keys") / SKETCH + 1)
    guessed = total.select("category", "total", F.get(wide, F.lit(0))["guess"].alias("bound"))
    within = F.col("key").isNull() | F.col("bound").isNull() | (F.col("key") <= F.col("bound"))
    counted = _with(rows, guessed).groupBy("category").agg(
        F.first("total").alias("total"), F.first("bound").alias("bound"), F.count_if(within).alias("upto"))
    # The sketch only proposes: a bound counts if the exact number of rows says so.
    holds = F.col("upto") >= F.least(F.lit(n), F.col("total"))
    return counted.select("category", F.when(holds, F.col("bound")).alias("bound"),
                          F.when(holds, F.col("upto")).otherwise(F.col("total")).alias("upto"))


def _with(rows: DataFrame, by_category: DataFrame) -> DataFrame:
    """rows with the columns of the one row of their category; null where it has none."""
    return rows.join(by_category.withColumnRenamed("category", "_of"),
                     F.col("category").eqNullSafe(F.col("_of")), "left").drop("_of")


def _last_keys(rows: DataFrame, n: int) -> DataFrame:
    """(category, last, room, equal): the key of the category's n-th row, how many rows with this key
    are among the first n, and how many there are. No row for a category of fewer than n rows.

    rows: category and key. Sketches narrow them down to a few times n; only these are counted by key."""
    staged = []
    try:
        for _ in range(SKETCH_ROUNDS):
            bounds, path = storage.stage(_bounds(rows, n), "bounds")
            staged.append(path)
            rows = _with(rows, bounds).where(
                F.col("key").isNull() | F.col("bound").isNull() | (F.col("key") <= F.col("bound"))).select("category", "key")
            if bounds.where(F.col("upto") > F.greatest(F.lit(ENOUGH_ROWS), F.lit(4 * n))).isEmpty():
                break
        by_key = Window.partitionBy("category").orderBy(F.asc("key"))
        counts = rows.groupBy("category", "key").agg(F.count("*").alias("equal"))
        last = (counts.withColumn("_upto", F.sum("equal").over(by_key))
                .withColumn("room", n - F.col("_upto") + F.col("equal"))
                .where((F.col("_upto") >= n) & (F.col("room") > 0)))
        return storage.stage(last.select("category", F.col("key").alias("last"), "room", "equal"), "last")[0]
    finally:
        for path in staged:
            storage.delete(rows.sparkSession, path)


def _first_rows(df: DataFrame, n: Column, order: Sequence[Column], rounds: Sequence[int]) -> DataFrame:
    """The first n rows of each category, by ranking whole rows.

    A category is cut in rounds: first in many hashed groups, then in few, then as a whole. A
    row among the first n of its category is among the first n of each group it passes, so the
    result is exact, and no task sorts more than a share of a large category."""
    # The input partition is part of the hash, so exact copies do not all share a group.
    columns = df.columns
    df = df.withColumn("_group", F.xxhash64(*columns, F.spark_partition_id()))
    for parts in rounds:
        group = ["category"] + ([F.pmod("_group", F.lit(parts))] if parts > 1 else [])
        position = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        df = df.withColumn("_position", position).where(F.col("_position") <= n)
    return df.select(*columns)


def cap_per_category(df: DataFrame, n: int | None, key: str, then: Sequence[Column] = (),
                     rounds: Sequence[int] = CAP_ROUNDS) -> DataFrame:
    """The first n rows of each category by key, nulls first, and for equal keys in the order of then;
    None keeps everything.

    The key of each category's n-th row is found on categories and keys alone. Whole rows are then
    filtered where they are read: those with a smaller key stay. Only where more rows have exactly
    this key than there is room for are these rows ranked, so texts cross no shuffle otherwise. Keys
    that are no numbers, dates or times have no sketch; whole rows are ranked by them.

    df is read three times or four; a table or files, not a costly plan."""
    if n is None:
        return df
    if n <= 0:
        return df.where(F.lit(False))
    if not isinstance(df.schema[key].dataType, SKETCHED):
        return _first_rows(df, F.lit(n), [F.asc(key), *then], rounds)
    narrow, path = storage.stage(df.select("category", F.col(key).alias("key")), "cap")
    try:
        last = _last_keys(narrow, n)
    finally:
        storage.delete(df.sparkSession, path)
    crowded = F.col("equal") > F.col("room")
    limits = last.select("category", F.col("last").alias("_last"), F.col("room").alias("_room"),
                         crowded.alias("_crowded"))
    limited = _with(df, limits)
    equal = F.col(key).eqNullSafe(F.col("_last"))
    smaller = F.coalesce(F.col(key) < F.col("_last"), F.col(key).isNull() & F.col("_last").isNotNull())
    whole = limited.where(F.col("_room").isNull() | smaller | (equal & ~F.col("_crowded"))).select(*df.columns)
    if last.where(crowded).isEmpty():
        return whole
    ranked = _first_rows(limited.where(equal & F.col("_crowded")).drop("_last", "_crowded"), F.col("_room"),
                         list(then) or [F.asc(key)], rounds)
    return whole.unionAll(ranked.select(*df.columns))

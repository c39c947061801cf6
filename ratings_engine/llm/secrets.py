"""Secrets in texts, in DataFrame functions only.

Fixed patterns find keys with a known shape. For all other long runs of key characters, two
first-order character Markov models, one of random strings and one of ordinary identifiers, give a
log-likelihood ratio per character; runs above a threshold are secrets as well. What the patterns find
is cut out of a run and the pieces left are judged by themselves. The models are bigram counts of
labelled samples from all documents: random are what the patterns found and digests of
the texts, ordinary are words and identifiers made of neighbouring words in the usual styles (snake and
camel case, paths, numbered names). The threshold comes from labelled runs that the counts left out.
A model is a table over pairs of 67 characters, whatever the corpus.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratings_engine.llm.common import let

# Kinds in order, their patterns, group that counts and its least length.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
LEAST = 16
RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
IDENTIFIER = r"[A-Za-z_-]{6,}"
#: Natural-log odds per pair of characters that a run needs to count as random, where no labelled runs tell.
THRESHOLD = 0.25
#: One labelled run in so many is held out for the threshold; quantiles of the held-out ordinary and
#: random runs, between which it lies half-way.
HELD_OUT = 4
ORDINARY_BELOW, RANDOM_BELOW = 0.999, 0.01
#: Words in an identifier that is made for the sample, matches whose positions are summed at a time.
PARTS, CHUNK = 4, 64
#: A document gives one such identifier for so many words.
EVERY = 16
MASK = "[SECRET]"


def _positions(parts: Column, rank: int) -> Column:
    """Spans of matches given as (gap before, long, value), at least one.

    Lengths are summed in chunks, and chunks over their sums, so that arrays which grow stay short."""
    last = F.floor((F.size(parts) - 1) / CHUNK).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(parts, c * CHUNK + 1, F.lit(CHUNK)))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def starts(groups: Column) -> Column:
        sums = F.transform(groups, lambda g: F.aggregate(g, F.lit(0), lambda total, x: total + x["gap"] + x["long"]))
        return F.aggregate(sums, start, lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def step(s: Column, x: Column) -> Column:
        begin = s["at"] + x["gap"]
        return F.struct((begin + x["long"]).alias("at"), F.concat(s["out"], F.array(F.struct(
            begin.alias("start"), F.lit(rank).alias("rank"), (begin + x["long"]).alias("end"),
            x["value"].alias("value")))).alias("out"))

    def spread(groups: Column) -> Column:
        return let(starts(groups), lambda at: F.flatten(F.transform(groups, lambda g, i: F.aggregate(
            g, F.struct(F.get(at, i).alias("at"), _none().alias("out")), step, lambda s: s["out"]))))

    return let(chunks, spread)


def _spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """Leftmost non-overlapping matches as (start, rank, end, value), in code points.

    The pieces between the matches and the matches themselves give the positions."""
    pieces, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rank = KINDS.index(kind)

    def placed(row: Column) -> Column:
        parts = F.transform(row["hits"], lambda hit, i: F.struct(
            F.length(F.get(row["pieces"], i)).alias("gap"), F.length(hit).alias("long"), F.get(row["values"], i).alias("value")))
        return F.when(F.size(row["hits"]) == 0, _none()).otherwise(let(parts, lambda p: _positions(p, rank)))

    found = let(F.struct(pieces.alias("pieces"), hits.alias("hits"), values.alias("values")), placed)
    return F.filter(found, lambda s: F.length(s["value"]) >= least)


def _none() -> Column:
    return F.array().cast("array<struct<start:int,rank:int,end:int,value:string>>")


def base_spans(text: Column) -> Column:
    """What the fixed patterns find. A cheap necessary condition stands before each pattern."""
    assign = F.when(F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")),
                    _spans(text, ASSIGN, "assign", 2, 12)).otherwise(_none())
    access = F.when(F.contains(text, F.lit("AKIA")), _spans(text, ACCESS, "access", 0, 18)).otherwise(_none())
    hexed = F.when(text.rlike(HEX), _spans(text, HEX, "hex", 0, 16)).otherwise(_none())
    return F.sort_array(F.concat(assign, access, hexed))


def _identifiers(text: Column) -> Column:
    """Identifiers of PARTS neighbouring words, one every EVERY words, in a style that a hash of the words chooses."""
    def made(parts: Column) -> Column:
        lower, upper = F.transform(parts, F.lower), F.transform(parts, F.upper)
        capital = F.transform(parts, F.initcap)
        draw = F.pmod(F.xxhash64(parts), F.lit(1 << 40))
        number = lambda n: F.substr(F.conv(F.hex(draw * 7919 + 10 ** 9), 16, 10), F.lit(1), F.lit(n))
        head = F.slice(lower, 1, PARTS - 1)
        tail = F.array_join(F.slice(capital, 2, PARTS - 1), "")
        styles = [
            F.array_join(lower, "_"), F.array_join(lower, "-"), F.array_join(lower, "/"), F.array_join(upper, "_"),
            F.concat(lower[0], tail), F.array_join(capital, ""), F.concat(F.array_join(head, "/"), F.lit("/"), tail),
            F.concat(F.array_join(capital, ""), number(11)), F.concat(F.array_join(lower, "_"), F.lit("_"), number(2)),
            F.concat(F.array_join(head, "/"), number(1), F.lit("/"), lower[PARTS - 1], F.lit("_"), number(2)),
            F.concat(number(4), F.lit("-"), number(2), F.lit("-"), number(2), F.lit("-"), F.array_join(lower, "-")),
            F.concat(number(8), F.lit("-"), number(8)), F.concat(number(16), number(11)),
            F.concat(F.array_join(lower, "="), number(3))]
        chosen = (F.floor(draw / 64) % len(styles)).cast("int")
        return F.coalesce(*(F.when(chosen == k, style) for k, style in enumerate(styles)))

    def groups(words: Column) -> Column:
        return F.transform(F.when(F.size(words) >= PARTS, F.sequence(F.lit(1), F.size(words) - PARTS + 1, F.lit(EVERY))),
                           lambda i: let(F.slice(words, i, F.lit(PARTS)), made))

    return let(F.regexp_extract_all(text, F.lit("[A-Za-z]{2,}"), F.lit(0)), groups)


def default_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """(value, is_random) from all documents: values that the patterns found and digests of the texts
    are random; words outside what the patterns found, and identifiers made of them, are ordinary, as
    are runs of one character."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(content.alias("text"), base_spans(content).alias("spans"))
    digest = lambda salt: F.base64(F.unhex(F.sha2(F.concat(F.lit(salt), F.col("text")), 256)))
    random = rows.select(F.explode(F.concat(
        F.transform("spans", lambda s: s["value"]),
        F.array(digest("a"), F.regexp_replace(digest("b"), "[+/=]", ""), F.upper(digest("c"))))).alias("value"))
    # Long runs are what is to be judged: none counts as ordinary for lying in a document.
    words = rows.where(F.size("spans") == 0).withColumn("text", F.regexp_replace("text", RUN, " ")).select(F.explode(F.concat(
        F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0)),
        F.coalesce(_identifiers(F.col("text")), F.array().cast("array<string>")))).alias("value"))
    # Rulers and padding: one character over and over, in many lengths.
    size = len(ALPHABET)
    rulers = docs.sparkSession.range(0, size * (LEAST + 1), 1, 1).select(F.repeat(F.substr(
        F.lit(ALPHABET), (F.col("id") % size + 1).cast("int"), F.lit(1)), (LEAST + F.floor(F.col("id") / size)).cast("int")).alias("value"))
    return (random.withColumn("is_random", F.lit(True))
            .unionAll(rulers.withColumn("is_random", F.lit(False)))
            .unionAll(words.withColumn("is_random", F.lit(False))))


def fit(samples: DataFrame) -> tuple[list[float], float]:
    """(model, threshold) of labelled runs (value, is_random): counts of most of them, a threshold from
    the rest, chosen by a hash of the value. Without held-out runs of both labels it is THRESHOLD."""
    held = F.pmod(F.xxhash64("value", F.lit("held")), F.lit(HELD_OUT)) == 0
    model = train(samples.where(~held))
    scored = samples.where(held & F.col("value").rlike(rf"^{RUN}$")).select("is_random", score(F.col("value"), model).alias("score"))
    quantile = lambda label, q: F.percentile_approx(F.when(F.col("is_random") == label, F.col("score")), q, 100_000)
    row = scored.agg(quantile(False, ORDINARY_BELOW).alias("ordinary"), quantile(True, RANDOM_BELOW).alias("random")).first()
    if row.ordinary is None or row.random is None:
        return model, THRESHOLD
    return model, max(row.ordinary, (row.ordinary + row.random) / 2)


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of characters (row by row of the alphabet), with one added
    to every count. Pairs outside the alphabet do not count. Without samples every ratio is 0."""
    counts = (samples.select("is_random", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("value") - 1, F.lit(1))),
        lambda i: F.substr(F.col("value"), i, F.lit(2)))).alias("pair"))
        .where(F.length("pair") == 2).groupBy("is_random", "pair").count()
        .where(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$")).collect())
    size = len(ALPHABET)
    tables = {True: [1.0] * (size * size), False: [1.0] * (size * size)}
    for label, pair, n in counts:
        tables[label][ALPHABET.index(pair[0]) * size + ALPHABET.index(pair[1])] += n
    ratios = []
    for first in range(size):
        rows = {label: tables[label][first * size:(first + 1) * size] for label in tables}
        sums = {label: sum(rows[label]) for label in rows}
        ratios += [math.log(r / sums[True]) - math.log(o / sums[False])
                   for r, o in zip(rows[True], rows[False], strict=True)]
    return ratios


def log_ratio(run: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a run of alphabet characters."""
    table = F.from_json(F.lit(json.dumps([round(x, 6) for x in model])), "array<double>")
    place = lambda i: F.instr(F.lit(ALPHABET), F.substr(run, i, F.lit(1))) - 1
    return F.aggregate(F.sequence(F.lit(1), F.length(run) - 1), F.lit(0.0),
                       lambda total, i: total + F.get(table, place(i) * len(ALPHABET) + place(i + 1)))


def score(run: Column, model: list[float]) -> Column:
    """Log-likelihood ratio per pair of neighbouring characters."""
    return log_ratio(run, model) / F.greatest(F.length(run) - 1, F.lit(1))


def _blanked(text: Column, pattern: str, group: int, least: int) -> Column:
    """text with spaces for what the pattern finds."""
    def joined(row: Column) -> Column:
        def piece(before: Column, i: Column) -> Column:
            hit = F.get(row["hits"], i)
            blank = F.when(F.length(F.get(row["values"], i)) >= least, F.repeat(F.lit(" "), F.length(hit))).otherwise(hit)
            return F.concat(before, F.coalesce(blank, F.lit("")))
        return F.array_join(F.transform(row["pieces"], piece), "")

    hits = lambda g: F.regexp_extract_all(text, F.lit(pattern), F.lit(g))
    return let(F.struct(F.split(text, pattern, -1).alias("pieces"), hits(0).alias("hits"), hits(group).alias("values")), joined)


def _outside(run: Column, base: Column) -> Column:
    """The pieces of a run between what the patterns found, as spans of the run's rank."""
    touching = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))

    def piece(start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), run["rank"].alias("rank"), end.alias("end"),
                        F.substr(run["value"], start - run["start"] + 1, end - start).alias("value"))

    step = lambda s, b: F.struct(
        F.greatest(s["at"], b["end"]).alias("at"),
        F.when(b["start"] > s["at"], F.concat(s["out"], F.array(piece(s["at"], b["start"])))).otherwise(s["out"]).alias("out"))
    rest = lambda s: F.when(s["at"] < run["end"], F.concat(s["out"], F.array(piece(s["at"], run["end"])))).otherwise(s["out"])
    return F.when(F.size(touching) == 0, F.array(run)).otherwise(
        F.aggregate(touching, F.struct(run["start"].alias("at"), _none().alias("out")), step, rest))


def _markov_spans(text: Column, base: Column, model: list[float], threshold: float) -> Column:
    def runs(content: Column) -> Column:
        return F.when(content.rlike(RUN), _spans(content, RUN, "markov")).otherwise(_none())

    # Base spans apart from each other are blanked, kind by kind; where some overlap (an access key that
    # ends in hex digits, say) blanking one would change what the next pattern finds.
    overlap = F.size(F.filter(base, lambda x, i: F.coalesce(F.get(base, i + 1)["start"] < x["end"], F.lit(False)))) > 0
    rest = let(let(let(text, lambda t: _blanked(t, ASSIGN, 2, 12)), lambda t: _blanked(t, ACCESS, 0, 18)),
               lambda t: _blanked(t, HEX, 0, 16))
    cut = F.flatten(F.transform(runs(text), lambda r: _outside(r, base)))
    found = F.when(F.size(base) == 0, runs(text)).when(overlap, cut).otherwise(let(rest, runs))
    return F.filter(found, lambda r: (F.length(r["value"]) >= LEAST) & (score(r["value"], model) >= threshold))


def _model(docs: DataFrame, text: str, doc_id: str, model: list[float] | None,
           threshold: float | None) -> tuple[list[float], float]:
    learned = THRESHOLD
    if model is None:
        model, learned = fit(default_samples(docs, text))
    return model, learned if threshold is None else threshold


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", model: list[float] | None = None,
         threshold: float | None = None) -> DataFrame:
    """docs with _base and _spans: arrays of (start, rank, end, value), in code points, end exclusive.

    Null text is empty. Markov spans never overlap what the patterns found. Equal rows give equal
    spans, an empty table gives no rows. Input columns called _base or _spans give way; others pass
    unchanged. Without a model both model and threshold are learned from docs."""
    model, threshold = _model(docs, text, doc_id, model, threshold)
    content = F.coalesce(F.col(text), F.lit(""))
    return (docs.withColumn("_base", base_spans(content))
            .withColumn("_spans", F.sort_array(F.concat(
                F.col("_base"), _markov_spans(content, F.col("_base"), model, threshold)))))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", model: list[float] | None = None,
           threshold: float | None = None, mask: str = MASK) -> DataFrame:
    """docs with every secret masked; overlapping spans become one mask. Null text stays null, all other
    columns pass unchanged, whatever their names; an empty table gives no rows."""
    model, threshold = _model(docs, text, doc_id, model, threshold)
    content = F.coalesce(F.col(text), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, span: Column) -> Column:
        fresh = span["start"] >= s["at"]
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"), F.when(fresh, F.concat(
            s["out"], F.substr(content, s["at"] + 1, span["start"] - s["at"]), F.lit(mask)))
            .otherwise(s["out"]).alias("out"))

    def masked(spans: Column) -> Column:
        return F.when(F.size(spans) == 0, F.col(text)).otherwise(F.aggregate(spans, start, step, lambda s: F.concat(
            s["out"], F.substr(content, s["at"] + 1))))

    spans = let(base_spans(content), lambda base: F.sort_array(F.concat(base, _markov_spans(content, base, model, threshold))))
    return docs.withColumn(text, let(spans, masked))

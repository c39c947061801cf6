"""Read-only SQL over the Gold tables."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from ratings_engine import schemas
from ratings_engine.operators.gold import restrict
from ratings_engine.sources import storage, tables

# What a query may start with, must not contain and may return at most, and
# the days a relative period spans before its anchor.
READ_ONLY_STARTS = ("SELECT", "WITH")
FORBIDDEN = ("DROP", "DELETE", "UPDATE", "INSERT", "CREATE", "ALTER", "TRUNCATE", "MERGE")
ROW_CAP = 100
PERIODS = {"today": (0, 0), "yesterday": (1, 1), "last 7 days": (7, 1), "last month": (30, 1)}
# End of fixed values.

_QUOTED_OR_COMMENT = re.compile(
    r"""'(?:[^'\\]|\\.|'')*' | "(?:[^"\\]|\\.|"")*" | `(?:[^`]|``)*` | --[^\n]* | /\*.*?\*/""",
    re.VERBOSE | re.DOTALL)
_FORBIDDEN_WORD = re.compile(rf"\b({'|'.join(FORBIDDEN)})\b", re.IGNORECASE)


def register_views(spark: SparkSession, gold_root: str) -> list[str]:
    """Name the Gold tables that exist as temporary views; returns their names."""
    found = [t for t in schemas.GOLD_TABLES if storage.exists(spark, f"{gold_root}/{t.name}")]
    for table in found:
        tables.read_slice(spark, f"{gold_root}/{table.name}", table).createOrReplaceTempView(
            table.name)
    return [t.name for t in found]


def check_read_only(text: str) -> str:
    """The query without closing semicolons; ValueError unless it only reads.

    Words inside literals, quoted names and comments do not count."""
    query = text.strip().rstrip(";").rstrip()
    bare = _QUOTED_OR_COMMENT.sub(" ", query).strip()
    word = _FORBIDDEN_WORD.search(bare)
    if word:
        raise ValueError(f"only reading is allowed, found {word.group(1).upper()}")
    first = re.match(r"\w+", bare)
    if first is None or first.group().upper() not in READ_ONLY_STARTS:
        raise ValueError(f"a query must start with {' or '.join(READ_ONLY_STARTS)}")
    return query


def _refuse_writes(spark: SparkSession, query: str) -> None:
    """ValueError if Spark's parser finds a command or a statement that writes anywhere in it.

    The parser reads literals as Spark will run them, raw strings included."""
    node = "org.apache.spark.sql.catalyst.plans.logical."
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    kinds = [loader.loadClass(node + name) for name in ("Command", "ParsedStatement")]
    waiting = [spark._jsparkSession.sessionState().sqlParser().parsePlan(query)]
    while waiting:
        plan = waiting.pop()
        if any(kind.isInstance(plan) for kind in kinds):
            raise ValueError(f"only reading is allowed, found {plan.nodeName()}")
        for nested in (plan.children(), plan.innerChildren()):
            waiting += [nested.apply(i) for i in range(nested.size())]


def safe_sql(spark: SparkSession, text: str, cap: int = ROW_CAP) -> DataFrame:
    """Run a read-only query; at most `cap` rows come back whatever limits it has itself."""
    query = check_read_only(text)
    _refuse_writes(spark, query)
    return spark.sql(query).limit(cap)


def relative_bounds(name: str, anchor: date | str | None = None) -> tuple[date, date]:
    """First and last date of a named period before the anchor (by default today, in the zone of
    the active session)."""
    if name not in PERIODS:
        raise ValueError(f"unknown period {name}, expected one of {list(PERIODS)}")
    if anchor is None:
        session = SparkSession.getActiveSession()
        anchor = session.sql("select current_date()").first()[0] if session else date.today()
    day = date.fromisoformat(str(anchor))
    first, last = PERIODS[name]
    return day - timedelta(days=first), day - timedelta(days=last)


def relative_range(df: DataFrame, name: str, anchor: date | str | None = None) -> DataFrame:
    """Rows whose review_date lies in a named period."""
    return restrict(df, *relative_bounds(name, anchor))

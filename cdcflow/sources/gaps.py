"""Log reading that waits for numbers committed late.

A log numbers its rows when they are inserted, and they become visible when their
transaction commits: a row may appear below numbers that were read before. A position
alone would pass it by. Here the state of a log is the set of numbers not read yet, as
ranges: those missing between the numbers read, and one without an end behind them. Every
number is read in the pass in which it is first seen, whatever the order of commits.

State has one row per range: ``table_name``, ``gap_from``, ``gap_to`` (NULL: no end) and
``seen_at``, the latest log time that was known when the range was found to be missing.
A transaction that was rolled back leaves its numbers missing for good; ``forget_gaps``
gives up those that are old enough, and only the caller can say how old that is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcflow.session import new_dir
from cdcflow.sources.files import land_parquet

GAP_SCHEMA = "table_name string, gap_from bigint, gap_to bigint, seen_at timestamp"

#: Missing ranges are cut into about this many cells, besides one or two for each range.
CELLS = 1_000_000
#: Numbers are compared with their neighbours in groups of 2**16 at most.
_BITS = 16
_OF = "_gap_of"


def unread_from(spark: SparkSession, tables, first: int = 1) -> DataFrame:
    """State of logs nothing was read of, whose numbers begin at ``first``."""
    return spark.createDataFrame([(t, first, None, None) for t in tables], GAP_SCHEMA)


def unnumbered(log: DataFrame, first: int = 1, number: str = "log_id") -> DataFrame:
    """Rows no pass can return: without a number, or with one below the first."""
    return log.filter(F.col(number).isNull() | (F.col(number) < first))


def forget_gaps(unread: DataFrame, before) -> DataFrame:
    """State without the missing ranges found before a time; rows in them are given up."""
    return unread.filter(
        F.col("gap_to").isNull() | F.col("seen_at").isNull() | (F.col("seen_at") >= before)
    )


def read_unread(
    log: DataFrame,
    unread: DataFrame,
    table_name: str,
    number: str = "log_id",
    ts: str = "log_timestamp",
) -> tuple[DataFrame, DataFrame]:
    """Rows with numbers not read yet, and the next state of this log.

    The rows are landed first and both results come from there, so what arrives in the
    log meanwhile is in neither. Rows that share a number are read together or, if they
    appear later, not at all. A log without a state is an error: ``unread_from``.
    """
    mine = unread.filter(F.col("table_name") == table_name)
    size = F.col("gap_to") - F.col("gap_from") + 1
    known = mine.agg(
        F.max(F.when(F.col("gap_to").isNull(), F.col("gap_from"))).alias("ahead"),
        F.min(F.when(F.col("gap_to").isNotNull(), F.col("gap_from"))).alias("lowest"),
        F.max("gap_to").alias("highest"),
        F.sum(size.cast("decimal(38,0)")).alias("missing"),
    ).first()
    if known.ahead is None:
        raise ValueError(f"no state of {table_name}")
    n = F.col(number).cast("bigint")
    fresh = log.filter(n >= known.ahead).withColumn(_OF, F.lit(known.ahead))
    if known.missing:
        fresh = fresh.unionByName(_late(log, mine.filter("gap_to IS NOT NULL"), n, known))
    fresh = land_parquet(fresh, new_dir(log.sparkSession, "unread"))

    ends = F.array("gap_from", F.col("gap_to") + 2)  # read numbers around a range, plus 1
    around = mine.select(F.col("gap_from").alias(_OF), F.explode(ends).alias("n"))
    numbers = fresh.select(_OF, n.alias("n")).unionByName(
        around.filter("n IS NOT NULL").select(_OF, (F.col("n") - 1).alias("n"))
    )
    missing, reached = missing_ranges(numbers, _OF)
    latest = fresh.agg(F.max(F.col(ts).cast("timestamp"))).scalar()
    found = mine.filter("gap_to IS NOT NULL").select(F.col("gap_from").alias(_OF), "seen_at")
    aged = missing.join(found, _OF, "left")
    older = F.when(F.col(_OF) == known.ahead, latest).otherwise(F.col("seen_at"))
    name = F.lit(table_name).alias("table_name")
    closed = aged.select(name, "gap_from", "gap_to", older.alias("seen_at"))
    end = reached.filter(F.col(_OF) == known.ahead).select(
        name,
        (F.col("reached") + 1).alias("gap_from"),
        F.lit(None).cast("bigint").alias("gap_to"),
        F.lit(None).cast("timestamp").alias("seen_at"),
    )
    following = land_parquet(closed.unionByName(end), new_dir(log.sparkSession, "gaps"))
    return fresh.drop(_OF), following


def _late(log: DataFrame, gaps: DataFrame, n: Column, known) -> DataFrame:
    """Rows in missing ranges: both sides are dealt to cells of the number line and meet
    by equality of the cell. Few missing numbers make cells of one number each."""
    width = max(1, -(-int(known.missing) // CELLS))
    cell = lambda c: F.expr(f"`{c}` div {width}")
    cells = F.explode(F.sequence(cell("gap_from"), cell("gap_to")))
    pieces = gaps.select("gap_from", "gap_to", cells.alias("_gap_cell"))
    below = log.filter(n.between(known.lowest, known.highest))
    below = below.withColumn("_gap_n", n).withColumn("_gap_cell", cell("_gap_n"))
    inside = F.col("_gap_n").between(F.col("gap_from"), F.col("gap_to"))
    met = below.join(pieces, "_gap_cell").filter(inside)
    return met.select(*log.columns, F.col("gap_from").alias(_OF))


def missing_ranges(numbers: DataFrame, of: str) -> tuple[DataFrame, DataFrame]:
    """Ranges between the numbers ``n`` of each group that are not among them, as
    ``of, gap_from, gap_to``, and the highest number of each group as ``reached``.

    Neighbours are found without sorting the numbers as a whole: in cells of 2**16
    numbers, then between cells by their ends, and so on in four rounds. No group holds
    more than 2**16 members however many numbers there are, and the first round, the
    only one that meets them all, collects each number once.
    """
    cells = numbers.groupBy(of, F.shiftright("n", _BITS).alias("cell")).agg(
        F.array_sort(F.collect_set("n")).alias("ns")
    )
    members = F.transform("ns", lambda x: F.struct(x.alias("lo"), x.alias("hi")))
    first = cells.select(of, members.alias("members"))
    level = land_parquet(
        first.select(of, *_ends(), _holes().alias("holes")),
        new_dir(numbers.sparkSession, "number_cells"),
    )
    holes = [level.select(of, F.inline("holes"))]
    level = level.drop("holes")
    for bits in (2 * _BITS, 3 * _BITS, None):
        cell = F.lit(0) if bits is None else F.shiftright("lo", bits)
        grouped = level.groupBy(of, cell.alias("cell")).agg(
            F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("members")
        )
        holes.append(grouped.select(of, F.inline(_holes())))
        level = grouped.select(of, *_ends())
    found = holes[0]
    for more in holes[1:]:
        found = found.unionByName(more)
    return found, level.select(of, F.col("hi").alias("reached"))


def _ends() -> tuple[Column, Column]:
    first, last = F.get("members", F.lit(0)), F.element_at("members", -1)
    return first["lo"].alias("lo"), last["hi"].alias("hi")


def _holes() -> Column:
    """What lies between neighbouring members that are in order and do not overlap."""

    def between(member, i):
        before = F.get("members", i - 1)["hi"]
        return F.struct((before + 1).alias("gap_from"), (member["lo"] - 1).alias("gap_to"))

    # nothing is before the first member: its comparison is NULL, so it makes no hole
    return F.filter(F.transform("members", between), lambda h: h["gap_from"] <= h["gap_to"])

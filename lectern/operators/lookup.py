"""Small tables taken once, and the filters that their values put on a scan.

A batch of queries has few distinct terms and few hits next to the index.
:func:`settled` takes at most ``LIMIT`` rows of such a table and gives them
back as a local table, which the planner knows the size of; their values then
become literal filters on folders and sorted columns (:func:`any_of`,
:func:`bounded`), so a lookup opens the folders and pages that hold them.  A
table of more rows is left as it is and met by joins.
"""

from __future__ import annotations

import math
import uuid
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Rows of a table that may go through the driver while a query is planned.
LIMIT = 1 << 16
#: Values that a filter names one by one, and in a set.  With more, folders alone are chosen and a join does the rest.
LISTED, IN_A_SET = 64, 1024


def settled(df: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, pa.Table | None]:
    """(local table, its rows) if ``df`` has at most ``limit`` rows, else (df, None).

    Runs one job, unless ``df`` is a table that this function gave back."""
    known = getattr(df, "settled_rows", None)
    if known is not None:
        return df, known
    rows = df.limit(limit + 1).toArrow()
    if rows.num_rows > limit:
        return df, None
    local = df.sparkSession.createDataFrame(rows, df.schema)
    local.settled_rows = rows
    return local, rows


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it
    back (computed once, lineage cut, survives executor loss)."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/lectern-{name}-{uuid.uuid4().hex[:12]}"
    put(df.write, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """The shuffles of a query that runs inside are deleted when it ends; otherwise they
    fill the disk until the driver's garbage collector comes by."""
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def put(writer: DataFrameWriter, path: str) -> None:
    """Writes packed Parquet files, and leaves no shuffle behind."""
    with shuffles_freed(writer._spark):
        writer.option("compression", "zstd").parquet(path)


#: Bytes of input files, and rows of scored matches, that one task takes.
TASK_BYTES, TASK_ROWS = 4 << 20, 1 << 20
MOST_TASKS = 8192
#: Bytes of input files to a slice, and how many slices there are at most.
SLICE_BYTES, MOST_SLICES = 16 << 20, 6


def input_bytes(df: DataFrame) -> int | None:
    """The size of the files under a table, as the planner knows it (no job)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return size if size < 1 << 60 else None


def slices_for(df: DataFrame) -> int:
    """In how many slices a table is shuffled, one after the other, so that only
    the shuffles of one are on the disk."""
    return min(max(math.ceil((input_bytes(df) or 0) / SLICE_BYTES), 1), MOST_SLICES)


def slice_of(key: str, slices: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")


def sliced(df: DataFrame, key: str, slices: int) -> list[DataFrame]:
    """The rows of a table in slices by a key; those of one key stay together."""
    return [df] if slices == 1 else [df.where(slice_of(key, slices) == s) for s in range(slices)]


def tasks_for(df: DataFrame, share: float = 1) -> int | None:
    """The number of tasks for a ``share`` of the files under a table (None: their size isn't known)."""
    size = input_bytes(df)
    if size is None:
        return None
    size = math.ceil(size * share)
    return min(max(math.ceil(size / TASK_BYTES), min(math.ceil(size / (TASK_BYTES / 4)), 8), 1), MOST_TASKS)


def dealt_by_bytes(df: DataFrame, *keys: str, share: float = 1) -> DataFrame:
    """``df`` dealt by keys to so many tasks that one's share doesn't grow with the input.

    The number follows the size of the files under it, as the planner knows it
    (no job): a fixed one would have each task hold more the larger the input
    is, and one that the planner merges to its own liking much too large for
    what a text makes of its bytes once it is cut into terms.  ``share``: the
    part of the files that the rows come from."""
    tasks = tasks_for(df, share)
    return df.repartition(*keys) if tasks is None else df.repartition(tasks, *keys)


def dealt_by_rows(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, which has or gives ``rows`` rows, dealt by keys to tasks of some ``TASK_ROWS``."""
    return df.repartition(min(max(math.ceil(rows / TASK_ROWS), 1), MOST_TASKS), *keys)


def column(rows: pa.Table, name: str) -> list:
    """The distinct values of a column, sorted, without nulls."""
    return sorted({v for v in rows.column(name).to_pylist() if v is not None})


def either(conditions: list[Column]) -> Column:
    """Any of the conditions, as a balanced tree (never: an empty list)."""
    if not conditions:
        return F.lit(False)
    while len(conditions) > 1:
        conditions = [reduce(Column.__or__, conditions[k:k + 2]) for k in range(0, len(conditions), 2)]
    return conditions[0]


def any_of(col: Column, values: list) -> Column:
    """Holds where ``col`` is one of ``values``, in a form that reaches the pages
    of a sorted file; with very many values it holds everywhere."""
    if len(values) > IN_A_SET:
        return F.lit(True)
    return either([col == v for v in values]) if len(values) <= LISTED else col.isin(values)


def successor(prefix: str) -> str | None:
    """The least string above all that start with ``prefix`` (None: there is none)."""
    while prefix:
        code = ord(prefix[-1]) + 1
        if code <= 0x10FFFF:
            return prefix[:-1] + chr(0xE000 if 0xD800 <= code <= 0xDFFF else code)
        prefix = prefix[:-1]
    return None


def bounded(col: Column, kind: str, term: str | None, term2: str | None) -> Column:
    """The values that a prefix or range clause can take, as bounds on a sorted column."""
    lower, upper = (term, successor(term)) if kind == "prefix" else (term, term2)
    parts = [] if lower is None else [col >= lower]
    if upper is not None:
        parts.append(col < upper if kind == "prefix" else col <= upper)
    return reduce(Column.__and__, parts) if parts else F.lit(True)


# --- keys under which a vocabulary is stored a second time ------------------------

#: Signs at a term's start that deletions are taken of, and how many go.
DELETION_PREFIX, DELETIONS = 6, 2


def _without_one(s: Column) -> Column:
    """The strings that ``s`` leaves without one of its signs."""
    cut = F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))
    return F.when(F.length(s) >= 1, cut).otherwise(F.array().cast("array<string>"))


def deletion_keys(term: Column) -> Column:
    """What is left of the first ``DELETION_PREFIX`` signs without up to two of them.

    Two strings within two edits (an exchange of neighbours is one) share a
    key: each edit takes at most one sign from either, what is left of both is
    the same string, and cutting the longer of the two prefixes' rests to the
    shorter needs no further deletions than the other has had."""
    start = F.substring(term, 1, DELETION_PREFIX)
    ones = F.transform(F.array(start), _without_one)[0]
    twos = F.flatten(F.transform(ones, _without_one))
    return F.array_distinct(F.concat(F.array(start), ones, twos))


#: Signs for a term's start and end in its trigrams.
START, END = "\u0002", "\u0003"


def trigrams(term: Column) -> Column:
    """The distinct runs of three signs of a term, with signs for its start and end."""
    s = F.concat(F.lit(START), term, F.lit(END))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(s) - 2, F.lit(1))), lambda i: F.substring(s, i, F.lit(3))))


def needed_trigrams(kind: str, pattern: str) -> list[str]:
    """Trigrams that every match of a wildcard or regular expression has.

    Wildcards: the runs between ``*`` and ``?``.  Regular expressions: runs of
    letters and digits outside brackets that no quantifier follows; one with a
    group, an alternative, an escape or the like gives none and is tried on
    the whole vocabulary."""
    if kind == "wildcard":
        signs = [None if c in "*?" else c for c in pattern]
    elif any(c in pattern for c in "|()\\^$&~@#<>\""):
        return []
    else:
        signs, at = [], 0
        while at < len(pattern):
            c, at = pattern[at], at + 1
            if c == "[":
                end = pattern.find("]", at + 1)
                if end < 0:
                    return []
                c, at = None, end + 1
            elif not c.isalnum() and c not in "_-' ":
                c = None  # a dot, or something unknown
            if at < len(pattern) and pattern[at] in "*+?{":
                if pattern[at] == "{":
                    end = pattern.find("}", at)
                    if end < 0:
                        return []
                    at = end
                c, at = None, at + 1
            signs.append(c)
    out, padded = [], [START, *signs, END]
    for k in range(len(padded) - 2):
        if None not in padded[k:k + 3]:
            out.append("".join(padded[k:k + 3]))
    return sorted(set(out))

"""Quality rules: base counts of each text, then robust multivariate outliers.

Everything is DataFrame functions.  The base counts are computed inside the
row, without a shuffle.  For the texts that pass the base rules, a minimum-
covariance-determinant estimate per language and source is found by
concentration steps: from medians and deviations, the closest 75 % of a
group's rows give its mean and covariance, these give new distances, and so
on until no group's determinant falls by 5 % any more (``SETTLED``; at most
``STEPS`` steps); a last estimate is made of all rows within the 97.5 %
distance.  A row is kept if its squared Mahalanobis distance is at most
``CUTOFF``.

Shares are taken to the arc sine of their root, so that the step from 0 to
10 % counts as much as the step from 30 to 45 %.  Each statistic can reject a
text alone: against a group whose texts have none, that takes about 8 % of
symbols, 41 % of words in repeated windows, or 41 % of duplicate lines
(counted against ``MORE_LINES`` lines more than there are).

Quantiles come of counts of values in fixed steps, so one hot group is summed
up in many tasks and no group is ever held in one.

Defined cases: a null or empty text has no words and fails the base rules; a
null language or source is a group of its own; repeated rows are rows; a group
of n rows takes n / (n + 6) of its own covariance and the rest from the mean
variances within all groups, so a row alone in its group is kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import Scratch, join_groups

GAP = r"[\x20\x09-\x0D]"
STEPS, SETTLED, CORE = 8, 0.05, 0.75
# chi-square constants for five statistics: factors that undo the cut at 75 % and at 97.5 %, and the 97.5 % limit
CORE_FACTOR, FINAL_FACTOR, FINAL_LIMIT = 1.412, 1.056, 12.833
CUTOFF = 30.86  # the 99.999 % quantile
# least standard deviation of each transformed statistic, given the ones before it: about what chance
# gives a text of 50 words, and more for lines and repeats, as a repeated passage counts in both
FLOORS = {"size": 0.1, "length": 0.05, "symbols": 0.05, "lines": 0.125, "repeats": 0.125}
NAMES = list(FLOORS)
PRIOR = len(NAMES) + 1.0
# a share of few lines is drawn towards none: duplicate lines are counted against so many lines more
MORE_LINES = 10


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more."""
    def marked(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def places(s: Column) -> Column:
            last = F.size(s) - 1
            twin = lambda e, i: ((i > 0) & (F.get(s, i - 1)["x"] == e["x"])) | ((i < last) & (F.get(s, i + 1)["x"] == e["x"]))
            return F.sort_array(F.transform(F.filter(s, twin), lambda e: e["i"]))

        covered = lambda at: F.aggregate(  # noqa: E731  each window adds what the next one doesn't cover
            F.transform(at, lambda p, i: F.when(i + 1 < F.size(at), F.least(F.lit(3), F.get(at, i + 1) - p)).otherwise(3)), F.lit(0), lambda a, b: a + b)
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(let(ordered, places), covered))

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(2), F.size(h) - 1), lambda i: F.xxhash64(F.get(h, i - 2), F.get(h, i - 1), F.get(h, i)))

    # words and windows as 64-bit hashes: two of one text's n windows agree by chance with probability n^2 / 2^65
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 3, 0).otherwise(let(let(hashes, windows), marked))


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    counts = let(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)),
                 lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r")))
    out = docs.withColumn("__counts", counts).withColumn("__lines", counted)
    out = out.withColumns({
        "n_words": F.col("__counts.n").cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_lines": F.col("__lines.n").cast("long"),
        "n_dup_lines": F.col("__lines.dup").cast("long"),
        "n_repeat_words": F.col("__counts.r").cast("long"),
    }).drop("__counts", "__lines")
    return out.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def statistics() -> dict[str, Column]:
    """The transformed statistics of a text that passes the base rules."""
    n = F.col("n_words")

    def share(part: str, whole: Column) -> Column:
        return F.asin(F.sqrt(F.least(F.col(part) / whole, F.lit(1.0))))

    return {
        "size": F.log(n),
        "length": F.log(F.col("word_chars") / n),
        "symbols": share("n_symbols", F.col("word_chars")),
        "lines": share("n_dup_lines", F.col("n_lines") + MORE_LINES),
        "repeats": share("n_repeat_words", n),
    }


def _medians(rows: DataFrame) -> DataFrame:
    """(group, m_<name>, s_<name>): median and scaled median deviation, in steps of 1/64."""
    named = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.round(F.col(c) * 64).cast("long").alias("step")) for c in NAMES))).alias("v")
    counts = rows.select("group", named).groupBy("group", "v.name", "v.step").agg(F.count("*").alias("c"))
    keys = ["group", "name"]

    def median(table: DataFrame, value: str, name: str) -> DataFrame:
        w = Window.partitionBy(*keys)
        placed = table.select(*keys, value, F.sum("c").over(w.orderBy(value)).alias("upto"), F.sum("c").over(w).alias("all"))
        return placed.where("2 * upto >= all").groupBy(*keys).agg(F.min(value).alias(name))

    middle = median(counts, "step", "mid")
    away = counts.join(middle, keys).select(*keys, "mid", "c", F.abs(F.col("step") - F.col("mid")).alias("off"))
    spread = median(away.groupBy(*keys, "off").agg(F.sum("c").alias("c")), "off", "mad")
    both = middle.join(spread, keys)
    pick = lambda name, value: F.max(F.when(F.col("name") == name, F.col(value)))
    return both.groupBy("group").agg(*(x for c in NAMES for x in ((pick(c, "mid") / 64).alias(f"m_{c}"), F.greatest(1.4826 * pick(c, "mad") / 64, F.lit(FLOORS[c])).alias(f"s_{c}"))))


def _core(rows: DataFrame) -> DataFrame:
    """The rows (.., d2) of the closest 75 % of each group, to a step of the distance."""
    stepped = rows.withColumn("step", F.floor(16 * F.log2(F.col("d2") + 1e-6)))
    counts = stepped.groupBy("group", "step").agg(F.count("*").alias("c"))
    w = Window.partitionBy("group")
    limit = (counts.select("group", "step", F.sum("c").over(w.orderBy("step")).alias("upto"), F.sum("c").over(w).alias("all"))
             .where(F.col("upto") >= CORE * F.col("all")).groupBy("group").agg(F.min("step").alias("limit")))
    return join_groups(stepped, limit, ["group"]).where("step <= limit").drop("step", "limit")


def _estimate(rows: DataFrame, factor: float) -> DataFrame:
    """(group, m_<name>, l<i><j>: the covariance's lower triangular root, logdet) of the rows."""
    p = range(len(NAMES))
    # plain sums keep the shuffled rows small; the values are of order one, and no variance counts that is under its floor
    sums = rows.groupBy("group").agg(F.count("*").alias("n"), *((F.sum(c) / F.count("*")).alias(f"m_{c}") for c in NAMES),
                                     *((F.sum(F.col(NAMES[i]) * F.col(NAMES[j])) / F.count("*")).alias(f"e{i}{j}") for i in p for j in p if j <= i))
    sums = sums.select("group", "n", *(f"m_{c}" for c in NAMES), *((F.col(f"e{i}{j}") - F.col(f"m_{NAMES[i]}") * F.col(f"m_{NAMES[j]}")).alias(f"c{i}{j}") for i in p for j in p if j <= i))
    # one row: the mean variances within the groups
    within = sums.agg(*((F.sum(F.col("n") * F.col(f"c{i}{i}")) / F.sum("n")).alias(f"w{i}") for i in p))
    share = F.col("n") / (F.col("n") + PRIOR)
    cov = sums.crossJoin(F.broadcast(within)).select("group", *(f"m_{c}" for c in NAMES), *(
        (factor * (share * F.col(f"c{i}{j}") + ((1 - share) * F.col(f"w{i}") if i == j else 0.0))).alias(f"c{i}{j}") for i in p for j in p if j <= i))
    for i in p:  # Cholesky, a row of the root at a time
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            root = F.sqrt(F.greatest(rest, F.lit(FLOORS[NAMES[i]] ** 2))) if i == j else rest / F.col(f"l{j}{j}")
            cov = cov.withColumn(f"l{i}{j}", root)
    logdet = sum((2 * F.log(f"l{i}{i}") for i in p), F.lit(0.0))
    return cov.withColumn("logdet", logdet).drop(*(f"c{i}{j}" for i in p for j in p if j <= i))


def _fall(before: DataFrame, after: DataFrame) -> float:
    """By how much the logarithm of a group's determinant fell at most."""
    both = before.select("group", F.col("logdet").alias("was")).join(after.select("group", "logdet"), "group")
    return both.agg(F.max(F.col("was") - F.col("logdet"))).first()[0] or 0.0


def _distances(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """``rows`` with d2, the squared Mahalanobis distance."""
    p = range(len(NAMES))
    out = join_groups(rows.drop("d2"), estimate, ["group"])
    for i in p:
        rest = F.col(NAMES[i]) - F.col(f"m_{NAMES[i]}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"y{k}")
        out = out.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    d2 = F.col("y0") * F.col("y0")
    for i in p[1:]:
        d2 = d2 + F.col(f"y{i}") * F.col(f"y{i}")
    return out.select(*(c for c in rows.columns if c != "d2"), d2.alias("d2"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *,
          cutoff: float = CUTOFF, steps: int = STEPS) -> DataFrame:
    """Per row: doc, the base counts, base_failed, d2 (null where that is true) and kept."""
    scratch = Scratch(docs.sparkSession, "rules")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"),
                         F.struct(F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source")).alias("g"))
    counted = base_counts(narrow).drop("text").withColumn("group", F.coalesce(F.to_json("g"), F.lit("{}"))).drop("g")
    counted = scratch.keep(counted, "counts")
    passed = counted.where(~F.col("base_failed"))
    rows = passed.select("doc", "group", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", *(c.alias(k) for k, c in statistics().items()))
    start = _medians(rows)
    first = join_groups(rows, start, ["group"])
    d2 = F.lit(0.0)
    for c in NAMES:
        z = (F.col(c) - F.col(f"m_{c}")) / F.col(f"s_{c}")
        d2 = d2 + z * z
    now = first.select(*rows.columns, d2.alias("d2"))
    before = None
    for _ in range(steps):
        estimate = scratch.keep(_estimate(_core(now), CORE_FACTOR), "core")
        now = _distances(rows, estimate)
        if before is not None and _fall(before, estimate) < SETTLED:
            break
        before = estimate
    estimate = scratch.keep(_estimate(now.where(F.col("d2") <= FINAL_LIMIT), FINAL_FACTOR), "final")
    judged = _distances(rows, estimate).drop(*NAMES, "group").withColumn("base_failed", F.lit(False))
    failed = counted.where("base_failed").drop("group").withColumn("d2", F.lit(None).cast("double"))
    return judged.unionByName(failed).withColumn("kept", F.coalesce(F.col("d2") <= cutoff, F.lit(False)))

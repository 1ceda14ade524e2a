"""Quality classifier: an interpolated modified Kneser-Ney model of byte n-grams.

The model is counted over the whole text of all trusted documents (labels
quality 1, toxic 0).  Counts, continuation counts, context totals, discounts
and the interpolated probabilities are tables made by aggregates and joins
that Spark shards by n-gram.

Scoring reads every document once, without shuffling its text.  The model's
entries with the largest counts, at most ``cache_entries`` of them (all, where
they fit), are broadcast; an n-gram that they don't settle becomes a row that
meets its part of the full model in a sharded lookup: rows and model go to
tasks by the two symbols before the last, which every order from three up has
in common.  The sums of both are a document's log-probability.

Two figures come of it: ``perplexity`` (2 to the mean surprisal of a byte) and
``excess`` (mean of the surprisal above ``SPIKE`` bits: a few foreign words in
a long text raise it where the mean hardly moves).  Per language, mean and
scale of both follow the logarithm of the length (two regressions each, on
trusted documents).  A document is rejected if the standardised distance of
either from its mean exceeds the quantile that trusted documents of its
language and length class have; a class with few of them is merged with its
neighbours, one more on both sides at a time, until they hold enough.  A
language with few trusted documents goes by all languages, also by length.
The quantiles are of out-of-fold scores: trusted documents
are dealt into ``FOLDS`` folds by a hash of the id, and each is scored by a
model whose counts are all but its fold's.

Defined cases: null and empty texts have perplexity 1 and are kept; a null
language is a language of its own; repeated rows and null ids are scored row
by row; without trusted documents nothing is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import Scratch, join_groups

ORDER, SPIKE, CACHE = 5, 8.0, 1 << 20
QUANTILES = {"perplexity": 0.998, "excess": 0.99}
LEAST_TRUSTED = 100
FOLDS = 4  # of trusted documents: a limit is taken of scores by models that haven't seen the document
ENTRY = ("model", "order", "weight", "key", "value")
SALTS, FOLD_SALTS = 8, 2  # a frequent pair of symbols is dealt to so many tasks, each with its part of the model
ALL = "\0all"  # the group of all languages
BLOOM_WORDS = 1 << 17  # 64-bit words of the Bloom filter of trusted ids: 1 MB


def packed_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte's n-gram (itself and the bytes before it, zeros before the start), and each text's start."""
    pad = b"\0" * (ORDER - 1)
    x = np.frombuffer(b"".join(pad + t for t in texts), dtype=np.uint8).astype(np.int64)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    if not len(x):
        return x, starts
    grams = np.zeros(len(x) - ORDER + 1, dtype=np.int64)
    for k in range(ORDER):
        grams = grams << 8 | x[k:len(x) - ORDER + 1 + k]
    keep = np.ones(len(grams), dtype=bool)  # leaves out what ends in a later text's padding
    for k in range(ORDER - 1):
        keep[(starts + (ORDER - 1) * np.arange(len(texts)) + k - (ORDER - 1))[1:]] = False
    return grams[keep], starts


def portions(texts: list[bytes | None], size: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) of about ``size`` bytes together."""
    at, held, total = 0, [], 0
    for k, text in enumerate(texts):
        held.append(text or b"")
        total += len(held[-1])
        if total >= size:
            yield at, held
            at, held, total = k + 1, [], 0
    if held:
        yield at, held


class Table:
    """An open-addressing hash table of int64 keys with vectorised lookups."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << self.bits, dtype=np.float32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot] == -1
            taken, first = np.unique(slot[free], return_index=True)
            who = left[free][first]
            self.keys[taken], self.values[taken] = keys[who], values[who]
            rest = np.ones(len(left), dtype=bool)
            rest[np.flatnonzero(free)[first]] = False
            left, slot = left[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, x: np.ndarray) -> np.ndarray:
        return ((x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, found); the value is 0 where nothing is found."""
        slot = self._slot(x)
        at = self.keys[slot]
        found = at == x
        values = np.where(found, self.values[slot], np.float32(0))
        open_ = np.flatnonzero(~found & (at != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at = self.keys[slot[open_]]
            hit = open_[at == x[open_]]
            found[hit], values[hit] = True, self.values[slot[hit]]
            open_ = open_[(at != x[open_]) & (at != -1)]
        return values, found


class Model:
    """Entries of the model: log2 probabilities by order and n-gram, log2 back-off weights by order and context."""

    def __init__(self, order: np.ndarray, weight: np.ndarray, key: np.ndarray, value: np.ndarray, complete: bool):
        self.complete = complete
        pick = lambda k, w: (order == k) & (weight == w)
        self.probs = {k: Table(key[pick(k, False)], value[pick(k, False)]) for k in range(1, ORDER + 1)}
        self.weights = {k: Table(key[pick(k, True)], value[pick(k, True)]) for k in range(1, ORDER + 1)}

    def surprisal(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bits, settled): not settled is what needs an entry that may exist elsewhere."""
        bits, settled = np.zeros(len(grams), dtype=np.float32), np.ones(len(grams), dtype=bool)
        left, back = np.arange(len(grams)), np.zeros(len(grams), dtype=np.float32)
        for k in range(ORDER, 0, -1):
            tail = grams[left] & ((1 << 8 * k) - 1)
            p, found = self.probs[k].find(tail)
            bits[left[found]] = -(back[found] + p[found])
            left, back, tail = left[~found], back[~found], tail[~found]
            if k > 2 and not self.complete:
                settled[left] = False
                return bits, settled
            back = back + self.weights[k].find(tail >> 8)[0]  # an unseen context has weight 1
        bits[left] = 8 - back
        return bits, settled


class Cached:
    """Models by number, as the columns of their entries; a task's process puts the tables together
    when it first needs them, so that the driver holds and sends no more than the columns."""

    def __init__(self, columns: list[np.ndarray], complete: dict[int, bool]):
        self.columns, self.complete, self.made = columns, complete, None

    def models(self) -> dict[int, Model]:
        if self.made is None:
            self.made = {m: _model(self.columns, m, whole) for m, whole in self.complete.items()}
            self.columns = None
        return self.made


def _mask(k: int) -> int:
    return (1 << 8 * k) - 1


def trusted_documents(docs: DataFrame, trusted_ids: DataFrame, more: list[str] | None = None) -> DataFrame:
    """(doc, text, and the string columns ``more``) of the documents whose id is in ``trusted_ids``.

    A Bloom filter of fixed size, put together by Spark, spares most other
    texts the shuffle of the exact join that follows.
    """
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).cast("long").alias("doc")).where("doc is not null").distinct()
    places = [F.pmod(F.xxhash64("doc", F.lit(seed)), F.lit(BLOOM_WORDS * 64)) for seed in range(3)]
    words = (ids.select(F.explode(F.array(*places)).alias("place")).groupBy(F.floor(F.col("place") / 64).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(place, 64) as int))")).alias("bits")))
    rows = words.toArrow()  # at most BLOOM_WORDS rows
    bits = np.zeros(BLOOM_WORDS, dtype=np.int64)
    bits[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            maybe = np.ones(batch.num_rows, dtype=bool)
            for name in ("p0", "p1", "p2"):
                place = batch.column(name).to_numpy(zero_copy_only=False)
                maybe &= (held.value[place >> 6] >> (place & 63) & 1).astype(bool)
            yield batch.select(names).filter(pa.array(maybe))

    names = ["doc", "text", *(more or [])]
    narrow = docs.where("doc is not null and text is not null")
    likely = narrow.select(*names, *(p.alias(f"p{k}") for k, p in enumerate(places))).mapInArrow(run, "doc long, " + ", ".join(f"{c} string" for c in names[1:]))
    return likely.join(ids.hint("merge"), "doc", "left_semi")


def gram_counts(docs: DataFrame, most: int = 1 << 20) -> DataFrame:
    """(fold, gram, c) over all texts (fold, text); each task adds up what it reads before it sends it on."""

    def run(batches):
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)

        def merged(parts):
            k = np.concatenate([p[0] for p in parts])
            c = np.concatenate([p[1] for p in parts])
            u, place = np.unique(k, return_inverse=True)
            return u, np.bincount(place, weights=c, minlength=len(u)).astype(np.int64)

        waiting, size = [], 0
        for batch in batches:
            folds = batch.column("fold").to_numpy()
            for at, texts in portions(batch.column("text").cast(pa.binary()).to_pylist()):
                own = np.repeat(folds[at:at + len(texts)].astype(np.int64), [len(t) for t in texts])
                waiting.append(np.unique(packed_grams(texts)[0] | own << 8 * ORDER, return_counts=True))
                size += len(waiting[-1][0])
                if size > most:
                    keys, counts = merged([(keys, counts), *waiting])
                    waiting, size = [], 0
                    if len(keys) > most:
                        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["gram", "c"])
                        keys, counts = keys[:0], counts[:0]
        keys, counts = merged([(keys, counts), *waiting])
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["gram", "c"])

    counts = docs.select("fold", "text").mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))
    return counts.select(F.shiftright("gram", 8 * ORDER).cast("int").alias("fold"), F.col("gram").bitwiseAND(F.lit(_mask(ORDER))).alias("gram"), "c")


def fold_of(doc: Column, folds: int) -> Column:
    """The fold of an id, from 0."""
    return F.pmod(F.xxhash64(doc, F.lit("fold")), F.lit(folds)).cast("int")


def left_out(counts: DataFrame, folds: int) -> DataFrame:
    """(model, gram, c) of counts (fold, gram, c): model 0 has them all, model k those of the folds but k - 1."""
    if folds < 2:
        return counts.select(F.lit(0).alias("model"), "gram", "c")
    own = [F.sum(F.when(F.col("fold") == k, F.col("c")).otherwise(0)).alias(f"own{k}") for k in range(folds)]
    sums = counts.groupBy("gram").agg(F.sum("c").alias("all"), *own)
    models = [F.struct(F.lit(0).alias("model"), F.col("all").alias("c"))]
    models += [F.struct(F.lit(k + 1).alias("model"), (F.col("all") - F.col(f"own{k}")).alias("c")) for k in range(folds)]
    return sums.select("gram", F.explode(F.array(*models)).alias("m")).select("m.model", "gram", "m.c").where("c > 0")


def _discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ of the modified method from the numbers of n-grams seen once to four times."""
    if min(n) == 0:
        return [0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [max(0.0, (j + 1) - (j + 2) * y * n[j + 1] / n[j]) for j in range(3)]


def train(trusted: DataFrame, scratch: Scratch, folds: int = 1) -> DataFrame:
    """The models' entries (model, order, weight, key, value, c): model 0 of all rows (doc, text), and with two ``folds`` or more model k without the fold k - 1."""
    dealt = trusted.select("text", (fold_of(F.col("doc"), folds) if folds > 1 else F.lit(0)).alias("fold"))
    counts = {ORDER: scratch.keep(left_out(gram_counts(dealt), folds), "counts")}
    for k in range(ORDER - 1, 0, -1):
        tail = F.col("gram").bitwiseAND(F.lit(_mask(k)))
        counts[k] = scratch.keep(counts[k + 1].groupBy("model", tail.alias("gram")).agg(F.count("*").alias("c")), f"counts{k}")
    every = None
    for k, table in counts.items():
        one = table.groupBy("model").agg(F.lit(k).alias("k"), *(F.count_if(F.col("c") == j).alias(f"n{j}") for j in (1, 2, 3, 4)))
        every = one if every is None else every.unionByName(one)
    discounts = {(r["k"], r["model"]): _discounts([r["n1"], r["n2"], r["n3"], r["n4"]]) for r in every.collect()}  # a row per order and model
    lower, kept = None, []
    for k in range(1, ORDER + 1):
        models = range(folds + 1 if folds > 1 else 1)
        d1, d2, d3 = (F.get(F.array(*(F.lit(discounts.get((k, m), _discounts([0]))[j]) for m in models)), F.col("model")) for j in range(3))
        off = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        grams = counts[k].withColumn("context", F.shiftright("gram", 8)).withColumn("off", off)
        head = ["model", F.lit(k).alias("order")]
        contexts = grams.groupBy("model", "context").agg(F.sum("c").alias("total"), (F.sum("off") / F.sum("c")).alias("g"))
        contexts = scratch.keep(contexts.select(*head, F.lit(True).alias("weight"), F.col("context").alias("key"), F.col("total").alias("c"), F.col("g").alias("p")), f"contexts{k}")
        seen = grams.join(contexts.select("model", F.col("key").alias("context"), F.col("c").alias("total"), F.col("p").alias("g")), ["model", "context"])
        if lower is None:
            seen = seen.withColumn("low", F.lit(1 / 256))
        else:
            seen = seen.withColumn("tail", F.col("gram").bitwiseAND(F.lit(_mask(k - 1)))).join(lower.select("model", F.col("key").alias("tail"), F.col("p").alias("low")), ["model", "tail"])
        p = (F.col("c") - F.col("off")) / F.col("total") + F.col("g") * F.col("low")
        lower = scratch.keep(seen.select(*head, F.lit(False).alias("weight"), F.col("gram").alias("key"), "c", p.alias("p")), f"probs{k}")
        kept += [lower, contexts]
    # tables of one form, so that all orders are one scan wherever they are read
    value = F.log2(F.when(F.col("weight"), F.greatest("p", F.lit(1e-9))).otherwise(F.col("p"))).cast("float")
    return scratch.together(kept).select("model", "order", "weight", "key", value.alias("value"), "c")


def cached_models(entries: DataFrame, most: int) -> Cached:
    """Of each model all entries of the orders one and two, and the others from the count on from which at most ``most`` are left (of the models without a fold, together half of it)."""
    large = entries.where("order > 2")
    sizes: dict[int, list] = {}
    for r in large.groupBy("model", F.floor(F.log2("c")).alias("b")).count().collect():  # some tens of rows a model
        sizes.setdefault(r["model"], []).append((r["b"], r["count"]))
    chosen, complete = F.col("order") <= 2, {}
    for m, own in sizes.items():
        least, total = None, 0
        for b, count in sorted(own, reverse=True):
            if total + count > (most if m == 0 else most // (2 * (len(sizes) - 1))):
                break
            least, total = b, total + count
        complete[m] = total == sum(count for _, count in own)
        if least is not None:
            chosen = chosen | ((F.col("model") == m) & (F.floor(F.log2("c")) >= least))
    columns = _columns([entries.where(chosen).select(*ENTRY).toArrow()])
    return Cached(columns, complete)


def _columns(parts: list[pa.Table]) -> list[np.ndarray]:
    whole = pa.concat_tables(parts)
    return [whole.column(c).to_numpy() for c in ENTRY]


def _model(columns: list[np.ndarray], number: int, complete: bool) -> Model:
    own = columns[0] == number
    return Model(*(c[own] for c in columns[1:]), complete)


def _surprisal(models: dict[int, Model], of: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, settled) of n-grams, each by its own model ``of``."""
    bits, settled = np.full(len(grams), 8, dtype=np.float32), np.ones(len(grams), dtype=bool)
    for m in np.unique(of).tolist():
        if m in models:  # a model without entries gives every byte 8 bits
            own = np.flatnonzero(of == m)
            bits[own], settled[own] = models[m].surprisal(grams[own])
    return bits, settled


def _hot(docs: DataFrame, held: Broadcast) -> DataFrame:
    """(uid, doc, lang, model, n, bits, excess, cold): what the cached entries settle, and the n-grams that they don't.  ``held``: a :class:`Cached`."""

    def run(batches):
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for first in range(0, batch.num_rows, 512):
                for at, part in portions(texts.slice(first, 512).to_pylist()):
                    n = np.array([len(t) for t in part], dtype=np.int64)
                    sums = np.zeros((2, len(part)))
                    cold = [None] * len(part)
                    grams, starts = packed_grams(part)
                    if len(grams):
                        of = np.repeat(batch.column("model").to_numpy()[first + at:first + at + len(part)], n)
                        bits, settled = _surprisal(held.value.models(), of, grams)
                        ends = np.concatenate((starts, [len(grams)]))
                        for row, values in enumerate((bits, np.maximum(bits - SPIKE, 0) * settled)):
                            total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
                            sums[row] = total[ends[1:]] - total[ends[:-1]]
                        if not settled.all():
                            cold = [grams[a:b][~settled[a:b]] for a, b in zip(ends[:-1], ends[1:])]
                    own = batch.slice(first + at, len(part))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.arange(uid, uid + len(part))), own.column("doc"), own.column("lang"), own.column("model"), pa.array(n), pa.array(sums[0]), pa.array(sums[1]), pa.array(cold, pa.list_(pa.int64()))],
                        names=["uid", "doc", "lang", "model", "n", "bits", "excess", "cold"])
                    uid += len(part)

    return docs.select("doc", "lang", "model", "text").mapInArrow(run, "uid long, doc long, lang string, model int, n long, bits double, excess double, cold array<long>")


def _looked_up(cold: DataFrame, entries: DataFrame) -> DataFrame:
    """(uid, bits, excess) of the rows (uid, model, gram, times), each against its shard of its model."""
    pair = F.lit(0xFFFF)  # of an n-gram the two symbols before its last, of a context its last two
    salts = F.when(F.col("model") == 0, SALTS).otherwise(FOLD_SALTS)
    model = entries.where("order > 2").select(
        "model", F.when(F.col("weight"), F.col("key").bitwiseAND(pair)).otherwise(F.shiftright("key", 8).bitwiseAND(pair)).alias("shard"),
        F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(0).alias("kind"), "order", "weight", "key", "value",
        F.lit(None).cast("long").alias("uid"), F.lit(0).cast("long").alias("times"))
    low = entries.where("order <= 2").select(*ENTRY).toArrow()  # at most 256 + 256^2 n-grams and contexts of a model
    held = cold.sparkSession.sparkContext.broadcast(low)
    asked = cold.select("model", F.shiftright("gram", 8).bitwiseAND(pair).alias("shard"), F.pmod("uid", salts).cast("int").alias("salt"), F.lit(1).alias("kind"), F.lit(0).alias("order"), F.lit(False).alias("weight"),
                        F.col("gram").alias("key"), F.lit(0.0).cast("float").alias("value"), "uid", "times")
    both = model.unionByName(asked).repartition("model", "shard", "salt").sortWithinPartitions("kind")  # a task's part of the model comes first

    def run(batches):
        parts, columns, models = [], None, {}
        for batch in batches:
            is_model = batch.column("kind").to_numpy() == 0
            if is_model.any():
                parts.append(pa.Table.from_batches([batch.filter(pa.array(is_model)).select(list(ENTRY))]).cast(held.value.schema))
            rows = batch.filter(pa.array(~is_model))
            if rows.num_rows:
                columns, of = columns or _columns([held.value, *parts]), rows.column("model").to_numpy()
                models |= {m: _model(columns, m, True) for m in np.unique(of).tolist() if m not in models}
                bits, _ = _surprisal(models, of, rows.column("key").to_numpy())
                times = rows.column("times").to_numpy()
                yield pa.RecordBatch.from_arrays([rows.column("uid"), pa.array(bits * times.astype(float)), pa.array(np.maximum(bits - SPIKE, 0) * times.astype(float))], names=["uid", "bits", "excess"])

    return both.mapInArrow(run, "uid long, bits double, excess double").groupBy("uid").agg(F.sum("bits").alias("cold_bits"), F.sum("excess").alias("cold_excess"))


def score(docs: DataFrame, entries: DataFrame, scratch: Scratch, cache_entries: int = CACHE) -> DataFrame:
    """(uid, doc, lang, model, n, perplexity, excess) of every row (doc, lang, text, and model unless it is 0)."""
    docs = docs if "model" in docs.columns else docs.withColumn("model", F.lit(0))
    held = docs.sparkSession.sparkContext.broadcast(cached_models(entries, cache_entries))
    hot = scratch.keep(_hot(docs, held), "hot")
    held.destroy()  # all that needs it is written
    cold = hot.select("uid", "model", F.explode("cold").alias("gram")).groupBy("uid", "model", "gram").agg(F.count("*").alias("times"))
    both = hot.drop("cold").join(_looked_up(cold, entries), "uid", "left")
    bits = (F.col("bits") + F.coalesce("cold_bits", F.lit(0.0))) / F.greatest("n", F.lit(1))
    excess = (F.col("excess") + F.coalesce("cold_excess", F.lit(0.0))) / F.greatest("n", F.lit(1))
    # rounded, so that the order in which a sum was taken doesn't show
    return both.select("uid", "doc", "lang", "model", "n", F.round(F.pow(F.lit(2.0), bits), 6).alias("perplexity"), F.round(excess, 6).alias("excess"))


def _thresholds(scored: DataFrame, figure: str, quantile: float, by: list[str], least: int) -> DataFrame:
    """The quantile of a figure per group, from counts of its values in steps of 1/1000."""
    return _cuts(_steps(scored, figure, by), figure, quantile, by, least)


def _steps(scored: DataFrame, figure: str, by: list[str]) -> DataFrame:
    return scored.groupBy(*by, F.ceil(F.col(figure) * 1000).alias("step")).agg(F.count("*").alias("m"))


def _cuts(counts: DataFrame, figure: str, quantile: float, by: list[str], least: int) -> DataFrame:
    window = Window.partitionBy(*by)
    ranked = counts.select(*by, "step", F.sum("m").over(window.orderBy("step")).alias("upto"), F.sum("m").over(window).alias("all"))
    cut = F.min(F.when(F.col("upto") >= F.col("all") * quantile, F.col("step"))) / 1000
    return ranked.where(F.col("all") >= least).groupBy(*by).agg(cut.alias(f"{figure}_{len(by)}"))


def _figure(name: str) -> Column:
    """A figure as it is standardised: of the perplexity its logarithm."""
    return F.log2(name) if name == "perplexity" else F.col(name)


def _fits(known: DataFrame, figures: list[str]) -> DataFrame:
    """(__lang, shortest, longest, and per figure its mean's and its log2 scale's slope and intercept) over log2 of the length."""
    length = F.log2(F.col("n") + 1)

    def line(y: Column, name: str) -> list[Column]:
        slope = F.regr_slope(y, length)  # null where all are of one length
        return [F.coalesce(slope, F.lit(0.0)).alias(f"{name}_slope"), (F.avg(y) - F.coalesce(slope, F.lit(0.0)) * F.avg(length)).alias(f"{name}_start")]

    means = known.groupBy("__lang").agg(F.min(length).alias("shortest"), F.max(length).alias("longest"), *(c for f in figures for c in line(_figure(f), f"{f}_mean")))
    away = join_groups(known, means, ["__lang"])
    scales = away.groupBy("__lang").agg(*(
        c for f in figures for c in line(F.log2(F.greatest(F.abs(_figure(f) - F.col(f"{f}_mean_start") - F.col(f"{f}_mean_slope") * length), F.lit(1e-4))), f"{f}_scale")))
    return means.join(scales, "__lang")


def _standardised(rows: DataFrame, fits: DataFrame, figures: list[str], keys: list[str] | None = None, more: list[str] | None = None) -> DataFrame:
    """``rows`` with z_<figure>: distance from the mean of its length over the scale of its length, both constant beyond the lengths seen."""
    length = F.least(F.greatest(F.log2(F.col("n") + 1), F.col("shortest")), F.col("longest"))
    at = lambda name: F.col(f"{name}_start") + F.col(f"{name}_slope") * length
    z = [((_figure(f) - at(f"{f}_mean")) / F.pow(F.lit(2.0), at(f"{f}_scale"))).alias(f"z_{f}") for f in figures]
    return join_groups(rows, fits, keys or ["__lang"], "left").select(*rows.columns, *z, *(more or []))


def _merged_classes(known: DataFrame, least: int) -> DataFrame:
    """(__lang, __size, reach): how far a length class must look to both sides to hold ``least`` rows, or its language's all."""
    sizes = known.groupBy("__lang", F.col("__size").alias("other")).agg(F.count("*").alias("m"))
    every = sizes.select("__lang").distinct().select("__lang", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))).alias("__size"))
    away = every.join(sizes, "__lang").withColumn("off", F.abs(F.col("other") - F.col("__size")))
    w = Window.partitionBy("__lang", "__size")
    held = away.select("__lang", "__size", "off", F.sum("m").over(w.orderBy("off")).alias("upto"), F.sum("m").over(w).alias("all"))
    return held.where((F.col("upto") >= least) | (F.col("upto") == F.col("all"))).groupBy("__lang", "__size").agg(F.min("off").alias("reach"))


def _limits(known: DataFrame, quantiles: dict[str, float], least: int, scratch: Scratch) -> DataFrame:
    """(__lang, __size, the columns of :func:`_fits`, and per figure its limit) of the rows (__lang, __size, n, figures); small tables are written, which keeps the plan short."""
    fits = scratch.keep(_fits(known, list(quantiles)), "fits")
    out = reach = scratch.keep(_merged_classes(known, least), "reach")
    known = _standardised(known, fits, list(quantiles))
    for figure, quantile in quantiles.items():
        counts = _steps(known, f"z_{figure}", ["__lang", "__size"]).withColumnRenamed("__size", "other")
        near = counts.join(reach, "__lang").where(F.abs(F.col("other") - F.col("__size")) <= F.col("reach"))
        merged = near.groupBy("__lang", "__size", "step").agg(F.sum("m").alias("m"))
        out = out.join(scratch.keep(_cuts(merged, figure, quantile, ["__lang", "__size"], 1), figure), ["__lang", "__size"])
    return scratch.keep(out.drop("reach").join(fits, "__lang"), "limits")


def verdicts(scored: DataFrame, trusted: DataFrame, quantiles: dict[str, float], least: int) -> DataFrame:
    """``scored`` plus kept; ``trusted``: scores of trusted documents."""
    figures, scratch = list(quantiles), Scratch(scored.sparkSession, "limits")
    own, size = F.coalesce("lang", F.lit("\0null")), F.floor(F.log2(F.col("n") + 1))
    known = trusted.withColumn("__lang", F.explode(F.array(own, F.lit(ALL)))).withColumn("__size", size)
    large = known.groupBy("__lang").agg(F.count("*").alias("m")).where((F.col("m") >= least) | (F.col("__lang") == ALL)).select("__lang", F.lit(True).alias("large"))
    large = scratch.keep(large, "languages")
    known = scratch.keep(join_groups(known, large, ["__lang"]).select("__lang", "__size", "n", *figures), "known")
    limits = _limits(known, quantiles, least, scratch)
    out = join_groups(scored.withColumn("__lang", own).withColumn("__size", size), large, ["__lang"], "left")
    out = out.withColumn("__lang", F.when(F.col("large"), F.col("__lang")).otherwise(ALL))
    out = _standardised(out, limits, figures, ["__lang", "__size"], [f"{f}_2" for f in figures])
    rejected = F.lit(False)
    for figure in figures:
        rejected = rejected | F.coalesce(F.col(f"z_{figure}") > F.col(f"{figure}_2"), F.lit(False))
    return out.withColumn("kept", ~rejected | (F.col("n") == 0)).select(*scored.columns, "kept")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
             cache_entries: int = CACHE, quantiles: dict[str, float] | None = None, least_trusted: int = LEAST_TRUSTED) -> DataFrame:
    """Per row: doc, lang, n (bytes), perplexity, excess, kept.  ``labels``: doc_id, quality, toxic."""
    scratch = Scratch(docs.sparkSession, "kneser-ney")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    ids = scratch.keep(labels.where("quality = 1 and toxic = 0 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc")).distinct(), "trusted")
    entries = train(trusted_documents(narrow, ids), scratch, FOLDS)
    # a trusted document is scored twice: by the whole model, and for the limits by the one that hasn't seen its fold
    known = trusted_documents(narrow, ids, ["lang"]).withColumn("model", fold_of(F.col("doc"), FOLDS) + 1)
    every = narrow.withColumn("model", F.lit(0)).unionByName(known.select("doc", "lang", "text", "model"))
    scored = scratch.keep(score(every, entries, scratch, cache_entries), "scored")
    unseen = scored.where("model > 0 and n > 0").drop("model")
    return verdicts(scored.where("model = 0").drop("model"), unseen, quantiles or QUANTILES, least_trusted).drop("uid")

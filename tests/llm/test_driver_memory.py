"""What the driver holds while it plans: scans (each broadcasts its settings), jobs and the size of expressions."""

import random

from lectern.llm import components, kneser_ney, near_dup
from lectern.llm.common import Scratch


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


class Watched(Scratch):
    def __init__(self, spark):
        super().__init__(spark, "watched")
        self.scans = []

    def keep(self, df, name):
        self.scans.append((name, scans(df)))
        return super().keep(df, name)


def test_a_round_of_components_scans_links_once_a_side(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (4, 4), (3, 7)], "a long, b long")
    scratch = Watched(spark)
    got = {(r["node"], r["component"]) for r in components.components(links, scratch).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (7, 1), (8, 8), (9, 8)}
    stars = [n for name, n in scratch.scans if name == "star"]
    assert stars and max(stars) <= 4


def test_rounds_of_components_take_one_execution(spark, monkeypatch):
    """The two numbers of a round come with the links as they are written, not by a second read."""
    links = spark.createDataFrame([(k, k + 1) for k in range(20)], "a long, b long")
    first = type(links).first
    monkeypatch.setattr(type(links), "first", lambda self: (_ for _ in ()).throw(AssertionError("a round reads its links again")))
    got = components.components(links, Scratch(spark, "rounds"))
    monkeypatch.setattr(type(links), "first", first)
    assert {(r["node"], r["component"]) for r in got.collect()} == {(k, 0) for k in range(21)}


def test_components_without_links(spark):
    for rows in ([], [(3, 3)]):
        links = spark.createDataFrame(rows, "a long, b long")
        assert components.components(links, Scratch(spark, "none")).collect() == []


def test_model_entries_are_one_scan(spark):
    texts = spark.createDataFrame([(k, f"some text of number {k} and more of it") for k in range(40)], "doc long, text string")
    entries = kneser_ney.train(texts, Scratch(spark, "one-scan"), 2)
    assert scans(entries) == 1
    assert {(r["order"], r["weight"]) for r in entries.select("order", "weight").distinct().collect()} == {(k, w) for k in range(1, 6) for w in (False, True)}


def test_symbols_that_differ(spark):
    rng = random.Random(3)
    lanes = [0, 1, 2, 3, 0x1000, 0x2000, 0x3FFF, 0x4000, 0x7FFF, 0x8000, 0xBFFF, 0xC000, 0xFFFF]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = []
    for k in range(200):
        a = [[rng.choice(lanes) for _ in range(4)] for _ in near_dup.SIG]
        b = [[x if rng.random() < 0.5 else rng.choice(lanes) for x in chunk] for chunk in a]
        pack = lambda side: [signed(sum(x << 16 * i for i, x in enumerate(chunk))) for chunk in side]
        rows.append((k, pack(a), pack(b), sum(x != y for p, q in zip(a, b) for x, y in zip(p, q))))
    df = spark.createDataFrame(rows, "k long, p array<long>, q array<long>, want long")
    fields = lambda c: ", ".join(f"{c}[{i}] AS {s}" for i, s in enumerate(near_dup.SIG))
    df = df.selectExpr("k", "want", f"struct({fields('p')}) AS x", f"struct({fields('q')}) AS y")
    counted = near_dup.errors("x", "y")
    assert df.where(counted != df["want"]).count() == 0
    plan = df.where(counted < 3)._jdf.queryExecution().analyzed().toString()
    assert plan.count("^") <= 2 * len(near_dup.SIG)  # a chunk's xor is written out twice, not 16 times

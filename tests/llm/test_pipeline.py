from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from lectern.llm import decontaminate as dc
from lectern.llm import kneser_ney as kn
from lectern.llm.common import Scratch
from tests.llm.conftest import SMALL
from tests.llm.test_near_dup import brute as near_groups
from tests.llm.test_packing import PATH, check

SPACE = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before the first and after each stage, over the smallest tables."""
    scratch = Scratch(spark, "test")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(scratch.keep(stage(spark, out[-1], SMALL), name))
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_of_documents(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])
    for s in stages[1:-1]:
        assert all(r.n_chars == len(r.text) for r in s.collect() if r.doc_id is not None)


def test_quality_stage(spark, stages):
    judged = kn.classify(stages[0], spark.read.parquet(f"{SMALL}/labels.parquet")).collect()
    assert by_id(stages[1]).keys() == {r.doc for r in judged if r.kept}


def test_line_stage(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    key = lambda line: line.strip(SPACE).translate({c: c + 32 for c in range(65, 91)})
    holders = defaultdict(set)
    for d, r in before.items():
        for line in r.text.split("\n"):
            holders[key(line)].add(d)
    for d, r in before.items():
        kept = [x for x in r.text.split("\n") if len(key(x)) < 40 or len(holders[key(x)]) < 5 or d == max(holders[key(x)])]
        assert after[d].text == "\n".join(kept)


def test_near_stage(stages):
    want = near_groups([(r.doc_id, r.text) for r in stages[2].collect()], n=5)
    assert by_id(stages[3]).keys() == {d for d, (_, _, kept) in want.items() if kept}


def test_benchmark_stage(spark, stages):
    items = [(str(r.item_id), r.text.encode()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    windows = dc.Windows.of(items, dc.N)
    scan = lambda t: windows.scan(dc._numbers(dc.words_of(t.encode()), windows))[0].any()
    before, after = by_id(stages[3]), by_id(stages[4])
    assert before.keys() == after.keys()
    for d, r in before.items():
        assert not scan(after[d].text)
        assert scan(r.text) or after[d].text == r.text


def test_packing_stage(stages):
    assert check(stages[5].collect(), [(r.doc_id, r.text) for r in stages[4].collect()], Tokenizer.from_file(PATH)) < 0.01


def test_run(spark, stages):
    digest = lambda df: sorted((r.doc_id, r.start, r.ids_crc32, r.doc_tokens) for r in df.collect())
    got, want = digest(cp.run(spark, SMALL)), digest(stages[5])
    assert {r[0]: r[3] for r in got} == {r[0]: r[3] for r in want}


@pytest.mark.parametrize("name", [n for n, _ in cp.STAGES])
def test_stage_edges(spark, edge, clashing, empty, name):
    stage = dict(cp.STAGES)[name]
    out = stage(spark, edge, SMALL)
    if name != "packing":
        assert out.columns == edge.columns
        assert stage(spark, clashing, SMALL).columns == clashing.columns
    assert out.count() > 0 and stage(spark, empty, SMALL).count() == 0

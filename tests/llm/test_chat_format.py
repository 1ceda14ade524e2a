import random

from lectern.llm import chat_format as cf
from tests.llm.conftest import same

NODES = "tree long, node long, parent long, role string, text string, score double"


def test_query_equals_sql(query, oracle):
    rows = query("op8_chat_format")
    same(rows, oracle("op8_chat_format"))
    assert any(r.conv_id == -7 and r.n_turns == 2 for r in rows)


def paths(rows, best):
    """Chosen root-to-leaf paths by walking up from each leaf."""
    out = {}
    for tree in {r[0] for r in rows}:
        own = {r[1]: r for r in rows if r[0] == tree}
        parents = {r[2] for r in own.values()}
        found = []
        for leaf in own:
            if leaf in parents:
                continue
            path, now = [], leaf
            while now in own and now not in path:
                path.append(now)
                now = own[now][2]
            if now not in path:
                total = sum(own[k][5] or 0.0 for k in path)
                found.append((-round(total, 6), -len(path), leaf, path[::-1]))
        for rank, (_, _, leaf, path) in enumerate(sorted(found)[:best]):
            out[tree, leaf] = (rank + 1, [(own[k][3] or "", own[k][4] or "") for k in path])
    return out


def test_random_trees(spark):
    rng = random.Random(6)
    bits = ["</turn>", "### ", "\\", "\\h", "\\b", "\n", "é", "日", ": ", "<", "#", "a", " ", "\U0001f600"]
    said = lambda: rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randrange(12)))])
    rows = []
    for tree in range(25):
        for node in range(rng.randrange(1, 40)):
            parent = None if node == 0 else rng.choice([node - 1, rng.randrange(node), 999 if rng.random() < 0.05 else node - 1])
            rows.append((tree, node, parent, rng.choice(["user", "assistant", "sys: #<\\", None]), said(), rng.choice([None, 0.5, 1.0, -0.25])))
    rows += [(90, 1, 2, "user", "in", 0.0), (90, 2, 1, "user", "a circle", 0.0), (90, 3, 2, "user", "and below", 0.0), (91, 5, 5, "user", "own parent", 0.0)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, NODES)
    for best in (1, 2, None):
        want = paths(rows, best)
        got = cf.read_back(cf.format_trees(table, "tree", "node", "parent", "role", "text", "score", best=best)).collect()
        assert {(r.tree, r.leaf): (r.branch, [(t.role, t.text) for t in r.turns]) for r in got} == want
        for r in got:
            assert "".join(r.learned) == "".join(t for role, t in want[r.tree, r.leaf][1] if role == "assistant")
            assert r.formatted.count("</turn>") == len(r.turns)


def test_a_long_thread(spark):
    rows = [(k, None, f"t{k}") for k in range(3000)]
    table = spark.createDataFrame([(1, k, "user" if k % 2 else "assistant", t) for k, _, t in rows], "conv_id long, turn long, role string, text string")
    out = cf.read_back(cf.format_trees(cf.threads(table), "tree", "node", "parent", "role", "text")).first()
    assert [t.text for t in out.turns] == [t for _, _, t in rows]


def test_edges(spark):
    rows = [(None, 0, "user", "x"), (None, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 1, "assistant", "y" * 200_000), (2, None, "assistant", None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for t in (table, table.withColumn("tree", table.role).withColumn("node", table.role).withColumn("branch", table.role)):
        out = {r.tree: r for r in cf.read_back(cf.format_trees(cf.threads(t), "tree", "node", "parent", "role", "text")).collect()}
        assert {k: len(r.turns) for k, r in out.items()} == {-(1 << 63): 2, 1: 3, 2: 1}
        assert "".join(out[1].learned) == "y" * 200_000
    assert cf.format_trees(cf.threads(table.limit(0)), "tree", "node", "parent", "role", "text").count() == 0

"""Personal data by base patterns and a skip-chain conditional random field.

The base patterns (emails, IP addresses, card numbers, phone numbers) are read
in one linear pass over each whole text.  The field then looks at every token
with a digit or an at sign.  Its nodes are these tokens with the labels
``none`` and the four kinds; neighbouring tokens form a chain, and distant
tokens that are equal, or end in the same seven digits, are joined by skip
links, each to the next of its like, so links grow with the tokens.  Loopy
message passing with the base spans as evidence gives every other token its
marginals.  A token alone that fits a base pattern (two card numbers side by
side hide each other from it) is evidence, too.  Tokens of a kind with at least
``certainty`` become further spans if links lead from them to evidence of it.

The weights come of all documents: Spark counts token shapes by label, and
label pairs over both sorts of links; shapes are fitted by a multinomial
logistic regression on these counts, pairs by their pointwise mutual
information.

Defined cases: null and empty texts have no spans; repeated rows and null ids
are handled row by row; without any evidence the field adds nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+((?:\.[0-9]+){3})")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]")
TOKEN = re.compile(r"[A-Za-z0-9@._%+()-]+")
CERTAINTY, TOLERANCE, STRONGEST, DAMPING = 0.9, 1e-6, 4.0, 0.5


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, sorted: leftmost and non-overlapping per kind."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((0, start, m.end()))
            last = m.end()
        at = text.find("@", m.end() if m else at + 1)
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append((3, m.start(), m.end()))
    return sorted(out)


def _bucket(n: int, *limits: int) -> int:
    return sum(n > x for x in limits)


def shape(token: str) -> tuple[int, ...]:
    """What the field sees of a token: no check sum, range or whole pattern."""
    digits = sum(map(str.isdigit, token))
    letters = sum(map(str.isalpha, token))
    return (token.count("@") and 1, _bucket(token.count("."), 0, 1, 2, 3), _bucket(digits, 0, 1, 2, 3, 4, 7, 8, 12, 19), _bucket(letters, 0, 2, 6),
            int(token[0] == "+"), int("(" in token or ")" in token), _bucket(token.count("-"), 0, 1), _bucket(len(token), 2, 4, 8, 16, 32))


@dataclass
class Graph:
    """Tokens of some texts, their evidence (0: none known, else kind + 1) and links."""

    tokens: list[tuple[int, int, int]]  # text, start, end
    shapes: list[tuple[int, ...]]
    known: np.ndarray
    based: np.ndarray  # inside a base span
    chain: np.ndarray
    skip: np.ndarray


def graph_of(texts: list[str], spans: list[list[tuple[int, int, int]]]) -> Graph:
    tokens, shapes, known, based, chain, skip = [], [], [], [], [], []
    for k, (text, own) in enumerate(zip(texts, spans)):
        if not HINT.search(text):
            continue
        first, last_like, by_start = len(tokens), {}, sorted(own, key=lambda s: (s[1], s[0]))
        done = 0
        for m in TOKEN.finditer(text):
            start, end = m.span()
            token = m[0].rstrip(".-(")
            end = start + len(token)
            if not HINT.search(token):
                continue
            while done < len(by_start) and max(s[2] for s in by_start[done:done + 1]) <= start:
                done += 1
            label = next((s[0] + 1 for s in by_start[done:done + 8] if s[1] < end and start < s[2]), 0)
            node = len(tokens)
            if node > first and start - tokens[-1][2] <= 1:
                chain.append((node - 1, node))
            digits = _digits(token)
            for like in {token.lower(), digits[-7:] if len(digits) >= 7 else token.lower()}:
                if like in last_like:
                    skip.append((last_like[like], node))
                last_like[like] = node
            tokens.append((k, start, end))
            shapes.append(shape(token))
            based.append(label > 0)
            if not label:
                label = next((k + 1 for k, a, b in base_spans(token) if (a, b) == (0, len(token))), 0)
            known.append(label)
    links = lambda x: np.array(x, dtype=np.int64).reshape(-1, 2)
    return Graph(tokens, shapes, np.array(known, dtype=np.int64), np.array(based, dtype=bool), links(chain), links(skip))


@dataclass
class Field:
    """Weights: per feature (place, value) and label, and label pairs over chain and skip links."""

    weights: dict[tuple[int, int], np.ndarray]
    pairs: list[np.ndarray]

    def unary(self, shapes: list[tuple[int, ...]]) -> np.ndarray:
        zero = np.zeros(len(KINDS) + 1)
        cache: dict = {}
        out = np.zeros((len(shapes), len(KINDS) + 1))
        for k, s in enumerate(shapes):
            if s not in cache:
                cache[s] = sum((self.weights.get((i, v), zero) for i, v in enumerate(s)), self.weights.get((-1, 0), zero))
            out[k] = cache[s]
        return out

    def marginals(self, graph: Graph, rounds: int | None = None) -> np.ndarray:
        """Loopy message passing over all links of the graph at once, until no message changes by ``TOLERANCE``.

        A round computes only messages from nodes that changed.  Without
        ``rounds`` it ends at the latest after as many as damped evidence needs
        to pass every node, which only messages that never settle reach.
        """
        belief = self.unary(graph.shapes)
        seen = np.flatnonzero(graph.known)
        belief[seen] = -20.0
        belief[seen, graph.known[seen]] = 0.0
        links = np.concatenate((graph.chain, graph.skip))
        source, target = np.concatenate((links, links[:, ::-1])).T  # each link in both directions
        sort = np.repeat([0, 1, 2, 3], [len(graph.chain), len(graph.skip)] * 2)
        psi = np.stack([*self.pairs, *(p.T for p in self.pairs)])
        back = np.roll(np.arange(len(source)), -len(links))
        messages, active = np.zeros((len(source), belief.shape[1])), np.arange(len(source))
        order = np.argsort(source, kind="stable")
        first = np.searchsorted(source[order], np.arange(len(belief) + 1))
        for _ in range(100 + 4 * len(belief) if rounds is None else rounds):
            if not len(active):
                break
            new = _logsumexp((belief[source[active]] - messages[back[active]])[:, :, None] + psi[sort[active]], 1)
            change = (1 - DAMPING) * (new - new.max(1, keepdims=True) - messages[active])
            messages[active] += change
            np.add.at(belief, target[active], change)
            moved = active[np.abs(change).max(1) > TOLERANCE]
            nodes = np.unique(target[moved])
            sizes = first[nodes + 1] - first[nodes]
            out = order[np.repeat(first[nodes] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
            active = np.union1d(moved, out)
        belief = np.exp(belief - belief.max(1, keepdims=True))
        return belief / belief.sum(1, keepdims=True)

    @staticmethod
    def reached(graph: Graph) -> np.ndarray:
        """(node, label): links lead from the node to evidence of the label, over however many."""
        root, links = np.arange(len(graph.tokens)), np.concatenate((graph.chain, graph.skip))
        while True:
            ends = root[links]
            low, high = ends.min(1), ends.max(1)
            if (low == high).all():
                break
            np.minimum.at(root, high, low)
            while (root != root[root]).any():
                root = root[root]
        out = np.zeros((len(root), len(KINDS) + 1), dtype=bool)
        seen = np.flatnonzero(graph.known)
        out[root[seen], graph.known[seen]] = True
        return out[root]


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def added_spans(graph: Graph, field: Field, certainty: float, spans: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Per text the spans that the field adds: neighbouring tokens of a kind are one span."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in spans]
    if not len(graph.tokens):
        return out
    marginals = field.marginals(graph)
    label = np.where(marginals.max(1) >= certainty, marginals.argmax(1), 0)
    before, reached = None, field.reached(graph)
    for node in np.flatnonzero((label > 0) & ~graph.based & reached[np.arange(len(label)), label]).tolist():
        text, start, end = graph.tokens[node]
        kind = int(label[node]) - 1
        own = out[text]
        if before == node - 1 and own and own[-1][0] == kind and start - own[-1][2] <= 1:
            own[-1] = (kind, own[-1][1], end)
        else:
            own.append((kind, start, end))
        before = node
    return out


def _texts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[tuple[pa.RecordBatch, list[str], list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            texts = [t or "" for t in part.column("text").to_pylist()]
            yield part, texts, [base_spans(t) if HINT.search(t) else [] for t in texts]


def train(docs: DataFrame) -> Field:
    """The field's weights from counts over all rows (doc, text)."""

    def run(batches):
        for _, texts, spans in _texts(batches):
            graph, counts = graph_of(texts, spans), Counter()
            for s, label in zip(graph.shapes, graph.known.tolist()):
                counts["shape", ",".join(map(str, s)), label, 0] += 1
            for name, links in (("chain", graph.chain), ("skip", graph.skip)):
                for a, b in graph.known[links].tolist():
                    counts[name, "", a, b] += 1
            if counts:
                what, key, a, b = zip(*counts)
                yield pa.RecordBatch.from_arrays([pa.array(what), pa.array(key), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(counts.values(), pa.int64())], names=["what", "key", "a", "b", "n"])

    counts = docs.select("text").mapInArrow(run, "what string, key string, a int, b int, n long").groupBy("what", "key", "a", "b").agg(F.sum("n").alias("n"))
    rows = counts.collect()  # shapes are tuples of a few buckets: bounded
    return Field(_fit([r for r in rows if r["what"] == "shape"]), [_pairs([r for r in rows if r["what"] == w]) for w in ("chain", "skip")])


def _fit(rows: list, steps: int = 400, ridge: float = 1e-4) -> dict[tuple[int, int], np.ndarray]:
    """Multinomial logistic regression on counts of (shape, label), by gradient steps with momentum."""
    if not rows:
        return {}
    rows = sorted(rows, key=lambda r: (r["key"], r["a"]))
    shapes = [tuple(map(int, r["key"].split(","))) for r in rows]
    places = sorted({(i, v) for s in shapes for i, v in enumerate(s)}) + [(-1, 0)]
    number = {p: k for k, p in enumerate(places)}
    x = np.zeros((len(rows), len(places)))
    for k, s in enumerate(shapes):
        x[k, [number[i, v] for i, v in enumerate(s)] + [number[-1, 0]]] = 1
    n = np.array([r["n"] for r in rows], dtype=float)
    n /= n.sum()
    y = np.eye(len(KINDS) + 1)[[r["a"] for r in rows]]
    w = np.zeros((len(places), len(KINDS) + 1))
    speed = np.zeros_like(w)
    for _ in range(steps):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        speed = 0.9 * speed - 1.0 * (x.T @ (n[:, None] * (p - y)) / x.shape[1] ** 0.5 + ridge * w)
        w += speed
    return {p: w[k] for k, p in enumerate(places)}


def _pairs(rows: list) -> np.ndarray:
    """Pointwise mutual information of the labels of linked tokens, symmetric, at most STRONGEST."""
    c = np.full((len(KINDS) + 1, len(KINDS) + 1), 0.5)
    for r in rows:
        c[r["a"], r["b"]] += r["n"]
        c[r["b"], r["a"]] += r["n"]
    c /= c.sum()
    share = c.sum(1)
    return np.clip(np.log(c / np.outer(share, share)), -STRONGEST, STRONGEST)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, certainty: float = CERTAINTY) -> DataFrame:
    """Per row: doc, base and added (arrays of kind, start, end; code points, end exclusive)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(train(rows))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        structs = lambda found: pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in own] for own in found], span)
        for part, texts, spans in _texts(batches):
            more = added_spans(graph_of(texts, spans), held.value, certainty, spans)
            yield pa.RecordBatch.from_arrays([part.column("doc"), structs(spans), structs(map(sorted, more))], names=["doc", "base", "added"])

    kind = "array<struct<kind: string, start: bigint, end: bigint>>"
    return rows.mapInArrow(run, f"doc long, base {kind}, added {kind}")


def written(spans: F.Column) -> F.Column:
    """``kind:start:end`` by kind as listed, then start, comma-joined."""
    order = F.array(*map(F.lit, KINDS))
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("n"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["n"], s["a"], s["b"])), ",")

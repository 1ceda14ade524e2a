"""Sum-of-squares online packing of documents into token windows.

Each task packs the documents it reads, in order, without a shuffle.  Full
windows are cut from a document's front; what is left goes, whole, into the
fill level that minimises the sum over levels of the squared number of
partially filled windows.  The level array holds that number per fill level
(0 to the window length) and the windows themselves hang below it.

At most ``max_open`` windows and ``max_held_tokens`` tokens stay open in a
task.  When a limit is reached the fuller half of the windows is closed, and
when the task's documents end, all are: a window stays as the rule filled it,
and its gap is filled with pieces of the emptiest windows, cut to size
(:func:`top_up`); the last remainder is cut into sequences whose lengths are
powers of two, which need no padding.  Both limits bound a task's memory and
change which documents share a window, never which ids are packed.

Defined cases: null and empty texts are the end-of-document id alone;
repeated rows and null ids are packed row by row; an empty table gives none.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.tokens import encoder

WINDOW, END_ID = 2048, 1
PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                   ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])


@dataclass
class Piece:
    doc: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.ids[:n], self.doc_tokens), Piece(self.doc, self.start + n, self.ids[n:], self.doc_tokens)


@dataclass
class LevelArray:
    """The partially filled windows by fill level, and how many each level has."""

    window: int = WINDOW
    count: np.ndarray = field(init=False)
    held: dict[int, list[list[Piece]]] = field(default_factory=dict)
    open: int = 0

    def __post_init__(self):
        self.count = np.zeros(self.window + 1, dtype=np.int64)

    def best_level(self, size: int) -> int:
        """The level whose use changes the sum of squared counts least (ties: the fullest)."""
        c, top = self.count, self.window - size
        # a window moves from level h to h + size; level 0 and the full level are not counted
        change = 2 * (c[size:self.window + 1] - c[:top + 1]) + 2
        change[0] = 2 * c[size] + 1
        change[top] = 1 - 2 * c[top] if top else 0
        usable = c[:top + 1] > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        return top - int(np.argmin(change[::-1]))

    def place(self, piece: Piece) -> list[Piece] | None:
        """Puts the piece into a window; returns the window if that is now full."""
        size = len(piece.ids)
        level = self.best_level(size)
        if level:
            window = self.held[level].pop()
            self.count[level] -= 1
        else:
            window = []
            self.open += 1
        window.append(piece)
        level += size
        if level == self.window:
            self.open -= 1
            return window
        self.held.setdefault(level, []).append(window)
        self.count[level] += 1
        return None

    def close(self, keep: int = 0) -> list[list[Piece]]:
        """Closes all but the ``keep`` emptiest windows without any padding."""
        out, partial = [], []
        for level in sorted(self.held, reverse=True):
            while self.held[level] and self.open > keep:
                window = self.held[level].pop()
                self.count[level] -= 1
                self.open -= 1
                (partial if level & (level - 1) else out).append(window)
        return out + top_up(partial, self.window)


def top_up(windows: list[list[Piece]], window: int) -> list[list[Piece]]:
    """Partial windows, fullest first, filled with the pieces of the emptiest ones."""
    out, loose, last = [], [], len(windows) - 1
    for k, pieces in enumerate(windows):
        if k > last:
            break
        gap = window - sum(len(p.ids) for p in pieces)
        full = list(pieces)
        while gap:
            if not loose:
                if last == k:
                    break
                loose = windows[last][::-1]
                last -= 1
            head, rest = loose.pop().cut(gap)
            full.append(head)
            gap -= len(head.ids)
            if len(rest.ids):
                loose.append(rest)
        if gap:  # the last one, with nothing left to fill it
            return out + relay(full, window)
        out.append(full)
    return out + relay(loose[::-1], window)


def relay(pieces: list[Piece], window: int) -> list[list[Piece]]:
    """The pieces end to end, cut into full windows and then into powers of two."""
    left = sum(len(p.ids) for p in pieces)
    out, now, room = [], [], 0
    for piece in pieces:
        while len(piece.ids):
            if not room:
                room = window if left >= window else 1 << (left.bit_length() - 1)
                now = []
                out.append(now)
            head, piece = piece.cut(min(room, len(piece.ids)))
            now.append(head)
            room -= len(head.ids)
            left -= len(head.ids)
    return out


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", *, window: int = WINDOW,
         end_id: int = END_ID, max_open: int = 4096, max_held_tokens: int = 4_000_000) -> DataFrame:
    """One row per piece: where it comes from, its ids, and its place in a sequence.

    ``sequence_id`` holds the task's number in its upper bits; a task that is
    run again reads the same rows and so gives the same sequences.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")

    def run(batches):
        encode, levels = encoder(vocabulary).encode, LevelArray(window)
        sequence, held = TaskContext.get().partitionId() << 40, 0
        end = np.array([end_id], dtype="<u4")

        def rows(windows):
            nonlocal sequence
            out = {f.name: [] for f in PIECE}
            for pieces in windows:
                offset = 0
                for p in pieces:
                    data = p.ids.tobytes()
                    for name, value in zip(out, (p.doc, p.start, len(p.ids), zlib.crc32(data), p.doc_tokens, sequence, offset, data)):
                        out[name].append(value)
                    offset += len(p.ids)
                sequence += 1
            return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in PIECE], schema=PIECE)

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part, full = batch.slice(at, 128), []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.concatenate((encode(text), end))
                    rest = Piece(doc, 0, ids, len(ids))
                    while len(rest.ids) >= window:
                        head, rest = rest.cut(window)
                        full.append([head])
                    if len(rest.ids):
                        rest.ids = rest.ids.copy()  # lets go of the whole text's ids
                        held += len(rest.ids)
                        done = levels.place(rest)
                        if done:
                            full.append(done)
                            held -= window
                        if levels.open > max_open or held > max_held_tokens:
                            full += levels.close(keep=levels.open // 2)
                            held = sum(len(p.ids) for at_level in levels.held.values() for w in at_level for p in w)
                if full:
                    yield rows(full)
        if last := levels.close():
            yield rows(last)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)

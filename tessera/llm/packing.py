"""Cost-balanced packing of token ids into sequences of a fixed length.

The cost of a piece of n tokens is estimated as ``linear * n + quadratic * n²``
(attention within a piece). Every task works on windows of
``window`` sequences: the whole sequences of long documents leave at once, the
rests go in descending length to the sequence of the lowest cost that has room
for them; a rest that fits nowhere whole is cut over the emptiest sequences.
What a window leaves goes into the next one, so a task pads nothing but its
last, partial sequence, and that one is cut into sequences whose lengths are
powers of two, which need no padding.

There is no shuffle: the pieces of a task depend on its rows alone, a rerun
after a lost executor repeats them, and memory is bounded by a window.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ranges, slices, texts_of, tidy, worker_value
from tessera.llm.units import MAX_UNITS, SPACE, UnitCoder

#: Plain units to a text that the library encodes.
LINES = 200
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, `offset` long, cost double, ids binary"


def library_encoder(content: str):
    """An encoder of units by the tokenizers library. Plain units (a space at
    most, then other characters) go in lines of ``LINES`` each, which saves a
    call for each; the line feed's id parts them again."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    (feed,) = tokenizer.encode("\n", add_special_tokens=False).ids
    plain = re.compile(f" ?[^{SPACE}]+").fullmatch

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        is_plain = np.fromiter((plain(u) is not None for u in units), bool, len(units))
        lines = [u for u, p in zip(units, is_plain) if p]
        joined = ids_of(["\n".join(lines[i : i + LINES]) + "\n" for i in range(0, len(lines), LINES)])
        each = ids_of([u for u, p in zip(units, is_plain) if not p])
        flat = np.concatenate([*joined, np.empty(0, np.int32)])
        ends = np.flatnonzero(flat == feed)
        lens = np.empty(len(units), np.int64)
        lens[is_plain] = np.diff(ends, prepend=-1) - 1
        lens[~is_plain] = [len(x) for x in each]
        flat = np.concatenate([flat[flat != feed], *each])
        # both kinds back into the order of the units
        order = np.concatenate([np.flatnonzero(is_plain), np.flatnonzero(~is_plain)])
        starts = np.empty(len(units), np.int64)
        starts[order] = np.cumsum(lens[order]) - lens[order]
        return flat[ranges(starts, lens)], lens

    return encode


class Packer:
    """Collects documents and gives out rows of full sequences."""

    def __init__(self, capacity: int, window: int, linear: float, quadratic: float, first_sequence: int) -> None:
        self.capacity, self.window, self.linear, self.quadratic = capacity, window, linear, quadratic
        self.next = first_sequence
        self.rests: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        self.held = 0
        self.out: list[tuple] = []

    def cost(self, n):
        return self.linear * n + self.quadratic * n * n

    def _emit(self, piece: tuple, sequence: int, offset: int, cost: float) -> None:
        doc, start, ids, total = piece
        self.out.append((doc, start, len(ids), total, sequence, offset, cost, ids.astype("<u4").tobytes()))

    def add(self, doc, ids: np.ndarray) -> None:
        n, c = len(ids), self.capacity
        whole = n // c * c
        for at in range(0, whole, c):
            self._emit((doc, at, ids[at : at + c], n), self.next, 0, self.cost(c))
            self.next += 1
        if n > whole:
            self.rests.append((doc, whole, ids[whole:], n))
            self.held += n - whole
        if self.held >= self.window * c:
            self._pack(self.held // c)

    def _pack(self, k: int) -> None:
        """Fill ``k`` sequences; what does not fit stays for the next window."""
        room, cost = np.full(k, self.capacity), np.zeros(k)
        used = np.zeros(k, np.int64)
        left = []

        def put(piece, s):
            n = len(piece[2])
            c = self.cost(n)
            self._emit(piece, self.next + int(s), int(used[s]), c)
            used[s] += n
            room[s] -= n
            cost[s] += c

        # ties: the row that came first; sort() is stable
        for piece in sorted(self.rests, key=lambda p: -len(p[2])):
            doc, start, ids, total = piece
            while len(ids):
                fits = room >= len(ids)
                if fits.any():
                    put((doc, start, ids, total), np.argmin(np.where(fits, cost, np.inf)))
                    break
                # it fits nowhere whole: as much of it as the emptiest sequence takes
                s = np.argmax(room)
                if not (n := int(room[s])):
                    left.append((doc, start, ids, total))
                    break
                put((doc, start, ids[:n], total), s)
                start, ids = start + n, ids[n:]
        self.rests, self.held = left, sum(len(p[2]) for p in left)
        self.next += k

    def finish(self) -> None:
        """Pack all that is left; the last ids go to sequences of powers of two."""
        if k := self.held // self.capacity:
            self._pack(k)
        n = self.held
        pieces = list(self.rests)
        while n:
            size = 1 << (n.bit_length() - 1)
            at = 0
            while at < size:
                doc, start, ids, total = pieces[0]
                take = min(size - at, len(ids))
                self._emit((doc, start, ids[:take], total), self.next, at, self.cost(take))
                pieces[:1] = [(doc, start + take, ids[take:], total)] if take < len(ids) else []
                at += take
            self.next += 1
            n -= size
        self.rests, self.held = [], 0

    def rows(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        cols = list(zip(*rows)) if rows else [()] * 8
        kinds = [pa.int64()] * 6 + [pa.float64(), pa.binary()]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "cost", "ids"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)


def pack_documents(
    docs: DataFrame,
    tokenizer_json: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    window: int = 256,
    linear: float = 1.0,
    quadratic: float = 1.0 / 2048,
    kept_units: int = MAX_UNITS,
) -> DataFrame:
    """Pieces of all documents, packed into sequences of ``capacity`` ids.

    Returns doc_id, start, length, doc_tokens, sequence_id, offset, cost and
    ids (binary, little-endian unsigned 32-bit). A document is the ids of its
    text and ``end_id``; a null or empty text gives the single piece
    ``end_id``. A null doc_id stays null and repeated rows are packed each on
    its own. ``kept_units`` is what a worker keeps of encoded units (about 250
    bytes each): more of them take less time. Equal lengths keep the order of their rows. Other columns of
    ``docs`` are not read. An empty table gives no rows.
    """
    source = open(tokenizer_json, encoding="utf-8").read()
    key, content = hashlib.sha256(source.encode()).hexdigest(), docs.sparkSession.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        packer = Packer(capacity, window, linear, quadratic, TaskContext.get().partitionId() << 40)
        for batch in slices(batches, "text"):
            coder = coder or worker_value(f"library {key} {kept_units}", lambda: UnitCoder(library_encoder(content.value), kept_units))
            ids, lens = coder(texts_of(batch, "text"))
            end = np.array([end_id], np.int32)
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), np.cumsum(lens) - lens, np.cumsum(lens)):
                packer.add(doc, np.concatenate([ids[a:b], end]))
                if len(packer.out) >= 4096:
                    yield packer.rows()
        packer.finish()
        yield packer.rows()

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(tidy(run, keep=True), SCHEMA)


def ids_crc32(ids: str = "ids") -> Column:
    return F.crc32(F.col(ids))

"""Byte-level BPE, encoding by batched merge rounds in numpy, and decoding.

The symbols of many words lie in one flat array. A round looks up every
adjacent pair by binary search over the sorted pair keys, takes the lowest
rank of each word and merges all its places at once, from the left; a word
without a known pair leaves. The rounds end when no word is left.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tessera.llm.common import ranges, slices, texts_of, tidy, unused
from tessera.llm.units import UnitCoder

#: Pre-token pattern of byte-level BPE (fixed value of the tokenizer's format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: printable
    Latin-1 characters for themselves, the others in turn from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Bpe:
    """Tables of one tokenizer file; encodes units and decodes ids."""

    def __init__(self, content: str) -> None:
        import regex

        spec = json.loads(content)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.byte_id = np.array([vocab[c] for c in letters], np.int64)
        size = 1 + max([*vocab.values(), *self.special.values()])
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]
        byte_of = {c: b for b, c in enumerate(letters)}
        table = [b""] * size
        for token, i in vocab.items():
            table[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            table[i] = token.encode()
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.widths = np.array([len(t) for t in table], np.int64)
        self.at = np.cumsum(self.widths) - self.widths
        self.words = regex.compile(PATTERN)
        self.split = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None

    def merge(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words given as flat byte ids and their lengths (1 at least)."""
        word = np.arange(len(lens))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(lens):
            last = np.cumsum(lens) - 1
            key = np.empty(len(symbols), np.int64)
            key[:-1] = symbols[:-1] << 32 | symbols[1:]
            key[last] = -1  # no pair reaches into the next word
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.ranks[at], NONE)
            best = np.minimum.reduceat(rank, last - lens + 1)
            on = best < NONE
            if not on.all():
                here = np.repeat(on, lens)
                done.append((word[~on], lens[~on], symbols[~here]))
                word, lens, best, symbols, rank, at = word[on], lens[on], best[on], symbols[here], rank[here], at[here]
                if not len(lens):
                    break
            place = np.flatnonzero(rank == np.repeat(best, lens))
            # of overlapping places (a run like "aaa") every second one, from the left
            new = np.concatenate([[True], np.diff(place) != 1])
            place = place[(place - place[new][np.cumsum(new) - 1]) % 2 == 0]
            symbols[place] = self.merged[at[place]]
            keep = np.ones(len(symbols), bool)
            keep[place + 1] = False
            owner = np.repeat(np.arange(len(lens)), lens)
            symbols = symbols[keep]
            lens = lens - np.bincount(owner[place], minlength=len(lens))
        words = np.concatenate([d[0] for d in done])
        sizes = np.concatenate([d[1] for d in done])
        flat = np.concatenate([d[2] for d in done])
        order = np.argsort(words)
        return flat[ranges((np.cumsum(sizes) - sizes)[order], sizes[order])], sizes[order]

    def _pieces(self, unit: str) -> Iterator[str | int]:
        at = 0
        for m in self.split.finditer(unit) if self.split else ():
            yield from self.words.findall(unit[at : m.start()])
            yield self.special[m[0]]
            at = m.end()
        yield from self.words.findall(unit[at:] if at else unit)

    def __call__(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of units and the number of ids of each."""
        number: dict[str | int, int] = {}
        use, counts = [], []
        for unit in units:
            before = len(use)
            use += [number.setdefault(p, len(number)) for p in self._pieces(unit)]
            counts.append(len(use) - before)
        words = [p.encode("utf-8", "replace") if isinstance(p, str) else b"\0" for p in number]
        lens = np.fromiter(map(len, words), np.int64, len(words))
        flat, sizes = self.merge(self.byte_id[np.frombuffer(b"".join(words), np.uint8)], lens)
        starts = np.cumsum(sizes) - sizes
        for p, i in number.items():
            if isinstance(p, int):
                flat[starts[i]] = p
        use_ = np.array(use, np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes[use_])])
        at = ends[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return flat[ranges(starts[use_], sizes[use_])].astype(np.int32), np.diff(at)

    def decode(self, ids: np.ndarray, lens: np.ndarray) -> list[str]:
        """Text of each list of ids; bytes that are no UTF-8 become U+FFFD."""
        data = self.bytes[ranges(self.at[ids], self.widths[ids])].tobytes()
        ends = np.concatenate([[0], np.cumsum(self.widths[ids])])[np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]


def _broadcast(df: DataFrame, tokenizer_json: str):
    return df.sparkSession.sparkContext.broadcast(open(tokenizer_json, encoding="utf-8").read())


def encode(docs: DataFrame, tokenizer_json: str, text: str = "text", ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the ids of ``text`` as an array of int.

    A null or empty text gives an empty array, texts of any length are encoded
    whole, in segments cut before white space. Repeated rows give repeated
    rows; other columns of ``docs`` are not read; no rows give no rows. The
    string of a special token in a text becomes its id, as in the library.
    """
    content = _broadcast(docs, tokenizer_json)
    (own,) = unused(docs, "text")
    narrow = docs.select(*keep, F.col(text).alias(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = None
        for batch in slices(batches, own):
            coder = coder or UnitCoder(Bpe(content.value))
            flat, lens = coder(texts_of(batch, own))
            out = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], [*keep, ids])

    schema = StructType([*narrow.schema.fields[:-1], StructField(ids, ArrayType(IntegerType()))])
    return narrow.mapInArrow(tidy(run), schema)


def decode(rows: DataFrame, tokenizer_json: str, ids: str = "ids", text: str = "decoded", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the text of the ids. Null ids read as none; an
    id outside the vocabulary adds nothing; no rows give no rows."""
    content = _broadcast(rows, tokenizer_json)
    narrow = rows.select(*keep, F.filter(F.coalesce(F.col(ids), F.array().cast("array<int>")), lambda i: i.isNotNull()).alias(unused(rows, "ids")[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = None
        for batch in batches:
            bpe = bpe or Bpe(content.value)
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                column = part.column(part.num_columns - 1)
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                lens = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
                known = (flat >= 0) & (flat < len(bpe.widths))
                ends = np.concatenate([[0], np.cumsum(known)])[np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)]
                out = pa.array(bpe.decode(flat[known], np.diff(ends)), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], out], [*keep, text])

    schema = StructType([*narrow.schema.fields[:-1], StructField(text, StringType())])
    return narrow.mapInArrow(tidy(run), schema)

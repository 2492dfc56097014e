"""Bounded-space online packing of tokenised documents into fixed windows."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read, small_batches

SEQUENCE = 1024
OPEN_WINDOWS = 64

PIECE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)

_encoders: dict[str, Callable[[str], list[int]]] = {}


def encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids of the byte-level BPE at ``path`` (without ``.json`` / ``.tiktoken``).

    The vocabulary is published for two libraries. Texts go through the faster one; a text that holds the string of a
    special token goes through ``tokenizers``, which has the say. Built once for each worker.
    """
    if path not in _encoders:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        whole = Tokenizer.from_file(f"{path}.json")
        specials = [t.content for t in whole.get_added_tokens_decoder().values()]
        with open(f"{path}.tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        plain = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode(text: str) -> list[int]:
            if any(s in text for s in specials):
                return whole.encode(text, add_special_tokens=False).ids
            return plain.encode_ordinary(text)

        _encoders[path] = encode
    return _encoders[path]


class Window:
    __slots__ = ("pieces", "used")

    def __init__(self) -> None:
        self.used, self.pieces = 0, []

    def add(self, piece: tuple) -> None:
        self.pieces.append((piece, self.used))
        self.used += len(piece[2]) // 4


class Packer:
    """Packs pieces (doc_id, start, ids as bytes, doc_tokens) online with at most ``open_windows`` unfinished windows.

    A document's full windows leave at once. The rest goes whole into the open window that it fills best. When it fits
    nowhere and no window may be opened, it tops up the fullest window, which leaves, and what it has left is placed in
    turn. At the end the open windows are merged: the emptiest are cut to fill the fullest, so one short window is left.
    """

    def __init__(self, size: int, open_windows: int) -> None:
        self.size, self.most, self.open = size, open_windows, []

    def add(self, doc_id, ids: bytes) -> Iterator[Window]:
        total = len(ids) // 4
        for start in range(0, total - self.size + 1, self.size):
            whole = Window()
            whole.add((doc_id, start, ids[4 * start : 4 * (start + self.size)], total))
            yield whole
        if start := total - total % self.size:
            ids = ids[4 * start :]
        if ids:
            yield from self.place((doc_id, start, ids, total))

    def place(self, piece: tuple) -> Iterator[Window]:
        n = len(piece[2]) // 4
        fits = [w for w in self.open if self.size - w.used >= n]
        if fits:
            best = max(fits, key=lambda w: w.used)
            best.add(piece)
            if best.used == self.size:
                self.open.remove(best)
                yield best
        elif len(self.open) < self.most:
            self.open.append(Window())
            self.open[-1].add(piece)
        else:
            fullest = max(self.open, key=lambda w: w.used)
            rest = self.top_up(fullest, piece)
            self.open.remove(fullest)
            yield fullest
            yield from self.place(rest)

    def top_up(self, window: Window, piece: tuple) -> tuple:
        doc_id, start, ids, total = piece
        free = self.size - window.used
        window.add((doc_id, start, ids[: 4 * free], total))
        return doc_id, start + free, ids[4 * free :], total

    def finish(self) -> Iterator[Window]:
        left = sorted(self.open, key=lambda w: w.used)
        self.open = []
        while left:
            fullest = left.pop()
            while left and fullest.used < self.size:
                giver = left[0]
                piece, _ = giver.pieces.pop()
                giver.used -= len(piece[2]) // 4
                if fullest.used + len(piece[2]) // 4 <= self.size:
                    fullest.add(piece)
                else:
                    giver.add(self.top_up(fullest, piece))
                if not giver.pieces:
                    left.pop(0)
            yield fullest


def pack(docs: DataFrame, vocabulary: str, size: int = SEQUENCE, open_windows: int = OPEN_WINDOWS, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cuts tokenised documents into pieces and packs them into sequences of at most ``size`` tokens.

    Returns a row per piece: doc_id, start (ids of its document before it), length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset. A document's ids are its text's and ``end_id``. Each partition packs on its own, in
    one pass and without a shuffle, holding ``open_windows`` windows; sequence ids hold the partition's number, so a
    task that is run again makes the same rows. Every id is in one piece; all sequences but a partition's last are full.
    Null and empty texts are a lone ``end_id``; rows with equal or null ids are documents of their own; an empty table
    gives no rows; columns other than the two named are not read, so they may have any name.
    """

    def run(batches):
        import pandas as pd

        encode = encoder(vocabulary)
        packer, sequence = Packer(size, open_windows), TaskContext.get().partitionId() << 40
        end, rows = end_id.to_bytes(4, "little"), []

        def flush():
            out = pd.DataFrame(rows, columns=PIECE.names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            rows.clear()
            return out

        def put(windows):
            nonlocal sequence
            for w in windows:
                rows.extend((d, start, len(ids) // 4, ids, total, sequence, offset) for (d, start, ids, total), offset in w.pieces)
                sequence += 1

        for batch in batches:
            for doc_id, text in zip(batch["k"], batch["t"], strict=True):
                ids = ids_of(encode, text) + end
                put(packer.add(None if pd.isna(doc_id) else int(doc_id), ids))
                if len(rows) >= 2000:
                    yield flush()
        put(packer.finish())
        yield flush()

    return small_batches(docs).select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t")).mapInPandas(run, PIECE)


def ids_of(encode: Callable[[str], list[int]], text: str | None) -> bytes:
    import numpy as np

    return np.array(encode(text), dtype="<u4").tobytes() if text else b""


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json")).removesuffix(".json")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(read(spark, sf_dir, "documents"), default_vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

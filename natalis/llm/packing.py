"""Best-fit decreasing packing of tokenised documents into windows of fixed length.

A document longer than the window is first cut into full windows; what is left of it is a piece. Pieces are
placed from the longest to the shortest, each into the open window with the least remaining room that still
holds it. Pieces of equal length are exchangeable, so the placement is decided between lengths with counts:
the driver sees one count per length (at most ``window`` numbers, however many documents there are) and keeps
the open windows as runs of sequence numbers per remaining room, found through a segment tree. The pieces
themselves are numbered within their length by Spark, in hash buckets, and look their place up in the plan.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from natalis.llm.shared import bounded_batches, saved
from natalis.operators.ordering import number_rows

WINDOW = 1024
END_ID = 0
_ROWS_OUT = 4096


class RoomTree:
    """Segment tree over remaining room 0..size: how many windows are open below each node."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, room: int, windows: int) -> None:
        node = self.leaves + room
        while node:
            self.open[node] += windows
            node >>= 1

    def tightest(self, length: int) -> int | None:
        """The least room of an open window that is at least ``length``."""
        node = self.leaves + length
        if self.open[node]:
            return length
        while node > 1:
            if not node & 1 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """Placements (length, first rank, first sequence, pieces per window, offset) of best-fit decreasing.

    The ranks from ``first rank`` up to the next placement of that length fill consecutive sequences, ``pieces
    per window`` in each, the first of them at ``offset``. The number of placements depends on the number of
    lengths only.
    """
    tree, runs = RoomTree(window), {}  # runs: room -> [first sequence, windows]
    plan: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def put(room: int, first: int, windows: int) -> None:
        if room and windows:
            tree.add(room, windows)
            runs.setdefault(room, []).append([first, windows])

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                each = window // length
                room, run = window, [sequences, -(-left // each)]
                sequences += run[1]
            else:
                each = room // length
                run = runs[room].pop()
                tree.add(room, -run[1])
            full = min(run[1], left // each)
            if full:
                plan.append((length, rank, run[0], each, window - room))
                put(room - each * length, run[0], full)
                rank, left = rank + full * each, left - full * each
            if full < run[1]:
                used = 0
                if left and left < each:
                    plan.append((length, rank, run[0] + full, left, window - room))
                    put(room - left * length, run[0] + full, 1)
                    rank, left, used = rank + left, 0, 1
                put(room, run[0] + full + used, run[1] - full - used)
    return plan


def bpe_encoder(ranks_path: str, json_path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """Ids of a byte-level BPE vocabulary, without special tokens added.

    The rank table gives the same ids as the tokenizer's JSON file several times faster. A text that spells a
    special token goes through the JSON file, whose reading of it counts.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    fast = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    with open(json_path, encoding="utf-8") as file:
        special = [token["content"] for token in json.load(file).get("added_tokens", [])]
    exact: list[Tokenizer] = []  # loaded when first needed

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            if not exact:
                exact.append(Tokenizer.from_file(json_path))
            return np.array(exact[0].encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(fast.encode_ordinary(text), dtype="<u4")

    return encode


def public_byte_bpe() -> Callable[[str], np.ndarray]:
    """Encoder over the public 50k byte-level vocabulary that is installed on every machine."""
    import public_tokenizers as public

    return bpe_encoder(public.path("byte_bpe_50k.tiktoken"), public.path("byte_bpe_50k.json"), public.PATTERN)


def tokenise(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    encoder: Callable[[], Callable[[str], np.ndarray]] = public_byte_bpe,
) -> DataFrame:
    """Pieces of at most ``window`` ids: (id, start, length, doc_tokens, ids as little-endian unsigned 32-bit).

    Every document ends with one id ``END_ID``, so a NULL or empty text is a piece of length 1. Repeated rows
    are separate documents; a NULL id is kept. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for batch in batches:
            rows: list[tuple] = []
            for key, text in zip(batch.iloc[:, 0], batch.iloc[:, 1], strict=True):
                ids = np.append(encode(text) if isinstance(text, str) else np.empty(0, "<u4"), END_ID).astype("<u4")
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    rows.append((key, start, len(part), len(ids), part.tobytes()))
                if len(rows) >= _ROWS_OUT:
                    yield pd.DataFrame(rows, columns=schema.names)
                    rows = []
            yield pd.DataFrame(rows, columns=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInPandas(cut, schema)


def pack(pieces: DataFrame, key: list[str], window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a table of pieces with a ``length`` from 1 to ``window``.

    ``key`` names the columns that tell pieces apart; equal keys are still numbered apart. ``pieces`` is read
    twice, so it should be a stored table. No pieces give no rows.
    """
    keyed = pieces.withColumn("_piece", F.xxhash64(*key))
    counts = {r["length"]: r["n"] for r in keyed.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_fit_plan(counts, window)
    # one sorted lookup key per placement: the length in the high bits, the first rank in the low ones
    table = np.array(sorted(plan), dtype=np.int64).reshape(-1, 5)
    heads = (table[:, 0] << 48) + table[:, 1]

    @F.pandas_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        row = table[np.searchsorted(heads, (size << 48) + rank, side="right") - 1]
        ahead = rank - row[:, 1]
        return pd.DataFrame({"sequence_id": row[:, 2] + ahead // row[:, 3], "offset": row[:, 4] + ahead % row[:, 3] * size})

    ranked = number_rows(keyed, "_piece", by=["length"], out="_rank").drop("_piece")
    placed = ranked.withColumn("_place", place("length", "_rank"))
    return placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Place of every piece of every document, with a digest of its ids in place of the ids."""
    pieces = tokenise(docs, id_col, text_col, window).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(saved(pieces, "pieces"), [id_col, "start"], window)


def sequences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The packed sequences themselves: (sequence_id, length, ids, documents as (id, start, offset, length)).

    ``ids`` holds the unpadded ids as little-endian unsigned 32-bit numbers. A sequence has at most ``window`` pieces.
    """
    placed = pack(saved(tokenise(docs, id_col, text_col, window), "pieces"), [id_col, "start"], window)
    parts = F.sort_array(F.collect_list(F.struct("offset", id_col, "start", "length", "ids")))
    grouped = placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
    return grouped.select(
        "sequence_id",
        "length",
        F.aggregate("parts", F.lit(b""), lambda got, part: F.concat(got, part["ids"])).alias("ids"),
        F.transform("parts", lambda p: F.struct(p[id_col], p["start"], p["offset"], p["length"])).alias("documents"),
    )

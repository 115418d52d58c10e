"""Near-duplicate documents by SimHash fingerprints and fuzzy hashing with the binary Golay code.

The [23, 12] Golay code is perfect: every word of 23 bits lies within three bits of exactly one codeword. A
64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each padded with zeros to 23. A segment is
given the codeword indices of itself and of all words one bit away, at most six of them. Two segments that
differ in two bits or fewer have a word between them that is at most one bit from either, so they share an
index. Fingerprints that differ in four bits or fewer have, by the pigeonhole principle, two segments with at
most two differing bits together, so they share a key (pair of segments, index, index).

Fingerprints are compared inside a key's bucket, and each bucket hands on a spanning forest of its links, not
all pairs. A bucket above ``pair_limit`` members is not compared in one task: its fingerprints are joined on
all words up to half the distance away instead, where equal words mean a link. That costs 2081 rows a
fingerprint, so it takes over where comparing all members would cost more.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from natalis.llm.components import connected_components
from natalis.llm.shared import bounded_batches, lowered_words_of, saved

MAX_BITS = 4
SHINGLE = 4
SEED = 42
PAIR_LIMIT = 4096
_GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
_SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
_BLOCK = 1 << 15
_SHIFT_LIMIT = 32


# --- fingerprints ----------------------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the lower-cased word shingles, as an unsigned number; 0 for a text without words."""
    words = lowered_words_of(text)
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1])).tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    votes, total = np.zeros(64, np.int64), len(stops)
    for first in range(0, total, _BLOCK):
        hashes = [
            xxhash.xxh64_intdigest(line[a:b], seed)
            for a, b in zip(starts[first : first + _BLOCK], stops[first : first + _BLOCK], strict=False)
        ]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit number. One row per row of ``docs``."""

    bounded_batches(docs.sparkSession)

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        prints = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(prints.view(np.int64))

    return docs.select(F.col(id_col), of(F.col(text_col).cast("string")).alias("fp"))


# --- the code --------------------------------------------------------------------------------------


def _remainders(values: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit polynomials by the generator."""
    left = values.astype(np.int64)
    for bit in range(22, 10, -1):
        left = np.where(left >> bit & 1, left ^ (_GENERATOR << (bit - 11)), left)
    return left


def _error_of_syndrome() -> np.ndarray:
    """The error of at most three bits behind each of the 2048 remainders."""
    errors = [0] + [sum(1 << b for b in bits) for n in (1, 2, 3) for bits in combinations(range(23), n)]
    table = np.zeros(2048, np.int64)
    table[_remainders(np.array(errors))] = errors
    return table


class GolayKeys:
    """Codeword indices of segments, and the bucket keys made of them."""

    def __init__(self) -> None:
        self.error = _error_of_syndrome()
        self.low, self.high = _remainders(np.arange(4096)), _remainders(np.arange(2048) << 12)

    def index(self, words: np.ndarray) -> np.ndarray:
        """Number (12 bits) of the codeword nearest to each 23-bit word."""
        syndrome = self.low[words & 4095] ^ self.high[words >> 12]
        return (words ^ self.error[syndrome]) >> 11

    def near(self, words: np.ndarray, width: int) -> np.ndarray:
        """Per word the different indices of itself and its one-bit neighbours, six columns, -1 where fewer."""
        around = words[:, None] ^ np.concatenate(([0], 1 << np.arange(width)))
        found = np.sort(self.index(around), axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        return -np.sort(-found, axis=1)[:, :6]

    def buckets(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket keys, and the row of ``prints`` that each belongs to."""
        bits = prints.view(np.uint64)
        near = [
            self.near((bits >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64), width) for at, width in _SEGMENTS
        ]
        keys, rows = [], []
        for pair, (a, b) in enumerate(combinations(range(len(_SEGMENTS)), 2)):
            one, two = near[a][:, :, None], near[b][:, None, :]
            key = (pair << 24) + (one << 12) + two
            row, i, j = np.nonzero((one >= 0) & (two >= 0))
            keys.append(key[row, i, j])
            rows.append(row)
        return np.concatenate(keys), np.concatenate(rows)


# --- links -----------------------------------------------------------------------------------------

_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _distance(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return np.bitwise_count((one ^ two).view(np.uint64))


def _forest(prints: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest of the links in one bucket: from each fingerprint to those it is first to reach."""
    left, queue = prints, []
    while len(left) or queue:
        if queue:
            at = queue.pop()
        else:
            at, left = left[0], left[1:]
        close = _distance(left, at) <= max_bits
        if close.any():
            reached = left[close]
            yield np.full(len(reached), at), reached
            queue.extend(reached)
            left = left[~close]


def _links_in(keys: np.ndarray, prints: np.ndarray, max_bits: int, limit: int) -> Iterator[pd.DataFrame]:
    """Links inside complete buckets; a fingerprint of a bucket above the limit comes back as (fingerprint, NULL)."""
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.append(heads, len(keys)))
    small = np.repeat(sizes <= _SHIFT_LIMIT, sizes)
    k, p = keys[small], prints[small]
    for step in range(1, _SHIFT_LIMIT):
        same = np.flatnonzero(k[step:] == k[:-step])
        if not len(same):
            break
        a, b = p[same], p[same + step]
        close = _distance(a, b) <= max_bits
        yield pd.DataFrame({"a": a[close], "b": b[close]})
    for head, size in zip(heads[sizes > _SHIFT_LIMIT], sizes[sizes > _SHIFT_LIMIT], strict=True):
        members = prints[head : head + size]
        if size > limit:
            yield _unpaired(members)
        else:
            for a, b in _forest(members, max_bits):
                yield pd.DataFrame({"a": a, "b": b})


def _unpaired(prints: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"a": pd.Series(prints, dtype="Int64"), "b": pd.Series([None] * len(prints), dtype="Int64")})


def _scan(batches: Iterator[pd.DataFrame], max_bits: int, limit: int) -> Iterator[pd.DataFrame]:
    """Walk over rows sorted by bucket, holding the rows of one bucket over batch borders, never above the limit."""
    keys, prints, open_large = np.empty(0, np.int64), np.empty(0, np.int64), None
    for batch in batches:
        keys = np.concatenate((keys, batch["bucket"].to_numpy(np.int64)))
        prints = np.concatenate((prints, batch["fp"].to_numpy(np.int64)))
        if open_large is not None:
            n = int(np.searchsorted(keys, open_large, side="right"))
            yield _unpaired(prints[:n])
            keys, prints = keys[n:], prints[n:]
        if len(keys):
            open_large = None
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield from _links_in(keys[:cut], prints[:cut], max_bits, limit)
            keys, prints = keys[cut:], prints[cut:]
            if len(keys) > limit:
                open_large = keys[-1]
                yield _unpaired(prints)
                keys, prints = keys[:0], prints[:0]
    if len(keys):
        yield from _links_in(keys, prints, max_bits, limit)


def _links_by_midpoint(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links between fingerprints through all words up to half of ``max_bits`` away, for buckets of any size.

    Two fingerprints that share such a word differ in at most ``max_bits`` bits, and every such pair shares one.
    """
    radius = max_bits // 2
    flips = [0] + [sum(1 << b for b in bits) for n in range(1, radius + 1) for bits in combinations(range(64), n)]

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        masks = np.array(flips, np.uint64).view(np.int64)
        for batch in batches:
            for first in range(0, len(batch), 64):
                p = batch["fp"].to_numpy(np.int64)[first : first + 64]
                yield pd.DataFrame({"word": (p[:, None] ^ masks).ravel(), "fp": np.repeat(p, len(masks))})

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        word, last = None, None
        for batch in batches:
            w, p = batch["word"].to_numpy(np.int64), batch["fp"].to_numpy(np.int64)
            if word is not None:
                w, p = np.append(word, w), np.append(last, p)
            same = w[1:] == w[:-1]
            yield pd.DataFrame({"a": p[:-1][same], "b": p[1:][same]}).drop_duplicates()
            if len(w):
                word, last = w[-1], p[-1]

    words = prints.mapInPandas(around, "word bigint, fp bigint").repartition("word").sortWithinPartitions("word", "fp")
    return words.mapInPandas(chain, _LINKS).distinct()


def links(prints: DataFrame, max_bits: int = MAX_BITS, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Links (a, b) whose connected components are those of all pairs at ``max_bits`` differing bits or fewer.

    ``prints`` has one column ``fp`` of different fingerprints.
    """
    if max_bits not in (2, 3, 4):
        raise ValueError("the segments serve two to four differing bits")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = GolayKeys()
        for batch in batches:
            p = batch["fp"].to_numpy(np.int64)
            for first in range(0, len(p), 8192):
                part = p[first : first + 8192]
                key, row = code.buckets(part)
                yield pd.DataFrame({"bucket": key.astype(np.int32), "fp": part[row]})

    keyed = prints.mapInPandas(spread, "bucket int, fp bigint").repartition("bucket").sortWithinPartitions("bucket", "fp")
    found = saved(keyed.mapInPandas(lambda it: _scan(it, max_bits, pair_limit), _LINKS), "golay-links")
    pairs = found.filter("b IS NOT NULL").distinct()
    large = found.filter("b IS NULL").select(F.col("a").alias("fp")).distinct()
    return pairs.unionByName(_links_by_midpoint(large, max_bits))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    pair_limit: int = PAIR_LIMIT,
) -> DataFrame:
    """(id, fp, component_id): the smallest id among all documents reachable over links.

    NULL, empty and blank texts have fingerprint 0 and link like any other. Repeated rows give repeated rows. A
    NULL id is never the smallest unless its component has no other. An empty table gives no rows.
    """
    prints = saved(fingerprints(docs, id_col, text_col, shingle).withColumnRenamed(id_col, "_id"), "fingerprints")
    first = saved(prints.groupBy("fp").agg(F.min("_id").alias("first")), "first-of-print")
    roots = connected_components(links(first.select("fp"), max_bits, pair_limit))
    linked = roots.join(first, roots["node"] == first["fp"])
    smallest = linked.groupBy("root").agg(F.min("first").alias("smallest"))
    named = roots.join(smallest, "root").select(F.col("node"), "smallest")
    component = saved(
        first.join(named, first["fp"] == named["node"], "left").select(
            first["fp"], F.coalesce("smallest", "first").alias("component_id")
        ),
        "component-of-print",
    )
    return prints.join(component, "fp").select(F.col("_id").alias(id_col), "fp", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """One row of each component, with all its columns: the smallest id's, and of rows with that id the smallest text hash's.

    NULL ids come after all others. Of equal rows one stays.
    """
    digest = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), digest.alias("digest"))
    groups = near_duplicates(docs.select(key.alias("_key"), F.col(text_col).alias("_text")), "_key", "_text", **options)
    chosen = groups.filter(F.col("_key") == F.col("component_id")).groupBy("_key").agg(F.count("*").alias("_rows"))
    chosen = saved(chosen.select(F.col("_key.id").alias("_id"), F.col("_key.digest").alias("_digest"), "_rows"), "chosen")

    def rows_of(some: DataFrame) -> DataFrame:
        return docs.join(some, docs[id_col].eqNullSafe(some["_id"]) & (digest == some["_digest"]), "left_semi")

    single = rows_of(chosen.filter("_rows = 1"))
    repeated = chosen.filter("_rows > 1")
    if repeated.isEmpty():
        return single
    copies = rows_of(repeated).withColumn("_digest", digest).dropDuplicates([id_col, "_digest"]).drop("_digest")
    return single.unionByName(copies)


def hex_fingerprint(column: str = "fp") -> Column:
    """The fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))

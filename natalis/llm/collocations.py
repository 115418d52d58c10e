"""Phrases whose words keep together, counted on a prefix-free parse of the corpus.

A document is its tokens: words, and a mark between pieces. Where a hash of the next four tokens is 0 modulo ``TRIGGER``
a chunk begins, so equal stretches of text are cut alike wherever they stand. A chunk reaches four tokens into the next
one. The corpus becomes a dictionary of distinct chunks with the number of times each occurs: text that repeats is held
and read once. Phrases are counted inside distinct chunks, weighted with the chunk's number; a phrase belongs to the
chunk where its first word lies before the overlap, so the overlaps count once.

A phrase can occur often only if all its words and pairs of neighbours do. So words are counted first; then pairs of
frequent words, as sums by 64-bit hashes; then the phrases of two to four words that consist of frequent pairs, exactly and as
text. Frequent words and pairs are looked up in bit tables of a fixed size: these may let a phrase through that is
dropped after its exact count, and never hold one back. What moves between tasks are counts, added up in each task before.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from natalis.llm.shared import WordCodes, bounded_batches, mixed_bits, saved

TRIGGER = 32
MOST_WORDS = OVERLAP = 4
TABLE_BITS = 26  # 8 MB
_FLUSH_BYTES = 16 << 20
_SALTS = 64
MARK = b"."
# every separator becomes the mark, a tab a blank, and A-Z lower case
_FOLD = bytes.maketrans(b",;:!?\n\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"......... abcdefghijklmnopqrstuvwxyz")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(text: str | None) -> list[bytes]:
    """Words of a text in lower case, with the mark between pieces."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).replace(MARK, b" . ").split() if text else []


def word_codes(words: pa.BinaryArray) -> np.ndarray:
    """64-bit hashes of words that are not empty."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]].astype(np.uint64)
    size = np.diff(ends)
    if not len(size):
        return np.empty(0, np.uint64)
    powers = np.cumprod(np.full(int(size.max()), _FACTOR))
    place = np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], size)
    return mixed_bits(np.add.reduceat((data + np.uint64(1)) * powers[place], ends[:-1] - ends[0]) + size.astype(np.uint64))


def parsed(documents: Sequence[list[bytes]]) -> Iterator[tuple[int, bytes]]:
    """(document, chunk) of token lists; each ends in marks."""
    marks = [MARK] * OVERLAP
    flat = [t for tokens in documents for t in (*tokens, *marks)]
    size = np.array([len(t) + OVERLAP for t in documents], np.int64)
    ends = np.cumsum(size)
    coded = pa.array(flat, pa.binary()).dictionary_encode()
    code = word_codes(coded.dictionary)[coded.indices.to_numpy()]
    window = np.zeros(max(0, len(flat) - OVERLAP + 1), np.uint64)
    for t in range(OVERLAP):
        window = window * _FACTOR + code[t : t + len(window)]
    begin = np.zeros(len(flat), bool)
    begin[: len(window)] = mixed_bits(window) % np.uint64(TRIGGER) == 0
    begin[(ends - size)] = True  # the first token; and no chunk begins in the marks
    begin[np.repeat(ends, OVERLAP) - np.tile(np.arange(1, OVERLAP + 1), len(ends))] = False
    starts = np.flatnonzero(begin)
    of = np.searchsorted(ends, starts, side="right")
    # a chunk reaches OVERLAP tokens past the beginning of the next one, or to the end of its document
    stops = np.minimum(np.append(starts[1:], len(flat)) + OVERLAP, ends[of])
    for i, a, b in zip(of.tolist(), starts.tolist(), stops.tolist(), strict=True):
        yield i, b" ".join(flat[a:b])


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, chunk, n): the distinct chunks of (lang, text) rows and how often each occurs."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = Counter(), 0

        def flushed() -> pa.RecordBatch:
            keys = list(held)
            return pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()), pa.array(list(held.values()), pa.int64())], ["lang", "chunk", "n"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for i, chunk in parsed([tokens_of(text.as_py()) for text in batch.column(1)]):
                held[langs[i], chunk] += 1
                size += len(chunk)
                if size > _FLUSH_BYTES:
                    yield flushed()
                    held.clear()
                    size = 0
        yield flushed()

    parts = docs.mapInArrow(parse, "lang string, chunk binary, n bigint")
    return parts.groupBy("lang", "chunk").agg(F.sum("n").alias("n"))


def _fold(start: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    for w in words:
        start = mixed_bits(start * _FACTOR + w)
    return start


def _is_set(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - TABLE_BITS)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def bit_table(hashes: DataFrame) -> Broadcast:
    """Bits at the first bits of the hashes ``h``; 8 MB however many there are."""
    at = F.shiftrightunsigned("h", 64 - TABLE_BITS + 6).cast("int").alias("at")
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {64 - TABLE_BITS}) & 63 AS INT))")
    found = hashes.groupBy(at).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << TABLE_BITS - 6, np.uint64)
    table[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(table)


def word_hashes(words: DataFrame) -> DataFrame:
    """Hashes ``h`` of the rows (lang, phrase) of one word."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            lang = np.array([codes[x.encode("utf-8", "surrogatepass")] for x in batch.column("lang").to_pylist()], np.uint64)
            word = word_codes(batch.column("phrase").cast(pa.binary()))
            yield pa.record_batch([pa.array(_fold(lang, [word]).view(np.int64))], ["h"])

    return words.select("lang", "phrase").mapInArrow(hashes, "h bigint")


class _Laid:
    """Tokens of chunks one after another, with the place of each in the list of different ones."""

    def __init__(self, batch: pa.RecordBatch):
        langs, parts = batch.column("lang").to_pylist(), pc.split_pattern(batch.column("chunk"), " ")
        size = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.list_flatten(parts).dictionary_encode()
        self.ids, self.words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        place = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
        self.langs = list(place)
        self.lang = np.repeat(np.array([place[x] for x in langs], np.int64), size)
        self.times = np.repeat(batch.column("n").to_numpy(), size)
        # where a phrase of this chunk may begin, and whether each token is a word
        self.own = np.arange(len(self.ids)) < np.repeat(np.cumsum(size), size) - OVERLAP
        self.word = self.ids != pc.index(self.words, pa.scalar(MARK, self.words.type)).as_py()

    def begins(self, words: int) -> np.ndarray:
        """Whether a phrase of so many words begins at each place."""
        begin = self.own & self.word
        for t in range(1, words):
            begin[: len(begin) - t] &= self.word[t:]
        return begin

    def hashes(self, codes: WordCodes) -> tuple[np.ndarray, np.ndarray]:
        """Of the word at each place, and of the pair that begins there."""
        own = word_codes(self.words)[self.ids]
        lang = np.array([codes[x.encode("utf-8", "surrogatepass")] for x in self.langs], np.uint64)[self.lang]
        single = _fold(lang, [own])
        return single, _fold(single[:-1], [own[1:]])

    def phrases(self, at: np.ndarray, words: int) -> pa.Array:
        """The phrases of so many words that begin at the places ``at``."""
        parts = [self.words.take(pa.array(self.ids[at + t])) for t in range(words)]
        return (pc.binary_join_element_wise(*parts, b" ") if words > 1 else parts[0]).cast(pa.string())

    def counted(self, at: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
        """The first place of each different phrase of so many words that begins at one of ``at``, and how often it does."""
        different = len(self.words)
        key, reach = self.lang[at] * different + self.ids[at], len(self.langs) * different
        if words == 1:
            total, first = np.zeros(reach, np.int64), np.zeros(reach, np.int64)
            np.add.at(total, key, self.times[at])
            first[key] = at
            return first[total > 0], total[total > 0]
        for t in range(1, words):
            if reach * different >= 1 << 62:
                key = np.unique(key, return_inverse=True)[1]
                reach = len(at)
            key = key * different + self.ids[at + t]
            reach *= different
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.diff(key[order], prepend=-1))
        return at[order[edges]], np.add.reduceat(self.times[at[order]], edges) if len(edges) else edges


def phrase_counts(chunked: DataFrame, sizes: Sequence[int], pairs: Broadcast | None = None) -> DataFrame:
    """(lang, phrase, k, f) of the phrases of k words, k in ``sizes``; with a table, of those whose pairs are all in it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            if not batch.num_rows:
                continue
            laid = _Laid(batch)
            often = None if pairs is None else _is_set(pairs.value, laid.hashes(codes)[1])
            for words in sizes:
                begin = laid.begins(words)
                for t in range(words - 1 if often is not None else 0):
                    begin[: len(often) - t] &= often[t:]
                at, total = laid.counted(np.flatnonzero(begin), words)
                langs = pa.array(laid.langs, pa.string()).take(pa.array(laid.lang[at]))
                yield pa.record_batch([langs, laid.phrases(at, words), pa.array(np.full(len(at), words, np.int32)), pa.array(total, pa.int64())], ["lang", "phrase", "k", "f"])

    found = chunked.mapInArrow(count, "lang string, phrase string, k int, f bigint")
    return found.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f"))


def pair_sums(chunked: DataFrame, words: Broadcast) -> DataFrame:
    """(h, f): occurrences of pairs of words in the table, by the hash of the pair."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            if batch.num_rows:
                laid = _Laid(batch)
                single, pair = laid.hashes(codes)
                often = _is_set(words.value, single)
                at = np.flatnonzero(laid.begins(2)[:-1] & often[:-1] & often[1:])
                yield pa.record_batch([pa.array(pair[at].view(np.int64)), pa.array(laid.times[at])], ["h", "f"])

    return chunked.mapInArrow(add, "h bigint, f bigint").groupBy("h").agg(F.sum("f").alias("f"))


def _exact(column: str):
    return F.col(column).cast("decimal(20,0)")


def mined(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30, top: int = 2000, inside_percent: int = 80
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's ``top`` phrases of two to four words.

    ``a`` is the number of occurrences, at least ``least``; ``l`` and ``r`` are those of the two parts at the cut with the
    lowest score floor(2000000 * a / (l + r)), at ties the first; ``n`` is the number of words of the lang. A phrase inside a longer
    one that occurs at least ``inside_percent`` percent as often is left out. Higher scores come first, then larger ``a``, then the
    smaller phrase in byte order. A NULL lang is ``und``; NULL, empty and blank texts have no words; repeated rows
    count each; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    chunked = saved(dictionary(rows), "chunks")
    single = saved(phrase_counts(chunked, [1]), "words")
    sizes = single.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = single.filter(F.col("f") >= least)
    pairs = bit_table(pair_sums(chunked, bit_table(word_hashes(frequent))).filter(F.col("f") >= least))
    phrases = phrase_counts(chunked, range(2, MOST_WORDS + 1), pairs).filter(F.col("f") >= least)
    counted = frequent.unionByName(saved(phrases, "phrases"))

    several = counted.filter("k > 1")
    cuts = several.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', cut)"))
    cuts = cuts.withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    short = counted.filter(F.col("k") < MOST_WORDS)
    cuts = cuts.join(short.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(short.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.withColumns({"x": F.lit(2_000_000).cast("decimal(7,0)") * _exact("a"), "y": _exact("l") + _exact("r")})
    cuts = cuts.withColumn("score", F.expr("x div y"))
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("c")).select("lang", "phrase", "a", "c.score", "c.l", "c.r")

    longer = counted.filter("k > 2").withColumn("w", F.split("phrase", " "))
    inner = "flatten(transform(sequence(2, k - 1), m -> transform(sequence(1, k - m + 1), i -> array_join(slice(w, i, m), ' '))))"
    inside = longer.select("lang", "f", F.explode(F.expr(inner)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    free = lowest.join(inside, ["lang", "phrase"], "left")
    free = free.filter(F.col("most").isNull() | (_exact("most") * 100 < _exact("a") * inside_percent)).drop("most")

    # the best of every part of a lang, then the best of these
    best = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    salted = free.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    salted = salted.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best))).filter(F.col("_at") <= top)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

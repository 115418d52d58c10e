"""Passages that stand in a document with a smaller id, found with suffix automata of reference shards and removed.

A window is ``length`` consecutive words. Its least eight-word hash, which equal windows have in common, decides where
it is looked up; consecutive windows with the same one are a segment. Segments whose hash occurs in one document only
can be left out, and equal segments are looked up once, with the smallest id that has them: for any later document all
their windows go. What remains, several different segments to one hash, makes the reference shards, each a bounded
number of words. A shard's documents pass in the order of their ids: each is streamed through the suffix automaton of
those before it, whose matching statistics give the longest earlier passage that ends at every word, and is then added
to it. Spans where the statistic reaches ``length`` are removed.

A hash with very many different segments (a passage amid ever different words) would be more than one automaton should
hold. Such segments are cut again by the least hash of longer runs of words, and again, up to whole windows: the longer
the run, the more of the windows that reach out of the passage share it with no other document.

Copies of a whole text are looked up once. Texts move twice at most, and only documents that share a hash the second time.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from natalis.llm.shared import WordCodes, bounded_batches, mixed_bits, saved, words_of

LENGTH = 50
SEED = 8  # words of the hash that decides where a window is looked up
LONGER = (0.4, 0.7, 1.0)  # shares of the window that are hashed where too many segments have one hash
LONGEST = 64  # windows of a segment
SHARD_WORDS = 30_000
WIDE = 128  # different segments to one hash that an automaton takes
_NOTHING = hashlib.sha256().hexdigest()


def _digest(data: bytes, size: int) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def segments(codes: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, least hash) of each run of windows with the same least hash."""
    windows, seed = len(codes) - length + 1, min(seed, length)
    if windows < 1:
        return (np.empty(0, np.int32),) * 2 + (np.empty(0, np.int64),)
    low = np.zeros(len(codes) - seed + 1, np.uint64)
    for t in range(seed):
        low = low * np.uint64(0x9E3779B97F4A7C15) + codes[t : t + len(low)]
    low = mixed_bits(low)
    spread, have = length - seed + 1, 1
    while 2 * have <= spread:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < spread:
        low = np.minimum(low[: have - spread], low[spread - have :])
    starts = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    sizes = np.diff(np.append(starts, windows))
    pieces = -(-sizes // LONGEST)
    inside = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts, ends = np.repeat(starts, pieces) + inside * LONGEST, np.repeat(starts + sizes, pieces)
    return starts.astype(np.int32), np.minimum(ends - starts, LONGEST).astype(np.int32), low[starts].view(np.int64)


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.long = [-1], [0]

    def _clone(self, of: int, long: int) -> int:
        self.next.append(self.next[of].copy())
        self.link.append(self.link[of])
        self.long.append(long)
        return len(self.long) - 1

    def _redirect(self, at: int, word: bytes, old: int, new: int) -> None:
        while at >= 0 and self.next[at].get(word) == old:
            self.next[at][word] = new
            at = self.link[at]

    def add(self, words: list[bytes]) -> None:
        edges, link, long = self.next, self.link, self.long
        last = 0
        for word in words:
            known = edges[last].get(word)
            if known is not None:  # the sequence so far stands in the automaton already
                if long[known] != long[last] + 1:
                    clone = self._clone(known, long[last] + 1)
                    link[known] = clone
                    self._redirect(last, word, known, clone)
                    known = clone
                last = known
                continue
            edges.append({})
            link.append(0)
            long.append(long[last] + 1)
            new, at = len(long) - 1, last
            while at >= 0 and word not in edges[at]:
                edges[at][word] = new
                at = link[at]
            if at >= 0:
                known = edges[at][word]
                if long[known] != long[at] + 1:
                    clone = self._clone(known, long[at] + 1)
                    link[known] = clone
                    self._redirect(at, word, known, clone)
                    known = clone
                link[new] = known
            last = new

    def statistics(self, words: list[bytes]) -> list[int]:
        """For each word the length of the longest passage of the automaton that ends there."""
        edges, link, long = self.next, self.link, self.long
        at, matched, out = 0, 0, []
        for word in words:
            while word not in edges[at] and at:
                at = link[at]
                matched = long[at]
            if word in edges[at]:
                at = edges[at][word]
                matched += 1
            out.append(matched)
        return out


def spans(flagged: np.ndarray, length: int) -> tuple[list[int], list[int]]:
    """First word and end of the stretches that the flagged windows (ascending) cover."""
    if not len(flagged):
        return [], []
    cut = np.flatnonzero(np.diff(flagged) > length) + 1
    return flagged[np.concatenate(([0], cut))].tolist(), (flagged[np.append(cut - 1, len(flagged) - 1)] + length).tolist()


def earlier_spans(rows: list[tuple], length: int) -> Iterator[tuple]:
    """(name, starts, stops) of the spans of each (id, name, words) that also stand in one with a smaller id."""
    automaton, waiting, held = Automaton(), [], None
    for key, name, words in sorted(rows, key=lambda r: r[0]):
        if waiting and key != held:
            for one in waiting:
                automaton.add(one)
            waiting = []
        found = np.flatnonzero(np.asarray(automaton.statistics(words)) >= length) - length + 1
        waiting.append(words)
        held = key
        if len(found):
            yield name, *spans(found, length)


def _batch(columns: list, schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def _scanned(docs: DataFrame, id_field: T.StructField, length: int) -> DataFrame:
    """Per row: id, digest of the text, number of words, digest of all words, and its segments."""
    schema = T.StructType(
        [
            id_field,
            T.StructField("_digest", T.BinaryType()),
            T.StructField("_words", T.LongType()),
            T.StructField("_sha", T.StringType()),
            T.StructField("_starts", T.ArrayType(T.IntegerType())),
            T.StructField("_sizes", T.ArrayType(T.IntegerType())),
            T.StructField("_keys", T.ArrayType(T.LongType())),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            n, sha, parts = [], [], ([], [], [])
            for text in batch.column("_text"):
                words = words_of(text.as_py())
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                found = segments(np.fromiter(map(codes.__getitem__, words), np.uint64, len(words)), length)
                for held, values in zip(parts, found, strict=True):
                    held.append(values)
            ends = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in parts[0]]))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(p) if p else [], t)) for p, t in zip(parts, (pa.int32(), pa.int32(), pa.int64()), strict=True)]
            yield _batch([batch.column("_id"), batch.column("_digest"), n, sha, *lists], schema)

    return docs.mapInArrow(scan, schema)


def _cut_schema(id_field: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("_segment", T.BinaryType()),
            T.StructField("_key", T.LongType()),
            T.StructField("_row", T.LongType()),
            id_field,
            T.StructField("_start", T.IntegerType()),
            T.StructField("_size", T.IntegerType()),
            T.StructField("_content", T.BinaryType()),
        ]
    )


def _cut(candidates: DataFrame, id_field: T.StructField, length: int) -> DataFrame:
    """A row per candidate segment: digest of its words, its hash, where it stands, and the words unless a task has sent them."""
    schema = _cut_schema(id_field)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for batch in batches:
            for i in range(batch.num_rows):
                row, key, text, near = (batch.column(c)[i].as_py() for c in ("_row", "_id", "_text", "_near"))
                words, out = words_of(text), []
                for one in near:
                    start, size = one["_start"], one["_size"]
                    content = b" ".join(words[start : start + size + length - 1])
                    name = _digest(content, 16)
                    out.append((name, one["_key"], row, key, start, size, None if name in sent else content))
                    if len(sent) >= 200_000:
                        sent.clear()
                    sent.add(name)
                yield _batch([list(c) for c in zip(*out, strict=True)], schema)

    return candidates.mapInArrow(cut, schema)


_SPAN = T.ArrayType(T.StructType([T.StructField("_a", T.IntegerType()), T.StructField("_b", T.IntegerType())]))
_FOUND = T.StructType([T.StructField("_number", T.LongType()), T.StructField("_spans", _SPAN)])


def _by_automata(distinct: DataFrame, length: int) -> DataFrame:
    """Spans of each distinct segment that stand in an earlier document, shard by shard; a hash is in one shard."""
    words = distinct.agg(F.coalesce(F.sum(F.col("_size") + (length - 1)), F.lit(0))).first()[0]
    shards = max(4 * int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-words // SHARD_WORDS))

    def match(table: pa.Table) -> pa.Table:
        columns = [table[c].to_pylist() for c in ("_key", "_first", "_number", "_content")]
        times = Counter(columns[0])
        rows = [(first, number, content.split(b" ")) for key, first, number, content in zip(*columns, strict=True) if times[key] > 1]
        found = list(earlier_spans(rows, length))
        pairs = [[{"_a": a, "_b": b} for a, b in zip(*f[1:], strict=True)] for f in found]
        return pa.Table.from_batches([_batch([[f[0] for f in found], pairs], _FOUND)])

    dealt = distinct.select(F.pmod(F.xxhash64("_key"), F.lit(shards)).alias("_shard"), "_key", "_first", "_number", "_content")
    return dealt.groupBy("_shard").applyInArrow(match, _FOUND)


def _cut_again(distinct: DataFrame, id_field: T.StructField, length: int, seed: int) -> DataFrame:
    """The windows of distinct segments as shorter segments, by the least hash of ``seed`` words."""
    schema = _cut_schema(id_field)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            out = []
            for number, first, content in zip(*(batch.column(c).to_pylist() for c in ("_number", "_first", "_content")), strict=True):
                words = content.split(b" ")
                found = segments(np.fromiter(map(codes.__getitem__, words), np.uint64, len(words)), length, seed)
                for start, size, key in zip(*(f.tolist() for f in found), strict=True):
                    own = b" ".join(words[start : start + size + length - 1])
                    out.append((_digest(own, 16), key, number, first, start, size, own))
            yield _batch([list(c) for c in zip(*out, strict=True)] if out else [[]] * len(schema), schema)

    return distinct.select("_number", "_first", "_content").mapInArrow(cut, schema)


def _lost(cut: DataFrame, id_field: T.StructField, length: int, wide: int, seeds: list[int]) -> DataFrame:
    """(_row, _spans): what each row of ``cut`` segments has in common with a smaller id, as spans of words.

    Equal segments are looked up once. A hash with one segment has nothing to compare; one with up to ``wide`` goes
    to an automaton; the segments of the others are cut again by the next of ``seeds``. At the last, whole windows,
    segments with equal hashes are stretches of one word, of which there are ``LONGEST`` lengths at most.
    """
    distinct = cut.groupBy("_segment").agg(F.min("_id").alias("_first"), F.min("_key").alias("_key"), F.min("_size").alias("_size"), F.max("_content").alias("_content"))
    distinct = saved(distinct.withColumn("_number", F.monotonically_increasing_id()), "distinct-segments")
    per_key = distinct.groupBy("_key").agg(F.count("*").alias("_different"))
    crowded = saved(per_key.filter(F.col("_different") > wide if seeds else F.lit(False)).select("_key"), "crowded")
    many = crowded.count()
    few = distinct.join(crowded, "_key", "left_anti") if many else distinct
    found = _by_automata(few, length)
    if many:
        again = saved(_cut_again(distinct.join(crowded, "_key"), id_field, length, seeds[0]), "cut-again")
        inner = _lost(again, id_field, length, wide, seeds[1:])
        found = found.unionByName(inner.select(F.col("_row").alias("_number"), "_spans"))
    known = distinct.select("_segment", "_first", "_number").join(found, "_number", "left")
    placed = cut.select("_segment", "_row", "_id", "_start", "_size").join(known, "_segment")
    later = F.col("_id") > F.col("_first")
    whole = F.array(F.struct(F.col("_start").alias("_a"), (F.col("_start") + F.col("_size") + (length - 1)).alias("_b")))
    inside = F.transform("_spans", lambda s: F.struct((s["_a"] + F.col("_start")).alias("_a"), (s["_b"] + F.col("_start")).alias("_b")))
    placed = placed.filter(later | F.col("_spans").isNotNull()).select("_row", F.when(later, whole).otherwise(inside).alias("_spans"))
    return placed.groupBy("_row").agg(F.flatten(F.collect_list("_spans")).alias("_spans"))


def _removed(docs: DataFrame, length: int) -> DataFrame:
    """(_digest, _gone, _kept): words removed and digest of the kept words, for the first document of a text that loses some."""
    schema = T.StructType([T.StructField("_digest", T.BinaryType()), T.StructField("_gone", T.LongType()), T.StructField("_kept", T.StringType())])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for digest, text, gone in zip(*(batch.column(c).to_pylist() for c in ("_digest", "_text", "_spans")), strict=True):
                words = words_of(text)
                keep = kept_words(words, ((s["_a"], s["_b"]) for s in gone))
                out.append((digest, len(words) - len(keep), hashlib.sha256(b" ".join(keep)).hexdigest()))
            yield _batch([list(c) for c in zip(*out, strict=True)] if out else [[]] * 3, schema)

    return docs.mapInArrow(remove, schema)


def kept_words(words: list[bytes], gone) -> list[bytes]:
    """The words outside the spans (first, end) of ``gone``."""
    keep, at = [], 0
    for start, stop in sorted(gone):
        keep += words[at:start]
        at = max(at, stop)
    return keep + words[at:]


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, wide: int = WIDE) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every document, without the passages that a smaller id has.

    Every word goes that is covered by ``length`` consecutive words which also stand in a document with a smaller id;
    documents are compared as they came in. NULL, empty and blank texts have no words. A document with a NULL id loses
    nothing and takes nothing from others. Rows with equal ids take nothing from each other; equal rows have equal results.
    """
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.unhex(F.md5(text)).alias("_digest"))
    id_field = T.StructField("_id", rows.schema["_id"].dataType)
    scan = saved(_scanned(rows, id_field, length).withColumn("_row", F.monotonically_increasing_id()), "scanned")
    firsts = scan.filter(F.col("_id").isNotNull()).groupBy("_digest").agg(F.min(F.struct("_id", "_row")).alias("_f"))
    firsts = saved(firsts.select("_digest", F.col("_f._id").alias("_first"), F.col("_f._row").alias("_row")), "first-of-text")

    # segments whose hash is in two documents at least
    own = scan.select("_row", "_id", "_digest", F.arrays_zip("_starts", "_sizes", "_keys").alias("_z")).filter(F.size("_z") > 0)
    own = saved(own.join(firsts.select("_row"), "_row", "left_semi"), "segments")
    flat = own.select("_row", "_id", F.explode("_z").alias("_s")).select("_row", "_id", "_s.*")
    flat = flat.toDF("_row", "_id", "_start", "_size", "_key")
    shared = flat.groupBy("_key").agg(F.min("_id").alias("_a"), F.max("_id").alias("_b")).filter("_a < _b").select("_key")
    near = flat.join(shared, "_key").groupBy("_row").agg(F.collect_list(F.struct("_start", "_size", "_key")).alias("_near"))
    near = near.join(own.select("_row", "_id", "_digest"), "_row")
    candidates = saved(rows.join(near, ["_digest", "_id"]), "candidates")

    seeds = sorted({round(length * share) for share in LONGER if round(length * share) > SEED})
    lost = _lost(saved(_cut(candidates, id_field, length), "cut"), id_field, length, wide, seeds)

    # back to documents
    changed = _removed(candidates.select("_row", "_digest", "_text").join(lost, "_row").select("_digest", "_text", "_spans"), length)
    changed = changed.groupBy("_digest").agg(F.min("_gone").alias("_gone"), F.min("_kept").alias("_kept"))

    per_text = firsts.select("_digest", "_first").join(changed, "_digest", "left")
    whole_rows = scan.select("_id", "_digest", "_words", "_sha").join(per_text, "_digest", "left")
    copy = (F.col("_id") > F.col("_first")) & (F.col("_words") >= length)
    first = F.col("_id") == F.col("_first")
    return whole_rows.select(
        F.col("_id").alias(id_col),
        F.col("_words").alias("n_words"),
        F.when(copy, F.col("_words")).when(first, F.coalesce("_gone", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(copy, F.lit(_NOTHING)).when(first, F.coalesce("_kept", "_sha")).otherwise(F.col("_sha")).alias("kept_sha256"),
    )

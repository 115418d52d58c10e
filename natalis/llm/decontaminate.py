"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

A mask is a fixed pattern of word positions; the positions it leaves out may hold any word. The masks are
chosen so that every stretch of ``WINDOW`` aligned words with at most ``WINDOW - MIN_EQUAL`` substitutions has a
place where one of them finds equal words only. Hashes of the masked words are joined between benchmark and
documents. Around each hit the words of both sides are laid side by side, and every window through the hit with
at least ``MIN_EQUAL`` equal words is an overlap.

Most positions of most documents match nothing. Before anything is shuffled, their hashes are looked up in a bit
table of all benchmark hashes. Its size is fixed, so it can be part of the plan; with a very large benchmark it
lets more positions pass, which the join then drops.

Items of fewer than ``WINDOW`` words have no window. They are looked for as a whole: the hash of all their words is
joined to the hashes of as many words at every place of a document. Items of fewer than ``LEAST_INSIDE`` words are
ordinary phrases, which clean documents hold too; they only overlap documents that consist of just these words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, MIN_EQUAL = 12, 10
#: together they have a clean place in every 12 words with two substitutions (a test goes through all of them)
MASKS = ((0, 1, 2, 3, 4, 6), (0, 1, 2, 3, 5, 6), (0, 1, 4, 7, 8, 9))
TABLE_BITS = 1 << 22
#: items of at least so many words are found inside a document, shorter ones only as the whole document
LEAST_INSIDE = 5
#: scripts written without blanks; each of their letters counts as a word
UNSPACED = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
#: code points that may belong to one of these scripts, by two plain ranges, which are quicker to test
_MAYBE_UNSPACED = r"[\x{0E00}-\x{1FFF}\x{2E80}-\x{10FFFF}]"


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits; an empty array for a NULL text.

    Letters of a script that is written without blanks are words of their own.
    """
    text, letter = F.coalesce(text, F.lit("")), "".join(rf"\p{{Is{script}}}" for script in UNSPACED)
    text = F.when(text.rlike(_MAYBE_UNSPACED), F.regexp_replace(text, f"([{letter}])", " $1 ")).otherwise(text)
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(df: DataFrame, hashes: str, masks: Sequence[Sequence[int]], place: str) -> DataFrame:
    """A row per place and mask, with the hash of the mask's number and the words under it as ``seed``.

    A mask that sticks out at the end of the text hashes fewer words. ``_tick`` is a number that Spark may not
    compute twice; a filter that uses it comes after the hash, which is so computed once and not at each use.
    """
    n, weight = len(masks), len(masks[0])
    span = min(m[-1] for m in masks) + 1
    steps = F.explode(F.sequence(F.lit(0), n * (F.size(hashes) - span + 1) - 1))
    at, number = F.expr(f"_step div {n}").cast("int"), F.expr(f"_step % {n}")
    words = [F.get(F.col(hashes), at + F.get(F.array(*[F.lit(m[j]) for m in masks]), number)) for j in range(weight)]
    rows = df.withColumn("_step", steps)
    return rows.withColumns({"seed": F.xxhash64(number, *words), place: at, "_mask": number, "_tick": F.monotonically_increasing_id()})


def _whole(hashes: str, size: str, place: Column) -> dict[str, Column]:
    """The ``size`` words from a place on, and their hash as ``seed``."""
    words = F.slice(F.col(hashes), place + 1, F.col(size))
    return {"seed": F.xxhash64(F.lit(-1), F.col(size), words), "_words": words}


def _around(hashes: str, place: str, window: int) -> Column:
    """The words of all windows through a place: at most window - 1 before it and window after its first."""
    first = F.greatest(F.col(place) - (window - 1), F.lit(0))
    return F.slice(F.col(hashes), first + 1, F.col(place) + window - first)


def _word_and_bits(seed: Column, words: int) -> tuple[Column, Column]:
    """Where a seed is kept in the bit table: the word's number, and three bits of it."""
    one = [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(seed, at).bitwiseAND(F.lit(63)).cast("int")) for at in (0, 6, 12)
    ]
    return F.shiftright(seed, 20).bitwiseAND(F.lit(words - 1)).cast("int"), one[0].bitwiseOR(one[1]).bitwiseOR(one[2])


def bit_table(seeds: DataFrame, bits: int = TABLE_BITS) -> DataFrame:
    """One row with an array of ``bits / 64`` numbers, a power of two, in which up to three bits per ``seed`` are set."""
    at, pattern = _word_and_bits(F.col("seed"), bits // 64)
    filled = seeds.groupBy(at.alias("at")).agg(F.bit_or(pattern).alias("bits"))
    every = seeds.sparkSession.range(bits // 64).join(filled, F.col("id") == F.col("at"), "left")
    ordered = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return every.agg(F.transform(ordered, lambda e: e["bits"]).alias("table"))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    min_equal: int = MIN_EQUAL,
    masks: Sequence[Sequence[int]] = MASKS,
    bits: int = TABLE_BITS,
) -> DataFrame:
    """(id, item, doc_start, doc_end, item_start, n_windows, max_equal) per document, item and alignment.

    Positions count words from 0; the overlap runs from the first word of its first window to the end of its
    last. An item of fewer than ``window`` words is one window of its own length, all of whose words must be equal;
    below ``LEAST_INSIDE`` words it must be the whole document. NULL, empty and blank texts have no rows. Repeated
    documents or items with one id count once; NULL ids are kept as such. All masks have equally many positions.
    """
    items = benchmark.select(F.col(item_col).alias("_item"), word_hashes(F.col(item_text_col).cast("string")).alias("_b"))
    reach = F.get(F.array(*[F.lit(m[-1]) for m in masks]), F.col("_mask"))
    seeds = _seeds(items.filter(F.size("_b") >= window), "_b", masks, "_j").filter(F.col("_j") + reach < F.size("_b"))
    seeds = seeds.select("seed", "_item", "_j", _around("_b", "_j", window).alias("_near_b"))
    short = items.withColumn("_size", F.size("_b")).filter(F.col("_size").between(1, window - 1))
    short = short.withColumns(_whole("_b", "_size", F.lit(0))).select("seed", "_item", "_words")
    table = bit_table(seeds.select("seed").unionByName(short.select("seed")), bits)

    words = docs.select(F.col(id_col).alias("_doc"), word_hashes(F.col(text_col).cast("string")).alias("_a"))
    places = _seeds(words.filter(F.size("_a") >= window), "_a", masks, "_i")
    at, pattern = _word_and_bits(F.col("seed"), bits // 64)
    known = F.get(table.scalar(), at).bitwiseAND(pattern) == pattern
    hits = places.filter(known & (F.col("_tick") >= 0)).select("seed", "_doc", "_i", _around("_a", "_i", window).alias("_near_a"))
    pairs = hits.join(seeds, "seed")
    # the hit's own place in either slice, then both slices from the same word before it
    at_a, at_b = F.least("_i", F.lit(window - 1)), F.least("_j", F.lit(window - 1))
    before = F.least(at_a, at_b)
    cut = lambda near, at: F.slice(F.col(near), at - before + 1, F.lit(2 * window))
    equal = F.zip_with(cut("_near_a", at_a), cut("_near_b", at_b), lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    length = F.least(F.size("_near_a") - at_a, F.size("_near_b") - at_b) + before
    pairs = pairs.withColumns({"_equal": equal, "_before": before, "_length": length}).filter(F.col("_length") >= window)
    starts = F.transform(
        F.sequence(F.lit(0), F.col("_length") - window),
        lambda s: F.struct(
            (s - F.col("_before")).alias("shift"),
            F.aggregate(F.slice(F.col("_equal"), s + 1, F.lit(window)), F.lit(0), lambda n, e: n + e).alias("equal"),
        ),
    )
    good = pairs.select("_doc", "_item", "_i", "_j", F.explode(F.filter(starts, lambda s: s["equal"] >= min_equal)).alias("_w"))
    windows = good.select(
        "_doc",
        "_item",
        (F.col("_i") + F.col("_w.shift")).alias("_start"),
        (F.col("_j") + F.col("_w.shift")).alias("_item_start"),
        F.col("_w.equal").alias("_n"),
        F.lit(window).alias("_size"),
    )
    # without short items, the list of their lengths is empty and no text is taken apart a second time
    sizes = short.agg(F.collect_set(F.size("_words")).alias("sizes")).scalar()
    texts = docs.filter(F.size(sizes) > 0).select(
        F.col(id_col).alias("_doc"), word_hashes(F.col(text_col).cast("string")).alias("_a"), sizes.alias("_sizes")
    )
    fits = F.filter("_sizes", lambda m: (m == F.size("_a")) | ((m >= LEAST_INSIDE) & (m < F.size("_a"))))
    texts = texts.withColumn("_size", F.explode(fits))
    texts = texts.withColumn("_i", F.explode(F.sequence(F.lit(0), F.size("_a") - F.col("_size"))))
    texts = texts.withColumns({**_whole("_a", "_size", F.col("_i")), "_tick": F.monotonically_increasing_id()})
    found = texts.filter(known & (F.col("_tick") >= 0)).select("seed", "_words", "_doc", "_i", "_size").join(short, ["seed", "_words"])
    whole = found.select("_doc", "_item", F.col("_i").alias("_start"), F.lit(0).alias("_item_start"), F.col("_size").alias("_n"), "_size")
    windows = windows.unionByName(whole).distinct()
    grouped = windows.groupBy("_doc", "_item", F.col("_start") - F.col("_item_start")).agg(
        F.min("_start").alias("doc_start"),
        F.max(F.col("_start") + F.col("_size")).alias("doc_end"),
        F.min("_item_start").alias("item_start"),
        F.count("*").alias("n_windows"),
        F.max("_n").alias("max_equal"),
    )
    return grouped.select(
        F.col("_doc").alias(id_col), F.col("_item").alias(item_col), "doc_start", "doc_end", "item_start", "n_windows", "max_equal"
    )


def without_overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: object
) -> DataFrame:
    """The rows of ``docs`` that share no window with a benchmark item, with all their columns.

    Rows are known by id and text hash: another text under the id of an overlapping document stays, NULL ids included.
    """
    digest = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    keyed = docs.select(F.struct(F.col(id_col).alias("id"), digest.alias("digest")).alias("_key"), F.col(text_col).alias("_text"))
    found = overlaps(keyed, benchmark, "_key", "_text", **options).select(F.col("_key.id").alias("_found"), F.col("_key.digest").alias("_digest")).distinct()
    return docs.join(found, docs[id_col].eqNullSafe(found["_found"]) & (digest == found["_digest"]), "left_anti")

"""Quality rules of a document: plain counts, and a linear-chain conditional random field over its lines.

Each line is content or boilerplate. A line's statistics give it a score for content, neighbouring lines
influence each other through transition scores, and the Viterbi path through the whole document marks its
lines. A document is retained if enough of its words stand in content lines.

The field is fitted by gradient ascent on the conditional log-likelihood of a bounded sample of labelled
documents: all lines of a good document count as content, those of a bad one as boilerplate unless they also
stand in a good one.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natalis.llm.shared import bounded_batches, remainder_of_id

LINE_FEATURES = (
    "constant",
    "blank",
    "log_length",
    "upper",
    "digits",
    "marks",
    "symbols",
    "exclaims",
    "seen_before",
    "repeated_next",
    "distinct_words",
    "lone_marks",
    "sentence_end",
    "few_words",
)
#: at most so many labelled documents, of at most so many lines each, are fitted
SAMPLE_DOCUMENTS, SAMPLE_LINES = 4_000, 200
MIN_CONTENT_SHARE = 0.5
MIN_WORDS, MAX_REPEATED_PERCENT, REPEAT_WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"  # counted by the rules

_UPPER, _DIGIT, _MARK, _SYMBOL, _EXCLAIM, _REST = range(6)
_SENTENCE_ENDS = tuple(c.encode() for c in ".!?:;…。")


def _kinds() -> np.ndarray:
    kind = np.full(256, _REST)
    for first, last, what in (("!", "~", _MARK), ("A", "Z", _UPPER), ("a", "z", _REST), ("0", "9", _DIGIT)):
        kind[ord(first) : ord(last) + 1] = what
    kind[[ord(c) for c in "#*$%&|<>{}[]=\\^~_"]] = _SYMBOL
    kind[ord("!")] = _EXCLAIM
    return kind


_KIND = _kinds()


def line_statistics(lines: list[bytes], words: list[list[bytes]]) -> np.ndarray:
    """One row of ``LINE_FEATURES`` per line of a document."""
    n = len(lines)
    joined = np.frombuffer(b"\n".join(lines), np.uint8)
    number = np.cumsum(joined == 10) - (joined == 10)
    kinds = np.bincount(number * 6 + _KIND[joined], minlength=6 * n).reshape(n, 6)
    size = np.fromiter(map(len, lines), np.float64, n)
    count = np.fromiter(map(len, words), np.float64, n)
    distinct = np.fromiter((len(set(w)) for w in words), np.float64, n)
    again = np.fromiter((sum(map(bytes.__eq__, w, w[1:])) for w in words), np.float64, n)
    lone = np.fromiter((sum(len(x) == 1 and not x.isalnum() for x in w) for w in words), np.float64, n)
    seen: set[bytes] = set()
    before = np.zeros(n)
    for i, line in enumerate(lines):
        if words[i]:
            before[i] = line in seen
            seen.add(line)
    x = np.empty((n, len(LINE_FEATURES)))
    x[:, 0] = 1
    x[:, 1] = count == 0
    x[:, 2] = np.log1p(size) / 5
    for at, kind in enumerate((_UPPER, _DIGIT, _MARK, _SYMBOL, _EXCLAIM), start=3):
        x[:, at] = np.sqrt(kinds[:, kind] / (size + 20))
    x[:, 8] = before
    x[:, 9] = again / (count + 4)
    x[:, 10] = np.where(count > 0, np.log1p(distinct) / np.log1p(np.maximum(count, 1)), 1)
    x[:, 11] = lone / (count + 4)
    x[:, 12] = [line.rstrip().endswith(_SENTENCE_ENDS) for line in lines]
    x[:, 13] = (count > 0) & (count < 4)
    return x


def lines_of(text: str | None) -> tuple[list[bytes], list[list[bytes]]]:
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    return lines, [line.split() for line in lines]


@dataclass(frozen=True)
class LineField:
    """Linear-chain field with the states boilerplate (0) and content (1); only differences of scores count."""

    weights: np.ndarray  # score of content per feature
    moves: np.ndarray  # (2, 2): score of going from a state to the next line's

    def content_scores(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best sequence of states; equal scores prefer content."""
        (m00, m01), (m10, m11) = self.moves.tolist()
        back = []
        s0, s1 = 0.0, 0.0
        for i, u in enumerate(self.content_scores(x).tolist()):
            if i:
                a0, a1, b0, b1 = s0 + m00, s1 + m10, s0 + m01, s1 + m11
                back.append((a1 >= a0, b1 >= b0))
                s0, s1 = max(a0, a1), max(b0, b1) + u
            else:
                s1 = u
        states = np.empty(len(x), np.int8)
        state = int(s1 >= s0)
        for i in range(len(x) - 1, -1, -1):
            states[i] = state
            if i:
                state = int(back[i - 1][state])
        return states


def fit_field(
    documents: list[np.ndarray], states: list[np.ndarray], steps: int = 120, rate: float = 0.5, ridge: float = 0.3
) -> LineField:
    """Field for documents given as line rows and the state of each line (Adam, fixed number of steps).

    Without documents all scores are zero, and every line decodes as content.
    """
    d = len(LINE_FEATURES)
    weights, moves = np.zeros(d), np.zeros((2, 2))
    if not documents:
        return LineField(weights, moves)
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    sizes = np.array([len(documents[i]) for i in order])
    # line by line: row t of ``at`` has the place of line t of each document that is long enough
    x = np.concatenate([documents[i] for i in order])
    truth = np.concatenate([states[i] for i in order]).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    at = [starts[: np.searchsorted(-sizes, -t, side="left")] + t for t in range(sizes[0])]
    later = np.ones(len(x), bool)
    later[starts] = False
    pairs = 2 * truth[np.flatnonzero(later) - 1] + truth[later]
    seen = np.concatenate((x[truth == 1].sum(axis=0), np.bincount(pairs, minlength=4)))
    first, second = np.zeros(d + 4), np.zeros(d + 4)
    for step in range(1, steps + 1):
        unary = np.stack([np.zeros(len(x)), x @ weights], axis=1)
        forward, backward = unary.copy(), np.zeros((len(x), 2))
        for here in at[1:]:
            before = forward[here - 1]
            forward[here] += np.logaddexp(before[:, :1] + moves[0], before[:, 1:] + moves[1])
        for here in at[:0:-1]:
            after = unary[here] + backward[here]
            backward[here - 1] = np.logaddexp(moves[:, 0] + after[:, :1], moves[:, 1] + after[:, 1:])
        both = forward + backward
        norm = np.logaddexp(both[:, 0], both[:, 1])
        here = np.flatnonzero(later)
        joint = forward[here - 1][:, :, None] + moves + (unary + backward)[here][:, None, :] - norm[here][:, None, None]
        expected = np.concatenate((x.T @ np.exp(both[:, 1] - norm), np.exp(joint).sum(axis=0).ravel()))
        gradient = (seen - expected - ridge * np.concatenate((weights, moves.ravel()))) / len(x)
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        move = rate * first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, moves = weights + move[:d], moves + move[d:].reshape(2, 2)
    return LineField(weights, moves)


def line_states(lines: list[np.ndarray], good: list[int]) -> list[np.ndarray]:
    """State of each line, for documents given as hashes of their lines.

    Lines of a good document are content. So are lines of a bad one that also stand in a good one; its others
    are boilerplate.
    """
    fine = np.unique(np.concatenate([x for x, g in zip(lines, good, strict=True) if g] or [np.empty(0, np.int64)]))
    return [np.ones(len(x), np.int64) if g else np.isin(x, fine).astype(np.int64) for x, g in zip(lines, good, strict=True)]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    documents: int = SAMPLE_DOCUMENTS,
    lines: int = SAMPLE_LINES,
) -> LineField:
    """Field fitted on the ``documents`` labelled rows that come first by a hash of their id.

    Of these, texts of more than ``lines`` lines are left out, so the driver holds a bounded number of lines. Rows
    whose id has crc32 remainder 0 stay unseen. An id with both labels counts as bad.
    """
    bounded_batches(docs.sparkSession)
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (remainder_of_id(id_col) != 0))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("_good"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(documents)

    @F.pandas_udf("array<double>")
    def described(texts: pd.Series) -> pd.Series:
        return pd.Series([line_statistics(*lines_of(t)).ravel() for t in texts], dtype=object)

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    rows = rows.filter(F.length("_text") - F.length(F.translate("_text", "\n", "")) < lines)
    # the chosen ids are at most ``documents`` rows, so they can go to every task
    rows = rows.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min("_good").alias("_good"), F.min("_text").alias("_text"))
    hashes = F.transform(F.split("_text", "\n"), lambda line: F.xxhash64(line))
    got = rows.orderBy("_id").limit(documents).select("_good", hashes.alias("_hashes"), described("_text").alias("_lines")).collect()
    states = line_states([np.array(r["_hashes"], np.int64) for r in got], [r["_good"] for r in got])
    return fit_field([np.array(r["_lines"]).reshape(-1, len(LINE_FEATURES)) for r in got], states)


# --- rules -----------------------------------------------------------------------------------------


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words covered by a window of words that occurs twice or more in the text, all occurrences included."""
    n = len(words)
    if n <= window:
        return 0
    line = b" ".join(words)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends)]
    windows = [line[a:b] for a, b in zip(starts, ends[window - 1 :], strict=False)]
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    twice = np.flatnonzero(np.fromiter((counts[w] > 1 for w in windows), bool, len(windows)))
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + window, -1)
    return int((np.cumsum(edges)[:n] > 0).sum())


def examine(text: str | None, field: LineField) -> tuple:
    """(words, word characters, symbols, repeated lines, repeated words, base failed, content share)."""
    lines, words = lines_of(text)
    flat = [w for line in words for w in line]
    n = len(flat)
    if not n:
        return 0, 0, sum(map((text or "").count, SYMBOLS)), 0, 0, True, 0.0
    chars = len(b"".join(flat).decode("utf-8", "surrogatepass"))
    x = line_statistics(lines, words)
    repeated = repeated_words(flat)
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n
    counts = np.fromiter(map(len, words), np.int64, len(words))
    content = float(counts[field.decode(x) == 1].sum() / n)
    return n, chars, sum(map(text.count, SYMBOLS)), int(x[:, 8].sum()), repeated, failed, content


_VERDICT = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint,"
    " base_failed boolean, content_share double, kept boolean"
)


def verdict(field: LineField, column: str | Column = "text", min_share: float = MIN_CONTENT_SHARE) -> Column:
    """All counts and the decision for one whole text, as a struct. A NULL, empty or blank text fails."""
    names = [part.split()[0] for part in _VERDICT.split(",")]

    @F.pandas_udf(_VERDICT)
    def of(texts: pd.Series) -> pd.DataFrame:
        rows = [examine(t, field) for t in texts]
        return pd.DataFrame([(*r, not r[5] and r[6] >= min_share) for r in rows], columns=names)

    return of(F.col(column).cast("string") if isinstance(column, str) else column)


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its counts and whether it is kept. An empty ``docs`` gives no rows; without
    labels only the plain rules decide."""
    field = fit(docs, labels, id_col, text_col)
    return docs.select(F.col(id_col), verdict(field, text_col).alias("_v")).select(id_col, "_v.*")


def keep_content(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", examples: DataFrame | None = None
) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns. Texts are not shuffled for it.

    The field is fitted on the labelled rows of ``examples``, by default of ``docs``. If ``docs`` has been filtered by
    quality before, few of its rows show boilerplate, and ``examples`` should be the unfiltered table.
    """
    return docs.filter(verdict(fit(docs if examples is None else examples, labels, id_col, text_col), text_col)["kept"])

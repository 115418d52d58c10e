"""Word-piece lengths by a linear longest-match automaton over a vocabulary trie.

Greedy longest-match pieces of a word are counted in one pass over its bytes. Where the trie has no way on, a
failure link leads to the node for what would be left after the pieces that are then certain, and the number of
those pieces is kept at the link. So lengths are added up without building a piece or reading a byte twice.

Words are cut at white space. A word's first piece is one that the vocabulary marks as beginning a word (with the
blank before it), further pieces are unmarked. A byte that no piece can begin makes the word one unknown piece.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.llm.shared import bounded_batches, words_of

_CACHED_WORDS = 200_000


class LengthAutomaton:
    """Trie of first pieces (below ``first``) and further pieces (below ``rest``) with failure links."""

    def __init__(self, first_pieces: Iterable[bytes], further_pieces: Iterable[bytes]):
        self.next: list[dict[int, int]] = [{}, {}]
        self.whole: list[bool] = [False, False]
        self.first, self.rest = 0, 1
        for root, pieces in ((self.first, first_pieces), (self.rest, further_pieces)):
            for piece in pieces:
                node = root
                for byte in piece:
                    if byte not in self.next[node]:
                        self.next[node][byte] = len(self.next)
                        self.next.append({})
                        self.whole.append(False)
                    node = self.next[node][byte]
                self.whole[node] = bool(piece)
        # fail[node]: where to go on after popped[node] pieces; None if the bytes so far cannot be cut
        self.fail: list[int | None] = [None] * len(self.next)
        self.popped: list[int] = [0] * len(self.next)
        queue = deque([(self.first, b) for b in self.next[self.first]] + [(self.rest, b) for b in self.next[self.rest]])
        while queue:
            parent, byte = queue.popleft()
            node = self.next[parent][byte]
            if self.whole[node]:
                self.fail[node], self.popped[node] = self.rest, 1
            else:
                at, pieces = self.fail[parent], self.popped[parent]
                while at is not None and byte not in self.next[at]:
                    at, pieces = self.fail[at], pieces + self.popped[at]
                if at is not None:
                    self.fail[node], self.popped[node] = self.next[at][byte], pieces
            queue.extend((node, b) for b in self.next[node])

    def length(self, word: bytes) -> int:
        """Number of greedy longest-match pieces; 1 for a word that cannot be cut, 0 for none."""
        if not word:
            return 0
        follow, fail, popped = self.next, self.fail, self.popped
        node, pieces = self.first, 0
        for byte in word:
            while True:
                step = follow[node].get(byte)
                if step is not None:
                    node = step
                    break
                pieces += popped[node]
                node = fail[node]
                if node is None:
                    return 1
        while node != self.rest:
            pieces += popped[node]
            node = fail[node]
            if node is None:
                return 1
        return pieces


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level_automaton(json_path: str) -> LengthAutomaton:
    """Automaton over a byte-level vocabulary file: pieces with a leading blank begin a word, the others go on.

    A blank alone is a piece too, so any word can begin; its own piece then counts.
    """
    with open(json_path, encoding="utf-8") as file:
        data = json.load(file)
    letters = byte_letters()
    special = {t["content"] for t in data.get("added_tokens", [])}
    pieces = [bytes(letters[c] for c in piece) for piece in data["model"]["vocab"] if piece not in special]
    return LengthAutomaton((p for p in pieces if p[:1] == b" "), (p for p in pieces if p[:1] != b" "))


def public_automaton() -> LengthAutomaton:
    """Automaton over the public 50k byte-level vocabulary that is installed on every machine."""
    import public_tokenizers as public

    return byte_level_automaton(public.path("byte_bpe_50k.json"))


class _Lengths(dict):
    """Lengths of words seen so far. When full it starts anew, so memory stays bounded and results equal."""

    def __init__(self, automaton: LengthAutomaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        length = self[word] = self.automaton.length(b" " + word)
        return length


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    automaton: Callable[[], LengthAutomaton] = public_automaton,
) -> DataFrame:
    """(id, n_words, n_tokens, max_word_tokens) of every whole text.

    NULL, empty and blank texts have zeros. Repeated rows are counted each; NULL ids are kept.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("n_words bigint, n_tokens bigint, max_word_tokens bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lengths = _Lengths(automaton())
        for texts in batches:
            rows = []
            for text in texts:
                words = words_of(text)
                sizes = [lengths[w] for w in words]
                rows.append((len(words), sum(sizes), max(sizes, default=0)))
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens", "max_word_tokens"])

    return docs.select(F.col(id_col), count(F.col(text_col).cast("string")).alias("_c")).select(id_col, "_c.*")

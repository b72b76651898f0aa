"""Token counts of whole texts by a unigram vocabulary, without making the tokens.

Per word, an Aho-Corasick automaton enumerates every vocabulary match, and a Viterbi pass over the match ends carries only
the best score and its number of pieces. Ties go by the tokenizer's rule: a later candidate must be strictly better, and of
the candidates that end at a place the one that starts first comes first. A character that no piece covers is an unknown
piece, scored ten below the least score; unknown pieces in a row count as one.

The vocabulary file stands outside the repository; its path is a parameter. The file's pieces come in order of merge rank
and carry ranks rather than probabilities, so scores follow Zipf's law over the rank: -ln(rank + 2.7).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_UNKNOWN_PENALTY = 10.0  # fixed value of the unigram tokenizers


@dataclass(frozen=True)
class Unigram:
    """``pieces``: (piece, score), whose pieces never hold white space. ``remembered``: words whose count a task keeps."""

    pieces: tuple[tuple[str, float], ...]
    remembered: int = 400_000


def load_unigram(path: str = VOCABULARY) -> Unigram:
    """The plain pieces of a vocabulary file; control, unknown and byte pieces stand for no text and are left out."""
    held = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(held.get_piece_size()) if not (held.is_control(i) or held.is_unknown(i) or held.is_byte(i) or held.is_unused(i))]
    # A word holds one space mark, at its start; pieces of several marks or with one inside never match.
    names = [held.id_to_piece(i) for i in plain]
    kept = [n for n in names if SPACE not in n[1:]]
    return Unigram(tuple((n, -math.log(rank + 2.7)) for rank, n in enumerate(kept)))


class WordCounter(dict):
    """Pieces of a word, worked out when first asked for and kept while there is room."""

    def __init__(self, model: Unigram) -> None:
        super().__init__()
        self.limit = model.remembered
        self.automaton = ahocorasick.Automaton()
        for piece, score in model.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if model.pieces:
            self.automaton.make_automaton()
        self.known = {piece for piece, _ in model.pieces if len(piece) == 1}
        self.unknown = min((s for _, s in model.pieces), default=0.0) - _UNKNOWN_PENALTY

    def __missing__(self, word: str) -> int:
        counted = self._count(word) if self.known.issuperset(word) else self._count_strange(word)
        if len(self) < self.limit and len(word) <= 64:
            self[word] = counted
        return counted

    def _count(self, word: str) -> int:
        """Best score and pieces at each place of a word whose characters are all pieces.

        The automaton gives matches by their end, of one end the longest, which starts first, before shorter ones.
        """
        best, pieces = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
        for end, (length, score) in self.automaton.iter(word):
            start = end + 1 - length
            total = best[start] + score
            if total > best[end + 1]:
                best[end + 1] = total
                pieces[end + 1] = pieces[start] + 1
        return pieces[-1]

    def _count_strange(self, word: str) -> int:
        """The same where some characters are no pieces: they are unknown pieces of one character."""
        n = len(word)
        ends: list[list[tuple[int, float, bool]]] = [[] for _ in range(n)]
        if len(self.automaton):
            for end, (length, score) in self.automaton.iter(word):
                ends[end].append((length, score, False))
        best, pieces, unknown = [0.0] + [-math.inf] * n, [0] * (n + 1), [False] * (n + 1)
        for at, found in enumerate(ends, 1):
            if word[at - 1] not in self.known:
                found.append((1, self.unknown, True))
            for length, score, strange in found:
                start = at - length
                total = best[start] + score
                if total > best[at]:
                    best[at], unknown[at] = total, strange
                    pieces[at] = pieces[start] + (0 if strange and unknown[start] else 1)
        return pieces[n]


def count_tokens(text: str | None, counter: WordCounter) -> int:
    """Each run of characters without white space is a word with a space mark in front; a null text has no token.

    A space mark inside a text is a character like others.
    """
    return sum(counter[SPACE + word] for word in text.split()) if text else 0


#: Of this Python process: words counted by one task serve the next.
_counters: dict[Unigram, WordCounter] = {}


def token_counts(docs: DataFrame, model: Unigram) -> DataFrame:
    """doc_id, n_chars, n_tokens for every row of ``docs`` (doc_id, text); null and blank texts have no token."""

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if model not in _counters:
            _counters[model] = WordCounter(model)
        counter = _counters[model]
        for texts in batches:
            yield pd.Series([count_tokens(text, counter) for text in texts], dtype="int64")

    n_chars = F.coalesce(F.length("text"), F.lit(0)).cast("bigint")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), n_chars.alias("n_chars"), counted("text").alias("n_tokens"))

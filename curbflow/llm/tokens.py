"""Token counts under a unigram vocabulary: Viterbi that carries only score and count.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character;
the best score of every prefix and the number of its tokens are all that is kept.
Ties follow the tokenizer: of equal scores the path whose last piece starts
earlier wins. A character without a piece of its own costs the lowest score less
ten and counts as its UTF-8 bytes. No piece spans white space, so words are
counted once and remembered.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbflow.llm.common import session

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Distinct words that a Python worker remembers the counts of.
WORDS_KEPT = 500_000

COUNTS = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])


def ranked_pieces(path: str) -> list[tuple[str, float]]:
    """The pieces of a sentencepiece model in order, scored -log(rank): frequent pieces come first."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return [(model.id_to_piece(i), -math.log(rank)) for rank, i in enumerate(ids, 1)]


class Counter(dict):
    """Tokens of a word, by word; missing words are counted."""

    def __init__(self, pieces: Iterable[tuple[str, float]]) -> None:
        import ahocorasick

        super().__init__()
        pieces = dict(pieces)
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY

    def best(self, text: str) -> tuple[float, int]:
        """(score, tokens) of the best path over ``text``, white space already marked."""
        n = len(text)
        score = [0.0] + [-math.inf] * n
        start, tokens = [0] * (n + 1), [0] * (n + 1)
        matches = self.automaton.iter(text) if len(self.automaton) else iter(())
        held = next(matches, None)
        for i, char in enumerate(text):
            end = i + 1
            while held is not None and held[0] == i:
                length, value = held[1]
                s = end - length
                new = score[s] + value
                if new > score[end] or (new == score[end] and s < start[end]):
                    score[end], start[end], tokens[end] = new, s, tokens[s] + 1
                held = next(matches, None)
            if char not in self.single and score[i] + self.unknown > score[end]:
                score[end], start[end] = score[i] + self.unknown, i
                tokens[end] = tokens[i] + len(char.encode())
        return score[n], tokens[n]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = self.best(SPACE + word.decode())[1]
        return n

    def count(self, text: str) -> tuple[int, int]:
        if len(self) > WORDS_KEPT:
            self.clear()
        words = text.encode().split()
        return len(words), sum(map(self.__getitem__, words))


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(ranked_pieces(path))


def token_counts(text: Column, path: str) -> Column:
    @F.pandas_udf(COUNTS)
    def count(texts: pd.Series) -> pd.DataFrame:
        c = counter(path)
        return pd.DataFrame([c.count(t or "") for t in texts], columns=COUNTS.names)

    return count(text)


def counted(docs: DataFrame, path: str, name: str = "tokens") -> DataFrame:
    """``docs`` with a struct ``name`` of words and tokens of each whole text.

    A null text, an empty one and one of white space alone have neither. Repeated
    rows count alike, an empty table gives no rows, other columns pass through
    (``name`` must not be among them).
    """
    session(docs.sparkSession)
    return docs.withColumn(name, token_counts(F.col("text"), path))

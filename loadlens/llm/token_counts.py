"""Operator 6: token counts by a count-only Viterbi pass over a unigram vocabulary.

The tokenizer is the unigram model over the pieces and scores of a public
vocabulary file, with spaces as U+2581, one put before the text, and byte
fallback.  An Aho-Corasick automaton finds all pieces in a stretch of text; the
dynamic program carries the best score and the number of pieces to each
position, never the pieces.  Its tie rules are those of the tokenizer: ends are
reached in order of their starts and only a better score replaces an earlier one,
and a character that no one-character piece covers costs the least score less 10
and counts its UTF-8 bytes.

Scores are whole numbers, and no piece of the vocabulary holds U+2581 after
another character, so the best path of a text is made of the best paths of its
stretches (a run of U+2581 and what follows up to the next one).  Equal
stretches are worked off once per task.

A null or empty text has no tokens.  Repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import texts as T

#: A public vocabulary file; another one may be given.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
#: Different stretches that a task remembers before it starts anew.
REMEMBERED = 200_000


@dataclass(frozen=True)
class Vocabulary:
    pieces: tuple[tuple[str, float], ...]

    @staticmethod
    def read(path: str = VOCABULARY) -> Vocabulary:
        """Pieces and scores of a sentencepiece file, in id order."""
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return Vocabulary(tuple((sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())))

    def splits(self) -> bool:
        """Whether paths never cross into a run of U+2581 and scores add without rounding."""
        return all(SPACE not in p.lstrip(SPACE) and s == int(s) for p, s in self.pieces)


class Counter(dict):
    """Stretch -> number of tokens; missing ones are worked off by the dynamic program."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.find = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            if piece:
                self.find.add_word(piece, (len(piece), score))
        self.find.make_automaton()
        self.unknown = min(s for _, s in vocabulary.pieces) - UNKNOWN_PENALTY

    def __missing__(self, text: str) -> int:
        n = self.count(text)
        if len(self) < REMEMBERED:
            self[text] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of the best path of a stretch."""
        size = len(text)
        ends: list[list] = [[] for _ in range(size + 1)]
        for last, match in self.find.iter(text):
            ends[last + 1].append(match)
        best = [0.0] * (size + 1)
        count = [0] * (size + 1)
        for end in range(1, size + 1):
            top, pieces, single = None, 0, False
            for length, score in sorted(ends[end], reverse=True):   # the longest piece starts first
                single |= length == 1
                total = best[end - length] + score
                if top is None or total > top:
                    top, pieces = total, count[end - length] + 1
            if not single:
                total = best[end - 1] + self.unknown
                if top is None or total > top:
                    top, pieces = total, count[end - 1] + len(text[end - 1].encode())
            best[end], count[end] = top, pieces
        return count[size]


STRETCH = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def stretches(text: str) -> list[str]:
    """The text with U+2581 for spaces and one before it, cut where a run of U+2581 begins."""
    marked = SPACE + text.replace(" ", SPACE)
    if SPACE * 2 not in marked:
        return [SPACE + w for w in marked.split(SPACE)[1:]]
    return STRETCH.findall(marked)


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: doc_id, n_tokens."""
    vocab = Vocabulary.read(vocabulary)
    if not vocab.splits():
        raise ValueError("the vocabulary has pieces across spaces or fractional scores; texts can't be cut at spaces")
    shared = docs.sparkSession.sparkContext.broadcast(vocab)  # a vocabulary file, not data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        look = counter.__getitem__
        for t in T.slices(batches):
            if len(counter) >= REMEMBERED:
                counter.clear()
            n = [sum(map(look, stretches(text))) if text else 0 for text in t["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([t["doc_id"].combine_chunks().cast(pa.int64()), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_tokens long")

"""Token counts of a unigram vocabulary: the best segmentation's score and length, no pieces kept.

An Aho-Corasick automaton lists every vocabulary piece in a text; a pass over the end positions carries the best
score and the number of pieces on its path. Ties follow the tokenizer: of equal scores the segmentation whose last piece starts
first stays, and neighbouring unknown characters make one piece.

No piece goes over a white-space mark, so a text's words are independent; each distinct word is solved once
per task and remembered up to a bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from loadtide.llm.words import as_bytes

MARK = "▁"
UNKNOWN = 10.0  # below the lowest score of the vocabulary
MEMORY = 200_000  # words remembered per task, then forgotten together
LONG = 64  # characters; longer words aren't remembered


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, without control, unknown and byte pieces.

    Files of merge ranks have whole-number scores of minus the rank; they serve as the scores of a unigram model.
    """
    p = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = lambda i: not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))
    return [(p.id_to_piece(i), p.get_score(i)) for i in range(p.get_piece_size()) if plain(i)]


class Counter:
    """Counts pieces of words with a vocabulary of (piece, score)."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        for text, score in pieces:
            if MARK not in text.lstrip(MARK):  # pieces over a mark inside can't occur in a word
                self.automaton.add_word(text, (len(text), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in pieces) - UNKNOWN
        self.single = {text for text, _ in pieces if len(text) == 1}
        self.seen: dict[str, tuple[float, int, int]] = {}

    def word(self, word: str) -> tuple[float, int, int]:
        """(best score, pieces, unknown pieces) of one word."""
        return self._known(word) if self.single.issuperset(word) else self._any(word)

    def _known(self, word: str) -> tuple[float, int, int]:
        """A word of known characters. The automaton lists the matches of an end by falling length, so the
        first of equal scores is the one that starts first, and every place has a path."""
        score, count = [0.0] * (len(word) + 1), [0] * (len(word) + 1)
        last = -1
        for end, (length, s) in self.automaton.iter(word):
            start = end + 1 - length
            total = score[start] + s
            if end != last:
                last = end
            elif total <= score[end + 1]:
                continue
            score[end + 1] = total
            count[end + 1] = count[start] + 1
        return score[-1], count[-1], 0

    def _any(self, word: str) -> tuple[float, int, int]:
        n = len(word)
        score, count, unknown = [0.0] + [None] * n, [0] * (n + 1), [0] * (n + 1)
        open_run = [False] * (n + 1)  # the path ends in an unknown piece
        single = [False] * n
        ends: list[list] = [[] for _ in range(n)]
        for end, (length, s) in self.automaton.iter(word):
            ends[end].append((end + 1 - length, s))
            single[end] |= length == 1
        for end in range(n):
            best = None
            matches = ends[end]
            if not single[end]:
                matches = [*matches, (end, None)]
            for start, s in sorted(matches, key=lambda m: m[0]):
                before = score[start]
                total = before + (self.unknown if s is None else s)
                if best is None or total > best:
                    best, from_, value = total, start, s
            score[end + 1] = best
            joins = value is None and open_run[from_]
            count[end + 1] = count[from_] + (not joins)
            unknown[end + 1] = unknown[from_] + (value is None and not joins)
            open_run[end + 1] = value is None
        return score[n], count[n], unknown[n]

    def text(self, text: str) -> tuple[float, int, int]:
        """Sums over the words of a text whose blanks are marks and which starts with one."""
        if len(self.seen) > MEMORY:
            self.seen.clear()
        total, pieces, unknown = 0.0, 0, 0
        for w in regex.findall(f"{MARK}*[^{MARK}]+|{MARK}+$", text):
            got = self.seen.get(w)
            if got is None:
                got = self.word(w)
                if len(w) <= LONG:
                    self.seen[w] = got
            total, pieces, unknown = total + got[0], pieces + got[1], unknown + got[2]
        return total, pieces, unknown


def marked(text: str) -> str:
    """Runs of white space as one mark, one in front, none at the end; empty if there is nothing else."""
    words = text.split()
    return MARK + MARK.join(words) if words else ""


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_unknown, score (of the best segmentation of the whole text).

    Runs of white space count as one; null, empty and blank texts have no tokens and score 0. Repeated rows
    keep their rows; other columns are ignored. ``path`` is read on the driver and sent to the tasks: its size
    is the vocabulary's.
    """
    pieces = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(pieces.value)
        for batch in batches:
            got = [counter.text(marked(t.decode())) for t in as_bytes(batch.column(1))]
            cols = np.array(got, np.float64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[:, 1].astype(np.int64)), pa.array(cols[:, 2].astype(np.int64)), pa.array(cols[:, 0].copy())],
                names=["doc_id", "n_tokens", "n_unknown", "score"],
            )

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    fields = [picked.schema["doc_id"], *(StructField(n, LongType()) for n in ("n_tokens", "n_unknown")), StructField("score", DoubleType())]
    return picked.mapInArrow(run, StructType(fields))

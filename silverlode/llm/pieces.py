"""Token counts of a unigram vocabulary, by a Viterbi pass that keeps only score and count.

Aho-Corasick lists every vocabulary piece that ends at each place of a word; dynamic
programming carries the best score and its number of pieces. Ties go as in the usual
unigram encoder: places are filled from left to right and a later candidate replaces an
earlier one only with a strictly better score, so of equal segmentations the one whose
last piece is longest wins. A character that no single-character piece covers costs
``UNKNOWN_PENALTY`` below the worst piece and, with byte fallback, counts its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from silverlode.llm.common import WordCache, kept_for, picked, texts_of

UNKNOWN_PENALTY = 10.0
BLANK = "▁"  # stands for a blank and begins every word


def read_vocabulary(data: bytes) -> tuple[list[tuple[str, float]], int]:
    """(piece, score) by id and the unknown id of a serialized piece model."""
    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())], model.unk_id()


class Counter:
    """Counts pieces of words; what a word costs is remembered."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int, byte_fallback: bool = True):
        self.auto = ahocorasick.Automaton()
        single = set()
        for i, (piece, score) in enumerate(vocabulary):
            if piece and i != unknown:
                self.auto.add_word(piece, (len(piece), score))
                single |= {piece} if len(piece) == 1 else set()
        self.auto.make_automaton()
        self.single = single
        self.unknown_score = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        tokens = {p for p, _ in vocabulary}
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in tokens for b in range(256))
        self.words = WordCache(self.count_word)

    def count_word(self, word: str) -> int:
        """Pieces of one word, its leading blank sign included."""
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.auto.iter(word):  # longest first at each end
            ends[end].append(match)
        none = float("-inf")
        best, count, unknown = [0.0] + [none] * n, [0] * (n + 1), [False] * (n + 1)
        for end in range(n):
            at = end + 1
            for length, score in ends[end]:
                total = score + best[at - length]
                if total > best[at]:
                    best[at], count[at], unknown[at] = total, count[at - length] + 1, False
            if word[end] not in self.single:
                total = self.unknown_score + best[end]
                if total > best[at]:
                    # neighbouring unknown characters are one unknown piece, or their bytes
                    size = len(word[end].encode()) if self.bytes else int(not unknown[end])
                    best[at], count[at], unknown[at] = total, count[end] + size, True
        return count[n]

    def count(self, text: str) -> int:
        if not text:
            return 0
        parts = text.replace(BLANK, " ").split(" ")
        if not parts[0]:  # the text begins with a blank: no other is put before it
            del parts[0]
        return sum(map(self.words.__getitem__, [BLANK + p for p in parts]))


def counter_of(data: bytes) -> Counter:
    """One counter per worker process."""
    kept = kept_for("pieces")
    if hash(data) not in kept:
        kept.clear()
        kept[hash(data)] = Counter(*read_vocabulary(data))
    return kept[hash(data)]


def token_counts(df: DataFrame, model: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of each whole text. NULL and empty texts have none; repeated rows stay."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([counter.count(t) for t in texts_of(b)], pa.int64())], ["doc_id", "n_tokens"])

    return picked(df, doc_id=key, text=text).mapInArrow(run, "doc_id long, n_tokens long")

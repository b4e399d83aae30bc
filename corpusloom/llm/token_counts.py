"""Token counts by count-only Viterbi over a unigram vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import claim, clean_text, remembers

_WORDS = 300_000
#: Fixed values of the unigram tokenizer: what an unknown character costs below the lowest score, and the sign for a space.
UNKNOWN_PENALTY, SPACE = 10.0, "▁"


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) of a sentencepiece model file, in id order. The file is bounded (tens of thousands)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.vocab_size())]


class Counter:
    """Best score and number of pieces of words. An Aho-Corasick automaton finds all vocabulary pieces in a
    word; dynamic programming over their ends keeps the best score and the pieces on its path.

    The tokenizer's rules on ties: of equal scores at an end, the piece that starts first stays. An unknown
    piece (one character) is offered where no vocabulary piece of one character starts. Unknown characters in a
    row are one unknown piece; with byte fallback they are spelled in bytes, one piece each, if the vocabulary
    has all 256.
    """

    def __init__(self, vocabulary: list[tuple[str, float]], byte_fallback: bool = True):
        self.automaton = ahocorasick.Automaton()
        lowest = min((s for _, s in vocabulary), default=0.0)
        for piece, score in vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        names = {p for p, _ in vocabulary}
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))
        self.unknown = lowest - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, float]] = {}

    def best(self, word: str) -> tuple[int, float]:
        """(pieces, score) of a word."""
        n = len(word)
        # at each end: score, pieces, whether the path ends in an unknown piece
        total, pieces, open_ = [0.0], [0], [False]
        top, of, single, end = None, 0, False, 1

        def close(upto: int) -> None:
            """Settle the ends before `upto`; an unknown character is tried last, as it starts last."""
            nonlocal top, of, single, end
            while end < upto:
                unknown = False
                if not single:
                    value = self.unknown + total[end - 1]
                    if top is None or value > top:
                        top, of, unknown = value, end - 1, True
                total.append(top)
                open_.append(unknown)
                if not unknown:
                    pieces.append(pieces[of] + 1)
                elif self.bytes:
                    pieces.append(pieces[of] + len(word[of:end].encode()))
                else:
                    pieces.append(pieces[of] + (not open_[of]))
                top, single, end = None, False, end + 1

        # matches come by rising end, and of one end the longest first, so by rising start
        for last, (length, score) in self.automaton.iter(word):
            if last >= end:
                close(last + 1)
            value = score + total[last + 1 - length]
            if top is None or value > top:
                top, of = value, last + 1 - length
            if length == 1:
                single = True
        close(n + 1)
        return pieces[n], total[n]

    def word(self, word: str) -> tuple[int, float]:
        got = self.known.get(word)
        if got is None:
            got = self.best(SPACE + word)
            if len(self.known) < _WORDS and len(word) < 60:
                self.known[word] = got
        return got

    def text(self, text: str) -> tuple[int, float]:
        """(pieces, score) of a text: each space starts a word, and the text gets one in front."""
        if not text:
            return 0, 0.0
        if text[0] in (" ", SPACE):
            text = text[1:]
        found = list(map(self.word, text.replace(SPACE, " ").split(" ")))
        return sum(x[0] for x in found), sum(x[1] for x in found)


_counters: list[tuple[object, Counter]] = []
remembers("token_counts", _counters.clear)


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], byte_fallback: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, score of each row of `docs`: pieces and log-score of the best segmentation of the whole
    text. Null text: null counts; empty text: 0. Repeated rows are counted each. Texts are read whole, word by word, so a
    very long one needs memory for its longest word only. Pieces that spell special or byte tokens match as plain text, as in the tokenizer
    without added tokens. Invalid bytes are read as U+FFFD. An empty table gives an empty result. Other columns are
    ignored."""
    handed = docs.sparkSession.sparkContext.broadcast((vocabulary, byte_fallback))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("token_counts")
        value = handed.value
        if not _counters or _counters[0][0] is not value:
            _counters[:] = [(value, Counter(*value))]
        counter = _counters[0][1]
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                found = [None if t is None else counter.text(t) for t in (x.as_py() for x in batch.column("text"))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([None if x is None else x[0] for x in found], pa.int64()), pa.array([None if x is None else x[1] for x in found], pa.float64())], names=["doc_id", "n_tokens", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), clean_text(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, score double")

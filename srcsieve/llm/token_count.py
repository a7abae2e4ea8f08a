"""Token counts of a unigram tokenizer by a count-only Viterbi pass.

An Aho-Corasick automaton lists the vocabulary pieces that end at each character. Dynamic
programming keeps, for each of the last few places, the best score, the number of tokens on that
path and nothing else: no path is ever built. Ties go the way of the tokenizer: places are
filled in order of the piece's start and only a better score replaces one, so the longest piece
wins a tie. Words repeat, so a worker keeps the counts of words it has met.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from srcsieve.llm.common import texts

SPACE_MARK = "▁"
UNKNOWN = "<unk>"
#: The score of a character outside the vocabulary lies this much below the lowest piece.
UNKNOWN_PENALTY = 10.0
MAX_WORDS = 500_000
MAX_CACHED_LENGTH = 64


def vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece file, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class TokenCounter:
    """Counts as ``tokenizers`` gives for a unigram model with byte fallback over words that start with a mark."""

    def __init__(self, pieces: list[tuple[str, float]], max_words: int = MAX_WORDS) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(pieces).items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score, piece == UNKNOWN))
        self.automaton.make_automaton()
        self.reach = max(len(piece) for piece, _ in pieces) + 1
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.words: dict[str, int] = {}
        self.max_words = max_words

    def count_word(self, word: str) -> int:
        """Tokens on the best path over ``word``.

        Characters outside the vocabulary count their bytes. Those next to each other are one run, and
        the literal unknown piece joins it; alone it is one token. So a state is ``(score,
        tokens before the run, bytes of the run, pieces of the run)``.
        """
        reach = self.reach
        states: list[tuple | None] = [None] * reach  # a ring: no piece looks back further
        states[0] = (0.0, 0, 0, 0)
        ends: dict[int, list] = {}
        matches = self.automaton.iter(word)
        waiting = next(matches, None)
        for place, char in enumerate(word):
            best, single = None, False
            while waiting is not None and waiting[0] == place:
                length, score, unknown = waiting[1]
                before = states[(place + 1 - length) % reach]
                total = before[0] + score
                single |= length == 1
                if best is None or total > best[0]:
                    if unknown:
                        best = (total, before[1], before[2] + length, 1 if before[3] == 0 else 2)
                    else:
                        best = (total, before[1] + self._run(before) + 1, 0, 0)
                waiting = next(matches, None)
            if not single:
                before = states[place % reach]
                total = before[0] + self.unknown
                if best is None or total > best[0]:
                    best = (total, before[1], before[2] + len(char.encode("utf-8", "surrogatepass")), 2)
            states[(place + 1) % reach] = best
        last = states[len(word) % reach]
        return last[1] + self._run(last)

    @staticmethod
    def _run(state: tuple) -> int:
        return 1 if state[3] == 1 else state[2]

    def count(self, text: str) -> int:
        if not text:
            return 0
        first, *rest = text.replace(" ", SPACE_MARK).split(SPACE_MARK)
        parts = ([first] if first else []) + rest  # a mark is put before a text that has none
        missing = [part for part in set(parts) if part not in self.words]
        if len(self.words) + len(missing) > self.max_words:
            self.words.clear()
            missing = list(set(parts))
        long: dict[str, int] = {}
        for part in missing:
            (self.words if len(part) <= MAX_CACHED_LENGTH else long)[part] = self.count_word(SPACE_MARK + part)
        if long:
            return sum(long[part] if part in long else self.words[part] for part in parts)
        return sum(map(self.words.__getitem__, parts))


_counters: dict[str, TokenCounter] = {}


def counter(model_path: str) -> TokenCounter:
    """One counter per worker, kept between tasks."""
    if model_path not in _counters:
        _counters[model_path] = TokenCounter(vocabulary(model_path))
    return _counters[model_path]


def count_tokens(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens, n_chars)`` of every row, with the pieces and scores of ``model_path`` as unigrams.

    Spaces are marks, and a mark stands before the text. Null and empty texts have no token; a
    long text takes memory for its words but never for its paths. Null ids and repeated rows each
    come back, other columns are dropped.
    """
    source = texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model_path).count
        for batch in batches:
            whole = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([count(t) for t in whole], pa.int64()), pa.array(map(len, whole), pa.int64())],
                names=[batch.schema.field(0).name, "n_tokens", "n_chars"],
            )

    return source.mapInArrow(run, T.StructType([source.schema[id_col], *T.StructType.fromDDL("n_tokens long, n_chars long")]))

"""Token ids of whole texts by a byte-level BPE file of the ``tokenizers`` library, a batch at a time.

The file's pattern cuts a text into words before its BPE model sees them. For Latin and Cyrillic texts
the same cuts are made on the bytes of a whole batch, each distinct word is looked up in a table, and only
words never met go to the file's BPE model. All other texts go through the whole tokenizer.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept at most, and bytes of one: a worker keeps its table between tasks, beside all else that it holds.
MAX_WORDS, MAX_WORD_BYTES = 1 << 17, 64
#: How the byte-level alphabet writes a space.
SPACE_TOKEN = "Ġ"
#: Text bytes cut at a time.
BLOCK_BYTES = 16 << 20
#: Classes of characters in the pattern; ``UNSAFE`` ones send their text through the whole tokenizer.
LETTER, NUMBER, MARK, SPACE, BREAK, UNSAFE = range(6)
#: The contractions of the pattern.
CONTRACTIONS = (b"'s", b"'t", b"'re", b"'ve", b"'m", b"'ll", b"'d")


def _character_classes(stop: int = 0x480) -> np.ndarray:
    """Class of each code point below ``stop``, which has two bytes at most. White space beyond ASCII, controls
    and characters that some version of Unicode lacks are unsafe."""
    classes = np.full(0x800, UNSAFE, np.uint8)
    for code in range(0x20, stop):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LN":
            classes[code] = LETTER if kind == "L" else NUMBER
        elif kind in "PSM":
            classes[code] = MARK
    classes[[ord(c) for c in "\t\n\r"]] = BREAK
    classes[ord(" ")] = SPACE
    return classes


_CLASSES = _character_classes()


def _classes(data: np.ndarray) -> np.ndarray:
    """Class of each byte of UTF-8; all bytes of a character have its class."""
    classes = np.where(data < 0x80, _CLASSES[data & 0x7F], np.uint8(UNSAFE))
    lead = np.flatnonzero((data >= 0xC2) & (data < 0xE0))
    two = _CLASSES[(data[lead].astype(np.int64) & 0x1F) << 6 | data[lead + 1] & 0x3F]
    classes[lead], classes[lead + 1] = two, two
    lead = np.flatnonzero(data == 0xE2)  # dashes, quotes, ellipses: U+2010 to U+2027
    lead = lead[(data[lead + 1] == 0x80) & (data[lead + 2] >= 0x90) & (data[lead + 2] <= 0xA7)]
    for byte in range(3):
        classes[lead + byte] = MARK
    return classes


def word_starts(data: np.ndarray, classes: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the pattern starts a word, ascending, in texts that start at ``texts``.

    A word is a run of one class with one space before it; of a longer run of white space the last stands alone or
    goes with what follows; a contraction that starts a word ends it.
    """
    n = len(data)
    first = np.zeros(n + 1, dtype=bool)
    first[texts] = True
    blank = classes >= SPACE
    before = np.empty_like(classes)
    before[0], before[1:] = BREAK, classes[:-1]
    ends_run = np.zeros(n, dtype=bool)
    ends_run[:-1] = ~blank[1:] & ~first[1:n]
    starts = np.where(blank, (before < SPACE) | ends_run, (before != classes) & (before != SPACE))
    starts |= first[:n]
    quotes = np.flatnonzero((data == ord("'")) & starts)
    starts = np.append(starts, False)
    for contraction in CONTRACTIONS:
        size = len(contraction)
        at = quotes[quotes + size <= n]
        for offset in range(1, size):
            at = at[(data[at + offset] == contraction[offset]) & ~first[at + offset]]
        starts[at + 1] = False
        starts[at + size] = True
    return np.flatnonzero(starts[:n])


def byte_alphabet() -> dict[int, str]:
    """The character that byte-level BPE writes for each byte: itself if it shows, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


def _bytes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ``texts`` and where each starts and the last ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _values(strings: pa.LargeStringArray) -> list[bytes]:
    data, offsets = _bytes(strings)
    whole, ends = data.tobytes(), offsets.tolist()
    return [whole[a:b] for a, b in zip(ends, ends[1:])]


class WordIds:
    """Ids of the texts of an Arrow array. Of the ``max_words`` kept, those not met for longest go, half of the table at once."""

    def __init__(self, path: str, max_words: int = MAX_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = self.tokenizer.model.tokenize
        self.alphabet = byte_alphabet()
        self.as_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.max_words = max_words
        self.words: dict[bytes, bytes] = {}
        self.earlier: dict[bytes, bytes] = {}

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters show as they are
            written = word.decode()
        elif word[:1] == b" " and word[1:].isalpha():
            written = SPACE_TOKEN + word[1:].decode()
        else:
            written = word.decode("latin-1").translate(self.alphabet)
        as_bytes = self.as_bytes
        return b"".join([as_bytes[token.id] for token in self.pieces(written)])

    def _words(self, words: list[bytes]) -> list[bytes]:
        known, half = self.words, self.max_words // 2
        found = list(map(known.get, words))
        for at, (word, ids) in enumerate(zip(words, found)):
            if ids is None:
                ids = self.earlier.get(word)
                found[at] = ids = self._word(word) if ids is None else ids
                if len(word) <= MAX_WORD_BYTES:
                    if len(known) >= half:
                        self.words, self.earlier = {}, known
                        known = self.words
                    known[word] = ids
        return found

    def _cut(self, data: np.ndarray, classes: np.ndarray, texts: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts that lie between ``texts`` in ``data``."""
        if len(data) == 0:
            return [np.empty(0, "<u4") for _ in texts[1:]]
        starts = word_starts(data, classes, texts[:-1][texts[:-1] < len(data)])
        words = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)
        )
        coded = words.dictionary_encode()
        ids = self._words(_values(coded.dictionary))
        pool, codes = np.frombuffer(b"".join(ids), "<u4"), coded.indices.to_numpy()
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        own, n = np.cumsum(lengths) - lengths, lengths[codes]
        ends = np.append(0, np.cumsum(n))
        out = pool[np.repeat(own[codes] - ends[:-1], n) + np.arange(ends[-1])]
        return np.split(out, ends[np.searchsorted(starts, texts[1:-1])])

    def _whole(self, texts: pa.Array) -> list[np.ndarray]:
        found = [self.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0].ids for t in texts.to_pylist()]
        return [np.array(ids, dtype="<u4") for ids in found]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """One array of unsigned 32-bit ids per text, in order. Nulls count as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        found: list[np.ndarray] = []
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            to = max(int(np.searchsorted(ends, before + BLOCK_BYTES, "right")), at + 1)
            found += self._block(texts.slice(at, to - at))
            at = to
        return found

    def _block(self, texts: pa.LargeStringArray) -> list[np.ndarray]:
        data, offsets = _bytes(texts)
        other = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False).copy()  # a special token, perhaps
        classes = _classes(data)
        other[np.searchsorted(offsets, np.flatnonzero(classes == UNSAFE), "right") - 1] = True
        if not other.any():
            return self._cut(data, classes, offsets)
        data, offsets = _bytes(texts.filter(pa.array(~other)))
        cut, whole = iter(self._cut(data, _classes(data), offsets)), iter(self._whole(texts.filter(pa.array(other))))
        return [next(whole if apart else cut) for apart in other]


_encoders: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """One encoder per worker, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]

"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

The walk of Chakraborty, Goldenberg and Koucky (STOC 2016) reads a string with a pointer that, at
every step, stays or moves by one as a random bit of (step, character) says. Two strings at a small
edit distance fall back into step after each edit, so their walks, compared step by step,
have a small Hamming distance. Walks start at every word of a document, in step with each other, and
embed the item-sized windows that start there.

Each of several samples of steps gives a hash of the characters that a walk reads at those steps. An
item is hashed from every word at which a whole walk is left. A hash that an item and a document share
says where the item would begin; two such hits that agree on the place, within the edits allowed,
are a candidate, and so is one where an item has too few words for two. The candidate is settled by
the exact edit distance, in characters, of the item to the best part of its surroundings.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from math import log

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from srcsieve.llm.common import LOWER, texts, word_blocks
from srcsieve.operators.batches import slices
from srcsieve.operators.joins import drop_ids

SIMILARITY = 0.8
RECALL = 0.9
#: Steps of a walk, how many of them a sample takes, and samples per walk and walks at most.
STEPS = 30
SAMPLED_STEPS = 11
SAMPLES_PER_WALK = 3
MOST_WALKS = 8
#: Two hits agree within this part of the edits allowed.
SHIFT_SHARE = 4
#: Edited copies of a length class on which its number of walks is set.
TRIALS = 400
#: Characters walked together, so that pointers and characters stay in cache.
CHARS_PER_WALK = 1 << 19
MOST_TABLE_BITS = 22
#: Characters of a segment that is looked up at least.
SEGMENT = 40
GRAM_BITS = 16
#: Lengths of the n-grams that a candidate has to share with its item before it is settled.
SHARED_GRAMS = (4, 3)
#: Candidates settled side by side at most and at least, and how many lengths of an item one may span.
PAIRS_AT_ONCE = 1024
FEWEST_PAIRS = 128
WIDEST = 2
#: Items sent to the executors at once, some 12 KB each; a larger benchmark goes in blocks.
ITEMS_PER_PASS = 5_000
_PUNCTUATION = bytes(b for b in range(128) if not (48 <= b < 58 or 97 <= b < 123 or b == 32 or 9 <= b < 14))
_GOLDEN = np.uint32(0x9E3779B1)


def words_of(text: str) -> list[bytes]:
    """Words of ``text``: A-Z lower-cased, ASCII punctuation and control characters dropped."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).translate(None, _PUNCTUATION).split()


def plain(text: str) -> str:
    """The words of ``text`` with one blank between them."""
    return b" ".join(words_of(text)).decode("utf-8", "replace")


def joined_codes(pieces: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """Several texts of words as one, each ended by a line break; its characters, with 0 for the break, and where words begin."""
    text = "\n".join([*pieces, ""])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
    codes[codes == 10] = 0
    begins = np.ones(len(codes), dtype=bool)
    begins[1:] = (codes[:-1] == 32) | (codes[:-1] == 0)
    begins &= codes != 0
    return text, codes, np.flatnonzero(begins).astype(np.int32)


@dataclass(frozen=True)
class Plan:
    """One walk, by the seed of its random bits, and the samples of its steps."""

    seed: int
    samples: tuple[tuple[int, ...], ...]


def walk_plan(seed: int) -> Plan:
    rng = np.random.default_rng(seed)
    return Plan(seed, tuple(
        tuple(sorted(rng.choice(STEPS, SAMPLED_STEPS, replace=False).tolist())) for _ in range(SAMPLES_PER_WALK)
    ))


def multipliers(steps: int, seed: int) -> np.ndarray:
    """Random odd numbers, one per step; the top bit of its product with a character moves the pointer."""
    return np.random.default_rng(seed).integers(0, 1 << 31, steps, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def walk_hashes(plan: Plan, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 32-bit hash for each sample and each of ``starts``, and whether the walk met the end of its text.

    All walks take their steps together. Character 0 ends a text: it never moves a pointer.
    """
    rows = np.zeros((len(plan.samples), len(starts)), dtype=np.uint32)
    by_step: dict[int, list[np.ndarray]] = {}
    for row, sample in zip(rows, plan.samples):
        for step in sample:
            by_step.setdefault(step, []).append(row)
    last = max(by_step)
    at, here, moved = starts.copy(), np.empty(len(starts), np.uint32), np.empty(len(starts), np.uint32)
    for step, multiplier in enumerate(multipliers(last + 1, plan.seed)):
        np.take(codes, at, out=here, mode="clip")
        for row in by_step.get(step, ()):
            row += here
            row *= _GOLDEN
            row ^= row >> np.uint32(15)
        if step < last:
            np.multiply(here, multiplier, out=moved)
            moved >>= np.uint32(31)
            at += moved.view(np.int32)
    rows *= _GOLDEN
    return rows, here == 0


def edit_distance(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of ``pattern`` to any part of ``text``, and where the first such part ends.

    Myers' bit-vector algorithm; the bits of one Python integer are a whole column.
    """
    m = len(pattern)
    if not m:
        return 0, 0
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(pattern):
        where[c] = where.get(c, 0) | (1 << i)
    up, down, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = where.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = down | ~(xh | up) & full, up & xh
        score += 1 if ph & top else -1 if mh & top else 0
        ph, mh = (ph << 1) & full, (mh << 1) & full
        up, down = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, j
    return best, end


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def edit_distances(pairs: list[tuple[str, str]]) -> list[int]:
    """The least edit distance of each pattern to any part of its text, for ``(pattern, text)`` pairs.

    Pairs with patterns of about one length are settled side by side, a few of a kind one by one.
    """
    found, by_blocks = [0] * len(pairs), {}
    for i in sorted(range(len(pairs)), key=lambda i: len(pairs[i][1])):
        by_blocks.setdefault(-(-len(pairs[i][0]) // 64), []).append(i)
    for blocks, members in by_blocks.items():
        for at in range(0, len(members), PAIRS_AT_ONCE):
            part = members[at : at + PAIRS_AT_ONCE]
            if blocks and len(part) >= FEWEST_PAIRS:
                least = _side_by_side([pairs[i] for i in part], blocks).tolist()
            else:
                least = [edit_distance(*pairs[i])[0] for i in part]
            for i, distance in zip(part, least):
                found[i] = distance
    return found


def _side_by_side(pairs: list[tuple[str, str]], blocks: int) -> np.ndarray:
    """``edit_distance`` of pairs whose patterns take ``blocks`` numbers of 64 bits each.

    Arrays take the place of one long integer; a block hands the step of its last row to the next.
    Characters past the end of a shorter text match nothing and so never lower a distance.
    """
    distinct = {pattern: i for i, pattern in enumerate(dict.fromkeys(pattern for pattern, _ in pairs))}
    rows = [_codes(pattern) for pattern in distinct]
    alphabet = np.unique(np.concatenate(rows))
    none, one = len(alphabet), np.uint64(1)
    match = np.zeros((blocks, len(rows), none + 1), dtype=np.uint64)
    for i, row in enumerate(rows):
        place = np.arange(len(row))
        np.bitwise_or.at(match, (place // 64, i, np.searchsorted(alphabet, row)), one << (place % 64).astype(np.uint64))
    match = match.reshape(blocks, -1)

    keys = np.full((len(pairs), max(max(len(text) for _, text in pairs), 1)), none, dtype=np.int64)
    for i, (_, text) in enumerate(pairs):
        codes = _codes(text)
        at = np.minimum(np.searchsorted(alphabet, codes), none - 1)
        keys[i, : len(codes)] = np.where(alphabet[at] == codes, at, none)
    keys += np.array([[distinct[pattern] * (none + 1)] for pattern, _ in pairs])

    size = np.array([len(pattern) for pattern, _ in pairs])
    tops = [np.uint64(63)] * (blocks - 1) + [((size - 1) % 64).astype(np.uint64)]
    ups = np.full((blocks, len(pairs)), ~np.uint64(0))
    downs = np.zeros_like(ups)
    eq, xv, xh, ph, mh = (np.empty(len(pairs), dtype=np.uint64) for _ in range(5))
    steps = np.zeros((blocks + 1, 2, len(pairs)), dtype=np.uint64)  # per block, whether its row above rises or falls
    score, best = size.copy(), size.copy()
    for key in np.ascontiguousarray(keys.T):
        for b in range(blocks):
            (rise, fall), (next_rise, next_fall), up, down = steps[b], steps[b + 1], ups[b], downs[b]
            np.take(match[b], key, out=eq, mode="clip")
            np.bitwise_or(eq, down, out=xv)
            eq |= fall
            np.bitwise_and(eq, up, out=xh)
            xh += up
            xh ^= up
            xh |= eq
            np.bitwise_or(xh, up, out=ph)
            np.invert(ph, out=ph)
            ph |= down
            np.bitwise_and(up, xh, out=mh)
            np.right_shift(ph, tops[b], out=next_rise)
            next_rise &= one
            np.right_shift(mh, tops[b], out=next_fall)
            next_fall &= one
            ph <<= one
            ph |= rise
            mh <<= one
            mh |= fall
            np.bitwise_and(ph, xv, out=down)
            xv |= ph
            np.invert(xv, out=up)
            up |= mh
        score += next_rise.view(np.int64)
        score -= next_fall.view(np.int64)
        np.minimum(best, score, out=best)
    return best


def _edited(text: str, edits: int, rng: np.random.Generator) -> str:
    """A copy with ``edits`` characters replaced, dropped or put in at random."""
    changed, letters = list(text), sorted(set(text) - {" "}) or ["a"]
    for _ in range(edits):
        at, kind = int(rng.integers(len(changed))), int(rng.integers(3))
        letter = letters[int(rng.integers(len(letters)))]
        if kind == 0:
            changed[at] = letter
        elif kind == 1 and len(changed) > 1:
            del changed[at]
        else:
            changed.insert(at, letter)
    return "".join(changed)


@dataclass
class Hits:
    """Words of texts (``at``, a character) that share a hash with an item at its character ``offset``."""

    at: np.ndarray
    item: np.ndarray
    offset: np.ndarray

    @classmethod
    def join(cls, parts: list[Hits]) -> Hits:
        return cls(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("at", "item", "offset")))

    def agreeing(self, slack: np.ndarray, needed: np.ndarray) -> list[tuple[int, int, int]]:
        """``(item, first, last)`` of the places where an item may begin, as ``needed`` hits say.

        Two distinct hits agree if they put the item's beginning within ``slack`` of each other.
        Places that lie that close are one, up to a bound; each covers its hits.
        """
        begin = self.at - self.offset
        order = np.lexsort((self.at, begin, self.item))
        at, item, begin = self.at[order], self.item[order], begin[order]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (at[1:] != at[:-1]) | (item[1:] != item[:-1]) | (begin[1:] != begin[:-1])
        item, begin = item[fresh], begin[fresh]
        linked = np.zeros(len(item) + 1, dtype=bool)
        linked[1:-1] = (item[1:] == item[:-1]) & (begin[1:] - begin[:-1] <= slack[item[1:]])
        use = np.flatnonzero(linked[1:] | linked[:-1] | (needed[item] == 1))
        found: list[list[int]] = []
        for i, place, goes_on in zip(item[use].tolist(), begin[use].tolist(), linked[use].tolist()):
            if goes_on and found[-1][0] == i and place - found[-1][1] <= WIDEST * slack[i] + 64:
                found[-1][2] = place
            else:
                found.append([i, place, place])
        return [tuple(f) for f in found]


@dataclass
class Table:
    """The hashes of one sample in order, whose they are, and a bit table that rules out most words."""

    keys: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    maybe: np.ndarray
    shift: np.uint32

    @classmethod
    def build(cls, keys: np.ndarray, item: np.ndarray, offset: np.ndarray) -> Table:
        bits = min(max(int(len(keys)).bit_length() + 4, 10), MOST_TABLE_BITS)
        order, shift = np.argsort(keys, kind="stable"), np.uint32(32 - bits)
        maybe = np.zeros(1 << bits, dtype=bool)
        maybe[keys >> shift] = True
        return cls(keys[order], item[order], offset[order], maybe, shift)

    def hits(self, row: np.ndarray, starts: np.ndarray) -> Hits:
        places = np.flatnonzero(self.maybe[row >> self.shift])
        low = np.searchsorted(self.keys, row[places], "left")
        times = np.searchsorted(self.keys, row[places], "right") - low
        key = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
        return Hits(np.repeat(starts[places], times).astype(np.int64), self.item[key], self.offset[key])


def item_tables(plan: Plan, texts: list[str], members: list[int]) -> list[Table]:
    """A table for each sample of ``plan`` over the items ``members`` of ``texts``."""
    _, codes, starts = joined_codes([texts[i] for i in members])
    ends = np.flatnonzero(codes == 0)
    of = np.searchsorted(ends, starts)
    offset = starts - np.concatenate([[0], ends + 1])[of]
    rows, ended = walk_hashes(plan, codes, starts)
    item = np.array(members, dtype=np.int64)[of]
    return [Table.build(row[~ended], item[~ended], offset[~ended].astype(np.int64)) for row in rows]


def shift_slack(limits: list[int]) -> np.ndarray:
    """By how much two hits may differ on where an item begins: edits put in and dropped mostly cancel out."""
    return np.maximum(np.array(limits, dtype=np.int64) // SHIFT_SHARE, 4)


def make_plans(texts: list[str], limits: list[int], recall: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """How many walks each item needs, 0 if it is to be looked up by its characters, and how many hits make a candidate.

    Items of about one length try copies with as many random edits as are allowed. Two hits must
    find ``recall`` of the copies, one where two do not; if neither does, the items are looked up.
    """
    by_class: dict[int, list[int]] = {}
    for i, text in enumerate(texts):
        by_class.setdefault(int(log(len(text), 1.2)), []).append(i)
    walks, needed = np.zeros(len(texts), dtype=np.int64), np.full(len(texts), 2)
    rng, slack = np.random.default_rng(seed), shift_slack(limits)
    for members in by_class.values():
        of = [members[i % len(members)] for i in range(max(TRIALS, len(members)))]
        copies = [_edited(texts[i], limits[i], rng) for i in of]
        _, codes, starts = joined_codes(copies)
        ends, parts, enough = np.flatnonzero(codes == 0), [], {}
        for number in range(MOST_WALKS):
            plan = walk_plan(seed + number)
            rows, _ = walk_hashes(plan, codes, starts)
            own = [table.hits(row, starts) for table, row in zip(item_tables(plan, texts, members), rows)]
            for hits in own:  # only those of the copy's own item count
                same = np.array(of)[np.searchsorted(ends, hits.at)] == hits.item
                parts.append(Hits(hits.at[same], hits.item[same], hits.offset[same]))
            for hits_needed in (1, 2):
                if hits_needed not in enough:
                    places = Hits.join(parts).agreeing(slack, np.full(len(texts), hits_needed))
                    met = {int(np.searchsorted(ends, max(first, 0))) for _, first, _ in places}
                    met |= {int(np.searchsorted(ends, max(last, 0))) for _, _, last in places}
                    if len(met) >= recall * len(of):
                        enough[hits_needed] = number + 1
            if 2 in enough:
                break
        hits_needed = 2 if 2 in enough else 1
        walks[members], needed[members] = enough.get(hits_needed, 0), hits_needed
    return walks, needed


@dataclass
class Segment:
    """``size`` characters of an item from ``offset`` on; a place with at most ``errors`` edits shares ``least`` n-grams or more."""

    item: int
    offset: int
    size: int
    errors: int
    gram: int
    least: int


def segments(item: int, n_chars: int, limit: int) -> list[Segment]:
    """Segments of which each place of the item within ``limit`` edits holds one within its ``errors``."""
    parts, found = max(n_chars // SEGMENT, 1), []
    errors = limit // parts
    for i in range(parts):
        low, high = n_chars * i // parts, n_chars * (i + 1) // parts
        shared = {gram: high - low + 1 - gram * (errors + 1) for gram in (4, 3, 2, 1)}
        gram = next(g for g, enough in ((4, 8), (3, 3), (2, 1), (1, 1)) if shared[g] >= enough)
        found.append(Segment(item, low, high - low, errors, gram, shared[gram]))
    return found


def gram_keys(codes: np.ndarray, gram: int) -> np.ndarray:
    """A key for the n-gram at each place."""
    size = max(len(codes) - gram + 1, 0)
    keys = np.zeros(size, dtype=np.uint32)
    for i in range(gram):
        keys *= np.uint32(0x01000193)
        keys += codes[i : i + size]
    keys *= np.uint32(0x9E3779B1)
    keys >>= np.uint32(32 - GRAM_BITS)
    return keys


def _shared(keys: np.ndarray, own: np.ndarray, counts: np.ndarray, held: np.ndarray) -> int:
    """How many of an item's n-grams are among ``keys``, each as often as both have it; ``held`` is all zero."""
    held[own] = counts
    there, times = np.unique(keys[held[keys] > 0], return_counts=True)
    shared = int(np.minimum(held[there], times).sum())
    held[own] = 0
    return shared


@dataclass
class Lookup:
    """Items found by their characters, without a miss: by the n-grams that so few edits must leave."""

    parts: list[tuple[Segment, np.ndarray]]

    @classmethod
    def build(cls, items: list[tuple[int, str, int]]) -> Lookup:
        own = [(s, text) for item, text, limit in items for s in segments(item, len(text), limit)]
        return cls([(s, gram_keys(_codes(text[s.offset : s.offset + s.size]), s.gram)) for s, text in own])

    def places(self, codes: np.ndarray) -> Iterator[tuple[Segment, int, int]]:
        """Each segment with the first and last character (exclusive) of where it may stand."""
        keys = {gram: gram_keys(codes, gram) for gram in {segment.gram for segment, _ in self.parts}}
        held = np.zeros(1 << GRAM_BITS, dtype=bool)
        for segment, own in self.parts:
            wide = segment.size + segment.errors
            held[own] = True
            total = np.cumsum(held[keys[segment.gram]], dtype=np.int32)
            held[own] = False
            if not len(total):
                continue
            # Windows end at every n-gram; one that the text begins or ends in is cut off there.
            back = wide - segment.gram + 1
            total[back:] -= total[:-back].copy()
            enough = np.concatenate([[False], total >= segment.least, [False]])
            turns = np.flatnonzero(enough[1:] != enough[:-1])
            for first, end in zip(turns[::2].tolist(), turns[1::2].tolist()):
                yield segment, first + segment.gram - wide, end - 1 + segment.gram


@dataclass
class Index:
    """Items with their edits allowed, the tables of each walk, and the items that are looked up instead."""

    ids: list
    texts: list[str]
    limits: list[int]
    needed: np.ndarray
    grams: list[list[tuple[np.ndarray, np.ndarray]]]
    plans: list[tuple[Plan, list[Table]]]
    lookup: Lookup

    @classmethod
    def build(cls, items: list[tuple], recall: float, seed: int, similarity: float = SIMILARITY) -> Index:
        own = [(item, words) for item, words in ((item, plain(text)) for item, text in items) if words]
        texts = [words for _, words in own]
        limits = [int((1 - similarity) * len(text) + 1e-9) for text in texts]
        walks, needed = make_plans(texts, limits, recall, seed)
        plans = []
        for number in range(int(walks.max(initial=0))):
            plan = walk_plan(seed + number)
            plans.append((plan, item_tables(plan, texts, np.flatnonzero(walks > number).tolist())))
        looked_up = [(i, texts[i], limits[i]) for i in np.flatnonzero(walks == 0).tolist()]
        grams = [[np.unique(gram_keys(_codes(text), g), return_counts=True) for g in SHARED_GRAMS] for text in texts]
        return cls([item for item, _ in own], texts, limits, needed, grams, plans, Lookup.build(looked_up))

    def candidates(self, codes: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int]]:
        """``(item, first, last)``: characters at which each item may begin."""
        parts = []
        for plan, tables in self.plans:
            rows, _ = walk_hashes(plan, codes, starts)
            parts += [table.hits(row, starts) for table, row in zip(tables, rows)]
        return Hits.join(parts).agreeing(shift_slack(self.limits), self.needed) if parts else []

    def places(self, text: str, codes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(item, low, high)``: parts of ``text`` that hold all of any place of an item.

        Of the places that hashes name, those with too few of the item's n-grams for so few edits go.
        """
        keys = {gram: gram_keys(codes, gram) for gram in SHARED_GRAMS}
        held = np.zeros(1 << GRAM_BITS, dtype=np.int32)
        for item, first, last in self.candidates(codes, starts):
            size, limit = len(self.texts[item]), self.limits[item]
            low, high = max(first - limit, 0), min(last + size + limit, len(codes))
            if all(
                _shared(keys[gram][low : high - gram + 1], own, counts, held) >= size + 1 - gram * (limit + 1)
                for gram, (own, counts) in zip(SHARED_GRAMS, self.grams[item])
            ):
                yield item, low, high
        if not self.lookup.parts:
            return
        regions: dict[int, list[list[int]]] = {}
        for segment, low, high in self.lookup.places(_codes(text)):
            item, size = segment.item, len(self.texts[segment.item])
            low -= segment.offset + self.limits[item]
            high += size - segment.offset - segment.size + self.limits[item]
            regions.setdefault(item, []).append([max(low, 0), min(high, len(text))])
        for item, own in regions.items():
            widest, joined = 4 * len(self.texts[item]), []
            for low, high in sorted(own):
                if joined and low <= joined[-1][1] and high - joined[-1][0] <= widest:
                    joined[-1][1] = max(joined[-1][1], high)
                else:
                    joined.append([low, high])
            for low, high in joined:
                for part in _overlapping(low, high, widest, widest // 2):
                    yield item, *part

    def matches(self, texts: Iterable[str]) -> list[tuple]:
        """``(text number, item, first word, edit distance)`` of each item's closest place in each text.

        Texts are walked many at a time. A very long one is taken in blocks that overlap by more
        than the longest item.
        """
        best: dict[tuple[int, int], tuple[int, int]] = {}
        overlap = 2 * max(map(len, self.texts), default=0) + 8  # words; each has a character and a blank
        pending, size, waiting = [], 0, []

        def settle() -> None:
            text, codes, starts = joined_codes([piece for _, _, piece in pending])
            bounds = np.cumsum([0] + [len(piece) + 1 for _, _, piece in pending])
            for item, low, high in self.places(text, codes, starts):
                low, high = max(low, 0), min(high, len(text))
                for number in range(*(np.searchsorted(bounds, [low, high - 1], "right") - [1, 0]).tolist()):
                    doc, first, piece = pending[number]
                    own = int(bounds[number])
                    end = own + len(piece)
                    begin = text.rfind(" ", own, max(low, own)) + 1 or own
                    last = text.find(" ", min(high, end), end)
                    word = np.searchsorted(starts, np.array([own, begin], dtype=np.int32))
                    near, first = text[begin : end if last < 0 else last], first + int(word[1] - word[0])
                    exact = near.find(self.texts[item])
                    if exact >= 0:
                        place = (0, first + near[:exact].count(" "))
                        best[doc, item] = min(best.get((doc, item), place), place)
                    elif best.get((doc, item), (1, 0))[0]:
                        waiting.append((doc, item, first, near))
                if len(waiting) >= 4 * PAIRS_AT_ONCE:
                    verify()

        def verify() -> None:
            distances = edit_distances([(self.texts[item], near) for _, item, _, near in waiting])
            for (doc, item, first, near), distance in zip(waiting, distances):
                if distance <= self.limits[item]:
                    self._keep(best, doc, item, first, near, distance)
            waiting.clear()

        for doc, text in enumerate(texts if self.texts else ()):
            words, first = [], 0
            for block in word_blocks(text.encode("utf-8", "surrogatepass").translate(LOWER)):
                kept = words[-overlap:]
                first += len(words) - len(kept)
                words = kept + block.translate(None, _PUNCTUATION).split()
                piece = b" ".join(words).decode("utf-8", "replace")
                pending.append((doc, first, piece))
                size += len(piece)
                if size > CHARS_PER_WALK:
                    settle()
                    pending, size = [], 0
        if pending:
            settle()
        verify()
        return [(doc, item, at, distance) for (doc, item), (distance, at) in sorted(best.items())]

    def _keep(self, best: dict, doc: int, item: int, first: int, near: str, distance: int) -> None:
        """Note the place of a match, the closest and then the first in its document."""
        pattern = self.texts[item]
        if (doc, item) in best and best[doc, item][0] < distance:
            return
        _, end = edit_distance(pattern, near)
        _, size = edit_distance(pattern[::-1], near[:end][::-1])  # back from its end, to where it starts
        place = (distance, first + near[: end - size].count(" "))
        best[doc, item] = min(best.get((doc, item), place), place)


def _overlapping(low: int, high: int, size: int, overlap: int) -> list[tuple[int, int]]:
    """``low`` to ``high`` in parts of at most ``size`` that overlap by ``overlap``."""
    if high - low <= size:
        return [(low, high)]
    return [(at, min(at + size, high)) for at in range(low, high - overlap, size - overlap)]


def _finder(index: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = index.value.matches(text for part in slices(batch.column(1)) for text in part)
            doc, *columns = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc, type=pa.int64())), *(pa.array(c, type=pa.int64()) for c in columns)],
                names=[batch.schema.field(0).name, "_item", "first_word", "edit_distance"],
            )

    return run


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    items_per_pass: int = ITEMS_PER_PASS,
    seed: int = 7,
) -> DataFrame:
    """``(id_col, item_col, first_word, edit_distance)`` for each item and document that holds it.

    A document holds an item if a part of it is within ``1 - similarity`` of the item's length in
    edits, both as lower-case words without punctuation. Texts are read once per block of
    ``items_per_pass`` items and never move. Null and empty texts and items match nothing, null
    ids are carried, repeated rows each come back, other columns are dropped. Of several places of an
    item in a document the closest counts, then the first. ``recall`` is that of copies with as many
    random edits as are allowed, the hardest to find; items whose length class falls short of it with
    all walks are looked up by their characters, without a miss. A worker holds the block's hashes,
    some 12 KB per item, and 24 bytes per character of the texts walked together.
    """
    spark, source = docs.sparkSession, texts(docs, id_col, text_col)
    items = benchmark.select(
        benchmark[item_col].alias("item"), F.coalesce(benchmark[item_text_col], F.lit("")).alias("words")
    )
    named = T.StructType([T.StructField("_item", T.LongType()), T.StructField(item_col, items.schema["item"].dataType)])
    found = None
    rows = items.orderBy("item", "words").toLocalIterator()
    while True:
        block = [(row["item"], row["words"]) for row in islice(rows, items_per_pass)]
        if found is not None and not block:
            return found
        index = Index.build(block, recall, seed, similarity)
        hits = source.mapInArrow(
            _finder(spark.sparkContext.broadcast(index)),
            T.StructType([
                source.schema[id_col], T.StructField("_item", T.LongType()),
                T.StructField("first_word", T.LongType()), T.StructField("edit_distance", T.LongType()),
            ]),
        )
        names = spark.createDataFrame(list(enumerate(index.ids)), named)
        hits = hits.join(F.broadcast(names), "_item").select(id_col, item_col, "first_word", "edit_distance")
        found = hits if found is None else found.unionByName(hits)


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **search
) -> DataFrame:
    """``docs`` without the documents that hold an item, all columns kept; rows with a null id stay."""
    found = contaminated(docs, benchmark, id_col, text_col, item_col="item_id", **search)
    return drop_ids(docs, found.select(id_col).dropna().distinct(), id_col)

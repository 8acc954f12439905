"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

All segmentations of a text into pieces of a vocabulary form a lattice; a piece
weighs by its rank, and a segmentation is as likely as the product of its pieces.
The sampler emits the k segmentations whose log-probabilities, each with Gumbel
noise added, are the highest: k distinct draws without replacement. It searches
top down and best first. A set of segmentations that share a beginning has the
largest noisy score of its members; the best set is split at its next piece, its
best child keeps the score, and the others draw theirs below it. The noise comes
from the row's key, so a row always gets the same segmentations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keyed, lean_batches
from tidemark.llm.hashing import U, mixed, seeds

#: Code points searched at a time; a longer text is a batch of its own.
BATCH_CHARS = 1 << 20
#: Noise on a log-probability is at most this: it is drawn from 53 bits.
MOST_NOISE = 38.0
#: How far log-probabilities may fall below the first one before scores wait to be drawn.
WINDOW = 60.0
#: SentencePiece's mark for a space.
SPACE = "▁"
_SPACE = ord(SPACE)
#: Stands for a space mark that the text itself holds; no piece has it.
_FOREIGN = 0x110000
_SALTS = seeds(3, 71)
#: A character's share in a hash, for the code points that most texts have.
_SHORT = mixed(np.arange(1, 0x3001, dtype=U))
_BASE, _INVERSE = U(0x9E3779B97F4A7C15), U(pow(0x9E3779B97F4A7C15, -1, 2**64))


@dataclass
class Vocabulary:
    """Pieces by id, their weights, and what a byte's piece is."""

    pieces: list[str]
    weights: np.ndarray
    normal: np.ndarray
    byte_ids: np.ndarray
    byte_weight: float


def read_vocabulary(model: bytes, sharpness: float = 1.0) -> Vocabulary:
    """The pieces of a serialised model; weight = -sharpness * log(rank + 2)."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    n = processor.vocab_size()
    pieces = [processor.id_to_piece(i) for i in range(n)]
    normal = np.array(
        [
            not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i)
                 or processor.is_unused(i))
            for i in range(n)
        ]
    )
    score = np.array([processor.get_score(i) for i in range(n)])
    rank = np.zeros(n)
    rank[np.argsort(-np.where(normal, score, -np.inf), kind="stable")] = np.arange(n)
    byte_ids = np.full(256, -1, dtype=np.int64)
    for i in range(n):
        if processor.is_byte(i):
            byte_ids[int(pieces[i][1:-1], 16)] = i
    return Vocabulary(
        pieces, -sharpness * np.log(rank + 2), normal, byte_ids, -sharpness * float(np.log(n + 2))
    )


class Prefixes:
    """A hash table of all beginnings of all pieces, looked up many at a time."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        whole = np.flatnonzero(vocabulary.normal)
        pieces = [vocabulary.pieces[i] for i in whole]
        length = np.array([len(p) for p in pieces], dtype=np.int64)
        start = np.cumsum(length) - length
        codes = np.frombuffer("".join(pieces).encode("utf-32-le"), dtype=np.uint32)
        self.longest = int(length.max(initial=1))
        # a row per beginning, which lie one after the other; -1 if it is no piece itself
        begin = np.repeat(start, length)
        ids = np.full(len(codes), -1, dtype=np.int32)
        ids[start + length - 1] = whole
        keys = (_sums(codes)[1:] - _sums(codes)[begin]) * _powers(len(codes))[1][begin]
        order = np.lexsort((ids, keys))
        last = np.append(keys[order][1:] != keys[order][:-1], True)[: len(order)]
        keys, ids = keys[order][last], ids[order][last]
        self.bits = max(12, (len(keys) * 4).bit_length())
        self.keys = np.zeros(1 << self.bits, dtype=U)
        self.ids = np.full(1 << self.bits, -1, dtype=np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # one key takes a free slot, those that meet there go on
            free = left[self.keys[slot[left]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            at = free[first]
            self.keys[slot[at]], self.ids[slot[at]] = keys[at], ids[at]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)

        # single characters, which are most lookups, have a table by code point, of 16
        # bits; the few beyond are the table's last rows, in the order of ``far``
        row = codes[start].astype(np.int64)
        beyond = row > 0xFFFF
        self.far = np.unique(codes[start][beyond])
        row[beyond] = 0x10000 + np.searchsorted(self.far, codes[start][beyond])
        self.single = np.full(0x10000 + len(self.far), -1, dtype=np.int32)
        self.opens = np.zeros(0x10000 + len(self.far), dtype=bool)
        self.opens[row[length > 1]] = True
        self.single[row[length == 1]] = whole[length == 1]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U(0xD6E8FEB86659FD93)) >> U(64 - self.bits)).astype(np.int64)

    def find_one(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each character begins a longer piece, and the id of its own or -1."""
        if codes.max(initial=0) < 0x10000:
            return self.opens[codes], self.single[codes]
        beyond = np.flatnonzero(codes > 0xFFFF)
        rows = codes.astype(np.int64)
        at = np.searchsorted(self.far, codes[beyond])
        known = at < len(self.far)
        known[known] = self.far[at[known]] == codes[beyond[known]]
        rows[beyond] = np.where(known, 0x10000 + at, 0)
        opens, ids = self.opens[rows], self.single[rows]
        opens[beyond[~known]], ids[beyond[~known]] = False, -1
        return opens, ids

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key begins a piece, and the id of the piece it is or -1."""
        slot = self._slot(keys)
        held = self.keys[slot]
        hit = held == keys
        ids = np.where(hit, self.ids[slot], -1)
        left = np.flatnonzero(~hit & (held != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
            held = self.keys[slot[left]]
            same = held == keys[left]
            hit[left[same]] = True
            ids[left[same]] = self.ids[slot[left[same]]]
            left = left[~same & (held != 0)]
        return hit, ids


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_tables, default=0)
    if size <= n:
        size = 1 << max(12, n.bit_length())
        pair = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, dtype=U)
            steps[0] = 1
            pair.append(np.cumprod(steps))
        _tables.clear()
        _tables[size] = (pair[0], pair[1])
    return _tables[size]


def _sums(codes: np.ndarray) -> np.ndarray:
    """Polynomial prefix sums: those of a range, moved to the start, hash the range."""
    out = np.zeros(len(codes) + 1, dtype=U)
    short = codes.max(initial=0) < len(_SHORT)
    each = _SHORT[codes] if short else mixed(codes.astype(U) + U(1))
    each *= _powers(len(codes))[0][: len(codes)]
    np.cumsum(each, out=out[1:])
    return out


def _codes(text: str) -> np.ndarray:
    """Code points with the leading space and the space marks that encoding puts in."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.empty(len(raw) + 1, dtype=np.uint32)
    codes[0], codes[1:] = _SPACE, raw
    codes[1:][raw == _SPACE] = _FOREIGN
    codes[1:][raw == 0x20] = _SPACE
    return codes


def _unit_interval(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64 random bits."""
    return ((x >> U(11)).astype(np.float64) + 0.5) * 2.0**-53


class Lattice:
    """Edges of the distinct words of a batch, and how likely each is taken.

    A word starts at a space mark; no piece crosses into the next one, so a word's
    part of the lattice is the same wherever it stands and is built once. Each word
    has one slot more than it has characters: the end. Edges lie slot by slot,
    slots by their distance from the word's end, the longest edge of a slot first.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray, vocabulary: Vocabulary,
                 prefixes: Prefixes) -> None:
        ends = np.append(starts[1:], len(codes))
        sums = _sums(codes)
        inverse = _powers(len(codes))[1]
        names = mixed((sums[ends] - sums[starts]) * inverse[starts])
        order = np.argsort(names)  # which of equal words comes first does not matter
        new = np.append(True, names[order][1:] != names[order][:-1])
        first = order[new]
        self.word = np.empty(len(names), dtype=np.int64)
        self.word[order] = np.cumsum(new) - 1
        length = ends[first] - starts[first]
        self.start = np.cumsum(length + 1) - (length + 1)
        n = int((length + 1).sum())
        unit = np.repeat(np.arange(len(first)), length + 1)
        offset = np.arange(n) - self.start[unit]
        self.left = length[unit] - offset  # characters to the end
        inside = np.flatnonzero(self.left > 0)
        self.codes = np.zeros(n, dtype=np.uint32)
        self.codes[inside] = codes[(starts[first][unit] + offset)[inside]]
        sums = _sums(self.codes)
        inverse = _powers(n)[1]
        begins, ids = prefixes.find_one(self.codes[inside])
        found = [(inside[ids >= 0], ids[ids >= 0])]  # slots and piece ids, by size
        at = inside[begins]
        for size in range(2, min(prefixes.longest, int(length.max(initial=1))) + 1):
            at = at[self.left[at] >= size]
            begins, ids = prefixes.find((sums[at + size] - sums[at]) * inverse[at])
            whole = ids >= 0
            found.append((at[whole], ids[whole]))
            at = at[begins]
        bare = np.ones(n, dtype=bool)  # a character that is no piece goes as its bytes
        bare[found[0][0]] = False
        plain = inside[bare[inside]]
        found.insert(0, (plain, np.full(len(plain), -1, dtype=np.int32)))

        count = np.bincount(np.concatenate([f[0] for f in found]), minlength=n)
        short = self.left.max(initial=0) < 1 << 16  # sorts faster as short numbers
        order = np.argsort(self.left.astype(np.uint16) if short else self.left, kind="stable")
        self.last = np.empty(n, dtype=np.int64)  # past the slot's last edge
        self.last[order] = np.cumsum(count[order])
        self.first = self.last - count
        total = int(count.sum())
        self.slot = np.repeat(order, count[order])
        self.size, self.piece = np.empty(total, np.int64), np.empty(total, np.int64)
        free = self.last.copy()
        for size, (slots, ids) in enumerate(found):
            edge = free[slots] - 1
            free[slots] = edge
            self.piece[edge], self.size[edge] = ids, max(size, 1)
        weight = vocabulary.weights[self.piece]
        edge = self.last[plain] - 1  # placed first, so last of its slot
        weight[edge] = vocabulary.byte_weight * _byte_counts(self.codes[plain])
        self._share(weight, order, count)

    def _share(self, weight: np.ndarray, order: np.ndarray, count: np.ndarray) -> None:
        """Log-probability of each edge: backward sums, nearest to the word's end first."""
        behind = np.zeros(len(self.left))
        self.to = to = self.slot + self.size
        bounds = np.searchsorted(self.left[order], np.arange(1, int(self.left.max(initial=0)) + 2))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            slots = order[a:b]
            if not len(slots):
                continue
            low, high = int(self.first[slots[0]]), int(self.last[slots[-1]])
            ways = weight[low:high] + behind[to[low:high]]
            cuts = self.first[slots] - low
            top = np.maximum.reduceat(ways, cuts)
            behind[slots] = top + np.log(
                np.add.reduceat(np.exp(ways - np.repeat(top, count[slots])), cuts)
            )
        self.log_share = weight + behind[to] - behind[self.slot]
        self.upto = np.zeros(len(weight) + 1)  # up to and without each edge
        np.cumsum(np.exp(self.log_share), out=self.upto[1:])
        # per slot: up to its edges, with the first of them, and all of them
        self.low = self.upto[self.first]
        self.head = self.upto[np.minimum(self.first + 1, len(weight))]
        self.span = self.upto[self.last] - self.low

    def pick(self, slots: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge taken at each slot, by probability."""
        edge, goal = self.first[slots], self.low[slots] + u * self.span[slots]
        going = np.flatnonzero(self.head[slots] <= goal)  # beyond the slot's first edge
        last, goal = self.last[slots[going]] - 1, goal[going]
        while len(going):
            more = edge[going] < last
            going, last, goal = going[more], last[more], goal[more]
            edge[going] += 1
            more = self.upto[edge[going] + 1] <= goal
            going, last, goal = going[more], last[more], goal[more]
        return edge


def _byte_counts(codes: np.ndarray) -> np.ndarray:
    codes = np.where(codes == _FOREIGN, _SPACE, codes)
    return 1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)


@dataclass
class Path:
    """One segmentation of every text of a batch that has this many.

    ``bound`` has the pieces' range of each text. Per piece: the word it is in, its
    edge, the log-probability before it, and the best noisy score of the other
    edges at its slot. Log-probabilities fall along a text, so scores are drawn for
    its first pieces only, as long as none beyond ``drawn`` can be the best: those
    score at most ``ceiling``. ``given`` has the edges that went to other paths, by
    piece.
    """

    bound: np.ndarray
    word: np.ndarray
    edge: np.ndarray
    before: np.ndarray
    rest: np.ndarray
    log_prob: np.ndarray
    score: np.ndarray
    present: np.ndarray
    drawn: np.ndarray
    ceiling: np.ndarray
    given: dict[int, list[int]] = field(default_factory=dict)


class Batch:
    """Texts searched together."""

    def __init__(self, texts: list[str], keys: np.ndarray, vocabulary: Vocabulary,
                 prefixes: Prefixes) -> None:
        self.n = len(texts)
        parts = [_codes(t) for t in texts]
        codes = np.concatenate(parts)
        char_bound = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        mark = codes == _SPACE
        begins = mark.copy()
        begins[1:] &= ~mark[:-1]
        begins[char_bound[:-1]] = True
        starts = np.flatnonzero(begins)
        self.word_bound = np.searchsorted(starts, char_bound)
        self.lattice = Lattice(codes, starts, vocabulary, prefixes)
        self.seed = mixed(keys.astype(np.int64).view(U))
        self.text_of_word = np.repeat(np.arange(self.n), np.diff(self.word_bound))
        # a word's own noise: of its text's key and its place in the text
        place = np.arange(len(starts)) - self.word_bound[self.text_of_word]
        self.word_seed = mixed(self.seed[self.text_of_word] ^ (place.astype(U) * (_SALTS[0] | U(1))))
        self.paths: list[Path] = []

    def _noise(self, word: np.ndarray, slot: np.ndarray, path: int, use: int) -> np.ndarray:
        """Numbers in (0, 1) of a place in a text, a path and a use."""
        place = self.lattice.left[slot].astype(U) * U(1 << 20) + U(path * 8 + use)
        return _unit_interval(mixed(self.word_seed[word] ^ (place * (_SALTS[1] | U(1)))))

    def _walk(self, word: np.ndarray, slot: np.ndarray, path: int) -> tuple[np.ndarray, np.ndarray]:
        """Words and edges from ``slot`` of each of the words to its end, word by word."""
        lattice, out = self.lattice, []
        line, slot = np.arange(len(word)), slot.copy()
        while len(line):
            at = slot[line]
            edge = lattice.pick(at, self._noise(word[line], at, path, 1))
            out.append((line, edge))
            at = lattice.to[edge]
            slot[line] = at
            line = line[lattice.left[at] > 0]
        count = np.zeros(len(word), dtype=np.int64)
        for step, (line, _) in enumerate(out):
            count[line] = step + 1
        free = np.cumsum(count) - count
        edges = np.empty(int(count.sum()), dtype=np.int64)
        for step, (line, edge) in enumerate(out):
            edges[free[line] + step] = edge
        return np.repeat(word, count), edges

    @staticmethod
    def _below(mass: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
        """Gumbel noise on log-masses, given that it stays below ``bound``."""
        score = np.full(len(mass), -np.inf)
        some = np.isfinite(mass)
        over = np.exp(np.minimum(mass[some] - bound[some], 700.0))
        score[some] = mass[some] - np.log(over - np.log(u[some]))
        return np.minimum(score, bound)

    def _path(self, word: np.ndarray, edge: np.ndarray, bound: np.ndarray, fixed: np.ndarray,
              score: np.ndarray, present: np.ndarray) -> None:
        """Add a path; its first ``fixed`` pieces of a text belong to earlier paths."""
        total = np.zeros(len(edge) + 1)
        np.cumsum(self.lattice.log_share[edge], out=total[1:])
        low, high = bound[:-1], bound[1:]
        before = total[:-1] - np.repeat(total[low], high - low)
        start = np.minimum(low + fixed, high)
        reach = np.where(start < high, before[np.minimum(start, len(edge) - 1)] - WINDOW, 0.0)
        apart = 1e9 * np.arange(self.n)
        drawn = np.searchsorted(np.repeat(apart, high - low) - before, apart - reach, side="right")
        drawn = np.clip(drawn, start, high)
        path = Path(
            bound, word, edge, before, np.full(len(edge), -np.inf), total[high] - total[low],
            score, present, drawn, np.where(drawn < high, reach + MOST_NOISE, -np.inf),
        )
        self.paths.append(path)
        count = drawn - start
        where = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
        self._draw(path, len(self.paths) - 1, where, np.repeat(score, count))

    def _draw(self, path: Path, number: int, where: np.ndarray, score: np.ndarray) -> None:
        """Noisy scores of what a path leaves over at some of its pieces."""
        edge = path.edge[where]
        other = -np.expm1(np.minimum(self.lattice.log_share[edge], 0.0))
        with np.errstate(divide="ignore"):
            mass = np.where(other > 1e-12, path.before[where] + np.log(other), -np.inf)
        noise = self._noise(path.word[where], self.lattice.slot[edge], number, 2)
        path.rest[where] = self._below(mass, score, noise)

    def search(self, k: int) -> np.ndarray:
        """Find up to ``k`` paths per text; returns the best noisy score not emitted."""
        words = np.arange(len(self.text_of_word))
        word, edge = self._walk(words, self.lattice.start[self.lattice.word], 0)
        bound = np.searchsorted(self.text_of_word[word], np.arange(self.n + 1))
        first = -np.log(-np.log(_unit_interval(mixed(self.seed ^ _SALTS[2]))))
        none = np.zeros(self.n, dtype=np.int64)
        self._path(word, edge, bound, none, first, np.ones(self.n, dtype=bool))
        while True:
            best, path, piece = self._best()
            if len(self.paths) == k or not np.isfinite(best).any():
                return best
            self._branch(best, path, piece)

    def _best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text the highest score over all places, with its path and piece."""
        best = np.full(self.n, -np.inf)
        path, piece = np.zeros(self.n, dtype=np.int64), np.zeros(self.n, dtype=np.int64)
        for number, p in enumerate(self.paths):
            for t in np.flatnonzero(p.present):
                i = p.bound[t] + int(p.rest[p.bound[t] : p.drawn[t]].argmax())
                if max(p.rest[i], best[t]) <= p.ceiling[t]:  # something beyond may be better
                    beyond = np.arange(p.drawn[t], p.bound[t + 1])
                    self._draw(p, number, beyond, np.full(len(beyond), p.score[t]))
                    p.drawn[t], p.ceiling[t] = p.bound[t + 1], -np.inf
                    i = p.bound[t] + int(p.rest[p.bound[t] : p.drawn[t]].argmax())
                if p.rest[i] > best[t]:
                    best[t], path[t], piece[t] = p.rest[i], number, i
        return best, path, piece

    def _sibling(self, p: Path, i: int, u: float) -> tuple[int, float]:
        """Gives another edge at a place to a new path; also the log-mass of what is left there."""
        lattice = self.lattice
        slot = lattice.slot[p.edge[i]]
        low = int(lattice.first[slot])
        given = p.given.setdefault(i, [int(p.edge[i])])
        share = np.exp(lattice.log_share[low : lattice.last[slot]])
        share[[edge - low for edge in given]] = 0.0
        upto = np.cumsum(share)
        pick = int((upto <= u * upto[-1]).sum())
        pick = min(pick, int(np.flatnonzero(share)[-1]))
        given.append(low + pick)
        left = share.sum() - share[pick]
        return low + pick, p.before[i] + np.log(left) if left > 1e-12 else -np.inf

    def _branch(self, best: np.ndarray, path: np.ndarray, piece: np.ndarray) -> None:
        """One new path per text: another piece at the best place, and a fresh end."""
        number, lattice = len(self.paths), self.lattice
        present = np.isfinite(best)
        heads, words, slots = [], [], []
        fixed = np.zeros(self.n, dtype=np.int64)
        texts = np.flatnonzero(present)
        split = [(self.paths[path[t]], int(piece[t])) for t in texts]
        here = (
            np.array([p.word[i] for p, i in split]),
            lattice.slot[np.array([p.edge[i] for p, i in split])],
        )
        picks, mass = self._noise(*here, number, 3), np.empty(len(split))
        for j, (t, (p, i)) in enumerate(zip(texts, split, strict=True)):
            edge, mass[j] = self._sibling(p, i, picks[j])
            word, a = int(p.word[i]), p.bound[t]
            fixed[t] = i - a + 1
            heads.append((t, p.word[a : i + 1], np.append(p.edge[a:i], edge)))
            slot = lattice.slot[edge] + lattice.size[edge]
            if lattice.left[slot]:
                words.append(np.array([word]))
                slots.append(np.array([slot]))
            later = np.arange(word + 1, self.word_bound[t + 1])
            words.append(later)
            slots.append(lattice.start[lattice.word[later]])
        rest = self._below(mass, best[texts], self._noise(*here, number, 4))
        for (p, i), score in zip(split, rest, strict=True):
            p.rest[i] = score
        word, edge = self._walk(np.concatenate(words), np.concatenate(slots), number)
        tails = np.searchsorted(self.text_of_word[word], np.arange(self.n + 1))
        new_words, new_edges, counts = [], [], np.zeros(self.n, dtype=np.int64)
        for t, head_words, head_edges in heads:
            tail = slice(tails[t], tails[t + 1])
            new_words += [head_words, word[tail]]
            new_edges += [head_edges, edge[tail]]
            counts[t] = len(head_edges) + tails[t + 1] - tails[t]
        bound = np.concatenate([[0], np.cumsum(counts)])
        self._path(
            np.concatenate(new_words), np.concatenate(new_edges), bound, fixed,
            np.where(present, best, 0.0), present,
        )

    def ids(self, path: Path, text: int, vocabulary: Vocabulary) -> np.ndarray:
        """Piece ids of one text; characters without a piece as their bytes' pieces."""
        ids, bound = self.all_ids(path, vocabulary)
        return ids[bound[text] : bound[text + 1]]

    def all_ids(self, path: Path, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts one after the other, and where each text's begin."""
        ids, bound = self.lattice.piece[path.edge], path.bound
        bare = np.flatnonzero(ids < 0)
        if not len(bare):
            return ids, bound
        codes = self.lattice.codes[self.lattice.slot[path.edge[bare]]]
        if (codes < 0x80).all():  # line feeds and the like: one byte each
            ids[bare] = vocabulary.byte_ids[codes]
            return ids, bound
        codes = np.where(codes == _FOREIGN, _SPACE, codes)
        chars = [chr(c).encode("utf-8", "surrogatepass") for c in codes.tolist()]
        count = np.ones(len(ids), dtype=np.int64)
        count[bare] = [len(c) for c in chars]
        out = np.repeat(ids, count)
        out[out < 0] = vocabulary.byte_ids[np.frombuffer(b"".join(chars), dtype=np.uint8)]
        return out, np.append(0, np.cumsum(count))[bound]


class Decoder:
    """Text of piece ids."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        pieces = [
            p.replace(SPACE, " ") if ok else ""
            for p, ok in zip(vocabulary.pieces, vocabulary.normal, strict=True)
        ]
        self.bytes = [p.encode() for p in pieces]
        self.partial = np.zeros(len(pieces), dtype=bool)  # bytes that are no character alone
        for byte, i in enumerate(vocabulary.byte_ids):
            if i >= 0:
                self.bytes[i] = bytes([byte])
                pieces[i], self.partial[i] = chr(byte), byte >= 0x80
        self.length = np.array([len(p) for p in pieces])
        self.start = np.cumsum(self.length) - self.length
        self.codes = np.frombuffer("".join(pieces).encode("utf-32-le"), dtype=np.uint32)

    def text(self, ids: np.ndarray) -> str:
        """Pieces joined, space marks as spaces, without the leading space put in."""
        if self.partial[ids].any():
            whole = b"".join([self.bytes[i] for i in ids]).decode("utf-8", "surrogatepass")
        else:
            length = self.length[ids]
            stop = np.cumsum(length)
            shift = np.repeat(self.start[ids] - stop + length, length)
            codes = self.codes[shift + np.arange(len(shift))]
            whole = codes.tobytes().decode("utf-32-le", "surrogatepass")
        return whole[1:]


def _batches(texts: list[str | None], keys: np.ndarray) -> Iterator[tuple[list[int], np.ndarray]]:
    """Places of the texts to be searched together, and their keys."""
    rows, size = [], 0
    for i, text in enumerate(texts):
        if rows and size + len(text or "") > BATCH_CHARS:
            yield rows, keys[rows]
            rows, size = [], 0
        if text:
            rows.append(i)
            size += len(text)
    if rows:
        yield rows, keys[rows]


def sample_segmentations(
    docs: DataFrame, model: bytes, k: int = 2, sharpness: float = 1.0, with_ids: bool = True
) -> DataFrame:
    """Up to ``k`` distinct segmentations of every whole text, sampled without replacement.

    Returns one row per document and sample: doc_id, sample from 1 in descending
    noisy score, n_pieces, log_prob, noisy_score, inclusion (the probability that
    the sample is among those emitted, given the best noisy score that was not),
    ids_md5 (of the ids as little-endian 32-bit numbers), round_trip (whether
    decoding gives the text back) and, if ``with_ids``, ids.

    A text with fewer than ``k`` segmentations gives all of them, with inclusion 1.
    NULL and empty texts have one, without pieces. Rows that share an id draw the
    same noise; equal rows get equal samples. A NULL id is a key like any other.
    Characters that no piece covers become their bytes' pieces. A task holds one
    batch of texts at a time, or one long text. An empty table gives no rows.
    """
    lean_batches(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    vocabulary = read_vocabulary(model, sharpness)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes, decoder = Prefixes(vocabulary), Decoder(vocabulary)
        names = ["sample", "n_pieces", "log_prob", "noisy_score", "inclusion", "ids_md5",
                 "round_trip"]
        kinds = [pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.string(),
                 pa.bool_()]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            nothing = hashlib.md5(b"").hexdigest()
            at = [i for i, text in enumerate(texts) if not text]
            out = [(1, 0, 0.0, 0.0, 1.0, nothing, True)] * len(at)
            pieces = [np.empty(0, np.int32)] * len(at)
            for rows, keys in _batches(texts, batch.column("key").to_numpy()):
                held = [texts[i] for i in rows]
                group = Batch(held, keys, vocabulary, prefixes)
                left = group.search(k)
                for number, path in enumerate(group.paths):
                    with np.errstate(over="ignore"):
                        inclusion = -np.expm1(-np.exp(path.log_prob - left))
                    every, bound = group.all_ids(path, vocabulary)
                    every_short = every.astype("<i4")
                    for t in np.flatnonzero(path.present):
                        part = slice(bound[t], bound[t + 1])
                        ids, short = every[part], every_short[part]
                        at.append(rows[t])
                        out.append((
                            number + 1, len(ids), path.log_prob[t], path.score[t], inclusion[t],
                            hashlib.md5(short.tobytes()).hexdigest(), decoder.text(ids) == held[t],
                        ))
                        if with_ids:
                            pieces.append(short)
            columns = [batch.column("doc_id").take(pa.array(at, pa.int64()))]
            values = zip(*out, strict=True) if out else [()] * len(kinds)
            columns += [pa.array(v, kind) for v, kind in zip(values, kinds, strict=True)]
            if with_ids:
                bounds = np.zeros(len(pieces) + 1, dtype=np.int32)
                np.cumsum([len(p) for p in pieces], out=bounds[1:])
                flat = np.concatenate([np.empty(0, np.int32), *pieces])
                columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names, *["ids"] * with_ids])
        _tables.clear()  # the worker process may idle on

    schema = (
        f"doc_id {id_type}, sample int, n_pieces long, log_prob double, noisy_score double, "
        "inclusion double, ids_md5 string, round_trip boolean" + ", ids array<int>" * with_ids
    )
    keyed_docs = docs.select("doc_id", "text", F.xxhash64(keyed(F.col("doc_id"))).alias("key"))
    return keyed_docs.mapInArrow(sample, schema)


def decode(samples: DataFrame, model: bytes, name: str = "text") -> DataFrame:
    """``samples`` with the text of its column ``ids``; NULL ids give NULL."""
    vocabulary = read_vocabulary(model)

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(vocabulary)
        for ids in batches:
            yield pd.Series([None if i is None else decoder.text(np.asarray(i, dtype=np.int64)) for i in ids])

    return samples.withColumn(name, texts("ids"))

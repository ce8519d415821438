"""N-best segmentation into sentence pieces, and decoding (operator 10).

The pieces of a ``.model`` vocabulary that match a normalised text are the edges of a lattice; a
segmentation is a path, its score the sum of its pieces' scores. A forward Viterbi pass gives
every place the best score of a path up to it. These scores are exact heuristics for an A*
search from the end: the first ``n`` complete paths it takes from its queue are the ``n`` best.
No place is expanded more than ``n`` times, so long units and ties stay linear in their edges.

No piece has a space mark after another character (checked on loading), so a text's lattice is
a chain of lattices, one for each run of marks and the word after it (a unit). Workers remember
units, in columns; new ones of a batch are matched and searched side by side. The Viterbi pass also keeps how much the second best path of a unit loses; only the
``n - 1`` units that lose least can differ from the best path within the ``n`` best, so the A*
search runs over those units alone, and their lists are combined.

A character without a piece becomes its UTF-8 byte pieces (or the unknown piece, if the model
has none) at a score below all pieces. Segmentations of equal score come in a fixed order, the
Viterbi path first.
``segment`` gives the ids, ``decode`` the texts, counts and digests of ids it is given, and
``segment_and_decode`` both at once: every distinct unit's ids are decoded when a worker first
meets them, and a text is put together from its units' decoded texts.

Null texts count as empty: one segmentation without pieces, score 0. A text with fewer than
``n`` segmentations gives fewer rows. Repeated rows each give rows; an empty table gives none; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import re
import struct
import zlib
from collections.abc import Iterable, Iterator, Mapping
from typing import NamedTuple

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common

MODEL, BEST = "piece_bpe_32k.model", 4
#: Units a worker remembers in each of two generations, and the longest unit remembered.
REMEMBERED, LONGEST = 300_000, 64
UNKNOWN_PENALTY = 10.0
#: Stands for the ids of a character without a piece (no id is so large).
_FALLBACK = 0xFFFFFFFF
#: Ids (at most) that a worker hands on at once, unless one text has more.
BATCH_IDS = 1 << 21
#: Characters of texts cut into units at once, and of new units searched side by side.
BATCH_CHARS, LEARN_CHARS = 1 << 20, 1 << 17
MARK = "▁"
UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

#: (score, ids) of a path
Path = tuple[float, tuple[int, ...]]
#: Ids of a unit's best path (little-endian unsigned 32-bit), its score, the loss of the second best, the ids' text with its marks.
Best = tuple[bytes, float, float, str]
#: One way through a unit: what it loses against the best one, its ids, the ids' text with its marks.
Way = tuple[float, bytes, str]


class Memory(Mapping):
    """Units and their ``Best``, in columns: nothing is an object of its own but the unit, and its text if that is another."""

    def __init__(self, found: Mapping[str, Best] | None = None) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.ends = np.empty(0, "<u4"), np.zeros(1, np.int64)
        self.scores, self.losses, self.plain = np.empty(0), np.empty(0), np.empty(0, bool)
        self.other: dict[int, str] = {}
        if found:
            self.remember(found.keys(), found.values())

    def __len__(self) -> int:
        return len(self.number)

    def __iter__(self) -> Iterator[str]:
        return iter(self.number)

    def __getitem__(self, unit: str) -> Best:
        k = self.number[unit]
        ids = self.ids[self.ends[k] : self.ends[k + 1]].tobytes()
        return ids, float(self.scores[k]), float(self.losses[k]), self.other.get(k, unit)

    def numbers(self, units: list[str]) -> np.ndarray:
        """The units' numbers, -1 where not known."""
        return np.fromiter(map(self.number.get, units, itertools.repeat(-1)), np.int64, len(units))

    def rows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids one after another, their number, score and loss of the units with these numbers."""
        starts = self.ends[at]
        sizes = self.ends[at + 1] - starts
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)
        return self.ids[places], sizes, self.scores[at], self.losses[at]

    def texts(self, units: list[str], at: np.ndarray) -> dict[int, str]:
        """By place, the decoded texts that are not the unit itself."""
        return {i: self.other[k] for i in np.flatnonzero(~self.plain[at]).tolist() if (k := int(at[i])) in self.other}

    def add(self, units: Iterable[str], ids: np.ndarray, sizes: np.ndarray, scores: np.ndarray, losses: np.ndarray, other: dict[int, str]) -> None:
        """Units with their rows, and by place the decoded texts that are not the unit itself."""
        first = len(self.scores)
        self.number.update(zip(units, itertools.count(first)))
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self.scores, self.losses = np.concatenate([self.scores, scores]), np.concatenate([self.losses, losses])
        plain = np.ones(len(sizes), bool)
        plain[list(other)] = False
        self.plain = np.concatenate([self.plain, plain])
        self.other.update((first + i, t) for i, t in other.items())

    def remember(self, units: Iterable[str], bests: Iterable[Best]) -> None:
        units, (raw, scores, losses, texts) = list(units), zip(*bests)
        ids = np.frombuffer(b"".join(raw), "<u4")
        other = {i: t for i, (u, t) in enumerate(zip(units, texts)) if t != u}
        self.add(units, ids, np.array([len(r) // 4 for r in raw]), np.array(scores), np.array(losses), other)

    def forget(self, units: list[str]) -> None:
        """The units that were added last."""
        n = len(self.scores) - len(units)
        for u in units:
            self.other.pop(self.number.pop(u), None)
        self.ids, self.ends = self.ids[: self.ends[n]].copy(), self.ends[: n + 1]
        self.scores, self.losses, self.plain = self.scores[:n], self.losses[:n], self.plain[:n]


class Met(NamedTuple):
    """The units of some texts one after another: where each text's begin, the units, their scores and losses, the ids of
    all, where each unit's ids begin (in bytes), and by place the decoded texts that are not the unit itself."""

    bounds: list[int]
    units: list[str]
    scores: np.ndarray
    losses: np.ndarray
    ids: memoryview
    ends: np.ndarray
    other: dict[int, str]

    def read(self, i: int) -> str:
        """The decoded text of the unit at a place."""
        return self.other.get(i, self.units[i])


class Decoder:
    """Texts of segmentations: pieces joined, byte pieces read as UTF-8, marks as spaces, the first one dropped."""

    def __init__(self, sp: sentencepiece.SentencePieceProcessor) -> None:
        table = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.pieces = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.encode() for i, p in enumerate(table)]
        self.table = pa.array(self.pieces, pa.large_binary())

    def joined(self, ids: bytes) -> str:
        """The pieces of little-endian unsigned 32-bit ids one after another, marks included."""
        pieces = map(self.pieces.__getitem__, struct.unpack(f"<{len(ids) // 4}I", ids))
        return str(b"".join(pieces), "utf-8", "replace")

    def marked(self, ids: np.ndarray, ends: list[int]) -> list[str]:
        """The pieces of ``ids[ends[k]:ends[k + 1]]`` one after another, marks included."""
        joined = self.table.take(pa.array(ids))  # its data are the pieces of all ids, one after another
        at = np.frombuffer(joined.buffers()[1], np.int64)[: len(ids) + 1][ends].tolist()
        raw = memoryview(joined.buffers()[2] or b"")
        return [str(raw[a:b], "utf-8", "replace") for a, b in zip(at, at[1:])]

    def texts(self, ids: np.ndarray, ends: list[int]) -> list[str]:
        """The texts of ``ids[ends[k]:ends[k + 1]]``."""
        return [t.replace(MARK, " ").removeprefix(" ") for t in self.marked(ids, ends)]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Trie:
    """Beginnings of pieces, for many places of a text at once, one more character at a time.

    A beginning is a number; a hash table has the one with another character by (number, the character's number).
    """

    def __init__(self, pieces: list[str]) -> None:
        chars = sorted(set("".join(pieces)))
        self.codes = _codes("".join(chars))
        self.width = len(chars) + 1
        of = {c: k for k, c in enumerate(chars, 1)}
        number, keys, self.depth = {"": 0}, {}, max(map(len, pieces))
        for p in pieces:
            for k in range(1, len(p) + 1):
                if p[:k] not in number:
                    number[p[:k]] = len(number)
                    keys[number[p[: k - 1]] * self.width + of[p[k - 1]]] = number[p[:k]]
        self.piece = np.full(len(number), -1, np.int64)
        self.piece[[number[p] for p in pieces]] = np.arange(len(pieces))
        # Open addressing: a key is in the first free slot from its hash on.
        self.bits = 64 - (2 * len(keys)).bit_length() - 1
        self.keys = np.full((1 << (64 - self.bits)) + len(keys), -1, np.int64)
        self.next = np.full(len(self.keys), -1, np.int64)
        left, values = np.array(list(keys)), np.array(list(keys.values()))
        slot = self._slot(left)
        while len(left):
            _, firsts = np.unique(slot, return_index=True)
            put = firsts[self.keys[slot[firsts]] == -1]
            self.keys[slot[put]], self.next[slot[put]] = left[put], values[put]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, values, slot = left[rest], values[rest], slot[rest] + 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.bits)).astype(np.int64)

    def following(self, at: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The beginnings ``at`` with one more character, -1 if no piece begins so."""
        keys = at * self.width + char
        slot = self._slot(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.next[slot], -1)
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            slot[open_] += 1
            there = self.keys[slot[open_]]
            out[open_] = np.where(there == keys[open_], self.next[slot[open_]], -1)
            open_ = open_[(there != keys[open_]) & (there != -1)]
        return out

    def matches(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last places and numbers of all pieces in a text, longer ones first; a piece that begins at a place ends before
        that place's ``ends``."""
        char = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        char = np.where(self.codes[char] == codes, char + 1, 0)
        place, state, found = np.arange(len(codes)), np.zeros(len(codes), np.int64), []
        for k in range(self.depth):
            state = self.following(state, char[place + k])
            on = state >= 0
            place, state = place[on], state[on]
            piece = self.piece[state]
            whole = piece >= 0
            found.append((place[whole] + k, piece[whole]))
            on = place + k + 1 < ends[place]
            place, state = place[on], state[on]
        last, piece = zip(*reversed(found))
        return np.concatenate(last), np.concatenate(piece)


class Lattices:
    """The vocabulary of one model and what this worker has met."""

    def __init__(self, path: str) -> None:
        self.model = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [
            i
            for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))
        ]
        self.pieces = {sp.id_to_piece(i): (float(sp.get_score(i)), i) for i in usable}
        if any(MARK in p.lstrip(MARK) for p in self.pieces):
            raise ValueError(f"{path}: pieces cross word starts")
        self.unknown = min(s for s, _ in self.pieces.values()) - UNKNOWN_PENALTY
        self.bytes = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
        self.decoder = Decoder(sp)
        self.single = {p for p in self.pieces if len(p) == 1}
        #: Edges by number: length, score and id of a piece.
        self.edge = [(len(p), score, i) for p, (score, i) in self.pieces.items()]
        # One more for a character without a piece.
        self.edge_length, self.edge_score, self.edge_id = (np.array(x) for x in zip(*self.edge, (1, self.unknown, _FALLBACK)))
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, p in enumerate(self.pieces):
            self.matcher.add_word(p, k)
        self.matcher.make_automaton()
        self.trie = Trie(list(self.pieces))
        self.known, self.older = Memory(), Memory()
        self.lists: dict[tuple[str, int], list[Way]] = {}

    @property
    def known(self) -> Memory:
        return self._known

    @known.setter
    def known(self, found: Mapping[str, Best]) -> None:
        self._known = found if isinstance(found, Memory) else Memory(found)

    def fallback(self, char: str) -> tuple[int, ...]:
        if not self.bytes:
            return (self.model.unk_id(),)
        return tuple(self.bytes[f"<0x{b:02X}>"] for b in char.encode("utf-8", "replace"))

    def edges(self, unit: str) -> list[tuple[int, tuple[int, float, int]]]:
        """The lattice's edges by end: last place covered and (length, score, id; -1: fallback)."""
        edge = self.edge
        found = [(last, edge[k]) for last, k in self.matcher.iter(unit)]
        if not self.single.issuperset(unit):
            found += [(k, (1, self.unknown, -1)) for k, c in enumerate(unit) if c not in self.single]
            found.sort(key=lambda e: e[0])
        return found

    def ids(self, unit: str, end: int, length: int, piece: int) -> tuple[int, ...]:
        return (piece,) if piece >= 0 else self.fallback(unit[end - length : end])

    def viterbi(self, unit: str) -> Best:
        low = -np.inf
        size = len(unit) + 1
        best, second, lengths, pieces = [0.0] + [low] * len(unit), [low] * size, [0] * size, [0] * size
        for last, (length, score, piece) in self.edges(unit):
            end = last + 1
            total = best[end - length] + score
            if total > best[end]:
                second[end] = best[end]
                best[end], lengths[end], pieces[end] = total, length, piece
            elif total > second[end]:
                second[end] = total
        loss, end, ids = np.inf, len(unit), []
        while end:
            if best[end] - second[end] < loss:
                loss = best[end] - second[end]
            if pieces[end] >= 0:
                ids.append(pieces[end])
            else:
                ids += reversed(self.fallback(unit[end - 1]))
            end -= lengths[end]
        ids.reverse()
        raw = struct.pack(f"<{len(ids)}I", *ids)
        return raw, best[-1], loss, self.decoder.joined(raw)

    def learn(self, units: list[str]) -> None:
        """Remember the Viterbi paths of many units, searched side by side: all of a unit's places with one more
        character at a time. What ``viterbi`` says of each."""
        lengths = np.array([len(u) for u in units], np.int64)
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(units)), lengths)
        together = "".join(units)
        codes = _codes(together)
        last, piece = self.trie.matches(codes, np.repeat(starts + lengths, lengths))
        without = "".join(set(together).difference(self.single))
        if without:  # their fallback is the edge after the last piece
            bare = np.flatnonzero(np.isin(codes, _codes(without)))
            last, piece = np.concatenate([last, bare]), np.concatenate([piece, np.full(len(bare), len(self.edge))])
        unit = owner[last]
        # Unit u has the places starts[u] + u up to its length later; edges lead to a place from an earlier one.
        to = last + unit + 1
        level = last - starts[unit]
        order = np.argsort(level * (len(owner) + len(units) + 1) + to, kind="stable")
        to, piece, level = to[order], piece[order], level[order]
        origin, score = to - self.edge_length[piece], self.edge_score[piece]
        n_places = len(owner) + len(units)
        best, second = np.full(n_places, -np.inf), np.full(n_places, -np.inf)
        back = np.zeros(n_places, np.int64)
        best[starts + np.arange(len(units))] = 0.0
        bounds = np.flatnonzero(np.diff(level, prepend=-1, append=level[-1] + 1))
        for a, b in zip(bounds, bounds[1:]):
            total = best[origin[a:b]] + score[a:b]
            place = to[a:b]
            firsts = np.flatnonzero(np.diff(place, prepend=-1))
            top = np.maximum.reduceat(total, firsts)
            counts = np.diff(firsts, append=b - a)
            chosen = np.minimum.reduceat(np.where(total == np.repeat(top, counts), np.arange(b - a), b - a), firsts)
            best[place[firsts]], back[place[firsts]] = top, chosen + a
            total[chosen] = -np.inf
            second[place[firsts]] = np.maximum.reduceat(total, firsts)
        here = starts + np.arange(len(units)) + lengths
        score_of, loss = best[here], np.full(len(units), np.inf)
        active, steps = np.arange(len(units)), []
        begin = starts + np.arange(len(units))
        while len(active):
            at = here[active]
            loss[active] = np.minimum(loss[active], best[at] - second[at])
            steps.append((active, self.edge_id[piece[back[at]]], origin[back[at]] - active))
            here[active] = origin[back[at]]
            active = active[here[active] > begin[active]]
        # Paths were read from their ends.
        whose, ids, chars = (np.concatenate(x) for x in zip(*reversed(steps)))
        order = np.argsort(whose, kind="stable")
        ids = ids[order].astype("<u4")
        sizes = np.bincount(whose, minlength=len(units))
        if without:
            ids, sizes = self._with_fallbacks(ids, whose[order], together, chars[order], len(units))
        read = self.decoder.marked(ids, [0, *np.cumsum(sizes).tolist()])
        other = {i: t for i, (u, t) in enumerate(zip(units, read)) if t != u}
        self.known.add(units, ids, sizes, score_of, loss, other)

    def _with_fallbacks(self, ids: np.ndarray, whose: np.ndarray, text: str, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids, and their number by unit, with each ``_FALLBACK`` replaced by the ids of its character (``at`` in ``text``)."""
        marks = np.flatnonzero(ids == _FALLBACK)
        chars = [text[k] for k in at[marks].tolist()]
        of = {c: self.fallback(c) for c in set(chars)}
        parts = list(map(of.__getitem__, chars))
        counts = np.ones(len(ids), np.int64)
        counts[marks] = [len(p) for p in parts]
        out = np.repeat(ids, counts)
        out[out == _FALLBACK] = list(itertools.chain.from_iterable(parts))
        return out, np.bincount(np.repeat(whose, counts), minlength=n)

    def meet(self, texts: list[list[str]]) -> Met:
        """Before texts (their units) are segmented: learn the units that are new, and bring older ones over."""
        if len(self.known) >= REMEMBERED:
            self.older, self.known = self.known, Memory()
        units = list(itertools.chain.from_iterable(texts))
        at = self.known.numbers(units)
        unknown = np.flatnonzero(at < 0)
        long = []
        if len(unknown):
            some = [units[i] for i in unknown.tolist()]
            new = list(dict.fromkeys(some))
            if back := [u for u in new if u in self.older.number]:
                old = self.older.numbers(back)
                self.known.add(back, *self.older.rows(old), self.older.texts(back, old))
                new = [u for u in new if u not in self.older.number]
            short = [u for u in new if len(u) <= LONGEST]
            for part in common.slices(short, [len(u) for u in short], LEARN_CHARS):
                self.learn(part)
            if long := [u for u in new if len(u) > LONGEST]:
                self.known.remember(long, map(self.viterbi, long))
            at[unknown] = self.known.numbers(some)
        ids, sizes, scores, losses = self.known.rows(at)
        other = self.known.texts(units, at)
        if long:
            self.known.forget(long)
        bounds = np.cumsum([0, *map(len, texts)]).tolist()
        return Met(bounds, units, scores, losses, memoryview(ids.tobytes()), np.concatenate([[0], np.cumsum(sizes) * 4]), other)

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        whole = self.model.normalize(text)
        if " " in whole or MARK * 2 in whole:
            return UNIT.findall(whole)
        return whole.replace(MARK, " " + MARK).removeprefix(" ").split(" ") if whole else []

    def nbest(self, unit: str, n: int) -> list[Path]:
        """The ``n`` best paths of a unit, best first: A* from its end with forward scores as heuristics.

        Every place is expanded at most ``n`` times: the ``n`` best paths use no more of its ways to
        the end. Entries are linked to the expanded one they come from, so the search needs memory for at
        most ``n`` entries an edge. Among equal scores the place nearest to the start goes first.
        """
        into: list[list[tuple[int, float, int]]] = [[] for _ in range(len(unit) + 1)]
        forward = [0.0] + [-np.inf] * len(unit)
        for last, edge in self.edges(unit):
            into[last + 1].append(edge)
            forward[last + 1] = max(forward[last + 1], forward[last + 1 - edge[0]] + edge[1])
        # Entries: -(best score through here), place, order of entry, score from here, parent, length, piece.
        queue = [(-forward[-1], len(unit), 0, 0.0, -1, 0, 0)]
        expanded: list[tuple[int, int, int, int]] = []  # place, parent, length and piece of the edge after it
        times = [0] * (len(unit) + 1)
        entered = 0
        found: list[Path] = []
        while queue and len(found) < n:
            _, place, _, score, parent, length, piece = heapq.heappop(queue)
            if times[place] == n:
                continue
            times[place] += 1
            if not place:
                found.append((score, self._ids_from(unit, expanded, (place, parent, length, piece))))
                continue
            expanded.append((place, parent, length, piece))
            for length, s, piece in into[place]:
                start = place - length
                if times[start] < n:
                    entered += 1
                    total = s + score
                    heapq.heappush(queue, (-(forward[start] + total), start, entered, total, len(expanded) - 1, length, piece))
        return sorted(found, key=lambda p: (-p[0], len(p[1]), p[1]))

    def _ids_from(self, unit: str, expanded: list[tuple[int, int, int, int]], at: tuple[int, int, int, int]) -> tuple[int, ...]:
        ids: list[int] = []
        place, parent, length, piece = at
        while parent >= 0:
            ids += self.ids(unit, place + length, length, piece)
            place, parent, length, piece = expanded[parent]
        return tuple(ids)

    def listed(self, met: Met, i: int, n: int) -> list[Way]:
        """The ``n`` best paths of the unit at a place, the Viterbi path first."""
        unit = met.units[i]
        got = self.lists.get((unit, n))
        if got is None:
            first, best = met.ids[met.ends[i] : met.ends[i + 1]].tobytes(), float(met.scores[i])
            rest = [(s - best, np.array(p, "<u4").tobytes()) for s, p in self.nbest(unit, n)]
            got = [(0.0, first, met.read(i)), *((d, p, self.decoder.joined(p)) for d, p in rest if p != first)][:n]
            if len(unit) <= LONGEST:
                if len(self.lists) >= REMEMBERED // 4:
                    self.lists.clear()
                self.lists[unit, n] = got
        return got

    def segmentations(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """Scores and ids of the ``n`` best segmentations of a text, best first."""
        return [(score, ids) for score, ids, _ in self.chains(self.meet([self.units(text)]), 0, n)]

    def chains(self, met: Met, text: int, n: int) -> Iterator[tuple[float, bytes, list[tuple[int, Way]]]]:
        """The ``n`` best segmentations of a text, best first: score, ids, and the places of the units that may have
        another way than in the best one, with their ways."""
        a, b = met.bounds[text : text + 2]
        if a == b:
            yield 0.0, b"", []
            return
        total = sum(met.scores[a:b].tolist())
        loss = met.losses[a:b]
        k = min(n - 1, b - a)
        at = np.argsort(loss, kind="stable")[:k] if b - a <= 64 else _smallest(loss, k)
        # Combine the units that lose least; others stay on their best path.
        ways: list[tuple[float, int, tuple[tuple[int, Way], ...]]] = [(0.0, 0, ())]
        for i in at.tolist():
            if not np.isfinite(loss[i]):
                continue
            paths = self.listed(met, a + i, n)
            ways = [(d + p[0], size + len(p[1]), (*chosen, (a + i, p))) for d, size, chosen in ways for p in paths]
            ways = sorted(ways, key=_order)[:n]
        for lost, _, chosen in ways[:n]:
            parts, begin = [], met.ends[a]
            for i, p in sorted(chosen):
                parts += [met.ids[begin : met.ends[i]], p[1]]
                begin = met.ends[i + 1]
            yield total + lost, b"".join([*parts, met.ids[begin : met.ends[b]]]), list(chosen)

    def decoded_segmentations(self, met: Met, text: int, n: int) -> Iterator[tuple[float, bytes, str]]:
        """Score, ids and decoded text of the ``n`` best segmentations of a text."""
        a, b = met.bounds[text : text + 2]
        parts = [met.read(i) for i in range(a, b)] if met.other else met.units[a:b]
        whole = _spaced(parts)
        for score, ids, chosen in self.chains(met, text, n):
            if all(p[2] == parts[i - a] for i, p in chosen):
                yield score, ids, whole
            else:
                read = parts.copy()
                for i, p in chosen:
                    read[i - a] = p[2]
                yield score, ids, _spaced(read)

    def decode(self, ids) -> str:
        """The text of a segmentation."""
        return self.decoder.texts(np.asarray(ids, np.int64), [0, len(ids)])[0]


def _spaced(parts: list[str]) -> str:
    """A text from the decoded texts of its units."""
    return "".join(parts).replace(MARK, " ").removeprefix(" ")


def _order(way: tuple[float, int, tuple]) -> tuple[float, int]:
    """The best score first, then the fewest ids."""
    return -way[0], way[1]


def _smallest(loss: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` smallest values, earlier ones first among equals."""
    if not k:
        return np.empty(0, np.int64)
    limit = np.partition(loss, k - 1)[k - 1]
    some = np.flatnonzero(loss <= limit)
    return some[np.argsort(loss[some], kind="stable")][:k]


@common.remembered("pieces")
def lattices(path: str) -> Lattices:
    """One instance a worker process and model."""
    return Lattices(path)


def _segment(path: str, n: int):
    @common.worker("pieces")
    def run(batches):
        found = lattices(path)
        for batch in batches:
            texts = common.texts_of(batch)
            for some in common.slices(range(len(texts)), [n * len(t) for t in texts], BATCH_IDS):
                rows, rank, score, parts = [], [], [], []
                met = found.meet([found.units(texts[i]) for i in some])
                for at, i in enumerate(some):
                    for k, (s, ids, _) in enumerate(found.chains(met, at, n)):
                        rows.append(i)
                        rank.append(k + 1)
                        score.append(s)
                        parts.append(ids)
                ends = np.cumsum([0, *(len(x) // 4 for x in parts)])
                ids = pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows, pa.int64())),
                        pa.array(rank, pa.int32()),
                        pa.array(score, pa.float64()),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids),
                    ],
                    ["doc_id", "rank", "score", "ids"],
                )

    return run


def segment(docs: DataFrame, model: str | None = None, n: int = BEST) -> DataFrame:
    """``doc_id, rank, score, ids, n_pieces``: the ``n`` best segmentations of every text. A narrow pass."""
    path = model or public_tokenizers.path(MODEL)
    common.prepare_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, rank int, score double, ids array<int>"
    rows = docs.select("doc_id", "text").mapInArrow(_segment(path, n), schema)
    return rows.withColumn("n_pieces", F.size("ids").cast("long"))


@common.remembered("pieces")
def decoder(path: str) -> Decoder:
    """One instance a worker process and model."""
    return Decoder(sentencepiece.SentencePieceProcessor(model_file=path))


def _decode(path: str):
    @common.worker("pieces")
    def run(batches):
        found = decoder(path)
        for batch in batches:
            ids = batch.column("ids")
            sizes = np.diff(ids.offsets.to_numpy())
            for some in common.slices(range(len(batch)), sizes.tolist(), BATCH_IDS):
                part = batch.slice(some[0], len(some))
                lists = part.column("ids")
                flat = lists.flatten().to_numpy().astype("<u4", copy=False)
                ends = np.cumsum([0, *sizes[some[0] : some[-1] + 1]]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("rank"),
                        part.column("score"),
                        pa.array(sizes[some[0] : some[-1] + 1], pa.int64()),
                        pa.array([zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.int64()),
                        pa.array(found.texts(flat, ends), pa.string()),
                    ],
                    ["doc_id", "rank", "score", "n_pieces", "ids_crc32", "text"],
                )

    return run


def decode(segments: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, rank, score, n_pieces, ids_crc32, text`` of rows ``doc_id, rank, score, ids``.

    ``text`` is read from the ids alone, as is ``ids_crc32``, over them as little-endian unsigned
    32-bit numbers. A narrow pass.
    """
    path = model or public_tokenizers.path(MODEL)
    common.prepare_workers(segments.sparkSession)
    kind = segments.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, rank int, score double, n_pieces long, ids_crc32 long, text string"
    return segments.select("doc_id", "rank", "score", "ids").mapInArrow(_decode(path), schema)


def _segment_and_decode(path: str, n: int):
    @common.worker("pieces")
    def run(batches):
        found = lattices(path)
        for batch in batches:
            rows, rank, score, size, crc, text_crc = [], [], [], [], [], []
            texts = common.texts_of(batch)
            for some in common.slices(range(len(texts)), [len(t) for t in texts], BATCH_CHARS):
                met = found.meet([found.units(texts[i]) for i in some])
                for at, i in enumerate(some):
                    last, last_crc = None, 0
                    for k, (s, ids, back) in enumerate(found.decoded_segmentations(met, at, n)):
                        if back is not last:
                            last, last_crc = back, zlib.crc32(back.encode("utf-8", "replace"))
                        rows.append(i)
                        rank.append(k + 1)
                        score.append(s)
                        size.append(len(ids) // 4)
                        crc.append(zlib.crc32(ids))
                        text_crc.append(last_crc)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(rank, pa.int32()),
                    pa.array(score, pa.float64()),
                    *(pa.array(x, pa.int64()) for x in (size, crc, text_crc)),
                ],
                ["doc_id", "rank", "score", "n_pieces", "ids_crc32", "text_crc32"],
            )

    return run


def segment_and_decode(docs: DataFrame, model: str | None = None, n: int = BEST) -> DataFrame:
    """``doc_id, rank, score, n_pieces, ids_crc32, text_crc32``: digests of the ids and of the decoded text of
    the ``n`` best segmentations of every text. A narrow pass; equal to ``decode(segment(docs))``."""
    path = model or public_tokenizers.path(MODEL)
    common.prepare_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, rank int, score double, n_pieces long, ids_crc32 long, text_crc32 long"
    return docs.select("doc_id", "text").mapInArrow(_segment_and_decode(path, n), schema)


def op10_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_and_decode(common.load(spark, sf_dir, "documents"))

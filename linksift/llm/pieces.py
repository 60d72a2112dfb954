"""SentencePiece encoding with seeded merge dropout, and exact decoding.

Merge-type (BPE) segmentation joins, again and again, the neighbouring symbols whose
union is the best piece. With dropout each candidate merge is struck off the agenda
with some probability. A hash decides, keyed by the seed, the document's id, the place of
the word in the document and the candidate's place in the word: every occurrence of a word is
drawn for itself, the same seed gives the same cut on any cluster, another seed another
cut, and no dropout the library's own. Every segmentation decodes to the text.

What does not depend on the key is kept by a worker: the merges that the agenda takes for a
word (its course), and the courses after some of them are struck. An occurrence follows
the word's course up to its own first struck merge and goes on with the course after that one.
A course is kept from the second time that it is needed; an occurrence that needs it for the
first time is cut by itself, with its own draws. Both give the same cut.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linksift.llm.common import text_or_empty

DROPOUT = 0.1
#: Longer words go through the agenda once for each occurrence, shorter ones share courses.
SHARED = 24
#: Words up to each of these lengths are cut together.
LENGTHS = (6, 10, 16, SHARED)
#: A worker forgets its courses beyond this many; they are found again when needed.
KEPT = 300_000
#: Bytes of text that are cut at a time.
AT_A_TIME = 1_000_000
#: Occurrences whose candidates are drawn at a time.
DRAWN = 50_000
#: Places for the hashes of words met once; words that share one are kept a time too early.
MET = 1 << 22
BLANK = "▁"
WORD = re.compile(" +[^ ]*")
_GOLDEN, _FULL = 0x9E3779B97F4A7C15, (1 << 64) - 1
_NEVER = np.iinfo(np.int32).max


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _key(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _place(a: int, b: int, e: int) -> int:
    """The candidate that joins [a, b) and [b, e), as a 64-bit number."""
    return ((a << 42) ^ (b << 21) ^ e) * _GOLDEN & _FULL


#: The same by the number of a candidate in a word of less than 32 characters: a, b and e in five bits each.
_a, _b, _e = (np.arange(1 << 15, dtype=np.uint64) >> np.uint64(x) & np.uint64(31) for x in (10, 5, 0))
_PLACES = ((_a << np.uint64(42)) ^ (_b << np.uint64(21)) ^ _e) * np.uint64(_GOLDEN)


class Grown:
    """A numpy array that grows at its end."""

    def __init__(self, dtype: str):
        self.data, self.n = np.zeros(1 << 12, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.data):
            room = np.zeros(max(len(values), len(self.data)), self.data.dtype)
            self.data = np.concatenate((self.data, room))
        self.data[self.n : self.n + len(values)] = values
        self.n += len(values)


class Courses:
    """Courses of words: the merges taken, the course after each one is struck, the ids in the end.

    Course v owns the merges ``begin[v]`` to ``begin[v] + size[v]`` and the ids
    ``out_begin[v]`` to ``out_begin[v] + out_size[v]``; ``child`` is -1 where the course after a
    struck merge was never needed, -2 where it was needed once. It is a course of the word
    ``word[v]`` after the merge ``up[v]`` was struck (-1: none); its first ``skip[v]`` merges stand
    in the courses above it. Words are kept without the blank before them.
    """

    def __init__(self) -> None:
        self.root: dict[str, int] = {}
        self.words: list[str] = []
        self.length, self.word, self.up, self.skip = (Grown(t) for t in ("i1", "i4", "i4", "i1"))
        self.candidate, self.child = Grown("i2"), Grown("i4")
        self.begin, self.size, self.out_begin, self.out_size, self.out = (Grown(t) for t in ("i4", "i1", "i4", "i2", "i4"))
        self.met = np.zeros(MET, bool)


class Pieces:
    """A merge-type SentencePiece model with byte pieces and no normalisation."""

    def __init__(self, path: str, seed: int, dropout: float):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.size, self.seed, self.dropout = size, seed, dropout
        self.byte = np.full(256, -1, np.int64)
        raw: list[bytes] = []
        best: dict[str, tuple[int, float]] = {}
        for i in range(size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                raw.append(piece.replace(BLANK, " ").encode())
                best[piece] = (i, sp.get_score(i))
                if BLANK in piece.lstrip(BLANK):
                    raise ValueError("pieces across words are not supported")
        if (self.byte < 0).any():
            raise ValueError("the model has no byte pieces; some texts could not be decoded")
        self.raw = pa.array(raw, pa.large_binary())
        self.char = {p if p != BLANK else " ": i for p, (i, _) in best.items() if len(p) == 1}
        # the lower the rank, the better the merge; equal scores rank by their ids
        ordered = sorted(best, key=lambda p: (-best[p][1], best[p][0]))
        self.of_rank = [best[p][0] for p in ordered]
        self.rank = {
            best[p[:k]][0] * size + best[p[k:]][0]: r
            for r, p in enumerate(ordered) for k in range(1, len(p)) if p[:k] in best and p[k:] in best
        }
        self.symbol_of = np.full(0x110000, -1, np.int32)
        self.symbol_of[:128] = self.byte[:128]  # one byte, which is in no merge
        self.symbol_of[[ord(c) for c in self.char]] = list(self.char.values())
        self.result = np.array(self.of_rank, np.int32)
        self._index()
        self.courses = Courses()

    def _index(self) -> None:
        """The pairs that merge, hashed into a table of at most an eighth of its places."""
        self.bits = (8 * len(self.rank)).bit_length()
        self.slot_pair, self.slot_rank = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, _NEVER, np.int32)
        code, rank = np.array(list(self.rank), np.int64), np.array(list(self.rank.values()), np.int32)
        at = self._slot(code)
        while len(code):
            at = np.where(self.slot_pair[at] == -1, at, (at + 1) & ((1 << self.bits) - 1))
            free = self.slot_pair[at] == -1
            self.slot_pair[at[free]] = code[free]  # of several for one place the last stays
            got = self.slot_pair[at] == code
            self.slot_rank[at[got]] = rank[got]
            code, rank, at = code[~got], rank[~got], at[~got]

    def _slot(self, code: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (code.astype(np.uint64) * np.uint64(_GOLDEN) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of symbols; never, where there is none."""
        code = left.astype(np.int64) * self.size + right
        code[(left < 0) | (right < 0)] = -2
        at = self._slot(code)
        held = self.slot_pair[at]
        out = np.where(held == code, self.slot_rank[at], _NEVER)
        open_ = np.flatnonzero((held != code) & (held != -1) & (code != -2))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            held = self.slot_pair[at[open_]]
            same = held == code[open_]
            out[open_[same]] = self.slot_rank[at[open_[same]]]
            open_ = open_[~same & (held != -1)]
        return out

    def many(self, words: list[str], n: int, gone: np.ndarray | None = None, key: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Words of up to n characters with the blank before them at once, in each round every word
        takes its best merge: the candidates taken (with ``gone``) and their number, the ids, and
        how many each word has. Struck are the candidates in the rows of ``gone``, in which 0 is
        none, or those drawn by the keys."""
        rows, w = len(words), n + 1
        width = np.fromiter(map(len, words), np.int64, rows) + 1
        symbol = np.full((rows, w), -2, np.int32)  # by the place at which it begins; -2: none begins there
        symbol[:, 0] = self.symbol_of[32]
        symbol[:, 1:n] = self.symbol_of[np.array(words, f"U{n - 1}").view("u4").reshape(rows, n - 1)]
        columns = np.arange(w)
        symbol[columns >= width[:, None]] = -2
        after, before = np.tile(columns + 1, (rows, 1)), np.tile(columns - 1, (rows, 1))
        rank = np.full((rows, w), _NEVER, np.int32)
        taken, steps = np.zeros((rows, n), np.int16), np.zeros(rows, np.int64)
        if gone is not None and gone.shape[1]:
            gone = gone[:, gone.any(0)]
        symbols, afters, befores, ranks = symbol.reshape(-1), after.reshape(-1), before.reshape(-1), rank.reshape(-1)

        def put(row: np.ndarray, a: np.ndarray, b: np.ndarray, e: np.ndarray) -> None:
            """The rank of the symbols [a, b) and [b, e) at the place a."""
            base = row * w
            new = self.ranks(symbols[base + a], symbols[base + b])
            if self.dropout and (key is not None or gone is not None and gone.shape[1]):
                some = np.flatnonzero(new != _NEVER)
                candidate = a[some] << 10 | b[some] << 5 | e[some]
                if key is not None:
                    out = self.struck(key[row[some]], _PLACES[candidate])
                else:
                    out = (gone[row[some]] == candidate[:, None]).any(1)
                new[some[out]] = _NEVER
            ranks[base + a] = new

        r, c = np.nonzero(columns < width[:, None] - 1)
        put(r, c, c + 1, c + 2)
        live = np.arange(rows)
        while len(live):
            a = rank[live].argmin(1)
            best = ranks[live * w + a]
            go = best != _NEVER
            if not go.all():
                live, a, best = live[go], a[go], best[go]
                if not len(live):
                    break
            base = live * w
            b = afters[base + a]
            e = afters[base + b]
            if key is None:
                taken[live, steps[live]] = a << 10 | b << 5 | e
                steps[live] += 1
            symbols[base + a] = self.result[best]
            symbols[base + b] = -2
            ranks[base + a] = _NEVER
            ranks[base + b] = _NEVER
            afters[base + a] = e
            befores[base + e] = a  # behind the last character no one looks
            left, right = np.flatnonzero(a > 0), np.flatnonzero(e < width[live])
            x, y = befores[base[left] + a[left]], afters[base[right] + e[right]]
            put(np.concatenate((live[left], live[right])), np.concatenate((x, a[right])), np.concatenate((a[left], e[right])), np.concatenate((e[left], y)))
        held = symbol != -2
        sizes = held.sum(1)
        odd = np.flatnonzero((symbol == -1).any(1))
        if not len(odd):
            return taken, steps, symbol[held], sizes
        # characters without a piece are written as their bytes
        ids, ends = symbol[held].tolist(), np.cumsum(sizes).tolist()
        out: list[list[int]] = []
        done = 0
        for i in odd.tolist():
            at = np.flatnonzero(held[i]).tolist()
            own = ids[ends[i] - len(at) : ends[i]]
            own = list(chain.from_iterable([x] if x >= 0 else self.bytes_of(words[i][p - 1]) for x, p in zip(own, at)))
            out += [ids[done : ends[i] - len(at)], own]
            done, sizes[i] = ends[i], len(own)
        return taken, steps, np.array(list(chain.from_iterable([*out, ids[done:]])), np.int32), sizes

    def struck(self, key: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether the candidate at a place is dropped for the occurrence with a key."""
        with np.errstate(over="ignore"):
            return (_mix(key + place) >> np.uint64(11)) < np.uint64(int(self.dropout * (1 << 53)))

    def struck_one(self, key: int, place: int) -> bool:
        x = key + place & _FULL
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _FULL
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _FULL
        return (x ^ (x >> 31)) >> 11 < int(self.dropout * (1 << 53))

    def agenda(self, word: str, key: int) -> list[int]:
        """The ids of one occurrence of a word, by a heap of candidate merges."""
        n = len(word)
        symbol = self.symbol_of[list(map(ord, word))].tolist()
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[int, int, int, int]] = []

        def add(a: int) -> None:
            b = after[a]
            if b >= 0 and symbol[a] >= 0 and symbol[b] >= 0:
                rank = self.rank.get(symbol[a] * self.size + symbol[b])
                if rank is not None:
                    heapq.heappush(heap, (rank, a, b, end[b]))

        for i in range(n):
            add(i)
        while heap:
            rank, a, b, e = heapq.heappop(heap)
            if symbol[a] == -2 or symbol[b] == -2 or after[a] != b or end[b] != e or end[a] != b:
                continue  # one side has grown since
            if self.rank.get(symbol[a] * self.size + symbol[b]) != rank or self.struck_one(key, _place(a, b, e)):
                continue
            symbol[a], symbol[b], end[a], after[a] = self.of_rank[rank], -2, e, after[b]
            if after[a] >= 0:
                before[after[a]] = a
            add(a)
            if before[a] >= 0:
                add(before[a])
        ids: list[int] = []
        for i, s in enumerate(symbol):
            if s >= 0:
                ids.append(s)
            elif s == -1:  # a character without a piece: its bytes
                ids += self.bytes_of(word[i])
        return ids

    def add_words(self, words: list[str]) -> np.ndarray:
        """The courses of new words without any struck merge."""
        c, n = self.courses, len(words)
        at = len(c.words) + np.arange(n)
        c.words += words
        c.length.extend(np.fromiter(map(len, words), np.int8, n))
        return self.add_courses(at, np.zeros((n, 0), np.int16), np.zeros(n, np.int64), np.full(n, -1))

    def add_struck(self, merges: np.ndarray) -> np.ndarray:
        """The courses after each of some merges is struck."""
        c = self.courses
        parent = np.searchsorted(c.begin.data[: c.begin.n], merges, "right") - 1
        gone, merge, course = [], merges, parent
        while (merge >= 0).any():
            gone.append(np.where(merge >= 0, c.candidate.data[merge], 0))
            merge = np.where(merge >= 0, c.up.data[course], -1)
            course = np.searchsorted(c.begin.data[: c.begin.n], merge, "right") - 1
        return self.add_courses(c.word.data[parent], np.stack(gone, 1), c.skip.data[parent] + merges - c.begin.data[parent], merges)

    def add_courses(self, word: np.ndarray, gone: np.ndarray, skips: np.ndarray, up: np.ndarray) -> np.ndarray:
        """Courses of words (their numbers) from their struck merges, the number of
        merges at the start that stand in earlier courses, and the merge struck last."""
        c = self.courses
        number = np.zeros(len(word), np.int64)
        for most, at in _by_length(c.length.data[word]):
            words, skip = [c.words[i] for i in word[at].tolist()], skips[at]
            taken, steps, ids, sizes = self.many(words, most, gone=gone[at])
            number[at] = np.arange(c.word.n, c.word.n + len(at))
            c.word.extend(word[at])
            c.up.extend(up[at])
            c.skip.extend(skip)
            c.begin.extend(c.candidate.n + np.cumsum(steps - skip) - (steps - skip))
            c.size.extend(steps - skip)
            order = np.arange(taken.shape[1])
            c.candidate.extend(taken[(order >= skip[:, None]) & (order < steps[:, None])])
            c.child.extend(np.full(int((steps - skip).sum()), -1))
            c.out_begin.extend(c.out.n + np.cumsum(sizes) - sizes)
            c.out_size.extend(sizes)
            c.out.extend(ids)
        return number

    def cut(self, words: list[str], key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of some occurrences, each with its own draws; where each one's begin, and their number."""
        outs, n = [np.zeros(0, np.int32)], 0
        begin, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for most, at in _by_length(np.fromiter(map(len, words), np.int64, len(words))):
            _, _, ids, sizes = self.many([words[i] for i in at.tolist()], most, key=key[at])
            begin[at], size[at] = n + np.cumsum(sizes) - sizes, sizes
            outs.append(ids)
            n += len(ids)
        return np.concatenate(outs), begin, size

    def bytes_of(self, char: str) -> list[int]:
        return self.byte[list(char.encode("utf-8", "surrogatepass"))].tolist()

    def follow(self, course: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The course on which each occurrence ends; -1 stays, or where it needs one that was never needed before."""
        if not self.dropout:
            return course
        c, course = self.courses, course.copy()
        live = np.flatnonzero(course >= 0)
        while len(live):
            merges, going = [], []
            for lo in range(0, len(live), DRAWN):
                some = live[lo : lo + DRAWN]
                v = course[some]
                size = c.size.data[v].astype(np.int64)
                ends = np.cumsum(size)
                at = np.arange(ends[-1]) - np.repeat(ends - size - c.begin.data[v], size)
                hit = np.flatnonzero(self.struck(np.repeat(key[some], size), _PLACES[c.candidate.data[at]]))
                own = np.searchsorted(ends, hit, "right")
                first = np.ones(len(hit), bool)
                first[1:] = own[1:] != own[:-1]
                merges.append(at[hit[first]])
                going.append(some[own[first]])
            merge, live = np.concatenate(merges), np.concatenate(going)
            unknown, times = np.unique(merge[c.child.data[merge] < 0], return_counts=True)
            again = (times > 1) | (c.child.data[unknown] == -2)
            c.child.data[unknown[~again]] = -2
            if again.any():
                c.child.data[unknown[again]] = self.add_struck(unknown[again])
            after = c.child.data[merge]
            course[live] = np.maximum(after, -1)
            live = live[after >= 0]
        return course

    def encode(self, texts: list[str], doc_ids: list[int | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text begins (with the end of the last)."""
        if self.courses.word.n > KEPT:
            self.courses = Courses()
        # words begin with blanks, the first of which is left out here
        cuts = [(t.split(" ") if "  " not in t and t[0] != " " else [w[1:] for w in WORD.findall(" " + t)]) if t else [] for t in texts]
        counts = np.array([len(cut) for cut in cuts], np.int64)
        words = list(chain.from_iterable(cuts))
        del cuts
        ends = np.cumsum(counts)
        c = self.courses
        found = np.fromiter(map(c.root.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(found < 0)
        new_words = [words[i] for i in new.tolist()]
        short = np.fromiter(map(len, new_words), np.int64, len(new)) < SHARED
        hashes = np.fromiter(map(hash, new_words), np.int64, len(new)) & (MET - 1)
        _, of, times = np.unique(hashes, return_inverse=True, return_counts=True)
        again = np.flatnonzero(short & ((times[of] > 1) | c.met[hashes]))
        c.met[hashes] = True
        if len(again):
            kept = sorted({new_words[i] for i in again.tolist()})
            c.root.update(zip(kept, self.add_words(kept).tolist()))
            found[new[again]] = [c.root[new_words[i]] for i in again.tolist()]
        place = np.arange(len(words)) - np.repeat(ends - counts, counts)
        salt = np.array([_key(self.seed, "document", i) for i in doc_ids], np.uint64)
        with np.errstate(over="ignore"):
            key = _mix(np.repeat(salt, counts) + place.astype(np.uint64) * np.uint64(_GOLDEN))
        course = self.follow(found, key)
        begin, size = c.out_begin.data[course].astype(np.int64), c.out_size.data[course].astype(np.int64)
        alone = np.flatnonzero(course < 0)
        own = [words[i] for i in alone.tolist()]
        short = np.fromiter(map(len, own), np.int64, len(own)) < SHARED
        some = alone[short]
        ids, at, sizes = self.cut([w for w in own if len(w) < SHARED], key[some])
        begin[some], size[some] = c.out.n + at, sizes
        some = alone[~short]
        long = [self.agenda(" " + words[i], int(key[i])) for i in some.tolist()]
        size[some] = [len(x) for x in long]
        begin[some] = c.out.n + len(ids) + np.cumsum(size[some]) - size[some]
        out = np.concatenate((c.out.data[: c.out.n], ids, np.array(list(chain.from_iterable(long)), np.int32)))
        to = np.concatenate(([0], np.cumsum(size)))
        ids = out[np.arange(to[-1]) - np.repeat(to[:-1] - begin, size)]
        return ids.astype("<i4"), to[np.concatenate(([0], ends))]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of ids[bounds[i]:bounds[i+1]]."""
        bytes_of = self.raw.take(pa.array(ids, pa.int32()))
        offsets, data = (np.frombuffer(bytes_of.buffers()[1], np.int64) if len(ids) else np.zeros(1, np.int64)), bytes_of.buffers()[2]
        data = memoryview(data) if data is not None else memoryview(b"")
        at = offsets[bounds].tolist()
        return [str(data[a:b], "utf-8", "surrogatepass")[1:] for a, b in zip(at, at[1:])]


def _by_length(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Words (their numbers) that are cut together, from their lengths without the blank, and the
    number of characters that the longest may have with it."""
    group = np.searchsorted(LENGTHS, lengths + 1)
    for i in np.unique(group).tolist():
        of_length = np.flatnonzero(group == i)
        for lo in range(0, len(of_length), 10_000):
            yield LENGTHS[i], of_length[lo : lo + 10_000]


_models: dict[tuple, Pieces] = {}


def model(path: str, seed: int, dropout: float) -> Pieces:
    """The model of this Python worker with the courses it has found so far."""
    key = (path, seed, dropout)
    if key not in _models:
        _models.clear()
        _models[key] = Pieces(*key)
    return _models[key]


def _portions(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Neighbouring texts of about ``AT_A_TIME`` bytes together; a longer text alone."""
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > AT_A_TIME:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


def encode_pieces(docs: DataFrame, path: str, seed: int = 0, dropout: float = DROPOUT, with_ids: bool = True) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (ids as little-endian 32-bit integers), lossless (the
    pieces decode to the text), and piece_ids if asked for; a row for each document.

    A null text is encoded as an empty one, which has no pieces. Equal ids and texts have
    equal pieces (null ids count as equal); other columns are not read. A text without blanks is
    one word. A projection: nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path, seed, dropout)
        for batch in batches:
            for lo, hi in _portions(pc.binary_length(batch.column(1)).to_pylist()):
                texts, doc_ids = batch.column(1).slice(lo, hi - lo).to_pylist(), batch.column(0).slice(lo, hi - lo)
                ids, bounds = m.encode(texts, doc_ids.to_pylist())
                at = bounds.tolist()
                arrays = [
                    doc_ids, pa.array(np.diff(bounds)), pa.array([zlib.crc32(ids[a:b]) for a, b in zip(at, at[1:])], pa.int64()),
                    pa.array([x == t for x, t in zip(m.decode(ids, bounds), texts)], pa.bool_()),
                ]
                if with_ids:
                    arrays.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_pieces", "ids_crc32", "lossless", "piece_ids"][: len(arrays)])

    return rows.mapInArrow(encode, "doc_id long, n_pieces long, ids_crc32 long, lossless boolean" + ", piece_ids array<int>" * with_ids)


def decode_pieces(coded: DataFrame, path: str) -> DataFrame:
    """doc_id, text of documents given as doc_id, piece_ids; null ids decode to an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path, 0, 0.0)
        for batch in batches:
            lists = [np.array(x or [], "<i4") for x in batch.column(1).to_pylist()]
            bounds = np.cumsum([0, *map(len, lists)])
            texts = m.decode(np.concatenate([np.zeros(0, "<i4"), *lists]), bounds)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("piece_ids").cast("array<int>").alias("piece_ids")).mapInArrow(decode, "doc_id long, text string")

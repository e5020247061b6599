"""SentencePiece encoding and decoding with a batched numpy Viterbi.

Texts are cut into units (white space and what follows it up to the next), and a unit
further where no piece spans; the distinct strings of a batch are solved once each.
Substring hashes probe the sorted piece keys, strings of equal length advance together, and
a vectorised maximum over the pieces that end at a place stores its backpointer.

The public model file is a merge (BPE) model, whose scores are merge ranks, not
log-probabilities. Its right segmentation is the one path whose neighbouring pieces can stand
side by side: no merge across their border would come before the merges that made them. So the
lattice admits an edge only if it fits the best edge before it; exactly one then remains at
each place, and the ids equal the library's.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import gathered_runs, mix, pa_schema, remembered, slices, small_batches, trim, utf8

SPACE = "▁"
#: Code points of distinct strings solved at once.
BLOCK = 1 << 17
#: Bytes of text encoded at once.
CHARS = 2 << 20
#: Encoded units that a worker remembers at most between slices, and the bytes of a unit that it remembers.
CACHE, UNIT = 400_000, 256
#: Longer strings that no place cuts are merged plainly: a step a place is too slow for one string alone.
LONG = 256
#: Places for remembered pairs of pieces, as a power of two.
MEMO = 20
_B = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Pieces:
    """A vocabulary: pieces and scores by id, the byte pieces, the unknown id and the dummy-prefix flag."""

    pieces: list[str]
    scores: list[float]
    bytes_: dict[int, int]
    unknown: int
    special: frozenset[int]
    prefix: bool = True

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(sp.vocab_size())
        names = [sp.id_to_piece(i) for i in n]
        raw = {i: int(names[i][3:5], 16) for i in n if sp.is_byte(i)}
        special = frozenset(i for i in n if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
        return cls(names, [sp.get_score(i) for i in n], raw, sp.unk_id(), special)

    @cached_property
    def usable(self) -> list[int]:
        return [i for i in range(len(self.pieces)) if i not in self.special and i not in self.bytes_ and self.pieces[i]]

    @cached_property
    def table(self) -> Table:
        return Table([self.pieces[i] for i in self.usable], self.usable, [self.scores[i] for i in self.usable])

    @cached_property
    def byte_ids(self) -> dict[int, int]:
        return {b: i for i, b in self.bytes_.items()}


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _raw_hash(piece: str) -> np.uint64:
    total = np.zeros(1, np.uint64)
    for c in _codes(piece):
        total = total * _B + mix(np.array([c + np.uint64(1)]))
    return total[0]


def merge(text: str, rank: dict[str, int]) -> list[str]:
    """Plain merging: the best-ranked neighbours first, the leftmost of equals."""
    parts: list[str | None] = list(text)
    left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
    queue = [(rank[a + b], i, a + b) for i, (a, b) in enumerate(pairwise(text)) if a + b in rank]
    heapq.heapify(queue)
    while queue:
        _, i, made = heapq.heappop(queue)
        j = right[i]
        if parts[i] is None or j >= len(parts) or parts[i] + parts[j] != made:
            continue
        parts[i], parts[j] = made, None
        right[i] = right[j]
        if right[i] < len(parts):
            left[right[i]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b < len(parts) and (both := parts[a] + parts[b]) in rank:
                heapq.heappush(queue, (rank[both], a, both))
    return [p for p in parts if p is not None]


class Table:
    """Pieces sorted by the hash of their characters, with ranks and the halves each was last merged from."""

    def __init__(self, pieces: list[str], ids: list[int], scores: list[float]):
        raw = np.array([_raw_hash(p) for p in pieces], np.uint64)
        size = np.array([len(p) for p in pieces], np.int64)
        keys = mix(raw + size.astype(np.uint64)) if len(pieces) else raw
        order = np.argsort(keys)
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces have one key")
        self.keys, self.raw, self.size, self.ids = keys[order], raw[order], size[order], np.array(ids, np.int64)[order]
        self.maybe = np.zeros(1 << 21, bool)
        self.maybe[(self.keys >> np.uint64(43)).astype(np.int64)] = True
        self.longest = int(size.max()) if len(size) else 1
        place = {pieces[j]: i for i, j in enumerate(order)}
        # Equal scores share a rank.
        levels = {s: r for r, s in enumerate(sorted(set(scores), reverse=True), 1)}
        self.ranks = {p: levels[s] for p, s in zip(pieces, scores, strict=True) if len(p) > 1}
        self.rank = np.array([self.ranks.get(pieces[j], 0) for j in order], np.int64)
        self.left, self.right = np.full(len(order), -1), np.full(len(order), -1)
        self.valid = np.zeros(len(order), bool)
        for piece, i in place.items():
            if len(piece) == 1:
                self.valid[i] = True
                continue
            halves = merge(piece, {k: r for k, r in _within(piece, self.ranks) if k != piece})
            if len(halves) == 2 and all(h in place for h in halves) and set(piece) != {SPACE}:
                self.left[i], self.right[i] = place[halves[0]], place[halves[1]]
                self.valid[i] = True
        self.memo: tuple[np.ndarray, np.ndarray] | None = None
        self.periods: dict[str, tuple[int, dict[int, list[str]]]] = {}
        self.powers = np.full(self.longest + 1, _B, np.uint64)
        self.powers[0] = 1
        self.powers = np.cumprod(self.powers)

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys in the table, or -1; the top bits rule out most keys first."""
        out = np.full(len(keys), -1)
        some = np.flatnonzero(self.maybe[(keys >> np.uint64(43)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, keys[some]), len(self.keys) - 1)
        hit = self.keys[at] == keys[some] if len(some) else np.zeros(0, bool)
        out[some[hit]] = at[hit]
        return out

    def key(self, pieces: list[str]) -> np.ndarray:
        known = {p: mix(np.array([_raw_hash(p) + np.uint64(len(p))]))[0] for p in set(pieces)}
        return np.array([known[p] for p in pieces], np.uint64)

    def merged(self, string: str) -> list[str]:
        """The string's pieces by plain merging; a run of one character by its period, once that is seen to hold."""
        if string.strip(string[0]):
            return merge(string, self.ranks)
        if (c := string[0]) not in self.periods:
            most = max(len(p) for p in merge(c * LONG, self.ranks))
            rest = {n: merge(c * n, self.ranks) for n in range(2 * most, 4 * most)}
            self.periods[c] = (most, rest) if all(rest[n] == [c * most, *rest[n - most]] for n in range(3 * most, 4 * most)) else (0, {})
        most, rest = self.periods[c]
        if not most or len(string) < 4 * most:
            return merge(string, self.ranks)
        times = len(string) // most - 2
        return [c * most] * times + rest[len(string) - times * most]

    def stay(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``compatible``, remembered in a table of fixed size where each pair has one place."""
        if self.memo is None:
            self.memo = np.full(1 << MEMO, -1, np.int64), np.zeros(1 << MEMO, bool)
        keys, oks = self.memo
        pair = a << 32 | b
        place = (mix(pair.astype(np.uint64)) >> np.uint64(64 - MEMO)).astype(np.int64)
        ok, new = oks[place], np.flatnonzero(keys[place] != pair)
        if len(new):
            pairs, where = np.unique(pair[new], return_inverse=True)
            fits = self.compatible(pairs >> 32, pairs & 0xFFFFFFFF)
            ok[new] = fits[where]
            keys[place[new]], oks[place[new]] = pair[new], ok[new]
        return ok

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a and b stay apart side by side.

        Both are taken apart along their border, the later merge first; they don't stay apart if two
        parts that stand there at one time would merge before the merges that took them away.
        """
        ok, live = np.ones(len(a), bool), np.arange(len(a))
        never = np.iinfo(np.int64).max
        x, y, after_x, after_y = a, b, np.full(len(a), never), np.full(len(b), never)
        while len(live):
            at = self.probe(mix(self.raw[x] * self.powers[self.size[y]] + self.raw[y] + (self.size[x] + self.size[y]).astype(np.uint64)))
            across = np.where(at >= 0, self.rank[at], never)
            bad = (across < after_x) & (across <= after_y) & (at >= 0)
            ok[live[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            down = rx > ry
            go = ~bad & ((rx > 0) | (ry > 0))
            after_x, after_y = np.where(down, rx, after_x)[go], np.where(down, after_y, ry)[go]
            x, y, live = np.where(down, self.right[x], x)[go], np.where(down, y, self.left[y])[go], live[go]
        return ok


def _within(piece: str, ranks: dict[str, int]):
    for i in range(len(piece)):
        for j in range(i + 2, len(piece) + 1):
            if (part := piece[i:j]) in ranks:
                yield part, ranks[part]


def segment(strings: list[str], table: Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the strings' pieces end to end, and where each string's begin; a character without a piece gives -1 less its code point.

    A string longer than BLOCK is looked at in windows, so that memory doesn't grow with it.
    """
    if any(len(s) > BLOCK for s in strings):
        parts = [_windowed(s, table) if len(s) > BLOCK else segment([s], table)[0] for s in strings]
        return np.concatenate([np.zeros(0, np.int64), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    text = "".join(strings)
    codes = _codes(text)
    total = len(codes)
    if not total:
        return np.zeros(0, np.int64), np.zeros(len(strings) + 1, np.int64)
    found, cut = _lattice(codes, starts, lengths, table)
    sizes = np.diff(np.append(cut, total))
    best, back = np.full(total, -1, np.int64), np.ones(total, np.int64)
    for size in np.unique(sizes[sizes <= LONG]).tolist():
        first, step = cut[sizes == size], max(1, BLOCK // size)
        for lo in range(0, len(first), step):
            _advance(first[lo : lo + step], size, found, table, best, back)
    for lo, size in zip(cut[sizes > LONG].tolist(), sizes[sizes > LONG].tolist(), strict=True):
        pieces = table.merged(text[lo : lo + size])
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = lo + np.cumsum(n) - 1
        best[ends], back[ends] = table.probe(table.key(pieces)), n
    # All strings walk back at once, a piece a step; what was merged or stands alone has its ends marked already.
    last = _walk(back, cut, sizes, total)
    ids = np.where(best >= 0, table.ids[best], -1 - codes.astype(np.int64))[last[1:] > 0]
    return ids, np.cumsum(last)[starts]


def _lattice(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, table: Table) -> tuple[list[np.ndarray], np.ndarray]:
    """By length less one, the pieces that begin at each place; and the places that no piece spans, where strings of one length are many and long ones few."""
    total, edge = len(codes), np.repeat(starts[1:], lengths)
    found, spanned = [], np.zeros(total + 1, np.int64)
    each = mix(codes + np.uint64(1))
    rolling = np.zeros(total, np.uint64)
    for n in range(1, min(table.longest, int(lengths.max())) + 1):
        rolling = rolling[: total - n + 1] * _B + each[n - 1 :]
        at = table.probe(mix(rolling + np.uint64(n)))
        inside = (at >= 0) & (np.arange(len(at)) + n <= edge[: len(at)]) & table.valid[at]
        found.append(np.where(inside, at, -1))
        if n > 1:
            begin = np.flatnonzero(inside)
            np.add.at(spanned, begin + 1, 1)
            np.add.at(spanned, begin + n, -1)
    return found, np.union1d(np.flatnonzero(np.cumsum(spanned)[:total] == 0), starts[:-1][lengths > 0])


def _walk(back: np.ndarray, cut: np.ndarray, sizes: np.ndarray, total: int) -> np.ndarray:
    """1 after each place where a piece ends."""
    last, at, begin = np.zeros(total + 1, np.int64), cut + sizes - 1, cut
    while len(at):
        last[at + 1] = 1
        at = at - back[at]
        go = at >= begin
        at, begin = at[go], begin[go]
    return last


def _windowed(string: str, table: Table) -> np.ndarray:
    """The same of one long string: cut, in windows that overlap by the longest piece, where no piece spans, and solved in strings between cuts."""
    cuts, reach = [0], table.longest
    for lo in range(0, len(string), BLOCK):
        a, b = max(0, lo - reach), min(len(string), lo + BLOCK + reach)
        _, cut = _lattice(_codes(string[a:b]), np.array([0, b - a]), np.array([b - a]), table)
        cut = cut + a
        cuts += cut[(cut >= max(lo, 1)) & (cut < lo + BLOCK)].tolist()
    out, held, size = [], [], 0
    for a, b in zip(cuts, [*cuts[1:], len(string)], strict=True):
        if b - a > BLOCK:  # no cut for long: merged as it is
            out += [segment(held, table)[0], table.ids[table.probe(table.key(table.merged(string[a:b])))]]
            held, size = [], 0
            continue
        held.append(string[a:b])
        size += b - a
        if size >= BLOCK // 2:
            out.append(segment(held, table)[0])
            held, size = [], 0
    return np.concatenate([np.zeros(0, np.int64), *out, segment(held, table)[0]])


def _advance(first: np.ndarray, size: int, found: list[np.ndarray], table: Table, best: np.ndarray, back: np.ndarray) -> None:
    """All strings of one size, from ``first``, a place at a time; the chosen piece and its length at its last place."""
    for end in range(1, size + 1):
        longest = min(end, len(found))
        score = np.full((longest, len(first)), -np.inf)
        piece = np.stack([found[n - 1][first + end - n] for n in range(1, longest + 1)])
        n, row = np.nonzero(piece >= 0)
        if end == 1:
            score[n, row] = 0
        else:
            before = np.where(n + 1 < end, best[np.maximum(first[row] + end - n - 2, 0)], -2)
            fits = before < 0  # nothing before it, or a character without a piece
            fits[~fits] = table.stay(before[~fits], piece[n, row][~fits])
            # A place that no path reaches can't be built on.
            fits &= (n + 1 == end) | (back[np.maximum(first[row] + end - n - 2, 0)] > 0)
            score[n[fits], row[fits]] = n[fits]
        pick = np.argmax(score, 0)
        at, column = first + end - 1, np.arange(len(first))
        reached = score[pick, column] > -np.inf
        bare = (piece < 0).all(0)
        best[at] = np.where(reached, piece[pick, column], -1)
        back[at] = np.where(reached, pick + 1, np.where(bare | (piece[0] < 0), 1, 0))


def units(text: str, prefix: bool = True) -> list[str]:
    """A text with visible spaces, cut before each run of them."""
    shown = text.replace(" ", SPACE)
    if prefix and shown:
        shown = SPACE + shown
    out, at = [], 0
    parts = shown.split(SPACE)
    run = ""
    if parts and parts[0]:
        out.append(parts[0])
    for part in parts[1:]:
        run += SPACE
        if part:
            out.append(run + part)
            run = ""
    if run:
        out.append(run)
    return out


class Codec:
    """Encodes and decodes; remembers the units it has solved, in flat arrays: the units, their ids end to end, how many
    ids each has, and the slice that last had it."""

    def __init__(self, vocabulary: Pieces):
        self.vocabulary, self.runs, self.turn = vocabulary, {0: []}, 0
        self.units, self.ids = pa.array([], pa.large_string()), np.zeros(0, np.int32)
        self.sizes, self.seen = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _final(self, ids: list[int]) -> bytes:
        out, known = [], self.vocabulary.byte_ids
        for i in ids:
            if i >= 0:
                out.append(i)
            elif known:
                out += [known[b] for b in chr(-1 - i).encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.vocabulary.unknown:
                out.append(self.vocabulary.unknown)
        return np.array(out, np.int32).tobytes()

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; null and empty texts have none."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        column = pa.array([t or "" for t in texts], pa.large_string())
        # A plain word stands for itself after one space; other texts are cut with their spaces.
        odd = [pc.match_substring(column, "  "), pc.match_substring(column, SPACE), pc.starts_with(column, " "), pc.ends_with(column, " "), pc.equal(column, "")]
        odd = np.logical_or.reduce([x.to_numpy(zero_copy_only=False) for x in odd]) | (not self.vocabulary.prefix)
        if not odd.all():
            cut = pc.split_pattern(column.filter(pa.array(~odd)), " ")
            self._gather(out, np.flatnonzero(~odd), cut.values, cut.offsets.to_numpy().astype(np.int64))
        if odd.any():
            cut = [units(texts[i] or "", self.vocabulary.prefix) for i in np.flatnonzero(odd)]
            self._gather(out, np.flatnonzero(odd), pa.array([u for us in cut for u in us], pa.large_string()), np.concatenate([[0], np.cumsum([len(us) for us in cut])]).astype(np.int64))
        return out

    def _gather(self, out: list[np.ndarray], rows: np.ndarray, words: pa.Array, edges: np.ndarray) -> None:
        """Each distinct unit is solved or looked up once; the rows' ids are gathered from theirs."""
        coded = words.dictionary_encode()
        known = coded.dictionary
        entry = pc.fill_null(pc.index_in(known, value_set=self.units), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(entry < 0)
        fresh = known.take(pa.array(new))
        made = self._solved(fresh.to_pylist())
        entry[new] = len(self.units) + np.arange(len(new))
        solved, sizes = np.frombuffer(b"".join(made), np.int32), np.fromiter(map(len, made), np.int64, len(made)) // 4
        ids, at = gathered_runs(np.concatenate([self.ids, solved]), np.concatenate([self.sizes, sizes]), entry[coded.indices.to_numpy()])
        ends = at[edges].tolist()
        for row, a, b in zip(rows.tolist(), ends, ends[1:], strict=False):
            out[row] = ids[a:b]
        self.turn += 1
        self.seen[entry[entry < len(self.seen)]] = self.turn
        self._remember(fresh, solved, sizes)

    def _remember(self, fresh: pa.Array, solved: np.ndarray, sizes: np.ndarray) -> None:
        """Add solved units but for long ones; beyond CACHE the half that was seen last stays."""
        short = np.flatnonzero(pc.binary_length(fresh).to_numpy() <= UNIT)
        if len(short) < len(fresh):
            fresh, (solved, _), sizes = fresh.take(pa.array(short)), gathered_runs(solved, sizes, short), sizes[short]
        units, ids = pa.concat_arrays([self.units, fresh]), np.concatenate([self.ids, solved])
        sizes, seen = np.concatenate([self.sizes, sizes]), np.concatenate([self.seen, np.full(len(sizes), self.turn)])
        if len(units) > CACHE:
            keep = np.sort(np.argsort(-seen, kind="stable")[: CACHE // 2])
            units, (ids, _), sizes, seen = units.take(pa.array(keep)), gathered_runs(ids, sizes, keep), sizes[keep], seen[keep]
        self.units, self.ids, self.sizes, self.seen = units, ids, sizes, seen

    def _solved(self, new: list[str]) -> list[bytes]:
        """The ids of each of the strings, BLOCK code points of strings at a time."""
        out, lo, size = [], 0, 0
        for hi, u in enumerate(new, 1):
            size += len(u) + 1
            if size > BLOCK or hi == len(new):
                out += self._solve(new[lo:hi])
                lo, size = hi, 0
        return out

    def _solve(self, new: list[str]) -> list[bytes]:
        table, made, plain = self.vocabulary.table, {}, [u for u in new if u[:2] != SPACE * 2]
        ids, at = segment([u if u[:1] == SPACE or not self.vocabulary.prefix else SPACE + u for u in plain], table)
        data, edges = ids.astype(np.int32).tobytes(), (4 * at).tolist()
        for u, a, b in zip(plain, edges, edges[1:], strict=False):
            made[u] = data[a:b]
        # Strings with characters that have no piece.
        for i in np.unique(np.searchsorted(at, np.flatnonzero(ids < 0), "right") - 1).tolist():
            made[plain[i]] = self._final(ids[at[i] : at[i + 1]].tolist())
        # Spaces come last in the ranks: what follows takes the last of a run if it can, the rest merge among themselves.
        runs = [u for u in new if u[:2] == SPACE * 2]
        words = [u.lstrip(SPACE) for u in runs]
        ids, at = segment([SPACE + w if w else "" for w in words], table)
        for i, (unit, word) in enumerate(zip(runs, words, strict=True)):
            own, run = ids[at[i] : at[i + 1]].tolist(), len(unit) - len(word) - (word != "")
            if own and own[0] == self._space_id():
                run, own = run + 1, own[1:]
            made[unit] = self._final([*self._run(run), *own])
        return [made[u] for u in new]

    def _space_id(self) -> int:
        at = int(self.vocabulary.table.probe(mix(np.array([_raw_hash(SPACE) + np.uint64(1)])))[0])
        return int(self.vocabulary.table.ids[at]) if at >= 0 else -1 - ord(SPACE)

    def _run(self, n: int) -> list[int]:
        if n not in self.runs:
            if len(self.runs) > UNIT:
                self.runs = {0: []}
            table = self.vocabulary.table
            spaces = {k: r for k, r in table.ranks.items() if set(k) == {SPACE}}
            at = table.probe(np.array([mix(np.array([_raw_hash(p) + np.uint64(len(p))]))[0] for p in merge(SPACE * n, spaces)], np.uint64))
            self.runs[n] = np.where(at >= 0, table.ids[at], -1 - ord(SPACE)).tolist()
        return self.runs[n]

    def decode(self, rows: list[np.ndarray]) -> list[str]:
        """Texts of id rows: byte pieces are joined as UTF-8, the dummy prefix goes."""
        name, out = self.names.__getitem__, []
        for ids in rows:
            text = b"".join(map(name, ids.tolist())).decode("utf-8", "surrogatepass").replace(SPACE, " ")
            out.append(text[1:] if self.vocabulary.prefix and text.startswith(" ") else text)
        return out

    @cached_property
    def names(self) -> list[bytes]:
        return [self._raw(i) for i in range(len(self.vocabulary.pieces))]

    def _raw(self, i: int) -> bytes:
        if i in self.vocabulary.bytes_:
            return bytes([self.vocabulary.bytes_[i]])
        return b"" if i in self.vocabulary.special else self.vocabulary.pieces[i].encode()


def encode(spark: SparkSession, docs: DataFrame, path: str, decode: bool = False) -> DataFrame:
    """doc_id, ids, n_tokens and restored (whether decoding gives the text back) for every row of ``docs`` (doc_id, text); ``decode`` adds decoded.

    ``path`` is the model file. Null texts count as empty and have no ids; repeated rows get equal ids.
    Decoding restores the text but for U+2581, which comes back as a space. An empty table gives none.
    """
    out = "doc_id long, ids array<int>, n_tokens long, restored boolean" + ", decoded string" * decode

    def columns(texts, ids, back):
        found = {"ids": ids, "n_tokens": [len(x) for x in ids], "restored": [_same(a, b) for a, b in zip(texts, back, strict=True)]}
        return found | ({"decoded": back} if decode else {})

    return _coded(spark, docs, path, out, columns)


def digest(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (little-endian uint32 ids) and restored of every row."""

    def columns(texts, ids, back):
        crc = [zlib.crc32(x.astype("<u4").tobytes()) for x in ids]
        return {"n_tokens": [len(x) for x in ids], "ids_crc32": crc, "restored": [_same(a, b) for a, b in zip(texts, back, strict=True)]}

    return _coded(spark, docs, path, "doc_id long, n_tokens long, ids_crc32 long, restored boolean", columns)


def _same(text: str, decoded: str) -> bool:
    return text.replace(SPACE, " ") == decoded


def _coded(spark: SparkSession, docs: DataFrame, path: str, ddl: str, columns) -> DataFrame:
    vocabulary = Pieces.load(path)
    vocabulary.table  # built once, here
    sent, kind = spark.sparkContext.broadcast(vocabulary), pa_schema(spark, ddl)
    small_batches(spark)

    def each(batches):
        codec = remembered(("codec", path), lambda: Codec(sent.value))

        def coded(part):
            texts = [t or "" for t in part.column("text").to_pylist()]
            ids = codec.encode(texts)
            return pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **columns(texts, ids, codec.decode(ids))}, schema=kind)

        for batch in batches:
            for lo, hi in slices(utf8(batch.column("text"))[0], CHARS):
                yield coded(batch.slice(lo, hi - lo))
                trim()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(each, ddl)

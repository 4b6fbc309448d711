"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

A text becomes units: a run of blanks with the word behind it, or a single character that no longer
piece holds. Pieces never reach from one unit into the next, so units are segmented on their own.
In a unit an agenda holds the adjacent pairs whose join is a piece; the best score goes first, the
leftmost of equals before others, and each candidate merge is skipped for good when its keyed hash
(seed, document, place of the unit in the text, place in the unit, both pieces) falls below the
dropout rate. So every occurrence of a unit draws its own skips, and repeats exactly for the same
seed. Rate 0 gives the library's own encoding.

Units are segmented once without dropout. An occurrence that skips none of the merges made there has
that segmentation, as skipping a pair that is never merged changes nothing. Others are parted by the
first merge they skip: those with the same one share the agenda without it, where they draw the merges
that follow, and so on. Occurrences that share their skips with too few run an agenda of their own.

Characters that are not in the vocabulary become byte pieces, and so does a literal U+2581, which
would otherwise read as a blank: decoding gives back every text.

Defined cases: a null text counts as empty and has no pieces; a null doc_id draws the skips of
id 0; a very long text is segmented whole; repeated rows get equal pieces; an empty table gives no
rows; other columns stay as they are.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructType

from tidemark.llm.common import whole

BLANK = "▁"
CHUNK = 8_000_000
"""Characters that a task segments at once."""
WIDE = 32
"""Longer units are segmented one by one, with a heap. At most 256."""
ROWS = 5_000
"""Units whose agendas run side by side."""
DRAWN = 20_000
"""Occurrences whose skips are drawn at once."""
LETTER, SPACE, OTHER = range(3)
"""Kinds of characters: held by longer pieces, the blank, and those that are units on their own."""
NONE = np.iinfo(np.int32).max
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number: the finalizer of splitmix64."""
    with np.errstate(over="ignore"):
        x = x + _MIX[0]
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


class Units(NamedTuple):
    """Distinct units: their code points in one array, and where each starts in it and how long it is."""

    points: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray


class Segmenter:
    """The tables of one model, and the agenda over them."""

    def __init__(self, model: str, rate: float, seed: int, shared: int = 2):
        """Occurrences of a unit share an agenda if at least ``shared`` of them skip the same merges."""
        library = sentencepiece.SentencePieceProcessor(model_file=model)
        n = library.get_piece_size()
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in range(n)]
        self.rate, self.seed, self.shared = rate, seed, shared
        ids = {library.id_to_piece(i): i for i in range(n) if not special[i]}
        byte_ids = {int(library.id_to_piece(i)[3:5], 16): i for i in range(n) if library.is_byte(i)}
        self.bytes_of = [b""] * n
        for piece, i in ids.items():
            self.bytes_of[i] = piece.replace(BLANK, " ").encode()
        for value, i in byte_ids.items():
            self.bytes_of[i] = bytes([value])
        self.spelt = pa.array(self.bytes_of, pa.binary())
        self.char_bytes = lambda c: [byte_ids[b] for b in c.encode()]
        longer = [p for p in ids if len(p) > 1]
        inside = set("".join(longer))
        if lost := sorted(c for c in inside if c not in ids):
            raise ValueError(f"characters of longer pieces must be pieces themselves: {lost[:5]}")
        self.symbol_of = np.full(0x110000, -1, np.int64)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        ranks = {s: r for r, s in enumerate(sorted({library.get_score(i) for i in ids.values()}, reverse=True))}
        joins = sorted(
            (ids[p[:k]] << 20 | ids[p[k:]], ids[p], ranks[library.get_score(ids[p])])
            for p in longer for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids
        )
        keys, joined, ranks = zip(*joins)
        # The last entry stands for pairs whose join is no piece.
        self.keys, self.joined = np.array([*keys, -1 << 62], np.int64), np.array([*joined, -1], np.int32)
        self.ranks = np.array([*ranks, NONE], np.int32)
        self.shift = np.uint64(64 - (16 * len(keys)).bit_length())
        self.slots = np.full(1 << (16 * len(keys)).bit_length(), len(keys), np.int32)
        self.slots[self.slot(self.keys[:-1])] = np.arange(len(keys))
        self.kind = np.full(0x110000, OTHER, np.uint8)
        self.kind[[ord(c) for c in inside]] = LETTER
        # In texts the blank has the symbol of U+2581, and a literal U+2581 has none.
        self.symbol_of[ord(" ")], self.symbol_of[ord(BLANK)] = self.symbol_of[ord(BLANK)], -1
        self.kind[ord(" ")], self.kind[ord(BLANK)] = SPACE, OTHER

    def split(self, texts: list[str]) -> tuple[Units, np.ndarray, np.ndarray]:
        """The distinct units of the texts, the number of the unit at each occurrence, and the offsets of the texts in these."""
        points = np.frombuffer("".join([" " + t for t in texts if t]).encode("utf-32-le"), "<u4")
        sizes = np.fromiter((len(t) + 1 if t else 0 for t in texts), np.int64, len(texts))
        kind = self.kind[points]
        opens = kind == OTHER
        opens[1:] |= opens[:-1] | (kind[1:] == SPACE) & (kind[:-1] != SPACE)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        opens[upto[:-1][sizes > 0]] = True
        at = np.flatnonzero(opens)
        ends = np.append(at, len(points))
        # Units as binary values over the code points, for Arrow to number the distinct ones.
        values = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends * 4), pa.py_buffer(points)])
        numbered = values.dictionary_encode()
        _, offsets, data = numbered.dictionary.buffers()
        starts = np.frombuffer(offsets, np.int64)[: len(numbered.dictionary) + 1] // 4 if len(at) else np.zeros(1, np.int64)
        held = np.frombuffer(data, "<u4")[: starts[-1]] if len(at) else np.empty(0, "<u4")
        return Units(held, starts[:-1], np.diff(starts)), numbered.indices.to_numpy().astype(np.int64), np.searchsorted(at, upto)

    def skipped(self, key: np.ndarray, candidate: np.ndarray) -> np.ndarray:
        below = min(math.ceil(self.rate * 2.0**53), 1 << 53)
        return mixed(key ^ candidate) <= np.uint64((below << 11) - 1) if below > 0 else np.zeros(np.broadcast(key, candidate).shape, bool)

    @staticmethod
    def candidate(code: np.ndarray, start: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed(code.astype(np.uint64) + start.astype(np.uint64) * _MIX[0])

    def pairs(
        self, key: np.ndarray | None, start: np.ndarray, left: np.ndarray, right: np.ndarray, without: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """(rank, joined) of pairs; rank NONE where the pair is no piece, is skipped or is one of the merges ``without``
        (along its first axis). Without a key none is skipped."""
        code = left.astype(np.int64) << 20 | right
        at = self.find(code)
        rank, joined = self.ranks[at], self.joined[at]
        if key is not None and self.rate > 0:
            rank[self.skipped(key, self.candidate(code, start))] = NONE
        if without is not None:
            for merge in without:
                rank[code << 8 | start == merge] = NONE
        return rank, joined

    def slot(self, code: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return code.astype(np.uint64) * _MIX[0] >> self.shift

    def find(self, code: np.ndarray) -> np.ndarray:
        """Where the codes of pairs stand in the tables; codes whose slot holds another one are searched for."""
        none = len(self.keys) - 1
        at = self.slots[self.slot(code)]
        other = np.nonzero((at < none) & (self.keys[at] != code))
        found = np.searchsorted(self.keys[:-1], code[other])
        at[other] = np.where(self.keys[found] == code[other], found, none)
        return at

    def wide(self, symbols: list[int], key: np.ndarray | None) -> list[int]:
        """The agenda of one unit, as a heap over linked symbols."""
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[int, int, int, int, int]] = []

        def offer(lefts, rights):
            if lefts:
                left, right = (np.array([symbols[k] for k in x], np.int64) for x in (lefts, rights))
                rank, joined = self.pairs(key, np.array(lefts, np.int64), left, right)
                for k in np.flatnonzero(rank < NONE):
                    heapq.heappush(agenda, (int(rank[k]), lefts[k], int(left[k]), int(right[k]), int(joined[k])))

        offer(list(range(n - 1)), list(range(1, n)))
        while agenda:
            _, at, left, right, joined = heapq.heappop(agenda)
            then = after[at]
            if symbols[at] != left or then < 0 or symbols[then] != right:
                continue
            symbols[at], symbols[then] = joined, -1
            after[at] = after[then]
            if after[at] >= 0:
                before[after[at]] = at
            ends = [(a, b) for a, b in ((before[at], at), (at, after[at])) if a >= 0 and b >= 0]
            offer([a for a, _ in ends], [b for _, b in ends])
        return [s for s in symbols if s >= 0]

    def narrow(
        self, ids: np.ndarray, key: np.ndarray | None, without: np.ndarray | None = None, merges: list | None = None
    ) -> np.ndarray:
        """The agendas of many units at once: a row each, symbols from the left, -1 behind them.

        ``without`` holds merges that are not made, a column for each row. ``merges`` receives for each step
        (rows, merges made); a merge is the codes of its pieces and its place in one number.
        """
        n, width = ids.shape
        # Flat places, a row's last one without a symbol: it is what stands before the next row and behind its own.
        symbols = np.pad(ids.astype(np.int32), ((0, 0), (0, 1)), constant_values=-1)
        rank, joined = np.full(symbols.shape, NONE, np.int32), np.full(symbols.shape, -1, np.int32)
        rank[:, :-1], joined[:, :-1] = self.pairs(
            None if key is None else key[:, None], np.arange(width), symbols[:, :-1], symbols[:, 1:],
            None if without is None else without[:, :, None],
        )
        flat, ranks, joins = symbols.ravel(), rank.ravel(), joined.ravel()
        after, before = np.roll(np.arange(flat.size), -1), np.roll(np.arange(flat.size), 1)
        rows = np.arange(n)
        while True:
            at = rows * (width + 1) + rank[rows].argmin(axis=1)
            live = ranks[at] < NONE
            rows, at = rows[live], at[live]
            if not len(rows):
                return symbols
            start, then = rows * (width + 1), after[at]
            if merges is not None:
                merges.append((rows, (flat[at].astype(np.int64) << 20 | flat[then]) << 8 | at - start))
            flat[at], flat[then], ranks[then] = joins[at], -1, NONE
            after[at] = after[then]
            before[after[at]] = at
            own, less = None if key is None else key[rows], None if without is None else without[:, rows]
            for left in (at, before[at]):
                ranks[left], joins[left] = self.pairs(own, left - start, flat[left], flat[after[left]], less)

    def segment(
        self, units: Units, which: np.ndarray, keys: np.ndarray | None, without: np.ndarray | None = None, merges: list | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Piece ids of the units ``which`` under ``keys``: one array, and where each starts in it and how long it is.

        ``without`` is as in ``narrow``; ``merges`` receives (step, members, merges made). Both are for units of up to
        WIDE symbols.
        """
        starts, sizes = units.starts[which], units.sizes[which]
        symbols = self.symbol_of[units.points]
        pools, lengths = [np.empty(0, np.int32)], np.zeros(len(which), np.int64)
        begins, filled = np.zeros(len(which), np.int64), 0

        def keep(members, flat, counts):
            nonlocal filled
            pools.append(flat.astype(np.int32))
            lengths[members], begins[members] = counts, filled + np.cumsum(counts) - counts
            filled += len(flat)

        single = np.flatnonzero(sizes == 1)
        spelt = symbols[starts[single]] < 0
        keep(single[~spelt], symbols[starts[single[~spelt]]], np.ones((~spelt).sum(), np.int64))
        for k in single[spelt].tolist():
            found = self.char_bytes(chr(units.points[starts[k]]).replace(" ", BLANK))
            keep(np.array([k]), np.array(found, np.int64), np.array([len(found)]))
        before = 1
        for width in (4, 8, 12, 16, WIDE):
            members = np.flatnonzero((sizes > before) & (sizes <= width))
            before = width
            for part in np.array_split(members, len(members) // ROWS + 1):
                if not len(part):
                    continue
                inside = np.arange(width)[None, :] < sizes[part][:, None]
                ids = np.where(inside, symbols[np.minimum(starts[part][:, None] + np.arange(width), len(symbols) - 1)], -1)
                made = None if merges is None else []
                found = self.narrow(ids, None if keys is None else keys[part], None if without is None else without[:, part], made)
                if made:
                    merges += [(step, part[rows], done) for step, (rows, done) in enumerate(made)]
                real = found >= 0
                keep(part, found[real], real.sum(axis=1))
        for k in np.flatnonzero(sizes > WIDE):
            row = symbols[starts[k] : starts[k] + sizes[k]]
            found = self.wide(row.tolist(), None if keys is None else keys[k : k + 1])
            keep(np.array([k]), np.array(found, np.int64), np.array([len(found)]))
        return np.concatenate(pools), begins, lengths

    def first_skipped(self, keys: np.ndarray, first: np.ndarray, made: np.ndarray, merges: np.ndarray) -> np.ndarray:
        """Where in ``merges`` stands the first that each occurrence skips, of ``made`` from ``first`` on; -1 if none."""
        met = self.candidate(merges >> 8, merges & 255)
        out = np.full(len(keys), -1, np.int64)
        for n in np.unique(made[made > 0]).tolist():
            members = np.flatnonzero(made == n)
            for at in range(0, len(members), DRAWN):
                part = members[at : at + DRAWN]
                skips = self.skipped(keys[part][:, None], met[first[part][:, None] + np.arange(n)])
                hit = skips.any(axis=1)
                out[part[hit]] = first[part[hit]] + skips[hit].argmax(axis=1)
        return out

    def encode(self, doc_ids: list[int | None], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and the offsets of the texts in it."""
        units, which, upto = self.split(texts)
        with np.errstate(over="ignore"):
            own = mixed(np.array([(i or 0) & (1 << 64) - 1 for i in doc_ids], np.uint64) ^ mixed(np.array([self.seed], np.uint64)))
            place = np.arange(len(which)) - np.repeat(upto[:-1], np.diff(upto))
            keys = mixed(np.repeat(own, np.diff(upto)) + place.astype(np.uint64) * _MIX[2])
        pools, filled = [], 0
        begins, lengths = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)

        def settle(members, found, starts, counts):
            nonlocal filled
            pools.append(found)
            begins[members], lengths[members] = starts + filled, counts
            filled += len(found)

        # Agendas: their units, the merges each goes without, and the step from which its occurrences draw.
        unit, without, drawn = np.arange(len(units.sizes)), np.empty((0, len(units.sizes)), np.int64), np.zeros(len(units.sizes), np.int64)
        left, agenda, alone = np.arange(len(which)), which, []
        while len(left):
            steps = [(0, np.empty(0, np.int64), np.empty(0, np.int64))]
            found, starts, counts = self.segment(units, unit, None, without, steps)
            settle(left, found, starts[agenda], counts[agenda])
            if self.rate <= 0:
                break
            if not len(without):
                alone.append(left[units.sizes[which] > WIDE])
            late = [drawn[members] <= step for step, members, _ in steps]
            owner = np.concatenate([members[x] for x, (_, members, _) in zip(late, steps)])
            merges = np.concatenate([done[x] for x, (_, _, done) in zip(late, steps)])
            order = np.argsort(owner, kind="stable")
            owner, merges, made = owner[order], merges[order], np.bincount(owner, minlength=len(unit))
            first = np.cumsum(made) - made
            skip = self.first_skipped(keys[left], first[agenda], made[agenda], merges)
            left, skip = left[skip >= 0], skip[skip >= 0]
            alike = np.bincount(skip, minlength=len(merges)) >= self.shared
            alone.append(left[~alike[skip]])
            left, skip = left[alike[skip]], skip[alike[skip]]
            agenda, parted = (np.cumsum(alike) - 1)[skip], owner[alike]
            without, unit = np.vstack([without[:, parted], merges[None, alike]]), unit[parted]
            drawn = drawn[parted] + np.flatnonzero(alike) - first[parted]
        alone = np.concatenate([*alone, np.empty(0, np.int64)])
        settle(alone, *self.segment(units, which[alone], keys[alone]))
        ends = np.cumsum(lengths)
        pool = np.concatenate([*pools, np.empty(0, np.int32)])
        flat = pool[np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        return flat, np.concatenate([[0], ends])[upto]

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The texts of runs of piece ids."""
        _, upto, data = self.spelt.take(pa.array(ids)).buffers()
        upto = np.frombuffer(upto, np.int32)[offsets] if len(ids) else np.zeros(len(offsets), np.int32)
        spelt = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(upto), data or pa.py_buffer(b"")])
        return pc.utf8_slice_codeunits(spelt.cast(pa.string()), 1)

    def decode(self, ids) -> str:
        """The text of piece ids."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode()[1:]


def encode_pieces(
    docs: DataFrame,
    model: str,
    rate: float = 0.1,
    seed: int = 42,
    keep: list[str] | None = None,
    decoded: bool = False,
) -> DataFrame:
    """The ``keep`` columns (all by default) with pieces (array of ids) and lossless (whether decoding
    them gave the text); with ``decoded`` also the text that the pieces decode to."""
    added = ["pieces", "lossless", *["decoded"] * decoded]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(
        F.struct(*kept).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text").cast("string")).alias("text")
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = None
        for batch in batches:
            segmenter = segmenter or Segmenter(model, rate, seed)
            done = np.cumsum(pc.utf8_length(batch.column(2)).to_numpy())
            # Runs of whole texts of about CHUNK characters; a longer text is a run of its own.
            cuts = np.flatnonzero(np.diff(done // CHUNK, prepend=0))
            starts = np.unique(np.concatenate([[0], cuts, [batch.num_rows]]).astype(np.int64))
            for a, b in zip(starts.tolist(), starts[1:].tolist()):
                run = batch.slice(a, b - a)
                ids, offsets = segmenter.encode(run.column(1).to_pylist(), run.column(2).to_pylist())
                back = segmenter.decode_all(ids, offsets)
                columns = [
                    run.column(0),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids)),
                    pc.equal(back, run.column(2)),
                    *[back] * decoded,
                ]
                yield pa.RecordBatch.from_arrays(columns, ["row", *added])

    schema = StructType([rows.schema["row"]]).add("pieces", ArrayType(IntegerType())).add("lossless", BooleanType())
    if decoded:
        schema = schema.add("decoded", StringType())
    return rows.mapInArrow(encoded, schema).select(*[F.col("row")[c].alias(c) for c in kept], *added)

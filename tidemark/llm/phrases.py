"""Phrase collocations, counted by double-array tries over the whole corpus.

Texts are read once, into stored blocks of about a million word numbers with a break behind every
piece. Phrases grow by a word at a time. Candidates are Apriori-safe: both parts of a pair are
frequent words, both pairs of a triple are frequent pairs, and the blocks hold the phrase ``least``
times together; Spark sums the blocks' distinct candidates. They are dealt to shards of at most about
``ENTRIES``, each of which a task builds into a trie of two arrays: word c leads from state s to
base[s] + c if check there says s. ``GROUP`` shards are broadcast at a time. The words at a place name
the one shard that could hold a phrase there; for each block numpy starts a state at every place in the
root of its shard's trie, advances all of them a word at a time, drops those without a transition and
counts the accepting states left. Tasks tell their counts packed by slices of states, which are added up.

Words of a language are known by 64-bit hashes of language and word. Which words are frequent is told
to the blocks by a bit set of fixed size, whose false positives the counts correct. What a task holds
is bounded by a block and a group of shards; a pass over the blocks serves a whole group, and each place
is followed in one pass alone, so more candidates add little but the reading of the blocks.

A phrase's score is floor(10^6 a a / (l r)) for the cut into two parts where that is lowest; products
are decimals of 38 digits. A pair is dropped when a triple that holds it has at least half its count.

Defined cases: a null text counts as empty, a null lang as ``und``; empty pieces hold no words;
repeated rows count each; a piece of any length is followed whole, blocks break only between texts;
equal scores go by count, then phrase; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, stored, whole
from tidemark.llm.lm import squeezed, unsqueezed

LEAST = 10
"""Occurrences that make a phrase a candidate."""
TOP = 2000
BLOCK = 500_000
"""Words of a block; a longer text is a block of its own."""
ENTRIES = 250_000
"""Candidates of a shard, on average."""
GROUP = 6
"""Shards that a pass over the blocks serves."""
STRETCH = 1 << 16
"""Places of a block that are advanced together."""
SLICE = 1 << 15
"""States whose counts are packed together."""
BITS = 26
"""The frequent words' bit set holds 2**BITS bits."""
EMIT = 100_000
PARTS = 64
"""Parts that the phrases of a language are ranked in before the best of all parts are."""
DIGIT = 11
"""A word is two steps in a trie, of so many bits each: no state has more than 2**DIGIT children."""
TRIED = 16_384
"""Slots looked at for a state's children, about, before they go behind all others."""
BREAK = 0

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(_SEPARATORS + b"\t" + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * len(_SEPARATORS) + b" " + b"abcdefghijklmnopqrstuvwxyz")
BLOCKS = "block string, size long, tokens binary, n long, hashes binary, langs array<string>, lang_words array<bigint>, lang_tokens array<bigint>, counts binary, words binary"


def pieces(text: bytes) -> list[bytes]:
    """Words, a line feed behind each piece; blanks leave empty words."""
    return (text.translate(_PLAIN) + b"\n").replace(b"\n", b" \n ").split(b" ")


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row after the other, as a row is a whole block."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + b"\0" + word, 11)


class Numbers(dict):
    """Numbers for the words of a language, dealt from a list that all languages share."""

    def __init__(self, lang: str, names: list[tuple[str, bytes]]):
        super().__init__({b"\n": BREAK, b"": -1})
        self.lang, self.names = lang, names

    def __missing__(self, word: bytes) -> int:
        self.names.append((self.lang, word))
        self[word] = number = len(self.names)
        return number


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text as bytes) to blocks; words are numbered from 1 in the order of their languages and hashes."""
    names: list[tuple[str, bytes]] = []
    numbers: dict[str, Numbers] = {}
    held: list[np.ndarray] = []
    total = 0

    def block() -> pa.RecordBatch:
        langs = sorted({lang for lang, _ in names})
        index = {lang: k for k, lang in enumerate(langs)}
        of = np.fromiter((index[lang] for lang, _ in names), np.int64, len(names))
        hashes = np.fromiter((word_hash(lang.encode(), word) for lang, word in names), np.uint64, len(names))
        order = np.lexsort([hashes, of])  # sorted hashes are looked up faster
        of, hashes = of[order], hashes[order]
        place = np.empty(len(names) + 1, np.int64)
        place[0] = BREAK
        place[order + 1] = np.arange(1, len(names) + 1)
        tokens = place[np.concatenate(held)]
        counts = np.bincount(tokens, minlength=len(names) + 1)[1:]
        row = {
            "block": uuid.uuid4().hex, "size": len(tokens), "tokens": squeezed(tokens.astype("<u4")), "n": len(names),
            "hashes": squeezed(hashes), "langs": langs, "lang_words": np.bincount(of, minlength=len(langs)).tolist(),
            "lang_tokens": np.bincount(of, weights=counts, minlength=len(langs)).astype(np.int64).tolist(),
            "counts": squeezed(counts.astype("<u4")), "words": pa.compress(b"\n".join(names[k][1] for k in order), "zstd", asbytes=True),
        }
        row["words"] = int(sum(len(w) + 1 for _, w in names)).to_bytes(8, "little") + row["words"]
        kinds = (pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], list(row))

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = pieces(text.as_py())
            if len(words) > 2 and total and total + len(words) > BLOCK:
                yield block()
                names, numbers, held, total = [], {}, [], 0
            known = numbers.get(lang)
            if known is None:
                known = numbers[lang] = Numbers(lang, names)
            tokens = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            held.append(tokens[tokens >= 0])
            total += len(held[-1])
    if names:
        yield block()


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks to rows (lang, word, hash, n)."""
    for batch in batches:
        for row in rows_of(batch):
            size = int.from_bytes(row["words"][:8], "little")
            words = pa.decompress(row["words"][8:], max(size - 1, 0), "zstd", asbytes=True).split(b"\n")
            langs = np.repeat(np.array(row["langs"], object), row["lang_words"])
            hashes, counts = unsqueezed(row["hashes"], row["n"], "<u8").view(np.int64), unsqueezed(row["counts"], row["n"], "<u4").astype(np.int64)
            for at in range(0, row["n"], EMIT):
                part = slice(at, at + EMIT)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs[part], pa.string()), pa.array(words[part], pa.binary()).cast(pa.string()), pa.array(hashes[part]), pa.array(counts[part])],
                    ["lang", "word", "hash", "n"],
                )


def tokens_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of a block with breaks behind, and the hash of each number (0 for the break)."""
    tokens = unsqueezed(row["tokens"], row["size"], "<u4").astype(np.int64)
    hashes = np.concatenate([np.zeros(1, np.uint64), unsqueezed(row["hashes"], row["n"], "<u8")])
    return np.concatenate([tokens, np.full(3, BREAK)]), hashes


def bit_set(hashes: DataFrame) -> bytes:
    """2**BITS bits, one set for the upper bits of each value of column hash."""
    place = F.shiftrightunsigned("hash", 64 - BITS) + 1
    rows = (
        hashes.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    out = np.zeros((1 << BITS) // 8, np.uint8)
    for row in rows.collect():  # of fixed size together
        part = np.frombuffer(row.bits, np.uint8)
        at = (row.bucket - 1) * len(part)
        out[at : at + len(part)] = part[: len(out) - at]
    return out.tobytes()


def digits(numbers: np.ndarray) -> np.ndarray:
    """Upper and lower half of each number, in an axis more."""
    return np.stack([numbers >> DIGIT, numbers & ((1 << DIGIT) - 1)], axis=-1)


class Trie:
    """Two arrays over states, and the sorted hashes of the words with their numbers.

    Words are numbered by how many phrases they stand in, the most first, so that children lie close
    together; the upper and the lower half of a number are two steps.
    """

    def __init__(self, words: np.ndarray, numbers: np.ndarray, base: np.ndarray, check: np.ndarray):
        self.words, self.numbers, self.base, self.check = words, numbers, base, check

    @staticmethod
    def built(phrases: np.ndarray) -> tuple[Trie, np.ndarray]:
        """The trie of distinct phrases (rows of hashes, all of one length), and each one's accepting state."""
        words, codes, times = np.unique(phrases, return_inverse=True, return_counts=True)
        numbers = np.empty(len(words), np.int64)
        numbers[np.argsort(-times, kind="stable")] = np.arange(len(words))
        codes = digits(numbers[codes.reshape(phrases.shape)]).reshape(len(phrases), -1)
        order = np.lexsort(codes.T[::-1])
        codes = codes[order]
        used = np.zeros((1 << DIGIT) + 2, bool)
        used[0] = True
        base, check = np.zeros(len(used), np.int64), np.full(len(used), -1, np.int64)
        states = np.zeros(len(codes), np.int64)

        def room(n: int) -> None:
            nonlocal used, base, check
            if n > len(used):
                more = max(n, 2 * len(used)) - len(used)
                used = np.concatenate([used, np.zeros(more, bool)])
                base, check = np.concatenate([base, np.zeros(more, np.int64)]), np.concatenate([check, np.full(more, -1, np.int64)])

        for depth in range(codes.shape[1]):
            code = codes[:, depth]
            new = np.concatenate([[True], (states[1:] != states[:-1]) | (code[1:] != code[:-1])])
            node = np.cumsum(new) - 1
            parent, code = states[new], code[new]
            starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            ends = np.append(starts[1:], len(parent))
            slots = np.empty(len(parent), np.int64)
            end, free = int(np.flatnonzero(used)[-1]) + 1, np.empty(0, np.int64)
            several = np.flatnonzero(ends - starts > 1)
            for n, k in enumerate(several[np.argsort(starts[several] - ends[several], kind="stable")]):  # the most children first
                a, b = starts[k], ends[k]
                c = code[a:b]
                if n % 64 == 0:
                    free = np.flatnonzero(~used[:end])
                first = end - int(c[0])  # behind everything, if there is no room between
                room(end + int(c[-1] - c[0]) + 1)
                # The lowest free slots, then some from everywhere: a node of many children fits seldom.
                few, many = free[:32], free[:: len(free) // max(TRIED // len(c), 32) + 1]
                for tried in (few, many):
                    at = tried - c[0]
                    room(int(at.max(initial=0) + c[-1]) + 1)
                    fits = ~used[at[:, None] + c].any(axis=1)
                    if fits.any():
                        first = int(at[fits.argmax()])
                        break
                slots[a:b] = first + c
                used[slots[a:b]] = True
                base[parent[a]] = first
                end = max(end, int(slots[b - 1]) + 1)
            single = starts[ends - starts == 1]
            if len(single):
                room(end + len(single))
                slots[single] = np.flatnonzero(~used)[: len(single)]
                used[slots[single]] = True
                base[parent[single]] = slots[single] - code[single]
            check[slots] = parent
            states = slots[node]
        accepting = np.empty(len(order), np.int64)
        accepting[order] = states
        size = int(np.flatnonzero(used)[-1]) + 1 if len(codes) else 1
        return Trie(words, numbers, base[:size], check[:size]), accepting

    def advanced(self, tokens: np.ndarray, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where a phrase of ``length`` words starts, and its accepting state there."""
        found = list(Tries(1, {0: self}).advanced(tokens, hashes, length))
        return tuple(np.concatenate([np.empty(0, np.int64), *part]) for part in zip(*found)) if found else (np.empty(0, np.int64),) * 2

    def packed(self) -> tuple[int, int, bytes, bytes, bytes, bytes]:
        small = (a.astype("<i4") for a in (self.numbers, self.base, self.check))  # a shard has far fewer states
        return len(self.words), len(self.base), squeezed(self.words), *map(squeezed, small)

    @staticmethod
    def unpacked(n: int, size: int, words: bytes, numbers: bytes, base: bytes, check: bytes) -> Trie:
        return Trie(unsqueezed(words, n, "<u8"), unsqueezed(numbers, n, "<i4"), unsqueezed(base, size, "<i4"), unsqueezed(check, size, "<i4"))


def shard_of(h: list[str], shards: int) -> Column:
    """The shard that a phrase is dealt to; ``Tries`` finds it by the same rule."""
    mixed = F.col(h[0])
    for k, c in enumerate(h[1:], 1):
        mixed = mixed.bitwiseXOR(F.shiftrightunsigned(c, k))
    return F.pmod(mixed, F.lit(shards)).cast("int")


class Tries:
    """Tries of some of all ``shards``, one behind the other in two arrays, and the numbers each has for their words."""

    def __init__(self, shards: int, tries: dict[int, Trie]):
        # No child is further than 2**DIGIT from its base, on either side: what leaves a trie meets a margin.
        self.roots = np.cumsum([0, *[len(t.base) + (1 << DIGIT) for t in tries.values()]])
        self.shards, self.those = shards, list(tries)
        self.place = np.full(shards, -1)
        self.place[self.those] = np.arange(len(tries))
        self.words = np.unique(np.concatenate([t.words for t in tries.values()]))
        self.numbers = np.full((len(tries), len(self.words)), -1, np.int32)
        self.base, self.check = np.zeros(self.roots[-1], np.int32), np.full(self.roots[-1], -1, np.int32)
        for k, trie in enumerate(tries.values()):
            root, own = self.roots[k], slice(self.roots[k], self.roots[k] + len(trie.base))
            self.numbers[k, np.searchsorted(self.words, trie.words)] = trie.numbers
            self.base[own] = trie.base + root
            self.check[own] = np.where(trie.check < 0, -1, trie.check + root)
        to, ok = self.followed(self.roots[:-1, None], self.numbers)
        self.first = np.where(ok, to, -1).astype(np.int32)

    def followed(self, states: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states a word later, and which of them there are."""
        half = self.base[states] + (numbers >> DIGIT)
        to = self.base[half] + (numbers & ((1 << DIGIT) - 1))
        return to, (numbers >= 0) & (self.check[half] == states) & (self.check[to] == half)

    def advanced(self, tokens: np.ndarray, hashes: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places where a phrase of ``length`` words starts, and its accepting state there, by stretches of the block."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[at] == hashes
        known[BREAK] = False
        mixes = [hashes >> np.uint64(k) for k in range(length)]
        firsts, numbers = self.first.ravel(), self.numbers.ravel()
        for begin in range(0, len(tokens) - length, STRETCH):
            words = tokens[begin : min(begin + STRETCH, len(tokens) - length) + length - 1]
            ok, n = known[words], len(words) - length + 1
            places = np.flatnonzero(np.logical_and.reduce([ok[k : k + n] for k in range(length)]))
            mixed = np.bitwise_xor.reduce([mix[words[places + k]] for k, mix in enumerate(mixes)])
            row = self.place[mixed.view(np.int64) % self.shards]
            states = firsts[row * len(self.words) + at[words[places]]]
            ok = (row >= 0) & (states >= 0)
            for depth in range(1, length):
                places, states, row = places[ok], states[ok], row[ok]
                states, ok = self.followed(states, numbers[row * len(self.words) + at[words[places + depth]]])
            yield places[ok] + begin, states[ok]


PACKED = ("n", "size", "words", "numbers", "base", "check")
TRIES = "shard int, n int, size int, words binary, numbers binary, base binary, check binary, states array<bigint>, words_of array<bigint>"


def _build(rows: pa.Table) -> pa.Table:
    names = [c for c in rows.schema.names if c != "shard"]
    phrases = np.column_stack([rows.column(c).to_numpy() for c in names]).astype(np.int64).view(np.uint64)
    trie, states = Trie.built(phrases)
    kinds = (pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4)
    columns = [pa.array([v], k) for v, k in zip((rows.column("shard")[0].as_py(), *trie.packed()), kinds)]
    for values in (states, phrases.view(np.int64).ravel()):
        columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values)))
    return pa.Table.from_arrays(columns, [c.split()[0] for c in TRIES.split(", ")])


SEEN = "shard int, slice long, counts binary, block string, m long, steps binary"

SUMS = "shard int, state long, a long"

def _counted(shared, length: int, places: bool):
    """Blocks to the counts of each slice of a shard's states, a task adds up its blocks before it tells; and, if asked
    for, where phrases start in each block. Column m is how many numbers are packed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries, held = shared.value, 0
        total, one = np.zeros(tries.roots[-1], np.uint32), np.uint32(1)  # a one of another type is added far slower

        def told() -> Iterator[pa.RecordBatch]:
            for shard, root, end in zip(tries.those, tries.roots, tries.roots[1:]):
                for k, at in enumerate(range(root, end, SLICE)):
                    part = total[at : min(at + SLICE, end)]
                    if part.any():
                        yield _seen(shard, k, squeezed(part), None, len(part), None)
            total[:] = 0

        for batch in batches:
            for row in rows_of(batch):
                if held + row["size"] >= 1 << 32:
                    yield from told()
                    held = 0
                held += row["size"]
                starts = [np.empty(0, "<u4")]
                for at, states in tries.advanced(*tokens_of(row), length):
                    np.add.at(total, states, one)
                    if places:
                        starts.append(at.astype("<u4"))
                if places:
                    at = np.concatenate(starts)
                    yield _seen(None, None, None, row["block"], len(at), squeezed(np.diff(at, prepend=at.dtype.type(0))))
        yield from told()

    return count


def _seen(*values) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [c.split()[0] for c in SEEN.split(", ")])


def _summed(least: int):
    """The tasks' counts, dealt by slice, to (shard, state, a) of the states that were met ``least`` times."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in rows_of(batch):
                counts, key = unsqueezed(row["counts"], row["m"], "<u4"), (row["shard"], row["slice"])
                if key in sums:
                    sums[key] += counts
                else:
                    sums[key] = counts.astype(np.int64)
        for (shard, k), a in sums.items():
            states = np.flatnonzero(a >= least)
            columns = [pa.array(np.full(len(states), shard), pa.int32()), pa.array(k * SLICE + states, pa.int64()), pa.array(a[states], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "state", "a"])

    return summed


def names(length: int) -> list[str]:
    return [f"h{k + 1}" for k in range(length)]


def counted(
    blocks: DataFrame, candidates: DataFrame, length: int, least: int, places: bool = False
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Columns h1.. and a, the exact count, of every candidate that occurs ``least`` times; block, m and steps
    of the places where candidates start, if asked for; the folders used."""
    spark, h = blocks.sparkSession, names(length)
    shards = candidates.count() // ENTRIES + 1
    dealt = candidates.select(shard_of(h, shards).alias("shard"), *h)
    tries, folder = stored(dealt.groupBy("shard").applyInArrow(_build, TRIES), "tries")
    seen, folders = spark.createDataFrame([], SEEN), [folder]
    sums = spark.createDataFrame([], SUMS)
    for first in range(0, shards, GROUP):
        rows = {k: tries.where(F.col("shard") == k).select(*PACKED).first() for k in range(first, min(first + GROUP, shards))}
        group = {k: Trie.unpacked(*row) for k, row in rows.items() if row}
        if not group:
            continue
        shared = spark.sparkContext.broadcast(Tries(shards, group))  # about GROUP times ENTRIES phrases
        found = blocks.select("block", "tokens", "size", "hashes", "n").mapInArrow(_counted(shared, length, places), SEEN)
        part, folder = stored(found, "trie-counts")
        shared.unpersist()
        seen = seen.unionByName(part)
        told = part.where("shard IS NOT NULL").select("shard", "slice", "counts", "m").repartition("shard", "slice")
        sums = sums.unionByName(told.mapInArrow(_summed(least), SUMS))
        folders.append(folder)
    each = F.transform("states", lambda s, i: F.struct(s.alias("state"), *[F.get("words_of", i * length + k).alias(c) for k, c in enumerate(h)]))
    phrases = tries.select("shard", F.explode(each).alias("p")).select("shard", "p.*")
    out, folder = stored(sums.join(phrases, ["shard", "state"]).select(*h, "a"), f"phrases-{length}")
    return out, seen.where("block IS NOT NULL").select("block", "m", "steps"), [*folders, folder]


def _rows(hashes: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(counts), EMIT):
        part = slice(at, at + EMIT)
        columns = [pa.array(h[part].view(np.int64)) for h in hashes] + [pa.array(counts[part].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, [*names(len(hashes)), "n"])


def _pairs(shared):
    """Blocks to their distinct pairs of words in the bit set, and how often each one stands there."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for row in rows_of(batch):
                tokens, hashes = tokens_of(row)
                place = (hashes >> np.uint64(64 - BITS)).astype(np.int64)
                known = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                known[BREAK] = False
                ok = known[tokens]
                at = np.flatnonzero(ok[:-1] & ok[1:])
                codes, counts = np.unique(tokens[at] << 32 | tokens[at + 1], return_counts=True)
                yield from _rows([hashes[codes >> 32], hashes[codes & 0xFFFFFFFF]], counts)

    return pairs


def _triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the places of pairs, by shard, to their distinct triples of two such pairs."""
    for batch in batches:
        for row in rows_of(batch):
            tokens, hashes = tokens_of(row)
            is_pair = np.zeros(len(tokens), bool)
            for mark in row["marks"]:
                is_pair[np.cumsum(unsqueezed(mark["steps"], mark["m"], "<u4").astype(np.int64))] = True
            at = np.flatnonzero(is_pair[:-1] & is_pair[1:])
            pairs, of = np.unique(tokens[at] << 32 | tokens[at + 1], return_inverse=True)
            codes, counts = np.unique(of << 32 | tokens[at + 2], return_counts=True)
            first = pairs[codes >> 32]
            yield from _rows([hashes[first >> 32], hashes[first & 0xFFFFFFFF], hashes[codes & 0xFFFFFFFF]], counts)


def often(rows: DataFrame, least: int) -> DataFrame:
    h = [c for c in rows.columns if c != "n"]
    return rows.groupBy(*h).agg(F.sum("n").alias("n")).where(F.col("n") >= least).select(*h)


def _ratio(l: Column, r: Column) -> Column:
    """floor(10^6 a a / (l r)), exact."""
    a = F.col("a").cast("decimal(15,0)")
    top = F.lit(1_000_000).cast("decimal(7,0)") * a * a
    return F.call_function("div", top, l.cast("decimal(18,0)") * r.cast("decimal(18,0)")).cast("long")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's ``top`` phrases of two and three words."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")), whole(F.col("text").cast("string")).cast("binary"))
    blocks, folder = stored(rows.mapInArrow(_blocks, BLOCKS), "phrase-blocks")
    folders = [folder]
    per_lang = blocks.select(F.explode(F.arrays_zip("langs", "lang_tokens")).alias("l")).groupBy(F.col("l.langs").alias("lang")).agg(F.sum("l.lang_tokens").alias("n"))
    told = blocks.select("words", "langs", "lang_words", "hashes", "counts", "n").mapInArrow(_words, "lang string, word string, hash long, n long")
    words, folder = stored(told.groupBy("lang", "word", "hash").agg(F.sum("n").alias("f")).where(F.col("f") >= least), "frequent-words")
    folders.append(folder)

    shared = spark.sparkContext.broadcast(bit_set(words.select("hash")))
    coded = blocks.select("block", "tokens", "size", "hashes", "n")
    found = coded.mapInArrow(_pairs(shared), "h1 long, h2 long, n long")
    candidates, folder = stored(often(found, least), "pair-candidates")
    shared.unpersist()
    pairs, places, used = counted(coded, candidates, 2, least, places=True)
    folders += [folder, *used]

    marks = places.groupBy("block").agg(F.collect_list(F.struct("m", "steps")).alias("marks"))
    found = coded.join(marks, "block").drop("block").mapInArrow(_triples, "h1 long, h2 long, h3 long, n long")
    candidates, folder = stored(often(found, least), "triple-candidates")
    triples, _, used = counted(coded, candidates, 3, least)
    folders += [folder, *used]

    best = _ranked(words, pairs, triples, top).join(per_lang, "lang")
    best, _ = stored(best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
    dropped(spark, *folders)
    return best


def _ranked(words: DataFrame, pairs: DataFrame, triples: DataFrame, top: int) -> DataFrame:
    word = lambda k: words.select(F.col("hash").alias(f"h{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"), *([F.col("lang")] if k == 1 else []))
    of_two = pairs.join(word(1), "h1").join(word(2), "h2")
    two = of_two.select("h1", "h2", "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"))
    front = pairs.select("h1", "h2", F.col("a").alias("front"))
    back = pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("back"))
    three = triples.join(front, ["h1", "h2"]).join(back, ["h2", "h3"]).join(word(1), "h1").join(word(2), "h2").join(word(3), "h3")
    three = three.withColumns({"early": _ratio(F.col("f1"), F.col("back")), "late": _ratio(F.col("front"), F.col("f3"))})
    is_early = F.col("early") <= F.col("late")
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(is_early, F.col("f1")).otherwise(F.col("front")).alias("l"), F.when(is_early, F.col("back")).otherwise(F.col("f3")).alias("r"),
    )
    inside = triples.select("a", F.explode(F.array(F.struct("h1", "h2"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2")))).alias("p"))
    inside = inside.groupBy("p.h1", "p.h2").agg(F.max("a").alias("longer"))
    free = two.join(inside, ["h1", "h2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a")))
    scored = free.select("lang", "phrase", "a", "l", "r").unionByName(three).withColumn("score", _ratio(F.col("l"), F.col("r")))
    # A phrase among a language's first is among the first of its part, so no task ranks a whole language.
    best = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    for by in (["lang", "_part"], ["lang"]):
        order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.withColumn("rank", F.col("rank").cast("long"))

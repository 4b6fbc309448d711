"""Token ids in binary shard files, with a minimal perfect hash index for keyed access.

A store is a folder of three kinds of files. ``shard-*.bin`` holds the ids of whole documents one after
another, raw and little-endian, documents in ascending doc_id order within a shard and from shard to
shard; an id takes two bytes if the vocabulary allows, else four. ``shard-*.off`` holds, in eight bytes
each, the first id of every document of the shard, and the shard's id count. ``index-*.bin`` holds one
part of the index: the minimal perfect hash of the keys that fall into the part, and in the slot of each
key a fingerprint and where the key's documents are (first and last shard, row, rows). A lookup hashes the key to its
part and slot, compares the fingerprint and reads one range: constant time, whatever the store holds.

The hash is a cascade of bit arrays: a key takes the first level where no other key shares its
position; its slot is the number of set bits before it.

Tasks write each file under a name of their own attempt and return it; only names that arrive count,
so a lost executor or a second attempt leaves no trace in the result. Files are opened through
pyarrow's file systems, which cover shared mounts and object stores.

Defined cases: a null text counts as empty and has the end id alone; a null doc_id comes first and
is not indexed (``unkeyed`` names those rows); a text of any length is encoded whole and is one row of
one shard; rows that repeat an id lie next to each other and the key finds them all; an empty table
gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import public_tokenizers
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, stored, whole
from tidemark.session import scratch_path

END = 2
SHARD_CHARS = 24_000_000
"""Characters of text that a shard holds, about."""
SHARD_ROWS = 500_000
"""Documents that a shard holds, about, however short."""
PART_KEYS = 50_000
"""Keys of one part of the index, about."""
SPREAD = 2
"""Bits of a level for each key that reaches it."""
CACHED = 400_000
"""Units of text and parts of them that a worker remembers the ids of in each of two generations."""

SLOT = np.dtype([("print", "<u4"), ("shard", "<u4"), ("last", "<u4"), ("row", "<u8"), ("rows", "<u8")])
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(keys: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of each key (finalizer of splitmix64) under a salt."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.int64).view(np.uint64) + np.uint64(salt + 1) * _MIX[0]
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        return x ^ (x >> np.uint64(31))


FINGERPRINT_SALT, PART_SALT, LEVEL_SALT = 1, 2, 16


def opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path.replace("s3a://", "s3://") if "://" in path or path.startswith("file:") else f"file://{path}")


class PerfectHash:
    """Levels of bit arrays over distinct keys; slots are 0 to n - 1 without gaps."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = []  # set bits before each 64-bit word, over all levels
        total = 0
        for bits in levels:
            counts = np.bitwise_count(bits).astype(np.int64)
            self.before.append(total + np.cumsum(counts) - counts)
            total += int(counts.sum())

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], np.unique(keys)
        while len(left):
            size = (max(SPREAD * len(left), 64) + 63) // 64 * 64
            at = mixed(left, LEVEL_SALT + len(levels)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at.astype(np.int64)]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; any slot, or -1, for a key that was not among those hashed."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.levels, self.before)):
            at = mixed(keys[left], LEVEL_SALT + level) % np.uint64(64 * len(bits))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (before[word] + np.bitwise_count(below))[hit]
            left = left[~hit]
        return out


def part_bytes(keys: np.ndarray, slots: np.ndarray) -> bytes:
    """An index part: level count, level sizes in words, bit arrays, slot table."""
    table = PerfectHash.of(keys)
    placed = np.empty(len(keys), SLOT)
    placed[table.slots(keys)] = slots
    head = np.array([len(table.levels), *map(len, table.levels)], "<u8")
    return b"".join([head.tobytes(), *[x.tobytes() for x in table.levels], placed.tobytes()])


def read_part(data: bytes) -> tuple[PerfectHash, np.ndarray]:
    n = int(np.frombuffer(data, "<u8", 1)[0])
    sizes = np.frombuffer(data, "<u8", n, 8).astype(int)
    at, levels = 8 * (1 + n), []
    for size in sizes:
        levels.append(np.frombuffer(data, "<u8", size, at))
        at += 8 * size
    return PerfectHash(levels), np.frombuffer(data, SLOT, offset=at)


class Remembered(dict):
    """The ids of units and of their parts, worked out when first asked for.

    Bounded in two generations: what is used again outlives a change of generation.
    """

    def __init__(self, limit: int, ids_of):
        super().__init__()
        self.limit, self.ids_of, self.old = limit, ids_of, {}

    def __missing__(self, unit: str) -> bytes:
        found = self.old.get(unit)
        if found is None:
            found = self.ids_of(unit)
        self[unit] = found
        return found

    def age(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


class Encoder:
    """The tokenizer, with the ids of units it has met, as bytes.

    A unit is a run of blanks with the word behind it. The tokenizer always cuts between a character
    and white space after it, so the ids of a text are the ids of its units. A unit is cut further by
    the vocabulary's own pattern and its parts go to the tokenizer's model, which is twice as fast as
    the way of a whole text. Letters behind a blank or none are one part, and a point or comma behind
    them another; the pattern need not be asked for these. Texts with white space of other kinds next
    to blanks, or with a special token, are encoded whole, and so are units with characters from
    U+0590 on, where the versions of Unicode that the pattern and the tokenizer know may differ.
    """

    def __init__(self, vocabulary: str, end: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        self.end = self.packed([end])
        # Nearly all words stand behind one blank: they are looked up without it.
        self.known, self.behind_blank = Remembered(CACHED // 4, self.ids_of), Remembered(CACHED, lambda word: self.ids_of(" " + word))
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        # Byte-level vocabularies write bytes as printable characters: those that are none follow U+0100.
        shown = [b for b in range(256) if chr(b).isprintable() and b != 32]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.blank = self.letters[32]

    @classmethod
    def of_process(cls, vocabulary: str, end: int) -> Encoder:
        """The encoder that earlier tasks of this worker process left, or a new one."""
        kept = sys.modules.setdefault("_token_store_encoders", types.ModuleType("_token_store_encoders"))
        found = kept.__dict__.get((vocabulary, end))
        if found is None:
            found = kept.__dict__[vocabulary, end] = cls(vocabulary, end)
        return found

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def ids_of(self, unit: str) -> bytes:
        """The ids of a unit that is not remembered."""
        if not unit.isascii() and max(unit) >= "\u0590":
            return self.packed(self.tokenizer.encode(unit, add_special_tokens=False).ids)
        blank = unit[0] == " "
        body = unit[1:] if blank else unit
        if body.isalpha():
            return self.part(unit)
        if unit[-1] in MARKS and body[:-1].isalpha():
            word = self.behind_blank[body[:-1]] if blank else self.known[body[:-1]]
            return word + self.known[unit[-1]]
        parts = self.pattern.findall(unit)
        return self.part(unit) if len(parts) == 1 else b"".join([self.known[p] for p in parts])

    def part(self, part: str) -> bytes:
        """The ids of what the pattern leaves in one piece."""
        if part.isascii() and part.isalnum():
            written = part
        elif part[0] == " " and part.isascii() and part[1:].isalnum():
            written = self.blank + part[1:]
        else:
            written = part.encode().decode("latin-1").translate(self.letters)
        return self.packed([t.id for t in self.model.tokenize(written)])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text and the end id."""
        self.known.age()
        self.behind_blank.age()
        return [self.text(t) + self.end for t in texts]

    def text(self, text: str) -> bytes:
        if any(c in text for c in ODD_SPACE) or any(s in text for s in self.special):
            return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        first, *words = text.split(" ")
        ids = self.known[first] if first else b""
        if "" not in words:
            return ids + b"".join(map(self.behind_blank.__getitem__, words))
        units, blanks = [], ""
        for word in words:
            blanks += " "
            if word:
                units.append(blanks + word)
                blanks = ""
        return ids + b"".join([self.known[u] for u in [*units, blanks] if u])


MARKS = ".,"
ODD_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"] + [" \n", "\n "]
"""What makes a text one that is encoded whole: other white space, and line feeds next to blanks."""


def write_store(docs: DataFrame, vocabulary: str, end: int = END) -> TokenStore:
    """Encode ``docs`` (doc_id, text) and write shards and index to the shared folder."""
    path = scratch_path(docs.sparkSession, "tokens")
    rows = docs.select(F.col("doc_id").cast("long"), whole(F.col("text").cast("string")).alias("text"))
    size = rows.agg(F.sum(F.length("text")).alias("chars"), F.count(F.lit(1)).alias("rows")).first()
    shards = max(int((size.chars or 0) // SHARD_CHARS), size.rows // SHARD_ROWS) + 1
    # The hash of the text splits an id that many rows share, the row's number equal rows; the shards stay in doc_id order.
    dealt = rows.repartitionByRange(shards, "doc_id", F.xxhash64("text"), F.monotonically_increasing_id())
    dealt = dealt.sortWithinPartitions("doc_id", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = opened(path)
        store.create_dir(root, recursive=True)
        shard, encoder = TaskContext.get().partitionId(), Encoder.of_process(vocabulary, end)
        name, sink, offsets = f"shard-{shard:06d}-{uuid.uuid4().hex}", None, [np.zeros(1, np.int64)]
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = encoder.encode(part.column(1).to_pylist())
                sink = sink or store.open_output_stream(f"{root}/{name}.bin")
                sink.write(b"".join(found))
                first = sum(map(len, offsets)) - 1
                offsets.append(offsets[-1][-1] + np.cumsum([len(x) // encoder.width for x in found]))
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([name] * n), pa.array([shard] * n, pa.int32()), pa.array(range(first, first + n), pa.int64()),
                     pa.array([len(x) // encoder.width for x in found], pa.int64()), pa.array([encoder.width] * n, pa.int32())],
                    ["doc_id", "file", "shard", "row", "ids", "width"],
                )
        if sink:
            sink.close()
            with store.open_output_stream(f"{root}/{name}.off") as lengths:
                lengths.write(np.concatenate(offsets).astype("<u8").tobytes())

    schema = "doc_id long, file string, shard int, row long, ids long, width int"
    manifest, manifest_path = stored(dealt.mapInArrow(write, schema), "token-rows")
    # One row a shard from here.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.groupBy("shard", "file", "width").agg(F.sum("ids").alias("ids"), F.count(F.lit(1)).alias("rows"))
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    files, _ = stored(files.select("shard", "file", "width", "rows", so_far("ids").alias("ids_before"), so_far("rows").alias("rows_before")), "token-files")

    # A key's rows lie next to each other; a key that very many rows share may fill several shards.
    spans = manifest.groupBy("doc_id", "shard").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("rows"))
    keys = spans.groupBy("doc_id").agg(F.min(F.struct("shard", "row")).alias("at"), F.max("shard").alias("last"), F.sum("rows").alias("rows"))
    keys, _ = stored(keys.select("doc_id", F.col("at.shard").alias("shard"), "last", F.col("at.row").alias("row"), "rows"), "token-keys")
    dropped(docs.sparkSession, manifest_path)
    parts = keys.count() // PART_KEYS + 1

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = opened(path)
        for number, part in runs(batches):
            keys = part.column("doc_id").to_numpy()
            slots = np.empty(len(keys), SLOT)
            for c in ("shard", "last", "row", "rows"):
                slots[c] = part.column(c).to_numpy()
            slots["print"] = mixed(keys, FINGERPRINT_SALT) >> np.uint64(32)
            name = f"index-{number:06d}-{uuid.uuid4().hex}.bin"
            with store.open_output_stream(f"{root}/{name}") as sink:
                sink.write(part_bytes(keys, slots))
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([name])], ["part", "file"])

    numbered = _with_part(keys.where("doc_id IS NOT NULL"), parts).select("part", "doc_id", "shard", "last", "row", "rows")
    built = numbered.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(index, "part int, file string")
    built, _ = stored(built, "token-index")
    return TokenStore(path, files, built, parts, keys.where("doc_id IS NULL"))


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(value, rows) of each run of equal values in the first column, over the borders of batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(0).to_pylist()
        cuts = [0, *[k for k in range(1, len(values)) if values[k] != values[k - 1]], len(values)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                if held and held[0].column(0)[0].as_py() != values[a]:
                    yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(a, b - a))
    if held:
        yield held[0].column(0)[0].as_py(), pa.Table.from_batches(held)


def _with_part(keys: DataFrame, parts: int) -> DataFrame:
    """The part of the index each key falls into."""
    return keys.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"))


class TokenStore:
    """A written store: its folder, its shard files, its index files (part, file), and where rows without id are."""

    def __init__(self, path: str, files: DataFrame, index: DataFrame, parts: int, unkeyed: DataFrame):
        self.path, self.files, self.index, self.parts, self.unkeyed = path, files, index, parts, unkeyed

    def locate(self, keys: DataFrame) -> DataFrame:
        """doc_id, shard, last, row, rows of the distinct ``keys`` (doc_id) that the index knows."""
        path = self.path

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, root = opened(path)
            for file, part in runs(batches):
                with store.open_input_file(f"{root}/{file}") as source:
                    table, slots = read_part(source.read())
                asked = part.column("doc_id").to_numpy()
                at = table.slots(asked)
                asked, got = asked[at >= 0], slots[at[at >= 0]]
                right = got["print"] == (mixed(asked, FINGERPRINT_SALT) >> np.uint64(32)).astype(np.uint32)
                columns = [got[c][right].astype(kind) for c, kind in (("shard", np.int32), ("last", np.int32), ("row", np.int64), ("rows", np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (asked[right], *columns)], ["doc_id", "shard", "last", "row", "rows"])

        asked = keys.select(F.col("doc_id").cast("long")).where("doc_id IS NOT NULL").distinct()
        named = _with_part(asked, self.parts).join(self.index, "part").select("file", "doc_id")
        dealt = named.repartition(self.parts, "file").sortWithinPartitions("file")
        return dealt.mapInArrow(find, "doc_id long, shard int, last int, row long, rows long")

    def read(self, places: DataFrame) -> DataFrame:
        """doc_id, start (ids of all documents before), ids (binary, four little-endian bytes each) of
        every row at ``places``, which come from ``locate`` or ``unkeyed``."""
        path = self.path
        # Seldom more than one shard; a key that very many rows share runs on into the next ones.
        spread = places.withColumn("each", F.explode(F.sequence("shard", "last")))
        first = self.files.select(F.col("shard").alias("first_shard"), (F.col("rows_before")).alias("first_before"))
        own = spread.join(self.files.withColumnRenamed("rows", "held").withColumnRenamed("shard", "each"), "each")
        own = own.join(first, F.col("shard") == F.col("first_shard"))
        a, b = F.col("first_before") + F.col("row"), F.col("first_before") + F.col("row") + F.col("rows")
        start, end = F.greatest(a, F.col("rows_before")), F.least(b, F.col("rows_before") + F.col("held"))
        every = own.select(
            "file", (start - F.col("rows_before")).alias("row"), (end - start).alias("rows"), "width", "ids_before", "doc_id"
        )

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            store, root = opened(path)
            for file, part in runs(batches):
                with store.open_input_file(f"{root}/{file}.off") as offsets, store.open_input_file(f"{root}/{file}.bin") as ids:
                    first = np.frombuffer(offsets.read(), "<u8").astype(np.int64)
                    wanted = part.select(["row", "rows", "width", "ids_before", "doc_id"]).to_pylist()
                    out, held = ([], [], []), 0
                    for w in wanted:
                        for row in range(w["row"], w["row"] + w["rows"]):
                            a, b = int(first[row]), int(first[row + 1])
                            ids.seek(a * w["width"])
                            values = np.frombuffer(ids.read((b - a) * w["width"]), f"<u{w['width']}").astype("<u4").tobytes()
                            for column, value in zip(out, (w["doc_id"], w["ids_before"] + a, values)):
                                column.append(value)
                            held += len(values)
                            if held > 16_000_000:
                                yield _rows(out)
                                out, held = ([], [], []), 0
                    if out[0]:
                        yield _rows(out)

        return every.repartition("file").sortWithinPartitions("file", "row").mapInArrow(read, "doc_id long, start long, ids binary")


def _rows(columns) -> pa.RecordBatch:
    arrays = [pa.array(x, kind) for x, kind in zip(columns, (pa.int64(), pa.int64(), pa.binary()))]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "ids"])

"""Near duplicates by SimHash and pigeonhole blocks.

A fingerprint has a bit set where more than half of the text's shingle hashes have it. Two
fingerprints that differ in at most ``distance`` bits agree completely in at least
``blocks - distance`` of ``blocks`` blocks, so every choice of that many blocks is a join key: close
pairs meet under one of the keys, and their Hamming distance is verified there.

Equal fingerprints count once, so a group of copies costs one row. A key that very many different
fingerprints share is dealt to finer keys by pigeonhole on the bits it leaves out. Under a key, a task
links the fingerprints to a spanning forest instead of listing pairs; components are then joined by
alternating star contraction on written tables.

Defined cases: a null or blank text has fingerprint zero and links like any other; a very long text
is hashed whole, its bits counted piece by piece; repeated rows keep a row each; a null doc_id takes part and is never the smallest unless a component has no
other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, stored, whole

SEED = 42
SHINGLE = 3
DISTANCE = 3
BLOCKS = 6
DIRECT = 1024
"""Up to so many fingerprints under a key are compared with each other; more are split by pigeonhole again."""
HEAVY = 50_000
"""More fingerprints under a key are dealt to finer keys before a task gets them."""
DEEPEST = 6
"""Times that keys are made finer; each adds a quarter of the bits that are left."""


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """SimHash of the shingles of ``words`` words, repeats included; 0 without words."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate([[0], ends[:-1]])
    n = max(len(parts) - words + 1, 1)
    ends = (ends[min(words, len(parts)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends)), np.uint64, n)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        rows = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def _fingerprints(words: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(2)), np.uint64, batch.num_rows)
            columns = [batch.column(0), batch.column(1), pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "print"])

    return prints


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id, key (hash of the text) and print (the 64 bits as a signed long) of every row."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64(whole(F.col("text"))).alias("key"), F.col("text").cast("string"))
    return rows.mapInArrow(_fingerprints(words), "doc_id long, key long, print long")


def masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """The bit masks of all keys: every choice of ``blocks - distance`` blocks."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in itertools.combinations(block, blocks - distance)]


def close_links(prints: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """Rows (smaller root, other) of a spanning forest of the distinct ``prints`` within ``distance``."""
    root = np.arange(len(prints))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    def link(index):
        n = len(index)
        if n < 2:
            return
        varying = int(np.bitwise_or.reduce(prints[index] ^ prints[index[0]]))
        bits = [b for b in range(64) if varying >> b & 1]
        if n > DIRECT and len(bits) > 8:
            for part in np.array_split(np.array(bits), distance + 1):
                mask = np.uint64(sum(1 << int(b) for b in part))
                order = index[np.argsort(prints[index] & mask, kind="stable")]
                key = prints[order] & mask
                cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
                runs = np.split(order, cuts)
                for run in runs:
                    link(run)
            return
        for at, k in enumerate(index[:-1]):
            others = index[at + 1 :]
            for other in others[np.bitwise_count(prints[others] ^ prints[k]) <= distance]:
                a, b = find(k), find(other)
                root[max(a, b)] = min(a, b)

    link(np.arange(len(prints)))
    top = np.array([find(k) for k in range(len(prints))], int)
    linked = np.flatnonzero(top != np.arange(len(prints)))
    return np.stack([prints[top[linked]], prints[linked]], axis=1) if len(linked) else np.empty((0, 2), np.uint64)


def _links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (mask number, key, print) sorted by all three to links; a key may span batches."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def flush():
        which, key, prints = (np.concatenate(x) for x in zip(*held))
        held.clear()
        new = np.concatenate([[True], (which[1:] != which[:-1]) | (key[1:] != key[:-1])])
        starts = np.concatenate([np.flatnonzero(new), [len(new)]])
        found = [close_links(np.unique(prints[a:b].view(np.uint64)), distance) for a, b in zip(starts, starts[1:]) if b - a > 1]
        pairs = np.concatenate([*found, np.empty((0, 2), np.uint64)]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        which, key, prints = (batch.column(k).to_numpy() for k in range(3))
        last = int(np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (key[1:] != key[:-1])]))[-1])
        if held and (held[-1][0][-1], held[-1][1][-1]) != (which[0], key[0]):
            yield flush()
        if last:
            held.append((which[:last], key[:last], prints[:last]))
            yield flush()
        held.append((which[last:], key[last:], prints[last:]))
    if held:
        yield flush()


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def parts_of(mask: int, distance: int) -> list[int]:
    """Masks that add to ``mask`` one of ``distance + 1`` parts of the bits it leaves out.

    Fingerprints within ``distance`` that agree under ``mask`` agree under one of these too.
    """
    free = [bit for bit in range(64) if not mask >> bit & 1]
    cut = [free[k * len(free) // (distance + 1) : (k + 1) * len(free) // (distance + 1)] for k in range(distance + 1)]
    return [mask | sum(1 << bit for bit in part) for part in cut]


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints, a spanning forest under each key.

    There are ``distance`` more blocks than a key has, so that the keys of any distance have three.
    A key that more than ``HEAVY`` fingerprints share, such as pages of one template, is replaced by
    the keys that look at some of the other bits too, and these again, so that no task gets it whole.
    """
    spark = prints.sparkSession
    level = [signed(m) for m in masks(distance + BLOCKS - DISTANCE, distance)]
    distinct = prints.select("print").distinct()
    keyed = distinct.select(F.explode(F.array(*map(F.lit, level))).alias("mask"), "print")
    keyed = keyed.select("mask", F.col("mask").bitwiseAND(F.col("print")).alias("key"), "print")
    for _ in range(DEEPEST):
        heavy, _ = stored(keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HEAVY).select("mask", "key"), "heavy-keys")
        found = [r.mask for r in heavy.select("mask").distinct().collect()]  # some of the level's masks
        if not found:
            break
        finer = [(m, [signed(p) for p in parts_of(m & (1 << 64) - 1, distance)]) for m in found]
        finer = F.broadcast(spark.createDataFrame(finer, "mask long, finer array<bigint>"))
        more = keyed.join(heavy, ["mask", "key"], "left_semi").join(finer, "mask").select(F.explode("finer").alias("mask"), "print")
        more = more.select("mask", F.col("mask").bitwiseAND(F.col("print")).alias("key"), "print")
        keyed, _ = stored(keyed.join(heavy, ["mask", "key"], "left_anti").unionByName(more), "keyed")
    dealt = keyed.repartition("mask", "key").sortWithinPartitions("mask", "key", "print")
    return dealt.mapInArrow(lambda batches: _links(batches, distance), "a long, b long").distinct()


def components(edges: DataFrame, label: str = "components") -> tuple[DataFrame, list[str]]:
    """(node, root) of every node with an edge, root the smallest node reachable, and the folders used.

    Alternates large-star (hang larger neighbours on the smallest) and small-star (hang smaller
    neighbours on the smallest) until an iteration changes nothing; the number of rounds grows with
    the logarithm of the longest chain.
    """
    spark, folders = edges.sparkSession, []

    def kept(df):
        out, path = stored(df, label)
        folders.append(path)
        return out

    stars = kept(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .distinct()
        )
        now = kept(small)
        if now.count() == stars.count() and now.exceptAll(stars).isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")), folders
        stars = now


def grouped(docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, key, print and component (the smallest print of the group) of every row, stored."""
    spark = docs.sparkSession
    prints, path = stored(fingerprints(docs, words), "prints")
    edges, folder = stored(links(prints, distance), "links")
    roots, folders = components(edges)
    out, _ = stored(
        prints.join(roots, prints["print"] == roots["node"], "left").select(
            "doc_id", "key", "print", F.coalesce("root", "print").alias("component")
        ),
        "grouped",
    )
    dropped(spark, path, folder, *folders)
    return out


def near_duplicates(docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs``."""
    rows = grouped(docs, words, distance)
    # Stored, so that the join is a stage of its own, in which Spark can split a large component.
    smallest, _ = stored(rows.groupBy("component").agg(F.min("doc_id").alias("component_id")), "smallest")
    return rows.join(smallest, "component").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_near_duplicates(docs: DataFrame, words: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for each group: the smallest doc_id, of equal ids the smallest text hash."""
    rows = grouped(docs, words, distance)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "key")).alias("first")
    chosen = rows.groupBy("component").agg(first).select(F.col("first.doc_id").alias("_id"), F.col("first.key").alias("_key"))
    copies = rows.groupBy(F.col("doc_id").alias("_of"), F.col("key").alias("_with")).agg(F.count(F.lit(1)).alias("_copies"))
    same = F.col("_of").eqNullSafe(F.col("_id")) & (F.col("_with") == F.col("_key"))
    chosen = copies.join(chosen, same, "left_semi")
    # The row travels as one column, so that its own names cannot meet these.
    named = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64(whole(F.col("text"))).alias("_hash"))
    kept = named.join(chosen, F.col("_doc").eqNullSafe(F.col("_of")) & (F.col("_hash") == F.col("_with")))
    columns = [F.col("_row")[c].alias(c) for c in docs.columns]
    once = kept.where("_copies = 1").select(*columns)
    if chosen.where("_copies > 1").isEmpty():
        return once
    # Rows that are equal in id and text, seldom any: one of each.
    return once.unionByName(kept.where("_copies > 1").dropDuplicates(["_of", "_with"]).select(*columns))

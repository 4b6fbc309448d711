"""Ranked lexical search by pipelined term partitioning.

Documents are cut into blocks of at most ``DOCS``, each with one posting list for every term that
some item asks for: places in the block and occurrences. Terms are dealt to ``OWNERS`` owners by
hash. Items travel in bundles; a bundle visits the owners one after another, once for each block, and
carries for each of its items a sparse accumulator, the scores of the block's documents so far. At
each stage a cogroup brings the bundle together with the lists of that owner's terms that it asks
for; their integer contributions are added, and the bundle goes on. Behind the last owner each block
names its best documents for each item, and the best of these are selected.

A stage moves one row for each bundle and block, so a term that all documents hold is spread over all
blocks, and no task holds more than ``ITEMS`` accumulators of ``DOCS`` documents. The items' terms
and the bundles are broadcast up to ``BROADCAST_TERMS`` pairs, counted first, and joined by shuffle
beyond that.

Weights: ``floor(1000 ln((2N+2)/(2df+1)))`` of a term, ``50 + 50 n N div L`` of a document, and
``weight * (10^9 tf div (1000 tf + 20 m))`` of a term in a document; all whole numbers.

Defined cases: a null or termless text is no document and a null or termless item finds nothing;
item rows that repeat an id are one item with the terms of all of them, a null id is an id; repeated
document rows are documents of their own; a null doc_id comes last among equal scores; a long text
is one entry in a block like any other; an empty table on either side gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import dropped, lower_ascii, stored, whole
from tidemark.llm.lm import squeezed, unsqueezed

DOCS = 8192
"""Documents of a block, at most; places in it take two bytes."""
OWNERS = 4
ITEMS = 256
"""Items of a bundle, on average."""
BROADCAST_TERMS = 500_000
"""More (bundle, term) pairs are joined by shuffle."""
BEST = 50

# What parts terms, as bytes and as the pattern of the same characters. Both stand for lower-case text.
_PARTING = bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PLAIN = bytes.maketrans(
    _PARTING + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_PARTING) + b"abcdefghijklmnopqrstuvwxyz"
)

INDEX = "block string, term string, n_docs int, postings binary, doc_ids array<bigint>, sizes array<bigint>"
CARRIED = ("bundle", "block", "doc_ids", "lengths", "asked", "counts", "places", "scores")


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def asked_terms(items: DataFrame) -> DataFrame:
    """item_id and term, once each."""
    words = F.split(lower_ascii(whole(F.col("text").cast("string"))), SEPARATORS, -1)
    return items.select("item_id", F.explode(words).alias("term")).where("term <> ''").distinct()


def _index(shared):
    """Rows (doc_id, text as bytes) to the blocks' head and posting rows; all terms when ``shared`` is None."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if shared is None else shared.value
        ids: list[int | None] = []
        sizes: list[int] = []
        lists: defaultdict[bytes, tuple[list[int], list[int]]] = defaultdict(lambda: ([], []))

        def block() -> Iterator[pa.RecordBatch]:
            name, terms = uuid.uuid4().hex, list(lists)
            for at in range(0, len(terms) or 1, 10_000):
                part = terms[at : at + 10_000]
                packed = [np.array(lists[t][0], "<u2").tobytes() + np.array(lists[t][1], "<u4").tobytes() for t in part]
                counts = [len(lists[t][0]) for t in part]
                head, none = ([(None, None, None, ids, sizes)] if at == 0 else []), [None] * len(part)
                columns = zip(*head, *zip([t.decode("utf-8", "replace") for t in part], counts, packed, none, none))
                kinds = (pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(arrays[0])), *arrays], [c.split()[0] for c in INDEX.split(", ")])
            ids.clear(), sizes.clear(), lists.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(text.as_py())
                if not words:
                    continue
                for word, n in Counter(words).items():
                    if wanted is None or word in wanted:
                        places, times = lists[word]
                        places.append(len(ids))
                        times.append(n)
                ids.append(doc_id)
                sizes.append(len(words))
                if len(ids) == DOCS:
                    yield from block()
        if ids:
            yield from block()

    return index


def _visit(bundles: pa.Table, lists: pa.Table) -> pa.Table:
    """One bundle at one owner, in one block: add what the owner's terms contribute."""
    if not bundles.num_rows:
        return bundles
    row = bundles.to_pylist()[0]
    of_item: defaultdict[int, list[tuple[str, int]]] = defaultdict(list)
    postings = dict(zip(lists.column("term").to_pylist(), lists.column("postings").to_pylist()))
    items: dict = {}
    for item_id, term, weight in ((a["item_id"], a["term"], a["weight"]) for a in row["asked"]):
        at = items.setdefault(item_id, len(items))
        if term in postings:
            of_item[at].append((term, weight))
    lengths = np.array(row["lengths"], np.int64)
    given: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for term, packed in postings.items():
        n = len(packed) // 6
        places, tf = np.frombuffer(packed, "<u2", n), np.frombuffer(packed, "<u4", n, 2 * n).astype(np.int64)
        given[term] = places, 1_000_000_000 * tf // (1000 * tf + 20 * lengths[places])
    counts, places, scores = accumulators(row, len(items))
    ends, out_counts, out_places, out_scores = np.cumsum(counts), [], [], []
    for at in range(len(items)):
        mine = slice(ends[at] - counts[at], ends[at])
        p, s = places[mine], scores[mine]
        if of_item[at]:
            sums = np.zeros(len(lengths), np.int64)
            sums[p] = s
            for term, weight in of_item[at]:
                there, part = given[term]
                sums[there] += weight * part
            p = np.flatnonzero(sums)
            s = sums[p]
        out_counts.append(len(p))
        out_places.append(p.astype("<u2"))
        out_scores.append(s)
    for name, parts, kind in (("counts", [out_counts], "<u4"), ("places", out_places, "<u2"), ("scores", out_scores, "<i8")):
        flat = np.concatenate([np.asarray(x, kind) for x in parts]) if parts else np.empty(0, kind)
        packed = pa.array([squeezed(flat)], pa.binary())
        bundles = bundles.set_column(bundles.schema.get_field_index(name), name, packed)
    return bundles


def accumulators(row: dict, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many documents each of the ``n`` items has so far, their places and their scores."""
    if row["counts"] is None:
        return np.zeros(n, np.int64), np.empty(0, "<u2"), np.empty(0, "<i8")
    counts = unsqueezed(row["counts"], n, "<u4").astype(np.int64)
    total = int(counts.sum())
    return counts, unsqueezed(row["places"], total, "<u2"), unsqueezed(row["scores"], total, "<i8")


def _best(k: int, schema: pa.DataType):
    """Bundles behind the last owner to the ``k`` best documents of each item in each block."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                items = list(dict.fromkeys(a["item_id"] for a in row["asked"]))
                counts, places, scores = accumulators(row, len(items))
                ids = row["doc_ids"]
                late = np.array([i is None for i in ids])
                order = np.array([0 if i is None else i for i in ids], np.int64)
                found = []
                ends = np.cumsum(counts)
                for item, a, b in zip(items, ends - counts, ends):
                    p, s = places[a:b], scores[a:b]
                    if len(s) > k:
                        enough = s >= np.partition(s, len(s) - k)[len(s) - k]
                        p, s = p[enough], s[enough]
                    first = np.lexsort((order[p], late[p], -s))[:k]
                    found += [(item, ids[x], int(y)) for x, y in zip(p[first], s[first])]
                if found:
                    kinds = (schema, pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], ["item_id", "doc_id", "score"])

    return best


def _length(n: Column, documents: int, total: int) -> Column:
    """A document's m: products may pass 64 bits, so decimals."""
    product = F.lit(50).cast("decimal(2,0)") * n.cast("decimal(16,0)") * F.lit(documents).cast("decimal(18,0)")
    return F.lit(50).cast("long") + F.call_function("div", product, F.lit(max(total, 1)).cast("decimal(19,0)"))


def index(docs: DataFrame, terms: DataFrame) -> tuple[DataFrame, list[str]]:
    """Head and posting rows of all blocks, posting rows of the ``terms`` (column term) only; and the folders used."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), whole(F.col("text").cast("string")).cast("binary"))
    # The count bounds what the driver and each task receive.
    if terms.count() <= BROADCAST_TERMS:
        shared = spark.sparkContext.broadcast({r.term.encode() for r in terms.select("term").collect()})
        blocks, path = stored(rows.mapInArrow(_index(shared), INDEX), "blocks")
        return blocks, [path]
    every, path = stored(rows.mapInArrow(_index(None), INDEX), "all-lists")
    wanted = every.where("term IS NOT NULL").join(terms, "term", "left_semi")
    blocks, smaller = stored(every.where("term IS NULL").unionByName(wanted), "blocks")
    return blocks, [path, smaller]


def ranked(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item."""
    spark = docs.sparkSession
    asked, asked_path = stored(asked_terms(items), "asked")
    blocks, block_paths = index(docs, asked.select("term").distinct())
    heads, lists = blocks.where("term IS NULL"), blocks.where("term IS NOT NULL")
    sizes = heads.select(F.size("doc_ids").alias("n"), F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x).alias("l"))
    totals = sizes.agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    documents, total = totals.n or 0, totals.l or 0

    df = lists.groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * documents + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("long")
    n_bundles = asked.select("item_id").distinct().count() // ITEMS + 1
    bundle = F.pmod(F.xxhash64("item_id"), F.lit(n_bundles)).cast("int").alias("bundle")
    weighted, weighted_path = stored(
        asked.join(df, "term").select(bundle, "item_id", "term", weight.alias("weight"), F.pmod(F.xxhash64("term"), F.lit(OWNERS)).alias("owner")), "weighted"
    )
    bundles = weighted.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("item_id", "term", "weight"))).alias("asked"))
    owned = weighted.select("bundle", "term", "owner").distinct()
    if weighted.count() <= BROADCAST_TERMS:
        bundles, owned = F.broadcast(bundles), F.broadcast(owned)

    empty = F.lit(None).cast("binary")
    lengths = F.transform("sizes", lambda n: _length(n, documents, total)).alias("lengths")
    dealt = heads.select("block", "doc_ids", lengths, F.explode(F.sequence(F.lit(0), F.lit(n_bundles - 1))).alias("bundle"))
    carried = dealt.join(bundles, "bundle").select(*CARRIED[:5], *[empty.alias(c) for c in CARRIED[5:]])
    schema = carried.schema
    for owner in range(OWNERS):
        its = lists.join(owned.where(F.col("owner") == owner), "term").select(F.col("bundle").alias("to"), F.col("block").alias("of"), "term", "postings")
        carried = carried.groupBy("bundle", "block").cogroup(its.groupBy("to", "of")).applyInArrow(_visit, schema)
    item_type = schema["asked"].dataType.elementType["item_id"].dataType
    best = carried.mapInArrow(_best(k, to_arrow_type(item_type)), f"item_id {item_type.simpleString()}, doc_id long, score long")
    best, _ = stored(best, "best")
    dropped(spark, asked_path, *block_paths, weighted_path)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.select("item_id", F.row_number().over(order).alias("rank"), "doc_id", "score").where(F.col("rank") <= k)

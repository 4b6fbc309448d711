"""Benchmark decontamination by a prefix-filtered set join. Native expressions only.

Items are cut into windows of consecutive words, documents and windows into shingles of three words
(fewer where the item is shorter). One pass over the documents keeps the places of shingles that any
window holds. Shingles are ordered by rarity in the corpus; containment of a whole window makes a
prefix of one shingle, the window's rarest, necessary, so only places of those propose (document,
window start). A proposal must fit between the document's first and last word, and is verified
exactly: every shingle of the window at its own place.

A window's text is its identity, so windows that several items share are looked for once.

Defined cases: a null or wordless text has no words, a null or wordless item no windows; a very long
text is one list of words in its task and is looked through whole; repeated document rows get equal
rows of their own; items that repeat an id count once; an empty table on either side gives no hits;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, lower_ascii, stored, whole

WINDOW = 10
SHINGLE = 3
BROADCAST_ROWS = 500_000
"""A larger vocabulary of benchmark shingles is joined by shuffle instead."""
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Runs of letters, digits and non-ASCII characters, A-Z in lower case."""
    return F.filter(F.split(lower_ascii(whole(text)), SEPARATORS, -1), lambda w: w != "")


def _shingles(parts: Column, size: int) -> Column:
    """Structs of ``size`` consecutive words; absent words of shorter shingles are empty."""
    columns = [parts if k == 0 else F.slice(parts, k + 1, F.greatest(F.size(parts) - k, F.lit(0))) for k in range(size)]
    blank = [F.lit("")] * (SHINGLE - size)
    count = F.greatest(F.size(parts) - (size - 1), F.lit(0))
    zipped = F.slice(F.arrays_zip(*[c.alias(f"w{k}") for k, c in enumerate(columns)]), 1, count)
    if not blank:
        return zipped
    names = [f"w{k}" for k in range(SHINGLE)]
    return F.transform(zipped, lambda z: F.struct(*[(z[n] if k < size else F.lit("")).alias(n) for k, n in enumerate(names)]))


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """item_id, window (its words), n: every window of every item, each once per item."""
    parts = items.select("item_id", words(F.col("text")).alias("parts")).where(F.size("parts") > 0)
    size = F.least(F.size("parts"), F.lit(width))
    starts = F.sequence(F.lit(1), F.size("parts") - size + 1)
    cut = parts.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("parts", s, size))).alias("window"))
    return cut.distinct()


def contaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, items (ids sorted as strings), key.

    ``key`` is the hash of the text; (doc_id, key) is how hits find their rows again.
    """
    cut, cut_path = stored(windows(items, width).select("item_id", "window", F.xxhash64("window").alias("window_id")), "windows")
    looked_for = cut.groupBy("window_id", "window").agg(F.count(F.lit(1)).alias("_items"))
    size = F.least(F.size("window"), F.lit(SHINGLE))
    pieces = looked_for.select(
        "window_id", F.size("window").alias("n"),
        F.posexplode(F.when(size == 3, _shingles(F.col("window"), 3)).when(size == 2, _shingles(F.col("window"), 2)).otherwise(_shingles(F.col("window"), 1))).alias("offset", "s"),
    ).select("window_id", "n", "offset", size_of(F.col("s")).alias("size"), F.col("s.*"))
    pieces, pieces_path = stored(pieces, "pieces")
    sizes = [r[0] for r in pieces.select("size").distinct().collect()]  # of 1, 2 and 3
    vocabulary = pieces.select("w0", "w1", "w2").distinct().select(
        F.xxhash64("w0", "w1", "w2").alias("shingle"), F.col("w0").alias("v0"), F.col("w1").alias("v1"), F.col("w2").alias("v2")
    )

    if vocabulary.count() <= BROADCAST_ROWS:
        vocabulary = F.broadcast(vocabulary)

    texts = docs.select("doc_id", whole(F.col("text")).alias("_text"))
    tokens = texts.select("doc_id", F.xxhash64("_text").alias("key"), words(F.col("_text")).alias("parts"))
    # A row of its own for each document, without words and at place -1, carries its word count.
    head = F.array(F.struct(*[F.lit("").alias(f"w{k}") for k in range(SHINGLE)]))
    listed = F.concat(head, *[_shingles(F.col("parts"), s) for s in sorted(sizes)])
    rows = tokens.select("doc_id", "key", F.size("parts").alias("n_words"), F.posexplode(listed).alias("at", "s"))
    rows = rows.select("doc_id", "key", "n_words", "at", "s.*")
    shingle = F.xxhash64("w0", "w1", "w2")
    same = (shingle == F.col("shingle")) & (F.col("w0") == F.col("v0")) & (F.col("w1") == F.col("v1")) & (F.col("w2") == F.col("v2"))
    place = F.col("at") - 1
    for s in sorted(sizes)[:-1]:  # longer shingles follow the shorter ones in the list
        longest = F.greatest(F.col("n_words") - (s - 1), F.lit(0))
        place = F.when(size_of_row() > s, place - longest).otherwise(place)
    met = rows.join(vocabulary, same, "left").where((F.col("at") == 0) | F.col("shingle").isNotNull())
    met = met.select("doc_id", "key", "n_words", F.when(F.col("at") == 0, -1).otherwise(place).cast("int").alias("at"), "shingle")
    met, met_path = stored(met, "met")

    places = met.where("at >= 0").select("doc_id", "key", "n_words", "at", "shingle")
    rarity = places.groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
    pieces = pieces.withColumn("shingle", F.xxhash64("w0", "w1", "w2")).drop("w0", "w1", "w2", "size")
    # The necessary prefix: the rarest shingle. A window with a shingle that no document has is absent.
    known = pieces.join(rarity, "shingle", "left")
    first = known.groupBy("window_id", "n").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "offset", "shingle")).alias("p"), F.count(F.lit(1)).alias("needs")
    ).where("p.seen > 0")
    prefix = first.select("window_id", "n", "needs", F.col("p.offset").alias("offset"), F.col("p.shingle").alias("shingle"))
    proposed = (
        places.join(prefix, "shingle")
        .select("doc_id", "key", "n_words", "window_id", "n", "needs", (F.col("at") - F.col("offset")).alias("start"))
        .where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("n_words")))
        .distinct()
    )
    here = places.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "at", F.col("shingle").alias("held")).distinct()
    at_place = (
        F.col("doc_id").eqNullSafe(F.col("d"))
        & (F.col("key") == F.col("k"))
        & (F.col("at") == F.col("start") + F.col("offset"))
        & (F.col("shingle") == F.col("held"))
    )
    verified = (
        proposed.join(pieces.select("window_id", "offset", "shingle"), "window_id")
        .join(here, at_place)
        .groupBy("doc_id", "key", "window_id", "start", "n", "needs")
        .agg(F.count(F.lit(1)).alias("has"))
        .where("has = needs")
    )
    verified, verified_path = stored(verified.select("doc_id", "key", "window_id", "start", "n"), "verified")

    # Words inside any window: each start adds what reaches beyond the ends before it.
    by_start = Window.partitionBy("doc_id", "key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = verified.groupBy("doc_id", "key", "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    fresh = F.greatest(F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(by_start), F.lit(0))), F.lit(0))
    hits = spans.select("doc_id", "key", fresh.alias("fresh")).groupBy("doc_id", "key").agg(F.sum("fresh").cast("long").alias("n_hit"))
    found = (
        verified.select("doc_id", "key", "window_id").distinct()
        .join(cut.select("window_id", F.col("item_id").cast("string").alias("item_id")).distinct(), "window_id")
        .groupBy("doc_id", "key")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    both = hits.join(found, hits["doc_id"].eqNullSafe(found["doc_id"]) & (hits["key"] == found["key"])).select(
        hits["doc_id"].alias("d"), hits["key"].alias("k"), "n_hit", "items"
    )
    heads = met.where("at = -1").select("doc_id", "key", F.col("n_words").cast("long").alias("n_words"))
    found = heads.join(both, heads["doc_id"].eqNullSafe(both["d"]) & (heads["key"] == both["k"]), "left").select(
        "doc_id", "key", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    found, _ = stored(found, "contaminated")  # narrow, so that what it came from can go
    dropped(docs.sparkSession, cut_path, pieces_path, met_path, verified_path)
    return found


def size_of(shingle: Column) -> Column:
    return F.when(shingle["w2"] != "", 3).when(shingle["w1"] != "", 2).otherwise(1)


def size_of_row() -> Column:
    return F.when(F.col("w2") != "", 3).when(F.col("w1") != "", 2).otherwise(1)


def digest(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item."""
    hit = contaminated(docs, items).where("n_hit > 0").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    # The row travels as one column, so that its own names cannot meet these.
    named = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_doc"), F.xxhash64(whole(F.col("text"))).alias("_hash"))
    left = named.join(hit, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_key")), "left_anti")
    return left.select(*[F.col("_row")[c].alias(c) for c in docs.columns])

"""Line dedup by content-defined chunks of lines. Native expressions only.

Each line has a hash and a number of words. From every line on, the shortest run of lines that holds
``LONG`` words is a window, and a rolling hash over the line hashes of a window decides where chunks
begin: at the line whose window has the smallest hash of all windows that begin inside one window.
So boundaries depend on nearby content alone, a shift of the text moves them along, and every run of
lines of at least ``2 * LONG - 1`` words, however long its lines, holds a whole chunk (the window at a
boundary): its windows that begin before the last ``LONG - 1`` words lie inside it.

A chunk that stands at several places keeps its first place, by doc_id, then hash of the text, then
position. Elsewhere it is extended line by line to both sides as long as the lines are those around
the first place (``EDGE`` words at most, as a longer run holds further chunks). Lines beyond that
belong to the run too if the places with the same chunk and the same lines up to there have an
earlier one among them. Lines that stand in the same order against one first document are compared
with that document's bytes, and go if these are equal. Runs of fewer than ``LONG`` words, such as
common short lines, stay everywhere.

A word is a run of characters that are not white space, of ``WIDE`` characters at most; in scripts
without blanks, two characters are a word. Blank lines belong to the line above them and are not
compared.

Defined cases: a null text stays null and an empty one empty; a text whose every line goes becomes
empty; a chunk repeated inside one text keeps its first place there, and copies that overlap that
place stay; a very long text is one list of lines in its task, and what is sent on of it are its
chunks; rows equal in doc_id and text are one document and keep the same places; a null doc_id
comes before all others; an empty table gives no rows; all columns and rows of the input stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import dropped, stored, whole

LONG = 20
"""Words of a chunk, at least, unless the caller says otherwise."""
EDGE = 50
"""Words that a chunk is extended by to either side, about, at most."""
WIDE = 30
"""Characters without white space that count as one word at most."""
BASE = 1_000_003
MODULUS = (1 << 31) - 1


_WHITE = r"\s\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_DENSE = r"\x{0e00}-\x{0eff}\x{1000}-\x{109f}\x{1780}-\x{17ff}\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{20000}-\x{3ffff}"
"""Scripts without blanks: Thai, Lao, Burmese, Khmer, kana, Han."""
_BLANKS = rf"[{_WHITE}&&[^\n]]*+"
_WORD = rf"(?:[{_DENSE}]{{1,2}}+|[^{_WHITE}{_DENSE}]{{1,{WIDE}}}+)"
_UNUSUAL = r"[\x85\xa0\x{590}-\x{10ffff}]"
"""Scripts without blanks, white space beyond ASCII, and whatever is near them."""
_NEXT = rf"\n(?={_BLANKS}[^{_WHITE}])"
"""The line feed before a line that is not blank."""


def units(text: Column) -> Column:
    """The lines of a text, each with the blank lines after it; blank lines at the start are one of their own."""
    return F.split(text, _NEXT, -1)


def _bare(unit: Column) -> Column:
    return F.when(F.contains(unit, F.lit("\n")), F.regexp_replace(unit, r"\n\s*+\z", "")).otherwise(unit)


def _count(unit: Column, long: int) -> Column:
    """The words of a line, ``long`` for any line with so many."""
    # Without signs that need the patterns: the first words by plain white space, the rest of the line as the last one.
    parts = F.split(unit, r"\s+", long + 2)
    plain = F.aggregate(parts, F.lit(0), lambda s, w: s + F.floor((F.length(w) + (WIDE - 1)) / WIDE).cast("int"))
    return F.least(F.lit(long), F.when(unit.rlike(_UNUSUAL), F.regexp_count(unit, F.lit(_WORD))).otherwise(plain))


def _reach(words: Column, enough: int) -> Column:
    """How many of the first values add up to ``enough``; null if all of them do not."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
    step = lambda s, w: F.when(
        s["sum"] < enough, F.struct((s["sum"] + w).alias("sum"), (s["n"] + 1).alias("n"))
    ).otherwise(s)
    return F.aggregate(words, start, step, lambda s: F.when(s["sum"] >= enough, s["n"]))


def chunks(docs: DataFrame, long: int = LONG) -> DataFrame:
    """_id, _key and the chunks of every row of ``docs`` (_id, _text): _at (first line), _n (lines), _hash, and
    _before and _after, the hashes of the lines around it from the nearest outward."""
    text = whole(F.col("_text"))
    # Arrays that lambdas look into are columns that stand twice in the next step: the optimizer would
    # else put the whole expression into the lambda and compute it for each line.
    lined = docs.select("_id", F.xxhash64(text).alias("_key"), F.transform(units(text), _bare).alias("_units"))
    hashed = lined.select(
        "_id", "_key",
        F.transform("_units", lambda u: F.xxhash64(u)).alias("_lines"),
        F.transform("_units", lambda u: _count(u, long)).alias("_words"),
    )
    # Every line but blank ones at the start has a word, so a window has few lines.
    size = F.transform("_words", lambda w, i: F.when(w >= long, 1).otherwise(_reach(F.slice("_words", i + 1, long + 1), long)))
    sized = hashed.select("_id", "_key", "_lines", "_words", size.alias("_sizes"))
    roll = lambda s, h: (s * BASE + F.pmod(h, F.lit(MODULUS))) % MODULUS
    rolled = F.transform("_sizes", lambda n, i: F.when(n.isNotNull(), F.aggregate(F.slice("_lines", i + 1, n), F.lit(0).cast("long"), roll)))
    rolling = sized.select("_id", "_key", "_lines", "_words", "_sizes", rolled.alias("_rolled"))
    ahead = lambda n, i: F.slice("_rolled", i + 1, n)
    least = lambda n, i: i + F.array_position(ahead(n, i), F.array_min(ahead(n, i))).cast("int") - 1
    begins = F.transform("_sizes", lambda n, i: F.when(n == 1, i).when(n.isNotNull(), least(n, i)))
    cut = rolling.select("_id", "_key", "_lines", "_words", "_sizes", F.array_compact(F.array_distinct(begins)).alias("_begins"))

    def chunk(at):
        n = F.get("_sizes", at)
        far = F.lit(EDGE)
        back = lambda c: F.reverse(F.slice(c, F.greatest(at - far, F.lit(0)) + 1, F.least(at, far)))
        on = lambda c: F.slice(c, at + n + 1, far)
        some = lambda side: F.slice(side("_lines"), 1, F.coalesce(_reach(side("_words"), EDGE), far))
        return F.struct(
            at.alias("_at"), n.alias("_n"), F.xxhash64(F.slice("_lines", at + 1, n)).alias("_hash"),
            some(back).alias("_before"), some(on).alias("_after"),
        )

    # The outer form: for the plain one the optimizer adds a filter that computes the chunks once more.
    listed = cut.select("_id", "_key", F.explode_outer(F.transform("_begins", chunk)).alias("_chunk"))
    return listed.select("_id", "_key", "_chunk.*").where("_hash IS NOT NULL")


def _alike(a: Column, b: Column) -> Column:
    """How many values at the beginning of two arrays are the same."""
    other = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    return F.when(other == 0, F.size(a)).otherwise(other - 1).cast("int")


def _edges(met: DataFrame) -> DataFrame:
    """For each chunk place that stopped being like its first place: the lines up to each further one, by their hash."""

    def beyond(side: int, lines: str, alike: str) -> Column:
        depths = F.when(F.col(alike) < F.size(lines), F.sequence(F.col(alike) + 1, F.size(lines)))
        told = lambda d: F.struct(F.lit(side).alias("_side"), d.alias("_depth"), F.xxhash64(F.slice(lines, 1, d)).alias("_upto"))
        return F.coalesce(F.transform(depths, told), F.array().cast("array<struct<_side:int,_depth:int,_upto:bigint>>"))

    both = F.concat(beyond(-1, "_before", "_left"), beyond(1, "_after", "_right"))
    return met.select("_hash", "_id", "_key", "_at", "_n", F.explode(both).alias("_edge")).select("_hash", "_id", "_key", "_at", "_n", "_edge.*")


def repeated(docs: DataFrame, long: int = LONG) -> tuple[DataFrame, list[str]]:
    """_id, _key and the places of lines to remove, of every document that has some; and the folders used.

    ``docs`` holds _id and _text.
    """
    listed, chunks_path = stored(chunks(docs, long), "chunks")
    place = F.struct("_id", "_key", "_at", "_before", "_after")
    again = (
        listed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_times"), F.min(place).alias("_first")).where("_times > 1")
        .select(F.col("_hash").alias("_same"), "_first")
    )
    # Stored, so that the join is a stage of its own, in which Spark can split a common chunk.
    again, again_path = stored(again, "repeated-chunks")
    met = listed.join(again, F.col("_hash") == F.col("_same"))
    inside = F.col("_id").eqNullSafe(F.col("_first._id")) & (F.col("_key") == F.col("_first._key"))
    met = met.where(~inside | (F.col("_at") >= F.col("_first._at") + F.col("_n")))
    left, right = _alike(F.col("_before"), F.col("_first._before")), _alike(F.col("_after"), F.col("_first._after"))
    met, met_path = stored(met.select("*", left.alias("_left"), right.alias("_right")), "later-chunks")

    edges, edges_path = stored(_edges(met), "edges")
    same = ["_hash", "_side", "_depth", "_upto"]
    earlier = edges.groupBy(*same).agg(F.count(F.lit(1)).alias("_times"), F.min(F.struct("_id", "_key", "_at")).alias("_first"))
    earlier, earlier_path = stored(earlier.where("_times > 1").select(*[F.col(c).alias(f"_same{c}") for c in same], "_first"), "repeated-edges")
    further = edges.join(earlier, reduce(Column.__and__, [F.col(c) == F.col(f"_same{c}") for c in same]))
    further = further.where(~inside | (F.col("_at") >= F.col("_first._at") + F.col("_n") + F.col("_depth")))
    line = F.when(F.col("_side") > 0, F.col("_at") + F.col("_n") + F.col("_depth") - 1).otherwise(F.col("_at") - F.col("_depth"))

    # Lines against one first document that stand equally far from their originals are looked at together.
    by = ["_id", "_key", F.col("_first._id").alias("_first_id"), F.col("_first._key").alias("_first_key"), (F.col("_at") - F.col("_first._at")).alias("_shift")]
    run = F.sequence(F.col("_at") - F.col("_left"), F.col("_at") + F.col("_n") + F.col("_right") - 1)
    lines = met.select(*by, run.alias("_run")).unionByName(further.select(*by, F.array(line).alias("_run")))
    runs = lines.groupBy("_id", "_key", "_first_id", "_first_key", "_shift").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("_run")))).alias("_places"))
    runs = runs.withColumn("_originals", F.transform("_places", lambda p: p - F.col("_shift")))
    runs, runs_path = stored(runs, "repeated-runs")

    # The bytes of all lines to be compared, of later and of first documents, in one pass over the texts.
    mine, theirs = runs.select("_id", "_key", "_places"), runs.select(F.col("_first_id"), F.col("_first_key"), F.col("_originals"))
    wanted = mine.union(theirs).groupBy("_id", "_key").agg(F.collect_set("_places").alias("_wanted"))
    wanted = wanted.select(F.col("_id").alias("_of"), F.col("_key").alias("_with"), "_wanted")
    here = F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_key") == F.col("_with"))
    keyed = docs.select("_id", "_text", F.xxhash64(whole(F.col("_text"))).alias("_key"))
    # Merged at any size. Rows equal in id and text hold the same lines; one of them speaks for all.
    met = keyed.join(wanted.hint("merge"), here).groupBy("_id", "_key").agg(F.first("_wanted").alias("_wanted"), F.first("_text").alias("_text"))
    cut = met.select("_id", "_key", "_wanted", F.transform(units(whole(F.col("_text"))), _bare).alias("_units"))
    picked = F.transform("_wanted", lambda w: F.struct(w.alias("_places"), F.transform(w, lambda p: F.get("_units", p)).alias("_lines")))
    lines = cut.select("_id", "_key", F.size("_units"), F.explode(picked).alias("_w")).select("_id", "_key", "_w.*")
    lines, lines_path = stored(lines, "compared-lines")

    of_mine = F.col("r._id").eqNullSafe(F.col("m._id")) & (F.col("r._key") == F.col("m._key")) & (F.col("r._places") == F.col("m._places"))
    of_theirs = (
        F.col("r._first_id").eqNullSafe(F.col("t._id")) & (F.col("r._first_key") == F.col("t._key"))
        & (F.col("r._originals") == F.col("t._places")) & (F.col("m._lines") == F.col("t._lines"))
    )
    equal = runs.alias("r").join(lines.alias("m"), of_mine).join(lines.alias("t"), of_theirs).select("r._id", "r._key", "r._places")
    gone = equal.groupBy("_id", "_key").agg(F.array_distinct(F.flatten(F.collect_set("_places"))).alias("_gone"))
    return gone, [chunks_path, again_path, met_path, edges_path, earlier_path, runs_path, lines_path]


def without_repeats(docs: DataFrame, long: int = LONG) -> DataFrame:
    """``docs`` with repeated runs of at least ``long`` words taken out of ``text``; adds _removed, the number of their lines.

    That column is the last one, and has more underscores behind it if ``docs`` has one of its name.
    """
    removed = "_removed"
    while removed in docs.columns:
        removed += "_"
    named = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    gone, folders = repeated(named.select("_id", "_text"), long)
    gone, _ = stored(gone.select(F.col("_id").alias("_gone_id"), F.col("_key").alias("_gone_key"), "_gone"), "repeated-lines")
    dropped(docs.sparkSession, *folders)
    keyed = named.select("_row", "_id", "_text", F.xxhash64(whole(F.col("_text"))).alias("_text_key"))
    same = F.col("_id").eqNullSafe(F.col("_gone_id")) & (F.col("_text_key") == F.col("_gone_key"))
    joined = keyed.join(gone.hint("merge"), same, "left").select("_row", "_text", "_gone")
    touched = joined.select("_row", "_text", "_gone", F.when(F.col("_gone").isNotNull(), units(F.col("_text"))).alias("_units"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_units") - 1), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(F.transform(left, lambda i: F.get("_units", i)), "\n"))
    return touched.select(
        *[text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns],
        F.coalesce(F.size("_gone"), F.lit(0)).alias(removed),
    )

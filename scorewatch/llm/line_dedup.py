"""Repeated line runs by a suffix array over line-id sequences, DataFrame
operations only.

A text's non-blank lines form a sequence of 64-bit line ids. A run is a stretch
of consecutive lines of one document; a run of ``min_words`` words or more that
also begins earlier (at a smaller doc_id, or further up in the same document)
is a later copy, and its lines are deleted. Overlapping copies count.

1. Texts that are equal as a whole are one document for the suffix array: the
   copy with the smallest id stands for all, and later copies go whole if they
   have ``min_words`` words. A huge group of copies is so counted once.
2. Lines that occur once end every run; only repeated lines go on. Lines are told
   apart by 128 bits.
3. Distributed prefix doubling: ``rank_h`` of a position is its place in the
   order of all suffixes by their first h lines. ``rank_2h`` is the start of its
   ``rank_h`` bucket plus the number of bucket members whose ``rank_h`` h lines
   further on is smaller. Ranks come from counts of distinct pairs, so a very
   frequent line is pre-aggregated before it meets its bucket; the running counts
   of a bucket go over ranges of the following rank, so no window grows with it.
4. The suffixes that share m lines are an interval of the suffix array whose
   longest common prefix is m or more; it is named by m and the ranks of the
   first and the last 2^j <= m lines. Asking only for the windows that are just long
   enough for ``min_words`` (from each first line on, and to each last line)
   finds every line of every maximal run, so doubling ends at the depth of the
   longest such window, ``min_words`` lines at most. Of an interval, the first
   position stays; the others are later copies. Their windows merge into
   maximal runs.

Whatever a group is given back to its members (copies of a text, places of a
line, of a pair, of an interval) goes by shares: members are dealt over
``SHARES`` shares of their group, shares are added up before they meet, and each
share of a group joins its own members only.

Defined cases: null and empty texts have no lines and stay; blank lines
belong to no run but go with one that spans them; rows equal in id and text
are one document; rows of equal id and other text are ordered by text hash;
null ids come last; very long texts are many rows, one per line; an empty table
gives an empty result; extra columns, whatever their names, are kept by
``deduplicated`` and don't matter elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, texts

MIN_WORDS = 50
SHARES = 64  # a group's members meet what is known of the group in as many places
RANGE = 1 << 20  # ranks that one window runs over


def _key(text: Column, id_col: str, kind: str) -> Column:
    """A document's place in the order; equal for equal rows only."""
    return F.struct(F.col(id_col).isNull().alias("none"),
                    F.coalesce(F.col(id_col), F.lit(0 if kind in ("bigint", "int") else "").cast(kind)).alias("id"),
                    F.xxhash64(text).alias("hash"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    source = texts(docs, id_col, text_col)
    return source.withColumn("d", _key(F.col("text"), "doc_id", dict(source.dtypes)["doc_id"]))


def _n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+")).cast("long")


def _share(*member: str) -> Column:
    return F.pmod(F.xxhash64(*member), F.lit(SHARES)).cast("int").alias("share")


def _ends(rows: DataFrame, keys: list[str], member: Column) -> DataFrame:
    """keys, share, low, high: smallest and largest member of each group that has
    more than one, for every share of it that occurs."""
    group = Window.partitionBy(*keys)  # SHARES rows at most
    return (rows.groupBy(*keys, "share").agg(F.min(member).alias("low"), F.max(member).alias("high"))
            .withColumn("low", F.min("low").over(group)).withColumn("high", F.max("high").over(group))
            .filter("low <> high").drop("high"))


def copies(keyed: DataFrame) -> DataFrame:
    """d, and the first document with the same text, of every document that has
    an earlier copy."""
    digest = keyed.filter("text <> ''").select("d", F.md5(F.col("text").cast("binary")).alias("digest"), _share("d"))
    first = _ends(digest, ["digest"], F.col("d")).withColumnRenamed("low", "first")
    return digest.join(first, ["digest", "share"]).filter("d > first").select("d", "first").distinct()


def _lines(keyed: DataFrame) -> DataFrame:
    """d, i (index among non-blank lines), n (line number), line and line2 (its
    128 bits), w (words)."""
    numbered = F.transform(F.split("text", "\n"), lambda x, n: F.struct(n.alias("n"), x.alias("x")))
    return (keyed.select("d", F.posexplode(F.filter(numbered, lambda x: x["x"].rlike(r"\S"))).alias("i", "l"))
            .select("d", "i", F.col("l.n").alias("n"), F.xxhash64("l.x").alias("line"),
                    F.xxhash64(F.lit("line"), "l.x").alias("line2"), _n_words(F.col("l.x")).alias("w")))


def _first_ranks(lines: DataFrame) -> DataFrame:
    """line, line2, share, r: number of positions with a smaller line id, of
    repeated lines, for every share of a line that occurs. Ids are spread evenly, so
    fixed ranges of them are even too: 2^12 coarse ones, each of 2^12 fine ones."""
    line = Window.partitionBy("line", "line2")
    shared = (lines.groupBy("line", "line2", "share").agg(F.count("*").alias("c"))
              .withColumn("c", F.sum("c").over(line)).filter("c > 1"))
    counted = (shared.groupBy("line", "line2").agg(F.first("c").alias("c"))
               .withColumn("coarse", F.shiftright("line", 52)).withColumn("fine", F.shiftright("line", 40)))
    fine = counted.groupBy("coarse", "fine").agg(F.sum("c").alias("t"))
    coarse = fine.groupBy("coarse").agg(F.sum("t").alias("t"))  # 2^12 rows at most

    def before(name: str, *parts: str) -> Column:
        return F.coalesce(F.sum(name).over(Window.partitionBy(*parts[:-1]).orderBy(parts[-1])
                                           .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    coarse = coarse.select("coarse", before("t", "coarse").alias("base"))
    fine = fine.join(coarse, "coarse").select("fine", (F.col("base") + before("t", "coarse", "fine")).alias("base"))
    inside = Window.partitionBy("fine").orderBy("line", "line2").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counted.join(fine, "fine").select(
        "line", "line2", (F.col("base") + F.coalesce(F.sum("c").over(inside), F.lit(0))).alias("r"))
    return shared.select("line", "line2", "share").join(ranks, ["line", "line2"])


def _windows(rows: DataFrame, min_words: int) -> DataFrame:
    """d, s (first line's index), m: every window of consecutive repeated lines
    that has ``min_words`` words and would not have them without its first or
    without its last line."""
    chain = rows.withColumn("chain", F.col("i") - F.row_number().over(Window.partitionBy("d").orderBy("i")))
    along = Window.partitionBy("d", "chain").orderBy("i")
    start = F.sum("w").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")
    chain = chain.withColumn("at", start)
    # The lines that begin less than min_words words after this one's begin.
    near = Window.partitionBy("d", "chain").orderBy("at").rangeBetween(0, min_words - 1)
    rest = Window.partitionBy("d", "chain").orderBy("at").rowsBetween(0, Window.unboundedFollowing)
    sized = (chain.withColumn("m", F.count("*").over(near))
             .withColumn("long", F.max(F.col("at") + F.col("w")).over(near) - F.col("at") >= min_words)
             .withColumn("left", F.count("*").over(rest)))
    following = Window.partitionBy("d", "chain").orderBy("i")
    sized = sized.withColumn("next", F.when(F.lead("long").over(following), F.lead("m").over(following))
                             .otherwise(F.col("left")))
    return sized.filter("long").select("d", F.col("i").alias("s"),
                                       F.explode(F.sequence("m", F.greatest("m", "next"))).alias("m"))


def _doubled(ranks: DataFrame, h: int) -> DataFrame:
    """Ranks by 2h lines from ranks by h lines, of positions that have 2h."""
    along = Window.partitionBy("d").orderBy("i")
    pairs = (ranks.withColumn("r2", F.lead("r", h).over(along)).withColumn("i2", F.lead("i", h).over(along))
             .filter(F.col("i2") == F.col("i") + h).select("d", "i", "r", "r2"))
    pairs = pairs.withColumn("share", _share("d", "i"))
    pair = Window.partitionBy("r", "r2")
    shared = pairs.groupBy("r", "r2", "share").agg(F.count("*").alias("c")).withColumn("c", F.sum("c").over(pair))
    counted = (shared.groupBy("r", "r2").agg(F.first("c").alias("c"))
               .withColumn("range", F.floor(F.col("r2") / RANGE).cast("long")))
    # A bucket's followers are ranks, so a range of them has RANGE rows at most.
    earlier = Window.partitionBy("r").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (counted.groupBy("r", "range").agg(F.sum("c").alias("t"))
              .select("r", "range", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("base")))
    below = Window.partitionBy("r", "range").orderBy("r2").rowsBetween(Window.unboundedPreceding, -1)
    ordered = (counted.join(ranges, ["r", "range"])
               .select("r", "r2", (F.col("r") + F.col("base") + F.coalesce(F.sum("c").over(below), F.lit(0))).alias("new")))
    given = shared.select("r", "r2", "share").join(ordered, ["r", "r2"])
    return pairs.join(given, ["r", "r2", "share"]).select("d", "i", F.col("new").alias("r"))


def _covers(windows: DataFrame, rows: DataFrame) -> DataFrame:
    """d, s, m of the windows that are later copies, and the first position of
    their interval."""
    longest = windows.agg(F.max("m")).first()[0] or 0
    ranks, named, h = rows.select("d", "i", "r"), None, 1
    while h <= longest:
        mine = windows.filter((F.col("m") >= h) & (F.col("m") < 2 * h)).withColumn("t", F.col("s") + F.col("m") - h)
        found = (mine.join(ranks.select("d", F.col("i").alias("s"), F.col("r").alias("ra")), ["d", "s"])
                 .join(ranks.select("d", F.col("i").alias("t"), F.col("r").alias("rb")), ["d", "t"])
                 .select("d", "s", "m", "ra", "rb"))
        named = found if named is None else named.unionByName(found)
        h *= 2
        if h <= longest:
            ranks = checkpointed(_doubled(ranks, h // 2))
    if named is None:
        return windows.select("d", "s", "m", F.col("d").alias("first"))
    place = F.struct("d", "s")
    named = named.withColumn("share", _share("d", "s"))
    interval = _ends(named, ["m", "ra", "rb"], place)
    return (named.join(interval, ["m", "ra", "rb", "share"]).filter(place > F.col("low"))
            .select("d", "s", "m", F.col("low.d").alias("first")))


def _merged(covers: DataFrame, rows: DataFrame) -> DataFrame:
    """d, first_line, last_line, n_words, first: maximal runs of covered lines."""
    so_far = Window.partitionBy("d").orderBy("s", "m").rowsBetween(Window.unboundedPreceding, -1)
    islands = (covers.withColumn("e", F.col("s") + F.col("m"))
               .withColumn("new", F.when(F.col("s") <= F.max("e").over(so_far), 0).otherwise(1))
               .withColumn("run", F.sum("new").over(Window.partitionBy("d").orderBy("s", "m")))
               .groupBy("d", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min("first").alias("first")))
    lines = islands.select("d", "run", "first", F.explode(F.sequence("s", F.col("e") - 1)).alias("i"))
    return (lines.join(rows.select("d", "i", "n", "w"), ["d", "i"]).groupBy("d", "run")
            .agg(F.min("n").alias("first_line"), F.max("n").alias("last_line"), F.sum("w").alias("n_words"),
                 F.min("first").alias("first")))


def _found(keyed: DataFrame, min_words: int) -> DataFrame:
    again = checkpointed(copies(keyed))
    single = keyed.select("d", "text").join(again.select("d"), "d", "left_anti") if again.head(1) else keyed.select("d", "text")
    lines = _lines(single).withColumn("share", _share("d", "i"))
    rows = checkpointed(lines.join(_first_ranks(lines), ["line", "line2", "share"]).select("d", "i", "n", "w", "r").distinct())
    windows = checkpointed(_windows(rows, min_words))
    runs = _merged(_covers(windows, rows), rows).select("d", "first_line", "last_line", "n_words", "first")
    whole = (keyed.join(again, "d").distinct().withColumn("n_words", _n_words(F.col("text"))).filter(F.col("n_words") >= min_words)
             .select("d", F.lit(0).alias("first_line"), (F.size(F.split("text", "\n")) - 1).alias("last_line"), "n_words", "first"))
    return runs.unionByName(whole)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per maximal run that is a later copy: doc_id, first_line and
    last_line (from 0), n_words, first_doc_id (a document with an earlier copy)."""
    unset = lambda c: F.when(~F.col(f"{c}.none"), F.col(f"{c}.id"))
    return _found(_keyed(docs, id_col, text_col), min_words).select(
        unset("d").alias("doc_id"), F.col("first_line").cast("int").alias("first_line"),
        F.col("last_line").cast("int").alias("last_line"), F.col("n_words").cast("long").alias("n_words"),
        unset("first").alias("first_doc_id"))


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its columns, without the lines of later copies. A document
    of which no word is left goes; others stay, texts without a change as they were."""
    keyed = _keyed(docs, id_col, text_col)
    gone = (_found(keyed, min_words).groupBy("d")
            .agg(F.collect_list(F.struct("first_line", "last_line")).alias("_gone")).withColumnRenamed("d", "_d"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    joined = docs.withColumn("_d", _key(text, id_col, dict(docs.dtypes)[id_col])).join(gone, "_d", "left")
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, n: ~F.exists(
        "_gone", lambda g: n.between(g["first_line"], g["last_line"]))), "\n")
    changed = F.col("_gone").isNotNull()
    return (joined.withColumn(text_col, F.when(changed, kept).otherwise(F.col(text_col)))
            .filter(~changed | F.col(text_col).rlike(r"\S")).select(*docs.columns))

"""Mix sources to target weights by a low-discrepancy schedule of equal blocks of words.

Every source is a line of words: its documents in hashed order, laid end to end, the line repeated
for each epoch. The mix is a row of slots. Slot t has the golden-ratio point frac(t * phi); the point
falls into the cumulated targets and so names a source; the slot's rank among the slots of that source
names the block of the source's line that it takes. Any stretch of slots holds the sources close to
their weights, and each source is read from the start of its line without gaps.

Sources differ by many orders of magnitude, so one size of block for all would be too large for the smallest or too many for the
largest. Sources whose targets lie within a factor of ``SPREAD`` share a schedule, with blocks of their magnitude: each source has some ``BLOCKS`` to
``SPREAD * BLOCKS`` of them, whatever the number of sources and of words (a few of them empty where it has fewer words). The schedules run beside each other; ``at`` says
where in the mix, from 0 to 1, a slot lies. A source's target is cut into exactly as many blocks as it has slots, equal but
for one word, so the mix takes the target to the word.

All of it is DataFrame code. Places on a line are prefix sums over hash buckets, so a source with a third of all
documents is no single window; ranks and sums over sources go by stretches of sources; documents meet slots by (source, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadtide.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
EPOCHS = 3
BLOCKS = 256
SPREAD = 4
STRETCH = 4096  # sources
POINTS = 1 << 16  # slots made by one row
BUCKET_DIGITS = 3  # hex digits: 4096 stretches of each source's hashed order
GOLDEN = 2654435769  # 2**32 / golden ratio, so points are exact whole numbers


def words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def _numbered(sums: DataFrame) -> DataFrame:
    """``sums`` (source, source_size) with ``src``, the place by code point from 0, null last."""
    dealt = sums.withColumn("named", F.col("source").isNull())
    size = max(1, -(-sums.count() // STRETCH))
    dealt = dealt.repartitionByRange(size, "named", "source").withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "mix-names")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per stretch of sources
    counts = dealt.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("named", "source")) - 1 + F.col("first")
    return dealt.join(counts, "part").select("source", "source_size", place.cast("long").alias("src"))


def source_table(sized: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS, blocks: int = BLOCKS) -> DataFrame:
    """(src, source, source_size, target, own, kind, lo, total, sources, slots): one row per source of ``sized`` (source, size).

    Sources by code point, null last, weigh ``weights``, repeating. Targets share the total size by weight;
    a target stops at ``epochs`` times its source, and what it leaves is shared again, until none is above: one small
    aggregation per round. ``own`` is the target in whole words, ``kind`` the magnitude whose schedule the source is in, ``lo`` where its stretch
    of that schedule's cumulated targets begins, ``total`` their sum, ``sources`` their number and ``slots`` the schedule's length.
    """
    sums = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sums")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int")).cast("long")
    named = materialize(_numbered(sums).withColumns({"w": weight, "cap": F.col("source_size") * epochs}), "mix-weights")
    total = named.agg(F.sum("source_size")).first()[0] or 0
    level, stopped = 0.0, -1
    while True:
        stops = F.col("cap") <= F.lit(level) * F.col("w") if stopped >= 0 else F.lit(False)
        now = named.agg(F.count_if(stops).alias("n"), F.sum(F.when(stops, F.col("cap"))).alias("held"), F.sum(F.when(~stops, F.col("w"))).alias("open")).first()
        if now["n"] == stopped or not now["open"]:
            break
        stopped, level = now["n"], float(total - (now["held"] or 0)) / float(now["open"])
    stops = F.col("cap") <= F.lit(level) * F.col("w")
    out = named.withColumn("target", F.when(stops, F.col("cap").cast("double")).otherwise(F.lit(level) * F.col("w")))
    out = out.withColumn("own", F.round("target").cast("long"))
    # the power of SPREAD that is not above the target, by its digits in base two
    bits = F.length(F.bin("own")) - 1
    out = out.withColumn("kind", F.floor(bits / (SPREAD.bit_length() - 1)).cast("int"))
    out = out.withColumn("part", F.floor(F.col("src") / STRETCH))
    inside = Window.partitionBy("kind", "part").orderBy("src").rowsBetween(Window.unboundedPreceding, -1)
    sums = out.groupBy("kind", "part").agg(F.sum("own").alias("sum"), F.count("*").alias("n"))
    before = Window.partitionBy("kind").orderBy("part")
    whole = Window.partitionBy("kind")
    sums = sums.select(
        "kind", "part", (F.sum("sum").over(before) - F.col("sum")).alias("before"), F.sum("sum").over(whole).alias("total"), F.sum("n").over(whole).alias("sources")
    )
    out = out.withColumn("inside", F.coalesce(F.sum("own").over(inside), F.lit(0))).join(sums, ["kind", "part"])
    slots = F.ceil(F.col("total") * blocks / F.pow(F.lit(float(SPREAD)), "kind")).cast("long")
    return out.select(
        "src", "source", "source_size", "target", "own", "kind", (F.col("before") + F.col("inside")).alias("lo"), "total", "sources", slots.alias("slots")
    )


def _key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def bucket(doc_id: Column, seed: str = "mix") -> Column:
    """The stretch of its source's line that a document lies in; stretches follow each other by name."""
    return F.substring(_key(doc_id, seed), 1, BUCKET_DIGITS)


def lines(sized: DataFrame, sources: DataFrame, seed: str = "mix") -> DataFrame:
    """``sized`` (row, doc_id, source, size) with its source's columns and ``start``, its first word's place on the line."""
    sources = sources.select("src", "source", "source_size", "target", "own")
    known = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    known = known.withColumn("_key", _key(F.col("doc_id"), seed)).withColumn("_bucket", bucket(F.col("doc_id"), seed))
    known = materialize(known, "mix-keys")
    order = Window.partitionBy("src").orderBy("_bucket")
    sums = known.groupBy("src", "_bucket").agg(F.sum("size").alias("_sum"))
    before = sums.select("src", "_bucket", (F.sum("_sum").over(order) - F.col("_sum")).alias("_before"))
    inside = Window.partitionBy("src", "_bucket").orderBy("_key", "doc_id", "size", "row")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = known.withColumn("_at", F.sum("size").over(inside) - F.col("size"))
    return at.join(before, ["src", "_bucket"]).withColumn("start", F.col("_before") + F.col("_at")).drop("_key", "_bucket", "_at", "_before")


def schedule(sources: DataFrame) -> DataFrame:
    """(src, block, blocks, kind, slot, at): the slots of every source in order, and how many it has.

    A source has its share of its kind's slots but for two or three: at least ``BLOCKS`` and at most ``SPREAD`` times as many, about.
    """
    held = sources.where("own > 0")
    kinds = held.select("kind", "total", "sources", "slots").distinct()  # a few dozen
    firsts = kinds.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(POINTS).cast("long"))))
    last = F.least(F.col("first") + POINTS, F.col("slots")) - 1
    points = firsts.repartition("kind", "first").withColumn("slot", F.explode(F.sequence(F.col("first"), last)))
    point = F.pmod(F.col("slot") * F.lit(GOLDEN).cast("long"), F.lit(1 << 32)) / F.lit(float(1 << 32))
    points = points.withColumn("word", F.floor(point * F.col("total")))
    # as many cells as sources: a source of a kind spans a few cells, a cell few sources
    cell = lambda c: F.floor(c / F.col("total") * F.col("sources")).cast("long")
    spans = held.select("src", "own", "kind", "lo", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("lo") + F.col("own") - 1))).alias("cell"))
    at = ((F.col("slot") + 0.5) / F.col("slots")).alias("at")
    points = points.select("kind", "slot", "word", at, cell(F.col("word")).alias("cell"))
    hit = points.join(spans, ["kind", "cell"]).where("word >= lo and word < lo + own")
    mine = Window.partitionBy("src")
    rank = (F.row_number().over(mine.orderBy("slot")) - 1).cast("long")
    return hit.select("src", rank.alias("block"), F.count("*").over(mine).alias("blocks"), "kind", "slot", "at")


def placements(line: DataFrame, slots: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """(row, epoch, kind, slot, at, from_word, to_word): the stretches of documents that the mix takes.

    ``line`` comes from `lines`, ``slots`` from `schedule`. Block k of n holds the words of the line from floor(k * target / n) on, so the
    blocks hold the target and differ by one word at most. A document that spans several blocks
    has a row for each; words count from 0 and ``to_word`` isn't included.
    """
    blocks = slots.where("block = 0").select(F.col("src").alias("of"), "blocks")
    laid = line.where("size > 0 and own > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    laid = laid.withColumn("start", F.col("epoch") * F.col("source_size") + F.col("start")).where("start < own")
    laid = laid.join(blocks, F.col("src") == F.col("of")).drop("of")
    block = lambda c: F.floor(((c + 1) * F.col("blocks") - 1) / F.col("own")).cast("long")
    edge = lambda k: F.floor(k * F.col("own") / F.col("blocks")).cast("long")
    end = F.least(F.col("start") + F.col("size"), F.col("own"))
    laid = laid.withColumn("block", F.explode(F.sequence(block(F.col("start")), block(end - 1))))
    laid = laid.select("row", "src", "epoch", "block", "start", end.alias("end"), edge(F.col("block")).alias("lo"), edge(F.col("block") + 1).alias("hi"))
    met = laid.join(slots.select("src", "block", "kind", "slot", "at"), ["src", "block"])
    first = F.greatest("start", "lo") - F.col("start")
    last = F.least("end", "hi") - F.col("start")
    return met.select("row", "epoch", "kind", "slot", "at", first.alias("from_word"), last.alias("to_word"))


def sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(row, doc_id, source, size), written once so that ``row`` holds."""
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words(F.col(text_col)).alias("size"))
    return materialize(out.withColumn("row", F.monotonically_increasing_id()), "mix-sizes")


def mix(sized: DataFrame, weights: tuple = WEIGHTS, epochs: int = EPOCHS, blocks: int = BLOCKS, seed: str = "mix"):
    """(lines, placements) of ``sized`` (row, doc_id, source, size), see the functions of these names.

    Every row of ``sized`` is on its source's line once, repeated rows included. Sizes of 0 and sources
    without words are on the line but never placed. Rows of the same doc_id follow one another; a null
    doc_id counts as an empty one. Equal input gives an equal mix, whatever the partitions.
    """
    sources = materialize(source_table(sized, weights, epochs, blocks), "mix-sources")
    line = materialize(lines(sized, sources, seed), "mix-lines")
    return line, placements(line, materialize(schedule(sources), "mix-slots"), epochs)


def taken(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (of its source), taken (words, repeats counted)."""
    line, placed = mix(sizes(docs), **options)
    got = placed.groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    out = line.join(got, "row", "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

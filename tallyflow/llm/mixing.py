"""Mixing sources to target weights: fixed-length blocks, random source counts per output shard, index permutations. Native expressions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyflow.llm.common import cut, let, small_side, words_of

#: Rows that a window over a share of a source holds, about.
CHUNK = 1024
#: Blocks that a source has at least, if it has as many words: a smaller source has shorter blocks, so that whole blocks come near its target.
PARTS = 64
#: Half rounds of the permutation of block indexes, and steps that it may take until it is back inside them.
ROUNDS, STEPS = 6, 70
PLACES = "array<struct<shard:bigint,slot:int,words:bigint>>"


def targets(sizes: DataFrame, share: float = 1.5, weights: tuple[float, ...] = (3, 1, 2), cap: float = 2.0) -> DataFrame:
    """``sizes`` (source, source_size) with source_no (from 0, by code point, null last), weight and target.

    The targets sum to ``share`` of all sizes, in proportion to the weights, which repeat over the sources; a target stops at
    ``cap`` times its source's size and the rest is shared again. Solved at once: in the order of size per weight, the sources
    before the first one that stays below its cap are full. The windows run over one row for each source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    numbered = sizes.withColumn("source_no", F.row_number().over(order) - 1).withColumn("weight", w).withColumn("full", cap * F.col("source_size"))
    by_fill = Window.orderBy(F.col("full") / F.col("weight"), "source_no")
    filled = numbered.select(
        "*",
        F.coalesce(F.sum("full").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("before"),
        F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        (F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) * share).alias("total"),
    )
    level = F.greatest((F.col("total") - F.col("before")) / F.col("open"), F.lit(0.0))
    everywhere = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    leveled = filled.withColumn("level", F.min(F.when(level * F.col("weight") <= F.col("full"), F.struct(F.col("full") / F.col("weight"), F.col("source_no"), level.alias("level")))).over(everywhere)["level"])
    return leveled.select("source", "source_no", "source_size", F.least("full", F.coalesce(F.col("level") * F.col("weight"), F.col("full"))).alias("target"))


def placed(docs: DataFrame, block: int, **how) -> tuple[DataFrame, DataFrame]:
    """The documents with their place in their source's stream of words, and the table of the sources. A source's blocks have ``block`` words (width), or, in a small source, a 64th of its words and at least one.

    A stream's order is that of a hash share, then of the id and the text's hash: sums within a share, then of the shares before, so that no task
    orders a whole source. Only equal rows tie.
    """
    sized = cut(docs.select("*", F.size(words_of(F.col("text"))).cast("long").alias("size")).drop("text"))
    chunks = max(1, -(-sized.count() // CHUNK))
    sized = sized.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "mark", F.lit(1)), F.lit(chunks)))
    shares = sized.groupBy("source", "chunk").agg(F.sum("size").alias("words"))
    sources = targets(shares.groupBy("source").agg(F.sum("words").alias("source_size")), **how)
    width = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.col("source_size") / PARTS))).cast("long")
    blocks = F.ceil(F.col("source_size") / F.col("width")).cast("long")
    sources = cut(sources.withColumn("width", width).withColumn("blocks", blocks).withColumn("slots", F.when(F.col("source_size") > 0, F.least(2 * blocks, F.round(F.col("target") * blocks / F.col("source_size")).cast("long"))).otherwise(0)))
    known = small_side(sources)
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("source", "chunk", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("ahead")).alias("a").join(known.alias("b"), F.expr("a.source <=> b.source")).select("a.source", "chunk", "ahead", "source_no", "source_size", "target", "width")
    within = Window.partitionBy("source", "chunk").orderBy("doc_id", "mark", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = rows.alias("a").join(shares.alias("b"), F.expr("a.source <=> b.source and a.chunk = b.chunk"))
    return joined.select("a.*", "source_no", "source_size", "target", "width", (F.col("ahead") + F.col("inside")).alias("start")).drop("chunk", "inside"), sources


def permuted(index, size, *key):
    """Column: where a permutation of 0 to size-1, drawn by ``key``, takes ``index``.

    A keyed Feistel network over two digits, each about the root of ``size``; a place behind the end is mapped on until it is
    inside. Up to 4096 the steps always suffice; beyond that a step leads outside with a chance below 1 in 64.
    """
    wide = F.ceil(F.sqrt(size.cast("double"))).cast("long")

    def once(x):
        start = F.struct(F.floor(x / wide).cast("long").alias("l"), (x % wide).alias("r"), F.ceil(size / wide).cast("long").alias("a"), wide.alias("b"))
        step = lambda s, i: F.struct(s["r"].alias("l"), F.pmod(s["l"] + F.pmod(F.xxhash64(*key, i, s["r"]), s["a"]), s["a"]).alias("r"), s["b"].alias("a"), s["a"].alias("b"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["l"] * wide + s["r"])

    return F.aggregate(F.sequence(F.lit(2), F.lit(STEPS)), once(index), lambda x, _: F.when(x < size, x).otherwise(once(x)))


def draws(sources: DataFrame, total: int, shard_slots: int, seed: int) -> DataFrame:
    """(shard, slot, source_no) for ``total`` slots: the counts of a shard's sources are a multinomial draw, slot for slot by the inverse of the distribution.

    The distribution is cut into as many equal parts as there are sources, so that a slot meets only the sources of its part:
    two on average.
    """
    parts = sources.count()
    order = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, 0)  # one row for each source
    to = F.sum("slots").over(order)
    ends = sources.where("slots > 0").select("source_no", "slots", to.alias("to"))
    spans = ends.select("source_no", "to", F.explode(F.sequence(F.floor((F.col("to") - F.col("slots")) * parts / total).cast("long"), F.floor((F.col("to") - 1) * parts / total).cast("long"))).alias("part"))
    guide = cut(spans.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("to", "source_no"))).alias("ends")))
    at = F.pmod(F.xxhash64(F.lit(seed), "id", F.lit(3)), F.lit(total))
    rows = sources.sparkSession.range(total).select((F.col("id") / shard_slots).cast("long").alias("shard"), (F.col("id") % shard_slots).cast("int").alias("slot"), at.alias("at"))
    rows = rows.withColumn("part", F.floor(F.col("at") * parts / total).cast("long")).join(small_side(guide), "part")
    return rows.select("shard", "slot", F.get(F.filter("ends", lambda x: x["to"] > F.col("at")), F.lit(0))["source_no"].alias("source_no"))


def slots(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """(source_no, copy, block, shard, slot): one row for each block that the mix takes, with its place in the output.

    Each output shard draws how many of its ``shard_slots`` slots go to each source. The slots of a source are numbered on
    from shard to shard. Draws vary, targets do not: numbers beyond a source's slots pass to the sources that drew too few.
    Number i of a source takes, in pass i div blocks, the block to which that pass's permutation maps i mod blocks.
    """
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    drawn = cut(draws(sources, total, shard_slots, seed)) if total else sources.sparkSession.createDataFrame([], "shard long, slot int, source_no int")
    counts = drawn.groupBy("source_no", "shard").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("source_no", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    within = F.row_number().over(Window.partitionBy("shard", "source_no").orderBy("slot")) - 1
    known = small_side(sources.select("source_no", "blocks", "slots"))
    numbered = drawn.withColumn("within", within).join(ahead, ["source_no", "shard"]).join(known, "source_no")
    numbered = cut(numbered.select("source_no", "shard", "slot", "blocks", "slots", (F.col("ahead") + F.col("within")).alias("number")))
    sums = sources.select("source_no", "blocks", "slots").join(counts.groupBy("source_no").agg(F.sum("n").alias("n")), "source_no", "left")
    sums = sums.select("source_no", "blocks", F.coalesce("n", F.lit(0)).alias("n"), "slots")
    below = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)  # one row for each source
    over = sums.select("source_no", F.coalesce(F.sum(F.greatest(F.col("n") - F.col("slots"), F.lit(0))).over(below), F.lit(0)).alias("base"))
    lack = sums.select("source_no", "blocks", "n", "slots", F.coalesce(F.sum(F.greatest(F.col("slots") - F.col("n"), F.lit(0))).over(below), F.lit(0)).alias("base"))
    left = numbered.where("number >= slots").join(over, "source_no").select("shard", "slot", (F.col("base") + F.col("number") - F.col("slots")).alias("turn"))
    wanted = lack.where("slots > n").select("source_no", "blocks", "n", "base", F.explode(F.sequence("n", F.col("slots") - 1)).alias("number")).select("source_no", "blocks", "number", (F.col("base") + F.col("number") - F.col("n")).alias("turn"))
    names = ["source_no", "blocks", "number", "shard", "slot"]
    each = numbered.where("number < slots").select(*names).union(wanted.join(left, "turn").select(*names))
    copy = F.floor(F.col("number") / F.col("blocks")).cast("long")
    mapped = permuted(F.col("number") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("source_no"), copy)
    return each.select("source_no", copy.alias("copy"), mapped.alias("block"), "shard", "slot")


def taken_parts(rows: DataFrame, sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """(start, source_no, doc_id, mark, size, ..., copy, shard, slot, from, words) for each part of a document that a drawn block holds."""
    first, last = F.floor(F.col("start") / F.col("width")), F.floor((F.col("start") + F.col("size") - 1) / F.col("width"))
    parts = rows.where("size > 0").select("*", F.explode(F.sequence(first, last)).alias("block"))
    low, high = F.greatest("start", F.col("block") * F.col("width")), F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * F.col("width"))
    parts = parts.withColumn("from", low - F.col("start")).withColumn("words", high - low)
    return parts.join(slots(sources, shard_slots, seed).hint("merge"), ["source_no", "block"])  # both sides grow with the input


def mix_shares(docs: DataFrame, block: int = 256, shard_slots: int = 1024, seed: int = 17, **how) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source; other columns are ignored): doc_id, size, source_size, target, taken, places.

    size counts the words between space and U+0009 to U+000D. Each source's words, document after document, are packed into
    blocks of ``block`` words (of a 64th of a source, if that is less); the mix takes whole blocks, each at most twice. places
    has the shard, the slot in it and the number of words for each block with words of the document. Null and blank texts have size 0 and are never
    taken. A null source is a source; rows without doc_id are mixed like others. Repeated rows are rows of their own: as they
    tie, what is taken of each may change hands between equal rows, so that reruns agree on the rows in whatever layout. A very long text costs its own row alone.
    """
    rows, sources = placed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("mark")), block, **how)
    rows = cut(rows)
    taken = taken_parts(rows, sources, shard_slots, seed).groupBy("source_no", "start").agg(F.sum("words").alias("words"), F.sort_array(F.collect_list(F.struct("shard", "slot", "words"))).alias("places"))
    some = rows.where("size > 0").join(taken, ["source_no", "start"], "left")
    none = rows.where("size = 0").withColumn("words", F.lit(0).cast("long")).withColumn("places", F.array().cast(PLACES))
    out = some.select(*none.columns).union(none)
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"), F.coalesce("places", F.array().cast(PLACES)).alias("places"))


def mix_documents(docs: DataFrame, block: int = 256, shard_slots: int = 1024, seed: int = 17, places: bool = False, **how) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: for each document and pass (at most two) a row whose text holds, in order and with the white space after them, the words of its drawn blocks. n_chars, where there is such a column, is the new length. Documents of which nothing is taken go. Identical repeated rows count as that many documents of one text. With ``places`` a column of that name follows (in the place of one that is there): shard, slot and number of words for each drawn block, as in ``mix_shares``. Other columns, whatever their names, are kept. Null and blank texts go, as nothing is taken of them; rows without doc_id or source are mixed like others; an empty table gives none."""
    marked = docs.withColumn("__mark", F.xxhash64("text"))
    rows, sources = placed(marked.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"), F.col("__mark").alias("mark")), block, **how)
    parts = taken_parts(cut(rows), sources, shard_slots, seed)
    drawn = parts.groupBy("source_no", "start", "copy", "doc_id", "mark", "source").agg(F.sort_array(F.collect_list(F.struct("from", "words", "shard", "slot"))).alias("__parts"))
    units = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*)"), F.lit(1))
    text = let(units, lambda u: F.array_join(F.flatten(F.transform("__parts", lambda p: F.slice(u, (p["from"] + 1).cast("int"), p["words"].cast("int")))), ""))
    # Texts are shuffled and sorted once: by keys without nulls, by which equal rows are told and the drawn parts joined.
    keys = lambda mark: {"__id": F.coalesce("doc_id", F.lit(0)).cast("long"), "__known": F.col("doc_id").isNotNull(), "__source": F.coalesce(F.col("source").cast("string"), F.lit("")), "__named": F.col("source").isNotNull(), "__text": F.col(mark)}
    names = list(keys("mark"))
    turn = F.count("*").over(Window.partitionBy(*names).rowsBetween(Window.unboundedPreceding, 0))
    originals = marked.where("text is not null").withColumns(keys("__mark")).withColumn("__turn", turn).where("__turn = 1")
    joined = originals.hint("merge").join(drawn.withColumns(keys("mark")).select(*names, "__parts"), names).select(*docs.columns, "__parts")
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    where = [F.transform("__parts", lambda p: F.struct(p["shard"].alias("shard"), p["slot"].alias("slot"), p["words"].alias("words"))).alias("places")]
    return out.select(*[c for c in docs.columns if c != "places" or not places], *(where if places else []))

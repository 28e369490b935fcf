"""Mixing sources to target weights: blocks of words, drawn per output shard and joined by index.

The words of a source form one stream, packed into blocks of ``BLOCK`` words.  A source with target t and size n takes
t div n whole passes over its blocks and a partial one; the last block of a partial pass is cut short, so that the
words taken equal the rounded target.  Draws of all sources are dealt to output slots by a keyed permutation: the
counts of the sources in a shard are multinomial, conditional on the sources' totals over all shards, which keeps
every source at its target.  The k-th draw of a source in a pass is the block at index permutation(k), another keyed
permutation of the source's blocks, and slots and blocks meet in a join by (source, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricemill.llm.common import WORD, chunks_for, keep, running_total

BLOCK = 256  # words
SLOTS = 4096  # blocks in an output shard
SHARE = 1.5  # words taken, as a share of all words
MOST = 2  # passes over a source at most
WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
SEED = 20
DRAWS_PER_ROW = 10_000
WALK = 64
PLACE = ("mix_shard", "mix_slot", "mix_at")  # output shard, slot in it, and first word in the slot's block


def permutation(x: Column, n: Column, *salt: Column) -> Column:
    """The image of x under a keyed permutation of 0 .. n - 1.

    Four Feistel rounds over a grid of rows x columns >= n cells; cells from n on are walked through until one below n
    is met.  A walk has at most rows * columns - n + 1 steps, which WALK covers for n < 4,096; above, a step leaves the
    range with a probability below 1/64, and WALK steps in a row do so with one below 1e-115.
    """
    rows = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    columns = F.ceil(n.cast("double") / rows).cast("long")

    def mixed(kind: Column, value: Column) -> Column:
        key = [F.lit(SEED), *salt, kind, value]
        return F.crc32(F.concat_ws(":", *[k.cast("string") for k in key]))

    def turn(pair: Column, kind: Column) -> Column:
        low, high = pair["l"], pair["r"]
        return F.struct(
            F.when(kind % 2 == 0, (low + mixed(kind, high)) % rows).otherwise(low).alias("l"),
            F.when(kind % 2 == 1, (high + mixed(kind, low)) % columns).otherwise(high).alias("r"))

    def step(v: Column) -> Column:
        cell = F.struct(F.floor(v / columns).cast("long").alias("l"), (v % columns).cast("long").alias("r"))
        turns = F.array(*[F.lit(k) for k in range(4)])
        return F.aggregate(turns, cell, turn, lambda pair: pair["l"] * columns + pair["r"])

    walk = F.sequence(F.lit(1), F.least(rows * columns - n + 1, F.lit(WALK)).cast("int"))
    return F.aggregate(walk, step(x), lambda at, _: F.when(at < n, at).otherwise(step(at)))


def source_targets(sized: DataFrame) -> DataFrame:
    """``sid, source, source_size, target`` of ``sized(source, size)``; sources by code point, null last.

    target = min(MOST * size, level * weight), with the level at which the targets add up to SHARE of all sizes: what
    is cut off at MOST times a size goes to the other sources by weight.
    """
    sources = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), ((F.col("sid") - 1) % len(WEIGHTS) + 1).cast("int"))
    sources = sources.withColumn("sid", F.row_number().over(ordered)).withColumn("weight", weight)
    sources = sources.withColumn("cap", MOST * F.col("source_size"))
    sources = sources.withColumn("ratio", F.col("cap") / F.col("weight"))
    rising = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (SHARE * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(rising), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(rising), F.lit(0)))
    sources = sources.withColumn("_level", level)
    free = F.max(F.when(F.col("ratio") > F.col("_level"), F.col("_level"))).over(every)
    target = F.least(F.col("cap").cast("double"), F.coalesce(free * F.col("weight"), F.col("cap").cast("double")))
    return sources.select("sid", "source", "source_size", target.alias("target"))


def draws(sources: DataFrame) -> DataFrame:
    """One row per drawn block: ``shard, slot, sid, pass, block, words`` (the first ``words`` words of the block)."""
    size, take = F.col("source_size"), F.col("take")
    plan = sources.where("source_size > 0").withColumn("take", F.floor(F.col("target") + 0.5).cast("long"))
    plan = plan.select(
        "sid", size, F.floor(size / BLOCK).cast("long").alias("full"), F.ceil(size / BLOCK).cast("long").alias("blocks"),
        F.floor(take / size).cast("long").alias("passes"), (take % size).alias("rest"),
    ).withColumn("n", F.col("passes") * F.col("blocks") + F.ceil(F.col("rest") / BLOCK).cast("long"))
    ordered = Window.orderBy("sid")
    plan = plan.withColumn("first", F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
    plan = plan.withColumn("all", F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    # a hot source has most of the draws: its range is dealt out in pieces before it is spelled out; to a fixed number of
    # partitions, as few bytes of pieces, which would be put together in one task, are many draws
    pieces = plan.where("n > 0").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(DRAWS_PER_ROW).cast("long"))).alias("from"))
    pieces = pieces.repartition(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    drawn = pieces.select("*", F.explode(F.sequence("from", F.least(F.col("from") + DRAWS_PER_ROW, F.col("n")) - 1)).alias("draw"))
    drawn = drawn.withColumn("pass", F.floor(F.col("draw") / F.col("blocks")).cast("long"))
    drawn = drawn.withColumn("k", F.col("draw") % F.col("blocks"))
    block = F.when(F.col("k") < F.col("full"), permutation(F.col("k"), F.col("full"), F.col("sid"), F.col("pass"))).otherwise(F.col("full"))
    length = F.when(F.col("k") < F.col("full"), F.lit(BLOCK)).otherwise(F.col("source_size") - F.col("full") * BLOCK)
    wanted = F.when(F.col("pass") < F.col("passes"), length).otherwise(F.least(length, F.col("rest") - F.col("k") * BLOCK))
    place = permutation(F.col("first") + F.col("draw"), F.col("all"), F.lit("out"))
    return drawn.select("sid", "pass", block.alias("block"), wanted.cast("long").alias("words"), place.alias("place")).select(
        F.floor(F.col("place") / SLOTS).cast("long").alias("shard"), (F.col("place") % SLOTS).alias("slot"),
        "sid", "pass", "block", "words")


def place_documents(sized: DataFrame, sources: DataFrame, rows: int, order: list[Column]) -> DataFrame:
    """``sized(doc_id, source, size, ...)`` with ``sid``, ``source_size``, ``target``, ``start`` (the first word's
    index in the stream of the source) and ``row`` (unique within the source)."""
    small = sources.select(F.col("source").alias("_source"), "sid", "source_size", "target")
    joined = sized.join(small, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return running_total(joined, F.col("size"), "sid", order, chunks_for(rows), "doc_id", "start", "row")


def pieces_of(placed: DataFrame, drawn: DataFrame) -> DataFrame:
    """Per document, block and draw of the block: ``sid, row, shard, slot, at, from, to``, a span of the document's words and
    where in the mix it goes: from word ``at`` on of the block in that slot of the shard."""
    start, end = F.col("start"), F.col("start") + F.col("size")
    parts = placed.where("size > 0").select(
        "sid", "row", "start", end.alias("end"),
        F.explode(F.sequence(F.floor(start / BLOCK).cast("long"), F.floor((end - 1) / BLOCK).cast("long"))).alias("block"))
    # merged: the draws grow with the words, but look as small as the pieces that they are spelled out from, and would be broadcast
    uses = drawn.select("sid", "block", "words", "shard", "slot").hint("merge")
    met = parts.join(uses, ["sid", "block"])
    first = F.greatest(F.col("start"), F.col("block") * BLOCK)
    last = F.least(F.col("end"), F.col("block") * BLOCK + F.col("words"))
    return met.select(
        "sid", "row", "shard", "slot", (first - F.col("block") * BLOCK).alias("at"), (first - F.col("start")).alias("from"),
        (last - F.col("start")).alias("to")).where(F.col("to") > F.col("from"))


def spans_of(placed: DataFrame, drawn: DataFrame) -> DataFrame:
    """Per document of which something is taken: ``sid, row, taken, spans``; spans in the order of the mix."""
    spans = F.sort_array(F.collect_list(F.struct("shard", "slot", "at", "from", "to")))
    return pieces_of(placed, drawn).groupBy("sid", "row").agg(F.sum(F.col("to") - F.col("from")).alias("taken"), spans.alias("spans"))


def sized_documents(docs: DataFrame, *more: str) -> DataFrame:
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), *more)


def mix(docs: DataFrame) -> DataFrame:
    """Every row of ``docs(doc_id, text, source)`` with the words that the mix takes of it: how many, and as ``spans`` the shard,
    slot, first word in the slot's block, and words (from, to) of the document.

    A null or empty text has size 0 and nothing taken; a null source is a source of its own.  Rows that repeat, doc_id
    included, are separate rows of the stream.  An empty table gives an empty result; further columns are ignored.
    """
    sized = keep(sized_documents(docs))
    sources = keep(source_targets(sized))
    placed = keep(place_documents(sized, sources, sized.count(), [F.col("doc_id"), F.col("size")]))
    taken = spans_of(placed, draws(sources))
    none = F.array().cast(taken.schema["spans"].dataType)
    return placed.join(taken, ["sid", "row"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("spans", none).alias("spans"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix: one row per shard, slot and document span in the slot's block, with the columns of ``docs`` and PLACE.

    By (mix_shard, mix_slot, mix_at) the rows are in the order of the mix.  A span of a whole document keeps its text as it is;
    otherwise text has the words of the span, joined by one space.  n_chars counts them.  Documents of which nothing is taken
    are left out; columns of ``docs`` named as those of PLACE are replaced.

    So null and empty texts, which have no words, are left out; a null source is a source, the last one.  Long texts are cut into spans
    of blocks.  Repeated rows, and rows that repeat a doc_id or have none, are documents of their own, each taken twice at most.
    An empty table gives an empty result.
    """
    columns = [c for c in docs.columns if c not in PLACE]
    whole = sized_documents(docs, F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"))
    sources = keep(source_targets(keep(sized_documents(docs).groupBy("source").agg(F.sum("size").alias("size")))))
    order = [F.col("doc_id"), F.col("size"), F.xxhash64("doc")]
    placed = place_documents(whole, sources, docs.count(), order)
    narrow = keep(placed.select("sid", "row", "start", "size"))
    met = placed.join(spans_of(narrow, draws(sources)), ["sid", "row"])
    words = F.regexp_extract_all(F.col("doc.text"), F.lit(WORD), F.lit(0))

    def piece(all_words: Column, s: Column) -> Column:
        some = F.array_join(F.slice(all_words, (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int")), " ")
        text = F.when(s["to"] - s["from"] == F.col("size"), F.col("doc.text")).otherwise(some)
        return F.struct(s["shard"].alias("shard"), s["slot"].alias("slot"), s["at"].alias("at"), text.alias("text"))

    # the words of a text are found once for all its spans
    pieces = F.transform(F.array(words), lambda all_words: F.transform("spans", lambda s: piece(all_words, s)))[0]
    rest = F.struct(*[F.col(f"doc.`{c}`") for c in columns if c != "text"])
    made = met.select(rest.alias("others"), F.explode(pieces).alias("piece"))
    return made.select(
        *[F.col("piece.text") if c == "text" else F.length("piece.text").cast("long").alias(c) if c == "n_chars" else F.col(f"others.`{c}`")
          for c in columns],
        *[F.col(f"piece.{k}").alias(c) for k, c in zip(("shard", "slot", "at"), PLACE, strict=True)])

"""Mixing sources to target weights by a hypergeometric splitting tree (native).

Each source gets a target of words. A source's words are cut into blocks: its records
are dealt by hash to blocks of about ``block_words`` words, and one epoch of the source
takes every block once. A target of 1.4 sources is one whole epoch and 0.4 of the blocks
of the next, in a permuted order; the last block is taken up to the exact word, so each
source's words meet its target exactly. Which output shard gets how many blocks of each
source is drawn by a splitting tree: starting from all shards, the shards of a node are
halved and the node's block counts are split by a multivariate hypergeometric draw, one
source after the other, each given what is left. At the leaves the counts are exact
quotas, and the shards draw disjoint ranges of each source's permuted blocks; rows are
shuffled within their shard by hash.

All randomness is a hash of the seed and of ids, so reruns agree. Sources are ordered by
code point, a null source last; the table of sources is small (one row per source, tens or
hundreds of them) and is all that a node of the tree holds. The tree is written every few
levels, so its nodes are dealt to tasks, and blocks are put in order by ranges of their
hashes, so no task orders a source's blocks alone. Null texts and texts without words have size 0 and are never
taken. Repeated rows (equal id and text) fall into one block and are taken as the rows
they are. A null id hashes like a value. Other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from landspark.llm.common import plainly_named, Scratch, content_key, materialize

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Ranges of hashes by which a source's blocks are put in order, and levels of the tree from one table to the next.
RANGES, LEVELS = 1024, 6
#: Words of an output shard, by which the number of shards follows the mix, and the fewest shards.
SHARD_WORDS, LEAST_SHARDS = 4_000_000, 16


def source_targets(sized: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """``source, place, source_size, target`` of each source of ``source, size``.

    The targets share ``share`` of all words by weight. A source's target stops at
    ``most`` times its size and the excess goes to the others by weight. In order of the
    level at which they fill up, a source is full if its level is below what is left for
    it and all later ones, so one running sum gives what repeated resharing would.
    """
    found = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = W.partitionBy(F.lit(0))
    found = (
        found.withColumn("place", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("place", F.lit(len(weights))) + 1))
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
    )
    order = every.orderBy(F.col("cap") / F.col("weight"), "place")
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    found = (
        found.withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.sum("weight").over(rest))
        .withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
        # the level of the first source that isn't full holds for all after it
        .withColumn("open_level", F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(every)["level"])
    )
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("open_level") * F.col("weight"))
    return found.select("source", "place", "source_size", target.alias("target"))


def _log_factorial(x: Column) -> Column:
    """ln(x!) by Stirling's series, shifted by 8."""
    z = x + 9.0
    product = x + 1.0
    for k in range(2, 9):
        product = product * (x + float(k))
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return series - F.log(product)


def _hypergeometric(seed: Column, total: Column, own: Column, draws: Column) -> Column:
    """How many of ``draws`` out of ``total`` blocks are among the ``own`` ones.

    A draw of the exact distribution: the largest of log-probability plus Gumbel noise
    over all counts within 12 deviations of the mean (what lies outside has less
    probability than a double resolves).
    """
    mean = draws * own / F.greatest(total, F.lit(1.0))
    spread = 12 * F.sqrt(mean * F.greatest(1 - own / F.greatest(total, F.lit(1.0)), F.lit(0.0)) + 1) + 12
    low = F.greatest(F.lit(0.0), draws + own - total, F.floor(mean - spread))
    high = F.least(own, draws, F.ceil(mean + spread))

    def scored(k: Column) -> Column:
        logp = -(_log_factorial(k) + _log_factorial(own - k) + _log_factorial(draws - k) + _log_factorial(total - own - draws + k))
        u = (F.pmod(F.xxhash64(seed, k), F.lit(1 << 52)) + 0.5) / float(1 << 52)
        return F.struct((logp - F.log(-F.log(u))).alias("score"), k.alias("k"))

    return F.array_max(F.transform(F.sequence(low.cast("long"), high.cast("long")), lambda k: scored(k.cast("double"))))["k"]


def splitting_tree(quotas: DataFrame, shards: int, seed: int, write: Callable = materialize) -> DataFrame:
    """``shard, place, n, first``: how many blocks of each source every shard gets.

    ``quotas`` has ``place, n``, one row per source. ``first`` is the rank of the shard's
    first block among the source's drawn blocks. All shards get equally many blocks but
    for rounding. Nodes are written and dealt anew every ``LEVELS`` levels.
    """
    sources = F.array_sort(F.collect_list(F.struct(F.col("place").cast("long").alias("place"), F.col("n").cast("double").alias("n"))))
    node = quotas.agg(sources.alias("counts")).select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "counts")
    level = 0
    while shards > 1:
        level += 1
        if level % LEVELS == 0:
            node = write(node, "tree").repartition("lo")
        total = F.aggregate("counts", F.lit(0.0), lambda s, c: s + c["n"])
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        here = node.withColumn("mid", mid).withColumn("total", total).withColumn("draws", F.floor(F.col("total") * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo"))))

        def draw(state: Column, c: Column) -> Column:
            seeded = F.xxhash64(F.lit(seed), F.col("lo"), F.col("hi"), c["place"])
            k = _hypergeometric(seeded, state["total"], c["n"], state["draws"])
            return F.struct(
                (state["total"] - c["n"]).alias("total"),
                (state["draws"] - k).alias("draws"),
                F.concat(state["got"], F.array(F.struct(c["place"].alias("place"), k.alias("n")))).alias("got"),
            )

        start = F.struct(F.col("total"), F.col("draws").cast("double").alias("draws"), F.array().cast("array<struct<place:bigint,n:double>>").alias("got"))
        here = here.withColumn("left", F.aggregate("counts", start, draw)["got"])
        right = F.zip_with("counts", "left", lambda c, g: F.struct(c["place"].alias("place"), (c["n"] - g["n"]).alias("n")))
        here = here.withColumn("right", right)
        # a node of a single shard is passed on as it is
        halves = F.when(F.col("hi") - F.col("lo") == 1, F.array(F.struct("lo", "hi", "counts"))).otherwise(
            F.array(F.struct("lo", F.col("mid").alias("hi"), F.col("left").alias("counts")), F.struct(F.col("mid").alias("lo"), "hi", F.col("right").alias("counts")))
        )
        node = here.select(F.inline(halves))
        shards = -(-shards // 2)
    leaves = write(node.select(F.col("lo").alias("shard"), F.inline("counts")).withColumn("n", F.col("n").cast("long")), "tree")
    return running_sum(leaves.withColumn("range", F.floor(F.col("shard") / RANGES)), ["place"], "range", ["shard"], "n", "first")


def running_sum(rows: DataFrame, by: list[str], part: str, order: list[str], value: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the sum of ``value`` over the rows before, within ``by``, in the order of ``part, *order``.

    Sums are made within parts first; a window over one row for each part gives every
    part its offset. ``rows`` should be a written table, as it is read twice.
    """
    sums = rows.groupBy(*by, part).agg(F.sum(value).alias("_sum"))
    ahead = F.sum("_sum").over(W.partitionBy(*by).orderBy(part).rowsBetween(W.unboundedPreceding, -1))
    offsets = sums.select(*[F.col(c).alias(f"_{c}") for c in [*by, part]], F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    same = [F.col(c) == F.col(f"_{c}") for c in [*by, part]]
    own = F.sum(value).over(W.partitionBy(*by, part).orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    return rows.withColumn("_own", own).join(offsets, same).withColumn(out, F.col("_ahead") + F.coalesce("_own", F.lit(0))).drop("_own", "_ahead", *[f"_{c}" for c in [*by, part]])


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, key, key2, row`` of each record.

    The keys hash a record's id and text, so that they do not depend on where it is
    stored; ``row`` numbers the records once they are written.
    """
    key, key2 = content_key(id_col, text_col)
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("key"), key2.alias("key2"), F.monotonically_increasing_id().alias("row"))


def mix(rows: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS, shards: int | None = None, block_words: int = 10_000, seed: int = 42, write: Callable = materialize) -> tuple[DataFrame, DataFrame]:
    """The mix of written rows ``source, size, key, row`` (see :func:`sized`).

    Returns its pieces, ``row, place, epoch, n_words, shard, position``, and the sources,
    ``source, place, source_size, target``. A piece is the first ``n_words`` words of a
    record in one epoch: all of them, but for the last record of a source. ``position``
    orders a shard's pieces at random. Only row numbers and sizes are shuffled. ``write``
    writes what the results read. Without ``shards`` there is one for ``SHARD_WORDS`` words, and ``LEAST_SHARDS`` at least.
    """
    sources = source_targets(rows, share, most, weights)
    sources = sources.withColumn("n_blocks", F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1)).cast("long"))
    sources = write(sources, "sources")
    if shards is None:
        shards = max(LEAST_SHARDS, -(-int(sources.agg(F.sum("target")).first()[0] or 0) // SHARD_WORDS))
    named = sources.select(F.col("source").alias("of"), "place", "n_blocks")
    rows = rows.join(named, rows["source"].eqNullSafe(F.col("of"))).select("row", "key", "size", "place", F.pmod(F.xxhash64(F.lit(seed), "key"), F.col("n_blocks")).alias("block"))
    blocks = write(rows.groupBy("place", "block").agg(F.sum("size").alias("words")), "blocks")

    # epochs of every source, and the order of its blocks in each
    last = int(-(-most // 1)) - 1
    epochs = sources.select("place", "source_size", F.round("target").cast("long").alias("words_due"), F.explode(F.sequence(F.lit(0), F.lit(last))).alias("epoch"))
    due = F.least(F.col("source_size"), F.col("words_due") - F.col("epoch") * F.col("source_size"))
    epochs = epochs.select("place", "epoch", due.alias("quota")).filter("quota > 0")
    # in each epoch's permuted order, the words before a block; and its rank among all blocks drawn from its source
    permuted = F.xxhash64(F.lit(seed + 1), "epoch", "place", "block")
    asked = write(blocks.join(epochs, "place").withColumn("permuted", permuted).withColumn("range", F.shiftrightunsigned("permuted", 64 - RANGES.bit_length() + 1)), "asked")
    # unsigned order of hashes, as ranges are taken from their upper bits
    order = [F.col("permuted") < 0, F.col("permuted"), F.col("block")]
    drawn = running_sum(asked, ["place", "epoch"], "range", order, "words", "ahead").withColumn("room", F.col("quota") - F.col("ahead")).filter("room > 0")
    drawn = write(drawn.select("place", "epoch", "block", "words", "room", "permuted", (F.col("epoch") * RANGES + F.col("range")).alias("range"), F.lit(1).cast("long").alias("one")), "drawn")
    ranked = running_sum(drawn, ["place"], "range", order, "one", "rank").select("place", "epoch", "block", "words", "room", "rank")
    tree = splitting_tree(drawn.groupBy("place").agg(F.count("*").alias("n")), shards, seed, write)
    dealt = tree.filter("n > 0").select("shard", "place", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("rank"))
    drawn = ranked.join(dealt, ["place", "rank"]).drop("rank")

    # whole blocks pass; in an epoch's last block, which may be cut, records go in order
    pieces = rows.join(drawn, ["place", "block"])
    inside = W.partitionBy("place", "epoch", "block").orderBy(F.xxhash64(F.lit(seed), "epoch", "key"), "row")
    ahead = F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = pieces.filter("room < words").withColumn("n_words", F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - ahead)))
    whole = pieces.filter("room >= words").withColumn("n_words", F.col("size"))
    out = whole.unionByName(cut).filter("n_words > 0")
    position = F.xxhash64(F.lit(seed + 2), "epoch", "key")
    return out.select("row", "place", "epoch", "n_words", "shard", position.alias("position")), sources.drop("n_blocks")


def taken(docs: DataFrame, **settings) -> DataFrame:
    """``doc_id, size, source_size, target, taken, pieces`` of every record of ``docs``.

    ``pieces`` says what the tree and the shuffle decided: ``epoch, shard, position, words``
    of each piece of the record, in order.
    """
    rows = materialize(sized(docs), "sized")
    pieces, sources = mix(rows, **settings)
    piece = F.struct("epoch", "shard", "position", F.col("n_words").alias("words"))
    words = pieces.groupBy("row").agg(F.sum("n_words").alias("taken"), F.array_sort(F.collect_list(piece)).alias("pieces"))
    named = sources.withColumnRenamed("source", "of")
    rows = rows.join(words, "row", "left")
    return rows.join(named, rows["source"].eqNullSafe(F.col("of"))).select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), F.coalesce("pieces", F.array().cast("array<struct<epoch:int,shard:int,position:bigint,words:bigint>>")).alias("pieces"))


def mixed(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", **settings) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each piece, shuffled within shards.

    A cut record keeps its first words, and ``chars_col`` follows its new text. Two
    rows of one record, from two epochs, may lie in different shards.
    """
    names, docs = docs.columns, plainly_named(docs, "doc_id", "source", text_col, chars_col)
    with Scratch(docs.sparkSession) as write:
        rows = write(sized(docs, text_col=text_col), "sized")
        pieces, _ = mix(rows, write=write, **settings)
        equal = rows.groupBy("key", "key2").agg((F.count("*") > 1).alias("equal")).filter("equal")
        found = pieces.join(rows.select("row", "size", "key", "key2"), "row").join(equal, ["key", "key2"], "left")
        found = found.select(F.col("key").alias("_mix_1"), F.col("key2").alias("_mix_2"), F.col("row").alias("_mix_row"), F.col("epoch").alias("_mix_epoch"), F.col("shard").alias("_mix_shard"), F.col("position").alias("_mix_position"), F.col("n_words").alias("_mix_words"), (F.col("n_words") < F.col("size")).alias("_mix_cut"), F.coalesce("equal", F.lit(False)).alias("_mix_equal"))
        found = materialize(found, "pieces")
    key, key2 = content_key("doc_id", text_col)
    out = docs.withColumns({"_mix_1": key, "_mix_2": key2}).join(found, ["_mix_1", "_mix_2"])
    if not found.filter("_mix_equal").isEmpty():  # equal records meet each other's pieces, but a piece comes once, with the least of their other columns
        others = F.struct(*[F.to_json(F.struct(F.col(f"`{c}`").alias("v"))).alias(f"_{k}") for k, c in enumerate(docs.columns)])
        meeting = [c for c in out.columns if c.startswith("_mix_") and c not in docs.columns]
        equal = out.filter("_mix_equal").groupBy(*meeting).agg(F.min_by(F.struct(*[f"`{c}`" for c in docs.columns]), others).alias("_mix_least"))
        out = out.filter("NOT _mix_equal").unionByName(equal.select("_mix_least.*", *meeting))
    short = F.array_join(F.slice(F.regexp_extract_all(text_col, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), F.lit(1), F.col("_mix_words").cast("int")), "")
    out = out.withColumn(text_col, F.when(F.col("_mix_cut"), short).otherwise(F.col(text_col)))
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col("_mix_cut"), F.length(text_col).cast(docs.schema[chars_col].dataType)).otherwise(F.col(chars_col)))
    shards = found.agg(F.max("_mix_shard")).first()[0]
    # a shard is a partition
    return out.repartitionById((shards or 0) + 1, F.col("_mix_shard")).sortWithinPartitions("_mix_position").select(*docs.columns).toDF(*names)

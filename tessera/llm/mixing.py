"""Mixing sources to target weights by Sainte-Lague apportionment (native).

1. Targets. Sources in code-point order (null last) take the weights in turn
   and share the whole token count; a target stops at ``max_epochs`` times the
   source's size and the excess is shared again by weight. The fixed point is
   found in closed form: with sources ordered by ratio cap / weight the capped
   ones are a prefix. This runs on one row per source.
2. Quotas. Tokens are dealt in equal blocks of ``block`` words to output shards
   of ``house`` blocks. Shards 1..i together hold i x house blocks, which go to
   the sources by Sainte-Lague with the targets as votes: seats go to the highest
   quotients votes / (2 k + 1), and no source gets more than the whole blocks of
   its target. A shard's integer quota is the seats of shards 1..i less those
   of shards 1..i-1, so no rounding adds up with their number. Seats that the
   divisor gives away (``round(votes)``) are taken directly; the few between
   their sum and the house are added by the highest, or given back by the
   lowest, quotients. The words left, under a block per source, are one more
   house with seats of a word.
3. Streams. Documents are dealt to decks by a seeded MD5 of id and text, about
   ``DECK_DOCS`` documents each, so a source with a third of all rows has a third
   of every deck and no deck grows with the input. A source's documents, by deck
   and then in MD5 order, form one stream of words; a document's place in it is
   its deck's offset (sums of spans of decks, then of decks) and its place in
   the deck.
4. Selection. A source with N words that is to give W takes every word ``W // N``
   times. The other ``W % N`` words are whole blocks and less than one block: the
   stream's blocks are cut into as many strata as blocks are to be taken, and
   of each stratum one block is taken, at a seeded place; the words left come
   from the end of the stream, behind the last block that may be chosen.
   Strata are filled in the order of the shards' quotas. How many words are
   taken before a place in the stream is known from the place alone, and a
   document's ``taken`` is the difference between its ends.

The targets are found on one row per source; all else is dealt by shard or deck.
Everything is a function of the rows and the seed, so reruns agree. Rows that
agree in id and text are interchangeable. Defined results: null text has size
0; a source without tokens has target 0 and takes nothing; the null source is
a source; an empty table gives an empty result; extra columns are carried
through in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._common import count_words, scratch

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK = 64
HOUSE = 1 << 16
DECK_DOCS = 256
SPAN = 1024
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sizes: (source, source_size), one row per source. Adds ``target``."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighted = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)).withColumn(
        "cap", F.col("source_size").cast("double") * max_epochs
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    level = weighted.select(
        "*",
        F.sum("source_size").over(every).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
        (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("w_left"),
    ).withColumn("rate", (F.col("total") - F.col("cap_before")) / F.col("w_left"))
    # Capped sources are those whose ratio is not above the rate of what is
    # left; the first source that is not capped sets the rate of the rest.
    free = F.when(F.col("cap") / F.col("w") > F.col("rate"), F.col("rate"))
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return level.withColumn("free", F.first(free, ignorenulls=True).over(whole)).select(
        "source",
        "source_size",
        F.least(F.col("cap"), F.coalesce(F.col("free") * F.col("w"), F.col("cap"))).alias("target"),
    )


def _seeded(seed: str, *cols: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def _apportion(cells: DataFrame, max_epochs: int) -> DataFrame:
    """cells: (shard, source, blocks, votes). Returns the integer ``seats``; a cell
    has at most ``blocks * max_epochs``. Equal quotients: the first source. A column
    ``weight``, in proportion to the votes, keeps quotients alike in all shards."""
    weight = F.col("weight" if "weight" in cells.columns else "votes")
    shard = Window.partitionBy("shard")
    cap = (F.col("blocks") * max_epochs).cast("long")
    rounded = cells.withColumn("cap", cap).withColumn("base", F.least(F.floor(F.col("votes") + 0.5), F.col("cap")))
    counted = rounded.withColumn(
        "missing", (F.floor(F.sum("votes").over(shard) + 0.5) - F.sum("base").over(shard)).cast("long")
    )
    up = F.col("missing") > 0
    # Were every cell to offer one seat, this quotient would be the last to
    # move; of a cell's seats only those as good can be among the best.
    one = F.when(up, F.col("base")).otherwise(F.col("base") - 1)
    offered = (one >= 0) & (one < F.col("cap")) & (F.col("votes") > 0)
    single = F.when(offered, F.col("votes") / (2 * one + 1))
    by_single = Window.partitionBy("shard").orderBy(F.when(up, -F.col("single")).otherwise(F.col("single")).asc_nulls_last())
    last = F.max(F.when(F.col("nth") == F.abs("missing"), F.col("single"))).over(shard)
    bounded = (
        counted.where("missing <> 0")
        .withColumn("single", single)
        .withColumn("nth", F.row_number().over(by_single))
        .withColumn("edge", F.floor((F.col("votes") / last - 1) / 2))
        .withColumn("most", F.coalesce(F.abs(F.col("edge") - F.col("base")) + 2, F.abs("missing")))
        .withColumn("most", F.least("most", F.abs("missing")).cast("long"))
    )
    # Seats on offer: the next ones of every cell, or the last ones given.
    steps = F.when(up, F.sequence(F.lit(0).cast("long"), F.col("most") - 1)).otherwise(
        F.sequence(F.lit(-1).cast("long"), -F.col("most"), F.lit(-1).cast("long"))
    )
    offers = (
        bounded
        .select("*", F.explode(steps).alias("step"))
        .withColumn("seat", F.col("base") + F.col("step"))
        .where((F.col("seat") >= 0) & (F.col("seat") < F.col("cap")) & (F.col("votes") > 0))
        .withColumn("quotient", weight / (2 * F.col("seat") + 1))
    )
    best = Window.partitionBy("shard").orderBy(
        F.when(up, -F.col("quotient")).otherwise(F.col("quotient")),
        # In one shard all rows go the same way, and one of these keys is null.
        F.when(up, F.col("source")).asc_nulls_last(), F.when(~up, F.col("source")).desc_nulls_first(),
    )
    moved = (
        offers.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= F.abs("missing"))
        .groupBy("shard", F.col("source").alias("o_source"))
        .agg(F.sum(F.signum("missing")).cast("long").alias("moved"))
        .withColumnRenamed("shard", "o_shard")
    )
    return counted.join(
        moved, (F.col("shard") == F.col("o_shard")) & F.col("source").eqNullSafe(F.col("o_source")), "left"
    ).select("shard", "source", "blocks", (F.col("base") + F.coalesce("moved", F.lit(0))).alias("seats"))


def block_quotas(targets: DataFrame, block: int = BLOCK, house: int = HOUSE) -> DataFrame:
    """targets: (source, target). Rows (shard, source, blocks): how many blocks of
    each source every output shard holds, shards numbered from 1."""
    whole = targets.where("target > 0").select("source", "target", F.floor(F.col("target") / block).alias("full"))
    blocks, votes = whole.agg(F.coalesce(F.sum("full"), F.lit(0)), F.sum("target")).first()
    shards = -(-blocks // house)
    upto = F.least(F.col("shard") * house, F.lit(blocks).cast("long"))
    prefixes = whole.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(max(1, shards)).cast("long"))).alias("shard"))
    seats = scratch(
        _apportion(
            prefixes.select(
                "shard", "source", F.col("full").alias("blocks"), F.col("target").alias("weight"),
                (F.col("target") * upto / F.lit(float(votes or 1))).alias("votes"),
            ),
            1,
        ),
        "mix-seats",
    )
    before = seats.select((F.col("shard") + 1).alias("b_shard"), F.col("source").alias("b_source"), F.col("seats").alias("b_seats"))
    return seats.join(
        before, (F.col("shard") == F.col("b_shard")) & F.col("source").eqNullSafe(F.col("b_source")), "left"
    ).select("shard", "source", (F.col("seats") - F.coalesce("b_seats", F.lit(0))).cast("long").alias("blocks"))


def source_words(targets: DataFrame, block: int = BLOCK, house: int = HOUSE) -> DataFrame:
    """targets: (source, target). Adds ``words``, what the source is to give: the
    blocks of its quotas and its seats in the house of the words left."""
    quotas = block_quotas(targets, block, house).groupBy(F.col("source").alias("q_source")).agg(F.sum("blocks").alias("q_blocks"))
    seated = targets.join(quotas, F.col("source").eqNullSafe(F.col("q_source")), "left").withColumn(
        "q_blocks", F.coalesce("q_blocks", F.lit(0).cast("long"))
    )
    over = F.greatest(F.col("target") - F.col("q_blocks") * block, F.lit(0.0))
    left = _apportion(seated.select(F.lit(0).alias("shard"), "source", F.ceil(over).alias("blocks"), over.alias("votes")), 1)
    left = left.select(F.col("source").alias("l_source"), F.col("seats").alias("l_words"))
    return seated.join(left, F.col("source").eqNullSafe(F.col("l_source"))).select(
        *targets.columns, (F.col("q_blocks") * block + F.col("l_words")).cast("long").alias("words")
    )


def _product(a: str, b: str) -> str:
    """SQL for a * b, exact for all words of any table."""
    return f"(cast({a} as decimal(18,0)) * cast({b} as decimal(18,0)))"


def _taken_before(rows: DataFrame, place: str, name: str, seed: str, block: int) -> DataFrame:
    """Adds ``name``: words taken before ``place`` in a stream with ``whole`` rounds,
    ``chosen`` blocks out of its first ``open`` ones and ``rest`` words behind them."""
    # A stratum s begins at block ceil(open * s / chosen).
    begin = lambda s: F.expr(f"({_product('open', s)} + greatest(chosen, 1) - 1) div greatest(chosen, 1)")
    inside = F.col("s_block") < F.col("open")
    return (
        rows.withColumn("s_block", F.least(F.expr(f"{place} div {block}"), F.col("open")))
        .withColumn("s_at", F.expr(f"{_product('s_block', 'chosen')} div greatest(open, 1)"))
        .withColumns({"s_from": begin("s_at"), "s_to": begin("s_at + 1")})
        .withColumn("s_pick", F.col("s_from") + F.pmod(F.xxhash64(F.lit(seed), "cell", "s_at"), F.greatest(F.col("s_to") - F.col("s_from"), F.lit(1).cast("long"))))
        .withColumn(
            "s_words",
            F.when(~inside, F.col("chosen") * block + F.least(F.col("rest"), F.col(place) - F.col("open") * block))
            .when(F.col("chosen") == 0, F.lit(0).cast("long"))
            .otherwise(
                F.col("s_at") * block
                + F.when(F.col("s_pick") < F.col("s_block"), F.lit(block).cast("long"))
                .when(F.col("s_pick") == F.col("s_block"), F.col(place) - F.col("s_block") * block)
                .otherwise(F.lit(0).cast("long"))
            ),
        )
        .withColumn(name, F.col("whole") * F.col(place) + F.col("s_words"))
        .drop("s_block", "s_at", "s_from", "s_to", "s_pick", "s_words")
    )


def _offsets(decks: DataFrame) -> DataFrame:
    """decks: (deck, cell, words). Adds ``offset``, the words of the cell in earlier
    decks: sums of spans of ``SPAN`` decks first, so no task sees all decks."""
    spanned = decks.withColumn("span", F.expr(f"deck div {SPAN}"))
    earlier = lambda w: F.coalesce(F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    spans = (
        spanned.groupBy("cell", "span").agg(F.sum("words").alias("words"))
        .select(F.col("cell").alias("s_cell"), F.col("span").alias("s_span"), earlier(Window.partitionBy("cell").orderBy("span")).alias("s_offset"))
    )
    return (
        spanned.withColumn("offset", earlier(Window.partitionBy("cell", "span").orderBy("deck")))
        .join(spans, (F.col("cell") == F.col("s_cell")) & (F.col("span") == F.col("s_span")))
        .select("deck", "cell", (F.col("offset") + F.col("s_offset")).alias("offset"))
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", carry: list[str] | None = None,
    weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, block: int = BLOCK, house: int = HOUSE, seed: str = SEED,
) -> DataFrame:
    """Per document: ``row`` (struct of the columns in ``carry``, by default
    all), size, source_size, target and taken."""
    dealt = docs.select(
        F.struct(*(carry or docs.columns)).alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        # The source as a key that is never null.
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("cell"),
        count_words(F.col(text)).alias("size"),
        _seeded(seed, F.col(doc_id), F.col(text)).alias("ord"),
    )
    # One pass over the texts gives what all later steps need but the row.
    sized = scratch(dealt.select("source", "cell", "size", "ord"), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = scratch(source_targets(totals, weights, max_epochs), "mix-targets")
    n_decks = max(1, -(-sized.count() // DECK_DOCS))
    deck = F.pmod(F.conv(F.substring("ord", 1, 12), 16, 10).cast("long"), F.lit(n_decks)).alias("deck")

    n = F.greatest("source_size", F.lit(1).cast("long"))
    plan = (
        scratch(source_words(targets, block, house), "mix-plan")
        .withColumns({"n": n, "whole": F.floor(F.col("words") / n), "over": F.pmod(F.col("words"), n)})
        .withColumns({"chosen": F.expr(f"over div {block}"), "rest": F.pmod("over", F.lit(block))})
        .select(
            F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("p_cell"), "source_size", "target", "whole", "chosen", "rest",
            # The last whole block stays shut if the words behind it are too few for the rest.
            F.expr(f"n div {block} - if(rest > n % {block}, 1, 0)").alias("open"),
        )
    )
    decks = scratch(sized.groupBy(deck, "cell").agg(F.sum("size").alias("words")), "mix-decks")
    cells = (
        _offsets(decks)
        .join(plan, F.col("cell") == F.col("p_cell"))
        .drop("p_cell")
        .withColumnsRenamed({"deck": "c_deck", "cell": "c_cell"})
    )
    in_order = Window.partitionBy("deck", "cell").orderBy("ord", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        dealt.select("row", "doc_id", "cell", "size", "ord", deck)
        .withColumn("stop", F.sum("size").over(in_order))
        .join(cells, (F.col("deck") == F.col("c_deck")) & (F.col("cell") == F.col("c_cell")))
        .withColumn("stop", F.col("offset") + F.col("stop"))
        .withColumn("begin", F.col("stop") - F.col("size"))
    )
    counted = _taken_before(_taken_before(placed, "begin", "before", seed, block), "stop", "after", seed, block)
    return counted.select("row", "size", "source_size", "target", (F.col("after") - F.col("before")).cast("long").alias("taken"))


def digest(docs: DataFrame) -> DataFrame:
    return mix(docs.select("doc_id", "text", "source"), carry=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken"
    )

"""Mixing sources to target weights by a low-discrepancy schedule.

Each source is a stream: its documents in the order of a hash, up to three times one after the
other, cut into blocks of equal numbers of words. The mix is a line of slots. Van der Corput
points (the slot number with its bits reversed) fall on the sources' cumulative numbers of
blocks, so that every source gets exactly its share of slots and any stretch of slots holds
nearly the same shares. A slot's rank among those of its source names the block that it takes.

The rank is counted in closed form from the bits of the slot number, without ordering slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.operators.running import with_total_before
from fleetmeter.llm.stored import stored

BLOCK_WORDS = 1024
REPEATS = 3
WEIGHTS = 3
ROWS_PER_BUCKET = 2_000
# Copies of one row that are made in one task.
COPIES_PER_TASK = 4_096
_CELLS_PER_BIN = 64
_KEY_BITS = 60


def sized(documents: DataFrame) -> DataFrame:
    """Each document's ``doc_id``, ``source``, ``size`` in words and ``place`` in the shuffled
    order of its source; equal rows once, with their number ``copies``. ``stream`` names the
    source, NULL too."""
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    of_text = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), of_text))
    rows = documents.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.coalesce(words, F.lit(0)).cast("long").alias("size"),
        F.conv(F.substring(key, 1, _KEY_BITS // 4), 16, 10).cast("long").alias("place"),
    )
    rows = rows.withColumn("stream", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))


def with_targets(sizes: DataFrame) -> DataFrame:
    """Per source of ``sized``: ``source_size``, ``target`` and its whole number ``quota``, its
    ``blocks`` and the number ``first`` of blocks of the sources before it.

    Sources by code point, NULL last, weigh 1, 2, 3 and again; they share all words by weight. A
    source that would get more than three times its words gets that, and what is over goes to the
    others by weight, until none is above. Any number of sources: they are ordered by ranges, and
    only sums come to the driver.
    """
    by_name = F.col("source").asc_nulls_last()
    sources = sizes.groupBy("stream", "source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size")
    )
    sources = sources.orderBy(by_name).withColumn("piece", F.spark_partition_id())
    sources = stored(sources.withColumn("one", F.lit(1)).withColumn("every", F.lit(0)), "sources")
    sources = with_total_before(sources, "every", "piece", [by_name], "one", "number")
    weighed = sources.withColumn("weight", F.col("number") % WEIGHTS + 1)
    weighed = stored(weighed.drop("one", "number"), "weights")
    full, budget, weight = _level(weighed)
    shared = F.expr(
        f"CAST((2BD * {budget}BD * CAST(weight AS DECIMAL(10,0)) + {weight}BD) div {2 * weight}BD AS BIGINT)"
    )
    most = REPEATS * F.col("source_size")
    result = weighed.select(
        "*",
        F.when(full, most.cast("double"))
        .otherwise(F.lit(float(budget)) * F.col("weight") / F.lit(float(weight)))
        .alias("target"),
        F.when(full, most).otherwise(shared).alias("quota"),
    )
    blocks = F.ceil(F.col("quota") / BLOCK_WORDS).cast("long")
    result = with_total_before(
        result.withColumn("blocks", blocks), "every", "piece", [by_name], "blocks", "first"
    )
    return stored(result.drop("every", "piece", "weight"), "targets")


def _level(weighed: DataFrame) -> tuple[Column, int, int]:
    """Which sources are full, the words for the others, and the others' weight.

    The level rises with every source that is found full, so each round finds some or ends."""
    total, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    total, weight = int(total or 0), int(weight or 1)
    budget, full = total, F.lit(False)
    while True:
        full = F.expr(
            f"CAST({REPEATS} * source_size AS DECIMAL(20,0)) * {weight}BD"
            f" < CAST(weight AS DECIMAL(10,0)) * {budget}BD"
        )
        words, left = weighed.agg(
            F.sum(F.when(full, F.col("source_size")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
        ).first()
        if not left or int(left) == weight:
            return full, budget, weight
        budget, weight = total - REPEATS * int(words), int(left)


def _reversed(number: Column, bits: int) -> Column:
    return F.conv(F.reverse(F.lpad(F.bin(number), bits, "0")), 2, 10).cast("long")


def _points_before(slot: Column, cell: Column, first: Column, end: Column, bits: int) -> Column:
    """How many smaller slots have a cell from ``first`` to before ``end``.

    Smaller slots fall into one group for each set bit of the slot number: equal above the bit, 0
    there, free below. The cells of a group are an arithmetic series, so they are counted by two
    divisions."""
    total = F.lit(0).cast("long")
    for bit in range(bits):
        step, shift = 1 << (bits - bit), bits - bit
        begin = cell.bitwiseAND(F.lit((step >> 1) - 1))
        below = F.shiftright(end - begin + (step - 1), shift) - F.shiftright(
            first - begin + (step - 1), shift
        )
        total = total + F.when(slot.bitwiseAND(F.lit(1 << bit)) != 0, below).otherwise(0)
    return total


def schedule(targets: DataFrame) -> DataFrame:
    """``slot``, ``stream`` and ``rank``: which block of which source each slot takes.

    Slot numbers grow along the mix; numbers whose point lies beyond all blocks are left out.
    Points meet sources by bins of 64 cells, so a point is compared with 64 sources at most."""
    blocks = targets.agg(F.sum("blocks")).first()[0] or 0
    bits = max(1, (blocks - 1).bit_length())
    slot, cell = F.col("slot"), F.col("cell")
    points = targets.sparkSession.range(1 << bits).withColumnRenamed("id", "slot")
    points = points.withColumn("cell", _reversed(slot, bits)).where(cell < blocks)
    points = points.withColumn("bin", F.floor(cell / _CELLS_PER_BIN))
    end = F.col("first") + F.col("blocks")
    bins = F.sequence(
        F.floor(F.col("first") / _CELLS_PER_BIN), F.floor((end - 1) / _CELLS_PER_BIN)
    )
    shares = targets.where("blocks > 0").select("stream", "first", "blocks", F.explode(bins).alias("bin"))
    met = points.join(shares, "bin").where((cell >= F.col("first")) & (cell < end))
    rank = _points_before(slot, cell, F.col("first"), end, bits)
    return met.select("slot", "stream", rank.alias("rank"))


def _placed(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Every copy of every row with the words of its stream before it, ``at``."""
    rows, most = sizes.agg(F.count("*"), F.max("copies")).first()
    width = -(-(1 << _KEY_BITS) // max(1, rows // ROWS_PER_BUCKET))
    bucket = F.call_function("div", F.col("place"), F.lit(width))
    placed = with_total_before(
        sizes.withColumn("bucket", bucket).withColumn("words", F.col("size") * F.col("copies")),
        "stream",
        "bucket",
        ["place", F.col("doc_id").asc_nulls_first(), "size"],
        "words",
        "at",
        targets.select("stream", "source_size", "target", "quota"),
    )
    runs = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES_PER_TASK).cast("long"))
    placed = placed.withColumn("run", F.explode(runs))
    if (most or 0) > COPIES_PER_TASK:
        placed = placed.repartition("stream", "place", "run")
    last = F.least(F.col("run") + COPIES_PER_TASK, F.col("copies")) - 1
    placed = placed.withColumn("copy", F.explode(F.sequence(F.col("run"), last)))
    return placed.withColumn("at", F.col("at") + F.col("copy") * F.col("size"))


def _pieces() -> Column:
    """The parts of a document in the blocks that are taken, over all repeats of its stream."""

    def in_repeat(repeat: Column) -> Column:
        begin = repeat * F.col("source_size") + F.col("at")
        end = F.least(begin + F.col("size"), F.col("quota"))

        def piece(block: Column) -> Column:
            low = F.greatest(block * BLOCK_WORDS, begin)
            high = F.least((block + 1) * BLOCK_WORDS, end)
            return F.struct(
                repeat.alias("repeat"),
                block.alias("block"),
                (low - begin).alias("start"),
                (high - low).alias("length"),
            )

        first, last = (F.floor(x / BLOCK_WORDS) for x in (begin, end - 1))
        return F.when(end > begin, F.transform(F.sequence(first, last), piece)).otherwise(F.array())

    repeats = F.sequence(F.lit(0).cast("long"), F.lit(REPEATS - 1).cast("long"))
    return F.flatten(F.transform(repeats, in_repeat))


def mixed(documents: DataFrame) -> DataFrame:
    """The mix: for each piece of a document that it takes, ``slot``, ``doc_id``, ``source``,
    ``copy`` (among equal rows), ``repeat`` of the stream, ``start`` and ``length`` in words. A
    document of which nothing is taken has one row without slot. With each: ``size``,
    ``source_size``, ``target`` and ``place``.

    Pieces of one slot follow each other by repeat and place. A null text has no words; documents
    without words are never taken; a NULL source is a source of its own. Documents of one id and
    size are told apart by their texts and sources, equal rows by ``copy``. The order of the rows
    given does not matter, and reruns agree. Other columns are not read. A table without rows
    gives no rows.
    """
    sizes = stored(sized(documents), "sizes")
    targets = with_targets(sizes)
    pieces = _placed(sizes, targets).withColumn("piece", F.explode_outer(_pieces()))
    pieces = pieces.select(
        "stream", "doc_id", "source", "size", "source_size", "target", "place", "copy", "piece.*"
    )
    slots = schedule(targets).withColumnRenamed("stream", "_stream")
    takes = (F.col("stream") == F.col("_stream")) & (F.col("block") == F.col("rank"))
    return pieces.join(slots, takes, "left").drop("_stream", "rank")


def taken(mix: DataFrame) -> DataFrame:
    """One row per document of ``mixed`` with ``taken``, the words that the mix takes of it."""
    words = F.when(F.col("slot").isNotNull(), F.col("length")).otherwise(0)
    document = ["stream", "place", "doc_id", "size", "copy", "source", "source_size", "target"]
    return mix.groupBy(*document).agg(F.sum(words).cast("long").alias("taken"))

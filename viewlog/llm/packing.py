"""Best-fit packing of documents into sequences of several permitted lengths.

Pieces are placed from the longest to the shortest into the open bin they fit best. A piece that fits
none opens the bin size that costs least for what is still to be placed. This is tried once for every
run of permitted sizes, from a smallest to a largest one. Each bin is downsized to the cheapest size
that holds its contents, and the cheapest outcome counts.

Pieces are dealt to groups of bounded size by a hash, and each group is packed by one task; a group
leaves at most a few bins unfilled, and those are downsized.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewlog.llm.tables import WORD, stored, text_of

CAPACITIES = (512, 1024, 2048, 4096, 8192)  # permitted lengths, in words
OVERHEAD = 64  # what a sequence costs besides its length
GROUP_PIECES = 4096  # pieces packed together; the loss by splitting is below a bin in a hundred
BIN_NUMBERS = 1 << 32  # bin numbers per group
RUN = 10_000  # copies of one row that one task numbers

PACKED = ("has_id boolean, doc_id bigint, piece int, first_word bigint, n_words bigint, bin_id bigint, capacity int, "
          "bin_offset bigint, bin_words bigint")


def costs_of(capacities: tuple[int, ...]) -> dict[int, float]:
    """The default price of a bin by its size."""
    return {capacity: float(capacity + OVERHEAD) for capacity in capacities}


def _filled(sizes: np.ndarray, allowed: list[int], costs: dict[int, float]) -> tuple[np.ndarray, list[int]]:
    """The bin of every piece, pieces given from long to short, and the contents of every bin."""
    by_price = sorted(allowed, key=lambda size: (costs[size] / size, size))
    room: list[tuple[int, int]] = []  # (free words, bin), sorted
    contents: list[int] = []
    place = np.empty(len(sizes), dtype=np.int64)
    left = int(sizes.sum())
    for number, size in enumerate(sizes.tolist()):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, chosen = room.pop(at)
        else:
            # If one bin can take all that is left, the cheapest such bin; else the best price per word.
            whole = [capacity for capacity in allowed if capacity >= left]
            free = min(whole, key=lambda c: (costs[c], c)) if whole else next(c for c in by_price if c >= size)
            chosen = len(contents)
            contents.append(0)
        place[number] = chosen
        contents[chosen] += size
        left -= size
        if free > size:
            insort(room, (free - size, chosen))
    return place, contents


def best_fit(sizes: np.ndarray, costs: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    """The bin of every piece and the size of every bin, for pieces given from long to short.

    No piece may be longer than the largest permitted size.
    """
    permitted = sorted(costs)
    if len(sizes) and sizes[0] > permitted[-1]:
        raise ValueError("a piece is longer than every permitted size")
    best = None
    runs = [permitted[low:high] for high in range(len(permitted), 0, -1) for low in range(high)]
    for allowed in runs:
        if len(sizes) and allowed[-1] < sizes[0]:
            continue
        place, contents = _filled(sizes, allowed, costs)
        final = [min((c for c in permitted if c >= words), key=lambda c: (costs[c], c)) for words in contents]
        total = sum(costs[capacity] for capacity in final)
        if best is None or total < best[0]:
            best = total, place, final
    return best[1], np.array(best[2], dtype=np.int64)


def _pack(group: pd.DataFrame, costs: dict[int, float]) -> pd.DataFrame:
    """One group of pieces with their bins; offsets follow the order of placing."""
    group = group.sort_values(
        ["n_words", "has_id", "doc_id", "piece", "copy"], ascending=[False, True, True, True, True], kind="stable")
    sizes = group["n_words"].to_numpy(dtype=np.int64)
    place, capacities = best_fit(sizes, costs)
    placed = pd.Series(sizes).groupby(place)
    return pd.DataFrame({
        "has_id": group["has_id"].array, "doc_id": group["doc_id"].array, "piece": group["piece"].array, "first_word": group["first_word"].array,
        "n_words": sizes, "bin_id": group["shard"].to_numpy(dtype=np.int64) * BIN_NUMBERS + place,
        "capacity": capacities[place], "bin_offset": placed.cumsum().to_numpy() - sizes,
        "bin_words": placed.transform("sum").to_numpy(),
    })


def pack(
    docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, costs: dict[int, float] | None = None,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, piece, first_word, n_words, bin_id, capacity, bin_offset, bin_words.

    A document is one piece, or, if it is longer than the largest capacity, pieces of that capacity
    and a rest: the words ``first_word`` to ``first_word + n_words - 1``. They stand in bin
    ``bin_id`` from ``bin_offset`` on. ``costs`` gives the price of a bin by size.

    A document without a word (NULL, empty or white space) takes no room: one row with NULL for
    bin_id, capacity, bin_offset and bin_words. Repeated rows are packed as often as they stand; pieces of the same
    length are placed by id, then by number. A NULL id is packed like any other. Columns other than
    doc_id and text are ignored; no rows give no rows.
    """
    costs = costs or costs_of(capacities)
    largest = max(costs)
    words = F.regexp_count(text_of(docs), F.lit(WORD)).cast("bigint")
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), words.alias("n_words"))
    # Equal rows are counted and then numbered, so that a row that stands very often is dealt to all groups.
    lengths = stored(rows.groupBy("doc_id", "n_words").agg(F.count("*").alias("copies")), "lengths")
    pieces_of = F.greatest(F.ceil(F.col("n_words") / largest), F.lit(1)).cast("bigint")
    size = lengths.agg(F.sum(F.col("copies") * pieces_of).alias("pieces")).first()["pieces"] or 0
    groups = max(1, -(-size // group_pieces))
    # One task numbers at most RUN copies; the runs of a row with more are dealt to all tasks.
    often = F.col("copies") > RUN
    one_run = lengths.where(~often).withColumn("run", F.lit(1).cast("bigint"))
    first_of_run = F.sequence(F.lit(1).cast("bigint"), F.col("copies"), F.lit(RUN).cast("bigint"))
    runs = lengths.where(often).withColumn("run", F.explode(first_of_run)).repartition("doc_id", "n_words", "run")
    last = F.least(F.col("run") + F.lit(RUN) - 1, F.col("copies"))
    pieces = (
        one_run.unionByName(runs)
        .withColumn("copy", F.explode(F.sequence(F.col("run"), last)))
        .withColumn("piece", F.explode(F.sequence(F.lit(0), pieces_of.cast("int") - 1)))
        .withColumn("first_word", F.col("piece").cast("bigint") * largest)
        .withColumn("n_words", F.least(F.col("n_words") - F.col("first_word"), F.lit(largest).cast("bigint")))
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "n_words", "copy"), F.lit(groups)))
        .select("shard", "doc_id", "piece", "copy", "first_word", "n_words"))
    # Whole numbers with gaps would become floating-point ones in pandas, so a NULL id travels as a flag.
    flagged = pieces.withColumn("has_id", F.col("doc_id").isNotNull()).fillna(0, "doc_id")
    packed = flagged.where("n_words > 0").groupBy("shard").applyInPandas(lambda group: _pack(group, costs), PACKED)
    packed = packed.withColumn("doc_id", F.when(F.col("has_id"), F.col("doc_id"))).drop("has_id")
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (
        ("bin_id", "bigint"), ("capacity", "int"), ("bin_offset", "bigint"), ("bin_words", "bigint"))]
    empty = pieces.where("n_words = 0").select("doc_id", "piece", "first_word", "n_words", *nothing)
    return packed.unionByName(empty)

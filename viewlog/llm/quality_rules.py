"""Quality rules: plain limits first, then robust multivariate outliers.

Every text gives a few statistics. Those that pass the plain limits are transformed to be roughly
normal, and for each language and source the minimum covariance determinant (MCD) estimates where
most documents lie: the mean and covariance of the subset, of a given share, whose covariance has
the smallest determinant. A document far from that centre by its Mahalanobis distance is rejected.

The subset is found by concentration steps: take the share of documents nearest to the present
centre, estimate again, repeat. Each step is one aggregation of sums and products by group and
distance band; no group is ever gathered. Statistics are rounded to whole units before, so all sums
are exact and do not depend on the order of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewlog.llm.tables import WORD, let, stored, text_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

STATISTICS = ("x_words", "x_word_length", "x_symbols", "x_repeats")
VECTOR = (*STATISTICS, "x_dup_lines")  # what documents are judged by
UNITS = 64  # whole units per 1.0 of a transformed statistic
SPREAD_FLOOR = 0.1  # standard deviation added to each statistic: what differs by less is alike
SUPPORT = 0.75  # share of a group that its estimate is made of
MIN_GROUP = 60  # smaller groups share the estimate of their language
MAX_STEPS = 12
BANDS_PER_OCTAVE, LEAST_OCTAVE, OCTAVES = 16, -8, 30  # bands of the squared distance
CUTOFF = 1e-4  # share of a normal sample beyond the limit of rejection


# --- Statistics of a text -------------------------------------------------------------------------


def _repeated_words(words: Column) -> Column:
    """Words inside a window of three that stands twice or more; windows may overlap.

    Windows are sorted so that equal ones are neighbours. Each repeated window then covers three
    words from its position, less what the one before it has covered.
    """
    size = F.size(words)
    windows = F.transform(F.sequence(F.lit(0), size - 3), lambda i: F.struct(
        F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("words"), i.alias("at")))

    def covered(rows: Column) -> Column:
        last = F.size(rows) - 1

        def twin(row: Column, place: Column) -> Column:
            before = (place > 0) & (rows[F.greatest(place - 1, F.lit(0))]["words"] == row["words"])
            return before | ((place < last) & (rows[F.least(place + 1, last)]["words"] == row["words"]))

        places = F.sort_array(F.transform(F.filter(rows, twin), lambda row: row["at"]))
        start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-3).alias("last"))
        return F.aggregate(
            places, start, lambda so_far, at: F.struct(
                (so_far["sum"] + F.least(F.lit(3), at - so_far["last"])).alias("sum"), at.alias("last")),
            lambda so_far: so_far["sum"])

    return F.when(size >= 3, let(F.sort_array(windows), covered)).otherwise(F.lit(0).cast("bigint"))


def text_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, the columns to keep, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    rows = docs.select(docs["doc_id"], *[docs[name].alias(name) for name in keep], text_of(docs).alias("_text"))
    text = F.col("_text")
    of_words = let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda words: F.struct(
        F.size(words).cast("bigint").alias("n_words"),
        _repeated_words(words).alias("n_repeat_words")))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    of_lines = let(lines, lambda own: F.struct(
        F.size(own).cast("bigint").alias("n_lines"),
        (F.size(own) - F.size(F.array_distinct(own))).cast("bigint").alias("n_dup_lines")))
    return rows.select(
        "doc_id", *keep, of_words.alias("_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        of_lines.alias("_lines"),
    ).select(
        "doc_id", *keep, "_words.n_words", "word_chars", "n_symbols", "_lines.n_lines", "_lines.n_dup_lines",
        "_words.n_repeat_words")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def transformed() -> list[Column]:
    """The statistic vector in whole units: logarithms of the length and of shares.

    Shares are taken in units of what is ordinary: a symbol in a hundred characters, and a tenth of
    the words or lines repeated, as a short document with one line standing twice has it.
    """
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    vector = (
        F.log(words), 2 * F.log(chars / words), F.log(1 + 100 * F.col("n_symbols") / chars),
        F.log(1 + 10 * F.col("n_repeat_words") / words), F.log(1 + 10 * F.col("n_dup_lines") / lines))
    return [F.round(UNITS * value).cast("bigint").alias(name) for name, value in zip(VECTOR, vector)]


# --- Estimates ------------------------------------------------------------------------------------


def _chi2_tail(x: float, degrees: int) -> float:
    """The probability that chi-square exceeds a value, for any whole number of degrees."""
    half = x / 2
    powers = [degrees % 2 / 2 + k for k in range(degrees // 2)]
    rest = math.erfc(math.sqrt(half)) if degrees % 2 else 0.0
    return rest + math.exp(-half) * sum(half ** power / math.gamma(power + 1) for power in powers)


def _chi2(x: float, degrees: int) -> float:
    """Distribution function of chi-square."""
    return 1 - _chi2_tail(x, degrees)


def _chi2_beyond(share: float, degrees: int) -> float:
    """The value that chi-square exceeds with the given probability."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2_tail(middle, degrees) > share else (low, middle)
    return high


def consistency(support: float, degrees: int = len(STATISTICS)) -> float:
    """What the covariance of the central share is multiplied by to estimate that of all."""
    return support / _chi2(_chi2_beyond(1 - support, degrees), degrees + 2)


def _pairs(names: Sequence[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(names)) for j in range(i + 1)]


def _sums(names: Sequence[str] = STATISTICS) -> list[Column]:
    """Row count, sums and sums of products: all whole numbers, so exact in any order."""
    wide = [F.col(name).cast("decimal(38,0)") for name in names]
    return [
        F.count("*").alias("n"), *[F.sum(F.col(name)).alias(f"s{i}") for i, name in enumerate(names)],
        *[F.sum(wide[i] * wide[j]).cast("decimal(38,0)").alias(f"s{i}_{j}") for i, j in _pairs(names)]]


def _sum_names(names: Sequence[str]) -> list[str]:
    return ["n", *[f"s{i}" for i in range(len(names))], *[f"s{i}_{j}" for i, j in _pairs(names)]]


def _estimate(sums: DataFrame, keys: list[str], factor: float, names: Sequence[str] = STATISTICS) -> DataFrame:
    """Mean, Cholesky factor of the covariance, and log determinant, from the sums of a subset."""
    size = F.col("n").cast("double")
    frame = sums.select(*keys, "n", *[(F.col(f"s{i}") / size / UNITS).alias(f"m{i}") for i in range(len(names))], *[
        (factor * (F.col(f"s{i}_{j}").cast("double") / size - (F.col(f"s{i}") / size) * (F.col(f"s{j}") / size))
         / UNITS ** 2 + (SPREAD_FLOOR ** 2 if i == j else 0.0)).alias(f"c{i}_{j}") for i, j in _pairs(names)])
    for i in range(len(names)):  # row by row, each entry from those before it
        for j in range(i + 1):
            rest = F.col(f"c{i}_{j}") - sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
            entry = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}_{j}")
            frame = frame.withColumn(f"l{i}_{j}", entry)
    logs = reduce(lambda a, b: a + b, [2 * F.log(f"l{i}_{i}") for i in range(len(names))])
    return frame.withColumn("log_det", logs).drop(*[f"c{i}_{j}" for i, j in _pairs(names)])


def with_distance(rows: DataFrame, names: Sequence[str] = STATISTICS) -> DataFrame:
    """``distance``: the squared Mahalanobis distance of rows that carry their group's estimate."""
    for i, name in enumerate(names):
        gap = F.col(name) / F.lit(float(UNITS)) - F.col(f"m{i}")
        known = sum((F.col(f"l{i}_{k}") * F.col(f"_z{k}") for k in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"_z{i}", (gap - known) / F.col(f"l{i}_{i}"))
    squares = reduce(lambda a, b: a + b, [F.col(f"_z{i}") * F.col(f"_z{i}") for i in range(len(names))])
    return rows.withColumn("distance", squares).drop(*[f"_z{i}" for i in range(len(names))])


def _estimate_names(names: Sequence[str]) -> list[str]:
    return [*[f"m{i}" for i in range(len(names))], *[f"l{i}_{j}" for i, j in _pairs(names)]]


ESTIMATE = _estimate_names(STATISTICS)
GROUP = ["cell_lang", "cell_source"]


def _join(rows: DataFrame, estimates: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Rows with what is known about their group.

    A group can hold a third of all rows, so its rows are dealt to as many slots as there are shuffle
    partitions, and the one row per group is repeated for each.
    """
    slots = F.sequence(F.lit(0), F.lit(_slots(rows) - 1)).cast("array<bigint>")
    return rows.join(estimates.withColumn("slot", F.explode(slots)), [*on, "slot"], how)


def _slots(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _band() -> Column:
    """The band of a distance: whole numbers, so that counts by band are exact."""
    place = F.floor((F.log2(F.col("distance") + 2.0 ** LEAST_OCTAVE) - LEAST_OCTAVE) * BANDS_PER_OCTAVE)
    return F.least(F.greatest(place, F.lit(0)), F.lit(OCTAVES * BANDS_PER_OCTAVE)).cast("int").alias("band")


def _concentrate(rows: DataFrame, estimates: DataFrame, support: float, names: Sequence[str]) -> DataFrame:
    """One step: the estimate of the nearest ``support`` of each group, whole bands at a time."""
    keys = [*GROUP, "start"]
    joined = _join(rows, estimates.select(*GROUP, *_estimate_names(names), "start"), GROUP)
    banded = with_distance(joined, names).groupBy(*keys, _band()).agg(*_sums(names))
    order = Window.partitionBy(*keys).orderBy("band")
    nearer = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    inside = banded.withColumn("_nearer", F.coalesce(nearer, F.lit(0))).withColumn("_total", total).where(
        F.col("_nearer") < F.lit(support) * F.col("_total"))
    return _estimate(inside.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in _sum_names(names)]), keys, 1.0, names)


def _starts(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Two first estimates per group: of all its rows, and by medians and median deviations."""
    every = _estimate(rows.groupBy(*GROUP).agg(*_sums(names)), GROUP, 1.0, names).withColumn("start", F.lit(0))
    # Rounded statistics take few values, so an exact median needs little memory.
    medians = stored(rows.groupBy(*GROUP).agg(*[F.percentile(name, 0.5).alias(f"m{i}") for i, name in enumerate(names)]), "medians")
    gaps = _join(rows, medians, GROUP).groupBy(*GROUP).agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(len(names))],
        *[F.percentile(F.abs(F.col(name) - F.col(f"m{i}")), 0.5).alias(f"g{i}") for i, name in enumerate(names)],
        F.count("*").alias("n"))
    spread = [F.sqrt((1.4826 * F.col(f"g{i}") / UNITS) ** 2 + SPREAD_FLOOR ** 2) for i in range(len(names))]
    middle = gaps.select(
        *GROUP, "n", *[(F.col(f"m{i}") / UNITS).alias(f"m{i}") for i in range(len(names))],
        *[(spread[i] if i == j else F.lit(0.0)).alias(f"l{i}_{j}") for i, j in _pairs(names)],
        F.lit(0.0).alias("log_det"), F.lit(1).alias("start"))
    return every.unionByName(middle)


def robust_estimates(rows: DataFrame, support: float = SUPPORT, names: Sequence[str] = STATISTICS) -> DataFrame:
    """The reweighted MCD estimate of every group of ``GROUP``: mean and Cholesky factor.

    ``rows`` have a slot from 0 to the number of shuffle partitions, spread evenly within any group.
    """
    estimates, size = stored(_starts(rows, names), "mcd-start"), None
    for _ in range(MAX_STEPS):
        estimates = stored(_concentrate(rows, estimates, support, names), "mcd-step")
        now = estimates.agg(F.sum(F.round("log_det", 6)).alias("sum")).first()["sum"]
        if now == size:  # a step that changes no subset changes none ever after
            break
        size = now
    best = estimates.groupBy(*GROUP).agg(F.min_by(F.struct("n", *_estimate_names(names)), F.struct("log_det", "start")).alias("_best"))
    best = best.select(*GROUP, "_best.*")
    widened = [(F.col(f"l{i}_{j}") * math.sqrt(consistency(support, len(names)))).alias(f"l{i}_{j}") for i, j in _pairs(names)]
    raw = stored(best.select(*GROUP, *[f"m{i}" for i in range(len(names))], *widened), "mcd-raw")
    near = with_distance(_join(rows, raw, GROUP), names).where(F.col("distance") <= _chi2_beyond(0.025, len(names)))
    return stored(_estimate(near.groupBy(*GROUP).agg(*_sums(names)), GROUP, consistency(0.975, len(names)), names), "mcd")


def quality_rules(docs: DataFrame, support: float = SUPPORT, cutoff: float = CUTOFF, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, kept, distance.

    ``distance`` is the squared distance from the centre of the document's group; ``kept`` is false
    for a document that fails the base limits or lies further out than a normal sample would but for
    a share of ``cutoff``. Groups are (lang, source); NULL is a value like any other. Documents of a
    group with fewer than ``min_group`` that pass the base share an estimate per language; where
    those are fewer still, distance is NULL and the base alone decides. Base failures do not enter
    an estimate and have no distance.

    A NULL text has no words and fails the base. Repeated rows count each time. Columns other than
    doc_id, text, lang and source are ignored; no rows give no rows.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    read = text_statistics(docs, "lang", "source")
    table = stored(read.select(
        "doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        *names, base_failed().alias("base_failed"), *transformed(),
        F.pmod(F.monotonically_increasing_id(), F.lit(_slots(docs))).alias("slot")), "statistics")
    # A group's name as text, NULL apart from every name, so that joins find it.
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit("null")) for name in ("lang", "source"))
    table = table.withColumn("_lang", lang).withColumn("_source", source)
    sizes = table.where(~F.col("base_failed")).groupBy("_lang", "_source").agg(F.count("*").alias("_size"))
    sizes = sizes.withColumn("cell_lang", F.col("_lang")).withColumn(
        "cell_source", F.when(F.col("_size") >= min_group, F.col("_source")).otherwise(F.lit("small")))
    of_cell = Window.partitionBy("cell_lang", "cell_source")
    cells = stored(sizes.withColumn("_size", F.sum("_size").over(of_cell)).where(F.col("_size") >= min_group).select(
        "_lang", "_source", "cell_lang", "cell_source"), "quality-groups")
    celled = _join(table, cells, ["_lang", "_source"], "left")
    learned = stored(celled.where(~F.col("base_failed") & F.col("cell_lang").isNotNull()).select(
        *GROUP, "slot", *VECTOR), "quality-learned")
    estimates = robust_estimates(learned, support, VECTOR)
    measured = with_distance(_join(celled, estimates.select(*GROUP, *_estimate_names(VECTOR)), GROUP, "left"), VECTOR)
    distance = F.when(~F.col("base_failed"), F.col("distance"))
    limit = _chi2_beyond(cutoff, len(VECTOR))
    kept = ~F.col("base_failed") & F.coalesce(distance <= limit, F.lit(True))
    return measured.select("doc_id", *names, "base_failed", kept.alias("kept"), distance.alias("distance"))

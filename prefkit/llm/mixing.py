"""Mixing sources to target weights by capped water-filling.

A total is dealt to the sources in proportion to their weights. A source stops at ``max_epochs``
times its own size; what it cannot take is dealt again to the others in proportion, until nobody
is above the limit. A source then takes its documents ``floor(target / size)`` times each, and a
seeded sample of them once more for the fraction that is left.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prefkit.llm.common import free_name, written

#: A source's rows are dealt by the seeded hash to bins of about BIN_ROWS rows, 2 ** BIN_BITS at most.
BIN_ROWS = 1024
BIN_BITS = 14
SEED = 20240601
#: Rows above one in LONG of the words that a source samples are decided before the others.
LONG = 8


def word_count(text: str) -> Column:
    """Number of maximal runs of characters other than space, tab, LF, VT, FF, CR (null: 0).

    A run ends where such a character is followed by a separator or the end, so the separators
    that follow a non-separator are counted on a copy of the text that ends in one.
    """
    kinds = F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[^\x20\x09-\x0D]+", "\x01")
    return (F.length(kinds) - F.length(F.translate(kinds, "\x01", ""))).cast("long")


def water_filled(sources: DataFrame, total: float | int, max_epochs: float) -> DataFrame:
    """``sources`` (source_size, weight, and further columns) with ``target`` (double).

    Sources at their cap are clamped and the rest of the total is dealt again by weight, until none
    is above its cap. Each round is one aggregate over the sources; at least one source is clamped
    per round. Sources of no size or no weight get 0; a total beyond all caps leaves each at its cap.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level = None
    while True:
        # Clamped so far: those whose cap is within the last level. The level never falls.
        clamped = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(clamped, cap).otherwise(0.0)).alias("used"),
            F.sum(F.when(clamped, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.count(F.when(clamped, 1)).alias("n"),
        ).first()
        if not row["weight"]:
            break
        nxt = max(0.0, float(total) - (row["used"] or 0.0)) / row["weight"]
        if level is not None and row["n"] == seen:
            break
        level, seen = nxt, row["n"]
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)).cast("double"))


def _draw(id: Column, seed: int) -> Column:
    """The seeded hash by which a source's rows are drawn."""
    return F.xxhash64(id.cast("string"), F.lit(seed))


def _bits(source_rows: str) -> Column:
    """Bits of the hash that number the bins of a source."""
    bits = F.ceil(F.log2(F.greatest(F.col(source_rows) / BIN_ROWS, F.lit(1.0))))
    return F.least(bits, F.lit(BIN_BITS)).cast("int")


def _bin(draw: Column, bits: Column) -> Column:
    """The bin of a drawn hash: its highest ``bits`` bits."""
    high = F.shiftrightunsigned(draw, 64 - BIN_BITS).cast("int")
    return F.floor(high / F.pow(F.lit(2.0), F.lit(BIN_BITS) - bits)).cast("int")


def _with_gaps(rows: DataFrame, share_of: Column | None = None) -> DataFrame:
    """``rows`` with ``_mx_gap``, what their source has still to take (of ``share_of`` if given)."""
    wanted = F.first("_mx_extra") if share_of is None else F.first(share_of)
    gaps = rows.groupBy(F.col("source").alias("_mx_s")).agg((wanted - F.sum(F.col("_mx_more") * F.col("size"))).alias("_mx_gap"))
    gaps = written(gaps, "mix-gaps")  # one row a source, of known size when the join is planned
    return rows.join(gaps, F.col("source").eqNullSafe(F.col("_mx_s"))).drop("_mx_s")


def _fitting(table: pa.Table) -> pa.Table:
    """The rows of a crossing bin in the seeded order; those that fit into what is left are taken."""
    table = table.sort_by([("_mx_draw", "ascending"), ("id", "ascending")])
    left = table["_mx_left"][0].as_py()
    more = []
    for size in table["size"].to_pylist():
        more.append(int(size <= left))
        left -= size * more[-1]
    table = table.drop_columns(["_mx_left"])
    return table.set_column(table.schema.get_field_index("_mx_more"), "_mx_more", pa.array(more, pa.int64()))


def _filled(rows: DataFrame, wanted: Column, name: str) -> DataFrame:
    """``rows`` (with ``_mx_gap``) of which the ``wanted`` ones that fit are taken in the seeded order.

    Bins below the crossing one are taken whole, from sums per (source, bin); in the crossing bin a row
    that does not fit is passed over. Rows above it are left to the next call, with a smaller gap.
    """
    tried = (F.col("_mx_more") == 0) & (F.col("size") > 0) & (F.col("size") <= F.col("_mx_gap")) & wanted
    rows = rows.withColumn("_mx_try", F.coalesce(tried, F.lit(False)))
    sums = rows.filter("_mx_try").groupBy("source", "_mx_bin").agg(F.sum("size").alias("sum"), F.first("_mx_gap").alias("gap"))
    sums = sums.withColumn("upto", F.sum("sum").over(Window.partitionBy("source").orderBy("_mx_bin")))
    crossing = sums.filter((F.col("upto") > F.col("gap")) & (F.col("upto") - F.col("sum") <= F.col("gap")))
    crossing = crossing.groupBy(F.col("source").alias("_mx_cs")).agg(
        F.min("_mx_bin").alias("_mx_cross"), F.min_by(F.col("gap") - (F.col("upto") - F.col("sum")), "_mx_bin").alias("_mx_left")
    )
    crossing = written(crossing, "mix-crossing")
    rows = rows.join(crossing, F.col("source").eqNullSafe(F.col("_mx_cs")), "left").drop("_mx_cs", "_mx_gap")
    inside = F.col("_mx_try") & F.coalesce(F.col("_mx_bin") == F.col("_mx_cross"), F.lit(False))
    below = F.col("_mx_try") & F.coalesce(F.col("_mx_bin") < F.col("_mx_cross"), F.lit(True))
    split = rows.filter(inside).drop("_mx_try", "_mx_cross")
    others = rows.filter(~inside).withColumn("_mx_more", F.col("_mx_more") + below.cast("long"))
    others = others.drop("_mx_try", "_mx_cross", "_mx_left")
    split = split.groupBy("source").applyInArrow(_fitting, split.drop("_mx_left").schema)
    return written(others.unionByName(split), name)


def _nearest(rows: DataFrame, wanted: Column, name: str) -> DataFrame:
    """``rows`` (with ``_mx_gap``) of which one further row a source is taken, the ``wanted`` one whose
    size is nearest to the gap, if that brings the source nearer to its target."""
    free = (F.col("_mx_more") == 0) & (F.col("size") > 0) & (F.col("size") < 2 * F.col("_mx_gap")) & wanted
    by = F.struct(F.abs(F.col("size") - F.col("_mx_gap")), "_mx_draw", "size")
    best = rows.filter(free).groupBy(F.col("source").alias("_mx_s")).agg(F.min(by).alias("_mx_best"))
    best = written(best, "mix-best")
    rows = rows.join(best, F.col("source").eqNullSafe(F.col("_mx_s")), "left").drop("_mx_s")
    found = F.coalesce(free & (by == F.col("_mx_best")), F.lit(False))
    # Repeated rows tie; one of them is taken.
    nth = F.row_number().over(Window.partitionBy("source").orderBy("id"))
    one = rows.filter(found).withColumn("_mx_more", (nth == 1).cast("long"))
    return written(rows.filter(~found).unionByName(one).drop("_mx_gap", "_mx_best"), name)


def taken_rows(rows: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` (id, source, size) with source_size, target, ``epochs`` (how often a row is taken)
    and ``taken`` (size times epochs). ``targets``: source, source_size, source_rows, target.

    Whole repetitions are the same for all rows of a source. For the fraction, rows stand in the
    order of a seeded hash. Long rows (above 1 / LONG of the fraction) are decided first, up to their
    share of the source's words; then the others fill what is left, and after them all rows that still
    fit, until none does. Last comes the one further row whose size is nearest to the gap. Each pass
    sums per (source, hash bin); only the bin in which the sum exceeds the gap (about ``BIN_ROWS`` rows,
    or one in ``2 ** BIN_BITS`` of a large source) is sorted by a task.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    t = targets.select(
        F.col("source").alias("_mx_source"),
        "source_size",
        "target",
        whole.alias("_mx_whole"),
        (F.col("target") - whole * F.col("source_size")).alias("_mx_extra"),
        _bits("source_rows").alias("_mx_bits"),
    )
    # One row per source, so a source that holds many rows meets a single row.
    rows = rows.join(t, F.col("source").eqNullSafe(F.col("_mx_source"))).drop("_mx_source")
    rows = rows.withColumn("_mx_draw", _draw(F.col("id"), seed))
    rows = rows.withColumn("_mx_bin", _bin(F.col("_mx_draw"), F.col("_mx_bits")))
    is_long = F.col("size") * LONG > F.col("_mx_extra")
    longs = rows.filter(is_long).groupBy(F.col("source").alias("_mx_s")).agg(F.sum("size").alias("_mx_long"))
    longs = written(longs, "mix-longs")
    rows = rows.join(longs, F.col("source").eqNullSafe(F.col("_mx_s")), "left").drop("_mx_s")
    rows = rows.withColumn("_mx_more", F.lit(0).cast("long"))
    rows = written(rows.withColumn("_mx_long", F.coalesce("_mx_long", F.lit(0))), "mix-drawn")
    share = F.when(F.col("source_size") > 0, F.col("_mx_extra") * F.col("_mx_long") / F.col("source_size")).otherwise(0.0)
    if not rows.filter(is_long & (F.col("_mx_extra") > 0)).isEmpty():
        rows = _filled(_with_gaps(rows, share), is_long, "mix-long")
        fits = F.col("size") <= F.col("_mx_gap") + F.col("_mx_extra") - share
        rows = _nearest(_with_gaps(rows, share), is_long & fits, "mix-long")
    rows = _filled(_with_gaps(rows), ~is_long, "mix-filled")
    while True:
        gaps = _with_gaps(rows)
        if gaps.filter("_mx_more = 0 AND size > 0 AND size <= _mx_gap").isEmpty():
            break
        rows = _filled(gaps, F.lit(True), "mix-filled")
    out = _nearest(gaps, F.lit(True), "mix-taken")
    out = out.withColumn("epochs", (F.col("_mx_whole") + F.col("_mx_more")).cast("long"))
    out = out.withColumn("taken", F.col("epochs") * F.col("size"))
    return out.select("id", "source", "size", "source_size", "target", "epochs", "taken")


def weighted_sources(sizes: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """``sizes`` (source, source_size) with ``weight``: the sources by code point, null last, take
    the weights in turn. One row per source is ranked; sources are ranked by one window over them."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    at = F.pmod(rank, F.lit(len(weights))) + 1
    return sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at.cast("int")))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.0,
    max_epochs: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """How often each document is taken by a mix of ``share`` times all words.

    Returns doc_id, source, size, source_size, target, epochs, taken, one row per row of ``docs``.
    A null source is a source of its own; a null or empty text has size 0 and is taken with its
    source's whole repetitions (0 words). Repeated rows are drawn alike. An empty table gives no
    rows. Only the id, text and source columns are read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size")
    )
    rows = written(rows, "mix-sizes")
    sizes = written(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows")), "mix-sources")
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    targets = water_filled(weighted_sources(sizes, weights), share * total, max_epochs)
    targets = written(targets.select("source", "source_size", "source_rows", "target"), "mix-targets")
    out = taken_rows(rows, targets, seed=seed)
    return out.withColumnRenamed("id", "doc_id")


def decisions(taken: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """What ``mix`` decided, in two small tables: ``bins`` (source, bits, bin, epochs), what most rows of
    a source's hash bin have, and ``others`` (doc_id, source, epochs), the rows that differ from it.

    A pass takes whole bins, so the others are the rows of the bins in which a pass ended, long rows
    and rows of no words. Repeated ids of a source count as often as the one taken most."""
    ids = taken.filter("doc_id IS NOT NULL").groupBy("source", "doc_id").agg(F.max("epochs").alias("epochs"))
    ids = written(ids, "mix-ids")
    bits = ids.groupBy(F.col("source").alias("_mx_s")).agg(F.count("*").alias("n")).select("_mx_s", _bits("n").alias("bits"))
    bits = written(bits, "mix-bits")
    ids = ids.join(bits, F.col("source").eqNullSafe(F.col("_mx_s"))).drop("_mx_s")
    ids = ids.withColumn("bin", _bin(_draw(F.col("doc_id"), seed), F.col("bits")))
    votes = ids.groupBy("source", "bits", "bin", "epochs").agg(F.count("*").alias("n"))
    most = F.max_by("epochs", F.struct("n", "epochs")).alias("epochs")
    bins = written(votes.groupBy("source", "bits", "bin").agg(most), "mix-bins")
    usual = bins.select(F.col("source").alias("_mx_s"), F.col("bin").alias("_mx_b"), F.col("epochs").alias("usual"))
    same = F.col("source").eqNullSafe(F.col("_mx_s")) & (F.col("bin") == F.col("_mx_b"))
    others = ids.join(usual, same).filter("epochs <> usual").select("doc_id", "source", "epochs")
    return bins, written(others, "mix-others")


def repeated(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = SEED, **settings
) -> DataFrame:
    """``docs`` with each row as often as ``mix`` takes it, all columns kept, whatever their names. Rows
    without an id go through once. Repeated rows of one id and source are drawn alike.

    Documents are decided where they lie: they meet a row per hash bin and the few ids that differ
    from their bin's. Both tables are written, so Spark broadcasts them if their sizes allow it, and else
    joins by shuffles."""
    bins, others = decisions(mix(docs, id_col=id_col, source_col=source_col, seed=seed, **settings), seed)
    bits = written(bins.select("source", "bits").distinct(), "mix-bits")
    src, nbits, bsrc, nbin, usual, own, osrc, special, times = (
        free_name(docs, f"mix_{x}") for x in ("s", "bits", "bs", "bin", "usual", "id", "os", "special", "times")
    )
    id, source = F.col(f"`{id_col}`"), F.col(f"`{source_col}`").cast("string")
    bits = bits.select(F.col("source").alias(src), F.col("bits").alias(nbits))
    bins = bins.select(F.col("source").alias(bsrc), F.col("bin").alias(nbin), F.col("epochs").alias(usual))
    others = others.select(F.col("doc_id").alias(own), F.col("source").alias(osrc), F.col("epochs").alias(special))
    joined = docs.join(bits, source.eqNullSafe(F.col(src)), "left")
    at = _bin(_draw(id, seed), F.col(nbits))
    joined = joined.join(bins, source.eqNullSafe(F.col(bsrc)) & (at == F.col(nbin)), "left")
    joined = joined.join(others, (id == F.col(own)) & source.eqNullSafe(F.col(osrc)), "left")
    often = F.when(id.isNull(), 1).otherwise(F.coalesce(special, usual, F.lit(1))).cast("int")
    copies = F.explode(F.array_repeat(F.lit(1), often))
    return joined.withColumn(times, copies).select(*[docs[f"`{c}`"] for c in docs.columns])

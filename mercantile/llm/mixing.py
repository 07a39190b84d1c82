"""Mixing sources to target weights by entropy balancing [native].

Every document gets a rate; of all rates that meet one token constraint per
source, those of least relative entropy are taken.  The dual is convex in one
multiplier per source; its Newton steps are distributed sums over the documents.
The primal solution tilts a document's rate exponentially with its tokens, up
to a cap.  Rates are rounded into whole copies so that each source's words stay
near its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import dense_keys, place, placed_totals
from .common import clean_text, materialise, register, table

WORD = r"[^\x20\x09-\x0D]+"
#: Documents rounded together; bounds the array one task folds at a time.
FOLD = 500
#: Equal rows that one task deals out at a time.
CHUNK = 10_000


def word_count(text_col: str) -> Column:
    return F.regexp_count(clean_text(text_col), F.lit(WORD)).cast("long")


def water_fill(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Targets per source: ``share`` of all words split by repeating
    ``weights`` in code point order of the source (NULL last); a target stops
    at ``cap`` times its source and the excess is shared again by weight until
    none is above.

    That limit is min(cap * size, weight * level).  The level is found from
    running sums in order of cap / weight: the last source with
    weight * level >= cap marks the capped prefix."""
    # Range-partitioned numbering and sums: no task holds all sources.
    named = sources.withColumn("is_null", F.col("source").isNull().cast("int"))
    ranked = dense_keys(named, ["is_null", "source"], start=-1, out="nth")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("nth"), F.lit(len(weights))) + 1).cast("int"))
    ranked = (ranked.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
              .withColumn("turn", F.col("cap") / F.col("weight")).withColumn("one", F.lit(1)))
    sums = {"caps_to": F.col("cap"), "weights_to": F.col("weight")}  # both over one layout
    summed = materialise(placed_totals(place(ranked, ["one"], ["turn", "nth"]), ["one"], sums), "mix-levels")
    total = summed.agg(F.struct((F.sum("source_size") * F.lit(float(share))).alias("total"),
                                F.sum("weight").alias("all_w"))).scalar()
    # Source k is capped when filling it, after the ones before it, needs no
    # more than what is left: caps_before + turn_k * weights_from_k <= total.
    levels = summed.withColumn("_t", total)
    is_capped = ((F.col("caps_to") - F.col("cap"))
                 + F.col("turn") * (F.col("_t.all_w") - F.col("weights_to") + F.col("weight"))) <= F.col("_t.total")
    levels = levels.withColumn("capped", is_capped)
    rest = levels.agg(F.struct(
        F.max("_t.total").alias("t"),
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))), F.lit(0.0)).alias("spent"),
        F.sum(F.when(~F.col("capped"), F.col("weight"))).alias("open_w"))).scalar()
    levels = levels.withColumn("_r", rest)
    level = F.greatest((F.col("_r.t") - F.col("_r.spent")) / F.col("_r.open_w"), F.lit(0.0))
    return (levels.withColumn("target", F.when(F.col("capped"), F.col("cap"))
                              .otherwise(F.least(F.col("weight") * level, F.col("cap"))))
            .select("source", "source_size", F.coalesce("target", F.lit(0.0)).alias("target")))


def tilted_rate(lam: Column, size: Column, scale: Column, cap: float) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(lam * size / scale, F.lit(50.0))))


def dual_multipliers(rows: DataFrame, targets: DataFrame, cap: float, tolerance: float = 1e-9,
                     most: int = 60) -> DataFrame:
    """Multipliers of the entropy balancing problem over documents

        minimise  sum of w log w - w   with   sum of w * size = target  in every
        source and w <= cap;  its solution is  w = min(cap, exp(lam * size / scale)).

    The dual is convex in the source's ``lam``.  A Newton step is one native
    aggregate over the documents, all open sources at once: gradient sum(w * size) -
    target and Hessian, the same sum over size / scale where the cap does not
    bind.  Steps that leave the bracket of the root are halved; iteration stops
    on the residual of the constraints.  Documents of equal source and size are
    counted first.  ``scale`` is the source's size-weighted mean size.

    Returns targets with ``scale``, ``lam`` and ``fixed``: the rate of sources
    that need no solution (0 without words or target, the cap at full target)."""
    bins = materialise(rows.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("m")), "mix-bins")
    scale = bins.groupBy("source").agg((F.sum(F.col("m") * F.col("size") * F.col("size"))
                                        / F.sum(F.col("m") * F.col("size"))).alias("scale"))
    scale = scale.withColumnRenamed("source", "_s")
    full = F.col("target") >= F.col("source_size") * F.lit(cap * (1 - 1e-12))
    fixed = F.when((F.col("source_size") <= 0) | (F.col("target") <= 0), 0.0).when(full, float(cap))
    none = F.lit(None).cast("double")
    state = materialise(
        targets.join(scale, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumn("fixed", fixed)
        .withColumn("lam", F.when(F.col("fixed").isNull(), F.log(F.col("target") / F.col("source_size"))))
        .withColumns({"lo": none, "hi": none}), "mix-multipliers")
    # A step meets the bins once: the state of an open source is its group's key.
    held = ["source", "source_size", "target", "scale", "fixed", "lam", "lo", "hi"]
    decided, state = state.where("fixed IS NOT NULL").select(*held), state.where("fixed IS NULL").select(*held)
    sized = bins.withColumnRenamed("source", "_s")
    w = tilted_rate(F.col("lam"), F.col("size"), F.col("scale"), cap)
    mass = F.col("m") * F.col("size") * w
    g = F.col("got") - F.col("target")
    newton, off = F.col("lam") - g / F.col("h"), F.abs(g) / F.col("target")
    safe = (F.col("h") > 0) & (F.col("lo").isNull() | (newton > F.col("lo"))) & (F.col("hi").isNull() | (newton < F.col("hi")))
    half = (F.coalesce("lo", F.col("hi") - 2) + F.coalesce("hi", F.col("lo") + 2)) / 2
    for _ in range(most):
        step = (sized.join(state, F.col("_s").eqNullSafe(F.col("source"))).groupBy(*held)
                .agg(F.sum(mass).alias("got"),
                     F.sum(F.when(w < cap, mass * F.col("size") / F.col("scale")).otherwise(0.0)).alias("h")))
        moved = (step.withColumns({"off": off, "lo": F.when(g < 0, F.col("lam")).otherwise(F.col("lo")),
                                   "hi": F.when(g > 0, F.col("lam")).otherwise(F.col("hi"))})
                 .withColumn("lam", F.when(F.col("off") <= tolerance, F.col("lam")).when(safe, newton).otherwise(half)))
        # The residual comes with the write; a query of its own would double the driver's plans.
        seen = Observation()
        state = materialise(moved.select(*held, "off").observe(seen, F.max("off").alias("worst")),
                            "mix-multipliers").drop("off")
        worst = seen.get.get("worst")
        if worst is None or worst <= tolerance:
            break
    state = state.unionByName(decided)
    # Sums of doubles depend on the order of tasks; reruns shall agree.
    return state.select("source", "source_size", "target", "scale", F.round("lam", 6).alias("lam"), "fixed")


def round_copies(rows: DataFrame, max_copies: int) -> DataFrame:
    """Whole copies from rates: within a bucket of about ``FOLD`` documents of
    one source, largest first, documents take extra copies while the words owed
    cover at least half of one.  What a bucket owes at its end is less than a
    small document, so the sums stay near the targets.  Buckets split hot
    sources; equal (doc_id, source, size) rows are counted first, share their
    extra copies, and are dealt out again in chunks of ``CHUNK`` rows."""
    same = ["source", "doc_id", "size", "source_size", "target", "rate"]
    counted = materialise(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("m")), "mix-rows")
    n = counted.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / F.lit(FOLD)).alias("buckets")).withColumnRenamed("source", "_s")
    keyed = (counted.join(n, F.col("source").eqNullSafe(F.col("_s")))
             .withColumn("bucket", F.pmod(F.xxhash64(F.lit("mix"), "doc_id", "size"), F.col("buckets"))))
    rate = F.least(F.col("rate"), F.lit(float(max_copies)))
    keyed = (keyed.withColumn("base", F.floor(rate)).withColumn("part", rate - F.floor(rate)))
    item = F.struct((-F.col("size")).alias("neg"), F.xxhash64(F.lit("tie"), "doc_id").alias("tie"),
                    "doc_id", "size", "base", "part", "m", "source_size", "target")
    groups = keyed.groupBy("source", "bucket").agg(F.array_sort(F.collect_list(item)).alias("items"))
    start = F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<long>").alias("extra"))

    def fold(acc, x):
        size = x["size"].cast("double")
        owed = acc["owed"] + x["part"] * size * x["m"]
        take = F.when((x["part"] > 0) & (size > 0), F.least(x["m"], F.floor(F.greatest(owed, F.lit(0.0)) / size + 0.5))).otherwise(0)
        return F.struct((owed - take * size).alias("owed"), F.concat(acc["extra"], F.array(take.cast("long"))).alias("extra"))

    extra = F.aggregate("items", start, fold, lambda acc: acc["extra"])
    dealt = (groups.withColumn("extra", extra).select("source", F.explode(F.arrays_zip("items", "extra")).alias("z"))
             .select("source", "z.items.*", "z.extra"))
    chunk = lambda df: df.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / CHUNK).cast("int"))))
    few, many = dealt.where(F.col("m") <= CHUNK), dealt.where(F.col("m") > CHUNK)
    rows_of = chunk(few).unionAll(chunk(many).repartition("doc_id", "chunk"))
    first = F.col("chunk").cast("long") * CHUNK
    return (rows_of.withColumn("nth", F.explode(F.sequence(first + 1, F.least(F.col("m"), first + CHUNK))))
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("base") + F.when(F.col("nth") <= F.col("extra"), 1).otherwise(0)).cast("int").alias("copies")))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                cap: float = 2.0, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """Copies per document: doc_id, source, size, source_size, target, copies.

    Size is the number of words (0 for NULL or empty text; whole texts of any
    length are counted).  NULL is a source of its own, last in order.  A
    document takes at most ``cap`` copies.  Repeated rows are documents of their
    own; an empty table gives an empty result; other columns are ignored.  Ties
    break by hash and id, so reruns agree."""
    rows = materialise(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                   word_count(text_col).alias("size")), "mix-sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(water_fill(sources, weights, share, cap), "mix-targets")
    solved = dual_multipliers(rows, targets, cap).withColumnRenamed("source", "_s")
    joined = (rows.join(solved, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
              .withColumn("rate", F.coalesce("fixed", tilted_rate(F.col("lam"), F.col("size"), F.col("scale"), cap))))
    return round_copies(joined, int(cap))


@register("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")

"""Stock-checked order admission.

Rule per order line, in arrival order: if the product's remaining stock is
below the quantity the line is refused (and uses no stock), otherwise stock
falls by the quantity.  A NULL quantity is quarantined; a quantity <= 0 or an
unknown product is refused.

* ``atomic``: the batch is one transaction.  Lines of a product all pass iff
  the product's total demand fits its stock (stock only falls, so the
  sequential check reduces to the total); one failure refuses the batch.
  Fully native: one partial aggregation plus a one-row scalar flag.
* ``greedy``: each line is its own transaction.  A refused line does not use
  stock, so later smaller lines may still pass; a running sum over all lines
  would be wrong.  Exact, native and distributed:

  1. products whose total demand fits their stock accept every line;
  2. the others accept the prefix that fits; the first line that does not is
     refused and leaves the stock ``s``, which never rises again, so later
     lines above ``s`` are refused at once;
  3. what remains goes in levels.  Let ``b`` be the largest power of two not
     above ``s``.  While at least ``b`` is left, every line below ``b`` fits,
     and only one line of ``b`` or more can be taken before less than ``b`` is
     left.  So a running sum of the lines below ``b`` and one minimum find
     where the level ends, for all products at once, and the next level has at
     most half of ``b``: at most log2(stock) + 1 rounds, whatever the number
     of lines.  Running sums spread a hot product over many tasks.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import PID, place, placed_totals
from ..session import ensure_checkpoint_dir, written

ARRIVAL_ORDER = ("arrival", "order_id", "line_no", "product_id", "quantity", "price")
SHORT = "not enough stock"


class Admission(NamedTuple):
    accepted: DataFrame
    refused: DataFrame
    products: DataFrame
    shortages: DataFrame


def _screen(items: DataFrame, products: DataFrame, key: str, qty: str) -> DataFrame:
    """Every line with its product's stock and, for lines that never reach the
    stock check, the reason."""
    stock = products.select(F.col(key).alias("_pk"), F.col("stock").cast("long").alias("_stock"),
                            F.lit(True).alias("_known"))
    j = items.join(stock, items[key] == stock["_pk"], "left").drop("_pk")
    reason = (F.when(F.col(qty).isNull(), F.lit("quantity is null"))
              .when(F.col(qty) <= 0, F.lit("quantity must be positive"))
              .when(F.col("_known").isNull(), F.lit("unknown product")))
    return j.withColumn("_reason", reason).drop("_known")


def _new_stock(products: DataFrame, accepted: DataFrame, key: str, qty: str) -> DataFrame:
    used = accepted.groupBy(key).agg(F.sum(qty).alias("_used"))
    return (products.join(used, key, "left")
            .withColumn("stock", (F.col("stock") - F.coalesce(F.col("_used"), F.lit(0))).cast("int"))
            .drop("_used").select(*products.columns))


def admit(items: DataFrame, products: DataFrame, mode: str = "greedy",
          order: tuple[str, ...] = ARRIVAL_ORDER, key: str = "product_id",
          qty: str = "quantity") -> Admission:
    """Admit order lines against product stock (see module doc)."""
    if mode not in ("atomic", "greedy"):
        raise ValueError(f"mode must be 'atomic' or 'greedy', not {mode!r}")
    cols = items.columns
    screened = _screen(items, products, key, qty)
    if mode == "greedy":  # read once for the demand and once for the lines
        ensure_checkpoint_dir(items.sparkSession)
        screened = screened.checkpoint(eager=True)
    good = screened.where(F.col("_reason").isNull())
    bad = screened.where(F.col("_reason").isNotNull()).select(*cols, F.col("_reason").alias("reason"))
    demand = good.groupBy(key).agg(F.sum(qty).cast("bigint").alias("demand"))
    if mode == "greedy":  # joined with the lines, a hot product's included
        demand = written(demand)
    shortages = (demand.join(products.select(key, "stock"), key, "inner")
                 .where(F.col("stock") < F.col("demand")).select(key, "stock", "demand"))
    if mode == "atomic":
        ok = F.struct(shortages.select(F.count(F.lit(1)).alias("n")).scalar().alias("short"),
                      bad.select(F.count(F.lit(1))).scalar().alias("bad"))
        passes = (ok.getField("short") == 0) & (ok.getField("bad") == 0)
        accepted = items.where(passes)
        refused = (bad.unionByName(good.select(*cols, F.lit("batch refused").alias("reason")))
                   .where(~passes))
        new_products = products.join(demand, key, "left").withColumn(
            "stock", F.when(passes, (F.col("stock") - F.coalesce(F.col("demand"), F.lit(0))).cast("int"))
            .otherwise(F.col("stock"))).select(*products.columns)
        return Admission(accepted, refused, new_products, shortages)

    with_demand = good.join(demand, key, "inner")
    fits = F.col("_stock").isNull() | (F.col("demand") <= F.col("_stock"))
    verdicts = [with_demand.where(fits).select(*cols, F.lit(True).alias("accepted"))]
    short = with_demand.where(~fits).select(*cols, F.col("_stock").alias("_r"))
    open_ = place(short, [key], [c for c in order if c != key and c in cols])
    step = _prefix
    while True:
        round_ = _settle(open_, key, qty, *step(key, qty)).checkpoint(eager=True)
        verdicts.append(round_.where(F.col("accepted").isNotNull()).select(*cols, "accepted"))
        open_ = round_.where(F.col("accepted").isNull()).drop("accepted")
        step = _level
        if open_.isEmpty():
            break
    decided = reduce(DataFrame.unionByName, verdicts)
    accepted = decided.where(F.col("accepted")).select(*cols)
    refused = bad.unionByName(decided.where(~F.col("accepted")).select(*cols, F.lit(SHORT).alias("reason")))
    return Admission(accepted, refused, _new_stock(products, accepted, key, qty), shortages)


def _prefix(key: str, qty: str) -> tuple[Column, Column, Column, Column, Column]:
    """The prefix that fits ends at the first line that does not."""
    before = F.col("_r") - (F.col("_sum") - F.col(qty))
    return F.col(qty), F.lit(True), F.col("_sum") > F.col("_r"), before, F.lit(False)


def _level(key: str, qty: str) -> tuple[Column, Column, Column, Column, Column]:
    """The level of lines below ``b``: it ends with the line that leaves less
    than ``b``, be it a small one or the first large one that fits."""
    b = F.expr("shiftleft(1L, length(bin(_r)) - 1)")
    small = F.col(qty) < b
    left = F.col("_r") - F.col("_sum")
    ends = F.when(small, left < b).otherwise(F.col(qty) <= left)
    after = F.when(small, left).otherwise(left - F.col(qty))
    return F.when(small, F.col(qty)).otherwise(0), small, ends, after, F.lit(True)


def _settle(open_: DataFrame, key: str, qty: str, value: Column, fits: Column, ends: Column,
            after: Column, end_fits: Column) -> DataFrame:
    """One round: lines before a product's end are accepted where ``fits``,
    the end itself as ``end_fits`` says; later lines above the stock ``after``
    it are refused, the others stay open (NULL) with that stock.

    The ends meet the lines by piece (partition, product), as the running sums
    did: a hot product stays spread and no line is shuffled for it."""
    summed = placed_totals(open_, [key], {"_sum": value})
    end = (summed.where(ends).groupBy(key)
           .agg(F.min("_mono").alias("_end"), F.min_by(after, "_mono").alias("_left")))
    ends_by_piece = open_.select(PID, key).distinct().join(end, key, "inner")
    late = F.col("_mono") > F.col("_end")
    verdict = (F.when(F.col("_end").isNull() | (F.col("_mono") < F.col("_end")), fits)
               .when(F.col("_mono") == F.col("_end"), end_fits)
               .when(F.col(qty) > F.col("_left"), F.lit(False)))
    return (summed.join(ends_by_piece, [PID, key], "left").withColumn("accepted", verdict)
            .withColumn("_r", F.when(late, F.col("_left")).otherwise(F.col("_r")))
            .drop("_sum", "_end", "_left"))


class LoadAdmission(NamedTuple):
    loads: DataFrame        # load id, accepted flag, reason
    accepted: DataFrame     # lines of accepted loads
    refused: DataFrame      # lines of refused loads, with the load's reason
    products: DataFrame     # stock after the accepted loads


def admit_loads(items: DataFrame, products: DataFrame, load: str, load_order: tuple[str, ...] | None = None,
                key: str = "product_id", qty: str = "quantity") -> LoadAdmission:
    """M16 on the ingest path: every load (one workbook or file) is one
    transaction, applied in ``load_order`` (default: the load id).  A load is
    accepted only if none of its lines is bad and, for every product, its
    total quantity fits the stock left by the loads accepted before it.

    Loads couple products, so the rounds work on (load, product, demand)
    rows.  Products that can serve all loads decide nothing and go first.  A
    round decides every load that is certain, from two running sums per
    product in load order: accepted if for all its products even the accepted
    *and* undecided loads before it leave room, refused if some product falls
    short after the accepted ones alone.  The first undecided load is always
    certain, so the rounds end; loads without a common short product are
    decided side by side."""
    ensure_checkpoint_dir(items.sparkSession)
    order_cols = list(load_order or (load,))
    # One position per load (its smallest order key, then the load id).
    position = items.groupBy(load).agg(
        F.min(F.struct(*[F.col(c) for c in order_cols], F.col(load))).alias("_lo"))
    screened = _screen(items, products, key, qty)
    bad_loads = (screened.where(F.col("_reason").isNotNull())
                 .groupBy(load).agg(F.min("_reason").alias("reason"))).checkpoint(eager=True)
    demand = (screened.where(F.col("_reason").isNull()).join(bad_loads.select(load), load, "left_anti")
              .groupBy(load, key).agg(F.sum(qty).cast("bigint").alias("_d"), F.first("_stock").alias("_r"))
              .checkpoint(eager=True))
    tight = (demand.groupBy(key).agg(F.sum("_d").alias("_all"), F.first("_r").alias("_r"))
             .where(F.col("_all") > F.col("_r")).select(key))
    rows = demand.join(tight, key, "left_semi").join(position, load, "inner").withColumn("_in", F.lit(False))
    free = (demand.select(load).distinct()
            .join(demand.join(tight, key, "left_semi").select(load).distinct(), load, "left_anti"))
    parts = [bad_loads.select(load, F.lit(False).alias("accepted"), "reason"),
             free.select(load, F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("reason"))]
    rows = place(rows, [key], ["_lo"])
    while not rows.where(~F.col("_in")).isEmpty():
        summed = placed_totals(rows, [key], {
            "_sure": F.when(F.col("_in"), F.col("_d")).otherwise(0),
            "_maybe": F.when(F.col("_in"), 0).otherwise(F.col("_d"))})
        certain = (summed.where(~F.col("_in")).groupBy(load).agg(
            F.min(F.col("_sure") + F.col("_maybe") <= F.col("_r")).alias("_yes"),
            F.max(F.col("_sure") + F.col("_d") > F.col("_r")).alias("_no"))
            .where(F.col("_yes") | F.col("_no")).select(load, F.col("_yes").alias("_ok")).checkpoint(eager=True))
        parts.append(certain.select(load, F.col("_ok").alias("accepted"),
                                    F.when(~F.col("_ok"), F.lit(SHORT)).alias("reason")))
        rows = (rows.join(certain, load, "left").where(F.coalesce("_ok", F.lit(True)))
                .withColumn("_in", F.col("_in") | F.coalesce("_ok", F.lit(False))).drop("_ok")
                .checkpoint(eager=True))
    loads = reduce(DataFrame.unionByName, parts)
    accepted = items.join(loads.where(F.col("accepted")), load, "left_semi")
    refused = (items.join(loads.where(~F.col("accepted")).select(load, "reason"), load, "inner")
               .select(*items.columns, "reason"))
    return LoadAdmission(loads, accepted, refused, _new_stock(products, accepted, key, qty))

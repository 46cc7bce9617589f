"""Mixing sources to target weights by entropy balancing.

Every document gets a rate close to 1 in relative entropy, such that the rates times the document
sizes meet each source's token target. The dual has one multiplier per source and yields rates
``exp(multiplier * size / largest size)``, at most ``CAP``. Newton steps solve it; each is one
distributed aggregate over the counts of (source, size), which is all that the rates depend on.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import write_out
from .common import WORD, fresh, same

CAP = 3.0
BLOCK = 5000  # documents rounded together
STEPS = 40
NEAR = 1e-7


def source_targets(sized: DataFrame, cap: float = CAP, cycle: int = 3) -> DataFrame:
    """One row per source: ``sid`` (by code point, null last), ``weight`` 1..cycle, ``source_size``,
    ``largest``, ``n_docs`` and ``target``.

    The targets share all sizes by weight; one above ``cap`` times its source's size stops there and
    the excess is shared again. In order of ``cap * size / weight`` the stopped sources are the first
    ones, so one ordered pass over the rows (one per source) finds them.
    """
    per = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.max("size").alias("largest"), F.count(F.lit(1)).alias("n_docs"))
    named = per.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    named = named.withColumn("weight", ((F.col("sid") - 1) % cycle + 1).cast("double"))
    named = named.withColumn("_room", F.col("source_size") * F.lit(cap))
    whole = Window.partitionBy()
    named = named.withColumn("_total", F.sum("source_size").over(whole).cast("double")).withColumn("_weights", F.sum("weight").over(whole))
    before = Window.orderBy(F.col("_room") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_total") - F.coalesce(F.sum("_room").over(before), F.lit(0.0))
    weights = F.col("_weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    named = named.withColumn("_full", left / weights * F.col("weight") > F.col("_room"))
    rest = F.col("_total") - F.sum(F.when(F.col("_full"), F.col("_room")).otherwise(0.0)).over(whole)
    shares = F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("weight"))).over(whole)
    target = F.when(F.col("_full"), F.col("_room")).otherwise(rest * F.col("weight") / shares)
    return named.select("source", "sid", "weight", "source_size", "largest", "n_docs", target.alias("target"))


def _rate(cap: float) -> Column:
    """The tilted rate of a document; the exponent is held below the one that any cap needs."""
    tilt = F.col("multiplier") * F.col("size") / F.greatest(F.col("largest"), F.lit(1))
    return F.when(F.col("source_size") <= 0, F.lit(1.0)).when(F.col("target") >= F.col("source_size") * F.lit(cap) * (1 - 1e-12), F.lit(cap)).otherwise(
        F.least(F.lit(cap), F.exp(F.least(tilt, F.lit(50.0)))))


def balance(counts: DataFrame, sources: DataFrame, cap: float = CAP, steps: int = STEPS) -> DataFrame:
    """``sid`` and ``multiplier`` such that rates meet the targets.

    ``counts`` has ``sid, size, n``. The words taken rise with the multiplier, so each step also keeps
    a bracket and a Newton step that leaves it is replaced by the middle.
    """
    state = sources.select("sid", "target", "source_size", "largest", F.lit(0.0).alias("multiplier"),
                           F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"))
    for _ in range(steps):
        rated = counts.join(state, "sid").withColumn("rate", _rate(cap))
        words = F.col("n") * F.col("size") * F.col("rate")
        slope = F.when(F.col("rate") < cap, words * F.col("size") / F.greatest(F.col("largest"), F.lit(1))).otherwise(0.0)
        sums = rated.groupBy("sid").agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        moved = state.join(sums, "sid").withColumn("off", F.col("words") - F.col("target"))
        done = (F.abs("off") <= F.col("target") * NEAR) | (F.col("target") >= F.col("source_size") * F.lit(cap) * (1 - 1e-12)) \
            | (F.col("target") <= 0)
        low = F.when(F.col("off") < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(F.col("off") > 0, F.col("multiplier")).otherwise(F.col("high"))
        step = F.col("multiplier") - F.col("off") / F.col("slope")
        middle = F.when((low <= -1e6) & (high < 1e6), high * 2 - 1).when((high >= 1e6) & (low > -1e6), low * 2 + 1).otherwise((low + high) / 2)
        chosen = F.when(done, F.col("multiplier")).when((F.col("slope") > 0) & (step > low) & (step < high), step).otherwise(middle)
        state = write_out(moved.select("sid", "target", "source_size", "largest", chosen.alias("multiplier"),
                                       low.alias("low"), high.alias("high"), done.alias("done")).coalesce(1), "balance")
        if state.filter(~F.col("done")).isEmpty():
            break
        state = state.drop("done")
    return state.select("sid", "multiplier")


def _copies(part: pa.Table) -> pa.Table:
    """Whole copies: largest documents first, each carrying on what rounding left over so far."""
    part = part.take(pc.sort_indices(part, [("size", "descending"), ("doc_id", "ascending"), ("row_hash", "ascending")]))
    carry, out, cap = 0.0, [], int(part["cap"][0].as_py())
    for size, rate in zip(part["size"].to_pylist(), part["rate"].to_pylist()):
        if size == 0:
            out.append(min(int(rate + 0.5), cap))
            continue
        want = rate * size + carry
        n = min(max(int(want / size + 0.5), 0), cap)
        carry = want - n * size
        out.append(n)
    return part.select(["doc_id", "row_hash", "size", "sid"]).append_column("copies", pa.array(out, pa.int32()))


def mix(sized: DataFrame, cap: float = CAP, block: int = BLOCK) -> DataFrame:
    """Copies per document: ``doc_id, source, size, source_size, target, rate bounds`` to ``copies``.

    ``sized`` needs ``doc_id, source, size`` and may carry ``row_hash``, which tells apart rows of one id.
    Null sources are a source of their own, listed last; sizes of 0 keep their row and take no words;
    an empty table gives no rows; rows that repeat are rounded one by one. A block of a source (by hash
    of the id) is rounded on its own, so no task holds a whole source.
    """
    if "row_hash" not in sized.columns:
        sized = sized.withColumn("row_hash", F.lit(0).cast("long"))
    sized = write_out(sized.select("doc_id", "source", F.col("size").cast("long").alias("size"), "row_hash"), "mix-sizes")
    sources = write_out(source_targets(sized, cap), "mix-sources")
    keyed = sized.join(sources, same(sized, sources, ["source"])).select(
        sized["doc_id"], sized["row_hash"], sized["size"], *[sources[c] for c in ("sid", "source_size", "largest", "n_docs", "target")])
    counts = write_out(keyed.groupBy("sid", "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    found = balance(counts, sources, cap)
    parts = F.ceil(F.col("n_docs") / block)
    rated = keyed.join(found, "sid").withColumn("rate", _rate(cap)).withColumn("cap", F.lit(cap)) \
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "row_hash"), parts))
    rounded = rated.select("doc_id", "row_hash", "size", "sid", "rate", "cap", "block").groupBy("sid", "block").applyInArrow(
        _copies, "doc_id long, row_hash long, size long, sid long, copies int")
    return rounded.join(sources.select("sid", "source", "source_size", "target"), "sid")


def sized_documents(docs: DataFrame) -> DataFrame:
    words = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0))
    return docs.select("doc_id", "source", words.cast("long").alias("size"), F.xxhash64("text").alias("row_hash"))


def op6(docs: DataFrame) -> DataFrame:
    mixed = mix(sized_documents(docs))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents, each as often as the mix takes it; all columns stay as they are."""
    copy, = fresh(docs, "_copy")
    taken = mix(sized_documents(docs)).filter("copies > 0").groupBy("doc_id", "row_hash").agg(F.max("copies").alias("times"))
    met = docs.join(taken, docs["doc_id"].eqNullSafe(taken["doc_id"]) & (F.xxhash64(docs["text"]) == taken["row_hash"]))
    return met.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), taken["times"])).alias(copy)).drop(copy)

"""Mixing sources to target weights with hash-threshold histograms.

No row is ever sorted.  Each row gets a uniform hash; its source's words are
summed per (source, leading hash digits), the bucket in which the running sum
crosses the budget is found, and only that bucket is split by the next digits,
until its rows share one hash.  The outcome is one threshold per source, and
the mix is a filter ``hash <= threshold``.  Thresholds are nested: a larger
budget takes a superset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestar.llm.common import hash60, materialize, source_name, word_count
from lodestar.operators.joins import bounded_broadcast
from lodestar.operators.ordering import dense_row_ids

WEIGHTS = (5, 2, 1)  # by rank of the source, repeating
SHARE = 1.5  # all targets together, in sizes of the corpus
LIMIT = 2  # a target stops at this many times its source's size
_BITS, _STEP = 60, 12  # hash width; bits refined per histogram
_SALTS = 64  # rows of one source are dealt over so many join keys


def source_targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """source, source_size -> the same plus ``target``.

    Sources are ranked by code point (null last) and weigh ``weights``,
    repeating.  Targets share ``share`` x all sizes by weight; a target above
    ``limit`` x its source's size stops there and the excess is shared again
    by weight among the others, until none is above.
    """
    # rank: code-point order is byte order of UTF-8; the null source sorts behind every name
    keyed = totals.withColumn("_key", F.coalesce(F.hex(F.encode("source", "UTF-8")), F.lit("~")))
    ranked = materialize(dense_row_ids(keyed, "_key", id_col="_rank", start=0).drop("_key"), "mix-sources")
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("_w", pick.cast("long"))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    # one number solves it: target = min(limit * size, weight * rate); capped sources only grow in number
    cap, rate, capped = F.col("source_size") * limit, None, -1
    while True:
        over = F.lit(False) if rate is None else cap * F.lit(rate[1]) < F.col("_w") * F.lit(rate[0])
        row = ranked.agg(F.count_if(over), F.sum(F.when(over, cap).otherwise(0)),
                         F.sum(F.when(over, 0).otherwise(F.col("_w")))).first()
        if row[0] == capped or not row[2]:
            break
        capped, rate = row[0], (float(share * total - (row[1] or 0)), float(row[2]))
    if rate is None:
        return ranked.select("source", "source_size", F.lit(0.0).alias("target"))
    fair = F.col("_w") * F.lit(rate[0]) / F.lit(rate[1])
    return ranked.select("source", "source_size", F.least(cap.cast("double"), fair).alias("target"))


def _digits(level: int) -> Column:
    """Leading hash digits up to and including ``level`` (0-based)."""
    return F.shiftright(F.col("h"), _BITS - _STEP * (level + 1))


def hash_thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, ``below``: rows with ``h < below`` come nearest to ``budget``.

    ``rows``: source, size, h.  ``budgets``: source, budget (0..source size).
    Each pass sums one level of hash digits for the open buckets only, so a
    pass moves at most 4096 sums per source, whatever the number of rows.
    """
    # state per source: digits of the open bucket so far, words taken below it
    state = budgets.select("source", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("taken"))
    for level in range(_BITS // _STEP):
        if level:
            # only rows of the boundary buckets; the key (source, digits) spreads a hot source
            rows = rows.join(state.select("source", "prefix"),
                             rows["source"].eqNullSafe(state["source"]) & (_digits(level - 1) == state["prefix"]),
                             "left_semi")
        sums = rows.groupBy("source", _digits(level).alias("digits")).agg(F.sum("size").alias("words"))
        run = Window.partitionBy("source").orderBy("digits")  # at most 4096 rows per source
        sums = sums.withColumn("upto", F.sum("words").over(run))
        joined = sums.alias("s").join(state.select("source", "budget", "prefix", "taken").alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        upto = F.col("taken") + F.col("upto")
        # boundary: the last bucket that begins below the budget
        begins = F.when(upto - F.col("words") < F.col("budget"),
                        F.struct(F.col("digits"), (upto - F.col("words")).alias("before"), F.col("words")))
        state = materialize(
            joined.groupBy(F.col("t.source").alias("source"), "budget", "taken", F.col("prefix").alias("old"))
            .agg(F.max(begins).alias("b"), F.min("digits").alias("lowest"))
            .select("source", "budget",
                    F.coalesce("b.digits", "lowest").alias("prefix"),
                    F.coalesce("b.before", "taken").alias("taken"),
                    F.coalesce("b.words", F.lit(0).cast("long")).alias("words")), "mix-state")
    # the last bucket holds rows of one hash: in or out, whichever comes nearer
    take_it = F.col("taken") + F.col("words") / 2 <= F.col("budget")
    return state.select("source", (F.col("prefix") + F.when(take_it & (F.col("budget") > 0), 1).otherwise(0)).alias("below"))


def mix_rows(slim: DataFrame) -> DataFrame:
    """Per source: source_size, target, whole (copies every row gets) and
    ``below`` (rows with a smaller hash get one copy more)."""
    totals = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(totals), "mix-targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets.withColumn("whole", whole.cast("long")).withColumn(
        "budget", F.col("target") - F.col("whole") * F.col("source_size"))
    below = hash_thresholds(slim.select("source", "size", "h"), plan.select("source", "budget"))
    joined = plan.alias("p").join(below.alias("b"), F.col("p.source").eqNullSafe(F.col("b.source")))
    return materialize(joined.select("p.source", "source_size", "target", "whole", "below"), "mix-plan")


def _with_plan(rows: DataFrame, plan: DataFrame, source: str, h: str) -> tuple[DataFrame, str]:
    """Attach the plan row of its source to every row, in a column named for no clash; the frame and that name.

    The plan has one row per source, repeated for ``_SALTS`` salts taken from
    the row hash: broadcast when it is proven small, else a shuffle join in
    which a source with a third of all rows is dealt over many tasks."""
    name, key, salt = (source_name(rows, c) for c in ("plan", "source", "salt"))
    salted = bounded_broadcast(plan.select(
        F.col("source").alias(key), F.struct("source_size", "target", "whole", "below").alias(name),
        F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias(salt)))
    joined = rows.join(salted, rows[f"`{source}`"].eqNullSafe(salted[key]) & ((rows[h] % _SALTS) == salted[salt]))
    return joined.drop(key, salt), name


def _copies(plan: str, h: str) -> Column:
    return F.col(f"{plan}.whole") + F.when(F.col(h) < F.col(f"{plan}.below"), 1).otherwise(0)


def row_hash(doc_id: str, text: str) -> Column:
    return hash60(F.col(doc_id), F.md5(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``.

    Size is the number of words (null text: 0).  ``taken`` is the words the
    mix takes of the row, repeats counted: 0, size or 2 x size.  Rows equal in
    doc_id and text share a hash and are taken alike.  A null source is a
    source of its own (last in rank); null doc_ids are hashed as such.  An
    empty table gives an empty result; texts of any length are counted whole;
    other columns are ignored.
    """
    slim = materialize(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                                   word_count(F.col(text)).alias("size"), row_hash(doc_id, text).alias("h")), "mix-rows")
    out, plan = _with_plan(slim, mix_rows(slim), "source", "h")
    return out.select("doc_id", "size", f"{plan}.source_size", f"{plan}.target", (F.col("size") * _copies(plan, "h")).alias("taken"))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each row as often (0, 1, 2 times) as the mix takes it.

    Columns and values are those of ``docs``, whatever the columns are called.
    Rows without words (null, empty or blank texts) follow the same
    thresholds; a null source is a source of its own; rows equal in id and
    text are taken alike; texts may be of any length; an empty table gives an
    empty mix."""
    h = source_name(docs, "h")
    slim = materialize(docs.select(F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
                                   row_hash(doc_id, text).alias("h")), "mix-rows")
    out, plan = _with_plan(docs.withColumn(h, row_hash(doc_id, text)), mix_rows(slim), source, h)
    copy = source_name(out, "copy")
    repeated = out.withColumn(copy, F.explode(F.array_repeat(F.lit(1), _copies(plan, h).cast("int"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])

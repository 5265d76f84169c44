"""Mixing sources to target weights: hierarchical budgeting over a tree of domains, languages and sources.

Every node shares its budget among its children by weight. A child that holds less than its share (its tokens times the
number of epochs allowed) gets all it has, and what it leaves goes to its siblings; only what a whole node cannot hold goes
to the siblings of that node. A leaf then takes whole epochs and, of one more, a prefix in seeded order that fits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paylake.llm.common import staged, table, unused

LEVELS = ("domain", "lang", "source")
WORD = "[^\\x20\\x09-\\x0D]+"
#: Relative integer weights of the children of every node by level; a value not named weighs 1, one of 0 gets nothing.
WEIGHTS = {"domain": {"d0": 3, "d1": 2, "d2": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 1}, "source": {}}
#: The budget as a share of all tokens, in thousandths.
BUDGET_PER_MILLE = 800
MAX_EPOCHS = 2
SEED = 20
#: A plan of up to this size goes to all tasks; a larger one meets rows that are dealt into salts.
BROADCAST_BYTES = 16 << 20
SALTS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def domain_of(source: Column) -> Column:
    """The sources of the given tables name no domain; their last character picks one of three."""
    return F.concat(F.lit("d"), F.coalesce(F.ascii(F.right(source, F.lit(1))), F.lit(0)) % 3)


def _weight(level: str, weights: Mapping[str, int]) -> Column:
    value = F.lit(1)
    for name, w in weights.items():
        value = F.when(F.col(level) == name, w).otherwise(value)
    return value.cast("decimal(18,0)")


def allocate(leaves: DataFrame, budget: int, levels: Sequence[str], weights: Mapping[str, Mapping[str, int]], max_epochs: int) -> DataFrame:
    """Add `allotted`, in whole tokens, to leaves (levels..., tokens). Sums stay below the budget by rounding down only.

    A leaf without weight, or below a node without weight, holds nothing that its ancestors could be given a budget for.
    """
    weighed = reduce(and_, (_weight(level, weights.get(level, {})) > 0 for level in levels))
    nodes = leaves.withColumn("_cap", F.when(weighed, F.col("tokens") * max_epochs).otherwise(0).cast("decimal(20,0)"))
    out = nodes.withColumn("_budget", F.lit(budget).cast("decimal(20,0)"))
    for depth, level in enumerate(levels):
        parent, path = list(levels[:depth]), list(levels[: depth + 1])
        weight = _weight(level, weights.get(level, {}))
        # Children without weight or tokens take no part.
        child = out.groupBy(*path).agg(F.sum("_cap").cast("decimal(20,0)").alias("_c"), F.first("_budget").alias("_b")).withColumn("_w", weight)
        child = child.filter("_w > 0 AND _c > 0")
        # In order of tokens per weight, those that can be filled come first; each sees what is left by those before it.
        order = W.partitionBy(*parent).orderBy((F.col("_c").cast("double") / F.col("_w").cast("double")), level)
        before, all_ = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy(*parent)
        zero = F.lit(0).cast("decimal(20,0)")
        child = child.withColumn("_left", F.col("_b") - F.coalesce(F.sum("_c").over(before).cast("decimal(20,0)"), zero))
        child = child.withColumn("_rest", F.sum("_w").over(all_).cast("decimal(18,0)") - F.coalesce(F.sum("_w").over(before).cast("decimal(18,0)"), zero))
        child = child.withColumn("_full", F.col("_c").cast("double") * F.col("_rest").cast("double") <= F.col("_left").cast("double") * F.col("_w").cast("double"))
        left = F.col("_b") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_c"))).over(all_), zero)
        rest = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(all_)
        child = child.withColumn("_num", (left * F.col("_w")).cast("decimal(38,0)")).withColumn("_den", rest.cast("decimal(18,0)"))
        share = F.when(F.col("_full"), F.col("_c")).otherwise(F.expr("_num div _den").cast("decimal(20,0)"))
        child = child.withColumn("_b", F.least(share, F.col("_c"))).select(*path, "_b")
        out = out.drop("_budget").join(child.withColumnRenamed("_b", "_budget"), path, "left").fillna(0, ["_budget"])
    return out.withColumn("allotted", F.col("_budget").cast("long")).drop("_cap", "_budget")


def epoch_key(doc_id: Column, epoch: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _meet(rows: DataFrame, plan: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows with what the plan says of their leaf; others go. The plan is stored and has one row per leaf.

    A leaf may hold a third of all rows, so no task gets a whole one: a plan whose size was checked goes to where the rows
    are, and a larger one is copied per salt.
    """
    size = plan.agg(F.sum(sum((F.octet_length(n) for n in names), F.lit(16 * len(plan.columns))))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(plan), list(names))
    salt = unused(rows, "_salt")
    dealt = rows.withColumn(salt, F.monotonically_increasing_id() % SALTS)
    copies = plan.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return dealt.join(copies.hint("merge"), [*names, salt]).drop(salt)


def selection(
    counted: DataFrame, budget_per_mille: int = BUDGET_PER_MILLE, levels: Sequence[str] = LEVELS,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
) -> DataFrame:
    """Per leaf: `allotted`, whole epochs `full`, and `cut_bucket` and `cut_key`, up to where the next epoch is taken.

    counted: (doc_id, levels..., tokens). A leaf's prefix is found without ordering the leaf: tokens are summed per range
    of keys first, and only the range in which the budget ends is ordered. Rows of one doc_id come all or not at all.
    """
    levels = list(levels)
    leaves = counted.groupBy(*levels).agg(F.sum("tokens").alias("tokens"))
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = allocate(leaves.filter("tokens > 0"), total * budget_per_mille // 1000, levels, weights, max_epochs)
    plan = plan.withColumn("full", F.expr("allotted div tokens")).withColumn("rest", F.expr("allotted % tokens")).drop("tokens")
    plan = staged(plan, "mix-leaves")
    keyed = _meet(counted, plan.filter("rest > 0"), levels).withColumn("_key", epoch_key(F.col("doc_id"), F.col("full") + 1, seed))
    keyed = keyed.withColumn("_range", F.substring("_key", 1, 3))
    ranges = keyed.groupBy(*levels, "_range", "rest").agg(F.sum("tokens").alias("_sum"))
    upto = F.sum("_sum").over(W.partitionBy(*levels).orderBy("_range"))
    ends = ranges.withColumn("_upto", upto).filter("_upto > rest AND _upto - _sum <= rest")
    # A range without tokens may follow with the same sum; the first one that exceeds the rest is the end.
    ends = ends.select(*levels, F.col("_range").alias("cut_range"), (F.col("rest") - F.col("_upto") + F.col("_sum")).alias("_room"))
    ends = staged(ends, "mix-ends")
    last = _meet(keyed, ends, levels).filter("_range = cut_range")
    within = F.sum("tokens").over(W.partitionBy(*levels).orderBy("_key"))
    keys = last.withColumn("_within", within).filter("_within <= _room").groupBy(*levels).agg(F.max("_key").alias("cut_key"))
    return plan.join(ends.drop("_room"), levels, "left").join(keys, levels, "left")


def mix(
    docs: DataFrame, levels: Mapping[str, Column], tokens: Column, doc_id: str = "doc_id", epoch: str = "mix_epoch", **options
) -> DataFrame:
    """Rows of docs once per epoch they are selected in, with that epoch in a column that replaces one of the same name.

    levels: name and value of each level, top first; null is a value like any other. Documents without tokens count for
    nothing and come with the prefix. Ties: equal ids share a key. Empty tables give no rows. Other columns pass unread.
    """
    mine = unused(docs, "_mix")
    names = [f"{mine}_{i}_{name}" for i, name in enumerate(levels)]
    leaf = {n: F.coalesce(v.cast("string"), F.lit("")) for n, v in zip(names, levels.values(), strict=True)}
    seed = options.get("seed", SEED)
    counted = docs.select(F.col(doc_id).alias("doc_id"), *(v.alias(n) for n, v in leaf.items()), tokens.alias("tokens"))
    weights = options.pop("weights", WEIGHTS)
    weights = {n: weights.get(level, {}) for n, level in zip(names, levels, strict=True)}
    plan = selection(staged(counted, "mix-counts"), levels=names, weights=weights, **options)
    full, bound, last, times = (f"{mine}_{c}" for c in ("full", "range", "cut", "times"))
    plan = staged(plan.select(*names, F.col("full").alias(full), F.col("cut_range").alias(bound), F.col("cut_key").alias(last)), "mix-plan")
    key = epoch_key(F.col(doc_id), F.col(full) + 1, seed)
    more = F.coalesce(F.substring(key, 1, 3) < F.col(bound), F.lit(False)) | F.coalesce(key <= F.col(last), F.lit(False))
    found = _meet(docs.withColumns(leaf), plan, names).withColumn(times, F.col(full) + more.cast("long"))
    keep = [F.col(f"`{c}`") for c in docs.columns if c != epoch]
    return found.filter(F.col(times) > 0).select(*keep, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))).alias(epoch))


def document_levels() -> dict[str, Column]:
    return {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", word_count(F.col("text")).alias("tokens"))
    docs = staged(docs, "mix-docs")
    return mix(docs, document_levels(), F.col("tokens")).select("doc_id", "lang", "source", "tokens", F.col("mix_epoch").alias("epoch"))


def _level_sql(depth: int) -> str:
    path, parent = ", ".join(LEVELS[: depth + 1]), ", ".join(LEVELS[:depth])
    by = f"PARTITION BY {parent}" if parent else ""
    before = f"({by} ORDER BY c::DOUBLE / w::DOUBLE, {LEVELS[depth]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    weight = " ".join(f"WHEN '{k}' THEN {w}" for k, w in WEIGHTS[LEVELS[depth]].items())
    weight = f"CASE {LEVELS[depth]} {weight} ELSE 1 END" if weight else "1"
    up = f"(SELECT *, b AS pb FROM s{depth - 1})" if depth else f"(SELECT (SELECT SUM(tokens) FROM leaves)::HUGEINT * {BUDGET_PER_MILLE} // 1000 AS pb)"
    join = f"JOIN {up} USING ({parent})" if depth else f"CROSS JOIN {up}"
    return f"""n{depth} AS (SELECT {path}, SUM(tokens)::HUGEINT * {MAX_EPOCHS} AS c, ({weight})::HUGEINT AS w FROM leaves WHERE tokens > 0 GROUP BY {path}),
    a{depth} AS (SELECT n{depth}.*, pb, pb - COALESCE(SUM(c) OVER {before}, 0) AS l, SUM(w) OVER ({by}) - COALESCE(SUM(w) OVER {before}, 0) AS r FROM n{depth} {join}),
    f{depth} AS (SELECT *, c::DOUBLE * r::DOUBLE <= l::DOUBLE * w::DOUBLE AS f FROM a{depth}),
    s{depth} AS (SELECT {path}, CASE WHEN f THEN c ELSE LEAST(c, ((pb - COALESCE(SUM(CASE WHEN f THEN c END) OVER ({by}), 0)) * w)::HUGEINT
        // (SUM(CASE WHEN NOT f THEN w END) OVER ({by}))::HUGEINT) END AS b FROM f{depth})"""


ORACLE = f"""WITH docs AS (
    SELECT doc_id, lang AS l0, source AS s0, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
        'd' || (COALESCE(ascii(right(source, 1)), 0) % 3) AS domain,
        len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS tokens FROM documents),
    leaves AS (SELECT domain, lang, source, SUM(tokens) AS tokens FROM docs GROUP BY ALL),
    {_level_sql(0)},
    {_level_sql(1)},
    {_level_sql(2)},
    plan AS (SELECT domain, lang, source, b // tokens AS n, b % tokens AS rest FROM s2 JOIN leaves USING (domain, lang, source)),
    keyed AS (SELECT docs.*, n, rest, md5('{SEED}:' || (n + 1) || ':' || COALESCE(doc_id::VARCHAR, '')) AS k FROM docs JOIN plan USING (domain, lang, source)),
    run AS (SELECT *, SUM(tokens) OVER (PARTITION BY domain, lang, source ORDER BY k) AS upto FROM keyed),
    taken AS (SELECT *, n + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS copies FROM run)
    SELECT doc_id, l0 AS lang, s0 AS source, tokens, unnest(range(1, copies::BIGINT + 1)) AS epoch FROM taken"""

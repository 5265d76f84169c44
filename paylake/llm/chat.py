"""Chat formatting by perspective rotation, in SQL functions only.

A dialogue of several parties is rendered once per participant: that participant's turns are the assistant's, the others
speak as named users, and system turns stay as they are. Masks mark the characters to learn, the assistant's words and the
mark that ends them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paylake.llm.common import table

START, END = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
#: Turns per rendered row. A longer conversation continues in further rows, so no row or group grows with it.
TURNS_PER_ROW = 256


def escaped(text):
    """Marks inside a text would end a turn. Reversible: a backslash is doubled, and `<|` becomes `<\\|`."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def rotate(turns: DataFrame, turns_per_row: int = TURNS_PER_ROW) -> DataFrame:
    """(conv_id, participant, part, n_turns, rendered, masks) of turns (conv_id, turn, role, text).

    participant: each distinct role of the conversation but `system`; part: 0 for the first `turns_per_row` turns, and so
    on; masks: array of (start, end) in characters of `rendered`, end exclusive. Turns are in order of turn, then role, then
    text, nulls first; repeated rows are rendered as often as they come. A null role speaks as an unnamed user and is no
    participant; a null text is empty; rows of a null conv_id are one conversation. A conversation of system turns alone has
    no participant and no row. Other columns are not read.
    """
    turns = turns.select("conv_id", "turn", "role", "text")
    # Ranks come from counts per turn number, so what is ordered per conversation is one small row per turn number.
    counts = turns.groupBy("conv_id", "turn").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select(F.col("conv_id").alias("conv"), F.col("turn").alias("no"), "n", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = turns.join(counts, F.col("conv_id").eqNullSafe(F.col("conv")) & F.col("turn").eqNullSafe(F.col("no"))).drop("conv", "no")
    single = ranked.filter("n = 1").withColumn("nth", F.col("before"))
    tied = ranked.filter("n > 1").withColumn("nth", F.col("before") + F.row_number().over(W.partitionBy("conv_id", "turn").orderBy("role", "text")) - 1)
    ranked = single.union(tied)
    parts = ranked.groupBy("conv_id", F.expr(f"nth div {turns_per_row}").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("nth", "role", escaped(F.col("text")).alias("text")))).alias("turns")
    )
    people = turns.filter(F.col("role") != SYSTEM).select("conv_id", "role").distinct()
    people = people.select(F.col("conv_id").alias("conv"), F.col("role").alias("participant"))
    seen = parts.join(people, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv")

    def segment(t):
        # What stands before a turn's words, the words, and whether they are to be learnt.
        head = (
            F.when(t["role"] == F.col("participant"), F.lit(f"{START}assistant\n"))
            .when(t["role"] == SYSTEM, F.lit(f"{START}system\n"))
            .when(t["role"].isNull(), F.lit(f"{START}user\n"))
            .otherwise(F.concat(F.lit(f"{START}user name="), F.translate(escaped(t["role"]), "\r\n", "  "), F.lit("\n")))
        )
        mine = F.coalesce(t["role"] == F.col("participant"), F.lit(False))
        return F.struct(head.alias("head"), F.concat(t["text"], F.lit(END)).alias("words"), mine.alias("mine"))

    seen = seen.withColumn("segments", F.transform("turns", segment))
    rendered = F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["words"], F.lit("\n"))), "")
    # One pass over the segments carries the place reached and the masks so far.
    state = F.expr("named_struct('at', 0L, 'masks', cast(array() AS array<struct<start: bigint, end: bigint>>))")

    def step(s, g):
        start = s["at"] + F.length(g["head"])
        end = start + F.length(g["words"])
        mask = F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"))
        masks = F.when(g["mine"], F.concat(s["masks"], F.array(mask))).otherwise(s["masks"])
        return F.struct((end + 1).cast("bigint").alias("at"), masks.alias("masks"))

    masks = F.aggregate("segments", state, step, lambda s: s["masks"])
    return seen.select("conv_id", "participant", "part", F.size("turns").cast("bigint").alias("n_turns"), rendered.alias("rendered"), masks.alias("masks"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masks as text, start:end joined by commas."""
    spans = F.array_join(F.transform("masks", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return rotate(table(spark, sf_dir, "conversations")).withColumn("masks", spans)


_HEAD = f"""CASE WHEN role = participant THEN '{START}assistant' WHEN role = '{SYSTEM}' THEN '{START}system' WHEN role IS NULL THEN '{START}user'
    ELSE '{START}user name=' || translate(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(13) || chr(10), '  ') END || chr(10)"""
ORACLE = f"""WITH t AS (SELECT conv_id, role, replace(replace(COALESCE(text, ''), '\\', '\\\\'), '<|', '<\\|') || '{END}' AS words,
        ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS nth FROM conversations),
    p AS (SELECT DISTINCT conv_id AS conv, role AS participant FROM conversations WHERE role <> '{SYSTEM}'),
    s AS (SELECT t.*, participant, nth // {TURNS_PER_ROW} AS part, {_HEAD} AS head FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv),
    o AS (SELECT *, SUM(length(head) + length(words) + 1) OVER (PARTITION BY conv_id, participant, part ORDER BY nth) - length(words) - 1 AS begins FROM s)
    SELECT conv_id, participant, part, COUNT(*) AS n_turns, string_agg(head || words || chr(10), '' ORDER BY nth) AS rendered,
        COALESCE(string_agg(CASE WHEN role = participant THEN begins::BIGINT || ':' || (begins + length(words))::BIGINT END, ',' ORDER BY nth), '') AS masks
    FROM o GROUP BY conv_id, participant, part"""

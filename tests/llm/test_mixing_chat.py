import random

from pyspark.sql import functions as F

from paylake.llm import chat, mixing
from tests.llm.helpers import documents


def _fill(budget, nodes):
    """Water-filling of one node's children: name to (capacity, weight)."""
    out, rest = {}, {n: cw for n, cw in nodes.items() if cw[0] and cw[1]}
    while rest:
        total = sum(w for _, w in rest.values())
        full = {n: c for n, (c, w) in rest.items() if c * total <= budget * w}
        if not full:
            return out | {n: budget * w // total for n, (c, w) in rest.items()}
        out |= full
        budget -= sum(full.values())
        rest = {n: cw for n, cw in rest.items() if n not in full}
    return out


def test_shortages_go_to_siblings_first(spark):
    rng = random.Random(1)
    for _ in range(4):
        leaves = {(d, lang, s): rng.choice([0, 3, 40, 500]) for d in "xy" for lang in "ab" for s in "pqr"}
        weights = {"domain": {"x": 3}, "lang": {"a": 2}, "source": {"q": 5, "r": 0}}
        budget = rng.randint(0, 1500)
        df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens bigint")
        got = {tuple(r)[:3]: r["allotted"] for r in mixing.allocate(df, budget, ["domain", "lang", "source"], weights, 2).collect()}
        weighed = lambda k: all(weights[n].get(x, 1) for n, x in zip(("domain", "lang", "source"), k, strict=True))
        cap = lambda key: sum(2 * v for k, v in leaves.items() if k[: len(key)] == key and weighed(k))
        want = {}
        tops = _fill(budget, {(d,): (cap((d,)), weights["domain"].get(d, 1)) for d in "xy"})
        for d, b in tops.items():
            for lang, b2 in _fill(b, {(*d, x): (cap((*d, x)), weights["lang"].get(x, 1)) for x in "ab"}).items():
                want |= _fill(b2, {(*lang, x): (cap((*lang, x)), weights["source"].get(x, 1)) for x in "pqr"})
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_what_has_no_weight_takes_no_budget(spark):
    leaves = [("a", "z", 1000), ("a", "y", 10), ("b", "x", 1000)]
    df = spark.createDataFrame(leaves, "domain string, source string, tokens bigint")
    got = {r["source"]: r["allotted"] for r in mixing.allocate(df, 600, ["domain", "source"], {"source": {"z": 0}}, 1).collect()}
    assert got == {"z": 0, "y": 10, "x": 590}


def test_mix_handles_odd_rows_and_names(spark):
    docs = documents(spark, [(1, "a b c"), (1, "a b c"), (2, None), (None, "x y"), (3, ""), (4, "q " * 1000)])
    docs = docs.withColumn("_mix_0_lang", F.lit(1)).withColumn("epoch", F.lit("mine")).withColumn("source", F.lit(None).cast("string"))
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    got = mixing.mix(docs, levels, mixing.word_count(F.col("text")), budget_per_mille=1500, weights={})
    rows = got.collect()
    assert set(docs.columns) < set(got.columns) and {r["epoch"] for r in rows} == {"mine"}
    assert sum(len((r["text"] or "").split()) for r in rows) <= 1.5 * 1008
    assert {r["doc_id"] for r in rows if r["mix_epoch"] == 1} == {1, 2, 3, 4, None}
    assert mixing.mix(docs.limit(0), levels, F.lit(1)).count() == 0


def test_prefixes_are_the_same_in_any_partitioning(spark):
    rng = random.Random(2)
    docs = documents(spark, [(i, "w " * rng.randint(1, 50), rng.choice("ab"), rng.choice("pq")) for i in range(300)])
    run = lambda d: sorted(map(tuple, mixing.mix(d, mixing.document_levels(), mixing.word_count(F.col("text"))).select("doc_id", "mix_epoch").collect()))
    assert run(docs.repartition(7)) == run(docs.coalesce(1))


def test_a_plan_too_large_to_send_meets_salted_rows(spark, monkeypatch):
    rng = random.Random(4)
    docs = documents(spark, [(i % 250, "w " * rng.randint(1, 50), rng.choice("aaaab"), rng.choice("ppppq")) for i in range(300)])
    run = lambda: mixing.mix(docs, mixing.document_levels(), mixing.word_count(F.col("text"))).select("doc_id", "mix_epoch")
    sent = sorted(map(tuple, run().collect()))
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    salted = run()
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "_salt" in plan
    assert sorted(map(tuple, salted.collect())) == sent


def _render(turns, me):
    out, masks = "", []
    for role, text in turns:
        text = (text or "").replace("\\", "\\\\").replace("<|", "<\\|")
        out += chat.START + ("assistant" if role == me else "system" if role == "system" else "user" if role is None else f"user name={role}") + "\n"
        start = len(out)
        out += text + chat.END
        if role == me:
            masks.append((start, len(out)))
        out += "\n"
    return out, masks


def test_every_participant_is_the_assistant_once(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|> \\ 😀"), (1, 2, "bob", None), (1, 3, None, "who"), (1, 4, "ann", ""),
        (2, 0, "system", "alone"), (None, 1, "cy", "b"), (None, 1, "cy", "b"), (None, 0, "cy", "a"), (3, None, "dee", "x"),
    ]
    df = spark.createDataFrame([(*t, 9) for t in turns], "conv_id bigint, turn bigint, role string, text string, n int").repartition(3)
    got = {(r["conv_id"], r["participant"]): (r["rendered"], [tuple(m) for m in r["masks"]]) for r in chat.rotate(df).collect()}
    first = [t[2:] for t in turns[:5]]
    assert got == {
        (1, "ann"): _render(first, "ann"), (1, "bob"): _render(first, "bob"), (None, "cy"): _render([("cy", "a"), ("cy", "b"), ("cy", "b")], "cy"),
        (3, "dee"): _render([("dee", "x")], "dee"),
    }
    assert chat.rotate(df.limit(0)).count() == 0


def test_long_conversations_continue_in_parts(spark):
    rng = random.Random(3)
    turns = [(7, rng.randint(0, 40), rng.choice(["a", "b"]), str(i)) for i in range(100)]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    rows = sorted((r for r in chat.rotate(df, turns_per_row=16).collect() if r["participant"] == "a"), key=lambda r: r["part"])
    assert [r["n_turns"] for r in rows] == [16] * 6 + [4]
    order = sorted(turns, key=lambda t: (t[1], t[2], t[3]))
    assert "".join(r["rendered"] for r in rows) == _render([t[2:] for t in order], "a")[0]


def test_chat_plan_is_native(spark):
    df = spark.createDataFrame([(1, 1, "a", "b")], "conv_id bigint, turn bigint, role string, text string")
    plan = chat.rotate(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))

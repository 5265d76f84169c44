"""Decontamination, Jaccard join and substring removal against plain Python."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from paylake.llm import decontaminate, jaccard, substrings
from paylake.llm.common import connected_components, small_batches
from tests.llm.helpers import components, documents, edits, jaccard_groups, prose, repeated


def _changed(rng, text, n):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(max(1, len(out)))
        out[at : at + 1] = rng.choice([["x"], ["y", *out[at : at + 1]], []])
    return "".join(out)


def test_leaks_against_edit_distance(monkeypatch):
    rng, hits = random.Random(1), 0
    for trial in range(120):
        monkeypatch.setattr(decontaminate, "PIECE", 64 if trial % 4 == 0 else 1 << 19)
        rows = [(i, prose(rng, rng.randint(1, 25))) for i in range(4)]
        items = decontaminate.Items.of(rows)
        item = decontaminate.normalise(rng.choice(rows)[1])
        leak = _changed(rng, item, rng.randint(0, max(1, len(item) // 14)))
        text = decontaminate.normalise(rng.choice(["", prose(rng, 9) + " "]) + leak + rng.choice(["", " " + prose(rng, 9)]))
        want = {}
        for i, t in rows:
            t = decontaminate.normalise(t)
            if len(t) >= decontaminate.Q and (d := edits(t, text)) <= int(len(t) * decontaminate.EDIT_RATE + 1e-9):
                want[i] = d
        assert {items.ids[i]: d for i, d in items.find(text).items()} == want
        hits += len(want)
    assert hits > 60


def test_leaks_of_tables_in_blocks(spark):
    small_batches(spark)
    rng = random.Random(2)
    items = [(i, prose(rng, 20)) for i in range(6)] + [(7, None), (None, "z" * 40), (8, "short"), (0, prose(rng, 20))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(1, "a " + items[0][1].upper().replace(" ", " \n ") + " b"), (2, None), (3, ""), (4, items[3][1] + " " + items[9][1]), (4, "x"), (None, items[5][1])]
    docs = documents(spark, rows).withColumn("leaks", F.lit("mine"))
    long = max(len(t) for _, t in items if t)
    assert decontaminate.dealt(bench)[1] == [0] and len(decontaminate.dealt(bench, 3 * long)[1]) == 8
    spread = spark.createDataFrame([(100 + i, prose(rng, 3)) for i in range(40)], "item_id bigint, text string").union(bench)
    numbered, places = decontaminate.dealt(spread, 4 * long)
    sizes = [r["n"] for r in numbered.groupBy("block").agg(F.sum(F.length("text")).alias("n")).collect()]
    assert len(places) == len(sizes) and max(sizes) <= 4 * long
    for size in (4_000_000, 3 * long):
        got = decontaminate.with_leaks(docs, bench, leaks="found", block_chars=size).collect()
        assert sorted((str(r["doc_id"]), [x["item_id"] for x in r["found"]]) for r in got) == [("1", [0]), ("2", []), ("3", []), ("4", []), ("4", [0, 3]), ("None", [5])]
        assert {r["leaks"] for r in got} == {"mine"}
    assert decontaminate.with_leaks(docs, bench.limit(0), leaks="found").filter("size(found) > 0").count() == 0
    assert decontaminate.with_leaks(docs.limit(0), bench).count() == 0


def test_items_without_qgrams_are_found_by_containment(spark):
    small_batches(spark)
    bench = spark.createDataFrame([(1, "Qux  42"), (2, "zyx"), (3, " \n "), (4, "a longer item than ten"), (2, "zyxwv")], "item_id bigint, text string")
    rows = [(1, "so qux\n42 it is"), (2, "qux 43"), (3, "ZYX; a longer item than ten, Qux 42"), (4, None), (5, "")]
    got = decontaminate.with_leaks(documents(spark, rows), bench).collect()
    assert {r["doc_id"]: [tuple(x) for x in r["leaks"]] for r in got} == {1: [(1, 0)], 2: [], 3: [(1, 0), (2, 0), (4, 0)], 4: [], 5: []}


def _family(rng, size, words, copies, share):
    base = prose(rng, words).split(" ")
    out = []
    for _ in range(copies):
        copy = list(base)
        for _ in range(rng.randint(0, int(words * share))):
            at = rng.randrange(len(copy))
            copy[at : at + 1] = rng.choice([[prose(rng, 1) + "q"], [], [copy[at], prose(rng, 1)]])
        out.append(" ".join(copy))
    return out


def test_jaccard_groups_against_all_pairs(spark):
    small_batches(spark)
    rng = random.Random(3)
    texts = [None, "", "  \t", "one", "One", "two words", "a b c", "A b\nc", "a b c d", "\x85 a\x0bb"]
    texts += _family(rng, 60, 120, 60, 0.06) + _family(rng, 40, 40, 40, 0.05) + [t for n in range(3, 30) for t in _family(rng, 4, n, 4, 0.12)]
    texts += [prose(rng, 60) for _ in range(30)] + [prose(rng, 3000)] * 2 + [" ".join(["w"] * 500)]
    passage = prose(rng, 40)
    texts += [f"{prose(rng, 25)} {passage} {prose(rng, 25)}" for _ in range(40)]
    rng.shuffle(texts)
    sizes, groups = jaccard_groups(dict(enumerate(texts)))
    docs = documents(spark, list(enumerate(texts))).withColumn("node", F.lit(1)).withColumn("n", F.lit("x"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs.repartition(5)).collect()}
    assert got == {i: (sizes[i], groups[i]) for i in range(len(texts))}
    assert len(set(groups.values())) < len(texts) - 60


def test_jaccard_of_odd_rows(spark):
    small_batches(spark)
    rows = [(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (7, "A b c d e"), (8, None), (8, "other words here now")]
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jaccard.jaccard_components(documents(spark, rows)).collect())
    assert got == [("5", 2, "5"), ("5", 2, "5"), ("7", 2, "5"), ("8", 0, "8"), ("8", 1, "8"), ("None", 2, "None")]
    assert jaccard.jaccard_components(documents(spark, rows).limit(0)).count() == 0


def test_light_and_heavy_sets_agree(spark, monkeypatch):
    small_batches(spark)
    rng = random.Random(4)
    texts = dict(enumerate(t for n in range(4, 22) for t in _family(rng, 6, n, 6, 0.1)))
    want = jaccard_groups(texts)[1]
    for light in (0, 9, 14):
        monkeypatch.setattr(jaccard, "boundary", lambda histogram, percent, light=light: light)
        got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(documents(spark, list(texts.items()))).collect()}
        assert got == want


def test_repeated_strings_against_a_scan(spark, monkeypatch):
    small_batches(spark)
    rng = random.Random(5)
    passages = [prose(rng, rng.randint(15, 60)) for _ in range(5)]
    texts = {1: None, 2: "", 3: "x" * 99, 4: "x" * 100, 5: "y" * 350, 6: "ab" * 300, 7: "ü😀" * 60}
    for i in range(10, 90):
        parts = [prose(rng, rng.randint(0, 20)) for _ in range(3)]
        text = parts[0] + rng.choice(passages) + parts[1] + rng.choice(passages) + parts[2]
        texts[i] = text if rng.random() < 0.8 else texts[rng.randint(2, 7)] + _changed(rng, text, 2)
    texts |= {90: texts[40], 91: texts[40], 92: _changed(rng, texts[41] * 3, 3)}
    for piece in (1 << 18, 300):
        monkeypatch.setattr(substrings, "PIECE", piece)
        docs = documents(spark, list(texts.items())).withColumn("doc", F.lit("mine")).repartition(6)
        rows = substrings.repeated_strings(docs).select("*", F.sha2("kept", 256).alias("d")).collect()
        got = {r["doc_id"]: (r["n_bytes"], sum(s["end"] - s["start"] for s in r["removed"]), len(r["removed"]), r["d"]) for r in rows}
        assert got == repeated(texts)


def test_a_passage_in_many_documents_is_not_gathered(spark, monkeypatch):
    small_batches(spark)
    rng = random.Random(10)
    passage, tail = prose(rng, 60), prose(rng, 12)
    texts = {i: prose(rng, 25) + passage + (tail[: i % 50] if i % 3 else "") + prose(rng, 25) for i in range(300)}
    gathered = spark.sparkContext.accumulator(0)
    whole = substrings.repeats

    def counted(rows, length):
        cores = [r[0] for r in rows]
        gathered.add(sum(cores.count(c) > 20 for c in set(cores)))
        return whole(rows, length)

    monkeypatch.setattr(substrings, "repeats", counted)
    for name, value in (("KINDS", 8), ("HOT_ROWS", 20), ("WINDOWS", 3000), ("COMBINED", 400)):
        monkeypatch.setattr(substrings, name, value, raising=False)
    rows = [(i, t) for i, t in texts.items()]
    got = {r["doc_id"]: bytes(r["kept"]) for r in substrings.repeated_strings(documents(spark, rows).repartition(4)).collect()}
    assert {i: hashlib.sha256(k).hexdigest() for i, k in got.items()} == {i: r[3] for i, r in repeated(texts).items()}
    assert gathered.value == 0


def test_repeated_strings_of_odd_rows(spark):
    small_batches(spark)
    rng = random.Random(6)
    a, b = prose(rng, 40), prose(rng, 40)
    rows = [(1, a), (1, a), (None, a), (2, b), (2, a + b), (3, b)]
    got = sorted((str(r["doc_id"]), r["n_bytes"], len(r["kept"])) for r in substrings.repeated_strings(documents(spark, rows)).collect())
    na, nb = len(a), len(b)
    # Both rows of 1 are alike; of 2, the row that starts with a repeats it from 1 and b from the other row.
    assert [g for g in got if g[0] != "2"] == [("1", na, na), ("1", na, na), ("3", nb, 0), ("None", na, na)]
    assert [g[2] for g in got if g[0] == "2"] == sorted([nb, 0]) or [g[2] for g in got if g[0] == "2"][0] in (0, nb)
    assert substrings.repeated_strings(documents(spark, rows).limit(0)).count() == 0


def test_sorting_tells_equal_windows_only():
    rng = random.Random(7)
    data = np.frombuffer("".join(rng.choices("ab", k=3000)).encode() + b"ab" * 400 + b"z" * 300, np.uint8)
    starts = np.arange(len(data) - 40 + 1)
    group = starts % 2
    found = sorted(tuple(sorted(g.tolist())) for g in substrings.equal_windows(data, starts, group, 40))
    want = {}
    for s in starts.tolist():
        want.setdefault((s % 2, data[s : s + 40].tobytes()), []).append(s)
    assert found == sorted(tuple(v) for v in want.values() if len(v) > 1)


def test_tries_list_strings_in_order():
    rng = random.Random(8)
    texts = ["".join(rng.choices("abc", k=8)).encode() for _ in range(300)]
    trie = substrings.BlindTrie()
    for i, t in enumerate(texts):
        trie.add(t, i)
    assert [texts[leaf[0]] for leaf in trie.leaves()] == sorted(set(texts))
    assert all(len({texts[i] for i in leaf}) == 1 for leaf in trie.leaves())


def test_components_against_union_find(spark):
    rng = random.Random(9)
    links = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(70)] + [(500, i) for i in range(501, 540)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    want = components({n for e in links for n in e}, links)
    alone = {a for a, b in links if a == b} - {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: c for n, c in want.items() if n not in alone}
    assert connected_components(df.limit(0)).count() == 0

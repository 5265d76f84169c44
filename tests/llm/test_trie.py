import hashlib
import random
import zlib

import pytest

from paylake.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """Every prefix of every rebuilt conversation as a tuple of turns."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0), name, (role, text)))
    own = {c: [t for *_, t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        made[c] = tuple(own.get(head, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    kids = {}
    for path in nodes:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        ends = ",".join(str(c) for c in sorted(m for m in members if len(made[m]) == len(path)))
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p)
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(kids.get(path, [])),
            sum(p not in kids for p in below), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def _rows(rng, ids, lengths=(0, 1, 2, 3, 6, 9, 30)):
    rows = []
    for c in ids:
        for t in range(rng.choice(lengths)):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "assistant", None]), rng.choice(["x", "yy", "", None, "zé"])))
    return rows


def _nodes(df):
    return sorted((tuple(r[c] for c in trie.MADE) for r in df.collect()), key=repr)


@pytest.mark.parametrize("bits", [25, 5])
def test_nodes_equal_the_plain_version(spark, monkeypatch, bits):
    """With 32 counters the sketch proves nothing, with many nearly all; the nodes are the same."""
    monkeypatch.setattr(trie, "LARGEST_BITS", bits)
    monkeypatch.setattr(trie, "BLOCK_BITS", min(bits, trie.BLOCK_BITS))
    monkeypatch.setattr(trie, "PIECE_IDS", 3)
    rows = _rows(random.Random(7), [*range(90), *range(100, 160), 1000, -5, -100, -150, None, 2**40])
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "'mine' AS depth").repartition(6)
    assert _nodes(trie.trie(turns)) == plain(rows)


def test_one_conversation_over_all_parts(spark):
    """A conversation that holds most rows lies in several parts; its digests and sums pass between them."""
    rows = [(200, t, "user", f"turn {t}") for t in range(3000)] + [(201, t, "user", f"turn {t}") for t in range(3000)]
    rows += _rows(random.Random(8), range(300, 320))
    turns = spark.createDataFrame(rows, SCHEMA)
    assert trie.ordered_turns(turns, 8).filter("conv_id = 200").select("part").distinct().count() > 1
    ours = _nodes(trie.trie(turns))
    assert len(ours) > 3000 and len({(r[0], r[1]) for r in ours}) == len(ours)
    deep = [r for r in ours if r[0] == 200 and r[1] > 6]
    assert {r[3] for r in deep} == {2} and max(r[1] for r in deep) == 3000
    sizes = {t: len(f"turn {t}") for t in range(3000)}
    assert {r[1]: r[6] for r in deep}[2999] == sizes[2998] + sizes[2999]


def test_turnless_and_no_conversations(spark):
    c = next(i for i in range(101, 200) if zlib.crc32(str(i).encode()) % 6 > 1)
    rows = [(c, 0, "user", "only"), (None, 0, "user", "no conversation")]
    assert _nodes(trie.trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows) and len(plain(rows)) == 1
    assert trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_long_text_and_a_crowded_start(spark):
    rows = [(c, 0, "system", "the same start" * 50_000) for c in range(1, 60)] + [(c, 1, "user", f"own {c}") for c in range(1, 60)]
    assert _nodes(trie.trie(spark.createDataFrame(rows, SCHEMA))) == plain(rows)

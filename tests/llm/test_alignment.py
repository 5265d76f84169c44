import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from paylake.llm import align, bpe
from paylake.llm.packing import VOCABULARY
from tests.llm.helpers import documents, prose

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(texts):
    """The contract read plainly, with both libraries' own encoders."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(os.path.join(VOCABULARY, bpe.NAME)), sentencepiece.SentencePieceProcessor(model_file=os.path.join(VOCABULARY, align.PIECES))
    a.encode_special_tokens = True
    back = {n: i for i, n in enumerate(bpe.byte_names())}
    rows, counts = [], Counter()
    for key, text in texts:
        one = a.encode(" " + (text or ""), add_special_tokens=False)
        left = [(i, bytes(back[c] for c in t)) for i, t in zip(one.ids, one.tokens, strict=True)]
        right = [(i, b.id_to_piece(i)) for i in b.encode(text or "")]
        right = [(i, bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in right]
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(t for _, t in side) != whole for side in (left, right)):
            left = right = []
        links, groups, now, i, j = [], [], ([], []), 0, 0
        end_a, end_b = (np.cumsum([len(t) for _, t in side]) for side in (left, right))
        while i < len(left):
            links.append((left[i][0], right[j][0]))
            step_a, step_b = end_a[i] <= end_b[j], end_b[j] <= end_a[i]
            if step_a:
                now[0].append(left[i][0])
            if step_b:
                now[1].append(right[j][0])
            i, j = i + step_a, j + step_b
            if step_a and step_b:
                groups.append(now)
                now = ([], [])
        counts.update(set(links))
        spelled = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        rows.append((key, len(left), len(right), len(groups), links, hashlib.sha256(spelled.encode()).hexdigest() if spelled else ""))
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    return [(*r[:4], len(r[4]), sum(counts[p] == top[p[0]] for p in r[4]), sum(counts[p] for p in r[4]), r[5]) for r in rows]


def _texts(rng, n):
    odd = [None, "", " ", "x", "▁blank", "a\nb\tc", "<|endoftext|>", "<s> </s>", "<0x0A>", "  two  blanks ", "naïve é 中文 \U0001f600", "\x00", "x" * 5000, " " * 3000]
    return [(i, odd[i] if i < len(odd) else prose(rng, rng.randint(1, 40))) for i in range(n)] + [(3, "x"), (None, "x y"), (None, None)]


@pytest.mark.parametrize("links", [align.BLOCK_LINKS, 50])
def test_alignment_equals_the_plain_version(spark, monkeypatch, links):
    monkeypatch.setattr(align, "BLOCK_LINKS", links)
    monkeypatch.setattr(align, "DECODED", 3 if links == 50 else align.DECODED)
    texts = _texts(random.Random(4), 120)
    docs = documents(spark, texts).selectExpr("*", "'mine' AS block", "1 AS n_a").repartition(5)
    got = [tuple(r[c] for c in COLUMNS) for r in align.alignment(docs).collect()]
    by_key = lambda r: tuple((v is None, v) for v in r)
    assert sorted(got, key=by_key) == sorted(plain(texts), key=by_key)


def test_alignment_of_no_documents(spark):
    out = align.alignment(documents(spark, [(1, "x")]).limit(0))
    assert out.columns == COLUMNS and out.collect() == []


def test_runs_merge_to_counts_in_their_own_order():
    rng = np.random.default_rng(3)
    runs, seen = [], Counter()
    for _ in range(5):
        pairs = np.unique(rng.integers(0, 200, 60)).astype(np.uint64) << np.uint64(3)
        counts = rng.integers(1, 9, len(pairs)).astype("<u4")
        seen.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
        runs.append((pairs, counts))
    spilled = [(align._packed(np.diff(p, prepend=np.uint64(0))), align._packed(c)) for p, c in runs]
    answers, highest = align.merge_runs(spilled, 5)
    assert [a.tolist() for a in answers] == [[seen[p] for p in pairs.tolist()] for pairs, _ in runs]
    assert highest == {a: max(n for p, n in seen.items() if p >> 5 == a) for a in {p >> 5 for p in seen}}


def test_pairs_of_one_id_reach_many_radixes():
    pairs = np.uint64(7) << np.uint64(15) | np.arange(1000, dtype=np.uint64)
    assert np.bincount((align.mixed(pairs) % np.uint64(10)).astype(int), minlength=10).min() > 50


def test_tokens_are_laid_over_each_other_without_sorting(monkeypatch):
    a, b = [b" a", b"b", b"cd", b" ", b"e"], [b" ab", b"c", b"d ", b"e"]
    sizes = tuple(np.array([len(t) for t in side], np.int64) for side in (a, b))
    spell = align.Spelling(5)

    def refused(*args, **options):
        raise AssertionError("sorted")

    for name in ("sort", "argsort", "union1d", "intersect1d"):
        monkeypatch.setattr(np, name, refused)
    x = align.align("abcd e", np.arange(5, dtype="<u4"), np.arange(4, dtype="<u4"), a, b, sizes)
    assert list(zip(x.link_a.tolist(), x.link_b.tolist())) == [(0, 0), (1, 0), (2, 1), (2, 2), (3, 2), (4, 3)]
    assert (x.groups_a.tolist(), x.groups_b.tolist()) == ([2, 4, 5], [1, 3, 4])
    assert spell(x) == "0,1|0;2,3|1,2;4|3"

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paylake.llm import bpe
from paylake.llm.packing import VOCABULARY
from tests.llm.helpers import documents, prose

MERGES = bpe.Merges()
CLASSES = bpe.class_table(bpe.character_classes(VOCABULARY))
ODD = [*" \n\t\r'strdvel 'S1²!…|<>", "<|endoftext|>", "'s", "'re", "'ll", "'ve", "''", " ", "　", "é", "中", "\U0001f600", "\x1c", "՘", "\x00"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(os.path.join(VOCABULARY, bpe.NAME))


def _ids(library, texts):
    return [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]


def _lexicon(words):
    return bpe.compile_lexicon(words, MERGES)


def test_ids_equal_the_library_on_odd_texts(library):
    rng = random.Random(1)
    texts = ["".join(rng.choices(ODD, k=rng.randint(0, 30))) for _ in range(5000)]
    words = {w for w in bpe.split_words(texts[:1000], CLASSES)[0]}
    for lexicon in (None, _lexicon(words)):
        assert bpe.Encoder(MERGES, CLASSES, lexicon)(texts) == _ids(library, texts)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_ids_equal_the_library_on_any_text(library, texts):
    coded = bpe.Encoder(MERGES, CLASSES)(texts)
    assert coded == _ids(library, texts)
    assert [bpe.decoded(i, MERGES.bytes_of) for i in coded] == texts


def test_every_character_is_split_as_the_library_does(library):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + c + "1 !" + c + "\n" + c for c in every[::7]]
    assert bpe.Encoder(MERGES, CLASSES)(texts) == _ids(library, texts)


def test_bytes_that_are_no_text_decode_as_the_library_does(library):
    rng = random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(1, 12))]
        assert bpe.decoded(np.array(ids, "<u4").tobytes(), MERGES.bytes_of) == library.decode(ids, skip_special_tokens=False)


def test_long_words_and_long_blanks():
    for text, n in ((" " * 1_000_000, None), ("\n" * 300_000 + "x", None), ("ab" * 200_000, None)):
        ids = bpe.Encoder(MERGES, CLASSES)([text])[0]
        assert bpe.decoded(ids, MERGES.bytes_of) == text


def test_the_lexicon_is_a_minimal_automaton():
    rng = random.Random(3)
    words = {("".join(rng.choices("ab", k=rng.randint(1, 6))) + rng.choice(["ing", "ed", ""])).encode() for _ in range(300)}
    made = _lexicon(words)
    ordered = sorted(words)
    assert made.numbers(ordered).tolist() == list(range(len(ordered)))
    assert made.numbers([b"zz", b"", b"aaaaaaaaaaaaing", b"a" * 100]).tolist()[0] == -1
    outside = [w for w in (w + b"x" for w in ordered) if w not in words]
    assert (made.numbers(outside) == -1).all()
    # No two states have the same future: the words that lead from a state to an end.
    arcs = {}
    for key, target in zip(made.arcs.tolist(), made.targets.tolist(), strict=True):
        arcs.setdefault(key >> 8, []).append((key & 255, target))
    futures = {}

    def future(state):
        if state not in futures:
            futures[state] = frozenset([b""] * bool(made.final[state])) | {bytes([b]) + f for b, t in arcs.get(state, []) for f in future(t)}
        return futures[state]

    assert future(made.start) == words
    assert len(set(futures.values())) == len(futures) == len(made.final)


def test_the_file_maps_to_the_same_lexicon(tmp_path):
    words = [f"word{i}".encode() for i in range(500)]
    (tmp_path / "lexicon.bin").write_bytes(_lexicon(words).save())
    mapped = bpe.Lexicon.mapped(str(tmp_path / "lexicon.bin"))
    assert mapped.numbers(words).tolist() == _lexicon(words).numbers(words).tolist()
    assert bpe.Lexicon.mapped(str(tmp_path / "lexicon.bin")).ids.tolist() == [i for w in sorted(words) for i in MERGES.merge(w)]
    assert _lexicon([]).numbers([b"a"]).tolist() == [-1]


@pytest.mark.parametrize("words", [0, 20, bpe.LEXICON_WORDS])
def test_rows_are_coded_and_decoded(spark, library, words):
    rng = random.Random(5)
    texts = [None, "", "a <|endoftext|> b", "x", "x", " " * 5000] + [prose(rng, 30) for _ in range(60)]
    docs = documents(spark, list(enumerate(texts))).withColumn("ids", F.lit("mine")).repartition(4)
    out = bpe.with_text(bpe.with_ids(docs, bpe.fit(docs, words=words))).orderBy("doc_id").collect()
    assert [bytes(r["ids"]) for r in out] == _ids(library, [t or "" for t in texts])
    assert [r["decoded"] for r in out] == [t or "" for t in texts]
    empty = docs.limit(0)
    assert bpe.with_ids(empty, bpe.fit(empty)).count() == 0


def test_frequent_words_are_counted_over_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(bpe, "COUNTED", 3)
    docs = documents(spark, [(i, "common rare%d" % i) for i in range(40)]).repartition(8)
    runs = bpe.character_classes(VOCABULARY)
    assert sorted(bpe.frequent_words(docs, runs, 3)) == [b" rare", b"common"]
    assert len(bpe.frequent_words(docs, runs, 100)) == 42 and bpe.frequent_words(docs, runs, 1) == []


def test_short_and_long_words_merge_alike():
    rng = random.Random(9)
    for _ in range(300):
        ids = [MERGES.of_byte[b] for b in "".join(rng.choices("aaehint ", k=rng.randint(0, 60))).encode()]
        assert MERGES._merge_short(list(ids)) == MERGES._merge_long(list(ids))


@pytest.mark.parametrize("lexicon", [None, _lexicon([b"again"])])
def test_words_that_keep_coming_are_looked_up_once(monkeypatch, lexicon):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encoder, asked = bpe.Encoder(MERGES, CLASSES, lexicon), []
    look_up = lexicon.numbers if lexicon else MERGES.merge
    monkeypatch.setattr(lexicon or MERGES, "numbers" if lexicon else "merge", lambda x: asked.extend(x if lexicon else [x]) or look_up(x))
    for i in range(50):
        assert encoder([f"again{i} x{i}"]) == bpe.Encoder(bpe.Merges(), CLASSES)([f"again{i} x{i}"])
        assert len(encoder.recent) <= 3 + 4 and len(encoder.older) <= 3 + 4
    assert asked.count(b"again") == 1


def test_words_of_wide_characters_are_cut_at_their_bytes():
    texts = ["", "é中 \U0001f600x's", "", "a b", "中"]
    words, firsts = bpe.split_words(texts, CLASSES)
    assert [w.decode() for w in words] == ["é中", " \U0001f600", "x", "'s", "a", " b", "中"]
    assert firsts.tolist() == [0, 0, 4, 4, 6, 7]

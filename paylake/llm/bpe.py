"""BPE encoding and decoding with a compiled lexicon.

The frequent words of the corpus, counted over all documents, are merged once and compiled into a minimal acyclic
transducer: states with equal futures are one, so suffixes are shared, and the numbers on a word's arcs add up to its place
in the table of ids. The file lies in the shared folder, reaches each executor once and is memory-mapped by its Python
workers. The distinct words of a batch walk it together; words that it lacks are merged exactly. A lexicon decides cost,
never results.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm.common import small_batches, staged, table
from paylake.llm.packing import VOCABULARY
from paylake.session import scratch_folder

NAME = "byte_bpe_50k.json"
#: The lexicon holds so many words at most, of so many bytes at most. All others are merged.
LEXICON_WORDS, LEXICON_BYTES = 1 << 17, 32
#: Words of more bytes are merged with a heap.
SHORT_WORD = 64
#: An encoder remembers the ids of so many words, and of as many again that came before those.
REMEMBERED = 1 << 18
#: Word counts fall into this many steps per doubling when the lexicon's least count is sought.
STEPS = 16
#: Distinct words that a task counts before it hands its counts on.
COUNTED = 1 << 18

OTHER, LETTER, NUMBER, SPACE, BREAK = range(5)
#: The contractions of the vocabulary's pattern of words, after the apostrophe.
SHORT_ENDINGS, LONG_ENDINGS = "stmd", ("re", "ve", "ll")


def byte_names() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: printable ones as they are, others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def character_classes(folder: str, name: str = NAME) -> tuple[list[int], list[int]]:
    """(first code points of runs, their classes) as the vocabulary's own splitter sees letters, numbers and white space.

    Its Unicode version need not be Python's. All characters in order are split once; each run is then tried by itself. The
    blank is left out, as it joins the run after it.
    """
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(os.path.join(folder, name)).pre_tokenizer.pre_tokenize_str
    every = [c for c in range(0x110000) if c != 0x20 and not 0xD800 <= c < 0xE000]
    together = lambda a, b: len(split(a + b)) == 1
    firsts, classes = [], []
    for _, (start, _) in split("".join(map(chr, every))):
        c = chr(every[start])
        kind = LETTER if together("a", c) else NUMBER if together("1", c) else OTHER if together("!", c) else SPACE
        if not classes or classes[-1] != kind:
            firsts.append(every[start])
            classes.append(kind)
    return firsts, classes


def class_table(runs: tuple[list[int], list[int]]) -> np.ndarray:
    firsts, classes = runs
    out = np.repeat(np.array(classes, np.uint8), np.diff([*firsts, 0x110000]))
    out[0x20] = SPACE
    return out


def split_words(texts: Sequence[str], classes: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """(all words as bytes, number of the first word of each text, and their total), as the vocabulary's pattern splits them.

    A word takes one blank (U+0020) before it; of other white space the last character stands alone before a word.
    """
    joined, ends = "".join(texts), np.cumsum([len(t) for t in texts], dtype=np.int64)
    plain = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    # A break after each text, of no width, and one before the first.
    breaks = np.concatenate(([0], ends + 1 + np.arange(len(ends))))
    inside = np.ones(len(plain) + len(breaks), bool)
    inside[breaks] = False
    codes, kind = np.zeros(len(inside), np.uint32), np.full(len(inside), BREAK, np.uint8)
    codes[inside], kind[inside] = plain, classes[plain]
    # Of the characters next to a row's ends, the breaks there, nothing is asked.
    before, after, blank, space = np.roll(kind, 1), np.roll(kind, -1), codes == 0x20, kind == SPACE
    no_blank_before = ~np.roll(blank, 1)
    starts = (kind != before) & inside & (space | no_blank_before)
    starts |= space & (after < SPACE)
    marks = np.flatnonzero(codes == 0x27)
    marks = marks[(before[marks] != OTHER) & no_blank_before[marks]]
    if len(marks):
        padded = np.concatenate((codes, np.zeros(3, np.uint32)))
        one, two = padded[marks + 1], padded[marks + 2]
        lengths = np.where(np.isin(one, [ord(c) for c in SHORT_ENDINGS]), 2, 0)
        for pair in LONG_ENDINGS:
            lengths[(one == ord(pair[0])) & (two == ord(pair[1]))] = 3
        marks, lengths = marks[lengths > 0], lengths[lengths > 0]
        starts[marks + 1] = False
        starts[marks + lengths] = kind[marks + lengths] != BREAK
    places, data = np.flatnonzero(starts), joined.encode("utf-8")
    offsets = places - np.searchsorted(breaks, places)
    if len(data) > len(plain):
        # A character begins at each byte that does not go on with one.
        octets = np.frombuffer(data, np.uint8)
        offsets = np.flatnonzero((octets & 0xC0) != 0x80)[offsets]
    at = [*offsets.tolist(), len(data)]
    return [data[a:b] for a, b in zip(at, at[1:])], np.searchsorted(places, breaks)


class Merges:
    """The vocabulary file: ids of bytes, merges by the ids they join, and the bytes of every id."""

    def __init__(self, folder: str = VOCABULARY, name: str = NAME):
        with open(os.path.join(folder, name), encoding="utf-8") as file:
            whole = json.load(file)
        vocabulary, names = whole["model"]["vocab"], byte_names()
        self.of_byte = [vocabulary[n] for n in names]
        #: Rank of each pair of ids that merges, and the id it makes by rank.
        self.rules, self.makes = {}, []
        for rank, pair in enumerate(whole["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rules[vocabulary[left], vocabulary[right]] = rank
            self.makes.append(vocabulary[left + right])
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        back = {n: b for b, n in enumerate(names)}
        self.bytes_of = [b""] * (1 + max(*vocabulary.values(), *self.special.values()))
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the rule of lowest rank goes first, of equal ones the leftmost."""
        ids = [self.of_byte[b] for b in word]
        return self._merge_long(ids) if len(ids) > SHORT_WORD else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        rules, makes, none = self.rules, self.makes, len(self.makes)
        ranks = [rules.get(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (rank := min(ranks)) < none:
            i = ranks.index(rank)
            ids[i] = makes[rank]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rules.get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rules.get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same in n log n steps, with a heap of ranks and places."""
        rules, n = self.rules, len(ids)
        following, previous = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rules[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rules]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = following[i]
            if ids[i] < 0 or j >= n or rules.get((ids[i], ids[j])) != rank:
                continue
            ids[i], ids[j] = self.makes[rank], -1
            following[i] = k = following[j]
            if k < n:
                previous[k] = i
                if (ids[i], ids[k]) in rules:
                    heapq.heappush(heap, (rules[ids[i], ids[k]], i))
            if (h := previous[i]) >= 0 and (ids[h], ids[i]) in rules:
                heapq.heappush(heap, (rules[ids[h], ids[i]], h))
        return [i for i in ids if i >= 0]


@dataclass
class Lexicon:
    """A minimal acyclic transducer. Arcs are sorted by `state << 8 | byte`; a word's number indexes its ids."""

    arcs: np.ndarray
    targets: np.ndarray
    outputs: np.ndarray
    final: np.ndarray
    offsets: np.ndarray
    ids: np.ndarray
    start: int

    TYPES = {"arcs": "<i8", "targets": "<i8", "outputs": "<i8", "final": "<i8", "offsets": "<i8", "ids": "<u4"}

    def numbers(self, words: Sequence[bytes]) -> np.ndarray:
        """The number of each word, -1 for those not held. All words take each step together."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data, begins = np.frombuffer(b"".join(words), np.uint8), np.concatenate(([0], np.cumsum(lengths)))[:-1]
        state, total = np.full(len(words), self.start, np.int64), np.zeros(len(words), np.int64)
        alive = np.flatnonzero((lengths > 0) & (lengths <= LEXICON_BYTES)) if len(self.arcs) else np.zeros(0, np.int64)
        done = np.zeros(len(words), bool)
        for step in range(LEXICON_BYTES):
            if not len(alive):
                break
            wanted = state[alive] << 8 | data[begins[alive] + step]
            at = np.minimum(np.searchsorted(self.arcs, wanted), len(self.arcs) - 1)
            held = self.arcs[at] == wanted
            alive, at = alive[held], at[held]
            state[alive] = self.targets[at]
            total[alive] += self.outputs[at]
            over = lengths[alive] == step + 1
            done[alive[over]] = self.final[state[alive[over]]] > 0
            alive = alive[~over]
        return np.where(done, total, -1)

    def save(self) -> bytes:
        parts = [np.ascontiguousarray(getattr(self, k), t) for k, t in self.TYPES.items()]
        head = np.array([self.start, *map(len, parts)], "<i8").tobytes()
        return head + b"".join(p.tobytes() for p in parts)

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        """The file as memory-mapped arrays; nothing is read before it is walked."""
        raw = np.memmap(path, np.uint8, "r")
        start, *lengths = raw[: 8 * (1 + len(cls.TYPES))].view("<i8").tolist()
        at, parts = 8 * (1 + len(cls.TYPES)), []
        for n, t in zip(lengths, cls.TYPES.values(), strict=True):
            size = n * np.dtype(t).itemsize
            parts.append(np.asarray(raw[at : at + size].view(t)))
            at += size
        return cls(*parts, start)


def compile_lexicon(words: Iterable[bytes], merges: Merges) -> Lexicon:
    """Build the automaton from the words in byte order: a state is closed once no later word can pass through it, and
    taken for an earlier one with the same arcs if there is one. Arc numbers count the words that sort before."""
    held: dict[tuple, int] = {}
    below: list[int] = []
    path: list[list] = [[False, []]]

    def close(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in held:
            held[key] = len(below)
            below.append(node[0] + sum(below[t] for _, t in node[1]))
        return held[key]

    def shorten(depth: int) -> None:
        while len(path) > depth + 1:
            done = close(path.pop())
            path[-1][1][-1] = (path[-1][1][-1], done)

    words = sorted(set(words))
    last = b""
    for word in words:
        shorten(len(os.path.commonprefix([word, last])))
        for byte in word[len(path) - 1 :]:
            path[-1][1].append(byte)
            path.append([False, []])
        path[-1][0], last = True, word
    shorten(0)
    start = close(path[0])
    rows, final = [], np.zeros(len(below), np.int64)
    for (accepts, arcs), state in held.items():
        final[state], passed = accepts, int(accepts)
        for byte, target in arcs:
            rows.append((state << 8 | byte, target, passed))
            passed += below[target]
    rows.sort()
    arcs, targets, outputs = np.array(rows, np.int64).reshape(-1, 3).T
    ids = [merges.merge(w) for w in words]
    offsets = np.cumsum([0, *map(len, ids)])
    return Lexicon(arcs, targets, outputs, final, offsets, np.array([i for w in ids for i in w], np.uint32), start)


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, merges: Merges, classes: np.ndarray, lexicon: Lexicon | None = None, special: bool = True):
        self.merges, self.classes, self.lexicon = merges, classes, lexicon
        self.special = merges.special if special else {}
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def words(self, distinct: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words: remembered, from the lexicon, or else merged. Words that keep coming stay remembered."""
        if len(self.recent) > REMEMBERED:
            self.recent, self.older = {}, self.recent
        recent, older, out, rest = self.recent, self.older, {}, []
        for word in distinct:
            ids = recent.get(word)
            if ids is None:
                ids = older.get(word)
                if ids is None:
                    rest.append(word)
                    continue
                recent[word] = ids
            out[word] = ids
        if self.lexicon is not None and rest:
            numbers = self.lexicon.numbers(rest)
            known = np.flatnonzero(numbers >= 0)
            data, at = self.lexicon.ids, self.lexicon.offsets
            for i, a, b in zip(known.tolist(), at[numbers[known]].tolist(), at[numbers[known] + 1].tolist(), strict=True):
                out[rest[i]] = recent[rest[i]] = data[a:b].tobytes()
            rest = [rest[i] for i in np.flatnonzero(numbers < 0).tolist()]
        for word in rest:
            out[word] = ids = array("I", self.merges.merge(word)).tobytes()
            if len(word) <= LEXICON_BYTES:
                recent[word] = ids
        return out

    def pieces(self, text: str) -> list[str | int]:
        """The text cut at the leftmost strings of special tokens, the longest of those that start together."""
        if not any(s in text for s in self.special):
            return [text]
        one = "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True))
        return [self.special.get(p, p) for p in re.split(f"({one})", text)]

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        parts = [self.pieces(t) for t in texts]
        words, firsts = split_words([p for text in parts for p in text if isinstance(p, str)], self.classes)
        ids = self.words(list(set(words)))
        coded, part, out = [ids[w] for w in words], 0, []
        for text in parts:
            row = []
            for p in text:
                if isinstance(p, int):
                    row.append(np.array([p], "<u4").tobytes())
                else:
                    row += coded[firsts[part] : firsts[part + 1]]
                    part += 1
            out.append(b"".join(row))
        return out


def decoded(ids: bytes, bytes_of: Sequence[bytes]) -> str:
    """The bytes of all ids as one text; bytes that are not UTF-8 become replacement characters."""
    return b"".join([bytes_of[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def frequent_words(docs: DataFrame, runs: tuple[list[int], list[int]], n: int = LEXICON_WORDS, text: str = "text") -> list[bytes]:
    """The words that come most often in all texts: as many steps of counts, from the top, as have n words or fewer.

    Tasks hand on counts, not words; the driver gets the steps' sizes and then at most n words.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, counts = class_table(runs), Counter()

        def taken() -> pa.RecordBatch:
            kept = {w: c for w, c in counts.items() if len(w) <= LEXICON_BYTES}
            out = pa.RecordBatch.from_arrays([pa.array(kept.keys(), pa.binary()), pa.array(kept.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            counts.update(split_words([t for t in batch.column(0).to_pylist() if t], classes)[0])
            if len(counts) > COUNTED:
                yield taken()
        yield taken()

    words = staged(docs.select(text).mapInArrow(counted, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words")
    step = F.floor(F.log2(F.col("n").cast("double")) * STEPS).cast("bigint")
    # One row per step of counts, a thousand at most.
    steps = sorted(((r["s"], r["c"]) for r in words.groupBy(step.alias("s")).agg(F.count("*").alias("c")).collect()), reverse=True)
    least, held = None, 0
    for s, c in steps:
        held += c
        if held > n:
            break
        least = s
    return [bytes(r["word"]) for r in words.filter(step >= least).select("word").collect()] if least is not None else []


@dataclass
class Fitted:
    """What the executors need: the vocabulary's place, classes of characters, and the lexicon's file name."""

    folder: str
    name: str
    runs: tuple[list[int], list[int]]
    file: str

    def encoder(self) -> Encoder:
        return Encoder(Merges(self.folder, self.name), class_table(self.runs), Lexicon.mapped(SparkFiles.get(self.file)))


def fit(docs: DataFrame, folder: str = VOCABULARY, name: str = NAME, words: int = LEXICON_WORDS, text: str = "text") -> Fitted:
    """Count, compile, and hand the file to the executors. The driver holds at most `words` words of `LEXICON_BYTES` bytes."""
    spark, runs = docs.sparkSession, character_classes(folder, name)
    made = compile_lexicon(frequent_words(docs, runs, words, text), Merges(folder, name)).save()
    path = scratch_folder(spark, "lexicon") + ".bin"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(place)
    out.write(made)
    out.close()
    spark.sparkContext.addFile(path)
    return Fitted(folder, name, runs, path.rsplit("/", 1)[-1])


def with_ids(docs: DataFrame, fitted: Fitted, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add a text's ids, as little-endian unsigned 32-bit integers; a column of that name is replaced.

    A null or empty text has none. Strings of special tokens become their ids, and nothing is added. Rows are independent,
    so repeated or null keys, ties and other columns do not matter; an empty table stays empty.
    """

    @F.pandas_udf("binary")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = fitted.encoder()
        for batch in batches:
            yield pd.Series(encoder([t or "" for t in batch]), dtype=object)

    return docs.withColumn(ids, coded(F.col(text)))


def with_text(coded: DataFrame, folder: str = VOCABULARY, name: str = NAME, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that ids stand for, special tokens included; a column of that name is replaced. Null ids are none."""

    @F.pandas_udf("string")
    def spelled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bytes_of = Merges(folder, name).bytes_of
        for batch in batches:
            yield pd.Series([decoded(i or b"", bytes_of) for i in batch], dtype=object)

    return coded.withColumn(text, spelled(F.col(ids)))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(small_batches(spark), sf_dir, "documents").select("doc_id", "text")
    return with_text(with_ids(docs, fit(docs))).select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )

"""Token-id output: documents become rows of fixed length for training.

A task tokenises its documents, cuts overlong ones into chunks without loss, and packs the chunks by best fit decreasing:
each goes to the row with the least room that still holds it, found with a segment tree over capacities. Rows are packed
per task and batch of chunks, so nothing is shuffled and a lost task repeats alone.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from paylake.llm.common import small_batches, table

#: The folder of the vocabulary files; a parameter wherever it is used.
VOCABULARY = os.environ.get("TOKENIZER_FILES", "/opt/tokenizers")
NAME = "byte_bpe_50k.tiktoken"
#: The vocabulary's pattern of pieces, and its one free id, written after each document.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_OF_TEXT = 50256
PAD = END_OF_TEXT
#: The characters that the pattern holds to be white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space of so many characters are cut out before the pattern is tried: it goes back over a run from its end.
LONG_RUN = 1000
#: Ids as stored; a vocabulary that needs more than 16 bits takes "<u4".
ID_TYPE = "<u2"
CONTEXT = 2048
#: Chunks packed together. Bounds a task's memory; rows left partly empty are at most one in some thousands.
CHUNKS_PER_BATCH = 8192

SCHEMA = pa.schema(
    [
        ("pack_id", pa.int64()), ("input_ids", pa.binary()), ("n_tokens", pa.int32()), ("cu_seqlens", pa.list_(pa.int32())),
        ("position_resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("doc_offsets", pa.list_(pa.int64())),
    ]
)
DDL = (
    "pack_id bigint, input_ids binary, n_tokens int, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<bigint>, doc_offsets array<bigint>"
)


class CapacityTree:
    """Rows by room left. A node tells whether any capacity below it has a row; search is logarithmic in the capacity."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.size
        while node:
            self.any[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, row) of the least room of at least `need`."""
        node = need + self.size
        if not self.any[node]:
            while node > 1 and not (node % 2 == 0 and self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.any[2 * node] else 2 * node + 1
        room = node - self.size
        while node:
            self.any[node] -= 1
            node >>= 1
        return room, self.rows[room].pop()


def best_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Rows as lists of item numbers. Equal sizes keep their order; of rows with equal room the last filled is taken."""
    tree, rows = CapacityTree(capacity), []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[item])
        if found:
            room, row = found
            rows[row].append(item)
        else:
            room, row = capacity, len(rows)
            rows.append([item])
        tree.add(room - sizes[item], row)
    return rows


def tokenizer(folder: str = VOCABULARY, name: str = NAME, id_type: str = ID_TYPE) -> Callable[[str], bytes]:
    """A function from text to its token ids as little-endian integers. Raises where the type cannot hold all ids.

    Of a run of white space the pattern makes one piece, without the run's last character if more text follows. Long runs
    are cut there and merged as they are, so their length is not bounded by the pattern's engine.
    """
    import tiktoken

    with open(os.path.join(folder, name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    if max(ranks.values(), default=0) > np.iinfo(id_type).max:
        raise ValueError(f"{name} has ids that {id_type} cannot hold")
    encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    runs = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")

    def plain(text: str) -> np.ndarray:
        return encoding.encode_to_numpy(text, disallowed_special=())

    def ids(text: str) -> bytes:
        parts, at = [], 0
        for run in runs.finditer(text):
            end = run.end() - (run.end() < len(text))
            parts += [plain(text[at : run.start()]), encoding._encode_single_piece(text[run.start() : end])]
            at = end
        return np.concatenate([*parts, plain(text[at:])]).astype(id_type).tobytes()

    return ids


def pack_rows(chunks: list[tuple[int | None, int, bytes]], context: int, pack_ids: Iterator[int], id_type: str = ID_TYPE) -> pa.RecordBatch:
    """chunks: document, offset of the chunk's first token in it, ids."""
    made: list[tuple] = []
    wide = np.dtype(id_type).itemsize
    for row in best_fit_decreasing([len(c[2]) // wide for c in chunks], context):
        parts = [chunks[i] for i in row]
        ends = np.cumsum([0] + [len(p[2]) // wide for p in parts])
        ids = b"".join(p[2] for p in parts) + np.full(context - ends[-1], PAD, id_type).tobytes()
        made.append((next(pack_ids), ids, int(ends[-1]), ends.tolist(), ends[:-1].tolist(), [p[0] for p in parts], [p[1] for p in parts]))
    columns = list(zip(*made, strict=True)) if made else [[] for _ in SCHEMA]
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, SCHEMA, strict=True)], schema=SCHEMA)


def pack(
    docs: DataFrame, context: int = CONTEXT, folder: str = VOCABULARY, name: str = NAME, id_type: str = ID_TYPE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Rows of `context` ids, as little-endian integers, padded at the end.

    cu_seqlens: where segments start, and the end of the last. position_resets: where positions start at 0 again, the start
    of each segment. doc_ids and doc_offsets: each segment's document and its first token's place there. Each document ends
    with one end-of-text id, so an empty or null text is one segment of that id alone. Rows with equal or null ids are
    separate documents. An empty table gives no rows. Only the two named columns are read.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = tokenizer(folder, name, id_type), np.array([END_OF_TEXT], id_type).tobytes()
        step = context * np.dtype(id_type).itemsize
        pack_ids = iter(range(TaskContext.get().partitionId() << 33, 1 << 63))
        waiting: list[tuple[int | None, int, bytes]] = []
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                ids = ids_of(value.as_py() or "") + end
                for at in range(0, len(ids), step):
                    waiting.append((key.as_py(), at // step * context, ids[at : at + step]))
                    if len(waiting) == CHUNKS_PER_BATCH:
                        yield pack_rows(waiting, context, pack_ids, id_type)
                        waiting = []
        if waiting:
            yield pack_rows(waiting, context, pack_ids, id_type)

    return docs.selectExpr(f"cast(`{doc_id}` as bigint)", f"`{text}`").mapInArrow(packed, DDL)


def write_packed(packed: DataFrame, path: str) -> None:
    """The id matrix, one row per record, with its segment table beside it. Ids do not compress, so they are stored plain."""
    packed.write.option("compression", "none").parquet(path)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack(table(spark, sf_dir, "documents"))

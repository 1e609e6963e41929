"""Cost-balanced packing of documents into sequences of a fixed number of tokens.

Each task packs its own documents in blocks of a bounded number of tokens, so nothing is
shuffled: full sequences are cut from long documents, and what is left of each document goes,
in descending order, to the sequence of lowest estimated cost that has room. The cost of a
piece is linear in its tokens plus quadratic (attention). The last tokens of a block form
sequences whose lengths are powers of two, so that no token of padding is needed.
"""

from __future__ import annotations

import base64
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtab.llm._util import in_arrow, read

END = 1
#: Tokens that a block has at least (but for a task's last one).
BLOCK = 1 << 21
SPECIAL = "<|endoftext|>"


def cost(tokens, linear: float = 1.0, quadratic: float = 1 / 2048):
    """Estimated work of a piece: linear layers, and attention within the piece."""
    return linear * tokens + quadratic * tokens * tokens


@cache
def tokenizer(name: str = "byte_bpe_50k"):
    """The ids that the tokenizer file {name}.json gives to a text.

    {name}.tiktoken holds the same vocabulary as ranks and is several times faster; a text
    with the special token's string goes by the .json file.
    """
    import public_tokenizers as P
    import tiktoken
    from tokenizers import Tokenizer

    with open(P.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(P.path(f"{name}.json"))

    def ids(text: str) -> list[int]:
        return exact.encode(text, add_special_tokens=False).ids if SPECIAL in text else fast.encode_ordinary(text)

    return ids


def assign(lengths: list[int], size: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of pieces of documents of these lengths."""
    pieces, sequences, left = [], 0, []
    for i, n in enumerate(lengths):
        full = n // size
        for j in range(full):
            pieces.append((i, j * size, size, sequences, 0))
            sequences += 1
        if n % size:
            left.append((n % size, i, full * size))
    total = sum(x[0] for x in left)
    rooms = [size] * (total // size) + [1 << b for b in range(size.bit_length() - 1, -1, -1) if total % size >> b & 1]
    room = np.array(rooms, np.int64)
    used = np.zeros(len(room), np.int64)
    load = np.zeros(len(room))
    for n, i, start in sorted(left, key=lambda x: (-x[0], x[1])):
        while n:
            fits = np.flatnonzero(room >= n)
            if len(fits):
                to, part = int(fits[np.argmin(load[fits])]), n
            else:  # cut: fill the sequence with the most room
                to = int(np.argmax(room))
                part = int(room[to])
            pieces.append((i, start, part, sequences + to, int(used[to])))
            used[to] += part
            room[to] -= part
            load[to] += cost(part)
            start, n = start + part, n - part
    return pieces


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, size: int = 2048, vocabulary: str = "byte_bpe_50k", block: int = BLOCK, with_ids: bool = False) -> DataFrame:
    """Pieces of documents in sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (, ids).

    docs: doc_id, text; other columns are ignored. A document's tokens are its text's ids and
    then END; a null text is empty. Each row is a document of its own, rows that repeat a
    doc_id and a null doc_id included. An empty table gives none.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def packed(ids: list[int | None], held: list[np.ndarray], first: int):
        rows = assign([len(x) for x in held], size)
        out = []
        for i, start, n, sequence, offset in rows:
            part = held[i][start : start + n]
            row = (ids[i], start, n, zlib.crc32(part.astype("<u4").tobytes()), len(held[i]), first + sequence, offset)
            out.append((*row, part.tolist()) if with_ids else row)
        kinds = [pa.list_(pa.int32()) if n == "ids" else pa.int64() for n in names]
        columns = list(zip(*out, strict=True))
        return max(r[3] for r in rows) + 1, pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches):
        encode = tokenizer(vocabulary)
        first = TaskContext.get().partitionId() << 32
        ids, held, n = [], [], 0
        for b in batches:
            for doc, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                tokens = encode(text.as_py() or "")
                tokens.append(END)
                ids.append(doc), held.append(np.array(tokens, np.uint32))
                n += len(tokens)
                if n >= block:
                    made, out = packed(ids, held, first)
                    yield out
                    first += made
                    ids, held, n = [], [], 0
        if held:
            yield packed(ids, held, first)[1]

    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def op7_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))

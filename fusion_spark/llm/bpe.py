"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches."""

from __future__ import annotations

import base64
import codecs
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from fusion_spark.llm.words import WordEncoder, byte_alphabet, slices, texts_of

Ranks = dict[bytes, int]


def read_ranks(path: str) -> Ranks:
    """Token bytes and their ranks from a rank file (base64 and number per line)."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def tokenizer_of(ranks: Ranks, pattern: str) -> Tokenizer:
    """A byte-level BPE tokenizer that merges by ``ranks``.

    Bytes become the characters of the byte alphabet. Every split of a token into two known
    tokens is a merge with the token's own rank, and a match that is a token needs no merge.
    """
    table = byte_alphabet()
    name = {token: "".join(table[b] for b in token) for token in ranks}
    merges = []
    for token, _ in sorted(ranks.items(), key=lambda item: item[1]):
        splits = [(token[:i], token[i:]) for i in range(1, len(token))]
        known = [(a, b) for a, b in splits if a in ranks and b in ranks]
        known.sort(key=lambda split: (ranks[split[0]], ranks[split[1]]))
        merges.extend((name[a], name[b]) for a, b in known)
    vocabulary = {name[token]: rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocabulary, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return tokenizer


def char_spans(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code-point spans (start, end exclusive) of tokens with these lengths in bytes.

    Tokens that share a character split between them all cover that character.
    """
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    stops = np.cumsum(lengths)
    return char[stops - lengths], char[stops - 1] + 1


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, offsets: bool = False
) -> DataFrame:
    """(doc_id, ids) per row of ``docs``; with ``offsets`` also arrays ``starts`` and ``ends``.

    Null texts count as empty and have no ids. Repeated rows give repeated results, an empty
    table an empty one. Columns other than ``doc_id`` and ``text`` are not read. Text that
    looks like a special token is ordinary text.
    """
    ranks = read_ranks(ranks_path)
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    shared = docs.sparkSession.sparkContext.broadcast({
        "model": tokenizer_of(ranks, pattern).to_str(), "pattern": pattern, "lengths": sizes,
    })
    schema = "doc_id long, ids array<int>"
    schema += ", starts array<int>, ends array<int>" if offsets else ""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, lengths = WordEncoder.of(shared.value), shared.value["lengths"]
        for batch in slices(batches):
            texts = texts_of(batch, "text")
            codes = [encoder.encode(text) for text in texts]
            flat = np.frombuffer(b"".join(codes), np.int32)
            bounds = np.cumsum([0, *(len(code) // 4 for code in codes)]).astype(np.int32)
            lists = [flat]
            if offsets:
                spans = [
                    char_spans(text, lengths[np.frombuffer(code, np.int32)])
                    for text, code in zip(texts, codes, strict=True) if code
                ]
                empty = np.array([], np.int32)
                lists += [
                    np.concatenate([empty, *(span[side] for span in spans)]).astype(np.int32)
                    for side in (0, 1)
                ]
            arrays = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x)) for x in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *arrays],
                names=["doc_id", "ids", "starts", "ends"][: 1 + len(arrays)],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of the ids, whole even where ids split a character.

    A null list counts as empty. Cast ``decoded`` to string for the text. An id that is not
    in the vocabulary fails the job.
    """
    ranks = read_ranks(ranks_path)
    order = sorted(ranks, key=ranks.get)
    numbers = np.array([ranks[token] for token in order])
    lengths = np.zeros(numbers[-1] + 1, np.int64)
    lengths[numbers] = [len(token) for token in order]
    starts = np.zeros(len(lengths), np.int64)
    starts[numbers] = np.cumsum([0, *(len(token) for token in order[:-1])])
    shared = encoded.sparkSession.sparkContext.broadcast((b"".join(order), starts, lengths))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, at, size = shared.value
        table = np.frombuffer(table, np.uint8)
        for batch in slices(batches):
            lists = batch.column("ids").fill_null([])
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            per_token = size[ids]
            if (per_token == 0).any():
                raise ValueError("an id is not in the vocabulary")
            ends = np.cumsum(per_token)
            total = int(ends[-1]) if len(ends) else 0
            raw = table[np.repeat(at[ids] - (ends - per_token), per_token) + np.arange(total)]
            counts = lists.value_lengths().to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], ends])[np.cumsum([0, *counts])].astype(np.int32)
            decoded = pa.Array.from_buffers(
                pa.binary(), batch.num_rows,
                [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(raw.tobytes())],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), lists, decoded], names=["doc_id", "ids", "decoded"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, ids array<int>, decoded binary"
    )


def decode_pieces(tokens: Iterable[bytes]) -> list[str]:
    """Text of each token in turn; a split character comes out with the token that ends it."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    pieces = [decoder.decode(token) for token in tokens]
    if rest := decoder.decode(b"", final=True):
        pieces.append(rest)
    return pieces

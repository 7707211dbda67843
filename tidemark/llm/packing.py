"""Best-fit packing of tokenised documents under several capacities.

A sequence has three capacities: tokens, documents, and attention cost (the sum of the
squared piece lengths).  Pieces are placed from the longest down.  Of the open
sequences that have room in every capacity, one is chosen by the weighted dot product
of the piece's demand and the residual capacities, or by the smallest weighted norm of
what would be left.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.inputs import partitions
from tidemark.session import staged

END = 2
SHARD = 8192  # pieces that are packed together
# How byte-level vocabulary files of this kind cut a text before merging
CUT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class Capacity:
    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    rule: str = "norm"  # or "dot"
    weights: tuple[float, float, float] = (1.0, 0.0, 1e-6)


def _byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


@lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of whole texts with the vocabulary file of the tokenizers library at ``path``.

    If its merges are numbered in their order, merging by the smallest id is the same as
    merging by rule, which a faster library does; else tokenizers itself is used.
    """
    content = json.loads(Path(path).read_text())
    vocabulary, merges = content["model"]["vocab"], content["model"]["merges"]
    pairs = ["".join(x if isinstance(x, list) else x.split(" ")) for x in merges]
    cut = content.get("pre_tokenizer") or {}
    like = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
    if like and not content.get("normalizer") and all(vocabulary[x] == 256 + k for k, x in enumerate(pairs)):
        special = {x["content"]: x["id"] for x in content.get("added_tokens", [])}
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in x): k for x, k in vocabulary.items() if x not in special}
        fast = tiktoken.Encoding("own", pat_str=CUT, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> list[int]:
            if any(x in text for x in special):
                return fast.encode(text, allowed_special="all")
            return fast.encode_ordinary(text)

        return encode
    slow = Tokenizer.from_file(path)
    return lambda text: slow.encode(text, add_special_tokens=False).ids


def _pieces(path: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = array("I", [*encode(text or ""), END]).tobytes()
                n = len(ids) // 4
                bounds = [0, *range((n - 1) % most + 1, n + 1, most)]
                for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    out.append((doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """``bin, offset`` of pieces, placed from the longest down."""
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    weights = np.array(capacity.weights)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    least = int(lengths.min(initial=0))
    rest = np.zeros((3, max(1, len(lengths))))  # residual capacities of the open bins
    number = np.zeros(max(1, len(lengths)), np.int64)
    opened = made = 0
    for i in order:
        demand = np.array([lengths[i], 1, lengths[i] ** 2], float)
        now = rest[:, :opened]
        fits = (now[0] >= demand[0]) & (now[1] >= demand[1]) & (now[2] >= demand[2])
        place = np.flatnonzero(fits)
        if len(place):
            left = now[:, place]
            if capacity.rule == "dot":
                score = -(weights * demand / full**2) @ left
            else:
                score = weights @ (((left - demand[:, None]) / full[:, None]) ** 2)
            at = int(place[score.argmin()])
        else:
            at = opened
            rest[:, at], number[at] = full, made
            opened, made = opened + 1, made + 1
        bins[i], offsets[i] = number[at], full[0] - rest[0, at]
        rest[:, at] -= demand
        if rest[0, at] < least or rest[1, at] < 1:  # nothing more can go there
            opened -= 1
            rest[:, at], number[at] = rest[:, opened], number[opened]
    return bins, offsets


def pieces(docs: DataFrame, path: str, most: int = 1024) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: token pieces of every row of ``docs``.

    A document is the ids of its whole text (null: none) and the id ``END``.  Only one
    longer than ``most`` is cut; then all pieces but the first have ``most`` tokens.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(path, most), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def packed(docs: DataFrame, path: str, capacity: Capacity | None = None, shard: int = SHARD) -> DataFrame:
    """A row per piece with its ``sequence_id`` and ``offset``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read.  Pieces are
    dealt by hash into shards of about ``shard`` and each shard is packed in one task,
    so memory is bounded and only the last sequences of a shard stay open.  No row is
    dropped: an empty or null text is one piece that holds the end token; repeated rows
    are packed as often as they occur.  An empty table gives no rows.
    """
    capacity = capacity or Capacity()
    found = staged(pieces(docs, path, capacity.tokens), "pieces")
    shards = max(1, -(-found.count() // shard))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True])
        bins, offsets = best_fit(rows["length"].to_numpy(), capacity)
        rows["sequence_id"] = rows["shard"].astype("int64") * (1 << 32) + bins
        rows["offset"] = offsets
        return rows.drop(columns="shard")

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    dealt = found.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("int"))
    return dealt.repartition(max(1, min(shards, partitions(docs.sparkSession))), "shard").groupBy("shard").applyInPandas(pack, schema)

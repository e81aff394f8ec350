"""Packing along a space-filling curve.

A document's vector is the mean of pseudorandom sign vectors of its token ids, a hashed bag of words projected to
``DIMS`` dimensions. Its coordinates give a Hilbert key; documents are range-sorted by it and laid end to end, and the one
long row of tokens is cut every ``length`` tokens. So neighbours on the curve share sequences, only the end of the row is not a
full sequence, and that end is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from locusmill.llm.common import running_start, written
from locusmill.llm.tokens import encode, loaded
from locusmill.llm.words import ragged, slices, sums

DIMS, BITS = 4, 8
PIECE = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@lru_cache(maxsize=1)
def sign_vectors(n_ids: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).choice(np.array([-1.0, 1.0], np.float32), (n_ids, DIMS))


def hilbert_key(x: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Keys along a Hilbert curve of points [n, dims] with integer coordinates of ``bits`` bits.

    From the highest bit down, each coordinate's bit either flips the lower bits of the first coordinate or swaps them with
    its own, which turns each sub-cube as the curve needs; the Gray code of the interleaved bits is the key.
    """
    x = x.astype(np.uint32).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = np.uint32((1 << b) - 1)
        for i in range(dims):
            up = (x[i] >> np.uint32(b)) & np.uint32(1) == 1
            swap = np.where(up, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap if i else np.uint32(0)
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[dims - 1] >> np.uint32(b)) & np.uint32(1) == 1, flip ^ np.uint32((1 << b) - 1), flip)
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> np.uint32(b)) & np.uint32(1))
    return key


def _coordinates(mean: np.ndarray) -> np.ndarray:
    """Means of signs to integer coordinates, spread by a fixed logistic curve."""
    return np.clip((1 << BITS) / (1 + np.exp(-mean * 12)), 0, (1 << BITS) - 1).astype(np.uint32)


def tokenised(docs: DataFrame, tokenizer: str, end_id: int, text: str = "text") -> DataFrame:
    """Replace the text by ``_ids`` (unsigned little-endian ids, then ``end_id``, in as many bytes as the vocabulary needs), ``_n`` of them and the Hilbert ``_key``."""
    width = id_type(tokenizer, end_id)
    spec = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text())
    kept = [c for c in docs.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, mb=16, gather=True):
            flat, at, units, offsets = encode(b.column(text), spec.value)
            per = np.diff(at)
            flat = flat.astype(width)
            signs = sign_vectors(1 << 16)
            whole = np.stack([sums(signs[flat & 0xFFFF, d].astype(np.float64), at) for d in range(DIMS)], 1)  # of each unit
            n = sums(per[units], offsets)
            mean = np.stack([sums(whole[units, d], offsets) for d in range(DIMS)], 1) / np.maximum(n, 1)[:, None]
            keys = hilbert_key(_coordinates(mean))
            tail = np.array([end_id], width).tobytes()
            step = 512  # texts whose ids are laid out at once
            for a in range(0, b.num_rows, step):
                z = min(b.num_rows, a + step)
                codes = units[offsets[a] : offsets[z]]
                ids = ragged(flat, at[:-1][codes], per[codes]).tobytes()
                ends = np.concatenate([[0], np.cumsum(n[a:z])]) * int(width[-1])
                blobs = [ids[x:y] + tail for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]
                part = b.slice(a, z - a)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(blobs, pa.binary()), pa.array(n[a:z] + 1, pa.int64()), pa.array(keys[a:z], pa.int64())], [*kept, "_ids", "_n", "_key"]
                )

    added = [StructField("_ids", BinaryType()), StructField("_n", LongType()), StructField("_key", LongType())]
    return docs.mapInArrow(run, StructType([*[docs.schema[c] for c in kept], *added]))


def id_type(tokenizer: str, end_id: int) -> str:
    """Two bytes where all ids fit, else four."""
    return "<u2" if max(end_id, loaded(Path(tokenizer).read_text()).get_vocab_size() - 1) < 1 << 16 else "<u4"


def last_cuts(total: int, length: int) -> list[int]:
    """Ends of the sequences behind the last full one: powers of two, falling."""
    at, cuts = total - total % length, []
    for b in reversed(range(length.bit_length())):
        if total - at >= 1 << b:
            at += 1 << b
            cuts.append(at)
    return cuts


def _cutter(total: int, length: int, width: str):
    full, tail = total // length, np.array(last_cuts(total, length), np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, rows = b.column("doc_id").take, []
            of: list[int] = []
            for i, (blob, start) in enumerate(zip(b.column("_ids").to_pylist(), b.column("_start").to_pylist())):
                ids = np.frombuffer(blob, width).astype("<u4")
                end = start + len(ids)
                inner = np.concatenate([np.arange((start // length + 1) * length, min(end, full * length + 1), length), tail])
                at = [start, *inner[(inner > start) & (inner < end)].tolist(), end]
                for a, z in zip(at, at[1:]):
                    if a < full * length:
                        seq, base = a // length, a - a % length
                    else:
                        k = int(np.searchsorted(tail, a, side="right"))
                        seq, base = full + k, int(tail[k - 1]) if k else full * length
                    of.append(i)
                    rows.append((a - start, z - a, zlib.crc32(ids[a - start : z - start]), len(ids), seq, a - base))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * len(PIECE)
            yield pa.RecordBatch.from_arrays([docs(pa.array(of, pa.int64())), *columns], ["doc_id", *PIECE])

    return cut


def pack_along_curve(docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 2, text: str = "text") -> DataFrame:
    """The pieces of every document (columns ``doc_id`` and ``text``), with their sequence and offset there.

    Null and empty texts are the end id alone; repeated rows and ids are documents of their own; an empty table
    gives no pieces; other columns don't count. ``length`` is a power of two. Documents are sorted in ranges of the key; equal keys (copies) follow by the hash of id and tokens.
    """
    laid = tokenised(docs.select(F.col("doc_id"), F.col(text)), tokenizer, end_id, text)
    laid = written(laid.withColumn("_tie", F.xxhash64("doc_id", "_ids")).withColumn("_row", F.monotonically_increasing_id()), "packing-ids")
    starts = running_start(laid.select("_row", "_key", "_tie", "_n"), [], ["_key", "_tie"], "_n", "_start").select("_row", "_start")
    total = laid.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    placed = laid.join(starts, "_row").select("doc_id", "_ids", "_start")
    schema = StructType([docs.schema["doc_id"], *[StructField(c, LongType()) for c in PIECE]])
    return placed.mapInArrow(_cutter(total, length, id_type(tokenizer, end_id)), schema)


def op5_curve_packing(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The contract's query."""
    import public_tokenizers

    return pack_along_curve(docs, tokenizer or public_tokenizers.path("word_bpe_49k.json"))

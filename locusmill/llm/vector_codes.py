"""Vector code compression: product codes of integer vectors, learnt and assigned with exact integer arithmetic on floating-point BLAS.

Products of integer matrices are taken limb by limb: each integer is cut into limbs so short that every sum of products of two limbs stays below
2^53 and a float64 GEMM gives it exactly; the limbs' products are shifted and added in int64. Distances are exact whenever they fit in 64 bits, and
ties go to the lower index.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from locusmill.llm.common import written

#: Bits of a float64's mantissa.
EXACT_BITS = 53
#: Vectors multiplied at once in a task.
ROWS = 4096


def limb_bits(width: int) -> int:
    """Bits of a limb so that a sum of ``width`` products of two limbs is below 2^53."""
    return (EXACT_BITS - int(width).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 arrays with x = sum of limb k * 2^(bits * k); all but the last are in [0, 2^bits), the last carries the sign and is no longer."""
    out = []
    while x.size and max(int(x.max()), -int(x.min())) >= 1 << bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices by float64 GEMMs over limbs, exact modulo 2^64."""
    bits = limb_bits(a.shape[1])
    out = np.zeros((len(a), len(b)), np.int64)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(limbs(b, bits)):
            if (shift := bits * (i + j)) < 64:
                out += (x @ y.T).astype(np.int64) << shift
    return out


def nearest(a: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``a`` the first entry of least squared distance, and that distance."""
    high = max((max(int(x.max()), -int(x.min())) for x in (a, book) if x.size), default=0)
    if a.shape[1] * (2 * high) ** 2 >= 1 << 63:
        raise ArithmeticError("squared distances don't fit in 64 bits: components are too large")
    far = (book * book).sum(1)[None, :] - 2 * exact_products(a, book)
    best = far.argmin(1)
    return best, far[np.arange(len(a)), best] + (a * a).sum(1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), width)


def _batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, ROWS):
            yield b.slice(k, ROWS)


def _integers(vector: str, scale: int) -> Callable:
    """Drop rows without a whole finite vector; the others' vectors become integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batched(batches):
            b = b.filter(pc.is_valid(b.column(vector)))
            column = b.column(vector)
            flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))]).astype(np.int64)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            fine = bad[offsets[1:]] == bad[offsets[:-1]]
            flat = flat[np.repeat(fine, np.diff(offsets))]
            if flat.size and np.abs(flat).max() >= 2.0**62:
                raise ArithmeticError("components are too large for 64 bits")
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.diff(offsets)[fine])]), pa.int32()), pa.array(flat.astype(np.int64)))
            kept = b.filter(pa.array(fine))
            yield kept.set_column(kept.schema.get_field_index(vector), vector, lists)

    return run


def integer_vectors(df: DataFrame, vector: str, scale: int = 1024) -> DataFrame:
    """``df`` with floor(scale * x) for every component of ``vector``, without the rows whose vector is null or holds null, NaN or an infinity."""
    schema = StructType([StructField(f.name, ArrayType(LongType()), True) if f.name == vector else f for f in df.schema.fields])
    return df.mapInArrow(_integers(vector, scale), schema)


def _sums(books: np.ndarray, width: int, vector: str) -> Callable:
    """For each part and entry, the sum and number of a task's parts that lie nearest to it."""
    parts, k, part_width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, k, part_width), np.int64), np.zeros((parts, k), np.int64)
        for b in _batched(batches):
            x = _matrix(b.column(vector), width).reshape(b.num_rows, parts, part_width)
            for p in range(parts):
                own, _ = nearest(np.ascontiguousarray(x[:, p]), books[p])
                np.add.at(total[p], own, x[:, p])
                count[p] += np.bincount(own, minlength=k)
        part, entry = np.nonzero(count)
        sums = total[part, entry]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * part_width, pa.int32()), pa.array(sums.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(count[part, entry]), lists], ["part", "entry", "n", "sums"])

    return run


def learn_codebooks(vectors: DataFrame, vector: str, key: str, width: int, parts: int = 4, entries: int = 256, rounds: int = 4) -> np.ndarray:
    """Codebooks [part, entry, position] of ``vectors``, whose ``vector`` holds ``width`` longs each, a multiple of ``parts``.

    They start as the parts of the rows of least ``key`` (nulls last; equal keys by their vector). In each round every part goes to its nearest entry, the
    lower one of a tie, and each entry becomes the floor of its parts' mean; entries without parts stay. A task sends a row for each part and entry
    that it met, which are added up by part and entry; the driver holds the codebooks alone, ``entries * width`` numbers.
    """
    # the keys alone first, so that no partition sends more vectors than it holds among the first ones
    least = [r[0] for r in vectors.select(key).orderBy(F.col(key).asc_nulls_last()).limit(entries).collect()]
    few = vectors.filter(F.col(key) <= F.lit(least[-1])) if least and least[-1] is not None else vectors
    first = few.orderBy(F.col(key).asc_nulls_last(), vector).select(vector).limit(entries).collect()
    books = np.array([r[0] for r in first], np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy()
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width // parts)]
    for _ in range(rounds if books.size else 0):
        met = vectors.select(vector).mapInArrow(_sums(books, width, vector), "part int, entry int, n long, sums array<long>")
        for r in met.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():
            books[r["part"], r["entry"]] = np.array(r[3:], np.int64) // r["n"]
    return books


def codebooks_sha256(books: np.ndarray) -> str:
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def assign_codes(vectors: DataFrame, vector: str, books: np.ndarray, width: int) -> DataFrame:
    """``vectors`` with ``code``, two hex digits for each part's entry, and ``error``, the squared distances to these entries, in place of ``vector``."""
    parts, _, part_width = books.shape
    kept = [c for c in vectors.columns if c not in (vector, "code", "error")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batched(batches):
            x, error, digits = _matrix(b.column(vector), width).reshape(b.num_rows, parts, part_width), np.zeros(b.num_rows, np.int64), np.zeros((b.num_rows, parts), np.uint8)
            for p in range(parts):
                digits[:, p], far = nearest(np.ascontiguousarray(x[:, p]), books[p])
                error += far
            code = [row.tobytes().hex() for row in digits]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(code, pa.string()), pa.array(error)], [*kept, "code", "error"])

    schema = StructType([*[vectors.schema[c] for c in kept], StructField("code", StringType()), StructField("error", LongType())])
    return vectors.select(*kept, vector).mapInArrow(run, schema)


def compress(df: DataFrame, key: str, vector: str, label: str, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> DataFrame:
    """``df``'s rows with a whole finite vector: key, label, code, error, label_error (error summed over equal labels, nulls together), codebooks_sha256.

    Repeated rows and null keys or labels stay rows of their own. Vectors shorter than the longest one, and a width that ``parts`` doesn't divide, are filled up with zeros,
    which add nothing to a distance between them. With fewer rows than ``entries`` the codebooks are as short; without rows, or with empty vectors alone, codes name entry 0 and errors
    are 0. Other columns aren't kept and may have any name. Components must stay so small that squared distances fit in 64 bits, else an ArithmeticError is raised.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry has two hex digits: 1 to 256 entries")
    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    whole = written(integer_vectors(rows, "vector", scale), "vectors")
    least, longest = whole.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    width = -(-(longest or 0) // parts) * parts
    vectors = whole
    if least != width:
        vectors = whole.withColumn("vector", F.concat("vector", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vector"))))
    books = learn_codebooks(vectors, "vector", "key", width, parts, entries, rounds)
    if width:
        coded = assign_codes(vectors, "vector", books, width)
    else:
        coded = vectors.select("key", "label", F.lit("00" * parts).alias("code"), F.lit(0).cast("long").alias("error"))
    coded = written(coded, "vector-codes")
    totals = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "of")
    out = coded.join(totals, F.col("label").eqNullSafe(F.col("of")))
    return out.select(F.col("key").alias(key), F.col("label").alias(label), "code", "error", "label_error", F.lit(codebooks_sha256(books)).alias("codebooks_sha256"))


def op13_limb_codes(vectors: DataFrame) -> DataFrame:
    """The contract's query."""
    return compress(vectors, "vec_id", "embedding", "label").select("vec_id", "code", "error", "label_error", "codebooks_sha256")

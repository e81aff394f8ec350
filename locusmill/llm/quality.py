"""Quality rules: counts of each text, and a hashed n-gram log-likelihood ratio.

The n-grams (three bytes of a word between blanks) of trusted documents and of the whole corpus are counted in hash buckets. A
document's score is the mean, over its n-grams, of the log of target share to corpus share of their buckets; it is kept if the score is
at least a threshold, which lies between the scores of documents labelled good (each scored as if it weren't in the target) and bad. Corpus counts cover all documents, the target all trusted ones, the threshold all labelled ones. Byte n-grams are
few enough for a target of some dozen documents; over whole words, a small target rejects whatever it doesn't happen to hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from locusmill.llm.common import discard, table, written
from locusmill.llm.words import Words, give_back, gram_hashes, ragged, slices, sums, word_codes

BUCKETS = 1 << 14
GRAM = 3
#: Share of the good documents that the threshold may reject.
GOOD_LOST = 0.01


def labelled_ids(labels: DataFrame) -> DataFrame:
    """doc_id, good: all ids that a row trusts (labelled good and not toxic), and all others that a row labels bad. Null ids and labels don't count."""
    marks = {"good": (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), "_bad": F.col("quality") == 0}
    ids = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*[F.coalesce(F.max(m), F.lit(False)).alias(k) for k, m in marks.items()])
    return ids.filter("good OR _bad").drop("_bad")


def _buckets(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the words, and the word that it is in."""
    if not len(names):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = pc.binary_length(names).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    raw = np.frombuffer(b" " + b"  ".join(pc.cast(names, pa.binary()).to_pylist()) + b" ", np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(size)), size)
    same = word[: 1 - GRAM] == word[GRAM - 1 :]
    return (gram_hashes(raw, GRAM)[same] % np.uint64(BUCKETS)).astype(np.int64), word[: 1 - GRAM][same]


def _packed(at: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending buckets, as gaps, and their counts: four planes of bytes each, compressed."""
    planes = np.stack([np.diff(at, prepend=0), n]).astype("<u4").view(np.uint8).reshape(2, len(at), 4).transpose(0, 2, 1)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and counts of each row of ``document_grams``."""
    for size, grams in zip(b.column("n_buckets").to_pylist(), b.column("grams").to_pylist()):
        planes = np.frombuffer(pa.decompress(grams, decompressed_size=8 * size, codec="zstd", asbytes=True), np.uint8)
        gaps, n = planes.reshape(2, 4, size).transpose(0, 2, 1).copy().view("<u4").reshape(2, size).astype(np.int64)
        yield np.cumsum(gaps), n


def document_grams(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, ok (passes the base rules), n_buckets, grams: each document's n-grams by bucket, ``_packed``. They take less than texts to move to their labels."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            w = word_codes(b.column(text))
            at, word = _buckets(w.names)
            per = np.bincount(word, minlength=len(w.names))
            first = np.cumsum(per) - per
            ok = ~_base_failed(w.lengths, _repeat_words(w))
            sizes, grams = [], []
            for a, z in zip(w.offsets[:-1], w.offsets[1:]):
                codes = w.codes[a:z]
                n = np.bincount(ragged(at, first[codes], per[codes]), minlength=BUCKETS)
                some = np.flatnonzero(n)
                sizes.append(len(some))
                grams.append(_packed(some, n[some]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ok), pa.array(sizes, pa.int32()), pa.array(grams, pa.binary())], ["doc_id", "ok", "n_buckets", "grams"])

    return docs.select("doc_id", text).mapInArrow(count, StructType([docs.schema["doc_id"], StructField("ok", BooleanType()), StructField("n_buckets", IntegerType()), StructField("grams", BinaryType())]))


def bucket_counts(grams: DataFrame) -> np.ndarray:
    """n-grams of each bucket in all rows of ``document_grams``. Counts are summed in each task first; ``BUCKETS`` rows at most come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for at, n in _unpacked(b):
                total[at] += n
        give_back()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    got = grams.select("n_buckets", "grams").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS)
    out[got["bucket"]] = got["n"]
    return out


def shares(raw: np.ndarray) -> np.ndarray:
    """Corpus share of each bucket."""
    return (raw + 1) / (raw.sum() + BUCKETS)


def log_ratios(share: np.ndarray, target: np.ndarray, total: float | None = None) -> np.ndarray:
    """Log of target share to corpus share of each bucket; the target is smoothed by one corpus-like count a bucket.

    ``total``: of all buckets' target n-grams, if only some buckets are given. Without target n-grams all ratios are 0, so nothing is rejected.
    """
    return np.log((target + BUCKETS * share) / ((target.sum() if total is None else total) + BUCKETS) / share)


def _llr(w: Words, at: np.ndarray, word: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The mean ratio of each text's n-grams, which ``_buckets`` gave for the words."""
    grams = np.bincount(word, minlength=len(w.names))
    each = np.bincount(word, np.round(ratios[at], 9), len(w.names))
    return sums(each[w.codes], w.offsets) / np.maximum(sums(grams[w.codes], w.offsets), 1)


def _base_failed(per: np.ndarray, again: np.ndarray) -> np.ndarray:
    return (per < 50) | (100 * again > 50 * per)


def labelled_scores(known: DataFrame, share: np.ndarray, target: np.ndarray) -> DataFrame:
    """good, llr (to 3 digits), n: how many labelled documents (``document_grams`` with good) that pass the base rules have a score. From the target, a good one's own n-grams are taken off."""
    model = known.sparkSession.sparkContext.broadcast((share, target))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, target = model.value
        whole, total = log_ratios(share, target), target.sum()
        for b in batches:
            llr = []
            for good, (at, n) in zip(b.column("good").to_pylist(), _unpacked(b)):
                ratios = log_ratios(share[at], target[at] - n, total - n.sum()) if good else whole[at]
                llr.append(n @ np.round(ratios, 9) / n.sum())
            yield pa.RecordBatch.from_arrays([b.column("good"), pa.array(np.round(llr, 3), pa.float64())], ["good", "llr"])

    return known.filter("ok").select("good", "n_buckets", "grams").mapInArrow(score, "good boolean, llr double").groupBy("good", "llr").agg(F.count(F.lit(1)).alias("n"))


def threshold_between(scores: pd.DataFrame) -> float:
    """Halfway from the least score that at most ``GOOD_LOST`` of the good documents stay below, to the next score of a bad one below it.

    Without bad ones below that score, the least score of a good one; without good documents, minus infinity: the base rules alone decide.
    """
    good, bad = (scores[scores["good"] == x].sort_values("llr") for x in (True, False))
    if not len(good):
        return -math.inf
    low = good["llr"][good["n"].cumsum() > GOOD_LOST * good["n"].sum()].iloc[0]
    below = bad["llr"][bad["llr"] < low]
    return float((low + below.max()) / 2) if len(below) else float(good["llr"].iloc[0])


def _line_repeats(texts: pa.Array) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, for each text."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    lines, per = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = lines.dictionary_encode()
    named = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(codes.dictionary)), 0).to_numpy(zero_copy_only=False).astype(bool)
    at = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    again = pd.Series(np.repeat(np.arange(len(per)), per) * max(1, len(named)) + at).duplicated().to_numpy()
    return sums((again & named[at]).astype(np.int64), np.concatenate([[0], np.cumsum(per)]))


def _repeat_words(w: Words) -> np.ndarray:
    """Words in runs of three that occur twice or more in their text, for each text."""
    doc, n = w.doc, len(w.codes)
    if n < 3:
        return np.zeros(len(w.offsets) - 1, np.int64)
    inside = doc[:-2] == doc[2:]
    runs = gram_hashes(w.codes.astype(np.uint64) + np.uint64(1), 3)
    runs = runs[inside] * np.uint64(0x9E3779B97F4A7C15) + doc[:-2][inside].astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    hit = np.zeros(n, bool)
    starts = np.flatnonzero(inside)[pd.Series(runs).duplicated(keep=False).to_numpy()]
    for k in range(3):
        hit[starts + k] = True
    return sums(hit.astype(np.int64), w.offsets)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame, ratios: np.ndarray, text: str = "text", threshold: float = -math.inf) -> DataFrame:
    """Add ``COUNTS``, ``llr`` (null without words), ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail the base rules. Rows stay, repeated ones too; columns of the added names are
    replaced; an empty table stays empty.
    """
    docs = docs.drop(*COUNTS, "llr", "base_failed", "kept")
    model = docs.sparkSession.sparkContext.broadcast(ratios)
    added = [*COUNTS, "llr", "base_failed", "kept"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            texts = b.column(text)
            w = word_codes(texts)
            per = w.lengths
            chars = pc.utf8_length(w.names).to_numpy(zero_copy_only=False).astype(np.int64)
            marks = pc.count_substring_regex(w.names, r"[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64)
            again = _repeat_words(w)
            at, word = _buckets(w.names)
            llr = _llr(w, at, word, model.value)
            failed = _base_failed(per, again)
            columns = [per, sums(chars[w.codes], w.offsets), sums(marks[w.codes], w.offsets), _line_repeats(texts), again]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(c, pa.int64()) for c in columns], pa.array(llr, mask=per == 0), pa.array(failed), pa.array(~failed & (llr >= threshold))], [*b.schema.names, *added]
            )

    types = [*[LongType()] * len(COUNTS), DoubleType(), BooleanType(), BooleanType()]
    return docs.mapInArrow(judge, StructType([*docs.schema.fields, *[StructField(c, t) for c, t in zip(added, types)]]))


def quality_rules(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """``judged`` with ratios and threshold fitted on these documents and labels. The labels are merged in at every size, not broadcast, so that small runs tell of large ones."""
    grams = written(document_grams(docs, text), "grams")
    known = written(grams.join(labelled_ids(labels).hint("merge"), "doc_id"), "labelled")
    share, target = shares(bucket_counts(grams)), bucket_counts(known.filter("good"))
    threshold = threshold_between(labelled_scores(known, share, target).toPandas())
    discard(grams, known)
    return judged(docs, log_ratios(share, target), text, threshold)


def op3_llr_rules(spark, sf_dir: str) -> DataFrame:
    """The contract's query."""
    out = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *COUNTS, "base_failed", "kept", "llr")

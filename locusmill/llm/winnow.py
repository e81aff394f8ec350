"""Winnowing fingerprints, in DataFrame functions only.

A text is cut into units, every run of ``k`` units is hashed, and each window of ``w`` neighbouring hashes keeps its minimum, the rightmost
of equal ones. Words are units; a word of more than ``UNIT_CHARS`` characters, as text without spaces is, has one at each character
instead: the ``STEP_CHARS`` characters from there, so that its units don't depend on where it begins. Two texts that share ``k + w - 1`` units
in a row, or ``k + w + STEP_CHARS - 2`` characters inside long words, share a kept hash; the kept positions show where.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Longer words have overlapping units of ``STEP_CHARS`` characters.
UNIT_CHARS = 16
STEP_CHARS = 8
_IN, _SHORT = r"[^\x20\x09-\x0D]", rf"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{{1,{UNIT_CHARS}}}+(?![^\x20\x09-\x0D])"
#: Group 1 is the unit; a short word is passed as a whole, a long one by a character.
UNIT = rf"(?=({_SHORT}|{_IN}{{{STEP_CHARS}}}))(?:{_SHORT}|{_IN})"
FINGERPRINT = "array<struct<pos:int,hash:bigint>>"


def _gram_hashes(text: Column, k: int) -> Column:
    """Hashes of the runs of ``k`` units; a shorter text has one, of all its units; a text without units none."""
    units = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(UNIT), F.lit(1)), lambda u: F.xxhash64(u))
    # ``let``: one evaluation of an array that is used several times
    return _let(
        units,
        lambda u: F.when(F.size(u) == 0, F.array().cast("array<bigint>"))
        .when(F.size(u) < k, F.array(F.aggregate(u, F.lit(0).cast("bigint"), lambda a, x: F.xxhash64(a, x))))
        .otherwise(F.transform(F.sequence(F.lit(0), F.size(u) - k), lambda i: F.xxhash64(*[F.get(u, i + j) for j in range(k)]))),
    )


def _let(value: Column, f) -> Column:
    return F.get(F.transform(F.array(value), f), 0)


def fingerprint(text: Column, k: int = 3, w: int = 8) -> Column:
    """Kept (pos, hash) by position; ``pos`` counts units from 0. Null and empty texts have none.

    With fewer hashes than ``w`` there is one window of all of them.
    """
    rightmost = lambda h: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(h) - w, F.lit(0))),
        lambda j: _let(F.reverse(F.slice(h, j + 1, F.lit(w))), lambda win: j + F.size(win) - F.array_position(win, F.array_min(win)).cast("int")),
    )
    return _let(
        _gram_hashes(text, k),
        lambda h: F.when(F.size(h) == 0, F.array().cast(FINGERPRINT)).otherwise(
            F.transform(F.array_distinct(rightmost(h)), lambda p: F.struct(p.alias("pos"), F.get(h, p).alias("hash")))
        ),
    )


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of the kept hashes, 0 to 1; two empty fingerprints are alike (1)."""
    hashes = lambda x: F.array_distinct(F.transform(x, lambda y: y["hash"]))
    return _let(
        F.struct(hashes(a).alias("a"), hashes(b).alias("b")),
        lambda p: _let(
            F.size(F.array_intersect(p["a"], p["b"])),
            lambda n: F.when(F.size(p["a"]) + F.size(p["b"]) == 0, F.lit(1.0)).otherwise(n / (F.size(p["a"]) + F.size(p["b"]) - n)),
        ),
    )


def as_text(fp: Column) -> Column:
    """``pos:hash`` of each kept hash, hexadecimal, comma-joined."""
    return F.array_join(F.transform(fp, lambda x: F.concat_ws(":", x["pos"].cast("string"), F.lower(F.hex(x["hash"])))), ",")


#: Rows of a range of keys, at least; with very many rows, both ranges and the rows of each grow as the root of their number.
RUN_ROWS = 10_000
LEAST = -(1 << 63)


def _range_starts(cuts: list[int], null_ranges: int) -> list[tuple[int, int, int]]:
    """(1 unless the key is null, key, tie) at which each range but the first starts. Null keys, and a key that is several quantiles, have ranges of their own, cut evenly along their ties, which are hashes."""
    starts = [(0, 0, LEAST + (k << 64) // null_ranges) for k in range(1, null_ranges)]
    if null_ranges:
        starts.append((1, LEAST, LEAST))
    times = Counter(cuts)
    for v in sorted(times):
        starts += [(1, v, LEAST + (k << 64) // times[v]) for k in range(times[v])]
        if times[v] > 1 and v < -LEAST - 1:
            starts.append((1, v + 1, LEAST))
    return sorted(set(starts))


def _found(starts: list[tuple[int, int, int]], at: Column) -> Column:
    """How many of the sorted starts are not above ``at``, by halves."""
    if not starts:
        return F.lit(0)
    known = F.from_json(F.lit(json.dumps([{"a": a, "k": k, "t": t} for a, k, t in starts])), "array<struct<a:int,k:bigint,t:bigint>>")
    steps = [1 << b for b in reversed(range(len(starts).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda p, step: F.when(F.get(known, p + step - 1) <= at, p + step).otherwise(p))


def with_next(df: DataFrame, key: str, columns: list[str], run_rows: int = RUN_ROWS) -> DataFrame:
    """Add ``next_<c>`` for each column: its value in the next row by ``key``, ties by ``tie``; after the last row, the first's.

    Keys are integers, ties hashes. Rows are dealt into key ranges cut at quantiles of the keys, ``run_rows`` rows each or the root of all rows if that is more, and
    ordered inside each; the first row of a range is also sent to the end of the range before it, so that texts
    are shuffled once. Equal and null keys are cut along their ties; rows that agree in both stay in one range. There is a start and a first row for each range: no more than the root of all rows.
    ``df`` must have the columns ``key`` and ``tie`` and is read twice. Null keys come first.
    """
    rows, null = df.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull())).first()
    run_rows = max(run_rows, math.isqrt(rows))
    parts = (rows - null) // run_rows
    cuts = df.agg(F.percentile_approx(key, [k / parts for k in range(1, parts)], 20 * parts)).first()[0] if parts > 1 else None
    at = F.struct(F.when(F.col(key).isNull(), 0).otherwise(1).alias("a"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("k"), F.col("tie").alias("t"))
    run = _found(_range_starts(list(cuts or []), -(-null // run_rows)), at).cast("long")
    dealt = df.withColumn("_run", run)
    firsts = dealt.groupBy("_run").agg(F.min(F.struct(F.col(key), F.col("tie"))).alias("_first"))
    every = Window.orderBy("_run")  # one row for each range
    firsts = firsts.withColumn("_to", F.lag("_run").over(every))
    firsts = firsts.withColumn("_to", F.coalesce("_to", F.max("_run").over(Window.partitionBy(F.lit(1)))))
    firsts = firsts.withColumnRenamed("_run", "_from")
    # one of several equal first rows will do: the copies that follow the first copy are never looked at
    sent = dealt.join(F.broadcast(firsts), F.col("_run") == F.col("_from"), "left").withColumn("_send", F.struct(F.col(key), F.col("tie")) == F.col("_first"))
    copies = F.when(F.col("_send"), F.array(F.struct(F.lit(0).alias("end"), F.col("_run").alias("run")), F.struct(F.lit(1).alias("end"), F.col("_to").alias("run")))).otherwise(
        F.array(F.struct(F.lit(0).alias("end"), F.col("_run").alias("run")))
    )
    laid = sent.withColumn("_c", F.explode(copies)).withColumn("_end", F.col("_c.end")).withColumn("_run", F.col("_c.run"))
    order = Window.partitionBy("_run").orderBy("_end", key, "tie")
    for c in columns:
        laid = laid.withColumn(f"next_{c}", F.lead(c).over(order))
    return laid.filter(F.col("_end") == 0).select(*df.columns, *[f"next_{c}" for c in columns])


def op8_winnowing(docs: DataFrame) -> DataFrame:
    """The contract's query.

    Null texts count as empty; documents of equal doc_id follow each other by the hash of their texts.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("fp", fingerprint(F.col("text")))
    ahead = with_next(rows, "doc_id", ["text", "fp"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    out = ahead.withColumn("edited", edited).withColumn("edited_fp", fingerprint(F.col("edited")))
    return out.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )

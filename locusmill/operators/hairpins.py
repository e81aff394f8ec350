"""Hairpins: windows around candidates, folding, and what a fold looks like."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusmill.functions.circular import precursor_windows
from locusmill.functions.sequences import reverse_complement_any_case
from locusmill.operators.shuffles import shuffle_column
from locusmill.operators.stretches import cut, pieces

Fold = Callable[[list[str]], list[tuple[str, float]]]
DESCRIPTION = "hairpin_loops int, stem_pairs int, stem_fraction double, single_hairpin boolean, arm string, paired_fraction double"


def partners(structure: str) -> np.ndarray:
    """The partner of each position of a dot-bracket string, -1 where unpaired. Unbalanced or other characters raise ValueError."""
    out, open_ = np.full(len(structure), -1), []
    for i, c in enumerate(structure):
        if c == "(":
            open_.append(i)
        elif c == ")":
            if not open_:
                raise ValueError("unbalanced structure")
            out[i] = open_.pop()
            out[out[i]] = i
        elif c != ".":
            raise ValueError(f"unexpected character {c!r}")
    if open_:
        raise ValueError("unbalanced structure")
    return out


def describe(structure: str, start: int, end: int, dominant: float = 0.8) -> tuple:
    """DESCRIPTION of a structure with its candidate at [start, end).

    Walking inwards along the brackets, a pair that encloses exactly one hairpin loop belongs to that loop's stem. The stem with most pairs (the
    leftmost of equal ones) is dominant; the arm is the side of it that the candidate pairs on.
    """
    pair = partners(structure)
    own = pair[start:end]
    share = float((own >= 0).mean()) if len(own) else 0.0
    opening = np.flatnonzero(pair > np.arange(len(pair)))
    if not len(opening):
        return 0, 0, 0.0, False, "NA", share
    before = np.concatenate([[0], np.cumsum(pair >= 0)])
    loops = np.array([i for i in opening if before[pair[i]] == before[i + 1]])
    # loops inside each pair: those that open between its ends
    inside = np.searchsorted(loops, pair[opening]) - np.searchsorted(loops, opening)
    single = opening[inside == 1]
    stem_of = loops[np.searchsorted(loops, single)]
    sizes = np.array([(stem_of == k).sum() for k in loops])
    stem = single[stem_of == loops[int(np.argmax(sizes))]]
    here = np.arange(start, end)
    five, three = np.isin(here, stem).any(), np.isin(here, pair[stem]).any()
    arm = "both" if five and three else "5p" if five else "3p" if three else "NA"
    fraction = len(stem) / len(opening)
    return len(loops), len(stem), fraction, bool(fraction >= dominant - 1e-9), arm, share


def described(folds: DataFrame, dominant: float = 0.8) -> DataFrame:
    """Add DESCRIPTION to rows with structure, cand_from, cand_to."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in DESCRIPTION.split(", ")]
        for b in batches:
            got = [describe(s, a, z, dominant) for s, a, z in zip(b["structure"], b["cand_from"], b["cand_to"])]
            yield pd.concat([b, pd.DataFrame(got, columns=names, index=b.index)], axis=1)

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in folds.schema)
    return folds.mapInPandas(run, f"{own}, {DESCRIPTION}")


def windows(candidates: DataFrame, contigs: DataFrame, near: int, far: int) -> DataFrame:
    """Windows of candidates (candidate, ref, start, end, strand; each once) with their sequence along the strand. ``contigs``: ref, sequence, circular.

    A window is put together from the pieces of the contig that it touches, over the origin from the last and the first ones.
    """
    if near < 0 or far < 0:
        raise ValueError("flanks must not be negative")
    rows = candidates.join(contigs.select("ref", "circular", F.char_length("sequence").cast("long").alias("length")), "ref")
    rows = rows.select("candidate", "ref", "strand", "length", F.explode(precursor_windows(F.col("start"), F.col("end"), F.col("strand"), F.col("length"), F.col("circular"), near, far)).alias("w"))
    span = lambda a, z: F.struct(a.alias("start"), z.alias("end"))
    whole, over = span(F.col("w.win_start"), F.col("w.win_end")), F.array(span(F.col("w.win_start"), F.col("length")), span(F.lit(0).cast("long"), F.col("w.win_end") - F.col("length")))
    spans = rows.select("candidate", "ref", "w.window", F.posexplode(F.when(F.col("w.wraps"), over).otherwise(F.array(whole))).alias("part", "s")).select("candidate", "ref", "window", "part", "s.start", "s.end")
    held = cut(spans, pieces(contigs), ["candidate", "ref", "window"])
    out = rows.select("candidate", "ref", "strand", "w.*").join(held, ["candidate", "ref", "window"])
    columns = ["candidate", "ref", "strand", "window", "win_start", "win_end", "cand_from", "cand_to", "wraps", "clipped"]
    return out.select(*columns, F.when(F.col("strand") == "+", F.col("sequence")).otherwise(reverse_complement_any_case(F.col("sequence"))).alias("sequence"))


def stacking_fold(sequences: list[str], loop: int = 3) -> list[tuple[str, float]]:
    """The nested structure with the most stacked hydrogen bonds: a plain stand-in for an energy model, not equal to any folding tool."""
    bonds = {"GC": 3.0, "CG": 3.0, "AT": 2.0, "TA": 2.0, "AU": 2.0, "UA": 2.0, "GT": 1.0, "TG": 1.0, "GU": 1.0, "UG": 1.0}
    out = []
    for s in sequences:
        n = len(s)
        best = np.zeros((n + 1, n + 1))
        for size in range(loop + 2, n + 1):
            for i in range(n - size + 1):
                j = i + size - 1
                top = max(best[i + 1, j], best[i, j - 1])
                if w := bonds.get(s[i] + s[j]):
                    top = max(top, best[i + 1, j - 1] + w)
                if size > 2 * loop + 4:
                    top = max(top, float((best[i, i + 1 : j] + best[i + 2 : j + 1, j]).max()))
                best[i, j] = top
        marks, todo = ["."] * n, [(0, n - 1)]
        while todo:
            i, j = todo.pop()
            if j - i < loop + 1 or best[i, j] == 0:
                continue
            w = bonds.get(s[i] + s[j])
            if w and best[i, j] == best[i + 1, j - 1] + w:
                marks[i], marks[j] = "(", ")"
                todo.append((i + 1, j - 1))
            elif best[i, j] == best[i + 1, j]:
                todo.append((i + 1, j))
            elif best[i, j] == best[i, j - 1]:
                todo.append((i, j - 1))
            else:
                k = i + int(np.argmax(best[i, i + 1 : j] + best[i + 2 : j + 1, j])) + 1
                todo += [(i, k), (k + 1, j)]
        out.append(("".join(marks), -float(best[0, n - 1]) if n else 0.0))
    return out


def folded(rows: DataFrame, fold: Fold = stacking_fold, column: str = "sequence") -> DataFrame:
    """Add structure and mfe by any folding function of a list of sequences, one call a batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = fold(b[column].tolist())
            yield b.assign(structure=[s for s, _ in got], mfe=[float(e) for _, e in got])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{own}, structure string, mfe double")


def with_shuffles(rows: DataFrame, n: int, seed: str = "1") -> DataFrame:
    """Rows (candidate, window, sequence, ...) and n shuffles of each; ``shuffle`` numbers them, null is the real one."""
    rows = rows.withColumn("shuffle", F.explode(F.sequence(F.lit(0), F.lit(n))))
    key = F.concat_ws(":", F.lit(seed), F.col("candidate").cast("string"), "window", F.col("shuffle").cast("string"))
    made = shuffle_column(F.col("sequence"), key)
    return rows.withColumn("sequence", F.when(F.col("shuffle") == 0, F.col("sequence")).otherwise(made)).withColumn("shuffle", F.when(F.col("shuffle") > 0, F.col("shuffle")))


def best_windows(rows: DataFrame) -> DataFrame:
    """Each candidate's window with the least p (null: 1), then the least energy, then 3p before 5p."""
    order = Window.partitionBy("candidate").orderBy(F.coalesce("p", F.lit(1.0)), "mfe", "window")
    return rows.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")

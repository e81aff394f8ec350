"""Katz backoff language model of word pairs, trained and evaluated where the counts are.

Tokens are lower-case words and an end of text; the history of a text's first token is a start mark. Each task cuts its
texts into chunks and sends, to the partition of each history's hash, the chunk's distinct (history, token) pairs and the documents
they stand in. A partition so holds all counts of its histories. It asks the partitions of the token hashes for the tokens'
total counts; with these and the counts of counts it has Good-Turing discounts, backoff weights and the probability of every
token sent to it, and returns one sum for each document. No step collects the model, and no n-gram is dropped. A history with more than a partition's
share of all tokens is dealt by its pairs instead; its sums over them come from all partitions before anything is scored.

p(w|h) = d(c) c(h,w) / c(h) for a seen pair, else a(h) p(w); p(w) = d(c) c(w) / N for a known word, and what the discounts leave
is the probability of the one unknown word. a(h) makes the probabilities after h sum to 1 exactly; an unseen h leaves p(w).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusmill.llm.common import discard, written
from locusmill.llm.words import give_back, mixed, ragged, slices, string_hashes, sums, word_codes

END, START = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
#: Counts up to this are discounted.
LAST = 5
#: The flattest power of a count that numbers of types are taken to follow: at -1 their sum has no bound.
FLATTEST = -1.1
#: Text for one partition of the model.
PART_MB = 16
CHUNK_MB = 8


def held_out(doc_id) -> bool:
    """Whether a document is kept from training: crc32 of its id as text divides by 10; a null id is held out."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def discounts(n: np.ndarray) -> np.ndarray:
    """Factors for counts 1 to LAST from n, the numbers of types seen 1 to LAST + 1 times (n[0] is unused): Good-Turing, as Katz normalises it.

    Copies of documents make raw numbers of types uneven at every size of corpus, so log n is fitted by a line over log count first. The line falls at least as
    count ** ``FLATTEST``, and as count ** -2 where there are fewer than two numbers to fit, so the factors lie in (0, 1) whatever the counts are.
    """
    r = np.arange(1, LAST + 2)
    some = n[1:] > 0
    slope = np.polyfit(np.log(r[some]), np.log(n[1:][some]), 1)[0] if some.sum() > 1 else -2.0
    slope, r = min(slope, FLATTEST), r[:-1]
    tail = (LAST + 1.0) ** (slope + 1)
    return np.concatenate([[0.0], ((1 + 1 / r) ** (slope + 1) - tail) / (1 - tail)])


def _discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(c <= LAST, d[np.minimum(c, LAST)], 1.0) * c


def _types(c: np.ndarray) -> np.ndarray:
    """How many of the counts are 1 to LAST + 1."""
    return np.bincount(c[c <= LAST + 1], minlength=LAST + 2)[: LAST + 2].astype(np.int64)


def _pair_key(h: np.ndarray, t: np.ndarray) -> np.ndarray:
    return mixed(mixed(h) * np.uint64(0x9E3779B97F4A7C15) + t)


def _small(a: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes as the largest needs: the width, then the numbers."""
    width = 1 if not len(a) or a.max() < 1 << 8 else 2 if a.max() < 1 << 16 else 4
    return bytes([width]) + a.astype(f"<u{width}").tobytes()


def _wide(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{b[0]}", offset=1).astype(np.int64)


#: ``runs``: the documents of each pair; ``docs`` and ``times``: for each of those the document and how often it has the pair.
SENT = "part int, chunk long, hists binary, fan binary, names binary, tok binary, runs binary, docs binary, times binary, train binary, ids binary, sizes binary"


def _schema(text: str) -> pa.Schema:
    kind = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(x.split()[0], kind[x.split()[1]]) for x in text.split(", ")])


def _frequent(parts: int, text: str):
    """Of each chunk, how many tokens it has (null name), and the words, and the start, with half a partition's share of them or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, mb=CHUNK_MB, gather=True):
            w = word_codes(b.column(text), lower=True)
            n = np.append(np.bincount(w.codes, minlength=len(w.names)), b.num_rows)
            names = np.append(string_hashes(w.names), START).astype(np.uint64)
            total = int(len(w.codes) + b.num_rows)
            some = 2 * parts * n >= total
            yield pa.RecordBatch.from_arrays([pa.array([None, *names[some].view(np.int64).tolist()], pa.int64()), pa.array([total, *n[some].tolist()], pa.int64())], ["name", "n"])

    return run


def hot_histories(docs: DataFrame, parts: int, text: str) -> np.ndarray:
    """Hashes of the histories with a partition's share of all tokens or more, and of no more than twice as many; ``2 * parts`` rows at most come to the driver.

    What chunks leave out is less than half a share of all tokens. Results don't depend on which histories are dealt by pair.
    """
    found = written(docs.select(text).mapInArrow(_frequent(parts, text), "name long, n long").groupBy("name").agg(F.sum("n").alias("n")), "katz-frequent")
    total = found.filter("name IS NULL").agg(F.sum("n")).first()[0] or 0
    rows = found.filter("name IS NOT NULL").filter(2 * parts * F.col("n") >= total).select("name").collect()
    discard(found)
    return np.sort(np.array([r["name"] for r in rows], np.int64).view(np.uint64))


def _send(parts: int, text: str, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        for b in slices(batches, text, mb=CHUNK_MB, gather=True):
            w = word_codes(b.column(text), lower=True)
            n, docs = b.num_rows, w.doc
            ids = b.column("doc_id").to_pylist()
            names = np.concatenate([string_hashes(w.names), [END, START]]).astype(np.uint64)
            v = len(names)
            # tokens: the words and an end for each text; histories: the token before, or the start
            tok = np.full(len(w.codes) + n, v - 2, np.int32)
            tok[np.arange(len(w.codes)) + docs] = w.codes
            hist = np.concatenate([np.array([v - 1], np.int32), tok[:-1]])
            hist[w.offsets[:-1] + np.arange(n)] = v - 1
            doc = np.repeat(np.arange(n, dtype=np.int32), w.lengths + 1)
            to = (mixed(names) % np.uint64(parts)).astype(np.int64)
            by_part = np.argsort(to, kind="stable")
            rank = np.empty(v, np.int64)
            rank[by_part] = np.arange(v)
            key = rank[hist] * v + tok
            del tok, hist, docs
            order = np.argsort(key, kind="stable")
            key, doc = key[order], doc[order]
            del order
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])).astype(np.int32)
            times = np.diff(np.append(start, np.int32(len(key))))
            key = key[start]
            h, t = by_part[key // v].astype(np.int32), (key % v).astype(np.int32)
            del key
            where = to[h].astype(np.int32)
            salted = np.flatnonzero(np.isin(names, hot)[h])
            where[salted] = mixed(_pair_key(names[h[salted]], names[t[salted]])) % np.uint64(parts)
            moved = np.argsort(where, kind="stable").astype(np.int32)
            h, t, where, start, times = (x[moved] for x in (h, t, where, start, times))
            del moved, salted
            # each pair's documents, ascending, once each
            doc = ragged(doc, start.astype(np.int64), times)
            pair = np.repeat(np.arange(len(h), dtype=np.int32), times)
            first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])])).astype(np.int32)
            runs = np.bincount(pair[first], minlength=len(h)).astype(np.int32)
            each, doc = np.diff(np.append(first, np.int32(len(doc)))), doc[first]
            del pair, first, start, times
            at_doc = np.concatenate([[0], np.cumsum(runs)])
            cuts = np.searchsorted(where, np.arange(parts + 1))
            train = np.packbits([not held_out(i) for i in ids]).tobytes()
            home = chunk % parts
            known = np.array([i or 0 for i in ids], "<i8").tobytes() + np.array([i is None for i in ids], "u1").tobytes()
            rows = []
            for p in range(parts):
                a, z = cuts[p], cuts[p + 1]
                if a == z and p != home:
                    continue
                hs, fan = _runs(h[a:z])
                used, at = np.unique(t[a:z], return_inverse=True)
                span = slice(at_doc[a], at_doc[z])
                rows.append(
                    {
                        "part": p, "chunk": chunk, "hists": names[hs].tobytes(), "fan": _small(fan), "names": names[used].tobytes(), "tok": _small(at), "runs": _small(runs[a:z]), "docs": _small(doc[span]), "times": _small(each[span]), "train": train,
                        "ids": known if p == home else None,
                        "sizes": _small(w.lengths + 1) if p == home else None,
                    }
                )
            chunk += 1
            yield pa.RecordBatch.from_pylist(rows, _schema(SENT))

    return run


def _runs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of runs of equal neighbours, and the runs' lengths."""
    if not len(a):
        return a, a
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    return a[first], np.diff(np.append(first, len(a)))


def _pairs(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """history, token and training count of each pair sent, chunk after chunk."""
    hs, ts, cs = [], [], []
    for r in rows:
        runs, docs, times = _wide(r["runs"]), _wide(r["docs"]), _wide(r["times"])
        train = np.unpackbits(np.frombuffer(r["train"], np.uint8)).astype(np.int64)
        hs.append(np.repeat(np.frombuffer(r["hists"], "<u8"), _wide(r["fan"])))
        ts.append(np.frombuffer(r["names"], "<u8")[_wide(r["tok"])])
        cs.append(sums(train[docs] * times, np.concatenate([[0], np.cumsum(runs)])))
    none = np.zeros(0, np.uint64)
    return np.concatenate([*hs, none]), np.concatenate([*ts, none]), np.concatenate([*cs, np.zeros(0, np.int64)])


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the index of each given key and the sums of counts."""
    one, at = np.unique(keys, return_inverse=True)
    return one, at, np.bincount(at, counts, len(one)).astype(np.int64)


ASKED = "to int, part int, names binary, counts binary, types binary"


def _ask(parts: int):
    """Each partition's tokens and their counts there, to the partitions of the tokens; the types of pairs to partition 0."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, t, c = _pairs([r for b in batches for r in b.to_pylist()])
        pair_types = _types(_summed(_pair_key(h, t), c)[2])
        names, _, count = _summed(t, c)
        to = (mixed(names + START) % np.uint64(parts)).astype(np.int64)
        for p in range(parts):
            mine = to == p
            row = {"to": p, "part": key[0].as_py(), "names": names[mine].tobytes(), "counts": _small(count[mine]), "types": pair_types.tobytes() if p == 0 else None}
            yield pa.RecordBatch.from_pylist([row], _schema(ASKED))
        give_back()

    return run


ANSWERED = "part int, names binary, counts binary, words binary, pairs binary, hist long, total double, mass double, below double"


def _answer(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Total counts to every partition that asked; with them this partition's types, tokens and words, and the types of pairs."""
    rows = [r for b in batches for r in b.to_pylist()]
    asked = [np.frombuffer(r["names"], "<u8") for r in rows]
    names, at, total = _summed(np.concatenate(asked), np.concatenate([_wide(r["counts"]) for r in rows]))
    words = np.concatenate([_types(total), [total.sum(), (total > 0).sum()]]).tobytes()
    pairs = sum((np.frombuffer(r["types"], "<i8") for r in rows if r["types"]), np.zeros(LAST + 2, np.int64)).tobytes()
    ends = np.cumsum([len(a) for a in asked])
    for r, a, z in zip(rows, ends - [len(a) for a in asked], ends):
        yield pa.RecordBatch.from_pylist([{"part": r["part"], "names": r["names"], "counts": _small(total[at[a:z]]), "words": words, "pairs": pairs}], _schema(ANSWERED))


class Model:
    """Probabilities of one partition: its pairs and, for its tokens, the words' total counts."""

    def __init__(self, h: np.ndarray, t: np.ndarray, c: np.ndarray, answers: list[dict]) -> None:
        hot, answers = [r for r in answers if r["hist"] is not None], [r for r in answers if r["hist"] is None]
        words = sum(np.frombuffer(r["words"], "<i8") for r in answers)
        self.n, self.v = int(words[-2]), int(words[-1])
        d1, d2 = discounts(words[:-2]), discounts(sum(np.frombuffer(r["pairs"], "<i8") for r in answers))
        known = np.concatenate([np.frombuffer(r["names"], "<u8") for r in answers])
        order = np.argsort(known)
        self.words, self.counts = known[order], np.concatenate([_wide(r["counts"]) for r in answers])[order]
        # words seen more than LAST times keep their counts, the rest lose the same share each: what is left is the unknown word's
        kept = self.n - sum((1 - d1[k]) * k * words[k] for k in range(1, LAST + 1))
        self.unknown = (self.n - kept) / self.n if self.n else 1.0
        if self.n and self.unknown <= 0:
            self.unknown, self.n_uni = 1 / (self.n + 1), self.n + 1
        else:
            self.n_uni = max(self.n, 1)
        self.d1 = d1
        self.pairs, at, self.pair_counts = _summed(_pair_key(h, t), c)
        first = np.zeros(len(self.pairs), np.int64)
        first[at] = np.arange(len(at))
        ph, pt = h[first], t[first]
        self.hists, of, total = _summed(ph, self.pair_counts)
        total = total.astype(float)
        seen = self.pair_counts > 0
        mass = np.bincount(of, np.where(seen, _discounted(self.pair_counts, d2), 0), len(self.hists))
        below = np.bincount(of, np.where(seen, self.word(self.count(pt)), 0), len(self.hists))
        self.total, self.mass, self.below = total, mass, below
        # of histories that are dealt by pair, the sums of all partitions
        at = np.searchsorted(self.hists, np.array([r["hist"] for r in hot], np.int64).view(np.uint64))
        for r, i in zip(hot, at):
            if i < len(self.hists) and int(self.hists[i].view(np.int64)) == r["hist"]:
                total[i], mass[i], below[i] = r["total"], r["mass"], r["below"]
        full = (total > 0) & (mass >= total - 1e-9)  # no discount: one more token makes room
        size = np.where(full, total + 1, np.maximum(total, 1))
        with np.errstate(all="ignore"):
            back = np.where(total > 0, (1 - mass / size) / np.maximum(1 - below, 1e-300), 1.0)
            self.back, self.log_pair = np.log10(back), np.log10(_discounted(self.pair_counts, d2) / size[of])
        self.of = of

    def count(self, t: np.ndarray) -> np.ndarray:
        return self.counts[np.searchsorted(self.words, t)]

    def word(self, c: np.ndarray) -> np.ndarray:
        """p(w) by a word's count; 0 stands for the unknown word."""
        return np.where(c > 0, _discounted(c, self.d1) / self.n_uni, self.unknown)

    def log_prob(self, h: np.ndarray, t: np.ndarray) -> np.ndarray:
        """log10 p(t|h): the pair if it was seen, else the history's weight and the word, else the unknown word."""
        at = np.searchsorted(self.pairs, _pair_key(h, t))
        return np.where(self.pair_counts[at] > 0, self.log_pair[at], self.back[self.of[at]] + np.log10(self.word(self.count(t))))


PARTIAL = "hist long, total double, mass double, below double"


def _partial(hot: np.ndarray):
    """A partition's sums over the pairs of the histories that are dealt by pair."""

    def run(sent: pa.Table, answers: pa.Table) -> pa.Table:
        h, t, c = _pairs(sent.to_pylist())
        mine = np.isin(h, hot)
        if not mine.any():
            return pa.Table.from_pylist([], _schema(PARTIAL))
        model = Model(h[mine], t[mine], c[mine], answers.to_pylist())
        give_back()
        return pa.table({"hist": model.hists.view(np.int64), "total": model.total.astype(float), "mass": model.mass, "below": model.below})

    return run


SCORED = "chunk long, docs binary, values binary, ids binary, sizes binary, n long"


def _score(sent: pa.Table, answers: pa.Table) -> pa.Table:
    rows, got = sent.to_pylist(), answers.to_pylist()
    out = []
    if rows:
        h, t, c = _pairs(rows)
        model = Model(h, t, c, got)
        at = 0
        for r in rows:
            runs, docs, times = _wide(r["runs"]), _wide(r["docs"]), _wide(r["times"])
            mine = slice(at, at + len(runs))
            at += len(runs)
            count = model.count(t[mine])
            base = np.log10((count + 0.1) / (model.n + 0.1 * (model.v + 1)))
            each = [np.repeat(x, runs) * times for x in (model.log_prob(h[mine], t[mine]), base, count > 0)]
            some, of = np.unique(docs, return_inverse=True)
            values = np.stack([np.bincount(of, x, len(some)) for x in each])
            out.append({"chunk": r["chunk"], "docs": _small(some), "values": values.tobytes(), "ids": r["ids"], "sizes": r["sizes"], "n": model.n})
    del rows, got
    give_back()
    return pa.Table.from_pylist(out, _schema(SCORED))


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _gather(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's documents: the sums of all partitions."""
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["ids"] is None, r["docs"], r["values"]))
    sizes = _wide(rows[0]["sizes"])
    n = len(sizes)
    ids, null = np.frombuffer(rows[0]["ids"][: 8 * n], "<i8"), np.frombuffer(rows[0]["ids"][8 * n :], "u1").astype(bool)
    total = np.zeros((3, n))
    for r in rows:
        docs = _wide(r["docs"])
        total[:, docs] += np.frombuffer(r["values"], "<f8").reshape(3, -1)
    held = [held_out(None if x else i) for i, x in zip(ids.tolist(), null.tolist())]
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64(), mask=null), pa.array(held), pa.array(sizes), pa.array(total[2].astype(np.int64)), pa.array(np.full(n, rows[0]["n"])), pa.array(total[1]), pa.array(total[0])],
        [x.split()[0] for x in RESULT.split(", ")],
    )


def katz_scores(docs: DataFrame, text: str = "text") -> DataFrame:
    """RESULT for each row of ``docs`` (columns ``doc_id``, a long, and ``text``).

    Null and empty texts are an end alone. Repeated rows and ids count and score as rows of their own; equal ids are held out together.
    An empty table gives no rows; without training rows every token has probability 1 as the unknown word (score 0).
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    parts = max(12, int(size / 1e6 / PART_MB) + 1)
    hot = hot_histories(docs, parts, text)
    sent = docs.mapInArrow(_send(parts, text, hot), SENT)
    by_part = sent.groupBy("part")
    answers = by_part.applyInArrow(_ask(parts), ASKED).groupBy("to").applyInArrow(_answer, ANSWERED)
    if len(hot):
        # both sides of the union are dealt by part already, so the answers are moved once for both uses
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        answers = answers.repartition(n, "part")
        partial = by_part.cogroup(answers.groupBy("part")).applyInArrow(_partial(hot), PARTIAL)
        whole = partial.groupBy("hist").agg(*[F.sum(c).alias(c) for c in ("total", "mass", "below")])
        every = whole.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), *[F.lit(None).cast("binary").alias(c) for c in ("names", "counts", "words", "pairs")], "hist", "total", "mass", "below")
        answers = answers.union(every.repartition(n, "part"))
    scored = by_part.cogroup(answers.groupBy("part")).applyInArrow(_score, SCORED)
    return scored.groupBy("chunk").applyInArrow(_gather, RESULT)


def op4_katz_backoff(docs: DataFrame) -> DataFrame:
    """The contract's query."""
    return katz_scores(docs)

"""Jaccard join of word shingle sets by token-combination prefixes.

The document frequency of every shingle is counted first: texts are laid into chunks, each chunk sends its distinct shingles (as buckets of the shingle
hash, of which there are many for every shingle, so their number follows the input) to partitions of bucket ranges, and gets the level of each
bucket back, the logarithm of its frequency. So neither the counts nor the frequent shingles are ever in one place.

Shingles are ordered by level, then by hash. Of two sets that link, each lacks at most ``t`` of the other's shingles, so both prefixes that need ``t + 1`` losses to lose
every signature share one. A shingle of a single chunk and set is no signature, it can't be shared. Rarer shingles are signatures alone. Frequent ones are dealt into subclasses, and pairs of
one subclass are signatures: m shingles of a subclass stand for m - 1 losses, so prefixes are extended. Subclasses depend on the size of a set; a set is indexed for its own
band of sizes and the next, which holds every size it can link with.

Equal sets are one class from the start. In each signature's bucket the members are verified against the most typical one (in slices, for frequent
shingles): first each set against the one it shares most buckets with, then against the others that are still in another component; only where a bucket
then holds several components are the pairs across components verified, again the closest pair of two components first. Copies are never paired, and no pair, bucket or set is capped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from locusmill.llm.common import discard, keyed, written
from locusmill.llm.components import components
from locusmill.llm.words import Words, give_back, gram_hashes, mixed, slices, string_hashes, sums, word_codes

#: Text of a chunk, and for one partition of counts or signatures.
CHUNK_MB, PART_MB = 12, 20
#: Levels from this one on are frequent: sets of more than 2 ** (FREQUENT - 1) documents.
FREQUENT = 6
#: Members of a slice of a bucket of frequent shingles, about.
SLICE = 4096
#: Shingles of a subclass that a prefix of frequent shingles has, about.
PER_SUBCLASS = 4
#: Buckets that a set names, where pairs across components meet.
LEAST = 16
#: Bits of a set's parity map.
PARITY_BITS = 256


def shingle_sets(w: Words, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer words than n, the whole sequence is one shingle."""
    h = string_hashes(w.names)[w.codes]
    grams = gram_hashes(h, n)
    for a, z in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist()):
        if z - a >= n:
            s = np.sort(grams[a : z - n + 1])
            yield s if (s[1:] != s[:-1]).all() else np.unique(s)
        elif z > a:
            yield mixed(gram_hashes(h[a:z], z - a) + np.uint64(z - a))
        else:
            yield np.zeros(0, np.uint64)


def set_keys(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128 bits, as two numbers, that stand for each of the sets laid end to end."""
    total = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(flat ^ x))]) for x in (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))]
    return np.stack([x[ends[1:]] - x[ends[:-1]] for x in total], 1)


def _losses(n: int, percent: int) -> int:
    """Shingles of a set of n that a linked set may lack: it has at least percent of them."""
    return n - -(-n * percent // 100)


def band(n: int, percent: int) -> int:
    """Bands of sizes so wide that sizes which may link are in one band or in neighbouring ones."""
    return int(math.floor(math.log(n) / -math.log(percent / 100) + 1e-9))


def subclasses(b: int, percent: int) -> int:
    """Subclasses of the frequent shingles for a band; 0: all shingles count as rare, for sets of one."""
    size = (percent / 100) ** -b
    return 0 if b == 0 else max(1, int(size * (100 - percent) / 100 / PER_SUBCLASS))


def signatures(s: np.ndarray, level: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set whose shingles have these levels, and the level of each: rare shingles, and pairs of frequent ones with the lesser level of the two."""
    need, b = _losses(len(s), percent) + 1, band(len(s), percent)
    order = np.lexsort((s, level))
    s, level = s[order], level[order]
    rare = len(s) if subclasses(b, percent) == 0 else int(np.searchsorted(level, FREQUENT))
    alone = int(np.searchsorted(level, 0, side="right"))
    sigs, levels = [s[alone : min(rare, need)]], [np.zeros(max(0, min(rare, need) - alone), np.uint8)]
    if rare < need:
        often, much = s[rare:], level[rare:]
        for k in (b, b + 1):
            cls = mixed(often * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(subclasses(k, percent))
            # losses that the shingles up to each stand for: all but the first of each subclass
            first = np.zeros(len(often), bool)
            first[np.unique(cls, return_index=True)[1]] = True
            stop = int(np.searchsorted(np.cumsum(~first), need - rare)) + 1
            by = np.argsort(cls[:stop], kind="stable")
            part, of, at = often[:stop][by], much[:stop][by], cls[:stop][by]
            ends = np.searchsorted(at, at, side="right")
            lengths = ends - np.arange(1, len(at) + 1)
            left = np.repeat(np.arange(len(at)), lengths)
            right = np.arange(len(left)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + left + 1
            sigs.append(mixed(mixed(part[left]) * np.uint64(0x9E3779B97F4A7C15) + part[right] + np.uint64(k)))
            levels.append(np.minimum(of[left], of[right]))
    return np.concatenate(sigs), np.concatenate(levels)


def parity(s: np.ndarray) -> np.ndarray:
    """Each shingle flips one bit: the maps of two sets differ in at most as many bits as the sets in shingles."""
    bit = (mixed(s ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(PARITY_BITS)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=PARITY_BITS) & 1).view(">i8").astype(np.int64)


def packed(a: np.ndarray) -> bytes:
    """Unsigned numbers, byte planes from the lowest to the highest one used, compressed."""
    a = a.astype("<u8")
    width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1
    return bytes([width]) + len(a).to_bytes(4, "little") + pa.compress(a.view("u1").reshape(-1, 8)[:, :width].T.tobytes(), codec="zstd", asbytes=True)


def unpacked(b: bytes) -> np.ndarray:
    width, n = b[0], int.from_bytes(b[1:5], "little")
    raw = np.frombuffer(pa.decompress(b[5:], width * n, codec="zstd", asbytes=True), "u1").reshape(width, n)
    out = np.zeros((n, 8), "u1")
    out[:, :width] = raw.T
    return out.view("<u8").reshape(-1).astype(np.uint64)


def _lay(text: str):
    """Rows into chunks of texts: a number and the rows, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 24
        for b in slices(batches, text, mb=CHUNK_MB, gather=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(b)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["chunk", "rows"])
            chunk += 1

    return run


class Chunk:
    """The sets of a chunk: one for each distinct set (``flat``, ``ends``, ``keys``), and for each row its set (-1: no words)."""

    def __init__(self, blob: bytes, n: int, text: str) -> None:
        rows = pa.ipc.open_stream(blob).read_all().combine_chunks().to_batches()[0]
        self.ids = rows.column("doc_id")
        sets = list(shingle_sets(word_codes(rows.column(text), lower=True), n))
        sizes = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
        keys = set_keys(flat, np.concatenate([[0], np.cumsum(sizes)]))
        seen: dict[tuple[int, int], int] = {}
        firsts = []
        of = np.full(len(sets), -1, np.int64)
        for i, key in enumerate(map(tuple, keys.tolist())):
            if sizes[i]:
                if key not in seen:
                    seen[key] = len(firsts)
                    firsts.append(i)
                of[i] = seen[key]
        self.of, self.sizes, self.keys = of, sizes[firsts], keys[firsts]
        self.flat = flat if len(firsts) == len(sets) else np.concatenate([*(sets[i] for i in firsts), np.zeros(0, np.uint64)])
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        self.n = sizes

    def names(self) -> list[bytes]:
        return [k.tobytes() for k in self.keys.astype(">u8")]


def _part_edges(parts: int, bits: int) -> np.ndarray:
    return np.array([-(-(p << bits) // parts) for p in range(parts)], np.uint64)


def _schema(**types) -> pa.Schema:
    return pa.schema(list(types.items()))


BUCKETS = _schema(part=pa.int32(), chunk=pa.int64(), buckets=pa.binary(), counts=pa.binary())


def _send_buckets(n: int, text: str, parts: int, bits: int):
    """A chunk's distinct buckets, with the number of its sets in each, to the partitions of their ranges. Partitions without one get no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = _part_edges(parts, bits)
        for b in batches:
            for chunk, blob in zip(b.column("chunk").to_pylist(), b.column("rows")):
                at, count = np.unique(Chunk(blob.as_py(), n, text).flat >> np.uint64(64 - bits), return_counts=True)
                cuts = np.append(np.searchsorted(at, edges), len(at))
                some = np.flatnonzero(np.diff(cuts)).tolist()
                spans = [slice(cuts[p], cuts[p + 1]) for p in some]
                steps = [packed(np.diff(at[x], prepend=edges[p])) for p, x in zip(some, spans)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip((some, [chunk] * len(some), steps, [packed(count[x]) for x in spans]), BUCKETS.types)], schema=BUCKETS)
                give_back()

    return run


LEVELS = _schema(chunk=pa.int64(), part=pa.int32(), levels=pa.binary())


def _levels(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The level of each bucket, to each chunk in the order it was sent in: 0 for a single set, k for up to 2 ** k sets."""
    rows = [r for b in batches for r in b.to_pylist()]
    sent = [np.cumsum(unpacked(r["buckets"])) for r in rows]
    sizes = [len(x) for x in sent]
    every = np.concatenate(sent)
    del sent
    one, of = np.unique(every, return_inverse=True)
    del every
    total = np.bincount(of, np.concatenate([unpacked(r["counts"]) for r in rows]).astype(np.float64), len(one))
    level = np.ceil(np.log2(total)).astype(np.uint8)[of]
    del one, of, total
    ends = np.cumsum(sizes)
    out = [pa.compress(x.tobytes(), codec="zstd", asbytes=True) for x in np.split(level, ends[:-1])]
    yield pa.RecordBatch.from_arrays([pa.array([r["chunk"] for r in rows], pa.int64()), pa.array([key[0].as_py()] * len(rows), pa.int32()), pa.array([x.to_bytes(4, "little") + o for x, o in zip(sizes, out)], pa.binary())], schema=LEVELS)
    give_back()


#: Of a chunk: its rows (doc_id, n, cls), its sets that have signatures (the chunk as doc_id, cls, n, shingles, parity), and the signatures for each partition.
SIGNED = _schema(
    kind=pa.int8(), doc_id=pa.int64(), cls=pa.binary(), n=pa.int64(), shingles=pa.list_(pa.int64()), parity=pa.list_(pa.int64()),
    part=pa.int32(), sig=pa.binary(), slice=pa.binary(), who=pa.binary(), keys=pa.binary(), sizes=pa.binary(), common=pa.binary(), maps=pa.binary(),
)
SIGNED_SQL = "kind byte, doc_id long, cls binary, n long, shingles array<long>, parity array<long>, part int, sig binary, slice binary, who binary, keys binary, sizes binary, common binary, maps binary"
ROW, SET, SENT = 0, 1, 2


def _table(kind: int, **columns) -> pa.Table:
    size = len(next(iter(columns.values())))
    given = {"kind": [kind] * size, **columns}
    return pa.Table.from_arrays([pa.array(given[f.name], f.type) if f.name in given else pa.nulls(size, f.type) for f in SIGNED], schema=SIGNED)


def _sign(n: int, percent: int, text: str, parts: int, bits: int):
    def run(laid: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for number, blob in zip(laid.column("chunk").to_pylist(), laid.column("rows")):
            c = Chunk(blob.as_py(), n, text)
            names = c.names()
            out.append(_table(ROW, doc_id=c.ids.to_pylist(), cls=[names[k] if k >= 0 else None for k in c.of.tolist()], n=c.n))
            one, of = np.unique(c.flat >> np.uint64(64 - bits), return_inverse=True)
            got = sorted(answers.select(["part", "levels"]).to_pylist(), key=lambda r: r["part"])
            known = [np.frombuffer(pa.decompress(r["levels"][4:], int.from_bytes(r["levels"][:4], "little"), codec="zstd", asbytes=True), "u1") for r in got]
            level = np.concatenate([*known, np.zeros(0, np.uint8)])[of]
            need = c.sizes - -(-c.sizes * percent // 100) + 1
            signing = np.flatnonzero(sums((level == 0).astype(np.int64), c.ends) < need).tolist()
            spans = [slice(c.ends[k], c.ends[k + 1]) for k in signing]
            signed = [signatures(c.flat[x], level[x], percent) for x in spans]
            maps = [parity(c.flat[x]) for x in spans]
            common = sums(level.astype(np.int64), c.ends) * 256 // np.maximum(c.sizes, 1)
            out.append(_table(SET, doc_id=[number] * len(signing), cls=[names[k] for k in signing], n=c.sizes[signing], shingles=[c.flat[x].view(np.int64) for x in spans], parity=maps))
            sig = np.concatenate([*(x for x, _ in signed), np.zeros(0, np.uint64)])
            high = np.concatenate([*(x for _, x in signed), np.zeros(0, np.uint8)]).astype(np.int64)
            who = np.repeat(np.arange(len(signing)), [len(x) for x, _ in signed])
            # buckets of frequent pairs are cut into slices of their members: 0 is no slice
            slices_of = np.int64(1) << np.maximum(0, high - int(math.log2(SLICE)))
            cut = np.where(slices_of > 1, 1 + (c.keys[signing, 0][who] >> np.uint64(1)).astype(np.int64) % slices_of, 0)
            to = (mixed(sig * np.uint64(0xD1342543DE82EF95) + cut.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((who, to))
            cuts = np.searchsorted(to[order], np.arange(parts + 1))
            sent = []
            for p in range(parts):
                mine = order[cuts[p] : cuts[p + 1]]
                if len(mine):
                    used, at = np.unique(who[mine], return_inverse=True)
                    some = np.array(signing)[used]
                    sent.append((p, sig[mine].tobytes(), packed(cut[mine]), packed(at), b"".join(names[k] for k in some), packed(c.sizes[some]), packed(common[some]), np.array([maps[k] for k in used], "<i8").tobytes()))
            if sent:
                out.append(_table(SENT, **dict(zip(("part", "sig", "slice", "who", "keys", "sizes", "common", "maps"), zip(*sent)))))
        give_back()
        return pa.concat_tables(out) if out else SIGNED.empty_table()

    return run


MEMBERS = "sig long, slice int, cls binary, n long, hub binary, hub_n long, near boolean"


def _buckets(percent: int):
    """The members of the buckets that hold more than one set, and each bucket's hub; of slices all, as others may hold more.

    The hub is the set whose shingles are most common on average: of near copies, one without edits of its own if there is any.
    """

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, base, parts = [r for b in batches for r in b.to_pylist()], 0, []
        for r in rows:
            parts.append((np.frombuffer(r["sig"], "<u8"), unpacked(r["slice"]).astype(np.int64), unpacked(r["who"]).astype(np.int64) + base))
            base += len(r["keys"]) // 16
        names, first, of = np.unique(np.frombuffer(b"".join(r["keys"] for r in rows), ">u8").astype(np.uint64).reshape(-1, 2), axis=0, return_index=True, return_inverse=True)
        size = np.concatenate([unpacked(r["sizes"]) for r in rows]).astype(np.int64)[first]
        common = np.concatenate([unpacked(r["common"]) for r in rows]).astype(np.int64)[first]
        maps = np.frombuffer(b"".join(r["maps"] for r in rows), "<u8").reshape(-1, PARITY_BITS // 64)[first]
        sig, cut, who = (np.concatenate(x) for x in zip(*parts))
        who = of.reshape(-1)[who]
        order = np.lexsort((who, -common[who], cut, sig))
        sig, cut, who = sig[order], cut[order], who[order]
        start = np.concatenate([[True], (sig[1:] != sig[:-1]) | (cut[1:] != cut[:-1])])
        new = start | np.concatenate([[True], who[1:] != who[:-1]])  # copies from several chunks are one member
        sig, cut, who, start = sig[new], cut[new], who[new], start[new]
        at = np.flatnonzero(start)
        many = np.diff(np.append(at, len(sig)))
        hub = np.repeat(who[at], many)
        keep = np.flatnonzero((np.repeat(many, many) > 1) | (cut > 0))
        blobs = pa.array([x.tobytes() for x in names.astype(">u8")], pa.binary())
        for x in np.array_split(keep, len(keep) // 100_000 + 1):
            h, w = hub[x], who[x]
            near = np.bitwise_count(maps[h] ^ maps[w]).sum(1, dtype=np.int64) * (100 + percent) <= (100 - percent) * (size[h] + size[w])
            near &= percent * np.maximum(size[h], size[w]) <= 100 * np.minimum(size[h], size[w])
            columns = [pa.array(sig[x].view(np.int64)), pa.array(cut[x], pa.int32()), blobs.take(pa.array(w)), pa.array(size[w]), blobs.take(pa.array(h)), pa.array(size[h]), pa.array(near)]
            yield pa.RecordBatch.from_arrays(columns, ["sig", "slice", "cls", "n", "hub", "hub_n", "near"])
        give_back()

    return run


def _bits_apart(a: str, b: str) -> Column:
    """Bits in which the parity maps of two sides differ."""
    return sum((F.bit_count(F.get(f"{a}parity", i).bitwiseXOR(F.get(f"{b}parity", i))) for i in range(1, PARITY_BITS // 64)), F.bit_count(F.get(f"{a}parity", 0).bitwiseXOR(F.get(f"{b}parity", 0))))


def _may_link(a: str, b: str, percent: int) -> Column:
    """Sizes and parity maps of two sides allow a link: linked sets differ in at most (1 - t) / (1 + t) of the sum of their sizes."""
    n = [F.col(f"{x}n") for x in (a, b)]
    return (percent * F.greatest(*n) <= 100 * F.least(*n)) & ((100 + percent) * _bits_apart(a, b) <= (100 - percent) * (n[0] + n[1]))


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose whole sets link, as a table. Of a class that stands in several chunks one set is taken, chosen before sets are moved."""
    classes = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    one = written(sets.select("cls", "chunk").join(classes, "cls", "left_semi").groupBy("cls").agg(F.min("chunk").alias("chunk")), "jaccard-wanted")
    some = sets.join(one, ["cls", "chunk"]).select("cls", "shingles")
    met = pairs.join(some.select(F.col("cls").alias("a"), F.col("shingles").alias("_a")), "a").join(some.select(F.col("cls").alias("b"), F.col("shingles").alias("_b")), "b")
    both = F.size(F.array_intersect("_a", "_b"))
    out = written(met.filter(100 * both >= percent * (F.size("_a") + F.size("_b") - both)).select("a", "b"), "jaccard-links")
    discard(one)
    return out


def _grown(comps: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components with the pairs that link besides."""
    if pairs.isEmpty():
        return comps
    return components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).union(_linked(pairs, sets, percent)), "a", "b")


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """The pairs (a, b) that no component holds both of."""
    of = lambda k: comps.select(F.col("node").alias(k), F.col("component").alias(f"_{k}"))
    met = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return met.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of each row of ``docs`` (columns ``doc_id`` and ``text``).

    Texts link when 100 * intersection >= percent * union of their sets of n-word shingles (A-Z lower-cased);
    component_id is the least doc_id that links reach. Null and empty texts link with nothing, not even each other. Repeated rows and ids
    stay rows of their own; a null doc_id is never a component's id unless there is no other. An empty table gives no rows; other columns don't count.
    """
    if not 50 <= percent < 100:
        raise ValueError("percent: 50 to 99")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(12, int(size / 1e6 / PART_MB) + 1)
    bits = max(20, (int(size) * 8).bit_length())  # some fifty buckets for every shingle
    laid_type = StructType([StructField("chunk", LongType()), StructField("rows", BinaryType())])
    laid = written(docs.mapInArrow(_lay("text"), laid_type), "jaccard-chunks")
    sent = laid.mapInArrow(_send_buckets(n, "text", parts, bits), "part int, chunk long, buckets binary, counts binary")
    levels = sent.groupBy("part").applyInArrow(_levels, "chunk long, part int, levels binary")
    signed = laid.groupBy("chunk").cogroup(levels.groupBy("chunk")).applyInArrow(_sign(n, percent, "text", parts, bits), SIGNED_SQL)
    signed = written(signed, "jaccard-signatures")
    discard(laid)
    rows, sets = signed.filter(F.col("kind") == ROW).select("doc_id", "cls", "n"), signed.filter(F.col("kind") == SET).select(F.col("doc_id").alias("chunk"), "cls", "n", "shingles", "parity")
    messages = signed.filter(F.col("kind") == SENT).select("part", "sig", "slice", "who", "keys", "sizes", "common", "maps")
    members = written(messages.groupBy("part").applyInArrow(_buckets(percent), MEMBERS), "jaccard-members")

    # the hubs of a bucket's slices are members of the bucket of the least hub
    hubs = members.filter("slice > 0").select("sig", "hub", "hub_n").distinct()
    tops = hubs.groupBy("sig").agg(F.min(F.struct("hub", "hub_n")).alias("t"), F.max("hub").alias("_top")).filter("t.hub <> _top")
    tied = hubs.join(tops, "sig").filter("hub <> t.hub").filter(percent * F.greatest("hub_n", "t.hub_n") <= 100 * F.least("hub_n", "t.hub_n"))
    stars = members.filter("near AND cls <> hub").select(F.col("hub").alias("a"), F.col("cls").alias("b")).union(tied.select(F.col("t.hub").alias("a"), F.col("hub").alias("b")))
    tried = written(stars.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")), "jaccard-stars")
    best = written(tried.groupBy("b").agg(F.max(F.struct("shared", "a"))["a"].alias("a")).select("a", "b"), "jaccard-best")
    comps = components(_linked(best, sets, percent), "a", "b")
    rest = written(_apart(tried.select("a", "b").join(best, ["a", "b"], "left_anti"), comps), "jaccard-rest")
    comps = _grown(comps, rest, sets, percent)
    # buckets that hold several components still
    held = members.select("sig", "cls", "n").distinct().join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("component", "cls")).drop("component")
    held = written(held, "jaccard-held")
    # buckets of the same members give the same pairs: one of them will do
    same = [F.count(F.lit(1)).alias("_k"), *[F.sum(F.xxhash64("cls", F.lit(i)).cast("decimal(38,0)")).alias(f"_s{i}") for i in range(2)]]
    open_ = held.groupBy("sig").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b"), *same).filter("_a <> _b").groupBy("_k", "_s0", "_s1").agg(F.min("sig").alias("sig")).select("sig")
    several = written(held.join(open_, "sig"), "jaccard-open")
    # a pair meets in the least bucket that both name; if they name none, in each that they share
    named = several.groupBy("cls").agg(F.slice(F.array_sort(F.collect_list("sig")), 1, LEAST).alias("least"))
    of_cls = sets.select("cls", "parity").join(named, "cls").dropDuplicates(["cls"])
    x, y = (several.join(of_cls, "cls").select(F.col("sig"), *[F.col(c).alias(f"{k}{c}") for c in ("cls", "n", "comp", "parity", "least")]) for k in "xy")
    here = F.coalesce(F.array_min(F.array_intersect("xleast", "yleast")), F.col("sig")) == F.col("sig")
    met = x.join(y, "sig").filter((F.col("xcomp") < F.col("ycomp")) & here & _may_link("x", "y", percent))
    across = met.groupBy(F.least("xcls", "ycls").alias("a"), F.greatest("xcls", "ycls").alias("b"), "xcomp", "ycomp").agg(F.min(_bits_apart("x", "y") / (F.col("xn") + F.col("yn"))).alias("far"), F.count(F.lit(1)).alias("times"))
    across = written(across.join(tried, ["a", "b"], "left_anti"), "jaccard-across")
    # of two components first the pair that shares most, then the others of those still apart
    closest = written(across.groupBy("xcomp", "ycomp").agg(F.min(F.struct("far", "a", "b")).alias("m")).select("m.a", "m.b"), "jaccard-closest")
    comps = _grown(comps, closest, sets, percent)
    others = written(_apart(across.select("a", "b").join(closest, ["a", "b"], "left_anti"), comps), "jaccard-others")
    comps = _grown(comps, others, sets, percent)
    discard(members, tried, best, rest, held, several, across, closest, others)

    placed = rows.join(comps.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("component", "cls"))
    least = placed.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "comp", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """The rows of ``docs`` but for near duplicates: of each component, the row with the least doc_id stays.

    Texts without words are never duplicates. Of repeated or null ids, the first row in the order of text and other columns stays.
    """
    rows = keyed(docs, "doc_id", "_key")
    found = near_duplicates(rows.select(F.col("_key").alias("doc_id"), F.col(text).alias("text")), n, percent)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_key"))
    return rows.join(gone, "_key", "left_anti").select(docs.columns)


def op6_combination_prefixes(docs: DataFrame) -> DataFrame:
    """The contract's query."""
    return near_duplicates(docs, n=3, percent=90)

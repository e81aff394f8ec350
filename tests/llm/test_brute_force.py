"""Whole queries against brute force: verdicts over links, log-likelihood ratios, and the stages of the pipeline on the smallest tables."""

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from locusmill.llm import quality, secret_index, url_graph  # noqa: E402
from locusmill.llm.words import gram_hashes  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_verdicts_over_links(spark):
    rng = random.Random(12)
    hosts = [f"h{k}.org" for k in range(14)] + ["www.example.com", "example.com", "a.net", "b.a.net", "shop.com"]
    pages, links = [], collections.Counter()
    for k in range(120):
        h = rng.choice(hosts)
        out = [rng.choice(hosts) for _ in range(rng.randint(0, 4))]
        path = rng.choice(["/en/x", "/es/y", "/", "/fr/z?q=1"])
        pages.append((k, f"https://{h.upper() if k % 5 == 0 else h}{path}", "".join(f"<a HREF='//{o}/p'>" for o in out)))
        links.update((h, o) for o in out if o != h)
    rules = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]

    def ruled(h, path):
        fits = [(len(r), v) for r, v in rules for host, _, rest in [r.partition("/")] if (h == host or h.endswith("." + host)) and path.startswith("/" + rest)]
        return max(fits)[1] if fits else None

    parsed = {k: (re.search("//([^/]*)", u)[1].lower(), re.search(r"//[^/]*([^?]*)", u)[1]) for k, u, _ in pages}
    seeds = {v: collections.Counter(h for h, p in parsed.values() if ruled(h, p) == v) for v in ("allow", "block")}

    def scores(seed, weight):  # iterated to a fixed point
        at = {h: 0.0 for h in hosts}
        for _ in range(400):
            new = {h: 0.15 * seed[h] / sum(seed.values()) for h in hosts}
            for a in hosts:
                total = sum(weight(a, b) for b in hosts)
                for b in hosts:
                    if total:
                        new[b] += 0.85 * at[a] * weight(a, b) / total
            at = new
        return at

    trust, distrust = scores(seeds["allow"], lambda a, b: links[a, b]), scores(seeds["block"], lambda a, b: links[b, a])
    want = {k: ruled(h, p) or ("block" if distrust[h] > trust[h] * (1 + 1e-6) else "allow") for k, (h, p) in parsed.items()}
    got = {r["page_id"]: r for r in url_graph.op2_trust_spread(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    assert {k: r["verdict"] for k, r in got.items()} == want
    assert all(got[k]["trust"] == pytest.approx(trust[h], rel=1e-6) and got[k]["distrust"] == pytest.approx(distrust[h], rel=1e-6) for k, (h, _) in parsed.items())
    open_ = [k for k, (h, p) in parsed.items() if ruled(h, p) is None]
    assert {want[k] for k in open_} == {"allow", "block"}


def bucket(gram):
    return int(gram_hashes(np.frombuffer(gram, np.uint8).astype(np.uint64), 3)[0] % np.uint64(quality.BUCKETS))


def grams(text):
    return collections.Counter(bucket(b[i : i + 3]) for w in WORD.findall(text or "") for b in [b" " + w.encode() + b" "] for i in range(len(b) - 2))


def test_ratios_and_kept(spark):
    rng = random.Random(3)
    good, bad = ["alpha", "beta", "gamma", "delta", "straße"], ["zzxq", "qqjx", "xxkk", "jjqz"]
    text = lambda words, n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    rows = [(k, text(good, rng.randint(30, 120))) for k in range(60)] + [(100 + k, text(bad, rng.randint(55, 90))) for k in range(20)] + [(200, None), (201, ""), (202, text(good + bad, 100))]
    labels = [(k, 1, 0) for k in range(25)] + [(30, 1, 1)] + [(100 + k, 0, 0) for k in range(6)] + [(55, 0, 0)]
    got = {r["doc_id"]: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    each = {d: grams(t) for d, t in rows}
    raw = sum(each.values(), collections.Counter())
    target = sum((each[k] for k in range(25)), collections.Counter())
    n = quality.BUCKETS
    share = {b: (raw[b] + 1) / (sum(raw.values()) + n) for b in raw}

    def llr(own, off=collections.Counter()):
        total = sum(target.values()) - sum(off.values())
        return sum(c * math.log((target[b] - off[b] + n * share[b]) / (total + n) / share[b]) for b, c in own.items()) / sum(own.values())

    passes = {d: not r["base_failed"] for d, r in got.items()}
    assert all(got[d]["llr"] == pytest.approx(llr(each[d]), abs=1e-6) for d, t in rows if each[d])
    of_good = sorted(round(llr(each[k], each[k]), 3) for k in range(25) if passes[k])
    low = of_good[math.floor(0.01 * len(of_good))]
    of_bad = [x for x in (round(llr(each[k]), 3) for k in (*range(100, 106), 55) if passes[k]) if x < low]
    threshold = (low + max(of_bad)) / 2
    assert {d: r["kept"] for d, r in got.items()} == {d: passes[d] and got[d]["llr"] >= threshold for d in got}
    assert not any(got[100 + k]["kept"] for k in range(20)) and all(got[k]["kept"] for k in range(60) if passes[k])


def test_all_labels_count(spark):
    """More labelled documents than a target of 20,000 held: all good ones are in the target, all good and bad ones place the threshold."""
    good, bad, rest = 20_700, 20_300, 900
    word = lambda kind, k: f"{kind}{(k * k * 7 + k) % 9973}x"
    kinds = [" ".join(word("good" if j < 9 else "bad", 1000 * j + k) for k in range(55)) for j in range(12)]  # nine of good documents, three of others
    of = lambda i: i % 9 if i < good else 9 + i % 2 if i < good + bad else 11
    kind = F.expr(f"CASE WHEN id < {good} THEN id % 9 WHEN id < {good + bad} THEN 9 + id % 2 ELSE 11 END")
    docs = spark.range(good + bad + rest).select(F.col("id").alias("doc_id"), F.array(*map(F.lit, kinds))[kind].alias("text"))
    labels = spark.range(good + bad).select(F.col("id").alias("doc_id"), F.expr(f"IF(id < {good}, 1, 0)").alias("quality"), F.lit(0).alias("toxic"))
    labelled = {r["good"]: r["n"] for r in quality.labelled_ids(labels.unionAll(labels.limit(10))).groupBy("good").agg(F.count("*").alias("n")).collect()}
    assert labelled == {True: good, False: bad}
    each, times = [grams(t) for t in kinds], collections.Counter(map(of, range(good + bad + rest)))
    raw, target = (sum((collections.Counter({b: c * times[k] for b, c in each[k].items()}) for k in ks), collections.Counter()) for ks in (range(12), range(9)))
    n = quality.BUCKETS
    share = {b: (raw[b] + 1) / (sum(raw.values()) + n) for b in raw}

    def llr(own, off=collections.Counter()):
        total = sum(target.values()) - sum(off.values())
        return sum(c * math.log((target[b] - off[b] + n * share[b]) / (total + n) / share[b]) for b, c in own.items()) / sum(own.values())

    of_good = sorted(round(llr(each[k], each[k]), 3) for k in range(9) for _ in range(times[k]))
    low = of_good[math.floor(0.01 * len(of_good))]
    threshold = (low + max(x for x in (round(llr(each[k]), 3) for k in (9, 10)) if x < low)) / 2
    got = quality.quality_rules(docs, labels).groupBy("text").agg(F.count("*").alias("n"), F.min("llr").alias("low"), F.max("llr").alias("high"), F.min("kept").alias("kept"), F.max("kept").alias("any"), F.max("base_failed").alias("failed")).collect()
    assert {r["text"]: r["n"] for r in got} == {kinds[k]: times[k] for k in range(12)} and not any(r["failed"] for r in got)
    for r in got:
        want = llr(each[kinds.index(r["text"])])
        assert r["low"] == pytest.approx(want, abs=1e-8) and r["high"] == pytest.approx(want, abs=1e-8)
        assert r["kept"] == r["any"] == (want >= threshold)


def test_packed_grams():
    rng = np.random.default_rng(4)
    rows = [np.zeros(0, np.int64), np.arange(quality.BUCKETS), np.array([quality.BUCKETS - 1]), np.sort(rng.choice(quality.BUCKETS, 700, replace=False))]
    counts = [rng.integers(1, 2**32, len(at)) for at in rows]
    b = quality.pa.RecordBatch.from_pydict({"n_buckets": [len(at) for at in rows], "grams": [quality._packed(at, n) for at, n in zip(rows, counts)]})
    assert [(at.tolist(), n.tolist()) for at, n in quality._unpacked(b)] == [(at.tolist(), n.tolist()) for at, n in zip(rows, counts)]


D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{D}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, D)
        rows = [r.asDict() for r in got.collect()]
        docs = spark.createDataFrame([tuple(r[c] for c in got.columns) for r in rows], got.schema)
        out.append(rows)
    return [[r.asDict() for r in spark.read.parquet(f"{D}/documents.parquet").collect()], *out]


def test_stage_of_near_duplicates(stages):
    docs = sorted(stages[1], key=lambda r: r["doc_id"])
    lower = str.maketrans({c: c + 32 for c in range(65, 91)})
    sets = []
    for r in docs:
        w = WORD.findall((r["text"] or "").translate(lower))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert sorted(r["doc_id"] for r in stages[2]) == [r["doc_id"] for i, r in enumerate(docs) if root(i) == i]
    assert {r["doc_id"]: r["text"] for r in stages[2]}.items() <= {r["doc_id"]: r["text"] for r in docs}.items()


def test_stage_of_secrets(stages):
    rules = (*secret_index.BASE, *secret_index.ADDED)

    def masked(text):
        spans = []
        for rank, r in enumerate(rules):
            for m in re.finditer(r.pattern, text):
                if len(m[r.value_group or 0]) >= r.min_chars:
                    spans.append((m.start(), rank, m.end(), r.kind))
        out, at = [], 0
        for s, _, e, kind in sorted(spans):
            if s >= at:
                out.append(text[at:s] + f"[{kind.upper()}]")
            at = max(at, e)
        return "".join(out) + text[at:]

    before = {r["doc_id"]: r["text"] for r in stages[2]}
    assert {r["doc_id"]: r["text"] for r in stages[3]} == {d: t and masked(t) for d, t in before.items()}
    assert any(before[r["doc_id"]] != r["text"] for r in stages[3])


def test_stage_of_the_mix(stages):
    words = {r["doc_id"]: WORD.findall(r["text"] or "") for r in stages[3]}
    source, size, taken = {r["doc_id"]: r["source"] for r in stages[3]}, collections.Counter(), collections.Counter()
    for d, w in words.items():
        size[source[d]] += len(w)
    per_doc = collections.Counter()
    for r in stages[4]:
        w = WORD.findall(r["text"])
        assert w and r["source"] == source[r["doc_id"]] and " ".join(w) in " ".join(words[r["doc_id"]]) and r["n_chars"] == len(r["text"])
        taken[r["source"]] += len(w)
        per_doc[r["doc_id"]] += len(w)
    assert all(n <= 3 * len(words[d]) for d, n in per_doc.items())
    # weights 5, 2, 1 by source, at most three times a source's size, the excess dealt to the others
    order = sorted(size, key=lambda s: (s is None, s))
    weight, left, target, free = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, sum(size.values()), {}, set(order)
    while True:
        each = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if each[s] > 3 * size[s] + 1e-9}
        if not over:
            target |= each
            break
        for s in over:
            target[s] = 3 * size[s]
            left -= target[s]
        free -= over
    assert all(abs(taken[s] - target[s]) <= 1 + 1e-9 for s in order if size[s])


def test_stage_of_packing(stages):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.no_truncation()
    want = collections.Counter((r["doc_id"], len(tok.encode(r["text"], add_special_tokens=False).ids) + 1) for r in stages[4])
    pieces, sequences = stages[5], collections.defaultdict(list)
    got = collections.Counter()
    for r in pieces:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        if r["start"] == 0:
            got[r["doc_id"], r["doc_tokens"]] += 1
    assert got == want and sum(r["length"] for r in pieces) == sum(n * k for (_, n), k in want.items())
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0
    # the rest is cut at powers of two, each once
    rest = [n for n in (sum(n for _, n in h) for h in sequences.values()) if n < 4096]
    assert len(rest) == len(set(rest)) <= 12


def test_hot_histories_are_dealt_by_pair(spark, monkeypatch):
    from locusmill.llm import katz

    rng = random.Random(6)
    vocab = [f"w{k}" for k in range(4000)]
    text = lambda n: " ".join(x for _ in range(n) for x in ("hot", rng.choice(vocab)))
    rows = [(k, text(rng.randint(20, 300))) for k in range(200)] + [(900, "na " * 3000), (901, None), (902, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    hot = katz.hot_histories(docs, 12, "text")
    assert 1 <= len(hot) <= 24
    names = katz.string_hashes(katz.pa.array(["hot", "na", "w1"]))
    assert list(np.isin(names.astype(np.uint64), hot)) == [True, True, False]

    def spread(hot):
        sent = docs.mapInArrow(katz._send(12, "text", hot), katz.SENT).groupBy("part").agg(F.sum(F.octet_length("docs")).alias("n"))
        return sorted(r["n"] for r in sent.collect())

    salted, whole = spread(hot), spread(hot[:0])
    assert whole[-1] > 5 * whole[len(whole) // 2] and salted[-1] < 2 * salted[len(salted) // 2]
    key = lambda r: (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 7), round(r["score"], 7))
    dealt = sorted(map(key, katz.op4_katz_backoff(docs).collect()))
    monkeypatch.setattr(katz, "hot_histories", lambda docs, parts, text: np.zeros(0, np.uint64))
    assert sorted(map(key, katz.op4_katz_backoff(docs).collect())) == dealt

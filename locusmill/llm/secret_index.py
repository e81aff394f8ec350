"""Secret scanning through a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived (``regex_trigrams``): an OR of ANDs that every match satisfies. The index holds postings
(trigram, document) for every trigram that some query names, over every document. Intersecting the postings
of a query gives the documents that may match; only those are run against the rule's expression. A rule without a
mandatory trigram has no query and scans every document.
"""

from __future__ import annotations

import re
import re._parser as parser
from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``pattern``: what both Java and Python read alike.

    ``value_group`` and ``min_chars``: a match whose group is shorter is dropped after matching.
    ``mask``: whether ``mask_secrets`` hides the match.
    """

    kind: str
    pattern: str
    value_group: int = 0
    min_chars: int = 0
    mask: bool = True


# The three base kinds.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16),
)
#: Kinds that the operator adds. ``[0-9a-f]{16,}`` and ``AKIA[A-Z0-9]{14,}`` above match what longest runs
#: of at least that length match.
ADDED = (
    Rule("bearer", r"(?i)\bbearer\x20+[A-Za-z0-9+/_.~=-]{16,}"),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"\bxox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"\bAIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN[A-Z\x20]*\x20PRIVATE\x20KEY-----"),
    Rule("url_password", r"(?i)\b[a-z][a-z0-9+.-]*://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/@]{6,}@"),
)


SPANS = "array<struct<start:int,end:int,kind:string>>"


Query = frozenset[frozenset[str]]
#: Every text satisfies it.
ANY_TEXT: Query = frozenset({frozenset()})
#: Strings and characters of a class that are spelled out, strings' length, clauses of a query: beyond these less is asked for, never more.
STRINGS, LETTERS, LENGTH, CLAUSES = 64, 16, 24, 64


def _or(a: Query, b: Query) -> Query:
    every = a | b
    least = frozenset(c for c in every if not any(d < c for d in every))
    return least if len(least) <= CLAUSES else ANY_TEXT


def _and(a: Query, b: Query) -> Query:
    both: Query = frozenset(c | d for c in a for d in b) if len(a) * len(b) <= CLAUSES * CLAUSES else a
    least = frozenset(c for c in both if not any(d < c for d in both))
    return least if len(least) <= CLAUSES else a


def _holds(strings: frozenset[str]) -> Query:
    """One of the strings is in the text."""
    if any(len(x) < 3 for x in strings):
        return ANY_TEXT
    out: Query = frozenset()
    for x in sorted(strings):
        out = _or(out, frozenset({frozenset(x[i : i + 3] for i in range(len(x) - 2))}))
    return out


def _letters(items) -> frozenset[str] | None:
    """The characters of a class in lower case; None: not spelled out."""
    out: set[str] = set()
    for op, x in items:
        if op == parser.LITERAL:
            codes = [x]
        elif op == parser.RANGE and x[1] - x[0] < 4 * LETTERS:
            codes = range(x[0], x[1] + 1)
        else:
            return None
        if any(c > 127 for c in codes):
            return None  # lower case isn't the same everywhere
        out |= {chr(c).lower() for c in codes}
    return frozenset(out) if len(out) <= LETTERS else None


def _strings(op, x) -> tuple[frozenset[str] | None, Query]:
    """Of a node: the strings that it matches, if they are few, else None; and a query that holds for what it matches."""
    if op in (parser.LITERAL, parser.IN):
        got = _letters([(op, x)] if op == parser.LITERAL else x)
        return got, ANY_TEXT
    if op in (parser.AT, parser.ASSERT, parser.ASSERT_NOT):
        return frozenset({""}), ANY_TEXT
    if op == parser.SUBPATTERN:
        return _sequence(x[-1])
    if op == parser.BRANCH:
        parts = [_sequence(b) for b in x[1]]
        if all(e is not None for e, _ in parts) and len(one := frozenset().union(*(e for e, _ in parts))) <= STRINGS:
            return one, _holds(one)
        query: Query = frozenset()
        for _, q in parts:
            query = _or(query, q)
        return None, query
    if op in (parser.MAX_REPEAT, parser.MIN_REPEAT, parser.POSSESSIVE_REPEAT):
        low, high, body = x
        exact, query = _sequence(body)
        if exact is not None and high == 1:
            return exact | {""}, ANY_TEXT
        return None, query if low else ANY_TEXT
    return None, ANY_TEXT


def _sequence(nodes) -> tuple[frozenset[str] | None, Query]:
    now: frozenset[str] = frozenset({""})
    query, whole = ANY_TEXT, True
    for op, x in nodes:
        repeat = op in (parser.MAX_REPEAT, parser.MIN_REPEAT, parser.POSSESSIVE_REPEAT)
        times = x[0] if repeat and x[0] == x[1] else 1 if repeat and x[0] > 0 else 0
        exact, more = _sequence(x[2]) if times else _strings(op, x)
        for _ in range(max(1, times)):
            joined = None if exact is None else frozenset(a + b for a in now for b in exact) if len(now) * len(exact) <= STRINGS else None
            if joined is not None and max(map(len, joined)) <= LENGTH:
                now = joined
                continue
            query, whole = _and(_and(query, _holds(now)), more), False
            now = frozenset({""}) if exact is None else exact
            if exact is None:
                break
        if times and x[0] != x[1]:  # more of the same may follow
            query, whole, now = _and(query, _holds(now)), False, frozenset({""})
    query = _and(query, _holds(now))
    return (now if whole else None), query


def regex_trigrams(pattern: str) -> Query:
    """An OR of ANDs of trigrams that every match of a regular expression holds in lower case, read from the parsed expression.

    Literals, small classes, alternations and repeats are multiplied out to strings as far as they are few; what can't be spelled out asks for nothing.
    """
    return _sequence(parser.parse(pattern))[1]


def trigram_query(rule: Rule) -> list[frozenset[str]]:
    """The rule's OR of ANDs of trigrams; empty if no trigram is mandatory."""
    query = regex_trigrams(rule.pattern)
    return [] if frozenset() in query else sorted(query, key=sorted)


def postings(docs: DataFrame, key: str, text: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(trigram, key) for each trigram of the rules' queries that occurs in a text, ASCII letters in either case."""
    grams = sorted(set(chain.from_iterable(chain.from_iterable(trigram_query(r) for r in rules))))
    low = docs.select(F.col(key).alias("key"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("low"))
    # one pass over a text, whatever the number of rules: the named trigrams at each of its places, by their first letters
    found = F.array_distinct(F.regexp_extract_all("low", F.lit(_any_of(grams)), F.lit(1)))
    return low.select(F.explode(found).alias("trigram"), "key")


def _any_of(grams: list[str]) -> str:
    """A pattern that matches before each of the trigrams, group 1 being it."""
    by_first: dict[str, list[str]] = {}
    for g in grams:
        by_first.setdefault(g[0], []).append(g[1:])
    heads = "".join(re.escape(a) for a in by_first)
    tails = "|".join(re.escape(a) + ("(?:" + "|".join(map(re.escape, z)) + ")") for a, z in by_first.items())
    return f"(?=[{heads}])(?=({tails}))" if grams else r"(?!)()"


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, kinds): the rules of which a query holds, by intersecting each query's postings."""
    clauses = [(k, n, g) for k, n, g in ((r.kind, n, g) for r in rules for n, g in enumerate(trigram_query(r)))]
    by_gram: dict[str, list[int]] = {}
    for i, (_, _, g) in enumerate(clauses):
        for t in g:
            by_gram.setdefault(t, []).append(i)
    clause_of = F.create_map(*chain.from_iterable((F.lit(t), F.array(*map(F.lit, v))) for t, v in sorted(by_gram.items())))
    need = F.array(*[F.lit(len(g)) for _, _, g in clauses])
    kind = F.array(*[F.lit(k) for k, _, _ in clauses])
    met = (
        index.distinct()
        .select("key", F.explode(F.element_at(clause_of, F.col("trigram"))).alias("clause"))
        .groupBy("key", "clause")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") == F.get(need, "clause"))
    )
    return met.groupBy("key").agg(F.collect_set(F.get(kind, "clause")).alias("kinds"))


def _spans(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches as (kind, start, end) in code points.

    The pieces between the matches and the matches themselves alternate, so a match starts after the lengths of all before it. Lengths are
    summed up in blocks of matches and then over blocks, as each step along an array copies what it has so far.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.value_group)) if rule.value_group else found
    chars = lambda a: F.transform(a, F.char_length)
    gaps = F.slice(chars(F.split(text, rule.pattern, -1)), F.lit(1), F.size(found))
    parts = F.zip_with(gaps, F.arrays_zip(chars(found).alias("n"), chars(value).alias("v")), lambda g, x: F.struct(g.alias("gap"), x["n"].alias("n"), x["v"].alias("v")))
    state = f"struct<at:int,out:{SPANS}>"

    def step(a: Column, x: Column) -> Column:
        start = a["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["n"]).alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct((start + x["n"]).alias("at"), F.when(x["v"] >= rule.min_chars, F.array_append(a["out"], span)).otherwise(a["out"]).alias("out")).cast(state)

    first = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out")).cast(state)
    walked = _let(F.transform(_blocks(parts), lambda b: F.aggregate(b, first, step)), lambda own: F.flatten(F.zip_with(own, _before(F.transform(own, lambda b: b["at"])), _moved)))
    return F.when(F.size(found) > 0, walked)


#: Elements of an array that are walked at once.
BLOCK = 256


def _let(value: Column, f) -> Column:
    """``f`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), f), 0)


def _blocks(array: Column) -> Column:
    return _let(array, lambda whole: F.transform(F.sequence(F.lit(0), F.greatest(F.size(whole) - 1, F.lit(0)), F.lit(BLOCK)), lambda i: F.slice(whole, i + 1, F.lit(BLOCK))))


def _before(sizes: Column, join=lambda a, b: a + b) -> Column:
    """For each element the sum (``join``) of those before it."""
    state = "struct<at:int,out:array<int>>"
    step = lambda a, x: F.struct(join(a["at"], x).alias("at"), F.array_append(a["out"], a["at"]).alias("out")).cast(state)
    return F.aggregate(sizes, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")).cast(state), step, lambda a: a["out"])


def _moved(block: Column, by: Column) -> Column:
    return F.transform(block["out"], lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["kind"].alias("kind")))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = (*BASE, *ADDED)) -> DataFrame:
    """Add ``spans``, an array of (start, end, kind) over the whole text by start, then by the rules' order.

    Null and empty texts have none. A null key is a key of its own; rows that share a key share the index's
    candidates, each row is verified on its own text. Every row of ``docs`` is kept, an empty table stays empty, and a column ``spans`` is replaced.
    """
    docs = docs.drop("spans")
    if any(trigram_query(r) for r in rules):
        hits = candidates(postings(docs, key, text, rules), rules).withColumnRenamed("key", "_key").withColumnRenamed("kinds", "_kinds")
        joined = docs.join(hits, docs[key].eqNullSafe(hits["_key"]), "left").drop("_key")
    else:
        joined = docs.withColumn("_kinds", F.array().cast("array<string>"))
    none = F.array().cast(SPANS)
    by_rule = [
        F.when(F.array_contains("_kinds", r.kind), _spans(F.col(text), r)).otherwise(none) if trigram_query(r) else _spans(F.col(text), r)
        for r in rules
    ]
    rank = F.create_map(*chain.from_iterable((F.lit(r.kind), F.lit(i)) for i, r in enumerate(rules)))
    ranked = [F.transform(F.coalesce(x, none), lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["end"], s["kind"])) for x in by_rule]
    return joined.withColumn("spans", F.transform(F.array_sort(F.concat(*ranked)), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).drop("_kinds")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = (*BASE, *ADDED)) -> DataFrame:
    """Replace each secret by ``[KIND]``, keeping every document; spans that overlap are hidden as one, under the first one's kind."""
    found = find_secrets(docs, key, text, rules)
    step = "struct<at:int,out:string>"
    body = F.col(text)

    last = lambda b: F.coalesce(F.array_max(F.transform(b, lambda s: s["end"])), F.lit(0))

    def walked(spans: Column, first: Column) -> Column:
        """The part of the text that a block of spans hides; it goes on where the blocks before it have come. Places are looked up in this part, as a text is read from its start for each."""

        def within(part: Column) -> Column:
            def walk(a: Column, s: Column) -> Column:
                shown = F.concat(a["out"], F.substring(part, a["at"] - first + 1, s["start"] - a["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
                return F.when(s["start"] >= a["at"], F.struct(s["end"].alias("at"), shown.alias("out"))).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))).cast(step)

            return F.aggregate(spans, F.struct(first.alias("at"), F.lit("").alias("out")).cast(step), walk, lambda a: a["out"])

        return _let(F.substring(body, first + 1, F.greatest(last(spans) - first, F.lit(0))), within)

    shown = _let(_blocks(F.col("spans")), lambda bs: F.array_join(F.zip_with(bs, _before(F.transform(bs, last), F.greatest), walked), ""))
    end = F.array_max(F.transform("spans", lambda s: s["end"]))
    hidden = F.concat(shown, F.substring(body, end + 1, F.char_length(body)))
    return found.withColumn(text, F.when(F.size("spans") > 0, hidden).otherwise(body)).drop("spans")


def op10_trigram_index(docs: DataFrame) -> DataFrame:
    """The contract's query: counts and digest of the base kinds, and all spans."""
    found = find_secrets(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in BASE]))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))

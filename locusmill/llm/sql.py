"""SQL that gives the same rows as the queries that SQL can express: the manifest and the vector codes."""

from __future__ import annotations

from locusmill.llm.merkle import ARITY, LOWER, UPPER

#: Levels of a source's tree and of the tree over the sources that the statement spells out: up to 16^6 documents of each of up to 16^4 sources.
LEAF_LEVELS, SOURCE_LEVELS = 6, 4


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    byte = "list_reduce([xor(a, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
    codes = f"[CAST(ascii(c) AS BIGINT) FOR c IN string_split({text}, '')]"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda a, b: {byte}), 4294967295)"


def _field(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


def manifest() -> str:
    leaf = lambda text: f"sha256({' || '.join(_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    ctes = [
        f"docs AS (SELECT *, {leaf('text')} AS leaf, CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {leaf(f'''translate(text, '{UPPER}', '{LOWER}')''')} END AS changed FROM documents)",
        "leaves AS (SELECT row_number() OVER () AS rid, doc_id, source, leaf, changed, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM docs)",
        "s0 AS (SELECT source, i, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM leaves)",
    ]
    up = lambda of, key: f"SELECT {key}i, h, count(*) OVER ({'PARTITION BY source' if key else ''}) AS n FROM (SELECT {key}i // {ARITY} AS i, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {of} GROUP BY {key}i // {ARITY})"
    ctes += [f"s{k + 1} AS ({up(f's{k}', 'source, ')})" for k in range(LEAF_LEVELS)]
    ctes += [f"g0 AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, h, count(*) OVER () AS n FROM s{LEAF_LEVELS})"]
    ctes += [f"g{k + 1} AS ({up(f'g{k}', '')})" for k in range(SOURCE_LEVELS)]
    # a leaf's runs, level by level: s0 to the subroot, g0 to the root
    ctes += [f"placed AS (SELECT l.*, r.h AS subroot, g.i AS gi FROM leaves l JOIN s{LEAF_LEVELS} r ON l.source IS NOT DISTINCT FROM r.source JOIN g0 g ON l.source IS NOT DISTINCT FROM g.source)"]
    runs = [f"SELECT rid, {k} AS level, b.i, b.h, b.i = p.i // {ARITY**k} AS own FROM placed p JOIN s{k} b ON p.source IS NOT DISTINCT FROM b.source AND b.i // {ARITY} = p.i // {ARITY ** (k + 1)} AND b.n > 1" for k in range(LEAF_LEVELS)]
    runs += [f"SELECT rid, {LEAF_LEVELS + k}, b.i, b.h, b.i = gi // {ARITY**k} FROM placed p JOIN g{k} b ON b.i // {ARITY} = gi // {ARITY ** (k + 1)} AND b.n > 1" for k in range(SOURCE_LEVELS)]
    ctes += [f"runs AS ({' UNION ALL '.join(runs)})", "proofs AS (SELECT rid, sha256(string_agg(h, '' ORDER BY level, i)) AS proof FROM runs WHERE NOT own GROUP BY rid)", "f0 AS (SELECT rid, coalesce(changed, leaf) AS f FROM leaves)"]
    for k in range(LEAF_LEVELS + SOURCE_LEVELS):
        ctes.append(f"f{k + 1} AS (SELECT rid, CASE WHEN count(h) = 0 THEN any_value(f) ELSE sha256(string_agg(CASE WHEN own THEN f ELSE h END, '' ORDER BY i)) END AS f FROM f{k} LEFT JOIN (SELECT * FROM runs WHERE level = {k}) r USING (rid) GROUP BY rid)")
    last, root = f"f{LEAF_LEVELS + SOURCE_LEVELS}", f"(SELECT h FROM g{SOURCE_LEVELS})"
    return (
        f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, {root} AS root, coalesce(proof, sha256('')) AS proof_sha256, f AS folded_root, f = {root} AS verified "
        f"FROM placed LEFT JOIN proofs USING (rid) JOIN {last} USING (rid)"
    )


def codes(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Product codes of ``embeddings`` whose vectors are all of one width that ``parts`` divides."""
    ctes = [
        f"kept AS (SELECT row_number() OVER () AS rid, vec_id, label, [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)",
        f"cut AS (SELECT rid, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS a FROM kept, range({parts}) r(part))",
        f"first AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS entry FROM kept QUALIFY entry < {entries})",
        "b0 AS (SELECT part, entry, a FROM first JOIN cut USING (rid))",
    ]
    double = lambda x: f"CAST({x} AS DOUBLE[])"
    far = f"CAST(list_inner_product({double('c.a')}, {double('c.a')}) - 2 * list_inner_product({double('c.a')}, {double('b.a')}) + list_inner_product({double('b.a')}, {double('b.a')}) AS BIGINT)"
    for k in range(rounds + 1):
        ctes.append(f"n{k} AS (SELECT rid, part, min({far} * {entries} + b.entry) AS m FROM cut c JOIN b{k} b USING (part) GROUP BY rid, part)")
        if k < rounds:
            ctes.append(f"p{k} AS (SELECT part, m % {entries} AS entry, pos, CAST(sum(a[pos]) AS BIGINT) AS s, count(*) AS n FROM (SELECT part, m, a, unnest(range(1, len(a) + 1)) AS pos FROM n{k} JOIN cut USING (rid, part)) GROUP BY ALL)")
            ctes.append(f"u{k} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS a FROM p{k} GROUP BY part, entry)")
            ctes.append(f"b{k + 1} AS (SELECT part, entry, coalesce(u.a, b.a) AS a FROM b{k} b LEFT JOIN u{k} u USING (part, entry))")
    ctes.append(f"coded AS (SELECT rid, string_agg(printf('%02x', CAST(m % {entries} AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error FROM n{rounds} GROUP BY rid)")
    digest = f"(SELECT sha256(string_agg(array_to_string(a, ','), ',' ORDER BY part, entry)) FROM b{rounds})"
    return f"WITH {', '.join(ctes)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, {digest} AS codebooks_sha256 FROM kept JOIN coded USING (rid)"

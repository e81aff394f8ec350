"""Main text, manifest and vector codes against brute force, with nulls, empty and long values, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusmill.llm import main_text, merkle, vector_codes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- merkle -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_fill_the_tree_and_halve_it(levels):
    at = [merkle.slots(levels, d, np.arange(16**d)) for d in range(levels)]
    assert sorted(np.concatenate(at).tolist()) == list(range(merkle.nodes_of(levels)))
    assert at[0][0] == 0
    if levels > 1:  # each bottom tree is one stretch, one after the other, behind the top tree
        top, size = levels // 2, merkle.nodes_of(levels - levels // 2)
        for k in range(16**top):
            own = np.concatenate([at[d][k * 16 ** (d - top) : (k + 1) * 16 ** (d - top)] for d in range(top, levels)])
            assert own.min() == merkle.nodes_of(top) + k * size and own.max() == own.min() + size - 1


def test_addresses_of_two_levels_by_hand():
    # five levels: a top of two (17 nodes), then 256 bottoms of three levels, each a top of one and 16 bottoms of two
    assert merkle.slots(5, 1, np.array([0, 15])).tolist() == [1, 16]
    assert merkle.slots(5, 2, np.array([0, 1])).tolist() == [17, 17 + 273]
    assert merkle.slots(5, 3, np.array([0, 1, 16])).tolist() == [18, 18 + 17, 17 + 273 + 1]
    assert merkle.slots(5, 4, np.array([0, 15, 16])).tolist() == [19, 34, 18 + 17 + 1]


def tree_levels(level):
    out = [level]
    while len(level) > 1:
        level = [h("".join(level[k : k + 16])) for k in range(0, len(level), 16)]
        out.append(level)
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = list(range(i // 16 * 16, min(i // 16 * 16 + 16, len(level))))
        out.append((level[run[0] : i], level[i + 1 : run[-1] + 1]))
        i //= 16
    return out


def brute_manifest(rows):
    def leaf(r, text):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))

    by = defaultdict(list)
    for r in rows:
        changed = text = r[1]
        if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
            changed = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        by[r[3]].append((r[0], leaf(r, text), leaf(r, changed)))
    trees = {}
    for s, leaves in by.items():
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree_levels([x[1] for x in leaves])
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    top = tree_levels([trees[s][-1][0] for s in order])
    root = top[-1][0]
    out = []
    for k, s in enumerate(order):
        for i, (doc, own, changed) in enumerate(by[s]):
            way = siblings(trees[s], i) + siblings(top, k)
            folded = changed
            for a, z in way:
                folded = h("".join(a) + folded + "".join(z))
            out.append((doc, own, trees[s][-1][0], root, h("".join("".join(a + z) for a, z in way)), folded, folded == root))
    return sorted(map(repr, out))


def manifest_rows():
    rng = random.Random(3)
    rows = [(i, f"Some TEXT {rng.random()}", "en", rng.choice(["a", "b", "é", ""]), i) for i in range(700)]
    rows += [(i, "X" * (i % 7), None, "big", None) for i in range(1000, 5200)]  # four levels
    rows += [(7, None, "en", None, 3), (8, "", "de", None, None), (9, "UPPER " * 3000, None, None, 1), (None, None, None, None, None), (None, "T", None, "a", 1), rows[5], rows[5], (99999, "lone Leaf", "en", "one", 2)]
    rows += [(i, "many SOURCES", "en", f"s{i % 40}", i) for i in range(6000, 6100)]
    return rows


def test_manifest(spark):
    rows = manifest_rows()
    df = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("x") for c in ("cell", "at", "key", "root")}).repartition(3)
    want = brute_manifest(rows)
    got = [tuple(r) for r in merkle.op12_merkle_manifest(df).collect()]
    assert sorted(map(repr, got)) == want
    assert {r[0] for r in got if not r[-1]} and all(r[-1] for r in got if r[0] is None)
    # several layers of blocks
    assert sorted(repr(tuple(r)) for r in merkle.op12_merkle_manifest(df, height=1).collect()) == want
    assert merkle.op12_merkle_manifest(spark.createDataFrame([], DOCS)).count() == 0


# --- vector codes -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("high", [1 << 10, 1 << 26, 1 << 29])
def test_products_are_exact(high):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-high, high, (50, 24)), rng.integers(-high, high, (9, 24))
    a[0], b[0] = -high, high - 1
    want = a.astype(object) @ b.astype(object).T
    assert (vector_codes.exact_products(a, b).astype(object) == want).all()
    bits = vector_codes.limb_bits(24)
    assert 24 * (2**bits - 1) ** 2 < 2**53
    assert len(vector_codes.limbs(a, bits)) == (1 if high < 1 << bits else 2)
    assert (sum(x.astype(np.int64) << (bits * k) for k, x in enumerate(vector_codes.limbs(a, bits))) == a).all()


def test_distances_past_53_bits_and_ties():
    big = np.array([[1 << 29, 0], [(1 << 29) + 1, 0]])
    best, far = vector_codes.nearest(big, np.array([[-(1 << 29), 1], [-(1 << 29), 0], [-(1 << 29), 0]]))
    assert best.tolist() == [1, 1] and far.tolist() == [1 << 60, (1 << 60) + (1 << 31 >> 1) * 2 + 1]
    with pytest.raises(ArithmeticError):
        vector_codes.nearest(np.array([[1 << 31, 0]]), np.array([[0, 0]]))


def brute_codes(rows, entries=256, rounds=4):
    kept = [(i, [int(np.floor(np.float64(x) * 1024)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 4)
    kept = [(i, v + [0] * (4 * width - len(v)), label) for i, v, label in kept]
    part = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[part(v, p) for _, v, _ in first] for p in range(4)]

    def near(v, book):
        return min((sum((x - y) ** 2 for x, y in zip(v, b)), k) for k, b in enumerate(book))

    for _ in range(rounds):
        for p in range(4):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[near(part(v, p), books[p])[1]].append(part(v, p))
            for k, vs in groups.items():
                books[p][k] = [sum(x) // len(vs) for x in zip(*vs)]
    digest = h(",".join(str(x) for b in books for e in b for x in e))
    out, sums = [], defaultdict(int)
    for i, v, label in kept:
        found = [near(part(v, p), books[p]) for p in range(4)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
        sums[label] += out[-1][2]
    return sorted(repr((i, c, e, sums[label], digest)) for i, c, e, label in out)


VECTORS = "vec_id long, embedding array<float>, label int"


def vectors(n, width=8):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.normal(size=width).astype(np.float32)], int(i) % 3) for i in rng.permutation(n)]
    same = rows[0][1]
    rows += [(n, None, 1), (n + 1, [None] + same[1:], 1), (n + 2, [float("nan")] + same[1:], 1), (n + 3, [float("-inf")] + same[1:], 1), (n + 4, [1e300 * 1e10] + same[1:], None)]
    return rows + [(None, same, None), (None, same, 2), rows[3], rows[3], (n + 5, [-0.0] * width, None), (n + 6, [1000.5] * width, 0)]


@pytest.mark.parametrize("n, entries", [(400, 256), (60, 256), (120, 5)])
def test_codes(spark, n, entries):
    rows = vectors(n)
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("x") for c in ("key", "vector", "code", "error")}).repartition(3)
    got = vector_codes.compress(df, "vec_id", "embedding", "label", entries=entries)
    assert sorted(repr(tuple(r)[:1] + tuple(r)[2:]) for r in got.collect()) == brute_codes(rows, entries)


def test_codes_of_odd_tables(spark):
    rows = [(1, [0.5, 1.5, 2.5], 0), (2, [1.0], None), (3, [], 0), (1, [0.5, 1.5, 2.5], 0)]
    assert sorted(repr(tuple(r)) for r in vector_codes.op13_limb_codes(spark.createDataFrame(rows, VECTORS)).collect()) == brute_codes(rows)
    got = vector_codes.op13_limb_codes(spark.createDataFrame([(1, [], 0), (2, None, 0)], VECTORS)).collect()
    assert [(r["vec_id"], r["code"], r["error"]) for r in got] == [(1, "00000000", 0)]
    assert vector_codes.op13_limb_codes(spark.createDataFrame([], VECTORS)).count() == 0
    assert vector_codes.op13_limb_codes(spark.createDataFrame([(1, None, 0)], VECTORS)).count() == 0


# --- main text ----------------------------------------------------------------------------------------------------


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))


def page(blocks, comments, notice, style):
    """An article in one of three styles of site, and its text."""
    def title_and(x):
        return f"<h1>{x[0]}</h1>" + "".join(f"<p>{b}</p>" for b in x[1:])
    menu = "<nav><ul><li><a href='/a'>Home</a><li><a href=/b>About us</a></ul></nav>"
    said = "".join(f"<p>{c}</p>" for c in comments)
    if style == 0:
        body = f"<header><h1>Site name</h1></header>{menu}<div class=cookie-notice>{notice}</div><main><article class='post post-17'>{title_and(blocks)}<div class='share-links'><a href=x>share</a></div></article><section id=comments>{said}</section></main><aside>{notice}</aside><footer>&copy; x</footer>"
    elif style == 1:
        body = f"<div id='top'><a href=1>one</a> <a href=2>two</a></div><div class='wrap'><div class='content'>{title_and(blocks)}<form><p>{notice}</p><input></form></div><div class='sidebar'><p>{notice}</p></div><ol class='commentlist'><li>{said}</ol></div>"
    else:
        body = f"<table><tr><td><a href=1>Menu entry</a><td>{title_and(blocks)}</table><!-- <p>hidden</p> --><div style='display: none'>{notice}</div>"
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>if (a<b) w('</p><p>no')</script></head><body>{body}</body></html>", "\n".join(blocks)


def test_main_text_follows_the_host(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for k in range(60):
        blocks = [words(rng, 4), *[words(rng, rng.randint(20, 60)) for _ in range(rng.randint(2, 6))]]
        if k % 10 == 9:
            blocks = ["Hi", "Short."]  # shorter than all that stands beside it
        html, text = page(blocks, [words(rng, 30) for _ in range(3)], words(rng, 25), k % 3)
        rows.append((k, f"http://Host{k % 3}.example/{k}", html))
        want[k] = text
    got = {r["page_id"]: r["text"] for r in main_text.op11_host_paths(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    assert got == want


def test_consensus_outvotes_a_page(spark):
    site = lambda a, b: f"<body><div class=c{len(a) % 3}><p>{a}</p></div><div class=x><p>{b}</p></div></body>"
    rows = [(k, "http://h.example/", f"<body><div class=k9><p>{'word ' * 30}{k}</p></div><div class=x><p>{'other ' * 3}</p></div></body>") for k in range(5)]
    rows.append((9, "http://h.example/z?q", f"<body><div class=k8><p>tiny</p></div><div class=x><p>{'longer ' * 30}</p></div></body>"))
    rows.append((10, None, rows[-1][2]))
    rows.append((11, "http://other.example", rows[-1][2]))
    rows.append((12, "http://h.example", site("none of the host's paths", "b").replace("class=x", "class=y")))
    got = {r["page_id"]: r["text"] for r in main_text.op11_host_paths(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "tiny" and got[10] == got[11] == ("longer " * 30).strip() and got[12] == "none of the host's paths" and got[0] == "word " * 30 + "0"


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""), ("", ""), ("   \n", ""), ("plain &amp; text", "plain & text"), ("a < b &lt; c", "a < b < c"), ("<p>one<p>two<br>three", "one\ntwo three"),
        ("<article><p>x&nbsp;&nbsp;y\n\t z&#233;&notanentity;</p></article>", "x y zé¬anentity;"), ("<p>cut &am</p><p>cut &amp</p>", "cut &am\ncut &"), ("<p>a<b>b</b>c <i>d</i></p>", "abc d"), ("<p>x<a hre", "x"),
        ("<p>x<!-- never ends <p>y", "x"), ("<p>x<script>var t='</p>'", "x"), ("<p title='it>s'>q</p>", "q"), ("<p title=it's>q</p>", "q"), ("<!--><p>x</p>-->", "x\n-->"), ("<p>x</div></span></p>y", "x\ny"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"), ("<article><header><h2>T</h2><p>by me</p></header><p>" + "w " * 50 + "</p><footer>f</footer></article>", "T\n" + ("w " * 50).strip()),
        ("<body class='has-sidebar comments-open'><p>kept</p><p class='Ad'>gone</p><div class=adBox>gone</div><p class=address>kept too</p>", "kept\nkept too"), ("<div hidden>a</div><div aria-hidden=true>b</div><p data-id=ad>c</p>", "c"), ("<TEXTAREA>a</TEXTAREA><P>b</P>", "b"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<p>" + "long words " * 100_000, ("long words " * 100_000).strip()),
    ],
)
def test_markup(html, text):
    page = main_text.parse(html or "")
    assert main_text.text_of(page, main_text.best(page)) == text


def test_main_text_of_odd_tables(spark):
    schema = "page_id long, url string, html string, text string, host string, row string, paths int"
    rows = [(None, None, None, "t", "h", "r", 1), (1, "no scheme", "<p>a</p>", "t", "h", "r", 1), (1, "no scheme", "<p>a</p>", "t", "h", "r", 1), (2, "http://", "", None, None, None, None)]
    got = main_text.extract_main_text(spark.createDataFrame(rows, schema))
    assert got.columns == ["page_id", "url", "host", "row", "paths", "text", "n_chars"]
    assert sorted((str(r["page_id"]), r["host"], r["text"], r["n_chars"]) for r in got.collect()) == sorted([("None", "h", "", 0), ("1", "h", "a", 1), ("1", "h", "a", 1), ("2", None, "", 0)], key=str)
    assert main_text.op11_host_paths(spark.createDataFrame([], schema)).count() == 0


def test_paths_are_counted(spark):
    html = lambda k: f"<body><div class='post p{k}'><p>{'w ' * 20}</p></div></body>"
    pages = spark.createDataFrame([("h", html(k)) for k in range(7)] + [("h", "<body><main><p>x y z</p></main></body>")], "host string, html string").repartition(3)
    assert [tuple(r) for r in main_text.host_paths(pages).collect()] == [("h", ["body>div.p0.post", "body>main"])]

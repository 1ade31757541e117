"""The training-data operators against brute-force versions on small tables with awkward rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from estatelens.llm import (common, decontaminate, html_text, licenses, linededup, mixing, quality, simhash, suffixdedup,
                            tokenfiles, toxicity)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, copies string, __key string"


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def prose(rng, n):
    vocabulary = ["the", "of", "Über", "été", "on", "tion", "x", "42", "mit", "license", "ça,", "end.\n", "a-b", "ing"]
    return " ".join(rng.choice(vocabulary) + rng.choice(["", "", str(rng.randint(0, 30))]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = [prose(rng, n) for n in (5, 30, 60, 200, 200)]
    texts = [None, "", " \n\t ", "\n\n", "a", *base, base[3], base[3] + " more", "Header line\n" + base[1], "header LINE \n" + base[2],
             base[4].replace("of", "off", 1), "b " * 4000, "x" * 700, "Released under the MIT License.", base[3]]
    out = [(i, t, "en", None if i % 5 == 0 else f"s{i % 3}", len(t or ""), 7, "c", "k") for i, t in enumerate(texts)]
    return [*out, out[6], (None, base[2], None, "s1", 3, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def as_set(df, *columns):
    return collections.Counter(tuple(r) for r in df.select(*columns).collect())


# ---------------------------------------------------------------------------- op 1

def brute_substrings(rows, n):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = collections.Counter(b[p:p + n] for _, b in texts for p in range(len(b) - n + 1))
    out = collections.Counter()
    for name, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            if seen[b[p:p + n]] > 1:
                gone[p:p + n] = b"\1" * n
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        left = bytes(x for x, g in zip(b, gone) if not g)
        out[(name, len(b), sum(gone), spans, hashlib.sha256(left).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot", [4096, 1])
@pytest.mark.parametrize("length,gram", [(200, 64), (24, 8)])
def test_suffix_dedup(docs, rows, length, gram, hot):
    got = suffixdedup.dedup_substrings(docs, length=length, gram=gram, hot=hot, with_text=True)
    assert as_set(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_substrings(rows, length)
    for r in got.collect():
        assert hashlib.sha256(r.text).hexdigest() == r.kept_sha256


def test_suffix_dedup_pieces(spark, monkeypatch):
    """Windows of one document handled in many pieces give the same bytes."""
    rng = random.Random(1)
    part = prose(rng, 80)
    rows = [(1, prose(rng, 300) + part + prose(rng, 100)), (2, part[5:] + "z" * 300), (3, prose(rng, 10))]
    buf, off = np.frombuffer("".join(r[1] for r in rows).encode(), np.uint8), [0]
    for r in rows:
        off.append(off[-1] + len(r[1].encode()))
    whole = suffixdedup.Places(buf, np.array(off), 50, 20)
    monkeypatch.setattr(suffixdedup, "PIECE", 97)
    cut = suffixdedup.Places(buf, np.array(off), 50, 20)
    spread = lambda p: sorted((int(w), int(a)) for a, f, t in zip(p.at, p.first, p.last) for w in range(f, t + 1))
    assert spread(whole) == spread(cut)


# ---------------------------------------------------------------------------- op 2

def test_license_scan(docs, rows):
    got = as_set(licenses.license_table(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    want = collections.Counter()
    for r in rows:
        w = WORD.findall(lowered(r[1]))
        at = [(j, label) for p, label in licenses.PHRASES for j in range(len(w)) if w[j:j + len(p.split())] == p.split()]
        want[(r[0], len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at})))] += 1
    assert got == want


def test_license_spans(spark):
    text = ("one two three " * 20 + licenses.TEMPLATES[1][1].replace("free of charge", "free of any charge")
            + " four five " + licenses.TEMPLATES[7][1])
    cases = [(1, text), (2, "nothing of the kind here"), (3, "Licensed under CC BY-NC 4.0."), (4, licenses.TEMPLATES[1][1][:60])]
    found = {r.doc_id: r for r in licenses.license_table(spark.createDataFrame(cases, "doc_id long, text string")).collect()}
    assert found[1].labels == "bsd,mit" and 0.7 < found[1].score <= 1
    assert found[2].labels == "" and found[2].score == 0
    assert found[3].labels == "cc-by-nc"
    assert found[4].labels == ""
    _, spans = licenses.scan(spark.createDataFrame(cases[:1], "doc_id long, text string"))
    assert min(r.first_word for r in spans.collect()) == 60


# ---------------------------------------------------------------------------- op 3

@pytest.mark.parametrize("text, labels", [
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "cc-by-nd"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "cc-by-nc-sa"),
    ("Licensed under CC BY 4.0, CC BY 4.0, CC BY 4.0", "cc-by"),
    ("Licensed under CC BY 4.0. " * 5, "cc-by"),
    ("Licensed under CC BY 4.0. Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
    ("You can redistribute it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
     "gpl,lgpl"),                                                   # the base phrase stands in it
    ("", ""), (None, "")])
def test_license_labels(spark, text, labels):
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [r.labels for r in licenses.license_table(docs).collect()] == [labels] * 2


def test_stages_keep_columns_of_any_name(spark):
    """Extra columns called like the operators' own come out with their values."""
    columns = "doc_id long, text string, __key string, __row string, __decon_hits string, root long, c0 string"
    rows = [(1, "alpha beta gamma delta epsilon", "a", "b", "c", 7, "d"), (2, "alpha beta gamma delta epsilon", "e", "f", "g", 8, "h"),
            (3, None, None, "i", None, None, "j"), (None, "one two three four five six seven", "k", "l", "m", 9, "n")]
    docs = spark.createDataFrame(rows, columns)
    got = simhash.keep_representatives(docs)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} == {rows[0], rows[2], rows[3]}
    items = spark.createDataFrame([(1, "five six seven")], "item_id long, text string")
    got = decontaminate.remove_spans(docs, items)
    assert got.columns == docs.columns
    assert {tuple(r) for r in got.collect()} == {*rows[:3], (None, "one two three four ", *rows[3][2:])}


ITEMS = [(1, "the of Über été on tion x 42 mit license the end x on of"), (2, "Short item, here!"), (3, ""), (4, None),
         (5, "été on tion x 42 mit license the end x on of the"), (10, "short"), (1, "a second row of item one " * 3)]


def brute_hits(text, items, window=10):
    w, hit, names = WORD.findall(lowered(text)), set(), set()
    for name, item in items:
        v = WORD.findall(lowered(item))
        n = min(window, len(v))
        runs = {tuple(v[j:j + n]) for j in range(len(v) - n + 1)} if n else set()
        for j in range(len(w) - n + 1) if n else ():
            if tuple(w[j:j + n]) in runs:
                hit.update(range(j, j + n))
                names.add(str(name))
    return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("keep", [lambda i: True, lambda i: i not in (2, 10), lambda i: i in (3, 4)])
@pytest.mark.parametrize("block_bytes", [4 << 20, 40])
def test_decontaminate(spark, rows, keep, block_bytes, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    items = [i for i in ITEMS if keep(i[0])]
    texts = [*rows, (100, "zz " + ITEMS[0][1].upper() + " zz short item here"), (101, ITEMS[4][1] * 3),
             (102, "été on tion x 42 mit license the end, yy short"), (103, "here short item short")]
    docs = spark.createDataFrame([r[:2] for r in texts], "doc_id long, text string")
    got = decontaminate.hit_table(docs, spark.createDataFrame(items, "item_id long, text string"))
    want = collections.Counter((r[0], *brute_hits(r[1], items)) for r in texts)
    assert as_set(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want


words_ = st.lists(st.sampled_from("abc"), max_size=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(words_, max_size=4), words_)
def test_automaton(items, doc):
    items = [(str(i), " ".join(x)) for i, x in enumerate(items)]
    scanner = decontaminate.Scanner(items, 4)
    hit, names = set(), set()
    if scanner.automaton:
        for a, b, found in scanner.automaton.stream([w.encode() for w in doc]):
            hit.update(range(a, b))
            names |= found
    want = brute_hits(" ".join(doc), items, 4)
    assert (len(hit), len(names)) == want[1:3]


def test_remove_spans(spark, docs):
    items = spark.createDataFrame([(1, "un deux trois quatre cinq six sept huit neuf dix")], "item_id long, text string")
    passage = "Un, deux trois\nquatre cinq six sept huit neuf dix"
    rows = [(1, "é " * 30 + passage + " tail", 5), (2, passage, 5), (3, "clean text", 5), (4, None, 5)]
    got = decontaminate.remove_spans(spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), items).collect()
    assert {(r.doc_id, r.text) for r in got} == {(1, "é " * 30 + " tail"), (3, "clean text"), (4, None)}
    assert {r.n_chars for r in got} == {65, 5}


# ---------------------------------------------------------------------------- op 4

def brute_print(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints, bits=4):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(ids)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            root[find(a)] = find(b)
    low = {}
    for i, name in enumerate(ids):
        if name is not None:
            low[find(i)] = min(low.get(find(i), name), name)
    return [low.get(find(i)) for i in range(len(ids))]


def test_simhash_rows(docs, rows):
    prints = [brute_print(r[1]) for r in rows]
    want = collections.Counter(zip([r[0] for r in rows], [p - (1 << 64) if p >> 63 else p for p in prints],
                                   brute_components([r[0] for r in rows], prints)))
    assert as_set(simhash.near_duplicates(docs), "doc_id", "fp", "component_id") == want


def test_golay_links(spark):
    """Links of random fingerprints with planted neighbours connect what all pairs connect."""
    rng = random.Random(7)
    prints = []
    for _ in range(60):
        p = rng.getrandbits(64)
        prints.append(p)
        for _ in range(rng.randint(0, 4)):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                p ^= 1 << b
            prints.append(p)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for bits in (0, 2, 4):
        pairs = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"), bits)
        roots = {r.node: r.root for r in common.components(pairs).collect()}
        want = brute_components(signed, prints, bits)
        assert [roots.get(s, s) for s in signed] == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(5, 5), (300, 200), (200, 250)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[i] == 100 for i in range(101, 160))
    assert got[300] == got[250] == 200
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ----------------------------------------------------------------------- op 5, op 9

def test_representatives_by_group(spark):
    """Groups without ids, and groups that share an id, keep a row each."""
    text = lambda i: " ".join(hashlib.md5(f"{i} {j}".encode()).hexdigest() for j in range(40))
    rows = [*((None, text(i), "x") for i in range(20)), (None, text(0), "y"), (7, text(30), "x"), (7, text(31), "x"), (7, text(31), "a"),
            (8, text(31), "x"), (None, text(30), "x"), (None, None, "x"), (9, "", "x")]
    got = simhash.keep_representatives(spark.createDataFrame(rows, "doc_id long, text string, more string"))
    assert as_set(got, "doc_id", "text") == collections.Counter(
        [*((None, text(i)) for i in range(20)), (7, text(30)), (7, text(31)), (9, "")])


def by_duckdb(sql, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r[0], r[1], r[3]) for r in rows])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return names, collections.Counter(result.fetchall())


@pytest.mark.parametrize("max_docs,left", [(100, 0.1), (1, 0.9)])
def test_quality_rules(docs, rows, max_docs, left):
    sql = quality.SQL.replace(f"> {quality.MAX_DOCS}", f"> {max_docs}").replace(f"{quality.MIN_LEFT} *", f"{left} *")
    names, want = by_duckdb(sql, rows)
    got = quality.judged(docs.select("doc_id", "source", "text"), max_docs=max_docs, min_left=left)
    assert as_set(got, *names) == want


def test_quality_keeps_rows(docs, rows):
    got = quality.kept_documents(docs)
    assert got.columns == docs.columns
    kept = quality.judged(docs.select("doc_id", "source", "text")).where("kept")
    assert as_set(got, "doc_id", "source") == as_set(kept, "doc_id", "source")


def test_quality_shared_longest_line(spark):
    """Many short pages whose longest line is the shared one; copies of one page count once."""
    legal = " ".join(f"legal{i}" for i in range(60))
    pages = [(i, "h", f"title of page {i} x\n{legal}") for i in range(150)]
    copies = [(1000 + i, "g", f"one title\n{legal}") for i in range(150)]
    df = spark.createDataFrame([*pages, *copies, copies[0]], "doc_id long, source string, text string")
    assert sorted(r.doc_id for r in quality.kept_documents(df).collect()) == [1000, *[x[0] for x in copies]]
    found = quality.judged(df.selectExpr("*", "'mine' AS __key", "'x' AS kept")).collect()
    assert sorted(r.doc_id for r in found if r.kept) == [1000, *[x[0] for x in copies]]
    assert {(r.source, r.n_removed_lines, r.n_removed_words, r["__key"]) for r in found} == {("h", 1, 60, "mine"), ("g", 0, 0, "mine")}


def test_quality_removes_lines(spark):
    rows = []
    for i in range(110):
        own = " ".join(f"w{i}x{j}" for j in range(40))
        rows.append((i, "h", f"{own}\n\n  Shared FOOTER of the host \nlast {i}", 1, "x"))
    rows += [rows[0], (500, "g", "Shared footer of the host\n" + own, 7, None)]
    got = quality.kept_documents(spark.createDataFrame(rows, "doc_id long, source string, text string, n_chars int, more string"))
    want = [(i, h, t.replace("  Shared FOOTER of the host \n", ""), 0, m) for i, h, t, _, m in rows[:-1]]
    want = [(i, h, t, len(t), m) for i, h, t, _, m in want] + [rows[-1]]
    assert as_set(got, "doc_id", "source", "text", "n_chars", "more") == collections.Counter(want)


@pytest.mark.parametrize("min_docs", [10, 2])
def test_line_dedup(docs, rows, min_docs):
    names, want = by_duckdb(linededup.SQL.replace(f">= {linededup.MIN_DOCS}", f">= {min_docs}"), rows)
    got = linededup.dropped_lines(docs, min_docs=min_docs, with_text=True)
    assert as_set(got, *names) == want
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in got.collect())


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.uint64)
    levels = linededup.unpack_levels(linededup.pack_levels(linededup.build_index(keys)))
    assert sorted(linededup.probe_index(levels, keys).tolist()) == list(range(len(keys)))


def test_line_keys_of_one_hash():
    """Keys that share their hash are told apart by their fingerprints, in the index and where lines are counted."""
    keys = np.zeros(300, linededup.KEY)
    keys["hash"], keys["print"] = np.arange(300) // 3, np.arange(300) % 3
    levels = linededup.unpack_levels(linededup.pack_levels(linededup.build_index(keys)))
    assert sorted(linededup.probe_index(levels, keys).tolist()) == list(range(300))
    assert len(linededup._distinct(np.concatenate((keys, keys)))[0]) == 300


def test_line_dedup_of_lines_that_polynomials_confuse(spark):
    """Thue-Morse lines and their complements are the same to a polynomial sum modulo 2**64: five documents each, none in ten."""
    bits = [bin(i).count("1") % 2 for i in range(2048)]
    lines = ["".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)]
    rows = [(i, f"own {i}\n{lines[i % 2]}") for i in range(10)]
    got = linededup.dropped_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.n_dropped for r in got.collect()} == {0}
    got = linededup.dropped_lines(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=5)
    assert {r.n_dropped for r in got.collect()} == {1}


# ---------------------------------------------------------------------------- op 6

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body>
<header><h1>Site</h1><form><p>Search all of this site here</p></form></header><nav><ul><li>Home<li>About</ul></nav>
<div class="ad">Buy &lt;now&gt; and save a lot of money on everything today</div>
<article><header><h2>Title&nbsp;of it</h2><p>by someone</p></header><p>A first   paragraph with &eacute;t&#233; and a good
 many words in it to read.<br>Second line <b>bold <p>Short.<p>Another long paragraph, unclosed, of which there is &gt; enough text
<div class="share-bar">Share this</div><table><tr><td>cell one<td>cell two</table>
<section class="comments"><article><p>I am a reader and have a lot of opinions about all of this.</p></article></section></article>
<aside><p>Related reading for you and for others, with many words as well.</p></aside><footer>&copy; Site</footer>
<script>var t = "</p><article><p>no</p>"; track(1);</script></body></html>"""


def test_html_text(spark):
    want = ("Title of it\n\nA first paragraph with été and a good many words in it to read. Second line bold\n\nShort.\n\n"
            "Another long paragraph, unclosed, of which there is > enough text\n\ncell one\n\ncell two")
    assert html_text.main_text(PAGE) == want
    soup = "<div id=menu>Menu</div><div class=c><p>" + "many words here " * 20 + "</p><p>ok</p></div><div class=footer>end</div>"
    assert html_text.main_text(soup) == ("many words here " * 20).strip() + "\n\nok"
    rows = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "<p>"), (None, "x", "plain text & more")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert as_set(got, "page_id", "url", "text", "n_chars") == collections.Counter(
        [(1, "u", want, len(want)), (2, None, "", 0), (3, "v", "", 0), (4, "w", "", 0), (None, "x", "plain text & more", 17)])


LONG = "a sentence of the article that goes on for quite a few words more"


def test_html_article_keeps_vague_names():
    page = (f"<body><div class=related><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></div><article><h2 class=section-header>Title</h2>"
            f"<p>{LONG}</p><div class=legal>{LONG} by law</div><section class=related-work><p>{LONG} of others</p></section>"
            f"<div class=ad>{LONG} to buy</div></article></body>")
    assert html_text.main_text(page).split("\n\n") == ["Title", LONG, f"{LONG} by law", f"{LONG} of others"]


def test_html_short_steps_without_article():
    steps = [f"Step {i}: turn {i}" for i in range(12)]
    page = (f"<body><div class=x7><a href=1>Home</a> <a href=2>News</a></div><div class=x8><p>{LONG}</p>"
            + "".join(f"<div>{x}</div>" for x in steps) + f"<p>{LONG} again</p><div>The end</div></div>"
            "<div class=x9><ul><li><a href=3>Terms</a><li><a href=4>Privacy</a></ul></div></body>")
    assert html_text.main_text(page).split("\n\n") == [LONG, *steps, f"{LONG} again", "The end"]


def test_html_threshold_decides():
    """Names that say nothing: the ratio alone tells the article from the menus, and the threshold moves the line."""
    menu = "".join(f"<li><a href={i}>entry {i}</a>" for i in range(8))
    page = f"<body><div class=q1><ul>{menu}</ul></div><div class=q2><p>{LONG}<p>{LONG}</div><div class=q3><ul>{menu}</ul></div></body>"
    assert html_text.main_text(page) == f"{LONG}\n\n{LONG}"
    assert "entry 3" in html_text.main_text(page, threshold=0.0)
    assert html_text.main_text(page, threshold=50.0) == ""


def test_html_rows(spark):
    """Repeated rows, clashing extra columns, a very long page, a page marked as a whole; many open elements."""
    long = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    whole = f"<div class=widget><p>{LONG}</p></div>"
    rows = [(1, "u", long, "x", 0), (2, "v", whole, "y", 0), (2, "v", whole, "y", 0), (3, "w", "<div>" * 3000 + LONG, None, None)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int"))
    want = [(1, "\n\n".join([LONG] * 20_000)), (2, LONG), (2, LONG), (3, LONG)]
    assert as_set(got, "page_id", "text") == collections.Counter(want)
    assert got.columns == ["page_id", "url", "text", "n_chars"]


def test_html_pieces(monkeypatch):
    whole = html_text.main_text(PAGE)
    monkeypatch.setattr(html_text, "PIECE", 7)
    assert html_text.main_text(PAGE) == whole


# ---------------------------------------------------------------------------- op 7

def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, spare, open_ = {}, 1.5 * sum(sizes.values()), set(names)
    while open_:
        level = spare / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in open_}
        for s in above:
            target[s] = 2 * sizes[s]
            spare -= 2 * sizes[s]
        open_ -= above
    return target


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(i, i, None if i % 11 == 0 else f"s{i % 4 * (i % 3)}", rng.choice([0, 1, 30, 200, 900])) for i in range(700)]
    df = spark.createDataFrame(rows, "row long, doc_id long, source string, size long")
    got = mixing.mix(df, fan_in=8).collect()
    assert sorted(r.row for r in got) == list(range(700))
    sizes = collections.Counter()
    for r in rows:
        sizes[r[2]] += r[3]
    want = brute_targets(sizes)
    taken = collections.Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 450 + 1e-6  # half of the largest document
    again = mixing.mix(df.repartition(7), fan_in=8)
    assert as_set(again, "row", "taken") == collections.Counter((r.row, r.taken) for r in got)


def test_mixed_documents(docs, rows):
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    assert {r.doc_id for r in got.collect()} <= {r[0] for r in rows}


# ---------------------------------------------------------------------------- op 8

def test_toxicity(spark):
    rng = random.Random(4)
    vocabulary = [a + b for a in ("ba", "lo", "mi", "ten", "gra", "su") for b in ("ra", "ndo", "t", "les", "ky", "fen")]
    clean = lambda: " ".join(rng.choice(vocabulary) for _ in range(25))
    bad = ["nasty", "wretch", "vermin"]
    hide = {"nasty": "n4sty", "wretch": "w r e t c h", "vermin": "veeeermin"}
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 5 == 0
        word = rng.choice(bad)
        rows.append((i, clean() + (f" {hide[word] if i >= 900 else word} " if toxic else " ") + clean()))
        if i < 900:
            labels.append((i, 1, int(toxic)))
    rows += [(5000, None), (5001, ""), (None, "tenra"), (5002, "x" * 5000)]
    got = toxicity.scored(spark.createDataFrame(rows, "doc_id long, text string"),
                          spark.createDataFrame([*labels, (3, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    hit = [r.predicted == int(r.doc_id % 5 == 0) for r in got if r.doc_id is not None and r.doc_id < 5000 and (r.held_out or r.doc_id >= 900)]
    assert sum(hit) >= 0.95 * len(hit)
    nothing = toxicity.scored(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, toxic int"))
    assert nothing.count() == 0


@pytest.fixture(scope="module")
def english(spark):
    plain = "such a stupid idiot here said hello to all of the other people . it is not a good idea to call him an idiot or stupid . " \
            "the stupid idiots are on it , i am here"
    return toxicity.language_model(spark.createDataFrame([(plain,)] * 50, "text string"))


@pytest.mark.parametrize("text,words", [
    ("such a i d i o t here", ["idiot"]), ("s t u p i d i d i o t s", ["stupid", "idiots"]), ("s t u p ! d", ["stupid"]),
    ("$ t u p i d", ["stupid"]), ("(i d i o t)", ["idiot"]), ("i  d  i  o  t", ["idiot"]), ("i\u00a0d\u00a0i\u00a0o\u00a0t", ["idiot"]),
    ("i/d/i/o/t", ["idiot"]), ("st up id", ["stupid"]), ("(i d i o t).", ["idiot"]), ("it is on a", ["it", "is", "on", "a"])])
def test_spelled_words(english, text, words):
    assert set(words) <= toxicity.spelled(text, english, {})
    assert toxicity.document_sum(text, english, {"=" + words[0]: 2.0}, {}, {}) == 2.0


@pytest.mark.parametrize("token,word", [
    ("1di" + 40 * "o" + "t", "idiot"), ("-".join("1d10t") + "-" * 60 + "s", "idiots"), ("hello,idi0t", "idiot"), ("hello/1diot", "idiot"),
    ("other-idi0t", "idiot"), ("other_idi0t", "idiot"), ("hello,$tupid", "stupid")])
def test_restored_parts(english, token, word):
    assert word in toxicity.pieces(token, english)


def test_viterbi_is_exact():
    """The decoded letters cost no more than any path of the lattice."""
    rng = np.random.default_rng(1)
    model = rng.random((27, 27, 27)) * 3

    def cost(path):
        a = b = total = 0
        for letter, price in path:
            total += price
            if letter:
                c = ord(letter) - 96
                total, a, b = total + model[a, b, c], b, c
        return total + model[a, b, 0]

    for word in ("1d10t", "a44-b", "ooo0", "$h1*"):
        best = min(itertools.product(*toxicity.lattice(word)), key=cost)
        assert toxicity.restore(word, model) == "".join(x for x, _ in best)


# --------------------------------------------------------------------------- op 10

@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=40), max_size=8), st.integers(1, 16))
def test_chunk_round_trip(docs_, block):
    lengths = np.array([len(x) for x in docs_], np.int64)
    ids = np.array([y for x in docs_ for y in x], "<u4")
    back = tokenfiles.unpack_chunk(tokenfiles.pack_chunk(lengths, ids, block))
    assert back[0].tolist() == lengths.tolist() and back[1].tolist() == ids.tolist()


def test_token_files(spark, docs, rows, tmp_path):
    from tokenizers import Tokenizer
    path, tokenizer = str(tmp_path / "tokens"), tokenfiles.default_tokenizer()
    odd = [(200, "It's WE'LL don't <|endoftext|>x a b É́ é, naïve... ßΣ ﬁ 12a3 　中文字!?"), (201, "a'b''c --- ***"),
           (202, "A" * 900 + "<|startoftext|>." + "\x85q"), (203, "İstanbul ǅ x²")]
    table = spark.createDataFrame([*[r[:2] for r in rows], *odd], "doc_id long, text string").repartition(4)
    tokenfiles.write_tokens(table, path, tokenizer, chunk_ids=50, block=16)
    encoder = Tokenizer.from_file(tokenizer)
    want, start = [], 0
    texts = [(r[0], r[1] or "") for r in [*rows, *odd]]
    ids_of = {t: encoder.encode(t, add_special_tokens=False).ids + [2] for _, t in texts}
    got = sorted(tokenfiles.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((n for n, _ in texts), key=lambda n: (n is not None, n or 0))
    crc = lambda ids: (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter(
        (n, *crc(ids_of[t])) for n, t in texts)
    for r in got:
        assert r.start == start
        start += r.n_tokens


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_is_the_library(name):
    """Letters that compose, or turn into a letter and a mark, before closing marks; white space that counts."""
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    library, encoder = Tokenizer.from_file(path), tokenfiles.Encoder(path)
    texts = ["", "  two  spaces\n\nand lines ", "\u0130. \u0130, x", "\u0915\u093c. \u0958.", "\u00dcn\u00ef. e\u0301. \u0301. a\u00a0b.",
             "\uac00. \u1100\u1161.", "\ufb01. \u01c5, \u0391\u03a3.", "<|endoftext|>. hi<|endoftext|>x <|start", "''s. don't!?", "H\u0331 h\u0331 J\u030c. T\u0308x",
             "<|StartOfText|>.A <|STARTOFTEXT|>", "A.B, c.'S 'RE.x IT'S,it's", "x" * 300 + "." + "\u00e9" * 300 + ","]
    rng = random.Random(5)
    alphabet = [*"aAhHjtsSlLzZ09  .,!?#*''-<|>\n", "\u0331", "\u030c", "\u0308", "\u0301", *"\u00e9\u00c9\u00df\u0130\u03a3\u2014\u2026\u00a0\u4e2d\u0958",
                "<|endoftext|>", "<|startOFtext|>", "the", "Word."]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(3000)]
    for text, got in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


# ---------------------------------------------------------------------- everything

def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    for got in (suffixdedup.dedup_substrings(empty), licenses.license_table(empty), decontaminate.hit_table(empty, none),
                simhash.near_duplicates(empty), quality.judged(empty.select("doc_id", "source", "text")),
                mixing.mixed_documents(empty), linededup.dropped_lines(empty), tokenfiles.encoded(empty),
                html_text.extract(spark.createDataFrame([], "page_id long, url string, html string"))):
        assert got.count() == 0


def test_pipeline(spark, docs, rows, tmp_path):
    """Each stage on all that its predecessor kept, held against plain versions of its decision."""
    spark.createDataFrame([(1, prose(random.Random(9), 30))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, common.written(stage(spark, now, str(tmp_path)), name)
        assert now.columns == before.columns, name
        if name == "simhash_near_dedup":
            r = before.select("doc_id", "text").collect()
            low = brute_components([x.doc_id for x in r], [brute_print(x.text) for x in r])
            assert sorted(x.doc_id for x in now.collect() if x.doc_id is not None) == sorted(set(low) - {None})
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count()
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]

"""Jaccard join, phrase mining and token alignment against brute-force versions on small awkward tables."""

from __future__ import annotations

import collections
import functools
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from estatelens.llm import collocations, jaccard, tokenalign

DOCS = "doc_id long, text string, lang string, source string, key string, n long, row long, __key string"
UPPER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = ["the", "of", "Über", "été", "on", "x", "42", "ça,", "end.\n", "a-b", "ing", "w\t", "!"]
    prose = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", "", str(rng.randint(0, 9))]) for _ in range(n))
    base = [prose(n) for n in (3, 4, 12, 60, 200, 400)]
    texts = [None, "", " \n\t ", "a", "A", "one two three", *base, base[4]]
    for _ in range(40):  # near copies: some link with the base only, some with one another
        words = base[4].split(" ")
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(len(words))] = prose(1)
        texts.append(" ".join(words))
    texts += [base[3] + " " + prose(rng.randint(0, 14)) for _ in range(12)] + ["b " * 3000, "x" * 700, "日本 語 テキスト 😀", base[5].upper()]
    out = [(i, t, rng.choice(["en", "de", None, "und"]), "s", "k", 7, 8, "z") for i, t in enumerate(texts)]
    return [*out, out[8], (None, base[2], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def counted(df):
    return collections.Counter(tuple(r) for r in df.collect())


# --------------------------------------------------------------------------- op 11

def shingles(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(" ".join(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([" ".join(w)] if w else [])


def brute_components(rows):
    sets, root = [shingles(r[1]) for r in rows], list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return collections.Counter((r[0], len(sets[i]), least.get(top(i)) if sets[i] else r[0]) for i, r in enumerate(rows))


@pytest.mark.parametrize("block", [1024, 3])
def test_jaccard_components(docs, rows, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "PARTNERS", 1 if block == 3 else 8)
    got = jaccard.jaccard_components(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert counted(got) == brute_components(rows)


def test_jaccard_empty(empty):
    assert jaccard.jaccard_components(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 2**32 - 1))
def test_linked_sets_share_a_key(n, seed):
    """Any two sets at the least similarity share a key, and their narrow sketches do not rule them out."""
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 2**63, 2 * n + 10, dtype=np.int64).astype(np.uint64)
    both = int(rng.integers(0, n + 1))
    a = np.unique(pool[:n])
    b = np.unique(np.concatenate((pool[:both], pool[n:n + int(rng.integers(0, n - both + 3))])))
    if not len(b):
        return
    common_ = len(np.intersect1d(a, b))
    if 100 * common_ >= 85 * (len(a) + len(b) - common_):
        whose, keys = jaccard.keys_of([a, b])
        assert set(keys[whose == 0].tolist()) & set(keys[whose == 1].tolist())
        x, y = jaccard.narrow_sketches([a, b])
        assert np.bitwise_count(x ^ y).sum() <= jaccard.most_apart(len(a) + len(b))


def test_key_numbers_follow_the_sizes():
    """A set has no more keys than its size allows differing shingles, in each of its bands."""
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)) for n in (1, 5, 7, 50, 1000)]
    whose, _ = jaccard.keys_of(sets)
    for i, x in enumerate(sets):
        assert 1 <= (whose == i).sum() <= 2 + 0.4 * len(x)


# --------------------------------------------------------------------------- op 12

def brute_phrases(rows, least, top):
    counts = collections.defaultdict(collections.Counter)
    for r in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (r[1] or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                for j in range(len(w) - k + 1):
                    counts[r[2] or "und"][tuple(w[j:j + k])] += 1
    out = collections.Counter()
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {p for q, b in cand.items() if len(q) == 3 for p in (q[:2], q[1:]) if p in cand and 100 * b >= 50 * cand[p]}
        ranked = []
        for p, a in cand.items():
            if p not in inside:
                score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out[(lang, i, p.decode(), -a, left, right, n, -s)] += 1
    return out


@pytest.mark.parametrize("least,top,every,count", [(10, 2000, 4, 2), (2, 30, 4, 2), (3, 2000, 1000, 9), (2, 2000, 1, 1)])
def test_phrases(docs, rows, least, top, every, count):
    got = collocations.collocations(docs, least=least, top=top, sample_every=every, sample_count=count)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert counted(got) == brute_phrases(rows, least, top)


def test_phrases_expand_until_closed(spark, rows):
    """A sample that proposes nothing fails at the border twice: words, then phrases; one that proposes all never does."""
    coded = spark.createDataFrame([(r[1], 5) for r in rows], "text string, lang long")
    *_, passes = collocations.frequent_phrases(coded, 10, 1 << 30, 1 << 30)
    assert passes == 3
    *_, passes = collocations.frequent_phrases(coded, 10, 1, 1)
    assert passes == 1


def test_phrases_crowded_bitmaps(docs, rows, monkeypatch):
    """Bits set by accident change no count."""
    monkeypatch.setattr(collocations, "power_for", lambda n, most: 7)
    assert counted(collocations.collocations(docs, least=2)) == brute_phrases(rows, 2, 2000)


def test_phrases_empty(empty):
    assert collocations.collocations(empty).count() == 0


# --------------------------------------------------------------------------- op 13

@functools.cache
def default_units():
    return tokenalign._sides(tokenalign.default_tokenizers())


@pytest.fixture(scope="module")
def sides():
    return default_units().sides


def tokens_of(sides, text):
    both = [side.encode([text or ""])[0] if text else [] for side in sides]
    good = all(b"".join(s.token_bytes[t] for t in ids) == b" " + (text or "").encode() for s, ids in zip(sides, both))
    return both if text and good else [[], []]


def brute_alignment(sides, texts):
    """Per text: groups by common ends, links by occurrence; then counts over all texts."""
    docs, holders = [], collections.Counter()
    for text in texts:
        ids = tokens_of(sides, text)
        ends = [np.cumsum([len(s.token_bytes[t]) for t in x]).tolist() for s, x in zip(sides, ids)]
        groups, at = [], [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            to = [e.index(end) + 1 for e in ends]
            groups.append([x[a:b] for x, a, b in zip(ids, at, to)])
            at = to
        links = [(a, b) for g in groups for a in g[0] for b in g[1]]
        holders.update(set(links))
        docs.append((len(ids[0]), len(ids[1]), groups, links))
    best = collections.defaultdict(int)
    for (a, _), n in holders.items():
        best[a] = max(best[a], n)
    for n_a, n_b, groups, links in docs:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        yield (n_a, n_b, len(groups), len(links), sum(holders[x] == best[x[0]] for x in links), sum(holders[x] for x in links),
               hashlib.sha256(text.encode()).hexdigest() if groups else "")


def test_alignment(docs, rows, sides, monkeypatch):
    monkeypatch.setattr(tokenalign, "BLOCK_BYTES", 2000)
    got = tokenalign.align(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = brute_alignment(sides, [r[1] for r in rows])
    assert counted(got) == collections.Counter((r[0], *w) for r, w in zip(rows, want))


def test_alignment_empty(empty):
    assert tokenalign.align(empty).count() == 0


PIECES = st.sampled_from([" ", "  ", "\n", "a", "é", "ß", "日", "😀", "'s", "12", "́", "\t", "The", "ing", "<s>", "▁", "!", " ",
                          "<|endoftext|>", "\x00", "ﬁ", "<0x41>", "ǅ"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=30).map("".join))
def test_units_give_the_librarys_ids(text):
    units = default_units()
    ids, counts = units.tokens([text])
    want = tokens_of(units.sides, text)
    assert [x.tolist() for x in ids] == want and [int(c[0]) for c in counts] == [len(x) for x in want]


def test_byte_side_is_the_tokenizers_library(rows, sides):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(tokenalign.default_tokenizers()[0])
    library.encode_special_tokens = True
    texts = [r[1] or "" for r in rows] + ["<|endoftext|> it's  we'll\n\n x", "ʼn ŉ ɐ", "12 345,6"]
    assert sides[0].encode(texts) == [library.encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_large_groups_and_overlaps(sides, monkeypatch):
    """Links of a large group are counted by distinct ids; both directions together give every overlap once."""
    units = tokenalign.Units(sides)
    ids, counts = units.tokens(["Straßenbahnhaltestelle 日本語 unbelievable 😀😀 wordlessness", "the thing"])
    whole = tokenalign.Alignment(ids, counts, sides)
    base = max(len(s.sizes) for s in sides)
    want = [x.tolist() for x in whole.pairs(base)]
    monkeypatch.setattr(tokenalign, "LINKS_AT_ONCE", 2)
    assert [x.tolist() for x in whole.pairs(base)] == want and sum(want[1]) == whole.n_links.sum()
    ends = [np.cumsum(s.sizes[i]) for s, i in zip(sides, ids)]
    starts = [e - s.sizes[i] for e, s, i in zip(ends, sides, ids)]
    touching = {(i, j) for i in range(len(ids[0])) for j in range(len(ids[1]))
                if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]}
    assert {(i, int(j)) for i, j in enumerate(whole.cover[0])} | {(int(i), j) for j, i in enumerate(whole.cover[1])} == touching



"""Spelling variants, phrases and set joins against plain versions of their contracts."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from labelloom.llm import bloom, op11_collocations, op12_spelling, op13_jaccard, quotient

DOC = "doc_id long, text string, lang string, word string, n long, form string, node long"  # with names that operators use


def documents(spark, rows):
    """rows: (doc_id, text, lang)."""
    return spark.createDataFrame([(i, t, l, "w", 1, "f", 2) for i, t, l in rows], DOC)


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# -- Bloom filters

def test_bloom_never_denies_a_key(spark):
    rng = np.random.default_rng(1)
    keys = [(int(x), int(s)) for x, s in zip(rng.integers(-2**63, 2**63, 5000), rng.integers(0, 3, 5000))]

    def hashed(batch):
        h, s = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
        for shard in np.unique(s).tolist():
            yield shard, h[s == shard]

    for limit in (bloom.BLOCKS, 64):
        held = bloom.build(spark.createDataFrame(keys, "h long, s int"), hashed, dict(Counter(s for _, s in keys)), limit)
        assert sum(len(b) for b in held.shards.values()) <= max(limit, 3)
        for shard in range(3):
            assert held.has(shard, np.array([h for h, s in keys if s == shard], np.int64).view(np.uint64)).all()
        strangers = held.has(0, rng.integers(0, 2**63, 20000).astype(np.uint64)).mean()
        assert strangers < 0.02 or limit == 64
    assert not held.has(9, np.array([1], np.uint64)).any()


# -- spelling variants

def plain_variants(rows, every=97):
    n = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = fold(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    near = {w: [v for v in n if v != w and one_edit(v, w)] for w in n}
    form = {}
    for w, some in near.items():
        top = min(some, key=lambda v: (-n[v], v), default=None)
        form[w] = top if top and n[top] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("every", [97, 2, 1])
def test_spelling_equals_plain(spark, every):
    rng = random.Random(every)
    pool = ["".join(rng.choice("abeé") for _ in range(rng.randint(4, 7))) for _ in range(150)]
    rows = [(i, " ".join(rng.choice(pool[:rng.randint(5, 150)]).upper() if rng.random() < .2 else rng.choice(pool[:rng.randint(5, 150)]) for _ in range(60)), None) for i in range(80)]
    rows += [(None, "aaaaa aaaaaa aaaaa Éaaaa éaaaa", None), (900, None, None), (901, "", None), (902, "12 ẞ×÷ aaaaaaa, aaaaaaa; aaaaaaa", "x"), (0, rows[0][1], None), (0, rows[0][1], None),
             (903, ("x" * 3000 + " ") * 3 + ("x" * 2999 + " ") * 7 + "y" * 70000, None)]
    got = op12_spelling.groups(documents(spark, rows), every=every)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_variants(rows, every), key=str)


def test_spelling_with_a_full_filter(spark, monkeypatch):
    """A filter far too small lets most edits pass; the join still removes the false ones."""
    monkeypatch.setattr(bloom, "ROOM", 1)
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choice("ab") for _ in range(rng.randint(5, 7))) for _ in range(80)), None) for i in range(30)]
    assert set(map(tuple, op12_spelling.groups(documents(spark, rows)).collect())) == plain_variants(rows)


def test_spelling_empty(spark):
    assert op12_spelling.groups(documents(spark, [])).count() == 0
    assert op12_spelling.groups(documents(spark, [(1, "one two", None)])).count() == 0


# -- counting quotient filters and phrases

def test_permutation_is_invertible():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 4):
        lanes = [rng.integers(0, 2**64, 1000, dtype=np.uint64) for _ in range(n)]
        assert all((a == b).all() for a, b in zip(lanes, quotient.restore(quotient.permute(lanes))))


@pytest.mark.parametrize("bits", [0, 3, 8])
@pytest.mark.parametrize("n", [1, 2, 4])
def test_quotient_filters_are_lossless(n, bits):
    rng = np.random.default_rng(bits + n)
    seen, parts = Counter(), {}
    for size in (1, 7, 3000, 5):
        lanes = [rng.integers(0, 30, size).astype(np.uint64) for _ in range(n)]
        for lane in lanes:
            lane[:size // 2] = 7
        seen.update(zip(*(lane.tolist() for lane in lanes)))
        lanes, counts = quotient.combine(quotient.permute(lanes))
        bounds = quotient.shard_bounds(lanes[0], bits)
        for s in range(1 << bits):
            a, b = bounds[s], bounds[s + 1]
            if b > a:
                parts.setdefault(s, []).append(quotient.unpack(quotient.pack([x[a:b] for x in lanes], counts[a:b], bits), s, bits, n))
    got = {}
    for some in parts.values():
        lanes, counts = quotient.merge(some)
        got |= dict(zip(zip(*(lane.tolist() for lane in quotient.restore(lanes))), counts.tolist()))
    assert got == seen and max(seen.values()) > 255


def test_keys_that_share_a_lane_stay_apart():
    lanes = [np.array([5, 5, 5, 5, 1], np.uint64), np.array([2, 1, 2, 1, 1], np.uint64)]
    held, counts = quotient.combine(lanes)
    assert [tuple(map(int, x)) for x in zip(*held, counts)] == [(1, 1, 1), (5, 1, 2), (5, 2, 2)]


def plain_phrases(rows, least=30, top=2000):
    n, f = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i:i + m]) for m in range(1, 5) for i in range(len(words) - m + 1))
    f = {k: c for k, c in f.items() if c >= least}
    out = []
    for (lang, *w), a in f.items():
        if len(w) >= 2:
            score, _, left, right = min((2000000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
            held = any(len(v) > len(w) and v[0] == lang and 100 * c >= 80 * a and any(v[i:i + len(w)] == tuple(w) for i in range(1, len(v) - len(w) + 1)) for v, c in f.items() if len(v) > len(w) + 1)
            if not held:
                out.append((lang, -score, -a, " ".join(w).encode(), left, right))
    out.sort()
    result, rank = [], Counter()
    for lang, score, a, phrase, left, right in out:
        rank[lang] += 1
        if rank[lang] <= top:
            result.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return result


@pytest.mark.parametrize("small", [False, True])
def test_phrases_equal_plain(spark, monkeypatch, small):
    if small:  # many hand-overs of each task
        monkeypatch.setattr(op11_collocations, "PENDING", 50)
        monkeypatch.setattr(op11_collocations, "HELD", 60)
    rng = random.Random(2)
    pool = ["new", "york", "City", "of", "Ünter", "É", "the", "big", "a\u00a0b", "x"]
    rows = [(i, "".join(rng.choice(["New York City", "the big x of", *pool]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(60)), rng.choice(["en", "de", None, "und", ""])) for i in range(120)]
    rows += [(1, None, "en"), (1, "", None), (None, rows[0][1], "en"), (5, rows[0][1], "en"), (6, "z " * 30000 + "." * 50, "long"), (7, "... ;;", "marks")]
    got = list(map(tuple, op11_collocations.mine(documents(spark, rows), top=40).collect()))
    assert sorted(got) == sorted(plain_phrases(rows, top=40))
    assert {"en", "und", "long", ""} <= {r[0] for r in got}


def test_phrases_with_shared_ids(spark, monkeypatch):
    """Words whose first ids are equal are told apart and counted under other ids."""
    from labelloom.llm import words
    whole = words.Words._hashes
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("aa bb cc dd".split()) for _ in range(40)), "en") for i in range(40)]
    expected = plain_phrases(rows)

    def equal(self):
        h = whole(self)
        return np.where(np.array([self.text(i) in (b"aa", b"bb") for i in range(len(h))], bool), np.uint64(1), h)

    batch = pa.RecordBatch.from_pydict({"text": ["aa bb cc"], "lang": ["en"]})
    monkeypatch.setattr(words.Words, "_hashes", equal)
    ids = next(op11_collocations.word_ids(batch, np.zeros(0, np.uint64)))[1]
    assert ids[0] == ids[1] != ids[2]
    other = next(op11_collocations.word_ids(batch, ids[:1]))[1]
    assert len(set(other.tolist())) == 3 and other[2] == ids[2]
    checks = op11_collocations.second_hash(next(op11_collocations.word_ids(batch, ids[:1]))[0])
    assert len(set(checks.tolist())) == 3
    monkeypatch.undo()
    shared = next(op11_collocations.word_ids(pa.RecordBatch.from_pydict({"text": ["aa bb"], "lang": ["en", ]}), np.zeros(0, np.uint64)))[1]
    docs = documents(spark, rows)
    before, after = (op11_collocations.frequent(docs, 30, 4, some)[0].groupBy("m").agg({"f": "sum"}).collect() for some in (np.zeros(0, np.uint64), shared))
    assert sorted(before) == sorted(after)
    assert sorted(map(tuple, op11_collocations.mine(docs).collect())) == sorted(expected)


def test_phrases_empty(spark):
    assert op11_collocations.mine(documents(spark, [])).count() == 0
    assert op11_collocations.mine(documents(spark, [(1, None, None), (2, "few words", "en")])).count() == 0


# -- set join

def plain_set(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def plain_classes(rows):
    some = [plain_set(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if some[i] and some[j] and 100 * len(some[i] & some[j]) >= 80 * len(some[i] | some[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None and some[i]:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(some[i]), least.get(root(i)) if some[i] else d) for i, (d, _, _) in enumerate(rows)]


def family(rng, pool, size, changes, copies):
    base = [rng.choice(pool) for _ in range(size)]
    out = [" ".join(base)]
    for _ in range(copies):
        some = list(base)
        for _ in range(rng.randint(0, changes)):
            at = rng.randrange(len(some))
            if rng.random() < .5:
                some[at] = rng.choice(pool)
            else:
                del some[at]
        out.append(rng.choice([" ", "  ", "\n"]).join(some))
    return out


@pytest.mark.parametrize("block, heavy", [(op13_jaccard.BLOCK, op13_jaccard.HEAVY), (300, 8), (1, 1)])
def test_set_join_equals_plain(spark, monkeypatch, block, heavy):
    monkeypatch.setattr(op13_jaccard, "HEAVY", heavy)
    rng = random.Random(block)
    pool = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(pool) for _ in range(60))
    texts = [t for size in (1, 2, 3, 4, 5, 6, 8, 12, 20, 40, 60, 100, 300) for _ in range(3) for t in family(rng, pool, size, max(1, size // 25), 6)]
    texts += family(rng, pool, 50, 3, 60) + [f"{passage} {t}" for t in family(rng, pool, 30, 30, 12)]
    texts += [passage.upper(), passage, "", " \t", "É É É É É É", "a a a a a a a a", "a a a a a"]
    rows = [(i * 7 % 1009, t, None) for i, t in enumerate(texts)]
    rows += [(5000, None, None), (None, None, None), (None, texts[0], None), (None, "only here " * 3, None), (None, "only  here " * 3, None), (3, rows[9][1], None), rows[20], rows[20], (6000, "x " * 50000 + passage, "y")]
    got = list(map(tuple, op13_jaccard.classes(documents(spark, rows), block).collect()))
    assert sorted(got, key=str) == sorted(plain_classes(rows), key=str)


@pytest.mark.parametrize("block", [op13_jaccard.BLOCK, 200])
def test_every_link_is_found_once_at_least(spark, block):
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(200)]
    texts = sorted({t for size in (5, 9, 30, 120) for _ in range(3) for t in family(rng, pool, size, size // 20 + 1, 15)})
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    rows = op13_jaccard.parsed(docs)
    name = {bytes(r["digest"]): r["doc_id"] for r in rows.filter("digest is not null").collect()}
    got = {frozenset((name[bytes(r["a"])], name[bytes(r["b"])])) for r in op13_jaccard.links(docs, rows, block, every=True).collect()}
    some = {d: plain_set(texts[d]) for d in name.values()}
    assert got == {frozenset((i, j)) for i in some for j in some if i < j and 100 * len(some[i] & some[j]) >= 80 * len(some[i] | some[j])}
    assert len(got) > 40


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(2)
    for _ in range(60):
        base = rng.integers(0, 500, 80)
        members = [np.unique(np.where(rng.random(80) < rng.choice([0, .05, .1, .3]), rng.integers(0, 500, 80), base)[:rng.integers(5, 80)]).astype(np.uint64) for _ in range(40)]
        lists = op13_jaccard.Lists(members)
        for s in members[:8]:
            sizes = [(len(np.intersect1d(s, y)), len(np.union1d(s, y))) for y in members]
            assert lists.search(s).tolist() == [j for j, (both, either) in enumerate(sizes) if 100 * both >= 80 * either]


def test_set_join_empty(spark):
    assert op13_jaccard.classes(documents(spark, [])).count() == 0
    assert list(map(tuple, op13_jaccard.classes(documents(spark, [(1, None, None), (2, "", None), (None, "", None)])).collect())) == [(1, 0, 1), (2, 0, 2), (None, 0, None)]

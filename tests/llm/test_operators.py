"""The numbered operators against plain versions of their contracts, on made-up rows with nulls, empty and long texts, ties and repeats."""
import gzip
import hashlib
import itertools
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from labelloom.llm import graph, op1_chat, op2_warc, op3_decontaminate, op4_licenses, op5_quality, op6_html, op7_bpe, op8_simhash, op9_language, op10_pii
from labelloom.llm.queries import vocabulary_path

DOC = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, fp string, spans int"  # with names that operators use


def documents(spark, rows):
    """rows: (doc_id, text, lang)."""
    return spark.createDataFrame([(i, t, l, "s", len(t or ""), True, "x", 1) for i, t, l in rows], DOC)


def sentence(rng, n, words="the of house water green running a to long field stone river made with under and some other time place".split()):
    return " ".join(rng.choice(words) for _ in range(n))


# -- BPE

def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary_path())
    rng = random.Random(3)
    pool = "abcdefghi   \n\t'sdtrevml0123ÄÖßéñ漢字テ\U0001f600\u0085\xa0 \x1c\x00ⅷ²՘̀!?.,"
    some = [None, "", " ", "a" * 5000, "ab " * 4000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "don't  we'll\n\n\tgo"]
    some += ["".join(rng.choice(pool) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    some += ["".join(chr(rng.choice([rng.randint(0, 0x3000), rng.randint(0x3000, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(25)) for _ in range(150)]
    rows = [(i, t, None) for i, t in enumerate(some)] + [(0, None, None), (None, "again", None)]
    got = op7_bpe.encode_documents(documents(spark, rows).select("doc_id", "text"), vocabulary_path(), ids="ids").collect()
    assert len(got) == len(rows)
    for r in got:
        ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids), r["text"]
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_empty_table(spark):
    assert op7_bpe.encode_documents(documents(spark, []), vocabulary_path()).count() == 0


# -- personal data

EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def luhn(d):
        return sum(x if i % 2 == 0 else (2 * x - 9 if 2 * x > 9 else 2 * x) for i, x in enumerate(reversed(d))) % 10 == 0

    def digits(s):
        return [int(c) for c in s if c in "0123456789"]
    return {"email": [m.span() for m in EMAIL.finditer(text)], "ip": [m.span() for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))],
            "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))], "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]}


def test_pii_base_equals_patterns():
    rng = random.Random(5)
    for _ in range(20000):
        text = "".join(rng.choice("a@.1 2-+(0)9é@.4567 8") for _ in range(rng.randint(0, 50)))
        found = op10_pii.spans(text)
        assert {k: found[k] for k in op10_pii.BASE} == plain_spans(text), text


def test_pii_accounts():
    def found(text):
        return [text[a:b] for a, b in op10_pii.spans(text)["account"]]

    for text in ("Le roman compte 100000 mots.", "La ciudad cuenta 150000 habitantes.", "accounting2024 is here", "We account 12345678 of them", "passport holder 12345678", "konto 12", "ssn: abcdefgh", "passport: 12345678@x.org"):
        assert found(text) == [], text
    for text, number in (("passport: AB12CD34", "AB12CD34"), ("account no. 12 34 56 78", "12 34 56 78"), ("konto 1234 5678 9012", "1234 5678 9012"), ("Account: 12345678 20 items", "12345678"),
                         ("cuenta #123456, y", "123456"), ("SSN 123-45-6789.", "123-45-6789"), ("Kontonummer 12345678", "12345678"), ("compte n 1 compte no 998877", "998877")):
        assert found(text) == [number], text


def test_pii_rows(spark):
    rows = [(1, None, None), (2, "", None), (3, "mail a.b@c.org, 4111 1111 1111 1111 and 10.0.0.1 or +1 (555) 010-0199", None), (3, "a@b.c", None), (4, "1" * 100_000 + "@" * 50, None),
            (5, "IBAN: DE89 3704 0044 0532 0130 00, account no. 12345678, http://u:pw@h.org/x", None)]
    got = {(r["doc_id"], r["text"]): r for r in op10_pii.find(documents(spark, rows).drop("spans")).collect()}
    assert got[1, None]["spans"] == "" and got[2, ""]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    r = got[3, rows[2][1]]
    assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == (1, 1, 1, 1) and r["spans"].startswith("email:5:14,ip:")
    assert [x.split(":")[0] for x in got[5, rows[5][1]]["spans"].split(",")] == ["email", "url", "iban", "account"]
    kept = op10_pii.redact(documents(spark, rows)).orderBy("doc_id").collect()
    assert len(kept) == len(rows) and kept[0]["text"] is None
    assert all("@c" not in (r["text"] or "") and r["n_chars"] == len(r["text"] or "") for r in kept)
    assert op10_pii.masked("x a@b.c y") == "x <EMAIL> y"


# -- SimHash

def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    some = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in some]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4:
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_simhash_classes(spark):
    rng = random.Random(7)
    base = [sentence(rng, n) for n in (3, 40, 200, 600, 600)]
    near = [" ".join(w if rng.random() > 0.004 else "x" for w in t.split(" ")) for t in base for _ in range(12)]
    some = [None, "", " \t", "one", "ONE", "É é", *base, *near, *base[:2], *[sentence(rng, 60) for _ in range(60)]]
    rows = [(1000 - i, t, None) for i, t in enumerate(some)]
    got = {r["doc_id"]: r for r in op8_simhash.classes(documents(spark, rows)).collect()}
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    assert len(got) == len(rows) and all(got[i]["fp"] & (1 << 64) - 1 == f for (i, _, _), f in zip(rows, fps))
    groups = defaultdict(list)
    for (i, _, _), c in zip(rows, plain_components(fps)):
        groups[c].append(i)
    assert {i: got[i]["component_id"] for i in got} == {i: min(g) for g in groups.values() for i in g}
    kept = op8_simhash.representatives(documents(spark, rows + rows[:3] + [(None, "no id", None)]))
    assert sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect()) == sorted(min(g) for g in groups.values())
    assert kept.filter("doc_id is null").count() == 1 and kept.columns == documents(spark, []).columns


def test_simhash_representatives(spark):
    rng = random.Random(21)
    a, b, c, d = (sentence(rng, 60) + f" {x}" for x in "abcd")
    rows = [(None, a, "en"), (None, a, "en"), (None, a, "de"), (None, b, "en"), (5, b, "en"), (7, c, "en"), (7, d, "en"), (7, d, "en"), (8, d, "en")]
    df = documents(spark, rows)
    got = op8_simhash.representatives(df)
    assert got.columns == df.columns
    want = [(7, c), (7, d), (5, b), (None, a)]
    one = sorted(((r["doc_id"], r["text"], r["lang"]) for r in got.collect()), key=str)
    assert sorted((x[:2] for x in one), key=str) == sorted(want, key=str)
    assert one == sorted(((r["doc_id"], r["text"], r["lang"]) for r in op8_simhash.representatives(documents(spark, rows[::-1]).repartition(5)).collect()), key=str)


def test_pigeonring_finds_every_link(spark):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    fps = {centre} | {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(400)}
    fps = sorted(op8_simhash.signed(x) for x in fps)
    got = {(r["a"], r["b"]) for r in op8_simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long")).collect()}
    assert got == {(a, b) for a, b in itertools.combinations(fps, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}


def test_components_of_paths_and_empty(spark):
    rng = random.Random(2)
    nodes = list(range(300))
    rng.shuffle(nodes)
    edges = list(zip(nodes, nodes[1:]))[:150] + [(5000, 5001), (5001, 5000), (5000, 5000)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    whole = min(nodes[:151])
    assert got == {**{n: whole for n in nodes[:151]}, 5000: 5000, 5001: 5000}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert op8_simhash.classes(documents(spark, [])).count() == 0


# -- decontamination

def plain_overlap(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        for i in range(max(1, len(x) - 12) if x else 0):
            window = x[i:i + 13]
            for p in range(len(w) - len(window) + 1):
                if w[p:p + len(window)] == window:
                    hit.update(range(p, p + len(window)))
                    found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block_bytes", [4 << 20, 700])
def test_decontamination(spark, block_bytes):
    rng = random.Random(11)
    items = [(i, sentence(rng, n)) for i, n in enumerate([1, 2, 3, 5, 12, 13, 14, 30, 30])] + [(20, None), (21, ""), (22, "Élan VITAL, vital élan"), (5, sentence(rng, 15)), (None, "river")]
    items += [(30, items[7][1]), (31, "green green green green green")]
    some = [None, "", "...", items[7][1].upper(), "x " * 700 + items[8][1] + " y", sentence(rng, 400), "élan\nvital;vital élan", "green " * 12, items[4][1] + " " + items[4][1], items[6][1][5:]]
    some += [sentence(rng, rng.randint(1, 60)) for _ in range(40)]
    rows = [(i, t, None) for i, t in enumerate(some)] + [(3, some[3], None)]
    got = op3_decontaminate.overlaps(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), block_bytes=block_bytes).collect()
    assert len(got) == len(rows)
    known = [x for x in items if x[0] is not None]
    for r in got:
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == plain_overlap(r["text"], known), r["text"]


def test_decontamination_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark, [(1, "a b", None), (2, None, None)])
    assert [r["contaminated"] for r in op3_decontaminate.overlaps(docs, none).collect()] == [False, False]
    assert op3_decontaminate.clean(docs, none).columns == docs.columns
    assert op3_decontaminate.overlaps(documents(spark, []), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


# -- language

def test_language_held_out(spark):
    rng = random.Random(4)
    words = {"en": "the and with house water this that from".split(), "de": "der und mit haus wasser dieses nicht über".split(), "fr": "le et avec maison eau cette être où".split()}
    rows = [(i, sentence(rng, rng.randint(5, 60), words[l]), l) for i, l in enumerate(["en", "de", "fr"] * 60)]
    rows += [(900, None, "en"), (901, "", "de"), (902, "123 !!", "fr"), (903, "das haus und der", None), (None, "le et avec", "fr"), (0, rows[0][1], "en"), (904, "der und mit " * 40000, "de")]
    got = op9_language.languages(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (900, 901, 902)) and by[903]["lang_pred"] == "de" and by[904]["lang_pred"] == "de"
    import zlib
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([by[i]["lang_pred"] == l for i, t, l in rows[:180] if by[i]["held_out"]]) > 0.95
    kept = op9_language.identified(documents(spark, rows))
    assert kept.columns == documents(spark, []).columns and kept.count() == len(rows) - 3
    assert [r["lang_pred"] for r in op9_language.languages(documents(spark, [(1, "abc", None)])).collect()] == ["und"]


def test_language_code_lengths():
    """Against a tree of dictionaries that escapes context by context."""
    learnt, text = {"x": "abracadabra", "y": "banana bread"}, "abran band"
    counts = {}
    for lang, t in learnt.items():
        raw = np.frombuffer(t.encode(), np.uint8)
        counts[lang] = np.unique(op9_language.grams(raw, np.array([0, len(raw)])), return_counts=True)
    raw = np.frombuffer(text.encode(), np.uint8)
    got = op9_language.Model(counts).cost(raw, np.array([0, len(raw)]))[0]
    for lang, cost in zip(("x", "y"), got):
        follow = defaultdict(Counter)
        t = "\0\0\0" + learnt[lang]
        for i in range(3, len(t)):
            for k in range(4):
                follow[t[i - k:i]][t[i]] += 1
        bits, s = 0.0, "\0\0\0" + text
        for i in range(3, len(s)):
            out = set()
            for k in (3, 2, 1, 0):
                left = {c: n for c, n in follow[s[i - k:i]].items() if c not in out}
                if not left:
                    continue
                total = sum(left.values()) + len(left)
                if s[i] in left:
                    bits -= np.log2(left[s[i]] / total)
                    break
                bits -= np.log2(len(left) / total)
                out |= set(left)
            else:
                bits += np.log2(256 - len(out))
        assert abs(bits - cost) < 1e-3


def test_language_keeps_every_context():
    """Four languages over 140 byte values: order-3 contexts still count, as in a tree of dictionaries."""
    rng = random.Random(11)
    pieces = [bytes(rng.randint(1, 140) for _ in range(6)) for _ in range(300)]
    learnt = {x: b"".join(rng.choice(pieces[i * 50:i * 50 + 150]) for _ in range(1500)) for i, x in enumerate("wxyz")}
    text = b"".join(rng.choice(pieces) for _ in range(60)) + bytes(range(100, 200))
    assert len(set(b"".join(learnt.values()))) == 140
    raw = {x: np.frombuffer(t, np.uint8) for x, t in learnt.items()}
    got = op9_language.Model({x: np.unique(op9_language.grams(r, np.array([0, len(r)])), return_counts=True) for x, r in raw.items()}).cost(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    for lang, cost in zip("wxyz", got):
        follow = defaultdict(Counter)
        t, s, bits = b"\0\0\0" + learnt[lang], b"\0\0\0" + text, 0.0
        for i in range(3, len(t)):
            for k in range(4):
                follow[t[i - k:i]][t[i]] += 1
        for i in range(3, len(s)):
            out = set()
            for k in (3, 2, 1, 0):
                left = {c: n for c, n in follow[s[i - k:i]].items() if c not in out}
                if s[i] in left:
                    bits -= np.log2(left[s[i]] / (sum(left.values()) + len(left)))
                    break
                if left:
                    bits -= np.log2(len(left) / (sum(left.values()) + len(left)))
                out |= set(left)
            else:
                bits += np.log2(256 - len(out))
        assert cost == pytest.approx(bits, rel=1e-5)


# -- quality

def plain_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    five = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(five)
    hit = {i + j for i, x in enumerate(five) if n[x] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit), len(words) < 10 or 100 * len(hit) > 20 * len(words)


def test_quality_rules_and_verdict(spark):
    rng = random.Random(9)
    good = [(i, sentence(rng, 80), None) for i in range(120)]
    bad = [(200 + i, " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in sentence(rng, 80).split()), None) for i in range(60)]
    odd = [(500, None, None), (501, "", None), (502, "é\x00ü \x0b#\n\n \n" * 30, None), (503, "a b c d e " * 2000, None), (504, "x\ny\nx\n x\nx", None), (504, "x\ny\nx\n x\nx", None), (None, "no id at all", None)]
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i, _, _ in good + bad] + [(500, None, 0), (None, 1, 0), (3, 0, 0), (999, 1, 1)], "doc_id long, quality int, toxic int")
    docs = documents(spark, good + bad + odd).select("doc_id", "text")
    got = op5_quality.judge(docs, op5_quality.train(docs, labels)).collect()
    assert len(got) == len(good + bad + odd)
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_rules(r["text"]), r["text"]
        assert not (r["base_failed"] and r["kept"])
    p = {r["doc_id"]: r["quality_p"] for r in got}
    assert np.mean([p[i] > 0.5 for i, _, _ in good]) > 0.95 and np.mean([p[i] < 0.3 for i, _, _ in bad]) > 0.95
    assert op5_quality.train(docs, labels.limit(0)) is None
    assert {r["kept"] for r in op5_quality.judge(docs.filter("doc_id < 100"), None).collect()} == {True}
    assert op5_quality.judge(docs.limit(0), None).count() == 0


# -- WARC

def test_warc_round_trip_and_revisits(spark, tmp_path):
    long = "<p>" + "é" * 200
    rows = [(1, "http://a/", long), (2, "http://b/\r\nX: y", long), (2, "http://b/", long), (3, None, None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "n", long), (7, "u", "WARC/1.0\r\n\r\n" * 20), (8, "u", "x" * 500_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    op2_warc.write(pages.repartition(3), f"file://{tmp_path}/w", records_per_file=2)
    got = op2_warc.read(spark, f"file://{tmp_path}/w")
    assert got.filter("fault is not null").count() == 0
    back = sorted(((r["page_id"], bytes(r["payload"]).decode()) for r in got.collect()), key=str)
    assert back == sorted(((p, h or "") for p, _, h in rows), key=str)
    kinds = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in op2_warc.revisits(got).collect()), key=str)
    size = len(long.encode())
    assert kinds == sorted([(1, size, "response", None), (2, size, "revisit", 1), (2, size, "revisit", 1), (3, 0, "response", None), (4, 0, "response", None), (5, 5, "response", None), (6, 5, "response", None),
                            (None, size, "revisit", 1), (7, 240, "response", None), (8, 500_000, "response", None)], key=str)


def raw_record(body, digest=None):
    d = digest or hashlib.sha256(body).hexdigest()
    return b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha256:" + d.encode() + b"\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def test_warc_salvage():
    good = [raw_record(b"first"), raw_record(b"second"), raw_record(b"third")]
    cases = {b"".join(good): ([b"first", b"second", b"third"], []),
             good[0] + good[1].replace(b"second", b"secund") + good[2]: ([b"first", b"third"], ["digest"]),
             good[0] + good[1][:-9] + good[2]: ([b"first", b"third"], ["no end mark"]),
             b"junk" + good[0] + b"\0\0" + good[2][:-20]: ([b"first"], ["no version line", "no version line"]),
             good[0] + good[1].replace(b"Content-Length: 6", b"Content-Length: 600") + good[2]: ([b"first", b"third"], ["truncated"]),
             gzip.compress(good[0]) + gzip.compress(good[1])[:-12] + gzip.compress(good[2]): ([b"first", b"third"], ["member"]), b"": ([], [])}
    for buf, (want, faults) in cases.items():
        got = list(op2_warc.salvage(buf))
        assert [b for _, _, h, b, _ in got if h is not None] == want
        assert [f for *_, f in got if f] == faults or len([f for *_, f in got if f]) == len(faults)
        assert sum(n for _, n, *_ in got) == len(buf)  # every byte belongs to a record or a gap


def test_warc_members_in_part():
    """Several records in one member that is cut, damaged, or holds a bad record."""
    good = [raw_record(b"%d " % i * 400) for i in range(3)]
    raw = b"".join(good)
    cut = gzip.compress(raw, 0)[:-200]
    got = list(op2_warc.salvage(cut + gzip.compress(good[2])))
    assert [b for _, _, h, b, _ in got if h is not None] == [b"0 " * 400, b"1 " * 400, b"2 " * 400] and sum(n for _, n, *_ in got) == len(cut) + len(gzip.compress(good[2]))
    whole = gzip.compress(good[0] + good[1].replace(b"1 1", b"1 x", 1) + good[2])
    got = list(op2_warc.salvage(whole))
    assert [b for _, _, h, b, _ in got if h is not None] == [b"0 " * 400, b"2 " * 400] and [f for *_, f in got if f] == ["digest"] and sum(n for _, n, *_ in got) == len(whole)


def test_warc_fuzz():
    """Bytes are flipped, cut and put in: no exception, lengths add up, untouched records are found."""
    rng = random.Random(17)
    bodies = [bytes(rng.randrange(256) for _ in range(rng.choice([0, 5, 300]))) + b"%d" % i for i in range(12)]
    for compress in (False, True):
        parts = [gzip.compress(raw_record(b)) if compress else raw_record(b) for b in bodies]
        begins = np.cumsum([0] + [len(p) for p in parts])
        for _ in range(150):
            buf = bytearray(b"".join(parts))
            at = rng.randrange(len(buf))
            size = rng.choice([1, 1, 3, 200])
            how = rng.choice(["flip", "cut", "put"])
            if how == "flip":
                buf[at:at + size] = bytes(rng.randrange(256) for _ in range(min(size, len(buf) - at)))
            elif how == "cut":
                del buf[at:at + size]
            else:
                buf[at:at] = rng.choice([b"WARC/1.", b"\x1f\x8b\x08", b"\r\n\r\n", b"xyz"])
            got = list(op2_warc.salvage(bytes(buf)))
            assert sum(n for _, n, *_ in got) == len(buf)
            hit = at + (size if how != "put" else 0)
            safe = [b for b, x, y in zip(bodies, begins[:-1], begins[1:]) if y <= at or x >= hit]
            seen = [b for _, _, h, b, _ in got if h is not None]
            assert all(b in seen for b in safe)


def test_warc_page_numbers():
    assert [op2_warc.page_number(x) for x in (None, "", "7", "-3", "1;3", "9" * 19, "9" * 18, "x")] == [None, None, 7, -3, None, None, int("9" * 18), None]


def test_warc_large_pages_go_to_their_own_archives(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "x" * n) for i, n in enumerate([10, 70_000, 10, 5_000_000, 65_536, 80_000])], "page_id long, url string, html string").coalesce(1)
    op2_warc.write(pages, f"file://{tmp_path}/w")
    back = op2_warc.read(spark, f"file://{tmp_path}/w")
    assert {r["page_id"]: r["payload_bytes"] for r in back.collect()} == {0: 10, 1: 70_000, 2: 10, 3: 5_000_000, 4: 65_536, 5: 80_000}
    assert back.select("archive").distinct().count() == 3


# -- licenses

def test_license_scan(spark):
    rows = [(1, None, None), (2, "", None), (3, "Some text.\nReleased under the MIT License.\nMore.", None), (4, "Intro here. This work is licenced under the GNU General Public License, version 3. And so on.", None),
            (5, "A license to kill is what they gave him in the end of that long story.", None), (6, "word " * 50000 + "\nLicensed under CC BY-NC 4.0.", None), (6, "Licensed under CC BY 4.0.", None), (7, "Licensed under the Apache License, Version 2.0.\nAll rights reserved.", None)]
    got = [(r["doc_id"], r["licenses"]) for r in op4_licenses.scan(documents(spark, rows)).collect()]
    assert sorted(got) == [(1, ""), (2, ""), (3, "MIT"), (4, "GPL-3.0"), (5, ""), (6, "CC-BY-4.0"), (6, "CC-BY-NC-4.0"), (7, "Apache-2.0,all-rights-reserved")]
    r = op4_licenses.scan(documents(spark, rows[3:4])).collect()[0]["found"][0]
    assert rows[3][1][r["start"]:r["end"]].startswith("This work") and r["differences"] == "-licensed +licenced"
    assert op4_licenses.scan(documents(spark, [])).count() == 0


def test_license_templates_that_hardly_differ():
    some = tuple((f"L-{v}", f"Licensed under the Open Sample License, version {v}.0 of the year.") for v in range(1, 9))
    for name, text in some:
        assert [r[2::2] for r in op4_licenses.stretches(text, some, 0.34)] == [(name, [])]


def test_license_wrapped_notices():
    def names(text):
        return [r[2] for a, b in op4_licenses.candidates(text) for r in op4_licenses.stretches(text[a:b], op4_licenses.TEMPLATES, 0.34)]

    bsd = " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:\n *\n * 1. Redistributions"
    assert names("/*\n * Copyright (c) X\n *\n" + bsd) == ["BSD-3-Clause"]
    words = next(t for n, t in op4_licenses.TEMPLATES if t.startswith("Permission is hereby")).split()
    wrapped = "\n".join("# " + " ".join(words[i:i + 9]) for i in range(0, len(words), 9))
    assert names("MIT License\n\nCopyright (c) 2020 X\n\n" + wrapped) == ["MIT", "MIT"]
    assert names("// SPDX-License-Identifier: Apache-2.0\nint x;") == ["Apache-2.0"] and names("-- SPDX-License-Identifier: GPL-3.0-or-later") == ["GPL-3.0"]
    assert names("word " * 3000 + "text that is\nreleased under the\nMIT License. More " + "word " * 3000) == ["MIT"]
    assert names("Released under the licence of all rights, with a warranty.") == []
    gnu = op4_licenses.GNU.format("", 2).split()
    assert names("dnl " + "\ndnl ".join(" ".join(gnu[i:i + 8]) for i in range(0, len(gnu), 8))) == ["GPL-2.0"]


def test_license_compression_decides(monkeypatch):
    """Without savings nothing is found, and a template that saves more comes before one with the better wording."""
    class Same:
        def compress(self, raw):
            return b"x" * 10

    text = "Released under the MIT License. Licensed under CC BY 4.0."
    assert [r[2] for r in op4_licenses.stretches(text, op4_licenses.TEMPLATES, 0.34)] == ["MIT", "CC-BY-4.0"]
    with monkeypatch.context() as m:
        m.setattr(op4_licenses, "_PLAIN", Same())
        for t in op4_licenses.prepared(op4_licenses.TEMPLATES):
            m.setattr(t, "z", Same())
        assert op4_licenses.stretches(text, op4_licenses.TEMPLATES, 0.34) == []
    two = tuple((name, f"Licensed under the open sample terms of {word} year which anyone may read in full at the usual place of publication") for name, word in (("A", "this"), ("B", "that")))
    assert [r[2] for r in op4_licenses.stretches(two[1][1], two, 0.34)] == ["B"]

    class Worse:
        def __init__(self, z):
            self.z = z

        def compress(self, raw):
            return self.z.compress(raw) + b"x" * 8

    with monkeypatch.context() as m:
        t = op4_licenses.prepared(two)[1]
        m.setattr(t, "z", Worse(t.z))
        assert [r[2::2] for r in op4_licenses.stretches(two[1][1], two, 0.34)] == [("A", ["-this", "+that"])]


def plain_stretches(block, templates, most):
    """Every window with every template, every stretch of the window by plain edit distance."""
    import zstandard
    spans = [m.span() for m in op4_licenses.WORD.finditer(block)]
    words = [block[a:b].lower() for a, b in spans]

    def size(raw, text=None):
        held = zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if text else None
        return len(zstandard.ZstdCompressor(level=9, write_content_size=False, dict_data=held).compress(raw))

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, a in enumerate(x, 1):
            row, last = [i], row
            for j, b in enumerate(y, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] if a == b else 10 ** 9))
        return row[-1]

    out, left = [], [(0, len(words))]
    while left:
        begin, end = left.pop()
        cues = {max(k for k in range(len(words)) if spans[k][0] <= m.start()) for m in op4_licenses.CUE.finditer(block)} & set(range(begin, end))
        rows = []
        for name, text in templates:
            want = op4_licenses.WORD.findall(text.lower())
            own_raw, held = " ".join(want).encode(), " ".join(text.lower().split()).encode()
            unique = {w for w in want if not any(w in op4_licenses.WORD.findall(t.lower()) for n, t in templates if n != name)} if len(want) < op4_licenses.BRIEF else set()
            for c in cues:
                low, high = max(begin, c - int(len(want) * (1 + most))), min(end, c + int(len(want) * (1 + most)) + 1)
                raw = " ".join(words[low:high]).encode()
                saved = size(raw) - size(raw, held)
                if saved <= 0 or saved < op4_licenses.LEAST_SHARE * (size(own_raw) - size(own_raw, held)):
                    continue
                hits = [(distance(want, words[a:b]), a, b) for a in range(low, high) for b in range(a + 1, high + 1) if unique <= set(words[a:b])
                        and op4_licenses.CUE.search(block, spans[a][0], spans[b - 1][1])]
                hits = [h for h in hits if h[0] <= most * len(want)]
                if hits:
                    n, a, b = min(hits)
                    raw = " ".join(words[a:b]).encode()
                    rows.append((saved, size(raw, held) - size(raw), n, name))
        if rows:
            _, n, name = min(r[1:] for r in rows if r[0] >= op4_licenses.RUNNER_UP * max(r[0] for r in rows))
            out.append((name, n))
            return out  # the first winner; what is left depends on where its stretch is cut
    return out


def test_license_winner_equals_plain():
    rng = random.Random(12)
    some = tuple(t for t in op4_licenses.TEMPLATES if len(t[1]) < 110)[:24]
    for _ in range(40):
        words = rng.choice(some)[1].split()
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(words))
            words[at:at + rng.randint(0, 1)] = rng.choice([[], ["license"], ["other"]])
        block = " ".join(["see", "the"] + words + ["and", "so", "on"])
        expected = plain_stretches(block, some, 0.34)
        got = [(r[2], len(r[4])) for r in op4_licenses.stretches(block, some, 0.34)]
        assert {name for name, _ in expected} <= {name for name, _ in got} and bool(got) == bool(expected)


# -- HTML

def test_html_by_markup():
    page = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">menu</a></ul></nav><div class="ad">buy</div>
    <article><header>by me</header><h1>Head &amp; shoulders</h1><p><b>Bold</b>ly&nbsp;so<br><p>Second<!-- no --> part<div class="comments"><p>mine</div><aside>see also</aside><form>f</form>
    <p class="notice">beware</p><p>Last &lt;tag&gt; 3 < 4</article><footer>&copy; x &am"""
    assert op6_html.parted(page)[0] == "Head & shoulders Boldly so Second part Last <tag> 3 < 4"
    assert op6_html.parted("<main>a<section><article>b</article></section>c</main>")[0] == "b"
    assert op6_html.parted("<main>a <p>b</main>c")[0] == "a b"
    assert op6_html.parted("<article></article>")[0] == "" and op6_html.parted("")[0] is None


def test_html_articles_are_not_lost_to_a_part_of_a_class():
    assert op6_html.parted('<article class="post share-alike"><p>Body.</p></article>')[0] == "Body."
    assert op6_html.parted('<main id="share-main">Text</main>')[0] == "Text"
    assert op6_html.parted('<article>Kept <article class="thread comment">Reader</article></article>')[0] == "Kept"
    assert op6_html.parted('<article hidden>x</article><article>y</article>')[0] == "y"


def test_html_suffix_array(spark):
    rng = random.Random(6)
    boiler = "all of these words stand on every page of this one host"
    own = [sentence(rng, 30) + f" number{i} " + " ".join(f"w{i}x{j}" for j in range(20)) for i in range(5)]
    rows = [(i, "http://h.org/" + str(i), f"<div>{boiler}</div><p>" + " ".join(f"w{i}x{j}" for j in range(20)) + "</p>") for i in range(5)]
    rows += [(10, "http://other.org/", f"<div>{boiler}</div>"), (11, None, None), (12, "http://h.org/0", rows[0][2]), (13, "http://m.org/1", f"<article>{own[0]}</article>"), (14, "http://m.org/2", f"<article>{own[0]}</article>"), (14, "http://m.org/2", f"<article>{own[0]}</article>")]
    got = {r["page_id"]: r for r in op6_html.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")).collect()}
    for i in range(5):
        assert got[i]["text"] == " ".join(f"w{i}x{j}" for j in range(20)) and got[i]["n_boilerplate"] == 12
    assert got[10]["text"] == boiler and got[11]["text"] == "" and got[12]["text"] == got[0]["text"] and got[13]["text"] == got[14]["text"] == own[0]
    assert op6_html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_covered_equals_brute_force():
    rng = random.Random(8)
    for _ in range(60):
        streams = [[rng.choice("abc") for _ in range(rng.randint(0, 25))] for _ in range(4)]
        page = [rng.randint(0, 3) for _ in streams]
        runs = defaultdict(set)
        for s, p in zip(streams, page):
            for i in range(len(s) - 3):
                runs[tuple(s[i:i + 4])].add(p)
        want = [[any(len(runs[tuple(s[j:j + 4])]) > 1 for j in range(max(0, i - 3), min(i, len(s) - 4) + 1)) for i in range(len(s))] for s in streams]
        assert [f.tolist() for f in op6_html.covered(streams, page, 4)] == want


def test_html_repeats_over_a_whole_host(spark):
    """Each notice stands on two pages of a host with 1,500, far apart, and one page is left over by any cut into groups."""
    def own(i):
        return " ".join(f"w{i}x{j}" for j in range(12))

    def notice(i):
        return " ".join(f"n{i}y{j}" for j in range(9))

    n = 1500
    rows = [(i, f"http://big.org/{i}", f"<div>{notice(i % (n // 2))}</div><p>{own(i)}</p>") for i in range(n)]
    rows += [(n + i, f"http://small{i}.org/", f"<div>{notice(i)}</div>") for i in range(5)] + [(n + 10 + i, "http://copy.org/", f"<div>{notice(i)}</div>") for i in (7, 7)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(11)
    for r in op6_html.extract(df).collect():
        if r["page_id"] < n:
            assert (r["text"], r["n_side"], r["n_boilerplate"]) == (own(r["page_id"]), 21, 9)
        else:
            assert r["text"].startswith("n") and r["n_boilerplate"] == 0  # alone on its host, or only on equal pages


def test_html_repeats_decide_where_a_class_only_partly_matches(spark):
    """Markup alone dropped both, the section on related work and the license note; and an article's page was never decided by repeats."""
    def words(name, n):
        return " ".join(f"{name}{j}" for j in range(n))

    note = words("licensed", 11)
    rows = [(i, f"http://h.org/{i}", f"<nav>{words('menu', 9)}</nav><article><h1>{words(f'own{i}x', 10)}</h1><section class='related-work'>{words(f'prior{i}x', 9)}</section>"
                f"<div class='share-alike-note'>{note}</div><p>{words('quoted', 10)}</p></article><footer>end</footer>") for i in range(3)]
    rows += [(9, "http://alone.org/", rows[0][2]), (10, "http://alone.org/same", rows[0][2])]
    for r in op6_html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect():
        i = r["page_id"] if r["page_id"] < 3 else 0
        kept = [words(f"own{i}x", 10), words(f"prior{i}x", 9)] + [note] * (r["page_id"] >= 9) + [words("quoted", 10)]
        assert (r["text"], r["n_side"], r["n_boilerplate"]) == (" ".join(kept), 30, 21 if r["page_id"] < 3 else 0)  # the note, the menu and the footer


def test_html_classes():
    for out in ("ad", "Sidebar", "navLeft", "site-footer", "cookie-bar", "comment-list", "ad-slot-2", "x menu_item"):
        assert op6_html.parted(f"<article>a<div class='{out}'>b</div></article>")[0] == "a", out
    for unsure in ("related-work", "share-alike", "notices-to-airmen"):
        assert op6_html.parted(f"<article>a<div class='{unsure}'>b</div></article>")[::2] == (None, [2, 1]), unsure
    assert op6_html.parted("<article>a<div class='loaded headline'>b</div></article>")[0] == "a b"
    assert op6_html.parted("<main>a<div class='related-work'><article>b</article></div></main><p>c</p>")[1:] == (["a", "b", "c"], [2, 1, 0])
    assert op6_html.parted("<div class='related-work'><article>b</article></div><p>c</p>")[1:] == (["b", "c"], [1, 1])


# -- chat

def test_chat(spark):
    rows = [(1, 0, "user", "How do I do this?"), (1, 1, "assistant", "Like so.\nStep one."), (2, 0, None, "User: hello there\nAssistant: hi\nand more\n\nHuman: bye"), (3, 0, "weird", None), (3, 1, "user", ""), (3, 2, "system", "### Assistant\nfine"),
            (1, 0, "user", "How do I do this?"), (None, None, None, "<|im_start|>user\nq<|im_end|>")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, roles int").drop("roles")
    got = {(r["conv_id"], r["turn"]): r for r in op1_chat.format_turns(docs, op1_chat.train(docs)).collect()}
    assert got[1, 1]["rendered"] == "<|assistant|>\nLike so.\nStep one.\n<|end|>\n"
    assert got[2, 0]["roles"] == "user,assistant,user" and "hi\nand more" in got[2, 0]["rendered"]
    assert got[3, 0]["n_turns"] == 0 and got[3, 1]["roles"] == "user" and got[3, 2]["roles"] == "assistant"
    assert op1_chat.format_turns(docs.limit(0), op1_chat.train(docs.limit(0))).count() == 0


def test_viterbi_is_the_best_path():
    chain = op1_chat.Chain({("length", "short", "user"): 9, ("length", "long", "assistant"): 9, ("shape", "plain", "user"): 3, ("end", "question", "user"): 4, ("end", "other", "assistant"): 5}, {("user", "assistant"): 5, ("assistant", "user"): 4})
    some = [(None, "why?"), ("assistant", "x" * 200), (None, "ok"), (None, "y" * 300)]

    def score(path):
        total = chain.first[path[0]]
        for i, (mark, line) in enumerate(some):
            if i:
                total += (chain.change if mark else chain.stay)[path[i - 1], path[i]]
            total += sum(chain.shows.get((f, v), np.zeros(4))[path[i]] for f, v in zip(op1_chat.FEATURES, op1_chat.features(line)))
            if mark:
                total += np.log(0.99 if op1_chat.ROLES[path[i]] == mark else 0.01 / 3)
        return total
    best = max(itertools.product(range(4), repeat=4), key=score)
    assert chain.roles(some, None) == [op1_chat.ROLES[i] for i in best]


def test_letters_are_letters():
    assert not any(op9_language.LETTER.search(x) for x in ("²³", "½", "Ⅷ", "①", "12 _ .", "")) and all(op9_language.LETTER.search(x) for x in ("a", "é", "漢", "ª", "ʰ"))


def test_quality_runs_are_of_characters():
    from labelloom.llm.words import Words
    texts = ["ab", "äöü漢字", "", "x😀yz", "abcdé"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    doc, dim = op5_quality.features(Words(data, offsets, op5_quality.IS_WORD, op5_quality.FOLD), data, offsets)[2]
    assert np.bincount(doc, minlength=5).tolist() == [max(0, len(t) - 3) for t in texts] and len(dim) == len(doc)


def test_quality_model_does_not_depend_on_row_order(spark):
    rng = random.Random(9)
    rows = [(i, sentence(rng, 40), None) for i in range(40)] + [(i, "spam " * 30 + sentence(rng, 5), None) for i in range(40, 80)] + [(i % 80, sentence(rng, 30), None) for i in range(20)]
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)], "doc_id long, quality int")
    models = [op5_quality.train(documents(spark, some), labels) for some in (rows, rows[::-1])]
    p = [[r["quality_p"] for r in op5_quality.judge(documents(spark, rows), m).orderBy("doc_id", "text").collect()] for m in models]
    assert p[0] == p[1]


def test_clashing_columns_are_replaced(spark):
    rows = [(1, "Some words: mail a.b@c.org now. Released under the MIT License.", "en")]
    docs = documents(spark, rows)
    clash = {c: F.lit("old") for c in ("n_words", "n_hit", "found", "licenses", "kept", "quality_p", "n_tokens", "IDS_SHA256", "spans", "n_email", "fp", "contaminated")}
    wide = docs.withColumns(clash)
    bench = spark.createDataFrame([("i", "nothing here")], "item_id string, text string")
    for out, name in ((op10_pii.find(wide), "spans"), (op4_licenses.scan(wide), "licenses"), (op5_quality.judge(wide, None), "n_words"), (op7_bpe.encode_documents(wide, vocabulary_path()), "ids_sha256"),
                      (op8_simhash.fingerprints(wide), "fp"), (op3_decontaminate.overlaps(wide, bench), "n_hit")):
        assert len({c.lower() for c in out.columns}) == len(out.columns)
        row = out.collect()[0]
        assert row[name] != "old" and row["source"] == "s"

"""The pipeline against a plain chain on made-up documents, its edge cases, and the queries that SQL cannot express."""
import hashlib
import random

import pytest

from labelloom.llm import op10_pii
from labelloom.llm.queries import ORACLE, QUERIES, vocabulary_path
from test_operators import documents, plain_components, plain_fingerprint, plain_overlap, sentence

import corpus_pipeline

GERMAN = "der die das haus wasser und grünen läuft lang feld stein fluss gemacht mit unter einige andere zeit ort schöne straße über für nicht auch".split()


def made_up():
    rng = random.Random(31)
    english = [(i, sentence(rng, rng.randint(40, 90)), "en") for i in range(40)]
    german = [(100 + i, sentence(rng, rng.randint(40, 90), GERMAN), "de") for i in range(40)]
    items = [("b1", " ".join(f"item{i}" for i in range(13))), ("b2", " ".join(f"other{i}" for i in range(20))), (None, "the of"), ("b3", None)]
    odd = [(200, None, "en"), (201, "", "de"), (202, "12 ²³ -- 4", "en"),  # no letters
           (203, english[0][1], "en"), (204, english[0][1], None), (None, english[1][1], "en"), (50, german[2][1].upper(), "de"),  # copies
           (205, english[2][1] + " " + items[0][1], "en"), (206, items[1][1] + " und " + german[3][1], "de"),  # contaminated
           (207, english[4][1] + " mail a.b@example.org or 10.0.0.1, card 4111 1111 1111 1111 and more words of it", "en"),
           (208, " ".join(sentence(rng, 90) for _ in range(300)), "en"), (33, english[33][1], "en")]  # long, a repeated row
    return english + german + odd, items


def plain_chain(rows, items, languages):
    """Stage by stage; the trained language model is asked row by row, everything else is worked out anew."""
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary_path())
    rows = [r for r in rows if languages[r[1]]]
    groups = {}
    for row, c in zip(rows, plain_components([plain_fingerprint(t) for _, t, _ in rows])):
        groups.setdefault(c, []).append(row)
    rows = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    rows = [r for r in rows if not plain_overlap(r[1], [x for x in items if x[0] is not None])[-1]]
    out = []
    for i, text, _ in rows:
        ids = lib.encode(op10_pii.masked(text), add_special_tokens=False).ids
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    return out


def test_pipeline_equals_a_plain_chain(spark, tmp_path):
    from labelloom.llm import op9_language
    rows, items = made_up()
    docs = documents(spark, rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    asked = op9_language.predict(docs, op9_language.train(docs)).collect()
    languages = {r["text"]: r["lang_pred"] != "und" and r["score"] >= 0.5 for r in asked}
    assert not languages[None] and not languages[""] and not languages["12 ²³ -- 4"] and sum(languages.values()) > 80
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_chain(rows, items, languages), key=str)


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    rows, items = made_up()
    docs = documents(spark, rows)
    spark.createDataFrame(items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and 0 < out.count() <= docs.count(), name
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, sf, name):
    """Those with a twin are compared in tests/test_oracle.py."""
    got = QUERIES[name](spark, sf)
    assert got.count() > 0 and len(set(got.columns)) == len(got.columns)

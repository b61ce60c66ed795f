"""Every operator on odd rows, on an empty table, and with columns whose names clash with its own."""

import os

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cartwise.llm import bpe, langid, lattice, licenses, mixing, pii, repeats, rules, simhash, tokens
from cartwise.llm.common import _scopes, cleared, scratch

from .conftest import ODD

@pytest.fixture(autouse=True)
def short_training(monkeypatch):
    """What the taggers find is tested elsewhere."""
    monkeypatch.setattr(pii, "STEPS", 5)


LABELS = "doc_id long, quality int, toxic int"
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_FILE = public_tokenizers.path("byte_bpe_50k.json")


def stored_tokens(docs):
    path = scratch(docs.sparkSession)
    tokens.write(docs, path, BYTE_FILE)
    return tokens.read_documents(docs.sparkSession, path)


def quality(docs):
    labels = docs.sparkSession.createDataFrame([(7, 1, 0), (7, 0, None), (None, 1, 1), (4, None, 0)], LABELS)
    return rules.quality(docs, labels)


OPERATORS = {
    "tokens": stored_tokens, "licenses": licenses.scan, "langid": langid.identify, "mixing": mixing.mix,
    "repeats": repeats.remove_repeats, "pii": lambda d: pii.find(d, pii.fit(d)), "simhash": simhash.near_duplicates,
    "bpe": lambda d: bpe.digests(d, WORD_FILE), "rules": quality,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_keep_their_ids(docs_of, name):
    made = OPERATORS[name](docs_of(ODD)).collect()
    key = lambda i: (i is None, i or 0)
    assert sorted((r.doc_id for r in made), key=key) == sorted((r[0] for r in ODD), key=key)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(docs_of, name):
    assert OPERATORS[name](docs_of(ODD).where("false")).collect() == []


def test_odd_rows_have_the_stated_results(docs_of):
    docs = docs_of(ODD)
    fps = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert fps[(1, 0)] == fps[(2, 0)] == fps[(3, 0)] == 1
    assert [v for (i, _), v in fps.items() if i is None] == [5]
    said = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert said[1].lang_pred == said[2].lang_pred == said[3].lang_pred == "und" and said[1].score == 0
    assert not said[None].held_out
    cut = {r.doc_id: r for r in repeats.remove_repeats(docs).collect()}
    assert (cut[1].n_bytes, cut[1].n_removed, cut[4].n_bytes, cut[6].n_bytes) == (0, 0, 1, len(ODD[7][1].encode()))
    first = {r.doc_id: r for r in stored_tokens(docs).collect()}
    assert first[None].start == 0 and first[1].n_tokens == 1  # null ids come first; an empty text is its end id
    words = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert (words[1].n_words, words[3].n_words, words[7].n_words, words[1].labels) == (0, 0, 60, "")
    taken = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert taken[1].taken == 0 and taken[7].size == 60 and taken[None].source_size == 9
    kept = {r.doc_id: r for r in quality(docs).collect()}
    assert kept[1].base_failed and kept[7].n_repeat_words == 60 and not kept[7].kept


@pytest.mark.parametrize("stage", [
    lambda d: simhash.survivors(d), lambda d: pii.mask(d, pii.fit(d)), lambda d: mixing.mixed(d),
    lambda d: rules.keep(d, d.sparkSession.createDataFrame([], LABELS)),
])
def test_stages_keep_all_columns(docs_of, stage):
    docs = docs_of(ODD)
    made = stage(docs)
    assert made.columns == docs.columns
    assert all(r["row"] == "clash" for r in made.collect())
    assert stage(docs.where("false")).collect() == []


def test_one_of_each_group_stays(docs_of):
    made = [(r.doc_id, r.text) for r in simhash.survivors(docs_of(ODD)).collect()]
    assert len(made) == len(set(made)) == 5
    assert {i for i, _ in made} == {1, 4, 5, 6, 7}


def test_tables_made_on_the_way_are_deleted(spark, docs_of):
    with cleared(spark):
        kept = sorted(r.doc_id for r in simhash.survivors(docs_of(ODD)).collect())
        inside = [p for p in _scopes[-1]]
        assert inside and all(os.path.exists(p) for p in inside)
    assert kept == [1, 4, 5, 6, 7] and not any(os.path.exists(p) for p in inside) and not _scopes


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.01], 0), (3, [1.0, 0.0], 1), (4, None, 0), (5, [0.0, 0.0], 0), (6, [1.0, None], 0),
            (7, [float("nan"), 1.0], 0), (8, [1.0, 0.0], None), (None, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (9, [1.0, 0.0, 0.0], 0),
            (10, [float("inf"), 1.0], 0), (11, [], 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("cid", F.lit("clash")).withColumn("n", F.lit(1))
    made = lattice.near_duplicates(vectors).collect()
    assert len(made) == len(rows)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in made}
    assert found[1] == (3, 1, True) and found[2] == (3, 1, False) and found[None] == (3, 1, False)
    assert all(found[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11))
    assert lattice.near_duplicates(vectors.where("false")).collect() == []

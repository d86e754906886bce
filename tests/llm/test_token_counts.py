"""Totals after inserts, deletes, revisions and repeated batches."""

from collections import Counter

import public_tokenizers
from llm_helpers import frame  # noqa: F401
from tokenizers import Tokenizer

from linepulse.llm import token_counts as t
from linepulse.scratch import fresh_path

BPE = public_tokenizers.path("byte_bpe_50k.json")
VERSIONS = {"words": None, "bpe": BPE}
ROWS = [
    (1, "some text here", "a", "en"), (2, "more", "a", "en"), (3, None, None, "de"), (4, "", "b", None),
    (5, "ein Text " * 900, "b", "de"), (1, "some text here", "a", "en"), (None, "no id", "a", "en"),
]


def plain(rows):
    tokenizer = Tokenizer.from_file(BPE)
    docs, tokens = Counter(), Counter()
    for _, text, source, lang in rows:
        for version in VERSIONS:
            n = len((text or "").split()) if version == "words" else len(tokenizer.encode(text or "").ids)
            docs[source, lang, version] += 1
            tokens[source, lang, version] += n
    return {(*k, docs[k], tokens[k]) for k in docs}


def test_batches(spark, frame):
    docs = frame([(*r, "x") for r in ROWS], "doc_id long, text string, source string, lang string, version string")
    rows = t.counts(docs, VERSIONS)
    rollup = t.Rollup(spark, fresh_path(spark, "rollup"))
    assert rollup.totals().count() == 0
    assert rollup.commit("one", t.inserted(rows))
    assert not rollup.commit("one", t.inserted(rows))
    assert {tuple(r) for r in rollup.totals().collect()} == plain(ROWS)
    assert rollup.commit("two", t.deleted(rows.where("doc_id = 2")))
    new = frame([(5, "kurz", "c", "de", "x")], docs.schema)
    assert rollup.commit("three", t.revised(rows.where("doc_id = 5"), t.counts(new, VERSIONS)))
    left = [r for r in ROWS if r[0] not in (2, 5)] + [(5, "kurz", "c", "de")]
    assert {tuple(r) for r in rollup.totals().collect()} == plain(left)
    assert rollup.batches() == ["one", "three", "two"]


def test_a_batch_that_failed_is_written_anew(spark, frame):
    docs = frame([(*r, "x") for r in ROWS], "doc_id long, text string, source string, lang string, version string")
    rollup = t.Rollup(spark, fresh_path(spark, "rollup"))
    rows = t.inserted(t.counts(docs, {"words": None}))
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{rollup.folder}/one")
    assert rollup.totals().count() == 0
    assert rollup.commit("one", rows)
    assert {tuple(r) for r in rollup.totals().collect()} == {r for r in plain(ROWS) if r[2] == "words"}


def test_empty(spark, frame):
    docs = frame([], "doc_id long, text string, source string, lang string")
    rollup = t.Rollup(spark, fresh_path(spark, "rollup"))
    assert rollup.commit("none", t.inserted(t.counts(docs, VERSIONS)))
    assert rollup.totals().count() == 0

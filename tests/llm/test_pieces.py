"""Ids and decoded texts against the library, text by text."""

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import frame  # noqa: F401

from linepulse.llm import chunked, packs, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PARTS = [" ", "  ", "\n", "\t ", "a", "Été", "don't", "▁", "▁▁", " the", "日本", "😀", "\x00", "<s>", "<unk>", "　", "x" * 30]
TEXTS = [
    "", None, " ", "  ", "a ", " a", "a  b", "▁", "a▁▁b ▁", "\x00a", " \n b", "日本語のテキスト", "😀 😀", "<s> </s> <unk> <0x41>",
    "word " * 50_000, "x" * 20_000, " " * 20_000, "ends in two  ",
]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12))
def test_marked_words_one_after_another_are_the_whole(parts):
    text, of = "".join(parts), pieces.model(MODEL)
    assert of.apart
    assert [i for part in of.chunks(text) for ids in of.segment(part) for i in ids] == library.encode(text)


def test_long_texts_are_taken_apart_in_slices(monkeypatch):
    monkeypatch.setattr(packs, "SLICE", 7)
    of = pieces.model(MODEL)
    for text in ("one two  three   four five six", "    ", "a" * 40, " a  b" * 9):
        parts = list(of.chunks(text))
        assert [i for part in parts for ids in of.segment(part) for i in ids] == library.encode(text)
    assert len(parts) > 3


def expected(rows):
    return sorted(((d, library.encode(t or ""), library.decode(library.encode(t or ""))) for d, t in rows), key=repr)


def test_rows_of_all_kinds(frame):
    rows = [*enumerate(TEXTS), (3, "twice"), (3, "twice"), (3, "other"), (None, "no id"), (None, None), (-1, "negative")]
    docs = frame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, ids string, pack int")
    got = pieces.encode_decode(docs, MODEL)
    assert got.columns == ["doc_id", "ids", "text"]
    assert sorted(((r.doc_id, r.ids, r.text) for r in got.collect()), key=repr) == expected(rows)


@pytest.mark.parametrize("chunks", [1, 40])
def test_many_packs(frame, chunks):
    rows = [(i, f"word{i % 7} of {i} and the  same again") for i in range(300)]
    docs = frame(rows, "doc_id long, text string").repartition(chunks)
    got = pieces.encode_decode(docs, MODEL).collect()
    assert sorted(((r.doc_id, r.ids, r.text) for r in got), key=repr) == expected(rows)


def test_packs_of_the_same_rows(frame):
    same = [(1, "a text"), (None, "of no id")] * 20
    docs = frame(same, "doc_id long, text string").coalesce(1)
    docs = docs.union(docs).union(docs)
    got = pieces.encode_decode(docs, MODEL).collect()
    assert sorted(((r.doc_id, r.ids, r.text) for r in got), key=repr) == expected(same * 3)


def test_empty(frame):
    assert pieces.encode_decode(frame([], "doc_id long, text string"), MODEL).count() == 0


def test_each_distinct_word_is_segmented_once():
    seen = []
    of = pieces.Model(MODEL)

    class Counting(pieces.Model):
        def __init__(self):
            self.__dict__.update(of.__dict__)

        def segment(self, chunks):
            seen.extend(chunks)
            return super().segment(chunks)

    words = ["the", "a", "blue", "the"]
    rows = [{"bucket": b, "pack": str(n), "kind": 0, **_dictionary(words[n:])} for b in (0, 1) for n in (0, 1, 2)]
    batch = chunked.pa.RecordBatch.from_pylist(rows, schema=chunked._SCHEMA)
    list(chunked._segmented(Counting)(iter([batch])))
    assert sorted(seen) == sorted(["the", "a", "blue"] * 2)


def _dictionary(words):
    import numpy as np

    words = list(dict.fromkeys(words))
    return {
        "codes": packs.shrunk(np.ones(len(words), np.int32)),
        "lengths": packs.shrunk(np.array([len(w) for w in words], np.int32)),
        "body": chunked.zstandard.compress("".join(words).encode()),
    }


def test_a_pack_that_is_not_whole_is_noticed():
    import numpy as np

    row = {"pack": "p", "codes": packs.shrunk(np.array([0, 1, 2], np.int32)), "lengths": packs.shrunk(np.array([3], np.int32)), "body": packs.shrunk(np.array([7, 1], np.int64))}
    one = (np.array([0]), np.array([1], np.int32), np.array([5], np.int32))
    with pytest.raises(RuntimeError, match="not whole"):
        list(chunked._assembled(None, None).__closure__[0].cell_contents(row, [one]))

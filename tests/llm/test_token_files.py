"""Exact round trips of ids, and what a reader reads."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow import fs
from tokenizers import Tokenizer
from llm_helpers import frame  # noqa: F401

from linepulse.llm import token_files

BPE = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
whole = Tokenizer.from_file(BPE)
encode, _ = token_files.encoder(BPE)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t ", "a", "Été", "don't", "'s", " 12", "Qu'x", "¼", "ß", "ſ", "\x1c", "...", " ", "<|endoftext|>", "\x00", "日本", "😀"]), max_size=14))
def test_taken_apart_is_encoded_like_whole(parts):
    text = "".join(parts)
    ids = np.frombuffer(encode([text])[0], "<u2").tolist()
    assert ids == whole.encode(text, add_special_tokens=False).ids


def test_a_piece_of_many_texts_is_looked_up_once(monkeypatch):
    asked = []
    find = token_files._Known.find
    monkeypatch.setattr(token_files._Known, "find", lambda self, pieces, how: asked.append(len(pieces)) or find(self, pieces, how))
    texts = [" ".join(f"wordy{(i + j) % 20}" for j in range(500)) for i in range(40)]
    got = [np.frombuffer(x, "<u2").tolist() for x in encode(pa.array(texts))]
    assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    # 20 pieces with their blanks, the first one of each text; the words of new ones; 20,000 pieces in all.
    assert sum(asked) <= 20 + 40 + 80


@pytest.mark.parametrize("size", [1, 40, 1 << 23])
def test_texts_of_several_slices(monkeypatch, size):
    monkeypatch.setattr(token_files, "_TEXTS", size)
    monkeypatch.setattr(token_files, "_CACHED", 3)
    texts = ["left out", " two  blanks", None, "", "a b", "x <|endoftext|> y", "\0 \0", " ", "Été 日本 don't", "end\n\n", "a b a\n b", "x" * 50]
    texts = [*texts, *texts[::-1]]
    want = [whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    fresh, _ = token_files._load(BPE)
    assert fresh([""]) == [b""]
    for kind in (pa.string(), pa.large_string()):
        got = fresh(pa.array(texts, kind).slice(1))
        assert [np.frombuffer(x, "<u2").tolist() for x in got] == want[1:]
    assert fresh([]) == []
    assert [np.frombuffer(x, "<u2").tolist() for x in fresh(texts)] == want


ROWS = [
    (7, "some text"), (3, ""), (3, None), (None, "no id"), (12, "word " * 30_000), (5, "ünïcode 😀"),
    (12, "twice"), (12, "twice"), (-4, "negative id"),
]


@pytest.mark.parametrize("path", [BPE, WORDS])
def test_round_trip(frame, path):
    docs = frame([(*r, "x", 1) for r in ROWS], "doc_id long, text string, ids string, part int")
    got = token_files.round_trip(docs, path, files=3).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(path)
    ids = {r: [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in ROWS}
    assert [r.doc_id for r in got] == [None, -4, 3, 3, 5, 7, 12, 12, 12]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    want = sorted((d or 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (d, t), x in [(r, ids[r]) for r in ROWS])
    assert sorted((r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == want


def test_empty(frame):
    assert token_files.round_trip(frame([], "doc_id long, text string"), BPE).count() == 0


def write(path, docs, frame_bytes):
    with fs.LocalFileSystem().open_output_stream(str(path), compression=None) as out:
        writer = token_files.Writer(out, 2, frame_bytes)
        for doc_id, ids in docs:
            writer.add(doc_id, np.array(ids, "<u2").tobytes())
        writer.close()


def test_a_reader_reads_the_frames_it_needs(tmp_path):
    docs = [(i, list(range(i, i + 50))) for i in range(40)]
    write(tmp_path / "x.zst", docs, 400)
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "x.zst")) as file:
        reader = token_files.Reader(file)
        assert len(reader.packed) == 10
        seen = []
        frame = reader.frame
        reader.frame = lambda i: seen.append(i) or frame(i)
        assert reader.ids(17).tolist() == docs[17][1]
        assert reader.ids(39).tolist() == docs[39][1]
        assert seen == [4, 9]
    raw = (tmp_path / "x.zst").read_bytes()
    plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert np.frombuffer(plain, "<u2").tolist() == [x for _, ids in docs for x in ids]


def test_a_damaged_frame_is_noticed(tmp_path):
    write(tmp_path / "x.zst", [(1, [5] * 300), (2, list(range(300)))], 100)
    raw = bytearray((tmp_path / "x.zst").read_bytes())
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "x.zst")) as file:
        at = int(token_files.Reader(file).at[1])
    raw[at + 20] ^= 1
    (tmp_path / "y.zst").write_bytes(raw)
    with fs.LocalFileSystem().open_input_file(str(tmp_path / "y.zst")) as file:
        reader = token_files.Reader(file)
        assert reader.ids(0).tolist() == [5] * 300
        with pytest.raises((ValueError, zstandard.ZstdError)):
            reader.ids(1)

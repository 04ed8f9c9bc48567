import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from regcurate.llm import packing, token_files
from regcurate.llm.tokens import tokenizer

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
_pieces = st.sampled_from(["a", "the", " ", "  ", "\n", "\t", "\r", ",", "'s", "don't", "É", "é",
                           "é", "́", "ß", "İ", "Σ", " ", " ", "\x1c", "\x85",
                           "7", "42", "½", "$$$", "<|endoftext|>", "中文", "😀", "_", "\0", "ab-c"])


def _direct(path, texts):
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    return [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path", [WORD, BYTE])
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.lists(_pieces, max_size=14).map("".join), min_size=1, max_size=6))
def test_parts_equal_direct_encoding(path, texts):
    ids, off = tokenizer(path).encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == _direct(path, texts)


def _expected(df, path, end):
    rows = df.select("doc_id", "text").collect()
    ids = _direct(path, [r.text or "" for r in rows])
    return [(r.doc_id, np.array([*i, end], "<u4")) for r, i in zip(rows, ids)]


def test_token_files_round_trip(edge, empty, documents):
    for df in (edge, documents):
        want = sorted(_expected(df, WORD, 2), key=lambda r: (r[0] is not None, r[0] or 0))
        got = sorted(token_files.encode_and_read(df, WORD, 2, "<u2").collect(),
                     key=lambda r: r.start)
        assert [r.doc_id for r in got] == [d for d, _ in want]
        assert sorted((r.doc_id or -1, r.n_tokens, r.ids_crc32) for r in got) == sorted(
            (d or -1, len(i), zlib.crc32(i.tobytes())) for d, i in want)
        assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert token_files.encode_and_read(empty, WORD, 2).count() == 0


def test_reader_fetches_single_frames_and_finds_damage():
    out, docs = io.BytesIO(), [np.arange(k * 50) % 40000 for k in range(6)]
    writer = token_files.TokenFileWriter(out, "<u2")
    for k, ids in enumerate(docs):
        writer.add(None if k == 3 else k, ids)
    writer.close()
    reader = token_files.TokenFileReader(io.BytesIO(out.getvalue()))
    assert reader.doc_ids == [0, 1, 2, None, 4, 5]
    for k in (5, 0, 3, 4):
        assert reader.read(k).tolist() == docs[k].tolist()
    import zstandard
    plain = zstandard.ZstdDecompressor().stream_reader(
        io.BytesIO(out.getvalue()), read_across_frames=True).read()
    assert plain == b"".join(d.astype("<u2").tobytes() for d in docs)
    broken = bytearray(out.getvalue())
    broken[20] ^= 0xFF
    with pytest.raises(Exception):
        bad = token_files.TokenFileReader(io.BytesIO(bytes(broken)))
        for k in range(len(bad)):
            bad.read(k)


def test_packing(edge, empty, documents):
    for df, groups in ((edge, 4), (documents, 60)):
        rows = packing.pack(df, BYTE, 0, 128, group_docs=groups).collect()
        got, seqs = {}, {}
        for r in rows:
            got.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
            seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        want = {}
        for d, ids in _expected(df, BYTE, 0):
            cut = [(a, len(ids[a:a + 128]), zlib.crc32(ids[a:a + 128].tobytes()))
                   for a in range(0, len(ids), 128)]
            want.setdefault((d, len(ids)), []).extend(cut)
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
        for pieces in seqs.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 128
    assert packing.pack(empty, BYTE).count() == 0


@given(st.lists(st.integers(1, 50), max_size=80))
@settings(max_examples=50, deadline=None)
def test_first_fit_decreasing(sizes):
    bins, offsets = packing.first_fit_decreasing(np.array(sizes, np.int64), 50)
    room, want = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
        if b == len(room):
            room.append(50)
        want[i] = (b, 50 - room[b])
        room[b] -= sizes[i]
    assert [(int(b), int(o)) for b, o in zip(bins, offsets)] == [want[i] for i in range(len(sizes))]


def test_ids_beyond_the_file_type_are_an_error():
    writer = token_files.TokenFileWriter(io.BytesIO(), "<u2")
    writer.add(1, np.array([0, 65_535], "<u4"))
    with pytest.raises(ValueError, match="65536 of document 2"):
        writer.add(2, np.array([65_536], "<u4"))


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_known_parts_cost_no_call_each(path, monkeypatch):
    tok, calls = tokenizer(path), []
    texts = pa.array(["the cat, the dog\nand 7 cats' Élan ", " two  spaces\tand\x1c one", "", None])
    piece = tok._piece
    monkeypatch.setattr(tok, "_piece", lambda part: calls.append(part) or piece(part))
    ids, off = tok.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(off[:-1], off[1:])] == _direct(
        path, [t or "" for t in texts.to_pylist()])
    calls.clear()
    again, _ = tok.encode(texts)
    assert again.tolist() == ids.tolist() and not calls

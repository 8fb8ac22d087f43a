"""Token counts and SentencePiece against the libraries."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cdmloom.llm import sentencepiece_codec as sp
from cdmloom.llm import token_counts as tc
from tests.llm import samples


def counted(text):
    return len(Tokenizer.from_file(public_tokenizers.path(tc.TOKENIZER)).encode(text or "", add_special_tokens=False))


def test_counts_are_the_librarys(spark):
    rows = samples.ROWS + [(r[0] + 100, *r[1:]) for r in samples.texts()]
    got = tc.count_tokens(samples.clashing(samples.documents(spark, rows)), slots=50, cached=100).collect()
    want = Counter((i, len((t or "").encode()), n := counted(t), n > 1024) for i, t, *_ in rows)
    assert Counter(tuple(r) for r in got) == want


@pytest.mark.parametrize("text", ["it's we'll I'D 'S", "a  b   c \n\n\td  ", "x1½²3 ٣ ﬁ", "a\x85b\xa0 c", "\x1f \x1c", "'", "''s", "<|endoftext|>", "é́ ʼn ǅ", " ", "  "])
def test_cutting(text):
    path = public_tokenizers.path(tc.TOKENIZER)
    cut = tc.pre_tokens(text, path)
    if cut is not None:
        assert "".join(cut) == text
        pre = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str(text)
        assert [text[a:b] for _, (a, b) in pre] == cut
    assert tc.Lengths({}, path, 10).tokens(text) == counted(text)


def test_every_plain_code_point_is_cut_as_the_library_does():
    path = public_tokenizers.path(tc.TOKENIZER)
    pre = Tokenizer.from_file(path).pre_tokenizer
    for c in map(chr, [*range(0x1C), *range(0x20, 0x250), *range(0x2010, 0x2028), 0x20AC]):
        text = f"a{c}{c}b {c}1 {c}! {c}"
        assert tc.pre_tokens(text, path) == [text[a:b] for _, (a, b) in pre.pre_tokenize_str(text)], hex(ord(c))


def test_bounded_cache_and_summaries(spark):
    lengths = tc.Lengths({" the": 1}, public_tokenizers.path(tc.TOKENIZER), 2)
    for t in ("alpha beta gamma delta", "the the epsilon"):
        assert lengths.tokens(t) == counted(t)
        assert len(lengths) <= 3
    docs = samples.documents(spark, [(i, "the the cat" + " rare" * 0 + f" w{i}", None, None, 0) for i in range(200)])
    best = tc.frequent_pre_tokens(docs, slots=2, counted=10, summary=5)
    assert set(best) == {" the", " cat"} or " the" in best


def test_empty_table(spark):
    empty = samples.documents(spark, [])
    assert tc.count_tokens(empty).count() == 0
    assert sp.digests(empty).count() == 0
    assert sp.encode(empty).count() == 0


def library():
    return SentencePieceProcessor(model_file=public_tokenizers.path(sp.MODEL))


def test_ids_spans_and_decoding(spark):
    rows = samples.ROWS + [(r[0] + 100, *r[1:]) for r in samples.texts()]
    lib = library()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = Counter((i, len(ids := lib.encode(t or "")), sha(",".join(map(str, ids))), sha(lib.decode(ids))) for i, t, *_ in rows)
    got = sp.digests(samples.clashing(samples.documents(spark, rows)))
    assert Counter(tuple(r)[:4] for r in got.collect()) == want
    for r in sp.encode(samples.documents(spark)).collect():
        pass
    texts = Counter((i, t or "") for i, t, *_ in samples.ROWS)
    for r in sp.encode(samples.documents(spark)).collect():
        text = next(t for (i, t) in texts if i == r["doc_id"] and lib.encode(t) == list(r["ids"]))
        data = text.encode()
        assert r["decoded"] == lib.decode(list(r["ids"]))
        spans = list(zip(r["begins"], r["ends"], strict=True))
        assert b"".join(data[a:b] for a, b in spans) == data
        for piece, (a, b) in zip(map(lib.id_to_piece, r["ids"]), spans, strict=True):
            if not piece.startswith("<0x"):
                assert piece.replace("▁", " ").strip() == data[a:b].decode().replace("▁", " ").strip()


def double_array(keys: dict[bytes, bytes]) -> bytes:
    """A compiled map made the plain way: nodes are placed one after the other, far apart."""
    strings, values = b"", {}
    for k, v in keys.items():
        values[k] = len(strings)
        strings += v + b"\0"
    prefixes = sorted({k[:n] for k in keys for n in range(len(k) + 1)}, key=lambda p: (len(p), p))
    base = {p: 256 * (n + 1) for n, p in enumerate(prefixes)}
    units = [0] * (256 * (len(prefixes) + 2))
    place = {b"": 0}
    for p in prefixes:
        for c in range(256):
            if p + bytes([c]) in base:
                place[p + bytes([c])] = base[p] ^ c
    for p in prefixes:
        offset = place[p] ^ base[p]
        leaf = p in values
        units[place[p]] |= offset << 10 if offset < 1 << 21 else (offset >> 8) << 10 | 0x200
        units[place[p]] |= leaf << 8 | (p[-1] if p else 0)
        if leaf:
            units[base[p]] = values[p] | 1 << 31
    blob = np.array(units, "<u4").tobytes()
    return len(blob).to_bytes(4, "little") + blob + strings


def normaliser(**values):
    n = sp.Normaliser(b"")
    n.map = sp.CharacterMap(values["map"]) if "map" in values else None
    n.dummy_prefix, n.remove_extra, n.escape = (values.get(k, False) for k in ("dummy_prefix", "remove_extra", "escape"))
    return n


def test_longest_prefix_wins_and_is_aligned():
    n = normaliser(map=double_array({b"a": b"x", b"ab": b"yz", "ﬁ".encode(): b"fi"}))
    out, at = n("abacﬁ.".encode())
    assert out == b"yzxcfi."
    assert at.tolist() == [0, 0, 2, 3, 4, 4, 7, 8]


def test_marks_and_spaces():
    n = normaliser(dummy_prefix=True, remove_extra=True, escape=True)
    out, at = n(b"  a  b ")
    assert out.decode() == "▁a▁b"
    assert at.tolist() == [2, 2, 2, 2, 3, 3, 3, 5, 7]
    assert n(b"   ")[0] == b"" and n(b"")[0] == b""

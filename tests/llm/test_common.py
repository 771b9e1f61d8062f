import numpy as np

from driftwood.llm import common as C


def test_word_hash_does_not_depend_on_place():
    words = [b"a", b"ab", b"ba", b"\xc3\xa9", b"x" * 300, b"0", b"\x00"]
    alone = [int(C.word_hashes(w)[0]) for w in words]
    assert len(set(alone)) == len(words)
    assert C.word_hashes(b"  " + b" \t".join(words) + b"\n").tolist() == alone
    text = b" ".join(words * 5000)  # longer than one piece
    assert C.word_hashes(text).tolist() == alone * 5000


def test_word_longer_than_a_piece():
    big = b"w" * (C._PIECE + 5)
    got = C.word_hashes(b"a " + big + b" a " + b"b" * 10)
    assert len(got) == 4 and got[0] == got[2] and got[1] == C.word_hashes(big)[0] != C.word_hashes(big + b"w")[0]
    exact = b"v" * C._PIECE
    assert C.word_hashes(exact)[0] == C.word_hashes(b"a " + exact)[1]


def test_empty():
    assert len(C.word_hashes(b"")) == len(C.word_hashes(b" \n ")) == 0
    assert len(C.shingles(np.empty(0, np.uint64), 5)) == 0


def test_shingles_depend_on_order_and_short_texts_are_one():
    w = C.word_hashes(b"a b c d e f a b c d e")
    s = C.shingles(w, 5)
    assert len(s) == 7 and s[0] == s[6] and len(set(s.tolist())) == 6
    assert len(C.shingles(w[:3], 5)) == 1 and C.shingles(w[:3], 5)[0] != C.shingles(w[:3][::-1].copy(), 5)[0]


def test_pack_round_trip():
    rng = np.random.default_rng(0)
    a = np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    assert (C.unpack_sorted(C.pack_sorted(a)) == a).all()
    assert (C.unpack(C.pack(a[::-1])) == a[::-1]).all()
    assert len(C.unpack(C.pack(a[:0]))) == 0

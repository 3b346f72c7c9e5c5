"""op2 and op7 against the libraries."""

import hashlib
import pickle
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest

from tests.llm.conftest import EDGES
from threadsift.llm import bpe, tokenio
from threadsift.llm.text import column_bytes, slices
from threadsift.session import checkpoint_path

MULTI, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def odd():
    rnd = random.Random(7)
    few = list("ab st'''relvdm  \n\t1²½!?") + ["é", "日", "　", "😀", " ", "Ⅷ"]
    out = ["", " ", "'s", "''s 's \n's 'rea 've've'll'l 'r", "a" * 5000, "ab" * 3000, " " * 700, "日本語" * 300]
    out += ["".join(rnd.choice(few) for _ in range(rnd.randrange(1, 40))) for _ in range(4000)]
    out += ["".join(rnd.choice("ab") for _ in range(3000)), "".join(rnd.choice("abcdefghij") for _ in range(3000))]
    out += ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0xA0, 0xD7FF), rnd.randrange(0x10000, 0x1FBFF)])) for _ in range(80)) for _ in range(500)]
    return out


def encoded(memory, texts):
    data, offs = column_bytes(pa.array(texts))
    out = []
    for _, _, d, o in slices(data, offs, 1 << 16):
        ids, each = memory.ids(d, o)
        end = np.cumsum(each)
        out += [ids[e - k:e] for e, k in zip(end, each)]
    return out


def reference(ranks):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks.ids, special_tokens={})


def test_ids_equal_the_library(odd):
    made = bpe.tables(MULTI)
    ranks, memory = bpe.rank_memory(*pickle.loads(pickle.dumps(made)), P.PATTERN)
    enc = reference(ranks)
    for t, ids in zip(odd, encoded(memory, odd)):
        assert ids.tolist() == enc.encode_ordinary(t), ascii(t[:60])
        assert ranks.decode(ids)[0].tobytes() == t.encode()
    # a small memory forgets, and any other pattern goes by the regex module
    small = bpe.PieceMemory(P.PATTERN, ranks.encode_pieces, made[2], limit=2000)
    other = bpe.PieceMemory(P.PATTERN + "|zzz", ranks.encode_pieces, made[2])
    for m in (small, other):
        assert [x.tolist() for x in encoded(m, odd[:1500])] == [enc.encode_ordinary(t) for t in odd[:1500]]


def test_a_clash_of_hashes_costs_no_ids(monkeypatch, odd):
    """Pieces that share their first hash are told apart by length and second hash."""
    _, ranks, classes = bpe.tables(MULTI)
    real = bpe.span_hashes
    monkeypatch.setattr(bpe, "span_hashes", lambda d, a, b, salt=0: real(d, a, b, salt=1) if salt else (b - a).astype(np.uint64) % 5)
    enc = reference(ranks)
    got = encoded(bpe.PieceMemory(P.PATTERN, ranks.encode_pieces, classes), odd[8:600])
    assert [x.tolist() for x in got] == [enc.encode_ordinary(t) for t in odd[8:600]]


def test_words_alike_under_a_polynomial(spark, make):
    """1,024 letters arranged by bit parity collide in any polynomial modulo 2 ** 64."""
    a = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    b = "".join("ba"[i.bit_count() % 2] for i in range(1024))
    rows = [(1, a, "en", "s"), (2, b, "en", "s"), (3, f"{a} {b}", "en", "s")]
    enc = reference(bpe.tables(MULTI)[1])
    got = {r["doc_id"]: r for r in bpe.encode(make(rows), MULTI, P.PATTERN).collect()}
    for i, t, *_ in rows:
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == enc.encode_ordinary(t)
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(JSON)
    path = checkpoint_path(spark, "test-tokens")
    tokenio.write_blocks(make(rows), JSON, P.PATTERN, path)
    full = {r["doc_id"]: r["ids"] for r in tokenio.texts_of(spark, path).collect()}
    assert all(full[i] == [*tok.encode(t, add_special_tokens=False).ids, 0] for i, t, *_ in rows)


def test_long_pieces_equal_the_library():
    rnd = random.Random(3)
    ranks = bpe.tables(MULTI)[1]
    enc = reference(ranks)
    for alphabet in ("a", "ab", "abc", "etaoin", "thequickbrown"):
        t = "".join(rnd.choice(alphabet) for _ in range(20_000))
        assert ranks.encode_pieces([t.encode()])[0].tolist() == enc.encode_ordinary(t)


def test_query_shape_and_edges(make):
    rows = [r for r in EDGES]
    got = bpe.encode(make(rows, extra=True), MULTI, P.PATTERN, ["lang", "key"]).collect()
    enc = reference(bpe.tables(MULTI)[1])
    want = sorted((str(i), len(x := enc.encode_ordinary(t or "")), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    assert all(np.frombuffer(r["ids"], "<u4").size == r["n_tokens"] for r in got)
    assert bpe.encode_digests(make([]), MULTI, P.PATTERN).count() == 0


def test_codec_round_trip():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (rnd.integers(0, 1 << 32, n, dtype=np.uint64) >> rnd.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        assert (tokenio.unpack(*tokenio.pack(v), n) == v).all()
    ids = rnd.zipf(1.3, 5000) % 50_000
    t, c, d = tokenio.pack_ids(ids)
    assert (tokenio.unpack_ids(t, c, d, ids.size) == ids).all()
    assert len(d) < 2 * ids.size and np.frombuffer(t, "<u4")[0] == np.bincount(ids).argmax()


def test_token_files(spark, make, monkeypatch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(JSON)
    rows = [r for r in EDGES if r[0] is not None] + [(50, "a <|endoftext|> b's", "en", "a")]
    path = checkpoint_path(spark, "test-tokens")
    tokenio.write_blocks(make(rows, extra=True), JSON, P.PATTERN, path)
    got = sorted(map(tuple, tokenio.read_blocks(spark, path).collect()))
    tok.encode_special_tokens = True
    at, want = 0, []
    for i, t in sorted(((r[0], r[1] or "") for r in rows), key=lambda r: r[0]):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == sorted(want)
    full = {r["doc_id"]: r["ids"] for r in tokenio.texts_of(spark, path).collect()}
    assert full[4] == [*tok.encode("one", add_special_tokens=False).ids, 0] and full[2] == [0]
    empty = checkpoint_path(spark, "test-tokens")
    tokenio.write_blocks(make([]), JSON, P.PATTERN, empty)
    assert tokenio.read_blocks(spark, empty).count() == 0

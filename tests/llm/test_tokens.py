"""Encodings against the libraries, and files read back."""

import base64
import hashlib
import random
import time
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from flowloom.llm._pieces import PartCache, keys, part  # noqa: E402
from flowloom.llm.bpe import MatrixBpe, _encoder, default_pattern, default_ranks, encode_decode  # noqa: E402
from flowloom.llm.token_files import Folder, _cache, bases, default_tokenizer, read_shards, write_shards  # noqa: E402


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(default_ranks(), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_tokenizer())


def odd_texts(seed=3, n=1500):
    rng = random.Random(seed)
    letters = "abAé ñß漢字1２,.!'’\n\t  \x1c\x85\xa0 s't're🙂$#<|endoftext|>ǆﬁ"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(n)] + ["", " ", "\n", "a" * 3000, "<|endoftext|>", "I'll don't ", " word\n\nnext", "\nword", "\n\nword", "x\n y"]


def test_parts_join_to_the_text():
    for t in odd_texts():
        assert "".join(map(part, keys(t))) == t


def test_matrix_merges(reference):
    bpe = MatrixBpe(default_ranks(), default_pattern())
    cache, texts = PartCache(bpe.encode), odd_texts()
    for most in (cache.most, 0):  # also when nothing is held from one batch to the next
        cache.most = most
        ids, n = cache.encoded(texts)
        ends = np.cumsum(n)
        for t, a, b in zip(texts, ends - n, ends, strict=True):
            assert ids[a:b].tolist() == reference.encode_ordinary(t), t
            assert bpe.decode(ids[a:b]).tobytes() == t.encode()


def test_library_on_parts(library):
    cache, _ = _cache(default_tokenizer())
    texts = odd_texts(9)
    ids, n = cache.encoded(texts)
    ends = np.cumsum(n)
    for t, a, b in zip(texts, ends - n, ends, strict=True):
        assert ids[a:b].tolist() == library.encode(t, add_special_tokens=False).ids, t


def test_strings_of_special_tokens(library):
    cache, _ = _cache(default_tokenizer())
    plain, _ = _cache(default_tokenizer(), plain=True)
    text = "x <|endoftext|> y.\n<|endoftext|><|endoftext|>"
    assert cache.encoded([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids and 50256 in cache.encoded([text])[0]
    assert 50256 not in plain.encoded([text])[0]


def test_documents_of_the_tables(sf, library):
    """The unmodified library, on all texts of the small table and of the next."""
    import pyarrow.parquet as pq

    cache, _ = _cache(default_tokenizer())
    for folder in (sf, sf.replace("0.001", "0.01")):
        texts = [t or "" for t in pq.read_table(f"{folder}/documents.parquet", columns=["text"]).column(0).to_pylist()]
        ids, n = cache.encoded(texts)
        assert n.tolist() == [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]
        assert ids.tolist() == [i for x in library.encode_batch(texts, add_special_tokens=False) for i in x.ids]


def test_other_tokenizers_take_whole_texts(spark):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    cache, _ = _cache(path)
    texts, theirs = odd_texts(5, 200), Tokenizer.from_file(path)
    ids, n = cache.encoded(texts)
    ends = np.cumsum(n)
    assert [ids[e - k : e].tolist() for e, k in zip(ends, n, strict=True)] == [theirs.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("letters", ["0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "a", "é漢"])
def test_long_pieces(reference, letters):
    rng = random.Random(5)
    bpe = MatrixBpe(default_ranks(), default_pattern())
    for n in (513, 700, 2000):
        piece = "".join(rng.choice(letters) for _ in range(n)).encode()
        row = bpe.of_byte[np.frombuffer(piece, np.uint8)][None, :].copy()
        assert bpe.merge_long(piece).tolist() == bpe.merge(row, np.array([len(piece)]))[0].tolist()
    long = "".join(rng.choice(letters) for _ in range(200_000))
    began = time.perf_counter()
    ids, _ = PartCache(bpe.encode).encoded([long])
    assert bpe.decode(ids).tobytes() == long.encode() and time.perf_counter() - began < 30


def test_a_word_is_held_and_encoded_once():
    """A cache of parts holds a word once, beside its ids, and encodes it once, whatever marks are behind it."""
    asked = []

    def encode(strings):
        asked.extend(strings)
        return [list(s.encode()) for s in strings]

    words = ["".join(random.Random(k).choices("abcdefgh", k=7)) for k in range(2000)]
    cache = PartCache(encode)
    texts = [" ".join(words), " ".join(w + "," for w in words), "\n".join(w + ")." for w in words)]
    ids, n = cache.encoded(texts[:1])
    assert cache.held < 300 * len(words) and len(cache) == len(set(words))
    more = cache.encoded(texts[1:])
    assert bytes(ids.tolist()) + bytes(more[0].tolist()) == "".join(texts).encode() and [*n, *more[1]] == list(map(len, texts))
    assert len(asked) == len(set(asked))


def test_another_pattern_takes_whole_texts():
    import tiktoken

    pattern = r"\p{L}+ |\p{N}{1,3}|[^\p{L}\p{N}]|\p{L}+"
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(default_ranks(), "rb"))}
    theirs = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    _, cache = _encoder(default_ranks(), pattern)
    texts = ["ab cd 12345 x", " a  b\n", "", "one two three"]
    ids, n = cache.encoded(texts)
    ends = np.cumsum(n)
    assert [ids[e - k : e].tolist() for e, k in zip(ends, n, strict=True)] == [theirs.encode_ordinary(t) for t in texts]


def test_encode_decode(docs, rows, reference):
    got = encode_decode(docs, ids_column="chunk").collect()
    want = sorted((str(i), len(ids := reference.encode_ordinary(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert all(len(r.chunk) == r.n_tokens for r in got) and "source" in got[0]


def test_encode_empty(empty):
    assert encode_decode(empty).collect() == []


def test_files(spark, docs, rows, library, ws):
    folder = f"{ws.root}/tokens"
    counts = ws.table(write_shards(docs, folder, 3), "counts")
    got = read_shards(bases(counts, group=2), folder, 2).collect()
    order = sorted(((1 << 62 if i is None else i), t is not None, t or "") for i, t in rows)
    start, want = 0, []
    for i, _, t in order:
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        want.append((None if i == 1 << 62 else i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    shards = sorted(r.shard for r in counts.collect())
    mapped = Folder(folder).mapped(f"shard-{shards[0]:06d}.bin", "<u2")
    assert isinstance(mapped, np.memmap) and mapped[-1] == 2


def test_files_empty(spark, empty, ws):
    counts = ws.table(write_shards(empty, f"{ws.root}/tokens", 2), "counts")
    assert read_shards(bases(counts), f"{ws.root}/tokens", 2).collect() == []


def test_named_queries(spark, sf, library, reference):
    """op6 and op9 over the whole table, against the libraries."""
    from flowloom.llm.queries import QUERIES

    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    digest = lambda ids: hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    want = [(i, len(ids := reference.encode_ordinary(t)), digest(ids), hashlib.sha256(t.encode()).hexdigest()) for i, t in docs]
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op6_bpe"](spark, sf).collect()) == want
    start, want = 0, []
    for i, t in docs:
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op9_token_files"](spark, sf).collect()) == want


def test_the_greatest_doc_id_is_not_null(spark, ws):
    docs = spark.createDataFrame([((1 << 63) - 1, "a b"), (None, "c"), (3, "d")], "doc_id long, text string")
    counts = ws.table(write_shards(docs, f"{ws.root}/tokens", 2), "counts")
    assert [r.doc_id for r in sorted(read_shards(bases(counts), f"{ws.root}/tokens", 2).collect(), key=lambda r: r.start)] == [3, (1 << 63) - 1, None]

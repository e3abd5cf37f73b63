import hashlib
import random
import zlib

import numpy as np
import pytest

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from siftlane.llm import bpe as B  # noqa: E402
from siftlane.llm import token_files as TF  # noqa: E402

BYTE, WORD = public.path("byte_bpe_50k.json"), public.path("word_bpe_49k.json")
ALPHABET = "aé ß\n\t  \x1c\x1f\x85\xa0\u2003 don't'll'S 123²Ⅷ<|endoftext|>ßẞİǅ×÷日本語😀́é.,!!\r\nThe the"


def random_texts(n=800):
    r = random.Random(11)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 60))) for _ in range(n)] + ["a<|endoftext|>b", "<|endoftext|>", " <|startoftext|>  x", "x" * 3000, " " * 400 + "x", "  ", ""]


@pytest.fixture(scope="module")
def vocab():
    with open(BYTE, encoding="utf-8") as f:
        return B.Vocabulary(f.read())


def test_trie_encoding_equals_the_library(vocab):
    lib = tokenizers.Tokenizer.from_file(BYTE)
    texts = random_texts()
    for t, ids in zip(texts, B.encode_texts(vocab, texts, {})):
        want = lib.encode(t, add_special_tokens=False).ids
        assert ids == ",".join(map(str, want))
        assert vocab.decode(ids).decode("utf-8", "replace") == lib.decode(want, skip_special_tokens=False)


def test_border_rule_equals_merging(vocab):
    r = random.Random(2)
    ids = [i for i in vocab.bytes if i < 50256]
    for _ in range(5000):
        a, b = (r.choice(ids[: r.choice((300, 3000, 50000))]) for _ in range(2))
        x, y = vocab.bytes[a], vocab.bytes[b]
        assert vocab.may_follow(a, b) == (vocab.merged(x + y) == [x, y])



def test_encode_decode_query(spark, odd_docs):
    lib = tokenizers.Tokenizer.from_file(BYTE)
    rows = B.encode_decode(odd_docs, BYTE, ids=True).collect()
    texts = [r.text or "" for r in odd_docs.collect()]
    assert len(rows) == len(texts)
    want = sorted((len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for t in texts for i in [lib.encode(t, add_special_tokens=False).ids])
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    assert all(len(r.ids) == r.n_tokens for r in rows)
    assert B.encode_decode(odd_docs.limit(0), BYTE).count() == 0


def test_a_small_memory_changes_nothing(vocab, monkeypatch):
    texts = random_texts(60)
    want = B.encode_texts(vocab, texts, {})
    monkeypatch.setattr(B, "PIECES_KEPT", 3)
    monkeypatch.setattr(B, "WORDS_KEPT", 3)
    monkeypatch.setattr(B, "PAIRS_KEPT", 3)
    kept = {}
    assert [x for t in texts for x in B.encode_texts(vocab, [t], kept)] == want


@pytest.mark.parametrize("mode", [TF.BIT, TF.BYTE])
def test_planes_round_trip(mode):
    r = random.Random(1)
    for top in (0, 1, 255, 256, 49407, 70_000, 2**32 - 1):
        for n in (1, 7, 8, 9, 1000):
            a = np.array([r.randint(0, top) for _ in range(n)], np.uint32)
            assert (TF.from_planes(TF.to_planes(a, mode), n, mode) == a).all()


@pytest.mark.parametrize("mode", [TF.BIT, TF.BYTE])
def test_records_round_trip(mode):
    docs = [np.arange(n, dtype="<u4").tobytes() for n in (0, 1, 5, 70)]
    data = TF.pack_record([None, 3, 3, -9], docs, 2, 100, block_ids=16, mode=mode) + b"\n" + TF.pack_record([], [], 2, 176) + b"\n"
    (shard, ids, starts, sizes, flat), (_, none, *_) = TF.read_records(data)
    assert (shard, ids, starts.tolist(), sizes.tolist(), none) == (2, [None, 3, 3, -9], [100, 100, 101, 106], [0, 1, 5, 70], [])
    assert flat.astype("<u4").tobytes() == b"".join(docs)
    with pytest.raises(ValueError):
        list(TF.read_records(b"XXXX" + data[4:]))


def test_blocks_are_found_by_the_chunk_index():
    docs = [np.arange(7 * n, 7 * n + n, dtype="<u4") for n in (0, 1, 40, 3, 100)]
    data = TF.pack_record(list(range(5)), [d.tobytes() for d in docs], 0, 0, block_ids=16)
    (r,) = TF.records(data + b"\n")
    opened = []

    class Unzip:
        def decompress(self, x):
            import zstandard

            opened.append(x)
            return zstandard.ZstdDecompressor().decompress(x)

    for d, s, n in zip(docs, r.starts.tolist(), r.sizes.tolist()):
        opened.clear()
        assert (r.ids(s, s + n, Unzip()) == d).all()
        blocks = range(s // 16, (s + n - 1) // 16 + 1) if n else ()
        assert len(opened) == sum(r.planes[b + 1] - r.planes[b] for b in blocks)  # no other plane
    body = int.from_bytes(data[37:45], "little")  # the size of the planes, last in the head
    with pytest.raises(ValueError, match="does not fit"):
        TF.Record(data[:37] + (body + 1).to_bytes(8, "little") + data[45:])


def test_fetch_some_documents(spark, odd_docs, monkeypatch, tmp_path):
    monkeypatch.setattr(TF, "SHARD_BYTES", 60_000)
    monkeypatch.setattr(TF, "BLOCK_IDS", 512)
    lib = tokenizers.Tokenizer.from_file(WORD)
    TF.write(odd_docs, f"{tmp_path}/t", WORD)
    got = sorted((r.doc_id, r.tokens) for r in TF.fetch(spark, f"{tmp_path}/t", [1, 5, 8, 999]).collect())
    want = sorted((r.doc_id, [*lib.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in odd_docs.collect() if r.doc_id in (1, 5, 8))
    assert got == want and len(got) == 4  # id 1 has two rows
    assert TF.fetch(spark, f"{tmp_path}/t", [999]).count() == TF.fetch(spark, f"{tmp_path}/t", []).count() == 0
    index = TF.document_index(spark, f"{tmp_path}/t")
    assert index.count() == odd_docs.count() and index.select("path").distinct().count() > 1


def test_word_encoder_equals_the_library():
    lib = tokenizers.Tokenizer.from_file(WORD)
    with open(WORD, encoding="utf-8") as f:
        enc = TF.WordEncoder(f.read())
    for t in random_texts():
        assert np.frombuffer(enc.text(t), "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids


def test_word_encoder_on_every_latin_letter():
    lib = tokenizers.Tokenizer.from_file(WORD)
    with open(WORD, encoding="utf-8") as f:
        enc = TF.WordEncoder(f.read())
    texts = [x for c in [*map(chr, range(0xA0, 0x250)), "\u212a", "\u212b", "\u1e9e"] for x in (c, c + "li", "ka" + c + "no", "KA" + c, "7" + c + "'s" + c + c)]
    wrong = [t for t in texts if np.frombuffer(enc.text(t), "<u4").tolist() != lib.encode(t, add_special_tokens=False).ids]
    assert not wrong, wrong


def test_file_query(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(TF, "SHARD_BYTES", 60_000)
    monkeypatch.setattr(TF, "RECORD_IDS", 5_000)
    lib = tokenizers.Tokenizer.from_file(WORD)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in TF.round_trip(odd_docs, WORD).collect())
    want, at = [], 0
    for d, t in sorted(((-1 if r.doc_id is None else r.doc_id, r.text or "") for r in odd_docs.collect()), key=lambda x: (x[0], x[1].encode())):
        ids = [*lib.encode(t, add_special_tokens=False).ids, 1]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == sorted(want)
    assert TF.round_trip(odd_docs.limit(0), WORD).count() == 0


def test_trie_holds_every_word_once():
    r = random.Random(5)
    words = sorted({bytes(r.choice(b"ab\x00\xff") for _ in range(r.randint(0, 9))) for _ in range(400)})

    def ends(node, start=b""):
        depth, word, whole, below = node
        assert word[: len(start)] == start and (whole or len(below) > 1 or depth == 0)
        yield from [word[:depth]] if whole else []
        for child in below:
            assert child[0] > depth
            yield from ends(child, word[:depth])

    assert sorted(ends(B.trie(words))) == words


def test_gathered_decimals_and_bytes(vocab):
    texts = random_texts(80) + ["", "a  b", "a\n b", "x \n", " \n \n y"]
    coded = B.encode_ids(vocab, texts, {})
    sizes = [len(c) // 4 for c in coded]
    flat = np.frombuffer(b"".join(coded), "<i4")
    for c, decimals, raw in zip(coded, B.spelled(vocab.decimals, flat, sizes), B.spelled(vocab.pieces, flat, sizes)):
        text = ",".join(map(str, np.frombuffer(c, "<i4")))
        assert str(decimals, "ascii") == (text + "," if text else "") and bytes(raw) == vocab.decode(text)
    assert [bytes(x) for x in B.spelled(vocab.pieces, flat[:0], [0, 0])] == [b"", b""]


def test_word_encoder_keeps_what_is_asked_for_again(monkeypatch):
    """A full memory forgets old pieces and words, not those in use, and gives the same ids."""
    with open(WORD, encoding="utf-8") as f:
        content = f.read()
    texts = random_texts(200)
    want = [TF.WordEncoder(content).text(t) for t in texts]
    monkeypatch.setattr(TF, "PIECES_KEPT", 40)
    monkeypatch.setattr(TF, "WORDS_KEPT", 20)
    enc = TF.WordEncoder(content)
    assert [enc.text(t) for t in texts] == want
    asked, word = [], enc.model.tokenize

    class Model:
        def tokenize(self, raw):
            asked.append(raw)
            return word(raw)

    enc = TF.WordEncoder(content)
    enc.model = Model()
    for i in range(300):
        enc.text(f"always new{i}{'abcdefghij'[i % 10]}")
        assert len(enc) + len(enc.older) <= 40 and len(enc.words) + len(enc.older_words) <= 20
    assert asked.count("always") == 1


def test_word_encoder_remembers_no_long_pieces():
    """Texts without white space, as Chinese ones, are pieces as long as themselves."""
    with open(WORD, encoding="utf-8") as f:
        enc = TF.WordEncoder(f.read())
    for i in range(20):
        enc.text("日本語" * 500 + str(i) + " " + "xy" * 1000 + "abcdefghij"[i % 10])
    assert max(map(len, [*enc, *enc.older, *enc.words, *enc.older_words]), default=0) <= 64


def test_word_encoder_takes_texts_together(monkeypatch):
    """Texts are encoded a batch at a time, long ones cut at white space; a piece is looked up once for all."""
    import pyarrow as pa

    lib = tokenizers.Tokenizer.from_file(WORD)
    texts = random_texts(300) + ["“quoted” – it's…  " * 9, "Ⱥb ɃéÉ İ × x" * 7]
    want = [lib.encode(t, add_special_tokens=False).ids for t in texts]
    with open(WORD, encoding="utf-8") as f:
        enc = TF.WordEncoder(f.read())
    array = pa.array(["skipped", *texts]).slice(1)
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.documents(array)] == want
    monkeypatch.setattr(TF, "WORK_BYTES", 50)
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.documents(array)] == want
    monkeypatch.undo()
    seen, pieces = [], enc.pieces
    monkeypatch.setattr(enc, "pieces", lambda p: seen.extend(p) or pieces(p))
    assert len(list(enc.documents(pa.array(["the cat the cat"] * 100)))) == 100 and sorted(seen) == ["cat", "the"]

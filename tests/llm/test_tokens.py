import pyarrow as pa
import zlib

import numpy as np
import pytest

from llm_helpers import words
from tillflow.llm import token_counts, token_store
from tillflow.llm.queries import tokenizer_path
from tillflow.llm.token_store import EliasFano, Encoder, ef_encode


FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return token_counts.load(tokenizer_path("piece_bpe_32k.model"))


def counted(frame, **kw):
    got = token_counts.count_tokens(frame, tokenizer_path("piece_bpe_32k.model"), **kw)
    return sorted(map(tuple, got.collect()), key=str)


def expected(rows, model):
    out = []
    for r in rows:
        text = r[1] or ""
        n = len(model.encode(text))
        out.append((r[0], len(text.encode()), n, n > 4096))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk,overlap", [(32_768, 1_024), (256, 16)])
def test_counts_equal_whole_texts(documents, odd_rows, model, chunk, overlap):
    rows = odd_rows + [(8, "a" * 5_000, "a"), (9, ("é ▁x  y " * 300), "a"), (10, " " * 900 + "z", "a"),
                       (11, "<s> </s> <unk> " * 90, "a"), (12, "ab\n" * 700, "a")]
    frame = documents(rows, extra=["n_tokens", "k", "uid"])
    assert counted(frame, chunk=chunk, overlap=overlap) == expected(rows, model)


def test_counts_of_no_rows(documents):
    assert counted(documents([])) == []


def test_a_model_without_the_property_is_never_spliced(documents, model, monkeypatch):
    assert token_counts.stable(model)
    assert not token_counts.is_boundary("a  b", 2) and token_counts.is_boundary("a b", 1)


def test_counts_of_the_table(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert counted(docs, chunk=2_000, overlap=64) == expected(rows, model)


@pytest.mark.parametrize("values", [[], [0], [7], [0, 0, 0], [1, 1, 5, 900, 900, 10**12],
                                    list(range(0, 40_000, 7)), [2**63, 2**64 - 1], [0] * 999 + [2**40]])
def test_elias_fano_round_trip(values):
    coded = EliasFano(memoryview(ef_encode(np.array(values, np.uint64))))
    assert coded.select(0, len(values)).tolist() == values
    for begin in range(0, len(values), max(1, len(values) // 13)):
        assert coded.select(begin, begin + 1).tolist() == values[begin:begin + 1]


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2_000, 100_000)).astype(np.uint64)
    assert len(ef_encode(ends)) * 8 / len(ends) < 2.2 + np.log2(float(ends[-1]) / len(ends))


def test_encoder_equals_the_library(rng):
    encoder = Encoder(tokenizer_path("byte_bpe_50k.json"))
    texts = ["", " ", "  a  b\n\n c \t d ", "foo\n <|endoftext|> bar", "it's I'll  don't ,x", "²³ ½x é, ñ. x.",
             "a\x85 b\xa0 c　 d\x1c e", " lead", "trail \n", "x.\nY z\nQ", "naïve café. Über\nstraße", "日本 語。 x"]
    letters = "ab Zé.,\n'1 \t!ñ"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(300)]
    for text in texts:
        assert encoder.encode(text) == encoder.whole(text), text
    texts += [t + t for t in texts] + ["first", "first again", "again first", "a", "", "x\u3000y z", "é é\u2003 é"]
    assert encoder.encode_all(pa.array(texts)) == [encoder.whole(text) for text in texts]
    assert encoder.encode_all(pa.array(["", ""])) == [b"", b""] and encoder.encode_all(pa.array([], pa.string())) == []


class Counting:
    """A tokenizer that notes the texts the library is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, []

    def encode(self, text, **kw):
        self.texts.append(text)
        return self.tokenizer.encode(text, **kw)

    def encode_batch_fast(self, texts, **kw):
        self.texts += texts
        return self.tokenizer.encode_batch_fast(texts, **kw)


def test_distinct_words_reach_the_library_in_few_calls(rng):
    encoder = Encoder(tokenizer_path("byte_bpe_50k.json"))
    vocabulary = words(rng, 3_000) + ["Über", "x.\ny", "z$$$", "½", "(a).", "..."]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", "", ",", ".", "!?"]) for _ in range(400))
             for _ in range(30)]
    want = [encoder.whole(text) for text in texts]
    counting = encoder.tokenizer = Counting(encoder.tokenizer)
    assert encoder.encode_all(pa.array(texts)) == want
    # the first pieces, the closing marks and the joined others
    assert len(counting.texts) <= len(texts) + 5 + 4
    counting.texts.clear()
    assert encoder.encode_all(pa.array(texts[::-1])) == want[::-1]
    assert len(counting.texts) <= len(texts) + 5


@pytest.mark.parametrize("known,joined", [(0, 1), (700, 40), (20_000, 300)])
def test_encoder_forgets_and_stays_right(rng, monkeypatch, known, joined):
    monkeypatch.setattr(token_store, "KNOWN_BYTES", known)
    monkeypatch.setattr(token_store, "JOINED_BYTES", joined)
    encoder = Encoder(tokenizer_path("byte_bpe_50k.json"))
    vocabulary = words(rng, 400) + ["é,", "日本。", "a\nb.", "y" * 900, "don't", "²³", "x\x1c"]
    for _ in range(12):
        texts = [rng.choice(["", " ", "  "]).join(["", *(f"{rng.choice(vocabulary)} " for _ in range(rng.randrange(9)))])
                 + rng.choice(["", "<|endoftext|>", "end."]) for _ in range(9)]
        assert encoder.encode_all(pa.array(texts)) == [encoder.whole(text) for text in texts]
        assert encoder.known.nbytes + encoder.known_ids.nbytes <= known + 64
        assert len(encoder.known) == len(encoder.known_ids) == len(encoder.last_use)


def test_block_of_ids_with_closing_ids():
    encoder = Encoder(tokenizer_path("byte_bpe_50k.json"))
    texts = ["one two, two", "", "a  b ", "x <|endoftext|> y", "one"]
    runs = [encoder.whole(text) + b"\x02\x00" for text in texts]
    ids, ends = encoder.encode_block(pa.array(["dropped", *texts]).slice(1), b"\x02\x00")
    assert ids.to_pybytes() == b"".join(runs) and ends.tolist() == np.cumsum(list(map(len, runs))).tolist()


def test_a_vocabulary_without_some_byte_goes_by_whole_pieces():
    encoder = Encoder(tokenizer_path("byte_bpe_50k.json"))
    encoder.id_bytes = encoder.id_bytes - 1
    texts = ["one two, two", "a b c"]
    assert encoder.encode_all(pa.array(texts)) == [encoder.whole(text) for text in texts]


def stored(spark, frame, tmp_path, **kw):
    root = token_store.write_store(frame, tokenizer_path("byte_bpe_50k.json"), root=f"file://{tmp_path}/s", **kw)
    return [tuple(r) for r in token_store.read_store(spark, root).collect()]


def test_store_round_trip(spark, documents, odd_rows, tmp_path):
    encoder = Encoder(tokenizer_path("byte_bpe_50k.json"))
    got = sorted(stored(spark, documents(odd_rows, extra=["start", "tokens"]), tmp_path), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 2, 3, 4, 5, 6, 6, 7]
    texts = {1: "", 2: "", 3: "  \n\t ", 4: "one", 5: odd_rows[5][1], 6: odd_rows[5][1], 7: "É one TWO"}
    place = 0
    for doc_id, start, n, crc in got:
        assert start == place
        place += n
        if doc_id is not None:
            ids = np.append(np.frombuffer(encoder.whole(texts[doc_id]), "<u2"), 2).astype("<u4")
            assert (n, crc) == (len(ids), zlib.crc32(ids.tobytes()))


def test_store_of_no_rows(spark, documents, tmp_path):
    assert stored(spark, documents([]), tmp_path) == []


def test_store_of_the_table(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    encoder = Encoder(tokenizer_path("byte_bpe_50k.json"))
    place, want = 0, []
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = np.append(np.frombuffer(encoder.whole(r.text), "<u2"), 2).astype("<u4")
        want.append((r.doc_id, place, len(ids), zlib.crc32(ids.tobytes())))
        place += len(ids)
    assert sorted(stored(spark, docs, tmp_path)) == want

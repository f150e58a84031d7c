import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from strata.llm import sentencepieces as S

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, " ", "  two  spaces ", "a\nb c\t d", "it's we'll 12 345,67", "naïve œuvre ß € 漢字 漢 字 🙂 x",
         "</s> a <s>b <unk>", "x" * 2000, "word " * 3000, "a \u00a0b", "lead\u2581ing mark", "<0x0A> byte", "\nab \n cd\n", "x\n\ny", "one two\nthree", "\x01 cut \x01", "tie", "tie"]


@pytest.fixture(scope="module")
def original():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_model_settings():
    with open(PATH, "rb") as f:
        m = S.SentencePieceModel(f.read())
    assert len(m.pieces) == 32000 and m.kind == S.BPE and m.byte_fallback and m.dummy_prefix
    assert m.splits_at_spaces and m.unknown == 0


def test_parity_with_the_original(spark, original):
    rows = [(k, t, 1) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, parity int").repartition(3)
    out = S.encode_documents(docs, PATH)
    for r in out.withColumn("back", S.decode_column("ids", PATH)).collect():
        text = TEXTS[r.doc_id] or ""
        expected = original.encode(text)
        assert r.parity == (r.ids == expected), text
        assert r.ids == expected, text
        assert r.n_tokens == len(expected) and r.ids_crc32 == zlib.crc32(np.array(expected, "<u4").tobytes())
        assert r.lossless == (r.back == text), text


def test_table_texts_parity(spark, original):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    c = S.SentencePieceCodec(PATH)
    ids, n, parity, lossless = c.encode(pa.array([r.text for r in rows]))
    theirs = original.encode([r.text for r in rows])
    assert ids.tolist() == [i for t in theirs for i in t] and n.tolist() == list(map(len, theirs))
    assert parity.all() and lossless.all()
    assert c.decode(theirs) == [r.text for r in rows]


def test_unigram_model_is_rebuilt():
    def message(number, wire, value):
        if wire == 0:
            return bytes([number << 3]) + bytes([value])
        return bytes([number << 3 | wire]) + (bytes([len(value)]) if wire == 2 else b"") + value

    import struct
    pieces = [("<unk>", 0.0, 2), ("\u2581", -2.0, 1), ("a", -3.0, 1), ("b", -3.5, 1), ("\u2581ab", -1.0, 1), ("ab", -2.5, 1)]
    data = b"".join(message(1, 2, message(1, 2, p.encode()) + message(2, 5, struct.pack("<f", s)) + message(3, 0, t))
                    for p, s, t in pieces)
    data += message(2, 2, message(3, 0, 1)) + message(3, 2, message(1, 2, b"identity") + message(4, 0, 0))
    m = S.SentencePieceModel(data)
    assert m.kind == S.UNIGRAM and not m.byte_fallback
    ids = m.tokenizer().encode("ab abb", add_special_tokens=False).ids
    assert [m.pieces[i] for i in ids] == ["\u2581ab", "\u2581ab", "b"]


def test_empty_table(spark):
    assert S.encode_documents(spark.createDataFrame([], "doc_id bigint, text string"), PATH).count() == 0

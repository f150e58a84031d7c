import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", None, " ", "  two  spaces ", "a\nb c\t d", "it's we'll 12 345,67", "naïve œuvre ß € 漢字 漢 字 🙂 x",
         "<|endoftext|> a <|endoftext|>b", "x" * 3000, "word " * 5000, "a \u00a0b \x1c c", "\x00 first", "\nab \n cd\n", "x\n\ny", "one two\nthree", "\x01 cut \x01", "tie", "tie"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda s: t.encode(s or "", add_special_tokens=False).ids


def test_units_give_the_ids_of_whole_texts(reference):
    enc = tokens.ByteLevelEncoder(PATH)
    for _ in range(2):                 # second time from the table
        ids, n = enc.encode(pa.array([t or "" for t in TEXTS]))
        assert n.tolist() == [len(reference(t)) for t in TEXTS]
        assert ids.tolist() == [i for t in TEXTS for i in reference(t)]


def test_full_table_still_encodes(reference, monkeypatch):
    monkeypatch.setattr("strata.llm.units.MAX_CACHED_UNITS", 3)
    ids, _ = tokens.ByteLevelEncoder(PATH).encode(pa.array([t or "" for t in TEXTS]))
    assert ids.tolist() == [i for t in TEXTS for i in reference(t)]


def test_files_round_trip(spark, tmp_path, reference):
    rows = [(100 - k, t, "clash") for k, t in enumerate(TEXTS)] + [(95, TEXTS[5], "clash")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string").repartition(3)
    path = str(tmp_path / "t")
    tokens.write_tokens(docs, path, PATH)
    got = tokens.read_tokens(spark, path).orderBy("start").collect()
    start = 0
    for r, (doc_id, text, _) in zip(got, sorted(rows, key=lambda x: x[0]), strict=True):
        ids = reference(text) + [2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (doc_id, start, len(ids), ids)
        start += len(ids)
    some = tokens.read_tokens(spark, path, 90, 92).select("doc_id", "start").collect()
    assert {r.doc_id: r.start for r in some} == {r.doc_id: r.start for r in got if 90 <= r.doc_id <= 92}
    crc = tokens.read_tokens(spark, path).select("ids", tokens.ids_crc32("ids").alias("c")).collect()
    assert all(r.c == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in crc)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tokens.write_tokens(spark.createDataFrame([], "doc_id bigint, text string"), path, PATH)
    assert tokens.read_tokens(spark, path).count() == 0


def test_punctuation_is_cut_off_words(reference, monkeypatch):
    # words met with other punctuation are no new words for the library, and the ids stay the same
    texts = ["alpha, beta. 12; Été! gamma", "alpha. beta%%% 12, Été? gamma...", "(alpha) beta' 'beta', don't, a_b_.",
             "a×, ×÷. «été», 漢,字. x́, ́. \n, b\n. ½, ²!", "<|endoftext|>, end<|endoftext|>.", "!!! ... , ."]
    enc, asked = tokens.ByteLevelEncoder(PATH), []
    known = enc._units
    monkeypatch.setattr(enc._table, "_encode", lambda units: asked.extend(units) or known(units))
    for text in texts:
        ids, n = enc.encode(pa.array([text]), 2)
        assert ids.tolist() == reference(text) + [2] and n.tolist() == [len(ids)]
    assert len(asked) == len(set(asked))
    assert not {" beta%%%", " beta.", " 12;", " 12,", " Été!", " Été?"} & set(asked)
    ids, n = enc.encode(pa.array(texts), 2)
    assert ids.tolist() == [i for t in texts for i in reference(t) + [2]] and n.tolist() == [len(reference(t)) + 1 for t in texts]


def test_table_fills_to_its_bound(reference, monkeypatch):
    monkeypatch.setattr("strata.llm.units.MAX_CACHED_UNITS", 5)
    enc = tokens.ByteLevelEncoder(PATH)
    for text in ["one two three", "four five, six. seven", "seven, six two eight!"]:
        ids, _ = enc.encode(pa.array([text]))
        assert ids.tolist() == reference(text)
    assert enc._table.known.to_pylist() == ["one", " two", " three", "four", " five"]

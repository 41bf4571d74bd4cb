import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from odd_rows import SCHEMA, odd_documents
from tableops.llm import simple8b as s8
from tableops.llm.tokens import TextEncoder

AWKWARD = ["", " ", "  a  b ", "a\n\nb", "\n", "a \n b", "it's  they'll\tx\x1cy z", "Σ ΑΣ β.",
           "<|endoftext|> a<|endoftext|>b", "é é ́x   y", "日本 語\n\n\n x", "a\x85b c",
           "  z", "x\r\ny", "a\x01b \x01 c", "end.\nNext, word. 12,3 a.b, ..", None,
           "a <|endoftext|> b", "<|startoftext|>x\n<|endoftext|>.", "<|endoftext", "Straße ÀÉÎ İstanbul ŉ ſ ĳ, Ω.",
           "École, ÉCOLE. e\u0301cole ﬁ ǅ Ⅷ ½", "a\x00b \x00 c\x00", "ŐŰ, ő.\nŁódź, ŽŠ", "don't l'eau I'M", "x" * 5000,
           "word " * 3000 + "end", "ab.c a,b. .a ,a a.. a,, A. Ab,"]


@pytest.mark.parametrize("name,style", [("byte_bpe_50k.json", "byte"),
                                        ("word_bpe_49k.json", "word")])
def test_units_give_the_ids_of_whole_texts(name, style):
    path = public_tokenizers.path(name)
    whole = Tokenizer.from_file(path)
    got = TextEncoder(path, style).encode(AWKWARD * 2)
    for text, ids in zip(AWKWARD * 2, got, strict=True):
        want = whole.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text


def greedy(ids):
    """Words by the coding's definition, one id after the other."""
    words, i = [], 0
    while i < len(ids):
        room = s8.SUB_BLOCK - i % s8.SUB_BLOCK
        for sel, (count, bits) in enumerate(zip(s8.COUNTS, s8.BITS, strict=True)):
            part = ids[i:i + count]
            if len(part) == count <= room and (sel == 15 or max(part) < 1 << bits):
                break
        data = sum(min(x, s8.ESCAPE) << (k * bits) for k, x in enumerate(part)) if bits else 0
        words.append(sel << 60 | data)
        i += count
    return words


ids = st.lists(st.one_of(st.integers(0, 1), st.integers(0, 40), st.integers(0, 60_000),
                         st.integers((1 << 60) - 2, (1 << 64) - 1)), max_size=1500)


@settings(max_examples=40, deadline=None)
@given(ids, st.integers(0, 300))
def test_round_trip_and_words(values, zeros):
    values = values + [0] * zeros
    x = np.array(values, np.uint64)
    block = s8.Block(s8.encode_block([3, None], [x, x[:5]]))
    assert block.doc_ids == [3, None] and block.lens.tolist() == [len(x), len(x[:5])]
    whole = values + values[:5]
    assert block.ids().tolist() == whole
    assert block.words.tolist() == greedy(whole)
    for k in range(len(block.subs)):
        assert block.sub_block(k).tolist() == whole[k * s8.SUB_BLOCK:(k + 1) * s8.SUB_BLOCK]


def test_bad_block():
    with pytest.raises(ValueError):
        s8.Block(b"x" * 100)


def test_files_round_trip(spark, tmp_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = odd_documents()
    s8.write_blocks(spark.createDataFrame(rows, SCHEMA).repartition(3), tmp_dir + "/b", path)
    got = sorted(map(tuple, s8.read_documents(spark, tmp_dir + "/b").collect()),
                 key=lambda r: r[1])
    whole = Tokenizer.from_file(path)
    docs = sorted(((r[0], r[1]) for r in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for (doc, text), row in zip(docs, got, strict=True):
        ids = np.array(whole.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        assert row == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_no_documents(spark, tmp_dir):
    s8.write_blocks(spark.createDataFrame([], SCHEMA), tmp_dir + "/b",
                    public_tokenizers.path("byte_bpe_50k.json"))
    assert s8.read_documents(spark, tmp_dir + "/b").count() == 0

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from voxloom.llm.common import WordEncoder
from voxloom.llm.token_files import EliasFano, read_token_files, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=300).map(sorted))
def test_elias_fano_round_trip_and_select(values):
    code = EliasFano.from_bytes(EliasFano.encode(np.array(values, np.uint64)).to_bytes())
    assert code.values().tolist() == values
    assert [code.select(i) for i in range(len(values))] == values


def test_elias_fano_is_small():
    bounds = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    assert len(EliasFano.encode(bounds).to_bytes()) * 8 < 100_000 * 14  # about 2 + log2(1000) bits each
    with pytest.raises(IndexError):
        EliasFano.encode(bounds).select(100_000)


@pytest.mark.parametrize("name,space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_special_tokens_are_what_the_plain_call_makes_of_them(name, space):
    path = public_tokenizers.path(name)
    found = ["a b", "a <|endoftext|> b", "", "<|endoftext|>", "<|nothing|> x", "A<|ENDOFTEXT|>", "x<|startoftext|>y <|endoftext|><|endoftext|>", "end"]
    for special in (False, True):
        plain = Tokenizer.from_file(path)
        plain.encode_special_tokens = not special
        got = [ids.tolist() for ids in WordEncoder(path, space, special=special).column(pa.array(found))]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in found]


ROWS = [
    (5, "The cat.  sat\n on  <|endoftext|> it's"), (-3, None), (2, ""), (2, "again"), (2, "again"), (None, "lost"),
    (2**62, "wörd " * 3000), (7, " lead and trail "), (8, "\ttab nbsp \n\n x"),
]


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment", [1, 50, 1 << 20])
def test_files_match_the_tokenizer(spark, tmp_path, segment):
    docs = spark.createDataFrame([(d, t, "x") for d, t in ROWS], "doc_id long, text string, start string")
    write_token_files(docs, str(tmp_path / "f"), PATH, segment_ids=segment)
    got = [tuple(r) for r in read_token_files(spark, str(tmp_path / "f")).orderBy("start").collect()]
    unordered = lambda rows: sorted((r[0] if r[0] is not None else -99, r[2], r[3]) for r in rows)
    assert unordered(got) == unordered(expected(ROWS))
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got[:-1]]]).tolist()
    assert [r[0] for r in got] == [r[0] for r in expected(ROWS)]


def test_empty_table_and_too_narrow_ids(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    write_token_files(docs, str(tmp_path / "e"), PATH)
    assert read_token_files(spark, str(tmp_path / "e")).count() == 0
    with pytest.raises(Exception, match="does not fit"):
        write_token_files(spark.createDataFrame([(1, "elephants")], "doc_id long, text string"), str(tmp_path / "n"), PATH, width=1)

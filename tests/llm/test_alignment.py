import hashlib
import random
from collections import Counter, defaultdict
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from voxloom.llm.alignment import PieceWords, aligned, bytes_of_a, bytes_of_b
from voxloom.llm.queries import op13_alignment

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@lru_cache(None)
def unicode_bytes(token):
    """Byte-level decoding by the library's own decoder, one token at a time."""
    plain = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    rest = [b for b in range(256) if b not in plain.values()]
    return bytes(plain.get(c, rest[ord(c) - 256] if 256 <= ord(c) < 256 + len(rest) else 0) for c in token)


def ends(pieces):
    out, at = [], 0
    for p in pieces:
        at += len(p)
        out.append(at)
    return out


def brute(docs):
    """Token by token, with every A-B pair that ends together."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    name_a = {i: t for t, i in a.get_vocab(with_added_tokens=True).items()}
    count, links, rows = Counter(), [], []
    for doc_id, text in docs:
        if not text:
            rows.append([doc_id, 0, 0, 0, ""])
            links.append([])
            continue
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a = [unicode_bytes(name_a[i]) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if {b"".join(bytes_a), b"".join(bytes_b)} != {(" " + text).encode()}:
            rows.append([doc_id, 0, 0, 0, ""])
            links.append([])
            continue
        ends_a, ends_b = ends(bytes_a), ends(bytes_b)
        by_end = defaultdict(list)
        for i, e in zip(ids_b, ends_b):
            by_end[e].append(i)
        pairs = [(i, j) for i, e in zip(ids_a, ends_a) for j in by_end[e]]
        cuts = sorted(set(ends_a) & set(ends_b))
        shown, x, y = [], 0, 0
        for cut in cuts:
            x0, y0 = x, y
            while x < len(ends_a) and ends_a[x] <= cut:
                x += 1
            while y < len(ends_b) and ends_b[y] <= cut:
                y += 1
            shown.append(",".join(map(str, ids_a[x0:x])) + "|" + ",".join(map(str, ids_b[y0:y])))
        count.update(pairs)
        links.append(pairs)
        rows.append([doc_id, len(ids_a), len(ids_b), len(cuts), hashlib.sha256(";".join(shown).encode()).hexdigest()])
    best = defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    out = []
    for (doc_id, n_a, n_b, n, digest), pairs in zip(rows, links):
        out.append((doc_id, n_a, n_b, n, len(pairs), sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs), digest))
    return sorted(out, key=str), count


def rows_of(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=str)


def odd_texts():
    rng = random.Random(5)
    words = ["the", "Ouwhea", "élève", "straße", "x", "naïve—", "日本語", "🙂", "<|endoftext|>", "<s>", "<0x41>", "a\tb", "don't", "12345", "...", "\n", "\nNext", "Tail\n", "▁", "a▁b", "\x00", "\x1f", "#!!", "ﬁ", "é", " "]
    out = [None, "", " ", "\n", "  ", "\n\n", " lead", "trail ", "two  spaces", "▁", "a ▁b", "a▁ b", "\t", "x" * 5000, "a\n b", "a \nb", "word " * 3000]
    out += [rng.choice(["", " "]) + rng.choice([" ", " ", " ", "\n", ""]).join(rng.choice(words) for _ in range(rng.randrange(1, 12))) for _ in range(25)]
    return out


@pytest.mark.parametrize("hot_pairs", [0, 40, 1 << 17])
def test_odd_texts_match_brute_force(spark, hot_pairs):
    docs = list(enumerate(odd_texts())) + [(None, "the same the"), (None, "the same the"), (6, " lead")]
    table = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, same string, row int")
    rows, pairs = aligned(table, A, B, hot_pairs=hot_pairs)
    expected, count = brute(docs)
    assert rows_of(rows) == expected
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(count)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = op13_alignment(spark, SF)
    assert got.columns == COLUMNS and [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    rows = rows_of(got)
    assert rows == brute(docs)[0]
    assert all(0 < r[5] <= r[4] for r in rows if r[1])


def test_empty_table(spark):
    rows, pairs = aligned(spark.createDataFrame([], "doc_id long, text string"), A, B)
    assert rows.count() == 0 and pairs.count() == 0


def test_words_give_the_ids_of_whole_texts():
    model, words = SentencePieceProcessor(model_file=B), PieceWords(B, most=40)
    texts = [t for t in odd_texts() if t and "▁" not in t]
    ids, sizes = words.column(pa.array(texts))
    at = 0
    for text, n in zip(texts, sizes):
        assert ids[at : at + n].tolist() == model.encode(text), repr(text)
        at += n


def test_token_bytes():
    a, b = bytes_of_a(A), bytes_of_b(B)
    assert b"".join(a[i] for i in Tokenizer.from_file(A).encode(" é 日\n", add_special_tokens=False).ids) == " é 日\n".encode()
    assert b"".join(b[i] for i in SentencePieceProcessor(model_file=B).encode("é 日\n")) == " é 日\n".encode()
    assert a[50256] == b"" and b[0] == b[1] == b[2] == b""

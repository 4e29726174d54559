import zlib

import numpy as np

from voxloom.llm.language import LENGTH, ByteNetwork, train, windows, with_language
from voxloom.llm.queries import op8_language


def test_windows_cover_whole_texts():
    text = bytes(range(1, 256)) * 5
    assert windows(text).tobytes().rstrip(b"\0") == text and windows(b"").shape == (1, LENGTH)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = ByteNetwork(["a", "b", "c"])
    for name in ("vectors", "filters", "bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    rows, wanted = rng.integers(1, 256, (6, LENGTH)).astype(np.uint8), np.array([0, 1, 2, 0, 1, 2])
    loss = lambda: -np.log(net.forward(rows)[2][np.arange(6), wanted]).mean()
    for p, g in zip(net.parameters(), net.gradients(rows, wanted)):
        flat, slope = p.reshape(-1), np.asarray(g).reshape(-1)
        for k in np.argsort(-abs(slope))[:3]:
            kept = flat[k]
            flat[k] = kept + 1e-6
            up = loss()
            flat[k] = kept - 1e-6
            down = loss()
            flat[k] = kept
            assert abs((up - down) / 2e-6 - slope[k]) < 1e-4


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op8_language(spark, sf)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = got.collect()
    assert len(rows) == 10_000 and all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    given = [(1, None, "en"), (2, "", None), (3, "12 34 !!", "en"), (4, "the " * 9000, "en"), (4, "der die das", "de"), (None, "été", "fr")]
    docs = spark.createDataFrame(given, "doc_id long, text string, lang string")
    rows = with_language(docs, train(docs), "score").collect()
    assert [r.score.lang for r in rows[:3]] == ["und"] * 3 and rows[0].score.score == 0
    assert rows[3].score.lang == "en" and [r.lang for r in rows] == [g[2] for g in given]
    nothing = train(docs.where("lang = 'xx'"))
    assert {r.l.lang for r in with_language(docs, nothing, "l").collect()} == {"und"}
    assert with_language(docs.limit(0), nothing, "l").count() == 0

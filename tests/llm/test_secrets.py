import hashlib
import random
import re
import string

from voxloom.llm.queries import op9_secrets
from voxloom.llm.secrets import Novelty, base_spans, identifier_dictionary, novel_spans, redacted, with_secrets

SF = "/root/testdata/sf0.01"
PATTERNS = (
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)


def brute(text):
    out = []
    for order, (kind, pattern, group, least) in enumerate(PATTERNS):
        out += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return [s for *_, s in sorted(out)]


def test_query_matches_plain_patterns(spark):
    got = op9_secrets(spark, SF)
    assert got.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    found = 0
    for r in got.collect():
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex")]
        assert [s for s in r.spans.split(",") if s and not s.startswith("novel")] == want
        found += len(want)
    assert found


def test_odd_matches():
    assert base_spans("password: token= abcdefghijklmnop") == []  # the failing match takes the second name with it
    assert [s[0] for s in base_spans("TOKEN='abc.def-ghi_jk=' " + "ab" * 9 + " AKIA" + "Z" * 14)] == ["assign", "hex", "access"]
    assert base_spans("ſecret=abcdefghijklmnop") == [] and base_spans("AKIA" + "A" * 13) == []


def random_key(seed, size=40):
    return "".join(random.Random(seed).choices(string.ascii_letters + string.digits, k=size))


def test_novelty_tells_random_from_known():
    names = [f"get_customer_order_{w}_by_id_2" for w in ("total", "status", "history", "address")]
    measure = Novelty("\n".join(names).encode())
    assert measure("def load(): auth = ", random_key(1)) > 0.7
    assert measure("def load(): auth = ", names[2]) < 0.3
    key = random_key(2)
    assert measure(f"auth = {key} ; auth = ", key) < 0.3


def test_novel_spans_redaction_and_odd_rows(spark):
    key = random_key(3)
    texts = [None, "", f"header auth bearer {key} end", f"nothing near it is special, {key}", f"é token={key}; AKIA{'Q7' * 8} z " * 300, "fetch_user_name_2_or_default_1 auth fetch_user_name_2_or_default_1"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts * 2)], "id long, text string, kind string")
    rows = sorted(with_secrets(docs, "s").collect(), key=lambda r: r.id)
    assert [len(r.s.novel) for r in rows[:6]] == [0, 0, 1, 0, 0, 0] and rows[2].text[rows[2].s.novel[0].start : rows[2].s.novel[0].stop] == key
    clean = sorted(redacted(with_secrets(docs, "s"), "s").collect(), key=lambda r: r.id)
    assert clean[0].text is None and clean[1].text == "" and clean[2].text == "header auth bearer [REDACTED] end"
    assert clean[3].text == texts[3] and clean[4].text == "é [REDACTED]; [REDACTED] z " * 300 and clean[0].kind == "x"
    assert with_secrets(docs.limit(0), "s").count() == 0
    assert identifier_dictionary(docs) == b"fetch_user_name_2_or_default_1"


def test_key_repeated_nearby(spark):
    measure = Novelty(b"")
    alone = other_name = 0
    for seed in range(60):
        rng = random.Random(seed)
        key = "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(20, 64)))
        key = key if any(c.isdigit() for c in key) else key[:-1] + "7"
        words = " ".join(rng.choices(("retry", "request", "the", "log", "line", "sent", "again", "with"), k=rng.randint(12, 45)))
        text = f"auth bearer {key} first {words} "
        found = lambda t: [t[a:b] for _, a, b in novel_spans(t, base_spans(t), measure, 0.62, 48, 400)]
        assert found(f"{text}auth bearer {key} end") == [key, key]
        alone += found(text) == [key]
        other_name += key in found(f"{text}Cookie: session={key} end")
    assert alone > 50 and other_name > 50  # a key of about 20 characters, judged once, is at the limit
    key = random_key(5)
    line = f"header auth bearer {key} end"
    docs = spark.createDataFrame([(0, f"{line}\n{line}"), (1, f"token = {key} and auth bearer {key}")], "id long, text string")
    clean = [r.text for r in redacted(with_secrets(docs, "s"), "s").orderBy("id").collect()]
    assert clean == ["header auth bearer [REDACTED] end\nheader auth bearer [REDACTED] end", "[REDACTED] and auth bearer [REDACTED]"]
    name = "get_customer_order_total_by_id_2"
    text = f"auth {name} and auth {name}"
    assert novel_spans(text, [], Novelty(name.encode()), 0.62, 48, 400) == []

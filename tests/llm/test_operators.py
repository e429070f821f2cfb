"""The operators against brute force, on awkward tables: nulls anywhere, empty and very long texts, ties, repeats, no rows, clashing columns."""

import base64
import hashlib
import json
import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
import zstandard
from pyspark.sql import functions as F

from larkspur.llm import bitsliced, components, hnsw, mixing, neardup, pieces, quality, queries, secrets, sharding, toxicity, warc
from larkspur.llm.common import table

DIR = "/root/testdata/sf0.001"
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    """(doc_id, text[, source]) as documents, with a column that no operator knows and names that some use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, DOCS).withColumn("node", F.lit("x")).withColumn("_clean", F.lit(1)).withColumn("score", F.lit("mine")).withColumn("mix_size", F.lit(None).cast("int")).withColumn("stays", F.lit(False))


AWKWARD = [(1, None, None), (2, "", "b"), (2, "", "b"), (None, "a word", "b"), (None, None, None), (3, " \t\n\x0b", "b"), (4, "Ünïcode 🙂 " * 3, None), (5, "long " + "w%d " * 3 % (1, 2, 3), "a"), (6, " ".join(f"word{i}" for i in range(60_000)), "a"), (-7, "x", "é")]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, DIR)
    names = sorted(df.columns)
    assert (names, sorted(repr(tuple(r)) for r in df.select(*names).collect())) == duck("sf0.001", queries.ORACLES[name])


# 1: secrets

ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain_base(text):
    spans = [(m.start(), m.end(), 0, "assign") for m in re.finditer(ASSIGN, text) if len(m[2]) >= 12]
    spans += [(m.start(), m.end(), 1, "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), m.end(), 2, "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans, key=lambda x: (x[0], x[2]))


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x81, n]) if n < 256 else bytes([0x82, n >> 8, n & 255])) + body


RSA = der(0x30, der(2, b"\0"), der(2, b"\1" + b"\7" * 127), *[der(2, b"\1" * 60) for _ in range(7)])
PKCS8 = der(0x30, der(2, b"\0"), der(0x30, der(6, bytes.fromhex("2a864886f70d010101")), b"\x05\0"), der(4, RSA))
ED = der(0x30, der(2, b"\0"), der(0x30, der(6, bytes.fromhex("2b6570"))), der(4, der(4, b"k" * 32)))
SSH = secrets.OPENSSH + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + b"".join(len(x).to_bytes(4, "big") + x for x in (b"p" * 51, b"q" * 144))


def token(alg="HS256", size=32):
    enc = lambda x: base64.urlsafe_b64encode(x).rstrip(b"=").decode()
    return ".".join([enc(json.dumps({"alg": alg, "typ": "JWT"}).encode()), enc(b'{"sub":"1"}'), enc(b"s" * size)])


def wrapped(data):
    text = base64.b64encode(data).decode()
    return "\n".join(text[i : i + 64] for i in range(0, len(text), 64))


def test_secret_kinds():
    kinds = lambda t: {k for *_, k in secrets.scan(t)} - set(secrets.KINDS[:3])
    for data in (RSA, PKCS8, ED):
        text = base64.b64encode(data).decode()
        (start, end, kind), *rest = [x for x in secrets.scan(f"né {text} z") if x[2] == "der"]
        assert (start, kind, rest) == (3, "der", []) and f"né {text} z"[start:end] == text
        assert kinds(f"-----BEGIN KEY-----\n{wrapped(data)}\n-----END KEY-----") == {"der"}
        assert kinds(f"x {data.hex()} y") == {"der"}
        assert kinds(base64.b64encode(data[:-1]).decode()) == set() and kinds(base64.b64encode(data + b"\0").decode()) == set()
    assert kinds(wrapped(SSH)) == {"openssh"} and kinds(wrapped(SSH[:-1])) == set()
    assert kinds(f"Bearer {token()}.") == {"token"} and kinds(token("none")) == set() and kinds(token(size=4)) == set() and kinds("eyJhb.eyJz.abc") == set()
    assert kinds(base64.b64encode(b"plain words, no key at all, but long enough to look").decode()) == set()
    assert kinds("M" * 200_000) == set()
    assert token() not in secrets.redact(f"a {token()} b") and secrets.redact(None) is None and secrets.redact("clean") == "clean"


def test_tokens_wherever_they_begin():
    enc = lambda x: base64.urlsafe_b64encode(x).rstrip(b"=").decode()
    for head in (b'{"alg":"RS256"}', b'{ "alg": "RS256"}', b'{\n "alg": "RS256"}', b' {"alg":"RS256"}', b'\t{"typ":"x","alg":"RS256"}', b'\n{"alg":"RS256"}', b'\r\n{"alg":"RS256"}', b'{\t"alg":"RS256"}'):
        t = ".".join([enc(head), enc(b'{ "sub": 1}'), enc(b"s" * 32)])
        for before in ("", "x.", "host.name.", "a b ", "é", f"{enc(head)}.", '"'):
            (span,) = [x for x in secrets.scan(f"{before}{t} and more.") if x[2] == "token"]
            assert span == (len(before), len(before) + len(t), "token")
        assert t not in secrets.redact(f"x.{t}")
        assert not [x for x in secrets.scan(f"z{t}") if x[2] == "token"]


def test_scan_is_linear():
    import time

    rng = random.Random(3)
    data = rng.randbytes(3 << 20)
    for text in (wrapped(data), base64.b64encode(data).decode(), data.hex(), "MIIE" * (1 << 20), "b3Blbn" * (1 << 19), "eyJ." * (1 << 20), "M" * (4 << 20)):
        start = time.process_time()
        secrets.scan(text)
        assert time.process_time() - start < 20


def spans_of(text):
    return [x for x in secrets.scan(text) if x[2] in ("der", "openssh")]


def test_keys_in_one_run():
    line = base64.b64encode(ED).decode()
    assert len(line) == 64
    for n in (1, 2, 3, 5):
        assert spans_of("\n".join([line] * n)) == [(65 * i, 65 * i + 64, "der") for i in range(n)]
    for key, kind in ((wrapped(RSA), "der"), (wrapped(PKCS8), "der"), (wrapped(SSH), "openssh"), (line, "der")):
        bare = key.rstrip("=")  # padding would end the run
        for more in ("", "\n" + "\n".join(["abcdefghijklmnopqrstuvwx"] * 5), f"\n{line}\n{line}"):
            assert spans_of(bare + more)[0] == (0, len(bare), kind)
            assert len(spans_of(bare + more)) == 1 + more.count(line)


def test_keys_wherever_they_begin():
    lines = lambda text, sep: sep.join(text[i : i + 64] for i in range(0, len(text), 64))
    for data, kind in ((RSA, "der"), (PKCS8, "der"), (ED, "der"), (SSH, "openssh")):
        b64 = base64.b64encode(data).decode()
        for key in (b64, data.hex(), data.hex().upper()):
            for sep in ("", "\n", "\r\n", "\n    ", "\n\t", "\\n", "\\r\\n", "\\\\n"):
                body = lines(key, sep)
                for head, tail in (("", ""), ("-----BEGIN KEY-----" + sep, sep + "-----END KEY-----"), ('{"key": "\\n', '\\n"}'), ("x_/+", " y"), ("x\n  ", "\n z")):
                    assert spans_of(head + body + tail) == [(len(head), len(head) + len(body), kind)], (kind, sep, head)
                    assert body not in secrets.redact(head + body + tail)
        assert spans_of(data.hex() + "00") == spans_of(data[:-1].hex()) == spans_of(f"{b64[:40]} {b64[40:]}") == []


def test_secrets_table(spark):
    rng = random.Random(1)
    parts = ["token=", "token: ", "Password = '", "apikey\":\"", "api_key=", "ſecret=", "AKIA", "ABCDEFGHIJKLMNOP", "deadbeef", "0123456789abcdef", " ", "=", "a.b-c/d+", "AKIAAKIA", "é", "\n", token(), base64.b64encode(ED).decode()]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(25)))) for i in range(300)] + AWKWARD
    got = secrets.find(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, text, *_ in rows:
        base = plain_base(text or "")
        n = [sum(x[2] == k for x in base) for k in range(3)]
        want.append((i, *n, hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, _, k in base).encode()).hexdigest()))
    assert sorted(map(repr, [tuple(r)[:5] for r in got])) == sorted(map(repr, want))
    for r in got:  # base spans stay among all spans
        assert sum(x.split(":")[0] == "hex" for x in r.spans.split(",")) == r.n_hex
    clean = secrets.redacted(docs(spark, rows))
    assert clean.columns == docs(spark, rows).columns and clean.count() == len(rows)
    for r in clean.collect():
        assert r.text is None or r.n_chars == len(r.text)
        assert not secrets.scan(r.text)
    assert secrets.find(docs(spark, [])).count() == secrets.redacted(docs(spark, [])).count() == 0


# 2 and 5: vectors

VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"


def vector_rows(n=400, dim=8, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(size=dim).astype(np.float32)], 0) for i in range(n)]
    same = [0.5] * dim
    rows += [(1000 + i, same, 0) for i in range(60)]  # ties
    rows += [(2000, None, 0), (2001, [None, *same[1:]], 0), (2002, [float("nan"), *same[1:]], 0), (2003, [float("inf"), *same[1:]], 0), (2004, [0.0] * dim, 0), (None, same, 0), (3000, same[:3], 0), (3050, same[:3], 0), (20, rows[20][1], 0), (4000, [], 0), (4050, [], 0)]
    return rows


def ranked(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def brute(rows, every, k, usable, score):
    rows = [r for r in rows if r[0] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and usable(r[1])]
    asked = {(r[0], tuple(r[1])) for r in rows if r[0] % every == 0}
    return {q: sorted(((i, score(v, w)) for i, w, _ in rows if i != q and len(w) == len(v)), key=lambda x: (-x[1], x[0]))[:k] for q, v in asked}


@pytest.mark.parametrize("block", [50, 1 << 15])
def test_bitsliced(spark, block):
    rows = vector_rows()
    v = bitsliced.quantised(spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("x")).withColumn("dim", F.lit(1)))
    got = ranked(bitsliced.search(bitsliced.build(v, block), v.where(F.col("id") % 50 == 0), 5, chunk=7).collect())
    exact = lambda a, b: sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b, strict=True))
    want = brute(rows, 50, 5, lambda v: True, exact)
    assert got == {q: x for q, x in want.items() if x}
    none = v.limit(0)
    assert bitsliced.search(bitsliced.build(none, block), none, 5).count() == 0


def test_slices_of_wide_and_equal_values():
    rng = np.random.default_rng(2)
    for values in (rng.integers(-(2**27), 2**27, (90, 5)), np.full((70, 3), 7), np.zeros((1, 4), int), rng.integers(0, 2, (200, 6))):
        ids = rng.permutation(len(values)).astype(np.int64)
        s = bitsliced.Slices.build(ids, values)
        for q in (values[0], -values[0], np.zeros_like(values[0])):
            got = dict(zip(*[x.tolist() for x in s.top(q, 9, int(ids[3 % len(ids)]))], strict=True))
            want = sorted(((int(i), int(v @ q)) for i, v in zip(ids, values, strict=True) if i != ids[3 % len(ids)]), key=lambda x: (-x[1], x[0]))[:9]
            assert got == dict(want)


def test_bitsliced_keeps_large_components(spark):
    rows = [(0, [2.0**20, 1.0], 0), (1, [-(2.0**26), 3.0], 0), (2, [2.0**22, -1.0], 0), (3, [0.5, 2.0**44], 0), (4, [1.0, 0.0], 0), (50, [3.0, -0.5], 0)]
    search = lambda rows: ranked(bitsliced.search(bitsliced.build(v := bitsliced.quantised(spark.createDataFrame(rows, VECTORS))), v.where(F.col("id") % 50 == 0), 5).collect())
    exact = lambda a, b: sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b, strict=True))
    assert search(rows) == brute(rows, 50, 5, lambda v: True, exact)
    s = bitsliced.Slices.build(np.arange(4), np.array([[-(2**63) + 1], [2**63 - 1], [0], [-1]]))
    assert [x.tolist() for x in s.top(np.array([-1]), 4)] == [[0, 1, 2, 3], [2**63 - 1, -(2**63) + 1, 0, 1]]
    for wide in ([2.0**40, 1.0], [2.0**60, 1.0]):  # a score, a component beyond a long
        with pytest.raises(Exception, match="fit a long"):
            search([*rows, (100, wide, 0), (101, wide, 0)])


@pytest.mark.parametrize("shard", [100, 1 << 13])
def test_hnsw(spark, shard):
    rows = vector_rows()
    rows[7] = (7, [float(np.float32(100 * x)) for x in rows[7][1]], 0)  # lengths differ: the largest inner product is not the nearest
    v = hnsw.vectors(spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("x")))
    got = ranked(hnsw.search(hnsw.build(v, shard), v.where(F.col("id") % 20 == 0), 20, width=128, chunk=9).collect())
    want = {q: x for q, x in brute(rows, 20, 20, any, lambda a, b: float(np.dot(np.float64(a), np.float64(b)))).items() if x}
    assert set(got) == set(want)
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / sum(map(len, want.values()))
    assert hit > 0.97
    assert all(len(got[q]) == len(want[q]) and q not in [i for i, _ in got[q]] for q in want)
    scores = {q: dict(brute(rows, 20, 10**6, any, lambda a, b: float(np.dot(np.float64(a), np.float64(b))))[q]) for q in list(want)[:5]}
    assert all(abs(scores[q][i] - s) < 1e-9 for q in scores for i, s in got[q])
    assert hnsw.search(hnsw.build(v.limit(0), shard), v.limit(0), 20).count() == 0


def test_more_neighbours_than_width(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), [float(x) for x in rng.normal(size=16)], 0) for i in range(1000)]
    v = hnsw.vectors(spark.createDataFrame(rows, VECTORS))
    for shard, k in ((1 << 13, 200), (300, 200), (1 << 13, 2000)):
        got = ranked(hnsw.search(hnsw.build(v, shard), v.where(F.col("id") % 250 == 0), k, width=32).collect())
        assert set(got) == {0, 250, 500, 750} and all(len(x) == min(k, 999) for x in got.values())
    want = brute(rows, 250, 2000, any, lambda a, b: float(np.dot(np.float32(a).astype(float), np.float32(b).astype(float))))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    far = [(int(i), [float(x) for x in (rng.normal(size=4) * 1e-3 + 100 * (i % 3 - 1))], 0) for i in range(90)]  # parts that no link may join
    v = hnsw.vectors(spark.createDataFrame(far, VECTORS))
    got = ranked(hnsw.search(hnsw.build(v, m=2, width=4), v, 89, width=4).collect())
    assert all(len(x) == 89 for x in got.values())


def test_queries_of_one_id(spark):
    rows = [(20, [1.0, 0.0], 0), (20, [0.0, 1.0], 0), (1, [5.0, 1.0], 0), (2, [1.0, 5.0], 0), (100, [2.0, 2.0], 0), (100, [2.0, 2.0], 0)]
    both = {(20, ((1, 5.0), (100, 2.0), (100, 2.0), (2, 1.0))), (20, ((2, 5.0), (100, 2.0), (100, 2.0), (1, 1.0)))}
    df = spark.createDataFrame(rows, VECTORS)
    for scale, found in ((1, hnsw.search(hnsw.build(v := hnsw.vectors(df)), v.where("id = 20"), 9)), (65536, bitsliced.search(bitsliced.build(v := bitsliced.quantised(df)), v.where("id = 20"), 9))):
        got = [(r.query_id, r["rank"], r.vec_id, r.score / scale) for r in found.collect()]
        one = {(q, tuple((i, s) for i, s in x)) for q, x in both}
        for q, x in one:
            assert all((q, n + 1, i, s) in got for n, (i, s) in enumerate(x))
        assert len(got) == 8


def test_blocks_stay_where_they_are(spark):
    """However many tasks and lots there are, answers are the same."""
    rng = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in rng.normal(size=6)], 0) for i in range(500)] + [(1000 + i, [float(x) for x in rng.normal(size=3)], 0) for i in range(0, 60, 5)]
    v = bitsliced.quantised(spark.createDataFrame(rows, VECTORS))
    index, asked = bitsliced.build(v, 30), v.where(F.col("id") % 5 == 0)
    got = [sorted(bitsliced.search(index, asked, 5, chunk, held, tasks).collect()) for chunk, held, tasks in ((7, 1, 1), (7, 16, 1), (200, 3, 40), (3, 16, 500))]
    assert got[0] == got[1] == got[2] == got[3] and len(got[0]) == 5 * 112


@pytest.mark.parametrize("lengths", [0.0, 1.0])
def test_hnsw_recall_on_hard_vectors(lengths):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4096, 64)) * np.exp(lengths * rng.normal(size=(4096, 1)))
    g = hnsw.Graph.build(x / np.abs(x).max())
    asked = np.arange(0, 4096, 20)
    s = x[asked] @ x.T
    s[np.arange(len(asked)), asked] = -np.inf
    want = np.argsort(-s, axis=1)[:, :20]
    got = g.search(x[asked], 224)
    assert sum(len(set(want[i]) & set(g.order[a[a >= 0]])) for i, a in enumerate(got)) / want.size >= 0.94


def test_hnsw_recall_on_the_table(spark):
    rows = table(spark, "/root/testdata/sf0.1", "embeddings").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = ranked(queries.op2_nearest_neighbours(spark, "/root/testdata/sf0.1").collect())
    hits = 0
    for q, found in got.items():
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        hits += len({i for i, _ in found} & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
    assert len(got) == (ids % 20 == 0).sum() and hits / (20 * len(got)) >= 0.9


# 3: near duplicates


def shingles(text, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def plain_near(rows, k, percent=80):
    """component of each row, by comparing all pairs."""
    sets = [shingles(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) or (rows[i][0] == rows[j][0] and rows[i][0] is not None and sets[i] and sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None and sets[i]:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(find(i), r[0]) if sets[i] else r[0]) for i, r in enumerate(rows)]


def near_rows(seed=3):
    rng = random.Random(seed)
    rows, i = list(AWKWARD), 100
    for family in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 3, 12, 80, 200]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            text = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 12 + 1))):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            rows.append((i, rng.choice([" ", "\n", "  "]).join(x.upper() if rng.random() < 0.2 else x for x in text)))
            i += 1
        base = base[: len(base) // 2] + [f"z{rng.randrange(10**6)}" for _ in range(len(base) // 2)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("words", "chunk"), [(2, 4096), (5, 4096), (2, 6)])
def test_near_duplicates(spark, words, chunk):
    rows = near_rows()
    got = neardup.near_duplicates(docs(spark, rows), neardup.Settings(words=words, chunk=chunk)).collect()
    assert sorted(map(repr, [tuple(r)[:3] for r in got])) == sorted(map(repr, plain_near(rows, words)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    stays = neardup.unique(docs(spark, rows), neardup.Settings(words=words, chunk=chunk))
    assert stays.columns == docs(spark, rows).columns
    keys = [r.doc_id for r in stays.collect()]
    assert len([k for k in keys if k is not None]) == len({k for k in keys if k is not None}) and set(keys) >= {r.component_id for r in got if r.doc_id is not None}
    assert neardup.near_duplicates(docs(spark, [])).count() == neardup.unique(docs(spark, [])).count() == 0


@pytest.mark.parametrize("heavy", [neardup.HEAVY, 3])
def test_near_duplicates_without_keys_and_of_one_key(spark, monkeypatch, heavy):
    monkeypatch.setattr(neardup, "HEAVY", heavy)
    long = [" ".join(f"{family}{i}" for i in range(60)) for family in "abcdef"]
    near = lambda text, *at: " ".join(f"other{i}" if i in at else w for i, w in enumerate(text.split()))
    rows = [(None, long[0]), (None, near(long[0], 0)), (None, near(long[0], 59))]  # only such documents
    rows += [(None, long[1].upper()), (None, long[1]), (None, long[1])]  # equal sets of several texts
    rows += [(40, near(long[2], *range(3))), (None, long[2]), (30, near(long[2], *range(57, 60)))]  # linked through one
    rows += [(7, long[3]), (7, long[4]), (9, near(long[3], 0)), (8, near(long[4], 0))]  # linked by a key's two texts
    rows += [(11, long[5])] * 40 + [(11, f"text {i} of one key") for i in range(40)] + [(None, None)] * 3
    plain = plain_near(rows, 2)
    assert {c for i, _, c in plain if i in (30, 40)} == {30} and {c for i, _, c in plain if i in (7, 8, 9)} == {7}
    got = neardup.near_duplicates(docs(spark, rows), neardup.Settings(words=2)).collect()
    assert sorted(map(repr, [tuple(r)[:3] for r in got])) == sorted(map(repr, plain))
    stays = [(r.doc_id, r.text) for r in neardup.unique(docs(spark, rows), neardup.Settings(words=2)).collect()]
    assert len(stays) == len(set(stays))
    assert sorted(t for i, t in stays if i == 7) == sorted(long[3:5]) and {i for i, _ in stays} == {None, 30, 7, 11}
    families = [t.split()[5].lower()[0] for i, t in stays if i is None and t]
    assert sorted(families) == ["a", "b"] and (None, None) in stays and sum(i == 11 for i, _ in stays) == 41


def test_bayes_bounds():
    steps = neardup.needed(neardup.Settings())
    rng = np.random.default_rng(1)
    s = 0.8 + 0.2 / 256
    same = (rng.random((200_000, 216)) < s).cumsum(axis=1)
    lost = np.zeros(len(same), bool)
    for n, least in steps:
        lost |= same[:, n - 1] < least
    assert lost.mean() < 2e-3  # at the very threshold; the posterior bound is on average over similarities
    low = (rng.random((1000, 216)) < 0.55).cumsum(axis=1)
    assert np.all([low[:, n - 1] < least for n, least in steps], axis=0).sum() < np.any([low[:, n - 1] < least for n, least in steps], axis=0).sum() > 990


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(900, 1000)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)] + [(5, 5), (-3, 7), (-3, 7)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a BIGINT, b BIGINT")).collect()}
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for p in links if p[0] != p[1] for x in p}
    assert components.components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


# 4: pieces


def test_pieces(spark):
    rows = AWKWARD + [(100 + i, t) for i, t in enumerate(["▁a", "a▁ b", "<s> </s>", "<0x0A>", "\x00\x01", "é́", "　x ", "▁▁▁", "日本語🙂", "a  b   c", "�"])]
    rows += [(500 + r.doc_id, r.text) for r in table(spark, DIR, "documents").collect()]
    rows += [(90000 + i, ["a copy\nof two lines", None, "", "another copy"][i % 4]) for i in range(40)]
    got = pieces.encode(docs(spark, rows), queries.TOKENIZER, verify=1.0).collect()
    other = sentencepiece.SentencePieceProcessor(model_file=queries.TOKENIZER)
    want = [(r[0], tuple(other.encode(r[1] or ""))) for r in rows]
    assert sorted(map(repr, [(r.doc_id, tuple(r.ids)) for r in got])) == sorted(map(repr, want))
    assert all(r.n_tokens == len(r.ids) and r.round_trip for r in got)
    coded = spark.createDataFrame([(r.doc_id, r.ids) for r in got] + [(9, None)], "doc_id BIGINT, ids ARRAY<INT>")
    back = sorted((r.text for r in pieces.decode(coded, queries.TOKENIZER).collect()), key=repr)
    assert back == sorted([other.decode(r.ids) for r in got] + [None], key=repr)
    assert pieces.encode(docs(spark, []), queries.TOKENIZER).count() == 0


def test_queries_verify_every_text(spark, tmp_path, monkeypatch):
    import corpus_pipeline as cp
    from larkspur.llm.common import share_of

    def crooked(data, threads):
        from types import SimpleNamespace

        from larkspur.llm.pieces import _loaded

        model, tokenizer = _loaded(data, threads)
        wrong = lambda batch, add_special_tokens: [SimpleNamespace(ids=[*e.ids, 0]) for e in tokenizer.encode_batch_fast(batch, add_special_tokens=add_special_tokens)]
        return model, SimpleNamespace(encode_batch_fast=wrong)

    unchecked = spark.range(64).where(~share_of(F.col("id"), 0.125, 17)).first().id  # not in the eighth that was once verified
    docs(spark, [(unchecked, "a text")]).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(pieces, "_loaded", crooked)
    with pytest.raises(Exception, match=f"{unchecked}: "):
        pieces.encode(docs(spark, [(unchecked, "a text")] * 3), queries.TOKENIZER).collect()
    for run in (queries.op4_sentencepiece, lambda spark, folder: cp.encode(spark, table(spark, folder, "documents"), folder)):
        with pytest.raises(Exception, match="ids by sentencepiece"):
            run(spark, str(tmp_path)).collect()


def field(number, value):
    if isinstance(value, int):
        return bytes([number << 3, value])
    return bytes([number << 3 & 127 | 2]) + bytes([len(value)]) + value if number < 16 else bytes([number << 3 & 127 | 130, number >> 4, len(value)]) + value


def test_unigram_model():
    import struct

    names = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("▁", -3.0, 1), ("▁ab", -1.0, 1), ("a", -4.0, 1), ("b", -4.0, 1), ("ab", -2.5, 1), ("c", -4.0, 1), ("▁abc", -2.0, 1)]
    data = b""
    for p, s, kind in names:
        body = field(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s) + field(3, kind)
        data += field(1, body)
    data += field(2, field(3, 1) + field(4, len(names))) + field(3, field(1, b"identity") + field(3, 1) + field(4, 1) + field(5, 1))
    ours, other = pieces.Model.parse(data).tokenizer(), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in ("abc", "ab c", " ab  abc ", "cab", "", "a", "xyz ab", "  "):
        assert ours.encode(text, add_special_tokens=False).ids == other.encode(text), text


def test_model_with_a_character_map():
    import struct

    rules = sentencepiece.SentencePieceNormalizer(rule_name="nfkc_cf").serialized_model_proto()
    charsmap = dict(pieces._fields(dict(pieces._fields(rules))[3]))[2]
    names = [("<unk>", 0.0, 2), ("▁", -3.0, 1), ("▁ab", -1.0, 1), ("a", -4.0, 1), ("b", -4.0, 1), ("c", -4.0, 1), ("ss", -4.0, 1), *[(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]]
    data = b"".join(bytes([1 << 3 | 2, len(body)]) + body for body in (field(1, p.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", s) + field(3, kind) for p, s, kind in names))

    def varint(n):
        return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)

    trainer = field(3, 1) + varint(35 << 3) + b"\x01"
    spec = bytes([2 << 3 | 2]) + varint(len(charsmap)) + charsmap + field(3, 1) + field(4, 1) + field(5, 1)
    data += bytes([2 << 3 | 2]) + varint(len(trainer)) + trainer + bytes([3 << 3 | 2]) + varint(len(spec)) + spec
    model = pieces.Model.parse(data)
    ours, other = model.tokenizer(), sentencepiece.SentencePieceProcessor(model_proto=data)
    for text in ("AB c", "ＡＢ  ｃ", "ß ab", "①", " a ", "", "日本 ab"):
        ids = ours.encode(text, add_special_tokens=False).ids
        assert ids == other.encode(text), text
        assert ours.decode(ids, skip_special_tokens=False) == model.plain(text, ours) == other.decode(ids)


# 6: mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, out, free = 1.5 * sum(sizes.values()), {}, list(names)
    while free:
        level = (total - sum(out.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        free = [s for s in free if s not in over]
    return out


@pytest.mark.parametrize("group", [8, 1024])
def test_mixing(spark, group):
    rng = random.Random(5)
    rows = AWKWARD + [(100 + i, "w " * int(rng.paretovariate(1.2) * 20), rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(900)]
    mixed = mixing.mix(docs(spark, rows), prefix="m", group=group, fan_in=4)
    assert mixed.columns[: len(docs(spark, rows).columns)] == docs(spark, rows).columns
    got = mixed.collect()
    assert sorted((repr(r.doc_id), r.m_size) for r in got) == sorted((repr(r[0]), len(WORD.findall(r[1] or ""))) for r in rows)
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.m_size
    want = plain_targets(sizes)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert all(abs(r.m_target - want[s]) < 1e-6 * max(want[s], 1) and r.m_source_size == sizes[s] for r in own)
        taken = sum(r.m_size * r.m_copies for r in own)
        share = want[s] / sizes[s] if sizes[s] else 0
        assert all(np.floor(share - 1e-9) <= r.m_copies <= np.ceil(share) or r.m_size == 0 for r in own)
        assert abs(taken - want[s]) <= max((r.m_size for r in own), default=0)
    again = mixing.mix(docs(spark, rows[::-1]).repartition(3), prefix="m", group=group, fan_in=4).collect()
    assert sorted(map(repr, [(r.doc_id, r.m_copies) for r in got if r.doc_id and r.doc_id > 50])) == sorted(map(repr, [(r.doc_id, r.m_copies) for r in again if r.doc_id and r.doc_id > 50]))
    assert mixing.mix(docs(spark, []), prefix="m").count() == 0


def test_pivotal_is_fair():
    size, p = np.array([5.0, 1, 9, 3, 3, 40, 2, 0]), np.array([0.3, 0.5, 0.2, 0.9, 0.01, 0.4, 1.0, 0.5])
    total, rounds = np.zeros(8), 4000
    for i in range(rounds):
        got, at = mixing.pivotal(size, p, np.random.default_rng(i))
        assert all(g in (0, 1) for j, g in enumerate(got) if j != at) and abs(got @ size - (p * (size > 0)) @ size) < 1e-6
        total += got
    assert np.abs(total / rounds - p * (size > 0)).max() < 0.04


# 7 and 8: classifiers


def labelled(spark, n=600, seed=6):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(10, n + 10):
        toxic, grade = rng.random() < 0.2, rng.randrange(3)
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 120))] + ["| #|"] * (grade == 0) * 5 + [f"fine{rng.randrange(4)}"] * grade * 3
        if toxic:
            words += rng.choices(["vile", "vileness", "rotten", "fool!"], k=2)
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        if rng.random() < 0.8:
            labels.append((i, grade, int(toxic)))
    labels += [(None, 1, 1), (3, None, None), (10**6, 1, 1)]
    return rows, spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")


def test_toxicity(spark):
    rows, labels = labelled(spark)
    d = docs(spark, rows + AWKWARD)
    model = toxicity.train(d, labels)
    got = toxicity.score(d, model, "p").collect()
    assert len(got) == len(rows) + len(AWKWARD) and all(0 <= r.p <= 1 for r in got) and got[0].score == "mine"
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(truth[r.doc_id], r.p >= 0.5) for r in got if truth.get(r.doc_id) is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert all(r.p < 0.5 for r in got if not r.text)
    for r in got[:200]:
        z = model.bias + sum(model.weights.get(f, 0.0) for f in toxicity.features(r.text))
        assert abs(r.p - 1 / (1 + np.exp(-z))) < 1e-9
    # Labels of the held-out fold change nothing, and labels, language and source are no inputs.
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(d, other).weights == model.weights
    empty = toxicity.train(d, labels.limit(0))
    assert not empty.weights and all(r.p < 0.5 for r in toxicity.score(d, empty, "p").collect())
    assert toxicity.score(docs(spark, []), model, "p").count() == 0
    assert toxicity.train(docs(spark, []), labels).weights == {}


def test_risk():
    """Both branches of the estimator against its definition, and the directions against differences."""
    rng = np.random.default_rng(3)
    log = lambda z: np.log1p(np.exp(z))
    for prior, lift in ((0.1, 0.0), (0.6, 5.0), (0.3, -2.0)):
        gp, gu = rng.normal(size=7) + lift, rng.normal(size=11) - lift
        plus, minus = prior * log(-gp).mean(), log(gu).mean() - prior * log(gp).mean()
        got, dp, du = toxicity.risk(gp, gu, prior)
        assert abs(got - (plus + max(minus, 0))) < 1e-12 and (minus < 0) == (lift > 0)
        objective = (lambda p, u: prior * log(-p).mean() + log(u).mean() - prior * log(p).mean()) if minus >= 0 else lambda p, u: prior * log(p).mean() - log(u).mean()  # noqa: B023
        e = 1e-6
        for i, x in enumerate(np.eye(len(gp))):
            assert abs((objective(gp + e * x, gu) - objective(gp - e * x, gu)) / (2 * e) - dp[i]) < 1e-7
        for i, x in enumerate(np.eye(len(gu))):
            assert abs((objective(gp, gu + e * x) - objective(gp, gu - e * x)) / (2 * e) - du[i]) < 1e-7


def test_nnpu_lowers_the_risk():
    rng = np.random.default_rng(4)
    p_rows = [np.array(sorted({0, int(rng.integers(1, 6))})) for _ in range(60)]
    u_rows = [np.array(sorted({int(rng.integers(1, 6))} | ({0} if rng.random() < 0.2 else set()))) for _ in range(300)]
    w, b = toxicity.nnpu(p_rows, u_rows, 6, 0.2)
    at = lambda w, b: toxicity.risk(*(np.array([b + w[r].sum() for r in rows]) for rows in (p_rows, u_rows)), 0.2)[0]
    start = np.log(0.2 / 0.8)
    assert at(w, b) < 0.5 * at(np.zeros(6), start) and w[0] > 2 > abs(w[1:]).max()
    plain, least = min(((at(np.array([x, 0, 0, 0, 0, 0]), y), (x, y)) for x in np.arange(0, 16, 0.5) for y in np.arange(-10, 2, 0.5)))  # a grid over the one feature that tells
    assert at(w, b) < plain + 0.05, least
    assert toxicity.nnpu([], u_rows, 6, 0.2)[1] < 0 and len(toxicity.nnpu([], [], 0, 0.5)[0]) == 0


def test_training_is_bounded(spark):
    rows, labels = labelled(spark)
    d = docs(spark, [*rows, (10**7, "long " * 300_000)])
    from larkspur.llm.common import thinned

    kept = thinned(d, "doc_id", "text", 50_000, 7)
    assert 0 < kept.count() < 60 and kept.join(d.select("doc_id"), "doc_id", "left_anti").isEmpty()
    assert thinned(d, "doc_id", "text", 10**9, 7).count() == d.count()
    few = toxicity.train(docs(spark, rows), labels, text_bytes=100_000)
    assert any(f.startswith(("vile", "rotten", "fool")) for f in few.weights)
    assert len(quality.train(d, labels, text_bytes=100_000).grades) == 3


def test_toxicity_on_the_table(spark):
    got = queries.op7_toxicity(spark, "/root/testdata/sf0.1").collect()
    truth = {r.doc_id: r.toxic for r in table(spark, "/root/testdata/sf0.1", "labels").collect()}
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in truth]
    assert len(got) == 10_000 and sum(a == b for a, b in held) / len(held) > 0.97
    assert sum(a == 1 == b for a, b in held) / sum(a for a, _ in held) > 0.85


def test_quality(spark):
    rows, labels = labelled(spark)
    d = docs(spark, rows + AWKWARD)
    model = quality.train(d, labels)
    assert model.grades == [0.0, 1.0, 2.0] and model.thresholds[0] < model.thresholds[1]
    got = quality.grade(d, model).collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(truth[r.doc_id], r.expected_grade) for r in got if r.held_out and truth.get(r.doc_id) is not None]
    assert np.mean([abs(a - b) < 0.75 for a, b in held]) > 0.85 and np.corrcoef(*zip(*held, strict=True))[0, 1] > 0.8
    assert len(got) == len(rows) + len(AWKWARD) and all(0 <= r.tail_prob <= 1 and r.kept == (r.tail_prob >= 0.5) for r in got)
    assert all(r.kept and r.tail_prob is None for r in quality.grade(d, quality.train(d, labels.limit(0))).collect())
    one = quality.train(d, labels.withColumn("quality", F.lit(4)))
    assert {r.expected_grade for r in quality.grade(d, one).collect()} == {4.0}


def test_likelihood():
    """Mean -log P(grade) against its definition, and the gradient against differences."""
    rng = np.random.default_rng(5)
    z, level, t = rng.normal(size=20), rng.integers(0, 4, 20), np.array([-1.0, 0.2, 1.5])
    got, dz, dt = quality.likelihood(z, level, t)
    sig = lambda x: 1 / (1 + np.exp(-x))
    edges = np.array([-np.inf, *t, np.inf])
    plain = lambda z, t: -np.mean([np.log(sig(e[x + 1] - y) - sig(e[x] - y)) for e in [np.array([-np.inf, *t, np.inf])] for x, y in zip(level, z, strict=True)])
    assert abs(got - plain(z, t)) < 1e-12 and len(edges) == 5
    e = 1e-6
    assert all(abs((plain(z + e * x, t) - plain(z - e * x, t)) / (2 * e) - dz[i]) < 1e-7 for i, x in enumerate(np.eye(20)))
    assert all(abs((plain(z, t + e * x) - plain(z, t - e * x)) / (2 * e) - dt[i]) < 1e-7 for i, x in enumerate(np.eye(3)))
    # What is fitted beats other thresholds and a weight that is no use.
    rows = [(np.array([int(x)], np.int32), np.ones(1, np.float32)) for x in rng.integers(0, 3, 600)]
    y = np.array([float(r[0][0] if rng.random() < 0.9 else rng.integers(0, 3)) for r in rows])
    model = quality.fit(rows, y)
    z = np.array([model.weights[r[0]].sum() for r in rows], float)
    best = quality.likelihood(z, y.astype(int), model.thresholds)[0]
    assert best < 0.55 and best < quality.likelihood(0 * z, y.astype(int), model.thresholds)[0] and all(best < quality.likelihood(z, y.astype(int), model.thresholds + s)[0] + 1e-3 for s in (-1, -0.3, 0.3, 1))


# 9: WARC


def test_warc(spark, tmp_path):
    rng = random.Random(7)
    bodies = ["x" * 99, "y" * 100, "é" * 50, "a\r\n\r\nWARC/1.1 " * 20, "", None, "big " * 200_000]
    rows = [(i, f"http://h/{i}", rng.choice(bodies)) for i in range(200)] + [(5, "http://h/5", "y" * 100), (None, None, "y" * 100), (-4, "u\r\nX: y", "y" * 100), (None, "", None)]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").withColumn("digest", F.lit("mine")).withColumn("first", F.lit(0))
    archives = warc.write(pages, frame_bytes=20_000, bundle_bytes=300_000)
    got = warc.read(archives)
    first = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 100 and i is not None:
            first[html] = min(first.get(html, i), i)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        to = first.get(html) if len(body) >= 100 and i != first.get(html) else None
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if to is None else "revisit", to))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(repr, [tuple(r) for r in got.select(columns).collect()])) == sorted(map(repr, want))
    held = got.where("record_type = 'response' and page_id is not null")
    back = {r.page_id: bytes(r.payload).decode() for r in warc.lookup(archives, held).collect()}
    text = {i: html or "" for i, _, html in rows[:200]}
    assert back and all(back[i] == text[i] for i in back if i in text)
    warc.store(pages, f"{tmp_path}/s", frame_bytes=20_000, bundle_bytes=300_000)
    indexed = warc.offsets(spark, f"{tmp_path}/s")  # the index written along says where each record lies
    where = ["page_id", "archive", "frame", "offset", "length"]
    assert sorted(map(repr, indexed.select(where).collect())) == sorted(map(repr, warc.read(warc.archives(spark, f"{tmp_path}/s")).select(where).collect()))
    back = {r.page_id: bytes(r.payload).decode() for r in warc.lookup(warc.archives(spark, f"{tmp_path}/s"), indexed.where("page_id % 3 = 0")).collect()}
    assert {i for i in back} == {i for i, *_ in rows if i is not None and i % 3 == 0}
    for path in (tmp_path / "s/archives").rglob("*.txt"):  # each file is a whole archive
        assert zstandard.ZstdDecompressor().stream_reader(path.read_bytes(), read_across_frames=True).read().startswith(b"WARC/1.1\r\n") and warc.seek_table(path.read_bytes())
    said = warc.export(archives, f"{tmp_path}/w").collect()
    assert len(said) == archives.count() > 1
    for r in said:  # any reader of Zstandard can take a bundle as a whole
        data = (tmp_path / "w" / r.archive).read_bytes()
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert whole.startswith(b"WARC/1.1\r\n") and len(whole) == sum(x[2] for x in warc.seek_table(data))
    assert warc.read(warc.write(pages.limit(0))).count() == 0
    with pytest.raises(ValueError):
        warc.seek_table(b"x" * 20)


# 10: sharding


def test_sharding(spark):
    rows = AWKWARD + [(i, "t" * (i % 7)) for i in range(10, 1500)] + [(77, "same")] * 40
    got = sharding.shard(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    place = lambda k, n: max(range(n), key=lambda s: (int(hashlib.md5(f"{'null' if k is None else k}:{s}".encode()).hexdigest()[:13], 16), -s))
    for r in got:
        assert (r.shard, r.grown_shard, r.law) == (place(r.doc_id, 24), place(r.doc_id, 25), "key") and r.grown_shard in (r.shard, 24)
    texts = sorted((repr(r[0]), len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in got) == texts
    for s in range(24):
        own = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        keys = [r.doc_id for r in own if r.doc_id is not None]
        assert keys == sorted(keys)
    heavy = sharding.shard(docs(spark, [(i, "") for i in range(4000)]), weights=[1, 3, 0, 2]).groupBy("shard").count().collect()
    assert {r.shard: round(r["count"] / 4000 * 6) for r in heavy} == {0: 1, 1: 3, 3: 2}
    assert sharding.shard(docs(spark, [])).count() == 0


# the pipeline


def test_pipeline(spark):
    import corpus_pipeline as cp

    raw = table(spark, DIR, "documents")
    stage = dict(cp.STAGES)
    assert [s for s, _ in cp.STAGES] == ["toxicity", "near_dedup", "secret_scans", "source_mixing", "sentencepiece"]
    model = toxicity.train(raw, table(spark, DIR, "labels"))
    kept = stage["toxicity"](spark, raw, DIR).collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in raw.collect() if model.score(r.text) < 0.5)
    second = stage["near_dedup"](spark, spark.createDataFrame(kept, raw.schema), DIR).collect()
    plain = plain_near([(r.doc_id, r.text) for r in kept], 5)
    assert sorted(r.doc_id for r in second) == sorted(i for i, _, c in plain if i == c)
    third = stage["secret_scans"](spark, spark.createDataFrame(second, raw.schema), DIR).collect()
    assert {r.doc_id: r.text for r in third} == {r.doc_id: secrets.redact(r.text) for r in second}
    fourth = stage["source_mixing"](spark, spark.createDataFrame(third, raw.schema), DIR)
    assert fourth.columns == raw.columns
    mixed = mixing.mix(spark.createDataFrame(third, raw.schema)).where("mix_copies > 0").select("doc_id", "mix_copies")
    assert sorted(fourth.groupBy("doc_id").count().collect()) == sorted(mixed.collect())
    assert cp.run(spark, DIR).count() == fourth.count()
    for name, f in cp.STAGES:  # on awkward and on no documents
        for rows in (AWKWARD, []):
            d = spark.createDataFrame([(r[0], r[1], None, r[2], None) for r in rows], DOCS)
            out = f(spark, d, DIR)
            assert out.count() <= 2 * len(rows) and (name == "sentencepiece" or out.columns == d.columns)

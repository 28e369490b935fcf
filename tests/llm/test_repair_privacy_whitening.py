"""Conversation repair, personal data and whitening against brute force, SQL, and on awkward rows."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricemill.llm import conversations, personal_data, whitening
from pricemill.llm.sql import PERSONAL_DATA_SQL

SMALL = "/root/testdata/sf0.001"
SPACES = " \t\n\x0b\x0c\r"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
NAMES = {"u": "user", "a": "assistant"}


def faults_of(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        if not text.strip(SPACES):
            faults.append("b")
        elif (role, text) in seen:
            faults.append("d")
        else:
            faults.append("t" if text.rstrip(SPACES)[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def cheapest(rows):
    """Uniform-cost search over (cost, edits): the least cost and, of equal costs, the ASCII-least edits."""
    faults, heap, done = faults_of(rows), [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, said = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            turns = [t for t, _, _ in rows if t is not None]
            return (
                max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False)),
                cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest(),
            )
        if (i, state) in done:
            continue
        done.add((i, state))
        for to in NEXT[state].keys() & NAMES.keys():
            heapq.heappush(heap, (cost + 5, audit + "I", i, to, (*said, NAMES[to] + ":")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, said))
            if faults[i] not in ("b", "d"):
                more = cost + 5 * (faults[i] == "t")
                if role[:1] in NEXT[state]:
                    heapq.heappush(heap, (more, audit + "K", i + 1, role[:1], (*said, f"{role}:{text}")))
                for to in NEXT[state].keys() & NAMES.keys():
                    heapq.heappush(heap, (more + 1, audit + "R", i + 1, to, (*said, f"{NAMES[to]}:{text}")))


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        spaced = [" " if v is None else v for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20
        role, text = ("user" if kind == 4 else spaced[2]), spaced[3]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def check_repairs(df, rows):
    result = {r.conv_id: tuple(r)[1:] for r in conversations.repair_damaged(df).collect()}
    assert result == {conv: cheapest(after) for conv, after in damaged(rows).items()}
    return result


@pytest.mark.parametrize("piece", [128, 3])
def test_repairs_equal_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    df = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    check_repairs(df, [tuple(r) for r in df.collect()])


AWKWARD_TURNS = [
    (None, 1, "user", "A."), (None, 2, "assistant", "B."), (1, None, "user", "no turn."), (1, None, None, "x."), (1, 5, "user", None),
    (1, 5, "user", "tie."), (1, 5, "assistant", "tie."), (2, 0, "system", "S."), (2, 1, "user", "q?"), (2, 2, "assistant", "a!"),
    (2, 2, "assistant", "a!"), (2, 9, "", "no role."), (2, 10, "operator", "other"), (3, 0, None, None), (4, 0, "user", " "),
    (5, 0, "assistant", "word " * 20_000 + "end."), (6, -3, "user", "  \t\n"), (7, 2**40, "user", "far."), (7, 1, "assistant", "near?"),
]


@pytest.mark.parametrize("piece", [128, 2])
def test_repairs_of_awkward_rows(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    df = spark.createDataFrame(AWKWARD_TURNS, "conv_id long, turn long, role string, text string")
    crowded = df.withColumns({c: F.lit(7) for c in ("n", "code", "part", "piece", "said", "fault", "_conv", "cost", "first")})
    check_repairs(crowded, AWKWARD_TURNS)
    assert conversations.repair_damaged(df.limit(0)).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = conversations.repair_damaged(spark.createDataFrame([(dropped, 0, "user", "Hi.")], df.schema)).collect()
    assert [tuple(r) for r in row] == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_a_long_conversation_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 16)
    dealt = random.Random(7)
    rows = [
        (1, t // 2, dealt.choice(["user", "assistant", "user", "assistant", "system"]), dealt.choice(["Yes.", "No", "", f"Text {t}.", f"Cut {t}"]))
        for t in range(600)
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    check_repairs(df, rows)


def test_search_is_exhaustive_on_short_rows():
    for code in ("", "x", "s", "su", "sua", "ua", "au", "aa", "uu", "S", "UA", "uA", "sx.", "uxa", "a.U", "ssuaa", "xuXa".replace("X", "x")):
        cost, edits = conversations.whole(code)
        rows = [(0, {"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "other"), f"{i}{'' if c.isupper() else '.'}" if c != "x" else "")
                for i, c in enumerate(code)]
        assert (cost, edits) == cheapest(rows)[5:7], code


HARD = [
    "mail a@b.c_d@e.f and x..y@z.q.", "a@b.c@d.e ,@x.y a@.b a@b", "IBAN DE89 3704 0044 0532 0130 00 BIC COBA",
    "ES91 2100 0418 4502 0005 1332 THIS IS", "XDE89370400440532013000", "DE89370400440532013000",
    "DE89370400440532013001 sample GB82WEST12345698765432 example", "ssn 123-45-6789, 123-45-6789 000-12-3456", "part 123-45-6789",
    "call (555) 555-1234 or 555.555.1234 tel: +1 (555) 555-1234", "1.2.3.4.5.6.7.8 256.1.1.1 00000255.1.1.1 1.2.3",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111-", "+1 2345678901 +12 +1 () 2",
    "é 日本 😀 mail é.x@y.de 😀 +49 (30) 1234567 -", "1 2 3 4 5 6 7 8 9 " * 40, "+1-2" * 50, None, "", "a@b.cc " * 700, "\n\t1.1.1.1\r\n",
    "FR76 3000 6000 0112 3456 7890 189", "telephone 555 555 1234", "phone5555551234 phone 555-555-12345", "9" * 30, "0 " * 13, "x@" * 100 + "y.z",
]


def base_spans(text):
    found = []
    for kind in personal_data.BASE:
        for m in re.finditer(kind.proposes, text):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(digits[::-1]))
            valid = {
                "email": True, "ip": kind.name == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and doubled % 10 == 0, "phone": 9 <= len(digits) <= 15,
            }[kind.name]
            if valid:
                found.append(f"{kind.name}:{m.start()}:{m.end()}")
    return found


def test_personal_data(spark):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(None, "a@b.c"), (3, "again 1.1.1.1"), (3, "again 1.1.1.1")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("spans", "_spans", "_pii_row", "value")})
    result = sorted([tuple(r) for r in personal_data.digest_personal_data(df).collect()], key=str)
    by = {r[0]: r for r in result}
    for i, text in enumerate(HARD):
        if i == 3:
            continue
        base = base_spans(text or "")
        kinds = [b.split(":")[0] for b in base]
        assert by[i][1:5] == tuple(kinds.count(k.name) for k in personal_data.BASE), text
        assert by[i][-2] == hashlib.sha256(",".join(base).encode()).hexdigest(), text
    assert by[2][-1] == "iban:5:32" and by[5][-1] == "iban:0:22" and by[4][-1] == "" == by[8][-1]
    assert by[7][-1] == "ssn:4:15" and by[21][-1] == "tel:10:22"
    duck = duckdb.connect()
    duck.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    assert sorted(duck.execute(PERSONAL_DATA_SQL).fetchall(), key=str) == result
    assert personal_data.digest_personal_data(df.limit(0)).count() == 0


def test_personal_data_plan_is_native(spark):
    plan = personal_data.digest_personal_data(spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan.split("== Physical Plan ==")[1])


def test_context_adjusts_scores(spark):
    df = spark.createDataFrame([(1, "server 10.0.0.1"), (2, "version 10.0.0.1"), (3, "10.0.0.1")], "doc_id long, text string")
    scores = {r.doc_id: r.spans[0].score for r in personal_data.find_personal_data(df).collect()}
    assert scores[1] > scores[3] > scores[2]


def test_many_matches_in_one_text(spark):
    df = spark.createDataFrame([(1, "a@b.c " * 20_000 + "x" * 500_000)], "doc_id long, text string")
    row = personal_data.digest_personal_data(df).first()
    assert row.n_email == 20_000 and row.spans.endswith(f"email:{6 * 19_999}:{6 * 19_999 + 5}")


def expected_whitening(rows):
    """(vec_id, x) by the definition, and the eigenvectors of the covariance of the distinct vectors."""
    width = max(len(v) for _, v in rows)
    x = [(i, tuple([*(int(np.floor(256 * float(c))) for c in v), *[0] * (width - len(v))])) for i, v in rows]
    fit = np.array(sorted({v for _, v in x}), float)
    centred = fit - fit.mean(0)
    values, vectors = np.linalg.eigh(centred.T @ centred / len(fit))
    return x, fit, values[::-1], vectors[:, ::-1]


def check_whitening(result, rows, count):
    x, fit, values, vectors = expected_whitening(rows)
    sums, n = fit.sum(0).astype(int), len(fit)
    assert len(result) == count * len(rows)
    by = defaultdict(list)
    for r in result:
        by[r.component].append(r)
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-10
    distances = sorted(int(((n * np.array(v) - sums) ** 2).sum()) for _, v in x)
    for k, of in by.items():
        assert sorted(r.deviation for r in of) == distances
        scores = np.sort([(np.array(v) - fit.mean(0)) @ vectors[:, k - 1] / np.sqrt(values[k - 1]) for _, v in x])
        got = np.sort([r.whitened for r in of])
        assert min(np.abs(scores - got).max(), np.abs(np.sort(-scores) - got).max()) < 1e-8


def test_whitening_equals_the_eigenvectors(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    check_whitening(whitening.whiten(df).collect(), [(r.vec_id, r.embedding) for r in df.collect()], 4)


def test_whitening_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [0.5, 0.25, -1.0]), (2, [0.5, 0.25, -1.0]), (2, [3.0, 1.0]), (None, [0.0, 0.7, 0.1]), (5, [-2.0, 0.3, 0.9]), (6, [])]
    bad = [(7, None), (8, [nan, 1.0, 1.0]), (9, [inf, 0.0, 0.0]), (10, [1.0, None, 0.0]), (11, [-inf, 0.0, 0.0])]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<float>")
    crowded = df.withColumns({c: F.lit(7) for c in ("x", "i", "v", "n", "component", "data")})
    check_whitening(whitening.whiten(crowded).collect(), good, 3)
    for empty in (df.limit(0), df.where("vec_id = 7"), df.where("vec_id = 1"), df.where("vec_id = 6")):
        assert whitening.whiten(empty).count() == 0


def test_equal_eigenvalues_and_few_dimensions(spark):
    rows = [(i, [float(s) if j == d else 0.0 for j in range(6)]) for i, (d, s) in enumerate((d, s) for d in range(3) for s in (-1, 1))]
    result = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in result} == {1, 2, 3} and all(r.identity_error < 1e-9 for r in result)
    assert all(abs(r.explained - 1 / 3) < 1e-9 for r in result)


def test_deviations_beyond_a_long():
    rows = np.array([[2**40, 0], [0, 1]], np.int64)
    assert whitening.deviations(rows, [2**40, 1], 2) == [None, None]
    assert whitening.deviations(rows[1:], [0, 1], 1) == [0]

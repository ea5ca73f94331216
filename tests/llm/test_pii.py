"""Spans against Python's re on awkward and random texts; validators of the method's own kinds."""

from __future__ import annotations

import hashlib
import random
import re

from keelson.llm.pii import find_pii, op3_pii
from tests.conftest import TESTDATA
from tests.llm.helpers import awkward_docs

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def brute(text):
    out, counts = [], []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        found = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((m.start(), k, m.end(), kind))
        out += found
        counts.append(len(found))
    joined = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))
    return (*counts, hashlib.sha256(joined.encode()).hexdigest())


def check(rows, texts):
    for r in rows:
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == brute(texts[r.doc_id]), texts[r.doc_id]


def test_random_and_awkward_texts(spark):
    r = random.Random(1)
    texts = [
        "a@b.c_d@e.f x a@b.c..d@e.f ", "a@b.c@d.e", None, "", "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.0004", "@@a@b.cc@d.ee", "\x01 a@b.c\n1.1.1.1",
        "4111 1111 1111 1111 and 4111-1111-1111-1111 5", "x" * 3000 + "@b.co", "9" * 3000, "1." * 3000, "+1 (555) 123-4567 +49 30 1234567890123",
        "é😀 a@é.c a@b.c 4111111111111111", "+1" + "." * 3000, "a" * 3000,
    ]
    texts += ["".join(r.choice("aB1 2+.-@()_é\n45") for _ in range(r.randint(0, 60))) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = find_pii(df).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_very_long_texts(spark):
    """Linear time and no deep recursion on long runs."""
    texts = ["x" * 400_000 + "@b.co", "9" * 400_000, "1." * 20_000, "+1" + "." * 400_000, "a" * 400_000, "a@b.c " * 5000]
    rows = find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)).collect()
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows} == {
        0: (1, 0, 0, 0), 1: (0, 0, 0, 0), 2: (0, 5000, 0, 0), 3: (0, 0, 0, 0), 4: (0, 0, 0, 0), 5: (5000, 0, 0, 0)
    }


def test_own_kinds(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 ok", "DE88370400440532013000", "my ssn is 123-45-6789", "part 123-45-6789", "ssn 000-45-6789"]
    rows = find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    spans = {r.doc_id: [(f.kind, texts[r.doc_id][f.s : f.e]) for f in r.findings if f.kind in ("iban", "ssn")] for r in rows}
    assert spans == {0: [("iban", "DE89 3704 0044 0532 0130 00")], 1: [], 2: [("ssn", "123-45-6789")], 3: [], 4: []}


def test_awkward_docs_and_table(spark):
    df, texts = awkward_docs(spark)
    rows = find_pii(df).collect()
    assert len(rows) == len(texts)
    check([r for r in rows if r.doc_id is not None], dict(texts))
    assert find_pii(df.limit(0)).count() == 0
    sf = f"{TESTDATA}/sf0.01"
    check(op3_pii(spark, sf).collect(), {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()})


def test_iban_before_words_and_numbers(spark):
    """What follows an IBAN, after a space, is not taken into it; letters and the length of the country end it."""
    ibans = [
        "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "NL91ABNA0417164300", "FR14 2004 1010 0505 0001 3M02 606",
        "NO93 8601 1117 947", "CH9300762011623852957", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "PL61 1090 1014 0000 0712 1981 2874", "ES9121000418450200051332",
    ]
    after = ["Please pay", "BIC COBADEFFXXX", "I paid", "2024", "X", "ok", "", "DE89 3704 0044 0532 0130 00"]
    texts = [f"IBAN {i} {a}" for i in ibans for a in after] + ["DE89 3704 0044 0532 0130 0", "DE893704004405320130001", "PO12 3456 DE89 3704 0044 0532 0130 00"]
    rows = find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = {r.doc_id: [texts[r.doc_id][f.s : f.e] for f in r.findings if f.kind == "iban"] for r in rows}
    want = [[i, a] if a.startswith("DE") else [i] for i in ibans for a in after] + [[], [], ["DE89 3704 0044 0532 0130 00"]]
    assert [found[i] for i in range(len(texts))] == want

"""Secret scans against the re module, and the automaton against plain loops."""
import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rulebeam.llm import automaton
from rulebeam.llm.secret_scan import BASE, RULES, Rule, Scanner, op11_secret_scan, scan_secrets

SCANNER = Scanner()
KEYS = "|".join("".join(f"[{c.lower()}{c.upper()}]" for c in k) for k in ("password", "passwd", "secret", "token", "apikey"))
KEYS = f"{KEYS}|[aA][pP][iI]_[kK][eE][yY]"
PLAIN = {
    "assign": (re.compile(rf"""(?:{KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[1]) >= 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
    "github": (re.compile(r"gh[pousr]_([A-Za-z0-9]+)"), lambda m: len(m[1]) >= 36),
    "slack": (re.compile(r"xox[abprs]-([A-Za-z0-9-]+)"), lambda m: len(m[1]) >= 10),
    "jwt": (re.compile(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), lambda m: True),
    "private_key": (re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"), lambda m: True),
}


def brute(text):
    found = [(m.start(), i, kind, m.end()) for i, (kind, (regex, good)) in enumerate(PLAIN.items())
             for m in regex.finditer(text or "") if good(m)]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


def spans(texts, scanner=SCANNER):
    raw = [t.encode() for t in texts]
    return scanner.spans(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64))


PARTS = ["token", "secret", "Password", "PASSWD", "api_key", "apikey", "AKIA", "=", ":", " ", '"', "'", "é", "ſecret", "toKen",
         "a1b2c3d4", "0123456789abcdef", "ABCDEF12", "-", "/", "x", "\n", "toktoken", "\U0001F511", "ghp_", "xoxb-", "eyJ", ".",
         "-----BEGIN ", "RSA ", "PRIVATE KEY-----"]


def test_spans_equal_regular_expressions():
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(60))) for _ in range(4000)]
    for text, got in zip(texts, spans(texts)):
        assert got == brute(text), text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=20).map("".join), max_size=4))
def test_spans_of_generated_texts(texts):
    assert spans(texts) == [brute(t) for t in texts] if texts else True


def test_a_dropped_match_uses_up_its_text():
    assert spans(["token=secret: abcdefgh1"]) == [[]]  # the first match takes the word secret and is too short
    assert spans(["token==abcdefg"]) == [[("assign", 0, 14)]]


def test_long_texts_and_window_borders(monkeypatch):
    run = "0123456789abcdef" * 5000
    text = "é " + run + " password=" + "q" * 70_000 + " AKIA" + "Z" * 3000
    assert spans([text, "", run]) == [brute(text), [], brute(run)]
    monkeypatch.setattr(automaton, "WINDOW", 1000)
    assert spans([text, "", run]) == [brute(text), [], brute(run)]


@pytest.mark.parametrize("pattern", ["a(b|cd)*e?", "[^a-c]{2,3}x", r"(?i)ab+\x20c", "(ab|a)(bc|c){2}", "a{3}|b{2,}"])
def test_automaton_equals_a_search(pattern):
    rng = random.Random(len(pattern))
    regex = re.compile(pattern)
    machine = automaton.build([pattern], backwards=True, anywhere=True)
    forward = automaton.build([pattern]).rows()
    for _ in range(200):
        text = "".join(rng.choice("aAbBcCde x") for _ in range(rng.randrange(600)))
        codes = machine.codes[np.frombuffer(text.encode(), np.uint8)]
        got = sorted(int(p) for at, _ in automaton.scan(machine, codes, True) for p in at)
        want = [i for i in range(len(text)) if any(regex.fullmatch(text, i, j) for j in range(i + 1, min(len(text), i + 40) + 1))]
        assert [g for g in got if g < len(text) - 40] == [w for w in want if w < len(text) - 40]
    assert len(forward) <= 20


def test_minimal_automaton():
    assert len(automaton.build(["abc|xbc"]).table) == 5  # start, shared bc, end, dead
    with pytest.raises(ValueError):
        automaton.build(["(a"])
    with pytest.raises(ValueError):
        automaton.build(["é"])


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "password=12345678", "y"), (None, "password=12345678", "y"),
            (3, "ü AKIA" + "A1" * 8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((r.doc_id or 0, [tuple(s) for s in r.spans]) for r in scan_secrets(df).collect())
    assert got == [(0, [("assign", 0, 17)])] * 2 + [(1, []), (2, []), (3, [("access", 2, 22)])]
    assert scan_secrets(df.limit(0)).count() == 0
    own = scan_secrets(df, [Rule("word", "", "[a-z]+", 4)]).where("doc_id IS NULL").first()
    assert [tuple(s) for s in own.spans] == [("word", 0, 8)]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op11_secret_scan(spark, sf).collect()
    assert len(rows) == len(texts)
    base = {r.kind for r in BASE}
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        mine = ",".join(f"{k}:{s}:{e}" for k, s, e in want if k in base)
        assert r.base_sha256 == hashlib.sha256(mine.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == b for k, _, _ in want) for b in ("assign", "access", "hex"))
    assert sum(r.n_assign + r.n_access + r.n_hex for r in rows) > 0
    assert [r.kind for r in RULES] == list(PLAIN)

"""Queries whose whole result SQL can express, beside that SQL in DuckDB; base columns beside plain patterns."""

import hashlib
import re
import sys
from pathlib import Path

import pytest

from mairie.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import compare, connect, run_oracle  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_multi_index_near_dedup", "op3_repeated_spans", "op9_line_quality", "op10_minhash_near_dedup"])
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, SF).toArrow(), run_oracle(connect(SF), ORACLES[name])) is None


def digest(found, kinds):
    found = sorted(found, key=lambda s: (s[1], kinds.index(s[0])))
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()


def test_base_digest_of_secrets(spark):
    forms = {
        "assign": (re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), lambda m: len(m[1]) >= 6),
        "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    }
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op8_char_cnn_secrets"](spark, SF).collect():
        found = [(k, *m.span()) for k, (form, holds) in forms.items() for m in form.finditer(texts[r.doc_id]) if holds(m)]
        assert r.base_sha256 == digest(found, list(forms))


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(digits)) % 10 == 0


def test_base_digest_of_personal_data(spark):
    count = lambda m: sum(c in "0123456789" for c in m[0])
    forms = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= count(m) <= 19 and luhn(m[0])),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= count(m) <= 15),
    }
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in QUERIES["op5_semi_markov_pii"](spark, SF).collect():
        found = [(k, *m.span()) for k, (form, holds) in forms.items() for m in re.finditer(form, texts[r.doc_id]) if holds(m)]
        assert r.base_sha256 == digest(found, list(forms))

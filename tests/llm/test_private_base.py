"""Base spans of personal data against the contract's own patterns, and on texts made to be slow."""

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mairie.llm import pii


def by_contract(text):
    found = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        doubled = [d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            found.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], ("email", "ip", "card", "phone").index(s[2])))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("a@.-_+ 0125()é\n")), max_size=60))
def test_base_spans_follow_the_patterns(text):
    assert pii.base_spans(text) == by_contract(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["1", "25", "255", "256", "007", ".", "..", " ", "4111111111111111", "4111-1111 11111111", "+44 20 7946 0958", "a@b", "a@b.c_d@e.f", "-"]), max_size=14))
def test_base_spans_of_pieces(parts):
    assert pii.base_spans("".join(parts)) == by_contract("".join(parts))


def test_zeros_in_an_address_part():
    text = f"{'0' * 5000}1.2.3.4 {'0' * 5000}999.2.3.4 1.2.3.{'9' * 5000}"
    assert [s for s in pii.base_spans(text) if s[2] == "ip"] == [(0, 5007, "ip")]


@pytest.mark.parametrize("text", ["7" * 10**6, "a" * 10**6 + " @", "a@" * 300_000, "1." * 500_000, "+1" * 300_000, "1 " * 300_000], ids=lambda t: t[:3])
def test_long_runs_take_linear_time(text):
    start = time.time()
    pii.base_spans(text)
    assert time.time() - start < 10


def test_regions_hold_whole_tokens():
    name = "maximiliane.schwarzenberger-oberhauser"
    text = f"write to {name} (at) example.org " + "z" * 5_000 + " or 12345678"
    spans = [text[a:b] for a, b in pii.regions(text)]
    assert len(spans) == 1 and f"{name} (at) example.org" in spans[0] and spans[0].endswith("z" * 5_000 + " or 12345678")
    assert pii.regions("no core at all (at home)") == [] and pii.regions("@") == [(0, 1)] and pii.regions("") == []


def test_field_finds_written_out_addresses():
    made = []
    for k in range(60):
        address = f"word{'abcdef'[k % 6]}.{k}@mail{k % 9}.example.com"
        text = f"some plain words before {address} and others after, in 20{k}"
        made.append((text, [(24, 24 + len(address), "email")]))
    weights = pii.train(made + [x for text, s in made for x in pii.rewritten(text, s)])
    for value in ("joe (at) example.org", "maximiliane.schwarzenberger-oberhauser (at) example.org"):
        text = f"please send it to {value} for more"
        assert [text[a:b] for a, b, _ in pii.all_spans(text, weights, [])] == [value]
    for plain in ("we met (at) noon in paris", "the price (at) least two.", "call me in 2011 or 2012"):
        assert pii.all_spans(plain, weights, []) == []


def test_cores_without_any_candidate():
    weights = pii.train([("a 12345678 b", [(2, 10, "phone")])])
    for text in ("@", " @ ", "(at)", "@@@@ ", "@" * 3_000 + "x" * 20_000):
        assert pii.all_spans(text, weights, pii.base_spans(text)) == []


def test_tables_of_numbers_end():
    text = "12 345 6789 01 " * 4_000
    start = time.process_time()
    pii.all_spans(text, pii.train([("a 12345678 b", [(2, 10, "phone")])]), pii.base_spans(text))
    assert time.process_time() - start < 60

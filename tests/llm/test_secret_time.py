"""The rules' own automata: equal to a backtracking engine, and linear on texts made to make them walk in vain."""

import random
import re
import time

import pytest

from aerolith.llm import automaton, secrets


@pytest.mark.parametrize("rule", secrets.BASE + secrets.EXTRA, ids=lambda r: r.kind)
def test_matches_equal_regular_expressions(rule):
    dfa, plain, r = automaton.compile_rules([rule.pattern], False), re.compile(rule.pattern.encode()), random.Random(rule.kind)
    bits = [b"eyJ", b"a.", b"Zz9", b"token", b"api_key=", b": ", b"'x", b"AKIA", b"0f", b"ghp_", b"xoxb-", b"AIza", b"-----BEGIN ", b"RSA ", b"PRIVATE KEY-----", b"http://", b"u:p", b"@", b"h", b".", b"-", b"redis://"]
    for _ in range(400):
        text = b"".join(r.choice(bits) for _ in range(r.randrange(0, 30)))
        assert [(a, b) for a, b, _ in automaton.longest_matches(dfa, text)] == [m.span() for m in plain.finditer(text)]


@pytest.mark.parametrize("unit", [b"eyJ", b"eyJa.", b"http://a", b"AKIA", b"token", b"-----BEGIN A"])
def test_time_is_linear(unit):
    began = time.process_time()
    for rule in secrets.BASE + secrets.EXTRA:
        automaton.longest_matches(automaton.compile_rules([rule.pattern], False), unit * (300_000 // len(unit)))
    assert time.process_time() - began < 20

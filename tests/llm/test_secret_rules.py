"""Each rule for public formats of credentials against re.finditer, and redaction of a URL's."""

import random
import re

import pytest

from aerolith.llm import secrets

PIECES = {
    "github": ["ghp_", "gho_", "ghx_", "a" * 36, "Z9" * 20, "b" * 35],
    "slack": ["xoxb-", "xoxa-", "xoxq-", "1234567890", "12-34-", "abc"],
    "google": ["AIza", "b" * 35, "_-" * 20, "c" * 34],
    "jwt": ["eyJ", "abc", ".", "d-_", "eyJhbGci.eyJzdWIi.c2ln"],
    "pem": ["-----BEGIN ", "RSA ", "PRIVATE KEY", "-----", "-----BEGIN PRIVATE KEY-----"],
    "url": ["postgres://", "http", "https://", "ftp://", "user", ":", "p+a=ss", "é", "@", "host/", "amqp://u:p@h", "/", "redis://a:b:c@"],
}
ALL = ["".join(x) for x in PIECES.values()] + [" ", "\n", "\t", "@", "x", "日本", "token=abcdef1"]


@pytest.mark.parametrize("rule", secrets.EXTRA, ids=lambda r: r.kind)
def test_rule_equals_finditer(spark, rule):
    r, pattern = random.Random(rule.kind), re.compile(rule.pattern)
    bits = PIECES[rule.kind] * 3 + ALL
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(1, 25))) for _ in range(400)]
    run = {"github": r"[A-Za-z0-9]+$", "slack": r"[A-Za-z0-9-]+$", "google": r"[A-Za-z0-9_-]+$"}.get(rule.kind)

    def kept(m):
        return run is None or len(re.search(run, m[0][len({"github": "ghp_", "slack": "xoxb-", "google": "AIza"}[rule.kind]) :])[0]) >= rule.min_tail

    want = {i: [f"{rule.kind}:{m.start()}:{m.end()}" for m in pattern.finditer(t) if kept(m)] for i, t in enumerate(texts)}
    assert sum(map(len, want.values())) > 50
    rows = secrets.find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {x.doc_id: [s for s in x.spans.split(",") if s.startswith(f"{rule.kind}:")] for x in rows} == want


def test_credentials_of_a_url_are_redacted(spark):
    rows = spark.createDataFrame([(1, "see postgres://user:pa+ss@host/db and http://host/a@b")], "doc_id long, text string")
    assert secrets.redact(rows).first().text == "see [SECRET]host/db and http://host/a@b"

"""Cues, check numbers and secrets of the personal data operator."""

import pytest

from stratum.llm import pii


def found(text):
    return [(k, text[a:b]) for k, a, b in pii.spans(text)]


@pytest.mark.parametrize(("text", "want"), [
    ("IBAN GB82 WEST 1234 5698 7654 32 and more", [("account", "GB82 WEST 1234 5698 7654 32")]),
    ("iBAN: GB82WEST12345698765432.", [("account", "GB82WEST12345698765432")]),
    ("IBAN DE89370400440532013000 x1", [("account", "DE89370400440532013000")]),
    ("iban GB00 WEST 1234 5698 7654 32", []), ("iban GB82 WEST 1234 5698 7654 33", []), ("IBAN GB82", []),
    ("see HttP://x.y, then", [("url", "HttP://x.y")]), ("MAILTO:me now", [("url", "MAILTO:me")]),
    ("SSN 123-45-6789.", [("account", "123-45-6789")]), ("ssn: 123 45 6789", [("account", "123 45 6789")]), ("ssn 123-45-67890", []),
    ("Passport No: X1234567", [("account", "X1234567")]), ("account number 12-3456-78", [("account", "12-3456-78")]), ("account of 12345678", []),
    ('token = "24be64439e3e49cf"', [("secret", "24be64439e3e49cf")]), ("API_KEY: sk-12ab34CD", [("secret", "sk-12ab34CD")]), ("password=hunter2x!", [("secret", "hunter2x")]),
    ("password: none given", []), ("tokens and secrets 12345678a", []), ("secret = short1", []),
    ("İİ Token='a1b2c3d4e5'", [("secret", "a1b2c3d4e5")]), ("", []), ("no anchors at all", [])])
def test_cues(text, want):
    assert [f for f in found(text) if f[0] in ("url", "account", "secret")] == want


def test_redaction_names_the_kind():
    t = 'x token = "24be64439e3e49cf" and IBAN GB82 WEST 1234 5698 7654 32.'
    assert pii.redact(t, pii.spans(t)) == 'x token = "[SECRET]" and IBAN [ACCOUNT].'


def test_columns(spark):
    df = spark.createDataFrame([(1, "token: abc12345678"), (2, "http://a.b only"), (3, None), (4, "")], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find_pii(df).collect()}
    assert (rows[1].n_secret, rows[1].private) == (1, True) and (rows[2].n_url, rows[2].private) == (1, False)
    assert not rows[3].private and rows[3].spans == rows[4].spans == ""

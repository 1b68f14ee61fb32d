r"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, plus
signs, digits, URL schemes and identifier cues.  A deterministic local parser
expands each anchor to its boundaries and validates it.  Base kinds, leftmost
and non-overlapping in each kind:

* ``email`` ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``
* ``ip`` four dotted numbers of at most 255
* ``card`` 14 to 19 digits with single blanks or hyphens between, Luhn-valid
* ``phone`` ``\+[0-9][\x20().0-9-]+[0-9]`` with 10 to 15 digits

The method adds, after cues and schemes in any case (ASCII letters are folded):

* ``url`` scheme and address up to white space or a quote, without closing
  punctuation; at least one character after the scheme
* ``account`` after ``iban``: two letters, two digits and 11 to 30 more letters and
  digits, in groups with single blanks between, whose check number (modulo 97)
  is right, the longest such; after ``ssn``: three, two and four digits with
  hyphens or blanks; after other account cues: 8 to 34 ASCII letters, digits and single
  hyphens, at least 4 digits.  Blanks, ``:``, ``#``, ``=`` stand before.
* ``secret`` after a cue such as ``token`` or ``password``, then ``:`` or ``=``, blanks
  and quotes around them allowed: 8 characters or more of ``[A-Za-z0-9_+/=.~-]``,
  a letter and a digit among them

Spans are in code points, end exclusive.  Defined cases: null or empty text has
none; repeated rows and null or repeated ``doc_id`` give a row each; other
columns are ignored; an empty table gives an empty result.  Texts are read
whole in time linear in their length.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm import text as T

KINDS = ("email", "ip", "card", "phone", "url", "account", "secret")
BASE = KINDS[:4]
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("iban", "ssn", "social security number", "acct", "account", "account no", "account number", "acct no", "customer no", "customer number", "passport", "passport no",
        "passport number", "tax id", "routing number", "sort code")
SECRETS = ("token", "secret", "password", "passwd", "pwd", "api key", "api_key", "api-key", "apikey", "access key", "access_key", "secret key", "secret_key", "private_key",
           "auth_token", "access_token", "client_secret")

_DIGITS = frozenset("0123456789")
_LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
_LOCAL = _LABEL | frozenset("._%+")
_PHONE = _DIGITS | frozenset(" ().-")
_ALNUM = _LABEL - {"-"}
_URL_END = re.compile(r"[\s\"'<>`]")
_NO_ANCHOR = re.compile(r"[@+0-9]|://|mailto:", re.IGNORECASE)        # accounts and secrets have digits
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}")
_SSN = re.compile(r"[0-9]{3}([- ])[0-9]{2}\1[0-9]{4}(?![0-9])")
_SECRET = re.compile(r"""["']?[ \t]*[:=][ \t]*["']?([A-Za-z0-9_+/=.~-]{8,})""")


@lru_cache(1)
def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for s in SCHEMES:
        a.add_word(s, ("url", len(s), s))
    for s in CUES:
        a.add_word(s, ("account", len(s), s))
    for s in SECRETS:
        a.add_word(s, ("secret", len(s), s))
    a.add_word("@", ("email", 1, ""))
    a.add_word("+", ("phone", 1, ""))
    for d in sorted(_DIGITS):
        a.add_word(d, ("digit", 1, ""))
    a.make_automaton()
    return a


def _while(text: str, at: int, allowed: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email_at(text: str, at: int, floor: int):
    """Span around the at-sign at ``at``, starting at ``floor`` or later."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _while(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in _LABEL:
        end = _while(text, end + 1, _LABEL)
        labels += 1
    return (start, end) if labels else None


def chain_of_parts(text: str, start: int) -> list[tuple[int, int]]:
    """Digit runs joined by single dots, from ``start``."""
    parts = []
    while True:
        end = _while(text, start, _DIGITS)
        parts.append((start, end))
        if end + 1 >= len(text) or text[end] != "." or text[end + 1] not in _DIGITS:
            return parts
        start = end + 1


def byte_value(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 4 and (not digits or int(digits) <= 255)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def card_run(text: str, start: int) -> tuple[int, str]:
    """End and digits of the run of digits with single separators."""
    digits, at, n = [], start, len(text)
    while True:
        end = _while(text, at, _DIGITS)
        digits.append(text[at:end])
        if end + 1 < n and text[end] in " -" and text[end + 1] in _DIGITS:
            at = end + 1
        else:
            return end, "".join(digits)


def phone_at(text: str, at: int):
    """(end, digits) from the plus sign at ``at``, or None."""
    if at + 1 >= len(text) or text[at + 1] not in _DIGITS:
        return None
    end = _while(text, at + 2, _PHONE)
    while end > at + 2 and text[end - 1] not in _DIGITS:
        end -= 1
    if end < at + 4:
        return None
    return end, sum(c in _DIGITS for c in text[at:end])


def url_at(text: str, start: int, after: int):
    found = _URL_END.search(text, after)
    end = found.start() if found else len(text)
    while end > after and text[end - 1] in ".,;:!?)]}":
        end -= 1
    return (start, end) if end > after else None


def iban_at(text: str, at: int):
    """The longest account number from ``at`` whose check number is right."""
    found = _IBAN.match(text, at)
    if not found:
        return None
    end = found.end()
    while end > at:
        own = text[at:end].replace(" ", "")
        if len(own) < 15:
            return None
        whole = end == len(text) or text[end] not in _ALNUM
        if whole and text[end - 1] != " " and int("".join(str(int(c, 36)) for c in own[4:] + own[:4])) % 97 == 1:
            return at, end
        end -= 1
    return None


def account_at(text: str, after: int, cue: str):
    at = _while(text, after, frozenset(" :#="))
    if at == after:
        return None
    if cue == "iban":
        return iban_at(text, at)
    if cue in ("ssn", "social security number"):
        found = _SSN.match(text, at)
        return found and found.span()
    end = _while(text, at, _LABEL)
    while end > at and text[end - 1] == "-":
        end -= 1
    inside = text[at:end]
    if 8 <= len(inside) <= 34 and "--" not in inside and inside[:1] != "-" and sum(c in _DIGITS for c in inside) >= 4:
        return at, end
    return None


def secret_at(text: str, after: int):
    found = _SECRET.match(text, after)
    if not found or not re.search("[A-Za-z]", found[1]) or not re.search("[0-9]", found[1]):
        return None
    return found.span(1)


def folded(text: str) -> str:
    """ASCII letters in lower case, every character in its place."""
    return text.lower() if text.isascii() else text.translate(_ASCII_LOWER)


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans as (kind, start, end), by start, then kind as listed."""
    if not _NO_ANCHOR.search(text):
        return []
    out = []
    floor = dict.fromkeys((*KINDS, "parts"), 0)   # nothing before is free in this kind

    def keep(kind, span):
        if span and span[0] >= floor[kind]:
            out.append((kind, *span))
            floor[kind] = span[1]

    for last, (kind, size, cue) in automaton().iter(folded(text)):
        at = last - size + 1
        if kind == "digit":
            if at >= floor["parts"]:
                parts = chain_of_parts(text, at)
                floor["parts"] = parts[-1][1]
                for i in range(0, len(parts) - 3, 4):
                    if all(byte_value(text[a:b]) for a, b in parts[i:i + 4]):
                        out.append(("ip", parts[i][0], parts[i + 3][1]))
            if at >= floor["card"]:
                floor["card"], digits = card_run(text, at)
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", at, floor["card"]))
        elif kind == "phone":
            found = phone_at(text, at) if at >= floor["phone"] else None
            if found:
                floor["phone"] = found[0]
                if 10 <= found[1] <= 15:
                    out.append(("phone", at, found[0]))
        elif kind == "email":
            keep("email", email_at(text, at, floor["email"]))
        elif kind == "url":
            keep("url", url_at(text, at, last + 1))
        elif kind == "secret":
            keep("secret", secret_at(text, last + 1))
        else:
            keep("account", account_at(text, last + 1, cue))
    out.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return out


def joined(found) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def redact(text: str, found) -> str:
    """``text`` with spans replaced by their kind in brackets; overlapping
    spans become one, named for the first."""
    out, at = [], 0
    for kind, a, b in found:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every
    row of ``docs``, then ``n_url, n_account, n_secret`` and ``private``: whether
    there is any span but addresses of pages."""
    T.prepare(docs.sparkSession)
    added = KINDS[len(BASE):]

    def find(batches):
        for batch in batches:
            for part in T.split_batch(batch, "text"):
                found = [spans(t or "") for t in part.column("text").to_pylist()]
                count = lambda k: pa.array([sum(s[0] == k for s in f) for f in found], pa.int64())
                sha = [hashlib.sha256(joined(s for s in f if s[0] in BASE).encode()).hexdigest() for f in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(count, BASE), pa.array(sha, pa.string()), pa.array(map(joined, found), pa.string()), *map(count, added),
                     pa.array([any(s[0] != "url" for s in f) for f in found], pa.bool_())],
                    ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", *(f"n_{k}" for k in added), "private"])

    return docs.select("doc_id", "text").mapInArrow(
        find, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_url long, n_account long, n_secret long, private boolean")


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced; ``n_chars``, where there
    is one, counts the new text.  Null stays null; other columns stay."""
    T.prepare(docs.sparkSession)

    def clean(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in T.split_batch(batch, "text"):
                texts = [t and redact(t, spans(t)) for t in part.column("text").to_pylist()]
                yield part.set_column(at, "text", pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(clean, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out

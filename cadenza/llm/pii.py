"""Personal data by weak supervision.

One pass over the texts finds candidate spans and lets five labelers vote on
each (for, against, or no opinion): strict shape, validity (checksums, ranges),
gazetteers (top-level domains, first names, dial codes, card prefixes), words
before the span, and its borders.  Votes and a few buckets of shape make one
small whole number per candidate, the *code*.

Codes are counted over all documents.  There are at most ``MAX_CODES`` of them
whatever the corpus, so the counts may go to the driver: expectation-
maximisation over them estimates each labeler's reliability and each
candidate's probability, and a logistic regression, weighted by the counts, is
trained on those probabilities.  Its verdict is again a function of the code,
so the last step reads the candidates and not the texts.

Base spans (email, ip, card, phone that pass their checks) always stay; the
classifier decides on the further kinds.

All scans are linear in the text's length.  Rows keep their own candidates, so
nothing is grouped by a hot key but the counts, which are summed map-side.

Defined results: a null text counts as empty; equal rows are treated alike;
offsets are code points, the end exclusive; secrets and names have no longest
length; a further span that overlaps a base span is left out; only id and text
are read, so other columns' names cannot clash; an empty table gives an empty one;
very long texts are searched whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored

BASE = ("email", "ip", "card", "phone")
KINDS = BASE + ("secret", "iban", "ssn", "person")
LABELERS = ("shape", "validity", "gazetteer", "context", "border")
#: 3 bits of kind, 2 of each vote, 2 of length, 2 of digits.
MAX_CODES = 1 << 17

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9]\.[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HEX = re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])")
_ASSIGNED = re.compile(r"(?i:token|secret|api[_-]?key|password|passwd|pwd)[ \t]{0,3}[=:][ \t]{0,3}[\"']?([^\s\"']{8,}+)")
_IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Señor Señora".split()
FIRST_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica "
    "Thomas Sarah Charles Karen Peter Hans Klaus Wolfgang Jürgen Petra Sabine Monika Ursula Claudia Jean Pierre Michel "
    "Marie Nathalie Isabelle Sophie Camille José Antonio Manuel Francisco Carmen María Ana Laura Isabel Carlos Miguel"
).split()
DOMAINS = frozenset("com org net edu gov info io de fr es uk eu it nl pl ch at be se us ca au jp cn in br mx".split())
DIAL_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "90", "91")
HINTS = {
    "email": ("mail", "contact", "write", "schreib", "courriel", "correo"),
    "ip": ("ip", "host", "server", "address", "login", "adresse"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "anruf"),
    "secret": ("token", "secret", "key", "password", "passwd", "pwd"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "person": tuple(t.lower() for t in TITLES) + ("name", "dear", "signed"),
}
AGAINST = ("version", "isbn", "order", "page", "section", "chapter", "release", "commit", "sha1", "md5", "checksum")
_PERSON = re.compile(
    r"(?<![A-Za-z])(?:(?:" + "|".join(TITLES) + r")\.? [A-ZÀ-Þ][a-zß-ÿ]++(?: [A-ZÀ-Þ][a-zß-ÿ]++)?"
    r"|(?:" + "|".join(FIRST_NAMES) + r") [A-ZÀ-Þ][a-zß-ÿ]++)"
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping: for each ``@`` the whole run of local
    characters before it (from the last match's end on) and the domain after."""
    last, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                last = domain.end()
                yield start, last
        at = text.find("@", max(at + 1, last))


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, passes its checks) of the base patterns' matches."""
    for a, b in _emails(text):
        yield "email", a, b, True
    if not _DIGIT.search(text):
        return
    if _DOTTED.search(text):
        for m in _IP.finditer(text):
            yield "ip", *m.span(), all(map(_octet, m.group().split(".")))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:  # under 12 digits otherwise
            n = m.end() - m.start() - m.group().count(" ") - m.group().count("-")
            if 12 <= n <= 19:
                yield "card", *m.span(), luhn(m.group().replace(" ", "").replace("-", ""))
    if "+" in text:
        for m in _PHONE.finditer(text):
            n = sum("0" <= c <= "9" for c in m.group())
            yield "phone", *m.span(), 9 <= n <= 15


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """The base spans by start, then kind as listed."""
    found = [(k, a, b) for k, a, b, ok in matches(text or "") if ok]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _further(text: str) -> Iterator[tuple[str, int, int]]:
    if _DIGIT.search(text):
        for m in _HEX.finditer(text):
            yield "secret", *m.span()
        for m in _IBAN.finditer(text):
            yield "iban", *m.span()
        for m in _SSN.finditer(text):
            yield "ssn", *m.span()
    for m in _ASSIGNED.finditer(text):
        yield "secret", *m.span(1)
    for m in _PERSON.finditer(text):
        yield "person", *m.span()


def _iban_valid(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _votes(text: str, kind: str, a: int, b: int, passes: bool) -> tuple[int, ...]:
    """1 for, 2 against, 0 no opinion, in the order of ``LABELERS``."""
    s = text[a:b] if b - a <= 400 or kind == "secret" else text[a : a + 200] + text[b - 200 : b]
    yes = lambda x: 1 if x else 2
    digits = "".join(c for c in s if "0" <= c <= "9")
    if kind == "email":
        top = s.rsplit(".", 1)[-1].lower()
        own = yes(2 <= len(top) <= 10 and top.isalpha()), yes(not s.startswith(".") and ".." not in s), 1 if top in DOMAINS else 0
    elif kind == "ip":
        own = yes(len(s) <= 15), yes(passes), 2 if s.startswith(("0.", "127.", "255.")) else 0
    elif kind == "card":
        own = yes(len(digits) in (15, 16)), yes(passes), 1 if s[0] in "3456" else 0
    elif kind == "phone":
        own = yes(10 <= len(digits) <= 14), yes(passes), yes(digits.startswith(DIAL_CODES))
    elif kind == "secret":
        mixed = bool(digits) and any(c.isalpha() for c in s)
        own = yes(len(s) in (32, 40, 64) and all(c in "0123456789abcdefABCDEF" for c in s)), yes(mixed and len(set(s)) >= 8), 0
    elif kind == "iban":
        own = yes(len(s) >= 15), yes(_iban_valid(s)), 1 if s[:2] in ("DE", "FR", "ES", "GB", "IT", "NL", "AT", "CH", "BE", "PL") else 0
    elif kind == "ssn":
        own = 1, yes(s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000"), 0
    else:
        parts = [p.rstrip(".") for p in s.split(" ")]
        own = yes(len(parts) >= 2), 0, 1 if any(p in FIRST_NAMES for p in parts) else (1 if parts[0] in TITLES else 2)
    before = text[max(0, a - 32) : a].lower()
    if kind == "person" and s.split(" ")[0].rstrip(".") in TITLES:
        context = 1
    elif any(h in before for h in HINTS[kind]):
        context = 1
    else:
        context = 2 if any(h in before for h in AGAINST) else 0
    left, right = text[a - 1 : a], text[b : b + 1]
    return (*own, context, yes(not left.isalnum() and not right.isalnum()))


def _code(text: str, kind: str, a: int, b: int, passes: bool) -> int:
    code = KINDS.index(kind)
    for v in _votes(text, kind, a, b, passes):
        code = code << 2 | v
    n = b - a
    seen = text[a : b if kind == "secret" else min(b, a + 400)]
    digits = sum("0" <= c <= "9" for c in seen) / len(seen)
    return (code << 2 | (n > 12) + (n > 20) + (n > 36)) << 2 | min(3, int(digits * 4))


def candidates_of(text: str | None) -> list[tuple[int, int, int, int, bool]]:
    """(kind, start, end, code, base) of a text's candidates, by start and kind."""
    text = text or ""
    found = {(k, a, b): ok for k, a, b, ok in matches(text)}
    taken = sorted((a, b) for (k, a, b), ok in found.items() if ok)
    at, further = 0, set(_further(text)) - set(found)
    for k, a, b in sorted(further, key=lambda s: (s[1], s[2])):
        while at < len(taken) and taken[at][1] <= a and (at + 1 == len(taken) or taken[at + 1][0] <= a):
            at += 1
        if not any(x < b and a < y for x, y in taken[max(0, at - 2) : at + 2]):
            found[(k, a, b)] = False
    out = []
    for (k, a, b), ok in found.items():
        i = KINDS.index(k)
        out.append((i, a, b, _code(text, k, a, b, ok), ok and k in BASE))
    return sorted(out, key=lambda s: (s[1], s[0], s[2]))


_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("code", pa.int32()), ("base", pa.bool_())]))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row: its candidates with their codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "code", "base")
        for b in batches:
            found = [[dict(zip(names, s)) for s in candidates_of(t.as_py())] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, _SPANS)], ["id", "spans"])

    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string"))
    kind = picked.schema["id"].dataType.simpleString()
    return picked.mapInArrow(run, f"id {kind}, spans array<struct<kind:int,start:int,end:int,code:int,base:boolean>>")


def _fields(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind, votes (one column a labeler), shape buckets of codes."""
    n = len(LABELERS)
    votes = np.stack([codes >> 4 + 2 * (n - 1 - j) & 3 for j in range(n)], axis=1)
    return codes >> 4 + 2 * n, votes, np.stack([codes >> 2 & 3, codes & 3], axis=1)


def reliabilities(codes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over counted vote patterns: P(vote | class) for
    each labeler (labeler, class, vote), and each code's probability of being
    personal data.  Votes are taken as independent given the class; the prior
    is per kind; all are smoothed by one observation."""
    kind, votes, _ = _fields(codes)
    n = len(LABELERS)
    p = np.clip(0.5 + 0.2 * ((votes == 1).sum(axis=1) - (votes == 2).sum(axis=1)), 0.05, 0.95)
    table = np.zeros((n, 2, 3))
    for _ in range(rounds):
        for c, w in enumerate(((1 - p) * counts, p * counts)):
            for j in range(n):
                table[j, c] = np.bincount(votes[:, j], w, 3)[:3] + 1.0
                table[j, c] /= table[j, c].sum()
        prior = (np.bincount(kind, p * counts, len(KINDS)) + 1.0) / (np.bincount(kind, counts, len(KINDS)) + 2.0)
        odds = np.log(prior[kind]) - np.log1p(-prior[kind])
        for j in range(n):
            odds += np.log(table[j, 1, votes[:, j]]) - np.log(table[j, 0, votes[:, j]])
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    # the class that more votes are for is the positive one
    if np.sum(counts * p * ((votes == 1).sum(axis=1) - (votes == 2).sum(axis=1))) < np.sum(counts * (1 - p) * ((votes == 1).sum(axis=1) - (votes == 2).sum(axis=1))):
        p, table = 1 - p, table[:, ::-1]
    return table, p


def features(codes: np.ndarray) -> np.ndarray:
    """One-hot kind, votes and shape buckets, and a constant."""
    kind, votes, shape = _fields(codes)
    parts = [kind[:, None] == np.arange(len(KINDS))]
    parts += [votes[:, [j]] == np.arange(3) for j in range(votes.shape[1])]
    parts += [shape[:, [j]] == np.arange(4) for j in range(2)]
    return np.concatenate([*parts, np.ones((len(codes), 1), bool)], axis=1).astype(np.float64)


def train(codes: np.ndarray, counts: np.ndarray, p: np.ndarray, rounds: int = 25, l2: float = 1.0) -> np.ndarray:
    """Weights of the span classifier: logistic regression on the probabilities
    ``p``, each code weighted by its count (Newton steps)."""
    x = features(codes)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts * (q - p)) + l2 * w
        hessian = (x.T * (counts * np.maximum(q * (1 - q), 1e-6))) @ x + l2 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def accepted(found: DataFrame) -> dict[int, bool]:
    """The classifier's verdict on each code among the candidates."""
    rows = found.select(F.explode("spans.code").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")).orderBy("code").collect()
    if not rows:
        return {}
    assert len(rows) <= MAX_CODES
    codes, counts = np.array([r["code"] for r in rows]), np.array([r["n"] for r in rows], np.float64)
    _, p = reliabilities(codes, counts)
    good = features(codes) @ train(codes, counts, p) > 0
    return dict(zip(codes.tolist(), good.tolist()))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row: its base spans and the further ones that the
    classifier takes, as (kind, start, end, base) by start, then kind."""
    found = stored(candidates(docs, id_col, text_col), "candidates")
    verdict = accepted(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = [
                [{"kind": KINDS[s["kind"]], "start": s["start"], "end": s["end"], "base": s["base"]} for s in row if s["base"] or s["kind"] >= len(BASE) and verdict[s["code"]]]
                for row in b.column(1).to_pylist()
            ]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, kind)], ["id", "spans"])

    kind = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:int,end:int,base:boolean>>")


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def base_digest(text: str | None) -> str:
    return hashlib.sha256(listed(base_spans(text)).encode()).hexdigest()

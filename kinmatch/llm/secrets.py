"""Secret scanning: Aho-Corasick keyword prefilter, anchored patterns at hits, checksum validation."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame

from . import common

# Keywords and shapes of the scanned kinds.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(rb"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
GITHUB_WORDS = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
NPM_WORDS = ("npm_",)
CHECKED = re.compile(rb"[A-Za-z0-9]{36}(?![A-Za-z0-9])")
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Order of kinds at one start.
KINDS = ("assign", "access", "hex", "github", "npm", "card")


def crc_token(body: bytes) -> bool:
    """Six base-62 digits at the end state the CRC-32 of what stands before."""
    n = 0
    for c in body[-6:]:
        n = n * 62 + BASE62.index(c)
    return n == zlib.crc32(body[:-6])


def luhn(digits: bytes) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = (c - 48) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in (("assign", ASSIGN_WORDS), ("access", ("akia",)), ("github", GITHUB_WORDS), ("npm", NPM_WORDS)):
        for w in words:
            found.add_word(w, (kind, len(w)))
    found.make_automaton()
    return found


def scan(raw: bytes, automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes, by start and then by kind.

    Keywords are found in one pass over the lower-cased bytes; the pattern of a keyword's kind is tried at the
    hit alone. Runs of hexadecimal digits have no keyword: their pattern is searched as it is.
    """
    spans: list[tuple[str, int, int]] = []
    free = {"assign": 0, "access": 0, "github": 0, "npm": 0}
    hits = sorted((end - n + 1, kind, n) for end, (kind, n) in automaton.iter(raw.lower().decode("latin-1")))
    for start, kind, n in hits:
        if start < free[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(raw, start):
                free[kind] = m.end()
                if m.end(1) - m.start(1) >= 12:
                    spans.append((kind, start, m.end()))
        elif kind == "access":
            if m := ACCESS.match(raw, start):
                free[kind] = m.end()
                if m.end() - start >= 18:
                    spans.append((kind, start, m.end()))
        elif raw[start : start + n].islower() and (m := CHECKED.match(raw, start + n)) and crc_token(m[0]):
            free[kind] = m.end()
            spans.append((kind, start, m.end()))
    for m in HEX.finditer(raw):
        spans.append(("hex", m.start(), m.end()))
        if m.end() - m.start() <= 19 and m[0].isdigit() and luhn(m[0]):
            spans.append(("card", m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def code_points(raw: bytes, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Byte offsets as code points."""
    if not spans or raw.isascii():
        return spans
    at = {}
    last = count = 0
    for p in sorted({p for _, a, z in spans for p in (a, z)}):
        count += len(raw[last:p].decode("utf-8"))
        last = p
        at[p] = count
    return [(k, at[a], at[z]) for k, a, z in spans]


def find_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every text: (doc_id, kinds, starts, ends), arrays in step, code points, ends exclusive.

    Base kinds are assign, access and hex; github, npm (CRC-32) and card (Luhn, 16 to 19 digits) are added where
    their checksum holds. A null or empty text has no span; repeated rows are scanned again; an empty table
    gives no rows; extra columns are ignored.
    """

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        automaton = _automaton()
        for b in batches:
            found = [code_points(r := (t or "").encode(), scan(r, automaton)) for t in b["text"].to_pylist()]
            yield {"doc_id": b["doc_id"], "kinds": [[s[0] for s in x] for x in found], "starts": [[s[1] for s in x] for x in found], "ends": [[s[2] for s in x] for x in found]}

    return common.map_batches(common.only(docs, "doc_id", "text"), run, "doc_id long, kinds array<string>, starts array<long>, ends array<long>")


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in spans).encode()).hexdigest()

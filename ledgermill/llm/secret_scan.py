"""Secrets in texts: base patterns, and candidates that are confirmed by their structure.

Base kinds are patterns alone. The structural kinds decode base64 or hex candidates and report one
only if what comes out is built like a key or a signed token: DER whose nested lengths add up and
whose first fields are those of a private key, an OpenSSH key block whose length-prefixed strings
fill it, or a token whose header and claims decode to JSON objects with an algorithm.

Spans are code points, end exclusive, written as kind:start:end.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgermill.llm.common import id_and_text, ship_package, slices

# The base patterns, their least lengths, and the order of kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "der_key", "ssh_key", "signed_token")

# A run of hex digits shorter than the least length fails as a whole, so it need not be visited.
_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST["hex"])
_LONG_ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (LEAST["access"] - 4))
# Candidates of the structural kinds begin wherever the digits of a DER sequence or of the OpenSSH
# block do, also inside a longer run of digits.
_HEAD = re.compile(r"M(?=[A-P][A-Za-z0-9+/]{22})|b3BlbnNzaC1rZXkt(?=[A-Za-z0-9+/]{8})")
_HEX_HEAD = re.compile(r"30(?=[0-9a-fA-F]{46})|6[fF]70656[eE]7373682[dD]6[bB]65792[dD](?=[0-9a-fA-F]{22})")
_DIGITS, _HEX_DIGITS = re.compile(r"[A-Za-z0-9+/]+"), re.compile(r"[0-9a-fA-F]+")
# Line breaks, escaped ones too, and the indentation of the next line belong to a block.
_BREAK = re.compile(r"(?:[ \t]*(?:\r\n?|\n|(?:\\+r)?\\+n)[ \t]*)+")
_PADDING = re.compile(r"={0,2}")
# A token: its head is the end of a run of digits before a dot.
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{12,}+)(?=\.([A-Za-z0-9_-]{4,}+)\.([A-Za-z0-9_-]*+))")
_OBJECT = re.compile(r"e(?=[w-z0-9_-])")  # the first digits of a brace

SEQUENCE, INTEGER, OCTETS = 0x30, 0x02, 0x04
SSH_MAGIC = b"openssh-key-v1\x00"


def der_item(data: bytes, at: int) -> tuple[int, int, int] | None:
    """Tag, first byte and end of the item at ``at``; None if its length does not fit."""
    if at + 2 > len(data):
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        width = size & 0x7F
        if not 1 <= width <= 4 or at + width > len(data):
            return None
        size, at = int.from_bytes(data[at : at + width], "big"), at + width
    return (tag, at, at + size) if at + size <= len(data) else None


def der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The items that fill ``data[at:end]`` exactly, or None."""
    out = []
    while at < end:
        item = der_item(data, at)
        if item is None or item[2] > end:
            return None
        out.append(item)
        at = item[2]
    return out


def is_der_key(data: bytes) -> bool:
    """A private key: one sequence over all bytes, a small version, then the fields of a known form.

    Known forms: RSA (nine integers), EC (octets, then tagged fields) and the wrapped form
    (algorithm sequence with an object id, then octets).
    """
    outer = der_item(data, 0)
    if outer is None or outer[0] != SEQUENCE or outer[2] != len(data):
        return False
    fields = der_items(data, outer[1], outer[2])
    if not fields or len(fields) < 2 or fields[0][0] != INTEGER or fields[0][2] - fields[0][1] != 1:
        return False
    tags = [tag for tag, _, _ in fields]
    if data[fields[0][1]] > 1:
        return False
    if len(tags) >= 9 and all(tag == INTEGER for tag in tags[:9]):
        return True
    if tags[1] == OCTETS:
        return fields[1][2] - fields[1][1] >= 16
    if len(tags) >= 3 and tags[1] == SEQUENCE and tags[2] == OCTETS:
        algorithm = der_items(data, fields[1][1], fields[1][2])
        return bool(algorithm) and algorithm[0][0] == 0x06
    return False


def is_ssh_key(data: bytes) -> bool:
    """An OpenSSH private key block and nothing behind it."""
    return ssh_end(lambda n: data[:n]) == len(data)


def ssh_end(first: Callable[[int], bytes]) -> int | None:
    """Bytes of an OpenSSH private key block: magic, three strings, a count, then that many keys and a rest.

    ``first(n)`` gives the first n bytes, or all if there are fewer.
    """
    if not first(len(SSH_MAGIC)).startswith(SSH_MAGIC):
        return None
    at = len(SSH_MAGIC)

    def word(at: int) -> int | None:
        data = first(at + 4)
        return int.from_bytes(data[at : at + 4], "big") if len(data) >= at + 4 else None

    def string(at: int) -> int | None:
        size = word(at)
        return None if size is None or len(first(at + 4 + size)) < at + 4 + size else at + 4 + size

    for _ in range(3):
        at = string(at)
        if at is None:
            return None
    count = word(at)
    if count is None or not 1 <= count <= 16:
        return None
    at += 4
    for _ in range(count + 1):
        at = string(at)
        if at is None:
            return None
    return at


def _json_object(part: str) -> dict | None:
    try:
        found = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_signed_token(text: str) -> bool:
    """Header with an algorithm, claims that are an object, and a signature unless it is ``none``."""
    head, claims, signature = text.split(".", 2)
    header = _json_object(head)
    if header is None or not isinstance(header.get("alg"), str) or _json_object(claims) is None:
        return False
    return bool(signature) or header["alg"].lower() == "none"


class _Block:
    """Digits of base64 or hex from a place on, across line breaks; read only as far as asked for."""

    def __init__(self, text: str, start: int, base64_digits: bool) -> None:
        self.text, self.start, self.is_base64 = text, start, base64_digits
        self.runs: list[tuple[int, int]] = []  # places of the runs of digits
        self.size, self.at = 0, start
        self.bytes = b""

    def first(self, n: int) -> bytes:
        """The first n bytes, or as many as there are."""
        if len(self.bytes) < n:
            digits = -(-n * 4 // 3) if self.is_base64 else 2 * n
            self._read(digits)
            packed = "".join(self.text[lo:hi] for lo, hi in self.runs)[:digits]
            if self.is_base64:
                packed = packed[: len(packed) - (len(packed) % 4 == 1)]  # a single digit holds no byte
                self.bytes = base64.b64decode(packed + "=" * (-len(packed) % 4))
            else:
                self.bytes = bytes.fromhex(packed[: len(packed) // 2 * 2])
        return self.bytes[:n]

    def _read(self, digits: int) -> None:
        pattern = _DIGITS if self.is_base64 else _HEX_DIGITS
        while self.size < digits:
            run = pattern.match(self.text, self.at, self.at + digits - self.size)
            if run is None:
                gap = _BREAK.match(self.text, self.at)
                if gap is None or not self.runs:
                    return
                run = pattern.match(self.text, gap.end(), gap.end() + digits - self.size)
                if run is None:
                    return
            if self.runs and self.runs[-1][1] == run.start():
                self.runs[-1] = self.runs[-1][0], run.end()
            else:
                self.runs.append(run.span())
            self.size += run.end() - run.start()
            self.at = run.end()

    def stop(self, n: int) -> int:
        """The place behind the digits of the first n bytes and their padding."""
        left = -(-n * 4 // 3) if self.is_base64 else 2 * n
        for lo, hi in self.runs:
            if left <= hi - lo:
                return _PADDING.match(self.text, lo + left).end() if self.is_base64 else lo + left
            left -= hi - lo
        raise ValueError("fewer digits than asked for")


def _key_span(text: str, start: int, base64_digits: bool) -> tuple[str, int] | None:
    """Kind and end of the key that begins at ``start``; words that follow it may look like its digits.

    The lengths inside the key tell how many digits belong to it.
    """
    block = _Block(text, start, base64_digits)
    head = block.first(12)
    if head[:1] == b"o":
        end = ssh_end(block.first)
        return None if end is None else ("ssh_key", block.stop(end))
    width = head[1] & 0x7F if head[1] & 0x80 else 0
    if head[:1] != b"\x30" or width > 4 or head[1] == 0x80:
        return None
    size = int.from_bytes(head[2 : 2 + width], "big") if width else head[1]
    # The version tells keys from most other bytes before their digits are read.
    if head[2 + width : 4 + width] != b"\x02\x01" or head[4 + width] > 1:
        return None
    end = 2 + width + size
    data = block.first(end)
    return ("der_key", block.stop(end)) if len(data) == end and is_der_key(data) else None


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds, by kind and start."""
    out = [
        ("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]
    ]
    out += [("access", m.start(), m.end()) for m in _LONG_ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]
    return out


def structural_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of candidates whose decoded bytes have the structure of a key or a signed token."""
    out = []
    for heads, base64_digits in ((_HEAD, True), (_HEX_HEAD, False)):
        end = 0
        for m in heads.finditer(text):
            # Inside a key that was found nothing is looked for; behind it and behind rejected ones all is.
            found = _key_span(text, m.start(), base64_digits) if m.start() >= end else None
            if found:
                end = found[1]
                out.append((found[0], m.start(), end))
    end = 0
    for m in _TOKEN.finditer(text):
        if m.start() < end or _json_object(m[2]) is None:
            continue
        for start in (m.start(), *(x.start() for x in _OBJECT.finditer(text, m.start() + 1, m.end()))):
            if m.end() - start >= 12 and is_signed_token(f"{text[start:m.end()]}.{m[2]}.{m[3]}"):
                end = m.end(3)
                out.append(("signed_token", start, end))
                break
    return out


def _joined(spans: list[tuple[str, int, int]]) -> str:
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_confirmed, base_sha256, spans`` for every row.

    A null or empty text has no spans (empty string, and the digest of an empty string). Repeated
    rows are reported each; a null id stays null. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text in part.column(1).to_pylist():
                    base = base_spans(text)
                    counts = [sum(kind == k for kind, _, _ in base) for k in KINDS[:3]]
                    digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                    more = structural_spans(text)
                    rows.append((*counts, len(more), digest, _joined(base + more)))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 6
                kinds = [pa.int64()] * 4 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"],
                )

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string",
    )


def redact(text: str) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    out, at = [], 0
    spans = sorted(base_spans(text) + structural_spans(text), key=lambda s: (s[1], -s[2]))
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All rows and columns, with secrets in the text replaced; a null text stays null.

    A column of text lengths, where there is one, follows a text that changed.
    """
    ship_package(docs.sparkSession)
    place = docs.columns.index(text_col)
    length = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.schema.names[place]):
                texts = part.column(place).to_pylist()
                clean = [None if t is None else redact(t) for t in texts]
                columns = list(part.columns)
                columns[place] = pa.array(clean, part.schema.field(place).type)
                if length is not None:
                    sizes = [
                        n if old == new else len(new)
                        for n, old, new in zip(part.column(length).to_pylist(), texts, clean, strict=True)
                    ]
                    columns[length] = pa.array(sizes, part.schema.field(length).type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return docs.mapInArrow(run, docs.schema)

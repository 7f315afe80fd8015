"""Secrets in texts: patterns first, then confirmation by the structure of what they encode.

A stretch of base64 or hex letters may be anything. It is reported as a key only if its decoded
bytes parse: DER lengths that nest and end where they must around the fields of a private key, a private key
container whose length-prefixed fields fill it, or a signed token whose header is a JSON object that
names an algorithm. Public keys and certificates parse too, but are no secrets. The work is linear in the text.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base patterns, and the least length that each match must reach.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Kinds in the order that settles equal starts; the last four need a confirmed structure.
KINDS = ("assign", "access", "hex", "signed_token", "der_key", "key_blob", "pem_key")

#: Shortest stretches that are decoded.
LEAST_SIGNED, LEAST_ENCODED = 12, 32

_TOKEN_LETTERS = re.compile(r"[A-Za-z0-9_.-]+")
#: Where a header may begin: with white space or a brace, so with one of four letters, and not inside a word.
_HEADER = re.compile(r"(?<![A-Za-z0-9])[CDIe](?=[A-Za-z0-9_-]{7})")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
#: A DER sequence begins with this letter; so may a key that follows a slash or a dash.
_SEQUENCE = re.compile(r"(?<![A-Za-z0-9])M(?=[A-Za-z0-9+/_-]{7})")
_LETTERS = re.compile(r"[A-Za-z0-9+/_-]+")
_LONG_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9a-f]{2}){16,}(?![0-9A-Fa-f])|(?<![0-9A-Fa-f])(?:[0-9A-F]{2}){16,}(?![0-9A-Fa-f])")
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----", re.ASCII)

ROWS = "doc_id long, kinds array<string>, starts array<int>, ends array<int>"


def decoded(candidate: str) -> bytes | None:
    """The bytes of a base64 stretch in either alphabet; None if it has no such reading."""
    body = candidate.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except binascii.Error:
        return None


def _element(data: bytes, at: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the content of a DER element; None if the length is not a proper one."""
    if at + 2 > len(data):
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or start + n > len(data):
            return None
        size = int.from_bytes(data[start : start + n], "big")
        if size < 0x80 or size >> (8 * (n - 1)) == 0:
            return None
        start += n
    return (tag, start, start + size) if start + size <= len(data) else None


#: Object ids under which keys are encrypted (PKCS #5, and PKCS #12 with a password).
_ENCRYPTED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))
_INTEGER, _OCTETS, _OBJECT, _SEQUENCE_TAG = 0x02, 0x04, 0x06, 0x30


def _elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill a range; None if they do not."""
    found = []
    while at < end:
        element = _element(data, at)
        if element is None or element[2] > end:
            return None
        found.append(element)
        at = element[2]
    return found


def is_der_key(data: bytes) -> bool:
    """A private key: a sequence that fills the bytes, whose nested lengths all fit, with the fields of one of these.

    A version and at least four numbers, one of them of key size; a version and a key of 16 bytes or more as octets; a
    version, an algorithm's object id and a key as octets; an encryption's object id and octets.
    """
    outer = _element(data, 0)
    if outer is None or outer[0] != _SEQUENCE_TAG or outer[2] != len(data) or len(data) < 32:
        return False
    fields, todo = None, [(outer[1], outer[2])]
    while todo:
        found = _elements(data, *todo.pop())
        if found is None or any(tag == _INTEGER and stop == start for tag, start, stop in found):
            return False
        fields = found if fields is None else fields
        todo += [(start, stop) for tag, start, stop in found if tag & 0x20]
    tags, sizes = [f[0] for f in fields], [f[2] - f[1] for f in fields]

    def object_id(field: tuple[int, int, int]) -> bytes:
        inner = _elements(data, field[1], field[2]) or [(0, 0, 0)]
        return data[inner[0][1] : inner[0][2]] if inner[0][0] == _OBJECT else b""

    if tags[:2] == [_SEQUENCE_TAG, _OCTETS] and len(tags) == 2:
        return sizes[1] >= 16 and object_id(fields[0]).startswith(_ENCRYPTED)
    if tags[0] != _INTEGER or sizes[0] != 1 or data[fields[0][1]] > 1:
        return False
    if set(tags) == {_INTEGER}:
        return len(tags) >= 5 and max(sizes) >= 16
    if tags[1:2] == [_OCTETS]:
        return sizes[1] >= 16
    return tags[1:3] == [_SEQUENCE_TAG, _OCTETS] and sizes[2] >= 16 and object_id(fields[1]) != b""


def _prefixed(data: bytes, at: int, end: int, most: int | None = None) -> list[tuple[int, int]] | None:
    """Ranges of the fields behind four-byte lengths: `most` of them, or as many as fill the range; None if they do not fit."""
    found = []
    while at < end if most is None else len(found) < most:
        start = at + 4
        at = start + int.from_bytes(data[at:start], "big")
        if at > end:
            return None
        found.append((start, at))
    return found


#: Fixed value: how a private key container begins, and the letters of that in base64.
_CONTAINER = b"openssh-key-v1\0"
CONTAINER_LETTERS = base64.b64encode(_CONTAINER).decode()


def is_key_blob(data: bytes, begin: int = 0) -> bool:
    """A private key container: cipher, derivation and its settings, as many public keys as it says, and a private part that ends it."""
    end = len(data)
    if not data.startswith(_CONTAINER, begin) or (head := _prefixed(data, begin + len(_CONTAINER), end, 3)) is None:
        return False
    if any(not 1 <= stop - start <= 64 or not data[start:stop].isascii() for start, stop in head[:2]):
        return False
    at = head[2][1]
    count = int.from_bytes(data[at : at + 4], "big")
    # Each key has a length, so there can be no more of them than this.
    if not 1 <= count <= (end - at) // 4 or (keys := _prefixed(data, at + 4, end, count)) is None:
        return False
    if any((fields := _prefixed(data, start, stop)) is None or len(fields) < 2 for start, stop in keys):
        return False
    private = _prefixed(data, keys[-1][1], end)
    return private is not None and len(private) == 1 and private[0][1] - private[0][0] >= 32


def is_signed_header(part: str) -> bool:
    """A JSON object that names its algorithm, in base64 letters."""
    data = decoded(part)
    if not data or not data.lstrip().startswith(b"{"):
        return False
    try:
        header = json.loads(data)
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def _header_start(part: str) -> int | None:
    """Where the first suffix begins that is a header. The bytes of all suffixes come from four decodings."""
    shifted: dict[int, bytes | None] = {}
    for m in _HEADER.finditer(part):
        at = m.start()
        first = at % 4
        if first not in shifted:
            shifted[first] = decoded(part[first:])
        data = shifted[first]
        if data is not None and data[(at - first) * 3 // 4 :].lstrip()[:1] == b"{" and is_signed_header(part[at:]):
            return at
    return None


def signed_spans(text: str) -> list[tuple[int, int]]:
    """Places of three dotted parts of which the first ends in a header; what stands before or after them does not matter."""
    found = []
    for m in _TOKEN_LETTERS.finditer(text):
        if m[0].count(".") < 2:
            continue
        parts, start, free = m[0].split("."), m.start(), 0
        for k, part in enumerate(parts[:-2]):
            if k >= free and len(part) >= 8 and len(parts[k + 1]) >= 2:
                at = _header_start(part)
                if at is not None and decoded(parts[k + 1]) is not None:
                    found.append((start + at, start + len(part) + len(parts[k + 1]) + len(parts[k + 2]) + 2))
                    free = k + 3
            start += len(part) + 1
    return found


def _sequence_span(text: str, at: int, run_end: int) -> tuple[int, int] | None:
    """The stretch from `at` that a DER key fills, over line ends if it must; no other letters may follow it."""
    head = decoded(text[at : at + 8])
    if head is None or head[0] != _SEQUENCE_TAG:
        return None
    # A key of 64 KB or more does not occur.
    n = max(0, head[1] - 0x80)
    if n > 2:
        return None
    size = 2 + n + (int.from_bytes(head[2 : 2 + n], "big") if n else head[1])
    letters, held = -(-size * 4 // 3), run_end - at
    if held > letters:
        return None
    body, end = [text[at:run_end]], run_end
    while held < letters and (m := _LETTERS.match(text, end + 1 + text.startswith("\r\n", end))) and text[end : end + 1] in ("\r", "\n"):
        body.append(m[0])
        held, end = held + len(m[0]), m.end()
    data = decoded("".join(body)) if held == letters else None
    if data is None or not is_der_key(data):
        return None
    return at, end + len(text[end : end + 2]) - len(text[end : end + 2].lstrip("="))


def sequence_spans(text: str) -> list[tuple[int, int]]:
    found, run_end, free = [], 0, 0
    for m in _SEQUENCE.finditer(text):
        if m.start() < free:
            continue
        if m.start() >= run_end:
            run_end = _LETTERS.match(text, m.start()).end()
        span = _sequence_span(text, m.start(), run_end)
        if span is not None:
            found.append(span)
            free = span[1]
    return found


def container_spans(text: str) -> list[tuple[int, int]]:
    """Stretches of base64 letters that a container fills, wherever in a run it begins."""
    found, run_end, shifted = [], 0, {}
    for m in re.finditer(CONTAINER_LETTERS, text):
        at = m.start()
        if at >= run_end:
            run, shifted = _BASE64.match(text, at), {}
            if run is None:
                continue
            run_end = run.end()
        # All starts of a run share four decodings.
        base, data = shifted.get(at % 4, (0, None))
        if at % 4 not in shifted:
            base, data = shifted[at % 4] = at, decoded(text[at:run_end])
        if data is not None and is_key_blob(data, (at - base) * 3 // 4):
            found.append((at, run_end))
    return found


def longest_run(text: str) -> int:
    """Of characters other than white space: no pattern of letters is longer."""
    return max(map(len, text.split()), default=0)


def base_spans(text: str, longest: int) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the pattern kinds, in code points."""
    found = []
    folded = text.lower()
    # Lower-casing keeps ASCII words in place or adds some; it never hides one.
    if any(word in folded for word in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    if longest >= LEAST_HEX:
        found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def confirmed_spans(text: str, longest: int) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the stretches whose structure is a key's or a signed token's."""
    found = []
    if longest >= LEAST_SIGNED and any(word.count(".") > 1 for word in text.split() if len(word) >= LEAST_SIGNED):
        found += [("signed_token", start, end) for start, end in signed_spans(text)]
    if longest >= LEAST_ENCODED:
        found += [("der_key", start, end) for start, end in sequence_spans(text)]
        if CONTAINER_LETTERS in text:
            found += [("key_blob", start, end) for start, end in container_spans(text)]
        for m in _LONG_HEX.finditer(text):
            if m[0][:2] == "30" and is_der_key(bytes.fromhex(m[0])):
                found.append(("der_key", m.start(), m.end()))
            elif m[0].startswith(_CONTAINER.hex()) and is_key_blob(bytes.fromhex(m[0])):
                found.append(("key_blob", m.start(), m.end()))
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            data = decoded(re.sub(r"\s", "", m[2]))
            if data is not None and (is_der_key(data) or is_key_blob(data)):
                found.append(("pem_key", m.start(), m.end()))
    return found


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text, by start and then kind."""
    if not text:
        return []
    longest = longest_run(text)
    spans = set(base_spans(text, longest)) | set(confirmed_spans(text, longest))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        found = [spans_of(text.as_py()) for text in part.column("text")]
        columns = [pa.array([[s[i] for s in row] for row in found], pa.list_(kind)) for i, kind in ((0, pa.string()), (1, pa.int32()), (2, pa.int32()))]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "kinds", "starts", "ends"])


def secret_scan(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, spans: the spans (kind, start, end) of every document, by start and then kind.

    Kinds are those of KINDS; places are code points, the end exclusive. A null text has none. Every
    row is scanned, rows without an id and rows that share one too. Very long texts, with or without spaces, are scanned
    whole in time that grows with their length. An empty table gives no rows. Other columns are ignored.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = source.mapInArrow(_scan, ROWS)
    spans = F.zip_with(
        F.arrays_zip("kinds", "starts"), "ends", lambda a, end: F.struct(a["kinds"].alias("kind"), a["starts"].alias("start"), end.alias("end"))
    )
    return found.select("doc_id", spans.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: counts and texts of the spans."""
    base = list(KINDS[:3])

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kept = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *map(number, base), F.sha2(shown(kept).cast("binary"), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))

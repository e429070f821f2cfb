"""Secret scans with structural confirmation.

Plain patterns find assignments, access key ids and long hex runs. Candidates for encoded secrets are then decoded and
reported only if their inside is in order: base64 (either alphabet) or hex, from any place on, wrapped or not, by
line ends as they are or escaped and with indentation or without, that is a DER private key
whose nested lengths add up, an OpenSSH private key whose length-prefixed fields do, or a signed token whose header is
JSON with an algorithm.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from larkspur.llm.common import free_name, lean, with_field

#: The base patterns, letters of the keywords in either case (ASCII only), and the least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of at least the least length is what [0-9a-f]+ finds less its failures
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "token", "openssh", "der")

#: Where a signed token may begin: an encoded "{", or the white space that JSON allows before it. Seen ahead, so that one may begin within another's place.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(?=((?:e[w-z0-9_-]|I[A-P]|C[Q-Za-v]|D[Q-Za-f])[A-Za-z0-9_-]*\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+))")
#: What may part the lines of an encoded key: line ends as they are or escaped, with white space around them.
WRAP = r"(?:[ \t]*+(?:\r\n?|\n|\\++r\\++n|\\++n))++[ \t]*+"
WRAPS = re.compile(WRAP)
#: Where a key in base64 or base64url may begin: a SEQUENCE (M) or OpenSSH's magic (b3B).
START = re.compile(rf"M(?=(?:{WRAP})?[A-I])|b(?=(?:{WRAP})?3(?:{WRAP})?B)")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]+")
PADS = [re.compile(rf"(?:{WRAP})?{'=' * n}") if n else re.compile("") for n in range(3)]
#: The same in hex: a SEQUENCE (30) with its length, or 6f70656e.
START_HEX = re.compile(rf"3(?=(?:{WRAP})?0(?:{WRAP})?[0-8])|6(?=(?:{WRAP})?[fF](?:{WRAP})?7)")
LETTERS_HEX = re.compile("[0-9A-Fa-f]+")
OPENSSH = b"openssh-key-v1\x00"
STANDARD = str.maketrans("-_", "+/")
#: Algorithm identifiers of private keys: RSA, elliptic curve, DSA, X25519, X448, Ed25519, Ed448.
KEY_OIDS = {bytes.fromhex(x) for x in ("2a864886f70d010101", "2a8648ce3d0201", "2a8648ce380401", "2b656e", "2b656f", "2b6570", "2b6571")}


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of DER elements that fill the data exactly; None if lengths don't add up."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, n = data[at], data[at + 1]
        at += 2
        if n >= 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > len(data) or data[at] == 0:
                return None
            n = int.from_bytes(data[at : at + k], "big")
            at += k
            if n < 0x80:
                return None
        if at + n > len(data):
            return None
        out.append((tag, data[at : at + n]))
        at += n
    return out


def is_private_key(data: bytes) -> bool:
    """PKCS#1, SEC 1, PKCS#8 or encrypted PKCS#8 in DER, checked through its nested lengths."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30 or not (parts := der_items(outer[0][1])):
        return False
    tags = [t for t, _ in parts]
    if len(parts) == 2 and tags == [0x30, 0x04]:  # encrypted: algorithm and octets
        inner = der_items(parts[0][1])
        return bool(inner) and inner[0][0] == 0x06 and inner[0][1].startswith(bytes.fromhex("2a864886f70d0105")) and len(parts[1][1]) >= 16
    if tags[0] != 0x02 or parts[0][1] not in (b"\x00", b"\x01", b"\x02"):
        return False
    if len(parts) >= 9 and set(tags[:9]) == {0x02}:  # RSA: version and eight integers
        return len(parts[1][1]) >= 32
    if len(parts) == 6 and set(tags) == {0x02}:  # DSA
        return len(parts[1][1]) >= 32
    if len(parts) >= 2 and tags[1] == 0x04 and parts[0][1] == b"\x01":  # SEC 1
        return 20 <= len(parts[1][1]) <= 66
    if len(parts) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:  # PKCS#8
        algorithm = der_items(parts[1][1])
        if not algorithm or algorithm[0][0] != 0x06 or algorithm[0][1] not in KEY_OIDS:
            return False
        return bool(der_items(parts[2][1]))
    return False


def is_openssh_key(data: bytes) -> bool:
    """The magic, cipher, kdf and options, key count, public keys and private block, each by its length."""
    if not data.startswith(OPENSSH):
        return False
    at = len(OPENSSH)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n : at]

    if any(field() is None for _ in range(3)) or at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 16 or any(field() is None for _ in range(keys)):
        return False
    return bool(field()) and at == len(data)


def is_token(text: str) -> bool:
    """header.claims.signature in base64url: both JSON objects, the header with an alg that signs."""
    head, claims, signature = text.split(".")
    try:
        decoded = [json.loads(base64.urlsafe_b64decode(x + "=" * (-len(x) % 4))) for x in (head, claims)]
    except (ValueError, RecursionError):
        return False
    return all(isinstance(x, dict) for x in decoded) and isinstance(decoded[0].get("alg"), str) and decoded[0]["alg"].lower() != "none" and len(signature) >= 16


def _taken(text: str, at: int, n: int, letters: re.Pattern) -> tuple[str, int] | None:
    """The n letters from a place on, without what wraps lines, and where they end; None if there are fewer."""
    got = []
    while m := letters.match(text, at, min(at + n, len(text))):
        got.append(m[0])
        at, n = m.end(), n - len(m[0])
        if not n:
            return "".join(got), at
        if not (m := WRAPS.match(text, at)):
            return None
        at = m.end()
    return None


def _base64(text: str, at: int, n: int) -> tuple[bytes, int] | None:
    """The n bytes in base64 from a place on, and where they end."""
    got = _taken(text, at, -(-4 * n // 3), BASE64)
    return got and (base64.b64decode(got[0].translate(STANDARD) + "=" * (-len(got[0]) % 4))[:n], got[1])


def _hex(text: str, at: int, n: int) -> tuple[bytes, int] | None:
    """The n bytes in hex from a place on, and where they end."""
    got = _taken(text, at, 2 * n, LETTERS_HEX)
    return got and (bytes.fromhex(got[0]), got[1])


def key_length(read: Callable[[int], tuple[bytes, int] | None]) -> int | None:
    """Bytes of the key that starts as read says, by the lengths in it; None if it cannot be one. read gives the first n bytes."""
    if not (got := read(16)):
        return None
    head = got[0]
    if head[0] == 0x30:
        k = head[1] & 0x7F if head[1] >= 0x80 else 0
        if k > 4 or head[1] == 0x80:
            return None
        first = head[2 + k :]  # a version, or an algorithm that begins with its identifier
        inner = first[1] & 0x7F if first[1] >= 0x80 else 0
        if not (first[:2] == b"\x02\x01" and first[2] <= 2 or first[0] == 0x30 and inner <= 4 and first[2 + inner] == 0x06):
            return None
        return 2 + k + (int.from_bytes(head[2 : 2 + k], "big") if k else head[1])
    if not head.startswith(OPENSSH):
        return None
    at, left = len(OPENSSH), 3  # cipher, kdf and options, then as many public keys as are said, and the private block

    def number() -> int | None:
        nonlocal at
        at += 4
        return int.from_bytes(got[0][at - 4 : at], "big") if (got := read(at)) else None

    while left:
        if (n := number()) is None:
            return None
        at, left = at + n, left - 1
    if (keys := number()) is None or not 1 <= keys <= 16:
        return None
    for _ in range(keys + 1):
        if (n := number()) is None:
            return None
        at += n
    return at


def _keys(text: str, starts: re.Pattern, decoded: Callable, end_of: Callable) -> list[tuple[int, int, str]]:
    """Spans of keys that begin at some start, none within another. end_of gives a key's end, or None if it goes on.

    A key may go on only with another one, so the last are looked at first.
    """
    found: dict[int, tuple[int, str]] = {}
    for at in reversed([m.start() for m in starts.finditer(text)]):
        read = functools.partial(decoded, text, at)
        if (n := key_length(read)) and (got := read(n)):
            kind = "der" if is_private_key(got[0]) else "openssh" if is_openssh_key(got[0]) else None
            end = kind and (got[1] if got[1] in found else end_of(text, at, got[1], n))
            if end:
                found[at] = end, kind
    out: list[tuple[int, int, str]] = []
    for at in sorted(found):
        if not out or at >= out[-1][1]:
            out.append((at, *found[at]))
    return out


def _base64_end(text: str, at: int, end: int, n: int) -> int | None:
    """The end with its padding; None if more letters of the same alphabet follow in the line."""
    pads = (-4 * n // 3) % 4
    if pads and (m := PADS[pads].match(text, end)):
        return m.end()
    more = text[end : end + 1]
    if more in ("-", "_") and not re.search("[-_]", text[at:end]):
        return end
    return None if BASE64.match(more) else end


def _hex_end(text: str, at: int, end: int, n: int) -> int | None:
    """The end; None if another byte follows in the line."""
    return None if re.match("[0-9A-Fa-f]{2}", text[end : end + 2]) else end


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start, then as KINDS has them. Code points, end exclusive.

    A null or empty text has none. The scan is over the whole text and linear in it but for the size of candidates.
    """
    if not text:
        return []
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    last = 0
    for m in TOKEN.finditer(text):
        if m.start() >= last and is_token(m[1]):
            out.append((m.start(), last := m.end(1), "token"))
    out += _keys(text, START, _base64, _base64_end)
    out += _keys(text, START_HEX, _hex, _hex_end)
    return sorted(set(out), key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def redact(text: str | None, mask: str = "[secret]") -> str | None:
    """The text with every span, overlapping ones together, replaced by the mask, over again if that lays bare another; a null stays null."""
    while spans := scan(text):
        out, at = [], 0
        for start, end, _ in spans:
            if start >= at:
                out += [text[at:start], mask]
            at = max(at, end)
        text = "".join([*out, text[at:]])
    return text


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_assign, n_access, n_hex, base_sha256 (over kind:start:end of the base kinds), spans (all kinds).

    Rows with a null text have no spans; repeated rows are kept; an empty table gives no rows; other columns are ignored.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ = [scan(x.as_py()) for x in batch.column(1)]
            base = [[x for x in s if x[2] in KINDS[:3]] for s in all_]
            counts = [pa.array([sum(x[2] == k for x in s) for s in base], pa.int64()) for k in KINDS[:3]]
            digest = pa.array([hashlib.sha256(_joined(s).encode()).hexdigest() for s in base], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digest, pa.array([_joined(s) for s in all_], pa.string())], [key, "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return lean(docs).select(key, text).mapInArrow(found, f"`{key}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(docs: DataFrame, text: str = "text", chars: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with secrets masked in the text, and chars (if the table has it) counted anew where the text changed."""
    clean = free_name(docs, "clean")

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = batch.schema.get_field_index(text)
            yield batch.append_column(clean, pa.array([redact(x.as_py()) for x in batch.column(i)], pa.string()))

    out = lean(docs).mapInArrow(masked, with_field(docs, clean, StringType()))
    if chars in docs.columns:
        out = out.withColumn(chars, F.when(F.col(clean).eqNullSafe(F.col(text)), F.col(chars)).otherwise(F.length(clean).cast(docs.schema[chars].dataType)))
    return out.withColumn(text, F.col(clean)).drop(clean)

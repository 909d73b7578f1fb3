"""Secret scan with structural confirmation.

Base patterns (assignments, access keys, hex strings) give candidates by shape alone. The structural
part decodes base64 and hex runs and reports a span only if the bytes parse as what they claim to be:

* ``pem``  an armoured private key whose body decodes to a DER key or an OpenSSH key;
* ``der``  a bare base64 or hex run, on one line or wrapped, that decodes to a DER private key (tags, versions and every
  nested length must fit);
* ``ssh``  such a run that decodes to ``openssh-key-v1`` with consistent nested lengths;
* ``jwt``  three base64url parts whose header is a JSON object with ``alg`` and whose payload is JSON.

A run that decodes to text is scanned once more, one level deep: it is reported whole as the first kind confirmed in it, so an
armoured key kept as base64 counts. Runs may follow a path and a slash, hex may be written with colons, tokens may follow a dotted name.

Null or empty text: no spans. Ties (spans at one start) are ordered by kind. Very long texts and runs
are scanned whole. Repeated rows: every row is scanned alone. Positions are code points, end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import math
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnkit.llm.common import field, per_text

KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")      # each keyword contains one of these
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}+")        # maximal runs, short ones dropped
_ESCAPED = re.compile(r"\\+[nr]")                       # line breaks as JSON and source code write them
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:[^-]++|-(?!----))*+)-----END \1-----")
_PEM_HEADER = re.compile(r"(?:Proc-Type|DEK-Info):\s*\S+|^[\s>]*[A-Za-z][A-Za-z0-9-]*:.*$", re.MULTILINE)
_QUOTES = re.compile(r"""["'`][\s+,.]*["'`]""")           # between the string literals of one value
_B64_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}+={0,2}")
_HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}+")
# what may lie between two lines (a line break must): blanks, reply marks, the quotes of string literals
_BREAK = r"""[\s>]*+(?:["'`][\s+,.]*["'`][\s>]*+)?"""
_B64_NEXT = re.compile(_BREAK + r"([A-Za-z0-9+/_-]++={0,2})")
_HEX_NEXT = re.compile(_BREAK + r"([0-9A-Fa-f]++)(?![A-Za-z0-9+/_-])")
# a header's base64 begins so if its JSON does, with a brace or with white space before it
_JWT = re.compile(r"(?<![A-Za-z0-9_-])([eICD][A-Za-z0-9_-]{9,}+)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]++)")
_COLON_HEX = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{2}(?::\s*+[0-9A-Fa-f]{2}){31,}+(?![0-9A-Fa-f])")
# what base64 of a DER sequence, an OpenSSH key and an armour line begins with, behind a path
_GLUED = re.compile(r"/(?=M[CEHI]|b3BlbnNzaC|LS0tLS1CRUdJTi)")
_TEXT_BYTES = frozenset((9, 10, 13, *range(32, 127)))

SSH_MAGIC = b"openssh-key-v1\0"

Span = tuple[int, int, int]      # start, kind index, end


def base_spans(text: str) -> Iterator[Span]:
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= 12:
                yield m.start(), 0, m.end()
    for m in _ACCESS.finditer(text):
        if m.end() - m.start() >= 18:
            yield m.start(), 1, m.end()
    for m in _HEX.finditer(text):
        yield m.start(), 2, m.end()


def b64_bytes(run: str) -> bytes | None:
    """Either alphabet, with or without padding; None if it is not base64."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(raw: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, body) items that fill ``raw`` exactly; None if a length does not fit."""
    items, at = [], 0
    while at < len(raw):
        if at + 2 > len(raw):
            return None
        tag, size = raw[at], raw[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(raw):
                return None
            size = int.from_bytes(raw[at:at + width], "big")
            at += width
        if at + size > len(raw):
            return None
        items.append((tag, raw[at:at + size]))
        at += size
    return items


def is_der_key(raw: bytes) -> bool:
    """A private key: PKCS#8, PKCS#1 (RSA), DSA, SEC 1 (EC) or encrypted PKCS#8, with all lengths nested rightly."""
    outer = der_items(raw) if raw[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    parts = der_items(outer[0][1])
    if not parts or len(parts) < 2:
        return False
    tags = [t for t, _ in parts]
    if tags[0] == 0x02 and parts[0][1] in (b"\0", b"\1"):
        if tags[1] == 0x30 and len(parts) >= 3 and tags[2] == 0x04:              # PKCS#8
            algorithm = der_items(parts[1][1])
            return bool(algorithm) and algorithm[0][0] == 0x06
        if len(parts) >= 9 and set(tags[:9]) == {0x02}:                          # PKCS#1
            return True
        if len(parts) == 6 and set(tags) == {0x02} and parts[0][1] == b"\0":     # DSA: version, p, q, g, y, x
            return True
        return tags[1] == 0x04 and len(parts[1][1]) >= 16 and parts[0][1] == b"\1"   # SEC 1
    if tags == [0x30, 0x04]:                                                     # encrypted PKCS#8
        algorithm = der_items(parts[0][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and len(parts[1][1]) >= 16
    return False


def der_size(raw: bytes) -> int | None:
    """Bytes of the DER item that ``raw`` begins with, by its own header."""
    if len(raw) < 2 or raw[0] != 0x30:
        return None
    width = raw[1] & 0x7F if raw[1] & 0x80 else 0
    if raw[1] & 0x80 and not 1 <= width <= 4 or len(raw) < 2 + width:
        return None
    return 2 + width + (int.from_bytes(raw[2:2 + width], "big") if width else raw[1])


def ssh_size(raw: bytes) -> int | None:
    """Bytes of the openssh-key-v1 that ``raw`` begins with: cipher, kdf, options, key count, that many public keys, one
    private block."""
    if not raw.startswith(SSH_MAGIC):
        return None
    at = len(SSH_MAGIC)

    def take() -> bytes | None:
        nonlocal at
        size = int.from_bytes(raw[at:at + 4], "big")
        if at + 4 + size > len(raw):
            return None
        body = raw[at + 4:at + 4 + size]
        at += 4 + size
        return body

    if any(take() is None for _ in range(3)) or at + 4 > len(raw):
        return None
    count = int.from_bytes(raw[at:at + 4], "big")
    at += 4
    if not 1 <= count <= 16 or any(not take() for _ in range(count)):
        return None
    return at if take() else None


def is_ssh_key(raw: bytes) -> bool:
    return len(raw) > 0 and ssh_size(raw) == len(raw)


def is_jwt(header: str, payload: str) -> bool:
    try:
        head, body = (json.loads(b64_bytes(x) or b"") for x in (header, payload))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def unescaped(text: str) -> str:
    """Escaped line breaks as blanks and a line break of the same length, so that positions stay."""
    return _ESCAPED.sub(lambda m: " " * (len(m[0]) - 1) + "\n", text) if "\\" in text else text


def is_pem_key(body: str) -> bool:
    """The text between the armour lines: headers, then base64 of a key or, if a header says so, of an encrypted one."""
    headers = " ".join(_PEM_HEADER.findall(body))
    body = _QUOTES.sub("\n", _PEM_HEADER.sub("\n", body)).replace("\\", "")
    raw = b64_bytes("".join("".join(x.lstrip("> \t").split()) for x in body.split("\n")))
    return bool(raw) and (is_der_key(raw) or is_ssh_key(raw) or "ENCRYPTED" in headers and len(raw) >= 64)


def hex_bytes(run: str) -> bytes | None:
    return bytes.fromhex(run) if len(run) % 2 == 0 else None


def bare_keys(text: str, first: re.Pattern, following: re.Pattern, decode: Callable[[str], bytes | None],
              chars: float, depth: int) -> Iterator[Span]:
    """Keys without armour: runs of ``chars`` characters a byte, on one line or wrapped (lines of one width, then one that
    may be shorter). A key says how long it is itself; its last character must end a line or its run. Runs that are
    text are scanned for ``depth`` more levels."""
    done = 0
    for m in first.finditer(text):
        if m.start() < done:
            continue
        lines, width = [(m.start(), m.end(), m[0].rstrip("="))], len(m[0])
        while len(lines[-1][2]) == width and (n := following.match(text, lines[-1][1])):
            if len(n[1]) > width or "\n" not in text[n.start():n.start(1)]:
                break
            lines.append((n.start(1), n.end(1), n[1].rstrip("=")))
        if depth and (within := _within(lines, width, decode, chars, depth)):
            yield lines[0][0], within[1], lines[within[0]][1]
            done = lines[within[0]][1]
            continue
        i = 0
        while i < len(lines):
            last = _key_end(lines, i, width, decode, chars)
            if last:
                k, kind = last
                yield lines[i][0], kind, lines[k][1]
                i = k
            i += 1
            done = lines[i - 1][1]
            if i == len(lines) - 1 and len(lines[i][2]) < width:     # a shorter line may begin a block of its own
                break
        if len(lines) == 1 and "/" in m[0]:                          # a run behind a path
            for cut in _GLUED.finditer(m[0]):
                rest = [(m.start() + cut.end(), m.end(), m[0][cut.end():].rstrip("="))]
                size = max(1, len(rest[0][2]))
                last = _key_end(rest, 0, size, decode, chars) or depth and _within(rest, size, decode, chars, depth)
                if last:
                    yield rest[0][0], last[1], m.end()
                    break


def _within(lines: list[tuple[int, int, str]], width: int, decode: Callable[[str], bytes | None], chars: float,
            depth: int) -> tuple[int, int] | None:
    """(last line, kind) of what is confirmed in the text that a block of lines decodes to: the last span's line, the first
    span's kind. None if it is no text or holds nothing."""
    head = decode(lines[0][2][:32])
    if not head or not _TEXT_BYTES.issuperset(head):
        return None
    whole = "".join(x for _, _, x in lines)
    raw = decode(whole) or decode(whole[:len(whole) // 4 * 4]) or b""
    found = sorted(structural_spans(raw.decode("latin-1"), depth - 1))
    return (min(len(lines), math.ceil(max(e for *_, e in found) * chars / width)) - 1, found[0][1]) if found else None


def _key_end(lines: list[tuple[int, int, str]], i: int, width: int, decode: Callable[[str], bytes | None],
             chars: float) -> tuple[int, int] | None:
    """(last line, kind) of the key that begins with line ``i``."""
    head = decode(lines[i][2][:32])
    if not head:
        return None
    if head.startswith(SSH_MAGIC):
        whole = "".join(x for _, _, x in lines[i:])
        size = ssh_size(decode(whole) or decode(whole[:len(whole) // 4 * 4]) or b"")
    else:
        size = der_size(head)
    if size is None:
        return None
    need = math.ceil(size * chars)
    k = i + (need - 1) // width
    if k >= len(lines) or need != (k - i) * width + len(lines[k][2]):
        return None
    raw = decode("".join(x for _, _, x in lines[i:k + 1])) or b""
    return (k, 4) if is_der_key(raw) else (k, 5) if is_ssh_key(raw) else None


def structural_spans(text: str, depth: int = 1) -> Iterator[Span]:
    text = unescaped(text)
    armoured: list[tuple[int, int]] = []
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            if is_pem_key(m[2]):
                yield m.start(), 3, m.end()
                armoured.append((m.start(), m.end()))
    found = [*bare_keys(text, _B64_RUN, _B64_NEXT, b64_bytes, 8 / 6, depth), *bare_keys(text, _HEX_RUN, _HEX_NEXT, hex_bytes, 2, depth)]
    for m in _COLON_HEX.finditer(text) if ":" in text else ():
        raw = bytes.fromhex("".join(m[0].replace(":", " ").split()))
        if is_der_key(raw) or is_ssh_key(raw):
            found.append((m.start(), 4 if is_der_key(raw) else 5, m.end()))
    for a, k, b in found:
        at = bisect.bisect_right(armoured, (a, len(text))) - 1
        if at < 0 or a >= armoured[at][1]:           # an armoured key is one secret
            yield a, k, b
    for m in _JWT.finditer(text):
        if is_jwt(m[1], m[2]):
            yield m.start(), 6, m.end()


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each ordered by start, then kind."""
    text = text or ""
    base = sorted(base_spans(text))
    return base, sorted(base + list(structural_spans(text)))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


FIELDS = (
    field("n_assign", T.LongType()), field("n_access", T.LongType()), field("n_hex", T.LongType()),
    field("base_sha256", T.StringType()), field("spans", T.StringType()), field("n_confirmed", T.LongType()),
)


def _report():
    def one(text: str | None) -> tuple:
        base, every = scan(text)
        count = [sum(k == i for _, k, _ in base) for i in range(3)]
        digest = hashlib.sha256(joined(base).encode()).hexdigest()
        return *count, digest, joined(every), len(every) - len(base)

    return one


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, counts, digest of the base spans, all spans), one row per row of ``docs``."""
    return per_text(docs, [doc_id], text, _report, FIELDS)


def redact(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span (overlaps merged) replaced by ``mark``; None stays None."""
    if not text:
        return text
    out, at = [], 0
    for start, _, end in scan(text)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the secrets in ``text`` masked; all other columns and the column order stay."""
    keep = [c for c in docs.columns if c != text]
    out = per_text(docs, keep, text, lambda: lambda t: (redact(t, mark),), [field(text, T.StringType())])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Secret scan: pattern matches, and matches confirmed by their structure.

Three kinds are plain patterns (assign, access, hex). Three more are reported
only when their bytes decode to what they claim to be:

- ``token``: a signed token, header and claims JSON objects, the header with an
  algorithm, the signature base64 as well;
- ``key``: base64 or hex of a DER sequence whose nested lengths add up exactly
  and that holds a number or an algorithm;
- ``ssh``: base64 of length-prefixed fields behind a known name.
"""

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kinds in their order, and the patterns of the first three.
KINDS = ("assign", "access", "hex", "token", "key", "ssh")
_NAMES = "password|passwd|secret|token|api_?key"
_ANY_CASE = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in _NAMES)
ASSIGN = re.compile(rf"({_ANY_CASE})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

_BASE64 = "[A-Za-z0-9+/_-]"
# A header begins with a brace and maybe white space behind it: at the start of a
# run of base64, or anywhere if a quote follows at once.
TOKEN = re.compile(
    r"(?:(?<![A-Za-z0-9_-])e[w-z0-9_-]|eyJ)[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"
)
# A DER sequence of 32 bytes or more begins with 0x30 and a length. How much
# belongs to it, its length says.
DER = re.compile(rf"M[CDEFGHIJ]{_BASE64}{{30}}")
DER_HEX = re.compile(r"30(?:[0-7][0-9a-fA-F]|8[1-4])(?:[0-9a-fA-F]{2}){30}")
SSH = re.compile(rf"(?:AAAA|b3BlbnNzaC1rZXktdjEA){_BASE64}{{20,}}(?:\s{{1,2}}{_BASE64}{{16,}})*={{0,2}}")
_OPENSSH = b"openssh-key-v1\x00"
# Base64 goes on over line ends, indented, quoted or escaped as they may be.
_RUN = re.compile(f"{_BASE64}+")
_HEX_ONLY = re.compile("[0-9a-fA-F]+")
_GAP = re.compile(r"(?:\\+[nr]|\\?[\s\"'>])+")
_GOES_ON = re.compile(r"[A-Za-z0-9+/_]|-(?!----)")
# Characters in which the length of an SSH key has to show: private keys of the
# largest sizes in use take some 16,000.
_SSH_MOST = 1 << 16


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = []
    lower = text.lower() if text.isascii() else text
    likely = not text.isascii() or any(
        n in lower for n in ("password", "passwd", "secret", "token", "apikey", "api_key")
    )
    if likely:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 12:
                found.append(("assign", m.start(), m.end()))
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def _decoded(text: str) -> bytes | None:
    text = re.sub(r"\s", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    data = _decoded(part)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_token(text: str) -> bool:
    header, claims, signature = text.split(".")
    head = _json_object(header)
    if head is None or not isinstance(head.get("alg"), str):
        return False
    return _json_object(claims) is not None and _decoded(signature) is not None


def _der_length(data: bytes, at: int) -> tuple[int, int] | None:
    """Length of the value whose length field is at ``at``, and where it starts."""
    if at >= len(data):
        return None
    first = data[at]
    if first < 128:
        return first, at + 1
    size = first & 127
    if not 1 <= size <= 4 or at + 1 + size > len(data):
        return None
    return int.from_bytes(data[at + 1 : at + 1 + size], "big"), at + 1 + size


def der_size(data: bytes) -> int:
    """Bytes of the DER sequence that ``data`` begins with; 0 if its nested
    lengths don't add up, or no whole number or object id is in it."""
    if not data or data[0] != 0x30:
        return 0
    outer = _der_length(data, 1)
    if outer is None or outer[0] < 8 or outer[1] + outer[0] > len(data):
        return 0
    total, useful, open_ranges = outer[1] + outer[0], False, [(outer[1], outer[1] + outer[0], 1)]
    while open_ranges:
        at, end, depth = open_ranges.pop()
        while at < end:
            tag, inner = data[at], _der_length(data, at + 1)
            if tag == 0 or inner is None or inner[1] + inner[0] > end:
                return 0
            useful |= tag in (0x02, 0x06) and inner[0] > 0
            if tag & 0x20 and depth < 16:
                open_ranges.append((inner[1], inner[1] + inner[0], depth + 1))
            at = inner[1] + inner[0]
    return total if useful else 0


def _runs(text: str, start: int) -> Iterator[tuple[int, int]]:
    """Runs of base64 from ``start``, with nothing but gaps between them."""
    while run := _RUN.match(text, start):
        yield run.span()
        gap = _GAP.match(text, run.end())
        if gap is None:
            return
        start = gap.end()


def _body(text: str, start: int, size: int) -> tuple[bytes | None, int]:
    """What ``size`` characters of base64 from ``start`` decode to, gaps left out,
    and where they end with their padding. None if there are fewer, or if base64
    goes on behind them without a gap."""
    parts, left = [], size
    for a, b in _runs(text, start) if size <= len(text) - start else ():
        end = min(b, a + left)
        parts.append(text[a:end])
        left -= end - a
        if left:
            continue
        if _GOES_ON.match(text, end):
            break
        for _ in range(-size % 4):
            end += text[end : end + 1] == "="
        return _decoded("".join(parts)), end
    return None, 0


def _characters(size: int) -> int:
    return -(-size * 8 // 6)


def _der_end(text: str, start: int) -> int:
    """Where the DER sequence ends whose base64 begins at ``start``, or 0. Its own
    length says how much of the text belongs to it."""
    head = _decoded(text[start : start + 8])
    length = _der_length(head, 1) if head else None
    if length is None:
        return 0
    data, end = _body(text, start, _characters(sum(length)))
    return end if data and der_size(data) == sum(length) == len(data) else 0


def _ssh_end(text: str, start: int) -> int:
    """The same of an SSH key, whose fields say how long they are: a private key
    ends with its secret part, a public one with the last field that ends where
    its base64 does."""
    parts, size, ends = [], 0, []
    for a, b in _runs(text, start):
        parts.append(text[a:b])
        size += b - a
        if size > _SSH_MOST:
            break
    whole = "".join(parts)[:_SSH_MOST]
    data = _decoded(whole[: len(whole) // 4 * 4]) or b""
    private = data.startswith(_OPENSSH)
    at = len(_OPENSSH) if private else 0
    cipher, known, field = b"", 0, 0
    while field < 16:
        # Behind cipher, derivation and its options: how many public keys follow.
        if private and field == 3:
            known, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + size > len(data) + 2:
            break
        if not field and private:
            cipher = data[at + 4 : at + 4 + size]
        at, field = at + 4 + size, field + 1
        if not private:
            ends.append(at)
        elif field == 4 + known:
            ends.append(at + 16 * (b"gcm" in cipher or b"poly1305" in cipher))
            break
    for size in reversed(ends):
        data, end = _body(text, start, _characters(size))
        if data and is_ssh_key(data):
            return end
    return 0


def is_ssh_key(data: bytes) -> bool:
    """Length-prefixed fields: the first a key type, the rest up to the end."""
    private = data.startswith(_OPENSSH)
    at, fields = len(_OPENSSH) if private else 0, []
    while at + 4 <= len(data) and len(fields) < 16:
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
        if private and len(fields) == 3:
            break
    if private:
        return len(fields) == 3 and all(re.fullmatch(rb"[a-z0-9@.-]+", f) for f in fields[:2])
    known = fields and re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+", fields[0])
    return bool(known) and len(fields) >= 2 and at == len(data)


def _der_hex_end(text: str, start: int) -> int:
    """As ``_der_end``, of a sequence written in hex digits."""
    length = _der_length(bytes.fromhex(text[start : start + 12]), 1)
    end = start + 2 * sum(length) if length else 0
    if not start < end <= len(text) or not _HEX_ONLY.fullmatch(text, start, end):
        return 0
    return end if 2 * der_size(bytes.fromhex(text[start:end])) == end - start else 0


def _confirmed(
    pattern: re.Pattern, text: str, end_of: Callable[[re.Match], int]
) -> Iterator[tuple[re.Match, int]]:
    """Matches with the end that was confirmed for them. Behind a match that is
    not confirmed the search goes on at its next character, since what it covers
    may hold another; a later line of a key may begin like one, so behind a
    confirmed match it goes on at that one's end."""
    at = 0
    while m := pattern.search(text, at):
        end = end_of(m)
        at = end or m.start() + 1
        if end:
            yield m, end


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the kinds that have to decode. A key ends where its own lengths
    say so, on whatever line that is; an SSH key that breaks off before is tried
    whole, then its first line alone."""
    found = []
    if "." in text:
        for m, end in _confirmed(TOKEN, text, lambda m: m.end() if is_token(m.group()) else 0):
            found.append(("token", m.start(), end))
    if "M" in text:
        for m, end in _confirmed(DER, text, lambda m: _der_end(text, m.start())):
            found.append(("key", m.start(), end))
    if "30" in text:
        for m, end in _confirmed(DER_HEX, text, lambda m: _der_hex_end(text, m.start())):
            found.append(("key", m.start(), end))
    if "AAAA" in text or "b3BlbnNzaC1rZXktdjEA" in text:
        for m in SSH.finditer(text):
            if stop := _ssh_end(text, m.start()):
                found.append(("ssh", m.start(), stop))
                continue
            for part in _whole_and_first_line(m.group()):
                data = _decoded(part)
                if data and is_ssh_key(data):
                    found.append(("ssh", m.start(), m.start() + len(part)))
                    break
    return found


def _whole_and_first_line(candidate: str) -> list[str]:
    first = candidate.split(maxsplit=1)[0]
    return [candidate] if first == candidate else [candidate, first]


def spans_text(spans: list[tuple[str, int, int]]) -> str:
    spans = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by the mark."""
    parts, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


_FOUND = (
    "n_assign long, n_access long, n_hex long, n_confirmed long,"
    " base_sha256 string, spans string, clean_text string"
)


def secret_scan(docs: DataFrame, text: str, keep: list[str], redact: bool = False) -> DataFrame:
    """The columns ``keep`` of every row with what its text holds.

    n_assign, n_access, n_hex and n_confirmed count spans; ``spans`` lists all
    as kind:start:end in code points, end exclusive, by start and kind;
    ``base_sha256`` is of the first three kinds listed that way. ``clean_text``
    has secrets replaced if ``redact``, else it is null. A null text has no
    spans, stays null and counts as empty. Rows are independent: one text is
    looked at whole, in one task, and nothing is shuffled.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            for value in batch.column(batch.num_columns - 1):
                value = value.as_py()
                base = base_spans(value or "")
                more = confirmed_spans(value or "")
                kinds = [s[0] for s in base]
                digest = hashlib.sha256(spans_text(base).encode()).hexdigest()
                clean = None
                if redact and value is not None:
                    clean = redacted(value, base + more) if base or more else value
                row = [
                    *[kinds.count(k) for k in KINDS[:3]],
                    len(more),
                    digest,
                    spans_text(base + more),
                    clean,
                ]
                for column, x in zip(columns, row):
                    column.append(x)
            types = [pa.int64()] * 4 + [pa.string()] * 3
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *arrays],
                [*kept, *names],
            )

    kept, names = list(keep), [f.split()[0] for f in _FOUND.split(",")]
    docs = docs.select(*kept, F.col(text).alias("_text"))
    schema = docs.drop("_text").schema
    for field in _FOUND.split(","):
        name, kind = field.split()
        schema = schema.add(name, kind)
    return docs.mapInArrow(scan, schema)

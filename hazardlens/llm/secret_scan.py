"""Secret scan with structural confirmation.

The base patterns (assignments, access keys, long hex) report what they match.
Beyond them, a run of base64 or hex digits is only a candidate: it is decoded
and reported if its structure confirms a secret —

* ``jwt``: three base64url segments whose first decodes to a JSON object with a
  string ``alg`` and whose second decodes to a JSON object;
* ``der``: a DER SEQUENCE whose nested lengths add up exactly and whose content
  is a private key (PKCS#1, PKCS#8, SEC1 EC or encrypted PKCS#8);
* ``ssh``: the OpenSSH private-key container, its nested lengths followed
  through cipher, KDF and public keys to the private block.

Base64 and hex digits may be wrapped over lines: indented, quoted, in comments,
with blanks at the ends of lines, the breaks real or escaped (``\\n``). Hex may
also come as single bytes (``30:82``, ``0x30, 0x82``, ``\\x30\\x82``). A run that
decodes to plain text (a whole PEM in base64 or hex, say) is scanned once more
inside. Every text is scanned whole, in one map over the documents; nothing is
shuffled or gathered. Each run of digits is decoded once per alignment and its
keys are followed in place by their lengths, so the time grows with the text.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import sliced

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "der", "ssh")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
MIN_CANDIDATE = 32    # base64 digits, on all lines together; private keys are longer
MIN_NESTED = 48       # digits on the first line of a run that may be an encoded text

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX_LONG = re.compile(rf"[0-9a-f]{{{MIN_HEX},}}")     # the same runs, as runs are maximal
# Between the lines of a candidate: line breaks with blanks, quotes and marks of comments and lists about them.
# Every part is possessive, so nothing is tried twice.
_MARKS = r"""(?:[ \t"'`,;()#*>|]|\\(?=[ \t]*+[\r\n])|\+(?=[ \t]*+[\r\n"'`])|(?://++|--++)(?=[ \t]))*+"""
_BREAK = rf"{_MARKS}(?:(?:[\r\n]|\\++[nr]){_MARKS})++"
_HEX, _STANDARD, _URL_SAFE = "0-9A-Fa-f", "A-Za-z0-9+/", "A-Za-z0-9_-"


def _start(digits: str) -> str:
    """Where a run of digits begins; the letter of an escaped blank is none of them."""
    return rf"(?:(?<![{digits}])|(?<=\\[nrt]))"


_JWT = re.compile(rf"{_start(_URL_SAFE)}(?=([{_URL_SAFE}]+)\.([{_URL_SAFE}]+)\.([{_URL_SAFE}]*))")
# how a DER sequence with a definite length and an OpenSSH container begin
_BASE64_HEAD, _HEX_HEAD = r"(?:M(?:[A-H][A-Za-z0-9+/_-]|I[E-T])|b3B)", r"(?:30(?:[0-7][0-9A-Fa-f]|8[1-4])|6[Ff]70)"
_PAIR = f"[{_HEX}]{{2}}(?![{_HEX}])"      # one byte of hex standing alone, and what may come before the next
_PAIR_GAP = rf"[ \t]*+[:,]?+(?:{_BREAK})?+[ \t]*+(?:0x|\\x)?+"
# where a candidate begins, its digits on a line, what joins two lines, bits a digit, digits that it needs
_RUNS = [(re.compile(f"{_start(d)}(?={head}|[{d}]{{{MIN_NESTED}}})"), re.compile(f"[{d}]+"), re.compile(f"{_BREAK}(?=[{d}])"), per, least)
         for d, head, per, least in ((_STANDARD, _BASE64_HEAD, 6, MIN_CANDIDATE), (_URL_SAFE, _BASE64_HEAD, 6, MIN_CANDIDATE),
                                     (_HEX, _HEX_HEAD, 4, 2 * MIN_CANDIDATE))]
_RUNS.append((re.compile(f"(?<![{_HEX}])(?=(?:30(?![{_HEX}]){_PAIR_GAP}(?:[0-7][{_HEX}]|8[1-4])|6[Ff](?![{_HEX}]){_PAIR_GAP}70)(?![{_HEX}]))"),
              re.compile(_PAIR), re.compile(f"{_PAIR_GAP}(?={_PAIR})"), 4, 2 * MIN_CANDIDATE))
_PLAIN = re.compile(rb"[\t\n\r\x20-\x7e]+")
_MAGIC = b"openssh-key-v1\0"
_PADDING = re.compile("={0,2}")


def _b64(text: str) -> bytes | None:
    """Decoded standard or URL-safe base64, padding optional; digits that fill
    no byte at the end of a longer run are ignored; None if malformed."""
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    if len(text) % 4 == 1:
        text = text[:-1]
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except binascii.Error:
        return None


class _Decoded:
    """The bytes of a run from digit ``first`` on, with what the scan knows of them."""

    def __init__(self, digits: str, first: int, per: int):
        self.first, self.per = first, per
        text = digits[first:]
        self.data = (_b64(text) or b"") if per == 6 else bytes.fromhex(text[:len(text) // 2 * 2])
        self.fields: dict[int, int] = {}    # see openssh_key
        self.read = 0                       # up to where nested text has been scanned

    def byte(self, digit: int) -> int:
        return (digit - self.first) * self.per // 8

    def digits(self, at: int, end: int) -> tuple[int, int]:
        """First digit and end of the digits that hold the bytes ``[at, end)``."""
        return self.first + at * 8 // self.per, self.first + -(-end * 8 // self.per)


class _Run:
    """The digits from a place on, joined over line breaks."""

    def __init__(self, text: str, at: int, line: re.Pattern, between: re.Pattern, per: int):
        lines, self.starts, self.before, size = [], [], [], 0
        while True:
            got = line.match(text, at)
            lines.append(got.group())
            self.starts.append(at)
            self.before.append(size)
            size += len(lines[-1])
            self.end = got.end()
            if not (gap := between.match(text, self.end)):
                break
            at = gap.end()
        self.text, self.per = "".join(lines), per
        self.aligned: dict[int, _Decoded] = {}

    def index(self, at: int) -> int:
        """Number of the digit at a place of the text."""
        i = bisect_right(self.starts, at) - 1
        return self.before[i] + at - self.starts[i]

    def span(self, start: int, end: int) -> tuple[int, int]:
        """Places in the text of the digits ``[start, end)``."""
        i, j = bisect_right(self.before, start) - 1, bisect_left(self.before, end) - 1
        return self.starts[i] + start - self.before[i], self.starts[j] + end - self.before[j]

    def decoded(self, digit: int) -> _Decoded:
        """The run's bytes, decoded once for all digits aligned like this one."""
        first = digit % (4 if self.per == 6 else 2)
        if first not in self.aligned:
            self.aligned[first] = _Decoded(self.text, first, self.per)
        return self.aligned[first]


def _json_object(segment: str) -> dict | None:
    raw = _b64(segment)
    try:
        got = json.loads(raw) if raw else None
    except (ValueError, RecursionError):
        return None
    return got if isinstance(got, dict) else None


def is_signed_token(header: str, payload: str) -> bool:
    head = _json_object(header)
    return bool(head) and isinstance(head.get("alg"), str) and _json_object(payload) is not None


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, content start and content end of the DER element at ``at``."""
    if at + 2 > end:
        return None
    tag, n = data[at], data[at + 1]
    at += 2
    if n & 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > end or data[at] == 0:
            return None
        n = int.from_bytes(data[at:at + size], "big")
        at += size
        if n < 0x80:
            return None
    return (tag, at, at + n) if at + n <= end else None


def _children(data: bytes, at: int, end: int, most: int) -> list[tuple[int, int, int]] | None:
    """The elements, up to ``most``, that fill ``[at, end)`` exactly, else None."""
    out = []
    while at < end:
        got = _tlv(data, at, end)
        if got is None or len(out) == most:
            return None
        out.append(got)
        at = got[2]
    return out


def private_key_der(data: bytes, at: int = 0) -> int:
    """Length of the DER private key that begins at ``at``, else 0: its nested
    lengths add up, and its tags are those of PKCS#1 (at most 10 elements),
    PKCS#8, SEC1 or encrypted PKCS#8. Only the elements' heads are read."""
    top = _tlv(data, at, len(data))
    if top is None or top[0] != 0x30:
        return 0
    parts = _children(data, top[1], top[2], 10)
    if not parts:
        return 0
    tags, size = [p[0] for p in parts], top[2] - at

    def names_algorithm(part) -> bool:
        inside = _children(data, part[1], part[2], 10)
        return bool(inside) and inside[0][0] == 0x06

    if tags == [0x30, 0x04]:                                    # EncryptedPrivateKeyInfo
        return size if names_algorithm(parts[0]) else 0
    if tags[0] != 0x02:
        return 0
    number = data[parts[0][1]:min(parts[0][2], parts[0][1] + 2)]   # a version fills one byte
    version = number[0] if parts[0][2] - parts[0][1] == 1 else -1
    ok = tags[:9] == [0x02] * 9 and version in (0, 1)           # PKCS#1 RSA
    if tags[:3] == [0x02, 0x30, 0x04] and version in (0, 1):    # PKCS#8
        ok = names_algorithm(parts[1])
    if tags[:2] == [0x02, 0x04] and version == 1:               # SEC1
        ok = all(t in (0xA0, 0xA1) for t in tags[2:])
    return size if ok else 0


def openssh_key(data: bytes, at: int = 0, known: dict[int, int] | None = None) -> int:
    """Length of the OpenSSH private-key container that begins at ``at``, else 0.

    ``known`` is kept between calls over the same data: how many whole fields
    follow a place up to a malformed one, so no failed chain is followed twice.
    """
    if not data.startswith(_MAGIC, at):
        return 0

    def field(at: int) -> int:
        """Where the field at ``at`` ends; 0 if it is not whole."""
        end = at + 4 + int.from_bytes(data[at:at + 4], "big")
        return end if end <= len(data) else 0

    known = {} if known is None else known
    start, at = at, at + len(_MAGIC)
    for _ in range(3):                                          # cipher, KDF, KDF options
        if not (at := field(at)):
            return 0
    keys = int.from_bytes(data[at:at + 4], "big")
    if not keys:
        return 0
    at, chain = at + 4, []
    for left in range(keys + 1, 0, -1):                         # public keys, the private block
        if known.get(at, left) < left:
            break
        end = field(at)
        if end <= at + 4:
            known[at] = 0
            break
        chain.append(at)
        at = end
    else:
        return at - start
    good = known[at]
    for place in reversed(chain):
        good += 1
        known[place] = good
    return 0


def _key(decoded: _Decoded, at: int) -> tuple[str, int] | None:
    """Kind and length in bytes of the key that begins at byte ``at``."""
    if n := private_key_der(decoded.data, at):
        return "der", n
    return ("ssh", n) if (n := openssh_key(decoded.data, at, decoded.fields)) else None


def _candidates(text: str, nested: bool = True) -> list[tuple[str, int, int]]:
    """Spans of decoded candidates whose structure is confirmed. A run may go on
    past the key; the span ends with the key's own digits and padding. With
    ``nested``, runs that decode to plain text are scanned inside, and a find
    there is the span of its digits."""
    out, end = [], 0
    for m in _JWT.finditer(text):
        if m.start() >= end and is_signed_token(m.group(1), m.group(2)):
            end = m.end(3)
            out.append(("jwt", m.start(), end))
    for heads, line, between, per, least in _RUNS:
        run, end = None, 0
        for m in heads.finditer(text):
            if m.start() < end:                                 # inside a key already found
                continue
            if run is None or m.start() >= run.end:
                run = _Run(text, m.start(), line, between, per)
            digit = run.index(m.start())
            if len(run.text) - digit < least:
                continue
            decoded = run.decoded(digit)
            at = decoded.byte(digit)
            if got := _key(decoded, at):
                start, end = run.span(*decoded.digits(at, at + got[1]))
                end = _PADDING.match(text, end).end() if per == 6 else end
                out.append((got[0], start, end))
            elif nested and at >= decoded.read and (plain := _PLAIN.match(decoded.data, at)):
                decoded.read = plain.end()
                for kind, i, j in _candidates(plain.group().decode("ascii"), nested=False):
                    out.append((kind, *run.span(*decoded.digits(at + i, at + j))))
    return out


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans ``(kind, start, end)`` by start, then kind as in ``KINDS``;
    positions count code points, ends are exclusive."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGN]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [("hex", *m.span()) for m in _HEX_LONG.finditer(text)]
    out += _candidates(text)
    return sorted(set(out), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``secrets``: array of (kind, start, end), per input row.

    Null or empty text has no secrets. Spans of different kinds may overlap;
    within the base kinds they do not. Repeated rows give repeated results;
    other columns are ignored, whatever their names; an empty table gives no
    rows.
    """
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))

    def run(batches):
        for b in sliced(batches):
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in scan(x)] if x else []
                     for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(found, _SPANS)], names=["doc_id", "secrets"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, secrets array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span (overlapping ones as one) replaced by
    ``mark``; all other columns and all texts without secrets stay as they are."""
    at = docs.columns.index(text_col)

    def clean(text):
        spans = scan(text) if text else []
        if not spans:
            return text
        out, end = [], 0
        for _, i, j in spans:
            if i >= end:
                out += [text[end:i], mark]
            end = max(end, j)
        return "".join(out) + text[end:]

    def run(batches):
        for b in sliced(batches):
            texts = pa.array([clean(x) for x in b.column(at).to_pylist()], b.schema.field(at).type)
            yield b.set_column(at, b.schema.field(at), texts)

    return docs.mapInArrow(run, docs.schema)


def digest(spans, kinds: tuple[str, ...] | None = None):
    """Spans as ``kind:start:end``, comma-joined, optionally only of some kinds."""
    some = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

"""Secret scans: patterns name candidates, and the structure inside them confirms more.

Base kinds (assign, access, hex) are reported by pattern alone. The structural kinds decode what they find first: PEM and bare base64 or hex
keys must parse as nested DER lengths that fill the data, with the fields of a private key, public-key lines as length-prefixed fields beginning with their own algorithm,
and signed tokens as JSON headers that name an algorithm. Fast byte-class searches pick the texts that need the patterns.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lakekit.llm.common import fresh

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "pem", "der", "hexkey", "sshkey", "jwt")

_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_LONG_HEX = re.compile(r"[0-9a-f]{32,}")
_PEM_EDGE = re.compile(r"-----(BEGIN|END) (?:[A-Z0-9]+ )*PRIVATE KEY-----", re.ASCII)
_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----([A-Za-z0-9+/=\s:,\\-]*?)-----END \1-----", re.ASCII)
# Whole runs of the alphabet; decoding decides. The letter of a written-out \n before a key is not part of its run.
_BASE64 = re.compile(r"(?:(?<![A-Za-z0-9+/\\])|(?<=\\)(?![nrt])|(?<=\\[nrt]))[A-Za-z0-9+/]{64,}={0,2}")
_HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{62,}(?![0-9A-Fa-f])")
_SSH = re.compile(r"(?<![A-Za-z0-9-])(ssh-rsa|ssh-dss|ssh-ed25519|ecdsa-sha2-nistp\d+) ([A-Za-z0-9+/]{40,}={0,2})", re.ASCII)
_JWT = re.compile(r"(?:(?<![A-Za-z0-9_.-])|(?<=\\[nrt]))(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)(?!\.*[A-Za-z0-9_-])")

#: What a text must hold, in RE2, before a kind's pattern runs over it.
_SIGNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]""",
    "access": r"AKIA[A-Z0-9]{12}",
    "hex": r"[0-9a-f]{32}",
    "pem": r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----",
    "der": r"[A-Za-z0-9+/]{64}",
    "hexkey": r"30[0-9A-Fa-f]{62}",
    "sshkey": r"(?:ssh-|ecdsa-sha2-)[a-z0-9]+ AAAA",
    "jwt": r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]",
}


def der_fills(data: bytes, depth: int = 0) -> bool:
    """Whether `data` is a run of DER values whose nested lengths all fit, with a sequence at the top."""
    at, top = 0, depth == 0
    if depth > 16 or not data:
        return not data and not top
    while at < len(data):
        if at + 2 > len(data):
            return False
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            more = size & 0x7F
            if not 1 <= more <= 4 or at + more > len(data):
                return False
            size = int.from_bytes(data[at : at + more], "big")
            at += more
        if at + size > len(data) or (top and (tag != 0x30 or at + size != len(data))):
            return False
        if tag & 0x20 and not der_fills(data[at : at + size], depth + 1):
            return False
        at += size
    return True


def der_values(data: bytes) -> list[tuple[int, bytes]]:
    """(tag, content) of each value of a run of DER values that `der_fills`."""
    out, at = [], 0
    while at < len(data):
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            more = size & 0x7F
            size = int.from_bytes(data[at : at + more], "big")
            at += more
        out.append((tag, data[at : at + size]))
        at += size
    return out


def is_key(data: bytes) -> bool:
    """A private key in DER: a sequence that fills the data and begins with a version of 0 to 3 before other fields, or that is an
    algorithm and the octets it encrypts. Public keys (an algorithm and bits, or a modulus and exponent) and certificates are neither."""
    if len(data) < 32 or data[0] != 0x30 or not der_fills(data):
        return False
    ((_, body),) = der_values(data)
    inner = der_values(body)
    if len(inner) < 2:
        return False
    (tag, first), (second, _) = inner[:2]
    if tag == 0x02:
        return len(first) == 1 and first[0] <= 3
    return tag == 0x30 and first[:1] == b"\x06" and second == 0x04 and len(inner) == 2


_OPENSSH = b"openssh-key-v1\0"


def is_openssh_key(data: bytes) -> bool:
    """An OpenSSH private key: cipher, kdf and its options, a number of keys, a public field for each and one private field, which end
    where the data does; if it is not encrypted, the private field begins with the same four bytes twice."""
    at, found, left = len(_OPENSSH), [], 3
    if not data.startswith(_OPENSSH):
        return False
    while left:
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return False
        found.append(data[at + 4 : at + 4 + size])
        at, left = at + 4 + size, left - 1
        if len(found) == 3:
            keys = int.from_bytes(data[at : at + 4], "big")
            if at + 4 > len(data) or not 1 <= keys <= len(data) // 4:
                return False
            at, left = at + 4, keys + 1
    private = found[-1]
    return at == len(data) and len(private) >= 8 and (found[0] != b"none" or private[:4] == private[4:8])


def fields(data: bytes) -> list[bytes] | None:
    """The fields of length-prefixed data, if they fill it."""
    out, at = [], 0
    while at < len(data):
        if at + 4 > len(data):
            return None
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + size > len(data):
            return None
        out.append(data[at : at + size])
        at += size
    return out


def _decode(text: str, url: bool = False) -> bytes:
    text = "".join(text.split()).rstrip("=")
    text = text.replace("-", "+").replace("_", "/") if url else text
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def _pem_blocks(text: str):
    """Matches of _PEM from each BEGIN line to an END line that comes before any other BEGIN; one pass over the edges."""
    begin = None
    for edge in _PEM_EDGE.finditer(text):
        if edge[1] == "BEGIN":
            begin = edge
        elif begin:
            if m := _PEM.fullmatch(text, begin.start(), edge.end()):
                yield m
            begin = None


def _pem(m: re.Match) -> bool:
    body = re.sub(r"\\+(?:[nrt]|(?=\s))", "\n", m[2]).replace("\\", "")  # written-out line ends, and \/
    body = re.sub(r"(?m)^[A-Za-z0-9-]+:.*$", "", body)  # encryption headers
    data = _decode(body)
    return is_key(data) or is_openssh_key(data) or ("ENCRYPTED" in m[2] and len(data) >= 32)


def _ssh(m: re.Match) -> bool:
    parts = fields(_decode(m[2]))
    return bool(parts) and parts[0] == m[1].encode() and len(parts) >= 2


def _jwt(m: re.Match) -> bool:
    try:
        header, body = (json.loads(_decode(part, url=True) or b"x") for part in (m[1], m[2]))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(body, dict) and len(_decode(m[3], url=True)) >= 16


#: Kind, matches in a text, test of a match.
_RULES = (
    ("assign", _ASSIGN.finditer, lambda m: len(m[2]) >= 8),
    ("access", _ACCESS.finditer, lambda m: len(m[0]) >= 16),
    ("hex", _LONG_HEX.finditer, lambda m: True),  # a run of 32 or more is the whole run: shorter ones fail
    ("pem", _pem_blocks, _pem),
    ("der", _BASE64.finditer, lambda m: is_key(_decode(m[0]))),
    ("hexkey", _HEX_KEY.finditer, lambda m: len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0]))),
    ("sshkey", _SSH.finditer, _ssh),
    ("jwt", _JWT.finditer, _jwt),
)


def secret_spans(text: str, kinds=KINDS) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of each confirmed span, sorted; positions count code points."""
    found = []
    for kind, matches, test in _RULES:
        if kind in kinds:
            found += [(m.start(), KINDS.index(kind), m.end()) for m in matches(text) if test(m)]
    return sorted(found)


def _join(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(text: str, names: list[str]):
    def run(batches):
        for batch in batches:
            column = batch.column(text).cast(pa.large_string()).fill_null("")
            signs = {k: np.asarray(pc.match_substring_regex(column, s).fill_null(False)) for k, s in _SIGNS.items()}
            n = batch.num_rows
            counts = {k: np.zeros(n, np.int64) for k in BASE}
            base, spans = [""] * n, [""] * n
            for i in np.flatnonzero(np.logical_or.reduce(list(signs.values()))).tolist():
                found = secret_spans(column[i].as_py(), [k for k in KINDS if signs[k][i]])
                own = [s for s in found if KINDS[s[1]] in BASE]
                for s in own:
                    counts[KINDS[s[1]]][i] += 1
                base[i], spans[i] = _join(own), _join(found)
            columns = {c: batch.column(c) for c in batch.schema.names}
            values = (*(counts[k] for k in BASE), pa.array(base), pa.array(spans))
            yield pa.record_batch(columns | dict(zip(names, values)))

    return run


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each row of `docs` with n_assign, n_access, n_hex, base_spans and spans.

    Spans are written kind:start:end (code points, end exclusive), sorted by start, then kind as in KINDS, joined by commas.
    Null texts count as empty and have none. Matches of one kind do not overlap; different kinds may. Extra columns pass
    through; the new names get a suffix where `docs` has them.
    """
    names = fresh(docs, "n_assign", "n_access", "n_hex", "base_spans", "spans")
    kind = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields])
    kind += f", {names[0]} long, {names[1]} long, {names[2]} long, {names[3]} string, {names[4]} string"
    return docs.mapInArrow(_scan(text, names), kind)

"""Secrets in text: assignments, access keys, hex runs, and candidates confirmed by structure.

A base64 or hex candidate is reported only if what it decodes to has the structure of a key:
nested DER lengths that fill the value exactly with the fields of a private key, the container
of an OpenSSH key, a PEM body that holds either, or a signed token whose header names its
algorithm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import struct
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import id_and_text, per_batch, texts

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "pem_key", "der_key", "openssh_key", "signed_token")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: A key in armour: its label, header lines as of RFC 1421 if any, and the body. Line breaks may be escaped.
PEM = re.compile(
    r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----(?:\s|\\[rn])*+((?:[A-Za-z][A-Za-z0-9-]*+: ?[A-Za-z0-9,=+/.-]*+(?:\s|\\[rn])++)*+)"
    r"([A-Za-z0-9+/=\s\\rn]*?)-----END \1-----"
)
DEK_INFO = re.compile(r"DEK-Info: ?[A-Z0-9-]+,((?:[0-9A-Fa-f]{2}){8,})(?![0-9A-Fa-f])")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
#: A DER sequence starts with byte 0x30 and an OpenSSH key with its magic: M, 30 and b3Blb in text.
BASE64 = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[rn]))(?:M[A-Za-z0-9+/_-]{39,}|b3Blb[A-Za-z0-9+/_-]{35,})={0,2}(?![A-Za-z0-9+/_=-])")
HEX_DER = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{62,}(?![0-9A-Fa-f])")

SEQUENCE, INTEGER, OCTETS, OBJECT_ID = 0x30, 0x02, 0x04, 0x06
OPENSSH_MAGIC = b"openssh-key-v1\x00"


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, end exclusive, by start and then kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    found += confirmed(text)
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def confirmed(text: str) -> list[tuple[str, int, int]]:
    """Candidates whose decoded form has the structure of a key or signed token."""
    found = []
    if "PRIVATE KEY-----" in text:
        for m in PEM.finditer(text):
            body = _base64(re.sub(r"\s|\\[rn]", "", m[3]))
            locked = "Proc-Type: 4,ENCRYPTED" in m[2] and DEK_INFO.search(m[2]) and body
            if locked or key_kind(body) or m[1].startswith("ENCRYPTED") and is_nested_der(body):
                found.append(("pem_key", *m.span()))
    if "eyJ" in text:
        found += [("signed_token", *m.span()) for m in TOKEN.finditer(text) if is_token_header(m[1])]
    for m in BASE64.finditer(text):
        if kind := key_kind(_base64(m[0])):
            found.append((kind, *m.span()))
    if "30" in text:
        for m in HEX_DER.finditer(text):
            if len(m[0]) % 2 == 0 and (kind := key_kind(bytes.fromhex(m[0]))):
                found.append((kind, *m.span()))
    return found


def _base64(text: str) -> bytes:
    """The decoded bytes, standard or URL-safe, padded or not; empty if it is not base64."""
    bare = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(bare) % 4 == 1:
        return b""
    try:
        return base64.b64decode(bare + "=" * (-len(bare) % 4), validate=True)
    except binascii.Error:
        return b""


def is_token_header(part: str) -> bool:
    """Whether a token's first part is a JSON object that names its algorithm."""
    try:
        header = json.loads(_base64(part))
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def key_kind(data: bytes) -> str | None:
    """``der_key`` or ``openssh_key`` if the bytes are such a private key."""
    if data.startswith(OPENSSH_MAGIC):
        return "openssh_key" if _is_openssh(data) else None
    return "der_key" if _is_private_der(data) else None


def _is_openssh(data: bytes) -> bool:
    """Three length-prefixed strings, a key count, and that many public keys follow the magic."""
    at = len(OPENSSH_MAGIC)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + struct.unpack_from(">I", data, at)[0]
    if at + 4 > len(data):
        return False
    return 1 <= struct.unpack_from(">I", data, at)[0] <= 64 and at + 8 <= len(data)


def _parts(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of consecutive DER values; None unless they fill ``data`` exactly."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data) or data[at] == 0:
                return None
            size = int.from_bytes(data[at : at + width], "big")
            at += width
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at : at + size]))
        at += size
    return out


def is_nested_der(data: bytes) -> bool:
    """One sequence that fills the bytes, holds two values or more, and nests validly."""
    outer = _parts(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    inner = _parts(outer[0][1])
    return inner is not None and len(inner) >= 2 and all(tag != SEQUENCE or _parts(body) is not None for tag, body in inner)


def _is_private_der(data: bytes) -> bool:
    """PKCS#1 or DSA (nine or six integers), SEC 1 (version 1, octets), or PKCS#8 (version, algorithm, octets)."""
    if not is_nested_der(data):
        return False
    inner = _parts(_parts(data)[0][1])
    tags = [tag for tag, _ in inner]
    if tags[0] != INTEGER or len(inner[0][1]) != 1:
        return False
    version = inner[0][1][0]
    if all(tag == INTEGER for tag in tags):
        return version == 0 and len(tags) in (6, 9)
    if tags[:2] == [INTEGER, OCTETS]:
        return version == 1 and 16 <= len(inner[1][1]) <= 72
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:
        algorithm = _parts(inner[1][1])
        return version in (0, 1) and bool(algorithm) and algorithm[0][0] == OBJECT_ID
    return False


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``, an array of (kind, start, end) for every row of ``docs``.

    Null and empty texts have none. Repeated rows are each scanned; other columns are left
    behind, whatever their names; an empty table gives no rows.
    """
    narrow = id_and_text(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        per_row = [find_spans(t) for t in texts(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), _span_array(per_row)], ["doc_id", "spans"])

    return per_batch(narrow, step, f"doc_id {kind}, spans array<struct<kind:string,start:int,end:int>>", "text")


def _span_array(per_row) -> pa.Array:
    offsets = [0]
    for spans in per_row:
        offsets.append(offsets[-1] + len(spans))
    flat = list(chain.from_iterable(per_row))
    columns = [
        pa.array([s[0] for s in flat], pa.string()),
        pa.array([s[1] for s in flat], pa.int32()),
        pa.array([s[2] for s in flat], pa.int32()),
    ]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, ["kind", "start", "end"]))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the SHA-256 of their list, and the list of all spans."""
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redact(text: str, mark: str = "<SECRET>") -> str:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""
    out, at = [], 0
    for _, start, end in find_spans(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def redact_documents(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", mark: str = "<SECRET>") -> DataFrame:
    """All rows and columns, secrets in ``text_col`` masked; ``length_col``, if there, is counted anew."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(text_col)
        cleaned = [x if x is None else redact(x, mark) for x in column.to_pylist()]
        return batch.set_column(batch.schema.get_field_index(text_col), text_col, pa.array(cleaned, column.type))

    masked = per_batch(docs, step, docs.schema, text_col)
    if length_col in docs.columns:
        masked = masked.withColumn(
            length_col, F.when(F.col(text_col).isNotNull(), F.length(text_col)).cast(docs.schema[length_col].dataType)
        )
    return masked.select(*docs.columns)

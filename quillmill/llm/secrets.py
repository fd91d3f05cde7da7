"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

A subword vocabulary spends few tokens on natural words and many on random strings. A run of key characters whose characters
per token fall to MOST_RATIO or below is reported as `random`, unless it is a known kind of digest or identifier: a digest by
length or by the name before it, a UUID, a number with hardly any letters, or a run with so many separators that it is a date, a
path or a list. If a whole run passes as clean, its parts between separators are tested.
"""

from __future__ import annotations

import hashlib
import re

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.common import append_columns, fresh, table
from quillmill.llm.packing import VOCABULARY, encoding

MOST_RATIO = 2.0  # characters a token: 99 % of random strings of any alphabet have less, words have 2.2 at least
SHORTEST = 20  # characters of a candidate
LETTERS = 3  # a run with fewer is a number
SEPARATORS = 8  # a run in which one character in so many or more is a separator is no key
KINDS = ("assign", "access", "hex", "random")

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
#: Identifiers and digests that look random but are no secrets.
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})")
DIGEST_NAME = re.compile(r"(?:sha(?:1|224|256|384|512)|md5|integrity|checksum|digest|etag)[-:=\s\"']*$", re.IGNORECASE)
DIGEST_RUN = re.compile(r"(?:sha(?:1|224|256|384|512)|md5)[-_=]", re.IGNORECASE)
PART = re.compile(r"[A-Za-z0-9+]{%d,}" % SHORTEST)  # between the separators of paths and names
_separators = re.compile(r"[/=_-]")


def named(text: str, m: re.Match) -> bool:
    """Whether a run is an identifier or a digest."""
    return bool(UUID.fullmatch(m.group()) or DIGEST.fullmatch(m.group()) or DIGEST_RUN.match(m.group()) or DIGEST_NAME.search(text, max(0, m.start() - 16), m.start()))


def random_run(run: str, encode, most_ratio: float) -> bool:
    """Whether the vocabulary spends a token on `most_ratio` characters of run or fewer, and run can be a key at all."""
    if sum(map(str.isalpha, run)) < LETTERS or SEPARATORS * len(_separators.findall(run.rstrip("="))) >= len(run):
        return False
    return len(run) <= most_ratio * len(encode(run))


def spans(text: str | None, encode, most_ratio: float = MOST_RATIO) -> list[tuple[int, int, int]]:
    """(start, end, kind) of all matches by start, then kind; kind is a position in KINDS, offsets are code points."""
    if not text:
        return []
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    for m in CANDIDATE.finditer(text):
        run = m.group()
        if named(text, m):
            continue
        if random_run(run, encode, most_ratio):
            found.append((m.start(), m.end(), 3))
        else:
            found += [(x.start(), x.end(), 3) for x in PART.finditer(text, m.start(), m.end()) if x.group() != run and not named(text, x) and random_run(x.group(), encode, most_ratio)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def label(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in found)


def redact(text: str | None, found: list[tuple[int, int, int]]) -> str | None:
    """text with each run of overlapping spans replaced by [SECRET]; of an assignment the value goes, not the name."""
    if not found:
        return text
    cuts = []
    for a, b, k in found:
        if k == 0:
            a += ASSIGN.match(text, a, b).start(2) - a
        cuts.append((a, b))
    out, at = [], 0
    for a, b in sorted(cuts):
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, most_ratio: float = MOST_RATIO) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans, redacted) for each row of docs.

    Only the two named columns are read. A null or empty text has no spans (its base_sha256 is that of the empty string; a
    null text stays null in redacted). Repeated rows each return a row; a null doc_id stays null; spans of different kinds
    may overlap, and with equal starts go by kind.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def make():
        encode = encoding(path).encode_ordinary

        def run(texts: list) -> list[pa.Array]:
            found = [spans(t, encode, most_ratio) for t in texts]
            counts = [pa.array([sum(k == kind for *_, k in f) for f in found], pa.int64()) for kind in range(4)]
            base = [hashlib.sha256(label([x for x in f if x[2] < 3]).encode()).hexdigest() for f in found]
            return [*counts, pa.array(base, pa.string()), pa.array([label(f) for f in found], pa.string()), pa.array([redact(t, f) for t, f in zip(texts, found, strict=True)], pa.string())]

        return run

    fields = [*((f"n_{k}", T.LongType()) for k in KINDS), ("base_sha256", T.StringType()), ("spans", T.StringType()), ("redacted", T.StringType())]
    return append_columns(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", fields, make).drop("text")


def redact_secrets(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", vocabulary: str | None = None) -> DataFrame:
    """docs with secrets in text replaced, and n_chars (if docs has it and its text changed) counted anew; all rows stay."""
    path, out = vocabulary or public_tokenizers.path(VOCABULARY), fresh(docs, "_redacted")

    def make():
        encode = encoding(path).encode_ordinary
        return lambda texts: [pa.array([redact(t, spans(t, encode)) for t in texts], pa.string())]

    rows = append_columns(docs, text, [(out, T.StringType())], make)
    new = {text: F.col(out)}
    if n_chars in docs.columns:
        new[n_chars] = F.when(F.col(out).eqNullSafe(F.col(text)), F.col(n_chars)).otherwise(F.length(out)).cast(docs.schema[n_chars].dataType)
    return rows.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).drop("redacted")

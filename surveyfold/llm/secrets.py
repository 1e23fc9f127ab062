"""Secret scans: fixed patterns, then a token-efficiency test for random strings.

A tokenizer's vocabulary is made of what text repeats, so ordinary strings take
few tokens and random ones take many. A run of key characters that no base
pattern found is reported as ``random`` when it has at most ``MOST_RATIO``
characters a token, unless it is a known kind of digest or identifier.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, text_or_empty, tidy

# fixed values: the base patterns of the contract (ASCII letters only, whatever
# other letters fold to them)
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "random")

# a text without any of these has no assignment
HINTS = ("passw", "secret", "token", "api")
# the maximal runs of HEX that are long enough: the greedy pattern's own runs
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % LEAST_HEX)

CANDIDATE = re.compile(r"(?<![\w+/-])[A-Za-z0-9+/_-]{16,}={0,2}(?!\w)")
MOST_RATIO = 2.0
DIGEST_HEX = (32, 40, 56, 64, 96, 128)      # MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512
UUID = re.compile(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE | re.ASCII)
ALL_HEX = re.compile(r"[0-9a-f]+", re.IGNORECASE | re.ASCII)


@functools.cache
def encoding(path: str):
    """A tiktoken encoding from a file of base64 tokens and ranks."""
    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, in code points."""
    found = []
    low = text.lower()
    if any(h in low for h in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def known_kind(s: str) -> bool:
    """A digest by its length, a UUID, or a string without a letter (a number, a
    rule of dashes), which is no key."""
    return not any(map(str.isalpha, s)) or bool(UUID.fullmatch(s)) or (len(s) in DIGEST_HEX and bool(ALL_HEX.fullmatch(s)))


def random_spans(text: str, taken: list[tuple[int, int, int]], enc, most_ratio: float) -> list[tuple[int, int, int]]:
    found = []
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        if any(s < b and a < e for s, _, e in taken) or known_kind(m.group()):
            continue
        if (b - a) <= most_ratio * len(enc.encode_ordinary(m.group())):
            found.append((a, 3, b))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, vocabulary: str, most_ratio: float = MOST_RATIO) -> DataFrame:
    """doc_id, counts of the base kinds, hash of the base spans, all spans.

    A null text counts as empty and has no spans (the empty string, and its
    hash). Rows that repeat are scanned each; a null doc_id stays null. An empty
    table gives no rows; other columns are not read.
    """
    schema = "`__at` string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(vocabulary)
        for f in batches:
            counts = np.zeros((len(f), 3), dtype=np.int64)
            digests, spans = [], []
            for row, text in enumerate(f["__text"]):
                base = base_spans(text)
                for _, kind, _ in base:
                    counts[row, kind] += 1
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(sorted(base + random_spans(text, base, enc, most_ratio))))
            yield pd.DataFrame({"__at": f["__at"], "n_assign": counts[:, 0], "n_access": counts[:, 1],
                                "n_hex": counts[:, 2], "base_sha256": digests, "spans": spans})

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select(F.to_json(F.struct("doc_id")).alias("__at"), text_or_empty().alias("__text")).mapInPandas(run, schema)
    return out.select(F.from_json("__at", f"doc_id {kind}")["doc_id"].alias("doc_id"),
                      "n_assign", "n_access", "n_hex", "base_sha256", "spans")

"""Secret scans: a keyword automaton finds where a secret may begin, anchored expressions run there alone."""

from __future__ import annotations

import re
import zlib

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from .common import documents, map_chunks, small_batches

#: What is looked for. The order of kinds decides among spans with the same start.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE = KINDS[:3]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
SIGNED = {"github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"), "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")}
KEYWORDS = {"password": "assign", "passwd": "assign", "secret": "assign", "token": "assign", "apikey": "assign", "api_key": "assign", "akia": "access"} | {f"gh{c}_": "github" for c in "pousr"} | {"npm_": "npm"}
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
GRID, HEX_LEAST = 8, 32
HEX, HEX_GRID = re.compile(f"[0-9a-f]{{{HEX_LEAST},}}"), re.compile(f"[0-9a-f]{{{HEX_LEAST // GRID},}}")


def checksum(body: str) -> str:
    """The six characters that signed tokens end with: CRC-32 of the body in base 62."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = DIGITS[d] + out
    return out


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """A-Z in lower case; the length stays, unlike that of ``str.lower``."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def hex_runs(text: str) -> list[tuple[int, int]]:
    """Runs of hexadecimal digits of the least length. A run covers neighbours on a coarse grid, so only near those is it looked for."""
    out = []
    for m in HEX_GRID.finditer(text[::GRID]):
        low, high = max(0, GRID * (m.start() - 1) + 1), GRID * m.end()
        out += [run.span() for run in HEX.finditer(text, low, high)]
    return out


def scan(text: str, hits: ahocorasick.Automaton) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all secrets, in order. Leftmost and not overlapping within a kind."""
    starts: dict[str, set[int]] = {}
    for last, (kind, n) in hits.iter(lowered(text)):
        starts.setdefault(kind, set()).add(last + 1 - n)
    out = [(a, "hex", b) for a, b in hex_runs(text)]
    for kind, places in starts.items():
        done = 0
        for at in sorted(places):
            if at < done:
                continue
            if kind == "assign":
                if m := ASSIGN.match(text, at):
                    done = m.end()
                    if len(m[2]) >= 8:
                        out.append((at, kind, done))
            elif kind == "access":
                if m := ACCESS.match(text, at):
                    done = m.end()
                    if done - at >= 16:
                        out.append((at, kind, done))
            elif (m := SIGNED[kind].match(text, at)) and checksum(m[1]) == m[2]:
                done = m.end()
                out.append((at, kind, done))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[1])))


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans: kind, start and end (exclusive) in code points, by start and then kind.

    Kinds beyond the base ones count only if their embedded checksum holds. A null or empty text
    has no spans. Repeated rows are answered once each.
    """

    def make():
        hits = automaton()

        def one(batch):
            return [batch.column(0), [[{"kind": k, "start": a, "end": b} for a, k, b in scan(t, hits)] for t in batch.column(1).to_pylist()]]

        return one

    return map_chunks(documents(df, id_col, text_col), make, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def cover(text: str, spans: list[tuple[int, str, int]], mark: str) -> str:
    out, done = [], 0
    for start, _, end in spans:
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every secret of its text column replaced; overlapping spans by one mark. Null texts stay null."""

    @pandas_udf(StringType())
    def covered(texts: pd.Series) -> pd.Series:
        hits = automaton()
        return pd.Series([None if t is None else cover(t, scan(t, hits), mark) for t in texts], dtype=object)

    small_batches(df.sparkSession)
    return df.withColumn(text_col, covered(F.col(text_col)))

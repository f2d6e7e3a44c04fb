"""Operator 1: secret scan with dictionary-primed zstandard novelty.

Base spans come from three fixed patterns (kinds assign, access, hex).  The
method adds spans of kind ``novel``: a string of 16 or more key characters that
begins within the 48 characters behind a sensitive word is compressed with zstandard
behind the text before it, under a dictionary of usual identifiers.  The bytes
by which it lengthens the compressed text are its novelty; natural words and
repeats of the text cost little, random keys cost about their entropy.  Strings
of mixed characters that overlap no base span are reported when they cost at
least ``NOVEL`` bytes per character, or that share of what random strings of
their alphabet and length cost in the same place.  A string that was reported
once in a text, or that ends a base span of it, is reported wherever it has a
sensitive context; a first copy without one makes the next compressible.  A sensitive word
may lie in a run of key characters itself, as in auth=KEY; what follows the word
and its separator is then judged by itself, up to the next such word.

Spans are in code points, end exclusive.  A null text is an empty one and has
no spans; doc_id may be null; repeated rows give repeated rows.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import texts as T

# The patterns and least lengths that define base spans.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_VALUE, MIN_ACCESS = 12, 18

#: A run of key characters, and the sensitive words that make it a candidate.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SENSITIVE = re.compile(r"pass(?:word|wd|phrase)?\b|pwd|secret|token|api[_-]?key|credential|bearer|private[_ -]?key|auth|signature", re.I | re.A)
BEFORE, AROUND = 48, 256
MIN_RUN = 16
#: What stands between a sensitive word and the rest of its run: the end of a name with its "=", or separators.
SEPARATOR = re.compile(r"[A-Za-z_-]{0,32}=+(?=[A-Za-z0-9+/_-])|[=_/+-]*")
#: Marginal compressed bytes per character, or share of a random string's, from which a string counts as incompressible.
NOVEL = 0.9
#: Random strings that a string is compared with.
CONTROLS = 4
#: Keys mix letters with digits, or the cases of letters; a lone word does not.
MIXED = re.compile(r"\A(?=.*[0-9])(?=.*[A-Za-z])|[a-z][A-Z]")

# Usual identifiers that prime the compressor.
IDENTIFIERS = """
access_token account address admin api_key application authorization auth_token base64 bearer bucket certificate client_id
client_secret config connection const content credential database default define description digest directory document
endpoint environment export false function header host https identifier import include integer length localhost message
module namespace null object option output parameter passphrase passwd password path pointer port private_key process
protocol public_key refresh_token region register release request response return schema secret secret_key select service
session signature source static string struct template timestamp token true undefined update username utf-8 value variable
version void www xmlns ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789
"""


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base spans, leftmost and non-overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_VALUE]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


class Novelty:
    """Marginal compressed size of a string behind its surroundings."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        primed = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.press = zstandard.ZstdCompressor(level=6, dict_data=primed, write_checksum=False, write_content_size=False)

    def _cost(self, before: bytes, key: str) -> int:
        return len(self.press.compress(before + key.encode())) - len(self.press.compress(before))

    def of(self, text: str, start: int, end: int) -> float:
        """Marginal bytes per character, or per byte of the cheapest random string where that is less than a character's."""
        before, key = text[max(0, start - AROUND):start].encode(), text[start:end]
        own = self._cost(before, key)
        if own >= NOVEL * len(key):
            return own / len(key)
        return own / max(1, min(len(key), *(self._cost(before, x) for x in controls(key))))


def controls(key: str) -> list[str]:
    """Fixed random strings of the length of ``key`` over the kinds of characters that it has."""
    kinds = [("0123456789", "0123456789"), ("abcdef", "abcdefghijklmnopqrstuvwxyz"), ("ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")]
    letters, rest = "", set(key)
    for few, every in kinds:
        own = rest & set(every)
        letters += "" if not own else few if own <= set(few) else every
        rest -= own
    letters += "".join(sorted(rest))
    rnd = random.Random(len(key))
    return ["".join(rnd.choices(letters, k=len(key))) for _ in range(CONTROLS)]


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    """Incompressible strings in a sensitive context that no base span covers."""
    out, known = [], set()
    reach = far = -1
    words = [(m, SEPARATOR.match(text, m.end())) for m in SENSITIVE.finditer(text)]
    named = [m.start() for m, gap in words if "=" in gap[0]]   # a word and its "=" begin a piece of their own
    for m, gap in words:
        at = max(gap.end(), reach)
        last = m.end() + BEFORE
        while c := CANDIDATE.search(text, at, min(len(text), last + MIN_RUN)):
            start = c.start()
            if start >= far:
                far = CANDIDATE.match(text, start).end()
            end = far                                            # of the whole run
            k = bisect.bisect_left(named, start)
            cut = k < len(named) and named[k] < end              # the rest is judged behind its own word
            if cut:
                end = named[k]
            at = reach = end
            if end - start >= MIN_RUN and not any(a < end and start < b for a, _, b in base):
                key = text[start:end]
                if MIXED.search(key) and (key in known or any(text.endswith(key, a, b) for a, _, b in base)
                                          or novelty.of(text, start, end) >= NOVEL):
                    known.add(key)
                    out.append((start, 3, end))
            if cut:
                break
    return out


def spans_of(text: str, novelty: Novelty) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    base = base_spans(text)
    return base, sorted(base + novel_spans(text, base, novelty))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for t in T.slices(batches):
            n, digest, spans = [[], [], [], []], [], []
            for text in t["text"].to_pylist():
                base, every = spans_of(text or "", novelty)
                for k in range(4):
                    n[k].append(sum(1 for s in every if s[1] == k))
                digest.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
            yield pa.RecordBatch.from_arrays(
                [t["doc_id"].combine_chunks().cast(pa.int64()), *(pa.array(x, pa.int64()) for x in n[:3]),
                 pa.array(digest, pa.string()), pa.array(spans, pa.string()), pa.array(n[3], pa.int64())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every reported span replaced by ``mark``; all rows and columns stay, n_chars is renewed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for t in T.slices(batches):
            out = []
            for text in t["text"].to_pylist():
                if text:
                    parts, at = [], 0
                    for a, _, b in spans_of(text, novelty)[1]:
                        if b > at:
                            parts += [text[at:a], mark] if a >= at else []
                            at = b
                    text = "".join(parts) + text[at:]
                out.append(text)
            yield t.set_column(t.schema.get_field_index("text"), "text", pa.array(out, pa.string())).to_batches()[0]

    clean = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))
    return clean.select(*docs.columns)

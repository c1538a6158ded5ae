"""Secrets in texts: fixed shapes, and strings that a primed compressor finds new.

The fixed shapes are assignments to a sensitive name, access keys, and long hexadecimal runs. Beyond
them, each long mixed run of letters, digits and symbols in a sensitive context is compressed with a
zstandard dictionary made of identifiers and of the text around it. What it adds to the compressed
size, against its length, is its novelty: names and repetitive strings compress away, keys do not.
Other copies of the run are left out of the text around it, so that a secret given twice is found twice.

Defined cases: a null text is an empty one, without spans; ids of any type are handed on, null or
repeated ones too; further columns are not looked at; an empty table gives no rows; texts are read
whole.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections import Counter
from collections.abc import Callable, Iterator

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm import common

# The three shapes.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "novel")
LEAST_ASSIGNED = 12
#: Every assignment holds one of these.
_NAMES = ("passw", "secret", "token", "key")

#: Runs in which access keys, hexadecimal runs and candidates of the compressor all lie.
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_SENSITIVE = re.compile(
    r"passw|passphrase|pwd|secret|token|credential|auth|bearer|private|signature|api.?key|access.?key",
    re.IGNORECASE | re.ASCII,
)
#: What parts a name from its value within a run, and what may stand between adjoining values.
_SIGN = re.compile(r"=+")
_BETWEEN = re.compile(r"[\s\"'\\,;|>#*.]{0,16}")
_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----.*?(?:-----END|\Z)", re.DOTALL)
LEAST = 16
#: Characters on either side of a value in which a sensitive word is looked for, and around it those that prime the compressor.
CONTEXT = 64
PRIMING = 512
#: Compressed bytes a value must add, per character, as a share of what a random one adds (1 at most).
NOVELTY = 0.7
#: A name of words, each with a short number behind it at most.
_NAME = re.compile(r"(?:[A-Za-z]{3,}\d{0,4}[_-]?)+")
#: Share of the bits of a random letter below which a run without digits is words; smoothing of its pairs.
PROSE = 1.0
_SMOOTHING = 5
#: Identifiers taken from the corpus for the dictionary.
IDENTIFIERS = 2000

#: Names common in code and configuration, in any corpus.
COMMON_NAMES = (
    "password passwd secret token api_key apikey access_key private_key public_key client_id "
    "client_secret authorization bearer basic username user_name hostname localhost database "
    "connection_string environment variable configuration settings parameter argument return "
    "function class import export default static const string integer boolean value version "
    "https://www. http:// .com/ .org/ index.html example placeholder changeme xxxxxxxxxxxxxxxx "
    "00000000000000000000000000000000 0123456789abcdef abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
)

#: Words for the letter pairs of common languages.
COMMON_WORDS = (
    "the understanding of international information and its application development between several "
    "responsible organisations which have generally established different requirements, although nothing "
    "misleading was mentioned about management, everything available through customers and numbers "
    "die verantwortliche Gesellschaft und ihre wirtschaftlichen Voraussetzungen zwischen verschiedenen "
    "Möglichkeiten der Donauschifffahrt, Rechtschreibung, Geschwindigkeit, Dampfkraft und Arbeitszeugnisse "
    "les responsables de cette organisation ont toujours développement quelques nouvelles connaissances "
    "las responsabilidades generales de nuestra organización siempre conocimiento desarrollo trabajadores "
    "getAccountNumber setCustomerName isValidConfiguration createUserFactory updateDocumentIndex longNameConfig"
)


def frequent_identifiers(
    docs: DataFrame, text: str = "text", count: int = IDENTIFIERS
) -> list[str]:
    """The most frequent compound identifiers of the corpus, counted over all texts.

    Only names made of letters count, so that a key copied into many texts does not become one.
    """
    names = F.regexp_extract_all(
        common.text_or_empty(text), F.lit(r"\b[A-Za-z]+(?:_[A-Za-z]+)+\b"), F.lit(0)
    )
    rows = (
        docs.select(F.explode(names).alias("name"))
        .where(F.length("name") <= 60)
        .groupBy("name")
        .count()
        .orderBy(F.desc("count"), "name")
        .limit(count)
    )
    return [row["name"] for row in rows.collect()]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of each string with one of the fixed shapes, by start, then kind."""
    found = []
    lowered = text.lower()
    if any(name in lowered for name in _NAMES):
        found = [
            (m.start(), m.end(), "assign")
            for m in ASSIGN.finditer(text)
            if len(m[2]) >= LEAST_ASSIGNED
        ]
    for run in _RUN.finditer(text):
        for kind, shape in (("access", ACCESS), ("hex", HEX)):
            found += [(m.start(), m.end(), kind) for m in shape.finditer(text, *run.span())]
    return sorted(found, key=_place)


def _place(span: tuple[int, int, str]) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


_ALPHABETS = (
    string.digits,
    "0123456789abcdef",
    "0123456789ABCDEF",
    string.ascii_lowercase,
    string.ascii_uppercase,
    string.digits + string.ascii_lowercase,
    string.digits + string.ascii_uppercase,
    string.ascii_letters,
    string.digits + string.ascii_letters,
    string.digits + string.ascii_letters + "+/_=-",
)


class Novelty:
    """Compressed bytes that a string adds after identifiers and the text around it."""

    def __init__(self, identifiers: list[str], level: int = 3) -> None:
        self.names = (" ".join(identifiers) + " " + COMMON_NAMES).encode()
        self.level = level
        self.random: dict[tuple[str, int], float] = {}
        words = f"{self.names.decode()} {COMMON_WORDS}"
        # single characters and pairs of the words, as they stand and in lower case
        self.words = {
            lower: (given, Counter(given), Counter(zip(given, given[1:])))
            for lower, given in ((False, words), (True, words.lower()))
        }

    def __call__(self, run: str, before: str, after: str) -> float:
        primed = zstandard.ZstdCompressionDict(
            self.names + f" {after} {before}".encode(errors="replace"),
            dict_type=zstandard.DICT_TYPE_RAWCONTENT,
        )
        packer = zstandard.ZstdCompressor(
            level=self.level, dict_data=primed, write_content_size=False, write_checksum=False
        )
        raw = run.encode()
        return (len(packer.compress(raw)) - len(packer.compress(b""))) / len(raw)

    def of_random(self, run: str) -> float:
        """What a random string of the same alphabet and length adds, per character."""
        alphabet = next(a for a in _ALPHABETS if set(run) <= set(a))
        key = alphabet, len(run)
        if key not in self.random:
            if len(self.random) >= 10_000:
                self.random.clear()
            drawn = "".join(random.Random(len(run)).choices(alphabet, k=len(run)))
            self.random[key] = self(drawn, "", "")
        return self.random[key]

    def like_prose(self, run: str, before: str, after: str) -> bool:
        """Whether a run has the letter pairs of words.

        Too short for zstandard to code its literals, a word adds as much there as a key. It is coded
        here by its pairs, with those of the dictionary and the text around; a random one then takes
        at least the bits of a letter of its alphabet.
        """
        around = f" {after} {before}"
        lower = run[1:] in (run[1:].lower(), run[1:].upper())
        if lower:
            run, around = run.lower(), around.lower()
        words, word_letters, word_pairs = self.words[lower]
        alphabet = next(a for a in _ALPHABETS if set(run) <= set(a))
        letters, pairs = Counter(around), Counter(zip(words[-1] + around, around))
        total = len(words) + len(around) + len(alphabet) / 2
        bits = 0.0
        for a, b in zip(" " + run, run):
            alone = (word_letters[b] + letters[b] + 0.5) / total
            both = word_pairs[a, b] + pairs[a, b]
            bits -= math.log2((both + _SMOOTHING * alone) / (word_letters[a] + letters[a] + _SMOOTHING))
        return bits < PROSE * math.log2(len(alphabet)) * len(run)

    def is_name(self, run: str, before: str, after: str) -> bool:
        """Whether a run is made of words: one without digits, or words with short numbers behind them."""
        if not any(map(str.isdigit, run)):
            return self.like_prose(run, before, after)
        if not _NAME.fullmatch(run):
            return False
        return self.like_prose(re.sub(r"\d+", "", run), before, after)


def _values(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each run, or of its parts between a name, ``=`` and a value; padding stays."""
    for run in _RUN.finditer(text):
        start, end = run.span()
        for sign in _SIGN.finditer(text, start, end):
            if sign.end() == end:
                break
            if sign.start() - start >= LEAST:
                yield start, sign.start()
            start = sign.end()
        if end - start >= LEAST:
            yield start, end


def novel_spans(
    text: str, base: list[tuple[int, int, str]], novelty: Novelty, least: float = NOVELTY
) -> list[tuple[int, int, str]]:
    """Values outside the base spans (by start) that stand in a sensitive context and do not compress.

    The context reaches ``CONTEXT`` characters to either side, on through values with only blanks,
    quotes and the like between them, and over a whole block of a private key.
    """
    found = []
    blocks = [block.span() for block in _BLOCK.finditer(text)]
    at, last, sensitive = 0, 0, False
    passed, covered = 0, 0  # base spans that start before the end of the value, and how far they reach
    for start, end in _values(text):
        while at < len(blocks) and blocks[at][1] <= start:
            at += 1
        sensitive = (
            (sensitive and _BETWEEN.fullmatch(text, last, start) is not None)
            or (at < len(blocks) and blocks[at][0] <= start)
            or _SENSITIVE.search(text, max(0, start - CONTEXT), start) is not None
            or _SENSITIVE.search(text, end, end + CONTEXT) is not None
        )
        last = end
        while passed < len(base) and base[passed][0] < end:
            covered = max(covered, base[passed][1])
            passed += 1
        if not sensitive or start < covered:
            continue
        run = text[start:end]
        reach = PRIMING + len(run)  # a copy that reaches into the text around lies whole within
        blank = " " * len(run)
        before = text[max(0, start - reach) : start].replace(run, blank)[-PRIMING:]
        after = text[end : end + reach].replace(run, blank)[:PRIMING]
        if novelty(run, before, after) >= least * min(1.0, novelty.of_random(run)) and not novelty.is_name(
            run, before, after
        ):
            found.append((start, end, "novel"))
    return found


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    identifiers: list[str] | None = None,
    least: float = NOVELTY,
) -> DataFrame:
    """Per document its spans (start, end, kind) with their strings; places count code points."""
    names = frequent_identifiers(docs, text) if identifiers is None else identifiers

    def start() -> Callable:
        novelty = Novelty(names)

        def one(content: str) -> tuple[list[dict]]:
            base = base_spans(content)
            spans = sorted([*base, *novel_spans(content, base, novelty, least)], key=_place)
            return ([{"start": s, "end": e, "kind": k, "found": content[s:e]} for s, e, k in spans],)

        return one

    return common.map_rows(
        docs.select(F.col(doc_id), common.text_or_empty(text)),
        "spans array<struct<start: long, end: long, kind: string, found: string>>",
        start,
    )


def digest_spans(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per document the counts by kind, the digest of the base spans, and all spans as text; last the novel ones."""
    written = "concat_ws(':', s.kind, s.start, s.end)"
    counted = {
        kind: F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}")
        for kind in KINDS
    }
    novel = counted.pop("novel")
    return scanned.select(
        doc_id,
        *counted.values(),
        F.expr(
            f"sha2(concat_ws(',', transform(filter(spans, s -> s.kind <> 'novel'), s -> {written})), 256)"
        ).alias("base_sha256"),
        F.expr(f"concat_ws(',', transform(spans, s -> {written}))").alias("spans"),
        novel,
    )


def sha256_of(spans: list[tuple[int, int, str]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()
